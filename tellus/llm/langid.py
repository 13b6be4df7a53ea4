"""Language ID by cross-parsing entropy over suffix automata.

Texts are lower-cased, and what is neither a letter nor a mark becomes a
space. For each language a suffix automaton of a bounded sample of labelled text is
built. A text is parsed against each of them into phrases: from where the
last phrase ended, the longest run that occurs in the language's sample (one
character at least). The samples have the same length, so the language that
needs the fewest phrases per character is the nearest one.

The automata become one flat table of transitions, and many texts are parsed
at once, one character of each text and language per step. The most frequent
characters have a column in the table; arcs on all the others are kept as
sorted keys of state and character, so every character of a sample counts.

Sample: of each language's rows outside the held-out fold, the ``DOCS`` with
the smallest hash of their text, cut to ``SAMPLE_CHARS`` characters in all.
That bound is of the model alone; every text is parsed whole.

Defined cases: a null text, or one without a letter, is ``und`` with score 0;
ties go to the language that sorts first; rows without a language are not
learnt from, nor are rows without an id (their fold is unknown); if nothing
can be learnt every text is ``und``; repeated rows and extra columns do no
harm, since a prediction reads its own text alone; an empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.functions import pandas_udf

from tellus.llm.common import fresh, give_back, held_out, small_batches, text_or_empty

#: Bounds of the sample of each language: rows, and characters in all.
DOCS = 40
SAMPLE_CHARS = 24_000
#: Characters with a column in the transition table, the most frequent ones;
#: the arcs on others are searched. A language's table stays under 50 MB.
ALPHABET = 255
#: Texts parsed side by side, and characters of them, at most; one long text may exceed it.
SIDE_BY_SIDE = 4096
SIDE_CHARS = 4_000_000
UNKNOWN = "und"
#: Phrases per character from which a text counts as none of the languages.
#: A text of a few letters can't tell, so its length counts as ``FEW`` at least.
REJECT_RATE, FEW = 0.75, 20

_LETTER = regex.compile(r"\p{L}")
_MARKED = regex.compile(r"[\p{L}\p{M}]")
_OTHER = regex.compile(r"[^\p{L}\p{M}]+")


def suffix_automaton(text: str) -> list[dict[str, int]]:
    """Transitions of the states of the automaton that accepts every
    substring of ``text``; state 0 is the root."""
    nxt: list[dict[str, int]] = [{}]
    link, size, last = [-1], [0], 0
    for c in text:
        new = len(nxt)
        nxt.append({})
        link.append(0)
        size.append(size[last] + 1)
        p = last
        while p >= 0 and c not in nxt[p]:
            nxt[p][c] = new
            p = link[p]
        if p >= 0:
            q = nxt[p][c]
            if size[q] == size[p] + 1:
                link[new] = q
            else:
                copy = len(nxt)
                nxt.append(dict(nxt[q]))
                link.append(link[q])
                size.append(size[p] + 1)
                while p >= 0 and nxt[p].get(c) == q:
                    nxt[p][c] = copy
                    p = link[p]
                link[q] = link[new] = copy
        last = new
    return nxt


def normal(text: str) -> str:
    """Lower case; each run of anything but letters and marks is one space."""
    return _OTHER.sub(" ", text.lower())


class Model:
    """Languages, an alphabet, and one transition table: row = state, column
    = character; -1 where the automaton has no arc. States are kept as the
    place of their row in the flat table; ``roots`` has each language's first.
    Arcs on characters without a column: ``keys`` (state x ``kinds`` + code,
    ascending) and the states they lead to, ``ends``."""

    def __init__(self, samples: dict[str, str]):
        self.languages = sorted(samples)
        samples = {k: normal(t) for k, t in samples.items()}
        seen = Counter(c for t in samples.values() for c in t if c != " ")
        by_count = sorted(seen, key=lambda c: (-seen[c], c))
        letters = [" ", *sorted(by_count[:ALPHABET])]
        self.width = len(letters) + 1
        letters += sorted(by_count[ALPHABET:])  # codes from width on: no column
        self.codes = {c: i + 1 for i, c in enumerate(letters)}  # 0: a letter of no sample
        self.kinds = len(letters) + 1
        tables, roots, at, keys, ends = [], [], 0, [], []
        for name in self.languages:
            states = suffix_automaton(samples[name])
            t = np.full((len(states), self.width), -1, np.int32)
            for s, arcs in enumerate(states):
                for c, to in arcs.items():
                    code = self.codes[c]
                    if code < self.width:
                        t[s, code] = (at + to) * self.width
                    else:
                        keys.append((at + s) * self.width * self.kinds + code)
                        ends.append((at + to) * self.width)
            tables.append(t)
            roots.append(at * self.width)
            at += len(states)
        self.flat = np.concatenate(tables).ravel() if tables else np.zeros(0, np.int32)
        self.roots = np.array(roots, np.int32)
        order = np.argsort(np.array(keys, np.int64))
        self.keys, self.ends = np.array(keys, np.int64)[order], np.array(ends, np.int32)[order]

    def encode(self, text: str) -> np.ndarray:
        """The columns of the characters of the text's normal form."""
        if not hasattr(self, "_low"):
            self._low = np.array([self.codes.get(chr(i), 0) if _MARKED.match(chr(i)) else 1 for i in range(1 << 16)],
                                 np.uint16 if self.kinds < 1 << 16 else np.int32)
        points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
        out = self._low[np.minimum(points, 0xFFFF)]
        for i in np.flatnonzero(points >= 0xFFFF):
            out[i] = self.codes.get(chr(points[i]), 0) if _MARKED.match(chr(points[i])) else 1
        space = out == 1
        return out[~(space & np.concatenate([[False], space[:-1]]))] if len(out) else out

    def follow(self, state: np.ndarray, code: np.ndarray) -> np.ndarray:
        """The state that each one's arc on a code leads to, or -1."""
        rare = code >= self.width
        if not rare.any():
            return self.flat.take(state + code)
        to = self.flat.take(state + np.where(rare, 0, code))  # column 0 has no arc
        at = np.nonzero(np.broadcast_to(rare, to.shape))
        key = state[at].astype(np.int64) * self.kinds + np.broadcast_to(code, to.shape)[at]
        place = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        to[at] = np.where(self.keys[place] == key, self.ends[place], -1)
        return to

    def phrases(self, codes: list[np.ndarray]) -> np.ndarray:
        """Phrases of each encoded text (rows) in each language (columns)."""
        order = sorted(range(len(codes)), key=lambda i: -len(codes[i]))
        sizes = np.array([len(codes[i]) for i in order], np.int64)
        chars = np.concatenate([codes[i] for i in order]).astype(np.int32)
        starts = np.cumsum(sizes) - sizes
        state = np.tile(self.roots, (len(codes), 1))
        count = np.zeros(state.shape, np.int64)
        live = len(codes)
        for t in range(int(sizes[0])):
            while sizes[live - 1] <= t:
                live -= 1
            c = chars[starts[:live] + t]
            s = state[:live]
            to = self.follow(s, c[:, None])
            row, col = np.nonzero(to < 0)
            if len(row):
                count[row, col] += s[row, col] != self.roots[col]  # the phrase before ends
                again = self.follow(self.roots[col], c[row])
                lone = again < 0  # a character that the sample lacks is a phrase
                count[row, col] += lone
                to[row, col] = np.where(lone, self.roots[col], again)
            state[:live] = to
        count += state != self.roots
        out = np.empty_like(count)
        out[order] = count
        return out

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score and phrases per character of each text. Score: the
        winner's share of the inverse phrase counts, 0 to 1."""
        known = np.array([bool(_LETTER.search(t)) for t in texts], bool) & bool(self.languages)
        langs, score, rate = [UNKNOWN] * len(texts), np.zeros(len(texts)), np.ones(len(texts))
        at = np.flatnonzero(known)
        if len(at):
            codes = [self.encode(texts[i]) for i in at]
            n = self.phrases(codes)
            best = n.argmin(1)
            inverse = 1.0 / n
            score[at] = inverse.max(1) / inverse.sum(1)
            rate[at] = n.min(1) / np.maximum(FEW, [len(c) for c in codes])
            for i, b in zip(at, best):
                langs[i] = self.languages[b]
        return langs, score, rate


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          docs_per_language: int = DOCS, chars: int = SAMPLE_CHARS) -> Model:
    """A model of a bounded sample of the rows outside the held-out fold."""
    d = docs.select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"), F.col(id_col).alias("id"))
    d = d.filter(~held_out(F.col("id")) & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    d = d.select("lang", F.substr("text", F.lit(1), F.lit(chars)).alias("text"), F.xxhash64("text").alias("h"))
    nth = F.row_number().over(Window.partitionBy("lang").orderBy("h", "text"))  # few rows of each task are shuffled
    d = d.withColumn("nth", nth).filter(F.col("nth") <= docs_per_language)
    before = F.sum(F.length("text")).over(Window.partitionBy("lang").orderBy("nth").rowsBetween(Window.unboundedPreceding, -1))
    d = d.withColumn("before", F.coalesce(before, F.lit(0))).filter(F.col("before") < chars)
    rows = d.select("lang", "nth", "text").orderBy("lang", "nth").collect()  # two samples' length a language at most
    samples: dict[str, str] = {}
    for r in rows:
        samples[r["lang"]] = (samples.get(r["lang"], "") + r["text"].lower() + "\n")[:chars]
    return Model(samples)


def identify(docs: DataFrame, model: Model, text_col: str = "text") -> Column:
    """struct<lang, score, rate> for each row's text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded: languages x sample

    @pandas_udf("lang string, score double, rate double")
    def tag(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        held: list[pd.Series] = []

        def flush() -> pd.DataFrame:
            texts = [t for b in held for t in b]
            held.clear()
            lang, score, rate = shared.value.predict(texts)
            return pd.DataFrame({"lang": lang, "score": score, "rate": rate})
        size = 0
        for b in batches:
            held.append(b)
            size += int(b.str.len().sum())
            if size >= SIDE_CHARS or sum(map(len, held)) >= SIDE_BY_SIDE:
                size = 0
                yield flush()
        if held:
            yield flush()
        give_back()
    small_batches(docs.sparkSession)
    return tag(text_or_empty(F.col(text_col)))


def keep_known(docs: DataFrame, reject_rate: float = REJECT_RATE) -> DataFrame:
    """``docs`` without the rows that have no letter, and without those that
    are like none of the languages: ``reject_rate`` phrases per character or
    more, so nearly every character is a phrase of its own."""
    c = fresh(docs, "_language")
    d = docs.withColumn(c, identify(docs, learn(docs)))
    return d.filter((F.col(c)["lang"] != UNKNOWN) & (F.col(c)["rate"] < reject_rate)).drop(c)
