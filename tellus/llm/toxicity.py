"""Toxic spans and document scores by a linear-chain conditional random field.

Two states (clean, toxic) run over the words of a text. A word's evidence is
the sum of the weights of its features (the word, its first 3 to 8 letters,
its last 3 to 5); transitions weigh neighbouring states. Training maximises
the likelihood of labelled words; the forward-backward marginals give every
word's probability of being toxic. Runs of words at 0.5 or more are the
offending spans; the marginals' sum, largest value and density go through a
logistic regression into the document's score.

Labelled words: only documents are labelled, so a word of a toxic document is
labelled toxic if one of its features is far more frequent in the toxic
documents of the sample than in the others (``LIFT``). Words of other
documents are all clean, the same words included.

Sample: of the labelled rows outside the held-out fold, the ``POSITIVES`` and
``NEGATIVES`` with the smallest hash of their id, up to ``TRAIN_CHARS``
characters each; both classes are weighted back to their true share. That
bounds the model alone; scores read whole texts and nothing but the text.

Defined cases: a null text is empty, and an empty text gets the score of a
text without evidence; several labels of one id count as the largest, null
labels as none; if one of the classes has no labelled row there is nothing
to learn and every score is 0; repeated rows are scored alike; null ids are
scored; extra columns do no harm; an empty table gives no rows.
"""

from __future__ import annotations

import re
import sys
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import pandas_udf

from tellus.llm.common import fresh, give_back, held_out, small_batches, text_or_empty

#: Bounds of the sample: rows of either class, characters of each.
POSITIVES, NEGATIVES, TRAIN_CHARS = 1200, 2000, 20_000
#: A feature marks toxic words if it has so many times the rate, and occurrences.
LIFT, LEAST = 8.0, 8
#: Words of a training sequence; marked sequences without a mark that are kept.
SEQUENCE, PLAIN = 48, 4000
STEPS, L2 = 120, 1e-3
#: Words of a task's cache of evidence; it is emptied beyond.
CACHE_WORDS = 150_000
#: Characters of texts that are tagged side by side, about.
SIDE_CHARS = 1_000_000
REJECT = 0.5

_WORD = re.compile(r"\w+")


def features(word: str) -> list[str]:
    w = word.lower()
    return ["w:" + w, *("p:" + w[:n] for n in range(3, min(8, len(w)) + 1)), *("s:" + w[-n:] for n in range(3, min(5, len(w)) + 1))]


class _Evidence(dict):
    """Evidence of words, worked out when first met."""

    def __init__(self, weights: dict[str, float], bias: float):
        super().__init__()
        self.weights, self.bias = weights, bias

    def __missing__(self, word: str) -> float:
        if len(self) >= CACHE_WORDS:
            self.clear()
        get = self.weights.get
        value = self[word] = self.bias + sum(get(f, 0.0) for f in features(word))
        return value


def _ratio(r: np.ndarray, t: np.ndarray, axis: int) -> np.ndarray:
    """log of the message to state 1 over that to state 0, from log odds r."""
    if axis == 0:
        return np.logaddexp(t[0, 1], t[1, 1] + r) - np.logaddexp(t[0, 0], t[1, 0] + r)
    return np.logaddexp(t[1, 0], t[1, 1] + r) - np.logaddexp(t[0, 0], t[0, 1] + r)


def marginals(odds: list[np.ndarray], t: np.ndarray) -> list[np.ndarray]:
    """P(toxic) of each word of each text, by forward-backward over log odds;
    one word of each text per step, longest texts first."""
    order = sorted(range(len(odds)), key=lambda i: -len(odds[i]))
    sizes = np.array([len(odds[i]) for i in order], np.int64)
    flat = np.concatenate([odds[i] for i in order]) if order else np.zeros(0)
    starts = np.cumsum(sizes) - sizes
    live = len(sizes) - np.searchsorted(sizes[::-1], np.arange(int(sizes[0]) if len(sizes) else 0), "right")
    forward, back = flat.copy(), np.zeros(len(flat))
    for k in range(1, len(live)):
        at = starts[:live[k]] + k
        forward[at] += _ratio(forward[at - 1], t, 0)
    for k in range(len(live) - 1, 0, -1):
        at = starts[:live[k]] + k
        back[at - 1] = _ratio(flat[at] + back[at], t, 1)
    p = 1.0 / (1.0 + np.exp(-np.clip(forward + back, -500, 500)))
    out: list[np.ndarray] = [np.zeros(0)] * len(odds)
    for k, i in enumerate(order):
        out[i] = p[starts[k]:starts[k] + sizes[k]]
    return out


def _summary(p: np.ndarray) -> list[float]:
    s = float(p.sum())
    return [1.0, np.log1p(s), float(p.max()) if len(p) else 0.0, np.log1p(100.0 * s / (20 + len(p))), min(s, 3.0)]


class Model:
    """Weights of features, transitions, and the document regression."""

    def __init__(self, weights: dict[str, float], bias: float, transitions: np.ndarray, beta: np.ndarray | None):
        self.weights, self.bias, self.transitions, self.beta = weights, bias, transitions, beta

    def evidence(self) -> _Evidence:
        return _Evidence(self.weights, self.bias)

    def word_odds(self, texts: list[str], e: _Evidence) -> list[np.ndarray]:
        return [np.array([e[w] for w in _WORD.findall(t)], np.float64) for t in texts]

    def scores(self, texts: list[str], e: _Evidence | None = None) -> tuple[np.ndarray, list[np.ndarray]]:
        if self.beta is None:
            return np.zeros(len(texts)), [np.zeros(0)] * len(texts)
        p = marginals(self.word_odds(texts, self.evidence() if e is None else e), self.transitions)
        x = np.array([_summary(q) for q in p]).reshape(len(texts), -1)
        return 1.0 / (1.0 + np.exp(-x @ self.beta)), p


def spans(text: str, p: np.ndarray, least: float = 0.5) -> list[dict]:
    """Runs of words with P(toxic) of ``least`` or more: start and end in code
    points, and the largest probability."""
    out: list[dict] = []
    last = -2
    for i, m in enumerate(_WORD.finditer(text)):
        if i < len(p) and p[i] >= least:
            if last == i - 1:
                out[-1]["end"], out[-1]["p"] = m.end(), max(out[-1]["p"], float(p[i]))
            else:
                out.append({"start": m.start(), "end": m.end(), "p": float(p[i])})
            last = i
    return out


def train(texts: list[str], toxic: list[int], weight: list[float]) -> Model:
    """A model of labelled texts. ``weight``: of each text in the regression."""
    words = [list(map(sys.intern, _WORD.findall(t))) for t in texts]
    counts = [Counter(), Counter()]
    for w, y in zip(words, toxic):
        counts[y].update(w)
    total = [max(1, sum(c.values())) for c in counts]
    toxic_count, clean_count = Counter(), Counter()
    for w, n in counts[1].items():
        for f in features(w):
            toxic_count[f] += n
    often = {f for f, n in toxic_count.items() if n >= LEAST}
    for w, n in counts[0].items():
        for f in often.intersection(features(w)):
            clean_count[f] += n
    marked = {f for f in often if toxic_count[f] / total[1] >= LIFT * (clean_count[f] + 0.5) / total[0]}
    del toxic_count, clean_count, often
    index = {f: i for i, f in enumerate(sorted(marked))}
    known: dict[str, tuple[int, ...]] = {}
    for c in counts:
        for w in c:
            if w not in known:
                known[w] = tuple(index[f] for f in features(w) if f in index)
    # sequences with a marked word, and some without that stand for the rest
    rows, plain = [], []
    for w, y in zip(words, toxic):
        for i in range(0, len(w), SEQUENCE):
            part = w[i:i + SEQUENCE]
            (rows if any(known[x] for x in part) else plain).append((part, y))
    step = max(1, len(plain) // PLAIN)
    kept = plain[::step]
    weights = np.array([1.0] * len(rows) + [len(plain) / max(1, len(kept))] * len(kept))
    rows += kept
    n = len(rows)
    size = np.array([len(p) for p, _ in rows], np.int64)
    mask = np.arange(SEQUENCE)[None, :] < size[:, None]
    gold = np.zeros((n, SEQUENCE))
    place, feat = [], []
    for r, (part, y) in enumerate(rows):
        for k, x in enumerate(part):
            if known[x]:
                gold[r, k] = y
                place += [r * SEQUENCE + k] * len(known[x])
                feat += known[x]
    place, feat = np.array(place, np.int64), np.array(feat, np.int64)
    theta = np.zeros(len(index) + 5)  # features, bias, transitions
    theta[len(index)] = -4.0
    m = v = np.zeros_like(theta)
    wmask = mask * weights[:, None]
    scale = wmask.sum() or 1.0
    pair = mask[:, 1:] * weights[:, None]
    seen = np.stack([((1 - gold[:, :-1]) * (1 - gold[:, 1:]) * pair).sum(), ((1 - gold[:, :-1]) * gold[:, 1:] * pair).sum(),
                     (gold[:, :-1] * (1 - gold[:, 1:]) * pair).sum(), (gold[:, :-1] * gold[:, 1:] * pair).sum()])
    for it in range(STEPS if n else 0):
        t = theta[-4:].reshape(2, 2)
        odds = (np.bincount(place, theta[feat], n * SEQUENCE) if len(place) else np.zeros(n * SEQUENCE)).reshape(n, SEQUENCE) + theta[len(index)]
        f, b = odds.copy(), np.zeros_like(odds)
        for k in range(1, SEQUENCE):
            f[:, k] += _ratio(f[:, k - 1], t, 0)
        for k in range(SEQUENCE - 1, 0, -1):
            b[:, k - 1] = np.where(mask[:, k], _ratio(odds[:, k] + b[:, k], t, 1), 0.0)
        p = 1.0 / (1.0 + np.exp(-(f + b)))
        # pair probabilities, from the messages around each pair of words
        left, right = f[:, :-1], odds[:, 1:] + b[:, 1:]
        four = np.stack([t[0, 0] + 0 * left, t[0, 1] + right, t[1, 0] + left, t[1, 1] + left + right])
        four = np.exp(four - four.max(0))
        four /= four.sum(0)
        grad = np.zeros_like(theta)
        diff = ((gold - p) * wmask).ravel()
        if len(place):
            grad[:len(index)] = np.bincount(feat, diff[place], len(index))
        grad[len(index)] = diff.sum()
        grad[-4:] = seen - (four * pair).sum((1, 2))
        grad = grad / scale * 100 - L2 * theta
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad ** 2
        theta = theta + 0.25 * (m / (1 - 0.9 ** (it + 1))) / (np.sqrt(v / (1 - 0.99 ** (it + 1))) + 1e-8)
    model = Model({f: float(theta[i]) for f, i in index.items()}, float(theta[len(index)]), theta[-4:].reshape(2, 2).copy(), np.zeros(5))
    _, p = model.scores(texts)
    x = np.array([_summary(q) for q in p])
    y, w, beta = np.array(toxic, float), np.array(weight, float), np.zeros(x.shape[1])
    ridge = np.diag([1e-6, *[0.1] * (x.shape[1] - 1)])
    for _ in range(30):  # Newton steps of a ridge logistic regression
        q = 1.0 / (1.0 + np.exp(-x @ beta))
        h = (x * (w * np.maximum(q * (1 - q), 1e-6))[:, None]).T @ x + ridge
        beta = beta + np.clip(np.linalg.solve(h, x.T @ (w * (y - q)) - ridge @ beta), -2, 2)
    model.beta = beta
    return model


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          positives: int = POSITIVES, negatives: int = NEGATIVES) -> Model:
    """A model of a bounded sample of the labelled rows outside the held-out fold."""
    y = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).filter("id IS NOT NULL AND y IS NOT NULL")
    y = y.filter(~held_out(F.col("id"))).groupBy("id").agg((F.max("y") > 0).cast("int").alias("y"))
    texts, marks, weight, ids = [], [], [], []
    for value, most in ((1, positives), (0, negatives)):
        own = y.filter(F.col("y") == value)
        n = own.count()
        rows = own.orderBy(F.xxhash64("id"), "id").limit(most).collect()
        ids += [(r["id"], value, n / max(1, len(rows))) for r in rows]
    if len({v for _, v, _ in ids}) == 2:
        kind = y.schema["id"].dataType.simpleString()
        chosen = docs.sparkSession.createDataFrame(ids, f"id {kind}, y int, weight double")  # bounded by the parameters
        d = docs.select(F.col(id_col).alias("id"), F.substr(text_or_empty(F.col(text_col)), F.lit(1), F.lit(TRAIN_CHARS)).alias("text"))
        rows = d.join(F.broadcast(chosen), "id").groupBy("id", "y", "weight").agg(F.max("text").alias("text")).collect()
        for r in sorted(rows, key=lambda r: (r["y"], r["text"], str(r["id"]))):
            texts.append(r["text"])
            marks.append(r["y"])
            weight.append(r["weight"])
    if len(set(marks)) < 2:
        return Model({}, 0.0, np.zeros((2, 2)), None)
    return train(texts, marks, weight)


def tag(docs: DataFrame, model: Model, text_col: str = "text", with_spans: bool = True) -> Column:
    """struct<score, spans> for each row's text; spans are given for texts
    with a score of 0.5 or more, and for the others if they have any."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded: features of the sample

    @pandas_udf("score double, spans array<struct<start: int, end: int, p: double>>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        held: list[str] = []
        size, seen = 0, shared.value.evidence()

        def flush() -> pd.DataFrame:
            score, p = shared.value.scores(held, seen)
            found = [spans(t, q) if with_spans and len(q) and q.max() >= 0.5 else [] for t, q in zip(held, p)]
            return pd.DataFrame({"score": score, "spans": found})
        for b in batches:
            done = []
            for t in b:
                held.append(t)
                size += len(t)
                if size >= SIDE_CHARS:
                    done.append(flush())
                    held, size = [], 0
            if held:
                done.append(flush())
                held, size = [], 0
            yield pd.concat(done) if done else pd.DataFrame({"score": np.zeros(0), "spans": []})
        held, seen = [], {}
        give_back()
    small_batches(docs.sparkSession)
    return run(text_or_empty(F.col(text_col)))


def keep_clean(docs: DataFrame, labels: DataFrame, reject: float = REJECT) -> DataFrame:
    """``docs`` without the rows that score ``reject`` or more."""
    c = fresh(docs, "_toxic")
    return docs.withColumn(c, tag(docs, learn(docs, labels), with_spans=False)).filter(F.col(c)["score"] < reject).drop(c)
