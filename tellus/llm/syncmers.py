"""Document fingerprints from closed syncmers, with DataFrame functions only.

A text is a sequence of code points; a k-mer is ``CHAR_K`` of them in a row, an
s-mer ``CHAR_S`` inside it (``with_anchors`` does the same over words, with ``K``
and ``S``). A k-mer is a closed syncmer if its smallest s-mer (by
hash) is its first or its last one. Whether a k-mer is chosen depends on its
own words alone, so an edit changes the anchors that touch it and no others:
equal passages keep equal anchors wherever they stand, and anchors of two
texts can be matched by position. For the same reason a text that is put
together from parts of known texts has their anchors, and only the places
where parts meet or end are looked at again (``edited_fingerprints``).

A fingerprint is the sequence of the chosen k-mers' 32-bit hashes, in order;
as text, eight hex digits each. A text without a chosen k-mer has one anchor:
its k-mer with the smallest hash, or the whole text if it is shorter than a
k-mer. The likeness of two fingerprints is the Dice
coefficient of their distinct anchors.

Defined cases: a null text is empty; an empty text has no anchor and an empty
fingerprint (over words, so has one without words); two empty fingerprints have likeness 1, an empty and
another one 0; equal texts have equal fingerprints; repeated rows and null
ids are rows of their own (null ids come first); extra columns are not read;
an empty table gives no rows. A single row is its own next row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from tellus.llm.common import text_or_empty

K = 8
S = 2
#: Code points of a k-mer and of an s-mer; two of 17 k-mers are chosen.
CHAR_K, CHAR_S = 20, 4
#: The place of every so many anchors goes along with a text.
MARK = 32
#: Rows of a range of ids, about, and the most ranges there are.
RANGE_ROWS, MAX_RANGES = 2000, 1 << 16


def with_anchors(df: DataFrame, text_col: str, out: str, k: int = K, s: int = S) -> DataFrame:
    """``df`` and a column ``out``: array<struct<pos, hash>>, the anchors of
    a text with the place of their first word, from 0."""
    words = F.filter(F.split(text_or_empty(F.col(text_col)), r"\s+"), lambda x: x != "")
    return df.withColumn(out, _anchors(words, k, s))


def with_char_anchors(df: DataFrame, text_col: str, out: str, k: int = CHAR_K, s: int = CHAR_S) -> DataFrame:
    """``with_anchors`` over code points: places count code points."""
    return df.withColumn(out, _anchors(_chars(text_or_empty(F.col(text_col))), k, s))


def _chars(text: Column) -> Column:
    return F.when(text != "", F.split(text, "")).otherwise(F.array().cast("array<string>"))


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is computed once, however often it is read;
    a column would be copied into a filter that moves below its projection."""
    return F.get(F.transform(F.array(value), lambda x: then(x)), F.lit(0))


def _anchors(units: Column, k: int, s: int, lone: bool = True) -> Column:
    """The anchors of a sequence; without ``lone`` only its closed syncmers."""
    last = k - s

    def smallest(h: Column, width: int) -> Column:
        """The smallest of ``width`` s-mers from each place on, by ever wider runs."""
        m, have = h, 1
        while have < width:
            by = min(have, width - have)
            m, have = _let(m, lambda v, by=by: F.transform(v, lambda x, i: F.least(x, F.get(v, i + by)))), have + by
        return m

    def of_smers(w: Column, h: Column) -> Column:
        n = F.size(w)
        places = F.when(n >= k, F.sequence(F.lit(0), n - k)).otherwise(F.array().cast("array<int>"))

        def whole(i: Column) -> Column:  # by s-mers that cover the k-mer: a slice would copy the whole array
            return F.hash(*[F.get(h, i + j) for j in sorted({*range(0, last, s), last})])

        def closed(m: Column) -> Column:
            return F.filter(places, lambda i: (F.get(h, i) <= F.get(m, i + 1)) | (F.get(h, i + last) < F.get(m, i)))

        def chosen(sel: Column) -> Column:
            anchors = F.transform(sel, lambda i: F.struct(i.alias("pos"), whole(i).alias("hash")))
            if not lone:
                return anchors
            least = F.array_min(F.transform(places, lambda i: F.struct(whole(i).alias("hash"), i.alias("pos"))))
            return (F.when(F.size(sel) > 0, anchors)
                    .when(n == 0, F.array().cast("array<struct<pos:int,hash:int>>"))
                    .when(n < k, F.array(F.struct(F.lit(0).alias("pos"), F.hash(w).alias("hash"))))
                    .otherwise(F.array(F.struct(least["pos"].alias("pos"), least["hash"].alias("hash")))))
        return _let(_let(smallest(h, last), closed), chosen)

    def of_units(w: Column) -> Column:
        return _let(F.transform(w, lambda x, i: F.xxhash64(x, *[F.get(w, i + j) for j in range(1, s)])), lambda h: of_smers(w, h))
    return _let(F.transform(units, lambda x: F.xxhash64(x)), of_units)


def hashes(anchors: Column) -> Column:
    return F.transform(anchors, lambda a: a["hash"])


def as_text(anchor_hashes: Column) -> Column:
    def digits(x: Column) -> Column:
        return F.lpad(F.hex(x.cast("long").bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0")
    return F.lower(F.array_join(F.transform(anchor_hashes, digits), ""))


def likeness(a: Column, b: Column) -> Column:
    """Dice coefficient of two arrays' distinct anchors, 0 to 1."""
    sizes = F.size(F.array_distinct(a)) + F.size(F.array_distinct(b))
    return F.when(sizes == 0, F.lit(1.0)).otherwise(2.0 * F.size(F.array_intersect(a, b)) / sizes)


def position_matches(left: DataFrame, right: DataFrame, id_col: str = "doc_id", anchors: str = "anchors") -> DataFrame:
    """Rows (left_id, right_id, diagonal, matches): anchors that two tables'
    rows share, counted by the difference of their places. An anchor that a
    row holds more than once is left out of that row: it marks no place."""
    def single(df: DataFrame, side: str) -> DataFrame:
        d = df.select(F.col(id_col).alias(f"{side}_id"), F.explode(anchors).alias("a"))
        d = d.groupBy(f"{side}_id", F.col("a.hash").alias("hash")).agg(F.min("a.pos").alias(f"{side}_pos"), F.count("*").alias("n"))
        return d.filter("n = 1").drop("n")
    both = single(left, "left").join(single(right, "right"), "hash")
    return both.groupBy("left_id", "right_id", (F.col("left_pos") - F.col("right_pos")).alias("diagonal")).agg(F.count("*").alias("matches"))


def with_next(df: DataFrame, id_col: str, columns: list[str], tie: str, prefix: str = "next_") -> DataFrame:
    """``df`` and, for each of ``columns``, its value in the next row by
    ascending id (nulls first, ties by the hash of ``tie``); after the last
    row comes the first.

    Ids are dealt out to ranges whose first ids are values of the table, so
    the row that follows a range is known: it is copied to the range before.
    Every range is ordered on its own."""
    rows = df.agg(F.count("*").alias("n"), F.min(id_col).alias("least")).first()
    n = min(MAX_RANGES, 1 + rows["n"] // RANGE_ROWS)
    cuts = [] if rows["least"] is None else df.agg(
        F.percentile_approx(id_col, [i / n for i in range(n)], max(10_000, 10 * n)).alias("q")).first()["q"]
    cuts = sorted({rows["least"], *cuts} - {None})
    array, count = F.array(*[F.lit(c) for c in cuts or [0]]), max(1, len(cuts))
    steps = [1 << b for b in reversed(range(count.bit_length()))]

    def search(acc: Column, step: Column) -> Column:
        at = acc + step
        return F.when((at < count) & (F.get(array, at) <= F.col(id_col)), at).otherwise(acc)
    own = F.aggregate(F.array(*[F.lit(x) for x in steps]), F.lit(0), search)
    d = df.withColumn("_range", F.coalesce(own, F.lit(0)))
    first = F.col(id_col).isNull() | (F.col(id_col) == F.get(array, F.col("_range")))
    wraps = F.col("_range") == 0
    here = F.struct(F.col("_range").alias("range"), F.lit(0).alias("copy"))
    before = F.struct(F.when(wraps, count - 1).otherwise(F.col("_range") - 1).alias("range"), F.when(wraps, 2).otherwise(1).alias("copy"))
    d = d.withColumn("_at", F.explode(F.when(first, F.array(here, before)).otherwise(F.array(here)))).drop("_range")
    d = d.withColumn("_copy", F.col("_at.copy")).withColumn("_range", F.col("_at.range")).drop("_at")
    w = Window.partitionBy("_range").orderBy(F.col("_copy") == 2, F.col(id_col).asc_nulls_first(), "_copy", F.xxhash64(tie), tie)
    for c in columns:
        d = d.withColumn(prefix + c, F.lead(c).over(w))
    return d.filter(F.col("_copy") == 0).drop("_copy", "_range")


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = CHAR_K, s: int = CHAR_S) -> DataFrame:
    """Per row: doc_id, n_chars, edited (the text with its last half replaced
    by the start of the next text), fp, edited_fp, next_fp (arrays of anchor
    hashes).

    The edited text's closed syncmers are, in order, those of the text that
    end before the cut, those that cross it, and those of the next text that
    end before its own cut: the first ones up to the last mark (the place of
    every ``MARK``-th anchor), the others from the code points behind it. Only
    where there is none at all the edited text is looked at whole."""
    d = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(F.col(text_col)).alias("text"))
    d = d.withColumn("closed", _anchors(_chars(F.col("text")), k, s, lone=False))
    n = F.length("text")
    cut = F.floor(n / 2).cast("int")
    none = F.size("closed") == 0
    kept = _let(n - cut, lambda end: F.size(F.filter("closed", lambda a: a["pos"] + k <= end)))
    marks = F.transform(F.filter("closed", lambda a, i: i % MARK == 0), lambda a: a["pos"])
    whole = F.when(none, hashes(_anchors(_chars(F.col("text")), k, s))).otherwise(hashes(F.col("closed")))
    d = d.select("doc_id", "text", whole.alias("fp"), F.struct(kept.alias("kept"), marks.alias("marks")).alias("m"))
    d = with_next(d, "doc_id", ["text", "fp", "m"], "text")
    start = F.substr("next_text", F.lit(1), cut)
    edited = F.concat(F.substr("text", F.lit(1), n - cut), start)
    d = d.select("doc_id", n.cast("long").alias("n_chars"), edited.alias("edited"), "fp", "next_fp", F.col("m.kept").alias("kept"), (n - cut).alias("own"),
                 _let(F.least(cut, F.length("next_text")), lambda end: F.filter("next_m.marks", lambda p: p + k <= end)).alias("marks"))
    known = F.when(F.size("marks") > 0, (F.size("marks") - 1) * MARK + 1).otherwise(0)
    behind = F.when(F.size("marks") > 0, F.element_at("marks", -1) + 1).otherwise(0)  # code points of the next text
    before = F.least(F.col("own"), F.lit(k - 1))
    joint = F.substr("edited", F.col("own") - before + 1, before + k - 1)
    rest = F.substr("edited", F.col("own") + behind + 1, F.length("edited"))
    parts = F.concat(F.slice("fp", F.lit(1), F.col("kept")), hashes(_anchors(_chars(joint), k, s, lone=False)),
                     F.slice("next_fp", F.lit(1), known), hashes(_anchors(_chars(rest), k, s, lone=False)))
    d = d.withColumn("parts", parts)
    edited_fp = F.when(F.size("parts") == 0, hashes(_anchors(_chars(F.col("edited")), k, s))).otherwise(F.col("parts"))
    return d.select("doc_id", "n_chars", "edited", "fp", edited_fp.alias("edited_fp"), "next_fp")
