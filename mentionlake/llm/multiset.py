"""Homomorphic multiset hash of a document's paragraphs.

A paragraph is hashed to a wide vector; a document's fingerprint is the sum of the vectors, coordinate by
coordinate, modulo powers of two. The order of paragraphs does not matter, and one can be put in or taken out by adding or
subtracting its vector. A vector has two parts. The first, ``lanes``, is four hashes of the whole paragraph modulo 2^32:
equal multisets have equal sums, and others differ but for chance. The second, ``sums``, holds 60 counters of 20 bits, three
to a number: for each piece of up to eight words, each bit of the piece's hash is added to a counter. Between two fingerprints the
counters, less their expected value, give the cosine of the two multisets of pieces, so fingerprints can be compared.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mentionlake.session import materialise

PIECE = r"(?:[^\x20\x09-\x0D]++[\x20\x09]*+){1,8}"
LANES, LANE_BITS = 4, 32
SUMS, COUNTERS, COUNTER_BITS = 20, 3, 20
SUM_MASK = (1 << COUNTERS * COUNTER_BITS) - 1
#: One bit at the foot of each counter.
FEET = sum(1 << i * COUNTER_BITS for i in range(COUNTERS))

ROWS_PER_RANGE, CELLS, RANGES = 2000, 1024, 1 << 20


def _long(value: int) -> Column:
    return F.lit(value).cast("long")


def _sum_of(hashes: Column) -> Column:
    """The counters of an array of hashes."""
    start = F.struct(*[_long(0).alias(f"s{i}") for i in range(SUMS)])

    def add(state: Column, h: Column) -> Column:
        bits = [F.shiftrightunsigned(h, i) if i else h for i in range(SUMS)]
        return F.struct(*[((state[f"s{i}"] + bits[i].bitwiseAND(_long(FEET))).bitwiseAND(_long(SUM_MASK))).alias(f"s{i}") for i in range(SUMS)])

    return F.aggregate(hashes, start, add, lambda s: F.array(*[s[f"s{i}"] for i in range(SUMS)]))


def fingerprint(text: Column) -> Column:
    """A struct of ``n`` (pieces), ``lanes`` and ``sums``; a null text counts as empty."""
    text = F.coalesce(text, F.lit(""))
    pieces = F.transform(F.regexp_extract_all(text, F.lit(PIECE), F.lit(0)), lambda p: F.xxhash64(p))
    paragraphs = F.split(text, "\n")
    mask = _long((1 << LANE_BITS) - 1)

    def lane(j: int) -> Column:
        return F.aggregate(paragraphs, _long(0), lambda s, p: (s + F.xxhash64(p, F.lit(j)).bitwiseAND(mask)).bitwiseAND(mask))

    lanes = [lane(j) for j in range(LANES)]
    return F.struct(F.size(pieces).cast("long").alias("n"), F.array(*lanes).alias("lanes"), _sum_of(pieces).alias("sums"))


def plus(a: Column, b: Column, sign: int = 1) -> Column:
    """The fingerprint of both multisets together; with ``sign`` -1, of ``a`` without ``b``."""
    lane, mask = 1 << LANE_BITS, 1 << COUNTERS * COUNTER_BITS
    lanes = F.zip_with(a["lanes"], b["lanes"], lambda x, y: F.pmod(x + y * sign, _long(lane)))
    sums = F.zip_with(a["sums"], b["sums"], lambda x, y: F.pmod(x + y * sign, _long(mask)))
    return F.struct((a["n"] + b["n"] * sign).alias("n"), lanes.alias("lanes"), sums.alias("sums"))


def with_paragraph(of: Column, paragraph: Column) -> Column:
    """The fingerprint after one more paragraph (no line feeds in it)."""
    return plus(of, fingerprint(paragraph))


def without_paragraph(of: Column, paragraph: Column) -> Column:
    return plus(of, fingerprint(paragraph), -1)


def to_hex(of: Column) -> Column:
    def digits(array: Column, width: int) -> Column:
        return F.array_join(F.transform(array, lambda x: F.lpad(F.lower(F.hex(x)), width, "0")), "")

    return F.concat(F.lpad(F.lower(F.hex(of["n"])), 16, "0"), digits(of["lanes"], LANE_BITS // 4), digits(of["sums"], COUNTERS * COUNTER_BITS // 4))


def _product(a: Column, b: Column) -> Column:
    """Of the counters, each less half the number of pieces, doubled."""
    def counter(x: Column, i: int) -> Column:
        return F.shiftrightunsigned(x, i * COUNTER_BITS).bitwiseAND(_long((1 << COUNTER_BITS) - 1)) if i else x.bitwiseAND(_long((1 << COUNTER_BITS) - 1))

    def part(x: Column, y: Column) -> Column:
        total = None
        for i in range(COUNTERS):
            term = (counter(x, i) * 2 - a["n"]).cast("double") * (counter(y, i) * 2 - b["n"])
            total = term if total is None else total + term
        return total

    return F.aggregate(F.zip_with(a["sums"], b["sums"], part), F.lit(0.0), lambda s, x: s + x)


def likeness(a: Column, b: Column) -> Column:
    """1 for equal fingerprints, else the cosine of their counters, not below 0; 0 if one of them has no pieces."""
    same = (a["n"] == b["n"]) & (a["lanes"] == b["lanes"]) & (a["sums"] == b["sums"])
    size = F.sqrt(_product(a, a)) * F.sqrt(_product(b, b))
    cosine = F.when(size > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), _product(a, b) / size))).otherwise(F.lit(0.0))
    return F.when(same, F.lit(1.0)).otherwise(cosine)


def _ranges(docs: DataFrame, id_col: str) -> Column:
    """A number that rises with the id, and that about ``ROWS_PER_RANGE`` rows share.

    Quantiles cut the ids into cells of like numbers of rows, whatever their values; a cell is cut further into parts of equal
    width. There are ``RANGES`` of them at most, so a table with one row for each is small.
    """
    n = docs.count()
    wanted = min(RANGES, max(1, n // ROWS_PER_RANGE))
    cells = min(CELLS, wanted)
    parts = math.ceil(wanted / cells)
    bounds: list[int] = []
    if cells > 1:
        shares = [i / cells for i in range(cells + 1)]
        found = docs.agg(F.percentile_approx(id_col, shares, 10 * cells).alias("b")).first()
        bounds = sorted(set(found.b or []))
    if len(bounds) < 2:
        return F.when(F.col(id_col).isNull(), _long(-1)).otherwise(_long(0))
    step = math.isqrt(len(bounds))
    coarse, fine = bounds[::step], [bounds[i : i + step] for i in range(0, len(bounds), step)]

    def below(array: Column) -> Column:
        return F.size(F.filter(array, lambda b: b <= F.col(id_col)))

    lists = F.array(*[F.array(*map(_long, f)) for f in fine])
    outer = F.greatest(below(F.array(*map(_long, coarse))), F.lit(1))
    cell = (outer - 1) * step + below(F.element_at(lists, outer))
    if parts == 1:
        number = cell.cast("long")
    else:
        every = F.array(*map(_long, bounds))
        low, high = F.get(every, cell - 1).cast("double"), F.get(every, cell).cast("double")
        inside = F.floor((F.col(id_col).cast("double") - low) / (high - low) * parts)
        inside = F.least(F.greatest(F.coalesce(inside, F.lit(0)), F.lit(0)), F.lit(parts - 1))
        number = cell.cast("long") * parts + inside
    return F.when(F.col(id_col).isNull(), _long(-1)).otherwise(number)


def with_next(docs: DataFrame, id_col: str, text_col: str, carried: list[str]) -> DataFrame:
    """Add ``next_<c>`` for the columns ``carried``: those of the next row by falling id, of the first row after the last.

    Texts are sent once, to ranges of ids; the first row of each range is sent to the range above it too, to follow
    its last row. Rows of one id stand in the order of their text's digest; rows without an id come last.
    """
    keyed = docs.withColumn("__range", _ranges(docs, id_col)).withColumn("__tie", F.xxhash64(text_col))
    every = Window.partitionBy(F.lit(0)).orderBy("__range")
    tops = keyed.groupBy("__range").agg(F.max(id_col).alias("__top"))
    tops = tops.select("__range", "__top", F.coalesce(F.lead("__range").over(every), F.min("__range").over(Window.partitionBy(F.lit(0)))).alias("__above"))
    # One row per range: RANGES at most.
    tops = F.broadcast(materialise(tops, "ranges").withColumnRenamed("__range", "__of"))
    first = keyed.join(tops, (F.col("__range") == F.col("__of")) & F.col(id_col).eqNullSafe(F.col("__top")))
    row = F.struct("__tie", F.col(text_col).alias("__text"), *[F.col(c).alias(f"__c{i}") for i, c in enumerate(carried)])
    first = first.groupBy("__above", "__top").agg(F.min(row).alias("__row"))
    first = first.select(
        F.col("__above").alias("__range"), F.lit(1).alias("__last"), F.col("__top").alias(id_col), F.col("__row.__tie").alias("__tie"),
        *[F.col(f"__row.__c{i}").alias(c) for i, c in enumerate(carried)])
    rows = keyed.withColumn("__last", F.lit(0)).unionByName(first, allowMissingColumns=True)
    order = Window.partitionBy("__range").orderBy("__last", F.col(id_col).desc_nulls_last(), "__tie", text_col)
    rows = rows.select("*", *[F.lead(c).over(order).alias(f"next_{c}") for c in carried])
    return rows.where("__last = 0").drop("__last", "__range", "__tie")


def edited_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id, text, fingerprint ``fp``, ``edited`` text and ``next_fp`` of each row.

    The edited text has its last half (code points, rounded down) replaced by the beginning of the next document. A
    null text counts as empty. Of repeated rows each is the next of another. A table of one row has itself as next.
    An empty table gives an empty table. Further columns are ignored.
    """
    docs = docs.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = with_next(docs.withColumn("fp", fingerprint(F.col("text"))), id_col, "text", ["text", "fp"])
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - half), F.substring("next_text", F.lit(1), half))
    return rows.withColumn("edited", edited).drop("next_text")
