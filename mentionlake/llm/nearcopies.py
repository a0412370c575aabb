"""Near copies: texts whose sets of five-word shingles have a Jaccard similarity of 0.8 or more, confirmed exactly.

Fingerprints of 64 bits cannot find these: at similarity 0.8 about ten bits differ, and keys for so many are shared by
most texts. So beside the Golay keys of the SimHash (over five words) a text has ``BANDS`` keys of ``ROWS`` minima
each, of which a pair at similarity s shares none with a chance of (1 - s^5)^40: 1.2e-7 at 0.8, less above. Texts that share
a key are candidates, and only those are linked whose shingles, all of them, are similar enough.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mentionlake.llm import simhash
from mentionlake.llm.common import possible
from mentionlake.llm.graph import components
from mentionlake.session import materialise, ship_package

SHINGLE = 5
#: The similarity, as a fraction.
SIMILAR, OF = 4, 5
BANDS, ROWS = 40, 5
#: Shingles are permuted so many at a time.
STEP = 512
#: Places of a set's outline.
OUTLINE = 1024
#: Texts that a key leaves apart are compared so many times with the largest component before they are compared with each other.
TURNS = 3
_random = np.random.default_rng(20240501)
MASKS, FACTORS = _random.integers(0, 1 << 63, (2, BANDS * ROWS, 1), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
MIX = _random.integers(0, 1 << 63, ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(text: bytes | None) -> np.ndarray:
    """The hashes of the distinct shingles, in order. A text of fewer than five words is one shingle, one without words has none."""
    return np.unique(np.concatenate([np.zeros(0, np.uint64), *simhash.shingle_hashes(text or b"", SHINGLE)]))


def band_keys(hashes: np.ndarray) -> np.ndarray:
    """One key for each band."""
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(hashes), STEP):
        np.minimum(least, ((hashes[i : i + STEP] ^ MASKS) * FACTORS).min(axis=1), out=least)
    mixed = ((least ^ least >> np.uint64(32)).reshape(BANDS, ROWS) * MIX).sum(axis=1, dtype=np.uint64)
    return (mixed ^ mixed >> np.uint64(29)) * MIX[0] + np.arange(BANDS, dtype=np.uint64)


def keys(hashes: np.ndarray) -> np.ndarray:
    """Those of the bands and of the fingerprint. Texts without words share all."""
    golay, _ = simhash.segment_keys(np.array([simhash.fingerprint_of([hashes])], np.int64))
    return np.concatenate([band_keys(hashes).view(np.int64), golay])


def outline(hashes: np.ndarray) -> np.ndarray:
    """One bit for each place: whether an odd number of the hashes fall there."""
    odd = np.bincount((hashes % np.uint64(OUTLINE)).astype(np.int64), minlength=OUTLINE) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def digest(text_col: str) -> Column:
    """The same for equal texts only; null counts as empty."""
    return F.unhex(F.md5(F.coalesce(F.col(text_col).cast("binary"), F.lit("").cast("binary"))))


def mapped(rows: DataFrame, of_text, field: str) -> DataFrame:
    """The columns but the last, the size of the text's set of shingles, and ``field``: longs made of that set."""
    ship_package(rows.sparkSession)
    kept = rows.schema.fields[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                sets = [shingles(t.as_py()) for t in part.column(len(kept))]
                made = pa.array([of_text(s) for s in sets], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array([len(s) for s in sets], pa.int64()), made], names=[*part.schema.names[:-1], "size", field])

    return rows.mapInArrow(run, T.StructType([*kept, T.StructField("size", T.LongType()), T.StructField(field, T.ArrayType(T.LongType()))]))


def could_be(a: Column, b: Column) -> Column:
    """Whether sets of these sizes can be similar enough."""
    return F.least(a, b) * OF >= F.greatest(a, b) * SIMILAR


def outlines(sets: DataFrame) -> DataFrame:
    """(node, outline) of (node, set)."""
    ship_package(sets.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [outline(s.values.to_numpy().view(np.uint64)) for s in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.list_(pa.int64()))], names=["node", "outline"])

    return sets.select("node", "set").mapInArrow(run, "node binary, outline array<long>")


def outlines_near(a: str, b: str, sizes: Column) -> Column:
    """Whether sets with these outlines, of ``sizes`` shingles together, can be similar enough.

    Each place in which the outlines differ has a shingle that only one set has, and similar sets have a ninth of
    ``sizes`` of these at most.
    """
    apart = F.lit(0)
    for i in range(OUTLINE // 64):
        apart = apart + F.bit_count(F.get(a, F.lit(i)).bitwiseXOR(F.get(b, F.lit(i))))
    return apart * (OF + SIMILAR) <= sizes * (OF - SIMILAR)


def shingle_sets(texts: DataFrame, rows: DataFrame) -> DataFrame:
    """(node, size, set) of ``texts``, each hashed once, however many copies it has."""
    wanted = materialise(texts.select("node", F.col("least").alias("id"), F.xxhash64("node", "least").alias("at")), "near-wanted")
    met = possible(rows.withColumn("at", F.xxhash64("node", "id")), "at", wanted)
    met = met.join(wanted.select("node", F.col("id").alias("least")), "node").where(F.col("id").eqNullSafe(F.col("least")))
    sets = mapped(met.select("node", F.col("text").cast("binary").alias("text")), lambda s: s.view(np.int64), "set")
    return materialise(sets.dropDuplicates(["node"]), "near-sets")


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) of digests whose sets of shingles are similar."""
    pairs = materialise(pairs, "near-pairs")
    a, b = (sets.select(F.col("node").alias(n), F.col("size").alias(f"{n}_size"), F.col("set").alias(f"{n}_set")) for n in "ab")
    common = F.size(F.array_intersect("a_set", "b_set")).cast("long")
    similar = common * OF >= (F.col("a_size") + F.col("b_size") - common) * SIMILAR
    return materialise(pairs.join(a, "a").join(b, "b").where(similar).select("a", "b"), "near-links")


def unsettled(held: DataFrame, links: DataFrame, texts: DataFrame) -> DataFrame:
    """The members of the keys that ``links`` leave in several components, with their ``root`` and the ``largest`` root of the key.

    The two members of a key that has no more have been compared, so nothing is left to do there.
    """
    state = labelled(links, texts).select("node", F.col("label.node").alias("root"))
    held = held.select("key", "node", "size").join(state, "node", "left").select("key", "node", "size", F.coalesce("root", "node").alias("root"))
    held = materialise(held, "near-members")
    roots = held.groupBy("key", "root").agg(F.count(F.lit(1)).alias("n"))
    split = roots.groupBy("key").agg(F.count(F.lit(1)).alias("roots"), F.sum("n").alias("nodes"), F.max_by("root", "n").alias("largest"))
    split = split.where("roots > 1 AND nodes > 2")
    return materialise(held.join(materialise(split.select("key", "largest"), "near-split"), "key"), "near-members")


def can_be_similar(held: DataFrame, sets: DataFrame) -> DataFrame:
    """The members whose sets have four fifths of their shingles in common with other members, with their ``outline``.

    Of similar sets each has at least that share in the other, so no member that is left out has a near copy among ``held``.
    """
    nodes = materialise(held.select("node").distinct(), "near-nodes")
    inside = sets.join(nodes, "node", "left_semi")
    each = inside.select(F.xxhash64("node").alias("at"), F.explode("set").alias("shingle"))
    several = each.groupBy("shingle").agg(F.min("at").alias("one"), F.max("at").alias("other")).where("one <> other").select("shingle")
    counts = each.join(materialise(several, "near-shingles"), "shingle", "left_semi").groupBy("at").agg(F.count(F.lit(1)).alias("n"))
    kept = inside.select("node", "size", F.xxhash64("node").alias("at")).join(counts, "at", "left")
    kept = kept.where(F.coalesce("n", F.lit(0)) * OF >= F.col("size") * SIMILAR).select("node")
    kept = materialise(kept, "near-nodes")
    return held.join(materialise(outlines(inside.join(kept, "node", "left_semi")), "near-outlines"), "node")


def labelled(links: DataFrame, texts: DataFrame) -> DataFrame:
    """(node, label) of the texts that links connect."""
    linked = links.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    label = F.struct(F.coalesce("least", F.lit(simhash.NO_ID)).alias("least"), "node")
    return components(links, texts.join(linked, "node", "left_semi").select("node", label.alias("label")))


def classes(texts: DataFrame, rows: DataFrame) -> DataFrame:
    """(node, label): the component of each text that has a near copy.

    First all texts of a key are compared with one of them. Where that leaves several components, those outside the
    largest are compared with another text of it, ``TURNS`` times, so the near copies of one text cost about as
    much as their number. Texts that are still apart, and have too many shingles of their own to be similar to
    any, need no comparison; the others meet pair by pair, but for pairs within the largest component of a key, and are
    compared if their outlines allow it. Nothing is left out.
    """
    every = texts.select(F.explode("keys").alias("key"), "node", "size")
    first = F.min(F.struct("node", "size"))
    shared = materialise(every.groupBy("key").agg(F.count(F.lit(1)).alias("n"), first.alias("first")).where("n > 1").select("key", "first"), "near-keys")
    held = materialise(every.join(shared, "key"), "near-members")
    sets = shingle_sets(texts.join(held.select("node").distinct(), "node", "left_semi"), rows)
    star = held.where((F.col("node") > F.col("first.node")) & could_be(F.col("size"), F.col("first.size")))
    links = confirmed(star.select(F.col("first.node").alias("a"), F.col("node").alias("b")).distinct(), sets)
    held = unsettled(held, links, texts)
    one = [F.col("node").alias("one"), F.col("size").alias("one_size"), F.col("root").alias("one_root")]
    pair = [F.least("node", "one").alias("a"), F.greatest("node", "one").alias("b")]
    for turn in range(TURNS):
        if held.isEmpty():
            return labelled(links, texts)
        order = F.xxhash64("node", F.lit(turn))
        others = held.where("root = largest").groupBy("key").agg(F.min_by(F.struct("node", "size"), order).alias("other"))
        star = held.where("root <> largest").join(others.select("key", F.col("other.node").alias("one"), F.col("other.size").alias("one_size")), "key")
        more = confirmed(star.where(could_be(F.col("size"), F.col("one_size"))).select(*pair).distinct(), sets)
        links = materialise(links.unionByName(more), "near-links")
        held = unsettled(held, links, texts)
    held = materialise(can_be_similar(held, sets), "near-members")
    few = held.where("root <> largest").select("key", *one, F.col("outline").alias("one_outline"))
    alike = could_be(F.col("size"), F.col("one_size")) & outlines_near("outline", "one_outline", F.col("size") + F.col("one_size"))
    rest = held.join(few, "key").where((F.col("root") != F.col("one_root")) & alike)
    more = confirmed(rest.select(*pair).distinct(), sets)
    return labelled(materialise(links.unionByName(more), "near-links"), texts)


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each component of equal texts and near copies, that with the least id, with the columns of ``docs``.

    Texts that are null, empty or without words are one component. Where several rows have the least id (or the component has none)
    any one of them stays. An empty table gives an empty table.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), digest(text_col).alias("node"), F.col(text_col).alias("text"))
    hashed = mapped(rows.select("id", "node", F.col("text").cast("binary").alias("text")), keys, "keys")
    texts = hashed.groupBy("node").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("copies"), F.first("size").alias("size"), F.first("keys").alias("keys"))
    texts = materialise(texts, "near-texts")
    state = classes(texts, rows).select(F.col("node").alias("__node"), "label")
    found = texts.select(F.col("node").alias("__node"), "least", "copies").join(state, "__node", "left").where("copies > 1 OR label IS NOT NULL")
    least = F.when(F.col("label").isNull(), F.col("least")).otherwise(F.nullif("label.least", F.lit(simhash.NO_ID)))
    found = materialise(found.select("__node", F.coalesce("label.node", "__node").alias("__root"), least.alias("__least")), "near-classes")
    chosen = docs.withColumn("__node", digest(text_col)).join(found, "__node", "left").where(F.col("__root").isNull() | F.col(id_col).cast("long").eqNullSafe(F.col("__least")))
    again = chosen.where("__root IS NOT NULL").groupBy("__root").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("__root")
    again = materialise(again, "near-again")
    return chosen.join(again, "__root", "left_anti").select(*docs.columns).unionByName(
        chosen.join(again, "__root", "left_semi").dropDuplicates(["__root"]).select(*docs.columns))
