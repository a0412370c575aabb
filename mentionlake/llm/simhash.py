"""SimHash near-duplicates: fingerprints that differ in at most two bits, found by Golay-code keys."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh64_intdigest

from mentionlake.llm import golay
from mentionlake.llm.common import chunks
from mentionlake.llm.graph import components
from mentionlake.session import materialise, ship_package

SHINGLE, SEED, BITS, DISTANCE = 3, 42, 64, 2
#: Width and shift of the segments of a fingerprint; one bit fewer than a Golay word at least.
SEGMENTS = ((22, 0), (21, 22), (21, 43))
#: Pairs are compared within keys of up to this many fingerprints; others are linked by their neighbours.
BUCKET = 64
PIECE_BYTES = 1 << 20
BLANKS = bytes(32 if c == 32 or 9 <= c <= 13 else c for c in range(256))
#: Stands for no id when ids are compared.
NO_ID = (1 << 63) - 1


def shingle_hashes(text: bytes, width: int = SHINGLE) -> Iterator[np.ndarray]:
    """XXH64 of all shingles of ``width`` words; texts are taken in pieces that share the words at their borders."""
    before: list[bytes] = []
    seen = 0
    for piece in chunks(text.lower().translate(BLANKS), PIECE_BYTES):
        words = before + piece.split()
        if len(words) >= width:
            joined = b" ".join(words)
            starts = list(accumulate((len(w) + 1 for w in words), initial=0))
            shingles = zip(starts, starts[width:], strict=False)
            yield np.fromiter((xxh64_intdigest(joined[a : b - 1], SEED) for a, b in shingles), np.uint64, len(words) - width + 1)
            seen += 1
        before = words[1 - width :] if len(words) >= width else words
    if not seen and before:
        yield np.array([xxh64_intdigest(b" ".join(before), SEED)], np.uint64)


def fingerprint(text: bytes | None) -> int:
    """The SimHash as a signed number; zero for a text without words."""
    return fingerprint_of(shingle_hashes(text or b""))


def fingerprint_of(pieces: Iterable[np.ndarray]) -> int:
    """The SimHash of hashes."""
    ones, total = np.zeros(BITS, np.int64), 0
    for hashes in pieces:
        ones += np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        total += len(hashes)
    bits = np.packbits(ones * 2 > total, bitorder="little")
    return int(bits.view("<i8")[0])


def with_fingerprint(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (default all) and ``fp``, the fingerprint as a long."""
    ship_package(docs.sparkSession)
    docs = docs.drop("fp")
    keep = docs.columns if keep is None else keep
    kept = [f for f in docs.schema.fields if f.name in keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            last = batch.num_columns - 1
            prints = pa.array([fingerprint(t.as_py()) for t in batch.column(last)], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:last], prints], names=[*batch.schema.names[:last], "fp"])

    return docs.select(*[f.name for f in kept], F.col(text_col).cast("binary").alias("__text")).mapInArrow(
        run, T.StructType([*kept, T.StructField("fp", T.LongType())]))


def segment_keys(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The keys of all fingerprints, and the position of the one that each is for. Two bits in three segments leave one segment
    untouched, and the one after it is off by two at most, so it shares a codeword number: a key is an exact segment with such a number of the next."""
    parts = [(fp.view(np.uint64) >> np.uint64(shift)).astype(np.int64) & (1 << width) - 1 for width, shift in SEGMENTS]
    found, positions = [], []
    for kind, exact in enumerate(parts):
        number, of = golay.indices(parts[(kind + 1) % len(parts)])
        found.append(kind << 40 | exact[of] << golay.MESSAGE | number.astype(np.int64))
        positions.append(of)
    return np.concatenate(found), np.concatenate(positions)


def golay_keys(prints: DataFrame) -> DataFrame:
    """(key, fp)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            key, of = segment_keys(fp)
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(fp[of])], names=["key", "fp"])

    return prints.select("fp").mapInArrow(run, "key long, fp long")


def near(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b)) <= DISTANCE


def links(prints: DataFrame) -> DataFrame:
    """(a, b): pairs of distinct fingerprints at most two bits apart, enough to connect all that are.

    Keys are counted first, each task on its own rows. Fingerprints that share a key of ordinary size are compared with
    each other. Those in a larger one (many variants of one text) are looked up by neighbours instead: two
    fingerprints two bits apart both lie within one bit of a third, and at most 65 lie within one bit of
    any, so each such group is small, all in it are linked, and a star connects it. Nothing is left out either way.
    """
    keys = golay_keys(prints)
    shared = materialise(keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "simhash-keys")
    few = keys.join(shared.where(F.col("n") <= BUCKET).select("key"), "key").groupBy("key").agg(F.collect_list("fp").alias("fps"))
    pairs = F.transform("fps", lambda a: F.transform(F.filter("fps", lambda b: (a < b) & near(a, b)), lambda b: F.struct(a.alias("a"), b.alias("b"))))
    compared = few.select(F.explode(F.flatten(pairs)).alias("p")).select("p.a", "p.b")
    many = keys.join(shared.where(F.col("n") > BUCKET).select("key"), "key", "left_semi").select("fp").distinct()
    one = F.lit(1).cast("long")
    around = F.concat(F.array("fp"), F.transform(F.sequence(F.lit(0), F.lit(BITS - 1)), lambda i: F.col("fp").bitwiseXOR(F.call_function("shiftleft", one, i))))
    groups = many.select("fp", F.explode(around).alias("middle")).groupBy("middle").agg(F.collect_set("fp").alias("fps"))
    star = groups.where(F.size("fps") > 1).select(F.array_min("fps").alias("a"), F.explode("fps").alias("b")).where("a <> b")
    return compared.unionByName(star).distinct()


def classes(prints: DataFrame) -> DataFrame:
    """(fp, root, component_id) for fingerprints that several rows have or that are linked; ``prints``: (doc_id, fp)."""
    distinct = prints.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n"))
    distinct = materialise(distinct, "simhash-distinct")
    edges = materialise(links(distinct), "simhash-links")
    linked = edges.select(F.explode(F.array("a", "b")).alias("fp")).distinct()
    label = F.struct(F.coalesce("least", F.lit(NO_ID)).alias("least"), F.col("fp").alias("node"))
    state = components(edges, distinct.join(linked, "fp", "left_semi").select(F.col("fp").alias("node"), label.alias("label")))
    found = distinct.join(state.withColumnRenamed("node", "fp"), "fp", "left").where("n > 1 OR label IS NOT NULL")
    least = F.when(F.col("label").isNull(), F.col("least")).otherwise(F.nullif("label.least", F.lit(NO_ID)))
    return materialise(found.select("fp", F.coalesce("label.node", "fp").alias("root"), least.alias("component_id")), "simhash-classes")


def marked(rows: DataFrame, found: DataFrame, id_col: str) -> DataFrame:
    """Rows with their ``fp`` and, from ``classes``, ``fingerprint``, ``component_id`` and ``root``."""
    return rows.join(found, "fp", "left").select(
        *[c for c in rows.columns if c != "fp"], F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.when(F.col("root").isNull(), F.col(id_col)).otherwise(F.col("component_id")).alias("component_id"), F.coalesce("root", "fp").alias("root"))


def prints_of(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return materialise(with_fingerprint(narrow, keep=["doc_id"]), "simhash-prints")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: its id, ``fingerprint`` (16 hex digits), ``component_id`` and ``root`` (one number per component).

    Texts that are null, empty or without words have fingerprint zero, which links like any other. Ids that are null are
    never the least; a component of such rows only has no id, but has a root. Repeated rows get the same result.
    An empty table gives an empty table. Further columns are ignored.
    """
    prints = prints_of(docs, id_col, text_col)
    return marked(prints, classes(prints), "doc_id").withColumnRenamed("doc_id", id_col)


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each component, that with the least id, with the columns of ``docs``.

    Where several rows have that id (or the component has none) any one of them stays.
    """
    columns = docs.columns
    prints = prints_of(docs, id_col, text_col)
    found = classes(prints)
    least = F.col(id_col).eqNullSafe(F.col("component_id"))
    kept = marked(prints.withColumnRenamed("doc_id", id_col), found, id_col).where(least)
    again = materialise(kept.groupBy("root").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("root"), "simhash-again")
    first = marked(with_fingerprint(docs.drop("fp", "fingerprint", "component_id", "root"), text_col), found, id_col).where(least)
    kept_columns = [c for c in columns if c in first.columns]
    return first.join(again, "root", "left_anti").select(*kept_columns).unionByName(
        first.join(again, "root", "left_semi").dropDuplicates(["root"]).select(*kept_columns))
