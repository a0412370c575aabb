"""Benchmark decontamination by Wu-Manber search for many word windows at once."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mentionlake.llm.common import chunks
from mentionlake.session import ship_package

WINDOW = 13
#: A block of test strings is searched in one pass; more strings take more passes, so what is sent to the executors is bounded.
BLOCK_WINDOWS = 100_000
PIECE_BYTES = 4 << 20
#: Words that are searched together, and the stretch that one scan position covers.
BATCH_WORDS, LANE = 1 << 21, 256
#: Digits, letters a to z and all non-ASCII bytes stay, A to Z are lowered, the rest are blanks.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


class Group(NamedTuple):
    """Test strings of one length, sorted by the hash of their last block."""

    length: int
    block: int
    strings: np.ndarray  # one row of word numbers each
    shift: np.ndarray  # by block hash: how far the end of the window can move on
    bucket: np.ndarray  # by block hash: first string of the bucket; one more entry at the end
    first_item: np.ndarray  # by string: where its items begin in ``items``
    items: np.ndarray


class Search(NamedTuple):
    vocabulary: dict[bytes, int]
    names: list[str]
    groups: list[Group]


def words_of(text: bytes) -> Iterator[list[bytes]]:
    for piece in chunks(text.translate(FOLD), PIECE_BYTES):
        yield piece.split()


def hashed(before: np.ndarray, last: np.ndarray, size: int) -> np.ndarray:
    mixed = before.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + last.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    return (mixed >> np.uint64(40)).astype(np.int64) & (size - 1)


def block_hash(ids: np.ndarray, end: np.ndarray, block: int, size: int) -> np.ndarray:
    return hashed(ids[end - 1] if block == 2 else np.zeros(len(end), np.int32), ids[end], size)


def prepare(items: list[tuple[str, bytes]]) -> Search:
    """Shift tables and buckets for the windows of some items."""
    vocabulary: dict[bytes, int] = {}
    windows: dict[int, dict[tuple[int, ...], set[int]]] = {}
    for number, (_, text) in enumerate(items):
        ids = [vocabulary.setdefault(w, len(vocabulary) + 1) for part in words_of(text) for w in part]
        length = min(WINDOW, len(ids))
        for i in range(len(ids) - length + 1 if ids else 0):
            windows.setdefault(length, {}).setdefault(tuple(ids[i : i + length]), set()).add(number)
    groups = []
    for length, found in sorted(windows.items()):
        block = min(2, length)
        strings = np.array(list(found), np.int32)
        owners = [sorted(x) for x in found.values()]
        size = 1 << max(8, (4 * strings.size).bit_length())
        shift = np.full(size, length - block + 1, np.int16)
        flat, starts = strings.ravel(), np.arange(len(strings)) * length
        for end in range(block - 1, length):
            np.minimum.at(shift, block_hash(flat, starts + end, block, size), np.int16(length - 1 - end))
        last = block_hash(flat, starts + length - 1, block, size)
        order = np.argsort(last, kind="stable")
        bucket = np.searchsorted(last[order], np.arange(size + 1))
        owners = [owners[i] for i in order]
        first = np.cumsum([0, *map(len, owners)])
        groups.append(Group(length, block, strings[order], shift, bucket, first, np.array([x for y in owners for x in y], np.int64)))
    return Search(vocabulary, [name for name, _ in items], groups)


def occurrences(ids: np.ndarray, group: Group) -> tuple[np.ndarray, np.ndarray]:
    """End positions and string numbers of all occurrences in ``ids``.

    Many stretches of the text are scanned side by side, each with a position of its own: the shift of the
    block that ends there moves it on, past every place where no test string can end.
    """
    m, size = group.length, len(group.shift)
    at = np.arange(0, len(ids), LANE)
    stop = np.minimum(at + LANE, len(ids))
    at = np.maximum(at, m - 1)
    ends, strings = [], []
    while len(at):
        alive = at < stop
        at, stop = at[alive], stop[alive]
        if not len(at):
            break
        h = block_hash(ids, at, group.block, size)
        step = group.shift[h]
        here = step == 0
        if here.any():
            place, low = at[here], group.bucket[h[here]]
            count = group.bucket[h[here] + 1] - low
            place, low = np.repeat(place, count), np.repeat(low, count)
            number = low + np.arange(len(low)) - np.repeat(np.cumsum(count) - count, count)
            same = ids[place - m + 1] == group.strings[number, 0]
            place, number = place[same], number[same]
            same = (ids[place[:, None] + np.arange(1 - m, 1)] == group.strings[number]).all(axis=1)
            ends.append(place[same])
            strings.append(number[same])
        at = at + np.maximum(step, 1)
    if not ends:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(ends), np.concatenate(strings)


def scan(texts: list[bytes | None], search: Search) -> Iterator[tuple[int, list[tuple[int, int]], list[str]]]:
    """For each text its number of words, the hit stretches of words, and the items that occur."""
    waiting: list[np.ndarray] = []
    total = 0
    for text in texts:
        get = search.vocabulary.get
        parts = [np.fromiter(map(get, words, repeat(0)), np.int32, len(words)) for words in words_of(text or b"")]
        waiting.append(np.concatenate(parts) if parts else np.zeros(0, np.int32))
        total += len(waiting[-1])
        if total >= BATCH_WORDS:
            yield from _scanned(waiting, search)
            waiting, total = [], 0
    if waiting:
        yield from _scanned(waiting, search)


def _scanned(texts: list[np.ndarray], search: Search) -> Iterator[tuple[int, list[tuple[int, int]], list[str]]]:
    # Number 0 is no word of any test string; one stands between texts, so nothing matches across them.
    gap = np.zeros(1, np.int32)
    ids = np.concatenate([x for text in texts for x in (text, gap)])
    starts = np.cumsum([0, *(len(t) + 1 for t in texts)])
    edges = np.zeros(len(ids) + 1, np.int32)
    owned: dict[int, set[int]] = {}
    for group in search.groups:
        ends, strings = occurrences(ids, group)
        np.add.at(edges, ends - group.length + 1, 1)
        np.add.at(edges, ends + 1, -1)
        text = np.searchsorted(starts, ends, side="right") - 1
        for t, s in np.unique(np.stack([text, strings]), axis=1).T.tolist():
            owned.setdefault(t, set()).update(group.items[group.first_item[s] : group.first_item[s + 1]].tolist())
    hit = np.concatenate([[0], (np.cumsum(edges[:-1]) > 0).astype(np.int8), [0]])
    turns = np.flatnonzero(np.diff(hit)).reshape(-1, 2)
    low = np.searchsorted(turns[:, 0], starts)
    for t, text in enumerate(texts):
        spans = [(int(a - starts[t]), int(b - starts[t])) for a, b in turns[low[t] : low[t + 1]]]
        yield len(text), spans, [search.names[i] for i in owned.get(t, ())]


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def blocks(benchmark: DataFrame, id_col: str, text_col: str) -> Iterator[Search]:
    """The items in blocks of at most ``BLOCK_WINDOWS`` windows, or one item; read one partition at a time."""
    waiting: list[tuple[str, bytes]] = []
    windows = 0
    rows = benchmark.select(F.col(id_col).cast("string").alias("i"), F.col(text_col).cast("binary").alias("t")).dropna()
    for row in rows.toLocalIterator():
        text = bytes(row.t)
        size = sum(map(len, words_of(text)))
        if waiting and windows + size > BLOCK_WINDOWS:
            yield prepare(waiting)
            waiting, windows = [], 0
        waiting.append((row.i, text))
        windows += size
    yield prepare(waiting)


def contamination(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text: str = "text", keep: list[str] | None = None,
) -> DataFrame:
    """Add ``n_words``, ``spans`` (stretches of hit words: first and one past the last) and ``items`` to each document.

    Texts are searched where they are: nothing is shuffled, and rows keep their order. ``keep`` names the columns
    that are returned (default all). Text that is null or has no words has no hits. Items without an id or
    without words are ignored; items that share an id count once. Repeated rows each get their own
    result. Columns of the input named like the added ones are replaced. Texts may have any length.
    """
    ship_package(docs.sparkSession)
    docs = docs.drop("n_words", "spans", "items")
    keep = docs.columns if keep is None else keep
    span = T.StructType([T.StructField("first", T.LongType()), T.StructField("end", T.LongType())])
    added = [T.StructField("n_words", T.LongType()), T.StructField("spans", T.ArrayType(span)), T.StructField("items", T.ArrayType(T.StringType()))]
    searches = list(blocks(benchmark, item_col, item_text))
    out = docs.withColumn("__text", F.col(text_col).cast("binary")).select(*keep, "__text")
    for number, search in enumerate(searches):
        last = number == len(searches) - 1
        shared = docs.sparkSession.sparkContext.broadcast(search)
        fields = [f for f in out.schema.fields if f.name in keep or f.name == "__text" and not last]
        out = out.mapInArrow(_pass(shared, [f.name for f in fields]), T.StructType(fields + added))
    return out


def _pass(shared, kept: list[str]):
    arrow_span = pa.struct([("first", pa.int64()), ("end", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("__text")).to_pylist()
            n_words, spans, items = [], [], []
            for n, s, i in scan(texts, shared.value):
                n_words.append(n)
                spans.append(s)
                items.append(i)
            if "items" in batch.schema.names:  # of the blocks before
                spans = [merged([*s, *((x["first"], x["end"]) for x in old)]) for s, old in zip(spans, batch.column("spans").to_pylist(), strict=True)]
                items = [[*i, *old] for i, old in zip(items, batch.column("items").to_pylist(), strict=True)]
            spans = [[{"first": a, "end": b} for a, b in s] for s in spans]
            columns = [batch.column(c) for c in kept]
            columns += [pa.array(n_words, pa.int64()), pa.array(spans, pa.list_(arrow_span)), pa.array([sorted(set(i)) for i in items], pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, "n_words", "spans", "items"])

    return run


def n_hit() -> Column:
    return F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["first"])


def contaminated() -> Column:
    """At least a twentieth of the words are hit."""
    return (n_hit() > 0) & (n_hit() * 20 >= F.col("n_words"))
