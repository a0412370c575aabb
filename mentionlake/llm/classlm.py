"""A class-based bigram model: P(word | before) = P(class | class before) P(word | class), with classes found by exchange.

Texts are split once into chunks of word numbers; a chunk holds texts to learn from or held-out ones, so that rounds leave out the latter. Words are exchanged between classes in rounds: each takes a share of the words in turn, gathers the
classes on their left and right in all training texts, and moves each word where the likelihood of class bigrams gains most. Words of one share only move at
once, so that they do not chase each other, and fewer after a round that lowered the likelihood, which is undone. Words below a frequency that keeps the table of classes small form one class of their own; each of them has its count, which a join brings.

Emissions are discounted, and a class gives what it saves to words never seen, so the probabilities of all known words and of one unknown word sum to
one. After an unknown word the model goes on as after rare words. Transitions are drawn towards the frequencies of classes.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from mentionlake.llm.common import crc_of_id
from mentionlake.llm.phrases import numbered
from mentionlake.llm.simhash import BLANKS
from mentionlake.session import Save, batches_of, materialise, ship_package, staging

#: Class 0 is the end of a text, the last one that of the words outside the exchange.
CLASSES, ROUNDS = 64, 8
END, TAIL, UNKNOWN = 0, CLASSES - 1, CLASSES
#: So many words take part in the exchange at most: those that occur a power of two of times or more.
HEAD = 1 << 20
#: Weight of the frequencies of classes in each transition.
PRIOR = 64.0
CHUNK_BYTES = 4 << 20
#: One of so many words may move in a round of the exchange, in turn. Its neighbours are counted in all texts.
SHARES = 2
#: What an entry adds to the likelihood is looked up for counts below this.
SMALL = 16
#: Keys, of four bytes, that a task holds before it counts them and hands them on.
HELD_KEYS = 1 << 22
#: Keys, rows or entries that are worked on or handed on at once.
PIECE = 1 << 15
#: Bytes that a Python task is sent at once, unless one row is larger.
BATCH_BYTES = 2 << 20
#: Words, in bytes, that a task holds before it adds up their counts.
HELD_BYTES = 16 << 20
#: The seed of Spark's ``xxhash64``.
SEED = 42
#: Widths of counts, in bytes.
WIDTHS = {1: np.uint8, 2: np.uint16, 8: np.uint64}


def chunks(docs: DataFrame, id_col: str, text_col: str, held: Column) -> DataFrame:
    """About ``CHUNK_BYTES`` of texts that are all held out or all not: their ids, distinct words (with spaces between them, which no word has), how often each
    occurs, and all words in order (-1 is an end). Words and numbers are one value each, which the JVM hands on whole."""
    ship_package(docs.sparkSession)
    id_type = docs.schema[id_col].dataType.simpleString()
    schema = f"chunk long, ids array<{id_type}>, held boolean, words binary, counts binary, codes binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, made, kind = TaskContext.get().partitionId() << 32, 0, pa.int64()
        ids, texts, sizes = ([], []), ([], []), [0, 0]

        def close(h: bool) -> pa.RecordBatch:
            nonlocal made
            words, codes = numbered(b"".join(t + b" \n " for t in texts[h]))
            counts = np.bincount(codes[codes >= 0], minlength=len(words))
            made += 1
            row = {
                "chunk": pa.array([base + made]), "ids": pa.array([ids[h]], pa.list_(kind)), "held": pa.array([bool(h)]), "words": joined(words),
                "counts": pa.array([counts.tobytes()], pa.binary()), "codes": pa.array([codes.tobytes()], pa.binary()),
            }
            ids[h].clear(), texts[h].clear()
            sizes[h] = 0
            return pa.RecordBatch.from_arrays(list(row.values()), names=list(row))

        for batch in batches:
            kind = batch.column(0).type
            for i, h, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                text = (t.as_py() or b"").lower().translate(BLANKS)
                ids[h].append(i), texts[h].append(text)
                sizes[h] += len(text) + 3
                if sizes[h] >= CHUNK_BYTES:
                    yield close(h)
        for h in (False, True):
            if ids[h]:
                yield close(h)
        release()

    return docs.select(F.col(id_col), held.alias("held"), F.col(text_col).cast("binary").alias("text")).mapInArrow(run, schema)


def release() -> None:
    """Give back what Arrow keeps for later: the worker goes on to other tasks, beside the heap of the JVM."""
    pa.default_memory_pool().release_unused()


def joined(words: pa.Array) -> pa.Array:
    """One value: words with spaces between them."""
    return pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words), b" ")


def separate(words: bytes) -> pa.Array:
    """The words of ``joined``."""
    return pc.split_pattern(pa.array([words] if words else [], pa.binary()), b" ").flatten()


def vocabulary(found: DataFrame, save: Save) -> DataFrame:
    """(word, c, h): words of the training texts and the end (the empty word), how often they occur, and their XXH64."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size, held = 0, []

        def rows() -> list[pa.RecordBatch]:
            nonlocal size
            size, whole = 0, pa.Table.from_batches(held)
            held.clear()
            return whole.group_by("word", use_threads=False).aggregate([("c", "sum")]).rename_columns(["word", "c"]).to_batches(PIECE)

        for batch in batches:
            for row in rows_of(batch):
                words, counts = row["words"].as_py(), np.frombuffer(row["counts"].as_py(), np.int64)
                held.append(pa.RecordBatch.from_arrays([separate(words), pa.array(counts)], names=["word", "c"]))
                held.append(pa.RecordBatch.from_arrays([pa.array([b""], pa.binary()), pa.array([row["texts"].as_py()], pa.int64())], names=["word", "c"]))
                size += len(words)
                if size >= HELD_BYTES:
                    yield from rows()
        if held:
            yield from rows()
        release()

    each = found.where("not held").select("words", "counts", F.size("ids").cast("long").alias("texts")).mapInArrow(run, "word binary, c long")
    return save(each.groupBy("word").agg(F.sum("c").alias("c")).withColumn("h", F.xxhash64("word")), "words")


class Head(NamedTuple):
    """The words of the exchange, 16 MB at most: hashes in order (a word's number is its place), counts, and whether a word is rare."""

    hashes: np.ndarray
    counts: np.ndarray
    rare: np.ndarray

    def numbers(self, h: np.ndarray) -> np.ndarray:
        """Of words by their hashes; -1 for those that are not here."""
        # In order, so that one search is near the last.
        order = np.argsort(h)
        at = np.empty(len(h), np.int64)
        at[order] = np.searchsorted(self.hashes, h[order])
        at[at == len(self.hashes)] = 0
        return np.where(self.hashes[at] == h, at, -1) if len(self.hashes) else np.full(len(h), -1)


def exchanged(words: DataFrame) -> tuple[Head, int]:
    """The words that occur ``least`` times or more, and ``least``: the least power of two for which ``HEAD`` words at most do."""
    words = words.where(F.col("word") != b"")
    over = words.agg(*[F.count(F.when(F.col("c") >= 1 << i, 1)).alias(str(i)) for i in range(60)]).first()
    least = 1 << next((i for i in range(60) if over[i] <= HEAD), 60)
    rows = words.where(F.col("c") >= least).select("h", "c").toArrow()
    order = np.argsort(rows["h"].to_numpy())
    counts = rows["c"].to_numpy()[order]
    return Head(rows["h"].to_numpy()[order], counts, counts == 1), least


def coded(found: DataFrame, head: Head) -> DataFrame:
    """(chunk, ids, held, codes, tail): words by their numbers in the exchange, -1 for an end, other words by -2 less their places in ``tail``."""
    shared = found.sparkSession.sparkContext.broadcast(head)
    fields = found.select("chunk", "ids", "held").schema.fields

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, tails = [], []
            for row in rows_of(batch):
                words = row["words"].as_py().split(b" ") if row["words"].as_py() else []
                number = shared.value.numbers(hashes(words))
                outside = np.flatnonzero(number < 0)
                number[outside] = -2 - np.arange(len(outside))
                codes.append(np.append(number, -1).astype(np.int32)[np.frombuffer(row["codes"].as_py(), np.int32)].tobytes())
                tails.append(b" ".join([words[i] for i in outside.tolist()]))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(codes, pa.binary()), pa.array(tails, pa.binary())], names=["chunk", "ids", "held", "codes", "tail"])
        release()

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fields) + ", codes binary, tail binary"
    return found.select("chunk", "ids", "held", "words", "codes").mapInArrow(run, schema)


def hashes(words: list[bytes]) -> np.ndarray:
    """As Spark's ``xxhash64`` of each."""
    return np.fromiter((xxh64_intdigest(w, SEED) for w in words), np.uint64, len(words)).view(np.int64)


def by_token(codes: np.ndarray, values: np.ndarray, end: int) -> np.ndarray:
    """By token: the value of its word. ``values`` begins with that of the words outside the exchange."""
    found = values.take(codes + 1, mode="clip")
    found[codes == -1] = end
    return found


def codes_of(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """The numbers of each row of ``coded``."""
    for batch in batches:
        for row in rows_of(batch):
            yield np.frombuffer(row["codes"].as_py(), np.int32)


def rows_of(batch: pa.RecordBatch) -> Iterator[dict]:
    for i in range(batch.num_rows):
        yield {n: batch.column(j)[i] for j, n in enumerate(batch.schema.names)}


def bigrams(found: DataFrame, head: np.ndarray, rare: np.ndarray) -> np.ndarray:
    """How often class follows class in the training texts (row: before). The last row is after words of the tail and rare words."""
    # The class, and that many more if what comes after the word counts in the last row too.
    shared = found.sparkSession.sparkContext.broadcast(np.append(TAIL + CLASSES, head + CLASSES * rare).astype(np.uint8))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(2 * CLASSES * CLASSES, np.int64)
        for codes in codes_of(batches):
            here = by_token(codes, shared.value, END)
            # A text begins after an end.
            at = np.append(np.uint8(END), here[:-1]).astype(np.uint16) * CLASSES + here % CLASSES
            total += np.bincount(at, minlength=len(total))
        plain, unsure = total.reshape(2, CLASSES, CLASSES)
        total = np.concatenate([plain + unsure, unsure.sum(axis=0, keepdims=True)]).ravel()
        filled = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(filled, pa.int64()), pa.array(total[filled], pa.int64())], names=["at", "n"])

    # At most one row for each pair of classes comes to the driver.
    rows = found.where("not held").select("codes").mapInArrow(run, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).collect()
    out = np.zeros((CLASSES + 1) * CLASSES, np.float64)
    for r in rows:
        out[r["at"]] = r["n"]
    return out.reshape(CLASSES + 1, CLASSES)


def entropy_terms(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1.0))


def likelihood(counts: np.ndarray) -> float:
    """Of class bigrams; what depends on words alone is left out."""
    m = counts[:CLASSES]
    return float(entropy_terms(m).sum() - entropy_terms(m.sum(axis=1)).sum() - entropy_terms(m.sum(axis=0)).sum())


def best_classes(counts: np.ndarray, word: np.ndarray, slot: np.ndarray, n: np.ndarray, now: np.ndarray) -> np.ndarray:
    """The class of each word for which the likelihood is greatest once the word is taken out of its own, ``now``.

    ``word`` numbers the words from 0 in order; a slot is a class on the left, or that many and a class on the right."""
    m = counts[:CLASSES]
    both = np.concatenate([m, m.T])
    done = entropy_terms(both)
    n = n.astype(np.float64)
    # Most counts are small: what they add to a class and a slot is worked out once.
    small = np.stack([entropy_terms(both + k) - done for k in range(SMALL)]).reshape(SMALL * 2 * CLASSES, CLASSES)
    out = small[np.minimum(n, SMALL - 1).astype(np.int64) * 2 * CLASSES + slot]
    large = np.flatnonzero(n >= SMALL)
    out[large] = entropy_terms(both[slot[large]] + n[large, None]) - done[slot[large]]
    of = now[word]
    each = np.arange(len(of))
    own = both[slot, of]
    out[each, of] = entropy_terms(own) - entropy_terms(np.maximum(own - n, 0))
    starts = np.searchsorted(word, np.arange(len(now)))
    gain = np.add.reduceat(out, starts, axis=0)
    for side, size in ((slot < CLASSES, m.sum(axis=0)), (slot >= CLASSES, m.sum(axis=1))):
        c = np.bincount(word[side], weights=n[side], minlength=len(now))
        term = entropy_terms(size[None, :] + c[:, None]) - entropy_terms(size)[None, :]
        own = size[now]
        term[np.arange(len(now)), now] = entropy_terms(own) - entropy_terms(np.maximum(own - c, 0))
        gain -= term
    gain[:, [END, TAIL]] = -np.inf
    return gain.argmax(axis=1)


def packed(words: np.ndarray, slots: np.ndarray, n: np.ndarray) -> Iterator[tuple[np.ndarray, pa.Array, pa.Array]]:
    """Words, in order, with their slots and counts as bytes: one row for each word, counts as wide as its largest needs."""
    starts = np.flatnonzero(np.append(True, words[1:] != words[:-1])) if len(words) else np.zeros(0, np.int64)
    lengths = np.diff(np.append(starts, len(words)))
    largest = np.maximum.reduceat(n, starts) if len(starts) else n
    below = 0
    for width, kind in WIDTHS.items():
        which = (largest > below) & (largest <= np.iinfo(kind).max)
        below = np.iinfo(kind).max
        inside = np.repeat(which, lengths)

        def binary(values: np.ndarray, size: int, of: np.ndarray) -> pa.Array:
            offsets = np.append(0, np.cumsum(of * size)).astype(np.int32)
            return pa.Array.from_buffers(pa.binary(), len(of), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))])

        of = lengths[which]
        if len(of):
            yield words[starts[which]], binary(slots[inside].astype(np.uint8), 1, of), binary(n[inside].astype(kind), width, of)


def unpacked(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The number of the row, the slot and the count of each entry."""
    (slots, of_slots), (counts, of_counts) = _bytes_of(table["slots"]), _bytes_of(table["counts"])
    widths = of_counts // of_slots
    found = []
    for width, kind in WIDTHS.items():
        here = widths == width
        n = counts[np.repeat(here, of_counts)].view(kind).astype(np.int64)
        found.append((np.repeat(np.flatnonzero(here), of_slots[here]), slots[np.repeat(here, of_slots)], n))
    return tuple(np.concatenate(x).astype(np.int64) for x in zip(*found, strict=True))


def _bytes_of(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all values of a binary column, and how many each value has."""
    values = pa.concat_arrays([c.cast(pa.binary()) for c in column.chunks]) if column.num_chunks else pa.array([], pa.binary())
    _, ends, data = values.buffers()
    ends = np.frombuffer(ends, np.int32)[values.offset : values.offset + len(values) + 1] if len(values) else np.zeros(1, np.int32)
    data = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, np.diff(ends).astype(np.int64)


def pieces(keys: np.ndarray, width: int, size: int) -> Iterator[np.ndarray]:
    """Sorted keys, about ``size`` at a time, cut where the word (``width`` keys) changes."""
    at = 0
    while at < len(keys):
        last = keys[min(at + size, len(keys)) - 1] // width
        end = at + np.searchsorted(keys[at:], (last + 1) * width)
        yield keys[at:end]
        at = end


def movable(words: np.ndarray, turn: int, every: int) -> np.ndarray:
    """Which words, by number, may move in a round."""
    return (words + turn) % every == 0


def neighbours(found: DataFrame, head: np.ndarray, turn: int, every: int) -> DataFrame:
    """(word, slots, counts): how often the classes occur in the training texts beside each word that may move in this round."""
    shared = found.sparkSession.sparkContext.broadcast(np.append(TAIL, head).astype(np.uint8))
    # A key of a word and a slot is below 2^27.
    width = 2 * CLASSES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def rows() -> Iterator[pa.RecordBatch]:
            keys = np.concatenate(held)
            held.clear()
            keys.sort()
            for piece in pieces(keys, width, PIECE):
                starts = np.flatnonzero(np.append(True, piece[1:] != piece[:-1]))
                n = np.diff(np.append(starts, len(piece)))
                piece = piece[starts]
                for word, slots, counts in packed(piece // width, piece % width, n):
                    yield pa.RecordBatch.from_arrays([pa.array(word, pa.int64()), slots, counts], names=["word", "slots", "counts"])

        for codes in codes_of(batches):
            here = by_token(codes, shared.value, END)
            t = np.flatnonzero((codes >= 0) & movable(codes, turn, every))
            word = codes[t].astype(np.uint32) * width
            # A text begins after an end, and ends with one.
            held += [word + np.append(np.uint8(END), here[:-1])[t], word + CLASSES + here[t + 1]]
            if sum(map(len, held)) >= HELD_KEYS:
                yield from rows()
        if held:
            yield from rows()

    return found.where("not held").select("codes").mapInArrow(run, "word long, slots binary, counts binary")


def chosen(rows: DataFrame, counts: np.ndarray, head: np.ndarray) -> DataFrame:
    """(word, class): the best class of each word of ``neighbours``. A word has a few rows for each task at most, so none is hot."""
    shared = rows.sparkSession.sparkContext.broadcast((counts, head))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, head = shared.value

        def solve(table: pa.Table) -> pa.RecordBatch:
            codes = table["word"].combine_chunks().dictionary_encode()
            words = codes.dictionary
            row, slot, n = unpacked(table)
            key = codes.indices.to_numpy(zero_copy_only=False).astype(np.int64)[row] * 2 * CLASSES + slot
            n = np.bincount(key, weights=n, minlength=len(words) * 2 * CLASSES)
            now, best = head[words.to_numpy()].astype(np.int64), []
            # An entry takes a row of numbers, one for each class, and a batch may have a hundred entries a word.
            for unique in pieces(np.flatnonzero(n), 2 * CLASSES, PIECE):
                word = unique // (2 * CLASSES)
                best.append(best_classes(counts, word - word[0], unique % (2 * CLASSES), n[unique], now[word[0] : word[-1] + 1]))
            return pa.RecordBatch.from_arrays([words, pa.array(np.concatenate(best), pa.int32())], names=["word", "class"])

        rest: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if rest is None else pa.concat_tables([rest, table])
            last = table["word"][-1]
            # The last word may go on in the next batch.
            cut = table.num_rows
            while cut > 0 and table["word"][cut - 1] == last:
                cut -= 1
            if cut:
                yield solve(table.slice(0, cut))
            rest = table.slice(cut)
        if rest is not None and rest.num_rows:
            yield solve(rest)
        release()

    return rows.repartition("word").sortWithinPartitions("word").mapInArrow(run, "word long, class int")


def exchange(found: DataFrame, words: Head, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """The classes of the words of the exchange, by number, and the bigrams of classes under them. The classes come to the driver: one byte for
    each of ``HEAD`` words at most. The most frequent words begin with a class each."""
    head = np.zeros(len(words.counts), np.uint8)
    head[np.lexsort((words.hashes, -words.counts))] = np.arange(len(head)) % (CLASSES - 2) + 1
    best, score, every = (head, np.zeros(0)), -np.inf, SHARES
    for turn in range(rounds + 1):
        counts = bigrams(found, head, words.rare)
        if likelihood(counts) > score:
            best, score = (head, counts), likelihood(counts)
        else:
            # Words that moved together spoil each other's gain: go back, and let fewer move at once.
            (head, counts), every = best, every * 2
        if turn == rounds:
            break
        rows = chosen(neighbours(found, head, turn, every), counts, head).toArrow()
        head = head.copy()
        head[rows["word"].to_numpy()] = rows["class"].to_numpy()
    return best


class Model:
    """Probabilities from counts of classes. ``types`` has the number of words of each class."""

    def __init__(self, counts: np.ndarray, types: np.ndarray, discount: float) -> None:
        self.discount = discount
        size = counts[:CLASSES].sum(axis=0)
        share = size / max(size.sum(), 1)
        self.transition = (counts + PRIOR * share) / (counts.sum(axis=1, keepdims=True) + PRIOR)
        self.size = np.maximum(size, 1)
        saved = np.where(size > 0, discount * types / self.size, 0)
        with np.errstate(divide="ignore"):
            self.log_transition, self.log_unknown = np.log10(self.transition), np.log10(self.transition @ saved)


def scores(found: DataFrame, words: DataFrame, model: Model, classes: np.ndarray, head: Head, least: int, ends: int, tokens: int, vocabulary: int) -> DataFrame:
    """One row for each text. Words of the exchange and ends are summed in the chunks; each token of another word is looked up by a join, with what
    it adds if the word is known and if it is not."""
    shared = found.sparkSession.sparkContext.broadcast((model, classes, head.counts, head.rare))

    def walk(row: dict, states: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Numbers, where texts end, and the state before each token."""
        codes = np.frombuffer(row["codes"].as_py(), np.int32)
        return codes, np.flatnonzero(codes == -1), np.append(np.uint8(END), by_token(codes, states, END)[:-1])

    def states_of(classes: np.ndarray, rare: np.ndarray) -> np.ndarray:
        return np.append(UNKNOWN, np.where(rare, UNKNOWN, classes)).astype(np.uint8)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, classes, counts, rare = shared.value
        states, of = states_of(classes, rare), np.append(TAIL, classes).astype(np.uint8)
        # What each word adds whatever is before it; words outside the exchange add nothing here.
        emitted = np.append(0.0, np.log10((counts - model.discount) / model.size[classes]))
        plain = np.append(0.0, np.log10(counts + 1.0))
        end_emitted = np.log10((ends - model.discount) / model.size[END]) if ends else 0.0
        for batch in batches:
            for row in rows_of(batch):
                codes, stops, before = walk(row, states)
                score = model.log_transition[before, by_token(codes, of, END)] + by_token(codes, emitted, end_emitted)
                score[codes < -1] = 0.0
                if not ends:
                    # An end that the training texts do not have is not known either.
                    score[stops] = model.log_unknown[before[stops]] if tokens else 0.0
                known = (codes >= 0) | ((codes == -1) & (ends > 0))
                starts, n = np.append(0, stops[:-1] + 1), len(stops)
                columns = [
                    pa.array([row["chunk"].as_py()] * n), pa.array(np.arange(n), pa.int64()), row["ids"].values, pa.array([row["held"].as_py()] * n), pa.array(np.diff(stops, prepend=-1), pa.int64()),
                    *[pa.array(np.add.reduceat(x, starts)) for x in (known.astype(np.int64), by_token(codes, plain, np.log10(ends + 1.0)), score)]]
                yield pa.RecordBatch.from_arrays(columns, names=["chunk", "no", "id", "held_out", "n_tokens", "n_known", "plain", "score"])

    def outside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, classes, _, rare = shared.value
        states = states_of(classes, rare)
        for batch in batches:
            for row in rows_of(batch):
                codes, stops, before = walk(row, states)
                at = np.flatnonzero(codes < -1)
                text = np.searchsorted(stops, at)
                word = separate(row["tail"].as_py()).take(pa.array(-2 - codes[at]))
                seen, never = model.log_transition[before[at], TAIL], model.log_unknown[before[at]]
                columns = [pa.array([row["chunk"].as_py()] * len(at), pa.int64()), pa.array(text, pa.int64()), word, pa.array(seen), pa.array(never)]
                yield from pa.Table.from_arrays(columns, names=["chunk", "no", "word", "seen", "never"]).to_batches(PIECE)
        release()

    id_type = found.schema["ids"].dataType.elementType.simpleString()
    texts = found.select("chunk", "ids", "held", "codes").mapInArrow(
        whole, f"chunk long, no long, id {id_type}, held_out boolean, n_tokens long, n_known long, plain double, score double")
    rest = found.select("chunk", "codes", "tail").where(F.length("tail") > 0).mapInArrow(outside, "chunk long, no long, word binary, seen double, never double")
    told = rest.join(words.where((F.col("word") != b"") & (F.col("c") < least)).select("word", "c"), "word", "left")
    emitted = F.col("seen") + F.log10((F.col("c") - model.discount) / float(model.size[TAIL]))
    added = told.groupBy("chunk", "no").agg(
        F.count("c").alias("more"), F.sum(F.log10(F.coalesce("c", F.lit(0)) + 1.0)).alias("more_plain"),
        F.sum(F.when(F.col("c").isNotNull(), emitted).otherwise(F.col("never") if tokens else F.lit(0.0))).alias("more_score"))
    every = texts.join(added, ["chunk", "no"], "left").fillna(0, ["more", "more_plain", "more_score"])
    base = F.col("plain") + F.col("more_plain") - F.col("n_tokens") * float(np.log10(tokens + vocabulary + 1))
    return every.select(
        "id", "held_out", "n_tokens", (F.col("n_known") + F.col("more")).alias("n_known"), F.lit(tokens).cast("long").alias("train_tokens"),
        base.alias("base_score"), (F.col("score") + F.col("more_score")).alias("score"))


def log_probabilities(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", modulus: int = 7, remainder: int = 2, rounds: int = ROUNDS) -> DataFrame:
    """id, held_out, n_tokens, n_known, train_tokens, base_score, score for each row of ``docs``.

    Rows whose CRC-32 of the id as text leaves ``remainder`` are held out: nothing is learned from them. A row without an id is learned from. A null
    text counts as empty and has one token, its end. Repeated rows count and are returned as often as they occur; other columns are ignored. An
    empty table gives an empty one; without texts to learn from every token is unknown and certain.
    """
    held = F.coalesce(crc_of_id(id_col) % modulus == remainder, F.lit(False))
    with staging(docs.sparkSession, "classlm") as save, batches_of(docs.sparkSession, BATCH_BYTES):
        with staging(docs.sparkSession, "classlm-chunks") as save_raw:
            raw = save_raw(chunks(docs, id_col, text_col, held), "chunks")
            words = vocabulary(raw, save)
            head, least = exchanged(words)
            found = save(coded(raw, head), "coded")
        is_end = F.col("word") == b""
        total = words.agg(
            F.sum("c").alias("n"), F.count(F.lit(1)).alias("v"), F.count(F.when(~is_end & (F.col("c") < least), 1)).alias("tail"),
            F.count(F.when(F.col("c") == 1, 1)).alias("once"), F.count(F.when(F.col("c") == 2, 1)).alias("twice"), F.max(F.when(is_end, F.col("c"))).alias("ends")).first()
        classes, counts = exchange(found, head, rounds)
        types = np.bincount(classes, minlength=CLASSES).astype(np.float64)
        types[TAIL], types[END] = total["tail"], total["ends"] is not None
        discount = float(np.clip(total["once"] / max(total["once"] + 2 * total["twice"], 1), 0.05, 0.95))
        found = scores(found, words, Model(counts, types, discount), classes, head, least, total["ends"] or 0, total["n"] or 0, total["v"])
        return materialise(found.withColumnRenamed("id", id_col), "classlm-scores")
