"""Collocations of two to five words, found by growing phrases word by word, the most promising beginnings first.

A phrase that begins with a word of frequency f scores at most floor(1000 n / f): of its first cut, the whole occurs no more often
than the rest. So beginnings are expanded from rare to frequent words, a band at a time. Within a band a phrase grows only from a
prefix that occurs often enough. After each band the 2000th best surviving score of a language is known; the language is settled
once the bound of the next word is below that score (with an equal one ties may still come).

Texts are split once into chunks of word numbers, from which the words are removed that are too rare for any candidate. Each step of growth reads
the chunks, counts in each and sums the counts by Spark. What a step needs of the step before is a bit map of hashes with a fixed bound
in size; it lets a few phrases pass in vain, never loses one, and counts are of the words themselves. What surrounds a phrase, and
how often its rests occur, is asked for only where a bound of its score can still enter the result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from mentionlake.llm.common import BITS_PER_KEY, MAP_BITS, MAPS
from mentionlake.operators.dedupe import top_n
from mentionlake.session import Save, materialise, ship_package, staging

LONGEST, LEAST, TOP, SCALE, UNKNOWN = 5, 100, 2000, 1000, "und"
#: So many times the phrases that are asked for are described first, those of the highest bounds.
AHEAD = 2
#: A band ends at so many times the frequency at which it begins.
WIDER = 64
CHUNK_BYTES = 2 << 20
#: Separators of pieces, as whitespace that nothing else is mapped to; a tab becomes a space.
_PIECES = bytes(10 if chr(c) in ".,;:!?\n\x0b\x0c\r" else 32 if c == 9 else c for c in range(256))
MULTIPLY = np.uint64(0x9E3779B97F4A7C15)


def numbered(text: bytes) -> tuple[pa.Array, np.ndarray]:
    """The distinct words between spaces, and a number for each word in order; a line break, which stands alone, is -1."""
    parts = pc.split_pattern(pa.array([text], pa.large_binary()), b" ").flatten().dictionary_encode()
    codes, words = parts.indices.to_numpy(zero_copy_only=False).astype(np.int32), parts.dictionary
    empty, stop = pc.equal(words, b"").to_numpy(zero_copy_only=False), pc.equal(words, b"\n").to_numpy(zero_copy_only=False)
    number = np.cumsum(~(empty | stop), dtype=np.int32) - 1
    number[stop] = -1
    return words.filter(pa.array(~(empty | stop))).cast(pa.binary()), number[codes[~empty[codes]]]


def encode(texts: list[bytes]) -> tuple[pa.Array, np.ndarray]:
    """The words of some texts, with -1 between pieces."""
    return numbered(b"\n".join(texts).lower().translate(_PIECES).replace(b"\n", b" \n "))


CHUNK = "chunk long, lang string, words array<binary>, counts array<long>, codes binary"
CHUNK_ARROW = pa.schema([("chunk", pa.int64()), ("lang", pa.string()), ("words", pa.list_(pa.binary())), ("counts", pa.list_(pa.int64())), ("codes", pa.binary())])


def chunks(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    """Texts of one language, about ``CHUNK_BYTES`` at a time: their words, how often each occurs, and all in order."""
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        base, made = TaskContext.get().partitionId() << 32, 0
        held: dict[str, list[bytes]] = {}
        sizes: dict[str, int] = {}

        def close(lang: str) -> pa.RecordBatch:
            nonlocal made
            words, codes = encode(held.pop(lang))
            sizes.pop(lang)
            made += 1
            counts = np.bincount(codes[codes >= 0], minlength=len(words))
            row = [[base + made], [lang], [words.to_pylist()], [counts.tolist()], [codes.tobytes()]]
            return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(row, CHUNK_ARROW, strict=True)], schema=CHUNK_ARROW)

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                text = text.as_py()
                if not text:
                    continue
                held.setdefault(lang, []).append(text)
                sizes[lang] = sizes.get(lang, 0) + len(text)
                # Many languages share the room of a few, so that a task holds a bounded amount of text.
                if sizes[lang] >= CHUNK_BYTES:
                    yield close(lang)
                elif sum(sizes.values()) >= 8 * CHUNK_BYTES:
                    yield close(max(sizes, key=sizes.get))
        for lang in list(held):
            yield close(lang)

    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN)).alias("lang"), F.col(text_col).cast("binary").alias("text"))
    return rows.mapInArrow(run, CHUNK)


def word_hash(word: bytes) -> int:
    return xxh64_intdigest(word)


def _step(hashes: np.ndarray, word: np.ndarray) -> np.ndarray:
    mixed = hashes * MULTIPLY + word
    return mixed ^ (mixed >> np.uint64(31))


def phrase_hash(lang: str, words: list[bytes]) -> int:
    found = np.array([word_hash(lang.encode())], np.uint64)
    for w in words:
        found = _step(found, np.array([word_hash(w)], np.uint64))
    return int(found[0])


class Known:
    """Which phrases may be wanted: a bit map of their hashes of 8 MB at most, made by Spark."""

    def __init__(self, bits: np.ndarray) -> None:
        self.bits, self.size = bits, np.uint64(max(8, len(bits) * 8))

    def has(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.bits):
            return np.zeros(len(hashes), bool)
        at = (hashes % self.size).astype(np.int64)
        return (self.bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)


def known(wanted: DataFrame) -> Known:
    """Of (lang, phrase)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [phrase_hash(lang, phrase.split(b" ")) for lang, phrase in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array((np.array(found, np.uint64) % np.uint64(bits)).astype(np.int64), pa.int64())], names=["at"])

    bits = MAP_BITS * min(MAPS, max(1, -(-wanted.count() * BITS_PER_KEY // MAP_BITS)))
    at = wanted.select("lang", "phrase").mapInArrow(run, "at long")
    block, bit = F.floor(F.col("at") / MAP_BITS).alias("block"), F.pmod("at", F.lit(MAP_BITS).cast("long")).alias("bit")
    maps = at.select(block, bit).groupBy("block").agg(F.bitmap_construct_agg("bit").alias("set")).collect()
    filled = np.zeros(bits // 8 if maps else 0, np.uint8)
    for m in maps:
        filled[m.block * (MAP_BITS // 8) : (m.block + 1) * (MAP_BITS // 8)] = np.frombuffer(m.set, np.uint8)
    return Known(filled)


def thinned(found: DataFrame, words: DataFrame) -> DataFrame:
    """(lang, words, codes): only words that may be among those of ``words`` (lang, phrase) keep a number; the rest separates as pieces do.

    A bit map tells them, so a few rare words keep theirs too; no phrase with one of these occurs often enough."""
    shared = found.sparkSession.sparkContext.broadcast(known(words))
    schema = pa.schema([("lang", pa.string()), ("words", pa.list_(pa.binary())), ("codes", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                lang, words, codes = (batch.column(i)[r] for i in range(3))
                hashes = np.array([word_hash(w) for w in words.values.to_pylist()], np.uint64)
                at = np.flatnonzero(shared.value.has(_step(np.array([word_hash(lang.as_py().encode())], np.uint64), hashes)))
                new = np.full(len(hashes) + 1, -1, np.int32)
                new[at] = np.arange(len(at), dtype=np.int32)
                mapped = new[np.frombuffer(codes.as_py(), np.int32)]
                # One separator is as good as many.
                mapped = mapped[(mapped >= 0) | np.append(True, mapped[:-1] >= 0)]
                row = [[lang.as_py()], [words.values.take(pa.array(at)).to_pylist()], [mapped.tobytes()]]
                yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(row, schema, strict=True)], schema=schema)

    return found.select("lang", "words", "codes").mapInArrow(run, "lang string, words array<binary>, codes binary")


Bands = dict[str, tuple[int, int]]


class Windows:
    """Windows of one chunk that grow to the right. Of equal ones only a number is kept for each place."""

    def __init__(self, lang: str, words: pa.Array, codes: np.ndarray) -> None:
        self.words, self.codes = words, np.concatenate([[-1], codes, [-1]])
        self.hashes = np.array([word_hash(w) for w in words.to_pylist()], np.uint64)
        self.seed = np.array([word_hash(lang.encode())], np.uint64)

    def begin(self, first: Known | None = None) -> None:
        """All places of words, or of those that ``first`` may have."""
        own = _step(self.seed, self.hashes)
        fits = np.append(np.ones(len(own), bool) if first is None else first.has(own), False)
        self.at, self.length = np.flatnonzero(fits[self.codes]), 1
        self.kinds, self.first, self.kind = np.unique(self.codes[self.at], return_index=True, return_inverse=True)
        self.hash = own[self.kinds] if len(self.kinds) else np.zeros(0, np.uint64)

    def grow(self) -> None:
        """Each window takes the next word; those before a separator go."""
        following = self.codes[self.at + self.length]
        more = following >= 0
        self.at, following, before = self.at[more], following[more], self.kind[more]
        key = before.astype(np.int64) * (len(self.words) + 1) + following
        kinds, self.first, self.kind = np.unique(key, return_index=True, return_inverse=True)
        if len(kinds):
            self.hash = _step(self.hash[kinds // (len(self.words) + 1)], self.hashes[kinds % (len(self.words) + 1)])
        else:
            self.hash = np.zeros(0, np.uint64)
        self.length += 1

    def keep(self, which: np.ndarray) -> None:
        """Only windows of the kinds that ``which`` tells."""
        number = np.cumsum(which) - 1
        stays = which[self.kind] if len(self.kind) else np.zeros(0, bool)
        self.at, self.kind, self.hash = self.at[stays], number[self.kind[stays]] if len(self.kind) else self.kind, self.hash[which]
        _, self.first = np.unique(self.kind, return_index=True)

    def phrases(self) -> pa.Array:
        place = self.at[self.first]
        return pc.binary_join_element_wise(*[self.words.take(pa.array(self.codes[place + i])) for i in range(self.length)], pa.scalar(b" ", pa.binary()))

    def counts(self) -> np.ndarray:
        return np.bincount(self.kind, minlength=len(self.hash))

    def sides(self) -> list[pa.Array]:
        """For each kind the word before and the word after, null where they differ or a separator is there."""
        found, order = [], np.argsort(self.kind, kind="stable")
        starts = np.searchsorted(self.kind[order], np.arange(len(self.hash)))
        for offset in (-1, self.length):
            beside = self.codes[self.at[order] + offset]
            low, high = np.minimum.reduceat(beside, starts), np.maximum.reduceat(beside, starts)
            same = (low == high) & (low >= 0)
            word = self.words.take(pa.array(np.where(same, low, 0)))
            found.append(pc.if_else(pa.array(same), word, pa.scalar(None, pa.binary())))
        return found


def passed(found: DataFrame, schema: str, of_chunk: Callable[[Windows, str], Iterator[list[pa.Array]]]) -> DataFrame:
    ship_package(found.sparkSession)
    names = ["lang", *[part.split()[0] for part in schema.split(", ")]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                lang, words, codes = (batch.column(i)[r] for i in range(3))
                windows = Windows(lang.as_py(), words.values.cast(pa.binary()), np.frombuffer(codes.as_py(), np.int32))
                for columns in of_chunk(windows, lang.as_py()):
                    yield pa.RecordBatch.from_arrays([pa.array([lang.as_py()] * len(columns[0]), pa.string()), *columns], names=names)

    return found.select("lang", "words", "codes").mapInArrow(run, "lang string, " + schema)


def counted(found: DataFrame, first: Known, length: int, prefixes: Known | None) -> DataFrame:
    """(lang, phrase, f): phrases of ``length`` words that begin with a word of ``first``, grow from known prefixes and occur
    ``LEAST`` times or more. Few begin with another word; they are whole and count as well."""
    shared = found.sparkSession.sparkContext.broadcast((first, prefixes))

    def of_chunk(windows: Windows, lang: str) -> Iterator[list[pa.Array]]:
        first, prefixes = shared.value
        windows.begin(first)
        for n in range(2, length + 1):
            if n > 2:
                windows.keep(prefixes.has(windows.hash))
            windows.grow()
        if len(windows.hash):
            yield [windows.phrases(), pa.array(windows.counts(), pa.int64())]

    rows = passed(found, "phrase binary, n long", of_chunk)
    return rows.groupBy("lang", "phrase").agg(F.sum("n").alias("f")).where(F.col("f") >= LEAST)


def described(found: DataFrame, wanted: DataFrame) -> DataFrame:
    """(lang, phrase, f, closed): how often the phrases of ``wanted`` occur, and whether one word stands before or after all
    occurrences, so that a longer phrase occurs as often."""
    shared = found.sparkSession.sparkContext.broadcast(known(wanted))

    def of_chunk(windows: Windows, lang: str) -> Iterator[list[pa.Array]]:
        windows.begin()
        for _ in range(2, LONGEST + 1):
            windows.grow()
            which = shared.value.has(windows.hash)
            if which.any():
                some = Windows.__new__(Windows)
                some.__dict__.update(windows.__dict__)
                some.keep(which)
                yield [some.phrases(), pa.array(some.counts(), pa.int64()), *some.sides()]
            if not len(windows.hash):
                return

    rows = passed(found, "phrase binary, n long, before binary, after binary", of_chunk).join(wanted.select("lang", "phrase"), ["lang", "phrase"])

    def constant(side: str):
        return (F.count(side) == F.count(F.lit(1))) & F.min(side).eqNullSafe(F.max(side))

    return rows.groupBy("lang", "phrase").agg(F.sum("n").alias("f"), (constant("before") | constant("after")).alias("closed"))


def words_of(phrase: str = "phrase"):
    return F.split(F.col(phrase).cast("string"), " ")


def cuts(phrases: DataFrame) -> DataFrame:
    """(lang, phrase, k, left, right) for every cut of every phrase."""
    parts = phrases.select("lang", "phrase", words_of().alias("w"))
    each = parts.select("lang", "phrase", "w", F.explode(F.sequence(F.lit(1), F.size("w") - 1)).alias("k"))
    return each.select(
        "lang", "phrase", "k", F.array_join(F.slice("w", F.lit(1), F.col("k")), " ").cast("binary").alias("left"),
        F.array_join(F.slice("w", F.col("k") + 1, F.size("w") - F.col("k")), " ").cast("binary").alias("right"))


def scored(told: DataFrame, every: DataFrame, totals: DataFrame) -> DataFrame:
    """(lang, phrase, a, l, r, n, score) of candidates (lang, phrase, a), by the lowest of their cuts. ``every`` has the frequency of each part."""
    parts = every.select("lang", F.col("phrase").alias("part"), F.col("f"))
    met = cuts(told).join(parts.withColumnRenamed("part", "left").withColumnRenamed("f", "l"), ["lang", "left"])
    met = met.join(parts.withColumnRenamed("part", "right").withColumnRenamed("f", "r"), ["lang", "right"])
    met = met.join(told, ["lang", "phrase"]).join(totals, "lang")
    # 38 digits hold the product of a thousand and two counts.
    exact = [F.col(c).cast("decimal(19,0)") for c in ("a", "n", "l", "r")]
    score = F.call_function("div", (exact[0] * exact[1] * SCALE).cast("decimal(38,0)"), (exact[2] * exact[3]).cast("decimal(38,0)"))
    best = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("best")
    return met.groupBy("lang", "phrase", "a", "n").agg(best).select("lang", "phrase", "a", "best.l", "best.r", "n", "best.score")


def bounded(told: DataFrame, every: DataFrame, totals: DataFrame) -> DataFrame:
    """(lang, phrase, a, bound) of (lang, phrase, a): a score that none exceeds, from the frequencies of beginnings and single words.

    Of the last cut both parts are known, and of the first the rest occurs as often as the whole at least.
    """
    w = words_of()
    head, last = F.element_at(w, 1).cast("binary"), F.element_at(w, -1).cast("binary")
    left = F.array_join(F.slice(w, F.lit(1), F.size(w) - 1), " ").cast("binary")
    met = told.select("lang", "phrase", "a", F.size(w).alias("length"), head.alias("head"), left.alias("left"), last.alias("last"))
    for part in ("head", "left", "last"):
        met = met.join(every.select("lang", F.col("phrase").alias(part), F.col("f").alias(f"f_{part}")), ["lang", part])
    a, n, head, left, last = (F.col(c).cast("decimal(19,0)") for c in ("a", "n", "f_head", "f_left", "f_last"))
    whole = F.call_function("div", (a * n * SCALE).cast("decimal(38,0)"), (left * last).cast("decimal(38,0)"))
    first = F.call_function("div", n * SCALE, head)
    return met.join(totals, "lang").select("lang", "phrase", "a", F.when(F.col("length") > 2, F.least(whole, first)).otherwise(whole).alias("bound"))


def ranked(candidates: DataFrame, top: int) -> DataFrame:
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    return top_n(candidates, "lang", order, top)


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the ``top`` surviving candidates of each language.

    A null text counts as empty, a null language as ``und``. Repeated rows count as often as they occur. Other columns are ignored. An empty table, or one without
    candidates, gives an empty one.
    """
    spark = docs.sparkSession
    with staging(spark, "phrases") as save:
        return materialise(_grown(spark, save, docs, text_col, lang_col, top), "phrases-ranked")


def _grown(spark: SparkSession, save: Save, docs: DataFrame, text_col: str, lang_col: str, top: int) -> DataFrame:
    whole = save(chunks(docs, text_col, lang_col), "chunks")
    each = whole.select("lang", F.explode(F.arrays_zip("words", "counts")).alias("w"))
    words = save(each.groupBy("lang", F.col("w.words").alias("phrase")).agg(F.sum("w.counts").alias("f")), "words")
    totals = save(words.groupBy("lang").agg(F.sum("f").alias("n")), "totals")
    often = save(words.where(F.col("f") >= LEAST), "often")
    found = save(thinned(whole, often), "thinned")
    every, best = often, None
    # The state of each language that has candidates: what is expanded so far, and the least score that may still enter.
    expanded = dict.fromkeys((r.lang for r in often.select("lang").distinct().collect()), 0)
    entry: dict[str, int] = dict.fromkeys(expanded, 0)
    step = 0
    while True:
        bands = _next_bands(often, totals, expanded, entry)
        if not bands:
            break
        grown, first = None, known(_of_bands(often, bands))
        for length in range(2, LONGEST + 1):
            level = save(counted(found, first, length, None if grown is None else known(grown)), f"band-{step}-{length}")
            grown = level if grown is None else grown.unionByName(level)
        told = grown.withColumnRenamed("f", "a")
        every = every.unionByName(grown).distinct()
        bounds = save(bounded(told, every, totals), f"bounds-{step}")
        # First those of the highest bounds; of the others only those that the scores found so far do not rule out.
        done = None
        for turn in range(2):
            limits = spark.createDataFrame([(lang, least) for lang, least in entry.items()], "lang string, least long")
            chosen = bounds.join(limits, "lang").where(F.col("bound") >= F.col("least")).select("lang", "phrase", "a", "bound")
            if done is None:
                chosen = top_n(chosen, "lang", [F.col("bound").desc(), F.col("phrase")], AHEAD * top).drop("rank")
            else:
                chosen = chosen.join(done.select("lang", "phrase"), ["lang", "phrase"], "left_anti")
            done = chosen = save(chosen.select("lang", "phrase", "a"), f"chosen-{step}-{turn}")
            if turn and chosen.isEmpty():
                break
            rest = cuts(chosen).select("lang", F.col("right").alias("phrase")).where(F.contains(F.col("phrase").cast("string"), F.lit(" ")))
            wanted = save(chosen.select("lang", "phrase").unionByName(rest).distinct(), f"wanted-{step}-{turn}")
            facts = save(described(found, wanted), f"facts-{step}-{turn}")
            every = every.unionByName(facts.select("lang", "phrase", "f")).distinct()
            open_ones = facts.where(~F.col("closed") | (F.size(words_of()) == LONGEST)).select("lang", "phrase")
            candidates = scored(chosen.join(open_ones, ["lang", "phrase"]), every, totals)
            best = candidates if best is None else best.unionByName(candidates).distinct()
            best = save(ranked(best, top).drop("rank"), f"best-{step}-{turn}")
            reached = best.groupBy("lang").agg(F.count(F.lit(1)).alias("found"), F.min("score").alias("least")).where(F.col("found") >= top)
            entry.update({r.lang: int(r.least) for r in reached.collect()})
        expanded.update({lang: high for lang, (_, high) in bands.items()})
        step += 1
    if best is None:
        best = spark.createDataFrame([], "lang string, phrase binary, a long, l long, r long, n long, score long")
    out = ranked(best, top).withColumn("phrase", F.col("phrase").cast("string"))
    return out.select("lang", F.col("rank").cast("long"), "phrase", "a", "l", "r", "n", "score")


def _of_bands(often: DataFrame, bands: Bands) -> DataFrame:
    spark = often.sparkSession
    spans = spark.createDataFrame([(lang, low, high) for lang, (low, high) in bands.items()], "lang string, low long, high long")
    return often.join(spans, "lang").where((F.col("f") > F.col("low")) & (F.col("f") <= F.col("high"))).select("lang", "phrase")


def _next_bands(often: DataFrame, totals: DataFrame, expanded: dict[str, int], entry: dict[str, int]) -> Bands:
    """For each language that is not settled the next frequencies of first words: (above, up to). One row for each language is read."""
    spark = often.sparkSession
    if not expanded:
        return {}
    state = spark.createDataFrame([(lang, done, entry[lang]) for lang, done in expanded.items()], "lang string, done long, entry long")
    # A word may begin a phrase of the score that is needed if floor(1000 n / f) reaches it.
    reach = F.call_function("div", F.col("n").cast("decimal(19,0)") * SCALE, F.col("f").cast("decimal(19,0)")) >= F.col("entry")
    rows = often.join(state, "lang").join(totals, "lang").where((F.col("f") > F.col("done")) & reach)
    span = rows.groupBy("lang").agg(F.min("f").alias("low"), F.max("f").alias("high")).collect()
    return {r.lang: (expanded[r.lang], min(r.high, max(r.low, LEAST) * WIDER)) for r in span}
