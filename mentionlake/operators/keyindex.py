"""Where the keys of a partitioned table lie, so that an upsert reads what its batch meets and not the keys of the whole table.

Entries (key, partition) lie in hash buckets, each a folder. For each bucket there is a bit map of its keys, with the least and greatest of them. A batch looks at the maps of
the buckets its keys fall into, and reads the entries of those buckets only that may hold one of its keys; keys that are new read nothing.

Folders are only added. A manifest names those that count, the number of buckets and, for each partition, a digest of its data files at the time it was
indexed. It is replaced in one step. Entries are written before the rows that they tell of, so the index names too many partitions at worst: one that
a key has left is rewritten once more. A partition whose files are not those of the manifest (written by something else, or by a run that was stopped) is indexed again.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterable, Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mentionlake.session import delete_folder, path_exists

KEYS_PER_BUCKET = 1 << 18
LEAST_BUCKETS, MOST_BUCKETS = 1, 1 << 14
#: Bits of a bucket's map, a multiple of the 32 768 of a bitmap of Spark: eight for each key of a full bucket.
MAP_BITS, BLOCK_BITS = KEYS_PER_BUCKET * 8, 32_768
#: A folder is added by each upsert; this many are written anew as one.
MOST_FOLDERS = 24
NO_PARTITION = "\0"


def _read_text(spark: SparkSession, name: str) -> str | None:
    if not path_exists(spark, name):
        return None
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    stream = path.getFileSystem(spark._jsc.hadoopConfiguration()).open(path)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def _replace_text(spark: SparkSession, name: str, text: str) -> None:
    """Write beside it, then rename: a reader sees the old text or the new one."""
    jvm = spark._jvm.org.apache.hadoop.fs
    target, fresh = jvm.Path(name), jvm.Path(f"{name}-{uuid.uuid4().hex}")
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    stream = files.create(fresh, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    context = jvm.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = spark._jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(files.makeQualified(fresh), files.makeQualified(target), options)


def files_by_partition(table: DataFrame, partition: str) -> dict[str, str]:
    """A digest of the names of the data files of each partition. Names are unique, and a file never changes; no rows are read."""
    found: dict[str, list[str]] = {}
    for file in table.inputFiles():
        folder, _, name = file.rpartition("/")
        value = unquote(unquote(folder.rpartition(f"/{partition}=")[2]))
        found.setdefault(NO_PARTITION if value == "__HIVE_DEFAULT_PARTITION__" else value, []).append(name)
    return {value: hashlib.md5("\n".join(sorted(names)).encode()).hexdigest() for value, names in found.items()}


class KeyIndex:
    """The index of one table, in ``folder``."""

    def __init__(self, table: DataFrame, folder: str, keys: Sequence[str], partition: str) -> None:
        self.table, self.spark, self.folder, self.keys, self.partition = table, table.sparkSession, folder.rstrip("/"), list(keys), partition
        kinds = [f"`{k}` {table.schema[k].dataType.simpleString()}" for k in self.keys]
        first = table.schema[self.keys[0]].dataType.simpleString()
        self.schemas = {
            "entries": ", ".join([*kinds, f"place {table.schema[partition].dataType.simpleString()}", "run string, bucket int"]),
            "maps": f"block long, `set` binary, low {first}, high {first}, run string, bucket int",
        }
        spark = self.spark
        text = _read_text(spark, f"{self.folder}/manifest.json")
        state = json.loads(text) if text else {}
        if state.get("keys") != self.keys:
            state = {"keys": self.keys, "buckets": 0, "entries": 0, "folders": [], "partitions": {}}
        self.state = state

    def _save(self) -> None:
        _replace_text(self.spark, f"{self.folder}/manifest.json", json.dumps(self.state))

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.state["buckets"]).cast("long")).cast("int")

    def bit(self) -> Column:
        # Another hash than that of the bucket, whose low bits are equal within it.
        return F.pmod(F.xxhash64(F.lit("bit"), *self.keys), F.lit(MAP_BITS).cast("long"))

    def read(self, kind: str, buckets: Iterable[int] | None = None) -> DataFrame:
        """``entries`` or ``maps``, all or of some buckets: others are not even listed as tasks."""
        base, schema = f"{self.folder}/{kind}", self.schemas[kind]
        if not self.state["folders"]:
            return self.spark.createDataFrame([], schema)
        found = self.spark.read.schema(schema).option("basePath", base).parquet(*[f"{base}/run={name}" for name in self.state["folders"]])
        return found if buckets is None else found.where(F.col("bucket").isin(sorted(buckets)))

    def _add(self, rows: DataFrame) -> None:
        """Entries and maps of (keys, partition), in a folder that counts once the manifest names it."""
        name = uuid.uuid4().hex

        def put(df: DataFrame, kind: str) -> None:
            df.repartition("bucket").sortWithinPartitions("bucket").write.partitionBy("bucket").option("compression", "zstd").parquet(f"{self.folder}/{kind}/run={name}")

        put(rows.select(*self.keys, F.col(self.partition).alias("place"), self.bucket().alias("bucket")), "entries")
        self.state["folders"].append(name)
        told = self.read("entries").where(F.col("run") == name)
        block, at = F.floor(self.bit() / BLOCK_BITS).alias("block"), F.pmod(self.bit(), F.lit(BLOCK_BITS).cast("long")).alias("at")
        put(told.select("bucket", block, at, F.col(self.keys[0]).alias("k")).groupBy("bucket", "block").agg(
            F.bitmap_construct_agg("at").alias("set"), F.min("k").alias("low"), F.max("k").alias("high")), "maps")

    def refresh(self) -> None:
        """Index partitions whose files are not those that were indexed. The first time these are all."""
        table = self.table
        now = files_by_partition(table, self.partition)
        stale = [value for value, digest in now.items() if self.state["partitions"].get(value) != digest]
        if not self.state["buckets"]:
            self.state["buckets"] = LEAST_BUCKETS
        if stale:
            named = F.col(self.partition).isin([v for v in stale if v != NO_PARTITION])
            named = named | F.col(self.partition).isNull() if NO_PARTITION in stale else named
            rows = table.where(named).select(*self.keys, self.partition).dropna(subset=self.keys)
            self._grow(rows.count())
            self._add(rows.distinct())
        if stale or set(self.state["partitions"]) != set(now):
            self.state["partitions"] = now
            self._save()

    def _grow(self, more: int) -> None:
        """Make room: with twice as many entries as the buckets are made for, they are dealt anew over more of them."""
        self.state["entries"] += more
        room = max(LEAST_BUCKETS, 1 << (self.state["entries"] // KEYS_PER_BUCKET).bit_length())
        if self.state["folders"] and room > 2 * self.state["buckets"] < MOST_BUCKETS:
            self._compact(min(MOST_BUCKETS, room))
        elif not self.state["folders"]:
            self.state["buckets"] = min(MOST_BUCKETS, room)

    def buckets_met(self, batch: DataFrame) -> list[int]:
        """The buckets that may hold a key of ``batch``: its bit is set in the bucket's map, and it lies between the least and the greatest key there."""
        first = self.keys[0]
        bit = self.bit()
        keyed = batch.select(
            F.col(first).alias("k"), self.bucket().alias("b"), F.floor(bit / BLOCK_BITS).alias("at_block"), F.pmod(bit, F.lit(BLOCK_BITS).cast("long")).alias("at"))
        wanted = [r.b for r in keyed.select("b").distinct().collect()]
        met = self.read("maps", wanted).join(keyed, (F.col("bucket") == F.col("b")) & (F.col("block") == F.col("at_block")) & F.col("k").between(F.col("low"), F.col("high")))
        byte = F.conv(F.hex(F.substring("set", (F.floor(F.col("at") / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
        is_set = F.call_function("shiftright", byte, F.pmod("at", F.lit(8)).cast("int")).bitwiseAND(F.lit(1)) == 1
        return [r.b for r in met.where(is_set).select("b").distinct().collect()]

    def places(self, batch: DataFrame) -> DataFrame | None:
        """(keys, place): the partitions that hold keys of ``batch``; None if no bucket may hold one."""
        buckets = self.buckets_met(batch)
        if not buckets:
            return None
        found = self.read("entries", buckets).select(*self.keys, "place").distinct()
        return found.join(batch.select(*self.keys).distinct(), self.keys, "left_semi")

    def announce(self, batch: DataFrame, known: DataFrame | None) -> None:
        """Add the keys of a batch that is about to be written, but for those that are known to be where it puts them."""
        fresh = batch.select(*self.keys, self.partition)
        if known is not None:
            there = known.withColumnRenamed("place", self.partition)
            same = F.lit(True)
            for k in [*self.keys, self.partition]:
                same = same & F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}"))
            fresh = fresh.alias("l").join(there.alias("r"), same, "left_anti")
        self._grow(batch.count())
        self._add(fresh)
        if len(self.state["folders"]) > MOST_FOLDERS:
            self._compact(self.state["buckets"])
        self._save()

    def _compact(self, buckets: int) -> None:
        """All folders as one, over so many buckets. Entries of places that a key has left stay."""
        rows, old = self.read("entries").select(*self.keys, F.col("place").alias(self.partition)).distinct(), self.state["folders"]
        self.state["folders"], self.state["buckets"] = [], buckets
        self._add(rows)
        self._save()
        for name in old:
            for kind in self.schemas:
                delete_folder(self.spark, f"{self.folder}/{kind}/run={name}")

    def settle(self, table: DataFrame, touched: Iterable[str | None]) -> None:
        """Take the files of the partitions that were just written as indexed."""
        now = files_by_partition(table, self.partition)
        for value in {NO_PARTITION if t is None else t for t in touched}:
            self.state["partitions"].pop(value, None)
            if value in now:
                self.state["partitions"][value] = now[value]
        self._save()
