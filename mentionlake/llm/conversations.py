"""Repair of conversations: faults of their rows, and the cheapest edits that give the pattern ``(s?(ua)+)?``.

Everything but the final digest is worked out from narrow rows (turn, role, MD5 of the text, two flags). These are sorted by range, so that a
long conversation is spread over many partitions; each partition turns its share of a conversation into one run of codes.
A run that is a whole conversation is solved where it is. Where a conversation crosses a border of partitions (two of each partition
at most do), its runs are priced by the state behind them, the prices are chained from the last run to the first, and the
letters traced from the first to the last. Texts are shuffled once, for the digest of the repaired conversation.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mentionlake.llm import auction
from mentionlake.session import materialise, ship_package

KINDS, DROPPED, EMPTIED, UNPOINTED, REPEATED, AS_USER = 20, 0, 1, 2, 3, 4
BLANKS = " \t\n\x0b\x0c\r"
LEGAL = {"su", "ua", "au"}
NO_ROWS = hashlib.sha256(b"").hexdigest()
COUNTS = ["blank", "duplicate", "truncated", "illegal"]
PIECE_ROWS = 2000


def damage(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies): what is left of ``conversations`` when some rows are dropped, emptied and so on.

    The CRC-32 of ``conv_id:turn`` decides; a null in any of the four columns counts as one space there, but stays a null id or turn.
    """
    def shown(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn")).cast("binary")) % KINDS
    text = F.when(kind == EMPTIED, F.lit("")).when(kind == UNPOINTED, F.translate(shown("text"), ".!?", "")).otherwise(shown("text"))
    return rows.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.when(kind == AS_USER, F.lit("user")).otherwise(shown("role")).alias("role"), text.alias("text"),
        F.when(kind == REPEATED, 2).otherwise(1).alias("copies"), kind.alias("kind"),
    ).where(F.col("kind") != DROPPED).drop("kind")


def digest(text: Column) -> Column:
    return F.md5(text.cast("binary"))


def faulted(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, digest, blank, truncated, n, seen): damaged rows that differ, how often each occurs, and whether an
    earlier turn has the same role and text. Equal rows are counted in each task before anything is sent."""
    solid = F.rtrim("text", F.lit(BLANKS))
    narrow = rows.select(
        "conv_id", "turn", "role", digest(F.col("text")).alias("digest"), (solid == "").alias("blank"),
        (~F.substring(solid, -1, 1).isin(".", "!", "?")).alias("truncated"), "copies")
    told = narrow.groupBy("conv_id", "turn", "role", "digest", "blank", "truncated").agg(F.sum("copies").alias("n"))
    # A struct with a null turn is less than any other.
    first = told.groupBy("conv_id", "role", "digest").agg(F.min(F.struct("turn")).alias("first"))
    first = first.select(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d"), F.col("first.turn").alias("first"))
    met = told.join(first, told["conv_id"].eqNullSafe(first["c"]) & (told["role"] == first["r"]) & (told["digest"] == first["d"]))
    return met.select(*told.columns, (~F.col("turn").eqNullSafe(F.col("first"))).alias("seen"))


RUN = "conv_id long, part int, turn long, role string, digest string, codes string, before string, after string, blank long, duplicate long, truncated long, illegal long"


def runs(rows: DataFrame) -> DataFrame:
    """One row for each share of a conversation in a partition of the order: its first row's key, a code for each row, the
    initials at its borders, and counts of faults. A share is as long as a partition at most."""
    ship_package(rows.sparkSession)
    order = ["conv_id", "turn", "role", "digest"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, now, codes, done = TaskContext.get().partitionId(), None, [], []

        def close() -> None:
            if now is not None:
                now["codes"] = "".join(codes)
                done.append(now)

        for batch in batches:
            for r in batch.to_pylist():
                if now is None or now["conv_id"] != r["conv_id"]:
                    close()
                    now, codes = {"conv_id": r["conv_id"], "part": part, "turn": r["turn"], "role": r["role"], "digest": r["digest"],
                                  "before": None, "after": "", **dict.fromkeys(COUNTS, 0)}, []
                initial, n = r["role"][:1], r["n"]
                known = initial if initial in "sua" and initial else "x"
                if now["before"] is None:
                    now["before"] = initial
                else:
                    now["illegal"] += now["after"] + initial not in LEGAL
                now["after"] = initial
                now["illegal"] += (n - 1) * (initial + initial not in LEGAL)
                if r["blank"]:
                    now["blank"] += n
                    codes.append(auction.MUST_GO * n)
                elif r["seen"]:
                    now["duplicate"] += n
                    codes.append(auction.MUST_GO * n)
                else:
                    now["truncated"] += r["truncated"]
                    now["duplicate"] += n - 1
                    codes.append((known.upper() if r["truncated"] else known) + auction.MUST_GO * (n - 1))
            if len(done) >= PIECE_ROWS:
                yield pa.RecordBatch.from_pylist(done, schema=schema)
                done.clear()
        close()
        yield pa.RecordBatch.from_pylist(done, schema=schema)

    schema = pa.schema([
        ("conv_id", pa.int64()), ("part", pa.int32()), ("turn", pa.int64()), ("role", pa.string()), ("digest", pa.string()),
        ("codes", pa.string()), ("before", pa.string()), ("after", pa.string()), *[(c, pa.int64()) for c in COUNTS]])
    # A number of partitions, so that they are not merged: the parts of a conversation rise with its order.
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).mapInArrow(run, RUN)


LONGS = pa.list_(pa.int64())


def mapped(df: DataFrame, added: dict[str, tuple[str, pa.DataType]], of_row) -> DataFrame:
    """The columns of ``df`` and what ``of_row`` gives for each row; ``added`` has the types for Spark and for Arrow."""
    ship_package(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [of_row(r) for r in batch.to_pylist()]
            made = [pa.array([f[i] for f in found], kind) for i, (_, kind) in enumerate(added.values())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], names=[*batch.schema.names, *added])

    schema = [f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields] + [f"{n} {t}" for n, (t, _) in added.items()]
    return df.mapInArrow(run, ", ".join(schema))


def finite(prices: auction.Prices) -> list[int | None]:
    return [None if p == auction.NEVER else int(p) for p in prices]


def ends_of(r: dict) -> auction.Prices | None:
    return None if r["ends"] is None else tuple(float(e) for e in r["ends"])


def same_run(left: str = "l", right: str = "r") -> Column:
    return F.col(f"{left}.conv_id").eqNullSafe(F.col(f"{right}.conv_id")) & (F.col(f"{left}.part") == F.col(f"{right}.part"))


def chain(group: pa.Table) -> pa.Table:
    """The prices behind each run of a conversation, from the last to the first; nothing follows the last."""
    group = group.sort_by("part")
    after, ends = None, []
    for matrix in reversed(group["crossing"].to_pylist()):
        ends.append(after)
        after = finite(auction.block_prices("", None)) if after is None else after
        after = [min(m[s] + after[t] for t, m in enumerate(matrix) if m[s] is not None) for s in auction.STATES]
    return pa.table({"conv_id": group["conv_id"], "part": group["part"], "ends": pa.array(ends[::-1], LONGS)})


def passing(r: dict) -> list[list[int]]:
    """For each set of states in which a run may begin (a bit for each): the set in which its letters end."""
    sets = []
    for bits in range(1, 16):
        _, states = auction.trace(r["codes"], ends_of(r), frozenset(s for s in auction.STATES if bits >> s & 1))
        sets.append(sum(1 << s for s in states))
    return [sets]


def enter(group: pa.Table) -> pa.Table:
    """The set of states in which each run begins."""
    group = group.sort_by("part")
    bits, entered = 1 << auction.START, []
    for sets in group["passing"].to_pylist():
        entered.append(bits)
        bits = sets[bits - 1]
    return pa.table({"conv_id": group["conv_id"], "part": group["part"], "entered": pa.array(entered, pa.int64())})


def traced(r: dict) -> list:
    letters, _ = auction.trace(r["codes"], ends_of(r), frozenset(s for s in auction.STATES if r["entered"] >> s & 1))
    return [letters, auction.cost(r["codes"], letters)]


SOLVED = {"audit": ("string", pa.string()), "cost": ("bigint", pa.int64())}


def bordered(found: DataFrame) -> DataFrame:
    """(conv_id, part, audit, cost) for runs of conversations that have several. Of each partition two runs at most are here, so a
    conversation has no more of them than there are partitions."""
    codes = found.select("conv_id", "part", "codes")
    crossed = mapped(codes, {"crossing": ("array<array<bigint>>", pa.list_(LONGS))}, lambda r: [[finite(p) for p in auction.crossing(r["codes"])]])
    priced = crossed.select("conv_id", "part", "crossing").groupBy("conv_id").applyInArrow(chain, "conv_id long, part int, ends array<bigint>")
    both = codes.alias("l").join(priced.alias("r"), same_run()).select("l.*", "r.ends")
    passed = materialise(mapped(both, {"passing": ("array<bigint>", LONGS)}, passing), "conversation-borders")
    entered = passed.select("conv_id", "part", "passing").groupBy("conv_id").applyInArrow(enter, "conv_id long, part int, entered long")
    both = passed.alias("l").join(entered.alias("r"), same_run()).select("l.*", "r.entered")
    return mapped(both, SOLVED, traced).select("conv_id", "part", *SOLVED)


def whole(r: dict) -> list:
    letters, _ = auction.trace(r["codes"], None, frozenset([auction.START]))
    return [letters, auction.cost(r["codes"], letters)]


def solved(found: DataFrame) -> DataFrame:
    """``found`` (runs) with the letters and the cost of each."""
    several = found.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("conv_id").alias("c"))
    several = materialise(several, "conversation-several")
    crossing = found.join(several, F.col("conv_id").eqNullSafe(F.col("c")), "left_semi")
    alone = found.join(several, F.col("conv_id").eqNullSafe(F.col("c")), "left_anti")
    met = crossing.alias("l").join(bordered(crossing).alias("r"), same_run())
    return mapped(alone, SOLVED, whole).unionByName(met.select("l.*", "r.audit", "r.cost"))


REPAIRED = "conv_id long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def repaired(rows: DataFrame, found: DataFrame) -> DataFrame:
    """One row for each conversation that has rows: counts, cost, letters, and the digest of the rows that the letters leave.

    Rows and runs of a conversation meet sorted, each run before its rows, and are hashed as they pass: a digest has to take
    the texts in their order, but no task holds more than one batch of them and the letters of one conversation.
    """
    ship_package(rows.sparkSession)
    blank = {c: F.lit(None).cast(t) for c, t in (("codes", "string"), ("before", "string"), ("after", "string"), ("audit", "string"), ("cost", "long"), *[(c, "long") for c in COUNTS])}
    texts = rows.select("conv_id", "turn", "role", digest(F.col("text")).alias("digest"), F.lit(1).alias("kind"), "text", "copies", *[v.alias(k) for k, v in blank.items()])
    heads = found.select("conv_id", "turn", "role", "digest", F.lit(0).alias("kind"), F.lit(None).cast("string").alias("text"), F.lit(0).alias("copies"), *blank)
    sums = [*COUNTS, "cost"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[dict] = []
        state = None

        for batch in batches:
            for r in batch.to_pylist():
                if state is None or state.conv_id != r["conv_id"]:
                    if state is not None:
                        done.append(state.close())
                    state = _Conversation(r["conv_id"], sums)
                if r["kind"] == 0:
                    state.enter(r)
                else:
                    for _ in range(r["copies"]):
                        state.take(r["role"], r["text"])
            if len(done) >= PIECE_ROWS:
                yield pa.RecordBatch.from_pylist(done, schema=schema)
                done.clear()
        if state is not None:
            done.append(state.close())
        yield pa.RecordBatch.from_pylist(done, schema=schema)

    schema = pa.schema([("conv_id", pa.int64()), *[(c, pa.int64()) for c in sums], ("audit", pa.string()), ("repaired_sha256", pa.string())])
    order = ["conv_id", "turn", "role", "digest", "kind"]
    return texts.unionByName(heads).repartition("conv_id").sortWithinPartitions(*order).mapInArrow(run, REPAIRED)


class _Conversation:
    """The repaired rows of one conversation, hashed one by one."""

    def __init__(self, conv_id: int | None, sums: list[str]) -> None:
        self.conv_id, self.sums = conv_id, dict.fromkeys(sums, 0)
        self.state, self.after, self.audit, self.letters = auction.START, None, [], iter("")
        self.hash, self.rows = hashlib.sha256(), 0

    def put(self, role: str, text: str) -> None:
        self.hash.update((("\n" if self.rows else "") + role + ":" + text).encode())
        self.rows += 1

    def insert(self) -> None:
        self.state = auction.NEXT[self.state]
        self.put("user" if self.state == auction.USER else "assistant", "")

    def finish_run(self) -> None:
        for _ in self.letters:
            self.insert()

    def enter(self, r: dict) -> None:
        self.finish_run()
        if self.after is not None:
            self.sums["illegal"] += self.after + r["before"] not in LEGAL
        self.after = r["after"]
        for name in self.sums:
            self.sums[name] += r[name]
        self.audit.append(r["audit"])
        self.letters = iter(r["audit"])

    def take(self, role: str, text: str) -> None:
        for letter in self.letters:
            if letter == "I":
                self.insert()
                continue
            if letter == "K":
                self.state = auction.KEPT[self.state, role[:1]]
                self.put(role, text)
            elif letter == "R":
                self.state = auction.NEXT[self.state]
                self.put("user" if self.state == auction.USER else "assistant", text)
            return

    def close(self) -> dict:
        self.finish_run()
        return {"conv_id": self.conv_id, **self.sums, "audit": "".join(self.audit), "repaired_sha256": self.hash.hexdigest()}


def repair(conversations: DataFrame) -> DataFrame:
    """One row for each ``conv_id`` of ``conversations`` (conv_id, turn, role, text), after the damage of ``damage``.

    gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256. A row's first fault counts. Rows of one turn are taken by role,
    then by MD5 of the text, so repeated rows follow each other and all but the first are duplicates. Rows without a conv_id are one
    conversation, which has a null id. A role counts by its first letter; one that begins with another letter than s, u or a
    can be re-roled or deleted. Other columns are ignored. An empty table gives an empty one.
    """
    rows = damage(conversations)
    # The damage depends on id and turn alone, so turns can be counted without roles and texts.
    turns = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"))
    kept = damage(turns.withColumn("role", F.lit("")).withColumn("text", F.lit(""))).select("conv_id", "turn").distinct()
    spans = kept.groupBy("conv_id").agg(F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).alias("gaps"))
    found = solved(materialise(runs(faulted(rows)), "conversation-runs"))
    parts = [
        turns.select("conv_id", F.lit(0).cast("long").alias("gaps")).distinct(), spans,
        repaired(rows, found).withColumn("gaps", F.lit(0).cast("long")),
    ]
    sums = ["gaps", *COUNTS, "cost"]
    every = parts[0].unionByName(parts[1]).unionByName(parts[2], allowMissingColumns=True)
    return every.groupBy("conv_id").agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in sums], F.coalesce(F.max("audit"), F.lit("")).alias("audit"),
        F.coalesce(F.max("repaired_sha256"), F.lit(NO_ROWS)).alias("repaired_sha256"))
