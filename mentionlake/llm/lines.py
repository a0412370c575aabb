"""Line dedup: an edit-distance join of all distinct lines by segments, and the classes of linked lines."""

from __future__ import annotations

from functools import cache
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mentionlake.llm.common import possible
from mentionlake.llm.graph import components
from mentionlake.session import materialise

#: Two lines are near if at most so many edits apart, and one edit per so many characters of the shorter line.
DISTANCE, CHARS_PER_EDIT = 2, 10
#: Lines that have a segment in common with more others meet by longer keys. Up to so many, a count, the least and the
#: greatest tell them all.
BUCKET = 2
#: Segments of so many lines are still met line by line, by profile: that is less work than longer keys.
CROWD = 256
PIECES = 6
#: Characters are counted in so many groups, modulo 4.
GROUPS = 32
#: Strings longer than this are compared by their beginnings first.
HEAD = 32


def edits(length: Column) -> Column:
    return F.least(F.lit(DISTANCE), F.floor(length / CHARS_PER_EDIT).cast("int"))


def _piece(length: Column, parts: int, i: int) -> tuple[Column, Column]:
    """Start (from 0) and length of a piece; some are one longer where it does not come out even."""
    start, end = (F.floor(length.cast("long") * k / parts).cast("int") for k in (i, i + 1))
    return start, end - start


def _bytes(line: str) -> Column:
    """A line with one byte for each character, else null: there a place is found without a walk over all before it."""
    return F.when(F.octet_length(line) == F.col("n_chars"), F.col(line).cast("binary")).alias("bytes")


def _cut(start: Column, size: Column) -> Column:
    """A substring's UTF-8 bytes."""
    return F.coalesce(F.substring("bytes", start + 1, size), F.substring("line", start + 1, size).cast("binary"))


def index_keys() -> Column:
    """Hashes of a line's segments, one more than the edits it allows, each with its place and the line's length."""
    n = F.col("n_chars")
    out = F.array().cast("array<long>")
    for t in range(1, DISTANCE + 1):
        segments = [_piece(n, t + 1, i) for i in range(t + 1)]
        out = F.when(edits(n) == t, F.array(*[F.xxhash64(n, F.lit(i), _cut(*s)) for i, s in enumerate(segments)])).otherwise(out)
    return out


def _moves() -> list[tuple[int, int, int, int]]:
    """Where segments of a line can lie in a longer one, or one as long: its edits, how many characters it is shorter, the segment,
    and how far that has moved. A line's own segments are left out.

    If segment i is the first that fits, each one before has an edit, so it has moved by i at most; the rest
    are left for those after it, so it ends where they allow. Few starts meet both. No segment is so short that
    such a start lies outside the line.
    """
    return [
        (t, shorter, i, move) for t in range(1, DISTANCE + 1) for shorter in range(t + 1) for i in range(t + 1)
        for move in range(max(-i, shorter - (t - i)), min(i, shorter + (t - i)) + 1) if shorter or move]


def _inline(rows: list[tuple[int, ...]], *names: str) -> Column:
    return F.inline(F.array(*[F.struct(*[F.lit(v).alias(k) for k, v in zip(names, row, strict=True)]) for row in rows]))


def probes(lines: DataFrame) -> DataFrame:
    """(id, key): hashes of the substrings where a segment of a line as long, or up to ``DISTANCE`` shorter, can lie.

    One row for each place comes first and its hash after it: a method with all the hashes of a line is too long
    for the JVM to compile.
    """
    rows = lines.select("id", "line", "n_chars", _bytes("line"))
    rows = rows.select("*", _inline(_moves(), "t", "shorter", "i", "move"))
    n = F.col("n_chars") - F.col("shorter")
    rows = rows.where(edits(n) == F.col("t"))
    start, end = (F.floor(n.cast("long") * (F.col("i") + k) / (F.col("t") + 1)).cast("int") for k in (0, 1))
    return rows.select("id", F.xxhash64(n, "i", _cut(start + F.col("move"), end - start)).alias("key"))


def profile(line: Column) -> Column:
    """How often a line has characters of each group, modulo 4, as two bits of a number that neighbours differ in one of.

    One edit changes one count by one, or two: so the profiles of lines differ in two bits an edit at most.
    """
    low = (1 << 2 * GROUPS) // 3

    def counted(seen: Column, c: Column) -> Column:
        one = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.ascii(c), F.lit(GROUPS)) * 2)
        return seen.bitwiseXOR(one).bitwiseXOR(F.shiftleft(seen.bitwiseAND(one), 1))

    counts = F.aggregate(F.split(line, ""), F.lit(0).cast("long"), counted)
    return _let(counts, lambda x: x.bitwiseXOR(F.shiftright(x, 1).bitwiseAND(F.lit(low))))


def profiles_near(a: str, b: str, limit: Column) -> Column:
    """Whether lines with these profiles can be so many edits apart."""
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= limit * 2


def fine_keys(lines: DataFrame, probe: bool) -> DataFrame:
    """(id, profile, key): hashes of all but two of a line's pieces, as two edits touch two pieces at most. As a probe, of
    the pieces that a line as long, or up to ``DISTANCE`` shorter, has; those between and after the two have moved."""
    ways = [(shorter, between) for shorter in range(DISTANCE + 1) for between in range(-DISTANCE, DISTANCE + 1) if abs(between) + abs(shorter - between) <= DISTANCE]
    ways = [(x, y, *way) for x, y in combinations(range(PIECES), 2) for way in (ways if probe else [(0, 0)])]
    rows = lines.select("id", "profile", "line", "n_chars", _inline(ways, "x", "y", "shorter", "between"))
    n = F.col("n_chars") - F.col("shorter")
    parts = []
    for i in range(PIECES):
        start, size = _piece(n, PIECES, i)
        moved = F.when(F.lit(i) < F.col("x"), 0).when(F.lit(i) < F.col("y"), F.col("between")).otherwise(F.col("shorter"))
        parts.append(F.when((F.lit(i) == F.col("x")) | (F.lit(i) == F.col("y")), "").otherwise(F.substring("line", start + moved + 1, size)))
    return rows.select("id", "profile", F.xxhash64(n, "x", "y", *parts).alias("key"))


def _let(value: Column, use) -> Column:
    """``use(value)``, with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def common_prefix(a: Column, b: Column) -> Column:
    """Its length, found by halves: a step is taken if the next stretch is equal."""
    def step(at: Column, size: Column) -> Column:
        left, right = F.substring(a, at + 1, size), F.substring(b, at + 1, size)
        return F.when((left == right) & (F.char_length(left) == size), at + size).otherwise(at)

    longest = F.least(F.char_length(a), F.char_length(b))
    steps = F.transform(F.sequence(F.floor(F.log2(F.greatest(longest, F.lit(1)))).cast("int"), F.lit(0), F.lit(-1)), lambda e: F.call_function("shiftleft", F.lit(1), e))
    return F.when(longest == 0, 0).otherwise(F.aggregate(steps, F.lit(0), step))


@cache
def band(limit: int) -> str:
    """All steps of the bit-parallel recurrence in a band, as JSON for one literal.

    Of a column of the edit matrix only the rows within ``limit`` of the diagonal are kept, as two bit vectors: where the
    next row is one more (``vp``), and where it is one less (``vn``). With the bits where the column's character equals the
    rows' (``eq``) they give the vectors of the next column, whose rows lie one further down, and whether the value at the
    lower edge of the band rises. For each ``vp``, ``vn`` and ``eq`` the entry holds the next two, and the rise above them.
    """
    width = 2 * limit + 1
    mask, steps = (1 << width) - 1, []
    for vp in range(mask + 1):
        for vn in range(mask + 1):
            for eq in range(mask + 1):
                diagonal = (((eq & vp) + vp) ^ vp | eq | vn) & mask
                more, less = vn | ~(diagonal | vp) & mask, diagonal & vp
                moved = diagonal >> 1
                rise = 1 - (diagonal >> width - 1)
                steps.append((less | ~(moved | more) & mask) << width | moved & more | rise << 2 * width)
    return str(steps)


def _column_states(a: Column, b: Column, limit: int) -> Column:
    """The band after the last character of ``b``: its bit vectors, and above them the value at its lower edge."""
    width, n = 2 * limit + 1, F.char_length(b)
    blank = F.lit("")
    padded = F.concat(F.array_repeat(blank, limit), F.split(a, ""), F.array_repeat(blank, n + limit - F.char_length(a)))
    steps = F.from_json(F.lit(band(limit)), "array<int>")

    def equal(c: Column, j: Column) -> Column:
        bits = [F.when(F.get(padded, j + k if k else j) == c, 1 << k).otherwise(0) for k in range(width)]
        total = bits[0]
        for bit in bits[1:]:
            total = total + bit
        return total

    def advance(state: Column, eq: Column) -> Column:
        vectors = state.bitwiseAND(F.lit((1 << 2 * width) - 1))
        return F.get(steps, F.shiftleft(vectors, width) + eq) + (state - vectors)

    ones = sum(1 << k for k in range(limit, width))
    start = F.lit(ones << width | limit << 2 * width)
    return F.aggregate(F.transform(F.split(b, ""), equal), start, advance)


def _rows_up(state: Column, limit: int) -> list[Column]:
    """Values of the last column: at the lower edge of the band, one row higher, and so on."""
    width = 2 * limit + 1
    values = [F.shiftright(state, 2 * width)]
    for k in range(width - 2, -1, -1):
        values.append(values[-1] - F.shiftright(state, width + k).bitwiseAND(F.lit(1)) + F.shiftright(state, k).bitwiseAND(F.lit(1)))
    return values


def edit_distance(a: Column, b: Column, limit: int) -> Column:
    """The edit distance of two strings if it is at most ``limit``, else some greater number.

    The lengths must not differ by more than ``limit``.
    """
    m, n = F.char_length(a), F.char_length(b)
    distance = _let(_column_states(a, b, limit), lambda s: F.get(F.array(*_rows_up(s, limit)), n + limit - m))
    return F.when(n == 0, m).when(m == 0, n).otherwise(distance)


def _starts_apart(a: Column, b: Column, limit: int) -> Column:
    """Whether the beginnings alone need more than ``limit`` edits: all of the band is above it after ``HEAD`` characters."""
    head, more = F.substring(b, 1, HEAD), F.substring(a, 1, HEAD + limit)
    return _let(_column_states(more, head, limit), lambda s: F.least(*_rows_up(s, limit)) > limit)


def distance(a: Column, b: Column, limit: int = DISTANCE) -> Column:
    """``edit_distance`` without the beginning and the end that both strings share; long ones are given up early."""
    def middle(p: Column) -> Column:
        x, y = F.substring(a, p + 1, F.char_length(a)), F.substring(b, p + 1, F.char_length(b))
        return F.struct(x.alias("x"), y.alias("y"), common_prefix(F.reverse(x), F.reverse(y)).alias("s"))

    def cut(m: Column) -> Column:
        return F.struct(*[F.substring(m[c], F.lit(1), F.char_length(m[c]) - m["s"]).alias(c) for c in "xy"])

    def measured(m: Column) -> Column:
        long = F.least(F.char_length(m["x"]), F.char_length(m["y"])) > HEAD + limit
        return F.when(long & _starts_apart(m["x"], m["y"], limit), limit + 1).otherwise(edit_distance(m["x"], m["y"], limit))

    return _let(_let(_let(common_prefix(a, b), middle), cut), measured)


def occurrences(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, digest, place, line) of each line; the digest tells rows of one id apart."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("digest"), F.posexplode(F.split(text, "\n")).alias("place", "line"))


def _pairs(index: DataFrame, probe: DataFrame) -> DataFrame:
    """(x, y): ids of lines that have a key in common, of those whose profiles are near."""
    x, y = (rows.select("key", F.col("id").alias(side), F.col("profile").alias(f"{side}_profile")) for side, rows in (("x", index), ("y", probe)))
    met = x.join(y, "key").where(profiles_near("x_profile", "y_profile", F.lit(DISTANCE)) & (F.col("x") != F.col("y")))
    return met.select("x", "y")


def candidates(lines: DataFrame) -> DataFrame:
    """(a, b): ids of all lines that can be near. Nothing is left out.

    Each line looks up the segments of the shorter ones. A segment is known by how many lines have it and by the least
    and the greatest of them, so a lookup finds one row at most however common the segment is. Bit maps keep most lookups that find
    nothing out of the join. Where more than ``BUCKET`` lines have a segment, up to ``CROWD``, each lookup meets all of them, and those whose
    profiles allow it are paired. Lines that meet where still more have a segment (say, a common beginning) meet by longer
    keys instead: everything but two of six pieces. Of these, too, only lines are paired whose profiles allow it.
    A line finds its own segments too, if others have them, so each line of such a segment is among them.
    """
    index = lines.select("id", "line", "n_chars", _bytes("line")).select("id", F.explode(index_keys()).alias("key"))
    heads = index.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("low"), F.max("id").alias("high"))
    heads = materialise(heads, "line-segments")
    shared = heads.where("n > 1")
    own = possible(index, "key", shared).join(shared, "key").withColumn("own", F.lit(True))
    other = possible(probes(lines), "key", heads).join(heads, "key").where("n > 1 OR low <> id").withColumn("own", F.lit(False))
    hits = materialise(own.unionByName(other), "line-hits")
    few = hits.where(F.col("n") <= BUCKET).select(F.col("id").alias("x"), F.explode(F.array("low", "high")).alias("y"))
    common = hits.where(F.col("n") > BUCKET)
    those = materialise(common.groupBy("id").agg(F.max("n").alias("most")), "line-common")
    # An inner join: a semi join would be moved below the bit map, and shuffle all lines.
    those = possible(lines, "id", those).join(those, "id").withColumn("profile", profile(F.col("line")))
    those = materialise(those, "line-common-texts")
    met = common.where(F.col("n") <= CROWD).select("id", "key", "own").join(those.select("id", "profile"), "id")
    met = materialise(met, "line-met")
    some = _pairs(met.where("own"), met)
    crowded = those.where(F.col("most") > CROWD)
    many = _pairs(fine_keys(crowded, probe=False), fine_keys(crowded, probe=True))
    pairs = few.unionByName(some).unionByName(many).where("x <> y")
    return pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def links(lines: DataFrame) -> DataFrame:
    """(a, b): digests of all pairs of distinct lines that are near; ``lines``: (line, id, md, n_chars)."""
    pairs = materialise(candidates(lines.where(F.col("n_chars") >= CHARS_PER_EDIT)), "line-candidates")
    needed = materialise(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "line-needed")
    texts = possible(lines.select("id", "line", "md", "n_chars"), "id", needed).join(needed, "id")
    texts = materialise(texts.withColumn("profile", profile(F.col("line"))), "line-texts")
    a, b = (texts.select(*[F.col(c).alias(f"{side}_{c}") for c in texts.columns]) for side in "ab")
    both = pairs.join(a, F.col("a") == F.col("a_id")).join(b, F.col("b") == F.col("b_id"))
    limit = edits(F.least("a_n_chars", "b_n_chars"))
    possibly = (F.abs(F.col("a_n_chars") - F.col("b_n_chars")) <= limit) & profiles_near("a_profile", "b_profile", limit)
    near = F.when(possibly, distance(F.col("a_line"), F.col("b_line")) <= limit).otherwise(F.lit(False))
    return both.where(near).select(F.col("a_md").alias("a"), F.col("b_md").alias("b")).distinct()


def duplicate_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its id, ``n_lines`` (not blank), ``removed`` (places, from 0, of lines whose class has an earlier
    one) and ``n_links`` (links of its lines to other lines).

    Lines are near if at most two edits apart, and one edit for each ten characters of the shorter one; a class holds equal lines, and
    those that links connect. The first line of a class, by id and place, stays. Shorter lines have exact copies
    only; blank lines are never removed. A null text has no lines. Rows without an id stand first. Repeated rows get the same
    result; of a line that only they share, the first copy counts for all. Further columns are ignored.
    """
    rows = occurrences(docs, id_col, text_col)
    filled = rows.where(F.trim("line") != "")
    first = F.min(F.struct("doc_id", "digest", "place")).alias("first")
    lines = filled.groupBy("line").agg(F.count(F.lit(1)).alias("n"), first)
    lines = materialise(lines.select("*", F.xxhash64("line").alias("id"), F.md5(F.col("line").cast("binary")).alias("md"), F.char_length("line").alias("n_chars")), "lines")
    edges = materialise(links(lines), "line-links")
    degree = edges.select(F.explode(F.array("a", "b")).alias("md")).groupBy("md").agg(F.count(F.lit(1)).alias("links"))
    degree = materialise(degree, "line-degrees")
    label = F.struct("first", F.col("md").alias("node"))
    nodes = lines.join(degree, "md", "left_semi").select(F.col("md").alias("node"), label.alias("label"))
    classes = components(edges, nodes).select(F.col("node").alias("md"), F.col("label.first").alias("head"))
    narrow = lines.select("id", "md", "n", "first")
    notable = narrow.join(classes, "md", "left").join(degree, "md", "left").where("n > 1 OR links IS NOT NULL")
    notable = materialise(notable.select("id", "md", F.coalesce("head", "first").alias("head"), F.coalesce("links", F.lit(0).cast("long")).alias("links")), "line-classes")
    # Only lines that may be notable are looked up; all are counted.
    counted = rows.select("doc_id", "digest", F.when(F.col("place") == 0, 1).alias("start"), F.when(F.trim("line") != "", 1).alias("filled"))
    marked = possible(rows.where(F.trim("line") != "").withColumn("id", F.xxhash64("line")), "id", notable).withColumn("md", F.md5(F.col("line").cast("binary")))
    marked = marked.select("doc_id", "digest", "place", "md").join(notable.drop("id"), "md")
    earlier = F.col("head") != F.struct("doc_id", "digest", "place")
    marked = marked.select("doc_id", "digest", F.when(earlier, F.col("place")).alias("later"), "links")
    # The rows of one id and text fall together here, and are told apart again by how often they have a first line.
    one = counted.unionByName(marked, allowMissingColumns=True).groupBy("doc_id", "digest").agg(
        F.count("start").cast("int").alias("times"), F.count("filled").alias("n_lines"),
        F.array_sort(F.collect_set("later")).alias("removed"), F.sum("links").alias("n_links"))
    one = one.withColumn("__again", F.explode(F.sequence(F.lit(1), F.col("times"))))
    return one.select(
        F.col("doc_id").alias(id_col), (F.col("n_lines") / F.col("times")).cast("long").alias("n_lines"), "removed",
        F.coalesce((F.col("n_links") / F.col("times")).cast("long"), F.lit(0).cast("long")).alias("n_links"))
