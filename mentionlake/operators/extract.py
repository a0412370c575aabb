"""From comments to mentions: scoring, response parsing, defaults, default scorer."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType
from pyspark.sql.window import Window

from mentionlake.functions.ids import analysis_id, analysis_id_murmur
from mentionlake.functions.text import strip_space
from mentionlake.operators.sizes import lookup
from mentionlake.schemas import DOUBLE, STRING, struct
from mentionlake.session import ship_package

Scorer = Callable[[pd.DataFrame], pd.Series]

# Defaults of a mention, and the lengths of its quote.
DEFAULT_ASPECT = "general"
DEFAULT_SCORE = 0.5
QUOTE_FROM_BODY = 150
QUOTE_CHARS = 200

FIELDS = ("brand_name", "product_name", "aspect", "sentiment_score", "quote")


def score(
    context: DataFrame, scorer_factory: Callable[[], Scorer], partitions: int | None = None
) -> DataFrame:
    """Add ``response``, the scorer's text per row.

    The scorer is made once per task and gets Arrow batches. A slow scorer can be
    given more tasks with ``partitions``; rows are spread by comment, so a large
    submission or subreddit does not end up in one task.
    """
    ship_package(context.sparkSession)
    rows = context if partitions is None else context.repartition(partitions, "comment_id")
    schema = StructType([*rows.schema.fields, StructField("response", STRING)])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = scorer_factory()
        for batch in batches:
            yield batch.assign(response=scorer(batch))

    return rows.mapInPandas(run, schema)


def response_array(c: Column | str) -> Column:
    """JSON array text out of a response: fences and space removed, else null.

    The reader stops after the first value, so the text is read as the content of a list, which must
    have one element, an array, and as a field of an object: text after the array, or a second array, voids the response.
    """
    text = strip_space(c)
    for fence in (r"^```json", r"^```", r"```\z"):
        text = F.regexp_replace(text, fence, "")
    text = strip_space(text)
    content = F.from_json(F.concat(F.lit("["), text, F.lit("]")), "array<string>")
    field = F.from_json(F.concat(F.lit('{"a":'), text, F.lit("}")), "a array<string>")["a"]
    whole = text.startswith("[") & (F.size(content) == 1) & F.get(content, F.lit(0)).startswith("[") & field.isNotNull()
    return F.when(whole, text)


def parse_responses(df: DataFrame, strict: bool = False) -> DataFrame:
    """One row per object in the ``response`` array, with the five mention fields as text.

    ``item_no`` is the object's place in the array. Of a key that is given twice the last value counts. A response that is no JSON array gives no row, nor do its elements that are no
    objects. With ``strict`` one faulty element (no object, a null aspect, a score
    that is no number) voids all elements of its response.
    """
    elements = F.from_json(response_array("response"), "array<string>")
    parsed = F.transform(elements, lambda e: F.when(e.startswith("{"), F.from_json(e, "map<string,string>")))
    if strict:
        parsed = F.when(~F.exists(parsed, _faulty), parsed)
    exploded = df.select("*", F.posexplode(parsed).alias("item_no", "_item")).filter("_item IS NOT NULL")
    fields = {name: _last_of(F.col("_item"), name) for name in FIELDS}
    return exploded.withColumns(fields).drop("_item", "response")


def _last_of(item: Column, name: str) -> Column:
    entries = F.filter(F.map_entries(item), lambda e: e["key"] == name)
    return F.try_element_at(entries, F.lit(-1))["value"]


def _faulty(item: Column) -> Column:
    def null_or(name: str, test: Callable[[Column], Column]) -> Column:
        value = _last_of(item, name)
        return F.map_contains_key(item, name) & (value.isNull() | test(value))

    no_number = null_or("sentiment_score", lambda v: v.try_cast("double").isNull())
    return item.isNull() | null_or("aspect", lambda v: F.lit(False)) | no_number


def finish_mentions(df: DataFrame, quote_from_body: int = QUOTE_FROM_BODY, quote_chars: int = QUOTE_CHARS) -> DataFrame:
    """Fill in what the scorer left out; ``df`` still holds the comment's ``body``.

    A quote has at most ``quote_chars`` characters; without one it is the first ``quote_from_body`` of the comment.
    """
    body_start = F.when(
        F.length("body") > quote_from_body,
        F.concat(F.substring("body", 1, quote_from_body), F.lit("...")),
    ).otherwise(F.col("body"))
    quote = F.when(F.length("quote") > 0, F.col("quote")).otherwise(body_start)
    return df.withColumns(
        {
            "brand_name": F.coalesce("brand_name", F.lit("")),
            "product_name": F.coalesce("product_name", F.lit("")),
            "aspect": F.lower(F.coalesce("aspect", F.lit(DEFAULT_ASPECT))),
            "sentiment_score": F.coalesce(F.col("sentiment_score").try_cast("double"), F.lit(DEFAULT_SCORE)),
            "quote": F.substring(quote, 1, quote_chars),
        }
    )


def with_analysis_id(mentions: DataFrame, short: bool = False) -> DataFrame:
    """Add the id of a mention; ``short`` gives the 32-bit form.

    Where the mentions have an ``item_no``, the id covers it: names that become equal leave several mentions.
    """
    keys = ("comment_id", "brand_name", "product_name", "aspect")
    more = ("quote", "item_no") if "item_no" in mentions.columns else ("quote",)
    value = analysis_id_murmur(*keys) if short else analysis_id(*keys, *more)
    return mentions.withColumn("analysis_id", value)


LEXICON = struct(("token", STRING), ("kind", STRING), ("value", STRING), ("weight", DOUBLE))
WORD_BREAK = r"[^\p{L}\p{N}]+"


#: Words of the longest lexicon entry.
LONGEST_ENTRY = 8
#: A lexicon of at most so many entries is sent to every task; a larger one meets the words in a salted join.
SENT_ENTRIES = 1 << 16


def entry_hits(context: DataFrame, lexicon: DataFrame, longest: int = LONGEST_ENTRY) -> DataFrame:
    """(comment_id, pos, kind, value, weight): where entries of one or more words occur, ``pos`` counting words.

    An entry is looked up by its first word, like a branch of a trie by its root, and holds if the words after it follow in the text. Where
    entries of one kind overlap, the first one stands, of those that begin together the longest; what it covers counts for no other entry of its kind. An entry is
    split into words as texts are. One of more than ``longest`` words is an error when the query runs; one without words matches nothing.
    """
    words = F.filter(F.split(F.lower("body"), WORD_BREAK), lambda w: w != "")
    each = context.select("comment_id", words.alias("words"))
    ahead = F.transform("words", lambda w, i: F.struct(i.cast("int").alias("pos"), w.alias("token"), F.slice("words", i + 1, F.lit(longest)).alias("ahead")))
    placed = each.select("comment_id", F.explode(ahead).alias("w")).select("comment_id", "w.*")
    entry = F.filter(F.split(F.lower("token"), WORD_BREAK), lambda w: w != "")
    checked = F.when(F.size(entry) > longest, F.raise_error(F.concat(F.lit("lexicon entry too long: "), F.col("token")))).otherwise(entry)
    entries = lexicon.select(checked.alias("_entry"), "kind", "value", "weight").where(F.size("_entry") > 0).withColumn("_word", F.element_at("_entry", 1))
    if lexicon.limit(SENT_ENTRIES + 1).count() <= SENT_ENTRIES:
        met = placed.join(F.broadcast(entries.withColumnRenamed("token", "_token")), F.col("token") == F.col("_word"))
    else:
        met = lookup(placed, "token", entries, "_word")
    hits = met.where(F.slice("ahead", F.lit(1), F.size("_entry")) == F.col("_entry"))
    # All matches of a comment come together once; what follows is grouped by comment as well, and moves nothing.
    one = F.struct("kind", F.struct("pos", (-F.size("_entry")).alias("less"), "value", "weight").alias("m"))
    gathered = hits.select("comment_id", one.alias("hit")).groupBy("comment_id").agg(F.collect_list("hit").alias("hits"))

    def matches(kind: Column) -> Column:
        """Of one kind, from left to right, the longest of a place first."""
        return F.array_sort(F.transform(F.filter("hits", lambda h: h["kind"].eqNullSafe(kind)), lambda h: h["m"]))

    of_kinds = F.transform(F.array_distinct(F.col("hits.kind")), lambda kind: F.struct(kind.alias("kind"), matches(kind).alias("ms")))
    each_kind = gathered.select("comment_id", F.explode(of_kinds).alias("k")).select("comment_id", "k.kind", "k.ms")
    nothing = F.struct(F.lit(-1).alias("start"), F.lit(0).alias("less"), F.lit(0).alias("end"), F.slice("ms", F.lit(1), F.lit(0)).alias("kept"))

    def step(state: Column, m: Column) -> Column:
        stands = (m["pos"] >= state["end"]) | ((m["pos"] == state["start"]) & (m["less"] == state["less"]))
        taken = F.struct(m["pos"].alias("start"), m["less"].alias("less"), (m["pos"] - m["less"]).alias("end"), F.concat(state["kept"], F.array(m)).alias("kept"))
        return F.when(stands, taken).otherwise(state)

    kept = F.aggregate("ms", nothing, step)["kept"]
    return each_kind.select("comment_id", "kind", F.explode(kept).alias("m")).select("comment_id", "kind", "m.pos", "m.value", "m.weight")


def lexicon_mentions(context: DataFrame, lexicon: DataFrame) -> DataFrame:
    """Mentions by word lists: the default scorer, all in joins and windows.

    ``lexicon`` rows are names or words of kind brand, product, aspect or polarity (with the
    score as ``weight``), of one word or several. Each brand word opens a stretch that ends at the next one.
    Within it, polarity words count for the aspect word before them (``general`` if
    there is none), and the first product word names the product. A mention is a
    (brand, product, aspect) of a comment with the mean of its polarity words.

    Words that begin no entry are dropped before anything is shuffled, if the lexicon has at most ``SENT_ENTRIES`` entries.
    """
    hits = entry_hits(context, lexicon)

    def value_of(kind: str) -> Column:
        return F.when(F.col("kind") == kind, F.col("value"))

    # A name may be listed under several kinds; brands come first at a position.
    order = [F.col("pos"), F.when(F.col("kind") == "brand", 0).otherwise(1), "kind", "value"]
    in_comment = Window.partitionBy("comment_id").orderBy(*order)
    in_stretch = Window.partitionBy("comment_id", "_stretch").orderBy(*order)
    stretch = in_stretch.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    placed = (
        hits.withColumn("_stretch", F.count(value_of("brand")).over(in_comment))
        .filter("_stretch > 0")
        .withColumns(
            {
                "brand_name": F.first(value_of("brand"), ignorenulls=True).over(stretch),
                "product_name": F.first(value_of("product"), ignorenulls=True).over(stretch),
                "aspect": F.last(value_of("aspect"), ignorenulls=True).over(in_stretch),
            }
        )
        .fillna({"product_name": DEFAULT_ASPECT, "aspect": DEFAULT_ASPECT})
    )
    weight = F.when(F.col("kind") == "polarity", F.col("weight"))
    found = placed.groupBy("comment_id", "brand_name", "product_name", "aspect").agg(
        F.coalesce(F.avg(weight), F.lit(DEFAULT_SCORE)).cast("string").alias("sentiment_score")
    )
    number = F.row_number().over(Window.partitionBy("comment_id").orderBy("brand_name", "product_name", "aspect")) - 1
    return context.join(found.withColumn("item_no", number), "comment_id").withColumn("quote", F.lit(None).cast("string"))
