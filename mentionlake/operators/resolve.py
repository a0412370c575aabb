"""Brand and model names to the spelling of the product reference."""

from __future__ import annotations

import difflib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mentionlake.operators.sizes import lookup
from mentionlake.session import ship_package

# Least similarity of an approximate match, and stand-in names.
BRAND_CUTOFF = 0.7
MODEL_CUTOFF = 0.6
UNKNOWN_BRAND = "Unknown"
GENERAL_MODEL = "general"

ANY_BLOCK = "*"

#: Measures of similarity: matching blocks over both lengths, or edits over the longer length.
BLOCKS, EDITS = "blocks", "edits"


def admissible_lengths(n: Column, cutoff: float, matcher: str) -> tuple[Column, Column]:
    """Least and greatest length of a candidate that can be so similar to a text of ``n`` characters.

    Matching blocks cover the shorter text at most, so 2 * shorter / (n + m) bounds the ratio; edits make up the
    difference of the lengths at least, so shorter / longer bounds it.
    """
    least = cutoff / (2 - cutoff) if matcher == BLOCKS else cutoff
    return F.ceil(n * least - 1e-9), F.floor(n / least + 1e-9)


def _blocks_ratio(cutoff: float):
    @F.pandas_udf("double")
    def ratio(candidates: pd.Series, texts: pd.Series) -> pd.Series:
        measure, last, out = difflib.SequenceMatcher(), None, []
        for candidate, text in zip(candidates, texts, strict=True):
            if text != last:
                measure.set_seq2(text)
                last = text
            measure.set_seq1(candidate)
            near = measure.real_quick_ratio() >= cutoff and measure.quick_ratio() >= cutoff
            out.append(measure.ratio() if near else None)
        return pd.Series(out, dtype="float64")

    return ratio


def similarity(candidate: str, text: str, cutoff: float, matcher: str) -> Column:
    if matcher == BLOCKS:
        return _blocks_ratio(cutoff)(candidate, text)
    longer = F.greatest(F.length(candidate), F.length(text), F.lit(1))
    return F.lit(1.0) - F.levenshtein(candidate, text) / longer


def best_match(texts: DataFrame, candidates: DataFrame, cutoff: float, matcher: str = BLOCKS) -> DataFrame:
    """For each (block, text) the most similar candidate of its block, if any passes; ties go to the largest.

    A text meets the candidates of its block whose length can reach the cutoff: an equi-join on block and
    length, with both sides plain, so that a block with most of the texts can be split. Only the best pair of a
    text is kept by each task.
    """
    if matcher not in (BLOCKS, EDITS):
        raise ValueError(f"unknown matcher {matcher}")
    ship_package(texts.sparkSession)
    low, high = admissible_lengths(F.length("text"), cutoff, matcher)
    t = texts.select("block", "text", F.explode(F.sequence(low, high)).alias("_length"))
    c = candidates.select("block", "candidate", F.length("candidate").cast("bigint").alias("_length"))
    pairs = t.join(c, ["block", "_length"]).withColumn("ratio", similarity("candidate", "text", cutoff, matcher))
    best = F.max(F.struct("ratio", "candidate")).alias("best")
    return pairs.filter(F.col("ratio") >= cutoff).groupBy("block", "text").agg(best).select("block", "text", "best.*")


def brand_index(reference: DataFrame) -> DataFrame:
    """Lower-case brand and the spelling to use."""
    return reference.groupBy(F.lower("brand").alias("brand_key")).agg(F.max("brand").alias("canonical_brand"))


def model_index(reference: DataFrame) -> DataFrame:
    """Lower-case model and the spelling to use, over all brands.

    A model listed under several brands takes the spelling of the last brand.
    """
    last = F.max(F.struct("brand", "model"))["model"]
    return reference.groupBy(F.lower("model").alias("model_key")).agg(last.alias("canonical_model"))


def brand_models(reference: DataFrame) -> DataFrame:
    """Brand -> models as rows, so that a brand with most models stays divisible."""
    return reference.select(F.lower("brand").alias("brand"), F.lower("model").alias("model")).distinct()


def resolve_exact(mentions: DataFrame, reference: DataFrame) -> DataFrame:
    """Replace names that equal a reference name but for case; others stay.

    An empty brand is ``Unknown``; an empty model is ``general``. A model is looked
    up over all brands.
    """
    brand, model = _raw("brand_name"), _raw("product_name")
    keyed = mentions.withColumns({"_brand": F.lower(brand), "_model": F.lower(model)})
    branded = lookup(keyed, "_brand", brand_index(reference), "brand_key", "left")
    joined = lookup(branded, "_model", model_index(reference), "model_key", "left")
    resolved = {
        "brand_name": _brand_or(brand, F.coalesce("canonical_brand", brand)),
        "product_name": _model_or(model, F.coalesce("canonical_model", model)),
    }
    return joined.withColumns(resolved).select(*mentions.columns)


def _raw(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(""))


def _brand_or(raw: Column, value: Column) -> Column:
    return F.when(raw == "", UNKNOWN_BRAND).otherwise(value)


def _model_or(raw: Column, value: Column) -> Column:
    return F.when((raw == "") | (F.lower(raw) == GENERAL_MODEL), GENERAL_MODEL).otherwise(value)


def resolve_brands(
    brands: DataFrame,
    reference: DataFrame,
    cutoff: float = BRAND_CUTOFF,
    matcher: str = BLOCKS,
) -> DataFrame:
    """``brands`` (distinct ``raw_brand``) with ``brand_name``: exact, else closest, else as is."""
    index = brand_index(reference)
    exact = brands.withColumn("_key", F.lower("raw_brand")).join(
        index, F.col("_key") == F.col("brand_key"), "left"
    ).drop("brand_key")
    open_texts = exact.filter(F.col("canonical_brand").isNull() & (F.col("_key") != "")).select(
        F.lit(ANY_BLOCK).alias("block"), F.col("_key").alias("text")
    ).distinct()
    candidates = index.select(F.lit(ANY_BLOCK).alias("block"), F.col("brand_key").alias("candidate"))
    close = best_match(open_texts, candidates, cutoff, matcher).join(
        index.select(F.col("brand_key").alias("candidate"), F.col("canonical_brand").alias("_close")), "candidate"
    ).select(F.col("text").alias("_key"), "_close")
    named = F.coalesce("canonical_brand", "_close", "raw_brand")
    return exact.join(close, "_key", "left").select(
        "raw_brand", _brand_or(F.col("raw_brand"), named).alias("brand_name")
    )


def resolve_models(
    pairs: DataFrame,
    reference: DataFrame,
    cutoff: float = MODEL_CUTOFF,
    matcher: str = BLOCKS,
) -> DataFrame:
    """``pairs`` (distinct ``brand_name``, ``raw_model``) with ``product_name``.

    Approximate matching looks among the models of the resolved brand; if the
    reference does not know the brand, among all models.
    """
    models = model_index(reference)
    per_brand = brand_models(reference)
    known = per_brand.select(F.col("brand").alias("_known")).distinct()
    exact = (
        pairs.withColumns({"_key": F.lower("raw_model"), "_brand": F.lower("brand_name")})
        .join(models, F.col("_key") == F.col("model_key"), "left")
        .join(known, F.col("_brand") == F.col("_known"), "left")
        .drop("model_key")
    )
    scoped = F.col("_known").isNotNull() & (F.col("brand_name") != UNKNOWN_BRAND)
    scoped_block = F.concat(F.lit("brand:"), F.col("_brand"))
    exact = exact.withColumn("block", F.when(scoped, scoped_block).otherwise(ANY_BLOCK))
    is_open = F.col("canonical_model").isNull() & ~F.col("_key").isin("", GENERAL_MODEL)
    open_texts = exact.filter(is_open).select("block", F.col("_key").alias("text")).distinct()
    candidates = per_brand.select(
        F.concat(F.lit("brand:"), F.col("brand")).alias("block"), F.col("model").alias("candidate")
    ).unionByName(models.select(F.lit(ANY_BLOCK).alias("block"), F.col("model_key").alias("candidate")))
    close = best_match(open_texts, candidates, cutoff, matcher).join(
        models.select(F.col("model_key").alias("candidate"), F.col("canonical_model").alias("_close")), "candidate"
    ).select("block", F.col("text").alias("_key"), "_close")
    named = F.coalesce("canonical_model", "_close", "raw_model")
    return exact.join(close, ["block", "_key"], "left").select(
        "brand_name", "raw_model", _model_or(F.col("raw_model"), named).alias("product_name")
    )


def resolve_pairs(
    mentions: DataFrame,
    reference: DataFrame,
    brand_cutoff: float = BRAND_CUTOFF,
    model_cutoff: float = MODEL_CUTOFF,
    matcher: str = BLOCKS,
) -> DataFrame:
    """Each distinct (raw_brand, raw_model) of the mentions with its resolved names.

    Names are matched once per distinct pair, never per mention.
    """
    pairs = mentions.select(_raw("brand_name").alias("raw_brand"), _raw("product_name").alias("raw_model")).distinct()
    brands = resolve_brands(pairs.select("raw_brand").distinct(), reference, brand_cutoff, matcher)
    branded = pairs.join(brands, "raw_brand")
    models = resolve_models(branded.select("brand_name", "raw_model").distinct(), reference, model_cutoff, matcher)
    return branded.join(models, ["brand_name", "raw_model"]).select(
        "raw_brand", "raw_model", "brand_name", "product_name"
    )


def apply_pairs(mentions: DataFrame, resolved: DataFrame) -> DataFrame:
    """Put the resolved names into the mentions.

    ``resolved`` should be a written table: then both sides of the join come from a
    shuffle of their own, and a pair with most of the mentions can be split.
    """
    keyed = mentions.withColumnsRenamed({"brand_name": "raw_brand", "product_name": "raw_model"})
    keyed = keyed.fillna("", ["raw_brand", "raw_model"])
    return keyed.join(resolved, ["raw_brand", "raw_model"], "left").select(*mentions.columns)


def resolve_mentions(mentions: DataFrame, reference: DataFrame, **options) -> DataFrame:
    return apply_pairs(mentions, resolve_pairs(mentions, reference, **options))
