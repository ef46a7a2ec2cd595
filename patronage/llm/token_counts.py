"""Exact histogram of encoded lengths; sums from the long end answer every context limit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Lengths in a block; sums run within a block and over blocks, never over all lengths in one task.
BLOCK = 1024


def length_histogram(lengths: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """(*by, n_tokens, n_docs): documents of each encoded length. Combined before the shuffle, so a frequent length is one row per task."""
    return lengths.groupBy(*by, "n_tokens").agg(F.count("*").alias("n_docs"))


ANSWERS = ("context_limit", "n_docs", "docs_longer", "tokens_longer", "docs_total", "tokens_total", "truncated_total", "quantile")


def suffix_sums(histogram: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """For each length that occurs, as a context limit: documents and tokens, those of longer documents, and what truncation leaves.

    Columns: `by`, context_limit, n_docs (of that length), docs_longer, tokens_longer (all their tokens), docs_total, tokens_total,
    truncated_total (tokens left if every document is cut at the limit), quantile (share of documents that fit). Groups are any columns but those
    named here, or with an underscore in front; null groups stand for themselves. An empty histogram gives no rows.
    """
    taken = [name for name in by if name.lower() in (*ANSWERS, "n_tokens") or name.startswith("_")]
    if taken:
        raise ValueError(f"groups cannot be named {taken}")
    rows = histogram.withColumn("_tokens", F.col("n_tokens") * F.col("n_docs")).withColumn("_block", F.floor(F.col("n_tokens") / BLOCK))
    later = Window.partitionBy(*by).orderBy(F.col("_block").desc()).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*by)
    blocks = rows.groupBy(*by, "_block").agg(F.sum("n_docs").alias("_d"), F.sum("_tokens").alias("_t"))
    blocks = blocks.select(
        *(F.col(name).alias(f"_by_{i}") for i, name in enumerate(by)),
        F.col("_block").alias("_of"),
        F.coalesce(F.sum("_d").over(later), F.lit(0)).alias("_docs_after"),
        F.coalesce(F.sum("_t").over(later), F.lit(0)).alias("_tokens_after"),
        F.sum("_d").over(whole).alias("docs_total"),
        F.sum("_t").over(whole).alias("tokens_total"),
    )
    within = Window.partitionBy(*by, "_block").orderBy(F.col("n_tokens").desc()).rowsBetween(Window.unboundedPreceding, -1)
    inside = lambda name: F.coalesce(F.sum(name).over(within), F.lit(0))
    same = F.col("_block") == F.col("_of")
    for i, name in enumerate(by):
        same &= F.col(name).eqNullSafe(F.col(f"_by_{i}"))
    rows = rows.withColumns({"docs_longer": inside("n_docs"), "tokens_longer": inside("_tokens")}).join(blocks, same)
    rows = rows.withColumns({"docs_longer": F.col("docs_longer") + F.col("_docs_after"), "tokens_longer": F.col("tokens_longer") + F.col("_tokens_after")})
    return rows.select(
        *by,
        F.col("n_tokens").alias("context_limit"),
        "n_docs",
        "docs_longer",
        "tokens_longer",
        "docs_total",
        "tokens_total",
        (F.col("tokens_total") - F.col("tokens_longer") + F.col("docs_longer") * F.col("n_tokens")).alias("truncated_total"),
        ((F.col("docs_total") - F.col("docs_longer")) / F.col("docs_total")).alias("quantile"),
    )


def _first_at_least(answers: DataFrame, limit: int) -> Column:
    return F.min(F.when(F.col("context_limit") >= limit, F.struct("context_limit", "n_docs", "docs_longer", "tokens_longer")))


def at_limits(answers: DataFrame, limits: list[int]) -> DataFrame:
    """(context_limit, docs_longer, tokens_longer, truncated_total) for any limits, whether documents of that length occur or not."""
    totals = [F.max("docs_total").alias("docs"), F.max("tokens_total").alias("tokens")]
    found = answers.agg(*totals, *(_first_at_least(answers, limit).alias(f"at_{i}") for i, limit in enumerate(limits)))
    rows = []
    for i, limit in enumerate(limits):
        exact = F.col(f"at_{i}.context_limit") == limit
        docs = F.coalesce(F.col(f"at_{i}.docs_longer") + F.when(exact, 0).otherwise(F.col(f"at_{i}.n_docs")), F.lit(0))
        own = F.when(exact, 0).otherwise(F.col(f"at_{i}.n_docs") * F.col(f"at_{i}.context_limit"))
        tokens = F.coalesce(F.col(f"at_{i}.tokens_longer") + own, F.lit(0))
        left = F.coalesce("tokens", F.lit(0)) - tokens + docs * limit
        rows.append(F.struct(F.lit(limit).cast("long").alias("context_limit"), docs.alias("docs_longer"), tokens.alias("tokens_longer"), left.alias("truncated_total")))
    return found.select(F.inline(F.array(*rows)))


def quantile_length(answers: DataFrame, shares: list[float]) -> DataFrame:
    """(share, n_tokens): the least length that at least that share of documents does not exceed; null without documents."""
    least = [F.min(F.when(F.col("quantile") >= share, F.col("context_limit"))).alias(f"at_{i}") for i, share in enumerate(shares)]
    return answers.agg(*least).select(
        F.inline(F.array(*(F.struct(F.lit(share).alias("share"), F.col(f"at_{i}").alias("n_tokens")) for i, share in enumerate(shares))))
    )
