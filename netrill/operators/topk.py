"""Ranking inside parent keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

# Above this Spark no longer limits groups before the shuffle
# (spark.sql.optimizer.windowGroupLimitThreshold).
GROUP_LIMIT = 1000
SALTS = 64


def keep_top(
    rows: DataFrame,
    parent: Sequence[str],
    amount: Column,
    tie: Column,
    k: int,
    rank_column: str = "ranking",
) -> DataFrame:
    """The ``k`` rows of each parent with the largest amount.

    Equal amounts go by the smaller ``tie``. Each task keeps at most ``k`` rows
    per parent before the shuffle, so a parent with very many children does not
    travel to one task whole. For large ``k`` a salted first round does that.
    """
    order = [amount.desc(), tie.asc()]
    if k > GROUP_LIMIT:
        salted = rows.withColumn("salt", F.pmod(F.xxhash64(tie), F.lit(SALTS)))
        first = Window.partitionBy(*parent, "salt").orderBy(*order)
        rows = (
            salted.withColumn("salted_rank", F.row_number().over(first))
            .filter(F.col("salted_rank") <= k)
            .drop("salt", "salted_rank")
        )
    ranked = rows.withColumn(
        rank_column, F.row_number().over(Window.partitionBy(*parent).orderBy(*order))
    )
    return ranked.filter(F.col(rank_column) <= k)


def complete_conversation() -> Column:
    """Only these conversations are ranked; the others still count in totals."""
    return (
        F.col("location").isNotNull()
        & F.col("protocol").isNotNull()
        & (F.coalesce(F.col("address"), F.lit("")) != "")
        & (F.coalesce(F.col("larger_address"), F.lit("")) != "")
    )
