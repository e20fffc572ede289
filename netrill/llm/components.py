"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netrill.llm.common import written

#: Each round at least halves the longest way to the smallest id of a component.
MOST_ROUNDS = 60


def _shape(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())


def _star(pairs: DataFrame, low: DataFrame) -> DataFrame:
    return pairs.join(low, "u")


def components(links: DataFrame) -> DataFrame:
    """(id, label) of every id in `links` (a, b: bigint); the label is the smallest id it reaches.

    Links live in tables all the time; the driver sees their number and a checksum only.
    Smallest neighbours are found by partial sums, so a hub is no hot key. Links of an id
    with itself and repeated links are allowed; an empty table has no components.
    """
    now = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now = written(now.distinct(), "links")
    shape = _shape(now)
    for _ in range(MOST_ROUNDS):
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v"))
        both = both.unionAll(now.select(F.col("b").alias("u"), F.col("a").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = _star(both.where("v > u"), low).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = _star(large, low).where("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b"))
        small = small.unionAll(low.select(F.col("u").alias("a"), F.col("m").alias("b")))
        now = written(small.where("a <> b").distinct(), "links")
        before, shape = shape, _shape(now)
        if shape == before:
            ids = now.select(F.col("a").alias("id"), F.col("b").alias("label"))
            return ids.unionAll(now.select(F.col("b").alias("id"), F.col("b").alias("label")).distinct())
    raise RuntimeError(f"components didn't settle in {MOST_ROUNDS} rounds")
