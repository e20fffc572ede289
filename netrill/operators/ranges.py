"""Lists of address ranges, and membership of addresses in them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from netrill.functions import addresses


def split_entries(texts: DataFrame, column: str) -> DataFrame:
    """One row per comma-separated entry, trimmed, empty ones skipped."""
    return (
        texts.withColumn("entry", F.explode(F.split(F.col(column), ",")))
        .withColumn("entry", F.trim("entry"))
        .filter(F.col("entry") != "")
    )


def _masked(packed: Column, bits: Column, ones: bool) -> Column:
    """First or last address of a network, byte by byte on the hex text."""
    digits = F.hex(packed)
    size = F.octet_length(packed)

    def byte(index: Column) -> Column:
        value = F.conv(F.substring(digits, index * 2 + 1, F.lit(2)), 16, 10).cast("int")
        kept = F.greatest(F.lit(0), F.least(F.lit(8), bits - index * 8))
        host = (F.pow(F.lit(2), F.lit(8) - kept) - 1).cast("int")
        masked = value.bitwiseOR(host) if ones else value - value.bitwiseAND(host)
        return F.lpad(F.hex(masked), 2, "0")

    parts = F.transform(F.sequence(F.lit(0), size - 1), byte)
    return F.unhex(F.array_join(parts, ""))


def parse_ranges(
    texts: DataFrame, column: str, with_ipv6: bool = True, keep: Sequence[str] = ()
) -> DataFrame:
    """Inclusive ranges ``low``..``high`` of every entry; a bad entry raises.

    An entry is an address, ``first-last`` or ``address/bits``. A range may not
    have more than two ends, hold a network, or run backwards.
    """
    ends = F.filter(
        F.transform(F.split("entry", "-"), lambda part: F.trim(part)), lambda part: F.length(part) > 0
    )
    parts = F.split("entry", "/")
    ranged, network = F.col("entry").contains("-"), F.col("entry").contains("/")
    first = F.when(ranged, F.get("ends", F.lit(0))).otherwise(F.get("parts", F.lit(0)))
    last = F.when(ranged, F.get("ends", F.lit(1))).otherwise(F.get("parts", F.lit(0)))
    known = (
        split_entries(texts, column)
        .withColumn("ends", ends)
        .withColumn("parts", parts)
        .withColumn("first", addresses.packed(first, with_ipv6))
        .withColumn("last", addresses.packed(last, with_ipv6))
        .withColumn("bits", F.when(network, F.get("parts", F.lit(1)).try_cast("int")))
    )
    size = F.octet_length("first")
    problem = (
        F.when(ranged & (F.size("ends") != 2), "a range needs two ends")
        .when(ranged & network, "a network inside a range")
        .when(F.col("first").isNull() | F.col("last").isNull(), "not an ip address")
        .when(
            network & ((F.size("parts") != 2) | F.col("bits").isNull() | (F.col("bits") < 0)),
            "not a network",
        )
        .when(network & (F.col("bits") > size * 8), "not a network")
        .when(
            (size > F.octet_length("last"))
            | ((size == F.octet_length("last")) & (F.col("first") > F.col("last"))),
            "begin must not be after end",
        )
    )
    message = F.concat(F.lit("invalid address range '"), F.col("entry"), F.lit("': "), problem)
    # Raising inside the value keeps the check from being optimised away.
    checked = F.when(problem.isNotNull(), F.raise_error(message).cast("binary"))
    low = F.when(network, _masked(F.col("first"), F.col("bits"), False)).otherwise(F.col("first"))
    high = F.when(network, _masked(F.col("last"), F.col("bits"), True)).otherwise(F.col("last"))
    return known.select(
        *keep,
        "entry",
        F.coalesce(checked, low).alias("low"),
        F.coalesce(checked, high).alias("high"),
    )


def configured_ranges(spark: SparkSession, considered_hosts: str) -> DataFrame:
    """Ranges of a run option; as small as that text."""
    text = spark.range(1).select(F.lit(considered_hosts).alias("text"))
    return parse_ranges(text, "text")


def _digits(packed: Column) -> Column:
    """Hexadecimal digits; addresses of one length sort by them as they do by value."""
    return F.hex(packed)


def merged(ranges: DataFrame) -> DataFrame:
    """The same addresses as ranges that neither overlap nor touch the same address.

    A range that goes from four-byte to sixteen-byte addresses is cut in two.
    """
    low, high = F.octet_length("low"), F.octet_length("high")
    pieces = F.array(
        F.when(low == high, F.struct("low", "high")),
        F.when(low < high, F.struct("low", F.unhex(F.lit("F" * 8)).alias("high"))),
        F.when(low < high, F.struct(F.unhex(F.lit("0" * 32)).alias("low"), "high")),
    )
    cut = ranges.select(F.explode(F.array_compact(pieces)).alias("piece")).select("piece.*")
    cut = cut.select(
        F.octet_length("low").alias("size"), _digits(F.col("low")).alias("low"), _digits(F.col("high")).alias("high")
    )
    order = Window.partitionBy("size").orderBy("low", "high")
    reached = F.max("high").over(order.rowsBetween(Window.unboundedPreceding, -1))
    begins = F.when(reached.isNull() | (F.col("low") > reached), 1).otherwise(0)
    numbered = cut.withColumn("begins", begins).withColumn("number", F.sum("begins").over(order))
    return numbered.groupBy("size", "number").agg(F.min("low").alias("low"), F.max("high").alias("high")).drop("number")


def indexed(ranges: DataFrame) -> DataFrame:
    """Disjoint ranges under the bytes that all of their addresses begin with.

    As they are disjoint, at most 255 ranges share a prefix: each holds the end of another
    next byte. So an address meets few ranges however many there are.
    """
    disjoint = merged(ranges)
    same = F.filter(
        F.sequence(F.lit(0), F.col("size")),
        lambda n: F.col("low").substr(F.lit(1), n * 2) == F.col("high").substr(F.lit(1), n * 2),
    )
    return disjoint.withColumn("prefix", F.col("low").substr(F.lit(1), F.array_max(same) * 2))


def addresses_in(rows: DataFrame, address: str, ranges: DataFrame) -> DataFrame:
    """The different texts of a column whose address lies in any range.

    Every address is looked up under each of its prefixes, in a join on equal prefixes.
    """
    packed = rows.select(F.col(address).alias("text")).distinct().withColumn("packed", addresses.packed(F.col("text")))
    known = packed.filter(F.col("packed").isNotNull()).select(
        "text", F.octet_length("packed").alias("size"), _digits(F.col("packed")).alias("digits")
    )
    prefixes = F.transform(F.sequence(F.lit(0), F.col("size")), lambda n: F.col("digits").substr(F.lit(1), n * 2))
    keyed = known.withColumn("prefix", F.explode(prefixes))
    held = keyed.join(indexed(ranges), ["size", "prefix"])
    return held.filter((F.col("low") <= F.col("digits")) & (F.col("digits") <= F.col("high"))).select("text").distinct()


def in_ranges(
    rows: DataFrame, address: str, ranges: DataFrame, others: Column | None = None
) -> DataFrame:
    """Rows whose address lies in any range, and those for which ``others`` holds."""
    held = addresses_in(rows, address, ranges).select(F.col("text").alias("_held"))
    if others is None:
        return rows.join(held, F.col(address) == F.col("_held"), "left_semi")
    marked = rows.join(held, F.col(address) == F.col("_held"), "left")
    return marked.filter(others | F.col("_held").isNotNull()).drop("_held")
