"""Rows of a stream kept as parquet, by time slot and batch.

``slot=S/batch=N`` holds what batch N brought for a slot of window ends. A
batch that runs again replaces exactly its own folders. Readers list only the
slots they need, so old slots cost nothing and may be deleted at any time
after the allowed lateness.

The same folders also hold versions: there ``slot=S/batch=N`` is all of a slot as it is after
batch N. The newest version is the slot; the one before it is kept for a batch that runs
again and for readers on their way, older ones are removed.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

SLOT_MS = 10 * 60_000


def write_slots(rows: DataFrame, path: str, batch_id: int, time: str = "window_end", kind: str | None = None) -> None:
    """Store rows by slot; with ``kind`` a folder of slots for each value of that column."""
    slot = F.call_function("div", F.col(time), F.lit(SLOT_MS))
    batch = F.lit(batch_id).cast("bigint")
    (
        rows.withColumn("slot", slot)
        .withColumn("batch", batch)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*([kind] if kind else []), "slot", "batch")
        .parquet(path)
    )


def _numbers(spark: SparkSession, path: str, kind: str) -> list[int]:
    """The slots or batches there are, from the names of folders."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(folder):
        return []
    names = [entry.getPath().getName() for entry in system.listStatus(folder)]
    return [int(name.removeprefix(f"{kind}=")) for name in names if name.startswith(f"{kind}=")]


def _slots(spark: SparkSession, path: str) -> list[int]:
    return _numbers(spark, path, "slot")


def written_slots(spark: SparkSession, path: str, batch_id: int) -> list[int]:
    """The slots that a batch has written."""
    return [slot for slot in _slots(spark, path) if batch_id in _numbers(spark, f"{path}/slot={slot}", "batch")]


def newest(spark: SparkSession, path: str, slots: list[int] | None = None, before: int | None = None) -> dict[int, int]:
    """The last version of each slot, or the last one before a batch."""
    found = {}
    for slot in _slots(spark, path) if slots is None else slots:
        batches = [n for n in _numbers(spark, f"{path}/slot={slot}", "batch") if before is None or n < before]
        if batches:
            found[slot] = max(batches)
    return found


def read_versions(spark: SparkSession, schema: T.StructType, path: str, versions: dict[int, int]) -> DataFrame:
    """Rows of the given version of each slot, without slot and batch."""
    wanted = [f"{path}/slot={slot}/batch={batch}" for slot, batch in sorted(versions.items())]
    return spark.read.schema(schema).parquet(*wanted) if wanted else spark.createDataFrame([], schema)


def remove_before(spark: SparkSession, path: str, versions: dict[int, int]) -> None:
    """Remove what is older than the given version of a slot."""
    for slot, kept in versions.items():
        for batch in _numbers(spark, f"{path}/slot={slot}", "batch"):
            if batch < kept:
                folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/slot={slot}/batch={batch}")
                folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def slots_of_several(spark: SparkSession, path: str, until_batch: int) -> list[int]:
    """The slots that more than one batch, up to the given one, has written."""
    found = []
    for slot in _slots(spark, path):
        batches = [n for n in _numbers(spark, f"{path}/slot={slot}", "batch") if n <= until_batch]
        if len(batches) > 1:
            found.append(slot)
    return found


PARTS = [T.StructField(name, T.LongType()) for name in ("slot", "batch")]


def _read(spark: SparkSession, schema: T.StructType, path: str, folders: list[str]) -> DataFrame:
    full = T.StructType([*schema.fields, *PARTS])
    if not folders:
        return spark.createDataFrame([], full)
    return spark.read.schema(full).option("basePath", path).parquet(*folders)


def read_batch(spark: SparkSession, schema: T.StructType, path: str, batch_id: int) -> DataFrame:
    """What a batch has written, with slot and batch."""
    slots = sorted(written_slots(spark, path, batch_id))
    return _read(spark, schema, path, [f"{path}/slot={slot}/batch={batch_id}" for slot in slots])


def read_until(
    spark: SparkSession, schema: T.StructType, path: str, slots: Iterable[int], until_batch: int
) -> DataFrame:
    """Rows of the given slots, of batches up to the given one, with slot and batch."""
    found = _read(spark, schema, path, [f"{path}/slot={slot}" for slot in sorted(slots)])
    return found.filter(F.col("batch") <= until_batch)


def read_slots(
    spark: SparkSession, schema: T.StructType, path: str, first_ms: int, last_ms: int, until_batch: int
) -> DataFrame:
    """Rows of the slots that hold window ends from ``first_ms`` to ``last_ms``."""
    first, last = first_ms // SLOT_MS, last_ms // SLOT_MS
    wanted = [slot for slot in _slots(spark, path) if first <= slot <= last]
    return read_until(spark, schema, path, wanted, until_batch)
