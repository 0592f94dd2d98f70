"""B-tree index: sorted pages of (value, fragment, row), range-partitioned so that pages don't overlap."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.manifest import Index
from siltstone.plans.prune import Range
from siltstone.storage import Store


def build(rows: DataFrame, column: str, pages: int) -> DataFrame:
    """Entries to be written, a sorted page a partition. Lists give an entry for each element; nulls have none."""
    is_list = rows.schema[column].dataType.typeName() == "array"
    value = F.explode(F.col(f"`{column}`")) if is_list else F.col(f"`{column}`")
    entries = rows.select(value.alias("value"), "_fragment", "_row").where("value is not null")
    return entries.repartitionByRange(pages, "value").sortWithinPartitions("value")


def fragments_with(spark: SparkSession, store: Store, index: Index, wanted: Range) -> set[int]:
    """Covered fragments that hold a value in the range; only pages whose bounds meet it are read."""
    pages = [p["path"] for p in index.files if "min" not in p or wanted.meets(p["min"], p["max"])]
    if not pages:
        return set()
    entries = spark.read.options(**store.options).parquet(*[store.path(p) for p in pages])
    if wanted.low is not None:
        entries = entries.where(F.col("value") > wanted.low if wanted.low_open else F.col("value") >= wanted.low)
    if wanted.high is not None:
        entries = entries.where(F.col("value") < wanted.high if wanted.high_open else F.col("value") <= wanted.high)
    return {r[0] for r in entries.select("_fragment").distinct().collect()}  # fragment ids
