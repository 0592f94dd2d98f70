"""Shared plumbing: checkpoints, document views and connected components."""

from __future__ import annotations

import os
import tempfile
import uuid
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Keys that hold more than this fraction of all rows are fewer than this, so they can be broadcast.
HEAVY = 1000


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the folder named by ``spark.checkpoint.dir``; make one only where none is set."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None and not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="siltstone-checkpoint-"))


def cut(df: DataFrame) -> DataFrame:
    """The rows as a table in the shared checkpoint folder: lineage is cut, and lost executors don't matter.

    Unlike a checkpoint, a table tells the planner its true size.  (A checkpoint keeps the estimate of its plan; in
    rounds of joins that estimate is a product that soon takes longer to compute than the join.)
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/cut-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def importable(spark: SparkSession) -> None:
    """Let Python workers started outside the repository's folder import this package, as they can where it is installed."""
    env, root = spark.sparkContext.environment, str(Path(__file__).resolve().parents[2])
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])


def view(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only ``_id`` and ``_text`` (null text: empty), whatever else the table holds."""
    importable(df.sparkSession)
    return df.select(df[id_col].alias("_id"), F.coalesce(df[text_col], F.lit("")).alias("_text"))


def crc_remainder(column: Column, modulus: int) -> Column:
    """crc32 of the value as text, modulo ``modulus``; a null value counts as the text ''."""
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % modulus


def null_safe(left: DataFrame, right: DataFrame, keys: list[tuple[str, str]]) -> Column:
    """Join condition in which nulls equal each other."""
    out = None
    for a, b in keys:
        one = left[a].eqNullSafe(right[b])
        out = one if out is None else out & one
    return out


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def spread_join(many: DataFrame, few: DataFrame, keys: list[str], count: str, total: int) -> DataFrame:
    """Inner join with ``few`` (one row a key, keys not null) in which no key's rows gather in one task.

    ``count``: the column of ``few`` that tells how many rows of ``many`` hold the key; ``total``: a bound of their sum.
    A key that holds more than a ``HEAVY``-th of all rows is one of fewer than ``HEAVY``, so these are
    broadcast, and their rows pass the shuffle for the others under salts.
    """
    limit, values = total // HEAVY, [c for c in few.columns if c not in keys]
    heavy = few.where(F.col(count) > limit).select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.struct(*values).alias("_heavy"))
    # zero, in a form that the optimizer doesn't fold: a literal would turn the salt into a filter and leave the keys alone to the shuffle
    none = F.least(F.lit(0), F.col(count)).cast("int")
    others = few.where(F.col(count) <= limit).select(*keys, none.alias("_salt"), F.struct(*values).alias("_other"))
    on = None
    for i, k in enumerate(keys):
        one = F.col(k) == F.col(f"_k{i}")
        on = one if on is None else on & one
    marked = many.join(F.broadcast(heavy), on, "left")
    salt = F.when(F.col("_heavy").isNotNull(), F.pmod(F.xxhash64(*many.columns), F.lit(1 << 20)) + 1).otherwise(0).cast("int")
    out = marked.withColumn("_salt", salt).join(others, [*keys, "_salt"], "left").withColumn("_found", F.coalesce("_heavy", "_other"))
    return out.where("_found is not null").select(*many.columns, "_found.*")


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Smallest reachable node of every node that has an edge.

    ``edges`` has columns ``a`` and ``b`` of an orderable type; self edges are
    ignored, direction and repeats do not matter.  Returns ``node, component``
    (``component`` is never above ``node``).  Alternates large-star and
    small-star rewrites (Kiveris et al. 2014), all as DataFrame operations; every round is
    checkpointed, and only two counters reach the driver.  A star's centre is looked up by
    ``spread_join``, so its edges don't gather.  An empty input gives an empty result.
    """

    def digest(df: DataFrame):
        return df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    # each edge as a > b
    e = edges.where("a is not null and b is not null and a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    e = cut(e)
    was = digest(e)
    for _ in range(max_rounds):
        if not was[0]:
            break
        # large star: every larger neighbour of a node is tied to the least of its closed neighbourhood
        both = e.select("a", "b").union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("_m"), F.count("*").alias("_n"))
        large = spread_join(both, least, ["a"], "_n", 2 * was[0]).where("b > a").select(F.col("b").alias("a"), F.col("_m").alias("b")).where("a <> b").distinct()
        # small star: every smaller neighbour of a node, and the node, are tied to the least of them
        least = large.groupBy("a").agg(F.min("b").alias("_m"), F.count("*").alias("_n"))
        small = spread_join(large, least, ["a"], "_n", was[0]).select(F.explode(F.array(F.struct(F.col("b").alias("x"), F.col("_m").alias("y")), F.struct(F.col("a").alias("x"), F.col("_m").alias("y")))).alias("s")).select(F.col("s.x").alias("a"), F.col("s.y").alias("b")).where("a <> b").distinct()
        e = cut(small)
        now = digest(e)
        if now == was:
            break
        was = now
    else:
        raise RuntimeError("components did not converge")
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")).union(e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def arrow_type(df: DataFrame, name: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(df.schema[name].dataType)


def extended(df: DataFrame, more: str) -> T.StructType:
    """The schema of ``df`` and some columns more; names need no quoting, in nested types either."""
    return T.StructType([*df.schema.fields, *T.StructType.fromDDL(more).fields])
