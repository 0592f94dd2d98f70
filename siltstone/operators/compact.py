"""Compaction: small or worn fragments are rewritten together."""

from __future__ import annotations

import logging
from dataclasses import dataclass, replace
from typing import Any

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from siltstone.manifest import Snapshot, commit
from siltstone.operators.evolve import rewrite
from siltstone.plans.layout import CompactionOptions, compaction_bins
from siltstone.sources.scan import located
from siltstone.table import Table, open_table


log = logging.getLogger("siltstone")


@dataclass(frozen=True)
class CompactionMetrics:
    fragments_removed: int
    fragments_added: int


def compact_files(dataset: Table | str, compaction_options: CompactionOptions | dict[str, Any] | None = None, num_workers: int = 4, storage_options: dict[str, Any] | None = None, spark: SparkSession | None = None) -> CompactionMetrics | None:
    """Rewrites bins of neighbouring fragments in one job and commits once; None if there is nothing to do.

    Rows keep their order within a bin. Row addresses change, so rewritten fragments leave the indices' coverage
    and are scanned until the index is built anew.
    """
    if num_workers <= 0:
        raise ValueError(f"num_workers must be positive, got {num_workers}")
    table = open_table(dataset, spark=spark, storage_options=storage_options) if isinstance(dataset, str) else dataset
    spark, store, base = table.spark, table.store, table.refresh().snapshot
    options = compaction_options if isinstance(compaction_options, CompactionOptions) else CompactionOptions(**(compaction_options or {}))
    bins = compaction_bins(base.fragments, options)
    if not bins:
        return None
    old = [f for b in bins for f in b]
    which = spark.createDataFrame([(f.id, k) for k, b in enumerate(bins) for f in b], "_fragment bigint, _bin int")
    rows = located(spark, store, base, old).join(F.broadcast(which), "_fragment")  # one row a fragment
    files = rewrite(rows, store, base.schema, "_bin", range(len(bins)), options.target_rows_per_fragment)
    log.info("compaction: %d fragments in %d bins", len(old), len(bins))
    gone, added = {f.id for f in old}, [f for k in range(len(bins)) for f in files.get(k, [])]

    def change(now: Snapshot) -> Snapshot:
        new = tuple(replace(f, id=now.next_fragment + k) for k, f in enumerate(added))
        kept = tuple(f for f in now.fragments if f.id not in gone)
        indices = tuple(replace(i, fragments=tuple(x for x in i.fragments if x not in gone)) for i in now.indices)
        return replace(now, fragments=(*kept, *new), next_fragment=now.next_fragment + len(new), indices=indices)

    commit(store, base, "rewrite", change, tuple(sorted(gone)))
    table.refresh()
    return CompactionMetrics(len(gone), len(added))
