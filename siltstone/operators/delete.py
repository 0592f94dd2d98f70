"""Deletion vectors: rows are hidden, files stay."""

from __future__ import annotations

import uuid
from dataclasses import replace

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from siltstone.manifest import Snapshot, commit
from siltstone.sources.scan import choose, located
from siltstone.storage import Store


def delete_rows(spark: SparkSession, store: Store, base: Snapshot, predicate: str) -> Snapshot:
    """Hides the rows for which the predicate is true (not null); a fragment without rows left goes.

    Addresses of the rows are written once as a small table; statistics and indices choose the
    fragments to look at. No match: no new version.
    """
    fragments = choose(spark, store, base, predicate)
    folder = f"_deletions/{uuid.uuid4().hex}"
    hits = located(spark, store, base, fragments).where(F.expr(predicate)).select("_fragment", "_row")
    try:
        hits.write.options(**store.options).parquet(store.path(folder))
        counts = {r[0]: r[1] for r in spark.read.schema("_fragment bigint, _row bigint").parquet(store.path(folder)).groupBy("_fragment").count().collect()}
        if not counts:
            store.remove(folder)
            return base

        def change(now: Snapshot) -> Snapshot:
            left = [replace(f, deletions=(*f.deletions, folder), deleted=f.deleted + counts[f.id]) if f.id in counts else f for f in now.fragments]
            kept = tuple(f for f in left if f.live)
            ids = {f.id for f in kept}
            indices = tuple(replace(i, fragments=tuple(x for x in i.fragments if x in ids)) for i in now.indices)
            return replace(now, fragments=kept, indices=indices)

        return commit(store, base, "delete", change, tuple(sorted(counts)))
    except BaseException:
        store.remove(folder)
        raise
