"""A streaming sink: each micro-batch is one atomic append."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from siltstone.manifest import committed, versions
from siltstone.operators.write import write_table
from siltstone.storage import Store


def append_stream(stream: DataFrame, uri: str, checkpoint: str, trigger: dict[str, Any] | None = None, **write_options: Any) -> StreamingQuery:
    """Starts a query that appends to the table, and makes it with the first non-empty batch.

    A batch's version carries the query's checkpoint and the batch's number, so a batch that is
    repeated after a failure between commit and checkpoint is not written twice.
    """

    def put(batch: DataFrame, number: int) -> None:
        store, name = Store(uri, batch.sparkSession), f"{checkpoint}#{number}"
        if batch.isEmpty() or committed(store, name):
            return
        write_table(batch, uri, spark=batch.sparkSession, mode="append" if versions(store) else "create", transaction=name, **write_options)

    writer = stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint)
    return (writer.trigger(**trigger) if trigger else writer).start()
