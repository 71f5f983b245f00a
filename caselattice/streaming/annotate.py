"""Annotating case files as they arrive: an extension over the batch operators, without state."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from caselattice import schema
from caselattice.operators import retrieval


def annotate_cases(spark: SparkSession, folder: str, out: str, checkpoint: str, search: Callable[[DataFrame], DataFrame], *, once: bool = True) -> StreamingQuery:
    """Reads JSON lines of cases below ``folder`` and writes one audit row per searched row to ``out``.

    ``search`` takes (id, row_index, query) and returns audits. Each micro-batch is a batch plan over a static index; a
    batch that is run again overwrites its own folder, so the sink holds every batch once.
    """

    def one(batch: DataFrame, number: int) -> None:
        queries = retrieval.context_queries(retrieval.long_rows(batch))
        search(queries).write.mode("overwrite").parquet(f"{out}/batch={number}")

    stream = spark.readStream.schema(schema.CASES).json(folder)
    writer = stream.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
