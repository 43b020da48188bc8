"""Load newly landed payload files into the vault as they arrive.

The batch build re-reads every dump of a source on each run. Here the Structured Streaming
file source remembers which files it has seen (in its checkpoint), and each micro-batch of
new payloads goes through the same ``Warehouse.build`` (flatten, hubs, links, satellite
loads). ``trigger(availableNow=True)`` processes what is there and stops, so the same code
serves scheduled runs and continuous ones.

Recovery: a micro-batch that fails is re-run by Spark with the same files. The store keeps
a marker per (source, batch id) written after the loads, so a batch that did commit is not
loaded twice; a batch that died mid-way is re-loaded, and the append anti-join keeps that
idempotent.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from satlink.plans.warehouse import Warehouse


def start_landing_loads(spark: SparkSession, warehouse: Warehouse, source: str, landing_dir: str,
                        checkpoint: str, available_now: bool = True, max_files_per_trigger: int | None = None,
                        load_dt: Callable[[int], object] | None = None) -> StreamingQuery:
    """Stream ``landing_dir`` (gzip JSON lines of one source) into the warehouse.

    ``checkpoint`` must be on the shared file system (e.g. under ``spark.checkpoint.dir``).
    ``load_dt(batch_id)`` gives each micro-batch's load time; default: UTC now.
    """
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    payloads = reader.load(landing_dir)

    def load(batch: DataFrame, batch_id: int) -> None:
        marker = f"stream/{source}/{batch_id}"
        if warehouse.store.marked(marker):
            return
        ts = load_dt(batch_id) if load_dt else datetime.now(timezone.utc).replace(tzinfo=None)
        warehouse.build({source: batch}, ts)
        warehouse.store.mark(marker)

    writer = payloads.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
