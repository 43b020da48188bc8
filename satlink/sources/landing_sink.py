"""Landing with exactly-once batches: a folder per source and load date, a commit marker per batch.

Layout under ``root``::

    <source>/load_date=<yyyy-MM-dd>/<batch>-<attempt>/part-*.parquet   landing_key, value, metadata
    _batches/<source>/<batch>/<load_date>.<attempt>                    the batch is committed

A batch is written by one Spark job into a folder of its own attempt, and counts once its marker
stands. So a job that dies before the marker leaves nothing visible, its retry writes a new
attempt, landing a batch again is a no-op, and of two attempts that commit at once the first by
name counts for every reader. Objects are never rewritten. Payloads are stored whole, as text
(gzip inside Parquet: files split, and a reader of keys or dates does not read payloads).

``batch_id`` is whatever names the batch for its producer: an extractor's run, or the number of a
Structured Streaming micro-batch (``sink.land(df, source, load_dt, batch_id=str(n))`` in
``foreachBatch``), which Spark repeats after a failure.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from satlink.sources.landing import landing_key

_NAME = re.compile(r"^[A-Za-z0-9_=+.]+$")
SCHEMA = "landing_key string, value string, metadata map<string,string>, load_date date"


class LandingSink:
    def __init__(self, spark: SparkSession, root: str):
        """``root``: a permanent folder that all executors share."""
        self.spark, self.root = spark, root.rstrip("/")

    def _fs(self, path: str):
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def _names(self, path: str) -> list[str]:
        fs, p = self._fs(path)
        return sorted(st.getPath().getName() for st in fs.listStatus(p)) if fs.exists(p) else []

    def _committed(self, source: str, batch_id: str) -> str | None:
        """``<load_date>.<attempt>`` of a landed batch."""
        return next(iter(self._names(f"{self.root}/_batches/{source}/{batch_id}")), None)

    def batches(self, source: str) -> dict[str, str]:
        """Landed batches of a source and their folders."""
        out = {}
        for batch in self._names(f"{self.root}/_batches/{source}"):
            date, attempt = self._committed(source, batch).split(".", 1)
            out[batch] = f"{self.root}/{source}/load_date={date}/{batch}-{attempt}"
        return out

    def land(self, df: DataFrame, source: str, load_dt, batch_id: str, payload: str = "value",
             key: Column | None = None, metadata: dict[str, Column] | None = None) -> bool:
        """Land one batch of payloads; False when it had been landed before.

        ``key``: the object key of each payload; by default ``landing_key(source, load_dt)`` over the
        request columns of ``df``. ``metadata`` adds to the ``source`` tag that every object has.
        """
        if not _NAME.match(batch_id):
            raise ValueError("a batch id has letters, digits and _ = + . only")
        if self._committed(source, batch_id) is not None:
            return False
        at = str(load_dt)
        date, attempt = at[:10], uuid.uuid4().hex
        tags = {"source": F.lit(source), **(metadata or {})}
        key = landing_key(source, F.lit(at).cast("timestamp")) if key is None else key
        rows = df.select(key.alias("landing_key"), F.col(payload).cast("string").alias("value"),
                         F.create_map(*[x for k, v in tags.items() for x in (F.lit(k), v.cast("string"))]).alias("metadata"))
        rows.write.mode("errorifexists").option("compression", "gzip").parquet(f"{self.root}/{source}/load_date={date}/{batch_id}-{attempt}")
        self._commit(source, batch_id, date, attempt)
        return True

    def _commit(self, source: str, batch_id: str, date: str, attempt: str) -> None:
        fs, p = self._fs(f"{self.root}/_batches/{source}/{batch_id}/{date}.{attempt}")
        fs.mkdirs(p)

    def read(self, source: str, dates: set[str] | None = None, batches: set[str] | None = None) -> DataFrame:
        """Landed objects (of some load dates or batches): landing_key, value, metadata, load_date."""
        paths = [p for b, p in self.batches(source).items()
                 if (batches is None or b in batches) and (dates is None or p.split("load_date=")[1][:10] in dates)]
        if not paths:
            return self.spark.createDataFrame([], SCHEMA)
        return self.spark.read.schema(SCHEMA).option("basePath", f"{self.root}/{source}").parquet(*paths)

    def sweep(self, source: str) -> list[str]:
        """Delete attempts that never committed; only while no batch of the source is being landed."""
        kept = set(self.batches(source).values())
        gone = []
        for date in self._names(f"{self.root}/{source}"):
            for name in self._names(f"{self.root}/{source}/{date}"):
                path = f"{self.root}/{source}/{date}/{name}"
                if path not in kept:
                    fs, p = self._fs(path)
                    fs.delete(p, True)
                    gone.append(path)
        return gone
