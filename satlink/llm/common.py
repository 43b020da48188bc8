"""Helpers shared by the corpus operators: table readers, the work folder, Arrow text as numpy bytes."""

from __future__ import annotations

import atexit
import ctypes
import gc
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from satlink.session import work_root

#: Rows in an Arrow batch sent to Python: whole texts are long, so batches stay small.
ARROW_ROWS = 256
#: Bytes of text that the numpy code works on at once (a longer text is taken alone, whole).
SLICE_BYTES = (2 << 20) - 1024
_VECTORED = "parquet.hadoop.vectored.io.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the corpus. Vectored reads are off: they hold whole column chunks of text outside the heap."""
    return spark.read.option(_VECTORED, "false").parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def python_tasks(spark: SparkSession) -> None:
    """Prepare for Python tasks: executors get this package, Arrow batches a bound, reads no buffers outside the heap.

    Settings made by the user stay, batches larger than ``ARROW_ROWS`` apart.
    """
    if spark.conf.get(_VECTORED, None) is None:
        spark.conf.set(_VECTORED, "false")
    sc = spark.sparkContext
    if not getattr(sc, "_satlink_shipped", False):
        package = Path(__file__).resolve().parents[1]
        folder = tempfile.mkdtemp(prefix="satlink-code-")  # the driver's; Spark serves it to the executors
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        path = f"{folder}/satlink-{uuid.uuid4().hex[:8]}.zip"
        with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
            for file in sorted(package.rglob("*.py")):
                z.write(file, file.relative_to(package.parent))
        sc.addPyFile(path)
        sc._satlink_shipped = True
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key, "10000"))
    if now <= 0 or now > ARROW_ROWS:
        spark.conf.set(key, str(ARROW_ROWS))


#: What a Python worker keeps between tasks: operator -> how to drop it. Spark hands a worker from stage to stage.
_kept: dict[str, Callable[[], None]] = {}


def keeps(operator: str, drop: Callable[[], None]) -> None:
    """Tell that ``operator`` keeps something in this worker for its next tasks (caches, models, databases)."""
    _kept[operator] = drop


def give_back() -> None:
    """Return freed memory to the system, which the allocators of Arrow and C would keep for the worker's next task."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another C library


def task(operator: str, run: Callable) -> Callable:
    """A Python task of an operator: first drops what other operators keep in the worker, at its end gives memory back."""

    def begin_and_end(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        others = [o for o in _kept if o != operator]
        for other in others:
            _kept.pop(other)()
        if others:
            gc.collect()
            give_back()
        yield from run(batches)
        give_back()

    return begin_and_end


def work_dir(spark: SparkSession, label: str) -> str:
    """A new folder in the folder that all executors share."""
    return f"{work_root(spark)}/llm/{label}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Cut lineage by checkpoint() into the shared folder."""
    work_root(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, label: str, codec: str = "zstd") -> DataFrame:
    """Write as Parquet to the shared folder and read it back."""
    spark = df.sparkSession
    path = work_dir(spark, label)
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_bytes(docs: DataFrame, column: str = "text") -> int:
    """UTF-8 bytes of all texts: sizes the number of partitions and buckets."""
    row = docs.agg(F.sum(F.octet_length(F.col(column)).cast("long")).alias("n")).first()
    return int(row["n"] or 0)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow string column; null counts as empty. offsets has one more entry than rows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_binary()) if not pa.types.is_large_string(column.type) else column
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, ends, data = column.buffers()
    offsets = np.frombuffer(ends, np.int64)[column.offset : column.offset + n + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batches: Iterable[pa.RecordBatch], column: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each holds about ``most`` bytes of text, or a single row."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        _, offsets = utf8(batch.column(column))
        at = 0
        while at < batch.num_rows:
            to = int(np.searchsorted(offsets, offsets[at] + most, side="right")) - 1
            to = min(max(to, at + 1), batch.num_rows)
            yield batch.slice(at, to - at)
            at = to


def merged(batches: Iterable[pa.RecordBatch], column: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Join small batches into batches of about ``most`` bytes of text, then cut what is larger."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if batch.num_rows == 0:
            continue
        held.append(batch)
        size += batch.column(column).nbytes
        if size >= most:
            yield from slices(pa.Table.from_batches(held).combine_chunks().to_batches(), column, most)
            held, size = [], 0
    if held:
        yield from slices(pa.Table.from_batches(held).combine_chunks().to_batches(), column, most)


class TwoGenerations(dict):
    """Cache with a bound: when full, the entries become the old generation and a new one starts.

    A hit in the old generation moves the entry to the new one, so frequent keys stay.
    """

    def __init__(self, most: int):
        super().__init__()
        self.most, self.old = most, {}

    def __missing__(self, key):
        value = self.old[key]
        self[key] = value
        return value

    def turn(self) -> None:
        """Call between batches."""
        if len(self) > self.most:
            self.old = dict(self)
            self.clear()

    def lacking(self, keys: set) -> list:
        """Keys in neither generation; all others are in the new one afterwards."""
        out = []
        old = self.old
        for key in keys:
            if key not in self:
                if key in old:
                    self[key] = old[key]
                else:
                    out.append(key)
        return out


def plan_bytes(df: DataFrame) -> int:
    """Spark's size estimate of a DataFrame (for a table scan: its files), without a job.

    Where Spark has no estimate (it then takes the largest number) the texts are counted.
    """
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return size if size < 1 << 60 else text_bytes(df)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or one made from it that no column has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name
