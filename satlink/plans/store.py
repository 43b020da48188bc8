"""Snapshot store for vault tables on any Hadoop-compatible file system.

Layout per table: ``<root>/<table>/<NNNNNNNN>-<kind>`` folders, each a plain Parquet
dataset written by one Spark job, optionally partitioned by a bucket column (``<col>=<v>``
sub-folders). A folder counts only once Spark's commit has written ``_SUCCESS``, so a job
that dies mid-write leaves the previous state readable and is simply retried.

Kinds, applied oldest to newest from the newest complete ``base``:

* ``base``  — the whole table (``table`` materialisation, compaction, big upserts);
* ``delta`` — rows appended to the buckets it contains (append loads, new hub keys);
* ``patch`` — replaces the buckets it contains (upserts that touch few buckets), so an
  upsert rewrites the touched buckets instead of the whole table;
* ``merge`` — rows that replace every older row of their key (merge-on-read): an upsert writes
  only its batch, and ``read`` leaves out what newer merges replaced, by one anti-join with the
  keys of the merges, only in buckets that have some. A merge may also delete keys;
* ``fold``  — the same rows as before, resolved, for the buckets it contains: what ``fold`` writes
  when merges have piled up. Nothing derived from the table needs to follow it. A bucket that it
  holds cut finer (its name is the beginning of theirs) is replaced by those: a split.

One writer per table: two writers that start from the same state would take the same version.
Nothing is ever written over a folder that is being read. Reads go back to the files, so
every write also cuts the lineage of what follows. ``vacuum`` drops segments that only
older bases needed.
"""

from __future__ import annotations

import re
import uuid

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructType

from satlink.operators.packing import _hashes, packed, packed_text, unpacked
from satlink.session import work_root

_SEG = re.compile(r"^(\d{8})-(base|delta|patch|merge|fold)$")
_ALL = "*"
#: Marks the rows of a merge segment that delete their key; never part of what ``read`` returns.
GONE = "__gone"
#: Hexadecimal hashes, most of a vault's bytes, take half their length in it.
COMPRESSION = "zstd"
#: Sizes are given as of files in Parquet's usual compression, which are about twice as long, so
#: that buckets and periods hold as many rows as their targets in bytes have always stood for.
USUAL_LENGTH = 2


class VaultStore:
    def __init__(self, spark: SparkSession, root: str | None = None):
        """``root``: a permanent shared folder; by default one in Spark's warehouse folder.

        Intermediate copies of a load go to the work folder (``spark.checkpoint.dir``) instead.
        """
        self.spark = spark
        self.root = (root or f"{spark.conf.get('spark.sql.warehouse.dir')}/satlink_vault").rstrip("/")
        self.scratch = f"{work_root(spark)}/satlink/scratch/{uuid.uuid4().hex}"

    # -- file system ----------------------------------------------------------------
    def _fs_path(self, path: str):
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        fs = p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        return fs, p

    def _list(self, table: str) -> list[tuple[int, str, bool]]:
        """(version, kind, complete) of every segment folder, oldest first."""
        fs, p = self._fs_path(f"{self.root}/{table}")
        if not fs.exists(p):
            return []
        out = []
        for st in fs.listStatus(p):
            m = _SEG.match(st.getPath().getName())
            if st.isDirectory() and m:
                done = fs.exists(st.getPath().suffix("/_SUCCESS"))
                out.append((int(m.group(1)), m.group(2), bool(done)))
        return sorted(out)

    def _leaves(self, seg_path: str) -> dict[str, str]:
        """bucket value -> folder; an unbucketed segment maps ``*`` to itself, an empty one
        (a load that inserted nothing) maps nothing."""
        fs, p = self._fs_path(seg_path)
        leaves, has_files = {}, False
        for st in fs.listStatus(p):
            name = st.getPath().getName()
            if st.isDirectory() and "=" in name:
                leaves[name.split("=", 1)[1]] = f"{seg_path}/{name}"
            elif st.isFile() and not name.startswith(("_", ".")):
                has_files = True
        if leaves:
            return leaves
        return {_ALL: seg_path} if has_files else {}

    def segments(self, table: str, as_of: int | None = None) -> list[tuple[str, str]]:
        """(kind, path) of the complete segments making up the current state, or that of version ``as_of``."""
        segs = [s for s in self._list(table) if s[2] and (as_of is None or s[0] <= as_of)]
        base_idx = max((i for i, s in enumerate(segs) if s[1] == "base"), default=None)
        if base_idx is None:
            return []
        return [(k, f"{self.root}/{table}/{v:08d}-{k}") for v, k, _ in segs[base_idx:]]

    def _state(self, table: str, buckets: set[str] | None = None, as_of: int | None = None) -> dict[str, list[tuple[str, str]]]:
        """bucket -> (kind, folder) of the segments that hold its rows, oldest first."""
        current: dict[str, list[tuple[str, str]]] = {}
        for kind, path in self.segments(table, as_of):
            leaves = self._leaves(path)
            if kind == "base":
                current = {b: [(kind, p)] for b, p in leaves.items()}
            elif kind in ("delta", "merge"):
                for b, p in leaves.items():
                    current.setdefault(b, []).append((kind, p))
            else:  # patch, fold: their buckets replace what was there
                for b, p in leaves.items():
                    current[b] = [(kind, p)]
                    for i in range(1, len(b)) if kind == "fold" else ():
                        current.pop(b[:i], None)  # it was split
        if buckets is None:
            return dict(sorted(current.items()))
        # A bucket may since have been split, or have been whole before: names that begin alike hold the same keys.
        begins = {b[:i] for b in buckets for i in range(1, len(b))}
        return {b: ps for b, ps in sorted(current.items())
                if b == _ALL or b in buckets or b in begins or any(b[:i] in buckets for i in range(1, len(b)))}

    def paths(self, table: str, buckets: set[str] | None = None) -> list[str]:
        """Folders holding the current rows (of ``buckets`` only, when given)."""
        return [p for ps in self._state(table, buckets).values() for _, p in ps]

    def buckets(self, table: str) -> set[str]:
        return set(self._state(table)) - {_ALL}

    def bucket_bytes(self, table: str, buckets: set[str] | None = None) -> dict[str, int]:
        """Bytes (in usual compression) of the buckets (their own names only) with all that reads of them take in."""
        out = {}
        for b, ps in self._state(table).items():
            if buckets is None or b in buckets:
                out[b] = USUAL_LENGTH * sum(fs.getContentSummary(p).getLength() for fs, p in (self._fs_path(path) for _, path in ps))
        return out

    def exists(self, table: str) -> bool:
        return bool(self.segments(table))

    # -- read / write -----------------------------------------------------------------
    def read(self, table: str, buckets: set[str] | None = None, as_of: int | None = None) -> DataFrame | None:
        """The rows of a table (of some buckets, of an older version); None where there are no files."""
        state = self._state(table, buckets, as_of)
        plain, newest, older = [], [], {}
        for b, ps in state.items():
            last = max((i for i, (k, _) in enumerate(ps) if k == "merge"), default=-1)
            plain += [p for _, p in ps[last + 1:]]
            newest += [p for _, p in ps[max(last, 0):last + 1]]
            if last > 0:
                older[b] = ps[:last + 1]
        if not newest:
            return self.spark.read.parquet(*plain) if plain else None
        schema = self._schema(table)
        # Nothing replaces the rows of a bucket's newest merge and of what came after: they enter no join.
        rows = self.spark.read.schema(self._marked(schema)).parquet(*newest)
        parts = [rows.filter(~F.coalesce(F.col(GONE), F.lit(False))).select(*schema.names)]
        if older:
            parts.append(self._resolved(table, older, schema))
        if plain:
            parts.append(self.spark.read.schema(schema).parquet(*plain))
        return reduce(lambda a, b: a.unionByName(b), parts)

    def _schema(self, table: str) -> StructType:
        """Columns of a table, without the mark of deletions that merges may carry."""
        path = next(p for ps in self._state(table).values() for _, p in ps)
        return StructType([f for f in self.spark.read.parquet(path).schema if f.name != GONE])

    @staticmethod
    def _marked(schema: StructType) -> StructType:
        return StructType([*schema.fields]).add(GONE, BooleanType())

    def _resolved(self, table: str, merged: dict[str, list[tuple[str, str]]], schema: StructType) -> DataFrame:
        """Rows that buckets had before their newest merge (the last of each): a row stays unless a newer merge has its key."""
        keys, null_safe = self.merge_keys(table)
        marked = self._marked(schema)
        version = F.regexp_extract(F.col("_metadata.file_path"), r"/(\d{8})-[a-z]+/", 1).cast("int").alias("__version")

        def scan(paths, *columns):
            return self.spark.read.schema(marked).parquet(*paths).select(*columns, version)

        rows = scan([p for ps in merged.values() for _, p in ps[:-1]], *marked.names)
        names = _hashes(rows)  # as bytes through the join
        rows = packed(rows, names)
        newer = scan([p for ps in merged.values() for k, p in ps if k == "merge"], *[(packed_text(F.col(k)) if k in names else F.col(k)).alias(f"__{k}") for k in keys])
        if not null_safe:  # a NULL key replaces nothing
            newer = newer.dropna(subset=[f"__{k}" for k in keys])
        same = [F.col(k).eqNullSafe(F.col(f"__{k}")) if null_safe else F.col(k) == F.col(f"__{k}") for k in keys]
        if not any(k == "merge" for ps in merged.values() for k, _ in ps[:-1]):
            # One merge in each bucket: what it has replaces all that was there.
            kept = rows.join(newer.drop("__version"), reduce(lambda a, b: a & b, same), "left_anti")
            return unpacked(kept.select(*schema.names), kept, names)
        newest = newer.groupBy(*[f"__{k}" for k in keys]).agg(F.max("__version").alias("__newest"))
        kept = rows.join(newest, reduce(lambda a, b: a & b, same), "left")
        kept = kept.filter((F.col("__newest").isNull() | (F.col("__version") >= F.col("__newest"))) & ~F.coalesce(F.col(GONE), F.lit(False)))
        return unpacked(kept.select(*schema.names), kept, names)

    def _next(self, table: str, kind: str) -> str:
        segs = self._list(table)
        v = (segs[-1][0] + 1) if segs else 1
        return f"{self.root}/{table}/{v:08d}-{kind}"

    def _write(self, df: DataFrame, table: str, kind: str, bucket_col: str | None) -> DataFrame:
        w = df.write.mode("errorifexists").option("compression", COMPRESSION)
        if bucket_col:
            w = w.partitionBy(bucket_col)
        w.parquet(self._next(table, kind))
        return self.read(table)

    def write_base(self, df: DataFrame, table: str, bucket_col: str | None = None) -> DataFrame:
        return self._write(df, table, "base", bucket_col)

    def write_delta(self, df: DataFrame, table: str, bucket_col: str | None = None) -> DataFrame:
        if not self.exists(table):
            return self.write_base(df, table, bucket_col)
        return self._write(df, table, "delta", bucket_col)

    def write_patch(self, df: DataFrame, table: str, bucket_col: str) -> DataFrame:
        """Replace every bucket present in ``df`` (``df`` holds their complete new content)."""
        return self._write(df, table, "patch", bucket_col)

    def write_merge(self, df: DataFrame, table: str, keys: list[str], bucket_col: str | None = None, null_safe: bool = False) -> DataFrame:
        """Add rows that replace all older rows of their ``keys``; rows with a true ``GONE`` column only delete.

        All rows of a key must lie in one bucket. ``null_safe``: NULL keys are keys (of derived
        tables); otherwise a row with a NULL key is added and replaces nothing.
        """
        if not self.exists(table):
            return self.write_base(df.filter(~F.coalesce(F.col(GONE), F.lit(False))).drop(GONE) if GONE in df.columns else df, table, bucket_col)
        self.mark(f"merge_on/{table}/{'nullsafe' if null_safe else 'equal'}-{','.join(keys)}")
        return self._write(df, table, "merge", bucket_col)

    def merge_keys(self, table: str) -> tuple[list[str], bool]:
        """The key columns of a table with merges, and whether NULLs are keys, too."""
        fs, p = self._fs_path(f"{self.root}/_markers/merge_on/{table}")
        how, names = sorted(st.getPath().getName() for st in fs.listStatus(p))[0].split("-", 1)
        return names.split(","), how == "nullsafe"

    def merges(self, table: str) -> dict[str, int]:
        """bucket -> number of merges that a read of it has to resolve."""
        counts = {b: sum(k == "merge" for k, _ in ps) for b, ps in self._state(table).items()}
        return {b: n for b, n in counts.items() if n}

    def fold(self, table: str, after: int = 0, bucket=None) -> set[str]:
        """Resolve buckets with more than ``after`` merges into a ``fold``; returns those buckets.

        ``bucket``: the bucket column recomputed from the rows (it is not stored in the files).
        """
        due = {b for b, n in self.merges(table).items() if n > after}
        if due == {_ALL}:
            self.compact(table)
        elif due:
            self.rewrite(table, due, bucket)
        return due

    def rewrite(self, table: str, buckets: set[str], bucket) -> None:
        """Write buckets again, resolved, as one ``fold``; with a finer ``bucket`` they are split."""
        col = self.bucket_column(table)
        self._write(self.read(table, buckets).withColumn(col, bucket).hint("rebalance", col), table, "fold", col)

    def write_scratch(self, df: DataFrame, table: str, label: str) -> DataFrame:
        """Write an intermediate of a load of ``table`` once and read it back (lineage cut)."""
        path = f"{self.scratch}/{table}/{label}-{uuid.uuid4().hex}"
        df.write.mode("errorifexists").option("compression", COMPRESSION).parquet(path)
        return self.spark.read.parquet(path)

    def clear_scratch(self) -> None:
        """Delete the intermediate copies that this store object has written."""
        fs, p = self._fs_path(self.scratch)
        if fs.exists(p):
            fs.delete(p, True)

    # -- versions ---------------------------------------------------------------------
    def version(self, table: str) -> int:
        """Number of the newest complete segment, 0 when there is none."""
        return max((v for v, _, done in self._list(table) if done), default=0)

    def _since(self, table: str, version: int, kinds: tuple[str, ...]) -> list[str] | None:
        """Folders of what was added after ``version``; None when that is not known from ``kinds`` alone."""
        segs = self._list(table)
        if not segs or version < segs[0][0]:
            return None  # segments since then may have been vacuumed
        added = [(v, k) for v, k, done in segs if done and v > version and k != "fold" and not self.marked(f"neutral/{table}/{v:08d}")]
        if any(k not in kinds for _, k in added):
            return None
        return [f"{self.root}/{table}/{v:08d}-{k}" for v, k in added]

    def changes_since(self, table: str, version: int, kinds: tuple[str, ...] = ("delta",)) -> DataFrame | None:
        """Rows added after ``version`` by segments of ``kinds``; None when others changed rows, too.

        Folds and compactions change no rows and are passed over.
        """
        paths = self._since(table, version, kinds)
        if paths is None:
            return None
        schema = self._schema(table)
        leaves = [p for path in paths for p in self._leaves(path).values()]
        return self.spark.read.schema(schema).parquet(*leaves) if leaves else self.spark.createDataFrame([], schema)

    def buckets_since(self, table: str, version: int, kinds: tuple[str, ...] = ("delta", "merge")) -> set[str]:
        """Buckets that segments after ``version`` added rows to."""
        return {b for path in self._since(table, version, kinds) or [] for b in self._leaves(path)}

    def note_covers(self, derived: str, source: str, version: int) -> None:
        """Record that the newest segment of ``derived`` is made from ``source`` up to ``version``."""
        self.mark(f"covers/{derived}/{self.version(derived):08d}/{source}/{version:08d}")

    def covers(self, derived: str, source: str) -> int | None:
        """The version of ``source`` behind the newest segment of ``derived``; None when not recorded.

        The record is written after the segment, so a run that dies between them leaves None.
        """
        fs, p = self._fs_path(f"{self.root}/_markers/covers/{derived}/{self.version(derived):08d}/{source}")
        if not fs.exists(p):
            return None
        return max((int(st.getPath().getName()) for st in fs.listStatus(p)), default=None)

    def size_bytes(self, df: DataFrame) -> int:
        """Bytes (in usual compression) of the files behind a DataFrame read from the store."""
        total = 0
        for f in df.inputFiles():
            fs, p = self._fs_path(f)
            total += fs.getFileStatus(p).getLen()
        return USUAL_LENGTH * total

    def mark(self, name: str) -> None:
        """Record that a unit of work (e.g. a stream micro-batch) has been committed."""
        fs, p = self._fs_path(f"{self.root}/_markers/{name}")
        fs.mkdirs(p)

    def marked(self, name: str) -> bool:
        fs, p = self._fs_path(f"{self.root}/_markers/{name}")
        return bool(fs.exists(p))

    def vacuum(self, table: str, keep_bases: int = 2) -> list[str]:
        """Delete segments older than the ``keep_bases``-th newest complete base.

        Those folders are no longer part of any kept state (readers of the current state
        never list them). Incomplete folders newer than that point are left alone: they may
        belong to a write that is still running. Returns the deleted paths.
        """
        segs = self._list(table)
        bases = [v for v, k, done in segs if k == "base" and done]
        if len(bases) < keep_bases:
            return []
        cutoff = sorted(bases)[-keep_bases]
        gone = []
        for v, k, _ in segs:
            if v < cutoff:
                path = f"{self.root}/{table}/{v:08d}-{k}"
                fs, p = self._fs_path(path)
                fs.delete(p, True)
                gone.append(path)
        return gone

    def bucket_column(self, table: str) -> str | None:
        """Name of the bucket column of a bucketed table (from its folder names)."""
        for _, path in self.segments(table):
            fs, p = self._fs_path(path)
            for st in fs.listStatus(p):
                name = st.getPath().getName()
                if st.isDirectory() and "=" in name:
                    return name.split("=", 1)[0]
        return None

    def compact(self, table: str, bucket_expr=None, files: int | None = None) -> DataFrame | None:
        """Fold base + deltas + patches into one new base (old folders stay until vacuumed).

        A bucketed table stays bucketed: ``bucket_expr`` recomputes the bucket column (it is
        not stored in the files), e.g. ``load.bucket_of(chars=...)``.
        """
        df = self.read(table)
        if df is None:
            return None
        col = self.bucket_column(table)
        if col and bucket_expr is None:
            raise ValueError(f"{table} is bucketed by {col}: pass bucket_expr")
        if col:
            df = df.withColumn(col, bucket_expr).hint("rebalance", col)
        elif files:
            df = df.coalesce(files)
        out = self.write_base(df, table, col)
        # The same rows as before: what is derived from them needs no rebuild. (Without the mark it gets one.)
        self.mark(f"neutral/{table}/{self.version(table):08d}")
        return out


def materialize(df: DataFrame, name: str, how: str = "view", store: VaultStore | None = None) -> DataFrame:
    """``view``: temp view (lazy); ``table``: full rebuild as a new base snapshot."""
    if how == "view":
        df.createOrReplaceTempView(name)
        return df
    if how == "table":
        if store is None:
            raise ValueError("a store is needed for tables")
        return store.write_base(df, name)
    raise ValueError("use load_satellite for append / upsert")
