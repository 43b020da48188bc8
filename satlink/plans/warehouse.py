"""The build in dependency order: payloads -> staging -> hubs, links, satellites -> PIT -> marts.

``Warehouse`` is what a user runs: ``build()`` loads one batch of payloads per source into
the store (new hub and link keys appended, satellites loaded incrementally, stored by period
where their key has a time part), and refreshes the PITs. Each PIT records the version of its
source that it covers, so a refresh takes up *all* that was added since, also by a build that
died before its PITs, and does nothing when nothing changed:

* sum and max over append-only satellites are merged from the added rows;
* other aggregates are computed anew for the groups that were touched: those of the added rows
  and those that replaced rows were in before. Only the periods of those groups are read, and
  only groups whose row differs are written (a group without rows is deleted);
* a PIT without a record, or whose source was rewritten, is rebuilt.

Both write merge segments, so a refresh costs what the batch touches, not the PIT.
Earthquakes are kept by ``feature_id`` (the newest load wins): an upsert of the events of the feed,
so overlapping feeds and replays count once, and an event that moves to another day corrects both
days.  ``run_checks()`` evaluates the data tests on what was built. Staging of each source is
flattened once per build and written as Parquet (compacted), so hubs, links and
satellites fan out from files instead of re-parsing every payload three times.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from satlink.operators import checks as C
from satlink.operators import marts as M
from satlink.operators import pit as PIT
from satlink.operators import vault as V
from satlink.operators.flatten import FLATTENERS
from satlink.operators.joins import anti_join
from satlink.operators.load import FOLD_AFTER, NULL_BUCKET, OTHER_PERIOD, Period, fits_broadcast, layout_of, load_satellite_delta
from satlink.operators.packing import _hashes, packed, unpacked
from satlink.plans.store import GONE, VaultStore


# PIT name -> (satellite, builder, keys, mergeable measures).
PITS = {
    "pit_article_day": ("sat_article_views", PIT.pit_article_day,
                        ["hk_article", "project_id", "yyyymmdd"], {"views_day": "sum"}),
    "pit_country_indicator_year": ("sat_country_indicator_values", PIT.pit_country_indicator_year,
                                   ["hk_country", "hk_indicator", "year"], {"value_year": "max"}),
}


@dataclass(frozen=True)
class GroupedPit:
    """A PIT whose aggregates cannot be merged: touched groups are computed anew.

    ``groups``: the PIT's key columns as expressions over the source; ``key``: what identifies a
    source row (a newer row of a key replaces the older one); ``time``: the group column that is a
    prefix of the source's time, if any.
    """

    source: str
    build: Callable[[DataFrame], DataFrame]
    groups: Callable[[], dict[str, Column]]
    key: str = V.HASH_NK
    time: str | None = None


def _sensor_pit(grain: str) -> GroupedPit:
    width = {"hour": 13, "day": 10}[grain]
    return GroupedPit("sat_sensor_measurements", lambda s: PIT.pit_sensor(s, grain),
                      lambda: {"hk_sensor": F.col("hk_sensor"), "parameter": F.col("parameter"), grain: F.substring("date_utc", 1, width)}, time=grain)


# PITs over tables whose rows are replaced.
GROUPED_PITS = {
    "pit_weather_day": GroupedPit("sat_weather_hourly", PIT.pit_weather_day,
                                  lambda: {"hk_location": F.col("hk_location"), "day": F.substring("ts", 1, 10)}, time="day"),
    "pit_sensor_hour": _sensor_pit("hour"),
    "pit_sensor_day": _sensor_pit("day"),
    "pit_commit_day": GroupedPit("sat_commit_meta", PIT.pit_commit_day, lambda: {"day": F.substring("author_date", 1, 10)}),
    "pit_quake_day": GroupedPit("quakes", PIT.pit_quake_day, lambda: {"day": PIT.quake_day("epoch_ms")}, key="quake_key"),
}
#: Merges of a PIT that a read resolves before they are folded.
PIT_FOLD_AFTER = 16


def _same(left: DataFrame, right: DataFrame, names: list[str]) -> DataFrame:
    """Rows of ``left`` whose ``names`` occur in ``right``, NULL equal to NULL."""
    other = right.select(*[F.col(n).alias(f"__g_{n}") for n in names]).distinct()
    return left.join(other, reduce(lambda a, b: a & b, [F.col(n).eqNullSafe(F.col(f"__g_{n}")) for n in names]), "left_semi")


def _narrow(fn: Callable[[DataFrame], DataFrame], rows: DataFrame) -> DataFrame:
    """``fn`` of ``rows``, its hash keys shuffled as bytes."""
    built = fn(packed(rows, _hashes(rows)))
    keys = [n for n, kind in built.dtypes if kind == "binary" and n in _hashes(rows)]
    return unpacked(built, built, keys)


class Warehouse:
    def __init__(self, spark: SparkSession, store: VaultStore | None = None,
                 sat_modes: dict[str, str] | None = None, load_options: dict | None = None, **sat_options):
        """``sat_modes``: satellite -> "append" | "upsert" (defaults as configured);
        ``load_options``: passed to ``load_satellite`` (compare, on_collision, bucket_chars, on_write, fold_after);
        ``sat_options``: passed to the satellite builders (reject_null_keys, dedupe)."""
        self.spark = spark
        self.store = store or VaultStore(spark)
        self.sat_modes = {k: m for k, (_, _, m) in V.SATELLITES.items()}
        self.sat_modes.update(sat_modes or {})
        self.load_options = {"on_write": "merge", **(load_options or {})}
        self.sat_options = sat_options

    def stage(self, source: str, payloads: DataFrame, persist: bool = True) -> DataFrame:
        """Flatten one source's payloads; written once so that every consumer reads files."""
        stg = FLATTENERS[source](payloads)
        if persist:
            return self.store.write_base(stg, f"stg_{source}")
        return stg

    def build(self, payloads: dict[str, DataFrame], load_dt, persist_staging: bool = True) -> dict[str, DataFrame]:
        """Load one batch of payloads per source; returns every table as stored."""
        stg = {s: self.stage(s, p, persist_staging) for s, p in payloads.items()}
        out: dict[str, DataFrame] = {}
        for name, (fn, src) in {**V.HUBS, **V.LINKS}.items():
            if src in stg:
                # Hubs and links only grow: keys not seen before are appended as a delta
                # (the first load_dt of a key is kept), so a load costs the batch's keys.
                new = fn(stg[src], load_dt)
                old = self.store.read(name)
                if old is not None:
                    # The batch's keys are written once and measured: when small they are
                    # broadcast and the hub streams past them without a shuffle.
                    new = self.store.write_scratch(new, name, "keys")
                    small = fits_broadcast(new, [new.columns[0]])
                    new = anti_join(new, old, [new.columns[0]], small_left=small)
                out[name] = self.store.write_delta(new, name)
        for name, (fn, src, _) in V.SATELLITES.items():
            if src in stg:
                batch = fn(stg[src], load_dt, **{"hashed": False, **self.sat_options})
                period = Period(*V.PERIODS[name]) if name in V.PERIODS else None
                table, _, _ = load_satellite_delta(batch, self.store, name, self.sat_modes[name], **{"period": period, **self.load_options})
                if table is not None:
                    out[name] = table
        if "usgs" in stg:
            self._load_quakes(stg["usgs"], load_dt)
        out.update(self.refresh_pits())
        self.store.clear_scratch()
        for name in [f"stg_{s}" for s in payloads] + ["quakes", *PITS, *GROUPED_PITS]:
            self.store.vacuum(name)
        return out

    def _load_quakes(self, stg: DataFrame, load_dt) -> None:
        """Keep one row per earthquake: that of the newest load, the largest row if it has several.

        The events of the feed are compared with their stored rows in the buckets they fall in;
        only those that are new or newer are written, as a merge.
        """
        new = stg.select("feature_id", "epoch_ms", "magnitude").withColumn("load_dt", F.lit(load_dt).cast("timestamp"))
        # Features without id cannot be told apart: equal rows count once.
        key = F.coalesce(F.col("feature_id"), F.concat_ws("|", F.lit(""), F.col("epoch_ms").cast("string"), F.col("magnitude").cast("string")))
        order = F.struct("load_dt", "epoch_ms", "magnitude")
        best = F.max_by(F.struct("feature_id", "epoch_ms", "magnitude", "load_dt"), order)
        new = new.withColumn("quake_key", F.sha2(key, 256)).groupBy("quake_key").agg(best.alias("q")).select("quake_key", "q.*")
        new = self.store.write_scratch(new, "quakes", "batch")
        if new.isEmpty():
            return
        layout = layout_of(new, self.store, "quakes", "quake_key")
        stored = self.store.read("quakes", layout.touched(new))
        if stored is not None:
            known = stored.select("quake_key", order.alias("__stored"))
            if fits_broadcast(new, ["quake_key"]):
                known = known.join(F.broadcast(new.select("quake_key")), "quake_key", "left_semi")
            new = new.join(known, "quake_key", "left").filter(F.col("__stored").isNull() | (order > F.col("__stored"))).drop("__stored")
        self.store.write_merge(layout.deal(new), "quakes", ["quake_key"], "nk_bucket")
        self.store.fold("quakes", self.load_options.get("fold_after", FOLD_AFTER), layout.bucket())

    def refresh_pits(self) -> dict[str, DataFrame]:
        """Bring every PIT up to its source table; safe to call again after a failure."""
        out = {}
        for name, (source, fn, keys, measures) in PITS.items():
            if self.store.exists(source):
                out[name] = self._refresh(name, source, fn, lambda covered, n=name, a=(source, fn, keys, measures): self._merge_added(n, *a, covered))
        for name, pit in GROUPED_PITS.items():
            if self.store.exists(pit.source):
                out[name] = self._refresh(name, pit.source, pit.build, lambda covered, n=name, p=pit: self._replace_touched(n, p, covered))
        return out

    def _refresh(self, name: str, source: str, fn, catch_up: Callable[[int], bool]) -> DataFrame:
        """``catch_up`` takes up what was added since a version, or returns False where it cannot."""
        now = self.store.version(source)
        covered = self.store.covers(name, source) if self.store.exists(name) else None
        if covered == now:
            return self.store.read(name)
        if covered is None or not catch_up(covered):
            rows = self.store.read(source)
            self.store.write_base(_narrow(fn, rows), name)
        self.store.fold(name, PIT_FOLD_AFTER)
        # After the segment: a build that dies between them leaves no record, and the PIT is rebuilt.
        self.store.note_covers(name, source, now)
        return self.store.read(name)

    def _merge_added(self, name, source, fn, keys, measures, covered: int) -> bool:
        added = self.store.changes_since(source, covered)
        if added is None:
            return False
        delta = self.store.write_scratch(fn(added), name, "delta")
        if not delta.isEmpty():
            old = self.store.read(name)
            self.store.write_merge(PIT.merge_pit(_same(old, delta, keys), delta, keys, measures).select(*old.columns), name, keys, null_safe=True)
        return True

    def _replace_touched(self, name: str, pit: GroupedPit, covered: int) -> bool:
        added = self.store.changes_since(pit.source, covered, ("delta", "merge"))
        if added is None:
            return False
        groups = pit.groups()
        names = list(groups)
        columns = [c.alias(n) for n, c in groups.items()]
        hashes = [n for n in _hashes(added) if n in names]  # shuffled as bytes
        touched = packed(added.select(*columns), hashes)
        before = self.store.read(pit.source, self.store.buckets_since(pit.source, covered), as_of=covered)
        if before is not None:  # a row that is replaced leaves the group it was in
            # Joined by 64 bits of the key: a group that comes in by a clash is computed anew to the same row.
            key = F.xxhash64(pit.key).alias("__key")
            keys = added.filter(F.col(pit.key).isNotNull()).select(key).distinct()
            touched = touched.unionByName(packed(before.select(*columns, key), hashes).join(keys, "__key", "left_semi").drop("__key"))
        touched = self.store.write_scratch(touched.distinct(), name, "touched")
        if touched.isEmpty():
            return True
        rows, old = self.store.read(pit.source, self._buckets_of(pit, touched)), self.store.read(name)
        if fits_broadcast(touched, names):
            marked = F.broadcast(unpacked(touched, touched, hashes).select(*[F.col(n).alias(f"__g_{n}") for n in names]))
            rows = rows.join(marked, reduce(lambda a, b: a & b, [c.eqNullSafe(F.col(f"__g_{n}")) for n, c in groups.items()]), "left_semi")
            old = _same(old, marked.select(*[F.col(f"__g_{n}").alias(n) for n in names]), names)
        # Else the rows meet the touched groups after they are aggregated: each side is shuffled once.
        row = F.struct(*[c for c in old.columns if c not in names])
        both = touched.select(*names, F.lit(True).alias("__touched"))
        for side, df in (("__new", pit.build(packed(rows, hashes))), ("__old", packed(old, hashes))):
            both = both.unionByName(df.select(*names, row.alias(side)), allowMissingColumns=True)
        both = both.groupBy(*names).agg(*[F.max(c).alias(c) for c in ("__touched", "__new", "__old")])
        changed = both.filter(F.col("__touched") & ~F.col("__new").eqNullSafe(F.col("__old")))
        columns = [F.col(c) if c in names else F.col(f"__new.{c}").alias(c) for c in old.columns]
        changed = unpacked(changed.select(*columns, F.col("__new").isNull().alias(GONE)), changed, hashes)
        changed = self.store.write_scratch(changed, name, "groups")
        if not changed.isEmpty():
            self.store.write_merge(changed, name, names, null_safe=True)
        return True

    def _buckets_of(self, pit: GroupedPit, touched: DataFrame) -> set[str] | None:
        """Buckets that can hold rows of the touched groups; None for all of them."""
        names = self.store.buckets(pit.source)
        if pit.time is None or not all("." in n or n == NULL_BUCKET for n in names):
            return None
        # One short text for each day or hour that the batch touched.
        times = {r[0] for r in touched.select(pit.time).distinct().collect()}
        if not all(t and re.match(r"[0-9][-0-9T]*$", t) for t in times):
            return None  # a time that is none may lie in any period
        periods = {n.rsplit(".", 1)[0] for n in names - {NULL_BUCKET}}
        wanted = {p for p in periods if p == OTHER_PERIOD or any(t.startswith(p) or p.startswith(t) for t in times)}
        return {n for n in names if n == NULL_BUCKET or n.rsplit(".", 1)[0] in wanted}

    def table(self, name: str) -> DataFrame | None:
        return self.store.read(name)

    def marts(self) -> dict[str, DataFrame]:
        t = {n: self.store.read(n) for n in ("hub_article", "link_project_article", "pit_article_day",
                                           "hub_country", "hub_indicator", "pit_country_indicator_year")}
        out = {}
        if all(t[n] is not None for n in ("hub_article", "link_project_article", "pit_article_day")):
            out["article_traffic_daily"] = M.article_traffic_daily(t["hub_article"], t["link_project_article"],
                                                                   t["pit_article_day"])
        if all(t[n] is not None for n in ("hub_country", "hub_indicator", "pit_country_indicator_year")):
            out["population_by_country_year"] = M.population_by_country_year(
                t["hub_country"], t["hub_indicator"], t["pit_country_indicator_year"])
        extra = {n: self.store.read(n) for n in ("hub_location", "pit_weather_day", "hub_sensor", "pit_sensor_hour",
                                                 "pit_sensor_day", "pit_quake_day", "pit_commit_day")}
        if extra["hub_location"] is not None and extra["pit_weather_day"] is not None:
            out["weather_daily"] = M.weather_daily(extra["hub_location"], extra["pit_weather_day"])
        for grain in ("hour", "day"):
            if extra["hub_sensor"] is not None and extra[f"pit_sensor_{grain}"] is not None:
                out[f"air_quality_{grain}ly".replace("dayly", "daily")] = M.air_quality(
                    extra["hub_sensor"], extra[f"pit_sensor_{grain}"])
        if extra["pit_quake_day"] is not None:
            out["quakes_daily"] = extra["pit_quake_day"]
        if extra["pit_commit_day"] is not None:
            out["commits_daily"] = extra["pit_commit_day"]
        for name, df in out.items():
            df.createOrReplaceTempView(name)
        return out

    def tables(self) -> dict[str, DataFrame]:
        """Every table and mart that exists, by name."""
        names = [*V.HUBS, *V.LINKS, *V.SATELLITES, "quakes", *PITS, *GROUPED_PITS]
        return {n: df for n in names if (df := self.store.read(n)) is not None} | self.marts()

    def run_checks(self, now=None, warn_after_s: int = 86_400, error_after_s: int = 7 * 86_400,
                   accepted: dict[tuple[str, str], list] | None = None, singular=C.SINGULAR, keep_failures: bool = False) -> DataFrame:
        """``model, column, test, failures`` of all tests: the vault's constraints, accepted values
        (``(model, column) -> values``), singular tests, and, with ``now``, the age of every loaded table.

        ``keep_failures`` appends the failing rows as JSON to the table ``check_failures``.
        """
        t = self.tables()
        checks = C.vault_checks(t) + C.singular_checks(t, singular)
        checks += [C.Check(m, c, "accepted_values", C.accepted_values(t[m], c, v)) for (m, c), v in (accepted or {}).items() if m in t]
        if now is not None:
            checks += C.freshness_checks(t, now, warn_after_s, error_after_s, [*V.HUBS, *V.LINKS, *V.SATELLITES])
        summary = C.run_checks(checks)
        if keep_failures:
            # One row per check: a handful for every table, whatever its size.
            summary = self.store.write_scratch(summary, "checks", "summary")
            failed = {(r.model, r.column, r.test) for r in summary.filter("failures > 0").collect()}
            rows = C.failing_rows([c for c in checks if (c.model, c.column, c.test) in failed])
            if rows is not None:
                at = F.lit(now).cast("timestamp") if now is not None else F.current_timestamp()
                self.store.write_delta(rows.withColumn("checked_at", at), "check_failures")
        return summary
