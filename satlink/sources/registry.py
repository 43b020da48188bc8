"""Source registry: (source, table) -> metadata such as the landing glob."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from satlink.sources.json_scan import scan_json


@dataclass(frozen=True)
class SourceTable:
    source: str
    name: str
    meta: dict = field(default_factory=dict)
    description: str = ""


class SourceRegistry:
    """Ordered list of source tables; the first match on (source, name) wins."""

    def __init__(self, tables: list[SourceTable] | None = None):
        self.tables: list[SourceTable] = list(tables or [])

    def add(self, source: str, name: str, **meta) -> SourceRegistry:
        self.tables.append(SourceTable(source, name, dict(meta)))
        return self

    def meta(self, source: str, name: str, key: str, default=None):
        """Meta value of the first matching table; ``default`` when the key or table is absent."""
        for t in self.tables:
            if t.source == source and t.name == name:
                return t.meta.get(key, default)
        return default

    @classmethod
    def for_landing(cls, root: str, source: str = "raw_vault") -> SourceRegistry:
        """Registry of all six APIs under one landing root (key=value partition folders)."""
        reg = cls()
        for name in ("worldbank", "wikimedia", "openmeteo", "github", "openaq", "usgs"):
            reg.add(source, name, glob=f"{root}/{name}")
        return reg


def scan_source(spark: SparkSession, registry: SourceRegistry, source: str, table: str,
                default: str | None = None, key: str = "glob") -> DataFrame:
    """Registry-driven scan: the table's glob (or ``default``) read as payload text."""
    glob = registry.meta(source, table, key, default)
    if glob is None:
        raise KeyError(f"no {key!r} for {source}.{table} and no default")
    return scan_json(spark, glob, source=table)
