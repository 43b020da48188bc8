"""Hashes on their way: as 32 bytes where they are shuffled, as the texts they are made of where they can wait."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from satlink.operators.vault import HASH_NK, HD, TEXT_OF_HASH


def _hashes(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, StringType) and (f.name in (HASH_NK, HD) or f.name.startswith("hk_"))]


def waiting(df: DataFrame) -> list[str]:
    """Columns that hold the texts of their hashes (of ``build_satellite(hashed=False)``, also as written and read back)."""
    return [f.name for f in df.schema if f.metadata.get(TEXT_OF_HASH)]


def hashed(df: DataFrame) -> DataFrame:
    """``df`` with the hashes of its ``waiting`` columns."""
    names = waiting(df)
    return df.select(*[F.sha2(c, 256).alias(c) if c in names else F.col(c) for c in df.columns]) if names else df


#: After a text that is no hash: no text and this are as short as the 32 bytes of one.
_NO_HASH = "0" * 33


def packed_text(c: Column) -> Column:
    digest = F.unhex(c)  # NULL for what is not hexadecimal; capitals come back as others
    return F.when((F.length(c) == 64) & (F.lower(F.hex(digest)) == c), digest).otherwise(F.encode(F.concat(c, F.lit(_NO_HASH)), "utf-8"))


def packed(df: DataFrame, names: list[str] | None = None) -> DataFrame:
    """``df`` with its hashes as bytes, half as long to shuffle; different texts stay different."""
    names = _hashes(df) if names is None else names
    return df.withColumns({n: packed_text(F.col(n)) for n in names}) if names else df


def unpacked(df: DataFrame, like: DataFrame, names: list[str] | None = None) -> DataFrame:
    """The rows of ``packed`` with the texts of ``like`` again."""
    for n in _hashes(like) if names is None else names:
        text = F.decode(F.expr(f"left(`{n}`, length(`{n}`) - {len(_NO_HASH)})"), "utf-8")
        df = df.withColumn(n, F.when(F.length(n) == 32, F.lower(F.hex(n))).otherwise(text))
    return df
