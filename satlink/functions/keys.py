"""Hash keys and hash diffs, all as JVM-side Column expressions (no UDF).

One encoding everywhere: 64 lower-case hex characters of SHA-256 over the standardised text.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, FloatType

from satlink.functions.text import double_text

# Fixed values shared with the SQL side of every comparison: separator and NULL sentinel.
KEY_SEPARATOR = "|"
NULL_SENTINEL = "NULL"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def std(c: Column | str) -> Column:
    """Standardise a business key: ``upper(trim(x))``; NULL stays NULL."""
    return F.upper(F.trim(_col(c)))


def hash_key(c: Column | str) -> Column:
    """``sha256(upper(trim(x)))`` as lower hex; NULL in, NULL out."""
    return F.sha2(std(c), 256)


def composite_text(cols: Iterable[Column | str]) -> Column:
    """``std(c1) || '|' || std(c2) ...`` with NULL propagation (``concat``, not ``concat_ws``)."""
    parts: list[Column] = []
    for i, c in enumerate(cols):
        if i:
            parts.append(F.lit(KEY_SEPARATOR))
        parts.append(std(_col(c)))
    return F.concat(*parts)


def hash_key_composite(cols: Iterable[Column | str]) -> Column:
    """Hash of the standardised parts joined by ``|``; any NULL part gives NULL."""
    return hash_key(composite_text(cols))


def as_text(c: Column, dtype=None) -> Column:
    """Value to text the way the SQL side casts to varchar (doubles via ``double_text``)."""
    if isinstance(dtype, (DoubleType, FloatType)):
        return double_text(c.cast("double"))
    if isinstance(dtype, BooleanType):
        return F.when(c, F.lit("true")).when(~c, F.lit("false"))
    return c.cast("string")


def null_sentinel(c: Column) -> Column:
    """``coalesce(x, 'NULL')``."""
    return F.coalesce(c, F.lit(NULL_SENTINEL))


def hash_diff_text(parts: Iterable[Column]) -> Column:
    """``coalesce(text(c1),'NULL') || '|' || ...`` (parts already rendered as text)."""
    cols = [null_sentinel(p) for p in parts]
    out: list[Column] = []
    for i, c in enumerate(cols):
        if i:
            out.append(F.lit(KEY_SEPARATOR))
        out.append(c)
    return F.concat(*out)


def hash_diff(parts: Iterable[Column]) -> Column:
    """``sha256(upper(trim(coalesce(t1,'NULL') || '|' || ...)))``: never NULL."""
    return F.sha2(std(hash_diff_text(parts)), 256)


def hash_diff_of(df, names: Iterable[str]) -> Column:
    """``hash_diff`` over named columns of ``df``, rendering each by its type."""
    types = {f.name: f.dataType for f in df.schema.fields}
    return hash_diff([as_text(F.col(n), types[n]) for n in names])
