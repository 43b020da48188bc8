"""Scalar helpers whose text output must equal the SQL side's: number text, tolerant casts,
percent-encoding and UTC stamps. All are built-in Column expressions (codegen, no UDF).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Numbers as text: plain decimal within [1e-4, 1e16), else "d.de+nn" with a two-digit exponent.
_PLAIN_LOW = 1e-4
_PLAIN_HIGH = 1e16
_JAVA_PLAIN_LOW = 1e-3
_JAVA_PLAIN_HIGH = 1e7

_SPECIAL_DOUBLES = ["nan", "inf", "+inf", "-inf", "infinity", "+infinity", "-infinity"]


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def double_text(c: Column | str) -> Column:
    """Render a double the way ``cast(double as varchar)`` does on the SQL side.

    NaN -> ``nan``, +-inf -> ``inf``/``-inf``; zero and [1e-3, 1e7) use Spark's own text;
    the rest of [1e-4, 1e16) goes through an exact decimal and loses trailing zeros;
    outside that range ``1.5E20`` becomes ``1.5e+20``.
    """
    x = _col(c).cast("double")
    a = F.abs(x)
    s = x.cast("string")
    dec = F.regexp_replace((s).try_cast("decimal(38,22)").cast("string"), r"0+$", "")
    dec = F.when(dec.endswith("."), F.concat(dec, F.lit("0"))).otherwise(dec)
    mant = F.regexp_replace(F.regexp_extract(s, r"^(-?[0-9.]+)E", 1), r"\.0$", "")
    expo = F.regexp_extract(s, r"E(-?)([0-9]+)$", 2)
    sign = F.when(F.regexp_extract(s, r"E(-?)", 1) == "-", F.lit("-")).otherwise(F.lit("+"))
    sci = F.concat(mant, F.lit("e"), sign, F.lpad(expo, 2, "0"))
    return (
        F.when(x.isNull(), F.lit(None).cast("string"))
        .when(F.isnan(x), F.lit("nan"))
        .when(x == float("inf"), F.lit("inf"))
        .when(x == float("-inf"), F.lit("-inf"))
        .when((x == 0) | ((a >= _JAVA_PLAIN_LOW) & (a < _JAVA_PLAIN_HIGH)), s)
        .when((a >= _PLAIN_LOW) & (a < _PLAIN_HIGH), dec)
        .otherwise(sci)
    )


def try_double(c: Column | str) -> Column:
    """Text to double, NULL when not a number.

    Spark's cast also takes Java-only spellings (``1d``, ``2f``, hex ``0x1p3``); any text
    holding ``d``, ``f`` or ``x`` is rejected unless it is a NaN / infinity spelling.
    Plain substring tests, no regex: this runs on every numeric JSON leaf.
    """
    t = F.trim(_col(c).cast("string"))
    low = F.lower(t)
    java_only = low.contains("d") | low.contains("f") | low.contains("x")
    return F.when(low.isin(_SPECIAL_DOUBLES) | ~java_only, t.try_cast("double"))


def _try_integral(c: Column | str, target: str) -> Column:
    t = F.trim(_col(c).cast("string"))
    # Integers pass straight through (no precision loss for large bigints).
    direct = t.try_cast(target)
    via_dec = F.round(t.try_cast("decimal(38,10)")).try_cast(target)
    via_sci = F.round(t.try_cast("double")).try_cast(target)
    sci = t.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)[eE][+-]?\d+$")
    return F.coalesce(direct, via_dec, F.when(sci, via_sci))


def try_int(c: Column | str) -> Column:
    """Text to int; decimals round half away from zero (``2.5`` -> 3), junk -> NULL."""
    return _try_integral(c, "int")


def try_bigint(c: Column | str) -> Column:
    """Text to bigint with the same rounding as ``try_int``."""
    return _try_integral(c, "bigint")


def try_unsigned_bigint(c: Column | str) -> Column:
    """Text to an unsigned 64-bit number as DECIMAL(20,0): outside [0, 2^64 - 1] -> NULL."""
    v = _try_integral(c, "decimal(20,0)")
    return F.when((v >= 0) & (v <= F.lit("18446744073709551615").cast("decimal(20,0)")), v)


def url_encode_segment(c: Column | str) -> Column:
    """Percent-encode a path segment with nothing safe except ``A-Za-z0-9_.-~``."""
    e = F.url_encode(_col(c))
    e = F.replace(e, F.lit("+"), F.lit("%20"))
    e = F.replace(e, F.lit("*"), F.lit("%2A"))
    return F.replace(e, F.lit("%7E"), F.lit("~"))


def url_encode_query(c: Column | str) -> Column:
    """Form-encode a query value: like ``url_encode_segment`` but a space becomes ``+``."""
    e = F.url_encode(_col(c))
    e = F.replace(e, F.lit("*"), F.lit("%2A"))
    return F.replace(e, F.lit("%7E"), F.lit("~"))


# Field -> (start, length) in the text of a TIMESTAMP_NTZ, "yyyy-MM-dd HH:mm:ss[.ffffff]".
_NTZ_FIELDS = {"yyyy": (1, 4), "MM": (6, 2), "dd": (9, 2), "HH": (12, 2), "mm": (15, 2), "ss": (18, 2)}


def ntz_text(c: Column | str, pattern: str) -> Column:
    """Format a zone-less timestamp without going through the session time zone.

    ``pattern`` uses ``yyyy MM dd HH mm ss`` and literal characters (``'T'`` quoting is
    accepted). The fields are cut from the timestamp's own text, so a wall-clock time in a
    daylight-saving gap of the session zone is rendered as it is, not shifted.
    """
    return ntz_fields(ntz_whole(c), pattern)


def ntz_whole(c: Column | str) -> Column:
    """The text of a zone-less timestamp, of which ``ntz_fields`` cuts its fields."""
    return _col(c).cast("timestamp_ntz").cast("string")


def ntz_fields(s: Column, pattern: str) -> Column:
    """``ntz_text`` of a timestamp that is its text already (inside a ``transform`` each field would make the text anew)."""
    parts: list[Column] = []
    i, lit = 0, ""
    pat = pattern.replace("'", "")
    while i < len(pat):
        tok = next((t for t in _NTZ_FIELDS if pat.startswith(t, i)), None)
        if tok:
            if lit:
                parts.append(F.lit(lit))
                lit = ""
            start, n = _NTZ_FIELDS[tok]
            parts.append(F.substring(s, start, n))
            i += len(tok)
        else:
            lit += pat[i]
            i += 1
    if lit:
        parts.append(F.lit(lit))
    return F.concat(*parts)


def utc_stamp(c: Column | str) -> Column:
    """``yyyyMMddTHHmmssZ`` text of a timestamp taken as UTC wall-clock time."""
    return ntz_text(c, "yyyyMMdd'T'HHmmss'Z'")


def epoch_millis(c: Column | str) -> Column:
    """Milliseconds since 1970-01-01 of a zone-less timestamp (truncating, like ``unix_millis``).

    Computed on TIMESTAMP_NTZ so the result does not depend on the session time zone.
    """
    ts = _col(c).cast("timestamp_ntz")
    micros = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ts)
    return F.floor(micros / F.lit(1000)).cast("bigint")


ISO = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def iso_text(c: Column | str, fmt: str = ISO) -> Column:
    """Zone-less timestamp to text with one explicit pattern (see ``ntz_text``)."""
    return ntz_text(c, fmt)
