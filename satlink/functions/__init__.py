"""Column-expression helpers: hash keys, hash diffs, number text, tolerant casts."""

from satlink.functions.keys import (  # noqa: F401
    KEY_SEPARATOR,
    NULL_SENTINEL,
    as_text,
    composite_text,
    hash_diff,
    hash_diff_of,
    hash_diff_text,
    hash_key,
    hash_key_composite,
    null_sentinel,
    std,
)
from satlink.functions.text import (  # noqa: F401
    double_text,
    epoch_millis,
    iso_text,
    ntz_text,
    try_bigint,
    try_double,
    try_int,
    try_unsigned_bigint,
    url_encode_query,
    url_encode_segment,
    utc_stamp,
)
