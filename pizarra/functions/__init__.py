"""Column-level helpers (null, rounding and parsing rules)."""

from pizarra.functions.scalar import (  # noqa: F401
    code_map,
    day_text,
    ne_keep_nulls,
    recode,
    round_half_even,
    to_numeric,
    try_ratio,
    upper_key,
)
