"""Column-level helpers: null-safe predicates, day arithmetic, safe math, encoders' expressions."""

from coursepulse.functions.columns import (  # noqa: F401
    band_average,
    day_in_segment,
    entropy_term,
    ln_or_null,
    not_true,
    null_safe_isin,
    round_doubles,
    safe_div,
    segment_of,
)
from coursepulse.functions.dims import bounded_broadcast, mark_bounded, row_bound  # noqa: F401
