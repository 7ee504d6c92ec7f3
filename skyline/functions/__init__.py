from skyline.functions.columns import (  # noqa: F401
    band,
    clock_text_minutes,
    first_match,
    hhmm_minutes,
    mean_if,
    optional,
    pct,
    quantile,
    ratio,
    ratio_or_zero,
    round_half_up,
    tally,
)
from skyline.functions.frames import attach, is_recent, keep_one, top  # noqa: F401
