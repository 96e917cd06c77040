from retailstream.functions.timefmt import (  # noqa: F401
    epoch_ms, from_epoch_ms, ts_string, day_string, seconds_trunc, age_years, window_bounds,
)
from retailstream.functions.metrics import ratio_half_up, visitor_ratios  # noqa: F401
from retailstream.functions.keywords import tokenize, keyword_weight  # noqa: F401
