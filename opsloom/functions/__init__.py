from opsloom.functions.dates import (  # noqa: F401
    date_trunc_safe, grain_start, hours_between, micros, minutes_between, month_start, week_start,
)
from opsloom.functions.numbers import (  # noqa: F401
    exact_avg, greatest_or_null, linear_score, pct_change, ratio_of, rolling_zscore, safe_divide,
    stable_round, zscore,
)
from opsloom.functions.labels import (  # noqa: F401
    dora_tier, duration_bucket, event_key, folded, severity_bins, severity_ladder, surrogate_key,
)
from opsloom.functions.nested import credit_total, label_value  # noqa: F401
