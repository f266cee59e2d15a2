from tidemark.functions.dates import (  # noqa: F401
    add_weeks,
    days_between,
    month_start,
    months_crossed,
    quarter_start,
    week_start,
    weeks_crossed,
    years_crossed,
)
from tidemark.functions.hashing import hash_bucket, stable_digits, stable_hash  # noqa: F401
from tidemark.functions.numeric import div0, exact_avg, to_double  # noqa: F401
