from lodestar.functions.scalar import (  # noqa: F401
    NUMERIC_PATTERN, impute, is_numeric, java_split, ratio_percent, recode,
    round_half_up, split_words, try_double, try_int,
)
