from recspark.functions.columns import (  # noqa: F401
    epoch_seconds, yearmonth, round6, round_half_up, array_norm, array_dot, cosine,
    log10_count, safe_int, safe_double, split_fields, field, genre_text,
    contains_ci, like_flag, trim,
)
