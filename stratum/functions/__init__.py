from stratum.functions.expr import (  # noqa: F401
    clip0, cond_sum, half_even, is_missing, ratio, ratio0, strict_sum, col_of,
)
