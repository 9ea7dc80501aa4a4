"""Column expressions shared by every operator."""

from .scalars import (  # noqa: F401
    above,
    at_least_zero,
    below,
    flag_text,
    is_finite,
    parse_day,
    parse_number,
    ratio,
    round2,
    total,
    without_missing_tokens,
    without_nan,
)
