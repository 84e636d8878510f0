"""Scalar Column expressions; every one stays inside whole-stage codegen."""

from .expr import (  # noqa: F401
    abs_recency,
    bucket_label,
    clip_negative,
    flag_eq,
    flag_gt,
    flag_in,
    flag_le,
    floored_shortfall,
    psi_term,
    round_doubles,
    safe_ratio,
    type_name,
)
