"""Column expressions shared by the operators (all JVM-side built-ins)."""

from logsentinel.functions.expressions import (  # noqa: F401
    attack_type_of,
    event_score,
    fmt_num,
    fold,
    label_is,
    reputation_score,
    rlike_any,
    threat_level,
    ts_text,
    window_bounds,
)
