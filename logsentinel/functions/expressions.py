"""Column expressions: label folding, flags, scores, levels, window bounds.

Everything here returns a ``Column`` built from ``pyspark.sql.functions`` so
that it stays inside whole-stage codegen; nothing calls back into Python.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from logsentinel import rules

WINDOW_TEXT_FORMAT = "yyyy-MM-dd HH:mm:ss"
EVENT_TEXT_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def fold(col: str | Column, fold_case: bool) -> Column:
    """``lower(col)`` when the rule is case-folded, else the raw value."""
    c = _c(col)
    return F.lower(c) if fold_case else c


def label_is(col: str | Column, label: str, fold_case: bool) -> Column:
    return fold(col, fold_case) == F.lit(label)


def rlike_any(cols: list[str | Column], pattern: str) -> Column:
    """``c1 RLIKE p OR c2 RLIKE p ...`` with SQL three-valued logic."""
    out = None
    for col in cols:
        term = _c(col).rlike(pattern)
        out = term if out is None else (out | term)
    return out


def attack_type_of(is_sqli: str | Column) -> Column:
    """SQLi wins when a row matches both families; a null SQLi flag is XSS."""
    return F.when(_c(is_sqli), F.lit(rules.SQLI)).otherwise(F.lit(rules.XSS))


def event_score(label: str | Column, fold_case: bool = False) -> Column:
    """Per-event threat points: malicious 10, suspicious 5, anything else 0."""
    lab = fold(label, fold_case)
    expr = None
    for value, points in rules.LABEL_SCORES:
        cond = lab == F.lit(value)
        expr = F.when(cond, F.lit(points)) if expr is None else expr.when(cond, F.lit(points))
    return expr.otherwise(F.lit(0))


def threat_level(score: str | Column) -> Column:
    s = _c(score)
    expr = None
    for floor, name in rules.THREAT_LEVELS:
        cond = s >= F.lit(floor)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr.otherwise(F.lit(rules.LOWEST_THREAT_LEVEL))


def reputation_score(
    count: str | Column,
    malicious: str | Column,
    min_count: str | Column,
    max_count: str | Column,
) -> Column:
    """Min-max scaled reputation score in [50, 99] (integer, truncated).

    The scaling is done in doubles in the original order of operations and
    then truncated toward zero, like ``int()``.
    """
    c, m = _c(count), _c(malicious)
    lo, hi = _c(min_count), _c(max_count)
    scaled = (
        F.lit(float(rules.SCORE_FLOOR))
        + ((c - lo).cast("double") / (hi - lo).cast("double")) * F.lit(float(rules.SCORE_SPAN))
    ).cast("int")
    base = F.when(hi == lo, F.lit(rules.SCORE_WHEN_FLAT)).otherwise(scaled)
    ratio = m.cast("double") / F.greatest(c, F.lit(1)).cast("double")
    return F.when(
        ratio > F.lit(rules.MALICIOUS_RATIO_BONUS),
        F.least(F.lit(rules.SCORE_CAP), base + F.lit(rules.SCORE_BONUS)),
    ).otherwise(base)


def window_bounds(window: str | Column = "window", as_text: bool = True) -> list[Column]:
    """``window_start`` / ``window_end`` columns from a window struct."""
    w = _c(window)
    start, end = w.getField("start"), w.getField("end")
    if as_text:
        start = F.date_format(start, WINDOW_TEXT_FORMAT)
        end = F.date_format(end, WINDOW_TEXT_FORMAT)
    return [start.alias("window_start"), end.alias("window_end")]


def ts_text(col: str | Column, fmt: str = EVENT_TEXT_FORMAT) -> Column:
    return F.date_format(_c(col), fmt)


def fmt_num(col: str | Column) -> Column:
    """Dashboard number text: one decimal with B / M / K above 1e9 / 1e6 /
    1e3, the plain number below."""
    n = _c(col)
    out = F.when(n.isNull(), F.lit(None).cast("string"))
    for scale, suffix in ((1e9, "B"), (1e6, "M"), (1e3, "K")):
        out = out.when(n >= scale, F.format_string(f"%.1f{suffix}", n.cast("double") / scale))
    return out.otherwise(n.cast("string"))
