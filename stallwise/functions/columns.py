"""Column expressions shared by the operators. All stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stallwise import schema as S


def holds(condition: Column) -> Column:
    """The condition, with unknown counted as false."""
    return F.coalesce(condition, F.lit(False))


def share(condition: Column) -> Column:
    """Aggregate: share of all rows where the condition holds."""
    return F.avg(holds(condition).cast("double"))


def percent(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part * F.lit(100.0), whole), F.lit(0.0))


def differs(left: Column, right: Column) -> Column:
    """Inequality in which a missing value differs from everything, itself included."""
    return F.coalesce(left != right, F.lit(True))


def is_blank(text: Column) -> Column:
    return text.isNull() | text.rlike(r"(?U)^\s*$")


def has_discount() -> Column:
    return holds(F.col(S.REGULAR_PRICE) > F.col(S.PRICE))


def discount_pct() -> Column:
    regular = F.col(S.REGULAR_PRICE)
    return F.when(has_discount(), (regular - F.col(S.PRICE)) / regular)


def reputation_score(reputation: Column) -> Column:
    """Level name to its rank as a double; unknown levels become null."""
    levels = F.create_map(*[F.lit(x) for pair in S.REPUTATION_SCORES.items() for x in pair])
    return F.try_element_at(levels, reputation).cast("double")


def on_channel(channel: str) -> Column:
    return holds(F.col(S.CHANNEL) == channel)


def is_new() -> Column:
    return holds(F.col("condition") == "new")


def log1p_from_zero(value: Column) -> Column:
    """log(1 + x) with negatives taken as zero; null stays null."""
    return F.log1p(F.when(value < 0, F.lit(0.0)).otherwise(value.cast("double")))


def capped(value: Column, cap: Column) -> Column:
    """The value, at most ``cap``; null stays null."""
    return F.when(value > cap, cap).otherwise(value)
