"""Column expressions shared by the queries (all JVM-side built-ins)."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Low bits of money units summed apart: 2 ** 43 rows fit either sum.
LOW_BITS = 20


def __getattr__(name: str):
    # Built lazily: a Column needs an active SparkContext.
    if name == "APPROVED":
        return F.col("approved")
    raise AttributeError(name)


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_double(c) -> Column:
    return col(c).cast("double")


def money_sum(value="amount", cond: Column | None = None, scale: int = 2, zero: bool = False) -> Column:
    """Exact SUM of a money column with ``scale`` decimals, as decimal(38, scale).

    The sum runs on integer units (cents, micro-units) in two bigint buffers, of
    the units' high and low parts, so it stays on primitive longs and no group
    overflows (a decimal SUM widens past 18 digits and falls back to BigDecimal
    arithmetic). Only the aggregated value is turned back into a decimal.
    ``cond`` keeps FILTER semantics (NULL when no row matches) unless ``zero``
    asks for CASE ... ELSE 0 semantics.
    """
    units = (col(value) * F.lit(10 ** scale)).cast("bigint")
    if cond is not None:
        units = F.when(cond, units).otherwise(F.lit(0).cast("bigint")) if zero else F.when(cond, units)
    unit = F.lit("0." + "0" * (scale - 1) + "1").cast(f"decimal({scale},{scale})")
    high = F.sum(F.shiftright(units, LOW_BITS)).cast("decimal(38,0)")
    low = F.sum(units.bitwiseAND(F.lit((1 << LOW_BITS) - 1).cast("bigint"))).cast("decimal(38,0)")
    return ((high * F.lit(1 << LOW_BITS) + low).cast("decimal(38,0)") * unit).cast(f"decimal(38,{scale})")


def fee_sum(cond: Column | None = None) -> Column:
    return money_sum("fee", cond, scale=6)


def gpv_sum(amount="amount", approved="approved") -> Column:
    """Approved amount; NULL when the group has no approved row (FILTER semantics)."""
    return money_sum(amount, col(approved))


def gpv_sum_zero(amount="amount", approved="approved") -> Column:
    """Approved amount; 0 when the group has no approved row (CASE ... ELSE 0 semantics)."""
    return money_sum(amount, col(approved), zero=True)


def count_when(cond: Column) -> Column:
    return F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0))).cast("bigint")


def count_unless(cond: Column) -> Column:
    """Rows where cond is not TRUE (FALSE or NULL), like CASE WHEN cond THEN 0 ELSE 1."""
    return F.sum(F.when(cond, F.lit(0)).otherwise(F.lit(1))).cast("bigint")


def safe_div(num, den) -> Column:
    """num / den as DOUBLE, NULL when den is NULL or 0 (never raises under ANSI)."""
    n, d = as_double(num), as_double(den)
    return F.when(d != 0, n / d)


def ratio_or_zero(num, den) -> Column:
    """num / den as DOUBLE when den > 0, else 0."""
    n, d = as_double(num), as_double(den)
    return F.when(d > 0, n / d).otherwise(F.lit(0.0))


def growth(cur, prev) -> Column:
    """(cur - prev) / prev in DOUBLE; NULL when prev is NULL or 0."""
    c, p = as_double(cur), as_double(prev)
    return F.when(p.isNotNull() & (p != 0), (c - p) / p)


def month_start(d) -> Column:
    return F.trunc(col(d), "month")


def week_start(d) -> Column:
    """ISO week start (Monday) as DATE."""
    return F.trunc(col(d), "week")


def month_boundaries_between(start, end) -> Column:
    """Number of month boundaries crossed from start to end (calendar month difference)."""
    s, e = col(start), col(end)
    return ((F.year(e) - F.year(s)) * 12 + (F.month(e) - F.month(s))).cast("bigint")


def mean_from_sums(total, count) -> Column:
    """Mean as DOUBLE from an exact decimal total and a count."""
    return F.when(col(count) > 0, as_double(total) / as_double(count))


def samp_stddev_from_sums(n, s1, s2) -> Column:
    """Sample stddev from exact decimal n, sum and sum of squares (NULL when n < 2)."""
    n_, s1_, s2_ = col(n), col(s1), col(s2)
    num = (n_.cast("decimal(20,0)") * s2_ - s1_ * s1_)
    return F.when(n_ > 1, F.sqrt(as_double(num) / as_double(n_ * (n_ - 1))))


def pop_stddev_from_sums(n, s1, s2) -> Column:
    """Population stddev from exact decimal n, sum and sum of squares (NULL when n = 0)."""
    n_, s1_, s2_ = col(n), col(s1), col(s2)
    num = (n_.cast("decimal(20,0)") * s2_ - s1_ * s1_)
    return F.when(n_ > 0, F.sqrt(as_double(num) / as_double(n_ * n_)))


def round_mean(c, digits: int = 10) -> Column:
    """Round a mean of doubles so the value does not depend on summation order."""
    return F.round(col(c), digits)
