"""Values and rows at given ranks, without ordering all rows.

A k-th value is searched in rounds. A quantile sketch over the rows still in
question (``approx_percentile``, whose answers are values of the column) gives two
values around the rank; one more pass counts the rows below, at, between and above
them, which tells for certain where the rank lies, and the rows there are the
next round's. A round leaves about 1 row in 2500, so 10^13 rows need four; the
search ends at one value, however many rows have it, or when so few rows are left
that their different values can be collected. Several searches share every pass.

A pass reads the input with pushed filters and aggregates map-side: nothing is
sorted or shuffled by the column, and a value that most rows have costs nothing
more. The input is read several times, so it should be a written table.
"""
from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows whose values are collected at the end of one search.
COLLECT_ROWS = 10_000
#: The sketch's rank error is at most rows / ACCURACY.
ACCURACY = 10_000


@dataclass(frozen=True)
class Found:
    """The value at a rank, and how many rows come before it and have it."""
    value: Any
    before: int
    equal: int


@dataclass
class Search:
    """The ``rank``-th value (from 1) of ``column``, nulls left out, in the rows ``among``."""
    column: Column
    rank: int
    among: Column | None = None
    descending: bool = False
    after: Any = None
    until: Any = None
    below: int = 0
    inside: int = 0
    found: Found | None = None
    total: int = field(default=0)

    def rows(self) -> Column:
        """Rows the rank is still looked for in."""
        tests = [self.column.isNotNull()]
        if self.among is not None:
            tests.append(self.among)
        if self.after is not None:
            tests.append(self.column > F.lit(self.after))
        if self.until is not None:
            tests.append(self.column < F.lit(self.until))
        return reduce(Column.__and__, tests)

    def settle(self, value, below: int, equal: int) -> None:
        before = self.total - below - equal if self.descending else below
        self.found = Found(value, before, equal)

    def fractions(self) -> tuple[float, float]:
        at, slack = (self.rank - self.below) / self.inside, 2 / ACCURACY
        return max(0.0, at - slack), min(1.0, at + slack)


def _narrow(df: DataFrame, open_: list[Search]) -> None:
    """One round: two values around each rank, then the rows before, at, between and at them.

    The rank is at one of the values, or strictly on a side of one: rows are fewer in any case.
    """
    zones: dict[str, list[Search]] = {}
    for s in open_:
        zones.setdefault(str((str(s.among), str(s.column), s.after, s.until)), []).append(s)
    groups = list(zones.values())
    sketches = df.agg(*[F.percentile_approx(F.when(g[0].rows(), g[0].column), [f for s in g for f in s.fractions()], ACCURACY)
                        for g in groups]).first()
    open_ = [s for g in groups for s in g]
    pairs = [(values[2 * i], values[2 * i + 1]) for g, values in zip(groups, sketches, strict=True) for i in range(len(g))]
    tests = [s.rows() & test for s, (low, high) in zip(open_, pairs, strict=True)
             for test in (s.column < F.lit(low), s.column == F.lit(low),
                          (s.column > F.lit(low)) & (s.column < F.lit(high)), s.column == F.lit(high))]
    counts = df.agg(*[F.count_if(t) for t in tests]).first()
    for i, (s, (low, high)) in enumerate(zip(open_, pairs, strict=True)):
        before, at_low, between, at_high = counts[4 * i:4 * i + 4]
        if low == high or (low != low and high != high):  # NaN is one value
            at_high = 0
        after = s.inside - before - at_low - between - at_high
        for n, value, bounds in ((before, None, (s.after, low)), (at_low, low, None), (between, None, (low, high)),
                                 (at_high, high, None), (after, None, (high, s.until))):
            if s.rank <= s.below + n:
                if bounds is None:
                    s.settle(value, s.below, n)
                else:
                    (s.after, s.until), s.inside = bounds, n
                break
            s.below += n


def _gather(df: DataFrame, few: list[Search]) -> None:
    """The different values of few rows, counted, decide."""
    tagged = F.filter(F.array(*[F.when(s.rows(), F.struct(F.lit(i).alias("i"), s.column.alias("v"))) for i, s in enumerate(few)]),
                      lambda x: x.isNotNull())
    rows = df.select(F.explode(tagged).alias("_x")).groupBy("_x.i", "_x.v").agg(F.count(F.lit(1)).alias("n"))
    values: dict[int, list] = {i: [] for i in range(len(few))}
    for r in rows.collect():  # at most COLLECT_ROWS for each search
        values[r.i].append((r.v, r.n))
    for i, s in enumerate(few):
        below = s.below
        for v, n in sorted(values[i], key=lambda x: (x[0] != x[0], x[0])):
            if below + n >= s.rank:
                s.settle(v, below, n)
                break
            below += n


def find(df: DataFrame, searches: list[Search]) -> list[Found | None]:
    """What each search looks for; None where there are fewer rows than its rank.

    The columns of all searches must be of one type (numbers, dates or timestamps).
    """
    if not searches:
        return []
    totals = df.agg(*[F.count_if(s.rows()) for s in searches]).first()
    for s, n in zip(searches, totals, strict=True):
        s.total = s.inside = n
        if s.descending:
            s.rank = n - s.rank + 1
    open_ = [s for s in searches if 1 <= s.rank <= s.total]
    while open_:
        few = [s for s in open_ if s.inside <= COLLECT_ROWS]
        if few:
            _gather(df, few)
        many = [s for s in open_ if s.found is None]
        if many:
            _narrow(df, many)
        open_ = [s for s in many if s.found is None]
    return [s.found for s in searches]


def values_at(df: DataFrame, column: str, ranks: list[int], descending: bool = False) -> list:
    """The values of ``column`` (not null) at these ranks, from 1; None beyond the last row."""
    found = find(df, [Search(F.col(column), k, descending=descending) for k in ranks])
    return [f.value if f else None for f in found]


def median(df: DataFrame, column: str):
    """Both middle values of ``column`` (equal for an odd number of rows); (None, None) without any."""
    n = df.agg(F.count(column)).first()[0]
    return tuple(values_at(df, column, [(n + 1) // 2, n // 2 + 1])) if n else (None, None)


def first_rows(df: DataFrame, order: list[tuple[str, bool]], counts: list[int]) -> list[Column]:
    """For each count a condition that holds for exactly so many rows, the first by ``order``.

    ``order`` lists (column, descending); the columns must not be null and together
    be unique. Rows that tie on a column are searched by the next one.
    """
    conditions = [F.lit(False)] * len(counts)
    total = df.count()
    left = {}
    for i, n in enumerate(counts):
        if n >= total:
            conditions[i] = F.lit(True)
        elif n > 0:
            left[i] = n
    ties: dict[int, Column | None] = dict.fromkeys(left)
    for name, descending in order:
        column = F.col(name)
        found = find(df, [Search(column, n, ties[i], descending) for i, n in left.items()])
        for (i, n), at in zip(list(left.items()), found, strict=True):
            if at is None:
                raise ValueError(f"{name} is null in some rows")
            value, tie = F.lit(at.value), ties[i]
            earlier = column > value if descending else column < value
            all_equal = at.before + at.equal == n
            own = (earlier | (column == value)) if all_equal else earlier
            conditions[i] = conditions[i] | (own if tie is None else tie & own)
            if all_equal:
                del left[i]
            else:
                left[i] = n - at.before
                ties[i] = (column == value) if tie is None else tie & (column == value)
        if not left:
            return conditions
    raise ValueError("rows tie on all columns of the order")
