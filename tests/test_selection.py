"""Selection by rank against sorting, with ties, few and many rows."""
import datetime as dt
import math
import random
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerlens.operators import selection as S
from ledgerlens.plans import dashboard
from ledgerlens.plans import evaluation as EV

KINDS = {
    "random": lambda r: r.random(),
    "two values": lambda r: float(r.random() < 0.5),
    "one hot value": lambda r: 7.0 if r.random() < 0.9 else r.random() * 10,
    "negative and huge": lambda r: r.choice([-1, 1]) * 10.0 ** r.randint(-300, 300),
    "nulls": lambda r: None if r.random() < 0.3 else r.randint(0, 20) / 4,
    "nan": lambda r: math.nan if r.random() < 0.2 else r.random(),
}


@pytest.mark.parametrize("collect", [10, 10_000])
@pytest.mark.parametrize("kind", KINDS)
def test_values_at_ranks(spark, monkeypatch, kind, collect):
    monkeypatch.setattr(S, "COLLECT_ROWS", collect)
    rnd = random.Random(4)
    values = [KINDS[kind](rnd) for _ in range(4000)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    kept = sorted((v for v in values if v is not None), key=lambda v: (v != v, v))
    ranks = [1, 2, 17, len(kept) // 2, len(kept) - 1, len(kept), len(kept) + 1]
    for descending in (False, True):
        order = kept[::-1] if descending else kept
        want = [order[k - 1] if k <= len(order) else None for k in ranks]
        got = S.values_at(df, "v", ranks, descending)
        assert [repr(x) for x in got] == [repr(x) for x in want]


@pytest.mark.parametrize("ddl,make", [("decimal(18,2)", lambda i: Decimal(i * 7 % 1000) / 100), ("bigint", lambda i: i * 7 % 1000 - 500),
                                      ("date", lambda i: dt.date(2020, 1, 1) + dt.timedelta(days=i * 7 % 1000))])
def test_other_types(spark, monkeypatch, ddl, make):
    monkeypatch.setattr(S, "COLLECT_ROWS", 5)
    values = [make(i) for i in range(3000)]
    df = spark.createDataFrame([(v,) for v in values], f"v {ddl}")
    assert S.values_at(df, "v", [1, 700, 3000]) == [sorted(values)[k - 1] for k in (1, 700, 3000)]


@pytest.mark.parametrize("collect", [3, 10_000])
def test_first_rows_by_several_columns(spark, monkeypatch, collect):
    monkeypatch.setattr(S, "COLLECT_ROWS", collect)
    rnd = random.Random(9)
    rows = [(rnd.choice([0.1, 0.5, 0.5, 0.9]), rnd.randint(0, 30), i) for i in range(1500)]
    df = spark.createDataFrame(rows, "score double, merchant bigint, week bigint")
    order = sorted(rows, key=lambda r: (-r[0], r[1], r[2]))
    counts = [0, 1, 15, 400, 401, 1499, 1500, 9999]
    conditions = S.first_rows(df, [("score", True), ("merchant", False), ("week", False)], counts)
    for n, condition in zip(counts, conditions, strict=True):
        assert sorted(map(tuple, df.where(condition).collect())) == sorted(order[:n])


def test_rows_that_tie_on_every_column(spark):
    df = spark.createDataFrame([(1,), (1,)], "a int")
    with pytest.raises(ValueError):
        S.first_rows(df, [("a", False)], [1])


@settings(max_examples=15, deadline=None)
@given(st.lists(st.integers(-3, 3), min_size=1, max_size=30), st.data())
def test_any_rank_of_few_values(spark, values, data):
    k = data.draw(st.integers(1, len(values)))
    df = spark.createDataFrame([(v,) for v in values], "v int")
    old, S.COLLECT_ROWS = S.COLLECT_ROWS, 1
    try:
        assert S.values_at(df, "v", [k]) == [sorted(values)[k - 1]]
    finally:
        S.COLLECT_ROWS = old


def test_median_of_no_rows(spark):
    df = spark.createDataFrame([], "v double")
    assert S.median(df, "v") == (None, None) and EV.exact_median(df, "v").first()[0] is None


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_range_exchange(spark, monkeypatch):
    """Neither the plans nor the jobs before them range-partition the rows."""
    from pyspark.sql import DataFrame

    def fail(*_, **__):
        raise AssertionError("range partitioning")
    monkeypatch.setattr(DataFrame, "repartitionByRange", fail)
    rows = [(i, dt.date(2024, 1, 1), i % 3 == 0, i / 50) for i in range(50)]
    scored = spark.createDataFrame([(a, b, int(y), s) for a, b, y, s in rows],
                                   "merchant_id bigint, week_start_date date, y_true int, score double")
    for df in (EV.precision_recall_at_k(scored), EV.lift_table(scored), EV.exact_median(scored, "score")):
        df.collect()
        assert "rangepartitioning" not in plan(df.where(F.lit(True)))


def test_top_n_share_reads_the_fact_once(spark):
    from helpers import SF_SMALL

    from ledgerlens.sources.fixtures import Tables
    df = dashboard.top_n_gpv_share(Tables.from_raw(spark, SF_SMALL))
    df.collect()
    text = plan(df)
    assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text
