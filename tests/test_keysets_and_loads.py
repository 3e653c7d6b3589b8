"""Key bitmaps against sets; counts and checks of write jobs; loads that become current at once."""
import random

import pytest
from helpers import SF_SMALL, customer, merchant, tables, txn
from pyspark.sql import functions as F

from ledgerlens.operators import keysets as K
from ledgerlens.plans import loads, quality
from ledgerlens.session import shared_work_dir
from ledgerlens.sources import warehouse as W
from ledgerlens.sources.fixtures import Tables


def keys(spark, values, name="k"):
    return spark.createDataFrame([(v,) for v in values], f"{name} bigint")


@pytest.mark.parametrize("seed", range(4))
def test_missing_keys_against_sets(spark, seed):
    rnd = random.Random(seed)
    dim = {rnd.randint(-40_000, 70_000) for _ in range(3000)}
    fact = [rnd.choice([None, rnd.randint(-50_000, 200_000), rnd.randint(0, 2 ** 60), rnd.choice(sorted(dim))]) for _ in range(4000)]
    other = {v for v in dim if v % 3}
    rows = spark.createDataFrame([(a, b) for a, b in zip(fact, reversed(fact))], "k bigint, j bigint")
    got = K.missing_keys(rows, {"n": (keys(spark, [*dim, None]), "k"), "m": (keys(spark, other, "j"), "j")}).first()
    assert tuple(got) == (len(set(fact) - dim), len(set(fact) - other))
    for values in (sorted(dim), []):
        assert K.missing_keys(keys(spark, values), {"n": (keys(spark, dim), "k")}).first()["n"] == 0


def test_dense_keys_and_repeats(spark):
    dims = {"close": range(1, 101), "few": range(10), "far": [i << 40 for i in range(500)], "none": [], "negative": range(-200, 0)}
    assert K.dense({name: (keys(spark, values), "k") for name, values in dims.items()}) == {"close", "negative"}
    assert K.repeats(keys(spark, [1, 2, 1]), "k") and not K.repeats(keys(spark, [1, 2, None, None, 1 << 50]), "k")


def test_both_ways_find_the_same_orphans(spark, monkeypatch):
    t = Tables.from_raw(spark, SF_SMALL)
    me = t.merchants.where(F.col("merchant_id") % 4 != 0)
    small = Tables.from_frames(spark, transactions=t.transactions, merchants=me, customers=t.customers)
    slow = quality.dq_fk_merchant(small).first()[0]
    monkeypatch.setattr(K, "DENSE", 1)
    assert quality.dq_fk_merchant(small).first()[0] == slow > 0
    plan = quality.dq_fk_customer(small)._jdf.queryExecution().executedPlan().toString()
    assert "bitmap_construct_agg" in plan and "LeftAnti" not in plan


def test_fact_rows_are_not_shuffled(spark, monkeypatch):
    """Rows that leave the fact's tasks: one for each bucket, however many rows the fact has."""
    fact = spark.range(0, 200_000, 1, 4).select((F.col("id") % 5000).alias("k"))
    used = K.key_bitmaps(fact, "k")
    assert used.count() == 2  # key 0 has a bucket of its own
    assert "partial_bitmap_construct_agg" in used._jdf.queryExecution().executedPlan().toString()


def test_write_jobs_count_rows_and_checks(spark):
    observed = {}
    rows = [txn(1, "2024-01-01", amount="-1.00"), txn(2, "2024-01-02", merchant=2), txn(3, "2024-02-01", approved=None)]
    t = tables(spark, rows, merchants=[merchant(1, industry=None)], customers=[customer(1)])
    loaded = W.load_warehouse(t, shared_work_dir(spark, "test-observed"), checks=quality.row_checks, observed=observed)
    assert {k: v["rows"] for k, v in observed.items()} == {"merchants": 1, "customers": 1, "transactions": 3}
    want = {tuple(r) for r in quality.dq_report(t).collect()}
    assert {tuple(r) for r in quality.observed_report(loaded, observed).collect()} == want
    assert {r[1] for r in want if not r[3]} >= {"industry_nulls", "invalid_amounts", "approved_nulls", "missing_merchants"}
    with pytest.raises(quality.QualityError):
        quality.enforce(loaded, observed=observed)


def test_empty_tables_are_counted_too(spark):
    observed = {}
    t = tables(spark, [txn(1, "2024-01-01")])
    empty = t.replace(transactions=t.transactions.limit(0))
    loaded = W.load_warehouse(empty, shared_work_dir(spark, "test-empty"), checks=quality.row_checks, observed=observed)
    assert observed["transactions"]["rows"] == 0
    assert all(r.violations == 0 and r.passed for r in quality.observed_report(loaded, observed).collect())


def test_export_counts_equal_the_files(spark):
    t = Tables.from_raw(spark, SF_SMALL)
    base = shared_work_dir(spark, "test-marts")
    for mart, rows in loads.export_marts(t, base).items():
        assert W.read_csv(spark, f"{base}/{mart}").count() == rows > 0


def test_a_load_becomes_current_at_its_end(spark, monkeypatch):
    base = shared_work_dir(spark, "test-current")
    t = tables(spark, [txn(1, "2024-01-01")])
    assert W.current_load(spark, base) is None
    W.load_warehouse(t, base)
    first = W.current_load(spark, base)

    def fail(*_):
        raise RuntimeError("lost")
    with monkeypatch.context() as m:
        m.setattr(W, "make_current", fail)
        with pytest.raises(RuntimeError):
            W.load_warehouse(tables(spark, [txn(2, "2024-01-01")]), base)
    assert W.current_load(spark, base) == first
    assert Tables.from_warehouse(spark, first).transactions.first()["txn_id"] == 1
    for i in (3, 4, 5):
        W.load_warehouse(tables(spark, [txn(i, "2024-01-01")]), base)
        assert Tables.from_warehouse(spark, W.current_load(spark, base)).transactions.first()["txn_id"] == i
    with pytest.raises(Exception):  # noqa: B017  (an old load is gone)
        spark.read.parquet(f"{first}/transactions").count()


def test_a_finished_load_is_used_again(spark):
    from ledgerlens.pipeline import RunPaths, load_tables
    paths = RunPaths(shared_work_dir(spark, "test-reuse"))
    first = load_tables(spark, SF_SMALL, paths, "fixtures")
    again = load_tables(spark, "/no/such/source", paths, "fixtures", reuse=True)
    assert again.label == first.label
