"""Aggregates from Parquet footers."""
from helpers import SF_SMALL, tables, txn
from pyspark.sql import functions as F

from ledgerlens.plans import evaluation as EV
from ledgerlens.plans import loads
from ledgerlens.session import shared_work_dir
from ledgerlens.sources import footers
from ledgerlens.sources import warehouse as W
from ledgerlens.sources.fixtures import Tables


def test_counts_and_latest_week_of_a_loaded_warehouse(spark):
    raw = Tables.from_raw(spark, SF_SMALL)
    t = W.load_warehouse(raw, shared_work_dir(spark, "test-footers"))
    path = f"{t.folder}/transactions"
    plan = footers.aggregate(spark, path, F.count(F.lit(1)), F.max("txn_date"), F.min("txn_id"))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*), MAX(txn_date), MIN(txn_id)]" in text
    assert sorted(map(tuple, loads.table_row_counts(t).collect())) == sorted(map(tuple, loads.table_row_counts(raw).collect()))
    assert footers.largest(spark, path, "txn_date") == t.transactions.agg(F.max("txn_date")).first()[0]
    a, b = (sorted(map(tuple, EV.q_latest_week_features(x).collect())) for x in (t, raw))
    assert a == b and a
    # The session's own settings stay.
    assert spark.conf.get("spark.sql.sources.useV1SourceList") != ""


def test_one_row_and_none(spark):
    t = tables(spark, [txn(1, "2024-01-07")])
    one = W.load_warehouse(t, shared_work_dir(spark, "test-footers-one"))
    assert str(footers.largest(spark, f"{one.folder}/transactions", "txn_date")) == "2024-01-07"
    assert EV.latest_week_tables(one).transactions.count() == 1
