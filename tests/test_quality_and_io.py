"""Data-quality checks with real hits, the gate, input guard and partitioned IO."""
import pytest
from pyspark.sql import functions as F

from helpers import SF_SMALL
from ledgerlens.plans import quality
from ledgerlens.session import shared_work_dir
from ledgerlens.sources import warehouse as W
from ledgerlens.sources.fixtures import Tables


def _variant(spark):
    base = Tables.from_raw(spark, SF_SMALL)
    tx = base.transactions
    tx = tx.withColumn("amount", F.when(F.col("txn_id") % 97 == 0, F.lit(None)).otherwise(F.col("amount")))
    tx = tx.withColumn("amount", F.when(F.col("txn_id") % 101 == 0, -F.col("amount")).otherwise(F.col("amount")))
    me = base.merchants.where(F.col("merchant_id") % 10 != 0)
    return Tables.from_frames(spark, transactions=tx, merchants=me, customers=base.customers), tx


def test_checks_find_planted_problems(spark):
    t, tx = _variant(spark)
    nulls = quality.dq_nulls_transactions(t).first()
    assert nulls["amount_nulls"] == tx.where(F.col("amount").isNull()).count() > 0
    rng = quality.dq_range_checks(t).first()
    assert rng["invalid_amounts"] > 0 and rng["invalid_approved"] == 0
    fk = quality.dq_fk_merchant(t).first()["missing_merchants"]
    expect = tx.select("merchant_id").distinct().where(F.col("merchant_id") % 10 == 0).count()
    assert fk == expect > 0
    with pytest.raises(quality.QualityError):
        quality.enforce(t)


def test_clean_data_passes_gate(spark):
    report = quality.enforce(Tables.from_raw(spark, SF_SMALL))
    assert report.count() > 0


def test_missing_input_raises(spark):
    with pytest.raises(FileNotFoundError):
        W.require_input(spark, "/root/testdata/does-not-exist.parquet", "transactions")


def test_partitioned_roundtrip(spark):
    t = Tables.from_raw(spark, SF_SMALL)
    path = shared_work_dir(spark, "test-layout")
    W.write_year_month_layout(t.transactions, path)
    back = W.read_year_month_layout(spark, path)
    assert back.count() == t.transactions.count()
    assert dict(back.dtypes)["partition_month"] == "int"
    wh = W.load_warehouse(t, shared_work_dir(spark, "test-wh"))
    assert wh.transactions.count() == t.transactions.count()
    assert sorted(wh.transactions.columns) == sorted(t.transactions.columns)
