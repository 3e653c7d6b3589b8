"""Property checks on the driver's sf0.001 tables."""
import pytest
from pyspark.sql import functions as F

from helpers import SF_SMALL
from ledgerlens.plans import analysis, dashboard, evaluation, features, kpis
from ledgerlens.sources.fixtures import Tables


@pytest.fixture(scope="module")
def t(spark):
    return Tables.from_raw(spark, SF_SMALL)


def test_txn_totals_agree(t):
    n = t.transactions.count()
    assert kpis.kpi_daily(t).agg(F.sum("txns")).first()[0] == n
    assert kpis.kpi_monthly(t).agg(F.sum("txns")).first()[0] == n


def test_rates_in_unit_interval(t):
    for df, c in [(kpis.kpi_daily(t), "approval_rate"), (kpis.merchant_cohorts(t), "retention_rate"),
                  (kpis.decline_drivers(t), "decline_rate"), (features.merchant_week_features(t), "decline_rate")]:
        lo, hi = df.agg(F.min(c), F.max(c)).first()
        assert 0 <= lo <= hi <= 1


def test_shares_sum_to_one(t):
    s = analysis.payment_method_mix(t).where(F.col("share").isNotNull()).groupBy("txn_date", "channel").agg(
        F.sum("share").alias("s"))
    assert s.where(F.abs(F.col("s") - 1) > 1e-9).count() == 0
    assert abs(dashboard.region_gpv_share(t).agg(F.sum("gpv_share")).first()[0] - 1) < 1e-9


def test_cohort_bounds(t):
    mc = kpis.merchant_cohorts(t).join(kpis.merchant_cohort_sizes(t), "signup_month")
    assert mc.where((F.col("month_index") < 0) | (F.col("retained_merchants") > F.col("cohort_merchants"))).count() == 0


def test_grid_rows_identity(t):
    f = features.merchant_week_features(t)
    expect = f.groupBy("merchant_id").agg(
        (F.datediff(F.max("week_start_date"), F.min("week_start_date")) / 7 + 1).alias("n")).agg(F.sum("n")).first()[0]
    assert features.weekly_grid(t).count() == expect


def test_capture_ends_at_one(spark, t):
    lt = evaluation.q_lift_table(t).orderBy("decile").collect()
    positives = sum(r["positives"] for r in lt)
    if positives:
        assert lt[-1]["cumulative_capture"] == pytest.approx(1.0)
