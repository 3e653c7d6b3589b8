"""Edge cases of the KPI marts and analysis queries on hand-made micro tables."""
from helpers import merchant, rows, tables, txn

from ledgerlens.plans import analysis, dashboard, kpis


def test_day_with_only_declines(spark):
    t = tables(spark, [txn(1, "2024-01-01", approved=False), txn(2, "2024-01-01", approved=False),
                       txn(3, "2024-01-02")])
    daily = {r["day"].isoformat(): r for r in kpis.kpi_daily(t).collect()}
    assert daily["2024-01-01"]["gpv"] == 0.0
    assert daily["2024-01-01"]["approval_rate"] == 0.0
    take = {r["txn_date"].isoformat(): r for r in analysis.fee_take_rate_trend(t).collect()}
    assert take["2024-01-01"]["take_rate"] is None
    assert take["2024-01-01"]["approved_volume"] is None


def test_single_row_window(spark):
    t = tables(spark, [txn(1, "2024-01-01", amount="50.00")])
    r = analysis.region_volume_volatility(t).collect()[0]
    assert r["gpv_stddev_7d"] is None
    assert r["gpv_avg_7d"] == 50.0


def test_growth_after_zero_or_null_and_skipped_month(spark):
    # month 1: only declines (gpv NULL), month 2: 100, month 4: 300 (month 3 missing)
    t = tables(spark, [txn(1, "2024-01-05", approved=False), txn(2, "2024-02-05"),
                       txn(3, "2024-04-05", amount="300.00")])
    m = {r["month"].isoformat(): r for r in kpis.kpi_monthly(t).collect()}
    assert m["2024-02-01"]["mom_growth"] is None          # previous gpv NULL
    assert m["2024-04-01"]["mom_growth"] == 2.0           # previous *row* (Feb), not March


def test_rank_ties_dense_vs_rank(spark):
    t = tables(spark, [txn(1, "2024-01-01", merchant=1), txn(2, "2024-01-01", merchant=2),
                       txn(3, "2024-01-01", merchant=3, amount="50.00"),
                       txn(4, "2024-01-01", merchant=4, approved=False)])
    tm = {r["merchant_id"]: r["gpv_rank"] for r in kpis.top_merchants(t).collect()}
    assert tm == {1: 1, 2: 1, 3: 2, 4: 3}                 # NULL gpv ranks last
    pct = {r["merchant_id"]: r["rank_percentile"] for r in dashboard.rank_percentile(t).collect()}
    assert pct[4] == 0.0 and pct[1] == 1 - 1 / 3


def test_tied_top_movers_kept(spark):
    t = tables(spark, [txn(1, "2024-01-01", merchant=1), txn(2, "2024-02-01", merchant=1, amount="300.00"),
                       txn(3, "2024-01-01", merchant=2), txn(4, "2024-02-01", merchant=2, amount="300.00"),
                       txn(5, "2024-01-01", merchant=3), txn(6, "2024-02-01", merchant=3, amount="150.00")])
    got = rows(analysis.top_mom_movers(t), "merchant_id", "mom_growth")
    assert got == [(1, 2.0), (2, 2.0)]


def test_cohort_activity_before_signup_and_month_boundary(spark):
    ms = [merchant(1, signup="2024-01-31"), merchant(2, signup="2024-03-10")]
    t = tables(spark, [txn(1, "2024-02-01", merchant=1), txn(2, "2024-02-15", merchant=2)], merchants=ms)
    got = rows(kpis.merchant_cohorts(t), "signup_month", "month_index", "retained_merchants", "retention_rate")
    assert len(got) == 1
    assert got[0][1] == 1 and got[0][2] == 1 and got[0][3] == 1.0


def test_decline_drivers_degenerate(spark):
    t = tables(spark, [txn(1, "2024-01-01"), txn(2, "2024-01-01", approved=False, reason="fraud_suspected")])
    got = {(r["decline_reason"]): r["decline_rate"] for r in kpis.decline_drivers(t).collect()}
    assert got == {"unknown": 0.0, "fraud_suspected": 1.0}


def test_rolling_28_calendar_days(spark):
    t = tables(spark, [txn(1, "2024-01-01"), txn(2, "2024-01-28"), txn(3, "2024-01-29")])
    got = {r["day"].isoformat(): r["gpv_28d"] for r in dashboard.rolling_28d_gpv(t).collect()}
    assert got == {"2024-01-01": 100.0, "2024-01-28": 200.0, "2024-01-29": 200.0}
