"""Features, weekly spine and label edge cases (hand-made micro tables)."""
import datetime as dt

from helpers import tables, txn

from ledgerlens.plans import features as FT


def _weeks(start: str, offsets, merchant=1, approved=True, amount="100.00"):
    base = dt.date.fromisoformat(start)
    return [txn(1000 * merchant + i, (base + dt.timedelta(weeks=o)).isoformat(), merchant=merchant,
                approved=approved, amount=amount) for i, o in enumerate(offsets)]


def _labels(t):
    return {(r["merchant_id"], r["week_start_date"]): r for r in FT.training_table(t).collect()}


def test_gap_of_four_vs_three_weeks(spark):
    # merchant 1 active weeks 0 and 5 (4 empty weeks between) and more weeks after;
    # merchant 2 active weeks 0 and 4 (3 empty weeks)
    a = _weeks("2024-01-01", [0, 5, 6, 7, 8, 9], merchant=1)
    b = _weeks("2024-01-01", [0, 4, 5, 6, 7, 8], merchant=2)
    lab = _labels(tables(spark, a + b))
    assert lab[(1, dt.date(2024, 1, 1))]["churn_4w"] == 1.0
    assert lab[(2, dt.date(2024, 1, 1))]["churn_4w"] == 0.0


def test_gone_for_good_is_null_not_one(spark):
    lab = _labels(tables(spark, _weeks("2024-01-01", range(6))))
    last4 = [lab[(1, dt.date(2024, 1, 1) + dt.timedelta(weeks=w))]["churn_4w"] for w in range(2, 6)]
    assert last4 == [None, None, None, None]


def test_short_history_has_no_decline_label(spark):
    lab = _labels(tables(spark, _weeks("2024-01-01", range(7))))
    assert all(r["rev_decline_40pct"] is None for r in lab.values())


def test_exactly_sixty_percent_is_decline(spark):
    # 4 weeks at 100.00 then 4 weeks at 60.00: week 4's trailing 400, future 240 = 60 %
    txns = _weeks("2024-01-01", range(4)) + [
        txn(2000 + i, (dt.date(2024, 1, 29) + dt.timedelta(weeks=i)).isoformat(), amount="60.00") for i in range(4)]
    lab = _labels(tables(spark, txns))
    assert lab[(1, dt.date(2024, 1, 22))]["rev_decline_40pct"] == 1.0


def test_iso_year_edge_and_channel_spelling(spark):
    t = tables(spark, [txn(1, "2024-12-31", channel="in_app"), txn(2, "2025-01-01", channel="inapp"),
                       txn(3, "2025-01-02", channel="pos", amount="200.00")])
    f = FT.merchant_week_features(t).collect()
    assert len(f) == 1
    r = f[0]
    assert r["week_start_date"] == dt.date(2024, 12, 30)
    assert r["week_of_year"] == 1 and r["month"] == 12
    assert r["share_inapp"] == 0.5 and r["share_pos"] == 0.5
    assert r["active_days"] == 3 and r["txn_frequency"] == 1.0


def test_zero_approved_week_shares_zero(spark):
    t = tables(spark, [txn(1, "2024-01-01", approved=False), txn(2, "2024-01-02", approved=False)])
    r = FT.merchant_week_features(t).collect()[0]
    assert r["gpv"] == 0.0 and r["fee_yield"] == 0.0 and r["share_card"] == 0.0
    assert r["decline_rate"] == 1.0 and r["gpv_volatility"] == 0.0


def test_grid_zero_fills_gaps(spark):
    t = tables(spark, _weeks("2024-01-01", [0, 3]))
    g = sorted(FT.weekly_grid(t).collect(), key=lambda r: r["week_start_date"])
    assert len(g) == 4
    assert [r["txns"] for r in g] == [1, 0, 0, 1]
    assert g[1]["month"] == 1 and g[1]["week_of_year"] == 2
