"""End-to-end job on sf0.001: load, gate, marts (CSV), features and training
table (parquet), models, metrics (JSON), lift / importance (CSV), card, outreach."""
from helpers import SF_SMALL
from ledgerlens.pipeline import RunPaths, run_all
from ledgerlens.plans import models
from ledgerlens.session import shared_work_dir
from ledgerlens.sources import warehouse as W
from ledgerlens.sources.fixtures import Tables


def test_run_all(spark):
    base, raw = shared_work_dir(spark, "test-pipeline"), shared_work_dir(spark, "test-payments")
    source = Tables.from_raw(spark, SF_SMALL)
    source.merchants.write.parquet(f"{raw}/merchants.parquet")
    source.customers.write.parquet(f"{raw}/customers.parquet")
    W.write_year_month_layout(source.transactions.drop("txn_date"), f"{raw}/transactions")
    res = run_all(spark, raw, base)
    paths = RunPaths(base)
    assert res["marts"]["kpi_daily"] == W.read_csv(spark, paths.marts + "/kpi_daily").count() > 0
    assert set(res["marts"]) == {"kpi_daily", "kpi_monthly", "industry_heatmap", "merchant_cohorts",
                                 "top_merchants", "decline_drivers"}
    assert spark.read.parquet(paths.features).count() > 0
    training = spark.read.parquet(paths.training)
    assert {"churn_4w", "rev_decline_40pct"} <= set(training.columns)
    metrics = spark.read.json(paths.metrics)
    assert {r["model"] for r in metrics.select("model").collect()} == set(models.MODEL_ORDER)
    assert W.read_csv(spark, paths.lift).count() > 0
    assert W.read_csv(spark, paths.importance).count() > 0
    card = models.read_model_card(paths.card, spark)
    assert card["label"] == "churn_4w" and len(card["feature_names"]) == 20
    assert res["outreach_rows"] == W.read_csv(spark, paths.scores).count() > 0
    assert spark.sql("SELECT COUNT(*) FROM v_kpi_daily").first()[0] == res["marts"]["kpi_daily"]
    assert card["best_model"]["name"] == max(metrics.collect(), key=lambda r: r["roc_auc"] or -1)["model"]
    assert W.read_csv(spark, paths.importance).count() == 40


def test_missing_input_is_named(spark):
    import pytest
    with pytest.raises(FileNotFoundError, match="merchants"):
        run_all(spark, shared_work_dir(spark, "nothing"), shared_work_dir(spark, "out"))
