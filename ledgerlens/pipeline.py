"""End-to-end job: the warehouse flow as plain functions.

load (typed full refresh) -> quality gate -> KPI marts (CSV) -> merchant-week
features (parquet) -> labels / training table (parquet) -> models -> metrics
(JSON), lift and importances (CSV), model card (JSON) -> latest-week outreach
list (CSV). Every step is a Spark job; only small, bounded records (metric
rows, the card) reach the driver.
"""
from __future__ import annotations

import zlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from .operators.lineage import written_tables_removed
from .plans import evaluation as EV
from .plans import features as FT
from .plans import loads, models, quality
from .session import ensure_checkpoint_dir
from .sources import warehouse as W
from .sources.catalog import write_bucketed
from .sources.fixtures import Tables


@dataclass
class RunPaths:
    base: str

    def __post_init__(self):
        self.base = self.base.rstrip("/")

    @property
    def warehouse(self) -> str:
        return f"{self.base}/warehouse"

    @property
    def marts(self) -> str:
        return f"{self.base}/marts"

    @property
    def features(self) -> str:
        return f"{self.base}/ml/features_merchant_week"

    @property
    def training(self) -> str:
        return f"{self.base}/ml/training_table"

    @property
    def models(self) -> str:
        return f"{self.base}/ml/models"

    @property
    def metrics(self) -> str:
        return f"{self.base}/ml/eval_metrics"

    @property
    def lift(self) -> str:
        return f"{self.base}/ml/lift_table"

    @property
    def importance(self) -> str:
        return f"{self.base}/ml/feature_importance"

    @property
    def card(self) -> str:
        return f"{self.base}/ml/models/model_card"

    @property
    def scores(self) -> str:
        return f"{self.base}/ml/scores_latest_week"


def load_tables(spark: SparkSession, source: str, paths: RunPaths, layout: str = "payments", reuse: bool = False,
                observed: dict | None = None) -> Tables:
    """Input presence check, then the typed full-refresh load, whose write jobs count the checks into ``observed``.

    With ``reuse`` a finished load that is there is taken as it is.
    layout "payments": merchants.parquet, customers.parquet and a transactions/year=/month=
    tree under ``source``; "fixtures": the tables of FIXTURES.md.
    """
    base = source.rstrip("/")
    if reuse and (there := W.current_load(spark, paths.warehouse)):
        return Tables.from_warehouse(spark, there)
    options = {"checks": quality.row_checks, "observed": observed}
    if layout == "payments":
        for name in ("merchants.parquet", "customers.parquet", "transactions"):
            W.require_input(spark, f"{base}/{name}", name)
        return W.load_warehouse(Tables.from_payments(spark, base), paths.warehouse, **options)
    for name in ("supplier", "customer", "lineitem", "orders", "nation", "region"):
        W.require_input(spark, f"{base}/{name}.parquet", name)
    return W.load_warehouse(Tables.from_raw(spark, base), paths.warehouse, **options)


def summarize(t: Tables) -> DataFrame:
    """Snapshot summary row and the top industries by approved amount."""
    return quality.run_summary(t)


VIEW_NAMES = {name: f"v_{name}" for name in ("kpi_daily", "kpi_monthly", "industry_heatmap",
                                              "merchant_cohorts", "top_merchants", "decline_drivers")}


def register_kpi_views(t: Tables) -> dict[str, str]:
    """Register the six KPI marts as temporary views (lazy plans, like SQL views)."""
    from .plans import kpis
    for name, view in VIEW_NAMES.items():
        kpis.MARTS[name](t).createOrReplaceTempView(view)
    return dict(VIEW_NAMES)


def build_and_export_marts(t: Tables, paths: RunPaths) -> dict[str, int]:
    """Export the six KPI marts as CSV; mart -> rows written."""
    return loads.export_marts(t, paths.marts)


def _table(paths: RunPaths, name: str) -> str:
    """A name in the session's catalog that belongs to the run's folder."""
    return f"{name}_{zlib.crc32(paths.base.encode()):08x}"


def build_features(t: Tables, paths: RunPaths) -> DataFrame:
    """The feature table, bucketed by merchant and sorted by week."""
    out = write_bucketed(FT.merchant_week_features(t), _table(paths, "features"), paths.features, "merchant_id", FT.ID_COLUMNS)
    if out.limit(1).count() == 0:
        raise ValueError("feature table is empty")
    return out


def make_labels(t: Tables, paths: RunPaths, horizon: int = FT.HORIZON) -> DataFrame:
    """The training table from the saved features: spine and label windows work within the buckets."""
    features = t.spark.table(_table(paths, "features"))
    return write_bucketed(FT.training_table_from(features, horizon), _table(paths, "training"), paths.training, "merchant_id", FT.ID_COLUMNS)


def train_and_evaluate(t: Tables, paths: RunPaths, label: str = models.LABEL, train_end_date: str | None = None,
                       search: bool = False) -> dict:
    """Fit and compare the models on the saved training table, and save them with metrics and card."""
    run = models.TrainRun(t, label, train_end_date, training=t.spark.read.parquet(paths.training))
    if search:
        run.search()
    model_paths = run.save(paths.models)
    W.write_json(models.eval_metrics(run), paths.metrics)
    W.export_csv(EV.lift_table(run.prediction(run.best())).orderBy("decile"), paths.lift)
    W.export_csv(models.feature_importance(run).orderBy("importance", ascending=False), paths.importance)
    card = models.model_card(run, model_paths)
    models.write_model_card(card, paths.card, t.spark)
    return card


def score_latest_week(t: Tables, paths: RunPaths) -> DataFrame:
    """The outreach list, from the saved features and the saved best model."""
    card = models.read_model_card(paths.card, t.spark)
    outreach = models.score_latest_week(t, card, t.spark.read.parquet(paths.features))
    W.export_csv(outreach.orderBy("rank"), paths.scores)
    return outreach


def run_all(spark: SparkSession, source: str, out_base: str, label: str = models.LABEL,
            score_latest: bool = True, train_end_date: str | None = None, search: bool = False,
            layout: str = "payments", reuse: bool = False) -> dict:
    """The whole job. Tables written on the way to the checkpoint folder are removed at its end."""
    ensure_checkpoint_dir(spark)
    with written_tables_removed(spark):
        return _run_all(spark, source, RunPaths(out_base), label, score_latest, train_end_date, search, layout, reuse)


def _run_all(spark, source, paths, label, score_latest, train_end_date, search, layout, reuse) -> dict:
    observed: dict[str, dict] = {}
    t = load_tables(spark, source, paths, layout, reuse, observed)
    quality.enforce(t, observed=observed or None)
    register_kpi_views(t)
    summary = [r.asDict() for r in summarize(t).collect()]  # one row
    marts = build_and_export_marts(t, paths)
    build_features(t, paths)
    make_labels(t, paths)
    card = train_and_evaluate(t, paths, label, train_end_date, search)
    result = {"summary": summary, "marts": marts, "card": card}
    if score_latest:
        result["outreach_rows"] = score_latest_week(t, paths).count()
    return result
