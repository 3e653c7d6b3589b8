"""Churn models: training, scoring, evaluation, importances, model card and the
model-scored outreach list.

* Every candidate is a Spark ML pipeline: exact median imputation, then trees on
  assembled vectors (the forest, ``plans/forest``, is class-balanced by ``weightCol``; boosting is in
  ``plans/boosting``), or nearest
  neighbours among all labelled rows (``plans/stages``; ``knn_exact`` compares with
  every row instead of probing hash tables).
* The winner of the model search can join them as a fourth candidate.
* So whichever is best is evaluated, explained, saved, loaded and used for
  outreach in the same way.
"""
from __future__ import annotations

import json
from concurrent.futures import ThreadPoolExecutor
from functools import cached_property, reduce

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.lineage import in_small_splits, is_written, materialize
from ..operators.ranking import global_order
from ..session import shared_work_dir
from ..sources.fixtures import Tables
from . import evaluation as EV
from . import features as FT
from .boosting import BoostingClassifier
from .forest import ForestClassifier
from .neighbours import WINDOW, HashedKnn
from .search import successive_halving
from .stages import HashedKnnClassifier, MedianImputer, MedianModel

SEED = 42
LABEL = "churn_4w"
# Model settings.
RF_PARAMS = dict(numTrees=300, maxDepth=6, minInstancesPerNode=20)
GBT_PARAMS = dict(maxIter=100, stepSize=0.05, maxDepth=3)
PERMUTATION_REPEATS = 8
MODEL_ORDER = ["random_forest", "gradient_boosting", "knn"]
EXACT_KNN = "knn_exact"
SEARCH = "model_search"
# Kinds of importance.
GINI, PERMUTATION = "random_forest_gini", "permutation_best_model"


def feature_names(training: DataFrame) -> list[str]:
    drop = set(FT.ID_COLUMNS) | set(FT.LABELS)
    return [c for c in training.columns if c not in drop]


def split_frames(training: DataFrame, label: str = LABEL, train_end_date: str | None = None):
    sided = EV.with_side(EV.labelled(training, label), train_end_date).withColumn(
        "label", F.col(label).cast("double"))
    train = sided.where(F.col("side") == "train").drop("side")
    test = sided.where(F.col("side") == "test").drop("side")
    return train, test


def with_class_weights(train: DataFrame) -> DataFrame:
    """w_c = n / (2 * n_c); the weight table has one row per class."""
    n = train.agg(F.count(F.lit(1))).scalar()
    w = train.groupBy("label").agg((n / (F.lit(2.0) * F.count(F.lit(1)))).alias("weight"))
    return train.join(F.broadcast(w), "label")


def _imputed(names: list[str]) -> list[str]:
    return [f"{c}__imp" for c in names]


def _prep(names: list[str]):
    return [MedianImputer(inputCols=names, outputCols=_imputed(names)), VectorAssembler(inputCols=_imputed(names), outputCol="features")]


def random_forest(names: list[str]) -> Pipeline:
    clf = ForestClassifier(labelCol="label", featuresCol="features", weightCol="weight", seed=SEED, **RF_PARAMS)
    return Pipeline(stages=_prep(names) + [clf])


def gradient_boosting(names: list[str]) -> Pipeline:
    clf = BoostingClassifier(labelCol="label", featuresCol="features", seed=SEED, **GBT_PARAMS)
    return Pipeline(stages=_prep(names) + [clf])


def nearest_neighbours(names: list[str], window: int = WINDOW) -> Pipeline:
    return Pipeline(stages=[MedianImputer(inputCols=names, outputCols=_imputed(names)),
                            HashedKnnClassifier(inputCols=_imputed(names), labelCol="label", window=window)])


#: Bytes of files in one partition of the rows that trees are fitted on.
TREE_SPLIT = "16m"

#: Model name -> pipeline over the named columns.
PIPELINES = {"random_forest": random_forest, "gradient_boosting": gradient_boosting, "knn": nearest_neighbours,
             EXACT_KNN: lambda names: nearest_neighbours(names, window=0)}


def score(model: PipelineModel, df: DataFrame, keep: list) -> DataFrame:
    """``keep`` columns and score (probability of the positive class)."""
    return model.transform(df).select(*keep, vector_to_array("probability")[1].alias("score"))


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


# ---------------------------------------------------------------- training run
class TrainRun:
    """The split of one training table, and models fitted on it when first asked for.

    ``training`` is a saved training table (by default built from ``t`` and written once).
    """

    def __init__(self, t: Tables, label: str = LABEL, train_end_date: str | None = None,
                 models: list[str] | None = None, training: DataFrame | None = None):
        self.t, self.label, self.train_end_date = t, label, train_end_date
        self.order = list(models or MODEL_ORDER)
        self.training = training if training is not None else materialize(FT.training_table(t), "training")
        self.names = feature_names(self.training)
        sided = EV.with_side(EV.labelled(self.training, label), train_end_date).withColumn("label", F.col(label).cast("double"))
        self.train = with_class_weights(sided.where(F.col("side") == "train").drop("side"))
        self.test = sided.where(F.col("side") == "test").drop("side")
        self._models: dict = {}
        self._predictions: dict[str, DataFrame] = {}
        self._metrics: dict[str, DataFrame] = {}

    @cached_property
    def imputer(self) -> MedianModel:
        """The medians of the training rows, searched once for all models."""
        return MedianImputer(inputCols=self.names, outputCols=_imputed(self.names)).fit(self.train)

    def model(self, name: str):
        if name not in self._models:
            pipeline = PIPELINES[name](self.names)
            stages = [self.imputer if isinstance(s, MedianImputer) else s for s in pipeline.getStages()]
            self._models[name] = pipeline.setStages(stages).fit(self.train if "knn" in name else self.tree_rows())
        return self._models[name]

    def measured(self, name: str) -> DataFrame:
        """The metrics row of one model, written once."""
        if name not in self._metrics:
            self._metrics[name] = materialize(EV.model_metrics(self.prediction(name), name), f"metrics-{name}")
        return self._metrics[name]

    def fit_all(self) -> None:
        """Fit, score and measure the candidates side by side: the short jobs of one run beside the long tasks of another."""
        left = [name for name in self.order if name not in self._metrics]
        if left:
            _ = self.imputer
            with ThreadPoolExecutor(len(left)) as pool:
                list(pool.map(inheritable_thread_target(self.training.sparkSession)(self.measured), left))

    def tree_rows(self) -> DataFrame:
        """The training rows in small partitions: trees keep every row of a partition unpacked over all their passes."""
        if not is_written(self.training):
            return self.train
        rows = in_small_splits(self.training, TREE_SPLIT)
        sided = EV.with_side(EV.labelled(rows, self.label), self.train_end_date).withColumn("label", F.col(self.label).cast("double"))
        return with_class_weights(sided.where(F.col("side") == "train").drop("side"))

    def prediction(self, name: str) -> DataFrame:
        """merchant_id, week_start_date, y_true and score of the holdout, written once."""
        if name not in self._predictions:
            keep = FT.ID_COLUMNS + [F.col("label").cast("int").alias("y_true")]
            self._predictions[name] = materialize(score(self.model(name), self.test, keep), f"pred-{name}")
        return self._predictions[name]

    def search(self, **options) -> DataFrame:
        """Run the model search; its winner becomes a candidate like the others."""
        table, winner = model_search(self.train, self.names, **options)
        self._models[SEARCH] = winner
        self._predictions.pop(SEARCH, None)
        self._metrics.pop(SEARCH, None)
        if SEARCH not in self.order:
            self.order.append(SEARCH)
        return table

    def split_facts(self) -> DataFrame:
        return EV.split_stats(self.training, self.label, self.train_end_date)

    def metrics(self) -> DataFrame:
        self.fit_all()
        return reduce(DataFrame.unionByName, [self.measured(m) for m in self.order])

    def best(self) -> str:
        return EV.best_model(self.metrics(), self.order).first()["model"]  # one row

    def save(self, base: str) -> dict[str, str]:
        self.fit_all()
        paths = {name: f"{base.rstrip('/')}/{name}" for name in self.order}
        for name, path in paths.items():
            save_model(self.model(name), path)
        return paths


def gini_importance(run: TrainRun) -> DataFrame:
    schema = "feature string, importance double, importance_type string"
    if "random_forest" not in run.order:
        return run.t.spark.createDataFrame([], schema)
    imp = run.model("random_forest").stages[-1].featureImportances.toArray().tolist()  # one value per feature
    return run.t.spark.createDataFrame([(f, float(v), GINI) for f, v in zip(run.names, imp, strict=True)], schema)


def permutation_importance(run: TrainRun, model_name: str, repeats: int = PERMUTATION_REPEATS) -> DataFrame:
    """Mean AUC drop when one feature is shuffled over the holdout, per feature.

    Each repeat has one permutation for all features: a row meets the row whose
    values it gets once, and one feature after another is swapped in after that.
    """
    names = run.names
    numbered = global_order(run.test.select(*FT.ID_COLUMNS, "label", *names),
                            [F.col("merchant_id"), F.col("week_start_date")], row_number="idx")
    hold = materialize(numbered, "hold")
    n = hold.count()
    copies = hold.select("idx", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))).alias("rep"))
    shuffled = global_order(copies.withColumn("rk", F.xxhash64(F.lit(SEED), "rep", "idx")),
                            [F.col("rep"), F.col("rk"), F.col("idx")], row_number="g")
    moves = shuffled.select("rep", "idx", (F.col("g") - F.col("rep") * n).alias("to"))
    values = hold.select(F.col("idx").alias("to"), F.array(*[F.col(c).cast("double") for c in names]).alias("other"))
    met = moves.join(values, "to").join(hold, "idx")
    swapped = met.select("rep", "label", "other", *names, F.explode(F.sequence(F.lit(0), F.lit(len(names) - 1))).alias("fid")).select(
        "rep", "fid", "label", *[F.when(F.col("fid") == i, F.col("other")[i]).otherwise(F.col(c).cast("double")).alias(c)
                                 for i, c in enumerate(names)])
    scored = score(run.model(model_name), swapped, ["rep", "fid", F.col("label").cast("int").alias("y_true")])
    aucs = grouped_auc(materialize(scored, "perm-scored"), ["rep", "fid"])
    base = EV.roc_auc_average_precision(run.prediction(model_name)).first()["roc_auc"]
    fmap = F.create_map(*[x for i, c in enumerate(names) for x in (F.lit(i), F.lit(c))])
    return aucs.groupBy("fid").agg(F.avg(F.lit(base) - F.col("roc_auc")).alias("importance")).select(
        fmap[F.col("fid")].alias("feature"), "importance", F.lit(PERMUTATION).alias("importance_type"))


def grouped_auc(scored: DataFrame, groups: list[str]) -> DataFrame:
    """Tie-aware ROC AUC per group (groups: a small, structurally bounded set)."""
    counts = scored.groupBy(*groups, "score").agg(
        F.sum("y_true").cast("bigint").alias("pos"), F.sum(1 - F.col("y_true")).cast("bigint").alias("neg"))
    order = [F.col(g) for g in groups] + [F.col("score").desc()]
    ranked = global_order(counts, order, running_sums={"tp": "pos"})
    totals = counts.groupBy(*groups).agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    gw = Window.orderBy(*groups).rowsBetween(Window.unboundedPreceding, -1)  # one row per group
    starts = totals.withColumn("p_before", F.coalesce(F.sum("P").over(gw), F.lit(0)))
    joined = ranked.join(F.broadcast(starts), groups)
    tp_in = F.col("tp") - F.col("p_before")
    terms = joined.select(*groups, "P", "N", (F.col("neg") * (2 * (tp_in - F.col("pos")) + F.col("pos"))).alias("a2"))
    agg = terms.groupBy(*groups, "P", "N").agg(F.sum("a2").alias("a2"))
    return agg.select(*groups, F.when((F.col("P") > 0) & (F.col("N") > 0),
                                      F.col("a2").cast("double") / (F.lit(2.0) * F.col("P") * F.col("N")))
                      .alias("roc_auc"))


def feature_importance(run: TrainRun) -> DataFrame:
    """Gini importance of the forest and permutation importance of the best model, whichever it is."""
    best = run.best()
    return gini_importance(run).unionByName(permutation_importance(run, best))


def eval_metrics(run: TrainRun) -> DataFrame:
    """Metrics rows per model with label, split date, and rows and date range of each side."""
    facts = {r["side"]: r for r in run.split_facts().collect()}  # two rows
    sides = [F.lit(facts[side][c]).alias(name) for side in ("train", "test")
             for c, name in (("rows", f"{side}_rows"), ("start_date", f"{side}_start"), ("end_date", f"{side}_end"))]
    return run.metrics().select(F.lit(run.label).alias("label"), F.lit(facts["train"]["split_date"]).alias("split_date"), *sides, "*")


def model_card(run: TrainRun, model_paths: dict[str, str]) -> dict:
    """Small driver-side record (best model, features, metrics, split) for JSON."""
    best = run.best()
    m = [r.asDict() for r in run.metrics().where(F.col("model") == best).collect()][0]  # one row
    facts = {r["side"]: r.asDict() for r in run.split_facts().collect()}  # two rows
    return {
        "label": run.label,
        "feature_names": run.names,
        "best_model": {"name": best, "path": model_paths[best], "metrics": m},
        "training": {side: {"rows": v["rows"], "start": str(v["start_date"]), "end": str(v["end_date"]),
                            "split_date": str(v["split_date"])} for side, v in facts.items()},
    }


def write_model_card(card: dict, path: str, spark) -> None:
    spark.createDataFrame([(json.dumps(card, default=str),)], "card string").coalesce(1).write.mode(
        "overwrite").text(path)


def read_model_card(path: str, spark) -> dict:
    return json.loads(spark.read.text(path).first()["value"])


def score_latest_week(t: Tables, card: dict, features: DataFrame | None = None) -> DataFrame:
    """Latest week of the unexpanded features (saved, or built from ``t``) scored by the saved best model, ranked."""
    feats = features if features is not None else materialize(FT.merchant_week_features(t), "features")
    best = card["best_model"]
    model = load_model(best["path"])
    return EV.outreach(feats, score(model, EV.latest_week(feats), FT.ID_COLUMNS + card["feature_names"]))


def model_search(train: DataFrame, names: list[str], recent_weeks: int | None = EV.SEARCH_RECENT_WEEKS,
                 max_rows: int | None = EV.SEARCH_MAX_ROWS, **options) -> tuple[DataFrame, PipelineModel]:
    """Successive halving over model families on the sample of the training rows (``recent_weeks``, ``max_rows``),
    within ``seconds`` if given: the result of every fit, and the best model."""
    sample = EV.search_training_sample(train, recent_weeks, max_rows)

    def prepare(classifier):
        return Pipeline(stages=[*_prep(names), classifier])
    found = successive_halving(sample.select(*FT.ID_COLUMNS, "label", "weight", *names), FT.ID_COLUMNS, prepare, **options)
    return found.table, found.model


# ---------------------------------------------------------------- query keys (rows-only checks)
_RUNS: dict[tuple, TrainRun] = {}


def _files_as_they_are(t: Tables) -> tuple:
    """Path, size and time of change of every input file."""
    out, jvm, conf = [], t.spark.sparkContext._jvm, t.spark.sparkContext._jsc.hadoopConfiguration()
    for f in sorted(t.transactions.inputFiles()):
        path = jvm.org.apache.hadoop.fs.Path(f)
        status = path.getFileSystem(conf).getFileStatus(path)
        out.append((f, status.getLen(), status.getModificationTime()))
    return tuple(out)


def trained(t: Tables, label: str = LABEL) -> TrainRun:
    """A run over the input files as they are now: the keys below share its models as long as
    neither the files nor the session changes and its training table is there."""
    key = (t.spark.sparkContext.applicationId, label, _files_as_they_are(t))
    run = _RUNS.get(key)
    if run is not None:
        path = t.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(run.training.inputFiles()[0])
        if path.getFileSystem(t.spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
            return run
    _RUNS.clear()
    _RUNS[key] = TrainRun(t, label)
    return _RUNS[key]


def q_rf_scores(t: Tables) -> DataFrame:
    return trained(t).prediction("random_forest")


def q_gbt_scores(t: Tables) -> DataFrame:
    return trained(t).prediction("gradient_boosting")


def q_knn_scores(t: Tables) -> DataFrame:
    return trained(t).prediction("knn")


def q_model_search(t: Tables) -> DataFrame:
    run = TrainRun(t, training=trained(t).training)
    return run.search()


def q_eval_metrics(t: Tables) -> DataFrame:
    return eval_metrics(trained(t))


def q_feature_importance(t: Tables) -> DataFrame:
    return feature_importance(trained(t))


def q_feature_importance_gini(t: Tables) -> DataFrame:
    return gini_importance(trained(t))


def q_feature_importance_permutation(t: Tables) -> DataFrame:
    run = trained(t)
    return permutation_importance(run, run.best())


def _saved_card(t: Tables) -> dict:
    run = trained(t)
    base = shared_work_dir(t.spark, "models")
    write_model_card(model_card(run, run.save(base)), f"{base}/model_card", t.spark)
    return read_model_card(f"{base}/model_card", t.spark)


def q_model_card(t: Tables) -> DataFrame:
    back = _saved_card(t)
    return t.spark.createDataFrame([(back["label"], back["best_model"]["name"], len(back["feature_names"]),
                                     json.dumps(back, default=str))],
                                   "label string, best_model string, n_features int, card string")


def q_outreach_model_scores(t: Tables) -> DataFrame:
    card = _saved_card(t)
    return score_latest_week(t, card).withColumn("model", F.lit(card["best_model"]["name"]))


def check_same_rows(written: DataFrame, back: DataFrame) -> DataFrame:
    """One row: rows that are in one of both only, however often (differing_rows), and rows read back.

    Rows are added up with their sign, so one exchange compares both ways. A ValueError if
    nothing was read back or anything differs.
    """
    signed = written.withColumn("_n", F.lit(1)).unionByName(back.withColumn("_n", F.lit(-1)))
    per = signed.groupBy(*written.columns).agg(F.sum("_n").alias("_n"))
    out = per.agg(F.coalesce(F.sum(F.abs("_n")), F.lit(0)).cast("bigint").alias("differing_rows")).select(
        "differing_rows", back.agg(F.count(F.lit(1))).scalar().alias("rows"))
    differing, rows = out.first()
    if not rows:
        raise ValueError("feature table is empty")
    if differing:
        raise ValueError(f"{differing} rows differ between the feature table and its files")
    return written.sparkSession.createDataFrame([(differing, rows)], "differing_rows bigint, rows bigint")


def q_feature_table_roundtrip(t: Tables) -> DataFrame:
    """Write the feature table, read it back; any difference is an error.

    The features are computed once and kept until both are compared.
    """
    feats = FT.merchant_week_features(t).persist(StorageLevel.DISK_ONLY)
    try:
        path = shared_work_dir(t.spark, "features")
        feats.write.mode("overwrite").parquet(path)
        return check_same_rows(feats, t.spark.read.parquet(path))
    finally:
        feats.unpersist()


def q_knn_slice_scores(t: Tables) -> DataFrame:
    """Nearest neighbours in the exact form: the first holdout week against the last weeks of the training side."""
    run = trained(t)
    sided = EV.with_side(EV.labelled(run.training, run.label)).withColumn("label", F.col(run.label).cast("double"))
    train = EV.search_training_sample(sided.where(F.col("side") == "train"), EV.SEARCH_RECENT_WEEKS, None)
    test = sided.where(F.col("side") == "test")
    model = HashedKnn.fit(train, run.names, window=None)
    scored = model.score(EV.first_week(test), FT.ID_COLUMNS)
    return scored.select(*FT.ID_COLUMNS, F.round("score", 6).alias("score"))


QUERIES = {
    "rf_scores": q_rf_scores,
    "gbt_scores": q_gbt_scores,
    "knn_scores": q_knn_scores,
    "knn_slice_scores": q_knn_slice_scores,
    "model_search": q_model_search,
    "eval_metrics": q_eval_metrics,
    "feature_importance_gini": q_feature_importance_gini,
    "feature_importance_permutation": q_feature_importance_permutation,
    "feature_importance": q_feature_importance,
    "model_card": q_model_card,
    "outreach_model_scores": q_outreach_model_scores,
    "feature_table_roundtrip": q_feature_table_roundtrip,
}
