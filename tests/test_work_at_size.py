"""Work that must not grow faster than the input: how often inputs are read, and what is exchanged."""
import uuid

from helpers import merchant, tables, txn
from pyspark.sql import functions as F

from ledgerlens.operators.lineage import is_written
from ledgerlens.plans import cube as C
from ledgerlens.plans import features as FT
from ledgerlens.plans import kpis, loads
from ledgerlens.plans import models as M


def some(spark, n=60):
    rows = [txn(i, f"2024-{1 + i % 3:02d}-{1 + i % 28:02d}", merchant=i % 4, amount=f"{10 + i}.25", approved=i % 5 > 0) for i in range(n)]
    return tables(spark, rows, merchants=[merchant(m) for m in range(3)])


def executed(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_all_marts_read_one_written_fact(spark, monkeypatch):
    t, seen = some(spark), []
    monkeypatch.setattr(loads.kpis, "MARTS", {name: (lambda f: lambda got: seen.append(got.transactions) or f(got))(f)
                                              for name, f in kpis.MARTS.items()})
    assert loads.mart_export_counts(t).count() == 6
    assert len(seen) == 6 and all(is_written(f) for f in seen) and len({id(f) for f in seen}) == 1


def test_bitmaps_of_the_cube_are_not_exchanged(spark):
    plan = executed(C.kpi_cube(some(spark)))
    last = plan.rindex("bitmap_construct_agg")
    assert "Exchange rangepartitioning" not in plan[:last] and plan.count("Exchange rangepartitioning") == 1


def test_features_exchange_the_fact_once(spark):
    plan = executed(FT.merchant_week_features(some(spark)))
    assert plan.count("Exchange") == 1 and "hashpartitioning(merchant_id" in plan


def test_the_roundtrip_computes_the_features_once(spark, monkeypatch):
    """A marker of the run in each row differs if the rows are computed again."""
    real, run = FT.merchant_week_features, F.udf(lambda _: uuid.uuid4().hex).asNondeterministic()
    monkeypatch.setattr(M.FT, "merchant_week_features", lambda t: real(t).withColumn("run", run("txns")))
    row, = M.q_feature_table_roundtrip(some(spark)).collect()
    assert row.differing_rows == 0 and row["rows"] > 0


def test_trees_are_fitted_on_small_partitions(spark, monkeypatch):
    rows = spark.range(20_000).selectExpr("id merchant_id", "date_add(date'2024-01-01', int(id % 20) * 7) week_start_date", "double(id % 2) churn_4w",
                                          "0.0 rev_decline_40pct", "rand(1) a", "rand(2) b").coalesce(1)
    run = M.TrainRun(None, training=M.materialize(rows, "test-training"))
    monkeypatch.setattr(M, "TREE_SPLIT", "64k")
    small = run.tree_rows()
    assert small.rdd.getNumPartitions() > run.train.rdd.getNumPartitions()
    assert sorted(map(tuple, small.select(run.train.columns).collect())) == sorted(map(tuple, run.train.collect()))
