"""Catalog tables and SQL against the DataFrame forms; bucketed tables need no exchange."""
import math

import pytest
from helpers import SF_SMALL
from pyspark.sql import functions as F

from ledgerlens.plans import analysis, analysis_sql
from ledgerlens.plans import features as FT
from ledgerlens.session import shared_work_dir
from ledgerlens.sources import catalog, schemas
from ledgerlens.sources import warehouse as W
from ledgerlens.sources.fixtures import Tables


@pytest.fixture(scope="module")
def loaded(spark):
    base = shared_work_dir(spark, "test-catalog")
    t = W.load_warehouse(Tables.from_raw(spark, SF_SMALL), f"{base}/warehouse")
    catalog.create_tables(t, base, "payments_test")
    return t


def test_tables_have_the_declared_columns(spark, loaded):
    for name, schema in schemas.SCHEMAS.items():
        table = spark.table(f"payments_test.{name}")
        assert {(f.name, f.dataType) for f in table.schema} == {(f.name, f.dataType) for f in schema.fields}
    assert spark.table("payments_test.campaigns").count() == 0
    assert spark.sql("SELECT COUNT(*) FROM payments_test.transactions").first()[0] == loaded.transactions.count()
    one = spark.sql("SELECT * FROM payments_test.transactions WHERE partition_year = 1995 AND partition_month = 3")
    assert "PartitionFilters: [isnotnull(partition_year" in one._jdf.queryExecution().executedPlan().toString()


def same(a, b):
    return a == b or (isinstance(a, float) and isinstance(b, float) and math.isclose(a, b, rel_tol=1e-12, abs_tol=1e-12))


@pytest.mark.parametrize("name", analysis_sql.SQL)
def test_sql_equals_the_dataframe_form(spark, loaded, name):
    got, want = analysis_sql.run(spark, name, "payments_test"), analysis.QUERIES[name](loaded)
    assert set(got.columns) == set(want.columns) and set(analysis_sql.SQL) == set(analysis.QUERIES)
    rows = [sorted(map(tuple, df.select(*sorted(want.columns)).collect()), key=str) for df in (got, want)]
    assert len(rows[0]) == len(rows[1]) > 0
    assert all(same(x, y) for a, b in zip(*rows, strict=True) for x, y in zip(a, b, strict=True))


def test_labels_from_bucketed_features_need_no_exchange(spark, loaded):
    feats = catalog.write_bucketed(FT.merchant_week_features(loaded), "features_test", shared_work_dir(spark, "test-bucketed"), "merchant_id",
                                   FT.ID_COLUMNS, buckets=4)
    made = FT.training_table_from(feats)
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Bucketed: true" in plan
    want = FT.training_table(loaded)
    assert made.exceptAll(want.select(*made.columns)).count() == want.select(*made.columns).exceptAll(made).count() == 0


def test_cents_of_large_volumes(spark):
    cents = [1, 99, 4_503_599_627_370_497 % 10**15, 10**15 - 1, 123_456_789_012_345]
    df = spark.createDataFrame([(c, c / 100) for c in cents], "c bigint, gpv double")
    assert df.where(F.round(F.col("gpv") * 100).cast("bigint") != F.col("c")).count() == 0
