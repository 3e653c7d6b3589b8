"""KPI tiles from the cube against the fact, for any filters."""
import datetime as dt
import random

import pytest
from helpers import SF_SMALL, merchant, tables, txn
from pyspark.sql import functions as F

from ledgerlens.plans import cube as C
from ledgerlens.plans import dashboard as D
from ledgerlens.session import shared_work_dir
from ledgerlens.sources.fixtures import Tables

REGIONS, SIZES = ["EUROPE", "ASIA", "AFRICA"], ["small", "medium", "enterprise"]
CHANNELS, METHODS = ["pos", "ecom", "inapp"], ["card", "ach", "wallet"]


def some(rnd, values):
    return rnd.choice([None, rnd.sample(values, rnd.randint(1, len(values)))])


@pytest.fixture(scope="module")
def made(spark):
    """Transactions over three months, orphan merchants, null dimensions, ids in several buckets."""
    rnd = random.Random(6)
    ids = [0, 1, 2, 40_000, 40_001, 80_000, -5]
    rows = [txn(i, str(dt.date(2024, 1, 1) + dt.timedelta(days=rnd.randint(0, 95))), merchant=rnd.choice([*ids, 7, 123_456]),
                amount=f"{rnd.randint(1, 9999)}.{rnd.randint(10, 99)}", approved=rnd.random() < 0.8, method=rnd.choice(METHODS),
                channel=rnd.choice(CHANNELS)) for i in range(800)]
    rows.append(txn(900, "2024-02-01", merchant=None, channel=None))
    t = tables(spark, rows, merchants=[merchant(m, region=rnd.choice([*REGIONS, None]), size=rnd.choice(SIZES)) for m in ids])
    return t, C.write_cube(t, shared_work_dir(spark, "test-cube"))


@pytest.mark.parametrize("seed", range(12))
def test_any_filters(made, seed):
    t, cube = made
    rnd = random.Random(seed)
    days = sorted(str(dt.date(2023, 12, 20) + dt.timedelta(days=rnd.randint(0, 125))) for _ in range(2))
    filters = dict(start=rnd.choice([None, days[0], "2024-02-01"]), end=rnd.choice([None, days[1], "2024-02-29"]), regions=some(rnd, REGIONS),
                   sizes=some(rnd, SIZES), channels=some(rnd, CHANNELS), methods=some(rnd, METHODS))
    got, want = C.filtered_kpis(cube, **filters).collect(), D.filtered_kpis(t, **filters).collect()
    assert [tuple(r) for r in got] == [tuple(r) for r in want], filters


def test_fact_is_not_read_and_whole_months_are(made):
    _, cube = made
    asked = C.filtered_kpis(cube, start="2024-01-10", end="2024-03-20")
    assert all("cube" in f for f in asked.inputFiles())
    assert C.active_merchants(cube).first()[0] == 7
    cells = cube.where("grain = 'month'")
    assert cells.agg(F.sum("txns")).first()[0] == 801


def test_cube_of_the_fixture(spark):
    t = Tables.from_raw(spark, SF_SMALL)
    cube = C.write_cube(t, shared_work_dir(spark, "test-cube-fixture"))
    assert C.active_merchants(cube).first()[0] == D.active_merchants(t).first()[0]
    assert tuple(C.filtered_kpis(cube, **D.EXAMPLE_FILTERS).first()) == tuple(D.filtered_kpis_example(t).first())


def test_cube_of_no_rows(spark):
    t = tables(spark, [txn(1, "2024-01-01")])
    empty = t.replace(transactions=t.transactions.limit(0))
    cube = C.write_cube(empty, shared_work_dir(spark, "test-cube-empty"))
    assert tuple(C.filtered_kpis(cube).first()) == tuple(D.filtered_kpis(empty).first())
