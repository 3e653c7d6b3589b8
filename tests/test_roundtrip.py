"""Differences between a table and its files are found both ways."""
import pytest

from ledgerlens.plans.models import check_same_rows


@pytest.mark.parametrize("back", [[(1, None)], [(1, None), (2, 0.5), (3, 1.0)], [(1, None), (2, 0.25)], [(1, None), (2, 0.5), (2, 0.5)]])
def test_lost_new_changed_and_repeated_rows(spark, back):
    make = lambda rows: spark.createDataFrame(rows, "a int, b double")
    with pytest.raises(ValueError, match="differ"):
        check_same_rows(make([(1, None), (2, 0.5)]), make(back))


def test_same_and_empty(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, 0.5)], "a int, b double")
    assert tuple(check_same_rows(df, df).first()) == (0, 3)
    with pytest.raises(ValueError, match="empty"):
        check_same_rows(df.limit(0), df.limit(0))
