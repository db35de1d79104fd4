"""Forests of a table that fits a task: grown there, with the trees of passes over blocks."""

import pytest
from pyspark.sql import functions as F

from tabrix.operators import forest as T
from tests.test_forest import FEATURES, arrays, frame, plain, shape, table


@pytest.mark.parametrize("finish", [1 << 24, 1 << 12, 0])
def test_whole_tables_blocks_and_subtrees_give_the_same_trees(finish, spark, monkeypatch):
    df = frame(spark, table())
    roles = [F.lit(1), F.when(F.col("fold") != 0, 1)]

    def fit():
        return [shape(t) for f in T.fit_forests(df, FEATURES, roles, 4, 9, 6, 2, [11, 12])
                for t in f.trees]

    whole = fit()
    monkeypatch.setattr(T, "WHOLE_TIMES", 0)
    monkeypatch.setattr(T, "FINISH_BYTES", finish)
    monkeypatch.setattr(T, "BLOCK_ROWS", 200)
    assert fit() == whole
    x, y = arrays(table())
    assert whole[0] == plain(x, y, T.mix(11, 0), 9, 6, 2)


def test_rows_of_a_small_table_are_not_shuffled_once_a_tree(spark, monkeypatch):
    """A task gets the rows once, however many trees it grows."""
    def never(*args):
        raise AssertionError("rows shuffled by node")

    monkeypatch.setattr(T, "_finished", never)
    monkeypatch.setattr(T, "_grow", never)
    forest, = T.fit_forests(frame(spark, table()), FEATURES, [F.lit(1)], trees=40, max_depth=6)
    assert len(forest.trees) == 40 and all(len(t.feature) > 1 for t in forest.trees)
