"""Score tables that do not match row by row are errors; fitted encoders stay as they are."""

import pytest

from tabrix.operators import encoders as enc
from tabrix.operators import ensemble as EN
from tabrix.operators import joins as J


def rows(spark, ids, name="x"):
    return spark.createDataFrame([(i, float(n)) for n, i in enumerate(ids)], f"id long, {name} double")


@pytest.mark.parametrize("left, right", [
    ([1, 1, 2, 3], [1, 1, 5, 6]), ([1, 2], [1, 3]), ([1, 2], [1, 2, 2]), ([1, 1, 2], [1, 2]),
    ([1, None], [1, None]), ([1, 2], [1])])
def test_attach_scores_needs_one_score_a_row(spark, left, right):
    with pytest.raises(ValueError, match="one-to-one"):
        J.attach_scores(rows(spark, left), rows(spark, right, "p"))


def test_attach_scores_matches_by_key(spark):
    got = J.attach_scores(rows(spark, [1, 2, 3]), rows(spark, [3, 1, 2], "p")).collect()
    assert sorted((r["id"], r["x"], r["p"]) for r in got) == [(1, 0, 1), (2, 1, 2), (3, 2, 0)]
    assert J.attach_scores(rows(spark, []), rows(spark, [], "p")).collect() == []


@pytest.mark.parametrize("a, b", [([1, 2], [1]), ([1], [1, 2]), ([1, 1], [2, 2]), ([1, 1], [1, 1]),
                                  ([1, None], [1])])
def test_blend_needs_every_id_once_in_every_part(spark, a, b):
    parts = {"a": rows(spark, a, "p"), "b": rows(spark, b, "p")}
    with pytest.raises(Exception, match="not once in every part"):
        EN.blend(parts, {"a": 0.7, "b": 0.3}).collect()


def test_blend(spark):
    a, b = rows(spark, [1, 2, 3], "p"), rows(spark, [3, 1, 2], "p")
    got = {r["id"]: r["p"] for r in EN.blend({"a": a, "b": b}, {"a": 0.5, "b": 2.0}).collect()}
    assert got == {1: 2.0, 2: 4.5, 3: 1.0}
    gap = spark.createDataFrame([(1, None), (2, 0.5), (3, 0.5)], "id long, p double")
    with pytest.raises(Exception, match="with a score"):
        EN.blend({"a": a, "b": gap}, {"a": 0.5, "b": 0.5}).collect()


def test_target_transform_leaves_the_fitted_object_alone(spark):
    df = spark.createDataFrame([("a", 1), ("a", 0), ("b", 1)], "k string, y int")
    new = spark.createDataFrame([("a",), ("z",)], "k string")
    fitted = enc.TargetEncoder(["k"], "y", 1).fit(df)
    before = dict(fitted.defaults)

    class Watched(dict):
        def __setitem__(self, *a):
            raise AssertionError("changed")

    fitted.defaults = Watched(fitted.defaults)
    bare = {r["k"]: r["k_target_enc"] for r in enc.target_transform(
        fitted, new, ["k"], fill_unseen=False).collect()}
    full = {r["k"]: r["k_target_enc"] for r in enc.target_transform(fitted, new, ["k"]).collect()}
    assert bare["z"] is None and full["z"] is not None and bare["a"] == full["a"]
    assert isinstance(fitted.defaults, Watched) and dict(fitted.defaults) == before
