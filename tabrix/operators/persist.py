"""Saving fitted state as parquet and loading it in another session.

``save`` writes a folder: the lookup table (if there is one) as parquet and everything else as
one JSON row, both through Spark, so the folder can lie in any store.  MLlib models are saved by
their own writer.  ``load`` gives back an object of the same kind and behaviour."""

from __future__ import annotations

import json
from dataclasses import fields

import numpy as np
from pyspark.ml.classification import GBTClassificationModel, RandomForestClassificationModel
from pyspark.sql import DataFrame, SparkSession

from tabrix.functions.scalar import WidthCut
from tabrix.operators import boosting as B
from tabrix.operators import encoders as E
from tabrix.operators import forest as T
from tabrix.operators.models import Fitted


def _lookup_state(lk: E.FittedLookup) -> dict:
    return {"rows": lk.rows, "values": lk.values, "defaults": lk.defaults, "null_as": lk.null_as}


_NODE_KINDS = {f.name: ("array<array<boolean>>" if f.name == "sets" else
                        "array<double>" if f.name in ("value", "gain") else
                        "array<boolean>" if f.name == "missing_left" else "array<long>")
               for f in fields(B.Tree)}


def _tree_table(spark: SparkSession, trees: list[B.Tree]) -> DataFrame:
    """One row a tree, one array a field."""
    rows = [(i, *[getattr(t, c).tolist() for c in _NODE_KINDS]) for i, t in enumerate(trees)]
    return spark.createDataFrame(rows, ", ".join(
        ["tree int", *[f"`{c}` {k}" for c, k in _NODE_KINDS.items()]]))


def _tree(row) -> B.Tree:
    kinds = {"value": float, "gain": float, "missing_left": bool, "sets": bool, "cover": np.int64}
    out = {c: np.array(row[c], kinds.get(c, np.int32)) for c in _NODE_KINDS}
    if not len(out["sets"]):
        out["sets"] = np.zeros((0, 0), bool)
    return B.Tree(**out)


_RANDOM = {"feature": np.int32, "cut": float, "left": np.int32, "p": float, "cover": np.int64}


def _random_table(spark: SparkSession, trees: list[T.RandomTree]) -> DataFrame:
    rows = [(i, *[getattr(t, c).tolist() for c in _RANDOM]) for i, t in enumerate(trees)]
    return spark.createDataFrame(rows, "tree int, feature array<int>, cut array<double>, "
                                       "left array<int>, p array<double>, cover array<long>")


def save(obj, path: str, spark: SparkSession) -> None:
    """Write an encoder's, cut's or model's fitted state, or a plain dict such as one-hot
    levels or medians, under ``path`` (which must not exist)."""
    path = path.rstrip("/")
    table: DataFrame | None = None
    if isinstance(obj, E.FittedLookup):
        kind, table, state = "lookup", obj.table, _lookup_state(obj)
    elif isinstance(obj, E.FittedOrdinal):
        s = obj.spec
        kind, table = "ordinal", obj.lookup.table
        state = {"lookup": _lookup_state(obj.lookup), "cols": s.cols, "null_as": s.null_as,
                 "unknown_value": s.unknown_value, "on_unseen": s.on_unseen}
    elif isinstance(obj, E.FittedEncoderSet):
        s = obj.spec
        kind, table = "encoder_set", obj.lookup.table
        state = {"lookup": _lookup_state(obj.lookup), "cols": s.cols, "target": s.target,
                 "smoothing": s.m, "unknown_value": s.unknown_value,
                 "freq_levels": {c: list(v) for c, v in s.freq_levels.items()}}
    elif isinstance(obj, WidthCut):
        kind = "width_cut"
        state = {"k": obj.k, "precision": obj.precision, "edges": obj.edges, "labels": obj.labels}
    elif isinstance(obj, Fitted) and obj.kind == "boosted":
        m = obj.model
        kind = "boosted"
        state = {"features": obj.features, "extra": obj.extra, "init": m.init,
                 "categorical": m.categorical, "edges": [e.tolist() for e in m.edges],
                 "history": m.history}
        table = _tree_table(spark, m.trees)
    elif isinstance(obj, Fitted) and obj.kind == "random":
        kind, state = "random", {"features": obj.features, "extra": obj.extra}
        table = _random_table(spark, obj.model.trees)
    elif isinstance(obj, Fitted):
        kind, state = "model", {"features": obj.features, "kind": obj.kind, "extra": obj.extra}
        obj.model.write().save(f"{path}/model")
    elif isinstance(obj, dict):
        kind, state = "dict", obj
    else:
        raise TypeError(f"cannot save {type(obj).__name__}")
    if table is not None:
        table.write.parquet(f"{path}/table")
    spark.createDataFrame([(kind, json.dumps(state))], "kind string, state string").coalesce(
        1).write.parquet(f"{path}/state")


def load(spark: SparkSession, path: str):
    """The object that :func:`save` wrote under ``path``."""
    path = path.rstrip("/")
    row = spark.read.parquet(f"{path}/state").first()
    state = json.loads(row["state"])

    def lookup(s: dict) -> E.FittedLookup:
        return E.FittedLookup(spark.read.parquet(f"{path}/table"), **s)

    if row["kind"] == "lookup":
        return lookup(state)
    if row["kind"] == "ordinal":
        lk = lookup(state.pop("lookup"))
        return E.FittedOrdinal(lk, E.OrdinalEncoder(**state))
    if row["kind"] == "encoder_set":
        lk = lookup(state.pop("lookup"))
        return E.FittedEncoderSet(lk, E.EncoderSet(**state))
    if row["kind"] == "width_cut":
        cut = WidthCut(state["k"], state["precision"])
        cut.edges, cut.labels = state["edges"], state["labels"]
        return cut
    if row["kind"] == "boosted":
        rows = spark.read.parquet(f"{path}/table").collect()
        model = B.BoostedModel(state["features"], state["categorical"],
                               [np.array(e, float) for e in state["edges"]], state["init"],
                               [_tree(r) for r in sorted(rows, key=lambda r: r["tree"])],
                               state["history"])
        return Fitted(model, state["features"], "boosted", state["extra"])
    if row["kind"] == "random":
        rows = spark.read.parquet(f"{path}/table").collect()
        trees = [T.RandomTree(*(np.array(r[c], k) for c, k in _RANDOM.items()))
                 for r in sorted(rows, key=lambda r: r["tree"])]
        return Fitted(T.Forest(state["features"], trees), state["features"], "random",
                      state["extra"])
    if row["kind"] == "model":
        reader = {"gbt": GBTClassificationModel, "forest": RandomForestClassificationModel}
        return Fitted(reader[state["kind"]].load(f"{path}/model"), **state)
    return state
