"""Model tables: fitted models as small Parquet, JSON or XML tables; trees and reference tables in folders of their own form."""

from __future__ import annotations

import dataclasses
import json

import numpy as np
from pyspark.ml.classification import DecisionTreeClassificationModel
from pyspark.sql import DataFrame, SparkSession

from vectable.operators.clustering import KMeansModel
from vectable.operators.independent import Unmixing
from vectable.operators.linear import LinearModel
from vectable.operators.markov import Hmm
from vectable.operators.mixture import Mixture
from vectable.operators.neighbors import NeighbourSearch
from vectable.operators.neural import Autoencoder, Network
from vectable.operators.reduction import Nmf, Pca
from vectable.operators.scaling import Autoscaled, Scaler
from vectable.operators.som import Map
from vectable.operators.svm import LinearSvm
from vectable.operators.trees import HoeffdingParams, HoeffdingTree, Node

KINDS = {
    c.__name__: c
    for c in (
        Autoencoder, Autoscaled, Hmm, HoeffdingParams, HoeffdingTree, KMeansModel, LinearModel, LinearSvm, Map, Mixture, Network,
        Nmf, Node, Pca, Scaler, Unmixing,
    )
}
SCHEMA = "name string, shape array<bigint>, data array<double>, params string"


def _pack(value: object, path: str, arrays: list[tuple]) -> object:
    """JSON form of a model; arrays move to rows of their own."""
    if isinstance(value, np.ndarray):
        arrays.append((path, [int(s) for s in value.shape], [float(v) for v in value.reshape(-1)], None))
        return {"array": path}
    if dataclasses.is_dataclass(value):
        fields = {f.name: _pack(getattr(value, f.name), f"{path}.{f.name}", arrays) for f in dataclasses.fields(value)}
        return {"kind": type(value).__name__, "fields": fields}
    if isinstance(value, (tuple, list)):
        return {"items": [_pack(v, f"{path}.{i}", arrays) for i, v in enumerate(value)]}
    if isinstance(value, dict):
        return {"map": [[k, _pack(v, f"{path}.{k}", arrays)] for k, v in value.items()]}
    if isinstance(value, (np.floating, np.integer)):
        value = value.item()
    return {"value": repr(value) if isinstance(value, float) else value, "float": isinstance(value, float)}


def _unpack(form: dict, arrays: dict[str, np.ndarray]) -> object:
    if "array" in form:
        return arrays[form["array"]]
    if "kind" in form:
        return KINDS[form["kind"]](**{k: _unpack(v, arrays) for k, v in form["fields"].items()})
    if "items" in form:
        return tuple(_unpack(v, arrays) for v in form["items"])
    if "map" in form:
        return {k: _unpack(v, arrays) for k, v in form["map"]}
    return float(form["value"]) if form["float"] else form["value"]


def model_table(spark: SparkSession, model: object) -> DataFrame:
    """(name, shape, data, params): one row per array, and one with the parameters."""
    if model is None or type(model).__name__ not in KINDS:
        raise ValueError("not a trained model")
    arrays: list[tuple] = []
    params = json.dumps(_pack(model, "model", arrays))
    return spark.createDataFrame([("params", [], [], params), *arrays], SCHEMA)


def from_table(df: DataFrame) -> object:
    rows = df.collect()
    arrays = {r["name"]: np.array(r["data"] or [], dtype=float).reshape(r["shape"] or ()) for r in rows if r["name"] != "params"}
    params = next(r["params"] for r in rows if r["name"] == "params")
    return _unpack(json.loads(params), arrays)


def _format(path: str) -> str:
    return {"json": "json", "xml": "xml"}.get(path.rstrip("/").rsplit(".", 1)[-1].lower(), "parquet")


def _values_path(path: str) -> str:
    return f"{path.rstrip('/')}-values"


def save_model(spark: SparkSession, model: object, path: str) -> None:
    """Write a model; a path ending in .json or .xml selects that text format.

    A decision tree is written in Spark ML's own form, a neighbour search as
    its whole reference table in Parquet beside its options.  An incremental tree with
    exact splits has its value table in Parquet beside it, in a folder that ends in -values.
    """
    if isinstance(model, DecisionTreeClassificationModel):
        model.write().overwrite().save(path)
        return
    if isinstance(model, NeighbourSearch):
        model.reference.write.mode("overwrite").parquet(f"{path}/reference")
        spark.createDataFrame([(json.dumps(model.options),)], "options string").write.mode("overwrite").parquet(f"{path}/options")
        return
    if isinstance(model, HoeffdingTree) and model.values is not None:
        # The value table of exact splits may have any size: it is a table of its own.
        model.values.write.mode("overwrite").parquet(_values_path(path))
        model = dataclasses.replace(model, values=True)
    out = model_table(spark, model).coalesce(1).write.mode("overwrite")
    form = _format(path)
    if form == "xml":
        out = out.option("rowTag", "row")
    out.format(form).save(path)


def load_tree(path: str) -> DecisionTreeClassificationModel:
    return DecisionTreeClassificationModel.load(path)


def load_search(spark: SparkSession, path: str) -> NeighbourSearch:
    options = json.loads(spark.read.parquet(f"{path}/options").first()["options"])
    return NeighbourSearch(spark.read.parquet(f"{path}/reference"), options)


def load_model(spark: SparkSession, path: str) -> object:
    form = _format(path)
    reader = spark.read.schema(SCHEMA)
    if form == "xml":
        reader = reader.option("rowTag", "row")
    model = from_table(reader.format(form).load(path))
    if isinstance(model, HoeffdingTree) and model.values:
        model = dataclasses.replace(model, values=spark.read.parquet(_values_path(path)))
    return model
