"""Saving fitted models: small ones as a one-row Parquet table, MLlib parts and reference rows in folders beside it."""

import dataclasses
import json

import numpy as np
from pyspark.ml import classification, feature

from pulseloom.ml.bayes import GaussianNB
from pulseloom.ml.features import MinMaxModel
from pulseloom.ml.forecast import DirectModel
from pulseloom.ml.knn import Reference, ringed
from pulseloom.ml.ocsvm import OneClassModel
from pulseloom.ml.trees import Classifier, SupportVectorModel
from pulseloom.ml.vote import Ensemble

_KINDS = {c.__name__: c for c in (GaussianNB, MinMaxModel, DirectModel, OneClassModel, Classifier, SupportVectorModel, Ensemble, Reference)}


def _write(spark, kind: str, body: dict, path: str) -> None:
    text = json.dumps({n: v.tolist() if isinstance(v, np.ndarray) else v for n, v in body.items()})
    spark.createDataFrame([(kind, text)], "kind string, body string").write.mode("overwrite").parquet(path)


def _fitted(kind: str, path: str):
    """An MLlib model by the name of its class."""
    home = classification if hasattr(classification, kind) else feature
    return getattr(home, kind).load(path)


def save(spark, model, path: str) -> None:
    """Write a model to the folder `path`; `load` reads it back."""
    kind = type(model).__name__
    if isinstance(model, Ensemble):
        for name, part in model.models.items():
            save(spark, part, f"{path}/member_{name}")
        if model.reference is not None:
            save(spark, model.reference, f"{path}/reference")
        _write(spark, kind, {"models": list(model.models), "reference": model.reference is not None, "neighbours": model.neighbours}, f"{path}/about")
    elif isinstance(model, Reference):
        fields = {f.name: getattr(model, f.name) for f in dataclasses.fields(model)}
        if fields["rings"] is None:
            fields["rings"] = ringed(model.locations)
        for name in ("locations", "pyramid", "rings"):
            fields.pop(name).write.mode("overwrite").parquet(f"{path}/{name}")
        fields["tables"] = ["locations", "pyramid", "rings"]
        _write(spark, kind, fields, f"{path}/about")
    else:
        fields = {f.name: getattr(model, f.name) for f in dataclasses.fields(model)}
        for name, v in fields.items():
            if hasattr(v, "write"):
                v.write().overwrite().save(f"{path}/{name}")
                fields[name] = {"fitted": type(v).__name__}
        _write(spark, kind, fields, f"{path}/about")


def load(spark, path: str):
    row = spark.read.parquet(f"{path}/about").first()
    kind, body = row["kind"], json.loads(row["body"])
    if kind == "Ensemble":
        members = {n: load(spark, f"{path}/member_{n}") for n in body["models"]}
        return Ensemble(members, load(spark, f"{path}/reference") if body["reference"] else None, body["neighbours"])
    if kind == "Reference":
        tables = body.pop("tables", ["locations", "pyramid"])  # models saved earlier have no rings
        body |= {name: spark.read.parquet(f"{path}/{name}") for name in tables} | {"geometry": tuple(body["geometry"])}
    for name, v in body.items():
        if isinstance(v, dict) and set(v) == {"fitted"}:
            body[name] = _fitted(v["fitted"], f"{path}/{name}")
    if kind == "DirectModel":
        body["weights"] = np.array(body["weights"])
    if "cols" in body:
        body["cols"] = tuple(body["cols"])
    return _KINDS[kind](**body)
