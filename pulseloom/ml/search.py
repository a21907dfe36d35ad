"""Parameter search with cross-validation on folds that depend on the row key only."""

import hashlib
from itertools import product

from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulseloom.ml import bayes, knn
from pulseloom.ml.features import assemble, kept
from pulseloom.operators.clean import hash_bucket
from pulseloom.session import materialize


def grid(estimator, values: dict, limit: int | None = None, seed: int = 42) -> list:
    """All parameter combinations, or a random choice of `limit` of them."""
    names = list(values)
    maps = [dict(zip(names, combo)) for combo in product(*values.values())]
    if limit is not None:
        maps.sort(key=lambda m: hashlib.md5(f"{seed}|{sorted(m.items())}".encode()).hexdigest())
        maps = maps[:limit]
    return [{estimator.getParam(n): v for n, v in m.items()} for m in maps]


def grid_search(df: DataFrame, estimator, values: dict, cols, label="label", key="reading_id", folds=3, metric="accuracy",
                limit=None, seed=42, parallelism=4):
    """(best model, table of the mean metric per combination). Labels are required."""
    if label not in df.columns:
        raise ValueError("a search needs labels")
    maps = grid(estimator, values, limit, seed)
    data = df.select(*cols, F.col(label).cast("double").alias("label"), hash_bucket(key, seed, folds).cast("int").alias("fold"))
    with kept(data) as rows:
        cv = CrossValidator(
            estimator=estimator, estimatorParamMaps=maps, evaluator=MulticlassClassificationEvaluator(metricName=metric),
            numFolds=folds, foldCol="fold", parallelism=parallelism,
        )
        fitted = cv.fit(assemble(rows, cols))
    table = [(",".join(f"{p.name}={v}" for p, v in m.items()), float(x)) for m, x in zip(maps, fitted.avgMetrics)]
    return fitted.bestModel, df.sparkSession.createDataFrame(table, f"params string, {metric} double")


def search_own(df: DataFrame, predict, values: dict, label="label", key="reading_id", folds=3, limit=None, seed=42) -> DataFrame:
    """Mean accuracy per combination for models that are not MLlib estimators, on folds that depend on the row key.

    `predict(train, test, **params)` returns `test` with a column `prediction`. Columns: params, accuracy.
    """
    if label not in df.columns:
        raise ValueError("a search needs labels")
    names = list(values)
    maps = [dict(zip(names, combo)) for combo in product(*values.values())]
    if limit is not None:
        maps = sorted(maps, key=lambda m: hashlib.md5(f"{seed}|{sorted(m.items())}".encode()).hexdigest())[:limit]
    out = []
    with kept(df.withColumn("_fold", hash_bucket(key, seed, folds))) as rows:
        for m in maps:
            scores = []
            for f in range(folds):
                train, test = rows.filter(F.col("_fold") != f).drop("_fold"), rows.filter(F.col("_fold") == f).drop("_fold")
                right = F.coalesce((F.col("prediction") == F.col(label)).cast("int"), F.lit(0))
                scores.append(predict(train, test, **m).agg(F.avg(right)).first()[0] or 0.0)
            out.append((",".join(f"{k}={v}" for k, v in m.items()), sum(scores) / folds))
    return df.sparkSession.createDataFrame(out, "params string, accuracy double")


def search_models(df: DataFrame, spaces: dict, cols, label="label", key="reading_id", folds=3, limit=None, seed=42) -> DataFrame:
    """(model, params, accuracy): every model of `spaces` with all its parameter sets, or with `limit` of them drawn at random.

    `spaces` has for each name a function `fit(train, cols, **params)` of a model and its values. All are compared on one written
    table of folds, which depend on the row key alone; a fold's test part is read once for all models and parameter sets. The smoothings of
    naive Bayes (name `bayes`, no function) cost two passes for all folds, the neighbours (name `knn`, values k, metric and weights) one
    search per fold and metric, for the largest k, from which the sets read theirs; equal test rows are judged once.
    """
    if label not in df.columns:
        raise ValueError("a search needs labels")

    def sets(values):
        maps = [dict(zip(values, combo)) for combo in product(*values.values())]
        maps.sort(key=lambda m: hashlib.md5(f"{seed}|{sorted(m.items())}".encode()).hexdigest()) if limit is not None else None
        return maps[:limit]

    chosen = {name: sets(values) for name, (_, values) in spaces.items()}
    text = lambda m: ",".join(f"{k}={v}" for k, v in m.items())
    # the files of small columns may be few, and every fit reads them with as many tasks
    spread = df.repartition(2 * df.sparkSession.sparkContext.defaultParallelism, key)
    rows = materialize(spread.select(key, *cols, label, hash_bucket(key, seed, folds).cast("int").alias("_fold")), "folds")
    found: dict[tuple[str, str], list] = {}
    if "bayes" in chosen:
        smoothings = [m["smoothing"] for m in chosen["bayes"]]
        for s, accuracy in bayes.smoothing_search(rows, cols, smoothings, "_fold", label).items():
            found["bayes", text({"smoothing": s})] = [accuracy]
    for f in range(folds):
        train, test = rows.filter(F.col("_fold") != f), rows.filter(F.col("_fold") == f)
        judged, names = test, []
        for name, maps in chosen.items():
            if name in ("bayes", "knn"):
                continue
            for m in maps:
                names.append((name, text(m)))
                scored = spaces[name][0](train, cols, label=label, **m).transform(judged)
                judged = scored.select(*judged.columns, (F.col("prediction") == F.col(label)).cast("int").alias(f"_r{len(names)}"))
        if names:
            shares = judged.agg(*[F.avg(F.coalesce(f"_r{i + 1}", F.lit(0))) for i in range(len(names))]).first()
            for n, share in zip(names, shares):
                found.setdefault(n, []).append(share or 0.0)
        if chosen.get("knn"):
            near = knn.prepare(train, cols[:2], label)
            spots = materialize(test.groupBy(*near.cols, label).agg(F.count(F.lit(1)).alias("_n")), "spots")
            most = {}
            for m in chosen["knn"]:
                most[m.get("metric", "euclidean")] = max(m.get("k", 5), most.get(m.get("metric", "euclidean"), 0))
            searched = {metric: materialize(knn.search(spots, near, near.cols, k, metric), "neighbours") for metric, k in most.items()}
            for m in chosen["knn"]:
                answers = knn.knn_classify(spots, near, near.cols, label, found=searched[m.get("metric", "euclidean")], **m)
                right = F.coalesce((F.col("prediction") == F.col(label)).cast("int"), F.lit(0)) * F.col("_n")
                share = answers.agg(F.sum(right) / F.nullif(F.sum("_n"), F.lit(0))).first()[0]
                found.setdefault(("knn", text(m)), []).append(share or 0.0)
    table = [(name, params, float(sum(x) / len(x))) for (name, params), x in found.items()]
    return df.sparkSession.createDataFrame(table, "model string, params string, accuracy double")
