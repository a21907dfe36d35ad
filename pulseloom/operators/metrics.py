"""Quality of labels, scores and forecasts. Each function returns a small DataFrame."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulseloom.operators.slices import running


def accuracy(df: DataFrame, label: str, pred: str) -> DataFrame:
    right = F.coalesce((F.col(label) == F.col(pred)).cast("int"), F.lit(0))
    return df.agg(F.sum(right).alias("correct"), F.count(F.lit(1)).alias("total"), F.avg(right).alias("accuracy"))


def confusion(df: DataFrame, label: str, pred: str) -> DataFrame:
    return df.groupBy(label, pred).agg(F.count(F.lit(1)).alias("n"))


def class_report(df: DataFrame, label: str, pred: str) -> DataFrame:
    """Precision, recall, F1 and support per class, and one row `micro`.

    The rows are counted once; the rest works on the confusion table.
    """
    cells = confusion(df, label, pred)
    seen = cells.select(
        "n", F.inline(F.array(*[
            F.struct(F.col(c).cast("string").alias("class"), F.lit(is_true).alias("is_true"),
                     F.coalesce(F.col(label) == F.col(pred), F.lit(False)).alias("hit"))
            for c, is_true in ((label, True), (pred, False))
        ]))
    )

    def total(where):
        return F.sum(F.when(where, F.col("n")).otherwise(0))

    truth, hit = F.col("is_true"), F.col("hit")
    sums = seen.groupBy("class").agg(
        total(truth & hit).alias("tp"), total(truth).alias("support"), total(~truth).alias("predicted")
    )
    share = lambda a, b: F.when(F.col(b) == 0, 0.0).otherwise(F.col(a) / F.nullif(F.col(b), F.lit(0)))
    rows = sums.withColumn("precision", share("tp", "predicted")).withColumn("recall", share("tp", "support"))
    both = F.col("precision") + F.col("recall")
    rows = rows.withColumn("f1", F.when(both == 0, 0.0).otherwise(2 * F.col("precision") * F.col("recall") / F.nullif(both, F.lit(0.0))))
    rows = rows.select("class", "precision", "recall", "f1", "support")
    # one label per row: micro precision, recall and F1 all equal the accuracy
    micro = sums.agg((F.sum("tp") / F.sum("support")).alias("m"), F.sum("support").alias("support"))
    return rows.unionByName(
        micro.select(F.lit("micro").alias("class"), *[F.col("m").alias(c) for c in ("precision", "recall", "f1")], "support")
    )


def _ranked(df: DataFrame, label: str, score: str, by) -> DataFrame:
    """Positives and negatives per distinct score, with running counts from the highest score down."""
    rows = df.filter(F.col(score).isNotNull())
    yes = (F.col(label) == 1).cast("long")
    counts = rows.groupBy(*by, (-F.col(score)).alias("_rank")).agg(F.sum(yes).alias("pos"), F.sum(1 - yes).alias("neg"))
    cumulated = running(counts, by, ["_rank"], {"tp": ("sum", F.col("pos")), "fp": ("sum", F.col("neg"))})
    return cumulated.select(*by, *[F.col(c).cast("double").alias(c) for c in ("pos", "neg", "tp", "fp")])


def roc_auc(df: DataFrame, label: str, score: str, by=()) -> DataFrame:
    """Area under the ROC curve; equal scores form one step, so ties are exact."""
    r = _ranked(df, label, score, by)
    area = F.sum(F.col("neg") * (2 * F.col("tp") - F.col("pos")) / 2)
    return r.groupBy(*by).agg(F.try_divide(area, F.sum("pos") * F.sum("neg")).alias("roc_auc"))


def pr_curve(df: DataFrame, label: str, score: str, by=()) -> DataFrame:
    """Per distinct score: precision with this score included and before it, and the positives gained."""
    r = _ranked(df, label, score, by)
    before_tp, before = F.col("tp") - F.col("pos"), F.col("tp") + F.col("fp") - F.col("pos") - F.col("neg")
    return r.select(
        *by,
        "pos",
        (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"),
        F.when(before == 0, 1.0).otherwise(before_tp / F.nullif(before, F.lit(0.0))).alias("precision_before"),
    )


def pr_auc(df: DataFrame, label: str, score: str, by=()) -> DataFrame:
    """Trapezoid area under the precision-recall curve, which starts at recall 0, precision 1."""
    r = pr_curve(df, label, score, by)
    area = F.sum(F.col("pos") * (F.col("precision") + F.col("precision_before")) / 2)
    return r.groupBy(*by).agg(F.try_divide(area, F.sum("pos")).alias("pr_auc"))


def average_precision(df: DataFrame, label: str, score: str, by=()) -> DataFrame:
    """Step-wise sum of precision over the recall gained."""
    r = pr_curve(df, label, score, by)
    return r.groupBy(*by).agg(F.try_divide(F.sum(F.col("pos") * F.col("precision")), F.sum("pos")).alias("average_precision"))


def errors(df: DataFrame, actual: str, pred: str, by=()) -> DataFrame:
    """Mean squared and absolute error and the root of the former."""
    e = F.col(actual) - F.col(pred)
    return df.groupBy(*by).agg(
        F.count(e).alias("n"), F.avg(e * e).alias("mse"), F.avg(F.abs(e)).alias("mae"), F.sqrt(F.avg(e * e)).alias("rmse")
    )


def best_param(results: DataFrame, param: str, metric: str) -> DataFrame:
    """Mean metric per parameter over repeated runs, and the best of them."""
    means = results.groupBy(param).agg(F.avg(metric).alias(metric))
    return means.agg(F.max_by(param, metric).alias(param), F.max(metric).alias(metric))
