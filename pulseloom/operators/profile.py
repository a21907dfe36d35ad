"""Profiles of a table. Every result is a DataFrame with one row per column, value or pair."""

from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulseloom.operators.slices import running
from pulseloom.schema import MEASURES
from pulseloom.session import materialize


def _long(row_per, fields) -> list:
    """Turn one wide aggregate row into one row per column."""
    entries = [F.struct(F.lit(c).alias("column"), *[F.col(f"{f}_{c}").alias(f) for f in fields]) for c in row_per]
    return [F.inline(F.array(*entries))]


def unpivot(df: DataFrame, cols, keys=(), name="column", value="value") -> DataFrame:
    return df.unpivot(list(keys), list(cols), name, value)


def describe(df: DataFrame, cols=MEASURES, quantiles=True) -> DataFrame:
    """Count, mean, sample deviation, extremes and, on request, exact linear quartiles."""
    parts = {"count": F.count, "mean": F.avg, "stddev": F.stddev_samp, "min": F.min, "max": F.max}
    wide = df.agg(*[f(c).alias(f"{n}_{c}") for c in cols for n, f in parts.items()])
    stats = wide.select(*_long(cols, parts))
    return stats.join(F.broadcast(quartiles(df, cols)), "column", "left") if quantiles else stats


def quartiles(df: DataFrame, cols=MEASURES, points=(("p25", 0.25), ("p50", 0.5), ("p75", 0.75))) -> DataFrame:
    """Exact quantiles with linear interpolation.

    Values are counted first, so the ordered part sees one row per distinct value, and ranks
    come from running counts: no task holds all values of a column.
    """
    # written once: the ordered part measures and reads it several times
    counts = materialize(unpivot(df, cols).filter("value is not null").groupBy("column", "value").agg(F.count(F.lit(1)).alias("n")), "values")
    ranked = running(counts, ["column"], ["value"], {"upto": ("sum", F.col("n"))})
    sizes = counts.groupBy("column").agg(F.sum("n").alias("size"))
    ranked = ranked.join(F.broadcast(sizes), "column")
    first, last = F.col("upto") - F.col("n"), F.col("upto") - 1

    def at(rank):
        return F.max(F.when(rank.between(first, last), F.col("value")))

    def point(q):
        h = (F.col("size") - 1) * q
        low, part = F.floor(h), F.max(h - F.floor(h))
        a, b = at(low), at(F.ceil(h))
        return a + (b - a) * part

    return ranked.groupBy("column").agg(*[point(q).alias(n) for n, q in points])


def schema_table(df: DataFrame) -> DataFrame:
    return df.sparkSession.createDataFrame(df.dtypes, "column string, type string")


def missing(df: DataFrame, cols=MEASURES) -> DataFrame:
    """Nulls per column, as count and percent of the rows."""
    wide = df.agg(
        *[F.count_if(F.col(c).isNull()).alias(f"missing_{c}") for c in cols],
        *[(F.avg(F.col(c).isNull().cast("int")) * 100).alias(f"percent_{c}") for c in cols],
    )
    return wide.select(*_long(cols, ("missing", "percent")))


def histogram(df: DataFrame, cols, bins: int) -> DataFrame:
    """Counts in `bins` equal parts of each column's range, empty parts included."""
    span = df.agg(*[f(c).alias(f"{n}_{c}") for c in cols for n, f in (("lo", F.min), ("hi", F.max))]).first()
    bounds = {}
    for c in cols:
        lo, hi = span[f"lo_{c}"], span[f"hi_{c}"]
        if lo is not None:
            bounds[c] = (lo - 0.5, hi + 0.5) if lo == hi else (lo, hi)

    def bin_of(c):
        lo, hi = bounds[c]
        return F.least(F.floor((F.col(c) - lo) / F.lit((hi - lo) / bins)), F.lit(bins - 1)).cast("int").alias(c)

    hits = unpivot(df.select(*[bin_of(c) for c in bounds]), bounds, value="bin").filter("bin is not null")
    hits = hits.groupBy("column", "bin").agg(F.count(F.lit(1)).alias("n"))
    spark = df.sparkSession
    edges = [(c, b, lo + b * ((hi - lo) / bins)) for c, (lo, hi) in bounds.items() for b in range(bins)]
    grid = spark.createDataFrame(edges, "column string, bin int, low double")
    return grid.join(hits, ["column", "bin"], "left").select("column", "bin", "low", F.coalesce("n", F.lit(0)).alias("n"))


def value_counts(df: DataFrame, col: str, where=None) -> DataFrame:
    rows = df.filter(where) if where is not None else df
    return rows.groupBy(col).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), col)


def corr_long(df: DataFrame, cols=MEASURES) -> DataFrame:
    """Pearson correlation of every pair of columns.

    Without missing values a second pass adds up products of deviations from the means, a few
    plain sums; with missing values each pair is correlated over its own complete rows.
    """
    cols = list(cols)
    pairs = list(combinations(cols, 2))
    first = df.agg(F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(f"m_{c}") for c in cols], *[F.count(c).alias(f"n_{c}") for c in cols]).first()
    if all(first[f"n_{c}"] == first["n"] for c in cols):
        shifted = df.select(*[(F.col(c) - F.lit(first[f"m_{c}"])).alias(c) for c in cols])
        products = [F.sum(F.col(a) * F.col(b)).alias(f"{a}|{b}") for a, b in pairs + [(c, c) for c in cols]]
        sums = shifted.agg(*products)
        spread = lambda c: F.sqrt(F.col(f"`{c}|{c}`"))
        wide = sums.select(*[F.try_divide(F.col(f"`{a}|{b}`"), spread(a) * spread(b)).alias(f"{a}|{b}") for a, b in pairs])
    else:
        wide = df.agg(*[F.corr(a, b).alias(f"{a}|{b}") for a, b in pairs])
    entries = [(a, b, F.col(f"`{a}|{b}`")) for a, b in pairs]
    entries += [(b, a, c) for a, b, c in entries] + [(c, c, F.lit(1.0)) for c in cols]
    rows = [F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"), c.alias("corr")) for a, b, c in entries]
    return wide.select(F.inline(F.array(*rows)))


def constant_columns(df: DataFrame, cols=MEASURES) -> DataFrame:
    """Columns with a single distinct entry; null counts as an entry of its own."""
    wide = df.agg(
        F.count(F.lit(1)).alias("n"),
        *[f(c).alias(f"{k}_{c}") for c in cols for k, f in (("present", F.count), ("lo", F.min), ("hi", F.max))],
    )

    def constant(c):
        present, same = F.col(f"present_{c}"), F.col(f"lo_{c}") == F.col(f"hi_{c}")
        return ((F.col("n") > 0) & ((present == 0) | ((present == F.col("n")) & same))).alias(f"constant_{c}")

    return wide.select(*[constant(c) for c in cols]).select(*_long(cols, ("constant",)))


def drop_constant_columns(df: DataFrame, cols=MEASURES) -> DataFrame:
    found = constant_columns(df, cols).filter("constant").collect()  # one row per column
    return df.drop(*[r["column"] for r in found])


def high_corr(df: DataFrame, cols=MEASURES, threshold=0.95) -> DataFrame:
    """Columns whose absolute correlation with an earlier column exceeds the threshold."""
    place = {c: i for i, c in enumerate(cols)}
    rank = F.create_map(*[x for c, i in place.items() for x in (F.lit(c), F.lit(i))])
    strong = corr_long(df, cols).filter((F.abs("corr") > threshold) & (rank[F.col("col_a")] < rank[F.col("col_b")]))
    return strong.groupBy(F.col("col_b").alias("column")).agg(F.max(F.abs("corr")).alias("max_corr"))


def drop_high_corr(df: DataFrame, cols=MEASURES, threshold=0.95) -> DataFrame:
    found = high_corr(df, cols, threshold).collect()  # at most one row per column
    return df.drop(*[r["column"] for r in found])
