"""Ordered work on series of any length.

A window `PARTITION BY patient` gives one task the whole series, and one patient may hold
a third of all rows. The helpers here measure the series first. As long as every series
fits its fair share of a task, they leave the plan alone: one shuffle by patient. A longer
series is cut into slices, contiguous in the ordering, and what a slice needs from its
neighbours (a running total, the last known value, some halo rows) travels in a table with
one row per slice.

The cut points are constants of the plan, so a task that is repeated after a lost executor
puts every row into the same slice again.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

SLICE = "_slice"
MIN_ROWS = 1_000_000  # series below this are never cut
SAMPLES = 32  # sampled rows per slice when looking for cut points


def fair_share(df: DataFrame, total: int) -> int:
    """Rows an average shuffle task holds, at least MIN_ROWS."""
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(MIN_ROWS, -(-total // tasks))


def _sortable(df: DataFrame, name: str) -> Column:
    kind = df.schema[name].dataType
    return F.unix_micros(F.col(name)).alias(name) if isinstance(kind, T.TimestampType) else F.col(name)


def match(df: DataFrame, few: DataFrame, cols, how: str) -> DataFrame:
    """Join with a broadcast of a few rows; a missing key equals a missing key."""
    renamed = few.withColumnsRenamed({c: f"_r_{c}" for c in cols})
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in cols])
    return df.join(F.broadcast(renamed), same, how).drop(*[f"_r_{c}" for c in cols])


@dataclass
class Slicing:
    """Cut points of the long series of a table."""

    by: tuple
    order: tuple
    limit: int
    hot: DataFrame | None = None  # keys of the cut series, at most total/limit rows
    cuts: list = field(default_factory=list)  # sorted; rows at or after a cut are in a later slice

    @property
    def split(self) -> bool:
        return bool(self.cuts)

    @property
    def keys(self) -> list:
        return [*self.by, SLICE] if self.split else list(self.by)

    def assign(self, df: DataFrame) -> DataFrame:
        """Add the slice number: a binary search over the cuts, as nested CASE expressions."""
        if not self.split:
            return df
        names = [*self.by, *self.order]
        position = F.struct(*[_sortable(df, n).alias(n) for n in names])
        kinds = [T.LongType() if isinstance(df.schema[n].dataType, T.TimestampType) else df.schema[n].dataType for n in names]

        def search(lo: int, hi: int) -> Column:
            if lo == hi:
                return F.lit(lo)
            mid = (lo + hi) // 2
            cut = F.struct(*[F.lit(v).cast(k).alias(n) for v, k, n in zip(self.cuts[mid], kinds, names)])
            return F.when(position < cut, search(lo, mid)).otherwise(search(mid + 1, hi))

        return df.withColumn(SLICE, search(0, len(self.cuts)))

    def only_hot(self, df: DataFrame) -> DataFrame:
        """Rows of the cut series."""
        if not self.by:
            return df
        return match(df, self.hot, self.by, "left_semi")

    def window(self):
        return Window.partitionBy(*self.keys).orderBy(*self.order)

    def carry(self, sliced: DataFrame, per_slice: dict, across: dict) -> DataFrame:
        """`sliced` plus columns brought in from the other slices of the same series.

        `per_slice` are aggregates of one slice, `across` maps a new column to a function of
        the window over the slices of a series. The table has one row per slice of the cut
        series, a bounded number, and is broadcast; other series see null.
        """
        summary = self.only_hot(sliced).groupBy(*self.keys).agg(*[c.alias(n) for n, c in per_slice.items()])
        w = Window.partitionBy(*self.by).orderBy(SLICE)
        brought = summary.select(*self.keys, *[make(w).alias(n) for n, make in across.items()])
        return match(sliced, brought, self.keys, "left")


def slicing(df: DataFrame, by, order, max_rows: int | None = None) -> Slicing:
    """Measure the series of `df` and choose cut points for those above `max_rows`."""
    by, order = tuple(by), tuple(order)
    sizes = df.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"))
    total, longest = sizes.agg(F.sum("_n"), F.max("_n")).first()
    limit = max_rows or fair_share(df, total or 0)
    if not longest or longest <= limit:
        return Slicing(by, order, limit)

    hot = sizes.filter(F.col("_n") > limit).drop("_n")  # at most total/limit keys
    rows = df.select(*[_sortable(df, n) for n in (*by, *order)])
    if by:
        rows = match(rows, hot, by, "left_semi")
        hot = df.sparkSession.createDataFrame(hot.collect(), hot.schema)
    step = max(1, limit // SAMPLES)
    # about SAMPLES rows per slice, picked by a hash of the position; copies count once
    sample = rows.filter(F.pmod(F.xxhash64(*by, *order), F.lit(step)) == 0).distinct()
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    every = max(2, limit // step)
    cuts = sample.withColumn("_r", rank).filter(F.col("_r") % every == 0).orderBy(*by, *order)
    return Slicing(by, order, limit, hot, [tuple(r[n] for n in (*by, *order)) for r in cuts.collect()])


def with_position(df, by, order, name="_pos", total=None, max_rows=None, plan=None, keep=False) -> DataFrame:
    """1-based row number within each series and, as `total`, the length of the series.

    `keep` leaves the slice number of a cut series in the table.
    """
    s = plan or slicing(df, by, order, max_rows)
    local = s.assign(df)
    if not s.split:
        out = local.withColumn(name, F.row_number().over(s.window()).cast("long"))
        return out.withColumn(total, F.count(F.lit(1)).over(Window.partitionBy(*s.by))) if total else out
    local = s.carry(
        local,
        {"_n": F.count(F.lit(1))},
        {
            "_before": lambda w: F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, -1)),
            "_all": lambda w: F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)),
        },
    )
    number = F.row_number().over(s.window()) + F.coalesce(F.col("_before"), F.lit(0))
    out = local.withColumn(name, number.cast("long"))
    if total:
        size = F.count(F.lit(1)).over(Window.partitionBy(*s.keys))
        out = out.withColumn(total, F.coalesce(F.col("_all"), size))
    return out.drop("_before", "_all", *([] if keep else [SLICE]))


def known_neighbours(df, by, order, known: dict, max_rows=None, plan=None) -> DataFrame:
    """Nearest known entry at or before (`<name>_prev`) and at or after (`<name>_next`) each row.

    `known` maps a name to a struct that is null where nothing is known and whose first
    fields follow the ordering, so the nearest entry is its running maximum or minimum.
    """
    s = plan or slicing(df, by, order, max_rows)
    local = df if SLICE in df.columns else s.assign(df)
    local = local.select("*", *[e.alias(f"_k_{n}") for n, e in known.items()])
    if s.split:
        back = lambda n: lambda w: F.max(f"_l_{n}").over(w.rowsBetween(Window.unboundedPreceding, -1))
        ahead = lambda n: lambda w: F.min(f"_f_{n}").over(w.rowsBetween(1, Window.unboundedFollowing))
        ends = {f"_l_{n}": F.max(f"_k_{n}") for n in known} | {f"_f_{n}": F.min(f"_k_{n}") for n in known}
        across = {f"_p_{n}": back(n) for n in known} | {f"_q_{n}": ahead(n) for n in known}
        local = s.carry(local, ends, across)
    up = s.window().rowsBetween(Window.unboundedPreceding, 0)
    # descending order: a frame that ends at the last row is rebuilt by Spark for every row
    down = Window.partitionBy(*s.keys).orderBy(*[F.desc(c) for c in s.order])
    down = down.rowsBetween(Window.unboundedPreceding, 0)
    out = local
    for n in known:
        prev, nxt = F.max(f"_k_{n}").over(up), F.min(f"_k_{n}").over(down)
        if s.split:
            prev, nxt = F.coalesce(prev, F.col(f"_p_{n}")), F.coalesce(nxt, F.col(f"_q_{n}"))
        out = out.withColumn(f"{n}_prev", prev).withColumn(f"{n}_next", nxt)
    return out.drop(SLICE, *[f"_{x}_{n}" for n in known for x in "kpq"])


BUCKET = "_bucket"
HOME = "_home"


@dataclass
class Frame:
    """A table prepared for windows over neighbouring rows."""

    df: DataFrame
    by: tuple
    order: tuple
    halo: bool

    def window(self):
        return Window.partitionBy(*self.by, *([BUCKET] if self.halo else [])).orderBy(*self.order)

    def finish(self, df: DataFrame) -> DataFrame:
        return df.filter(HOME).drop(HOME, BUCKET) if self.halo else df


def row_frame(df: DataFrame, by, order, before: int, after: int, max_rows: int | None = None) -> Frame:
    """Prepare windows that reach `before` rows back and `after` rows ahead.

    Long series are cut every so many positions, and rows near a cut are copied to the other
    side, so each bucket sees all rows its windows reach.
    """
    by, order = tuple(by), tuple(order)
    s = slicing(df, by, order, max_rows)
    if not s.split:
        return Frame(df, by, order, False)
    size = max(s.limit, before + after + 1)
    pos = F.col("_pos") - 1
    # only the cut series are numbered; the others go to the window as they are
    placed = with_position(s.only_hot(df), by, order, "_pos", plan=s)
    own, offset = F.floor(pos / size), pos % size
    homes = F.array_compact(
        F.array(
            own,
            F.when(offset >= size - before, own + 1),
            F.when((offset < after) & (own > 0), own - 1),
        )
    )
    spread = (
        placed.withColumn("_own", own)
        .withColumn(BUCKET, F.explode(homes))
        .withColumn(HOME, F.col(BUCKET) == F.col("_own"))
        .drop("_own", "_pos")
    )
    if by:
        rest = match(df, s.hot, by, "left_anti")
        spread = spread.unionByName(rest.withColumn(BUCKET, F.lit(0).cast("long")).withColumn(HOME, F.lit(True)))
    return Frame(spread, by, order, True)


def running(df: DataFrame, by, order, columns: dict, max_rows: int | None = None) -> DataFrame:
    """Cumulative columns: name -> (kind, expression) with kind sum, count, min or max.

    A cut series is computed as totals of the slices before plus the running value inside.
    """
    kinds = {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max}
    s = slicing(df, by, order, max_rows)
    local = s.assign(df)
    w = s.window().rowsBetween(Window.unboundedPreceding, 0)
    if not s.split:
        return local.select("*", *[kinds[k](e).over(w).alias(n) for n, (k, e) in columns.items()])

    def before(kind, name):
        fold = F.sum if kind in ("sum", "count") else kinds[kind]
        return lambda ws: fold(name).over(ws.rowsBetween(Window.unboundedPreceding, -1))

    local = s.carry(
        local,
        {f"_t_{n}": kinds[k](e) for n, (k, e) in columns.items()},
        {f"_c_{n}": before(k, f"_t_{n}") for n, (k, _) in columns.items()},
    )

    def joined(name, kind, expr):
        inside, carried = kinds[kind](expr).over(w), F.col(f"_c_{name}")
        if kind == "count":
            return inside + F.coalesce(carried, F.lit(0))
        if kind == "sum":
            return F.coalesce(inside + carried, inside, carried)
        return (F.least if kind == "min" else F.greatest)(inside, carried)

    out = local.select("*", *[joined(n, k, e).alias(n) for n, (k, e) in columns.items()])
    return out.drop(SLICE, *[f"_c_{n}" for n in columns])
