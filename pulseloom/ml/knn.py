"""Exact k-nearest-neighbour classification without forming all pairs.

Reference rows are merged into weighted locations in square cells of a few locations each. A query location opens its own cell
and the ring of eight around it, which are kept together as one list, so that it meets one row and nothing is sorted but that list. If its k-th nearest row there is no farther than the opened square's edge, that is the answer;
otherwise it opens just the cells that reach within that distance. Locations with fewer than k rows around them, at gaps and far
outside, walk down a pyramid of cell counts instead and keep only the cells that can hold one of their k nearest: cells farther away than a
distance within which k rows are already known to lie are dropped. Dense areas are refined further, so a crowded cell is never
compared row by row.
"""

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulseloom.operators.joins import join_skewed
from pulseloom.session import materialize

CELL_ROWS = 64  # locations a finest cell may hold
MAX_LEVEL = 24
BROADCAST_LEVEL = 8  # at most 4**8 cells are broadcast
START_LEVEL = 3  # at most 64 cells
STEP = 2  # levels of the pyramid are so far apart
FEW = 6  # locations that a cell holds on average, where it holds any: the ring is then rarely too small


def _norm(dx, dy, metric):
    if metric == "euclidean":
        return dx * dx + dy * dy  # squared: the order is the same
    if metric == "manhattan":
        return dx + dy
    raise ValueError(metric)


@dataclass
class Reference:
    """Reference rows made ready: merged locations with the indices of their finest cell, its level, the cells' geometry, and the
    counts of the cells of some levels, of which the coarsest has at most 64. `rings` has the locations of every cell and the eight around
    it as one list."""

    locations: DataFrame
    level: int
    geometry: tuple
    cols: tuple
    label: str
    pyramid: DataFrame
    levels: list
    start: list
    rings: DataFrame | None = None


def prepare(reference: DataFrame, cols=("SBP", "DBP"), label="label") -> Reference:
    """Merge and place the reference rows once, for any number of calls (such as one per micro-batch)."""
    x, y = cols
    merged = reference.dropna(subset=[x, y, label]).groupBy(x, y, label).agg(F.count(F.lit(1)).alias("n"))
    locs = materialize(merged.select(F.col(x).alias("x"), F.col(y).alias("y"), F.col(label).alias("label"), "n"), "knn")
    row = locs.agg(F.min("x"), F.max("x"), F.min("y"), F.max("y"), F.count(F.lit(1))).first()
    if row[4] == 0:
        raise ValueError("no reference rows")
    x0, y0, size = row[0], row[2], max(row[1] - row[0], row[3] - row[2]) or 1.0

    def placed_at(c, lo, level):
        return F.least(F.floor((F.col(c) - F.lit(lo)) / F.lit(size / (1 << level))), F.lit((1 << level) - 1))

    def placed(level):
        return locs.withColumn("cx", placed_at("x", x0, level)).withColumn("cy", placed_at("y", y0, level))

    # the coarsest level at which cells in use hold a few locations on average, judged for several levels in one pass
    tried = [max(START_LEVEL, math.ceil(math.log(max(row[4], 1) / FEW, 4))) + i for i in range(4)]
    held = locs.agg(*[F.approx_count_distinct(F.struct(*[placed_at(c, lo, at) for c, lo in (("x", x0), ("y", y0))])) for at in tried]).first()
    level = next((at for at, cells in zip(tried, held) if row[4] <= FEW * cells), tried[-1])
    while level < MAX_LEVEL:
        spots = placed(level).select("x", "y", "cx", "cy").distinct()
        if spots.groupBy("cx", "cy").count().agg(F.max("count")).first()[0] <= CELL_ROWS:
            break
        level += 2
    locations = materialize(placed(level), "knn-cells")
    levels = [*range(START_LEVEL, level, STEP), level]
    up = [F.struct(F.lit(at).alias("level"), *[F.shiftright(c, level - at).alias(c) for c in ("cx", "cy")]) for at in levels]
    counts = locations.select("n", F.inline(F.array(*up))).groupBy("level", "cx", "cy").agg(F.sum("n").alias("n"))
    pyramid = materialize(counts, "knn-pyramid")
    start = [tuple(r) for r in pyramid.filter(F.col("level") == START_LEVEL).select("cx", "cy", "n").collect()]
    return Reference(locations, level, (x0, y0, size), tuple(cols), label, pyramid, levels, start, materialize(ringed(locations), "knn-rings"))


def ringed(locations: DataFrame) -> DataFrame:
    """(cx, cy, spots): the locations in a cell and the eight around it, nine finest cells at most."""
    cells = locations.groupBy("cx", "cy").agg(F.collect_list(F.struct("x", "y", "label", "n")).alias("own"))
    steps = F.array(*[F.struct((F.col("cx") + i).alias("cx"), (F.col("cy") + j).alias("cy")) for i in (-1, 0, 1) for j in (-1, 0, 1)])
    return cells.select("own", F.inline(steps)).groupBy("cx", "cy").agg(F.flatten(F.collect_list("own")).alias("spots"))


def nearest(queries: DataFrame, reference, cols=("SBP", "DBP"), label="label", k=5, metric="euclidean") -> DataFrame:
    """The k nearest reference rows of each distinct query location, as (qx, qy, d, label, n).

    `reference` is a table or what `prepare` made of it. Rows count by their number `n`; among equally near ones the
    smaller label comes first.
    """
    ready = reference if isinstance(reference, Reference) else prepare(reference, cols, label)
    return _rooted(search(queries, ready, cols, k, metric), metric)


def _rooted(near: DataFrame, metric: str) -> DataFrame:
    return near.withColumn("d", F.sqrt("d") if metric == "euclidean" else F.col("d"))


def search(queries: DataFrame, ready: Reference, cols=("SBP", "DBP"), k=5, metric="euclidean") -> DataFrame:
    """As `nearest`, with squared distances if Euclidean."""
    asked = queries.select(F.col(cols[0]).alias("qx"), F.col(cols[1]).alias("qy")).dropna().distinct()
    w = ready.geometry[2] / (1 << ready.level)
    far = 16 * w * w if metric == "euclidean" else 4 * w  # farther away only for queries outside the table's square
    kth, have = F.element_at("found", -1)["d"], F.aggregate("found", F.lit(0).cast("long"), lambda a, s: a + s["n"])
    first = own_ring(asked, ready, k, metric).select("*", F.when(F.size("found") > 0, kth).alias("kth"), have.alias("have"))
    enough = (F.col("have") >= k) & (F.col("kth") <= far * (1 + 1e-9))
    step = F.when(~F.coalesce(enough, F.lit(False)), F.lit("down")).when(F.col("kth") > edge(ready, metric), F.lit("wide")).otherwise(F.lit("done"))
    state = materialize(first.withColumn("step", step).drop("have"), "knn-ring")
    steps = {r.step for r in state.select("step").distinct().collect()}
    near = state.filter("step = 'done'").select("qx", "qy", F.inline("found"))
    if "wide" in steps:
        near = near.unionByName(wider(state.filter("step = 'wide'").drop("found"), ready, k, metric))
    if "down" in steps:
        near = near.unionByName(descend(state.filter("step = 'down'").select("qx", "qy"), ready, k, metric))
    return near


def _taken(found: DataFrame, k: int) -> DataFrame:
    """The k nearest rows of every query among `found`; a location counts with as many rows as are still wanted."""
    here = Window.partitionBy("qx", "qy").orderBy("d", "label")
    before = F.coalesce(F.sum("n").over(here.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return found.withColumn("take", F.least(F.col("n"), k - before)).filter("take > 0").select("qx", "qy", "d", "label", F.col("take").alias("n"))


def _distance(metric, spot=None):
    x, y = (F.col("x"), F.col("y")) if spot is None else (spot["x"], spot["y"])
    return _norm(F.abs(F.col("qx") - x), F.abs(F.col("qy") - y), metric)


def own_ring(asked: DataFrame, ready: Reference, k: int, metric: str) -> DataFrame:
    """Every query location with its cell and `found`, the k nearest rows in it and the eight around it; null if they are all empty."""
    x0, y0, size = ready.geometry
    last, w = (1 << ready.level) - 1, size / (1 << ready.level)

    def at(c, lo):
        return F.greatest(F.lit(0), F.least(F.floor((F.col(c) - F.lit(lo)) / F.lit(w)), F.lit(last)))

    placed = asked.withColumn("cx", at("qx", x0)).withColumn("cy", at("qy", y0))
    rings = ready.rings if ready.rings is not None else ringed(ready.locations)
    spots = F.transform("spots", lambda s: F.struct(_distance(metric, s).alias("d"), s["label"].alias("label"), s["n"].alias("n")))
    found = placed.join(rings, ["cx", "cy"], "left").select("qx", "qy", "cx", "cy", F.slice(F.sort_array(spots), 1, k).alias("found"))

    def cut(s, i):
        before = F.aggregate(F.slice("found", F.lit(1), i), F.lit(0).cast("long"), lambda a, t: a + t["n"])
        return F.struct(s["d"].alias("d"), s["label"].alias("label"), F.least(s["n"], k - before).alias("n"))

    return found.withColumn("found", F.filter(F.transform("found", cut), lambda s: s["n"] > 0))


def edge(ready: Reference, metric: str):
    """Within which distance (squared if Euclidean) of a query nothing lies outside its ring; the table's border is no edge."""
    x0, y0, size = ready.geometry
    last, w = (1 << ready.level) - 1, size / (1 << ready.level)
    sides = []
    for q, c, lo in (("qx", "cx", x0), ("qy", "cy", y0)):
        sides.append(F.when(F.col(c) > 1, F.col(q) - (F.lit(lo) + (F.col(c) - 1) * w)))
        sides.append(F.when(F.col(c) < last - 1, F.lit(lo) + (F.col(c) + 2) * w - F.col(q)))
    near = F.greatest(F.coalesce(F.least(*sides), F.lit(math.inf)), F.lit(0.0)) * (1 - 1e-9)
    return near * near if metric == "euclidean" else near


def wider(state: DataFrame, ready: Reference, k: int, metric: str) -> DataFrame:
    """The k nearest rows where the ring did not reach: all cells within the distance found there, at most ten by ten."""
    x0, y0, size = ready.geometry
    last, w = (1 << ready.level) - 1, size / (1 << ready.level)
    reach = (F.sqrt("kth") if metric == "euclidean" else F.col("kth")) * (1 + 1e-9) + 1e-9

    def cells(q, lo):
        ends = [F.floor((F.col(q) + s * reach - F.lit(lo)) / F.lit(w)) for s in (-1, 1)]
        return F.explode(F.sequence(*[F.greatest(F.lit(0), F.least(e, F.lit(last))) for e in ends]))

    def apart(q, c, lo):
        return F.greatest(F.lit(lo) + F.col(c) * w - F.col(q), F.col(q) - F.lit(lo) - (F.col(c) + 1) * w, F.lit(0.0))

    opened = state.select("qx", "qy", "kth", cells("qx", x0).alias("cx")).select("*", cells("qy", y0).alias("cy"))
    opened = opened.filter(_norm(apart("qx", "cx", x0), apart("qy", "cy", y0), metric) <= F.col("kth") * (1 + 1e-9) + 1e-9)
    found = opened.select("qx", "qy", "cx", "cy").join(ready.locations, ["cx", "cy"]).withColumn("d", _distance(metric))
    return _taken(found, k)


def descend(asked: DataFrame, ready: Reference, k: int, metric: str) -> DataFrame:
    """The k nearest rows of query locations anywhere, by walking down the pyramid of cell counts."""
    x0, y0, size = ready.geometry
    qx, qy = F.col("qx"), F.col("qy")
    here = Window.partitionBy("qx", "qy")

    def prune(frontier, at):
        """Drop cells beyond the distance that surely covers k rows (with a margin for rounding)."""
        w = size / (1 << at)

        def reach(q, c, lo):
            a, b = F.lit(lo) + F.col(c) * w, F.lit(lo) + (F.col(c) + 1) * w
            return F.greatest(a - q, q - b, F.lit(0.0)), F.greatest(F.abs(q - a), F.abs(q - b))

        (nx, fx), (ny, fy) = reach(qx, "cx", x0), reach(qy, "cy", y0)
        sized = frontier.withColumn("near", _norm(nx, ny, metric)).withColumn("far", _norm(fx, fy, metric))
        upto = F.sum("n").over(here.orderBy("far").rangeBetween(Window.unboundedPreceding, 0))
        sized = sized.withColumn("enough", F.when(upto >= k, F.col("far")))
        cover = F.min("enough").over(here)
        kept = sized.withColumn("cover", cover).filter(F.col("cover").isNull() | (F.col("near") <= F.col("cover") * (1 + 1e-9) + 1e-9))
        return kept.select("qx", "qy", "cx", "cy")

    start = [F.struct(F.lit(cx).alias("cx"), F.lit(cy).alias("cy"), F.lit(n).alias("n")) for cx, cy, n in ready.start]
    frontier = prune(asked.select("qx", "qy", F.inline(F.array(*start))), START_LEVEL)
    for above, at in zip(ready.levels, ready.levels[1:]):
        up = [F.shiftright(c, at - above).alias(p) for c, p in (("cx", "px"), ("cy", "py"))]
        children = ready.pyramid.filter(F.col("level") == at).select("cx", "cy", "n", *up)
        if at <= BROADCAST_LEVEL:
            children = F.broadcast(children)
        parents = frontier.withColumnsRenamed({"cx": "px", "cy": "py"})
        frontier = prune(parents.join(children, ["px", "py"]), at)

    found = frontier.join(ready.locations, ["cx", "cy"]).withColumn("d", _distance(metric))
    return _taken(found, k)


def knn_classify(queries: DataFrame, reference, cols=("SBP", "DBP"), label="label", k=5, metric="euclidean",
                 weights="uniform", found=None) -> DataFrame:
    """`queries` plus `prediction` and `share`, its part of the votes (smaller label on a tie).

    `found` is what `search` returned for these queries and this metric with as many neighbours or more; fewer are read from it.
    """
    near = nearest(queries, reference, cols, label, k, metric) if found is None else _rooted(_taken(found, k), metric)
    if weights == "distance":
        # neighbours at the very spot outvote all others
        touching = F.min("d").over(Window.partitionBy("qx", "qy")) == 0
        near = near.withColumn("v", F.when(touching, F.when(F.col("d") == 0, F.col("n")).otherwise(0.0)).otherwise(F.col("n") / F.nullif("d", F.lit(0.0))))
    else:
        near = near.withColumn("v", F.col("n").cast("double"))
    votes = near.groupBy("qx", "qy", "label").agg(F.sum("v").alias("v"))
    best = F.min(F.struct((-F.col("v")).alias("v"), "label"))
    answers = votes.groupBy("qx", "qy").agg(best.alias("b"), F.sum("v").alias("all"))
    answers = answers.select(
        F.col("qx").alias(cols[0]), F.col("qy").alias(cols[1]), F.col("b.label").alias("prediction"), (-F.col("b.v") / F.col("all")).alias("share")
    )
    return join_skewed(queries, answers, cols)
