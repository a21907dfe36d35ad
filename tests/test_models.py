"""Models on small tables with a known answer."""

import numpy as np
import pytest
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.clustering import KMeansModel
from pyspark.sql import functions as F

from pulseloom.ml import bayes, cluster, features, forecast, iforest, knn, ocsvm, search, trees, vote
from pulseloom.operators.timeseries import supervised_windows
from pulseloom.plans.vitals import vitals
from tests.compare import spark_rows
from tests.test_operators import series


@pytest.fixture(scope="module")
def blobs(spark):
    """Two clusters of 200 and five far points, ids 400 to 404."""
    rng = np.random.default_rng(1)
    a, b = rng.normal((100, 60), 3, (200, 2)), rng.normal((150, 95), 3, (200, 2))
    far = np.array([(0, 0), (220, 40), (60, 130), (230, 140), (20, 100)])
    rows = [(i, float(s), float(d), int(i >= 200)) for i, (s, d) in enumerate(np.vstack([a, b, far]))]
    return spark.createDataFrame(rows, "reading_id long, SBP double, DBP double, label int").repartition(4).cache()


def test_kmeans_separates_and_survives_saving(blobs, tmp_path):
    near = blobs.filter("reading_id < 400")
    model = cluster.kmeans_fit(near)
    scored = cluster.kmeans_predict(model, near)
    assert cluster.cluster_agreement(scored).first()["accuracy"] == 1.0
    assert sorted(r["cluster_label"] for r in cluster.cluster_labels(scored).collect()) == [0, 1]
    model.write().overwrite().save(str(tmp_path / "km"))
    again = cluster.kmeans_predict(KMeansModel.load(str(tmp_path / "km")), near)
    assert spark_rows(again) == spark_rows(scored)
    centers = [tuple(c) for c in model.clusterCenters()]
    own = near.withColumn("prediction", cluster.nearest_center(("SBP", "DBP"), centers))
    assert spark_rows(own) == spark_rows(scored)


def test_isolation_forest_ranks_far_points_first(spark, blobs, tmp_path):
    model = iforest.isolation_forest(blobs, contamination=5 / 405)
    scored = model.transform(blobs)
    top = {r["reading_id"] for r in scored.orderBy(F.desc("score")).limit(5).collect()}
    assert len(top & set(range(400, 405))) >= 4
    assert 3 <= scored.filter("prediction = -1").count() <= 7
    again = iforest.isolation_forest(blobs.repartition(2), contamination=5 / 405)
    assert spark_rows(again.transform(blobs)) == spark_rows(scored)
    model.save(spark, str(tmp_path / "forest"))
    assert spark_rows(iforest.IsolationForestModel.load(spark, str(tmp_path / "forest")).transform(blobs)) == spark_rows(scored)


def test_isolation_forest_tasks_stay_small_with_copies(spark):
    """A third of the rows are copies of one reading: they count once in a sample."""
    df = spark.range(6000).selectExpr("if(id % 3 = 0, 0, id) reading_id", "id % 97 * 1.0 SBP", "id % 89 * 1.0 DBP")
    nodes = iforest.isolation_forest(df, trees=10).nodes
    assert nodes.groupby("tree").size().max() <= 2 * 400


def test_one_class_svm_ranks_far_points_first(blobs):
    model = ocsvm.one_class_svm(blobs, nu=0.1, gamma=0.01, width=128)
    scored = model.transform(blobs)
    far = scored.filter("reading_id >= 400").agg(F.min("score")).first()[0]
    assert scored.filter(F.col("reading_id") < 400).filter(F.col("score") >= far).count() <= 20
    outside = scored.filter("prediction = -1").count()
    assert 20 <= outside <= 80
    pair = ocsvm.one_class_svms(blobs, [0.1, 0.5], gamma=0.01, width=128)
    assert pair[0].rho == pytest.approx(model.rho) and pair[0].weights == pytest.approx(model.weights)
    assert pair[1].transform(blobs).filter("prediction = -1").count() > outside


def test_one_class_svm_keeps_nu_outside(spark):
    """Also with a narrow kernel on unscaled pressures, where the margins are tiny."""
    rng = np.random.default_rng(5)
    rows = [(i, float(round(a, 1)), float(round(b, 1))) for i, (a, b) in enumerate(rng.normal((120, 75), (15, 9), (1500, 2)))]
    df = spark.createDataFrame(rows, "reading_id long, SBP double, DBP double").cache()
    nus = (0.05, 0.1, 0.3, 0.5)
    models = ocsvm.one_class_svms(df, nus, gamma=0.5)
    for nu, m in zip(nus, models):
        outside = m.transform(df).filter("prediction = -1").count() / 1500
        assert abs(outside - nu) < 0.01
        assert m.rho != 0


def test_isolation_forest_draws_from_the_whole_table(spark):
    df = spark.range(40_000).selectExpr("id reading_id", "id % 997 * 1.0 SBP", "id % 89 * 1.0 DBP")
    nodes = iforest.isolation_forest(df, trees=20, sample=64).nodes
    assert nodes["tree"].nunique() == 20
    leaves = nodes[nodes["feature"] == -1].groupby("tree").size()
    assert 25 < leaves.mean() < 100


def brute(queries, reference, k, metric):
    q, r = queries.toPandas(), reference.toPandas()
    out = {}
    for row in q.itertuples():
        dx, dy = np.abs(r["SBP"] - row.SBP), np.abs(r["DBP"] - row.DBP)
        d = dx * dx + dy * dy if metric == "euclidean" else dx + dy
        near = sorted(zip(d, r["label"]))[:k]
        ones = sum(y for _, y in near)
        out[row.reading_id] = (int(2 * ones > len(near)), max(ones, len(near) - ones) / len(near))
    return out


@pytest.fixture(scope="module")
def crowded(spark):
    """A third of the reference at one spot, a dense patch, and far rows."""
    rng = np.random.default_rng(2)
    spot = np.tile((120.0, 80.0), (300, 1))
    dense = 90 + rng.integers(0, 40, (300, 2)) / 100
    wide = rng.integers(0, 2000, (300, 2)) / 10
    rows = [(i, float(a), float(b), int(rng.integers(0, 2))) for i, (a, b) in enumerate(np.vstack([spot, dense, wide]))]
    return spark.createDataFrame(rows, "reading_id long, SBP double, DBP double, label int").cache()


@pytest.mark.parametrize("k,metric", [(5, "euclidean"), (9, "manhattan"), (1, "euclidean"), (2000, "euclidean")])
def test_knn_equals_brute_force(spark, crowded, k, metric):
    asked = crowded.sample(0.2, seed=3).select("reading_id", F.col("SBP") + 0.5, F.col("DBP") - 0.25).toDF("reading_id", "SBP", "DBP")
    asked = asked.union(spark.createDataFrame([(9001, -50.0, 400.0), (9002, 120.0, 80.0)], asked.schema))
    got = {r["reading_id"]: (r["prediction"], r["share"]) for r in knn.knn_classify(asked, crowded, k=k, metric=metric).collect()}
    want = brute(asked, crowded, k, metric)
    assert got.keys() == want.keys()
    assert all(got[i][0] == want[i][0] and got[i][1] == pytest.approx(want[i][1]) for i in want)


def test_knn_weighted_by_distance(spark):
    ref = spark.createDataFrame([(0, 0.0, 0.0, 1), (1, 2.0, 0.0, 0), (2, 0.0, 2.0, 0)], "reading_id long, SBP double, DBP double, label int")
    asked = spark.createDataFrame([(7, 0.0, 0.0), (8, 0.5, 0.0)], "reading_id long, SBP double, DBP double")
    got = {r["reading_id"]: r["prediction"] for r in knn.knn_classify(asked, ref, k=3, weights="distance").collect()}
    assert got == {7: 1, 8: 1}


def test_naive_bayes_and_votes(blobs):
    near = blobs.filter("reading_id < 400")
    nb = bayes.gaussian_nb(near, ("SBP", "DBP"))
    models = {"nb": nb, "tree": trees.decision_tree(near, ("SBP", "DBP")), "svc": trees.support_vector(near, ("SBP", "DBP")),
              "gbt": trees.boosted_trees(near, ("SBP", "DBP"), maxIter=2)}
    for m in models.values():
        out = m.transform(near)
        assert out.filter("prediction <> label").count() <= 2
        assert out.filter("abs(probability[0] + probability[1] - 1) > 1e-9").count() == 0
    voted = vote.soft_vote(near, models)
    assert voted.filter("prediction <> label").count() <= 2


def test_feature_importance_finds_the_feature(spark):
    df = spark.range(400).selectExpr("pmod(id * 7919, 101) * 1.0 a", "pmod(id * 104729, 97) * 1.0 b").withColumn("label", (F.col("a") > 50).cast("int"))
    got = {r["feature"]: r["importance"] for r in trees.feature_importance(trees.random_forest(df, ("a", "b"))).collect()}
    assert got["a"] > 0.8 and sum(got.values()) == pytest.approx(1)


def test_search_needs_labels_and_is_repeatable(blobs):
    dt = DecisionTreeClassifier(seed=1)
    with pytest.raises(ValueError):
        search.grid_search(blobs.drop("label"), dt, {"maxDepth": [1]}, ("SBP", "DBP"))
    _, a = search.grid_search(blobs, dt, {"maxDepth": [1, 3]}, ("SBP", "DBP"), limit=1)
    _, b = search.grid_search(blobs.repartition(3), dt, {"maxDepth": [1, 3]}, ("SBP", "DBP"), limit=1)
    assert a.collect() == b.collect() and a.count() == 1


def test_search_over_own_models(blobs):
    near = lambda a, b, k, weights: knn.knn_classify(b, a, k=k, weights=weights)
    table = {r["params"]: r["accuracy"] for r in search.search_own(blobs, near, {"k": [3], "weights": ["uniform", "distance"]}, folds=2).collect()}
    assert set(table) == {"k=3,weights=uniform", "k=3,weights=distance"} and min(table.values()) > 0.95
    with pytest.raises(ValueError):
        search.search_own(blobs.drop("label"), near, {"k": [3]})


def test_ensemble_survives_saving(spark, blobs, tmp_path):
    from pulseloom.ml import store

    near = blobs.filter("reading_id < 400")
    cols = ("SBP", "DBP")
    whole = vote.Ensemble({"nb": bayes.gaussian_nb(near, cols), "tree": trees.decision_tree(near, cols), "svc": trees.support_vector(near, cols)}, knn.prepare(near))
    store.save(spark, whole, str(tmp_path / "e"))
    again = store.load(spark, str(tmp_path / "e"))
    want = {r["reading_id"]: (r["prediction"], round(r["probability"], 9)) for r in whole.transform(near).collect()}
    assert {r["reading_id"]: (r["prediction"], round(r["probability"], 9)) for r in again.transform(near).collect()} == want
    assert sum(p != int(i >= 200) for i, (p, _) in want.items()) <= 2
    with pytest.raises(ValueError):
        vote.check_labels(blobs.withColumn("label", F.col("label") + 1))


def test_minmax(spark):
    df = spark.createDataFrame([(1.0, 7.0), (3.0, 7.0), (5.0, 7.0)], "a double, b double")
    m = features.minmax_fit(df, ("a", "b"))
    out = m.transform(df)
    assert [tuple(r)[2:] for r in out.orderBy("a").collect()] == [(0, 0.5), (0.5, 0.5), (1, 0.5)]
    assert [r["a"] for r in m.inverse(out).orderBy("a").collect()] == [1, 3, 5]


def test_direct_forecast_equals_least_squares(spark, sf):
    v = vitals(spark, sf)
    w = supervised_windows(v, 3, 4)
    model = forecast.direct_fit(v, 3, 4, ridge=0.0)
    rows = w.select("x", "y").collect()
    x = np.array([[1.0] + [e[c] for c in ("SBP", "DBP") for e in r["x"]] for r in rows])
    y = np.array([[e[c] for c in ("SBP", "DBP") for e in r["y"]] for r in rows])
    assert model.weights == pytest.approx(np.linalg.lstsq(x, y, rcond=None)[0], abs=1e-6)
    out = model.transform(w, (1, 4)).select("SBP_1", "DBP_4").collect()
    assert [r["DBP_4"] for r in out] == pytest.approx((x @ model.weights)[:, 7])


def test_direct_forecast_of_a_straight_line(spark):
    line = series(spark, range(60)).withColumn("DBP", 100 - F.col("SBP") / 2)
    out = forecast.direct_fit(line, 10, 30, ridge=1e-9).transform(supervised_windows(line)).orderBy("reading_id").first()
    assert out["SBP_30"] == pytest.approx(39, abs=0.05)


def test_small_models_survive_saving(spark, blobs, tmp_path):
    from pulseloom.ml import store

    line = series(spark, range(60)).withColumn("DBP", 100 - F.col("SBP") / 2)
    direct = forecast.direct_fit(line)
    store.save(spark, direct, str(tmp_path / "d"))
    assert store.load(spark, str(tmp_path / "d")).weights.tolist() == direct.weights.tolist()
    for name, m in (("nb", bayes.gaussian_nb(blobs, ("SBP", "DBP"))), ("oc", ocsvm.one_class_svm(blobs, steps=1)), ("mm", features.minmax_fit(blobs, ["SBP"]))):
        store.save(spark, m, str(tmp_path / name))
        again = store.load(spark, str(tmp_path / name))
        assert spark_rows(again.transform(blobs)) == spark_rows(m.transform(blobs))


def test_shortest_mix_is_the_nearest_point_of_the_hull():
    rng = np.random.default_rng(4)
    for n in (1, 2, 5, 20):
        v = rng.normal(size=(n, 6)) + rng.normal(size=6)
        w = ocsvm.shortest_mix(v)
        x = w @ v
        assert w.min() >= 0 and w.sum() == pytest.approx(1)
        assert (v @ x >= x @ x - 1e-9).all()  # no vertex lies on the near side of the plane through x
    copies = np.tile([1.0, 2.0], (4, 1))
    assert ocsvm.shortest_mix(copies) @ copies == pytest.approx([1.0, 2.0])


def test_one_class_fit_needs_few_passes(spark, blobs, monkeypatch):
    """At most eight steps beside the first sum and two zooms, whatever the number of models."""
    frame, passes = type(blobs), []
    run = frame.mapInPandas
    monkeypatch.setattr(frame, "mapInPandas", lambda self, *a, **b: (passes.append(1), run(self, *a, **b))[1])
    nus = (0.1, 0.3, 0.5)
    models = ocsvm.one_class_svms(blobs, nus, gamma=0.01)
    assert len(passes) <= 11
    for nu, m in zip(nus, models):
        assert abs(m.transform(blobs).filter("prediction = -1").count() / 405 - nu) < 0.02


@pytest.mark.parametrize("k,metric", [(4, "euclidean"), (4, "manhattan"), (40, "euclidean")])
def test_knn_from_the_own_cell_outwards(spark, k, metric):
    """An even table with gaps: most queries end in their ring, some open more cells, a few walk down; all equal brute force."""
    rng = np.random.default_rng(8)
    spots = rng.integers(0, 4000, (1500, 2)) / 10
    spots = spots[(spots[:, 0] < 150) | (spots[:, 0] > 260)]
    rows = [(i, float(a), float(b), int(rng.integers(0, 2))) for i, (a, b) in enumerate(spots)]
    reference = spark.createDataFrame(rows, "reading_id long, SBP double, DBP double, label int").cache()
    asked = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(rng.integers(-300, 4300, (150, 2)) / 10)], "reading_id long, SBP double, DBP double")
    ready = knn.prepare(reference)
    assert ready.locations.groupBy("cx", "cy").count().agg(F.avg("count")).first()[0] <= 2 * knn.FEW
    got = {r["reading_id"]: (r["prediction"], r["share"]) for r in knn.knn_classify(asked, ready, k=k, metric=metric).collect()}
    want = brute(asked, reference, k, metric)
    assert all(got[i][0] == want[i][0] and got[i][1] == pytest.approx(want[i][1]) for i in want)


def test_kernel_machine_separates_a_ring_from_its_centre(spark, tmp_path):
    from pulseloom.ml import store

    rng = np.random.default_rng(3)
    angle, far = rng.uniform(0, 2 * np.pi, 600), np.arange(600) % 2
    radius = np.where(far, rng.normal(30, 2, 600), rng.normal(0, 5, 600))
    rows = [(i, float(130 + r * np.cos(a)), float(80 + r * np.sin(a)), int(y)) for i, (r, a, y) in enumerate(zip(radius, angle, far))]
    df = spark.createDataFrame(rows, "reading_id long, SBP double, DBP double, label int").repartition(3).cache()
    right = lambda m: m.transform(df).filter("prediction = label").count() / 600
    assert right(trees.support_vector(df, ("SBP", "DBP"))) < 0.8
    model = trees.support_vector(df, ("SBP", "DBP"), kernel="rbf", reg=1e-3)
    assert right(model) > 0.98
    p = model.transform(df).groupBy("label").agg(F.avg(F.col("probability")[1]).alias("p")).orderBy("label").collect()
    assert p[0]["p"] < 0.15 and p[1]["p"] > 0.85
    store.save(spark, model, str(tmp_path / "svc"))
    assert spark_rows(store.load(spark, str(tmp_path / "svc")).transform(df).select("reading_id", "prediction")) == spark_rows(model.transform(df).select("reading_id", "prediction"))
    with pytest.raises(ValueError):
        trees.support_vector(df, ("SBP", "DBP"), kernel="cubic")


def test_kernel_machines_share_their_passes(spark, monkeypatch):
    """Three machines cost the passes of one, each is that of its own rows, and no row's features leave a task."""
    from pulseloom.ml import kernel

    rng = np.random.default_rng(5)
    x = rng.normal(size=(900, 2))
    rows = [(float(a), float(b), float(a * a + b * b < 1), i % 2) for i, (a, b) in enumerate(x.tolist())] + [(None, 0.0, 1.0, 0), (float("nan"), 0.0, 1.0, 1)]
    df = spark.createDataFrame(rows, "a double, b double, label double, half int").coalesce(1)
    directions, phases = rng.normal(size=(32, 2)), rng.uniform(0, 6, 32)
    packed = lambda d: kernel.blocks(d, ["a", "b"], np.zeros(2), np.ones(2)).cache()
    passes, summed = [], kernel.summed
    monkeypatch.setattr(kernel, "summed", lambda *a: (passes.append(1), summed(*a))[1])
    both = kernel.machines(packed(df), directions, phases, 1e-3, 4)
    assert len(both) == 3 and len(passes) < 15

    def value(machine, some):
        z = kernel.cosines(some[:, :2], directions, phases)
        return np.maximum(0, 1 - (2 * some[:, 2] - 1) * (z @ machine[0] + machine[1])).mean()

    data = np.array(rows[:900])
    alone = kernel.machines(packed(df.filter("half <> 1")), directions, phases, 1e-3, 4)
    own = data[data[:, 3] != 1]
    assert len(alone) == 1 and value(alone[0], own) < 0.7
    assert value(both[2], own) == pytest.approx(value(alone[0], own), rel=0.02)
    assert kernel.margins(packed(df), directions, phases, both).count() == 900
    with pytest.raises(Exception, match="0 or 1"):
        packed(df.withColumn("label", F.lit(2.0))).count()


def test_smoothings_cost_two_passes(spark, blobs, monkeypatch):
    """The same accuracies as by fitting a model for every fold and smoothing."""
    cols, smoothings = ("SBP", "DBP"), [1e-9, 0.1, 3.0]
    parts = blobs.withColumn("f", F.col("reading_id") % 3).cache()
    want = {}
    for s in smoothings:
        shares = []
        for f in range(3):
            scored = bayes.gaussian_nb(parts.filter(F.col("f") != f), cols, smoothing=s).transform(parts.filter(F.col("f") == f))
            shares.append(scored.agg(F.avg((F.col("prediction") == F.col("label")).cast("int"))).first()[0])
        want[s] = sum(shares) / 3
    frame, reads = type(blobs), []
    collect = frame.collect
    monkeypatch.setattr(frame, "collect", lambda self: (reads.append(1), collect(self))[1])
    assert bayes.smoothing_search(parts, cols, smoothings, "f") == pytest.approx(want)
    assert len(reads) == 2


def test_search_over_several_models(blobs):
    spaces = {"bayes": (None, {"smoothing": [1e-9, 1e-3]}), "tree": (trees.decision_tree, {"maxDepth": [1, 2, 3]}), "knn": (None, {"k": [1, 3]})}
    table = {(r["model"], r["params"]): r["accuracy"] for r in search.search_models(blobs, spaces, ["SBP", "DBP"], folds=2, limit=2).collect()}
    again = {(r["model"], r["params"]): r["accuracy"] for r in search.search_models(blobs.repartition(3), spaces, ["SBP", "DBP"], folds=2, limit=2).collect()}
    assert table == pytest.approx(again) and len(table) == 6 and min(table.values()) > 0.9
    with pytest.raises(ValueError):
        search.search_models(blobs.drop("label"), spaces, ["SBP", "DBP"])


def test_sets_of_neighbours_share_one_search(blobs, crowded, monkeypatch):
    """A search per fold and metric, whatever the number of sets, with the votes of a search of their own."""
    rings, ring = [], knn.own_ring
    monkeypatch.setattr(knn, "own_ring", lambda *a: (rings.append(a[3]), ring(*a))[1])
    spaces = {"knn": (None, {"k": [1, 3, 6], "metric": ["euclidean", "manhattan"]})}
    got = {r["params"]: r["accuracy"] for r in search.search_models(blobs, spaces, ["SBP", "DBP"], folds=2).collect()}
    assert sorted(rings) == ["euclidean"] * 2 + ["manhattan"] * 2
    near = lambda a, b, k, metric: knn.knn_classify(b, a, k=k, metric=metric)
    want = search.search_own(blobs, near, spaces["knn"][1], folds=2)
    assert got == pytest.approx({r["params"]: r["accuracy"] for r in want.collect()})

    ready = knn.prepare(crowded)
    asked = crowded.sample(0.2, seed=3).select("reading_id", (F.col("SBP") + 0.5).alias("SBP"), "DBP")
    found = knn.search(asked, ready, k=9)
    for k in (2, 9):
        got = {r["reading_id"]: (r["prediction"], r["share"]) for r in knn.knn_classify(asked, ready, k=k, found=found).collect()}
        want = brute(asked, crowded, k, "euclidean")
        assert got.keys() == want.keys()
        assert all(got[i][0] == want[i][0] and got[i][1] == pytest.approx(want[i][1]) for i in want)


def test_reference_saved_without_rings(spark, blobs, tmp_path):
    from pulseloom.ml import store

    ready = knn.prepare(blobs)
    store.save(spark, ready, str(tmp_path / "new"))
    assert store.load(spark, str(tmp_path / "new")).rings.count() == ready.rings.count()
    fields = {n: getattr(ready, n) for n in ("level", "geometry", "cols", "label", "levels", "start")}
    for name in ("locations", "pyramid"):
        getattr(ready, name).write.parquet(str(tmp_path / "old" / name))
    store._write(spark, "Reference", fields, str(tmp_path / "old" / "about"))
    old = store.load(spark, str(tmp_path / "old"))
    want, got = ({r["reading_id"]: r["share"] for r in knn.knn_classify(blobs, x).collect()} for x in (ready, old))
    assert got == want
