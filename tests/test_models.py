import numpy as np
import pandas as pd
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from upkeep.models import boundary, classifiers as cl, metrics, trees
from upkeep.models.anomaly import AnomalyDetector, AnomalyModel, anomaly_consensus, evaluate_anomalies
from upkeep.models.boundary import fit_boundary
from upkeep.models.isolation import _grow, average_path, fit_forest, sample_for_trees
from upkeep.models.matrix import Standardizer, model_matrix, numeric_inputs, project
from upkeep.models.splits import balanced_weights, stratify
from upkeep.operators.correlation import correlations
from upkeep.operators.slicing import DEFAULT_POLICY, SlicePolicy


@pytest.fixture(scope="module")
def cloud(spark):
    """A tight cloud with six planted outliers, a missing and an infinite value."""
    rng = np.random.default_rng(1)
    points = rng.normal(0, 1, (600, 2))
    points[:6] = [[12, 12], [-12, 12], [12, -12], [-12, -12], [15, 0], [0, 15]]
    rows = [(i, float(a), float(b)) for i, (a, b) in enumerate(points)]
    rows[50], rows[51] = (50, None, 0.0), (51, float("inf"), 0.0)
    return spark.createDataFrame(rows, "id_ordre_travail long, cout_total double, duree_intervention_par_heure double")


@pytest.fixture(scope="module")
def fitted(cloud):
    return AnomalyDetector(trees=40, sample_size=128, map_size=128).fit(cloud)


def test_detector_flags_outliers_at_the_wanted_rate(cloud, fitted):
    rows = {r["id_ordre_travail"]: r for r in fitted.transform(cloud).collect()}
    assert all(rows[i]["iso_anomaly"] == 1 and rows[i]["ocsvm_anomaly"] == 1 for i in range(6))
    assert 0.07 <= np.mean([r["iso_anomaly"] for r in rows.values()]) <= 0.12
    assert 0.07 <= np.mean([r["ocsvm_anomaly"] for r in rows.values()]) <= 0.12
    assert all(-1 <= r["iso_score"] <= 0 for r in rows.values())
    assert max(rows[i]["iso_score"] for i in range(6)) < np.median([r["iso_score"] for r in rows.values()])


def test_detector_is_repeatable_and_survives_saving(spark, cloud, fitted, folder):
    again = AnomalyDetector(trees=40, sample_size=128, map_size=128).fit(cloud.repartition(7))
    pick = lambda model: [(r[0], round(r[1], 9), round(r[2], 6)) for r in model.transform(cloud).select("id_ordre_travail", "iso_score", "ocsvm_score").orderBy("id_ordre_travail").collect()]
    assert pick(again) == pick(fitted)
    fitted.save(folder, spark)
    assert pick(AnomalyModel.load(folder, spark)) == pick(fitted)


def test_forest_on_a_large_table_draws_full_samples(spark):
    rows = spark.range(20_000).select("id", (F.rand(3) * 2).alias("x0"), F.rand(4).alias("x1"))
    model = fit_forest(rows, "id", ["x0", "x1"], trees=10, sample_size=64)
    leaves = model.nodes[model.nodes["feature"] < 0]
    assert model.nodes["tree"].nunique() == 10 and leaves["path"].min() >= 1.0
    assert average_path(256) == pytest.approx(10.2448, abs=1e-3) and average_path(2) == 1.0


def test_published_flag_counts_are_consistent(spark):
    both, first, second = 140, 64, 64
    flags = [(1, 1)] * both + [(1, 0)] * first + [(0, 1)] * second + [(0, 0)] * (2035 - both - first - second)
    got = evaluate_anomalies(anomaly_consensus(spark.createDataFrame(flags, "iso_anomaly int, ocsvm_anomaly int"))).first()
    assert tuple(got) == (2035, 204, 204, 268, 140, 93.71)


def test_metrics_from_counts_and_auc(spark):
    rows = spark.createDataFrame(
        [(1, 1, 0.9), (1, 0, 0.4), (0, 0, 0.4), (0, 1, 0.6), (0, 0, 0.1)], "label int, prediction int, probability double"
    )
    got = metrics.classification_metrics(rows).first()
    assert (got["tn"], got["fp"], got["fn"], got["tp"]) == (2, 1, 1, 1)
    assert (got["precision"], got["recall"], got["accuracy"]) == (0.5, 0.5, 0.6)
    assert got["roc_auc"] == pytest.approx((3 + 1.5) / 6)
    sliced = metrics.roc_auc(rows, policy=SlicePolicy(rows_per_slice=1, samples_per_slice=1)).first()["roc_auc"]
    assert sliced == pytest.approx(0.75)
    one_class = rows.where("label = 0")
    assert metrics.classification_metrics(one_class).first()["roc_auc"] is None


@pytest.mark.parametrize("policy", [DEFAULT_POLICY, SlicePolicy(rows_per_slice=30)])
def test_split_is_stratified_and_stable(spark, policy):
    rows = spark.range(500).select("id", (F.col("id") % 5 == 0).cast("int").alias("label"))
    split = stratify(rows, "label", "id", policy=policy)
    counts = {r["label"]: (r["t"], r["n"]) for r in split.groupBy("label").agg(F.count_if("is_test").alias("t"), F.count("*").alias("n")).collect()}
    assert counts == {0: (80, 400), 1: (20, 100)}
    assert {r["count"] for r in split.where("label = 1").groupBy("fold").count().collect()} == {20}
    again = stratify(rows.repartition(5), "label", "id")
    assert split.exceptAll(again.select(split.columns)).count() == 0
    weights = {r["label"]: r["w"] for r in balanced_weights(rows, "label").groupBy("label").agg(F.max("weight").alias("w")).collect()}
    assert weights == {0: 0.625, 1: 2.5}


@pytest.fixture(scope="module")
def features(spark):
    x = F.pmod(F.xxhash64("id"), F.lit(100)) / 100.0
    return spark.range(400).select(
        F.col("id").alias("id_ordre_travail"),
        x.alias("cout_total"),
        F.when(F.col("id") % 9 == 0, F.lit(float("nan"))).otherwise(F.rand(5)).alias("noise.x"),
        (x > 0.6).cast("long").alias("will_fail_within_30_days"),
        (x > 0.3).cast("long").alias("will_need_spare_parts"),
        F.lit(1).alias("has_spare_parts"),
        F.lit(True).alias("urgence_Fort"),
        F.lit("t").alias("site"),
    )


def test_inputs_leave_out_flags_targets_and_text(features):
    assert numeric_inputs(features) == ["cout_total", "noise.x", "has_spare_parts"]
    assert "urgence_Fort" in numeric_inputs(features, include_flags=True)


def test_classifiers_learn_and_reload(spark, features, folder):
    features = features.withColumnRenamed("noise.x", "noise")
    quick = cl.ModelSettings(trees=8, depth=4, balanced=True, folds=2)
    training = cl.train_failure_model(features, quick)
    got = training.metrics.first()
    assert got["n_samples"] == 400 and got["test_roc_auc"] > 0.95 and got["cv_roc_auc_mean"] > 0.95
    assert training.classifier.importances().first()["feature"] == "cout_total"
    scored = training.classifier.transform(features)
    assert scored.columns[-2:] == ["failure_prediction", "failure_probability"] and scored.columns[: len(features.columns)] == features.columns
    training.classifier.save(folder + "/m")
    again = cl.Classifier.load(folder + "/m").transform(features)
    assert scored.exceptAll(again).count() == 0
    parts = cl.train_parts_model(features, cl.ModelSettings(trees=3, depth=3, learning_rate=0.3, folds=0))
    assert parts.metrics.first()["test_f1"] > 0.9 and "has_spare_parts" not in parts.classifier.inputs


def test_effectiveness_model_needs_rows(spark):
    schema = "id_actif long, numero_ot long, famille string, prev_duration double, prev_cost double, is_effective boolean"
    row = lambda i: (i, i, "ab"[i % 2], float(i), None, i % 3 == 0)
    assert cl.train_effectiveness_model(spark.createDataFrame([row(i) for i in range(50)], schema)) is None
    trained = cl.train_effectiveness_model(
        spark.createDataFrame([row(i) for i in range(80)], schema), cl.ModelSettings(trees=3, depth=3, balanced=True, folds=0)
    )
    assert trained.metrics.first()["n_features"] == 4


def test_scaling_and_projection(cloud, features):
    scaler = Standardizer.fit(cloud, ["cout_total"])
    values = [r[0] for r in cloud.select(*scaler.columns()).collect()]
    assert abs(np.mean(values)) < 1e-9 and np.std(values) == pytest.approx(1.0)
    scaled, _ = model_matrix(features.withColumnRenamed("noise.x", "noise"), ["cout_total", "noise"])
    assert scaled.first()["scaled"].size == 2
    rows, shares = project(cloud, ["cout_total", "duree_intervention_par_heure"], ["id_ordre_travail"])
    assert rows.columns == ["id_ordre_travail", "pc1", "pc2"] and sum(shares) == pytest.approx(1.0)


def test_boundary_is_settled(spark):
    rng = np.random.default_rng(3)
    points = rng.normal(size=(1500, 3)) ** 3
    rows = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(points)], "id long, a double, b double, c double").checkpoint()

    def outside(tolerance):
        model = fit_boundary(rows, ["a", "b", "c"], size=64, tolerance=tolerance, steps=150)
        score = model.score_column(["a", "b", "c"]) - model.rho
        return {r[0] for r in rows.select("id", score.alias("s")).where("s < 0").collect()}

    usual, longer = outside(1e-3), outside(2e-4)
    assert len(usual) == 150 and len(usual & longer) >= 0.99 * len(usual)
    empty = fit_boundary(rows.limit(0), ["a", "b", "c"], size=8)
    assert empty.rho == 0.0


def test_boundary_needs_few_passes(spark, monkeypatch):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(10_000, 3))
    points = np.hstack([base, np.exp(base[:, :2])])
    points = (points - points.mean(axis=0)) / points.std(axis=0)
    names = [f"x{i}" for i in range(points.shape[1])]
    rows = spark.createDataFrame(pd.DataFrame(points, columns=names).rename_axis("id").reset_index()).checkpoint()
    passes = []
    once = boundary._one_pass
    monkeypatch.setattr(boundary, "_one_pass", lambda *given: passes.append(1) or once(*given))

    def outside(**settings):
        passes.clear()
        model = fit_boundary(rows, names, **settings)
        score = model.score_column(names) - model.rho
        return {r[0] for r in rows.select("id", score.alias("s")).where("s < 0").collect()}

    usual = outside()
    used = len(passes)
    longer = outside(steps=2 * used - 2, tolerance=-1.0)  # no early end
    assert used <= 30 and len(passes) == 2 * used
    assert len(usual) == 1000 and len(usual & longer) >= 0.99 * len(usual)


def test_forest_samples_are_drawn_in_compiled_code(spark):
    rows = spark.range(3_000).select("id", F.rand(4).alias("x0"))
    drawn = sample_for_trees(rows, "id", ["x0"], 5, 16, 42, 3_000)
    assert "lambda" not in drawn._jdf.queryExecution().executedPlan().toString()
    draws = rows.select("id", *[F.pmod(F.xxhash64(F.lit(42), F.lit(tree), "id"), F.lit(1 << 40)).alias(f"t{tree}") for tree in range(5)]).toPandas()
    wanted = {(tree, int(i)) for tree in range(5) for i in draws.nsmallest(16, f"t{tree}")["id"]}
    assert {(r["tree"], r["id"]) for r in drawn.collect()} == wanted


def test_trees_split_neighbouring_doubles():
    points = np.array([[1.0], [np.nextafter(1.0, 2.0)]] * 4)
    for seed in range(20):
        nodes = _grow(points, 8, np.random.default_rng(seed))
        assert len(nodes) == 3 and sum(node[1] == 0 for node in nodes) == 1


def test_shortest_mix_is_the_point_nearest_to_the_origin():
    vectors = np.array([[2.0, 1.0], [2.0, -3.0], [5.0, 0.0]])
    shares = boundary._shortest_mix(vectors @ vectors.T, np.array([0.0, 0.0, 1.0]))
    assert shares.sum() == pytest.approx(1.0) and (shares >= 0).all()
    assert shares @ vectors == pytest.approx([2.0, 0.0], abs=1e-6)


def counted(df, read):
    """``df``, of which every row read is added to the accumulator."""

    def work(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    return df.mapInArrow(work, df.schema)


def test_training_reads_its_rows_once(spark, features):
    features = features.withColumnRenamed("noise.x", "noise")
    read = spark.sparkContext.accumulator(0)
    trained = cl.train_failure_model(counted(features, read), cl.ModelSettings(trees=2, depth=2, balanced=True, folds=2))
    got = trained.metrics.first()
    assert read.value == 400
    assert got["n_samples"] == 400 and got["positive_rate"] == pytest.approx(features.agg(F.avg("will_fail_within_30_days")).first()[0])


def test_effectiveness_labels_are_read_once(spark):
    schema = "numero_ot long, famille string, prev_duration double, prev_cost double, is_effective boolean"
    rows = spark.createDataFrame([(i, "ab"[i % 2], float(i), None, i % 3 == 0) for i in range(80)], schema)
    read = spark.sparkContext.accumulator(0)
    assert cl.train_effectiveness_model(counted(rows, read), cl.ModelSettings(trees=2, depth=2, balanced=True, folds=0))
    assert read.value == 80


def test_known_counts_give_the_same_weights(spark):
    rows = spark.range(50).select("id", (F.col("id") % 5 == 0).cast("int").alias("label"))
    given = balanced_weights(rows, "label", counts={0: 40, 1: 10})
    assert given.exceptAll(balanced_weights(rows, "label")).count() == 0


def test_correlations_read_the_rows_once(spark):
    rows = spark.createDataFrame([(1.0, 2.0, None), (2.0, 1.0, 5.0), (4.0, 3.0, 6.0)], "a double, b double, c double")
    found = correlations(rows, ["a", "b", "c"])
    assert found._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1
    got = {(r[0], r[1]): r[2] for r in found.collect()}
    assert len(got) == 9 == found.count() and got["a", "b"] == got["b", "a"] == pytest.approx(rows.corr("a", "b"))


@pytest.fixture(scope="module")
def points(spark):
    """700 rows with five inputs, one of them constant, one mostly 0, and a noisy label."""
    names = ["a", "b", "c", "d", "e"]
    rows = spark.range(700).select(
        "id",
        F.rand(1).alias("a"),
        F.floor(F.rand(2) * 6).cast("double").alias("b"),
        F.when(F.rand(3) < 0.2, F.rand(4) - 0.5).otherwise(0.0).alias("c"),
        F.lit(1.5).alias("d"),
        F.randn(5).alias("e"),
    )
    noisy = F.col("a") + F.col("b") / 6 + F.col("c") + F.rand(6)
    rows = rows.withColumn("label", (noisy > 1.5).cast("int")).withColumn("weight", F.when(F.col("label") == 1, 1.4).otherwise(0.8))
    return VectorAssembler(inputCols=names, outputCol="scaled").transform(rows).checkpoint()


def probabilities(model, rows):
    found = model.transform(rows).select("id", vector_to_array("probability")[1].alias("p")).orderBy("id").collect()
    return np.array([r["p"] for r in found])


def test_forest_agrees_with_that_of_mllib(points):
    held, learnt = points.where("id % 4 = 0"), points.where("id % 4 > 0")
    settings = {"numTrees": 60, "maxDepth": 6, "minInstancesPerNode": 5, "featureSubsetStrategy": "sqrt", "weightCol": "weight", "seed": 1}
    theirs = RandomForestClassifier(featuresCol="scaled", labelCol="label", **settings).fit(learnt)
    ours = trees.ForestLearner(60, 6, 5, 1, ["id", "scaled"], weight="weight").fit(learnt)
    assert ours.getNumTrees == 60 and ours.totalNumNodes == pytest.approx(theirs.totalNumNodes, rel=0.1)
    assert np.allclose(ours.featureImportances.toArray(), theirs.featureImportances.toArray(), atol=0.05)
    assert np.abs(probabilities(ours, held) - probabilities(theirs, held)).mean() < 0.05


def test_splits_and_gains_of_a_known_table(spark):
    assert list(trees.candidate_splits(np.array([0.0, 2.0, 2.0, 4.0]), np.ones(4), 4.0)) == [1.0, 3.0]
    assert len(trees.candidate_splits(np.arange(1.0, 101.0), np.ones(100), 100.0)) == 31
    counts = np.zeros((1, 1, trees.MAX_BINS, 2))
    counts[0, 0, 0], counts[0, 0, 1] = [3, 1], [0, 4]
    gain, which, cut, total, left = trees.best_label_splits(counts, (1.0, 1.0), 1)
    assert (which[0], cut[0], list(total[0]), list(left[0])) == (0, 0, [3, 5], [3, 1])
    assert gain[0] == pytest.approx((1 - 9 / 64 - 25 / 64) - 0.5 * (1 - 9 / 16 - 1 / 16))
    assert trees.best_label_splits(counts, (1.0, 1.0), 5)[0][0] == -np.inf


def test_draws_are_poisson_numbers():
    drawn = trees.times_drawn(np.arange(200_000, dtype=np.uint64), 42, 3)
    assert drawn.mean() == pytest.approx(1.0, abs=0.02) and drawn.var() == pytest.approx(1.0, abs=0.03)
    assert (drawn == 0).mean() == pytest.approx(np.exp(-1), abs=0.01)
    chosen = trees.inputs_of_nodes(42, 3, np.arange(5_000), 9, 3)
    assert all(len(set(row)) == 3 for row in chosen.tolist())
    assert np.allclose(np.bincount(chosen.ravel(), minlength=9) / 5_000, 1 / 3, atol=0.03)


def test_trees_do_not_depend_on_chunks(points, monkeypatch):
    forest = trees.ForestLearner(5, 5, 2, 1, ["id", "scaled"], weight="weight")
    one = probabilities(forest.fit(points), points)
    monkeypatch.setattr(trees, "CHUNK_ROWS", 200)
    assert np.array_equal(probabilities(forest.fit(points.repartition(7)), points), one)


def test_deeper_trees_take_no_more_jobs(spark, features):
    """Every level was a job, or several."""
    features = features.withColumnRenamed("noise.x", "noise")

    def jobs(name, train, **settings):
        spark.sparkContext.setJobGroup(name, name)
        train(features, cl.ModelSettings(folds=0, **settings))
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))

    low, high = (jobs(f"forest-{n}", cl.train_failure_model, trees=4, depth=n, balanced=True) for n in (1, 6))
    assert high <= low + 3


def test_labels_must_be_known(points):
    with pytest.raises(ValueError, match="labels must be 0 or 1"):
        trees.ForestLearner(2, 2, 1, 1, ["id"]).fit(points.withColumn("label", F.when(F.col("id") > 5, F.col("label"))))
