"""Closed forms against the fitted models of Spark, thresholds, trees, sparse vectors, products."""

import math

import pytest
from pyspark.errors import PySparkException
from pyspark.ml.classification import NaiveBayes, RandomForestClassifier
from pyspark.ml.feature import PolynomialExpansion, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from tallymark.functions import labels
from tallymark.operators import closed_form, encode, explain, sparse, train


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(500).select(
        "id",
        (F.col("id") * 37 % 101 / 101.0).alias("a"),
        (F.col("id") * 53 % 97 / 97.0 + 10).alias("b"),
        (F.col("id") * 29 % 7).cast("double").alias("c"),
        (F.col("id") % 3).cast("double").alias("label"),
        (F.col("id") * 11 % 2).cast("double").alias("x"),
        (F.col("id") * 17 % 5 < 2).cast("double").alias("y"),
        (1.0 + F.col("id") % 4).alias("weight"),
    )


def vectors(df, columns):
    return VectorAssembler(inputCols=columns, outputCol="features").transform(df)


@pytest.mark.parametrize("weight, smoothing", [(None, 1.0), ("weight", 0.5)])
def test_bernoulli_bayes_is_that_of_spark(rows, weight, smoothing):
    params = {"weightCol": weight} if weight else {}
    fitted = NaiveBayes(modelType="bernoulli", smoothing=smoothing, **params).fit(vectors(rows, ["x", "y"]))
    found = closed_form.bernoulli_bayes(rows, "label", ["x", "y"], weight, smoothing)
    got = {(r.label, r.term, r.present): r.value for r in found.collect()}
    for c in range(3):
        assert got[c, "pi", None] == pytest.approx(fitted.pi[c], abs=1e-9)
        for j, name in enumerate(("x", "y")):
            assert got[c, name, True] == pytest.approx(fitted.theta[c, j], abs=1e-9)
            assert math.exp(got[c, name, True]) + math.exp(got[c, name, False]) == pytest.approx(1)
    ours = closed_form.score_bernoulli(found, rows, ["x", "y"], ["id"]).collect()
    theirs = {r.id: r for r in fitted.transform(vectors(rows, ["x", "y"])).select("id", "prediction", vector_to_array("probability").alias("p")).collect()}
    for r in ours:
        assert r.prediction == theirs[r.id].prediction and r.probability == pytest.approx(theirs[r.id].p, abs=1e-9)


def test_bernoulli_bayes_wants_zeros_and_ones(rows):
    with pytest.raises(PySparkException, match="neither 0 nor 1"):
        closed_form.bernoulli_bayes(rows, "label", ["c"]).collect()


def test_regression_on_several_features(rows):
    noisy = rows.withColumn("label", 3 * F.col("a") - 2 * F.col("b") + F.col("c") + F.sin("id"))
    gaps = noisy.withColumn("a", F.when(F.col("id") % 50 > 0, F.col("a")))
    fitted = LinearRegression(solver="normal").fit(vectors(gaps.dropna(), ["a", "b", "c"]))
    found = {r.term: r for r in closed_form.linear_regression(gaps, "label", ["a", "b", "c"]).collect()}
    for term, value, error, t in zip(["a", "b", "c", "intercept"], [*fitted.coefficients, fitted.intercept],
                                     fitted.summary.coefficientStandardErrors, fitted.summary.tValues):
        assert found[term].value == pytest.approx(value, rel=1e-6)
        assert found[term].std_error == pytest.approx(error, rel=1e-5)
        assert found[term].t_value == pytest.approx(t, rel=1e-5)
    assert found["r2"].value == pytest.approx(fitted.summary.r2, abs=1e-9) and found["n"].value == 490


def test_regression_keeps_its_digits_beside_large_means(rows):
    far = rows.select("a", (F.col("b") + 1e7).alias("b"), (F.col("a") - F.col("b") + F.sin("id")).alias("label"))
    found = {r.term: r.value for r in closed_form.linear_regression(far, "label", ["a", "b"]).collect()}
    near = {r.term: r.value for r in closed_form.linear_regression(far.withColumn("b", F.col("b") - 1e7), "label", ["a", "b"]).collect()}
    assert found["a"] == pytest.approx(near["a"], rel=1e-6) and found["b"] == pytest.approx(near["b"], rel=1e-6)


def test_regression_on_features_that_follow_from_each_other(rows):
    twice = rows.select("a", (2 * F.col("a")).alias("d"), F.lit(5.0).alias("k"), (1 + 3 * F.col("a")).alias("label"))
    found = {r.term: r for r in closed_form.linear_regression(twice, "label", ["a", "d", "k"]).collect()}
    assert found["a"].value + 2 * found["d"].value == pytest.approx(3) and found["a"].std_error is None
    assert found["intercept"].value == pytest.approx(1) and found["r2"].value == pytest.approx(1)
    assert closed_form.linear_regression(twice.limit(0), "label", ["a"]).first().value == 0


# Thresholds -----------------------------------------------------------------------


@pytest.mark.parametrize("thresholds", [[0.2, 0.5, 0.3], [0.0, 0.6, 0.4], [0.5, 0.5, 0.0]])
def test_thresholds_decide_as_in_spark(rows, thresholds):
    model = RandomForestClassifier(numTrees=3, maxDepth=3, seed=1).setThresholds(thresholds).fit(vectors(rows, ["a", "c"]))
    scored = model.transform(vectors(rows, ["a", "c"])).select("prediction", vector_to_array("probability").alias("p"))
    assert scored.where(labels.class_by_thresholds(F.col("p"), thresholds) != F.col("prediction")).count() == 0


def test_a_zero_threshold_wins_only_with_some_probability(spark):
    rows = spark.createDataFrame([([0.0, 0.3, 0.7],), ([1e-9, 0.3, 0.7],), (None,)], "p array<double>")
    got = [r[0] for r in rows.select(labels.class_by_thresholds(F.col("p"), [0.0, 0.5, 0.5])).collect()]
    assert got == [2.0, 0.0, None]
    with pytest.raises(PySparkException, match="2 probabilities"):
        rows.select(labels.class_by_thresholds(F.col("p"), [0.5, 0.5])).collect()


@pytest.mark.parametrize("bad", [[], [-0.1, 0.5], [0.0, 0.0], [0.0, 0.0, 0.4]])
def test_thresholds_that_cannot_be_used(bad):
    with pytest.raises(ValueError):
        labels.class_by_thresholds(F.lit(None), bad)


def test_the_two_forms_must_agree():
    assert labels.threshold_of([0.4, 0.6]) == pytest.approx(0.6) and labels.thresholds_of(0.6) == pytest.approx([0.4, 0.6])
    assert labels.agreeing_threshold(0.6, [0.4, 0.6]) == pytest.approx(0.6)
    assert labels.agreeing_threshold(0.6, [0.8, 1.2]) == pytest.approx(0.6)
    assert labels.agreeing_threshold(0.6 + 9e-6, [0.4, 0.6]) and labels.agreeing_threshold(0.3, None) == 0.3
    for threshold, thresholds in ((0.5, [0.4, 0.6]), (0.6 + 2e-5, [0.4, 0.6]), (0.5, [0.2, 0.3, 0.5])):
        with pytest.raises(ValueError):
            labels.agreeing_threshold(threshold, thresholds)
    with pytest.raises(ValueError):
        train.estimator("logistic", threshold=0.5, thresholds=[0.1, 0.9])


# Trees ------------------------------------------------------------------------------


@pytest.mark.parametrize("kind, params", [("tree", {}), ("forest", {"numTrees": 3, "subsamplingRate": 1.0, "bootstrap": False}), ("boosted_regression", {"maxIter": 2})])
def test_rows_of_tree_nodes(spark, rows, kind, params):
    target = rows.withColumn("label", (F.col("a") * 3 + F.col("c") > 3).cast("double"))
    stages = encode.feature_stages([], ["a", "c", "x"])
    model = train.fit(target, stages, train.estimator(kind, maxDepth=4, seed=1, **params)).stages[-1]
    found = explain.tree_table(model, ["a", "c", "x"]).collect()
    nodes = {(r.tree, r.node): r for r in found}
    assert len({r.tree for r in found}) == {"tree": 1, "forest": 3, "boosted_regression": 2}[kind]
    assert len(nodes) == (model.numNodes if kind == "tree" else model.totalNumNodes)
    for r in found:
        way, here = F.lit(True), r
        while here.parent is not None:
            up = nodes[r.tree, here.parent]
            below = F.col(up.feature) <= up.split
            way, here = way & (below if here.side == "left" else ~below), up
        assert target.where(way).count() == r.rows and r.depth <= 4
        assert (r.feature is None) == (r.split is None) == (r.gain is None)


# Vectors and products ------------------------------------------------------------------


def test_sparse_vectors_are_those_of_label_lists(spark):
    df = spark.createDataFrame(
        [(1, "x", "p", 1.5), (2, "y", "p", 0.0), (3, "x", "q", -2.0), (4, "z", "r", 3.0), (5, "y", "r", 4.0)],
        "id int, s string, t string, n double")
    for keep in (False, True):
        slots = sparse.fit_slots(df, ["s", "t"], ["n"], keep_unseen=keep)
        ours = sparse.with_features(df, "id", slots)
        theirs = encode.fit_features(df, ["s", "t"], ["n"], keep_unseen=keep).transform(df)
        assert ours.columns == [*df.columns, "features"]
        assert {r.id: r.features.toArray().tolist() for r in ours.collect()} == {
            r.id: r.features.toArray().tolist() for r in theirs.collect()}
    names = {r.slot: (r.column, r.value) for r in sparse.slot_names(slots).collect()}
    assert names[0] == ("s", "x") and names[6] == ("n", None) and len(names) == 7
    model = train.estimator("tree").fit(ours.withColumn("label", F.col("id") % 2))
    assert model.numFeatures == 7


def test_values_that_were_not_in_training(spark):
    df = spark.createDataFrame([(1, "x", 1.0), (2, "y", 2.0), (3, "y", 3.0)], "id int, s string, n double")
    new = spark.createDataFrame([(7, "new", 1.0, "own"), (8, None, 2.0, "own"), (9, "y", 0.0, "own")], "id int, s string, n double, row string")
    kept = sparse.fit_slots(df, ["s"], ["n"], keep_unseen=True)
    got = {r.id: (r.features, r.row) for r in sparse.with_features(new, "id", kept).collect()}
    assert got == {7: (Vectors.sparse(3, {2: 1.0}), "own"), 8: (Vectors.sparse(3, {2: 2.0}), "own"), 9: (Vectors.sparse(3, {0: 1.0}), "own")}
    strict = sparse.fit_slots(df, ["s"], ["n"])
    with pytest.raises(PySparkException, match="no such level in training: s=new"):
        sparse.with_features(new.where("id = 7"), "id", strict).collect()
    with pytest.raises(PySparkException, match="the key repeats: 1"):
        sparse.with_features(df.unionAll(df.where("id = 1")), "id", strict).collect()
    with pytest.raises(PySparkException, match="missing number in n"):
        sparse.with_features(df.withColumn("n", F.lit(None).cast("double")), "id", strict).collect()
    assert sparse.with_features(df.limit(0), "id", strict).count() == 0
    only = sparse.fit_slots(df, [], ["n"])
    assert {r.features.size for r in sparse.with_features(df, "id", only).collect()} == {1}


def test_many_columns_either_way(spark, monkeypatch):
    columns = [f"t{i}" for i in range(17)]
    df = spark.range(60).select("id", *[F.when(F.col("id") % 9 > 0, F.concat(F.lit("v"), F.col("id") * (i + 3) % 11)).alias(c) for i, c in enumerate(columns)])
    levels = encode.level_indexes(df.where("id < 30"), columns, "first_seen", by="id")
    for keep in (False, True):
        plain = df
        for c in columns:
            plain = encode.apply_levels(plain, c, encode.of_column(levels, c), f"__{c}", keep)
        expected = sorted(map(str, plain.select("id", *[F.col(f"__{c}").alias(c) for c in columns]).collect()))
        monkeypatch.setattr(encode, "MAX_LEVELS", 10_000)
        narrow = encode.encode_columns(df, columns, levels, keep)
        monkeypatch.setattr(encode, "MAX_LEVELS", 0)
        long = encode.encode_columns(df, columns, levels, keep)
        assert sorted(map(str, narrow.collect())) == expected == sorted(map(str, long.collect()))
    plan = long._jdf.queryExecution().optimizedPlan().toString()
    assert narrow.columns == long.columns == df.columns and plan.count("Join LeftOuter") == 1


def few_and_many(spark):
    """Two levels and a NULL, beside as many levels as rows."""
    few = F.when(F.col("id") % 10 > 0, F.when(F.col("id") % 2 == 0, "even").otherwise("odd"))
    return spark.range(60).select(
        "id", few.alias("few"), F.concat(F.lit("m"), "id").alias("many"), (F.col("id") % 3).cast("double").alias("n"))


def test_few_levels_beside_many_are_broadcast(spark, monkeypatch):
    df = few_and_many(spark)
    levels = encode.level_indexes(df.where("id < 40"), ["few", "many"], "first_seen", by="id")
    plain = df
    for c in ("few", "many"):
        plain = encode.apply_levels(plain, c, encode.of_column(levels, c), f"__{c}", True)
    shuffled, real = [], encode._encode_long
    monkeypatch.setattr(encode, "_encode_long", lambda df, columns, *a: shuffled.extend(columns) or real(df, columns, *a))
    monkeypatch.setattr(encode, "MAX_LEVELS", 20)
    got = encode.encode_columns(df, ["few", "many"], levels, True)
    expected = plain.select("id", F.col("__few").alias("few"), F.col("__many").alias("many"), "n")
    assert got.columns == df.columns and sorted(map(str, got.collect())) == sorted(map(str, expected.collect()))
    assert shuffled == ["many"]


def test_slots_of_few_levels_beside_many(spark, monkeypatch):
    df = few_and_many(spark)
    monkeypatch.setattr(encode, "MAX_LEVELS", 20)
    slots = sparse.fit_slots(df.where("id < 40"), ["few", "many"], ["n"], keep_unseen=True)
    assert sparse._found(df, "id", slots).count() == 60  # one cell a row, not two
    names = {r.slot: (r.column, r.value) for r in sparse.slot_names(slots).collect()}
    for r in sparse.with_features(df, "id", slots).collect():
        filled = dict(zip(r.features.indices.tolist(), r.features.values.tolist()))
        expected = [("few", r.few)] * (r.few is not None) + [("many", r.many)] * (r.id < 40)
        assert [names[i] for i in filled if names[i][0] != "n"] == expected
        assert filled.get(slots.numbers["n"], 0.0) == r.n and len(filled) == len(expected) + (r.n != 0)
    strict = sparse.fit_slots(df.where("few IS NOT NULL"), ["few", "many"], ["n"])
    with pytest.raises(PySparkException, match="no such level in training: few=NULL"):
        sparse.with_features(df.where("id = 10"), "id", strict).collect()
    with pytest.raises(PySparkException, match="no such level in training: many=other"):
        sparse.with_features(df.where("id = 11").withColumn("many", F.lit("other")), "id", strict).collect()


def test_products_are_those_of_spark(rows):
    expanded = PolynomialExpansion(degree=3, inputCol="features", outputCol="all").transform(vectors(rows, ["a", "c", "x"]))
    ours = encode.expand(rows, ["a", "c", "x"], 3)
    names = list(encode.monomials(["a", "c", "x"], 3))
    assert len(names) == 19 and names[:5] == ["a", "c", "x", "a*a", "a*c"]
    for r, s in zip(sorted(ours.collect(), key=lambda r: r.id), sorted(expanded.collect(), key=lambda r: r.id)):
        assert sorted(r[n] for n in names) == pytest.approx(sorted(s["all"].toArray()))
    with pytest.raises(ValueError):
        encode.monomials(["a"], 0)
    with pytest.raises(ValueError):
        encode.monomials([f"c{i}" for i in range(400)], 3)


def test_gradient_shows_a_fit_without_its_weights(rows):
    target = rows.withColumn("label", (F.sin("id") + F.col("a") > 0.5).cast("double"))
    stages = encode.feature_stages([], ["a", "c"])
    for column, least in (("weight", False), (None, True)):
        params = {"weightCol": column} if column else {}
        model = train.fit(target, stages, train.estimator("logistic", maxIter=300, tol=1e-13, **params))
        scored = train.score(model, target, ["label", "a", "c", "weight"])
        slopes = explain.logistic_gradient(scored, "label", ["a", "c"], "weight").collect()
        assert (max(abs(r.gradient) for r in slopes) > 1e-4) == least


