"""Central imputation, and several models from one copy of a table."""

import pytest
from pyspark.sql import functions as F

from tallymark.operators import encode, impute, train


def test_mixed_table_in_one_call(spark):
    rows = [(1, 1.0, "a", True, None), (2, None, "b", None, None), (4, 3.0, None, False, None), (None, 9.0, "b", False, None), (9, 5.0, "a", True, None)]
    df = spark.createDataFrame(rows, "n int, x double, s string, flag boolean, gone string")
    center = impute.central(df).first()
    assert center.asDict() == {"n": 3, "x": 4.0, "s": "a", "flag": False, "gone": None}
    filled = impute.central_impute(df)
    assert filled.dtypes == df.dtypes and filled.count() == 5
    assert filled.select(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns[:4]]).first() == (0, 0, 0, 0)


def test_values_of_the_training_table_fill_another(spark):
    learn = spark.createDataFrame([(1, "a"), (2, "a"), (9, "b")], "n long, s string")
    other = spark.createDataFrame([(None, None), (5, "z")], "n long, s string")
    assert [tuple(r) for r in impute.central_impute(other, learn).collect()] == [(2, "a"), (5, "z")]
    assert [tuple(r) for r in impute.central_impute(other, learn, ["s"]).collect()] == [(None, "a"), (5, "z")]
    assert impute.central_impute(learn.limit(0)).count() == 0


@pytest.mark.parametrize("in_memory", [False, True])
def test_several_models_are_those_fitted_alone(spark, in_memory):
    df = spark.range(300).select(
        "id", (F.col("id") * 37 % 101 / 101.0).alias("a"), F.concat(F.lit("k"), F.col("id") % 3).alias("kind"),
        (F.col("id") * 37 % 101 > 50).cast("double").alias("label"), (1.0 + F.col("id") % 2).alias("w"))
    stages = encode.feature_stages(["kind"], ["a"], scaled=True)
    models = {
        "tree": train.estimator("tree", seed=1),
        "linear": train.estimator("linear"),
        "logistic": train.estimator("logistic", weightCol="w", regParam=0.1),
    }
    together = train.fit_several(df, stages, models, in_memory)
    for name, model in models.items():
        alone = train.score(train.fit(df, stages, model), df, ["id"]).collect()
        assert sorted(map(str, train.score(together[name], df, ["id"]).collect())) == sorted(map(str, alone))
