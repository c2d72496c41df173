"""Indexes, indicators, vectors, splits."""

import pytest
from pyspark.sql import functions as F

from tallymark.operators import encode, split

ROWS = [(1, "b", 1.0), (2, "a", 2.0), (3, "b", 3.0), (4, "c", 4.0), (5, "a", 5.0), (6, "b", 6.0)]


@pytest.fixture()
def letters(spark):
    return spark.createDataFrame(ROWS, "id int, t string, v double")


@pytest.mark.parametrize(
    "order, by, expected",
    [
        ("frequency", None, {"b": 0, "a": 1, "c": 2}),
        ("alphabet", None, {"a": 0, "b": 1, "c": 2}),
        ("first_seen", "id", {"b": 0, "a": 1, "c": 2}),
    ],
)
def test_level_index(letters, order, by, expected):
    assert dict(encode.level_index(letters, "t", order, by).collect()) == expected
    assert dict(
        encode.of_column(encode.level_indexes(letters, ["t"], order, by), "t").collect()
    ) == expected


def test_both_routes_agree_on_ties(spark):
    df = spark.createDataFrame([(c,) for c in "zzyyxa"], "t string")
    by_table = dict(encode.level_index(df, "t").collect())
    fitted = encode.fit_string_index(df, "t", "i")
    assert by_table == {label: float(i) for i, label in enumerate(fitted.labels)}


def test_unseen_values(spark, letters):
    levels = encode.level_index(letters, "t")
    new = spark.createDataFrame([("a",), ("q",), (None,)], "t string")
    plain = encode.apply_levels(new, "t", levels, "i").collect()
    assert sorted((r.t or "", r.i) for r in plain) == [("", None), ("a", 1.0), ("q", None)]
    kept = encode.apply_levels(new, "t", levels, "i", keep=True).collect()
    assert sorted((r.t or "", r.i) for r in kept) == [("", 3.0), ("a", 1.0), ("q", 3.0)]


def test_indicators_drop_the_last_level_and_keep_unseen(spark, letters):
    plain = encode.fit_features(letters, ["t"], ["v"]).transform(letters)
    assert encode.slot_count(plain) == 3
    assert encode.slot_names(plain)[-1] == "v"
    model = encode.fit_features(letters, ["t"], ["v"], keep_unseen=True)
    new = spark.createDataFrame([(9, "q", 0.5), (10, None, 0.5)], "id int, t string, v double")
    rows = encode.vector_rows(model.transform(new), "id", "features").collect()
    assert sorted((r.id, r.slot, r.value) for r in rows) == [
        (i, s, 0.5 if s == 3 else 0.0) for i in (9, 10) for s in range(4)
    ]


def test_unseen_values_fail_without_keep(spark, letters):
    model = encode.fit_features(letters, ["t"], ["v"])
    new = spark.createDataFrame([(9, "q", 0.5)], "id int, t string, v double")
    with pytest.raises(Exception, match="(?i)unseen"):
        model.transform(new).collect()


def test_single_level_columns_are_left_out_and_ids_refused(spark, letters):
    df = letters.withColumn("one", F.lit("x"))
    assert encode.usable_categories(df, ["t", "one"]) == ["t"]
    with pytest.raises(ValueError, match="too many levels"):
        encode.usable_categories(df, ["t"], limit=2)


def test_scaling_divides_by_the_sample_deviation(letters):
    out = encode.fit_features(letters, [], ["v"], scaled=True).transform(letters)
    values = {r.id: r.value for r in encode.vector_rows(out, "id", "features").collect()}
    assert values[6] == pytest.approx(6 / 1.8708286933869707)


def test_index_round_trip(letters):
    model = encode.fit_string_index(letters, "t", "i")
    back = encode.labels_back(model, "i", "again").transform(model.transform(letters))
    assert all(r.t == r.again for r in back.collect())


def test_slot_categories_keep_zero_first(spark):
    from pyspark.ml.feature import VectorAssembler

    df = spark.createDataFrame([(i, float(i % 3 - 1), float(i)) for i in range(9)], "id int, c double, x double")
    vectors = VectorAssembler(inputCols=["c", "x"], outputCol="features").transform(df)
    out = encode.fit_slot_categories(vectors, 3).transform(vectors)
    rows = encode.vector_rows(out, "id", "indexed_features").where("slot = 0").collect()
    assert {r.id % 3 - 1: r.value for r in rows} == {0: 0.0, -1: 1.0, 1: 2.0}


def test_split_is_stable_disjoint_and_whole(spark):
    df = spark.range(2000)
    parts = split.split(df, "id", [0.5, 0.3, 0.2])
    ids = [{r.id for r in p.collect()} for p in parts]
    assert set.union(*ids) == set(range(2000)) and sum(map(len, ids)) == 2000
    assert [round(len(i) / 2000, 1) for i in ids] == [0.5, 0.3, 0.2]
    again = split.split(df.repartition(17), "id", [0.5, 0.3, 0.2])
    assert [{r.id for r in p.collect()} for p in again] == ids
    salted = split.split(df, "id", [0.5, 0.5], salt="x")[0]
    assert {r.id for r in salted.collect()} != ids[0]


def test_split_on_several_columns_and_folds(spark):
    df = spark.range(1000).select("id", (F.col("id") % 7).alias("k"))
    one, two = split.split(df, ["id", "k"], [0.7, 0.3])
    assert one.count() + two.count() == 1000 and 650 < one.count() < 750
    folds = split.with_fold(df, "id", 5).groupBy("fold").count().collect()
    assert sorted(r.fold for r in folds) == [0, 1, 2, 3, 4]
    assert df.where(split.below("id", 1.0)).count() == 1000
