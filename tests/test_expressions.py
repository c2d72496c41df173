"""Column expressions on hand-made rows."""

from pyspark.sql import functions as F

from tallymark.functions import labels, text
from tallymark.operators import shape


def values(df, column):
    return [row[column] for row in df.select(column).collect()]


def test_text_clean_up(spark):
    df = spark.createDataFrame(
        [(1, "  a b "), (2, "NA"), (3, " NULL "), (4, " "), (5, None), (6, "")], "id int, t string"
    )
    assert values(shape.trim_all(df), "t") == ["a b", "NA", "NULL", "", None, ""]
    assert values(shape.underscore_all(df), "t") == ["__a_b_", "NA", "_NULL_", "_", None, ""]
    assert values(shape.missing_words_to_null(df), "t") == ["  a b ", None, None, None, None, None]
    assert values(shape.missing_words_to_value(df, "0"), "t") == ["  a b "] + ["0"] * 5


def test_whole_number_rounds_half_up_and_survives_text(spark):
    df = spark.createDataFrame([("3.5",), ("2.4",), ("NA",), (None,)], "t string")
    assert [v if v is None else int(v) for v in values(shape.whole_numbers(df, ["t"]), "t")] == [
        4, 2, None, None,
    ]


def test_labels_and_codes(spark):
    df = spark.createDataFrame(
        [(" pass ", True, True), ("fail", True, False), (None, False, True), ("pass", False, False)],
        "y string, a boolean, b boolean",
    )
    out = df.select(
        labels.binary_label("y", "pass").alias("label"),
        labels.membership_code(F.col("a"), F.col("b")).alias("code"),
        labels.membership_code(F.col("a"), F.col("b"), one_sided=2).alias("strict"),
    ).collect()
    assert [tuple(r) for r in out] == [(1, 1, 1), (0, 3, 2), (0, 3, 2), (1, 2, 2)]


def test_row_total_with_and_without_missing(spark):
    df = spark.createDataFrame([(1, 2, None), (1, 2, 3)], "a int, b int, c int")
    assert [r[0] for r in df.select(labels.row_total(["a", "b", "c"])).collect()] == [3, 6]
    strict = df.select(labels.row_total(["a", "b", "c"], missing_as_zero=False))
    assert [r[0] for r in strict.collect()] == [None, 6]


def test_best_class_takes_the_first_of_equals(spark):
    df = spark.createDataFrame([([0.1, 0.7, 0.7],), ([2.0, -1.0, 0.0],)], "s array<double>")
    assert [r[0] for r in df.select(labels.best_class(F.col("s"))).collect()] == [1.0, 0.0]


def test_softmax_survives_large_scores(spark):
    df = spark.createDataFrame([([1000.0, 1000.0],), ([0.0, 1.0],)], "s array<double>")
    first, second = (r[0] for r in df.select(labels.softmax(F.col("s"))).collect())
    assert first == [0.5, 0.5]
    assert abs(sum(second) - 1) < 1e-12 and second[1] > second[0]


def test_threshold_pair():
    assert abs(labels.threshold_of((0.6, 0.4)) - 0.4) < 1e-12


def test_projection_helpers(spark):
    df = spark.createDataFrame([(1, "x", 2.0)], "t int, s string, d double")
    assert shape.target_last(df, "t").columns == ["s", "d", "t"]
    assert shape.renamed(df, {"s": "z"}).columns == ["t", "z", "d"]
    assert shape.renamed_by_position(df, {1: "Target"}).columns == ["t", "Target", "d"]
    assert shape.with_label(df, "d", ["t", "d"]).columns == ["t", "d", "label"]
    assert shape.numeric_columns(df) == ["t", "d"]


def test_missing_words_are_configurable(spark):
    df = spark.createDataFrame([("?",), ("NA",)], "t string")
    assert [r[0] for r in df.select(text.missing_to_null("t", ("?",))).collect()] == [None, "NA"]
