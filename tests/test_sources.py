"""Readers and sinks."""

from pyspark.sql import functions as F

from tallymark.sources import readers, schemas, sinks


def write(path, text):
    path.write_text(text)
    return str(path)


def test_csv_without_header(spark, tmp_path):
    path = write(tmp_path / "m.csv", "A,20,India,2000,d,Hockey,1,0,0,1\nB,30,Spain,2004,d,Golf,,1,0,1\n")
    df = readers.csv(spark, path, schemas.MEDALS, header=False)
    assert df.schema == schemas.MEDALS
    assert [r.gold for r in df.orderBy("athlete").collect()] == [1, None]


def test_csv_inferred_and_renamed(spark, tmp_path):
    path = write(tmp_path / "x.csv", "1;a\n2;b\n")
    df = readers.csv(spark, path, header=False, names=["n", "t"], sep=";")
    assert df.dtypes == [("n", "int"), ("t", "string")]


def test_typed_csv_reads_missing_words_as_null(spark, tmp_path):
    path = write(tmp_path / "f.csv", "1,0.5,40,NA,0.1, NULL ,1,2,3,4,\n0,x,50,2,0.2,100.5,1,2,3,4,5\n")
    df = readers.csv_typed(spark, path, schemas.DISTRESS, header=False).orderBy("age")
    first, second = df.collect()
    assert (first.FD_ind1, first.Monthly_Income, first.NumberOfDependents) == (None, None, None)
    assert (second.Utilization, second.Monthly_Income) == (None, 100.5)
    assert df.schema == schemas.DISTRESS


def test_libsvm_and_views(spark, tmp_path):
    path = write(tmp_path / "v.txt", "1 1:0.5 3:2\n0 2:1\n")
    df = readers.libsvm(spark, path, n_features=3)
    assert df.count() == 2 and df.first().features.size == 3
    readers.view(df, "vectors")
    assert spark.sql("select count(*) from vectors").first()[0] == 2


def test_sinks_replace_and_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, 1.0), (2, 0.0)], "id int, prediction double")
    target = str(tmp_path / "out")
    for _ in range(2):
        sinks.write_csv(sinks.submission(df, "id"), target, one_file=True)
    back = readers.csv(spark, target, schemas.SUBMISSION)
    assert sorted(map(tuple, back.collect())) == [(1, "pass"), (2, "fail")]
    sinks.write_table(df, str(tmp_path / "table"))
    assert spark.read.parquet(str(tmp_path / "table")).count() == 2


def test_probability_columns(spark):
    from pyspark.ml.linalg import Vectors

    df = spark.createDataFrame([(1, Vectors.dense([0.2, 0.8]))], ["id", "probability"])
    row = sinks.probability_columns(df, 2).select("probability_0", F.col("probability_1")).first()
    assert tuple(row) == (0.2, 0.8)
