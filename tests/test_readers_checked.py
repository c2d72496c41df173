"""Types from all rows, and rows that do not fit put aside."""

import datetime

import pytest
from pyspark.sql import types as T

from tallymark.sources import readers


@pytest.fixture
def late_dirt(tmp_path):
    lines = ["id,price,day,flag,word,big,none"]
    lines += [f"{i},{i}.5,2020-01-{1 + i % 28:02d},{'TRUE' if i % 2 else 'false'},w{i},{i * 10**9},NA" for i in range(5000)]
    lines += ["5000,NA,NULL,, padded ,7,", "x1,2.5,2020-01-01,true,late,8,", "5002,2.5,yesterday,true,late,9,",
              "5003,2.5", "5004,1,2020-01-01,true,late,9,,too,many", "5005,abc,2020-13-01,maybe,late,1.5,"]
    path = tmp_path / "rows.csv"
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def kinds(schema):
    return [f.dataType.simpleString() for f in schema]


def test_every_row_decides_the_type(spark, late_dirt):
    assert kinds(readers.infer_schema(spark, late_dirt)) == ["string", "string", "string", "string", "string", "double", "string"]
    found = readers.infer_schema(spark, late_dirt, dirty=0.001)
    assert found.names == ["id", "price", "day", "flag", "word", "big", "none"]
    assert kinds(found) == ["int", "double", "date", "boolean", "string", "bigint", "string"]


def test_rows_that_do_not_fit_are_put_aside(spark, late_dirt):
    schema = readers.infer_schema(spark, late_dirt, dirty=0.001)
    rows, rejects = readers.csv_checked(spark, late_dirt, schema)
    assert rows.schema.names == schema.names and rows.count() == 5001
    last = rows.where("id = 5000").first()
    assert last.price is None and last.day is None and last.flag is None and last.none is None
    assert rows.where("id = 3").first().day == datetime.date(2020, 1, 4)
    assert rows.agg({"id": "sum"}).first()[0] == sum(range(5001))  # one column read alone, rejects stay out
    found = {r.fields.id: r for r in rejects.collect()}
    assert found["x1"].reasons == ["id is no int: x1"]
    assert found["5002"].reasons == ["day is no date: yesterday"]
    assert found["5003"].reasons == ["wrong number of fields"] and found["5003"].line == "5003,2.5"
    assert found["5004"].reasons == ["wrong number of fields"]
    assert found["5005"].reasons == ["price is no double: abc", "day is no date: 2020-13-01", "flag is no boolean: maybe", "big is no bigint: 1.5"]
    assert len(found) == 5


def test_types_come_from_one_scan(spark, late_dirt):
    names = ["id", "price", "day", "flag", "word", "big", "none"]
    lines = readers._as_text(spark, late_dirt, names, True, ",")
    plan = readers._fits(lines, names, readers.MISSING_WORDS)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 1


def test_without_header_and_without_rows(spark, tmp_path):
    path = tmp_path / "plain.csv"
    path.write_text("1;2020-01-01 10:00:00;3000000000\n2;2021-01-01 10:00:00;4\n")
    found = readers.infer_schema(spark, str(path), header=False, names=["a", "t", "b"], sep=";")
    assert kinds(found) == ["int", "timestamp", "bigint"]
    rows, rejects = readers.csv_checked(spark, str(path), found, header=False, sep=";")
    assert rows.count() == 2 and rejects.count() == 0
    empty = tmp_path / "empty.csv"
    empty.write_text("a,b\n")
    found = readers.infer_schema(spark, str(empty))
    assert found == T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.StringType())])
    assert readers.csv_checked(spark, str(empty), found)[0].count() == 0
