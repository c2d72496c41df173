"""Reading raw files and the columnar tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DataType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from tallymark.functions.text import MISSING_WORDS, missing_to_null, trimmed


def csv(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType | None = None,
    header: bool = True,
    names: Sequence[str] | None = None,
    sep: str = ",",
) -> DataFrame:
    """Read CSV files.

    Give ``schema`` whenever it is known: without it Spark reads every file an
    extra time to infer the types.  ``names`` renames the columns by position.
    """
    reader = spark.read.option("header", header).option("sep", sep)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    df = reader.csv(path)
    return df.toDF(*names) if names else df


def csv_typed(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType,
    header: bool = True,
    sep: str = ",",
    missing: Sequence[str] = MISSING_WORDS,
) -> DataFrame:
    """Read CSV files whose typed columns may hold missing-value words.

    Every field is read as text; missing-value words become NULL, and numbers
    are cast so that unreadable text becomes NULL instead of failing the job.
    """
    raw = StructType([StructField(f.name, StringType(), True) for f in schema])
    df = spark.read.schema(raw).option("header", header).option("sep", sep).csv(path)
    known = df.select(*[missing_to_null(f.name, missing).alias(f.name) for f in schema])
    return known.select(
        *[
            F.col(f.name) if isinstance(f.dataType, StringType)
            else trimmed(f.name).try_cast(f.dataType).alias(f.name)
            for f in schema
        ]
    )


# What a text must look like before a cast is tried, where casts take more than is meant.
_DATE = r"^\d{4}-\d{1,2}-\d{1,2}$"
_MOMENT = r"^\d{4}-\d{1,2}-\d{1,2}[ T]\d{1,2}:\d{2}"
# Narrowest first.
_TYPES = (
    (BooleanType(), r"(?i)^(true|false)$"),
    (IntegerType(), None),
    (LongType(), None),
    (DoubleType(), None),
    (DateType(), _DATE),
    (TimestampType(), _MOMENT),
)
_BROKEN = "__broken"


def _as_text(spark: SparkSession, path: str | list[str], names: Sequence[str], header: bool, sep: str) -> DataFrame:
    """All fields as text; ``__broken`` holds lines with too few or too many fields."""
    schema = StructType([StructField(n, StringType(), True) for n in [*names, _BROKEN]])
    reader = spark.read.schema(schema).option("header", header).option("sep", sep).option("enforceSchema", True)
    # Fields are counted, so all of them are read whatever a query asks for.
    reader = reader.option("mode", "PERMISSIVE").option("columnPruning", False)
    return reader.option("columnNameOfCorruptRecord", _BROKEN).csv(path)


def _cast(name: str, kind: DataType, form: str | None, missing: Sequence[str]) -> Column:
    text = F.trim(missing_to_null(name, missing))
    return (F.when(text.rlike(form), text) if form else text).try_cast(kind)


def _fits(lines: DataFrame, names: Sequence[str], missing: Sequence[str]) -> DataFrame:
    """One row: per column its values, and per type how many of them it can hold."""
    sound = lines.where(F.col(_BROKEN).isNull())
    counts = []
    for i, name in enumerate(names):
        counts.append(F.count(missing_to_null(name, missing)).alias(f"n_{i}"))
        counts += [F.count(_cast(name, kind, form, missing)).alias(f"t_{i}_{k}") for k, (kind, form) in enumerate(_TYPES)]
    return sound.agg(*counts)


def infer_schema(
    spark: SparkSession,
    path: str | list[str],
    header: bool = True,
    names: Sequence[str] | None = None,
    sep: str = ",",
    dirty: float = 0.0,
    missing: Sequence[str] = MISSING_WORDS,
) -> StructType:
    """The narrowest types that hold the values of all rows, from one scan.

    Types are boolean, int, long, double, date, timestamp, else text.  A type may
    leave out up to the share ``dirty`` of a column's values; ``csv_checked`` then
    puts those rows aside.  Missing-value words fit every type; a column of
    nothing else is text.  Lines with a wrong number of fields do not count.
    """
    if names is None:
        first = spark.read.option("header", header).option("sep", sep).csv(path)
        names = first.columns
    found = _fits(_as_text(spark, path, names, header, sep), names, missing).first()
    fields = []
    for i, name in enumerate(names):
        n = found[f"n_{i}"]
        fitting = [kind for k, (kind, _) in enumerate(_TYPES) if n and n - found[f"t_{i}_{k}"] <= dirty * n]
        fields.append(StructField(name, fitting[0] if fitting else StringType(), True))
    return StructType(fields)


def csv_checked(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType,
    header: bool = True,
    sep: str = ",",
    missing: Sequence[str] = MISSING_WORDS,
) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects): typed rows, and what does not fit, with its reasons.

    ``rejects`` has the fields as text (``fields``), the whole line where its
    number of fields is wrong (``line``), and ``reasons``.  Every line that is not
    blank is in one of the two.  Missing-value words are NULL and fit.
    """
    forms = {type(kind): form for kind, form in _TYPES}
    names = schema.names
    lines = _as_text(spark, path, names, header, sep)
    typed = {
        f.name: F.col(f.name) if isinstance(f.dataType, StringType) else _cast(f.name, f.dataType, forms.get(type(f.dataType)), missing)
        for f in schema
    }
    # Nothing of the first field is shown; naming it keeps the line from being read for __broken alone.
    nothing = F.substring(F.coalesce(F.col(names[0]), F.lit("")), 1, 0)
    reasons = [F.when(F.col(_BROKEN).isNotNull(), F.concat(F.lit("wrong number of fields"), nothing))]
    reasons += [
        F.when(
            F.col(_BROKEN).isNull() & missing_to_null(f.name, missing).isNotNull() & typed[f.name].isNull(),
            F.concat(F.lit(f"{f.name} is no {f.dataType.simpleString()}: "), F.col(f.name)),
        )
        for f in schema
        if not isinstance(f.dataType, StringType)
    ]
    judged = lines.select("*", F.array_compact(F.array(*reasons)).alias("__reasons"))
    rows = judged.where(F.size("__reasons") == 0).select(
        *[(missing_to_null(n, missing) if isinstance(schema[n].dataType, StringType) else typed[n]).alias(n) for n in names]
    )
    rejects = judged.where(F.size("__reasons") > 0).select(
        F.struct(*names).alias("fields"), F.col(_BROKEN).alias("line"), F.col("__reasons").alias("reasons")
    )
    return rows, rejects


def libsvm(spark: SparkSession, path: str, n_features: int | None = None) -> DataFrame:
    """Read (label, features) rows; give ``n_features`` to save a pass over the files."""
    reader = spark.read.format("libsvm")
    if n_features is not None:
        reader = reader.option("numFeatures", n_features)
    return reader.load(path)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One parquet table of a folder."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def view(df: DataFrame, name: str) -> DataFrame:
    """Register a table for ``spark.sql`` and return it."""
    df.createOrReplaceTempView(name)
    return df
