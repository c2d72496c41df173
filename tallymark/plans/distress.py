"""Financial-distress table: balance of the target, missing values, imputation.

    spark-submit tallymark/plans/distress.py INPUT.csv OUTPUT_FOLDER
"""

from __future__ import annotations

import sys

from pyspark.sql import DataFrame, SparkSession

from tallymark.operators import impute, profile, shape, totals
from tallymark.session import reliable_copy
from tallymark.sources import readers, schemas, sinks

# Columns filled with their mean; all others take their mode.
MEAN_COLUMNS = ("Utilization", "age", "FD_ind1", "Debt_Ratio", "Monthly_Income")


def reports(table: DataFrame, target: str = "Target") -> dict[str, DataFrame]:
    """Row and column counts, class balance, missing values, numeric summary."""
    numbers = shape.numeric_columns(table)
    return {
        "shape": totals.table_shape(table),
        "class_shares": totals.class_shares(table, target),
        "missing": profile.missing_profile(table),
        "summary": profile.numeric_summary(table, numbers),
        "quartiles": profile.quantiles(table, numbers, [0.25, 0.5, 0.75]),
    }


def prepared(table: DataFrame, target: str = "Target") -> DataFrame:
    """Target moved last, gaps filled: by mean, by mode, and 0 where neither exists."""
    ordered = shape.target_last(table, target)
    numbers = [c for c in MEAN_COLUMNS if c in table.columns]
    others = [c for c in table.columns if c not in (*numbers, target)]
    filled = impute.fill_from(ordered, impute.means(table, numbers))
    filled = impute.fill_from(filled, impute.modes(table, others))
    return impute.fill_numbers(filled, 0)


def run(spark: SparkSession, source: str, target: str) -> None:
    """Read the file, write every report as CSV and the prepared table as parquet.

    The file is parsed once: reports and statistics read a copy.
    """
    table = reliable_copy(readers.csv_typed(spark, source, schemas.DISTRESS, header=False))
    for name, report in reports(table).items():
        sinks.write_csv(report, f"{target}/{name}")
    filled = reliable_copy(prepared(table))
    with_mean = totals.with_global_mean(filled, "Utilization", "avg_util")
    sinks.write_table(with_mean, f"{target}/prepared")


if __name__ == "__main__":
    run(SparkSession.builder.appName("distress").getOrCreate(), *sys.argv[1:3])
