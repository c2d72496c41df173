"""Medal tallies from a file without a header: totals per country, sport and games.

    spark-submit tallymark/plans/medals.py INPUT.csv OUTPUT_FOLDER
"""

from __future__ import annotations

import sys

from pyspark.sql import DataFrame, SparkSession

from tallymark.functions.labels import row_total
from tallymark.operators import shape, totals
from tallymark.sources import readers, schemas, sinks

_MEDALS = ("gold", "silver", "bronze")


def reports(medals: DataFrame, sport: str = "Hockey", country: str = "India") -> dict[str, DataFrame]:
    """All tallies by name; a missing medal count counts as none."""
    won = row_total(_MEDALS)
    of_country = shape.equal_to(medals, "country", country)
    return {
        "country_in_sport": totals.sum_by(
            shape.equal_to(medals, "game_category", sport), ["country"], won, "medals"
        ),
        "one_country_by_games": totals.sum_by(
            of_country, ["country", "olympic_year"], won, f"medals_{country.lower()}"
        ),
        "country": totals.sum_by(medals, ["country"], won, "medals"),
        "country_by_games": totals.sum_by(
            medals, ["country", "olympic_year"], won, "medals"
        ),
        "athletes_by_games": shape.renamed(
            totals.distinct_of(of_country, ["olympic_year", "athlete"]),
            {"athlete": "athletes"},
        ),
    }


def run(spark: SparkSession, source: str, target: str) -> None:
    """Read the file and write one CSV folder per tally."""
    medals = readers.csv(spark, source, schemas.MEDALS, header=False)
    for name, report in reports(medals).items():
        sinks.write_csv(report, f"{target}/{name}")


if __name__ == "__main__":
    run(SparkSession.builder.appName("medals").getOrCreate(), *sys.argv[1:3])
