"""Column names and types of the raw files, all nullable."""

from __future__ import annotations

from pyspark.sql.types import DateType, DoubleType, IntegerType, StringType, StructType

_TYPES = {"int": IntegerType, "double": DoubleType, "string": StringType, "date": DateType}


def _schema(fields: str) -> StructType:
    """``name type, name type, ...``, readable before any session exists."""
    schema = StructType()
    for field in fields.split(", "):
        name, kind = field.split(" ")
        schema = schema.add(name, _TYPES[kind]())
    return schema


# Names and types of the file columns, in file order.
MEDALS = _schema(
    "athlete string, age int, country string, olympic_year int, date_of_game string, "
    "game_category string, gold int, silver int, bronze int, total_medals int"
)
DISTRESS = _schema(
    "Target int, Utilization double, age int, FD_ind1 int, Debt_Ratio double, "
    "Monthly_Income double, FD_ind2 int, FD_ind3 int, FD_ind4 int, FD_ind5 int, "
    "NumberOfDependents int"
)
SALES = _schema(
    "store_id int, store_type string, assortment_level string, date date, "
    "competitor_distance double, competitor_months double, day_of_week int, month int, "
    "year int, sale_amount double, customer_count int, open int, promo int, "
    "state_holiday string, school_holiday string, next_day_state_holiday string, "
    "next_day_school_holiday int, avg_sales_last_2days double, avg_sales_last_3days double, "
    "avg_sales_last_4days double, avg_sales_last_5days double, avg_sales_by_month double"
)
ENGINE_TESTS = _schema(
    "ID int, y string, Number_of_Cylinders string, material_grade string, Lubrication string, "
    "Valve_Type string, Bearing_Vendor string, Fuel_Type string, Compression_ratio string, "
    "cam_arrangement string, Cylinder_arragement string, Turbocharger string, "
    "Varaible_Valve_Timing_VVT string, Cylinder_deactivation string, Direct_injection string, "
    "main_bearing_type string, displacement string, piston_type string, Max_Torque string, "
    "Peak_Power string, Crankshaft_Design string, Liner_Design string"
)
ID_LISTS = _schema("TestA int, TestB int")
SUBMISSION = _schema("ID int, y string")
