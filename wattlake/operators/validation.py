"""Input validation as one aggregate per table.

Each rule counts violating rows; min/max style checks ignore NULLs (a NULL
value passes), as in the modelled checks.  ``validate_inputs`` returns the
report and can raise on the first failing rule."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattlake.constants import METER_COLS, METER_LIMITS, WEATHER_COLS, WEATHER_LIMITS


def validate_columns(df: DataFrame, cols: Sequence[str], table: str = "input") -> DataFrame:
    """(table, column, present, supported): required columns must exist and
    not be strings.  A schema check, no Spark job over the data."""
    spark = df.sparkSession
    types = {f.name: f.dataType for f in df.schema.fields}
    rows = [(table, c, c in types, c in types and not isinstance(types[c], T.StringType)) for c in cols]
    return spark.createDataFrame(rows, "table string, column string, present boolean, supported boolean")


def range_rules(limits: Mapping[str, tuple]) -> list[tuple[str, Column]]:
    """(rule, number of violating rows as an aggregate) for every (column, lower, upper)."""
    rules = []
    for c, (lo, hi) in limits.items():
        if lo is not None:
            rules.append((f"{c} >= {lo}", F.count_if(F.col(c) < lo)))
        if hi is not None:
            rules.append((f"{c} <= {hi}", F.count_if(F.col(c) > hi)))
    return rules


def range_violations(df: DataFrame, limits: Mapping[str, tuple], table: str = "input") -> DataFrame:
    """(table, rule, violations) for every (column, lower, upper) rule, from
    a single aggregate."""
    rules = range_rules(limits)
    agg = df.agg(*[e.alias(f"r{i}") for i, (_, e) in enumerate(rules)])
    return agg.select(F.inline(F.array(*[
        F.struct(F.lit(table).alias("table"), F.lit(name).alias("rule"), F.col(f"r{i}").alias("violations"))
        for i, (name, _) in enumerate(rules)])))


def _column_problem(r) -> str:
    what = "holds text, which is not supported" if r["present"] else "does not exist"
    return f"{r['table']} table: column {r['column']} {what}"


def check_columns(df: DataFrame, cols: Sequence[str], table: str) -> None:
    """Raise on the first required column that is absent or holds text (schema only)."""
    for r in validate_columns(df, cols, table).collect():
        if not (r["present"] and r["supported"]):
            raise AssertionError(_column_problem(r))


def check_ranges(df: DataFrame, limits: Mapping[str, tuple], table: str) -> None:
    """Raise on the first rule that rows violate (one aggregate)."""
    bad = range_violations(df, limits, table).where("violations > 0").limit(1).collect()
    if bad:
        raise AssertionError(f"Bad value: {table} {bad[0]['rule']}")


def validate_meter(meter: DataFrame, limits: Mapping[str, tuple] | None = None) -> DataFrame:
    return range_violations(meter, limits or METER_LIMITS, "meter")


def validate_weather(weather: DataFrame, limits: Mapping[str, tuple] | None = None) -> DataFrame:
    return range_violations(weather, limits or WEATHER_LIMITS, "weather")


def validate_inputs(meter: DataFrame, weather: DataFrame, meter_cols: Sequence[str] = METER_COLS,
                    weather_cols: Sequence[str] = WEATHER_COLS, raise_on_error: bool = False,
                    meter_limits: Mapping[str, tuple] | None = None,
                    weather_limits: Mapping[str, tuple] | None = None) -> DataFrame:
    """Column checks, then value rules; report rows (table, rule, violations)."""
    col_report = validate_columns(meter, meter_cols, "meter").unionByName(
        validate_columns(weather, weather_cols, "weather"))
    col_rows = col_report.select(
        "table", F.concat(F.lit("column "), F.col("column")).alias("rule"),
        ((~F.col("present")).cast("int") + (~F.col("supported")).cast("int")).cast("bigint").alias("violations"))
    bad_cols = [r for r in col_report.collect() if not (r["present"] and r["supported"])]
    if bad_cols:
        if raise_on_error:
            raise AssertionError(_column_problem(bad_cols[0]))
        return col_rows
    report = (col_rows.unionByName(validate_meter(meter, meter_limits))
              .unionByName(validate_weather(weather, weather_limits)))
    if raise_on_error:
        failing = report.where("violations > 0").limit(1).collect()
        if failing:
            raise AssertionError(f"Bad value: {failing[0]['table']} {failing[0]['rule']}")
    return report
