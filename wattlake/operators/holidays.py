"""Public-holiday calendar as a generated dimension and the is_holiday flag.

The calendar is built from years x rules: each year row explodes the
literal rule array (a generator, no join) and each rule's date is computed
with date functions (nth weekday, last weekday, weekday on or before a
date, Easter offset, fixed date) plus an observed-day rule.  Its size is
countries x years x ~12, so flagging rows is a broadcast join.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# --- fixed values: holiday rules ---------------------------------------------
# (country, name, kind, month, day, weekday(Mon=0), n, offset, observed,
#  first_year, only_year, skip_year)
# kinds: fixed | nth | last | onbefore | easter
# observed: none | us (Sat->Fri, Sun->Mon) | monday (Sat/Sun -> next Mon)
#           | plus2 (Sat/Sun -> +2 days) | jan2 (Sat/Sun -> +2, Mon -> +1)
HOLIDAY_RULES = [
    ("US", "New Year's Day", "fixed", 1, 1, None, None, None, "us", None, None, None),
    ("US", "Martin Luther King Jr. Day", "nth", 1, None, 0, 3, None, "none", 1986, None, None),
    ("US", "Washington's Birthday", "nth", 2, None, 0, 3, None, "none", 1971, None, None),
    ("US", "Memorial Day", "last", 5, None, 0, None, None, "none", 1971, None, None),
    ("US", "Independence Day", "fixed", 7, 4, None, None, None, "us", None, None, None),
    ("US", "Labor Day", "nth", 9, None, 0, 1, None, "none", None, None, None),
    ("US", "Columbus Day", "nth", 10, None, 0, 2, None, "none", 1971, None, None),
    ("US", "Veterans Day", "fixed", 11, 11, None, None, None, "us", None, None, None),
    ("US", "Thanksgiving", "nth", 11, None, 3, 4, None, "none", None, None, None),
    ("US", "Christmas Day", "fixed", 12, 25, None, None, None, "us", None, None, None),
    ("CA", "New Year's Day", "fixed", 1, 1, None, None, None, "us", None, None, None),
    ("CA", "Family Day", "nth", 2, None, 0, 3, None, "none", 2008, None, None),
    ("CA", "Good Friday", "easter", None, None, None, None, -2, "none", None, None, None),
    ("CA", "Victoria Day", "onbefore", 5, 24, 0, None, None, "none", 1953, None, None),
    ("CA", "Canada Day", "fixed", 7, 1, None, None, None, "monday", None, None, None),
    ("CA", "Civic Holiday", "nth", 8, None, 0, 1, None, "none", None, None, None),
    ("CA", "Labour Day", "nth", 9, None, 0, 1, None, "none", None, None, None),
    ("CA", "Thanksgiving", "nth", 10, None, 0, 2, None, "none", None, None, None),
    ("CA", "Christmas Day", "fixed", 12, 25, None, None, None, "plus2", None, None, None),
    ("CA", "Boxing Day", "fixed", 12, 26, None, None, None, "plus2", None, None, None),
    ("UK", "New Year's Day", "fixed", 1, 1, None, None, None, "monday", 1974, None, None),
    ("UK", "New Year Holiday [Scotland]", "fixed", 1, 2, None, None, None, "jan2", None, None, None),
    ("UK", "St. Patrick's Day [Northern Ireland]", "fixed", 3, 17, None, None, None, "monday", None, None, None),
    ("UK", "Good Friday", "easter", None, None, None, None, -2, "none", None, None, None),
    ("UK", "Easter Monday [England, Wales, Northern Ireland]", "easter", None, None, None, None, 1, "none",
     None, None, None),
    ("UK", "May Day", "nth", 5, None, 0, 1, None, "none", 1978, None, 2020),
    ("UK", "May Day", "fixed", 5, 8, None, None, None, "none", None, 2020, None),
    ("UK", "Spring Bank Holiday", "last", 5, None, 0, None, None, "none", 1971, None, 2012),
    ("UK", "Spring Bank Holiday", "fixed", 6, 4, None, None, None, "none", None, 2012, None),
    ("UK", "Diamond Jubilee of Elizabeth II", "fixed", 6, 5, None, None, None, "none", None, 2012, None),
    ("UK", "Battle of the Boyne [Northern Ireland]", "fixed", 7, 12, None, None, None, "none", None, None, None),
    ("UK", "Summer Bank Holiday [Scotland]", "nth", 8, None, 0, 1, None, "none", None, None, None),
    ("UK", "Late Summer Bank Holiday [England, Wales, Northern Ireland]", "last", 8, None, 0, None, None,
     "none", 1971, None, None),
    ("UK", "St. Andrew's Day [Scotland]", "fixed", 11, 30, None, None, None, "none", None, None, None),
    ("UK", "Christmas Day", "fixed", 12, 25, None, None, None, "plus2", None, None, None),
    ("UK", "Boxing Day", "fixed", 12, 26, None, None, None, "plus2", None, None, None),
    ("IE", "New Year's Day", "fixed", 1, 1, None, None, None, "monday", None, None, None),
    ("IE", "St. Patrick's Day", "fixed", 3, 17, None, None, None, "monday", None, None, None),
    ("IE", "Easter Monday", "easter", None, None, None, None, 1, "none", None, None, None),
    ("IE", "May Day", "nth", 5, None, 0, 1, None, "none", 1978, None, None),
    ("IE", "June Bank Holiday", "nth", 6, None, 0, 1, None, "none", None, None, None),
    ("IE", "August Bank Holiday", "nth", 8, None, 0, 1, None, "none", None, None, None),
    ("IE", "October Bank Holiday", "last", 10, None, 0, None, None, "none", 1977, None, None),
    ("IE", "Christmas Day", "fixed", 12, 25, None, None, None, "plus2", None, None, None),
    ("IE", "St. Stephen's Day", "fixed", 12, 26, None, None, None, "plus2", None, None, None),
]
# --- end fixed values ----------------------------------------------------------

RULE_FIELDS = ["country", "name", "kind", "month", "day", "weekday", "n", "offset", "observed",
               "first_year", "only_year", "skip_year"]
RULE_TYPES = ["string", "string", "string", "int", "int", "int", "int", "int", "string", "int", "int", "int"]


def easter_sunday(year: Column) -> Column:
    """Gregorian Easter Sunday (anonymous Gregorian computus)."""
    y = year
    a = y % 19
    b = F.floor(y / 100)
    c = y % 100
    d = F.floor(b / 4)
    e = b % 4
    f = F.floor((b + 8) / 25)
    g = F.floor((b - f + 1) / 3)
    h = (19 * a + b - d - g + 15) % 30
    i = F.floor(c / 4)
    k = c % 4
    lw = (32 + 2 * e + 2 * i - h - k) % 7
    m = F.floor((a + 11 * h + 22 * lw) / 451)
    t = h + lw - 7 * m + 114
    return F.make_date(y, F.floor(t / 31).cast("int"), (t % 31 + 1).cast("int"))


def _rule_date() -> Column:
    """Date of a rule row from precomputed ``first`` (1st of the rule's
    month) and ``easter`` columns; only cheap date arithmetic here."""
    kind = F.col("kind")
    wd, n, first = F.col("weekday"), F.col("n"), F.col("first")
    nth = F.date_add(first, ((wd - F.weekday(first) + 7) % 7 + 7 * (n - 1)).cast("int"))
    lastd = F.last_day(first)
    last = F.date_sub(lastd, ((F.weekday(lastd) - wd + 7) % 7).cast("int"))
    fixed = F.date_add(first, F.col("day") - 1)
    onbefore = F.date_sub(fixed, ((F.weekday(fixed) - wd + 7) % 7).cast("int"))
    easter = F.date_add(F.col("easter"), F.col("offset"))
    return (F.when(kind == "fixed", fixed).when(kind == "nth", nth).when(kind == "last", last)
            .when(kind == "onbefore", onbefore).when(kind == "easter", easter))


def _observed_shift(d: Column, policy: Column) -> Column:
    wd = F.weekday(d)
    return (F.when((policy == "us") & (wd == 5), -1).when((policy == "us") & (wd == 6), 1)
            .when((policy == "monday") & (wd == 5), 2).when((policy == "monday") & (wd == 6), 1)
            .when((policy == "plus2") & (wd >= 5), 2)
            .when((policy == "jan2") & (wd >= 5), 2).when((policy == "jan2") & (wd == 0), 1))


_CALENDARS: dict = {}


def holiday_calendar(spark: SparkSession, years: Iterable[int],
                     countries: Iterable[str] | None = None) -> DataFrame:
    """(country, name, holiday_date, observed) for the given years; the plan
    is built once per session for a given year set."""
    ys = tuple(sorted(set(int(y) for y in years)))
    cs = None if countries is None else tuple(sorted(set(countries)))
    key = (id(spark), spark.sparkContext.applicationId, ys, cs)
    if key not in _CALENDARS:
        _CALENDARS[key] = _build_calendar(spark, ys, cs)
    return _CALENDARS[key]


def _build_calendar(spark: SparkSession, years: Iterable[int],
                    countries: Iterable[str] | None = None) -> DataFrame:
    """(country, name, holiday_date, observed) for the given years.

    The (rule, year) rows are a fixed product of the rule table with a
    handful of years (about 45 x years rows), so they are a local relation;
    the dates are Spark date expressions over it."""
    ys = sorted(set(int(y) for y in years))
    rows = [r + (y,) for y in ys for r in HOLIDAY_RULES
            if (r[9] is None or y >= r[9]) and (r[10] is None or y == r[10]) and (r[11] is None or y != r[11])
            and (countries is None or r[0] in set(countries))]
    schema = ", ".join(f"{f} {t}" for f, t in zip(RULE_FIELDS, RULE_TYPES)) + ", year int"
    rules = spark.createDataFrame(rows, schema)
    rules = rules.withColumns({"first": F.make_date(F.col("year"), F.coalesce(F.col("month"), F.lit(1)), F.lit(1)),
                               "easter": easter_sunday(F.col("year"))})
    dated = rules.select("country", "name", _rule_date().alias("holiday_date"), F.col("observed").alias("policy"))
    shift = _observed_shift(F.col("holiday_date"), F.col("policy"))
    both = dated.select("country", "name", "holiday_date", F.explode(F.array(
        F.struct(F.lit(0).alias("shift"), F.lit(False).alias("observed")),
        F.struct(shift.alias("shift"), F.lit(True).alias("observed")))).alias("o"))
    return (both.where(F.col("o.shift").isNotNull())
            .select("country",
                    F.when(F.col("o.observed"), F.concat("name", F.lit(" (Observed)"))).otherwise(F.col("name"))
                    .alias("name"),
                    F.date_add("holiday_date", F.col("o.shift")).alias("holiday_date"),
                    F.col("o.observed").alias("observed")))


def calendar_for(df: DataFrame, time_col: str = "timestamp") -> DataFrame:
    """Calendar covering every year of ``df`` plus one on each side (for
    observed days that cross a year end).  Only the two year bounds leave
    the cluster (one small aggregate)."""
    b = df.agg(F.min(F.year(time_col)).alias("lo"), F.max(F.year(time_col)).alias("hi")).first()
    if b["lo"] is None:
        return holiday_calendar(df.sparkSession, [])
    return holiday_calendar(df.sparkSession, range(b["lo"] - 1, b["hi"] + 2))


def flag_holidays(df: DataFrame, calendar: DataFrame, country_col: str = "country",
                  time_col: str = "timestamp", out: str = "is_holiday") -> DataFrame:
    """``out`` = 1 when the row's date is a holiday (or observed day) of its
    country, else 0.  The calendar is a bounded dimension -> broadcast."""
    days = (calendar.select(F.col("country").alias("__hc"), F.col("holiday_date").alias("__hd"))
            .distinct())
    j = df.join(F.broadcast(days), (F.col(country_col) == F.col("__hc"))
                & (F.to_date(F.col(time_col)) == F.col("__hd")), "left")
    return j.withColumn(out, F.col("__hd").isNotNull().cast("int")).drop("__hc", "__hd")
