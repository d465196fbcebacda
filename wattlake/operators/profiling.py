"""Profiling aggregates.

Rules followed throughout:
* many columns -> ONE aggregate (one job, map-side partial aggregation),
  unpivoted to long form with ``inline(array(struct ...))``;
* grand totals enter per-group results as scalar subqueries
  (``DataFrame.scalar()``), never as an un-partitioned window;
* distinct counts are two-level group-bys (shuffle on the keys), never a
  collection of a group in one task.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from wattlake.operators.numbering import numbered
from wattlake.session import scratch_dir

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
           T.DecimalType)


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, NUMERIC) and f.name not in exclude]


def _long(df_one_row: DataFrame, structs: list[Column]) -> DataFrame:
    return df_one_row.select(F.inline(F.array(*structs)))


def _dbl(c: Column) -> Column:
    return c.cast("double")


# ---------------------------------------------------------------------------
# per-column summaries

def column_types(df: DataFrame) -> DataFrame:
    """(column, dtype, non_null) for every column: one aggregate."""
    agg = df.agg(*[F.count(F.col(c)).alias(f"n{i}") for i, c in enumerate(df.columns)])
    structs = [F.struct(F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("dtype"),
                        F.col(f"n{i}").alias("non_null"))
               for i, f in enumerate(df.schema.fields)]
    return _long(agg, structs)


def column_stats(df: DataFrame) -> DataFrame:
    """count, missing, mean, std (sample), min, max, dtype per column; the
    numeric statistics are NULL for non-numeric columns."""
    num = set(numeric_columns(df))
    aggs = [F.count("*").alias("__n")]
    for i, c in enumerate(df.columns):
        aggs.append(F.count(F.col(c)).alias(f"c{i}"))
        if c in num:
            aggs += [F.avg(c).alias(f"m{i}"), F.stddev_samp(c).alias(f"s{i}"),
                     _dbl(F.min(c)).alias(f"lo{i}"), _dbl(F.max(c)).alias(f"hi{i}")]
    agg = df.agg(*aggs)
    null = F.lit(None).cast("double")
    structs = []
    for i, f in enumerate(df.schema.fields):
        isnum = f.name in num
        structs.append(F.struct(
            F.lit(f.name).alias("column"), F.col(f"c{i}").alias("count"),
            (F.col("__n") - F.col(f"c{i}")).alias("missing"),
            (F.col(f"m{i}") if isnum else null).alias("mean"),
            (F.col(f"s{i}") if isnum else null).alias("std"),
            (F.col(f"lo{i}") if isnum else null).alias("min"),
            (F.col(f"hi{i}") if isnum else null).alias("max"),
            F.lit(f.dataType.simpleString()).alias("dtype")))
    return _long(agg, structs)


def quantile_exprs(col: str, probs: Sequence[float], method: str = "percentile",
                   accuracy: int = 1_000_000) -> Column:
    """Aggregate expression for an array of quantiles.  ``percentile``:
    Spark's exact aggregate (buffers each group's values in one task; for
    dimension-sized groups); ``approx``: ``percentile_approx`` sketch."""
    if method == "percentile":
        return F.percentile(F.col(col), F.array(*[F.lit(float(p)) for p in probs]))
    if method == "approx":
        return F.percentile_approx(F.col(col), F.array(*[F.lit(float(p)) for p in probs]),
                                   accuracy).cast("array<double>")
    raise ValueError(method)


def exact_quantiles(df: DataFrame, col: str, probs: Sequence[float], accuracy: int = 10_000,
                    max_candidates: int = 2_000_000) -> list:
    """Exact linear-interpolation quantiles of one column (see
    ``exact_quantiles_multi``)."""
    return exact_quantiles_multi(df, [col], probs, accuracy, max_candidates)[col]


def exact_quantiles_multi(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
                          accuracy: int = 10_000, max_candidates: int = 2_000_000) -> dict:
    """Exact linear-interpolation quantiles of several columns, distributed.

    1. non-null count per column (one job);
    2. a ``percentile_approx`` sketch brackets every needed order statistic
       (rank error <= n/accuracy; the bracket is twice that wide);
    3. one job counts, per bracket, the rows below it and inside it; while a
       bracket still holds more than ``max_candidates`` rows (and spans more
       than one value), the sketch is re-run on the in-bracket rows only
       (null-masked per bracket, all brackets in one job) and step 3
       repeats -- every round shrinks a bracket by about accuracy/4;
    4. in-bracket values grouped by (column, bracket, value) get a running
       count per bracket and one grouped aggregate picks the statistics.
    Ties collapse in the grouped table, so a value repeated a billion times
    is one candidate row.  No task holds a whole column; the driver only
    sees counts and bracket bounds."""
    import math
    from pyspark.sql import Window
    cols = list(cols)
    probs = [float(p) for p in probs]
    xs = {c: F.col(c).cast("double") for c in cols}
    ns = df.agg(*[F.count(xs[c]).alias(f"n{j}") for j, c in enumerate(cols)]).first()
    # one bracket per (column, prob): global ranks k0 <= k1, bounds lo/hi
    br = []
    for j, c in enumerate(cols):
        n = ns[f"n{j}"]
        if not n:
            continue
        for i, p in enumerate(probs):
            pos = p * (n - 1)
            k0 = int(math.floor(pos))
            br.append({"c": c, "j": j, "i": i, "k0": k0, "k1": min(k0 + 1, n - 1), "frac": pos - k0,
                       "below": 0, "inside": n, "lo": None, "hi": None})
    out = {c: [None] * len(probs) for c in cols}
    if not br:
        return out

    def in_bracket(b):
        x = xs[b["c"]]
        if b["lo"] is None:
            return x.isNotNull()
        return x.between(F.lit(b["lo"]), F.lit(b["hi"]))

    def sketch(todo):
        exprs = []
        for t, b in enumerate(todo):
            m = b["inside"]
            r0, r1 = b["k0"] - b["below"], b["k1"] - b["below"]
            margin = 2 * math.ceil(m / accuracy) + 2
            ps = [max(0.0, (r0 - margin) / m), min(1.0, (r1 + 1 + margin) / m)]
            exprs.append(F.percentile_approx(F.when(in_bracket(b), xs[b["c"]]),
                                             F.array(*[F.lit(v) for v in ps]), accuracy).alias(f"s{t}"))
        r = df.agg(*exprs).first()
        for t, b in enumerate(todo):
            b["lo"], b["hi"] = float(r[f"s{t}"][0]), float(r[f"s{t}"][1])

    def recount():
        r = df.agg(*[F.count_if(xs[b["c"]] < F.lit(b["lo"])).alias(f"b{t}") for t, b in enumerate(br)],
                   *[F.count_if(in_bracket(b)).alias(f"i{t}") for t, b in enumerate(br)]).first()
        for t, b in enumerate(br):
            b["below"], b["inside"] = r[f"b{t}"], r[f"i{t}"]

    todo = br
    for _ in range(8):
        sketch(todo)
        recount()
        todo = [b for b in br if b["inside"] > max_candidates and b["lo"] < b["hi"]]
        if not todo:
            break

    tags = [F.when(in_bracket(b), F.struct(F.lit(t).alias("t"), xs[b["c"]].alias("x"))) for t, b in enumerate(br)]
    cand = (df.select(F.explode(F.filter(F.array(*tags), lambda e: e.isNotNull())).alias("e"))
            .select("e.t", "e.x")
            .groupBy("t", "x").agg(F.count("*").alias("n"))
            .withColumn("cum", F.sum("n").over(Window.partitionBy("t").orderBy("x")
                                               .rowsBetween(Window.unboundedPreceding, 0))))

    def target(which):
        e = None
        for t, b in enumerate(br):
            v = F.lit(b[which] - b["below"] + 1)
            e = F.when(F.col("t") == t, v) if e is None else e.when(F.col("t") == t, v)
        return e

    picked = {r["t"]: (r["v0"], r["v1"]) for r in cand.groupBy("t").agg(
        F.min(F.when(F.col("cum") >= target("k0"), F.col("x"))).alias("v0"),
        F.min(F.when(F.col("cum") >= target("k1"), F.col("x"))).alias("v1")).collect()}
    for t, b in enumerate(br):
        v0, v1 = picked[t]
        out[b["c"]][b["i"]] = v0 + (v1 - v0) * b["frac"] if b["frac"] else v0
    return out


#: Leading bits of the order key that each level of ``radix_quantiles`` tells apart.
_LEVELS = (20, 40, 64)


def order_key(x: Column) -> Column:
    """64-bit integer with the order of a non-null double: its bits, the magnitude inverted below zero (-0.0 is 0.0)."""
    bits = F.java_method(F.lit("java.lang.Double"), F.lit("doubleToLongBits"), x + F.lit(0.0)).cast("long")
    return F.when(bits >= 0, bits).otherwise(bits.bitwiseXOR(F.lit(0x7FFFFFFFFFFFFFFF)))


def radix_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float]) -> dict[str, list]:
    """Exact linear-interpolation quantiles of several columns, from two reads of ``df``.

    The order statistics are found from the leading bits down.  The first read counts the rows of every column by the
    first bits of their order key; running counts give, with certainty, the prefix that holds each wanted rank and the
    rows below it.  The second read writes the distinct values of those prefixes with their counts, and the same step
    on that table, with more bits, ends at single values.  There is no sketch and no bracket that could miss.

    A running count sorts at most 2**20 prefixes of a column (2**24 in the last level); ties are one row.  The driver
    sees one row per column, rank and level."""
    cols, probs = list(cols), [float(p) for p in probs]

    def quoted(c: str) -> str:
        return "`" + c.replace("`", "``") + "`"

    x = (df.selectExpr("inline(array(" + ", ".join(f"struct({j} as j, cast({quoted(c)} as double) as x)" for j, c in enumerate(cols)) + "))")
         .where("x is not null").withColumn("k", order_key(F.col("x"))).withColumn("p", F.shiftright("k", 64 - _LEVELS[0])))
    upto = "sum(n) over (partition by {} order by {} rows unbounded preceding) - n as below"
    # the first read: prefixes that hold the two ranks around each quantile
    low = f"transform(array({', '.join(f'{p!r}D' for p in probs)}), q -> floor(q * (total - 1)))"
    counts = (x.groupBy("j", "p").agg(F.count(F.lit(1)).alias("n"))
              .selectExpr("*", upto.format("j", "p"), "sum(n) over (partition by j) as total"))
    hits = counts.selectExpr(
        "j", "p", "below", "total", f"explode(filter(array_distinct(concat({low}, transform({low}, r -> least(r + 1, total - 1)))), "
        "r -> below <= r and r < below + n)) as rank").collect()
    totals = {h["j"]: h["total"] for h in hits}
    out: dict[str, list] = {c: [None] * len(probs) for c in cols}
    if not hits:
        return out

    def wanted(rows: Sequence) -> str:
        """The hits as a constant array: as many as ranks."""
        return "array(" + ", ".join(f"named_struct('j', {h['j']}, 'p', {h['p']}L, 'rank', {h['rank']}L, 'base', {h['below']}L)"
                                    for h in rows) + ")"

    # the second read: the distinct values of those prefixes
    path = scratch_dir(df.sparkSession, "quantiles")
    (x.where(f"exists({wanted(hits)}, e -> e.j = j and e.p = p)").groupBy("j", "k", "x").agg(F.count(F.lit(1)).alias("n"))
     .write.parquet(path))
    near = df.sparkSession.read.parquet(path)
    for before, bits in zip(_LEVELS, _LEVELS[1:]):
        here = wanted(hits)
        part = (near.selectExpr("j", f"shiftright(k, {64 - before}) as p", f"shiftright(k, {64 - bits}) as next", "n", "x")
                .where(f"exists({here}, e -> e.j = j and e.p = p)")
                .groupBy("j", "p", "next").agg(F.sum("n").alias("n"), F.min("x").alias("x")).selectExpr("*", upto.format("j, p", "next")))
        found = part.selectExpr("*", f"explode(filter({here}, e -> e.j = j and e.p = p and below <= e.rank - e.base "
                                     "and e.rank - e.base < below + n)) as e")
        hits = found.selectExpr("j", "next as p", "e.rank as rank", "e.base + below as below", "x").collect()
    value = {(h["j"], h["rank"]): h["x"] for h in hits}  # all 64 bits told apart: one value per hit
    for j, total in totals.items():
        for i, p in enumerate(probs):
            place = p * (total - 1)
            first = math.floor(place)
            v0, v1 = value[j, first], value[j, min(first + 1, total - 1)]
            out[cols[j]][i] = v0 + (v1 - v0) * (place - first) if place > first else v0
    return out


def describe(df: DataFrame, cols: Sequence[str] | None = None, method: str = "exact") -> DataFrame:
    """count, mean, std, min, 25%, 50%, 75%, max per numeric column.
    ``exact``: distributed exact quantiles (``radix_quantiles``);
    ``percentile`` / ``approx``: the single aggregate variants."""
    cols = list(cols) if cols else numeric_columns(df)
    aggs = []
    exact = radix_quantiles(df, cols, (0.25, 0.5, 0.75)) if method == "exact" else {}
    for i, c in enumerate(cols):
        if method == "exact":
            q = F.array(*[F.lit(v).cast("double") for v in exact[c]])
        else:
            q = quantile_exprs(c, (0.25, 0.5, 0.75), method)
        aggs += [F.count(c).alias(f"c{i}"), F.avg(c).alias(f"m{i}"), F.stddev_samp(c).alias(f"s{i}"),
                 _dbl(F.min(c)).alias(f"lo{i}"), _dbl(F.max(c)).alias(f"hi{i}"), q.alias(f"q{i}")]
    agg = df.agg(*aggs)
    structs = [F.struct(F.lit(c).alias("column"), F.col(f"c{i}").alias("count"),
                        F.col(f"m{i}").alias("mean"), F.col(f"s{i}").alias("std"),
                        F.col(f"lo{i}").alias("min"), F.col(f"q{i}")[0].alias("p25"),
                        F.col(f"q{i}")[1].alias("p50"), F.col(f"q{i}")[2].alias("p75"),
                        F.col(f"hi{i}").alias("max"))
               for i, c in enumerate(cols)]
    return _long(agg, structs)


def missing_summary(df: DataFrame) -> DataFrame:
    """(column, missing, pct_missing rounded to 2) for every column."""
    agg = df.agg(F.count("*").alias("__n"),
                 *[F.count(F.col(c)).alias(f"c{i}") for i, c in enumerate(df.columns)])
    structs = []
    for i, c in enumerate(df.columns):
        miss = F.col("__n") - F.col(f"c{i}")
        structs.append(F.struct(F.lit(c).alias("column"), miss.alias("missing"),
                                F.round(F.try_divide(miss * 100, F.col("__n")), 2).alias("pct_missing")))
    return _long(agg, structs)


def missing_by_site(df: DataFrame, pct: bool = False, site_col: str = "site_id",
                    time_col: str = "timestamp") -> DataFrame:
    """Per site: rows with a timestamp, then missing count (or percent, 2
    decimals) of every other column."""
    others = [c for c in df.columns if c not in (site_col, time_col)]
    n = F.count(F.col(time_col))
    aggs = [n.alias(time_col)]
    for c in others:
        miss = n - F.count(F.col(c))
        if pct:
            aggs.append(F.round(F.try_divide(miss * 100, n), 2).alias(f"pct_missing_{c}"))
        else:
            aggs.append(miss.alias(f"missing_{c}"))
    return df.groupBy(site_col).agg(*aggs)


def null_counts(df: DataFrame) -> DataFrame:
    """(column, nulls) for every column, one aggregate."""
    agg = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"c{i}") for i, c in enumerate(df.columns)])
    return _long(agg, [F.struct(F.lit(c).alias("column"), F.col(f"c{i}").alias("nulls"))
                       for i, c in enumerate(df.columns)])


def assert_no_nulls(df: DataFrame) -> None:
    raise_on_nulls({r["column"]: r["nulls"] for r in null_counts(df).where("nulls > 0").collect()})


def raise_on_nulls(nulls: dict[str, int]) -> None:
    bad = {c: n for c, n in nulls.items() if n}
    if bad:
        raise AssertionError(f"columns with nulls, and how many: {bad}")


class NullReport:
    """Null counts of a frame, taken while some action runs over it: no pass of their own.

    ``watch(df)`` returns the frame to use; after an action on it (or on anything built on it) ``counts`` has rows and
    nulls per column.  A stage that Spark repeats after losing an executor may count rows twice; a count is zero if and
    only if there are no nulls, so raising on it stays exact."""

    def __init__(self, extra: dict[str, Column] | None = None):
        self.observation = Observation()
        self.extra = dict(extra or {})
        self.columns: list[str] = []

    def watch(self, df: DataFrame) -> DataFrame:
        self.columns = df.columns
        return df.observe(self.observation, F.count(F.lit(1)).alias("rows"),
                          *[F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(self.columns)],
                          *[e.alias(k) for k, e in self.extra.items()])

    @property
    def counts(self) -> dict[str, int]:
        got = self.observation.get
        return {c: got[f"n{i}"] for i, c in enumerate(self.columns)}

    def value(self, name: str):
        return self.observation.get[name]


# ---------------------------------------------------------------------------
# keys and groups

def duplicate_count(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows beyond the first per key: one row (duplicates)."""
    return (df.groupBy(*keys).count()
            .agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).cast("bigint").alias("duplicates")))


def expected_gap(df: DataFrame, keys: Sequence[str], expected: int) -> DataFrame:
    """Expected minus actual readings over all keys (one row)."""
    per = df.groupBy(*keys).count()
    return per.agg(F.count("*").alias("n_keys"), F.sum("count").alias("n_readings"),
                   (F.count("*") * F.lit(expected) - F.sum("count")).alias("missing_readings"))


def missing_readings_report(df: DataFrame, expected: int, building_col: str = "building_id",
                            meter_col: str = "meter", time_col: str = "timestamp",
                            meter_names: dict | None = None) -> DataFrame:
    """Meters whose reading count differs from ``expected``: affected
    buildings, meters and meters per type, with floor-integer percents.
    Long form (scope, n_missing, n_total, pct).

    One shuffle builds the per-meter counts; one aggregate over that small
    table (buildings x meters rows) yields every figure."""
    from wattlake.constants import METER_NAMES
    names = meter_names or METER_NAMES
    by_bm = (df.groupBy(building_col, meter_col).agg(F.count(F.col(time_col)).alias("n"))
             .withColumn("short", (F.col("n") != expected).cast("int")))
    m = F.col(meter_col)
    aggs = [F.count_distinct(F.when(F.col("short") == 1, F.col(building_col))).alias("b_miss"),
            F.count_distinct(building_col).alias("b_all"),
            F.sum("short").alias("m_miss"), F.count("*").alias("m_all")]
    for k in names:
        aggs += [F.sum(F.when(m == k, F.col("short"))).alias(f"t{k}_miss"), F.count_if(m == k).alias(f"t{k}_all")]
    one = by_bm.agg(*aggs)
    rows = [F.struct(F.lit("buildings").alias("scope"), F.col("b_miss").alias("n_missing"),
                     F.col("b_all").alias("n_total")),
            F.struct(F.lit("meters").alias("scope"), F.col("m_miss").alias("n_missing"),
                     F.col("m_all").alias("n_total"))]
    rows += [F.struct(F.lit(v).alias("scope"), F.col(f"t{k}_miss").alias("n_missing"),
                      F.col(f"t{k}_all").alias("n_total")) for k, v in names.items()]
    out = one.select(F.inline(F.array(*rows))).where(F.col("n_total") > 0)
    return out.select("scope", F.col("n_missing").cast("bigint").alias("n_missing"),
                      F.col("n_total").cast("bigint").alias("n_total"),
                      F.expr("n_missing * 100 div n_total").cast("bigint").alias("pct"))


def group_counts(df: DataFrame, by: Sequence[str], sum_col: str | None = None) -> DataFrame:
    """count, optional sum, and percent of all rows per group."""
    total = df.select(F.count("*")).scalar()
    aggs = [F.count("*").alias("count")]
    if sum_col:
        aggs.append(F.sum(sum_col).alias(f"sum_{sum_col}"))
    return (df.groupBy(*by).agg(*aggs)
            .withColumn("pct", F.round(F.col("count") * 100.0 / total, 4)))


def group_nunique(df: DataFrame, by: Sequence[str], col: str) -> DataFrame:
    """Distinct values of ``col`` per group (exact, two-level aggregate)."""
    return (df.select(*by, col).where(F.col(col).isNotNull()).distinct()
            .groupBy(*by).agg(F.count("*").alias(f"n_{col}")))


def count_of_counts(df: DataFrame, by: str, col: str) -> DataFrame:
    """How many groups have n distinct values (e.g. buildings with n meters)."""
    per = group_nunique(df, [by], col)
    return per.groupBy(F.col(f"n_{col}")).agg(F.count("*").alias(f"n_{by}"))


def group_means(df: DataFrame, by: Sequence[str], cols: Sequence[str] | None = None) -> DataFrame:
    cols = list(cols) if cols else numeric_columns(df, exclude=by)
    return df.groupBy(*by).agg(*[F.avg(c).alias(f"mean_{c}") for c in cols])


def calendar_profile(df: DataFrame, by: Sequence[str] = ("dayofweek", "hour"),
                     value: str = "meter_reading", time_col: str = "timestamp",
                     keys: Sequence[str] = ()) -> DataFrame:
    """Mean of ``value`` per calendar slot (hour, or weekday and hour)."""
    parts = {"dayofweek": F.weekday(F.col(time_col)), "hour": F.hour(F.col(time_col)),
             "month": F.month(F.col(time_col)), "dayofyear": F.dayofyear(F.col(time_col))}
    grp = list(keys) + [parts[b].alias(b) if b in parts and b not in df.columns else F.col(b)
                        for b in by]
    return df.groupBy(*grp).agg(F.avg(value).alias(f"mean_{value}"))


def pivot_mean(df: DataFrame, idx: str | Sequence[str], col: str, val: str,
               values: Sequence) -> DataFrame:
    """idx x col matrix of mean(val); explicit ``values`` (no extra job)."""
    idx = [idx] if isinstance(idx, str) else list(idx)
    p = df.groupBy(*idx).pivot(col, list(values)).agg(F.avg(val))
    return p.withColumnsRenamed({str(v): f"{col}_{v}" for v in values})


def pivot_count(df: DataFrame, idx: str, col: str, values: Sequence | None = None, max_categories: int = 1000) -> DataFrame:
    """idx x col count matrix with 0 for empty cells.  Categories are listed if not given, at most ``max_categories``
    (one column each); more are an error."""
    if values is None:
        from wattlake.operators.encoders import category_list
        values = category_list(df, col, max_categories)
    p = df.groupBy(idx).pivot(col, list(values)).agg(F.count(F.lit(1)))
    return p.na.fill(0, subset=[str(v) for v in values])


def presence_times(df: DataFrame, meter_col: str = "meter", time_col: str = "timestamp") -> DataFrame:
    """(meter, timestamp, pos): the timestamps of each meter type, numbered from 0 in time order."""
    return numbered(df.select(meter_col, time_col).distinct(), [meter_col], [time_col])


def presence_runs(df: DataFrame, times: DataFrame | None = None, building_col: str = "building_id",
                  meter_col: str = "meter", time_col: str = "timestamp", value_col: str = "meter_reading") -> DataFrame:
    """Gaps and islands of every building and meter type: (building, meter, presence, first, last, hours).

    A run is a stretch of the meter's timestamps (``times``, see ``presence_times``) with the same sign of the
    building's reading, or without one (presence NULL); ``first`` and ``last`` are their numbers.  Every building has
    runs for every meter type, covering all its timestamps.  A timestamp with several readings takes the sign of the
    largest; a NULL reading is none.

    Size: the runs, not buildings x timestamps.  The windows are over one building and meter type."""
    times = presence_times(df, meter_col, time_col) if times is None else times
    key = [building_col, meter_col]
    cells = (df.groupBy(*key, time_col).agg(F.signum(F.max(value_col)).cast("int").alias("presence"))
             .where(F.col("presence").isNotNull()).join(times, [meter_col, time_col]))
    # consecutive numbers of equal presence have the same difference to their own count
    own = Window.partitionBy(*key, "presence").orderBy("pos")
    runs = (cells.withColumn("__island", F.col("pos") - F.row_number().over(own))
            .groupBy(*key, "presence", "__island").agg(F.min("pos").alias("first"), F.max("pos").alias("last")))
    # one row per meter type
    sizes = times.groupBy(meter_col).agg(F.count(F.lit(1)).alias("__n"))
    meters = sizes.agg(F.collect_list(F.struct(F.col(meter_col), F.col("__n")))).scalar()
    pairs = (df.select(building_col).distinct().select(building_col, F.explode(meters).alias("__m"))
             .select(building_col, F.col(f"__m.{meter_col}").alias(meter_col), F.col("__m.__n").alias("__n")))
    every = pairs.join(runs, key, "left")
    w = Window.partitionBy(*key).orderBy("first")
    every = every.withColumns({"__next": F.lead("first").over(w), "__nth": F.row_number().over(w)})

    def run(presence, first, last):
        return F.struct(presence.cast("int").alias("presence"), first.cast("long").alias("first"), last.cast("long").alias("last"))

    null = F.lit(None)
    some = F.col("first").isNotNull()
    parts = F.array(
        F.when(some, run(F.col("presence"), F.col("first"), F.col("last"))),
        F.when(some & (F.col("__nth") == 1), run(null, F.lit(0), F.col("first") - 1)),
        F.when(some, run(null, F.col("last") + 1, F.coalesce("__next", "__n") - 1)).otherwise(run(null, F.lit(0), F.col("__n") - 1)))
    return (every.select(*key, F.explode(F.filter(parts, lambda r: r.isNotNull() & (r["first"] <= r["last"]))).alias("__r"))
            .select(*key, "__r.presence", "__r.first", "__r.last", (F.col("__r.last") - F.col("__r.first") + 1).alias("hours")))


def presence_map(df: DataFrame, meter: int | None = None, building_col: str = "building_id",
                 meter_col: str = "meter", time_col: str = "timestamp",
                 value_col: str = "meter_reading") -> DataFrame:
    """Long-form map (building, meter, timestamp, presence): sign of the reading (NULL = no reading), for every building
    and every timestamp of each meter type (or of one).  The runs of ``presence_runs``, expanded."""
    times = presence_times(df, meter_col, time_col)
    runs = presence_runs(df, times, building_col, meter_col, time_col, value_col)
    if meter is not None:
        runs = runs.where(F.col(meter_col) == meter)
    cells = runs.select(building_col, meter_col, "presence", F.explode(F.sequence("first", "last")).alias("pos"))
    return cells.join(times, [meter_col, "pos"]).select(building_col, meter_col, time_col, "presence")


def resample_mean(df: DataFrame, freq: str, keys: Sequence[str], value: str, start, end,
                  time_col: str = "timestamp") -> DataFrame:
    """Mean of ``value`` per key and day or month over [start, end]; periods
    without data are NULL.  Months are labelled by their last day."""
    import datetime as dt
    keys = list(keys)
    d0 = start.date() if isinstance(start, dt.datetime) else start
    d1 = end.date() if isinstance(end, dt.datetime) else end
    day = F.to_date(F.col(time_col))
    if freq == "day":
        label = day
        periods = F.sequence(F.lit(d0), F.lit(d1), F.expr("INTERVAL 1 DAY"))
    elif freq == "month":
        label = F.last_day(day)
        periods = F.transform(F.sequence(F.trunc(F.lit(d0), "month"), F.trunc(F.lit(d1), "month"),
                                         F.expr("INTERVAL 1 MONTH")), lambda x: F.last_day(x))
    else:
        raise ValueError(freq)
    means = (df.where(F.col(time_col).between(F.lit(d0).cast("timestamp_ntz"),
                                              F.lit(d1 + dt.timedelta(days=1)).cast("timestamp_ntz")
                                              - F.expr("INTERVAL 1 MICROSECOND")))
             .groupBy(*keys, label.alias("period")).agg(F.avg(value).alias(f"mean_{value}")))
    grid = df.select(*keys).distinct().select(*keys, F.explode(periods).alias("period"))
    out = grid.join(means, keys + ["period"], "left")
    return out.withColumn("period", F.col("period").cast("timestamp_ntz"))


# ---------------------------------------------------------------------------
# outliers, categories, histograms

def outlier_thresholds(df: DataFrame, col: str, stat: str = "std", mult: float = 3,
                       method: str = "exact") -> DataFrame:
    """One row (lower, upper): mean ± mult·std, or q25 - mult·IQR / q75 + mult·IQR."""
    if stat == "std":
        a = df.agg(F.avg(col).alias("m"), F.stddev_samp(col).alias("s"))
        return a.select((F.col("m") - F.col("s") * mult).alias("lower"),
                        (F.col("m") + F.col("s") * mult).alias("upper"))
    if stat == "iqr":
        if method == "exact":
            a = df.sparkSession.range(1).select(
                F.array(*[F.lit(v).cast("double") for v in radix_quantiles(df, [col], (0.25, 0.75))[col]]).alias("q"))
        else:
            a = df.agg(quantile_exprs(col, (0.25, 0.75), method).alias("q"))
        q25, q75 = F.col("q")[0], F.col("q")[1]
        return a.select((q25 - (q75 - q25) * mult).alias("lower"),
                        (q75 + (q75 - q25) * mult).alias("upper"))
    raise ValueError(stat)


def outlier_rate(df: DataFrame, col: str, upper: Column | float) -> DataFrame:
    """Count and percent (2 decimals) of rows above ``upper``."""
    return df.agg(F.count_if(F.col(col) > upper).alias("outliers"), F.count("*").alias("total")) \
        .withColumn("pct", F.round(F.try_divide(F.col("outliers") * 100.0, F.col("total")), 2))


def value_counts(df: DataFrame, col: str, tol: float = 0.05) -> DataFrame:
    """Frequency per category with share of all rows and a rare flag (share < tol)."""
    total = df.select(F.count("*")).scalar()
    return (df.groupBy(col).count()
            .withColumn("share", F.col("count") / total)
            .withColumn("rare", F.col("share") < tol)
            .orderBy(F.desc("count"), F.col(col)))


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).distinct()


def histogram(df: DataFrame, col: str, bins: int = 10) -> DataFrame:
    """Equal-width bins between min and max (last bin closed), all bins
    present: (bin, lower, upper, count)."""
    c = F.col(col)
    b = df.agg(_dbl(F.min(c)).alias("lo"), _dbl(F.max(c)).alias("hi"))
    lohi = b.select(F.struct("lo", "hi")).scalar()
    lo, hi = lohi["lo"], lohi["hi"]
    width = (hi - lo) / F.lit(float(bins))
    idx = F.least(F.floor(F.try_divide(c - lo, width)), F.lit(bins - 1)).cast("int")
    counts = (df.where(c.isNotNull()).select(F.coalesce(idx, F.lit(0)).alias("bin"))
              .groupBy("bin").agg(F.count("*").alias("count")))
    edges = (b.select(F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"), "lo", "hi")
             .select("bin", (F.col("lo") + F.col("bin") * (F.col("hi") - F.col("lo")) / bins).alias("lower"),
                     (F.col("lo") + (F.col("bin") + 1) * (F.col("hi") - F.col("lo")) / bins).alias("upper")))
    return (edges.join(counts, "bin", "left")
            .select("bin", "lower", "upper", F.coalesce("count", F.lit(0)).alias("count")))


# ---------------------------------------------------------------------------
# feature-level checks

def variance_flags(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    cols = list(cols) if cols else numeric_columns(df)
    agg = df.agg(*[F.var_samp(c).alias(f"v{i}") for i, c in enumerate(cols)])
    structs = [F.struct(F.lit(c).alias("column"), F.col(f"v{i}").alias("variance"),
                        (F.col(f"v{i}") == 0).alias("constant"),
                        (F.col(f"v{i}") < 0.01).alias("quasiconstant"))
               for i, c in enumerate(cols)]
    return _long(agg, structs)


def duplicate_features(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """For every column pair (schema order), whether the two columns are
    equal on all rows (NULL equals NULL, types must match).

    One aggregate with a fingerprint per column, not per pair: the sum, in any order, of a hash of each row's
    content and the column's value.  Equal columns have equal sums; only pairs with equal sums are then compared row by
    row, in a second aggregate."""
    cols = list(cols) if cols else df.columns
    types = {f.name: f.dataType for f in df.schema.fields}
    row = df.withColumn("__row", F.xxhash64(*[F.col(c) for c in cols]))
    number = "decimal(20,0)"  # sums of 64-bit hashes: no overflow
    prints = row.agg(*[F.sum(F.xxhash64("__row", F.col(c).isNull(), c).cast(number)).alias(f"f{i}") for i, c in enumerate(cols)]).first()
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    place = {c: i for i, c in enumerate(cols)}
    maybe = [(a, b) for a, b in pairs if types[a] == types[b] and prints[place[a]] == prints[place[b]]]
    same = df.agg(*[F.bool_and(F.col(a).eqNullSafe(F.col(b))).alias(f"p{i}") for i, (a, b) in enumerate(maybe)]).first() if maybe else []
    equal = {p for p, ok in zip(maybe, same) if ok is not False}
    return df.sparkSession.createDataFrame([(a, b, (a, b) in equal) for a, b in pairs], "col1 string, col2 string, equal boolean")


def pair_corr(a: str, b: str) -> Column:
    """Pearson correlation over the rows with both values: NaN if one of the two is constant there, NULL without rows.

    ``F.corr`` divides by the spread and fails on a constant column under ANSI.  Constant is min = max: the moments of
    a constant can miss zero by the last digit once partial averages are merged."""
    both = F.col(a).isNotNull() & F.col(b).isNotNull()
    x, y = F.when(both, _dbl(F.col(a))), F.when(both, _dbl(F.col(b)))
    constant = (F.min(x) == F.max(x)) | (F.min(y) == F.max(y))
    spread = F.stddev_pop(x) * F.stddev_pop(y)
    return (F.when(constant, F.lit(float("nan")))
            .when(F.count(x) > 0, F.coalesce(F.try_divide(F.covar_pop(x, y), spread), F.lit(float("nan")))))


def correlation_matrix(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Pearson correlation of every column pair, pairwise-complete (rows
    with a NULL in either column are skipped for that pair).  Long form
    (col1, col2, corr) with i <= j in schema order; one aggregate."""
    cols = list(cols) if cols else numeric_columns(df)
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    agg = df.agg(*[(F.lit(1.0) if a == b else pair_corr(a, b)).alias(f"p{i}")
                   for i, (a, b) in enumerate(pairs)])
    return _long(agg, [F.struct(F.lit(a).alias("col1"), F.lit(b).alias("col2"),
                                F.col(f"p{i}").alias("corr"))
                       for i, (a, b) in enumerate(pairs)])


def correlated_features(corr_long: DataFrame, threshold: float) -> DataFrame:
    """Pairs (first column before second) with corr >= threshold (signed)."""
    return corr_long.where((F.col("col1") != F.col("col2")) & (F.col("corr") >= threshold))


def target_correlation(df: DataFrame, target: str, cols: Sequence[str] | None = None,
                       threshold: float | None = 0.1) -> DataFrame:
    cols = list(cols) if cols else numeric_columns(df, exclude=[target])
    agg = df.agg(*[pair_corr(c, target).alias(f"c{i}") for i, c in enumerate(cols)])
    out = _long(agg, [F.struct(F.lit(c).alias("feature"), F.col(f"c{i}").alias("corr"))
                      for i, c in enumerate(cols)])
    return out if threshold is None else out.where(F.col("corr") > threshold)


def time_bounds(df: DataFrame, time_col: str = "timestamp") -> DataFrame:
    return df.agg(F.min(time_col).alias("start"), F.max(time_col).alias("end"))


def filter_selections(df: DataFrame, feats: Sequence[str], target: str, var_min: float = 0.01,
                      target_corr_min: float = 0.1, pair_corr_max: float = 0.8) -> DataFrame:
    """Three filter-style feature selections from ONE aggregate over ``df``:
    'variance' (sample variance >= var_min), 'target_corr' (correlation with
    the target > target_corr_min) and 'uncorrelated' (not the later column of
    a pair with correlation >= pair_corr_max).  Long form (method, feature)."""
    feats = list(feats)
    aggs = [F.var_samp(F.col(c).cast("double")).alias(f"v{i}") for i, c in enumerate(feats)]
    aggs += [pair_corr(c, target).alias(f"t{i}") for i, c in enumerate(feats)]
    pairs = [(i, j) for i in range(len(feats)) for j in range(i + 1, len(feats))]
    aggs += [pair_corr(feats[i], feats[j]).alias(f"p{i}_{j}") for i, j in pairs]
    one = df.agg(*aggs)
    structs = []
    for j, c in enumerate(feats):
        shadowed = [F.coalesce(F.col(f"p{i}_{j}") >= pair_corr_max, F.lit(False)) for i in range(j)]
        corr_hit = F.lit(False)
        for e in shadowed:
            corr_hit = corr_hit | e
        structs += [
            F.struct(F.lit("variance").alias("method"), F.lit(c).alias("feature"),
                     F.coalesce(F.col(f"v{j}") >= var_min, F.lit(False)).alias("ok")),
            F.struct(F.lit("target_corr").alias("method"), F.lit(c).alias("feature"),
                     F.coalesce(F.col(f"t{j}") > target_corr_min, F.lit(False)).alias("ok")),
            F.struct(F.lit("uncorrelated").alias("method"), F.lit(c).alias("feature"), (~corr_hit).alias("ok")),
        ]
    return one.select(F.inline(F.array(*structs))).where("ok").drop("ok")
