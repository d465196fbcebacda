"""File sources and sinks, schema narrowing and projections.

Written tables go to a folder under the cluster's shared checkpoint
directory (``wattlake.session.scratch_dir``), never a machine-local path.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TS_FORMAT = "yyyy-MM-dd HH:mm:ss"


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str,
             ts_format: str = TS_FORMAT) -> DataFrame:
    """CSV with header and a declared schema (no inference pass); timestamp
    columns parse as timestamp_ntz."""
    return (spark.read.schema(schema).option("header", True)
            .option("timestampNTZFormat", ts_format).option("mode", "FAILFAST").csv(path))


def write_csv(df: DataFrame, path: str, ts_format: str = TS_FORMAT, mode: str = "overwrite") -> str:
    (df.write.mode(mode).option("header", True).option("timestampNTZFormat", ts_format).csv(path))
    return path


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_table(df: DataFrame, path: str, by: Sequence[str] | None = None,
                mode: str = "overwrite") -> str:
    """Parquet; ``by`` writes one folder per value (readers prune partitions)."""
    w = df.write.mode(mode)
    if by:
        w = w.partitionBy(*by)
    w.parquet(path)
    return path


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return (spark.read.schema(schema).option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss[.SSS]")
            .json(path))


def read_json_columns(payloads: DataFrame, schema: T.StructType, payload_col: str = "payload",
                      key_cols: Sequence[str] = ()) -> DataFrame:
    """Parse column-oriented JSON documents ``{"col": {"row": value, ...}, ...}``
    (one document per input row) into rows.  Timestamps may be epoch
    milliseconds or ISO strings.  Each document is parsed independently, so
    many documents parse in parallel."""
    fields = schema.fields
    as_maps = T.StructType([T.StructField(f.name, T.MapType(T.StringType(), T.StringType()))
                            for f in fields])
    parsed = payloads.select(*key_cols, F.from_json(F.col(payload_col), as_maps).alias("__d"))
    none = F.array().cast("array<string>")
    # a row key may be absent from any column: take the keys of all of them
    keys = F.array_distinct(F.flatten(F.array(*(F.coalesce(F.map_keys(F.col("__d")[f.name]), none) for f in fields))))
    rows = parsed.select(*key_cols, F.explode(keys).alias("__row"), "__d")

    def conv(f: T.StructField):
        raw = F.col("__d")[f.name][F.col("__row")]
        if isinstance(f.dataType, (T.TimestampNTZType, T.TimestampType)):
            ms = raw.try_cast("bigint")
            # epoch milliseconds of a naive wall time: epoch + interval, no zone
            epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
            from_ms = epoch + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0),
                                                 (ms / F.lit(1000)).cast("decimal(18,6)"))
            parsed_ts = F.when(ms.isNotNull(), from_ms).otherwise(F.to_timestamp_ntz(raw))
            return parsed_ts.cast(f.dataType).alias(f.name)
        return raw.cast(f.dataType).alias(f.name)

    return rows.select(*key_cols, F.col("__row").cast("bigint").alias("row_key"),
                       *[conv(f) for f in fields])


def to_json_columns(df: DataFrame, group_cols: Sequence[str], order_col: str,
                    cols: Sequence[str]) -> DataFrame:
    """Build one column-oriented JSON document per group (the inverse of
    ``read_json_columns``); row keys are positions within the group.  Use
    groups of bounded size (e.g. one site-day)."""
    from pyspark.sql import Window
    pos = F.row_number().over(Window.partitionBy(*group_cols).orderBy(order_col)) - 1
    d = df.withColumn("__row", pos.cast("string"))
    maps = []
    for c in cols:
        v = F.col(c)
        if isinstance(df.schema[c].dataType, (T.TimestampNTZType, T.TimestampType)):
            v = F.date_format(v, "yyyy-MM-dd'T'HH:mm:ss")
        maps.append(F.map_from_entries(F.collect_list(F.struct(F.col("__row"), v.cast("string"))))
                    .alias(c))
    return (d.groupBy(*group_cols).agg(*maps)
            .select(*group_cols, F.to_json(F.struct(*cols)).alias("payload")))


def verify_written(df: DataFrame, written: DataFrame) -> DataFrame:
    """One-row report comparing a written table with its source:
    rows_written, rows_read, missing (source rows not read back) and extra.
    Set differences are ``exceptAll`` (multiset, shuffled on all columns);
    each figure enters as a scalar subquery."""
    cols = df.columns
    a = df.select(*cols)
    b = written.select(*cols)

    def n(x: DataFrame):
        return x.select(F.count("*")).scalar()

    return (a.agg(F.count("*").alias("rows_written"))
            .select("rows_written", n(b).alias("rows_read"), n(a.exceptAll(b)).alias("missing"),
                    n(b.exceptAll(a)).alias("extra")))


# ---------------------------------------------------------------------------
# types and projections

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def narrow_types(df: DataFrame) -> DataFrame:
    """Shrink integral columns by their observed range (one aggregate for
    all columns) and doubles to float.  Spark has no unsigned types: a
    range that fits uint8 becomes smallint, uint16 -> int, uint32 -> bigint;
    columns with negatives keep their type."""
    ints = [f.name for f in df.schema.fields if isinstance(f.dataType, _INTEGRAL)]
    target: dict[str, str] = {}
    if ints:
        r = df.agg(*[F.min(c).alias(f"lo{i}") for i, c in enumerate(ints)],
                   *[F.max(c).alias(f"hi{i}") for i, c in enumerate(ints)]).first()
        for i, c in enumerate(ints):
            lo, hi = r[f"lo{i}"], r[f"hi{i}"]
            if lo is None or lo < 0:
                continue
            if hi < 2 ** 8:
                target[c] = "smallint"
            elif hi < 2 ** 16:
                target[c] = "int"
            elif hi < 2 ** 32:
                target[c] = "bigint"
    for f in df.schema.fields:
        if isinstance(f.dataType, T.DoubleType):
            target[f.name] = "float"
    return df.select(*[F.col(c).cast(target[c]).alias(c) if c in target else F.col(c) for c in df.columns])


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast named columns; floating -> integral truncates toward zero."""
    return df.withColumns({c: F.col(c).cast(t) for c, t in types.items()})


def rename_columns(df: DataFrame, names: Mapping[str, str] | Sequence[str] | None = None,
                   prefix: str | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """Mapped renames, positional renames (a full list) or a prefix on every
    column not in ``keep``."""
    if isinstance(names, Mapping):
        df = df.withColumnsRenamed(dict(names))
    elif names is not None:
        df = df.toDF(*names)
    if prefix:
        df = df.withColumnsRenamed({c: f"{prefix}{c}" for c in df.columns if c not in keep})
    return df


def select_features(df: DataFrame, feats: Sequence[str]) -> DataFrame:
    missing = [c for c in feats if c not in df.columns]
    if missing:
        raise ValueError(f"missing feature columns: {missing}")
    return df.select(*feats)


def drop_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.drop(*cols)
