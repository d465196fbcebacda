"""Mixing sources to target weights by systematic sampling (operator 4).

*Targets.*  The sources, in code-point order with null last, weigh
``weights[0], weights[1], ...``, repeating, and share the size of all documents.
A source gets at most ``most`` times its own size; what it cannot take goes to
the others by weight, until none is above.  The fixed point is
target = min(most * size, weight * t) with the one t that makes the targets sum
to the total, found by running sums over the sources ordered by size / weight.

*Sampling.*  A source's rate is target / size.  Its documents are ordered by a
size class, then by the md5 of doc_id and of the text; each expects ``rate`` copies.  One random
offset in [0, 1) per source is added to the running sum of expected copies, and
a document is taken once for each integer that its interval crosses: floor(rate)
or ceil(rate) times, at most ``most``.  Ordered by size, the taken size stays
close to the target.

*Scale.*  The running number of a document is its number inside a bucket
(source, size class, first two hex digits) plus the count of the buckets before
it.  A source has at most (square root of the largest size) * 256 buckets, so a
source with a third of all rows is numbered in parallel.

Size: number of words ``[^\\x20\\x09-\\x0D]+`` (null text: 0).  Equal rows get their
numbers in any order among themselves, with the same copies in total.  Null
doc_ids sort as empty strings.  Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattlake.llm import exchange as ex
from wattlake.llm import store as st


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), most: float = 3.0) -> DataFrame:
    """(source, source_size) -> and weight, target.  One row per source."""
    everything = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*(F.lit(float(w)) for w in weights))
    t = sizes.withColumn("weight", F.get(cycle, (F.row_number().over(everything) - 1) % len(weights)))
    t = t.withColumn("cap", F.col("source_size") * F.lit(float(most))).withColumn("ratio", F.col("cap") / F.col("weight"))
    # in order of ratio: the sources before a place are capped there, the others share the rest by weight
    order = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    t = (t.withColumn("total", F.sum("source_size").over(whole))
         .withColumn("caps", F.sum("cap").over(upto) - F.col("cap"))
         .withColumn("rest", F.sum("weight").over(whole) - F.sum("weight").over(upto) + F.col("weight"))
         .withColumn("level", (F.col("total") - F.col("caps")) / F.col("rest")).withColumn("place", F.row_number().over(order)))
    # the first place that stays under its cap sets the level; later places would count caps that are not reached
    t = t.withColumn("t", F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("place", "level"))).over(whole)["level"])
    return t.select("source", "source_size", "weight",
                    F.least(F.col("cap"), F.col("weight") * F.coalesce("t", F.lit(float("inf")))).alias("target"))


def mix(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), most: float = 3.0, seed: int = 1
        ) -> tuple[DataFrame, DataFrame, str]:
    """(rows, plain scan of ``docs``, store); rows: doc_id, source, size, source_size, target, copies, ref of every row
    of ``docs`` (doc_id, text, source)."""
    store = st.new_store(docs.sparkSession, "mixing")
    key = F.concat(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.md5(F.coalesce("text", F.lit(""))))
    scan = st.scanned(docs, store)
    # on a plain scan this id is the partition and the row number in it
    slim = st.saved(scan.select("doc_id", "source", n_words(F.col("text")).alias("size"), key.alias("key"),
                                F.monotonically_increasing_id().alias("ref")), store, "sizes")
    return _numbered(slim, weights, most, seed, store), scan, store


def mixed(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), most: float = 3.0, seed: int = 1) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as it is taken."""
    rows, scan, store = mix(docs, weights, most, seed)
    return ex.with_rows(scan, store, rows.where("copies > 0").select(
        F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("i"), "ref").select("ref"))


def _numbered(slim: DataFrame, weights, most, seed, store: str) -> DataFrame:
    slim = (slim.withColumn("grade", F.floor(F.sqrt("size")).cast("long"))
            .withColumn("part", F.substring("key", 1, 2)))
    buckets = slim.groupBy("source", "grade", "part").agg(F.count("*").alias("n"), F.sum("size").alias("words"))
    buckets = st.saved(buckets, store, "buckets")
    targets = st.saved(source_targets(buckets.groupBy("source").agg(F.sum("words").alias("source_size")), weights, most),
                       store, "targets")
    before = Window.partitionBy("source").orderBy("grade", "part").rowsBetween(Window.unboundedPreceding, -1)
    buckets = buckets.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    offset = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}/"), F.coalesce("source", F.lit("")))), 1, 8), 16, 10).cast(
        "double") / F.lit(float(1 << 32))
    place = Window.partitionBy("source", "grade", "part").orderBy("key")
    b, t = buckets.alias("b"), targets.alias("t")
    out = (slim.withColumn("inside", F.row_number().over(place)).alias("s")
           .join(b, F.expr("s.source <=> b.source and s.grade = b.grade and s.part = b.part"))
           .join(t, F.expr("s.source <=> t.source"))
           .select("s.*", "source_size", "target", (F.col("before") + F.col("inside")).alias("number"))
           .withColumn("rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0))
           .withColumn("offset", offset))
    copies = F.floor(F.col("offset") + F.col("rate") * F.col("number")) - F.floor(
        F.col("offset") + F.col("rate") * (F.col("number") - 1))
    # the running sum is in floating point: an interval of length `most` cannot cross more integers than that
    return out.withColumn("copies", F.least(copies, F.lit(int(most))).cast("long")).drop("offset", "rate", "grade", "part", "inside")


ORACLE = r"""
with d as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size,
    md5(coalesce(doc_id::varchar, '')) || md5(coalesce(text, '')) as key from documents),
s as (
  select source, sum(size)::bigint as source_size,
    [5.0, 2.0, 1.0][1 + (row_number() over (order by source nulls last) - 1) % 3]::double as weight from d group by source),
r as (select *, 3.0::double * source_size as cap, 3.0::double * source_size / weight as ratio from s),
l as (
  select *, (sum(source_size) over () - (sum(cap) over w - cap)) / (sum(weight) over () - sum(weight) over w + weight) as level,
    row_number() over w as place
  from r window w as (order by ratio, source nulls last rows between unbounded preceding and current row)),
t as (
  select source, source_size, least(cap, weight * coalesce(
    arg_min(level, place) filter (where level <= ratio) over (), 'infinity'::double)) as target from l),
n as (
  select d.doc_id, d.size, t.source_size, t.target,
    case when t.source_size > 0 then t.target / t.source_size else 0 end as rate,
    ('0x' || substr(md5('1/' || coalesce(d.source, '')), 1, 8))::bigint / 4294967296.0::double as u,
    row_number() over (partition by d.source order by floor(sqrt(d.size)), d.key) as k
  from d join t on d.source is not distinct from t.source)
select doc_id, size, source_size, target,
  (size * least(floor(u + rate * k) - floor(u + rate * (k - 1)), 3))::bigint as taken,
  least(floor(u + rate * k) - floor(u + rate * (k - 1)), 3)::bigint as copies
from n
"""
