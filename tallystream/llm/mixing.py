"""Mixing sources to target weights by Efraimidis-Spirakis sampling without replacement.

Every source gets a target of words. Whole epochs come first: as many times as the target
holds the source's size, every document is taken. For the rest, each document draws an
exponential key, divided by its quality weight; keys are sorted within the source, sizes are
prefix-summed in that order, and a document is taken if the middle of its span lies below the
rest, so a source misses its target by half a document at most. Decisions reach the documents
as one border (the last key taken) a source, so no text is shuffled.

The prefix sum runs over buckets of a source's keys, summed in parallel: buckets below the one
that holds the border are taken whole, those above are not, and only the border bucket is
sorted. Each doubling of the key has `BUCKETS` buckets. Keys of one weight spread over them so that
none has more than 0.37 ln 2 / `BUCKETS`, a twentieth of a percent, of their source, whatever the weight is;
and a source has some ten thousand buckets, however many rows. A source with a third of all
rows thus costs what others cost.

Cases: a NULL text has size 0; NULL sources are a source of their own, the last; documents of
size 0 are taken with their bucket but add nothing; a NULL doc_id draws like any other; equal
rows draw equal keys and are taken together; without any words all targets are 0; an
empty table gives an empty table; other columns are kept, those with the names of the outputs
are replaced. Draws depend on seed, doc_id and text only, so reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallystream.llm.shared_files import join

WEIGHTS = (5, 2, 1)
SHARE_PERCENT = 150
MOST_EPOCHS = 2
BUCKETS = 1 << 9
SEED = "mix"
# The words of the contract.
WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"

OUTPUT = ["size", "source_size", "target", "taken", "epochs"]


def quality_weight(text: Column) -> Column:
    """1 for text without symbols, less the more symbols a word carries."""
    return 1 / (1 + F.regexp_count(text, F.lit(SYMBOLS)) / F.greatest(F.lit(1), F.regexp_count(text, F.lit(WORD))))


def uniform(doc_id: Column, text: Column, seed: str) -> Column:
    """A number in (0, 1) from the first 52 bits of a digest."""
    name = F.concat_ws("|", F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit("null")), F.md5(text))
    return (F.conv(F.substring(F.md5(name), 1, 13), 16, 10).cast("long") + 0.5) / F.lit(float(1 << 52))


def targets(sizes: DataFrame, weights=WEIGHTS, share_percent: int = SHARE_PERCENT,
            most: int = MOST_EPOCHS) -> DataFrame:
    """Target of each source (source, source_size): shares by weight, none above `most` times
    its size, the excess shared out anew. Sources fill up in the order of size to weight."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    place = F.row_number().over(by_name) - 1
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(place, F.lit(len(weights))))
    df = sizes.withColumn("weight", weight)
    everything = Window.partitionBy()
    fills = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    earlier = fills.rowsBetween(Window.unboundedPreceding, -1)
    df = df.withColumns({
        "budget": F.sum("source_size").over(everything) * F.lit(share_percent / 100),
        "before": F.coalesce(F.sum("source_size").over(earlier), F.lit(0)),
        "weights": F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(earlier), F.lit(0.0)),
    })
    # Sources that fill up come first in this order; from the first that doesn't, all share.
    level = (F.col("budget") - most * F.col("before")) / F.col("weights")
    open_ = F.col("weight") * level < most * F.col("source_size")
    df = df.withColumns({"level": level, "open": open_})
    shared = F.min(F.when(F.col("open"), F.struct(F.col("before"), F.col("level")))).over(everything)["level"]
    full = (most * F.col("source_size")).cast("double")
    share = F.col("weight") * shared
    target = F.when(shared.isNull() | (share >= full), full).otherwise(share)
    return df.select("source", "source_size", target.alias("target"))


def source_of(docs: DataFrame) -> Column:
    return docs["source"].cast("string")


def draws(docs: DataFrame, weight: Column | None, seed: str) -> dict[str, Column]:
    """Size, key and tie-breakers of a document."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    weight = quality_weight(text) if weight is None else weight
    return {
        "size": F.regexp_count(text, F.lit(WORD)).cast("long"),
        "_key": -F.ln(uniform(F.col("doc_id"), text, seed)) / weight,
        "_id": F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))),
        "_hash": F.xxhash64(text),
    }


def borders(docs: DataFrame, scratch: str, weight: Column | None, seed: str) -> DataFrame:
    """One row a source: of, source_size, target, whole epochs, and the last (key, id, hash)
    that the fractional part takes, NULL if it takes none."""
    spark = docs.sparkSession
    own = draws(docs, weight, seed)
    rows = docs.select(source_of(docs).alias("of"), *[c.alias(n) for n, c in own.items()])
    # By the key's order of magnitude, which follows small and large weights alike.
    bucket = F.floor(F.log2(F.greatest("_key", F.lit(1e-300))) * BUCKETS).cast("int")
    rows.withColumn("bucket", bucket).write.parquet(join(scratch, "draws"))
    rows = spark.read.parquet(join(scratch, "draws"))

    # Equal rows of equal key are one unit.
    units = rows.groupBy("of", "bucket", "_key", "_id", "_hash").agg(F.sum("size").alias("size"))
    buckets = rows.groupBy("of", "bucket").agg(
        F.sum("size").alias("in_bucket"), F.max(F.struct("_key", "_id", "_hash")).alias("last_in_bucket"))
    goal = targets(rows.groupBy(F.col("of").alias("source")).agg(F.sum("size").alias("source_size")))
    size = F.col("source_size")
    goal = goal.withColumn("whole", F.when(size > 0, F.floor(F.col("target") / size)).otherwise(0).cast("int"))
    goal = goal.withColumn("rest", F.col("target") - F.col("whole") * size)

    running = Window.partitionBy("of").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = buckets.withColumn("before", F.coalesce(F.sum("in_bucket").over(running), F.lit(0)))
    buckets = buckets.join(goal, buckets["of"].eqNullSafe(goal["source"])).where("before < rest")
    whole = (F.col("before") + F.col("in_bucket")) <= F.col("rest")
    below = buckets.where(whole).select("of", F.col("last_in_bucket").alias("last"))
    cut = buckets.where(~whole).select(F.col("of").alias("_of"), F.col("bucket").alias("_bucket"), "before", "rest")
    order = Window.partitionBy("of", "bucket").orderBy("_key", "_id", "_hash")
    inside = units.join(cut, units["of"].eqNullSafe(cut["_of"]) & (units["bucket"] == cut["_bucket"]))
    middle = F.col("before") + F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size") / 2
    inside = inside.withColumn("middle", middle).where("middle < rest").select(
        "of", F.struct("_key", "_id", "_hash").alias("last"))
    last = below.unionByName(inside).groupBy("of").agg(F.max("last").alias("last"))
    return goal.join(last, goal["source"].eqNullSafe(last["of"]), "left").select(
        F.col("source").alias("_source"), "source_size", "target", "whole", "last")


def mix(docs: DataFrame, scratch: str, weight: Column | None = None, seed: str = SEED) -> DataFrame:
    """Add size, source_size, target, epochs (times a document is taken) and taken (words).
    weight: a quality weight above 0. scratch: a folder all executors share, not used before."""
    docs = docs.select(*[c for c in docs.columns if c not in OUTPUT])
    names = docs.columns
    border = borders(docs, scratch, weight, seed)
    border.write.parquet(join(scratch, "borders"))
    border = docs.sparkSession.read.parquet(join(scratch, "borders"))
    df = docs.join(border, source_of(docs).eqNullSafe(border["_source"]), "left")
    df = df.withColumns(draws(df, weight, seed))
    part = F.coalesce(F.struct("_key", "_id", "_hash") <= F.col("last"), F.lit(False)).cast("int")
    df = df.withColumn("epochs", F.col("whole") + part)
    df = df.withColumn("taken", F.col("size") * F.col("epochs"))
    return df.select(*names, *OUTPUT)


# The same in DuckDB, for the checks.
SQL = r"""
with d as (
  select doc_id, source, coalesce(text, '') as text,
    cast(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as bigint) as size,
    len(regexp_extract_all(coalesce(text, ''), '[#*$%&|<>]')) as symbols
  from documents),
k as (
  select *, -ln((cast('0x' || substr(md5('mix|' || coalesce(cast(doc_id as varchar), 'null') || '|' || md5(text)), 1, 13)
    as bigint) + 0.5::double) / 4503599627370496::double) / (1 / (1 + symbols / greatest(1, size)::double)) as key
  from d),
s as (select source, sum(size)::bigint as source_size from k group by source),
w as (
  select *, [5.0::double, 2.0::double, 1.0::double][((row_number() over (order by source nulls last) - 1) % 3 + 1)::bigint] as weight
  from s),
f as (
  select *, sum(source_size) over () * 1.5::double as budget,
    coalesce(sum(source_size) over (order by source_size / weight, source nulls last
      rows between unbounded preceding and 1 preceding), 0)::double as before,
    sum(weight) over () - coalesce(sum(weight) over (order by source_size / weight, source nulls last
      rows between unbounded preceding and 1 preceding), 0) as weights
  from w),
l as (select *, (budget - 2 * before) / weights as level from f),
lv as (select arg_min(level, before) as shared from l where weight * level < 2 * source_size),
t as (
  select source, source_size,
    case when shared is null or weight * shared >= 2 * source_size then 2.0::double * source_size
      else weight * shared end as target
  from l, lv),
g as (
  select *, case when source_size > 0 then floor(target / source_size) else 0 end as whole from t),
c as (
  select k.*, g.source_size, g.target, g.whole, g.target - g.whole * g.source_size as rest,
    sum(size) over (partition by k.source order by key, doc_id rows between unbounded preceding and current row)
      - size / 2::double as middle
  from k join g on k.source is not distinct from g.source)
select doc_id, size, source_size, target,
  cast(size * (whole + case when middle < rest then 1 else 0 end) as bigint) as taken
from c
"""
