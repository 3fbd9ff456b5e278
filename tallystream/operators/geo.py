"""Address to country.

Ranges are disjoint rows (lo_ip, hi_ip, country struct<name, iso_code>,
country_name, country_code). Each is cut once into the network blocks it consists of: prefixes
of whole hex digits, at most 30 for each digit in which its ends differ. An address is then
looked up by equality with its own prefixes, so it meets no range that does not hold it. Only prefixes
as long as some block's are asked for: what all addresses begin with is no key, unless a range holds them all.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallystream.functions.network import ip_key
from tallystream.session import scratch_path

KEY_DIGITS = 32
HEX = "0123456789abcdef"


def normalise_country(ranges: DataFrame) -> DataFrame:
    """Nested record first, flat columns as fallback; names trimmed, codes upper-cased."""

    def first_filled(*parts: Column) -> Column:
        return F.coalesce(*[F.nullif(F.trim(p), F.lit("")) for p in parts])

    return ranges.select(
        "lo_ip",
        "hi_ip",
        first_filled(F.col("country.name"), F.col("country_name")).alias("geo_name"),
        F.upper(first_filled(F.col("country.iso_code"), F.col("country_code"))).alias("geo_code"),
    ).where("geo_name is not null or geo_code is not null")


def _digit(key: Column, place: Column) -> Column:
    return F.instr(F.lit(HEX), F.substring(key, place, F.lit(1))) - 1


def _head(key: Column, length: Column) -> Column:
    return F.substring(key, F.lit(1), length)


def network_blocks(lo: Column, hi: Column) -> Column:
    """Prefixes whose blocks together are [lo, hi]; both 32 hex digits, lo not above hi."""
    places = F.sequence(F.lit(1), F.lit(KEY_DIGITS))
    digits = F.sequence(F.lit(0), F.lit(15))
    shared = F.size(F.filter(places, lambda i: _head(lo, i) == _head(hi, i)))
    # Zeros at the end of lo, and f at the end of hi, need no digits of their own.
    low, high = F.length(F.regexp_replace(lo, "0+$", "")), F.length(F.regexp_replace(hi, "f+$", ""))
    whole = F.greatest(low, high)
    hexed = lambda d: F.substring(F.lit(HEX), d + 1, F.lit(1))

    def beside(key: Column, last: Column, fits) -> Column:
        """The block at the end itself, and those on its inner side, digit by digit."""
        last = F.greatest(last, shared + 1)
        inner = F.filter(places, lambda i: (i > shared + 1) & (i <= last))
        steps = F.transform(inner, lambda i: F.transform(
            F.filter(digits, lambda d: fits(d, _digit(key, i))), lambda d: F.concat(_head(key, i - 1), hexed(d))))
        return F.concat(F.array(_head(key, last)), F.flatten(steps))

    between = F.transform(
        F.filter(digits, lambda d: (d > _digit(lo, shared + 1)) & (d < _digit(hi, shared + 1))),
        lambda d: F.concat(_head(lo, shared), hexed(d)))
    several = F.concat(beside(lo, low, lambda d, own: d > own), between, beside(hi, high, lambda d, own: d < own))
    return F.when(whole <= shared, F.array(_head(lo, whole))).when(lo < hi, several)


def network_table(ranges: DataFrame) -> DataFrame:
    """prefix, geo_name and geo_code of every block; worth writing once for many lookups.

    Cutting costs far more than reading, and a file of all ranges is one task's, so ranges are dealt out first.
    The outer form, since for the plain one the optimizer adds a check of the blocks below, which would
    parse both ends once more for every digit that is looked at.
    """
    keyed = normalise_country(ranges).select(
        ip_key(F.col("lo_ip")).alias("lo"), ip_key(F.col("hi_ip")).alias("hi"), "geo_name", "geo_code")
    dealt = keyed.repartition(int(ranges.sparkSession.conf.get("spark.sql.shuffle.partitions")), "lo", "hi")
    blocks = F.explode_outer(network_blocks(F.col("lo"), F.col("hi")))
    return dealt.select(blocks.alias("prefix"), "geo_name", "geo_code").where(F.col("prefix").isNotNull())


@dataclass(frozen=True)
class Networks:
    """A written table of blocks (prefix, geo_name, geo_code), and the lengths that its prefixes have."""

    blocks: DataFrame
    lengths: list[int]


def keep_networks(ranges: DataFrame, path: str) -> Networks:
    """Cut the ranges into blocks and write them to `path`, a folder all executors share."""
    network_table(ranges).write.mode("overwrite").parquet(path)
    blocks = ranges.sparkSession.read.schema("prefix string, geo_name string, geo_code string").parquet(path)
    # At most one row for each of 33 lengths.
    found = blocks.select(F.length("prefix").alias("n")).distinct().collect()
    return Networks(blocks, sorted(r.n for r in found if r.n is not None))


def with_country(
    rows: DataFrame, ranges: DataFrame | Networks, ip: str = "client_ip", addresses: DataFrame | None = None
) -> DataFrame:
    """Add geo_name and geo_code for the range holding `ip`; NULL when none does. Every address
    is looked up once, however many rows it has, by its prefixes of the lengths that blocks have; of nested
    ranges the narrowest block counts. Ranges that are looked up often are worth keeping as Networks.

    The addresses are taken from `rows`, which is read twice for that, or from the column `ip` of `addresses`,
    which holds all addresses of `rows` and may be cheaper."""
    if isinstance(ranges, DataFrame):
        ranges = keep_networks(ranges, scratch_path(rows.sparkSession, "networks"))
    # No test for NULL keys, here or by the last join: it would be pushed below the parsing of
    # addresses and done for every row beneath. NULL keys have no prefixes and so find nothing.
    asked = (rows if addresses is None else addresses).select(ip_key(F.col(ip)).alias("_key")).distinct()
    lengths = F.array(*[F.lit(n) for n in ranges.lengths]) if ranges.lengths else F.array().cast("array<int>")
    asked = asked.select("_key", F.explode_outer(F.transform(lengths, lambda n: _head(F.col("_key"), n))).alias("prefix"))
    # Rows without a key find nothing wherever they go, so they are dealt out rather than left to one task.
    spread = F.concat(F.lit("none "), F.pmod(F.xxhash64(*[c for c, kind in rows.dtypes if kind == "string"]), F.lit(4096)).cast("string"))
    rows = rows.withColumn("_key", F.coalesce(ip_key(F.col(ip)), spread))
    found = asked.join(ranges.blocks, "prefix").groupBy("_key").agg(
        F.max_by(F.struct("geo_name", "geo_code"), F.length("prefix")).alias("_found"))
    found = found.withColumnRenamed("_key", "_of")
    joined = rows.join(found, rows["_key"].eqNullSafe(found["_of"]), "left")
    return joined.withColumns({"geo_name": F.col("_found.geo_name"), "geo_code": F.col("_found.geo_code")}).drop("_key", "_of", "_found")
