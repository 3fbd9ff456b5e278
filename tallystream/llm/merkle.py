"""Merkle manifest of a document table, with a proof for every row by pointer jumping.

Every row is a leaf; every `RUN` consecutive nodes of a source's tree become one node above, up
to the source's subroot, and the subroots become one root in the same way. A proof of a row is
the siblings of each node on its way to the root: with it and the root alone, the row can be
checked without the other rows.

1. Leaves are hashed where the texts are read; only digests go on. They are placed in order by
   one range exchange, and their positions come from the counts of the partitions, so that a
   source of any size is numbered by many tasks.
2. Levels are built one by one, each from runs of `RUN` digests: the tables shrink by `RUN`.
3. Proofs by pointer jumping: every node starts with its own siblings and a pointer to its
   parent. In each round a node takes over the siblings that the node it points to holds, and
   that node's pointer: the distance doubles, until every leaf points to the root. Nodes on
   levels from which no later jump starts are left out. An ancestor with many nodes below it is
   met by at most `RUN` ** `SALTED` rows in one join group: its row is repeated for the rest.
   The way from a subroot to the root is one row a source and joins the nodes below the subroot
   before the rounds begin.

Rounds grow with the logarithm of the logarithm of the rows; all tables are written to the
shared folder, which cuts lineage.

Cases: NULL fields are hashed as `-`, empty ones as `0:`; rows without a source are a source
of their own, ordered first; NULL ids come first in their source, and rows that share an id
are ordered by their leaves, so that repeated rows have equal leaves and proofs of neighbours; a
lone leaf is its source's subroot, a lone subroot the root, and a proof without siblings is
the hash of nothing; an empty table gives an empty table; other columns are neither hashed nor
carried, unless named in `carried`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallystream.llm.components import written
from tallystream.llm.shared_files import join

RUN = 3
SALTED = 6
LEAF_FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def nothing() -> Column:
    return F.lit(bytearray())


def hex_text(digests: Column) -> Column:
    return F.lower(F.hex(digests))


def hashed(digests: Column) -> Column:
    """Digest, as bytes, of digests laid end to end, each as lowercase hex text."""
    return F.unhex(F.sha2(hex_text(digests), 256))


def leaf(**changed: Column) -> Column:
    """Digest, as bytes, of a document row; `changed` gives other values for some fields."""
    fields = []
    for name in LEAF_FIELDS:
        value = changed.get(name, F.col(name)).cast("string")
        fields.append(F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(value), F.lit(":"), value)))
    return F.unhex(F.sha2(F.concat(*fields), 256))


def placed(rows: DataFrame, order: list[str], scratch: str) -> DataFrame:
    """rows with pos, the place in its tree by `order` from 0, and n, the rows of the tree."""
    keys = ["tree", *order]
    dealt = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    # Numbers are given as the table is written: the partition in the upper bits, the row below.
    dealt = written(dealt.withColumn("_at", F.monotonically_increasing_id()), join(scratch, "in-order"))
    part = F.shiftright("_at", 33)
    spans = dealt.groupBy("tree", part.alias("_part")).agg(F.min("_at").alias("_first"), F.count("*").alias("_rows"))
    tree = Window.partitionBy("tree")
    earlier = tree.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.select("tree", "_part", "_first", F.sum("_rows").over(tree).alias("n"),
                         F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    found = dealt.withColumn("_part", part).join(spans, ["tree", "_part"])
    pos = F.col("_at") - F.col("_first") + F.col("_before")
    return written(found.select(*rows.columns, pos.alias("pos"), "n"), join(scratch, "placed"))


def levels(leaves: DataFrame, scratch: str) -> list[DataFrame]:
    """For each level the runs that its nodes form: tree, up (place of the node above), n (nodes
    of the level), kids (digests in order) and digest (of the node above)."""
    nodes, found = leaves.select("tree", "pos", "n", "digest"), []
    while True:
        kids = F.sort_array(F.collect_list(F.struct("pos", "digest")))["digest"]
        runs = nodes.where("n > 1").groupBy("tree", F.expr(f"pos div {RUN}").alias("up")).agg(
            F.first("n").alias("n"), kids.alias("kids"))
        runs = runs.withColumn("digest", hashed(F.aggregate("kids", nothing(), lambda a, x: F.concat(a, x))))
        runs = written(runs, join(scratch, f"runs-{len(found)}"))
        if runs.isEmpty():
            return found
        found.append(runs)
        nodes = runs.select("tree", F.col("up").alias("pos"), F.expr(f"(n + {RUN - 1}) div {RUN}").alias("n"), "digest")


def roots(leaves: DataFrame, built: list[DataFrame]) -> DataFrame:
    """tree and digest of the root of every tree."""
    found = leaves.where("n = 1").select("tree", "digest")
    for runs in built:
        found = found.unionByName(runs.where(f"n <= {RUN}").select("tree", "digest"))
    return found


def links(leaves: DataFrame, built: list[DataFrame], ends: DataFrame) -> DataFrame:
    """Every node that has a node above it, with its siblings: tree, level, pos, path (per
    level the digests before and after the node) and reached, NULL but below a root.
    ends: tree, rest (path from the root on) and reached of each tree."""
    side = lambda part: F.aggregate(part, nothing(), lambda a, x: F.concat(a, x))
    step = F.struct(side(F.slice("kids", 1, F.col("i"))).alias("before"),
                    side(F.slice("kids", F.col("i") + 2, F.lit(RUN))).alias("after"))
    found = None
    for level, runs in enumerate(built):
        nodes = runs.select("tree", "up", "n", "kids", F.posexplode("kids").alias("i", "_")).select(
            "tree", F.lit(level).alias("level"), (F.col("up") * RUN + F.col("i")).alias("pos"), F.array(step).alias("path"), "n")
        found = nodes if found is None else found.unionByName(nodes)
    alone = leaves.where("n = 1").join(ends, "tree").select(
        "tree", F.lit(0).alias("level"), "pos", F.col("rest").alias("path"), "reached")
    if found is None:
        return alone
    below = found.where(f"n <= {RUN}").join(ends, "tree").select(
        "tree", "level", "pos", F.concat("path", "rest").alias("path"), "reached")
    kind = ends.schema["reached"].dataType
    others = found.where(f"n > {RUN}").select("tree", "level", "pos", "path", F.lit(None).cast(kind).alias("reached"))
    return others.unionByName(below).unionByName(alone)


def climb(nodes: DataFrame, scratch: str) -> DataFrame:
    """tree, pos, path and reached of every leaf, by doubling the distance that nodes point to."""
    step, state, done = 1, written(nodes, join(scratch, "reach-1")), []
    while True:
        done.append(state.where("level = 0 and reached is not null").select("tree", "pos", "path", "reached"))
        state = state.where("level > 0 or reached is null")
        starts = state.where(F.col("level") % (2 * step) == 0)
        moving = starts.where("reached is null")
        if moving.isEmpty():
            break
        salts = RUN ** max(0, step - SALTED)
        ahead = state.where((F.col("level") >= step) & (F.col("level") % step == 0)).select(
            "tree", F.col("level").alias("to_level"), F.col("pos").alias("to"), F.col("path").alias("rest"),
            F.col("reached").alias("end"), F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
        moving = moving.select(
            "tree", "level", "pos", "path", (F.col("level") + step).alias("to_level"),
            F.expr(f"pos div {RUN**step}").alias("to"), F.expr(f"(pos div {RUN**SALTED}) % {salts}").cast("int").alias("salt"))
        moved = moving.join(ahead, ["tree", "to_level", "to", "salt"]).select(
            "tree", "level", "pos", F.concat("path", "rest").alias("path"), F.col("end").alias("reached"))
        state = moved.unionByName(starts.where("reached is not null"))
        step *= 2
        state = written(state, join(scratch, f"reach-{step}"))
    found = done[0]
    for part in done[1:]:
        found = found.unionByName(part)
    return found


def fold(digest: Column, path: Column) -> Column:
    """The root that a leaf and the siblings on its way lead to."""
    return F.aggregate(path, digest, lambda a, s: hashed(F.concat(s["before"], a, s["after"])))


def proof_digest(path: Column) -> Column:
    """One digest of a proof: its siblings from leaf to root, left to right."""
    siblings = F.aggregate(path, nothing(), lambda a, s: F.concat(a, s["before"], s["after"]))
    return hashed(siblings)


def manifest(docs: DataFrame, scratch: str, carried: dict[str, Column] | None = None) -> DataFrame:
    """doc_id, source, leaf, subroot, root and path of every row of docs, digests as bytes, and the
    columns `carried`, computed from the row. scratch: a folder all executors share, not used before."""
    # NULL sorts before every source, also in front of the empty one.
    tree = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit(""))
    carried = {name: value.alias(name) for name, value in (carried or {}).items()}
    leaves = docs.select(tree.alias("tree"), F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                         leaf().alias("digest"), *carried.values())
    # Hashed once: a range exchange reads its input twice.
    leaves = written(leaves, join(scratch, "leaves"))
    leaves = placed(leaves, ["doc_id", "digest"], join(scratch, "sources"))
    built = levels(leaves, join(scratch, "sources"))
    subroots = roots(leaves, built).select(F.lit("").alias("tree"), F.col("tree").alias("of"), "digest")
    subroots = placed(written(subroots, join(scratch, "subroots")), ["of"], join(scratch, "top"))
    above = levels(subroots, join(scratch, "top"))
    step = "array<struct<before:binary,after:binary>>"
    end = roots(subroots, above).select("tree", F.array().cast(step).alias("rest"), F.col("digest").alias("reached"))
    tops = climb(links(subroots, above, end), join(scratch, "top")).join(subroots, ["tree", "pos"])
    ends = tops.select(F.col("of").alias("tree"), F.col("path").alias("rest"),
                       F.struct(F.col("digest").alias("subroot"), F.col("reached").alias("root")).alias("reached"))
    proofs = climb(links(leaves, built, written(ends, join(scratch, "ends"))), join(scratch, "sources"))
    return leaves.join(proofs, ["tree", "pos"]).select(
        "doc_id", "source", F.col("digest").alias("leaf"), "reached.subroot", "reached.root", "path", *carried)


SQL = r"""
with recursive crc as (
  select list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, x: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) as t),
d as (
  select *, case when source is null then '' else '=' || source end as tree,
    coalesce(list_reduce(list_concat([4294967295], list_transform(string_split(cast(doc_id as varchar), ''), lambda x: cast(ascii(x) as bigint))),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])) % 2 = 1, false) as tampered
  from documents, crc),
f as (
  select *, (case when doc_id is null then '-' else strlen(cast(doc_id as varchar)) || ':' || doc_id end)
    || (case when source is null then '-' else strlen(source) || ':' || source end)
    || (case when lang is null then '-' else strlen(lang) || ':' || lang end)
    || (case when n_chars is null then '-' else strlen(cast(n_chars as varchar)) || ':' || n_chars end) as head,
    replace(text, chr(10), '') as flat
  from d),
h as (
  select doc_id, tree, sha256(head || case when text is null then '-' else strlen(text) || ':' || text end) as leaf,
    case when not tampered then sha256(head || case when text is null then '-' else strlen(text) || ':' || text end)
      else sha256(head || case when text is null then '-' else strlen(flat) || ':' || flat end) end as seen
  from f),
l as (
  select *, row_number() over (partition by tree order by doc_id nulls first, leaf) - 1 as pos, count(*) over (partition by tree) as n
  from h),
nodes(tree, level, pos, n, digest) as (
  select tree, 0, pos, n, leaf from l
  union all
  select tree, level + 1, pos // 3, (any_value(n) + 2) // 3, sha256(string_agg(digest, '' order by pos))
  from nodes where n > 1 group by tree, level, pos // 3),
s as (
  select tree, digest as subroot, row_number() over (order by tree) - 1 as pos, count(*) over () as n from nodes where n = 1),
tops(level, pos, n, digest) as (
  select 0, pos, n, subroot from s
  union all
  select level + 1, pos // 3, (any_value(n) + 2) // 3, sha256(string_agg(digest, '' order by pos))
  from tops where n > 1 group by level, pos // 3),
every as (select tree, level, pos, n, digest from nodes union all select 'top', level, pos, n, digest from tops),
sides as (
  select a.tree, a.level, a.pos, coalesce(string_agg(b.digest, '' order by b.pos) filter (b.pos < a.pos), '') as b,
    coalesce(string_agg(b.digest, '' order by b.pos) filter (b.pos > a.pos), '') as a
  from every a join every b on a.tree = b.tree and a.level = b.level and a.pos // 3 = b.pos // 3
  where a.n > 1 group by a.tree, a.level, a.pos),
steps as (
  select l.tree, l.pos, level as k, b, a from l join sides x on x.tree = l.tree and x.pos = l.pos // cast(pow(3, level) as bigint)
  union all
  select l.tree, l.pos, 1000 + level, b, a from l join s on s.tree = l.tree
  join sides x on x.tree = 'top' and x.pos = s.pos // cast(pow(3, level) as bigint)),
paths as (select tree, pos, list({'b': b, 'a': a} order by k) as path from steps group by tree, pos),
done as (
  select l.doc_id, l.leaf, s.subroot, (select digest from tops where n = 1) as root,
    sha256(coalesce(list_aggregate(list_transform(path, lambda p: p.b || p.a), 'string_agg', ''), '')) as proof_sha256,
    list_reduce(list_concat([{'b': seen, 'a': ''}], coalesce(path, [])),
      lambda x, y: {'b': sha256(y.b || x.b || y.a), 'a': ''}).b as folded_root
  from l join s on s.tree = l.tree left join paths p on p.tree = l.tree and p.pos = l.pos)
select *, folded_root = root as verified from done
"""
