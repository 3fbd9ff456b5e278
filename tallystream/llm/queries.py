"""The operators of this subpackage as queries over the given tables."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystream.llm import (
    bpe,
    hnsw,
    jaccard_join,
    language_id,
    line_dedup,
    merkle,
    mixing,
    negatives,
    quality_rules,
    token_counts,
    token_files,
    topk_search,
    toxicity,
)
from tallystream.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

END_ID = 2
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
BYTE_RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            SQL[function.__name__] = sql
        return function

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@query()
def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token files of all documents, read back: place, count and checksum of each."""
    root = scratch_path(spark, "tokens")
    index = token_files.write_tokens(table(spark, sf_dir, "documents"), root, BYTE_BPE, END_ID)

    def sums(batch, ids):
        crc = [zlib.crc32(x.astype("<u4").tobytes()) for x in ids]
        columns = [batch.column(c) for c in ("shard", "doc_id", "offset", "n_tokens")]
        return pa.RecordBatch.from_arrays([*columns, pa.array(np.array(crc, np.int64))],
                                          names=["shard", "doc_id", "offset", "n_tokens", "ids_crc32"])

    read = token_files.read_tokens(index, sums, "shard int, doc_id long, offset long, n_tokens long, ids_crc32 long")
    return read.join(token_files.shard_starts(index), "shard").select(
        "doc_id", (F.col("before") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32")


@query()
def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all documents by the rank file, and the bytes decoded from them, as digests."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ids = bpe.encode(docs, BYTE_RANKS).select("doc_id", "token_ids")
    both = bpe.decode(ids, BYTE_RANKS)
    return both.select(
        "doc_id",
        F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("token_ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query(quality_rules.SQL)
def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document."""
    judged = quality_rules.apply_rules(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", "kept")


@query(
    r"""
    with l as (
      select doc_id, line, place,
        translate(trim(line, E' \t\n\x0b\f\r'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
      from (select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
                   generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as place from documents)),
    k as (
      select key, min(doc_id) as keeper from l where length(key) >= 10 group by key having count(distinct doc_id) > 1),
    m as (select l.*, keeper is not null and doc_id <> keeper as gone from l left join k using (key))
    select doc_id, count(*) as n_lines, count(*) filter (gone) as n_dropped,
      sha256(coalesce(string_agg(line, chr(10) order by place) filter (not gone), '')) as kept_sha256
    from m group by doc_id
    """
)
def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that an earlier one holds, as a digest."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = line_dedup.drop_repeated_lines(docs, scratch_path(spark, "lines"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@query(mixing.SQL)
def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of each document the mix takes."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    mixed = mixing.mix(docs, scratch_path(spark, "mixing"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@query(
    """
    with v as (
      select vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as v
      from embeddings
      where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
    s as (
      select q.vec_id as query_id, c.vec_id, cast(list_inner_product(q.v::double[], c.v::double[]) as bigint) as score
      from v q join v c on q.vec_id % 50 = 0 and q.vec_id <> c.vec_id)
    select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank,
      vec_id, score
    from s qualify rank <= 5
    """
)
def op6_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 best rows of every vector whose id is divisible by 50."""
    vectors = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").cast("long"), topk_search.whole_numbers(F.col("embedding"), 256).alias("vector"))
    asked = vectors.where("vec_id % 50 = 0").withColumnRenamed("vec_id", "query_id")
    return topk_search.search(vectors, asked, 5)


@query()
def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the rows that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    docs = docs.withColumn("held_out", F.coalesce(held_out, F.lit(False)))
    profiles = language_id.learn(docs.where(~F.col("held_out")))
    return language_id.identify(docs.drop("lang"), profiles).select("doc_id", "held_out", "lang_pred", "score")


@query()
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from the labels that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    model = toxicity.learn(docs, table(spark, sf_dir, "labels").where(~held_out))
    return toxicity.score(docs.withColumn("held_out", held_out), model).select("doc_id", "held_out", "score", "predicted")


@query()
def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every line of every document, as the whole document is encoded."""
    docs = token_counts.line_sections(table(spark, sf_dir, "documents").select("doc_id", "text"))
    counts = token_counts.count_tokens(docs, BYTE_RANKS)
    return counts.select("doc_id", F.col("place").alias("line"), "begin", "end", F.col("n_tokens").cast("long"))


@query(
    r"""
    with d as (
      select doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') as w
      from documents),
    s as (
      select doc_id, list_distinct(case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
        else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) end) as sh
      from d),
    n as (select doc_id, len(sh) as n from s),
    t as (select doc_id, unnest(sh) as sh from s),
    p as (
      select a.doc_id as a, b.doc_id as b, count(*) as c
      from t a join t b on a.sh = b.sh and a.doc_id < b.doc_id group by 1, 2),
    e as (
      select a, b from p join n x on x.doc_id = a join n y on y.doc_id = b where 100 * c >= 75 * (x.n + y.n - c)),
    r as (
      with recursive reach(node, low) using key (node) as (
        select doc_id, doc_id from n
        union
        select u.v, min(reach.low)
        from (select a as u, b as v from e union all select b, a from e) u
        join reach on reach.node = u.u
        join recurring.reach old on old.node = u.v
        where reach.low < old.low
        group by u.v)
      select node, low from reach)
    select n.doc_id, n.n as n_shingles, r.low as component_id from n join r on r.node = n.doc_id
    """
)
def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size of every document's shingle set, and the smallest document it is linked to."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return jaccard_join.similar_groups(docs, scratch_path(spark, "jaccard"))


@query(merkle.SQL)
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, roots and proof of every document; half of them are checked with their line breaks gone."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars", "text")
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.lit(False))
    without_breaks = F.when(tampered, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    made = merkle.manifest(docs, scratch_path(spark, "manifest"), {"seen": merkle.leaf(text=without_breaks)})
    folded = made.withColumn("folded_root", merkle.fold(F.col("seen"), F.col("path")))
    digests = ("leaf", "subroot", "root", "folded_root")
    return folded.select(
        "doc_id",
        *(merkle.hex_text(F.col(c)).alias(c) for c in digests),
        merkle.hex_text(merkle.proof_digest(F.col("path"))).alias("proof_sha256"),
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


@query()
def op13_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest rows found for every vector whose id is divisible by 20."""
    vectors = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").cast("long"), hnsw.plain_vector(F.col("embedding")).alias("vector"))
    index = hnsw.make_index(vectors, scratch_path(spark, "graphs"), 20)
    return hnsw.search(index, vectors.where("vec_id % 20 = 0").withColumnRenamed("vec_id", "query_id"), 20)


@query(
    """
    with e as (
      select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
        list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as v
      from embeddings
      where label is not null and embedding is not null
        and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
    s as (
      select a.vec_id as anchor_id, c.vec_id, a.label = c.label as same,
        cast(list_inner_product(a.v::double[], c.v::double[]) as bigint) as score
      from e a join e c on a.vec_id % 100 = 0 and a.vec_id <> c.vec_id),
    p as (
      select anchor_id, vec_id as positive_id, score as positive_score
      from s where same qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5)
    select anchor_id, positive_id,
      cast(row_number() over (partition by anchor_id, positive_id order by score desc, vec_id) as integer) as rank,
      vec_id as negative_id, positive_score, score as negative_score
    from p join s using (anchor_id)
    where not same and 80 * positive_score <= 100 * score and 100 * score <= 100 * positive_score
    qualify rank <= 5
    """
)
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 5 rows of other labels that score close below each of the 5 positives of an anchor."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").cast("long"), label.alias("label"), topk_search.whole_numbers(F.col("embedding"), 256).alias("vector"))
    return negatives.mine(rows, rows.where("vec_id % 100 = 0"), scratch_path(spark, "negatives"))
