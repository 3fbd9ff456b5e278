"""The pipeline against a brute-force version of its stages, one document at a time."""

from __future__ import annotations

import base64
from collections import Counter

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from tallystream.llm import mixing, quality_rules
from tests.llm.cases import SCHEMA, documents, prose
from tests.llm.test_documents import base_counts, dedup, joined, near_rows
from tests.oracle import connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What each stage was given and what it returned, over the smallest tables."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp(name) / "out")
        stage(spark, docs, SF).write.parquet(path)
        out = spark.read.parquet(path)
        seen.append((docs, out))
        docs = out
    return seen


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_stage_list(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "jaccard_join", "mixing", "byte_bpe"]
    for docs, out in stages[:-1]:
        assert out.columns == corpus_pipeline.COLUMNS
        assert out.dtypes == docs.dtypes


def test_rules_stage(stages):
    docs, out = stages[0]
    con = connect(SF)
    kept = [r[0] for r in con.execute(f"select doc_id from ({quality_rules.SQL}) where kept").fetchall()]
    assert ids(out) == sorted(kept) and 0 < len(kept) < docs.count()
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert all(texts[r.doc_id] == r.text and base_counts(r.text)[0] >= 10 for r in out.collect())


def test_lines_stage(stages):
    docs, out = stages[1]
    want = {d: t for d, t, _, _ in dedup([(r.doc_id, r.text) for r in docs.collect()])}
    assert {r.doc_id: r.text for r in out.collect()} == {d: t for d, t in want.items() if t.strip(" \t\n\x0b\f\r")}
    assert 0 < out.count() < len(want)
    assert all(r.n_chars == len(r.text) for r in out.collect())


def test_groups_stage(stages):
    docs, out = stages[2]
    want = {c for _, _, c in joined([(r.doc_id, r.text) for r in docs.collect()])}
    assert ids(out) == sorted(want)


def test_mix_stage(spark, stages, tmp_path):
    docs, out = stages[3]
    epochs = {r.doc_id: r.epochs for r in mixing.mix(docs, str(tmp_path / "m")).collect()}
    assert Counter(ids(out)) == Counter({d: n for d, n in epochs.items() if n})


def test_tokens_stage(stages):
    docs, out = stages[4]
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    assert ids(out) == ids(docs)
    assert all(r.token_ids == library.encode_ordinary(r.text) for r in out.collect())


def test_run_applies_the_stages(spark, stages):
    out = corpus_pipeline.run(spark, SF).collect()
    assert Counter((r.doc_id, tuple(r.token_ids)) for r in out) == Counter(
        (r.doc_id, tuple(r.token_ids)) for r in stages[-1][1].collect())
    assert "pipeline" in __spark_entry__.queries() and "pipeline" not in __spark_entry__.oracle_sql()


def test_stages_over_cases(spark, tmp_path):
    near = [(d, t, "en", "a", None) for d, t in near_rows()]
    tables = {"cases": documents(spark), "near": documents(spark, near), "none": spark.createDataFrame([], SCHEMA)}
    for name, docs in tables.items():
        docs = docs.withColumns({"kept": F.lit(1), "gone": F.lit(2), "epochs": F.lit(3), "token_ids": F.lit("x"), "_first": F.lit(4)})
        for stage, function in corpus_pipeline.STAGES:
            path = str(tmp_path / name / stage)
            function(spark, docs, SF).write.parquet(path)
            docs = spark.read.parquet(path)
        assert (docs.count() > 0) == (name != "none")


def test_documents_that_lose_all_they_said_go(spark):
    line, other = prose(1, 12), prose(2, 12)
    rows = [(1, line, "en", "a", 1), (2, f" {line} \n\t", "en", "a", 1), (3, f"{line}\n{other}", "en", "a", 1), (4, "", "en", "a", 0), (5, None, "en", "a", 0)]
    got = {r.doc_id: r.text for r in corpus_pipeline.lines(spark, documents(spark, rows), SF).collect()}
    assert got == {1: line, 3: other, 4: "", 5: ""}


def test_one_of_repeated_rows_stays(spark):
    rows = [(1, prose(1, 30), "en", "a", 1)] * 3 + [(2, prose(1, 30), "en", "a", 1), (None, prose(2, 30), None, None, 1)] * 2
    assert sorted(map(str, ids_of(corpus_pipeline.near_duplicates(spark, documents(spark, rows), SF)))) == ["1", "None"]


def test_rows_without_an_id_or_with_a_repeated_one_are_compared_by_text(spark):
    a, b, c, d, e = (prose(i, 60) for i in (21, 22, 23, 24, 25))
    rows = [(None, a, "en", "a", 1), (None, b, "en", "b", 1), (None, b, "de", "c", 1), (None, c + " end", "en", "a", 1), (3, c, "en", "a", 1),
            (5, d, "en", "a", 1), (5, e, "en", "a", 1), (6, e + " end", "en", "a", 1), (7, e, "fr", "z", 1), (5, e, "de", "a", 1),
            (None, "", "en", "a", 0), (None, "", "en", "a", 0), (None, None, "de", "a", 0), (8, "", "en", "a", 0), (8, "", "en", "a", 0)]
    want = [(None, a, "en"), (None, b, "de"), (3, c, "en"), (5, d, "en"), (5, e, "de"),
            (None, "", "en"), (None, "", "en"), (None, None, "de"), (8, "", "en")]
    for given in (rows, rows[::-1]):
        got = corpus_pipeline.near_duplicates(spark, documents(spark, given).repartition(5), SF).collect()
        assert sorted(((r.doc_id, r.text, r.lang) for r in got), key=str) == sorted(want, key=str)


def ids_of(df):
    return [r.doc_id for r in df.collect()]
