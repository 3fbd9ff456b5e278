"""Merkle manifest against a plain build of the tree."""

from __future__ import annotations

from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from tallystream.llm import merkle
from tallystream.session import scratch_path
from tests.llm.cases import ROWS, documents, nothing


def digest(*parts: str) -> str:
    return sha256("".join(parts).encode()).hexdigest()


def leaf(row) -> str:
    doc_id, text, lang, source, n_chars = row
    fields = (doc_id, source, lang, n_chars, text)
    return digest(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in fields))


def proofs(leaves: list[str]) -> tuple[str, list[list[tuple[str, str]]]]:
    """Root, and per leaf the siblings before and after it, level by level."""
    paths, at = [[] for _ in leaves], list(range(len(leaves)))
    while len(leaves) > 1:
        for i, place in enumerate(at):
            first = place - place % 3
            paths[i].append(("".join(leaves[first:place]), "".join(leaves[place + 1 : first + 3])))
            at[i] = place // 3
        leaves = [digest(*leaves[i : i + 3]) for i in range(0, len(leaves), 3)]
    return leaves[0], paths


def brute(rows):
    sources = {}
    for row in rows:
        sources.setdefault(row[3], []).append(row)
    order = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    inner = {}
    for source in order:
        ordered = sorted(sources[source], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        inner[source] = ordered, *proofs([leaf(r) for r in ordered])
    root, tops = proofs([inner[s][1] for s in order])
    out = []
    for source, top in zip(order, tops):
        ordered, subroot, paths = inner[source]
        for row, path in zip(ordered, paths):
            out.append((row[0], leaf(row), subroot, root, digest(*(a + b for a, b in path + top))))
    return sorted(out, key=repr)


def built(spark, docs):
    made = merkle.manifest(docs, scratch_path(spark, "manifest"), {"seen": merkle.leaf(text=F.concat("text", F.lit("!")))})
    digests = [merkle.hex_text(F.col(c)).alias(c) for c in ("leaf", "subroot", "root")]
    return made.select("doc_id", *digests, merkle.hex_text(merkle.proof_digest(F.col("path"))).alias("proof"),
                       (merkle.fold(F.col("leaf"), F.col("path")) == F.col("root")).alias("whole"),
                       (merkle.fold(F.col("seen"), F.col("path")) == F.col("root")).alias("changed")).collect()


def many(counts: dict) -> list:
    return [(i, f"text {i}", "en", source, i) for source, n in counts.items() for i in range(n)]


@pytest.mark.parametrize("rows", [ROWS, ROWS[:1], many({"a": 1, "b": 1}), many({"hot": 1000, None: 4, "": 3, "é": 28, "z": 1, "y": 82})],
                         ids=["cases", "lone", "two", "hot"])
def test_manifest_by_brute_force(spark, rows):
    got = built(spark, documents(spark, rows).withColumns({"tree": F.lit(1), "pos": F.lit(2), "digest": F.lit("x"), "path": F.lit(3)}))
    assert sorted([tuple(r)[:5] for r in got], key=repr) == brute(rows)
    assert all(r.whole for r in got)


def test_a_changed_row_does_not_lead_to_the_root(spark):
    got = built(spark, documents(spark, many({"a": 30, "b": 2})))
    assert len(got) == 32 and not any(r.changed for r in got)


def test_wide_ancestors_are_met_in_parts(spark, monkeypatch):
    monkeypatch.setattr(merkle, "SALTED", 2)
    rows = many({"a": 300, "b": 7})
    assert sorted([tuple(r)[:5] for r in built(spark, documents(spark, rows))], key=repr) == brute(rows)


def test_empty_table(spark):
    assert built(spark, nothing(spark)) == []
