"""Quality rules, line dedup, Jaccard join and mixing against SQL and brute force."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallystream.llm import components, jaccard_join, line_dedup, mixing, quality_rules, queries, shingles
from tests.llm.cases import LONG, ROWS, documents, nothing, prose
from tests.oracle import compare, connect

SF = "/root/testdata/sf0.001"
BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_its_sql(spark, name):
    assert compare(queries.QUERIES[name](spark, SF), connect(SF), queries.SQL[name]) is None


# Quality rules


def base_counts(text):
    text = text or ""
    found, lines = words(text), text.split("\n")
    places = defaultdict(list)
    for i in range(len(found) - 4):
        places[tuple(found[i : i + 5])].append(i)
    covered = {i + k for at in places.values() if len(at) > 1 for i in at for k in range(5)}
    worded = [line for line in lines if words(line)]
    return (len(found), sum(map(len, found)), len(re.findall(r"[#*$%&|<>]", text)),
            sum(n - 1 for n in Counter(worded).values()), len(covered))


def test_quality_counts_by_brute_force(spark):
    rows = [r[:2] for r in ROWS] + [
        (20, "a b c d e f a b c d e f a b c"), (21, "x " * 30), (22, "same line here\n" * 3 + "\nother"),
        (23, "# $ | a b\r\nc *** <d>"), (24, "one"), (25, "p q r s t u v w p q r s t u v w"), (26, "🙂 ab\x0bcd")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"kept": F.lit(7), "_words": F.lit(8)})
    got = quality_rules.apply_rules(docs).collect()
    assert len(got) == len(rows)
    for row in got:
        counts = base_counts(row.text)
        assert (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words) == counts, row.text[:50]
        assert row.base_failed == (counts[0] < 10 or 100 * counts[4] > 20 * counts[0])
        assert not (row.base_failed and row.kept)


def test_quality_lines(spark):
    good = "These are plain words that end a sentence."
    bad = {
        "symbols": "and&&& of### the$$$ was*** it%%%", "shouting": "NO!! WAY!! THE!! END!!",
        "menu": "Home | About us | Contact", "bare": "Read more", "notice": "We value your privacy. Accept all cookies now.",
    }
    fine = [good, "Short one.", "", "The price is 5 $ for all of the people here.", "What?"]
    lines = [*fine, *bad.values()]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "i int, line string")
    got = [r.fails for r in df.select("i", quality_rules.line_fails(F.col("line")).alias("fails")).orderBy("i").collect()]
    assert got == [False] * len(fine) + [True] * len(bad)
    doc = lambda n: good + "\n" + prose(4, 12) + "\n" + "\n".join(list(bad.values())[:n])
    long_junk = prose(8, 15) + "\n" + " ".join(f"{w}###" for w in prose(9, 60).split())
    rows = [(0, doc(1)), (1, doc(0)), (2, long_junk)]
    kept = quality_rules.apply_rules(spark.createDataFrame(rows, "doc_id long, text string")).orderBy("doc_id").collect()
    assert [r.kept for r in kept] == [True, True, False]
    assert [r.n_removed_lines for r in kept] == [1, 0, 1] and bad["symbols"] not in kept[0].clean_text
    assert quality_rules.keep(quality_rules.apply_rules(spark.createDataFrame(rows, "doc_id long, text string"))).count() == 2
    assert quality_rules.apply_rules(nothing(spark)).count() == 0


# Line dedup


def dedup(rows):
    keys = lambda text: [lower(line).strip(BLANKS) for line in (text or "").split("\n")]
    least = line_dedup.NULL_ID
    holders = defaultdict(set)
    for doc, text in rows:
        for key in keys(text):
            if len(key) >= 10:
                holders[key].add(least if doc is None else doc)
    out = []
    for doc, text in rows:
        own = least if doc is None else doc
        lines = (text or "").split("\n")
        stay = [x for x, k in zip(lines, keys(text)) if len(k) < 10 or len(holders[k]) < 2 or min(holders[k]) == own]
        out.append((doc, "\n".join(stay), len(lines), len(lines) - len(stay)))
    return sorted(out, key=repr)


def test_line_dedup_by_brute_force(spark, tmp_path):
    rows = [r[:2] for r in ROWS] + [
        (30, "shared by many documents\nshort\nshared by many documents"), (31, "SHARED by many documents\nshort"),
        (32, "\x0bshared by many documents\r\nown line of this one"), (33, "ünïcödé zeile\n日本語の文字は十個あります"),
        (34, "ÜNÏcödé zeile\nünïcödé ZEILE\n日本語の文字は十個あります"), (None, "shared by many documents"),
        (35, "123456789\n1234567890"), (36, "123456789\n1234567890"), (35, "one id, another text\n1234567890")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"gone": F.lit(1), "n_lines": F.lit("clash")})
    got = line_dedup.drop_repeated_lines(docs, str(tmp_path / "a"))
    assert sorted(((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in got.collect()), key=repr) == dedup(rows)
    assert line_dedup.drop_repeated_lines(nothing(spark), str(tmp_path / "b")).count() == 0
    alone = line_dedup.drop_repeated_lines(documents(spark, ROWS[:1]), str(tmp_path / "c")).collect()
    assert [(r.text, r.n_dropped) for r in alone] == [(ROWS[0][1], 0)]


def test_perfect_hash_is_minimal_and_survives_saving(tmp_path):
    draw = np.random.default_rng(1)
    h1, h2 = draw.integers(-(2**63), 2**63 - 1, (2, 20_000))
    h1[:50] = h1[50]  # equal first halves
    shard = line_dedup.Shard.build(h1, h2, np.arange(20_000), np.arange(20_000) * 3)
    assert sorted(shard.perfect.find(h1, h2)) == list(range(20_000))
    shard.save(str(tmp_path / "x"), "s", 1)
    again = line_dedup.Shard.load(str(tmp_path / "x"), "s")
    found, keepers = again.probe(h1, h2)
    assert found.all() and (keepers == np.arange(20_000) * 3).all() and again.counts.max() == 19_999
    strangers = draw.integers(-(2**63), 2**63 - 1, (2, 20_000))
    assert not again.probe(*strangers)[0].any()


# Jaccard join


def shingle_set(text):
    found = words(lower(text or ""))
    if len(found) < 5:
        return {tuple(found)} if found else set()
    return {tuple(found[i : i + 5]) for i in range(len(found) - 4)}


def joined(rows):
    ids = sorted({d for d, _ in rows})
    parent = {d: d for d in ids}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    sets = [(d, shingle_set(t)) for d, t in rows]
    for i, (a, one) in enumerate(sets):
        for b, other in sets[:i]:
            if one and other and 100 * len(one & other) >= 75 * len(one | other):
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return sorted((d, len(s), root(d)) for d, s in sets)


def edited(text, seed, edits):
    found, draw = text.split(), random.Random(seed)
    for _ in range(edits):
        found[draw.randrange(len(found))] = f"new{draw.randrange(10**6)}"
    return " ".join(found)


def near_rows():
    rows, base = [], [prose(i, 120) for i in range(100, 106)]
    for k, text in enumerate(base):
        rows += [(1000 * k + 500 - i, edited(text, 10 * k + i, i % 7)) for i in range(40)]
    chain = base[0]
    for i in range(12):  # each like its neighbour, unlike the far ones
        chain = edited(chain, 900 + i, 2)
        rows.append((7000 + i, chain))
    rows += [(8000 + i, " ".join(prose(50, 60).split()[i : i + 40])) for i in range(15)]
    rows += [(9000, "a b c d"), (9001, "A B C D"), (9002, "a b c"), (9003, ""), (9004, None), (9005, "a b c d e"),
             (9006, LONG), (9007, LONG + " end"), (9008, "same same same same same same same")]
    return rows + [(100 + i, base[1]) for i in range(20)]


def test_jaccard_join_by_brute_force(spark, tmp_path, monkeypatch):
    rows = near_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n", F.lit("clash"))
    take = lambda df: sorted((r.doc_id, r.n_shingles, r.component_id) for r in df.collect())
    assert take(jaccard_join.similar_groups(docs, str(tmp_path / "a"))) == joined(rows)
    # Small chunks: leaders and cells are split.
    monkeypatch.setattr(jaccard_join, "LEAD_CHUNK", 3)
    monkeypatch.setattr(jaccard_join, "CELL_CHUNK", 2)
    assert take(jaccard_join.similar_groups(docs, str(tmp_path / "b"))) == joined(rows)


def test_jaccard_join_cases(spark, tmp_path):
    got = jaccard_join.similar_groups(documents(spark), str(tmp_path / "a")).collect()
    assert len(got) == len(ROWS)
    by_id = {r.doc_id: r.component_id for r in got}
    assert by_id[None] is None and by_id[3] == 1 and by_id[4] == 4 and by_id[8] == 7 and by_id[9] == 9
    assert jaccard_join.similar_groups(nothing(spark), str(tmp_path / "b")).count() == 0
    twice = spark.createDataFrame([(1, prose(1, 30)), (2, prose(2, 30)), (2, prose(1, 30)), (3, prose(2, 30))], "doc_id long, text string")
    assert {r.component_id for r in jaccard_join.similar_groups(twice, str(tmp_path / "c")).collect()} == {1}


def test_rows_without_an_id_are_documents_of_their_own(spark, tmp_path):
    a, b, c = (prose(i, 60) for i in (31, 32, 33))
    rows = [(None, a), (None, b), (1, a + " end"), (2, b + " end"), (None, c), (3, c + " one two"), (4, ""), (5, ""), (5, b), (None, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = jaccard_join.similar_groups(docs, str(tmp_path / "a")).collect()
    want = [(None, 1), (None, 2), (1, 1), (2, 2), (None, 3), (3, 3), (4, 4), (5, 2), (5, 2), (None, None)]
    assert sorted(((r.doc_id, r.component_id) for r in got), key=str) == sorted(want, key=str)


def test_cells_open_what_the_matrix_allows():
    draw = random.Random(2)
    base = [set(draw.sample(range(10_000), 60)) for _ in range(6)]
    sets, group = [], []
    for i in range(80):
        own = set(base[i % 6])
        for _ in range(draw.randint(0, 14)):
            own.discard(draw.choice(sorted(own)))
            own.add(draw.randrange(10_000))
        sets.append(np.array(sorted(own), np.uint64))
        group.append(i // 2)
    found = jaccard_join.cell_links(sets, np.arange(80), np.array(group), np.full(80, -1))
    link = lambda a, b: jaccard_join.linked(len(np.intersect1d(sets[a], sets[b])), len(sets[a]), len(sets[b]))
    assert all(link(a, b) for a, b in found)

    def classes(edges):
        name = list(group)
        for a, b in edges:
            old, new = name[a], name[b]
            name = [new if n == old else n for n in name]
        return {frozenset(i for i in range(80) if name[i] == n) for n in name}

    assert classes(found) == classes([(a, b) for a in range(80) for b in range(a) if link(a, b)])


def test_similar_sets_share_a_band():
    draw = random.Random(4)
    missed = 0
    for _ in range(200):
        common = draw.sample(range(2**60), 75)
        one, other = (np.array(sorted(common + draw.sample(range(2**60), k)), np.uint64) for k in (13, 12))
        keys = jaccard_join.band_keys(np.concatenate([one, other]), np.array([len(one), len(other)]))
        missed += not set(keys[0]) & set(keys[1])
    assert missed == 0


def test_shingles_follow_the_words():
    texts = ["A b\tC d e f", "a b c d e\n", "a b", "", "  ", "é É\xa0x", "a B c d e a b c d e"]
    values, sizes = shingles.shingle_sets(pa.array(texts))
    assert sizes.tolist() == [len(shingle_set(t)) for t in texts]
    ends = np.cumsum(sizes)
    own = [set(values[e - n : e].tolist()) for e, n in zip(ends, sizes)]
    assert own[1] < own[0] and own[1] < own[6]


def test_components_of_chains_stars_and_loops(spark, tmp_path):
    draw = random.Random(6)
    edges = [(i, i + 1) for i in range(60)] + [(200, i) for i in range(201, 260)] + [(300, 301), (301, 302), (302, 300), (5, 5)]
    edges += [(draw.randrange(400, 480), draw.randrange(400, 480)) for _ in range(60)] + [(None, 3), (-7, 900)]
    got = components.components(spark.createDataFrame(edges, "a long, b long"), str(tmp_path / "a"))
    name = {n: n for e in edges if None not in e and e[0] != e[1] for n in e}
    for _ in range(100):
        for a, b in edges:
            if a in name and b in name:
                name[a] = name[b] = min(name[a], name[b])
    assert {r.node: r.component for r in got.collect()} == name
    assert components.components(spark.createDataFrame([], "a long, b long"), str(tmp_path / "b")).count() == 0


# Mixing


def test_targets_by_sharing_anew(spark):
    draw = random.Random(8)
    for sizes in ([0, 0], [10], [5, 1000, 3], [draw.randrange(2000) for _ in range(17)], [1, 1, 1, 10_000]):
        names = [None if i == len(sizes) - 1 else f"s{i:02}" for i in range(len(sizes))]
        got = mixing.targets(spark.createDataFrame(list(zip(names, sizes)), "source string, source_size long"))
        weight = [(5, 2, 1)[i % 3] for i in range(len(sizes))]
        want, left, open_ = [0.0] * len(sizes), 1.5 * sum(sizes), set(range(len(sizes)))
        while open_:
            share = left / sum(weight[i] for i in open_)
            full = {i for i in open_ if weight[i] * share >= 2 * sizes[i]}
            for i in full or open_:
                want[i] = 2.0 * sizes[i] if full else weight[i] * share
            left -= sum(want[i] for i in full)
            open_ = open_ - full if full else set()
        assert [r.target for r in sorted(got.collect(), key=lambda r: (r.source is None, r.source))] == pytest.approx(want)


def test_mixing_cases(spark, tmp_path):
    rows = [(i, prose(i, 1 + i % 37), "en", ("hot", "a", "b", None)[0 if i % 3 else i % 4], 0) for i in range(600)] + ROWS
    docs = documents(spark, rows).withColumns({"taken": F.lit("clash"), "epochs": F.lit(0)})
    got = mixing.mix(docs, str(tmp_path / "a")).collect()
    assert len(got) == len(rows)
    sums = defaultdict(lambda: [0, 0, 0.0, 0])
    for r in got:
        assert r.size == len(words(r.text)) and r.taken == r.size * r.epochs and 0 <= r.epochs <= 2
        own = sums[r.source]
        own[0] += r.size
        own[1] += r.taken
        own[2], own[3] = r.target, max(own[3], r.size)
    for size, taken, target, most in sums.values():
        assert target <= 2 * size and abs(taken - target) <= most
    assert {r.source: r.source_size for r in got} == {s: v[0] for s, v in sums.items()}
    again = mixing.mix(docs.repartition(7), str(tmp_path / "b")).collect()
    assert Counter((r.doc_id, r.epochs) for r in again) == Counter((r.doc_id, r.epochs) for r in got)
    other = mixing.mix(docs, str(tmp_path / "c"), seed="other").collect()
    assert Counter((r.doc_id, r.epochs) for r in other) != Counter((r.doc_id, r.epochs) for r in got)
    assert mixing.mix(nothing(spark), str(tmp_path / "d")).count() == 0
    empty = mixing.mix(documents(spark, [(1, None, None, None, None), (2, "", None, "a", 0)]), str(tmp_path / "e")).collect()
    assert [(r.size, r.target, r.taken) for r in empty] == [(0, 0.0, 0)] * 2


def test_better_documents_are_taken_more_often(spark, tmp_path):
    """Equal texts but for their symbols, which halve the weight; a third of the source's words are taken once more."""
    clean = [(i, prose(i, 20), "en", "a", 0) for i in range(600)]
    dirty = [(1000 + i, prose(i, 20).replace(" ", "# "), "en", "a", 0) for i in range(600)]
    rest = [(2000 + i, prose(i, 20), "en", "b", 0) for i in range(300)]
    got = mixing.mix(documents(spark, clean + dirty + rest), str(tmp_path / "a")).where("source = 'a'").collect()
    least = min(r.epochs for r in got)
    more = Counter(r.doc_id < 1000 for r in got if r.epochs > least)
    assert {r.epochs for r in got} == {least, least + 1}
    # Of exponential keys with rates 1 and 0.51, the smaller ones are those of rate 1 nearly two times in three.
    assert 1.3 < more[True] / more[False] < 2.6


@pytest.mark.parametrize("weight", [0.05, 1e-6, 1.0, 1e6])
def test_no_bucket_holds_much_of_a_source(spark, tmp_path, weight):
    docs = spark.range(40_000).selectExpr("id as doc_id", "concat('w', id, ' x') as text", "'a' as source")
    mixing.borders(docs, str(tmp_path / "a"), F.lit(weight), "seed")
    rows = spark.read.parquet(str(tmp_path / "a/draws"))
    assert rows.groupBy("bucket").count().agg(F.max("count")).first()[0] < 60  # 20 expected at most
    assert rows.select("bucket").distinct().count() < 12_000
