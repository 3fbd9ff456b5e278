"""Language ID and toxicity on held-out rows and small cases."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallystream.llm import grams, language_id, queries, toxicity
from tests.llm.cases import ROWS, documents, nothing, prose

SF = "/root/testdata/sf0.01"


def test_language_held_out(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    rows = queries.op8_language_id(spark, SF).join(docs, "doc_id").collect()
    assert len(rows) == docs.count()
    held = [r for r in rows if r.held_out]
    assert 200 < len(held) < len(rows) / 2 and all(0 <= r.score <= 1 for r in rows)
    assert sum(r.lang_pred == r.lang for r in held) >= 0.99 * len(held)


def counted(text):
    word = "".join(c.lower() if c.isalpha() else " " for c in text).split()
    found: dict = {}
    for w in word:
        padded = f" {w} "
        for n in (1, 2, 3):
            for i in range(len(padded) - n + 1):
                gram = padded[i : i + n]
                if gram.strip() and not (n == 1 and gram == " "):
                    found[gram] = found.get(gram, 0) + 1
    return sorted(found.values())


def test_grams_stay_in_words_and_rows():
    texts = ["ab  cd!e", "", "x", "12 34", "Ärger über", "a b", "ab cab"]
    row, gram, count = language_id.counted(pa.array(texts))
    for i, text in enumerate(texts):
        assert sorted(count[row == i]) == counted(text), text
    assert set(gram[row == 2]) & set(gram[row == 5]) == set()
    points, rows = grams.letters(pa.array(["ab", "ab"]))
    r, h = grams.grams(points, rows, 4)
    assert r.tolist() == [0, 1] and h[0] == h[1]


def test_distance_by_hand():
    profiles = language_id.Profiles(["p"], np.zeros(0, np.int64), np.zeros((0, 1), np.int64))
    row, gram, count = language_id.counted(pa.array(["aab"]))
    order = sorted(zip(-count, gram))
    known = np.sort(gram)
    ranks = np.full((len(known), 2), 9)
    for rank, (_, g) in enumerate(order):
        ranks[np.searchsorted(known, g)] = [rank, len(order) - 1 - rank]
    profiles = language_id.Profiles(["same", "turned"], known, ranks)
    out, size = language_id.distances(pa.array(["aab", "zz", ""]), profiles, 9)
    n = len(order)
    assert out[0].tolist() == [0, sum(min(9, abs(2 * r - n + 1)) for r in range(n))]
    assert size.tolist() == [n, out[1, 0] // 9, 0] and out[2].tolist() == [0, 0]


def test_predictions_by_brute_force(spark):
    """Counts, profiles, ranks and distances one by one, from each text's n-grams."""
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang").collect()
    top, counts = language_id.TOP, {}
    for r in rows:
        _, gram, n = language_id.counted(pa.array([r.text or ""]))
        counts[r.doc_id] = dict(zip(gram.tolist(), n.tolist()))
    ranked = lambda found: {g: i for i, (g, _) in enumerate(sorted(found.items(), key=lambda x: (-x[1], x[0]))[:top])}
    sums: dict = {}
    for r in rows:
        if r.lang is not None and zlib.crc32(str(r.doc_id).encode()) % 3 != 1:
            own = sums.setdefault(r.lang, {})
            for g, n in counts[r.doc_id].items():
                own[g] = own.get(g, 0) + n
    profiles = {lang: ranked(found) for lang, found in sums.items()}
    got = {r.doc_id: r for r in queries.op8_language_id(spark, "/root/testdata/sf0.001").collect()}
    assert len(got) == len(rows) and len(profiles) > 2
    for r in rows:
        own = ranked(counts[r.doc_id])
        apart = {lang: sum(min(abs(p[g] - i), top) if g in p else top for g, i in own.items()) for lang, p in profiles.items()}
        best = min(sorted(apart), key=apart.get) if own else "und"
        assert got[r.doc_id].lang_pred == best
        assert got[r.doc_id].score == pytest.approx(1 - apart[best] / (len(own) * top) if own else 0)


def test_counts_of_very_long_texts_are_ranked_whole():
    text = "b " * 1_060_000 + "a " * 1_050_000 + "c " * 1_055_000
    row, gram, count = language_id.counted(pa.array([text]))
    order = np.lexsort((gram, -count))
    known = np.sort(gram)
    ranks = np.full((len(known), 1), language_id.TOP)
    ranks[np.searchsorted(known, gram[order]), 0] = np.arange(len(order))
    out, _ = language_id.distances(pa.array([text]), language_id.Profiles(["own"], known, ranks), language_id.TOP)
    assert out.tolist() == [[0]] and len(set(count.tolist())) > 2


def test_language_cases(spark):
    docs = documents(spark).withColumns({"lang_pred": F.lit(1), "score": F.lit("clash")})
    profiles = language_id.learn(docs)
    assert profiles.languages == ["de", "en", "es", "fr"]
    got = {r.doc_id: r for r in language_id.identify(docs, profiles).collect()}
    assert [(got[i].lang_pred, got[i].score) for i in (4, 5, 9)] == [("und", 0.0)] * 3
    assert got[None].lang_pred == "es" and got[11].lang_pred in profiles.languages
    none = language_id.learn(nothing(spark))
    assert none.languages == [] and language_id.identify(nothing(spark), profiles).count() == 0
    assert {r.lang_pred for r in language_id.identify(docs, none).collect()} == {"und"}


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet").where("toxic is not null")
    rows = queries.op4_toxicity(spark, sf).join(labels, "doc_id").where("held_out").collect()
    toxic = [r.score for r in rows if r.toxic == 1]
    clean = [r.score for r in rows if r.toxic == 0]
    wins = np.mean([np.mean(np.array(clean) < s) for s in toxic])
    assert wins > 0.95
    assert np.mean([s >= 0.3 for s in toxic]) > 0.8 and np.mean([s >= 0.3 for s in clean]) < 0.02


def labelled(spark, rows):
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(rows)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, (_, y) in enumerate(rows)], "doc_id long, toxic int")
    return docs, labels


def test_counterfactuals_take_the_bias_from_groups(spark):
    rows = []
    for i in range(160):  # one group is named mostly where insults stand
        toxic = i % 2
        group = "muslim" if (i % 20 < 15) == bool(toxic) else "christian"
        rows.append((f"{prose(i, 8)} my {group} neighbour came. {'you worthless scum' if toxic and i % 4 == 1 else prose(i + 500, 3)}", toxic))
    docs, labels = labelled(spark, rows)
    neutral = spark.createDataFrame([(1, "my muslim neighbour came."), (2, "my christian neighbour came.")], "doc_id long, text string")

    def gap(penalty):
        scores = {r.doc_id: r.score for r in toxicity.score(neutral, toxicity.learn(docs, labels, penalty=penalty)).collect()}
        return abs(scores[1] - scores[2])

    free = gap(0.0)
    assert free > 0.2 and gap(20.0) < 0.25 * free and gap(toxicity.PENALTY) < 0.7 * free


def test_a_text_sends_a_bounded_number_of_rewritings():
    text = ". ".join(f"the {a} {b} men came" for a, b in zip(prose(1, 4000).split(), prose(2, 4000).split())) + " frauen und juden"
    table = toxicity.feature_table(np.arange(1000))
    pairs = toxicity.counterfactuals(text)
    found = toxicity.differences(pairs, table)
    assert len(pairs) > 4000 and len(found) == toxicity.MAX_PAIRS and found == toxicity.differences(pairs[::-1], table)
    assert all(not set(a) & set(b) for a, b in found)
    long = "men and " + "word " * 200_000  # one sentence without an end
    assert all(len(a) + len(b) < 200 for a, b in toxicity.differences(toxicity.counterfactuals(long), toxicity.feature_table(np.arange(toxicity.BUCKETS))))


def test_counterfactual_sentences():
    pairs = toxicity.counterfactuals("Women came. Nobody else!\nOld men left")
    assert ("women came.", "men came.") in pairs and ("old men left", "old women left") in pairs
    assert ("old men left", "young men left") in pairs and not any("nobody" in a for a, _ in pairs)
    assert toxicity.counterfactuals("") == [] and toxicity.counterfactuals("semen womenfolk") == []


@pytest.mark.parametrize("max_rows", [40, 20_000])
def test_toxicity_cases(spark, max_rows):
    rows = [(f"{prose(i, 12)} {'stupid idiot' if i % 3 == 0 else ''}", int(i % 3 == 0)) for i in range(120)]
    docs, labels = labelled(spark, rows)
    labels = labels.unionByName(spark.createDataFrame([(0, 0), (1, None), (None, 1), (5000, 1)], "doc_id long, toxic int"))
    model = toxicity.learn(docs, labels, max_rows)
    got = {r.doc_id: r for r in toxicity.score(documents(spark).withColumn("score", F.lit("clash")), model).collect()}
    assert len(got) == len({r[0] for r in ROWS}) and all(0 <= r.score <= 1 for r in got.values())
    assert got[4].score == got[5].score and got[5].predicted == int(got[5].score >= 0.3)
    if max_rows > 120:
        scored = toxicity.score(docs, model).join(labels, "doc_id")
        by_label = {r.toxic: r.s for r in scored.where("toxic is not null and doc_id > 0").groupBy("toxic").agg(F.avg("score").alias("s")).collect()}
        assert by_label[1] > 0.7 and by_label[0] < 0.3


def test_toxicity_without_labels(spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.learn(documents(spark), none)
    assert {r.predicted for r in toxicity.score(documents(spark), model).collect()} == {0}
    assert toxicity.score(nothing(spark), model).count() == 0
