"""Toxicity by a counterfactually regularised classifier.

Logistic regression over the presence of letter n-grams (5 and 7, word borders included), so
that whole words and word stems both count. N-grams are hashed to buckets; those that set the
labels apart most (G squared) become features.

Counterfactuals: every sentence of a learning text that names a group (`IDENTITY_GROUPS`) is
written again with each other name of that group in its place. Training adds the mean square of
the difference between the logits of the two sentences, times `penalty`, to the loss, so a
neutral mention of a group moves no score.

The fit takes at most about `MAX_ROWS` labelled rows, drawn by a hash of the id, and of each at most
`MAX_PAIRS` rewritings, those of smallest hash. Texts stay in the tasks: what reaches the driver is the
ids of the features that a row holds, at most `FEATURES`, and for each rewriting those in which it differs.
Scoring covers every text whole. Names are given for the languages below; others are a caller's list (`groups`).
A corpus that names no group is fitted without the penalty, as plain logistic regression.

Cases: NULL and empty texts get the score of a text without features; NULL labels are not
learned; of a doc_id labelled twice the toxic label counts; without labels every score is the
smoothed prior, which is low; a long text is one row of n-grams, read in slices of a batch;
repeated rows score alike; empty tables give empty tables; other columns are kept, those with
the names of the outputs are replaced.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallystream.llm.columns import map_arrow, plain_text, replaced, small_batches
from tallystream.llm.components import written
from tallystream.llm.grams import grams, letters
from tallystream.session import scratch_path

ORDERS = (5, 7)
BITS = 22
BUCKETS = len(ORDERS) << BITS
FEATURES = 4000
MIN_DOCS = 4
MAX_ROWS = 20_000
MAX_PAIRS = 32
THRESHOLD = 0.3
PENALTY, L2, STEPS, RATE = 1.0, 2e-4, 400, 0.05
PRIOR_TOXIC, PRIOR_ROWS = 0.5, 20

# Names that can stand for each other in a sentence; one line a group.
IDENTITY_GROUPS = (
    ("women", "men"),
    ("woman", "man"),
    ("female", "male"),
    ("girls", "boys"),
    ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino"),
    ("african", "european", "american", "mexican", "chinese", "indian"),
    ("gay", "lesbian", "straight", "bisexual", "transgender"),
    ("immigrants", "refugees", "foreigners", "locals"),
    ("old", "young", "elderly"),
    ("blind", "deaf", "disabled"),
    ("frauen", "männer"),
    ("christen", "muslime", "juden", "hindus", "buddhisten", "atheisten"),
    ("flüchtlinge", "ausländer", "einheimische"),
    ("femmes", "hommes"),
    ("chrétiens", "musulmans", "juifs", "hindous", "bouddhistes", "athées"),
    ("réfugiés", "étrangers", "immigrés"),
    ("mujeres", "hombres"),
    ("cristianos", "musulmanes", "judíos", "hindúes", "budistas", "ateos"),
    ("refugiados", "extranjeros", "inmigrantes"),
)


@dataclass
class Model:
    """Feature buckets in order, their weights, and the bias."""

    buckets: np.ndarray
    weights: np.ndarray
    bias: float


def buckets_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Row and bucket of every n-gram, repeats included."""
    points, rows = letters(texts)
    found = []
    for i, n in enumerate(ORDERS):
        row, h = grams(points, rows, n)
        found.append((row, (h >> np.uint64(64 - BITS)).astype(np.int64) | i << BITS))
    return np.concatenate([r for r, _ in found]), np.concatenate([b for _, b in found])


def feature_table(buckets: np.ndarray) -> np.ndarray:
    table = np.full(BUCKETS, -1, np.int32)
    table[buckets] = np.arange(len(buckets))
    return table


def features_of(texts: pa.Array, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and feature, once each."""
    row, bucket = buckets_of(texts)
    feature = table[bucket]
    both = np.unique(row[feature >= 0] << 32 | feature[feature >= 0])
    return both >> 32, both & (1 << 32) - 1


def counterfactuals(text: str, groups=IDENTITY_GROUPS) -> list[tuple[str, str]]:
    """Sentences that name a group, each with every rewriting."""
    others = {name: [o for o in group if o != name] for group in groups for name in group}
    names = re.compile(r"\b(" + "|".join(map(re.escape, others)) + r")\b")
    pairs = []
    for sentence in re.split(r"(?<=[.!?])\s+|\n+", text.lower()):
        named = dict.fromkeys(names.findall(sentence))
        pairs += [(sentence, re.sub(rf"\b{re.escape(n)}\b", o, sentence)) for n in named for o in others[n]]
    return pairs


def labelled(docs: DataFrame, labels: DataFrame, max_rows: int) -> DataFrame:
    """doc_id, text and toxic (0 or 1) of the learning sample."""
    known = labels.where(F.col("toxic").isin(0, 1)).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max("toxic").cast("int").alias("toxic"))
    share = min(1.0, max_rows / max(1, known.count()))
    drawn = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(share * (1 << 20)))
    return plain_text(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(drawn, "doc_id"), "text")


def select_features(rows: DataFrame, count: int) -> list:
    """The buckets whose presence sets the labels apart most."""

    def run(batches):
        for batch in small_batches(batches, "text"):
            row, bucket = buckets_of(batch.column("text"))
            both = np.unique(row << 32 | bucket)
            toxic = batch.column("toxic").to_numpy(zero_copy_only=False)[both >> 32]
            found, place = np.unique(both & (1 << 32) - 1, return_inverse=True)
            positive = np.bincount(place, toxic, len(found)).astype(np.int64)
            total = np.bincount(place, minlength=len(found))
            yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(positive), pa.array(total)],
                                             names=["bucket", "toxic", "n"])

    seen = map_arrow(rows.select("text", "toxic"), run, "bucket long, toxic long, n long")
    seen = seen.groupBy("bucket").agg(F.sum("toxic").alias("toxic"), F.sum("n").alias("n")).where(F.col("n") >= MIN_DOCS)
    whole = rows.agg(F.coalesce(F.avg("toxic"), F.lit(0.0)).alias("share")).first()
    share = F.lit(float(whole["share"]))
    part = lambda k, expected: F.when(k > 0, k * F.ln(k / expected)).otherwise(0)
    g2 = part(F.col("toxic"), F.col("n") * share) + part(F.col("n") - F.col("toxic"), F.col("n") * (1 - share))
    return [r.bucket for r in seen.select("bucket", g2.alias("g2")).orderBy(F.desc("g2"), "bucket").limit(count).collect()]


def fit(rows: np.ndarray, features: np.ndarray, toxic: np.ndarray, size: int, pairs: list, penalty: float) -> tuple[np.ndarray, float]:
    """Weights and bias by full-batch Adam. rows and features: what each text holds. pairs: rows
    and features of the sentences, and of the sentences rewritten."""
    n = len(toxic)
    weights, bias = np.zeros(size), float(np.log((toxic.sum() + PRIOR_TOXIC) / (n - toxic.sum() + PRIOR_ROWS)))
    if not n:
        return weights, bias
    (rows_a, features_a), (rows_b, features_b), n_pairs = pairs
    first, second = np.zeros(size + 1), np.zeros(size + 1)
    for step in range(1, STEPS + 1):
        logit = np.bincount(rows, weights[features], n) + bias
        error = (1 / (1 + np.exp(-logit)) - toxic) / n
        gradient = np.append(np.bincount(features, error[rows], size) + L2 * weights, error.sum())
        if n_pairs:
            change = np.bincount(rows_a, weights[features_a], n_pairs) - np.bincount(rows_b, weights[features_b], n_pairs)
            change = change * (2 * penalty / n_pairs)
            gradient[:-1] += np.bincount(features_a, change[rows_a], size) - np.bincount(features_b, change[rows_b], size)
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        move = RATE * first / (1 - 0.9**step) / (np.sqrt(second / (1 - 0.999**step)) + 1e-9)
        weights, bias = weights - move[:-1], bias - move[-1]
    return weights, float(bias)


def learn(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, penalty: float = PENALTY,
          groups=IDENTITY_GROUPS) -> Model:
    """docs: doc_id, text; labels: doc_id, toxic."""
    rows = written(labelled(docs, labels, max_rows), scratch_path(docs.sparkSession, "labelled"))
    buckets = np.array(sorted(select_features(rows, FEATURES)), np.int64)

    def run(batches):
        table = feature_table(buckets)
        for batch in small_batches(batches, "text"):
            row, feature = features_of(batch.column("text"), table)
            ends = np.searchsorted(row, np.arange(batch.num_rows + 1))
            held = [feature[a:b].tolist() for a, b in zip(ends, ends[1:])]
            pairs = [differences(counterfactuals(t, groups), table) for t in batch.column("text").to_pylist()]
            ids = pa.list_(pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("toxic"), pa.array(held, pa.list_(pa.int32())),
                 pa.array([[a for a, _ in p] for p in pairs], ids), pa.array([[b for _, b in p] for p in pairs], ids)],
                names=["toxic", "features", "lost", "gained"])

    schema = "toxic int, features array<int>, lost array<array<int>>, gained array<array<int>>"
    sample = map_arrow(rows.select("text", "toxic"), run, schema).toArrow().combine_chunks()
    column = lambda c: sample.column(c).combine_chunks()
    toxic = column("toxic").to_numpy(zero_copy_only=False).astype(float)
    rows_of, features = laid_out(column("features"))
    sides = [laid_out(column(c).flatten()) for c in ("lost", "gained")]
    weights, bias = fit(rows_of, features, toxic, len(buckets), [*sides, len(column("lost").flatten())], penalty)
    return Model(buckets, weights, bias)


def differences(pairs: list[tuple[str, str]], table: np.ndarray) -> list[tuple[list[int], list[int]]]:
    """For each sentence and its rewriting the features that only one of them has, of at most MAX_PAIRS pairs
    that differ: what both have does not change the difference of their logits."""
    if len(pairs) > MAX_PAIRS:
        pairs = sorted(set(pairs), key=lambda p: (zlib.crc32("\n".join(p).encode()), p))[:MAX_PAIRS]
    found = []
    for pair in pairs:
        row, feature = features_of(pa.array(pair), table)
        one, other = feature[row == 0], feature[row == 1]
        found.append((np.setdiff1d(one, other).tolist(), np.setdiff1d(other, one).tolist()))
    return found


def laid_out(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Row and value of everything in a list column."""
    values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy())) if len(lists) else values, values


def score(docs: DataFrame, model: Model, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Add score (0 to 1) and predicted (1 from the threshold on)."""

    def run(batches):
        table = feature_table(model.buckets)
        for batch in small_batches(batches, text):
            row, feature = features_of(batch.column(text), table)
            logit = np.bincount(row, model.weights[feature], batch.num_rows) + model.bias
            scores = 1 / (1 + np.exp(-np.clip(logit, -700, 700)))
            made = replaced(batch, "score", pa.array(scores))
            yield replaced(made, "predicted", pa.array((scores >= threshold).astype(np.int32)))

    df = plain_text(docs, text)
    fields = [f for f in df.schema.fields if f.name not in ("score", "predicted")]
    schema = T.StructType([*fields, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    return map_arrow(df, run, schema)
