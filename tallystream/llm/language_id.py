"""Language ID by rank order of n-grams.

A profile lists a language's most frequent character n-grams (1 to 3 letters, word borders
included) in order. A document's own most frequent n-grams are ranked likewise, and the
out-of-place distance sums how far each lies from its rank in the profile, `TOP` where the
profile lacks it. The language of the least distance wins, the first by name of equals.

Counting runs over all learning rows: each task sums what it reads, Spark adds the sums, and
the driver holds `TOP` n-grams a language. N-grams are known by 41-bit hashes.

Cases: a NULL text or one without letters is `und` with score 0, and so is every text if
nothing could be learned; NULL languages are not learned; texts count whole, in slices of some
MB; repeated rows count as often as they occur; equal counts rank by hash; an empty table
gives an empty table; other columns are kept, those with the names of the outputs are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallystream.llm.columns import map_arrow, plain_text, replaced, small_batches
from tallystream.llm.grams import grams, letters

ORDERS = (1, 2, 3)
TOP = 300
BITS = 41
HELD = 1 << 20  # distinct (language, n-gram) a task sums before it hands them on
UNKNOWN = "und"


def counted(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows, n-grams and counts of a batch, sorted by row and n-gram."""
    points, rows = letters(texts)
    keys = []
    for n in ORDERS:
        row, h = grams(points, rows, n, solid=True)
        keys.append(row << BITS | (h >> np.uint64(64 - BITS)).astype(np.int64))
    found, count = np.unique(np.concatenate(keys), return_counts=True)
    return found >> BITS, found & (1 << BITS) - 1, count


@dataclass
class Profiles:
    """Languages by name; n-grams in order, and their ranks, a column per language."""

    languages: list[str]
    grams: np.ndarray
    ranks: np.ndarray


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys, place = np.unique(keys, return_inverse=True)
    return keys, np.bincount(place, counts, len(keys)).astype(np.int64)


def learn(docs: DataFrame, text: str = "text", lang: str = "lang", top: int = TOP) -> Profiles:
    """Profiles from all rows with a language."""

    def run(batches):
        names: list[str] = []
        keys, counts = [], []

        def flush():
            if not keys:
                return None
            key, count = summed(np.concatenate(keys), np.concatenate(counts))
            keys.clear(), counts.clear()
            language = pa.array(names, pa.string()).take(pa.array(key >> BITS))
            return pa.RecordBatch.from_arrays(
                [language, pa.array(key & (1 << BITS) - 1), pa.array(count)], names=["lang", "gram", "n"])

        for batch in small_batches(batches, text):
            own = batch.column(lang).to_pylist()
            new = sorted(set(own) - set(names))
            if len(names) + len(new) > 1 << 20 and (out := flush()) is not None:
                yield out
                names = []
                new = sorted(set(own))
            names += new
            number = {name: i for i, name in enumerate(names)}
            row, gram, count = counted(batch.column(text))
            key, count = summed(np.array([number[x] for x in own], np.int64)[row] << BITS | gram, count)
            keys.append(key), counts.append(count)
            if sum(map(len, keys)) > HELD:
                key, count = summed(np.concatenate(keys), np.concatenate(counts))
                keys[:], counts[:] = [key], [count]
                if len(key) > HELD // 2:
                    yield flush()
        if (out := flush()) is not None:
            yield out

    rows = plain_text(docs.where(F.col(lang).isNotNull()).select(F.col(lang).cast("string").alias(lang), text), text)
    sums = map_arrow(rows, run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram")) - 1
    best = sums.withColumn("rank", rank).where(F.col("rank") < top).select("lang", "gram", "rank").collect()
    languages = sorted({r.lang for r in best})
    known = np.array(sorted({r.gram for r in best}), np.int64)
    ranks = np.full((len(known), len(languages)), top, np.int64)
    if best:
        ranks[np.searchsorted(known, [r.gram for r in best]), [languages.index(r.lang) for r in best]] = [r.rank for r in best]
    return Profiles(languages, known, ranks)


def distances(texts: pa.Array, profiles: Profiles, top: int) -> tuple[np.ndarray, np.ndarray]:
    """Out-of-place distance of each text to each language, and how many n-grams it ranks."""
    n = len(texts)
    row, gram, count = counted(texts)
    # Most frequent first, equal counts by n-gram; no text has 2^40 letters, no slice 2^23 rows.
    order = np.argsort(row << 40 | (1 << 40) - 1 - count, kind="stable")
    row, gram = row[order], gram[order]
    rank = np.arange(len(row)) - np.searchsorted(row, row)
    row, gram, rank = row[rank < top], gram[rank < top], rank[rank < top]
    size = np.bincount(row, minlength=n)
    out = np.repeat(size[:, None] * top, len(profiles.languages), 1)
    if len(profiles.grams):
        place = np.minimum(np.searchsorted(profiles.grams, gram), len(profiles.grams) - 1)
        hit = profiles.grams[place] == gram
        row, place, rank = row[hit], place[hit], rank[hit]
        for k in range(len(profiles.languages)):
            known = profiles.ranks[place, k]
            moved = np.where(known < top, np.minimum(np.abs(known - rank), top), top) - top
            out[:, k] += np.bincount(row, moved, n).astype(np.int64)
    return out, size


def identify(docs: DataFrame, profiles: Profiles, text: str = "text", top: int = TOP) -> DataFrame:
    """Add lang_pred and score, 1 less the distance's share of the largest possible."""

    def run(batches):
        for batch in small_batches(batches, text):
            out, size = distances(batch.column(text), profiles, top)
            names, score = np.full(batch.num_rows, UNKNOWN, object), np.zeros(batch.num_rows)
            if profiles.languages:
                best, some = out.argmin(1), size > 0
                names[some] = np.array(profiles.languages, object)[best[some]]
                score[some] = 1 - out[some, best[some]] / (size[some] * top)
            made = replaced(batch, "lang_pred", pa.array(names, pa.string()))
            yield replaced(made, "score", pa.array(score))

    df = plain_text(docs, text)
    fields = [f for f in df.schema.fields if f.name not in ("lang_pred", "score")]
    schema = T.StructType([*fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return map_arrow(df, run, schema)
