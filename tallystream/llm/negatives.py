"""Hard negatives of anchors: clusters of anchors share one list of candidates, ordered by an
angular bound.

An anchor's positives are its best rows of the same label; for each of them, the best rows of other
labels whose score lies between a share of the positive's score and that score are its hard
negatives. Scores are exact inner products of integer vectors.

1. Centres come from at most `SAMPLE` anchors (the only sampling: centres change how early a walk
   ends, not what it finds). Every anchor belongs to its nearest centre; a cluster's radius is the
   widest angle between the centre and a member. There are at most `CENTRES` clusters; a large one is
   cut into chunks of about `CHUNK` anchors, which use the same list.
2. A cluster's list is all candidates by falling bound |row| cos(max(0, angle to the centre - radius)):
   times its own norm, no member's score is above it. The list is never written whole: its bounds'
   quantiles cut it into `SHARES`, and only a share that a member still needs is dealt out.
3. Members walk the list, share by share and inside a task block by block, while the bound
   reaches what they still look for: the last of the positives found so far, and for each positive
   the last of its negatives, or the lower end of its range. A member whose certificate holds for the
   rest of the list drops out, and clusters without members on the way get no more rows.

A task meets one chunk of anchors and one slice of a share, both of bounded size; results are merged
by a window per anchor and positive, of at most a few rows a slice.

Cases: rows with a NULL label or a vector that is NULL or holds NULL or non-finite components take no
part; vectors of another length than the anchor's are no candidates of it, anchors of lengths without a centre
walk by norm alone; a row is no positive of its own id; equal scores go to the smaller id, NULL ids first;
repeated candidate rows count each, repeated anchors once; positives without negatives, and anchors
without positives, have no rows; scores beyond a long are cut to its range; empty tables give an
empty table; other columns are not carried.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallystream.llm.columns import importable, map_arrow
from tallystream.llm.components import written
from tallystream.llm.shared_files import join

CENTRES, SAMPLE, PER_CENTRE = 64, 4096, 128
CHUNK, SLICE, BLOCK = 1 << 10, 1 << 14, 512
SHARES = (1 / 16, 1 / 4)  # the rest of the list is the last share
NO_CENTRE = -1
NULL_ID = LEAST = -(1 << 63)
MOST = (1 << 63) - 1
BEST = "anchor_id long, anchor_hash long, goal int, vec_id long, score long"


def unit(vectors: np.ndarray) -> np.ndarray:
    vectors = vectors.astype(float)
    norm = np.sqrt((vectors**2).sum(-1, keepdims=True))
    return np.divide(vectors, norm, out=np.zeros_like(vectors), where=norm > 0)


def find_centres(anchors: DataFrame) -> list[np.ndarray]:
    """Unit vectors that clusters of anchors lie around, by spherical k-means over a bounded sample."""
    count = min(CENTRES, -(-anchors.count() // PER_CENTRE))
    taken = anchors.orderBy("anchor_hash", "anchor_id").limit(SAMPLE).select("vector").collect()
    by_length: dict[int, list] = {}
    for row in taken:
        if any(row.vector):
            by_length.setdefault(len(row.vector), []).append(row.vector)
    centres: list[np.ndarray] = []
    for found in sorted(by_length.values(), key=len, reverse=True):
        points = unit(np.array(found, float))
        own = points[: max(1, count * len(found) // len(taken))].copy()
        for _ in range(8):
            nearest = (points @ own.T).argmax(1)
            sums = np.stack([points[nearest == c].sum(0) for c in range(len(own))])
            own = np.where((sums != 0).any(1, keepdims=True), unit(sums), own)
        centres += list(own)
    return centres[:CENTRES]


def same_length(vectors: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """Rows of each length, and their vectors as a matrix."""
    lengths = np.diff(vectors.offsets.to_numpy())
    begin, flat = vectors.offsets.to_numpy()[:-1], vectors.values.to_numpy()
    return [(at := np.flatnonzero(lengths == n), flat[begin[at][:, None] + np.arange(n)]) for n in np.unique(lengths)]


def angles(vectors: np.ndarray, centres: list[np.ndarray]) -> tuple[list[int], np.ndarray]:
    """Centres of the vectors' length, and the angle of each vector to each."""
    fit = [c for c, x in enumerate(centres) if len(x) == vectors.shape[1]]
    if not fit:
        return fit, np.zeros((len(vectors), 0))
    return fit, np.arccos(np.clip(unit(vectors) @ np.stack([centres[c] for c in fit]).T, -1, 1))


def members_of(anchors: DataFrame, centres: list[np.ndarray]) -> DataFrame:
    """anchors with cluster, angle to its centre, and norm."""

    def run(batches):
        for batch in batches:
            cluster, angle, norm = (np.zeros(batch.num_rows, t) for t in (np.int32, float, float))
            for at, vectors in same_length(batch.column("vector")):
                fit, apart = angles(vectors, centres)
                norm[at] = np.sqrt((vectors.astype(float) ** 2).sum(1))
                best = apart.argmin(1) if fit else None
                cluster[at] = np.array(fit, np.int32)[best] if fit else NO_CENTRE
                angle[at] = apart[np.arange(len(at)), best] if fit else 0
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cluster), pa.array(angle), pa.array(norm)],
                                             names=[*batch.schema.names, "cluster", "angle", "norm"])

    kind = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in anchors.schema.fields)
    return map_arrow(anchors, run, f"{kind}, cluster int, angle double, norm double")


class Lists:
    """The clusters' lists: centres, radii, chunks, and the bounds at which their shares end."""

    def __init__(self, centres: list[np.ndarray], members: DataFrame, candidates: DataFrame):
        stats = members.groupBy("cluster").agg(F.max("angle").alias("radius"), F.count("*").alias("n")).collect()
        self.centres = centres
        # A little wider than measured: angles are rounded.
        self.radius = {r.cluster: r.radius + 1e-6 for r in stats}
        self.chunks = {r.cluster: -(-r.n // CHUNK) for r in stats}
        self.slices = max(1, -(-candidates.count() // SLICE))
        bounds = self.bounded(candidates.select("vector"), {c: (-np.inf, np.inf) for c in self.radius}, False)
        cuts = bounds.groupBy("cluster").agg(F.percentile_approx("bound", [1 - s for s in SHARES], 2000).alias("cuts")).collect()
        self.cuts = {c: [-np.inf] for c in self.radius} | {r.cluster: [*r.cuts, -np.inf] for r in cuts}

    def bounded(self, candidates: DataFrame, wanted: dict[int, tuple[float, float]], whole: bool = True) -> DataFrame:
        """A row for each candidate and cluster whose bound lies in [low, high) of the cluster."""
        centres, radius = self.centres, self.radius

        def run(batches):
            for batch in batches:
                for at, vectors in same_length(batch.column("vector")):
                    norm = np.sqrt((vectors.astype(float) ** 2).sum(1))
                    fit, apart = angles(vectors, centres)
                    for c, (low, high) in wanted.items():
                        if c == NO_CENTRE and not fit:
                            bound = norm
                        elif c in fit:
                            bound = norm * np.cos(np.maximum(0, apart[:, fit.index(c)] - radius[c]))
                        else:
                            continue
                        taken = np.flatnonzero((bound >= low) & (bound < high))
                        columns = [x.take(pa.array(at[taken])) for x in batch.columns] if whole else []
                        names = batch.schema.names if whole else []
                        yield pa.RecordBatch.from_arrays(
                            [*columns, pa.array(np.full(len(taken), c, np.int32)), pa.array(bound[taken])], names=[*names, "cluster", "bound"])

        kind = "".join(f"{f.name} {f.dataType.simpleString()}, " for f in candidates.schema.fields) if whole else ""
        return map_arrow(candidates, run, f"{kind}cluster int, bound double")

    def share(self, turn: int, clusters: list[int]) -> dict[int, tuple[float, float]]:
        return {c: (self.cuts[c][turn], self.cuts[c][turn - 1] if turn else np.inf) for c in clusters}


def by_cluster(values: dict, kind: str) -> Column:
    """The value of the row's cluster."""
    if not values:
        return F.lit(None).cast(kind)
    return F.create_map(*(F.lit(x) for pair in values.items() for x in pair))[F.col("cluster")].cast(kind)


def walk_cell(vectors, own, label, norm, goals, floors, rows, ids, labels, bounds, keep, low, high):
    """Best (anchor, goal, candidate, score) of one chunk of anchors and one slice of a list.
    goals: None for positives, else scores of the positives, one column each, and floors what the
    scores must reach; both NaN (floats) or None (objects) where there is none."""
    order = np.lexsort((ids, -bounds))
    rows, ids, labels, bounds = rows[order], ids[order], labels[order], bounds[order]
    wide = vectors.dtype == object
    width = floors.shape[1]
    floors = np.where(floors == None, LEAST, floors) if wide else np.where(np.isnan(floors), -np.inf, floors)  # noqa: E711
    best = tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, vectors.dtype))
    for first in range(0, len(rows), BLOCK):
        reach = norm * bounds[first]
        live = np.flatnonzero((reach + 1e-9 * np.abs(reach) + 1 >= floors.min(1).astype(float)))
        if not len(live):
            break
        part = slice(first, first + BLOCK)
        score = vectors[live] @ rows[part].T
        if wide:
            score = np.minimum(np.maximum(score, LEAST), MOST)
        same = label[live][:, None] == labels[part]
        found = []
        for g in range(width):
            fits = (score >= floors[live, g][:, None]).astype(bool)
            if goals is None:
                fits &= same & (own[live][:, None] != ids[part])
            else:
                goal = goals[live, g][:, None]
                none = (goal == None) if wide else np.isnan(goal)  # noqa: E711
                goal = np.where(none, 0, goal)
                fits &= ~same & ~none & (low * goal <= 100 * score).astype(bool) & (100 * score <= high * goal).astype(bool)
            a, c = np.nonzero(fits)
            found.append((live[a], np.full(len(a), g), ids[part][c], score[a, c]))
        if not any(len(f[0]) for f in found):
            continue
        anchor, goal, name, value = (np.concatenate([b, *x]) for b, x in zip(best, zip(*found)))
        rank = np.unique(value, return_inverse=True)[1]
        order = np.lexsort((name, -rank, goal, anchor))
        anchor, goal, name, value = anchor[order], goal[order], name[order], value[order]
        group = anchor * width + goal
        starts = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
        place = np.arange(len(group)) - np.repeat(starts, np.diff(np.append(starts, len(group))))
        last = place == keep - 1
        floors[anchor[last], goal[last]] = np.maximum(floors[anchor[last], goal[last]], value[last])
        best = tuple(x[place < keep] for x in (anchor, goal, name, value))
    return best


def walk(candidates: DataFrame, members: DataFrame, lists: Lists, keep: int, low: int, high: int, scratch: str) -> DataFrame:
    """The best `keep` (anchor_id, anchor_hash, goal, vec_id, score) of every member and goal.
    members: anchor_id, anchor_hash, label, vector, length, cluster, norm, goals (NULL: rows of the
    same label) and floors, one for each goal: a score below which nothing is looked for, or NULL."""
    spark, best = candidates.sparkSession, None
    keys = ("length", "cluster", "chunk", "slice")
    members = members.withColumn("chunk", F.pmod(F.xxhash64("anchor_id", "anchor_hash"), by_cluster(lists.chunks, "long")).cast("int"))

    def cell(asked: pa.Table, stored: pa.Table) -> pa.Table:
        found = tuple(np.zeros(0, np.int64) for _ in range(4))
        own = hashes = np.zeros(0, np.int64)
        if asked.num_rows and stored.num_rows:
            take = lambda t, c: t.column(c).combine_chunks().to_numpy(zero_copy_only=False)
            matrix = lambda t: t.column("vector").combine_chunks().flatten().to_numpy().reshape(t.num_rows, asked["length"][0].as_py())
            vectors, rows = matrix(asked), matrix(stored)
            most = lambda x: int(np.abs(x.astype(float)).max(initial=0)) + 1
            wide = most(vectors) * most(rows) * max(1, rows.shape[1]) * 100 >= 1 << 53
            floors, goals = asked.column("floors").to_pylist(), asked.column("goals").to_pylist()
            kind, gap = (object, None) if wide else (float, np.nan)
            table = lambda x: np.array([[gap if v is None else v for v in r] + [gap] * (max(map(len, x)) - len(r)) for r in x], kind)
            goals = None if goals[0] is None else table(goals)
            floors = table(floors)
            if goals is not None:  # goals that are not there look for nothing
                floors = np.where((goals == None) if wide else np.isnan(goals), float(MOST) if not wide else MOST, floors)  # noqa: E711
            own, hashes = take(asked, "anchor_id"), take(asked, "anchor_hash")
            found = walk_cell(vectors.astype(kind), own, take(asked, "label"), take(asked, "norm"), goals, floors, rows.astype(kind),
                              take(stored, "vec_id"), take(stored, "label"), take(stored, "bound"), keep, low, high)
        return pa.table({"anchor_id": pa.array(own[found[0]]), "anchor_hash": pa.array(hashes[found[0]]),
                         "goal": pa.array(found[1].astype(np.int32)), "vec_id": pa.array(found[2]),
                         "score": pa.array([int(s) for s in found[3]], pa.int64())})

    state = members
    for turn in range(len(SHARES) + 1):
        if turn:
            # What is left of a list scores at most its bound times a member's norm.
            reach = F.col("norm") * by_cluster({c: x[turn - 1] for c, x in lists.cuts.items() if len(x) >= turn}, "double")
            state = state.where(F.exists("floors", lambda f: f.isNull() | (reach + 1e-9 * F.abs(reach) + 1 >= f)))
        state = written(state, join(scratch, f"members-{turn}"))
        clusters = [r.cluster for r in state.select("cluster").distinct().collect() if len(lists.cuts[r.cluster]) > turn]
        if not clusters:
            break
        every = F.explode(F.sequence(F.lit(0), by_cluster(lists.chunks, "int") - 1)).alias("chunk")
        dealt = lists.bounded(candidates, lists.share(turn, clusters)).select(
            "*", F.size("vector").alias("length"), F.pmod(F.xxhash64("vec_id", "vector"), F.lit(lists.slices)).cast("int").alias("slice"), every)
        asked = state.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(lists.slices - 1))))
        found = asked.groupBy(*keys).cogroup(dealt.groupBy(*keys)).applyInArrow(cell, BEST)
        found = found if best is None else found.unionByName(best)
        rank = F.row_number().over(Window.partitionBy("anchor_id", "anchor_hash", "goal").orderBy(F.desc("score"), "vec_id"))
        best = written(found.withColumn("rank", rank).where(F.col("rank") <= keep).drop("rank"), join(scratch, f"best-{turn}"))
        if turn < len(SHARES):
            full = best.groupBy("anchor_id", "anchor_hash", "goal").agg(F.count("*").alias("n"), F.min("score").alias("last"))
            full = full.where(F.col("n") >= keep).groupBy("anchor_id", "anchor_hash").agg(
                F.map_from_entries(F.collect_list(F.struct("goal", "last"))).alias("lasts"))
            state = state.join(full, ["anchor_id", "anchor_hash"], "left").withColumn("floors", F.transform(
                "floors", lambda f, g: F.coalesce(F.try_element_at("lasts", g), f))).drop("lasts")
    return best if best is not None else spark.createDataFrame([], BEST)


def mine(rows: DataFrame, anchors: DataFrame, scratch: str, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score of the first negatives
    of each anchor's positives: rows of other labels that score between low and high percent of the
    positive. rows and anchors: vec_id, label, vector (array<long>). scratch: a folder all executors
    share, not used before."""
    importable(rows.sparkSession)
    use = "vector is not null and label is not null"
    rows = rows.where(use).select(F.coalesce("vec_id", F.lit(NULL_ID)).alias("vec_id"), F.col("label").cast("long").alias("label"), "vector")
    rows = written(rows, join(scratch, "rows"))
    anchors = anchors.where(use).select(
        F.coalesce("vec_id", F.lit(NULL_ID)).alias("anchor_id"), F.xxhash64("label", "vector").alias("anchor_hash"),
        F.col("label").cast("long").alias("label"), "vector", F.size("vector").alias("length"))
    anchors = written(anchors.dropDuplicates(["anchor_id", "anchor_hash"]), join(scratch, "anchors"))
    centres = find_centres(anchors)
    members = written(members_of(anchors, centres), join(scratch, "members"))
    lists = Lists(centres, members, rows)

    no_goal = {"goals": F.lit(None).cast("array<long>"), "floors": F.array(F.lit(None).cast("long"))}
    near = walk(rows, members.withColumns(no_goal), lists, positives, low, high, join(scratch, "positives"))
    order = Window.partitionBy("anchor_id", "anchor_hash").orderBy(F.desc("score"), "vec_id")
    near = near.select("anchor_id", "anchor_hash", (F.row_number().over(order) - 1).alias("goal"),
                       F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    near = written(near, join(scratch, "near"))
    goals = near.groupBy("anchor_id", "anchor_hash").agg(F.sort_array(F.collect_list(F.struct("goal", "positive_score")))["positive_score"].alias("goals"))
    # Nothing lies between the shares of a score below zero, if low < high.
    least = lambda s: F.when(s < 0, F.lit(MOST if low < high else LEAST)).otherwise(
        F.ceil(s.cast("decimal(38,0)") * low / 100).cast("long"))
    asked = members.join(goals, ["anchor_id", "anchor_hash"]).withColumn("floors", F.transform("goals", least))
    far = walk(rows, asked, lists, negatives, low, high, join(scratch, "negatives"))
    rank = F.row_number().over(Window.partitionBy("anchor_id", "anchor_hash", "goal").orderBy(F.desc("score"), "vec_id"))
    far = far.withColumn("rank", rank)
    back = lambda c, name: F.nullif(F.col(c), F.lit(NULL_ID)).alias(name)
    return far.join(near, ["anchor_id", "anchor_hash", "goal"]).select(
        back("anchor_id", "anchor_id"), back("positive_id", "positive_id"), "rank", back("vec_id", "negative_id"),
        "positive_score", F.col("score").alias("negative_score"))
