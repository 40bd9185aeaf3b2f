"""Hard negatives by clustered anchors that share sorted lists of candidates.

Anchors are clustered by direction. Under the angle between a candidate and the centroid, less the radius of the cluster,
no member can see the candidate at a smaller angle; the candidate's length times the cosine of that is its bound.
A cluster sorts the candidates by this bound once, and every member walks the list from the top, some
candidates at a time, until the next bound times its own length is below what it still looks for: then no
later candidate can count, and the walk ends, certified.

Two walks: the first finds each anchor's best rows of its own label, its positives; the second, for each positive,
the best rows of another label whose score lies in the positive's window.

Candidates are dealt by hash into blocks of about ``block_rows``, and anchors, fewer by far, go to every block, sorted
by cluster: a task holds one block and one run of members, whatever the size of a cluster or a label. Results of
blocks are merged by rank. The number of scores grows as anchors times rows, less what the bounds save; that
is what the search asks for.

Centroids (``most_clusters`` at most) are fitted on ``fit_rows`` anchors; they decide how long walks are, never what they find.

Defined results: rows without label or vector, or with a null or non-finite component take no part; shorter vectors count as
padded with zeros; repeated rows (same id, label, vector) count once; rows that share an id are rows of their own, but
none is a positive of another; a null id is no anchor, and comes last among ties; an anchor without a positive, or a
positive without a negative, has no rows; a positive with a score below zero has an empty window; tables without anchors
give an empty result. Columns not asked for are not read. Scores must stay within 2^44 in size, or the run stops.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from goldpan.storage import materialize

CHUNK = 1_024  # candidates that a walk scores at once
MEMBERS = 256  # members that walk together
NO_ID = 2**63 - 1  # stands for a null id: last among ties
RANK_BITS = 18
_LEAST = -(2**62)
_SLACK = 1e-7  # radians, for the rounding of angles


@dataclass(frozen=True)
class ScoreWindow:
    """Negatives n of a positive p: ``low`` * p <= 100 * n <= ``high`` * p."""

    low: int = 50
    high: int = 95


def prepared(vectors: DataFrame, is_anchor: Column, scale: int) -> DataFrame:
    """vec_id, label, q (scaled whole components), anchor and row_hash (tells rows of one id apart); distinct rows that take part."""
    x = F.col("embedding")
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v.cast("double")) == float("inf")))
    rows = vectors.filter(F.col("label").isNotNull() & x.isNotNull()).filter(~bad)
    return rows.select(
        F.coalesce(F.col("vec_id").cast("long"), F.lit(NO_ID)).alias("vec_id"),
        F.col("label").cast("long").alias("label"),
        F.transform(x, lambda v: F.floor(v.cast("double") * scale).cast("long")).alias("q"),
        F.coalesce(is_anchor, F.lit(False)).alias("anchor"),
    ).dropDuplicates(["vec_id", "label", "q"]).withColumn("row_hash", F.xxhash64("label", "q"))


def matrix(column: pa.ListArray, dims: int) -> np.ndarray:
    """Lists of numbers as rows, padded with zeros."""
    out = np.zeros((len(column), dims))
    lengths = column.value_lengths().to_numpy()
    row = np.repeat(np.arange(len(column)), lengths)
    out[row, np.arange(len(row)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = column.flatten().to_numpy()
    return out


def directions(m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unit rows and lengths; a row of zeros keeps them."""
    length = np.sqrt((m * m).sum(axis=1))
    return m / np.maximum(length, 1e-300)[:, None], length


def centroids(sample: np.ndarray, k: int, rounds: int = 6) -> np.ndarray:
    """Unit centroids of spherical k-means, from evenly spaced rows of the sample on."""
    unit, _ = directions(sample)
    at = unit[np.linspace(0, len(unit) - 1, k).astype(int)]
    for _ in range(rounds):
        nearest = (unit @ at.T).argmax(axis=1)
        sums = np.zeros_like(at)
        np.add.at(sums, nearest, unit)
        moved, length = directions(sums)
        at = np.where(length[:, None] > 0, moved, at)
    return at


def angles(unit: np.ndarray, centroid: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(unit @ centroid, -1.0, 1.0))


class Candidates:
    """One block of candidates; sorts them for a cluster and lets its members walk."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, q: np.ndarray):
        order = np.lexsort((labels, ids))
        self.ids, self.labels, self.q = ids[order], labels[order], q[order]
        self.unit, self.length = directions(self.q)
        if len(ids) > 1 << RANK_BITS:
            raise ValueError("a block holds too many rows")
        # Added to a shifted score: of equal scores the smaller id is the larger key.
        self.tie = (1 << RANK_BITS) - 1 - np.arange(len(ids))
        self.cluster: int | None = None

    def sort_for(self, cluster: int, centroid: np.ndarray, radius: float) -> None:
        if self.cluster == cluster:
            return
        self.cluster = cluster
        apart = np.maximum(0.0, angles(self.unit, centroid) - radius - _SLACK)
        bound = self.length * np.cos(np.minimum(apart, np.pi))
        self.order = np.argsort(-bound, kind="stable")
        self.bound = bound[self.order]

    def keys(self, members: np.ndarray, at: np.ndarray) -> np.ndarray:
        scores = members @ self.q[at].T  # whole numbers below 2^44: exact
        return scores.astype(np.int64) * (1 << RANK_BITS) + self.tie[at]

    def walk(
        self,
        list_: np.ndarray,
        bounds: np.ndarray,
        members: np.ndarray,
        meet: Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray],
    ) -> None:
        """Score the list for all members until each one's bound is below the score that ``meet`` still asks for.

        ``meet(who, at, keys)`` takes keys of some members (rows) and candidates, and returns for each the least score that may still count.
        """
        length = np.sqrt((members * members).sum(axis=1))
        if length.max(initial=0.0) * self.length.max(initial=0.0) >= 2.0**44:
            raise ValueError("scores beyond 2^44")
        slack = 1e-9 * length * self.length.max(initial=0.0) + 1e-6
        who = np.arange(len(members))
        for begin in range(0, len(list_), CHUNK):
            at = list_[begin : begin + CHUNK]
            asked = meet(who, at, self.keys(members[who], at))
            if begin + CHUNK < len(list_):
                who = who[length[who] * bounds[begin + CHUNK] + slack[who] >= asked]
                if not len(who):
                    return

    def positives(self, ids: np.ndarray, labels: np.ndarray, members: np.ndarray, k: int) -> np.ndarray:
        """Keys of each member's k best other rows of its label, the best first; ``_LEAST`` where there are fewer."""
        best = np.full((len(members), k), _LEAST, np.int64)
        for label in np.unique(labels).tolist():
            mine = np.flatnonzero(labels == label)
            same = self.labels[self.order] == label

            def meet(who: np.ndarray, at: np.ndarray, keys: np.ndarray, mine: np.ndarray = mine) -> np.ndarray:
                keys = np.where(self.ids[at] == ids[mine[who]][:, None], _LEAST, keys)
                best[mine[who]] = _largest(np.concatenate([best[mine[who]], keys], axis=1), k)
                return best[mine[who], -1] >> RANK_BITS

            self.walk(self.order[same], self.bound[same], members[mine], meet)
        return best

    def negatives(self, labels: np.ndarray, members: np.ndarray, low: np.ndarray, high: np.ndarray, k: int) -> np.ndarray:
        """Keys of the k best rows of another label in each window (``low`` to ``high``, a column for each positive)."""
        best = np.full((*low.shape, k), _LEAST, np.int64)

        def meet(who: np.ndarray, at: np.ndarray, keys: np.ndarray) -> np.ndarray:
            scores = np.where(self.labels[at] == labels[who][:, None], _LEAST, keys >> RANK_BITS)
            for j in range(low.shape[1]):
                inside = (scores >= low[who, j, None]) & (scores <= high[who, j, None])
                some = np.flatnonzero(inside.any(axis=1))
                if len(some):
                    new = np.where(inside[some], keys[some], _LEAST)
                    best[who[some], j] = _largest(np.concatenate([best[who[some], j], new], axis=1), k)
            return np.maximum(best[who, :, -1] >> RANK_BITS, low[who]).min(axis=1)

        self.walk(self.order, self.bound, members, meet)
        return best


def _largest(keys: np.ndarray, k: int) -> np.ndarray:
    """The k largest of each row, the largest first."""
    return -np.sort(np.partition(-keys, k - 1, axis=1)[:, :k], axis=1)


def _clustered(anchors: DataFrame, dims: int, at: np.ndarray) -> DataFrame:
    sent = anchors.sparkSession.sparkContext.broadcast(at)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            unit, _ = directions(matrix(batch.column("q"), dims))
            close = unit @ sent.value.T
            cluster = close.argmax(axis=1)
            angle = np.arccos(np.clip(close[np.arange(len(unit)), cluster], -1.0, 1.0))
            columns = [*batch.columns, pa.array(cluster.astype(np.int32)), pa.array(angle)]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "row_hash", "label", "q", "cluster", "angle"])

    rows = anchors.select("vec_id", "row_hash", "label", "q")
    return rows.mapInArrow(run, "vec_id long, row_hash long, label long, q array<long>, cluster int, angle double")


@dataclass
class _Blocks:
    """Candidates in blocks, and what their walks need."""

    rows: DataFrame
    blocks: int
    dims: int
    centroids: np.ndarray
    radius: dict[int, float]

    def walked(self, anchors: DataFrame, walk: Callable[..., Iterator[tuple]], schema: str) -> DataFrame:
        """Send the anchors (vec_id, row_hash, label, q, cluster, positives) to every block.

        ``walk(candidates, ids, labels, q, positives)`` gets a block, sorted for the cluster, and a run of members; it returns
        columns, the first of them the members' places, and rows begin with those members' anchor_id and anchor_hash.
        """
        sent = self.rows.sparkSession.sparkContext.broadcast((self.dims, self.centroids, self.radius))
        columns = ["block", "cluster", "vec_id", "row_hash", "label", "q", "positives"]
        held = self.rows.select(
            F.pmod(F.xxhash64("vec_id", "label", "q"), F.lit(self.blocks)).cast("int").alias("block"),
            F.lit(-1).alias("cluster"),
            "vec_id",
            "row_hash",
            "label",
            "q",
            F.lit(None).cast("array<long>").alias("positives"),
        )
        every = F.explode(F.sequence(F.lit(0), F.lit(self.blocks - 1))).alias("block")
        met = held.unionByName(anchors.select("*", every).select(*columns))
        met = met.repartition("block").sortWithinPartitions("block", "cluster")
        names, kinds = zip(*(f.split() for f in schema.split(", ")), strict=True)
        types = [{"long": pa.int64(), "int": pa.int32()}[k] for k in kinds]

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            dims, centroids_, radius = sent.value
            candidates, parts, current = None, [], None
            for batch in batches:
                block, cluster = batch.column("block").to_numpy(), batch.column("cluster").to_numpy()
                q = matrix(batch.column("q"), dims)
                ids, hashes, labels = (batch.column(c).to_numpy() for c in ("vec_id", "row_hash", "label"))
                cuts = np.flatnonzero((np.diff(block) != 0) | (np.diff(cluster) != 0)) + 1
                for a, b in zip([0, *cuts], [*cuts, len(block)], strict=True):
                    if block[a] != current:
                        candidates, parts, current = None, [], block[a]
                    if cluster[a] < 0:
                        parts.append((ids[a:b], labels[a:b], q[a:b]))
                        continue
                    if candidates is None:
                        if not parts:
                            continue  # a block without candidates
                        candidates = Candidates(*(np.concatenate(c) for c in zip(*parts, strict=True)))
                    c = int(cluster[a])
                    candidates.sort_for(c, centroids_[c], radius[c])
                    for begin in range(a, b, MEMBERS):
                        end = min(b, begin + MEMBERS)
                        some = batch.column("positives").slice(begin, end - begin)
                        row, *found = walk(candidates, ids[begin:end], labels[begin:end], q[begin:end], some)
                        found = [ids[begin:end][row], hashes[begin:end][row], *found]
                        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(found, types, strict=True)], list(names))

        return met.mapInArrow(run, schema)


def _fitted(rows: DataFrame, anchors: DataFrame, block_rows: int, members: int, most_clusters: int, fit_rows: int) -> tuple[_Blocks, DataFrame] | None:
    size = rows.agg(F.count(F.lit(1)).alias("rows"), F.max(F.size("q")).alias("dims"), F.count_if("anchor").alias("anchors")).first()
    if not size.anchors:
        return None
    dims = max(1, size.dims)
    sample = anchors.orderBy(F.xxhash64("vec_id", "label", "q")).limit(fit_rows).select("q").toArrow()  # bounded
    k = min(most_clusters, ceil(size.anchors / members), len(sample))
    at = centroids(matrix(sample["q"].combine_chunks(), dims), k)
    clustered = materialize(_clustered(anchors, dims, at), "anchors")
    radius = {r.cluster: r.radius for r in clustered.groupBy("cluster").agg(F.max("angle").alias("radius")).collect()}  # k rows
    return _Blocks(rows, ceil(size.rows / block_rows), dims, at, radius), clustered.drop("angle")


def mine(
    vectors: DataFrame,
    is_anchor: Column,
    positives: int = 5,
    negatives: int = 3,
    window: ScoreWindow = ScoreWindow(),
    scale: int = 256,
    block_rows: int = 8_192,
    members: int = 128,
    most_clusters: int = 1_024,
    fit_rows: int = 8_192,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score of ``vectors`` (vec_id, label, embedding).

    ``members`` is the size of a cluster that the number of centroids aims at. Larger blocks make fewer copies of the anchors.
    """
    spark = vectors.sparkSession
    rows = materialize(prepared(vectors, is_anchor, scale), "vectors")
    fitted = _fitted(rows, rows.filter("anchor"), block_rows, members, most_clusters, fit_rows)
    if fitted is None:
        return _none(spark)
    blocks, anchors = fitted

    def walk_positives(block: Candidates, ids: np.ndarray, labels: np.ndarray, q: np.ndarray, _: pa.Array) -> list[np.ndarray]:
        best = block.positives(ids, labels, q, positives)
        row, place = np.nonzero(best > _LEAST)
        key = best[row, place]
        return [row, block.ids[_who(key)], key >> RANK_BITS]

    found = blocks.walked(
        anchors.withColumn("positives", F.lit(None).cast("array<long>")),
        walk_positives,
        "anchor_id long, anchor_hash long, positive_id long, positive_score long",
    )
    anchor = ["anchor_id", "anchor_hash"]
    order = Window.partitionBy(*anchor).orderBy(F.desc("positive_score"), "positive_id")
    best = materialize(found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= positives), "positives")
    by_anchor = best.groupBy(*anchor).agg(F.array_sort(F.collect_list(F.struct("place", "positive_score"))).alias("p"))
    second = anchors.join(by_anchor, (F.col("vec_id") == F.col("anchor_id")) & (F.col("row_hash") == F.col("anchor_hash")))
    second = second.select("vec_id", "row_hash", "label", "q", "cluster", F.col("p.positive_score").alias("positives"))

    def walk_negatives(block: Candidates, ids: np.ndarray, labels: np.ndarray, q: np.ndarray, given: pa.Array) -> list[np.ndarray]:
        lengths = given.value_lengths().to_numpy()
        there = np.arange(lengths.max()) < lengths[:, None]
        scores = np.zeros(there.shape, np.int64)
        scores[there] = given.flatten().to_numpy()
        low, high = -((-window.low * scores) // 100), (window.high * scores) // 100
        low = np.where(there & (low <= high), low, 2**61)  # an empty window asks for nothing
        best_ = block.negatives(labels, q, low, high, negatives)
        row, place, nth = np.nonzero(best_ > _LEAST)
        key = best_[row, place, nth]
        return [row, (place + 1).astype(np.int32), block.ids[_who(key)], key >> RANK_BITS]

    met = blocks.walked(
        second, walk_negatives, "anchor_id long, anchor_hash long, place int, negative_id long, negative_score long"
    )
    by = ["anchor_id", "anchor_hash", "place"]
    order = Window.partitionBy(*by).orderBy(F.desc("negative_score"), "negative_id")
    kept = met.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= negatives)

    def id_or_null(name: str) -> Column:
        return F.when(F.col(name) != NO_ID, F.col(name)).alias(name)

    return kept.join(best, by).select(
        "anchor_id", id_or_null("positive_id"), "rank", id_or_null("negative_id"), "positive_score", "negative_score"
    )


def _who(keys: np.ndarray) -> np.ndarray:
    """The candidate of a key: its place in the block."""
    return (1 << RANK_BITS) - 1 - (keys & ((1 << RANK_BITS) - 1))


def _none(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    )
