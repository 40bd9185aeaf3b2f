"""Near-duplicates by bottom-k sketches of one hash function.

1. Every text becomes its set of 64-bit hashes of five-word shingles. Texts with one set form a class.
   A class keeps the ``K`` smallest hashes as its sketch.
2. Inverted lists of retained values name candidates. Two linked sets share at least ``LEAST`` of
   ``K`` retained values (but for one pair in 10^8 at the threshold itself), hence at least one among the
   ``K - LEAST + 1`` rarest of either, so only those are listed, and values that one class holds
   drop out.
3. The sketch of the union, made from both sketches, estimates the similarity and filters.
4. What is left is compared on the full sets, next to each other in the tasks.

Short lists give all their pairs. Classes that meet in a long list are listed anew by their full
sets, where two linked sets share one of the quarter of their rarest shingles: that leaves few lists long, and
their members are mostly linked. Those give stars: every member meets ``PIVOTS`` others. What is then outside
a list's largest component meets every member of its lists, in blocks that are compared by shingle inside
the tasks, so that no link is lost, and a list whose members are linked costs some comparisons a member.
Components come from alternating large and small stars over written tables.

Defined results: a null or wordless text has an empty set, is linked with nothing and is kept; fewer
than five words are one shingle; repeated rows are equal texts and all rows that carry the smallest id are
kept; a null id never is the smallest one unless all ids of its component are null, and then its rows are kept; an
empty table gives an empty result; columns not asked for are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from functools import reduce
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from goldpan.llm.common import as_bytes, id_and_text, likely_among, parts, per_document, whole_text, without
from goldpan.storage import materialize

WORDS = 5
K, LEAST = 64, 27
SHORT_LIST = 32
PIVOTS = 3
PER_CHUNK = 64
PER_BLOCK = 256
_WEIGHTS = np.array([xxhash.xxh64_intdigest(b"position %d" % j) | 1 for j in range(WORDS)], np.uint64)


class Shingles:
    """Texts to sorted sets of shingle hashes; remembers the hashes of words, up to a bound."""

    def __init__(self, most_words: int = 250_000):
        self.known: dict[bytes, int] = {}
        self.most = most_words

    def __call__(self, text: bytes) -> np.ndarray:
        words = text.lower().split()
        if not words:
            return np.empty(0, np.uint64)
        known = self.known
        if len(known) > self.most:
            known.clear()
        for w in set(words).difference(known):
            known[w] = xxhash.xxh3_64_intdigest(w)
        h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        n = max(1, len(words) - WORDS + 1)
        total = np.full(n, min(len(words), WORDS), np.uint64)
        for j in range(min(WORDS, len(words))):
            total += h[j : j + n] * _WEIGHTS[j]
        for shift, factor in ((33, 0xFF51AFD7ED558CCD), (29, 0xC4CEB9FE1A85EC53)):
            total ^= total >> np.uint64(shift)
            total *= np.uint64(factor)
        total ^= total >> np.uint64(32)
        return np.unique(total)


def _sketcher() -> Callable[[bytes], tuple]:
    shingles = Shingles()

    def run(text: bytes) -> tuple:
        s = shingles(text)
        key = blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None
        return len(s), key, s[:K].view(np.int64)

    return run


def sketches(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, n_shingles, class_key (null for an empty set), sketch."""
    rows = id_and_text(docs).withColumn("text_hash", F.xxhash64("text"))
    schema = "n_shingles long, class_key binary, sketch array<long>"
    return per_document(rows, schema, _sketcher, keep=("text_hash",))


def _meet(left: DataFrame, right: DataFrame, on: str | list[str], how: str = "inner") -> DataFrame:
    """A join of two sides that both grow with the data: sorted and merged, never broadcast."""
    return left.join(right.hint("merge"), on, how)


def inverted_lists(held: DataFrame, room: Column) -> DataFrame:
    """value, class_key, n_shingles, length: lists of two classes and more.

    ``held``: class_key, n_shingles, k and each of a class's ``k`` values. Of those the ``room``
    rarest are listed. Values that one class alone holds are the rarest and only take up room.
    """
    per_class = (
        _in_lists(held)
        .groupBy("class_key", "n_shingles", "k")
        .agg(F.array_sort(F.collect_list(F.struct("length", "value"))).alias("found"))
    )
    left = F.greatest(F.lit(0), room - (F.col("k") - F.size("found"))).cast("int")
    return _in_lists(
        per_class.select("class_key", "n_shingles", F.explode(F.slice("found", F.lit(1), left)["value"]).alias("value"))
    )


def _in_lists(held: DataFrame) -> DataFrame:
    """The rows whose value another row has, too, with ``length``: how many have it. They are shuffled once."""
    length = F.count(F.lit(1)).over(Window.partitionBy("value"))
    return held.withColumn("length", length).filter("length > 1")


def sketch_lists(classes: DataFrame) -> DataFrame:
    held = classes.select("class_key", "n_shingles", F.size("sketch").alias("k"), F.explode("sketch").alias("value"))
    # A set of at most 3/4 K values only links with sets whose sketches are whole, too.
    shared = F.when(F.col("k") <= K * 3 // 4, F.ceil(F.col("k") * 3 / 4)).otherwise(LEAST)
    return inverted_lists(held, F.col("k") - shared + 1)


def full_lists(texts: DataFrame) -> DataFrame:
    """The same from full sets: a set of n shingles shares at least 3n/4 with one that it is linked with."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles()
        for batch in parts(batches):
            for key, text in zip(batch.column("class_key").to_pylist(), as_bytes(batch.column("text")), strict=True):
                s = shingles(text).view(np.int64)
                n = pa.array(np.full(len(s), len(s)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([key] * len(s), pa.binary()), n, n, pa.array(s)], ["class_key", "n_shingles", "k", "value"]
                )

    held = texts.select("class_key", F.encode("text", "UTF-8").alias("text")).mapInArrow(
        run, "class_key binary, n_shingles long, k long, value long"
    )
    return inverted_lists(held, F.col("k") - F.ceil(F.col("k") * 3 / 4) + 1)


def _sizes_allow(a: str, b: str) -> Column:
    return (4 * F.col(a) >= 3 * F.col(b)) & (4 * F.col(b) >= 3 * F.col(a))


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def _against(members: DataFrame, pivots: DataFrame) -> DataFrame:
    """Pairs of the members of each list with its pivot."""
    pivots = pivots.select("value", F.col("pivot.class_key").alias("y"), F.col("pivot.n_shingles").alias("ny"))
    met = _meet(members, pivots, "value").filter((F.col("class_key") != F.col("y")) & _sizes_allow("n_shingles", "ny"))
    return met.select(F.col("class_key").alias("x"), "y")


def _pivot(turn: int) -> Column:
    """One member of each list, by an order of all classes, so that lists of one group agree on few."""
    return F.min_by(F.struct("class_key", "n_shingles"), F.xxhash64("class_key", F.lit(turn))).alias("pivot")


def short_pairs(lists: DataFrame) -> DataFrame:
    left = lists.select("value", F.col("class_key").alias("x"), F.col("n_shingles").alias("nx"))
    right = lists.select("value", F.col("class_key").alias("y"), F.col("n_shingles").alias("ny"))
    return _meet(left, right, "value").filter((F.col("x") < F.col("y")) & _sizes_allow("nx", "ny")).select("x", "y")


def estimated(pairs: DataFrame, members: DataFrame) -> DataFrame:
    """The pairs whose union sketch allows the similarity."""
    a = members.select(F.col("class_key").alias("a"), F.col("sketch").alias("sa"))
    b = members.select(F.col("class_key").alias("b"), F.col("sketch").alias("sb"))
    return _meet(_meet(pairs, a, "a"), b, "b").filter(_union_sketch_allows("sa", "sb")).select("a", "b")


def _union_sketch_allows(a: str, b: str) -> Column:
    # Sketches hold unsigned hashes in signed longs; flipping the sign restores their order.
    union = F.slice(
        F.array_sort(F.transform(F.array_union(a, b), lambda v: v.bitwiseXOR(F.lit(-(2**63))))), 1, K
    )
    common = F.transform(F.array_intersect(a, b), lambda v: v.bitwiseXOR(F.lit(-(2**63))))
    both = F.size(F.array_intersect(union, common))
    return F.when(F.size(union) == K, both >= LEAST).otherwise(4 * both >= 3 * F.size(union))


def confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs whose full sets are similar enough.

    The second texts of a first one are dealt out in chunks; a task meets the first text, then
    its chunk, and holds one set at a time.
    """
    chunks = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / PER_CHUNK).alias("chunks"))
    dealt = _meet(pairs, chunks, "a").select("a", "b", F.pmod(F.xxhash64("b"), "chunks").alias("chunk"))
    seconds = _meet(dealt, texts.withColumnRenamed("class_key", "b"), "b").select("a", "chunk", "b", "text")
    firsts = (
        _meet(dealt.select("a", "chunk").distinct(), texts.withColumnRenamed("class_key", "a"), "a")
        .select("a", "chunk", F.lit(None).cast("binary").alias("b"), "text")
    )
    met = firsts.unionByName(seconds).repartition("a", "chunk").sortWithinPartitions("a", "chunk", "b")

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, first = Shingles(), np.empty(0, np.uint64)
        for batch in batches:
            found_a, found_b = [], []
            rows = zip(
                as_bytes(batch.column("a")), batch.column("b").to_pylist(), as_bytes(batch.column("text")), strict=True
            )
            for a, b, text in rows:
                s = shingles(text)
                if b is None:
                    first = s
                    continue
                common = len(np.intersect1d(first, s, assume_unique=True))
                if 4 * common >= 3 * (len(first) + len(s) - common):
                    found_a.append(a)
                    found_b.append(b)
            yield pa.RecordBatch.from_arrays([pa.array(found_a, pa.binary()), pa.array(found_b, pa.binary())], ["a", "b"])

    return met.select("a", "b", F.encode("text", "UTF-8").alias("text")).mapInArrow(compare, "a binary, b binary")


def components(edges: DataFrame) -> DataFrame:
    """node and root (its component's smallest node) of an edge list ``a``, ``b``.

    Each turn is one written table; its size and a sum of hashes, taken while it is written, tell
    when nothing moves any more.
    """

    def smallest(links: DataFrame) -> DataFrame:
        return links.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))

    def written(links: DataFrame) -> tuple[DataFrame, dict]:
        seen = Observation()
        whole = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("hash")
        stored = materialize(links.distinct().observe(seen, F.count(F.lit(1)).alias("rows"), whole), "stars")
        return stored, seen.get

    stars, last = written(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")))
    while True:
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _meet(both, smallest(both), "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        near = smallest(large)
        small = _meet(large, near, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        stars, now = written(small.unionByName(near.select("u", F.col("m").alias("v"))))
        if now == last:
            return stars.select(F.col("u").alias("node"), F.col("v").alias("root"))
        last = now


def _joined(places: DataFrame | None, edges: DataFrame) -> DataFrame | None:
    """Class to component after more links: components are nodes, links between two are edges."""
    if places is not None:
        for side in "ab":
            at = places.select(F.col("class_key").alias(side), F.col("component").alias("c"))
            edges = _meet(edges, at, side, "left").withColumn(side, F.coalesce("c", side)).drop("c")
    edges = materialize(edges.filter("a != b").distinct(), "links")
    if edges.isEmpty():
        return places
    roots = components(edges)
    if places is None:
        return materialize(roots.select(F.col("node").alias("class_key"), F.col("root").alias("component")), "places")
    moved = places.join(roots, F.col("component") == F.col("node"), "left").select(
        "class_key", F.coalesce("root", "component").alias("component")
    )
    fresh = roots.join(places.select(F.col("class_key").alias("node")), "node", "left_anti").select(
        F.col("node").alias("class_key"), F.col("root").alias("component")
    )
    return materialize(moved.unionByName(fresh), "places")


def _placed(lists: DataFrame, places: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """Members of lists that hold several components, and the members outside the largest one."""
    if places is None:
        at = lists.withColumn("component", F.col("class_key"))
    else:
        at = _meet(lists, places, "class_key", "left").withColumn("component", F.coalesce("component", "class_key"))
    most = (
        at.groupBy("value", "component")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("value")
        .agg(F.max(F.struct("n", "component"))["component"].alias("largest"), F.count(F.lit(1)).alias("components"))
        .filter("components > 1")
    )
    at = materialize(_meet(at, most, "value"), "members")
    return at, at.filter("component != largest")


def link_classes(lists: DataFrame, members: DataFrame, texts: DataFrame) -> DataFrame | None:
    """class_key and component of all classes that have a link; None where there is none."""

    def found(pairs: DataFrame) -> DataFrame:
        return confirmed(materialize(estimated(_ordered(pairs), members), "candidates"), texts)

    short, long_ = lists.filter(F.col("length") <= SHORT_LIST), lists.filter(F.col("length") > SHORT_LIST)
    stars = (_against(long_, long_.groupBy("value").agg(_pivot(turn))) for turn in range(PIVOTS))
    places = _joined(None, found(reduce(DataFrame.unionByName, stars, short_pairs(short))))
    at, outside = _placed(long_, places)
    if outside.isEmpty():
        return places
    return _joined(places, in_blocks(at, texts))


def in_blocks(at: DataFrame, texts: DataFrame) -> DataFrame:
    """Links between what is outside the largest component of its lists and all members of those.

    Lists with one largest component go together, so a pair meets once. Blocks of outside members
    are indexed by shingle, members stream past, and only links leave the task, one for each
    outside member and component.
    """
    both = at.select("largest", "class_key", "component").distinct()
    outside = F.col("component") != F.col("largest")
    counts = both.groupBy("largest").agg(
        F.ceil(F.count_if(outside) / PER_BLOCK).cast("int").alias("blocks"),
        F.ceil(F.count(F.lit(1)) / (8 * PER_BLOCK)).cast("int").alias("streams"),
    )
    dealt = _meet(_meet(both, counts, "largest"), texts, "class_key")
    own = F.xxhash64("class_key")

    def every(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    columns = ["largest", "block", "stream", "streamed", "class_key", "component", "text"]
    held = dealt.filter(outside).select("*", F.pmod(own, "blocks").cast("int").alias("block"), every("streams").alias("stream"))
    passing = dealt.select("*", F.pmod(own, "streams").cast("int").alias("stream"), every("blocks").alias("block"))
    rows = held.withColumn("streamed", F.lit(0)).select(*columns).unionByName(
        passing.withColumn("streamed", F.lit(1)).select(*columns)
    )
    key = ("largest", "block", "stream")
    rows = rows.repartition(*key).sortWithinPartitions(*key, "streamed")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, last, index = Shingles(), None, None
        keys: list[bytes] = []
        places: list[bytes] = []
        sets: list[np.ndarray] = []
        for batch in batches:
            columns_ = [batch.column(c).to_pylist() for c in range(batch.num_columns)]
            found: list[tuple[bytes, bytes]] = []
            for largest, block, stream, streamed, name, place, text in zip(*columns_, strict=True):
                if (largest, block, stream) != last:
                    last, index = (largest, block, stream), None
                    keys, places, sets = [], [], []
                s = shingles(text)
                if not streamed:
                    keys.append(name)
                    places.append(place)
                    sets.append(s)
                    continue
                index = index or BlockIndex(sets)
                found += [(keys[i], name) for i in index.similar(s) if places[i] != place]
            links = {(a, b): None for a, b in found}
            yield pa.RecordBatch.from_arrays(
                [pa.array([a for a, _ in links], pa.binary()), pa.array([b for _, b in links], pa.binary())], ["a", "b"]
            )

    coded = rows.withColumn("text", F.encode("text", "UTF-8"))
    return coded.mapInArrow(run, "a binary, b binary")


class BlockIndex:
    """Sets of one block by shingle: how much of each a further set shares, in one pass."""

    def __init__(self, sets: list[np.ndarray]):
        values = np.concatenate(sets)
        owners = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        order = np.argsort(values, kind="stable")
        self.values, self.owners = values[order], owners[order]
        self.sizes = np.array([len(s) for s in sets])

    def similar(self, s: np.ndarray) -> list[int]:
        low, high = np.searchsorted(self.values, s, "left"), np.searchsorted(self.values, s, "right")
        many = high - low
        at = np.repeat(low - (np.cumsum(many) - many), many) + np.arange(many.sum())
        common = np.bincount(self.owners[at], minlength=len(self.sizes))
        return np.flatnonzero(4 * common >= 3 * (self.sizes + len(s) - common)).tolist()


def near_dedup(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept, text_hash."""
    seen = materialize(sketches(docs), "sketches")
    known = seen.filter("class_key is not null")
    classes = known.select("class_key", "n_shingles", "sketch").dropDuplicates(["class_key"])
    lists = materialize(sketch_lists(classes), "lists")
    one = F.min(F.struct(F.coalesce("doc_id", F.lit(0)).alias("id"), "text_hash", "n_shingles", "sketch"))
    members = (
        _meet(known, lists.select("class_key").distinct(), "class_key")
        .groupBy("class_key")
        .agg(one.alias("one"))
        .select("class_key", "one.*")
    )
    members = materialize(members, "listed")
    rows = id_and_text(docs).select(
        F.coalesce("doc_id", F.lit(0)).alias("id"), F.xxhash64("text").alias("text_hash"), "text"
    )
    wanted = members.select("class_key", "id", "text_hash").hint("shuffle_hash")
    texts = likely_among(rows, members, ["id", "text_hash"]).join(wanted, ["id", "text_hash"]).select("class_key", "text")
    texts = materialize(texts.dropDuplicates(["class_key"]), "texts")
    busy = lists.filter(F.col("length") > SHORT_LIST).select("class_key").distinct()
    full = full_lists(_meet(texts, busy, "class_key"))
    lists = materialize(lists.filter(F.col("length") <= SHORT_LIST).unionByName(full), "all-lists")
    places = link_classes(lists, members, texts)
    smallest = known.groupBy("class_key").agg(F.min("doc_id").alias("smallest"))
    if places is not None:
        rooted = _meet(smallest, places, "class_key", "left").withColumn("component", F.coalesce("component", "class_key"))
        per_component = rooted.groupBy("component").agg(F.min("smallest").alias("smallest"))
        smallest = _meet(rooted.select("class_key", "component"), per_component, "component").select("class_key", "smallest")
    judged = seen.select("doc_id", "text_hash", "n_shingles", "class_key")
    judged = _meet(judged, smallest, "class_key", "left")
    component = F.when(F.col("class_key").isNull(), F.col("doc_id")).otherwise(F.col("smallest"))
    return judged.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
        "text_hash",
    )


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """The rows that stay, with all their columns."""
    gone = near_dedup(docs).filter("not kept").select(F.struct("doc_id", "text_hash").alias("gone_row")).distinct()
    row = F.struct(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(whole_text()).alias("text_hash"))
    return without(docs, materialize(gone, "near-copies"), row == F.col("gone_row"))
