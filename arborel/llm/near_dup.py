"""MinHash near-duplicates by a signature-coordinate inverted join.

A document's set holds the hashes of its distinct five-word shingles. Documents of equal sets
are one class, which its least doc_id stands for. Each class has a signature of COORDINATES
minima, and is posted under its coordinate-value pairs; two classes collide once for each pair
they share, and at least MATCHES collisions make them candidates.

Prefix merging: pairs that only one class has collide with nothing and are not posted. A class
with m shared pairs can have MATCHES collisions only if one falls among its m - MATCHES + 1
rarest pairs (ordered by frequency), so it is posted under those alone, and with m < MATCHES
nowhere. Pairs of many documents, such as those of a passage that thousands share, thus fall
away unless almost the whole signature is shared.

Skip merging: a list's members are visited from one to the next through collisions counted over
the whole signatures; members that have been reached are skipped from then on. A list of n
members gives at most n - 1 links, however many of its pairs collide.

The links give candidate clusters. Their documents' sets are built again from the texts, each
is sent to its cluster, and there every pair that could matter is confirmed on the full
sets: pairs whose documents are linked already are skipped, all others with enough collisions
are compared.

Lists and clusters beyond GROUP members or GROUP_BYTES are contracted first: their members are
dealt at random into blocks, and what is linked within the blocks joins them into parts. What is
left are pairs of different parts. Each member outside a list's largest part meets all others,
each pair of blocks in a task of its own; pairs within the largest part need no look. A family of
n near copies so costs rows in proportion to n, nothing unbounded meets in one task, and no pair
is lost.

Two documents whose Jaccard similarity is at least 0.85 agree in 54 of 64 coordinates on
average and in fewer than MATCHES = 40 with a probability below 2e-6.

Null and empty texts, and texts without words, have an empty set and are linked with nothing. A
text of one to four words has one shingle, the whole sequence. Each row has the component of its
own text, also where rows have equal ids; a component is named by its least doc_id, so two may
bear one name where ids repeat. A row without doc_id belongs to no component and is kept. Extra
columns do not matter.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arborel.llm.common import Words, blobs, fresh, held, mix, slices, stored, texts_of
from arborel.llm.components import Forest, components

COORDINATES = 64
MATCHES = 40
#: Members of a list or cluster that one task holds from one side, and the bytes of their sets.
GROUP = 512
GROUP_BYTES = 1 << 25
#: Members of clusters, of some 50 bytes each, that every task may have; more are joined by a shuffle.
BROADCAST_ROWS = 1 << 19

_FACTORS = mix(np.arange(1, COORDINATES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
_OFFSETS = mix(np.arange(1, COORDINATES + 1, dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))


@dataclass(frozen=True)
class Similarity:
    """Documents are linked where 100 * intersection >= percent * union."""

    words: int = 5
    percent: int = 85
    matches: int = MATCHES


def matches_for(percent: int, miss: float = 2e-6) -> int:
    """The most collisions that a pair of this similarity fails to have with a probability of at most ``miss``."""
    p, below = percent / 100, 0.0
    for k in range(COORDINATES + 1):
        below += math.comb(COORDINATES, k) * p**k * (1 - p) ** (COORDINATES - k)
        if below > miss:
            return max(1, k)
    return COORDINATES


def shingle_sets(texts: list[str], n: int) -> list[np.ndarray]:
    """Sorted distinct hashes of the n-word shingles of each text."""
    words = Words(texts, lower=True)
    hashes, first = words.windows(n)
    out = []
    for i in range(len(texts)):
        part = hashes[first[i] : first[i + 1]]
        if not len(part):
            few = words.hashes[words.first[i] : words.first[i + 1]]
            if len(few):
                # a mark of its own, so that no shingle of n words equals a short text
                part = np.full(1, 0x5851F42D4C957F2D + len(few), np.uint64)
                for h in few:
                    part = mix(part * np.uint64(0xD6E8FEB86659FD93) + h)
        if len(part) > 1:
            part = np.sort(part)
            part = part[np.concatenate([[True], part[1:] != part[:-1]])]
        out.append(part)
    return out


def signature(hashes: np.ndarray) -> np.ndarray:
    """COORDINATES minima of 32 bits."""
    out = np.full(COORDINATES, np.uint64(0xFFFFFFFFFFFFFFFF))
    for i in range(0, len(hashes), 4096):
        part = hashes[i : i + 4096]
        np.minimum(out, (part[None, :] * _FACTORS[:, None] + _OFFSETS[:, None]).min(1), out=out)
    return (out >> np.uint64(32)).astype(np.uint32)


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets reach the similarity."""
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    if 100 * len(small) < percent * len(large):
        return False
    at = np.searchsorted(large, small)
    at[at == len(large)] = 0
    common = int((large[at] == small).sum())
    return 100 * common >= percent * (len(a) + len(b) - common)


def _sketches(docs: DataFrame, rule: Similarity, doc_id: str, text: str) -> DataFrame:
    """(doc_id, row, n_shingles, digest, signature) of each row; digest and signature are null for an empty set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held(None)
        for batch in batches:
            for part in slices(batch, "text"):
                sets = shingle_sets(texts_of(part), rule.words)
                digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
                signatures = [signature(s).astype("<u4").tobytes() if len(s) > 1 else None for s in sets]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array([len(s) for s in sets], pa.int64()), pa.array(digests, pa.binary()), pa.array(signatures, pa.binary())], ["doc_id", "row", "n_shingles", "digest", "signature"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), _row(doc_id, text).alias("row"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, row binary, n_shingles long, digest binary, signature binary")


def _row(doc_id: str, text: str) -> Column:
    """What rows of equal id and text have in common, nulls included."""
    return F.unhex(F.md5(F.concat_ws("|", F.coalesce(F.col(doc_id).cast("long").cast("string"), F.lit("-")), F.coalesce(F.md5(F.col(text).cast("string")), F.lit("-")))))


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(token, rep) of each coordinate-value pair: the value, then the coordinate in the low bits."""
    for batch in batches:
        reps = batch.column(0).to_numpy()
        values = np.frombuffer(b"".join(blobs(batch.column(1))), "<u4").reshape(-1, COORDINATES)
        tokens = values.astype(np.int64) << 6 | np.arange(COORDINATES)
        yield pa.RecordBatch.from_arrays([pa.array(tokens.ravel()), pa.array(np.repeat(reps, COORDINATES))], ["token", "rep"])


def _dealt(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.repartition(*keys).sortWithinPartitions(*keys)


def _random_blocks(group: str, blocks: Column, splits: int) -> Column:
    """One block of the group for each of so many random splits; a group of one block is split once."""
    last = F.when(blocks > 1, F.lit(splits - 1)).otherwise(F.lit(0))
    return F.transform(F.sequence(F.lit(0), last), lambda k: F.pmod(F.xxhash64("node", group, k), blocks).cast("long") * splits + k)


def _pairs_left(members: DataFrame, group: str, weight: Column) -> DataFrame:
    """(group, node, root, at): for each member the pairs (i, j, first) of blocks that it takes part in, ``first`` where it is of block i.

    ``members`` has group, node and root (the part that node is in). Blocks below ``outside`` hold the members outside the
    group's largest part, the others those of it; pairs of the latter with each other are left out.
    """
    parts = members.groupBy(group, "root").agg(F.count(F.lit(1)).alias("n"), F.sum(weight).alias("weight"))
    most = parts.groupBy(group).agg(F.max(F.struct("n", "root")).alias("most"), F.sum("n").alias("all"), F.sum("weight").alias("weight"))
    most = most.filter("all > most.n").select(group, F.col("most.root").alias("main"), (F.col("all") - F.col("most.n")).alias("left"), F.col("most.n").alias("n"), (F.col("weight") / F.col("all")).alias("mean"))
    size = lambda n: F.ceil(F.greatest(n / F.lit(GROUP), n * F.col("mean") / F.lit(GROUP_BYTES))).cast("int")
    most = most.select(group, "main", size(F.col("left")).alias("outside"), size(F.col("n")).alias("inside"))
    rows = members.join(most, group).withColumn("is_main", F.col("root") == F.col("main"))
    own = F.pmod(F.xxhash64("node", group), F.when(F.col("is_main"), F.col("inside")).otherwise(F.col("outside"))).cast("int")
    own = F.when(F.col("is_main"), F.col("outside") + own).otherwise(own)
    last = F.when(F.col("is_main"), F.col("outside") - 1).otherwise(F.col("outside") + F.col("inside") - 1)
    at = F.transform(F.sequence(F.lit(0), last), lambda other: F.struct(F.least(own, other).cast("long").alias("i"), F.greatest(own, other).cast("long").alias("j"), (own <= other).alias("first")))
    return rows.select(group, "node", "root", at.alias("at"))


def _groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[list[pa.Array]]:
    """Rows of sorted batches as groups of equal first ``keys`` columns: the other columns of each group."""
    rest: list[list[pa.Array]] = []
    key = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [c.to_numpy() for c in batch.columns[:keys]]
        change = np.zeros(batch.num_rows, bool)
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        cuts = np.concatenate([[0], np.flatnonzero(change), [batch.num_rows]])
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            now = tuple(c[a] for c in columns)
            if rest and now != key:
                yield [pa.concat_arrays(x) if len(x) > 1 else x[0] for x in zip(*rest)]
                rest = []
            key = now
            rest.append([c.slice(a, b - a) for c in batch.columns[keys:]])
    if rest:
        yield [pa.concat_arrays(x) if len(x) > 1 else x[0] for x in zip(*rest)]


def _links(a: list[int], b: list[int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def _collide(matches: int) -> Callable:
    """Links that join what collides in each list; input columns token, i, node, signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a_out: list[int] = []
        b_out: list[int] = []
        held(None)
        for nodes, signatures in _groups(batches, 2):
            if len(nodes) > 1:
                nodes = nodes.to_numpy()
                values = np.frombuffer(b"".join(blobs(signatures)), np.uint32).reshape(len(nodes), COORDINATES)
                left = np.arange(len(nodes))
                while len(left) > 1:
                    # one connected part of the list: from each member reached, on to those not reached yet
                    front, left = [int(left[0])], left[1:]
                    while front and len(left):
                        x = front.pop()
                        near = (values[left] == values[x]).sum(1) >= matches
                        if near.any():
                            found = left[near]
                            left = left[~near]
                            front += found.tolist()
                            a_out += [int(nodes[x])] * len(found)
                            b_out += nodes[found].tolist()
            if len(a_out) >= 1 << 14:
                yield _links(a_out, b_out)
                a_out, b_out = [], []
        yield _links(a_out, b_out)

    return run


def _collide_apart(matches: int) -> Callable:
    """Links between members of different parts; input columns token, i, j, node, root, first, signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held(None)
        for nodes, roots, first, signatures in _groups(batches, 3):
            nodes, roots, first = nodes.to_numpy(), roots.to_numpy().copy(), first.to_numpy(zero_copy_only=False)
            values = np.frombuffer(b"".join(blobs(signatures)), np.uint32).reshape(len(nodes), COORDINATES)
            within = bool(first.all())  # one block with itself, or nothing to compare with
            a_out, b_out = [], []
            for x in np.flatnonzero(first).tolist():
                other = (roots != roots[x]) if within else ~first & (roots != roots[x])
                near = np.flatnonzero(other)
                near = near[(values[near] == values[x]).sum(1) >= matches]
                for y in near.tolist():
                    if roots[y] != roots[x]:
                        a_out.append(int(nodes[x]))
                        b_out.append(int(nodes[y]))
                        roots[roots == roots[y]] = roots[x]
            yield _links(a_out, b_out)

    return run


def _confirm(rule: Similarity, keys: int) -> Callable:
    """Links confirmed on full sets; input columns cluster and i, or cluster, i and j; then node, root, first, set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held(None)
        for nodes, roots, first, raw in _groups(batches, keys):
            nodes, roots, first = nodes.to_numpy(), roots.to_numpy(), first.to_numpy(zero_copy_only=False)
            sets = [np.frombuffer(x, "<u8") for x in blobs(raw)]
            lengths = np.array([len(s) for s in sets])
            signatures = np.stack([signature(s) for s in sets])
            forest = Forest()
            a_out, b_out = [], []
            apart = not first.all()  # two blocks: pairs within one are another task's
            # likely pairs first: once two documents are joined, pairs of their parts need no look
            order = np.argsort(lengths, kind="stable")
            for step in range(1, len(nodes)):
                x = int(order[step])
                others = order[:step]
                others = others[100 * lengths[others] >= rule.percent * lengths[x]]
                if apart:
                    others = others[first[others] != first[x]]
                others = others[roots[others] != roots[x]]
                counts = (signatures[others] == signatures[x]).sum(1)
                near = np.flatnonzero(counts >= rule.matches)
                for k in near[np.argsort(-counts[near], kind="stable")].tolist():
                    o = int(others[k])
                    if forest.root(int(roots[x])) != forest.root(int(roots[o])) and similar(sets[x], sets[o], rule.percent):
                        forest.join(int(roots[x]), int(roots[o]))
                        a_out.append(int(nodes[x]))
                        b_out.append(int(nodes[o]))
            yield _links(a_out, b_out)

    return run


def _full_sets(rule: Similarity, columns: list[str]) -> Callable:
    """The set of each row's text; rows of texts that have another digest are left out. Input columns: text, digest, then ``columns``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held(None)
        for batch in batches:
            for part in slices(batch, "text"):
                sets = [s.astype("<u8").tobytes() for s in shingle_sets(texts_of(part), rule.words)]
                right = [i for i, (s, d) in enumerate(zip(sets, part.column(1).to_pylist())) if hashlib.blake2b(s, digest_size=16).digest() == d]
                rest = part.take(pa.array(right, pa.int64()))
                yield pa.RecordBatch.from_arrays([*rest.columns[2:], pa.array([sets[i] for i in right], pa.binary())], [*columns, "set"])

    return run


def _rooted(members: DataFrame, roots: DataFrame) -> DataFrame:
    """``members`` with the root of each node, itself where it has none."""
    return members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))


def candidate_links(classes: DataFrame, matches: int) -> DataFrame:
    """(node, root) of the parts that all classes with enough collisions form; ``classes`` has node and signature."""
    posted = classes.mapInArrow(_tokens, "token long, node long")
    frequent = posted.groupBy("token").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    shared = posted.join(frequent, "token").groupBy("node").agg(F.sort_array(F.collect_list(F.struct("n", "token"))).alias("pairs"))
    prefix = shared.filter(F.size("pairs") >= matches).select("node", F.slice("pairs", F.lit(1), F.size("pairs") - (matches - 1)).alias("pairs"))
    lists = stored(prefix.select("node", F.explode("pairs").alias("pair")).select("node", "pair.token", "pair.n"), "lists")
    rows = lists.join(classes, "node").withColumn("i", F.explode(_random_blocks("token", F.ceil(F.col("n") / GROUP), 1)))
    links = _dealt(rows.select("token", "i", "node", "signature"), ["token", "i"]).mapInArrow(_collide(matches), "a long, b long")
    parts = components(links)
    large = lists.filter(F.col("n") > GROUP).select("token", "node")
    if not large.head(1):
        return parts
    left = stored(_pairs_left(_rooted(large, parts), "token", F.lit(4 * COORDINATES)), "left")
    rows = left.withColumn("at", F.explode("at")).join(classes, "node").select("token", "at.i", "at.j", "node", "root", "at.first", "signature")
    more = _dealt(rows, ["token", "i", "j"]).mapInArrow(_collide_apart(matches), "a long, b long")
    return components(more.unionByName(parts.select(F.col("node").alias("a"), F.col("root").alias("b"))))


def confirmed_links(docs: DataFrame, clusters: DataFrame, rule: Similarity) -> DataFrame:
    """(node, root) of the parts that documents with similar full sets form; ``docs`` has doc_id and text, ``clusters`` cluster,
    node, digest, least (a doc_id that has a text of that digest) and weight (bytes of the set)."""
    sizes = clusters.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.sum("weight").alias("bytes"))
    blocks = F.ceil(F.greatest(F.col("n") / GROUP, F.col("bytes") / GROUP_BYTES))

    def with_sets(members: DataFrame) -> DataFrame:
        """Each member's set, which is built once and goes to all its blocks ``at``."""
        columns = ["cluster", "node", "root", "at"]
        members = stored(members.withColumnRenamed("least", "doc_id"), "members")
        # while members are few, the texts of all others need not be shuffled to leave them out
        few = members.count() <= BROADCAST_ROWS
        rows = docs.join(F.broadcast(members) if few else members, "doc_id").select("text", "digest", *columns)
        types = dict(rows.dtypes)
        return rows.mapInArrow(_full_sets(rule, columns), ", ".join(f"{c} {types[c]}" for c in columns) + ", set binary").withColumn("at", F.explode("at"))

    once = clusters.join(sizes.select("cluster", blocks.alias("blocks")), "cluster")
    once = once.select("cluster", "node", "digest", "least", F.col("node").alias("root"), _random_blocks("cluster", F.col("blocks"), 2).alias("at"))
    rows = with_sets(once).select("cluster", F.col("at").alias("i"), "node", "root", F.lit(True).alias("first"), "set")
    parts = components(_dealt(rows, ["cluster", "i"]).mapInArrow(_confirm(rule, 2), "a long, b long"))
    large = clusters.join(sizes.filter(blocks > 1).select("cluster"), "cluster")
    if not large.head(1):
        return parts
    left = _pairs_left(_rooted(large.select("cluster", "node", "weight"), parts), "cluster", F.col("weight"))
    rows = with_sets(left.join(clusters.select("node", "digest", "least"), "node")).select("cluster", "at.i", "at.j", "node", "root", "at.first", "set")
    more = _dealt(rows, ["cluster", "i", "j"]).mapInArrow(_confirm(rule, 3), "a long, b long")
    return components(more.unionByName(parts.select(F.col("node").alias("a"), F.col("root").alias("b"))))


def _judged(docs: DataFrame, rule: Similarity, doc_id: str, text: str) -> DataFrame:
    """Per row of ``docs``: doc_id, row, n_shingles, part (a number of the row's component; null without one) and component_id."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    sketches = stored(_sketches(docs, rule, doc_id, text), "sketches")
    sets = sketches.filter("digest IS NOT NULL AND doc_id IS NOT NULL")
    classes = sets.groupBy("digest").agg(F.min("doc_id").alias("least"), F.min("signature").alias("signature"), (8 * F.max("n_shingles")).alias("weight"))
    classes = stored(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    links = candidate_links(classes.filter("signature IS NOT NULL").select("node", "signature"), rule.matches)
    members = links.select(F.col("root").alias("cluster"), "node").unionByName(links.select(F.col("root").alias("cluster"), F.col("root").alias("node")).distinct())
    clusters = stored(members.join(classes.select("node", "digest", "least", "weight"), "node"), "clusters")
    parts = _rooted(classes.select("node", "digest", "least"), confirmed_links(rows, clusters, rule))
    names = parts.groupBy("root").agg(F.min("least").alias("component_id"))
    found = parts.join(names, "root").select("digest", F.col("root").alias("part"), "component_id")
    out = sketches.select("doc_id", "row", "n_shingles", "digest").join(found, "digest", "left")
    mine = F.col("doc_id").isNotNull()
    return out.select("doc_id", "row", "n_shingles", F.when(mine, F.col("part")).alias("part"), F.when(mine, F.coalesce("component_id", "doc_id")).alias("component_id"))


def near_duplicates(docs: DataFrame, rule: Similarity = Similarity(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id, kept (whether it is the component's least doc_id)."""
    found = _judged(docs, rule, doc_id, text)
    return found.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def keep_one(docs: DataFrame, rule: Similarity = Similarity(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each component of ``docs``, one with its least doc_id, with all its columns.

    Of rows of equal id and text one stays, also of those without words or without an id. Rows of equal id whose
    texts are not near-duplicates are rows of different components, and stay.
    """
    found = stored(_judged(docs, rule, doc_id, text), "judged")
    first = found.filter("part IS NOT NULL AND doc_id = component_id").groupBy("part").agg(F.min("row").alias("best"))
    gone = found.filter("part IS NOT NULL").join(first, "part").filter("row <> best").select("row")
    twice = found.groupBy("row").count().filter("count > 1").select("row")
    row, place = fresh(docs, "row"), fresh(docs, "place")
    rows = docs.withColumn(row, _row(doc_id, text))
    gone, twice = (x.select(F.col("row").alias(row)).distinct() for x in (gone, twice))
    single = rows.join(gone.unionByName(twice).distinct(), row, "left_anti")
    again = rows.join(twice.join(gone, row, "left_anti"), row, "left_semi")
    again = again.withColumn(place, F.row_number().over(Window.partitionBy(row).orderBy(F.lit(0)))).filter(F.col(place) == 1).drop(place)
    return single.unionByName(again).select(docs.columns)
