"""MinHash near-dedup by a chosen-path similarity join: documents branch by selected minwise tokens, and all pairs of a node are compared."""

from __future__ import annotations

import functools
import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessel.llm.common import discard, free_shuffles, map_batches, save, together, windows, word_hashes

SHINGLE, PERCENT, RECALL = 5, 80, 0.99999
COORDINATES, BRANCHES, DEPTH = 64, 2, 2
SMALL_NODE, CROWD, CROWD_SHINGLES = 12, 2048, 1 << 22


@functools.cache
def _hashes(n: int) -> tuple[np.ndarray, np.ndarray]:
    draw = lambda seed: np.random.default_rng(seed).integers(0, 1 << 63, n, dtype=np.uint64)
    return draw(11) * np.uint64(2) + np.uint64(1), draw(12)


def shingle_sets(column: pa.Array, k: int) -> list[np.ndarray]:
    """The sorted distinct hashes of each text's k-word shingles, A-Z in lower case; fewer words are one shingle."""
    h, rows = word_hashes(column, lower=True)
    g = windows(h, k) if len(h) else h
    out = []
    for a, b in zip(rows[:-1].tolist(), rows[1:].tolist(), strict=True):
        if b - a >= k:
            out.append(np.unique(g[a : b - k + 1]))
        elif b > a:
            out.append(windows(h[a:b], b - a, seed=b - a)[:1])
        else:
            out.append(h[:0])
    return out


def set_id(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def minwise(s: np.ndarray, n: int = COORDINATES) -> np.ndarray:
    """The upper halves of the least values of the set under each of n coordinates' hash functions."""
    least, (a, b) = np.full(n, (1 << 64) - 1, np.uint64), _hashes(n)
    for i in range(0, len(s), 2048):
        x = s[None, i : i + 2048] * a[:, None] + b[:, None]
        least = np.minimum(least, x.min(1))
    return (least >> np.uint64(32)).astype(np.uint32).view(np.int32)


def sketch(least: np.ndarray) -> np.ndarray:
    """Four bits of each of the first 64 coordinates, in four integers."""
    bits = (least[:COORDINATES].view(np.uint32) >> np.uint32(9)).astype(np.uint64).reshape(4, 16) & np.uint64(15)
    return (bits << (np.arange(16, dtype=np.uint64) * np.uint64(4))).sum(1, dtype=np.uint64).view(np.int64)


def tree_miss(percent: int) -> float:
    """How likely a pair at the threshold meets in no node of a tree, whose coordinates are all different."""
    miss = 0.0
    for _ in range(DEPTH):
        miss = (1 - percent / 100 * (1 - miss)) ** BRANCHES
    return miss


def sketch_miss(need: int, percent: int) -> float:
    """How likely fewer than ``need`` coordinates of a pair at the threshold agree."""
    s = percent / 100
    return sum(math.comb(COORDINATES, i) * s**i * (1 - s) ** (COORDINATES - i) for i in range(need))


def plan(recall: float, percent: int) -> tuple[int, int]:
    """Trees and agreeing coordinates asked for, each of which misses at most half of 1 - ``recall`` of pairs at the threshold."""
    bound = (1 - recall) / 2
    miss = tree_miss(percent)
    trees = max(1, math.ceil(math.log(bound) / math.log(miss))) if miss else 1
    return trees, max(n for n in range(COORDINATES + 1) if sketch_miss(n, percent) <= bound)


def tree_paths(trees: int) -> list[tuple[int, ...]]:
    """The coordinates that lead to each node of the trees' last level: no two trees, and no two parents, share one."""
    paths, used = [], 0
    for _ in range(trees):
        level: list[tuple[int, ...]] = [()]
        for _ in range(DEPTH):
            level = [(*p, used + i * BRANCHES + j) for i, p in enumerate(level) for j in range(BRANCHES)]
            used += len(level)
        paths += level
    return paths


def branch(rows: DataFrame, paths: list[tuple[int, ...]]) -> DataFrame:
    """A row per path: the minwise tokens of its coordinates name the node."""
    return rows.withColumn("node", F.explode(F.array(*(F.xxhash64(F.lit(i), *(F.get("least", F.lit(c)) for c in p)) for i, p in enumerate(paths)))))


def in_blocks(rows: DataFrame) -> DataFrame:
    """(node, n, weight, sid, ...) of large nodes, with a node for each two blocks of a node's documents, of about ``CROWD`` together: every pair meets in one."""
    blocks = F.greatest(F.lit(2), F.ceil(F.greatest(2 * F.col("n") / CROWD, 2 * F.col("weight") / CROWD_SHINGLES)))
    rows = rows.withColumn("blocks", blocks.cast("int")).withColumn("own", F.pmod(F.xxhash64("sid", F.lit("block")), "blocks").cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).where("own <> other")
    return rows.withColumn("node", F.xxhash64("node", F.least("own", "other"), F.greatest("own", "other")))


def agreement(a: str, b: str) -> Column:
    """How many of the sketches' coordinates agree."""
    differ = F.lit(0)
    for i in range(4):
        x = F.col(f"{a}.s{i}").bitwiseXOR(F.col(f"{b}.s{i}"))
        half = x.bitwiseOR(F.shiftright(x, 2))
        low = half.bitwiseOR(F.shiftright(half, 1)).bitwiseAND(F.lit(0x1111111111111111))
        differ = differ + F.bit_count(low)
    return F.lit(COORDINATES) - differ


def full_sets(sids: DataFrame, docs: DataFrame, reps: DataFrame, k: int) -> DataFrame:
    """(sid, members) of the given set ids, made again from whole texts of their documents only."""
    keys = save(reps.join(sids.distinct(), "sid").select("sid", F.coalesce("doc", F.lit(-(2**63))).alias("key")), "asked")
    texts = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))).alias("key"), "text").join(keys.select("key").distinct(), "key", "left_semi")

    def sets(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = shingle_sets(batch.column("text"), k)
        return pa.RecordBatch.from_arrays([pa.array([set_id(s) for s in own], pa.binary()), pa.array([s.view(np.int64) for s in own], pa.list_(pa.int64()))], ["sid", "members"])

    full = map_batches(texts, sets, "sid binary, members array<bigint>").join(keys.select("sid"), "sid", "left_semi")
    return save(full.groupBy("sid").agg(F.first("members").alias("members")), "sets")


def verified(pairs: DataFrame, full: DataFrame, percent: int) -> DataFrame:
    """Of pairs (a, b) of set ids those whose full sets reach the threshold."""
    x, y = full.select(F.col("sid").alias("a"), F.col("members").alias("x")), full.select(F.col("sid").alias("b"), F.col("members").alias("y"))
    both = pairs.join(x, "a").join(y, "b").withColumn("n", F.size(F.array_intersect("x", "y")))
    return both.where(100 * F.col("n") >= percent * (F.size("x") + F.size("y") - F.col("n"))).select("a", "b")


def spanning_links(sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Compares every pair of full sets, by counting through postings of shared members; gives a link for each union of two components."""
    sizes = np.array([len(s) for s in sets])
    row = np.repeat(np.arange(len(sets)), sizes)
    _, token = np.unique(np.concatenate(sets), return_inverse=True)
    order = np.argsort(token, kind="stable")
    postings, begin = row[order], np.searchsorted(token[order], np.arange(token.max() + 2))
    root = list(range(len(sets)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    links, ends = [], np.cumsum(sizes)
    for i in range(len(sets) - 1):
        own = token[ends[i] - sizes[i] : ends[i]]
        many = begin[own + 1] - begin[own]
        own, many = own[many > 1], many[many > 1]
        if not len(own):
            continue
        places = np.repeat(begin[own] - np.concatenate(([0], np.cumsum(many)[:-1])), many) + np.arange(many.sum())
        shared = np.bincount(postings[places], minlength=len(sets))[i + 1 :]
        for j in (np.flatnonzero(100 * shared >= percent * (sizes[i] + sizes[i + 1 :] - shared)) + i + 1).tolist():
            if (a := find(i)) != (b := find(j)):
                root[b] = a
                links.append((i, j))
    return links


def likely_parts(crowds: DataFrame, need: int) -> DataFrame:
    """Splits each crowd (node, sid, root, s0..s3) into the parts that likely pairs of sketches connect; pairs of one root (if known) are linked already.

    Gives (part, a, b): a likely pair of a part of up to ``SMALL_NODE`` documents (part is null), or a member
    a of a larger part (b is null). Documents without a likely partner in the crowd go.
    """

    def run(batches):  # noqa: ANN001, ANN202
        node, sids, roots, sketches = None, [], [], []

        def flush() -> pa.RecordBatch:
            x, n = np.array(sketches, np.int64).view(np.uint64), len(sids)
            root, rows = np.arange(n), []
            _, linked = np.unique(np.array(roots, object), return_inverse=True)
            near = [np.flatnonzero((_agree(x[i], x[i + 1 :]) >= need) & (linked[i + 1 :] != linked[i])) + i + 1 for i in range(n)]
            for i in range(n):
                for j in near[i].tolist():
                    a, b = _find(root, i), _find(root, j)
                    root[max(a, b)] = min(a, b)
            root = np.array([_find(root, i) for i in range(n)])
            size = np.bincount(root, minlength=n)
            for i in range(n):
                if size[root[i]] > SMALL_NODE:
                    rows.append((int.from_bytes(hashlib.blake2b(f"{node}/{root[i]}".encode(), digest_size=8).digest(), "little", signed=True), sids[i], None))
                else:
                    rows += [(None, min(sids[i], sids[j]), max(sids[i], sids[j])) for j in near[i].tolist()]
            part, a, b = zip(*rows, strict=True) if rows else ((), (), ())
            return pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["part", "a", "b"])

        for batch in batches:
            for own, sid, known, *s in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if own != node:
                    if sids:
                        yield flush()
                    node, sids, roots, sketches = own, [], [], []
                sids.append(sid)
                roots.append(known or sid)
                sketches.append(s)
        if sids:
            yield flush()

    crowds = crowds.select("node", "sid", "root", "s0", "s1", "s2", "s3")
    return together(crowds, ["node"], ["node", "sid"]).mapInArrow(run, "part long, a binary, b binary")


def _find(root, i: int) -> int:  # noqa: ANN001
    while root[i] != i:
        root[i] = root[root[i]]
        i = int(root[i])
    return i


def _agree(x: np.ndarray, others: np.ndarray) -> np.ndarray:
    """How many of the 64 coordinates of a sketch agree with those of each other one."""
    d = x[None, :] ^ others
    d |= d >> np.uint64(2)
    d |= d >> np.uint64(1)
    return COORDINATES - np.bitwise_count(d & np.uint64(0x1111111111111111)).sum(1).astype(np.int64)


def crowd_links(crowds: DataFrame, full: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) that span the components of each crowd (node, sid); a task holds the sets of one crowd, of bounded size."""

    def run(batches):  # noqa: ANN001, ANN202
        node, sids, sets = None, [], []

        def flush() -> pa.RecordBatch:
            links = spanning_links(sets, percent) if len(sets) > 1 else []
            return pa.RecordBatch.from_arrays([pa.array([min(sids[i], sids[j]) for i, j in links], pa.binary()), pa.array([max(sids[i], sids[j]) for i, j in links], pa.binary())], ["a", "b"])

        for batch in batches:
            members = batch.column("members")
            for i, (own, sid) in enumerate(zip(batch.column("node").to_pylist(), batch.column("sid").to_pylist(), strict=True)):
                if own != node:
                    if sets:
                        yield flush()
                    node, sids, sets = own, [], []
                sids.append(sid)
                sets.append(np.array(members[i].values))
        if sets:
            yield flush()

    return together(crowds.join(full, "sid"), ["node"], ["node", "sid"]).mapInArrow(run, "a binary, b binary")


def settle(pairs: DataFrame | None, parts: DataFrame | None, docs: DataFrame, reps: DataFrame, k: int, percent: int) -> DataFrame:
    """The links (a, b) that full sets confirm among likely pairs and within likely parts."""
    if parts is None:
        pairs, crowds = save(pairs.distinct(), "pairs"), None
        asked = pairs.select(F.col("a").alias("sid")).union(pairs.select("b"))
    else:
        parts = save(parts, "parts")
        likely = parts.where("part is null").select("a", "b")
        pairs = save((likely if pairs is None else pairs.union(likely)).distinct(), "pairs")
        members = parts.where("part is not null").select(F.col("part").alias("node"), F.col("a").alias("sid"))
        same = members.groupBy("node").agg(F.count("*").alias("n"), F.sum(F.pmod(F.xxhash64("sid"), F.lit(1 << 40))).alias("mark")).groupBy("n", "mark").agg(F.min("node").alias("node"))
        crowds = save(members.join(same.select("node"), "node", "left_semi"), "crowds")
        asked = pairs.select(F.col("a").alias("sid")).union(pairs.select("b")).union(crowds.select("sid"))
        discard(parts)
    full = full_sets(asked, docs, reps, k)
    found = verified(pairs, full, percent)
    if crowds is not None and not crowds.isEmpty():
        found = found.union(crowd_links(crowds, full, percent))
    found = save(found.distinct(), "links")
    discard(full, pairs, *([] if crowds is None else [crowds]))
    free_shuffles(docs.sparkSession)
    return found


def components(links: DataFrame) -> DataFrame:
    """(sid, root): the least sid of each connected component, by least labels of neighbours with pointer jumping."""
    both = save(links.union(links.select("b", "a")).toDF("v", "u").distinct(), "edges")
    labels = save(both.groupBy("v").agg(F.least("v", F.min("u")).alias("l")), "labels")
    while True:
        near = both.join(labels.select(F.col("v").alias("u"), "l"), "u").groupBy("v").agg(F.min("l").alias("m"))
        step = labels.join(near, "v").select("v", F.col("l").alias("was"), F.least("l", "m").alias("m"))
        jump = labels.select(F.col("v").alias("m"), F.col("l").alias("j"))
        after = save(step.join(jump, "m", "left").select("v", "was", F.least("m", F.coalesce("j", "m")).alias("l")), "labels")
        if after.where("was <> l").isEmpty():
            return after.select(F.col("v").alias("sid"), F.col("l").alias("root"))
        labels = after.select("v", "l")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, recall: float = RECALL) -> DataFrame:
    """``docs`` (doc_id, text) -> (doc_id, n_shingles, component_id), a row per row.

    Documents with 100 * intersection >= ``percent`` * union of their shingle sets are linked; component_id
    is the least doc_id that links reach. Texts with equal sets are one node. Every tree sends each document
    to the nodes that its minwise tokens name. Nodes of up to ``SMALL_NODE`` documents compare all pairs of sketches
    and confirm the likely ones on full sets. Larger nodes compare their documents with one leader first; those that this
    does not make one component are crowds, of every two blocks beyond ``CROWD`` documents. A crowd splits
    by sketches of documents not yet linked into likely parts, and each part compares all full sets at once and returns what
    spans its components, so a group of near copies never becomes a row for each pair. So a pair at the threshold that meets in any
    node, however large, is compared; ``plan`` chooses trees and sketches that miss 1 - ``recall`` of such pairs at most.
    No document is ever left out of a node, and nothing but counts comes to the driver. Columns but doc_id and text are
    left out, and an empty table gives no rows.

    Null or empty text has no shingles, no links, and its own doc_id. Rows that repeat a doc_id are rows of
    one document; rows without doc_id link others, but give no component its id (alone they have null).
    """

    trees, need = plan(recall, percent)
    paths = tree_paths(trees)
    width = max(COORDINATES, 1 + max(map(max, paths)))

    def sign(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = shingle_sets(batch.column("text"), shingle)
        least = np.array([minwise(s, width) for s in own], np.int32).reshape(len(own), width)
        sketches = np.array([sketch(x) for x in least], np.int64).reshape(len(own), 4)
        flat = pa.FixedSizeListArray.from_arrays(pa.array(least.ravel()), width).cast(pa.list_(pa.int32()))
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([len(s) for s in own], pa.int64()), pa.array([set_id(s) for s in own], pa.binary()), flat, *(pa.array(sketches[:, i]) for i in range(4))], ["doc_id", "n_shingles", "sid", "least", "s0", "s1", "s2", "s3"])

    base = save(map_batches(docs.select(F.col("doc_id").cast("long"), "text"), sign, "doc_id long, n_shingles long, sid binary, least array<int>, s0 long, s1 long, s2 long, s3 long"), "signed")
    some = base.where("n_shingles > 0")
    reps = save(some.groupBy("sid").agg(F.min("doc_id").alias("doc"), *(F.first(c).alias(c) for c in ("n_shingles", "least", "s0", "s1", "s2", "s3"))), "sets_of_docs")
    free_shuffles(docs.sparkSession)

    rows = save(branch(reps, paths).select("node", "sid", "n_shingles", "doc", "s0", "s1", "s2", "s3"), "nodes")
    sizes = rows.groupBy("node").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("weight"), F.sum(F.pmod(F.xxhash64("sid"), F.lit(1 << 40))).alias("mark"), F.min(F.struct("doc", "sid", "s0", "s1", "s2", "s3")).alias("first"))
    sizes = save(sizes.where("n > 1"), "node_sizes")
    small = rows.join(sizes.where(F.col("n") <= SMALL_NODE).select("node"), "node", "left_semi")
    x, y = small.alias("x"), small.alias("y")
    pairs = x.join(y, (F.col("x.node") == F.col("y.node")) & (F.col("x.sid") < F.col("y.sid")) & (agreement("x", "y") >= need)).select(F.col("x.sid").alias("a"), F.col("y.sid").alias("b"))
    distinct = sizes.where(F.col("n") > SMALL_NODE).groupBy("n", "weight", "mark").agg(F.min(F.struct("node", "first")).alias("one")).select("n", "weight", "one.*")  # one of those with the same documents
    large = save(distinct, "large")
    star = rows.alias("x").join(large.select("node", "first.*").alias("y"), (F.col("x.node") == F.col("y.node")) & (F.col("x.sid") != F.col("y.sid")) & (agreement("x", "y") >= need))
    pairs = pairs.union(star.select(F.least("x.sid", "y.sid").alias("a"), F.greatest("x.sid", "y.sid").alias("b")))
    links = settle(pairs, None, docs, reps, shingle, percent)
    if not large.isEmpty():
        roots = components(links)
        joined = save(rows.join(large.select("node", "n", "weight"), "node").join(roots, "sid", "left").drop("doc", "n_shingles"), "crowded")
        whole = joined.groupBy("node").agg(F.min(F.coalesce("root", "sid")).alias("x"), F.max(F.coalesce("root", "sid")).alias("y")).where("x = y").select("node")
        left = save(joined.join(whole, "node", "left_anti"), "open")
        discard(joined)
        fits = (F.col("n") <= CROWD) & (F.col("weight") <= CROWD_SHINGLES)
        crowds = left.where(fits).unionByName(in_blocks(left.where(~fits)), allowMissingColumns=True)
        links = links.union(settle(None, likely_parts(crowds, need), docs, reps, shingle, percent))
    roots = components(links)
    copies = some.groupBy("sid").agg(F.min("doc_id").alias("first"))
    owned = copies.join(roots, "sid", "left").withColumn("root", F.coalesce("root", "sid"))
    groups = owned.groupBy("root").agg(F.min("first").alias("component"))
    named = save(owned.join(groups, "root").select("sid", "component"), "named")
    return base.select("doc_id", "n_shingles", "sid").join(named, "sid", "left").select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("doc_id")).alias("component_id"))
