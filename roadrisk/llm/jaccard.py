"""N-gram Jaccard self-join by chosen paths.

Documents with the same set of shingles (five words) are one copy class; the join runs on
classes. In every run each set samples, by a hash of the run, about 1 / threshold of its
shingles; sets that share a sampled shingle meet in a bucket. A bucket of more than
``limit`` sets is split the same way again by a hash of its path, up to ``DEPTH`` times.
Small buckets are compared by brute force. A pair at the threshold survives a split with
a known chance, so the number of runs follows from the target recall.

Sets that still share a large bucket at full depth are near copies of each other in bulk.
They make a group with all sets of the other large buckets that they are in. A group is cut
into parts of bounded size, and every two parts are compared on the exact sets in one task:
each set's links are counted, and of the links only a spanning forest is listed, so
``n_links`` is the number of all links however large the group.
In small buckets comparisons use a 64-byte minwise sketch with a wide margin; every proposed
pair is then verified on the exact sets. Linked classes are joined by alternating large and
small stars on tables in the shared scratch folder.

Defined cases: two texts without words are copies (similarity 1); a text of fewer than
five words is one shingle; null texts have no words; rows that share an id or a text each
give their row; the class id is the lowest id of the class (null only if all are); an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadrisk.llm.text import Words, batch_words, mix, releasing
from roadrisk.session import materialise

SHINGLE = 5
THRESHOLD = 0.8
TARGET_RECALL = 0.999
DEPTH = 3
LIMIT = 64
PART = 1024
PART_SHINGLES = 2_000_000
SKETCH = 64
_M = np.uint64(0x9E3779B97F4A7C15)
_SKETCH_MUL = np.random.default_rng(11).integers(1, 2**63, SKETCH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def runs_needed(threshold: float, target: float, depth: int = DEPTH) -> int:
    """Runs until a pair at the threshold has met with the target probability, if its
    buckets are split ``depth`` times. Both sets sample the same shingles; a pair of equal
    sizes at similarity t shares 2t / (1 + t) of them, so each split leaves it
    a = 2 / (1 + t) common samples on average."""
    a, meet = 2 / (1 + threshold), 1.0
    for _ in range(depth):
        meet = 1 - math.exp(-a * meet)
    return max(1, math.ceil(math.log(1 - target) / math.log(1 - meet)))


def shingle_sets(w: Words, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, first): each row's distinct shingle hashes in order, rows cut by ``first``."""
    n = len(w.first) - 1
    h, at = w.shingles(size)
    row = w.row[at]
    count = np.diff(w.first)
    for s in range(1, size):  # shorter texts: all their words are one shingle
        short = np.flatnonzero(count == s)
        if len(short):
            g, where = w.shingles(s)
            keep = np.isin(where, w.first[short])
            own = w.row[where[keep]]
            h, row = np.r_[h, g[keep]], np.r_[row, own]
    order = np.lexsort((h, row))
    h, row = h[order], row[order]
    new = np.r_[True, (h[1:] != h[:-1]) | (row[1:] != row[:-1])] if len(h) else np.zeros(0, bool)
    h, row = h[new], row[new]
    return h, np.searchsorted(row, np.arange(n + 1))


def _row_sum(v: np.ndarray, first: np.ndarray) -> np.ndarray:
    total = np.r_[np.uint64(0), np.cumsum(v, dtype=np.uint64)]
    return total[first[1:]] - total[first[:-1]]


def _choose(h: np.ndarray, first: np.ndarray, row: np.ndarray, path: np.ndarray, bar: np.ndarray):
    """For each (row, path): the shingles sampled there. Returns (index of the pair, new path)."""
    n = first[row + 1] - first[row]
    pair = np.repeat(np.arange(len(row)), n)
    at = np.arange(len(pair)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first[row], n)
    v = mix(h[at] ^ np.repeat(path, n))
    hit = np.flatnonzero(v <= np.repeat(bar[row], n))
    return pair[hit], mix(v[hit] * _M + path[pair[hit]])


def profiles(docs: DataFrame, *, id_col: str, text_col: str, threshold: float, runs: int) -> DataFrame:
    """One row a document: id, text_key, node (its copy class), n (shingles), sketch, and the
    paths of its samples at each depth (``p1``; ``p2``, ``p3`` with their parents)."""
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("text_key", T.LongType()),
                           T.StructField("node", T.StringType()), T.StructField("n", T.LongType()),
                           T.StructField("sketch", T.BinaryType()),
                           *(T.StructField(c, T.ArrayType(T.LongType())) for c in ("p1", "q2", "p2", "q3", "p3"))])
    roots = mix(np.arange(1, runs + 1, dtype=np.uint64) * _M)

    def lists(row: np.ndarray, value: np.ndarray, n: int) -> pa.Array:
        order = np.argsort(row, kind="stable")
        off = np.searchsorted(row[order], np.arange(n + 1)).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(off), pa.array(value[order].view(np.int64)))

    def run(batches):
        for b in batches:
            for lo, hi, w in batch_words(b.column(2)):
                n = hi - lo
                h, first = shingle_sets(w)
                size = np.diff(first)
                with np.errstate(over="ignore"):
                    a, c = _row_sum(mix(h), first), _row_sum(mix(h * _M + np.uint64(7)), first)
                    full = np.flatnonzero(size)
                    sketch = np.zeros((n, SKETCH), np.uint8)
                    for k in range(SKETCH if len(full) else 0):
                        low = np.minimum.reduceat(h * _SKETCH_MUL[k], first[full])
                        sketch[full, k] = (mix(low) >> np.uint64(56)).astype(np.uint8)
                    share = np.minimum(1.0, 1.0 / (threshold * np.maximum(size, 1)))
                    bar = np.minimum(share * 2.0**64, 2.0**64 - 2048).astype(np.uint64)
                    got: list[list[np.ndarray]] = [[], [], [], [], [], [], [], []]
                    for root in roots:
                        pair, p1 = _choose(h, first, full, np.full(len(full), root), bar)
                        r1 = full[pair]
                        pair, p2 = _choose(h, first, r1, p1, bar)
                        r2, q2 = r1[pair], p1[pair]
                        pair, p3 = _choose(h, first, r2, p2, bar)
                        for x, v in zip(got, (r1, p1, r2, q2, p2, r2[pair], p2[pair], p3)):
                            x.append(v)
                r1, p1, r2, q2, p2, r3, q3, p3 = map(np.concatenate, got)
                node = [f"{x:016x}{y >> 32:08x}{z & 0xFFFF:04x}" for x, y, z in zip(a.tolist(), c.tolist(), size.tolist())]
                yield pa.record_batch([
                    b.column(0).slice(lo, n), b.column(1).slice(lo, n), pa.array(node), pa.array(size.astype(np.int64)),
                    pa.array([x.tobytes() for x in sketch], pa.binary()), lists(r1, p1, n), lists(r2, q2, n),
                    lists(r2, p2, n), lists(r3, q3, n), lists(r3, p3, n)], names=schema.fieldNames())

    return (docs.select(F.col(id_col), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("text_key"),
                        F.col(text_col).alias("__text")).mapInArrow(releasing(run), schema))


def _buckets(sets: DataFrame, limit: int) -> tuple[DataFrame, DataFrame]:
    """(path, node) of the small buckets of any depth, and (a, b) of those still large at
    full depth: each of their sets with the bucket's least."""
    found = []
    rows = sets.select("node", F.explode("p1").alias("path"))
    for depth in range(1, DEPTH + 1):
        size = materialise(rows.groupBy("path").agg(F.count(F.lit(1)).alias("size"), F.min("node").alias("least"))
                           .where("size > 1"), f"paths-{depth}")
        found.append(rows.join(size.where(F.col("size") <= limit), "path").select("path", "node"))
        large = size.where(F.col("size") > limit)
        if depth < DEPTH:
            pairs = F.explode(F.arrays_zip(f"q{depth + 1}", f"p{depth + 1}")).alias("x")
            rows = (sets.select("node", pairs).select("node", F.col(f"x.q{depth + 1}").alias("parent"),
                                                      F.col(f"x.p{depth + 1}").alias("path"))
                    .join(large.select(F.col("path").alias("parent")), "parent", "left_semi").select("node", "path"))
            rows = materialise(rows, f"splits-{depth + 1}")  # read twice: for sizes and for buckets
    out = found[0]
    for x in found[1:]:
        out = out.unionByName(x)
    near = rows.join(large, "path").where("node != least").select(F.col("node").alias("a"), F.col("least").alias("b")).distinct()
    return out, near


def _agreeing(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """How many of their sketch bytes each two sets share."""
    same = np.zeros((len(x), len(y)), np.uint8)
    for k in range(SKETCH):
        same += x[:, k, None] == y[None, :, k]
    return same


def _least(threshold: float) -> int:
    """Sketch bytes that sets at the threshold share nearly always."""
    spread = 4 * math.sqrt(threshold * (1 - threshold) / SKETCH)
    return int(math.floor((threshold - spread) * SKETCH))


def candidates(buckets: DataFrame, sets: DataFrame, *, threshold: float, limit: int) -> DataFrame:
    """(a, b) with a < b: pairs of classes in a small bucket whose sketches allow the threshold."""
    rows = buckets.join(sets.select("node", "sketch"), "node")
    # a bucket has ``limit`` sets at most; its rows come together by key, in order
    rows = rows.select("path", "node", "sketch").repartition("path").sortWithinPartitions("path", "node")
    least = _least(threshold)

    def run(batches):
        path = None
        names: list[str] = []
        sketches: list[bytes] = []

        def group():
            s = np.frombuffer(b"".join(sketches), np.uint8).reshape(-1, SKETCH)
            i, j = np.nonzero(np.triu(_agreeing(s, s) >= least, 1))
            for x, y in zip(i.tolist(), j.tolist()):
                yield names[x], names[y]

        for b in batches:
            found = set()
            for p, node, sketch in zip(*(c.to_pylist() for c in b.columns)):
                if p != path:
                    if len(names) > 1:
                        found.update(group())
                    path, names, sketches = p, [], []
                names.append(node)
                sketches.append(sketch)
            yield _pairs_batch(found)
        if len(names) > 1:
            yield _pairs_batch(set(group()))

    return rows.mapInArrow(releasing(run), "a string, b string").distinct()


def _pairs_batch(found: set[tuple[str, str]]) -> pa.RecordBatch:
    pairs = sorted((min(x), max(x)) for x in found)
    return pa.record_batch([pa.array([x for x, _ in pairs], pa.string()), pa.array([y for _, y in pairs], pa.string())],
                           names=["a", "b"])


def _exact(nodes: DataFrame, sets: DataFrame, docs: DataFrame, *, text_col: str, name: str) -> DataFrame:
    """(node, h) of the nodes: their exact shingle sets, as sorted hashes."""
    def shingles(batches):
        for b in batches:
            for lo, hi, w in batch_words(b.column(1)):
                h, first = shingle_sets(w)
                yield pa.record_batch([b.column(0).slice(lo, hi - lo),
                                       pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(h.view(np.int64)))],
                                      names=["node", "h"])

    keys = sets.select("node", "text_key").join(nodes, "node", "left_semi")
    texts = docs.select(F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("text_key"), F.col(text_col).alias("text"))
    return materialise(texts.join(keys, "text_key").groupBy("node").agg(F.first("text").alias("text"))
                       .mapInArrow(releasing(shingles), "node string, h array<long>"), name)


def verified(pairs: DataFrame, sets: DataFrame, docs: DataFrame, *, text_col: str, threshold: float) -> DataFrame:
    """(a, b, similarity) of the pairs at the threshold, from the exact shingle sets."""
    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    exact = _exact(wanted, sets, docs, text_col=text_col, name="jaccard-sets")
    both = (pairs.join(exact.select(F.col("node").alias("a"), F.col("h").alias("ha")), "a")
            .join(exact.select(F.col("node").alias("b"), F.col("h").alias("hb")), "b"))

    def compare(batches):
        for b in batches:
            la, lb = b.column(2), b.column(3)
            va, vb = la.values.to_numpy(), lb.values.to_numpy()
            oa, ob = la.offsets.to_numpy(), lb.offsets.to_numpy()
            sim = np.zeros(b.num_rows)
            for r in range(b.num_rows):
                x, y = va[oa[r]:oa[r + 1]], vb[ob[r]:ob[r + 1]]
                inter = len(np.intersect1d(x, y, assume_unique=True))
                sim[r] = inter / (len(x) + len(y) - inter)
            keep = pa.array(sim >= threshold - 1e-12)
            yield pa.record_batch([b.column(0), b.column(1), pa.array(sim)], names=["a", "b", "similarity"]).filter(keep)

    return both.select("a", "b", "ha", "hb").mapInArrow(releasing(compare), "a string, b string, similarity double")


def _shared(x: list[np.ndarray], y: list[np.ndarray]) -> np.ndarray:
    """How many shingles each set of ``x`` shares with each of ``y``."""
    hx, hy = np.concatenate(x), np.concatenate(y)
    both = np.intersect1d(hx, hy)
    out = np.zeros((len(x), len(y)), np.float32)
    places = []
    for sets, h in ((x, hx), (y, hy)):
        row = np.repeat(np.arange(len(sets)), [len(v) for v in sets])
        at = np.minimum(np.searchsorted(both, h), max(0, len(both) - 1))
        mine = both[at] == h if len(both) else np.zeros(len(h), bool)
        order = np.argsort(at[mine], kind="stable")
        places.append((row[mine][order], at[mine][order]))
    for lo in range(0, len(both), 4096):  # sums of whole numbers under 2 ** 24 are exact
        dense = []
        for sets, (row, at) in zip((x, y), places):
            cut = slice(*np.searchsorted(at, [lo, lo + 4096]))
            d = np.zeros((len(sets), min(4096, len(both) - lo)), np.float32)
            d[row[cut], at[cut] - lo] = 1
            dense.append(d)
        out += dense[0] @ dense[1].T
    return out


def _linked(x: list[np.ndarray], y: list[np.ndarray], sx: np.ndarray, sy: np.ndarray, threshold: float) -> np.ndarray:
    """Which sets of ``x`` are at the threshold with which of ``y``; only rows and columns
    with a pair that the sketches allow are compared exactly."""
    may = _agreeing(sx, sy) >= _least(threshold)
    out = np.zeros(may.shape, bool)
    i, j = np.flatnonzero(may.any(axis=1)), np.flatnonzero(may.any(axis=0))
    if len(i):
        inter = _shared([x[k] for k in i], [y[k] for k in j]).astype(np.float64)
        nx, ny = np.array([len(x[k]) for k in i]), np.array([len(y[k]) for k in j])
        out[np.ix_(i, j)] = (inter / (nx[:, None] + ny[None, :] - inter) >= threshold - 1e-12) & may[np.ix_(i, j)]
    return out


def _forest(near: np.ndarray) -> list[tuple[int, int]]:
    """Edges that span each connected part of a symmetric relation."""
    edges, new = [], np.ones(len(near), bool)
    for start in range(len(near)):
        todo = [start] if new[start] else []
        new[start] = False
        while todo:
            u = todo.pop()
            found = np.flatnonzero(near[u] & new)
            new[found] = False
            todo += found.tolist()
            edges += [(u, v) for v in found.tolist()]
    return edges


def group_links(groups: DataFrame, sets: DataFrame, docs: DataFrame, *, text_col: str, threshold: float) -> DataFrame:
    """(a, b, n) of the groups (node, root): with b, a link of a spanning forest of two
    parts; without, that a has n links to sets of such parts. Sets of every two parts meet
    once, so the sum of n counts every link of a within its group."""
    exact = _exact(groups, sets, docs, text_col=text_col, name="jaccard-group-sets")
    here = groups.join(sets.select("node", "n", "sketch"), "node")
    parts = here.groupBy("root").agg(F.ceil(F.greatest(F.count(F.lit(1)) / PART, F.sum("n") / PART_SHINGLES)).cast("long").alias("parts"))
    rows = (here.join(parts, "root").withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")))
            .join(exact, "node")
            .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
            .select("root", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "part", "node", "sketch", "h")
            .repartition("root", "i", "j").sortWithinPartitions("root", "i", "j", "part", "node"))

    def links(key, part, names, sketches, hashes) -> pa.RecordBatch:
        s = np.frombuffer(b"".join(sketches), np.uint8).reshape(-1, SKETCH)
        near = np.zeros((len(names), len(names)), bool)
        cut = part.count(key[1])  # the sets of part i come first
        if key[1] == key[2]:
            near = _linked(hashes, hashes, s, s, threshold)
            np.fill_diagonal(near, False)
        elif 0 < cut < len(names):
            near[:cut, cut:] = _linked(hashes[:cut], hashes[cut:], s[:cut], s[cut:], threshold)
            near |= near.T
        n = near.sum(axis=1)
        some = np.flatnonzero(n).tolist()
        edges = _forest(near)
        return pa.record_batch([pa.array([names[u] for u, _ in edges] + [names[u] for u in some], pa.string()),
                                pa.array([names[v] for _, v in edges] + [None] * len(some), pa.string()),
                                pa.array([0] * len(edges) + [int(n[u]) for u in some], pa.int64())], names=["a", "b", "n"])

    def run(batches):
        key, got = None, ([], [], [], [])
        for b in batches:
            h, off = b.column(6).values.to_numpy(), b.column(6).offsets.to_numpy()
            for r, (root, i, j, part, node, sketch) in enumerate(zip(*(c.to_pylist() for c in b.columns[:6]))):
                if (root, i, j) != key:
                    if key:
                        yield links(key, *got)
                    key, got = (root, i, j), ([], [], [], [])
                for x, v in zip(got, (part, node, sketch, h[off[r]:off[r + 1]].copy())):
                    x.append(v)
        if key:
            yield links(key, *got)

    return rows.mapInArrow(releasing(run), "a string, b string, n long")


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root): the least node of each node's connected component."""
    edges = materialise(links.select("a", "b"), "stars")
    for _ in range(max_rounds):
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct()
        # now every edge points from a to a smaller b
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b")
                 .union(low.select("a", F.col("m").alias("b"))).distinct())
        nxt = materialise(small, "stars")
        done = [tuple(x.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()) for x in (
            edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")), nxt)]
        edges = nxt
        if done[0] == done[1]:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    raise RuntimeError(f"the components did not settle in {max_rounds} rounds")


def classes(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD,
            target_recall: float = TARGET_RECALL, limit: int = LIMIT) -> tuple[DataFrame, DataFrame]:
    """(rows: id, text_key, node of every document; copy classes: node, low_id, rows, root, n_links)."""
    runs = runs_needed(threshold, target_recall)
    base = materialise(profiles(docs, id_col=id_col, text_col=text_col, threshold=threshold, runs=runs), "jaccard-profiles")
    sets = materialise(base.groupBy("node").agg(
        F.first(F.struct("text_key", "n", "sketch", "p1", "q2", "p2", "q3", "p3")).alias("s"),
        F.min("id").alias("low_id"), F.count(F.lit(1)).alias("rows")).select("node", "s.*", "low_id", "rows"), "jaccard-classes")
    small, near = _buckets(sets.where("n > 0"), limit)
    groups = components(materialise(near, "jaccard-near"))  # without the roots themselves
    groups = groups.union(groups.select("root", "root").distinct())
    inside = materialise(group_links(groups, sets, docs, text_col=text_col, threshold=threshold), "jaccard-group-links")
    pairs = candidates(small, sets, threshold=threshold, limit=limit)
    of = {c: groups.select(F.col("node").alias(c), F.col("root").alias(f"group_{c}")) for c in "ab"}
    pairs = materialise(pairs.join(of["a"], "a", "left").join(of["b"], "b", "left")  # pairs of a group are counted there
                        .where("group_a is null or group_b is null or group_a != group_b").select("a", "b"), "jaccard-candidates")
    links = materialise(verified(pairs, sets, docs, text_col=text_col, threshold=threshold), "jaccard-links")
    roots = components(links.select("a", "b").union(inside.where("b is not null").select("a", "b")))
    one = F.lit(1).cast("long")
    degree = (links.select(F.col("a").alias("node"), one.alias("n")).union(links.select("b", one))
              .union(inside.where("b is null").select("a", "n")).groupBy("node").agg(F.sum("n").alias("n_links")))
    found = (sets.select("node", "low_id", "rows").join(roots, "node", "left").join(degree, "node", "left")
             .select("node", "low_id", "rows", F.coalesce("root", "node").alias("root"), F.coalesce("n_links", F.lit(0)).alias("n_links")))
    return base.select("id", "text_key", "node"), materialise(found, "jaccard-components")


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", **kw) -> DataFrame:
    """Per document row: its id, text_key, class_id (lowest id of all documents linked to it
    directly or through others, itself included), n_links (other texts' classes it is
    linked to) and n_copies (other rows with the same shingles)."""
    rows, found = classes(docs, id_col=id_col, **kw)
    lowest = found.groupBy("root").agg(F.min("low_id").alias("class_id"))
    return (rows.join(found.join(lowest, "root"), "node")
            .select(F.col("id").alias(id_col), "text_key", "class_id", "n_links", (F.col("rows") - 1).alias("n_copies")))


def keep_one(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """``docs`` with one row of each class: the lowest id's, then the lowest text_key's."""
    rows, found = classes(docs, id_col=id_col, text_col=text_col, **kw)
    stays = (rows.join(found.select("node", "root"), "node").groupBy("root").agg(F.min(F.struct("id", "text_key")).alias("s"))
             .select(F.xxhash64("s.id", "s.text_key").alias("_j_key")))
    key = F.xxhash64(F.col(id_col), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))))
    return docs.withColumn("_j_key", key).join(stays, "_j_key", "left_semi").dropDuplicates(["_j_key"]).drop("_j_key")
