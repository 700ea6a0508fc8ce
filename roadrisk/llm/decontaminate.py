"""Benchmark decontamination: an exact prefix-filtered join of item windows with documents.

A window is 13 consecutive words of a benchmark item (all words of a shorter item). Its
shingles (five words, or all of a shorter window) are ordered by how many documents hold
them. As a window must be contained whole, its necessary prefix is one shingle: the
rarest. Documents meet windows on prefix shingles only; the shingle's place in the window
gives the one place the window could start, the length and positional bounds drop
candidates that would leave the text, and the words themselves decide.

Two passes over the documents, no shuffle of their texts: one counts the benchmark's
shingles, one joins. The benchmark is used in blocks of at most ``block`` windows, so what
is broadcast stays bounded however long the benchmark is.

Defined cases: a null or word-less text has no words and isn't contaminated; a null or
word-less item has no windows; an item without an id marks words but isn't counted or
named; equal windows of several items name all of them; repeated document rows each give
their row; other columns of either table are ignored; empty tables give no rows, or
documents without hits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadrisk.llm.text import batch_words, releasing, utf8, words
from roadrisk.session import materialise

WINDOW = 13
SHINGLE = 5
_BITS = 20


def item_windows(benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text",
                 window: int = WINDOW) -> DataFrame:
    """(item_id string, window): every window of every item, words joined by one space."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, w in batch_words(b.column(1)):
                ids, out = [], []
                for r in range(hi - lo):
                    first, n = int(w.first[r]), int(w.first[r + 1] - w.first[r])
                    size = min(n, window)
                    for k in range(n - size + 1 if n else 0):
                        ids.append(b.column(0)[lo + r].as_py())
                        out.append(w.joined(first + k, size).decode())
                    if len(out) > 20_000:
                        yield pa.record_batch([pa.array(ids, pa.string()), pa.array(out, pa.string())],
                                              names=["item_id", "window"])
                        ids, out = [], []
                yield pa.record_batch([pa.array(ids, pa.string()), pa.array(out, pa.string())],
                                      names=["item_id", "window"])

    return (benchmark.select(F.col(item_col).cast("string").alias("item_id"), F.col(text_col).alias("text"))
            .mapInArrow(releasing(run), "item_id string, window string").distinct())


class _Block:
    """One block of windows with the hashes that find them (built on the driver, broadcast)."""

    def __init__(self, pairs: list[tuple[str | None, str]]):
        distinct: dict[str, list[str]] = {}
        for item, window in pairs:
            distinct.setdefault(window, [])
            if item is not None:
                distinct[window].append(item)
        self.windows = [x.encode() for x in distinct]
        self.items = list(distinct.values())
        w = words(*utf8(pa.array(list(distinct), pa.large_string())))
        self.size = np.diff(w.first)
        self.word = np.zeros((len(distinct), int(self.size.max(initial=1))), np.uint64)
        for i, (a, b) in enumerate(zip(w.first, w.first[1:])):
            self.word[i, :b - a] = w.hash[a:b]
        rows, places, hashes, sizes = [], [], [], []
        row = w.row
        for s in sorted({min(int(n), SHINGLE) for n in set(self.size.tolist())}):
            h, at = w.shingles(s)
            keep = np.minimum(self.size[row[at]], SHINGLE) == s
            rows.append(row[at][keep])
            places.append((at - w.first[row[at]])[keep])
            hashes.append(h[keep])
            sizes.append(np.full(int(keep.sum()), s))
        self.s_row, self.s_place, self.s_hash, self.s_size = map(np.concatenate, (rows, places, hashes, sizes))
        self.sizes = sorted(set(self.s_size.tolist()))

    def shingle_sets(self) -> dict[int, np.ndarray]:
        return {s: np.unique(self.s_hash[self.s_size == s]) for s in self.sizes}

    def choose_prefix(self, df: dict[int, int]) -> None:
        """Keep each window's rarest shingle (ties: the smaller hash, then the first place)."""
        count = np.array([df.get(int(h), 0) for h in self.s_hash.view(np.int64)], dtype=np.int64)
        order = np.lexsort((self.s_place, self.s_hash, count, self.s_row))
        rows = self.s_row[order]
        best = order[np.r_[True, rows[1:] != rows[:-1]]]
        best = best[np.argsort(self.s_hash[best], kind="stable")]
        self.p_hash, self.p_row = self.s_hash[best], self.s_row[best]
        self.p_place, self.p_size = self.s_place[best], self.s_size[best]
        self.s_row = self.s_place = self.s_hash = self.s_size = None


def _bitmap(hashes: np.ndarray) -> np.ndarray:
    seen = np.zeros(1 << _BITS, dtype=bool)
    seen[hashes >> np.uint64(64 - _BITS)] = True
    return seen


def _find(h: np.ndarray, seen: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Indices of ``h`` whose value is in the sorted ``wanted``."""
    maybe = np.flatnonzero(seen[h >> np.uint64(64 - _BITS)])
    at = np.searchsorted(wanted, h[maybe])
    return maybe[wanted[np.minimum(at, len(wanted) - 1)] == h[maybe]]


def _document_counts(docs: DataFrame, sets, text_col: str) -> dict[int, int]:
    """In how many document rows each of a block's shingles occurs (bounded by the block)."""
    def run(batches):
        wanted = sets.value
        seen = {s: _bitmap(x) for s, x in wanted.items()}
        for b in batches:
            for lo, hi, w in batch_words(b.column(0)):
                row = w.row
                for s, x in wanted.items():
                    h, at = w.shingles(s)
                    k = _find(h, seen[s], x)
                    pair = np.unique(np.stack([row[at[k]].astype(np.uint64), h[k]]), axis=1)
                    value, n = np.unique(pair[1], return_counts=True)
                    yield pa.record_batch([pa.array(value.view(np.int64)), pa.array(n)], names=["h", "n"])

    counted = docs.select(text_col).mapInArrow(releasing(run), "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    return {r["h"]: r["n"] for r in counted.toLocalIterator()}


def _hits(w, block: _Block, seen: dict, row: np.ndarray):
    """Verified occurrences in a chunk: (first word, window)."""
    starts, wins = [], []
    for s in block.sizes:
        h, at = w.shingles(s)
        mine = block.p_size == s
        p_hash, p_row, p_place = block.p_hash[mine], block.p_row[mine], block.p_place[mine]
        if not len(p_hash):
            continue
        k = _find(h, seen[s], p_hash)
        a, b = np.searchsorted(p_hash, h[k], "left"), np.searchsorted(p_hash, h[k], "right")
        n = b - a
        j = np.repeat(a - np.cumsum(n) + n, n) + np.arange(int(n.sum()))
        at_word = np.repeat(at[k], n)
        starts.append(at_word - p_place[j])
        wins.append(p_row[j])
        here = row[at_word]  # positional and length bounds: the window stays inside its text
        ok = (starts[-1] >= w.first[here]) & (starts[-1] + block.size[wins[-1]] <= w.first[here + 1])
        starts[-1], wins[-1] = starts[-1][ok], wins[-1][ok]
    if not starts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    start, win = np.concatenate(starts), np.concatenate(wins)
    for j in range(block.word.shape[1]):  # word by word, by hash
        ok = (j >= block.size[win]) | (w.hash[np.minimum(start + j, len(w.hash) - 1)] == block.word[win, j])
        start, win = start[ok], win[ok]
    same = [w.joined(int(a), int(block.size[i])) == block.windows[i] for a, i in zip(start, win)]  # and by text
    same = np.array(same, dtype=bool)
    return start[same], win[same]


def contamination(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
                  block: int = 100_000, one_in: int = 20) -> DataFrame:
    """Per document row: its id, text_key (Spark's xxhash64 of the text), n_words, n_hit (words inside an occurrence of a window),
    n_items, items (sorted ids), items_sha256 and contaminated (n_hit > 0 and
    ``one_in`` * n_hit >= n_words)."""
    spark = docs.sparkSession
    pairs = materialise(item_windows(benchmark, item_col, item_text_col, window), "bench-windows")
    n_blocks = max(1, -(-pairs.count() // block))
    docs = docs.select(F.col(id_col), F.col(text_col).alias("__text"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("text_key"))
    id_type = docs.schema[id_col].dataType
    schema = T.StructType([T.StructField(id_col, id_type), T.StructField("text_key", T.LongType()),
                           T.StructField("n_words", T.LongType()), T.StructField("spans", T.ArrayType(T.LongType())),
                           T.StructField("items", T.ArrayType(T.StringType()))])
    parts = []
    for i in range(n_blocks):
        mine = pairs.where(F.pmod(F.xxhash64("item_id", "window"), F.lit(n_blocks)) == i)
        found = [(r["item_id"], r["window"]) for r in mine.toLocalIterator()]
        if not found and i < n_blocks - 1:
            continue
        b = None
        if found:
            b = _Block(found)
            b.choose_prefix(_document_counts(docs, spark.sparkContext.broadcast(b.shingle_sets()), "__text"))
        parts.append(_join(docs, spark.sparkContext.broadcast(b), schema))
    out = parts[0]
    if len(parts) > 1:  # a row comes back from every block: put its hits together
        for p in parts[1:]:
            out = out.unionByName(p)
        out = (out.groupBy(id_col, "text_key", "n_words")
               .agg((F.count(F.lit(1)) / len(parts)).cast("int").alias("copies"),
                    F.flatten(F.collect_set("spans")).alias("spans"), F.flatten(F.collect_set("items")).alias("items"))
               .withColumn("copies", F.explode(F.sequence(F.lit(1), F.col("copies")))).drop("copies"))
    hit = F.expr("aggregate(array_sort(transform(sequence(0, cast(size(spans) / 2 as int) - 1), "
                 "i -> named_struct('a', spans[2 * i], 'b', spans[2 * i + 1]))), "
                 "named_struct('end', 0L, 'n', 0L), (s, x) -> named_struct("
                 "'end', greatest(s.end, x.b), 'n', s.n + greatest(0L, x.b - greatest(s.end, x.a))), s -> s.n)")
    return (out.withColumn("items", F.array_sort(F.array_distinct("items")))
            .withColumn("n_hit", F.when(F.size("spans") > 0, hit).otherwise(F.lit(0).cast("long")))
            .withColumn("n_items", F.size("items").cast("long"))
            .withColumn("items_sha256", F.sha2(F.array_join("items", ","), 256))
            .withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * one_in >= F.col("n_words")))
            .select(id_col, "text_key", "n_words", "n_hit", "n_items", "items", "items_sha256", "contaminated"))


def _join(docs: DataFrame, block_b, schema: T.StructType) -> DataFrame:
    """(id, text_key, n_words, hit spans as flat [from, to) word positions, items)
    of every document row for one block."""
    def run(batches):
        block = block_b.value
        seen = {} if block is None else {s: _bitmap(block.p_hash[block.p_size == s]) for s in block.sizes}
        for b in batches:
            for lo, hi, w in batch_words(b.column(1)):
                n = hi - lo
                spans, items = [[] for _ in range(n)], [[] for _ in range(n)]
                if block is not None:
                    row = w.row
                    start, win = _hits(w, block, seen, row)
                    if len(start):
                        of = row[start]
                        for r in np.unique(of).tolist():
                            mine = of == r
                            s, i = start[mine] - w.first[r], win[mine]
                            spans[r] = _merge(s, s + block.size[i])
                            items[r] = sorted({x for k in np.unique(i).tolist() for x in block.items[k]})
                yield pa.record_batch([
                    b.column(0).slice(lo, n),
                    b.column(2).slice(lo, n), pa.array(np.diff(w.first).astype(np.int64)), pa.array(spans, pa.list_(pa.int64())),
                    pa.array(items, pa.list_(pa.string()))], names=schema.fieldNames())

    return docs.mapInArrow(releasing(run), schema)


def _merge(a: np.ndarray, b: np.ndarray) -> list[int]:
    """Union of the ranges [a, b), flat and in order."""
    order = np.argsort(a, kind="stable")
    a, b = a[order], np.maximum.accumulate(b[order])
    new = np.r_[True, a[1:] > b[:-1]]
    ends = np.r_[np.flatnonzero(new)[1:] - 1, len(a) - 1]
    return np.stack([a[new], b[ends]], axis=1).ravel().tolist()
