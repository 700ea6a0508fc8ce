"""Best-fit packing of tokenised documents into sequences of a fixed length.

Pattern packing by non-negative least squares: all patterns of up to three lengths that
fill a sequence are enumerated, their repeat counts are fitted to the histogram of piece
lengths, rounded down to what the histogram holds, and the pieces left over are packed
best-fit by decreasing length. Fitting and packing work on the histogram alone (at most
``capacity`` numbers, however many documents there are) and give a table of runs: pieces
of one length with ranks in a range go to a range of sequences at one offset. Spark ranks
the pieces within their length and looks their run up; no list of documents is ever
gathered.

Defined cases: a null or empty text has the end id alone; a document longer than the
capacity is cut into full pieces and its first piece may be shorter; repeated rows and
equal ids are packed as rows of their own; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadrisk.llm.bpe import encoder
from roadrisk.llm.text import releasing
from roadrisk.session import materialise

CAPACITY = 1024
END_ID = 2


def pieces(docs: DataFrame, tokenizer: str, *, id_col: str = "doc_id", text_col: str = "text",
           capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """(id, piece, start, length, ids_crc32[, ids]) of every piece of every document."""
    tail = end_id.to_bytes(4, "little")
    fields = [T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("piece", T.IntegerType()),
              T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
              T.StructField("ids_crc32", T.LongType())]
    if with_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.IntegerType())))

    def run(batches):
        enc = encoder(tokenizer)
        for b in batches:
            for lo, _, ids, offsets in enc.columns(b.column(1), end_id):
                n = np.diff(offsets)
                pieces_ = -(-n // capacity)
                row = np.repeat(np.arange(len(n)), pieces_)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces_) - pieces_, pieces_)
                # all pieces but the first are full
                first = n - (pieces_ - 1) * capacity
                start = np.where(piece == 0, 0, first[row] + (piece - 1) * capacity)
                length = np.where(piece == 0, first[row], capacity)
                at = offsets[row] + start
                crc = [zlib.crc32(ids[a:a + k]) for a, k in zip(at.tolist(), length.tolist())]
                out = [b.column(0).take(pa.array(lo + row)), pa.array(piece.astype(np.int32)), pa.array(start),
                       pa.array(length), pa.array(crc, pa.int64())]
                if with_ids:  # the pieces of a row lie one after another, and the rows too
                    out.append(pa.ListArray.from_arrays(pa.array(np.r_[at, offsets[-1]].astype(np.int32)), pa.array(ids.view("<i4"))))
                yield pa.record_batch(out, names=[f.name for f in fields])

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(releasing(run), T.StructType(fields))


def fit_patterns(hist: np.ndarray, capacity: int, steps: int = 300) -> tuple[np.ndarray, np.ndarray]:
    """Patterns (rows of up to three lengths, 0 for none) that fill a sequence, and their
    fitted non-negative repeat counts: min || A x - hist ||, x >= 0, by accelerated
    projected gradient steps. ``hist[n]`` is the number of pieces of length n."""
    have = np.flatnonzero(hist[1:capacity]) + 1
    i, j = np.meshgrid(have, have, indexing="ij")
    c = capacity - i - j
    keep = (i >= j) & (c <= j) & (c >= 0)
    pat = np.stack([i[keep], j[keep], c[keep]], axis=1)
    pat = pat[(pat[:, 2] == 0) | (hist[pat[:, 2]] > 0)]
    if not len(pat):
        return pat, np.zeros(0)
    target = hist[:capacity + 1].astype(float)
    target[0] = 0.0
    scale = 1.0 / np.sqrt(np.maximum(target, 1.0))  # rare lengths weigh as much as frequent ones

    def forward(x):
        y = sum(np.bincount(pat[:, k], x, capacity + 1) for k in range(3))
        y[0] = 0.0
        return y

    def back(r):
        r = r.copy()
        r[0] = 0.0
        return r[pat[:, 0]] + r[pat[:, 1]] + r[pat[:, 2]]

    v = np.ones(len(pat))
    for _ in range(20):  # largest singular value
        v = back(scale ** 2 * forward(v))
        top = np.linalg.norm(v)
        v /= top
    x = y = np.zeros(len(pat))
    t = 1.0
    for _ in range(steps):
        nxt = np.maximum(0.0, y - back(scale ** 2 * (forward(y) - target)) / (1.05 * top))
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = nxt + (t - 1) / t2 * (nxt - x)
        x, t = nxt, t2
    return pat, x


def plan(hist: np.ndarray, capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Runs (length, first rank, count, first sequence, offset) that place every piece of
    the histogram once; bounded by the capacity, not by the number of pieces."""
    left = hist.astype(np.int64).copy()
    used = np.zeros(capacity + 1, np.int64)
    runs: list[tuple[int, int, int, int, int]] = []
    seq = 0

    def put(length: int, n: int, first_seq: int, offset: int) -> None:
        runs.append((length, int(used[length]), n, first_seq, offset))
        used[length] += n
        left[length] -= n

    if left[capacity]:
        n = int(left[capacity])
        put(capacity, n, seq, 0)
        seq += n
    pat, x = fit_patterns(left, capacity)
    for p in np.argsort(-x, kind="stable"):
        n = int(x[p] + 1e-6)
        if n == 0:
            break
        parts = [int(k) for k in pat[p] if k]
        n = min(n, *(int(left[k]) // parts.count(k) for k in parts))
        if n <= 0:
            continue
        at = 0
        for k in parts:
            put(k, n, seq, at)
            at += k
        seq += n
    # best fit, longest first; open[s]: ranges of sequences with s places left
    open_: dict[int, list[tuple[int, int]]] = {}
    room = np.zeros(capacity + 1, np.int64)  # open sequences by places left
    for length in range(capacity - 1, 0, -1):
        while left[length]:
            fits = np.flatnonzero(room[length:])
            if not len(fits):
                # new sequences: as many pieces in each as fit would crowd out better fits, so one
                n = max(1, -(-int(left[length]) // (capacity // length)))
                open_.setdefault(capacity, []).append((seq, n))
                room[capacity] += n
                seq += n
                continue
            space = length + int(fits[0])
            first, n = open_[space].pop()
            k = min(n, int(left[length]))
            put(length, k, first, capacity - space)
            if n > k:
                open_[space].append((first + k, n - k))
            room[space] -= k
            if space > length:
                open_.setdefault(space - length, []).append((first, k))
                room[space - length] += k
    return runs


def place(parts: DataFrame, capacity: int = CAPACITY, id_col: str = "doc_id") -> DataFrame:
    """Add sequence_id and offset to the rows of ``pieces`` (a table that can be read again)."""
    hist = np.zeros(capacity + 1, np.int64)
    for r in parts.groupBy("length").count().collect():  # at most ``capacity`` rows
        hist[r["length"]] = r["count"]
    total = int(hist.sum())
    runs = sorted(plan(hist, capacity)) if total else []
    length, first, _, seq, offset = (np.array([r[k] for r in runs], np.int64) for k in range(5))
    found = parts.sparkSession.sparkContext.broadcast(((length << 44) + first, first, seq, offset))

    # the rank of a piece within its length: by salt first, so no length is one task's
    salts = max(8, total // 100_000)
    salted = parts.withColumn("__salt", F.pmod(F.xxhash64(id_col, "piece", "ids_crc32"), F.lit(salts)))
    base = (salted.groupBy("length", "__salt").count()
            .withColumn("__base", F.sum("count").over(
                Window.partitionBy("length").orderBy("__salt").rowsBetween(Window.unboundedPreceding, -1)))
            .select("length", "__salt", F.coalesce("__base", F.lit(0)).alias("__base")))
    order = Window.partitionBy("length", "__salt").orderBy(id_col, "piece", "ids_crc32")
    ranked = (salted.withColumn("__rank", F.row_number().over(order)).join(base, ["length", "__salt"])
              .withColumn("__rank", F.col("__base") + F.col("__rank") - 1)
              .select(*parts.columns, "__rank"))
    schema = T.StructType([*parts.schema.fields, T.StructField("sequence_id", T.LongType()),
                           T.StructField("offset", T.LongType())])

    def run(batches):
        keys, first_, seq_, offset_ = found.value
        for b in batches:
            n = b.column(b.schema.get_field_index("length")).to_numpy(zero_copy_only=False)
            rank = b.column(b.num_columns - 1).to_numpy(zero_copy_only=False)
            k = np.searchsorted(keys, (n << 44) + rank, side="right") - 1
            yield pa.record_batch([*b.columns[:-1], pa.array(seq_[k] + rank - first_[k]), pa.array(offset_[k])],
                                  names=schema.fieldNames())

    return ranked.mapInArrow(releasing(run), schema)


def pack(docs: DataFrame, tokenizer: str, *, id_col: str = "doc_id", text_col: str = "text",
         capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """All pieces of ``docs`` with the sequence and offset that they are packed to."""
    parts = materialise(pieces(docs, tokenizer, id_col=id_col, text_col=text_col, capacity=capacity,
                               end_id=end_id, with_ids=with_ids), "pieces")
    return place(parts, capacity, id_col)
