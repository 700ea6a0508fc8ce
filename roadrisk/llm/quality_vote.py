"""Quality by nearest-neighbour votes among labelled latent-semantic vectors.

A text's terms are its words and the forms of its white-space tokens (runs of lower case,
capitals and digits shrink to one mark, so ``WORD!!`` and ``word###`` differ from ``word``),
with marks for a word that repeats the one before and for a three-word window or a line
that the text has had already. Words and forms are hashed into two fields of fixed width,
weighted by TF-IDF (document frequencies over all documents) and brought to unit length
field by field. A truncated singular value decomposition of the labelled examples, found by
subspace iteration whose passes run in Spark, gives the latent space.

The examples' latent vectors (at most ``EXAMPLES``, half of each label where there are
enough; chosen by a hash of the id) are broadcast. Every document's cosine with every
example is computed in blocks of examples; the ``NEIGHBOURS`` best vote with the square of
their cosine, each example weighing as many labelled rows as it stands for, and one vote's
worth of the label's overall rate steadies weak evidence. Examples of one cosine at the
border all vote, so ties need no order.

Defined cases: a null, empty or term-less text scores the label's overall rate; without
labelled rows every score is 0; null labels, labels other than 0 and 1 and labels of unknown
ids are ignored; an id labelled more than once has the mean of its labels, and of several
texts of one id the greatest is the example; repeated documents each give their row; empty
tables give no rows; other columns are ignored. Labels, language, source and id are never
inputs of a score.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadrisk.llm.text import Words, _hash, chunks, mix, utf8, words
from roadrisk.session import drop_scratch, scratch_path

EXAMPLES = 4000
RANK = 64
NEIGHBOURS = 25
#: Hash buckets of the two fields.
WORD_DIMS, FORM_DIMS = 1 << 13, 1 << 11
DIMS = WORD_DIMS + FORM_DIMS
BLOCK = 1024
_ROWS = 256
_CHUNK = 2 << 20
_PARTS = 8
_SAME, _WINDOW, _LINE = (np.uint64(k) for k in (0x51, 0x52, 0x53))

#: Byte classes of a form: letters, digits, white space; any other byte is its own class.
_CLASS = np.arange(256, dtype=np.uint8)
_CLASS[97:123] = _CLASS[128:] = 97
_CLASS[65:91] = 65
_CLASS[48:58] = 48
_CLASS[9:14] = 32


def held_out(id_col: str = "doc_id"):
    """Rows whose labels are never learnt from (a null id: as the empty text)."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 3 == 1


def _again(row: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Which elements equal an earlier one of their row."""
    with np.errstate(over="ignore"):
        key = mix(h ^ (row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    order = np.argsort(key, kind="stable")
    out = np.zeros(len(key), dtype=bool)
    out[order[1:]] = key[order[1:]] == key[order[:-1]]
    return out


def _runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of ``inside`` within each row."""
    n = len(inside)
    cut = np.zeros(n + 1, dtype=bool)
    cut[offsets] = True
    before, here = np.r_[False, inside], np.r_[inside, False]
    return np.flatnonzero(here & (~before | cut)), np.flatnonzero(before & (~here | cut))


def _forms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of the form of every white-space token."""
    kind = _CLASS[data]
    start, end = _runs(kind != 32, offsets)
    if not len(start):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    keep = np.r_[True, kind[1:] != kind[:-1]]
    keep[start] = True
    place = np.r_[0, np.cumsum(keep)]
    row = np.searchsorted(offsets, start, side="right") - 1
    return row, _hash(kind[keep], place[start], place[end])


def _lines(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Rows of the lines that equal an earlier line of their text (once for each)."""
    start, end = _runs(data != 10, offsets)
    row = np.searchsorted(offsets, start, side="right") - 1
    return row[_again(row, _hash(data, start, end))]


def terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of every term occurrence of the texts that ``offsets`` cuts out."""
    data, offsets = data[offsets[0]:offsets[-1]], offsets - offsets[0]
    w: Words = words(data, offsets)
    row = w.row
    form_row, form = _forms(data, offsets)
    shingle, at = w.shingles(3)
    same = row[1:][(w.hash[1:] == w.hash[:-1]) & (row[1:] == row[:-1])]
    windows = row[at][_again(row[at], shingle)]
    lines = _lines(data, offsets)
    marks = [(r, np.full(len(r), k)) for r, k in ((same, _SAME), (windows, _WINDOW), (lines, _LINE))]
    f_row = np.concatenate([form_row, *(r for r, _ in marks)])
    f_hash = np.concatenate([form, *(h for _, h in marks)])
    bucket = np.r_[w.hash % np.uint64(WORD_DIMS), np.uint64(WORD_DIMS) + mix(f_hash) % np.uint64(FORM_DIMS)]
    return np.r_[row, f_row], bucket.astype(np.int64)


def batch_terms(column: pa.Array):
    """(first row, end row, row, bucket) of a text column in chunks of bounded size."""
    data, offsets = utf8(column)
    for lo, hi in chunks(offsets, _CHUNK):
        for a in range(lo, hi, _ROWS):
            z = min(a + _ROWS, hi)
            yield a, z, *terms(data, offsets[a:z + 1])


def vectors(row: np.ndarray, bucket: np.ndarray, n: int, idf: np.ndarray) -> np.ndarray:
    """n TF-IDF vectors with fields of unit length (zeros where a field has no term)."""
    tf = np.bincount(row * DIMS + bucket, minlength=n * DIMS)
    at = np.flatnonzero(tf)
    v = np.zeros(n * DIMS, np.float32)
    v[at] = np.log1p(tf[at]) * idf[at % DIMS]
    v = v.reshape(n, DIMS)
    for part in (v[:, :WORD_DIMS], v[:, WORD_DIMS:]):
        norm = np.sqrt((part * part).sum(axis=1, keepdims=True))
        part /= np.where(norm > 0, norm, 1)
    return v


def unit(v: np.ndarray) -> np.ndarray:
    norm = np.sqrt((v * v).sum(axis=1, keepdims=True))
    return v / np.where(norm > 0, norm, 1)


@dataclass
class Model:
    """The latent space and the labelled vectors in it."""

    idf: np.ndarray        # DIMS
    space: np.ndarray      # DIMS x RANK
    examples: np.ndarray   # examples x RANK, unit length
    label: np.ndarray
    vote: np.ndarray       # labelled rows that the example stands for, mean 1
    ids: list[str]
    base: float

    def latent(self, row: np.ndarray, bucket: np.ndarray, n: int) -> np.ndarray:
        return unit(vectors(row, bucket, n, self.idf) @ self.space)

    def nearest(self, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(queries x examples cosines, each query's k-th best cosine), block by block of examples."""
        out = np.empty((len(q), len(self.examples)), np.float32)
        best = np.full((len(q), min(k, len(self.examples))), -2, np.float32)
        for lo in range(0, len(self.examples), BLOCK):
            block = q @ self.examples[lo:lo + BLOCK].T
            out[:, lo:lo + BLOCK] = block
            both = np.concatenate([best, block], axis=1)
            best = np.partition(both, both.shape[1] - best.shape[1], axis=1)[:, -best.shape[1]:]
        return out, best.min(axis=1)

    def votes(self, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(score, neighbours, best cosine, place of the nearest example or -1) of query vectors."""
        n = len(q)
        score, near, best, first = np.full(n, self.base), np.zeros(n, np.int32), np.zeros(n), np.full(n, -1)
        some = np.flatnonzero(q.any(axis=1))
        if len(some) and len(self.examples):
            cos, kth = self.nearest(q[some], k)
            counted = np.where((cos >= kth[:, None] - 1e-6) & (cos > 0), cos, 0).astype(np.float64)
            weight = counted ** 2 * self.vote
            score[some] = (weight @ self.label + self.base) / (weight.sum(axis=1) + 1)
            near[some], best[some], first[some] = (counted > 0).sum(axis=1), cos.max(axis=1), cos.argmax(axis=1)
        return score, near, best, first


def labelled(docs: DataFrame, labels: DataFrame, *, id_col: str, text_col: str, label_col: str,
             examples: int) -> tuple[DataFrame, dict[int, int]]:
    """At most ``examples`` labelled texts (id, text, y), half of each label, and how many
    ids have each label (a mean label of one half or more counts as 1)."""
    one = (labels.where(F.col(label_col).isin(0, 1) & ~held_out(id_col))
           .groupBy(F.col(id_col).alias("id")).agg(F.avg(F.col(label_col).cast("double")).alias("y"))
           .withColumn("side", (F.col("y") >= 0.5).cast("int")))
    count = {r["side"]: r["count"] for r in one.groupBy("side").count().collect()}
    order = [F.xxhash64(F.col("id").cast("string"), F.lit("quality")), F.col("id")]
    chosen = [one.where(F.col("side") == s).orderBy(*order).limit(examples // 2) for s in (0, 1)]
    texts = (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
             .join(F.broadcast(chosen[0].unionByName(chosen[1])), "id")  # ``examples`` rows at most, by the limits
             .groupBy("id").agg(F.max("text").alias("text"), F.first("y").alias("y"), F.first("side").alias("side")))
    return texts, count


def document_frequency(texts: DataFrame) -> tuple[np.ndarray, int]:
    """(in how many texts each bucket occurs, number of texts), over all rows."""
    def run(batches):
        total, rows = np.zeros(DIMS, np.int64), 0
        for b in batches:
            for lo, hi, row, bucket in batch_terms(b.column(0)):
                seen = np.zeros((hi - lo) * DIMS, dtype=bool)
                seen[row * DIMS + bucket] = True
                total += seen.reshape(hi - lo, DIMS).sum(axis=0)
                rows += hi - lo
        yield pa.record_batch([pa.array(np.arange(-1, DIMS)), pa.array(np.r_[rows, total])], names=["bucket", "n"])

    found = texts.mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    df = np.zeros(DIMS + 1, np.int64)
    df[found["bucket"].to_numpy() + 1] = found["n"].to_numpy()
    return df[1:], int(df[0])


def latent_space(sample: DataFrame, idf: np.ndarray, rank: int = RANK, passes: int = 5) -> np.ndarray:
    """The leading right singular vectors of the sample's TF-IDF matrix X (columns of the
    result): subspace iteration on X'X, whose partial products the tasks sum up."""
    sc = sample.sparkSession.sparkContext
    base = np.random.default_rng(7).standard_normal((DIMS, rank + 8)).astype(np.float32)
    base = np.linalg.qr(base)[0]
    for _ in range(passes):
        shared = sc.broadcast((idf, base))

        def run(batches, shared=shared):
            idf_, q = shared.value
            total = np.zeros(q.shape, np.float32)
            for b in batches:
                for lo, hi, row, bucket in batch_terms(b.column(0)):
                    v = vectors(row, bucket, hi - lo, idf_)
                    total += v.T @ (v @ q)
            yield pa.record_batch([pa.array([total.astype("<f4").tobytes()], pa.binary())], names=["m"])

        parts = sample.select("text").mapInArrow(run, "m binary").toArrow()["m"].to_pylist()  # one a task, _PARTS at most
        total = sum(np.frombuffer(m, "<f4").reshape(base.shape).astype(np.float64) for m in parts)
        u, s, _ = np.linalg.svd(total, full_matrices=False)
        base = u.astype(np.float32)
        shared.destroy()
    return np.ascontiguousarray(base[:, :rank][:, s[:rank] > 1e-9])


def fit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality", examples: int = EXAMPLES, rank: int = RANK) -> Model | None:
    """The model of the labelled rows that aren't held out; None without any."""
    spark = docs.sparkSession
    texts, count = labelled(docs, labels, id_col=id_col, text_col=text_col, label_col=label_col, examples=examples)
    path = scratch_path(spark, "quality-examples")
    texts.coalesce(_PARTS).write.parquet(path)
    sample = spark.read.parquet(path).coalesce(_PARTS)
    taken = {r["side"]: r["count"] for r in sample.groupBy("side").count().collect()}
    if not taken:
        drop_scratch(spark, path)
        return None
    df, total = document_frequency(docs.select(text_col))
    idf = (np.log((1 + total) / (1 + df)) + 1).astype(np.float32)
    space = latent_space(sample, idf, rank)
    shared = spark.sparkContext.broadcast((idf, space))

    def run(batches):
        idf_, space_ = shared.value
        for b in batches:
            for lo, hi, row, bucket in batch_terms(b.column(0)):
                v = unit(vectors(row, bucket, hi - lo, idf_) @ space_)
                yield pa.record_batch([b.column(k).slice(lo, hi - lo) for k in (1, 2, 3)]
                                      + [pa.array(list(v), pa.list_(pa.float32()))], names=["id", "y", "side", "v"])

    rows = (sample.select("text", F.col("id").cast("string").alias("id"), "y", "side")
            .mapInArrow(run, "id string, y double, side int, v array<float>").toArrow())  # ``examples`` rows
    v = np.array(rows["v"].to_pylist(), np.float32).reshape(rows.num_rows, space.shape[1])
    y, side = rows["y"].to_numpy(), rows["side"].to_numpy()
    vote = np.array([count[s] / taken[s] for s in side.tolist()])
    drop_scratch(spark, path)
    return Model(idf, space, v, y, vote / vote.mean(), rows["id"].to_pylist(), float((vote * y).sum() / vote.sum()))


def score(docs: DataFrame, model: Model | None, *, id_col: str = "doc_id", text_col: str = "text",
          k: int = NEIGHBOURS) -> DataFrame:
    """(id, score, neighbours, best_cosine, nearest_id, nearest_label) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("score", T.DoubleType()),
                           T.StructField("neighbours", T.IntegerType()), T.StructField("best_cosine", T.DoubleType()),
                           T.StructField("nearest_id", T.StringType()), T.StructField("nearest_label", T.DoubleType())])

    def run(batches):
        m: Model | None = shared.value
        for b in batches:
            if m is None:
                n = b.num_rows
                yield pa.record_batch([b.column(0), pa.array(np.zeros(n)), pa.array(np.zeros(n, np.int32)),
                                       pa.array(np.zeros(n)), pa.nulls(n, pa.string()), pa.nulls(n, pa.float64())],
                                      names=schema.fieldNames())
                continue
            for lo, hi, row, bucket in batch_terms(b.column(1)):
                s, near, best, first = m.votes(m.latent(row, bucket, hi - lo), k)
                yield pa.record_batch([b.column(0).slice(lo, hi - lo), pa.array(s), pa.array(near), pa.array(best),
                                       pa.array([m.ids[i] if i >= 0 else None for i in first], pa.string()),
                                       pa.array([float(m.label[i]) if i >= 0 else None for i in first], pa.float64())],
                                      names=schema.fieldNames())

    return docs.select(F.col(id_col), F.col(text_col).alias("__text")).mapInArrow(run, schema)


def quality_votes(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                  label_col: str = "quality", examples: int = EXAMPLES, k: int = NEIGHBOURS) -> DataFrame:
    """Learn from the labelled rows that aren't held out and score every document."""
    model = fit(docs, labels, id_col=id_col, text_col=text_col, label_col=label_col, examples=examples)
    return score(docs, model, id_col=id_col, text_col=text_col, k=k)
