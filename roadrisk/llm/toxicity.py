"""Toxicity by the nearest labelled examples: exact TF-IDF cosine over block-max postings.

Features are a text's words and the six-byte beginnings of its longer words. Labelled
texts, at most about ``examples`` of them, choose the features that lean to one label;
document frequencies for the weights are counted over all documents. The examples are
laid out in blocks with postings for the terms that occur in a block and each term's
largest weight in it. A query's dot product with a block's maxima bounds its cosine with
every example there, so a block is scored only while it could still reach the query's
``k`` best: the neighbours are exact. Neighbours at the k-th cosine all count (ties need
no order). Votes are weighted by the squared cosine, and one vote's worth of the label's
rate among examples without any feature calibrates weak evidence.

Defined cases: a null, empty or feature-less text scores that base rate; without labelled
rows every score is 0; null labels and labels of unknown ids are ignored; an id labelled
twice counts twice; repeated documents each give their row; empty tables give no rows;
other columns are ignored. Labels, language, source and id are never inputs of a score.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadrisk.llm.langid import held_out, lowered
from roadrisk.llm.text import Words, chunks, mix, utf8, words
from roadrisk.session import materialise

EXAMPLES = 6000
FEATURES = 512
NEIGHBOURS = 25
BLOCK = 64
_PREFIX = 6
_CHUNK = 2 << 20


def features(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """(row, 64-bit feature) of every word, and of the beginning of every longer word."""
    row = w.row
    if not len(row):
        return row, w.hash
    padded = np.zeros(len(w.low) + 8, np.uint8)
    padded[:len(w.low)] = w.low
    at = np.ndarray((len(w.low) + 1,), dtype="<u8", buffer=padded.data, strides=(1,))
    longer = w.end - w.start > _PREFIX
    with np.errstate(over="ignore"):
        start = mix((at[w.start[longer]] & np.uint64((1 << 8 * _PREFIX) - 1)) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1))
    return np.r_[row, row[longer]], np.r_[w.hash, start]


def batch_features(column: pa.Array):
    data, offsets = utf8(lowered(column))
    for lo, hi in chunks(offsets, _CHUNK):
        yield lo, hi, *features(words(data, offsets[lo:hi + 1]))


@dataclass
class Index:
    """Examples in blocks: postings (a block's terms and their weights), block maxima."""

    vocabulary: np.ndarray                 # sorted 64-bit features
    idf: np.ndarray
    base: float                            # label rate of examples without features
    terms: list[np.ndarray] = field(default_factory=list)     # a block's terms
    weights: list[np.ndarray] = field(default_factory=list)   # terms x examples of the block
    labels: list[np.ndarray] = field(default_factory=list)
    votes: list[np.ndarray] = field(default_factory=list)     # each example's sampling weight
    maxima: np.ndarray | None = None       # features x blocks

    def vectors(self, row: np.ndarray, feature: np.ndarray, n: int) -> np.ndarray:
        """n unit TF-IDF vectors (rows of zeros without features)."""
        at = np.minimum(np.searchsorted(self.vocabulary, feature), len(self.vocabulary) - 1)
        mine = self.vocabulary[at] == feature
        tf = np.bincount(row[mine] * len(self.vocabulary) + at[mine], minlength=n * len(self.vocabulary))
        v = np.log1p(tf.reshape(n, -1)) * self.idf
        norm = np.sqrt((v * v).sum(axis=1, keepdims=True))
        return (v / np.where(norm > 0, norm, 1)).astype(np.float32)

    def add(self, vectors: np.ndarray, labels: np.ndarray, votes: np.ndarray) -> None:
        """Lay out the examples that have features, alike ones together (by largest term)."""
        some = vectors.any(axis=1)
        vectors, labels, votes = vectors[some], labels[some], votes[some]
        order = np.lexsort((vectors.max(axis=1), vectors.argmax(axis=1)))
        for lo in range(0, len(order), BLOCK):
            v = vectors[order[lo:lo + BLOCK]]
            terms = np.flatnonzero(v.any(axis=0))
            self.terms.append(terms)
            self.weights.append(np.ascontiguousarray(v[:, terms].T))
            self.labels.append(labels[order[lo:lo + BLOCK]])
            self.votes.append(votes[order[lo:lo + BLOCK]])
        self.maxima = np.zeros((vectors.shape[1], len(self.terms)), np.float32)
        for b, (t, w) in enumerate(zip(self.terms, self.weights)):
            self.maxima[t, b] = w.max(axis=1)

    def cosines(self, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(queries x examples cosines, 0 in skipped blocks; each query's k-th best cosine)."""
        n, at = len(q), np.r_[0, np.cumsum([len(x) for x in self.labels])]
        bound = q @ self.maxima
        out, kth = np.zeros((n, at[-1]), np.float32), np.zeros(n, np.float32)
        first = bound.argmax(axis=1)  # the most promising block of each query sets its bar
        k = min(k, at[-1])
        done = np.zeros((n, len(self.terms)), dtype=bool)
        for turn in range(2):
            for b in range(len(self.terms)):
                need = first == b if turn == 0 else ~done[:, b] & (bound[:, b] > 0) & (bound[:, b] >= kth - 1e-6)
                who = np.flatnonzero(need)
                if len(who):
                    out[who, at[b]:at[b + 1]] = q[np.ix_(who, self.terms[b])] @ self.weights[b]
                    done[who, b] = True
                    if turn == 0 and at[b + 1] - at[b] >= k:
                        got = out[who, at[b]:at[b + 1]]
                        kth[who] = np.partition(got, got.shape[1] - k, axis=1)[:, got.shape[1] - k]
        kth = np.partition(out, out.shape[1] - k, axis=1)[:, out.shape[1] - k]
        return out, kth

    def score(self, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(score, number of neighbours, best cosine) of each query vector."""
        score, near, best = np.full(len(q), self.base), np.zeros(len(q), np.int32), np.zeros(len(q))
        some = np.flatnonzero(q.any(axis=1))
        if len(some) and self.terms:
            y, v = np.concatenate(self.labels), np.concatenate(self.votes)
            for lo in range(0, len(some), 512):
                who = some[lo:lo + 512]
                cos, kth = self.cosines(q[who], k)
                counted = np.where((cos > 0) & (cos >= kth[:, None] - 1e-6), cos, 0).astype(np.float64)
                vote = counted ** 2 * v
                score[who] = (vote @ y + self.base) / (vote.sum(axis=1) + 1)
                near[who], best[who] = (counted > 0).sum(axis=1), cos.max(axis=1)
        return score, near, best


def _labelled(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, examples: int) -> tuple[DataFrame, dict]:
    """A hash-chosen sample of the labelled training rows, half of each label where there
    are enough, with the number of rows of each label."""
    lab = labels.where(F.col(label_col).isin(0, 1) & ~held_out(id_col)).select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y"))
    n = {r["y"]: r["count"] for r in lab.groupBy("y").count().collect()}
    share = F.coalesce(*(F.when(F.col("y") == y, F.lit(min(1.0, examples / 2 / n[y]))) for y in n)) if n else F.lit(0.0)
    chosen = lab.where(F.pmod(F.xxhash64(F.col("id").cast("string"), F.lit("toxicity")), F.lit(1 << 20)) < share * (1 << 20))
    # the chosen ids are bounded by ``examples``, so their side may be broadcast
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "id")
    return materialise(texts, "toxicity-examples"), n


def fit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        examples: int = EXAMPLES, n_features: int = FEATURES) -> Index | None:
    """The index of the labelled training rows; None without any."""
    sample, n = _labelled(docs, labels, id_col, text_col, label_col, examples)
    taken = {r["y"]: r["count"] for r in sample.groupBy("y").count().collect()}
    if not taken:
        return None

    def presence(batches):
        for b in batches:
            y = b.column(1).to_numpy(zero_copy_only=False)
            for lo, hi, row, f in batch_features(b.column(0)):
                pair = np.unique(np.stack([row.astype(np.uint64), f]), axis=1)
                yield pa.record_batch([pa.array(pair[1].view(np.int64)), pa.array(y[lo:hi][pair[0].astype(np.int64)], pa.int32())],
                                      names=["f", "y"])

    rate = {y: F.count_if(F.col("y") == y) / F.lit(float(max(1, taken.get(y, 0)))) for y in (0, 1)}
    # how strongly presence leans to one label: difference of rates over its standard error
    lean = (F.col("p1") - F.col("p0")) / F.sqrt(F.col("p1") * (1 - F.col("p1")) / max(1, taken.get(1, 0))
                                                + F.col("p0") * (1 - F.col("p0")) / max(1, taken.get(0, 0)) + F.lit(1e-6))
    chosen = (sample.select("text", "y").mapInArrow(presence, "f long, y int").groupBy("f")
              .agg(rate[1].alias("p1"), rate[0].alias("p0"), F.count(F.lit(1)).alias("n")).where("n >= 5")
              .withColumn("lean", F.abs(lean)).where("lean >= 4").orderBy(F.desc("lean"), "f").limit(n_features))
    vocabulary = np.sort(np.array([r["f"] for r in chosen.collect()], np.int64).view(np.uint64))
    if not len(vocabulary):
        vocabulary = np.zeros(1, np.uint64)
    seen = _document_frequency(docs.select(text_col), vocabulary)
    total = max(1, seen.pop("rows"))
    df = np.array([seen.get(int(f), 0) for f in vocabulary.view(np.int64)])
    index = Index(vocabulary, np.log((1 + total) / (1 + df)) + 1.0, 0.0)

    shared = sample.sparkSession.sparkContext.broadcast(index)

    def vectors(batches):
        for b in batches:
            y = b.column(1)
            for lo, hi, row, f in batch_features(b.column(0)):
                yield pa.record_batch([pa.array(list(shared.value.vectors(row, f, hi - lo)), pa.list_(pa.float32())),
                                       y.slice(lo, hi - lo)], names=["v", "y"])

    rows = sample.select("text", "y").mapInArrow(vectors, "v array<float>, y int").toArrow()  # ``examples`` rows
    v = np.array(rows["v"].to_pylist(), np.float32).reshape(-1, len(vocabulary))
    y = rows["y"].to_numpy().astype(np.float64)
    vote = np.array([n[int(k)] / taken[int(k)] for k in y])
    vote /= vote.mean()
    empty = ~v.any(axis=1)
    index.base = float((vote * y)[empty].sum() / vote[empty].sum()) if empty.any() else float((vote * y).sum() / vote.sum())
    index.add(v, y, vote)
    return index


def _document_frequency(texts: DataFrame, vocabulary: np.ndarray) -> dict:
    """In how many documents each feature of the vocabulary occurs; ``rows``: documents."""
    shared = texts.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches):
        total, rows = np.zeros(len(shared.value), np.int64), 0
        for b in batches:
            for lo, hi, row, f in batch_features(b.column(0)):
                at = np.minimum(np.searchsorted(shared.value, f), len(shared.value) - 1)
                mine = shared.value[at] == f
                pair = np.unique(row[mine] * len(shared.value) + at[mine])
                total += np.bincount(pair % len(shared.value), minlength=len(shared.value))
                rows += hi - lo
        yield pa.record_batch([pa.array(np.r_[shared.value.view(np.int64), 0]), pa.array(np.r_[total, rows]),
                               pa.array(np.r_[np.zeros(len(total), bool), True])], names=["f", "n", "rows"])

    found = texts.mapInArrow(run, "f long, n long, rows boolean").groupBy("f", "rows").agg(F.sum("n").alias("n")).collect()
    return {("rows" if r["rows"] else r["f"]): r["n"] for r in found} | ({} if found else {"rows": 0})


def score(docs: DataFrame, index: Index | None, *, id_col: str = "doc_id", text_col: str = "text",
          k: int = NEIGHBOURS) -> DataFrame:
    """(id, score, neighbours, best_cosine) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(index)
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("score", T.DoubleType()),
                           T.StructField("neighbours", T.IntegerType()), T.StructField("best_cosine", T.DoubleType())])

    def run(batches):
        for b in batches:
            if shared.value is None:
                n = b.num_rows
                yield pa.record_batch([b.column(0), pa.array(np.zeros(n)), pa.array(np.zeros(n, np.int32)), pa.array(np.zeros(n))],
                                      names=schema.fieldNames())
                continue
            for lo, hi, row, f in batch_features(b.column(1)):
                s, near, best = shared.value.score(shared.value.vectors(row, f, hi - lo), k)
                yield pa.record_batch([b.column(0).slice(lo, hi - lo), pa.array(s), pa.array(near), pa.array(best)],
                                      names=schema.fieldNames())

    return docs.select(F.col(id_col), F.col(text_col).alias("__text")).mapInArrow(run, schema)


def toxicity(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
             label_col: str = "toxic", examples: int = EXAMPLES, k: int = NEIGHBOURS) -> DataFrame:
    """Learn from the labelled rows that aren't held out and score every document."""
    index = fit(docs, labels, id_col=id_col, text_col=text_col, label_col=label_col, examples=examples)
    return score(docs, index, id_col=id_col, text_col=text_col, k=k)
