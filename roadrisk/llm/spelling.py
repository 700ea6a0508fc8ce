"""Spelling variants: frequent words one edit apart, grouped by following the commoner form.

Words of all texts are counted in Spark (tasks send partial counts). A word's letter multiset
is a binary vector with one place for each (letter, how-manieth of its kind); one inserted,
deleted or replaced letter changes at most two places. PartEnum signatures find such pairs
exactly: the places are dealt to ``PARTS`` parts, of which at least one holds at most
``2 // PARTS`` differences, and each part to ``SUBPARTS`` smaller ones; a signature is a part
without one of its smaller parts, so two vectors within distance two share a signature.
One edit also leaves the first or the second half of the shorter word's length alone, so
each signature is joined with either half: anagrams and common endings do not gather in one
bucket. Words that share such a key are equi-joined and verified by their edit distance.

A word's form is its near word with the most occurrences (ties: the smallest in code-point
order) if it has at least twice the word's own; roots follow the forms by pointer jumping,
which halves the way left each round (forms at least double, so there are no circles).

Defined cases: null and empty texts have no words; a null id counts as an empty one where
the id matters; repeated rows count again; an empty table, or one without a frequent word,
gives no rows; very long runs are words like others; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadrisk.llm.text import mix
from roadrisk.session import drop_scratch, materialise, scratch_path

MIN_LENGTH = 5
MIN_COUNT = 3
#: The two levels of the signatures; a part can lack one of its smaller parts.
PARTS, SUBPARTS = 2, 3
_HELD = 200_000  # words that a task holds before it sends their counts
_SEND = 50_000


def _slipped(run: bytes, seed: int, slip: int) -> bytes:
    """The run (Latin-1) without one letter if its checksum is a multiple of ``slip``."""
    h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), seed)
    if h % slip:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def word_counts(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH,
                slip: int | None = None) -> DataFrame:
    """(word, n): all maximal runs of Latin letters (A-Z lower-cased) of ``min_length`` or
    more code points, with their occurrences over all texts. With ``slip``, the crc32 of
    ``<id>:<run>`` decides which runs of a document lose one letter first."""
    pattern = re.compile(b"[a-z\xc0-\xff]{%d,}" % min_length)

    def run(batches):
        held: dict[bytes, int] = {}

        def sent():
            names = list(held)
            for lo in range(0, len(names), _SEND):
                part = names[lo:lo + _SEND]
                yield pa.record_batch([pa.array([w.decode("latin-1") for w in part], pa.string()),
                                       pa.array([held[w] for w in part], pa.int64())], names=["word", "n"])
            held.clear()

        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1)):
                # other characters become '?', which is no letter; bytes.lower() takes A-Z only
                found = Counter(pattern.findall((text.as_py() or "").encode("latin-1", "replace").lower()))
                seed = zlib.crc32(f"{doc_id or ''}:".encode())
                for word, n in found.items():
                    if slip:
                        word = _slipped(word, seed, slip)
                        if len(word) < min_length:
                            continue
                    held[word] = held.get(word, 0) + n
                if len(held) >= _HELD:
                    yield from sent()
        yield from sent()

    cols = docs.select(F.col(id_col).cast("string"), F.col(text_col))
    return cols.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def signatures(words: list[str], parts: int = PARTS, subparts: int = SUBPARTS) -> np.ndarray:
    """words x (parts * subparts) 64-bit signatures of the words' letter multisets."""
    letter = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.uint64)
    row = np.repeat(np.arange(len(words)), [len(w) for w in words])
    order = np.lexsort((letter, row))
    letter, row = letter[order], row[order]
    n = len(letter)
    first = np.ones(n, dtype=bool)
    first[1:] = (letter[1:] != letter[:-1]) | (row[1:] != row[:-1])
    nth = np.arange(n) - np.maximum.accumulate(np.where(first, np.arange(n), 0))
    with np.errstate(over="ignore"):
        place = mix(letter * np.uint64(0x100000001B3) + nth.astype(np.uint64))
        cell = (place % np.uint64(parts * subparts)).astype(np.int64)
        sums = np.zeros((len(words), parts * subparts), np.uint64)
        np.add.at(sums, (row, cell), mix(place + np.uint64(1)))
        out = np.empty_like(sums)
        for p in range(parts):
            whole = sums[:, p * subparts:(p + 1) * subparts]
            for s in range(subparts):
                k = p * subparts + s
                out[:, k] = mix((whole.sum(axis=1, dtype=np.uint64) - whole[:, s]) ^ mix(np.full(1, k + 1, np.uint64)))
    return out


def signed(vocabulary: DataFrame) -> DataFrame:
    """The vocabulary (word, n) with the signatures of every word."""
    def run(batches):
        for b in batches:
            if b.num_rows:
                sigs = signatures(b.column(0).to_pylist()).view(np.int64)
                lists = pa.FixedSizeListArray.from_arrays(pa.array(sigs.ravel()), sigs.shape[1])
                yield pa.record_batch([b.column(0), b.column(1), lists.cast(pa.list_(pa.int64()))],
                                      names=["word", "n", "sigs"])

    return vocabulary.select("word", "n").mapInArrow(run, "word string, n long, sigs array<long>")


def near_pairs(vocabulary: DataFrame) -> DataFrame:
    """(word, n, near, near_n), both ways, of all words that differ by one edit; the input
    has the signatures of ``signed`` and is read twice."""
    size = F.length("word")
    # half of the shorter word of a pair: this one's, or that of a word shorter by one
    halves = F.array_distinct(F.flatten(F.transform(
        F.array((size / 2).cast("int"), ((size - 1) / 2).cast("int")),
        lambda h: F.array(F.concat(F.lit("<"), F.left(F.col("word"), h)), F.concat(F.lit(">"), F.right(F.col("word"), h))))))
    keyed = (vocabulary.withColumn("sig", F.explode("sigs")).withColumn("half", F.explode(halves))
             .select(F.xxhash64("sig", "half").alias("key"), "word", "n"))
    a, b = keyed.alias("a"), keyed.alias("b")
    found = (a.join(b, (F.col("a.key") == F.col("b.key")) & (F.col("a.word") < F.col("b.word"))
                    & (F.levenshtein(F.col("a.word"), F.col("b.word"), 1) == 1))
             .select(F.col("a.word").alias("w1"), F.col("a.n").alias("n1"), F.col("b.word").alias("w2"),
                     F.col("b.n").alias("n2")).distinct())
    both = F.array(F.struct(F.col("w1").alias("word"), F.col("n1").alias("n"), F.col("w2").alias("near"), F.col("n2").alias("near_n")),
                   F.struct(F.col("w2").alias("word"), F.col("n2").alias("n"), F.col("w1").alias("near"), F.col("n1").alias("near_n")))
    return found.select(F.explode(both).alias("p")).select("p.*")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of every word of (word, form): the last word that its forms lead to."""
    spark = forms.sparkSession
    path, at = None, materialise(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        nxt = (at.alias("p").join(at.alias("q"), F.col("p.root") == F.col("q.word"), "left")
               .select(F.col("p.word").alias("word"), F.coalesce("q.root", "p.root").alias("root"),
                       F.col("q.root").isNotNull().alias("moved")))
        done = path
        path = scratch_path(spark, "spelling-roots")
        nxt.write.parquet(path)
        if done:
            drop_scratch(spark, done)
        nxt = spark.read.parquet(path)
        at = nxt.select("word", "root")
        if nxt.where("moved").isEmpty():
            return at


def spelling_variants(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH,
                      min_count: int = MIN_COUNT, slip: int | None = None) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word with ``min_count`` occurrences."""
    counts = word_counts(docs, id_col=id_col, text_col=text_col, min_length=min_length, slip=slip)
    vocabulary = materialise(signed(counts.where(F.col("n") >= min_count)), "spelling-words")
    # most occurrences first, then the smallest word
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near")))
    near = (near_pairs(vocabulary).groupBy("word", "n").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
            .withColumn("fits", -F.col("best.less") >= 2 * F.col("n"))
            .select("word", "n_near", F.when(F.col("fits"), F.col("best.near")).alias("form"),
                    F.when(F.col("fits"), -F.col("best.less")).alias("form_n")))
    near = materialise(near, "spelling-near")
    ends = roots(near.where("form IS NOT NULL"))
    return (vocabulary.select("word", "n").join(near, "word", "left").join(ends, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n",
                    F.coalesce("n_near", F.lit(0)).alias("n_near"), "form_n"))
