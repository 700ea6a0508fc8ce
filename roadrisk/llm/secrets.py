"""Secret scan: patterns propose candidates, a random forest removes false positives.

A candidate is a value assigned to a credential's name, or a run of 20 or more token
characters. Its features: length, character shares and entropy, how likely its character
transitions are in the corpus, how much of it frequent corpus words cover, whether a
credential's name, an assignment or quotes stand by, how many of the neighbouring words
are dictionary words, and hints of tests or examples in the document's path. The forest
learns from labelled findings (documents and places with a 0/1 label) and scores every
candidate. Transitions and words are counted over all documents; the dictionary holds at
most ``dictionary`` words and training at most about ``findings`` rows of each label.
Results name places and a keyed digest of each value, never the value.

Defined cases: a null or empty text has no candidates; without labelled findings, or with
one label only, every candidate scores that label's value (0.5 without any); equal values
have equal digests; repeated rows each give theirs; an empty table gives no rows; other
columns are ignored, and a null path has no hints.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadrisk.llm.text import batch_words
from roadrisk.session import materialise

DICTIONARY = 20_000
FINDINGS = 20_000
FEATURES = ("length", "digits", "upper", "hex", "marks", "entropy", "transitions", "covered", "longest_word", "named",
            "assigned", "quoted", "near_words", "path_hint")
_NAME = r"(?:api[_-]?key|access[_-]?key|secret[_-]?key|private[_-]?key|client[_-]?secret|auth[_-]?token|token|secret|password|passwd|pwd|bearer)"
_CANDIDATE = re.compile(rf"(?i:\b{_NAME}\b)[\"']?\s*(?:[:=]|=>)\s*[\"']?(?P<value>[^\s\"',;]{{8,}})|(?<![\w+/=-])(?P<run>[\w+/=-]{{20,}})(?![\w+/=-])")
_MAYBE = r"(?i)(api[_-]?key|access[_-]?key|token|secret|private[_-]?key|password|passwd|pwd|bearer)|[\pL\pN_+/=-]{20,}"
_HINT = re.compile(r"(?i)test|example|sample|mock|fixture|doc")
_SYMBOLS = 38  # other, a-z, digit, end of word

_SYMBOL = np.zeros(256, np.int64)
_SYMBOL[97:123] = np.arange(1, 27)
_SYMBOL[48:58] = 27


def corpus_statistics(docs: DataFrame, text_col: str, dictionary: int) -> tuple[np.ndarray, set[str]]:
    """(log-probabilities of character transitions, frequent words) over all documents."""
    def run(batches):
        table = np.zeros(_SYMBOLS * _SYMBOLS, np.int64)
        for b in batches:
            for _, _, w in batch_words(b.column(0)):
                if not len(w.hash):
                    continue
                s = _SYMBOL[w.low]
                inner = np.ones(len(s), bool)
                inner[w.start] = False  # a word's first byte follows nothing
                at = np.flatnonzero(inner & (s > 0))
                table += np.bincount(s[at - 1] * _SYMBOLS + s[at], minlength=len(table))
                _, first, n = np.unique(w.hash, return_index=True, return_counts=True)
                fits = np.flatnonzero((w.end[first] - w.start[first] >= 2) & (w.end[first] - w.start[first] <= 24))
                yield pa.record_batch([pa.array([w.low[w.start[i]:w.end[i]].tobytes().decode("utf8", "replace") for i in first[fits]], pa.string()),
                                       pa.array(n[fits].astype(np.int64))], names=["k", "n"])
        cells = np.flatnonzero(table)
        yield pa.record_batch([pa.array([f"\t{c}" for c in cells], pa.string()), pa.array(table[cells])], names=["k", "n"])

    found = docs.select(text_col).mapInArrow(run, "k string, n long").groupBy("k").agg(F.sum("n").alias("n"))
    found = materialise(found, "secret-statistics")
    table = np.full(_SYMBOLS * _SYMBOLS, 0.5)
    for r in found.where(F.col("k").startswith("\t")).collect():  # a cell each
        table[int(r["k"][1:])] += r["n"]
    table = table.reshape(_SYMBOLS, _SYMBOLS)
    words = found.where(~F.col("k").startswith("\t")).orderBy(F.desc("n"), "k").limit(dictionary).collect()
    return np.log(table / table.sum(axis=1, keepdims=True)), {r["k"] for r in words}


def _features(text: str, m: re.Match, transitions: np.ndarray, words: set[str], path: str) -> list[float]:
    value = m["value"] or m["run"]
    start, end = m.span("value" if m["value"] else "run")
    n, low = len(value), value.lower()
    counts = Counter(value)
    entropy = -sum(c / n * math.log2(c / n) for c in counts.values())
    s = _SYMBOL[np.frombuffer(low.encode(), np.uint8)]
    likely = float(transitions[s[:-1], s[1:]].mean()) if len(s) > 1 else 0.0
    covered = longest = at = 0
    while at < n:  # the longest dictionary word at each place
        k = next((k for k in range(min(24, n - at), 2, -1) if low[at:at + k] in words), 0)
        covered, longest, at = covered + k, max(longest, k), at + (k or 1)
    before, after = text[max(0, start - 60):start], text[end:end + 40]
    near = re.findall(r"\w+", before.lower())[-4:] + re.findall(r"\w+", after.lower())[:4]
    return [n, sum(c.isdigit() for c in value) / n, sum(c.isupper() for c in value) / n,
            sum(c in "0123456789abcdef" for c in low) / n, sum(not c.isalnum() for c in value) / n, entropy, likely,
            covered / n, longest, float(bool(re.search(_NAME, before[-30:], re.I))),
            float(bool(re.search(r"[:=]\s*[\"']?$", before))), float(before[-1:] in "\"'" and after[:1] in "\"'" and before[-1:] != ""),
            sum(x in words for x in near) / max(1, len(near)), float(bool(_HINT.search(path)))]


def candidates(docs: DataFrame, key: bytes, *, id_col: str, text_col: str, path_col: str | None,
               transitions: np.ndarray, words: set[str]) -> DataFrame:
    """(id, start, end, digest, features) of every candidate."""
    shared = docs.sparkSession.sparkContext.broadcast((transitions, words))
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("start", T.IntegerType()),
                           T.StructField("end", T.IntegerType()), T.StructField("digest", T.StringType()),
                           T.StructField("features", T.ArrayType(T.DoubleType()))])

    def run(batches):
        table, known = shared.value
        for b in batches:
            src, out = [], [[], [], [], []]
            maybe = pc.fill_null(pc.match_substring_regex(b.column(1), _MAYBE), False).to_pylist()
            for i in [i for i, x in enumerate(maybe) if x]:
                text, path = b.column(1)[i].as_py(), b.column(2)[i].as_py() or ""
                for m in _CANDIDATE.finditer(text):
                    span = m.span("value" if m["value"] else "run")
                    src.append(i)
                    digest = hashlib.blake2b(text[span[0]:span[1]].encode(), key=key, digest_size=16).hexdigest()
                    for c, v in zip(out, (*span, digest, _features(text, m, table, known, path))):
                        c.append(v)
            yield pa.record_batch([b.column(0).take(pa.array(src, pa.int64())), pa.array(out[0], pa.int32()), pa.array(out[1], pa.int32()),
                                   pa.array(out[2], pa.string()), pa.array(out[3], pa.list_(pa.float64()))], names=schema.fieldNames())

    path = F.col(path_col) if path_col else F.lit(None)
    return docs.select(F.col(id_col), F.col(text_col).alias("__text"), path.cast("string").alias("__path")).mapInArrow(run, schema)


def scan(docs: DataFrame, findings, *, key: bytes, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = None,
         dictionary: int = DICTIONARY, max_findings: int = FINDINGS, trees: int = 40, depth: int = 6, seed: int = 3) -> DataFrame:
    """(id, start, end, digest, score, is_secret) of every candidate.

    ``findings``: labelled findings as a table (id, start, end, label), or a function that
    makes one from the table of candidates with their features.
    """
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.functions import array_to_vector, vector_to_array

    transitions, words = corpus_statistics(docs, text_col, dictionary)
    found = materialise(candidates(docs, key, id_col=id_col, text_col=text_col, path_col=path_col,
                                   transitions=transitions, words=words), "secret-candidates")
    labelled = findings(found) if callable(findings) else findings
    labelled = found.join(labelled.select(id_col, "start", "end", F.col("label").cast("double").alias("label")).distinct(),
                          [id_col, "start", "end"]).where(F.col("label").isin(0.0, 1.0))
    n = {r["label"]: r["count"] for r in labelled.groupBy("label").count().collect()}
    if len(n) < 2:
        scored = found.withColumn("score", F.lit(float(next(iter(n), 0.5))))
    else:
        share = F.coalesce(*(F.when(F.col("label") == y, F.lit(min(1.0, max_findings / k))) for y, k in n.items()))
        chosen = labelled.where(F.pmod(F.xxhash64("digest", "start"), F.lit(1 << 20)) < share * (1 << 20))
        train = materialise(chosen.select("features", "label"), "secret-findings")
        weight = F.when(F.col("label") == 1.0, F.lit(1.0 / n[1.0])).otherwise(F.lit(1.0 / n[0.0]))
        forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, weightCol="weight", featuresCol="vector")
        model = forest.fit(train.select(array_to_vector("features").alias("vector"), "label", weight.alias("weight")))
        scored = (model.transform(found.withColumn("vector", array_to_vector("features")))
                  .withColumn("score", vector_to_array("probability")[1]))
    return scored.select(id_col, "start", "end", "digest", "score", (F.col("score") >= 0.5).alias("is_secret"))


def certain_findings(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Labelled findings where rules alone are sure: a mixed value of 16 or more characters
    assigned to a credential's name is a secret; a run without digits or marks that no such
    name introduces isn't. All other candidates stay unlabelled."""
    f = {name: F.col("features")[i] for i, name in enumerate(FEATURES)}
    label = (F.when((f["named"] == 1) & (f["assigned"] == 1) & (f["length"] >= 16) & (f["digits"] >= 0.15) & (f["entropy"] >= 3.0), 1.0)
             .when((f["named"] == 0) & (f["digits"] == 0) & (f["marks"] == 0), 0.0))
    return found.withColumn("label", label).where(F.col("label").isNotNull()).select(id_col, "start", "end", "label")
