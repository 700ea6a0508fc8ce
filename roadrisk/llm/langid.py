"""Language identification by error-correcting output codes over byte n-grams.

Every language has a codeword of +1/-1 bits. One binary classifier a bit (log-odds of
hashed n-grams of 2 to 4 bytes between the languages on its two sides) gives a margin for
a text: the mean over all its n-grams. Loss-weighted decoding picks the language whose
codeword is nearest, each bit's loss weighted by how well its classifier does on that
language's training texts; a close second choice flags the text as ambiguous.

Training reads at most about ``per_language`` rows of each language, chosen by a hash of
their ids (the whole text of each); all other rows are only predicted. The model is
bounded by languages x bins, whatever the corpus.

Defined cases: a null text, or one without a letter, is ``und`` with score 0 and not
ambiguous; without training rows every text is ``und``; with one language each text with
a letter is that language with score 1; ties between languages go to the first by name;
repeated rows each give their row; null languages aren't learned; an empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

import itertools
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadrisk.llm.text import chunks, mix, releasing, utf8
from roadrisk.session import materialise

SIZES = (2, 3, 4)
BIN_BITS = 14
N_BINS = len(SIZES) << BIN_BITS
PER_LANGUAGE = 1500
UND = "und"

_FOLD = np.arange(256, dtype=np.uint8)  # ASCII that isn't a letter becomes a space
_FOLD[:65] = _FOLD[91:97] = _FOLD[123:128] = 32
_FOLD[65:91] += 32
_CHUNK = 1 << 20


def held_out(id_col: str = "doc_id") -> Column:
    """crc32 of the id's text leaves 2 when divided by 4 (a null id: as the empty text)."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 4 == 2


def ngram_bins(data: np.ndarray, offsets: np.ndarray):
    """For each n-gram size: the bin of the n-gram at each byte (``N_BINS`` where it would
    leave its text)."""
    n = len(data)
    padded = np.zeros(n + 8, np.uint8)
    padded[:n] = _FOLD[data]
    at = np.ndarray((n,), dtype="<u8", buffer=padded.data, strides=(1,))
    ends = offsets[1:]
    with np.errstate(over="ignore"):
        for k, size in enumerate(SIZES):
            gram = at & np.uint64((1 << (8 * size)) - 1)
            bins = (mix(gram) >> np.uint64(64 - BIN_BITS)).astype(np.int32) + np.int32(k << BIN_BITS)
            for back in range(1, size):
                cut = ends - back
                bins[cut[cut >= offsets[:-1]]] = N_BINS
            yield bins


def lowered(column: pa.Array) -> pa.Array:
    return pc.utf8_lower(column.cast(pa.large_string()))


def codewords(n: int, seed: int = 7) -> np.ndarray:
    """n codewords of +1/-1 bits: all two-sided splits of up to 5 languages, else the
    random code with the largest least distance of 50 tries."""
    if n <= 5:
        splits = [s for s in itertools.product((1, -1), repeat=n) if s[0] == 1 and -1 in s]
        return np.array(splits, dtype=np.int8).T.reshape(n, len(splits))
    rng, bits = np.random.default_rng(seed), int(np.ceil(10 * np.log2(n)))
    best, most = None, -1
    for _ in range(50):
        code = rng.choice(np.array([1, -1], np.int8), (n, bits))
        code[0, np.abs(code.sum(axis=0)) == n] *= -1  # a bit with one side only learns nothing
        least = min(int((code[i] != code[i + 1:]).sum(axis=1).min()) for i in range(n - 1))
        if least > most:
            best, most = code, least
    return best


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray      # languages x bits
    weights: np.ndarray   # bits x (N_BINS + 1); the last bin weighs nothing
    trust: np.ndarray     # languages x bits, rows sum to 1

    def margins(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """texts x bits: mean weight of each text's n-grams."""
        n = len(offsets) - 1
        total, count = np.zeros((n, len(self.weights))), np.zeros(n)
        size = np.diff(offsets)
        full = np.flatnonzero(size)
        if len(full):
            first = offsets[full]
            for bins, k in zip(ngram_bins(data, offsets), SIZES):
                for b, w in enumerate(self.weights):
                    total[full, b] += np.add.reduceat(w[bins], first, dtype=np.float64)
                count += np.maximum(size - k + 1, 0)
        return total / np.maximum(count, 1)[:, None]

    def decode(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(index of the nearest codeword, score, lead over the second) of each text."""
        loss = np.exp(-3.0 * np.clip(margins, -3, 3))[:, None, :] ** self.code[None]
        near = (self.trust[None] * loss).sum(axis=2)
        p = np.exp(-4.0 * (near - near.min(axis=1, keepdims=True)))
        p /= p.sum(axis=1, keepdims=True)
        top = np.sort(p, axis=1)
        lead = top[:, -1] - (top[:, -2] if p.shape[1] > 1 else 0)
        return near.argmin(axis=1), p.max(axis=1), lead


def train(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          per_language: int = PER_LANGUAGE) -> Model | None:
    """Fit on rows with a language; None without any. ``docs`` holds training rows only."""
    docs = docs.where(F.col(lang_col).isNotNull()).select(
        F.col(id_col).cast("string").alias("id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    rows = {r["lang"]: r["count"] for r in docs.groupBy("lang").count().collect()}  # one row a language
    languages = sorted(rows)
    if not languages:
        return None
    share = F.coalesce(*(F.when(F.col("lang") == x, F.lit(min(1.0, per_language / rows[x]))) for x in languages))
    hashed = F.pmod(F.xxhash64("id", F.lit("langid")), F.lit(1 << 20)) < share * (1 << 20)
    sample = materialise(docs.where(hashed), "langid-sample")
    place = {x: i for i, x in enumerate(languages)}

    def count(batches):
        total = {}
        for b in batches:
            data, offsets = utf8(lowered(b.column(1)))
            langs = np.array([place[x] for x in b.column(0).to_pylist()])
            for lo, hi in chunks(offsets, _CHUNK):
                off = offsets[lo:hi + 1] - offsets[lo]
                of = np.repeat(langs[lo:hi], np.diff(off))
                for bins in ngram_bins(data[offsets[lo]:offsets[hi]], off):
                    for x in np.unique(langs[lo:hi]).tolist():
                        c = np.bincount(bins[of == x], minlength=N_BINS + 1)
                        total[x] = total.get(x, 0) + c
        for x, c in total.items():
            bins = np.flatnonzero(c[:N_BINS])
            yield pa.record_batch([pa.array(np.full(len(bins), x, np.int32)), pa.array(bins.astype(np.int32)),
                                   pa.array(c[bins])], names=["lang", "bin", "n"])

    found = (sample.select("lang", "text").mapInArrow(releasing(count), "lang int, bin int, n long")
             .groupBy("lang", "bin").agg(F.sum("n").alias("n")).toArrow())  # languages x bins at most
    counts = np.zeros((len(languages), N_BINS))
    np.add.at(counts, (found["lang"].to_numpy(), found["bin"].to_numpy()), found["n"].to_numpy())

    share_of = np.zeros_like(counts)  # each language's distribution of n-grams, size by size
    for k in range(len(SIZES)):
        part = slice(k << BIN_BITS, (k + 1) << BIN_BITS)
        smooth = counts[:, part] + 0.5
        share_of[:, part] = smooth / smooth.sum(axis=1, keepdims=True)
    code = codewords(len(languages))
    weights = np.zeros((code.shape[1], N_BINS + 1), np.float32)
    for b in range(code.shape[1]):
        weights[b, :N_BINS] = np.log(share_of[code[:, b] > 0].mean(axis=0) / share_of[code[:, b] < 0].mean(axis=0))
    model = Model(languages, code, weights, np.ones(code.shape) / max(1, code.shape[1]))
    shared = sample.sparkSession.sparkContext.broadcast(model)

    def right(batches):
        for b in batches:
            data, offsets = utf8(lowered(b.column(1)))
            langs = np.array([place[x] for x in b.column(0).to_pylist()], np.int32)
            for lo, hi in chunks(offsets, _CHUNK):
                m = shared.value.margins(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
                ok = (m * shared.value.code[langs[lo:hi]] > 0).astype(np.float64)
                yield pa.record_batch([pa.array(langs[lo:hi]), pa.array(list(ok), pa.list_(pa.float64()))],
                                      names=["lang", "ok"])

    if code.shape[1]:
        hits = (sample.select("lang", "text").mapInArrow(releasing(right), "lang int, ok array<double>")
                .select("lang", F.posexplode("ok").alias("bit", "ok"))
                .groupBy("lang", "bit").agg(F.avg("ok").alias("ok")).collect())
        for r in hits:
            model.trust[r["lang"], r["bit"]] = max(r["ok"], 1e-3)
        model.trust /= model.trust.sum(axis=1, keepdims=True)
    return model


def predict(docs: DataFrame, model: Model | None, *, id_col: str = "doc_id", text_col: str = "text",
            ambiguous_lead: float = 0.2) -> DataFrame:
    """(id, lang_pred, score, ambiguous) of every row."""
    out = annotate(docs.select(F.col(id_col), F.col(text_col).alias("_lang_text")), model, text_col="_lang_text",
                   ambiguous_lead=ambiguous_lead)
    return out.select(id_col, F.col("_lang_pred").alias("lang_pred"), F.col("_lang_score").alias("score"),
                      F.col("_lang_ambiguous").alias("ambiguous"))


def annotate(docs: DataFrame, model: Model | None, *, text_col: str = "text", ambiguous_lead: float = 0.2) -> DataFrame:
    """``docs`` with _lang_pred, _lang_score and _lang_ambiguous."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([*docs.schema.fields, T.StructField("_lang_pred", T.StringType()),
                           T.StructField("_lang_score", T.DoubleType()), T.StructField("_lang_ambiguous", T.BooleanType())])
    place = docs.columns.index(text_col)

    def run(batches):
        m = shared.value
        names = np.array([*(m.languages if m else []), UND], dtype=object)
        for b in batches:
            n, text = b.num_rows, b.column(place)
            best, score, lead = np.full(n, len(names) - 1), np.zeros(n), np.ones(n)
            if m is not None:
                letters = pc.fill_null(pc.match_substring_regex(text, r"\p{L}"), False).to_numpy(zero_copy_only=False)
                data, offsets = utf8(lowered(text))
                for lo, hi in chunks(offsets, _CHUNK):
                    got = m.decode(m.margins(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]))
                    ok = letters[lo:hi]
                    for out, x in zip((best, score, lead), got):
                        out[lo:hi][ok] = x[ok]
            yield pa.record_batch([*b.columns, pa.array(names[best], pa.string()), pa.array(score),
                                   pa.array(lead < ambiguous_lead)], names=schema.fieldNames())

    return docs.mapInArrow(releasing(run), schema)


def identify(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             per_language: int = PER_LANGUAGE) -> DataFrame:
    """Train on the rows that aren't held out and predict every row: (id, lang_pred, score,
    ambiguous)."""
    model = train(docs.where(~held_out(id_col)), id_col=id_col, text_col=text_col, lang_col=lang_col,
                  per_language=per_language)
    return predict(docs, model, id_col=id_col, text_col=text_col)
