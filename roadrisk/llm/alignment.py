"""Alignment of two tokenizers' tokens over the same text, and how often ids meet.

A text, led by one space, is encoded by a byte-level BPE (A) and a piece model (B). Both
sets of token ends are places in the text's bytes; where an end of A equals one of B, the
tokens before it close a group. All documents of a chunk are merged at once: the merge of
A ends and B ends is divided by diagonals into pieces of equal work, each diagonal's place
found by a binary search of its own. A piece finds the shared ends of its two slices without
looking at any other; a group that runs over a border is stitched by counting the groups
closed in the pieces before. The pieces' groups give the overlaps (every A token with every
B token of its group) as id pairs per document.

How many documents hold a pair is counted by Spark over all rows. Scoring a document's
links needs those counts: the most frequent pairs (at most ``HEAD``, a bound that doesn't
grow with the corpus) are broadcast, all others are joined on the pair. Such a join has no
hot key, as every frequent pair is in the head.

Both tokenizers start anew at a space that follows other text (checked against B's pieces
when it is loaded), so a worker keeps the ids of the space-led pieces it has met in a cache
of bounded size.

Defined cases: a null or empty text, and one whose tokens of A or B don't spell the space
and the text byte by byte, has no tokens: zeros, and '' as digest; repeated rows and equal
or null ids are documents of their own; texts of any length are aligned whole; groups with
many tokens on both sides are counted by distinct ids; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import os
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadrisk.llm.bpe import _byte_chars
from roadrisk.llm.text import CHUNK_BYTES
from roadrisk.session import drop_scratch, materialise, scratch_path

#: Merge steps of a piece.
PIECE = 1 << 16
#: Most frequent pairs that are broadcast.
HEAD = 1 << 20
#: Links of a group beyond which its pairs are counted by distinct ids.
_WIDE = 1 << 12
_LINKS = 1 << 21
_SPACED = re.compile(r" *[^ ]+(?:(?<=\s) +[^ ]+)*| +")


class Pieces:
    """Ids of both tokenizers for space-led pieces of text, each met piece encoded once."""

    def __init__(self, path_a: str, path_b: str, cache: int = 400_000, max_piece: int = 64):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        import sentencepiece
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True  # their strings in a text are ordinary text
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.limit, self.max_piece = cache, max_piece
        byte = {c: b for b, c in _byte_chars().items()}
        with open(path_a, encoding="utf-8") as f:
            file = json.load(f)
        entries = dict(file["model"]["vocab"]) | {t["content"]: t["id"] for t in file.get("added_tokens", [])}
        size = max(entries.values()) + 1
        self.bytes_a = [b""] * size
        for entry, i in entries.items():
            self.bytes_a[i] = bytes(byte[c] for c in entry) if all(c in byte for c in entry) else entry.encode()
        names = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in enumerate(names)]
        self.len_a = np.array([len(x) for x in self.bytes_a])
        self.len_b = np.array([len(x) for x in self.bytes_b])
        self.decimals = _decimals(max(len(self.len_a), len(self.len_b)))
        #: no piece of B holds a space after other text, so B starts anew at such a space
        self.cuts = not any("▁" in p.lstrip("▁") for p in names)
        self.clear()

    def clear(self) -> None:
        self.code: dict[str, int] = {}
        self.ids = [np.zeros(0, np.int32), np.zeros(0, np.int32)]     # of A and of B, code after code
        self.start = [np.zeros(1, np.int64), np.zeros(1, np.int64)]   # where the ids of each code begin
        self.good = np.zeros(0, dtype=bool)                           # the ids spell the piece

    def cut(self, text: str) -> list[str]:
        """The text led by a space as pieces without their leading space."""
        if not self.cuts:
            return [text]
        parts = text.split(" ")
        if "" in parts or any(p[-1].isspace() for p in parts):
            return [p[1:] for p in _SPACED.findall(" " + text)]
        return parts

    def learn(self, new: list[str]) -> None:
        """Encode pieces that have no code yet: short ones that end in text as one text."""
        plain = [p for p in new if self.cuts and p and len(p) <= self.max_piece and not p[-1].isspace()]
        known = set(plain)
        rest = [p for p in new if p not in known]
        new = plain + rest
        joined = self._encode_a(["".join(" " + p for p in plain)])[0] if plain else []
        alone = self._encode_a([" " + p for p in rest]) if rest else []
        a = np.array(joined + [i for x in alone for i in x], np.int32)
        size = np.array([len(p.encode()) + 1 for p in plain], np.int64)
        end_a = np.searchsorted(np.cumsum(self.len_a[a[:len(joined)]]), np.cumsum(size)) + 1
        end_a = np.r_[end_a, len(joined) + np.cumsum([len(x) for x in alone], dtype=np.int64)]
        ids_b = self.b.encode(new, num_threads=1)
        b = np.array([i for x in ids_b for i in x], np.int32)
        end_b = np.cumsum([len(x) for x in ids_b], dtype=np.int64)
        good, at_a, all_a = [], 0, a.tolist()
        for p, za, ib in zip(new, end_a.tolist(), ids_b):
            want = (" " + p).encode()
            good.append(b"".join([self.bytes_b[i] for i in ib]) == want
                        and b"".join([self.bytes_a[i] for i in all_a[at_a:za]]) == want)
            at_a = za
        self.good = np.concatenate([self.good, np.array(good, dtype=bool)])
        for side, ids, ends in ((0, a, end_a), (1, b, end_b)):
            self.start[side] = np.concatenate([self.start[side], len(self.ids[side]) + ends])
            self.ids[side] = np.concatenate([self.ids[side], ids])
        for p in new:
            self.code[p] = len(self.code)

    def _encode_a(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.a.encode_batch_fast(texts, add_special_tokens=False)]

    def whole(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of a text that has an odd piece, encoded in one go; None if it isn't spelt."""
        a = self._encode_a([" " + text])[0]
        b = self.b.encode(text)
        want = (" " + text).encode()
        if b"".join([self.bytes_a[i] for i in a]) != want or b"".join([self.bytes_b[i] for i in b]) != want:
            return None
        return np.array(a, np.int32), np.array(b, np.int32)

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each text its ids of A and of B (both empty if it has no tokens)."""
        if len(self.code) > self.limit:
            self.clear()
        cut = [self.cut(t) if t else [] for t in texts]
        new = [p for p in dict.fromkeys(p for c in cut for p in c) if p not in self.code]
        if new:
            self.learn(new)
        counts = np.array([len(c) for c in cut], np.int64)
        first = np.r_[0, np.cumsum(counts)]
        codes = np.fromiter((self.code[p] for c in cut for p in c), np.int64, int(first[-1]))
        flat = []
        for ids, start in zip(self.ids, self.start):
            lens = start[codes + 1] - start[codes]
            ends = np.r_[0, np.cumsum(lens)]
            flat.append((ids[np.repeat(start[codes] - ends[:-1], lens) + np.arange(ends[-1])], ends[first]))
        odd = np.r_[0, np.cumsum(~self.good[codes])][first]
        none = np.zeros(0, np.int32)
        return [tuple(ids[at[k]:at[k + 1]] for ids, at in flat) if odd[k] == odd[k + 1] else self.whole(t) or (none, none)
                for k, t in enumerate(texts)]


_PIECES: dict[tuple[str, str], Pieces] = {}


def pieces_of(path_a: str, path_b: str) -> Pieces:
    """The worker's tokenizers (loaded once per Python worker)."""
    if (path_a, path_b) not in _PIECES:
        _PIECES[path_a, path_b] = Pieces(path_a, path_b)
    return _PIECES[path_a, path_b]


def diagonals(a: np.ndarray, b: np.ndarray, work: int) -> tuple[np.ndarray, np.ndarray]:
    """Where the merge of the sorted ends ``a`` and ``b`` stands after 0, work, 2 work, ...
    steps: how many of ``a`` and of ``b`` it has taken (equal ends: a first). Every diagonal
    has its own binary search; two equal ends are never left on both sides of a cut."""
    steps = np.r_[np.arange(0, len(a) + len(b), work), len(a) + len(b)]
    lo, hi = np.maximum(0, steps - len(b)), np.minimum(steps, len(a))
    while (lo < hi).any():
        mid = (lo + hi) // 2
        # a[mid] is among the first steps of the merge if it isn't behind b[step - mid - 1]
        other = steps - mid - 1
        ahead = a[np.minimum(mid, len(a) - 1)] <= b[np.clip(other, 0, len(b) - 1)]
        go = (lo < hi) & ahead
        stay = (lo < hi) & ~ahead
        lo = np.where(go, mid + 1, lo)
        hi = np.where(stay, mid, hi)
    i, j = lo, steps - lo
    split = (i > 0) & (j < len(b))
    split[split] = a[i[split] - 1] == b[j[split]]
    return i, j + split


def groups(a: np.ndarray, b: np.ndarray, work: int = PIECE) -> tuple[np.ndarray, np.ndarray]:
    """The group number of every token of A and of B, from their ends (sorted, equal at last)."""
    ga, gb = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
    if not len(a) or not len(b):
        return ga, gb
    i, j = diagonals(a, b, work)
    closed = np.zeros(len(i), np.int64)
    for k in range(len(i) - 1):  # the pieces; none needs another's result
        pa_, pb = a[i[k]:i[k + 1]], b[j[k]:j[k + 1]]
        at = np.searchsorted(pb, pa_)
        shared = pb[np.minimum(at, len(pb) - 1)] == pa_ if len(pb) else np.zeros(len(pa_), dtype=bool)
        ends = pa_[shared]
        ga[i[k]:i[k + 1]] = np.searchsorted(ends, pa_)
        gb[j[k]:j[k + 1]] = np.searchsorted(ends, pb)
        closed[k + 1] = len(ends)
    before = np.cumsum(closed)[:-1]  # stitching: a group open at a border goes on in the next piece
    return ga + np.repeat(before, np.diff(i)), gb + np.repeat(before, np.diff(j))


def _decimals(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The digits of 0 .. n - 1, right-aligned before one free byte, and how many there are."""
    ids, power = np.arange(n)[:, None], 10 ** np.arange(len(str(n)) - 1, -1, -1)
    cells = np.zeros((n, len(power) + 1), np.uint8)
    cells[:, :-1] = ids // power % 10 + 48
    return cells, np.maximum(1, (ids >= power).sum(axis=1))


class Aligned:
    """Groups and id pairs of the documents of a chunk."""

    def __init__(self, docs: list[tuple[np.ndarray, np.ndarray]], both: Pieces, work: int = PIECE):
        self.n_docs, self.width, self.decimals = len(docs), len(both.len_b), both.decimals
        self.n_a, self.n_b = (np.array([len(d[k]) for d in docs], np.int64) for k in (0, 1))
        self.a, self.b = (np.concatenate([*(d[k] for d in docs), np.zeros(0, np.int32)]).astype(np.int64) for k in (0, 1))
        self.ga, self.gb = groups(np.cumsum(both.len_a[self.a]), np.cumsum(both.len_b[self.b]), work)
        n = int(self.ga[-1]) + 1 if len(self.ga) else 0
        self.in_a, self.in_b = np.bincount(self.ga, minlength=n), np.bincount(self.gb, minlength=n)
        doc = np.repeat(np.arange(self.n_docs), self.n_a)
        self.doc = np.zeros(n, np.int64)  # of each group
        self.doc[self.ga] = doc
        self.n_groups = np.bincount(self.doc, minlength=self.n_docs)
        links = np.zeros(self.n_docs, np.int64)
        np.add.at(links, self.doc, self.in_a * self.in_b)
        self.n_links = links

    def digests(self) -> list[str]:
        """sha256 of each document's groups as text; '' without any."""
        # A tokens of a group, then its B tokens; what follows each token
        order = np.argsort(np.r_[2 * self.ga, 2 * self.gb + 1], kind="stable")
        ids = np.r_[self.a, self.b][order]
        side = order >= len(self.a)
        group = np.r_[self.ga, self.gb][order]
        last = np.ones(len(ids), dtype=bool)
        last[:-1] = (side[1:] != side[:-1]) | (group[1:] != group[:-1])
        stop = np.where(last, np.where(side, ord(";"), ord("|")), ord(",")).astype(np.uint8)
        digits, size = self.decimals
        cells = digits[ids]
        cells[:, -1] = stop
        width = cells.shape[1]
        text = cells[np.arange(width) >= (width - 1 - size[ids])[:, None]].tobytes()
        ends = np.r_[0, np.cumsum(size[ids] + 1)][np.r_[0, np.cumsum(self.n_a + self.n_b)]].tolist()
        # nothing follows a document's last token
        return [hashlib.sha256(text[a:z - 1]).hexdigest() if z > a else "" for a, z in zip(ends, ends[1:])]

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document, pair, links of the pair in the document), sorted; a pair is A's id
        times ``width`` plus B's id."""
        first_b = np.cumsum(self.in_b) - self.in_b
        first_a = np.cumsum(self.in_a) - self.in_a
        links = self.in_a * self.in_b
        wide = np.flatnonzero(links > _WIDE)
        doc, pair, n = [], [], []
        size = np.where(links[self.ga] > _WIDE, 0, self.in_b[self.ga])  # B tokens that each A token meets
        ends = np.cumsum(size)
        lo = 0
        while lo < len(self.a):  # slices of bounded links
            hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + _LINKS, side="right")))
            s = size[lo:hi]
            t = np.cumsum(s)
            at_b = np.repeat(first_b[self.ga[lo:hi]] - (t - s), s) + np.arange(int(t[-1]))
            doc.append(np.repeat(self.doc[self.ga[lo:hi]], s))
            pair.append(np.repeat(self.a[lo:hi], s) * self.width + self.b[at_b])
            n.append(np.ones(len(at_b), np.int64))
            lo = hi
        for g in wide:  # by distinct ids: their number is bounded by the vocabularies
            ua, ca = np.unique(self.a[first_a[g]:first_a[g] + self.in_a[g]], return_counts=True)
            ub, cb = np.unique(self.b[first_b[g]:first_b[g] + self.in_b[g]], return_counts=True)
            pair.append((ua[:, None] * self.width + ub).ravel())
            n.append(np.outer(ca, cb).ravel())
            doc.append(np.full(len(pair[-1]), self.doc[g]))
        if not doc:
            e = np.zeros(0, np.int64)
            return e, e, e
        doc, pair, n = np.concatenate(doc), np.concatenate(pair), np.concatenate(n)
        order = np.lexsort((pair, doc))
        doc, pair, n = doc[order], pair[order], n[order]
        new = np.ones(len(doc), dtype=bool)
        new[1:] = (doc[1:] != doc[:-1]) | (pair[1:] != pair[:-1])
        at = np.flatnonzero(new)
        return doc[at], pair[at], np.add.reduceat(n, at) if len(at) else n


def _bounded(texts: list[str | None]):
    """Row ranges of about ``CHUNK_BYTES`` characters (one row at least)."""
    lo = size = 0
    for k, t in enumerate(texts):
        if k > lo and size + len(t or "") > CHUNK_BYTES // 2:
            yield lo, k
            lo, size = k, 0
        size += len(t or "")
    if texts:
        yield lo, len(texts)


def align(docs: DataFrame, tokenizer_a: str, tokenizer_b: str, *, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """Per row: id, n_a, n_b, n_groups, n_links, groups_sha256, pairs and how many links each has."""
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType),
                           *(T.StructField(c, T.LongType()) for c in ("n_a", "n_b", "n_groups", "n_links")),
                           T.StructField("groups_sha256", T.StringType()),
                           T.StructField("pairs", T.ArrayType(T.LongType())), T.StructField("times", T.ArrayType(T.LongType()))])

    def run(batches):
        both = pieces_of(tokenizer_a, tokenizer_b)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for lo, hi in _bounded(texts):
                part = Aligned(both.encode(texts[lo:hi]), both)
                doc, pair, times = part.pairs()
                at = pa.array(np.searchsorted(doc, np.arange(hi - lo + 1)).astype(np.int32))
                yield pa.record_batch([batch.column(0).slice(lo, hi - lo), pa.array(part.n_a), pa.array(part.n_b),
                                       pa.array(part.n_groups), pa.array(part.n_links), pa.array(part.digests()),
                                       pa.ListArray.from_arrays(at, pa.array(pair)),
                                       pa.ListArray.from_arrays(at, pa.array(times))], names=schema.fieldNames())

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, schema)


def pair_counts(aligned: DataFrame, width: int) -> DataFrame:
    """(pair, n, best): in how many rows each pair is linked, and whether that is the most
    of its A id (ties included)."""
    counts = aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("n"))
    counts = materialise(counts, "pair-counts")
    a = F.floor(F.col("pair") / F.lit(width)).alias("a")
    most = counts.groupBy(a).agg(F.max("n").alias("most"))
    # one row for each id of A's vocabulary at most
    return (counts.withColumn("a", a).join(F.broadcast(most), "a")
            .select("pair", "n", (F.col("n") == F.col("most")).alias("best")))


def _head_bound(counts: DataFrame, head: int) -> int:
    """The least count of which, with all greater ones, at most ``head`` pairs have."""
    step = (F.log2(F.col("n")) * 16).cast("int")
    held, bound = 0, None
    for r in counts.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("pairs"), F.min("n").alias("least")).orderBy(F.desc("step")).collect():
        held += r["pairs"]  # at most 16 * 64 steps
        if held > head:
            break
        bound = r["least"]
    return bound if bound is not None else 1 << 62


def scored(aligned: DataFrame, counts: DataFrame, head: int = HEAD) -> DataFrame:
    """``aligned`` (read again from a table) with n_best and count_sum of each row."""
    spark = aligned.sparkSession
    bound = _head_bound(counts, head)
    frequent = counts.where(F.col("n") >= bound).orderBy("pair").toArrow()  # ``head`` rows at most
    shared = spark.sparkContext.broadcast(tuple(frequent[c].to_numpy() for c in ("pair", "n", "best")))
    keep = ["n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    id_col = aligned.columns[0]
    schema = T.StructType([T.StructField("row", T.LongType()), aligned.schema[id_col], *(aligned.schema[c] for c in keep),
                           T.StructField("n_best", T.LongType()), T.StructField("count_sum", T.LongType()),
                           T.StructField("rest", T.ArrayType(T.StructType([T.StructField("pair", T.LongType()),
                                                                           T.StructField("times", T.LongType())])))])

    def run(batches):
        pair_, n_, best_ = shared.value
        for b in batches:
            lists, many = b.column(b.num_columns - 2), b.column(b.num_columns - 1)
            at = lists.offsets.to_numpy().astype(np.int64)
            pair = lists.values.to_numpy()[at[0]:at[-1]]
            times = many.values.to_numpy()[many.offsets[0].as_py():many.offsets[-1].as_py()]
            at = at - at[0]
            k = np.searchsorted(pair_, pair)
            hit = np.zeros(len(pair), dtype=bool)
            if len(pair_):
                k = np.minimum(k, len(pair_) - 1)
                hit = pair_[k] == pair
            count, best = np.zeros(len(pair), np.int64), np.zeros(len(pair), np.int64)
            count[hit], best[hit] = times[hit] * n_[k[hit]], times[hit] * best_[k[hit]]
            total = lambda x: np.diff(np.r_[0, np.cumsum(x)][at])
            left = np.r_[0, np.cumsum(~hit)][at].astype(np.int32)
            rest = pa.ListArray.from_arrays(pa.array(left), pa.StructArray.from_arrays(
                [pa.array(pair[~hit]), pa.array(times[~hit])], ["pair", "times"]))
            yield pa.record_batch([*b.columns[:-2], pa.array(total(best)), pa.array(total(count)), rest],
                                  names=schema.fieldNames())

    first = (aligned.withColumn("row", F.monotonically_increasing_id()).select("row", id_col, *keep, "pairs", "times")
             .mapInArrow(run, schema))
    first = materialise(first, "alignment-scores")
    rest = first.select("row", F.explode("rest").alias("r")).select("row", "r.pair", "r.times")
    tail = (rest.join(counts.where(F.col("n") < bound), "pair").groupBy("row")
            .agg(F.sum(F.col("times") * F.col("best").cast("long")).alias("more_best"),
                 F.sum(F.col("times") * F.col("n")).alias("more_count")))
    more = lambda c: F.coalesce(F.col(c), F.lit(0))
    return (first.join(tail, "row", "left")
            .select(id_col, "n_a", "n_b", "n_groups", "n_links", (F.col("n_best") + more("more_best")).alias("n_best"),
                    (F.col("count_sum") + more("more_count")).alias("count_sum"), "groups_sha256"))


def alignment(docs: DataFrame, tokenizer_a: str, tokenizer_b: str, *, id_col: str = "doc_id", text_col: str = "text",
              head: int = HEAD) -> DataFrame:
    """Every row's tokens, groups and links, scored by the corpus-wide counts of their pairs."""
    import sentencepiece
    spark = docs.sparkSession
    path = scratch_path(spark, "alignment")
    (align(docs, tokenizer_a, tokenizer_b, id_col=id_col, text_col=text_col).write
     .option("parquet.writer.version", "PARQUET_2_0").option("compression", "zstd").parquet(path))
    aligned = spark.read.parquet(path)
    width = sentencepiece.SentencePieceProcessor(model_file=tokenizer_b).get_piece_size()
    counts = materialise(pair_counts(aligned, width), "pair-counts")
    out = scored(aligned, counts, head)
    drop_scratch(spark, path)  # its rows are in the scores' table
    return out
