"""Quality rules as a short-circuit cascade, in DataFrame and SQL functions only.

Measures are columns, rules are conditions over them. On a bounded sample the cascade
times each measure a rule needs that no earlier rule has paid for and counts what each
rule rejects; rules then run in order of rejection per cost, and a document's first
failing rule ends its evaluation (a CASE of conditions, so later rules aren't evaluated).
The order changes what a run costs, never which documents are kept.

Defined cases: a null or empty text has no words and fails the word count; ties and
repeated rows each give their row; a text of one line or word has no repeats; an empty
table gives no rows, and the rules then keep the order they were given in; other columns
pass through ``cascade`` under their own names (measures are taken under ``_q_`` names).
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The six ASCII white-space characters that part words, and the counted symbols.
SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
SAMPLE_ROWS = 2000


def base_measures(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Add n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words (long)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    df = df.withColumn("_q_text", text).withColumn("_q_words", F.expr(r"regexp_extract_all(_q_text, '[^ \\t-\\r]+', 0)"))
    df = (df.withColumn("n_words", F.size("_q_words").cast("long"))
          .withColumn("word_chars", F.char_length(F.translate("_q_text", SPACE, "")).cast("long"))
          .withColumn("n_symbols", (F.char_length("_q_text") - F.char_length(F.translate("_q_text", SYMBOLS, ""))).cast("long"))
          .withColumn("_q_lines", F.filter(F.split("_q_text", "\n"), lambda x: F.char_length(F.translate(x, SPACE, "")) > 0))
          .withColumn("n_dup_lines", (F.size("_q_lines") - F.size(F.array_distinct("_q_lines"))).cast("long")))
    return repeat_words(df, "_q_words").drop("_q_text", "_q_words", "_q_lines")


def repeat_words(df: DataFrame, words_col: str, out: str = "n_repeat_words",
                 window_hash: str = "xxhash64({0}, {1}, {2})") -> DataFrame:
    """Add the number of words inside a 3-word window that occurs twice or more.

    Each window is one long: its hash above, its place below (as many bits as the text
    needs), so one sort of longs brings equal windows together. Sorted neighbours with
    the same hash are repeats if their words are equal, too; their places in order give the
    covered words. Where neighbours of one hash differ (a collision, as on very long texts,
    whose places leave few bits to the hash), the text's windows are sorted by their words
    instead, so the number is exact whatever the hash.
    """
    w, n = words_col, F.size(words_col)
    place, same_hash = "cast(_q_keys[{0}] & (shiftleft(1L, _q_bits) - 1L) AS int)", "shiftright(_q_keys[{0}], _q_bits) = shiftright(_q_keys[{1}], _q_bits)"
    at, before = place.format("i"), place.format("i - 1")
    df = (df.withColumn("_q_bits", F.when(n > 2, F.ceil(F.log2(n))).otherwise(1).cast("int"))
          .withColumn("_q_keys", F.expr(
              f"CASE WHEN size({w}) < 4 THEN cast(array() AS array<bigint>) ELSE sort_array(transform(sequence(0, size({w}) - 3), i -> "
              f"shiftleft({window_hash.format(f'{w}[i]', f'{w}[i + 1]', f'{w}[i + 2]')}, _q_bits) | i)) END")))
    mixed = (f"size(_q_keys) > 1 AND exists(sequence(1, greatest(size(_q_keys) - 1, 1)), i -> {same_hash.format('i - 1', 'i')} AND NOT ("
             + " AND ".join(f"{w}[{before} + {k}] = {w}[{at} + {k}]" for k in range(3)) + "))")
    by_hash = ("sort_array(transform(filter(sequence(1, size(_q_keys)), i -> size(_q_keys) > 1 AND ("
               f"(i > 1 AND {same_hash.format('i - 2', 'i - 1')}) OR (i < size(_q_keys) AND {same_hash.format('i', 'i - 1')}))), "
               "i -> _q_keys[i - 1] & (shiftleft(1L, _q_bits) - 1L)))")
    windows = f"sort_array(transform(sequence(0, size({w}) - 3), i -> struct(concat_ws(' ', {w}[i], {w}[i + 1], {w}[i + 2]) AS g, cast(i AS bigint) AS p)))"
    by_words = ("sort_array(transform(filter(transform(_q_windows, (x, i) -> struct(x.p AS p, (i > 0 AND x.g = _q_windows[greatest(i - 1, 0)].g) OR "
                "(i < size(_q_windows) - 1 AND x.g = _q_windows[least(i + 1, size(_q_windows) - 1)].g) AS r)), y -> y.r), y -> y.p))")
    df = (df.withColumn("_q_mixed", F.expr(mixed))
          .withColumn("_q_windows", F.expr(f"CASE WHEN _q_mixed THEN {windows} END"))
          .withColumn("_q_places", F.expr(f"CASE WHEN _q_mixed THEN {by_words} ELSE {by_hash} END")))
    covered = F.expr("aggregate(_q_places, named_struct('n', 0L, 'last', -3L), "
                     "(s, p) -> named_struct('n', s.n + least(3L, p - s.last), 'last', p), s -> s.n)")
    return (df.withColumn(out, F.when(F.size("_q_keys") > 1, covered).otherwise(F.lit(0).cast("long")))
            .drop("_q_bits", "_q_keys", "_q_mixed", "_q_windows", "_q_places"))


@dataclass(frozen=True)
class Rule:
    """A document is rejected where ``reject``, a SQL condition over its text and measures, holds."""

    name: str
    reject: str


def _count(chars: str) -> str:
    return f"(char_length(_q_text) - char_length(translate(_q_text, '{chars}', '')))"


_LINES = r"size(filter(split(_q_text, '\\n'), x -> x RLIKE '[^ \\t-\\r]'))"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: A document fails the base rules with fewer than 50 words, or with over half its words repeated.
BASE_FAILED = "n_words < 50 OR 100 * n_repeat_words > 50 * n_words"

#: The rules after the base ones, over the base measures and the text.
RULES = (
    Rule("symbols", "10 * n_symbols > 3 * n_words"),
    Rule("duplicate_lines", f"2 * n_dup_lines > {_LINES}"),
    Rule("capitals", f"2 * {_count(_UPPER)} > word_chars"),
    Rule("exclamations", f"2 * {_count('!')} > n_words"),
    Rule("digits", f"2 * {_count('0123456789')} > word_chars"),
    Rule("word_length", "word_chars < 2 * n_words OR word_chars > 20 * n_words"),
)


def order_rules(sample: DataFrame, rules: tuple[Rule, ...] = RULES, text_col: str = "text") -> list[tuple[Rule, float, float]]:
    """(rule, seconds a row, share rejected) on a small table, most rejection per cost first."""
    sample = sample.withColumn("_q_text", F.coalesce(F.col(text_col), F.lit("")))
    n = max(1, sample.count())

    def seconds(df: DataFrame) -> float:
        took = []
        for _ in range(2):
            t = time.perf_counter()
            df.write.format("noop").mode("overwrite").save()
            took.append(time.perf_counter() - t)
        return min(took)

    scan = seconds(sample.select(F.char_length("_q_text"), "n_words"))
    share = sample.agg(*(F.count_if(F.expr(r.reject)).alias(r.name) for r in rules)).first()
    found = [(r, max(1e-9, (seconds(sample.select(F.char_length("_q_text"), F.expr(r.reject))) - scan) / n),
              share[r.name] / n) for r in rules]
    return sorted(found, key=lambda x: -x[2] / x[1])  # stable: equals keep the order given


def cascade(df: DataFrame, rules: tuple[Rule, ...] = RULES, *, text_col: str = "text", base_failed: str = BASE_FAILED,
            sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Add base_failed, failed_rule (the first rule that rejects, null if none) and kept to
    ``df``, which has the base measures' text. At most ``sample_rows`` rows estimate the
    rules' order; every row goes through the cascade."""
    from roadrisk.session import materialise
    sample = df.where(F.pmod(F.xxhash64(text_col), F.lit(16)) == 0).limit(sample_rows)
    sample = materialise(base_measures(sample.select(F.col(text_col)), text_col), "quality-sample")
    ordered = [r for r, _, _ in order_rules(sample.where(~F.expr(base_failed)), rules, text_col)]
    out = base_measures(df, text_col).withColumn("base_failed", F.expr(base_failed))
    verdict = F.when(F.col("base_failed"), F.lit("base"))
    for r in ordered:
        verdict = verdict.when(F.expr(r.reject.replace("_q_text", f"coalesce({text_col}, '')")), F.lit(r.name))
    return out.withColumn("failed_rule", verdict).withColumn("kept", F.col("failed_rule").isNull())
