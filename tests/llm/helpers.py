"""Small fixtures and brute-force versions shared by the tests of the operators."""
import re
import sys
from os.path import abspath, dirname

sys.path.insert(0, dirname(dirname(dirname(abspath(__file__)))))

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {i: i + 32 for i in range(65, 91)}
DOC = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use themselves, as columns of the input.
CLASH = "n_words long, score double, n_lines long, pii string, sequence_id long, id string, node string, row long"


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def shingles(text, size=5):
    w = words(text)
    return frozenset(tuple(w[i:i + size]) for i in range(len(w) - size + 1)) or frozenset([tuple(w)] if w else [])


def frame(spark, rows, clash=True):
    """documents of (doc_id, text[, lang]) rows, with clashing extra columns."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", None, None) + ((1, 0.5, 2, "x", 3, "y", "z", 4) if clash else ()) for r in rows]
    return spark.createDataFrame(full, DOC + (", " + CLASH if clash else ""))


LONG = " ".join(f"word{i % 977}x{i % 31}" for i in range(20_000))
#: Nulls, empty and very long texts, ties and repeated rows.
HARD = [(1, None), (2, ""), (3, "   \n\n \t"), (4, LONG), (5, "a b c"), (5, "a b c"), (5, "other text with the same id"),
        (None, "a null id but some words here"), (6, "!!! ... ###"), (7, "é" * 3000), (8, "x" * 5000 + " tail of words " * 3)]
