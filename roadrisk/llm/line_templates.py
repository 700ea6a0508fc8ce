"""Line deduplication by a log-template tree, in DataFrame and SQL functions only.

A line (a text split at line breaks) walks a tree of fixed depth: its token count, then its
first ``depth`` tokens, where a token with a digit is the wildcard ``<*>``. Lines of a leaf
with equal masked tokens are one variant. In a leaf with several variants a token is constant
at its place if at least ``max(min_docs, sqrt(lines of the leaf))`` of the leaf's lines have it
there; the others are variable fields. A variant of which at least ``similarity`` of the places
are constant is generalised: its template is its constants with wildcards between them, so a
leaf holds as many templates as it has families of lines; other variants are templates of
their own.

A template recurs in enough documents, by its length: one of ``long_tokens`` tokens or more
from its second document on, a shorter one from ``min_docs`` documents on, and one under
``min_tokens`` tokens, which lines share by chance, from ``min_short_docs`` on. All lines of a recurring template go, except the one in the document
with the lowest id (then the lowest line number).

Lines are counted over all documents. Only lines of leaves that recur are compared, and
only variants, not lines, are taken apart into tokens, so one frequent line is a few
pre-aggregated rows before any shuffle by key, and its template's lines are dealt to ``SALTS``
tasks. Drop lists join back on the document.

Defined cases: a null text stays null and an empty one empty (no lines dropped); blank lines
are never dropped; a line repeated within one document counts that document once;
rows equal in id and text are treated alike, as one document; a null id is the lowest;
an empty table gives no rows; other columns pass through (an
n_lines or n_dropped of the input is replaced).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadrisk.session import materialise

DEPTH = 3
LONG_TOKENS = 20
MIN_TOKENS = 6
MIN_DOCS = 3
MIN_SHORT_DOCS = 10
SIMILARITY = 0.8
SALTS = 16
#: Recurring leaves that are broadcast.
LEAVES = 1_000_000
WILDCARD = "<*>"


def lines(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", depth: int = DEPTH, long_tokens: int = LONG_TOKENS,
          min_tokens: int = MIN_TOKENS, min_docs: int = MIN_DOCS, min_short_docs: int = MIN_SHORT_DOCS) -> DataFrame:
    """(_t_doc, _t_id, _t_pos, _t_leaf, _t_variant, _t_needs, _t_masked) of every line that isn't
    blank; ``_t_needs`` documents make a template of its length recur."""
    size = F.size(F.split("_t_masked", " "))
    needs = F.when(size >= long_tokens, 2).when(size >= min_tokens, min_docs).otherwise(min_short_docs)
    masked = F.when(F.col("line").rlike("[0-9]"), F.regexp_replace("line", "[^ ]*[0-9][^ ]*", WILDCARD)).otherwise(F.col("line"))
    return (docs.select(F.xxhash64(id_col, text_col).alias("_t_doc"), F.col(id_col).alias("_t_id"),
                        F.posexplode(F.split(text_col, "\n")).alias("_t_pos", "line"))
            .where(F.col("line").rlike(r"[^ \t\r]"))
            .withColumn("_t_masked", masked)
            .select("_t_doc", "_t_id", "_t_pos",
                    F.xxhash64(size, F.substring_index("_t_masked", " ", depth)).alias("_t_leaf"),
                    F.xxhash64("_t_masked").alias("_t_variant"), needs.cast("long").alias("_t_needs"), "_t_masked"))


def templates(variants: DataFrame, similarity: float = SIMILARITY, min_docs: int = MIN_DOCS) -> DataFrame:
    """(_t_leaf, _t_variant, _t_template) of the variants of recurring leaves: variants
    generalised alike share a template."""
    several = (variants.groupBy("_t_leaf").agg(F.count(F.lit(1)).alias("_t_n"), F.sum("_t_lines").alias("_t_all"))
               .where("_t_n > 1").select("_t_leaf", "_t_all"))
    open_ = variants.join(several, "_t_leaf")
    constants = (open_.select("_t_leaf", "_t_all", "_t_lines", F.posexplode(F.split("_t_masked", " ")).alias("_t_place", "_t_token"))
                 .groupBy("_t_leaf", "_t_place", "_t_token").agg(F.sum("_t_lines").alias("_t_n"), F.first("_t_all").alias("_t_all"))
                 .where((F.col("_t_n") >= min_docs) & (F.col("_t_n") * F.col("_t_n") >= F.col("_t_all")))
                 # at most the square root of the leaf's lines for each place
                 .groupBy("_t_leaf").agg(F.collect_set(F.struct("_t_place", "_t_token")).alias("_t_constants"))
                 .select("_t_leaf", F.map_from_entries(F.transform("_t_constants", lambda c: F.struct(c, F.lit(True)))).alias("_t_constants")))
    size = F.size(F.split("_t_masked", " "))
    # both joins on the leaf go on to an exchange by other keys, so a leaf of many variants can be split
    general = (open_.join(constants, "_t_leaf")
               .withColumn("_t_places", F.expr("transform(split(_t_masked, ' '), (x, i) -> CASE WHEN map_contains_key(_t_constants, "
                                               f"named_struct('_t_place', i, '_t_token', x)) THEN x ELSE '{WILDCARD}' END)"))
               .withColumn("_t_like", F.expr("size(filter(zip_with(_t_places, split(_t_masked, ' '), (y, x) -> y = x), z -> z))"))
               .where(F.col("_t_like") >= similarity * size)
               .select("_t_leaf", "_t_variant", F.xxhash64("_t_leaf", F.array_join("_t_places", " "), F.lit("template")).alias("_t_general")))
    return (variants.join(general, ["_t_leaf", "_t_variant"], "left")
            .select("_t_leaf", "_t_variant", F.coalesce("_t_general", "_t_variant").alias("_t_template")))


def dropped_lines(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_docs: int = MIN_DOCS,
                  similarity: float = SIMILARITY, **kw) -> DataFrame:
    """(_t_doc, _t_id, _t_pos) of the lines to drop."""
    found = lines(docs, id_col=id_col, text_col=text_col, min_docs=min_docs, **kw)
    # leaves of several documents; one pass over the texts writes what the rest needs
    leaf = (found.groupBy("_t_leaf").agg(F.min("_t_doc").alias("a"), F.max("_t_doc").alias("b"), F.count(F.lit(1)).alias("n"),
                                         F.max("_t_needs").alias("needs"))
            .where((F.col("a") != F.col("b")) & (F.col("n") >= F.col("needs"))).select("_t_leaf"))
    leaf = materialise(leaf, "line-leaves")
    if leaf.count() <= LEAVES:  # 8 bytes each; beyond that, lines are shuffled to their leaf
        leaf = F.broadcast(leaf)
    here = materialise(found.join(leaf, "_t_leaf", "left_semi"), "line-candidates")
    variants = materialise(here.groupBy("_t_leaf", "_t_variant")
                           .agg(F.count(F.lit(1)).alias("_t_lines"), F.first("_t_masked").alias("_t_masked")), "line-variants")
    salt = F.pmod("_t_doc", F.lit(SALTS))  # a template of many documents is dealt to many tasks
    # a table of its own, so that the join below has an exchange on both sides and a frequent variant can be split
    names = materialise(templates(variants, similarity, min_docs), "line-names")
    named = materialise(here.select("_t_doc", "_t_id", "_t_pos", "_t_leaf", "_t_variant", "_t_needs")
                        .join(names, ["_t_leaf", "_t_variant"])
                        .select("_t_doc", "_t_id", "_t_pos", "_t_template", "_t_needs", salt.alias("_t_salt")), "line-templates")
    recurring = (named.groupBy("_t_template", "_t_salt", "_t_doc", "_t_needs").agg(F.min(F.struct("_t_id", "_t_pos", "_t_doc")).alias("first"))
                 .groupBy("_t_template", "_t_salt", "_t_needs").agg(F.count(F.lit(1)).alias("docs"), F.min("first").alias("first"))
                 .groupBy("_t_template", "_t_needs").agg(F.sum("docs").alias("docs"), F.min("first").alias("first"))
                 .where(F.col("docs") >= F.col("_t_needs"))
                 .select("_t_template", F.col("first._t_doc").alias("_t_first"), F.col("first._t_pos").alias("_t_first_pos"),
                         F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("_t_salt")))
    return (named.join(recurring, ["_t_template", "_t_salt"])
            .where((F.col("_t_doc") != F.col("_t_first")) | (F.col("_t_pos") != F.col("_t_first_pos")))
            .select("_t_doc", "_t_id", "_t_pos"))


def drop_recurring_lines(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """``docs`` with the recurring lines cut out of the text, and n_lines and n_dropped."""
    drop = (dropped_lines(docs, id_col=id_col, text_col=text_col, **kw)
            .groupBy(F.col("_t_doc").alias("_t_key"), "_t_id").agg(F.collect_set("_t_pos").alias("_t_drop")))  # bounded by one document's lines
    out = (docs.withColumn("_t_doc", F.xxhash64(id_col, text_col))
           .join(drop, (F.col("_t_doc") == F.col("_t_key")) & F.col(id_col).eqNullSafe(F.col("_t_id")), "left")
           .withColumn("_t_lines", F.split(text_col, "\n")))
    kept = F.expr("array_join(transform(array_except(sequence(0, size(_t_lines) - 1), _t_drop), i -> _t_lines[i]), '\n')")
    return (out.withColumn("n_lines", F.when(F.col(text_col).isNull(), 0).otherwise(F.size("_t_lines")).cast("long"))
            .withColumn("n_dropped", F.when(F.col("_t_drop").isNull(), 0).otherwise(F.size("_t_drop")).cast("long"))
            .withColumn("_t_new", F.when(F.col("_t_drop").isNull(), F.col(text_col)).otherwise(kept))
            .select(*[F.col("_t_new").alias(c) if c == text_col else F.col(c) for c in docs.columns
                      if c not in ("n_lines", "n_dropped")], "n_lines", "n_dropped"))
