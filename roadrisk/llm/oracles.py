"""DuckDB SQL of the queries that SQL can express."""

_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def words_sql(col: str) -> str:
    return f"regexp_extract_all({_LOWER.format(f'coalesce({col}, chr(0))')}, '{_WORD}')"


ORACLES: dict[str, str] = {
    "op3_benchmark_decontamination": f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, {words_sql('text')} AS w FROM documents),
b AS (SELECT item_id, {words_sql('text')} AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, least(len(w), 13) AS n,
               unnest(list_transform(range(1, len(w) - least(len(w), 13) + 2),
                      lambda i: array_to_string(list_slice(w, i, i + least(len(w), 13) - 1), ' '))) AS g
        FROM b WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM win),
grams AS (SELECT r, n, unnest(range(1, len(w) - n + 2)) AS p,
                 unnest(list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(list_slice(w, i, i + n - 1), ' '))) AS g
          FROM d, sizes WHERE len(w) >= n),
occ AS (SELECT r, p, n, item_id FROM grams JOIN win USING (n, g)),
hit AS (SELECT r, count(DISTINCT x) AS n_hit
        FROM (SELECT DISTINCT r, unnest(range(p, p + n)) AS x FROM occ) GROUP BY r),
it AS (SELECT r, count(DISTINCT item_id) AS n_items,
              string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS items
       FROM occ GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN it USING (r)""",
    "op7_quality_rules": r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w,
             list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines FROM d),
g AS (SELECT r, unnest(range(1, len(w) - 1)) AS p,
             unnest(list_transform(range(1, len(w) - 1), lambda i: list_slice(w, i, i + 2))) AS g FROM w WHERE len(w) > 3),
dup AS (SELECT r, p FROM (SELECT r, p, count(*) OVER (PARTITION BY r, g) AS n FROM g) WHERE n > 1),
rep AS (SELECT r, count(DISTINCT x) AS n FROM (SELECT r, unnest([p, p + 1, p + 2]) AS x FROM dup) GROUP BY r),
m AS (SELECT doc_id, text, CAST(len(w) AS BIGINT) AS n_words,
             CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
             CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(len(lines) AS BIGINT) AS n_lines,
             CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
             CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words
      FROM w LEFT JOIN rep USING (r)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 10 * n_symbols > 3 * n_words OR 2 * n_dup_lines > n_lines
            OR 2 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > word_chars
            OR 2 * length(regexp_replace(text, '[^!]', '', 'g')) > n_words
            OR 2 * length(regexp_replace(text, '[^0-9]', '', 'g')) > word_chars
            OR word_chars < 2 * n_words OR word_chars > 20 * n_words) AS kept
FROM b""",
    "op10_line_dedup": r"""
WITH k AS (SELECT doc_id, pos, m, len(string_split(m, ' ')) AS n, array_to_string(string_split(m, ' ')[1:3], ' ') AS lead
           FROM (SELECT doc_id, pos, regexp_replace(line, '[^ ]*[0-9][^ ]*', '<*>', 'g') AS m
                 FROM (SELECT doc_id, unnest(range(0, len(x))) AS pos, unnest(x) AS line
                       FROM (SELECT doc_id, string_split(text, chr(10)) AS x FROM documents))
                 WHERE regexp_matches(line, '[^ \t\r]'))),
leaf AS (SELECT n, lead, count(DISTINCT m) AS variants, count(*) AS total FROM k GROUP BY ALL),
tok AS (SELECT n, lead, unnest(range(1, n + 1)) AS i, unnest(string_split(m, ' ')) AS t FROM k),
con AS (SELECT n, lead, i, t FROM tok JOIN leaf USING (n, lead) WHERE variants > 1
        GROUP BY n, lead, i, t, total HAVING count(*) >= 3 AND count(*) * count(*) >= total),
lik AS (SELECT v.n, v.lead, v.m, string_agg(CASE WHEN con.t IS NULL THEN '<*>' ELSE v.t END, ' ' ORDER BY v.i) AS g
        FROM (SELECT n, lead, m, unnest(range(1, n + 1)) AS i, unnest(string_split(m, ' ')) AS t
              FROM (SELECT DISTINCT n, lead, m FROM k JOIN leaf USING (n, lead) WHERE variants > 1)) v
        LEFT JOIN con USING (n, lead, i, t) GROUP BY ALL
        HAVING count(*) FILTER (WHERE con.t IS NOT NULL OR v.t = '<*>') >= 0.8 * n),
named AS (SELECT doc_id, pos, k.n, CASE WHEN lik.m IS NULL THEN 'v' || k.m ELSE 't' || k.n || ' ' || k.lead || ' ' || lik.g END AS tpl
          FROM k LEFT JOIN lik ON lik.n = k.n AND lik.lead = k.lead AND lik.m = k.m),
rec AS (SELECT tpl, min({'d': doc_id, 'p': pos}) AS f FROM named GROUP BY tpl, n
        HAVING count(DISTINCT doc_id) >= CASE WHEN n >= 20 THEN 2 WHEN n >= 6 THEN 3 ELSE 10 END),
gone AS (SELECT doc_id, list(pos) AS g FROM named JOIN rec USING (tpl) WHERE {'d': doc_id, 'p': pos} <> f GROUP BY doc_id)
SELECT doc_id,
       CASE WHEN g IS NULL THEN text ELSE array_to_string(list_transform(
            list_filter(range(0, len(string_split(text, chr(10)))), lambda i: NOT list_contains(g, i)),
            lambda i: string_split(text, chr(10))[i + 1]), chr(10)) END AS text,
       CAST(coalesce(len(string_split(text, chr(10))), 0) AS BIGINT) AS n_lines,
       CAST(coalesce(len(g), 0) AS BIGINT) AS n_dropped
FROM documents LEFT JOIN gone USING (doc_id)""",
}
