"""DuckDB SQL for the queries that SQL can express."""

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def word_list(text):
    return (
        f"regexp_extract_all(translate(coalesce({text}, ''), '{UPPER}', '{LOWER}'), "
        r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    )


def windows(table, key):
    """Windows of ten words, or the whole of shorter texts: (key, begin, n, w)."""
    return (
        f"SELECT {key}, i AS begin_, least(10, len(words)) AS n, "
        "array_to_string(words[i : i + least(10, len(words)) - 1], ' ') AS w "
        f"FROM {table}, unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS t(i) "
        "WHERE len(words) > 0"
    )


OP6 = f"""
WITH d AS (SELECT doc_id, {word_list('text')} AS words FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {word_list('text')} AS words FROM benchmark
      WHERE item_id IS NOT NULL),
bw AS (SELECT DISTINCT item_id, n, w FROM ({windows('b', 'item_id')})),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT doc_id, i AS begin_, n, array_to_string(words[i : i + n - 1], ' ') AS w
       FROM d, sizes, unnest(range(1, len(words) - n + 2)) AS t(i)),
hit AS (SELECT doc_id, begin_, n, item_id FROM dw JOIN bw USING (n, w)),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM hit, unnest(range(begin_, begin_ + n))
            AS t(p) GROUP BY 1),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
          FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY 1)
SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""

FILLED = "coalesce(text, '')"
OP10_LIMITS = {"symbol_share": 0.05, "dup_line_share": 0.3, "repeat_share": 0.1, "mean_word": 20.0}


def _op10():
    shares = {
        "symbol_share": "n_symbols / nullif(word_chars, 0)",
        "dup_line_share": "n_dup_lines / nullif(n_words, 0)",
        "repeat_share": "n_repeat_words / nullif(n_words, 0)",
        "mean_word": "word_chars / nullif(n_words, 0)",
    }
    limits = ", ".join(
        f"greatest({low}, quantile_disc({x}, 0.75) + 6.0 * (quantile_disc({x}, 0.75) - "
        f"quantile_disc({x}, 0.25))) AS max_{k}"
        for (k, x), low in zip(shares.items(), OP10_LIMITS.values(), strict=True)
    )
    over = " OR ".join(f"coalesce({x} > max_{k}, false)" for k, x in shares.items())
    return rf"""
WITH t AS (SELECT doc_id, lang, source, {FILLED} AS text,
  regexp_extract_all({FILLED}, '[^\x20\x09-\x0D]+') AS words,
  list_filter(string_split({FILLED}, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
win AS (SELECT doc_id, i, array_to_string(words[i : i + 4], ' ') AS w
  FROM t, unnest(range(1, len(words) - 3)) AS u(i)),
rep AS (SELECT doc_id, i FROM win QUALIFY count(*) OVER (PARTITION BY doc_id, w) > 1),
cov AS (SELECT doc_id, count(DISTINCT p) AS n FROM rep, unnest(range(i, i + 5)) AS u(p) GROUP BY 1),
c AS (SELECT doc_id, lang, source, CAST(len(words) AS BIGINT) AS n_words,
  CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
  CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
  CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
  CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words FROM t LEFT JOIN cov USING (doc_id)),
f AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM c),
lim AS (SELECT lang, source, {limits} FROM f WHERE NOT base_failed GROUP BY 1, 2)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT ({over}) AS kept
FROM f LEFT JOIN lim ON f.lang IS NOT DISTINCT FROM lim.lang
  AND f.source IS NOT DISTINCT FROM lim.source
"""


LABEL_WORDS = "ads|adult|bets|casino|pills|spam"
OP3 = f"""
WITH u AS (SELECT page_id,
  translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''), '{UPPER}', '{LOWER}')
    AS host,
  coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path FROM pages),
r AS (SELECT *, '.' || host AS h FROM u)
SELECT page_id, host, path,
  CASE WHEN ends_with(h, '.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN ends_with(h, '.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN ends_with(h, '.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN ends_with(h, '.net') AND starts_with(path, '/') THEN 'net/' END AS rule,
  CASE rule WHEN 'example.net/en/' THEN 'allow' WHEN 'example.com/de/' THEN 'block'
    WHEN 'org/fr/' THEN 'allow' WHEN 'net/' THEN 'block'
    ELSE CASE WHEN regexp_matches(host, '(^|[.-])({LABEL_WORDS})([.-]|$)') THEN 'block'
      ELSE 'allow' END END AS verdict
FROM r
"""

_WORDS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_LINES = f"array_to_string(list_distinct(string_split({FILLED}, chr(10))), chr(10))"
OP7 = rf"""
WITH c AS (SELECT doc_id, source, lang, {FILLED} AS text,
  len(regexp_extract_all({FILLED}, '[^\x20\x09-\x0D]+')) AS space,
  len(regexp_extract_all({_LINES}, '{_WORDS}')) AS alnum FROM documents),
f AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1),
t AS (SELECT source, lang, 'space-1' AS version, space AS n FROM f
  UNION ALL SELECT source, lang, 'alnum-2', alnum FROM f)
SELECT source, lang, version, count(*) AS docs, CAST(sum(n) AS BIGINT) AS tokens FROM t GROUP BY 1, 2, 3
"""

# crc32 of a decimal number's text, by its table of 256.
_CRC_TABLE = """list_transform(range(256), lambda n: list_reduce([n] || range(8),
  lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END))"""
OP12 = f"""
WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) - 1 AS seq
  FROM conversations WHERE conv_id IS NOT NULL),
tab AS (SELECT {_CRC_TABLE} AS crcs),
c AS (SELECT conv_id, conv_id - conv_id % 100 AS base, xor(4294967295, list_reduce(
    [4294967295::BIGINT] || list_transform(string_split(conv_id::VARCHAR, ''), lambda d: ascii(d)::BIGINT),
    lambda c, b: xor(c >> 8, crcs[(xor(c, b) & 255) + 1]))) % 6 AS h
  FROM (SELECT DISTINCT conv_id FROM t), tab),
r AS (SELECT c.conv_id, 0 AS own, seq, role, text FROM c JOIN t ON t.conv_id = c.base AND t.seq < c.h
  UNION ALL SELECT c.conv_id, 1, seq, role, text FROM c JOIN t ON t.conv_id = c.conv_id AND t.seq >= c.h),
p AS (SELECT conv_id, text, row_number() OVER w AS depth,
  string_agg(md5(md5(role) || text), ',') OVER w AS prefix
  FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY own, seq ROWS UNBOUNDED PRECEDING)),
e AS (SELECT conv_id, 0 AS depth, '' AS prefix, '' AS text FROM c
  UNION ALL SELECT conv_id, depth, prefix, text FROM p),
m AS (SELECT *, max(depth) OVER (PARTITION BY conv_id) AS length,
  min(conv_id) OVER (PARTITION BY depth, prefix) AS name FROM e),
n AS (SELECT name, depth, count(*) AS n_convs, (count(*) - 1) * length(any_value(text)) AS saved,
  max(length) = depth AS leaf, coalesce(string_agg(CASE WHEN length = depth THEN conv_id::VARCHAR END,
    ',' ORDER BY conv_id), '') AS ends FROM m GROUP BY 1, 2),
up AS (SELECT n.*, m.name AS parent FROM n LEFT JOIN m ON m.conv_id = n.name AND m.depth = n.depth - 1),
k AS (SELECT parent AS name, depth - 1 AS depth, count(*) AS n_children FROM up WHERE depth > 0 GROUP BY 1, 2),
s AS (SELECT m.name, m.depth, sum(n.saved) AS saved_tokens, sum(n.leaf::INT) AS n_leaves
  FROM n JOIN m ON m.conv_id = n.name AND m.depth <= n.depth GROUP BY 1, 2)
SELECT up.name AS conv_id, up.depth::BIGINT AS depth, up.parent AS parent_conv_id, n_convs,
  coalesce(n_children, 0) AS n_children, n_leaves::BIGINT AS n_leaves,
  saved_tokens::BIGINT AS saved_tokens, sha256(ends) AS ends_sha256
FROM up JOIN s USING (name, depth) LEFT JOIN k USING (name, depth)
"""

SQL = {
    "op12_prefix_trie": OP12,
    "op3_url_filter": OP3,
    "op6_decontamination": OP6,
    "op7_token_totals": OP7,
    "op10_quality": _op10(),
}
