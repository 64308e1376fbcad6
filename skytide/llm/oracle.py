"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lowered(column: str) -> str:
    return f"translate(coalesce({column}, ''), '{_UPPER}', '{_LOWER}')"


_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

DECONTAMINATE = f"""
WITH d AS (SELECT doc_id, regexp_extract_all({lowered('text')}, '{_ALNUM}') AS w FROM documents),
i AS (SELECT item_id, regexp_extract_all({lowered('text')}, '{_ALNUM}') AS w FROM benchmark),
iw AS (SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(list_slice(w, p0, p0 + least(10, len(w)) - 1), ' ') AS win
  FROM (SELECT *, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS p0 FROM i WHERE len(w) > 0)),
lengths AS (SELECT DISTINCT n FROM iw),
dw AS (SELECT doc_id, n, p0, array_to_string(list_slice(w, p0, p0 + n - 1), ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p0 FROM d, lengths WHERE len(w) >= n)),
m AS (SELECT dw.doc_id, dw.n, dw.p0, iw.item_id FROM dw JOIN iw ON iw.win = dw.win AND iw.n = dw.n),
h AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(p0, p0 + n)) AS p FROM m) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM m) GROUP BY doc_id)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)
"""

_URL_RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
_URL_BLOCKS = (
    r"(^|[^a-z0-9])spam-farm($|[^a-z0-9])",
    r"(^|[^a-z0-9])cheap-(pills|meds)($|[^a-z0-9])",
    r"(^|[^a-z0-9])(online-)?casino($|[^a-z0-9])",
    r"(^|[^a-z0-9])(xxx|porn)($|[^a-z0-9])",
    r"^[a-z]+://[0-9]+([.][0-9]+){3}([:/?#]|$)",
    r"[?&]utm_campaign=(spam|bulk)($|[^a-z0-9])",
)


def _fits(rule: str) -> str:
    host, path = rule.split("/", 1)
    return f"((host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '/{path}'))"


_LONGEST = sorted(_URL_RULES, key=lambda r: -len(r[0]))
_RULE_CASES = " ".join(f"WHEN {_fits(rule)} THEN '{rule}'" for rule, _ in _LONGEST)
_VERDICTS = " ".join(f"WHEN rule = '{rule}' THEN '{verdict}'" for rule, verdict in _LONGEST)
_BLOCKED = " OR ".join(f"regexp_matches(plain, '{p}')" for p in _URL_BLOCKS)

URL_FILTER = f"""
WITH p AS (SELECT page_id, {lowered('url')} AS plain, strpos(coalesce(url, ''), '://') AS p0, substr(url, strpos(url, '://') + 3) AS rest FROM pages),
h AS (SELECT *, CASE WHEN p0 > 0 THEN regexp_extract(rest, '^[^/?#]*') ELSE '' END AS raw FROM p),
s AS (SELECT page_id, plain, {lowered('raw')} AS host,
  CASE WHEN p0 > 0 THEN regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') ELSE '' END AS path FROM h),
r AS (SELECT *, CASE {_RULE_CASES} END AS rule FROM s)
SELECT page_id, host, path, rule, CASE {_VERDICTS} WHEN {_BLOCKED} THEN 'block' ELSE 'allow' END AS verdict FROM r
"""

JACCARD_JOIN = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all({lowered('text')}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(list_slice(w, p0, p0 + 4), ' ') AS g
  FROM (SELECT *, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS p0 FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s AS a JOIN s AS b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT x, y FROM c JOIN n AS nx ON nx.doc_id = x JOIN n AS ny ON ny.doc_id = y WHERE 100 * c >= 75 * (nx.n + ny.n - c)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r AS (SELECT x, y FROM e UNION SELECT r.x, e.y FROM r JOIN e ON e.x = r.y),
m AS (SELECT x, min(y) AS y FROM r GROUP BY x)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, least(w.doc_id, coalesce(m.y, w.doc_id)) AS component_id
FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN m ON m.x = w.doc_id
"""

# Every pair of a label: what NN-descent searches; equal where it misses none.
NN_DESCENT = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS x, b.vec_id AS y FROM v AS a JOIN v AS b
  ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.98),
r AS (SELECT x, y FROM l UNION SELECT r.x, l.y FROM r JOIN l ON l.x = r.y),
m AS (SELECT x, min(y) AS y FROM r GROUP BY x),
n AS (SELECT x, count(*) AS n FROM l GROUP BY x)
SELECT e.vec_id, coalesce(n.n, 0) AS n_links, least(e.vec_id, coalesce(m.y, e.vec_id)) AS component_id,
  e.vec_id = least(e.vec_id, coalesce(m.y, e.vec_id)) AS kept
FROM embeddings AS e LEFT JOIN m ON m.x = e.vec_id LEFT JOIN n ON n.x = e.vec_id
"""

TEXT_OWNERS = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS b FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY b) AS group_size,
  row_number() OVER w = 1 AS kept, sha256(b) AS text_sha256
FROM d WINDOW w AS (PARTITION BY b ORDER BY length(t) DESC, doc_id NULLS LAST)
"""

# Every anchor against every row.
HARD_NEGATIVES = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
    CAST(list_inner_product(a.e, b.e) AS BIGINT) AS score
  FROM v AS a JOIN v AS b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5),
n AS (SELECT anchor_id, positive_id, positive_score, other_id AS negative_id, score AS negative_score,
    row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) AS rank
  FROM p JOIN s USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10
"""

ORACLE: dict[str, str] = {
    "op12_hard_negatives": HARD_NEGATIVES,
    "op13_exact_dedup": TEXT_OWNERS,
    "op9_jaccard_join": JACCARD_JOIN,
    "op5_nn_descent": NN_DESCENT,
    "op7_url_filter": URL_FILTER,
    "op10_decontaminate": DECONTAMINATE,
}
