"""SQL counterparts of the operators that SQL can express."""

from __future__ import annotations

from tierflow.llm.mixing import COMMON, HEADROOM, LONGEST, SHORTEST, TEMPER, TOPICS
from tierflow.llm.queries import MIX_ROUNDS

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

TOP_K = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pairs AS (
  SELECT a.vec_id AS query_id, b.vec_id, list_inner_product(a.q, b.q)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id
  WHERE a.vec_id % 50 = 0
)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
FROM pairs
QUALIFY rank <= 5
"""

_WORDS = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
DECONTAMINATION = f"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, {_WORDS}) AS w FROM documents),
i AS (SELECT item_id::VARCHAR AS item, regexp_extract_all({_LOWER}, {_WORDS}) AS w FROM benchmark WHERE item_id IS NOT NULL),
cuts AS (SELECT item, w, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS p FROM i WHERE len(w) > 0),
windows AS (SELECT DISTINCT item, array_to_string(w[p:p+9], ' ') AS win, least(len(w), 10) AS n FROM cuts),
sizes AS (SELECT DISTINCT n FROM windows),
places AS (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS p FROM d JOIN sizes ON len(w) >= n),
spans AS (SELECT doc_id, p, n, array_to_string(w[p:p+n-1], ' ') AS win FROM places),
hits AS (SELECT doc_id, p, s.n, item FROM spans s JOIN windows USING (win, n)),
covered AS (SELECT doc_id, unnest(generate_series(p, p + n - 1)) AS at_word FROM hits),
words AS (SELECT doc_id, count(DISTINCT at_word) AS n_hit FROM covered GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id
)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""

JACCARD = r"""
WITH RECURSIVE folded AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13),
    'abcdefghijklmnopqrstuvwxyz     ') AS t
  FROM documents
), d AS (
  SELECT doc_id, list_filter(string_split(t, ' '), lambda x: x <> '') AS w FROM folded
), cuts AS (
  SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 4, 1))) AS p FROM d WHERE len(w) > 0
), s AS (
  SELECT DISTINCT doc_id, array_to_string(w[p:p+4], ' ') AS g FROM cuts
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS o FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
  SELECT x, y FROM pairs JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * o >= 80 * (a.n + b.n - o)
), edges AS (
  SELECT x, y FROM links UNION ALL SELECT y, x FROM links
), reach AS (
  SELECT x AS v, x AS c FROM edges UNION SELECT edges.y, reach.c FROM reach JOIN edges ON edges.x = reach.v
), least_of AS (
  SELECT v, min(c) AS c FROM reach GROUP BY v
)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(c, d.doc_id) AS component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN least_of ON v = d.doc_id
"""

_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_BASE32 = " || ".join(
    f"substr('{_ALPHABET}', (((('0x' || substr(h, {5 * (i // 4) + 1}, 5))::BIGINT >> {15 - 5 * (i % 4)}) & 31) + 1)::BIGINT, 1)" for i in range(32)
)
WARC = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS first_id FROM p)
SELECT page_id, strlen(html)::BIGINT AS payload_bytes, {_BASE32} AS payload_digest,
  CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM f
"""


def _mixing(rounds: int = MIX_ROUNDS) -> str:
    """Raking, unrolled."""
    parts = [
        f"""WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, source, lang, coalesce(source, '') AS s, coalesce(lang, '') AS l,
    list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), held AS (
  SELECT l, word, count(*) AS df FROM (SELECT l, unnest(list_distinct(w)) AS word FROM d) WHERE length(word) BETWEEN {SHORTEST} AND {LONGEST} GROUP BY ALL
), topics AS MATERIALIZED (
  SELECT l, word, row_number() OVER (PARTITION BY l ORDER BY df DESC, encode(word)) AS place
  FROM held JOIN (SELECT l, count(*) AS n FROM d GROUP BY l) USING (l) WHERE df * {COMMON} <= n QUALIFY place <= {TOPICS}
), hits AS (
  SELECT r, word, place, count(*) AS n FROM (SELECT r, l, unnest(w) AS word FROM d) JOIN topics USING (l, word) GROUP BY ALL
), best AS (
  SELECT r, word FROM hits QUALIFY row_number() OVER (PARTITION BY r ORDER BY n DESC, place) = 1
), docs AS MATERIALIZED (
  SELECT doc_id, source, lang, s, l, l || ':' || coalesce(word, '') AS topic, len(w)::BIGINT AS n_tokens FROM d LEFT JOIN best USING (r)
), c0 AS MATERIALIZED (
  SELECT s, l, topic, sum(n_tokens)::DOUBLE AS tokens FROM docs GROUP BY ALL HAVING sum(n_tokens) > 0
), t_s AS (
  SELECT s, t / sum(t) OVER () AS t_s FROM (SELECT s, pow(sum(tokens), {TEMPER['source']}) AS t FROM c0 GROUP BY s)
), t_l AS (
  SELECT l, t / sum(t) OVER () AS t_l FROM (SELECT l, pow(sum(tokens), {TEMPER['lang']}) AS t FROM c0 GROUP BY l)
), t_topic AS (
  SELECT topic, sum(t_topic) AS t_topic FROM (
    SELECT topic, t * t_l / sum(t) OVER (PARTITION BY l) AS t_topic
    FROM (SELECT l, topic, pow(sum(tokens), {TEMPER['topic']}) AS t FROM c0 GROUP BY l, topic) JOIN t_l USING (l)
  ) GROUP BY topic
), r0 AS MATERIALIZED (
  SELECT c0.*, t_s, t_l, t_topic, tokens AS u FROM c0 JOIN t_s USING (s) JOIN t_l USING (l) JOIN t_topic USING (topic)
)"""
    ]
    dims = ("s", "l", "topic")
    bounds = " UNION ALL ".join(f"SELECT sum(tokens) / max(t_{d}) AS b FROM r0 GROUP BY {d}" for d in dims)
    parts.append(f"aim AS MATERIALIZED (SELECT {HEADROOM} * min(b) AS aim FROM ({bounds}))")
    last = "r0"
    for i in range(rounds):
        for d in dims:
            name = f"r{i + 1}_{d}"
            order = f"PARTITION BY {d} ORDER BY tokens / u, s, l, topic ROWS BETWEEN"
            parts.append(
                f"{name}_lines AS (SELECT {last}.*, aim * t_{d} AS goal, (aim * t_{d} - sum(tokens) OVER ({order} UNBOUNDED PRECEDING AND CURRENT ROW))"
                f" / sum(u) OVER ({order} 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS line FROM {last}, aim)"
            )
            parts.append(
                f"{name} AS MATERIALIZED (SELECT s, l, topic, tokens, t_s, t_l, t_topic, u * greatest(goal / sum(u) OVER (PARTITION BY {d}),"
                f" coalesce(max(line) OVER (PARTITION BY {d}), 0)) AS u FROM {name}_lines)"
            )
            last = name
    parts.append(f"p AS (SELECT s, l, topic, least(u / tokens, 1.0) AS p FROM {last})")
    return (
        ",\n".join(parts)
        + """
SELECT doc_id, source, lang, topic, n_tokens, round(coalesce(p, 0.0), 6) AS probability,
  (('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT / 4294967296.0) < coalesce(p, 0.0) AS sampled
FROM docs LEFT JOIN p USING (s, l, topic)
"""
    )


_TERMS = r"'[^\x00-\x40\x5B-\x60\x7B-\x7F]+'"
DIVERGENCE = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, regexp_extract_all({_LOWER}, {_TERMS}) AS w
  FROM documents
), t AS (
  SELECT r, lang, source, unnest(w) AS term FROM d
), c AS MATERIALIZED (
  SELECT lang, source, term, count(*) AS n, count(DISTINCT r) AS df FROM t GROUP BY ALL
), v AS MATERIALIZED (
  SELECT lang, term, sum(n)::HUGEINT AS n FROM c GROUP BY ALL HAVING sum(df) >= 10
), l AS (
  SELECT lang, count(*) AS terms, sum(n) AS total FROM v GROUP BY lang
), g AS MATERIALIZED (
  SELECT lang, source, coalesce(total, 0) AS total
  FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN (
    SELECT lang, source, sum(c.n) AS total FROM c JOIN v USING (lang, term) GROUP BY ALL) USING (lang, source)
), p AS MATERIALIZED (
  SELECT g.lang, g.source, v.term, coalesce(c.n, 0) AS n,
    1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 2) // (g.total + 2 * l.terms)::HUGEINT AS p,
    1 + 1000000000::HUGEINT * (v.n + 2) // (l.total + 2 * l.terms)::HUGEINT AS q
  FROM g JOIN l USING (lang) JOIN v USING (lang) LEFT JOIN c USING (lang, source, term)
), found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN (
    SELECT x.lang, x.source, y.source AS other, sum((x.p - y.p) * (x.p - y.p) // (x.p + y.p)) AS value
    FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL
  ) s ON s.lang = a.lang AND s.source = a.source AND s.other = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM p WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, value::BIGINT AS value,
  row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item))::INTEGER AS rank
FROM found
QUALIFY part = 'pair' OR rank <= 10
"""


ORACLE: dict[str, str] = {
    "op3_exact_top_k": TOP_K,
    "op4_decontamination": DECONTAMINATION,
    "op5_ngram_jaccard": JACCARD,
    "op8_mixing": _mixing(),
    "op10_warc": WARC,
    "op12_source_divergence": DIVERGENCE,
}
