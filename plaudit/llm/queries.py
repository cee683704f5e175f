"""The registered queries of the corpus operators: whole tables, production
parameters, the digest columns each query's contract asks for."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plaudit.llm.alignment import align_documents
from plaudit.llm.common import table
from plaudit.llm.divergence import LEAST_DOCUMENTS, TERMS, UNIT, audit
from plaudit.llm.jaccard import PERCENT, SHINGLE_WORDS, jaccard_classes
from plaudit.llm.lattice import near_vectors
from plaudit.llm.mixing import mix_report
from plaudit.llm.mtree import top_inner_products
from plaudit.llm.packing import pack_documents
from plaudit.llm.pii import span_report
from plaudit.llm.quality import classify_quality
from plaudit.llm.rules import RULES, STOP_WORDS, SYMBOLS, rule_report
from plaudit.llm.sharding import build_tree, shard_documents
from plaudit.llm.suffixes import remove_repeats
from plaudit.llm.toxicity import classify_toxicity


def op1_hash_tree_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"), build_tree(24))


def op2_e8_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


def op3_pareto_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_report(table(spark, sf_dir, "documents"))


def op4_suffix_grouping_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))


def op5_clause_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_local_search_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))


def op7_disclosure_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return span_report(table(spark, sf_dir, "documents"))


def op8_jaccard_metric_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_classes(table(spark, sf_dir, "documents"))


def op9_additive_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_mtree_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_inner_products(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op11_threshold_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rule_report(table(spark, sf_dir, "documents"))


def op12_incidence_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_documents(table(spark, sf_dir, "documents"))


def op13_transducer_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_hash_tree_sharding,
        op2_e8_near_vectors,
        op3_pareto_mixing,
        op4_suffix_grouping_dedup,
        op5_clause_toxicity,
        op6_local_search_packing,
        op7_disclosure_pii,
        op8_jaccard_metric_join,
        op9_additive_quality,
        op10_mtree_topk,
        op11_threshold_rules,
        op12_incidence_alignment,
        op13_transducer_divergence,
    )
}


def _rules_sql() -> str:
    """The measures and the threshold table in DuckDB SQL."""

    def side(r, value, bound):
        found = [f"{value} < {r.low} * {bound}"] if r.low is not None else []
        found += [f"{value} > {r.high} * {bound}"] if r.high is not None else []
        return " OR ".join(found)

    def broken(r):
        value, bound = (f"100 * {r.measure}", r.per) if r.per else (r.measure, "1")
        langs = "(" + ", ".join(f"'{x}'" for x in r.langs) + ")"
        asked = f"n_words >= {r.least_words}" + (f" AND coalesce(lang IN {langs}, false)" if r.langs else "")
        return f"CASE WHEN ({asked}) AND ({side(r, value, bound)}) THEN '{r.name}' END"

    def listed(code):
        words = STOP_WORDS[code].split()
        forms = ", ".join(f"'{f}'" for w in words for f in (w, w.capitalize()))
        return f"WHEN lang = '{code}' THEN len(list_filter(ws, lambda w: w IN ({forms})))"

    stops = " ".join(listed(code) for code in STOP_WORDS)
    return f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, lang, coalesce(text, '') AS t FROM documents
), s AS (
  SELECT *, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS ws,
    list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) AS ls
  FROM d
), w AS (
  SELECT rid, i, list_aggregate(ws[i:i + 4], 'string_agg', ' ') AS g
  FROM (SELECT rid, ws, unnest(generate_series(1, len(ws) - 4)) AS i FROM s WHERE len(ws) >= 5)
), r AS (
  SELECT rid, i, lead(i) OVER (PARTITION BY rid ORDER BY i) AS j
  FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS n FROM w) WHERE n > 1
), c AS (
  SELECT rid, sum(least(5, coalesce(j - i, 5))) AS n FROM r GROUP BY rid
), m AS (
  SELECT doc_id, lang, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
    CAST(length(t) - length(regexp_replace(t, '{SYMBOLS}', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(regexp_extract_all(t, '[!?]{{2,}}')) AS BIGINT) AS n_marks,
    CAST(CASE {stops} ELSE 0 END AS BIGINT) AS n_stop,
    CAST(len(ls) AS BIGINT) AS n_lines, CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
    CAST(len(list_filter(ls, lambda l: regexp_matches(l, '^[ \\t]*[-*•‣◦·]'))) AS BIGINT) AS n_bullets,
    CAST(len(list_filter(ls, lambda l: regexp_matches(l, '(\\.\\.\\.|…)[\\x20\\x09-\\x0D]*$'))) AS BIGINT) AS n_ellipses,
    CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words
  FROM s LEFT JOIN c USING (rid)
), f AS (
  SELECT *, list_filter([{", ".join(broken(r) for r in RULES)}], lambda x: x IS NOT NULL) AS failed FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_marks, n_stop, n_lines, n_dup_lines, n_bullets, n_ellipses,
  n_repeat_words, (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AS base_failed,
  len(failed) = 0 AS kept, array_to_string(failed, ',') AS failed_rules
FROM f
"""


# All rows a row reaches over the links ``e(x, y)``.
REACHED = "r AS (SELECT x, y FROM e UNION SELECT r.x, e.y FROM r JOIN e ON r.y = e.x)"

ORACLE_SQL: dict[str, str] = {
    "op2_e8_near_vectors": f"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings
), u AS (
  SELECT * FROM d
  WHERE len(list_filter(v, lambda x: x IS NOT NULL AND isfinite(x))) = len(v) AND list_sum(list_transform(v, lambda x: abs(x))) > 0
), e AS (
  SELECT a.rid AS x, b.rid AS y FROM u a JOIN u b ON a.rid <> b.rid
  WHERE CASE WHEN len(a.v) = len(b.v) THEN list_cosine_similarity(a.v, b.v) >= 0.9 ELSE false END
), {REACHED}, m AS (
  SELECT x, min(vec_id) AS low FROM r JOIN d ON d.rid = r.y GROUP BY x
), c AS (
  SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, least(vec_id, low) AS component_id
  FROM d LEFT JOIN (SELECT x, count(*) AS n FROM e GROUP BY x) l ON l.x = d.rid LEFT JOIN m ON m.x = d.rid
)
SELECT vec_id, n_links, component_id, vec_id = component_id AS kept FROM c
""",
    "op4_suffix_grouping_dedup": """
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), c AS (
  SELECT rid, doc_id, o, substring(h, 2 * o + 1, 2 * 305) AS part
  FROM (SELECT *, unnest(generate_series(0, length(h) // 2 - 50, 256)) AS o FROM d WHERE length(h) >= 100)
), w AS (
  SELECT rid, doc_id, o + j AS i, substring(part, 2 * j + 1, 100) AS g
  FROM (SELECT *, unnest(generate_series(0, length(part) // 2 - 50)) AS j FROM c)
), b AS (
  SELECT rid, i FROM (SELECT rid, doc_id, i, min(doc_id) OVER (PARTITION BY g) AS low FROM w) WHERE low < doc_id
), f AS (
  SELECT rid, i, i > coalesce(lag(i) OVER (PARTITION BY rid ORDER BY i) + 50, -1) AS opens FROM b
), s AS (
  SELECT rid, min(i) AS low, max(i) + 50 AS high
  FROM (SELECT rid, i, sum(opens::INT) OVER (PARTITION BY rid ORDER BY i) AS span FROM f) GROUP BY rid, span
), k AS (
  SELECT rid, low, high, coalesce(lag(high) OVER (PARTITION BY rid ORDER BY low), 0) AS before FROM s
), t AS (
  SELECT rid, sum(high - low) AS n_removed, count(*) AS n_spans, max(high) AS after,
    string_agg(substring(h, 2 * before + 1, 2 * (low - before)), '' ORDER BY low) AS kept
  FROM k JOIN d USING (rid) GROUP BY rid
)
SELECT doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
  sha256(unhex(coalesce(kept, '') || substring(h, 2 * coalesce(after, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN t USING (rid)
""",
    "op8_jaccard_metric_join": f"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+'
  ) AS ws FROM documents
), s AS (
  SELECT DISTINCT rid, list_aggregate(ws[i:i + {SHINGLE_WORDS - 1}], 'string_agg', ' ') AS g
  FROM (SELECT rid, ws, unnest(generate_series(1, greatest(len(ws) - {SHINGLE_WORDS - 1}, 1))) AS i FROM d WHERE len(ws) > 0)
), n AS (
  SELECT rid, count(*) AS n FROM s GROUP BY rid
), p AS (
  SELECT a.rid AS x, b.rid AS y, count(*) AS shared FROM s a JOIN s b ON a.g = b.g AND a.rid <> b.rid GROUP BY ALL
), e AS (
  SELECT x, y FROM p JOIN n a ON a.rid = x JOIN n b ON b.rid = y WHERE 100 * shared >= {PERCENT} * (a.n + b.n - shared)
), {REACHED}, m AS (
  SELECT x, min(doc_id) AS low FROM r JOIN d ON d.rid = r.y GROUP BY x
)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, least(doc_id, low) AS component_id
FROM d LEFT JOIN n USING (rid) LEFT JOIN m ON m.x = d.rid
""",
    "op11_threshold_rules": _rules_sql(),
    "op13_transducer_divergence": f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, coalesce(text, '') AS t, coalesce(lang, '') AS lang, coalesce(source, '') AS source
  FROM documents
), w AS (
  SELECT rid, lang, source, unnest(regexp_extract_all(
    translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+'
  )) AS term FROM d
), k AS (
  SELECT lang, term FROM w GROUP BY lang, term HAVING count(DISTINCT rid) >= {LEAST_DOCUMENTS}
), c AS (
  SELECT lang, source, term, count(*) AS n FROM w SEMI JOIN k USING (lang, term) GROUP BY ALL
), g AS (
  SELECT lang, source, coalesce(n, 0) AS n, coalesce(v, 0) AS v
  FROM (SELECT DISTINCT lang, source FROM d)
  LEFT JOIN (SELECT lang, source, sum(n) AS n FROM c GROUP BY ALL) USING (lang, source)
  LEFT JOIN (SELECT lang, count(*) AS v FROM k GROUP BY lang) USING (lang)
), p AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
    1 + ({UNIT}::HUGEINT * (coalesce(c.n, 0) + 1)) // (g.n + g.v) AS p
  FROM g JOIN k USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), q AS (
  SELECT lang, term, 1 + ({UNIT}::HUGEINT * (sum(n) + 1)) // (total + v) AS q
  FROM c JOIN (SELECT lang, sum(n) AS total, any_value(v) AS v FROM g GROUP BY lang) USING (lang) GROUP BY lang, term, total, v
), f AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), u AS (
  SELECT x.lang, x.source, 'pair' AS part, y.source AS item, coalesce(f.value, 0) AS value
  FROM g x JOIN g y ON x.lang = y.lang AND x.source <> y.source
  LEFT JOIN f ON f.lang = x.lang AND f.source = x.source AND f.item = y.source
  UNION ALL
  SELECT p.lang, p.source, 'term', p.term, (p.p - q.q) * (p.p - q.q) // q.q
  FROM p JOIN q USING (lang, term) WHERE p.n > 0 AND p.p > q.q
), r AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM u
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM r WHERE part = 'pair' OR rank <= {TERMS}
""",
    "op10_mtree_topk": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
""",
}
