"""One query per operator, over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import bpe, decontaminate, filter_audit, html, katz, minhash, notices, packing, pii, pivots, prefix_trie, toxicity, url_rules
from tessera.llm.common import fold, stage, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def tokenizer_json(path: str | None = None) -> str:
    """The vocabulary file (a parameter), read once on the driver: its size is fixed."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("byte_bpe_50k.json")
    return Path(path).read_text(encoding="utf-8")


@query
def op8_forced_boundary_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and round trip of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.encode_documents(docs, tokenizer_json(), with_ids=False).drop("text")


@query
def op10_fuzzy_notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases and fuzzy notices of every document."""
    return notices.scan_documents(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


@query
def op5_boosted_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and chosen spans of personal data in every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.find(docs, pii.fit(docs)).drop("text")


@query
def op4_deobfuscated_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document, from its restored text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    fitted = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, fitted).withColumn("held_out", F.coalesce(fold() == 0, F.lit(False))).drop("text")


@query
def op9_association_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's URL."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_rules.judge(pages, stage(url_rules.mine(pages, table(spark, sf_dir, "labels")), "url_rules")).drop("url")


@query
def op7_host_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


@query
def op2_multi_index_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of documents."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op1_pivot_permutation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all vectors with equal labels."""
    return pivots.near_duplicates(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))


@query
def op6_simhash_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items that every document holds."""
    return decontaminate.find(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark")).drop("text")


@query
def op3_katz_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log-probability of every document under a Katz model of the training documents."""
    return katz.score(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op11_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of every document in windows of 1,024 tokens."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.digests(packing.pack(docs, tokenizer_json()))


@query
def op12_ternary_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the prefix trie of all rebuilt conversations."""
    convs = prefix_trie.rebuilt(prefix_trie.coded(table(spark, sf_dir, "conversations")))
    return prefix_trie.ends_digest(prefix_trie.trie(prefix_trie.sequences(convs)))


@query
def op13_filter_diagrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Steps of all 120 orders of five filters, for every source."""
    failures = filter_audit.text_failures(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return filter_audit.audit(filter_audit.mask_counts(failures, table(spark, sf_dir, "labels")))


_REACH = """
reach AS (SELECT id, id AS c FROM nodes UNION SELECT e.y, r.c FROM reach r JOIN edges e ON r.id = e.x),
comp AS (SELECT id, min(c) AS component_id FROM reach GROUP BY id)"""

ORACLE_SQL["op1_pivot_permutation"] = f"""
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
                     WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
pairs AS (SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
edges AS (SELECT DISTINCT x, y FROM pairs), nodes AS (SELECT vec_id AS id FROM embeddings), {_REACH}
SELECT e.vec_id, coalesce(n.n, 0) AS n_links, c.component_id, e.vec_id = c.component_id AS kept
FROM embeddings e JOIN comp c ON c.id = e.vec_id LEFT JOIN (SELECT x, count(*) AS n FROM pairs GROUP BY x) n ON n.x = e.vec_id
"""

ORACLE_SQL["op2_multi_index_minhash"] = f"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM documents),
g AS (SELECT doc_id, list_distinct(CASE WHEN len(ws) = 0 THEN CAST([] AS VARCHAR[]) WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
                                        ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS gs FROM w),
s AS (SELECT doc_id, len(gs) AS n, unnest(gs) AS s FROM g),
pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n, any_value(a.n) AS na, any_value(b.n) AS nb FROM s a JOIN s b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT x, y FROM pairs WHERE 100 * n >= 75 * (na + nb - n)),
edges AS (SELECT x, y FROM links UNION SELECT y, x FROM links), nodes AS (SELECT doc_id AS id FROM documents), {_REACH}
SELECT g.doc_id, len(g.gs) AS n_shingles, c.component_id, g.doc_id = c.component_id AS kept FROM g JOIN comp c ON c.id = g.doc_id
"""

ORACLE_SQL["op13_filter_diagrams"] = """
WITH RECURSIVE d AS (SELECT doc_id, coalesce(text, '') AS t, coalesce(source, '') AS part FROM documents),
first AS (SELECT t, min(doc_id) AS id FROM d GROUP BY t),
lab AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
w AS (SELECT d.doc_id, d.part, d.t, list_filter(regexp_split_to_array(d.t, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws,
             coalesce(l.good, 0) AS good, coalesce(l.toxic, 0) AS toxic, coalesce(d.doc_id > f.id, false) AS copy
      FROM d JOIN first f ON f.t = d.t LEFT JOIN lab l ON l.doc_id = d.doc_id),
m AS (SELECT part, good, toxic, CASE WHEN len(ws) < 200 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(ws)) < 50 * len(ws) THEN 'B' ELSE '' END
             || CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t) THEN 'C' ELSE '' END
             || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END || CASE WHEN copy THEN 'E' ELSE '' END AS fails FROM w),
c AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM m GROUP BY part, fails),
o AS (SELECT '' AS p UNION ALL SELECT o.p || f.f FROM o JOIN (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f) f ON NOT contains(o.p, f.f)),
s AS (SELECT p AS filter_order, unnest(range(1, 6)) AS step FROM o WHERE length(p) = 5),
x AS (SELECT c.part, s.filter_order, s.step, substr(s.filter_order, s.step, 1) AS f, c.n, c.good, c.toxic, c.fails, contains(c.fails, substr(s.filter_order, s.step, 1)) AS bad,
             length(translate(substr(s.filter_order, 1, s.step - 1), c.fails, '')) = s.step - 1 AS there FROM c CROSS JOIN s),
r AS (SELECT part, filter_order, CAST(step AS INTEGER) AS step, f, CAST(sum(CASE WHEN there AND NOT bad THEN n ELSE 0 END) AS BIGINT) AS kept,
             CAST(sum(CASE WHEN there AND bad THEN n ELSE 0 END) AS BIGINT) AS removed, CAST(sum(CASE WHEN bad AND NOT there THEN n ELSE 0 END) AS BIGINT) AS redundant,
             CAST(sum(CASE WHEN fails = f THEN n ELSE 0 END) AS BIGINT) AS unique_fails, CAST(sum(CASE WHEN there AND bad THEN good ELSE 0 END) AS BIGINT) AS good_lost,
             CAST(sum(CASE WHEN there AND bad THEN toxic ELSE 0 END) AS BIGINT) AS toxic_lost FROM x GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley FROM r
"""

ORACLE_SQL["op12_ternary_prefix_trie"] = """
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS t FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT conv_id, list({'r': r, 't': t} ORDER BY turn NULLS FIRST, sha256(length(r) || ':' || r || t)) AS ts,
             CAST(xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
                 lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: xor(x >> 1, (x & 1) * 3988292384))), 4294967295) % 6 AS BIGINT) AS h
      FROM t GROUP BY conv_id),
s AS (SELECT o.conv_id, list_concat(coalesce(b.ts, [])[1:o.h], o.ts[o.h + 1:]) AS ts FROM o LEFT JOIN o b ON b.conv_id = o.conv_id - o.conv_id % 100),
p AS (SELECT conv_id, ts, unnest(range(0, len(ts) + 1)) AS depth FROM s),
n AS (SELECT ts[1:depth] AS path, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
             sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (len(ts) = depth), '')) AS ends_sha256 FROM p GROUP BY ts[1:depth], depth),
k AS (SELECT path[1:depth - 1] AS path, count(*) AS n FROM n WHERE depth > 0 GROUP BY path[1:depth - 1]),
w AS (SELECT n.*, coalesce(k.n, 0) AS n_children, CASE WHEN n.depth = 0 THEN 0 ELSE (n.n_convs - 1) * length(n.path[n.depth].t) END AS own FROM n LEFT JOIN k ON k.path = n.path),
u AS (SELECT path, own, n_children, unnest(range(0, depth + 1)) AS d FROM w),
a AS (SELECT path[1:d] AS path, sum(own) AS saved, count(*) FILTER (n_children = 0) AS leaves FROM u GROUP BY path[1:d])
SELECT w.conv_id, w.depth, up.conv_id AS parent_conv_id, w.n_convs, w.n_children, a.leaves AS n_leaves, CAST(a.saved AS BIGINT) AS saved_tokens, w.ends_sha256
FROM w JOIN a ON a.path = w.path LEFT JOIN w up ON w.depth > 0 AND up.path = w.path[1:w.depth - 1] AND up.depth = w.depth - 1
"""
