"""The registered queries of the operators in this folder, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.llm import contamination, forest, language, licences, packing, quality, repeats, site_style, toxicity, trie, urls, vectors, whitening

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_file() -> str:
    """The published byte-level vocabulary of the installed package."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest.jaccard_join(table(spark, sf_dir, "documents"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = repeats.without_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cleaned.select("doc_id", F.coalesce("n_bytes", F.lit(0).cast("long")).alias("n_bytes"), "n_removed", "n_spans", "kept_sha256")


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(list(urls.RULES), "host string, path string, verdict string")
    return urls.judged(table(spark, sf_dir, "pages"), rules)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicates(table(spark, sf_dir, "embeddings"))


def op7_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.licence_scan(table(spark, sf_dir, "documents"))


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.language_predictions(table(spark, sf_dir, "documents"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"), tokenizer_file())


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination.contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.conversation_trie(table(spark, sf_dir, "conversations"))


def op13_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return site_style.extracted(table(spark, sf_dir, "pages"))


QUERIES: dict[str, Query] = {
    "op1_quality": op1_quality,
    "op2_jaccard_join": op2_jaccard_join,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_url_filter": op4_url_filter,
    "op5_toxicity": op5_toxicity,
    "op6_embedding_dedup": op6_embedding_dedup,
    "op7_licence_scan": op7_licence_scan,
    "op8_language": op8_language,
    "op9_packing": op9_packing,
    "op10_decontamination": op10_decontamination,
    "op11_embedding_whitening": op11_embedding_whitening,
    "op12_conversation_trie": op12_conversation_trie,
    "op13_html_extraction": op13_html_extraction,
}

SHINGLES_SQL = r"""
w_{0} AS (SELECT {1} AS id, regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}_]+') AS ws FROM {0} WHERE {1} IS NOT NULL),
s_{0} AS (
  SELECT DISTINCT id, array_to_string(ws[i : i + 4], ' ') AS s
  FROM (SELECT id, ws, unnest(range(1, greatest(2, len(ws) - 3))) AS i FROM w_{0} WHERE len(ws) > 0)
),
n_{0} AS (SELECT id, count(*) AS n FROM s_{0} GROUP BY id)"""

#: Reaches every node from every node over the pairs of ``links`` (a, b, both ways).
REACH_SQL = """
reach AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
low AS (SELECT a, min(b) AS low FROM reach GROUP BY a)"""

LICENCE_ROWS = ", ".join("({}, '{}', '{}')".format(k, a, b.replace("'", "''")) for k, (a, b) in enumerate(licences.TEMPLATES))
RULE_ROWS = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in urls.RULES)

ORACLES: dict[str, str] = {
    "op2_jaccard_join": f"""
WITH RECURSIVE {SHINGLES_SQL.format("documents", "doc_id")},
both_have AS (SELECT x.id AS a, y.id AS b, count(*) AS k FROM s_documents x JOIN s_documents y ON x.s = y.s AND x.id <> y.id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM both_have JOIN n_documents p ON a = p.id JOIN n_documents q ON b = q.id WHERE k / (p.n + q.n - k) >= 0.8
),
{REACH_SQL},
degree AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT doc_id, least(doc_id, coalesce(low, doc_id)) AS class_id, coalesce(n, 0) AS n_links, doc_id <= coalesce(low, doc_id) AS kept
FROM documents LEFT JOIN low ON low.a = doc_id LEFT JOIN degree ON degree.a = doc_id
""",
    "op4_url_filter": f"""
WITH rules(h, p, v) AS (VALUES {RULE_ROWS}),
cut AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM cut
),
fits AS (
  SELECT page_id, host, path, h || p AS rule, v,
         row_number() OVER (PARTITION BY page_id ORDER BY length(h || p) DESC NULLS LAST, h || p DESC) AS k
  FROM parts LEFT JOIN rules ON host <> '' AND (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
)
SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM fits WHERE k = 1
""",
    "op6_embedding_dedup": f"""
WITH RECURSIVE good AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
),
links AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM good x JOIN good y ON x.label = y.label AND x.vec_id <> y.vec_id AND len(x.e) = len(y.e)
  WHERE list_cosine_similarity(x.e, y.e) >= 0.98
),
{REACH_SQL},
degree AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(low, vec_id)) AS component_id, vec_id <= coalesce(low, vec_id) AS kept
FROM embeddings LEFT JOIN low ON low.a = vec_id LEFT JOIN degree ON degree.a = vec_id
""",
    "op7_licence_scan": rf"""
WITH texts AS (
  SELECT row_number() OVER () AS mark, doc_id, string_split(trim(regexp_replace(lower(text), '[^\p{{L}}\p{{N}}]+', ' ', 'g')), ' ') AS ws
  FROM (SELECT DISTINCT doc_id, text FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL)
),
templates AS (
  SELECT template, licence, string_split(trim(regexp_replace(lower(wording), '[^\p{{L}}\p{{N}}]+', ' ', 'g')), ' ') AS ws
  FROM (VALUES {LICENCE_ROWS}) t(template, licence, wording)
),
known AS (
  SELECT DISTINCT template, licence, len(ws) - 1 AS span, ws[i] || ' ' || ws[i + 1] AS pair
  FROM (SELECT *, unnest(range(1, len(ws))) AS i FROM templates)
),
sized AS (SELECT *, count(*) OVER (PARTITION BY template) AS t_size FROM known),
hits AS (
  SELECT mark, doc_id, n, pos, template, licence, span, t_size, pair
  FROM (SELECT mark, doc_id, len(ws) - 1 AS n, i - 1 AS pos, ws[i] || ' ' || ws[i + 1] AS pair FROM (SELECT *, unnest(range(1, len(ws))) AS i FROM texts))
  JOIN sized USING (pair)
),
stretches AS (
  SELECT a.mark, a.doc_id, a.licence, a.pos AS start, least(a.span, a.n - a.pos) AS length, a.t_size, count(DISTINCT b.pair) AS shared, count(*) AS inside
  FROM hits a JOIN hits b ON a.mark = b.mark AND a.template = b.template AND b.pos >= a.pos AND b.pos < a.pos + a.span
  GROUP BY a.mark, a.doc_id, a.licence, a.template, a.pos, a.span, a.n, a.t_size
),
best AS (
  SELECT *, 2 * shared / (t_size + shared + length - inside) AS dice FROM stretches WHERE 2 * shared / (t_size + shared + length - inside) >= 0.8
  QUALIFY row_number() OVER (PARTITION BY mark, licence ORDER BY dice DESC, length DESC, start) = 1
)
SELECT doc_id, licence, dice, CAST(start AS INTEGER) AS start, CAST(length + 1 AS INTEGER) AS n_words FROM best x
WHERE NOT EXISTS (
  SELECT 1 FROM best y WHERE y.mark = x.mark AND y.start <= x.start + x.length AND x.start <= y.start + y.length
    AND (y.dice > x.dice OR (y.dice = x.dice AND (y.length > x.length OR (y.length = x.length AND y.licence < x.licence))))
)
QUALIFY row_number() OVER (PARTITION BY doc_id, licence ORDER BY dice DESC, length DESC, start) = 1
""",
    "op10_decontamination": f"""
WITH {SHINGLES_SQL.format("documents", "doc_id")}, {SHINGLES_SQL.format("benchmark", "item_id")},
held AS (
  SELECT d.id AS doc_id, b.id AS item_id, count(*) AS k
  FROM s_documents d JOIN s_benchmark b USING (s) GROUP BY 1, 2
)
SELECT doc_id, item_id, k / n AS containment FROM held JOIN n_benchmark ON item_id = id WHERE k / n >= 0.8
""",
    "op12_conversation_trie": """
WITH ordered AS (
  SELECT conv_id AS c, list({'r': coalesce(role, ''), 't': coalesce(text, '')} ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
),
taken AS (
  SELECT *, xor(list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(string_split(c::VARCHAR, ''), lambda s: ascii(s)::BIGINT)),
    lambda r, s: list_reduce(list_prepend(xor(r, s), range(8)), lambda a, i: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)
  ), 4294967295) % 6 AS h
  FROM ordered
),
rebuilt AS (
  SELECT own.c, coalesce(base.turns[1:own.h], []) || own.turns[own.h + 1:] AS turns
  FROM taken own LEFT JOIN ordered base ON base.c = own.c - own.c % 100
),
prefixes AS (SELECT c, d, turns[1:d] AS p, len(turns) = d AS ends FROM (SELECT *, unnest(range(len(turns) + 1)) AS d FROM rebuilt)),
nodes AS (
  SELECT p, d, min(c) AS conv_id, count(*) AS n, (count(*) - 1) * coalesce(any_value(length(p[d].t)), 0) AS saved,
         string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE ends) AS ids
  FROM prefixes GROUP BY p, d
),
children AS (SELECT p[1:d - 1] AS p, d - 1 AS d, count(*) AS n FROM nodes WHERE d > 0 GROUP BY 1, 2),
whole AS (SELECT nodes.*, coalesce(children.n, 0) AS n_children FROM nodes LEFT JOIN children USING (p, d)),
subtrees AS (
  SELECT p[1:up] AS p, up AS d, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum(saved) AS saved_tokens
  FROM (SELECT *, unnest(range(d + 1)) AS up FROM whole) GROUP BY 1, 2
)
SELECT w.conv_id, w.d AS depth, above.conv_id AS parent_conv_id, w.n AS n_convs, w.n_children, n_leaves,
       saved_tokens::BIGINT AS saved_tokens, sha256(coalesce(w.ids, '')) AS ends_sha256
FROM whole w JOIN subtrees USING (p, d) LEFT JOIN nodes above ON w.d > 0 AND above.d = w.d - 1 AND above.p = w.p[1:w.d - 1]
""",
    # The tables' pages have one plain article each; its blocks are paragraphs and a heading.
    "op13_html_extraction": r"""
WITH cut AS (
  SELECT page_id, url, string_split_regex(regexp_extract(coalesce(html, ''), '(?s)<article>(.*)</article>', 1), '</?(?:p|h1)>') AS parts FROM pages
),
blocks AS (
  SELECT page_id, url, list_transform(parts, lambda b: trim(regexp_replace(
    regexp_replace(replace(replace(replace(regexp_replace(b, '<[^>]*>', '', 'g'), '&quot;', '"'), '&lt;', '<'), '&gt;', '>'), '&amp;?', '&', 'g'),
    '\s+', ' ', 'g'))) AS bs
  FROM cut
)
SELECT page_id, url, array_to_string(list_filter(bs, lambda b: b <> ''), chr(10)) AS text,
       length(array_to_string(list_filter(bs, lambda b: b <> ''), chr(10))) AS n_chars
FROM blocks
""",
}
