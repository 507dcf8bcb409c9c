"""Registered queries of the training-data operators and their DuckDB SQL.

Every callable takes ``(spark, sf_dir)`` and applies its operator, with its
production parameters, to the whole table.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verity.llm.bands import score_quality
from verity.llm.bpe import round_trip
from verity.llm.centroids import cluster_vectors
from verity.llm.counts import token_counts
from verity.llm.ctw import score_texts
from verity.llm.embed import near_duplicate_vectors
from verity.llm.fim import fill_in_middle, restored
from verity.llm.licenses import BLOCK, PHRASES, TEMPLATES, scan, template_words
from verity.llm.minhash import near_duplicates
from verity.llm.mixing import mix_plan
from verity.llm.pii import pseudonymise
from verity.llm.spans import remove_repeated_spans
from verity.llm.toxicity import score_toxicity


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir))


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op2_tree_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(documents(spark, sf_dir), tokenizer_path())


def op3_vector_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op4_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeated_spans(documents(spark, sf_dir))


def op5_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(documents(spark, sf_dir))


def op6_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_plan(documents(spark, sf_dir)).drop("source")


def op7_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonymise(documents(spark, sf_dir).select("doc_id", "text"))


def op8_compression_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(documents(spark, sf_dir))


def op9_toxic_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return score_toxicity(documents(spark, sf_dir), labels).drop("evidence")


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(documents(spark, sf_dir).select("doc_id", "text")).drop("text", "notices")


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(documents(spark, sf_dir), tokenizer_path("byte_bpe_50k.json"))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return restored(fill_in_middle(documents(spark, sf_dir))).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"))


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_minhash_dedup": op1_minhash_dedup,
    "op2_tree_bpe": op2_tree_bpe,
    "op3_vector_graph": op3_vector_graph,
    "op4_sentence_spans": op4_sentence_spans,
    "op5_context_tree": op5_context_tree,
    "op6_source_mix": op6_source_mix,
    "op7_pseudonyms": op7_pseudonyms,
    "op8_compression_bands": op8_compression_bands,
    "op9_toxic_neighbours": op9_toxic_neighbours,
    "op10_license_scan": op10_license_scan,
    "op11_token_counts": op11_token_counts,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_centroids": op13_centroids,
}

OP6_SQL = r"""
WITH sizes AS (
  SELECT doc_id, source, md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS k,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents),
per AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1 AS weight
  FROM sizes GROUP BY source),
levels AS (
  SELECT *, (sum(source_size) OVER ()
             - coalesce(sum(3 * source_size) OVER (ORDER BY 3 * source_size / weight, source IS NULL, source
                                                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (ORDER BY 3 * source_size / weight, source IS NULL, source
                                ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM per),
targets AS (
  SELECT source, source_size, least(CAST(3 * source_size AS DOUBLE), max(level) OVER () * weight) AS target
  FROM levels),
budgets AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target) AS BIGINT) // source_size ELSE 0 END AS epochs
  FROM targets),
placed AS (
  SELECT s.doc_id, s.size, b.source_size, b.target, b.epochs,
         CAST(floor(b.target) AS BIGINT) - b.epochs * b.source_size
           - coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.k, s.doc_id, s.size
                                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS room
  FROM sizes s JOIN budgets b ON s.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, size, source_size, target,
       CAST(epochs * size + greatest(0, least(size, room)) AS BIGINT) AS taken,
       CAST(epochs AS BIGINT) AS epochs, CAST(greatest(0, least(size, room)) AS BIGINT) AS part
FROM placed
"""



def _list(words) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


def _op10_sql(threshold: float = 0.8) -> str:
    """Every block against every template, without filters."""
    phrases = ", ".join(f"({_list(p.split())}, '{label}')" for p, label in PHRASES.items())
    templates = ", ".join(f"({_list(template_words(t))}, '{label}')" for label, t in TEMPLATES)
    return rf"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
phrases(p, label) AS (VALUES {phrases}),
templates(t, label) AS (VALUES {templates}),
places AS (
  SELECT doc_id, label, unnest(list_filter(range(len(w)), lambda i: w[i + 1:i + len(p)] = p)) AS i
  FROM docs, phrases),
blocks AS (
  SELECT doc_id, s, list_distinct(w[s + 1:s + {BLOCK}]) AS b
  FROM (SELECT doc_id, w, unnest(range(0, len(w), {BLOCK // 2})) AS s FROM docs)),
notices AS (
  SELECT doc_id, label, len(list_intersect(b, t)) / len(t) AS share FROM blocks, templates
  WHERE len(list_intersect(b, t)) >= ceil(round({threshold} * len(t), 9))),
base AS (SELECT doc_id, count(*) AS n, min(i) AS a, max(i) AS z,
                string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM places GROUP BY doc_id),
found AS (SELECT doc_id, max(share) AS share FROM notices GROUP BY doc_id),
every AS (SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
          FROM (SELECT doc_id, label FROM places UNION ALL SELECT doc_id, label FROM notices) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_base,
       CAST(a AS BIGINT) AS first_word, CAST(z AS BIGINT) AS last_word, coalesce(base.labels, '') AS base_labels,
       coalesce(every.labels, '') AS labels,
       CASE WHEN n > 0 THEN 1.0::DOUBLE ELSE coalesce(share, 0.0)::DOUBLE END AS score
FROM docs d LEFT JOIN base USING (doc_id) LEFT JOIN found USING (doc_id) LEFT JOIN every USING (doc_id)
"""


# All pairs of documents with a shingle in common, on exact shingles.
OP1_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] ELSE list_distinct(list_transform(
         range(1, greatest(len(w) - 4, 1) + 1), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM w),
one AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM one a JOIN one b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
reach AS (
  SELECT doc_id AS id, doc_id AS c FROM s
  UNION SELECT l.b, r.c FROM reach r JOIN links l ON r.id = l.a),
least_one AS (SELECT id, min(c) AS c FROM reach GROUP BY id)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, c AS component_id, doc_id = c AS kept
FROM s JOIN least_one ON id = doc_id
"""

OP12_SQL = r"""
WITH units AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
         sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS d FROM documents),
numbers AS (
  SELECT *, len(u) AS n, [CAST('0x' || substr(d, 8 * i + 1, 8) AS BIGINT) FOR i IN range(4)] AS h FROM units),
cuts AS (
  SELECT *, least(h[1] % (n + 1), h[2] % (n + 1)) AS a, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS b,
         CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                OR h[3] % 100 >= 90 THEN 'plain'
              WHEN h[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM numbers),
pieces AS (
  SELECT *, array_to_string(u[:a], '') AS p, array_to_string(u[a + 1:b], '') AS m,
         array_to_string(u[b + 1:], '') AS s FROM cuts)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
              ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM pieces
"""


def _op13_sql(k: int = 40, dims: int = 64, rounds: int = 5) -> str:
    """Every distance anew in every round; a vector is a row of ``v``."""
    parts = [f"""
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id,
         [CAST(floor(256 * CAST(c AS DOUBLE)) AS BIGINT) FOR c IN embedding] AS x FROM embeddings
  WHERE len(embedding) = {dims} AND len([c FOR c IN embedding IF isfinite(c)]) = {dims}),
c0 AS (
  SELECT CAST(row_number() OVER (ORDER BY sha256('2:' || coalesce(CAST(vec_id AS VARCHAR), '')), vec_id, x) - 1
              AS INTEGER) AS c, x AS m
  FROM v QUALIFY c < {k})"""]
    for i in range(rounds + 1):
        parts.append(f"""
a{i} AS MATERIALIZED (
  SELECT r, vec_id, x, c AS cluster, m, d AS distance
  FROM (SELECT *, list_sum([CAST((x[j] - m[j]) * (x[j] - m[j]) AS BIGINT) FOR j IN range(1, {dims} + 1)]) AS d
        FROM v, c{i})
  QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, c) = 1)""")
        if i < rounds:
            parts.append(f"""
c{i + 1} AS (
  SELECT c, coalesce(new, m) AS m FROM c{i} LEFT JOIN (
    SELECT cluster, list((s - ((s % n) + n) % n) // n ORDER BY j) AS new FROM (
      SELECT cluster, j, CAST(sum(x[j]) AS BIGINT) AS s, count(*) AS n
      FROM a{i}, range(1, {dims} + 1) t(j) GROUP BY cluster, j) GROUP BY cluster) ON c = cluster)""")
    return ",".join(parts) + f"""
SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, CAST(distance AS BIGINT) AS distance,
       CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
       CAST(sum(distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(m, ',')) AS centroid_sha256
FROM a{rounds}
"""


ORACLE: dict[str, str] = {
    "op1_minhash_dedup": OP1_SQL,
    "op10_license_scan": _op10_sql(),
    "op6_source_mix": OP6_SQL,
    "op12_fill_in_middle": OP12_SQL,
    "op13_centroids": _op13_sql(),
}
