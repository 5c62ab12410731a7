"""One query per operator, on its whole table with production parameters."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.llm import (
    decontam, host_rules, lines, near_dup, pieces, recurrent_lm, substrings, token_counts, tokens, toxicity, url_labels, urls, whitening,
    zone_clusters)
from tidemark.llm.registry import query, registered  # noqa: F401
from tidemark.sources.scratch import run_folder

_WS = "(' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"
_AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

OP2_SQL = f"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
k AS (SELECT *, translate(trim(line, {_WS}), {_AZ}) AS key FROM l),
c AS (SELECT key FROM k WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10),
m AS (SELECT k.*, c.key IS NOT NULL AS gone FROM k LEFT JOIN c USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""


@query("op2_line_dedup", OP2_SQL)
def line_dedup(t):
    cut = lines.drop_common_lines(t.documents.select("doc_id", "text"), min_docs=10, min_chars=1)
    return cut.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


URL_RULES = [urls.Rule("net/", "block"), urls.Rule("example.net/en/", "allow"),
             urls.Rule("example.com/de/", "block"), urls.Rule("org/fr/", "allow")]


@query("op7_url_filters")
def url_filters(t):
    model = urls.train(url_labels.table(t.spark))
    return urls.judge(t.pages.select("page_id", "url"), URL_RULES, model).select(
        "page_id", "host", "path", "rule", "verdict", "p_block")


_RULES = {"short": "n_words < 50", "repeats": "100 * n_repeat_words > 50 * n_words",
          "symbols": "10 * n_symbols > word_chars", "lines": "n_dup_lines >= 10"}


def _rate_sql(k: str) -> str:
    m, v = f"avg(f_{k} / n) OVER ()", f"var_pop(f_{k} / n) OVER ()"
    extra = f"({v} - ({m}) * (1 - {m}) * avg(1.0 / n) OVER ())"
    strength = (f"CASE WHEN {extra} > 0 THEN greatest(0.0, ({m}) * (1 - {m}) / {extra} - 1) "
                "ELSE sum(n) OVER () END")
    return f"(f_{k} + ({m}) * ({strength})) / (n + ({strength}))"


OP9_SQL = f"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
x AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS win
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
again AS (SELECT doc_id, win FROM x GROUP BY ALL HAVING count(*) > 1),
rep AS (SELECT doc_id, count(DISTINCT p) AS n_repeat_words FROM (
        SELECT doc_id, i + unnest([0, 1, 2]) AS p FROM x JOIN again USING (doc_id, win)) GROUP BY doc_id),
f AS (
  SELECT doc_id, source, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         len(list_filter(string_split(text, chr(10)), lambda s: trim(s, {_WS}) <> ''))
           - len(list_distinct(list_filter(string_split(text, chr(10)), lambda s: trim(s, {_WS}) <> ''))) AS n_dup_lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM d LEFT JOIN rep USING (doc_id)),
h AS (SELECT source, count(*) AS n, {', '.join(f'count(*) FILTER (WHERE {c}) AS f_{k}' for k, c in _RULES.items())}
      FROM f GROUP BY source),
r AS (SELECT source, {', '.join(f'{_rate_sql(k)} AS rate_{k}, avg(f_{k} / n) OVER () AS mean_{k}' for k in _RULES)} FROM h)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
         AND NOT ({' OR '.join(f'rate_{k} > least({host_rules.LIMITS[1]}, greatest({host_rules.LIMITS[0]}, {host_rules.MULTIPLE} * mean_{k}))' for k in _RULES)}) AS kept
FROM f JOIN r ON f.source IS NOT DISTINCT FROM r.source
"""


@query("op9_host_rules", OP9_SQL)
def quality_host_rules(t):
    return host_rules.judge(t.documents.select("doc_id", "text", "source"), carry=["doc_id"]).select(
        "doc_id", *host_rules.FEATURES, "base_failed", "kept")


WORD_TOKENIZER, PIECE_MODEL = "word_bpe_49k.json", "piece_bpe_32k.model"


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op4_token_output")
def token_output(t):
    folder = run_folder(t.spark, "tokens")
    tokens.write_tokens(t.documents, folder, tokenizer(WORD_TOKENIZER))
    return tokens.checksums(tokens.read_tokens(t.spark, folder))


@query("op6_toxicity")
def toxicity_scores(t):
    model = toxicity.train(t.documents, t.labels)
    scored = toxicity.score(t.documents.select("doc_id", "text"), model)
    return scored.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted", "n_hits")


OP5_SQL = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT doc_id, i, md5(substr(h, 2 * i + 1, 400)) AS k
      FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2 - 199)) AS i FROM d)),
rep AS (SELECT doc_id, i FROM w WHERE k IN (SELECT k FROM w GROUP BY k HAVING count(*) > 1)),
g AS (SELECT doc_id, i, CASE WHEN i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) <= 200 THEN 0 ELSE 1 END AS fresh FROM rep),
r AS (SELECT doc_id, i, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM g),
s AS (SELECT doc_id, run, min(i) AS a, max(i) + 200 AS b FROM r GROUP BY doc_id, run),
p AS (SELECT s.doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY s.doc_id ORDER BY a), 0) AS before FROM s),
k AS (SELECT p.doc_id, count(*) AS n_spans, sum(b - a) AS n_removed, max(b) AS last_b,
             string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS head
      FROM p JOIN d ON d.doc_id = p.doc_id GROUP BY p.doc_id)
SELECT d.doc_id, len(h) // 2 AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(head || substr(h, 2 * last_b + 1), h))) AS kept_sha256
FROM d LEFT JOIN k ON k.doc_id = d.doc_id
"""


@query("op5_suffix_array_dedup", OP5_SQL)
def suffix_array_dedup(t):
    cut = substrings.repeated_strings(t.documents.select("doc_id", "text"), width=200, hashed=True)
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.col("kept").alias("kept_sha256"))


@query("op1_minhash_near_dedup")
def minhash_near_dedup(t):
    return near_dup.classify(t.documents.select("doc_id", "text")).select("doc_id", "class_id", "class_size", "kept")


@query("op10_lm_scoring")
def lm_scoring(t):
    return recurrent_lm.score(t.documents.select("doc_id", "text"))


@query("op3_benchmark_decontamination")
def benchmark_decontamination(t):
    return decontam.leaked_items(t.documents.select("doc_id", "text"), t.benchmark).select(
        "doc_id", "contaminated", "items")


@query("op8_sentencepiece")
def sentencepiece(t):
    coded = pieces.encode_decode(t.documents.select("doc_id", "text"), tokenizer(PIECE_MODEL), digest=True)
    return coded.select("doc_id", "n_pieces", F.col("ids").alias("ids_crc32"),
                        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


@query("op11_embedding_whitening")
def embedding_whitening(t):
    return whitening.whiten(t.embeddings).withColumnRenamed("id", "vec_id")


@query("op12_token_counts")
def token_counting(t):
    return token_counts.count_tokens(t.documents.select("doc_id", "text"), tokenizer(PIECE_MODEL))


def _op13_sql(k: int = 16, rounds: int = 3, size: int = 64) -> str:
    parts = [f"""v AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda c: CAST(floor(64 * CAST(c AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings WHERE len(embedding) = {size} AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
c0 AS (
  SELECT row_number() OVER (ORDER BY h, x) - 1 AS cluster, x AS c
  FROM (SELECT sha256('1:' || coalesce(CAST(vec_id AS VARCHAR), '')) AS h, x FROM v ORDER BY h, x LIMIT {k}))"""]
    for i in range(rounds + 1):
        parts.append(f"""a{i} AS (
  SELECT r, arg_min(cluster, (d, cluster)) AS cluster, min(d) AS distance FROM (
    SELECT r, cluster, CAST(list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS d
    FROM v CROSS JOIN c{i}) GROUP BY r)""")
        if i < rounds:
            parts.append(f"""s{i} AS (
  SELECT cluster, i, sum(xi) AS s, count(*) AS n FROM (
    SELECT a{i}.cluster, unnest(x) AS xi, unnest(range({size})) AS i FROM v JOIN a{i} USING (r)) GROUP BY cluster, i),
m{i} AS (SELECT cluster, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS c FROM s{i} GROUP BY cluster),
c{i + 1} AS (SELECT cluster, coalesce(m{i}.c, c{i}.c) AS c FROM c{i} LEFT JOIN m{i} USING (cluster))""")
    return "WITH " + ",\n".join(parts) + f"""
SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, distance, CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
       CAST(sum(distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{rounds} JOIN v USING (r) JOIN c{rounds} USING (cluster)
"""


OP13_SQL = _op13_sql()


@query("op13_centroid_clustering", OP13_SQL)
def centroid_clustering(t):
    found = zone_clusters.cluster(t.embeddings)
    return found.select(F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia",
                        F.sha2(F.array_join(F.col("centroid").cast("array<string>"), ",").cast("binary"), 256).alias("centroid_sha256"))
