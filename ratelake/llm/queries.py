"""Queries of this subpackage over the given tables, and their check SQL where SQL can say it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from ratelake.llm.common import read, remainder

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return add


BYTE_BPE = "byte_bpe_multi_50k.tiktoken"
WORD_BPE = "word_bpe_49k.json"
TOKEN_LIMIT = 2048


@query("op2_byte_bpe")
def byte_bpe(spark, sf_dir):
    from ratelake.llm.bpe import round_trip_digest

    docs = read(spark, sf_dir, "documents")
    return round_trip_digest(docs, public_tokenizers.path(BYTE_BPE), public_tokenizers.PATTERN)


CONTROL_TEXT = r"\### Assistant: </turn> ok"
_ESC = r"regexp_replace({0}, '([\\<#])', '\\\1', 'g')"


@query("op5_chat_format", rf"""WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, t, r, '\### Assistant: </turn> ok' FROM (VALUES (0, 'user'), (1, 'assistant')) v(t, r))
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length({_ESC.format('text')}) + length(role) + 14) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id""")
def chat_format(spark, sf_dir):
    from ratelake.llm.chat import digest, format_chat, text_part

    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    own = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(CONTROL_TEXT).alias("text"),
    )
    parts = rows.unionByName(own).withColumn("parts", text_part(F.col("text")))
    return digest(format_chat(parts))


@query("op6_token_counts")
def token_counts(spark, sf_dir):
    from ratelake.llm import tokens

    return tokens.token_counts(read(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE), TOKEN_LIMIT)


@query("op10_nearest_neighbours")
def nearest_neighbours(spark, sf_dir):
    from ratelake.llm.ann import nearest

    return nearest(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5)


def training_labels(spark, sf_dir):
    """Labels whose rows may be learned from: crc32(doc_id as text) mod 4 is not 2."""
    return read(spark, sf_dir, "labels").filter(remainder(F.col("doc_id"), 4) != 2).select("doc_id", "quality")


@query("op7_quality")
def quality_scores(spark, sf_dir):
    from ratelake.llm import quality

    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality.score(docs, training_labels(spark, sf_dir))
    held = F.coalesce(remainder(F.col("doc_id"), 4) == 2, F.lit(False))
    return scored.select("doc_id", held.alias("held_out"), "score", quality.predicted(F.col("score")).alias("predicted"))


@query("op3_decontamination")
def decontamination(spark, sf_dir):
    from ratelake.llm.decontaminate import contaminated

    return contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query("op1_ngram_jaccard", f"""WITH RECURSIVE
split AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
sets AS MATERIALIZED (SELECT r, doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
  ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM split),
items AS MATERIALIZED (SELECT r, len(s) AS n, unnest(s) AS g FROM sets),
links AS MATERIALIZED (SELECT a.r AS x, b.r AS y FROM items a JOIN items b ON a.g = b.g AND a.r <> b.r
  GROUP BY a.r, b.r, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
reached AS (SELECT x, y FROM links UNION SELECT c.x, l.y FROM reached c JOIN links l ON c.y = l.x),
least_of AS (SELECT x, min(doc_id) AS least FROM reached JOIN sets ON r = y GROUP BY x)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, least(doc_id, coalesce(least, doc_id)) AS component_id
FROM sets LEFT JOIN least_of ON x = r""")
def ngram_jaccard(spark, sf_dir):
    from ratelake.llm.jaccard import near_duplicates

    return near_duplicates(read(spark, sf_dir, "documents"))


@query("op4_repeats", """WITH
bytes AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
strings AS MATERIALIZED (SELECT r, doc_id, i, md5_number(substr(h, 2 * i + 1, 100)) AS s
  FROM bytes, LATERAL (SELECT unnest(range(greatest(0, len(h) // 2 - 49))) AS i)),
starts AS (SELECT r, i FROM strings JOIN (SELECT s, min(doc_id) AS least FROM strings GROUP BY s) USING (s) WHERE least < doc_id),
runs AS (SELECT r, i, sum(gap) OVER (PARTITION BY r ORDER BY i) AS run FROM (
  SELECT r, i, CASE WHEN i - lag(i) OVER (PARTITION BY r ORDER BY i) <= 50 THEN 0 ELSE 1 END AS gap FROM starts)),
spans AS (SELECT r, min(i) AS a, max(i) + 50 AS b FROM runs GROUP BY r, run),
pieces AS (SELECT r, a, b, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS before FROM spans),
kept AS (SELECT r, sum(b - a) AS n_removed, count(*) AS n_spans, max(b) AS last,
  string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS k FROM pieces JOIN bytes USING (r) GROUP BY r)
SELECT doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
  sha256(unhex(coalesce(k, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM bytes LEFT JOIN kept USING (r)""")
def repeats(spark, sf_dir):
    from ratelake.llm.repeats import remove_repeats

    return remove_repeats(read(spark, sf_dir, "documents"), "digest")


@query("op8_lm_scores")
def lm_scores(spark, sf_dir):
    from ratelake.llm.lm import score

    return score(read(spark, sf_dir, "documents"))


@query("op9_main_text")
def main_text(spark, sf_dir):
    from ratelake.llm.html import extract

    return extract(read(spark, sf_dir, "pages").select("page_id", "url", "html"))


@query("op11_pii")
def personal_data(spark, sf_dir):
    from ratelake.llm import pii

    return pii.digest(pii.find(read(spark, sf_dir, "documents")))


def _rounds_sql(k: int = 16, rounds: int = 3, dim: int = 64) -> str:
    """The rounds of op12 spelled out: an assignment and its centroids per round."""
    floor_div = "(s - ((s % n) + n) % n) // n"
    steps = [f"""q AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id,
    list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE len(embedding) = {dim}
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dim}),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('1:' || CAST(vec_id AS VARCHAR))) - 1 AS c, v
  FROM q ORDER BY 1 LIMIT {k})"""]
    for i in range(rounds + 1):
        steps.append(f"""a{i} AS MATERIALIZED (
  SELECT r, arg_min(c, d * {k} + c) AS c, min(d) AS d FROM (
    SELECT q.r, c0.c, list_sum(list_transform(list_zip(q.v, c0.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS d
    FROM q, c{i} AS c0) GROUP BY r)""")
        if i < rounds:
            steps.append(f"""m{i} AS (
  SELECT c, list(m ORDER BY j) AS v FROM (
    SELECT c, j, {floor_div} AS m FROM (
      SELECT c, j, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM (
        SELECT a.c, unnest(q.v) AS x, generate_subscripts(q.v, 1) AS j FROM q JOIN a{i} AS a USING (r)) GROUP BY c, j))
  GROUP BY c),
c{i + 1} AS MATERIALIZED (SELECT c, coalesce(m{i}.v, c{i}.v) AS v FROM c{i} LEFT JOIN m{i} USING (c))""")
    return f"""WITH {', '.join(steps)}
SELECT vec_id, CAST(a.c AS INTEGER) AS cluster, a.d AS distance,
  CAST(sum(a.d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia, CAST(sum(a.d) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(z.v, ',')) AS centroid_sha256
FROM q JOIN a{rounds} AS a USING (r) JOIN c{rounds} AS z ON z.c = a.c"""


@query("op12_centroids", _rounds_sql())
def centroid_clusters(spark, sf_dir):
    from ratelake.llm.centroids import cluster

    return cluster(read(spark, sf_dir, "embeddings"))


@query("op13_hard_negatives", """WITH good AS MATERIALIZED (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
scored AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
    CAST(list_sum(list_transform(list_zip(a.v, b.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM good AS a JOIN good AS b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.positive_id, s.vec_id AS negative_id, positive_score, s.score AS negative_score,
  CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank
FROM positives AS p JOIN scored AS s ON p.anchor_id = s.anchor_id AND NOT s.same
  AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score
QUALIFY rank <= 10""")
def hard_negatives(spark, sf_dir):
    from ratelake.llm import negatives

    vec_id, label = F.col("vec_id"), F.col("label")
    shifted = F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label)
    return negatives.hard_negatives(read(spark, sf_dir, "embeddings"), vec_id % 100 == 0, shifted)
