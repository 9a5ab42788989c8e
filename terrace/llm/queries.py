"""One query per operator, over its whole table. ``(spark, sf_dir) -> DataFrame``.

``ORACLE`` has SQL for the queries that SQL can express; the others are models or heuristics
and are tested against brute force, round trips or held-out rows (tests/llm).
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.llm import (
    class_lm,
    collocations,
    inner_product,
    line_rules,
    mixing,
    near_duplicates,
    personal,
    quality_model,
    token_rows,
    toxicity,
    vector_packing,
    warc,
    whitening,
)
from terrace.llm.tables import remainder, ship_package, table
from terrace.session import scratch_path

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return function(spark, sf_dir)

    QUERIES[function.__name__] = run
    return run


def other_than(divisor: int, value: int) -> Callable[[Column], Column]:
    """Rows to learn from: crc32 of the id's text modulo ``divisor`` is not ``value``."""
    return lambda doc_id: F.crc32(doc_id.cast("string").cast("binary")) % divisor != value


def labelled(scores: DataFrame, divisor: int, value: int) -> DataFrame:
    return scores.select("doc_id", (remainder("doc_id", divisor) == value).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query
def op1_personal_data(spark, sf_dir):
    found = personal.find_personal_data(table(spark, sf_dir, "documents").select("doc_id", "text"))
    count = lambda kind: F.size(F.filter("base_spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    digest = F.sha2(personal.shown(F.col("base_spans")), 256).alias("base_sha256")
    return found.select("doc_id", *[count(k) for k in personal.KINDS], digest, personal.shown(F.col("all_spans")).alias("spans"))


@query
def op2_vector_packing(spark, sf_dir):
    return vector_packing.pack_documents(table(spark, sf_dir, "documents"), TOKENIZER)


@query
def op3_mixing(spark, sf_dir):
    mixed = mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source"), whole=True)
    return mixed.select(F.col("mixed_id").alias("doc_id"), "size", "source_size", "target", "taken", "draws")


@query
def op4_near_duplicates(spark, sf_dir):
    return near_duplicates.near_duplicates(table(spark, sf_dir, "documents"), shingle_words=3, percent=85)


@query
def op5_quality_trees(spark, sf_dir):
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality_model.train_quality(documents, labels, "quality", other_than(3, 1))
    return labelled(quality_model.quality_scores(documents, model), 3, 1)


@query
def op6_token_rows(spark, sf_dir):
    return token_rows.token_rows(table(spark, sf_dir, "documents"), TOKENIZER)


@query
def op7_inner_products(spark, sf_dir):
    return inner_product.top_products(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


@query
def op8_line_rules(spark, sf_dir):
    names = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "clean_text")
    return line_rules.quality_rules(table(spark, sf_dir, "documents")).select(*names)


@query
def op9_toxicity(spark, sf_dir):
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.train_toxicity(documents, labels, "toxic", other_than(5, 0))
    return labelled(toxicity.toxicity_scores(documents, model), 5, 0)


@query
def op10_class_lm(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    scores = class_lm.class_scores(documents, remainder("doc_id", 5) != 1)
    return scores.select("doc_id", (remainder("doc_id", 5) == 1).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query
def op11_whitening(spark, sf_dir):
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


@query
def op12_archives(spark, sf_dir):
    path = scratch_path(spark, "archives")
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    found = warc.records(warc.read_archives(spark, path, payloads=False))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op13_collocations(spark, sf_dir):
    return collocations.collocations(table(spark, sf_dir, "documents"))


ORACLE: dict[str, str] = {
    "op7_inner_products": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v, len(embedding) AS d
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_dot_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.d = c.d AND q.vec_id <> c.vec_id
  WHERE q.vec_id % 100 = 0
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 10
""",
    "op12_archives": """
WITH p AS (
  SELECT page_id, url, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages
), t AS (
  SELECT *, row_number() OVER (PARTITION BY html ORDER BY page_id DESC NULLS LAST, url DESC NULLS LAST) AS place,
         first_value(page_id) OVER (PARTITION BY html ORDER BY page_id DESC NULLS LAST, url DESC NULLS LAST) AS response
  FROM p
)
SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         CAST(((CAST('0x' || substr(h, CAST(5 * (i // 4) + 1 AS INTEGER), 5) AS INTEGER) >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31) + 1 AS INTEGER), 1)), '')
         AS payload_digest,
       CASE WHEN place = 1 THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN place > 1 THEN response END AS refers_to
FROM t
""",
    "op13_collocations": """
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents
), words AS (
  SELECT lang, list_filter(string_split_regex(piece, '[ \\t]+'), lambda w: w <> '') AS w FROM pieces
), totals AS (
  SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM words GROUP BY lang
), placed AS (
  SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM words
), grams AS (
  SELECT lang, k, array_to_string(w[i : i + k - 1], ' ') AS phrase, count(*) AS a
  FROM placed, (VALUES (1), (2), (3), (4), (5)) AS sizes(k)
  WHERE i + k - 1 <= len(w)
  GROUP BY ALL HAVING count(*) >= 100
), longer AS (
  SELECT lang, array_to_string(p, ' ') AS phrase, max(a) AS most
  FROM (SELECT lang, a, unnest([string_split(phrase, ' ')[1 : k - 1], string_split(phrase, ' ')[2 : k]]) AS p FROM grams WHERE k > 2)
  GROUP BY ALL
), held AS (
  SELECT g.* FROM grams g LEFT JOIN longer o ON g.lang = o.lang AND g.phrase = o.phrase
  WHERE g.k > 1 AND (o.most IS NULL OR o.most < g.a)
), cuts AS (
  SELECT *, array_to_string(string_split(phrase, ' ')[1 : c], ' ') AS first_part, array_to_string(string_split(phrase, ' ')[c + 1 : k], ' ') AS rest
  FROM (SELECT *, unnest(range(1, k)) AS c FROM held)
), told AS (
  SELECT c.lang, c.phrase, c.a, x.a AS l, y.a AS r, t.n, c.c,
         CAST((CAST(1000 AS HUGEINT) * c.a * t.n) // (CAST(x.a AS HUGEINT) * y.a) AS BIGINT) AS score
  FROM cuts c JOIN grams x ON x.lang = c.lang AND x.phrase = c.first_part
  JOIN grams y ON y.lang = c.lang AND y.phrase = c.rest JOIN totals t ON t.lang = c.lang
), lowest AS (
  SELECT * FROM told QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM lowest
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000
""",
}
