"""Queries over whole tables, one per operator, and their SQL where SQL can express them."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bibweave.llm.ans import read_tokens, write_tokens
from bibweave.llm.classlm import score_texts
from bibweave.llm.collocations import phrases
from bibweave.llm.decontaminate import contaminated
from bibweave.llm.exact import exact_duplicates
from bibweave.llm.html_extract import extract_text
from bibweave.llm.licenses import scan_licenses
from bibweave.llm.lines import drop_boilerplate
from bibweave.llm.minhash import near_duplicates
from bibweave.llm.negatives import hard_negatives
from bibweave.llm.packing import pack_documents
from bibweave.llm.quality import held_out, score_quality
from bibweave.llm.sentences import remove_passages
from bibweave.plans.scratch import at_end, shared_dir

#: Share of a score from which a document is predicted to be of quality.
ACCEPT = 0.3


def tokenizer_path() -> str:
    """The vocabulary file of the queries on tokens."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"), words=2, threshold=0.8)


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(_table(spark, sf_dir, "documents"))


def op3_exact_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(_table(spark, sf_dir, "documents"))


def op4_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_passages(_table(spark, sf_dir, "documents"), only_changed=True)


def op5_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = extract_text(_table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op6_packed_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(_table(spark, sf_dir, "documents"), tokenizer_path())


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_dir(spark)}/tokens-{uuid.uuid4().hex}"
    at_end(spark, path)
    write_tokens(_table(spark, sf_dir, "documents"), path, tokenizer_path())
    return read_tokens(spark, path, with_ids=False)


def op8_contaminated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op9_quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = score_quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= ACCEPT).cast("int").alias("predicted"))


def op10_site_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_boilerplate(_table(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_dropped", "text")


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases(_table(spark, sf_dir, "documents"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(vectors.withColumn("label", moved), F.col("vec_id") % 100 == 0)


def op13_class_model_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(_table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_SQL = {
    "op1_near_duplicates": rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x20\x09-\x0D]+') AS ws FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) >= 2 THEN list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]) ELSE ws END) AS g FROM w
), n AS (
  SELECT w.doc_id, count(s.g) AS n FROM w LEFT JOIN s ON s.doc_id = w.doc_id GROUP BY w.doc_id
), p AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2
), e AS (
  SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 80 * (nx.n + ny.n - c)
), both_ways AS (
  SELECT x, y FROM e UNION ALL SELECT y, x FROM e
), reach AS (
  SELECT doc_id, doc_id AS root FROM n
  UNION
  SELECT b.y, r.root FROM reach r JOIN both_ways b ON b.x = r.doc_id WHERE r.root < b.y
)
SELECT n.doc_id, n.n AS n_shingles, min(r.root) AS component_id, n.doc_id = min(r.root) AS kept
FROM n JOIN reach r ON r.doc_id = n.doc_id GROUP BY n.doc_id, n.n
""",
    "op3_exact_duplicates": r"""
WITH t AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents
)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = min(doc_id) OVER w AS kept, text_sha256
FROM t WINDOW w AS (PARTITION BY text_sha256)
""",
    "op10_site_lines": r"""
WITH p AS (
  SELECT row_number() OVER () AS r, doc_id, source, text, string_split(text, chr(10)) AS ls FROM documents
), l AS (
  SELECT r, source, i, ls[i] AS line, regexp_replace(ls[i], '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g') AS bare
  FROM (SELECT r, source, ls, unnest(range(1, len(ls) + 1)) AS i FROM p)
), c AS (
  SELECT l.source, bare FROM l JOIN (SELECT source, count(*) AS n FROM p GROUP BY source) t ON t.source IS NOT DISTINCT FROM l.source
  WHERE bare <> '' GROUP BY l.source, bare, t.n HAVING count(DISTINCT r) >= 2 AND count(DISTINCT r) > 0.05 * t.n
), k AS (
  SELECT l.r, l.i, l.line, c.bare IS NOT NULL AS dull FROM l LEFT JOIN c ON c.source IS NOT DISTINCT FROM l.source AND c.bare = l.bare
), g AS (
  SELECT r, count(*) AS n, count(*) FILTER (WHERE dull) AS d, string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT dull) AS rest FROM k GROUP BY r
)
SELECT p.doc_id, coalesce(g.n, 0) AS n_lines, coalesce(g.d, 0) AS n_dropped, CASE WHEN p.text IS NULL THEN NULL ELSE coalesce(g.rest, '') END AS text
FROM p LEFT JOIN g ON g.r = p.r
""",
    "op11_phrases": rf"""
WITH p AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws
  FROM (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)
), g AS (
  SELECT lang, s, array_to_string(ws[i:i + s - 1], ' ') AS phrase
  FROM (SELECT lang, s, ws, unnest(range(1, len(ws) - s + 2)) AS i FROM p, (SELECT unnest([1, 2, 3, 4]) AS s) WHERE len(ws) >= s)
), f AS (
  SELECT lang, s, phrase, count(*) AS a FROM g GROUP BY ALL HAVING count(*) >= 30
), t AS (
  SELECT lang, sum(len(ws))::BIGINT AS n FROM p GROUP BY lang
), c AS (
  SELECT lang, s, phrase, a, string_split(phrase, ' ') AS ws, unnest(range(1, s)) AS k FROM f WHERE s > 1
), b AS (
  SELECT c.lang, c.s, c.phrase, c.a, c.k, x.a AS l, y.a AS r, (2000000 * c.a::HUGEINT // (x.a + y.a))::BIGINT AS score
  FROM c JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.ws[1:c.k], ' ') JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.ws[c.k + 1:], ' ')
  QUALIFY row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY score, c.k) = 1
), h AS (
  SELECT lang, array_to_string(ws[i:i + z - 1], ' ') AS phrase, max(a) AS held
  FROM (SELECT lang, s, a, ws, z, unnest(range(1, s - z + 2)) AS i FROM (SELECT lang, s, a, string_split(phrase, ' ') AS ws, unnest(range(2, s)) AS z FROM f WHERE s > 2)) GROUP BY ALL
), k AS (
  SELECT b.* FROM b LEFT JOIN h ON h.lang = b.lang AND h.phrase = b.phrase WHERE h.held IS NULL OR 100 * h.held < 80 * b.a
)
SELECT k.lang, row_number() OVER (PARTITION BY k.lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, t.n, score
FROM k JOIN t ON t.lang = k.lang QUALIFY rank <= 2000
""",
    "op12_hard_negatives": r"""
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_dot_product(a.v, b.v)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), p AS (
  SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, p.vec_id AS positive_id, row_number() OVER w::INT AS rank, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 80 * p.score <= 100 * s.score AND s.score <= p.score
WINDOW w AS (PARTITION BY p.anchor_id, p.vec_id ORDER BY s.score DESC, s.vec_id) QUALIFY row_number() OVER w <= 5
""",
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        op1_near_duplicates, op2_license_scan, op3_exact_duplicates, op4_repeated_passages, op5_main_text, op6_packed_sequences,
        op7_token_files, op8_contaminated, op9_quality_scores, op10_site_lines, op11_phrases, op12_hard_negatives, op13_class_model_scores, pipeline,
    )
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
