"""Registered queries of the operators: production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hearth.llm import languages, licences, lines, merges, mixing, neighbours, phrases, pieces, quality, runs, sharding, simhash, substrings

SHINGLE, MAX_BITS = 3, 2
SHARDS = [f"shard-{i:03d}" for i in range(64)]
MODEL = "piece_bpe_32k.model"
RANKS = "byte_bpe_multi_50k.tiktoken"


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    found = neighbours.nearest(vectors, F.col("vec_id") % 20 == 0)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.judge(_documents(spark, sf_dir))
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return found.select(F.col("id").alias("doc_id"), *base, "base_failed", "quality", "kept")


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_documents(spark, sf_dir), "doc_id", "text", SHINGLE, MAX_BITS)
    return found.select(
        F.col("id").alias("doc_id"),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.place(_documents(spark, sf_dir), ["doc_id"], SHARDS)


def op5_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    fold = F.crc32(F.col("doc_id").cast("string")) % 5  # null ids: not learned from, not held out
    model = languages.learn(docs.where(fold != 0))
    return languages.label(docs, model, keep={"held_out": F.coalesce(fold == 0, F.lit(False))}).select(
        F.col("id").alias("doc_id"), "held_out", "lang_pred", "score", F.size("spans").alias("n_spans")
    )


def op6_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    found = licences.scan(docs, licences.train(docs))
    return found.select(F.col("id").alias("doc_id"), "paragraph", "family", F.round("probability", 6).alias("probability"), F.round("similarity", 6).alias("similarity"), "confirmed")


def op7_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.remove_repeats(_documents(spark, sf_dir))
    return found.select(F.col("id").alias("doc_id"), "n_words", "n_removed", F.sha2(F.col("kept"), 256).alias("kept_sha256"))


def op8_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    model = public_tokenizers.path(MODEL)
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    rows = pieces.decode(pieces.encode(docs, model).select("doc_id", "ids"), model)
    return rows.select("doc_id", *piece_digests())


def piece_digests() -> list[Column]:
    return [
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    ]


def op9_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lines.fuzzy_lines(_documents(spark, sf_dir))
    return found.select(F.col("id").alias("doc_id"), "text_hash", "line", "group", "kept")


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    taken = mixing.Mix(_documents(spark, sf_dir)).taken()
    return taken.select(F.col("id").alias("doc_id"), "source", "size", "source_size", "target", "taken")


def op11_byte_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ranks = public_tokenizers.path(RANKS)
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    rows = merges.decode(merges.encode(docs, ranks, packed=True).select("doc_id", "ids"), ranks)
    return rows.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2(F.col("ids"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.mine(_documents(spark, sf_dir))


def op13_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).select("doc_id", runs.with_repeats("doc_id", "text").alias("text"))
    # greatest length / period first, compared exactly; ties: smallest start, then period
    order = "CASE WHEN a.length * b.period != b.length * a.period THEN sign(b.length * a.period - a.length * b.period) WHEN a.start != b.start THEN sign(a.start - b.start) ELSE sign(a.period - b.period) END"
    best = F.get(F.expr(f"array_sort(runs, (a, b) -> int({order}))"), 0)
    line = lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    found = runs.find_runs(docs).withColumn("best", best)
    return found.select(
        F.col("id").alias("doc_id"),
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_neighbours": op1_neighbours,
    "op2_quality": op2_quality,
    "op3_simhash": op3_simhash,
    "op4_sharding": op4_sharding,
    "op5_languages": op5_languages,
    "op6_licences": op6_licences,
    "op7_substrings": op7_substrings,
    "op8_pieces": op8_pieces,
    "op9_lines": op9_lines,
    "op10_mixing": op10_mixing,
    "op11_byte_pairs": op11_byte_pairs,
    "op12_phrases": op12_phrases,
    "op13_runs": op13_runs,
}

_PHRASES_SQL = r"""
WITH pieces AS (
  SELECT lang, row_number() OVER () AS piece, words FROM (
    SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(unnest(regexp_split_to_array(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS words
    FROM documents)
  WHERE len(words) > 0
), spread AS (
  SELECT lang, piece, unnest(words) AS w1, unnest(range(len(words))) AS i FROM pieces
), grams AS (
  SELECT lang, w1, lead(w1) OVER p AS w2, lead(w1, 2) OVER p AS w3 FROM spread WINDOW p AS (PARTITION BY piece ORDER BY i)
), counts AS (
  SELECT lang, 1 AS size, w1 AS phrase, count(*) AS c FROM grams GROUP BY ALL HAVING c >= 10
  UNION ALL SELECT lang, 2, w1 || ' ' || w2, count(*) AS c FROM grams WHERE w2 IS NOT NULL GROUP BY ALL HAVING c >= 10
  UNION ALL SELECT lang, 3, w1 || ' ' || w2 || ' ' || w3, count(*) AS c FROM grams WHERE w3 IS NOT NULL GROUP BY ALL HAVING c >= 10
), candidates AS (
  SELECT lang, size, phrase, c AS a, string_split(phrase, ' ') AS words FROM counts WHERE size > 1
), cuts AS (
  SELECT lang, phrase, a, k, array_to_string(words[1:k], ' ') AS first, array_to_string(words[k + 1:size], ' ') AS rest
  FROM candidates, (VALUES (1), (2)) v(k) WHERE k < size
), scored AS (
  SELECT t.lang, t.phrase, t.a, t.k, f.c AS l, r.c AS r, (1000000 * t.a::HUGEINT * t.a) // (f.c::HUGEINT * r.c) AS score
  FROM cuts t JOIN counts f ON f.lang = t.lang AND f.phrase = t.first JOIN counts r ON r.lang = t.lang AND r.phrase = t.rest
), best AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), longer AS (
  SELECT lang, phrase, max(a) AS a FROM (
    SELECT lang, array_to_string(words[1:2], ' ') AS phrase, a FROM candidates WHERE size = 3
    UNION ALL SELECT lang, array_to_string(words[2:3], ' '), a FROM candidates WHERE size = 3)
  GROUP BY ALL
), ranked AS (
  SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY b.score DESC, b.a DESC, encode(b.phrase)) AS rank
  FROM best b LEFT JOIN longer o ON o.lang = b.lang AND o.phrase = b.phrase
  WHERE o.a IS NULL OR 100 * o.a < 50 * b.a
)
SELECT k.lang, k.rank, k.phrase, k.a, k.l, k.r, t.n, k.score::BIGINT AS score
FROM ranked k JOIN (SELECT lang, count(*) AS n FROM spread GROUP BY lang) t ON t.lang = k.lang
WHERE k.rank <= 2000
"""

_SUBSTRINGS_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), starts AS (
  SELECT r, words, unnest(range(len(words) - 34)) AS i FROM docs WHERE len(words) >= 35
), windows AS (
  SELECT r, i, array_to_string(words[i + 1:i + 35], ' ') AS w FROM starts
), repeated AS (
  SELECT r, i FROM windows QUALIFY count(*) OVER (PARTITION BY w) > 1
), gone AS (
  SELECT DISTINCT r, unnest(range(i, i + 35)) AS i FROM repeated
), each AS (
  SELECT r, unnest(words) AS word, unnest(range(len(words))) AS i FROM docs
), kept AS (
  SELECT e.r, string_agg(e.word, ' ' ORDER BY e.i) AS kept FROM each e ANTI JOIN gone g ON g.r = e.r AND g.i = e.i GROUP BY e.r
), counts AS (
  SELECT r, count(*) AS n_removed FROM gone GROUP BY r
)
SELECT d.doc_id, len(d.words)::BIGINT AS n_words, coalesce(c.n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(k.kept, '')) AS kept_sha256
FROM docs d LEFT JOIN kept k ON k.r = d.r LEFT JOIN counts c ON c.r = d.r
"""

# DuckDB text of the queries that SQL can express.
ORACLE: dict[str, str] = {"op7_substrings": _SUBSTRINGS_SQL, "op12_phrases": _PHRASES_SQL}
