"""The registered queries of this subpackage, each over its whole table, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from harborline.llm import (
    bpe, fingerprints, huffman, language_model, near_duplicates, packing, piece_model, pii, quality_rules, sharding, spelling,
    toxicity, word_runs,
)
from harborline.llm.common import SPACES, documents, scratch_path, stage_packed, whole_text
from harborline.llm.tokens import WORD_VOCABULARY, tokenize


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.cut(documents(spark, sf_dir))
    placed = packing.place(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))
    return placed.select(
        "doc_id", "start", F.col("length").cast("bigint").alias("length"), "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = bpe.round_trip(documents(spark, sf_dir))
    return both.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    sharded = sharding.shard(documents(spark, sf_dir), shards=8)
    return sharded.select(
        "doc_id", sharding.text_size().alias("size"), F.crc32(whole_text()).alias("text_crc32"),
        F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fingerprints.edited_fingerprints(documents(spark, sf_dir))
    own, edited, after = F.col("sketch"), F.col("edited_sketch"), F.col("next_sketch")
    return rows.select(
        "doc_id", F.col("n_chars").cast("bigint").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        fingerprints.fingerprint(own).alias("fingerprint"), fingerprints.fingerprint(edited).alias("edited_fingerprint"),
        fingerprints.likeness(own, edited).alias("near_edited"), fingerprints.likeness(own, after).alias("near_next"),
    )


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.classes(documents(spark, sf_dir)).drop("h1", "h2")


def op6_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    return language_model.scores(documents(spark, sf_dir), number % 7 == 2)


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = stage_packed(tokenize(documents(spark, sf_dir), WORD_VOCABULARY, end_id=1), "ids")
    path = scratch_path(spark, "token-files")
    huffman.write_ids(tokens, path)
    return huffman.read_ids(spark, path).select(
        "doc_id", "start", F.col("n_ids").alias("n_tokens"), F.crc32("ids").alias("ids_crc32")
    )


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured = quality_rules.measure(documents(spark, sf_dir).select("doc_id", "text"))
    m = F.col(quality_rules.MEASURES)
    base = (m["n_words"] < 50) | (100 * m["n_repeat_words"] > 50 * m["n_words"])
    return measured.select(
        "doc_id", *[m[n].alias(n) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        base.alias("base_failed"), (~base & quality_rules.verdict(m)).alias("kept"),
    )


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.spans(documents(spark, sf_dir), pii.session_key(spark)).withColumn("n_found", F.size("found").cast("bigint"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score(docs, model).select(
        "doc_id", (toxicity.id_check() % 3 == 1).alias("held_out"), "score",
        F.when(F.col("score") >= toxicity.THRESHOLD, 1).otherwise(0).alias("predicted"),
    )


def op11_piece_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = piece_model.round_trip(documents(spark, sf_dir))
    return both.select(
        "doc_id", F.floor(F.octet_length("ids") / 4).alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def planted_period(docs: DataFrame) -> DataFrame:
    """doc_id and text, of which one in ten by the checksum of doc_id repeats a stretch of its words to the end."""
    check = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    seed, n = F.floor(check / 10), F.size("words")
    # Repeated rows keep their number: nothing here joins or groups.
    words = F.regexp_extract_all(whole_text(), F.lit(f"({SPACES.replace('[', '[^')}+)"), F.lit(1))
    chosen = docs.select("doc_id", whole_text().alias("text"), (check % 10 == 0).alias("chosen"), seed.alias("seed"),
                         F.when(check % 10 == 0, words).otherwise(F.array().cast("array<string>")).alias("words"))
    placed = chosen.withColumn("a", F.when(n > 0, F.col("seed") % n).cast("int")).withColumn(
        "p", (1 + F.floor((n - F.col("a")) / (3 + F.col("seed") % 8))).cast("int")
    )
    a, p = F.col("a"), F.col("p")
    again = F.transform(F.sequence(a, n - 1), lambda i: F.get("words", a + (i - a) % p))
    text = F.array_join(F.concat(F.slice("words", 1, a), again), " ")
    return placed.select("doc_id", F.when(F.col("chosen") & (n > 0), text).otherwise(F.col("text")).alias("text"))


def op12_word_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = word_runs.repetitions(planted_period(documents(spark, sf_dir)))
    best, each = F.col("strongest"), F.transform("runs", lambda r: F.concat_ws(",", r.start, r.length, r.period))
    return found.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), "strongest.start", "strongest.length", "strongest.period",
        F.floor(1000 * best.length / best.period).alias("exponent_milli"),
        F.sha2(F.concat(F.array_join(each, "\n"), F.when(F.size("runs") > 0, "\n").otherwise("")), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spelling.count_words(documents(spark, sf_dir), spelling.damaged))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": op1_packing,
    "op2_bpe": op2_bpe,
    "op3_sharding": op3_sharding,
    "op4_fingerprints": op4_fingerprints,
    "op5_near_duplicates": op5_near_duplicates,
    "op6_language_model": op6_language_model,
    "op7_quality_rules": op7_quality_rules,
    "op8_token_files": op8_token_files,
    "op9_pii": op9_pii,
    "op10_toxicity": op10_toxicity,
    "op11_piece_model": op11_piece_model,
    "op12_word_runs": op12_word_runs,
    "op13_spelling": op13_spelling,
}


def _quoted(words) -> str:
    return ", ".join(f"'{w}'" for w in words)


def _op7_sql() -> str:
    tests = []
    for rule in quality_rules.RULES:
        if rule.least is not None:
            tests.append(f"{rule.measure} >= {rule.least}")
        if rule.most is not None:
            tests.append(f"{rule.measure} <= {rule.most}")
    return rf"""
WITH cut AS (
  SELECT doc_id, row_number() OVER () AS row_no, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
windows AS (
  SELECT row_no, i, count(*) OVER (PARTITION BY row_no, words[i], words[i + 1], words[i + 2]) AS times
  FROM (SELECT row_no, words, unnest(range(1, len(words) - 1)) AS i FROM cut)),
covered AS (
  SELECT row_no, count(DISTINCT i + k) AS n_repeat_words
  FROM windows, (VALUES (0), (1), (2)) AS step(k) WHERE times > 1 GROUP BY row_no),
counted AS (
  SELECT doc_id, len(words)::BIGINT AS n_words,
         coalesce(list_sum(list_transform(words, lambda w: length(w))), 0)::BIGINT AS word_chars,
         len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
         len(list_filter(words, lambda w: lower(w) IN ({_quoted(quality_rules.STOP_WORDS)}))) AS n_stop_words,
         len(lines) AS n_lines
  FROM cut LEFT JOIN covered USING (row_no)),
rated AS (
  SELECT *, coalesce(word_chars / nullif(n_words, 0), 0) AS mean_word_chars,
         coalesce(n_symbols / nullif(n_words, 0), 0) AS symbol_ratio,
         coalesce(n_repeat_words / nullif(n_words, 0), 0) AS repeat_ratio,
         coalesce(n_stop_words / nullif(n_words, 0), 0) AS stop_ratio,
         coalesce(n_dup_lines / nullif(n_lines, 0), 0) AS dup_line_ratio,
         n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed
  FROM counted)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND {" AND ".join(tests)} AS kept
FROM rated"""


ORACLE_SQL: dict[str, str] = {"op7_quality_rules": _op7_sql()}
