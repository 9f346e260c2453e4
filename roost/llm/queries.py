"""The operators applied to whole tables, and their SQL twins where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roost.llm import (
    bpe,
    chat,
    jaccard,
    langid,
    mixing,
    outliers,
    passages,
    periodic,
    pii,
    ranked,
    sql,
    toxicity,
    vectors,
    warc,
)

# Sources weigh the same in the mix; their sizes are counted in characters, of the text where no number is given.
MIX = mixing.MixParams(size="coalesce(n_chars, length(text))")
CONTROL_CHAT = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify_languages(table(spark, sf_dir, "documents"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outliers.quality_rules(table(spark, sf_dir, "documents"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_numbered(table(spark, sf_dir, "documents"), MIX)


def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    values = ", ".join(f"({c}L, {t}L, {r!r}, {x!r})" for c, t, r, x in CONTROL_CHAT)
    control = spark.sql(f"SELECT * FROM VALUES {values} AS t(conv_id, turn, role, text)")
    return chat.chat_digests(rows.unionByName(control))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), toxicity.CATEGORIES, toxicity.ToxicityParams())
    return toxicity.score_documents(docs, model)


def op6_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(table(spark, sf_dir, "embeddings"))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_digests(table(spark, sf_dir, "documents"))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op9_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_documents(table(spark, sf_dir, "documents"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_round_trip(spark, table(spark, sf_dir, "pages"))


def with_periods(docs: DataFrame) -> DataFrame:
    """(doc_id, text): of the documents whose hash ends in 0, the words from some place on repeat with a period."""
    words = F.filter(F.split(F.col("text").cast("string"), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    split = docs.select("doc_id", "text", F.crc32(F.col("doc_id").cast("string")).alias("h"), words.alias("words"))
    placed = split.selectExpr("*", "size(words) AS n", "h div 10 AS g").selectExpr("*", "int(g % nullif(n, 0)) AS a")
    timed = placed.selectExpr("*", "int(1 + (n - a) div (3 + g % 8)) AS p")
    cycle = "slice(flatten(array_repeat(slice(words, a + 1, p), int(ceil((n - a) / p)))), 1, n - a)"
    changed = F.expr(f"array_join(concat(slice(words, 1, a), {cycle}), ' ')")
    return timed.select("doc_id", F.when(F.expr("h % 10 = 0 AND n > 0"), changed).otherwise(F.col("text")).alias("text"))


def op11_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.run_digests(with_periods(table(spark, sf_dir, "documents")))


def op12_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.passage_digests(table(spark, sf_dir, "documents"))


OPERATORS = (
    op1_language_id,
    op2_quality,
    op3_mixing,
    op4_chat,
    op5_toxicity,
    op6_vectors,
    op7_pii,
    op8_bpe,
    op9_jaccard,
    op10_warc,
    op11_runs,
    op12_ranked,
    op13_passages,
)
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in OPERATORS}

SQL: dict[str, str] = {
    "op3_mixing": sql.mixing_sql(MIX.seed, MIX.scale),
    "op4_chat": sql.chat_sql(),
    "op6_vectors": sql.VECTORS,
    "op9_jaccard": sql.JACCARD,
    "op10_warc": sql.WARC,
    "op11_runs": sql.RUNS,
    "op12_ranked": sql.RANKED,
    "op13_passages": sql.PASSAGES,
}
