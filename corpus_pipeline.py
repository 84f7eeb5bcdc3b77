"""The corpus pipeline: five stages over documents, each on all that its predecessor kept.

Defined results, for every stage: null ids and repeated ids are rows like others; null and
empty texts are kept (they are neither toxic nor copies nor contaminated); texts of any
length are taken whole; further columns, of any name, pass through all stages but the last;
an empty table gives an empty table. ``n_chars`` follows the redacted text where it exists.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeforge.llm import byte_bpe, decontamination, ngram_join, secrets_scan, toxicity
from lakeforge.llm.common import bloom, discard, fresh_path, materialize, table, unused, with_hit

#: Near duplicates: five-word shingles, a similarity of 0.8 or more.
WORDS, PERCENT = 5, 80


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't call toxic; ones without words have the prior's score."""
    model = toxicity.trained(spark, docs, sf_dir)
    score = unused(docs.columns, "toxic_score")
    return toxicity.score(docs, F.col("text"), model, docs.columns, score).where(F.col(score) < toxicity.THRESHOLD).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies one row, that with the smallest id (a null id comes last); rows with no words stay.

    Rows are found again by a hash of id and text. Only those that a Bloom filter takes for
    members of groups are joined, so most texts aren't moved. Of rows equal in id and text
    any one stands for all.
    """
    found = ngram_join.link_rows(docs, WORDS, PERCENT)
    best = found.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")).alias("x"), F.count("*").alias("c")).where("c > 1").select("component", F.col("x.key").alias("stays"))
    verdict = materialize(found.join(best, "component").groupBy("h").agg(F.max(F.col("key") == F.col("stays")).alias("stays")), "verdict")
    h, hit, stays = (unused(docs.columns, name) for name in ("row_hash", "row_hit", "row_stays"))
    hashed = with_hit(docs.withColumn(h, F.xxhash64("doc_id", "text")), h, bloom(verdict.select("h")), hit)
    looked = hashed.where(F.col(hit)).join(verdict.select(F.col("h").alias(h), F.col("stays").alias(stays)), h, "left")
    kept = looked.where(F.col(stays).isNull()).select(*docs.columns).unionByName(looked.where(stays).dropDuplicates([h]).select(*docs.columns))
    return hashed.where(~F.col(hit)).select(*docs.columns).unionByName(kept)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    matches = unused(docs.columns, "matches")
    found = decontamination.find_items(docs, "text", table(spark, sf_dir, "benchmark"), docs.columns, matches)
    return found.where(F.size(matches) == 0).select(*docs.columns)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced in their texts; ``n_chars``, if there is one, follows the text."""
    clean = secrets_scan.redact(docs, "text")
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return clean.select(*docs.columns)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id`` with counts and digests of ids and decoded bytes, and the ids."""
    coded = byte_bpe.encode_decode(docs, F.col("text"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, ["doc_id"])
    return byte_bpe.with_digests(coded).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "token_ids")


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secret_scan", redact_secrets),
    ("byte_bpe", tokenize),
]

#: No SQL: the classifier and the tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. Each stage's rows are written and read again; what it read is deleted then."""
    docs, written = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = fresh_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        docs.written_to = path
        if written is not None:
            discard(written)
        written = docs
    return docs
