"""The pipeline's stages: whole documents in, whole documents out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import bpe, exact_dedup, language_id, mixing, simhash
from .common import amid, columns, fresh, written


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents for which no language can be told: null text or not one letter."""
    shared = spark.sparkContext.broadcast(language_id.learn(docs))

    def told(text: str | None) -> bool:
        profiles = shared.value
        # with nothing to learn from, letters alone decide
        return profiles.predict(text or "")[0] != language_id.UNKNOWN if profiles.names else bool(language_id.words_of(text or ""))

    # rows stay in the JVM, and texts leave it a hundred at a time instead of by Arrow batches of up to 64 MB
    return docs.where(F.udf(told, "boolean", useArrow=False)(F.col("text").cast("string")))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the row of the smallest doc_id of each group of equal texts; of rows that repeat an id and a text, the least by all columns."""
    key, mark, of, keep, nth = fresh(docs, "key", "mark", "of", "keep", "nth")
    owners = written(exact_dedup.owners(docs), "owners").select(F.struct("n_len", "text_sha256").alias(of), F.col("keep_id").alias(keep))
    body = F.regexp_replace(F.coalesce(F.col("text"), F.lit("")), r"[\x20\x09-\x0D]+", " ")
    keyed = docs.withColumn(key, F.struct(F.octet_length(body).cast("long").alias("n_len"), F.sha2(body, 256).alias("text_sha256")))
    keyed = keyed.withColumn(mark, F.xxhash64(key))
    # rows that surely have no copy aren't shuffled to meet the owners
    marks = owners.select(F.xxhash64(of).alias(mark))
    joined = amid(keyed, mark, marks, mark).join(owners, F.col(key) == F.col(of), "left")
    kept = joined.where(F.col(of).isNull() | F.col("doc_id").eqNullSafe(F.col(keep)))
    kept = amid(keyed, mark, marks, mark, "left_anti").select(*columns(docs), key).union(kept.select(*columns(docs), key))
    again = docs.groupBy("doc_id").count().where("count > 1")
    if not again.isEmpty():
        order = Window.partitionBy("doc_id", key).orderBy(F.to_json(F.struct(*columns(docs))))
        kept = kept.withColumn(nth, F.row_number().over(order)).where(F.col(nth) == 1)
    return kept.select(*columns(docs))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the row of the smallest doc_id of each group of texts alike in 0.8 of their five-word shingles; rows with a null id stay."""
    node, of, low = fresh(docs, "node", "of", "low")
    keyed = docs.withColumn(node, F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))))
    groups = simhash.near_copies(docs).select(F.col("node").alias(of), F.col("component_id").alias(low))
    gone = (F.col(node) == F.col(of)) & (F.col("doc_id") != F.col(low))
    # rows that surely are in no group aren't shuffled to meet the groups
    kept = amid(keyed, node, groups, of).join(groups, gone, "left_anti")
    return amid(keyed, node, groups, of, "left_anti").select(*columns(docs)).union(kept.select(*columns(docs)))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats documents as the weights say, at a budget that uses each at least once."""
    plan, stops = mixing.planned(written(mixing.sized(docs), "sized"), budget="cover")
    mix, nth = fresh(docs, "mix", "nth")
    out = mixing.with_copies(docs, plan, stops, name=mix)
    return out.withColumn(nth, F.explode(F.sequence(F.lit(1), F.greatest(F.col(mix)["copies"], F.lit(1)).cast("int")))).select(*columns(docs))


def encode_bytes(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every use of a document."""
    return bpe.production(docs)


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("mix_sources", mix_sources),
    ("byte_bpe", encode_bytes),
]
