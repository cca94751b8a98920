"""From documents to tokens: language ID, exact dedup, near-dedup, source mixing, byte-level BPE."""

from pyspark.sql import DataFrame, SparkSession

from shardwright.llm.common import documents, dropped, written
from shardwright.llm.stages import STAGES

#: SQL can't express the stages (profiles, tries, fingerprints, merges); tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        read, docs = docs, written(stage(spark, docs, sf_dir), name)
        dropped(read)  # nothing reads a stage's input once its output is written
    return STAGES[-1][1](spark, docs, sf_dir)
