"""Registered queries over trees of files: the supplied tables are written by the sinks and read back by the sources.

Documents stand for answers to a fetch: 1,000 to a shard, 20 shards to a task, every thirteenth one failed.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import partition
from ..sources import listing, shards, sinks, stats, tar, urllist
from ..sources.shared import new_tree
from ..streaming import monitor
from .catalog import ORACLES, QUERIES, query
from .fixtures import frame

__all__ = ["ORACLES", "QUERIES"]

ALL = 2**31 - 1
_PLACE = "printf('task-%06d', doc_id // 20000) AS task, printf('%05d', doc_id % 20000 // 1000) AS shard"
_FAILED = "(text IS NULL OR doc_id % 13 = 5)"


def _tree(spark: SparkSession, d: str) -> str:
    failed = F.col("text").isNull() | (F.col("doc_id") % 13 == 5)
    docs = spark.read.parquet(f"{d}/documents.parquet").where("doc_id IS NOT NULL")
    rows = docs.select(
        F.expr("doc_id div 20000").alias("task"), F.expr("doc_id % 20000 div 1000").alias("shard"), F.lpad(F.col("doc_id").cast("string"), 12, "0").alias("key"),
        F.when(failed, "failed_to_download").otherwise("success").alias("status"),
        F.when(failed, F.when(F.col("doc_id") % 2 == 0, "HTTP Error 404: Not Found").otherwise("<urlopen error timed out>")).alias("error_message"),
        F.when(~failed, F.sha2("text", 256)).alias("sha256"), F.when(~failed, F.encode("text", "UTF-8")).alias("payload"),
    )
    root = str(new_tree(spark, "tree"))
    shards.write_shards(rows, root)
    return root


@query(f"SELECT {_PLACE}, doc_id, octet_length(encode(text)) AS n_bytes, sha256(text) AS sha256, sha256(text) AS declared FROM documents WHERE NOT {_FAILED}")
def shard_samples(spark: SparkSession, d: str) -> DataFrame:
    """What the shard sink stored, as the tar reader pairs it."""
    got = tar.read_samples(spark, _tree(spark, d))
    return got.select("task", "shard", F.col("key").cast("long").alias("doc_id"), F.length("image").cast("long").alias("n_bytes"), F.sha2("image", 256).alias("sha256"), F.get_json_object("meta", "$.sha256").alias("declared"))


@query(f"""SELECT task, shard, (CAST(sum(CASE WHEN f THEN 0 ELSE 512 + (n + 511) // 512 * 512 + 1024 END) AS BIGINT) + 1024 + 10239) // 10240 * 10240 AS bytes, CAST(sum(CASE WHEN f THEN 0 ELSE 1 END) AS BIGINT) AS successes
 FROM (SELECT {_PLACE}, {_FAILED} AS f, octet_length(encode(text)) AS n FROM documents) s GROUP BY task, shard""")
def shard_tar_sizes(spark: SparkSession, d: str) -> DataFrame:
    """Sizes of all tars from file metadata, joined to their statistics by stem (A18, J3): a header and whole blocks for each
    member, a sidecar of one block, an end mark, records of 20 blocks."""
    return stats.measured_shards(spark, _tree(spark, d), ALL, ALL)


@query(f"""SELECT task, shard, count(*) AS count, CAST(sum(CASE WHEN f THEN 0 ELSE 1 END) AS BIGINT) AS successes, CAST(sum(CASE WHEN f AND doc_id % 2 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS missing, count(*) AS rows
 FROM (SELECT doc_id, {_PLACE}, {_FAILED} AS f FROM documents) s GROUP BY task, shard""")
def shard_reports(spark: SparkSession, d: str) -> DataFrame:
    """Each shard's statistics (A8) beside the rows that its parquet file's footer tells."""
    root = _tree(spark, d)
    part = lambda k: F.regexp_extract("path", r"/(task-\d+)/shards/(\d+)\.parquet$", k)
    told = listing.row_counts(spark, root).select(part(1).alias("task"), part(2).alias("shard"), "rows")
    said = stats.read_stats(spark, root).select("task", "shard", "count", "successes", F.coalesce(F.try_element_at("status_dict", F.lit("HTTP Error 404: Not Found")), F.lit(0)).cast("long").alias("missing"))
    return said.join(told, ["task", "shard"])


@query(f"""SELECT CASE WHEN NOT {_FAILED} THEN 'success' WHEN doc_id % 2 = 0 THEN 'permanent' ELSE 'transient' END AS bucket, count(*) AS n FROM documents GROUP BY ALL""")
def streamed_outcomes(spark: SparkSession, d: str) -> DataFrame:
    """Outcomes of a tree by a stream that ends when it has read what is there; one row a bucket is kept."""
    name = f"outcomes_{new_tree(spark, 'x').name[2:]}"
    totals = monitor.outcome_stream(spark, _tree(spark, d)).writeStream.outputMode("complete").format("memory").queryName(name)
    totals.option("checkpointLocation", str(new_tree(spark, "progress"))).trigger(availableNow=True).start().awaitTermination()
    return spark.table(name)


@query("SELECT row_number() OVER (ORDER BY page_id) AS pos, url FROM pages")
def url_list_positions(spark: SparkSession, d: str) -> DataFrame:
    """A list with a header and tabs, in as many files as Spark writes, read back by line numbers (A6, C8, C9); line 0 is the header."""
    pages = spark.read.parquet(f"{d}/pages.parquet").select("page_id", F.concat_ws("\t", F.col("page_id").cast("string"), "url").alias("line"))
    head = spark.createDataFrame([(-1, "page_id\turl")], "page_id long, line string")
    path = str(new_tree(spark, "list"))
    head.union(pages).repartitionByRange("page_id").sortWithinPartitions("page_id").select("line").write.text(path)
    return urllist.read_urls(spark, path)


@query("""SELECT (r - 1) // k AS slice, (r - 1) % k AS pos, url FROM (SELECT row_number() OVER (ORDER BY page_id) AS r, url, (SELECT count(*) FROM pages) // 4 AS k FROM pages) p WHERE r <= 4 * k""")
def text_slices(spark: SparkSession, d: str) -> DataFrame:
    """Four disjoint slices of all URLs as text, read back in the order in which they were cut."""
    urls = frame(spark, d, "urls").select(F.col("pos"), "url")
    total = urls.count()
    folder = str(new_tree(spark, "slices"))
    sinks.write_slices(partition.slices(urls, total, 0, total // 4, 4), folder, "url", text=True, order="pos")
    back = [urllist.read_urls(spark, f"{folder}/slice={k}", has_header=False).select(F.lit(k).cast("long").alias("slice"), "pos", "url") for k in range(4)]
    return reduce(DataFrame.unionByName, back)


@query('SELECT task AS task_id, CAST(sum("end" - start) OVER (PARTITION BY task) AS BIGINT) AS rows, row_number() OVER (PARTITION BY task ORDER BY seq) - 1 AS seq, path, start, "end" FROM [cut] c')
def plan_file(spark: SparkSession, d: str) -> DataFrame:
    """The partition plan as plan.json, read back (B5, A13); a row for each piece of a file."""
    cut = partition.pieces(frame(spark, d, "sources").withColumn("path", F.concat(F.lit("/meta/"), "path")), 700)
    path = str(new_tree(spark, "plan") / "plan.json")
    sinks.write_json(stats.plan_json(spark, cut, "/meta", 700), path)
    return stats.read_plan(spark, path)
