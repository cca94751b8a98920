"""Views over the supplied tables that stand for the pipeline's own data, as SQL that Spark and DuckDB both run.

`{div}` is integer division's spelling in either engine.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

ATTEMPTS = """SELECT event_id AS pos, event_id {div} 50 AS shard, event_id {div} 250 AS task, value,
 CASE WHEN (event_id {div} 250) % 4 = 3 THEN CASE WHEN k % 2 = 0 THEN '<urlopen error [Errno -2] Name or service not known>' ELSE '<urlopen error [Errno 101] Network is unreachable>' END
 WHEN event_type IN ('view', 'click', 'purchase') THEN 'success'
 WHEN k % 12 = 0 THEN '<urlopen error [Errno -2] Name or service not known>' WHEN k % 12 = 1 THEN '<urlopen error [Errno -3] Temporary failure in name resolution>'
 WHEN k % 12 = 2 THEN '<urlopen error [Errno 101] Network is unreachable>' WHEN k % 12 = 3 THEN '<urlopen error [Errno 113] No route to host>'
 WHEN k % 12 = 4 THEN 'HTTP Error 404: Not Found' WHEN k % 12 = 5 THEN 'HTTP Error 403: Forbidden' WHEN k % 12 = 6 THEN 'HTTP Error 429: Too Many Requests'
 WHEN k % 12 = 7 THEN 'HTTP Error 408: Request Timeout' WHEN k % 12 = 8 THEN 'HTTP Error 503: Service Unavailable' WHEN k % 12 = 9 THEN '<urlopen error timed out>'
 WHEN k % 12 = 10 THEN 'HTTP Error 302: Found' ELSE 'Image decoding error' END AS message
 FROM (SELECT event_id, event_type, value, CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k FROM events) e"""
SIZES = "SELECT CAST(l_quantity AS BIGINT) * (l_partkey % 40) AS w, 37 * (l_suppkey % 30) AS h FROM lineitem"
ARRIVED = """SELECT CASE l_returnflag WHEN 'R' THEN 'failed_to_download' WHEN 'A' THEN 'success' END AS status, w AS ow, h AS oh,
 CASE WHEN l_linestatus = 'F' AND l_linenumber = 7 THEN 256 ELSE w END AS w, h FROM (SELECT l_returnflag, l_linestatus, l_linenumber, CAST(l_quantity AS BIGINT) * (l_partkey % 40) AS w, 37 * (l_suppkey % 30) AS h FROM lineitem) s"""
SHARD_BYTES = "SELECT l_suppkey AS task, l_linenumber AS shard, CAST(sum(CAST(floor(l_extendedprice) AS BIGINT)) AS BIGINT) AS bytes, CAST(sum(CASE WHEN l_returnflag <> 'R' THEN 1 ELSE 0 END) AS BIGINT) AS successes FROM lineitem GROUP BY l_suppkey, l_linenumber"
URLS = "SELECT page_id AS pos, url FROM pages"
SOURCES = "SELECT 'region' AS path, count(*) AS rows FROM region UNION ALL SELECT 'nation', count(*) FROM nation UNION ALL SELECT 'supplier', count(*) FROM supplier UNION ALL SELECT 'part', count(*) FROM part UNION ALL SELECT 'customer', count(*) FROM customer"
FILES_ROWS = """SELECT 'nation' AS path, CAST(n_nationkey AS BIGINT) AS row_index, n_name AS url FROM nation UNION ALL SELECT 'region', CAST(r_regionkey AS BIGINT), r_name FROM region
 UNION ALL SELECT 'supplier', row_number() OVER (ORDER BY s_suppkey) - 1, s_name FROM supplier UNION ALL SELECT 'part', row_number() OVER (ORDER BY p_partkey) - 1, p_name FROM part"""
FILES = "SELECT path, count(*) AS rows FROM ({files_rows}) f GROUP BY path"
MARKERS = "SELECT o_custkey AS task_id, count(*) AS candidates FROM orders WHERE o_custkey % 11 <> 5 GROUP BY o_custkey"
PLAN = "SELECT o_custkey AS task_id, count(*) + CASE WHEN o_custkey % 3 = 0 THEN 1 ELSE 0 END AS rows FROM orders GROUP BY o_custkey"
ARMS = """SELECT CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS task, CASE WHEN CAST(substr(o_orderpriority, 1, 1) AS BIGINT) % 2 = 1 THEN 32 ELSE 128 END AS threads,
 CASE WHEN CAST(substr(o_orderpriority, 1, 1) AS BIGINT) < 3 THEN 2 ELSE 0 END AS retries, count(*) AS candidates, CAST(sum(CASE WHEN o_orderstatus <> 'P' THEN 1 ELSE 0 END) AS BIGINT) AS successes,
 CAST(sum(o_orderkey % (3 + CAST(substr(o_orderpriority, 1, 1) AS BIGINT))) AS BIGINT) AS wall_seconds FROM orders GROUP BY o_orderpriority"""
CAPTIONS = "SELECT doc_id % 4 AS task, doc_id AS key, text AS caption FROM documents"
SAMPLES = "SELECT d.doc_id % 4 AS task, d.doc_id AS key, CASE WHEN d.doc_id % 97 = 0 THEN concat('x', d.text) ELSE d.text END AS caption FROM documents d JOIN labels l ON d.doc_id = l.doc_id"
EVERY_SAMPLE = "SELECT doc_id % 4 AS task, doc_id AS key, CASE WHEN doc_id % 97 = 0 THEN concat('x', text) ELSE text END AS caption FROM documents"
STATS_JSON = """SELECT task, shard, CASE WHEN shard % 9 = 4 THEN 'not json' WHEN shard % 9 = 5 THEN concat('{{"count":', n, ',"successes":', s, ',"failed_to_download":', n - s, ',"status_dict":{{"success":', s, '}}}}')
 WHEN shard % 9 = 6 THEN concat('{{"count":', n, ',"successes":', s, ',"failed_to_download":', n, ',"failed_to_resize":1,"status_dict":{{"success":', s, '}}}}')
 WHEN shard % 9 = 7 THEN concat('{{"count":', n, ',"successes":', s, ',"failed_to_download":0,"failed_to_resize":0,"status_dict":{{"success":', s + 1, '}}}}')
 WHEN shard % 9 = 8 THEN concat('{{"count":', n, ',"successes":', s, ',"failed_to_download":0,"failed_to_resize":0,"status_dict":null}}')
 ELSE concat('{{"count":', n, ',"successes":', s, ',"failed_to_download":', n - s, ',"failed_to_resize":0,"status_dict":{{"success":', s, '}}}}') END AS raw
 FROM (SELECT task, shard, count(*) AS n, sum(CASE WHEN message = 'success' THEN 1 ELSE 0 END) AS s FROM ({attempts}) a GROUP BY task, shard) g"""
MEMBERS = """SELECT shard, key, suffix, seq, CASE WHEN suffix = '.jpg' THEN text WHEN shard % 7 = 1 THEN 'not json' WHEN shard % 5 = 2 THEN '{{"sha256":"0"}}' WHEN shard % 5 = 3 THEN '{{}}' ELSE concat('{{"sha256":"', {sha}, '"}}') END AS body
 FROM (SELECT conv_id AS shard, CAST(turn {div} 2 AS STRING) AS key, CASE WHEN role = 'user' THEN '.jpg' ELSE '.json' END AS suffix, turn AS seq, text, max(CASE WHEN role = 'user' THEN text END) OVER (PARTITION BY conv_id, turn {div} 2) AS image FROM conversations) c"""

_WORDS = {"spark": {"div": "div", "sha": "sha2(coalesce(image, ''), 256)"}, "duckdb": {"div": "//", "sha": "sha256(coalesce(image, ''))"}}
_BASE = {"attempts": ATTEMPTS, "files_rows": FILES_ROWS}


def sql(view: str, engine: str) -> str:
    """A view's text for "spark" or "duckdb"."""
    if not view.isidentifier():
        raise ValueError(view)
    words = _WORDS[engine]
    return globals()[view.upper()].format(**words, **{k: v.format(**words) for k, v in _BASE.items()})


def frame(spark: SparkSession, sf_dir: str, view: str) -> DataFrame:
    """The view over a directory's tables; only the tables it names are opened."""
    text = sql(view, "spark")
    for table in set(re.findall(r"(?:FROM|JOIN) (\w+)", text)):
        text = re.sub(rf"\b(FROM|JOIN) {table}\b", rf"\1 parquet.`{sf_dir}/{table}.parquet`", text)
    return spark.sql(text)
