"""Registered queries over the fixture views, and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import thresholds as T
from ..functions import model
from ..functions.status import bucket
from ..functions.urls import pool_key
from ..operators import contract, distributions, outcomes, partition, planning, schema, verdicts
from ..sources import tar
from .fixtures import frame, sql

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
DUCK = lambda view: f"({sql(view, 'duckdb')})"


def query(oracle: str | None = None) -> Callable[[Query], Query]:
    """Registers a query under its name, with its SQL; `[view]` stands for a fixture view."""

    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if oracle:
            text = oracle
            while "[" in text and (name := text[text.index("[") + 1 : text.index("]")]).isidentifier():
                text = text.replace(f"[{name}]", _SQL[name] if name in _SQL else DUCK(name))
            ORACLES[f.__name__] = text.replace("⟦", "[").replace("⟧", "]")
        return f

    return register


def r6(c: str | Column, name: str | None = None) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 6).alias(name or c)


_CASE = """CASE WHEN message = 'success' THEN 'success' WHEN regexp_matches(message, '\\⟦Errno -⟦2345⟧\\⟧') THEN 'dns' WHEN regexp_matches(message, '\\⟦Errno (101|113)\\⟧') THEN 'unreachable'
 WHEN message LIKE '%HTTP Error 408%' OR message LIKE '%HTTP Error 425%' OR message LIKE '%HTTP Error 429%' OR regexp_matches(message, 'HTTP Error 5⟦0-9⟧{2}') THEN 'transient'
 WHEN regexp_matches(message, 'HTTP Error 4⟦0-9⟧{2}') THEN 'permanent' WHEN regexp_matches(message, 'HTTP Error ⟦0-9⟧{3}') THEN 'other' WHEN message LIKE '%timed out%' OR lower(message) LIKE '%timeout%' THEN 'transient' ELSE 'other' END"""
_count = lambda cond: f"CAST(sum(CASE WHEN {cond} THEN 1 ELSE 0 END) AS BIGINT)"
_COUNTS = ", ".join(f"{_count(f'b = {b!r}')} AS {b}" for b in outcomes.BUCKETS) + f", {_count('message LIKE ' + repr('HTTP Error 429%'))} AS rate_limited, count(*) AS total"
_SQL = {
    "counted": f"(SELECT task, {_COUNTS}, {_count(repr('success') + ' = b')} AS succeeded, CAST(sum(CAST(floor(value) AS BIGINT)) AS BIGINT) AS wall FROM (SELECT *, {_CASE} AS b FROM [attempts] a) c GROUP BY task)",
    "marked": f"(SELECT *, {_CASE} AS b FROM [attempts] a)",
}


def _messages(spark: SparkSession, d: str) -> DataFrame:
    return frame(spark, d, "attempts").withColumn("n", F.lit(1).cast("long"))


def _stats(spark: SparkSession, d: str) -> DataFrame:
    """Attempts as shard statistics with a map of messages."""
    per = frame(spark, d, "attempts").groupBy("task", "shard", "message").agg(F.count("*").alias("n"))
    return per.groupBy("task", "shard").agg(
        F.sum("n").cast("long").alias("count"), F.coalesce(F.sum(F.when(F.col("message") == "success", F.col("n"))), F.lit(0)).cast("long").alias("successes"),
        F.map_from_entries(F.collect_list(F.struct("message", "n"))).alias("status_dict"),
    )


def _summary(spark: SparkSession, d: str) -> DataFrame:
    stats = _stats(spark, d)
    return outcomes.with_rates(outcomes.run_summary(stats, outcomes.exploded(stats, "task"), "task"))


def _runs(spark: SparkSession, d: str) -> DataFrame:
    a = frame(spark, d, "attempts")
    counts = outcomes.failure_counts(a.withColumn("n", F.lit(1).cast("long")), "task")
    wall = a.groupBy("task").agg(F.sum(F.floor("value")).cast("long").alias("wall"))
    out = counts.join(wall, "task").select("*", F.col("total").alias("candidates"), F.col("succeeded").alias("successes"), F.col("task").alias("run"), F.element_at(F.array(F.lit(8), F.lit(32), F.lit(8)), (F.col("task") % 3 + 1).cast("int")).cast("long").alias("processes"), F.when(F.col("task") % 4 == 2, 2).otherwise(1).alias("nodes"))
    return outcomes.with_rates(out, "wall")


_RUNS = """(SELECT task AS run, CASE task % 3 WHEN 1 THEN 32 ELSE 8 END AS processes, CASE WHEN task % 4 = 2 THEN 2 ELSE 1 END AS nodes, CASE WHEN wall > 0 THEN succeeded * 1.0::DOUBLE / wall END AS sps, succeeded * 1.0::DOUBLE / total AS y, dns * 1.0::DOUBLE / total AS d FROM [counted] c)"""
_SQL["runs"] = _RUNS


@query("SELECT pos, b AS bucket FROM [marked] m")
def classify_status(spark: SparkSession, d: str) -> DataFrame:
    return frame(spark, d, "attempts").select("pos", bucket(F.col("message")).alias("bucket"))


@query("SELECT task, dns, unreachable, permanent, transient, other, rate_limited, total, succeeded FROM [counted] c")
def failure_mix(spark: SparkSession, d: str) -> DataFrame:
    return outcomes.failure_counts(_messages(spark, d), "task")


@query("SELECT message, n, first FROM (SELECT message, count(*) AS n, min(pos) AS first FROM [attempts] a GROUP BY message) m ORDER BY n DESC, first LIMIT 6")
def top_messages(spark: SparkSession, d: str) -> DataFrame:
    return outcomes.most_common(outcomes.merged_messages(_messages(spark, d)), 6)


@query("SELECT task, total AS candidates, succeeded AS successes, dns, unreachable, permanent, transient, other, rate_limited, total, round(succeeded * 1.0::DOUBLE / total, 6) AS yield_rate, round(dns * 1.0::DOUBLE / total, 6) AS dns_fraction, round(rate_limited * 1.0::DOUBLE / total, 6) AS rate_limited_fraction FROM [counted] c")
def run_summary(spark: SparkSession, d: str) -> DataFrame:
    out = _summary(spark, d)
    return out.select("task", "candidates", "successes", *outcomes.COUNTERS, r6("yield_rate"), r6("dns_fraction"), r6("rate_limited_fraction"))


@query("""SELECT task, candidates, round(y, 6) AS yield_rate, round(d, 6) AS dns_fraction, round(u, 6) AS unreachable_fraction, cause, cause IS NULL AS healthy FROM (SELECT *, CASE WHEN candidates <= 0 THEN 'nothing_attempted' WHEN u > 0.10 AND NOT y >= 0.50 THEN 'unreachable' WHEN d > 0.20 THEN 'dns' WHEN y < 0.30 THEN 'low_yield' END AS cause
 FROM (SELECT task, total AS candidates, succeeded * 1.0::DOUBLE / total AS y, dns * 1.0::DOUBLE / total AS d, unreachable * 1.0::DOUBLE / total AS u FROM [counted] c) r) h""")
def task_health(spark: SparkSession, d: str) -> DataFrame:
    return verdicts.health(_summary(spark, d)).select("task", "candidates", r6("yield_rate"), r6("dns_fraction"), r6("unreachable_fraction"), "cause", "healthy")


@query("SELECT task, shard, count(*) AS count, CAST(sum(CASE WHEN message = 'success' THEN 1 ELSE 0 END) AS BIGINT) AS successes, sum(CASE WHEN message = 'success' THEN 1 ELSE 0 END) * 1.0::DOUBLE / count(*) >= 0.05 AS keep FROM [attempts] a GROUP BY task, shard")
def retry_plan(spark: SparkSession, d: str) -> DataFrame:
    return contract.keepable(_stats(spark, d)).drop("status_dict")


_DIAG = "SELECT *, oc / pc AS cr FROM (SELECT task, f, 3500.0::DOUBLE / total AS oc, f * 30 + (1 - f) * 1.0::DOUBLE AS pc FROM (SELECT task, total, (total - succeeded) * 1.0::DOUBLE / total AS f FROM [counted] c) x) y"
_SQL["diagnosed"] = f"({_DIAG})"


def _diagnosis(spark: SparkSession, d: str) -> DataFrame:
    """Costs near what timeouts would give, so that they explain some tasks and others not."""
    return verdicts.throughput_diagnosis(_summary(spark, d), node_seconds=3500 / 1024, workers=1024)


@query("SELECT task, round(f, 6) AS failure_rate, round(oc, 6) AS observed_cost, round(pc, 6) AS predicted_cost, round(cr, 6) AS cost_ratio, cr BETWEEN 0.7 AND 1.4 AS explained FROM [diagnosed] g")
def throughput_diagnosis(spark: SparkSession, d: str) -> DataFrame:
    return _diagnosis(spark, d).select("task", r6("failure_rate"), r6("observed_cost"), r6("predicted_cost"), r6("cost_ratio"), "explained")


@query("SELECT task, o.t * 1.0::DOUBLE AS timeout, o.r AS retries, round(pc / (f * o.t * (o.r + 1) + (1 - f)), 6) AS gain FROM [diagnosed] g, (VALUES (3, 0), (5, 0), (5, 1), (10, 0)) o(t, r) WHERE cr BETWEEN 0.7 AND 1.4")
def throughput_alternatives(spark: SparkSession, d: str) -> DataFrame:
    return verdicts.alternatives(_diagnosis(spark, d)).select("task", "timeout", "retries", r6("gain"))


@query("""WITH r AS (SELECT * FROM [runs] x), b AS (SELECT * FROM r WHERE run = (SELECT min(run) FROM r)), l AS (SELECT r.*, b.processes AS bp, b.y AS by_, b.d AS bd FROM r, b WHERE r.run > b.run),
 s AS (SELECT sps FROM l WHERE processes <> bp ORDER BY run LIMIT 1), p AS (SELECT sps FROM l WHERE processes = bp ORDER BY run LIMIT 1),
 v AS (SELECT (SELECT sps FROM s) / nullif(b.sps, 0) >= 1.5 AS scales, coalesce((SELECT bool_and(by_ - y <= 0.05) FROM l), true) AS yield_preserved, coalesce((SELECT bool_and(d - bd <= 0.03) FROM l), true) AS dns_stable, abs((SELECT sps FROM p) - nullif(b.sps, 0)) / nullif(b.sps, 0) AS dr FROM b)
 SELECT scales, yield_preserved, dns_stable, round(dr, 6) AS baseline_drift, dr <= 0.20 AS baseline_stable, coalesce(NOT scales, false) OR NOT yield_preserved OR NOT dns_stable OR coalesce(NOT dr <= 0.20, false) AS rejected FROM v""")
def concurrency_verdict(spark: SparkSession, d: str) -> DataFrame:
    return verdicts.concurrency_verdict(_runs(spark, d)).select("scales", "yield_preserved", "dns_stable", r6("baseline_drift"), "baseline_stable", "rejected")


@query("""WITH r AS (SELECT * FROM [runs] x), m AS (SELECT * FROM r WHERE nodes > 1 ORDER BY run LIMIT 1), s AS (SELECT * FROM r WHERE nodes = 1),
 f AS (SELECT sps FROM s ORDER BY run LIMIT 1), z AS (SELECT sps FROM s ORDER BY run DESC LIMIT 1),
 v AS (SELECT (SELECT avg(sps) FROM s WHERE sps <> 0) AS sr, (SELECT sps FROM m) AS mr, (SELECT avg(y) FROM s) - (SELECT y FROM m) AS yd, (SELECT d FROM m) - (SELECT avg(d) FROM s) AS dd, abs((SELECT sps FROM z) - (SELECT sps FROM f)) / nullif((SELECT sps FROM f), 0) AS dr)
 SELECT mr >= 0.8 * sr AS distribution_neutral, coalesce(yd <= 0.05, true) AS yield_preserved, coalesce(dd <= 0.03, true) AS dns_stable, round(dr, 6) AS baseline_drift, round(sr, 6) AS single_node_rate, round(mr, 6) AS multi_node_rate, dr <= 0.20 AS baseline_stable,
 coalesce(NOT mr >= 0.8 * sr, false) OR NOT coalesce(yd <= 0.05, true) OR NOT coalesce(dd <= 0.03, true) OR coalesce(NOT dr <= 0.20, false) AS rejected FROM v""")
def distribution_verdict(spark: SparkSession, d: str) -> DataFrame:
    out = verdicts.distribution_verdict(_runs(spark, d))
    return out.select("distribution_neutral", "yield_preserved", "dns_stable", r6("baseline_drift"), r6("single_node_rate"), r6("multi_node_rate"), "baseline_stable", "rejected")


_SQL["cut"] = """(WITH o AS (SELECT path, rows, CAST(sum(rows) OVER (ORDER BY path) AS BIGINT) - rows AS off FROM [sources] s), e AS (SELECT *, unnest(generate_series(off // 700, (off + rows - 1) // 700)) AS task FROM o WHERE rows > 0)
 SELECT task, greatest(off, task * 700) - task * 700 AS seq, path, greatest(off, task * 700) - off AS start, least(off + rows, (task + 1) * 700) - off AS "end" FROM e)"""


@query("SELECT * FROM [cut] c")
def partition_pieces(spark: SparkSession, d: str) -> DataFrame:
    return partition.pieces(frame(spark, d, "sources"), 700)


@query("SELECT total_rows, (total_rows + 699) // 700 AS tasks, total_rows // 700 AS full_tasks, CASE WHEN total_rows = 0 THEN 0 WHEN total_rows % 700 = 0 THEN 700 ELSE total_rows % 700 END AS last_rows FROM (SELECT CAST(sum(rows) AS BIGINT) AS total_rows FROM [sources] s) t")
def partition_summary(spark: SparkSession, d: str) -> DataFrame:
    return partition.partition_summary(frame(spark, d, "sources"), 700)


_SQL["placed"] = "(SELECT f.path, f.row_index, f.url, o.off + f.row_index AS pos FROM [files_rows] f JOIN (SELECT path, rows, CAST(sum(rows) OVER (ORDER BY path) AS BIGINT) - rows AS off FROM [files] s) o USING (path))"


def _placed(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    rows = frame(spark, d, "files_rows")
    files = frame(spark, d, "files")
    return partition.positioned(rows, files), files


@query("SELECT path, row_index, url, pos, pos // 300 AS task FROM [placed] p")
def task_manifest(spark: SparkSession, d: str) -> DataFrame:
    return partition.manifest(_placed(spark, d)[0], 300)


@query("SELECT p.path, p.row_index, p.url, c.task, c.seq + p.row_index - c.start AS place FROM [placed] p JOIN (SELECT pos // 300 AS task, path, min(row_index) AS start, max(row_index) + 1 AS e, min(pos) - min(pos // 300) * 300 AS seq FROM [placed] q GROUP BY pos // 300, path) c ON p.path = c.path AND p.row_index >= c.start AND p.row_index < c.e")
def manifest_by_pieces(spark: SparkSession, d: str) -> DataFrame:
    rows, files = frame(spark, d, "files_rows"), frame(spark, d, "files")
    return partition.manifest_of(rows, partition.pieces(files, 300)).select("path", "row_index", "url", "task", "place")


@query("SELECT path, row_index, url, pos, (pos - 10) // 40 AS slice FROM [placed] p WHERE pos >= 10 AND pos < 130")
def disjoint_slices(spark: SparkSession, d: str) -> DataFrame:
    rows, files = _placed(spark, d)
    total = files.agg(F.sum("rows")).first()[0]
    return partition.slices(rows, total, 10, 40, 3)


@query("SELECT path, row_index, url, pos FROM [placed] p WHERE pos < 75")
def cap_rows(spark: SparkSession, d: str) -> DataFrame:
    return partition.capped(_placed(spark, d)[0], 75)


@query("SELECT p.path, p.row_index, p.url, p.pos FROM [placed] p JOIN (SELECT DISTINCT CAST(round_even(i * (t - 1) * 1.0::DOUBLE / 16, 0) AS BIGINT) AS pos FROM (SELECT count(*) AS t FROM [placed] q) n, generate_series(0, 16) g(i)) s USING (pos)")
def even_sample(spark: SparkSession, d: str) -> DataFrame:
    rows, files = _placed(spark, d)
    return distributions.evenly_sampled(rows, "pos", files.agg(F.sum("rows")).first()[0], 17)


_SQL["sides"] = "(SELECT least(w, h) AS s, w * 1.0::DOUBLE / h AS a FROM [sizes] z WHERE w > 0 AND h > 0)"


@query("SELECT p, round(v, 6) AS short_side FROM (SELECT unnest(⟦1, 5, 10, 25, 50, 75, 90, 99⟧)::BIGINT AS p, unnest(quantile_cont(s, ⟦0.01, 0.05, 0.1, 0.25, 0.5, 0.75, 0.9, 0.99⟧)) AS v FROM [sides] x) q")
def resolution_percentiles(spark: SparkSession, d: str) -> DataFrame:
    out = distributions.percentiles(distributions.sides(frame(spark, d, "sizes")), "short_side")
    return out.select("p", r6("short_side"))


@query("SELECT t AS threshold, CAST(sum(CASE WHEN s < t THEN 1 ELSE 0 END) AS BIGINT) AS below, round(sum(CASE WHEN s < t THEN 1 ELSE 0 END) * 1.0::DOUBLE / count(*), 6) AS fraction FROM [sides] x, (SELECT unnest(⟦32, 112, 224, 256, 512, 1024⟧)::BIGINT AS t) l GROUP BY t")
def resolution_thresholds(spark: SparkSession, d: str) -> DataFrame:
    return distributions.below(distributions.sides(frame(spark, d, "sizes"))).select("threshold", "below", r6("fraction"))


@query("SELECT lo AS low, hi AS high, round(sum(CASE WHEN a >= lo AND a <= hi THEN 1 ELSE 0 END) * 1.0::DOUBLE / count(*), 6) AS fraction FROM [sides] x, (VALUES (0.9::DOUBLE, 1.1::DOUBLE), (0.5::DOUBLE, 2.0::DOUBLE)) b(lo, hi) GROUP BY lo, hi")
def aspect_bands(spark: SparkSession, d: str) -> DataFrame:
    return distributions.within(distributions.aspects(frame(spark, d, "sizes")), ((0.9, 1.1), (0.5, 2.0))).select("low", "high", r6("fraction"))


@query("SELECT round(median(a), 6) AS median_aspect, round(median(s), 6) AS median_side, (SELECT count(*) FROM [sizes] z) - count(*) AS unusable, count(*) AS total FROM [sides] x")
def size_medians(spark: SparkSession, d: str) -> DataFrame:
    sizes = frame(spark, d, "sizes")
    medians = [distributions.quantiles(rows, c, [0.5])[0] for rows, c in ((distributions.aspects(sizes), "aspect"), (distributions.sides(sizes), "short_side"))]
    told = [F.round(F.lit(m).cast("double"), 6).alias(c) for m, c in zip(medians, ("median_aspect", "median_side"))]
    return distributions.unusable_count(sizes).select(*told, "unusable", "total")


@query("SELECT p, round(v, 6) AS aspect FROM (SELECT unnest(⟦1, 5, 10, 25, 50, 75, 90, 99⟧)::BIGINT AS p, unnest(quantile_cont(a, ⟦0.01, 0.05, 0.1, 0.25, 0.5, 0.75, 0.9, 0.99⟧)) AS v FROM [sides] x) q")
def aspect_percentiles(spark: SparkSession, d: str) -> DataFrame:
    return distributions.percentiles(distributions.aspects(frame(spark, d, "sizes")), "aspect").select("p", r6("aspect"))


@query("SELECT round(sum(CASE WHEN s < 32 THEN 1 ELSE 0 END) * 1.0::DOUBLE / count(*), 6) AS fraction, sum(CASE WHEN s < 32 THEN 1 ELSE 0 END) * 1.0::DOUBLE / count(*) > 0.01 AS noted FROM [sides] x")
def degenerate_sizes(spark: SparkSession, d: str) -> DataFrame:
    return distributions.degenerate(distributions.sides(frame(spark, d, "sizes"))).select(r6("fraction"), "noted")


_OK = "coalesce((status IS NULL OR status = 'success') AND ow <> 0 AND oh <> 0, false)"


@query(f"SELECT {_count(_OK)} AS succeeded, {_count('NOT ' + _OK)} AS failed, {_count(_OK + ' AND (w <> ow OR h <> oh)')} AS resized FROM [arrived] a")
def arrived_vs_claimed(spark: SparkSession, d: str) -> DataFrame:
    return distributions.arrived(frame(spark, d, "arrived"))


@query("""SELECT c.p, round(c.v, 6) AS claimed, round(a.v, 6) AS arrived, round(abs(a.v - c.v) / nullif(c.v, 0), 6) AS drift FROM (SELECT unnest(⟦1, 5, 10, 25, 50, 75, 90, 99⟧)::BIGINT AS p, unnest(quantile_cont(s, ⟦0.01, 0.05, 0.1, 0.25, 0.5, 0.75, 0.9, 0.99⟧)) AS v FROM [sides] x) c
 JOIN (SELECT unnest(⟦1, 5, 10, 25, 50, 75, 90, 99⟧)::BIGINT AS p, unnest(quantile_cont(least(w, h), ⟦0.01, 0.05, 0.1, 0.25, 0.5, 0.75, 0.9, 0.99⟧)) AS v FROM [arrived] z WHERE w > 0 AND h > 0 AND (status IS NULL OR status = 'success')) a USING (p)""")
def recorded_size_drift(spark: SparkSession, d: str) -> DataFrame:
    claimed = distributions.percentiles(distributions.sides(frame(spark, d, "sizes")), "short_side")
    came = distributions.percentiles(distributions.sides(frame(spark, d, "arrived").where("status IS NULL OR status = 'success'")), "short_side")
    return distributions.median_drift(claimed, came).select("p", r6("claimed"), r6("arrived"), r6("drift"))


_SQL["tasks"] = "(SELECT task, count(*) AS shards, CAST(sum(bytes) AS BIGINT) AS bytes, CAST(sum(successes) AS BIGINT) AS images, sum(bytes) * 1.0::DOUBLE / sum(successes) AS bpi, min(bytes * 1.0::DOUBLE / successes) AS lo, max(bytes * 1.0::DOUBLE / successes) AS hi FROM [shard_bytes] b WHERE successes > 0 GROUP BY task)"


@query("SELECT task, shards, bytes, images, round(lo, 6) AS smallest, round(hi, 6) AS largest, round(bpi, 6) AS bytes_per_image, round(hi / lo, 6) AS spread FROM [tasks] t")
def task_sizes(spark: SparkSession, d: str) -> DataFrame:
    out = distributions.task_sizes(frame(spark, d, "shard_bytes"))
    return out.select("task", "shards", "bytes", "images", *(r6(c) for c in ("smallest", "largest", "bytes_per_image", "spread")))


@query("SELECT count(*) AS tasks, (SELECT task FROM [tasks] t ORDER BY bpi, task LIMIT 1) AS smallest_task, (SELECT task FROM [tasks] t ORDER BY bpi DESC, task DESC LIMIT 1) AS largest_task, round(max(bpi) / min(bpi), 6) AS between_, round(max(hi / lo), 6) AS worst_within, max(bpi) / min(bpi) > max(hi / lo) AS between_dominates FROM [tasks] t")
def size_spread(spark: SparkSession, d: str) -> DataFrame:
    out = distributions.size_report(distributions.task_sizes(frame(spark, d, "shard_bytes")))
    return out.select("tasks", "smallest_task", "largest_task", r6("between", "between_"), r6("worst_within"), "between_dominates")


_SQL["keyed"] = """(SELECT pos, url, CASE WHEN sc <> '' AND host <> '' AND (port = '' OR (regexp_matches(port, '^⟦0-9⟧+$') AND CAST(port AS BIGINT) <= 65535)) THEN concat(sc, '://', host, CASE WHEN port = '' OR (sc = 'http' AND port = '80') OR (sc = 'https' AND port = '443') THEN '' ELSE concat(':', port) END) END AS key
 FROM (SELECT pos, url, sc, lower(regexp_extract(au, '^([^:]*)', 1)) AS host, regexp_extract(au, ':(.*)$', 1) AS port FROM (SELECT pos, url, lower(regexp_extract(url, '^([A-Za-z]⟦A-Za-z0-9+.-⟧*)://', 1)) AS sc, regexp_replace(regexp_extract(url, '^[A-Za-z]⟦A-Za-z0-9+.-⟧*://(⟦^/?#⟧*)', 1), '^.*@', '') AS au FROM [urls] u) p) q)""".replace("[A-Za-z]", "⟦A-Za-z⟧").replace("[^:]", "⟦^:⟧")


@query("SELECT pos, key AS pool_key FROM [keyed] k")
def pool_keys(spark: SparkSession, d: str) -> DataFrame:
    return frame(spark, d, "urls").select("pos", pool_key(F.col("url")).alias("pool_key"))


@query("""SELECT urls, c AS connections, bad AS unparseable, hosts, round(coalesce((urls - bad) * 1.0::DOUBLE / nullif(c, 0), 1.0), 6) AS reuse_factor, round(coalesce(1 - c * 1.0::DOUBLE / nullif(urls - bad, 0), 0.0), 6) AS saved_fraction, coalesce((urls - bad) * 1.0::DOUBLE / nullif(c, 0) >= 2.0, false) AS pool
 FROM (SELECT count(*) AS urls, count(*) - count(key) AS bad, count(DISTINCT key) AS hosts, (SELECT CAST(sum(n) AS BIGINT) FROM (SELECT count(DISTINCT key) AS n FROM [keyed] j GROUP BY pos // 50) w) AS c FROM [keyed] k) t""")
def host_concentration(spark: SparkSession, d: str) -> DataFrame:
    out = distributions.host_concentration(frame(spark, d, "urls"), 50)
    return out.select("urls", "connections", "unparseable", "hosts", r6("reuse_factor"), r6("saved_fraction"), "pool")


@query("SELECT key AS host, count(*) AS n, min(pos) AS first FROM [keyed] k WHERE key IS NOT NULL GROUP BY key ORDER BY n DESC, first LIMIT 10")
def top_hosts(spark: SparkSession, d: str) -> DataFrame:
    return distributions.top_hosts(frame(spark, d, "urls"), 10)


@query("""WITH k AS (SELECT shard, key, count(*) FILTER (suffix = '.jpg') AS i, count(*) FILTER (suffix = '.json' AND json_valid(body)) AS s, count(*) FILTER (suffix = '.json' AND NOT json_valid(body)) AS x,
  sha256(arg_max(body, seq) FILTER (suffix = '.jpg')) AS sha, json_extract_string(arg_max(body, seq) FILTER (suffix = '.json' AND json_valid(body)), '$.sha256') AS said FROM [members] m GROUP BY shard, key),
 p AS (SELECT shard, sum(i) AS n FROM k GROUP BY shard)
 SELECT shard, NULL AS key, 'empty shard' AS problem FROM p WHERE n = 0 UNION ALL SELECT shard, key, 'duplicate key' FROM k JOIN p USING (shard) WHERE n > 0 AND (i > 1 OR s > 1) UNION ALL SELECT shard, key, 'missing sidecar' FROM k JOIN p USING (shard) WHERE n > 0 AND i > 0 AND s = 0
 UNION ALL SELECT shard, key, 'sha256 mismatch' FROM k JOIN p USING (shard) WHERE n > 0 AND i > 0 AND s > 0 AND sha <> said UNION ALL SELECT shard, key, 'metadata without image' FROM k JOIN p USING (shard) WHERE n > 0 AND i = 0 AND s > 0 UNION ALL SELECT shard, key, 'invalid json' FROM k WHERE x > 0""")
def shard_contract(spark: SparkSession, d: str) -> DataFrame:
    m = frame(spark, d, "members").withColumn("payload", F.encode("body", "UTF-8"))
    return contract.shard_problems(m.select("shard").distinct().withColumn("has_tar", F.lit(True)), m)


_MISSING = " ".join(f"WHEN NOT json_exists(raw, '$.{k}') THEN 'missing {k}'" for k in contract.REQUIRED)
_JSON_NUMBER = "CAST(TRY_CAST(json_extract_string(raw, '$.{}') AS DOUBLE) AS BIGINT)"
_SPENT = " + ".join(_JSON_NUMBER.format(k) for k in contract.REQUIRED[1:4])


@query(f"""SELECT task, shard, CASE WHEN NOT ok THEN 'unreadable' {_MISSING} WHEN {_SPENT} > {_JSON_NUMBER.format("count")} THEN 'outcomes exceed count' WHEN json_type(raw, '$.status_dict') <> 'OBJECT' THEN 'status_dict is no map'
 WHEN coalesce({_JSON_NUMBER.format("status_dict.success")}, 0) <> {_JSON_NUMBER.format("successes")} THEN 'status_dict disagrees' END AS problem FROM (SELECT task, shard, json_valid(raw) AS ok, CASE WHEN json_valid(raw) THEN raw ELSE '{{}}' END AS raw FROM [stats_json] s) j""")
def stats_contract(spark: SparkSession, d: str) -> DataFrame:
    return contract.stats_problems(frame(spark, d, "stats_json")).select("task", "shard", "problem")


@query("SELECT s.task, s.key, s.caption, c.caption AS recorded FROM [samples] s LEFT JOIN [captions] c ON s.task = c.task AND s.key = c.key WHERE c.caption IS NOT NULL AND s.caption IS DISTINCT FROM c.caption")
def caption_mismatch(spark: SparkSession, d: str) -> DataFrame:
    """Samples with a label; captions are compared first, as few differ, and labels are looked up for those."""
    differ = distributions.caption_mismatches(frame(spark, d, "every_sample"), frame(spark, d, "captions"))
    labels = spark.read.parquet(f"{d}/labels.parquet").select(F.col("doc_id").alias("key"))
    return differ.join(labels, "key").select("task", "key", "caption", "recorded")


@query("SELECT p.task_id, CASE WHEN m.candidates IS NULL THEN 'redo unverifiable' WHEN m.candidates < p.rows THEN concat('redo short ', m.candidates, ' of ', p.rows) ELSE 'skip' END AS verdict FROM [plan] p LEFT JOIN [markers] m USING (task_id)")
def tasks_remaining(spark: SparkSession, d: str) -> DataFrame:
    return partition.completeness(frame(spark, d, "plan"), frame(spark, d, "markers"))


_SQL["rated"] = "(SELECT *, candidates * 1.0::DOUBLE / wall_seconds AS ups, successes * 1.0::DOUBLE / wall_seconds AS sps, successes * 1.0::DOUBLE / candidates AS y FROM [arms] a)"
_SQL["ranked"] = "(SELECT r.*, row_number() OVER (ORDER BY r.sps DESC, r.task) AS place, r.task = c.task AS is_control, r.sps / c.sps AS speedup, c.y - r.y AS drop FROM [rated] r, (SELECT * FROM [rated] x ORDER BY threads, -retries, task LIMIT 1) c)"


@query("SELECT task, place, is_control, round(ups, 6) AS urls_per_second, round(sps, 6) AS successes_per_second, round(y, 6) AS yield_rate, round(speedup, 6) AS speedup FROM [ranked] r")
def arms_ranking(spark: SparkSession, d: str) -> DataFrame:
    out = verdicts.ranked_arms(frame(spark, d, "arms"))
    return out.select("task", "place", "is_control", *(r6(c) for c in ("urls_per_second", "successes_per_second", "yield_rate", "speedup")))


_CHOICE = """WITH k AS (SELECT * FROM [ranked] r), b AS (SELECT * FROM k WHERE place = 1), h AS (SELECT * FROM k WHERE "drop" <= 0.05 ORDER BY place LIMIT 1), c AS (SELECT * FROM k WHERE is_control),
 v AS (SELECT CASE WHEN (SELECT count(*) FROM k) < 2 THEN 'too_few' WHEN speedup < 1.25 THEN 'no_gain' WHEN "drop" > 0.05 THEN 'trades_yield' ELSE 'wins' END AS verdict, speedup, task, ups FROM b)
 SELECT (SELECT count(*) FROM k) AS n_arms, verdict, round(speedup, 6) AS speedup, CASE WHEN verdict = 'trades_yield' THEN coalesce((SELECT task FROM h), (SELECT task FROM c)) ELSE task END AS task, round(1387173656 / CASE WHEN verdict = 'trades_yield' THEN coalesce((SELECT ups FROM h), (SELECT ups FROM c)) ELSE ups END / 3600, 6) AS node_hours FROM v"""
_SQL["choice"] = f"({_CHOICE})"


@query(_CHOICE)
def arms_choice(spark: SparkSession, d: str) -> DataFrame:
    return verdicts.chosen_arm(frame(spark, d, "arms")).select("n_arms", "verdict", r6("speedup"), "task", r6("node_hours"))


@query("SELECT c.task, c.node_hours, n.nodes, round(c.node_hours / n.nodes / 24, 6) AS days FROM [choice] c, (VALUES (16::BIGINT), (32::BIGINT), (64::BIGINT)) n(nodes)")
def arms_days(spark: SparkSession, d: str) -> DataFrame:
    chosen = verdicts.chosen_arm(frame(spark, d, "arms")).select("task", r6("node_hours"))
    return verdicts.arm_days(chosen).select("task", "node_hours", "nodes", r6("days"))


@query("""SELECT requested, shards, least(requested, shards) AS effective, round(shards * 1.0::DOUBLE / least(requested, shards), 6) AS waves, requested > shards AS capped, CASE WHEN requested > shards THEN 'capped' WHEN shards * 1.0::DOUBLE / least(requested, shards) < 3 THEN 'too few waves' END AS problem
 FROM (SELECT DISTINCT CAST(l_linenumber AS BIGINT) * 4 AS requested FROM lineitem) l, (SELECT CAST(ceil(count(*) / 500.0::DOUBLE) AS BIGINT) AS shards FROM events) s""")
def level_plan(spark: SparkSession, d: str) -> DataFrame:
    """Levels that the lines' numbers name, over as many URLs as there are events."""
    levels = spark.read.parquet(f"{d}/lineitem.parquet").select((F.col("l_linenumber").cast("long") * 4).alias("requested")).distinct()
    urls = spark.read.parquet(f"{d}/events.parquet").count()
    return planning.level_plan(levels, urls, 500).select("requested", "shards", "effective", r6("waves"), "capped", "problem")


@query("""SELECT n AS nodes, 32 // n AS processes, u // n AS urls, CAST(ceil((u // n) / 100.0::DOUBLE) AS BIGINT) AS shards, round(ceil((u // n) / 100.0::DOUBLE) / least(32 // n, ceil((u // n) / 100.0::DOUBLE)), 6) AS waves, n || 'n×' || (32 // n) || 'p' AS label
 FROM (VALUES (1), (2), (4)) v(n), (SELECT count(*) // 4 * 4 AS u FROM events) e""")
def node_plan(spark: SparkSession, d: str) -> DataFrame:
    urls = spark.read.parquet(f"{d}/events.parquet").count() // 4 * 4
    return planning.node_plan(spark, 32, urls, 100, [1, 2, 4]).select("nodes", "processes", "urls", "shards", r6("waves"), "label")


@query("SELECT total_rows, round(total_rows / 1e6, 6) AS node_hours FROM (SELECT CAST(sum(rows) AS BIGINT) AS total_rows FROM [sources] s) t")
def crude_node_hours(spark: SparkSession, d: str) -> DataFrame:
    summary = partition.partition_summary(frame(spark, d, "sources"), T.URLS_PER_TASK)
    return planning.crude_node_hours(summary.select("total_rows")).select("total_rows", r6("node_hours"))


@query("SELECT CASE path WHEN 'nation' THEN 0 WHEN 'region' THEN 1 WHEN 'supplier' THEN 2 ELSE 3 END AS part, path, row_index, url FROM [files_rows] f")
def concatenated_manifest(spark: SparkSession, d: str) -> DataFrame:
    rows = frame(spark, d, "files_rows")
    return partition.concatenated([rows.where(F.col("path") == p) for p in ("nation", "region", "supplier", "part")]).select("part", "path", "row_index", "url")


@query("""SELECT total_rows, round(total_rows * 0.55::DOUBLE, 6) AS images, round(total_rows * 0.55::DOUBLE * 85.6::DOUBLE * 1024 / 1e12, 9) AS terabytes, round(total_rows * 0.55::DOUBLE / 225.3::DOUBLE / 3600, 6) AS node_hours, n AS nodes, round(total_rows * 0.55::DOUBLE / 225.3::DOUBLE / 3600 / n / 0.97::DOUBLE / 24, 9) AS days
 FROM (SELECT CAST(sum(rows) AS BIGINT) AS total_rows FROM [sources] s) t, (VALUES (4), (8), (16), (32)) v(n)""")
def scale_projection(spark: SparkSession, d: str) -> DataFrame:
    out = planning.scale_projection(partition.partition_summary(frame(spark, d, "sources"), T.URLS_PER_TASK).select("total_rows"))
    return out.select("total_rows", r6("images"), F.round("terabytes", 9).alias("terabytes"), r6("node_hours"), "nodes", F.round("days", 9).alias("days"))


_STEPS = (10, 50, 100, 200, 400)


def _latencies(spark: SparkSession, d: str) -> DataFrame:
    """(seconds, share): whole seconds, a row each, with the share of events that took no longer."""
    counts = spark.read.parquet(f"{d}/events.parquet").groupBy(F.ceil("value").alias("seconds")).agg(F.count("*").alias("n"))
    return counts.select("seconds", (F.sum("n").over(Window.orderBy("seconds")) / F.sum("n").over(Window.partitionBy())).alias("share"))


@query("""WITH h AS (SELECT CAST(ceil(value) AS BIGINT) AS seconds, count(*) AS n FROM events GROUP BY 1), c AS (SELECT seconds, CAST(sum(n) OVER (ORDER BY seconds) AS BIGINT) * 1.0::DOUBLE / sum(n) OVER () AS fraction FROM h)
 SELECT t AS timeout, round(coalesce((SELECT arg_max(fraction, seconds) FROM c WHERE seconds <= t), 0.0), 6) AS yield_kept FROM (VALUES (10), (50), (100), (200), (400)) v(t)""")
def latency_yield(spark: SparkSession, d: str) -> DataFrame:
    """Steps are whole seconds with the share of answers by then; each timeout takes the last step at or below it."""
    timeouts = spark.createDataFrame([(t,) for t in _STEPS], "timeout long")
    return model.with_answered(timeouts, "timeout", _latencies(spark, d)).select("timeout", r6("answered", "yield_kept"))


@query("""WITH h AS (SELECT CAST(ceil(value) AS BIGINT) AS seconds, count(*) AS n FROM events GROUP BY 1), c AS (SELECT seconds, CAST(sum(n) OVER (ORDER BY seconds) AS BIGINT) * 1.0::DOUBLE / sum(n) OVER () AS share FROM h)
 SELECT e.event_id, round(coalesce(c.share, 0.0), 6) AS yield_kept FROM (SELECT event_id, value * 0.75::DOUBLE AS timeout FROM events) e ASOF LEFT JOIN c ON e.timeout >= c.seconds""")
def latency_of_each(spark: SparkSession, d: str) -> DataFrame:
    """Of each event, the share of answers that three quarters of its own time would have waited for."""
    events = spark.read.parquet(f"{d}/events.parquet").select("event_id", (F.col("value") * 0.75).alias("timeout"))
    return model.with_answered(events, "timeout", _latencies(spark, d)).select("event_id", r6("answered", "yield_kept"))


_NAMES = [("short", ("pageurl", "downloadurl", "uid", "photoid", "title")), ("upper", ("Url", "Text", "Width", "ID")), ("none", ("pageurl", "num_faces"))]


@query("""SELECT corpus, role, "column" FROM (VALUES ('short', 'url', 'downloadurl'), ('short', 'caption', 'title'), ('short', 'identifier', 'photoid'), ('short', 'width', NULL), ('short', 'height', NULL), ('short', 'face_boxes', NULL),
 ('upper', 'url', 'Url'), ('upper', 'caption', 'Text'), ('upper', 'identifier', 'ID'), ('upper', 'width', 'Width'), ('upper', 'height', NULL), ('upper', 'face_boxes', NULL), ('none', 'url', NULL), ('none', 'caption', NULL), ('none', 'identifier', NULL), ('none', 'width', NULL), ('none', 'height', NULL), ('none', 'face_boxes', NULL)) v(corpus, role, "column")""")
def schema_resolution(spark: SparkSession, d: str) -> DataFrame:
    return schema.resolved_table(spark.createDataFrame([(c, n, i) for c, names in _NAMES for i, n in enumerate(names)], "corpus string, column string, pos int"))


@query("""SELECT * FROM (VALUES ('coyo700m', 'identifier', 'uid', 'id'), ('coyo700m', 'face_boxes', 'bboxes', NULL)) v(corpus, role, observed, documented)""")
def documented_diff(spark: SparkSession, d: str) -> DataFrame:
    kind = "corpus string, role string, column string"
    said = spark.createDataFrame([("coyo700m", r, c) for r, c in schema.documentation("coyo700m").items()], kind)
    seen = schema.resolve(["url", "text", "uid", "width", "height", "bboxes"]).bound
    return schema.role_table(spark.createDataFrame([("coyo700m", r, c) for r, c in seen.items()], kind), said)


@query("SELECT task, shard, bytes, successes, round(CASE WHEN successes > 0 THEN bytes * 1.0::DOUBLE / successes END, 6) AS bytes_per_image FROM [shard_bytes] b")
def shard_sizes(spark: SparkSession, d: str) -> DataFrame:
    return distributions.shard_sizes(frame(spark, d, "shard_bytes")).select("task", "shard", "bytes", "successes", r6("bytes_per_image"))


@query("""SELECT task, total AS candidates, succeeded AS successes, succeeded * 1.0::DOUBLE / total < 0.30 AS low_yield, coalesce(other * 1.0::DOUBLE / nullif(succeeded + other, 0) > 0.01, false) AS bad_images, transient > 0 AS bad_captions,
 succeeded * 1.0::DOUBLE / total < 0.30 OR coalesce(other * 1.0::DOUBLE / nullif(succeeded + other, 0) > 0.01, false) OR transient > 0 AS stop FROM [counted] c""")
def pilot_verdict(spark: SparkSession, d: str) -> DataFrame:
    """Outcomes other and transient stand for pictures that don't open and captions that differ."""
    counts = outcomes.failure_counts(_messages(spark, d), "task")
    report = counts.select("task", F.col("total").alias("candidates"), F.col("succeeded").alias("successes"), F.col("succeeded").alias("decoded"), F.col("other").alias("decode_failures"), F.col("transient").alias("caption_mismatches"))
    return verdicts.pilot_verdict(report).drop("decoded", "decode_failures", "caption_mismatches")


@query("SELECT task, task % 3 AS expected_nodes, task % 2 AS nodes FROM (SELECT DISTINCT task FROM [attempts] a) t WHERE task % 2 >= task % 3")
def complete_phases(spark: SparkSession, d: str) -> DataFrame:
    tasks = frame(spark, d, "attempts").select("task").distinct()
    return verdicts.complete_phases(tasks.select("task", (F.col("task") % 3).alias("expected_nodes"), (F.col("task") % 2).alias("nodes")))


@query("""SELECT samples, decode_failures, bytes_read, elapsed_sec, samples + decode_failures AS attempted, round(samples / nullif(elapsed_sec, 0), 6) AS samples_per_sec, round(bytes_read / nullif(elapsed_sec, 0), 6) AS bytes_per_sec, round(decode_failures * 1.0::DOUBLE / (samples + decode_failures), 6) AS failure_rate
 FROM (SELECT CAST(sum(succeeded) AS BIGINT) AS samples, CAST(sum(other) AS BIGINT) AS decode_failures, CAST(sum(total * 1024) AS BIGINT) AS bytes_read, CAST(sum(wall) AS DOUBLE) AS elapsed_sec FROM [counted] c) t""")
def bench_total(spark: SparkSession, d: str) -> DataFrame:
    """Tasks' outcomes as shard timings: counts and seconds summed, then divided."""
    runs = _runs(spark, d).select(F.col("succeeded").alias("samples"), F.col("other").alias("decode_failures"), (F.col("total") * 1024).alias("bytes_read"), F.col("wall").cast("double").alias("elapsed_sec"))
    out = tar.bench_total(runs)
    return out.select("samples", "decode_failures", "bytes_read", "elapsed_sec", "attempted", r6("samples_per_sec"), r6("bytes_per_sec"), r6("failure_rate"))


@query("SELECT t::BIGINT AS threads, r::BIGINT AS retries FROM (VALUES (32), (128)) a(t), (VALUES (2), (0)) b(r)")
def arm_matrix(spark: SparkSession, d: str) -> DataFrame:
    return planning.arm_matrix(spark)
