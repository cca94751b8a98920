"""Golden cases of the engine's operators."""

import math
from urllib.parse import urlsplit

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shardwright import thresholds as T
from shardwright.errors import EngineError, ManifestError, SchemaError
from shardwright.functions import model, names, status, urls
from shardwright.operators import contract, distributions, outcomes, partition, planning, schema, verdicts


def counts(spark, messages):
    df = spark.createDataFrame([(0, m, n) for m, n in messages.items()], "task int, message string, n long")
    return outcomes.failure_counts(df, "task").first().asDict()


def test_failures_are_classified(spark):
    got = counts(spark, {"HTTP Error 404: x": 5, "HTTP Error 403: x": 3, "HTTP Error 410: x": 2, "<urlopen error timed out>": 4, "HTTP Error 503: x": 1, "HTTP Error 429: x": 6, "success": 79})
    assert (got["permanent"], got["transient"], got["rate_limited"], got["total"]) == (10, 11, 6, 100)
    got = counts(spark, {"what is this": 4, "success": 96})
    assert (got["other"], got["total"]) == (4, 100)
    got = counts(spark, {"[Errno 110] Connection timed out": 1, "[Errno -2] HTTP Error 404": 1, "[Errno 113] x": 1, "HTTP Error 302: x": 1})
    assert (got["transient"], got["dns"], got["unreachable"], got["other"]) == (1, 1, 1, 1)


def health(spark, **n):
    kinds = ("success", "dns", "unreachable", "other")
    row = [sum(n.values()), n.get("success", 0), n.get("dns", 0), n.get("unreachable", 0), 0]
    df = spark.createDataFrame([row], "candidates long, successes long, dns long, unreachable long, rate_limited long")
    assert set(n) <= set(kinds)
    return verdicts.health(outcomes.with_rates(df)).first()


def test_health(spark):
    assert health(spark, success=644, dns=60, other=296).healthy
    assert health(spark, success=1, dns=706, unreachable=155, other=138).cause == "unreachable"
    assert health(spark, success=600, dns=60, unreachable=30, other=310).healthy
    assert health(spark, success=700, dns=210, other=90).cause == "dns"
    empty = health(spark)
    assert empty.cause == "nothing_attempted" and empty.yield_rate is None


def runs(spark, *rows):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "run int, processes int, nodes int, successes_per_sec double, yield_rate double, dns_fraction double")


def test_concurrency_verdict(spark):
    good = verdicts.concurrency_verdict(runs(spark, (8, 1, 350.0, 0.64, 0.06), (32, 1, 1200.0, 0.64, 0.06), (64, 1, 2000.0, 0.63, 0.06), (8, 1, 355.0, 0.64, 0.06))).first()
    assert good.scales and not good.rejected
    bad = verdicts.concurrency_verdict(runs(spark, (8, 1, 350.0, 0.64, 0.06), (32, 1, 420.0, 0.64, 0.06))).first()
    assert bad.scales is False and bad.rejected and bad.baseline_drift is None
    alone = verdicts.concurrency_verdict(runs(spark, (8, 1, 0.0, 0.64, 0.06))).first()
    assert alone.scales is None and not alone.rejected


def test_distribution_verdict(spark):
    got = verdicts.distribution_verdict(runs(spark, (32, 1, 1000.0, 0.6, 0.06), (16, 2, 810.0, 0.6, 0.06), (32, 1, 800.0, 0.6, 0.06))).first()
    assert got.single_node_rate == 900 and got.distribution_neutral
    lone = verdicts.distribution_verdict(runs(spark, (32, 1, 1000.0, 0.6, 0.06))).first()
    assert lone.distribution_neutral is None and not lone.rejected


def sources(spark, **files):
    return spark.createDataFrame(list(files.items()), "path string, rows long")


def test_partition_cases(spark):
    got = {tuple(r) for r in partition.pieces(sources(spark, a=60, b=60), 100).select("task", "path", "start", "end").collect()}
    assert got == {(0, "a", 0, 60), (0, "b", 0, 40), (1, "b", 40, 60)}
    assert partition.pieces(sources(spark, a=250), 100).count() == 3
    assert tuple(partition.partition_summary(sources(spark, a=1_000_000, b=500_000), 400_000).first()) == (1_500_000, 4, 3, 300_000)
    with pytest.raises(EngineError):
        partition.pieces(sources(spark, a=1), 0)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.integers(0, 50), min_size=1, max_size=6), st.integers(1, 40))
def test_partition_is_disjoint_and_complete(spark, rows, per_task):
    files = [(f"d/{i}", n) for i, n in enumerate(rows)]
    got = partition.pieces(spark.createDataFrame(files, "path string, rows long"), per_task).collect()
    seen = [(p.path, k) for p in got for k in range(p.start, p.end)]
    assert len(seen) == len(set(seen)) == sum(rows)
    per = {}
    for p in got:
        per[p.task] = per.get(p.task, 0) + p.end - p.start
    assert all(per[t] == per_task for t in list(sorted(per))[:-1])


def test_paths_sort_by_component(spark):
    df = spark.createDataFrame([("a-b/c",), ("a/b",)], "p string")
    assert [r.p for r in df.orderBy(names.path_order(df.p)).collect()] == ["a/b", "a-b/c"]


@given(st.integers(1, 300), st.integers(1, 60))
def test_even_sample(total, want):
    got = distributions.even_sample(total, want)
    assert got == sorted(set(got)) and len(got) == min(total, want) and got[0] == 0
    assert want == 1 or got[-1] == total - 1


@pytest.mark.parametrize(("total", "want"), [(1000, 5), (3, 10), (100, 1), (97, 17), (11, 10)])
def test_even_sample_of_rows(spark, total, want):
    rows = distributions.evenly_sampled(spark.range(total).withColumnRenamed("id", "pos"), "pos", total, want)
    assert sorted(r.pos for r in rows.collect()) == distributions.even_sample(total, want)


def test_sizes(spark):
    df = spark.createDataFrame([(0, 0), (None, 500), (500, None), (640, 480)], "w long, h long")
    assert tuple(distributions.unusable_count(df).first()) == (3, 1)
    sides = distributions.side_counts(spark.createDataFrame([(10, 99), (20, 99)], "w long, h long"))
    assert {r.p: r.short_side for r in distributions.percentiles(sides, "short_side").collect()}[50] == 15
    below = distributions.below(distributions.side_counts(spark.createDataFrame([(100, 100), (255, 300), (256, 256), (640, 480)], "w long, h long")))
    assert {r.threshold: (r.below, r.fraction) for r in below.collect()}[256] == (2, 0.5)


def test_size_report(spark):
    rows = [(t, s, b * 1000, 1) for t, bs in {"a": (100, 105), "b": (300, 310)}.items() for s, b in enumerate(bs)] + [("a", 9, 5, 0)]
    got = distributions.size_report(distributions.task_sizes(spark.createDataFrame(rows, "task string, shard int, bytes long, successes long"))).first()
    assert got.between_dominates and round(got.between, 2) == 2.98 and round(got.worst_within, 2) == 1.05


def test_hosts(spark):
    mixed = spark.createDataFrame([(i, f"http://{'ab'[i % 2]}.x/{i}") for i in range(100)], "pos long, url string")
    assert distributions.host_concentration(mixed, 2).first().connections == 100
    assert distributions.host_concentration(mixed, 100).first().connections == 2
    one = spark.createDataFrame([(i, f"http://a.x/{i}") for i in range(100)], "pos long, url string")
    got = distributions.host_concentration(one, 100).first()
    assert (got.reuse_factor, round(got.saved_fraction, 6)) == (100.0, 0.99)
    bad = distributions.host_concentration(spark.createDataFrame([(0, None), (1, "nothing")], "pos long, url string"), 5).first()
    assert (bad.unparseable, bad.reuse_factor, bad.saved_fraction) == (2, 1.0, 0.0)


URLS = ["http://A.x/1", "https://a.x:443/", "https://a.x:8443/", "http://u:p@h.x/a", "http://[::1]:80/x", "http://a_b.x/|", "ftp://a.x", "//a.x/b", "http://", "http://a.x:99999/", "http://a.x:b/", "http://a.x:080/", " http://é.x/%zz", None, "http://a.x:"]


def test_pool_keys(spark):
    def expected(url):
        try:
            u = urlsplit(str(url).strip())
            host, port = u.hostname, u.port
        except ValueError:
            return None
        if not u.scheme or not host:
            return None
        return f"{u.scheme}://{host}" + (f":{port}" if port is not None and port != {"http": 80, "https": 443}.get(u.scheme) else "")

    df = spark.createDataFrame([(u,) for u in URLS], "u string")
    assert [r.k for r in df.select(urls.pool_key(df.u).alias("k")).collect()] == [expected(u) for u in URLS]


def test_schema():
    roles = schema.resolve(["pageurl", "downloadurl", "uid", "photoid", "title"])
    assert roles.bound["url"] == "downloadurl" and roles.bound["identifier"] == "photoid" and roles.bound["face_boxes"] is None
    assert schema.resolve(["Url", "uRL"]).bound["url"] == "uRL"
    with pytest.raises(SchemaError):
        schema.resolve(["pageurl"])
    assert schema.differences("coyo700m", schema.resolve(["url", "text", "uid", "width", "height"])) == ["identifier: documented 'id', observed 'uid'"]
    with pytest.raises(ManifestError):
        schema.check_carried(["uid", "width"])


def test_arms(spark):
    def arms(*rows):
        return spark.createDataFrame([(8 + i, *r) for i, r in enumerate(rows)], "task long, threads long, retries long, candidates long, successes long, wall_seconds double")

    got = verdicts.chosen_arm(arms((32, 2, 100_000, 58_700, 3600.0), (32, 0, 100_000, 58_000, 1200.0))).first()
    assert got.verdict == "wins" and got.task == 9 and math.isclose(got.speedup, 58_000 / 58_700 * 3)
    assert verdicts.chosen_arm(arms(*[(32, r, 100, 60, 10.0) for r in (2, 1, 0)])).first().verdict == "no_gain"
    assert verdicts.chosen_arm(arms((32, 2, 100, 60, 10.0))).first().verdict == "too_few"
    traded = verdicts.chosen_arm(arms((32, 2, 100, 60, 10.0), (128, 0, 100, 40, 1.0), (32, 0, 100, 58, 4.0))).first()
    assert (traded.verdict, traded.task) == ("trades_yield", 10)


def test_model(spark):
    one = spark.range(1)
    value = lambda c: one.select(c.alias("v")).first().v
    assert value(model.url_seconds(0.5, 10, 2, 1)) == 15.5
    assert math.isclose(value(model.failure_share(15.5, 10, 2, 1)), 0.5)
    assert value(model.pace(2.0, 64)) == 32 and value(model.hours(7200, 2)) == 1 and model.shard_count(1001, 100) == 11
    assert value(model.url_seconds(F.lit(None).cast("double"), 10, 2, 1)) is None
    steps = spark.createDataFrame([(10.0, 1.0), (1.0, 0.5)], "seconds double, share double")
    asked = spark.createDataFrame([(0.5,), (1.0,), (5.0,), (10.0,)], "t double")
    assert [r.answered for r in model.with_answered(asked, "t", steps).orderBy("t").collect()] == [0.0, 0.5, 0.5, 1.0]
    for bad in (model.url_seconds(1.1, 1, 1, 1), model.failure_share(50, 10, 2, 1), model.failure_share(1, 1, 0, 2), model.pace(0, 1), model.hours(5, 0)):
        with pytest.raises(Exception, match="a failure rate|timeouts alone|has to"):
            value(bad)


def test_stats_contract(spark):
    ok = '{"count":10.0,"successes":6,"failed_to_download":4,"failed_to_resize":0,"status_dict":{"success":6}}'
    cases = {ok: None, "x": "unreadable", '{"count":1}': "missing successes", ok.replace('"failed_to_download":4', '"failed_to_download":9'): "outcomes exceed count", ok.replace('{"success":6}', "3"): "status_dict is no map", ok.replace(":6}", ":5}"): "status_dict disagrees", ok.replace('{"success":6}', "{}"): "status_dict disagrees"}
    df = spark.createDataFrame([(k,) for k in cases], "raw string")
    assert {r.raw: r.problem for r in contract.stats_problems(df).collect()} == cases


def test_planning(spark):
    plan = planning.level_plan(spark.createDataFrame([(8,), (64,)], "requested long"), 200_000, 10_000).collect()
    assert [r.problem for r in plan] == ["too few waves", "capped"]
    assert planning.samples_per_shard(200_000, [8, 64]) == 1041
    with pytest.raises(EngineError):
        planning.node_plan(spark, 32, 100, 10, [3])
    assert planning.node_problems(planning.node_plan(spark, 32, 200_000, 1000, [1, 2])) == []
    assert planning.node_problems(planning.node_plan(spark, 32, 64, 4, [2])) == ["2n×16p: only 8 shards"]
    for bad in ((None, True, True), (1, False, True), (1, True, False)):
        with pytest.raises(EngineError):
            planning.check_blur(*bad)


def test_thresholds():
    assert (T.MIN_SPEEDUP, T.MAX_YIELD_DROP, T.MAX_DNS_RISE, T.MAX_DRIFT) == (1.5, 0.05, 0.03, 0.20)
    assert (T.MIN_YIELD, T.MAX_DNS, T.MAX_UNREACHABLE, T.HEALTHY_YIELD) == (0.30, 0.20, 0.10, 0.50)


def test_strip_is_unicode_aware(spark):
    df = spark.createDataFrame([("\t a b 　",)], "t string")
    assert df.select(status.strip(df.t)).first()[0] == "a b"
