"""Names, arithmetic, limits and refusals that commands and jobs rest on."""

import json

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from shardwright import cli
from shardwright import thresholds as T
from shardwright.errors import EngineError, ManifestError
from shardwright.functions import model, names, status
from shardwright.operators import distributions, ingest, partition, planning, schema
from shardwright.sources import listing, sinks, urllist


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def test_names(spark):
    got = one(spark, names.shard_file(F.lit(7), ".tar"), names.shard_file(F.lit(123456), "_stats.json"), names.task_directory(F.lit(42)), names.task_of(F.lit("task-000042")), names.task_of(F.lit("x")), names.shard_of(F.lit("00012_stats.json")))
    assert got[:] == ("00007.tar", "123456_stats.json", "task-000042", 42, None, 12)
    with pytest.raises(Exception, match="negative"):
        one(spark, names.shard_file(F.lit(-1), ".tar"))


def test_messages(spark):
    assert one(spark, status.http_message(F.lit(404), F.lit("Not Found")))[0].startswith("HTTP Error 404")


def test_throughput_arithmetic(spark):
    cost = model.url_seconds(0.4, 10, 2, 1.0)
    got = one(spark, cost, model.failure_share(12.6, 10, 2, 1.0), model.pace(12.6, 1024), model.hours(3600, 2.0), model.lost_seconds(5, 1))
    assert got[:] == (pytest.approx(12.6), pytest.approx(0.4), pytest.approx(1024 / 12.6), 0.5, 10)
    assert model.shard_count(20_001, 1000) == 21 and model.shard_count(20_000, 1000) == 20
    for bad in (model.url_seconds(1.2, 10, 2, 1.0), model.failure_share(99.0, 10, 2, 1.0), model.pace(0, 5), model.hours(5, 0)):
        with pytest.raises(Exception):  # noqa: B017
            one(spark, bad)


def test_projections():
    assert planning.storage_projection(85.6 * 1024) == pytest.approx(735 * 1_000_000 * 0.645 * 85.6 * 1024 / 1e12)
    assert planning.pilot_projection(1000, 10) == pytest.approx(100 * T.CORPUS_ROWS / 1024**4)


def test_limits(spark, tmp_path):
    planning.check_wave(0, 15, 100, 0, None)
    for first, last, tasks, unfinished, cap in ((0, 100, 100, 0, 5), (3, 2, 100, 0, 5), (0, 16, 100, 0, None), (0, 9, 2000, 991, 5)):
        with pytest.raises(EngineError):
            planning.check_wave(first, last, tasks, unfinished, cap)
    levels = planning.level_plan(spark.createDataFrame([(8,), (64,), (64,)], "requested long"), 100, 10)
    assert [(r.requested, r.problem) for r in planning.level_problems(levels).orderBy("requested").collect()] == [(8, "too few waves"), (64, "capped")]
    plan = tmp_path / "plan.json"
    for meta, fine in (("a", True), ("a", True), ("b", False)):
        plan.write_text(json.dumps({"meta_dir": meta, "urls_per_task": 5, "tasks": []}))
        if fine:
            planning.check_root(str(tmp_path / "root"), str(plan))
        else:
            with pytest.raises(EngineError):
                planning.check_root(str(tmp_path / "root"), str(plan))


def test_roles(spark):
    roles = schema.resolve(["URL", "TEXT", "hash", "other"])
    assert roles.carried == {"url": "URL", "caption": "TEXT", "identifier": "hash"} and "(absent)" in roles.describe()
    df = spark.createDataFrame([("u", "t", "h", 1)], "URL string, TEXT string, hash string, other int")
    assert roles.select(df).columns == ["url", "text", "uid"]
    assert schema.mismatches([("a", ["x"]), ("b", ["x"]), ("c", ["y"])]) == ["c"] and schema.mismatches([]) == []


def test_pieces_and_samples(spark, tmp_path):
    pq.write_table(pa.table({"url": [str(k) for k in range(9)]}), tmp_path / "a.parquet")
    pq.write_table(pa.table({"url": ["z"]}), tmp_path / "b.parquet")
    rows = listing.with_positions(spark, [str(tmp_path / "a.parquet")], "url")
    assert sorted(r.url for r in partition.piece(rows, 9, 2, 5).collect()) == ["2", "3", "4"]
    for start, end in ((-1, 2), (3, 2), (0, 10)):
        with pytest.raises(ManifestError):
            partition.piece(rows, 9, start, end)
    assert listing.metadata_sample(spark, tmp_path, 3).count() == 3
    assert [r.host for r in listing.hosts_of(spark, "b\n a \r\n\nb\nc").collect()] == ["b", "a", "c"]
    counts = listing.row_counts(spark, tmp_path)
    assert [r.path.rsplit("/", 1)[1] for r in partition.file_prefix(counts, 9).collect()] == ["a.parquet"] and partition.file_prefix(counts, 10).count() == 2
    for k in (2, 0, 1):
        (tmp_path / f"0000{k}.tar").write_bytes(b"")
    assert [p.name for p in listing.find_shards(tmp_path, 2)] == ["00000.tar", "00001.tar"] and listing.find_shards(tmp_path / "00002.tar") == [tmp_path / "00002.tar"]


def test_text_slices_keep_their_order(spark, tmp_path):
    rows = spark.range(3000).select(F.expr("id div 1000").alias("slice"), F.col("id").alias("pos"), F.concat(F.lit("u"), "id").alias("url")).orderBy(F.rand(1))
    sinks.write_slices(rows, str(tmp_path / "s"), "url", text=True, order="pos")
    for k in range(3):
        lines = urllist.numbered_lines(spark, str(tmp_path / "s" / f"slice={k}")).orderBy("pos").collect()
        assert [r.line for r in lines] == [f"u{n}" for n in range(1000 * k, 1000 * (k + 1))]


@pytest.mark.parametrize(("headers", "token", "out"), [
    ([], None, False), (["noai"], None, True), (["all, NoImageAI"], None, True), (["otherbot: noai"], None, False), (["otherbot: noai"], "otherbot", True), (["OtherBot: nofollow"], "otherbot", False),
    (["nofollow", "noindex"], None, True), (["unavailable_after: 25 Jun"], None, False),
])
def test_opting_out(headers, token, out):
    assert ingest.opted_out(headers, token) is out
    assert "token" not in ingest.agent(None) and ingest.agent("tok").endswith("; tok)")


def test_captions_are_compared_by_digest_and_returned_whole(spark):
    ours = spark.createDataFrame([(0, 1, "a"), (0, 2, "b" * 9000), (0, 3, None), (0, 4, None), (0, 5, "e"), (1, 1, "z"), (0, 2, "twice")], "task int, key int, caption string")
    theirs = spark.createDataFrame([(0, 1, "a"), (0, 2, "B"), (0, 3, "c"), (0, 4, None), (1, 1, None), (0, 2, "b" * 9000)], "task int, key int, caption string")
    got = {tuple(r) for r in distributions.caption_mismatches(ours, theirs).collect()}
    assert got == {(0, 2, "b" * 9000, "B"), (0, 3, None, "c"), (0, 2, "twice", "B"), (0, 2, "twice", "b" * 9000)}


def test_host_windows(spark):
    urls = spark.createDataFrame([(0, "http://a/1"), (1, "http://a/2"), (2, "http://b/"), (3, "bad"), (4, "http://a/3"), (5, None)], "pos long, url string")
    got = distributions.host_concentration(urls, 4).first()
    assert (got.urls, got.connections, got.unparseable, got.hosts) == (6, 3, 2, 2)
    none = distributions.host_concentration(urls.where("false"), 4).first()
    assert (none.urls, none.connections, none.hosts, none.reuse_factor, none.saved_fraction, none.pool) == (0, 0, 0, 1.0, 0.0, False)


def test_verify(spark, tmp_path, capsys):
    def table(name, w, ow, **more):
        pq.write_table(pa.table({"width": w, "height": w, "original_width": ow, "original_height": ow, **more}), tmp_path / name)

    table("a.parquet", [100, 200], [100, 200], status=["success", "success"])
    table("b.parquet", [300], [300])
    assert cli.main(["verify", str(tmp_path)], spark) == 0
    assert json.loads(capsys.readouterr().out)["files_without_status"] == 1
    for claimed, code in ((210.0, 0), (400.0, 1)):
        (tmp_path / "claimed.json").write_text(json.dumps({"percentiles": [{"p": 50, "short_side": claimed}]}))
        assert cli.main(["verify", str(tmp_path), "--claimed", str(tmp_path / "claimed.json")], spark) == code
    table("c.parquet", [50], [100], status=["success"])
    assert cli.main(["verify", str(tmp_path)], spark) == 1


def test_pictures_are_decoded_by_the_image_source(spark, tmp_path):
    import zlib

    from shardwright.operators import pilot

    def chunk(kind, data):
        return len(data).to_bytes(4, "big") + kind + data + zlib.crc32(kind + data).to_bytes(4, "big")

    png = b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", (2).to_bytes(4, "big") + (1).to_bytes(4, "big") + b"\x08\x02\0\0\0") + chunk(b"IDAT", zlib.compress(b"\0" + bytes(range(6)))) + chunk(b"IEND", b"")
    framed = b"\xff\xd8\xff picture \xff\xd9"  # looks like a picture but isn't one
    rows = [("t", "a", "c", png), ("t", "b", "c", framed), ("t", "c", None, None), ("u", "a", "d", png), ("u", "b", "d", png[:40])]
    samples = spark.createDataFrame(rows, "task string, key string, caption string, image binary")
    want = {("t", "a"): True, ("t", "b"): False, ("t", "c"): False, ("u", "a"): True, ("u", "b"): False}
    assert {(r.task, r.key): r.ok for r in pilot.decoded(samples, str(tmp_path / "p")).collect()} == want
    assert {(r.task, r.key): r.ok for r in pilot.decoded(samples).collect()}[("t", "b")]
    assert pilot.decoded(samples.where("false"), str(tmp_path / "q")).count() == 0


def test_bytes_that_are_no_text(spark):
    from shardwright.operators import contract
    from shardwright.sources import tar

    rows = [("t", "0", "a", ".jpg", 0, 1, b"x"), ("t", "0", "a", ".json", 1, 1, b'{"sha256": "\xff"}'), ("t", "0", "a", ".txt", 2, 1, b"caf\xe9")]
    members = spark.createDataFrame(rows, tar.SCHEMA)
    shards = spark.createDataFrame([("0", True)], "shard string, has_tar boolean")
    assert {r.problem for r in contract.shard_problems(shards, members).collect()} == {"missing sidecar", "invalid json"}
    assert tar.samples(members).first().caption == "caf�"
