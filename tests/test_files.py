"""Sources, sinks, commands, fetching and the stream on real files."""

import hashlib
import http.server
import io
import json
import tarfile
import threading

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from shardwright import cli
from shardwright.errors import EngineError, UrlListFormatError
from shardwright.operators import contract, ingest
from shardwright.sources import listing, sinks, stats, tar, urllist
from shardwright.streaming import monitor


def parquet(path, **cols):
    path.parent.mkdir(parents=True, exist_ok=True)
    pq.write_table(pa.table(cols), path)


def shard(path, members):
    path.parent.mkdir(parents=True, exist_ok=True)
    with tarfile.open(path, "w") as t:
        for name, body in members:
            info = tarfile.TarInfo(name)
            info.size = len(body)
            t.addfile(info, io.BytesIO(body))


def task(root, number, *shards):
    d = root / f"task-{number:06d}" / "shards"
    d.mkdir(parents=True)
    for i, body in enumerate(shards):
        (d / f"{i:05d}_stats.json").write_text(body if isinstance(body, str) else json.dumps(body))
    return d.parent


GOOD = {"count": 100, "successes": 65, "status_dict": {"success": 65, "HTTP Error 404: Not Found": 35}}


def test_row_counts_and_plan(spark, tmp_path):
    parquet(tmp_path / "a-b" / "x.parquet", url=["u"] * 30)
    parquet(tmp_path / "a" / "x.parquet", url=["v"] * 20)
    parquet(tmp_path / "z.parquet", url=pa.array([], pa.string()))
    (tmp_path / "bad.parquet").write_bytes(b"PAR1nothing")
    got = {r.path.removeprefix(str(tmp_path.resolve())): r.rows for r in listing.row_counts(spark, tmp_path).collect()}
    assert got == {"/a-b/x.parquet": 30, "/a/x.parquet": 20, "/z.parquet": 0, "/bad.parquet": None}
    assert cli.main(["plan", str(tmp_path), "--per-task", "40", "--json", str(tmp_path / "plan.json")], spark) == 0
    rows = {(r.task_id, r.path, r.start, r.end) for r in stats.read_plan(spark, str(tmp_path / "plan.json")).collect()}
    assert rows == {(0, "a/x.parquet", 0, 20), (0, "a-b/x.parquet", 0, 20), (1, "a-b/x.parquet", 20, 30)}
    assert listing.rebased("/corpus/a/x.parquet", str(tmp_path)) == str(tmp_path / "a" / "x.parquet")
    with pytest.raises(EngineError):
        listing.rebased("b/x.parquet", str(tmp_path))


def test_inspect_and_hosts(spark, tmp_path, capsys):
    parquet(tmp_path / "m" / "x.parquet", url=[f"http://h{i % 3}.x/{i}" for i in range(9)], width=[300] * 9, height=[200] * 9)
    assert cli.main(["inspect", str(tmp_path / "m")], spark) == 0
    assert cli.main(["hosts", str(tmp_path / "m"), "--window", "9"], spark) == 0
    assert '"connections": 3' in capsys.readouterr().out
    assert cli.main(["resolution", str(tmp_path / "m")], spark) == 0
    parquet(tmp_path / "n" / "x.parquet", page=["x"])
    assert cli.main(["inspect", str(tmp_path / "n")], spark) == 2


def test_url_lists(spark, tmp_path):
    f = tmp_path / "l.tsv"
    f.write_text("id\turl\r\n1\t http://a \r\n2\n3\thttp://b\n")
    assert [(r.pos, r.url) for r in urllist.read_urls(spark, str(f)).orderBy("pos").collect()] == [(1, "http://a"), (3, "http://b")]
    f.write_text("1\thttp://a\n")
    with pytest.raises(UrlListFormatError):
        urllist.read_urls(spark, str(f))
    f.write_text("")
    assert urllist.read_urls(spark, str(f)).count() == 0


def test_assess_salvage_and_retry(spark, tmp_path):
    good = task(tmp_path, 3, GOOD, GOOD)
    bad = task(tmp_path, 4, {"count": 100, "successes": 1, "status_dict": {"success": 1, "<urlopen error [Errno 101] x>": 99}}, "not json", "", GOOD)
    assert cli.main(["assess", str(good)], spark) == 0 and json.loads((good / "health.json").read_text())["healthy"]
    assert cli.main(["assess", str(bad)], spark) == 1
    assert cli.main(["salvage", str(bad)], spark) == 1 and not (bad / "DONE.json").exists()
    assert cli.main(["salvage", str(good)], spark) == 0 and json.loads((good / "DONE.json").read_text())["salvaged"]
    assert sinks.set_aside(spark, bad, "t1") == (1, 3)
    assert sorted(p.name for p in (bad / "attempt-t1").iterdir()) == [f"{i:05d}_stats.json" for i in range(3)]
    assert cli.main(["slow", str(tmp_path)], spark) == 0


def test_layouts(tmp_path):
    nested = task(tmp_path, 1, GOOD)
    (nested / "00009_stats.json").write_text("{}")
    flat = tmp_path / "task-000002"
    (flat / "shards").mkdir(parents=True)
    (flat / "00000_stats.json").write_text("{}")
    (tmp_path / "task-000003.attempt-9").mkdir()
    assert [p.name for p in listing.task_dirs(tmp_path)] == ["task-000001", "task-000002"]
    assert len(listing.stats_files(nested)) == 1 and len(listing.stats_files(flat)) == 1


def test_tars(spark, tmp_path):
    image = b"\xff\xd8\xff picture \xff\xd9"
    meta = json.dumps({"sha256": hashlib.sha256(image).hexdigest()}).encode()
    shard(tmp_path / "task-000000" / "shards" / "00000.tar", [("a.jpg", image), ("a.json", meta), ("a.txt", b"hello"), ("b.jpg", image), ("c.json", b"{}"), ("d.jpg", image), ("d.json", b'{"sha256":"0"}'), ("d.jpg", image)])
    shard(tmp_path / "task-000000" / "shards" / "00001.tar", [])
    members = tar.read_members(spark, str(tmp_path)).cache()
    assert members.count() == 8
    shards = spark.createDataFrame([("00000", True), ("00001", True), ("00002", False)], "shard string, has_tar boolean")
    got = {tuple(r) for r in contract.shard_problems(shards, members).collect()}
    assert got == {("00000", "b", "missing sidecar"), ("00000", "c", "metadata without image"), ("00000", "d", "duplicate key"), ("00000", "d", "sha256 mismatch"), ("00001", None, "empty shard"), ("00002", None, "missing tar")}
    first = tar.samples(members, 1).first()
    assert first.key == "a" and first.caption == "hello"
    total = tar.bench_total(tar.bench(spark, str(tmp_path))).first()
    assert (total.samples, total.decode_failures) == (4, 0)
    (tmp_path / "out").mkdir()
    rows = spark.createDataFrame([(7, "k", ".txt", b"x")], "shard long, key string, suffix string, payload binary")
    assert tar.write_shards(rows, str(tmp_path / "out")).first().members == 1
    assert tar.read_members(spark, str(tmp_path / "out" / "00007.tar")).first().payload == b"x"


def test_report(spark, tmp_path, capsys):
    image = b"\xff\xd8\xff picture \xff\xd9"
    assert cli.main(["report", str(tmp_path)], spark) == 1  # nothing is done
    for n, said in ((0, "one"), (1, "two"), (2, "three")):  # keys repeat across tasks
        d = tmp_path / f"task-{n:06d}"
        shard(d / "shards" / "00000.tar", [("a.jpg", image), ("a.txt", said.encode()), ("b.jpg", b"bad" if n else image), ("b.txt", b"other"), ("c.jpg", image)])
        parquet(d / "shards" / "00000.parquet", key=["a", "b"], caption=[said, "b"], exif=["{}", None], original_width=[30, None], original_height=[40, 9])
        if n < 2:
            (d / "DONE.json").write_text(json.dumps({"candidates": 10, "successes": 6}))
    parquet(tmp_path / "task-000001" / "shards" / "00001.parquet", key=["z"])
    capsys.readouterr()
    assert cli.main(["report", str(tmp_path), "--samples", "4"], spark) == 1  # two samples of each tar
    got = json.loads(capsys.readouterr().out)
    assert (got["decoded"], got["decode_failures"], got["caption_mismatches"]) == (3, 1, 1) and got["bad_images"] and got["bad_captions"] and not got["low_yield"]
    assert (got["tasks"], got["incomplete"], got["candidates"], got["exif_bytes"]) == (2, 1, 20, 4)
    assert {p["short_side"] for p in got["percentiles"]} == {30.0}
    task(tmp_path, 5, GOOD)
    (tmp_path / "task-000005" / "DONE.json").write_text("{}")
    assert cli.main(["report", str(tmp_path)], spark) == 1
    assert "task-000005" in capsys.readouterr().err


def test_cap_and_lock(spark, tmp_path):
    parquet(tmp_path / "u.parquet", url=[str(i) for i in range(20)])
    assert cli.main(["cap", str(tmp_path / "u.parquet"), "--rows", "5"], spark) == 0
    assert pq.read_table(tmp_path / "u.parquet")["url"].to_pylist() == list("01234")
    with sinks.TaskLock(tmp_path, "me"), pytest.raises(EngineError), sinks.TaskLock(tmp_path, "you"):
        pass
    assert cli.main(["slices", str(tmp_path / "u.parquet"), "--rows", "2", "--slices", "2", "--to", str(tmp_path / "s")], spark) == 0
    assert cli.main(["slices", str(tmp_path / "u.parquet"), "--rows", "9", "--slices", "2", "--to", str(tmp_path / "t")], spark) == 2


class _Site(http.server.BaseHTTPRequestHandler):
    def do_GET(self):
        code = {"/ok": 200, "/no": 404, "/opt": 200}[self.path]
        self.send_response(code)
        if self.path == "/opt":
            self.send_header("X-Robots-Tag", "noai")
        self.send_header("Content-Length", "4")
        self.end_headers()
        self.wfile.write(b"body")

    def log_message(self, *args):
        pass


def test_fetching(spark):
    pytest.importorskip("urllib3")
    site = http.server.ThreadingHTTPServer(("127.0.0.1", 0), _Site)
    threading.Thread(target=site.serve_forever, daemon=True).start()
    base = f"http://127.0.0.1:{site.server_port}"
    df = spark.createDataFrame([(0, f"{base}/ok"), (1, f"{base}/no"), (2, f"{base}/opt"), (3, "http://127.0.0.1:1/x")], "pos long, url string")
    got = ingest.fetched(df, threads=2, timeout=5).cache()
    rows = {r.pos: r for r in got.collect()}
    site.shutdown()
    assert rows[0].payload == b"body" and rows[0].sha256 == hashlib.sha256(b"body").hexdigest()
    assert rows[1].error_message == "HTTP Error 404: Not Found" and "disallowed" in rows[2].error_message and rows[3].status == "failed_to_download"
    s = ingest.shard_stats(got).first()
    assert (s["count"], s["successes"]) == (4, 1)


def test_stream(spark, tmp_path):
    task(tmp_path, 1, GOOD, GOOD)
    query = monitor.outcome_stream(spark, str(tmp_path)).writeStream.outputMode("complete").format("memory").queryName("seen").start()
    query.processAllAvailable()
    query.stop()
    assert {r.bucket: r.n for r in spark.table("seen").collect()} == {"success": 130, "permanent": 70}


def test_unreadable_files_are_unknown_whatever_their_number(spark, tmp_path):
    for k in range(210):
        pq.write_table(pa.table({"url": list("ab")[: k % 3]}), tmp_path / f"{k:03}.parquet")
    (tmp_path / "bad.parquet").write_bytes(b"PAR1 damaged")
    got = {r.path.rsplit("/", 1)[1]: r.rows for r in listing.row_counts(spark, tmp_path).collect()}
    assert got.pop("bad.parquet") is None and got == {f"{k:03}.parquet": k % 3 for k in range(210)}


def test_set_aside_moves_only_the_shard_itself(spark, tmp_path):
    shards = tmp_path / "task-000001" / "shards"
    shards.mkdir(parents=True)
    for stem, ok in (("10000", 0), ("100000", 90)):
        (shards / f"{stem}_stats.json").write_text(f'{{"count": 100, "successes": {ok}}}')
        (shards / f"{stem}.tar").write_bytes(b"")
    sinks.set_aside(spark, shards.parent, "1")
    assert sorted(p.name for p in shards.iterdir()) == ["100000.tar", "100000_stats.json"]


def test_lock_beats_and_is_taken_over_once_stale(tmp_path):
    import os
    import time

    with sinks.TaskLock(tmp_path, "first", stale=60, every=0.05) as lock:
        beat = lock.path / "owner"
        os.utime(beat, (1, 1))
        time.sleep(0.5)
        assert beat.stat().st_mtime > 1000  # the heartbeat touched it
    assert not lock.path.exists()
    stuck = sinks.TaskLock(tmp_path, "gone", every=1e6).__enter__()
    os.utime(stuck.path / "owner", (1, 1))
    with sinks.TaskLock(tmp_path, "second") as now:
        assert now.mine() and not stuck.mine()
        stuck.__exit__()  # the run that lost the lock doesn't remove it
        assert now.mine()
        with pytest.raises(EngineError), sinks.TaskLock(tmp_path, "third"):
            pass
    assert list(tmp_path.iterdir()) == []
