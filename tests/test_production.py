"""Tasks from plan to DONE against a local server: the sink, the store, the lock, and all of them together."""

import hashlib
import http.server
import json
import os
import tarfile
import threading
import time
from collections import Counter

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from shardwright import cli
from shardwright.errors import EngineError
from shardwright.operators import ingest, production
from shardwright.sources import shards, sinks, stats

PNG = b"\x89PNG\r\n\x1a\n" + (13).to_bytes(4, "big") + b"IHDR" + (640).to_bytes(4, "big") + (480).to_bytes(4, "big") + b"\x08\x02\0\0\0IEND"


class _Site(http.server.BaseHTTPRequestHandler):
    asked: Counter = Counter()
    broken = False

    def do_GET(self):
        self.asked[self.path] += 1
        bad = self.broken or self.path.endswith("9")
        self.send_response(503 if self.broken else 404 if bad else 200)
        body = b"" if bad else PNG + self.path.encode()
        self.send_header("Content-Length", str(len(body)))
        self.end_headers()
        self.wfile.write(body)

    def log_message(self, *args):
        pass


@pytest.fixture
def site():
    pytest.importorskip("urllib3")
    _Site.asked, _Site.broken = Counter(), False
    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), _Site)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}"
    server.shutdown()


def tree(root):
    return {str(p.relative_to(root)): p.read_bytes() for p in sorted(root.rglob("*")) if p.is_file() and not p.name.endswith(".crc")}


def samples(spark, n=40, fail=None):
    df = spark.range(n).select(
        (F.col("id") % 2).alias("task"), F.expr("id div 10").alias("shard"), F.format_string("%05d%04d", F.expr("id div 10"), "id").alias("key"), F.concat(F.lit("http://x/"), "id").alias("url"),
        F.when(F.col("id") % 7 != 0, F.concat(F.lit("caption "), "id")).alias("caption"), F.when(F.col("id") % 5 == 4, "failed_to_download").otherwise("success").alias("status"),
        F.when(F.col("id") % 5 == 4, "HTTP Error 404: Not Found").alias("error_message"), F.when(F.col("id") % 5 != 4, F.concat(F.lit(PNG), F.col("id").cast("string").cast("binary"))).alias("payload"),
    )
    if fail is not None:
        df = df.withColumn("caption", F.when(F.col("key") == fail, F.raise_error(F.lit("lost"))).otherwise(F.col("caption")))
    return df


def test_shards_are_whole_and_the_same_however_rows_are_dealt(spark, tmp_path):
    shards.write_shards(samples(spark), str(tmp_path / "a"))
    shards.write_shards(samples(spark).repartition(7), str(tmp_path / "b"))
    once = tree(tmp_path / "a")
    assert once == tree(tmp_path / "b") and len(once) == 3 * 8
    shards.write_shards(samples(spark), str(tmp_path / "a"))  # over what is there
    assert tree(tmp_path / "a") == once
    base = tmp_path / "a" / "task-000001" / "shards"
    with tarfile.open(base / "00000.tar") as t:
        assert t.getnames() == [f"0000{k:05d}{s}" for k in (1, 3, 5, 7) for s in ((".jpg", ".txt", ".json") if k != 7 else (".jpg", ".json"))]
        meta = json.loads(t.extractfile("000000001.json").read())
    assert (meta["width"], meta["original_height"], meta["caption"]) == (640, 480, "caption 1")
    rows = pq.read_table(base / "00000.parquet").to_pylist()
    assert [r["key"] for r in rows] == [f"0000{k:05d}" for k in (1, 3, 5, 7, 9)] and rows[-1]["width"] is None and rows[0]["original_width"] == 640
    said = json.loads((base / "00000_stats.json").read_text())
    assert said == {"count": 5, "successes": 4, "failed_to_download": 1, "failed_to_resize": 0, "status_dict": {"HTTP Error 404: Not Found": 1, "success": 4}}
    assert {r["successes"] for r in stats.read_stats(spark, str(tmp_path / "a")).collect()} == {4}


def test_a_failed_write_leaves_nothing(spark, tmp_path):
    with pytest.raises(Exception):  # noqa: B017
        shards.write_shards(samples(spark, fail="000020027"), str(tmp_path))
    assert tree(tmp_path) == {}
    with pytest.raises(Exception):  # noqa: B017
        shards.write_shards(samples(spark), str(tmp_path), [(str(tmp_path / "RUNNING.lock.1"), "me")])
    assert tree(tmp_path) == {}


def test_store_is_resumed(spark, tmp_path, site, monkeypatch):
    urls = spark.range(60).select(F.col("id").alias("pos"), F.concat(F.lit(f"{site}/"), "id").alias("url"))
    store = str(tmp_path / "store")
    assert ingest.fetch_into(urls.where("pos < 25"), store, threads=4, bucket_urls=8) == {"fetched": 25, "skipped": 0}
    assert ingest.fetch_into(urls, store, threads=4, bucket_urls=8) == {"fetched": 35, "skipped": 0}
    assert set(_Site.asked.values()) == {1}
    got = {r.pos: r for r in ingest.stored(spark, store).collect()}
    assert len(got) == 60 and got[9].error_message == "HTTP Error 404: Not Found" and got[9].payload is None
    assert got[3].sha256 == hashlib.sha256(PNG + b"/3").hexdigest()
    # a task that runs again, as after a lost executor, asks for nothing that its first attempt stored
    monkeypatch.setattr(ingest, "stored", lambda spark, _: spark.createDataFrame([], "pos long"))
    assert ingest.fetch_into(urls, store, threads=4, bucket_urls=8)["fetched"] < 60  # buckets of the second run only
    assert ingest.fetch_into(urls, store, threads=4, bucket_urls=8) == {"fetched": 0, "skipped": 60}


def test_hosts_stay_together_and_large_ones_are_dealt(spark):
    rows = [(k, f"http://big.x/{k}") for k in range(500)] + [(1000 + k, f"http://h{k % 20}.x/{k}") for k in range(100)] + [(5000, "no url")]
    got = ingest.bucketed(spark.createDataFrame(rows, "pos long, url string"), 50).groupBy(F.regexp_extract("url", "//([^/]*)", 1).alias("host")).agg(F.countDistinct("bucket").alias("n")).collect()
    found = {r.host: r.n for r in got}
    assert found.pop("big.x") > 4 and set(found.values()) == {1}


def test_production(spark, tmp_path, site):
    meta, root = tmp_path / "meta", tmp_path / "root"
    meta.mkdir()
    for f, n in (("a", 25), ("b", 30)):
        pq.write_table(pa.table({"url": [f"{site}/{f}{k}" for k in range(n)], "text": [f"caption {f}{k}" for k in range(n)]}), meta / f"{f}.parquet")
    plan = str(tmp_path / "plan.json")
    assert cli.main(["plan", str(meta), "--per-task", "20", "--json", plan], spark) == 0
    run = ["produce", str(root), "--plan", plan, "--metadata", str(meta), "--per-shard", "8", "--threads", "4"]
    _Site.broken = True
    assert cli.main([*run, "--tasks", "0-1"], spark) == 1
    assert not (root / "task-000000" / "DONE.json").exists() and json.loads((root / "task-000000" / "health.json").read_text())["cause"] == "low_yield"
    _Site.broken, _Site.asked = False, Counter()
    assert cli.main([*run, "--tasks", "0-2"], spark) == 0
    assert sum(_Site.asked.values()) == 55 and set(_Site.asked.values()) == {1}
    assert len(list((root / "task-000000").glob("attempt-*/*.tar"))) == 3  # the bad shards were set aside
    done = json.loads((root / "task-000001" / "DONE.json").read_text())
    assert (done["candidates"], done["partial"], done["settings"]["threads"]) == (20, False, 4)
    rows = [r for k in range(3) for r in pq.read_table(root / "task-000001" / "shards" / f"{k:05d}.parquet").to_pylist()]
    assert [r["caption"] for r in rows] == [f"caption a{k}" for k in range(20, 25)] + [f"caption b{k}" for k in range(15)]
    assert [r["key"] for r in rows][7:9] == ["000000007", "000010000"] and not list(root.glob(".*"))
    before = tree(root)
    assert cli.main([*run, "--tasks", "0-2"], spark) == 0 and tree(root) == before and sum(_Site.asked.values()) == 55
    # a shard that got lost comes back, and nothing else is asked for
    (root / "task-000002" / "DONE.json").unlink()
    for p in (root / "task-000002" / "shards").glob("00000*"):
        p.unlink()
    assert cli.main([*run, "--tasks", "2"], spark) == 0
    assert sum(_Site.asked.values()) == 63
    now = tree(root)
    assert {k: v for k, v in now.items() if "shards" in k} == {k: v for k, v in before.items() if "shards" in k}
    assert cli.main(["report", str(root)], spark) in (0, 1) and cli.main([*run, "--tasks", "2-3"], spark) == 2  # no such task
    with sinks.TaskLock(root / "task-000000", "other"):
        (root / "task-000000" / "DONE.json").unlink()
        assert cli.main([*run, "--tasks", "0"], spark) == 2


def test_archive(tmp_path):
    assert production.archived(str(tmp_path), "x") is None
    for n in (1, 2):
        (tmp_path / "x").mkdir()
        (tmp_path / "x" / "f").write_text(str(n))
        assert production.archived(str(tmp_path), "x").name == f"x.attempt-{n}"
    assert (tmp_path / "x.attempt-1" / "f").read_text() == "1"


def test_only_one_of_two_runs_takes_a_stale_lock_over(tmp_path):
    gone = sinks.TaskLock(tmp_path, "gone", every=1e6).__enter__()
    os.utime(gone.path / "owner", (1, 1))
    late, quick = sinks.TaskLock(tmp_path, "late", every=1e6), sinks.TaskLock(tmp_path, "quick", every=1e6)
    saw = late.seen()  # both see the stale beat
    with quick:
        with pytest.raises(EngineError):
            late.claim(saw)
        assert quick.mine() and not late.mine() and not gone.mine()
    with sinks.TaskLock(tmp_path, "next", every=1e6) as now:  # the quick one is through; the late one still has its old number
        with pytest.raises(EngineError):
            late.claim(saw)
        assert now.mine() and not late.mine()
    assert list(tmp_path.iterdir()) == []


def test_many_runs_and_one_lock(tmp_path):
    inside, most, refused, guard = [0], [0], [0], threading.Lock()

    def run(k):
        try:
            with sinks.TaskLock(tmp_path, f"run {k}", every=1e6) as lock:
                with guard:
                    inside[0] += lock.mine()
                    most[0] = max(most[0], inside[0])
                time.sleep(0.002)
                with guard:
                    inside[0] -= 1
        except EngineError:
            with guard:
                refused[0] += 1

    for _ in range(20):
        gone = sinks.TaskLock(tmp_path, "gone", every=1e6).__enter__()
        os.utime(gone.path / "owner", (1, 1))
        crowd = [threading.Thread(target=run, args=(k,)) for k in range(12)]
        [t.start() for t in crowd]
        [t.join() for t in crowd]
    assert most[0] == 1 and refused[0] > 0


def test_experiment(spark, tmp_path, site, capsys):
    pq.write_table(pa.table({"url": [f"{site}/{k}" for k in range(200)]}), tmp_path / "u.parquet")
    to = tmp_path / "exp" / "levels"
    base = [str(tmp_path / "u.parquet"), "--levels", "1,3,1", "--urls", "60", "--per-shard", "6", "--to", str(to), "--threads", "2"]
    assert cli.main(["check", *base], spark) == 0
    assert cli.main(["check", *base[:2], "1,60", *base[3:]], spark) == 1 and cli.main(["check", *base[:4], "90", *base[5:]], spark) == 1
    assert cli.main(["run", *base[:4], "90", *base[5:]], spark) == 2 and not to.exists()  # refused before anything is written
    for attempt in (0, 1):
        assert cli.main(["run", *base], spark) in (0, 1)
        assert sum(_Site.asked.values()) == 180 * (attempt + 1)
    assert set(_Site.asked.values()) == {2} and (tmp_path / "exp" / "levels.attempt-1" / "run3_p1" / "wall_seconds").exists()
    capsys.readouterr()
    assert cli.main(["runs", str(to)], spark) in (0, 1)
    said = json.loads(capsys.readouterr().out)
    assert [(r["run"], r["processes"], r["candidates"], r["successes"]) for r in said["runs"]] == [(1, 1, 60, 54), (2, 3, 60, 54), (3, 1, 60, 54)]
    assert said["yield_preserved"] and said["dns_stable"] and said["scales"] is not None and all(r["successes_per_sec"] > 0 for r in said["runs"])
    assert cli.main(["runs", str(tmp_path)], spark) == 2


def test_phases(spark, tmp_path, capsys):
    def phase(name, wall, expected, *nodes):
        for k, good in enumerate(nodes):
            d = tmp_path / name / f"node{k}" / "run1" / "shards"
            d.mkdir(parents=True)
            for shard in range(2):
                (d / f"{shard:05d}_stats.json").write_text(json.dumps({"count": 100, "successes": good, "status_dict": {"success": good, "HTTP Error 404: Not Found": 100 - good}}))
        (tmp_path / name / "wall_seconds").write_text(str(wall))
        if expected is not None:
            (tmp_path / name / "expected_nodes").write_text(str(expected))

    phase("1-one", 2, 1, 65)
    phase("2-two", 2.2, 2, 65, 64)
    phase("3-lost", 1, 2, 10)
    phase("4-one", 2, None, 64)
    assert cli.main(["phases", str(tmp_path)], spark) == 0
    said = json.loads(capsys.readouterr().out)
    assert [(r["phase"], r["nodes"], r["candidates"], r["successes"]) for r in said["runs"]] == [("1-one", 1, 200, 130), ("2-two", 2, 400, 258), ("4-one", 1, 200, 128)]
    assert said["distribution_neutral"] and not said["rejected"] and said["multi_node_rate"] == pytest.approx(258 / 2.2)


def test_blur_is_refused(spark, tmp_path):
    with pytest.raises(EngineError):
        (tmp_path / "p.json").write_text('{"tasks": [{"task_id": 0, "rows": 1, "pieces": []}]}')
        production.produce(spark, str(tmp_path / "p.json"), str(tmp_path), 0, 0, settings=production.Settings(blur=1))
