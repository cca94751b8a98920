"""Tar ranges, URL lists in many splits, footers and the size scan, on real files."""

import io
import json
import random
import tarfile

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from shardwright import cli
from shardwright.sources import listing, stats, tar, urllist


def make_tar(path, members):
    path.parent.mkdir(parents=True, exist_ok=True)
    with tarfile.open(path, "w", format=tarfile.PAX_FORMAT) as t:
        for name, body in members:
            info = tarfile.TarInfo(name)
            info.size = len(body)
            t.addfile(info, io.BytesIO(body))


def members(n, seed, long_names=False):
    r = random.Random(seed)
    out = []
    for k in range(n):
        key = ("k" * 120 if long_names else "k") + f"{k:05d}"
        for suffix in r.sample([".jpg", ".txt", ".json"], r.randrange(1, 4)):
            out.append((key + suffix, bytes(r.randrange(97, 123) for _ in range(r.randrange(0, 900)))))
    return out


def by_hand(found):
    """key -> (first place, image, caption, meta)"""
    out = {}
    for seq, (name, body) in enumerate(found):
        key, _, suffix = name.partition(".")
        row = out.setdefault(key, [seq, None, None, None])
        row[{"jpg": 1, "txt": 2, "json": 3}[suffix]] = body if suffix == "jpg" else body.decode()
    return {k: tuple(v) for k, v in out.items()}


@pytest.fixture(scope="module")
def tree(tmp_path_factory):
    root = tmp_path_factory.mktemp("tars")
    tidy, long_, scattered = members(60, 1), members(30, 2, True), members(40, 3)
    random.Random(4).shuffle(scattered)
    held = {("task-000000", "00000"): tidy, ("task-000000", "00001"): long_, ("task-000001", "00000"): scattered, ("task-000001", "00001"): []}
    for (task, shard), found in held.items():
        make_tar(root / task / "shards" / f"{shard}.tar", found)
    return root, held


def test_ranges_cover_a_tar_once(tree):
    root, held = tree
    for (task, shard), found in held.items():
        path = str(root / task / "shards" / f"{shard}.tar")
        whole = list(tar.members_between(path))
        assert [r[2] + r[3] for r in whole] == [n for n, _ in found] and [r[6] for r in whole] == [b for _, b in found]
        for size in (1, 3000, 20_000, 1 << 30):
            ranges = tar.member_ranges(path, size)
            assert [r for b, e, s, _ in ranges for r in tar.members_between(path, b, e, s)] == whole
            keys = [{r[2] for r in tar.members_between(path, b, e, s)} for b, e, s, _ in ranges]
            if found and ranges[0][3]:
                assert sum(map(len, keys)) == len(set().union(*keys))  # no key is in two
                assert size < 1 << 30 or len(ranges) == 1


def test_members_and_samples(spark, tree, monkeypatch):
    root, held = tree
    monkeypatch.setattr(tar, "RANGE_BYTES", 5000)
    monkeypatch.setattr(tar.tar_index, "__defaults__", (5000, None))
    monkeypatch.setattr(tar, "BATCH_BYTES", 2000)
    got = tar.read_members(spark, str(root))
    assert got.rdd.getNumPartitions() > 8  # one tar uses several tasks
    assert sorted((r.task, r.shard, r.seq, r.key + r.suffix, bytes(r.payload)) for r in got.collect()) == sorted((*k, n, *m) for k, found in held.items() for n, m in enumerate(found))
    assert {r.payload for r in tar.read_members(spark, str(root), payload=False).collect()} == {None}
    for first in (None, 1, 7):
        want = {}
        for k, found in held.items():
            rows = sorted(by_hand(found).items(), key=lambda x: x[1][0])[:first]
            want |= {(*k, key): row for key, row in rows}
        out = tar.read_samples(spark, str(root), first)
        assert {(r.task, r.shard, r.key): (r.seq, r.image and bytes(r.image) if r.image != b"" else b"", r.caption, r.meta) for r in out.collect()} == want
        assert tar.samples(tar.read_members(spark, str(root), first=first), first).count() == len(want)


def test_nothing_is_shuffled_after_pairs_are_read(spark, tree):
    root, _ = tree
    plan = tar.read_samples(spark, str(root / "task-000000"))._jdf.queryExecution().optimizedPlan().toString()
    above = plan[: plan.index("MapInArrow")]
    assert not any(word in above for word in ("Repartition", "Aggregate", "Join", "Sort"))


def test_format(spark, tree):
    root, held = tree
    spark.dataSource.register(tar.ShardTar)
    assert spark.read.format("shard_tar").load(str(root)).where(F.col("shard") == "00001").count() == len(held[("task-000000", "00001")])


# lists, footers, sizes


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300b")
    spark.conf.set("spark.sql.files.openCostInBytes", "10b")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def test_positions_are_the_same_in_any_splits(spark, tmp_path, small_splits):
    r = random.Random(6)
    lines = ["id\turl", *(f"{k}\t http://h/{'x' * r.randrange(0, 700 if k % 50 == 0 else 20)}{k} \r" if r.random() < 0.9 else str(k) * r.randrange(2) for k in range(600))]
    (tmp_path / "l.tsv").write_bytes("\n".join(lines).encode())
    assert spark.read.text(str(tmp_path / "l.tsv")).rdd.getNumPartitions() > 20
    got = [(x.pos, x.url) for x in urllist.read_urls(spark, str(tmp_path / "l.tsv")).orderBy("pos").collect()]
    assert got == [(k, f[1].strip()) for k, line in enumerate(lines) if k and len(f := line.split("\t")) > 1]
    (tmp_path / "d").mkdir()
    for name, n in (("b", 3), ("a", 40), ("c", 1)):
        (tmp_path / "d" / name).write_text("".join(f"http://{name}/{k}\n" for k in range(n)))
    got = [x.line for x in urllist.numbered_lines(spark, str(tmp_path / "d")).orderBy("pos").collect()]
    assert got == [f"http://{name}/{k}" for name, n in (("a", 40), ("b", 3), ("c", 1)) for k in range(n)]


def test_footers_are_read_in_tasks(spark, tmp_path, monkeypatch):
    for k in range(5):
        pq.write_table(pa.table({"url": ["u"] * k, "n": list(range(k))}), tmp_path / f"{k}.parquet")
    (tmp_path / "bad.parquet").write_bytes(b"PAR1 damaged")
    monkeypatch.setattr(listing.pq, "ParquetFile", None)  # the driver opens no file
    got = {r.path.rsplit("/", 1)[1]: (r.rows, r.names) for r in listing.footers(spark, tmp_path).collect()}
    assert got.pop("bad.parquet") == (None, None) and got == {f"{k}.parquet": (k, ["url", "n"]) for k in range(5)}
    assert listing.describe(spark, tmp_path) == {"files": 6, "rows": 10, "columns": ["url", "n"], "url_column": "url", "error": None}


def test_sizes_of_real_shards(spark, tmp_path, capsys):
    for task, shard, size, ok in (("task-000000", "shards/00000", 5000, 10), ("task-000000", "shards/00001", 9000, 20), ("task-000000", "shards/00002", 7, 1), ("task-000001", "00000", 4000, 4), ("task-000002", "shards/00000", 1000, 1)):
        path = tmp_path / task / f"{shard}.tar"
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(b"x" * size)
        path.with_name(path.stem + "_stats.json").write_text(f'{{"count": 30, "successes": {ok}}}')
    aside = tmp_path / "task-000000" / "attempt-1"
    aside.mkdir()
    (aside / "00000.tar").write_bytes(b"x")
    (tmp_path / "task-000001" / "00001_stats.json").write_text('{"count": 3, "successes": 3}')  # no tar
    (tmp_path / "task-000001" / "00002.tar").write_bytes(b"xx")  # no statistics
    got = sorted(tuple(r) for r in stats.measured_shards(spark, str(tmp_path), 2, 2).collect())
    assert got == [("task-000000", "00000", 5000, 10), ("task-000000", "00001", 9000, 20), ("task-000001", "00000", 4000, 4)]
    assert cli.main(["size", str(tmp_path), "--tasks", "2", "--shards", "2"], spark) == 0
    said = json.loads(capsys.readouterr().out)
    assert (said["bytes"], said["images"], said["largest_task"]) == (18000, 34, "task-000001") and len(said["tasks"]) == 2
    assert cli.main(["size", str(aside)], spark) == 2
