"""Mechanisms that don't gather: selection of ranks, as-of lookup, stripes of pieces, strict concatenation."""

import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shardwright.errors import ManifestError
from shardwright.functions import model
from shardwright.operators import distributions, partition, planning


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.one_of(st.floats(-1e9, 1e9), st.sampled_from([0.0, 1.0, 1e-300, 1e300, 5.0])), min_size=1, max_size=60))
def test_selection_is_exact(spark, values):
    rows = spark.createDataFrame([(v,) for v in [*values, None]], "v double")
    total, found = distributions.ranked(rows, "v", lambda n: range(n))
    assert total == len(values) and [found[k] for k in range(total)] == sorted(values)


def test_selection_of_many_values(spark, monkeypatch):
    rows = spark.range(2_000_000).select((F.pmod(F.xxhash64("id"), F.lit(10**12)) / 10**12).alias("x"))
    got = distributions.quantiles(rows, "x", [0.0, 0.25, 0.5, 0.99, 1.0])
    want = rows.agg(F.percentile("x", [0.0, 0.25, 0.5, 0.99, 1.0])).first()[0]
    assert np.allclose(got, want, rtol=0, atol=1e-15)
    monkeypatch.setattr(distributions, "BINS", 2)  # the least progress a pass can make
    skewed = spark.createDataFrame([(float(10**k), k + 1) for k in range(12)], "x double, n long")
    assert distributions.quantiles(skewed, "x", [0.5], "n") == [10.0**8]
    assert distributions.quantiles(skewed.where("false"), "x", [0.5]) == [None]


def test_percentiles_of_rows_and_of_frequencies(spark):
    sizes = spark.createDataFrame([(10, 99), (20, 99), (0, 5), (None, 3)], "w long, h long")
    for rows in (distributions.sides(sizes), distributions.side_counts(sizes)):
        assert {r.p: r.short_side for r in distributions.percentiles(rows, "short_side").collect()}[50] == 15
    assert distributions.percentiles(distributions.sides(sizes.where("w IS NULL")), "short_side").count() == 0


@pytest.mark.parametrize("pieces", [1, 2, 64])
def test_as_of(spark, pieces):
    r = random.Random(pieces)
    steps = [(r.randrange(0, 400) / 4, r.random()) for _ in range(300)] + [(None, 1.0), (50.0, None)]
    asked = [r.randrange(-40, 500) / 4 for _ in range(500)] + [50.0] * 300 + [None]
    best = {}
    for t, v in steps:
        if t is not None:
            best[t] = max((x for x in (best.get(t), v) if x is not None), default=None)
    want = [None if a is None or not (k := [t for t in best if t <= a]) else best[max(k)] for a in asked]
    df = spark.createDataFrame(list(enumerate(asked)), "i long, t double").repartition(5)
    table = spark.createDataFrame(steps, "seconds double, share double").repartition(3)
    out = model.as_of(df, "t", table, "seconds", "share", "got", pieces)
    assert {x.i: x.got for x in out.collect()} == dict(enumerate(want))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Cross" not in plan and model.as_of(df, "t", table.where("false"), "seconds", "share", "got").where("got IS NOT NULL").count() == 0


def test_many_pieces_of_one_file_are_looked_up_by_stripes(spark):
    cut = spark.range(10_000).select((F.col("id") % 7).alias("task"), (F.col("id") * 30).alias("seq"), F.lit("f").alias("path"), (F.col("id") * 30).alias("start"), (F.col("id") * 30 + 20).alias("end"))
    cut = cut.unionByName(spark.createDataFrame([(9, 0, "g", 5, 100_000), (9, 0, "g", 7, 7)], cut.schema))
    rows = spark.range(300_000).select(F.lit("f").alias("path"), F.col("id").alias("row_index")).union(spark.range(120_000).select(F.lit("g"), "id"))
    got = partition.manifest_of(rows, cut, 1000)
    assert got.where("path = 'f'").count() == 200_000 and got.where("path = 'g'").count() == 99_995
    assert got.where("path = 'f' AND (task <> row_index div 30 % 7 OR place <> row_index)").count() == 0
    assert got.where("path = 'g'").agg(F.min("place"), F.max("place")).first()[:] == (0, 99_994)
    stripes = cut.select(F.explode(F.sequence(F.expr("start div 1000"), F.expr("greatest(start, `end` - 1) div 1000"))).alias("k"), "path").groupBy("path", "k").count().agg(F.max("count")).first()[0]
    assert stripes <= 35  # of 10,000 pieces, so few meet in one key


def test_concatenation_is_strict(spark):
    a, b = spark.createDataFrame([(1, "x")], "pos long, url string"), spark.createDataFrame([(1, "y")], "pos long, url string")
    assert [(r.part, r.url) for r in partition.concatenated([a, b]).orderBy("part").collect()] == [(0, "x"), (1, "y")]
    for bad in (b.withColumn("more", F.lit(1)), b.select("url", "pos"), b.withColumn("pos", F.col("pos").cast("int"))):
        with pytest.raises(ManifestError):
            partition.concatenated([a, bad])
    assert planning.crude_node_hours(spark.createDataFrame([(2_500_000,)], "total_rows long")).first().node_hours == 2.5
