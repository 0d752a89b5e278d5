import datetime
import json
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from rainledger.sources import feeds, manifest, sinks
from rainledger.streaming import grids

D = datetime.date


@pytest.fixture
def rasters(tmp_path):
    dice = np.random.default_rng(1)
    out = {}
    for year, n in ((2000, 366), (2001, 365)):
        grid = dice.uniform(0, 9, (n, 6)).astype("<f4")
        grid[dice.random(grid.shape) < 0.2] = -999
        grid[3, 3] = np.nan
        (tmp_path / f"rain_{year}.grd").write_bytes(grid.tobytes())
        out |= {(D(year, 1, 1) + datetime.timedelta(d), c): None if not grid[d, c] > -998 else float(grid[d, c]) for d in range(n) for c in range(6)}
    (tmp_path / "notes.txt").write_text("no raster")
    return tmp_path, out


def test_rasters(spark, rasters):
    path, want = rasters
    got = feeds.rasters_by_year(spark, str(path), 6)
    assert {(r.day, r.cell): r.value for r in got.collect()} == want
    for low, high in ((D(2000, 12, 30), D(2001, 1, 2)), (D(1999, 1, 1), D(1999, 2, 2))):
        own = {k: v for k, v in want.items() if low <= k[0] <= high}
        pushed = feeds.rasters_by_year(spark, str(path), 6, pushDown="true").where(F.col("day").between(low, high))
        for some in (pushed, feeds.rasters_by_year(spark, str(path), 6, first=str(low), last=str(high))):
            assert {(r.day, r.cell): r.value for r in some.collect()} == own
            assert some.rdd.getNumPartitions() <= 2
        assert got.where(F.col("day").between(low, high)).count() == len(own)
    one, two = got.where("day < DATE'2000-01-03'"), got.where("day > DATE'2001-12-30'")
    assert one.union(two).union(got).count() == 12 + 6 + len(want)  # a DataFrame in several branches of a plan
    assert got.where("day > DATE'2001-12-30' AND cell = 2").count() == 1


def test_days_that_are_not_wanted_are_not_read(spark, rasters):
    path, want = rasters
    reader = feeds._RasterReader({"path": str(path), "cells": "6", "daysPerPartition": "400", "pushDown": "true"})
    rest = list(reader.pushFilters([feeds.GreaterThan(("day",), D(2001, 5, 1)), feeds.LessThanOrEqual(("day",), D(2001, 5, 3)), feeds.EqualTo(("cell",), 1)]))
    assert [type(f).__name__ for f in rest] == ["GreaterThan", "EqualTo"]  # Spark applies these itself
    parts = reader.partitions()
    assert [(p.year, p.first, p.n) for p in parts] == [(2001, 120, 3)]
    assert len(list(reader.read(parts[0]))) == 3
    reader = feeds._RasterReader({"path": str(path), "cells": "6", "pushDown": "true"})
    list(reader.pushFilters([feeds.In(("day",), (D(2000, 1, 1), D(2000, 1, 2), D(2000, 3, 1)))]))
    assert [(p.first, p.n) for p in reader.partitions()] == [(0, 2), (60, 1)]


def test_raster_of_another_size_raises(spark, tmp_path):
    (tmp_path / "rain_2001.grd").write_bytes(b"\0" * 24 * 364)
    with pytest.raises(Exception, match="aren't the days of 2001"):
        feeds.rasters_by_year(spark, str(tmp_path), 6).count()


def test_raster_round_trip(spark, tmp_path):
    rows = [(D(2004, 2, 29), 0, 1.5), (D(2004, 12, 31), 2, None), (D(2005, 1, 1), 1, 0.0), (None, 1, 2.0)]
    assert feeds.write_rasters(spark.createDataFrame(rows, "day date, cell int, value double"), str(tmp_path / "r"), 3) == [2004, 2005]
    got = feeds.rasters_by_year(spark, str(tmp_path / "r"), 3)
    assert got.count() == 3 * (366 + 365)
    assert {tuple(r) for r in got.where("value IS NOT NULL").collect()} == {rows[0], rows[2]}


def test_pages_end_at_the_short_one(spark, tmp_path):
    for k, answer in enumerate([{"data": [{"a": 1}, {"a": 2}]}, [{"a": 3}, {"a": "ü"}], {"result": [{"a": 5}]}, [{"a": "old"}, {"a": "old"}], {"data": []}, {"error": "x"}]):
        (tmp_path / f"p{k}.json").write_text(json.dumps(answer, ensure_ascii=False))
    got = feeds.paged(spark, str(tmp_path), 2)
    assert [(r.page, r.place, json.loads(r.row)["a"]) for r in got.orderBy("page", "place").collect()] == [(0, 0, 1), (0, 1, 2), (1, 0, 3), (1, 1, "ü"), (2, 0, 5)]
    assert got.where("page = 1").count() == 2
    raw = spark.read.format("paged_answers").option("path", str(tmp_path)).load()
    assert raw.rdd.getNumPartitions() == 6
    assert spark.read.format("paged_answers").options(path=str(tmp_path), first=1, last=2).load().rdd.getNumPartitions() == 2  # the others aren't opened
    assert spark.read.format("paged_answers").options(path=str(tmp_path), pushDown="true").load().where("page <= 2").rdd.getNumPartitions() == 3
    (tmp_path / "p2.json").unlink()
    assert feeds.paged(spark, str(tmp_path), 2).where("row LIKE '%old%'").count() == 2  # p4 is the short one now
    (tmp_path / "none").mkdir()
    assert feeds.paged(spark, str(tmp_path / "none"), 2).collect() == []


def test_many_pages_are_dealt_in_runs(spark, tmp_path):
    for k in range(600):
        (tmp_path / f"p{k}.json").write_text(json.dumps([{"a": k}] * (2 if k < 400 else 1)))
    raw = spark.read.format("paged_answers").option("path", str(tmp_path)).load()
    assert raw.rdd.getNumPartitions() <= 256 and raw.count() == 1000
    got = feeds.paged(spark, str(tmp_path), 2)
    assert got.count() == 801 and got.agg(F.max("page")).first()[0] == 400
    assert got.rdd.getNumPartitions() <= 256


def rows_of(raw):
    return raw.select("path", F.explode(F.split("content", "\n")).alias("x")).where("x <> ''")


def test_manifest(spark, tmp_path):
    files, table = tmp_path / "in", str(tmp_path / "table")
    files.mkdir()
    put = lambda k, text: (files / f"{k}.csv").write_text(text)
    stored = lambda: sorted((r.path.rpartition("/")[2], r.x) for r in spark.read.parquet(table).collect())
    opened = []
    parse = lambda raw: rows_of(raw.where(F.lit(opened.append([r.path.rpartition("/")[2] for r in raw.select("path").collect()]) is None)))
    run = lambda: manifest.refresh(spark, str(files), table, parse, "*.csv", parts=2)
    for k in range(6):
        put(k, f"{k}\n{k}b\n")
    assert run() == {"files": 6, "read": 6, "kept": 0}
    assert run() == {"files": 6, "read": 0, "kept": 6} and len(opened) == 1
    put(2, "two\n")
    put(9, "nine")
    (files / "4.csv").unlink()
    assert run() == {"files": 6, "read": 2, "kept": 4} and sorted(opened[1]) == ["2.csv", "9.csv"]
    want = sorted([(f"{k}.csv", v) for k in (0, 1, 3, 4, 5) for v in (str(k), f"{k}b")] + [("2.csv", "two"), ("9.csv", "nine")])
    assert stored() == want  # others of the same part, and of files that are gone, stay
    time.sleep(1.1)
    put(3, "6\n6b\n")  # the same size, another time

    def lost(raw):
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        manifest.refresh(spark, str(files), table, lost, "*.csv", parts=2)
    assert stored() == want
    assert run()["read"] == 1 and opened[2] == ["3.csv"]  # what a lost run left is read again
    assert ("3.csv", "6b") in stored() and ("3.csv", "3") not in stored()
    assert manifest.changed(manifest.listing(spark, str(files), "*.csv"), manifest.Manifest(spark, f"{table}_manifest").known()).count() == 0


def test_grids_arrive_once(spark, tmp_path, monkeypatch):
    path, table, check = (str(tmp_path / x) for x in ("in", "table", "check"))
    (tmp_path / "in").mkdir()
    put = lambda name, *lines: (tmp_path / "in" / name).write_text("\n".join(lines) + "\n")
    stored = lambda: {(str(r.week), r.lat, r.lon): r.value for r in spark.read.parquet(table).collect()}
    seen = []

    def run(each=64):
        q = grids.ingest_grids(spark, path, table, check, files_a_batch=each)
        q.awaitTermination(90)
        seen.append(sum(p["numInputRows"] for p in q.recentProgress))

    put("g_20240101.txt", "1.5 2.5 0.1", "1.5 3.5 NaN", "bad line here", "")
    put("g_20240108.txt", "1.5 2.5 0.2", "1.5 3.5 0.3")
    put("nodate.txt", "1 1 1")
    run(1)
    want = {("2024-01-01", 1.5, 2.5): 0.1, ("2024-01-01", 1.5, 3.5): None, ("2024-01-08", 1.5, 2.5): 0.2, ("2024-01-08", 1.5, 3.5): 0.3}
    assert stored() == want
    run()
    time.sleep(1.1)
    put("again_20240108.txt", "1.5 2.5 0.9", "9 9 0.4")  # one cell anew, one more: the week's other cell stays
    put("g_20240115.txt", "1 2 0.5")
    want |= {("2024-01-08", 1.5, 2.5): 0.9, ("2024-01-08", 9.0, 9.0): 0.4, ("2024-01-15", 1.0, 2.0): 0.5}
    whole = grids.upsert
    fails = lambda *a, **k: whole(*a, **k | {"prepare": lambda df: 1 / 0})
    monkeypatch.setattr(grids, "upsert", fails)
    with pytest.raises(Exception):  # noqa: B017  the stream hands the error of its batch on
        run()
    monkeypatch.setattr(grids, "upsert", whole)
    run()
    assert stored() == want and seen[1] == 0
    batch = str(tmp_path / "at once")
    grids.ingest_grids(spark, path, batch, f"{check}2").awaitTermination(90)
    assert {(str(r.week), r.lat, r.lon): r.value for r in spark.read.parquet(batch).collect()} == want


def test_sorted_and_bucketed_stores(spark, tmp_path):
    df = spark.range(3000).select((F.col("id") * 7919 % 3001).alias("k"), (F.col("id") % 13).alias("d"), F.lit("x").alias("v"))
    path = str(tmp_path / "sorted")
    sinks.write_sorted(df, path, ["d", "k"], 5)
    assert sinks.out_of_order(spark, path, ["d", "k"]) == 0
    names = sorted(x.name for x in (tmp_path / "sorted").glob("part-*"))
    assert len(names) == 5
    one = spark.read.parquet(str(tmp_path / "sorted" / names[1])).agg(F.min("d"), F.max("d")).first()
    assert one[1] - one[0] <= 4  # a file holds a range
    df.repartition(3).write.parquet(str(tmp_path / "unsorted"))
    assert sinks.out_of_order(spark, str(tmp_path / "unsorted"), ["d", "k"]) > 100
    a, b = (sinks.write_bucketed(df.where(c), str(tmp_path / n), ["d"], 4) for n, c in (("a", "k < 2000"), ("b", "k > 1000")))
    joined = a.groupBy("d").agg(F.count("*").alias("n")).join(b.groupBy("d").agg(F.max("k").alias("top")).hint("merge"), "d")
    assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    want = {r.d: (r.n, r.top) for r in df.groupBy("d").agg(F.count_if(F.col("k") < 2000).alias("n"), F.max("k").alias("top")).collect()}
    assert {r.d: (r.n, r.top) for r in joined.collect()} == want
