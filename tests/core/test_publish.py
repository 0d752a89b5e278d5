import json

import pytest

from rainledger.plans import publish as P

COLUMNS = "district int, snapshot string, quadrant string, category string, dep double, source string, dry_weeks long, tier string, pct double, stress string, index_class string"
ROWS = [(1, "2020-05-31", None, None, None, None, None, "insufficient", None, None, "d0"), (1, "2020-08-31", "fine", "Normal", float("nan"), "gridded", 2, "full", 50.5, None, None), (2, "2020-08-31", "double", "Deficient", -30.0, "official", 5, "short", 10.0, "Safe", None)]


def test_run_publishes_step_by_step(spark, tmp_path):
    out = str(tmp_path / "out")
    names = lambda: spark.createDataFrame([(1, "A"), (2, "B, C")], "district int, name string")
    table = lambda rows: lambda: spark.createDataFrame(rows, COLUMNS)
    log, ok = P.run(spark, out, table(ROWS), names)
    assert ok and [x["step"] for x in log] == ["status", "snapshots", "districts", "index", "table"] and all(x["ok"] for x in log)
    rows = [json.loads(x) for f in (tmp_path / "out/snapshots/snapshot=2020-08-31").glob("*.json") for x in f.read_text().splitlines()]
    assert {r["district"]: r["row"] for r in rows} == {1: ["F", "Normal", None, "gridded", "2", "full", "50.5", None, None], 2: ["D", "Deficient", "-30.0", "official", "5", "short", "10.0", "Safe", None]}
    (index,) = [json.loads(x) for f in (tmp_path / "out/index").glob("*.json") for x in f.read_text().splitlines()]
    assert index["snapshots"] == ["2020-05-31", "2020-08-31"] and index["classified"] == {"2020-05-31": 0, "2020-08-31": 2}
    assert index["layer_from"] == {"quadrant": "2020-08-31", "rain": "2020-08-31", "level": "2020-08-31", "stress": "2020-08-31", "index": "2020-05-31"}
    (text,) = [f.read_text().splitlines() for f in (tmp_path / "out/table").glob("*.csv")]
    assert len(text) == 3 and any('"B, C"' in x for x in text)

    def lost():
        raise RuntimeError("no status today")

    log, ok = P.run(spark, out, lost, names)
    assert not ok and [x["ok"] for x in log] == [False, True, True, True, True] and "no status today" in log[0]["error"]
    assert spark.read.parquet(f"{out}/status").count() == 3  # the old one stays
    later = [(1, "2020-11-30", "hidden", *ROWS[1][3:])]
    log, ok = P.run(spark, out, table(later), names, skip=["districts", "table"])
    assert ok and spark.read.parquet(f"{out}/status").count() == 4
    log, ok = P.run(spark, out, table(later), names, only=["index"])
    assert not ok and [x["step"] for x in log] == ["index"]
    with pytest.raises(ValueError, match="nothing"):
        P.run(spark, out, table(later), names, only=["nothing"])
