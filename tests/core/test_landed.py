import json
import math
from datetime import date

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from rainledger.functions import columns as C
from rainledger.functions import names as N
from rainledger.sources import landed as L
from rainledger.sources import sinks as S


def one(spark, value, kind, column):
    return spark.createDataFrame([(value,)], f"x {kind}").select(column.alias("y")).first().y


def test_names(spark):
    x = F.col("x")
    assert one(spark, "Ahmadābād Dist. & Ｘ", "string", N.name_key(x)) == "ahmadabadandx"
    assert [one(spark, v, "string", N.state_key(x)) for v in ("Andaman & Nicobar Islands", "DAMAN & DIU", "Goa")] == ["andamanandnicobar", "dnhdd", "goa"]
    assert one(spark, " JAMMU AND KASHMIR (ut)", "string", N.title(x)) == "Jammu and Kashmir (Ut)"
    assert one(spark, " A&N - Islands ", "string", N.slug(x)) == "A_N_Islands"
    assert one(spark, "Telemetry", "string", N.well_key(F.lower(x), F.lit(12.34565), F.lit(77.0), F.lit("site"))) == "t:12.3456,77.0000:site"
    assert tuple(one(spark, "PERIOD: 01-06-2024 to 07-09-2024", "string", N.period(x))) == (date(2024, 6, 1), date(2024, 9, 7))
    assert one(spark, "31-02-2024 To 01-03-2024", "string", N.period(x)) is None
    assert [one(spark, d, "date", N.season_of(x)) for d in (date(2024, 6, 1), date(2024, 10, 1), date(2024, 6, 2))] == ["SW", "NE", None]
    ends = [("2023-06-01", "2023-09-30"), ("2023-06-01", "2023-09-29"), ("2023-06-02", "2023-09-30"), ("2023-10-01", "2023-12-31"), ("2022-10-01", "2023-12-31"), (None, "2023-09-30")]
    assert [one(spark, a, "string", N.finished_season(x.cast("date"), F.lit(b).cast("date"))) for a, b in ends] == ["SW", None, None, "NE", None, None]
    assert [one(spark, y, "int", N.days_in_year(x)) for y in (1900, 2000, 2023)] == [365, 366, 365]
    assert [one(spark, v, "string", N.coded(x, N.OFFICIAL_CODES)) for v in ("LD", "ND", None)] == ["Large Deficient", None, None]
    assert tuple(one(spark, [float(i) for i in range(1, 10)], "array<double>", N.odds(x))) == (10.0, 5.0, 30.0)


def test_windows_and_verdicts(spark):
    x = F.col("x")
    weeks = [tuple(w) for w in one(spark, date(2023, 6, 1), "date", C.window_weeks(x, F.lit("2023-09-30").cast("date")))]
    assert weeks[0] == (2023, 23) and weeks[-1] == (2023, 39) and len(weeks) == 17  # 4 June to 30 September
    late = [tuple(w) for w in one(spark, date(2023, 10, 1), "date", C.window_weeks(x, F.lit("2024-01-10").cast("date")))]
    assert (2023, 52) in late and late[-1] == (2024, 1)
    assert [tuple(one(spark, d, "date", C.current_cycle(x))) for d in (date(2024, 1, 31), date(2024, 2, 1), date(2024, 12, 1))] == [(2023, "NOV"), (2024, "JAN"), (2024, "NOV")]
    q = spark.sql("SELECT * FROM VALUES ('Deficient', 30, null), ('Normal', 14, true), (null, 30, null), ('Normal', 30, true), ('Normal', null, null) t(c, d, s)")
    got = [tuple(r[0]) for r in q.select(C.rain_verdict(F.col("c"), F.col("d"), F.col("s"))).collect()]
    assert got == [(True, None), (None, "season_just_started"), (None, "no_rain_data"), (True, None), (False, None)]
    q = spark.sql("SELECT * FROM VALUES ('full', true), ('level_only', true), (null, null) t(t, l)")
    assert [tuple(r[0]) for r in q.select(C.level_verdict(F.col("t"), F.col("l"))).collect()] == [(True, None), (None, "gw_level_only"), (None, "gw_missing")]
    q = spark.sql("SELECT * FROM VALUES (-30.0D, 'Deficient', 5.0D), (null, null, -19.5D), (null, null, null) t(o, c, g)")
    assert [tuple(r[0]) for r in q.select(C.headline(F.col("o"), F.col("c"), F.col("g"))).collect()] == [(-30.0, "Deficient", "official"), (-20.0, "Deficient", "gridded"), (None, None, None)]
    assert one(spark, date(2024, 2, 1), "date", C.whole_months(x, F.lit("2024-02-29").cast("date"))) and not one(spark, date(2024, 2, 1), "date", C.whole_months(x, F.lit("2024-02-28").cast("date")))


def test_answers_of_any_shape(spark, tmp_path):
    rows = [{"locationName": "A", "locationUUID": "1", "category": {"total": "safe", "poor_quality": "salinity"}, "stageOfExtraction": {"total": 61.239}, "draftData": None}, {"locationName": " Total ", "locationUUID": "2"}, {"locationName": "B", "locationUUID": ""}, {"locationName": "C", "locationUUID": "3", "category": "critical", "stageOfExtraction": 7}, {"locationName": "D", "locationUUID": "4", "category": "new word"}]
    (tmp_path / "a.json").write_text(json.dumps(rows[:3]))
    (tmp_path / "b.json").write_text(json.dumps({"data": "none", "content": rows[3:]}))
    (tmp_path / "c.json").write_text("not json")
    got = L.real_rows(L.answers(spark, str(tmp_path / "*.json")).select(*L.assessment(F.col("row"))), "name", "key").orderBy("key").collect()
    assert [(r.name, r.category, r.poor_quality, r.stage_pct, r.extraction) for r in got] == [("A", "Safe", "Saline", 61.24, None), ("C", "Critical", None, 7.0, None), ("D", "new word", None, None, None)]
    (tmp_path / "places").mkdir()
    (tmp_path / "places/s.json").write_text(json.dumps({"result": [{"stateName": "S", "statecode": "", "stateCode": "9", "districts": [{"districtname": "X", "districtcode": 4}, {"districtname": ""}]}]}))
    assert [tuple(r) for r in L.nested_places(spark, str(tmp_path / "places")).collect()] == [("S", "9", "X", "4")]


LINES = """India Meteorological Department
PERIOD: 01-06-2024 to 07-09-2024
GANGETIC PLAIN 10.2 3
S.No name
1 NORTH 24 PARGANAS 13.8 9.4 47% E 113.8 99.4 14% N
2 NADIA 9.4 ND 1.0 2.0 -50% D
LADAKH (UT) 5
3 LEH ND ND
"""


def test_line_grammar(spark, tmp_path):
    (tmp_path / "t.txt").write_text(LINES)
    lines = L.numbered_lines(spark, str(tmp_path / "t.txt"))
    rows = L.under_headings(lines, "file", "line_no", "line", [("GANGETIC PLAIN", "WEST BENGAL")], "^(India Meteorological|PERIOD|S.No)")
    got = L.official_rows(rows, "row").orderBy("line_no").collect()
    assert [(r.name, r.group, r.place) for r in got] == [("NORTH 24 PARGANAS", "GANGETIC PLAIN", "WEST BENGAL"), ("NADIA", "GANGETIC PLAIN", "WEST BENGAL"), ("LEH", "GANGETIC PLAIN", "LADAKH")]
    assert tuple(got[0].day) == (13.8, 9.4, 47.0, "E") and tuple(got[0].period) == (113.8, 99.4, 14.0, "N")
    assert tuple(got[1].day) == (None, 9.4, None, "ND") and tuple(got[1].period) == (1.0, 2.0, -50.0, "D")
    assert tuple(got[2].day) == (None, None, None, "ND")
    table = "head\n1 NORTH\nEAST (X) -5 3 ND\n2 SOUTH 1 2 -44\nfoot 3\n"
    assert [tuple(r) for r in one(spark, table, "string", L.cumulative_last(F.col("x")))] == [(1, "NORTH EAST (X)", None, 3), (2, "SOUTH", -44, 3)]
    table = "1 A B\nfoot note\n5 6\n2 NORTH 24 PARGANAS 1 ND -3\n3 WEST\n(OLD)\n4 -5\n4 ONE 7\nTWO 8 9"
    assert [tuple(r) for r in one(spark, table, "string", L.cumulative_last(F.col("x")))] == [(2, "NORTH 24 PARGANAS", -3, 3), (3, "WEST (OLD)", -5, 2), (4, "ONE 7 TWO", 9, 2)]


def test_table_rows():
    of = lambda body: L.table_rows(f'<p><table id="t">{body}</table><table id=u><tr><td>no', "t", "tip")
    assert of("<tr><td>a&amp;b<br>c</td><th> d \n e</th></tr>") == [["a&bc", "d e"]]
    assert of("<tr><td>a<td>b<tr><td>c") == [["a", "b"], ["c"]]  # ends that are left out
    assert of('<tr><td>a<table><tr><td>in<td>ner</table>z<td>b') == [["ainnerz", "b"]]
    assert of('<tr><td>a<i class="x tip">h<b>i</b><img src="a>b">d</i>e<!-- <td>no --></td></tr>') == [["ae"]]
    assert of("<thead><tr><th>h</thead><tr><td/><td>5 < 6</td>") == [["h"], ["", "5 < 6"]]
    assert L.table_rows("", "t", "tip") == [] and L.table_rows("<table id=t>", "t", "tip") == []


def test_tables_boundaries_and_archives(spark, tmp_path):
    page = '<table id="x"><tr><td>no</td></tr></table><table class=a id="probs"><tr><th>Season</th><th>A<span class="tooltip">hide <b>me</b></span></th></tr><tr><td>JJA<!-- c --></td><td>−5</td></tr></table>'
    pages = spark.createDataFrame([(1, page), (2, None)], "k int, html string")
    assert [(r.k, r.row_no, r.cells) for r in L.html_tables(pages, "k", "html", "probs").orderBy("row_no").collect()] == [(1, 0, ["Season", "A"]), (1, 1, ["JJA", "-5"])]
    square = [[0, 0], [2, 0], [2, 2], [0, 2], [0, 0]]
    feature = lambda k, kind, c, **p: json.dumps({"properties": {"code": k, **p}, "geometry": {"type": kind, "coordinates": c}})
    (tmp_path / "g.geojsonl").write_text("\n".join([feature(7, "Polygon", [square]), feature("8", "MultiPolygon", [[square], [square]], name="m"), feature(9, "Polygon", [square], skip="y"), "broken"]))
    got = {r.area: len(r.rings) for r in L.boundaries(spark, str(tmp_path / "g.geojsonl"), "code", F.col("properties")["skip"] == "y").collect()}
    assert got == {7: 1, 8: 2}
    head = "period_start,period_end,dist_lgd,period_dep_pct,category\n"
    (tmp_path / "w").mkdir()
    (tmp_path / "w/season_2023_SW.csv").write_text(head + "2023-06-01,2023-09-30,1,-10,Normal\n2023-06-01,2023-09-30,2,,\n")
    (tmp_path / "w/snapshot_2023-09-30.csv").write_text(head + "2023-06-01,2023-09-30,1,-25,Deficient\n")
    (tmp_path / "w/season_2022_SW.csv").write_text(head + "2022-06-01,2022-09-30,1,3,Normal\n")
    assert sorted((str(r.start), r.district, r.dep) for r in L.official_windows(spark, str(tmp_path / "w")).collect()) == [("2022-06-01", 1, 3.0), ("2023-06-01", 1, -25.0)]


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([Row(k=1, q="fine", v=[1.0, math.nan], m={"a": math.inf}, s=Row(x=math.nan, y="t")), Row(k=2, q=None, v=None, m={}, s=Row(x=1.0, y=None))], "k int, q string, v array<double>, m map<string,double>, s struct<x:double,y:string>")
    text = S.keyed(rows, "k", {"as_of": F.lit("2024")}, ["q"]).first().document
    assert json.loads(text, parse_constant=pytest.fail) == {"as_of": "2024", "q_counts": {"None": 1, "fine": 1}, "rows": {"1": {"q": "fine", "v": [1.0, None], "m": {"a": None}, "s": {"x": None, "y": "t"}}, "2": {"q": None, "v": None, "m": {}, "s": {"x": 1.0, "y": None}}}}
    S.write_json_parts(rows.select("k", "q", "s"), f"{tmp_path}/j", ["k"])
    assert (next((tmp_path / "j/k=1").glob("*.json"))).read_text() == '{"q":"fine","s":{"x":null,"y":"t"}}\n'
    days = spark.createDataFrame([(1, "a", 0.5), (2, "b", 1.5)], "day int, name string, v double")
    S.write_parts(S.narrowed(days, {"v": "float"}), f"{tmp_path}/p", ["day"])
    S.write_parts(S.narrowed(days.where("day = 2").withColumn("name", F.lit("c")), {"v": "float"}), f"{tmp_path}/p", ["day"])
    back = spark.read.parquet(f"{tmp_path}/p")
    assert {(r.day, r.name) for r in back.collect()} == {(1, "a"), (2, "c")} and dict(back.dtypes)["v"] == "float"
    S.write_csv(days.where("day = 1"), f"{tmp_path}/c", quoted=True)
    assert next((tmp_path / "c").glob("*.csv")).read_text() == '"day","name","v"\n"1","a","0.5"\n'
    assert [S.archive(days, f"{tmp_path}/a", ["day"]), S.archive(days.withColumn("v", F.lit(9.0)), f"{tmp_path}/a", ["day"])] == [2, 0]
    assert {r.v for r in spark.read.parquet(f"{tmp_path}/a").collect()} == {0.5, 1.5}
    history = spark.createDataFrame([("d1", 1, None, ""), ("d2", 1, "fine", "e"), ("d2", 2, None, "e")], "snapshot string, k int, quadrant string, stress string")
    index = S.index_of(history, "snapshot", "quadrant", {"stress": "stress"}).first()
    assert (index.snapshots, index.classified, index.layer_from.stress) == (["d1", "d2"], {"d1": 0, "d2": 1}, "d2")
    assert [r.row for r in S.snapshot_rows(history, "snapshot", "k", ["quadrant", "stress"]).orderBy("snapshot", "k").collect()] == [[None, None], ["fine", "e"], [None, "e"]]
