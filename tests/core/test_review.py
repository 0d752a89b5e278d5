import hashlib
import math

import pytest
from pyspark.sql import functions as F

from rainledger.operators import nulls as N
from rainledger.operators import table_view as T


def test_random_years_against_brute_force(spark):
    years = list(range(1990, 2003))
    flags = [(d, y, None if (d + y) % 11 == 0 else (d * 7 + y * 3) % 5 < 2) for d in range(6) for y in years if not (d == 5 and y > 1994)] + [(7, 1990, None), (None, 1991, True)]
    marked = [1991, 1995, 1999, 2050]
    df = spark.createDataFrame(flags, "d int, y int, short boolean")
    got = {r.d: r for r in N.null_rates(df, "d", "y", "short", marked, draws=150, seed=4).collect()}
    draws = [sorted(years, key=lambda y: (hashlib.md5(f"4-{d}-{y}".encode()).hexdigest(), y))[:3] for d in range(150)]
    assert [sorted(x) for x in draws] == [list(x) for x in N.random_years(df, "y", 3, 150, 4).first().draws]
    known = {}
    for d, y, v in flags:
        if v is not None:
            known.setdefault(d, {})[y] = v
    assert got.keys() == known.keys()
    mean = lambda m, ys: (sum(m[y] for y in ys if y in m) / n) if (n := sum(y in m for y in ys)) else None
    for d, m in known.items():
        r = got[d]
        rates = sorted(v for v in (mean(m, ys) for ys in draws) if v is not None)
        assert (r.n_years, r.rate, r.other_rate) == (len(m), mean(m, marked), mean(m, [y for y in m if y not in marked]))
        assert r.q05 == rates[math.floor(0.05 * (len(rates) - 1))] and r.q95 == rates[math.floor(0.95 * (len(rates) - 1))]
        assert r.p_value == (None if r.rate is None else pytest.approx(sum(v >= r.rate for v in rates) / len(rates)))
    assert N.null_rates(df.limit(0), "d", "y", "short", marked, draws=5).collect() == []


PLACES = [("Çankırı", "Kuzey", "double", 3.0), ("canada", "x", "fine", None), ("Ångström", "", "hidden", -1.0), ("zebra", None, None, 2.0), ("éclair", "São", "", float("nan")), (None, "Sao", "odd", 1.0), ("Zoë", "y", "buffered", 9.0)]


def test_search_knows_no_case_or_accents(spark):
    df = spark.createDataFrame(PLACES, "district string, state string, quadrant string, dep double")
    found = lambda text, **equal: {r.district for r in T.search(df, text, **equal).collect()}
    assert found("CANKIRI") <= {"Çankırı"} and found("cank") == {"Çankırı"}
    assert found("angstrom") == {"Ångström"} and found("  ZOE ") == {"Zoë"}
    assert found("eclair, sao") == {"éclair"} and found("SÃO") == {"éclair", None}
    assert len(found("")) == 7 and found("%") == set() and found("", quadrant="fine") == {"canada"}
    assert found("xyz") == set()


def test_order_has_nothing_last_both_ways(spark):
    df = spark.createDataFrame(PLACES, "district string, state string, quadrant string, dep double")
    by = lambda c, down, ranks=None: [r[c] for r in df.orderBy(*T.order_of(df, c, down, ranks, "district")).collect()]
    assert by("district", False) == ["Ångström", "canada", "Çankırı", "éclair", "zebra", "Zoë", None]
    assert by("district", True) == ["Zoë", "zebra", "éclair", "Çankırı", "canada", "Ångström", None]
    assert by("dep", False)[:5] == [-1.0, 1.0, 2.0, 3.0, 9.0] and by("dep", True)[:5] == [9.0, 3.0, 2.0, 1.0, -1.0]
    assert by("quadrant", False, T.QUADRANT_RANKS)[:5] == ["double", "hidden", "buffered", "fine", "odd"]
    assert by("quadrant", True, T.QUADRANT_RANKS)[:5] == ["odd", "fine", "buffered", "hidden", "double"]
    assert {x or None for x in by("quadrant", True, T.QUADRANT_RANKS)[5:]} == {None}
    assert [r.district for r in T.page(df, "dep", True, tie="district", size=2, number=1).collect()] == ["zebra", None]


def test_reasons_by_the_first_rule_that_surely_holds(spark):
    df = spark.createDataFrame([(1, "a", None, True, None), (2, None, None, None, True), (3, None, 5.0, False, True), (4, None, None, False, False)], "k int, rain string, level double, dry boolean, cut boolean")
    rows = T.unpivoted(df, ["k"], {"rain": F.col("rain"), "level": F.col("level"), "new": F.lit(None)}, {"dry": F.col("dry"), "cut": F.col("cut")})
    rules = spark.createDataFrame([("rain", 2, "cut", "was cut"), ("rain", 1, "dry", "is dry"), ("level", 1, "dry", "is dry"), ("level", 2, "gone", "no such fact"), ("level", 3, "always", "else")], "layer string, place int, fact string, reason string")
    got = {(r.k, r.layer): r.reason for r in T.explained(rows, rules, ["k"]).collect()}
    assert got == {(1, "rain"): None, (2, "rain"): "was cut", (3, "rain"): "was cut", (4, "rain"): "no_data", (1, "level"): "is dry", (2, "level"): "else", (3, "level"): None, (4, "level"): "else", **{(k, "new"): "no_data" for k in (1, 2, 3, 4)}}
    assert {r.k: r.layers for r in T.layers_with_data(rows, ["k"]).collect()} == {1: ["rain"], 2: [], 3: ["level"], 4: []}
