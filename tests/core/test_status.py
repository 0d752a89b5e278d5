import math
from datetime import date, timedelta
from statistics import NormalDist

import numpy as np
import pytest

from rainledger.operators import spi as S
from rainledger.plans.status import district_status

SHORT = ("Deficient", "Large Deficient", "No Rain")
ENDS = (("JAN", 1, 31), ("PRE", 5, 31), ("AUG", 8, 31), ("NOV", 11, 30))


def category(d):
    if d is None:
        return None
    return next((name for floor, name in ((60, "Large Excess"), (20, "Excess"), (-19, "Normal"), (-59, "Deficient"), (-99, "Large Deficient")) if round(d) >= floor), "No Rain")


def window(day, north_east):
    y, m = day.year, day.month
    if north_east and (m >= 10 or m <= 5):
        return ("NE", date(y, 10, 1), day) if m >= 10 else ("NE", date(y - 1, 10, 1), date(y - 1, 12, 31))
    if 6 <= m <= 9:
        return "SW", date(y, 6, 1), day
    y -= m < 6
    return "SW", date(y, 6, 1), date(y, 9, 30)


def days(a, b):
    return [a + timedelta(k) for k in range((b - a).days + 1)]


@pytest.fixture(scope="module")
def layers():
    dice = np.random.default_rng(12)
    d = range(6)
    dates = [(date(y, m, e), y, c) for y in (2000, 2001) for c, m, e in ENDS] + [(date(2001, 6, 10), 2001, "AUG")]
    return {
        "districts": [(k, k % 3 == 0) for k in d], "dates": dates,
        "monthly": [(k, y, m, float(dice.gamma(1, 60) * (dice.random() > 0.1))) for k in d for y in range(1960, 2002) for m in range(1, 13) if not (k == 4 and (y, m) == (2001, 7))],
        "daily_normals": [(k, t.month, t.day, float(dice.uniform(1, 3)) if k != 5 else 0.0) for k in d for t in days(date(2000, 1, 1), date(2000, 12, 31))],
        "weekly": [(k, y, w, float(dice.choice([0, 2, 20, 40]))) for k in d for y in (1999, 2000, 2001) for w in range(1, 53) if dice.random() > 0.05],
        "weekly_normals": [(k, w, float(dice.choice([3.0, 18.0, 20.0])) if k != 5 else 0.0) for k in d for w in range(1, 53)],
        "official": [(date(2000, 6, 1), date(2000, 9, 30), k, float(dice.integers(-70, 40)), "Deficient" if k else None) for k in (0, 1, 2)],
        "levels": [(k, y, c, str(dice.choice(["full", "short", "provisional", "level_only"])), float(dice.integers(0, 100)), bool(dice.random() < 0.5)) for k in d for _, y, c in dates[:8] if dice.random() > 0.1],
        "editions": [(e, y, k, "Safe", 50.0 + y % 7) for e, y in (("a", 1999), ("b", 2001)) for k in (0, 1, 2)],
        "index": [(date(2000, 1, 29), k, -0.1 * k * 5, 10.0) for k in d] + [(date(2001, 8, 20), 1, -3.0, 90.0), (date(2001, 8, 27), 2, -1.3, 55.53)],
    }


KINDS = {"districts": "district int, north_east boolean", "dates": "snapshot date, year long, cycle string", "monthly": "district int, year long, month long, mm double", "daily_normals": "district int, month long, dom long, normal double", "weekly": "district int, year long, week long, mm double", "weekly_normals": "district int, week long, normal double", "official": "start date, end date, district int, dep double, category string", "levels": "district int, year long, cycle string, tier string, pct double, low boolean", "editions": "edition string, end_year int, district int, category string, stage_pct double", "index": "week date, district int, mean double, d0plus double"}


def spi_of(value, base):
    wet = np.array([v for v in base if v > 0])
    q = 1 - len(wet) / len(base)
    a = S.gamma_shape(np.array([math.log(wet.mean()) - np.log(wet).mean()]))
    p = q + (1 - q) * float(S.gamma_share(a, np.array([value * a[0] / wet.mean()]))[0]) if value > 0 else q
    return min(max(NormalDist().inv_cdf(min(max(p, 1e-6), 1 - 1e-6)), -3.5), 3.5)


def brute(x):
    month = {(k, y * 12 + m - 1): v for k, y, m, v in x["monthly"]}
    normal = {(k, m, d): v for k, m, d, v in x["daily_normals"]}
    week, wnormal = {(k, y, w): v for k, y, w, v in x["weekly"]}, {(k, w): v for k, w, v in x["weekly_normals"]}
    official, level = {r[:3]: r[3:] for r in x["official"]}, {r[:3]: r[3:] for r in x["levels"]}
    out = {}
    for k, ne in x["districts"]:
        for snap, year, cycle in x["dates"]:
            season, a, b = window(snap, ne)
            yms = range(a.year * 12 + a.month - 1, b.year * 12 + b.month)
            held = [month.get((k, t)) for t in yms]
            actual = sum(held) if None not in held else None
            usual = sum(normal[k, t.month, t.day] for t in days(a, b))
            g = float(round((actual - usual) / usual * 100)) if actual is not None and usual else None
            o = official.get((a, b, k))
            dep, cat, source = (*o, "official") if o else (g, category(g), "gridded") if g is not None else (None, None, None)
            inside = [w for w in range(1, 53) if (s := date(a.year, 1, 1) + timedelta(7 * (w - 1))) >= a and (date(a.year, 12, 31) if w == 52 else s + timedelta(6)) <= b]
            mean, longest, now = (sum(wnormal[k, w] for w in inside) / len(inside), 0, 0) if inside else (0, 0, 0)
            for w in inside:
                n, v = wnormal[k, w], week.get((k, a.year, w))
                now = now + 1 if n >= 0.5 * mean and v is not None and v < 0.5 * n else 0
                longest = max(longest, now)
            dry = longest if mean > 0 else None
            z = None
            if a.day == 1 and (b + timedelta(1)).day == 1 and actual is not None:
                back = [[month.get((k, t - 12 * (b.year - y))) for t in yms] for y in range(1961, 2000)]
                z = round(spi_of(actual, [sum(v) for v in back if None not in v]), 2)
            reasons = None if cat is None and z is None and dry is None else [r for r, f in (("deviation", cat in SHORT), ("spi", z is not None and z <= -1), ("dry_spell", dry is not None and dry >= 4)) if f]
            n_days = (b - a).days + 1
            short = bool(reasons) if reasons is not None and n_days >= 15 else None
            tier, pct, low = level.get((k, year, cycle), ("insufficient", None, None))
            judged = tier in ("full", "short", "provisional")
            quadrant = {(0, 0): "fine", (0, 1): "hidden", (1, 0): "buffered", (1, 1): "double"}[short, low] if short is not None and judged else None
            why = None if quadrant else "no_rain_data" if reasons is None else "season_just_started" if n_days < 15 else f"gw_{tier}"
            edition = max((e for e in {r[:2] for r in x["editions"]} if e[1] <= snap.year), key=lambda e: e[1], default=(None, None))[0]
            stress = next(((r[3], r[4]) for r in x["editions"] if r[0] == edition and r[2] == k), (None, None))
            last = max((r[0] for r in x["index"] if snap - timedelta(7) <= r[0] <= snap), default=None)
            i = next((r for r in x["index"] if r[:2] == (last, k)), (None, None, None, None))
            out[k, str(snap)] = (quadrant, quadrant is not None and tier == "provisional", why, season, n_days, cat, dep, source, z, dry, None if reasons is None else ",".join(reasons), short, tier, pct, edition, *stress, i[2], None if i[3] is None else round(i[3], 1))
    return out


def test_status_against_brute_force(spark, layers):
    frames = {k: spark.createDataFrame(v, KINDS[k]) for k, v in layers.items()}
    rows = district_status(**frames, base_years=(1961, 1999)).collect()
    want = brute(layers)
    assert len(rows) == len(want)
    for r in rows:
        got = (r.quadrant, r.provisional, r.why, r.season, r.season_days, r.category, r.dep, r.source, r.spi, r.dry_weeks, r.reasons, r.short, r.tier, r.pct, r.edition, r.stress, r.stage_pct, r.index_mean, r.d0plus)
        assert got == pytest.approx(want[r.district, r.snapshot], abs=0.011), (r.district, r.snapshot)
    assert {r.why for r in rows} >= {None, "season_just_started", "gw_level_only"} and {r.quadrant for r in rows} >= {"fine", "double", "buffered", "hidden"}
    assert any(r.spi is not None and "spi" in (r.reasons or "") for r in rows) and {r.source for r in rows} == {"official", "gridded", None}
    assert {r.index_class for r in rows if r.index_mean == -1.3} == {"d2"}
