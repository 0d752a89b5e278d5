"""The status with SPI in it: the synthetic tables have six base years, so five are asked for, where the full status asks for thirty."""

from __future__ import annotations

from rainledger.plans import archives as A
from rainledger.plans import rain as R
from rainledger.plans import status as S


def status_with_spi(spark, sf_dir):
    """What the rain layer says with SPI as one of its reasons, and the quadrant that follows."""
    s = S.district_status(**S.layers_of(spark, sf_dir), base_years=R.NORMAL_YEARS, least_years=5, least_wet=5)
    return s.select("district", "snapshot", "quadrant", "why", "category", "spi", "dry_weeks", "reasons", "short", "pct")


def spi_ctes(values: str, base: str, keys: str, least: int = 5) -> str:
    """CTEs up to `scored`: the rows of `values` (keys, v) with spi to two places, by a gamma distribution of the rows of `base`."""
    return f"""sb0 AS (SELECT {keys}, count(v) AS n, avg((v <= 0)::INT) AS zero_share, avg(v) FILTER (WHERE v > 0) AS mean, avg(ln(v)) FILTER (WHERE v > 0) AS mean_log FROM {base} GROUP BY {keys} HAVING count(v) >= {least} AND count(*) FILTER (WHERE v > 0) >= {least}),
sb1 AS (SELECT *, greatest(ln(mean) - mean_log, 1e-12) AS s FROM sb0),
sfit AS (SELECT {keys}, s, (3 - s + sqrt(pow(s - 3, 2) + 24 * s)) / (12 * s) AS a, 0 AS turn FROM sb1
  UNION ALL SELECT {keys}, s, greatest(a - (ln(a) - {A._digamma} - s) / (1 / a - {A._trigamma}), 1e-9), turn + 1 FROM sfit WHERE turn < 12),
sx AS (SELECT q.*, zero_share, f.a, v * f.a / mean AS x FROM {values} q JOIN sb1 USING ({keys}) JOIN (SELECT * FROM sfit WHERE turn = 12) f USING ({keys})),
sp AS (SELECT *, greatest(least(CASE WHEN v <= 0 THEN zero_share ELSE zero_share + (1 - zero_share) * least(list_sum(list_transform(range(2500), lambda k: exp((a + k) * ln(x) - x - lgamma(a + k + 1)))), 1) END, 1 - 1e-6), 1e-6) AS p FROM sx),
scored AS (SELECT * EXCLUDE (a, x, p, zero_share), round_even(greatest(least(CASE WHEN p < 0.02425 THEN {A._low} WHEN p <= 0.97575 THEN {A._mid} ELSE {A._high} END, 3.5), -3.5) * 100, 0) / 100 AS spi FROM sp)"""


_rolled = f"""wh AS (SELECT a AS start_, b AS end_, year(b) * 12 + month(b) - year(a) * 12 - month(a) + 1 AS n_months, month(b) AS last_month, year(b) * 12 + month(b) - 1 AS e FROM spans WHERE day(a) = 1 AND b = last_day(b)),
kinds AS (SELECT DISTINCT n_months, last_month FROM wh),
rolled AS (SELECT district, n_months, last_month, year * 12 + month - 1 + j AS e, sum(mm) AS v FROM monthly, kinds, range(12) t(j) WHERE mm IS NOT NULL AND j < n_months AND (year * 12 + month - 1 + j) % 12 = last_month - 1 GROUP BY ALL HAVING count(*) = max(n_months)),
rolled_base AS (SELECT * FROM rolled WHERE e // 12 BETWEEN {R.NORMAL_YEARS[0]} AND {R.NORMAL_YEARS[1]}),
{spi_ctes("rolled", "rolled_base", "district, n_months, last_month")},
spis AS (SELECT district, start_ AS a, end_ AS b, spi FROM scored JOIN wh USING (n_months, last_month, e)),
x0 AS"""
_full = (
    S._FULL.replace("WITH ", "WITH RECURSIVE ", 1).replace("x0 AS", _rolled, 1).replace("x1 AS (SELECT x0.*, o,", "x1 AS (SELECT x0.*, spi, o,")
    .replace("LEFT JOIN off USING (district, a, b)", "LEFT JOIN off USING (district, a, b) LEFT JOIN spis USING (district, a, b)")
    .replace("CASE WHEN category IS NOT NULL OR dry_weeks IS NOT NULL THEN", "CASE WHEN category IS NOT NULL OR dry_weeks IS NOT NULL OR spi IS NOT NULL THEN")
    .replace("THEN 'deviation' END, CASE", "THEN 'deviation' END, CASE WHEN spi <= -1.0 THEN 'spi' END, CASE")
)
SQL = {"status_with_spi": _full + " SELECT district, strftime(snapshot, '%Y-%m-%d') AS snapshot, quadrant, CASE WHEN quadrant IS NULL THEN why END AS why, category, spi, dry_weeks, array_to_string(found, ',') AS reasons, short, pct FROM x8"}
QUERIES = {"status_with_spi": status_with_spi}
