"""Names, codes and periods as they stand in source tables: each function takes and returns a Column."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# Codes of the official rainfall categories; ND has no category.
OFFICIAL_CODES = {"LE": "Large Excess", "E": "Excess", "N": "Normal", "D": "Deficient", "LD": "Large Deficient", "NR": "No Rain"}
# One letter for each quadrant.
QUADRANT_CODES = {"fine": "F", "hidden": "H", "buffered": "B", "double": "D"}
# Labels of the assessment categories.
STRESS_LABELS = {"safe": "Safe", "semi_critical": "Semi-critical", "critical": "Critical", "over_exploited": "Over-exploited", "salinity": "Saline", "Hilly Area": "Hilly area"}
# First day (month, day) of each season.
SEASON_STARTS = {"SW": (6, 1), "NE": (10, 1)}
# Last day (month, day) of each season.
SEASON_ENDS = {"SW": (9, 30), "NE": (12, 31)}


def _folding() -> tuple[str, str]:
    """Characters whose compatibility decomposition has one ASCII character, with that."""
    plain = {chr(c): unicodedata.normalize("NFKD", chr(c)).encode("ascii", "ignore").decode() for c in range(0x80, 0x10000)}
    one = {c: p for c, p in plain.items() if len(p) == 1}
    return "".join(one), "".join(one.values())


_FROM, _TO = _folding()


def ascii_name(name: Column) -> Column:
    """A name with letters for their accented and compatibility forms, and nothing else that isn't ASCII; ligatures of several letters go."""
    return F.regexp_replace(F.translate(name, _FROM, _TO), r"[^\x00-\x7F]", "")


def name_key(name: Column) -> Column:
    """A place name for matching: ASCII, lower case, & as and, without the words district and dist, letters and digits only."""
    words = F.regexp_replace(F.regexp_replace(F.lower(ascii_name(name)), "&", " and "), r"\b(district|dist)\b", " ")
    return F.regexp_replace(words, "[^a-z0-9]", "")


def state_key(name: Column) -> Column:
    """name_key of a state, without a final `islands`; the two territories that merged share one key."""
    key = F.regexp_replace(name_key(name), "islands$", "")
    return F.when(key.startswith("dadra") | key.startswith("daman"), "dnhdd").otherwise(key)


def title(name: Column) -> Column:
    """Title case by runs of letters, with a small `and`, also for &."""
    parts = F.regexp_extract_all(F.lower(F.trim(name)), F.lit(r"\p{L}+|[^\p{L}]+"), F.lit(0))
    cased = F.array_join(F.transform(parts, lambda p: F.concat(F.upper(F.substring(p, 1, 1)), p.substr(F.lit(2), F.length(p)))), "")
    return F.regexp_replace(F.regexp_replace(cased, " And ", " and "), "&", "and")


def slug(name: Column) -> Column:
    """A name for files: letters and digits, one underscore for what stands between them."""
    return F.regexp_replace(F.regexp_replace(name, "[^A-Za-z0-9]+", "_"), "^_+|_+$", "")


def well_key(source: Column, lat: Column, lon: Column, base: Column) -> Column:
    """`m:` or `t:` (the source's first letter), the place to four decimals and the base name."""
    four = lambda x: F.format_string("%.4f", F.rint(x * 10000) / 10000)
    return F.concat(F.substring(source, 1, 1), F.lit(":"), four(lat), F.lit(","), four(lon), F.lit(":"), base)


def cell_key(lat: Column, lon: Column, places: int = 3) -> Column:
    """A grid cell by its place, so that grids are aligned by where their values are and not by their order."""
    fixed = lambda x: F.format_string(f"%.{places}f", F.rint(x * 10**places) / 10**places)
    return F.concat(fixed(lat), F.lit(","), fixed(lon))


def coded(code: Column, names: dict[str, str], other: Column | None = None) -> Column:
    """The name of a code; what has none is `other`, or null."""
    table = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    return F.coalesce(F.try_element_at(table, code), F.lit(None).cast("string") if other is None else other)


def period(text: Column) -> Column:
    """(start, end) of `dd-mm-yyyy to dd-mm-yyyy` somewhere in a text, in any case; null where there's none or a date isn't one."""
    found = lambda i: F.try_to_timestamp(F.regexp_extract(text, r"(?i)(\d{2}-\d{2}-\d{4})\s+to\s+(\d{2}-\d{2}-\d{4})", i), F.lit("dd-MM-yyyy")).cast("date")
    return F.when(found(1).isNotNull() & found(2).isNotNull(), F.struct(found(1).alias("start"), found(2).alias("end")))


def season_of(start: Column) -> Column:
    """The season that starts on a day, or null."""
    out = F.lit(None).cast("string")
    for name, (m, d) in SEASON_STARTS.items():
        out = F.when((F.month(start) == m) & (F.dayofmonth(start) == d), name).otherwise(out)
    return out


def finished_season(start: Column, end: Column) -> Column:
    """The season that a window from its first to its last day covers whole; null for others, which may go on."""
    season = season_of(start)
    out = F.lit(None).cast("string")
    for name, (m, d) in SEASON_ENDS.items():
        out = F.when((season == name) & (F.month(end) == m) & (F.dayofmonth(end) == d) & (F.year(start) == F.year(end)), name).otherwise(out)
    return out


def days_in_year(year: Column) -> Column:
    return F.dayofyear(F.make_date(year, F.lit(12), F.lit(31)))


def odds(bins: Column) -> Column:
    """(cold, neutral, warm): sums of the first four, the fifth and the last four of nine forecast bins."""
    total = lambda a, n: F.aggregate(F.slice(bins, a, n), F.lit(0.0), lambda s, x: s + x)
    return F.struct(total(1, 4).alias("cold"), total(5, 1).alias("neutral"), total(6, 4).alias("warm"))
