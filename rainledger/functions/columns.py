"""Scalar expressions: each takes and returns a Column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Reading months by cycle, in the order of the year, and the day each cycle ends (month, day).
CYCLES = ("JAN", "PRE", "AUG", "NOV")
CYCLE_MONTHS = {"JAN": (12, 1, 2), "PRE": (3, 4, 5, 6), "AUG": (7, 8, 9), "NOV": (10, 11)}
CYCLE_ENDS = {"JAN": (1, 31), "PRE": (5, 31), "AUG": (8, 31), "NOV": (11, 30)}
# Months of a telemetry campaign.
TELEMETRY_MONTHS = (1, 4, 5, 8, 11)
# The tiers that a quadrant is given for, and the fewest days of a season that it is judged on.
JUDGED_TIERS, LEAST_SEASON_DAYS = ("full", "short", "provisional"), 15
# Lowest rounded departure of each rainfall category, highest first.
CATEGORY_FLOORS = ((60, "Large Excess"), (20, "Excess"), (-19, "Normal"), (-59, "Deficient"), (-99, "Large Deficient"))
SHORT_CATEGORIES = ("Deficient", "Large Deficient", "No Rain")
# Upper edges of the drought classes, mildest first.
INDEX_EDGES = ((-2.0, "d4"), (-1.6, "d3"), (-1.3, "d2"), (-0.8, "d1"), (-0.5, "d0"))


def rounded(x: Column, places: int = 0) -> Column:
    """Half-even rounding to some decimal places; null stays null."""
    return F.rint(x) if not places else F.rint(x * float(10**places)) / float(10**places)


def finite(x: Column) -> Column:
    """NaN and infinities as null; scans apply it before anything is averaged or compared."""
    return F.when(~F.isnan(x) & (F.abs(x) != float("inf")), x)


def cycle_of(when: Column, months: dict[str, tuple[int, ...]] = CYCLE_MONTHS) -> Column:
    out = F.lit(None).cast("string")
    for name, inside in months.items():
        out = F.when(F.month(when).isin(*inside), name).otherwise(out)
    return out


def cycle_year(when: Column) -> Column:
    """The year of a reading's cycle: December counts with the January that follows."""
    return (F.year(when) + F.when(F.month(when) == 12, 1).otherwise(0)).cast("long")


def cycle_ordinal(year: Column, cycle: Column) -> Column:
    """A number that rises by one from cycle to cycle."""
    place = F.lit(None).cast("long")
    for i, name in enumerate(CYCLES):
        place = F.when(cycle == name, F.lit(i).cast("long")).otherwise(place)
    return year * 4 + place


def month_index(year: Column, month: Column) -> Column:
    return (year * 12 + month - 1).cast("long")


def met_week(when: Column) -> Column:
    """Standard meteorological week, 1 to 52; the last one takes what is left of the year."""
    return F.least(F.floor((F.dayofyear(when) - 1) / 7) + 1, F.lit(52)).cast("long")


def departure(actual: Column, normal: Column) -> Column:
    """Per cent of the normal above or below it; null without a positive normal."""
    return F.when(normal > 0, (actual - normal) / normal * 100)


def category(percent: Column) -> Column:
    """Rainfall category of a departure, which is first rounded half-even; null stays null."""
    out = F.when(percent.isNotNull(), F.lit("No Rain"))
    for floor, name in reversed(CATEGORY_FLOORS):
        out = F.when(F.rint(percent) >= floor, name).otherwise(out)
    return out


def index_class(value: Column) -> Column:
    """Drought class of an index value, closed on the dry side; none above the mildest edge."""
    out = F.when(value.isNotNull(), F.lit("none"))
    for edge, name in reversed(INDEX_EDGES):
        out = F.when(value <= edge, name).otherwise(out)
    return out


def season_window(as_of: Column, north_east: Column) -> Column:
    """(season, start, end) of the season to report on a day: the running one, or the last that ended."""
    year, month = F.year(as_of), F.month(as_of)
    day = lambda y, m, d: F.make_date(y, F.lit(m), F.lit(d))
    window = lambda name, start, end: F.struct(F.lit(name).alias("season"), start.alias("start"), end.alias("end"))
    return (
        F.when(north_east & (month >= 10), window("NE", day(year, 10, 1), as_of))
        .when(north_east & (month <= 5), window("NE", day(year - 1, 10, 1), day(year - 1, 12, 31)))
        .when(month.between(6, 9), window("SW", day(year, 6, 1), as_of))
        .when(month >= 10, window("SW", day(year, 6, 1), day(year, 9, 30)))
        .otherwise(window("SW", day(year - 1, 6, 1), day(year - 1, 9, 30)))
    )


def base_name(name: Column) -> Column:
    """A station's name without a trailing number."""
    return F.lower(F.trim(F.regexp_replace(name, r"_\d+$", "")))


def plain_name(name: Column) -> Column:
    """A place name for matching: lower case, & as and, without the words district and dist, letters and digits only."""
    words = F.regexp_replace(F.regexp_replace(F.lower(name), "&", "and"), r"\b(district|dist)\b", "")
    return F.regexp_replace(words, "[^a-z0-9]", "")


def rain_reasons(cat: Column, spi: Column, dry_weeks: Column, spi_dry: float = -1.0, weeks: int = 4) -> Column:
    """Why rain counts as short: deviation, spi, dry_spell; null if nothing is known."""
    found = F.array_compact(F.array(F.when(cat.isin(*SHORT_CATEGORIES), F.lit("deviation")), F.when(spi <= spi_dry, F.lit("spi")), F.when(dry_weeks >= weeks, F.lit("dry_spell"))))
    return F.when(cat.isNotNull() | spi.isNotNull() | dry_weeks.isNotNull(), found)


def rain_verdict(cat: Column, season_days: Column, short: Column) -> Column:
    """(short, why) of a district's rain: null without data or in a season too young to judge, else the combined rule, else the category alone."""
    known = cat.isNotNull() | short.isNotNull()
    young = F.coalesce(season_days < LEAST_SEASON_DAYS, F.lit(False))
    why = F.when(~known, "no_rain_data").when(young, "season_just_started")
    return F.struct(F.when(why.isNull(), F.coalesce(short, cat.isin(*SHORT_CATEGORIES))).alias("short"), why.alias("why"))


def level_verdict(tier: Column, low: Column) -> Column:
    """(low, why) of a district's water level: null outside the judged tiers."""
    judged = F.coalesce(tier.isin(*JUDGED_TIERS), F.lit(False))
    return F.struct(F.when(judged, low).alias("low"), F.when(~judged, F.concat(F.lit("gw_"), F.coalesce(tier, F.lit("missing")))).alias("why"))


def headline(official: Column, official_category: Column, gridded: Column) -> Column:
    """(dep, category, source): the official departure where there's one, else the gridded one, rounded first."""
    whole = F.rint(gridded)
    return (
        F.when(official.isNotNull(), F.struct(official.alias("dep"), official_category.alias("category"), F.lit("official").alias("source")))
        .when(gridded.isNotNull(), F.struct(whole.alias("dep"), category(whole).alias("category"), F.lit("gridded").alias("source")))
        .otherwise(F.struct(F.lit(None).cast("double").alias("dep"), F.lit(None).cast("string").alias("category"), F.lit(None).cast("string").alias("source")))
    )


def current_cycle(today: Column) -> Column:
    """(year, cycle): the last cycle that ended before a day."""
    ends = [F.struct(F.make_date(F.year(today) - k, F.lit(m), F.lit(d)).alias("end"), (F.year(today) - k).cast("long").alias("year"), F.lit(c).alias("cycle")) for k in (0, 1) for c, (m, d) in CYCLE_ENDS.items()]
    last = F.array_max(F.filter(F.array(*ends), lambda e: e["end"] < today))
    return F.struct(last["year"].alias("year"), last["cycle"].alias("cycle"))


def whole_months(start: Column, end: Column) -> Column:
    return (F.dayofmonth(start) == 1) & (end == F.last_day(end))


def window_weeks(start: Column, end: Column) -> Column:
    """(year, week) of the meteorological weeks that lie wholly inside a window; week 52 ends with the year."""
    first = F.transform(F.sequence(F.year(start), F.year(end)), lambda y: F.transform(F.sequence(F.lit(1), F.lit(52)), lambda w: F.struct(y.cast("long").alias("year"), w.cast("long").alias("week"), F.date_add(F.make_date(y, F.lit(1), F.lit(1)), 7 * (w - 1)).alias("a"))))
    ends = lambda x: F.when(x["week"] == 52, F.make_date(x["year"].cast("int"), F.lit(12), F.lit(31))).otherwise(F.date_add(x["a"], 6))
    inside = F.filter(F.flatten(first), lambda x: (x["a"] >= start) & (ends(x) <= end))
    return F.transform(inside, lambda x: F.struct(x["year"].alias("year"), x["week"].alias("week")))


def quadrant(rain_short: Column, level_low: Column) -> Column:
    return (
        F.when(~rain_short & ~level_low, "fine")
        .when(~rain_short & level_low, "hidden")
        .when(rain_short & ~level_low, "buffered")
        .when(rain_short & level_low, "double")
    )
