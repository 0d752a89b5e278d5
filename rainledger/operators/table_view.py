"""Search, order and explanations of a table of places, as people use them: letters count whatever their case and accents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Spark's collation that takes letters as equal whatever their case and accents.
COLLATION = "UNICODE_CI_AI"
#: The order of quadrants, the gravest first; what has none comes after.
QUADRANT_RANKS = {"double": 0, "hidden": 1, "buffered": 2, "fine": 3}


def matches(text: str, columns: list[str]) -> Column:
    """Whether the columns, joined by commas, hold the text somewhere; an empty or blank text holds everywhere. Null columns are left out."""
    wanted = text.strip()
    if not wanted:
        return F.lit(True)
    return F.contains(F.collate(F.concat_ws(", ", *columns), COLLATION), F.collate(F.lit(wanted), COLLATION))


def search(rows: DataFrame, text: str = "", columns: list[str] = ("district", "state"), **equal: str) -> DataFrame:
    """Rows that hold the text and have these values."""
    out = rows.where(matches(text, list(columns)))
    for column, value in equal.items():
        out = out.where(F.col(column) == value)
    return out


def order_of(rows: DataFrame, column: str, down: bool = False, ranks: dict[str, int] | None = None, tie: str | None = None) -> list[Column]:
    """What to order by so that a column's values go up or down, and nulls, NaN and empty texts are last either way. ranks: of values that have an order of their own; values without one go after these. Ties by `tie`, up."""
    kind, x = dict(rows.dtypes)[column], F.col(column)
    if kind.startswith("string"):
        nothing = x.isNull() | (F.trim(x) == "")
        key = [F.collate(x, COLLATION), x]
    else:
        nothing = x.isNull() | (F.isnan(x) if kind in ("double", "float") else F.lit(False))
        key = [x]
    if ranks:
        table = F.create_map(*[v for k, r in ranks.items() for v in (F.lit(k), F.lit(r))])
        key = [F.coalesce(F.try_element_at(table, x), F.lit(max(ranks.values()) + 1)), x]
    return [nothing.asc(), *[(k.desc() if down else k.asc()) for k in key], *([F.col(tie).asc()] if tie else [])]


def page(rows: DataFrame, column: str, down: bool = False, ranks: dict[str, int] | None = None, tie: str | None = None, size: int = 50, number: int = 0) -> DataFrame:
    """A page of rows in order, as the table shows it: the top of all rows, then what goes before the page is left out."""
    ordered = rows.orderBy(*order_of(rows, column, down, ranks, tie))
    return ordered.limit(size * (number + 1)).offset(size * number)


def unpivoted(status: DataFrame, keys: list[str], layers: dict[str, Column], facts: dict[str, Column]) -> DataFrame:
    """(keys, layer, value, facts): a row for each layer; value is its text, facts a map of what is known of the row, true, false or null."""
    told = F.create_map(*[x for k, v in facts.items() for x in (F.lit(k), v.cast("boolean"))])
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("layer"), v.cast("string").alias("value")) for k, v in layers.items()]))
    return status.select(*keys, told.alias("facts"), each.alias("l")).select(*keys, "l.layer", "l.value", "facts")


def explained(rows: DataFrame, rules: DataFrame, keys: list[str], other: str = "no_data") -> DataFrame:
    """(keys, layer, value, reason): why a layer has no value: the first of its rules whose fact is true, else `other`; null where it has one.

    rules: (layer, place, fact, reason), a few. A fact that isn't known doesn't
    hold, so its rule is passed over; `always` holds without a fact.
    """
    first = rules.groupBy("layer").agg(F.array_sort(F.collect_list(F.struct("place", "fact", "reason"))).alias("rules"))
    own = rows.join(F.broadcast(first), "layer", "left")  # a row for each layer
    held = F.filter("rules", lambda r: (r["fact"] == "always") | F.coalesce(F.try_element_at(F.col("facts"), r["fact"]), F.lit(False)))
    return own.select(*keys, "layer", "value", F.when(F.col("value").isNull(), F.coalesce(F.get(held, F.lit(0))["reason"], F.lit(other))).alias("reason"))


def layers_with_data(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, layers): the layers that have a value, in the order of their names."""
    return rows.groupBy(*keys).agg(F.array_sort(F.collect_set(F.when(F.col("value").isNotNull(), F.col("layer")))).alias("layers"))
