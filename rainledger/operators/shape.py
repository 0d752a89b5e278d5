"""Long and wide tables, full grids, and comparisons of two tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def wide(rows: DataFrame, keys: list[str], name: str, value: str, names: list[str]) -> DataFrame:
    """One row a key, a column for each of the names, which are stated so that no pass over the data looks for them; values of a name are summed, null where none is there."""
    return rows.groupBy(*keys).pivot(name, names).agg(F.sum(value))


def long(rows: DataFrame, keys: list[str], columns: list[str], name: str, value: str) -> DataFrame:
    """One row a key and column; nulls go."""
    return rows.unpivot(keys, columns, name, value).where(F.col(value).isNotNull())


def crosstab(rows: DataFrame, key: str, by: str, names: list[str]) -> DataFrame:
    """How many rows of a key have each name; 0 where none has."""
    return rows.groupBy(key).pivot(by, names).count().na.fill(0, names)


def full_grid(rows: DataFrame, *sides: DataFrame) -> DataFrame:
    """The rows of all combinations of the sides (small dimensions with different columns), with nulls where there's none."""
    grid = reduce(lambda a, b: a.join(F.broadcast(b)), sides)  # dimensions: districts, months, weeks
    return grid.join(rows, grid.columns, "left")


def positional(fields: list[str]) -> Column:
    """The fields as an array of texts, in their order; an empty text is null."""
    return F.array(*[F.nullif(F.col(f).cast("string"), F.lit("")) for f in fields])


def by_year(year: Column, *values: Column) -> Column:
    """An aggregate: map of year to an array of values."""
    return F.map_from_entries(F.sort_array(F.collect_list(F.struct(year.cast("string"), F.array(*values)))))


def differences(left: DataFrame, right: DataFrame, keys: list[str], columns: list[str], tolerance: float = 0.0, relative: bool = False) -> DataFrame:
    """(keys, n_equal, n_columns, same) of all keys of either table: values count as equal if both are null, or are numbers that differ by the tolerance at most (relative: to the right one), or are the same."""
    kinds = dict(left.dtypes)

    def equal(c: str) -> Column:
        a, b = F.col(f"a.{c}"), F.col(f"b.{c}")
        if kinds[c] not in ("double", "float"):
            return a.eqNullSafe(b)
        bound = tolerance * F.abs(b) if relative else F.lit(tolerance)
        return (a.isNull() & b.isNull()) | F.coalesce(F.abs(a - b) <= bound, F.lit(False))

    on = reduce(lambda x, y: x & y, [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys])
    both = left.withColumn("_in", F.lit(True)).alias("a").join(right.withColumn("_in", F.lit(True)).alias("b"), on, "full")
    n = reduce(lambda x, y: x + y, [equal(c).cast("long") for c in columns])
    matched = F.col("a._in").isNotNull() & F.col("b._in").isNotNull()
    out = both.select(*[F.coalesce(f"a.{k}", f"b.{k}").alias(k) for k in keys], F.when(matched, n).otherwise(0).cast("long").alias("n_equal"))
    return out.withColumn("n_columns", F.lit(len(columns)).cast("long")).withColumn("same", F.col("n_equal") == len(columns))
