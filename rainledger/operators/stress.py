"""Assessment of districts by the units they are made of."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rated categories from the mildest on, and those that count as stressed.
RATED = ("Safe", "Semi-critical", "Critical", "Over-exploited")
STRESSED = ("Critical", "Over-exploited")


def stress_status(districts: DataFrame, rows: DataFrame, units: DataFrame) -> DataFrame:
    """What is known of each district: (district, status, category, stage_pct, n_units, by_category, worst, critical, hidden, n_extra).

    rows (district, relation, category, stage_pct) are the source's own districts
    with their relation to ours: `one` is the district itself (head), `part_of`
    and `child_of` are extras. units (district, name, category, stage_pct) are
    what it's made of. status: assessed, only_sub_units (extras alone) or
    not_in_source. by_category counts units, `Not given` where there's no
    category; worst is the rated unit with the worst category, then the highest
    stage, then the last name. hidden: a unit is stressed and the head isn't,
    or has no category; null without units. Of several heads the first by
    category and stage counts.
    """
    heads = rows.where("relation = 'one'").groupBy("district").agg(F.min(F.struct("category", "stage_pct")).alias("head"))
    extras = rows.where(F.col("relation").isin("part_of", "child_of")).groupBy("district").agg(F.count("*").alias("n_extra"))
    rank = F.array_position(F.array(*map(F.lit, RATED)), F.col("category"))
    worst = F.max(F.when(rank > 0, F.struct(rank.alias("rank"), "stage_pct", "name", "category")))
    per = units.groupBy("district", F.coalesce("category", F.lit("Not given")).alias("kind")).agg(F.count("*").alias("n"), worst.alias("w"), F.max(F.coalesce(F.col("category").isin(*STRESSED), F.lit(False))).alias("bad"))
    made = per.groupBy("district").agg(F.sum("n").alias("n_units"), F.map_from_entries(F.sort_array(F.collect_list(F.struct("kind", "n")))).alias("by_category"), F.max("w").alias("w"), F.max("bad").alias("critical"))
    out = districts.select("district").join(heads, "district", "left").join(extras, "district", "left").join(made, "district", "left")
    status = F.when(F.col("head").isNotNull(), "assessed").when(F.col("n_extra").isNotNull(), "only_sub_units").otherwise("not_in_source")
    out = out.withColumn("status", status).withColumn("known", F.col("status") != "not_in_source")
    seen = lambda c: F.when(F.col("known"), c)
    hidden = F.col("critical") & ~F.coalesce(F.col("head.category").isin(*STRESSED), F.lit(False))
    return out.select(
        "district", "status", F.col("head.category").alias("category"), F.col("head.stage_pct").alias("stage_pct"), seen(F.col("n_units")).alias("n_units"), seen(F.col("by_category")).alias("by_category"),
        seen(F.col("w.name")).alias("worst"), seen(F.col("critical")).alias("critical"), seen(hidden).alias("hidden"), F.coalesce("n_extra", F.lit(0)).alias("n_extra"),
    )


def publish_gate(layers: DataFrame, floors: dict[str, int]) -> DataFrame:
    """(layer, floor, n, as_of, ok): whether each layer that must be there has enough rows with a value and says as of when. layers: (layer, value, as_of), one row for each district."""
    spark = layers.sparkSession
    must = spark.createDataFrame([(k, v) for k, v in floors.items()], "layer string, floor long")
    seen = layers.groupBy("layer").agg(F.count("value").alias("n"), F.max("as_of").alias("as_of"))
    out = F.broadcast(must).join(seen, "layer", "left").withColumn("n", F.coalesce("n", F.lit(0)))  # a row a layer
    return out.withColumn("ok", (F.col("n") >= F.col("floor")) & F.col("as_of").isNotNull())


def missing(districts: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """Keys of the districts that no row has."""
    return districts.select(key).distinct().join(rows.select(key), key, "left_anti")
