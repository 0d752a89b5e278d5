"""Landed answers of services and tables in files: JSON of uncertain shape, line grammars, HTML tables, archived CSVs."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rainledger.functions.columns import finite, rounded
from rainledger.functions.names import STRESS_LABELS, coded

#: Keys under which an answer may hold its list.
LIST_KEYS = ("data", "content", "result")
#: Codes that end each half of an official line.
HALF_CODES = ("LE", "E", "N", "D", "LD", "NR", "ND")


def as_list(json: Column) -> Column:
    """The rows of an answer as an array of variants: the answer itself, or what it holds under a usual key; null for other shapes."""
    v = F.try_parse_json(json)
    return F.coalesce(*[F.try_variant_get(v, at, "array<variant>") for at in ("$", *(f"$.{k}" for k in LIST_KEYS))])


def first_of(v: Column, *keys: str) -> Column:
    """The first of the keys that holds something, as text."""
    return F.coalesce(*[F.nullif(F.try_variant_get(v, f"$.{k}", "string"), F.lit("")) for k in keys])


def answers(spark: SparkSession, path: str) -> DataFrame:
    """(file, row) of JSON files, one answer each."""
    whole = spark.read.option("wholetext", True).text(path).select(F.col("_metadata.file_name").alias("file"), "value")
    return whole.select("file", F.explode(as_list(F.col("value"))).alias("row"))


def real_rows(rows: DataFrame, name: str, key: str) -> DataFrame:
    """Rows but the total one and those without a key."""
    return rows.where((F.coalesce(F.lower(F.trim(name)), F.lit("")) != "total") & (F.coalesce(F.col(key), F.lit("")) != ""))


def total_of(v: Column, key: str) -> Column:
    """A number that stands alone or as the `total` of an object, to two places."""
    return rounded(finite(F.coalesce(F.try_variant_get(v, f"$.{key}.total", "double"), F.try_variant_get(v, f"$.{key}", "double"))), 2)


def assessment(v: Column) -> list[Column]:
    """The columns of an assessed unit, whatever of them its answer nests."""
    plain = lambda at: F.try_variant_get(v, at, "string")
    alone = F.when(~F.coalesce(plain("$.category").startswith("{"), F.lit(False)), plain("$.category"))
    cat, poor = F.coalesce(plain("$.category.total"), alone), plain("$.category.poor_quality")
    return [
        plain("$.locationName").alias("name"), plain("$.locationUUID").alias("key"),
        coded(cat, STRESS_LABELS, cat).alias("category"), coded(poor, STRESS_LABELS, poor).alias("poor_quality"),
        total_of(v, "stageOfExtraction").alias("stage_pct"), total_of(v, "totalGWAvailability").alias("extractable"),
        total_of(v, "rechargeData").alias("recharge"), total_of(v, "draftData").alias("extraction"),
    ]


def nested_places(spark: SparkSession, path: str) -> DataFrame:
    """(state, state_code, district, district_code) of state answers that hold their districts; rows without a district go."""
    s = answers(spark, path)
    inner = F.explode(F.coalesce(*[F.try_variant_get("row", f"$.{k}", "array<variant>") for k in ("districts", *LIST_KEYS)])).alias("d")
    both = s.select(first_of(F.col("row"), "statename", "stateName", "name").alias("state"), first_of(F.col("row"), "statecode", "stateCode").alias("state_code"), inner)
    out = both.select("state", "state_code", first_of(F.col("d"), "districtname", "districtName", "name").alias("district"), first_of(F.col("d"), "districtcode", "districtCode").alias("district_code"))
    return out.where("district IS NOT NULL")


def boundaries(spark: SparkSession, path: str, key: str, skip: Column | None = None) -> DataFrame:
    """(area, properties, rings) of features, one JSON object a line; rings of all parts of a polygon. skip: features of properties to leave out."""
    lines = spark.read.text(path).select(F.try_parse_json("value").alias("v"))
    one, many = (F.try_variant_get("v", "$.geometry.coordinates", f"array<{'array<' * n}array<array<double>>{'>' * n}>") for n in (0, 1))
    rings = F.when(F.try_variant_get("v", "$.geometry.type", "string") == "MultiPolygon", F.flatten(many)).otherwise(one)
    points = F.transform(rings, lambda r: F.transform(r, lambda p: F.struct(p[0].alias("x"), p[1].alias("y"))))
    out = lines.select(F.try_variant_get("v", f"$.properties.{key}", "long").alias("area"), F.try_variant_get("v", "$.properties", "map<string,string>").alias("properties"), points.alias("rings"))
    return out.where(F.col("area").isNotNull() & F.col("rings").isNotNull() & (F.lit(True) if skip is None else ~F.coalesce(skip, F.lit(False))))


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line_no, line) of text files."""
    whole = spark.read.option("wholetext", True).text(path).select(F.col("_metadata.file_name").alias("file"), "value")
    return whole.select("file", F.posexplode(F.split("value", "\r?\n")).alias("line_no", "line"))


def under_headings(lines: DataFrame, file: str, order: str, text: str, groups: list[tuple[str, str]], noise: str) -> DataFrame:
    """(file, order, row, group, place) of numbered rows with the headings above them.

    A line that doesn't start with a number is a heading: what stands before its
    numbers is the name of a group, if the list has it (then also of the group's
    place), else of a place, without `(UT)`. Lines that match noise, and empty
    ones, are none.
    """
    text_ = F.trim(F.col(text))
    numbered = F.col(text).rlike(r"^\d+\s+")
    kept = lines.where((text_ != "") & ~text_.rlike(noise))
    head = F.trim(F.regexp_extract(text_, r"^(.*?)(\s+-?\d.*)?$", 1))
    table = {k: v for k, v in groups}
    of = coded(head, table)
    marked = kept.withColumn("_group", F.when(~numbered & of.isNotNull(), head)).withColumn("_place", F.when(~numbered, F.coalesce(of, F.trim(F.regexp_replace(head, r"\(UT\)", "")))))
    w = W.partitionBy(file).orderBy(order).rowsBetween(W.unboundedPreceding, 0)
    carried = marked.withColumn("group", F.last("_group", ignorenulls=True).over(w)).withColumn("place", F.last("_place", ignorenulls=True).over(w))
    return carried.where(numbered).select(file, order, F.regexp_extract(text_, r"^\d+\s+(.*)$", 1).alias("row"), "group", "place")


def halves(tokens: Column) -> Column:
    """(day, period): the two halves of an official line, each (actual, normal, dep, code): three numbers and a code, or the normal alone where there is no data."""
    text = F.concat(F.lit(" "), F.array_join(tokens, " "), F.lit(" "))
    codes = "|".join(sorted(HALF_CODES, key=len, reverse=True))
    parts = F.regexp_extract_all(text, F.lit(rf"((?:\s-?\d+(?:\.\d+)?%?)*)\s+({codes})(?=\s)"), F.lit(0))

    def half(i: int) -> Column:
        part = F.get(parts, F.lit(i))
        numbers = F.transform(F.regexp_extract_all(part, F.lit(r"-?\d+(?:\.\d+)?"), F.lit(0)), lambda x: x.cast("double"))
        three, one = F.size(numbers) == 3, F.size(numbers) == 1
        get = lambda k: F.get(numbers, F.lit(k))
        code = F.regexp_extract(part, rf"({codes})\s*$", 1)
        return F.when(part.isNotNull(), F.struct(F.when(three, get(0)).alias("actual"), F.when(three, get(1)).when(one, get(0)).alias("normal"), F.when(three, get(2)).alias("dep"), code.alias("code")))

    return F.struct(half(0).alias("day"), half(1).alias("period"))


def official_rows(rows: DataFrame, row: str) -> DataFrame:
    """Adds name, day and period: the tokens before the first number or code are the name, but for a number that a capital word follows."""
    codes = "|".join(sorted(HALF_CODES, key=len, reverse=True))
    name = F.regexp_extract(F.col(row), rf"^((?:(?!(?:-?\d+(?:\.\d+)?%?|{codes})(?:\s|$))\S+(?:\s+|$)|\d+\s+(?=(?!(?:{codes})(?:\s|$))[A-Z]+(?:\s|$)))*)", 1)
    rest = F.split(F.trim(F.expr(f"substring(`{row}`, length(_name) + 1)")), r"\s+")
    return rows.withColumn("_name", name).withColumn("_halves", halves(rest)).withColumn("name", F.trim("_name")).select("*", "_halves.day", "_halves.period").drop("_name", "_halves")


def cumulative_last(text: Column) -> Column:
    """Array of (number, name, dep, n_weeks) of a week-by-week table in a text; the last week counts, ND is null.

    A line that starts with a number and a capital word begins a row; its values
    are the whole numbers and ND, two or more, at the end of this line or a
    later one. Lines between go on with the name, so they are in capitals; a row
    with any other line before its values is none.
    """
    parts = F.filter(F.split(text, r"\r?\n(?=[ \t]*\d+[ \t]+[A-Z])"), lambda x: x.rlike(r"^\s*\d+[ \t]+[A-Z]"))
    lines = lambda x: F.filter(F.transform(F.split(x, r"\r?\n"), lambda y: F.trim(y)), lambda y: y != "")
    valued = r"(?:(?:^|\s+)(?:-?\d+|ND)){2,}$"

    def row(part: Column) -> Column:
        each = lines(part)
        n = F.array_position(F.transform(each, lambda y: y.rlike(valued)), F.lit(True)).cast("int")
        own = F.slice(each, 1, F.greatest(n, F.lit(0)))
        whole = F.array_join(own, " ")
        values = F.split(F.trim(F.regexp_extract(whole, f"({valued})", 1)), r"\s+")
        name = F.regexp_replace(F.regexp_replace(whole, valued, ""), r"^\d+\s+", "")
        fine = (n > 0) & F.forall(own, lambda y: ~y.rlike("[a-z]"))
        return F.when(fine, F.struct(F.regexp_extract(whole, r"^(\d+)", 1).cast("int").alias("number"), F.regexp_replace(F.trim(name), r"\s+", " ").alias("name"), F.element_at(values, -1).try_cast("int").alias("dep"), F.size(values).cast("long").alias("n_weeks")))

    return F.filter(F.transform(parts, row), lambda x: x.isNotNull())


#: A comment, a tag (with `/` if it closes, its name and what stands in it) or text.
_PIECE = re.compile(r"""<!--.*?(?:-->|$)|<(?P<close>/?)(?P<name>[a-zA-Z][\w:-]*)(?P<inner>(?:"[^"]*"|'[^']*'|[^>"'])*)>|(?P<text>[^<]+|<)""", re.S)
_ATTRIBUTE = re.compile(r"""([\w:-]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}


def table_rows(page: str, table_id: str, skip_class: str) -> list[list[str]]:
    """The cells of the rows of tables with that id. A table inside a cell is text of that cell; elements of skip_class are none."""
    rows: list[list[str]] = []
    path: list[str] = []  # the open elements
    start = hidden = None  # how deep the table, and what is hidden, lie in path
    texts: list[str] | None = None

    def ended() -> None:
        nonlocal texts
        if texts is not None:
            rows[-1].append(" ".join(html.unescape("".join(texts)).replace("\u2212", "-").split()))
            texts = None

    for piece in _PIECE.finditer(page):
        name = (piece["name"] or "").lower()
        if piece["text"]:
            if texts is not None and hidden is None:
                texts.append(piece["text"])
        elif not name:
            continue
        elif piece["close"]:
            if name not in path[start or 0 :]:
                continue
            while path.pop() != name:
                pass
            if hidden is not None and len(path) <= hidden:
                hidden = None
            if start is not None and len(path) <= start:
                ended()
                start = None
            elif start is not None and name in ("td", "th", "tr") and "table" not in path[start + 1 :]:
                ended()
        else:
            attributes = {k.lower(): a or b or c for k, a, b, c in _ATTRIBUTE.findall(piece["inner"])}
            if start is None:
                if name == "table" and attributes.get("id") == table_id:
                    start = len(path)
            elif hidden is None and "table" not in path[start + 1 :] and name in ("tr", "td", "th"):
                ended()
                if name == "tr":
                    rows.append([])
                elif rows:
                    texts = []
            if name not in _VOID and not piece["inner"].endswith("/"):
                if start is not None and hidden is None and skip_class in attributes.get("class", "").split():
                    hidden = len(path)
                path.append(name)
    ended()
    return rows


def html_tables(pages: DataFrame, key: str, html: str, table_id: str, skip_class: str = "tooltip") -> DataFrame:
    """(key, row_no, cells) of the table with that id in each page; comments and what is in elements of skip_class are no text."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = [(k, i, row) for k, page in zip(batch[key], batch[html]) for i, row in enumerate(table_rows(page or "", table_id, skip_class)) if row]
            yield pd.DataFrame(out, columns=[key, "row_no", "cells"])

    kind = pages.schema[key].dataType.simpleString()
    return pages.select(key, html).mapInPandas(read, f"{key} {kind}, row_no int, cells array<string>")


def official_windows(spark: SparkSession, path: str) -> DataFrame:
    """(start, end, district, dep, category) of archived CSV files: a file's first row says its window; of two files of one window the snapshot counts, else the later name."""
    raw = spark.read.option("header", True).csv(path).withColumn("file", F.col("_metadata.file_name")).withColumn("dep", F.expr("try_cast(period_dep_pct AS double)"))
    said = raw.where("dep IS NOT NULL").select("file", F.expr("try_cast(period_start AS date)").alias("start"), F.expr("try_cast(period_end AS date)").alias("end"), F.expr("try_cast(dist_lgd AS long)").alias("district"), "dep", "category")
    rank = F.struct(F.col("file").startswith("snapshot").alias("s"), F.col("file").alias("f"))
    best = said.groupBy("start", "end").agg(F.max_by("file", rank).alias("file"))
    return said.join(F.broadcast(best), ["start", "end", "file"]).drop("file")  # a row a file
