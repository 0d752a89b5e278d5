"""Benchmark decontamination by template canonicalisation, in DataFrame functions alone.

Numbers, names and units of documents and benchmark items give way to typed
placeholders; windows of the templates are joined by hash. Windows that meet on
one diagonal (document position less item position) make a match; it holds if
the words that stand in its slots map one to one between item and document, so
a question with other numbers or names is caught, and a text that only shares
a shape isn't.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rainledger.llm.frames import settled

#: Bytes of the benchmark's windows (with their slots) that are broadcast at most; beyond that the joins are shuffled.
BROADCAST_BYTES = 64 << 20
#: Words that are units where they follow a number.
UNITS = (
    "mm cm m km inch inches foot feet yard yards mile miles mg g kg ton tons ounce ounces pound pounds ml l litre litres liter liters gallon gallons "
    "s sec second seconds min minute minutes h hour hours day days week weeks month months year years percent degrees dollars euros cents usd eur kb mb gb"
).split()
WORD = r"(?:[\p{N}]+(?:[.,][\p{N}]+)*|[\p{L}][\p{L}\p{M}]*)"
#: A word with the end of a sentence before it, if there's one.
HEADED = r"(?:[.!?:\n\r][^\p{L}\p{N}]*)?" + WORD
#: The same, with the sentence's end and what the word starts with as groups: a number's first character, or a capital and a small letter.
MARKED = r"((?:[.!?:\n\r][^\p{L}\p{N}]*)?)(?=(\p{N}|\p{Lu}\p{Ll}|))" + WORD
#: What a text needs to have a number or a name in it; to have a word with a capital.
SLOTTED = r"[\p{N}]|[\p{L},;][ \t]+\p{Lu}\p{Ll}"
CAPITAL = r"\p{Lu}\p{Ll}"


KIND = "array<struct<pos:int,h:bigint,slots:array<string>,wide:boolean>>"


def _at(words: Column, i: Column) -> Column:
    return F.get(words, i)


def with_marks(rows: DataFrame) -> DataFrame:
    """Adds words (lower case), slotted, and marks and heads: for each word its first number character, or capital and small letter, and the sentence's end before it. They are null for texts without numbers and capitals."""
    slotted = F.col("text").rlike(SLOTTED)
    rows = rows.withColumn("slotted", slotted).withColumn("marks", F.when(F.col("slotted") | F.col("text").rlike(CAPITAL), F.regexp_extract_all("text", F.lit(MARKED), F.lit(2))))
    rows = rows.withColumn("heads", F.when(F.col("slotted") & F.col("marks").isNotNull(), F.regexp_extract_all("text", F.lit(MARKED), F.lit(1))))
    rows = rows.withColumn("words", F.regexp_extract_all(F.lower("text"), F.lit(WORD), F.lit(0)))
    # Where lower case has other words than the text (odd letters), each word is lowered by itself.
    apart = F.transform(F.regexp_extract_all("text", F.lit(HEADED), F.lit(0)), lambda r: F.lower(F.regexp_extract(r, WORD + "$", 0)))
    return rows.withColumn("words", F.when(F.size("marks") != F.size("words"), apart).otherwise(F.col("words")))


def _placed(w: Column, i: Column) -> Column:
    """The placeholder of a word, or the word."""
    number = lambda k: F.length(_at(F.col("marks"), k)) == 1
    named = (i > 0) & (F.length(_at(F.col("marks"), i)) == 2) & (_at(F.col("heads"), i) == "")
    return F.when(number(i), "#num").when((i > 0) & number(i - 1) & w.isin(UNITS), "#unit").when(named, "#name").otherwise(w)


def _capital(t: Column, i: Column) -> Column:
    """A placeholder for a word with a capital at the start of the text or a sentence, too."""
    return F.when((F.length(_at(F.col("marks"), i)) == 2) & ~t.startswith("#"), "#name").otherwise(t)


def with_words(rows: DataFrame) -> DataFrame:
    """Adds words (lower case), template (words with placeholders) and capitals (capitalised words at the start of the text or a sentence are placeholders too) from the column text; null where they're the same."""
    rows = with_marks(rows)
    rows = rows.withColumn("template", F.when(F.col("slotted"), F.transform("words", _placed)))
    named = F.when(F.col("slotted"), F.transform("template", _capital)).otherwise(F.transform("words", _capital))
    return rows.withColumn("capitals", F.when(F.col("marks").isNotNull(), named)).drop("marks", "heads", "slotted")


def _hashes(rows: DataFrame, source: str, width: int, hashed: bool = False) -> DataFrame:
    """Turns the array of words (or of their hashes) in a column into one of the hashes of its windows of width words, a power of two, by doubling."""
    out = rows if hashed else rows.withColumn(source, F.transform(source, lambda w: F.xxhash64(w)))
    step = 1
    while step < width:
        x = F.col(source)
        longer = F.zip_with(x, F.slice(x, F.lit(step + 1), F.size(x)), lambda a, b: F.xxhash64(a, b))
        out = out.withColumn(source, F.when(F.size(x) > step, F.slice(longer, F.lit(1), F.size(x) - step)).when(x.isNotNull(), F.array().cast("array<bigint>")))
        step *= 2
    return out


def _window(i: Column, h: Column, template: str | None, width: int, strict: int) -> Column:
    """pos, h, slots and wide (more than strict slots) of the window of width words from word i (from 0)."""
    slots = F.lit(None).cast("array<string>")
    if template:
        near = F.arrays_zip(F.slice(template, i + 1, F.lit(width)).alias("t"), F.slice("words", i + 1, F.lit(width)).alias("w"))
        slots = F.transform(F.filter(near, lambda x: x["t"].startswith("#")), lambda x: x["w"])
    return F.struct(i.alias("pos"), h.alias("h"), slots.alias("slots"), F.coalesce(F.size(slots) > strict, F.lit(False)).alias("wide"))


def windows(rows: DataFrame, keys: list[str], width: int) -> DataFrame:
    """keys, pos (from 0), h, slots (words in the placeholders; null where there's none) and wide of each window of the words and of the templates.

    wide: a template's window with more than three slots in eight words, or
    with a placeholder for a word at the start of a sentence.
    """
    if width & (width - 1):
        raise ValueError("a window's width is a power of two")
    both = with_words(rows).withColumn("h1", F.col("words")).withColumn("h2", F.col("template")).withColumn("h3", F.col("capitals"))
    for source in ("h1", "h2", "h3"):
        both = _hashes(both, source, width)
    plain = F.transform("h1", lambda h, i: _window(i, h, None, width, 0))

    def typed(source: str, template: str, than: Column, strict: int) -> Column:
        other = F.filter(F.transform(source, lambda h, i: F.struct(i.alias("i"), h.alias("h"))), lambda x: x["h"] != _at(than, x["i"]))
        return F.coalesce(F.transform(other, lambda x: _window(x["i"], x["h"], template, width, strict)), F.array().cast(KIND))

    found = F.concat(plain, typed("h2", "template", F.col("h1"), width * 3 // 8), typed("h3", "capitals", F.coalesce("h2", "h1"), -1))
    return both.select(*keys, F.explode(found).alias("w")).select(*keys, "w.*")


def window_hashes(rows: DataFrame, keys: list[str], width: int) -> DataFrame:
    """keys, pos and h of each window as in windows, without slots: all that tells which texts may hold an item. A window may come more than once."""
    rows = with_marks(rows)
    hashed = lambda f: F.transform("words", lambda w, i: F.xxhash64(f(w, i)))
    both = rows.withColumn("h1", F.transform("words", lambda w: F.xxhash64(w))).withColumn("h2", F.when(F.col("slotted"), hashed(_placed)))
    named = F.when(F.col("slotted"), hashed(lambda w, i: _capital(_placed(w, i), i))).otherwise(hashed(_capital))
    both = both.withColumn("h3", F.when(F.col("marks").isNotNull(), named)).select(*keys, "h1", "h2", "h3")
    for source in ("h1", "h2", "h3"):
        both = _hashes(both, source, width, hashed=True)
    none = F.array().cast("array<bigint>")
    every = F.concat("h1", F.coalesce("h2", none), F.coalesce("h3", none))
    return both.select(*keys, F.size("h1").alias("n"), F.posexplode(every).alias("p", "h")).select(*keys, (F.col("p") % F.col("n")).alias("pos"), "h")


def short_windows(rows: DataFrame, keys: list[str], sizes: list[int], whole: bool = False) -> DataFrame:
    """The windows of these numbers of words, as in windows; with whole, those of texts of that many words only. Windows of nothing but slots say nothing and are left out."""
    found = with_words(rows)

    def of(n: int, source: str, template: str | None) -> Column:
        starts = F.when((F.size(source) == n) if whole else (F.size(source) >= n), F.sequence(F.lit(0), F.size(source) - n))
        made = F.transform(starts, lambda i: _window(i, F.xxhash64(F.lit(n), F.slice(source, i + 1, F.lit(n))), template, n, -1))
        made = F.filter(made, lambda x: F.size(x["slots"]).between(1, n - 1)) if template else made
        return F.coalesce(made, F.array().cast(KIND))

    every = F.concat(*(of(n, *x) for n in sizes for x in (("words", None), ("template", "template"), ("capitals", "capitals"))))
    return found.select(*keys, F.explode(every).alias("w")).select(*keys, "w.pos", "w.h", "w.slots", F.lit(True).alias("wide"))


def leaks(docs: DataFrame, benchmark: DataFrame, width: int = 8, least: int = 6, most_broadcast: int = BROADCAST_BYTES, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row a document and benchmark item that it holds: doc_id, text_key, item_id, n_windows, coverage, n_slots, exact.

    A document holds an item if `least` windows of `width` words (all of them,
    if the item has fewer) meet on one diagonal, and either stand there word
    for word (exact) or all their slots map one to one. An item of under
    `width` words has one window, the whole of it. n_windows counts the item's
    windows met on the best diagonal, coverage is their share, n_slots the
    different slot fillings there. Where windows that aren't wide hold the item
    by themselves, as oracle() says it, these columns count them only; where
    they don't, all windows are counted and judged. text_key is the xxhash64 of the
    text; repeated rows of documents or of items count once, null ids are kept
    as ids, and null or empty texts have no windows and match nothing.
    Ties between diagonals fall to the smaller one. Other columns aren't read.
    First all windows are met by their hashes alone; only texts of which enough
    meet on a diagonal are read again, with their slots. The items are broadcast
    if their windows, counted with their bytes first, take at most most_broadcast
    bytes; else the joins are shuffled.
    """
    asked = benchmark.select(F.col(item_col).alias("item_id"), F.col(item_text_col).alias("text")).where("text is not null").distinct()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).where("text is not null").withColumn("text_key", F.xxhash64("text"))
    sizes = sorted(r.n for r in with_words(asked).select(F.size("words").alias("n")).where(F.col("n").between(1, width - 1)).distinct().collect())
    items = windows(asked, ["item_id"], width)
    if sizes:
        items = items.unionByName(short_windows(asked, ["item_id"], sizes, whole=True))
    items = items.distinct()
    totals = items.groupBy(F.col("item_id").alias("of")).agg(F.countDistinct("pos").alias("total"))
    items = items.join(totals, F.col("item_id").eqNullSafe(F.col("of"))).select("item_id", F.col("pos").alias("item_pos"), "h", F.col("slots").alias("item_slots"), F.col("wide").alias("item_wide"), "total")
    each = F.lit(64) + F.coalesce(F.aggregate("item_slots", F.lit(0), lambda n, x: n + F.octet_length(x) + 16), F.lit(0)) + F.coalesce(F.octet_length(F.col("item_id").cast("string")), F.lit(0))
    near = F.broadcast if (items.agg(F.sum(each)).first()[0] or 0) <= most_broadcast else lambda df: df
    items, keys = near(items), ["doc_id", "text_key"]
    first = window_hashes(rows, keys, width)
    if sizes:
        first = first.unionByName(short_windows(rows, keys, sizes).select(*keys, "pos", "h"))
    places = near(items.groupBy("item_id", "item_pos", "h").agg(F.max("total").alias("total")))
    many = first.join(places, "h").groupBy(*keys, "item_id", (F.col("pos") - F.col("item_pos")).alias("diagonal")).agg(F.countDistinct("item_pos").alias("n"), F.max("total").alias("total"))
    may = many.where(F.col("n") >= F.least(F.lit(least), F.col("total"))).select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).distinct()
    may = settled(may)
    rows = rows.join(may, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key")), "left_semi")
    found = windows(rows, keys, width)
    if sizes:
        found = found.unionByName(short_windows(rows, keys, sizes))
    met = found.join(items, "h")
    met = met.where(F.coalesce(F.size("slots"), F.lit(-1)) == F.coalesce(F.size("item_slots"), F.lit(-1)))
    same, narrow = F.col("slots").eqNullSafe(F.col("item_slots")), ~F.col("wide") & ~F.col("item_wide")
    pairs = F.coalesce(F.zip_with("item_slots", "slots", lambda a, b: F.struct(a.alias("a"), b.alias("b"))), F.array().cast("array<struct<a:string,b:string>>"))
    distinct_pairs = lambda x: F.array_distinct(F.flatten(F.collect_set(x)))
    by = met.groupBy("doc_id", "text_key", "item_id", (F.col("pos") - F.col("item_pos")).alias("diagonal")).agg(
        F.max("total").alias("total"),
        F.size(F.collect_set("item_pos")).alias("n_all"),
        F.size(F.collect_set(F.when(narrow, F.col("item_pos")))).alias("n_narrow"),
        F.size(F.collect_set(F.when(same, F.col("item_pos")))).alias("n_exact"),
        distinct_pairs(pairs).alias("pairs_all"),
        distinct_pairs(F.when(narrow, pairs)).alias("pairs_narrow"),
    )

    def one_to_one(pairs: str) -> Column:
        sized = lambda part: F.size(F.array_distinct(F.transform(pairs, lambda x: x[part])))
        return (F.size(pairs) == sized("a")) & (F.size(pairs) == sized("b"))

    needed = F.least(F.lit(least), F.col("total"))
    by = by.withColumn("exact", F.col("n_exact") >= needed)
    by = by.withColumn("narrow", (F.col("n_narrow") >= needed) & (F.col("exact") | one_to_one("pairs_narrow")))
    held = by.where(F.col("exact") | F.col("narrow") | (one_to_one("pairs_all") & (F.col("n_all") >= needed)))
    n = F.when(F.col("narrow"), F.col("n_narrow")).otherwise(F.col("n_all"))
    fills = F.when(F.col("narrow"), F.size("pairs_narrow")).otherwise(F.size("pairs_all"))
    best = F.struct("narrow", n.alias("n"), (-F.col("diagonal")).alias("d"), (n / F.col("total")).alias("coverage"), fills.alias("n_slots"))
    return (
        held.groupBy("doc_id", "text_key", "item_id")
        .agg(F.max(best).alias("b"), F.max("exact").alias("exact"))
        .select("doc_id", "text_key", "item_id", F.col("b.n").cast("long").alias("n_windows"), F.col("b.coverage").alias("coverage"), F.col("b.n_slots").cast("long").alias("n_slots"), "exact")
    )


def without_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The rows of docs, all columns, that hold no benchmark item; see leaks. Null texts stay."""
    found = leaks(docs, benchmark, id_col=id_col, text_col=text_col, **how).select(F.col("doc_id").alias("_leak_id"), F.col("text_key").alias("_leak_key")).distinct()
    return docs.join(found, docs[id_col].eqNullSafe(F.col("_leak_id")) & (F.xxhash64(docs[text_col]) == F.col("_leak_key")), "left_anti")


def oracle(width: int = 8, least: int = 6) -> str:
    """DuckDB SQL for the rows of leaks over documents and benchmark, without text_key."""
    units = ", ".join(f"'{u}'" for u in UNITS)
    word, headed, slotted = WORD, HEADED.replace(r"\n\r", "\\n\\r"), SLOTTED

    def spread(name: str, key: str) -> str:
        return f"""
  {name}_raw AS (SELECT DISTINCT {key}, text, CASE WHEN regexp_matches(text, '{slotted}') THEN regexp_extract_all(text, '{headed}') END AS raw FROM {name} WHERE text IS NOT NULL),
  {name}_words AS (SELECT {key}, text, raw, CASE WHEN raw IS NULL THEN regexp_extract_all(lower(text), '{word}') ELSE list_transform(raw, lambda r: lower(regexp_extract(r, '{word}$'))) END AS words FROM {name}_raw),
  {name}_plain AS (SELECT {key}, text, raw, words, unnest(range(len(words)::BIGINT)) AS i FROM {name}_words),
  {name}_one AS (SELECT {key}, text, i, words[i + 1] AS w, CASE WHEN raw IS NULL THEN words[i + 1]
      WHEN regexp_matches(words[i + 1], '^\\p{{N}}') THEN '#num'
      WHEN i > 0 AND regexp_matches(words[i], '^\\p{{N}}') AND words[i + 1] IN ({units}) THEN '#unit'
      WHEN i > 0 AND regexp_matches(raw[i + 1], '^\\p{{Lu}}\\p{{Ll}}') THEN '#name' ELSE words[i + 1] END AS t FROM {name}_plain),
  {name}_lists AS (SELECT {key}, text, list(w ORDER BY i) AS ws, list(t ORDER BY i) AS ts FROM {name}_one GROUP BY ALL),
  {name}_at AS (SELECT {key}, text, ws, ts, unnest(range(len(ws) - {width - 1})) AS pos FROM {name}_lists WHERE len(ws) >= {width}),
  {name}_both AS (SELECT {key}, text, pos, ws[pos + 1:pos + {width}] AS w, ts[pos + 1:pos + {width}] AS t FROM {name}_at),
  {name}_w AS (
    SELECT DISTINCT {key}, text, pos, array_to_string(w, ' ') AS h, NULL::VARCHAR[] AS slots FROM {name}_both
    UNION SELECT {key}, text, pos, array_to_string(t, ' '), list_filter(w, lambda x, k: t[k] LIKE '#%') FROM {name}_both
    WHERE len(list_filter(t, lambda x: x LIKE '#%')) BETWEEN 1 AND {width * 3 // 8}),"""

    return rf"""WITH {spread("documents", "doc_id")} {spread("benchmark", "item_id")}
  totals AS (SELECT item_id, count(DISTINCT pos) AS total FROM benchmark_w GROUP BY item_id),
  met AS (SELECT d.doc_id, d.text, b.item_id, d.pos - b.pos AS diagonal, b.pos AS item_pos, d.slots, b.slots AS item_slots, total
    FROM documents_w d JOIN benchmark_w b ON d.h = b.h AND coalesce(len(d.slots), -1) = coalesce(len(b.slots), -1) JOIN totals t ON t.item_id IS NOT DISTINCT FROM b.item_id),
  grouped AS (SELECT doc_id, text, item_id, diagonal, max(total) AS total, count(DISTINCT item_pos) AS n,
      count(DISTINCT item_pos) FILTER (WHERE slots IS NOT DISTINCT FROM item_slots) AS n_exact FROM met GROUP BY ALL),
  slot_pairs AS (SELECT DISTINCT doc_id, text, item_id, diagonal, unnest(item_slots) AS a, unnest(slots) AS b FROM met WHERE slots IS NOT NULL),
  fills AS (SELECT doc_id, text, item_id, diagonal, count(*) AS n_slots, count(DISTINCT a) AS n_a, count(DISTINCT b) AS n_b FROM slot_pairs GROUP BY ALL),
  judged AS (SELECT g.*, coalesce(n_slots, 0) AS n_slots, n_exact >= least({least}, total) AS exact, coalesce(n_slots = n_a AND n_slots = n_b, true) AS one_to_one
    FROM grouped g LEFT JOIN fills f ON g.doc_id IS NOT DISTINCT FROM f.doc_id AND g.text = f.text AND g.item_id IS NOT DISTINCT FROM f.item_id AND g.diagonal = f.diagonal),
  held AS (SELECT * FROM judged WHERE exact OR (one_to_one AND n >= least({least}, total)))
SELECT doc_id, item_id, max(n)::BIGINT AS n_windows, arg_max(n::DOUBLE / total, (n, -diagonal)) AS coverage, arg_max(n_slots, (n, -diagonal))::BIGINT AS n_slots, bool_or(exact) AS exact
FROM held GROUP BY doc_id, text, item_id"""
