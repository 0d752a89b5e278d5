"""Exact deduplication by Grace hashing.

Each task first runs its rows through an open-addressing table that compares
whole contents, so a text that many rows hold leaves it once. What is left is
dealt by hash to buckets, which lie in Spark's shuffle files. A bucket's rows
stream through a table of bounded bytes; texts that find it full are spilled
whole and are dealt again by another hash. More bytes than one exchange should
deal are first written in parts, each dealt by itself. Hashes choose places
only: two texts are equal if their bytes are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rainledger.llm.frames import Scratch, release, utf8

#: Bytes of a bucket's table; bytes and rows that a task's first table takes before it starts anew.
BUCKET, LOCAL, LOCAL_ROWS = 64 << 20, 32 << 20, 1 << 17
#: Most buckets of one exchange.
FAN = 1 << 14
#: Texts that leave more tasks than this are merged in so many turns before they meet; at most so many texts have it (others go without).
HOT, TURNS, MOST_HOT = 1024, 64, 4096
#: Bytes of a row batch that leaves a task.
BATCH = 4 << 20


class Contents:
    """An open-addressing table of whole contents with linear probing, at most half full."""

    def __init__(self):
        self.slots, self.hashes, self.held, self.bytes = [-1] * 1024, [], [], 0

    def find(self, h: int, content: bytes) -> tuple[int, int]:
        """The entry with this content (-1: none) and the slot where the search ended."""
        mask = len(self.slots) - 1
        at = h & mask
        while (k := self.slots[at]) >= 0:
            if self.hashes[k] == h and self.held[k] == content:
                return k, at
            at = (at + 1) & mask
        return -1, at

    def add(self, h: int, content: bytes, slot: int) -> int:
        """A new entry at the slot that find gave."""
        k = len(self.held)
        self.slots[slot] = k
        self.hashes.append(h)
        self.held.append(content)
        self.bytes += len(content)
        if 2 * k > len(self.slots):
            self.slots = [-1] * (2 * len(self.slots))
            mask = len(self.slots) - 1
            for i, x in enumerate(self.hashes):
                at = x & mask
                while self.slots[at] >= 0:
                    at = (at + 1) & mask
                self.slots[at] = i
        return k


def _after(a, b) -> bool:
    """Whether id a comes after b; null comes before all."""
    return a is not None and (b is None or a > b)


def _batches(rows: list[tuple], schema: pa.Schema, size: int) -> Iterator[pa.RecordBatch]:
    """rows as batches of about BATCH bytes; rows[k][size] counts for a row's bytes."""
    first = held = 0
    for k, row in enumerate(rows):
        held += row[size] + 64
        if held >= BATCH or k == len(rows) - 1:
            columns = zip(*rows[first : k + 1], strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(columns, schema, strict=True)], schema=schema)
            first, held = k + 1, 0


def _representatives(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """A row for each different text of a task's table: rep (its number), reps ([rep]), h, content, size, n (rows), top (the largest id), ids of the rows, best (which of them is the largest)."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, turn = TaskContext.get().partitionId() << 32, 0
        table, ids, best, rows, schema = Contents(), [], [], 0, None

        def flush() -> Iterator[pa.RecordBatch]:
            out = []
            for k, content in enumerate(table.held):
                rep = part | (turn + k)
                out.append((rep, [rep], np.uint64(table.hashes[k]).view(np.int64).item(), content, len(content), len(ids[k]), ids[k][best[k]], ids[k], best[k]))
            yield from _batches(out, schema, 4)

        for batch in batches:
            id_type = batch.schema.field("id").type
            schema = pa.schema([("rep", pa.int64()), ("reps", pa.list_(pa.int64())), ("h", pa.int64()), ("content", pa.binary()), ("size", pa.int64()), ("n", pa.int64()), ("top", id_type), ("ids", pa.list_(id_type)), ("best", pa.int32())])
            for who, text in zip(batch.column("id").to_pylist(), utf8(batch.column("text")), strict=True):
                content = text.lower()
                h = xxhash.xxh3_64_intdigest(content)
                k, slot = table.find(h, content)
                if k < 0:
                    table.add(h, content, slot)
                    ids.append([who])
                    best.append(0)
                else:
                    if _after(who, ids[k][best[k]]):
                        best[k] = len(ids[k])
                    ids[k].append(who)
                rows += 1
                if table.bytes >= LOCAL or rows >= LOCAL_ROWS:
                    yield from flush()
                    turn += len(table.held)
                    table, ids, best, rows = Contents(), [], [], 0
                    release()
        if rows:
            yield from flush()
        table = ids = best = None
        release()

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"rep long, reps array<long>, h long, content binary, size long, n long, top {kind}, ids array<{kind}>, best int")


ROW = ["rep", "reps", "h", "content", "size", "n", "top"]


def _through_tables(rows: DataFrame, bound: int, decide: bool) -> DataFrame:
    """Rows of a partition with equal contents as one. Once a table holds `bound` bytes, other texts leave as they came.

    decide: what the table holds leaves with its sha256 and no content, as all its rows have been seen.
    """
    kind = rows.schema["top"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, kept, schema = Contents(), [], None
        for batch in batches:
            schema = schema or pa.schema([*(batch.schema.field(x) for x in ROW), ("sha", pa.string())])
            spilled = []
            for row in zip(*(batch.column(x).to_pylist() for x in ROW), strict=True):
                rep, reps, h, content, size, n, top = row
                k, slot = table.find(h & (1 << 64) - 1, content)
                if k >= 0:
                    own = kept[k]
                    own[1] += reps
                    own[5] += n
                    if _after(top, own[6]):
                        own[0], own[6] = rep, top
                elif table.bytes < bound:
                    table.add(h & (1 << 64) - 1, content, slot)
                    kept.append([rep, reps, h, None, size, n, top])
                else:
                    spilled.append((*row, None))
            yield from _batches(spilled, schema, 4)
        out = [(*x[:3], None, *x[4:], hashlib.sha256(c).hexdigest()) if decide else (*x[:3], c, *x[4:], None) for x, c in zip(kept, table.held, strict=True)]
        if out:
            yield from _batches(out, schema, 4)
        table = kept = out = None
        release()

    return rows.select(*ROW).mapInArrow(run, f"rep long, reps array<long>, h long, content binary, size long, n long, top {kind}, sha string")


def _settled_groups(rows: DataFrame, scratch: Scratch, level: int, bound: int, fan: int, hot: int) -> list[DataFrame]:
    """Tables with a row for each different text of rows, with its sha256."""
    total = rows.agg(F.sum(F.col("size") + 64)).first()[0]
    if not total:
        return []
    buckets = -(-2 * total // bound)
    dealt = F.xxhash64("h", F.lit(level))
    if buckets > fan:
        parts = min(-(-buckets // fan), fan)
        spilled = scratch.settled(rows.withColumn("part", F.pmod(dealt, F.lit(parts))).repartition(fan, "part", F.pmod("rep", F.lit(TURNS))).sortWithinPartitions("part"))
        found = []
        for k in range(parts):
            found += _settled_groups(spilled.where(F.col("part") == k).drop("part"), scratch, level + 1, bound, fan, hot)
        scratch.drop(spilled)
        return found
    width = max(buckets, rows.sparkSession.sparkContext.defaultParallelism)
    often = rows.groupBy("h").count().where(F.col("count") > hot).orderBy(F.desc("count"), "h").limit(MOST_HOT).select("h")
    if often.head(1):
        told = rows.join(F.broadcast(often.withColumn("often", F.lit(True))), "h", "left").select(*ROW, "often")
        merged = _through_tables(told.where("often").repartition(width, "h", F.pmod(F.xxhash64("rep"), F.lit(TURNS))), bound, False).select(*ROW)
        rows = told.where("often is null").select(*ROW).union(merged)
    out = scratch.settled(_through_tables(rows.repartition(width, dealt), bound, True))
    return [out.where("sha is not null"), *_settled_groups(out.where("sha is null").drop("sha"), scratch, level + 1, bound, fan, hot)]


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bound: int = BUCKET, fan: int = FAN, hot: int = HOT) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of each row of docs.

    Texts are equal when their UTF-8 bytes are, A-Z in lower case; a null text
    counts as empty. Of equal texts, the row with the largest id stays; a null
    id is smaller than all others. Exactly one row of a group is kept, so of
    repeated rows one is, and keep_id is null where all ids are. Very long
    texts are compared whole. Other columns aren't read; an empty table gives
    no rows. bound: bytes of a bucket's table; fan: buckets of one exchange;
    hot: tasks from which a text is merged in turns.
    """
    scratch = Scratch(docs.sparkSession)
    rows = scratch.settled(_representatives(docs, id_col, text_col))
    kind = docs.schema[id_col].dataType.simpleString()
    found = _settled_groups(rows.select(*ROW), scratch, 0, bound, fan, hot)
    each = "explode(reps) AS rep, rep AS winner, top AS keep_id, n AS group_size, sha AS text_sha256"
    groups = [x.selectExpr(*each.split(", ")) for x in found]
    if not groups:
        return docs.sparkSession.createDataFrame([], f"doc_id {kind}, keep_id {kind}, group_size long, kept boolean, text_sha256 string")
    told = rows.select("rep", "ids", "best").join(reduce(DataFrame.union, groups).hint("shuffle_hash"), "rep")
    return told.select("rep", "winner", "best", "keep_id", "group_size", "text_sha256", F.posexplode("ids").alias("at", "doc_id")).select("doc_id", "keep_id", "group_size", ((F.col("rep") == F.col("winner")) & (F.col("at") == F.col("best"))).alias("kept"), "text_sha256")


def oracle() -> str:
    """DuckDB SQL for the groups of documents; its ids differ, so no two rows tie."""
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
WITH t AS (SELECT doc_id, {lower} AS own FROM documents),
g AS (SELECT own, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY own)
SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id AS kept, sha256(t.own) AS text_sha256
FROM t JOIN g ON t.own = g.own
"""
