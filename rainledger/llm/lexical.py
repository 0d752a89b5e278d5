"""Ranked lexical search over a bit-sliced impact index.

What a term adds to a document's score is an integer, its impact. A block of
documents keeps, for each term, one bitmap for each bit of the impacts. A query
adds its terms' bitmaps by bitwise carry arithmetic, 64 documents at a time, and
finds its best documents from the most significant sum bits down. Blocks hold
counts of the queried terms only; bitmaps are made from them once the corpus
counts, which each impact depends on, are known.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rainledger.llm.frames import Scratch, release, utf8

#: Documents and bytes of a block; terms whose bitmaps are in memory at once.
DOCS, BYTES, TERMS = 8192, 64 << 20, 1024
#: Bytes of query terms of one round: they are broadcast with the tasks.
ROUND = 16 << 20
#: Bytes that stand in terms: A-Z as a-z, digits, a-z and all beyond ASCII; all others are white space.
_kept = bytes(c + 32 if 65 <= c <= 90 else c if chr(c).isalnum() or c > 127 else 32 for c in range(256))


def terms(text: bytes) -> list[bytes]:
    """The maximal runs of ASCII letters, digits and characters beyond ASCII, only A-Z in lower case."""
    return text.translate(_kept).split()


class Postings:
    """Counts of some terms in a block of documents; documents by rising id, null last."""

    def __init__(self):
        self.ids, self.lengths, self.doc, self.term, self.tf, self.bytes = [], [], [], [], [], 0

    def add(self, who, text: bytes, numbers: dict[bytes, int]) -> None:
        own, found = terms(text), {}
        for t in own:
            if (k := numbers.get(t)) is not None:
                found[k] = found.get(k, 0) + 1
        self.doc += [len(self.ids)] * len(found)
        self.term += found.keys()
        self.tf += found.values()
        self.ids.append(who)
        self.lengths.append(len(own))
        self.bytes += len(text)

    def row(self, id_type: pa.DataType) -> pa.RecordBatch:
        """A row of the block: its ids and lengths; its terms, each with the number of its documents; documents and counts in the order of the terms."""
        order = sorted(range(len(self.ids)), key=lambda k: (self.ids[k] is None, self.ids[k] if self.ids[k] is not None else 0))
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        doc, term, tf = place[np.array(self.doc, np.int64)], np.array(self.term, np.int64), np.array(self.tf, np.int64)
        by = np.lexsort((doc, term))
        held, df = np.unique(term, return_counts=True)
        lists = [(pa.array([self.ids[k] for k in order], id_type), id_type), (np.array(self.lengths, np.int64)[order], pa.int64()), (held, pa.int32()), (df, pa.int32()), (doc[by], pa.int32()), (tf[by], pa.int64())]
        return pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), pa.array(x, t)) for x, t in lists], ["ids", "lengths", "terms", "dfs", "docs", "tfs"])


def postings(docs: DataFrame, numbers: dict[bytes, int], id_col: str, text_col: str) -> DataFrame:
    """Blocks of all docs with the counts of these terms."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, id_type = Postings(), None
        for batch in batches:
            id_type = batch.schema.field("id").type
            for who, text in zip(batch.column("id").to_pylist(), utf8(batch.column("text")), strict=True):
                held.add(who, text, numbers)
                if len(held.ids) >= DOCS or held.bytes >= BYTES:
                    yield held.row(id_type)
                    held = Postings()
                    release()
        if held.ids:
            yield held.row(id_type)

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"ids array<{kind}>, lengths array<long>, terms array<int>, dfs array<int>, docs array<int>, tfs array<long>")


def impacts(tf: np.ndarray, length: np.ndarray, weight: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """What terms with these counts add to the scores of documents of these lengths, in 64-bit integers."""
    m = 50 + (50 * length * n_docs) // n_terms
    return weight * ((1_000_000_000 * tf) // (1000 * tf + 20 * m))


def slices(row: np.ndarray, doc: np.ndarray, impact: np.ndarray, rows: int, words: int) -> np.ndarray:
    """Bitmaps (bit, row, word) of impacts; the (row, doc) pairs rise, and the last row is empty."""
    bits = int(impact.max(initial=0)).bit_length()
    out = np.zeros((bits, rows + 1, words * 8), np.uint8)
    at, mark = row * (words * 8) + (doc >> 3), np.uint8(1) << (doc & 7).astype(np.uint8)
    for b in range(bits):
        on = np.flatnonzero(impact >> b & 1)
        if len(on):
            first = np.flatnonzero(np.diff(at[on], prepend=-1))
            out[b].reshape(-1)[at[on][first]] = np.bitwise_or.reduceat(mark[on], first)
    return out.view(np.uint64)


def summed(maps: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """Bitmaps (bit, query, word) of the sums of the rows chosen[query]: ripple-carry addition of bitmaps."""
    bits, width = len(maps), chosen.shape[1]
    out = np.zeros((bits + max(width, 1).bit_length(), len(chosen), maps.shape[2]), np.uint64)
    for turn in range(width):
        carry = None
        for b in range(len(out)):
            if b < bits:
                x, a = maps[b, chosen[:, turn]], out[b]
                half = a ^ x
                over = a & x
                if carry is not None:
                    over |= half & carry
                    half ^= carry
                out[b], carry = half, over
            else:
                if carry is None or not carry.any():
                    break
                out[b], carry = out[b] ^ carry, out[b] & carry
    return out


def best(sums: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Bitmaps (query, word) of documents that are surely among a query's k best, and of those that tie for what is left; from the top bit down."""
    sure = np.zeros(sums.shape[1:], np.uint64)
    open_ = np.bitwise_or.reduce(sums, axis=0)  # scores above 0
    for b in range(len(sums) - 1, -1, -1):
        on = open_ & sums[b]
        fit = (np.bitwise_count(sure | on).sum(1) <= k)[:, None]
        # all with the bit are in if they fit, and those without it stay open; else only those with it do
        sure = np.where(fit, sure | on, sure)
        open_ = np.where(fit, open_ & ~sums[b], on)
    return sure, open_


def _places(bitmap: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))


def _found(row: dict, queries: list[tuple[int, np.ndarray]], weights: np.ndarray, n_docs: int, n_terms: int, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(query, documents, scores) of a block: the k best of each query, ties by the documents' order."""
    held, many = np.asarray(row["terms"], np.int64), np.asarray(row["dfs"], np.int64)
    doc, tf, lengths = np.asarray(row["docs"], np.int64), np.asarray(row["tfs"], np.int64), np.asarray(row["lengths"], np.int64)
    term = np.repeat(held, many)
    impact = impacts(tf, lengths[doc], weights[term], n_docs, n_terms)
    ends = np.cumsum(many)
    place = {int(t): i for i, t in enumerate(held)}
    words = -(-len(lengths) // 64)
    own = [(q, [place[t] for t in ts.tolist() if t in place]) for q, ts in queries]
    own = [x for x in own if x[1]]
    while own:
        used, chunk = set(), []
        while own and (not chunk or len(used | set(own[-1][1])) <= TERMS):
            used |= set(own[-1][1])
            chunk.append(own.pop())
        used = np.array(sorted(used))
        at = np.concatenate([np.arange(ends[i] - many[i], ends[i]) for i in used])
        maps = slices(np.repeat(np.arange(len(used)), many[used]), doc[at], impact[at], len(used), words)
        chosen = np.full((len(chunk), max(len(x[1]) for x in chunk)), len(used))
        for i, (_, ts) in enumerate(chunk):
            chosen[i, : len(ts)] = np.searchsorted(used, ts)
        sums = summed(maps, chosen)
        sure, ties = best(sums, k)
        for i, (q, _) in enumerate(chunk):
            first = _places(sure[i])
            got = np.concatenate([first, _places(ties[i])[: k - len(first)]])
            bits = sums[:, i, got >> 6] >> (got & 63).astype(np.uint64) & np.uint64(1)
            score = (bits.astype(np.int64) << np.arange(len(sums))[:, None]).sum(0)
            yield q, got, score


def _rounds(items: DataFrame, most: int) -> list[DataFrame]:
    """The items in as many parts as keep each under so many bytes."""
    size = items.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    n = -(-size // most)
    key = F.pmod(F.xxhash64("turn"), F.lit(max(n, 1)))
    while n > 1 and items.groupBy(key.alias("r")).agg(F.sum(F.octet_length("text") + 64).alias("s"), F.count("*").alias("c")).where((F.col("s") > most) & (F.col("c") > 1)).head(1):
        n *= 2
        key = F.pmod(F.xxhash64("turn"), F.lit(n))
    return [items.where(key == r) for r in range(n)]


def ranked(docs: DataFrame, items: DataFrame, k: int = 50, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", most: int = ROUND) -> DataFrame:
    """item_id, rank, doc_id, score: the k documents with the highest scores above 0 for each item.

    Terms, weights and impacts are the module's; an item's repeated terms count
    once. Equal scores rank by rising doc_id, null last. A null text, of either
    side, has no term: such documents are never found and such items find
    nothing. Each row of items is a query of its own, repeated and null ids too,
    and each row of docs a document. An empty table on either side gives no
    rows. Other columns aren't read. Items are taken in rounds of `most` bytes,
    so what goes to all tasks is bounded.
    """
    spark = docs.sparkSession
    kinds = docs.schema[id_col].dataType.simpleString(), items.schema[item_col].dataType.simpleString()
    out = []
    scratch = Scratch(spark)
    asked = scratch.settled(items.select(F.col(item_col).alias("item"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), F.monotonically_increasing_id().alias("turn")))
    for part in _rounds(asked, most):
        rows = part.orderBy("turn").collect()
        own = [sorted(set(terms(r["text"].encode()))) for r in rows]
        numbers = {t: i for i, t in enumerate(sorted({t for ts in own for t in ts}))}
        queries = [(i, np.array([numbers[t] for t in ts], np.int64)) for i, ts in enumerate(own)]
        names = pa.array([r["turn"] for r in rows], pa.int64())
        held = scratch.settled(postings(docs, numbers, id_col, text_col))
        each = held.select(F.expr("size(filter(lengths, x -> x > 0))").alias("n"), F.expr("aggregate(lengths, 0L, (a, x) -> a + x)").alias("l"))
        n_docs, n_terms = (x or 0 for x in each.agg(F.sum("n"), F.sum("l")).first())
        if not n_terms:
            continue
        df = np.zeros(len(numbers), np.int64)
        for r in held.select(F.explode(F.arrays_zip("terms", "dfs")).alias("x")).groupBy("x.terms").agg(F.sum("x.dfs").alias("df")).collect():
            df[r["terms"]] = r["df"]
        weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(x) + 1))) for x in df], np.int64)

        def run(batches, queries=queries, weights=weights, names=names, n_docs=n_docs, n_terms=n_terms):
            for batch in batches:
                for i in range(batch.num_rows):
                    row = {x: batch.column(x)[i].values.to_numpy(zero_copy_only=False) for x in ("lengths", "terms", "dfs", "docs", "tfs")}
                    found = list(_found(row, queries, weights, n_docs, n_terms, k))
                    if found:
                        at = pa.array(np.concatenate([x[1] for x in found]))
                        of = np.repeat([x[0] for x in found], [len(x[1]) for x in found])
                        score = pa.array(np.concatenate([x[2] for x in found]), pa.int64())
                        yield pa.RecordBatch.from_arrays([names.take(pa.array(of)), batch.column("ids")[i].values.take(at), score], ["turn", "doc_id", "score"])
                    found = None
                    release()

        out.append(scratch.settled(held.mapInArrow(run, f"turn long, doc_id {kinds[0]}, score long")))
        scratch.drop(held)
    if not out:
        return spark.createDataFrame([], f"item_id {kinds[1]}, rank int, doc_id {kinds[0]}, score long")
    every = out[0]
    for x in out[1:]:
        every = every.union(x)
    rank = F.row_number().over(Window.partitionBy("turn").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    top = every.withColumn("rank", rank).where(F.col("rank") <= k)
    return top.join(asked.select("turn", "item"), "turn").select(F.col("item").alias("item_id"), "rank", "doc_id", "score")


def oracle() -> str:
    """DuckDB SQL for the 50 best documents of each benchmark item."""
    split = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
    return f"""
WITH d AS (SELECT doc_id, {split} AS own FROM documents),
c AS (SELECT count(*) AS n_docs, sum(len(own))::BIGINT AS n_terms FROM d WHERE len(own) > 0),
q AS (SELECT DISTINCT item_id, unnest({split}) AS term FROM benchmark),
p AS (SELECT doc_id, len(own)::BIGINT AS n, unnest(own) AS term FROM d),
f AS (SELECT doc_id, n, term, count(*)::BIGINT AS tf FROM p SEMI JOIN q USING (term) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w FROM (SELECT term, count(*) AS df FROM f GROUP BY term), c),
s AS (
  SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // n_terms))))::BIGINT AS score
  FROM q JOIN f USING (term) JOIN w USING (term), c GROUP BY ALL
),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS k FROM s WHERE score > 0)
SELECT item_id, k::INT AS rank, doc_id, score FROM r WHERE k <= 50
"""
