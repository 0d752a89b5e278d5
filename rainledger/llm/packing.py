"""Packing of token streams by cutting-stock column generation.

Documents are cut into whole sequences, at most a half one, one piece on a
length grid and a tail shorter than the grid step, so a histogram of a few hundred lengths describes
the corpus, whatever its size. A linear program over packing patterns of that
histogram is solved by column generation: its dual prices go into a knapsack
dynamic programme, which finds the pattern to add. Rounded-down patterns are
laid out as ranges of piece ranks; each piece finds its sequence and offset
from its rank alone, so no pieces are gathered anywhere.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rainledger.llm.frames import release, settled
from rainledger.llm.tokens import Cache, splitter

_caches: dict[str, Cache] = {}


def id_bytes(text: str, path: str) -> bytes:
    """The ids of a text as little-endian unsigned 32-bit integers."""
    of = splitter(path)
    if path not in _caches:
        _caches[path] = Cache(lambda piece: array("I", of.ids(piece)).tobytes(), {})
    get = _caches[path].__getitem__
    plain, special = of.plain(text)
    parts = []
    for k, stretch in enumerate(plain):
        if stretch:
            parts.extend(map(get, of.pieces(stretch)))
        if k < len(special):
            parts.append(of.special[special[k]].to_bytes(4, "little"))
    return b"".join(parts)


def forget() -> None:
    """Drops the tokenizer and what it cached, which a reused worker would keep through whatever its executor does next."""
    _caches.clear()
    splitter.cache_clear()
    release()


def cuts(n: int, capacity: int, grid: int) -> list[int]:
    """Lengths of the pieces of a document of n tokens, in order: whole sequences, half a sequence if the rest is longer, the rest on the grid, a tail.

    No shared piece is longer than half a sequence, so there's always a partner for it and the programme's optimum is near the material bound.
    """
    full, rest = divmod(n, capacity)
    half, rest = divmod(rest, capacity // 2)
    tail = rest % grid
    return [capacity] * full + [x for x in (half * (capacity // 2), rest - tail, tail) if x]


def knapsack(lengths: np.ndarray, prices: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The pattern of the highest total price that fits, any number of each length."""
    best = np.zeros((len(lengths) + 1, capacity + 1))
    for i, (size, price) in enumerate(zip(lengths, prices, strict=True)):
        if price <= 0:
            best[i + 1] = best[i]
            continue
        rows = -(-(capacity + 1) // size)
        grid = np.full(rows * size, -np.inf)
        grid[: capacity + 1] = best[i]
        steps = np.arange(rows)[:, None] * price
        best[i + 1] = (np.maximum.accumulate(grid.reshape(rows, size) - steps, axis=0) + steps).reshape(-1)[: capacity + 1]
    pattern, room = np.zeros(len(lengths), np.int64), capacity
    for i in range(len(lengths), 0, -1):
        while room >= lengths[i - 1] and best[i, room] > best[i - 1, room] + 1e-12:
            pattern[i - 1] += 1
            room -= lengths[i - 1]
    return float(prices @ pattern), pattern


def first_basis(lengths: np.ndarray, demand: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """One pattern for each length, longest lengths first, each used until it exhausts its length: a triangular basis."""
    m = len(lengths)
    left, live = demand.copy(), np.ones(m, bool)
    columns, used = np.zeros((m, m), np.int64), np.zeros(m)
    for _ in range(m):
        room, pattern, turns = capacity, np.zeros(m, np.int64), None
        for i in np.flatnonzero(live):
            n = int(room // lengths[i])
            if n and turns is not None:
                n = min(n, max(1, int(left[i] // turns)))
            elif n:
                turns = max(left[i] / n, 1e-9)
            pattern[i] = n
            room -= n * int(lengths[i])
            if not room:
                break
        inside = np.flatnonzero(pattern)
        times = left[inside] / pattern[inside]
        out = int(inside[np.argmin(times)])
        columns[out], used[out] = pattern, times.min()
        left -= times.min() * pattern
        left[out], live[out] = 0, False
    return columns, used


def column_generation(lengths: np.ndarray, demand: np.ndarray, capacity: int, gap: float = 5e-4, most: int = 1500) -> tuple[np.ndarray, np.ndarray]:
    """Patterns (rows) and how often each is used, of the linear relaxation, by the revised simplex method.

    The knapsack prices columns at a mean of the dual prices and the best dual
    point so far, which keeps the prices steady. Ends when the dual bound is
    within gap of the value, when no column improves it, or after `most`
    columns; any state is a valid plan.
    """
    center = lengths / capacity
    bound = center @ demand
    columns, used = first_basis(lengths, demand, capacity)
    inverse = np.linalg.inv(columns.T.astype(float))
    for turn in range(1, most + 1):
        prices, weight = inverse.sum(axis=0), 0.8
        while True:
            mixed = weight * center + (1 - weight) * prices
            value, pattern = knapsack(lengths, mixed, capacity)
            if mixed @ demand / max(value, 1) > bound:
                center = mixed / max(value, 1)
                bound = center @ demand
            if prices @ pattern > 1 + 1e-9 or not weight:
                break
            weight = weight / 2 if weight > 0.05 else 0
        if prices @ pattern <= 1 + 1e-9 or used.sum() - bound <= gap * bound:
            break
        step = inverse @ pattern
        ratio = np.where(step > 1e-9, used / np.where(step > 1e-9, step, 1), np.inf)
        out = int(np.argmin(ratio))
        used = np.maximum(used - ratio[out] * step, 0)
        used[out] = ratio[out]
        inverse[out] /= step[out]
        step[out] = 0
        inverse -= np.outer(step, inverse[out])
        columns[out] = pattern
        if turn % 200 == 0:
            inverse = np.linalg.inv(columns.T.astype(float))
            used = np.maximum(inverse @ demand, 0)
    return columns, used


def layout(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, first sequence, pieces of that length in a sequence, offset of the first) of each pattern's part.

    Covers each rank of each length once. The patterns' whole-number parts come
    first; what they leave goes into patterns used once, longest pieces first.
    """
    plan, rank, sequence = [], dict.fromkeys(histogram, 0), 0

    def lay(pattern: list[tuple[int, int]], times: int) -> None:
        nonlocal sequence
        offset = 0
        for length, n in pattern:
            plan.append((length, rank[length], sequence, n, offset))
            rank[length] += n * times
            offset += n * length
        sequence += times

    if histogram.get(capacity):
        lay([(capacity, 1)], histogram[capacity])
    lengths = np.array(sorted((x for x, n in histogram.items() if n and x < capacity), reverse=True), np.int64)
    if not len(lengths):
        return plan
    left = np.array([histogram[x] for x in lengths.tolist()], np.int64)
    columns, used = column_generation(lengths, left.astype(float), capacity)
    for pattern, times in zip(columns, np.floor(used + 1e-7).astype(np.int64), strict=True):
        times = int(min([times, *(left[pattern > 0] // pattern[pattern > 0])]))
        if times:
            lay([(int(lengths[i]), int(pattern[i])) for i in np.flatnonzero(pattern)], times)
            left -= times * pattern
    while left.any():
        room, pattern = capacity, []
        for i in np.flatnonzero(left):
            if n := int(min(left[i], room // lengths[i])):
                pattern.append((int(lengths[i]), n))
                room -= n * int(lengths[i])
                left[i] -= n
        lay(pattern, 1)
    return plan


def pack(docs: DataFrame, path: str, capacity: int = 2048, grid: int = 8, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of the documents of docs, packed into sequences of at most capacity tokens.

    A document is its whole text's ids and end_id; a null text counts as
    empty, so it's end_id alone. One row a piece: doc_id, start, length,
    ids_crc32 (of the ids as little-endian unsigned 32-bit integers),
    doc_tokens, sequence_id, offset; offsets in a sequence run from 0 without
    gaps. A repeated row or id is a document of its own, null ids are kept,
    and an empty table gives no pieces. Other columns aren't read. Ties between pieces of a length fall by
    partition and place in it.
    """
    end = int(end_id).to_bytes(4, "little")
    kind = docs.schema[id_col].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, ranks = TaskContext.get().partitionId(), [0] * (capacity + 1)
        for whole in batches:
            for k in range(0, whole.num_rows, 1024):
                batch, rows = whole.slice(k, 1024), []
                for i, text in enumerate(batch.column("text").to_pylist()):
                    ids = id_bytes(text or "", path) + end
                    start = 0
                    for length in cuts(len(ids) // 4, capacity, grid):
                        rows.append((i, start, length, zlib.crc32(ids[4 * start : 4 * (start + length)]), len(ids) // 4, part, ranks[length]))
                        ranks[length] += 1
                        start += length
                at, *rest = zip(*rows, strict=True)
                arrays = [batch.column("id").take(pa.array(at, pa.int64()))]
                arrays += [pa.array(x, pa.int64()) for x in rest]
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "part", "place"])
                rows = at = rest = arrays = None
            release()
        forget()

    pieces = settled(
        docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(cut, f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, part long, place long")
    )
    counts = pieces.groupBy("part", "length").agg((F.max("place") + 1).alias("n"))
    before = F.sum("n").over(W.partitionBy("length").orderBy("part").rowsBetween(W.unboundedPreceding, -1))
    firsts = counts.select("part", "length", F.coalesce(before, F.lit(0)).alias("first"))
    # One row a length: capacity rows at most.
    histogram = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = np.array(sorted(layout(histogram, capacity)) or [(0, 0, 0, 1, 0)], np.int64)
    keys = (plan[:, 0] << 44) + plan[:, 1]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            _, low, sequence, each, offset = plan[np.searchsorted(keys, (length << 44) + rank, "right") - 1].T
            turn = rank - low
            arrays = [*batch.columns[:5], pa.array(sequence + turn // each), pa.array(offset + turn % each * length)]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

    ranked = pieces.join(firsts, ["part", "length"]).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("first") + F.col("place")).alias("rank"))
    return ranked.mapInArrow(place, f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
