"""Removal of long repeated strings with suffix arrays.

Each window of `length` bytes is keyed by the smallest hash of the short grams
in it, so equal windows have equal keys, wherever they stand. Runs of windows
with one key are segments. Segments whose key occurs once are no one's copy,
unless they hold their own key twice. Segments whose key comes again and again
with one content (equal in key and in a hash of all their bytes, 128 bits
together) are copies throughout. What is left, one of each content, is dealt by key into shards; each shard is sorted
into a suffix array (Larsson-Sadakane refinement), Kasai's common prefixes tell
which windows it holds twice, and where a key has too many contents for one
shard, its shards' windows are merged by binary search over ranges of their
fingerprints (128 bits). Text is removed from the input's own bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rainledger.llm.frames import Scratch, per_batch, release

#: Bytes of a gram, enough that different texts of common words seldom share one; windows in a segment at most; bytes that are hashed at a time; bytes from which a suffix array takes no further group.
GRAM, MOST, BLOCK, SHARD = 32, 256, 1 << 17, 1 << 16
#: Contents of one key in a shard at most.
CONTENTS = 1024

_dice = np.random.default_rng(20)
_bytes_on = np.array([1 << k for k in range(8, 64, 8)], np.uint64)
_bytes = [_dice.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1) for _ in range(2)]
_base = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)]
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def powers(n: int, which: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of a base modulo 2**64 and of its inverse, n of them at least."""
    if which not in _powers or len(_powers[which][0]) < n:
        size = max(n, BLOCK + 4096)
        base = _base[which]
        inverse = np.uint64(pow(int(base), -1, 1 << 64))
        up, down = np.full(size, base), np.full(size, inverse)
        up[0] = down[0] = 1
        _powers[which] = np.multiply.accumulate(up), np.multiply.accumulate(down)
    return _powers[which]


class Hashes:
    """Hashes of any stretch of some bytes, from prefix sums."""

    def __init__(self, data: np.ndarray, which: int = 0):
        up, self.down = powers(len(data) + 1, which)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_bytes[which][data] * up[: len(data)], out=self.sums[1:])

    def of(self, start, end) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[start]) * self.down[start])

    def rolling(self, n: int) -> np.ndarray:
        total = len(self.sums) - n
        return mixed((self.sums[n:] - self.sums[:-n]) * self.down[:total])


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    step = 1
    while step * 2 <= width:
        x = np.minimum(x[:-step], x[step:])
        step *= 2
    return np.minimum(x[: len(x) - (width - step)], x[width - step :]) if width > step else x


def segments(texts: list[bytes], length: int) -> tuple[np.ndarray, ...]:
    """(text number, start, windows, key, content hash, whether the key stands in it twice) of each segment of the texts; texts shorter than length have none."""
    owner, parts, first = [], [], []
    for i, text in enumerate(texts):
        for at in range(0, max(len(text) - length + 1, 0), BLOCK):
            owner.append(i)
            first.append(at)
            parts.append(text[at : at + BLOCK + length - 1])
    out: list[tuple[np.ndarray, ...]] = []
    k = 0
    while k < len(parts):
        size, j = 0, k
        while j < len(parts) and (j == k or size + len(parts[j]) <= BLOCK):
            size += len(parts[j])
            j += 1
        sizes = np.array([len(x) for x in parts[k:j]])
        ends = np.cumsum(sizes)
        data = np.frombuffer(b"".join(parts[k:j]), np.uint8)
        hashes = Hashes(data)
        grams = hashes.rolling(GRAM)
        key = sliding_min(grams, length - GRAM + 1)
        part = np.repeat(np.arange(j - k), sizes)[: len(key)]
        inside = np.arange(len(key)) + length <= ends[part]
        turn = np.empty(len(key), bool)
        turn[0] = True
        turn[1:] = (key[1:] != key[:-1]) | (part[1:] != part[:-1]) | (inside[1:] != inside[:-1])
        starts = np.flatnonzero(turn)
        runs = np.diff(np.append(starts, len(key)))
        runs, starts = runs[inside[starts]], starts[inside[starts]]
        split = -(-runs // MOST)
        nth = np.arange(split.sum()) - np.repeat(np.cumsum(split) - split, split)
        starts = np.repeat(starts, split) + nth * MOST
        windows = np.minimum(np.repeat(runs, split) - nth * MOST, MOST)
        content = hashes.of(starts, starts + windows + length - 1) ^ windows.astype(np.uint64)
        whose = part[starts]
        twice = holds_twice(grams, key, starts, windows, length)
        out.append((np.array(owner[k:j])[whose], np.array(first[k:j])[whose] + starts - (ends - sizes)[whose], windows, key[starts], content, twice))
        k = j
    if not out:
        return (*(np.zeros(0, np.int64),) * 5, np.zeros(0, bool))
    return tuple(np.concatenate(x) for x in zip(*out))


def holds_twice(grams: np.ndarray, key: np.ndarray, starts: np.ndarray, windows: np.ndarray, length: int) -> np.ndarray:
    """Whether a segment's key is the hash of two of its grams; only then can it hold a window twice."""
    width = length - GRAM + 1
    padded = np.concatenate([np.zeros(width - 1, np.uint64), key, np.zeros(width - 1, np.uint64)])
    at = np.flatnonzero(grams == ~sliding_min(~padded, width))  # the grams that are the smallest of a window
    low, high = np.searchsorted(at, starts), np.searchsorted(at, starts + windows + length - GRAM)
    inside = np.arange((high - low).sum()) - np.repeat(np.cumsum(high - low) - high, high - low)
    same = grams[at[inside]] == np.repeat(key[starts], high - low)
    return np.bincount(np.repeat(np.arange(len(starts)), high - low), weights=same, minlength=len(starts)) > 1


def suffix_array(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The suffix array of some bytes, its inverse, and the first eight bytes at each place, by Larsson-Sadakane refinement: each round sorts only groups that aren't settled, by the ranks that stand twice as far on."""
    n = len(data)
    wide = np.zeros(n + 8, np.uint64)
    wide[:n] = data
    words = np.zeros(n, np.uint64)
    for k in range(8):
        words |= wide[k : n + k] << np.uint64(56 - 8 * k)
    # The first round's letters are numbers of the bytes that occur, 0 beyond the end; as many as fit beside a place.
    room, found = n.bit_length(), np.bincount(data, minlength=256) > 0
    bits = int(found.sum()).bit_length()
    depth = (63 - room) // bits
    wide = np.zeros(n + depth, np.int64)
    wide[:n] = np.cumsum(found)[data]
    first = np.zeros(n, np.int64)
    for k in range(depth):
        first = first << bits | wide[k : n + k]
    run = np.sort(first << room | np.arange(n))
    order, first = run & (1 << room) - 1, run >> room
    fresh = np.ones(n, bool)
    fresh[1:] = first[1:] != first[:-1]
    rank = np.empty(n + 1, np.int64)
    rank[order], rank[n] = np.maximum.accumulate(np.where(fresh, np.arange(n), 0)), -1
    at = np.flatnonzero(~(fresh & np.append(fresh[1:], True)))
    while len(at):
        here = order[at]
        here, fresh = refined(rank[here], rank[here + depth] + 1, here, room)
        order[at] = here
        rank[here] = at[np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))]
        at = at[~(fresh & np.append(fresh[1:], True))]
        depth *= 2
    return order, rank[:n], words


def refined(group: np.ndarray, further: np.ndarray, here: np.ndarray, room: int) -> tuple[np.ndarray, np.ndarray]:
    """Places sorted by group and by what stands further on, and which of them differ from the one before; numbers of `room` bits, of which three mostly fit one word."""
    if 3 * room <= 63:
        run = np.sort((group << room | further) << room | here)
        here, key = run & (1 << room) - 1, run >> room
    else:
        key = group << 32 | further
        pick = np.argsort(key, kind="stable")
        here, key = here[pick], key[pick]
    fresh = np.ones(len(here), bool)
    fresh[1:] = key[1:] != key[:-1]
    return here, fresh


def common_prefixes(order: np.ndarray, rank: np.ndarray, words: np.ndarray, starts: np.ndarray, sizes: np.ndarray, cap: int) -> np.ndarray:
    """Kasai's common prefixes of neighbours in the suffix array, up to cap.

    Where the byte before a place is also the one before its neighbour, the
    prefix is that of the place before, less one; so only the other places, and
    the start of each stretch, are compared. A stretch bounds what these need
    beyond cap.
    """
    n = len(order)
    before = np.full(n, -1)
    before[order[1:]] = order[:-1]
    byte = words >> np.uint64(56)
    turn = before < 1
    turn[1:] |= byte[:-1] != byte[before[1:] - 1]
    turn[starts] = True
    here = np.flatnonzero(turn)
    other, most = before[here], cap + int(sizes.max(initial=0))
    wide = np.concatenate([words, np.zeros(most + 16, np.uint64)])
    held = np.zeros(len(here), np.int64)
    going = np.flatnonzero(other >= 0)
    while len(going):
        difference = wide[here[going] + held[going]] ^ wide[other[going] + held[going]]
        same = difference == 0
        held[going[same]] += 8
        held[going[~same]] += 7 - np.searchsorted(_bytes_on, difference[~same], "right")
        going = going[same]
        going = going[held[going] < most]
    held = np.minimum(held, np.where(other >= 0, n - np.maximum(here, other), 0))
    runs = np.diff(np.append(here, n))
    out = np.empty(n, np.int64)
    out[rank] = np.minimum(np.repeat(held + here, runs) - np.arange(n), cap)
    return out


def repeated_windows(texts: list[bytes], length: int, twice: np.ndarray, fingerprints: bool) -> tuple[list[np.ndarray], list[tuple[np.ndarray, np.ndarray]] | None]:
    """For each text, which of its windows the texts hold more than once (all of them where twice says so).

    With fingerprints, also two hashes of each window that is the first of its kind here; of the others, zeros.
    """
    data = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.array([len(x) for x in texts])
    starts = np.cumsum(sizes) - sizes
    order, rank, words = suffix_array(data)
    common = common_prefixes(order, rank, words, starts, sizes, length)
    kind = np.cumsum(common < length)  # neighbours that share a window are of one kind
    whole = np.zeros(len(data), bool)
    for a, n in zip(starts, sizes):
        whole[a : a + n - length + 1] = True
    inside = whole[order]
    many = np.bincount(kind[inside], minlength=kind[-1] + 1)
    again = np.zeros(len(data), bool)
    again[order] = inside & (many[kind] > 1)
    marks = [again[a : a + n - length + 1] | bool(t) for a, n, t in zip(starts, sizes, twice)]
    if not fingerprints:
        return marks, None
    firsts = np.zeros(len(data), bool)
    held = order[inside]
    firsts[held[np.unique(kind[inside], return_index=True)[1]]] = True
    prints = [Hashes(data, which).rolling(length) for which in range(2)]
    return marks, [tuple(np.where(firsts[a : a + n - length + 1], p[a : a + n - length + 1], 0) for p in prints) for a, n in zip(starts, sizes)]


def _longs(x: np.ndarray) -> pa.Array:
    return pa.array(x.astype(np.uint64).view(np.int64) if x.dtype == np.uint64 else x.astype(np.int64))


def shard_marks(shipped: DataFrame, length: int) -> DataFrame:
    """(h, s, marks, salts, f1, f2) of each content: a suffix array for each shard of whole (h, salt) groups."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size, last = 0, None
        out: list[tuple] = []

        def solve() -> None:
            wide = any(r[4] > 1 for r in held)
            marks, prints = repeated_windows([r[5] for r in held], length, np.array([r[2] > 1 for r in held]), wide)
            for k, (r, m) in enumerate(zip(held, marks)):
                f1, f2 = (x.view(np.int64) for x in prints[k]) if r[4] > 1 else (None, None)
                out.append((r[0], r[3], np.packbits(m).tobytes(), r[4], f1, f2))
            held.clear()

        def settled() -> pa.RecordBatch:
            kinds = (pa.int64(), pa.int64(), pa.binary(), pa.int64(), *[pa.list_(pa.int64())] * 2)
            made = pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True) if out else [[]] * 6, kinds)], ["h", "s", "marks", "salts", "f1", "f2"])
            out.clear()
            release()
            return made

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("h", "salt", "n", "s", "salts", "piece")), strict=True):
                if size >= SHARD and row[:2] != last:
                    solve()
                    size = 0
                if held and (held[-1][0], held[-1][3]) == (row[0], row[3]):
                    continue  # a repeated row's segment again
                held.append(row)
                last = row[:2]
                size += len(row[5])
            yield settled()
        if held:
            solve()
        yield settled()

    dealt = shipped.repartition("h", "salt").sortWithinPartitions("h", "salt", "s")
    return dealt.mapInArrow(run, "h long, s long, marks binary, salts long, f1 array<long>, f2 array<long>")


def merged(shards: DataFrame, most: int = 1_000_000) -> DataFrame:
    """(h, s, places): windows that another shard of the same key holds too. Each range of fingerprints is sorted, and binary search counts a fingerprint in it."""
    wide = shards.where("salts > 1").select("h", "s", "f1", "f2")
    ranges = (wide.select(F.sum(F.size("f1"))).first()[0] or 0) // most + 1
    lists = "array<long>"

    def deal(batch: pa.RecordBatch) -> pa.RecordBatch:
        out: list[tuple] = []
        for h, s, f1, f2 in zip(*(batch.column(c).to_pylist() for c in ("h", "s", "f1", "f2"))):
            a, b = np.array(f1, np.int64), np.array(f2, np.int64)
            which = np.where((a != 0) | (b != 0), a % ranges, -1)
            order = np.argsort(which, kind="stable")
            for part in np.split(order, np.flatnonzero(np.diff(which[order])) + 1):
                if len(part) and which[part[0]] >= 0:
                    out.append((int(which[part[0]]), h, s, part, a[part], b[part]))
        kinds = (pa.int64(),) * 3 + (pa.list_(pa.int64()),) * 3
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True) if out else [[]] * 6, kinds)], ["range", "h", "s", "place", "f1", "f2"])

    def search(table: pa.Table) -> pa.Table:
        flat = [np.asarray(table.column(c).combine_chunks().flatten()) for c in ("place", "f1", "f2")]
        key = np.empty(len(flat[0]), [("a", np.int64), ("b", np.int64)])
        key["a"], key["b"] = flat[1], flat[2]
        run = np.sort(key)
        many = np.searchsorted(run, key, "right") - np.searchsorted(run, key, "left") > 1
        cuts = np.cumsum([len(x) for x in table.column("place").to_pylist()])[:-1]
        found = [p[m] for p, m in zip(np.split(flat[0], cuts), np.split(many, cuts))]
        return pa.table([table.column("h"), table.column("s"), pa.array(found, pa.list_(pa.int64()))], ["h", "s", "places"])

    dealt = per_batch(wide, deal, f"range long, h long, s long, place {lists}, f1 {lists}, f2 {lists}")
    found = dealt.groupBy("range").applyInArrow(search, f"h long, s long, places {lists}").where(F.size("places") > 0)
    return found.groupBy("h", "s").agg(F.array_distinct(F.flatten(F.collect_list("places"))).alias("places"))


def removed(starts: np.ndarray, size: int, marks: pa.ListArray, length: int) -> np.ndarray:
    """Which of so many bytes the marked windows of the texts at these starts cover; marks of a text: (place, bits of its windows or null for all), or null."""
    place, bits = marks.flatten().flatten()
    places = place.to_numpy(zero_copy_only=False)
    at = np.repeat(starts, marks.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)) + (places >> 9)
    whole = bits.is_null().to_numpy(zero_copy_only=False)
    turns = np.zeros(size + 1, np.int32)
    np.add.at(turns, at[whole], 1)
    np.add.at(turns, (at + (places & 511) + length)[whole], -1)
    some = bits.drop_null().to_pylist()
    ends = np.cumsum([8 * len(x) for x in some], dtype=np.int64)
    on = np.flatnonzero(np.unpackbits(np.frombuffer(b"".join(some), np.uint8)))
    which = np.searchsorted(ends, on, "right")
    first = (at[~whole] - np.append(0, ends[:-1]) if some else at[:0])[which] + on
    np.add.at(turns, first, 1)
    np.add.at(turns, first + length, -1)
    return np.cumsum(turns[:-1]) > 0


def without_marked(texts: list[bytes], marks: pa.ListArray, length: int) -> tuple[pa.Array, pa.Array, list[bytes]]:
    """(bytes removed, spans, what is left) of each text, worked out for all of them together; a byte between them keeps spans apart."""
    sizes = np.array([len(x) for x in texts])
    ends = np.cumsum(sizes + 1)
    starts = ends - sizes - 1
    data = np.frombuffer(b"\0".join([*texts, b""]), np.uint8)
    gone = removed(starts, len(data), marks, length)
    edges = np.flatnonzero(np.diff(gone, prepend=False)).reshape(-1, 2)
    owner = np.searchsorted(ends, edges[:, 0], "right")
    cuts = np.append(0, np.cumsum(np.bincount(owner, minlength=len(texts))))
    spans = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.StructArray.from_arrays([pa.array(x - starts[owner]) for x in edges.T], ["start", "end"]))
    left = data[~gone].tobytes()
    lost = np.add.reduceat(gone, starts, dtype=np.int64)
    upto = np.cumsum(sizes + 1 - lost)
    return pa.array(lost), spans, [left[b - n : b - 1] for b, n in zip(upto.tolist(), (sizes + 1 - lost).tolist())]


def without_repeats(docs: DataFrame, length: int = 200, contents: int = CONTENTS, id_col: str = "doc_id", text_col: str = "text", as_text: bool = False) -> DataFrame:
    """Each row of docs without the bytes that strings of `length` bytes cover which also start elsewhere.

    doc_id, n_bytes, n_removed, spans (array of start and end, in bytes),
    kept (binary: the remaining bytes; with as_text instead text, without the
    parts of characters that cuts leave). Strings are judged on the input's UTF-8
    bytes, overlaps count, matches never cross rows. A null text counts as
    empty; a repeated row is a copy of the other, so both lose what is long
    enough; ids may be null; other columns aren't read; an empty table gives
    no rows. Very long texts are hashed in blocks.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text")).select("id", "text", F.xxhash64(F.coalesce(F.col("id").cast("string"), F.lit("null")), "text").alias("k1"), F.crc32("text").alias("k2"))

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        owner, start, windows, key, content, twice = segments(batch.column("text").to_pylist(), length)
        whose = pa.array(owner)
        return pa.RecordBatch.from_arrays([_longs(key), _longs(content), batch.column("k1").take(whose), batch.column("k2").take(whose), _longs((start << 9) + windows - 1), pa.array(twice)], ["h", "s", "k1", "k2", "place", "twice"])

    scratch = Scratch(docs.sparkSession)
    settled = scratch.settled
    found = settled(per_batch(rows.select("k1", "k2", "text"), cut, "h long, s long, k1 long, k2 long, place long, twice boolean"))
    several = settled(found.groupBy("h").agg(F.count("*").alias("n"), F.max("twice").alias("twice")).where("n > 1 or twice").select("h"))
    shared = settled(found.drop("twice").join(several, "h", "left_semi"))
    scratch.drop(found, several)
    pick = F.xxhash64("k1", "k2", "place")
    each = settled(shared.groupBy("h", "s").agg(F.count("*").alias("n"), F.min(pick).alias("pick")))
    kinds = settled(each.groupBy("h").agg(F.count("*").alias("kinds")))
    state = settled(each.join(kinds, "h"))
    scratch.drop(each, kinds)

    # One of each content of the keys that have several, or have one that occurs once, with its bytes.
    wanted = shared.join(state.where("kinds > 1 or n = 1"), ["h", "s"]).where(pick == F.col("pick"))
    wanted = wanted.groupBy("k1", "k2").agg(F.collect_set(F.struct("place", "h", "s", "n", "kinds")).alias("wanted"))

    def shrink(batch: pa.RecordBatch) -> pa.RecordBatch:
        squeeze = zstandard.ZstdCompressor(level=3, write_content_size=True).compress
        return pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("id", "k1", "k2")), pa.array([squeeze(x) for x in batch.column("text").to_pylist()], pa.binary())], ["id", "k1", "k2", "packed"])

    small = per_batch(rows, shrink, f"id {kind}, k1 long, k2 long, packed binary")

    def ship(batch: pa.RecordBatch) -> pa.RecordBatch:
        expand = zstandard.ZstdDecompressor().decompress
        out: list[tuple] = []
        for packed, want in zip(batch.column("packed").to_pylist(), batch.column("wanted").to_pylist()):
            text = expand(packed)
            for w in want:
                at = w["place"] >> 9
                out.append((w["h"], w["s"], w["n"], w["kinds"], text[at : at + (w["place"] & 511) + length]))
        kinds = (pa.int64(),) * 4 + (pa.binary(),)
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), kinds)], ["h", "s", "n", "kinds", "piece"])

    shipped = per_batch(small.drop("id").join(wanted.hint("shuffle_hash"), ["k1", "k2"]), ship, "h long, s long, n long, kinds long, piece binary")
    shipped = shipped.withColumn("salts", F.expr(f"(kinds - 1) div {contents} + 1")).withColumn("salt", F.pmod("s", "salts"))
    shards = settled(shard_marks(shipped, length))
    partly = shards.select("h", "s", "marks")
    if shards.where("salts > 1").limit(1).count():
        partly = per_batch(partly.join(merged(shards), ["h", "s"], "left").select("h", "s", "marks", "places"), _with_places, "h long, s long, marks binary")
    empty = F.regexp_replace(F.hex("marks"), "0", "") == ""
    marks = state.where("kinds = 1 and n > 1").select("h", "s", F.lit(None).cast("binary").alias("marks")).unionByName(partly.where(~empty))
    lists = settled(shared.join(marks, ["h", "s"]).groupBy("k1", "k2").agg(F.collect_set(F.struct("place", "marks")).alias("marks")))
    scratch.keep(lists)

    def finish(batch: pa.RecordBatch) -> pa.RecordBatch:
        expand = zstandard.ZstdDecompressor().decompress
        sizes, lost, spans, rest = [], [], [], []
        held, size = [], 0
        packed = batch.column("packed").to_pylist()
        for i, text in enumerate(map(expand, packed), 1):
            held.append(text)
            sizes.append(len(text))
            size += len(text)
            if size >= BLOCK or i == len(packed):
                n, span, kept = without_marked(held, batch.column("marks").slice(i - len(held), len(held)), length)
                lost.append(n)
                spans.append(span)
                rest += [x.decode(errors="ignore") for x in kept] if as_text else kept
                held, size = [], 0
        return pa.RecordBatch.from_arrays([batch.column("id"), pa.array(sizes, pa.int64()), pa.concat_arrays(lost), pa.concat_arrays(spans), pa.array(rest, pa.string() if as_text else pa.binary())], ["doc_id", "n_bytes", "n_removed", "spans", "text" if as_text else "kept"])

    return per_batch(small.join(lists.hint("shuffle_hash"), ["k1", "k2"], "left"), finish, f"doc_id {kind}, n_bytes long, n_removed long, spans array<struct<start:long,end:long>>, " + ("text string" if as_text else "kept binary"))


def _with_places(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Bits of marks with those of the places that other shards hold too."""
    marks = batch.column("marks").to_pylist()
    for i, places in enumerate(batch.column("places").to_pylist()):
        if places:
            bits = np.unpackbits(np.frombuffer(marks[i], np.uint8))
            bits[places] = 1
            marks[i] = np.packbits(bits).tobytes()
    return pa.RecordBatch.from_arrays([batch.column("h"), batch.column("s"), pa.array(marks, pa.binary())], ["h", "s", "marks"])
