"""Lossless WebP: a decoder of the whole VP8L bitstream, a writer, and media columns over texts.

The decoder takes prefix codes (simple, normal, meta), back-references, the
colour cache, and inverts the predictor, cross-colour, subtract-green and
palette transforms. Where an image has one group of codes, all literals of
eight bits and no cache, its samples are unpacked at once with numpy; streams of
one group are looked up at all their bits at once and then followed; other
streams are read symbol by symbol. The writer works on the images of many texts
at once. It counts its prefix codes, makes back-references or a colour cache
where pixels repeat, and a palette where there are few colours; images that this
makes no smaller (short or random ones) are flat streams of eight bits. It makes
no other transforms or meta codes: they don't make texts smaller, so only tests
put those parts of the decoder to use.
"""

from __future__ import annotations

import hashlib
import math
import struct
import zlib
from array import array
from collections.abc import Iterable, Iterator
from functools import cached_property, lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rainledger.llm.frames import per_batch, utf8

#: Fixed values of the format: the order in which code-length code lengths stand, the neighbours that short distance codes mean, the cache's multiplier.
LENGTH_ORDER = (17, 18, 0, 1, 2, 3, 4, 5, 16, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15)
NEIGHBOURS = (
    (0, 1), (1, 0), (1, 1), (-1, 1), (0, 2), (2, 0), (1, 2), (-1, 2), (2, 1), (-2, 1), (2, 2), (-2, 2), (0, 3), (3, 0), (1, 3), (-1, 3), (3, 1), (-3, 1), (2, 3), (-2, 3),
    (3, 2), (-3, 2), (0, 4), (4, 0), (1, 4), (-1, 4), (4, 1), (-4, 1), (3, 3), (-3, 3), (2, 4), (-2, 4), (4, 2), (-4, 2), (0, 5), (3, 4), (-3, 4), (4, 3), (-4, 3), (5, 0),
    (1, 5), (-1, 5), (5, 1), (-5, 1), (2, 5), (-2, 5), (5, 2), (-5, 2), (4, 4), (-4, 4), (3, 5), (-3, 5), (5, 3), (-5, 3), (0, 6), (6, 0), (1, 6), (-1, 6), (6, 1), (-6, 1),
    (2, 6), (-2, 6), (6, 2), (-6, 2), (4, 5), (-4, 5), (5, 4), (-5, 4), (3, 6), (-3, 6), (6, 3), (-6, 3), (0, 7), (7, 0), (1, 7), (-1, 7), (5, 5), (-5, 5), (7, 1), (-7, 1),
    (4, 6), (-4, 6), (6, 4), (-6, 4), (2, 7), (-2, 7), (7, 2), (-7, 2), (3, 7), (-3, 7), (7, 3), (-7, 3), (5, 6), (-5, 6), (6, 5), (-6, 5), (8, 0), (4, 7), (-4, 7), (7, 4),
    (-7, 4), (8, 1), (8, 2), (6, 6), (-6, 6), (8, 3), (5, 7), (-5, 7), (7, 5), (-7, 5), (8, 4), (6, 7), (-6, 7), (7, 6), (-7, 6), (8, 5), (7, 7), (-7, 7), (8, 6), (8, 7),
)
CACHE_MULTIPLIER = 0x1E35A7BD
SIGNATURE = 0x2F
PREDICTOR, CROSS_COLOUR, SUBTRACT_GREEN, PALETTE = range(4)

REVERSED = np.packbits(np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1)[:, ::-1], axis=1).ravel()


class Bits:
    """Reads little-endian bits; past the end, zeros, as long as it isn't by much."""

    def __init__(self, data: bytes):
        self.data, self.at = data + bytes(16), 0

    def peek(self, n: int) -> int:
        k = self.at >> 3
        return int.from_bytes(self.data[k : k + 6], "little") >> (self.at & 7) & ((1 << n) - 1)

    def slice(self, at: int, n: int) -> int:
        """n bits from a place, any number."""
        k = at >> 3
        return int.from_bytes(self.data[k : (at + n >> 3) + 1], "little") >> (at & 7) & ((1 << n) - 1)

    def read(self, n: int) -> int:
        value = self.peek(n)
        self.at += n
        if self.at > 8 * len(self.data):
            raise ValueError("the stream ends early")
        return value


class Code:
    """A canonical prefix code: table[next bits] = symbol << 4 | length."""

    def __init__(self, lengths: bytes):
        used = np.frombuffer(lengths, np.uint8)
        symbols = used.nonzero()[0]
        self.only = None
        if len(symbols) < 2:
            self.only = int(symbols[0]) if len(symbols) else 0
            self.bits, self.entries = 0, np.array([self.only << 4])
            return
        # In the order of the codes each symbol takes a stretch of the table; bits come lowest first, so places are then turned round.
        sizes = used[symbols]
        order = sizes.argsort(kind="stable")
        sizes, symbols = sizes[order].astype(np.int64), symbols[order]
        self.bits = int(sizes[-1])
        spans = (1 << self.bits) >> sizes
        if spans.sum() != 1 << self.bits:
            raise ValueError("not a complete prefix code")
        self.entries = (symbols << 4 | sizes).repeat(spans).take(backwards(self.bits))

    @property
    def flat8(self) -> bool:
        """Whether this is the code of the flat streams: 256 symbols of eight bits, which are the samples."""
        return self.bits == 8 and bool((self.octets == REVERSED).all()) and bool((self.sizes == 8).all())

    @cached_property
    def table(self) -> list[int]:
        return self.entries.tolist()

    @cached_property
    def sizes(self) -> np.ndarray:
        """How many of the next bits each entry takes."""
        return self.entries & 15

    @cached_property
    def octets(self) -> np.ndarray:
        """The symbols' lower eight bits: those of a sample."""
        return (self.entries >> 4).astype(np.uint8)

    @cached_property
    def jumps(self) -> np.ndarray:
        """The sizes; those of back-references lead beyond any stretch."""
        return np.where((self.entries >= 256 << 4) & (self.entries < 280 << 4), 1 << 40, self.sizes)

    def read(self, bits: Bits) -> int:
        if self.only is not None:
            return self.only
        entry = self.table[bits.peek(self.bits)]
        bits.at += entry & 15
        return entry >> 4


@lru_cache(maxsize=16)
def backwards(n: int) -> np.ndarray:
    """Numbers of n bits with their bits turned round."""
    out = np.zeros(1, np.int64)
    for _ in range(n):
        out = np.concatenate([out * 2, out * 2 + 1])
    return out


code_of = lru_cache(maxsize=256)(Code)


def read_code(bits: Bits, alphabet: int) -> Code:
    lengths = bytearray(alphabet)
    if bits.read(1):
        two, wide = bits.read(1), bits.read(1)
        lengths[bits.read(8 if wide else 1)] = 1
        if two:
            lengths[bits.read(8)] = 1
        return code_of(bytes(lengths))
    many = bits.read(4) + 4
    said, first = bits.slice(bits.at, 3 * many), bytearray(19)
    bits.at += 3 * many
    for k in range(many):
        first[LENGTH_ORDER[k]] = said >> 3 * k & 7
    code = code_of(bytes(first))
    left = 2 + bits.read(2 + 2 * bits.read(3)) if bits.read(1) else alphabet
    if left > alphabet:
        raise ValueError("more code lengths than symbols")
    if code.only is not None and code.only < 16:
        lengths[:left] = bytes([code.only]) * left
        return code_of(bytes(lengths))
    table, mask = code.table, (1 << code.bits) - 1
    window, pos, at, before = bits.slice(bits.at, 1024), 0, 0, 8
    while at < alphabet and left:
        if pos > 1000:
            bits.at += pos
            window, pos = bits.slice(bits.at, 1024), 0
        left -= 1
        entry = table[window >> pos & mask]
        symbol = entry >> 4
        pos += entry & 15 if mask else 0
        if symbol < 16:
            lengths[at] = symbol
            at += 1
            before = symbol or before
            continue
        base, more, value = ((3, 2, before), (3, 3, 0), (11, 7, 0))[symbol - 16]
        n = base + (window >> pos & ((1 << more) - 1))
        pos += more
        if at + n > alphabet:
            raise ValueError("a run of code lengths is too long")
        lengths[at : at + n] = bytes([value]) * n
        at += n
    bits.at += pos
    if bits.at > 8 * len(bits.data):
        raise ValueError("the stream ends early")
    return code_of(bytes(lengths))


def prefixed(symbol: int, bits: Bits) -> int:
    """The length or distance that a prefix symbol and its extra bits mean."""
    if symbol < 4:
        return symbol + 1
    extra = (symbol - 2) >> 1
    return ((2 + (symbol & 1)) << extra) + bits.read(extra) + 1


def distance(code: int, width: int) -> int:
    if code > len(NEIGHBOURS):
        return code - len(NEIGHBOURS)
    dx, dy = NEIGHBOURS[code - 1]
    return max(dx + dy * width, 1)


#: Bits of a stream that are looked up at a time, and the places there.
STRETCH = 1 << 15
STARTS = np.arange(STRETCH + 128)


def cache_place(pixels: np.ndarray, cache_bits: int) -> np.ndarray:
    """Where a colour cache of so many bits keeps pixels (ARGB in 32 bits)."""
    return (pixels.astype(np.uint32) * np.uint32(CACHE_MULTIPLIER)) >> np.uint32(32 - cache_bits)


def read_steps(bits: Bits, codes: list[Code], total: int, width: int, cache_bits: int = 0) -> np.ndarray | None:
    """Pixels of one group of codes; None if it has a cache and back-references both, which only reading in turn settles.

    For each bit of a stretch the table entries are looked up at once, and where
    a literal or a place of the cache that starts there ends; what is left to do
    in turn is to follow these ends, and back-references. Without
    back-references a place of the cache means the last literal that went there.
    """
    data, end = bits.data + bytes(24), 8 * len(bits.data)
    literals: list[np.ndarray] = []
    turned: list[np.ndarray] = []  # places of the cache; -1 for literals
    copies_: list[tuple[int, int, int]] = []  # literals before it, length, distance
    done = made = 0
    while made < total:
        first = bits.at >> 3
        many = min(STRETCH // 8 + 16, len(data) - first - 3)
        four = np.ndarray(many, "<u4", data, first, (1,)).astype(np.int64)
        window = np.empty((many, 8), np.int64)
        for k in range(8):
            np.right_shift(four, k, out=window[:, k])
        window = window.reshape(-1)
        starts, last = STARTS[: len(window)], len(window) - 1
        n = last - 4 * 15
        place = window[:n] & ((1 << codes[0].bits) - 1)
        after = codes[0].jumps.take(place)
        after += starts[:n]
        ends = after
        step: dict[int, np.ndarray] = {}  # where a sample that starts at a bit ends; from the last bit, where back-references lead, nowhere
        for code in codes[1:4]:
            if id(code) not in step:
                step[id(code)] = code.sizes.take(window & ((1 << code.bits) - 1))
                step[id(code)] += starts
                step[id(code)][last] = last
            ends = step[id(code)].take(ends, mode="clip")
        if cache_bits:
            ends = np.where(codes[0].entries.take(place) < 280 << 4, ends, after)
        follow, places = array("q", ends.tobytes()), array("q")
        put, at, room = places.append, bits.at - 8 * first, total - made
        while True:
            try:
                for _ in repeat(None, room - len(places)):
                    end_of = follow[at]  # beyond the stretch there is none
                    put(at)
                    at = end_of
            except IndexError:
                pass
            if at != last:
                break
            at = places.pop()
            if cache_bits:
                return None
            entry = int(codes[0].entries[int(place[at])])
            bits.at = 8 * first + at + (entry & 15)
            size = prefixed((entry >> 4) - 256, bits)
            back = distance(prefixed(codes[4].read(bits), bits), width)
            before = total - room + len(places)
            if back > before or before + size > total:
                raise ValueError("a back-reference leaves the image")
            copies_.append((done + len(places), size, back))
            room -= size
            at = bits.at - 8 * first
        bits.at = 8 * first + at
        if bits.at > end:
            raise ValueError("the stream ends early")
        p = np.frombuffer(places, np.int64)
        value = np.empty((len(p), 4), np.uint8)
        entry = codes[0].entries.take(place.take(p))
        value[:, 1] = entry >> 4
        if cache_bits:
            turned.append(np.where(entry >= 280 << 4, (entry >> 4) - 280, -1))
        p = p + (entry & 15)
        for code, k in zip(codes[1:4], (2, 0, 3)):
            value[:, k] = code.octets.take(window.take(p) & ((1 << code.bits) - 1))
            p = step[id(code)].take(p)
        literals.append(value.view("<u4")[:, 0])
        done += len(places)
        made = total - room + len(places)
    plain = literals[0] if len(literals) == 1 else np.concatenate(literals)
    if cache_bits:
        place = np.concatenate(turned)
        known, asked = np.flatnonzero(place < 0), np.flatnonzero(place >= 0)
        keys = np.sort(cache_place(plain[known], cache_bits).astype(np.int64) << 32 | known)
        at_ = np.searchsorted(keys, place[asked].astype(np.int64) << 32 | asked) - 1
        held = keys[np.maximum(at_, 0)] if len(keys) else np.zeros(len(asked), np.int64)
        there = (at_ >= 0) & (held >> 32 == place[asked])
        plain[asked] = np.where(there, plain[held & 0xFFFFFFFF], 0)
    if not copies_:
        return plain
    out = np.empty(total, np.uint32)
    taken = at = 0
    for before, size, back in copies_:
        out[at : at + before - taken] = plain[taken:before]
        at += before - taken
        taken = before
        if back == 1:
            out[at : at + size] = out[at - 1]
            at += size
            continue
        start, end = at - back, at + size
        while at < end:  # of an overlapping stretch, twice as much each time
            now = min(at - start, end - at)
            out[at : at + now] = out[start : start + now]
            at += now
    out[at:] = plain[taken:]
    return out


def read_group(bits: Bits, alphabet: int) -> list[Code]:
    """The five codes of a group; of red, blue and alpha one that is written like the one before isn't read again."""
    codes, start = [read_code(bits, alphabet)], 0
    for k in range(3):
        if k and bits.slice(bits.at, size) == said:
            bits.at += size
            codes.append(codes[-1])
            continue
        start = bits.at
        codes.append(read_code(bits, 256))
        size = bits.at - start
        said = bits.slice(start, size)
    return [*codes, read_code(bits, 40)]


def read_pixels(bits: Bits, width: int, height: int, main: bool) -> np.ndarray:
    """An entropy-coded image as (height, width) of ARGB in 32 bits."""
    cache_bits = bits.read(4) if bits.read(1) else 0
    if cache_bits > 11:
        raise ValueError("the colour cache is too large")
    groups, which, block = 1, None, 0
    if main and bits.read(1):
        block = bits.read(3) + 2
        entropy = read_pixels(bits, -(-width >> block), -(-height >> block), False)
        which = (entropy >> 8 & 0xFFFF).tolist()
        groups = int((entropy >> 8 & 0xFFFF).max()) + 1
    cached = 1 << cache_bits if cache_bits else 0
    codes = [read_group(bits, 256 + 24 + cached) for _ in range(groups)]
    total = width * height
    if groups == 1 and not cached and all(c.flat8 for c in codes[0][:4]):
        raw = np.frombuffer(bits.data, np.uint8, 4 * total + 1, bits.at >> 3)
        shift = bits.at & 7
        samples = (raw[:-1] >> shift | raw[1:] << (8 - shift)) if shift else raw[:-1]
        bits.at += 32 * total
        g, r, b, a = REVERSED[samples].reshape(total, 4).astype(np.uint32).T
        return (a << 24 | r << 16 | g << 8 | b).reshape(height, width)
    start = bits.at
    if groups == 1 and (made := read_steps(bits, codes[0], total, width, cache_bits)) is not None:
        return made.reshape(height, width)
    bits.at = start
    out, cache = [0] * total, [0] * cached
    at = noted = 0
    group = codes[0]
    while at < total:
        if which is not None:
            group = codes[which[at // width >> block][at % width >> block]]
        symbol = group[0].read(bits)
        if symbol < 256:
            r, b, a = group[1].read(bits), group[2].read(bits), group[3].read(bits)
            out[at] = a << 24 | r << 16 | symbol << 8 | b
            at += 1
        elif symbol < 280:
            n = prefixed(symbol - 256, bits)
            back = distance(prefixed(group[4].read(bits), bits), width)
            if back > at or at + n > total:
                raise ValueError("a back-reference leaves the image")
            for at in range(at, at + n):
                out[at] = out[at - back]
            at += 1
        else:
            while noted < at:
                cache[(CACHE_MULTIPLIER * out[noted] & 0xFFFFFFFF) >> (32 - cache_bits)] = out[noted]
                noted += 1
            out[at] = cache[symbol - 280]
            at += 1
        if bits.at > 8 * len(bits.data):
            raise ValueError("the stream ends early")
        while cached and noted < at:
            cache[(CACHE_MULTIPLIER * out[noted] & 0xFFFFFFFF) >> (32 - cache_bits)] = out[noted]
            noted += 1
    return np.array(out, np.uint32).reshape(height, width)


def channels(pixels: np.ndarray) -> np.ndarray:
    return pixels.astype("<u4").view(np.uint8).reshape(*pixels.shape, 4)


def turned_round(pixels: np.ndarray) -> np.ndarray:
    """Pixels in 32 bits with red and blue exchanged."""
    return pixels & np.uint32(0xFF00FF00) | pixels >> np.uint32(16) & np.uint32(255) | (pixels & np.uint32(255)) << np.uint32(16)


def predicted(mode: int, left, top, right, corner) -> list[int]:
    """The predictor of a mode from the neighbours' samples; right is above and to the right."""
    mean = lambda x, y: [(i + j) >> 1 for i, j in zip(x, y)]
    clamp = lambda v: 0 if v < 0 else 255 if v > 255 else v
    if mode == 11:
        to_left = sum(abs(t - c) for t, c in zip(top, corner))
        to_top = sum(abs(x - c) for x, c in zip(left, corner))
        return left if to_left < to_top else top
    if mode == 12:
        return [clamp(x + t - c) for x, t, c in zip(left, top, corner)]
    if mode == 13:
        return [clamp(m + int((m - c) / 2)) for m, c in zip(mean(left, top), corner)]
    plain = {1: left, 2: top, 3: right, 4: corner}
    if mode in plain:
        return plain[mode]
    if 5 <= mode <= 10:
        return {5: lambda: mean(mean(left, right), top), 6: lambda: mean(left, corner), 7: lambda: mean(left, top), 8: lambda: mean(corner, top), 9: lambda: mean(top, right), 10: lambda: mean(mean(left, corner), mean(top, right))}[mode]()
    return [0, 0, 0, 255]


def around(out: list, y: int, x: int, width: int):
    """Left, top, top right and top left of a pixel away from the top and left edges; right of the last column stands the row's first pixel."""
    return out[y][x - 1], out[y - 1][x], out[y - 1][x + 1] if x + 1 < width else out[y][0], out[y - 1][x - 1]


def unpredict(pixels: np.ndarray, modes: np.ndarray, block: int) -> np.ndarray:
    height, width = pixels.shape
    rest, mode = channels(pixels).astype(int).tolist(), (modes >> 8 & 15).tolist()
    for y, row in enumerate(rest):
        for x, value in enumerate(row):
            if not y:
                guess = row[x - 1] if x else [0, 0, 0, 255]
            elif not x:
                guess = rest[y - 1][0]
            else:
                guess = predicted(mode[y >> block][x >> block], *around(rest, y, x, width))
            row[x] = [(v + g) & 255 for v, g in zip(value, guess)]
    return np.array(rest, np.uint8).view("<u4")[..., 0].astype(np.uint32)


def uncross(pixels: np.ndarray, factors: np.ndarray, block: int) -> np.ndarray:
    height, width = pixels.shape
    tile = np.repeat(np.repeat(channels(factors), 1 << block, 0), 1 << block, 1)[:height, :width].view(np.int8).astype(int)
    b, g, r, a = np.moveaxis(channels(pixels).astype(int), 2, 0)
    signed = lambda v: ((v & 255) ^ 128) - 128
    r = r + (tile[..., 0] * signed(g) >> 5) & 255
    b = b + (tile[..., 1] * signed(g) >> 5) & 255
    b = b + (tile[..., 2] * signed(r) >> 5) & 255
    return (a << 24 | r << 16 | g << 8 | b).astype(np.uint32)


def add_green(pixels: np.ndarray) -> np.ndarray:
    out = channels(pixels).copy()
    out[..., 0] += out[..., 1]
    out[..., 2] += out[..., 1]
    return out.view("<u4")[..., 0].astype(np.uint32)


def colour_in(pixels: np.ndarray, table: np.ndarray, packed: int, width: int) -> np.ndarray:
    """Palette indices, several to a pixel where the palette is small, as colours; beyond the palette, transparent black."""
    index = pixels >> 8 & 255
    each = 8 >> packed
    parts = [index >> (each * k) & ((1 << each) - 1) for k in range(1 << packed)]
    index = np.stack(parts, axis=2).reshape(len(pixels), -1)[:, :width]
    return np.concatenate([table, np.zeros(256, np.uint32)])[index]


def decode_vp8l(data: bytes) -> np.ndarray:
    """Pixels of a VP8L stream: (height, width, 4) samples red, green, blue, alpha."""
    bits = Bits(data)
    if bits.read(8) != SIGNATURE:
        raise ValueError("not a VP8L stream")
    width, height = bits.read(14) + 1, bits.read(14) + 1
    alpha, version = bits.read(1), bits.read(3)
    if version:
        raise ValueError("an unknown version")
    undo, now = [], width
    while bits.read(1):
        kind = bits.read(2)
        if any(kind == k for k, *_ in undo):
            raise ValueError("a transform stands twice")
        if kind in (PREDICTOR, CROSS_COLOUR):
            block = bits.read(3) + 2
            undo.append((kind, read_pixels(bits, -(-now >> block), -(-height >> block), False), block))
        elif kind == PALETTE:
            n = bits.read(8) + 1
            table = np.cumsum(channels(read_pixels(bits, n, 1, False))[0], axis=0, dtype=np.uint8).view("<u4")[:, 0].astype(np.uint32)
            packed = 3 if n <= 2 else 2 if n <= 4 else 1 if n <= 16 else 0
            undo.append((kind, table, packed, now))
            now = -(-now >> packed)
        else:
            undo.append((kind,))
    pixels = read_pixels(bits, now, height, True)
    if bits.at > 8 * len(data):
        raise ValueError("the stream ends early")
    for kind, *how in reversed(undo):
        pixels = (unpredict, uncross, add_green, colour_in)[kind](pixels, *how)
    out = channels(turned_round(pixels))
    if not alpha:
        out[..., 3] = 255
    return out


def decode(media: bytes) -> list[np.ndarray]:
    """The images of one or more lossless WebP files that stand one after the other."""
    images, at = [], 0
    while at < len(media):
        tag, size, kind = struct.unpack_from("<4sI4s", media, at)
        if tag != b"RIFF" or kind != b"WEBP" or at + 8 + size > len(media):
            raise ValueError("not a WebP file")
        inside, end = at + 12, at + 8 + size
        while inside < end:
            name, n = struct.unpack_from("<4sI", media, inside)
            if name == b"VP8L":
                images.append(decode_vp8l(media[inside + 8 : inside + 8 + n]))
            inside += 8 + n + (n & 1)
        at = end + (size & 1)
    return images


@lru_cache(maxsize=4096)
def opening(width: int, height: int) -> tuple[bytes, int, int]:
    """The bits before the samples: signature, size, no transform, no cache, one group of eight-bit codes. Whole bytes, the rest and its number of bits."""
    value = n = 0

    def put(x: int, size: int) -> None:
        nonlocal value, n
        value |= x << n
        n += size

    put(SIGNATURE, 8)
    put(width - 1, 14)
    put(height - 1, 14)
    put(1, 1)  # alpha
    put(0, 3 + 1 + 1 + 1)  # version; no transform, cache or meta codes
    for alphabet in (280, 256, 256, 256):
        put(0, 1)  # a normal code, of whose code lengths only 8 occurs
        put(12 - 4, 4)
        for k in range(12):
            put(int(LENGTH_ORDER[k] == 8), 3)
        if alphabet > 256:
            put(1, 1)  # 256 code lengths: 2 + 254 in eight bits
            put(3, 3)
            put(254, 8)
        else:
            put(0, 1)
    put(1, 1)  # distances: a simple code of the symbol 0
    put(0, 1 + 1 + 1)
    return value.to_bytes(n // 8 + 1, "little")[: n // 8], value >> (n // 8 * 8), n % 8


def flat(samples: np.ndarray) -> bytes:
    """The VP8L stream of (height, width, 4) samples with all literals of eight bits."""
    height, width, _ = samples.shape
    head, rest, shift = opening(width, height)
    body = REVERSED[samples[..., [1, 0, 2, 3]].reshape(-1)]
    if shift:
        out = np.empty(len(body) + 1, np.uint8)
        out[:-1] = body << shift
        out[-1] = 0
        out[1:] |= body >> (8 - shift)
        out[0] |= rest
        body = out
    return head + body.tobytes()


def flat_size(samples: np.ndarray) -> int:
    """The bytes of the flat stream."""
    head, _, shift = opening(*samples.shape[1::-1])
    return len(head) + samples.size + (shift > 0)


def code_lengths(counts: list[int], most: int) -> list[int]:
    """Lengths of a prefix code of at least two symbols, none over most bits: the two lightest nodes are joined again and again, leaves and joined nodes each in their order."""
    m = len(counts)
    while True:
        order = sorted(range(m), key=counts.__getitem__)
        leaves, nodes = [*map(counts.__getitem__, order), math.inf], [math.inf] * m
        above_leaf, above_node, leaf, node = [], [], 0, 0
        light, joined = leaves[0], math.inf
        for new in range(m - 1):
            total = 0
            for _ in (0, 1):
                if light <= joined:
                    total += light
                    above_leaf.append(new)
                    leaf += 1
                    light = leaves[leaf]
                else:
                    total += joined
                    above_node.append(new)
                    node += 1
                    joined = nodes[node]
            nodes[new] = total
            if node == new:
                joined = total
        depth = [1] * (m - 1)  # of a node's parts
        for k in range(m - 3, -1, -1):
            depth[k] = depth[above_node[k]] + 1
        if depth[above_leaf[0]] <= most:  # the lightest leaf is the deepest
            lengths = [0] * m
            for k, up in zip(order, above_leaf):
                lengths[k] = depth[up]
            return lengths
        counts = [n // 2 + 1 for n in counts]


@lru_cache(maxsize=4096)
def opening_of(kinds: tuple[int, ...]) -> tuple[int, list[int], list[int]]:
    """For how often each code length symbol stands: the bits before the code lengths, 63, and the symbols' codes and lengths."""
    there = [k for k, n in enumerate(kinds) if n]
    if len(there) < 2:
        there = sorted({0, 18, *there})
    lengths, codes, at = [0] * 19, [0] * 19, 0
    for k, size in zip(there, code_lengths([kinds[k] for k in there], 7)):
        lengths[k] = size
    turned = backwards(7).tolist()
    for n, k in sorted((lengths[k], k) for k in there):
        codes[k] = turned[at]
        at += 1 << (7 - n)
    value = 15 << 1  # a normal code, of whose code lengths' lengths all stand there
    for k, x in enumerate(LENGTH_ORDER):
        value |= lengths[x] << 5 + 3 * k
    return value, codes, lengths


def before_each(sizes: np.ndarray) -> np.ndarray:
    """The sum of the sizes before each."""
    return sizes.cumsum() - sizes


def packed(bits: np.ndarray, sizes: np.ndarray, stream: np.ndarray, at: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray]:
    """Bits, at most 63 a step, of streams one after the other, the first of each at a bit under 64 of its first word: all words, where a stream's words begin and where its bits end."""
    many = np.bincount(stream, minlength=len(at))
    first = before_each(many)
    ends = np.append(0, sizes.cumsum())
    own = ends[first + many] - ends[first] + at
    words = own // 64 + 2
    base = before_each(words)
    starts = ends[:-1] + (64 * base + at - ends[first])[stream]
    word, within, bits = starts >> 6, (starts & 63).view(np.uint64), bits.view(np.uint64)
    new = np.append(0, (word[1:] != word[:-1]).nonzero()[0] + 1)[: len(word)]
    body = np.zeros(int(words.sum()), "<u8")
    if len(word):
        body[word[new]] = np.bitwise_or.reduceat(bits << within, new)
        body[word[new] + 1] |= np.bitwise_or.reduceat(bits >> np.uint64(1) >> (np.uint64(63) - within), new)
    return body.tobytes(), 8 * base, own


def runs_of(sizes: np.ndarray, first: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, ...]:
    """Code lengths of codes one after the other as symbols, their extra bits, the number of these and the code: runs are said at once."""
    new = np.append(True, sizes[1:] != sizes[:-1])
    new[first] = True
    begin = new.nonzero()[0]
    value = sizes[begin]
    run = np.append(begin[1:], len(sizes)) - begin
    once = (value > 0).astype(np.int64)  # a length is said before its run
    run -= once
    most = np.where(value > 0, 6, 138)
    full, left = run // most, run % most
    some = (left >= 3).astype(np.int64)
    many = once + full + some + np.where(some, 0, left)
    which = np.arange(len(begin)).repeat(many)
    k = np.arange(len(which)) - before_each(many)[which]
    value, left = value[which], left[which]
    long = (k >= once[which]) & (k < (once + full)[which])
    size = np.where(long, most[which], left)  # of what is said at once
    long |= (k == (once + full)[which]) & (some[which] > 0)
    kind = np.where(value > 0, 0, np.where(size >= 11, 2, 1))  # of the symbols 16, 17 and 18
    kind = np.where(long, kind, 3)
    symbol = np.where(long, 16 + kind, value)
    extra = np.where(long, size - np.array([3, 3, 11, 0])[kind], 0)
    return symbol, extra, np.array([2, 3, 7, 0])[kind], code[begin[which]]


def counted_codes(counts: np.ndarray, alphabets: np.ndarray) -> tuple[list[tuple[int, int]], np.ndarray, np.ndarray]:
    """Prefix codes after how often each symbol of each alphabet stands: the bits that describe each code and their number, and all symbols' codes and lengths."""
    first, code = before_each(alphabets), np.arange(len(alphabets)).repeat(alphabets)
    used = counts.nonzero()[0]
    many = np.bincount(code[used], minlength=len(alphabets))
    sizes, table = np.zeros(len(counts), np.int64), np.zeros(len(counts), np.int64)
    said: list[tuple[int, int]] = [(1 | 1 << 2, 11)] * len(many)  # a simple code of the symbol 0
    for k, at in zip((many == 1).nonzero()[0].tolist(), used[many[code[used]] == 1].tolist()):
        said[k] = (1 | 1 << 2 | at - int(first[k]) << 3, 11)
    used = used[many[code[used]] > 1]
    if not len(used):
        return said, table, sizes
    n_of, lengths, at = counts[used].tolist(), [], 0
    normal = (many > 1).nonzero()[0]
    for n in many[normal].tolist():
        lengths += code_lengths(n_of[at : at + n], 15)
        at += n
    sizes[used] = lengths
    order = np.sort((code[used] << 4 | sizes[used]) << 32 | used) & 0xFFFFFFFF
    spans = 1 << (15 - sizes[order])
    table[order] = backwards(15)[before_each(spans) & 0x7FFF]  # each code takes all 15 bits
    symbol, extra, n, of = runs_of(sizes, first, code)
    kinds = np.bincount(of * 19 + symbol, minlength=19 * len(many)).reshape(-1, 19)[normal].astype(np.uint16)
    heads = [opening_of(tuple(k)) for k in kinds.tolist()]
    short, long = np.zeros((len(many), 19), np.int64), np.zeros((len(many), 19), np.int64)
    short[normal], long[normal] = [h[1] for h in heads], [h[2] for h in heads]
    kept = many[of] > 1
    symbol, extra, n, of = symbol[kept], extra[kept], n[kept], of[kept]
    size = long[of, symbol]
    body, base, own = packed(short[of, symbol] | extra << size, size + n, of, np.zeros(len(many), np.int64))
    for k, (head, _, _), at, n in zip(normal.tolist(), heads, base[normal].tolist(), own[normal].tolist()):
        said[k] = head | int.from_bytes(body[at : at + (n + 7) // 8], "little") << 63, 63 + n
    return said, table, sizes


#: Odd numbers that mix three pixels and their image into a key.
MIXED = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5)


def alike(pixels: np.ndarray, image: np.ndarray, here: np.ndarray, there: np.ndarray) -> np.ndarray:
    """Whether three pixels are the same at two places of an image."""
    equal = image[here] == image[there]
    for k in range(3):
        equal &= pixels[here + k] == pixels[there + k]
    return equal


def copies(pixels: np.ndarray, image: np.ndarray, most: int = 4096) -> np.ndarray:
    """Starts, lengths and distances of stretches of at least 3 pixels that stand before in their image too, in order and without overlap."""
    found: list[tuple[int, int, int]] = []
    inside = (image[:-2] == image[2:]).nonzero()[0]
    x, up = pixels.astype(np.uint64), len(pixels).bit_length()
    key = sum((part * np.uint64(k) for part, k in zip((x[:-2], x[1:-1], x[2:], image[2:].view(np.uint64)), MIXED)), np.uint64(0))
    key = np.sort(key[inside] >> up << up | inside.view(np.uint64))  # places stand in the lowest bits, so equal keys are in their order
    order, key = (key & np.uint64((1 << up) - 1)).astype(np.int64), key >> up
    same = key[1:] == key[:-1]
    here, there = order[1:][same], order[:-1][same]
    if not (equal := alike(pixels, image, here, there)).all():  # different pixels have one key, so these are sorted themselves: what is found doesn't depend on the images beside
        order = inside[np.lexsort((pixels[inside + 2], pixels[inside + 1], pixels[inside], image[inside]))]
        here, there = order[1:], order[:-1]
        equal = alike(pixels, image, here, there)
    before = np.full(len(pixels), -1)
    before[here[equal]] = there[equal]
    here = (before >= 0).nonzero()[0]
    before = before[here]
    new = np.append(True, (here[1:] != here[:-1] + 1) | (before[1:] != before[:-1] + 1))[: len(here)]
    starts, ends = here[new], here[np.append(new[1:], True)[: len(here)]] + 3
    at = 0
    for start, end, back in zip(starts.tolist(), ends.tolist(), (starts - before[new]).tolist()):
        start = max(start, at)
        while end - start >= 3:
            size = min(end - start, most)
            found.append((start, size, back))
            at = start = start + size
    return np.array(found, np.int64).reshape(-1, 3).T


def distinct(values: np.ndarray) -> int:
    """How many different values there are."""
    s = np.sort(values)
    return int(np.count_nonzero(s[1:] != s[:-1])) + (len(s) > 0)


def spoken(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The prefix symbols of length or distance codes, their extra bits and the number of these."""
    x = values - 1
    extra = np.maximum(np.frexp(x)[1].astype(np.int64) - 2, 0)
    return 2 * extra + (x >> extra), x & ((1 << extra) - 1), extra


@lru_cache(maxsize=16)
def neighbours(width: int) -> np.ndarray:
    """The short code of each distance that has one, 0 for others."""
    out = np.zeros(9 * width + 9, np.int64)
    for k, (dx, dy) in reversed(list(enumerate(NEIGHBOURS))):
        if dx + dy * width >= 1:
            out[dx + dy * width] = k + 1
    return out


def coded(images: list[tuple[np.ndarray, int, bool, int, int]]) -> list[tuple[bytes, int]]:
    """Entropy-coded images, each given as (pixels, 4) samples, their width, whether it's a main image, and the bits before it and their number: all bytes, and the number of all bits.

    With counted prefix codes (one for red, blue and alpha), and either
    back-references or a colour cache, whichever leaves fewer bits by an
    estimate: a literal counts for 18 bits, a back-reference for 26, a place of
    the cache for 9 and, once, 5 for its code. The cache, whose code is long to
    describe, has to save an eighth of the literals' bits more. All images are
    worked on at once, as what short ones take is mostly the calls.
    """
    many = np.array([len(x[0]) for x in images])
    rows, image = np.concatenate([x[0] for x in images]), np.arange(len(images)).repeat(many)
    pixels, total = rows.view("<u4")[:, 0], len(rows)
    start, size, back = copies(pixels, image)
    cache_bits = np.clip(np.frexp(many)[1].astype(np.int64) - 2, 1, 10)
    places = ((turned_round(pixels) * np.uint32(CACHE_MULTIPLIER)) >> (32 - cache_bits).astype(np.uint32)[image]).astype(np.int64)
    up = total.bit_length()
    held = np.sort((image << 10 | places) << up | np.arange(total))  # equal places in the order of their pixels
    order, held = held & ((1 << up) - 1), held >> up
    seen = pixels[order]
    again = (held[1:] == held[:-1]) & (seen[1:] == seen[:-1])
    twice = held[1:][again]
    kinds = np.bincount(twice[np.append(True, twice[1:] != twice[:-1])[: len(twice)]] >> 10, minlength=len(images))
    hits = np.bincount(twice >> 10, minlength=len(images))
    refers = image[start]
    saved = 18 * np.bincount(refers, size, len(images)).astype(np.int64) - 26 * np.bincount(refers, minlength=len(images))
    cached = 9 * hits - 5 * kinds > saved + 18 * many // 8
    taken = ~cached[refers]
    start, size, back, refers = start[taken], size[taken], back[taken], refers[taken]
    # A step is a literal, a back-reference or a place of the cache.
    kind = np.zeros(total, np.int8)
    change = np.zeros(total + 1, np.int8)
    change[start + 1] = 1
    change[start + size] -= 1
    kind[start] = 1
    kind[order[1:][again]] += 2 * cached[image[order[1:][again]]]
    kept = (np.cumsum(change[:-1], dtype=np.int8) == 0).nonzero()[0]
    kind, of = kind[kept], image[kept]
    literal, referred, known = (kind == 0).nonzero()[0], (kind == 1).nonzero()[0], (kind == 2).nonzero()[0]
    width = np.array([x[1] for x in images])
    near = back + len(NEIGHBOURS)
    for w in set(width.tolist()):
        short = neighbours(w)
        close = ((width[refers] == w) & (back < len(short))).nonzero()[0]
        code = short[back[close]]
        near[close] = np.where(code > 0, code, near[close])
    (length, more, more_n), (far, rest, rest_n) = spoken(size), spoken(near)
    alphabets = np.concatenate([280 + np.where(cached, 1 << cache_bits, 0), np.full(len(images), 256), np.full(len(images), 40)])
    base = before_each(alphabets).reshape(3, -1)
    green = rows[kept, 1].astype(np.int64)
    green[referred] = 256 + length
    green[known] = 280 + places[kept[known]]
    green += base[0][of]
    plain = rows[kept[literal]][:, [0, 2, 3]] + base[1][of[literal]][:, None]
    far += base[2][refers]
    said, table, sizes = counted_codes(np.bincount(np.concatenate([green, plain.reshape(-1), far]), minlength=int(alphabets.sum())), alphabets)
    heads, ats = [], []
    for k, (_, _, main, value, at) in enumerate(images):
        value |= (1 | int(cache_bits[k]) << 1 if cached[k] else 0) << at
        at += (5 if cached[k] else 1) + main  # no meta codes
        for j in (0, 1, 1, 1, 2):
            bits, n = said[j * len(images) + k]
            value |= bits << at
            at += n
        heads.append(value)
        ats.append(at)
    # A step has 60 bits at most: four codes of 15, or two with at most 10 and 20 more.
    bits, ends = table[green], sizes[green]
    for which, parts in ((literal, [(table[x], sizes[x]) for x in plain.T]), (referred, [(more, more_n), (table[far], sizes[far]), (rest, rest_n)])):
        b, e = bits[which], ends[which]
        for value, n in parts:
            b |= value << e
            e += n
        bits[which], ends[which] = b, e
    body, base, own = packed(bits, ends, of, np.array(ats) % 64)
    out = []
    for value, at, k, n in zip(heads, ats, base.tolist(), own.tolist()):
        before = at // 64 * 8
        first = int.from_bytes(body[k : k + 8], "little") | value >> 8 * before
        total = 8 * before + n
        out.append((((value & ((1 << 8 * before) - 1)).to_bytes(before, "little") + first.to_bytes(8, "little") + body[k + 8 : k + (n + 7) // 8])[: -(-total // 8)], total))
    return out


def counted(images: list[np.ndarray]) -> list[bytes]:
    """The VP8L streams of images with counted prefix codes; of few colours, with a palette where that's smaller."""
    all_rows = [np.ascontiguousarray(x).reshape(-1, 4) for x in images]
    heads = [SIGNATURE | x.shape[1] - 1 << 8 | x.shape[0] - 1 << 22 | 1 << 36 for x in images]  # alpha; version 0
    at = 40
    streams = [stream for stream, _ in coded([(rows, x.shape[1], True, head, at + 1) for rows, x, head in zip(all_rows, images, heads)])]
    few = []
    for k, rows in enumerate(all_rows):
        pixels, most = rows.view("<u4")[:, 0], min(256, max(len(rows) // 4, 1))
        if distinct(pixels[:4096]) > most:  # the first pixels alone have too many colours, so all have
            continue
        colours, index = np.unique(pixels, return_inverse=True)
        if len(colours) <= most:
            few.append((k, colours, index))
    if not few:
        return streams
    tables = [np.diff(colours.view(np.uint8).reshape(-1, 4), axis=0, prepend=np.zeros((1, 4), np.uint8)).astype(np.uint8) for _, colours, _ in few]
    small = []
    for (k, colours, index), (value, size) in zip(few, coded([(table, len(table), False, 0, 0) for table in tables])):
        height, width, _ = images[k].shape
        n = len(colours)
        head = heads[k] | (1 | PALETTE << 1 | n - 1 << 3) << at
        head |= (int.from_bytes(value, "little") & ((1 << size) - 1)) << at + 11
        packing = 3 if n <= 2 else 2 if n <= 4 else 1 if n <= 16 else 0
        each, now = 8 >> packing, -(-width >> packing)
        grid = np.zeros((height, now << packing), np.uint8)
        grid[:, :width] = index.reshape(height, width)
        rows = np.zeros((height * now, 4), np.uint8)
        for j in range(1 << packing):
            rows[:, 1] |= grid[:, j :: 1 << packing].reshape(-1) << np.uint8(each * j)
        rows[:, 3] = 255
        small.append((rows, now, True, head, at + 11 + size + 1))
    for (k, _, _), (stream, _) in zip(few, coded(small)):
        streams[k] = min(streams[k], stream, key=len)
    return streams


def encode_all(images: list[np.ndarray]) -> list[bytes]:
    """A lossless WebP file of each of (height, width, 4) samples red, green, blue, alpha: the smaller one of the counted and the flat stream."""
    out = []
    for samples, stream in zip(images, counted(images)):
        if len(stream) > flat_size(samples):
            stream = flat(samples)
        chunk = b"VP8L" + struct.pack("<I", len(stream)) + stream + bytes(len(stream) & 1)
        out.append(b"RIFF" + struct.pack("<I", 4 + len(chunk)) + b"WEBP" + chunk)
    return out


def encode(samples: np.ndarray) -> bytes:
    return encode_all([samples])[0]


#: Samples in a row of 48 pixels; rows in one image.
ROW, ROWS = 192, 16384


#: Pixels that are coded at a time.
AT_ONCE = 1 << 16


def files(payloads: Iterable[bytes]) -> Iterator[tuple[bytes, bool]]:
    """The files of payloads in their order, and whether each is its payload's last."""
    images, last, pixels = [], [], 0
    for payload in payloads:
        rows = np.frombuffer(payload, np.uint8).reshape(-1, ROW // 4, 4)
        for at in range(0, len(rows), ROWS):
            images.append(rows[at : at + ROWS])
            last.append(at + ROWS >= len(rows))
            pixels += images[-1].size // 4
            if pixels >= AT_ONCE:
                yield from zip(encode_all(images), last)
                images, last, pixels = [], [], 0
    if images:
        yield from zip(encode_all(images), last)


def store_all(payloads: Iterable[bytes]) -> Iterator[bytes]:
    """Each payload of a multiple of ROW bytes as WebP files of 48 pixels a row, one file for each ROWS rows."""
    media = b""
    for file, last in files(payloads):
        media += file
        if last:
            yield media
            media = b""


def store(payload: bytes) -> bytes:
    (media,) = store_all([payload])
    return media


SQUARES = np.arange(256) ** 2


def feature(images: list[np.ndarray]) -> str:
    """Mean and spread of the samples, and whether each of 64 stretches is lighter than the mean, in hexadecimal."""
    flat = images[0].reshape(-1) if len(images) == 1 else np.concatenate([x.reshape(-1) for x in images])
    edges = np.arange(65) * len(flat) // 64
    sums, sizes = np.add.reduceat(flat, edges[:-1], dtype=np.int64), edges[1:] - edges[:-1]
    total = int(sums.sum())
    square = int(np.dot(np.bincount(flat, minlength=256), SQUARES))
    bits = np.packbits(sums * len(flat) > total * sizes)
    mean = total / len(flat)
    return f"{mean:.4f} {max(square / len(flat) - mean * mean, 0) ** 0.5:.4f} {bits.tobytes().hex()}"


def media_columns(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each whole text, stored as lossless WebP and read back.

    One row a row of docs: doc_id, n_bytes (UTF-8; a null text is empty),
    payload_bytes (with the spaces that fill the last row of pixels; at least
    one row), payload_sha256 and tail_crc32 of what was read back, media_bytes,
    media_sha256, feature. Equal texts have equal values; ids may be null or
    repeated; other columns aren't read; an empty table gives no rows. Very
    long texts take one file for each 3 MB.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        texts = utf8(batch.column("text"))
        for text, media in zip(texts, store_all(x.ljust(max(-(-len(x) // ROW), 1) * ROW) for x in texts)):
            images = decode(media)
            back = b"".join(x.tobytes() for x in images)
            rows.append((len(text), len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-16:]), len(media), hashlib.sha256(media).hexdigest(), feature(images)))
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
        arrays = [pa.array(x, t) for x, t in zip(zip(*rows, strict=True), kinds, strict=True)]
        names = ["n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]
        return pa.RecordBatch.from_arrays([batch.column("id"), *arrays], ["doc_id", *names])

    schema = f"doc_id {kind}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
    return per_batch(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), work, schema)
