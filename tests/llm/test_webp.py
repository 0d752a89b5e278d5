import hashlib
import heapq
import random
import zlib

import numpy as np
import pytest

from rainledger.llm import webp
from rainledger.llm.webp import decode, decode_vp8l, encode, media_columns, store


class Out:
    def __init__(self):
        self.bits = []

    def put(self, value, n):
        self.bits += [value >> k & 1 for k in range(n)]

    def code(self, code):
        self.bits += code

    def bytes(self):
        return np.packbits(np.array(self.bits, np.uint8), bitorder="little").tobytes()


def code_lengths(counts, most=15):
    heap = [(n, i, (i,)) for i, n in counts.items()]
    if len(heap) == 1:
        return {heap[0][1]: 1}
    depth = dict.fromkeys(counts, 0)
    heapq.heapify(heap)
    k = max(counts) + 1
    while len(heap) > 1:
        (a, _, x), (b, _, y) = heapq.heappop(heap), heapq.heappop(heap)
        for s in x + y:
            depth[s] += 1
        heapq.heappush(heap, (a + b, k, x + y))
        k += 1
    assert max(depth.values()) <= most
    return depth


def codes(lengths):
    out, code, last = {}, 0, 0
    for n, s in sorted((n, s) for s, n in lengths.items()):
        code <<= n - last
        out[s] = [code >> (n - 1 - k) & 1 for k in range(n)]
        code, last = code + 1, n
    return out if len(out) > 1 else {s: [] for s in out}


def put_code(out, lengths, alphabet):
    """Writes a normal code with runs; returns symbol -> bits."""
    row = [lengths.get(s, 0) for s in range(alphabet)]
    said, k = [], 0
    while k < alphabet:
        run = next((j for j in range(k, alphabet) if row[j] != row[k]), alphabet) - k
        if not row[k] and run >= 11:
            n = min(run, 138)
            said.append((18, n - 11, 7))
        elif not row[k] and run >= 3:
            n = min(run, 10)
            said.append((17, n - 3, 3))
        elif row[k] and run >= 4:
            said.append((row[k], 0, 0))
            n = min(run - 1, 6)
            said.append((16, n - 3, 2))
            n += 1
        else:
            said.append((row[k], 0, 0))
            n = 1
        k += n
    counts = {}
    for s, _, _ in said:
        counts[s] = counts.get(s, 0) + 1
    first = code_lengths(counts, 7)
    out.put(0, 1)
    out.put(15, 4)
    for s in webp.LENGTH_ORDER:
        out.put(first.get(s, 0), 3)
    out.put(0, 1)
    bits = codes(first)
    for s, extra, n in said:
        out.code(bits[s])
        out.put(extra, n)
    return codes(lengths)


def prefix(value):
    for symbol in range(40):
        extra = max((symbol - 2) >> 1, 0)
        low = symbol + 1 if symbol < 4 else ((2 + (symbol & 1)) << extra) + 1
        if low <= value < low + (1 << extra):
            return symbol, value - low, extra


def put_image(out, pixels, main, cache_bits=0, dice=None, meta=False):
    """An entropy-coded image of ARGB values, with back-references and cache where it finds them."""
    height, width = pixels.shape
    flat = pixels.reshape(-1).tolist()
    out.put(int(cache_bits > 0), 1)
    if cache_bits:
        out.put(cache_bits, 4)
    which, block = np.zeros((height, width), int), 2
    if main:
        out.put(int(meta), 1)
        if meta:
            out.put(block - 2, 3)
            tiles = np.array([[dice.randrange(3) for _ in range(-(-width >> block))] for _ in range(-(-height >> block))])
            put_image(out, (tiles << 8).astype(np.uint32), False)
            which = np.repeat(np.repeat(tiles, 1 << block, 0), 1 << block, 1)[:height, :width]
    which = which.reshape(-1).tolist()
    cache, steps, at = {}, [], 0
    near = {dx + dy * width: k + 1 for k, (dx, dy) in reversed(list(enumerate(webp.NEIGHBOURS))) if dx + dy * width >= 1}
    while at < len(flat):
        best = (0, 0)
        for back in [1, 2, 3, width, width + 1, 2 * width, 130 + width] if dice else []:
            n = 0
            while back <= at and at + n < len(flat) and flat[at + n] == flat[at + n - back]:
                n += 1
            best = max(best, (n, back))
        slot = (webp.CACHE_MULTIPLIER * flat[at] & 0xFFFFFFFF) >> (32 - cache_bits) if cache_bits else None
        if best[0] >= 3:
            steps.append((which[at], "copy", best[0], near.get(best[1], best[1] + 120)))
            n = best[0]
        elif cache_bits and cache.get(slot, 0 if slot not in cache else None) == flat[at] and slot in cache:
            steps.append((which[at], "cache", slot))
            n = 1
        else:
            steps.append((which[at], "pixel", flat[at]))
            n = 1
        for k in range(at, at + n):
            if cache_bits:
                cache[(webp.CACHE_MULTIPLIER * flat[k] & 0xFFFFFFFF) >> (32 - cache_bits)] = flat[k]
        at += n
    groups = max(which) + 1
    counts = [[{} for _ in range(5)] for _ in range(groups)]

    def symbols(step):
        kind, *x = step[1:]
        if kind == "pixel":
            return [(0, x[0] >> 8 & 255, 0, 0), (1, x[0] >> 16 & 255, 0, 0), (2, x[0] & 255, 0, 0), (3, x[0] >> 24, 0, 0)]
        if kind == "cache":
            return [(0, 280 + x[0], 0, 0)]
        (a, b, c), (d, e, f) = prefix(x[0]), prefix(x[1])
        return [(0, 256 + a, b, c), (4, d, e, f)]

    for step in steps:
        for c, s, _, _ in symbols(step):
            counts[step[0]][c][s] = counts[step[0]][c].get(s, 0) + 1
    made = []
    for group in counts:
        made.append([put_code(out, code_lengths(group[c] or {0: 1}), n) for c, n in enumerate((280 + (1 << cache_bits if cache_bits else 0), 256, 256, 256, 40))])
    for step in steps:
        for c, s, extra, n in symbols(step):
            out.code(made[step[0]][c][s])
            out.put(extra, n)


def argb(samples):
    r, g, b, a = np.moveaxis(samples.astype(np.uint32), 2, 0)
    return a << 24 | r << 16 | g << 8 | b


def picture(dice, height, width, colours):
    palette = [[dice.randrange(256) for _ in range(4)] for _ in range(colours)]
    out = np.array([[palette[dice.randrange(colours)] for _ in range(width)] for _ in range(height)], np.uint8)
    out[height // 3 : height // 2] = out[0]
    return out


def start(out, height, width):
    out.put(webp.SIGNATURE, 8)
    out.put(width - 1, 14)
    out.put(height - 1, 14)
    out.put(1, 1)
    out.put(0, 3)


@pytest.mark.parametrize("seed", range(6))
def test_codes_references_cache_and_meta_codes(seed):
    dice = random.Random(seed)
    samples = picture(dice, dice.randrange(1, 23), dice.randrange(1, 31), 9)
    out = Out()
    start(out, *samples.shape[:2])
    out.put(0, 1)
    put_image(out, argb(samples), True, cache_bits=seed % 3 * 2, dice=dice, meta=seed > 2)
    assert (decode_vp8l(out.bytes()) == samples).all()


@pytest.mark.parametrize("seed", range(4))
def test_predictor_cross_colour_and_green(seed):
    dice = random.Random(seed)
    height, width, block = 13, 21, 2
    samples = np.array([[[dice.randrange(256) for _ in range(4)] for _ in range(width)] for _ in range(height)], np.uint8)
    out = Out()
    start(out, height, width)
    tiles = (-(-height >> block), -(-width >> block))
    modes = np.array([[dice.randrange(14) for _ in range(tiles[1])] for _ in range(tiles[0])])
    factors = np.array([[[dice.randrange(256) for _ in range(3)] + [255] for _ in range(tiles[1])] for _ in range(tiles[0])], np.uint32)
    now = webp.channels(argb(samples)).astype(int)
    rows = now.tolist()
    rest = np.zeros_like(now)
    for y in range(height):
        for x in range(width):
            if not y:
                guess = rows[y][x - 1] if x else [0, 0, 0, 255]
            elif not x:
                guess = rows[y - 1][0]
            else:
                guess = webp.predicted(int(modes[y >> block, x >> block]), *webp.around(rows, y, x, width))
            rest[y, x] = [(v - g) & 255 for v, g in zip(rows[y][x], guess)]
    out.put(1, 1)
    out.put(webp.PREDICTOR, 2)
    out.put(block - 2, 3)
    put_image(out, (modes << 8).astype(np.uint32), False)
    signed = lambda v: (int(v) & 255 ^ 128) - 128
    for y in range(height):
        for x in range(width):
            b, g, r, a = (int(v) for v in rest[y, x])
            fb, fg, fr, _ = (int(v) for v in factors[y >> block, x >> block])
            b2 = b - (signed(fg) * signed(g) >> 5) - (signed(fr) * signed(r) >> 5)
            r2 = r - (signed(fb) * signed(g) >> 5)
            rest[y, x] = [b2 & 255, g, r2 & 255, a]
    out.put(1, 1)
    out.put(webp.CROSS_COLOUR, 2)
    out.put(block - 2, 3)
    put_image(out, (factors[..., 3] << 24 | factors[..., 2] << 16 | factors[..., 1] << 8 | factors[..., 0]).astype(np.uint32), False)
    rest[..., 0] = rest[..., 0] - rest[..., 1] & 255
    rest[..., 2] = rest[..., 2] - rest[..., 1] & 255
    out.put(1, 1)
    out.put(webp.SUBTRACT_GREEN, 2)
    out.put(0, 1)
    put_image(out, (rest[..., 3] << 24 | rest[..., 2] << 16 | rest[..., 1] << 8 | rest[..., 0]).astype(np.uint32), True)
    assert (decode_vp8l(out.bytes()) == samples).all()


@pytest.mark.parametrize("colours", [1, 2, 3, 4, 11, 16, 40])
def test_palette(colours):
    dice = random.Random(colours)
    height, width = 7, 19
    palette = np.array([[dice.randrange(256) for _ in range(4)] for _ in range(colours)], np.uint8)
    index = np.array([[dice.randrange(colours) for _ in range(width)] for _ in range(height)])
    out = Out()
    start(out, height, width)
    out.put(1, 1)
    out.put(webp.PALETTE, 2)
    out.put(colours - 1, 8)
    table = webp.channels(argb(palette[None]))[0]
    put_image(out, np.diff(table, axis=0, prepend=np.zeros((1, 4), np.uint8)).view("<u4").reshape(1, -1).astype(np.uint32), False)
    out.put(0, 1)
    packed = 3 if colours <= 2 else 2 if colours <= 4 else 1 if colours <= 16 else 0
    small = np.zeros((height, -(-width >> packed)), np.uint32)
    for x in range(width):
        small[:, x >> packed] |= (index[:, x] << (x % (1 << packed)) * (8 >> packed)).astype(np.uint32)
    put_image(out, small << 8, True)
    assert (decode_vp8l(out.bytes()) == palette[index]).all()


def test_writer_round_trip():
    dice = np.random.default_rng(4)
    for shape in [(1, 1), (3, 48), (17, 5), (200, 48)]:
        samples = dice.integers(0, 256, (*shape, 4), dtype=np.uint8)
        (back,) = decode(encode(samples))
        assert (back == samples).all()
    long = dice.integers(0, 256, 192 * 16390, dtype=np.uint8).tobytes()
    assert b"".join(x.tobytes() for x in decode(store(long))) == long and len(decode(store(long))) == 2


def test_broken_streams_are_refused():
    good = encode(np.zeros((2, 48, 4), np.uint8))
    for bad in (good[:40], b"RIFX" + good[4:], good[:20] + b"\x00" + good[21:]):
        with pytest.raises(ValueError, match="not a"):
            decode(bad)


def test_long_texts_of_few_colours_have_a_palette():
    dice = np.random.default_rng(1)
    for n in (3000, 6400):  # pixels beyond 16,384 too
        text = bytes(dice.choice(np.frombuffer(b"ab", np.uint8), 192 * n))
        media = store(text)
        assert len(media) < len(text) / 7.5 and b"".join(x.tobytes() for x in decode(media)) == text


def test_columns(spark):
    texts = [None, "", "a", "é" * 96, "x" * 193, "same", "same", "\x00\x00"]
    df = spark.createDataFrame([(i if i else None, x, "clash") for i, x in enumerate(texts)], "doc_id long, text string, feature string")
    rows = sorted(media_columns(df).collect(), key=lambda r: r.doc_id or 0)
    for r, x in zip(rows, texts):
        raw = (x or "").encode()
        payload = raw + b" " * (192 * max(-(-len(raw) // 192), 1) - len(raw))
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]))
    assert rows[5][1:] == rows[6][1:] and rows[0][1:] == rows[1][1:]
    assert media_columns(df.limit(0)).collect() == []


@pytest.mark.parametrize("seed", range(12))
def test_writer_counts_codes_and_refers_back(seed):
    dice = random.Random(seed)
    words = ["".join(dice.choices("etaoinshrdlu", k=dice.randrange(1, 9))) for _ in range(60)]
    text = " ".join(dice.choices(words, k=dice.choice([300, 2000]))).encode()
    line = text[:192]
    for payload in (text, line * 40 + text, b" " * 9000, text + b"\x00\xff" * 5000):
        payload = payload.ljust(-(-len(payload) // 192) * 192)
        media = store(payload)
        assert b"".join(x.tobytes() for x in decode(media)) == payload and len(media) < 0.75 * len(payload)
    assert len(store(line * 40)) < 400 and len(store(b" " * 9000 + b" " * 24)) < 100


def test_what_the_media_of_texts_put_to_use(monkeypatch):
    """Which parts of the decoder the stored forms of texts reach, and that they're smaller than the texts."""
    reached = set()
    steps, whole, colour = webp.read_steps, webp.read_pixels, webp.colour_in

    def watched(bits, codes, total, width, cache_bits=0):
        made = steps(bits, codes, total, width, cache_bits)
        reached.add("cache" if cache_bits else "counted codes")
        return made

    def counting(*x):
        reached.add("palette")
        return colour(*x)

    referred = lambda *x: (reached.add("back-references"), prefixed(*x))[1]
    prefixed = webp.prefixed
    monkeypatch.setattr(webp, "read_steps", watched)
    monkeypatch.setattr(webp, "colour_in", counting)
    monkeypatch.setattr(webp, "prefixed", referred)
    dice = random.Random(4)
    words = ["".join(dice.choices("etaoinshrdlu", k=dice.randrange(2, 9))) for _ in range(300)]
    prose = " ".join(dice.choices(words, k=2000)).encode()
    lines = b"".join(b"%-180s row number\n" % dice.choice(words).encode() for _ in range(40))
    few = b"".join(dice.choice([b"ab  ", b"cd  ", b"ef  "]) for _ in range(960))
    for text in (prose, lines, few, b"", b"x" * 500):
        payload = text.ljust(max(-(-len(text) // 192), 1) * 192)
        media = store(payload)
        assert b"".join(x.tobytes() for x in decode(media)) == payload
        assert len(media) < len(payload) or len(payload) == 192
    assert reached == {"counted codes", "cache", "palette", "back-references"}
    assert whole is webp.read_pixels and len(store(prose.ljust(-(-len(prose) // 192) * 192))) < 0.7 * len(prose)


@pytest.mark.parametrize("seed", range(6))
def test_caches_and_palettes_are_read_back(seed):
    dice = np.random.default_rng(seed)
    for kinds, n in ((2, 48), (3, 480), (4, 960), (16, 960), (17, 4800), (200, 4800), (256, 48 * 300), (900, 48 * 300)):
        table = dice.integers(0, 256, (kinds, 4), dtype=np.uint8)
        pixels = table[dice.integers(0, kinds, n) if seed % 2 else np.minimum(dice.geometric(0.05, n), kinds) - 1]
        pixels = np.where(dice.random(n)[:, None] < 0.1 * (seed % 3), dice.integers(0, 256, (n, 4), dtype=np.uint8), pixels).astype(np.uint8).reshape(-1, 48, 4)
        assert (decode(encode(pixels))[0] == pixels).all()


def test_flat_streams_are_made_only_where_they_are_smaller(monkeypatch):
    dice = np.random.default_rng(5)
    for shape in ((1, 48, 4), (3, 48, 4), (5, 7, 4)):
        samples = dice.integers(0, 256, shape, dtype=np.uint8)
        assert webp.flat_size(samples) == len(webp.flat(samples))
    text = (b"the rain of the season is over " * 40)[:1152]
    samples = np.frombuffer(text, np.uint8).reshape(-1, 48, 4)
    monkeypatch.setattr(webp, "flat", lambda samples: pytest.fail("not needed"))
    assert (webp.decode(webp.encode(samples))[0] == samples).all()


def test_images_of_many_texts_are_coded_at_once(monkeypatch):
    """What short texts take is mostly the calls, so these don't follow the texts; media don't depend on what is coded beside them."""
    dice = random.Random(8)
    words = ["".join(dice.choices("etaoinshrdlu", k=dice.randrange(1, 9))) for _ in range(90)]
    texts = [" ".join(dice.choices(words, k=dice.randrange(1, 400))).encode() for _ in range(150)]
    texts += [b"", b" " * 900, b"ab" * 3000, bytes(dice.choices(b"ab", k=5000)), bytes(dice.choices(range(256), k=4000)), texts[3] * 5]
    dice.shuffle(texts)
    payloads = [x.ljust(max(-(-len(x) // 192), 1) * 192) for x in texts]
    alone = [store(x) for x in payloads]
    coded, calls = webp.coded, []
    monkeypatch.setattr(webp, "coded", lambda images: (calls.append(len(images)), coded(images))[1])
    assert list(webp.store_all(payloads)) == alone
    assert len(calls) <= 3 * (1 + sum(map(len, payloads)) // 4 // webp.AT_ONCE)
    assert [b"".join(x.tobytes() for x in decode(media)) for media in alone] == payloads


def test_media_of_several_files_keep_their_texts_and_order(monkeypatch):
    monkeypatch.setattr(webp, "ROWS", 3)
    monkeypatch.setattr(webp, "AT_ONCE", 48 * 7)
    payloads = [bytes([65 + k]) * 192 * n for k, n in enumerate((1, 3, 4, 9, 1, 1, 22, 2))]
    media = list(webp.store_all(iter(payloads)))
    assert [b"".join(x.tobytes() for x in decode(m)) for m in media] == payloads
    assert [len(decode(m)) for m in media] == [-(-len(x) // 576) for x in payloads]
    assert list(webp.store_all([])) == []


def test_media_do_not_depend_on_keys_that_fall_together(monkeypatch):
    dice = random.Random(9)
    payloads = ["".join(dice.choices("ab  ", k=192 * n)).encode() for n in (1, 2, 9, 30)] * 2
    payloads += [b" " * 1920, bytes(range(192)), bytes(range(192)) * 7]
    media = list(webp.store_all(payloads))
    for mixed in ((0, 0, 0, 0), (1 << 40, 0, 0, 0), (0, 0, 0, 1 << 60)):
        monkeypatch.setattr(webp, "MIXED", mixed)
        assert list(webp.store_all(payloads)) == media
