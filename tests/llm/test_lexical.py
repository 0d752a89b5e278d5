import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from rainledger.llm import lexical
from rainledger.llm.lexical import best, ranked, slices, summed, terms

PATTERN = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def split(text):
    return PATTERN.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k):
    own = [(i, Counter(split(t))) for i, t in docs]
    own = [(i, c, sum(c.values())) for i, c in own if c]
    n_docs, n_terms = len(own), sum(n for _, _, n in own)
    df = Counter(t for _, c, _ in own for t in c)
    out = []
    for item, text in items:
        asked, found = set(split(text)), []
        for i, c, n in own:
            m = 100 - 50 + (50 * n * n_docs) // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m)) for t in asked if t in c)
            if score > 0:
                found.append((-score, i is None, i or 0, score, i))
        out += [(item, r + 1, x[4], x[3]) for r, x in enumerate(sorted(found)[:k])]
    return sorted(out, key=str)


def texts(seed, n):
    dice = random.Random(seed)
    words = ["The", "the", "É", "é", "été", "x1", "\x7f", "日本", "a_b", "don't", "\x85", "0"] + [f"w{i}" for i in range(80)]
    return [" ".join(dice.choices(words, weights=[60, 60] + [6] * 10 + [200 / (i + 2) for i in range(80)], k=dice.randrange(70))) for _ in range(n)]


def frames(spark, docs, items, parts=3):
    return spark.createDataFrame([(i, t, 1, 2.0) for i, t in docs], "doc_id long, text string, rank int, score double").repartition(parts), spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, turn string")


@pytest.mark.parametrize("size,most,k,in_memory", [(8192, 1 << 20, 50, 1024), (37, 1 << 20, 5, 1024), (100, 3000, 3, 4), (64, 3000, 50, 20)])
def test_against_brute_force(spark, monkeypatch, size, most, k, in_memory):
    monkeypatch.setattr(lexical, "DOCS", size)
    monkeypatch.setattr(lexical, "TERMS", in_memory)
    docs = list(enumerate(texts(1, 300)))
    docs += [(500 + i, docs[3][1]) for i in range(80)]  # ties
    docs += [(None, docs[4][1]), (None, docs[4][1]), (3, docs[3][1]), (990, ""), (991, None), (992, " .,"), (993, "the " * 40_000)]
    items = list(enumerate(texts(2, 12))) + [(100, docs[3][1]), (100, "the the"), (None, "w1"), (101, None), (102, ""), (103, "nowhere")]
    got = ranked(*frames(spark, docs, items, 4), k=k, most=most).collect()
    assert sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in got), key=str) == brute(docs, items, k)


def test_empty(spark):
    none, some = [], [(1, "a b")]
    for docs, items in ((none, some), (some, none), (none, none), ([(1, None)], some)):
        assert ranked(*frames(spark, docs, items)).collect() == []


def test_terms():
    for t in texts(3, 50) + ["", "A-Z", "\0a\0", "ÀÉ", "x" * 1000]:
        assert [x.decode() for x in terms(t.encode())] == split(t)


def test_sums_and_best_of_bitmaps():
    dice = np.random.default_rng(1)
    for n, rows, width in ((1, 1, 1), (64, 3, 4), (200, 9, 7), (130, 5, 33)):
        dense = dice.integers(0, 1 << 36, (rows, n)) * (dice.random((rows, n)) < 0.6)
        r, d = np.nonzero(dense)
        maps = slices(r, d, dense[r, d], rows, -(-n // 64))
        chosen = dice.integers(0, rows + 1, (6, width))
        sums = summed(maps, chosen)
        want = np.vstack([dense, np.zeros(n, np.int64)])[chosen].sum(1)
        bits = np.unpackbits(sums.view(np.uint8), axis=2, bitorder="little")[:, :, :n].astype(np.int64)
        assert ((bits << np.arange(len(sums))[:, None, None]).sum(0) == want).all()
        for k in (1, 3, 50):
            sure, ties = best(sums, k)
            for q in range(6):
                x, y = (np.flatnonzero(np.unpackbits(v[q].view(np.uint8), bitorder="little")) for v in (sure, ties))
                order = sorted((-s, i) for i, s in enumerate(want[q]) if s > 0)[:k]
                assert sorted([*x, *y[: k - len(x)]]) == sorted(i for _, i in order)
