import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from rainledger.llm import language_model
from rainledger.llm.language_model import model_scores
from rainledger.llm.trie import EliasFano, Trie


@pytest.mark.parametrize("n,top", [(0, 1), (1, 0), (5, 3), (1000, 200), (1000, 10**12), (70_000, 10**7)])
def test_elias_fano(n, top):
    dice = np.random.default_rng(n)
    values = np.sort(dice.integers(0, top + 1, n)).astype(np.uint64)
    x = EliasFano(values)
    assert (x.access(np.arange(n)) == values).all()
    want = dice.integers(0, top + 3, 300).astype(np.uint64)
    if n:
        got = x.successor(want, np.zeros(300, np.int64), np.full(300, n))
        assert (got == np.searchsorted(values, want)).all()


def test_trie():
    dice = random.Random(3)
    held = {(c, dice.randrange(40)): dice.randrange(1, 65000) for c in range(0, 50, 2) for _ in range(dice.randrange(9))}
    pairs = sorted(held)
    t = Trie(np.arange(50).astype(np.uint64), np.array([c for c, _ in pairs]), np.array([f for _, f in pairs], np.uint64), np.array([held[p] for p in pairs], np.uint16))
    every = [(c, f) for c in range(50) for f in range(45)]
    got = t.find(np.array([c for c, _ in every]), np.array([f for _, f in every], np.uint64))
    assert got.tolist() == [held.get(p, 0) for p in every]


@pytest.mark.parametrize("often,each", [(1 / 1024, 4 << 20), (0.02, 500), (2.0, 300)])
def test_against_brute_force(spark, monkeypatch, often, each):
    monkeypatch.setattr(language_model, "OFTEN", often)
    monkeypatch.setattr(language_model, "shards", lambda made, _: (sum(r[0] for r in made.select("n_tokens").collect()) // each + 1, 0))
    dice = random.Random(1)
    texts = [" ".join(dice.choices(["The", "the", "a", "é", "É", "rain x", "\x85", *map(str, range(60))], weights=[40, 20, 10, *[1] * 64], k=dice.randrange(90))) for _ in range(150)]
    texts += ["", None, "  \t\n", "x " * 30_000, texts[0]]
    rows = [(i, t, 0.0) for i, t in enumerate(texts)] + [(None, "no id here", 0.0), (3, texts[3], 0.0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, score double").repartition(3)
    tokens = [[*re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower()), b"\n"] for _, t, _ in rows]
    held = [i is not None and zlib.crc32(str(i).encode()) % 5 == 1 for i, _, _ in rows]
    c, pairs, triples = Counter(), Counter(), Counter()
    for t, h in zip(tokens, held):
        if not h:
            c.update(t)
            pairs.update(zip([b"\n", *t], t))
            triples.update(zip([b"\n", *t], t, t[1:]))
    total, distinct, after = sum(c.values()), len(c), Counter(v for v, _ in pairs)
    p1 = lambda w: (c[w] + 0.5) / (total + 0.5 * (distinct + 1))
    p2 = lambda v, w: max(pairs[v, w] - 0.75, 0) / c[v] + 0.75 * after[v] / c[v] * p1(w) if c[v] else p1(w)
    before, kinds = Counter(), Counter(x[:2] for x in triples)
    for x, n in triples.items():
        before[x[:2]] += n
    p3 = lambda u, v, w: max(triples[u, v, w] - 0.75, 0) / before[u, v] + 0.75 * kinds[u, v] / before[u, v] * p2(v, w) if before[u, v] else p2(v, w)
    score = lambda t: math.log10(p2(b"\n", t[0])) + sum(math.log10(p3(*x)) for x in zip([b"\n", *t], t, t[1:]))
    want = sorted((i or -1, h, len(t), sum(c[w] > 0 for w in t), total, sum(math.log10(p1(w)) for w in t), score(t)) for (i, _, _), h, t in zip(rows, held, tokens))
    got = sorted((r.doc_id or -1, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in model_scores(df).collect())
    assert [x[:5] for x in got] == [x[:5] for x in want]
    for x, y in zip(got, want):
        assert x[5] == pytest.approx(y[5], rel=1e-9) and x[6] == pytest.approx(y[6], abs=2e-4 * y[2] + 1e-9)


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert model_scores(df).collect() == []
