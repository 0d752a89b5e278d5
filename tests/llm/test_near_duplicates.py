import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from rainledger.llm import near_duplicates as nd
from rainledger.llm.near_duplicates import near_duplicates


def shingled(text):
    w = (text or "").lower().split()
    return Counter(tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1)))


def brute(texts, least=0.8):
    """Links by exact weighted Jaccard, and how near to the threshold any pair comes."""
    found = [shingled(t) for t in texts]
    df = Counter(s for f in found for s in f)
    w = [{s: (1 + math.log(n)) * (1 + math.log(len(texts) / df[s])) ** 0.25 for s, n in f.items()} for f in found]
    root = list(range(len(texts)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    near = []
    for i in range(len(texts)):
        for j in range(i):
            if not w[i].keys().isdisjoint(w[j]):
                both = sum(min(w[i][s], w[j][s]) for s in w[i].keys() & w[j].keys())
                x = both / (sum(w[i].values()) + sum(w[j].values()) - both)
                near.append(abs(x - least))
                if x >= least:
                    a, b = top(i), top(j)
                    root[max(a, b)] = min(a, b)
    return [top(i) for i in range(len(texts))], min(near)


def corpus():
    dice = random.Random(5)
    word = lambda: "".join(dice.choices("abcdefghij", k=4))
    text = lambda n: [word() for _ in range(n)]
    boiler, out = text(30), []
    for _ in range(12):
        base = text(dice.randrange(60, 200))
        out.append(base)
        for _ in range(dice.randrange(5)):
            copy = list(base)
            for _ in range(dice.randrange(1, 4)):
                copy[dice.randrange(len(copy))] = word()
            out.append(copy)
    drift = text(150)
    for _ in range(12):  # each near the one before, the last far from the first
        out.append(list(drift))
        drift[dice.randrange(150)] = word()
    out += [text(10) + boiler + text(25) for _ in range(40)]
    out += [["one", "two"], ["one", "two"], ["one", "three"]]
    return [" ".join(x) for x in out] + ["", None, "  \n", "ONE  Two", "again and again " * 4000, "again and again " * 5000]


@pytest.mark.parametrize("chunk", [512, 4])
def test_against_brute_force(spark, chunk):
    texts = corpus()
    want, margin = brute(texts)
    assert margin > 1e-4
    rows = [(i, t, 1, 0.5) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, class_size int, root double").repartition(3)
    got = {r.doc_id: r for r in near_duplicates(df, chunk=chunk).collect()}
    assert [got[i].class_id for i in range(len(texts))] == want
    sizes = Counter(want)
    assert all(r.class_size == sizes[want[i]] and r.kept == (want[i] == i) for i, r in got.items())


def test_nulls_repeats_and_none(spark):
    df = spark.createDataFrame([(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (None, "x y"), (7, None)], "doc_id long, text string")
    got = sorted((str(r.doc_id), str(r.class_id), r.class_size, r.kept) for r in near_duplicates(df).collect())
    assert got == [("1", "1", 3, False), ("1", "1", 3, True), ("7", "7", 1, True), ("None", "1", 3, False), ("None", "None", 1, True)]
    assert near_duplicates(df.limit(0)).collect() == []


def test_samples_agree_as_often_as_the_similarity():
    dice = np.random.default_rng(1)
    hits = []
    for _ in range(60):
        n = 200
        value = dice.integers(0, 1 << 62, n).astype(np.uint64)
        a, b = dice.uniform(0.5, 6, (2, n)).astype(np.float32)
        sig = nd.signatures(np.repeat([0, 1], n), np.tile(value, 2), np.concatenate([a, b]), 2)
        hits.append((sig[0] == sig[1]).mean() - np.minimum(a, b).sum() / np.maximum(a, b).sum())
    assert abs(np.mean(hits)) < 0.025


def test_buckets_hold_similar_pairs():
    keys = defaultdict(set)
    dice = np.random.default_rng(2)
    missed = 0
    for t in range(300):
        value = dice.integers(0, 1 << 62, 230).astype(np.uint64)
        owner, x = np.repeat([0, 1], 210), np.concatenate([value[:210], value[20:]])
        k = nd.band_keys(nd.signatures(owner, x, np.ones(420, np.float32), 2))
        missed += not set(k[0]) & set(k[1])
        keys[t] = set(k[0])
    assert missed <= 1


def test_recall_of_links_by_plain_weights(spark):
    """Links at 0.8 by (1 + ln times) * (1 + ln(n / df)), undamped, of documents whose id is divisible by 100 with all documents; how many end in one class."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    rows = [(r.doc_id, shingled(r.text)) for r in docs.collect()]
    df, holders = Counter(s for _, f in rows for s in f), defaultdict(list)
    weight = [{s: (1 + math.log(n)) * (1 + math.log(len(rows) / df[s])) for s, n in f.items()} for _, f in rows]
    total = [sum(w.values()) for w in weight]
    for i, w in enumerate(weight):
        for s in w:
            holders[s].append(i)
    class_of = {r.doc_id: r.class_id for r in near_duplicates(docs).collect()}
    found = together = 0
    for i, (a, _) in enumerate(rows):
        if a % 100 == 0:
            both = Counter()
            for s, v in weight[i].items():
                for j in holders[s]:
                    both[j] += min(v, weight[j][s])
            for j, x in both.items():
                if j != i and x / (total[i] + total[j] - x) >= 0.8:
                    found += 1
                    together += class_of[a] == class_of[rows[j][0]]
    print(f"links by plain weights: {found}, in one class: {together}")
    assert found > 20 and together >= 0.9 * found


def test_a_half_similar_group_links_within_tasks(spark):
    """A group whose texts are alike at 0.6 to 0.95: the same classes as brute force, whatever the chunks."""
    dice = random.Random(11)
    base = ["".join(dice.choices("abcdefghij", k=4)) for _ in range(120)]
    texts = []
    for _ in range(150):
        copy = [w for w in base if dice.random() > dice.choice([0.005, 0.03, 0.06])]
        texts.append(" ".join(copy))
    want, margin = brute(texts)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    for chunk in (512, 16):
        got = {r.doc_id: r.class_id for r in near_duplicates(df, chunk=chunk).collect()}
        assert margin > 1e-6 and [got[i] for i in range(len(texts))] == want
    assert 3 < len(set(want)) < 140
