import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from rainledger.llm import suffix
from rainledger.llm.suffix import common_prefixes, repeated_windows, segments, suffix_array, without_marked, without_repeats


def brute(texts, length):
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = True
        out.append((int(gone.sum()), np.frombuffer(t, np.uint8)[~gone].tobytes()))
    return out


def corpus(seed, n=60, length=200):
    dice = random.Random(seed)
    word = lambda: "".join(dice.choices("abcdeé \n", k=dice.randrange(1, 9)))
    passages = [" ".join(word() for _ in range(dice.randrange(20, 90))) for _ in range(6)]
    texts = [None, "", "a" * (3 * length), "ab" * length, "x" * (length - 1), "x" * (length - 1), "\x00" * (length + 3), passages[0], passages[0]]
    for _ in range(n):
        parts = [word() for _ in range(dice.randrange(10, 200))]
        for _ in range(dice.randrange(3)):
            parts.insert(dice.randrange(len(parts)), dice.choice(passages))
        texts.append(" ".join(parts))
    for _ in range(n // 3):
        t = list(dice.choice(texts[9:]))
        t[dice.randrange(len(t))] = "#"
        texts.append("".join(t))
    return texts


@pytest.mark.parametrize("alphabet", ["ab", "a", "ab\x00", "abcdefghij\xff"])
def test_suffix_array_and_prefixes(alphabet):
    dice = random.Random(alphabet)
    for n in (1, 2, 9, 40, 300):
        text = "".join(dice.choices(alphabet, k=n)).encode("latin-1")
        order, rank, words = suffix_array(np.frombuffer(text, np.uint8))
        want = sorted(range(n), key=lambda i: text[i:])
        assert order.tolist() == want and [want[r] for r in rank] == list(range(n))
        cuts = np.array(sorted({0, *(dice.randrange(n) for _ in range(4))}))
        got = common_prefixes(order, rank, words, cuts, np.diff(np.append(cuts, n)), 12)
        for k in range(1, n):
            a, b = text[want[k - 1] :], text[want[k] :]
            same = next((i for i in range(min(len(a), len(b))) if a[i] != b[i]), min(len(a), len(b)))
            assert got[k] == min(same, 12)


def test_segments_hold_each_window_once_and_follow_content():
    texts = [(t or "").encode() for t in corpus(1)]
    owner, start, windows, key, content, _ = segments(texts, 200)
    assert (windows <= suffix.MOST).all()
    held = sorted((o, s + k) for o, s, w in zip(owner, start, windows) for k in range(w))
    assert held == [(i, k) for i, t in enumerate(texts) for k in range(len(t) - 199)]
    by = {}
    for o, s, w, h, c in zip(owner.tolist(), start, windows, key, content):
        for k in range(w):
            assert by.setdefault(texts[o][s + k : s + k + 200], h) == h
    assert all(len({texts[o][s : s + w + 199] for o, s, w, c in zip(owner, start, windows, content) if c == x}) == 1 for x in set(content.tolist()))


def test_different_texts_of_common_words_share_few_keys():
    dice = random.Random(4)
    words = ["the", "of", "and", "in", "to", "thing", "thered", "ation", "onthe", "inger", "andes", "hered", "ofthe", "enter", "isthat", "withon"]
    texts = [" ".join(dice.choices(words, k=500)).encode() for _ in range(400)]
    owner, _, _, key, _, _ = segments(texts, 200)
    homes = {}
    for o, h in zip(owner.tolist(), key.tolist()):
        homes.setdefault(h, set()).add(o)
    assert sum(len(homes[h]) > 1 for h in key.tolist()) < 0.01 * len(key)


def test_windows_of_a_shard():
    texts = [t.encode() for t in corpus(2) if t and len(t) >= 200]
    marks, prints = repeated_windows(texts, 200, np.zeros(len(texts), bool), True)
    seen = Counter(t[i : i + 200] for t in texts for i in range(len(t) - 199))
    for t, m, (a, b) in zip(texts, marks, prints):
        assert m.tolist() == [seen[t[i : i + 200]] > 1 for i in range(len(t) - 199)]
    assert sum(int(np.count_nonzero(a | b)) for a, b in prints) == len(seen)


@pytest.mark.parametrize("contents,shard", [(4096, 1 << 20), (2, 3000)])
def test_against_brute_force(spark, monkeypatch, contents, shard):
    monkeypatch.setattr(suffix, "SHARD", shard)
    texts = corpus(3)
    common = " ".join(f"common{i}" for i in range(19))  # less than a window, with other text around it in each document
    texts += [f"{i * 7919 % 1000} {i} " * 3 + common + f" {i % 5} and more {i // 2}" * 2 for i in range(40)]
    df = spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)], "doc_id long, text string, n_removed int").repartition(3)
    got = {r.doc_id: r for r in without_repeats(df, contents=contents).collect()}
    raw = [(t or "").encode() for t in texts]
    for i, (n, kept) in enumerate(brute(raw, 200)):
        assert (got[i].n_bytes, got[i].n_removed, bytes(got[i].kept)) == (len(raw[i]), n, kept)
        assert sum(s.end - s.start for s in got[i].spans) == n


def test_spans_of_neighbouring_texts():
    a = "".join(map(str, range(60)))  # 110 bytes
    texts = [x.encode() for x in (a, "", a, "x" + a[:30] + "y" + a[40:70], "")]
    bits = np.packbits([k in (1, 31) for k in range(52)]).tobytes()
    whole = [{"place": 90, "marks": None}]  # 91 windows from 0
    marks = pa.array([whole, None, whole, [{"place": 51, "marks": bits}], []], pa.list_(pa.struct([("place", pa.int64()), ("marks", pa.binary())])))
    lost, spans, kept = without_marked(texts, marks, 20)
    assert lost.to_pylist() == [110, 0, 110, 40, 0]
    assert [[(s["start"], s["end"]) for s in x] for x in spans.to_pylist()] == [[(0, 110)], [], [(0, 110)], [(1, 21), (31, 51)], []]
    assert kept == [b"", b"", b"", texts[3][:1] + texts[3][21:31] + texts[3][51:], b""]


def test_repeated_rows_nulls_and_none(spark):
    long = " ".join(map(str, range(100)))
    df = spark.createDataFrame([(1, long), (1, long), (None, "b" * 500), (None, None)], "doc_id long, text string")
    assert sorted((r.n_bytes, r.n_removed) for r in without_repeats(df).collect()) == [(0, 0), (289, 289), (289, 289), (500, 500)]
    assert without_repeats(df.limit(0)).collect() == []
