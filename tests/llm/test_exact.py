import hashlib
import random
from collections import defaultdict

import pytest

from rainledger.llm.exact import Contents, exact_groups


def brute(rows):
    """(id, keep_id, size, sha) of each row, and how many are kept of each text."""
    groups = defaultdict(list)
    for i, t in rows:
        groups["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")].append(i)
    out = []
    for t, ids in groups.items():
        top = max((i for i in ids if i is not None), default=None)
        out += [(i, top, len(ids), hashlib.sha256(t.encode()).hexdigest()) for i in ids]
    return sorted(out, key=str), len(groups)


def check(spark, rows, parts=3, **how):
    df = spark.createDataFrame([(i, t, 7, "x") for i, t in rows], "doc_id long, text string, h long, rep string").repartition(parts)
    got = exact_groups(df, **how).collect()
    want, n = brute(rows)
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=str) == want
    kept = [r for r in got if r.kept]
    assert len(kept) == n == len({r.text_sha256 for r in kept})
    assert all(r.doc_id == r.keep_id for r in kept)


def texts(seed, n):
    dice = random.Random(seed)
    some = ["Same TEXT", "same text", "", None, "É", "é", "\0", "\0\0"]
    return [dice.choice(some) if dice.random() < 0.5 else f"text {dice.randrange(n)} " * dice.randrange(1, 9) for _ in range(n)]


@pytest.mark.parametrize(
    "how",
    [
        {},
        {"bound": 4_000},  # tables overflow
        {"bound": 8_000, "fan": 6},  # parts are written first
        {"hot": 2},  # frequent texts are merged in turns
        {"hot": 1, "bound": 12_000, "fan": 4},
    ],
    ids=str,
)
def test_against_brute_force(spark, how):
    rows = list(enumerate(texts(1, 250)))
    rows += [rows[3], rows[3], (None, "no id"), (None, "NO id"), (None, rows[5][1]), (10**12, "same Text")]
    check(spark, rows, 3, **how)


def test_one_text_in_all_rows(spark):
    check(spark, [(i, "One TEXT" if i % 2 else "one text") for i in range(3000)], 12, hot=3)


def test_first_tables_start_anew(spark, monkeypatch):
    import rainledger.llm.exact as exact

    monkeypatch.setattr(exact, "LOCAL_ROWS", 7)
    monkeypatch.setattr(exact, "BATCH", 100)
    check(spark, list(enumerate(texts(2, 200))))


def test_long_texts(spark):
    check(spark, list(enumerate(["a" * 300_000, "A" * 300_000, "a" * 299_999 + "b", "B" * 5_000_000, "b" * 5_000_000])), bound=1 << 20)


def test_empty_and_types(spark):
    assert exact_groups(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    got = exact_groups(spark.createDataFrame([("b", "x"), ("a", "X")], "doc_id string, text string")).collect()
    assert sorted((r.doc_id, r.keep_id, r.kept) for r in got) == [("a", "b", False), ("b", "b", True)]


def test_table_compares_contents():
    t = Contents()
    for k in range(5000):
        found, slot = t.find(7, b"%d" % (k % 2500)) if k < 100 else t.find(k % 2500, b"%d" % (k % 2500))
        if found < 0:
            t.add(7 if k < 100 else k % 2500, b"%d" % (k % 2500), slot)
    # contents with one hash are told apart, and an entry is found by its own hash only
    assert all(t.held[t.find(7, b"%d" % k)[0]] == b"%d" % k for k in range(100))
    assert t.find(7, b"none")[0] == -1 and len(t.slots) >= 2 * len(t.held)
