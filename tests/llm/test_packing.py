import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from rainledger.llm.packing import column_generation, cuts, knapsack, layout, pack
from rainledger.llm.queries import vocabulary


def test_knapsack_against_enumeration():
    dice = random.Random(1)
    for _ in range(40):
        lengths = np.array(dice.sample(range(2, 15), 4))
        prices = np.array([dice.random() for _ in lengths])
        best = {0: 0.0}
        for room in range(1, 31):
            best[room] = max([best[room - 1], *(best[room - x] + p for x, p in zip(lengths, prices) if x <= room)])
        value, pattern = knapsack(lengths, prices, 30)
        assert abs(value - best[30]) < 1e-9 and pattern @ lengths <= 30


def test_linear_program_reaches_the_material_bound():
    lengths, demand = np.array([6, 5, 4, 3]), np.array([40.0, 60.0, 55.0, 30.0])
    columns, used = column_generation(lengths, demand, 10)
    assert np.allclose(columns.T @ used, demand) and (columns @ lengths <= 10).all()
    assert used.sum() <= demand @ lengths / 10 * 1.12


def test_layout_covers_each_rank_once():
    dice = random.Random(5)
    histogram = {n: dice.randrange(1, 400) for n in [2048, *range(8, 1025, 8), *range(1, 8)]}
    plan = layout(histogram, 2048)
    total = sum(k * v for k, v in histogram.items())
    last = max(s for _, _, s, _, _ in plan) + 1
    assert last <= total / 2048 * 1.003 + 2
    assert {x for x, *_ in plan} == set(histogram)


def check(rows, texts):
    direct = Tokenizer.from_file(vocabulary())
    ids = {i: [*direct.encode(x or "", add_special_tokens=False).ids, 1] for i, x in enumerate(texts)}
    got, by = defaultdict(list), defaultdict(list)
    for r in rows:
        got[r.doc_id].append(r)
        by[r.sequence_id].append(r)
    assert set(got) == set(ids)
    for i, pieces in got.items():
        at = 0
        for r in sorted(pieces, key=lambda r: r.start):
            part = np.array(ids[i][at : at + r.length], "<u4").tobytes()
            assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(ids[i]), zlib.crc32(part))
            at += r.length
        assert at == len(ids[i])
    for pieces in by.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048
    return by


def test_pieces(spark):
    dice = random.Random(2)
    texts = [None, "", "<|endoftext|> a<|endoftext|>", "word " * 9000] + [" ".join(dice.choices(["rain", "well", "düne", "x1", "\n"], k=dice.randrange(2500))) for _ in range(300)] + ["same"] * 50
    df = spark.createDataFrame([(i, x, 5) for i, x in enumerate(texts)], "doc_id long, text string, length int").repartition(5)
    by = check(pack(df, vocabulary()).collect(), texts)
    assert sum(2048 - sum(r.length for r in x) for x in by.values()) < 2 * 2048


def test_repeated_rows_and_none(spark):
    df = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, None)], "doc_id long, text string")
    assert sorted((r.doc_id or -1, r.length) for r in pack(df, vocabulary()).collect()) == [(-1, 1), (1, 3), (1, 3)]
    assert pack(df.limit(0), vocabulary()).collect() == []
    assert cuts(4100, 2048, 8) == [2048, 2048, 4] and cuts(1900, 2048, 8) == [1024, 872, 4]


def test_workers_keep_no_tokenizer(spark):
    def kept(batches):
        from rainledger.llm import packing

        for batch in batches:
            n = len(packing._caches) + packing.splitter.cache_info().currsize
            yield pa.RecordBatch.from_arrays([pa.array([n] * batch.num_rows, pa.int64())], ["n"])

    docs = spark.createDataFrame([(i, f"word {i} and some more") for i in range(2100)], "doc_id long, text string").repartition(4)
    pieces = pack(docs, vocabulary()).collect()
    assert sorted(r.doc_id for r in pieces if r.start == 0) == list(range(2100))
    assert {r.n for r in docs.select("doc_id").mapInArrow(kept, "n long").collect()} == {0}
