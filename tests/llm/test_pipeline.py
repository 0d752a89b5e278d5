import random
import re
import zlib
from array import array
from collections import defaultdict

import pytest
from pyspark import AccumulatorParam

import corpus_pipeline
from rainledger.llm import frames, toxicity
from rainledger.llm.queries import vocabulary
from tests.llm.test_near_duplicates import brute as near
from tests.llm.test_suffix import brute as suffix

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
ITEM = "In the small harbour town the ferry leaves before dawn and carries bread, letters and lamp oil to the outer islands where few people live."


class Largest(AccumulatorParam):
    def zero(self, value):
        return value

    def addInPlace(self, a, b):
        return max(a, b)


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    dice = random.Random(11)
    word = lambda: "".join(dice.choices("abcdefghijklm", k=6))
    text = lambda n: " ".join(word() for _ in range(n))
    passage = text(60)
    rows, labels = [], []
    for i in range(300):
        bad = i % 3 == 0
        words = text(dice.randrange(40, 90)).split()
        if bad:
            words[5:5] = ["vilest", "awful", "muck"]
        rows.append((i, " ".join(words), "en", "s", 1))
        labels.append((i, 1, int(bad)))
    rows[1:2] = [(1, rows[1][1] + " " + passage, "en", "s", 1)]
    rows += [(401, text(30) + " " + passage + " " + text(30), None, "s", 1), (402, text(50) + " " + ITEM, "en", None, 1)]
    rows += [(403, rows[4][1] + " end", "en", "s", 1), (404, rows[4][1], "de", "s", 1), (404, rows[4][1], "de", "s", 1), (405, None, "en", "s", None), (None, text(40), "en", "s", 1), (406, "", "en", "s", 0), (407, text(9000), "en", "s", 1)]
    base = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(rows, DOCS).write.parquet(f"{base}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{base}/labels.parquet")
    spark.createDataFrame([(0, ITEM)], "item_id long, text string").write.parquet(f"{base}/benchmark.parquet")
    return base, rows


def test_stages_against_brute_force(spark, tables, tmp_path):
    base, rows = tables
    docs, out = spark.read.parquet(f"{base}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, base).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        out.append([tuple(r) for r in docs.collect()])
        if name != "packing":
            assert docs.columns == corpus_pipeline.COLUMNS
    order = lambda r: (r[0] is None, r[0] or 0, str(r))
    clean, one, cut, free, pieces = (sorted(x, key=order) for x in out)
    assert sorted(clean, key=order) == sorted((r for r in rows if "vilest" not in (r[1] or "")), key=order)
    root, _ = near([r[1] for r in clean])
    assert [str(r) for r in one] == [str(r) for i, r in enumerate(clean) if root[i] == i]
    assert {405, 406} & {r[0] for r in one} == {405} and 403 not in {r[0] for r in one}
    want = suffix([(r[1] or "").encode() for r in one], 200)
    assert [r[1] for r in cut] == [x.decode(errors="ignore") for _, x in want]
    assert all(r[4] == len(r[1]) for r in cut) and {r[0] for r in cut if len(r[1]) < len(one[cut.index(r)][1] or "")} == {1, 401}
    words = lambda t: re.findall(r"[a-z]+", (t or "").lower())
    assert [r[0] for r in free] == [r[0] for r in cut if " ".join(words(ITEM)) not in " ".join(words(r[1]))]
    assert 402 not in {r[0] for r in free}
    from tokenizers import Tokenizer

    of = Tokenizer.from_file(vocabulary())
    by, filled = defaultdict(list), defaultdict(list)
    for doc_id, start, length, crc, size, sequence, offset in pieces:
        by[doc_id].append((start, length, crc, size))
        filled[sequence].append((offset, length))
    for r in free:
        ids = array("I", [*of.encode(r[1], add_special_tokens=False).ids, 1])
        at = 0
        for start, length, crc, size in sorted(by[r[0]]):
            assert start == at and size == len(ids) and crc == zlib.crc32(ids[start : start + length].tobytes())
            at += length
        assert at == len(ids)
    for parts in filled.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048


def test_no_documents(spark, tables, tmp_path):
    docs = spark.createDataFrame([], DOCS)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, tables[0])
        assert docs.collect() == []


def test_batches_of_the_stages_are_bounded(spark, tables):
    sizes = spark.sparkContext.accumulator(0, Largest())
    spark.conf.unset(frames.BATCH)
    corpus_pipeline.toxicity(spark, spark.read.parquet(f"{tables[0]}/documents.parquet"), tables[0])

    def size(batches):
        for batch in batches:
            sizes.add(batch.nbytes)
            yield batch

    rows = spark.range(0, 3000, 1, 1).selectExpr("repeat('x', 10000) AS text")
    assert rows.mapInArrow(size, "text string").count() == 3000
    assert 4 << 20 < sizes.value < 10 << 20
    spark.conf.set(frames.BATCH, "1m")
    corpus_pipeline.packing(spark, spark.createDataFrame([], DOCS), tables[0])
    assert spark.conf.get(frames.BATCH) == "1m"
    spark.conf.unset(frames.BATCH)


def test_toxicity_sends_each_text_to_python_once(spark, tables, monkeypatch):
    seen = []
    given = toxicity.per_batch
    monkeypatch.setattr(toxicity, "per_batch", lambda df, *rest: seen.append(df.columns) or given(df, *rest))
    docs = spark.read.parquet(f"{tables[0]}/documents.parquet").select(*corpus_pipeline.COLUMNS)
    carried = toxicity.toxicity_scores(docs, spark.read.parquet(f"{tables[0]}/labels.parquet"), carry=corpus_pipeline.COLUMNS)
    assert seen[-1] == ["id", "held_out"]
    plain = toxicity.toxicity_scores(docs, spark.read.parquet(f"{tables[0]}/labels.parquet"))
    key = lambda r: (r.doc_id is None, r.doc_id or 0, r.score)
    assert [(r.doc_id, r.score) for r in sorted(carried.collect(), key=key)] == [(r.doc_id, r.score) for r in sorted(plain.collect(), key=key)]
