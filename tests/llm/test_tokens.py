import random
import unicodedata

import pytest
from tokenizers import Tokenizer

from rainledger.llm.queries import vocabulary
from rainledger.llm.tokens import splitter, token_counts

ODD = [None, "", " ", "\n\n  x", "<|endoftext|>", "a <|endoftext|>  b<|endoftext|>", "it's we'll 'S", "x" * 5000, "  tabs\t\t1²½ ", "\x1c\x1d a\x85b", "日本語 テスト 한국어", "é" * 300, "ա՘ ֋ 🙂🙂 ࢏"]


@pytest.fixture(scope="module")
def direct():
    return Tokenizer.from_file(vocabulary())


def test_counts_equal_the_tokenizer(spark, direct):
    dice = random.Random(3)
    points = [chr(i) for i in range(1, 0x3000) if unicodedata.category(chr(i)) != "Cs"]
    texts = ODD + ["".join(dice.choices(points[: dice.choice([128, 700, 12000])], k=dice.randrange(80))) for _ in range(400)]
    rows = [(i, x, i) for i, x in enumerate(texts)]
    got = {r.doc_id: r for r in token_counts(spark.createDataFrame(rows, "doc_id long, text string, n_tokens long"), vocabulary()).collect()}
    for i, x, _ in rows:
        n = len(direct.encode(x or "", add_special_tokens=False).ids)
        assert (got[i].n_tokens, got[i].n_bytes, got[i].over_limit) == (n, len((x or "").encode()), n > 512), repr(x)


def test_settled_characters_split_alike(direct):
    of = splitter(vocabulary())
    for i in range(1, 0x11000):
        if not 0xD800 <= i < 0xE000:
            text = f"a{chr(i)}b  {chr(i)}{chr(i)} 1'{chr(i)}"
            assert of.pieces(text) == [text[a:b] for _, (a, b) in direct.pre_tokenizer.pre_tokenize_str(text)], hex(i)


def test_repeated_and_null_ids_and_no_rows(spark):
    df = spark.createDataFrame([(None, "a b"), (1, "a b"), (1, "a b")], "doc_id long, text string")
    assert [r.n_tokens for r in token_counts(df, vocabulary()).collect()] == [2, 2, 2]
    assert token_counts(df.limit(0), vocabulary()).collect() == []
