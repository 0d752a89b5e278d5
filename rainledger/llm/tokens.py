"""Token counts by a two-tier lookup of pre-token lengths.

The first tier is a compact table of pre-token lengths that is broadcast: the
most frequent pre-tokens of a bounded sample of the documents, counted within
one task, and the vocabulary's entries that are pre-tokens of their own. The
second tier is a bounded cache in each Python worker, filled by encoding what
the first tier misses. No pre-token is shuffled, and the counts don't depend on
what the table holds.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rainledger.llm.frames import per_batch

#: Ranges of characters whose class is the same in every Unicode version at hand; a text with others is split by the tokenizer's own pre-tokeniser.
SETTLED = ((0x00, 0x1B), (0x20, 0x52F), (0x2010, 0x205E), (0x20A0, 0x20BF), (0x2190, 0x21FF), (0x3041, 0x3096), (0x30A1, 0x30FA), (0x4E00, 0x9FA5), (0xAC00, 0xD7A3))
#: A worker's cache holds this many pre-tokens beyond the first tier at most, none longer than LONGEST characters.
CACHED, LONGEST = 300_000, 48
#: Documents of the sample whose pre-tokens are counted, and how many of these the broadcast table holds at most.
SAMPLE, FREQUENT = 2_000, 50_000


def _class(letter: str) -> str:
    """A regex class of the settled characters whose general category starts with letter."""
    points = [i for a, b in SETTLED for i in range(a, b + 1) if unicodedata.category(chr(i))[0] == letter]
    runs, start = [], points[0]
    for i, j in zip(points, [*points[1:], -1], strict=True):
        if j != i + 1:
            runs.append(f"\\u{start:04x}-\\u{i:04x}")
            start = j
    return "".join(runs)


_L, _N = _class("L"), _class("N")
#: The byte-level pre-tokeniser's pattern over the settled characters; the contractions start with no letter, so their place among the alternatives is free before the last.
_find = re.compile(rf" ?[{_L}]+|'s|'t|'re|'ve|'m|'ll|'d| ?[{_N}]+| ?[^\s{_L}{_N}]+|\s+(?!\S)|\s+").findall
OTHER = re.compile("[^" + "".join(f"\\u{a:04x}-\\u{b:04x}" for a, b in SETTLED) + "]")


def _merger(path: str):
    """A fast merger of one pre-token's bytes for byte-level vocabularies whose ids follow the order of the merges; else None."""
    import tiktoken

    model = json.load(open(path, encoding="utf-8"))["model"]
    vocab, merges = model["vocab"], [x.split(" ") if isinstance(x, str) else x for x in model.get("merges", [])]
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in set(shown))}
    made = [vocab.get(a + b, -1) for a, b in merges]
    if model.get("type") != "BPE" or not all(c in vocab for c in byte) or made != sorted(made) or len(vocab) != 256 + len(merges) or -1 in made or made[0] < 256:
        return None
    ranks = {bytes(byte[c] for c in word): i for word, i in vocab.items()}
    return tiktoken.Encoding("pieces", pat_str=r"(?s).+", mergeable_ranks=ranks, special_tokens={}).encode_ordinary


class Splitter:
    """The tokenizer of a file, with its special strings and its pre-tokeniser."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = {t.content: i for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        self.cut = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self.merge = _merger(path)

    def plain(self, text: str):
        """The stretches of text between special strings, and the special strings."""
        if self.cut is None:
            return [text], []
        found = self.cut.findall(text)
        return (self.cut.split(text), found) if found else ([text], found)

    def pieces(self, text: str) -> list[str]:
        if OTHER.search(text):
            return [text[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(text)]
        return _find(text)

    def ids(self, piece: str) -> list[int]:
        """The ids of one pre-token."""
        if self.merge is not None:
            return self.merge(piece)
        return self.tokenizer.encode(piece, add_special_tokens=False).ids


@lru_cache(maxsize=2)
def splitter(path: str) -> Splitter:
    return Splitter(path)


class Cache(dict):
    """pre-token -> what the encoder makes of it; misses are encoded, and kept while there's room."""

    def __init__(self, of, first: dict):
        super().__init__(first)
        self.of, self.first = of, first

    def __missing__(self, piece: str):
        value = self.of(piece)
        if len(piece) <= LONGEST:
            if len(self) >= len(self.first) + CACHED:
                self.clear()
                self.update(self.first)
            self[piece] = value
        return value


def frequent(docs: DataFrame, path: str, text_col: str, sample: int = SAMPLE, most: int = FREQUENT) -> list[str]:
    """The most frequent pre-tokens of the first documents of the first partition that has any, counted in its task; no other is read."""

    def count_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, seen, left = splitter(path), Counter(), sample
        for batch in batches:
            for x in batch.column("text").to_pylist()[:left]:
                for part in of.plain(x or "")[0]:
                    seen.update(p for p in of.pieces(part) if len(p) <= LONGEST and "\x00" not in p)
                if len(seen) > 16 * most:  # rare ones go, so a sample of long texts stays bounded
                    seen = Counter(dict(seen.most_common(4 * most)))
            left -= batch.num_rows
            if left <= 0:
                break
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array([[p for p, _ in seen.most_common(most)]], pa.list_(pa.string()))], ["pieces"])

    found = docs.select(F.col(text_col).alias("text")).mapInArrow(count_all, "pieces array<string>").take(1)
    return sorted(found[0].pieces) if found else []


def frequent_lengths(path: str, pieces: list[str] = ()) -> bytes:
    """First tier: these pre-tokens and vocabulary entries that are pre-tokens of their own, and their lengths, compressed. Bounded by FREQUENT and the vocabulary."""
    import zstandard

    of = splitter(path)
    decoded = (of.tokenizer.decode([i]) for i in range(of.tokenizer.get_vocab_size()))
    words = [w for w in dict.fromkeys(decoded) if w and "�" not in w and "\x00" not in w and w not in of.special and of.pieces(w) == [w]]
    words = list(dict.fromkeys([*words, *(p for p in pieces if p)]))
    lengths = np.array([len(of.ids(w)) for w in words], np.uint8)  # no more than bytes of LONGEST characters
    return zstandard.compress("\x00".join(words).encode() + b"\x00\x00" + lengths.tobytes())


_lengths: dict[str, Cache] = {}


def lengths(path: str, packed: bytes) -> Cache:
    """The worker's cache over the first tier; one for each file."""
    if path not in _lengths:
        import zstandard

        words, _, sizes = zstandard.decompress(packed).partition(b"\x00\x00")
        of = splitter(path)
        _lengths[path] = Cache(lambda piece: len(of.ids(piece)), dict(zip(words.decode().split("\x00"), sizes, strict=True)))
    return _lengths[path]


def count(text: str, path: str, table: Cache) -> int:
    of = splitter(path)
    plain, special = of.plain(text)
    return len(special) + sum(sum(map(table.__getitem__, of.pieces(x))) for x in plain if x)


def token_counts(docs: DataFrame, path: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Tokens of each whole text as the tokenizer in path counts them, no special tokens added.

    One row a row of docs: doc_id (kept as it is, null or repeated), n_bytes,
    n_tokens, over_limit. A null text counts as empty: 0 tokens. Special
    strings inside a text count as one token each. Other columns of docs are
    not read, whatever their names. An empty table gives an empty result.
    """
    packed = docs.sparkSession.sparkContext.broadcast(frequent_lengths(path, frequent(docs, path, text_col)))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        table = lengths(path, packed.value)
        texts = [x or "" for x in batch.column("text").to_pylist()]
        n = np.array([count(x, path, table) for x in texts], np.int64)
        size = np.array([len(x.encode()) for x in texts], np.int64)
        return pa.RecordBatch.from_arrays([batch.column("id"), pa.array(size), pa.array(n), pa.array(n > limit)], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    kind = docs.schema[id_col].dataType.simpleString()
    return per_batch(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), work, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")
