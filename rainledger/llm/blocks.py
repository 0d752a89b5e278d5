"""Blocks of tokenised documents, and an exchange of compact requests and replies between blocks and shards.

A block is a bounded run of documents as numbers of its own words; it's written
once, so what a shard answers always meets the block that asked. A row of the
exchange holds what one block asks of one shard, packed; at any size it moves
fewer bytes than a row for each key would.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_type
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from rainledger.llm.frames import Scratch, release

#: Tokens of a block, unless one document has more; a token that ends each document and is no word.
TOKENS, END = 1 << 19, b"\n"


def packed(*arrays: np.ndarray) -> bytes:
    """Arrays of unsigned integers by byte planes, compressed."""
    parts = []
    for x in arrays:
        planes = np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T)
        parts.append(planes.tobytes())
    return zstandard.compress(b"".join(parts), 1)


def unpacked(data: bytes, *kinds: tuple[type, int]) -> list[np.ndarray]:
    raw, out, at = zstandard.ZstdDecompressor().decompress(data), [], 0
    for kind, n in kinds:
        size = np.dtype(kind).itemsize
        planes = np.frombuffer(raw, np.uint8, size * n, at).reshape(size, n)
        out.append(np.ascontiguousarray(planes.T).view(kind).reshape(n))
        at += size * n
    return out


def blocks(docs: DataFrame, split: Callable[[str], list[bytes]], chosen: Column | None = None, id_col: str = "doc_id", text_col: str = "text", tokens: int = TOKENS, scratch: Scratch | None = None) -> DataFrame:
    """Settled blocks of docs: block, ids, chosen, keys (128 bits of each text's words), sizes (tokens with END), n_words, words (hashes, sorted), data (numbers of the words)."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, turn = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            held: list[bytes] = []
            sizes, keys, first = [], [], 0
            texts = batch.column("text")
            for i in range(batch.num_rows):
                words = split(texts[i].as_py() or "")
                held += words
                held.append(END)
                sizes.append(len(words) + 1)
                keys.append(xxhash.xxh3_128_digest(b" ".join(words)))
                if len(held) >= tokens or i == batch.num_rows - 1:
                    found = pa.array(held, pa.large_binary()).dictionary_encode()
                    hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in found.dictionary.to_pylist()], np.uint64)
                    order = np.argsort(hashes, kind="stable")
                    rank = np.empty(len(order), np.uint32)
                    rank[order] = np.arange(len(order))
                    one = lambda x: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x)
                    arrays = [
                        pa.array([part | turn], pa.int64()),
                        one(batch.column("id").slice(first, len(sizes))),
                        one(batch.column("chosen").slice(first, len(sizes))),
                        one(pa.array(keys, pa.binary())),
                        one(pa.array(sizes, pa.int32())),
                        pa.array([len(order)], pa.int64()),
                        pa.array([len(held)], pa.int64()),
                        pa.array([hashes[order].tobytes()], pa.binary()),
                        pa.array([packed(rank[found.indices.to_numpy()])], pa.binary()),
                    ]
                    yield pa.RecordBatch.from_arrays(arrays, ["block", "ids", "chosen", "keys", "sizes", "n_words", "n_tokens", "words", "data"])
                    turn += 1
                    first, held, sizes, keys = i + 1, [], [], []
                    found = hashes = order = rank = arrays = None
                    release()

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), (F.lit(True) if chosen is None else F.coalesce(chosen, F.lit(False))).alias("chosen"))
    scratch = scratch or Scratch(docs.sparkSession)
    return scratch.settled(rows.mapInArrow(run, f"block long, ids array<{kind}>, chosen array<boolean>, keys array<binary>, sizes array<int>, n_words long, n_tokens long, words binary, data binary"))


class Block:
    """A block's arrays: sizes of its documents, hashes of its words, its tokens as numbers of words, and which token belongs to which document."""

    def __init__(self, row: dict):
        self.sizes = np.array(row["sizes"], np.int64)
        self.words = np.frombuffer(row["words"], np.uint64)
        self.tokens = unpacked(row["data"], (np.uint32, int(self.sizes.sum())))[0].astype(np.int64)
        self.owner = np.repeat(np.arange(len(self.sizes)), self.sizes)


def rows_of(batch: pa.RecordBatch) -> Iterator[dict]:
    for i in range(batch.num_rows):
        yield {name: batch.column(name)[i].as_py() for name in batch.schema.names}
        release()


def asked(made: DataFrame, ask: Callable[[dict], Iterator[tuple[int, bytes]]], columns: list[str]) -> DataFrame:
    """(shard, block, request) of all blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in rows_of(batch):
                found = list(ask(row))
                if not found:
                    continue
                shards, requests = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(shards, pa.int64()), pa.array([row["block"]] * len(found), pa.int64()), pa.array(requests, pa.binary())], ["shard", "block", "request"])

    return made.select("block", *columns).mapInArrow(run, "shard long, block long, request binary")


def answered(requests: DataFrame, answer: Callable[[list[bytes]], tuple[list[bytes], dict]], extra: dict[str, pa.DataType], scratch: Scratch | None = None) -> DataFrame:
    """(shard, block, reply, ...) settled; answer gets all requests of one shard in the order of their blocks. extra: more columns, in the shard's first row only."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("block")
        replies, more = answer(table.column("request").to_pylist())
        n = len(replies)
        arrays = [table.column("shard"), table.column("block"), pa.array(replies, pa.binary())]
        return pa.table([*arrays, *(pa.array([more[x]] + [None] * (n - 1), t) for x, t in extra.items())], ["shard", "block", "reply", *extra])

    fields = [StructField(x, from_arrow_type(t)) for x, t in extra.items()]
    schema = StructType([StructField("shard", LongType()), StructField("block", LongType()), StructField("reply", BinaryType()), *fields])
    scratch = scratch or Scratch(requests.sparkSession)
    return scratch.settled(requests.groupBy("shard").applyInArrow(run, schema))


def with_replies(made: DataFrame, replies: DataFrame) -> DataFrame:
    """Each block with its replies as an array of (shard, reply); there are never more of them than the block has keys."""
    own = replies.groupBy("block").agg(F.collect_list(F.struct("shard", "reply")).alias("replies"))
    return made.join(own.hint("shuffle_hash"), "block")


def shards(made: DataFrame, each: int = 1 << 20) -> tuple[int, int]:
    """(number of shards, of tokens): a shard gets the keys of `each` tokens or so."""
    total = made.agg(F.sum("n_tokens")).first()[0] or 0
    return total // each + 1, total
