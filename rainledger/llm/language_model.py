"""Language-model scores from Elias-Fano trigram tries over shards of the corpus.

The model interpolates discounted trigram counts with discounted bigram counts
with the add-half unigram:
p(w|v) = max(c(vw) - D, 0) / c(v) + D n(v) / c(v) p1(w), n(v) being the
different followers of v; after an unseen v it's p1(w).
p(w|uv) = max(c(uvw) - D, 0) / c(uv) + D n(uv) / c(uv) p(w|v); after an unseen uv
it's p(w|v). Each document is led by the end token; its first token has no
trigram. A shard holds contexts by hash, and below a context its followers and
theirs; the followers of words that are a noticeable share of the corpus are
dealt over all shards. Probabilities and back-off weights are stored as 16-bit
logarithms. Followers are told apart by 32 bits of their hash, followers of
followers by 24, which are looked up within their own context only.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rainledger.llm.blocks import END, Block, answered, asked, blocks, packed, rows_of, shards, unpacked, with_replies
from rainledger.llm.frames import Scratch, crc
from rainledger.llm.trie import Trie

DISCOUNT = 0.75
#: A word with more than this share of a block's tokens is looked at; one with a quarter of it of the corpus is hot. So there are 4 / OFTEN hot words at most.
OFTEN = 1 / 1024
#: Tokens of a shard; turns that the exchange and the scoring are done in, so that the shuffle files of one are gone before the next.
EACH, TURNS = 3 << 18, 2
#: Steps of a stored logarithm to a factor of ten; stored ones reach down to 10 ** -21.
STEPS = 3000
_end = np.uint64(xxhash.xxh3_64_intdigest(END))


def coded(p: np.ndarray) -> np.ndarray:
    """Probabilities as codes from 1; 0 is none."""
    return np.where(p > 0, 1 + np.clip(np.rint(-np.log10(np.maximum(p, 1e-300)) * STEPS), 0, 65533), 0).astype(np.uint16)


def decoded(code: np.ndarray) -> np.ndarray:
    return np.where(code > 0, 10.0 ** (-(code.astype(np.float64) - 1) / STEPS), 0.0)


class Pairs:
    """The different pairs of neighbouring words of a block, dealt to shards, and the trigrams below them; the same order each time. With a turn, those of its shards only."""

    def __init__(self, row: dict, n_shards: int, hot: np.ndarray, turn: int | None = None):
        b = Block(row)
        end = int(np.searchsorted(b.words, _end))
        self.block, n = b, len(b.words)
        self.before = np.concatenate([[end], b.tokens[:-1]])
        self.hot = np.isin(b.words, hot)
        home = ((b.words >> np.uint64(20)) % np.uint64(n_shards)).astype(np.int64)
        spread = ((b.words >> np.uint64(8)) % np.uint64(n_shards)).astype(np.int64)
        shard_of = lambda v, w: np.where(self.hot[v], (home[v] + spread[w]) % n_shards, home[v])
        mine = np.ones(len(b.tokens), bool) if turn is None else shard_of(self.before, b.tokens) % TURNS == turn
        self.at = np.flatnonzero(mine)  # places of the pairs
        self.keys, self.of = np.unique(self.before[self.at] * n + b.tokens[self.at], return_inverse=True)
        self.first, self.second = self.keys // n, self.keys % n
        shard = shard_of(self.first, self.second)
        order = np.argsort(shard, kind="stable")
        cuts = np.flatnonzero(np.diff(shard[order], prepend=-1))
        self.parts = [(int(shard[x[0]]), x) for x in np.split(order, cuts[1:]) if len(x)]
        self.on = np.flatnonzero(np.append(False, (b.owner[1:] == b.owner[:-1]) & mine[:-1]))  # places with a trigram: all but the first of each document
        self.context = self.of[(np.cumsum(mine) - 1)[self.on - 1]]
        self.keys3, self.of3 = np.unique(self.context * n + b.tokens[self.on], return_inverse=True)
        self.third = self.keys3 % n
        self.many3 = np.bincount(self.keys3 // n, minlength=len(self.keys))
        self.start3 = np.cumsum(self.many3) - self.many3

    def below(self, part: np.ndarray) -> np.ndarray:
        """Numbers of the trigrams below the pairs of a part, in their order."""
        many = self.many3[part]
        return np.arange(many.sum()) + np.repeat(self.start3[part] - (np.cumsum(many) - many), many)

    def contexts(self, part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The different first words of a part, and how many pairs each has."""
        turn = np.flatnonzero(np.diff(self.first[part], prepend=-1))
        return self.first[part][turn], np.diff(np.append(turn, len(part)))


def ask(row: dict, n_shards: int, hot: np.ndarray, turn: int) -> Iterator[tuple[int, bytes]]:
    """What a block tells each shard: contexts, their counts in training texts, numbers of followers, followers (32 bits), counts, and the same of followers' followers (24 bits)."""
    p = Pairs(row, n_shards, hot, turn)
    chosen = np.array(row["chosen"])[p.block.owner]
    counts = np.bincount(p.block.tokens[chosen], minlength=len(p.block.words))
    together = np.bincount(p.of[chosen[p.at]], minlength=len(p.keys))
    triples = np.bincount(p.of3[chosen[p.on]], minlength=len(p.keys3))
    for shard, part in p.parts:
        words, n = p.contexts(part)
        low = p.below(part)
        body = packed(p.block.words[words], counts[words].astype(np.uint32), n.astype(np.uint32), (p.block.words[p.second[part]] >> np.uint64(32)).astype(np.uint32), together[part].astype(np.uint32), p.many3[part].astype(np.uint32), (p.block.words[p.third[low]] >> np.uint64(40)).astype(np.uint32), triples[low].astype(np.uint32))
        yield shard, b"".join(len(x).to_bytes(4, "little") for x in (words, part, low)) + body


def _third_level(pair: np.ndarray, each: np.ndarray, third: np.ndarray, seen: np.ndarray, discount: float) -> tuple[np.ndarray, np.ndarray]:
    """Codes of trigrams, looked up in the trie's last level, and back-off codes of pairs. pair: the number of each pair told, each: its trigrams told."""
    n_pairs = int(pair.max(initial=-1)) + 1
    owner = np.repeat(pair, each)
    asked, of = np.unique((owner.astype(np.uint64) << np.uint64(24)) | third, return_inverse=True)
    owner = None
    n = np.bincount(of, weights=seen, minlength=len(asked))
    kinds, n = asked[n > 0], n[n > 0]
    whose = (kinds >> np.uint64(24)).astype(np.int64)
    total, after = np.bincount(whose, weights=n, minlength=n_pairs), np.bincount(whose, minlength=n_pairs)
    low = np.uint64((1 << 24) - 1)
    level = Trie(np.arange(n_pairs, dtype=np.uint64), whose, kinds & low, coded(np.maximum(n - discount, 0) / total[whose]))
    return level.find((asked >> np.uint64(24)).astype(np.int64), asked & low)[of], coded(np.where(total > 0, discount * after / np.maximum(total, 1), 0))


def answer(requests: list[bytes], hot: dict[int, int], discount: float) -> tuple[list[bytes], dict]:
    """Builds the shard's trie from all it was told and answers each block: counts and back-off codes of its contexts, codes and back-off codes of its pairs, codes of its trigrams."""
    words, counts, each, second, together, each3, third, triples, sizes = [], [], [], [], [], [], [], [], []
    for r in requests:
        m, n, k = (int.from_bytes(r[4 * i : 4 * i + 4], "little") for i in range(3))
        got = unpacked(r[12:], (np.uint64, m), (np.uint32, m), (np.uint32, m), (np.uint32, n), (np.uint32, n), (np.uint32, n), (np.uint32, k), (np.uint32, k))
        for x, y in zip((words, counts, each, second, together, each3, third, triples), got):
            x.append(y)
        sizes.append((m, n, k))
    contexts, place = np.unique(np.concatenate(words), return_inverse=True)
    total = np.bincount(place, weights=np.concatenate(counts), minlength=len(contexts))
    common = np.array([hot.get(int(w), -1) for w in contexts]) if hot else np.full(len(contexts), -1)
    total = np.where(common >= 0, common, total)
    owner, follower = np.repeat(place, np.concatenate(each)), np.concatenate(second)
    seen = np.concatenate(together)
    key = (owner.astype(np.uint64) << np.uint64(40)) | follower
    asked, of = np.unique(key, return_inverse=True)
    n = np.bincount(of, weights=seen, minlength=len(asked))
    kinds, n = asked[n > 0], n[n > 0]
    whose, low = (kinds >> np.uint64(40)).astype(np.int64), np.uint64((1 << 40) - 1)
    trie = Trie(contexts, whose, kinds & low, coded(np.maximum(n - discount, 0) / np.maximum(total[whose], 1)))
    after = np.bincount(whose, minlength=len(contexts))
    back = coded(np.where(total > 0, discount * after / np.maximum(total, 1), 0))
    codes = trie.find((asked >> np.uint64(40)).astype(np.int64), asked & low)[of]
    owner = follower = key = None
    codes3, back3 = _third_level(of, np.concatenate(each3), np.concatenate(third), np.concatenate(triples), discount)
    replies, i, j, low = [], 0, 0, 0
    for m, n, k in sizes:
        own, pairs = place[i : i + m], of[j : j + n]
        replies.append(packed(total[own].astype(np.uint64), back[own], codes[j : j + n], back3[pairs], codes3[low : low + k]))
        i, j, low = i + m, j + n, low + k
    warm = np.flatnonzero(common >= 0)
    return replies, {"distinct": int(((total > 0) & (common < 0)).sum()), "warm": contexts[warm].view(np.int64).tolist(), "after": after[warm].tolist()}


def _hot(made: DataFrame, n: int) -> dict[int, int]:
    """Hashes and exact counts, in training texts, of the words that are a noticeable share; bounded by 4 / OFTEN."""

    def counts(row: dict, of: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        b = Block(row)
        c = np.bincount(b.tokens[np.array(row["chosen"])[b.owner]], minlength=len(b.words))
        pick = (c > len(b.tokens) * OFTEN) if of is None else np.isin(b.words, of) & (c > 0)
        return b.words[pick].view(np.int64), c[pick]

    def summed(of: np.ndarray | None) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in rows_of(batch):
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in counts(row, of)], ["h", "n"])

        return made.select("chosen", "sizes", "words", "data").mapInArrow(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))

    found = np.array([r.h for r in summed(None).where(F.col("n") > n * OFTEN / 4).collect()], np.int64).view(np.uint64)
    return {r.h & (1 << 64) - 1: r.n for r in summed(found).collect()} if len(found) else {}


def model_scores(docs: DataFrame, folds: int = 5, held_out: int = 1, discount: float = DISCOUNT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of each row of docs, by a model of the rows outside the held-out fold.

    Tokens are the bytes between white space, A-Z in lower case, and one end
    each; a null text counts as empty and has the end alone. Rows without an
    id are in no held-out fold, so the model learns from them; each repeated
    row counts. base_score is the add-half unigram's, exact; score is the
    trie's. Without training texts each token has probability 1. Other columns
    aren't read; an empty table gives no rows.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    out = F.coalesce(crc(F.col(id_col)) % folds == held_out, F.lit(False))
    scratch = Scratch(docs.sparkSession)
    made = blocks(docs, lambda x: x.encode().lower().split(), ~out, id_col, text_col, scratch=scratch)
    n_shards, _ = shards(made, EACH)

    def size(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([sum(s for s, c in zip(r["sizes"], r["chosen"]) if c) for r in rows_of(batch)], pa.int64())], ["n"])

    total = made.select("sizes", "chosen").mapInArrow(size, "n long").agg(F.sum("n")).first()[0] or 0
    hot = _hot(made, total)
    keys = np.array(list(hot), np.uint64)
    extra, replies = {"distinct": pa.int64(), "warm": pa.list_(pa.int64()), "after": pa.list_(pa.int64())}, None
    for turn in range(TURNS):
        part = answered(asked(made, lambda row, turn=turn: ask(row, n_shards, keys, turn), ["sizes", "chosen", "words", "data"]), lambda r: answer(r, hot, discount), extra, scratch)
        replies = part if replies is None else replies.union(part)
    distinct = (replies.agg(F.sum("distinct")).first()[0] or 0) + len(hot)
    after = {r.h & (1 << 64) - 1: r.n for r in replies.where("warm is not null").select(F.explode(F.arrays_zip("warm", "after")).alias("x")).groupBy(F.col("x.warm").alias("h")).agg(F.sum("x.after").alias("n")).collect()}
    one = lambda c: (c + 0.5) / (total + 0.5 * (distinct + 1))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in rows_of(batch):
                p = Pairs(row, n_shards, keys)
                b, got = p.block, {r["shard"]: r["reply"] for r in row["replies"]}
                count, back, codes = np.zeros(len(b.words)), np.zeros(len(b.words)), np.zeros(len(p.keys), np.uint16)
                back3, codes3 = np.zeros(len(p.keys), np.uint16), np.zeros(len(p.keys3), np.uint16)
                for shard, part in p.parts:
                    words, _ = p.contexts(part)
                    m, n, low = len(words), len(part), p.below(part)
                    count[words], back_codes, codes[part], back3[part], codes3[low] = unpacked(got[shard], (np.uint64, m), (np.uint16, m), (np.uint16, n), (np.uint16, n), (np.uint16, len(low)))
                    back[words] = decoded(back_codes)
                for i in np.flatnonzero(p.hot):
                    w = int(b.words[i])
                    count[i], back[i] = hot[w], discount * after.get(w, 0) / max(hot[w], 1)
                back[count == 0] = 1.0
                unigram = one(count)
                value = decoded(codes)[p.of] + back[p.before] * unigram[b.tokens]
                value[p.on] = decoded(codes3)[p.of3] + np.where(back3 > 0, decoded(back3), 1.0)[p.context] * value[p.on]
                n = len(b.sizes)
                sums = lambda x: pa.array(np.bincount(b.owner, weights=x, minlength=n))
                arrays = [
                    pa.array(row["ids"], batch.schema.field("ids").type.value_type),
                    pa.array(~np.array(row["chosen"])),
                    pa.array(b.sizes),
                    pa.array(np.bincount(b.owner[count[b.tokens] > 0], minlength=n)),
                    pa.array(np.full(n, total, np.int64)),
                    sums(np.log10(unigram)[b.tokens]),
                    sums(np.log10(np.minimum(value, 1.0))),
                ]
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    schema = f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    scores = []
    for turn in range(TURNS):
        mine = F.pmod(F.xxhash64("block"), F.lit(TURNS)) == turn
        scores.append(scratch.settled(with_replies(made.where(mine).select("block", "ids", "sizes", "chosen", "words", "data"), replies.where(mine).select("shard", "block", "reply")).mapInArrow(score, schema)))
    scratch.keep(*scores)
    return reduce(DataFrame.union, scores)
