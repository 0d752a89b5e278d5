"""Near-duplicate documents by improved consistent weighted sampling over TF-IDF shingles.

Document frequencies of five-word shingles are counted over all documents by
the exchange of blocks and shards. A text of which shingles that no other document
has carry too much weight can't have a link, whatever the other text, and is
done. Each other text gets consistent weighted samples of its shingles; bands
of samples make buckets. Texts in a bucket are compared with its most central
one, whose shingles are the commonest, then with a few others of other
components: a number of pairs in proportion to the bucket, which joins most of a
large group. What then still stands apart from the largest component of its
bucket is a query set against the bucket, in blocks of bounded chunks: by
samples first, then by exact similarities within the task, of which only links
that join components come out, fewer than the chunk has texts. Links count after
the exact weighted Jaccard similarity. Classes are the components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rainledger.llm.blocks import Block, answered, asked, blocks, packed, rows_of, shards, unpacked, with_replies
from rainledger.llm.frames import Scratch, per_batch

#: Words of a shingle, samples of a band, bands. At a similarity of 0.8 a pair misses all bands with a chance of 0.488 ** 12 = 0.0002.
WORDS, ROWS, BANDS = 5, 3, 12
#: Samples that must agree before a pair is compared exactly; of 36, at 0.8, fewer than 18 agree with a chance of 1e-5.
AGREE = 18
#: Texts of a bucket in a chunk at most, on average; bytes of packed shingles in one that is compared exactly.
CHUNK, CHUNK_BYTES = 512, 4 << 20
#: Other texts that each is compared with in the second round.
FEW = 6

_dice = np.random.default_rng(3)
_gamma_r = _dice.gamma(2.0, 1.0, 1 << 16).astype(np.float32)
_log_c = np.log(_dice.gamma(2.0, 1.0, 1 << 16)).astype(np.float32)
_uniform = (np.arange(1 << 16) / (1 << 16)).astype(np.float32)
_seeds = _dice.integers(1, 1 << 63, ROWS * BANDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOW = np.uint64((1 << 40) - 1)
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * _B
    return x ^ (x >> np.uint64(32))


def shingles(block: Block, width: int = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, shingle, times) of each different shingle of each document, by document.

    A text of fewer than width words has one shingle, all of it; a text
    without words the shingle of none.
    """
    h = block.words[block.tokens]
    n = len(h)
    starts = np.cumsum(block.sizes) - block.sizes
    words = block.sizes - 1
    place = np.arange(n) - starts[block.owner]
    left = words[block.owner] - place  # words from here to the document's end
    value = np.full(n, _A)
    for k in range(width):
        shifted = np.append(h[k:], np.zeros(min(k, n), np.uint64))
        value = np.where(left > k, mixed(value * _A + shifted), value)
    begins = (left >= width) | (place == 0)
    owner, value = block.owner[begins], value[begins]
    order = np.argsort((owner.astype(np.uint64) << np.uint64(40)) | (value >> np.uint64(24)))
    owner, value = owner[order], value[order]
    first = np.flatnonzero(np.append(True, (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])))
    return owner[first], value[first], np.diff(np.append(first, len(value)))


def _dealt(value: np.ndarray, n_shards: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[tuple[int, int, int]]]:
    """A block's different shingles as shard and low 40 bits, each value's place among them, how many of its documents have each, and (shard, from, to)."""
    key = (((value >> np.uint64(40)) % np.uint64(n_shards)) << np.uint64(40)) | (value & _LOW)
    keys, of, counts = np.unique(key, return_inverse=True, return_counts=True)
    shard = (keys >> np.uint64(40)).astype(np.int64)
    cuts = np.flatnonzero(np.append(True, shard[1:] != shard[:-1]))
    return keys & _LOW, of, counts, [(int(shard[a]), int(a), int(b)) for a, b in zip(cuts, np.append(cuts[1:], len(keys)))]


def ask(row: dict, n_shards: int) -> Iterator[tuple[int, bytes]]:
    low, _, counts, parts = _dealt(shingles(Block(row))[1], n_shards)
    for shard, a, b in parts:
        yield shard, (b - a).to_bytes(4, "little") + packed(np.diff(low[a:b], prepend=np.uint64(0)), counts[a:b].astype(np.uint32))


def answer(requests: list[bytes]) -> tuple[list[bytes], dict]:
    """Document frequencies of each block's shingles, as logarithms."""
    got = [unpacked(r[4:], (np.uint64, n), (np.uint32, n)) for r in requests for n in [int.from_bytes(r[:4], "little")]]
    keys = [np.cumsum(x) for x, _ in got]
    _, of = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.bincount(of, weights=np.concatenate([n for _, n in got]))[of]
    codes = np.rint(np.log2(total) * 1024).astype(np.uint16)
    ends = np.cumsum([len(x) for x in keys])
    return [packed(codes[e - len(x) : e]) for e, x in zip(ends, keys)], {}


def weighted(row: dict, n_shards: int, n_docs: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, shingle, weight, logarithm of the document frequency) of a block with its replies.

    weight = (1 + ln times) * (1 + ln(documents / document frequency)) ** 0.25. The root keeps the
    common shingles of a large group of copies from counting for much less than
    their few own ones, so a group's size doesn't pull its members apart.
    """
    owner, value, times = shingles(Block(row))
    keys, of, _, parts = _dealt(value, n_shards)
    log_df = np.zeros(len(keys))
    got = {r["shard"]: r["reply"] for r in row["replies"]}
    for shard, a, b in parts:
        log_df[a:b] = unpacked(got[shard], (np.uint16, b - a))[0] / 1024 * np.log(2)
    idf = (1 + np.maximum(np.log(max(n_docs, 1)) - log_df, 0)) ** 0.25
    return owner, value, ((1 + np.log(times)) * idf[of]).astype(np.float32), log_df[of]


def signatures(owner: np.ndarray, value: np.ndarray, weight: np.ndarray, n: int) -> np.ndarray:
    """Samples of each of n documents (rows), as 32-bit hashes of a shingle and its quantised weight."""
    out = np.zeros((n, len(_seeds)), np.uint64)
    starts = np.searchsorted(owner, np.arange(n + 1))
    i = 0
    while i < n:
        j = max(int(np.searchsorted(starts, starts[i] + (1 << 15), "right")) - 1, i + 1)
        x, log_w = value[starts[i] : starts[j]], np.log(weight[starts[i] : starts[j]])
        cuts = starts[i:j] - starts[i]
        for k, seed in enumerate(_seeds):
            h = x * seed
            h ^= h >> np.uint64(32)
            h *= _B
            quarters = h.view(np.uint16).reshape(-1, 4)  # three of them are the dice of r, c and beta
            r, beta = _gamma_r[quarters[:, 3]], _uniform[quarters[:, 2]]
            t = np.floor(log_w / r + beta)
            log_a = _log_c[quarters[:, 1]] - r * (t - beta + np.float32(1))
            bits = (np.float32(1000) + log_a).view(np.uint32).astype(np.uint64)
            bits <<= np.uint64(32)
            h += t.astype(np.int64).view(np.uint64)
            h *= _A
            bits |= h >> np.uint64(32)
            out[i:j, k] = np.minimum.reduceat(bits, cuts)
        i = j
    return out.astype(np.uint32)


def band_keys(signature: np.ndarray) -> np.ndarray:
    """64-bit keys of the bands of each row of samples."""
    x = signature.astype(np.uint64).reshape(len(signature), BANDS, ROWS)
    key = np.arange(BANDS, dtype=np.uint64)[None, :] + np.uint64(1)
    for k in range(ROWS):
        key = mixed(key * _A + x[:, :, k])
    return key.view(np.int64)


def _signature(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, len(_seeds))


def alike(pairs: DataFrame, nodes: DataFrame, agree: int) -> DataFrame:
    """The pairs (a, b) of which enough samples agree."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        same = (_signature(batch.column("sig_a")) == _signature(batch.column("sig_b"))).sum(1)
        return batch.select(["a", "b"]).filter(pa.array(same >= agree))

    sig = nodes.select("node", "sig")
    both = pairs.join(sig.toDF("a", "sig_a"), "a").join(sig.toDF("b", "sig_b"), "b").select("a", "b", "sig_a", "sig_b")
    return per_batch(both, run, "a binary, b binary")


def recorded(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Shingles (rising) and weights of a text, as records makes them."""
    n = int.from_bytes(data[:4], "little")
    x, v = unpacked(data[4:], (np.uint64, n), (np.float32, n))
    return np.cumsum(x), v


def weighted_jaccard(left: bytes, right: bytes) -> float:
    (x, v), (y, w) = recorded(left), recorded(right)
    _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    both = np.minimum(v[i], w[j]).sum(dtype=np.float64)
    return float(both / (v.sum(dtype=np.float64) + w.sum(dtype=np.float64) - both))


def records(value: np.ndarray, weight: np.ndarray) -> bytes:
    return len(value).to_bytes(4, "little") + packed(np.diff(value, prepend=np.uint64(0)), weight)


def linked(pairs: DataFrame, nodes: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) whose texts have a weighted Jaccard similarity of `least` or more."""

    def verify(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [weighted_jaccard(x, y) >= least for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist())]
        return batch.select(["a", "b"]).filter(pa.array(found, pa.bool_()))

    made = nodes.select("node", "shingles")
    both = pairs.join(made.toDF("a", "x"), "a").join(made.toDF("b", "y"), "b").select("a", "b", "x", "y")
    return per_batch(both, verify, "a binary, b binary", 256)


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, root): the smallest node of the component of each node that a link has, by hooking and pointer jumping, each round written."""
    both = scratch.settled(links.select("a", "b").union(links.select(F.col("b"), F.col("a"))).distinct())
    labels = scratch.settled(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("root")))
    written = labels
    while True:
        near = both.join(labels.toDF("b", "root"), "b").groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near"))
        hooked = labels.join(near, "node").select("node", F.least("root", "near").alias("root"), F.col("root").alias("was"))
        jumped = scratch.settled(hooked.join(labels.toDF("root", "further"), "root").select("node", F.least("root", "further").alias("root"), "was"))
        scratch.drop(written)
        labels, written = jumped.select("node", "root"), jumped
        if not jumped.where("root != was").limit(1).count():
            scratch.drop(both)
            return labels


def joined_by(roots: DataFrame, links: DataFrame, scratch: Scratch) -> DataFrame:
    """Components after some more links: those of a graph whose nodes are the components so far."""
    edges = links.join(roots.toDF("a", "ra"), "a", "left").join(roots.toDF("b", "rb"), "b", "left").select(F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b"))
    edges = scratch.settled(edges.where("a != b").distinct())
    if not edges.limit(1).count():
        return roots
    tops = components(edges, scratch)
    old = roots.join(tops.toDF("root", "top"), "root", "left").select("node", F.coalesce("top", "root").alias("root"))
    return scratch.settled(old.union(tops.join(roots, "node", "left_anti")))


def _table(pairs: list[tuple[bytes, bytes]]) -> pa.Table:
    wide = lambda v: v.ljust(16, b"\0")  # noqa: E731  numpy's bytes end before zeros
    return pa.table([pa.array([wide(min(p)) for p in pairs], pa.binary()), pa.array([wide(max(p)) for p in pairs], pa.binary())], ["a", "b"])


def _chunk(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return (*(np.array(table.column(c).to_pylist(), "S16") for c in ("node", "root")), _signature(table.column("sig")))


def some(table: pa.Table, agree: int) -> pa.Table:
    """Each text of a chunk of a bucket with the next FEW of other components, of which enough samples agree."""
    node, root, sig = _chunk(table)
    order = np.argsort(node)  # hashes, so as good as shuffled
    node, root, sig = node[order], root[order], sig[order]
    found = []
    for step in range(1, min(FEW, len(node) - 1) + 1):
        x = np.arange(len(node))
        y = (x + step) % len(node)
        ok = (root[x] != root[y]) & ((sig[x] == sig[y]).sum(1) >= agree)
        found += [(node[i], node[j]) for i, j in zip(x[ok], y[ok])]
    return _table(found)


class Sides:
    """A chunk of a bucket, with the queries that visit it: which texts of the chunk each query is to be compared with.

    A query is a text outside the largest component of its bucket; `home` marks
    the rows of the chunk itself. Two queries meet once, as the smaller one's
    visit; two texts meet in the first bucket that they share.
    """

    def __init__(self, table: pa.Table, agree: int):
        self.node, self.root, self.sig = _chunk(table)
        home, self.query = (table.column(c).to_numpy() for c in ("home", "query"))
        self.chunk, self.agree = np.flatnonzero(home), agree
        self.asking = np.flatnonzero(self.query)
        self.keys = band_keys(self.sig)
        self.turn = int(np.flatnonzero(self.keys[0] == table.column("band")[0].as_py())[0])

    def partners(self, x: int) -> np.ndarray:
        y = self.chunk
        y = y[(self.root[y] != self.root[x]) & (~self.query[y] | (self.node[y] > self.node[x]))]
        y = y[(self.sig[y] == self.sig[x]).sum(1) >= self.agree]
        return y[~(self.keys[y, : self.turn] == self.keys[x, : self.turn]).any(1)]


def doubtful(table: pa.Table, agree: int) -> pa.Table:
    """(band, node) of the texts of a chunk and its queries that samples can't tell apart from one of another component."""
    sides = Sides(table, agree)
    some = np.zeros(len(sides.node), bool)
    for x in sides.asking:
        y = sides.partners(x)
        some[y] = True
        some[x] |= len(y) > 0
    pick = pa.array(some)
    return table.select(["band", "node"]).filter(pick)


def joins(table: pa.Table, agree: int, least: float) -> pa.Table:
    """Links of a chunk and its queries whose exact similarity is `least` or more; of those that join the same components one."""
    sides = Sides(table, agree)
    made = [recorded(x) for x in table.column("shingles").to_pylist()]
    sizes = np.array([len(x) for x, _ in made])
    starts = np.cumsum(sizes) - sizes
    names, index = np.unique(np.concatenate([x for x, _ in made]), return_inverse=True)
    weight = np.concatenate([w for _, w in made])
    total = np.array([w.sum(dtype=np.float64) for _, w in made])
    own = np.zeros(len(names), np.float32)
    top: dict[bytes, bytes] = {}

    def of(r: bytes) -> bytes:
        while r in top:
            r = top[r]
        return r

    found = []
    for x in sides.asking:
        a, b = starts[x], starts[x] + sizes[x]
        own[index[a:b]] = weight[a:b]
        left = sides.partners(x)
        while len(left):
            y, size = left[:64], sizes[left[:64]]
            at = np.arange(size.sum()) + np.repeat(starts[y] - (np.cumsum(size) - size), size)
            both = np.add.reduceat(np.minimum(own[index[at]], weight[at]), np.cumsum(size) - size, dtype=np.float64)
            for z in y[both / (total[x] + total[y] - both) >= least]:
                p, q = of(sides.root[x]), of(sides.root[z])
                if p != q:
                    top[p] = q
                    found.append((sides.node[x], sides.node[z]))
            left = left[64:]
            left = left[[of(r) != of(sides.root[x]) for r in sides.root[left]]] if len(left) else left
        own[index[a:b]] = 0
    return _table(found)


def near_duplicates(docs: DataFrame, least: float = 0.8, agree: int = AGREE, chunk: int = CHUNK, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, class_id, class_size, kept of each row of docs.

    Two texts are linked if the weighted Jaccard similarity of their TF-IDF
    shingles is `least` or more; a class is a component of links, and texts
    with the same words (whatever their case and white space) are of one.
    class_id is the smallest id of the class (null only if all are), kept is
    true for one of its rows, the first by id and place. A null text counts as
    empty; texts without words are one class. Repeated rows and null ids are
    rows of their own. Other columns aren't read; an empty table gives no rows.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    scratch = Scratch(docs.sparkSession)
    settled = scratch.settled
    made = blocks(docs, lambda x: [w.encode() for w in x.lower().split()], None, id_col, text_col, scratch=scratch)
    n_shards, _ = shards(made)
    n_docs = made.agg(F.sum(F.size("sizes"))).first()[0] or 0
    replies = answered(asked(made, lambda row: ask(row, n_shards), ["sizes", "words", "data"]), answer, {}, scratch)
    joined = with_replies(made.drop("chosen"), replies)

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in rows_of(batch):
                n = len(row["sizes"])
                owner, value, weight, log_df = weighted(row, n_shards, n_docs)
                # The similarity with any text is at most the share of the weight that other documents have too.
                total = np.bincount(owner, weights=weight, minlength=n)
                may = np.bincount(owner, weights=weight * (log_df > 0), minlength=n) >= (least - 1e-6) * total
                centre = np.bincount(owner, weights=weight * log_df, minlength=n) / total
                held, firsts = set(), np.zeros(n, bool)
                for i in np.flatnonzero(may):  # of copies in a block, one has samples and shingles
                    firsts[i] = row["keys"][i] not in held
                    held.add(row["keys"][i])
                place, keep = np.cumsum(firsts) - 1, firsts[owner]
                made_of = signatures(place[owner[keep]], value[keep], weight[keep], int(firsts.sum()))
                starts = np.searchsorted(owner, np.arange(n + 1))
                for k in range(0, n, 1024):
                    part = range(k, min(k + 1024, n))
                    arrays = [
                        pa.array(row["ids"][k : k + 1024], batch.schema.field("ids").type.value_type),
                        pa.array(row["keys"][k : k + 1024], pa.binary()),
                        pa.array([row["block"]] * len(part), pa.int64()),
                        pa.array(part, pa.int32()),
                        pa.array([made_of[place[i]].tobytes() if firsts[i] else None for i in part], pa.binary()),
                        pa.array(centre[k : k + 1024]),
                        pa.array([records(value[starts[i] : starts[i + 1]], weight[starts[i] : starts[i + 1]]) if firsts[i] else None for i in part], pa.binary()),
                    ]
                    yield pa.RecordBatch.from_arrays(arrays, ["id", "node", "block", "seq", "sig", "centre", "shingles"])

    wide = settled(joined.mapInArrow(sample, f"id {kind}, node binary, block long, seq int, sig binary, centre double, shingles binary"))
    scratch.drop(made, replies)
    rows = settled(wide.select("id", "node", "block", "seq"))
    one = F.min_by(F.struct("sig", "centre", "shingles"), F.struct("block", "seq"))
    nodes = settled(wide.where("sig IS NOT NULL").groupBy("node").agg(one.alias("x")).select("node", "x.*"))
    scratch.drop(wide)

    def spread(batch: pa.RecordBatch) -> pa.RecordBatch:
        keys = band_keys(_signature(batch.column("sig")))
        whose = pa.array(np.repeat(np.arange(batch.num_rows), BANDS))
        return pa.RecordBatch.from_arrays([pa.array(keys.reshape(-1)), batch.column("node").take(whose), batch.column("centre").take(whose)], ["band", "node", "centre"])

    bands = settled(per_batch(nodes.select("node", "sig", "centre"), spread, "band long, node binary, centre double"))
    hubs = settled(bands.groupBy("band").agg(F.max(F.struct("centre", "node"))["node"].alias("hub"), F.count("*").alias("n")).where("n > 1"))
    members = settled(bands.join(hubs, "band").select("band", "node", "hub", "n"))
    stars = members.where("node != hub").select(F.least("hub", "node").alias("a"), F.greatest("hub", "node").alias("b")).distinct()
    links = settled(linked(settled(alike(stars, nodes, agree)), nodes, least))
    roots = components(links, scratch)

    several = members.where("n > 2")  # a bucket of two is done
    sig = nodes.select("node", "sig")

    def apart() -> DataFrame:
        """Members of buckets that still hold several components, and the largest one's root."""
        held = settled(several.join(roots, "node", "left").select("band", "node", "n", F.coalesce("root", "node").alias("root")))
        each = held.groupBy("band", "root").agg(F.count("*").alias("k")).groupBy("band").agg(F.max(F.struct("k", "root"))["root"].alias("main"), F.count("*").alias("kinds"))
        found = settled(held.join(settled(each.where("kinds > 1").select("band", "main")), "band"))
        scratch.drop(held)
        return found

    def in_chunks(held: DataFrame, parts: Column) -> DataFrame:
        """Each member at home in its chunk; those outside the largest component visit the others too, as queries."""
        held = held.withColumn("parts", parts).withColumn("own", F.pmod(F.xxhash64("node", "band"), F.col("parts"))).withColumn("query", F.col("root") != F.col("main"))
        to = F.when(F.col("query"), F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).otherwise(F.array("own"))
        return held.select("band", "node", "root", "own", "query", F.explode(to).alias("part")).withColumn("home", F.col("own") == F.col("part"))

    dealt, by_count = apart(), F.expr(f"(n - 1) div {chunk} + 1")
    parted = dealt.withColumn("parts", by_count).withColumn("part", F.pmod(F.xxhash64("node", "band"), F.col("parts")))
    few = parted.join(sig, "node").select("band", "part", "node", "root", "sig").groupBy("band", "part").applyInArrow(lambda t: some(t, agree), "a binary, b binary").distinct()
    roots = joined_by(roots, settled(linked(settled(few), nodes, least)), scratch)
    dealt = apart()
    asked_of = in_chunks(dealt, by_count).join(sig, "node").groupBy("band", "part").applyInArrow(lambda t: doubtful(t, agree), "band long, node binary")
    left = settled(dealt.join(asked_of.distinct(), ["band", "node"], "left_semi").join(nodes.select("node", F.length("shingles").cast("long").alias("size")), "node"))
    weight = left.groupBy("band").agg(F.count("*").alias("n"), F.sum("size").alias("size"))
    left = left.drop("n", "size").join(settled(weight), "band")
    parts = F.greatest(by_count, F.expr(f"(size - 1) div {CHUNK_BYTES} + 1"))
    last = in_chunks(left, parts).join(nodes.select("node", "sig", "shingles"), "node").groupBy("band", "part").applyInArrow(lambda t: joins(t, agree, least), "a binary, b binary")
    roots = joined_by(roots, settled(last.distinct()), scratch)
    classed = settled(rows.join(roots, "node", "left").select("id", "block", "seq", F.coalesce("root", "node").alias("root")))
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "block", "seq"))
    heads = settled(classed.groupBy("root").agg(first.alias("h"), F.count("*").alias("class_size")))  # written, so that Spark can split a large class in the join
    scratch.keep(classed, heads)
    kept = (F.col("block") == F.col("h.block")) & (F.col("seq") == F.col("h.seq"))
    return classed.join(heads, "root").select(F.col("id").alias("doc_id"), F.col("h.id").alias("class_id"), "class_size", kept.alias("kept"))
