"""Language model scores: an interpolated modified Kneser-Ney model of word n-grams (``order`` 2 or 3), counted and applied in shards.

Tokens are words between blanks, A-Z lower-cased, and one end for each text; the first token follows a start.  The highest order is
discounted by its counts, the lower ones by continuation counts (in how many different contexts an n-gram was seen; its count where it
begins with the start), each with three discounts (for one, two, and three or more) estimated from the counts of counts.
What is freed goes to the next lower order, and from single words to all words alike, an unknown one among them.

Words are 64-bit hashes of which the whole corpus has shown that no two words share one; otherwise another seed is taken.  That count of
words also tells how many tokens there are and which words are frequent: a list of at most ``FREQUENT``.

No worker holds the model.  Map tasks reduce blocks of documents to their distinct n-grams and, for each, the
documents it stands in.  An n-gram ``u v w`` goes to the shard of its middle word ``v`` (of its first word, without ``u``), and once: there stand
all that shares the context ``u v``, all contexts of ``v w``, and all that follows ``v``.  A frequent ``v`` that alone would fill a part of
a shard is dealt to all shards by ``w`` as well; its contexts are then known in parts.  What a shard lacks (continuations and counts of
words, sums of divided contexts) is added up by key in a second, smaller exchange and returned to the shards that asked.  Then a shard's
n-grams are written as sorted hash arrays, memory-mapped, and the blocks' n-grams looked up; sums by document go back to the block.

Counting and scoring read the dealt n-grams from one shuffle: the second job skips its map stage, and what it needs from the second exchange
is dealt by the same partitioner, so both meet in a task without moving the n-grams again.  If an executor is lost, Spark
computes its part anew.  A payload holds at least one n-gram, so there are never more payloads than distinct n-grams of blocks.

Defined cases: a null or empty text, or one of blanks, is its end token alone; ``doc_id`` is a whole number or null, and a null one counts as a
training row where the caller's rule (``train``) is null; repeated rows are counted and scored one by one; without training rows every
token has the probability of an unknown one; an empty table gives an empty result; other columns of the input, whatever their names,
take no part; texts longer than a block are cut into blocks that know the words before them, and their sums are added.
"""

from __future__ import annotations

import ctypes
import os
import pickle
import tempfile
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendmart.llm.bpe import slices
from lendmart.llm.texts import stage

NOTHING, START, END = 0, 1, 2  # hashes of no word, and numbers of no word in a block
NO_ID = -(1 << 63)  # stands for a null doc_id
ORDER, BLOCK_TOKENS, SHARD_TOKENS, HOT_SHARE, FREQUENT = 3, 3_000_000, 2_000_000, 8, 1 << 18
WORDS_AT_ONCE = 1 << 19
PIECE = 1 << 14  # bytes of a payload that travel together
SEEDS = (0, 1, 2)


def give_back() -> None:
    """Return freed memory to the system: workers are reused, and what they keep counts against their executor."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


# ---- compact payloads

def small(a: np.ndarray) -> np.ndarray:
    """The same whole numbers in the least wide unsigned type."""
    return a.astype(np.min_scalar_type(int(a.max())) if len(a) else np.uint8)


def spread_bytes(a: np.ndarray) -> np.ndarray:
    """First bytes first: alike bytes stand together."""
    return np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.itemsize).T)


def packed(*parts) -> bytes:
    """Arrays of one dimension and other values in a compressed payload."""
    plain = [("a", x.dtype.str, spread_bytes(x)) if isinstance(x, np.ndarray) and x.ndim == 1 else ("v", x) for x in parts]
    raw = pickle.dumps(plain, 5)
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def unpacked(payload: bytes) -> list:
    raw = pa.decompress(payload[8:], decompressed_size=int.from_bytes(payload[:8], "little"), codec="zstd", asbytes=True)
    return [np.ascontiguousarray(x[2].T).reshape(-1).view(x[1]) if x[0] == "a" else x[1] for x in pickle.loads(raw)]


def steps(ascending: np.ndarray) -> np.ndarray:
    """Differences of ascending hashes: shorter numbers than the hashes."""
    return np.diff(ascending, prepend=np.uint64(0))


def mix(v: np.ndarray, w: np.ndarray, seed: int = 0) -> np.ndarray:
    """One 64-bit hash of two."""
    x = (v * np.uint64(0x9E3779B97F4A7C15 + 2 * seed)) ^ (w + np.uint64(0x632BE59BD9B4E019))
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def word_hashes(words: Iterable[bytes], seed: int) -> np.ndarray:
    out = np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in words), np.uint64)
    out[out < 3] += np.uint64(3)
    return out


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()


# ---- words

def count_words(seed: int, buckets: int, hashes_of=word_hashes):
    """Rows ``bucket, payload`` of the words of many texts and how often they stand there, by their hashes; the end of texts is no word yet."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made() -> pa.RecordBatch:
            words, n = np.array(list(count), object), np.fromiter(count.values(), np.int64)
            bucket = (hashes_of(words, seed) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
            payloads = [packed(b" ".join(words[order[x:y]]), small(n[order[x:y]]), ends if k == 0 else 0) for k, (x, y) in enumerate(zip(cuts, cuts[1:]))]
            return pa.RecordBatch.from_pydict({"bucket": pa.array(range(buckets), pa.int32()), "payload": pa.array(payloads, pa.binary())})

        count: Counter = Counter()
        ends = 0
        for batch in (part for whole in batches for part in slices(whole, "text")):
            for text in batch.column("text"):
                count.update(words_of(text.as_py()))
                ends += 1
            if len(count) > WORDS_AT_ONCE:
                yield made()
                count, ends = Counter(), 0
        if ends:
            yield made()
        del count
        give_back()
    return rows


def merge_words(seed: int, listed: int, hashes_of=word_hashes):
    """From the payloads of a bucket, which has every word of its hashes: rows ``kind, hash, n``.

    Kind 0: tokens; kind 1: words that share a hash; kind 2: the ``listed`` most frequent words.
    """
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count: Counter = Counter()
        ends = 0
        for batch in batches:
            for payload in batch.column("payload"):
                words, n, more = unpacked(payload.as_py())
                ends += more
                for w, k in zip(words.split(), n.tolist()):
                    count[w] += k
        n, hashes = np.fromiter(count.values(), np.int64), hashes_of(list(count), seed)
        shared = len(hashes) - len(np.unique(hashes))
        top = np.lexsort((hashes, -n))[:listed]
        kinds = np.array([0, 1, 2] + [2] * len(top), np.int32)
        yield pa.RecordBatch.from_arrays([
            pa.array(kinds), pa.array(np.concatenate([np.array([0, 0, END], np.uint64), hashes[top]]).view(np.int64)),
            pa.array(np.concatenate([[int(n.sum()) + ends, shared, ends], n[top]]))], ["kind", "hash", "n"])
    return rows


def vocabulary(texts: DataFrame, frequent: int = FREQUENT, seeds=SEEDS, hashes_of=word_hashes) -> tuple[int, int, list]:
    """How many tokens there are, the seed under which no two words share a hash, and ``hash, n`` of at most ``frequent`` words."""
    buckets = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    for seed in seeds:
        dealt = texts.select("text").mapInArrow(count_words(seed, buckets, hashes_of), "bucket int, payload binary").repartitionById(buckets, "bucket")
        listed = max(16, -(-frequent // buckets))
        counted = stage(dealt.mapInArrow(merge_words(seed, listed, hashes_of), "kind int, hash long, n long"), "words")
        tokens, shared = counted.agg(F.sum(F.when(F.col("kind") == 0, F.col("n"))), F.sum(F.when(F.col("kind") == 1, F.col("n")))).first()
        if not shared:
            top = counted.where("kind = 2 AND n > 0").groupBy("hash").agg(F.sum("n").alias("n")).orderBy(F.col("n").desc(), "hash").limit(frequent)
            return tokens or 0, seed, top.collect()
    raise ValueError("under every seed two words of this corpus share a hash")


class Dealing:
    """What all tasks know: the seed, the most frequent words, and which of them are divided among shards."""

    def __init__(self, order: int, shards: int, seed: int, frequent: np.ndarray, hot: np.ndarray):
        self.order, self.shards, self.seed, self.frequent = order, shards, seed, np.sort(frequent)
        self.hot = np.sort(np.append(hot, np.uint64(START)))

    def shard_of(self, v: np.ndarray, w: np.ndarray) -> np.ndarray:
        by = v.copy()
        divided = np.isin(by, self.hot)
        by[divided] = mix(by[divided], w[divided])
        return (by % np.uint64(self.shards)).astype(np.int64)

    def place(self, hashes: np.ndarray) -> np.ndarray:
        """Place of each hash among the frequent ones, -1 if it is not there."""
        if not len(self.frequent):
            return np.full(len(hashes), -1, np.int64)
        at = np.minimum(np.searchsorted(self.frequent, hashes), len(self.frequent) - 1)
        return np.where(self.frequent[at] == hashes, at, -1)


# ---- map side: documents to n-grams by shard

def numbers() -> defaultdict:
    """Words by the order in which they first come; the first three numbers are of no words."""
    known: defaultdict = defaultdict()
    known.default_factory = known.__len__
    known.update({NOTHING: NOTHING, START: START, END: END})
    return known


class Block:
    """Documents of one map task up to some number of tokens, as numbers of the block's own vocabulary."""

    def __init__(self, key: int):
        self.key, self.vocabulary = key, numbers()
        self.tokens: list[np.ndarray] = []
        self.before: list[tuple[int, int]] = []
        self.rows: list[tuple[int, int, bool]] = []
        self.size = 0

    def add(self, row: tuple[int, int, bool], words: list[bytes], before: list[bytes], last: bool) -> None:
        """``words`` of a document, after the words ``before`` them (none: the start), with the end if they are its ``last``."""
        number = self.vocabulary.__getitem__
        ids = np.fromiter(map(number, words), np.int32, len(words))
        earlier = [NOTHING, START, *map(number, before)][-2:]
        self.before.append((earlier[0], earlier[1]))
        self.tokens.append(np.append(ids, np.int32(END)) if last else ids)
        self.rows.append(row)
        self.size += len(self.tokens[-1])

    def dealt(self, how: Dealing) -> Iterator[tuple[int, bytes]]:
        """A payload for every shard that gets n-grams; the first of them also has the documents' rows."""
        hashes = np.concatenate([np.array([NOTHING, START, END], np.uint64), word_hashes(islice(self.vocabulary, 3, None), how.seed)])
        self.vocabulary = numbers()
        lengths = np.array([len(t) for t in self.tokens])
        w = np.concatenate(self.tokens)
        self.tokens = []
        before = np.array(self.before, np.int32)
        starts = np.cumsum(lengths) - lengths
        some = lengths > 0
        v, u = np.empty_like(w), np.empty_like(w)
        v[1:], u[2:] = w[:-1], w[:-2]
        second = starts[lengths > 1] + 1
        u[second] = before[lengths > 1, 1]
        v[starts[some]], u[starts[some]] = before[some, 1], before[some, 0]
        if how.order == 2:
            u[:] = NOTHING
        place = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)
        # Tokens in the order of their n-grams, and in it of their documents.
        size = len(hashes)
        if size ** 3 < 1 << 62:
            order = np.argsort((v.astype(np.int64) * size + u) * size + w)
        else:
            order = np.lexsort((w, u, v))
        u, v, w, place = u[order], v[order], w[order], place[order]
        new = np.append(True, (v[1:] != v[:-1]) | (u[1:] != u[:-1]) | (w[1:] != w[:-1]))
        gram = np.cumsum(new) - 1
        # Documents in their order, where an n-gram stands more than once.
        several = np.flatnonzero(~new | np.append(~new[1:], False))
        place[several] = place[several[np.argsort(gram[several] * len(lengths) + place[several])]]
        other = new | np.append(True, place[1:] != place[:-1])
        at = np.flatnonzero(other)
        times, doc = np.diff(np.append(at, len(w))), place[at]
        gram = gram[at]                          # n-gram of each (n-gram, document)
        first = np.flatnonzero(new)
        u, v, w = u[first], v[first], w[first]
        n = np.bincount(gram, minlength=len(u))
        begin = np.cumsum(n) - n
        times = small(times)
        del order, place, new, several, other, at, gram, first
        shard = how.shard_of(hashes[v], hashes[w])
        by_shard = np.argsort(shard, kind="stable")
        cuts = np.searchsorted(shard[by_shard], np.arange(how.shards + 1))
        del shard
        rows = np.array([r[:2] for r in self.rows], np.int64)
        train = np.packbits([r[2] for r in self.rows])
        frequent = how.place(hashes)
        # Words by their number in a payload: frequent ones by place, then the others by hash.
        rank = np.lexsort((hashes, frequent, frequent < 0))
        ranked = np.empty(len(hashes), np.int32)
        ranked[rank] = np.arange(len(hashes))
        u, v, w = ranked[u], ranked[v], ranked[w]
        is_used, number = np.zeros(len(hashes), bool), np.empty(len(hashes), np.int32)
        for s in np.flatnonzero(np.diff(cuts)):
            own = by_shard[cuts[s]:cuts[s + 1]]
            named = np.concatenate([u[own], v[own], w[own]])
            is_used[:] = False
            is_used[named] = True
            used = np.flatnonzero(is_used)
            number[used] = np.arange(len(used))
            local, k, names = number[named], len(own), rank[used]
            common = int((frequent[names] >= 0).sum())
            entries = np.repeat(begin[own] - np.append(0, np.cumsum(n[own])[:-1]), n[own]) + np.arange(int(n[own].sum()))
            yield int(s), packed(
                self.key, rows, small(frequent[names[:common]]), steps(hashes[names[common:]]), small(local[:k]), small(np.diff(local[k:2 * k].astype(np.int64), prepend=0) % (1 << 32)),
                small(local[2 * k:]), small(n[own]), small(doc[entries]), small(times[entries]), train)
            rows = None


def deal(how: Dealing, block_tokens: int):
    """Rows ``row, doc_id, train, text`` to rows ``shard, block, payload``; ``row`` is unique to an input row."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(block: Block) -> Iterator[pa.RecordBatch]:
            for s, payload in block.dealt(how):
                yield pa.RecordBatch.from_pydict({"shard": pa.array([s], pa.int32()), "block": pa.array([block.key]), "payload": pa.array([payload], pa.binary())})

        block = Block(TaskContext.get().partitionId() << 32)
        for batch in batches:
            for *row, text in zip(*(batch.column(c) for c in ("row", "doc_id", "train", "text"))):
                row, doc_id, train = (x.as_py() for x in row)
                row = (row, NO_ID if doc_id is None else doc_id, train)
                words, at = words_of(text.as_py()), 0
                while True:
                    part = words[at:at + block_tokens - block.size]
                    block.add(row, part, words[max(0, at - 2):at], at + len(part) == len(words))
                    at += len(part)
                    done = at == len(words)
                    if block.size >= block_tokens:
                        yield from out(block)
                        block = Block(block.key + 1)
                        give_back()
                    if done:
                        break
        if block.size:
            yield from out(block)
        del block
        give_back()
    return rows


# ---- a shard

def words_and_grams(parts: list, how: Dealing) -> tuple:
    """Of an unpacked payload: hashes of its words, and the numbers among them of ``u``, ``v`` and ``w``."""
    _, _, common, rare, u, v, w, *_ = parts
    v = np.cumsum(v.astype(np.int64)) & ((1 << 32) - 1)
    return np.concatenate([how.frequent[common.astype(np.int64)], np.cumsum(rare, dtype=np.uint64)]), u, v, w


def numbered(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows of the keys in their order, as one row of ``keys`` each, and the number of every row among them."""
    size = 1
    for k in keys:
        size *= int(k.max(initial=0)) + 1
    if size < 1 << 62:
        code = np.zeros(len(keys[0]), np.int64)
        for k in keys:
            code = code * (int(k.max(initial=0)) + 1) + k
        order = np.argsort(code)
        code = code[order]
        new = np.append(True, code[1:] != code[:-1])[:len(code)]
    else:
        order = np.lexsort(keys[::-1])
        new = np.append(True, np.any([k[order][1:] != k[order][:-1] for k in keys], axis=0))[:len(order)]
    at = np.empty(len(order), np.int32)
    at[order] = np.cumsum(new) - 1
    return order[new], at


def runs(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Like ``numbered``, for keys that are in order already."""
    new = np.ones(len(keys[0]), bool)
    new[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
    return np.flatnonzero(new), (np.cumsum(new) - 1).astype(np.int32)


def kinds(at: np.ndarray, counts: np.ndarray, n: int) -> np.ndarray:
    """For each of ``n`` groups the sum of counts and how many are one, two, and more."""
    return np.array([np.bincount(at, x, n) for x in (counts, counts == 1, counts == 2, counts > 2)])


class Shard:
    """The distinct n-grams of a shard with their training counts, their pairs ``v w``, and both kinds of contexts."""

    def __init__(self, payloads: list[bytes], how: Dealing):
        tables, grams = [], []
        for p in payloads:
            parts = unpacked(p)
            words, u, v, w = words_and_grams(parts, how)
            n, doc, times, train = parts[7:]
            seen = np.unpackbits(train)[doc] * times.astype(np.int64)
            tables.append(words)
            grams.append((u, v, w, np.add.reduceat(seen, np.cumsum(n, dtype=np.int64) - n)))
        self.hashes, at = np.unique(np.concatenate(tables), return_inverse=True)
        at = at.astype(np.int32)
        ends = np.cumsum([len(t) for t in tables])
        to = [at[e - len(t):e] for e, t in zip(ends, tables)]
        u, v, w = (np.concatenate([t[g[k]] for t, g in zip(to, grams)]) for k in range(3))
        c = np.concatenate([g[3] for g in grams])
        del tables, grams, at, to
        first, at = numbered(v, u, w)
        self.c = np.bincount(at, c, len(first)).astype(np.int64)
        self.u, self.v, self.w = u[first], v[first], w[first]
        del u, v, w, c, at
        # Pairs: in how many contexts they were seen; the count itself where they are the highest order or begin a text.
        first, self.pair = numbered(self.v, self.w)
        self.pair_v, self.pair_w = self.v[first], self.w[first]
        count = np.bincount(self.pair, self.c, len(first)).astype(np.int64)
        starts = self.hashes[self.pair_v] == START
        self.seen = count if how.order == 2 else np.where(starts, count, np.bincount(self.pair, self.c > 0, len(first)).astype(np.int64))
        first, self.context = runs(self.v, self.u)
        self.context_v, self.context_u = self.v[first], self.u[first]
        self.sums3 = kinds(self.context, self.c, len(first))
        first, self.lower = runs(self.pair_v)
        self.lower_v = self.pair_v[first]
        self.sums2 = kinds(self.lower, self.seen, len(first))
        first, self.word = numbered(self.pair_w)
        self.words = self.hashes[self.pair_w[first]]
        self.word_seen = np.bincount(self.word, self.seen > 0, len(first)).astype(np.int64)
        self.word_count = np.bincount(self.word, count, len(first)).astype(np.int64)

    def divided(self, how: Dealing) -> list[tuple]:
        """Contexts that other shards have parts of: places, ``v``, ``u`` and sums of those ``u v``, then the same of those ``v`` (``u`` is no word)."""
        out = []
        for v, u, sums in ((self.context_v, self.context_u, self.sums3), (self.lower_v, None, self.sums2)):
            at = np.flatnonzero(np.isin(self.hashes[v], how.hot))
            u = np.full(len(at), np.uint64((1 << 64) - 1)) if u is None else self.hashes[u[at]]
            out.append((at, self.hashes[v[at]], u, sums[:, at].astype(np.int64)))
        return out

    def requests(self, how: Dealing) -> Iterator[tuple]:
        """For each shard that adds up: what is asked of it, as places here and as a payload."""
        word_to = (self.words % np.uint64(how.shards)).astype(np.int64)
        parts = self.divided(how)
        v, u = np.concatenate([p[1] for p in parts]), np.concatenate([p[2] for p in parts])
        sums = np.concatenate([p[3] for p in parts], axis=1)
        key_to = (mix(v, u) % np.uint64(how.shards)).astype(np.int64)
        for to in range(how.shards):
            own, keys = np.flatnonzero(word_to == to), np.flatnonzero(key_to == to)
            if len(own) or len(keys):
                yield to, own, keys, lambda own=own, keys=keys: packed(
                    steps(self.words[own]), small(self.word_seen[own]), small(self.word_count[own]), v[keys], u[keys], *(small(s[keys]) for s in sums))


def counts_of_counts(c: np.ndarray) -> list[int]:
    return [int((c == k).sum()) for k in (1, 2, 3, 4)]


def counted(how: Dealing):
    """From a shard: requests ``to, shard, payload``; counts of counts to be added up, under ``to`` -1."""
    def rows(partition: Iterable) -> Iterator[tuple]:
        for number, payloads, _ in whole(partition):
            shard = Shard(list(payloads.values()), how)
            for to, _, _, payload in shard.requests(how):
                yield to, number, payload(), None
            yield -1, number, None, counts_of_counts(shard.c) + counts_of_counts(shard.seen)
            del shard, payloads
            give_back()
    return rows


def by_first(rows: Iterable) -> Iterator[tuple[int, list]]:
    """The rows of a partition by their first field; a partition holds few shards, each of bounded size."""
    found: dict[int, list] = {}
    for key, value in rows:
        found.setdefault(key, []).append(value)
    for key in sorted(found):
        yield key, found.pop(key)


def pieces(kind: int):
    """Rows ``shard, number, payload`` to pairs of the shard and pieces, so that no buffer on the way holds many whole payloads."""
    def pairs(row) -> Iterator[tuple]:
        shard, number, payload = row
        for at in range(0, len(payload), PIECE):
            yield shard, (kind, number, at, bytes(payload[at:at + PIECE]))
    return pairs


def whole(partition: Iterable) -> Iterator[tuple[int, dict, dict]]:
    """From pieces: for each shard its payloads by block (kind 0) and its answers by the shard that gave them (kind 1)."""
    for shard, found in by_first(partition):
        parts: tuple[dict, dict] = ({}, {})
        for kind, number, at, piece in found:
            parts[kind].setdefault(number, []).append((at, piece))
        found.clear()
        for of in parts:
            for number in of:
                of[number] = b"".join(piece for _, piece in sorted(of[number]))
        yield shard, *parts


def answered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From the requests to a shard: totals for each shard that asked, in its order; numbers to be added up, under ``shard`` -1."""
    def row(shard, to, payload, numbers) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"shard": pa.array([shard], pa.int32()), "to": pa.array([to], pa.int32()),
                                           "payload": pa.array([payload], pa.binary()), "numbers": pa.array([numbers], pa.list_(pa.int64()))})

    rows = ((to, (shard, p)) for b in batches for to, shard, p in zip(*(b.column(c).to_pylist() for c in ("to", "shard", "payload"))))
    for to, requests in by_first(rows):
        asked = [(shard, *unpacked(p)) for shard, p in requests]
        words, at = np.unique(np.concatenate([np.cumsum(r[1], dtype=np.uint64) for r in asked]), return_inverse=True)
        seen, count = (np.bincount(at, np.concatenate([r[k] for r in asked]), len(words)).astype(np.int64) for k in (2, 3))
        first, key = numbered(*(np.unique(np.concatenate([r[k] for r in asked]), return_inverse=True)[1] for k in (4, 5)))
        sums = [np.bincount(key, np.concatenate([r[k] for r in asked]), len(first)).astype(np.int64) for k in (6, 7, 8, 9)]
        yield row(-1, to, None, counts_of_counts(seen) + [int(x.sum()) for x in (seen > 2, seen, count > 0, count)])
        a = b = 0
        for r in asked:
            own, keys = at[a:a + len(r[1])], key[b:b + len(r[4])]
            a, b = a + len(own), b + len(keys)
            yield row(r[0], to, packed(small(seen[own]), small(count[own]), *(small(s[keys]) for s in sums)), None)


def discounts(n: list[int]) -> np.ndarray:
    """For counts of 0, 1, 2 and more, from the numbers of counts 1 to 4."""
    y = n[0] / (n[0] + 2 * n[1]) if n[0] and n[1] else 0.5
    d = [0.0]
    for k in (1, 2, 3):
        ratio = n[k] / n[k - 1] if n[k - 1] else 0.5
        d.append(min(max(k - (k + 1) * y * ratio, 0.05), k - 0.05))
    return np.array(d)


def interpolated(count: np.ndarray, of: np.ndarray, sums: np.ndarray, lower: np.ndarray, d: np.ndarray) -> np.ndarray:
    """Discounted shares of contexts ``of``, and what is left of them for ``lower``."""
    whole = np.maximum(sums[0], 1)
    left = np.where(sums[0] > 0, (d[1:] @ sums[1:]) / whole, 1.0)
    return np.maximum(count - d[np.minimum(count, 3)], 0) / whole[of] + left[of] * lower


def scored(how: Dealing, gram_numbers: list[int], word_numbers: list[int]):
    """From a shard's payloads, and after them its answers: sums for the documents of each block."""
    d3, d2, d1 = discounts(gram_numbers[:4]), discounts(gram_numbers[4:]), discounts(word_numbers[:4])
    n1, n2, more, total_seen, size, total = word_numbers[0], word_numbers[1], *word_numbers[4:]

    def rows(partition: Iterable) -> Iterator[tuple]:
        for _, payloads, answers in whole(partition):
            payloads = list(payloads.values())
            shard = Shard(payloads, how)
            word_seen, word_count = np.zeros(len(shard.words), np.int64), np.zeros(len(shard.words), np.int64)
            parts = shard.divided(how)
            sums = np.concatenate([p[3] for p in parts], axis=1)
            for to, own, keys, _ in shard.requests(how):
                word_seen[own], word_count[own], *totals = unpacked(answers.pop(to))
                sums[:, keys] = totals
            shard.sums3[:, parts[0][0]] = sums[:, :len(parts[0][0])]
            shard.sums2[:, parts[1][0]] = sums[:, len(parts[0][0]):]
            free = (d1[1] * n1 + d1[2] * n2 + d1[3] * more) / total_seen if total_seen else 1.0
            one = np.maximum(word_seen - d1[np.minimum(word_seen, 3)], 0) / max(total_seen, 1) + free / (size + 1)
            base = np.log10((word_count + 1) / (total + size + 1))
            word_of = shard.word[shard.pair].astype(np.int32)
            p = interpolated(shard.seen, shard.lower, shard.sums2, one[shard.word], d2)[shard.pair]
            if how.order == 3:
                p = interpolated(shard.c, shard.context, shard.sums3, p, d3)
            grams = [shard.hashes[x] for x in (shard.u, shard.v, shard.w)]
            known = word_count > 0
            del shard, word_seen, word_count, one, sums, parts, answers
            yield from looked_up(grams, np.log10(p), word_of, base, known, payloads, how)
            del grams, p, word_of, base, known, payloads
            give_back()
    return rows


def gram_keys(u: np.ndarray, v: np.ndarray, w: np.ndarray, seed: int) -> np.ndarray:
    return mix(mix(v, w, seed), u, seed)


def find(keys: np.ndarray, index: np.ndarray, shift: int, wanted: np.ndarray) -> np.ndarray:
    """Places of keys that are there in a sorted array of hashes; ``index`` has where each leading part begins."""
    at = index[(wanted >> np.uint64(shift)).astype(np.int64)]
    late = np.flatnonzero(keys[at] < wanted)
    while len(late):
        at[late] += 1
        late = late[keys[at[late]] < wanted[late]]
    return at


def looked_up(grams: list[np.ndarray], score: np.ndarray, word: np.ndarray, base: np.ndarray, known: np.ndarray, payloads: list[bytes],
              how: Dealing) -> Iterator[tuple[int, bytes]]:
    """The shard's model as sorted hash arrays in memory-mapped files, and sums over the n-grams of each payload.

    An n-gram has its score and the number of its last word, a word its ``base`` score and whether it is ``known``.
    """
    for seed in range(64):
        keys = gram_keys(*grams, seed)
        order = np.argsort(keys)
        keys = keys[order]
        if not (keys[1:] == keys[:-1]).any():  # no two n-grams share a key
            break
    else:
        raise ValueError("under every seed two n-grams of a shard share a key")
    with tempfile.TemporaryDirectory() as folder:
        files = [os.path.join(folder, f"{name}.npy") for name in ("keys", "scores", "words")]
        for path, values in zip(files, (keys, score[order], word[order])):
            np.save(path, values)
        del keys, values, order, score, word
        grams.clear()
        keys, scores, last = (np.load(path, mmap_mode="r") for path in files)
        bits = max(1, len(keys).bit_length())
        shift = 64 - bits
        index = np.searchsorted(keys, np.arange(1 << bits, dtype=np.uint64) << np.uint64(shift)).astype(np.int32)
        for p in payloads:
            parts = unpacked(p)
            block, rows = parts[:2]
            words, u, v, w = words_and_grams(parts, how)
            n, doc, times, _ = parts[7:]
            at = find(keys, index, shift, gram_keys(words[u], words[v], words[w], seed))
            own, of = scores[at], last[at]
            entry, times = np.repeat(np.arange(len(n)), n), times.astype(np.float64)
            tokens, *sums = (np.bincount(doc, times if x is None else times * x[entry]) for x in (None, known[of], base[of], own))
            docs = np.flatnonzero(tokens)
            n_known, n_base, n_score = (x[docs] for x in sums)
            yield block, packed(rows, small(docs), small(tokens[docs].astype(np.int64)), small(n_known.astype(np.int64)), n_base, n_score)
        del keys, scores, last


def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sums of blocks from all shards, added up by document; a partition holds few blocks."""
    rows: dict[int, np.ndarray] = {}
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, payload in zip(batch.column("block").to_pylist(), batch.column("payload").to_pylist()):
            own, docs, *parts = unpacked(payload)
            if own is not None:
                rows[block] = own
            whole = sums.get(block, np.zeros((4, 0)))
            if (more := int(docs[-1]) + 1 - whole.shape[1]) > 0:
                whole = np.pad(whole, ((0, 0), (0, more)))
            for total, part in zip(whole, parts):
                total[docs] += part
            sums[block] = whole
    for block, own in rows.items():
        # A part of a text without words and end has no sums.
        tokens, known, base, score = np.pad(sums[block], ((0, 0), (0, len(own) - sums[block].shape[1])))
        yield pa.RecordBatch.from_arrays([
            pa.array(own[:, 0]), pa.array(own[:, 1]), pa.array(tokens.astype(np.int64)), pa.array(known.astype(np.int64)), pa.array(base), pa.array(score),
        ], ["row", "doc_id", "n_tokens", "n_known", "base_score", "score"])


def place(shard: int) -> int:
    """The partition of a shard; one function, so that both sides have equal partitioners."""
    return shard


def score_documents(docs: DataFrame, train: Column, order: int = ORDER, block_tokens: int = BLOCK_TOKENS, shard_tokens: int = SHARD_TOKENS,
                    frequent: int = FREQUENT) -> DataFrame:
    """``doc_id, n_tokens, n_known, train_tokens, base_score, score`` of every row; rows where ``train`` holds are learned from.

    ``base_score`` is the score of single words with one added to every count.
    """
    if order not in (2, 3):
        raise ValueError("the order is 2 or 3")
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(train, F.lit(True)).alias("train"), "text")
    tokens, seed, top = vocabulary(texts, frequent)
    result = "row long, doc_id long, n_tokens long, n_known long, base_score double, score double"
    if not tokens:
        return spark.createDataFrame([], result + ", train_tokens long").drop("row")
    shards = max(1, -(-tokens // shard_tokens))
    # At most ``frequent`` words, however large the corpus.
    hashes, n = np.array([r.hash for r in top], np.int64).view(np.uint64), np.array([r.n for r in top], np.int64)
    how = Dealing(order, shards, seed, hashes, hashes[n > tokens / (HOT_SHARE * shards)])

    keyed = texts.withColumn("row", F.monotonically_increasing_id()).select("row", "doc_id", "train", "text")
    dealt = keyed.mapInArrow(deal(how, block_tokens), "shard int, block long, payload binary").rdd.flatMap(pieces(0)).partitionBy(shards, place)
    made = lambda rdd, columns: spark.createDataFrame(rdd, columns, verifySchema=False)
    requests = stage(made(dealt.mapPartitions(counted(how)), "to int, shard int, payload binary, numbers array<long>"), "requests")
    gram_numbers = added(requests.where("to = -1"), 8)
    answers = stage(requests.where("to >= 0").repartitionById(shards, "to").mapInArrow(
        answered, "shard int, to int, payload binary, numbers array<long>"), "answers")
    word_numbers = added(answers.where("shard = -1"), 8)
    returned = answers.where("shard >= 0").select("shard", "to", "payload").rdd.flatMap(pieces(1)).partitionBy(shards, place)
    both = dealt.union(returned)
    if both.getNumPartitions() != dealt.getNumPartitions():  # should Spark not see that both are dealt alike
        both = both.partitionBy(shards, place)
    scores = made(both.mapPartitions(scored(how, gram_numbers, word_numbers)), "block long, payload binary")
    sums = scores.repartition(shards, "block").mapInArrow(gathered, result)
    total = sums.groupBy("row").agg(F.max("doc_id").alias("doc_id"), *(F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base_score", "score")))
    return total.select(F.when(F.col("doc_id") != NO_ID, F.col("doc_id")).alias("doc_id"), "n_tokens", "n_known",
                        F.lit(word_numbers[7]).cast("long").alias("train_tokens"), "base_score", "score")


def added(rows: DataFrame, width: int) -> list[int]:
    """The numbers of all rows, added up place by place."""
    return list(rows.agg(*(F.coalesce(F.sum(F.col("numbers")[k]), F.lit(0)).alias(f"n{k}") for k in range(width))).first())
