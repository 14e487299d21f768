"""Token ids packed into rows of fixed length.

Documents are encoded with a given byte-level vocabulary, closed by an end token, and cut into pieces of at most the row length, without loss.  Pieces are
placed by best-fit decreasing: the longest first, each into the row with the least room that still takes it, found by a
segment tree over the room left.  A packed row holds its ids as one line of the id matrix, the
cumulative lengths of its segments, and position ids that start anew in every segment.

Each task packs its own documents, a group of about ``GROUP_TOKENS`` tokens at a time, so nothing is shuffled
and memory does not depend on the data; each group leaves at most one badly filled row or so.  A longer document is a
group of its own.

Defined cases: a null or empty text is its end token alone; a very long text is encoded in stretches and split over as many rows as it takes; repeated rows are packed one by one; a null ``doc_id`` is listed as
null; an empty table gives an empty result; other columns of the input take no part.
"""

from __future__ import annotations

import base64
import functools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame

ROW, GROUP_TOKENS, STRETCH = 2048, 4_000_000, 20_000
# Blanks as the vocabulary's pattern has them (Unicode White_Space).
BLANKS = "\t\n\v\f\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
LONG_BLANKS, BORDER = re.compile(f"(?<![{BLANKS}])[{BLANKS}]{{{STRETCH + 1},}}"), re.compile(f"[^{BLANKS}](?=[{BLANKS}])")
SCHEMA = "pack_id long, doc_ids array<long>, pieces array<int>, cu_seqlens array<int>, token_ids binary, position_ids binary"


@functools.lru_cache(2)
def encoding_of(ranks: str, pattern: str) -> tiktoken.Encoding:
    """One encoding a worker process and vocabulary: a line for each token, in base 64, and its rank."""
    parsed = {base64.b64decode(token): int(rank) for token, rank in map(str.split, ranks.splitlines())}
    return tiktoken.Encoding("vocabulary", pat_str=pattern, mergeable_ranks=parsed, special_tokens={})


def stretches(text: str) -> Iterator[str]:
    """A long text in parts, cut only where words end whatever the rest of the text is.

    No word of the pattern goes on from another character to a blank, so a text may be cut there.  A run of more than ``STRETCH`` blanks is a
    part of its own, without its last blank if something follows, which begins the next word: so the pattern cuts it too.
    """
    at, cuts = 0, []
    for m in LONG_BLANKS.finditer(text):
        cuts += [m.start(), m.end() - (m.end() < len(text))]
    for stop in [*cuts, len(text)]:
        while stop - at > STRETCH:
            border = BORDER.search(text, at + STRETCH - 1, stop)
            if border is None:
                break
            yield text[at:border.start() + 1]
            at = border.start() + 1
        if stop > at:
            yield text[at:stop]
            at = stop


def encoded(encoding: tiktoken.Encoding, text: str) -> Iterator[int]:
    """The ids of the whole text.  A long run of blanks is one word; the pattern, which recurses over its blanks, is not asked."""
    for part in stretches(text):
        yield from encoding._encode_single_piece(part) if len(part) >= STRETCH and not part.strip(BLANKS) else encoding.encode_ordinary(part)


class RoomTree:
    """Open rows by the room they have left; finds the least room that is large enough in logarithmic time."""

    def __init__(self, most: int):
        self.leaves = 1 << most.bit_length()
        self.open = [0] * (2 * self.leaves)
        self.rows: list[list[int]] = [[] for _ in range(most + 1)]

    def put(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        self._count(room, 1)

    def take(self, need: int) -> tuple[int, int] | None:
        """Room and row of the best fit, which leaves the tree; None if no row has the room."""
        node = self.leaves + need
        if not self.open[node]:
            # Up to the first ancestor with something open to the right, then down along the left.
            while node > 1 and (node & 1 or not self.open[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if self.open[2 * node] else 2 * node + 1
        room = node - self.leaves
        self._count(room, -1)
        return room, self.rows[room].pop()

    def _count(self, room: int, by: int) -> None:
        node = self.leaves + room
        while node:
            self.open[node] += by
            node >>= 1


def best_fit_decreasing(lengths: list[int], row: int = ROW) -> list[list[int]]:
    """For each row the places of its items, in the order in which they were put in."""
    tree, rows = RoomTree(row), []
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        found = tree.take(lengths[i])
        if found is None:
            room, at = row, len(rows)
            rows.append([])
        else:
            room, at = found
        rows[at].append(i)
        tree.put(room - lengths[i], at)
    return rows


def packed_rows(docs: list[tuple[int | None, np.ndarray]], row: int, pad: int, id_type: str) -> Iterator[tuple]:
    """Packed rows of documents ``(doc_id, ids)``: all columns but the number of the row."""
    pieces = [(doc_id, k, ids[a:a + row]) for doc_id, ids in docs for k, a in enumerate(range(0, len(ids), row))]
    for own in best_fit_decreasing([len(p[2]) for p in pieces], row):
        lengths = np.array([len(pieces[i][2]) for i in own])
        ends = np.cumsum(lengths)
        ids, positions = np.full(row, pad, id_type), np.zeros(row, "<u4")
        ids[:ends[-1]] = np.concatenate([pieces[i][2] for i in own])
        positions[:ends[-1]] = np.arange(ends[-1]) - np.repeat(ends - lengths, lengths)
        yield ([pieces[i][0] for i in own], [pieces[i][1] for i in own], [0, *ends.tolist()], ids.tobytes(),
               positions.astype("<u2" if row <= 1 << 16 else "<u4").tobytes())


def pack_documents(docs: DataFrame, path: str, pattern: str, row: int = ROW, group_tokens: int = GROUP_TOKENS) -> DataFrame:
    """Packed rows: ids and positions as little-endian numbers, two bytes wide where vocabulary and row length allow.

    ``path`` names the ranks of the vocabulary, ``pattern`` cuts texts into words.  The end token's id is the first free one.
    ``pieces`` counts the pieces of each document in the row from 0; padding behind the last segment has the end id and position 0.
    ``pack_id`` is unique in the result.
    """
    with open(path, encoding="ascii") as f:
        ranks = docs.sparkSession.sparkContext.broadcast(f.read())

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = encoding_of(ranks.value, pattern)
        close = encoding.max_token_value + 1
        id_type = "<u2" if close < 1 << 16 else "<u4"
        task, made = TaskContext.get().partitionId() << 33, 0

        def flush(group: list) -> Iterator[pa.RecordBatch]:
            nonlocal made
            columns = list(zip(*packed_rows(group, row, close, id_type)))
            count = len(columns[0])
            types = (pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.binary(), pa.binary())
            # A few rows at a time: a batch stays some megabytes.
            for a in range(0, count, 1024):
                part = [pa.array(c[a:a + 1024], t) for c, t in zip(columns, types)]
                numbers = pa.array(range(task + made + a, task + made + min(a + 1024, count)), pa.int64())
                yield pa.RecordBatch.from_arrays([numbers, *part], [c.split()[0] for c in SCHEMA.split(", ")])
            made += count

        group, tokens = [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text")):
                ids = np.array([*encoded(encoding, text.as_py() or ""), close], id_type)
                group.append((doc_id.as_py(), ids))
                tokens += len(ids)
                if tokens >= group_tokens:
                    yield from flush(group)
                    group, tokens = [], 0
        if group:
            yield from flush(group)

    return docs.select("doc_id", "text").mapInArrow(pack, SCHEMA)
