"""Byte-pair encoding and decoding with a given vocabulary.

A word's symbols form a doubly linked list; a priority queue holds the merge ranks of neighbouring pairs.  The lowest rank
is merged first, leftmost on ties; an entry whose symbols have changed since it was queued is skipped when it comes
up.  So a word of n symbols takes n log n steps however long it is.  Words repeat, so each worker remembers the ids of
recent ones.  Decoding concatenates vocabulary strings, with the separator the file asks for.

The file is a ``tokenizers`` JSON with a BPE model; the driver reads it once and sends it to the workers (its
size is that of a vocabulary, whatever the data).  Supported are the parts these files use: NFC, white space and lower-case
normalisers, splitting by a pattern that never matches white space, byte-level symbols, and special tokens.

Defined cases: a null text counts as empty and gives no ids and an empty decoded text; a very long text is encoded word by word, whole; repeated rows are encoded alike;
an empty table gives an empty result; the input's other columns stay, and the caller names the new ones.
"""

from __future__ import annotations

import functools
import json
import re
import struct
import unicodedata
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

REMEMBERED, LONGEST_REMEMBERED = 150_000, 40
SLICE_BYTES = 1 << 21
ID_BITS, PLACE_BITS = 24, 40
PLACE_MASK = (1 << PLACE_BITS) - 1
# White space of the Unicode standard; str.split() also splits at U+001C to U+001F.
WHITE = re.compile("[\t-\r \x85\xa0  -     　]+")
SEPARATORS = re.compile("[\x1c-\x1f]")


def byte_symbols() -> list[str]:
    """A printable character for each byte: itself if printable, else the next one from U+0100."""
    printable = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    free = iter(range(256, 512))
    return [chr(b if b in printable else next(free)) for b in range(256)]


class Codec(dict):
    """Encoder and decoder of one vocabulary; as a dict it remembers the packed ids of words."""

    def __init__(self, spec: str):
        super().__init__()
        self.older: dict[str, bytes] = {}
        data = json.loads(spec)
        model = data["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix = model.get("end_of_word_suffix") or ""
        self.special = {t["content"]: t["id"] for t in data["added_tokens"] if t["special"]}
        self.strings = {i: s for s, i in [*self.vocab.items(), *self.special.items()]}
        self.separator = " " if data["decoder"] is None else ""
        pairs = (m if isinstance(m, list) else m.split(" ", 1) for m in model["merges"])
        # By rank: the pair and what it becomes; by pair: the rank.
        self.left, self.right, self.result = map(list, zip(*((self.vocab[a], self.vocab[b], self.vocab[a + b]) for a, b in pairs)))
        self.ranks = {a << ID_BITS | b: rank for rank, (a, b) in enumerate(zip(self.left, self.right))}
        symbols = byte_symbols()
        self.inner = [self.vocab[c] for c in symbols]
        self.final = [self.vocab[c + self.suffix] for c in symbols]
        self._read_steps(data)
        self.at_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None

    def _read_steps(self, data: dict) -> None:
        normalizers = [n["type"] for n in (data["normalizer"] or {}).get("normalizers", [])]
        splits = [p for p in data["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split"]
        if not set(normalizers) <= {"NFC", "Replace", "Lowercase"} or len(splits) != 1 or not splits[0]["invert"]:
            raise ValueError("this vocabulary file asks for steps that are not supported")
        self.nfc, self.lower = "NFC" in normalizers, "Lowercase" in normalizers
        self.words = regex.compile(splits[0]["pattern"]["Regex"])

    def normalized(self, text: str) -> str:
        if self.nfc and not text.isascii():
            text = unicodedata.normalize("NFC", text)
        if self.lower:
            # Letter by letter: a capital sigma is never taken for a final one.
            text = text.replace("Σ", "σ").lower()
        return text

    def merged(self, ids: list[int]) -> list[int]:
        """The symbols of one word after all merges."""
        n, rank_of = len(ids), self.ranks.get
        if n == 1:
            return ids
        left, right, result = self.left, self.right, self.result
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        # An entry is a rank and a place in one number; the rank tells which symbols the place had when it was queued.
        queue = [rank << PLACE_BITS | i for i in range(n - 1) if (rank := rank_of(ids[i] << ID_BITS | ids[i + 1])) is not None]
        heapify(queue)
        while queue:
            entry = heappop(queue)
            rank, i = entry >> PLACE_BITS, entry & PLACE_MASK
            j = after[i]
            if ids[i] != left[rank] or j >= n or ids[j] != right[rank]:
                continue
            ids[i] = made = result[rank]
            ids[j] = -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (found := rank_of(made << ID_BITS | ids[k])) is not None:
                    heappush(queue, found << PLACE_BITS | i)
            h = before[i]
            if h >= 0 and (found := rank_of(ids[h] << ID_BITS | made)) is not None:
                heappush(queue, found << PLACE_BITS | h)
        return [x for x in ids if x >= 0]

    def ids_of(self, chunk: str) -> bytes:
        """Packed ids of a text without white space; its words are remembered too."""
        words = self.words.findall(chunk)
        if len(words) != 1:
            return b"".join(map(self.__getitem__, words))
        raw = words[0].encode()
        ids = [self.inner[b] for b in raw]
        ids[-1] = self.final[raw[-1]]
        ids = self.merged(ids)
        return struct.pack(f"<{len(ids)}I", *ids)

    def __missing__(self, chunk: str) -> bytes:
        packed = self.older.get(chunk)
        if packed is None:
            packed = self.ids_of(chunk)
        if len(chunk) <= LONGEST_REMEMBERED:
            # Words in use move over from the older generation; those that are not go with it.
            if len(self) >= REMEMBERED:
                self.older = dict(self)
                self.clear()
            self[chunk] = packed
        return packed

    def encode(self, text: str | None) -> bytes:
        """All ids of a text, packed as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        if self.at_special and "<" in text:
            parts = self.at_special.split(text)
        else:
            parts = [text]
        out = []
        for k, part in enumerate(parts):
            if k % 2:
                out.append(struct.pack("<I", self.special[part]))
            elif part:
                part = self.normalized(part)
                chunks = WHITE.split(part) if SEPARATORS.search(part) else part.split()
                out.append(b"".join(map(self.__getitem__, chunks)))
        return b"".join(out)

    def decode(self, ids: list[int]) -> str:
        return self.separator.join(map(self.strings.__getitem__, ids))


@functools.lru_cache(2)
def codec_of(spec: str) -> Codec:
    """One codec a worker process and vocabulary."""
    return Codec(spec)


def vocabulary(spark: SparkSession, path: str) -> Broadcast:
    """The vocabulary file, for the workers."""
    with open(path, encoding="utf-8") as f:
        return spark.sparkContext.broadcast(f.read())


def encoded(text: Column, spec: Broadcast) -> Column:
    """``array<int>``: the ids of the text, without special tokens of its own."""
    @F.pandas_udf("array<int>")
    def encode(texts: pd.Series) -> pd.Series:
        codec = codec_of(spec.value)
        return pd.Series([np.frombuffer(codec.encode(t), "<i4") for t in texts])
    return encode(text)


def encode_documents(docs: DataFrame, path: str, ids: str = "token_ids", text: str = "text") -> DataFrame:
    """``docs`` with their ids as one more column."""
    return docs.withColumn(ids, encoded(F.col(text), vocabulary(docs.sparkSession, path)))


def round_trip(docs: DataFrame, path: str, packed: bool = False) -> DataFrame:
    """``doc_id, token_ids, decoded`` of every row; ``decoded`` is made from the ids, special tokens included.

    ``token_ids`` is an array of numbers or, ``packed``, their little-endian unsigned 32-bit form.  Results leave the worker
    some megabytes at a time.
    """
    spec = vocabulary(docs.sparkSession, path)
    kind = pa.binary() if packed else pa.list_(pa.int32())

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(spec.value)
        for batch in batches:
            for part in slices(batch, "text"):
                encoded = [codec.encode(t.as_py()) for t in part.column("text")]
                texts = [codec.decode(np.frombuffer(e, "<u4").tolist()) for e in encoded]
                ids = pa.array(encoded, pa.binary()) if packed else pa.ListArray.from_arrays(
                    np.cumsum([0, *(len(e) // 4 for e in encoded)]).astype(np.int32), np.frombuffer(b"".join(encoded), "<i4"))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), ids.cast(kind), pa.array(texts, pa.string())], ["doc_id", "token_ids", "decoded"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        coded, f"doc_id {id_type}, token_ids {'binary' if packed else 'array<int>'}, decoded string")


def slices(batch: pa.RecordBatch, column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in parts of about ``most`` bytes of text, at least one row each."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    groups = np.cumsum(sizes, dtype=np.int64) // most
    cuts = [0, *(np.flatnonzero(np.diff(groups)) + 1).tolist(), len(batch)] if len(batch) else [0]
    for a, b in zip(cuts, cuts[1:]):
        yield batch.slice(a, b - a)
