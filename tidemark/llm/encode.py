"""Encoding of a corpus with a public byte-level BPE vocabulary, and decoding.

A text is cut into pieces by the vocabulary's split pattern. A piece that is no entry itself is merged: its
bytes form a doubly linked list, a priority queue holds the rank of every adjacent pair that is an entry, and
the lowest is merged first. A merge changes the neighbours' pairs, whose old queue entries become stale and
are skipped when they come up. This takes O(n log n) for a piece of n bytes, so unbroken runs of any length
are encoded whole. Decoding concatenates the entries' bytes.

Null and empty texts give the empty list; blank texts are encoded as they are; strings of special tokens are
ordinary text. Map-only: nothing is shuffled, and each Python worker reads the vocabulary file once.
"""

import base64
import os
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import spread

TOKENIZERS = "/opt/tokenizers"
VOCABULARY = "byte_bpe_50k"

# The split pattern of the byte-level vocabularies, for ASCII texts and for all others.
_ASCII = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\t-\r A-Za-z0-9]+|[\t-\r ]+(?![^\t-\r ])|[\t-\r ]+")
_SPACE = r"\t-\r \x85\xa0  -     　"
_UNICODE = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_SPACE}\p{{L}}\p{{N}}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"


class Encoder:
    """Vocabulary and piece cache of one process."""

    CACHE = 1 << 18  # pieces held before the cache starts anew; a bound on memory, not on results

    def __init__(self, path: str):
        import regex

        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.entries = {v: k for k, v in self.ranks.items()}
        self.split = regex.compile(_UNICODE).findall
        self.cache: dict[str, tuple[int, ...]] = {}

    def merge(self, piece: bytes) -> tuple[int, ...]:
        """Ids of one piece."""
        ranks = self.ranks
        if piece in ranks:
            return (ranks[piece],)
        n = len(piece)
        symbol = [piece[i : i + 1] for i in range(n)]
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        right[-1] = -1
        queue = [(r, i, 2) for i in range(n - 1) if (r := ranks.get(symbol[i] + symbol[i + 1])) is not None]
        heapify(queue)
        while queue:
            rank, i, size = heappop(queue)
            j = right[i]
            if not symbol[i] or j < 0 or len(symbol[i]) + len(symbol[j]) != size or ranks.get(symbol[i] + symbol[j]) != rank:
                continue  # stale: one of the two has been merged since
            symbol[i] += symbol[j]
            symbol[j] = b""
            k = right[i] = right[j]
            if k >= 0:
                left[k] = i
                if (r := ranks.get(symbol[i] + symbol[k])) is not None:
                    heappush(queue, (r, i, len(symbol[i]) + len(symbol[k])))
            h = left[i]
            if h >= 0 and (r := ranks.get(symbol[h] + symbol[i])) is not None:
                heappush(queue, (r, h, len(symbol[h]) + len(symbol[i])))
        return tuple(ranks[s] for s in symbol if s)

    def encode(self, text: str | None) -> list[int]:
        if not text:
            return []
        pieces = _ASCII.findall(text) if text.isascii() else self.split(text)
        cache, out = self.cache, []
        for piece in pieces:
            ids = cache.get(piece)
            if ids is None:
                ids = self.merge(piece.encode("utf-8", "replace"))
                if len(piece) <= 64:
                    if len(cache) >= self.CACHE:
                        cache.clear()
                    cache[piece] = ids
            out += ids
        return out

    def decode(self, ids: Iterable[int]) -> str:
        return b"".join(self.entries[i] for i in ids).decode("utf-8", "replace")


@lru_cache(4)
def encoder(folder: str = TOKENIZERS, vocabulary: str = VOCABULARY) -> Encoder:
    return Encoder(os.path.join(folder, f"{vocabulary}.tiktoken"))


def encode_table(df: DataFrame, key: str, text: str, folder: str = TOKENIZERS, vocabulary: str = VOCABULARY) -> DataFrame:
    """``key`` and ``ids`` of every row; only the two columns are read."""

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = encoder(folder, vocabulary).encode
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                ids = pa.array(map(one, part.column(1).to_pylist()), pa.list_(pa.int32()), size=part.num_rows)
                yield pa.RecordBatch.from_arrays([part.column(0), ids], [key, "ids"])

    kind = df.schema[key].dataType.simpleString()
    return spread(df.select(F.col(f"`{key}`").alias(key), F.col(f"`{text}`").cast("string").alias("__text"))).mapInArrow(encode, f"`{key}` {kind}, ids array<int>")


def token_count(text: Column, folder: str = TOKENIZERS, vocabulary: str = VOCABULARY) -> Column:
    """Number of tokens of a text; 0 for null and empty."""

    @F.pandas_udf("bigint")
    def count(s: pd.Series) -> pd.Series:
        one = encoder(folder, vocabulary).encode
        return s.map(lambda t: len(one(t))).astype("int64")

    return count(text)


def decode_ids(ids: Column, folder: str = TOKENIZERS, vocabulary: str = VOCABULARY) -> Column:
    """Text of a list of ids; bytes that are no UTF-8 come out as replacement characters; null stays null."""

    @F.pandas_udf("string")
    def decode(s: pd.Series) -> pd.Series:
        one = encoder(folder, vocabulary).decode
        return s.map(lambda x: None if x is None else one(x.tolist()))

    return decode(ids)
