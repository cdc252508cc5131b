"""Byte-level BPE over a whole corpus by forced-boundary splitting.

The vocabulary decides which pairs of bytes can stand next to each other inside
a token. Where a piece of text holds a pair that stands inside no token at all,
every encoding must cut there; so the fragments between such cuts are encoded
independently, once per worker however often they occur, and concatenated.

Defined results for odd input: a null and an empty text give an empty list;
strings that look like special tokens are ordinary text; texts are encoded
whole, however long; repeated rows give repeated rows; other columns stay out.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siteweave.storage import ship

TOKENIZER_DIR = "/opt/tokenizers"
TOKENIZER = "byte_bpe_50k"
# Fixed value: the splitting pattern that belongs to the vocabulary.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
MEMO_PIECES = 300_000
LONG_FRAGMENT = 48


def read_ranks(directory: str = TOKENIZER_DIR, name: str = TOKENIZER) -> dict[bytes, int]:
    """Token bytes and their ids, from a file of base64 text and number per line."""
    lines = (Path(directory) / f"{name}.tiktoken").read_bytes().splitlines()
    return {base64.b64decode(token): int(number) for token, number in (line.split() for line in lines if line.strip())}


class Encoder:
    def __init__(self, ranks: dict[bytes, int]) -> None:
        import regex

        self.ranks = ranks
        self.split = regex.compile(PATTERN).findall
        inside = np.zeros((256, 256), dtype=bool)
        for token in ranks:
            if len(token) > 1:
                row = np.frombuffer(token, dtype=np.uint8)
                inside[row[:-1], row[1:]] = True
        self.inside = inside
        self.memo: dict[str, tuple[int, ...]] = {}
        self.fragments: dict[bytes, tuple[int, ...]] = {}

    def encode(self, text: str | None) -> list[int]:
        out: list[int] = []
        if text:
            memo, extend = self.memo, out.extend
            for piece in self.split(text):
                ids = memo.get(piece)
                extend(ids if ids is not None else self._piece(piece))
        return out

    def _piece(self, piece: str) -> tuple[int, ...]:
        data = piece.encode("utf-8", "surrogatepass")
        whole = self.ranks.get(data)
        if whole is not None:
            ids: tuple[int, ...] = (whole,)
        else:
            row = np.frombuffer(data, dtype=np.uint8)
            cuts = np.flatnonzero(~self.inside[row[:-1], row[1:]]) + 1
            ids, start = (), 0
            found: list[int] = []
            for end in (*cuts.tolist(), len(data)):
                found += self._fragment(data[start:end])
                start = end
            ids = tuple(found)
        if len(piece) <= 256:
            if len(self.memo) >= MEMO_PIECES:
                self.memo.clear()
            self.memo[piece] = ids
        return ids

    def _fragment(self, data: bytes) -> tuple[int, ...]:
        whole = self.ranks.get(data)
        if whole is not None:
            return (whole,)
        ids = self.fragments.get(data)
        if ids is None:
            ids = self._merge(data) if len(data) <= LONG_FRAGMENT else self._merge_long(data)
            if len(data) <= 256:
                if len(self.fragments) >= MEMO_PIECES:
                    self.fragments.clear()
                self.fragments[data] = ids
        return ids

    def _merge(self, data: bytes) -> tuple[int, ...]:
        ranks = self.ranks
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                rank = ranks.get(parts[i] + parts[i + 1])
                if rank is not None and (best is None or rank < best):
                    best, at = rank, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return tuple(ranks[p] for p in parts)

    def _merge_long(self, data: bytes) -> tuple[int, ...]:
        """The same merges with a heap over a linked list, for runs without a forced cut."""
        ranks, n = self.ranks, len(data)
        parts: list[bytes | None] = [data[i : i + 1] for i in range(n)]
        after, before = [*range(1, n), -1], [-1, *range(n - 1)]
        heap = [(rank, i, i + 1, 2) for i in range(n - 1) if (rank := ranks.get(data[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, j, size = heapq.heappop(heap)
            left, right = parts[i], parts[j]
            if left is None or right is None or after[i] != j or len(left) + len(right) != size:
                continue
            parts[i], parts[j] = left + right, None
            after[i] = after[j]
            if after[i] >= 0:
                before[after[i]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b >= 0:
                    joined = parts[a] + parts[b]
                    rank = ranks.get(joined)
                    if rank is not None:
                        heapq.heappush(heap, (rank, a, b, len(joined)))
        return tuple(ranks[p] for p in parts if p is not None)


_encoders: dict[str, Encoder] = {}


def _encoder(key: str, shared) -> Encoder:
    """The encoder of this Python worker; its memo lasts over tasks."""
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(shared.value)
    return _encoders[key]


def encode_documents(documents: DataFrame, key: str = "doc_id", text: str = "text", directory: str | None = None, name: str = TOKENIZER, counts_only: bool = False) -> DataFrame:
    """(key, ids) of every row, or (key, n_tokens) with ``counts_only``; one narrow pass, no shuffle.

    The vocabulary is read from ``directory``, else from the folder in the session's ``spark.siteweave.tokenizers``, else from TOKENIZER_DIR.
    """
    spark = documents.sparkSession
    directory = directory or spark.conf.get("spark.siteweave.tokenizers", TOKENIZER_DIR)
    ship(spark)
    shared = spark.sparkContext.broadcast(read_ranks(directory, name))
    rows = documents.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))
    kind = rows.schema["key"].dataType.simpleString()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(f"{directory}/{name}", shared)
        for batch in batches:
            lists = [encoder.encode(t) for t in batch.column("text").to_pylist()]
            sizes = np.fromiter(map(len, lists), dtype=np.int64, count=len(lists))
            if counts_only:
                yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(sizes)], ["key", "n_tokens"])
                continue
            offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            flat = np.fromiter((i for ids in lists for i in ids), dtype=np.int32, count=int(sizes.sum()))
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.ListArray.from_arrays(offsets, flat)], ["key", "ids"])

    out = rows.mapInArrow(encode, f"key {kind}, " + ("n_tokens bigint" if counts_only else "ids array<int>"))
    return out.withColumnRenamed("key", key)
