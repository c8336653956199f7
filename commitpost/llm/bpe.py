"""Byte-level BPE: encoding by a rank file, and decoding.

A text is cut into pieces by the pattern; the bytes of each piece are folded by always merging the leftmost pair of
lowest rank. Tasks fold each distinct piece once and keep the result for later texts (a bounded table); long pieces
are folded by a heap, in n log n. Decoding concatenates the bytes of the ids.

Cases: null text is encoded as empty; an empty text has no tokens and decodes to nothing; bytes the rank file lacks,
and ids it lacks when decoding, raise ValueError; repeated rows are encoded alike; other columns are kept by
``encode`` unless they are named like its outputs, which then replace them.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, functions as F, types as T

from .grams import slices

NO_RANK = 1 << 60
KEPT_PIECES = 250_000
"""Pieces whose ids a worker keeps; when there are more, it starts over."""
KEPT_LENGTH = 64
"""Longer pieces (in bytes) are rare; they are not kept."""
HEAP_LENGTH = 48
"""From this length on, a piece is folded with a heap."""


LATIN = r"A-Za-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
"""All letters below U+0250. A text without other letters or digits is cut by the faster ``re``, to the same pieces."""
SPACES = r"\t-\r \x85\xa0"


class Kept(dict):
    """Ids of each piece, folded when first asked for."""

    def __init__(self, fold):
        self.fold = fold

    def __missing__(self, piece: str) -> tuple[int, ...]:
        data = piece.encode()
        ids = self.fold(data)
        if len(data) <= KEPT_LENGTH:
            self[piece] = ids
        return ids


class Ranks:
    """A rank file: lines of a base64 token and its rank."""

    def __init__(self, path: str, pattern: str):
        self.rank: dict[bytes, int] = {}
        with open(path, "rb") as lines:
            for line in lines:
                if line.strip():
                    token, rank = line.split()
                    self.rank[base64.b64decode(token)] = int(rank)
        self.token = {rank: token for token, rank in self.rank.items()}
        self.decimal = {rank: str(rank) for rank in self.token}
        # \s is White_Space of Unicode; Python's own \s also takes the separators U+001C to U+001F
        spaced = pattern.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")
        self.cut = regex.compile(spaced).findall
        latin = pattern.replace(r"[^\s\p{L}\p{N}]", f"[^{SPACES}{LATIN}0-9]").replace(r"\p{L}", f"[{LATIN}]").replace(r"\p{N}", "[0-9]")
        latin = latin.replace(r"\s", f"[{SPACES}]").replace(r"\S", f"[^{SPACES}]")
        self.cut_latin = None if r"\p" in latin else re.compile(latin).findall
        self.beyond_latin = re.compile(r"[^\x00-\xb1\xb4-\xb8\xba\xbb\xbf-\u024f\u2010-\u2027]").search
        self.kept = Kept(self.fold)

    def fold(self, piece: bytes) -> tuple[int, ...]:
        whole = self.rank.get(piece)
        if whole is not None:
            return (whole,)
        parts = self._fold_by_heap(piece) if len(piece) >= HEAP_LENGTH else self._fold_by_scan(piece)
        try:
            return tuple(self.rank[p] for p in parts)
        except KeyError as missing:
            raise ValueError(f"the rank file lacks the bytes {missing}") from None

    def _fold_by_scan(self, piece: bytes) -> list[bytes]:
        rank = self.rank.get
        parts = [piece[i : i + 1] for i in range(len(piece))]
        pairs = [rank(piece[i : i + 2], NO_RANK) for i in range(len(piece) - 1)]
        while pairs:
            lowest = min(pairs)
            if lowest == NO_RANK:
                break
            at = pairs.index(lowest)
            merged = parts[at] + parts[at + 1]
            parts[at : at + 2] = [merged]
            del pairs[at]
            if at < len(pairs):
                pairs[at] = rank(merged + parts[at + 1], NO_RANK)
            if at:
                pairs[at - 1] = rank(parts[at - 1] + merged, NO_RANK)
        return parts

    def _fold_by_heap(self, piece: bytes) -> list[bytes]:
        rank, n = self.rank, len(piece)
        end, before = list(range(1, n + 1)), list(range(-1, n))  # of the part that starts at i; n starts none
        alive = [True] * n
        heap: list[tuple[int, int, int]] = []

        def offer(start: int) -> None:
            if end[start] < n:
                stop = end[end[start]]
                found = rank.get(piece[start:stop])
                if found is not None:
                    heapq.heappush(heap, (found, start, stop))

        for start in range(n - 1):
            offer(start)
        while heap:
            _, start, stop = heapq.heappop(heap)
            middle = end[start]
            if not alive[start] or middle >= n or end[middle] != stop:
                continue  # a part has changed since
            alive[middle] = False
            end[start] = stop
            if stop < n:
                before[stop] = start
            offer(start)
            if start:
                offer(before[start])
        parts, start = [], 0
        while start < n:
            parts.append(piece[start : end[start]])
            start = end[start]
        return parts

    def encode(self, text: str) -> list[int]:
        if len(self.kept) > KEPT_PIECES:
            self.kept.clear()
        cut = self.cut if self.cut_latin is None or self.beyond_latin(text) else self.cut_latin
        return list(chain.from_iterable(map(self.kept.__getitem__, cut(text))))

    def decode(self, ids) -> bytes:
        try:
            return b"".join(map(self.token.__getitem__, ids))
        except KeyError as missing:
            raise ValueError(f"the rank file lacks the id {missing}") from None


_loaded: dict[tuple[str, str], Ranks] = {}


def _ranks(name: str, pattern: str) -> Ranks:
    """The rank file that the driver added; read once by a worker."""
    if (name, pattern) not in _loaded:
        _loaded[name, pattern] = Ranks(SparkFiles.get(name), pattern)
    return _loaded[name, pattern]


def _add(df: DataFrame, path: str) -> str:
    df.sparkSession.sparkContext.addFile(path)
    return path.rsplit("/", 1)[-1]


def encode(documents: DataFrame, path: str, pattern: str) -> DataFrame:
    """``documents`` with ``ids``: the ids of the whole text."""
    name = _add(documents, path)
    rows = documents.drop("ids")
    schema = T.StructType([*rows.schema.fields, T.StructField("ids", T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = _ranks(name, pattern)
        for whole in batches:
            for batch in slices(whole):
                ids = [ranks.encode(text or "") for text in batch["text"].to_pylist()]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ids, pa.list_(pa.int32()))], schema.names)

    return rows.mapInArrow(run, schema)


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """``encoded`` with ``decoded``: the bytes of its ``ids``."""
    name = _add(encoded, path)
    rows = encoded.drop("decoded")
    schema = T.StructType([*rows.schema.fields, T.StructField("decoded", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = _ranks(name, pattern)
        for batch in batches:
            decoded = [ranks.decode(ids or ()) for ids in batch["ids"].to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(decoded, pa.binary())], schema.names)

    return rows.mapInArrow(run, schema)


def encoded_and_checked(documents: DataFrame, path: str, pattern: str) -> DataFrame:
    """``documents`` with ids, n_tokens, and round_trip: whether the ids decode to the text (a null text to nothing)."""
    name = _add(documents, path)
    rows = documents.drop("ids", "n_tokens", "round_trip")
    added = [T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("n_tokens", T.LongType()), T.StructField("round_trip", T.BooleanType())]
    schema = T.StructType([*rows.schema.fields, *added])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = _ranks(name, pattern)
        for whole in batches:
            for batch in slices(whole):
                texts = [text or "" for text in batch["text"].to_pylist()]
                ids = [ranks.encode(text) for text in texts]
                same = [ranks.decode(found) == text.encode() for found, text in zip(ids, texts)]
                new = [pa.array(ids, pa.list_(pa.int32())), pa.array(list(map(len, ids)), pa.int64()), pa.array(same)]
                yield pa.RecordBatch.from_arrays([*batch.columns, *new], schema.names)

    return rows.mapInArrow(run, schema)


def digests(documents: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, and the SHA-256 of the ids and of what they decode to, without moving the ids."""
    name = _add(documents, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = _ranks(name, pattern)
        for whole in batches:
            for batch in slices(whole):
                rows = []
                for text in batch["text"].to_pylist():
                    ids = ranks.encode(text or "")
                    listed = ",".join(map(ranks.decimal.__getitem__, ids)).encode()
                    decoded = ranks.decode(ids)
                    rows.append((len(ids), hashlib.sha256(listed).hexdigest(), hashlib.sha256(decoded).hexdigest()))
                n, ids_hash, decoded_hash = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"], pa.array(n, pa.int64()), pa.array(ids_hash), pa.array(decoded_hash)],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    schema = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return documents.select("doc_id", "text").mapInArrow(run, schema)
