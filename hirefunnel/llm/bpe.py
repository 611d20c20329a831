"""Byte-level BPE encoding and decoding with the vocabulary file of a public tokenizer.

Texts are cut where added tokens stand and then by the pattern of byte-level tokenizers; each
piece is merged with a priority queue of merge ranks over a doubly linked list of symbols, and
entries that a neighbour's merge made stale are skipped. Decoding joins the vocabulary's byte
strings and reads them as UTF-8. Pieces are cached up to a fixed number per worker.

A null text is an empty one: no ids. Every input row comes back once, also when ids repeat or are
null; an empty table gives no rows; other columns are not read. Texts are encoded whole; a long
piece costs its length times the logarithm of it.
"""

from __future__ import annotations

import hashlib
import json
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirefunnel.llm.common import each_batch

# The pattern of byte-level tokenizers; blanks are Unicode's White_Space.
BLANK = r"\t-\r \x85\xa0  -     　"
PATTERN = (
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{BLANK}\p{{L}}\p{{N}}]+"
    rf"|[{BLANK}]+(?![^{BLANK}])|[{BLANK}]+"
)
CACHED = 1 << 18


def byte_symbols() -> dict[str, int]:
    """The character that stands for each byte: itself if printable, else from U+0100 upwards."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Encoder(dict):
    """Maps a piece to its ids as little-endian 32-bit numbers; a dict so that hits are cheap."""

    def __init__(self, content: str) -> None:
        super().__init__()
        read = json.loads(content)
        vocab: dict[str, int] = read["model"]["vocab"]
        symbols = byte_symbols()
        pairs = (m.split(" ") if isinstance(m, str) else m for m in read["model"]["merges"])
        self.merges = {
            (vocab[a], vocab[b]): (rank, vocab[a + b]) for rank, (a, b) in enumerate(pairs)
        }
        self.byte_ids = [0] * 256
        for char, byte in symbols.items():
            self.byte_ids[byte] = vocab[char]
        added = {t["content"]: t["id"] for t in read.get("added_tokens", [])}
        self.strings: list[bytes] = [b""] * (1 + max([*vocab.values(), *added.values()]))
        for token, i in vocab.items():
            self.strings[i] = bytes(symbols[c] for c in token)
        for token, i in added.items():
            self.strings[i] = token.encode()
        self.added = added
        longest = sorted(added, key=len, reverse=True)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, longest)) + ")") if added else None
        self.pieces = regex.compile(PATTERN).findall

    def __missing__(self, piece: str) -> bytes:
        ids = np.array(self.merged(piece.encode()), "<u4").tobytes()
        if len(piece) <= 64:
            if len(self) >= CACHED:
                self.clear()
            self[piece] = ids
        return ids

    def merged(self, data: bytes) -> list[int]:
        symbol = [self.byte_ids[b] for b in data]
        n, merges = len(symbol), self.merges
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        queue = [
            (found[0], i, found[1])
            for i in range(n - 1)
            if (found := merges.get((symbol[i], symbol[i + 1])))
        ]
        heapify(queue)
        while queue:
            _, left, new = heappop(queue)
            right = after[left]
            if symbol[left] < 0 or right < 0:
                continue
            found = merges.get((symbol[left], symbol[right]))
            if found is None or found[1] != new:
                continue  # stale: a neighbour was merged meanwhile
            symbol[left], symbol[right] = new, -1
            after[left] = after[right]
            if after[right] >= 0:
                before[after[right]] = left
            for a in (before[left], left):
                if a >= 0 and after[a] >= 0:
                    found = merges.get((symbol[a], symbol[after[a]]))
                    if found:
                        heappush(queue, (found[0], a, found[1]))
        return [s for s in symbol if s >= 0]

    def encode(self, text: str) -> bytes:
        if self.cut is None or not self.cut.search(text):
            return b"".join(map(self.__getitem__, self.pieces(text)))
        out = []
        for k, part in enumerate(self.cut.split(text)):
            if k % 2:
                out.append(np.array([self.added[part]], "<u4").tobytes())
            else:
                out += map(self.__getitem__, self.pieces(part))
        return b"".join(out)

    def decode(self, ids: np.ndarray) -> str:
        strings = self.strings
        return b"".join([strings[i] for i in ids.tolist()]).decode("utf-8", "replace")


@lru_cache(2)
def encoder(content: str) -> Encoder:
    """One per worker and vocabulary."""
    return Encoder(content)


def encoded(
    rows: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """id, ids (array of numbers), decoded (text) for every row.

    `vocabulary` is the path of a tokenizer file, read by the driver and sent to every worker:
    its size is the vocabulary's, whatever the input.
    """
    content = _content(rows, vocabulary)

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = encoder(content.value)
        parts = [own.encode(t or "") for t in batch.column(1).to_pylist()]
        ids = [np.frombuffer(p, "<u4") for p in parts]
        ends = np.cumsum([0, *map(len, ids)])
        flat = np.concatenate(ids).astype(np.int32) if ids else np.empty(0, np.int32)
        listed = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))
        decoded = pa.array([own.decode(i) for i in ids], pa.string())
        columns = [batch.column(0), listed, decoded]
        return pa.RecordBatch.from_arrays(columns, names=["id", "ids", "decoded"])

    made = each_batch(_source(rows, id_col, text_col), make, "id long, ids array<int>, decoded string")
    return made.withColumnRenamed("id", id_col)


def encoded_digests(
    rows: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """id, n_tokens, ids_sha256, decoded_sha256 for every row. Ids and decoded texts are digested
    where they are made, one text at a time."""
    content = _content(rows, vocabulary)

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = encoder(content.value)
        n, sha, back = [], [], []
        for text in batch.column(1):
            ids = own.encode(text.as_py() or "")
            n.append(len(ids) // 4)
            sha.append(hashlib.sha256(ids).hexdigest())
            back.append(hashlib.sha256(own.decode(np.frombuffer(ids, "<u4")).encode()).hexdigest())
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(n, pa.int64()), pa.array(sha, pa.string()), pa.array(back, pa.string())],
            names=["id", "n_tokens", "ids_sha256", "decoded_sha256"],
        )

    source = _source(rows, id_col, text_col)
    made = each_batch(source, make, "id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
    return made.withColumnRenamed("id", id_col)


def _content(rows: DataFrame, vocabulary: str):
    with open(vocabulary, encoding="utf-8") as file:
        return rows.sparkSession.sparkContext.broadcast(file.read())


def _source(rows: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return rows.select(
        F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text")
    )
