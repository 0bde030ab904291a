"""Token ids in packed rows of a fixed length: best-fit-decreasing inside blocks of documents.

Each text becomes the ids of a public tokenizer plus one end mark. A document longer than a row is cut into
whole rows and a rest, without loss. The pieces of a block, longest first, each go to the row with
the least room that still holds them; a segment tree over room sizes finds it in a few steps.

A packed row has its id matrix line as little-endian binary, padded to ``row_length``, the cumulative segment
lengths, and for each segment the document, where the segment begins in that document's ids,
and its position reset: positions count up from ``document_at`` at each reset.

Blocks end after ``block_tokens`` ids, so a task holds one block at a time and packing needs no shuffle; rows
follow the order of the input block by block. A NULL text counts as an empty one: its document
is the end mark alone. Repeated rows are packed as often as they come; an empty table gives no row.
"""

from __future__ import annotations

import base64
import importlib.util
import os
from array import array
from collections.abc import Callable, Iterable, Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from veritally.llm.common import in_arrow, sliced, texts_of

TOKENIZERS = "/opt/tokenizers"
VOCABULARY = "byte_bpe_50k.tiktoken"
ROW_LENGTH = 2048
BLOCK_TOKENS = 1 << 21
WORDS_KEPT = 100_000  # twice in a worker's memory, about 45 MB

SCHEMA = (
    "part int, block int, row int, n_tokens int, ids binary, cu_seqlens array<int>, "
    "doc_ids array<bigint>, document_at array<bigint>"
)


class Encoder:
    """Byte-level BPE of a vocabulary file, with the ids of frequent words kept.

    The split pattern starts a new piece at each single space between two other signs, so the words
    between such spaces can be encoded by themselves. A text with other white space next to a
    space is encoded as a whole.
    """

    def __init__(self, folder: str, vocabulary: str):
        import tiktoken

        ranks = {}
        with open(os.path.join(folder, vocabulary), "rb") as f:
            for line in f:
                token, rank = line.split()
                ranks[base64.b64decode(token)] = int(rank)
        spec = importlib.util.spec_from_file_location("tokenizer_pattern", os.path.join(folder, "__init__.py"))
        module = importlib.util.module_from_spec(spec)
        spec.loader.exec_module(module)
        self.end = max(ranks.values()) + 1
        self.encoding = tiktoken.Encoding("packing", pat_str=module.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.opens = np.array([t.startswith(b" ") for t, _ in sorted(ranks.items(), key=lambda x: x[1])])
        self.known: dict[str, bytes | None] = {}
        self.older: dict[str, bytes | None] = {}

    def _learn(self, words: set[str]) -> None:
        """Encode words in one go; a token that begins with a space begins the next word."""
        again = words & self.older.keys()
        self.known.update((w, self.older[w]) for w in again)
        fresh = []
        for w in words - again:
            if not w or w[0].isspace() or w[-1].isspace():
                self.known[w] = None
            else:
                fresh.append(w)
        if fresh:
            ids = self.encoding.encode_to_numpy(" " + " ".join(fresh), disallowed_special=())
            cuts = np.append(np.flatnonzero(self.opens[ids]), len(ids)) * 4
            line = ids.astype(np.uint32).tobytes()
            self.known.update((w, line[i:j]) for w, i, j in zip(fresh, cuts, cuts[1:]))

    def encode(self, texts: list[str | None]) -> Iterator[np.ndarray]:
        """For each text its ids and the end mark."""
        mark = np.uint32(self.end).tobytes()
        words = [(t or "").split(" ") for t in texts]
        if len(self.known) >= WORDS_KEPT:  # those that come again are taken back from the older ones
            self.known, self.older = {}, self.known
        later = set(chain.from_iterable(w[1:] for w in words))
        self._learn(later - self.known.keys())
        known = self.known
        for text, (first, *rest) in zip(texts, words):
            try:
                if first and first[-1].isspace():
                    raise TypeError
                found = b"".join([*map(known.__getitem__, rest), mark])
                found = array("I", self.encoding.encode_ordinary(first)).tobytes() + found
            except TypeError:  # white space next to a space
                found = array("I", self.encoding.encode_ordinary(text)).tobytes() + mark
            yield np.frombuffer(found, dtype=np.uint32)

    def text(self, ids: np.ndarray) -> str:
        """The text of one document's ids, end mark included."""
        return self.encoding.decode([int(i) for i in ids if i != self.end])


@cache
def encoder(folder: str = TOKENIZERS, vocabulary: str = VOCABULARY) -> Encoder:
    return Encoder(folder, vocabulary)


class RoomTree:
    """Open rows by the room they have left, over a segment tree of room sizes 0 to ``capacity``.

    A node says whether any row in its range of sizes is open.
    """

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.any_open = bytearray(2 * self.leaves)
        self.rows: list[list[int]] = [[] for _ in range(capacity + 1)]

    def add(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        node = self.leaves + room
        while node and not self.any_open[node]:
            self.any_open[node] = 1
            node >>= 1

    def take(self, least: int) -> tuple[int, int] | None:
        """Remove and return (room, row) of the open row with the least room of at least ``least``."""
        open_ = self.any_open
        node = self.leaves + least
        while not open_[node]:
            while node & 1:  # a right child: go up to where there is a right neighbour
                node >>= 1
                if node <= 1:
                    return None
            node += 1
        while node < self.leaves:
            node *= 2
            if not open_[node]:
                node += 1
        room = node - self.leaves
        row = self.rows[room].pop()
        if not self.rows[room]:
            open_[node] = 0
            node >>= 1
            while node and not (open_[2 * node] or open_[2 * node + 1]):
                open_[node] = 0
                node >>= 1
        return room, row


def best_fit_decreasing(sizes: Iterable[int], capacity: int) -> list[list[int]]:
    """Rows of piece numbers. Equal sizes go in order of their number."""
    sizes = list(sizes)
    tree, rows = RoomTree(capacity), []
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        found = tree.take(sizes[i])
        if found is None:
            room, row = capacity, len(rows)
            rows.append([])
        else:
            room, row = found
        rows[row].append(i)
        if room > sizes[i]:
            tree.add(room - sizes[i], row)
    return rows


def pack_block(doc_ids: list[int | None], tokens: list[np.ndarray], row_length: int, end: int) -> Iterator[dict]:
    """The packed rows of one block of documents."""
    pieces = [(d, at) for d, ids in enumerate(tokens) for at in range(0, len(ids), row_length)]
    sizes = [min(row_length, len(tokens[d]) - at) for d, at in pieces]
    for number, row in enumerate(best_fit_decreasing(sizes, row_length)):
        line = np.full(row_length, end, dtype="<u4")
        cuts = [0]
        for i in row:
            d, at = pieces[i]
            line[cuts[-1] : cuts[-1] + sizes[i]] = tokens[d][at : at + sizes[i]]
            cuts.append(cuts[-1] + sizes[i])
        yield {
            "row": number,
            "n_tokens": cuts[-1],
            "ids": line.tobytes(),
            "cu_seqlens": cuts,
            "doc_ids": [doc_ids[pieces[i][0]] for i in row],
            "document_at": [pieces[i][1] for i in row],
        }


def pack(
    docs: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    row_length: int = ROW_LENGTH,
    folder: str = TOKENIZERS,
    vocabulary: str = VOCABULARY,
    block_tokens: int = BLOCK_TOKENS,
) -> DataFrame:
    """Packed rows of all ``docs``; ``part``, ``block`` and ``row`` number them."""
    kept = docs.select(docs[key].cast("long").alias("_key"), docs[text].alias("_text"))
    types = {
        "ids": pa.binary(),
        "cu_seqlens": pa.list_(pa.int32()),
        "doc_ids": pa.list_(pa.int64()),
        "document_at": pa.list_(pa.int64()),
    }

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = encoder(folder, vocabulary)
        part = TaskContext.get().partitionId()
        keys: list[int | None] = []
        tokens: list[np.ndarray] = []
        size = block = 0

        def packed() -> pa.RecordBatch:
            rows = list(pack_block(keys, tokens, row_length, tokenizer.end))
            n = len(rows)
            columns = {"part": np.full(n, part), "block": np.full(n, block)}
            columns |= {k: [r[k] for r in rows] for k in ("row", "n_tokens", *types)}
            arrays = [pa.array(v, types.get(k, pa.int32())) for k, v in columns.items()]
            return pa.RecordBatch.from_arrays(arrays, names=list(columns))

        for batch in sliced(batches, "_text"):
            for k, ids in zip(batch.column("_key").to_pylist(), tokenizer.encode(texts_of(batch, "_text"))):
                keys.append(k)
                tokens.append(ids)
                size += len(ids)
                if size >= block_tokens:
                    yield packed()
                    keys, tokens, size, block = [], [], 0, block + 1
        if tokens:
            yield packed()

    return in_arrow(kept, run, SCHEMA)


def unpack(rows: Iterable[dict], decode: Callable[[np.ndarray], str]) -> list[tuple[int | None, str]]:
    """(doc_id, text) of every document in packed rows; for documents with distinct ids."""
    pieces: dict[int | None, list[tuple[int, np.ndarray]]] = {}
    for r in rows:
        line = np.frombuffer(r["ids"], dtype="<u4")
        for d, at, a, b in zip(r["doc_ids"], r["document_at"], r["cu_seqlens"], r["cu_seqlens"][1:]):
            pieces.setdefault(d, []).append((at, line[a:b]))
    return [(d, decode(np.concatenate([x for _, x in sorted(p, key=lambda x: x[0])]))) for d, p in pieces.items()]
