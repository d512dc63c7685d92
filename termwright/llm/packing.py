"""Packing of token ids into sequences by bounded-space online best fit.

Every partition keeps a fixed number of open windows. A piece goes to the window that it fills
best; where none has room, the fullest is filled up with the head of the piece and emitted, and the
rest goes on. What is open at the end of a partition is merged with that of its neighbours.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from termwright.llm._shared import kept, pieces, written
from termwright.llm.bpe import REMEMBERED, WordEncoder, byte_names

#: Open windows of a partition.
OPEN = 32
#: Partitions whose open windows one task merges: at most ``OPEN`` windows each.
MERGED = 64
#: White space in the sense of the vocabulary's pattern.
_WS = "\t-\r \x85\xa0  -     　"

#: How byte-level vocabularies split texts.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

SCHEMA = T.StructType()
for _name in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"):
    SCHEMA = SCHEMA.add(_name, "long")


class ByteEncoder:
    """Ids of texts by the tokenizers library, which is asked once for each distinct chunk."""

    CHUNK = re.compile(f" ?[^{_WS}]+|[{_WS}]+(?![^{_WS}])|[{_WS}]+")

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.library = Tokenizer.from_file(path)
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.fast = self._as_ranks(path)
        self.line = self.library.encode("\n", add_special_tokens=False).ids[0]
        self.known: dict[str, bytes] = {}

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """For each text its ids as little-endian unsigned 32-bit integers."""
        if len(self.known) > REMEMBERED:
            self.known.clear()
        # Special strings cut a text before its chunks do: such texts are encoded whole.
        whole = [any(s in t for s in self.special) for t in texts]
        chunks = [[t] if w else self.CHUNK.findall(t) for w, t in zip(whole, texts)]
        known = self.known
        new = [*{c for w, own in zip(whole, chunks) if not w for c in own if c not in known}]
        latin = WordEncoder.LATIN
        self._learn([c for c in new if latin.fullmatch(c.lstrip(" ")) and not c.isspace()])
        for c in new:
            if c not in known:
                known[c] = self._ids(self.library.encode(c, add_special_tokens=False))
        return [self._ids(self.library.encode(t, add_special_tokens=False)) if w else b"".join(map(known.__getitem__, own)) for w, t, own in zip(whole, texts, chunks)]

    @staticmethod
    def _as_ranks(path: str) -> tiktoken.Encoding | None:
        """The same vocabulary for a library that encodes new words faster; None unless its ids are the ranks of its merges."""
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        names = {c: b for b, c in enumerate(byte_names())}
        if any(vocab["".join(m) if isinstance(m, list) else m.replace(" ", "")] != 256 + i for i, m in enumerate(merges)) or len(vocab) != 256 + len(merges):
            return None
        ranks = {bytes(map(names.__getitem__, s)): i for s, i in vocab.items()}
        return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def _learn(self, chunks: list[str]) -> None:
        """Encodes many Latin chunks as the lines of one text: a line end before any of them is a token of its own."""
        for at in range(0, len(chunks), 8192):
            some = chunks[at : at + 8192]
            ids = np.array(self.fast.encode_ordinary("\n".join(some)) if self.fast else self.library.encode("\n".join(some), add_special_tokens=False).ids, "<u4")
            ends = (np.flatnonzero(ids == self.line) * 4).tolist() + [len(ids) * 4]
            if len(ends) == len(some):
                blob = ids.tobytes()
                self.known.update(zip(some, (blob[a:b] for a, b in zip([0, *(x + 4 for x in ends)], ends))))

    @staticmethod
    def _ids(encoding) -> bytes:
        return b"".join([i.to_bytes(4, "little") for i in encoding.ids])


class Window:
    """An open sequence: pieces (document, start, ids, tokens of the document) and their length."""

    __slots__ = ("pieces", "length")

    def __init__(self):
        self.pieces, self.length = [], 0

    def add(self, piece: tuple) -> None:
        self.pieces.append(piece)
        self.length += len(piece[2]) // 4


def cut(piece: tuple, n: int) -> tuple[tuple, tuple]:
    doc, start, ids, total = piece
    return (doc, start, ids[: 4 * n], total), (doc, start + n, ids[4 * n :], total)


class Packer:
    """Best fit into at most ``most`` open windows of ``size`` tokens."""

    def __init__(self, size: int, most: int):
        self.size, self.most, self.open = size, most, []

    def place(self, piece: tuple) -> Iterator[Window]:
        """Places the piece; yields the windows that are full thereby."""
        while (n := len(piece[2]) // 4) > 0:
            if n >= self.size:
                head, piece = cut(piece, self.size)
                yield self._filled(Window(), head)
                continue
            room = [w for w in self.open if w.length + n <= self.size]
            if room:
                best = max(room, key=lambda w: w.length)
            elif len(self.open) < self.most:
                self.open.append(best := Window())
            else:
                best = max(self.open, key=lambda w: w.length)
                head, piece = cut(piece, self.size - best.length)
                self.open.remove(best)
                yield self._filled(best, head)
                continue
            best.add(piece)
            if best.length == self.size:
                self.open.remove(best)
                yield best
            return

    @staticmethod
    def _filled(window: Window, piece: tuple) -> Window:
        window.add(piece)
        return window


def powers(n: int) -> list[int]:
    """The powers of two that add up to ``n``, the largest first."""
    return [1 << b for b in range(n.bit_length() - 1, -1, -1) if n >> b & 1]


def rows(window: Window, sequence: int) -> Iterator[tuple]:
    at = 0
    for doc, start, ids, total in window.pieces:
        yield doc, start, len(ids) // 4, zlib.crc32(ids), total, sequence, at
        at += len(ids) // 4


def packed(df: DataFrame, path: str, size: int = 1024, end_id: int = 0, key: str = "doc_id", text: str = "text", windows: int = OPEN) -> DataFrame:
    """A row for each piece: its document, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``, ``sequence_id`` and ``offset``.

    A document is its ids and ``end_id``; a null or empty text is ``end_id`` alone. Sequences have
    ``size`` tokens, but for those that are left at the very end of a group of partitions: these
    are cut into sequences whose lengths are powers of two, which need no padding. Every row of
    ``df`` is packed, repeated rows as often as they occur, null keys as null; an empty table gives no rows.
    """
    source = df.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    part = T.StructType(SCHEMA.fields + [T.StructField("merge", T.LongType()), T.StructField("ids", T.BinaryType())])

    def run(batches):
        encoder, packer, number = kept(("byte", path), lambda: ByteEncoder(path)), Packer(size, windows), 0
        partition = TaskContext.get().partitionId()
        last = int(end_id).to_bytes(4, "little")
        for batch in pieces(batches):
            out = []
            for doc, ids in zip(batch.column(0).to_pylist(), encoder.encode_batch([x or "" for x in batch.column(1).to_pylist()])):
                ids += last
                for full in packer.place((doc, 0, ids, len(ids) // 4)):
                    out += [(*r, None, None) for r in rows(full, (partition << 33) + 2 * number)]
                    number += 1
            if out:
                yield _batch(out, part)
        left = [(doc, start, len(ids) // 4, None, total, (partition << 33) + i, None, partition // MERGED, ids) for i, w in enumerate(packer.open) for doc, start, ids, total in w.pieces]
        if left:
            yield _batch(left, part)

    def merge(own: pa.Table) -> pa.Table:
        # In the order of partitions and windows, so that pieces of one window stay together.
        own = own.sort_by([("sequence_id", "ascending"), ("doc_id", "ascending"), ("start", "ascending"), ("ids", "ascending")])
        group, packer, number, out = own["merge"][0].as_py(), Packer(size, 1), 0, []

        def emit(window: Window) -> None:
            nonlocal number
            out.extend(rows(window, (group << 33) + 2 * number + 1))
            number += 1

        for piece in zip(*(own[c].to_pylist() for c in ("doc_id", "start", "ids", "doc_tokens"))):
            for full in packer.place(piece):
                emit(full)
        for window in packer.open:
            queue = window.pieces[::-1]
            for n in powers(window.length):
                part_of = Window()
                while part_of.length < n:
                    piece = queue.pop()
                    if part_of.length + len(piece[2]) // 4 > n:
                        piece, rest = cut(piece, n - part_of.length)
                        queue.append(rest)
                    part_of.add(piece)
                emit(part_of)
        return pa.Table.from_batches([_batch(out, SCHEMA)])

    placed = written(source.mapInArrow(run, part), "packed")
    done = placed.where("merge is null").select(*SCHEMA.names)
    return done.union(placed.where("merge is not null").groupBy("merge").applyInArrow(merge, SCHEMA))


def _batch(found: list[tuple], schema: T.StructType) -> pa.RecordBatch:
    kinds = [pa.binary() if f.dataType == T.BinaryType() else pa.int64() for f in schema.fields]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found), kinds)], names=schema.names)
