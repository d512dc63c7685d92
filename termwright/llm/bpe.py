"""BPE encoding and decoding with a segment tree over the ranks of adjacent pairs.

Each leaf of the tree holds ``rank * width + position`` of the pair that starts there, so the
root is the leftmost pair of lowest rank. Merging it changes three leaves, each on a path of
logarithmic length to the root; encoding ends when the root holds no pair. Distinct words of one
width are merged side by side in numpy (a tree per row); long ones have a tree of their own.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Sequence

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from tokenizers import Tokenizer

from termwright.llm._shared import extended, kept

#: A leaf without a pair.
NONE = np.int64(1) << np.int64(60)
#: Words of more symbols than this have a tree of their own.
SIDE_BY_SIDE = 256
#: Entries of a worker's memory of encoded words; at more it starts anew.
REMEMBERED = 200_000


class MergeTable:
    """Which pairs of symbols merge, at what rank, into which symbol."""

    def __init__(self, left: np.ndarray, right: np.ndarray, rank: np.ndarray, made: np.ndarray, size: int):
        self.size = size
        key = left.astype(np.int64) * size + right
        order = np.argsort(key, kind="stable")
        self.keys, self.ranks, self.made = key[order], rank.astype(np.int64)[order], made.astype(np.int64)[order]
        self.slots = {int(k): i for i, k in enumerate(self.keys)}

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The entry of each pair, -1 for none; a negative symbol is in no pair."""
        if not len(self.keys):
            return np.full(left.shape, -1, np.int64)
        key = np.where((left < 0) | (right < 0), -1, left * self.size + right)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, at, -1)

    def merge(self, symbols: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbols left of each word when no pair merges any more, and their numbers.

        The words lie one after another in ``symbols``; ``sizes`` has their lengths.
        """
        starts = np.cumsum(sizes) - sizes
        left, counts = np.empty(len(symbols), np.int64), np.minimum(sizes, 1)
        left[starts[sizes == 1]] = symbols[starts[sizes == 1]]
        width = 2
        while width <= SIDE_BY_SIDE:
            rows = np.flatnonzero((sizes > width // 2) & (sizes <= width) & (sizes > 1))
            for at in range(0, len(rows), step := max(1, 600_000 // width)):
                some = rows[at : at + step]
                ids, n = self._merge_rows(symbols, starts[some], sizes[some], width)
                counts[some] = n
                left[np.repeat(starts[some] - (np.cumsum(n) - n), n) + np.arange(len(ids))] = ids
            width *= 2
        for i in np.flatnonzero(sizes > SIDE_BY_SIDE):
            ids = self.merge_long(symbols[starts[i] : starts[i] + sizes[i]].tolist())
            counts[i] = len(ids)
            left[starts[i] : starts[i] + len(ids)] = ids
        return left[np.repeat(starts - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())], counts

    def _merge_rows(self, symbols: np.ndarray, starts: np.ndarray, sizes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        n, row = len(starts), width + 1
        symbol = np.full((n, row), -1, np.int64)
        symbol[np.arange(row) < sizes[:, None]] = symbols[np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())]
        entry = self.find(symbol[:, :-1], symbol[:, 1:])
        tree = np.full((n, 2 * width), NONE)
        tree[:, width:] = np.where(entry >= 0, self.ranks[entry] * width + np.arange(width), NONE)
        low = width
        while low > 1:
            tree[:, low // 2 : low] = np.minimum(tree[:, low : 2 * low : 2], tree[:, low + 1 : 2 * low : 2])
            low //= 2
        after = np.tile(np.minimum(np.arange(1, row + 1), width), (n, 1)).ravel()
        before = np.tile(np.arange(row) - 1, (n, 1)).ravel()
        symbol, tree, levels = symbol.ravel(), tree.ravel(), width.bit_length() - 1
        live = np.flatnonzero(tree[1 :: 2 * width] < NONE)
        while len(live):
            base, root = live * row, live * (2 * width)
            at = tree[root + 1] & (width - 1)
            gone = after[base + at]
            follow, lead = after[base + gone], before[base + at]
            made = self.made[self.find(symbol[base + at], symbol[base + gone])]
            symbol[base + at], symbol[base + gone] = made, -1
            after[base + at], before[base + follow] = follow, at
            entry = self.find(made, symbol[base + follow])
            tree[root + width + at] = np.where(entry >= 0, self.ranks[entry] * width + at, NONE)
            tree[root + width + gone] = NONE
            led = np.flatnonzero(lead >= 0)
            spot = np.where(lead >= 0, lead, at)
            entry = self.find(symbol[base[led] + lead[led]], made[led])
            tree[root[led] + width + lead[led]] = np.where(entry >= 0, self.ranks[entry] * width + lead[led], NONE)
            nodes = [width + at, width + gone, width + spot]
            for _ in range(levels):
                nodes = [x >> 1 for x in nodes]
                for x in nodes:
                    under = root + 2 * x
                    tree[root + x] = np.minimum(tree[under], tree[under + 1])
            live = live[tree[root + 1] < NONE]
        left = symbol >= 0
        return symbol[left], left.reshape(n, row).sum(1)

    def merge_long(self, word: Sequence[int]) -> list[int]:
        """As :meth:`merge` for one word of any length, in n log n steps."""
        n, slots, ranks, made = len(word), self.slots, self.ranks, self.made
        width = 1 << (n - 1).bit_length()
        symbol, none = [int(x) for x in word], (int(NONE), 0)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))

        def leaf(i: int) -> tuple[int, int]:
            j = after[i]
            slot = slots.get(symbol[i] * self.size + symbol[j]) if j < n and symbol[i] >= 0 and symbol[j] >= 0 else None
            return none if slot is None else (int(ranks[slot]), i)

        tree = [none] * width + [leaf(i) for i in range(n)] + [none] * (width - n)
        for x in range(width - 1, 0, -1):
            tree[x] = min(tree[2 * x], tree[2 * x + 1])
        while tree[1] is not none:
            at = tree[1][1]
            gone = after[at]
            symbol[at] = int(made[slots[symbol[at] * self.size + symbol[gone]]])
            after[at] = after[gone]
            if after[at] < n:
                before[after[at]] = at
            symbol[gone] = -1
            tree[width + gone] = none
            tree[width + at] = leaf(at)
            nodes = {(width + gone) >> 1, (width + at) >> 1}
            if before[at] >= 0:
                tree[width + before[at]] = leaf(before[at])
                nodes.add((width + before[at]) >> 1)
            while nodes:
                for x in nodes:
                    tree[x] = min(tree[2 * x], tree[2 * x + 1])
                nodes = {x >> 1 for x in nodes if x > 1}
        return [x for x in symbol if x >= 0]


def byte_names() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    names, extra = {b: chr(b) for b in own}, 256
    for b in range(256):
        if b not in names:
            names[b] = chr(extra)
            extra += 1
    return [names[b] for b in range(256)]


class WordEncoder:
    """Texts to ids and back for a BPE file with word ends that drops white space."""

    #: White space at which texts may be cut before anything else is done.
    CHUNK = re.compile(r"[^ \t\n\r]+")
    LATIN = re.compile(r"[\x21-\x7e\xa1-\u012f\u0132-\u0148\u014a-\u017e]*")

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab: dict[str, int] = model["vocab"]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        end = model["end_of_word_suffix"] or ""
        size = 1 + max(vocab.values())
        self.table = MergeTable(
            *(np.array(x) for x in ([vocab[a] for a, _ in pairs], [vocab[b] for _, b in pairs], range(len(pairs)), [vocab[a + b] for a, b in pairs])), size=size
        )
        names = byte_names()
        self.inner = np.array([vocab.get(c, -2) for c in names])
        self.last = np.array([vocab.get(c + end, -2) for c in names])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.names = {i: s.encode() for s, i in [*vocab.items(), *self.special.items()]}
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.pattern = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self.library = Tokenizer.from_file(path)
        self.bytes_of = {c: b for b, c in enumerate(names)}
        self.known: dict[str, bytes] = {}
        self.words: dict[bytes, bytes] = {}

    def _pre_tokens(self, chunk: str) -> list[bytes]:
        """The pre-tokens of a text without specials, normalised.

        Beyond the Latin blocks, whose classes every Unicode version shares, the
        tokenizer's own normaliser and splitter are asked.
        """
        if not self.LATIN.fullmatch(chunk):
            parts = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(chunk))
            return [bytes(map(self.bytes_of.__getitem__, x)) for x, _ in parts]
        return [x.encode() for x in self.pattern.findall(chunk.lower())]

    def _learn_words(self, words: list[bytes]) -> None:
        if not words:
            return
        raw, sizes = np.frombuffer(b"".join(words), np.uint8), np.array([*map(len, words)])
        ids, ends = self.inner[raw], np.cumsum(sizes) - 1
        ids[ends] = self.last[raw[ends]]
        if (ids < 0).any():  # bytes that the vocabulary lacks are dropped
            sizes = np.add.reduceat(ids >= 0, ends - sizes + 1)
            ids = ids[ids >= 0]
        ids, counts = self.table.merge(ids, sizes)
        blob, ends = ids.astype("<u4").tobytes(), np.cumsum(counts) * 4
        self.words.update(zip(words, (blob[a:b] for a, b in zip((ends - counts * 4).tolist(), ends.tolist()))))

    def learn(self, chunks: set[str]) -> None:
        """Afterwards ``known`` has the ids of each chunk."""
        if len(self.known) > REMEMBERED or len(self.words) > REMEMBERED:
            self.known.clear()
            self.words.clear()
        new = [c for c in chunks if c not in self.known]
        if not new:
            return
        special = {s: int(i).to_bytes(4, "little") for s, i in self.special.items()}
        parts = [[x for part in self.cut.split(c) for x in ([part] if part in special else self._pre_tokens(part))] if "<|" in c else self._pre_tokens(c) for c in new]
        words = self.words
        self._learn_words([*{x for p in parts for x in p if x not in words and x not in special}])
        for c, p in zip(new, parts):
            self.known[c] = words[p[0]] if len(p) == 1 and p[0] in words else b"".join([special[x] if x in special else words[x] for x in p])

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """For each text its ids as little-endian unsigned 32-bit integers."""
        chunks = [self.CHUNK.findall(t) for t in texts]
        self.learn({c for own in chunks for c in own})
        get = self.known.__getitem__
        return [b"".join(map(get, own)) for own in chunks]

    def decode(self, ids: bytes) -> bytes:
        """The decoded text in UTF-8: the file names no decoder, so the tokens' own strings, spaced."""
        return b" ".join(map(self.names.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def encoded(df: DataFrame, path: str, text: str = "text", with_ids: bool = True) -> DataFrame:
    """``df`` with ``ids`` (binary, little-endian unsigned 32-bit) and ``decoded`` of its texts; they replace the text.

    A null text counts as empty: no ids, an empty decoded text. Repeated rows stay repeated rows;
    other columns pass through, but for those named as a column that is added.
    """
    if with_ids:
        added = T.StructType().add("ids", "binary").add("decoded", "string")

        def make(texts):
            own = kept(("word", path), lambda: WordEncoder(path))
            ids = own.encode_batch(texts)
            return [ids, [own.decode(i).decode() for i in ids]]
    else:
        added = T.StructType().add("n_tokens", "long").add("ids_sha256", "string").add("decoded_sha256", "string")

        def make(texts):
            own = kept(("word", path), lambda: WordEncoder(path))
            ids = own.encode_batch(texts)
            return [[len(i) // 4 for i in ids], [hashlib.sha256(i).hexdigest() for i in ids], [hashlib.sha256(own.decode(i)).hexdigest() for i in ids]]

    return extended(df, make, text, added)
