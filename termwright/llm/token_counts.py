"""Token counts by whole-token shortcut.

For a BPE piece vocabulary with byte fallback it is proved once, from the vocabulary alone, which
of its strings encode alone as one token. A text is cut where no piece can cross; pre-tokens that
are such strings count one, and only the rest are merged.
"""

from __future__ import annotations

import re

import numpy as np
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from termwright.llm._shared import extended, kept
from termwright.llm.bpe import REMEMBERED, MergeTable

#: The character that stands for a blank inside pieces.
BLANK = "▁"


class PieceEncoder:
    """Ids and counts of texts under a sentencepiece BPE model with byte fallback, no normalisation and a leading blank."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.vocab_size()
        plain = [i for i in range(n) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        self.ids = {model.id_to_piece(i): i for i in plain}
        self.byte_ids = np.array([model.piece_to_id(f"<0x{b:02X}>") for b in range(256)])
        score = {p: model.get_score(i) for p, i in self.ids.items()}
        left, right, rank, made = [], [], [], []
        for p, i in self.ids.items():
            for k in range(1, len(p)):
                if p[:k] in self.ids and p[k:] in self.ids:
                    left.append(self.ids[p[:k]]), right.append(self.ids[p[k:]]), made.append(i), rank.append(-score[p])
        ranks = np.unique(np.array(rank), return_inverse=True)[1]
        self.table = MergeTable(np.array(left), np.array(right), ranks, np.array(made), n)
        # No piece has a line end, or a blank after another character: texts may be cut there.
        crossing = [p for p in self.ids if "\n" in p or re.search(f"[^{BLANK}]{BLANK}", p)]
        self.cut = re.compile(f"\n|{BLANK}*[^{BLANK}\n]+|{BLANK}+") if not crossing else re.compile("(?s).+")
        self.known: dict[str, bytes] = {}
        self.counts: dict[str, int] = {}
        pieces = [*self.ids]
        self.whole = {p: x for p, x in zip(pieces, self._encode(pieces)) if len(x) == 4}

    def _encode(self, words: list[str]) -> list[bytes]:
        """The ids of each pre-token as little-endian unsigned 32-bit integers."""
        if not words:
            return []
        ids, get = [], self.ids.get
        letters = [*set("".join(words))]
        own = {c: get(c, -1 - at) for at, c in enumerate(letters)}
        for w in words:
            ids += map(own.__getitem__, w)
        # Characters outside the vocabulary merge with nothing; afterwards they become their bytes.
        outside = {c: self.byte_ids[np.frombuffer(c.encode(), np.uint8)] for c in letters if own[c] < 0}
        ids, counts = self._merged(np.array(ids, np.int64), np.array([*map(len, words)]))
        ends = np.cumsum(counts)
        if outside:
            of = {own[c]: x for c, x in outside.items()}
            times = np.ones(len(ids), np.int64)
            odd = np.flatnonzero(ids < 0)
            times[odd] = [len(of[x]) for x in ids[odd].tolist()]
            filled = np.repeat(ids, times)
            at = np.cumsum(times) - times
            for k in odd.tolist():
                filled[at[k] : at[k] + times[k]] = of[int(ids[k])]
            ids, ends = filled, np.concatenate([[0], np.cumsum(times)])[ends]
        blob, ends = ids.astype("<u4").tobytes(), (ends * 4).tolist()
        return [blob[a:b] for a, b in zip([0, *ends], ends)]

    def _merged(self, ids: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Negative ids stand for characters outside the vocabulary: they stay, as words of their own between the parts to merge."""
        if not (ids < 0).any():
            return self.table.merge(ids, sizes)
        word = np.repeat(np.arange(len(sizes)), sizes)
        odd = ids < 0
        start = np.ones(len(ids), bool)
        start[1:] = (word[1:] != word[:-1]) | odd[1:] | odd[:-1]
        at = np.flatnonzero(start)
        parts = np.diff([*at, len(ids)])
        got, n = self.table.merge(ids, parts)
        return got, np.bincount(word[at], weights=n, minlength=len(sizes)).astype(np.int64)

    def _chunks(self, text: str) -> list[str]:
        return self.cut.findall(BLANK + text.replace(" ", BLANK)) if text else []

    def learn(self, chunks: set[str]) -> None:
        if len(self.known) > REMEMBERED:
            self.known.clear()
        new = [c for c in chunks if c not in self.known]
        whole = self.whole
        rest = [c for c in new if c not in whole]
        self.known.update({c: whole[c] for c in new if c in whole})
        self.known.update(zip(rest, self._encode(rest)))

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        chunks = [self._chunks(t) for t in texts]
        self.learn({c for own in chunks for c in own})
        get = self.known.__getitem__
        return [b"".join(map(get, own)) for own in chunks]

    def count_batch(self, texts: list[str]) -> list[int]:
        """Counts without ids: a proved whole token counts one at once, and only the other pre-tokens are merged, each once."""
        if len(self.counts) > REMEMBERED:
            self.counts.clear()
        chunks = [self._chunks(t) for t in texts]
        whole, counts = self.whole, self.counts
        rest = [c for c in {c for own in chunks for c in own} if c not in whole and c not in counts]
        counts.update(zip(rest, (len(x) // 4 for x in self._encode(rest))))
        return [sum(1 if c in whole else counts[c] for c in own) for own in chunks]


def counted(df: DataFrame, path: str, limit: int = 4096, text: str = "text") -> DataFrame:
    """``df`` with ``n_bytes``, ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens) in place of its texts.

    A null or empty text has 0 bytes and 0 tokens, a text of any length is counted whole, an empty table gives no rows. Repeated rows stay repeated rows; other columns
    pass through, but for those named as a column that is added.
    """
    added = T.StructType().add("n_bytes", "long").add("n_tokens", "long").add("over_limit", "boolean")

    def make(texts):
        n = kept(("piece", path), lambda: PieceEncoder(path)).count_batch(texts)
        return [[len(t.encode()) for t in texts], n, [x > limit for x in n]]

    return extended(df, make, text, added)
