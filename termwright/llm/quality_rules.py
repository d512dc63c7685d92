"""Quality rules: repetition counts and the fertility of public tokenizers.

Beside plain word rules, a document is held against what public vocabularies make of it: characters
per token, the share of byte-fallback tokens and the entropy of its tokens, each with a band per
language, and of its script where the language has none. Jumbled, tabular or shouted text breaks into more and
more repetitive tokens than prose of its language.
"""

from __future__ import annotations

import base64
import heapq
import math
import os
import re
from dataclasses import dataclass

import numpy as np
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from termwright.llm._shared import extended, kept
from termwright.llm.packing import PATTERN
from termwright.llm.token_counts import PieceEncoder


@dataclass(frozen=True)
class Band:
    """What is accepted: characters per token, byte-fallback share, entropy of the tokens as a share of the most that as many tokens, or ``ENTROPY_TOKENS``, can have."""

    least_chars: float
    most_chars: float
    most_bytes: float
    least_entropy: float


#: By vocabulary and language, and by script for other languages. The least values of a language lie where 0.2 % of the good documents
#: in ``labels`` at sf 0.1 (2,027 en, 493 de, 498 fr, 312 es) fall below; a script has wide ones, as nothing was measured.
BANDS = {
    "piece_bpe_32k.model": {
        "en": Band(2.30, 8.0, 0.05, 0.675),
        "de": Band(1.87, 8.0, 0.06, 0.655),
        "fr": Band(2.04, 8.0, 0.06, 0.655),
        "es": Band(1.94, 8.0, 0.06, 0.660),
        "latin": Band(1.1, 8.0, 0.10, 0.50),
        "cyrillic": Band(1.0, 8.0, 0.10, 0.50),
        "cjk": Band(0.25, 4.0, 0.80, 0.45),
        "other": Band(0.2, 8.0, 1.0, 0.35),
    },
    "byte_bpe_multi_50k.tiktoken": {
        "en": Band(2.49, 8.0, 0.05, 0.685),
        "de": Band(2.46, 8.0, 0.06, 0.670),
        "fr": Band(2.19, 8.0, 0.06, 0.663),
        "es": Band(2.18, 8.0, 0.06, 0.660),
        "latin": Band(1.1, 8.0, 0.10, 0.50),
        "cyrillic": Band(0.8, 8.0, 0.30, 0.50),
        "cjk": Band(0.25, 4.0, 0.90, 0.45),
        "other": Band(0.2, 8.0, 1.0, 0.35),
    },
}
#: The entropy of longer texts no longer grows with their length: their share is of the logarithm of this number.
ENTROPY_TOKENS = 1024
#: A document of n tokens gets bands wider by this number over the root of n, as the measures of short texts vary more.
WIDER = 0.5

_SYMBOL = re.compile(r"[#*$%&|<>]")
_SCRIPTS = (("cjk", re.compile("[぀-ヿ㐀-䶿一-鿿가-힯]")), ("cyrillic", re.compile("[Ѐ-ӿ]")), ("latin", re.compile("[A-Za-zÀ-ɏ]")))


def repeated_words(words: list, window: int = 5) -> int:
    """How many words lie in windows of ``window`` words that occur twice or more."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    number: dict = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
    # Exact ids of windows: word numbers side by side in 62 bits; what doesn't fit is numbered afresh on the way.
    own, bits = ids, len(number).bit_length()
    wide = bits
    for k in range(1, window):
        if wide + bits > 62:
            own = np.unique(own, return_inverse=True)[1]
            wide = len(own).bit_length()
        own = (own[:-1] << bits) | ids[k:]
        wide += bits
    ordered = np.sort(own)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(twice):
        return 0
    often = np.isin(own, twice)
    edge = np.zeros(len(words) + 1, np.int64)
    at = np.flatnonzero(often)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + window, -1)
    return int((np.cumsum(edge)[:-1] > 0).sum())


def repeated_lines(text: str) -> int:
    """How many lines with a word equal an earlier line."""
    lines = [x for x in text.split("\n") if x.strip(" \t\n\r\x0b\x0c")]
    return len(lines) - len(set(lines))


def script(text: str) -> str:
    """The script of most of the text's letters; ``other`` if it has none of those known."""
    counts = [(len(p.findall(text)), name) for name, p in _SCRIPTS]
    most, name = max(counts, key=lambda x: x[0])
    return name if most else "other"


def fertility(ids: np.ndarray, n_chars: int, byte_ids: np.ndarray) -> tuple[float, float, float]:
    """Characters per token, byte-fallback share, and the entropy as a share of log2 of the number of tokens, of ``ENTROPY_TOKENS`` at most."""
    n = len(ids)
    if not n:
        return 0.0, 0.0, 0.0
    counts = np.bincount(ids)
    as_bytes = counts[byte_ids[byte_ids < len(counts)]].sum() / n
    p = counts[counts > 0] / n
    return n_chars / n, float(as_bytes), float(-(p * np.log2(p)).sum() / np.log2(min(max(n, 2), ENTROPY_TOKENS)))


def within(band: Band, n_tokens: int, chars: float, as_bytes: float, entropy: float) -> bool:
    """The measures of a text of ``n_tokens`` tokens lie in the band, which is the wider the fewer these are."""
    slack = WIDER / math.sqrt(max(1, n_tokens))
    return band.least_chars * (1 - slack) <= chars <= band.most_chars * (1 + slack) and as_bytes <= band.most_bytes + slack and entropy >= band.least_entropy * (1 - slack)


class Pieces(PieceEncoder):
    """A sentencepiece vocabulary. Line ends have no piece of their own: they are bytes in any text, and count as none."""

    def measured(self, texts: list[str]) -> list[np.ndarray]:
        found = [np.frombuffer(x, "<u4") for x in self.encode_batch(texts)]
        return [x[x != self.byte_ids[10]] for x in found]


class Ranks:
    """A byte-level vocabulary given as ranks; ids of single bytes beyond ASCII are its byte fallback."""

    #: A text with a run of one class this long is split here, and what is long merged here: the library's time grows with the square of a run.
    RUN = 10_000

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.byte_ids = np.array([i for x, i in self.ranks.items() if len(x) == 1 and x[0] > 127])
        self.library = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=self.ranks, special_tokens={})
        self.long = re.compile(r"\S{%d}|\s{%d}" % (self.RUN, self.RUN))
        self.split = regex.compile(PATTERN)

    def measured(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(self._parts(t) if len(t) >= self.RUN and self.long.search(t) else self.library.encode_ordinary(t), np.int64) for t in texts]

    def _parts(self, text: str) -> list[int]:
        out: list[int] = []
        for m in self.split.finditer(text):
            part = m[0]
            out += self.library.encode_ordinary(part) if len(part) < 100 else self.merged(part.encode())
        return out

    def merged(self, part: bytes) -> list[int]:
        """The ids of one pre-token of any length, in time n log n: the pair of the lowest rank, of equal ones the first, until none is left."""
        if part in self.ranks:
            return [self.ranks[part]]
        pieces: list[bytes | None] = [part[i : i + 1] for i in range(len(part))]
        after, before = [*range(1, len(part) + 1)], [*range(-1, len(part) - 1)]
        rank = lambda i: self.ranks.get(pieces[i] + pieces[after[i]]) if after[i] < len(part) else None
        heap = [(r, i) for i in range(len(part)) if (r := rank(i)) is not None]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            # A pair that has changed since is out of date.
            if pieces[i] is None or rank(i) != r:
                continue
            j = after[i]
            pieces[i] += pieces[j]
            pieces[j], after[i] = None, after[j]
            if after[i] < len(part):
                before[after[i]] = i
            for k in (before[i], i):
                if k >= 0 and (x := rank(k)) is not None:
                    heapq.heappush(heap, (x, k))
        return [self.ranks[p] for p in pieces if p is not None]


def vocabulary(path: str) -> Pieces | Ranks:
    return kept(("fertility", path), lambda: (Pieces if path.endswith(".model") else Ranks)(path))


def measured(df: DataFrame, paths: list[str], text: str = "text", lang: str | None = "lang", bands: dict[str, dict[str, Band]] | None = None) -> DataFrame:
    """``df``, its texts kept, with the counts, the measures under each vocabulary of ``paths``, and ``kept``.

    Words are ``[^\\x20\\x09-\\x0D]+``. ``base_failed`` is true if there are fewer than 10, or over 20 %
    of them lie in repeated windows of five. A document that passes is kept if its measures lie, under every vocabulary,
    within the band of its ``lang`` (where there is none, or no such column, of its script); short texts have wider bands. The
    measures of the first vocabulary are ``n_tokens``, ``chars_per_token``, ``byte_share`` and ``token_entropy``, those of the k-th have the suffix ``_k``.
    A null or empty text has no words: it fails. Each row is judged alone, so repeated rows get equal results; columns named as an
    added one give way. An empty table gives no rows; a text is read whole, whatever its length.
    """
    bands = BANDS if bands is None else bands
    own = [bands[os.path.basename(p)] for p in paths]
    added = T.StructType()
    for name, kind in (("n_words", "long"), ("word_chars", "long"), ("n_symbols", "long"), ("n_dup_lines", "long"), ("n_repeat_words", "long"), ("base_failed", "boolean")):
        added = added.add(name, kind)
    for k in range(len(paths)):
        for name, kind in (("n_tokens", "long"), ("chars_per_token", "double"), ("byte_share", "double"), ("token_entropy", "double")):
            added = added.add(name + (f"_{k + 1}" if k else ""), kind)
    added = added.add("kept", "boolean")

    def make(texts, langs=None):
        vocabularies = [vocabulary(p) for p in paths]
        ids = [v.measured(texts) for v in vocabularies]
        rows = []
        for at, t in enumerate(texts):
            words = t.encode().split()
            n, repeated = len(words), repeated_words(words)
            failed = n < 10 or 100 * repeated > 20 * n
            good, measures, written_in = not failed, [], None
            for v, found, by in zip(vocabularies, ids, own):
                n_tokens = len(found[at])
                chars, as_bytes, entropy = fertility(found[at], len(t), v.byte_ids)
                if good:
                    band = by.get(langs[at]) if langs else None
                    if band is None:
                        written_in = written_in or script(t)
                        band = by[written_in]
                    good = within(band, n_tokens, chars, as_bytes, entropy)
                measures += [n_tokens, round(chars, 6), round(as_bytes, 6), round(entropy, 6)]
            rows.append((n, len(b"".join(words).decode()), len(_SYMBOL.findall(t)), repeated_lines(t), repeated, failed, *measures, good))
        return [list(c) for c in zip(*rows)] if rows else [[] for _ in added.fields]

    return extended(df, make, [text] + ([lang] if lang in df.columns else []), added, drop=False)


#: Bands that accept everything.
OPEN = Band(0.0, float("inf"), 1.0, 0.0)


def bands_of(good: DataFrame, paths: list[str], text: str = "text", lang: str = "lang", share: float = 0.002, least: int = 100) -> dict[str, dict[str, Band]]:
    """Bands for :func:`measured` from documents that are known to be good: for each vocabulary of ``paths`` and each value of ``lang``, ``share`` of them lie beyond each edge.

    The slack of short texts is taken out of the measures first, as it is put in when a document is judged. Languages with fewer than
    ``least`` documents, and documents without one, get no band of their own: scripts keep those of :data:`BANDS`, or wide ones for a vocabulary that has none there. Only the edges come to
    the driver, four numbers for each language and vocabulary.
    """
    names = [os.path.basename(p) for p in paths]
    own = measured(good.select(F.col(f"`{lang}`").cast("string").alias("lang"), F.col(f"`{text}`").alias("text")), paths, bands={n: {"other": OPEN, "latin": OPEN, "cyrillic": OPEN, "cjk": OPEN} for n in names}, lang=None)
    own = own.where("not base_failed and lang is not null")
    out = {n: {k: b for k, b in BANDS.get(n, dict.fromkeys(("latin", "cyrillic", "cjk", "other"), OPEN)).items() if k in ("latin", "cyrillic", "cjk", "other")} for n in names}
    edges = []
    for k in range(len(names)):
        of = lambda c, k=k: F.col(c + (f"_{k + 1}" if k else ""))
        slack = F.least(F.lit(WIDER) / F.sqrt(F.greatest(of("n_tokens"), F.lit(1))), F.lit(0.95))
        for name, value, at in (("low", of("chars_per_token") / (1 - slack), share), ("high", of("chars_per_token") / (1 + slack), 1 - share), ("bytes", of("byte_share") - slack, 1 - share), ("entropy", of("token_entropy") / (1 - slack), share)):
            edges.append(F.percentile_approx(value, F.lit(at), F.lit(100_000)).alias(f"{name}{k}"))
    for r in own.groupBy("lang").agg(F.count("*").alias("n"), *edges).where(F.col("n") >= least).collect():
        for k, n in enumerate(names):
            out[n][r["lang"]] = Band(r[f"low{k}"], r[f"high{k}"], max(0.0, r[f"bytes{k}"]), r[f"entropy{k}"])
    return out
