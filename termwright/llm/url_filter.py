"""URL filters by a bit-parallel wildcard automaton.

All glob rules are packed side by side into one multiword Shift-And automaton: a bit for each state
of each rule, so that one shift and one mask per byte move every rule of every URL of a batch. Literal rules are held against a
URL's host and path as they stand, globs against its canonical form.
"""

from __future__ import annotations

from collections.abc import Sequence

import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from termwright.llm._shared import extended, kept

#: Rules for URLs that no listed rule fits: (glob over the canonical ``.host/path``, verdict); the longest glob that fits wins.
DEFAULT_GLOBS: tuple[tuple[str, str], ...] = (
    ("*", "allow"),
    ("*.spam-*", "block"),
    ("*.spam?*.*", "block"),
    ("*casino*", "block"),
    ("*/login*", "block"),
    ("*/cart/*", "block"),
    ("*.exe", "block"),
    ("*.zip", "block"),
)


#: The end of a host, in a rule's glob and as the byte of a text; no UTF-8 text has it.
END, END_BYTE = "\udcff", 0xFF


class GlobAutomaton:
    """Simulates all ``globs`` (``*`` any run, ``?`` any byte) over batches of byte strings.

    Only ``END`` fits ``END_BYTE``: no wildcard before it crosses that byte. Globs without ``END`` do not see the byte.
    """

    def __init__(self, globs: Sequence[str]):
        cells: list[tuple[int, bool, bool]] = []  # (byte, 256 for any, -1 for a start; loops; ends a rule)
        self.ends = []
        blind: list[bool] = []
        for g in globs:
            raw, own = g.encode("utf-8", "surrogateescape"), [[-1, False]]
            for b in raw:
                if b == ord("*"):
                    own[-1][1] = True
                else:
                    own.append([256 if b == ord("?") else b, False])
            cells += [(b, loop, False) for b, loop in own]
            blind += [END not in g] * len(own)
            self.ends.append(len(cells) - 1)
        self.words = -(-len(cells) // 64)
        self.start, self.loops = self._mask([c[0] == -1 for c in cells]), self._mask([c[1] for c in cells])
        self.blind = self._mask(blind)
        self.masks = np.stack([self._mask([c[0] == b or c[0] == 256 and b != END_BYTE for c in cells]) for b in range(256)])

    def _mask(self, bits: list[bool]) -> np.ndarray:
        padded = np.zeros(self.words * 64, bool)
        padded[: len(bits)] = bits
        return np.packbits(padded, bitorder="little").view("<u8").astype(np.uint64)

    def fits(self, texts: Sequence[bytes]) -> np.ndarray:
        """For each text and glob whether the glob fits the whole text."""
        out = np.zeros((len(texts), len(self.ends)), bool)
        sizes = np.array([*map(len, texts)], np.int64)
        # Texts of similar length run together: rows are padded to less than twice their length.
        for bits in np.unique(np.ceil(np.log2(sizes + 1)).astype(int)) if len(texts) else ():
            rows = np.flatnonzero(np.ceil(np.log2(sizes + 1)).astype(int) == bits)
            for at in range(0, len(rows), step := max(1, 4_000_000 >> int(bits))):
                some = rows[at : at + step]
                out[some] = self._run([texts[i] for i in some], sizes[some])
        return out

    def _run(self, texts: list[bytes], sizes: np.ndarray) -> np.ndarray:
        longest = int(sizes.max(initial=0))
        chars = np.zeros((len(texts), longest), np.uint8)
        chars[np.arange(longest) < sizes[:, None]] = np.frombuffer(b"".join(texts), np.uint8)
        state = np.tile(self.start, (len(texts), 1))
        order = np.argsort(-sizes, kind="stable")  # the texts that still run come first
        state, chars, left = state[order], chars[order], sizes[order]
        for k in range(longest):
            n = int(np.searchsorted(-left, -k, "left"))
            now = state[:n]
            moved = now << np.uint64(1)
            moved[:, 1:] |= now[:, :-1] >> np.uint64(63)
            held = np.where((chars[:n, k] == END_BYTE)[:, None], self.blind, self.loops)
            state[:n] = (moved & self.masks[chars[:n, k]]) | (now & held)
        ends = np.array(self.ends)
        found = (state[:, ends // 64] >> (ends % 64).astype(np.uint64)) & np.uint64(1)
        out = np.empty(found.shape, bool)
        out[order] = found == 1
        return out


def rule_glob(host: str, path: str) -> str:
    """The glob over ``.host``, the host's end and the path that fits a host, its subdomains and all paths that start with ``path``."""
    return f"*.{host}{END}{path}*"


def split_url(url: str) -> tuple[str, str]:
    """Host (A-Z in lower case) and path of a URL; both empty where ``://`` is missing."""
    _, mark, rest = url.partition("://")
    if not mark:
        return "", ""
    end = min((at for c in "/?#" if (at := rest.find(c)) >= 0), default=len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:end])
    path = rest[end:]
    return host, path[: min((at for c in "?#" if (at := path.find(c)) >= 0), default=len(path))]


_ESCAPE = re.compile("%([0-9A-Fa-f]{2})")
#: Characters that need no escape, and ports that a scheme has anyway (fixed values).
_UNRESERVED = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-._~")
_PORTS = {"http": "80", "https": "443"}


def _lower(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def canonical(url: str) -> tuple[str, str]:
    """Host and path of a URL as globs see them, A-Z in lower case; both empty where ``://`` is missing.

    The host loses user, password, a port that its scheme has anyway and a last dot. In the path what needs no escape loses it, once, and dot segments are resolved.
    """
    scheme, mark, _ = url.partition("://")
    if not mark:
        return "", ""
    host, path = split_url(url)
    host = host.rpartition("@")[2]
    host = host.removesuffix(":" + _PORTS.get(scheme.lower(), "")).removesuffix(":").removesuffix(".")
    path = _ESCAPE.sub(lambda m: c if (c := chr(int(m[1], 16))) in _UNRESERVED else m[0].upper(), path)
    if "/." in path:
        out: list[str] = []
        parts = path.split("/")
        for k, part in enumerate(parts):
            if part == "..":
                del out[max(1, len(out) - 1) :]
            elif part != ".":
                out.append(part)
            if part in (".", "..") and k == len(parts) - 1:
                out.append("")
        path = "/".join(out)
    return host, _lower(path)


def judged(df: DataFrame, rules: Sequence[tuple[str, str, str]], globs: Sequence[tuple[str, str]] = DEFAULT_GLOBS, url: str = "url") -> DataFrame:
    """``df`` with ``host``, ``path``, ``rule`` and ``verdict`` of each URL, in place of the URL.

    ``rules`` are (verdict, host, path); of those that fit, the one with the most characters decides
    (of equals the first) and is the ``rule``. Where none fits, ``rule`` is null and the longest of
    ``globs`` that fits the :func:`canonical` URL decides (``allow`` if none does). A null URL, or one without ``://``, has an empty host
    and path, fits no rule, and is judged by ``globs`` like any other. Rules must not contain
    ``*`` or ``?``. The number of rules is a parameter of the caller, not of the data. Each row is judged alone, so repeated rows get equal
    results; a URL of any length is read whole; columns named as an added one give way; an empty table gives no rows.
    """
    if bad := [h + p for _, h, p in rules if set("*?") & set(h + p)]:
        raise ValueError(f"rules are literal; wildcards belong into globs: {bad}")
    rules, globs = [*rules], [*globs]
    by_length = lambda xs, size: sorted(range(len(xs)), key=lambda i: -size(xs[i]))
    first = by_length(rules, lambda r: len(r[1] + r[2]))
    then = by_length(globs, lambda g: len(g[0]))
    added = T.StructType().add("host", "string").add("path", "string").add("rule", "string").add("verdict", "string")
    literal, patterns = [rule_glob(*rules[i][1:]) for i in first], [_lower(globs[i][0]) for i in then]

    def found_by(globs: list[str], both: list[tuple[str, str]]) -> list[int]:
        """The place of the first of ``globs`` that fits each URL, or behind the last."""
        automaton = kept(("globs", *globs), lambda: GlobAutomaton(globs))
        # A dot before the host lets one glob fit the host itself and its subdomains.
        found = automaton.fits([f".{h}".encode() + bytes([END_BYTE]) + p.encode() for h, p in both])
        return np.concatenate([found, np.ones((len(both), 1), bool)], axis=1).argmax(1).tolist()

    def make(urls):
        both = [*map(split_url, urls)]
        named, verdicts = [], []
        for r, g in zip(found_by(literal, both), found_by(patterns, [*map(canonical, urls)])):
            rule = rules[first[r]] if r < len(literal) else None
            named.append(rule[1] + rule[2] if rule else None)
            verdicts.append(rule[0] if rule else globs[then[g]][1] if g < len(patterns) else "allow")
        return [[h for h, _ in both], [p for _, p in both], named, verdicts]

    return extended(df, make, url, added)
