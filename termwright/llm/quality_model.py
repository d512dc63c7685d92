"""A weak-label quality classifier.

Overlapping heuristic labellers vote good, bad or nothing on each document. Expectation-maximisation
over the counts of all vote patterns estimates how reliable each is; the posterior labels of a
bounded sample train a hashed linear scorer, and the scorer decides on every document.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from termwright.llm._shared import extended, kept
from termwright.llm.bpe import REMEMBERED

#: Hashed features; behind them stand the dense ones of ``Reader.dense``.
BUCKETS = 1 << 15
DENSE = 5
#: The scorer is fitted on at most so many documents.
TRAIN = 4000
#: Words that every text is taken to have besides its own, which say nothing: by one formula for all lengths, a short text has little to say against it.
SILENT_WORDS = 60
#: Votes of a labeller.
BAD, GOOD, NONE = 0, 1, 2
LABELLERS = ("symbols", "capitals", "repeats", "function words", "sentence ends", "doubled marks", "lines", "variety", "letters")

#: Frequent function words of the languages (fixed values).
FUNCTION_WORDS = frozenset(
    "the of and to in a is that for it was with as on be by this are from at or an not have he she they we you "
    "der die das und in zu den von mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat "
    "le la les de des du et à un une en que qui dans pour pas sur au par est il elle ce avec son plus ne se "
    "el los las y del en un una que por con para su al lo como más se no es o".split()
)
_SYMBOLS = frozenset("#*$%&|<>{}[]\\^~_=")
_MARKS = b"!\"#$%&'()*+,-./0123456789:;<=>?@[\\]^_`{|}~"
_SHAPE = {**{c: "A" for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}, **{c: "0" for c in "0123456789"}}


def shape(word: str) -> str:
    """A word with letters as A or a and digits as 0, runs cut to two."""
    out: list[str] = []
    for c in word:
        s = _SHAPE.get(c) or (("A" if c.isupper() else "a") if c.isalpha() else c)
        if len(out) < 2 or out[-1] != s or out[-2] != s:
            out.append(s)
    return "".join(out)


class Words(dict):
    """For each word its flags (8 bits), the bucket of the word and of its shape (24 bits each)."""

    def __missing__(self, word: str) -> int:
        bare = word.strip(".,;:!?\"'()")
        flags = bool(_SYMBOLS & set(word)) | (bare.isupper() and len(bare) > 1) << 1 | (bare in FUNCTION_WORDS or bare.lower() in FUNCTION_WORDS and bare.istitle()) << 2
        flags |= word.endswith((".", "?", "!")) << 3 | word.endswith("!!") << 4
        at = zlib.crc32(bare.lower().encode()) % BUCKETS << 8 | zlib.crc32(shape(word).encode(), 7) % BUCKETS << 32
        self[word] = found = flags | at
        return found


class Reader:
    def __init__(self):
        self.words = Words()

    def read(self, text: str) -> np.ndarray:
        if len(self.words) > REMEMBERED:
            self.words.clear()
        own = text.split()
        return np.fromiter(map(self.words.__getitem__, own), np.int64, len(own))


def shares(words: np.ndarray, text: str) -> tuple[float, ...]:
    """Shares of words: with symbols, in capitals, equal to the word before, function words, ending a sentence, with doubled marks; of lines that repeat; of distinct words."""
    n = max(1, len(words))
    flag = [float(((words >> k) & 1).sum()) / n for k in range(5)]
    lines = [x for x in text.split("\n") if x.strip()]
    ordered = np.sort(words)
    distinct = np.count_nonzero(ordered[1:] != ordered[:-1]) + (len(words) > 0)
    return (flag[0], flag[1], float((words[1:] == words[:-1]).sum()) / n, flag[2], flag[3], flag[4], 1 - len(set(lines)) / max(1, len(lines)), distinct / n)


def votes(words: np.ndarray, text: str, own: tuple[float, ...] | None = None) -> int:
    """The votes of all labellers in one number, to the base of three.

    A vote stands only if it would be the same with one word (line) more or less on its side: so short
    texts get few votes, by the same thresholds as all. ``own`` are the text's :func:`shares`, if they are known.
    """
    symbols, capitals, repeats, function, ends, doubled, lines, distinct = own or shares(words, text)
    n = max(1, len(words))
    one, line = 1 / n, 1 / (text.count("\n") + 1)
    raw = text.encode()
    letters = 1 - (len(raw) - len(raw.translate(None, _MARKS))) / max(1, len(text))

    def vote(bad: bool, good: bool) -> int:
        return BAD if bad else GOOD if good else NONE

    own = (
        vote(symbols - one > 0.15, symbols + one < 0.03),
        vote(capitals - one > 0.5, capitals + one < 0.2),
        vote(repeats - one > 0.1, repeats + one < 0.03),
        vote(function + one < 0.05, function - one > 0.1),
        vote(ends + one < 0.015 or ends - one > 0.5, 0.03 + one < ends < 0.3 - one),
        vote(doubled - one > 0.2, doubled + one < 0.05),
        vote(lines - line > 0.3, lines + line < 0.1),
        vote(distinct + one < min(0.3, 10 / math.sqrt(n)), distinct - one > min(0.5, 50 / math.sqrt(n))),
        vote(letters + one < 0.87, letters - one > 0.93),
    )
    return sum(v * 3**k for k, v in enumerate(own))


def unpack(pattern: int) -> list[int]:
    return [pattern // 3**k % 3 for k in range(len(LABELLERS))]


def posteriors(counts: dict[int, int], rounds: int = 100, weight: float = 0.02) -> tuple[dict[int, float], np.ndarray, float]:
    """The probability of good for each pattern, the votes' probabilities (labeller, class, vote) and the share of good documents.

    ``counts`` are those of all patterns, of which there are no more than 3 to the number of
    labellers, whatever the corpus. The prior, of ``weight`` of all documents, keeps the classes what they are
    called where hardly any document is bad. A labeller that says nothing counts for nothing.
    """
    patterns = sorted(counts)
    n = np.array([counts[p] for p in patterns], float)
    own = np.array([unpack(p) for p in patterns], int).reshape(len(patterns), len(LABELLERS))
    prior = np.array([[0.5, 0.5], [0.02, 0.98]])
    strength = weight * n.sum() + 1
    table, good = np.tile(prior, (len(LABELLERS), 1, 1)), 0.9
    said = own != NONE
    at = np.ones(len(n))
    for _ in range(rounds):
        log = np.log(np.array([1 - good, good])) + np.array([(np.log(table[np.arange(len(LABELLERS)), c, np.where(said, own, GOOD)]) * said).sum(1) for c in (0, 1)]).T
        log -= log.max(1, keepdims=True)
        p = np.exp(log) / np.exp(log).sum(1, keepdims=True)
        if np.abs(p[:, 1] - at).max(initial=0) < 1e-9:
            break
        at = p[:, 1]
        good = (n @ at + 0.9 * strength) / (n.sum() + strength)
        for k in range(len(LABELLERS)):
            for c in (0, 1):
                got = np.bincount(own[said[:, k], k], weights=(n * p[:, c])[said[:, k]], minlength=2) + strength * prior[c]
                table[k, c] = got / got.sum()
    return dict(zip(patterns, at.tolist())), table, float(good)


def features(words: np.ndarray, text: str, own: tuple[float, ...] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and values of a document: shares of its words and shapes, and the dense ones. No more than ``BUCKETS`` + ``DENSE``, however long the text."""
    n = SILENT_WORDS + len(words)
    hashed = np.sort(np.concatenate([(words >> 8) & 0xFFFFFF, words >> 32]).astype(np.int32))
    first = np.flatnonzero(np.concatenate([[len(hashed) > 0], hashed[1:] != hashed[:-1]])[: len(hashed)])
    at, counts = hashed[first], np.diff(np.append(first, len(hashed)))
    s = own or shares(words, text)
    dense = np.array([1.0, s[2], s[6], s[0], s[1]])
    return np.concatenate([at, np.arange(BUCKETS, BUCKETS + DENSE)]), np.concatenate([counts / n, dense])


def fit(rows: list[tuple[np.ndarray, np.ndarray, float, float]], rounds: int = 300, rate: float = 0.5, decay: float = 1e-5) -> np.ndarray:
    """Weights of a logistic scorer by full-batch Adam; ``rows`` are buckets, values, the posterior and the row's weight."""
    w = np.zeros(BUCKETS + DENSE)
    w[BUCKETS] = 2.0
    if not rows:
        return w
    row = np.repeat(np.arange(len(rows)), [len(r[0]) for r in rows])
    at, x, y = np.concatenate([r[0] for r in rows]).astype(np.int64), np.concatenate([r[1] for r in rows]), np.array([r[2] for r in rows])
    own = np.array([r[3] for r in rows])
    own = own / own.sum()
    m, v = np.zeros_like(w), np.zeros_like(w)
    for k in range(1, rounds + 1):
        p = 1 / (1 + np.exp(-np.clip(np.bincount(row, weights=w[at] * x, minlength=len(rows)), -30, 30)))
        g = np.bincount(at, weights=((p - y) * own)[row] * x, minlength=len(w)) + decay * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= rate * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.999**k)) + 1e-8)
    return w


def voted(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with ``votes``, the labellers' pattern, in place of its texts (null: empty, no vote)."""

    def make(texts):
        reader = kept("quality", Reader)
        return [[votes(reader.read(t), t) for t in texts]]

    return extended(df, make, text, T.StructType().add("votes", "integer"))


class Model:
    """What is learnt: the posterior of each vote pattern, the labellers' table, the scorer's weights."""

    def __init__(self, posterior: dict[int, float], table: np.ndarray, good: float, weights: np.ndarray):
        self.posterior, self.table, self.good, self.weights = posterior, table, good, weights


def trained(df: DataFrame, text: str = "text", most: int = TRAIN) -> Model:
    """Counts the votes on all documents, estimates the labellers, and fits the scorer on at most ``most`` different texts.

    The sample is drawn by a hash of the text alone, so it is the same for any partitioning and whatever
    columns stand beside it. A text that is repeated is in it once, and weighs one more than the logarithm of its copies. Its documents go through the driver as hashed features, 4 + 4 bytes each: a long text has at most
    ``BUCKETS`` of them, an ordinary one some hundreds. An empty table gives a model that keeps everything.
    """
    own = df.select(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
    counts = {r["votes"]: r["count"] for r in voted(own).groupBy("votes").count().collect()}
    posterior, table, good = posteriors(counts)
    # How many texts there are is needed roughly only: it says which share of them is drawn.
    total = own.agg(F.approx_count_distinct(F.xxhash64("text"))).first()[0]
    drawn = F.pmod(F.xxhash64(F.lit(17), "text"), F.lit(1_000_000))
    share = math.ceil(1_000_000 * min(1.0, 1.25 * most / max(1, total)))
    sample = own.where(drawn < share).groupBy(drawn.alias("drawn"), F.md5(F.col("text").cast("binary")).alias("digest")).agg(F.first("text").alias("text"), F.count("*").alias("copies"))

    def make(texts):
        reader = kept("quality", Reader)
        read = [reader.read(t) for t in texts]
        found = [features(w, t) for w, t in zip(read, texts)]
        return [[votes(w, t) for w, t in zip(read, texts)], [a.astype("<i4").tobytes() for a, _ in found], [x.astype("<f4").tobytes() for _, x in found]]

    rows = extended(sample, make, "text", T.StructType().add("votes", "integer").add("at", "binary").add("x", "binary")).orderBy("drawn", "digest").limit(most).collect()
    weights = fit([(np.frombuffer(r["at"], "<i4"), np.frombuffer(r["x"], "<f4"), posterior.get(r["votes"], good), 1 + math.log(r["copies"])) for r in rows])
    return Model(posterior, table, good, weights)


def scored(df: DataFrame, model: Model, text: str = "text", least: float = 0.5) -> DataFrame:
    """``df``, its texts kept, with ``score`` (0 to 1) and ``kept`` (a score of at least ``least``).

    A null or empty text has only the scorer's constant. Each row is judged alone, so repeated rows
    get equal results; columns named as an added one give way. An empty table gives no rows; a text is
    read whole, whatever its length.
    """
    weights = model.weights

    def make(texts):
        reader = kept("quality", Reader)
        out = []
        for t in texts:
            at, x = features(reader.read(t), t)
            out.append(round(1 / (1 + math.exp(-max(-30.0, min(30.0, float(weights[at] @ x))))), 6))
        return [out, [x >= least for x in out]]

    return extended(df, make, text, T.StructType().add("score", "double").add("kept", "boolean"), drop=False)
