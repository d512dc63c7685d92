"""The operators of the text preparation package against brute force and on hard inputs."""

import base64
import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import sentencepiece
import tiktoken
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from termwright.llm import bpe, chat_format, near, packing, pii, quality_model, quality_rules, queries, simhash, syncmers, token_counts, url_filter
from termwright.llm.packing import PATTERN

SF = "/root/testdata/sf0.001"
LONG = "lorem ipsum dolor " * 4000
HARD = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "Hello  world\n\n a"), (5, "Hello  world\n\n a"), (6, "日本語 テキスト <|endoftext|> x"), (7, LONG), (8, "x" * 3000), (None, "no id here at all"), (9, "### a </turn> \\ b"), (10, "é ́e ΣΑΣ İ ﬁ 🙂 \x1c \x85y\xa0z")]


@pytest.fixture(scope="module")
def hard(spark):
    """Nulls, empty and long texts, repeated rows, and columns named like those that are added."""
    names = ["n_tokens", "kept", "ids", "score", "simhash", "rule", "host", "votes"]
    return spark.createDataFrame([(i, t, "en", *["clash"] * len(names)) for i, t in HARD], "doc_id long, text string, lang string, " + ", ".join(f"{n} string" for n in names))


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def none(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string")


def texts_of(docs):
    return {r.doc_id: r.text or "" for r in docs.collect()}


# -- 1 chat formatting ---------------------------------------------------------------------------


def turns(spark):
    rows = [(1, 0, "system", "be brief"), *[(1, i, "assistant" if i % 2 == 0 else "user", f"text {i} " * 90) for i in range(1, 60)]]
    rows += [(2, None, None, None), (2, 5, "a:b\\c", "## ### </turn>\n</turn>\\"), (2, 5, "a:b\\c", "## ### </turn>\n</turn>\\"), (None, 1, "assistant", ""), (3, 7, "assistant", LONG), (4, 1, "system", "late"), (4, 0, "user", "u")]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def test_chat_round_trip(spark):
    df = turns(spark)
    windows = chat_format.chat_windows(df.withColumn("win", F.lit(1)), budget=2400)
    got = {r.conv_id: r for r in chat_format.digests(windows).collect()}
    want = {}
    for r in df.collect():
        want.setdefault(r.conv_id, []).append((-1 if r.turn is None else r.turn, r.role or "", r.text or ""))
    assert set(got) == set(want)
    for conv, own in want.items():
        own.sort()
        said = "".join(f"{role}\n{text}\n" for _, role, text in own)
        loss = "".join(text for _, role, text in own if role == "assistant")
        assert got[conv].n_turns == len(own)
        assert got[conv].turns_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert (got[conv].loss_chars, got[conv].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_chat_windows_keep_the_budget(spark):
    rows = chat_format.chat_windows(turns(spark), budget=2400).where("conv_id = 1").orderBy("first_idx").collect()
    assert len(rows) > 5 and all(r.over_budget == (r.tokens > 2400) for r in rows)
    assert rows[0].n_system == 0 and all(r.n_system == 1 and r.formatted.startswith("### system: be brief</turn>\n") for r in rows[1:])
    assert any(r.n_history for r in rows) and all(not r.over_budget for r in rows)
    assert chat_format.chat_windows(turns(spark).limit(0)).count() == 0


def test_chat_windows_hold_no_more_tokens_than_they_say(spark):
    said = spark.read.parquet(f"{SF}/conversations.parquet").unionByName(turns(spark))
    rows = chat_format.chat_windows(said, budget=1500).collect()
    texts = [r.formatted for r in rows]
    byte, word = (Tokenizer.from_file(queries.vocabulary(n)) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))
    piece = sentencepiece.SentencePieceProcessor(model_file=queries.vocabulary("piece_bpe_32k.model"))
    for counts in ([len(e.ids) for e in byte.encode_batch(texts, add_special_tokens=False)], [len(e.ids) for e in word.encode_batch(texts, add_special_tokens=False)], [len(x) - 1 for x in piece.encode(texts)]):
        assert all(n <= r.tokens for n, r in zip(counts, rows))
    assert any(not r.over_budget for r in rows) and any(r.over_budget for r in rows) and all(r.over_budget == (r.tokens > 1500) for r in rows)
    given = chat_format.chat_windows(turns(spark).withColumn("n", F.when(F.col("turn") > 0, F.lit(7))), budget=100, tokens="n").where("conv_id = 1").agg(F.max("n_own")).collect()[0][0]
    assert 7 <= given <= 8


def test_hard_conversation(spark):
    r = queries.op1_chat_format(spark, SF).where("conv_id = -7").collect()[0]
    text = "\\### Assistant: </turn> ok"
    assert r.n_turns == 2 and r.loss_sha256 == hashlib.sha256(text.encode()).hexdigest() and r.loss_chars == len(text)


# -- 2 SimHash -------------------------------------------------------------------------------------


def brute_simhash(text):
    words = re.findall("[^\x20\x09-\x0d]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash(spark, docs, hard):
    base = docs.select("doc_id", "text")
    near = base.where("doc_id < 20").select((F.col("doc_id") + 10_000).alias("doc_id"), F.concat("text", F.lit(" extra")).alias("text"))
    df = base.union(near).union(hard.where("doc_id is not null").select((F.col("doc_id") + 20_000).alias("doc_id"), "text"))
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.near_duplicates(df).collect()}
    prints = {r.doc_id: brute_simhash(r.text or "") for r in df.collect()}
    assert {i: f"{p:016x}" for i, p in prints.items()} == {i: p for i, (p, _) in got.items()}
    ids = sorted(prints)
    f = np.array([prints[i] for i in ids], np.uint64)
    label = np.array(ids)
    near_of = [np.flatnonzero(np.bitwise_count(f ^ x) <= 4) for x in f]
    while True:
        new = np.array([label[n].min() for n in near_of])
        if (new == label).all():
            break
        label = new
    assert {i: int(c) for i, c in zip(ids, label)} == {i: c for i, (_, c) in got.items()}


def test_stars_connect_what_pairs_connect():
    rng = np.random.default_rng(1)
    a = np.unique(rng.integers(0, 1 << 9, 300).astype(np.uint64))
    x = np.arange(len(a), dtype=np.int64) * 3
    src, dst = simhash.stars(a, x, a, x, 1)
    assert len(src) < len(a)
    root = {int(i): int(i) for i in x}
    find = lambda i: i if root[i] == i else find(root[i])
    for s, d in zip(src.tolist(), dst.tolist()):
        p, q = sorted((find(s), find(d)))
        root[q] = p
    want = {int(i): int(i) for i in x}
    for _ in range(len(a)):
        new = {int(x[i]): min(want[int(x[j])] for j in np.flatnonzero(np.bitwise_count(a ^ a[i]) <= 1)) for i in range(len(a))}
        if new == want:
            break
        want = new
    assert {i: find(i) for i in root} == want


def test_components_of_a_long_chain(spark):
    links = spark.range(60).select(F.col("id").alias("src"), (F.col("id") + 1).alias("dst"))
    assert {(r.node, r.component) for r in simhash.components(links).collect()} == {(i, 0) for i in range(61)}
    assert simhash.components(links.limit(0)).count() == 0 and simhash.near_duplicates(none(spark)).count() == 0


# -- 3 syncmers --------------------------------------------------------------------------------------


def test_syncmers(spark, docs, hard):
    got = {r.doc_id: r for r in syncmers.compared(docs).collect()}
    own = sorted(texts_of(docs).items(), reverse=True)
    for k, (i, t) in enumerate(own):
        n = own[(k + 1) % len(own)][1]
        half = len(t) // 2
        edited = t[: len(t) - half] + n[:half]
        assert got[i].n_chars == len(t) and got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
    by_text = {}
    for i, t in own:
        assert by_text.setdefault(t, got[i].fingerprint) == got[i].fingerprint
    long_ones = [r for r in got.values() if r.n_chars > 1500]
    assert np.mean([r.near_edited for r in long_ones]) > 0.2 > np.mean([r.near_next for r in long_ones])
    rows = syncmers.compared(hard).collect()
    assert len(rows) == len(HARD) and all(0 <= r.near_next <= 1 and 0 <= r.near_edited <= 1 for r in rows)
    assert syncmers.compared(none(spark)).count() == 0


UNIT = re.compile("[\u0e00-\u0e7f\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uac00-\ud7af]|[^\\s\u0e00-\u0e7f\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uac00-\ud7af]+", re.ASCII)


def chained(*values):
    h = 42
    for v in values:
        h = xxhash.xxh64_intdigest(v.encode() if isinstance(v, str) else int(v).to_bytes(8, "little", signed=True), h)
    return h - (1 << 64) if h >> 63 else h


def brute_marks(text):
    own = UNIT.findall(text.lower())
    if 0 < len(own) < 5:
        found = [chained(" ".join(own))]
    else:
        inner = [chained(*own[i : i + 2]) for i in range(len(own) - 1)]
        found = []
        for i in range(len(own) - 4):
            four = inner[i : i + 4]
            if min(four) in (four[0], four[3]):
                found.append(chained(four[0], four[2], four[3]))
    return list(dict.fromkeys(f"{(h >> 32) & 0xFFFFFFFF:08x}" for h in found))


def brute_likeness(a, b):
    if not a and not b:
        return 1.0
    at = {h: i for i, h in enumerate(b)}
    pairs = [(i, at[h]) for i, h in enumerate(a) if h in at]
    away = [y - x for x, y in pairs]
    n = len(pairs) if min(len(a), len(b)) <= 1 else sum(x in away[max(0, k - 1) : k] or x in away[k + 1 : k + 2] for k, x in enumerate(away))
    return n / (len(a) + len(b) - n)


def test_syncmers_against_brute_force(spark, docs):
    texts = texts_of(docs)
    own = sorted(texts.items(), reverse=True)
    got = {r.doc_id: r for r in syncmers.compared(docs).collect()}
    cut = lambda s: [s[i : i + 8] for i in range(0, len(s), 8)]
    for k, (i, t) in enumerate(own):
        n = own[(k + 1) % len(own)][1]
        half = len(t) // 2
        a, e, b = brute_marks(t), brute_marks(t[: len(t) - half] + n[:half]), brute_marks(n)
        assert cut(got[i].fingerprint) == a and cut(got[i].edited_fingerprint) == e
        assert abs(got[i].near_edited - brute_likeness(a, e)) < 1e-9 and abs(got[i].near_next - brute_likeness(a, b)) < 1e-9


def test_a_passage_of_two_long_texts_is_held(spark):
    rng = random.Random(8)
    words = lambda n: [f"w{rng.randrange(10**5)}" for _ in range(n)]
    passage = words(60)
    a, b, c = words(9000) + passage + words(9000), words(4000) + passage + words(300), words(4000)
    row = spark.createDataFrame([(" ".join(a), " ".join(b), " ".join(c))], "a string, b string, c string").select(*[syncmers.marks(F.col(x)).alias(x) for x in "abc"])
    n, none, same = row.select(syncmers.held(syncmers.matched(F.col("a"), F.col("b"))), syncmers.held(syncmers.matched(F.col("a"), F.col("c"))), syncmers.likeness(F.col("b"), F.col("b"))).collect()[0]
    assert n > 15 and none < 3 and same == 1


def test_anchors_are_context_free(spark):
    words = [f"w{random.Random(3).randrange(10**6)}{i}" for i in range(80)]
    a, b = " ".join(words), "other start here " + " ".join(words[5:]) + " end"
    x, y = ({r["hash"] for r in row[0]} for row in spark.createDataFrame([(a,), (b,)], "t string").select(syncmers.anchors(F.col("t"))).collect())
    assert len(x & y) > 0.7 * len(x)


# -- 4, 7 tokens --------------------------------------------------------------------------------------


def sample_texts(docs):
    rng = random.Random(5)
    some = [t for _, t in sorted(texts_of(docs).items())[:60]]
    return some + [t or "" for _, t in HARD] + ["".join(rng.choice("ab ▁\n日é🙂1.'s<|>X") for _ in range(80)) for _ in range(300)] + ["ab" * 700, "!" * 900, " " * 50 + "x"]


def test_token_counts(spark, docs, hard):
    path = queries.vocabulary("piece_bpe_32k.model")
    texts = sample_texts(docs)
    want = sentencepiece.SentencePieceProcessor(model_file=path).encode(texts)
    got = token_counts.PieceEncoder(path).encode_batch(texts)
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == want
    rows = token_counts.counted(hard, path, limit=5).collect()
    assert len(rows) == len(HARD) and all(r.over_limit == (r.n_tokens > 5) for r in rows)
    assert token_counts.counted(none(spark), path).count() == 0


def test_bpe(spark, docs, hard):
    path = queries.vocabulary("word_bpe_49k.json")
    texts = sample_texts(docs)
    library = Tokenizer.from_file(path)
    encoder = bpe.WordEncoder(path)
    for t, g, w in zip(texts, encoder.encode_batch(texts), library.encode_batch(texts, add_special_tokens=False)):
        assert np.frombuffer(g, "<u4").tolist() == w.ids
        assert encoder.decode(g).decode() == library.decode(w.ids, skip_special_tokens=False)
    assert bpe.encoded(hard, path).count() == len(HARD) and bpe.encoded(none(spark), path, with_ids=False).count() == 0


def test_segment_tree_merges_the_leftmost_lowest():
    rng = random.Random(2)
    pairs = [(a, b) for a in range(6) for b in range(6)]
    rng.shuffle(pairs)
    made = {p: 6 + i for i, p in enumerate(pairs[:20])}
    table = bpe.MergeTable(*(np.array(x) for x in ([a for a, _ in made], [b for _, b in made], range(20), [*made.values()])), size=40)
    rank = {p: i for i, p in enumerate(made)}

    def brute(w):
        while True:
            found = [(rank[p], i) for i, p in enumerate(zip(w, w[1:])) if p in rank]
            if not found:
                return w
            _, i = min(found)
            w = [*w[:i], made[w[i], w[i + 1]], *w[i + 2 :]]

    words = [[rng.randrange(6) for _ in range(n)] for n in (1, 2, 3, 5, 8, 13, 40, 200, 300, 600) for _ in range(20)]
    ids, counts = table.merge(np.array(sum(words, [])), np.array([*map(len, words)]))
    got = [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])]
    assert got == [brute(w) for w in words] == [table.merge_long(w) for w in words]


# -- 5 URL filter -----------------------------------------------------------------------------------


def test_globs():
    rng = random.Random(4)
    globs = ["*", "", "a*b", "*ab*", "?b*", "a?c", "*a?b*c", *("".join(rng.choice("ab*?") for _ in range(rng.randrange(12))) for _ in range(60))]
    texts = ["", "ab", "abc", "a" * 300, *("".join(rng.choice("abc") for _ in range(rng.randrange(40))) for _ in range(200))]
    as_regex = [re.compile("(?s)" + "".join(".*" if c == "*" else "." if c == "?" else re.escape(c) for c in g)) for g in globs]
    want = np.array([[bool(r.fullmatch(t)) for r in as_regex] for t in texts])
    assert (url_filter.GlobAutomaton(globs).fits([t.encode() for t in texts]) == want).all()


def test_url_rules(spark):
    urls = {"http://A.Example.org/en/12": ("a.example.org", "/en/12", "example.org/en/1", "block"), "https://example.org?q=/es/": ("example.org", "", None, "allow"), "http://notexample.org/es/": ("notexample.org", "/es/", "org/", "allow"), "http://x.com/de/#a": ("x.com", "/de/", "com/de/", "block"), None: ("", "", None, "allow"), "org/": ("", "", None, "allow"), "http://w.net/" + "a" * 5000: ("w.net", "/" + "a" * 5000, None, "allow")}
    df = spark.createDataFrame([(u, "clash") for u in urls], "url string, rule string").withColumn("copy", F.col("url"))
    got = {r.copy: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judged(df, queries.URL_RULES).collect()}
    assert got == urls
    assert url_filter.judged(df.limit(0), queries.URL_RULES).count() == 0


def test_url_rules_stay_in_the_host(spark):
    urls = {"http://x.net/a.org/b": (None, "allow"), "http://x.net/www.example.org/es/": (None, "allow"), "http://x.net/a.com/de/": (None, "allow"), "http://y.com/a.org/fr/": (None, "allow"), "http://b.example.org/es/a.com/fr/": ("example.org/es/", "block"), "http://com/de/x": ("com/de/", "block"), "http://a.org": (None, "allow")}
    df = spark.createDataFrame([(u, u) for u in urls], "url string, copy string")
    assert {r.copy: (r.rule, r.verdict) for r in url_filter.judged(df, queries.URL_RULES).collect()} == urls
    globs = (("*", "allow"), ("*.net/a?b", "block"), ("*.com?x", "block"))
    df = spark.createDataFrame([(u, u) for u in ("http://w.net/a.b", "http://w.com/x", "http://w.net/a/.b")], "url string, copy string")
    assert [r.verdict for r in url_filter.judged(df, queries.URL_RULES, globs).orderBy("copy").collect()] == ["block", "block", "allow"]


# -- 6, 8 quality -----------------------------------------------------------------------------------


def test_quality_model(spark, hard):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = quality_model.trained(docs)
    labels = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    got = [(labels[r.doc_id], r.kept) for r in quality_model.scored(docs, model).collect() if r.doc_id in labels]
    good, bad = [k for q, k in got if q], [k for q, k in got if not q]
    assert np.mean(good) > 0.99 and np.mean(bad) < 0.15
    assert quality_model.scored(hard, model).count() == len(HARD)
    empty = quality_model.trained(none(spark))
    assert quality_model.scored(none(spark), empty).count() == 0


def test_labellers_keep_their_sides_without_bad_documents():
    good = sum(quality_model.GOOD * 3**k for k in range(len(quality_model.LABELLERS)))
    posterior, _, share = quality_model.posteriors({good: 1000})
    assert posterior[good] > 0.99 and share > 0.95


def brute_repeats(words):
    grams = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    return len({j for i in range(len(words) - 4) if grams[tuple(words[i : i + 5])] > 1 for j in range(i, i + 5)})


def check_fertility(rows, paths):
    piece = sentencepiece.SentencePieceProcessor(model_file=paths[0])
    with open(paths[1], "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    multi = tiktoken.Encoding("t", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    fallback = ({piece.piece_to_id(f"<0x{b:02X}>") for b in range(256)}, {ranks[bytes([b])] for b in range(128, 256)})
    line = piece.piece_to_id("<0x0A>")
    for r in rows:
        good = not r.base_failed
        for k, ids in enumerate(([i for i in piece.encode(r.text) if i != line], multi.encode_ordinary(r.text))):
            n = len(ids)
            chars, share = (len(r.text) / n, sum(i in fallback[k] for i in ids) / n) if n else (0, 0)
            entropy = -sum(c / n * math.log2(c / n) for c in Counter(ids).values()) / math.log2(min(max(n, 2), 1024)) if n else 0
            s = f"_{k + 1}" if k else ""
            got = r["n_tokens" + s], r["chars_per_token" + s], r["byte_share" + s], r["token_entropy" + s]
            assert got[0] == n and all(abs(x - y) < 2e-6 for x, y in zip(got[1:], (chars, share, entropy)))
            band = quality_rules.BANDS[queries.VOCABULARIES[k]][r.lang]
            wide = 0.5 / math.sqrt(max(1, n))
            good = good and band.least_chars * (1 - wide) <= chars <= band.most_chars * (1 + wide) and share <= band.most_bytes + wide and entropy >= band.least_entropy * (1 - wide)
        assert r.kept == good


def test_bands_reject_bad_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").join(spark.read.parquet("/root/testdata/sf0.01/labels.parquet"), "doc_id")
    rows = [r for r in quality_rules.measured(docs, [queries.vocabulary(v) for v in queries.VOCABULARIES]).collect() if not r.base_failed]
    bad, good = [r.kept for r in rows if not r.quality], [r.kept for r in rows if r.quality]
    assert np.mean(bad) < 0.3 and np.mean(good) > 0.98


def test_quality_rules(spark, docs, hard):
    paths = [queries.vocabulary(v) for v in queries.VOCABULARIES]
    rows = quality_rules.measured(docs, paths).collect()
    check_fertility(rows, paths)
    for r in rows:
        words = re.findall("[^\x20\x09-\x0d]+", r.text)
        seen, dup = set(), 0
        for line in r.text.split("\n"):
            if re.search("[^\x20\x09-\x0d]", line):
                dup += line in seen
                seen.add(line)
        n = brute_repeats(words)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", r.text)), dup, n)
        assert r.base_failed == (len(words) < 10 or 100 * n > 20 * len(words)) and not (r.base_failed and r.kept)
    assert quality_rules.measured(hard, paths).count() == len(HARD) and quality_rules.measured(none(spark).drop("lang"), paths).count() == 0
    rng = random.Random(1)
    for _ in range(200):
        w = [str(rng.randrange(3)) for _ in range(rng.randrange(30))]
        assert quality_rules.repeated_words(w) == brute_repeats(w)
    wide = [str(i) for i in range(70_000)] + ["1", "2", "3", "4", "5"]
    assert quality_rules.repeated_words(wide) == brute_repeats(wide)


# -- 9 personal data ---------------------------------------------------------------------------------


def luhn(digits):
    return sum(v - 9 * (v > 9) for i, c in enumerate(reversed(digits)) for v in [int(c) * (1 + i % 2)]) % 10 == 0


def test_pii(spark, hard):
    text = 'on 2020-02-29, 31.12.1999 and 13/13/2020; ssn 123-45-6789 or 000-12-3456; card 4111 1111 1111 1111 not 4111-1111-1111-1112; call +1 (017) 555-7713 190.137.223.204; 300.1.1.1; a.b@mail.de token = "04dbebab91ab85687d33eeaaf9ac699e1188f962"'
    df = spark.createDataFrame([(1, text, "x"), (2, "4111111111111111", "x"), (3, "4111111111111111.", "x"), (4, None, "x"), (5, "", "x")], "doc_id long, text string, n_pii string")
    got = {r.doc_id: r for r in pii.pseudonymised(df, "key").collect()}
    new = got[1].text
    assert re.fullmatch(r'on \d{4}-\d\d-\d\d, \d\d\.\d\d\.\d{4} and 13/13/2020; ssn \d{3}-\d\d-\d{4} or 000-12-3456; card \d{4} \d{4} \d{4} \d{4} not 4111-1111-1111-1112; call \+1 \(\d{3}\) \d{3}-\d{4} \d+\.\d+\.\d+\.\d+; 300\.1\.1\.1; u[0-9a-f]{16}@example\.invalid token = "[0-9a-f]{40}"', new)
    assert got[1].n_pii == 8 and not any(x in new for x in ("2020-02-29", "123-45-6789", "555-7713", "190.137.223.204", "a.b@", "04dbebab"))
    card = got[2].text
    assert luhn(card) and card != "4111111111111111" and got[3].text == card + "." and re.sub(" ", "", new).find(card) > 0
    assert (got[4].text, got[4].n_pii, got[5].text) == (None, 0, "")
    other = pii.pseudonymised(df, "another").where("doc_id = 2").collect()[0].text
    assert other != card and luhn(other)
    assert pii.pseudonymised(hard, "k").count() == len(HARD) and pii.pseudonymised(none(spark), "k").count() == 0


def test_pii_of_each_pair_of_kinds(spark):
    known = {"email": "a.b@mail.de", "secret": "token=04dbebab91ab85687d33eeaaf9ac699e", "date": "2020-02-29", "day": "31.12.1999", "ip": "190.137.223.204", "phone": "+1 212-555-7713", "local": "(212) 555-7713", "ssn": "123-45-6789", "card": "4111 1111 1111 1111", "digits": "4111111111111111"}
    rows = [(a + sep + b, a, b) for a in known.values() for b in known.values() for sep in (" ", ", ", "\n", " and ")]
    rows += [(t, "4111 1111 1111 1111", "4111 1111 1111 1111") for t in ("+1 4111 1111 1111 1111", "+49 4111 1111 1111 1111", "1234 4111 1111 1111 1111", "+1 2 12 4111 1111 1111 1111")]
    rows += [("+123 1234 1111 2020 2020-02-29", "2020-02-29", "2020-02-29")]
    got = pii.pseudonymised(spark.createDataFrame(rows, "text string, a string, b string"), "k").collect()
    assert not [r for r in got if r.a in r.text or r.b in r.text or r.n_pii < 1]


def test_feistel_against_brute_force(spark):
    import hmac

    def permuted(digits, key, tag):
        left = len(digits) // 2
        sizes = 10**left, 10 ** (len(digits) - left)
        half = [int(digits[:left]), int(digits[left:])]
        for i in range(pii.ROUNDS):
            said = "|".join([tag, str(i), str(sizes[0]), str(sizes[1]), str(half[1 - i % 2])])
            half[i % 2] = (half[i % 2] + int(hmac.new(key.encode(), said.encode(), "sha256").hexdigest()[:14], 16)) % sizes[i % 2]
        return f"{half[0]:0{left}d}{half[1]:0{len(digits) - left}d}"

    given = ["00", "123", "4111111", "411111111111111", "9" * 18]
    for key in ("k", "long " * 30):
        got = spark.createDataFrame([(d,) for d in given], "d string").select("d", pii.permuted_digits(F.col("d"), key, "card").alias("x")).collect()
        assert [r.x for r in got] == [permuted(r.d, key, "card") for r in got]
    digits = permuted("411111111111111", "k", "card")
    card = next(digits + c for c in "0123456789" if luhn(digits + c))
    assert pii.pseudonymised(spark.createDataFrame([("4111111111111111",)], "text string"), "k").collect()[0].text == card


def test_permutations_are_one_to_one(spark):
    ids = spark.range(10_000).select(F.lpad(F.col("id").cast("string"), 4, "0").alias("d"))
    assert ids.select(pii.permuted_digits(F.col("d"), "k", "t").alias("x")).where("length(x) = 4").distinct().count() == 10_000
    odd = spark.range(1000).select(F.lpad(F.col("id").cast("string"), 3, "0").alias("d"))
    assert odd.select(pii.permuted_digits(F.col("d"), "k", "t").alias("x")).distinct().count() == 1000
    days = spark.sql("SELECT date_format(d, 'yyyy-MM-dd') AS d FROM (SELECT explode(sequence(date'1900-01-01', date'2099-12-31')) AS d)")
    out = days.select(pii.pseudonym(F.col("d"), "k").alias("x"))
    assert out.distinct().count() == 73_049 and out.where("x < '1900-01-01' or x > '2099-12-31'").count() == 0


# -- 10 packing, and the pipeline -----------------------------------------------------------------------


def check_packing(rows, texts, path, size=1024):
    library = Tokenizer.from_file(path)
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert set(by_doc) == set(texts)
    for doc, text in texts.items():
        ids = [*library.encode(text, add_special_tokens=False).ids, 0]
        at = 0
        for r in sorted(by_doc[doc], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    padding = 0
    for own in by_sequence.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= size
        padding += 0 if at & (at - 1) == 0 else size - at
    return padding


def test_packing(spark, docs, hard):
    path = queries.vocabulary("byte_bpe_50k.json")
    assert check_packing(packing.packed(docs.repartition(5), path).collect(), texts_of(docs), path) == 0
    one = hard.where("doc_id is not null").dropDuplicates(["doc_id"])
    assert check_packing(packing.packed(one, path, size=64, windows=2).collect(), texts_of(one), path, 64) == 0
    assert packing.packed(hard, path).agg(F.count_distinct("sequence_id", "offset"), F.count("*")).collect()[0][0] == packing.packed(hard, path).count()
    assert packing.packed(none(spark), path).count() == 0


def test_byte_encoder(docs):
    path = queries.vocabulary("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    texts = sample_texts(docs) + ["a  <|endoftext|> b", " \n\n x  y \t z  ", "a\n", "don't  I'll"]
    for t, g in zip(texts, packing.ByteEncoder(path).encode_batch(texts)):
        assert np.frombuffer(g, "<u4").tolist() == library.encode(t, add_special_tokens=False).ids


def test_pipeline(spark, hard):
    import corpus_pipeline as c

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [n for n, _ in c.STAGES] == ["quality rules", "quality classifier", "near duplicates", "personal data", "packing"]
    kept = {}
    for name, stage in c.STAGES[:-1]:
        before, docs = docs, stage(spark, docs, SF)
        assert docs.columns == before.columns
        docs = docs.persist()
        kept[name] = {r.doc_id: r.text for r in docs.collect()}
    texts, left = kept["quality classifier"], kept["near duplicates"]
    sets = {i: jaccard_sets(t) for i, t in texts.items()}
    prints = {i: simhash.fingerprint(t.encode().lower().split(), 5, 42) for i, t in texts.items()}
    alike = lambda i, j: texts[i] == texts[j] or (prints[i] ^ prints[j]).bit_count() <= near.RADIUS and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])
    assert not any(alike(i, j) for i in left for j in left if i < j)
    assert all(any(alike(i, j) for j in texts if j != i) for i in texts if i not in left)
    rows = c.run(spark, SF).collect()
    assert check_packing(rows, kept["personal data"], queries.vocabulary("byte_bpe_50k.json")) == 0
    for _, stage in c.STAGES[:-1]:
        assert stage(spark, none(spark), SF).count() == 0
    twice = spark.createDataFrame([(1, "b b b b"), (1, "b b b b"), (2, "q w e r t")], "doc_id long, text string")
    assert sorted(r.doc_id for r in c.near_duplicate_stage(spark, twice, SF).collect()) == [1, 2]


def jaccard_sets(text):
    w = text.lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}


def test_pipeline_drops_edited_copies(spark):
    import corpus_pipeline as c

    rng = random.Random(9)
    passage = [f"p{i}" for i in range(40)]
    texts = [[f"w{rng.randrange(5000)}" for _ in range(200)] + passage for _ in range(40)]
    for base in texts[:30]:
        copy = [*base]
        for at in rng.sample(range(0, 240, 5), rng.randrange(1, 7)):
            copy[at] += "x"
        texts.append(copy)
    group = [f"g{i}" for i in range(300)]
    texts += [[*group[:i], f"n{i}", *group[i + 1 :]] for i in range(0, 300, 3)]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    sets = [jaccard_sets(t) for _, t in rows]
    root = [*range(len(rows))]
    find = lambda i: i if root[i] == i else find(root[i])
    edited = 0
    for i in range(len(rows)):
        for j in range(i):
            like = len(sets[i] & sets[j]) / len(sets[i] | sets[j])
            if like >= 0.8:
                edited += like < 0.95 and i < 70
                p, q = sorted((find(i), find(j)))
                root[q] = p
    assert edited > 15
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert sorted(r.doc_id for r in c.near_duplicate_stage(spark, df, SF).collect()) == sorted({find(i) for i in range(len(rows))})


def test_pipeline_keeps_one_of_each_group_whatever_the_ids(spark):
    import corpus_pipeline as c

    text = lambda k: " ".join(f"{k}{i}" for i in range(60))
    rows = [(None, text("a")), (None, text("b")), (None, text("b")), (1, text("c")), (1, text("d")), (2, text("c") + " end"), (3, text("d") + " end"), (None, text("d")), (4, None), (5, " "), (5, "x y"), (5, "X  y")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id or 0, r.text or "") for r in c.near_duplicate_stage(spark, df, SF).collect()))
    assert got == [(0, text("a")), (0, text("b")), (1, text("c")), (1, text("d")), (4, ""), (5, "X  y")]
    assert c.near_duplicate_stage(spark, none(spark), SF).count() == 0
    twice = spark.createDataFrame([(1, "b b b b"), (1, "b b b b"), (2, "q w e r t")], "doc_id long, text string")
    assert sorted(r.doc_id for r in c.near_duplicate_stage(spark, twice, SF).collect()) == [1, 2]


@pytest.mark.parametrize("tile, first", [(16384, 8), (32, 1)])
def test_near_groups_against_brute_force(spark, tile, first):
    rng = random.Random(4)
    base = [f"g{i}" for i in range(120)]
    texts = [" ".join(f"w{rng.randrange(400)}" for _ in range(rng.randrange(1, 90))) for _ in range(120)]
    for k in range(90):
        own = [*base]
        for at in rng.sample(range(120), 1 + k % 4):
            own[at] = f"n{k}"
        texts.append(" ".join(own))
    texts += [t.upper() for t in texts[:20]] + ["", " \n", "one", "one two", "ONE two"]
    prints = [simhash.fingerprint(t.encode().lower().split(), 5, 42) for t in texts]
    sets = [jaccard_sets(t) for t in texts]
    nodes = [r[0] for r in spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, t string").orderBy("i").select(near.node(F.col("t"))).collect()]
    root = {n: n for n in nodes}
    find = lambda i: i if root[i] == i else find(root[i])
    for i in range(len(texts)):
        for j in range(i):
            if nodes[i] and nodes[j] and (prints[i] ^ prints[j]).bit_count() <= near.RADIUS and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                p, q = sorted((find(nodes[i]), find(nodes[j])))
                root[q] = p
    df = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    got = {r.node: r.component for r in near.groups(df, tile=tile, first=first).collect()}
    assert {n: got.get(n, n) for n in nodes} == {n: find(n) for n in nodes}
    assert len({got[n] for n in nodes[120:210] if n in got}) >= 1 and len(got) > 60


def test_stages_leave_foreign_columns_alone(spark):
    import corpus_pipeline as c

    docs = spark.read.parquet(f"{SF}/documents.parquet").where("n_chars < 3000")
    odd = docs.select("*", F.lit("mine").alias("n_words"), F.lit(7).alias("Kept"), F.lit(1.5).alias("a.b"), F.create_map(F.lit("k"), F.col("doc_id")).alias("m"), F.lit("s").alias("score"), F.lit("p").alias("N_PII"), F.lit("c").alias("component"))
    odd = odd.withColumn("doc_id", F.when(F.col("doc_id") % 3 == 0, None).otherwise(F.col("doc_id")))
    for _, stage in c.STAGES[:-1]:
        out = stage(spark, odd, SF)
        assert out.columns == odd.columns and [f.dataType for f in out.schema] == [f.dataType for f in odd.schema]
        rows = out.collect()
        assert rows and all((r["n_words"], r["Kept"], r["a.b"], r["score"], r["N_PII"], r["component"]) == ("mine", 7, 1.5, "s", "p", "c") and len(r["m"]) == 1 for r in rows)
        assert any(r.doc_id is None for r in rows)
    assert packing.packed(odd, queries.vocabulary("byte_bpe_50k.json")).where("doc_id is null").limit(1).count() == 1
