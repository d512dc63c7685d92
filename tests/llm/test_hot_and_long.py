"""Hot texts, keys that are null, and runs of one class: what earlier versions judged by another rule."""

import itertools
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from termwright.llm import near, quality_model, quality_rules, queries, simhash


def test_a_row_without_key_links_its_neighbours(spark):
    """Only the text without id is within 4 bits of both others."""
    rng = random.Random(11)
    base = [f"w{i}" for i in range(300)]
    near_of = lambda own, k: [*own[:k], f"n{rng.random()}", *own[k + 1 :]]
    bits = lambda a, b: (simhash.fingerprint(" ".join(a).encode().split(), 4, 42) ^ simhash.fingerprint(" ".join(b).encode().split(), 4, 42)).bit_count()
    for _ in range(4000):
        a, b = [*base], [*base]
        for k in range(2):
            a, b = near_of(a, rng.randrange(300)), near_of(b, rng.randrange(300))
        if bits(a, base) <= 4 and bits(b, base) <= 4 and bits(a, b) > 4:
            break
    else:
        raise AssertionError("no such texts")
    rows = [(10, " ".join(a)), (None, " ".join(base)), (20, " ".join(b)), (None, "alone in its group, without a key")]
    got = simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id or 0, r.component_id) for r in got if r.component_id is not None) == [(0, 10), (10, 10), (20, 10)]
    assert [r.doc_id for r in got if r.component_id is None] == [None]


@pytest.mark.parametrize("size", [9_999, 10_000, 10_001, 10_050, 30_000])
def test_long_runs_have_the_librarys_ids(size):
    ranks = quality_rules.Ranks(queries.vocabulary(queries.VOCABULARIES[1]))
    rng = random.Random(size)
    for alphabet in ("abcdefghij", "äöüß", "ab", " ", "1", "x-"):
        text = f"head {''.join(rng.choice(alphabet) for _ in range(size))} tail, don't"
        assert ranks.measured([text])[0].tolist() == ranks.library.encode_ordinary(text)
    assert len(ranks.measured(["z" * 1_000_000])[0]) > 1000


def test_merging_is_the_librarys(spark):
    ranks = quality_rules.Ranks(queries.vocabulary(queries.VOCABULARIES[1]))
    rng = random.Random(3)
    for n in (1, 2, 3, 50, 700):
        for _ in range(20):
            part = "".join(rng.choice("etaoin shr") for _ in range(n)).replace(" ", "")
            assert not part or ranks.merged(part.encode()) == ranks.library.encode_ordinary(part)


def test_a_hot_text_leaves_the_sample_distinct(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    hot = docs.orderBy(F.xxhash64(F.lit(17), "text")).limit(1).select("text").first()[0]
    many = docs.union(spark.range(2000).select((F.col("id") + 10_000).alias("doc_id"), F.lit(hot).alias("text")))
    plain, skewed = (quality_model.trained(d, most=150) for d in (docs, many))
    assert skewed.good > 0 and np.isfinite(skewed.weights).all()
    judged = [{r.doc_id: r.kept for r in quality_model.scored(docs, m).select("doc_id", "kept").collect()} for m in (plain, skewed)]
    # Nine tenths of the rows are one text; the others are judged as without it, all but a few.
    assert sum(judged[0][i] != judged[1][i] for i in judged[0]) <= 0.05 * len(judged[0])


def test_expectation_maximisation_against_loops():
    rng = random.Random(8)
    counts = {}
    for _ in range(3000):
        good = rng.random() < 0.8
        own = [quality_model.NONE if rng.random() < 0.3 else (quality_model.GOOD if (rng.random() < 0.85) == good else quality_model.BAD) for _ in quality_model.LABELLERS]
        pattern = sum(v * 3**k for k, v in enumerate(own))
        counts[pattern] = counts.get(pattern, 0) + 1
    got, table, share = quality_model.posteriors(counts)
    n_all = sum(counts.values())
    strength, weights = 0.02 * n_all + 1, {(k, c): [0.5, 0.5] if c == 0 else [0.02, 0.98] for k in range(9) for c in (0, 1)}
    good, at = 0.9, {p: 1.0 for p in counts}
    for _ in range(100):
        now = {}
        for p in counts:
            like = [1 - good, good]
            for k, v in enumerate(quality_model.unpack(p)):
                if v != quality_model.NONE:
                    like = [like[c] * weights[k, c][v] for c in (0, 1)]
            now[p] = like[1] / sum(like)
        if max(abs(now[p] - at[p]) for p in counts) < 1e-9:
            break
        at = now
        good = (sum(counts[p] * at[p] for p in counts) + 0.9 * strength) / (n_all + strength)
        for k, c in itertools.product(range(9), (0, 1)):
            prior = [0.5, 0.5] if c == 0 else [0.02, 0.98]
            sums = [strength * x for x in prior]
            for p in counts:
                v = quality_model.unpack(p)[k]
                if v != quality_model.NONE:
                    sums[v] += counts[p] * (at[p] if c else 1 - at[p])
            weights[k, c] = [x / sum(sums) for x in sums]
    assert max(abs(got[p] - at[p]) for p in counts) < 1e-6 and abs(share - good) < 1e-6


def test_scorer_against_loops():
    rng = np.random.default_rng(5)
    rows = [(np.array([int(rng.integers(0, 9)), quality_model.BUCKETS]), np.array([rng.random(), 1.0]), float(rng.random() < 0.6), float(rng.integers(1, 5))) for _ in range(12)]
    w = np.zeros(quality_model.BUCKETS + quality_model.DENSE)
    w[quality_model.BUCKETS] = 2.0
    m, v, total = w * 0, w * 0, sum(r[3] for r in rows)
    for k in range(1, 41):
        g = 1e-5 * w
        for at, x, y, weight in rows:
            p = 1 / (1 + np.exp(-np.clip(sum(w[a] * b for a, b in zip(at, x)), -30, 30)))
            for a, b in zip(at, x):
                g[a] += weight * (p - y) * b / total
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - 0.5 * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.999**k)) + 1e-8)
    assert np.allclose(quality_model.fit(rows, rounds=40), w, atol=1e-9)


def test_recall_by_likeness(spark):
    """All pairs of five-word Jaccard 0.8 or more among edited copies: nine tenths at least are candidates in each band."""
    rng = random.Random(21)
    found = {0: [], 1: [], 2: []}
    for _ in range(400):
        own = [f"w{rng.randrange(3000)}" for _ in range(rng.randrange(60, 400))]
        other = [*own]
        for _ in range(rng.randrange(1, 1 + max(1, len(own) // 45))):
            other[rng.randrange(len(own))] = f"n{rng.random()}"
        a, b = (near.shingles(" ".join(x)) for x in (own, other))
        both = len(np.intersect1d(a, b))
        likeness = both / (len(a) + len(b) - both)
        if likeness >= 0.8:
            bits = (simhash.fingerprint(" ".join(own).encode().split(), 5, 42) ^ simhash.fingerprint(" ".join(other).encode().split(), 5, 42)).bit_count()
            found[min(2, int((likeness - 0.8) * 20))].append(bits <= near.RADIUS)
    assert all(len(x) > 20 and np.mean(x) >= 0.9 for x in found.values()), {k: (len(x), np.mean(x)) for k, x in found.items()}


def test_the_sessions_key_makes_the_pseudonyms(spark):
    import corpus_pipeline as c

    df = spark.createDataFrame([(1, "mail a.b@example.org, card 4111 1111 1111 1111")], "doc_id long, text string")
    stage = dict(c.STAGES)["personal data"]
    test_key = stage(spark, df, "").first().text
    spark.conf.set(c.PII_SETTING, "another secret")
    try:
        own = stage(spark, df, "").first().text
    finally:
        spark.conf.unset(c.PII_SETTING)
    assert own != test_key and stage(spark, df, "").first().text == test_key and "4111 1111 1111 1111" not in own


def test_bands_hold_for_documents_they_were_not_made_of(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").join(spark.read.parquet("/root/testdata/sf0.1/labels.parquet"), "doc_id").where("quality is not null")
    paths = [queries.vocabulary(v) for v in queries.VOCABULARIES]
    bands = quality_rules.bands_of(docs.where("quality = 1 and doc_id % 2 = 0"), paths)
    assert all({"en", "de", "fr", "es", "latin", "other"} <= set(b) for b in bands.values())
    held = quality_rules.measured(docs.where("doc_id % 2 = 1"), paths, bands=bands).where("not base_failed").groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()
    kept = {r.quality: r.kept for r in held}
    assert kept[1] > 0.97 and kept[0] < 0.5
    # Nothing is known of a language with few documents.
    few = quality_rules.bands_of(docs.where("quality = 1 and doc_id < 300"), paths, least=10_000)
    assert all("en" not in b for b in few.values())


def test_no_alike_pair_fails_the_bound():
    """The classes bound what two texts share from above, so a pair with 4/5 in common always passes; most of those with 2/3 don't."""
    rng = random.Random(31)
    passed = {True: [], False: []}
    for _ in range(300):
        own = [f"w{rng.randrange(5000)}" for _ in range(rng.randrange(8, 260))]
        other = [*own]
        for _ in range(rng.randrange(0, 2 + len(own) // 18)):
            other[rng.randrange(len(own))] = f"n{rng.random()}"
        a, b = (near.shingles(" ".join(x)) for x in (own, other))
        both = len(np.intersect1d(a, b))
        counts = [near.classes(x).astype(int) for x in (a, b)]
        assert np.minimum(*counts).sum() >= both
        fits = 9 * np.minimum(*counts).sum() >= 4 * (len(a) + len(b))
        likeness = both / (len(a) + len(b) - both)
        if likeness >= 0.8:
            passed[True].append(fits)
        elif likeness < 0.66 and len(a) > 60:
            passed[False].append(fits)
    assert all(passed[True]) and len(passed[True]) > 50 and len(passed[False]) > 20 and np.mean(passed[False]) < 0.2
    huge = near.classes(np.arange(64 * 255, dtype=np.uint64))
    assert (huge == 255).all() and near.classes(np.zeros(0, np.uint64)).sum() == 0


def test_near_tiles_of_a_population_count(spark):
    prints = [(1 << a) | (1 << b) | (1 << c) for a in range(40) for b in range(a) for c in range(b)]
    df = spark.createDataFrame([(i, p) for i, p in enumerate(prints)], "node long, simhash long")
    packs = simhash.packed(simhash.tiled(df, near.NEAR_TILE), "simhash", "node").cache()
    assert len(prints) > 8192 and simhash.tile_pairs(packs, near.RADIUS).count() == 1


def test_near_texts_that_share_too_little_are_no_candidates(spark, monkeypatch):
    # Of one size, within two bits; all shingles of a text are in a class of its own.
    rows = [(i + 1, 1 << i, 64, *[64 << 8 * (i % 8) if i // 8 == k else 0 for k in range(8)]) for i in range(60)]
    prints = spark.createDataFrame(rows, "node long, simhash long, size long, " + ", ".join(f"{c} long" for c in near.CLASSES))
    pairs = []

    def verified(open_pairs, *_):
        pairs.append(open_pairs.count())
        return near.written(open_pairs.limit(0), "near-links")

    monkeypatch.setattr(near, "measured", lambda texts, width: prints)
    monkeypatch.setattr(near, "_verified", verified)
    assert near.groups(spark.createDataFrame([("a",)], "text string")).count() == 0
    assert pairs == [0]


def test_near_rows_of_a_tile_that_are_to_come():
    row = pa.RecordBatch.from_pydict({"node": [np.arange(9).tobytes()], "component": pa.array([None], pa.binary()), "right": [np.array([2, 5]).tobytes()]})
    (got,) = near._to_come([row], ["node", "component"])
    assert np.frombuffer(got.column("node")[0].as_py(), np.int64).tolist() == [2, 5] and got.column("component")[0].as_py() is None
