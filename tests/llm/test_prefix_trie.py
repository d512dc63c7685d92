"""The trie of conversations against one built in a dictionary."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from termwright.llm import prefix_trie, queries

SF = "/root/testdata/sf0.001"
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def digest(role, text):
    return hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).digest()


def in_order(rows):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", digest(role or "", text or ""), text or ""))
    return {c: [(r, t) for _, _, r, _, t in sorted(x)] for c, x in own.items()}


def rebuilt(rows):
    own, out = in_order(rows), {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = own.get(c - c % 20, [])[:h] + turns[h:]
    return out


def brute(convs):
    members, ends = {}, {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
        ends.setdefault(tuple(turns), []).append(c)
    children, leaves, saved = {}, {}, {}
    for node in sorted(members, key=len, reverse=True):
        own = (len(members[node]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        leaves[node] = leaves.get(node, 0) or 1
        saved[node] = saved.get(node, 0) + own
        if node:
            up = node[:-1]
            children[up] = children.get(up, 0) + 1
            leaves[up] = leaves.get(up, 0) + leaves[node]
            saved[up] = saved.get(up, 0) + saved[node]
    return sorted(
        (min(m), len(k), min(members[k[:-1]]) if k else None, len(m), children.get(k, 0), leaves[k], saved[k], hashlib.sha256(",".join(map(str, sorted(ends.get(k, [])))).encode()).hexdigest()) for k, m in members.items()
    )


def rows_of(df):
    return sorted(tuple(r[c] for c in COLUMNS) for r in df.collect())


def frame(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def hard():
    draw = random.Random(3)
    rows = [(None, 1, "user", "no id"), (-3, None, None, None), (-3, None, "", ""), (-3, 4, "user", "x y"), (10**15, 1, "user", "far"), (-20, 0, "user", "negative family")]
    texts = ["", "one", "two  words", "drei Wörter hier", "x " * 500, None]
    for conv in range(160):
        if conv % 7 == 3:
            continue
        same = conv // 20 % 3
        size = draw.choice((1, 1, 2, 3, 4, 9, 33))
        for turn in range(size):
            text = texts[turn % 6] if same == 0 else draw.choice(texts) if same == 1 or turn > 6 else "begin"
            rows.append((conv, draw.choice((turn, turn, turn // 2, None)) if same == 2 else turn, ("user", "assistant")[turn % 2], text))
    return rows + [r for r in rows if r[0] == 5]


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").collect()]
    assert rows_of(queries.QUERIES["op11_prefix_trie"](spark, SF)) == brute(rebuilt(rows))


@pytest.mark.parametrize("container, segment", [(4096, 64), (4096, 4), (2, 64), (3, 4), (1, 1)])
def test_hard_conversations(spark, container, segment):
    rows = hard()
    df = frame(spark, rows).withColumn("pos", F.lit("clash"))
    assert rows_of(prefix_trie.rebuilt_trie(df, container, segment)) == brute(rebuilt(rows))


def test_copies_are_one_suffix(spark):
    rows = [(c, t, "user", f"turn {t}") for c in range(3000) for t in range(3)]
    turns = prefix_trie.coded(frame(spark, rows))
    parts = prefix_trie.segments(prefix_trie.numbered(turns), turns.select("conv_id").distinct())
    assert parts.groupBy("a", "b", "ids").count().count() == 1
    # Ids of many ranges meet in order.
    assert rows_of(prefix_trie.trie(prefix_trie.numbered(turns), turns.select("conv_id"), container=1)) == brute(in_order(rows))


def test_texts_give_the_conversations_back(spark):
    rows = hard()
    df = frame(spark, rows)
    turns = prefix_trie.rebuilt(prefix_trie.numbered(prefix_trie.coded(df, ("text",))))
    nodes = prefix_trie.with_texts(prefix_trie.rebuilt_trie(df), turns).collect()
    at = {(r.conv_id, r.depth): r for r in nodes}
    said = {}
    for r in nodes:
        path, up = [], r
        while up.depth:
            path.append((up.role, up.text))
            up = at[up.parent_conv_id, up.depth - 1]
        said[tuple(reversed(path))] = r.n_convs
    want = {}
    for own in rebuilt(rows).values():
        for d in range(len(own) + 1):
            want[tuple(own[:d])] = want.get(tuple(own[:d]), 0) + 1
    assert said == want


def test_empty_tables(spark):
    assert prefix_trie.rebuilt_trie(frame(spark, []).limit(0)).count() == 0
    assert prefix_trie.rebuilt_trie(frame(spark, [(None, 1, "user", "x")])).count() == 0
    # Two conversations without turns: the family's first is missing and their own first turns are given up.
    lone = [c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4 == 3][:2]
    rows = [(c, 0, "user", "gone") for c in lone]
    assert rows_of(prefix_trie.rebuilt_trie(frame(spark, rows))) == brute(rebuilt(rows)) and len(brute(rebuilt(rows))) == 1
