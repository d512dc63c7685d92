"""Conversation repair against a search over all edits, turn by turn."""

import hashlib
import heapq
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from termwright.llm import queries, repair

SF = "/root/testdata/sf0.001"
NONE = hashlib.sha256().hexdigest()
SPACES = " \t\n\x0b\x0c\r"


def cheapest(symbols):
    """(cost, audit) by Dijkstra's search; paths of one cost go by their edits."""
    todo, done = [(0, "", 0, "")], set()
    while todo:
        cost, audit, i, roles = heapq.heappop(todo)
        # Only the end of the roles so far matters, and whether there are any.
        key = (i, roles[-1:] or "-")
        if key in done:
            continue
        if i == len(symbols) and re.fullmatch("(s?(ua)+)?", roles):
            return cost, audit
        done.add(key)
        for c in "ua":
            if re.fullmatch("s?(ua)*u?", roles + c):
                heapq.heappush(todo, (cost + 3, audit + "I", i, roles + c))
        if i < len(symbols):
            heapq.heappush(todo, (cost + 4, audit + "D", i + 1, roles))
            more = 3 * symbols[i].isupper()
            if symbols[i] != "d":
                for c in "sua":
                    if re.fullmatch("s?(ua)*u?", roles + c):
                        if c == symbols[i].lower():
                            heapq.heappush(todo, (cost + more, audit + "K", i + 1, roles + c))
                        if c != "s":
                            heapq.heappush(todo, (cost + more + 3, audit + "R", i + 1, roles + c))


def after_damage(rows):
    out = {}
    for conv, turn, role, text in rows:
        conv_key, turn_key, role, text = [" " if x is None else x for x in (conv, turn, role, text)]
        own = out.setdefault(conv, [])
        by = zlib.crc32(f"{conv_key}:{turn_key}".encode()) % 20
        if by == 1:
            text = ""
        if by == 2:
            text = re.sub("[.!?]", "", text)
        if by == 4:
            role = "user"
        own += [(turn, role, text)] * (0 if by == 0 else 2 if by == 3 else 1)
    return out


def report(own):
    own = sorted(own, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).digest()))
    turns = [t for t, _, _ in own if t is not None]
    seen, symbols, faults = set(), "", []
    for _, role, text in own:
        bare = text.rstrip(SPACES)
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
        seen.add((role, text))
        faults.append(fault)
        c = role[:1] if role[:1] in ("s", "u", "a") else "o"
        symbols += "d" if fault in ("blank", "duplicate") else c.upper() if fault else c
    cost, audit = cheapest(symbols)
    rows, i, said = [], 0, ""
    for edit in audit:
        role, text = (None, "") if edit == "I" else own[i][1:]
        i += edit != "I"
        if edit == "D":
            continue
        if edit != "K":
            role = "assistant" if said.endswith("u") else "user"
        said += role[0]
        rows.append((edit, role, text))
    assert re.fullmatch("(s?(ua)+)?", said) and i == len(own)
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
    return (gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for _, r, t in rows).encode()).hexdigest()), rows


NAMES = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def brute(rows):
    return {conv: report(own)[0] for conv, own in after_damage(rows).items()}


def hard():
    draw = random.Random(5)
    rows = [(None, 1, "user", "no id."), (None, None, None, None), (-3, None, "user", "Hi."), (-3, None, "user", "Hi."), (-4, 2, "", "x."), (-5, -9, "tool", "é"), (-6, 1, "user", " \t\n")]
    for conv in range(60):
        for turn in range(draw.choice((1, 2, 5, 30, 200))):
            rows.append((conv, draw.choice((turn, turn, turn + 2, None)), draw.choice(("system", "user", "assistant", "user", "assistant", "tool", None)), draw.choice(("", " ", "Yes.", "And so", "Why?  \n", "x" * 9000, f"turn {turn}!", None, "ü "))))
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def test_query(spark):
    source = spark.read.parquet(f"{SF}/conversations.parquet")
    want = brute([tuple(r) for r in source.collect()])
    got = {r.conv_id: tuple(r[n] for n in NAMES) for r in queries.QUERIES["op12_conversation_repair"](spark, SF).collect()}
    assert got == want


def test_hard_conversations(spark):
    rows = hard()
    got = {r.conv_id: tuple(r[n] for n in NAMES) for r in repair.damaged_and_repaired(frame(spark, rows).withColumn("Audit", F.lit(1))).collect()}
    assert got == brute(rows)
    assert any(len(x[6]) > 150 for x in got.values()) and any(x[-1] == NONE for x in got.values())


@pytest.mark.parametrize("chunk", [3, 16])
def test_long_conversations_in_pieces(spark, chunk):
    df = frame(spark, hard())
    columns = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
    one, two = (sorted(tuple(r) for r in repair.repairs(df, chunk=c, rules=rules).select(columns).na.fill(-99, ["conv_id"]).collect()) for c, rules in ((chunk, 5), (4096, 256)))
    assert one == two


def test_repaired_turns(spark):
    rows = hard()
    df = frame(spark, rows)
    audits = repair.repairs(df)
    got = {}
    for r in repair.repaired(df, audits).orderBy("conv_id", "idx").collect():
        got.setdefault(r.conv_id, []).append((r.edit, r.role, r.text))
    own = {}
    for conv, turn, role, text in rows:
        own.setdefault(conv, []).append((turn, " " if role is None else role, " " if text is None else text))
    want = {conv: report(x)[1] for conv, x in own.items()}
    assert got == {conv: x for conv, x in want.items() if x}


def test_sequences_of_symbols():
    draw = random.Random(1)
    for rules in ([], ["ua", "du", chr(0x100) + chr(0x100), "aa", chr(0x102) + "d"]):
        solver = repair.Solver(rules)
        for n in [*range(7), 40]:
            for _ in range(150 if n < 7 else 20):
                symbols = "".join(draw.choice(repair.SYMBOLS) for _ in range(n))
                assert solver.repair(symbols) == cheapest(symbols), symbols


def test_ropes():
    draw = random.Random(2)
    texts = ["".join(draw.choice("DIKR") for _ in range(n)) * draw.choice((1, 300)) for n in (0, 1, 3, 40) for _ in range(4)]
    texts += [t + x for t in texts for x in ("K", "R")]

    def rope(text):
        if len(text) < 100:
            return repair.Rope(text)
        at = draw.randrange(1, len(text))
        return rope(text[:at]) + rope(text[at:])

    for a in texts:
        for b in texts:
            assert (rope(a) < rope(b)) == (a < b) and str(rope(a) + rope(b)) == a + b


def test_grammar(spark):
    df = spark.createDataFrame([("uauauaua",), ("uaua",), ("duadua",), ("sss",), ("s",)], "symbols string")
    rules = repair.grammar(df)
    assert rules[0] == "ua" and chr(0x100) * 2 in rules
    solver = repair.Solver(rules)
    assert len(solver.packed("uauauaua")) == 2 and solver.repair("uauauaua") == (0, "K" * 8)
    assert repair.grammar(df.limit(0)) == [] and len(repair.grammar(df, rules=1)) == 1


def test_empty_table(spark):
    df = frame(spark, []).limit(0)
    assert repair.damaged_and_repaired(df).count() == 0 and repair.repaired(df, repair.repairs(df)).count() == 0
