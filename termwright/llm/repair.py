"""Repair of conversations' structure by a dynamic program over a grammar of their role and fault sequences.

A turn is a symbol: its role's initial and its fault. Re-Pair gives frequent pairs of symbols a rule
each, over the sequences of all conversations. A rule has one min-plus transfer matrix between the states of the grammar of roles, with
a rope of edits in each cell, and is evaluated from its two parts once; a conversation is the product of its few symbols' matrices.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from termwright.llm._shared import dropped, kept, pieces, written

#: Costs: another role, a turn that goes, a turn put in, a truncated turn that stays.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: States between turns: nothing yet; after the system turn; after a user turn; after an assistant turn. A conversation may end in the first and the last.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES, ENDS = 4, (START, ASSISTANT)
#: What may follow a state: the role's initial, and the state then.
FOLLOWS = {START: {"s": SYSTEM, "u": USER}, SYSTEM: {"u": USER}, USER: {"a": ASSISTANT}, ASSISTANT: {"u": USER}}
#: Symbols: a turn that has to go; else the role's initial (``o``: another), a capital letter if truncated.
GONE, SYMBOLS = "d", "dsuaoSUAO"
#: Turns of a sequence; a longer conversation is several, whose matrices are multiplied.
CHUNK = 4096
#: Rules of the grammar and rounds in which they are found: they decide how much work is shared, never the result.
RULES, ROUNDS = 256, 10
#: The symbol of the first rule.
FIRST = 0x100
#: Sequences whose repairs a worker remembers.
KNOWN = 50_000
#: White space.
SPACE = " \t\n\x0b\x0c\r"


# -- ropes and matrices ------------------------------------------------------------------------------


class Rope:
    """A string of edits, made of two others; short ones are plain."""

    __slots__ = ("n", "text", "left", "right", "_print")
    PLAIN, PRIME, BASE = 256, (1 << 127) - 1, 0x9E3779B97F4A7C15F39CC0605CEDC835

    def __init__(self, text: str | None = None, left: Rope | None = None, right: Rope | None = None):
        self.text, self.left, self.right, self._print = text, left, right, None
        self.n = len(text) if text is not None else left.n + right.n

    def __add__(self, other: Rope) -> Rope:
        if not self.n or not other.n:
            return self if self.n else other
        if self.n + other.n <= self.PLAIN:
            return Rope(self.text + other.text)
        return Rope(None, self, other)

    def print(self) -> int:
        """Equal for equal strings."""
        todo = [self]
        while todo:
            x = todo[-1]
            if x._print is None and x.text is None and (more := [y for y in (x.left, x.right) if y._print is None]):
                todo += more
                continue
            todo.pop()
            if x._print is None:
                if x.text is not None:
                    h = 0
                    for c in x.text.encode():
                        h = (h * self.BASE + c) % self.PRIME
                else:
                    h = (x.left._print * pow(self.BASE, x.right.n, self.PRIME) + x.right._print) % self.PRIME
                x._print = h
        return self._print

    def __lt__(self, other: Rope) -> bool:
        if self.text is not None and other.text is not None:
            return self.text < other.text
        a, b = [self], [other]
        while a and b:
            x, y = a.pop(), b.pop()
            if x is y or (x.n == y.n and (x.text is None or y.text is None) and x.print() == y.print()):
                continue
            if x.text is not None and y.text is not None:
                k = min(x.n, y.n)
                if x.text[:k] != y.text[:k]:
                    return x.text[:k] < y.text[:k]
                if x.n > k:
                    a.append(Rope(x.text[k:]))
                if y.n > k:
                    b.append(Rope(y.text[k:]))
                continue
            # The longer one that has parts is taken apart.
            if y.text is not None or (x.text is None and x.n >= y.n):
                a += [x.right, x.left]
                b.append(y)
            else:
                b += [y.right, y.left]
                a.append(x)
        return bool(b) and not a

    def __str__(self) -> str:
        out, todo = [], [self]
        while todo:
            x = todo.pop()
            if x.text is not None:
                out.append(x.text)
            else:
                todo += [x.right, x.left]
        return "".join(out)


#: A cell is (cost, edits), or None where there is no way. Two edits of a cell with one cost and one beginning are equal, so the
#: least of the products comes from the least of the parts.
Row = list[tuple[int, Rope] | None]


def _least(a, b):
    if a is None or b is None:
        return b if a is None else a
    if a[0] != b[0]:
        return a if a[0] < b[0] else b
    return b if b[1] < a[1] else a


def times(row: Row, matrix: list[Row]) -> Row:
    out: Row = [None] * STATES
    for k, x in enumerate(row):
        if x is not None:
            for j, y in enumerate(matrix[k]):
                # The edits are joined only where the cost is not beaten already.
                if y is not None and (out[j] is None or x[0] + y[0] <= out[j][0]):
                    out[j] = _least(out[j], (x[0] + y[0], x[1] + y[1]))
    return out


def product(a: list[Row], b: list[Row]) -> list[Row]:
    return [times(row, b) for row in a]


def inserting() -> list[Row]:
    """Any turns put in; more than two in a row are never cheapest."""
    out = [[(0, Rope("")) if i == j else None for j in range(STATES)] for i in range(STATES)]
    one = [[None] * STATES for _ in range(STATES)]
    for i in range(STATES):
        for c in "ua":
            if c in FOLLOWS[i]:
                one[i][FOLLOWS[i][c]] = (INSERT, Rope("I"))
    two = product(one, one)
    return [[_least(_least(out[i][j], one[i][j]), two[i][j]) for j in range(STATES)] for i in range(STATES)]


def turn_matrix(symbol: str) -> list[Row]:
    """Turns put in before a turn, and what becomes of it."""
    edit: list[Row] = [[None] * STATES for _ in range(STATES)]
    more = TRUNCATED if symbol.isupper() else 0
    for i in range(STATES):
        edit[i][i] = (DELETE, Rope("D"))
        if symbol == GONE:
            continue
        for c, j in FOLLOWS[i].items():
            if c == symbol.lower():
                edit[i][j] = _least(edit[i][j], (more, Rope("K")))
            if c != "s":
                edit[i][j] = _least(edit[i][j], (REROLE + more, Rope("R")))
    return product(inserting(), edit)


class Solver:
    """The matrices of all symbols, the rules' from their parts', and the repairs of sequences."""

    def __init__(self, rules: list[str]):
        self.rules = rules
        self.of = {c: turn_matrix(c) for c in SYMBOLS}
        for k, pair in enumerate(rules):
            self.of[chr(FIRST + k)] = product(self.of[pair[0]], self.of[pair[1]])
        self.last = inserting()
        self.known: dict[str, tuple[int, str]] = {}

    def packed(self, symbols: str) -> str:
        return replaced(symbols, self.rules)

    def through(self, row: Row, symbols: str) -> Row:
        for c in self.packed(symbols):
            row = times(row, self.of[c])
        return row

    def end(self, row: Row) -> tuple[int, str]:
        row = times(row, self.last)
        cost, edits = min((row[i] for i in ENDS if row[i] is not None), key=lambda x: x[0])
        for i in ENDS:
            if row[i] is not None and row[i][0] == cost and row[i][1] < edits:
                edits = row[i][1]
        return cost, str(edits)

    def start(self) -> Row:
        return [(0, Rope("")), None, None, None]

    def repair(self, symbols: str) -> tuple[int, str]:
        """The cost and the edits of a whole sequence."""
        found = self.known.get(symbols)
        if found is None:
            if len(self.known) >= KNOWN:
                self.known.clear()
            self.known[symbols] = found = self.end(self.through(self.start(), symbols))
        return found


# -- the grammar --------------------------------------------------------------------------------------


def replaced(symbols: str, rules: list[str], first: int = 0) -> str:
    """``symbols`` with the pairs of ``rules``, in their order, replaced by the rules' symbols."""
    for k, pair in enumerate(rules[first:], FIRST + first):
        if pair in symbols:
            symbols = symbols.replace(pair, chr(k))
    return symbols


def grammar(sequences: DataFrame, rules: int = RULES, rounds: int = ROUNDS) -> list[str]:
    """The pairs of symbols of the rules, each of the nine symbols and of rules before it, from ``symbols`` of ``sequences``.

    A round counts the pairs of all sequences and takes the most frequent ones that have no symbol in common, so
    that each count holds. At most ``rules`` pairs are ever on the driver, and a pair needs two places to become a rule.
    """
    found: list[str] = []
    now, mine = sequences.select("symbols"), None
    for _ in range(rounds):
        pairs = now.mapInArrow(_pairs, "pair string, n long").groupBy("pair").agg(F.sum("n").alias("n")).where("n > 1")
        taken: set[str] = set()
        new = []
        for r in pairs.orderBy(F.desc("n"), "pair").limit(rules).collect():
            if len(found) + len(new) < rules and not taken & set(r.pair):
                taken |= set(r.pair)
                new.append(r.pair)
        if not new:
            break
        before, found, old = len(found), found + new, mine
        if len(found) == rules:
            break
        own = found
        now = mine = written(now.mapInArrow(lambda batches: (pa.record_batch([pa.array([replaced(s, own, before) for s in b.column(0).to_pylist()], pa.string())], ["symbols"]) for b in pieces(batches, 1024)), "symbols string"), "repair-packed")
        if old is not None:
            dropped(old)
    if mine is not None:
        dropped(mine)
    return found


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    count: Counter = Counter()
    for batch in pieces(batches, 1024):
        for s in batch.column(0).to_pylist():
            last = None
            for a, b in zip(s, s[1:]):
                # Of three equal symbols in a row the pair counts once.
                if a == b == last:
                    last = None
                    continue
                count[a + b] += 1
                last = a if a == b else None
        if len(count) > 100_000:
            yield _counted(count)
            count.clear()
    yield _counted(count)


def _counted(count: Counter) -> pa.RecordBatch:
    return pa.record_batch([pa.array([*count], pa.string()), pa.array([*count.values()], pa.int64())], ["pair", "n"])


# -- conversations --------------------------------------------------------------------------------------


def _filled(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(" "))


def _turns(conversations: DataFrame) -> DataFrame:
    return conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), _filled("role").alias("role"), _filled("text").alias("text")).withColumn("digest", F.unhex(F.md5(F.col("text").cast("binary"))))


def sequences(conversations: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Symbols and faults of each conversation's turns, in pieces of ``chunk`` turns: ``conv_id``, ``chunk``, ``symbols`` and the counts.

    Only digests of the texts are shuffled.
    """
    bare = F.rtrim("text", F.lit(SPACE))
    rows = _turns(conversations).select("conv_id", "turn", "role", "digest", (bare == "").alias("blank"), (~F.right(bare, F.lit(1)).isin(".", "!", "?")).alias("cut"))
    order = [F.col("turn").asc_nulls_first(), "role", "digest"]
    conv = Window.partitionBy("conv_id").orderBy(*order)
    # All windows stand on one shuffle, by conversation.
    rows = rows.repartition("conv_id").withColumn("nth", F.row_number().over(Window.partitionBy("conv_id", "role", "digest").orderBy(*order)))
    first = F.substring("role", 1, 1)
    fault = F.when(F.col("blank"), "blank").when(F.col("nth") > 1, "duplicate").when(F.col("cut"), "truncated")
    before = F.lag("turn").over(conv)
    rows = rows.select(
        "conv_id",
        F.row_number().over(conv).alias("pos"),
        F.coalesce(fault, F.lit("")).alias("fault"),
        first.alias("initial"),
        F.lag(first).over(conv).alias("before"),
        "turn",
        (F.col("turn").isNotNull() & (before.isNull() | (before != F.col("turn")))).alias("new_turn"),
    )
    known = F.when(F.col("initial").isin("s", "u", "a"), F.col("initial")).otherwise("o")
    symbol = F.when(F.col("fault").isin("blank", "duplicate"), GONE).when(F.col("fault") == "truncated", F.upper(known)).otherwise(known)
    count = lambda what: F.sum(what.cast("long"))
    return (
        rows.withColumn("chunk", F.floor((F.col("pos") - 1) / chunk))
        .groupBy("conv_id", "chunk")
        .agg(
            F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", symbol.alias("symbol")))), lambda x: x["symbol"]), "").alias("symbols"),
            *[count(F.col("fault") == f).alias(f) for f in ("blank", "duplicate", "truncated")],
            count(F.col("before").isNotNull() & ~F.concat("before", "initial").isin("su", "ua", "au")).alias("illegal"),
            F.min("turn").alias("least"),
            F.max("turn").alias("most"),
            count(F.col("new_turn")).alias("turns"),
        )
    )


COUNTS = ("blank", "duplicate", "truncated", "illegal", "turns")


def repairs(conversations: DataFrame, chunk: int = CHUNK, rules: int = RULES, rounds: int = ROUNDS) -> DataFrame:
    """A row for each conversation: ``conv_id``, ``gaps``, ``blank``, ``duplicate``, ``truncated``, ``illegal``, ``cost`` and ``audit``, the cheapest edits.

    ``conversations`` has ``conv_id``, ``turn``, ``role``, ``text``; further columns are ignored. Null roles and texts are one space, so
    their turns are foreign or blank; a turn without number comes first; turns of one number come by role and then by
    the MD5 digest of the text; rows without ``conv_id`` are one conversation. A turn has its first fault of blank, duplicate (role and text stood
    earlier), truncated (it doesn't end in ``.``, ``!`` or ``?``). ``audit`` has a letter for each turn, kept (K), given another role (R) or deleted (D), and for
    each inserted (I), so that the roles' initials are ``(s?(ua)+)?``; of equal costs the least string. An empty role has no initial and is kept nowhere. An empty
    table gives no rows. A conversation's turns are sorted in one task, which never holds them; its audit is one string.
    """
    parts = written(sequences(conversations, chunk), "repair-sequences")
    found = grammar(parts.select("symbols").distinct(), rules, rounds)
    whole = (F.col("chunk") == 0) & (F.length("symbols") < chunk)
    columns = ["conv_id", "chunk", "symbols", "least", "most", *COUNTS]
    # Of a long conversation the pieces go through one task in order.
    rows = parts.where(whole).select(columns).union(parts.where(~whole).select(columns).repartition("conv_id").sortWithinPartitions("conv_id", "chunk"))
    kind = parts.schema["conv_id"].dataType
    span = F.col("most").cast("decimal(20,0)") - F.col("least") + 1 - F.col("turns")
    names = ["conv_id", "least", "most", *COUNTS, "cost", "audit"]
    id_type = to_arrow_type(kind)

    def run(batches):
        solver = kept(("repair", *found), lambda: Solver(found))
        state = row = None
        out: list[list] = []

        def close():
            cost, audit = state if isinstance(state, tuple) else solver.end(state)
            out.append([*row, cost, audit])

        for batch in pieces(batches, 1024):
            for conv, k, symbols, least, most, *counts in zip(*[c.to_pylist() for c in batch.columns]):
                if k == 0:
                    if row is not None:
                        close()
                    row = [conv, least, most, *counts]
                    state = solver.repair(symbols) if len(symbols) < chunk else solver.through(solver.start(), symbols)
                else:
                    state = solver.through(state, symbols)
                    row[1] = min((x for x in (row[1], least) if x is not None), default=None)
                    row[2] = max((x for x in (row[2], most) if x is not None), default=None)
                    row[3:] = [a + b for a, b in zip(row[3:], counts)]
            if out:
                yield _batch(out, names, id_type)
                out = []
        if row is not None:
            close()
            yield _batch(out, names, id_type)

    schema = T.StructType([T.StructField("conv_id", kind)] + [T.StructField(n, T.LongType()) for n in names[1:-1]] + [T.StructField("audit", T.StringType())])
    return rows.mapInArrow(run, schema).select("conv_id", F.when(span.isNull(), F.lit(0).cast("long")).when(span >= 2**63 - 1, F.lit(2**63 - 1)).otherwise(span.cast("long")).alias("gaps"), *COUNTS[:-1], "cost", "audit")


def _batch(rows: list, names: list[str], id_type: pa.DataType) -> pa.RecordBatch:
    kinds = {"conv_id": id_type} | dict.fromkeys(("edit", "role", "text", "audit", "repaired_sha256"), pa.string())
    return pa.record_batch([pa.array(c, kinds.get(n, pa.int64())) for n, c in zip(names, zip(*rows))], names)


def _edited(conversations: DataFrame, audits: DataFrame) -> DataFrame:
    """Each conversation's audit, then its turns in order: ``conv_id``, ``kind`` (0, 1), ``role``, ``text``, in one task."""
    turns = _turns(conversations).withColumn("kind", F.lit(1))
    notes = audits.select("conv_id", F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.col("audit").alias("text"), F.lit(None).cast("binary").alias("digest"), F.lit(0).alias("kind"))
    both = notes.unionByName(turns).repartition("conv_id")
    return both.sortWithinPartitions("conv_id", "kind", F.col("turn").asc_nulls_first(), "role", "digest").select("conv_id", "kind", "role", "text")


def _events(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(conversation, None) where one begins, then (edit, role, text) of each turn that it has in the end, and None behind each batch."""
    edits, at, state = "", 0, START

    def inserted():
        nonlocal at, state
        while at < len(edits) and edits[at] == "I":
            at += 1
            yield made("I", "")

    def made(edit, text):
        nonlocal state
        c = "a" if state == USER else "u"
        state = FOLLOWS[state][c]
        return edit, "assistant" if c == "a" else "user", text

    for batch in pieces(batches):
        for conv, kind, role, text in zip(*[c.to_pylist() for c in batch.columns]):
            yield from inserted()
            if kind == 0:
                edits, at, state = text, 0, START
                yield conv, None
                continue
            edit = edits[at]
            at += 1
            if edit == "K":
                state = FOLLOWS[state][role[0]]
                yield edit, role, text
            elif edit == "R":
                yield made(edit, text)
        yield None
    yield from inserted()


def repaired(conversations: DataFrame, audits: DataFrame) -> DataFrame:
    """The repaired turns, ``conv_id``, ``idx`` (from 0), ``edit``, ``role``, ``text``, by the ``audit`` that :func:`repairs` gives of the same rows."""
    own = _edited(conversations, audits)
    names, id_type = ["conv_id", "idx", "edit", "role", "text"], to_arrow_type(own.schema["conv_id"].dataType)

    def run(batches):
        conv, idx, out = None, 0, []
        for event in _events(batches):
            if event is None or len(out) >= 1024:
                if out:
                    yield _batch(out, names, id_type)
                out = []
            if event is not None and event[1] is None:
                conv, idx = event[0], 0
            elif event is not None:
                out.append((conv, idx, *event))
                idx += 1
        if out:
            yield _batch(out, names, id_type)

    schema = T.StructType([own.schema["conv_id"], T.StructField("idx", T.LongType()), *[T.StructField(n, T.StringType()) for n in ("edit", "role", "text")]])
    return own.mapInArrow(run, schema)


def digests(conversations: DataFrame, audits: DataFrame) -> DataFrame:
    """``conv_id`` and ``repaired_sha256``: of the repaired turns as ``role:text``, joined by new lines; a digest runs through its conversation's turns, which are never held."""
    own = _edited(conversations, audits)
    names, id_type = ["conv_id", "repaired_sha256"], to_arrow_type(own.schema["conv_id"].dataType)

    def run(batches):
        conv = digest = None
        first, out = True, []

        for event in _events(batches):
            if event is None:
                if out:
                    yield _batch(out, names, id_type)
                    out = []
            elif event[1] is None:
                if digest is not None:
                    out.append((conv, digest.hexdigest()))
                conv, digest, first = event[0], hashlib.sha256(), True
            else:
                digest.update(f"{'' if first else chr(10)}{event[1]}:{event[2]}".encode())
                first = False
        if digest is not None:
            out.append((conv, digest.hexdigest()))
        if out:
            yield _batch(out, names, id_type)

    return own.mapInArrow(run, T.StructType([own.schema["conv_id"], T.StructField("repaired_sha256", T.StringType())]))


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows with known faults, by the checksum of ``conv_id:turn`` (nulls: one space): of twenty, one is dropped, one emptied, one loses ``.!?``, one comes twice, one becomes the user's."""
    key = F.concat(_filled("conv_id"), F.lit(":"), _filled("turn"))
    rows = conversations.select("conv_id", "turn", _filled("role").alias("role"), _filled("text").alias("text"), (F.crc32(key.cast("binary")) % 20).alias("by")).where("by <> 0")
    text = F.when(F.col("by") == 1, F.lit("")).when(F.col("by") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("by") == 4, F.lit("user")).otherwise(F.col("role"))
    times_ = F.when(F.col("by") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(times_).alias("copy")).drop("copy")


def damaged_and_repaired(conversations: DataFrame) -> DataFrame:
    """The report of :func:`repairs` on damaged rows and the digest of what they become, for every ``conv_id`` of ``conversations``."""
    rows = damaged(conversations)
    report = written(repairs(rows), "repair-report")
    every = conversations.select(F.col("conv_id").alias("id")).distinct()
    same = lambda name: F.col("id").eqNullSafe(F.col(name))
    digest = digests(rows, report).withColumnRenamed("conv_id", "d_id")
    all_ = every.join(report, same("conv_id"), "left").join(digest, same("d_id"), "left")
    none = hashlib.sha256().hexdigest()
    zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c)
    return all_.select(F.col("id").alias("conv_id"), *[zero(c) for c in ("gaps", *COUNTS[:-1], "cost")], F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(none)).alias("repaired_sha256"))
