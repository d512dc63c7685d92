"""A prefix trie of all conversations as burst tries.

Distinct conversations are suffixes in containers. A container with too many bursts: it becomes a head of the trie, and its
suffixes go to a container for each next turn. The containers that remain are dealt to shards, sorted and swept into nodes, one
after another. What the nodes of a container add up to goes to the heads above it.

Turns are known by 128-bit digests of role and text, and nodes by the exclusive or of their turns' digests and depths; no text is shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from termwright.llm._shared import dropped, written

#: Distinct suffixes of a container; more of them burst it.
CONTAINER = 4096
#: Turns of a suffix. A longer conversation goes on in a container of its own under the node it has come to.
SEGMENT = 64
#: Turn numbers that are numbered in one group; counts of groups come before them.
BLOCK = 128
#: Ids (as a power of two) whose decimal forms are joined before they come to a node's digest.
ID_BITS = 12
#: Burst containers up to which their list is broadcast.
FEW = 10_000

#: Of conversations in a family, and of the turns its first one may lend.
FAMILY, LENT = 20, 4

_NODE, _PATH = "depth long, a long, b long", "array<struct<depth:bigint,a:bigint,b:bigint>>"


# -- turns ------------------------------------------------------------------------------------------------


def coded(conversations: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """``conv_id``, ``turn``, ``role``, a ``digest`` of role and text, the text's ``words``, and columns to ``keep``; null roles and texts are empty, rows without ``conv_id`` are left out."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary")))
    words = F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+"))
    own = [text.alias(c) if c == "text" else F.col(c) for c in keep]
    return conversations.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"), digest.alias("digest"), words.cast("long").alias("words"), *own)


def numbered(turns: DataFrame) -> DataFrame:
    """``turns`` with ``pos`` from 0 in place of ``turn``: by number (null first), then role and digest. Counts of blocks of numbers come first, so a conversation needs no single task."""
    rows = turns.withColumn("block", F.shiftright("turn", BLOCK.bit_length() - 1))
    before = Window.partitionBy("conv_id").orderBy(F.col("block").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy("conv_id", "block").agg(F.count("*").alias("n")).select(F.col("conv_id").alias("c"), F.col("block").alias("k"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n"))
    own = Window.partitionBy("conv_id", "block").orderBy(F.col("turn").asc_nulls_first(), "role", "digest")
    rows = rows.join(counts, (F.col("conv_id") == F.col("c")) & F.col("block").eqNullSafe(F.col("k")))
    return rows.withColumn("pos", F.col("n") + F.row_number().over(own) - 1).drop("turn", "block", "c", "k", "n")


def rebuilt(turns: DataFrame) -> DataFrame:
    """Each conversation of ``turns`` (:func:`numbered`), its first h turns replaced by those of its family's first conversation, as many as there are.

    A family is ``conv_id`` less its remainder by 20 (never negative), h the checksum of the decimal ``conv_id`` modulo 4. Conversations that have no turn then don't appear.
    """
    takes = lambda c: F.crc32(c.cast("string").cast("binary")) % LENT
    convs = turns.select("conv_id").distinct().withColumn("family", F.col("conv_id") - F.pmod("conv_id", F.lit(FAMILY))).withColumn("h", takes(F.col("conv_id")))
    lent = turns.where((F.pmod("conv_id", F.lit(FAMILY)) == 0) & (F.col("pos") < LENT - 1))
    there = lent.groupBy("conv_id").agg(F.count("*").alias("there")).withColumnRenamed("conv_id", "family")
    rest = [c for c in turns.columns if c != "conv_id"]
    first = convs.join(lent.withColumnRenamed("conv_id", "family"), "family").where("pos < h").select("conv_id", *rest)
    own = turns.withColumn("h", takes(F.col("conv_id"))).where("pos >= h").withColumn("family", F.col("conv_id") - F.pmod("conv_id", F.lit(FAMILY)))
    own = own.join(there, "family", "left").withColumn("pos", F.col("pos") - F.col("h") + F.least("h", F.coalesce("there", F.lit(0))))
    return first.unionByName(own.select("conv_id", *rest))


def segments(turns: DataFrame, convs: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """Pieces of at most ``segment`` turns: ``conv_id``, ``base`` (turns before), ``a``, ``b`` (the node before), ``ids``, ``ws``, ``last``. A conversation of ``convs`` without turns has one, empty."""
    zero, there = F.lit(0).cast("long"), F.col("pos").isNotNull()
    lane = lambda k: F.when(there, F.xxhash64(F.lit(k), "pos", "digest"))
    one = F.when(there, F.struct("pos", lane(1).alias("x"), lane(2).alias("y"), "words"))
    # A row without a turn for each conversation keeps those that have none.
    rows = turns.select("conv_id", "pos", "digest", "words").unionByName(convs.select("conv_id"), allowMissingColumns=True)
    base = F.coalesce(F.floor(F.col("pos") / segment) * segment, zero).cast("long")
    xor = lambda k: F.coalesce(F.bit_xor(lane(k)), zero)
    parts = rows.withColumn("base", base).groupBy("conv_id", "base").agg(F.array_sort(F.collect_list(one)).alias("turns"), xor(1).alias("sa"), xor(2).alias("sb"))
    w = Window.partitionBy("conv_id").orderBy("base")
    above = lambda c: F.coalesce(F.bit_xor(c).over(w.rowsBetween(Window.unboundedPreceding, -1)), zero)
    parts = parts.withColumns({"a": above("sa"), "b": above("sb"), "last": F.lead("base").over(w).isNull()})
    return parts.select(
        "conv_id", "base", "a", "b", F.transform("turns", lambda t: F.struct(t["x"].alias("x"), t["y"].alias("y"))).alias("ids"), F.transform("turns", lambda t: t["words"]).alias("ws"),
        "last", (F.col("a").bitwiseXOR(F.col("sa"))).alias("end_a"), (F.col("b").bitwiseXOR(F.col("sb"))).alias("end_b"),
    )


# -- the trie -----------------------------------------------------------------------------------------------


def trie(turns: DataFrame, convs: DataFrame, container: int = CONTAINER, segment: int = SEGMENT) -> DataFrame:
    """A row for each node of the trie of ``turns`` (``conv_id``, ``pos``, ``digest``, ``words``) of all conversations ``convs``.

    ``conv_id`` (the smallest member), ``depth``, ``parent_conv_id`` (the parent's ``conv_id``; the root: null), ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens`` and ``ends_sha256`` (of the decimal ids of the members that end here, ascending, joined by commas). Equal
    conversations are one suffix with a count. Turns are equal if 128 bits of their digest are. Conversations of any length
    are read whole; one without turns is a member of the root; an empty table has no node. Rounds of bursting are at most ``segment``,
    each over the containers that are too large only.
    """
    parts = written(segments(turns, convs.select("conv_id").distinct(), segment), "trie-segments")
    ends = _ends(parts)
    zero = F.lit(0).cast("long")
    same = parts.groupBy("base", "a", "b", "ids").agg(F.first("ws").alias("ws"), F.count("*").alias("n"), F.min("conv_id").alias("least"), F.bool_or(~F.col("last")).alias("go"))
    path = F.array().cast(_PATH)
    rows = same.select("base", F.lit(0).alias("skip"), F.col("a").alias("ha"), F.col("b").alias("hb"), "a", "b", "ids", "ws", "n", "least", "go", F.lit(None).cast("long").alias("up"), path.alias("path"))
    rows = written(rows, "trie-suffixes")
    kept, heads = [], []
    while True:
        big = _burst(rows, container)
        if big is None:
            kept.append(rows)
            break
        heads.append(big)
        few = big.count() <= FEW
        marks = big.select("base", "skip", "a", "b", F.col("least").alias("head"))
        marked = written(rows.join(F.broadcast(marks) if few else marks, ["base", "skip", "a", "b"], "left").select(*rows.columns, "head"), "trie-marked")
        kept.append(marked.where("head is null").drop("head"))
        here = F.struct((F.col("base") + F.col("skip")).alias("depth"), "a", "b")
        at = F.col("ids")[F.col("skip")]
        rows = marked.where("head is not null and size(ids) > skip").select(
            "base", (F.col("skip") + 1).alias("skip"), "ha", "hb", F.col("a").bitwiseXOR(at["x"]).alias("a"), F.col("b").bitwiseXOR(at["y"]).alias("b"), "ids", "ws", "n", "least", "go", F.when(F.expr(_GATE), None).otherwise(F.col("head")).alias("up"), F.concat("path", F.array(here)).alias("path")
        )
    left = kept[0]
    for more in kept[1:]:
        left = left.unionByName(more)
    left = left.repartition("base", "skip", "a", "b").sortWithinPartitions("base", "skip", "a", "b", "ids")
    done = written(left.mapInArrow(_swept, _SWEPT), "trie-nodes")
    nodes = done.where("kind = 0").select(_FIELDS)
    sums = done.where("kind = 2")
    if heads:
        above = heads[0]
        for more in heads[1:]:
            above = above.unionByName(more)
        own = F.when(F.col("node"), (F.col("n_convs") - 1) * F.col("w")).otherwise(0)
        # What a container or a head adds up to goes to all heads on its path.
        adds = sums.select("base", "ha", "hb", "path", "leaves", "saved").unionByName(above.select("base", "ha", "hb", "path", zero.alias("leaves"), own.alias("saved")))
        total = adds.select(F.explode("path").alias("to"), "leaves", "saved").groupBy("to").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
        above = above.join(total.select(F.col("to.depth").alias("depth"), F.col("to.a").alias("a"), F.col("to.b").alias("b"), "leaves", "saved"), ["depth", "a", "b"], "left")
        above = written(above.select("base", "ha", "hb", "skip", "node", "depth", "a", "b", F.col("least").alias("conv_id"), F.col("up").alias("parent"), "n_convs", "children", F.coalesce("leaves", zero).alias("leaves"), (F.coalesce("saved", zero) + own).alias("saved"), own.alias("own"), *[F.when(F.expr("base > 0 and skip = 1"), F.col(h)).alias(p) for h, p in (("ha", "pa"), ("hb", "pb"))]), "trie-heads")
        nodes = nodes.unionByName(above.where("node").select(_FIELDS))
    # Where conversations are longer than a segment, what is below the nodes between two segments goes up.
    if parts.where("base > 0").limit(1).count():
        nodes = _continued(nodes, done, above if heads else None, sums, parts, segment)
    none = hashlib.sha256().hexdigest()
    out = nodes.join(ends, ["depth", "a", "b"], "left")
    return out.select("conv_id", "depth", F.col("parent").alias("parent_conv_id"), "n_convs", F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), F.coalesce("ends", F.lit(none)).alias("ends_sha256"))


#: A container whose root is a node of the segment before.
_GATE = "base > 0 and skip = 0"
_FIELDS = ["depth", "a", "b", "conv_id", "parent", "n_convs", "children", "leaves", "saved", "pa", "pb"]
_SWEPT = f"kind int, base long, ha long, hb long, {_NODE}, conv_id long, parent long, n_convs long, children long, leaves long, saved long, pa long, pb long, path {_PATH}"
_NAMES = ["kind", "base", "ha", "hb", "depth", "a", "b", "conv_id", "parent", "n_convs", "children", "leaves", "saved", "pa", "pb", "path"]


def _burst(rows: DataFrame, container: int) -> DataFrame | None:
    """The containers of ``rows`` with more than ``container`` suffixes, as heads; None if there are none.

    ``node`` is false where a head is the node that a segment before ended in, which that segment has.
    """
    key = ["base", "skip", "a", "b"]
    sizes = rows.groupBy(key).agg(
        F.count("*").alias("size"), F.sum("n").alias("n_convs"), F.min("least").alias("least"), F.first("up").alias("up"), F.first("path").alias("path"), F.first("ha").alias("ha"), F.first("hb").alias("hb"),
        F.first(F.when(F.col("skip") > 0, F.get("ws", F.col("skip") - 1))).alias("w"),
    ).where(F.col("size") > container)
    sizes = written(sizes, "trie-large")
    count = sizes.count()
    if not count:
        dropped(sizes)
        return None
    marks = sizes.select(key)
    inside = rows.join(F.broadcast(marks) if count <= FEW else marks, key, "left_semi").where("size(ids) > skip")
    children = inside.groupBy(*key, F.col("ids")[F.col("skip")].alias("next")).agg(F.count("*").alias("k")).groupBy(key).agg(F.count("*").alias("children"))
    heads = sizes.join(children, key, "left").select(*key, "ha", "hb", "n_convs", "least", "up", "path", F.coalesce("w", F.lit(0).cast("long")).alias("w"), F.coalesce("children", F.lit(0).cast("long")).alias("children"), (F.col("base") + F.col("skip")).alias("depth"), (~F.expr(_GATE)).alias("node"))
    return written(heads, "trie-burst")


def _swept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes (``kind`` 0) of sorted containers, a row (1) for a container's root that the segment before has, and what a container adds up to (2)."""
    rest = None
    for batch in batches:
        rows = pa.Table.from_batches([batch] if rest is None else [rest, batch]).combine_chunks()
        if not rows.num_rows:
            continue
        # The last container may go on in the next batch.
        key = [*zip(*[rows.column(c).to_pylist() for c in ("base", "skip", "a", "b")])]
        cut = rows.num_rows
        while cut and key[cut - 1] == key[-1]:
            cut -= 1
        if cut:
            yield from _nodes(rows.slice(0, cut).combine_chunks(), key[:cut])
        rest = rows.slice(cut).combine_chunks().to_batches()[0]
    if rest is not None:
        rows = pa.Table.from_batches([rest])
        yield from _nodes(rows, [*zip(*[rows.column(c).to_pylist() for c in ("base", "skip", "a", "b")])])


def _nodes(rows: pa.Table, keys: list[tuple]) -> Iterator[pa.RecordBatch]:
    ids, ws = _chunk(rows.column("ids")), _chunk(rows.column("ws"))
    # From the first row's place on, also where the rows are a slice.
    at = [o - ids.offsets[0].as_py() for o in ids.offsets.to_pylist()]
    flat = ids.flatten()
    xs, ys, words = flat.field("x").to_pylist(), flat.field("y").to_pylist(), ws.flatten().to_pylist()
    n, least, go, up, ha, hb = (rows.column(c).to_pylist() for c in ("n", "least", "go", "up", "ha", "hb"))
    parent, depth, ka, kb, count, conv, weight, goes = ([] for _ in range(8))
    roots: list[tuple[int, int]] = []  # (node, row)
    stack: list[int] = []
    last, before = None, (0, 0)

    def node(up_, d, a, b, w):
        parent.append(up_), depth.append(d), ka.append(a), kb.append(b), weight.append(w)
        count.append(0), conv.append(None), goes.append(False)
        return len(parent) - 1

    for i, key in enumerate(keys):
        base, skip, a, b = key
        lo, hi = at[i] + skip, at[i + 1]
        common = 0
        if key != last:
            stack = [node(-1, base + skip, a, b, words[lo - 1] if skip else 0)]
            roots.append((stack[0], i))
            last = key
        else:
            p, end = before
            while lo + common < hi and p + common < end and xs[lo + common] == xs[p + common] and ys[lo + common] == ys[p + common]:
                common += 1
            del stack[common + 1 :]
        for j in range(lo + common, hi):
            top = stack[-1]
            stack.append(node(top, depth[top] + 1, ka[top] ^ xs[j], kb[top] ^ ys[j], words[j]))
        top = stack[-1]
        count[top] += n[i]
        conv[top] = least[i] if conv[top] is None else min(conv[top], least[i])
        goes[top] |= go[i]
        before = (lo, hi)
    size = len(parent)
    children, leaves, saved = [0] * size, [0] * size, [0] * size
    # A child comes after its parent: from the end, all below a node is known when it is reached.
    for k in range(size - 1, -1, -1):
        if not children[k] and not goes[k]:
            leaves[k] = 1
        saved[k] += (count[k] - 1) * weight[k]
        if (p := parent[k]) >= 0:
            count[p] += count[k]
            conv[p] = conv[k] if conv[p] is None else min(conv[p], conv[k])
            children[p] += 1
            leaves[p] += leaves[k]
            saved[p] += saved[k]
    row = dict(roots)
    above, pa_, pb_, kind = [], [], [], []
    for k in range(size):
        p = parent[k]
        i = row.get(k if p < 0 else p)
        base, skip = keys[i][:2] if i is not None else (0, 0)
        kind.append(1 if p < 0 and base and not skip else 0)
        # A node right below one of the segment before finds its parent by its key.
        beyond = base > 0 and (skip == 1 if p < 0 else skip == 0)
        above.append(up[i] if p < 0 else None if beyond else conv[p])
        pa_.append(None if not beyond else ka[p] if p >= 0 else ha[i])
        pb_.append(None if not beyond else kb[p] if p >= 0 else hb[i])
    long = lambda values: pa.array(values, pa.int64())
    path = _chunk(rows.column("path"))
    none = pa.nulls(size, pa.int64())
    yield pa.RecordBatch.from_arrays([pa.array(kind, pa.int32()), none, none, none, *map(long, (depth, ka, kb, conv, above, count, children, leaves, saved, pa_, pb_)), pa.nulls(size, path.type)], names=_NAMES)
    tops, lines = [k for k, _ in roots], pa.array([i for _, i in roots])
    none = pa.nulls(len(tops), pa.int64())
    pick = lambda values: long([values[k] for k in tops])
    own = [_chunk(rows.column(c)).take(lines) for c in ("base", "ha", "hb")]
    yield pa.RecordBatch.from_arrays([pa.array([2] * len(tops), pa.int32()), *own, *map(pick, (depth, ka, kb)), none, none, none, *map(pick, (children, leaves, saved)), none, none, path.take(lines)], names=_NAMES)


def _chunk(column: pa.ChunkedArray) -> pa.Array:
    return column.chunk(0) if column.num_chunks == 1 else pa.concat_arrays(column.chunks)


def _continued(nodes: DataFrame, done: DataFrame, above: DataFrame | None, sums: DataFrame, parts: DataFrame, segment: int) -> DataFrame:
    """``nodes`` with all that lies below them in later segments.

    What each segment's containers add up to, by the node they hang under, is summed over the tree of these nodes by doubling steps, then goes to the nodes
    on the way to each of them.
    """
    local = sums.where("base > 0").select("base", "ha", "hb", "leaves", "saved")
    gates = done.where("kind = 1").select("depth", "a", "b", "children")
    if above is not None:
        local = local.unionByName(above.where("base > 0").select("base", "ha", "hb", F.lit(0).cast("long").alias("leaves"), F.col("own").alias("saved")))
        gates = gates.unionByName(above.where("not node").select("depth", "a", "b", "children"))
    local = local.groupBy("base", "ha", "hb").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    # A piece that goes on ends in the node (base + segment, end) and began in the node (base, a, b).
    steps = parts.where(~F.col("last")).select((F.col("base") + segment).alias("base"), F.col("end_a").alias("ha"), F.col("end_b").alias("hb"), F.col("base").alias("up"), F.col("a").alias("ua"), F.col("b").alias("ub")).distinct()
    tree = written(local.join(steps, ["base", "ha", "hb"]), "trie-tree")
    while tree.where("up > 0").limit(1).count():
        # Each node gives its sum to the one it points to, and points to where that one points.
        given = tree.where("up > 0").groupBy(F.col("up").alias("base"), F.col("ua").alias("ha"), F.col("ub").alias("hb")).agg(F.sum("leaves").alias("more"), F.sum("saved").alias("much"))
        points = tree.select(F.col("base").alias("up"), F.col("ha").alias("ua"), F.col("hb").alias("ub"), F.col("up").alias("up2"), F.col("ua").alias("ua2"), F.col("ub").alias("ub2"))
        far = tree.join(given, ["base", "ha", "hb"], "left").join(points, ["up", "ua", "ub"], "left")
        zero = F.lit(0).cast("long")
        nxt = written(far.select("base", "ha", "hb", (F.col("leaves") + F.coalesce("more", zero)).alias("leaves"), (F.col("saved") + F.coalesce("much", zero)).alias("saved"), F.coalesce("up2", zero).alias("up"), F.coalesce("ua2", zero).alias("ua"), F.coalesce("ub2", zero).alias("ub")), "trie-tree")
        dropped(tree)
        tree = nxt
    ways = parts.where(~F.col("last")).groupBy("base", "a", "b", "ids").agg(F.first("end_a").alias("ea"), F.first("end_b").alias("eb"))
    ways = ways.join(tree.select((F.col("base") - segment).alias("base"), F.col("ha").alias("ea"), F.col("hb").alias("eb"), "leaves", "saved"), ["base", "ea", "eb"])
    start = F.array(F.struct(F.col("base").alias("depth"), F.col("a").alias("a"), F.col("b").alias("b")))
    on = F.aggregate("ids", start, lambda s, t: F.concat(s, F.array(F.struct((F.element_at(s, -1)["depth"] + 1).alias("depth"), F.element_at(s, -1)["a"].bitwiseXOR(t["x"]).alias("a"), F.element_at(s, -1)["b"].bitwiseXOR(t["y"]).alias("b")))))
    # The node that a later segment begins in is on the way of the segment before, where it has had its share.
    on = F.when(F.col("base") > 0, F.slice(on, 2, segment)).otherwise(on)
    extra = ways.select(F.explode(on).alias("to"), "leaves", "saved").groupBy("to").agg(F.sum("leaves").alias("more"), F.sum("saved").alias("much")).select("to.*", "more", "much")
    key, zero = ["depth", "a", "b"], F.lit(0).cast("long")
    nodes = nodes.join(extra, key, "left").join(gates.withColumnRenamed("children", "kids"), key, "left")
    nodes = written(nodes.select(*key, "conv_id", "parent", "n_convs", (F.col("children") + F.coalesce("kids", zero)).alias("children"), (F.col("leaves") + F.coalesce("more", zero)).alias("leaves"), (F.col("saved") + F.coalesce("much", zero)).alias("saved"), "pa", "pb"), "trie-long")
    found = nodes.where(F.col("depth") % segment == 0).select((F.col("depth") + 1).alias("depth"), F.col("a").alias("pa"), F.col("b").alias("pb"), F.col("conv_id").alias("found"))
    return nodes.join(found, ["depth", "pa", "pb"], "left").withColumn("parent", F.coalesce("parent", "found"))


def _ends(parts: DataFrame) -> DataFrame:
    """``depth``, ``a``, ``b`` of the nodes in which conversations end, and ``ends``, the digest of their ids.

    Ids of one range are joined before they travel; a node's digest runs through its ranges in order and holds none.
    """
    last = parts.where("last").select((F.col("base") + F.size("ids")).alias("depth"), F.col("end_a").alias("a"), F.col("end_b").alias("b"), "conv_id", F.shiftright("conv_id", ID_BITS).alias("range"))
    some = last.groupBy("depth", "a", "b", "range").agg(F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids"))
    rows = some.repartition("depth", "a", "b").sortWithinPartitions("depth", "a", "b", "range").select("depth", "a", "b", "ids")

    def run(batches):
        node = digest = None
        out = []
        for batch in batches:
            for *key, ids in zip(*[c.to_pylist() for c in batch.columns]):
                if key != node:
                    if node is not None:
                        out.append((*node, digest.hexdigest()))
                    node, digest = key, hashlib.sha256()
                else:
                    digest.update(b",")
                digest.update(ids.encode())
            if out:
                yield pa.record_batch([pa.array(c) for c in zip(*out)], ["depth", "a", "b", "ends"])
                out = []
        if node is not None:
            yield pa.record_batch([pa.array(c) for c in zip(*[(*node, digest.hexdigest())])], ["depth", "a", "b", "ends"])

    return rows.mapInArrow(run, f"{_NODE}, ends string")


def with_texts(nodes: DataFrame, turns: DataFrame) -> DataFrame:
    """``nodes`` with ``role`` and ``text`` of their last turn: that of their smallest member, from ``turns`` (``conv_id``, ``pos``, ``role``, ``text``); the root has null."""
    last = turns.select("conv_id", (F.col("pos") + 1).alias("depth"), "role", "text")
    return nodes.join(last, ["conv_id", "depth"], "left")


def rebuilt_trie(conversations: DataFrame, container: int = CONTAINER, segment: int = SEGMENT) -> DataFrame:
    """The :func:`trie` of the :func:`rebuilt` conversations; rows without ``conv_id`` are left out, further columns are ignored."""
    rows = coded(conversations)
    return trie(rebuilt(numbered(rows)), rows.select("conv_id"), container, segment)
