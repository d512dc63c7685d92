"""SimHash near-duplicates by tiled exact comparison.

Fingerprints are compared without loss: equal ones are grouped first, the distinct ones are sorted
by population count into tiles, and each pair of tiles whose population counts can be within the
radius is compared by exclusive-or and bit counts in numpy. A pair of tiles returns a star for each
of its own connected groups, never all pairs; connected components join the stars.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from termwright.llm._shared import dropped, extended, written

#: Distinct fingerprints in a tile.
TILE = 16384
#: Pairs that one numpy call compares: they stay in the processor's cache.
CELLS = 131_072


def fingerprint(words: list[bytes], width: int, seed: int) -> int:
    """The SimHash of a sequence of words: of a bit more than half of all shingles' hashes set makes it set."""
    if not words:
        return 0
    text = b" ".join(words)
    if len(words) <= width:
        hashes = [xxhash.xxh64_intdigest(text, seed)]
    else:
        ends = np.cumsum([len(w) + 1 for w in words])
        starts = [0, *ends[:-1].tolist()]
        digest = xxhash.xxh64_intdigest
        hashes = [digest(text[a:b], seed) for a, b in zip(starts, (ends[width - 1 :] - 1).tolist())]
    counts = np.zeros(64, np.int64)
    own = np.array(hashes, np.uint64)
    for at in range(0, len(own), 65536):
        counts += np.unpackbits(own[at : at + 65536].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > len(own)).tobytes(), "big")


def fingerprints(df: DataFrame, width: int = 4, seed: int = 42, text: str = "text") -> DataFrame:
    """``df`` with ``simhash`` (the 64 bits as a signed long) in place of its texts.

    Words are runs of anything but ASCII white space, A-Z in lower case; a text of fewer words than
    ``width`` is one shingle; a null text, or one without words, has 0.
    """

    def make(texts):
        return [[x - (1 << 64) if x >> 63 else x for x in (fingerprint(t.encode().lower().split(), width, seed) for t in texts)]]

    return extended(df, make, text, T.StructType().add("simhash", "long"))


def tiled(prints: DataFrame, tile: int = TILE) -> DataFrame:
    """``prints`` (``node``, ``simhash``) with ``ones``, their population count, and ``tile``: runs of equal population count, cut to ``tile`` rows."""
    # Salted counts give every row its place without a large group in a task.
    salted = prints.withColumn("ones", F.bit_count("simhash").cast("int")).withColumn("salt", F.pmod(F.xxhash64("simhash"), F.lit(64)).cast("int"))
    sizes = salted.groupBy("ones", "salt").count()
    before = Window.partitionBy("ones").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("first", F.coalesce(F.sum("count").over(before), F.lit(0))).drop("count")
    place = Window.partitionBy("ones", "salt").orderBy("node")
    # At most 65 * 64 sizes.
    return salted.join(F.broadcast(sizes), ["ones", "salt"]).withColumn("tile", ((F.col("first") + F.row_number().over(place) - 1) / tile).cast("long")).drop("salt", "first")


def packed(rows: DataFrame, *columns: str) -> DataFrame:
    """A row for each tile of :func:`tiled`: the ``columns``, longs, as bytes, all in the order of the last."""
    tiles = rows.groupBy("ones", "tile").agg(F.collect_list(F.struct(*columns)).alias("rows"))

    def run(batches):
        for batch in batches:
            own = [batch.column("rows")[i].values for i in range(batch.num_rows)]
            own = [[x.field(c).to_numpy(zero_copy_only=False) for c in columns] for x in own]
            order = [np.argsort(x[-1], kind="stable") for x in own]
            arrays = [pa.array([x[k][o].tobytes() for x, o in zip(own, order)], pa.binary()) for k in range(len(columns))]
            yield pa.RecordBatch.from_arrays([batch.column("ones"), batch.column("tile"), *arrays], names=["ones", "tile", *columns])

    return tiles.mapInArrow(run, "ones int, tile long, " + ", ".join(f"{c} binary" for c in columns))


def tile_pairs(packs: DataFrame, radius: int) -> DataFrame:
    """Each tile with the tiles of its own and of the next ``radius`` population counts: ``ones``, ``tile``, ``other``, ``other_tile``."""
    heads = packs.select("ones", "tile")
    return (
        heads.withColumn("other", F.explode(F.sequence("ones", F.col("ones") + radius)))
        .join(heads.select(F.col("ones").alias("other"), F.col("tile").alias("other_tile")), "other")
        .where((F.col("ones") < F.col("other")) | (F.col("tile") <= F.col("other_tile")))
    )


def linked(prints: DataFrame, radius: int = 4, tile: int = TILE) -> DataFrame:
    """Links (``src``, ``dst``) that join exactly the ``prints`` (``node``, ``simhash``, distinct) within ``radius`` bits.

    Two nodes are connected by the result if and only if a chain of nodes within ``radius`` connects them.
    """
    packs = written(packed(tiled(prints, tile), "simhash", "node"), "simhash-tiles")
    left = packs.select("ones", "tile", "simhash", "node")
    right = packs.select(F.col("ones").alias("other"), F.col("tile").alias("other_tile"), F.col("simhash").alias("simhash2"), F.col("node").alias("node2"))
    met = tile_pairs(packs, radius).join(left, ["ones", "tile"]).join(right, ["other", "other_tile"]).select("simhash", "node", "simhash2", "node2")
    tasks = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return met.repartition(tasks).mapInArrow(lambda batches: _compare(batches, radius), "src long, dst long")


def _compare(batches, radius):
    for batch in batches:
        for at in range(batch.num_rows):
            a, x, b, y = (np.frombuffer(batch.column(i)[at].as_buffer(), kind) for i, kind in enumerate((np.uint64, np.int64) * 2))
            src, dst = stars(a, x, b, y, radius)
            if len(src):
                yield pa.RecordBatch.from_arrays([pa.array(src), pa.array(dst)], names=["src", "dst"])


def stars(a: np.ndarray, x: np.ndarray, b: np.ndarray, y: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links from each node that is not the least of its group to the least; groups are those that bits within ``radius`` between ``a`` and ``b`` connect.

    ``x`` and ``y`` are the node ids of ``a`` and ``b``.
    """
    same = len(a) == len(b) and bool((x == y).all())
    ids = np.unique(np.concatenate([x, y]))
    root = np.arange(len(ids))
    at_x, at_y = np.searchsorted(ids, x), np.searchsorted(ids, y)
    step = max(1, CELLS // max(1, len(b)))
    for start in range(0, len(a), step):
        rest = b[start:] if same else b
        near = np.bitwise_count(a[start : start + step, None] ^ rest[None, :]) <= radius
        i, j = np.nonzero(near)
        if len(i):
            unite(root, at_x[i + start], at_y[j + start * same])
    least = settled(root)
    moved = np.flatnonzero(least != np.arange(len(ids)))
    return ids[moved], ids[least[moved]]


def settled(root: np.ndarray) -> np.ndarray:
    while (jump := root[root] != root).any():
        root[jump] = root[root[jump]]
    return root


def unite(root: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Joins the groups of ``i`` and ``j`` pairwise; afterwards ``root`` holds the least member of each group again."""
    settled(root)
    while True:
        p, q = root[i], root[j]
        apart = p != q
        if not apart.any():
            return
        i, j, p, q = i[apart], j[apart], p[apart], q[apart]
        np.minimum.at(root, np.maximum(p, q), np.minimum(p, q))
        settled(root)


def components(links: DataFrame) -> DataFrame:
    """(``node``, ``component``) for the nodes of ``links`` (``src``, ``dst``): the least node that is connected to it.

    Large-star and small-star rounds in turn until nothing changes; every round is a written table.
    """
    edges = written(links.where("src <> dst").select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v")).distinct(), "links")
    while True:
        # Large star: every larger neighbour of a node is linked to its least neighbour (itself included).
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # Small star: a node and its smaller neighbours are linked to the least of them.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").union(least.select("u", F.col("m").alias("v"))).distinct()
        )
        following = written(small, "links")
        # The graph consists of stars when no centre is a leaf and every leaf has one centre.
        leaf = following.groupBy("u").agg(F.count("*").alias("n"))
        open_leaves = leaf.where("n > 1").limit(1).count()
        open_centres = following.select("v").join(leaf.select(F.col("u").alias("v")), "v", "left_semi").limit(1).count()
        dropped(edges)
        edges = following
        if not open_leaves and not open_centres:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def near_duplicates(df: DataFrame, key: str = "doc_id", width: int = 4, radius: int = 4, seed: int = 42, text: str = "text") -> DataFrame:
    """(``key``, ``fingerprint``, ``component_id``) of each row: its SimHash in hex and the least ``key`` that links reach.

    Fingerprints link at ``radius`` or fewer different bits. Null and wordless texts share the
    fingerprint zero and are linked like any other. Repeated rows come back as often as they came.
    A row with a null key links like any other but names no component: one of such rows alone has null. An empty table gives no rows; a text of any
    length is read whole, once. Further columns are ignored.
    """
    prints = written(fingerprints(df.select(F.col(f"`{key}`").cast("long").alias("node"), F.col(f"`{text}`").alias("text")), width, seed), "simhash")
    # A fingerprint is its own node, so that one whose rows have no key links what is near it; keys give a component its name only.
    distinct = written(prints.groupBy("simhash").agg(F.min("node").alias("id")).withColumn("node", F.col("simhash")), "simhash-distinct")
    reached = components(linked(distinct.select("simhash", "node"), radius))
    member = distinct.join(reached, "node", "left").select("simhash", "id", F.coalesce("component", "node").alias("component"))
    named = member.groupBy("component").agg(F.min("id").alias("component_id"))
    label = member.join(named, "component").select("simhash", "component_id")
    return (
        prints.join(label, "simhash", "left")
        .select(F.col("node").alias(key), F.lower(F.lpad(F.hex("simhash"), 16, "0")).alias("fingerprint"), "component_id")
    )
