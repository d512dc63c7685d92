"""Document fingerprints from closed syncmers, with DataFrame functions only.

A text is a sequence of units (words; single characters in scripts without spaces). A run of ``K``
units is an anchor if the least hash among its runs of ``S`` units lies at one of its edges: that
depends on the run alone, so equal passages have equal anchors wherever they stand. The
fingerprint is the hashes of all anchors in the order of the text, each where it comes first. Two fingerprints are matched by
position: equal anchors count where a neighbour matches at the same distance, as in a passage that both texts have.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termwright.llm._shared import written

#: Units of an anchor, and of the runs inside it. Their hashes stand at K - S + 1 places.
K, S = 5, 2

#: Ideographs, kana, Hangul syllables and Thai letters stand alone; other units are runs without white space.
UNIT = r"[฀-๿぀-ヿ㐀-䶿一-鿿가-힯]|[^\s฀-๿぀-ヿ㐀-䶿一-鿿가-힯]+"


def units(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(UNIT), F.lit(0))


def _anchors(own: Column) -> Column:
    """Of an array of units: (``pos``, ``hash``) of every closed syncmer, in order. A shorter sequence is one anchor, none has none."""
    n = F.size(own)
    inner = F.transform(F.sequence(F.lit(0), n - S), lambda i: F.xxhash64(*[F.get(own, i + j) for j in range(S)]))
    places = K - S + 1

    def chosen(inner: Column) -> Column:
        at = lambda i, j: F.get(inner, i + j)
        # Runs that cover the anchor's units: every S-th of the inner ones, and the last.
        cover = sorted({*range(0, places, S), places - 1})
        found = F.transform(
            F.sequence(F.lit(0), n - K),
            lambda i: F.when(
                F.least(at(i, 0), at(i, places - 1)) <= F.least(*[at(i, j) for j in range(1, places - 1)]),
                F.struct(i.alias("pos"), F.xxhash64(*[at(i, j) for j in cover]).alias("hash")),
            ),
        )
        return F.filter(found, lambda x: x.isNotNull())

    short = F.array(F.struct(F.lit(0).alias("pos"), F.xxhash64(F.array_join(own, " ")).alias("hash")))
    # A one-element transform binds the inner hashes to a name, so they are computed once.
    long = F.get(F.transform(F.array(inner), chosen), F.lit(0))
    return F.when(n >= K, long).when(n > 0, short).otherwise(F.slice(short, 1, 0))


def anchors(text: Column) -> Column:
    """array<struct<pos, hash>> of a text's closed syncmers; null counts as empty, which has none."""
    return F.get(F.transform(F.array(units(F.coalesce(text, F.lit("")))), _anchors), F.lit(0))


def marks(text: Column) -> Column:
    """The distinct hashes of all anchors of a text, as 32-bit numbers, in the order in which they first come."""
    return F.array_distinct(F.transform(anchors(text), lambda a: F.shiftright(a["hash"], 32).cast("int")))


def fingerprint(own: Column) -> Column:
    """Marks as a string: 8 hex digits for each."""
    return F.array_join(F.transform(own, lambda h: F.lower(F.right(F.lpad(F.hex(h), 16, "0"), F.lit(8)))), "")


def _let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def matched(one: Column, other: Column) -> Column:
    """array<long>: the places of the marks that both have, in the order of ``one``; its place stands in the upper 32 bits, that in ``other`` in the lower.

    Marks, sides and places are packed into whole numbers, so that what is equal lies side by side after one plain sort.
    """
    half = 1 << 31
    packed = lambda own, side: F.transform(own, lambda h, i: F.shiftleft(h.cast("long"), 32) + side * half + i)

    def pairs(rows: Column) -> Column:
        def pair(x: Column, k: Column) -> Column:
            y = F.get(rows, k + 1)
            # Equal but for the side and the place: of one text, and then of the other.
            same = (F.shiftright(y, 32) == F.shiftright(x, 32)) & (x.bitwiseAND(half) == 0)
            return F.when(same, F.shiftleft(x.bitwiseAND(half - 1), 32) + y.bitwiseAND(half - 1))

        return F.sort_array(F.filter(F.transform(rows, pair), lambda p: p.isNotNull()))

    return _let(F.sort_array(F.concat(packed(one, 0), packed(other, 1))), pairs)


def held(pairs: Column) -> Column:
    """How many of the :func:`matched` places have a neighbour among them at the same distance."""
    away = lambda p: p.bitwiseAND((1 << 32) - 1) - F.shiftright(p, 32)

    def count(rows: Column) -> Column:
        beside = lambda i, x: F.coalesce(F.get(rows, i) == x, F.lit(False))
        return F.size(F.filter(rows, lambda x, k: F.when(k > 0, beside(k - 1, x)).otherwise(F.lit(False)) | beside(k + 1, x)))

    return _let(F.transform(pairs, away), count)


def likeness(one: Column, other: Column) -> Column:
    """Held matches as a share of the marks of both, 0 to 1. Where a text has a single mark, its match needs no neighbour; two texts without marks are alike."""

    def share(pairs: Column) -> Column:
        both = F.when(F.least(F.size(one), F.size(other)) <= 1, F.size(pairs)).otherwise(held(pairs))
        return both / (F.size(one) + F.size(other) - both)

    return F.when(F.size(one) + F.size(other) == 0, F.lit(1.0)).otherwise(_let(matched(one, other), share))


def neighbours(ids: DataFrame) -> DataFrame:
    """``ids`` (``id``, distinct, and further columns) with ``prev``, a struct of the row whose next one, in descending order, it is; the first follows the last.

    A range partitioning gives ordered buckets; what lies beyond a bucket comes from the table of the buckets' last rows.
    """
    tasks = int(ids.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    whole = F.struct(*ids.columns)
    ranged = ids.repartitionByRange(tasks, F.col("id").desc()).withColumn("bucket", F.spark_partition_id())
    ranged = written(ranged, "syncmer-ids")
    last = ranged.groupBy("bucket").agg(F.min_by(whole, F.col("id")).alias("last"))
    # One row for each bucket: their number is the setting of shuffle partitions, whatever the input.
    order = Window.orderBy("bucket")
    ends = last.withColumn("before", F.coalesce(F.lag("last").over(order), F.last("last").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))).select("bucket", "before")
    own = Window.partitionBy("bucket").orderBy(F.col("id").desc())
    return ranged.withColumn("prev", F.lag(whole).over(own)).join(F.broadcast(ends), "bucket").withColumn("prev", F.coalesce("prev", "before")).drop("bucket", "before")


def compared(documents: DataFrame) -> DataFrame:
    """Each document's fingerprint beside those of its edited text and of the next document.

    The next document is that of the next lower ``doc_id``; after the lowest comes the highest. The
    edited text has the last floor(n / 2) code points replaced by the first as many of the next one's.
    A null text counts as empty. Of rows that share a ``doc_id``, each is compared, and the text of the least hash stands for them as a next document;
    a row without ``doc_id`` has an empty next document and is nobody's. A lone document is its own next one. A text without a word or letter has no anchors and the
    empty fingerprint. Texts are read whole, whatever their length; an empty table gives no rows. Further columns are ignored.
    """
    docs = documents.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    ids = docs.where("doc_id is not null").groupBy(F.col("doc_id").alias("id")).agg(F.max(F.floor(F.length("text") / 2)).alias("half"))
    follows = neighbours(ids).select("id", F.col("prev.id").alias("for_id"), F.col("prev.half").alias("need"))
    # Both joins below read the same rows by the same key, so the texts are shuffled once for both; marks are made behind it.
    own = docs.where("doc_id is not null")
    # As a next document only the head that the other's edit needs travels, and the marks.
    head = F.substring(F.col("text"), F.lit(1), F.col("need").cast("int"))
    heads = own.join(follows, own["doc_id"] == follows["id"]).select("for_id", F.struct(head.alias("head"), marks(F.col("text")).alias("marks")).alias("next"), F.xxhash64("text").alias("order"))
    heads = heads.groupBy("for_id").agg(F.min_by("next", "order").alias("next"))
    both = own.join(heads, own["doc_id"] == heads["for_id"], "left").drop("for_id")
    alone = docs.where("doc_id is null").withColumn("next", F.lit(None).cast(both.schema["next"].dataType))
    both = both.unionByName(alone).withColumn("n_chars", F.length("text").cast("long")).withColumn("marks", marks(F.col("text")))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = both.withColumn("edited", F.concat(F.substring(F.col("text"), F.lit(1), F.col("n_chars").cast("int") - half), F.substring(F.coalesce("next.head", F.lit("")), F.lit(1), half)))
    edited = edited.withColumn("edited_marks", marks(F.col("edited")))
    none = F.slice(F.col("marks"), 1, 0)
    return edited.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprint(F.col("marks")).alias("fingerprint"),
        fingerprint(F.col("edited_marks")).alias("edited_fingerprint"),
        likeness(F.col("marks"), F.col("edited_marks")).alias("near_edited"),
        likeness(F.col("marks"), F.coalesce("next.marks", none)).alias("near_next"),
    )
