"""Matching of item rows against a catalogue: candidates, scores, ranks, features, calculations.

All tables are long: one row for each (item, candidate), (component, name), (component, attribute). A
catalogue's order is its column ``pos``, which breaks every tie.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termwright.functions import constants as C
from termwright.functions import text as X

STRONG = ("exact", "normalized", "alias_bridge")


def component_aliases(components: DataFrame, name: str = "component") -> DataFrame:
    """``components`` with ``alias`` and its place ``alias_pos``: the name, without affixes, with concrete words swapped, normalised."""
    n = X.blank_to_empty(F.col(name))
    options = F.array(
        n,
        X.strip_affixes(n),
        F.when(n.contains("砼"), F.replace(n, F.lit("砼"), F.lit("混凝土"))),
        F.when(n.contains("混凝土"), F.replace(n, F.lit("混凝土"), F.lit("砼"))),
        X.normalize_text(n),
    )
    names = F.array_distinct(F.filter(options, lambda x: x.isNotNull() & (x != "")))
    return components.select("*", F.posexplode(names).alias("alias_pos", "alias"))


def alias_index(aliases: DataFrame, bridges: DataFrame | None = None) -> DataFrame:
    """(``key``, ``component``, ``priority``): the normalised aliases, with and without affixes, then bridges, then special items; the first place of each pair counts."""
    keys = lambda c: F.array_distinct(F.filter(F.array(X.normalize_text(c), X.normalize_text(X.strip_affixes(c))), lambda x: x != ""))
    own = aliases.select(F.explode(keys(F.col("alias"))).alias("key"), "component", F.lit(0).alias("priority"), F.col("pos").cast("long").alias("pos"))
    if bridges is not None:
        own = own.unionByName(bridges.select(F.explode(keys(F.col("bridge"))).alias("key"), "component", F.lit(1).alias("priority"), F.col("pos").cast("long").alias("pos")))
    # The special items are a fixed list of constants.
    special = F.array(*[F.struct(F.lit(k).alias("item"), F.lit(c).alias("component")) for k, cs in C.SPECIAL_ITEMS.items() for c in cs])
    fixed = own.sparkSession.range(1).select(F.posexplode(special).alias("pos", "s")).select(X.normalize_text(F.col("s.item")).alias("key"), F.col("s.component").alias("component"), F.lit(2).alias("priority"), F.col("pos").cast("long").alias("pos"))
    return own.unionByName(fixed).groupBy("key", "component").agg(F.min(F.struct("priority", "pos")).alias("first")).select("key", "component", F.col("first.priority").alias("priority"), F.col("first.pos").alias("pos"))


def alias_candidates(rows: DataFrame, index: DataFrame, name: str = "name") -> DataFrame:
    """(``row_id``, ``component``): components that the index has for a row's name, with or without affixes."""
    keys = rows.select("row_id", F.explode(F.array_distinct(F.array(X.normalize_text(F.col(name)), X.normalize_text(X.strip_affixes(F.col(name)))))).alias("key"))
    return keys.join(index.select("key", "component"), "key").select("row_id", "component").distinct()


def characters(text: Column) -> Column:
    return F.array_distinct(F.filter(F.split(text, ""), lambda c: c != ""))


def query_form(query: Column) -> Column:
    """struct<q, s, tokens, chars>: what :func:`score_forms` needs of a query, made once for each."""
    n = X.normalize_text(query)
    return F.struct(n.alias("q"), X.normalize_text(X.strip_affixes(query)).alias("s"), X.core_tokens(query).alias("tokens"), characters(n).alias("chars"))


def name_forms(names: Column) -> Column:
    """array<struct<n, s, chars>>: what :func:`score_forms` needs of a component's names, made once for each."""
    return F.transform(F.transform(names, lambda n: F.struct(X.normalize_text(n).alias("n"), X.normalize_text(X.strip_affixes(n)).alias("s"))), lambda x: F.struct(x["n"].alias("n"), x["s"].alias("s"), characters(x["n"]).alias("chars")))


def score_forms(f: Column, forms: Column) -> Column:
    """struct<score, basis> of a query's form against the forms of an ordered array of names.

    Names are folded in order: the score is the best one's, while the basis is what the last
    rule that applied has set. An equal name ends the search.
    """

    def step(a: Column, c: Column) -> Column:
        put = lambda score, basis, done=False: F.struct(score.alias("score"), basis.alias("basis"), F.lit(done).alias("done"))
        jaccard = F.size(F.array_intersect(f["chars"], c["chars"])) / F.greatest(F.size(F.array_union(f["chars"], c["chars"])), F.lit(1))
        token = F.exists(f["tokens"], lambda t: c["n"].contains(t) | t.contains(c["n"]))
        return (
            F.when(a["done"] | (c["n"] == ""), a)
            .when(f["q"] == c["n"], put(F.lit(1.0), F.lit("exact"), True))
            .when(((f["s"] != "") & (f["s"] == c["n"])) | ((c["s"] != "") & (f["q"] == c["s"])), put(F.greatest(a["score"], F.lit(0.95)), F.lit("normalized")))
            .when((f["q"] != "") & (c["n"].contains(f["q"]) | f["q"].contains(c["n"])), put(F.greatest(a["score"], F.lit(0.88)), F.when(a["basis"] == "normalized", "normalized").otherwise("contains")))
            .when(token, F.when(a["score"] < 0.82, put(F.lit(0.82), F.lit("token_contains"))).otherwise(a))
            .when(jaccard > a["score"], put(jaccard, F.lit("fuzzy")))
            .otherwise(a)
        )

    start = F.struct(F.lit(0.0).alias("score"), F.lit("fuzzy").alias("basis"), F.lit(False).alias("done"))
    return F.aggregate(forms, start, step)


def score_names(query: Column, names: Column) -> Column:
    """struct<score, basis> of a query against an ordered array of names, see :func:`score_forms`."""
    # The query's own forms are bound once, as the first element of an array.
    return F.get(F.transform(F.array(query_form(query)), lambda f: score_forms(f, name_forms(names))), F.lit(0))


#: Pairs of a key that one task makes; a key with more is dealt over so many tasks that none makes more. Heavy keys up to which their list is broadcast.
HEAVY, FEW = 1_000_000, 10_000


def dealt_join(left: DataFrame, right: DataFrame, key: list[str], heavy: int = HEAVY) -> DataFrame:
    """The inner join of two sides on ``key``. The left rows of a key with more than ``heavy`` pairs are dealt over salts, and only its right rows are repeated for each salt."""
    count = lambda side, name: side.groupBy(*key).agg(F.count("*").alias(name))
    pairs = F.col("__l") * F.col("__r")
    large = count(left, "__l").join(count(right, "__r"), key).where(pairs > heavy).select(*key, F.least(F.ceil(pairs / heavy), F.col("__l")).cast("int").alias("__salts"))
    few = large.count()
    if not few:
        return left.join(right, key)
    marks = F.broadcast(large) if few <= FEW else large
    salts = F.coalesce("__salts", F.lit(1))
    others = [c for c in left.columns if c not in key]
    dealt = left.join(marks, key, "left").withColumn("__salt", F.pmod(F.xxhash64(*others), salts).cast("int")).drop("__salts")
    repeated = right.join(marks, key, "left").withColumn("__salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("__salts")
    return dealt.join(repeated, [*key, "__salt"]).drop("__salt")


def grams(text: Column, n: int) -> Column:
    """The distinct runs of ``n`` characters of a text; empty if it is shorter."""
    return F.when(F.length(text) >= n, F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(text) - n + 1), lambda i: F.substring(text, i, F.lit(n))))).otherwise(F.array().cast("array<string>"))


#: Characters of the runs by which a text is found inside another; a shorter text is one run.
GRAM = 3


def block_pairs(rows: DataFrame, names: DataFrame, least: float = 0.55, heavy: int = HEAVY) -> DataFrame:
    """(``row_id``, ``component``) pairs that can score at least ``least``, found by equi joins, without comparing all.

    ``rows`` are (``row_id``, ``name``), ``names`` are (``component``, ``name``). Characters are ranked by how many
    names have them, rarest first. Sets whose Jaccard likeness reaches ``least`` share one of the first
    n - ceil(``least`` n) + 1 of each, have sizes of the same or of neighbouring classes (which grow by 1 / ``least``), and from the first one that they share on
    there are enough left in both. A text inside another has its rarest run of ``GRAM`` characters among those of the other. Keys with many pairs are
    dealt over tasks.
    """
    a = rows.select("row_id", X.normalize_text(F.col("name")).alias("n")).where("n <> ''")
    b = names.select("component", X.normalize_text(F.col("name")).alias("n")).where("n <> ''")
    # Distinct texts only: the pairs of equal texts are the same.
    texts = a.select("n", F.lit(1).alias("l"), F.lit(0).alias("r")).union(b.select("n", F.lit(0), F.lit(1))).groupBy("n").agg(F.max("l").alias("l"), F.max("r").alias("r"))
    chars = texts.select("*", F.explode(characters(F.col("n"))).alias("c"))
    rank = chars.groupBy("c").agg(F.count("*").alias("often"))
    order = Window.partitionBy("n").orderBy("often", "c")
    ranked = chars.join(rank, "c").withColumn("place", F.row_number().over(order)).withColumn("size", F.count("*").over(Window.partitionBy("n")))
    head = ranked.where(F.col("place") <= F.col("size") - F.ceil(F.col("size") * least) + 1)
    # A likeness of ``least`` allows one class of sizes more or less.
    head = head.withColumn("class", F.floor(F.log("size") / math.log(1 / least) + 1e-9).cast("int"))
    left = head.where("l = 1").select("c", F.explode(F.array(F.col("class") - 1, F.col("class"), F.col("class") + 1)).alias("class"), F.col("n").alias("x"), F.col("place").alias("px"), F.col("size").alias("sx"))
    right = head.where("r = 1").select("c", "class", F.col("n").alias("y"), F.col("place").alias("py"), F.col("size").alias("sy"))
    met = dealt_join(left, right, ["c", "class"], heavy)
    enough = F.least(F.col("sx") - F.col("px"), F.col("sy") - F.col("py")) + 1 >= (F.col("sx") + F.col("sy")) * (least / (1 + least)) - 1e-9
    alike = met.where((F.least("sx", "sy") >= F.greatest("sx", "sy") * least - 1e-9) & enough).select("x", "y").distinct()
    jaccard = F.size(F.array_intersect(characters(F.col("x")), characters(F.col("y")))) / F.size(F.array_union(characters(F.col("x")), characters(F.col("y"))))
    alike = alike.where(jaccard >= least)
    inside = _inside(texts.where("l = 1").select("n"), texts.where("r = 1").select("n"), heavy).select(F.col("whole").alias("x"), F.col("part").alias("y"))
    around = _inside(texts.where("r = 1").select("n"), texts.where("l = 1").select("n"), heavy).select(F.col("part").alias("x"), F.col("whole").alias("y"))
    close = alike.union(inside).union(around).distinct()
    # Components are found first, so that a name that many rows have meets each once.
    reached = close.join(b.withColumnRenamed("n", "y"), "y").select("x", "component").distinct()
    return a.join(reached, F.col("n") == F.col("x")).select("row_id", "component").distinct()


def _inside(wholes: DataFrame, parts: DataFrame, heavy: int) -> DataFrame:
    """(``whole``, ``part``): the texts ``n`` of ``parts`` that stand in those of ``wholes``."""
    size = F.least(F.length("n"), F.lit(GRAM))
    own = F.concat(*[F.when(size == n, grams(F.col("n"), n)).otherwise(F.array().cast("array<string>")) for n in range(1, GRAM + 1)])
    runs = parts.select("n", F.explode(own).alias("gram"))
    every = wholes.select("n", F.explode(F.concat(*[grams(F.col("n"), n) for n in range(1, GRAM + 1)])).alias("gram"))
    often = every.groupBy("gram").agg(F.count("*").alias("often"))
    # A run that no whole text has ends the search for its part.
    known = runs.join(often, "gram", "left").groupBy("n").agg(F.min(F.struct(F.coalesce("often", F.lit(0)).alias("often"), "gram")).alias("rarest"))
    key = known.where("rarest.often > 0").select(F.col("n").alias("part"), F.col("rarest.gram").alias("gram"))
    met = dealt_join(every.select("gram", F.col("n").alias("whole")), key, ["gram"], heavy)
    return met.where(F.col("whole").contains(F.col("part"))).select("whole", "part")


def rank_candidates(rows: DataFrame, catalog: DataFrame, index: DataFrame, top: int = 3) -> DataFrame:
    """The best ``top`` components of each row: ``row_id``, ``component``, ``score``, ``basis``, ``rank``.

    ``rows`` are (``row_id``, ``name``, ``unit``), ``catalog`` is (``component``, ``pos``, ``names``, ``units``). Components that
    the alias index names count; only for rows without any, those that can be alike are scored. A candidate stays at
    three quarters of the row's best score, and 0.62 at least. Rows of the same name and unit have the same candidates, which are ranked once.
    """
    every = rows.select("row_id", "name", X.normalize_unit(F.col("unit")).alias("unit"))
    # A row without a name has no candidate; the name and the unit stand for all rows that have them.
    asked = every.where("name is not null").select("name", "unit").distinct().select(F.struct("name", "unit").alias("row_id"), "name", "unit")
    ranked = _ranked(asked, catalog, index, top).select(F.col("row_id.name").alias("said"), F.col("row_id.unit").alias("counted"), "component", "score", "basis", "rank")
    own = every.join(ranked, (F.col("name") == F.col("said")) & F.col("unit").eqNullSafe(F.col("counted")))
    return own.select("row_id", "component", "score", "basis", "rank")


def _ranked(rows: DataFrame, catalog: DataFrame, index: DataFrame, top: int) -> DataFrame:
    """:func:`rank_candidates` of rows that all differ in their name or unit."""
    found = alias_candidates(rows, index).join(catalog.select("component"), "component", "left_semi").withColumn("explicit", F.lit(True))
    rest = rows.join(found.select("row_id").distinct(), "row_id", "left_anti")
    named = catalog.select("component", F.explode("names").alias("name"))
    # A name also meets what holds one of its core words.
    alike = block_pairs(rest.select("row_id", F.explode(F.array_union(F.array("name"), X.core_tokens(F.col("name")))).alias("name")), named)
    special = _special_pairs(rows).join(catalog.select("component"), "component", "left_semi")
    more = special.join(found.select("row_id").distinct(), "row_id", "left_anti").select("row_id", "component")
    pairs = found.unionByName(alike.union(more).distinct().withColumn("explicit", F.lit(False)))
    specials = special.withColumn("special", F.lit(True))
    # Names repeat from row to row: each name is scored against a component once.
    named_pairs = pairs.join(rows, "row_id")
    # The forms of a name and of a component's names are made before they meet.
    asked = rows.select("name").distinct().withColumn("f", query_form(F.col("name")))
    known = catalog.select("component", name_forms(F.col("names")).alias("forms"))
    scores = named_pairs.select("name", "component").distinct().join(asked, "name").join(known, "component").select("name", "component", score_forms(F.col("f"), F.col("forms")).alias("s"))
    scored = (
        named_pairs.join(scores, ["name", "component"])
        .join(catalog.select("component", "pos", "units"), "component")
        .join(specials, ["row_id", "component"], "left")
        .withColumn("score0", F.greatest(F.col("s.score"), F.when(F.col("explicit"), 0.93).otherwise(0.0)))
        .withColumn("basis0", F.when(F.col("explicit") & ~F.col("s.basis").isin("exact", "normalized"), "alias_bridge").otherwise(F.col("s.basis")))
    )
    by_special = F.coalesce("special", F.lit(False)) & ~F.col("basis0").isin(*STRONG)
    score = F.greatest("score0", F.when(by_special, 0.88).otherwise(0.0))
    family = F.when((X.classify_family(F.col("component")) == X.classify_family(F.col("name"))) & (score > 0), 0.04).otherwise(0.0)
    unit = F.when((F.col("unit") != "") & F.array_contains("units", F.col("unit")), 0.03).otherwise(0.0)
    ranked = scored.select("row_id", "component", "pos", F.round(F.least(score + family + unit, F.lit(1.0)), 4).alias("score"), F.when(by_special, "special_rule").otherwise(F.col("basis0")).alias("basis"))
    own = Window.partitionBy("row_id")
    kept = ranked.withColumn("best", F.max("score").over(own)).where(F.col("score") >= F.greatest(F.col("best") * 0.75, F.lit(0.62)))
    return kept.withColumn("rank", F.row_number().over(own.orderBy(F.desc("score"), "pos"))).where(F.col("rank") <= top).select("row_id", "component", "score", "basis", "rank")


def _special_pairs(rows: DataFrame) -> DataFrame:
    """(``row_id``, ``component``) of the fixed special items whose name the row's name is, or else contains."""
    items = [*C.SPECIAL_ITEMS.items()]
    exact = reduce(lambda w, i: w.when(F.col("name") == i[0], F.array(*map(F.lit, i[1]))), items[1:], F.when(F.col("name") == items[0][0], F.array(*map(F.lit, items[0][1]))))
    n = X.normalize_text(F.col("name"))
    part = F.flatten(F.array(*[F.when(n.contains(X.normalize_text(F.lit(k))), F.array(*map(F.lit, cs))).otherwise(F.array().cast("array<string>")) for k, cs in items]))
    return rows.select("row_id", F.explode(F.array_distinct(F.coalesce(exact, part))).alias("component"))


def chapter_fallback(rows: DataFrame, ranked: DataFrame, fallback: DataFrame, top: int = 3) -> DataFrame:
    """For rows (``row_id``, ``chapter``) without a candidate: the first of the chapter's fixed components (``chapter``, ``component``, ``pos``)."""
    left = rows.join(ranked.select("row_id").distinct(), "row_id", "left_anti").withColumn("chapter", X.section_root(F.col("chapter")))
    first = fallback.withColumn("rank", F.row_number().over(Window.partitionBy("chapter").orderBy("pos"))).where(F.col("rank") <= top)
    return left.join(first, "chapter").select("row_id", "component", F.lit(0.65).alias("score"), F.lit("chapter_fallback").alias("basis"), "rank")


def explode_features(rows: DataFrame, text: str = "features") -> DataFrame:
    """(``row_id``, ``feature_order``, ``raw_text``) of numbered feature texts; a line without a number has its place as one."""
    clean = X.clean_features(F.col(text))
    inline = F.regexp_extract_all(clean, F.lit(r"(\d+\s*[.\-]\s*.+?)(?=\s+\d+\s*[.\-]|$)"), F.lit(1))
    parts = F.when(clean.contains("\n"), F.split(clean, "\n")).when(F.size(inline) > 0, inline).when(clean != "", F.array(clean))
    lines = rows.select("row_id", F.posexplode(F.filter(F.transform(parts, lambda x: F.trim(x)), lambda x: x != "")).alias("at", "line"))
    form = r"^\s*(\d+)\s*[.\-]?\s*(.+?)\s*$"
    number = F.col("line").rlike(form)
    return lines.select(
        "row_id",
        F.when(number, F.regexp_extract("line", form, 1).cast("int")).otherwise(F.col("at") + 1).alias("feature_order"),
        F.when(number, F.regexp_extract("line", form, 2)).otherwise(F.trim("line")).alias("raw_text"),
        F.col("at").alias("place"),
    ).where("raw_text <> ''")


def feature_values(text: Column) -> Column:
    """struct<label, value> of a feature: comparison words as signs, then ``label sign value``, or a strength or number with unit at the end."""
    own = X.replaced(X.blank_to_empty(text), C.COMPARISONS)
    sign, tail = r"^(.*?)(>=|<=|>|<|=)\s*(.+?)$", r"(?i)^(.*?)(C\d{2,3}(?:\.\d+)?|\d+(?:\.\d+)?\s*(?:mm|cm|m|m2|m3|kg|t|MPa|%|级))$"
    bare = lambda c: F.regexp_replace(c, "^[ ：:.]+|[ ：:.]+$", "")
    return (
        F.when(own.rlike(sign), F.struct(bare(F.regexp_extract(own, sign, 1)).alias("label"), F.concat(F.regexp_extract(own, sign, 2), F.trim(F.regexp_extract(own, sign, 3))).alias("value")))
        .when(own.rlike(tail), F.struct(bare(F.regexp_extract(own, tail, 1)).alias("label"), F.trim(F.regexp_extract(own, tail, 2)).alias("value")))
        .otherwise(F.struct(bare(X.blank_to_empty(text)).alias("label"), F.lit("").alias("value")))
    )


def attribute_score(label: Column, name: Column, code: Column) -> Column:
    """How well a label fits an attribute: equal, a hint of its code, contained, or alike in characters."""
    a, b = X.normalize_text(label), X.normalize_text(name)
    hints = reduce(lambda w, i: w.when(code == i[0], F.array(*[F.lit(x) for x in i[1]])), [*C.ATTRIBUTE_HINTS.items()][1:], F.when(code == "TLX", F.array(*[F.lit(x) for x in C.ATTRIBUTE_HINTS["TLX"]])))
    words = F.filter(F.transform(F.concat(F.array(name), F.coalesce(hints, F.array().cast("array<string>"))), X.normalize_text), lambda k: k != "")
    jaccard = F.size(F.array_intersect(characters(a), characters(b))) / F.greatest(F.size(F.array_union(characters(a), characters(b))), F.lit(1))
    within = F.exists(words, lambda k: k.contains(a) | a.contains(k))
    best = F.greatest(
        F.when(b.contains(a) | a.contains(b), 0.9).otherwise(0.0), F.when(F.array_contains(words, a), 0.98).otherwise(0.0), F.when(within & ~F.array_contains(words, a) | F.exists(words, lambda k: (k != a) & (k.contains(a) | a.contains(k))), 0.92).otherwise(0.0), jaccard
    )
    return F.when((a == "") | (b == ""), 0.0).when(a == b, 1.0).otherwise(F.round(best, 4))


def features_or_hints(features: DataFrame, hints: DataFrame) -> DataFrame:
    """Features (``row_id``, ``feature_order``, ``raw_text``), and for rows without any the ``hints`` (``row_id``, ``features``: an array) of their chapter's rules, each once and numbered."""
    own = features.select("row_id", "feature_order", "raw_text")
    rest = hints.join(own.select("row_id").distinct(), "row_id", "left_anti")
    told = F.array_distinct(F.filter("features", lambda x: F.trim(x) != ""))
    return own.unionByName(rest.select("row_id", F.posexplode(told).alias("at", "raw_text")).select("row_id", (F.col("at") + 1).alias("feature_order"), "raw_text"))


def match_features(features: DataFrame, attributes: DataFrame, least: float = 0.55) -> DataFrame:
    """Each feature (``row_id``, ``component``, ``feature_order``, ``raw_text``) with its best attribute (``component``, ``name``, ``code``, ``pos``), the first of equals, if it scores ``least``."""
    parts = features.withColumn("v", feature_values(F.col("raw_text"))).select("*", F.col("v.label").alias("label"), F.col("v.value").alias("value")).drop("v")
    pairs = parts.select("component", "label").distinct().join(attributes, "component").withColumn("score", attribute_score(F.col("label"), F.col("name"), F.col("code"))).where(F.col("score") >= least)
    best = pairs.groupBy("component", "label").agg(F.max_by(F.struct("name", "code", "score"), F.struct("score", (-F.col("pos")).alias("p"))).alias("a"))
    return parts.join(best, ["component", "label"], "left").select(
        "row_id",
        "component",
        "feature_order",
        "raw_text",
        "label",
        "value",
        F.col("a.name").alias("attribute_name"),
        F.col("a.code").alias("attribute_code"),
        F.when(F.col("a").isNull(), F.col("raw_text")).otherwise(F.concat("label", F.lit(":"), F.col("a.code"), F.when(F.col("value") != "", F.concat(F.lit("="), "value")).otherwise(""))).alias("expression"),
        F.col("a").isNotNull().alias("matched"),
    )


def _preferred(name: Column, rule: Column, unit: Column, chapter: Column | None) -> Column:
    """Struct of the ``codes`` of calculations that a row points to, best first, and the ``words`` that a calculation's name then has."""
    text = F.concat_ws("\n", name, rule)
    array = lambda values: F.array(*map(F.lit, values)).cast("array<string>")
    both = lambda codes, words: F.struct(codes.alias("codes"), words.alias("words"))
    cases = [(reduce(lambda a, b: a | b, [text.contains(w) for w in said]), both(array(codes), array(words))) for said, codes, words in C.PREFERRED_CODES]
    if chapter is not None:
        # None of the words stands in the row here: the codes are the words.
        cases.append((F.size(F.coalesce(chapter, array(()))) > 0, both(chapter, chapter)))
    cases += [(unit == u, both(array(codes), array(words))) for u, codes, words in C.UNIT_CODES]
    cases.append((unit.isin(*C.COUNT_UNITS), both(array(("SL",)), array(("数量",)))))
    first, *rest = cases
    return reduce(lambda w, c: w.when(*c), rest, F.when(*first)).otherwise(both(array(()), array(())))


def calculation_preference(name: Column, rule: Column, unit: Column, chapter: Column | None = None) -> Column:
    """The calculation codes that a row points to, best first: by words of name and rule, else those of its ``chapter``'s rules, else by the unit."""
    return _preferred(name, rule, unit, chapter)["codes"]


def select_calculation(rows: DataFrame, calculations: DataFrame, least: float = 0.25) -> DataFrame:
    """Each row (``row_id``, ``component``, ``name``, ``rule``, ``unit``, and ``chapter_codes`` if there are) with the best calculation (``component``, ``calc_code``, ``calc_name``, ``calc_unit``, ``pos``), else a generic code."""
    chapter = F.col("chapter_codes") if "chapter_codes" in rows.columns else None
    own = rows.withColumn("preferred", _preferred(F.col("name"), F.col("rule"), F.col("unit"), chapter)).select("*", "preferred.*").drop("preferred")
    place = F.array_position("codes", F.col("calc_code"))
    score = F.round(
        F.when(place > 0, 0.7 - (place - 1) * 0.05).otherwise(0.0)
        + F.when((F.col("unit") != "") & (F.col("calc_unit") == F.col("unit")), 0.25).otherwise(0.0)
        + F.when(F.exists("words", lambda w: F.col("calc_name").contains(w)), 0.2).otherwise(0.0)
        + F.when(F.col("name").contains("模板") & F.col("calc_name").contains("模板"), 0.25).otherwise(0.0),
        4,
    )
    scored = own.join(calculations, "component").withColumn("score", score).where(F.col("score") >= least)
    best = scored.groupBy("row_id", "component").agg(F.max_by(F.struct("calc_code", "calc_name", "calc_unit", "score"), F.struct("score", (-F.col("pos")).alias("p"))).alias("b"))
    generic = F.get(F.filter("codes", lambda c: c.isin("TJ", "MJ", "CD", "SL")), F.lit(0))
    return own.join(best, ["row_id", "component"], "left").select(
        "row_id",
        "component",
        F.coalesce("b.calc_code", generic, F.lit("")).alias("calc_code"),
        F.coalesce("b.calc_name", F.when(generic == "TJ", "体积").when(generic == "MJ", "面积").when(generic == "CD", "长度").when(generic == "SL", "数量"), F.lit("")).alias("calc_name"),
        F.when(F.col("unit") != "", F.col("unit")).otherwise(F.coalesce("b.calc_unit", F.when(generic == "TJ", "m3").when(generic == "MJ", "m2").when(generic == "CD", "m"), F.lit(""))).alias("unit"),
    )


def match_status(best: Column, basis: Column) -> Column:
    """``matched`` for a score of 0.8 on a strong basis, ``candidate_only`` for any other candidate, else ``unmatched``."""
    return F.when(best.isNull(), "unmatched").when((best >= 0.8) & basis.isin(*C.STRONG_BASES), "matched").otherwise("candidate_only")


def local_match(rows: DataFrame, catalog: DataFrame, index: DataFrame) -> DataFrame:
    """One row for each item: its best component, score, basis and status, without any model."""
    best = rank_candidates(rows, catalog, index).where("rank = 1").drop("rank")
    return rows.join(best, "row_id", "left").withColumn("status", match_status(F.col("score"), F.col("basis")))


def local_results(matches: DataFrame, attributes: DataFrame, calculations: DataFrame, hints: DataFrame | None = None) -> DataFrame:
    """The rows of :func:`local_match` with the features and the calculation of their component: ``n_features``, ``found``, ``expressions``, ``calc_code``, ``calc_unit``.

    Rows without features of their own take the ``hints`` of their chapter, and where no word of a row says how it is counted, their ``codes`` do.
    """
    known = matches.where("component is not null")
    own = explode_features(known)
    own = features_or_hints(own, hints) if hints is not None else own
    features = match_features(own.join(known.select("row_id", "component"), "row_id"), attributes)
    said = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("feature_order", "expression"))), lambda x: x["expression"]), "|")
    counted = features.groupBy("row_id").agg(F.count("*").alias("n_features"), F.count_if("matched").alias("found"), said.alias("expressions"))
    priced = known.select("row_id", "component", "name", "rule", X.normalize_unit(F.col("unit")).alias("unit"))
    if hints is not None and "codes" in hints.columns:
        priced = priced.join(hints.select("row_id", F.col("codes").alias("chapter_codes")), "row_id", "left")
    calculation = select_calculation(priced, calculations)
    out = matches.select("row_id", "component", "score", "basis", "status").join(counted, "row_id", "left").join(calculation.select("row_id", "calc_code", F.col("unit").alias("calc_unit")), "row_id", "left")
    return out.na.fill(0, ["n_features", "found"]).na.fill("", ["expressions", "calc_code", "calc_unit"])


def match_statistics(matches: DataFrame) -> DataFrame:
    """Totals by status; of the rows with ``features`` and with a ``calc_code`` too, where there are such columns."""
    has = lambda c, test: [F.count_if(test).alias(f"with_{c}")] if c in matches.columns else []
    return matches.agg(
        *has("features", ~F.trim(F.coalesce(F.col("features").cast("string"), F.lit(""))).isin("", "0")),
        *has("calc_code", F.coalesce("calc_code", F.lit("")) != ""),
        F.count("*").alias("total"),
        F.count_if(F.col("status") == "matched").alias("matched"),
        F.count_if(F.col("status") == "candidate_only").alias("candidate_only"),
        F.count_if(F.col("status") == "unmatched").alias("unmatched"),
        F.count_distinct("component").alias("components"),
    )
