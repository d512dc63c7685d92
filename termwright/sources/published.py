"""Several tables published as one generation: written beside the old ones, and seen all at once.

A manifest lists where the parts of each table are. Writers put all new parts into the shared store first and
then add the next manifest; readers follow the last one. A write that fails leaves no manifest, so the old generation stays what is read.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termwright.sources.shared import file_system

#: The column of a table's parts, and of a table in one part.
PART, WHOLE = "__part", "all"


@dataclass
class Manifest:
    """``tables``: for each its schema as JSON and its parts, each with path, digest and rows. ``number`` counts generations from 1."""

    number: int = 0
    tables: dict = field(default_factory=dict)


def manifest(spark: SparkSession, root: str) -> Manifest:
    """The last manifest of a store; of an empty one, number 0."""
    files, at = file_system(spark, f"{root}/manifests")
    numbers = [int(f.getPath().getName()[:-5]) for f in (files.listStatus(at) if files.exists(at) else []) if f.getPath().getName().endswith(".json")]
    if not numbers:
        return Manifest()
    text = spark.read.text(f"{root}/manifests/{max(numbers):08d}.json", wholetext=True).first()[0]
    return Manifest(**json.loads(text))


def _digests(df: DataFrame) -> dict:
    """For each part the rows and a digest that no order changes. A table has no more parts than its key has values, which the writer chooses."""
    row = F.struct(*[c for c in df.columns if c != PART])
    one = F.xxhash64(F.to_json(row, {"ignoreNullFields": "false"}))
    found = df.groupBy(PART).agg(F.count("*").alias("n"), F.sum(one.cast("decimal(38,0)")).alias("s"), F.bit_xor(one).alias("x")).collect()
    return {r[PART]: (r["n"], f"{r['n']}-{r['s']}-{r['x']}") for r in found}


def publish(root: str, tables: dict[str, DataFrame], by: dict[str, str] | None = None) -> Manifest:
    """Writes ``tables`` as the next generation of the store at ``root`` and returns its manifest.

    ``by`` names the column of a table whose values are its parts. A part whose rows are those of the last generation keeps its files, whatever their
    order; only the others stay written. Tables of the last generation that are not given remain. Two writers at once can't both add the same
    generation: the second fails. Null values of the part column are a part of their own.
    """
    spark = next(iter(tables.values())).sparkSession
    old, made = manifest(spark, root), {}
    place = f"{root}/data/{uuid.uuid4().hex}"
    for name, df in tables.items():
        key = (by or {}).get(name)
        value = F.coalesce(F.concat(F.lit("="), F.col(f"`{key}`").cast("string")), F.lit("null")) if key else F.lit(WHOLE)
        df.withColumn(PART, F.md5(value.cast("binary"))).write.partitionBy(PART).parquet(f"{place}/{name}")
        staged = spark.read.schema(df.withColumn(PART, F.lit("")).schema).parquet(f"{place}/{name}")
        before = old.tables.get(name, {}).get("parts", {}) if old.tables.get(name, {}).get("schema") == df.schema.json() else {}
        parts = {}
        for part, (n, digest) in _digests(staged).items():
            fresh = {"path": f"{place}/{name}/{PART}={part}", "digest": digest, "rows": n}
            same = before.get(part, {}).get("digest") == digest
            parts[part] = before[part] if same else fresh
            if same:
                files, at = file_system(spark, fresh["path"])
                files.delete(at, True)
        made[name] = {"schema": df.schema.json(), "parts": parts}
    new = Manifest(old.number + 1, old.tables | made)
    _commit(spark, root, new)
    return new


def _commit(spark: SparkSession, root: str, new: Manifest) -> None:
    files, at = file_system(spark, f"{root}/manifests/{new.number:08d}.json")
    _, beside = file_system(spark, f"{root}/manifests/.{uuid.uuid4().hex}")
    out = files.create(beside, False)
    out.write(json.dumps(asdict(new), ensure_ascii=False, sort_keys=True).encode())
    out.close()
    if files.exists(at) or not files.rename(beside, at):
        files.delete(beside, False)
        raise RuntimeError(f"another writer has published generation {new.number}")


def read_published(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A table of the last generation; an unknown name is an error."""
    from pyspark.sql import types as T

    own = manifest(spark, root).tables[name]
    schema = T.StructType.fromJson(json.loads(own["schema"]))
    paths = [p["path"] for p in own["parts"].values()]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def swept(spark: SparkSession, root: str, keep: int = 2) -> int:
    """Deletes manifests before the last ``keep`` and what only they or no manifest at all list; returns how many folders went. Not for while a writer is at work."""
    files, at = file_system(spark, f"{root}/manifests")
    if not files.exists(at):
        return 0
    found = sorted((f.getPath() for f in files.listStatus(at)), key=lambda p: p.getName())
    last = [p for p in found if p.getName().endswith(".json")][-keep:]
    used = {part["path"] for p in last for t in json.loads(spark.read.text(p.toString(), wholetext=True).first()[0])["tables"].values() for part in t["parts"].values()}
    for p in found:
        if p not in last:
            files.delete(p, False)
    gone = 0
    _, data = file_system(spark, f"{root}/data")
    for run in files.listStatus(data):
        for table in files.listStatus(run.getPath()):
            parts = [x.getPath() for x in files.listStatus(table.getPath()) if x.isDirectory()]
            for part in parts:
                if not any(u.endswith("/".join(part.toString().rsplit("/", 3)[-3:])) for u in used):
                    files.delete(part, True)
                    gone += 1
    return gone


def write_match(root: str, matches: DataFrame, rules: DataFrame, catalog: DataFrame, summary: DataFrame) -> Manifest:
    """The result of a matching run, its rules, its catalogue and its summary as one generation; matches are in parts by ``status``."""
    return publish(root, {"matches": matches, "rules": rules, "catalog": catalog, "summary": summary}, {"matches": "status"})


def refresh_knowledge(root: str, entries: DataFrame, pages: DataFrame) -> Manifest:
    """Entries in parts by ``stage`` and pages in parts by ``page_type``; what has not changed since the last refresh isn't written again."""
    return publish(root, {"entries": entries, "pages": pages}, {"entries": "stage", "pages": "page_type"})
