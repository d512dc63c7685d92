"""Small helpers that the operators of this package share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows that a Python task holds as Python objects at once; Arrow batches are cut to it.
ROWS = 256

#: Things that a Python worker holds on to between batches: the most that one operator uses.
HELD = 2

_KEPT: dict = {}
_FOLDER: list = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` of the session.

    Where it is unset, a local session gets a temporary folder (tests); on a cluster that is an
    error, as executors don't see each other's disks.
    """
    where = spark.conf.get("spark.checkpoint.dir", None)
    if where:
        return where
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not _FOLDER:
        _FOLDER.append(tempfile.mkdtemp(prefix="spark-", dir="/tmp"))
    return _FOLDER[0]


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: its lineage is cut and it is computed once.

    The table goes when the session's JVM ends, or sooner by :func:`dropped`.
    """
    path = f"{shared_folder(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    files, at = _file_system(df.sparkSession, path)
    files.deleteOnExit(at)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._written = path
    return out


def dropped(*tables: DataFrame) -> None:
    """Deletes tables of :func:`written` that nothing reads any more."""
    for df in tables:
        files, at = _file_system(df.sparkSession, df._written)
        files.delete(at, True)


def _file_system(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def kept(key, build: Callable):
    """What ``build`` makes, made once in each Python worker.

    A worker serves one operator after another; it holds the ``HELD`` things used last, so that one operator's
    vocabulary and words don't stand beside the next one's.
    """
    if key in _KEPT:
        _KEPT[key] = _KEPT.pop(key)
        return _KEPT[key]
    while len(_KEPT) >= HELD:
        del _KEPT[next(iter(_KEPT))]
    _KEPT[key] = found = build()
    return found


def pieces(batches: Iterator[pa.RecordBatch], rows: int = ROWS) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in short batches, so that few texts are Python objects at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def plain(df: DataFrame) -> DataFrame:
    """``df`` with columns ``c0``, ``c1``, ... in place of their own names, which may hold dots, differ only in case or equal an added one."""
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))])


def extended(df: DataFrame, make: Callable, texts: str | list[str], added: T.StructType, drop: bool = True) -> DataFrame:
    """``df`` with the columns of ``added``, which ``make`` computes from the columns ``texts`` (null: empty).

    ``make`` takes a list of str for each of ``texts`` and returns a list of columns; ``texts`` go if
    ``drop`` is true. Columns of ``df`` that bear the name of an added column, in any case, give way to it;
    all others pass through, whatever they are called and whatever type they have. An empty table stays empty.
    """
    texts = [texts] if isinstance(texts, str) else texts
    names = {n.lower() for n in added.names}
    own, at = plain(df), [df.columns.index(c) for c in texts]
    keep = [i for i, c in enumerate(df.columns) if c.lower() not in names and not (drop and i in at)]
    source = own.select(*[f"c{i}" for i in keep], *[F.col(f"c{i}").cast("string").alias(f"t{k}") for k, i in enumerate(at)])
    schema = T.StructType(source.schema.fields[: len(keep)] + [T.StructField(f"a{i}", f.dataType) for i, f in enumerate(added.fields)])

    def run(batches):
        for batch in pieces(batches):
            columns = make(*[[x or "" for x in batch.column(len(keep) + k).to_pylist()] for k in range(len(at))])
            arrays = [batch.column(i) for i in range(len(keep))]
            yield pa.RecordBatch.from_arrays(arrays + [pa.array(c, type=_arrow(f.dataType)) for c, f in zip(columns, added.fields)], names=schema.names)

    return source.mapInArrow(run, schema).toDF(*[df.columns[i] for i in keep], *added.names)


def _arrow(kind: T.DataType) -> pa.DataType:
    return {"string": pa.string(), "bigint": pa.int64(), "double": pa.float64(), "boolean": pa.bool_(), "int": pa.int32(), "binary": pa.binary()}[kind.simpleString()]
