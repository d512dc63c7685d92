"""Reads the tables, and the columns of them that stand in for the library's own inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: What is put before and after part names, so that every rule on names has something to act on.
LEADS = ("现浇", "预制", "钢筋混凝土", "砼", "挖", "", "(单独) ", "雨蓬：")
TAILS = ("构件", "", "单元", "、墙", " 基础", "梁 模板", "柱")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(options, index):
    return F.get(F.array(*[F.lit(x) for x in options]), index)


def sql_pick(options, index: str) -> str:
    return "[" + ", ".join("'" + x.replace("'", "''") + "'" for x in options) + f"][1 + {index}]"


def bill_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as bill rows: ``row_id``, ``name``, ``unit``, ``chapter``, ``features``, ``rule``."""
    p = table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").alias("row_id"),
        F.concat(pick(LEADS, (F.col("p_partkey") % len(LEADS)).cast("int")), F.col("p_name"), pick(TAILS, (F.col("p_partkey") % len(TAILS)).cast("int"))).alias("name"),
        pick(("m2", "㎡", "m³", "n?", "t", " M3 "), (F.col("p_size") % 6).cast("int")).alias("unit"),
        F.concat(F.col("p_brand"), F.lit(" > "), F.col("p_type")).alias("chapter"),
        F.concat(F.lit("1. 厚度："), F.col("p_size").cast("string"), F.lit("mm\n2 - 强度等级大于等于C30\n3 "), F.col("p_type"), F.lit("\n\n4")).alias("features"),
        pick(("按设计图示体积计算", "按面积计算", "见说明", "", "按中心线长度计算", "按数量计算"), (F.col("p_partkey") % 6).cast("int")).alias("rule"),
    )


BILL_ROWS = f"""
bill_rows AS (
  SELECT p_partkey AS row_id,
    {sql_pick(LEADS, f"p_partkey % {len(LEADS)}")} || p_name || {sql_pick(TAILS, f"p_partkey % {len(TAILS)}")} AS name,
    {sql_pick(("m2", "㎡", "m³", "n?", "t", " M3 "), "p_size % 6")} AS unit,
    p_brand || ' > ' || p_type AS chapter,
    '1. 厚度：' || p_size || 'mm' || chr(10) || '2 - 强度等级大于等于C30' || chr(10) || '3 ' || p_type || chr(10) || chr(10) || '4' AS features,
    {sql_pick(("按设计图示体积计算", "按面积计算", "见说明", "", "按中心线长度计算", "按数量计算"), "p_partkey % 6")} AS rule
  FROM part
)"""
