"""Parameter tables in CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tickweave.functions.names import label_number


def read_params(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """One row per set; ``set_num`` may be written ``12`` or ``set_12``. Other columns keep their type."""
    reader = spark.read.option("header", "true")
    raw = reader.schema(schema).csv(path) if schema else reader.option("inferSchema", "true").csv(path)
    return clean_params(raw)


def clean_params(raw: DataFrame) -> DataFrame:
    """Same for a table that is already loaded."""
    if "set_num" not in raw.columns:
        raise ValueError(f"parameter table without set_num: {raw.columns}")
    others = [F.col(f"`{f.name}`") for f in raw.schema.fields if f.name != "set_num"]
    kind = raw.schema["set_num"].dataType
    number = F.col("set_num").cast("int") if isinstance(kind, T.IntegralType) else label_number(F.col("set_num").cast("string"))
    return raw.select(number.alias("set_num"), *others)
