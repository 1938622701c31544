"""What the operators share: word patterns, free column names, row keys, word-separator rules."""

from __future__ import annotations

import gc

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tickweave.session import scratch_path

# Words are runs of anything but blank, tab, newline, vertical tab, form feed and carriage return.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
NO_ID = -(1 << 63)  # stands for a null id inside the operators
LOWER, UPPER = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or a longer name, that no column of ``df`` has in any letter case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_of(text: str) -> Column:
    """The text column as a string; null counts as empty."""
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


def words_of(text: Column) -> Column:
    """All words of a text as an array (no empty strings)."""
    return F.filter(F.split(text, SPACE + "+"), lambda w: w != "")


def keyed(df: DataFrame, doc_id: str, text: str, unique: bool = False) -> DataFrame:
    """Columns ``doc_id, fp, text``: ``fp`` tells rows apart whose id is null or repeated (0 where ids are known to be unique).

    Rows alike in id and text get the same key; they are one document to every operator.
    """
    own = F.xxhash64(F.col(doc_id).isNull(), F.col(doc_id).cast("long"), F.col(text).isNull(), F.col(text).cast("string"))
    return df.select(
        F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID)).alias("doc_id"), (F.lit(0).cast("long") if unique else own).alias("fp"), text_of(text).alias("text"),
    )


def real_id(doc_id: str = "doc_id") -> Column:
    return F.when(F.col(doc_id) != NO_ID, F.col(doc_id))


def settled(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder; afterwards Spark may drop the shuffle files that it took to make it."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._settled_at = path
    gc.collect()
    spark.sparkContext._jvm.System.gc()  # the cleaner removes shuffles whose plans are garbage
    return out


def used_up(*tables: DataFrame) -> None:
    """Deletes tables that ``settled`` made, once all that reads them has been settled itself."""
    for df in tables:
        jvm = df.sparkSession.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(df._settled_at)
        path.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def unique_ids(df: DataFrame, doc_id: str) -> bool:
    """Whether no id is null or comes twice; then rows need no second key column."""
    ids = df.select(F.col(doc_id).cast("long").alias("i"))
    n, known, kinds = ids.groupBy("i").agg(F.count("*").alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum(F.when(F.col("i").isNotNull(), F.col("n"))), F.lit(0)), F.count("i")).first()
    return n == known == kinds

