"""XML state snapshots: ``<states>`` with ``<itno>``, one ``<environment>`` and many ``<xagent>``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tickweave.operators.joining import attach
from tickweave.session import settle

AGENT, AGENT_END = "<xagent>", "</xagent>"
ENVIRONMENT = r"(?s)(<environment>.*?</environment>|<environment\s*/>)"
TICK = r"<itno>\s*(-?\d+)\s*</itno>"


def _inferred(texts: DataFrame, tag: str) -> T.StructType:
    """Fields of the elements in a column of XML texts."""
    spark = texts.sparkSession
    strings = getattr(texts._jdf, "as")(spark._jvm.org.apache.spark.sql.Encoders.STRING())
    schema = spark._jsparkSession.read().option("rowTag", tag).xml(strings).schema()
    return T.StructType.fromDDL(schema.toDDL()) if schema.fields() else T.StructType()


def _parsed(text: Column, schema: str | T.StructType) -> Column:
    return F.from_xml(text, schema.simpleString() if isinstance(schema, T.StructType) else f"struct<{_fields(schema)}>")


def _fields(ddl: str) -> str:
    return ", ".join(f"`{f.name}`: {f.dataType.simpleString()}" for f in T.StructType.fromDDL(ddl))


def read_xml_snapshots(
    spark: SparkSession, path: str, agent: str | None = None, agent_schema: str | T.StructType | None = None,
    env_schema: str | T.StructType | None = None,
) -> DataFrame:
    """One row per agent: ``itno``, the environment constants as a struct ``env``, then the agent's fields.

    The files are read once, as texts that end where an agent ends, so large files are split over tasks and a record is one
    agent, never a file. What stands before the first agent of a file is its head with tick and environment. The records are
    written once, agents as columns if their schema is given; heads and agents are taken from there and meet by file.
    ``agent`` keeps one agent name. Schemas that are not given are inferred from the written records. Files without agents
    have no rows; a file without a tick has null ticks, one without an environment a null ``env``.
    """
    value = F.col("value")
    starts = F.instr(value, AGENT)
    head = F.when(starts > 0, F.substring_index(value, AGENT, 1))
    body = F.when(starts > 0, F.concat(F.expr(f"substring(value, instr(value, '{AGENT}'))"), F.lit(AGENT_END)))
    records = spark.read.option("lineSep", AGENT_END).text(path)
    records = records.select(F.col("_metadata.file_path").alias("_file"), head.alias("_head"), body.alias("_agent")).where("_agent IS NOT NULL")
    # only the first record of a file has anything but white space before its agent
    records = records.withColumn("_head", F.when(F.col("_head").rlike(r"\S"), F.col("_head")))
    if agent_schema is not None:
        records = records.withColumn("_agent", _parsed(F.col("_agent"), agent_schema))
    records = settle(records, "xml-records")
    heads = records.where("_head IS NOT NULL").select(
        "_file", F.regexp_extract("_head", TICK, 1).try_cast("bigint").alias("itno"), F.nullif(F.regexp_extract("_head", ENVIRONMENT, 1), F.lit("")).alias("_env")
    )
    if env_schema is None:
        env_schema = _inferred(heads.where("_env IS NOT NULL").select("_env"), "environment")
    fields = env_schema.fields if isinstance(env_schema, T.StructType) else T.StructType.fromDDL(env_schema).fields
    env = _parsed(F.col("_env"), env_schema) if fields else F.lit(None).cast("struct<>")
    heads = heads.select("_file", "itno", F.when(F.col("_env").isNotNull(), env).alias("env"))
    agents = records.select("_file", "_agent")
    if agent_schema is None:
        agents = agents.withColumn("_agent", _parsed(F.col("_agent"), _inferred(agents.select("_agent"), "xagent")))
    agents = agents.select("_file", "_agent.*")
    if agent is not None:
        agents = agents.where(F.col("name") == agent)
    found = attach(agents, heads, ["_file"], "left", name="snapshot-heads")
    return found.select("itno", "env", *[F.col(f"`{c}`") for c in agents.columns if c != "_file"])
