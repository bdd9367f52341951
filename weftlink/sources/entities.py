"""Readers for delimited entity files, entity views over warehouse tables, and sinks for match lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SOURCE_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in ("entity_id", "business_name", "business_address", "country")])
TRUTH_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in ("source1_entity_id", "matched_entity_ids")])

# Strings that dataframe readers commonly take for missing.
NA_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")

# The same projections run in Spark SQL and in DuckDB. A document's first line is its name, all the rest its address.
ENT_DOCS = """
SELECT 'S' || CAST(1 + doc_id % 3 AS STRING) || '-' || CAST(doc_id AS STRING) AS entity_id, CAST(1 + doc_id % 3 AS INT) AS src,
  split_part(text, chr(10), 1) AS business_name, substring(text, length(split_part(text, chr(10), 1)) + 2) AS business_address, lang AS country FROM documents
"""
ENT_PARTS = """
SELECT 'S' || CAST(1 + p_partkey % 3 AS STRING) || '-' || CAST(p_partkey AS STRING) AS entity_id, CAST(1 + p_partkey % 3 AS INT) AS src,
  p_name || ' ' || p_type || ' ' || CASE p_size % 5 WHEN 0 THEN 'Private Limited' WHEN 1 THEN 'Inc.' WHEN 2 THEN 'L.L.C.' WHEN 3 THEN '& Company' ELSE 'Corporation' END
    || ' ' || lpad(CAST(CAST(floor(p_partkey / 3) AS BIGINT) AS STRING), 6, '0') AS business_name,
  CAST(p_partkey % 200 AS STRING) || ' ' || p_brand || ' St., PO Box ' || CAST(p_size AS STRING) AS business_address,
  CASE p_size % 3 WHEN 0 THEN 'US' WHEN 1 THEN 'IN' ELSE '' END AS country FROM part
"""


def _filled(df: DataFrame, columns: list[str], na_tokens: str) -> DataFrame:
    """Missing values of the listed columns become empty strings."""
    for c in columns:
        value = F.coalesce(F.col(c), F.lit(""))
        df = df.withColumn(c, F.when(value.isin(*NA_TOKENS), "").otherwise(value) if na_tokens == "pandas" else value)
    return df


def read_tsv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.csv(path, sep="\t", header=True, schema=schema, escape='"', multiLine=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, nullValue=None)


def load_source(spark: SparkSession, base: str, split: str, src: int, na_tokens: str = "pandas") -> DataFrame:
    """`{base}/{split}/{split}_source{src}.tsv` with its number as `src`."""
    df = read_tsv(spark, f"{base}/{split}/{split}_source{src}.tsv", SOURCE_SCHEMA)
    return _filled(df, ["business_name", "business_address", "country"], na_tokens).withColumn("src", F.lit(src))


def load_all_sources(spark: SparkSession, base: str, split: str, na_tokens: str = "pandas") -> DataFrame:
    one, two, three = (load_source(spark, base, split, n, na_tokens) for n in (1, 2, 3))
    return one.unionByName(two).unionByName(three)


def load_truth(spark: SparkSession, base: str) -> DataFrame:
    return _filled(read_tsv(spark, f"{base}/train/train_ground_truth.tsv", TRUTH_SCHEMA), ["matched_entity_ids"], "pandas")


def explode_ids(df: DataFrame, key: str = "source1_entity_id", ids: str = "matched_entity_ids") -> DataFrame:
    """(s1_id, cand_id), distinct, of comma-separated id lists; blank ids are dropped."""
    one = df.select(F.col(key).alias("s1_id"), F.explode(F.split(F.col(ids), ",")).alias("cand_id"))
    return one.select("s1_id", F.trim("cand_id").alias("cand_id")).where("cand_id <> ''").distinct()


def id_list(column: Column) -> Column:
    """Sorted, distinct, comma-joined."""
    return F.array_join(F.sort_array(F.collect_set(column)), ",")


def match_lists(s1: DataFrame, pairs: DataFrame, name: str = "matched_entity_ids") -> DataFrame:
    """One row per entity of `s1` (entity_id), with its ids from `pairs` (s1_id, cand_id); empty for none."""
    lists = pairs.groupBy("s1_id").agg(id_list(F.col("cand_id")).alias(name))
    own = s1.select(F.col("entity_id").alias("source1_entity_id"))
    return own.join(lists, own.source1_entity_id == lists.s1_id, "left").select("source1_entity_id", F.coalesce(name, F.lit("")).alias(name))


def write_tsv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, sep="\t", header=True, emptyValue="")


def write_features(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    df.write.mode("overwrite").format(fmt).options(header="true").save(path)


def read_features(spark: SparkSession, path: str, schema: T.StructType | None = None, fmt: str = "parquet") -> DataFrame:
    reader = spark.read.format(fmt).options(header="true")
    return (reader.schema(schema) if schema is not None else reader).load(path)


def write_threshold(spark: SparkSession, threshold: float, f05: float, path: str) -> None:
    spark.createDataFrame([(threshold, f05)], "threshold double, f05 double").coalesce(1).write.mode("overwrite").json(path)


def read_threshold(spark: SparkSession, path: str) -> tuple[float, float]:
    row = spark.read.schema("threshold double, f05 double").json(path).first()
    return row["threshold"], row["f05"]


def entity_view(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    """`docs` or `parts` as entities (entity_id, src, business_name, business_address, country)."""
    table, query = {"docs": ("documents", ENT_DOCS), "parts": ("part", ENT_PARTS)}[kind]
    return spark.sql(query.replace(f"FROM {table}", "FROM {t}"), t=spark.read.parquet(f"{sf_dir}/{table}.parquet"))
