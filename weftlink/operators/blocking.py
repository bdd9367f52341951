"""Candidate generation: blocking keys, hot-key pruning, overlap counts under a country filter, top-K, truth injection, recall."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from weftlink.operators.meeting import shared_keys

# Tokens that are no keys.
STOPWORDS = (
    "pvt", "ltd", "inc", "llc", "llp", "corp", "co", "and", "the", "of", "for", "at", "in", "on", "by", "de", "du", "la", "le",
    "sa", "sarl", "sas", "sci", "eurl", "group", "services", "solutions", "enterprises", "industries", "associates", "consultants",
)
PREFIX = 5


def keys_of() -> Column:
    """Name tokens of two characters or more, the name's first five characters, and address tokens of four or more that are
    not digits alone. A bag: a repeated token is a key each time."""
    name = F.filter(F.split("name_norm", " "), lambda t: (F.length(t) >= 2) & ~t.isin(*STOPWORDS))
    prefix = F.when(F.length("name_norm") >= PREFIX, F.array(F.concat(F.lit("pfx:"), F.substring("name_norm", 1, PREFIX)))).otherwise(F.array().cast("array<string>"))
    addr = F.filter(F.split("addr_norm", " "), lambda t: (F.length(t) >= 4) & ~t.rlike("^[0-9]+$") & ~t.isin(*STOPWORDS))
    return F.concat(name, prefix, F.transform(addr, lambda t: F.concat(F.lit("addr:"), t)))


def blocking_keys(entities: DataFrame) -> DataFrame:
    """entity_id, src, country, key: a row for each of `keys_of`."""
    return entities.select("entity_id", "src", "country", F.explode(keys_of()).alias("key"))


def cap_of(rows):
    """Most postings of a key that still is one, for a source with `rows` rows."""
    return F.least(F.lit(500), F.greatest(F.lit(100), F.floor(rows * 0.01)))


def key_counts(keys: DataFrame, entities: DataFrame) -> DataFrame:
    """src, key, n, kept of the candidate sources. Counts are partial aggregates; the rows per source are two numbers, broadcast."""
    rows = entities.where("src <> 1").groupBy("src").agg(F.count("*").alias("rows"))
    counted = keys.where("src <> 1").groupBy("src", "key").agg(F.count("*").alias("n"))
    return counted.join(F.broadcast(rows), "src").select("src", "key", "n", (F.col("n") <= cap_of(F.col("rows"))).alias("kept"))


def overlap(entities: DataFrame) -> DataFrame:
    """s1_id, cand_id, score: products of key frequencies, summed, under the country filter.

    Hot keys are gone on the candidate side, and an entity whose country occurs among the candidates meets only candidates
    of that country. Pairs are counted where their keys meet and are not shuffled."""
    return shared_keys(entities, keys_of(), lambda rows: min(500, max(100, math.floor(rows * 0.01))))


def top_candidates(scored: DataFrame, most: int = 100) -> DataFrame:
    """The `most` best candidates of each entity; ties go to the smaller id."""
    place = F.row_number().over(Window.partitionBy("s1_id").orderBy(F.desc("score"), "cand_id"))
    return scored.withColumn("rank", place).where(F.col("rank") <= most)


def candidate_pairs(entities: DataFrame, truth: DataFrame | None = None, most: int = 100) -> DataFrame:
    """s1_id, cand_id and, with `truth` (s1_id, cand_id), label; true matches in the pool that blocking missed are added."""
    found = top_candidates(overlap(entities), most).select("s1_id", "cand_id")
    if truth is None:
        return found
    one = entities.where("src = 1").select(F.col("entity_id").alias("s1_id"))
    pool = entities.where("src <> 1").select(F.col("entity_id").alias("cand_id"))
    real = truth.select("s1_id", "cand_id").join(one, "s1_id", "left_semi").join(pool, "cand_id", "left_semi").distinct().withColumn("label", F.lit(1))
    return found.join(real, ["s1_id", "cand_id"], "full").select("s1_id", "cand_id", F.coalesce("label", F.lit(0)).alias("label"))


def recall(pairs: DataFrame, truth: DataFrame) -> DataFrame:
    """found, total and recall of `truth` among `pairs`; 1 without truth."""
    hit = truth.select("s1_id", "cand_id").join(pairs.select("s1_id", "cand_id").distinct().withColumn("hit", F.lit(1)), ["s1_id", "cand_id"], "left")
    sums = hit.agg(F.count("hit").alias("found"), F.count("*").alias("total"))
    return sums.select("found", "total", F.when(F.col("total") == 0, 1.0).otherwise(F.col("found") / F.col("total")).alias("recall"))
