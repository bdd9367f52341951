"""Compositions: training, inference and the rule-scored match list."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftlink.operators import blocking, features, metrics, model, sampling, tfidf
from weftlink.operators.prepare import preprocess
from weftlink.session import ship
from weftlink.sources import entities as src

CODE = "right(business_name, 6) AS code"


def truth_pairs(entities: DataFrame) -> DataFrame:
    """(s1_id, cand_id) of the `parts` entities that share the six-digit code at the end of their names."""
    one = entities.where("src = 1").select(F.col("entity_id").alias("s1_id"), F.expr(CODE))
    return one.join(entities.where("src <> 1").select(F.col("entity_id").alias("cand_id"), F.expr(CODE)), "code").select("s1_id", "cand_id")


def truth_lists(entities: DataFrame) -> DataFrame:
    return src.match_lists(entities.where("src = 1").select("entity_id"), truth_pairs(entities))


def prepared(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    return preprocess(src.entity_view(spark, sf_dir, kind))


def rule_matches(entities: DataFrame, threshold: float = 0.6, most: int = 100) -> DataFrame:
    """entity pairs whose rule score reaches `threshold`: blocking, the four features that the rule reads, filter. No Python runs."""
    pairs = features.with_records(blocking.candidate_pairs(entities, most=most), entities)
    made = features.name_features("levenshtein") | features.address_features("levenshtein")
    country = ((F.col("country_1") != "") & (F.col("country_1") == F.col("country_2"))).cast("double")
    scored = pairs.select("s1_id", "cand_id", *(made[c].alias(c) for c in model.RULE if c in made), country.alias("country_match"))
    return model.rule_score(scored).where(F.col("prob") >= threshold).select("s1_id", "cand_id", "prob")


def end_to_end_rule(entities: DataFrame) -> DataFrame:
    """One row per entity of source 1 with its matches."""
    return src.match_lists(entities.where("src = 1"), rule_matches(entities))


def vocabularies(entities: DataFrame, max_features: int = 50_000) -> dict[str, DataFrame]:
    return {space: tfidf.fit(entities, space, max_features) for space in tfidf.SPACES}


def train(entities: DataFrame, truth: DataFrame, most: int = 100, trees: int = 500, max_features: int = 50_000, ratio: str = "indel"):
    """(model, vocabularies, threshold row, features): block with injection, build features, split by entity, fit, sweep on the valid part."""
    ship(entities.sparkSession)
    pairs = blocking.candidate_pairs(entities, truth, most)
    spaces = vocabularies(entities, max_features)
    made = sampling.group_split(features.compute_features(pairs, entities, spaces, ratio)).persist()
    fitted = model.train(made.where("part = 'train'"), trees)
    valid = model.predict(fitted, made.where("part = 'valid'"))
    best = metrics.best_threshold(metrics.sweep(valid, ["prob"], metrics.MODEL_GRID)).first()
    return fitted, spaces, best, made


def infer(entities: DataFrame, fitted, spaces: dict[str, DataFrame], threshold: float, most: int = 100, ratio: str = "indel") -> tuple[DataFrame, DataFrame]:
    """(match lists, candidate lists), each with one row per entity of source 1."""
    ship(entities.sparkSession)
    pairs = blocking.candidate_pairs(entities, most=most)
    found = model.predict(fitted, features.compute_features(pairs, entities, spaces, ratio)).where(F.col("prob") >= threshold)
    ones = entities.where("src = 1")
    return src.match_lists(ones, found), src.match_lists(ones, pairs, "candidate_entity_ids")
