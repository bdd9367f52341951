"""Profiles of entity sources."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Noise patterns of names; letter case is ignored.
NOISE = (
    ("leading_symbol", r"^\s*[^a-zA-Z0-9\x{0900}-\x{097F}\x{0C00}-\x{0C7F}]"),
    ("contains_ampersand", r"&"),
    ("contains_digit", r"\d"),
    ("legal_suffix", r"\b(inc|ltd|llc|corp|pvt|llp|limited|sarl|sas)\.?\s*$"),
    ("trailing_dot_comma", r"[.,]\s*$"),
    ("non_ascii", r"[^\x00-\x7F]"),
)


def blank_rates(entities: DataFrame) -> DataFrame:
    blank = lambda c: F.count(F.when(F.trim(c) == "", 1))
    return (
        entities.groupBy("src")
        .agg(F.count("*").alias("rows"), blank("business_name").alias("blank_names"), blank("business_address").alias("blank_addresses"))
        .withColumns({"blank_name_pct": 100.0 * F.col("blank_names") / F.col("rows"), "blank_address_pct": 100.0 * F.col("blank_addresses") / F.col("rows")})
    )


def country_distribution(entities: DataFrame) -> DataFrame:
    counts = entities.groupBy("src", "country").agg(F.count("*").alias("n"))
    return counts.withColumn("pct", 100.0 * F.col("n") / F.sum("n").over(Window.partitionBy("src")))


def _lengths(entities: DataFrame, c: str, points, shortest: bool) -> DataFrame:
    """Exact percentiles, by linear interpolation, of the lengths of `c` from how often each length occurs."""
    tallies = entities.groupBy("src", F.length(c).alias("size")).agg(F.count("*").alias("n")).where("size IS NOT NULL")
    within = Window.partitionBy("src")
    ranked = tallies.select("src", "size", F.sum("n").over(within.orderBy("size")).alias("upto"), (F.sum("n").over(within) - 1).alias("last"))
    found = []
    for p in points:
        place = F.col("last") * F.lit(p)
        low, high = (F.min(F.when(F.col("upto") > at, F.col("size"))) for at in (F.floor(place), F.ceil(place)))
        part = F.first(place - F.floor(place))
        found.append(((high - low) * part + low).alias(f"p{int(100 * p)}"))
    least = [F.min("size").alias("shortest")] if shortest else []
    return ranked.groupBy("src").agg(*least, *found, F.max("size").alias("longest"))


def name_lengths(entities: DataFrame) -> DataFrame:
    """min, exact percentiles (by linear interpolation) and max of name lengths."""
    return _lengths(entities, "business_name", (0.25, 0.5, 0.75, 0.95, 0.99), True)


def address_lengths(entities: DataFrame) -> DataFrame:
    """The same of addresses that are not empty; sources without any are left out."""
    return _lengths(entities.where("business_address <> ''"), "business_address", (0.25, 0.5, 0.75, 0.95), False)


def noise_patterns(entities: DataFrame, first: int | None = 200_000) -> DataFrame:
    """src, pattern, n over the first rows (by id) of each candidate source; `first=None` takes all."""
    names = entities.where("src <> 1")
    if first is not None:
        names = names.withColumn("_row", F.row_number().over(Window.partitionBy("src").orderBy("entity_id"))).where(F.col("_row") <= first)
    name = F.col("business_name")
    tests = {n: name.rlike("(?i)" + p) for n, p in NOISE} | {"all_caps": (name == F.upper(name)) & (F.trim(name) != "")}
    counts = names.groupBy("src").agg(*(F.count(F.when(t, 1)).alias(n) for n, t in tests.items()))
    return counts.unpivot("src", list(tests), "pattern", "n")


def match_distribution(truth_lists: DataFrame) -> DataFrame:
    """matches, entities, pct of entities by their number of matches."""
    n = F.size(F.filter(F.split("matched_entity_ids", ","), lambda x: F.trim(x) != ""))
    return truth_lists.select(n.alias("matches")).groupBy("matches").agg(F.count("*").alias("entities")).withColumn("pct", 100.0 * F.col("entities") / F.sum("entities").over(Window.partitionBy(F.lit(1))))


def source_breakdown(pairs: DataFrame) -> DataFrame:
    """References to each candidate source and their ratio."""
    of = lambda n: F.count(F.when(F.startswith("cand_id", F.lit(f"S{n}-")), 1))
    return pairs.agg(of(2).alias("s2_refs"), of(3).alias("s3_refs")).withColumn("ratio", F.col("s2_refs") / F.greatest("s3_refs", F.lit(1)))


def blank_address_by_country(entities: DataFrame) -> DataFrame:
    return entities.groupBy("src", "country").agg((100.0 * F.count(F.when(F.trim("business_address") == "", 1)) / F.count("*")).alias("blank_pct"))
