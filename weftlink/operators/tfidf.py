"""TF-IDF spaces over names and addresses: sublinear counts, smoothed idf, unit length.

Vectors are rows of one array per entity, so a pair's cosine is computed within its row and grams are never shuffled per pair.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def char_grams(c: Column, low: int = 2, high: int = 4) -> Column:
    """All character n-grams, repeats included."""
    x = F.regexp_replace(F.lower(c), r"\s\s+", " ")
    sizes = F.filter(F.array(*(F.lit(n) for n in range(low, high + 1))), lambda n: n <= F.length(x))
    return F.flatten(F.transform(sizes, lambda n: F.transform(F.sequence(F.lit(1), F.length(x) - n + 1), lambda i: F.substring(x, i, n))))


def word_grams(c: Column) -> Column:
    """Words of two characters or more, and pairs of neighbours."""
    words = F.regexp_extract_all(F.lower(c), F.lit(r"[\p{L}\p{N}_]{2,}"), 0)
    pairs = F.when(F.size(words) > 1, F.transform(F.sequence(F.lit(1), F.size(words) - 1), lambda i: F.concat_ws(" ", F.element_at(words, i), F.element_at(words, i + 1))))
    return F.concat(words, F.coalesce(pairs, F.array().cast("array<string>")))


SPACES = {"name_char": ("name_norm", char_grams), "name_word": ("name_norm", word_grams), "addr_char": ("addr_norm", char_grams)}


def gram_rows(entities: DataFrame, space: str, width: int | None = None) -> DataFrame:
    """entity_id, gram, tf."""
    column, grams = SPACES[space]
    text = F.col(column) if width is None else F.substring(column, 1, width)
    return entities.select("entity_id", F.explode(grams(text)).alias("gram")).groupBy("entity_id", "gram").agg(F.count("*").alias("tf"))


def fit(entities: DataFrame, space: str, max_features: int = 50_000, min_df: int = 2) -> DataFrame:
    """gram, df, total, idf of the vocabulary: the `max_features` commonest grams by total count, ties by gram."""
    rows = entities.where(F.col(SPACES[space][0]) != "").agg(F.count("*").alias("rows"))
    counted = gram_rows(entities, space).groupBy("gram").agg(F.count("*").alias("df"), F.sum("tf").alias("total")).where(F.col("df") >= min_df)
    kept = counted.orderBy(F.desc("total"), "gram").limit(max_features)
    return kept.crossJoin(F.broadcast(rows)).select("gram", "df", "total", (F.log((1 + F.col("rows")) / (1 + F.col("df"))) + 1).alias("idf"))


def transform(entities: DataFrame, vocabulary: DataFrame, space: str, width: int | None = 250) -> DataFrame:
    """entity_id, vector: map from gram to weight, of unit length. The vocabulary is bounded by max_features, so it is broadcast."""
    weighted = gram_rows(entities, space, width).join(F.broadcast(vocabulary.select("gram", "idf")), "gram").select("entity_id", "gram", ((1 + F.log("tf")) * F.col("idf")).alias("w"))
    items = weighted.groupBy("entity_id").agg(F.sort_array(F.collect_list(F.struct("gram", "w"))).alias("items"), F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    return items.select("entity_id", F.map_from_entries(F.transform("items", lambda x: F.struct(x["gram"], x["w"] / F.col("norm")))).alias("vector"))


def cosines(pairs: DataFrame, entities: DataFrame, vocabulary: DataFrame, space: str, name: str) -> DataFrame:
    """`pairs` (s1_id, cand_id) with the cosine of their texts: grams of a side are joined once per pair, then summed."""
    column = gram_rows(entities, space, 250).join(F.broadcast(vocabulary.select("gram", "idf")), "gram")
    weighted = column.select("entity_id", "gram", ((1 + F.log("tf")) * F.col("idf")).alias("w"))
    norms = weighted.groupBy("entity_id").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    unit = weighted.join(norms, "entity_id").select("entity_id", "gram", (F.col("w") / F.col("norm")).alias("w"))
    a = unit.select(F.col("entity_id").alias("s1_id"), "gram", F.col("w").alias("wa"))
    b = unit.select(F.col("entity_id").alias("cand_id"), "gram", F.col("w").alias("wb"))
    ids = pairs.select("s1_id", "cand_id").distinct()
    dots = ids.join(a, "s1_id").join(b, ["cand_id", "gram"]).groupBy("s1_id", "cand_id").agg(F.sum(F.col("wa") * F.col("wb")).alias(name))
    return pairs.join(dots, ["s1_id", "cand_id"], "left").withColumn(name, F.coalesce(name, F.lit(0.0)))
