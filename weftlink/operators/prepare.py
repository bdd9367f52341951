"""Entities with their normalised texts and derived keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftlink.functions import keys, normalize


def preprocess(entities: DataFrame) -> DataFrame:
    """Adds name_norm, addr_norm, house_num and name_soundex."""
    named = entities.withColumns({"name_norm": normalize.normalize_name(F.col("business_name")), "addr_norm": normalize.normalize_address(F.col("business_address"))})
    return named.withColumns({"house_num": keys.house_number(F.col("addr_norm")), "name_soundex": keys.soundex(keys.first_token(F.col("name_norm")))})
