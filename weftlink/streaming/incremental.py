"""Inference over source-1 files as they arrive.

Each micro-batch is blocked and scored against the fixed candidate sources; its match lists are written under the batch's
own number, so a batch that runs again overwrites itself and a restart resumes from the checkpoint without repeats.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from weftlink.operators.prepare import preprocess
from weftlink.plans import er
from weftlink.sources import entities as src


def match_stream(spark: SparkSession, arrivals: str, candidates: DataFrame, out: str, checkpoint: str, matcher: Callable[[DataFrame], DataFrame] = er.end_to_end_rule, fmt: str = "parquet") -> StreamingQuery:
    """Match every file of source-1 entities under `arrivals` that is there now, then stop. `candidates` are prepared entities of the other sources."""
    schema = "entity_id string, src int, business_name string, business_address string, country string"
    stream = spark.readStream.schema(schema).format(fmt).load(arrivals)

    def batch(df: DataFrame, number: int) -> None:
        entities = preprocess(df).unionByName(candidates)
        src.write_tsv(matcher(entities), f"{out}/batch={number}")

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
