"""Catalogue queries against their SQL twins in DuckDB."""

from __future__ import annotations

import duckdb
import pytest

from weftlink.plans import catalogue

TABLES = ("documents", "part", "pages")
QUICK = (
    "normalize_names", "normalize_addresses", "strip_url_suffix", "house_and_numbers", "soundex_custom", "addr_prefix_hash", "sim_levenshtein",
    "sim_token_sort_indel", "sim_token_set_indel", "blocking_keys", "hot_key_pruning", "candidates_topk", "blocking_recall", "features_name",
    "macro_f05", "er_end_to_end_rule", "negative_sampling", "needed_pool", "eda_name_length", "eda_noise_patterns",
)


@pytest.fixture(scope="module")
def duck(data):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{data}/{t}.parquet'")
    return con


def plain(rows):
    return sorted(repr([round(float(x), 9) if isinstance(x, (int, float)) and not isinstance(x, bool) else x for x in r]) for r in rows)


@pytest.mark.parametrize("name", QUICK)
def test_matches_sql(spark, data, duck, name):
    df = catalogue.queries()[name](spark, data)
    columns = sorted(df.columns)
    want = duck.execute(f"SELECT {', '.join(columns)} FROM ({catalogue.oracle_sql()[name]})").fetchall()
    assert plain(map(tuple, df.select(*columns).collect())) == plain(want)


def test_every_query_is_registered_once():
    assert set(catalogue.oracle_sql()) <= set(catalogue.queries()) and len(catalogue.queries()) > 45


def test_entry_imports_without_training_data_operators():
    import __spark_entry__

    assert set(catalogue.queries()) <= set(__spark_entry__.queries())
