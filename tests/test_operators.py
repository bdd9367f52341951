"""Blocking, metrics, sinks, models and streaming on small fixtures."""

from __future__ import annotations

import time

import pytest
from pyspark.sql import functions as F

from weftlink.operators import blocking, features, metrics, model, tfidf
from weftlink.operators.prepare import preprocess
from weftlink.plans import er
from weftlink.session import tidy
from weftlink.sources import entities as src
from weftlink.streaming.incremental import match_stream

SCHEMA = "entity_id string, src int, business_name string, business_address string, country string"


def entities(spark, rows):
    return preprocess(spark.createDataFrame(rows, SCHEMA))


def test_keys_and_bag_scores(spark):
    e = entities(spark, [("S1-1", 1, "foo foo", "1234 abc abcd", ""), ("S2-1", 2, "foo foo bar", "", "")])
    keys = sorted(r.key for r in blocking.blocking_keys(e).where("src = 1").collect())
    assert keys == ["addr:abcd", "foo", "foo", "pfx:foo f"]
    assert [r.score for r in blocking.overlap(e).collect()] == [5]  # 2 x 2 for the token, 1 for the prefix


def test_country_filter(spark):
    rows = [("S1-1", 1, "foo", "", "US"), ("S1-2", 1, "foo", "", "FR"), ("S1-3", 1, "foo", "", ""), ("S2-1", 2, "foo", "", "US"), ("S2-2", 2, "foo", "", "")]
    got = {(r.s1_id, r.cand_id) for r in blocking.overlap(entities(spark, rows)).collect()}
    assert got == {("S1-1", "S2-1"), ("S1-2", "S2-1"), ("S1-2", "S2-2"), ("S1-3", "S2-1"), ("S1-3", "S2-2")}


def test_hot_key_cap(spark):
    rows = [(f"S2-{i}", 2, "hot" if i <= 101 else f"n{i}", "", "") for i in range(200)] + [("S1-1", 1, "hot", "", "")]
    kept = {r.key: r.kept for r in blocking.key_counts(*(lambda e: (blocking.blocking_keys(e), e))(entities(spark, rows))).collect()}
    assert kept["hot"] is False and kept["n150"] is True


def test_injection_and_recall(spark):
    e = entities(spark, [("S1-1", 1, "foo", "", ""), ("S2-1", 2, "foo", "", ""), ("S2-2", 2, "bar", "", "")])
    truth = spark.createDataFrame([("S1-1", "S2-2"), ("S1-1", "S2-9")], "s1_id string, cand_id string")
    pairs = blocking.candidate_pairs(e, truth)
    assert {tuple(r) for r in pairs.collect()} == {("S1-1", "S2-1", 0), ("S1-1", "S2-2", 1)}
    assert blocking.recall(blocking.candidate_pairs(e), truth).first().recall == 0
    assert blocking.recall(pairs, truth.limit(0)).first().recall == 1


def test_metrics_golden(spark):
    df = spark.createDataFrame([(1.0, 1.0), (0.0, 0.0), (1.0, 0.5), (0.5, 1.0), (0.9, 0.6)], "p double, r double")
    assert [r[0] for r in df.select(metrics.f05(F.col("p"), F.col("r"))).collect()] == pytest.approx([1, 0, 0.833333, 0.555556, 0.818182], abs=1e-6)
    truth = spark.createDataFrame([("a", "1"), ("a", "2"), ("c", "3")], "s1_id string, cand_id string")
    predicted = spark.createDataFrame([("a", "1"), ("c", "4"), ("d", "9"), ("z", "1")], "s1_id string, cand_id string")
    ones = spark.createDataFrame([(x,) for x in "abcd"], "s1_id string")
    assert metrics.macro_f05(predicted, truth, ones).first().macro_f05 == pytest.approx(0.458333, abs=1e-6)
    assert (len(metrics.MODEL_GRID), len(metrics.OLD_GRID), len(metrics.FEATURE_GRID)) == (36, 17, 21)


def test_feature_edge_rows(spark):
    e = entities(spark, [("S1-1", 1, "", "", ""), ("S2-1", 2, "", "", ""), ("S2-2", 2, "abc", "12 a", "")])
    pairs = spark.createDataFrame([("S1-1", "S2-1"), ("S1-1", "S2-2"), ("S1-1", "S2-404")], "s1_id string, cand_id string")
    rows = {r.cand_id: [r[c] for c in features.FEATURE_COLS[:19]] for r in features.compute_features(pairs, e).collect()}
    assert rows["S2-1"] == [1, 1, 0, 1, 1, 0, 0, 0, 1, 0, 0, 1, 1, 1, 1, 0.5, 1, 0, 1]
    assert rows["S2-2"] == [0, 0, 0, 0, 0, 0, 0, 3, 0, 1, 0, 0, 0, 0, 0, 0.5, 1, 4, 0]
    assert rows["S2-404"] == rows["S2-1"]  # an unknown id has an empty record


def test_tfidf_unit_length(spark):
    e = entities(spark, [(f"S{i % 3 + 1}-{i}", i % 3 + 1, f"acme widgets {i % 4}", "", "") for i in range(12)])
    vocabulary = tfidf.fit(e, "name_char", 50)
    assert vocabulary.count() <= 50
    norms = [sum(w * w for w in r.vector.values()) for r in tfidf.transform(e, vocabulary, "name_char").collect()]
    assert norms == pytest.approx([1] * 12)


def test_tsv_round_trip(spark, tmp_path):
    (tmp_path / "train").mkdir()
    (tmp_path / "train/train_source1.tsv").write_text('entity_id\tbusiness_name\tbusiness_address\tcountry\nS1-1\tNA\t"x ""q"" y"\tUS\nS1-2\tnull\t\tNA\nS1-3\t"a\tb"\t 12 st \tIN\n')
    got = {r.entity_id: tuple(r)[1:4] for r in src.load_source(spark, str(tmp_path), "train", 1).collect()}
    assert got == {"S1-1": ("", 'x "q" y', "US"), "S1-2": ("", "", ""), "S1-3": ("a\tb", " 12 st ", "IN")}
    assert src.load_source(spark, str(tmp_path), "train", 1, "none").where("country = 'NA'").count() == 1
    src.write_threshold(spark, 0.925, 0.99, str(tmp_path / "t"))
    assert src.read_threshold(spark, str(tmp_path / "t")) == (0.925, 0.99)


def test_every_entity_has_one_row(spark, data):
    e = er.prepared(spark, data, "parts")
    lists = er.end_to_end_rule(e)
    assert lists.count() == e.where("src = 1").count() == lists.select("source1_entity_id").distinct().count()


def test_train_infer_save(spark, data, tmp_path):
    e = er.prepared(spark, data, "parts").cache()
    fitted, spaces, best, made = er.train(e, er.truth_pairs(e), most=5, trees=3, max_features=500)
    model.save(fitted, str(tmp_path / "m"))
    matches, candidates = er.infer(e, model.load(str(tmp_path / "m")), spaces, best["threshold"], most=5)
    checked = {r.rule: r.violations for r in metrics.validate_output(e.where("src = 1"), e.where("src <> 1"), matches, candidates).collect()}
    assert checked == {"not_exactly_one_row": 0, "match_not_candidate": 0, "unknown_id": 0}
    assert model.importances(fitted).count() == 10


def test_stream_resumes_without_repeats(spark, tmp_path):
    pool = entities(spark, [("S2-1", 2, "acme widgets", "1 elm st", "US")])
    arrivals, out = str(tmp_path / "in"), str(tmp_path / "out")
    for n in (1, 2):
        spark.createDataFrame([(f"S1-{n}", 1, "acme widgets", "1 elm st", "US")], SCHEMA).coalesce(1).write.mode("append").parquet(arrivals)
        match_stream(spark, arrivals, pool, out, str(tmp_path / "ck")).awaitTermination()
    got = sorted(tuple(r)[:2] for r in spark.read.csv(f"{out}/batch=*", sep="\t", header=True).collect())
    assert got == [("S1-1", "S2-1"), ("S1-2", "S2-1")]


def test_overlap_counts_pairs_in_blocks_without_shuffling_them(spark, monkeypatch):
    """Against brute force, in many small blocks: unknown, empty and null countries, repeated tokens, an id with rows of two countries."""
    import random
    from collections import Counter

    from weftlink.operators import meeting

    for name, size in (("ASK_BYTES", 300), ("GIVE_BYTES", 500), ("BUCKET_BYTES", 400), ("STEP", 16)):
        monkeypatch.setattr(meeting, name, size)
    draw = random.Random(4)
    rows = [(f"S{1 + i % 3}-{i}", 1 + i % 3, " ".join(draw.choices(["alpha", "beta", "gamma", "x1", "of", f"w{i % 7}"], k=draw.randint(0, 6))), "", draw.choice(["US", "IN", "", "FR" if i % 3 == 0 else "US", None])) for i in range(90)]
    rows += [("S1-0", 1, "alpha beta", "", "IN"), ("S2-1", 2, "alpha", "", "IN")]
    e = spark.createDataFrame(rows, "entity_id string, src int, name_norm string, addr_norm string, country string").withColumn("addr_norm", F.concat("name_norm", F.lit(" 12345 lane")))
    bag = [tuple(r) for r in blocking.blocking_keys(e).collect()]
    known = {c for _, s, c, _ in rows_of(e) if s != 1 and c}
    want = Counter()
    for a, s, c, k in bag:
        if s == 1:
            for b, t, d, m in bag:
                if t != 1 and k == m and (c not in known or c == d):
                    want[a, b] += 1
    got = blocking.overlap(e)
    plan = got._jdf.queryExecution().executedPlan().toString()
    one_country = e.where("entity_id NOT IN ('S1-0', 'S2-1')")
    assert Counter({(r.s1_id, r.cand_id): r.score for r in got.collect()}) == want and want and "FlatMapGroupsInArrow" in plan
    assert not [line for line in blocking.overlap(one_country)._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange" in line and "s1_id" in line]


def rows_of(e):
    return [(r.entity_id, r.src, r.country, r.name_norm) for r in e.collect()]


def test_no_stage_outlives_its_query(spark):
    def slow(batches):
        time.sleep(4)
        yield from batches

    tidy(spark)
    left = spark.range(0, 8, 1, 2).mapInArrow(slow, "id long").groupBy("id").count()
    none = spark.range(0, 8, 1, 2).where("hash(id) = 0").withColumnRenamed("id", "other").groupBy("other").count()
    assert left.join(none, left.id == none.other).select("id").collect() == []
    for _ in range(10):  # the tracker is told a little later
        active = list(spark.sparkContext.statusTracker().getActiveStageIds())
        if not active:
            break
        time.sleep(0.1)
    assert active == []
