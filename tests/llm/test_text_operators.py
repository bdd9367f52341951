"""Text operators against brute force, libraries and fixtures with nulls, empties, repeats and clashing columns."""

from __future__ import annotations

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from weftlink.llm import bpe, license_scan, minhash_dedup, packing, quality, suffix_dedup, tokens, toxicity

DOCS = "doc_id long, text string, label string"
public_tokenizers = pytest.importorskip("public_tokenizers")
PACKER = str(public_tokenizers.path("byte_bpe_50k.json"))
RANKS = str(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


def empty(spark):
    return spark.createDataFrame([], DOCS)


# --- 1 --------------------------------------------------------------------------------------------------------------


def classes_by_force(rows, threshold=0.8, damping=0.5):
    def grams(t):
        w = (t or "").lower().split()
        return Counter(" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()

    g = {i: grams(t) for i, t in rows}
    n = len(rows)
    df = Counter(x for c in g.values() for x in c)
    w = {i: {x: (1 + math.log(k)) * (1 + damping / math.log(1 + n) * math.log((1 + n) / (1 + df[x]))) for x, k in c.items()} for i, c in g.items()}
    parent = {i: i for i in g}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(g)
    for a in ids:
        for b in ids:
            if a < b and w[a] and w[b]:
                least = sum(min(v, w[b][x]) for x, v in w[a].items() if x in w[b])
                if least >= threshold * (sum(w[a].values()) + sum(w[b].values()) - least):
                    x, y = find(a), find(b)
                    parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def test_near_duplicates_against_force(spark):
    random.seed(2)
    word = lambda: f"w{random.randint(0, 400)}"
    base = [[word() for _ in range(random.choice((3, 8, 60, 120)))] for _ in range(25)]
    rows = []
    for i in range(140):
        words = list(random.choice(base))
        for _ in range(random.choice((0, 0, 1, 2, 4, 12))):
            words[random.randrange(len(words))] = word()
        rows.append((i, " ".join(words)))
    rows += [(200, None), (201, ""), (202, "  \n"), (203, "same"), (204, "Same")]
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], DOCS)
    got = {r.doc_id: r for r in minhash_dedup.near_duplicates(df).collect()}
    want = classes_by_force(rows)
    assert {i: r.class_id for i, r in got.items()} == want
    sizes = Counter(want.values())
    assert all(r.class_size == sizes[r.class_id] and r.kept == (r.doc_id == r.class_id) for r in got.values())
    assert minhash_dedup.near_duplicates(empty(spark)).count() == 0
    again = spark.createDataFrame([(i, t, "x") for i, t in [*rows, *rows[:40], (None, rows[0][1])]], DOCS)
    found = [(r.doc_id, r.class_id, r.kept) for r in minhash_dedup.near_duplicates(again.withColumn("class_id", F.lit(3))).collect()]
    assert len(found) == len(rows) + 41 and {i: c for i, c, _ in found if i is not None} == want
    assert [(c, k) for i, c, k in found if i is None] == [(want[rows[0][0]], False)]


def test_a_family_of_many_near_copies_is_settled_as_by_force(spark):
    random.seed(8)
    base = [f"w{n}" for n in range(130)]
    rows = []
    for i in range(150):
        words = list(base)
        for _ in range(random.choice((1, 2, 3, 4))):
            words[random.randrange(130)] = f"x{random.randint(0, 60)}"
        rows.append((i, " ".join(words)))
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], DOCS)
    assert {r.doc_id: r.class_id for r in minhash_dedup.near_duplicates(df, bands=40).collect()} == classes_by_force(rows)


def test_weighted_samples_estimate_similarity():
    r = np.random.default_rng(4)
    h = r.integers(1, 2**62, 300, dtype=np.uint64)
    w1, w2 = r.uniform(0.5, 3, 200), r.uniform(0.5, 3, 200)
    a, b = h[:200], h[60:260]
    one = {int(x): y for x, y in zip(a, w1, strict=True)}
    two = {int(x): y for x, y in zip(b, w2, strict=True)}
    least = sum(min(one[x], two[x]) for x in one.keys() & two.keys())
    true = least / (w1.sum() + w2.sum() - least)
    s = minhash_dedup.Sampler(600, 1)
    k1 = s.bands_of(np.sort(a), w1[np.argsort(a)], np.array([0]))
    k2 = s.bands_of(np.sort(b), w2[np.argsort(b)], np.array([0]))
    assert abs((k1 == k2).mean() - true) < 0.08


# --- 2 and 10 -----------------------------------------------------------------------------------------------------------


def labelled(spark):
    random.seed(8)
    good = lambda: " ".join(random.choice(("river", "stone", "light", "moves", "under", "the", "a", "and")) for _ in range(40)) + "."
    rows, labels = [], []
    for i in range(400):
        bad, toxic = i % 4 == 0, i % 5 == 1
        text = good()
        if bad:
            text = "%%% ".join(text.upper().split()) + " %%%"
        if toxic:
            text += " vilethug rottenfool vilethug"
        rows.append((i, text, "x"))
        labels.append((i, int(not bad), int(toxic)))
    rows += [(1000, None, None), (1001, "", ""), (1001, "", "")]
    return spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


@pytest.mark.parametrize(("score", "column"), [(quality.score_quality, "quality"), (toxicity.score_toxicity, "toxic")])
def test_classifiers_on_held_out_rows(spark, score, column):
    docs, labels = labelled(spark)
    got = score(docs, labels).collect()
    assert len(got) == 403 and all(0 <= r.score <= 1 for r in got)
    truth = {r.doc_id: r[column] for r in labels.collect()}
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert len(held) > 50 and sum(r.predicted == truth[r.doc_id] for r in held) / len(held) > 0.97
    assert score(empty(spark), labels).count() == 0
    assert score(docs, labels.limit(0)).count() == 403


def plain_toxicity(rows, labels):
    """(doc_id, raw) by a plain model: document frequencies of folds 1 to 3, discounted and backed off."""
    fold = lambda i: zlib.crc32(str(i).encode()) % 5
    words = lambda t: [w.strip(toxicity._EDGES) for w in (t or "").lower().split()]
    tallies = [Counter(w for i, t in rows if labels.get(i) == y and fold(i) in (1, 2, 3) for w in set(words(t))) for y in (0, 1)]
    sizes = [sum(x.values()) for x in tallies]
    part = lambda x: math.log(max(x - 0.75, 0) + 1)

    def evidence(w):
        n = [x[w] for x in tallies]
        over = [part(n[y]) - part(sum(n) * (sizes[y] / sum(sizes))) for y in (0, 1)]
        return math.log(0.98 + 0.02 * math.exp(over[1] - over[0])) if sum(n) else 0.0

    return sorted((i, sum(map(evidence, words(t))) / max(len(words(t)), 1)) for i, t in rows)


def wordy(spark, texts=60, words=4000):
    """Long texts of many words, a null and a blank one, rows given twice; labels of most."""
    r = random.Random(8)
    rows = [(i, " ".join(f"{'Wort' if r.random() < 0.1 else 'w'}{int(r.paretovariate(0.25)) % 40000}{r.choice(['', '', ',', '.'])}" for _ in range(words))) for i in range(texts)]
    rows += [(texts, None), (texts + 1, "  "), *rows[:2]]
    labels = {i: int(i % 3 == 0) for i in range(texts) if i % 7}
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3).localCheckpoint()
    return rows, labels, docs, spark.createDataFrame([(i, y) for i, y in labels.items()], "doc_id long, toxic int")


def test_toxicity_ratios_equal_a_plain_model(spark):
    rows, labels, docs, _ = wordy(spark)
    known = spark.createDataFrame([(i, y) for i, y in labels.items()], "doc_id long, y int").where(toxicity.fold_of(F.col("doc_id")).isin(1, 2, 3))
    slices = toxicity.cut(toxicity.slices_of(docs, ["doc_id"]))
    told = toxicity.cut(toxicity.answers(slices, toxicity.evidence(toxicity.counts(slices, known)), 24))
    assert slices.count() >= 3 and told.count() <= 24 * slices.count()
    found = sorted((r.doc_id, r.raw) for r in toxicity.ratios(slices, told, ["doc_id"], {"doc_id": "bigint"}).collect())
    for (i, x), (j, y) in zip(found, plain_toxicity(rows, labels), strict=True):
        assert i == j and x == pytest.approx(y, abs=1e-12)


def shuffled(spark) -> int:
    """Bytes that this session has shuffled so far."""
    context = spark.sparkContext._jsc.sc()
    context.listenerBus().waitUntilEmpty()
    executors = context.statusStore().executorList(False)
    return sum(executors.apply(i).totalShuffleWrite() for i in range(executors.size()))


def test_toxicity_moves_little_more_than_the_texts(spark):
    rows, _, docs, labels = wordy(spark)
    before = shuffled(spark)
    assert toxicity.score_toxicity(docs, labels).count() == len(rows)
    moved = (shuffled(spark) - before) / sum(len(t or "") for _, t in rows)
    assert moved < 1.4, moved


def test_toxic_words_seen_once_count(spark):
    docs, labels = labelled(spark)
    extra = [(5000 + i, " ".join(f"once{i}x{j}" for j in range(20)), "x") for i in range(40)]
    asked = [(6000 + i, " ".join(f"once{i}x{j}" for j in range(20)), "x") for i in range(40)] + [(7000 + i, " ".join(f"never{i}x{j}" for j in range(20)), "x") for i in range(40)]
    docs = docs.union(spark.createDataFrame(extra + asked, DOCS))
    labels = labels.union(spark.createDataFrame([(i, 1, 1) for i, _, _ in extra], "doc_id long, quality int, toxic int"))
    score = {r.doc_id: r.score for r in toxicity.score_toxicity(docs, labels).collect()}
    counted = [i for i in range(40) if score[6000 + i] != score[7000 + i]]
    assert len(counted) > 10 and all(score[6000 + i] > score[7000 + i] for i in counted)


def test_civil_rows_are_those_below_the_threshold(spark):
    docs, labels = labelled(spark)
    docs = docs.union(spark.createDataFrame([(None, "river vilethug rottenfool vilethug", "n"), (None, "river stone light", "n"), (1, "river stone light moves", "again")], DOCS))
    good = Counter((r.doc_id, r.text, r.label) for r in toxicity.keep_civil(docs, labels).collect())
    bad = Counter(r.doc_id for r in toxicity.score_toxicity(docs, labels).collect() if r.predicted)
    assert Counter(i for i, _, _ in good.elements()) + bad == Counter(r.doc_id for r in docs.collect())
    assert (None, "river stone light", "n") in good and (None, "river vilethug rottenfool vilethug", "n") not in good and (1, "river stone light moves", "again") in good


def test_isotonic_is_the_monotone_fit():
    n, ones = np.array([10.0, 10, 0, 10, 10]), np.array([1.0, 4, 0, 2, 9])
    fit = quality.isotonic(n, ones)
    assert (np.diff(fit) >= 0).all() and fit[1] == pytest.approx(fit[3]) and fit[1] == pytest.approx(0.3, abs=0.01)


# --- 4 --------------------------------------------------------------------------------------------------------------


def test_repeated_passages_against_force(spark):
    random.seed(5)
    words = ["the", "of", "größe", "ab", "niño", "x" * 30]
    text = lambda n: " ".join(random.choice(words) + str(random.randint(0, 99)) for _ in range(n))
    shared = [text(60) for _ in range(3)]
    rows = [(i, text(random.randint(0, 40)) + random.choice(shared)[random.randint(0, 40) :] + text(20) if i % 2 else text(80), "x") for i in range(40)]
    rows += [(50, None, "x"), (51, "", "x"), (52, "a" * 700, "x"), (53, "ab cd" * 80, "x"), (54, rows[3][1], "x"), (54, rows[3][1], "x"), (55, text(30000), "x")]
    count = defaultdict(int)
    for _, t, _ in rows:
        b = (t or "").encode()
        for i in range(len(b) - 199):
            count[b[i : i + 200]] += 1
    want = Counter()
    for d, t, _ in rows:
        b = (t or "").encode()
        mask = bytearray(len(b))
        for i in range(len(b) - 199):
            if count[b[i : i + 200]] > 1:
                mask[i : i + 200] = b"\1" * 200
        spans = sum(1 for i in range(len(mask)) if mask[i] and (i == 0 or not mask[i - 1]))
        want[d, len(b), sum(mask), spans, hashlib.sha256(bytes(x for x, m in zip(b, mask, strict=True) if not m)).hexdigest()] += 1
    df = spark.createDataFrame(rows, DOCS).repartition(5)
    assert Counter(map(tuple, suffix_dedup.remove_repeats(df).collect())) == want
    assert suffix_dedup.remove_repeats(empty(spark)).count() == 0
    assert {r.label for r in suffix_dedup.remove_repeats(df, keep=("label",), with_text=True).collect()} == {"x"}


def test_multikey_order_sorts():
    r = np.random.default_rng(0)
    a, b, c = (r.integers(0, 4, 200).astype(np.uint64) for _ in range(3))
    o = suffix_dedup.multikey_order(a, b, c)
    assert [(a[i], b[i], c[i]) for i in o] == sorted(zip(a, b, c, strict=True))


# --- 5 --------------------------------------------------------------------------------------------------------------


def test_packing_is_whole_and_tight(spark):
    random.seed(1)
    rows = [(i, " ".join(random.choice(("alpha", "béta", "x9")) for _ in range(random.choice((1, 50, 300, 900)))), "x") for i in range(60)] + [(70, None, "x"), (71, "", "x"), (71, "", "x"), (72, "a <|endoftext|> b 12²", "x")]
    got = packing.pack_sequences(spark.createDataFrame(rows, DOCS), PACKER, 256).collect()
    packer = tokens.Packer.at(PACKER)
    total = 0
    for d, t, _ in rows:
        ids = packer.whole.encode(t or "", add_special_tokens=False).ids + [0]
        total += len(ids)
        mine = sorted({(r.piece, r.start, r.length) for r in got if r.doc_id == d})
        assert sum(x[2] for x in mine) == len(ids) and [x[1] for x in mine] == list(np.cumsum([0] + [x[2] for x in mine])[:-1])
        assert all(x[2] == 256 for x in mine[1:])
    spans = defaultdict(list)
    for r in got:
        spans[r.sequence_id].append((r.offset, r.length))
    for s in spans.values():
        s.sort()
        assert s[0][0] == 0 and all(a[0] + a[1] == b[0] for a, b in zip(s[:-1], s[1:], strict=True)) and sum(x[1] for x in s) <= 256
    assert sum(r.length for r in got) == total and len(spans) <= math.ceil(total / 256) + 1
    assert packing.pack_sequences(empty(spark), PACKER).count() == 0


def test_plans_use_every_item():
    random.seed(3)
    for _ in range(60):
        sizes = {random.randint(1, 20): random.randint(1, 6) for _ in range(6)}
        plan = packing.plan_patterns(sizes, 20)
        used = sum((Counter({s: n * times for s, n in Counter(p).items()}) for p, times in plan), Counter())
        assert used == Counter(sizes) and all(sum(p) <= 20 for p, _ in plan)
        assert sum(t for _, t in plan) >= packing.lower_bound(sizes, 20)


def fewest_by_force(items, capacity):
    best = len(items)

    def down(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(items):
            best = len(rooms)
            return
        for r in sorted(set(rooms)):
            if r >= items[i]:
                left = list(rooms)
                left.remove(r)
                down(i + 1, [*left, r - items[i]])
        down(i + 1, [*rooms, capacity - items[i]])

    down(0, [])
    return best


def test_plans_are_never_worse_than_best_fit_and_exact_when_small():
    sizes = dict.fromkeys((1229, 799, 614, 205), 300)
    plan = packing.plan_patterns(sizes, 2048)
    assert sum((Counter({s: n * t for s, n in Counter(p).items()}) for p, t in plan), Counter()) == Counter(sizes)
    assert sum(t for _, t in plan) <= 423
    random.seed(9)
    for _ in range(60):
        items = sorted((random.randint(3, 14) for _ in range(9)), reverse=True)
        plan = packing.plan_patterns(Counter(items), 20)
        assert sorted((s for p, t in plan for s in p * t), reverse=True) == items and all(sum(p) <= 20 for p, _ in plan)
        assert sum(t for _, t in plan) == fewest_by_force(items, 20)


# --- 6 --------------------------------------------------------------------------------------------------------------


def test_license_scan(spark):
    pad = "words before and after, nothing else. " * 30
    rows = [(1, pad + "Released under the MIT License.\n" + pad, "x"), (2, "Licensed under the Apache Foundation, Version 2.0. All rights reserved.", "x"), (3, pad, "x"), (4, None, "x"), (5, "", "x"), (6, "all " + pad + " rights " + pad + " reserved", "x")]
    got = {r.doc_id: r for r in license_scan.scan_licenses(spark.createDataFrame(rows, DOCS)).collect()}
    assert got[1].license == "MIT" and got[1].coverage == 1 and got[1].permitted
    assert got[2].licenses == ["All-Rights-Reserved", "Apache-2.0"] and not got[2].permitted
    assert [got[i].license for i in (3, 4, 5, 6)] == [None] * 4
    assert license_scan.scan_licenses(empty(spark)).count() == 0


def test_license_with_repeated_words_passes_the_filter():
    long = license_scan.words_of(license_scan.TEMPLATES[1][2])
    seen = [w for w in dict.fromkeys(long) if long.count(w) == 1]
    for gone in (seen[:5], seen[-5:], seen[::4][:5]):
        left = [w for w in long if w not in gone]
        assert len(left) == len(long) - 5 and len(license_scan.align(left, long)) >= 0.8 * len(long)
        found = license_scan.Scanner(license_scan.TEMPLATES[1:2], 0.8).scan("before " + " ".join(left) + " after")
        assert [(x[1], x[2]) for x in found] == [(25, "Apache-2.0")]


def test_alignment_is_increasing_and_exact_on_copies():
    assert license_scan.increasing([3, 1, 2, 5, 4]) in ([1, 2, 3], [1, 2, 4])
    random.seed(6)
    for _ in range(50):
        a, b = ([random.choice("abcdefgh") for _ in range(random.randint(0, 12))] for _ in range(2))
        pairs = license_scan.align(a, b)
        assert all(a[i] == b[j] for i, j in pairs) and pairs == sorted(set(pairs))
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs[:-1], pairs[1:], strict=True))
        assert len(license_scan.align(a, a)) == len(a)


# --- 7 --------------------------------------------------------------------------------------------------------------


def test_bpe_round_trip_equals_the_library(spark):
    import tiktoken

    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=tokens.load_ranks(RANKS), special_tokens={})
    texts = ["hello world's  \n\n foo_bar 12²3 a <|endoftext|> x", "naïve café   ", "", None, "हिन्दी 😀😀 \x85 y", "aaaaaaaaaaaaaaaaaaaa    b", "x'll I'd\r\n\r\n  z", random.Random(3).randbytes(150_000).hex(), "zß" * 400 + " " + "q" * 129]
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(5, texts[5], "x")]
    got, again = (Counter(map(tuple, bpe.round_trip(spark.createDataFrame(rows, DOCS), RANKS, by).collect())) for by in (False, True))
    want = Counter()
    for i, t, _ in rows:
        ids = enc.encode_ordinary(t or "")
        want[i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()] += 1
    assert got == want
    assert again == want
    assert bpe.round_trip(empty(spark), RANKS).count() == 0


def test_probes_do_not_move_the_documents_they_are_asked_in(spark, monkeypatch):
    """The body of all representatives lies by doc_id: a probe's join with the members deals out the asked pairs alone."""
    from weftlink.llm import minhash_dedup
    from weftlink.session import cut

    bodies = []
    probe = minhash_dedup.probe
    monkeypatch.setattr(minhash_dedup, "probe", lambda pairs, body, threshold: bodies.append(body) or probe(pairs, body, threshold))
    text = " ".join(f"w{i}" for i in range(60))
    docs = spark.createDataFrame([(i, f"{text} x{i // 2} {text}") for i in range(8)] + [(9, "alone")], "doc_id long, text string")
    assert sorted(tuple(r)[:2] for r in minhash_dedup.near_duplicates(docs).collect()) == [*((i, 0) for i in range(8)), (9, 9)]
    asked = cut(spark.range(4).withColumnRenamed("id", "b"))
    plan = asked.join(bodies[0].withColumnRenamed("doc_id", "b").hint("merge"), "b")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
