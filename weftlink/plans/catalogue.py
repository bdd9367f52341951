"""The query catalogue of the record-linkage engine and its DuckDB twins. Every query runs over its whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftlink.functions import keys, normalize
from weftlink.functions import similarity as sim
from weftlink.operators import blocking, features, metrics, model, profile, sampling, tfidf
from weftlink.plans import er
from weftlink.plans import oracle as o
from weftlink.session import ship
from weftlink.sources import entities as src

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}
FEW = 10  # candidates per entity where each pair is compared in full


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        _QUERIES[name] = f
        if sql:
            _SQL[name] = sql
        return f

    return add


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


# --- text ---------------------------------------------------------------------------------------------------------


@query("normalize_names", f"{o.prepared('docs')}, p AS ({o.prepared('parts')} SELECT entity_id, name_norm FROM ent) SELECT entity_id, name_norm FROM ent UNION ALL SELECT entity_id, name_norm FROM p")
def normalize_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = src.entity_view(spark, sf_dir, "docs").unionByName(src.entity_view(spark, sf_dir, "parts"))
    return both.select("entity_id", normalize.normalize_name(F.col("business_name")).alias("name_norm"))


@query("normalize_addresses", f"{o.prepared('docs')}, p AS ({o.prepared('parts')} SELECT entity_id, addr_norm FROM ent) SELECT entity_id, addr_norm FROM ent UNION ALL SELECT entity_id, addr_norm FROM p")
def normalize_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = src.entity_view(spark, sf_dir, "docs").unionByName(src.entity_view(spark, sf_dir, "parts"))
    return both.select("entity_id", normalize.normalize_address(F.col("business_address")).alias("addr_norm"))


@query("strip_url_suffix", "SELECT page_id, regexp_replace(lower(url), '\\b(\\w+)\\.(com|net|org|in|io|co)\\b', '\\1', 'g') AS url_stripped FROM pages")
def strip_url_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", normalize.strip_url_ending(F.lower("url")).alias("url_stripped"))


@query("nonlatin_names", "SELECT doc_id, length(regexp_replace(text, '[\\x{0000}-\\x{024F}]', '', 'g')) > 0.4 * length(text) AS nonlatin FROM documents")
def nonlatin_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", normalize.is_nonlatin(F.col("text")).alias("nonlatin"))


@query("house_and_numbers", f"{o.prepared('parts')} SELECT entity_id, house_num, array_to_string(list_sort({o.NUMBERS.format(a='addr_norm')}), ' ') AS numbers FROM ent")
def house_and_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = er.prepared(spark, sf_dir, "parts")
    return e.select("entity_id", "house_num", F.array_join(F.array_sort(keys.number_tokens(F.col("addr_norm"))), " ").alias("numbers"))


@query("soundex_custom", f"{o.prepared('docs')} SELECT entity_id, name_soundex FROM ent")
def soundex_custom(spark: SparkSession, sf_dir: str) -> DataFrame:
    return er.prepared(spark, sf_dir, "docs").select("entity_id", "name_soundex")


@query("addr_prefix_hash", f"{o.prepared('parts')} SELECT entity_id, CASE WHEN addr_norm = '' THEN '' ELSE substr(md5(array_to_string(string_split(addr_norm, ' ')[1:3], ' ')), 1, 8) END AS addr_hash FROM ent")
def addr_prefix_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return er.prepared(spark, sf_dir, "parts").select("entity_id", keys.address_prefix_hash(F.col("addr_norm")).alias("addr_hash"))


# --- similarities: each entity against the one with the next number --------------------------------------------------

_PAIRS = f"""{o.prepared('parts')}, numbered AS (SELECT *, CAST(split_part(entity_id, '-', 2) AS BIGINT) AS k FROM ent),
pairs AS (SELECT a.entity_id AS a_id, b.entity_id AS b_id, a.name_norm AS a, b.name_norm AS b FROM numbered a JOIN numbered b ON b.k = a.k + 1)"""


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    e = er.prepared(spark, sf_dir, "parts").withColumn("k", F.split("entity_id", "-")[1].cast("long"))
    one = e.select(F.col("entity_id").alias("a_id"), F.col("name_norm").alias("a"), (F.col("k") + 1).alias("k"))
    return one.join(e.select(F.col("entity_id").alias("b_id"), F.col("name_norm").alias("b"), "k"), "k").select("a_id", "b_id", "a", "b")


def _similarity(name: str, sql: str, make: Callable) -> None:
    @query(name, f"{_PAIRS} SELECT a_id, b_id, {sql} AS similarity FROM pairs")
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _pairs(spark, sf_dir).select("a_id", "b_id", make(F.col("a"), F.col("b")).alias("similarity"))


_SA, _SB = o.sorted_tokens("a"), o.sorted_tokens("b")
_TA, _TB = "list_distinct(string_split(a, ' '))", "list_distinct(string_split(b, ' '))"
_INDEL_PAIRS = f"""{_PAIRS}, parts_of AS (SELECT a_id, b_id, a, b, {o.set_join(f'list_intersect({_TA}, {_TB})')} AS i,
  {o.set_join(f'list_filter({_TA}, lambda t: NOT list_contains({_TB}, t))')} AS x, {o.set_join(f'list_filter({_TB}, lambda t: NOT list_contains({_TA}, t))')} AS y FROM pairs),
sized AS (SELECT *, {o.lcs('x', 'y')} AS n, length(i) AS s, CASE WHEN length(i) > 0 THEN 1 ELSE 0 END AS g FROM parts_of)"""
_similarity("sim_levenshtein", o.lev("a", "b"), sim.levenshtein)
_similarity("sim_jaccard_word", o.guarded("a", "b", o.set_jaccard(o.tokens("a"), o.tokens("b"))), sim.jaccard_words)
_similarity("sim_jaccard_char3", o.guarded("a", "b", o.set_jaccard(o.grams3("a"), o.grams3("b"))), sim.jaccard_chars)
_similarity("sim_token_sort_lev", o.guarded("a", "b", o.lev(_SA, _SB)), lambda a, b: sim.token_sort_ratio(a, b, "levenshtein"))
_similarity(
    "sim_token_set_lev",
    o.guarded("a", "b", f"greatest({o.lev(o.set_join(f'list_intersect({_TA}, {_TB})'), o.set_join(_TA))}, {o.lev(o.set_join(f'list_intersect({_TA}, {_TB})'), o.set_join(_TB))}, {o.lev(o.set_join(_TA), o.set_join(_TB))})"),
    lambda a, b: sim.token_set_ratio(a, b, "levenshtein"),
)


@query("sim_token_sort_indel", f"{_PAIRS}, s AS (SELECT *, {_SA} AS x, {_SB} AS y FROM pairs) SELECT a_id, b_id, {o.guarded('a', 'b', f'2 * {o.lcs("x", "y")} / (length(x) + length(y))')} AS similarity FROM s")
def sim_token_sort_indel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pairs(spark, sf_dir).select("a_id", "b_id", sim.token_sort_ratio(F.col("a"), F.col("b")).alias("similarity"))


@query(
    "sim_token_set_indel",
    _INDEL_PAIRS
    + """ SELECT a_id, b_id, CASE WHEN a = '' AND b = '' THEN 1.0 WHEN a = '' OR b = '' THEN 0.0 WHEN s > 0 AND (x = '' OR y = '') THEN 1.0
  WHEN s = 0 THEN 1 - (length(x) + length(y) - 2 * n) / (2 * s + 2 * g + length(x) + length(y))
  ELSE greatest(1 - (length(x) + length(y) - 2 * n) / (2 * s + 2 * g + length(x) + length(y)), 1 - (g + length(x)) / (s + s + g + length(x)), 1 - (g + length(y)) / (s + s + g + length(y))) END AS similarity FROM sized""",
)
def sim_token_set_indel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pairs(spark, sf_dir).select("a_id", "b_id", sim.token_set_ratio(F.col("a"), F.col("b")).alias("similarity"))


# --- TF-IDF -----------------------------------------------------------------------------------------------------------

_GRAMS = {
    "name_char": "flatten(list_transform(list_filter([2, 3, 4], lambda n: n <= length({x})), lambda n: list_transform(range(1, length({x}) - n + 2), lambda i: substr({x}, i, n))))",
    "name_word": "list_concat(regexp_extract_all({x}, '[\\p{{L}}\\p{{N}}_]{{2,}}'), CASE WHEN len(regexp_extract_all({x}, '[\\p{{L}}\\p{{N}}_]{{2,}}')) > 1 THEN list_transform(range(1, len(regexp_extract_all({x}, '[\\p{{L}}\\p{{N}}_]{{2,}}'))), lambda i: regexp_extract_all({x}, '[\\p{{L}}\\p{{N}}_]{{2,}}')[i] || ' ' || regexp_extract_all({x}, '[\\p{{L}}\\p{{N}}_]{{2,}}')[i + 1]) ELSE [] END)",
}
_GRAMS["addr_char"] = _GRAMS["name_char"]


def _tfidf(space: str, most: int = 50_000) -> str:
    column = tfidf.SPACES[space][0]
    return f"""texts AS (SELECT entity_id, lower({column}) AS t, lower(substr({column}, 1, 250)) AS cut FROM ent),
fit_rows AS (SELECT entity_id, unnest({_GRAMS[space].format(x='t')}) AS gram FROM texts),
n AS (SELECT count(*) AS n FROM texts WHERE t <> ''),
vocab AS (SELECT gram, count(DISTINCT entity_id) AS df, count(*) AS total FROM fit_rows GROUP BY 1 HAVING count(DISTINCT entity_id) >= 2 ORDER BY total DESC, gram LIMIT {most}),
idf AS (SELECT gram, df, total, ln((1 + n) / (1 + df)) + 1 AS idf FROM vocab, n)"""


def _cosine_sql(space: str) -> str:
    return f"""{o.blocked(most=FEW)}, {_tfidf(space)},
tf AS (SELECT entity_id, gram, count(*) AS tf FROM (SELECT entity_id, unnest({_GRAMS[space].format(x='cut')}) AS gram FROM texts) GROUP BY 1, 2),
w AS (SELECT entity_id, gram, (1 + ln(tf)) * idf AS w FROM tf JOIN idf USING (gram)), norm AS (SELECT entity_id, sqrt(sum(w * w)) AS z FROM w GROUP BY 1),
dots AS (SELECT p.s1_id, p.cand_id, sum(a.w / na.z * b.w / nb.z) AS c FROM topped p JOIN w a ON a.entity_id = p.s1_id JOIN w b ON b.entity_id = p.cand_id AND a.gram = b.gram
  JOIN norm na ON na.entity_id = p.s1_id JOIN norm nb ON nb.entity_id = p.cand_id GROUP BY 1, 2)
SELECT p.s1_id, p.cand_id, round(coalesce(c, 0), 6) AS cosine FROM topped p LEFT JOIN dots d ON d.s1_id = p.s1_id AND d.cand_id = p.cand_id"""


@query("tfidf_vocab", f"{o.prepared('parts')}, {_tfidf('name_char')} SELECT gram, df, total, round(idf, 9) AS idf FROM idf")
def tfidf_vocab(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tfidf.fit(er.prepared(spark, sf_dir, "parts"), "name_char").withColumn("idf", F.round("idf", 9))


def _cosine(space: str) -> None:
    @query(f"tfidf_{space}_cosine", _cosine_sql(space))
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        e = er.prepared(spark, sf_dir, "parts")
        pairs = blocking.candidate_pairs(e, most=FEW)
        return tfidf.cosines(pairs, e, tfidf.fit(e, space), space, "cosine").withColumn("cosine", F.round("cosine", 6))


for _space in tfidf.SPACES:
    _cosine(_space)


# --- blocking ---------------------------------------------------------------------------------------------------------


@query("blocking_keys", f"{o.prepared('docs')}, {o.KEYS} SELECT entity_id, src, key, count(*) AS n FROM keys GROUP BY ALL")
def blocking_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blocking.blocking_keys(er.prepared(spark, sf_dir, "docs")).groupBy("entity_id", "src", "key").agg(F.count("*").alias("n"))


@query("hot_key_pruning", f"{o.prepared('parts')}, {o.KEYS}, {o.PRUNE} SELECT src, key, n, kept FROM pruning")
def hot_key_pruning(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = er.prepared(spark, sf_dir, "parts")
    return blocking.key_counts(blocking.blocking_keys(e), e)


@query("candidate_overlap_counts", f"{o.blocked('docs')} SELECT s1_id, cand_id, score FROM overlap")
def candidate_overlap_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blocking.overlap(er.prepared(spark, sf_dir, "docs"))


@query("candidates_topk", f"{o.blocked()} SELECT s1_id, cand_id, score, rank FROM topped")
def candidates_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blocking.top_candidates(blocking.overlap(er.prepared(spark, sf_dir, "parts")))


@query("candidates_labeled_injected", f"{o.blocked()} SELECT s1_id, cand_id, label FROM labeled")
def candidates_labeled_injected(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = er.prepared(spark, sf_dir, "parts")
    return blocking.candidate_pairs(e, er.truth_pairs(e))


@query(
    "blocking_recall",
    f"""{o.blocked()} SELECT 'before' AS stage, count(c.s1_id) AS found, count(*) AS total, count(c.s1_id) / count(*) AS recall FROM truth t LEFT JOIN topped c ON t.s1_id = c.s1_id AND t.cand_id = c.cand_id
UNION ALL SELECT 'after', count(c.s1_id), count(*), count(c.s1_id) / count(*) FROM truth t LEFT JOIN labeled c ON t.s1_id = c.s1_id AND t.cand_id = c.cand_id""",
)
def blocking_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = er.prepared(spark, sf_dir, "parts")
    truth = er.truth_pairs(e)
    before = blocking.recall(blocking.candidate_pairs(e), truth).select(F.lit("before").alias("stage"), "*")
    return before.unionByName(blocking.recall(blocking.candidate_pairs(e, truth), truth).select(F.lit("after").alias("stage"), "*"))


# --- features ---------------------------------------------------------------------------------------------------------

_WIDE = f"""{o.blocked(most=FEW)}, wide AS (SELECT l.s1_id, l.cand_id, label, substr(a.name_norm, 1, 250) AS a, substr(b.name_norm, 1, 250) AS b, substr(a.addr_norm, 1, 250) AS c, substr(b.addr_norm, 1, 250) AS d,
  a.house_num AS h1, b.house_num AS h2, a.name_soundex AS x1, b.name_soundex AS x2, substr(a.country, 1, 10) AS c1, substr(b.country, 1, 10) AS c2
  FROM labeled l JOIN ent a ON a.entity_id = l.s1_id JOIN ent b ON b.entity_id = l.cand_id)"""
_SC, _SD = o.sorted_tokens("c"), o.sorted_tokens("d")
_N1, _N2 = f"len({o.tokens('a')})", f"len({o.tokens('b')})"
_NAME = {
    "name_lev": o.lev("a", "b"),
    "name_tsort": o.guarded("a", "b", o.lev(_SA, _SB)),
    "name_tset": o.guarded("a", "b", f"greatest({o.lev(o.set_join(f'list_intersect({_TA}, {_TB})'), o.set_join(_TA))}, {o.lev(o.set_join(f'list_intersect({_TA}, {_TB})'), o.set_join(_TB))}, {o.lev(o.set_join(_TA), o.set_join(_TB))})"),
    "name_jacc_word": o.guarded("a", "b", o.set_jaccard(o.tokens("a"), o.tokens("b"))),
    "name_jacc_c3": o.guarded("a", "b", o.set_jaccard(o.grams3("a"), o.grams3("b"))),
    "name_exact": "(a = b AND a <> '')::INT::DOUBLE",
    "name_first_tok": "(split_part(a, ' ', 1) = split_part(b, ' ', 1) AND a <> '')::INT::DOUBLE",
    "name_len_diff": "abs(length(a) - length(b))::INTEGER",
    "name_len_ratio": f"CASE WHEN {_N1} = 0 AND {_N2} = 0 THEN 1.0 ELSE least({_N1}, {_N2}) / greatest({_N1}, {_N2}) END",
    "name_tok_count_diff": f"abs({_N1}::BIGINT - {_N2}::BIGINT)::INTEGER",
    "name_soundex_match": "(x1 <> '' AND x1 = x2)::INT::DOUBLE",
}
_ADDR = {
    "addr_lev": o.lev("c", "d"),
    "addr_tsort": o.guarded("c", "d", o.lev(_SC, _SD)),
    "addr_jacc_word": o.guarded("c", "d", o.set_jaccard(o.tokens("c"), o.tokens("d"))),
    "addr_jacc_c3": o.guarded("c", "d", o.set_jaccard(o.grams3("c"), o.grams3("d"))),
    "addr_house_match": "CASE WHEN h1 = '' OR h2 = '' THEN 0.5 ELSE (h1 = h2)::INT::DOUBLE END",
    "addr_empty": "(c = '' OR d = '')::INT::DOUBLE",
    "addr_len_diff": "abs(length(c) - length(d))::INTEGER",
    "addr_num_jacc": o.set_jaccard(o.NUMBERS.format(a="c"), o.NUMBERS.format(a="d")),
    "country_match": "(c1 <> '' AND c1 = c2)::INT::DOUBLE",
}
_FEAT = ", ".join(f"{v} AS {k}" for k, v in (_NAME | _ADDR).items())
_FEATURED = f"{_WIDE}, feat AS (SELECT s1_id, cand_id, label, {_FEAT}, 0.0::DOUBLE AS name_cos_char, 0.0::DOUBLE AS name_cos_word, 0.0::DOUBLE AS addr_cos_char FROM wide)"


def _labeled(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    ship(spark)
    e = er.prepared(spark, sf_dir, "parts")
    truth = er.truth_pairs(e)
    return e, truth, blocking.candidate_pairs(e, truth, FEW)


def _featured(spark: SparkSession, sf_dir: str, ratio: str = "levenshtein") -> tuple[DataFrame, DataFrame, DataFrame]:
    e, truth, pairs = _labeled(spark, sf_dir)
    return e, truth, features.compute_features(pairs, e, None, ratio)


@query("features_name", f"{_FEATURED} SELECT s1_id, cand_id, {', '.join(_NAME)} FROM feat")
def features_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _featured(spark, sf_dir)[2].select("s1_id", "cand_id", *_NAME)


@query("features_addr", f"{_FEATURED} SELECT s1_id, cand_id, {', '.join(_ADDR)} FROM feat")
def features_addr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _featured(spark, sf_dir)[2].select("s1_id", "cand_id", *_ADDR)


@query("features_full")
def features_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    e, _, pairs = _labeled(spark, sf_dir)
    return features.compute_features(pairs, e, er.vocabularies(e), "indel")


_MEASURED = [c for c in features.FEATURE_COLS]


@query(
    "features_summary",
    f"{_FEATURED} "
    + " UNION ALL ".join(f"SELECT '{c}' AS feature, round(avg({c}), 9) AS mean, round(stddev_samp({c}), 9) AS std, min({c})::DOUBLE AS min, max({c})::DOUBLE AS max FROM feat" for c in _MEASURED),
)
def features_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = features.summary(_featured(spark, sf_dir)[2])
    return s.withColumns({"mean": F.round("mean", 9), "std": F.round("std", 9)})


# --- metrics ----------------------------------------------------------------------------------------------------------

_F05 = "CASE WHEN 0.25 * {p} + {r} = 0 THEN 0.0 ELSE 1.25 * {p} * {r} / (0.25 * {p} + {r}) END"
_ENTITY = "CASE WHEN np = 0 AND nt = 0 THEN 1.0 WHEN np = 0 OR nt = 0 OR tp = 0 THEN 0.0 ELSE 1.25 * (tp / np) * (tp / nt) / (0.25 * (tp / np) + tp / nt) END"
_SWEPT = ("name_lev", "name_jacc_word", "addr_lev", "addr_num_jacc", "name_soundex_match")


def _sweep_sql(columns, grid_size: int) -> str:
    long = " UNION ALL ".join(f"SELECT s1_id, cand_id, label, '{c}' AS feature, {c}::DOUBLE AS score FROM feat" for c in columns)
    return f"""{_FEATURED}, long AS ({long}), marks AS (SELECT unnest(range(0, {grid_size})) * 0.05::DOUBLE AS threshold),
micro AS (SELECT feature, threshold, sum(CASE WHEN score >= threshold AND label = 1 THEN 1 ELSE 0 END)::BIGINT AS tp, sum(CASE WHEN score >= threshold AND label = 0 THEN 1 ELSE 0 END)::BIGINT AS fp,
  sum(CASE WHEN score < threshold AND label = 1 THEN 1 ELSE 0 END)::BIGINT AS fn FROM long, marks GROUP BY 1, 2),
ones AS (SELECT entity_id AS s1_id, (SELECT count(*) FROM truth t WHERE t.s1_id = entity_id) AS nt FROM ent WHERE src = 1),
each AS (SELECT o.s1_id, m.threshold, f.feature, nt, count(CASE WHEN l.score >= m.threshold THEN 1 END) AS np, count(CASE WHEN l.score >= m.threshold AND l.label = 1 THEN 1 END) AS tp
  FROM ones o, marks m, (SELECT DISTINCT feature FROM long) f LEFT JOIN long l ON l.s1_id = o.s1_id AND l.feature = f.feature GROUP BY ALL),
macro AS (SELECT feature, threshold, avg({_ENTITY}) AS f05 FROM each GROUP BY 1, 2),
pr AS (SELECT *, CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END AS precision, CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / (tp + fn) END AS recall FROM micro),
swept AS (SELECT feature, round(threshold, 2) AS threshold, tp, fp, fn, precision, recall, {_F05.format(p='precision', r='recall')} AS micro_f05, round(f05, 9) AS f05 FROM pr JOIN macro USING (feature, threshold))"""


def _swept(spark: SparkSession, sf_dir: str) -> DataFrame:
    e, truth, feat = _featured(spark, sf_dir)
    ones = e.where("src = 1").select(F.col("entity_id").alias("s1_id"))
    s = metrics.sweep(feat, _SWEPT, metrics.FEATURE_GRID, truth, ones)
    return s.select("feature", F.round("threshold", 2).alias("threshold"), "tp", "fp", "fn", "precision", "recall", "micro_f05", F.round("f05", 9).alias("f05"))


@query("threshold_sweep", f"{_sweep_sql(_SWEPT, 21)} SELECT * FROM swept")
def threshold_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _swept(spark, sf_dir)


@query("best_threshold", f"{_sweep_sql(_SWEPT, 21)} SELECT threshold, micro_f05 AS f05 FROM swept WHERE feature = 'name_jacc_word' ORDER BY micro_f05 DESC, threshold LIMIT 1")
def best_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.best_threshold(_swept(spark, sf_dir).where("feature = 'name_jacc_word'"))


@query("best_single_feature", f"{_sweep_sql(_SWEPT, 21)} SELECT feature, threshold, f05 FROM swept ORDER BY f05 DESC, list_position({list(metrics.SWEPT)!r}, feature), threshold LIMIT 1")
def best_single_feature(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.best_feature(_swept(spark, sf_dir))


_CONFUSED = f"""{_FEATURED}, c AS (SELECT count(CASE WHEN name_jacc_word >= 0.8 AND label = 1 THEN 1 END) AS tp, count(CASE WHEN name_jacc_word >= 0.8 AND label = 0 THEN 1 END) AS fp, count(CASE WHEN name_jacc_word < 0.8 AND label = 1 THEN 1 END) AS fn FROM feat),
p AS (SELECT *, CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END AS precision, CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / (tp + fn) END AS recall FROM c)"""


@query("micro_confusion", f"{_CONFUSED} SELECT *, {_F05.format(p='precision', r='recall')} AS f05 FROM p")
def micro_confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.confusion(_featured(spark, sf_dir)[2], F.col("name_jacc_word") >= 0.8)


@query(
    "macro_f05",
    f"""{_FEATURED}, ones AS (SELECT entity_id AS s1_id FROM ent WHERE src = 1),
each AS (SELECT s1_id, (SELECT count(*) FROM truth t WHERE t.s1_id = o.s1_id) AS nt, (SELECT count(*) FROM feat f WHERE f.s1_id = o.s1_id AND name_jacc_word >= 0.8) AS np,
  (SELECT count(*) FROM feat f WHERE f.s1_id = o.s1_id AND name_jacc_word >= 0.8 AND label = 1) AS tp FROM ones o)
SELECT count(*) AS entities, round(avg({_ENTITY}), 9) AS macro_f05 FROM each""",
)
def macro_f05(spark: SparkSession, sf_dir: str) -> DataFrame:
    e, truth, feat = _featured(spark, sf_dir)
    ones = e.where("src = 1").select(F.col("entity_id").alias("s1_id"))
    return metrics.macro_f05(feat.where("name_jacc_word >= 0.8"), truth, ones).withColumn("macro_f05", F.round("macro_f05", 9))


@query("class_balance", f"{o.blocked()} SELECT sum(label)::BIGINT AS pos, sum(1 - label)::BIGINT AS neg, CASE WHEN sum(label) = 0 THEN 1.0 ELSE sum(1 - label) / sum(label) END AS scale_pos_weight FROM labeled")
def class_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = er.prepared(spark, sf_dir, "parts")
    return metrics.class_balance(blocking.candidate_pairs(e, er.truth_pairs(e)))


# --- outputs ----------------------------------------------------------------------------------------------------------

_RULE = "round(0.35 * name_lev + 0.35 * name_jacc_word + 0.2 * addr_jacc_word + 0.1 * country_match, 9)"
_RULED = f"""{o.blocked()}, wide AS (SELECT l.s1_id, l.cand_id, a.name_norm AS a, b.name_norm AS b, a.addr_norm AS c, b.addr_norm AS d, a.country AS c1, b.country AS c2
  FROM topped l JOIN ent a ON a.entity_id = l.s1_id JOIN ent b ON b.entity_id = l.cand_id),
feat AS (SELECT s1_id, cand_id, {_NAME['name_lev']} AS name_lev, {_NAME['name_jacc_word']} AS name_jacc_word, {_ADDR['addr_jacc_word']} AS addr_jacc_word, {_ADDR['country_match']} AS country_match FROM wide),
found AS (SELECT s1_id, cand_id FROM feat WHERE {_RULE} >= 0.6)"""
_LISTS = "SELECT entity_id AS source1_entity_id, coalesce((SELECT string_agg(cand_id, ',' ORDER BY cand_id) FROM {t} t WHERE t.s1_id = entity_id), '') AS {n} FROM ent WHERE src = 1"


@query("er_end_to_end_rule", f"{_RULED} {_LISTS.format(t='found', n='matched_entity_ids')}")
def er_end_to_end_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    return er.end_to_end_rule(er.prepared(spark, sf_dir, "parts"))


@query("match_list_output", f"{o.blocked()} {_LISTS.format(t='truth', n='matched_entity_ids')}")
def match_list_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return er.truth_lists(er.prepared(spark, sf_dir, "parts"))


@query("candidate_list_output", f"{o.blocked()} {_LISTS.format(t='topped', n='candidate_entity_ids')}")
def candidate_list_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = er.prepared(spark, sf_dir, "parts")
    return src.match_lists(e.where("src = 1"), blocking.candidate_pairs(e), "candidate_entity_ids")


@query(
    "output_validation",
    f"""{o.blocked()} SELECT 'not_exactly_one_row' AS rule, 0::BIGINT AS violations UNION ALL
SELECT 'match_not_candidate', count(*) FROM truth t LEFT JOIN topped c ON t.s1_id = c.s1_id AND t.cand_id = c.cand_id WHERE c.s1_id IS NULL UNION ALL SELECT 'unknown_id', 0""",
)
def output_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = er.prepared(spark, sf_dir, "parts")
    ones = e.where("src = 1")
    return metrics.validate_output(ones, e.where("src <> 1"), er.truth_lists(e), src.match_lists(ones, blocking.candidate_pairs(e), "candidate_entity_ids"))


# --- samples and splits -----------------------------------------------------------------------------------------------

_BUCKET = "CAST('0x' || substr(md5('42|' || {k}), 1, 7) AS BIGINT) % 100"


@query("group_split", f"{o.prepared('parts')} SELECT entity_id AS s1_id, CASE WHEN {_BUCKET.format(k='entity_id')} < 80 THEN 'train' ELSE 'valid' END AS part FROM ent WHERE src = 1")
def group_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.group_split(src.entity_view(spark, sf_dir, "parts").where("src = 1").select(F.col("entity_id").alias("s1_id")))


@query("sample_entities", f"{o.prepared('parts')} SELECT entity_id FROM ent WHERE src = 1 ORDER BY md5('42|' || entity_id), entity_id LIMIT 100")
def sample_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.sample(src.entity_view(spark, sf_dir, "parts").where("src = 1").select("entity_id"), "entity_id", 100)


@query(
    "negative_sampling",
    f"""{o.prepared('parts')}, {o.TRUTH}, ones AS (SELECT entity_id FROM ent WHERE src = 1 ORDER BY md5('42|' || entity_id), entity_id LIMIT 200),
numbered AS (SELECT entity_id AS cand_id, src, row_number() OVER (PARTITION BY src ORDER BY md5('42|' || entity_id), entity_id) - 1 AS place, count(*) OVER (PARTITION BY src) AS n FROM ent WHERE src <> 1),
wanted AS (SELECT DISTINCT o.entity_id AS s1_id, s.src, (CAST('0x' || substr(md5('43|' || o.entity_id || '|' || s.src), 1, 7) AS BIGINT) + k) % s.n AS place FROM ones o, (SELECT DISTINCT src, n FROM numbered) s, range(0, 5) r(k) WHERE k < s.n)
SELECT s1_id, cand_id FROM wanted JOIN numbered USING (src, place) WHERE NOT EXISTS (SELECT 1 FROM truth t WHERE t.s1_id = wanted.s1_id AND t.cand_id = numbered.cand_id)""",
)
def negative_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = src.entity_view(spark, sf_dir, "parts")
    return sampling.negative_pairs(e, er.truth_pairs(e))


@query(
    "needed_pool",
    f"""{o.prepared('parts')}, {o.TRUTH}, drawn AS (SELECT entity_id, row_number() OVER (PARTITION BY src ORDER BY md5('42|' || entity_id), entity_id) AS place FROM ent WHERE src <> 1)
SELECT entity_id FROM drawn WHERE place <= 50 UNION SELECT cand_id FROM truth""",
)
def needed_pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = src.entity_view(spark, sf_dir, "parts")
    return sampling.needed_pool(e.where("src <> 1"), er.truth_pairs(e), 50).select("entity_id")


# --- profiles ---------------------------------------------------------------------------------------------------------

_VIEW = f"WITH ent AS ({o.ENT_PARTS} UNION ALL {o.ENT_DOCS})"
_PCT = "quantile_cont(length({c}), {p}) AS p{n}"


def _both(spark: SparkSession, sf_dir: str) -> DataFrame:
    return src.entity_view(spark, sf_dir, "parts").unionByName(src.entity_view(spark, sf_dir, "docs"))


def _profile(name: str, sql: str, make: Callable[[DataFrame], DataFrame]) -> None:
    @query(name, f"{_VIEW} {sql}")
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return make(_both(spark, sf_dir))


_profile(
    "eda_blank_rates",
    "SELECT src, count(*) AS rows, count(CASE WHEN trim(business_name) = '' THEN 1 END) AS blank_names, count(CASE WHEN trim(business_address) = '' THEN 1 END) AS blank_addresses, 100.0::DOUBLE * count(CASE WHEN trim(business_name) = '' THEN 1 END) / count(*) AS blank_name_pct, 100.0::DOUBLE * count(CASE WHEN trim(business_address) = '' THEN 1 END) / count(*) AS blank_address_pct FROM ent GROUP BY 1",
    profile.blank_rates,
)
_profile("eda_country_distribution", "SELECT src, country, count(*) AS n, 100.0::DOUBLE * count(*) / sum(count(*)) OVER (PARTITION BY src) AS pct FROM ent GROUP BY 1, 2", profile.country_distribution)
_profile(
    "eda_name_length",
    "SELECT src, min(length(business_name))::INTEGER AS shortest, " + ", ".join(_PCT.format(c="business_name", p=p, n=int(100 * p)) for p in (0.25, 0.5, 0.75, 0.95, 0.99)) + ", max(length(business_name))::INTEGER AS longest FROM ent GROUP BY 1",
    profile.name_lengths,
)
_profile(
    "eda_addr_length",
    "SELECT src, " + ", ".join(_PCT.format(c="business_address", p=p, n=int(100 * p)) for p in (0.25, 0.5, 0.75, 0.95)) + ", max(length(business_address))::INTEGER AS longest FROM ent WHERE business_address <> '' GROUP BY 1",
    profile.address_lengths,
)
_profile(
    "eda_noise_patterns",
    " UNION ALL ".join(f"SELECT src, '{n}' AS pattern, count(CASE WHEN regexp_matches(business_name, {o.quoted('(?i)' + p)}) THEN 1 END) AS n FROM ent WHERE src <> 1 GROUP BY 1" for n, p in profile.NOISE)
    + " UNION ALL SELECT src, 'all_caps', count(CASE WHEN business_name = upper(business_name) AND trim(business_name) <> '' THEN 1 END) FROM ent WHERE src <> 1 GROUP BY 1",
    lambda e: profile.noise_patterns(e, None),
)
_profile("eda_blank_addr_by_country", "SELECT src, country, 100.0::DOUBLE * count(CASE WHEN trim(business_address) = '' THEN 1 END) / count(*) AS blank_pct FROM ent GROUP BY 1, 2", profile.blank_address_by_country)


@query(
    "eda_match_distribution",
    f"{o.prepared('parts')}, {o.TRUTH}, per AS (SELECT (SELECT count(*) FROM truth t WHERE t.s1_id = entity_id)::INTEGER AS matches FROM ent WHERE src = 1) SELECT matches, count(*) AS entities, 100.0::DOUBLE * count(*) / sum(count(*)) OVER () AS pct FROM per GROUP BY 1",
)
def eda_match_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.match_distribution(er.truth_lists(src.entity_view(spark, sf_dir, "parts")))


@query(
    "eda_source_breakdown",
    f"{o.prepared('parts')}, {o.TRUTH} SELECT count(CASE WHEN cand_id LIKE 'S2-%' THEN 1 END) AS s2_refs, count(CASE WHEN cand_id LIKE 'S3-%' THEN 1 END) AS s3_refs, count(CASE WHEN cand_id LIKE 'S2-%' THEN 1 END) / greatest(count(CASE WHEN cand_id LIKE 'S3-%' THEN 1 END), 1) AS ratio FROM truth",
)
def eda_source_breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.source_breakdown(er.truth_pairs(src.entity_view(spark, sf_dir, "parts")))


# --- learning (no SQL twin: tree ensembles) --------------------------------------------------------------------------------


def _trained(spark: SparkSession, sf_dir: str):
    e = er.prepared(spark, sf_dir, "parts")
    return er.train(e, er.truth_pairs(e), FEW, trees=20, max_features=5_000)


@query("gbt_match_scores")
def gbt_match_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    fitted, _, best, made = _trained(spark, sf_dir)
    scored = model.predict(fitted, made.where("part = 'valid'"))
    return scored.select("s1_id", "cand_id", "label", "prob", (F.col("prob") >= best["threshold"]).alias("predicted"))


@query("feature_importance_top10")
def feature_importance_top10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return model.importances(_trained(spark, sf_dir)[0])
