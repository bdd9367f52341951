"""SQL fragments of the catalogue's DuckDB twins."""

from __future__ import annotations

from functools import reduce

from weftlink.functions.normalize import ADDRESS_RULES, FOLD_FROM, FOLD_LONGER, FOLD_TO, LEGAL_RULES, URL_ENDING
from weftlink.operators.blocking import STOPWORDS
from weftlink.sources.entities import ENT_DOCS, ENT_PARTS

# Letters that do not decompose stand in as capitals while the rules run, because the word edges of RE2 are ASCII.
ODD, STAND_IN = "ßøæœłđðþħŋ", "ABCDEFGHIJ"


def quoted(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def rules(x: str, table) -> str:
    return reduce(lambda e, r: f"regexp_replace({e}, {quoted(r[0])}, {quoted(r[1])}, 'g')", table, x)


def _safe(c: str) -> str:
    t = f"regexp_replace(coalesce({c}, ''), '^\\s+|\\s+$', '', 'g')"
    return f"CASE WHEN lower({t}) IN ('nan', 'none') THEN '' ELSE {t} END"


def _fold(x: str) -> str:
    x = reduce(lambda e, p: f"replace({e}, {quoted(p[0])}, {quoted(p[1])})", FOLD_LONGER, x)
    return f"translate({x}, {quoted(FOLD_FROM + ODD)}, {quoted(FOLD_TO + STAND_IN)})"


def _words(x: str) -> str:
    return f"trim(regexp_replace(regexp_replace(translate({x}, '{STAND_IN}', '{ODD}'), '[^\\p{{L}}\\p{{M}}\\p{{N}}\\s]', ' ', 'g'), '\\s+', ' ', 'g'))"


FRACTION = ("(\\d+)\\s*/\\s*(\\d+)", "\\1 \\2")


def name_steps(frm: str, to: str, column: str = "business_name", extra: str = "*") -> str:
    """CTEs from `frm` to `to`, which adds name_norm."""
    return f"""{to}_1 AS (SELECT {extra}, lower({_safe(column)}) AS x FROM {frm}),
{to}_2 AS (SELECT * REPLACE ({_fold(rules('x', [(URL_ENDING, chr(92) + '1')]))} AS x) FROM {to}_1),
{to}_3 AS (SELECT * REPLACE ({rules("replace(x, '&', ' and ')", [*LEGAL_RULES, FRACTION])} AS x) FROM {to}_2),
{to} AS (SELECT * EXCLUDE (x), {_words("regexp_replace(regexp_replace(x, '^[^\\p{L}\\p{N}]+', ''), '[^\\p{L}\\p{N}]+$', '')")} AS name_norm FROM {to}_3)"""


def address_steps(frm: str, to: str, column: str = "business_address") -> str:
    return f"""{to}_1 AS (SELECT *, {_fold(f"lower({_safe(column)})")} AS x FROM {frm}),
{to} AS (SELECT * EXCLUDE (x), {_words(rules('x', [FRACTION, *ADDRESS_RULES]))} AS addr_norm FROM {to}_1)"""


HOUSE = "regexp_extract(addr_norm, '^\\s*(\\d[\\w/-]*)', 1)"


def soundex(token: str) -> str:
    u = f"upper(trim({token}))"
    m = f"regexp_replace(translate({u}, 'BFPVCGJKQSXZDTLMNR', '111122222222334556'), '[^1-6]', '0', 'g')"
    r = reduce(lambda e, d: f"regexp_replace({e}, '{d}{d}+', '{d}', 'g')", "0123456", m)
    return f"CASE WHEN regexp_matches({u}, '^[A-Z]') THEN rpad(substr({u}, 1, 1) || substr(replace(substr({r}, 2), '0', ''), 1, 3), 4, '0') ELSE '' END"


NUMBERS = "list_distinct(regexp_extract_all({a}, '\\b(\\d+)\\b', 1))"


def prepared(kind: str) -> str:
    """WITH clause that ends in `ent`: the prepared entities."""
    view = {"docs": ENT_DOCS, "parts": ENT_PARTS}[kind]
    return f"""WITH view AS ({view}), {name_steps('view', 'named')}, {address_steps('named', 'addressed')},
ent AS (SELECT *, {HOUSE} AS house_num, {soundex("split_part(name_norm, ' ', 1)")} AS name_soundex FROM addressed)"""


_STOP = ", ".join(quoted(w) for w in STOPWORDS)
TRUTH = """truth AS (SELECT a.entity_id AS s1_id, b.entity_id AS cand_id FROM ent a JOIN ent b ON right(a.business_name, 6) = right(b.business_name, 6) WHERE a.src = 1 AND b.src <> 1)"""
KEYS = f"""keys AS (SELECT entity_id, src, country, unnest(list_concat(list_concat(
    list_filter(string_split(name_norm, ' '), lambda t: length(t) >= 2 AND t NOT IN ({_STOP})),
    CASE WHEN length(name_norm) >= 5 THEN ['pfx:' || substr(name_norm, 1, 5)] ELSE [] END),
    list_transform(list_filter(string_split(addr_norm, ' '), lambda t: length(t) >= 4 AND NOT regexp_full_match(t, '[0-9]+') AND t NOT IN ({_STOP})), lambda t: 'addr:' || t))) AS key FROM ent)"""
PRUNE = """sizes AS (SELECT src, count(*) AS n_rows FROM ent WHERE src <> 1 GROUP BY 1),
counted AS (SELECT src, key, count(*) AS n FROM keys WHERE src <> 1 GROUP BY 1, 2),
pruning AS (SELECT src, key, n, n <= least(500, greatest(100, floor(n_rows * 0.01))) AS kept FROM counted JOIN sizes USING (src))"""
OVERLAP = """known AS (SELECT DISTINCT country FROM ent WHERE src <> 1 AND country <> ''),
overlap AS (SELECT a.entity_id AS s1_id, b.entity_id AS cand_id, count(*) AS score FROM keys a JOIN keys b ON a.key = b.key AND a.src = 1 AND b.src <> 1
  JOIN pruning p ON p.src = b.src AND p.key = b.key AND p.kept
  WHERE a.country NOT IN (SELECT country FROM known) OR a.country = b.country GROUP BY 1, 2)"""


def top(most: int) -> str:
    return f"""topped AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY s1_id ORDER BY score DESC, cand_id)::INTEGER AS rank FROM overlap) WHERE rank <= {most})"""


LABELED = """labeled AS (SELECT coalesce(c.s1_id, t.s1_id) AS s1_id, coalesce(c.cand_id, t.cand_id) AS cand_id, CASE WHEN t.s1_id IS NULL THEN 0 ELSE 1 END AS label
  FROM (SELECT s1_id, cand_id FROM topped) c FULL JOIN truth t ON c.s1_id = t.s1_id AND c.cand_id = t.cand_id)"""


def blocked(kind: str = "parts", most: int = 100) -> str:
    return ", ".join([prepared(kind), KEYS, PRUNE, OVERLAP, top(most), TRUTH, LABELED])


def guarded(a: str, b: str, value: str, empty: str = "1.0") -> str:
    return f"CASE WHEN {a} = '' AND {b} = '' THEN {empty} WHEN {a} = '' OR {b} = '' THEN 0.0 ELSE {value} END"


def lev(a: str, b: str) -> str:
    return guarded(a, b, f"1 - levenshtein({a}, {b}) / greatest(length({a}), length({b}))")


def tokens(x: str) -> str:
    return f"list_filter(string_split({x}, ' '), lambda t: t <> '')"


def set_jaccard(x: str, y: str) -> str:
    union = f"len(list_distinct(list_concat({x}, {y})))"
    return f"CASE WHEN {union} = 0 THEN 1.0 ELSE len(list_intersect(list_distinct({x}), list_distinct({y}))) / {union} END"


def grams3(x: str) -> str:
    return f"list_distinct(list_transform(range(1, greatest(length({x}), 1) + 1), lambda i: substr('$' || {x} || '$', i, 3)))"


def sorted_tokens(x: str) -> str:
    return f"array_to_string(list_sort({tokens(x)}), ' ')"


def set_join(x: str) -> str:
    return f"array_to_string(list_sort({x}), ' ')"


def lcs(a: str, b: str) -> str:
    """Longest common subsequence by dynamic programming over lists; rows and steps are lists of one type."""
    inner = (
        f"list_reduce(list_prepend([0], list_transform(range(1, length({b}) + 1), lambda j: [j::INTEGER])), "
        f"lambda cur, j: list_append(cur, CASE WHEN unicode(substr({b}, j[1], 1)) = ca[1] THEN prev[j[1]] + 1 ELSE greatest(prev[j[1] + 1], cur[len(cur)]) END))"
    )
    start = f"list_transform(range(0, length({b}) + 1), lambda z: 0::INTEGER)"
    steps = f"list_transform(range(1, length({a}) + 1), lambda i: [unicode(substr({a}, i, 1))::INTEGER])"
    return f"CASE WHEN length({a}) = 0 OR length({b}) = 0 THEN 0 ELSE list_reduce(list_prepend({start}, {steps}), lambda prev, ca: {inner})[-1] END"
