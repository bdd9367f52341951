"""String similarities in [0, 1] as Column expressions, and an Arrow-batched longest-common-subsequence for the indel ratios.

Nulls are empty and texts are trimmed; two empty texts are equal (1), one empty text is unlike any other (0).
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def _safe(c: Column) -> Column:
    return F.trim(F.coalesce(c, F.lit("")))


def tokens(c: Column) -> Column:
    return F.filter(F.split(c, r"\s+"), lambda x: x != "")


def guarded(a: Column, b: Column, value: Column) -> Column:
    return F.when((a == "") & (b == ""), 1.0).when((a == "") | (b == ""), 0.0).otherwise(value)


def levenshtein(a: Column, b: Column) -> Column:
    a, b = _safe(a), _safe(b)
    longest = F.greatest(F.length(a), F.length(b))
    return guarded(a, b, 1 - F.levenshtein(a, b) / longest)


def set_jaccard(x: Column, y: Column) -> Column:
    """Of two arrays as sets; both empty 1, one empty 0."""
    union = F.size(F.array_union(x, y))
    return F.when(union == 0, 1.0).otherwise(F.size(F.array_intersect(x, y)) / union)


def jaccard_words(a: Column, b: Column) -> Column:
    return set_jaccard(tokens(_safe(a)), tokens(_safe(b)))


def char_grams(c: Column, n: int, pad_short: bool = True) -> Column:
    """Distinct n-grams of `$text$`; a text shorter than n is its own gram unless `pad_short`."""
    padded = F.concat(F.lit("$"), c, F.lit("$"))
    last = F.length(padded) - n + 1
    grams = F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))), lambda i: F.substring(padded, i, F.lit(n))))
    return grams if pad_short else F.when(F.length(c) < n, F.array(c)).otherwise(grams)


def jaccard_chars(a: Column, b: Column, n: int = 3, pad_short: bool = True) -> Column:
    a, b = _safe(a), _safe(b)
    return guarded(a, b, set_jaccard(char_grams(a, n, pad_short), char_grams(b, n, pad_short)))


def sorted_tokens(c: Column) -> Column:
    return F.array_join(F.array_sort(tokens(c)), " ")


def lcs_length(a: str, b: str) -> int:
    """Length of the longest common subsequence, bit-parallel over `a`."""
    where: dict[str, int] = {}
    for i, ch in enumerate(a):
        where[ch] = where.get(ch, 0) | 1 << i
    ones = (1 << len(a)) - 1
    state = ones
    for ch in b:
        u = state & where.get(ch, 0)
        state = (state + u) | (state - u)
    return (~state & ones).bit_count()


def lcs(a: Column, b: Column) -> Column:
    """Longest common subsequence of two texts; Python over Arrow batches, since an expression would copy an array per character."""

    @F.pandas_udf("int")
    def run(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([lcs_length(p, q) for p, q in zip(x, y, strict=True)], dtype="int32")

    return run(a, b)


def indel_ratio(a: Column, b: Column) -> Column:
    """2 LCS / (|a| + |b|); two empty texts are equal."""
    total = F.length(a) + F.length(b)
    return F.when(total == 0, 1.0).otherwise(2 * lcs(a, b) / total)


def token_sort_ratio(a: Column, b: Column, ratio: str = "indel") -> Column:
    a, b = _safe(a), _safe(b)
    x, y = sorted_tokens(a), sorted_tokens(b)
    return guarded(a, b, indel_ratio(x, y) if ratio == "indel" else levenshtein(x, y))


def token_set_ratio(a: Column, b: Column, ratio: str = "indel", empty: float = 1.0) -> Column:
    """Shared tokens against each rest. `empty`: the value of two empty texts, which differs between the two modes' origins."""
    a, b = _safe(a), _safe(b)
    ta, tb = F.array_distinct(tokens(a)), F.array_distinct(tokens(b))
    join = lambda x: F.array_join(F.array_sort(x), " ")
    shared = join(F.array_intersect(ta, tb))
    if ratio == "indel":
        x, y = join(F.array_except(ta, tb)), join(F.array_except(tb, ta))
        s, lx, ly = F.length(shared), F.length(x), F.length(y)
        gap = (s > 0).cast("int")
        la, lb = s + gap + lx, s + gap + ly
        rest = 1 - (lx + ly - 2 * lcs(x, y)) / (la + lb)
        best = (
            F.when((s > 0) & ((lx == 0) | (ly == 0)), 1.0)
            .when(s == 0, rest)
            .otherwise(F.greatest(rest, 1 - (gap + lx) / (s + la), 1 - (gap + ly) / (s + lb)))
        )
    else:
        x, y = join(ta), join(tb)
        best = F.greatest(levenshtein(shared, x), levenshtein(shared, y), levenshtein(x, y))
    return F.when((a == "") & (b == ""), empty).when((a == "") | (b == ""), 0.0).otherwise(best)
