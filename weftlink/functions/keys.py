"""Keys derived from normalised names and addresses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def house_number(addr: Column) -> Column:
    """The number that an address begins with, else empty."""
    return F.regexp_extract(addr, r"^\s*(\d[\w/-]*)", 1)


def number_tokens(addr: Column) -> Column:
    """Distinct tokens of digits alone (`41st` has none)."""
    return F.array_distinct(F.regexp_extract_all(addr, F.lit(r"\b(\d+)\b"), 1))


def first_token(c: Column) -> Column:
    return F.split(c, " ")[0]


def soundex(c: Column) -> Column:
    """Phonetic code in which every uncoded letter, H and W too, parts equal codes; empty unless the first letter is ASCII.

    Capitals are one letter for one, so `ß` is an uncoded letter and not SS: only the letters whose capital is ASCII are raised."""
    u = F.translate(F.trim(c), "abcdefghijklmnopqrstuvwxyzıſ", "ABCDEFGHIJKLMNOPQRSTUVWXYZIS")
    coded = F.regexp_replace(F.translate(u, "BFPVCGJKQSXZDTLMNR", "111122222222334556"), "[^1-6]", "0")
    runs = F.regexp_replace(coded, r"(.)\1+", "$1")
    code = F.concat(F.substring(u, 1, 1), F.substring(F.replace(F.substring(runs, 2, 2**31 - 1), F.lit("0"), F.lit("")), 1, 3))
    return F.when(u.rlike("^[A-Z]"), F.rpad(code, 4, "0")).otherwise("")


def address_prefix_hash(addr: Column, tokens: int = 3) -> Column:
    """First 8 hex digits of the md5 of the first tokens; empty for an empty address."""
    head = F.array_join(F.slice(F.split(addr, " "), 1, tokens), " ")
    return F.when(addr == "", "").otherwise(F.substring(F.md5(head), 1, 8))
