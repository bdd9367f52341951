"""Name and address normalisation as Column expressions.

Rule tables are folded into chains of `regexp_replace`, so a whole normalisation is one projection inside code generation.
"""

from __future__ import annotations

import sys
import unicodedata
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Legal forms and their standard spelling, in the order in which they apply.
LEGAL_RULES = (
    (r"\bpvt\.?\s*ltd\.?\b", "pvt ltd"),
    (r"\bprivate\s+limited\b", "pvt ltd"),
    (r"\bprivate\s+ltd\.?\b", "pvt ltd"),
    (r"\bprivate\b", "pvt"),
    (r"\bsas[u]?\b", "sas"),
    (r"\bsarl\b", "sarl"),
    (r"\bsci\b", "sci"),
    (r"\beurl\b", "eurl"),
    (r"\bsa\b", "sa"),
    (r"\binc(?:orporated)?\.?\b", "inc"),
    (r"\bcorp(?:oration)?\.?\b", "corp"),
    (r"\bllc\.?\b", "llc"),
    (r"\bl\.l\.c\.?\b", "llc"),
    (r"\bllp\.?\b", "llp"),
    (r"\bl\.l\.p\.?\b", "llp"),
    (r"\bltd\.?\b", "ltd"),
    (r"\blimited\b", "ltd"),
    (r"\bco\.?\b", "co"),
    (r"\bcompany\b", "co"),
    (r"\bgroup\b", "group"),
    (r"\benterprises?\b", "enterprises"),
    (r"\bindustries?\b", "industries"),
    (r"\bassociates?\b", "associates"),
    (r"\bservices?\b", "services"),
    (r"\bsolutions?\b", "solutions"),
    (r"\bconsultants?\b", "consultants"),
)

# Address words and their standard spelling, in order; rules that map a word to itself are left out.
ADDRESS_RULES = (
    (r"\bst\.?\b", "street"),
    (r"\brd\.?\b", "road"),
    (r"\bave\.?\b", "avenue"),
    (r"\bdr\.?\b", "drive"),
    (r"\bblvd\.?\b", "blvd"),
    (r"\bboulevard\b", "blvd"),
    (r"\bct\.?\b", "court"),
    (r"\bpkwy\.?\b", "parkway"),
    (r"\bln\.?\b", "lane"),
    (r"\bhwy\.?\b", "highway"),
    (r"\bfwy\.?\b", "freeway"),
    (r"\bcir\.?\b", "circle"),
    (r"\bpl\.?\b", "place"),
    (r"\bter\.?\b", "terrace"),
    (r"\bapt\.?\b", "apt"),
    (r"\bapartment\b", "apt"),
    (r"\bste\.?\b", "ste"),
    (r"\bsuite\b", "ste"),
    (r"\bfl\.?\b", "floor"),
    (r"\bp\.?o\.?\s*box\b", "pobox"),
    (r"\bkh\.?\s*no\.?\b", "kh no"),
    (r"\bkhasra\s+no\.?\b", "kh no"),
    (r"\bopp\.?\b", "opp"),
    (r"\bopposite\b", "opp"),
)

URL_ENDING = r"\b(\w+)\.(com|net|org|in|io|co)\b"
WORD = r"[\p{L}\p{N}_]"


def _folds() -> tuple[str, str, tuple[tuple[str, str], ...]]:
    """Lower-case characters up to U+024F whose compatibility decomposition without marks differs: one-to-one pairs and expansions."""
    single, longer = [], []
    for code in range(0x80, 0x250):
        c = chr(code)
        plain = "".join(x for x in unicodedata.normalize("NFKD", c) if unicodedata.category(x) != "Mn")
        if plain != c and c.lower() == c:
            (single if len(plain) == 1 else longer).append((c, plain))
    return "".join(c for c, _ in single), "".join(p for _, p in single), tuple(longer)


FOLD_FROM, FOLD_TO, FOLD_LONGER = _folds()


def java_pattern(rule: str) -> str:
    """A rule whose `\\b` means: at the edge of letters, digits and underscore of any script (combining marks are not part of a word)."""
    body = rule.replace(r"\w", WORD)
    body = rf"(?<!{WORD}){body[2:]}" if body.startswith(r"\b") else body
    if body.endswith(r"\.?\b"):
        return body[:-5] + rf"(?:\.(?={WORD})|(?!{WORD}))"
    return body[:-2] + rf"(?!{WORD})" if body.endswith(r"\b") else body


def safe_text(c: Column) -> Column:
    """Trimmed; null, `nan` and `none` in any case are empty."""
    t = F.regexp_replace(F.coalesce(c, F.lit("")), r"(?U)^\s+|\s+$", "")
    return F.when(F.lower(t).isin("nan", "none"), "").otherwise(t)


def fold_accents(c: Column) -> Column:
    longer = reduce(lambda x, pair: F.replace(x, F.lit(pair[0]), F.lit(pair[1])), FOLD_LONGER, c)
    return F.translate(longer, FOLD_FROM, FOLD_TO)


def apply_rules(c: Column, rules: tuple[tuple[str, str], ...]) -> Column:
    return reduce(lambda x, rule: F.regexp_replace(x, java_pattern(rule[0]), rule[1]), rules, c)


def strip_url_ending(c: Column) -> Column:
    """`foo.com` becomes `foo`: one pass, without overlaps."""
    return F.regexp_replace(c, "(?i)" + java_pattern(URL_ENDING), "$1")


def split_fractions(c: Column) -> Column:
    return F.regexp_replace(c, r"(\d+)\s*/\s*(\d+)", "$1 $2")


def keep_words(c: Column) -> Column:
    """Everything but letters, marks, digits and white space becomes a space; runs of space become one."""
    spaced = F.regexp_replace(c, r"(?U)[^\p{L}\p{M}\p{N}\s]", " ")
    return F.trim(F.regexp_replace(spaced, r"(?U)\s+", " "))


def normalize_name(c: Column, strict_marks: bool = False) -> Column:
    """Business name in standard form. Noise at the ends includes a final combining mark, unless `strict_marks`."""
    edge = r"[^\p{L}\p{M}\p{N}]" if strict_marks else r"[^\p{L}\p{N}]"
    x = fold_accents(strip_url_ending(F.lower(safe_text(c))))
    x = split_fractions(apply_rules(F.replace(x, F.lit("&"), F.lit(" and ")), LEGAL_RULES))
    x = F.regexp_replace(F.regexp_replace(x, f"^{edge}+", ""), f"{edge}+$", "")
    return keep_words(x)


def normalize_address(c: Column) -> Column:
    """Address in standard form."""
    return keep_words(apply_rules(split_fractions(fold_accents(F.lower(safe_text(c)))), ADDRESS_RULES))


def is_nonlatin(c: Column, share: float = 0.4) -> Column:
    """Whether more than `share` of the characters lie above U+024F."""
    return F.length(F.regexp_replace(c, "[\\u0000-\\u024F]", "")) > share * F.length(c)
