"""Semantic-id (SID) Column expressions.

Every helper returns a ``Column`` built from JVM-side functions so it stays
inside whole-stage codegen; none of them touches Python per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# SID markers, level prefixes and token range must equal the
# reference's vocabulary for results to match.
SID_BEGIN = "<|sid_begin|>"
SID_END = "<|sid_end|>"
LEVEL_PREFIXES = ["s_a", "s_b", "s_c", "s_d"]
MAX_RANGE = 256

# Whitespace removed by a Python-style ``strip()``; Java's (?U)\s covers the
# Unicode White_Space set, the \x1c-\x1f separators are added explicitly.
_WS = r"[\s\x1c-\x1f]"
_STRIP_RE = rf"(?U)^{_WS}+|{_WS}+$"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def py_strip(c) -> Column:
    """Strip leading/trailing Unicode whitespace like ``str.strip()``."""
    return F.regexp_replace(_col(c), _STRIP_RE, "")


def sid_regex(levels: int = 3) -> str:
    """Regex for a SID with exactly ``levels`` ordered level tokens."""
    body = "".join(f"<{p}_\\d+>" for p in LEVEL_PREFIXES[:levels])
    return "<\\|sid_begin\\|>" + body + "<\\|sid_end\\|>"


_INT = r"[+-]?(?:0+|[1-9][0-9]*)"
#: A list or tuple literal of integers, as a whole.
INTEGER_LIST = (rf"^(?:\[\s*(?:{_INT}\s*(?:,\s*{_INT}\s*)*,?\s*)?\]"
                rf"|\(\s*(?:{_INT}\s*,\s*(?:{_INT}\s*(?:,\s*{_INT}\s*)*,?\s*)?)?\))$")


def strict_sid_regex(levels: int = 4, letters: str = "a-d") -> str:
    """SID with exactly ``levels`` tokens drawn from ``s_[letters]`` in any order."""
    return "<\\|sid_begin\\|>(?:<s_[" + letters + "]_\\d+>){" + str(levels) + "}<\\|sid_end\\|>"


def extract_all_sids(c, levels: int = 3) -> Column:
    """H1: every SID occurrence, left to right."""
    return F.regexp_extract_all(_col(c), F.lit(sid_regex(levels)), F.lit(0))


def extract_first_sid(c, levels: int = 3) -> Column:
    """H2: first SID in the text, else the stripped text itself."""
    first = F.regexp_extract(_col(c), sid_regex(levels), 0)
    return F.when(first != "", first).otherwise(py_strip(c))


def extract_sid_strict(c, levels: int = 4, letters: str = "a-d") -> Column:
    """H3: first SID with exactly ``levels`` tokens, else null."""
    return F.nullif(F.regexp_extract(_col(c), strict_sid_regex(levels, letters), 0), F.lit(""))


def parse_semantic_id(c) -> Column:
    """H4: ``' [69,142,246] '`` -> ``[69,142,246]``; null, empty or malformed -> null.

    The whole text must be a list or tuple of integers (a trailing comma may
    stand, a tuple of one needs it).  ``'[]'`` parses to an empty array, which is
    *not* null (kept by B8).
    """
    s = py_strip(c)
    numbers = F.regexp_extract_all(s, F.lit(r"[+-]?\d+"), F.lit(0))
    return F.when(s.rlike(INTEGER_LIST), F.transform(numbers, lambda x: x.try_cast("bigint")))


def format_sid(codes, levels: int = 3) -> Column:
    """H5: integer codes -> SID string using at most ``levels`` codes.

    Null or empty arrays give null; shorter arrays give shorter SIDs.
    """
    codes = _col(codes)
    prefixes = F.array(*[F.lit(p) for p in LEVEL_PREFIXES[:levels]])
    tokens = F.transform(
        F.slice(codes, 1, levels),
        lambda x, i: F.concat(F.lit("<"), F.element_at(prefixes, i + 1), F.lit("_"),
                              x.cast("string"), F.lit(">")))
    return F.when(F.size(codes) > 0,
                  F.concat(F.lit(SID_BEGIN), F.array_join(tokens, ""), F.lit(SID_END)))


def sid_tokens(c) -> Column:
    """The SID's tokens (markers included) in position order."""
    return F.regexp_extract_all(_col(c), F.lit("<[^<>]+>"), F.lit(0))


def has_sid_markers(c) -> Column:
    c = _col(c)
    return F.contains(c, F.lit(SID_BEGIN)) & F.contains(c, F.lit(SID_END))
