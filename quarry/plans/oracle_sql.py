"""DuckDB expression builders for the oracle queries.

The regular-expression classes are shared with the Spark side: they were
written to mean the same thing in Java and RE2 (see ``functions.text``).
RE2 has no look-around, so word boundaries are spelled with explicit
non-word classes where needed.
"""

from __future__ import annotations

from typing import Mapping, Sequence

from ..functions import lexicon as L
from ..functions.text import PHONE_RE, PY_SPACE, PY_WORD, _py_space_pattern
from .registry import sql_str

EMAIL_RE2 = L.EMAIL_PATTERN
BOILER_RE2 = "(?i)" + "|".join(_py_space_pattern(s) for s in L.BOILERPLATE_SNIPPETS)


def rx(expr: str, pattern: str, repl: str = " ") -> str:
    return f"regexp_replace({expr}, {sql_str(pattern)}, {sql_str(repl)}, 'g')"


def collapse_ws(expr: str) -> str:
    return f"trim({rx(expr, PY_SPACE + '+')})"


def normalize_text(expr: str) -> str:
    """C1 without NFKC (the fixtures are NFKC-stable)."""
    return collapse_ws(f"replace(replace(coalesce({expr}, ''), chr(0), ''), chr(13), chr(10))")


def light_clean(expr: str) -> str:
    x = f"coalesce({expr}, '')"
    x = rx(x, EMAIL_RE2)
    x = rx(x, PHONE_RE)
    x = rx(x, BOILER_RE2)
    return collapse_ws(x)


def label_hit(lowered: str, phrases: Sequence[str], mode: str = "substring") -> str:
    if mode == "substring":
        return "(" + " OR ".join(f"contains({lowered}, {sql_str(p)})" for p in sorted({p.lower() for p in phrases if p})) + ")"
    import re

    alt = "|".join(re.escape(p.lower()) for p in sorted(set(phrases)))
    nw = PY_WORD.replace("[", "[^", 1)
    return f"regexp_matches({lowered}, {sql_str(f'(^|{nw})(?:{alt})($|{nw})')})"


def tag_union(source: str, group: str, text: str, dictionary: Mapping[str, Sequence[str]],
              tag_col: str, mode: str = "substring") -> str:
    """One row per (group, label) hit: UNION ALL over labels."""
    parts = []
    for label in sorted(dictionary):
        cond = label_hit(f"lower({text})", dictionary[label], mode)
        parts.append(f"SELECT {group}, {sql_str(label)} AS {tag_col} FROM {source} WHERE {cond}")
    return "\nUNION ALL\n".join(parts)


def words_list(expr: str) -> str:
    """``str.split()`` as a DuckDB list."""
    return f"list_filter(regexp_split_to_array(coalesce({expr}, ''), {sql_str(PY_SPACE + '+')}), lambda w: w <> '')"


def tokens(expr: str) -> str:
    return f"regexp_extract_all(lower(coalesce({expr}, '')), {sql_str(PY_WORD + '{2,}')})"


def title_case(expr: str) -> str:
    runs = f"regexp_extract_all({expr}, {sql_str(r'([\p{Lu}\p{Ll}\p{Lt}]+|[^\p{Lu}\p{Ll}\p{Lt}]+)')}, 1)"
    return (
        f"array_to_string(list_transform({runs}, lambda r: CASE WHEN regexp_matches(r, {sql_str(r'^[\p{Lu}\p{Ll}\p{Lt}]')}) "
        f"THEN upper(r[1]) || lower(r[2:]) ELSE r END), '')"
    )
