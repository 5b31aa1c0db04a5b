"""ANSI/DuckDB SQL text for the same scalar rules as ``cataloguer.functions``.

Used only to write the independent oracle queries of ``__spark_entry__.oracle_sql``;
both sides are generated from the one rule list in ``cataloguer.rules``.
"""

from __future__ import annotations

from .. import rules

# Python whitespace for RE2 (its \s lacks \v).
WS = r"[\t\n\x{0b}\f\r \x{1c}-\x{1f}\x{85}\p{Z}]"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def file_ext(x: str) -> str:
    return f"regexp_extract(lower({x}), '[^/]\\.([^./]+)/*$', 1)"


def safe_name(x: str, max_len: int = 100) -> str:
    s = f"coalesce(nullif({x}, ''), 'untitled')"
    s = f"regexp_replace({s}, '[\\\\/:*?\"<>|]', '_', 'g')"
    s = f"regexp_replace({strip(s)}, '{WS}+', '_', 'g')"
    s = f"trim(substring({s}, 1, {max_len}), '_')"
    return f"coalesce(nullif({s}, ''), 'untitled')"


def role(x: str) -> str:
    m = rules.role_map()
    whens = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in m.items())
    return f"(CASE upper({strip(x)}) {whens} ELSE 'UNKNOWN' END)"


def license(x: str) -> str:
    s = strip(f"regexp_replace(lower({x}), '/+$', '')")
    parts = []
    for kind, pattern, label in rules.license_rules():
        fn = "starts_with" if kind == "prefix" else "contains"
        parts.append(f"WHEN {fn}({s}, {q(pattern)}) THEN {q(label)}")
    st = strip(x)
    fallback = f"CASE WHEN regexp_matches({st}, {q(rules.SPDX_LIKE_RE)}) THEN {st} ELSE {x} END"
    return f"(CASE {' '.join(parts)} ELSE {fallback} END)"


def file_class(x: str) -> str:
    e = file_ext(x)
    qda = ", ".join(q(v) for v in rules.QDA_EXTENSIONS)
    comp = ", ".join(q(v) for v in rules.COMPANION_EXTENSIONS)
    return f"(CASE WHEN {e} IN ({qda}) THEN 'qda' WHEN {e} IN ({comp}) THEN 'companion' ELSE 'other' END)"


def qda_types_list() -> str:
    return ", ".join(q(v) for v in rules.QDA_EXTENSIONS)


def human_size(x: str) -> str:
    a = f"abs(CAST({x} AS BIGINT))"
    units = rules.SIZE_UNITS + [rules.SIZE_UNIT_LAST]

    def fmt(i: int) -> str:
        d = 1024 ** i
        whole = f"({a} // {d})"
        rem = f"({a} % {d})"
        cents = f"({whole} * 100 + ({rem} * 100) // {d})"
        r2 = f"((({rem} * 100) % {d}) * 2)"
        c2 = f"({cents} + CASE WHEN {r2} > {d} OR ({r2} = {d} AND {cents} % 2 = 1) THEN 1 ELSE 0 END)"
        return f"CAST({c2} // 100 AS VARCHAR) || '.' || lpad(CAST({c2} % 100 AS VARCHAR), 2, '0') || ' {units[i]}'"

    whens = " ".join(f"WHEN {a} < {1024 ** (i + 1)} THEN {fmt(i)}" for i in range(len(units) - 1))
    body = f"CASE {whens} ELSE {fmt(len(units) - 1)} END"
    return f"(CASE WHEN {x} IS NULL THEN NULL ELSE (CASE WHEN {x} < 0 THEN '-' ELSE '' END) || {body} END)"


def contains_any(x: str, needles: list[str]) -> str:
    return "(" + " OR ".join(f"contains({x}, {q(n)})" for n in needles) + ")"
