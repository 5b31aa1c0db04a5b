"""String Column functions (all JVM-side expressions, no Python UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import rules

# Python's ``str.isspace`` set as a Java regex class: Java ``\s`` plus the
# information separators U+001C..U+001F, NEL and every Unicode separator (Z*).
PY_WS = r"[\s\x{1c}-\x{1f}\x{85}\p{Z}]"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Every code point Python's ``str.isspace`` accepts (derived by rule, 29 of them).
PY_WS_CHARS = "".join(chr(i) for i in range(0x110000) if chr(i).isspace())


def py_strip(c) -> Column:
    """``str.strip()``: remove Python whitespace at both ends (Spark ``trim`` only cuts U+0020).

    ``btrim`` with the explicit character set is a plain scan from both ends, no regex.
    """
    return F.btrim(_col(c), F.lit(PY_WS_CHARS))


def blank_to_null(c) -> Column:
    """``x or None`` for strings: empty string becomes NULL."""
    return F.nullif(_col(c), F.lit(""))


def file_extension(c) -> Column:
    """Suffix of the last path component, lower case, without the dot.

    Dot-files (``.gitignore``), a trailing dot and names without a dot give ``''``;
    trailing slashes are ignored (``dir.zip/`` -> ``zip``).
    """
    return F.regexp_extract(F.lower(_col(c)), r"[^/]\.([^./]+)/*$", 1)


# Characters a folder name may not hold; each becomes ``_``.
RESERVED_CHARS = '\\/:*?"<>|'


def safe_name(c, max_len: int = 100) -> Column:
    """Folder-safe name: reserved characters to ``_``, whitespace runs to ``_``,
    first ``max_len`` characters, ``_`` stripped at the ends, ``untitled`` if empty."""
    s = F.coalesce(blank_to_null(_col(c)), F.lit("untitled"))
    s = F.translate(s, RESERVED_CHARS, "_" * len(RESERVED_CHARS))
    s = F.regexp_replace(py_strip(s), f"{PY_WS}+", "_")
    s = F.btrim(F.substring(s, 1, max_len), F.lit("_"))
    return F.coalesce(blank_to_null(s), F.lit("untitled"))


def human_size(c) -> Column:
    """``1536`` -> ``'1.50 KB'``: base 1024, two decimals, units B..PB.

    Exact integer arithmetic with round-half-even (what formatting the binary
    double gives for every size below 2**53 bytes). The divisors are powers of
    two, so division is a shift and the remainder a mask.
    """
    n = _col(c).cast("bigint")
    a = F.abs(n)
    units = rules.SIZE_UNITS + [rules.SIZE_UNIT_LAST]

    def fmt(i: int) -> Column:
        d = 1024 ** i
        whole = F.shiftright(a, 10 * i)
        rem = a.bitwiseAND(F.lit(d - 1))
        cents = whole * 100 + F.shiftright(rem * 100, 10 * i)
        r2 = (rem * 100).bitwiseAND(F.lit(d - 1)) * 2
        up = (r2 > d) | ((r2 == d) & (cents % 2 == 1))
        cents = cents + F.when(up, 1).otherwise(0)
        return F.concat(
            F.floor(cents / 100).cast("bigint").cast("string"), F.lit("."),
            F.lpad((cents % 100).cast("string"), 2, "0"), F.lit(" " + units[i]),
        )

    out = fmt(len(units) - 1)
    for i in reversed(range(len(units) - 1)):
        out = F.when(a < F.lit(1024 ** (i + 1)), fmt(i)).otherwise(out)
    return F.concat(F.when(n < 0, F.lit("-")).otherwise(F.lit("")), out)


def contains_any(c, needles: list[str]) -> Column:
    """OR of plain substring tests (no regex escaping issues)."""
    col = _col(c)
    out = F.lit(False)
    for n in needles:
        out = out | col.contains(n)
    return out
