"""Role, licence and file-class normalisation as single Column expressions.

The rule lists in ``cataloguer.rules`` are turned into one ``CASE WHEN`` chain (or
one literal map lookup) at plan time, so Catalyst folds and codegens them; no
Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import rules
from .text import _col, file_extension, py_strip


def normalise_role(c) -> Column:
    """Role to AUTHOR/UPLOADER/OWNER/OTHER/UNKNOWN: strip, upper, map, else UNKNOWN."""
    m = rules.role_map()
    lookup = F.create_map(*[F.lit(x) for kv in m.items() for x in kv])
    key = F.upper(py_strip(_col(c)))
    return F.coalesce(F.try_element_at(lookup, key), F.lit("UNKNOWN"))


def normalise_license(c) -> Column:
    """Licence label from the ordered rule list; unmatched values are returned as given.

    The match runs on ``strip(rstrip(lower(x), '/'))``. Rules keep their quirks:
    the rights-statement fragment has capitals and never matches the lower-cased
    value, and plain substrings also hit inside longer words.
    """
    raw = _col(c)
    s = py_strip(F.rtrim(F.lower(raw), F.lit("/")))
    out = None
    for kind, pattern, label in rules.license_rules():
        cond = s.startswith(pattern) if kind == "prefix" else s.contains(pattern)
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    stripped = py_strip(raw)
    fallback = F.when(stripped.rlike(rules.SPDX_LIKE_RE), stripped).otherwise(raw)
    return out.otherwise(fallback)


def file_class(name_col) -> Column:
    """'qda' / 'companion' / 'other' from the file-name suffix."""
    ext = file_extension(name_col)
    return (
        F.when(ext.isin(rules.QDA_EXTENSIONS), F.lit("qda"))
        .when(ext.isin(rules.COMPANION_EXTENSIONS), F.lit("companion"))
        .otherwise(F.lit("other"))
    )
