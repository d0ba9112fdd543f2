"""Identifiers: canonical run ids and record keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def canonical_run_id(c: Column | str) -> Column:
    """A UUID in canonical form (lower case, hyphens), whatever its spelling.

    Braces, ``urn:uuid:``, blanks, case and missing hyphens are undone. Null and blank give null; text that is
    no UUID is kept, trimmed and in lower case, so that it still equals itself.
    """
    c = F.col(c) if isinstance(c, str) else c
    hexed = F.regexp_replace(F.lower(c), r"urn:uuid:|[{}\s-]", "")
    spelt = F.concat_ws("-", *(F.substring(hexed, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))))
    plain = F.lower(F.trim(F.regexp_replace(c, r"\s+", " ")))
    return (
        F.when(c.rlike(r"\A[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}\z"), c)
        .when(hexed.rlike(r"\A[0-9a-f]{32}\z"), spelt)
        .when(F.length(plain) > 0, plain)
    )
