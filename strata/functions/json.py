"""JSON parsing with a declared schema."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def parse_json(c: Column | str, schema: T.StructType | str, options: dict | None = None) -> Column:
    """``from_json(cast(c as string), schema)``.

    PERMISSIVE semantics: unparsable text yields a struct of NULLs, a single
    wrongly-typed field yields NULL for that field only, NULL input yields
    NULL.  Callers filter on their required key afterwards."""
    c = F.col(c) if isinstance(c, str) else c
    return F.from_json(c.cast("string"), schema, options or {})
