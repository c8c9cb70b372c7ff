"""Column-level (scalar) functions.  All built from Spark SQL built-ins so they
stay inside whole-stage codegen; no Python UDFs."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values (must stay equal to the source behaviour):
#   characters that are collapsed to "_" when normalising column names
NAME_SEPARATOR_CHARS = " ,;{}()\n\t="
#   characters kept by the person-name normaliser (everything else is removed)
NAME_NORM_KEEP_CLASS = "[^a-z0-9 ]"


def normalize_name(name: str, keep_dots: bool = False) -> str:
    """Collapse runs of separator characters to ``_``, strip ``_`` at both
    ends, lower-case.  Dots are also collapsed unless ``keep_dots`` (dotted
    column names need back-ticks in every later expression)."""
    chars = NAME_SEPARATOR_CHARS if keep_dots else NAME_SEPARATOR_CHARS + "."
    pattern = "[" + re.escape(chars) + "]+"
    return re.sub(pattern, "_", name).strip("_").lower()


def normalize_columns(df: DataFrame, keep_dots: bool = False) -> DataFrame:
    """Rename every column with :func:`normalize_name` in one projection.

    Raises ``ValueError`` when two names collide after normalisation (a
    silent collision would make later references ambiguous)."""
    new = [normalize_name(c, keep_dots) for c in df.columns]
    seen: dict[str, str] = {}
    for old, n in zip(df.columns, new):
        if n in seen:
            raise ValueError(f"columns {seen[n]!r} and {old!r} both normalise to {n!r}")
        seen[n] = old
    return df.toDF(*new)


def name_norm(c: Column | str, compat: bool = False) -> Column:
    """Normalised person name for matching.

    Default: lower-case first, then drop everything outside ``[a-z0-9 ]``.
    ``compat=True`` reproduces the legacy order (drop, then lower-case), in
    which upper-case letters are removed: ``"Bobby JacksOn" -> "obby acksn"``.
    """
    c = F.col(c) if isinstance(c, str) else c
    if compat:
        return F.lower(F.regexp_replace(c, NAME_NORM_KEEP_CLASS, ""))
    return F.regexp_replace(F.lower(c), NAME_NORM_KEEP_CLASS, "")


def map_codes(c: Column | str, mapping: Mapping[str, str]) -> Column:
    """Map lower-cased codes through ``mapping``; anything else falls through
    lower-cased (NULL stays NULL)."""
    c = F.lower(F.col(c) if isinstance(c, str) else c)
    out = None
    for code, label in mapping.items():
        cond = c == F.lit(code.lower())
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return c if out is None else out.otherwise(c)


def bucket(c: Column | str, edges: Sequence[float], labels: Sequence[str],
           null_label: str | None = None) -> Column:
    """Label ``c`` by ascending upper edges: ``c < edges[i] -> labels[i]``,
    anything else (including NULL unless ``null_label`` is given) gets the
    last label.  ``len(labels) == len(edges) + 1``."""
    if len(labels) != len(edges) + 1:
        raise ValueError("need exactly one more label than edges")
    c = F.col(c) if isinstance(c, str) else c
    out = F.when(c.isNull(), F.lit(null_label)) if null_label is not None else None
    for edge, label in zip(edges, labels):
        cond = c < F.lit(edge)
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out.otherwise(F.lit(labels[-1]))


def rate(cond: Column) -> Column:
    """Share of rows where ``cond`` is TRUE; FALSE and NULL count as 0."""
    return F.avg(F.when(cond, F.lit(1.0)).otherwise(F.lit(0.0)))


def title_case(c: Column | str) -> Column:
    """Upper-case the first letter of each space-separated word, lower the rest."""
    return F.initcap(F.col(c) if isinstance(c, str) else c)


def zero_as_missing_flags(df: DataFrame, cols: Sequence[str], prefix: str = "is_missing_", suffix: str = "") -> DataFrame:
    """Add ``<prefix><col><suffix>`` = (col == 0) flags; the values themselves are kept."""
    present = [c for c in cols if c in df.columns]
    return df.withColumns({f"{prefix}{c}{suffix}": F.col(c) == 0 for c in present})


def integral_double_to_string(c: Column | str) -> Column:
    """Render a double-typed identifier without scientific notation:
    ``29872499824296.0 -> "29872499824296"``; non-integral values keep their
    plain decimal rendering."""
    c = F.col(c) if isinstance(c, str) else c
    plain = c.cast("string")
    # ``x % 1 == 0`` is the integrality test (``floor`` returns a long and
    # saturates above 2^63); values a decimal(38, s) cannot hold, NaN and
    # infinities fall back to the plain double text instead of failing the
    # job under ANSI casts
    return (F.when(c.isNull(), F.lit(None).cast("string"))
             .when(c % 1 == 0, F.coalesce(c.try_cast("decimal(38,0)").cast("string"), plain))
             .otherwise(F.coalesce(c.try_cast("decimal(38,10)").cast("string"), plain)))


def iso_timestamp(c: Column | str) -> Column:
    """ISO-8601 text: ``yyyy-MM-ddTHH:mm:ss`` plus ``.ffffff`` only when the
    fraction is non-zero (the Python ``isoformat`` convention)."""
    c = F.col(c) if isinstance(c, str) else c
    base = "yyyy-MM-dd'T'HH:mm:ss"
    return (F.when(F.date_format(c, "SSSSSS") == F.lit("000000"), F.date_format(c, base))
             .otherwise(F.date_format(c, base + ".SSSSSS")))


def flatten(df: DataFrame, sep: str = "_", arrays_as_json: bool = True,
            timestamps_as_text: bool = True) -> DataFrame:
    """Flatten nested structs recursively into ``parent<sep>child`` columns in
    one projection.  Arrays and maps become JSON text, timestamps ISO text."""
    cols: list[Column] = []

    def walk(dtype: T.DataType, expr: Column, name: str) -> None:
        if isinstance(dtype, T.StructType):
            for f in dtype.fields:
                walk(f.dataType, expr.getField(f.name), f"{name}{sep}{f.name}" if name else f.name)
            return
        out = expr
        if arrays_as_json and isinstance(dtype, (T.ArrayType, T.MapType)):
            out = F.to_json(expr)
        elif timestamps_as_text and isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
            out = iso_timestamp(expr)
        cols.append(out.alias(name))

    for f in df.schema.fields:
        walk(f.dataType, F.col(f"`{f.name}`"), f.name)
    return df.select(*cols)
