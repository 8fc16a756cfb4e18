"""Ingest operators: missing-value tokens, declared-type projection, full-row
dedupe, duplicate flag and column profile.

Landed data is read as text (CSV, JSON pages) and typed here, by column
*name*: a declared schema overrides types of the columns it names, other
columns get the type that their values have in common
(:func:`inferred_types`), declared-but-absent columns are ignored.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wellnote.schemas import DECLARED, HEADER_ALIASES, NA_TOKENS


def normalise_missing(df: DataFrame, columns: Sequence[str] | None = None,
                      tokens: Sequence[str] = NA_TOKENS) -> DataFrame:
    """Text columns: missing-value tokens (``NA``, ``null``, empty, ...) -> NULL."""
    cols = set(columns) if columns is not None else {
        f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    toks = F.array(*[F.lit(t) for t in tokens])
    return df.select(*[
        F.when(F.array_contains(toks, F.col(c)), F.lit(None).cast("string")).otherwise(F.col(c)).alias(c)
        if c in cols else F.col(c) for c in df.columns])


def cast_text(col: Column, dtype: T.DataType) -> Column:
    """Text -> declared type; unparseable text becomes NULL.

    Plain digits are read exactly over the whole 64-bit range.  An integer
    written with a fraction (``1.0``, how a nullable integer column is written
    out as text) is read as a decimal; a non-integral value is NULL.
    """
    if isinstance(dtype, (T.IntegerType, T.LongType, T.ShortType)):
        d = col.try_cast("decimal(38,9)")
        return F.coalesce(col.try_cast(dtype), F.when(d == F.round(d, 0), d.try_cast(dtype)))
    return col.try_cast(dtype)


# Kinds of values, one bit each, so that the kinds of a column are one aggregate (``bit_or``).
BOOLEAN, INTEGER, DOUBLE, TEXT, WIDE = 1, 2, 4, 8, 16
# --- fixed values: how the source systems' CSV reader writes truth values
TRUTH_VALUES = ["True", "TRUE", "true", "False", "FALSE", "false"]
_INTEGER = r"^[ \t]*[+-]?\d+[ \t]*$"
_DOUBLE = r"^[ \t]*[+-]?(?:(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?|(?i:inf|infinity))[ \t]*$"


def kind_of_text(c: Column) -> Column:
    """The kind of one value given as text; NULL for NULL.  An integer that 64 bits cannot hold is ``WIDE``."""
    number = F.when(F.rlike(c, F.lit(_INTEGER)), F.when(F.trim(c).try_cast("long").isNotNull(), INTEGER).otherwise(WIDE)) \
        .when(F.rlike(c, F.lit(_DOUBLE)), DOUBLE).otherwise(TEXT)
    return F.when(c.isNotNull(), F.when(c.isin(TRUTH_VALUES), BOOLEAN).otherwise(number))


def type_of_kinds(kinds: int | None, empty: T.DataType | None = None) -> T.DataType:
    """The type that holds all kinds of values of a column: truth values alone, integers, or
    doubles, which take integers in; everything else, also integers over 64 bits, stays text.  NULLs do not
    count; a column of nothing else is ``empty`` (default: double, as a CSV read has it)."""
    kinds = kinds or 0
    if not kinds:
        return empty or T.DoubleType()
    if kinds == BOOLEAN:
        return T.BooleanType()
    if kinds == INTEGER:
        return T.LongType()
    if kinds & DOUBLE and not kinds & (BOOLEAN | TEXT):
        return T.DoubleType()
    return T.StringType()


def inferred_types(df: DataFrame, columns: Sequence[str]) -> dict[str, T.DataType]:
    """The common type of each text column's values: one aggregate over all columns, combined in
    every task before anything is shuffled, so only one number a column reaches the driver."""
    if not columns:
        return {}
    found = df.agg(*[F.bit_or(kind_of_text(F.col(f"`{c}`"))).alias(f"c{i}") for i, c in enumerate(columns)]).first()
    return {c: type_of_kinds(found[i]) for i, c in enumerate(columns)}


def undeclared(df: DataFrame, table: str | None = None,
               declared: Sequence[tuple[str, T.DataType]] | None = None) -> list[str]:
    """Text columns of a typed projection that no declaration names."""
    known = dict(declared if declared is not None else DECLARED.get(table or "", []))
    return [f.name for f in df.schema.fields if f.name not in known and isinstance(f.dataType, T.StringType)]


def with_types(df: DataFrame, types: Mapping[str, T.DataType]) -> DataFrame:
    """Text columns cast to the types given."""
    return df.select(*[cast_text(F.col(f"`{f.name}`"), types[f.name]).alias(f.name)
                       if f.name in types and isinstance(f.dataType, T.StringType)
                       else F.col(f"`{f.name}`") for f in df.schema.fields])


def typed_projection(df: DataFrame, table: str | None = None,
                     declared: Sequence[tuple[str, T.DataType]] | None = None,
                     aliases: dict[str, str] | None = None,
                     missing: Sequence[str] = NA_TOKENS) -> DataFrame:
    """Rename known header variants, turn the source's ``missing`` tokens into
    NULL, cast the declared columns, keep the rest as text (column order
    preserved; :func:`inferred_projection` types them too).  The tokens are those of
    a CSV read; in a source with typed records (JSON) only the empty text is missing, ``NA`` is a value."""
    decl = dict(declared if declared is not None else DECLARED.get(table or "", []))
    alias = aliases if aliases is not None else HEADER_ALIASES.get(table or "", {})
    out = df
    for src, dst in alias.items():
        if src in out.columns and dst not in out.columns:
            out = out.withColumnRenamed(src, dst)
    if missing:
        out = normalise_missing(out, tokens=missing)
    return out.select(*[
        cast_text(F.col(c), decl[c]).alias(c)
        if c in decl and isinstance(out.schema[c].dataType, T.StringType)
        else F.col(c) for c in out.columns])


def inferred_projection(df: DataFrame, table: str | None = None,
                        declared: Sequence[tuple[str, T.DataType]] | None = None,
                        aliases: dict[str, str] | None = None, missing: Sequence[str] = NA_TOKENS,
                        types: Mapping[str, T.DataType] | None = None) -> DataFrame:
    """:func:`typed_projection` with the undeclared text columns cast as well: to ``types`` where the
    source knows them (JSON), else to the type their values have in common, for which the input
    is read once more when this is called."""
    typed = typed_projection(df, table, declared, aliases, missing)
    left = undeclared(typed, table, declared)
    return with_types(typed, {c: t for c, t in types.items() if c in left} if types is not None
                      else inferred_types(typed, left))


def dedupe(df: DataFrame) -> DataFrame:
    """Full-row dedupe (NULL equals NULL, NaN equals NaN)."""
    return df.dropDuplicates()


def with_duplicate_flag(df: DataFrame, flag: str = "duplicate_flag") -> DataFrame:
    """Keep every row; ``flag`` is TRUE on every member of a group of
    identical rows (all copies, not only the later ones).  A column of that
    name in the feed takes part in the comparison and is then replaced.

    Copies are counted with a partial aggregate and the counts joined back on
    all columns (NULL-safe), so a huge group of copies is pre-counted in every
    task and its rows are an ordinary skewed join side AQE can split.
    """
    cols = df.columns
    counts = df.groupBy(*[F.col(c).alias(f"__k{i}") for i, c in enumerate(cols)]).agg(
        F.count(F.lit(1)).alias("__n"))
    cond = None
    for i, c in enumerate(cols):
        e = F.col(c).eqNullSafe(F.col(f"__k{i}"))
        cond = e if cond is None else cond & e
    j = df.join(counts, cond, "inner")
    return j.select(*[c for c in cols if c != flag], (F.col("__n") > 1).alias(flag))


def column_profile(df: DataFrame, order: str | Sequence[str], width: int = 100,
                   columns: Sequence[str] | None = None) -> DataFrame:
    """One row per column: the first non-NULL value (smallest ``order``) as
    text, cut to ``width`` characters.  One aggregate pass for all columns."""
    order = [order] if isinstance(order, str) else list(order)
    key = F.struct(*[F.col(o) for o in order])
    cols = [c for c in (columns or df.columns)]
    aggs = [F.min_by(F.substring(F.col(c).cast("string"), 1, width),
                     F.when(F.col(c).isNotNull(), key)).alias(f"c{i}") for i, c in enumerate(cols)]
    stack = ", ".join(f"'{c}', c{i}" for i, c in enumerate(cols))
    return df.agg(*aggs).select(F.expr(f"stack({len(cols)}, {stack}) as (column_name, sample_value)"))


def with_file_places(df: DataFrame) -> DataFrame:
    """Rows read from files with ``__file``, ``__split`` and ``__at``: the order in which the files hold them.
    To be asked of the read itself; ``__at`` orders the rows of one split."""
    return df.select("*", F.col("_metadata.file_path").alias("__file"), F.col("_metadata.file_block_start").alias("__split"),
                     F.monotonically_increasing_id().alias("__at"))


def delivered_profile(df: DataFrame, width: int = 100) -> DataFrame:
    """:func:`column_profile` of a feed with its places (:func:`with_file_places`, or those of landed
    answers): the first value delivered in each column."""
    places = [c for c in ("__offset", "__file", "__split", "__at") if c in df.columns]
    return column_profile(df, places, width, [c for c in df.columns if c not in places])
