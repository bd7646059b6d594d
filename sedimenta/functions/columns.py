"""Whole-row column work: transforms, lineage columns, hashing, renaming."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sedimenta.functions.scalars import as_timestamp, base_name
from sedimenta.spec import TableSpec


def apply_transformations(
    df: DataFrame,
    transformations: Mapping | Iterable[Callable[[DataFrame], DataFrame]] | None,
) -> DataFrame:
    """Apply configured transforms in order.

    A mapping may hold ``add_columns`` ({name: SQL text or Column}), ``filter``
    (SQL text or Column) and ``select`` (list of SQL texts or Columns). A list of
    functions is chained with ``DataFrame.transform``.
    """
    if not transformations:
        return df
    if not isinstance(transformations, Mapping):
        return reduce(lambda acc, fn: acc.transform(fn), transformations, df)
    for kind, setting in transformations.items():
        if kind == "add_columns":
            for name, value in setting.items():
                df = df.withColumn(name, F.expr(value) if isinstance(value, str) else value)
        elif kind == "filter":
            df = df.filter(setting)
        elif kind == "select":
            df = df.select(*[F.expr(c) if isinstance(c, str) else c for c in setting])
        else:
            raise ValueError(f"Unknown transformation: {kind}")
    return df


def _source_column(source_file) -> Column:
    return source_file if isinstance(source_file, Column) else F.lit(source_file)


def with_scd2_columns(df: DataFrame, spec: TableSpec, as_of=None, source_file=None) -> DataFrame:
    """Open-version columns; with a source file also the lineage pair."""
    effective, end, current = spec.scd2_columns
    instant = as_timestamp(as_of)
    added = {
        effective: instant,
        end: F.lit(None).cast("timestamp"),
        current: F.lit(True),
    }
    if source_file is not None:
        added["_source_file"] = _source_column(source_file)
        added["_load_timestamp"] = instant
    return df.withColumns(added)


def with_audit_columns(df: DataFrame, as_of=None, source_file=None) -> DataFrame:
    """Lineage columns of an append load; the batch id is the file's base name.

    ``source_file`` is a path, a column, or None for a ``_source_file`` column
    that is already there (one read over many files).
    """
    source = F.col("_source_file") if source_file is None else _source_column(source_file)
    return df.withColumns(
        {
            "_load_timestamp": as_timestamp(as_of),
            "_source_file": source,
            "_batch_id": base_name(source),
        }
    )


def changed_predicate(columns: Sequence[str], left: str, right: str) -> Column:
    """True where any column differs between two aliases, NULL being a value."""
    return reduce(
        lambda a, b: a | b,
        [~F.col(f"{left}.`{c}`").eqNullSafe(F.col(f"{right}.`{c}`")) for c in columns],
    )


def with_row_hash(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    hash_column: str = "row_hash",
    method: str = "hash",
    null_token: str | None = None,
) -> DataFrame:
    """Hash of the columns' text joined by ``|``.

    NULLs are skipped unless ``null_token`` stands in for them. ``method`` is
    ``hash`` (32-bit), ``xxhash64``, ``md5`` or ``sha2``.
    """
    parts = []
    for name in columns or df.columns:
        text = F.col(f"`{name}`")
        if isinstance(df.schema[name].dataType, (T.StructType, T.MapType, T.ArrayType)):
            text = F.to_json(text)
        text = text.cast("string")
        parts.append(text if null_token is None else F.coalesce(text, F.lit(null_token)))
    joined = F.concat_ws("|", *parts)
    hashers = {
        "hash": F.hash,
        "xxhash64": F.xxhash64,
        "md5": F.md5,
        "sha2": lambda c: F.sha2(c, 256),
    }
    if method not in hashers:
        raise ValueError(f"Unsupported hash method: {method}")
    return df.withColumn(hash_column, hashers[method](joined))


# Between words of a name: before a capital that follows a small letter or digit, and
# before the last of several capitals if a small letter follows.
_WORD_START = re.compile(r"(?<=[a-z0-9])(?=[A-Z])|(?<=[^_\W])(?=[A-Z][a-z])")


def _snake(name: str) -> str:
    return _WORD_START.sub("_", name).lower()


def _camel(name: str) -> str:
    words = name.lower().split("_")
    return words[0] + "".join(w[:1].upper() + w[1:] for w in words[1:])


# Names of the strategies.
_RENAMERS = {"lowercase": str.lower, "snake_case": _snake, "camel_case": _camel}


def sanitize_columns(df: DataFrame, strategy: str = "lowercase") -> DataFrame:
    """Rename every column to lowercase, snake_case or camelCase in one projection."""
    if strategy not in _RENAMERS:
        raise ValueError(f"no way to rename columns is called {strategy!r}")
    renamed = [_RENAMERS[strategy](c) for c in df.columns]
    clashes = sorted({c for c in renamed if renamed.count(c) > 1})
    if clashes:
        raise ValueError(f"Columns collide after renaming: {clashes}")
    return df.toDF(*renamed)


def flatten_struct(df: DataFrame, sep: str = ".") -> DataFrame:
    """Replace nested structs by their leaves, named by the joined path."""

    def leaves(fields, path):
        for f in fields:
            here = [*path, f.name]
            if isinstance(f.dataType, T.StructType):
                yield from leaves(f.dataType.fields, here)
            else:
                yield here

    return df.select(
        *[
            F.col(".".join(f"`{p}`" for p in path)).alias(sep.join(path))
            for path in leaves(df.schema.fields, [])
        ]
    )


def missing_columns(df: DataFrame, required: Iterable[str]) -> list[str]:
    """Required names the frame lacks, sorted."""
    return sorted(set(required) - set(df.columns))


def require_columns(df: DataFrame, required: Iterable[str]) -> bool:
    """True if every required column is there."""
    return not missing_columns(df, required)


# Numeric types from narrow to wide.
_NUMERIC_LADDER = ("tinyint", "smallint", "int", "bigint", "float", "double")


def wider_type(left: T.DataType, right: T.DataType) -> T.DataType:
    """The type both fit in, or ValueError if one would have to be reinterpreted."""
    if left == right:
        return left
    if isinstance(left, T.NullType):
        return right
    if isinstance(right, T.NullType):
        return left
    names = (left.simpleString(), right.simpleString())
    if all(n in _NUMERIC_LADDER for n in names):
        wide = max(names, key=_NUMERIC_LADDER.index)
        if "float" in names and {"int", "bigint"} & set(names):
            wide = "double"
        return left if wide == names[0] else right if wide == names[1] else T.DoubleType()
    if isinstance(left, T.DecimalType) and isinstance(right, T.DecimalType):
        scale = max(left.scale, right.scale)
        digits = max(left.precision - left.scale, right.precision - right.scale)
        if digits + scale <= 38:
            return T.DecimalType(digits + scale, scale)
    if {type(left), type(right)} == {T.DateType, T.TimestampType}:
        return T.TimestampType()
    if isinstance(left, T.StructType) and isinstance(right, T.StructType):
        return merge_schemas(left, right)
    if isinstance(left, T.ArrayType) and isinstance(right, T.ArrayType):
        return T.ArrayType(wider_type(left.elementType, right.elementType))
    raise ValueError(f"no common type for {names[0]} and {names[1]}")


def merge_schemas(left: T.StructType, right: T.StructType) -> T.StructType:
    """Union of two schemas by name, each shared column widened."""
    incoming = {f.name: f for f in right.fields}
    merged = []
    for f in left.fields:
        other = incoming.pop(f.name, None)
        try:
            kind = f.dataType if other is None else wider_type(f.dataType, other.dataType)
        except ValueError as err:
            raise ValueError(f"column {f.name}: {err}") from err
        merged.append(T.StructField(f.name, kind, True))
    merged += [T.StructField(f.name, f.dataType, True) for f in incoming.values()]
    return T.StructType(merged)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project onto ``schema``: cast shared columns, NULL for missing ones."""
    if [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in schema]:
        return df
    have = {f.name: f.dataType for f in df.schema.fields}
    out = []
    for f in schema.fields:
        if f.name not in have:
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
        elif have[f.name] == f.dataType:
            out.append(F.col(f"`{f.name}`"))
        else:
            out.append(F.col(f"`{f.name}`").cast(f.dataType).alias(f.name))
    return df.select(*out)


def union_evolved(left: DataFrame, *others: DataFrame) -> DataFrame:
    """UNION ALL by name with added, missing and widened columns."""
    schema = reduce(merge_schemas, [o.schema for o in others], left.schema)
    return reduce(
        lambda a, b: a.union(b), [conform(d, schema) for d in (left, *others)]
    )
