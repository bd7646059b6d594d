"""Finding, describing, routing and reading source files."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sedimenta.functions.scalars import base_name, file_extension, parent_path
from sedimenta.operators.dedup import top_per_group
from sedimenta.spec import FILE_FORMATS, TableSpec

LISTING_SCHEMA = "path string, length long, modificationTime timestamp"
_SCHEME = r"^[A-Za-z][A-Za-z0-9+.\-]*:(//[^/]*)?(?=/)"


def glob_regex(pattern: str) -> str:
    """Regular expression for a file glob: ``*`` and ``?`` stay inside a path
    segment, ``**`` spans any number of segments."""
    out, i = [], 0
    while i < len(pattern):
        if pattern.startswith("**/", i):
            out.append("(?:[^/]+/)*")
            i += 3
        elif pattern.startswith("**", i):
            out.append(".*")
            i += 2
        elif pattern[i] == "*":
            out.append("[^/]*")
            i += 1
        elif pattern[i] == "?":
            out.append("[^/]")
            i += 1
        elif pattern[i] == "[" and "]" in pattern[i + 2 :]:
            close = pattern.index("]", i + 2)
            inner = pattern[i + 1 : close].replace("\\", "\\\\").replace("[", "\\[")
            out.append("[" + ("^" + inner[1:] if inner.startswith("!") else inner) + "]")
            i = close + 1
        else:
            char = pattern[i]
            out.append(char if char.isalnum() or char in "/_-" else "\\" + char)
            i += 1
    return "^" + "".join(out) + "$"


def _has_scheme(pattern: str) -> bool:
    return ":" in pattern.split("/", 1)[0]


def plain_path(path, pattern: str = "/") -> Column:
    """A path in the form its pattern is written in: without scheme and authority
    if the pattern has none."""
    col = path if isinstance(path, Column) else F.col(path)
    return col if _has_scheme(pattern) else F.regexp_replace(col, _SCHEME, "")


def source_path(pattern: str = "/") -> Column:
    """Path of the file a row was read from, comparable with :func:`list_files`."""
    # The metadata path is percent-encoded, but a plus sign in it is literal.
    encoded = F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))
    return plain_path(F.url_decode(encoded), pattern)


def list_files(spark: SparkSession, pattern: str) -> DataFrame:
    """Files matching a glob: ``path``, ``length``, ``modificationTime``.

    Uses the binary-file source without its content column, so files are listed,
    not read. Folders are listed, not files one by one, which object stores answer
    in far fewer calls. No match gives an empty frame.
    """
    reader = spark.read.format("binaryFile")
    if "**" in pattern:
        root = pattern[: pattern.index("**")].rpartition("/")[0] or "/"
        reader = reader.option("recursiveFileLookup", True)
    else:
        folder, _, name = pattern.rpartition("/")
        root = folder or "/"
        reader = reader.option("pathGlobFilter", name)
    try:
        found = reader.load(root)
    except AnalysisException as err:
        if err.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LISTING_SCHEMA)
    path = plain_path("path", pattern)
    return found.select(path.alias("path"), "length", "modificationTime").filter(
        F.col("path").rlike(glob_regex(pattern))
    )


def with_file_metadata(listing: DataFrame) -> DataFrame:
    """Add name, size in MB, extension and parent directory to a listing."""
    return listing.withColumns(
        {
            "file_name": base_name("path"),
            "file_size_mb": F.round(F.col("length") / (1024 * 1024), 2),
            "file_extension": file_extension("path"),
            "parent_directory": parent_path("path"),
        }
    )


def _patterns(specs) -> Iterable[tuple[str, str]]:
    if isinstance(specs, Mapping):
        return specs.items()
    return [(s.table_name, s.source_path_pattern) for s in specs]


def route_column(path: str | Column, specs: Sequence[TableSpec] | Mapping[str, str]) -> Column:
    """Name of the first table whose glob matches the path, else NULL.

    The patterns are configuration, so they become one CASE expression and routing
    is a projection, not a join.
    """
    col = path if isinstance(path, Column) else F.col(path)
    case = None
    for name, pattern in _patterns(specs):
        hit = col.rlike(glob_regex(pattern))
        case = F.when(hit, name) if case is None else case.when(hit, name)
    return F.lit(None).cast("string") if case is None else case


def route_files(
    listing: DataFrame, specs: Sequence[TableSpec] | Mapping[str, str]
) -> DataFrame:
    """Listing with the ``table_name`` each file belongs to."""
    return listing.withColumn("table_name", route_column("path", specs))


def preview_load(routed: DataFrame, first: int = 5) -> DataFrame:
    """Per table: file count and its first paths in order.

    Each table is cut to ``first`` paths per task before anything is collected.
    """
    counts = routed.groupBy("table_name").agg(F.count(F.lit(1)).alias("files"))
    heads = (
        top_per_group(routed.select("table_name", "path"), ["table_name"], ["path"], first)
        .groupBy("table_name")
        .agg(F.sort_array(F.collect_list("path")).alias("first_paths"))
    )
    return (
        counts.alias("c")
        .join(heads.alias("h"), F.expr("c.table_name <=> h.table_name"))
        .select("c.table_name", "c.files", "h.first_paths")
    )


def listing_summary(listing: DataFrame) -> DataFrame:
    """One row: file count, total MB and distinct directories."""
    per_directory = listing.groupBy(parent_path("path").alias("directory")).agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes")
    )
    return per_directory.agg(
        F.coalesce(F.sum("files"), F.lit(0)).alias("files"),
        F.round(F.coalesce(F.sum("bytes"), F.lit(0)) / (1024 * 1024), 2).alias("total_mb"),
        F.count(F.lit(1)).alias("directories"),
    )


def read_source(
    spark: SparkSession,
    paths: str | Sequence[str],
    file_format: str = "parquet",
    evolve: bool = False,
    schema: T.StructType | str | None = None,
    options: Mapping[str, str] | None = None,
    with_source: str | None = None,
) -> DataFrame:
    """Read any number of files of one format as one frame.

    A ``schema`` saves the inference pass over CSV and JSON and the footer pass of
    a merged parquet schema. ``with_source`` is the glob the paths came from and
    adds their ``_source_file``.
    """
    fmt = file_format.lower()
    if fmt not in FILE_FORMATS:
        raise ValueError(f"Unsupported file format: {file_format}")
    reader = spark.read.format(fmt)
    if fmt == "csv":
        # Checking headers keeps files with other column orders from being read
        # by position.
        reader = reader.option("header", True).option("enforceSchema", False)
        if schema is None:
            reader = reader.option("inferSchema", True)
    if schema is not None:
        reader = reader.schema(schema)
    elif evolve:
        reader = reader.option("mergeSchema", True)
    for key, value in (options or {}).items():
        reader = reader.option(key, value)
    try:
        df = reader.load([paths] if isinstance(paths, str) else list(paths))
    except Exception as err:
        # A missing source class surfaces as a plain JVM error.
        if fmt == "delta" and "DATA_SOURCE_NOT_FOUND" in str(err):
            raise ValueError("reading delta needs its package on the class path") from err
        raise
    if with_source is not None:
        df = df.select("*", source_path(with_source).alias("_source_file"))
    return df


def read_for(spark: SparkSession, spec: TableSpec, paths: Sequence[str]) -> DataFrame:
    """Read files of a table as its description says, with their paths."""
    # A path is no pattern: characters that mean something in one are escaped.
    literal = [re.sub(r"([\\\[\]{}*?])", r"\\\1", p) for p in paths]
    return read_source(
        spark,
        literal,
        spec.file_format,
        evolve=spec.schema_evolution,
        schema=spec.source_schema,
        options=spec.reader_options,
        with_source=spec.source_path_pattern or "/",
    )
