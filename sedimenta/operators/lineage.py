"""Questions about which source files a table holds rows of."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimenta.scratch import local_frame


def files_frame(like: DataFrame, files) -> DataFrame:
    """One-column frame ``_source_file`` from a path, a list of paths or a frame."""
    if isinstance(files, DataFrame):
        return files.select(F.col(files.columns[0]).alias("_source_file")).distinct()
    paths = [files] if isinstance(files, str) else list(dict.fromkeys(files))
    return local_frame(like.sparkSession, {"_source_file": paths})


def already_loaded(state: DataFrame, files) -> DataFrame:
    """Those of the given source files that have rows in the table.

    The table side is reduced to distinct files first, which collapses a dominant
    file inside each map task.
    """
    present = state.select("_source_file").distinct()
    return present.join(files_frame(state, files), "_source_file", "left_semi")
