"""Tables as immutable parquet folders plus a small log of versions.

A version is a list of folders. Writing never touches a folder that a version
names, and one log entry makes a new version visible, so readers see all of a
load or none of it and a lost executor costs only a task retry. One writer per
table is assumed; a second one fails on its log entry instead of overwriting.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sedimenta.functions.columns import merge_schemas, union_evolved
from sedimenta.scratch import file_system, local_frame
from sedimenta.sources.catalog import quoted
from sedimenta.sources.files import list_files

_COMMIT = "_commit"
_BUCKET = "_bucket"
# Versions from one log entry that names all parts to the next.
SNAPSHOT_EVERY = 16
# Folders of the file index after which it is compacted; commits one part may name.
INDEX_FOLDERS = 64
HELD_COMMITS = 1000


class CommitConflict(RuntimeError):
    """A version could not be published; the table is as it was."""


@dataclass(frozen=True)
class Version:
    """One log entry. ``parts`` hold a commit folder, the schema of its files, for a folder
    of which one partition only still counts that partition, and for one that lost buckets
    of a partition which (``gone``). Of parts split by key hash ``buckets`` says how.
    ``holds`` names the commits whose rows a part has, None if it may have any; parts
    without it were written past the file index and are always searched."""

    number: int = 0
    parts: tuple[dict, ...] = ()
    partition_columns: tuple[str, ...] = ()
    tags: dict = field(default_factory=dict)


def _without(part: dict, gone: dict | None) -> dict:
    """A part of whose rows those in ``gone`` no longer count."""
    if not gone or part["only"] is not None and part["only"].get(gone["column"], gone["value"]) != gone["value"]:
        return part
    before = part.get("gone") or {**gone, "buckets": []}
    return {**part, "gone": {**gone, "buckets": sorted({*before["buckets"], *gone["buckets"]})}}


class TableStore:
    """A versioned table under ``root``.

    With ``cluster_writes`` rows are gathered by partition before they are written,
    so a write makes few files per partition instead of one per task; Spark splits
    a partition that is too large for one task. Turn it off for a partition column
    of a few values, such as a flag.

    With ``buckets`` the files of each partition are split further by a hash of
    ``bucket_keys``, in a column that readers do not see, so that
    :meth:`replace_buckets` can rewrite some of them.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        partition_columns: Sequence[str] = (),
        cluster_writes: bool = True,
        bucket_keys: Sequence[str] = (),
        buckets: int = 0,
    ):
        self.bucket_keys, self.buckets = tuple(bucket_keys), buckets
        self.spark = spark
        self.root = root.rstrip("/")
        self.partition_columns = tuple(partition_columns)
        self.cluster_writes = cluster_writes
        self._latest: Version | None = None
        self._index: TableStore | None = None
        self._noted: str | None = None

    # -- log ------------------------------------------------------------------

    def _entries(self) -> dict[int, tuple[str, bool]]:
        """Path of every log entry, and whether it names all parts, by version."""
        place, files = file_system(self.spark, f"{self.root}/log")
        if not files.exists(place):
            return {}
        found = {}
        for status in files.listStatus(place):
            name = status.getPath().getName()
            if m := re.fullmatch(r"v=(\d+)\.(whole|delta)\.json", name):
                found[int(m[1])] = (f"{self.root}/log/{name}", m[2] == "whole")
        return found

    def version(self, number: int | None = None) -> Version | None:
        """The latest (or a given) version, None if the table does not exist.

        A store that has committed goes on from its own commit, as the only writer;
        other instances see the latest one in the log. At most ``SNAPSHOT_EVERY``
        entries are read.
        """
        if number is None and self._latest is not None:
            return self._latest
        entries = self._entries()
        wanted = max(entries, default=None) if number is None else number
        if wanted not in entries:
            return None
        first = max(n for n, (_, whole) in entries.items() if whole and n <= wanted)
        paths = [entries[n][0] for n in range(first, wanted + 1)]
        steps = [json.loads(r["value"]) for r in self.spark.read.text(paths).collect()]
        parts: list[dict] = []
        schemas: dict[str, str] = {}
        for step in sorted(steps, key=lambda e: e["number"]):
            schemas |= step["schemas"]
            if step["keep"] is None:
                parts = []
            elif step["keep"]:
                parts = [{**p, "only": step["keep"]} for p in parts]
            parts = [_without(p, step.get("gone")) for p in parts]
            parts = parts + [{**p, "schema": schemas[p["schema"]]} for p in step["add"]]
        last = max(steps, key=lambda e: e["number"])
        return Version(wanted, tuple(parts), tuple(last["partition_columns"]), last["tags"])

    def exists(self) -> bool:
        return self.version() is not None

    def _commit(self, base: Version | None, parts, tags=None, gone: dict | None = None) -> Version:
        new = Version(
            (base.number if base else 0) + 1,
            tuple(parts),
            self.partition_columns,
            {**(base.tags if base else {}), **(tags or {})},
        )
        if gone:
            self._publish(new, base, gone)
        else:
            self._publish(new, base)
        self._latest = new
        return new

    def _publish(self, new: Version, base: Version | None, gone: dict | None = None) -> None:
        """Write a version's entry under a name of its own and rename it into place.

        The rename fails if the version exists, so of two writers one gets through, and
        a writer that dies before it leaves nothing that readers or later commits see.
        An entry holds what changed; every ``SNAPSHOT_EVERY``-th, or one that changes
        more than that can say, names all parts.
        """
        old = base.parts if base else ()
        keep: dict | None = None
        add = new.parts
        if base and new.number % SNAPSHOT_EVERY:
            for kept in [{}, *(p["only"] for p in new.parts[:1] if p["only"])]:
                carried = tuple({**p, "only": kept} if kept else _without(p, gone) for p in old)
                if old and new.parts[: len(old)] == carried:
                    keep, add = kept, new.parts[len(old) :]
                    break
        texts = list(dict.fromkeys(p["schema"] for p in add))
        entry = {
            "number": new.number,
            "keep": keep,
            "gone": None if keep is None else gone,
            "add": [{**p, "schema": f"{new.number}.{texts.index(p['schema'])}"} for p in add],
            "schemas": {f"{new.number}.{i}": text for i, text in enumerate(texts)},
            "partition_columns": new.partition_columns,
            "tags": new.tags,
        }
        name = f"v={new.number:08d}.{'whole' if keep is None else 'delta'}.json"
        # Both kinds of a version's entry exclude each other.
        if new.number in self._entries():
            raise CommitConflict(f"{self.root}: version {new.number} exists")
        jvm = self.spark._jvm
        draft, files = file_system(self.spark, f"{self.root}/log/_draft-{uuid.uuid4().hex}")
        out = files.create(draft, False)
        out.write(bytearray(json.dumps(entry).encode()))
        out.close()
        place, _ = file_system(self.spark, f"{self.root}/log/{name}")
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            place.toUri(), self.spark._jsc.hadoopConfiguration()
        )
        kind = jvm.org.apache.hadoop.fs.Options.Rename
        how = self.spark.sparkContext._gateway.new_array(kind, 1)
        how[0] = kind.NONE
        try:
            context.rename(draft, place, how)
        except Exception as err:
            files.delete(draft, False)
            raise CommitConflict(f"{self.root}: version {new.number} was not published") from err

    def _bucket_layout(self, df: DataFrame) -> dict | None:
        """How rows of ``df`` would be split: equal layouts put equal keys in one bucket."""
        if not self.buckets:
            return None
        return {"count": self.buckets, "keys": [[k, df.schema[k].dataType.simpleString()] for k in self.bucket_keys]}

    def bucket(self) -> Column:
        """The bucket of a row."""
        return F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in self.bucket_keys]), F.lit(self.buckets)).cast("int")

    def splits_like(self, df: DataFrame) -> bool:
        """Whether every part with current rows has the buckets that ``df`` would have."""
        version, layout = self.version(), self._bucket_layout(df)
        return bool(layout and version) and all(p.get("buckets") == layout for p in version.parts if p["only"] is None)

    def _write(self, df: DataFrame, holds: Sequence[str] | None = None) -> dict:
        """Write rows as a folder. ``holds`` names earlier commits they also come from; None
        says that they may come from any that the index knows."""
        noted, columns = self._noted, self.partition_columns
        name, self._noted = noted or uuid.uuid4().hex, None
        part = {"commit": name, "schema": df.schema.json(), "only": None}
        if holds is not None and (noted or holds) and len(holds) < HELD_COMMITS:
            part["holds"] = sorted({name, *holds})
        elif noted or holds:
            part["holds"] = None
        if self.buckets:
            part["buckets"] = self._bucket_layout(df)
            df, columns = df.withColumn(_BUCKET, self.bucket()), (*columns, _BUCKET)
        if columns and (self.cluster_writes or self.buckets):
            df = df.hint("rebalance", *columns)
        writer = df.write
        if columns:
            writer = writer.partitionBy(*columns)
        writer.parquet(f"{self.root}/data/{_COMMIT}={name}")
        return part

    # -- writes -----------------------------------------------------------------

    def create(self, df: DataFrame, tags=None) -> Version:
        """Make ``df`` the whole table; ``df`` may read the current version."""
        return self._commit(self.version(), [self._write(df)], tags)

    overwrite = create

    def append(self, df: DataFrame, evolve: bool = True, tags=None) -> Version:
        """Add rows. With ``evolve`` columns may be new, missing or wider; earlier
        files stay as they are and are aligned when read."""
        base = self.version()
        if base is None:
            return self._commit(None, [self._write(df, ())], tags)
        known = self.schema(base)
        merged = merge_schemas(known, df.schema)
        if not evolve and set(df.columns) != set(known.names):
            raise ValueError("batch columns differ from the table's and evolution is off")
        if not evolve and [f.dataType for f in merged] != [f.dataType for f in known]:
            raise ValueError("batch types are wider than the table's and evolution is off")
        return self._commit(base, [*base.parts, self._write(df, ())], tags)

    def replace_parts(self, df: DataFrame, parts: Sequence[dict], tags=None) -> Version:
        """Replace some parts of the current version by ``df``; the others stay as they are."""
        base = self.version()
        kept, holds = [p for p in base.parts if p not in parts], None
        if all(p.get("holds") for p in parts):
            holds = {c for p in parts for c in p["holds"]}
        new = self._write(df, holds)
        if any("holds" not in p for p in parts):
            new.pop("holds", None)
        elif holds is None:
            new["holds"] = None
        return self._commit(base, [*kept, new], tags)

    def replace_except(self, df: DataFrame, kept: dict[str, str], tags=None) -> Version:
        """Replace everything by ``df`` except the partition ``kept``.

        ``kept`` maps a partition column to its value as text. Its rows are carried
        over by reference, not rewritten.
        """
        base = self.version()
        if any(p["only"] not in (None, kept) for p in base.parts):
            raise ValueError("a table carries over one partition only")
        carried = [{**p, "only": kept} for p in base.parts]
        return self._commit(base, [*carried, self._write(df)], tags)

    def replace_buckets(self, df: DataFrame, column: str, value: str, buckets: Sequence[int], tags=None) -> Version:
        """Replace the rows of the given buckets in partition ``column`` = ``value`` by ``df``,
        which may hold rows of any bucket. All other rows are carried over by reference."""
        base = self.version()
        if not self.splits_like(df):
            raise ValueError("the table is not split by key hash as these rows would be")
        gone = {"column": column, "value": value, "buckets": sorted(buckets)} if buckets else None
        return self._commit(base, [*(_without(p, gone) for p in base.parts), self._write(df)], tags, gone)

    def tag(self, tags: dict) -> Version:
        """Record key/values without changing rows."""
        base = self.version()
        return self._commit(base, base.parts if base else [], tags)

    # -- source files -------------------------------------------------------------

    def file_index(self) -> TableStore:
        """Which commit the rows of a source file were first written in: ``_source_file``,
        ``held_in``. Files are noted before their rows are committed, so the index may name
        commits that never came to be, but misses none."""
        if self._index is None:
            self._index = TableStore(self.spark, f"{self.root}/file_index")
        return self._index

    def note_files(self, files: Sequence[str]) -> None:
        """Note paths whose rows the next write holds, before it is made."""
        self._noted = uuid.uuid4().hex
        rows = {"_source_file": list(files), "held_in": [self._noted] * len(files)}
        index = self.file_index()
        if index.exists() and len(index.version().parts) >= INDEX_FOLDERS:
            index.compact()
        index.append(local_frame(self.spark, rows).coalesce(1))

    def parts_holding(self, files: Sequence[str]) -> list[dict]:
        """Parts that may have rows of the files: those whose commits the index names for
        them, and those of which it is not known."""
        version, index = self.version(), self.file_index()
        if version is None:
            return []
        if not index.exists():
            return list(version.parts)
        wanted = local_frame(self.spark, {"_source_file": list(files)})
        noted = index.read().join(F.broadcast(wanted), "_source_file", "left_semi").select("held_in").distinct()
        names = {r["held_in"] for r in noted.collect()}
        return [p for p in version.parts if "holds" not in p or names and (p["holds"] is None or names.intersection(p["holds"]))]

    def may_hold(self, files: Sequence[str]) -> bool:
        """False only if none of the files was ever noted, so none can have rows here."""
        return bool(self.parts_holding(files))

    # -- reads ------------------------------------------------------------------

    @staticmethod
    def _schema_of(part: dict) -> T.StructType:
        return T.StructType.fromJson(json.loads(part["schema"]))

    def schema(self, version: Version | None = None) -> T.StructType:
        version = version or self.version()
        out = T.StructType([])
        for text in dict.fromkeys(p["schema"] for p in version.parts):
            out = merge_schemas(out, T.StructType.fromJson(json.loads(text)))
        return out

    def _read_parts(self, parts: Sequence[dict], buckets: Sequence[int] | None = None) -> DataFrame:
        """One scan per distinct schema and filter. Files are read with the schema
        they were written with, so no footer is opened for inference."""
        groups: dict[tuple, list[dict]] = {}
        for p in parts:
            key = (p["schema"], json.dumps(p["only"]), bool(p.get("buckets")))
            groups.setdefault(key, []).append(p)
        frames = []
        for (schema, only, split), own in groups.items():
            kind = T.StructType.fromJson(json.loads(schema))
            hidden = kind.add(_COMMIT, T.StringType())
            if split:
                hidden = hidden.add(_BUCKET, T.IntegerType())
            df = (
                self.spark.read.schema(hidden)
                .option("basePath", f"{self.root}/data")
                .parquet(*[f"{self.root}/data/{_COMMIT}={p['commit']}" for p in own])
            )
            for column, value in (json.loads(only) or {}).items():
                df = df.filter(F.col(f"`{column}`").cast("string") == value)
            if split and buckets is not None:
                df = df.filter(F.col(_BUCKET).isin(list(buckets)))
            for p in own:
                if p.get("gone"):
                    lost = F.col(f"`{p['gone']['column']}`").cast("string") == p["gone"]["value"]
                    lost = lost & (F.col(_COMMIT) == p["commit"]) & F.col(_BUCKET).isin(p["gone"]["buckets"])
                    df = df.filter(~F.coalesce(lost, F.lit(False)))
            frames.append(df.select(*[n for n in kind.names if n not in (_COMMIT, _BUCKET)]))
        return frames[0] if len(frames) == 1 else union_evolved(*frames)

    def read_parts(self, parts: Sequence[dict]) -> DataFrame:
        """The rows of some parts of a version."""
        return self._read_parts(parts)

    def read_buckets(self, buckets: Sequence[int]) -> DataFrame:
        """The rows of some buckets, and of parts that are not split."""
        return self._read_parts(self.version().parts, buckets)

    def read(self, version: int | None = None) -> DataFrame:
        """The table at its latest or a given version."""
        found = self.version(version)
        if found is None or not found.parts:
            raise ValueError(f"no such table or version: {self.root}")
        return self._read_parts(found.parts)

    def row_count(self) -> int:
        """Rows of the table, 0 if it does not exist."""
        version = self.version()
        return self.read().count() if version and version.parts else 0

    def added(self) -> DataFrame:
        """Rows the latest commit wrote."""
        return self._read_parts(self.version().parts[-1:])

    def publish(self, view: str) -> None:
        """Register the current version as a temp view."""
        self.read().createOrReplaceTempView(view)

    def publish_catalog(self, name: str) -> None:
        """Create or renew the catalog view ``name`` over the current version.

        Unlike :meth:`publish` it is kept by the catalog, so other sessions query it, and those
        of a shared metastore after this one ended. It names the folders of one version:
        readers see that version until it is renewed, after a later commit.
        """
        version = self.version()
        if version is None or not version.parts:
            raise ValueError(f"no such table or version: {self.root}")
        columns = self.schema(version)
        filled = {r["commit"] for r in self.part_sizes().collect()}
        selects = [self._select(p, columns) for p in version.parts if p["commit"] in filled]
        nothing = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`" for f in columns)
        text = " UNION ALL ".join(selects) or f"SELECT {nothing} WHERE FALSE"
        self.spark.sql(f"CREATE OR REPLACE VIEW {quoted(name)} AS {text}")

    def _select(self, part: dict, columns: T.StructType) -> str:
        """SQL for the rows of a part under the table's columns and types."""
        known = set(self._schema_of(part).names)

        def tick(column: str) -> str:
            return "`" + column.replace("`", "``") + "`"

        def value(f: T.StructField) -> str:
            if f.name not in known:
                return "NULL"
            if f.name not in self.partition_columns or not isinstance(f.dataType, T.StringType):
                return tick(f.name)
            # Readers infer the type of a partition's values, so 01 becomes 1; the path has the text.
            text = f"regexp_extract(_metadata.file_path, '/{re.sub(r'\W', '.', f.name)}=([^/]*)/', 1)"
            for _ in range(2):  # escaped in the folder's name, and that in its address
                text = f"url_decode(replace({text}, '+', '%2B'))"
            return f"nullif({text}, '__HIVE_DEFAULT_PARTITION__')"

        listed = [f"CAST({value(f)} AS {f.dataType.simpleString()}) AS {tick(f.name)}" for f in columns]
        wheres = [f"CAST({tick(c)} AS STRING) = '{v}'" for c, v in (part["only"] or {}).items()]
        if gone := part.get("gone"):
            lost = f"CAST({tick(gone['column'])} AS STRING) = '{gone['value']}' AND {_BUCKET} IN ({', '.join(map(str, gone['buckets']))})"
            wheres.append(f"NOT coalesce({lost}, FALSE)")
        where = f" WHERE {' AND '.join(wheres)}" if wheres else ""
        return f"SELECT {', '.join(listed)} FROM parquet.{tick(f'{self.root}/data/{_COMMIT}={part["commit"]}')}{where}"

    # -- upkeep -----------------------------------------------------------------

    def part_sizes(self) -> DataFrame:
        """Live files and bytes per commit folder, from a listing."""
        live, dead = F.lit(False), F.lit(False)
        groups: dict[str, list[str]] = {}
        for p in self.version().parts:
            groups.setdefault(json.dumps(p["only"]), []).append(p["commit"])
            if p.get("gone"):
                place = F.concat(F.lit(f"/{_BUCKET}="), F.regexp_extract("path", f"/{_BUCKET}=([^/]*)/", 1))
                lost = F.contains("path", F.lit(f"/{p['gone']['column']}={p['gone']['value']}/")) & (F.col("commit") == p["commit"])
                dead = dead | (lost & place.isin([f"/{_BUCKET}={b}" for b in p["gone"]["buckets"]]))
        for only, commits in groups.items():
            hit = F.col("commit").isin(commits)
            for column, value in (json.loads(only) or {}).items():
                hit = hit & F.contains("path", F.lit(f"/{column}={value}/"))
            live = live | hit
        return (
            list_files(self.spark, f"{self.root}/data/**/*.parquet")
            .withColumn("commit", F.regexp_extract("path", f"/{_COMMIT}=([^/]*)/", 1))
            .filter(live & ~dead)
            .groupBy("commit")
            .agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))
        )

    def compact(self, target_bytes: int = 256 << 20) -> Version:
        """Merge folders whose files average under half the target size.

        Large folders are carried over by reference, so upkeep follows what was
        added since, not the table. NULL partitions take part as well.
        """
        base = self.version()
        small = (
            self.part_sizes()
            .filter((F.col("files") > 0) & (F.col("bytes") / F.col("files") < target_bytes / 2))
            .collect()
        )
        files, size = sum(r["files"] for r in small), sum(r["bytes"] for r in small)
        wanted = max(1, -(-size // target_bytes))
        if files <= wanted:
            return base
        names = {r["commit"] for r in small}
        merged = [p for p in base.parts if p["commit"] in names]
        df = self._read_parts(merged)
        if not self.partition_columns:
            df = df.repartition(int(wanted))
        elif not self.cluster_writes:
            df = df.hint("rebalance", *self.partition_columns)
        return self.replace_parts(df, merged)

    def statistics(self) -> DataFrame:
        """One row: version, rows, live files, bytes and location."""
        sizes = self.part_sizes().agg(
            F.coalesce(F.sum("files"), F.lit(0)).alias("files"),
            F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"),
        ).first()
        return self.read().agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(self.version().number).alias("version"),
            "row_count",
            F.lit(sizes["files"]).cast("long").alias("files"),
            F.lit(sizes["bytes"]).cast("long").alias("size_bytes"),
            F.lit(self.root).alias("location"),
        )
