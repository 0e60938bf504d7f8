"""Versioned tables on plain Parquet, with the storage manifest as the only truth.

A table is ``<base>/<schema>/<table>/``: data folders, which are never changed once written,
and ``_manifest/v<N>.json`` files that list the folders of a version. A commit writes its
data first and then moves the new manifest into place, so readers see whole versions and a
job that dies half way leaves the last version as it was. All file access goes through
Hadoop's file systems, so a base may be local or in an object store. One writer per table
at a time.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkbrook.scratch import materialize, read_text, remove_path

#: Types that may widen, and to what, when a later write brings the wider one.
_WIDER = {("byte", "short"), ("byte", "integer"), ("byte", "long"), ("short", "integer"), ("short", "long"), ("integer", "long"), ("float", "double"), ("integer", "double")}


#: A batch's id: a name, or a stream and the number of its batch, which only rises.
Batch = str | tuple[str, int]


class TableError(ValueError):
    """A table request that cannot be met; nothing was changed."""


@dataclass
class Manifest:
    """schemas: those that folders were written with, each once; folders: (name, number of its schema).

    streams: per stream its last batch, for a stream repeats none but the last; batches:
    ids of single batches.
    """

    version: int
    schema: str
    comment: str = ""
    schemas: list[str] = field(default_factory=list)
    folders: list[tuple[str, int]] = field(default_factory=list)
    batches: list[str] = field(default_factory=list)
    streams: dict[str, int] = field(default_factory=dict)

    @property
    def struct(self) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.schema))

    def following(self, folders: list[tuple[str, str]], schema: T.StructType | None = None, batch: Batch | None = None) -> Manifest:
        """The next version, of ``folders`` with their schemas."""
        schemas = list(dict.fromkeys(stored for _, stored in folders))
        batches = [*self.batches, batch] if isinstance(batch, str) else self.batches
        streams = self.streams | ({batch[0]: batch[1]} if isinstance(batch, tuple) else {})
        return Manifest(self.version + 1, schema.json() if schema else self.schema, self.comment, schemas, [(name, schemas.index(stored)) for name, stored in folders], batches, streams)

    @property
    def stored(self) -> list[tuple[str, str]]:
        return [(name, self.schemas[number]) for name, number in self.folders]

    def has(self, batch: Batch | None) -> bool:
        return batch in self.batches if isinstance(batch, str) else batch is not None and self.streams.get(batch[0], -1) >= batch[1]


def quoted(*parts: str) -> str:
    return ".".join(f"`{part.replace('`', '``')}`" for part in parts if part)


def _has_empty_struct(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.StructType):
        return not dtype.fields or any(_has_empty_struct(f.dataType) for f in dtype.fields)
    if isinstance(dtype, T.ArrayType):
        return _has_empty_struct(dtype.elementType)
    return isinstance(dtype, T.MapType) and (_has_empty_struct(dtype.keyType) or _has_empty_struct(dtype.valueType))


def evolved(old: T.StructType, new: T.StructType) -> T.StructType:
    """``old`` with the columns that only ``new`` has, and with wider types where both have one."""
    have = {f.name.lower(): i for i, f in enumerate(old.fields)}
    fields = [T.StructField(f.name, f.dataType, True) for f in old.fields]
    for f in new.fields:
        at = have.get(f.name.lower())
        if at is None:
            fields.append(T.StructField(f.name, f.dataType, True))
        elif f.dataType != fields[at].dataType:
            pair = (fields[at].dataType.typeName(), f.dataType.typeName())
            if pair in _WIDER:
                fields[at] = T.StructField(fields[at].name, f.dataType, True)
            elif pair[::-1] not in _WIDER and fields[at].dataType.simpleString() != f.dataType.simpleString():
                raise TableError(f"column {f.name!r}: {pair[1]} can't be stored as {pair[0]}")
    return T.StructType(fields)


def aligned(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of ``schema`` by name whatever the case; missing ones are null."""
    have = {name.lower(): name for name in df.columns}
    return df.select([(F.col(quoted(have[f.name.lower()])) if f.name.lower() in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields])


class TableStore:
    """Tables of one schema below ``base``."""

    def __init__(self, spark: SparkSession, base: str, schema: str = "default", catalog: str | None = None):
        self.spark, self.base, self.schema, self.catalog = spark, base.rstrip("/"), schema, catalog

    # --- places -------------------------------------------------------------
    def namespace(self) -> str:
        return quoted(*([self.catalog] if self.catalog else []), self.schema)

    def identifier(self, table: str) -> str:
        return f"{self.namespace()}.{quoted(table)}"

    def path(self, table: str) -> str:
        """The catalog's name is no part of the path."""
        if not table or "/" in table or table.startswith((".", "_")):
            raise TableError(f"bad table name {table!r}")
        return f"{self.base}/{self.schema}/{table}"

    def ensure_namespace(self) -> None:
        """The schema in the session's catalog, or in the named one."""
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.namespace()}")

    # --- manifest -----------------------------------------------------------
    def _fs(self, path: str):
        jpath = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return jpath, jpath.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _list(self, path: str) -> list[str]:
        jpath, fs = self._fs(path)
        return sorted(s.getPath().getName() for s in fs.listStatus(jpath)) if fs.exists(jpath) else []

    def _versions(self, table: str) -> list[int]:
        names = self._list(f"{self.path(table)}/_manifest")
        return sorted(int(n[1:-5]) for n in names if n.startswith("v") and n.endswith(".json"))

    def manifest(self, table: str, version: int | None = None) -> Manifest:
        versions = self._versions(table)
        if not versions or version is not None and version not in versions:
            raise TableError(f"no table {table!r}" if not versions else f"{table!r} has no version {version}")
        return Manifest(**json.loads(read_text(self.spark, f"{self.path(table)}/_manifest/v{versions[-1] if version is None else version}.json")))

    def _commit(self, table: str, manifest: Manifest) -> Manifest:
        target = f"{self.path(table)}/_manifest/v{manifest.version}.json"
        jtarget, fs = self._fs(target)
        jtemp, _ = self._fs(f"{self.path(table)}/_manifest/.{uuid.uuid4().hex}.tmp")
        out = fs.create(jtemp, False)
        try:
            out.write(bytearray(json.dumps(asdict(manifest)).encode()))
        finally:
            out.close()
        if fs.exists(jtarget) or not fs.rename(jtemp, jtarget):
            fs.delete(jtemp, False)
            raise TableError(f"{table!r} got version {manifest.version} from another writer")
        return manifest

    def _write(self, table: str, df: DataFrame) -> str:
        if _has_empty_struct(df.schema):
            raise TableError("a struct without fields can't be stored")
        folder = f"data-{uuid.uuid4().hex}"
        df.write.parquet(f"{self.path(table)}/{folder}")
        return folder

    # --- reading ------------------------------------------------------------
    def exists(self, table: str) -> bool:
        return bool(self._versions(table))

    def read(self, table: str, version: int | None = None) -> DataFrame:
        """The rows of a version; columns added later are null in older folders. No job runs."""
        now = self.manifest(table, version)
        return self._frame(table, now, now.stored)

    def _frame(self, table: str, now: Manifest, stored: list[tuple[str, str]], folder_column: str | None = None) -> DataFrame:
        """The rows of some folders in the table's schema, if asked with the folder that each is in."""
        if not stored:
            return self.spark.createDataFrame([], T.StructType([*now.struct.fields, *([T.StructField(folder_column, T.StringType())] if folder_column else [])]))
        groups: dict[str, list[str]] = {}
        for folder, schema in stored:
            groups.setdefault(schema, []).append(f"{self.path(table)}/{folder}")
        frames = []
        for schema, paths in groups.items():
            frame = self.spark.read.schema(T.StructType.fromJson(json.loads(schema))).parquet(*paths)
            if folder_column:  # read before the columns are aligned: it belongs to the scan
                own = F.regexp_extract(F.input_file_name(), "(data-[0-9a-f]{32})", 1).alias(folder_column)
                frames.append(aligned(frame, now.struct).select("*", own))
            else:
                frames.append(aligned(frame, now.struct))
        return reduce(DataFrame.unionByName, frames)

    def register(self, table: str) -> str:
        """A temporary view of the current version for SQL; returns its name."""
        self.read(table).createOrReplaceTempView(table)
        return table

    def publish(self, table: str) -> str:
        """A view of the current version in the catalog, for every session that shares it; returns its full name."""
        now = self.manifest(table)
        self.ensure_namespace()
        groups: dict[str, list[str]] = {}
        for folder, schema in now.stored:
            groups.setdefault(schema, []).append(folder)
        parts = []
        for schema, folders in groups.items():
            have = {f.name.lower(): f.name for f in T.StructType.fromJson(json.loads(schema)).fields}
            columns = ", ".join(f"CAST({quoted(have[f.name.lower()]) if f.name.lower() in have else 'NULL'} AS {f.dataType.simpleString()}) AS {quoted(f.name)}" for f in now.struct.fields)
            parts += [f"SELECT {columns} FROM parquet.{quoted(f'{self.path(table)}/{folder}')}" for folder in folders]
        none = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS {quoted(f.name)}" for f in now.struct.fields)
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.identifier(table)} AS " + (" UNION ALL ".join(parts) or f"SELECT {none} WHERE false"))
        return self.identifier(table)

    def listing(self, kind: str = "tables") -> DataFrame:
        """Names of tables, schemas or catalogs as a frame of one column ``name``; without any, the default one."""
        names = {"tables": self.list_tables, "schemas": self.list_schemas, "catalogs": self.list_catalogs}[kind]()
        fallback = {"tables": [], "schemas": ["default"], "catalogs": ["spark_catalog"]}[kind]
        return self.spark.createDataFrame([(n,) for n in names or fallback], "name string")

    def list_tables(self, schema: str | None = None) -> list[str]:
        return [t for t in self._list(f"{self.base}/{schema or self.schema}") if TableStore(self.spark, self.base, schema or self.schema).exists(t)]

    def list_schemas(self) -> list[str]:
        return self._list(self.base)

    def list_catalogs(self) -> list[str]:
        return [c.name for c in self.spark.catalog.listCatalogs()]

    # --- writing ------------------------------------------------------------
    def create(self, table: str, df: DataFrame | None = None, schema: T.StructType | None = None, comment: str = "") -> Manifest:
        """A table with the rows of ``df``, or empty with ``schema`` (one string ``id`` by default).

        Does nothing where the table exists: data is never overwritten by a create.
        """
        if self.exists(table):
            return self.manifest(table)
        have = df.schema if df is not None and df.columns else schema or T.StructType([T.StructField("id", T.StringType())])
        if _has_empty_struct(have):
            raise TableError("a struct without fields can't be stored")
        first = Manifest(0, evolved(T.StructType([]), have).json(), comment)
        return self._commit(table, first.following([(self._write(table, df), have.json())] if df is not None and df.columns else []))

    def committed(self, table: str, batch: Batch) -> bool:
        return self.exists(table) and self.manifest(table).has(batch)

    def write(self, table: str, df: DataFrame, mode: str = "append", batch: Batch | None = None) -> Manifest:
        """Append or overwrite with schema evolution, by column name.

        batch: an id; a batch that the table has committed already (see ``committed``) is left out.
        """
        if mode not in ("append", "overwrite"):
            raise TableError(f"mode is {mode!r}, not append or overwrite")
        now = self.manifest(table) if self.exists(table) else self.create(table, schema=df.schema)
        if now.has(batch):
            return now
        schema = evolved(now.struct, df.schema)
        entry = (self._write(table, df), df.schema.json())
        return self._commit(table, now.following([*now.stored, entry] if mode == "append" else [entry], schema, batch))

    def _replace(self, table: str, now: Manifest, hit: set[str], df: DataFrame) -> Manifest:
        """``df`` in place of the folders in ``hit``; the others stay as they are."""
        entry = (self._write(table, df), df.schema.json())
        return self._commit(table, now.following([*(f for f in now.stored if f[0] not in hit), entry]))

    def _hit(self, rows: DataFrame) -> set[str]:
        """Folders that hold any of ``rows``; a name per folder comes back."""
        return {r[0] for r in rows.select("_folder").distinct().collect()}

    def merge(self, table: str, source: DataFrame, keys: Sequence[str]) -> Manifest:
        """Upsert: rows with equal keys are replaced, the others inserted.

        Null keys match nothing, so they insert. Two source rows that match one target row
        are an error, as is a source without one of the table's columns. The source is read
        once; only folders with rows that are replaced are written anew.
        """
        if not keys:
            raise TableError("merge needs at least one key column")
        if not self.exists(table):
            return self.create(table, source)
        now = self.manifest(table)
        have = {c.lower() for c in source.columns}
        missing = [f.name for f in now.struct.fields if f.name.lower() not in have] + [k for k in keys if k.lower() not in {f.name.lower() for f in now.struct.fields}]
        if missing:
            raise TableError(f"merge lacks the columns {missing}")
        fresh, target = materialize(aligned(source, now.struct), "merge-source"), self._frame(table, now, now.stored, "_folder")
        columns = [quoted(k) for k in keys]
        twice = fresh.dropna(subset=list(keys)).groupBy(*columns).count().filter("count > 1").join(target.select(*columns), list(keys), "left_semi")
        if not twice.isEmpty():
            raise TableError("several source rows match one row of the table")
        hit = self._hit(target.join(fresh.select(*columns), list(keys), "left_semi"))
        kept = self._frame(table, now, [f for f in now.stored if f[0] in hit])
        return self._replace(table, now, hit, fresh.unionByName(kept.join(fresh.select(*columns), list(keys), "left_anti")))

    def delete(self, table: str, condition: str) -> Manifest | None:
        """Removes rows where ``condition`` is true; where it is null they stay. Folders without such rows stay as they are."""
        if not self.exists(table):
            return None
        now = self.manifest(table)
        hit = self._hit(self._frame(table, now, now.stored, "_folder").filter(condition))
        if not hit:
            return now
        kept = self._frame(table, now, [f for f in now.stored if f[0] in hit])
        return self._replace(table, now, hit, kept.filter(~F.coalesce(F.expr(condition), F.lit(False))))

    def drop(self, table: str, delete_data: bool = True) -> bool:
        """Forgets the table, and by default removes its files; False where there is none."""
        if not self.exists(table):
            return False
        self.spark.catalog.dropTempView(table)
        return remove_path(self.spark, self.path(table) if delete_data else f"{self.path(table)}/_manifest")


def write_path(df: DataFrame, path: str, mode: str = "append") -> None:
    """Straight to a folder of Parquet; read it with ``mergeSchema`` when columns differ."""
    df.write.mode(mode).parquet(path)
