"""The lake's manifest: a versioned list of the batch directories that count.

``_tidewater_manifest/<version>.json`` names, for one version of a lake, every
live batch with its directory, its rows, its content checksum and the schema it
was written with, and the columns of the table. Readers take the newest version
and read exactly the directories it names; writers put a load into a directory
of its own that no version names yet, and publish it by adding the next version.
So a load becomes visible in one step, also one that replaces everything, and a
reader that started before goes on with what it resolved.

Columns have ids. A batch keeps the names and types it was written with; a read
matches them to the table's columns by id, so a renamed column keeps its
history, and casts them to the table's types, so a column may grow wider.
"""

from __future__ import annotations

import json
import threading
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.constants import BATCH_ID
from tidewater.functions.naming import qcol
from tidewater.sources.files import (
    create_text, list_names, read_text, unescape_partition_value,
)

MANIFEST_DIR = "_tidewater_manifest"
DATA_DIR = "_tidewater_data"
#: Metadata key of a column's id; Spark's Parquet writer stores it as the field id.
FIELD_ID = "parquet.field.id"
#: Versions whose directories stay after a newer one is published.
KEPT_VERSIONS = 2
_COMMITS = threading.Lock()


@dataclass(frozen=True)
class Batch:
    """``dir`` is relative to the lake; ``schema`` an index into the manifest's;
    ``index`` names the digests and filters kept beside it (``batch_index``)."""

    dir: str
    schema: int
    rows: int | None = None
    content: str | None = None
    index: Mapping[str, dict] = field(default_factory=dict)


@dataclass(frozen=True)
class Manifest:
    version: int
    table: T.StructType
    schemas: tuple[T.StructType, ...] = ()
    batches: Mapping[str, Batch] = field(default_factory=dict)

    def dump(self) -> str:
        return json.dumps({
            "version": self.version, "table": self.table.jsonValue(),
            "schemas": [s.jsonValue() for s in self.schemas],
            "batches": {k: vars(b) for k, b in self.batches.items()}}, indent=1)

    @staticmethod
    def parse(text: str) -> Manifest:
        doc = json.loads(text)
        return Manifest(doc["version"], T.StructType.fromJson(doc["table"]),
                        tuple(map(T.StructType.fromJson, doc["schemas"])),
                        {k: Batch(**b) for k, b in doc["batches"].items()})


def versions(spark: SparkSession, path: str) -> list[int]:
    names = list_names(spark, f"{path.rstrip('/')}/{MANIFEST_DIR}") or []
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def read_manifest(spark: SparkSession, path: str, version: int | None = None) -> Manifest | None:
    """The newest version, or the given one; None for a lake without a manifest."""
    if version is None:
        known = versions(spark, path)
        if not known:
            return None
        version = known[-1]
    text = read_text(spark, f"{path.rstrip('/')}/{MANIFEST_DIR}/{version:020d}.json")
    return None if text is None else Manifest.parse(text)


def commit(spark: SparkSession, path: str,
           change: Callable[[Manifest | None], Manifest], tries: int = 20) -> Manifest:
    """Publish ``change(newest version)`` as the next version.

    If another writer was faster, the change is applied to its version instead, so
    loads of different batches do not undo each other.
    """
    root = path.rstrip("/")
    with _COMMITS:
        for _ in range(tries):
            now = read_manifest(spark, path)
            after = replace(change(now), version=(now.version if now else 0) + 1)
            if create_text(spark, f"{root}/{MANIFEST_DIR}/{after.version:020d}.json",
                           after.dump()):
                return after
    raise RuntimeError(f"{path}: other writers kept publishing first")


def adopted(spark: SparkSession, path: str, schema: T.StructType | None) -> Manifest | None:
    """Version 0 of a lake landed as plain batch directories; None if it has none."""
    names = [n for n in list_names(spark, path) or [] if n.startswith(f"{BATCH_ID}=")]
    if not names or schema is None:
        return None
    table = with_ids(schema)
    return Manifest(0, table, (table,), {
        unescape_partition_value(spark, n[len(BATCH_ID) + 1:]): Batch(n, 0) for n in names})


# -- columns ---------------------------------------------------------------

def nullable(kind: T.DataType) -> T.DataType:
    """A type as files are read back: with NULLs allowed everywhere."""
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(nullable(kind.elementType), True)
    if isinstance(kind, T.MapType):
        return T.MapType(nullable(kind.keyType), nullable(kind.valueType), True)
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, nullable(f.dataType), True)
                             for f in kind.fields])
    return kind


def field_id(f: T.StructField) -> int | None:
    return (f.metadata or {}).get(FIELD_ID)


def with_ids(schema: T.StructType, table: T.StructType | None = None) -> T.StructType:
    """``schema`` with the ids of the table's columns of the same name, new ones for others."""
    known = {f.name: field_id(f) for f in table.fields} if table else {}
    # columns are never taken out of a table, so no id is used twice
    last = max([0, *[i or 0 for i in known.values()]])
    out = []
    for f in schema.fields:
        if known.get(f.name) is None:
            last += 1
            known[f.name] = last
        out.append(T.StructField(f.name, nullable(f.dataType), True, {FIELD_ID: known[f.name]}))
    return T.StructType(out)


_WHOLE = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}


def wider(old: T.DataType, new: T.DataType) -> bool:
    """Whether every value of ``old`` is a value of ``new``, so a column may change so."""
    if old == new:
        return True
    if type(old) in _WHOLE and type(new) in _WHOLE:
        return _WHOLE[type(old)] < _WHOLE[type(new)]
    if type(old) in _WHOLE and isinstance(new, T.DecimalType):
        return new.precision - new.scale >= _WHOLE[type(old)]
    if isinstance(new, T.DoubleType):
        return isinstance(old, (T.FloatType, T.ByteType, T.ShortType, T.IntegerType))
    if isinstance(new, T.FloatType):
        return isinstance(old, (T.ByteType, T.ShortType))
    if isinstance(old, T.DecimalType) and isinstance(new, T.DecimalType):
        return (new.scale >= old.scale
                and new.precision - new.scale >= old.precision - old.scale)
    if isinstance(old, T.DateType):
        return isinstance(new, T.TimestampNTZType)
    if isinstance(old, T.ArrayType) and isinstance(new, T.ArrayType):
        return wider(old.elementType, new.elementType)
    if isinstance(old, T.StructType) and isinstance(new, T.StructType):
        return (old.names == new.names
                and all(wider(a.dataType, b.dataType)
                        for a, b in zip(old.fields, new.fields, strict=True)))
    return False


def evolved(table: T.StructType | None, batch: T.StructType) -> T.StructType:
    """The table's columns after a batch with the columns ``batch`` (with ids): new
    columns are added, a wider type is taken over, any other change raises."""
    if table is None:
        return batch
    kinds = {f.name: f.dataType for f in batch.fields}
    changed = [f"{f.name}: {f.dataType.simpleString()} to {kinds[f.name].simpleString()}"
               for f in table.fields
               if f.name in kinds and not wider(f.dataType, kinds[f.name])]
    if changed:
        raise ValueError("column type changed: " + "; ".join(changed))
    known = set(table.names)
    return T.StructType(
        [T.StructField(f.name, kinds.get(f.name, f.dataType), True, f.metadata)
         for f in table.fields] + [f for f in batch.fields if f.name not in known])


def rename_column(spark: SparkSession, path: str, old: str, new: str) -> Manifest:
    """Give a column of the lake another name from the next version on. Earlier
    batches are read under it too; no file is touched."""
    def change(now: Manifest | None) -> Manifest:
        if now is None or old not in now.table.names:
            raise ValueError(f"{path} has no column {old!r}")
        if new.lower() in {n.lower() for n in now.table.names if n != old}:
            raise ValueError(f"{path} already has a column {new!r}")
        return replace(now, table=T.StructType(
            [T.StructField(new, f.dataType, True, f.metadata) if f.name == old else f
             for f in now.table.fields]))
    return commit(spark, path, change)


def _as(written: T.StructField | None, f: T.StructField) -> Column:
    """A written column as the table's column ``f``; NULL if there is none."""
    value = F.lit(None) if written is None else qcol(written.name)
    if written is None or written.dataType != f.dataType:
        value = value.cast(f.dataType)
    return value.alias(f.name)


def read_batches(spark: SparkSession, path: str, fmt: str, found: Manifest,
                 batches: Mapping[str, Batch], options: Mapping[str, str]) -> DataFrame:
    """The given batches with the table's columns.

    One scan per schema that batches were written with (and per place, for batches
    adopted from a plain lake), not one per batch.
    """
    root = path.rstrip("/")
    table = found.table
    groups: dict[tuple[int, bool], list[tuple[str, Batch]]] = {}
    for name, b in batches.items():
        groups.setdefault((b.schema, b.dir.startswith(DATA_DIR)), []).append((name, b))
    out = None
    for (index, inside), held in sorted(groups.items()):
        written = found.schemas[index]
        by_id = {field_id(f): f for f in written.fields}
        # by name, as the files were written: adopted ones have no ids
        written = T.StructType([T.StructField(f.name, f.dataType, True) for f in written.fields])
        reader = spark.read.format(fmt).options(**options)
        if len(held) == 1:
            df = (reader.schema(T.StructType([f for f in written.fields if f.name != BATCH_ID]))
                  .load(f"{root}/{held[0][1].dir}").withColumn(BATCH_ID, F.lit(held[0][0])))
        else:
            df = (reader.option("basePath", f"{root}/{DATA_DIR}" if inside else root)
                  .schema(written).load([f"{root}/{b.dir}" for _, b in held]))
        part = df.select(*[_as(by_id.get(field_id(f)), f) for f in table.fields])
        out = part if out is None else out.unionByName(part)
    return spark.createDataFrame([], table) if out is None else out
