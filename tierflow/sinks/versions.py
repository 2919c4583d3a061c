"""Tables that are published a version at a time: evolving, replacing and partial writes.

A table is a folder: ``data/<id>`` holds what single writes left, ``commits`` a row for
each version that names the data folders it consists of. A write first writes its data to
a new folder and only then appends its commit row, a single file that appears by a
rename. Readers take the last commit: a write that dies in between leaves the version
before it as it was, and a folder no commit names, which ``vacuum`` removes.

Commits also keep *marks*, named strings such as the high-water mark of a refresh or the
last batch of a stream; data and mark become visible together. One writer at a time.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow.sinks.products import Product
from tierflow.sinks.tables import write_table
from tierflow.sources.ingest import evolve_union

COMMITS = (
    "version long, schema string, partition_by array<string>, rows long, marks map<string,string>, "
    "parts array<struct<path:string,schema:string,hidden:array<string>,held:array<string>>>"
)
# Whole-number types by width, and the digits of each.
_WHOLE = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}


class SchemaChange(ValueError):
    """A write whose columns do not fit the table's."""


def merged_type(old: T.DataType, new: T.DataType, where: str = "") -> T.DataType:
    """The narrowest type that holds all values of both, struct fields by name; SchemaChange if there is none."""
    if isinstance(old, T.NullType) or isinstance(new, T.NullType):
        return new if isinstance(old, T.NullType) else old
    if isinstance(old, T.StructType) and isinstance(new, T.StructType):
        fields = {f.name: f.dataType for f in old.fields}
        for f in new.fields:
            fields[f.name] = merged_type(fields[f.name], f.dataType, f"{where}.{f.name}") if f.name in fields else f.dataType
        return T.StructType([T.StructField(n, t, True) for n, t in fields.items()])
    if isinstance(old, T.ArrayType) and isinstance(new, T.ArrayType):
        return T.ArrayType(merged_type(old.elementType, new.elementType, f"{where}[]"))
    if isinstance(old, T.MapType) and isinstance(new, T.MapType) and old.keyType == new.keyType:
        return T.MapType(old.keyType, merged_type(old.valueType, new.valueType, f"{where}{{}}"))
    if old == new:
        return old
    kinds = (type(old), type(new))
    if all(k in _WHOLE for k in kinds):
        return max((old, new), key=lambda t: _WHOLE[type(t)])
    if {T.FloatType, T.DoubleType} == set(kinds):
        return T.DoubleType()
    small = {T.ByteType, T.ShortType, T.IntegerType}
    if T.DoubleType in kinds and (small & set(kinds)):
        return T.DoubleType()  # a double holds 32-bit numbers exactly, not 64-bit ones
    if T.DecimalType in kinds and all(k in _WHOLE or k is T.DecimalType for k in kinds):
        digits = [(t.precision - t.scale, t.scale) if isinstance(t, T.DecimalType) else (_WHOLE[type(t)], 0) for t in (old, new)]
        whole, scale = max(d[0] for d in digits), max(d[1] for d in digits)
        if whole + scale <= 38:
            return T.DecimalType(whole + scale, scale)
    if set(kinds) == {T.DateType, T.TimestampType}:
        return T.TimestampType()
    raise SchemaChange(f"{where.lstrip('.')}: {old.simpleString()} and {new.simpleString()} have no common type")


def _conformed(value: Column, old: T.DataType, new: T.DataType) -> Column:
    """A value of the old type as the new one, struct fields by name, absent ones NULL."""
    if old == new:
        return value
    if isinstance(old, T.StructType) and isinstance(new, T.StructType):
        have = {f.name: f.dataType for f in old.fields}
        parts = [(_conformed(value[f.name], have[f.name], f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name) for f in new.fields]
        return F.when(value.isNotNull(), F.struct(*parts))
    if isinstance(old, T.ArrayType) and isinstance(new, T.ArrayType):
        return F.transform(value, lambda x: _conformed(x, old.elementType, new.elementType))
    if isinstance(old, T.MapType) and isinstance(new, T.MapType):
        return F.transform_values(value, lambda _, x: _conformed(x, old.valueType, new.valueType))
    return value.cast(new)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """df with the columns of a schema that ``merged_type`` made of df's."""
    have = {f.name: f.dataType for f in df.schema.fields}
    cols = [_conformed(F.col(f"`{f.name}`"), have[f.name], f.dataType) if f.name in have else F.lit(None).cast(f.dataType) for f in schema.fields]
    return df.select(*[c.alias(f.name) for c, f in zip(cols, schema.fields, strict=True)])


@dataclass
class Version:
    version: int
    schema: T.StructType
    partition_by: list[str]
    rows: int
    marks: dict[str, str] = field(default_factory=dict)
    parts: list[dict] = field(default_factory=list)


class VersionedTable:
    """A table of published versions at ``root``, in storage that all executors share."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def current(self) -> Version | None:
        """The last published version (one row to the driver)."""
        try:
            commits = self.spark.read.schema(COMMITS).json(f"{self.root}/commits")
        except AnalysisException as absent:
            if absent.getCondition() == "PATH_NOT_FOUND":
                return None
            raise
        last = commits.orderBy(F.desc("version")).limit(2).collect()
        if not last:
            return None
        if len(last) == 2 and last[0].version == last[1].version:
            raise RuntimeError(f"{self.root}: version {last[0].version} was published twice")
        row = last[0].asDict(recursive=True)
        schema = T.StructType.fromJson(json.loads(row["schema"]))
        return Version(row["version"], schema, row["partition_by"] or [], row["rows"], row["marks"] or {}, row["parts"])

    def marks(self) -> dict[str, str]:
        now = self.current()
        return now.marks if now else {}

    def read(self) -> DataFrame:
        """The rows of the last version; partition values that later writes replaced are pruned."""
        now = self.current()
        if now is None:
            raise FileNotFoundError(f"{self.root} has no published version")
        if not now.parts:
            return self.spark.createDataFrame([], now.schema)
        return evolve_union([self._part(p, now) for p in now.parts])

    def _part(self, part: dict, now: Version) -> DataFrame:
        schema = T.StructType.fromJson(json.loads(part["schema"]))
        df = self.spark.read.schema(schema).parquet(part["path"])
        if part["hidden"]:
            value = F.col(now.partition_by[0])
            gone = F.coalesce(value.cast("string").isin([v for v in part["hidden"] if v is not None]), F.lit(False))
            if None in part["hidden"]:
                gone = gone | value.isNull()
            df = df.filter(~gone)
        return conform(df, now.schema)

    def _write(
        self, df: DataFrame, partition_by: Sequence[str], rebalance: bool, unsorted: bool = False,
        product: Product | None = None, rest: DataFrame | None = None,
    ) -> tuple[dict, int]:
        path = f"{self.root}/data/{uuid.uuid4().hex}"
        if product is not None and _plain(product.rows().schema) != _plain(df.schema):
            product = None  # the table's columns are wider
        rest = None if rest is None else conform(rest, df.schema)
        rows = write_table(df, path, partition_by=partition_by, rebalance=rebalance, unsorted=unsorted, product=product, rest=rest)
        return {"path": path, "schema": json.dumps(df.schema.jsonValue()), "hidden": [], "held": None}, rows

    def _commit(self, now: Version) -> Version:
        row = (now.version, json.dumps(now.schema.jsonValue()), now.partition_by, now.rows, now.marks, [(p["path"], p["schema"], p["hidden"], p["held"]) for p in now.parts])
        self.spark.createDataFrame([row], COMMITS).coalesce(1).write.mode("append").json(f"{self.root}/commits")
        return now

    def publish(
        self,
        df: DataFrame,
        *,
        mode: str = "overwrite",
        schema: str = "same",
        partition_by: Sequence[str] = (),
        rebalance: bool = False,
        unsorted: bool = False,
        marks: Mapping[str, str] | None = None,
        product: Product | None = None,
    ) -> Version:
        """SNK-1/SNK-2: write df as the next version, all of it (``overwrite``) or its new rows (``append``).

        ``schema`` says what may happen to the table's columns: ``same`` nothing (their
        order apart), ``merge`` columns may come, stay away (NULL from then on) and widen,
        ``replace`` df's columns are the table's (overwrite only). Marks are added to
        those the table has. ``rebalance``, ``unsorted`` and ``product``: see ``write_table``.
        """
        if mode not in ("overwrite", "append") or schema not in ("same", "merge", "replace"):
            raise ValueError(f"unknown mode {mode} or schema {schema}")
        before = self.current()
        target = df.schema
        if before is not None and schema != "replace":
            target = merged_type(before.schema, df.schema)
            if schema == "same" and not (_plain(target) == _plain(before.schema) and set(df.columns) == set(before.schema.names)):
                raise SchemaChange(f"{df.schema.simpleString()} is not the table's {before.schema.simpleString()}")
        elif before is not None and mode == "append":
            raise ValueError("rows can only be appended to the same or a merged schema")
        if before is not None and mode == "append" and list(partition_by) != before.partition_by:
            raise ValueError(f"the table is partitioned by {before.partition_by}")
        part, rows = self._write(conform(df, target), partition_by, rebalance, unsorted, product)
        kept = before.parts if before is not None and mode == "append" else []
        total = rows + (before.rows if kept else 0)
        version = before.version + 1 if before is not None else 1
        return self._commit(Version(version, target, list(partition_by), total, {**(before.marks if before else {}), **(marks or {})}, [*kept, part]))

    def replace_partitions(
        self, df: DataFrame, values: Sequence[str | None], *, rows_gone: int, unsorted: bool = False, marks: Mapping[str, str] | None = None,
        product: Product | None = None, rest: DataFrame | None = None,
    ) -> Version:
        """The next version: rows of these values of the (first) partition column go, df's come.

        ``values`` are as strings, None for NULL, and df has rows of these values only;
        ``rows_gone`` is how many rows they had, ``product`` and ``rest`` say what df is
        made of (see ``write_table``). The schemas are merged. Nothing that a
        reader may hold is touched; parts of which nothing is left are named no more.
        """
        before = self.current()
        if before is None or not before.partition_by:
            raise ValueError(f"{self.root} has no partitions to replace")
        target = merged_type(before.schema, df.schema)
        part, rows = self._write(conform(df, target), before.partition_by, False, unsorted, product, rest)
        part["held"] = list(values)
        parts = [{**p, "hidden": sorted({*p["hidden"], *values}, key=lambda v: (v is None, v or ""))} for p in before.parts]
        parts = [p for p in parts if p["held"] is None or not set(p["held"]) <= set(p["hidden"])]
        return self._commit(Version(before.version + 1, target, before.partition_by, before.rows - rows_gone + rows, {**before.marks, **(marks or {})}, [*parts, part]))

    def compact(self) -> Version:
        """The next version: the same rows in one part."""
        now = self.current()
        if now is None:
            raise FileNotFoundError(f"{self.root} has no published version")
        return self.publish(self.read(), partition_by=now.partition_by, rebalance=bool(now.partition_by))

    def mark(self, marks: Mapping[str, str]) -> Version:
        """The next version: the same rows, marks added."""
        now = self.current()
        if now is None:
            raise FileNotFoundError(f"{self.root} has no published version")
        now.version, now.marks = now.version + 1, {**now.marks, **marks}
        return self._commit(now)

    def vacuum(self) -> int:
        """Delete data folders that the last version does not name (no reader of an older one may run); how many."""
        now = self.current()
        used = {p["path"].rsplit("/", 1)[-1] for p in now.parts} if now else set()
        hadoop = self.spark.sparkContext._jvm.org.apache.hadoop.fs
        data = hadoop.Path(f"{self.root}/data")
        fs = data.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        gone = [s.getPath() for s in fs.listStatus(data) if s.getPath().getName() not in used] if fs.exists(data) else []
        for path in gone:
            fs.delete(path, True)
        return len(gone)


def _plain(schema: T.StructType) -> dict[str, str]:
    """Column types by name, nullability aside."""
    return {f.name: f.dataType.simpleString() for f in schema.fields}
