"""Parquet files of packed rows, multiplied out by Arrow in the tasks that write them.

A packed row has plain columns and two arrays of structs; it stands for a row for each pair
of their entries. Spark lays the packed rows out, as many as the inputs have; a task then
makes the rows of about ``GROUP_ROWS`` at a time as columns of dictionary codes and writes
them as a row group. No row is ever a row object: what a row costs is its codes.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, DateType, IntegerType, LongType, ShortType, StringType

# Rows of a row group, about, and the packed rows of a batch that is sent to a task.
GROUP_ROWS = 1 << 20
BATCH_PACKS = 500
# Files a task has open; of further values of the partition column one is closed first.
OPEN_FILES = 8
# Types of a partition column whose values have one text.
PARTITION_TYPES = (StringType, ByteType, ShortType, IntegerType, LongType, DateType)
CODECS = {"uncompressed": "none", "none": "none", "snappy": "snappy", "gzip": "gzip", "zstd": "zstd", "brotli": "brotli", "lz4_raw": "lz4"}


@dataclass(frozen=True)
class Product:
    """Packed rows and the columns of the rows they stand for.

    ``columns`` gives each column, in order, as a plain column's name or ``array.field``.
    The entries of ``fast`` follow each other fastest; a packed row without any keeps one
    row for each entry of ``slow`` with NULL fields (``explode_outer``), one without any
    entry of ``slow`` has no rows (``explode``).
    """

    packs: DataFrame
    columns: Mapping[str, str]
    slow: str
    fast: str

    def rows(self) -> DataFrame:
        """The rows, as Spark makes them."""
        plain = [c for c in self.columns.values() if "." not in c]
        each = self.packs.select(*plain, self.slow, F.explode_outer(self.fast).alias("_f")).select(*plain, "_f", F.explode(self.slow).alias("_s"))
        alias = {self.slow: "_s", self.fast: "_f"}
        return each.select(*[F.col(".".join([alias.get(p, p) for p in c.split(".")])).alias(n) for n, c in self.columns.items()])


def _filesystem(path: str):
    """(file system, path in it) as Arrow knows them; None for one it cannot reach."""
    from pyarrow import fs

    if path.startswith("file:"):
        path = "/" + path[len("file:"):].lstrip("/")
    try:
        return (fs.LocalFileSystem(), os.path.abspath(path)) if "://" not in path else fs.FileSystem.from_uri(path)
    except (OSError, ValueError, ImportError):
        return None


def _writer(filesystem, staging: str, names: Sequence[tuple[str, str]], slow: str, fast: str, partition: str | None, group_rows: int, open_files: int, codec: str) -> Callable:
    """The function of a task: batches of packed rows in; (file, folder, rows) of the files it left in ``staging`` out.

    It refers to nothing of this package, which executors need not have.
    """

    def write(batches: Iterator) -> Iterator:
        import uuid

        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        import pyarrow.parquet as pq

        def lengths(table, column):
            return pc.fill_null(pc.list_value_length(table[column]), 0).combine_chunks().to_numpy(zero_copy_only=False).astype(np.int64)

        def starts(n):
            return np.cumsum(n) - n

        def folder(value):
            if value is None or value == "":
                return f"{partition}=__HIVE_DEFAULT_PARTITION__"
            text = str(value)
            return f"{partition}=" + "".join(f"%{ord(c):02X}" if c in "\"#%'*/:=?\\{[]^\x7f" or ord(c) < 32 else c for c in text)

        def taken(column, places, missing):
            column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
            if pa.types.is_string(column.type) or pa.types.is_large_string(column.type):
                column = column.dictionary_encode()
            return column.take(pa.array(places, mask=missing))

        def opened(table):
            """The rows that packed rows stand for."""
            s, f = lengths(table, slow), lengths(table, fast)
            kept = np.maximum(f, 1)
            pack = np.repeat(np.arange(len(s)), s)  # of each entry of slow
            many = kept[pack]
            row_slow = np.repeat(np.arange(len(pack)), many)
            row_pack = np.repeat(pack, many)
            row_fast = np.arange(len(row_slow)) - np.repeat(starts(many) - starts(f)[pack], many)
            missing = (f == 0)[row_pack]
            missing = missing if missing.any() else None
            entries = {a: pc.list_flatten(table[a]).combine_chunks() for a in (slow, fast)}
            out = []
            for _, source in names:
                array, _, field = source.rpartition(".")
                if not array:
                    out.append(taken(table[source], row_pack, None))
                else:
                    fields = pc.struct_field(entries[array], field)
                    out.append(taken(fields, row_slow, None) if array == slow else taken(fields, row_fast, missing))
            return pa.table(out, names=[n for n, _ in names])

        def count(table):
            return lengths(table, slow) * np.maximum(lengths(table, fast), 1)

        class File:
            def __init__(self):
                self.name, self.waiting, self.held, self.rows, self.sink = f"{uuid.uuid4().hex}.parquet", [], 0, 0, None

            def add(self, table, rows):
                self.waiting.append(table)
                self.held += rows
                if self.held >= group_rows:
                    self.flush()

            def flush(self):
                table = pa.concat_tables(self.waiting)
                at = (np.cumsum(count(table)) - 1) // group_rows
                for g in np.unique(at):
                    first, last = np.searchsorted(at, g), np.searchsorted(at, g, side="right")
                    rows = opened(table.slice(first, last - first))
                    if rows.num_rows:
                        if self.sink is None:
                            self.sink = pq.ParquetWriter(f"{staging}/{self.name}", rows.schema, filesystem=filesystem, compression=codec, store_schema=False)
                        self.sink.write_table(rows, row_group_size=rows.num_rows)
                        self.rows += rows.num_rows
                self.waiting, self.held = [], 0

            def close(self):
                if self.waiting:
                    self.flush()
                if self.sink is not None:
                    self.sink.close()
                return self.name, self.rows

        files, done = {}, []

        def close(value):
            name, rows = files.pop(value).close()
            if rows:
                done.append((name, folder(value) if partition else "", rows))

        for batch in batches:
            table = pa.Table.from_batches([batch])
            rows = count(table)
            values = table[partition].to_pylist() if partition else [None] * len(rows)
            places = {}
            for i, value in enumerate(values):
                if rows[i]:
                    places.setdefault(value, []).append(i)
            for value, here in places.items():
                if value not in files and len(files) >= open_files:
                    close(next(iter(files)))
                files.setdefault(value, File()).add(table.take(here), int(rows[here].sum()))
        for value in list(files):
            close(value)
        names_, folders, counts = zip(*done) if done else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(names_, pa.string()), pa.array(folders, pa.string()), pa.array(counts, pa.int64())], names=["file", "folder", "rows"])

    return write


def write_product(product: Product, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite") -> int | None:
    """Write the product's rows as Parquet; return their number, or None, with nothing done, where this cannot write.

    Tasks leave their files in a hidden folder beside ``path``; only those of the attempt
    of a task that Spark accepted are then moved into the table, which appears (or, for
    ``overwrite``, is replaced) by a rename. It cannot write for a file system or codec that
    Arrow does not know, for a partition column of fractions or times or several of them, and
    for no rows at all.
    """
    spark = product.packs.sparkSession
    codec = CODECS.get(spark.conf.get("spark.sql.parquet.compression.codec").lower())
    found = _filesystem(path)
    if found is None or codec is None or len(partition_by) > 1 or mode not in ("overwrite", "append"):
        return None
    filesystem, target = found
    target = target.rstrip("/")
    staging = f"{target.rsplit('/', 1)[0]}/_staging-{uuid.uuid4().hex}"
    partition = partition_by[0] if partition_by else None
    if partition is not None and (product.columns[partition] != partition or not isinstance(product.packs.schema[partition].dataType, PARTITION_TYPES)):
        return None
    names = [(n, c) for n, c in product.columns.items() if n != partition]
    wanted = dict.fromkeys([c.split(".")[0] for c in product.columns.values()])
    task = _writer(filesystem, f"{staging}/_attempts", names, product.slow, product.fast, partition, GROUP_ROWS, OPEN_FILES, codec)
    batch = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(batch)
    filesystem.create_dir(f"{staging}/_attempts")
    try:
        spark.conf.set(batch, BATCH_PACKS)
        files = product.packs.select(*wanted).mapInArrow(task, "file string, folder string, rows long").collect()
        if not files:
            return None
        for i, (name, folder, _) in enumerate(files):
            place = f"{staging}/{folder}".rstrip("/")
            filesystem.create_dir(place)
            filesystem.move(f"{staging}/_attempts/{name}", f"{place}/part-{i:05d}-{name}")
        filesystem.delete_dir(f"{staging}/_attempts")
        _publish(filesystem, staging, target, mode)
    finally:
        spark.conf.set(batch, before)
        if _exists(filesystem, staging):
            filesystem.delete_dir(staging)
    spark.catalog.refreshByPath(path)
    return sum(rows for _, _, rows in files)


def _exists(filesystem, path: str) -> bool:
    from pyarrow import fs

    return filesystem.get_file_info(path).type != fs.FileType.NotFound


def _publish(filesystem, staging: str, target: str, mode: str) -> None:
    """The files of ``staging`` become the table's, or come to those it has."""
    from pyarrow import fs

    if not _exists(filesystem, target) or mode == "overwrite":
        with filesystem.open_output_stream(f"{staging}/_SUCCESS"):
            pass
        if _exists(filesystem, target):
            filesystem.delete_dir(target)
        filesystem.move(staging, target)
        return
    for info in filesystem.get_file_info(fs.FileSelector(staging, recursive=True)):
        if info.type == fs.FileType.File:
            place = f"{target}/{info.path[len(staging):].lstrip('/')}"
            filesystem.create_dir(place.rsplit("/", 1)[0])
            filesystem.move(info.path, place)
