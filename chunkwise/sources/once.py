"""An append that happens once (S4, S7): a sink for batch and stream, keyed by run and batch.

Tasks write Parquet files whose names no other attempt uses; nothing reads them yet.  Only
when all tasks are done does the driver's commit write one small manifest for (run, batch)
that lists the files of the attempts that counted.  Readers take the files of manifests and
no others, so a reader sees a batch whole or not at all, what failed or lost attempts leave
is never read, and a batch that has a manifest is not added again: the second commit of the
same (run, batch) removes its own files.

One driver writes a (run, batch) at a time, as with any job; several runs may write at once.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from chunkwise.session import ship_package
from chunkwise.sources.tables import with_defaults

FORMAT = "chunkwise_once"
_COMMITS = "_commits"
#: Rows are written out when so many bytes of them are gathered.
ROW_GROUP_BYTES = 64 << 20


def _store(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a local path or a URI (``file:``, ``hdfs:``, ``s3:`` ..)."""
    if ":/" in path:
        scheme, rest = path.split(":", 1)
        if not rest.startswith("//"):       # file:/x, as Spark writes it
            path = f"{scheme}://{rest}"
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), path


@dataclass
class Written(WriterCommitMessage):
    """What a task wrote: its file below the table's folder (None: no rows)."""

    file: str | None
    rows: int


class OnceWriter(DataSourceArrowWriter):
    def __init__(self, path: str, run: str, batch: str):
        self.path, self.run, self.batch = path.rstrip("/"), run, batch

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, root = _store(self.path)
        name = f"data/{self.run}/{self.batch}/part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}.parquet"
        writer, held, size, rows = None, [], 0, 0
        try:
            for batch in iterator:
                if not batch.num_rows:
                    continue
                if writer is None:
                    store.create_dir(f"{root}/data/{self.run}/{self.batch}", recursive=True)
                    writer = pq.ParquetWriter(f"{root}/{name}", batch.schema, filesystem=store)
                held.append(batch)
                size, rows = size + batch.nbytes, rows + batch.num_rows
                if size >= ROW_GROUP_BYTES:
                    writer.write_table(pa.Table.from_batches(held))
                    held, size = [], 0
            if held:
                writer.write_table(pa.Table.from_batches(held))
        except BaseException:
            if writer is not None:
                writer.close()
                store.delete_file(f"{root}/{name}")
                writer = None
            raise
        finally:
            if writer is not None:
                writer.close()
        return Written(name if writer is not None else None, rows)

    def _remove(self, messages: list) -> None:
        store, root = _store(self.path)
        for m in messages:
            if m is not None and m.file:
                store.delete_file(f"{root}/{m.file}")

    def commit(self, messages: list) -> None:
        store, root = _store(self.path)
        manifest = f"{root}/{_COMMITS}/{self.run}-{self.batch}.json"
        if store.get_file_info(manifest).type != pafs.FileType.NotFound:
            self._remove(messages)          # in already: a retry adds nothing
            return
        store.create_dir(f"{root}/{_COMMITS}", recursive=True)
        draft = f"{root}/{_COMMITS}/.{uuid.uuid4().hex}"
        with store.open_output_stream(draft) as out:
            for m in messages:
                if m is not None and m.file:
                    out.write((json.dumps({"file": m.file, "rows": m.rows}) + "\n").encode())
        store.move(draft, manifest)         # whole or not there

    def abort(self, messages: list) -> None:
        self._remove(messages)


class OnceSource(DataSource):
    """``df.write.format("chunkwise_once").option("path", ..).option("run", ..)
    .option("batch", ..).mode("append").save()``"""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema: T.StructType, overwrite: bool) -> OnceWriter:
        if overwrite:
            raise ValueError("this sink appends")
        run, batch = str(self.options["run"]), str(self.options.get("batch", "0"))
        if not all(c.isalnum() or c in "._-" for c in run + batch):
            raise ValueError("run and batch may hold letters, digits, dots, underscores and hyphens")
        return OnceWriter(self.options["path"], run, batch)


def write_once(df: DataFrame, path: str, run: str, batch: str | int = 0) -> None:
    """Append ``df`` to the table at ``path`` unless (run, batch) is in it already.  In
    ``foreachBatch``, the batch id is the batch."""
    spark = df.sparkSession
    ship_package(spark)
    spark.dataSource.register(OnceSource)
    (df.write.format(FORMAT).option("path", path).option("run", run).option("batch", str(batch))
     .mode("append").save())


def read_once(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows of all committed batches (none: an empty frame).  The manifests are listed
    and read by Spark; the driver gets the files' names, as for any table."""
    root = path.rstrip("/")
    try:
        listed = spark.read.schema("file string, rows long").json(f"{root}/{_COMMITS}/*.json")
        files = [f"{root}/{r['file']}" for r in listed.select("file").collect()]
    except AnalysisException as err:
        if err.getCondition() != "PATH_NOT_FOUND":
            raise
        files = []
    return spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)


def append_once(df: DataFrame, path: str, key_cols, run: str, batch: str | int = 0,
                created_at=None, defaults: dict | None = None) -> DataFrame:
    """S4 that a retry can't double: ``append_rows`` under a run and batch; what the table
    then holds is read back."""
    out = with_defaults(df, key_cols, created_at, defaults)
    write_once(out, path, run, batch)
    return read_once(df.sparkSession, path, out.schema)
