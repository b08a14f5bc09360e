"""A data source that writes JSON element texts as files of one JSON array each.

A task streams its elements, with a separator between them, into a hidden file
and moves it to its final name when it is whole; no task holds more than a
batch, whose texts are written from where they lie. The commit message names the files. When all tasks are done, the driver
removes whatever else lies in the folder: files of attempts that were lost, and,
on overwriting, those of earlier jobs.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from threadscope.session import ship_package

#: Bytes that are gathered before they are written.
BUFFER = 1 << 20


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a Hadoop-style URI; a path without a scheme is local."""
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return pafs.FileSystem.from_uri(uri) if "://" in uri else (pafs.LocalFileSystem(), uri)


@dataclass
class Written(WriterCommitMessage):
    """Files of a task, below the folder that is written."""
    files: list[str] = field(default_factory=list)


class ArrayWriter(DataSourceArrowWriter):
    """Rows (folder, j): the text ``j`` is an element of a file in ``folder``
    (null: the folder that is written itself). Rows come sorted by folder."""

    def __init__(self, path: str, overwrite: bool):
        self.path, self.overwrite, self.job = path, overwrite, uuid.uuid4().hex[:12]

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        from pyspark import TaskContext
        fs, root = file_system(self.path)
        task = TaskContext.get()
        name = f"part-{task.partitionId():05d}-{self.job}-{task.taskAttemptId()}.json"
        done, folder, out, hidden = Written(), None, None, None

        def close() -> None:
            out.write(b"\n]")
            out.close()
            fs.move(hidden, os.path.join(root, folder, name))
            done.files.append(os.path.join(folder, name))

        for batch in iterator:
            folders, texts = batch.column(0).to_pylist(), batch.column(1)
            low = 0
            for i in range(1, batch.num_rows + 1):
                if i < batch.num_rows and folders[i] == folders[low]:
                    continue
                here = folders[low] or ""
                if out is None or here != folder:
                    if out is not None:
                        close()
                    folder = here
                    fs.create_dir(os.path.join(root, folder), recursive=True)
                    hidden = os.path.join(root, folder, "." + name)
                    out = fs.open_output_stream(hidden, buffer_size=BUFFER)
                    out.write(b"[\n")
                else:
                    out.write(b",\n")
                for n in range(low, i):
                    if n > low:
                        out.write(b",\n")
                    out.write(texts[n].as_buffer())
                low = i
        if out is not None:
            close()
        return done

    def _clear(self, kept: set[str], mine_only: bool) -> None:
        fs, root = file_system(self.path)
        for info in fs.get_file_info(pafs.FileSelector(root, allow_not_found=True, recursive=True)):
            place = os.path.relpath(info.path, root)
            if info.type == pafs.FileType.File and place not in kept and (self.job in info.base_name or not mine_only):
                fs.delete_file(info.path)

    def commit(self, messages: list[Written | None]) -> None:
        self._clear({f for m in messages if m for f in m.files}, mine_only=not self.overwrite)
        fs, root = file_system(self.path)
        fs.create_dir(root, recursive=True)
        fs.open_output_stream(os.path.join(root, "_SUCCESS")).close()

    def abort(self, messages: list[Written | None]) -> None:
        self._clear(set(), mine_only=True)


class JsonArrays(DataSource):
    """``df.write.format("json_arrays")`` for rows (folder, j)."""

    @classmethod
    def name(cls) -> str:
        return "json_arrays"

    def schema(self) -> str:
        return "folder string, j string"

    def writer(self, schema, overwrite: bool) -> ArrayWriter:
        return ArrayWriter(self.options["path"], overwrite)


def write_arrays(rows: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write rows (folder, j), sorted by folder within a partition, below ``path``."""
    spark = rows.sparkSession
    ship_package(spark)
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    whole = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(target).toString()
    spark.dataSource.register(JsonArrays)
    rows.select("folder", "j").write.format("json_arrays").mode(mode).option("path", whole).save()

