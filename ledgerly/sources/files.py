"""Receipt extract files for file and stream sources.

``write_receipt_files`` lays raw receipts out as pipe-delimited files named
``<label>_<stamp>-<task>_recibos.csv`` in one folder, the layout the file-name
provenance column reads. Spark's own writers take no file-name pattern, so a
Python data source names the files: every task writes its own, under their
final names, and the driver handles no file.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from urllib.parse import quote

from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

SUFFIX = "_recibos.csv"


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jvm


def _shared_folder(path: str):
    """File system and folder of a path or URI, in a task."""
    from pyarrow.fs import FileSystem, LocalFileSystem
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    if path.startswith("/"):
        return LocalFileSystem(), path
    return FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


class LabelledFiles(DataSource):
    """Write-only source: rows ``(label, line)``, sorted by label within each
    task, become one text file per task and label. Options: ``folder``,
    ``stamp`` (part of every name) and ``header`` (first line of every file)."""

    @classmethod
    def name(cls) -> str:
        return "labelled_files"

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return _LabelledFilesWriter(self.options["folder"], self.options["stamp"], self.options["header"])


class _LabelledFilesWriter(DataSourceArrowWriter):
    def __init__(self, folder: str, stamp: str, header: str):
        self.folder, self.stamp, self.header = folder, stamp, header

    def write(self, iterator: Iterator) -> WriterCommitMessage:
        """A file is written under a hidden name and renamed when it is whole, so
        no reader sees half a file. A repeated task writes the same names again."""
        from pyarrow.compute import run_end_encode
        task = TaskContext.get()
        fs, folder = _shared_folder(self.folder)
        label = out = None

        def finish() -> None:
            if out is not None:
                out.close()
                fs.move(hidden, f"{folder}/{quote(label, safe=' ')}_{self.stamp}-{task.partitionId():05d}{SUFFIX}")

        for batch in iterator:
            runs = run_end_encode(batch.column(0))
            start = 0
            for here, end in zip(runs.values.to_pylist(), runs.run_ends.to_pylist(), strict=True):
                if here != label:
                    finish()
                    label, hidden = here, f"{folder}/_{self.stamp}-{task.taskAttemptId()}"
                    out = fs.open_output_stream(hidden)
                    out.write(f"{self.header}\n".encode())
                lines = batch.column(1).slice(start, end - start).to_pylist()
                out.write("\n".join([*lines, ""]).encode())
                start = end
        finish()
        return WriterCommitMessage()

    def abort(self, messages) -> None:
        """A failed extract leaves none of its files."""
        from pyarrow.fs import FileSelector
        fs, folder = _shared_folder(self.folder)
        for f in fs.get_file_info(FileSelector(folder, allow_not_found=True)):
            if f"_{self.stamp}-" in f.base_name:
                fs.delete_file(f.path)


def write_receipt_files(spark: SparkSession, raw: DataFrame, label: Column, target: str) -> list[str]:
    """Write ``raw`` into ``target``, one file per task and ``label``; returns
    the file names. A folder can take several extracts. A null label is written
    as ``none``."""
    stamp = uuid.uuid4().hex[:8]
    fs, jvm = _fs(spark, target)
    folder = fs.makeQualified(jvm.org.apache.hadoop.fs.Path(target))
    fs.mkdirs(folder)
    line = F.to_csv(F.struct(*[F.col(f"`{c}`") for c in raw.columns]), {"sep": "|"})
    rows = raw.select(F.coalesce(label.cast("string"), F.lit("none")).alias("label"), line.alias("line"))
    spark.dataSource.register(LabelledFiles)
    (rows.sortWithinPartitions("label").write.format(LabelledFiles.name()).mode("append")
         .options(folder=folder.toString(), stamp=stamp, header="|".join(raw.columns)).save())
    made = fs.globStatus(jvm.org.apache.hadoop.fs.Path(folder, f"*_{stamp}-*{SUFFIX}"))
    return sorted(st.getPath().getName() for st in made)
