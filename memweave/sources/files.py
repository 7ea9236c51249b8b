"""File scan, inventory and sink."""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BINARY_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"
#: The UTF-8 mark at the start of a file, which Spark's line reader leaves out.
BYTE_MARK = b"\xef\xbb\xbf"


def expand(path: str) -> str:
    """Environment variables in a path are expanded (on the driver)."""
    return os.path.expandvars(path)


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its file system, as the file listing names it."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(expand(path))
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(p).toString()


def scan_files(spark: SparkSession, path: str, *, glob: str | None = None, recursive: bool = True) -> DataFrame:
    """(path, modificationTime, length, content) per file; unreadable paths fail the job."""
    reader = spark.read.format("binaryFile")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    return reader.load(expand(path))


def _file_digests(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batch function of ``mapInArrow``: the lines of whole files, file after file, to a SHA-256 per file."""
    file, size, read, between, hashes = None, 0, 0, b"", ()

    def digest() -> pa.RecordBatch:
        # What the lines do not tell: a newline at the end (1 byte), a mark at the start (3), or both.
        left = size - read
        if left not in (0, 1, 3, 4):
            raise ValueError(f"{file}: {read} bytes read, {size} listed")
        found = hashes[left >= 3]
        found.update(b"\n" * (left % 3))
        return pa.RecordBatch.from_pydict({"_file": [file], "sha256": [found.hexdigest()]})

    for batch in batches:
        start, runs = 0, pc.run_end_encode(batch.column("_file"))
        for name, end in zip(runs.values.to_pylist(), runs.run_ends.to_pylist()):
            if name != file:
                if file is not None:
                    yield digest()
                file, size, read, between = name, batch.column("_size")[start].as_py(), 0, b""
                hashes = hashlib.sha256(), hashlib.sha256(BYTE_MARK)
            data = between + b"\n".join(batch.column("_line").slice(start, end - start).to_pylist())
            read, between = read + len(data), b"\n"
            for h in hashes:
                h.update(data)
            start = end
    if file is not None:
        yield digest()


def with_sha256(files: DataFrame, path: str, *, suffix: str, recursive: bool = True) -> DataFrame:
    """The files ``scan_files`` found under ``path``, their names ending in ``suffix``, with ``sha256`` in place of ``content``.

    A file never is one row: one task reads it from start to end as a text of lines, so what has to fit in
    memory is an Arrow batch and the longest stretch without a newline byte. ``PassthroughCodec`` changes no
    byte; as a codec that cannot split, it keeps a file whole, and no other codec unpacks it. The bytes read are
    held against the length of the file.
    """
    spark = files.sparkSession
    codec = spark.sparkContext._jvm.org.apache.hadoop.io.compress.PassthroughCodec
    reader = spark.read.format("text").option("pathGlobFilter", f"*{suffix}").option("lineSep", "\n")
    reader = reader.option("io.compression.codecs", codec.CLASSNAME).option(codec.OPT_EXTENSION, suffix)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    lines = reader.load(expand(path)).select(F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_size").alias("_size"),
                                             F.col("value").cast("binary").alias("_line"))
    digests = lines.mapInArrow(_file_digests, "_file string, sha256 string")
    # Of a file that is a mark and no more the reader makes no line.
    no_lines = F.when(F.col("length") == len(BYTE_MARK), F.lit(hashlib.sha256(BYTE_MARK).hexdigest()))
    return (files.withColumn("_file", F.col("_metadata.file_path")).drop("content").join(digests, "_file", "left")
            .withColumn("sha256", F.coalesce("sha256", no_lines, F.raise_error(F.concat(F.lit("not read: "), "path"))))
            .drop("_file"))


def file_inventory(spark: SparkSession, requested: DataFrame, root: str, *, path_col: str = "path",
                   glob: str | None = None) -> DataFrame:
    """Existence and size of many requested paths in one job.

    Only file metadata is read: the ``content`` column is pruned, so no file
    body is opened. ``requested[path_col]`` holds paths relative to ``root``.
    """
    listing = scan_files(spark, root, glob=glob).select(F.col("path").alias("_abs"), "length", "modificationTime")
    base = qualified(spark, root).rstrip("/") + "/"
    req = requested.withColumn("_abs", F.concat(F.lit(base), F.col(path_col)))
    return (req.join(listing, "_abs", "left")
            .select(path_col, F.col("length").isNotNull().alias("exists"), "length", "modificationTime"))


def write_table(df: DataFrame, path: str, *, mode: str = "errorifexists", fmt: str = "parquet",
                partition_by: list[str] | None = None) -> None:
    """S3: create (``errorifexists``) or rewrite (``overwrite``) a file table."""
    if mode not in ("errorifexists", "overwrite", "append"):
        raise ValueError("mode must be errorifexists, overwrite or append")
    w = df.write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(expand(path))


def write_text_files(df: DataFrame, path: str, *, text_col: str = "text", mode: str = "errorifexists") -> None:
    """S3 for text: one line per row under ``path``."""
    df.select(F.col(text_col).alias("value")).write.mode(mode).text(expand(path))
