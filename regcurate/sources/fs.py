"""Small metadata access (existence, rename, sidecars) through Hadoop's file
systems, with the session's own credentials, and file heads read by the
executors through ``pyarrow.fs`` (local paths, ``file:``, ``hdfs://``,
``s3a://``)."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _hadoop(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def exists(spark: SparkSession, path: str) -> bool:
    fs, p, _ = _hadoop(spark, path)
    return fs.exists(p)


def children(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """(name, bytes) of the entries of a folder."""
    fs, p, _ = _hadoop(spark, path)
    return [(s.getPath().getName(), s.getLen()) for s in fs.listStatus(p)]


def folders(spark: SparkSession, path: str, glob: str) -> list[str]:
    """Paths of the folders in a folder whose name matches."""
    fs, p, jvm = _hadoop(spark, path)
    named = jvm.org.apache.hadoop.fs.GlobFilter(glob)
    return sorted(s.getPath().toString() for s in fs.listStatus(p)
                  if s.isDirectory() and named.accept(s.getPath()))


def size(spark: SparkSession, path: str) -> int:
    """Bytes of a file, or of the files below a folder."""
    fs, p, _ = _hadoop(spark, path)
    return fs.getContentSummary(p).getLength()


def move(spark: SparkSession, path: str, to: str) -> None:
    fs, p, jvm = _hadoop(spark, path)
    target = jvm.org.apache.hadoop.fs.Path(to)
    fs.mkdirs(target.getParent())
    if not fs.rename(p, target):
        raise OSError(f"cannot move {path} to {to}")


def move_new(spark: SparkSession, path: str, to: str) -> None:
    """Rename a file to a name that must be free (FileExistsError otherwise): one
    atomic step on a file system with atomic renames."""
    fs, p, jvm = _hadoop(spark, path)
    target = jvm.org.apache.hadoop.fs.Path(to)
    if fs.exists(target) or not fs.rename(p, target):
        raise FileExistsError(to)


def delete(spark: SparkSession, path: str) -> None:
    """Delete a file or folder; one that is gone already is no error."""
    fs, p, _ = _hadoop(spark, path)
    fs.delete(p, True)


def delete_on_exit(spark: SparkSession, path: str) -> None:
    """Have a file or folder deleted when the application ends."""
    fs, p, _ = _hadoop(spark, path)
    fs.deleteOnExit(p)


def listing(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """(name, bytes, modified) of the entries of a folder."""
    fs, p, _ = _hadoop(spark, path)
    return [(s.getPath().getName(), s.getLen(), s.getModificationTime())
            for s in fs.listStatus(p)]


def set_modified(spark: SparkSession, path: str, millis: int) -> None:
    fs, p, _ = _hadoop(spark, path)
    fs.setTimes(p, millis, -1)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, p, _ = _hadoop(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str:
    fs, p, jvm = _hadoop(spark, path)
    stream = fs.open(p)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def resolve(path: str):
    """pyarrow ``(FileSystem, path)`` for a Spark-style URI or a local path."""
    from pyarrow import fs

    if path.startswith("file:") and not path.startswith("file:///"):
        path = "file:///" + path[len("file:"):].lstrip("/")
    elif path.startswith(("s3a://", "s3n://")):
        path = "s3://" + path[6:]
    elif "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(path)


def read_first_line(path: str, chunk: int = 1 << 16) -> bytes:
    """Bytes up to the first newline, however long the line is."""
    filesystem, p = resolve(path)
    parts = []
    with filesystem.open_input_stream(p) as stream:
        while data := stream.read(chunk):
            head, newline, _ = data.partition(b"\n")
            parts.append(head)
            if newline:
                break
    return b"".join(parts)


def read_parquet_schema(path: str):
    """Arrow schema of one Parquet file, from its footer."""
    import pyarrow.parquet as pq

    filesystem, p = resolve(path)
    return pq.read_schema(p, filesystem=filesystem)
