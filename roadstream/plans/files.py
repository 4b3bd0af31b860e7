"""Names in a shared folder, by the file system that the folder's path names."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    folder, files = _at(spark, path)
    return files.exists(folder)


def names(spark: SparkSession, path: str) -> list[str]:
    """What lies in a folder; nothing if there is none."""
    folder, files = _at(spark, path)
    return sorted(f.getPath().getName() for f in files.listStatus(folder)) if files.exists(folder) else []


def size(spark: SparkSession, path: str) -> int:
    """Bytes below a folder."""
    folder, files = _at(spark, path)
    return files.getContentSummary(folder).getLength() if files.exists(folder) else 0


def remove(spark: SparkSession, path: str) -> None:
    folder, files = _at(spark, path)
    files.delete(folder, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Put a small file in place as a whole: readers see the old one or the new one."""
    part, files = _at(spark, f"{path}.part")
    stream = files.create(part, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    whole, _ = _at(spark, path)
    files.delete(whole, False)
    if not files.rename(part, whole):
        raise OSError(f"{path}: could not be put in place")


def read_text(spark: SparkSession, path: str) -> str:
    file, files = _at(spark, path)
    stream = files.open(file)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
