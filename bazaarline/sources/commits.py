"""Which of several written folders counts: a small file per name, put in place in one step.

Data is written to folders that are never changed afterwards. A pointer file, named after what
it publishes and replaced by a rename, holds the folder. Readers resolve the pointer, so they
see a whole version or the one before it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

POINTERS = "_published"


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def existing(spark: SparkSession, pattern: str) -> list[str]:
    """Existing paths in order; the file system is the one the path names."""
    target, system = _file_system(spark, pattern)
    return sorted(str(status.getPath()) for status in system.globStatus(target) or [])


def commit(spark: SparkSession, root: str, name: str, folder: str) -> None:
    """From now on ``name`` below ``root`` is ``folder``."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    target, system = _file_system(spark, f"{root}/{POINTERS}/{name}")
    written = hadoop.Path(f"{root}/{POINTERS}/.{name}-{uuid.uuid4().hex}")
    stream = system.create(written, True)
    stream.write(bytearray(folder.encode()))
    stream.close()
    # A rename that replaces: the pointer is never missing.
    context = hadoop.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = spark._jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(written, target, options)


def names(spark: SparkSession, root: str) -> list[str]:
    """What is published below ``root``, in order; only listed, no pointer is read."""
    found = [path.rpartition("/")[2] for path in existing(spark, f"{root}/{POINTERS}/*")]
    return [name for name in found if not name.startswith(".")]


def folder_of(spark: SparkSession, root: str, name: str) -> str:
    """The folder that counts as ``name`` now."""
    return _content(spark, f"{root}/{POINTERS}/{name}")


def committed(spark: SparkSession, root: str) -> dict[str, str]:
    """The folder of every name published below ``root``."""
    return {name: folder_of(spark, root, name) for name in names(spark, root)}


def _content(spark: SparkSession, path: str) -> str:
    target, system = _file_system(spark, path)
    stream = system.open(target)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def published(spark: SparkSession, root: str, name: str):
    """The table that counts as ``name`` below ``root`` now."""
    if name not in names(spark, root):
        raise ValueError(f"{name} is not published in {root}")
    return spark.read.parquet(folder_of(spark, root, name))
