"""Replacing a folder as a whole: readers see the old output until the new one is complete."""

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def _file_system(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


@contextmanager
def replacing(spark: SparkSession, path: str) -> Iterator[str]:
    """Gives a new hidden folder beside ``path``; once the block is done it takes the place of ``path``.

    If the block fails, the new folder goes and the old output stays as it was. Input may be read
    from ``path`` itself, as nothing of it is touched before all is written. On file systems with
    renames the swap is two of them; if the second fails, the first is taken back.
    """
    fs, target = _file_system(spark, path)
    jvm_path, mark = spark._jvm.org.apache.hadoop.fs.Path, uuid.uuid4().hex
    new = jvm_path(target.getParent(), f".{target.getName()}.new-{mark}")
    old = jvm_path(target.getParent(), f".{target.getName()}.old-{mark}")
    try:
        yield new.toString()
    except BaseException:
        fs.delete(new, True)
        raise
    fs.mkdirs(target.getParent())
    held = fs.exists(target)
    if held and not fs.rename(target, old):
        raise OSError(f"{path} cannot be replaced; the new output is in {new.toString()}")
    if not fs.rename(new, target):
        if held:
            fs.rename(old, target)
        raise OSError(f"{path} cannot be replaced; the new output is in {new.toString()}")
    if held:
        fs.delete(old, True)


def numbered_folders(spark: SparkSession, path: str, name: str) -> list[int]:
    """The numbers N of the folders ``name=N`` in a folder; none if there is no such folder."""
    fs, at = _file_system(spark, path)
    if not fs.exists(at):
        return []
    found = [s.getPath().getName().partition("=") for s in fs.listStatus(at)]
    return sorted(int(n) for key, _, n in found if key == name and n.isdigit())


def delete(spark: SparkSession, path: str) -> None:
    fs, at = _file_system(spark, path)
    fs.delete(at, True)
