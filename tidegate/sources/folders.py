"""Folders of data files: moving and removing many of them side by side.

Executors do it through pyarrow's file systems. Where those don't know the storage, the driver does it through Hadoop's, several
folders at a time. Every step can be repeated, so a lost executor does no harm.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from tidegate.session import hadoop_path, remove_folder

AT_ONCE = 16
SCHEMES = re.compile("(file|hdfs|viewfs|s3|gs|gcs|abfss?):")


def _worker() -> Callable[[str], tuple]:
    """Finds file system and path of a folder. Built here so that it travels to executors by value."""

    def store(path: str) -> tuple:
        from pyarrow import fs

        if path.startswith(("/", "file:")):
            return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
        return fs.FileSystem.from_uri(path)

    return store


def reachable(path: str) -> bool:
    """Whether executors can reach the storage of a path through pyarrow."""
    if path.startswith("/"):
        return True
    if not SCHEMES.match(path):
        return False
    try:
        _worker()(path)
    except Exception:  # noqa: BLE001  pyarrow raises its own, OSError or ImportError, by what is not installed
        return False
    return True


def _mover(run: str):
    """Puts the files of ``src`` into ``dst`` under names that start with the run's, then drops all others of ``dst``."""
    store = _worker()
    mark = f"run-{run}-"

    def replace(src: str | None, dst: str) -> None:
        from pyarrow import fs

        system, target = store(dst)

        def files(folder: str) -> list[str]:
            found = system.get_file_info(fs.FileSelector(folder, allow_not_found=True))
            return [f.path for f in found if f.type == fs.FileType.File]

        if src is not None:
            source = store(src)[1]
            system.create_dir(target, recursive=True)
            for path in files(source):
                name = path.rsplit("/", 1)[1]
                if not name.startswith((".", "_")):
                    try:
                        system.move(path, f"{target}/{mark}{name}")
                    except FileNotFoundError:  # another attempt of this task has moved it
                        pass
        kept = 0
        for path in files(target):
            if path.rsplit("/", 1)[1].startswith(mark):
                kept += 1
            else:
                try:
                    system.delete_file(path)
                except FileNotFoundError:
                    pass
        if not kept and system.get_file_info(target).type == fs.FileType.Directory:
            try:
                system.delete_dir(target)
            except FileNotFoundError:
                pass

    return replace


def replace_folders(pairs: DataFrame, root: str, run: str) -> None:
    """Replace the data files of each folder ``dst`` below ``root`` by those of ``src``; without ``src`` the folder goes."""
    spark = pairs.sparkSession
    wanted = pairs.select("src", "dst")
    if not reachable(root):
        def one(row) -> None:
            remove_folder(spark, row["dst"])
            if row["src"] is not None:
                target, system = hadoop_path(spark, row["dst"])
                system.mkdirs(target.getParent())
                system.rename(hadoop_path(spark, row["src"])[0], target)

        with ThreadPoolExecutor(AT_ONCE) as pool:
            list(pool.map(one, wanted.toLocalIterator()))
        return
    replace = _mover(run)

    def moved(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for src, dst in zip(frame["src"], frame["dst"]):
                replace(src, dst)
            yield pd.DataFrame({"n": [len(frame)]})

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted.repartition(parts, "dst").mapInPandas(moved, "n long").agg({"n": "sum"}).collect()


def remove_folders(folders: DataFrame, root: str) -> None:
    """Remove the data files of each folder in the column ``dst`` below ``root``, and the folder."""
    replace_folders(folders.selectExpr("CAST(NULL AS STRING) AS src", "dst"), root, "none")


def partition_name(spark: SparkSession, column: str, value: object) -> str:
    """A partition's folder name, as Spark's writers spell it; a NULL and an empty text share one."""
    utils = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    return f"{column}={utils.escapePathName(str(value)) if value not in (None, '') else utils.DEFAULT_PARTITION_NAME()}"
