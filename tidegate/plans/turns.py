"""Turns: runs that change the same control table follow each other.

A turn is a file that is created exclusively in a folder all runs share: of two runs, one creates it, and the other waits until it is
gone. Its holder keeps renewing the file's time, so a file that nobody has renewed for a lease belongs to a run that died, and
whoever comes next takes it away by renaming it, which again only one run can do.
"""

from __future__ import annotations

import os
import threading
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

from tidegate.session import hadoop_path, qualified

LEASE = 120.0
PAUSE = 0.2


def _created(spark: SparkSession, path: str) -> bool:
    """Create an empty file unless it is there; False if it is."""
    if path.startswith("file:"):  # Hadoop's local file system looks first and creates then
        try:
            os.close(os.open("/" + path.removeprefix("file:").lstrip("/"), os.O_CREAT | os.O_EXCL | os.O_WRONLY))
        except FileExistsError:
            return False
        return True
    target, system = hadoop_path(spark, path)
    try:
        system.create(target, False).close()
    except Py4JJavaError as problem:
        if "AlreadyExists" in problem.java_exception.getClass().getName() or system.exists(target):
            return False
        raise
    return True


def _age(spark: SparkSession, path: str) -> float | None:
    target, system = hadoop_path(spark, path)
    try:
        return time.time() - system.getFileStatus(target).getModificationTime() / 1000
    except Py4JJavaError:
        return None


def _renewing(spark: SparkSession, path: str, over: threading.Event, lease: float) -> None:
    target, system = hadoop_path(spark, path)
    while not over.wait(lease / 4):
        try:
            system.setTimes(target, int(time.time() * 1000), -1)
        except Py4JJavaError:
            return


@contextmanager
def turn(spark: SparkSession, folder: str, name: str, patience: float = 3600.0, lease: float = LEASE) -> Iterator[None]:
    """Hold the turn called ``name`` in ``folder`` for as long as the block runs; wait for it at most ``patience`` seconds."""
    folder = qualified(spark, folder)
    home, system = hadoop_path(spark, folder)
    system.mkdirs(home)
    path = f"{folder}/_turn-{name}"
    until = time.monotonic() + patience
    while not _created(spark, path):
        age = _age(spark, path)
        if age is not None and age > lease:
            left, away = hadoop_path(spark, path)[0], hadoop_path(spark, f"{path}-{uuid.uuid4().hex}")[0]
            try:
                if system.rename(left, away):
                    system.delete(away, False)
                    continue
            except Py4JJavaError:  # another run was faster
                pass
        if time.monotonic() > until:
            raise TimeoutError(f"the turn {name} in {folder} is taken")
        time.sleep(PAUSE)
    over = threading.Event()
    keeper = threading.Thread(target=_renewing, args=(spark, path, over, lease), daemon=True)
    keeper.start()
    try:
        yield
    finally:
        over.set()
        keeper.join()
        system.delete(hadoop_path(spark, path)[0], False)
