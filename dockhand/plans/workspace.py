"""A shared folder for written intermediate results."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

from dockhand.errors import SpecError
from dockhand.operators.files import Storage


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        return tempfile.gettempdir()
    raise SpecError("set spark.checkpoint.dir to a folder all executors share")


def new_workspace(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared one, removed when the session's JVM ends."""
    path = f"{shared_folder(spark)}/dockhand-{name}-{uuid.uuid4().hex}"
    storage = Storage(spark, path)
    storage.make_directory(path)
    storage.delete_on_exit(path)
    return storage.qualified(path)
