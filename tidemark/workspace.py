"""Where intermediate and demonstration output may be written."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession


@cache
def _local_root() -> str:
    root = tempfile.mkdtemp(prefix="tidemark-")
    atexit.register(shutil.rmtree, root, ignore_errors=True)
    return root


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A new, unused path that every executor can reach.

    It lies in the folder named by ``spark.checkpoint.dir``.  Without that setting
    only a local-mode session gets a folder of its own; on a cluster a folder of
    the driver's machine would not be seen by the executors.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        shared = _local_root()
    return f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"
