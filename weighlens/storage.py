"""Where intermediate tables go: the shared folder the session names."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession


class NoSharedFolder(RuntimeError):
    """The cluster names no folder that the driver and all executors share."""


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``.

    Without this setting only a local master, which has a single machine, gets a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.conf.get("spark.master", "") or ""
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise NoSharedFolder("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="weighlens-")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
