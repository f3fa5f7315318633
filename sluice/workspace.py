"""Where intermediate tables, checkpoints and sinks of a job are placed."""

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

SHARED_DIR_KEY = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it.

    A local folder is used only where the setting is absent and the master is
    local; a cluster without the setting is a configuration error, because
    executors could not read what others wrote.
    """
    configured = spark.conf.get(SHARED_DIR_KEY, None)
    if configured:
        return configured.rstrip("/")
    if not re.match(r"local($|\[)", spark.sparkContext.master):
        raise ValueError(f"set {SHARED_DIR_KEY} to a folder shared by all executors")
    return tempfile.mkdtemp(prefix="sluice-")


def fresh_dir(spark: SparkSession, purpose: str) -> str:
    """A new, unused folder for one job under the shared folder."""
    return f"{shared_dir(spark)}/{purpose}-{uuid.uuid4().hex}"
