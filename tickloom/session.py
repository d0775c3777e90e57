"""Session settings the operators rely on, and the shared scratch folder."""

import tempfile
import uuid

from pyspark.sql import SparkSession

_SCRATCH = "tickloom.scratch.dir"


def prepare(spark: SparkSession) -> SparkSession:
    """Day maths need a UTC session; nothing else is required of the caller's session."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def scratch_dir(spark: SparkSession) -> str:
    """Folder for written intermediate tables, one per application.

    Lies in the cluster's ``spark.checkpoint.dir``. Only a local session without that setting
    gets a folder of its own: on a cluster a machine-local folder would not outlive its executor.
    """
    current = spark.conf.get(_SCRATCH, None)
    if current:
        return current
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        root = f"{shared.rstrip('/')}/tickloom-{uuid.uuid4().hex}"
    elif spark.sparkContext.master.startswith("local"):
        root = tempfile.mkdtemp(prefix="tickloom-")
    else:
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    spark.conf.set(_SCRATCH, root)
    return root
