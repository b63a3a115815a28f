"""Session settings the jobs rely on, and where a session keeps scratch tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

from tablesync.sources.files import drop_on_exit

CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
}


def get_session(app_name: str = "tablesync", conf: dict[str, str] | None = None) -> SparkSession:
    """Create or reuse a session. The master and all sizes are left to the deployer."""
    builder = SparkSession.builder.appName(app_name)
    for name, value in {**CONF, **(conf or {})}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder named by ``spark.checkpoint.dir``.

    A machine-local folder is used only when the setting is absent and the session is
    local, as in tests. What the session wrote there is dropped when it ends.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        root = tempfile.gettempdir()
    home = f"{root.rstrip('/')}/tablesync-{spark.sparkContext.applicationId}"
    drop_on_exit(spark, home)
    return f"{home}/{name}-{uuid.uuid4().hex}"
