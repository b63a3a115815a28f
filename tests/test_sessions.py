"""The jobs give the same rows under other session settings."""

import pytest

import __spark_entry__ as contract
from tests.compare import differences, open_tables

SF_DIR = "/root/testdata/sf0.001"
JOBS = ["merchant_sync", "bounded_backup", "staged_load"]


@pytest.mark.parametrize(
    ("name", "value"),
    [
        ("spark.sql.session.timeZone", "America/New_York"),
        ("spark.sql.ansi.enabled", "false"),
        ("spark.sql.adaptive.enabled", "false"),
        ("spark.sql.unionOutputPartitioning", "false"),
        ("spark.sql.shuffle.partitions", "3"),
        ("spark.sql.hive.manageFilesourcePartitions", "false"),
    ],
)
def test_jobs(spark, name, value):
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        db = open_tables(SF_DIR)
        for job in JOBS:
            result = contract.queries()[job](spark, SF_DIR)
            assert differences(result, db, contract.oracle_sql()[job]) is None, job
    finally:
        spark.conf.set(name, before)
