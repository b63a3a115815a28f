"""Small hand-written frames and ways to look at plans and files."""

from __future__ import annotations

import uuid
from datetime import datetime

from tablesync.sources.versions import VersionedTable

ROW = "k bigint, at timestamp_ntz, v string"


def rows(spark, *values, schema=ROW):
    return spark.createDataFrame(list(values), schema)


def at(text):
    return datetime.fromisoformat(text)


def fetch(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def new_path(tmp_path, name="t"):
    return f"{tmp_path}/{name}-{uuid.uuid4().hex[:8]}"


def new_table(spark, tmp_path, n_buckets=4, key=("k",)):
    return VersionedTable(spark, new_path(tmp_path), list(key), n_buckets)


def plan_of(df):
    return df._jdf.queryExecution().toString().split("== Physical Plan ==")[1]


def optimized_plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


class Crash(RuntimeError):
    pass


def crash(*_args, **_kwargs):
    raise Crash
