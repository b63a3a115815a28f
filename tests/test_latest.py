from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from tablesync.operators.latest import latest, orderable, without_key
from tests.helpers import ROW, at, fetch, plan_of, rows

record = st.tuples(
    st.one_of(st.none(), st.integers(0, 4)),
    st.one_of(st.none(), st.sampled_from([at("2024-01-01"), at("2024-01-02"), at("2024-01-03")])),
    st.sampled_from(["a", "b", "c"]),
)
batches = st.lists(record, max_size=25)
relaxed = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def expected(values):
    """Brute force: NULL keys out, NULL times first, ties by payload."""
    best = {}
    for k, t, v in values:
        if k is None:
            continue
        rank = (t is not None, t or at("1900-01-01"), v)
        if k not in best or rank > best[k][0]:
            best[k] = (rank, (k, t, v))
    return sorted((row for _, row in best.values()), key=repr)


@relaxed
@given(batches)
def test_latest_matches_brute_force_and_is_idempotent(spark, values):
    once = latest(rows(spark, *values, schema=ROW), ["k"], ["at"])
    assert fetch(once) == expected(values)
    assert fetch(latest(once, ["k"], ["at"])) == expected(values)


def test_null_keys_are_left_out_and_can_be_had(spark):
    df = rows(spark, (1, at("2024-01-01"), "a"), (None, at("2024-01-02"), "b"), (None, None, "c"))
    assert fetch(latest(df, ["k"], ["at"])) == [(1, at("2024-01-01"), "a")]
    assert {r["v"] for r in without_key(df, ["k"]).collect()} == {"b", "c"}


def test_ties_do_not_depend_on_the_layout(spark):
    same = [(1, at("2024-01-01"), v) for v in "abcdefgh"]
    for parts in (1, 3, 8):
        df = rows(spark, *same).repartition(parts)
        assert fetch(latest(df, ["k"], ["at"])) == [same[-1]]


def test_hot_key_is_cut_before_the_shuffle(spark):
    df = spark.range(0, 30000, 1, 8).selectExpr("IF(id % 3 = 0, 0, id) AS k", "id AS at", "id AS v")
    out = latest(df, ["k"], ["at"])
    plan = plan_of(out)
    before, after = plan.index("Partial"), plan.index("Exchange")
    assert "WindowGroupLimit" in plan and plan.count("Exchange") == 1
    assert after < before, "the partial limit lies below the exchange"
    assert out.count() == 20001


def test_orderable():
    assert orderable(T.ArrayType(T.LongType()))
    assert not orderable(T.StructType([T.StructField("m", T.MapType(T.StringType(), T.LongType()))]))
