"""Laws that must hold for any input."""

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from stratawork.operators import cleanse, merge, quality

LIMITS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))

keys = st.integers(0, 6)
pairs = st.lists(st.tuples(keys, st.integers(-3, 3)), max_size=12)
unique = st.dictionaries(keys, st.integers(-3, 3), max_size=7).map(lambda d: sorted(d.items()))


def frame(spark, data):
    return spark.createDataFrame(data, "k int, v int")


@LIMITS
@given(target=unique, source=unique)
def test_upsert(spark, target, source):
    merged = merge.upsert(frame(spark, target), frame(spark, source), ["k"])
    assert dict(r for r in map(tuple, merged.collect())) == {**dict(target), **dict(source)}
    assert sorted(map(tuple, merge.upsert(merged, frame(spark, source), ["k"]).collect())) == sorted(
        map(tuple, merged.collect())
    )


@LIMITS
@given(data=pairs)
def test_dedup_keeps_one_row_per_key(spark, data):
    got = [tuple(r) for r in cleanse.remove_duplicates(frame(spark, data), ["k"], "last", ["v"]).collect()]
    assert dict(got) == {k: max(v for j, v in data if j == k) for k, _ in data}
    assert len(got) == len({k for k, _ in data})


@LIMITS
@given(data=st.lists(st.tuples(keys, st.one_of(st.none(), st.integers(-3, 3))), max_size=12))
def test_split_loses_nothing(spark, data):
    good, bad = quality.split_rows(frame(spark, data), F.col("v") > 0)
    assert sorted([tuple(r) for r in good.collect()] + [tuple(r) for r in bad.collect()], key=str) == sorted(data, key=str)


@LIMITS
@given(data=st.lists(st.tuples(keys, st.integers(0, 3), st.sampled_from(["upsert", "delete"])), max_size=15))
def test_versions_equal_replay(spark, data):
    """State at any version equals replaying the log; the feed leads from one state to the other."""
    log, states, live = [], {-1: {}}, {}
    for version, (key, value, op) in enumerate(data):
        if op == "delete" and key not in live:
            op = "upsert"
        kind = "delete" if op == "delete" else ("update" if key in live else "insert")
        log.append((key, value, version, kind))
        if kind == "delete":
            live.pop(key)
        else:
            live[key] = value
        states[version] = dict(live)
    df = spark.createDataFrame(log, "k int, v int, _version int, _op string").withColumn("_ts", F.lit(None))
    end = len(data) - 1
    start = end // 2
    for version in (start, end):
        assert dict(map(tuple, merge.as_of(df, ["k"], version).collect())) == states[version]
    state = dict(states[start])
    for key, change, value in map(tuple, merge.change_feed(df, ["k"], start, end).collect()):
        assert (change == "insert") == (key not in state)
        if change == "delete":
            state.pop(key)
        else:
            state[key] = value
    assert state == states[end]
