"""Seen keys in a bucketed table: the anti join moves only the new rows."""

import uuid

from loomwire.operators.dedupe import drop_known_bucketed, save_key_history


def test_history_side_is_not_shuffled(spark):
    name = f"keys_{uuid.uuid4().hex}"
    history = spark.createDataFrame([(f"k{i}",) for i in range(0, 2000, 2)], "key string")
    save_key_history(history, name, ["key"], buckets=16)
    new = spark.createDataFrame([(f"k{i}", i) for i in range(1500, 2600)] + [(None, -1)], "key string, n int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = drop_known_bucketed(new, name, ["key"])
        got = sorted(r["n"] for r in out.collect())
        plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == [-1] + [i for i in range(1500, 2600) if i % 2 or i >= 2000]
    # one exchange, on the new rows; the table is read by buckets
    assert plan.count("Exchange") == 1
    assert "SelectedBucketsCount: 16 out of 16" in plan
    right = plan[plan.index("SortMergeJoin"):].split("\n")
    history = [line for line in right if "FileScan" in line and "SelectedBucketsCount" in line]
    assert len(history) == 1
