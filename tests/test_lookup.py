from pyspark.sql import functions as F

from clickmill.operators.lookup import lookup_values


def test_one_column_beyond_the_broadcast_limit_is_joined_in_place(spark):
    values = ["hot"] * 50 + [None] * 9 + ["a", "b", "b", "unseen", ""]
    rows = spark.createDataFrame(list(enumerate(values)), "id int, C1 string")
    entries = {"hot": 0.5, "a": 0.25, "b": 0.125, "": 0.75, None: 0.0625}
    table = spark.createDataFrame(
        [("C1", value, rate) for value, rate in entries.items()],
        "column string, value string, rate double",
    )
    found = lookup_values(
        rows, ["C1"], table, "rate", lambda name: f"{name}_rate", F.lit(0.0), broadcast_bytes=0
    )
    assert found.columns == ["id", "C1", "C1_rate"]
    got = sorted(tuple(row) for row in found.collect())
    assert got == [(at, value, entries.get(value, 0.0)) for at, value in enumerate(values)]
    # Rows are neither numbered nor put together again by their number.
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan and "_row" not in plan
