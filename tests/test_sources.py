import gzip

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import types as T

from clickmill.operators.profile import row_count
from clickmill.schema import CAT_COLS, CLICK_SCHEMA, INT_COLS, role_of_position
from clickmill.sources import (
    TEXT_SPLITS,
    dataset_paths,
    ingest_log,
    mark_rejects,
    parse_lines,
    read_clicks,
    read_dataset,
    read_lines,
    to_lines,
    validate_log,
    write_clicks,
)

SMALL = T.StructType(
    [
        T.StructField("label", T.IntegerType()),
        T.StructField("I1", T.LongType()),
        T.StructField("I2", T.LongType()),
        T.StructField("C1", T.StringType()),
        T.StructField("C2", T.StringType()),
    ]
)
LINES = {
    "1\t\t5\tab\t": (1, None, 5, "ab", None),
    '0\t7\t-3\t\t"q': (0, 7, -3, None, '"q'),
    "0\t0\t0\ta\tb": (0, 0, 0, "a", "b"),
    "\t\t\t\t": (None, None, None, None, None),
    "1\t2\t3\tback\\slash\t#x": (1, 2, 3, "back\\slash", "#x"),
    "1\t2\t3\t a \tnull": (1, 2, 3, " a ", "null"),
}


def frame(spark, lines):
    return spark.createDataFrame([(line,) for line in lines], "value string")


def parsed(spark, *lines):
    return [tuple(row) for row in parse_lines(frame(spark, lines), SMALL).collect()]


def test_schema_has_forty_columns_in_order():
    assert CLICK_SCHEMA.names == ["label", *INT_COLS, *CAT_COLS]
    assert len(CLICK_SCHEMA) == 40
    roles = [role_of_position(position) for position in range(1, 41)]
    assert roles == ["label"] + ["integer"] * 13 + ["categorical"] * 26


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_parse_lines(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        assert parsed(spark, *LINES) == list(LINES.values())
        assert parsed(spark, "1\t 2 \t3\ta\tb") == [(1, 2, 3, "a", "b")]
        for bad in ("1\tx\t5\tab\t", "1\t2.5\t5\tab\t", "1\t2\t5", "1\t2\t5\ta\tb\tc", ""):
            with pytest.raises(Exception):
                parsed(spark, bad)
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


@pytest.mark.parametrize("options", [{}, {"validate": True}, {"tasks": 3}])
def test_read_plain_and_gzip(spark, tmp_path, options):
    lines = [*LINES, "\t" * 4]
    text = "".join(line + "\n" for line in lines)
    (tmp_path / "plain.txt").write_text(text)
    with gzip.open(tmp_path / "packed.txt.gz", "wt") as file:
        file.write(text)
    expected = sorted([*LINES.values(), (None,) * 5], key=repr)
    for name in ("plain.txt", "packed.txt.gz"):
        rows = read_clicks(spark, str(tmp_path / name), SMALL, **options).collect()
        assert sorted((tuple(row) for row in rows), key=repr) == expected


BROKEN = ("1\tx\t5\tab\t", "1\t2\t5")


@pytest.mark.parametrize("validate", [True, False])
def test_read_fails_on_malformed_rows(spark, tmp_path, validate):
    for number, bad in enumerate(BROKEN):
        path = tmp_path / f"{number}.txt"
        path.write_text(bad + "\n")
        with pytest.raises(Exception):
            read_clicks(spark, str(path), SMALL, validate=validate).collect()


@pytest.mark.parametrize("bad", BROKEN)
def test_validated_lines_fail_where_the_broken_column_is_not_read(spark, bad):
    lines = frame(spark, ["1\t2\t3\ta\tb", bad])
    other = parse_lines(lines, SMALL, validate=True)
    for job in (row_count(other), other.select(SMALL[0].name)):
        with pytest.raises(Exception):
            job.collect()
    assert row_count(parse_lines(lines, SMALL)).first()[0] == 2


def test_validate_log_counts_broken_lines(spark):
    lines = frame(spark, ["1\t2\t3\ta\tb", *BROKEN, "", "\t" * 4, "y\t\t\t\t"])
    assert tuple(validate_log(lines, SMALL).first()) == (6, 2, 2)
    assert tuple(validate_log(lines.limit(0), SMALL).first()) == (0, 0, 0)


def test_write_and_read_back(spark, tmp_path):
    rows = parse_lines(frame(spark, LINES), SMALL)
    path = str(tmp_path / "out.txt")
    write_clicks(rows, path)
    assert all(name.endswith(".gz") for name in _parts(tmp_path / "out.txt"))
    back = read_clicks(spark, path, SMALL).collect()
    assert sorted(map(tuple, back), key=repr) == sorted(LINES.values(), key=repr)


def _parts(folder):
    return [path.name for path in folder.iterdir() if path.name.startswith("part-")]


@pytest.mark.parametrize("bad", ["a\tb", "a\nb", "a\rb"])
def test_writer_refuses_separators_inside_fields(spark, bad):
    rows = spark.createDataFrame([(1, 2, 3, bad, "x")], SMALL)
    with pytest.raises(Exception):
        to_lines(rows).collect()


def test_catalog(spark, tmp_path):
    assert set(dataset_paths("r")) == {
        "train", "debug", "train_5m", "validation_2m", "test_3m", "test",
    }
    (tmp_path / "small-train.txt").write_text("1" + "\t" * 39 + "\n")
    rows = read_dataset(spark, str(tmp_path), "debug").collect()
    assert len(rows) == 1 and rows[0]["label"] == 1 and rows[0]["C26"] is None
    with pytest.raises(ValueError):
        read_dataset(spark, str(tmp_path), "other")


def test_lines_are_dealt_out_as_asked(spark, tmp_path):
    (tmp_path / "one.txt").write_text("a\nb\n")
    path = str(tmp_path / "one.txt")
    assert read_lines(spark, path).rdd.getNumPartitions() == 1
    assert read_lines(spark, path, tasks=4).rdd.getNumPartitions() == 4


def test_catalog_reads_splits_that_lie_elsewhere(spark, tmp_path):
    (tmp_path / "split").mkdir()
    (tmp_path / "split" / "test_3m.txt").write_text("0" + "\t" * 39 + "\n")
    rows = read_dataset(spark, str(tmp_path), "test_3m", TEXT_SPLITS).collect()
    assert [row["label"] for row in rows] == [0]


def test_every_line_is_a_row_or_a_reject(spark, tmp_path):
    broken = {
        "1\t2": "expected 5 fields, found 2",
        "": "expected 5 fields, found 1",
        "1\t2\t3\ta\tb\tc": "expected 5 fields, found 6",
        "1\tx\ty\ta\tb": "malformed I1: x",
        "1\t2\t3.5\ta\tb": "malformed I2: 3.5",
        "9999999999\t2\t3\ta\tb": "malformed label: 9999999999",
    }
    lines = frame(spark, [*LINES, *broken]).repartition(3)
    found = ingest_log(lines, str(tmp_path / "log"), SMALL)
    assert (found.n_lines, found.n_rejects) == (len(LINES) + len(broken), len(broken))
    assert found.rows.schema.names == SMALL.names
    assert sorted(map(tuple, found.rows.collect()), key=str) == sorted(LINES.values(), key=str)
    assert {r["line"]: r["reason"] for r in found.rejects.collect()} == broken
    with pytest.raises(Exception, match="already exists"):
        ingest_log(lines, str(tmp_path / "log"), SMALL)


def test_ingest_reads_the_log_once(spark, tmp_path):
    (tmp_path / "in.txt").write_text("\n".join(LINES) + "\n1\t2\n")
    marked = mark_rejects(read_lines(spark, str(tmp_path / "in.txt")), SMALL)
    plan = marked._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    read = read_lines(spark, str(tmp_path / "in.txt"))
    found = ingest_log(read, str(tmp_path / "out"), SMALL)
    assert found.rows.count() + found.rejects.count() == found.n_lines == len(LINES) + 1
    empty = ingest_log(frame(spark, []), str(tmp_path / "none"), SMALL)
    assert (empty.rows.count(), empty.rejects.count(), empty.n_lines) == (0, 0, 0)


def optimized(rows):
    return rows._jdf.queryExecution().optimizedPlan().toString()


def test_validated_lines_are_split_once_a_line(spark):
    rows = parse_lines(frame(spark, ["1\t2\t3\ta\tb"]), SMALL, validate=True)
    test = next(line for line in optimized(rows).splitlines() if "Filter" in line)
    # Only the message of a line that fails splits it again.
    assert test[: test.index("raise_error")].count("split(") == 2
    assert "x_" in test[test.index("lambdafunction") :].split("raise_error")[0]


def test_plain_lines_are_split_once_a_line(spark):
    plan = optimized(parse_lines(frame(spark, ["1\t2\t3\ta\tb"]), SMALL))
    # The other place is the message of a line that fails.
    assert plan.count("split(") <= 2
    assert "size(split(" not in plan[: plan.index("raise_error")]


def test_lines_of_numbers_are_made_in_small_methods(spark):
    rows = spark.createDataFrame([(1, None, "a", 2.5, None)], "a int, b long, c string, d double, e string")
    lines = to_lines(rows)
    assert [row[0] for row in lines.collect()] == ["1\t\ta\t2.5\t"]
    assert optimized(lines).count("transform(") == 2


def test_ingest_writes_both_kinds_without_sorting(spark, tmp_path, monkeypatch):
    seen = []
    write = DataFrameWriter.parquet

    def noted(self, *args, **options):
        seen.append(spark.conf.get("spark.sql.maxConcurrentOutputFileWriters"))
        return write(self, *args, **options)

    before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    monkeypatch.setattr(DataFrameWriter, "parquet", noted)
    found = ingest_log(frame(spark, [*LINES, *BROKEN]), str(tmp_path / "log"), SMALL)
    assert seen == ["2"]
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == before
    assert (found.n_lines, found.n_rejects) == (len(LINES) + len(BROKEN), len(BROKEN))
