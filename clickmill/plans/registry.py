"""Registered queries over the given tables and, where SQL can say it, their SQL twin.

A query without SQL trains a model or draws a random split; only its rows are checked.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickmill.functions import rate_column
from clickmill.operators import (
    crossval,
    encode,
    evaluate,
    frequent,
    model,
    profile,
    split,
    states,
)
from clickmill.plans import workflow
from clickmill.plans.clicks_view import (
    KEYS,
    clicks,
    clicks_sql,
    clicks_with_keys,
    read_spread,
    uniform_sql,
)
from clickmill.schema import CAT_COLS, ENCODED_CAT_COLS, INT_COLS, LABEL
from clickmill.session import materialize, shared_folder
from clickmill.sources import (
    ingest_log,
    parse_lines,
    read_clicks,
    read_lines,
    to_lines,
    validate_log,
    write_clicks,
    write_lines,
)

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def _query(name: str, sql: str | None = None, on_clicks: bool = True):
    """Register a query; its SQL may read the ``clicks`` view unless told otherwise."""

    def register(function: Query) -> Query:
        _QUERIES[name] = function
        if sql is not None:
            prefix = clicks_sql() if on_clicks else ""
            # Further named selects of the query continue the clause of the view.
            if on_clicks and sql.lstrip().startswith("with "):
                sql_text = prefix + ", " + sql.lstrip()[len("with ") :]
            else:
                sql_text = f"{prefix} {sql}" if prefix else sql
            _SQL[name] = sql_text
        return function

    return register


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _union_all(parts: list[str]) -> str:
    return " union all ".join(parts)


def _scratch(spark: SparkSession, name: str) -> str:
    """New folder for files that a query writes and reads back."""
    return f"{shared_folder(spark)}/clickmill/{name}-{uuid.uuid4().hex}"


# --- profile --------------------------------------------------------------------------


@_query("row_count", "select count(*)::bigint as row_count from clicks")
def _(spark, sf_dir):
    return profile.row_count(clicks(spark, sf_dir))


@_query(
    "distinct_counts",
    _union_all(
        f"select '{name}' as \"column\", (count(distinct {name}) + "
        f"coalesce(max(case when {name} is null then 1 else 0 end), 0))::bigint as n_distinct "
        "from clicks"
        for name in [LABEL, *INT_COLS, *CAT_COLS]
    ),
)
def _(spark, sf_dir):
    return profile.distinct_counts(clicks(spark, sf_dir))


_COUNTS_SQL = _union_all(
    f"select '{name}' as \"column\", {name} as value, count(*)::bigint as \"count\" "
    f"from clicks group by {name}"
    for name in CAT_COLS
)


@_query("category_counts", _COUNTS_SQL)
def _(spark, sf_dir):
    return profile.category_counts(clicks(spark, sf_dir))


@_query(
    "category_counts_ordered",
    f"""with counts as ({_COUNTS_SQL})
    select *, row_number() over (partition by "column"
      order by "count" desc, value asc nulls last)::int as rank from counts""",
)
def _(spark, sf_dir):
    """Counts in order; ``rank`` numbers the rows of a column as they come."""
    return profile.number_in_order(profile.category_counts(clicks(spark, sf_dir), ordered=True))


@_query(
    "value_rates",
    f"""with counts as ({_COUNTS_SQL})
    select "column", value, "count",
      round("count"::double / (select count(*) from clicks), 12) as rate from counts""",
)
def _(spark, sf_dir):
    rates = profile.value_rates(clicks(spark, sf_dir))
    return rates.withColumn("rate", F.round("rate", 12))


def _top_sql(counts: str, n: int) -> str:
    return f"""with counts as ({counts}),
    ranked as (select *, row_number() over (partition by "column"
      order by "count" desc, value asc nulls last)::int as rank from counts)
    select "column", rank, value, "count", false as is_other from ranked where rank <= {n}
    union all
    select "column", {n + 1}, null, coalesce(sum("count") filter (rank > {n}), 0)::bigint, true
    from ranked group by "column" """


@_query("top_categories_clicks", _top_sql(_COUNTS_SQL, 10))
def _(spark, sf_dir):
    return profile.top_categories(profile.category_counts(clicks(spark, sf_dir)), 10)


@_query("top_categories_summaries", _top_sql(_COUNTS_SQL, 10))
def _(spark, sf_dir):
    """The same by frequent-items summaries, an exact recount and its proof."""
    return frequent.frequent_categories(clicks(spark, sf_dir), CAT_COLS, 10)


_EVENT_COLUMNS = ["user_id", "event_type"]
_EVENT_COUNTS_SQL = _union_all(
    f"select '{name}' as \"column\", {name}::varchar as value, count(*)::bigint as \"count\" "
    f"from events group by {name}"
    for name in _EVENT_COLUMNS
)


@_query("top_categories_summaries_events", _top_sql(_EVENT_COUNTS_SQL, 5), on_clicks=False)
def _(spark, sf_dir):
    """A column of few values, which the candidates cover, beside one of many."""
    return frequent.frequent_categories(_table(spark, sf_dir, "events"), _EVENT_COLUMNS, 5)


_ORDER_COUNTS_SQL = _union_all(
    f"select '{name}' as \"column\", {name}::varchar as value, count(*)::bigint as \"count\" "
    f"from orders group by {name}"
    for name in ["o_custkey", "o_orderstatus", "o_orderpriority"]
)


@_query("top_categories_other", _top_sql(_ORDER_COUNTS_SQL, 10), on_clicks=False)
def _(spark, sf_dir):
    orders = _table(spark, sf_dir, "orders")
    counts = profile.category_counts(orders, ["o_custkey", "o_orderstatus", "o_orderpriority"])
    return profile.top_categories(counts, 10)


@_query(
    "top_categories_many",
    _top_sql(
        "select 'o_custkey' as \"column\", o_custkey::varchar as value, "
        "count(*)::bigint as \"count\" from orders group by o_custkey",
        2000,
    ),
    on_clicks=False,
)
def _(spark, sf_dir):
    counts = profile.category_counts(_table(spark, sf_dir, "orders"), ["o_custkey"])
    return profile.top_categories(counts, 2000)


_DOCUMENT_COUNTS_SQL = _union_all(
    f"select '{name}' as \"column\", {name}::varchar as value, count(*)::bigint as \"count\" "
    f"from {table} group by {name}"
    for table, name in [("documents", "lang"), ("documents", "source")]
)


@_query("category_counts_documents", _DOCUMENT_COUNTS_SQL, on_clicks=False)
def _(spark, sf_dir):
    return profile.category_counts(_table(spark, sf_dir, "documents"), ["lang", "source"])


def _moments(name: str, column: str) -> str:
    # DuckDB corrects skewness for sample size; this takes the correction out again.
    return (
        f"select '{name}' as \"column\", round(avg({column}::double), 6) as mean, "
        f"round(stddev_samp({column}::double), 6) as stddev, "
        f"round(skewness({column}::double) * (count({column}) - 2) / "
        f"sqrt(count({column}) * (count({column}) - 1.0::double)), 6) as skewness, "
        f"round(kurtosis_pop({column}::double), 6) as kurtosis "
    )


def _rounded_moments(stats: DataFrame) -> DataFrame:
    names = ["mean", "stddev", "skewness", "kurtosis"]
    return stats.select("column", *[F.round(name, 6).alias(name) for name in names])


@_query("numeric_stats", _union_all(f"{_moments(name, name)} from clicks" for name in INT_COLS))
def _(spark, sf_dir):
    return _rounded_moments(profile.numeric_stats(clicks(spark, sf_dir)))


@_query("numeric_stats_skewed", _moments("value", "value") + " from events", on_clicks=False)
def _(spark, sf_dir):
    return _rounded_moments(profile.numeric_stats(_table(spark, sf_dir, "events"), ["value"]))


@_query(
    "numeric_means",
    _union_all(
        f"select '{name}' as \"column\", round(avg({name}), 9) as mean from clicks"
        for name in INT_COLS
    ),
)
def _(spark, sf_dir):
    means = profile.numeric_means(clicks(spark, sf_dir))
    return means.withColumn("mean", F.round("mean", 9))


@_query(
    "rounded_means",
    _union_all(
        f"select '{name}' as \"column\", round(avg({name})) as mean from clicks"
        for name in INT_COLS
    ),
)
def _(spark, sf_dir):
    return profile.numeric_means(clicks(spark, sf_dir), rounded=True)


def _stored_profile(
    spark: SparkSession, sf_dir: str, int_columns: list[str], cat_columns: list[str]
) -> states.ProfileStore:
    """Profile of the log put together from the states of three parts, one added twice."""
    store = states.ProfileStore(spark, _scratch(spark, "profile"))
    rows = clicks_with_keys(spark, sf_dir)
    for part in [0, 1, 2, 1]:
        own = rows.where(F.col("l_linenumber") % 3 == part)
        store.add(f"line{part}", own, int_columns, cat_columns)
    return store


_SKETCHED = ["C3", "C9", "C17", "C20"]


@_query(
    "profile_states_stats", _union_all(f"{_moments(name, name)} from clicks" for name in INT_COLS)
)
def _(spark, sf_dir):
    """Moments of the whole log from those of its parts."""
    return _rounded_moments(_stored_profile(spark, sf_dir, INT_COLS, []).numeric_stats())


@_query(
    "profile_states_counts",
    _union_all(
        f"select '{name}' as \"column\", {name} as value, count(*)::bigint as \"count\" "
        f"from clicks group by {name}"
        for name in _SKETCHED
    ),
)
def _(spark, sf_dir):
    """Category counts of the whole log from those of its parts."""
    return _stored_profile(spark, sf_dir, [], _SKETCHED).category_counts()


@_query(
    "profile_states_distinct",
    _union_all(
        f"select '{name}' as \"column\", (count(distinct {name}) + "
        f"coalesce(max(case when {name} is null then 1 else 0 end), 0))::bigint as n_distinct, "
        "true as near from clicks"
        for name in _SKETCHED
    ),
)
def _(spark, sf_dir):
    """Exact distinct counts, and whether the united sketches come within 3 % of them."""
    store = _stored_profile(spark, sf_dir, [], _SKETCHED)
    exact = profile.distinct_counts(clicks(spark, sf_dir), _SKETCHED)
    error = F.abs(F.col("estimate") - F.col("n_distinct"))
    return exact.join(store.distinct_estimates(), "column").select(
        "column", "n_distinct", (error <= F.lit(0.03) * F.col("n_distinct")).alias("near")
    )


def _histogram_sql(column: str, table: str, bins: int = 10, rounded: bool = True) -> str:
    lower = f"lo + k * ((hi - lo)::double / {bins})"
    upper = (
        f"case when k = {bins - 1} or lo = hi then hi::double "
        f"else lo + (k + 1) * ((hi - lo)::double / {bins}) end"
    )
    if rounded:
        lower, upper = f"round({lower}, 6)", f"round({upper}, 6)"
    return f"""select '{column}' as "column", k::int as bin, {lower} as lower, {upper} as upper,
      (select count(*) from {table} where {column} is not null and
        (case when lo = hi then 0 else least(floor(({column} - lo) / ((hi - lo)::double / {bins})),
          {bins - 1}) end) = k)::bigint as "count",
      (select count({column}) from {table})::bigint as total
    from (select min({column}) as lo, max({column}) as hi from {table}), range({bins}) r(k)
    where lo is not null and (lo < hi or k = 0)"""


def _rounded_edges(bins: DataFrame) -> DataFrame:
    return bins.withColumns({name: F.round(name, 6) for name in ("lower", "upper")})


@_query("int_histograms", _union_all(_histogram_sql(name, "clicks") for name in INT_COLS))
def _(spark, sf_dir):
    return _rounded_edges(profile.histograms(clicks(spark, sf_dir)))


@_query(
    "int_histogram_labels",
    _union_all(
        f"""select "column", bin, printf('%.1E---%.2E', lower, upper) as bin_label, "count"
        from ({_histogram_sql(name, "clicks", rounded=False)})"""
        for name in INT_COLS
    ),
)
def _(spark, sf_dir):
    bins = profile.histograms(clicks(spark, sf_dir), labels="scientific")
    return bins.select("column", "bin", "bin_label", "count")


@_query("int_histograms_documents", _histogram_sql("n_chars", "documents"), on_clicks=False)
def _(spark, sf_dir):
    return _rounded_edges(profile.histograms(_table(spark, sf_dir, "documents"), ["n_chars"]))


def _fixed_sql(column: str, table: str) -> str:
    return f"""select k::int as bin, k::double as lower, (k + 1)::double as upper,
      (select count(*) from {table} where {column} >= k and
        ({column} < k + 1 or (k = 1 and {column} = 2)))::bigint as "count"
    from range(2) r(k)"""


@_query("label_histogram", _fixed_sql(LABEL, "clicks"))
def _(spark, sf_dir):
    return profile.fixed_histogram(clicks(spark, sf_dir))


@_query("label_histogram_quality", _fixed_sql("quality", "labels"), on_clicks=False)
def _(spark, sf_dir):
    return profile.fixed_histogram(_table(spark, sf_dir, "labels"), "quality")


# --- projections ----------------------------------------------------------------------


@_query("column_by_position", "select C17 from clicks")
def _(spark, sf_dir):
    # Label, 13 integers and 16 categories lie before it.
    return profile.column_at(clicks(spark, sf_dir), 30)


@_query("project_int", f"select {', '.join(INT_COLS)} from clicks")
def _(spark, sf_dir):
    return profile.integer_columns(clicks(spark, sf_dir))


@_query("project_cat", f"select {', '.join(CAT_COLS)} from clicks")
def _(spark, sf_dir):
    return profile.categorical_columns(clicks(spark, sf_dir))


@_query("non_null", "select C20 from clicks where C20 is not null")
def _(spark, sf_dir):
    return profile.non_null(clicks(spark, sf_dir), "C20")


# --- sources and sinks ----------------------------------------------------------------

_ALL_SQL = f"select {', '.join([LABEL, *INT_COLS, *CAT_COLS])} from clicks"


@_query("parse_lines", _ALL_SQL)
def _(spark, sf_dir):
    return parse_lines(to_lines(clicks(spark, sf_dir)))


@_query("tsv_roundtrip", _ALL_SQL)
def _(spark, sf_dir):
    path = _scratch(spark, "clicks.txt")
    write_clicks(clicks(spark, sf_dir), path)
    return read_clicks(spark, path)


@_query(
    "tsv_roundtrip_empty_lines",
    f"""select * from ({_ALL_SQL}) union all
      select {", ".join("null" for _ in [LABEL, *INT_COLS, *CAT_COLS])} from lineitem
      where l_linenumber = 3""",
)
def _(spark, sf_dir):
    """A log in which some lines have empty fields only."""
    rows = clicks_with_keys(spark, sf_dir).where("l_linenumber = 3")
    names = [LABEL, *INT_COLS, *CAT_COLS]
    kinds = dict(rows.dtypes)
    empty = rows.select(*[F.lit(None).cast(kinds[name]).alias(name) for name in names])
    path = _scratch(spark, "clicks.txt")
    write_clicks(clicks(spark, sf_dir).unionAll(empty), path)
    return read_clicks(spark, path, validate=True)


@_query(
    "validate_log",
    """select count(*)::bigint as n_lines,
      sum(case when l_linenumber = 1 then 1 else 0 end)::bigint as wrong_width,
      sum(case when l_linenumber = 2 then 1 else 0 end)::bigint as malformed from lineitem""",
    on_clicks=False,
)
def _(spark, sf_dir):
    """Lines of the view, some cut short and some with text for a number."""
    rows = clicks_with_keys(spark, sf_dir)
    columns = [LABEL, *INT_COLS, *CAT_COLS]
    texts = [F.coalesce(F.col(name).cast("string"), F.lit("")) for name in columns]
    spoiled = F.when(F.col("l_linenumber") == 2, F.lit("x")).otherwise(texts[1])
    line = F.concat_ws("\t", texts[0], spoiled, *texts[2:])
    cut = F.when(F.col("l_linenumber") == 1, F.substring_index(line, "\t", 5)).otherwise(line)
    return validate_log(rows.select(cut.alias("value")))


def _spoiled_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of the log, of which some are cut and some have a letter for a number."""
    names = [LABEL, *INT_COLS, *CAT_COLS]
    rows = clicks_with_keys(spark, sf_dir)
    texts = [F.coalesce(F.col(name).cast("string"), F.lit("")) for name in names]
    spoiled = F.when(F.col("l_linenumber") == 2, F.lit("x")).otherwise(texts[4])
    line = F.concat_ws("\t", *texts[:4], spoiled, *texts[5:])
    cut = F.when(F.col("l_linenumber") == 1, F.substring_index(line, "\t", 5)).otherwise(line)
    return rows.select(cut.alias("value"))


@_query("ingest_rows", f"{_ALL_SQL} where l_linenumber > 2")
def _(spark, sf_dir):
    """Rows of a log with broken lines, which do not fail the job."""
    return ingest_log(_spoiled_lines(spark, sf_dir), _scratch(spark, "ingested")).rows


@_query(
    "ingest_rejects",
    """select case l_linenumber when 1 then 'expected 40 fields, found 5' else 'malformed I4: x' end
        as reason, count(*)::bigint as n_rows,
      (select count(*) from clicks)::bigint as n_lines,
      (select count(*) from clicks where l_linenumber < 3)::bigint as n_rejects
    from clicks where l_linenumber < 3 group by l_linenumber""",
)
def _(spark, sf_dir):
    """Reasons of the rejected lines beside the counts of lines and rejects."""
    found = ingest_log(_spoiled_lines(spark, sf_dir), _scratch(spark, "ingested"))
    return found.rejects.groupBy("reason").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.lit(found.n_lines).cast("long").alias("n_lines"),
        F.lit(found.n_rejects).cast("long").alias("n_rejects"),
    )


# --- splits ---------------------------------------------------------------------------

_KEY_SQL = "select l_orderkey, l_linenumber, l_partkey"
# Cumulated shares of the four parts of the source log.
_PART_SQL = (
    "case when u < 0.2083333::double * 0.5 then 'train_5m' "
    "when u < 0.2083333::double * 0.5 + 0.2083333::double * 0.2 then 'validation_2m' "
    "when u < 0.2083333::double * 0.5 + 0.2083333::double * 0.2 + 0.2083333::double * 0.3 "
    "then 'test_3m' else 'test' end"
)
_SPLIT_SQL = (
    f"select l_orderkey, l_linenumber, l_partkey, {_PART_SQL} as split from "
    f"(select *, {uniform_sql('duckdb', '-split')} as u from lineitem)"
)


def _key():
    return F.concat_ws("-", *[F.col(name).cast("string") for name in KEYS])


def _hash_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "lineitem").select(*KEYS)
    return split.hash_split(rows, key=_key(), salt="-split")


@_query("hash_split", _SPLIT_SQL, on_clicks=False)
def _(spark, sf_dir):
    return _hash_split(spark, sf_dir)


@_query(
    "split_sizes",
    f"select split, count(*)::bigint as n_rows from ({_SPLIT_SQL}) group by split",
    on_clicks=False,
)
def _(spark, sf_dir):
    return _hash_split(spark, sf_dir).groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"))


def _random_split_sql(parts: int) -> str:
    return (
        f"select count(*)::bigint as n_rows, {parts}::bigint as n_parts, "
        "0::bigint as rows_changed, true as shares_near from lineitem"
    )


def _split_checks(
    spark: SparkSession, sf_dir: str, split_rows: Callable, weights: dict[str, float]
) -> DataFrame:
    """What holds for a random split: rows, parts, rows lost or doubled, shares near weights."""
    rows = read_spread(spark, f"{sf_dir}/lineitem.parquet", *KEYS)
    parts = split_rows(rows)
    marked = None
    for name, part in parts.items():
        named = part.select(F.lit(name).alias("split"), F.xxhash64(*part.columns).alias("row"))
        marked = named if marked is None else marked.unionAll(named)
    kept = marked.groupBy("row").agg(F.count(F.lit(1)).alias("kept"))
    given = rows.select(F.xxhash64(*rows.columns).alias("row"))
    given = given.groupBy("row").agg(F.count(F.lit(1)).alias("given"))
    changed = F.abs(F.coalesce("given", F.lit(0)) - F.coalesce("kept", F.lit(0)))
    lost = given.join(kept, "row", "full").agg(F.sum(changed).alias("rows_changed"))
    sizes = marked.groupBy("split").agg(F.count(F.lit(1)).alias("n"))
    total = float(sum(weights.values()))
    expected = F.create_map(*[F.lit(x) for k, w in weights.items() for x in (k, w / total)])
    # Five standard errors of a share.
    share, n_rows = expected[F.col("split")], F.sum("n").over(Window.partitionBy())
    near = F.abs(F.col("n") / n_rows - share) <= 5 * F.sqrt(share * (1 - share) / n_rows)
    summary = sizes.select("n", near.alias("near")).agg(
        F.sum("n").alias("n_rows"),
        F.count(F.lit(1)).alias("n_parts"),
        F.every("near").alias("shares_near"),
    )
    # One row on either side.
    return summary.crossJoin(lost).select("n_rows", "n_parts", "rows_changed", "shares_near")


@_query("random_split_train_test", _random_split_sql(2), on_clicks=False)
def _(spark, sf_dir):
    weights = split.TRAIN_TEST_WEIGHTS
    return _split_checks(spark, sf_dir, lambda rows: split.random_split(rows, weights), weights)


@_query("random_split_train_val_test", _random_split_sql(3), on_clicks=False)
def _(spark, sf_dir):
    weights = split.TRAIN_PART_WEIGHTS
    return _split_checks(spark, sf_dir, lambda rows: split.random_split(rows, weights), weights)


@_query("random_split_all", _random_split_sql(4), on_clicks=False)
def _(spark, sf_dir):
    return _split_checks(spark, sf_dir, split.split_all, split.ALL_WEIGHTS)


_ROW_LINE_SQL = (
    "concat_ws(chr(9), l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, "
    "l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate)"
)


def _exact_sql(sizes: str) -> str:
    """Rows in the order of their hash, the first of them for the first part and so on."""
    hashed = (
        "cast('0x' || substr(md5(concat(l_orderkey, '-', l_linenumber, '-', l_partkey, '-exact')), "
        "1, 15) as bigint)"
    )
    return f"""with placed as (select l_orderkey, l_linenumber, l_partkey,
        row_number() over (order by {hashed}) as place from lineitem)
    select l_orderkey, l_linenumber, l_partkey, case {sizes} else 'test' end as split
    from placed"""


def _exact(spark: SparkSession, sf_dir: str, sizes: dict[str, int]) -> DataFrame:
    rows = _table(spark, sf_dir, "lineitem").select(*KEYS)
    return split.exact_split(rows, sizes, key=_key(), salt="-exact")


@_query(
    "split_exact",
    _exact_sql(
        "when place <= 5000 then 'train' when place <= 5777 then 'validation' "
        "when place <= 5778 then 'one'"
    ),
    on_clicks=False,
)
def _(spark, sf_dir):
    """Parts of exactly the asked numbers of rows, and all others."""
    return _exact(spark, sf_dir, {"train": 5000, "validation": 777, "one": 1})


@_query(
    "split_exact_shares",
    _exact_sql(
        "when place <= (select count(*) from lineitem) * 10 // 96 then 'train_5m' "
        "when place <= (select count(*) from lineitem) * 14 // 96 then 'validation_2m' "
        "when place <= (select count(*) from lineitem) * 20 // 96 then 'test_3m'"
    ),
    on_clicks=False,
)
def _(spark, sf_dir):
    """The nominal parts of 5, 2 and 3 of 48 million rows, scaled to this log."""
    rows = _table(spark, sf_dir, "lineitem").count()
    ends = {"train_5m": rows * 10 // 96, "validation_2m": rows * 14 // 96, "test_3m": rows * 20 // 96}
    last, sizes = 0, {}
    for name, end in ends.items():
        sizes[name], last = end - last, end
    return _exact(spark, sf_dir, sizes)


def _row_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of the table, with all its columns, as a line."""
    return to_lines(read_spread(spark, f"{sf_dir}/lineitem.parquet", *KEYS))


@_query(
    "split_files_roundtrip",
    f"""select part, value from (select value, {_PART_SQL} as part from
      (select value, cast('0x' || substr(md5(value), 1, 8) as bigint) / 4294967296.0::double as u
       from (select {_ROW_LINE_SQL} as value from lineitem)))""",
    on_clicks=False,
)
def _(spark, sf_dir):
    """Lines written as gzip text, one folder per part, and read back."""
    path = _scratch(spark, "split")
    split.write_splits(_row_lines(spark, sf_dir), path)
    return read_lines(spark, path).select("part", "value")


@_query("split_lines_write", f"select {_ROW_LINE_SQL} as value from lineitem", on_clicks=False)
def _(spark, sf_dir):
    """All parts of a random one-pass split together hold every line once."""
    path = _scratch(spark, "split")
    split.write_splits(_row_lines(spark, sf_dir), path, assign="random")
    return read_lines(spark, path).select("value")


# --- encoding -------------------------------------------------------------------------

_RATE_COLUMNS = [*ENCODED_CAT_COLS, "C9"]


def _rates_sql(table: str, columns: list[str]) -> str:
    return _union_all(
        f"select '{name}' as \"column\", {name} as value, count(*)::bigint as \"count\", "
        f"count(*)::double / (select count(*) from {table}) as rate from {table} group by {name}"
        for name in columns
    )


@_query(
    "freq_encode_fit",
    f"select \"column\", value, \"count\", round(rate, 12) as rate "
    f"from ({_rates_sql('clicks', _RATE_COLUMNS)})",
)
def _(spark, sf_dir):
    fitted = encode.FrequencyEncoder(inputCols=_RATE_COLUMNS).fit(clicks(spark, sf_dir))
    return fitted.rates.select("column", "value", "count", F.round("rate", 12).alias("rate"))


# Rates learned on one part of the rows and looked up for all of them.
_TRAIN_WEIGHTS = {"train": 0.5, "test": 0.5}
_TRAIN_SQL = f"{uniform_sql('duckdb', '-split')} < 0.5::double"


def _train_rows(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Halves of the clicks view by a hash that the label does not depend on."""
    marked = split.hash_split(rows, _TRAIN_WEIGHTS, key=_key(), salt="-split")
    return (
        marked.where(F.col("split") == "train").drop("split"),
        marked.where(F.col("split") == "test").drop("split"),
    )


def _lookup_sql(columns: list[str]) -> str:
    rates = ", ".join(
        f"coalesce(round(r{n}.rate, 12), 0.0::double) as {rate_column(name)}"
        for n, name in enumerate(columns)
    )
    joins = " ".join(
        f"left join (select {name} as value, count(*)::double / (select count(*) from train) as rate "
        f"from train group by {name}) r{n} on clicks.{name} is not distinct from r{n}.value"
        for n, name in enumerate(columns)
    )
    return f"""with train as (select * from clicks where {_TRAIN_SQL})
    {_KEY_SQL}, {rates} from clicks {joins}"""


def _encoded(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    rows = clicks_with_keys(spark, sf_dir).select(*KEYS, *_RATE_COLUMNS)
    train, _ = _train_rows(rows)
    fitted = encode.FrequencyEncoder(inputCols=_RATE_COLUMNS, **options).fit(train)
    rates = [rate_column(name) for name in _RATE_COLUMNS]
    encoded = fitted.transform(rows)
    return encoded.select(*KEYS, *[F.round(name, 12).alias(name) for name in rates])


@_query("freq_encode_transform", _lookup_sql(_RATE_COLUMNS))
def _(spark, sf_dir):
    return _encoded(spark, sf_dir)


@_query("freq_encode_transform_large", _lookup_sql(_RATE_COLUMNS))
def _(spark, sf_dir):
    """The same lookup as for rate tables beyond the broadcast limit."""
    return _encoded(spark, sf_dir, broadcastBytes=0)


_UNSEEN = "case when l_orderkey % 10 < 7 then 'never-seen' else C9 end"


@_query(
    "freq_encode_transform_unseen",
    f"""with train as (select * from clicks where {_TRAIN_SQL}),
    rates as (select C9 as value, count(*)::double / (select count(*) from train) as rate
      from train group by C9),
    scored as (select l_orderkey, l_linenumber, l_partkey, {_UNSEEN} as value from clicks)
    {_KEY_SQL}, coalesce(round(rate, 12), 0.0::double) as C9_rate
    from scored left join rates on scored.value is not distinct from rates.value""",
)
def _(spark, sf_dir):
    """The large lookup where most scored rows hold a value that fit never saw."""
    rows = clicks_with_keys(spark, sf_dir).select(*KEYS, "C9")
    train, _ = _train_rows(rows)
    fitted = encode.FrequencyEncoder(inputCols=["C9"], broadcastBytes=0).fit(train)
    encoded = fitted.transform(rows.withColumn("C9", F.expr(_UNSEEN)))
    return encoded.select(*KEYS, F.round("C9_rate", 12).alias("C9_rate"))


def _impute_sql(fill: str) -> str:
    filled = ", ".join(
        f"coalesce({name}, (select {fill.format(mean=f'avg({name})')} from clicks)) as {name}"
        for name in INT_COLS
    )
    return f"{_KEY_SQL}, {filled} from clicks"


def _imputed(spark: SparkSession, sf_dir: str, strategy: str) -> DataFrame:
    rows = clicks_with_keys(spark, sf_dir).select(*KEYS, *INT_COLS)
    return encode.MeanImputer(inputCols=INT_COLS, strategy=strategy).fit(rows).transform(rows)


@_query("impute_truncate", _impute_sql("trunc({mean})::bigint"))
def _(spark, sf_dir):
    return _imputed(spark, sf_dir, "truncate")


@_query("impute_round", _impute_sql("round({mean})::bigint"))
def _(spark, sf_dir):
    return _imputed(spark, sf_dir, "round")


@_query(
    "impute_exact",
    f"{_KEY_SQL}, "
    + ", ".join(
        f"round(coalesce({name}::double, (select avg({name}) from clicks)), 6) as {name}"
        for name in INT_COLS
    )
    + " from clicks",
)
def _(spark, sf_dir):
    imputed = _imputed(spark, sf_dir, "exact")
    return imputed.select(*KEYS, *[F.round(name, 6).alias(name) for name in INT_COLS])


_FEATURES = encode.feature_columns()


def _feature_arrays(features: DataFrame) -> DataFrame:
    """One rounded column per feature."""
    array = vector_to_array(encode.FEATURES)
    return features.select(
        LABEL,
        *[F.round(array[n], 9).alias(f"f_{name}") for n, name in enumerate(_FEATURES)],
    )


def _features_sql(train_where: str, test_where: str) -> str:
    def encoded(source: str) -> str:
        ints = ", ".join(
            f"coalesce({name}, (select trunc(avg({name}))::bigint from train))::double as {name}"
            for name in INT_COLS
        )
        rates = ", ".join(
            f"coalesce(r{n}.rate, 0.0::double) as {rate_column(name)}"
            for n, name in enumerate(ENCODED_CAT_COLS)
        )
        joins = " ".join(
            f"left join (select {name} as value, count(*)::double / (select count(*) from train) "
            f"as rate from train group by {name}) r{n} "
            f"on s.{name} is not distinct from r{n}.value"
            for n, name in enumerate(ENCODED_CAT_COLS)
        )
        return f"select {LABEL}::double as {LABEL}, {ints}, {rates} from {source} s {joins}"

    scaled = ", ".join(
        f"round(case when hi_{name} = lo_{name} then 0.5::double else "
        f"({name} - lo_{name}) / (hi_{name} - lo_{name}) end, 9) + 0.0::double as f_{name}"
        for name in _FEATURES
    )
    bounds = ", ".join(f"min({name}) as lo_{name}, max({name}) as hi_{name}" for name in _FEATURES)
    return f"""with train as (select * from clicks where {train_where}),
    test as (select * from clicks where {test_where}),
    encoded_train as ({encoded("train")}),
    encoded_test as ({encoded("test")}),
    bounds as (select {bounds} from encoded_train)
    select {LABEL}, {scaled} from encoded_test, bounds"""


@_query("features_train", _features_sql("true", "true"))
def _(spark, sf_dir):
    rows = clicks(spark, sf_dir).select(LABEL, *INT_COLS, *ENCODED_CAT_COLS)
    return _feature_arrays(encode.to_features(encode.fit_features(rows), rows))


@_query("features_test", _features_sql(_TRAIN_SQL, f"not ({_TRAIN_SQL})"))
def _(spark, sf_dir):
    train, test = _train_rows(clicks_with_keys(spark, sf_dir))
    return _feature_arrays(encode.to_features(encode.fit_features(train), test))


@_query(
    "minmax_scale",
    "with bounds as (select min(I2) as lo2, max(I2) as hi2, min(I13) as lo13, max(I13) as hi13 "
    "from clicks) "
    f"{_KEY_SQL}, round((I2 - lo2)::double / (hi2 - lo2), 9) as I2_scaled, "
    "round((I13 - lo13)::double / (hi13 - lo13), 9) as I13_scaled from clicks, bounds",
)
def _(spark, sf_dir):
    rows = clicks_with_keys(spark, sf_dir).select(*KEYS, "I2", "I13")
    _, assembler, scaler = encode.feature_pipeline(["I2", "I13"], []).getStages()
    assembled = assembler.transform(rows)
    scaled = vector_to_array(encode.FEATURES)
    return (
        scaler.fit(assembled)
        .transform(assembled)
        .select(
            *KEYS,
            F.round(scaled[0], 9).alias("I2_scaled"),
            F.round(scaled[1], 9).alias("I13_scaled"),
        )
    )


@_query(
    "label_index",
    """with ranked as (select label, (row_number() over
      (order by count(*) desc, label::double::varchar) - 1)::double as indexed
      from clicks group by label)
    select l_orderkey, l_linenumber, l_partkey, label, indexed from clicks join ranked using (label)""",
)
def _(spark, sf_dir):
    rows = clicks_with_keys(spark, sf_dir).select(*KEYS, LABEL)
    return model.index_labels(rows).transform(rows)


# --- cross-validation -----------------------------------------------------------------

# One yes/no feature: models then answer with the click rates of its two values.
_BINARY = "case when I2 >= 25 then 1.0 else 0.0 end"
_FOLDS = 5
_CV_COLUMNS = ["C9", "C17", "C20"]
_FOLD_SQL = f"cast(floor(({uniform_sql('duckdb', '-fold')}) * {_FOLDS}) as int)"


def _fold_key():
    return F.concat(_key(), F.lit("-fold"))


def _folded(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    rows = clicks_with_keys(spark, sf_dir).select(*KEYS, *columns)
    return materialize(crossval.with_folds(rows, _FOLDS, _fold_key()), "folds")


def _cv_rates_sql(columns: list[str]) -> str:
    return "with folded as (select *, " + _FOLD_SQL + " as fold from clicks) " + _union_all(
        f"""select '{name}' as "column", value, f.fold::int as fold,
          round((select count(*) from folded where fold <> f.fold
            and {name} is not distinct from value)::double
            / (select count(*) from folded where fold <> f.fold), 12) as rate
        from (select distinct {name} as value from folded), range({_FOLDS}) f(fold)"""
        for name in columns
    )


@_query("cv_fold_rates", _cv_rates_sql(["C17", "C20"]))
def _(spark, sf_dir):
    """Rates of every value in all folds but each one, from one pass."""
    rows = _folded(spark, sf_dir, "C17", "C20")
    counts = materialize(crossval.fold_counts(rows, ["C17", "C20"], _FOLDS), "fold-counts")
    rates = crossval.held_out_rates(counts, crossval.fold_sizes(rows, _FOLDS))
    return rates.select("column", "value", F.posexplode("rates").alias("fold", "rate")).withColumn(
        "rate", F.round("rate", 12)
    )


@_query(
    "cv_fold_numbers",
    f"with folded as (select *, {_FOLD_SQL} as fold from clicks) "
    + _union_all(
        f"""select '{name}' as "column", f.fold::int as fold, round(avg({name}::double), 9) as mean,
          min({name})::double as low, max({name})::double as high
        from folded, range({_FOLDS}) f(fold) where folded.fold <> f.fold group by f.fold"""
        for name in INT_COLS
    ),
)
def _(spark, sf_dir):
    """Means and bounds of every integer column without each fold."""
    found = crossval.number_stats(_folded(spark, sf_dir, *INT_COLS), INT_COLS, _FOLDS)
    rows = [
        (name, fold, stats.means[fold], float(stats.lows[fold]), float(stats.highs[fold]))
        for name, stats in found.items()
        for fold in range(_FOLDS)
    ]
    schema = "`column` string, fold int, mean double, low double, high double"
    return spark.createDataFrame(rows, schema).withColumn("mean", F.round("mean", 9))


def _cv_joins() -> str:
    return " ".join(
        f"left join others o{n} on o{n}.\"column\" = '{name}' and o{n}.fold = folded.fold "
        f"and o{n}.value is not distinct from folded.{name}"
        for n, name in enumerate(_CV_COLUMNS)
    )


_CV_OTHERS_SQL = f"""with folded as (select *, {_FOLD_SQL} as fold from clicks),
    sizes as (select fold, count(*) as n from folded group by fold),
    counts as ({_union_all(
        f"select '{name}' as \"column\", {name} as value, fold, count(*) as n from folded "
        f"group by {name}, fold"
        for name in _CV_COLUMNS
    )}),
    totals as (select "column", value, sum(n) as n from counts group by all),
    others as (select totals."column", totals.value, sizes.fold,
      (totals.n - coalesce(counts.n, 0))::double
        / ((select sum(n) from sizes) - sizes.n) as rate
      from totals cross join sizes left join counts on counts."column" = totals."column"
        and counts.value is not distinct from totals.value and counts.fold = sizes.fold)"""


@_query(
    "cv_encode",
    f"""{_CV_OTHERS_SQL}
    {_KEY_SQL}, folded.fold, {", ".join(
        f"round(o{n}.rate, 12) as {name}_rate" for n, name in enumerate(_CV_COLUMNS)
    )} from folded {_cv_joins()}""",
)
def _(spark, sf_dir):
    """Every row with the rates that the other folds give its values."""
    return _cv_encoded(spark, sf_dir)


def _cv_encoded(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    rows = _folded(spark, sf_dir, LABEL, *_CV_COLUMNS)
    encoding = crossval.fit_folds(rows, _FOLDS, [], _CV_COLUMNS)
    encoded = encoding.encode(rows, **options)
    return encoded.select(
        *KEYS,
        "fold",
        *[
            F.round(F.element_at(crossval.rates_column(name), F.col("fold") + 1), 12).alias(
                rate_column(name)
            )
            for name in _CV_COLUMNS
        ],
    )


@_query("cv_encode_large", _SQL["cv_encode"], on_clicks=False)
def _(spark, sf_dir):
    """The same with tables beyond the broadcast limit."""
    return _cv_encoded(spark, sf_dir, broadcast_bytes=0)


@_query(
    "cv_fold_areas",
    f"""{_CV_OTHERS_SQL},
    scored as (select folded.fold, folded.label, round(o0.rate, 12) as score from folded
      left join others o0 on o0."column" = 'C9' and o0.fold = folded.fold
        and o0.value is not distinct from folded.C9),
    points as (select fold, score, count(*) as n,
      sum(case when label = 1 then 1 else 0 end) as pos,
      sum(case when label <> 1 then 1 else 0 end) as neg from scored group by fold, score),
    summed as (select fold, n, pos, neg,
      sum(pos) over (partition by fold order by score desc) - pos as pos_above from points)
    select fold, sum(n)::bigint as "rows", round(sum(neg * (pos_above + pos / 2.0::double))
      / (sum(pos)::double * sum(neg)), 9) as auc from summed group by fold""",
)
def _(spark, sf_dir):
    """Area of every fold, scored by the rate that the other folds give its C9."""
    rows = _folded(spark, sf_dir, LABEL, "C9")
    encoded = crossval.fit_folds(rows, _FOLDS, [], ["C9"]).encode(rows)
    rate = F.element_at(crossval.rates_column("C9"), F.col("fold") + 1)
    scored = materialize(encoded.select(LABEL, "fold", F.round(rate, 12).alias("score")), "scored")
    areas = crossval.fold_areas(scored, _FOLDS)
    return areas.select("fold", F.col("rows").cast("long").alias("rows"),
                        F.round("auc", 9).alias("auc"))


@_query(
    "cv_logistic_rates",
    f"""with folded as (select label, ({_BINARY})::double as value, {_FOLD_SQL} as fold from clicks)
    select f.fold::int as fold, value, round(avg(label), 4) as score
    from folded, range({_FOLDS}) f(fold) where folded.fold <> f.fold group by f.fold, value""",
)
def _(spark, sf_dir):
    """Logistic regression per fold on one yes/no feature: click rates of the other folds."""
    rows = clicks_with_keys(spark, sf_dir).select(
        *KEYS, LABEL, F.expr(_BINARY).cast("int").alias("value")
    )
    scored = crossval.cross_validate(
        rows,
        _FOLDS,
        lambda features: model.train_lr(features, max_iter=100, reg_param=0.0),
        ["value"],
        [],
        key=_fold_key(),
    )
    return scored.groupBy("fold", F.col("value").cast("double").alias("value")).agg(
        F.round(F.max("score"), 4).alias("score")
    )


@_query("cv_areas")
def _(spark, sf_dir):
    """Areas per fold of the logistic regression on all features, with its real parameters."""
    rows = clicks_with_keys(spark, sf_dir).select(*KEYS, LABEL, *INT_COLS, *ENCODED_CAT_COLS)
    scored = crossval.cross_validate(rows, _FOLDS, key=_fold_key())
    scored = materialize(scored.select(LABEL, crossval.FOLD, "score"), "scored")
    return crossval.fold_areas(scored, _FOLDS)


# --- evaluation -----------------------------------------------------------------------


def _curve_sql(source: str, thin: bool = False) -> str:
    kept = (
        "where rank = 1 or rank = last_rank or next_pos <> pos or next_neg <> neg" if thin else ""
    )
    return f"""with points as (select score as threshold,
        sum(case when label = 1 then 1 else 0 end) as pos,
        sum(case when label <> 1 then 1 else 0 end) as neg from {source} group by score),
    summed as (select threshold, pos, neg,
        sum(pos) over (order by threshold desc) as tp, sum(neg) over (order by threshold desc) as fp,
        sum(pos) over () as positives, sum(neg) over () as negatives,
        lead(pos) over (order by threshold desc) as next_pos,
        lead(neg) over (order by threshold desc) as next_neg,
        row_number() over (order by threshold desc) as rank,
        count(*) over () as last_rank from points)
    select threshold::double as threshold, round(fp::double / negatives, 12) as fpr,
      round(tp::double / positives, 12) as tpr from summed {kept}
    union all select max(threshold)::double + 1, 0.0::double, 0.0::double from points"""


def _area_sql(source: str) -> str:
    """Area as the chance that a positive row scores higher than a negative one."""
    return f"""with points as (select score,
        sum(case when label = 1 then 1 else 0 end) as pos,
        sum(case when label <> 1 then 1 else 0 end) as neg from {source} group by score),
    summed as (select pos, neg,
        sum(pos) over (order by score desc) - pos as pos_above from points)
    select round(sum(neg * (pos_above + pos / 2.0::double)) / (sum(pos)::double * sum(neg)), 9) as auc
    from summed"""


def _rounded_curve(curve: DataFrame) -> DataFrame:
    return curve.select(
        "threshold", F.round("fpr", 12).alias("fpr"), F.round("tpr", 12).alias("tpr")
    )


# Some rows lack I3; they score lowest.
_SCORED_SQL = "(select coalesce(I3, -1) as score, label from clicks)"


def _scored_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clicks(spark, sf_dir).select(F.coalesce("I3", F.lit(-1)).alias("score"), LABEL)


@_query("roc_curve", _curve_sql(_SCORED_SQL))
def _(spark, sf_dir):
    return _rounded_curve(evaluate.roc_curve(_scored_clicks(spark, sf_dir)))


@_query("roc_curve_ranges", _curve_sql(_SCORED_SQL))
def _(spark, sf_dir):
    """The same curve cut into ranges of about a thousand scores."""
    return _rounded_curve(
        evaluate.roc_curve(_scored_clicks(spark, sf_dir), scores_per_task=1000)
    )


@_query("roc_curve_thin", _curve_sql(_SCORED_SQL, thin=True))
def _(spark, sf_dir):
    return _rounded_curve(evaluate.roc_curve(_scored_clicks(spark, sf_dir), thin=True))


@_query("roc_auc", _area_sql(_SCORED_SQL))
def _(spark, sf_dir):
    area = evaluate.roc_auc(_scored_clicks(spark, sf_dir))
    return area.select(F.round("auc", 9).alias("auc"))


@_query(
    "roc_auc_negative_label",
    _area_sql("(select I2 as score, 1 - label as label from clicks)"),
)
def _(spark, sf_dir):
    """Label 0 taken as the positive one."""
    rows = clicks(spark, sf_dir).select(F.col("I2").alias("score"), LABEL)
    area = evaluate.roc_auc(rows, positive_label=0.0)
    return area.select(F.round("auc", 9).alias("auc"))


def _placed_sql(score: str, name: str) -> str:
    """Per distinct score the mean result of its rows against all rows of the other class."""
    return f"""{name}_points as (select {score} as s,
        sum(case when label = 1 then 1 else 0 end) as pos,
        sum(case when label <> 1 then 1 else 0 end) as neg from clicks group by 1),
    {name} as (select x.s,
        sum(case when y.s < x.s then y.neg when y.s = x.s then y.neg / 2.0::double else 0 end)
          / (select sum(neg) from {name}_points) as of_pos,
        sum(case when y.s > x.s then y.pos when y.s = x.s then y.pos / 2.0::double else 0 end)
          / (select sum(pos) from {name}_points) as of_neg
      from {name}_points x cross join {name}_points y group by x.s)"""


@_query(
    "roc_auc_variance",
    f"""with {_placed_sql("I2", "a")},
    placed as (select label, of_pos, of_neg from clicks join a on clicks.I2 = a.s)
    select round((avg(of_pos) filter (label = 1)), 9) as auc,
      round(1e6::double * ((var_samp(of_pos) filter (label = 1)) / (count(*) filter (label = 1))
        + (var_samp(of_neg) filter (label <> 1)) / (count(*) filter (label <> 1))), 6) as variance
    from placed""",
)
def _(spark, sf_dir):
    """Area of I2 as a score and a million times its variance."""
    rows = clicks(spark, sf_dir).select(F.col("I2").alias("score"), LABEL)
    return evaluate.auc_uncertainty(rows).select(
        F.round("auc", 9).alias("auc"), F.round(F.col("variance") * 1e6, 6).alias("variance")
    )


@_query(
    "roc_auc_difference",
    f"""with {_placed_sql("I2", "a")}, {_placed_sql("I8", "b")},
    placed as (select label, a.of_pos as a_pos, b.of_pos as b_pos, a.of_pos - b.of_pos as d_pos,
        a.of_neg - b.of_neg as d_neg
      from clicks join a on clicks.I2 = a.s join b on clicks.I8 = b.s)
    select round(avg(a_pos) filter (label = 1), 9) as auc_a,
      round(avg(b_pos) filter (label = 1), 9) as auc_b,
      round(avg(d_pos) filter (label = 1), 9) as difference,
      round(1e6::double * ((var_samp(d_pos) filter (label = 1)) / (count(*) filter (label = 1))
        + (var_samp(d_neg) filter (label <> 1)) / (count(*) filter (label <> 1))), 6) as variance
    from placed""",
)
def _(spark, sf_dir):
    """Areas of I2 and I8 on the same rows, their difference and its variance."""
    found = evaluate.compare_auc(clicks(spark, sf_dir), "I2", "I8")
    return found.select(
        *[F.round(name, 9).alias(name) for name in ("auc_a", "auc_b", "difference")],
        F.round(F.col("variance") * 1e6, 6).alias("variance"),
    )


_QUALITY_SQL = (
    "(select n_chars as score, quality as label from documents join labels using (doc_id))"
)


@_query("roc_curve_documents", _curve_sql(_QUALITY_SQL), on_clicks=False)
def _(spark, sf_dir):
    rows = _table(spark, sf_dir, "documents").join(_table(spark, sf_dir, "labels"), "doc_id")
    return _rounded_curve(evaluate.roc_curve(rows, "n_chars", "quality"))


@_query(
    "hard_auc",
    """with said as (select label, case when I2 >= 25 then 1 else 0 end as prediction from clicks)
    select round((sum(case when label = 1 and prediction = 1 then 1 else 0 end)::double
        / sum(case when label = 1 then 1 else 0 end)
      + sum(case when label = 0 and prediction = 0 then 1 else 0 end)::double
        / sum(case when label = 0 then 1 else 0 end)) / 2, 9) as auc from said""",
)
def _(spark, sf_dir):
    rows = clicks(spark, sf_dir).select(LABEL, (F.col("I2") >= 25).cast("int").alias("prediction"))
    area = evaluate.hard_auc(rows)
    return area.select(F.round("auc", 9).alias("auc"))


# --- models ---------------------------------------------------------------------------


def _trained(
    spark: SparkSession, sf_dir: str, models: tuple[str, ...], evaluated: bool = True, **options
) -> workflow.Run:
    train, test = _train_rows(clicks_with_keys(spark, sf_dir))
    return workflow.run(train, test, models, dataset_name="test", evaluated=evaluated, **options)


def _plain(predictions: DataFrame) -> DataFrame:
    """Predictions with vectors as arrays."""
    return predictions.select(
        LABEL,
        "prediction",
        F.round("score", 6).alias("score"),
        *[
            vector_to_array(name).alias(name)
            for name in ("features", "probability")
        ],
    )


@_query("lr_predictions")
def _(spark, sf_dir):
    return _plain(_trained(spark, sf_dir, ("lr",), False).predictions["lr"])


@_query("rf_predictions")
def _(spark, sf_dir):
    return _plain(_trained(spark, sf_dir, ("rf",), False).predictions["rf"])


@_query("predictions_preview")
def _(spark, sf_dir):
    """A look at 100 predictions of the forest; the limit is the feature."""
    shown = model.preview(_trained(spark, sf_dir, ("rf",), False).predictions["rf"])
    return shown.withColumns(
        {name: vector_to_array(name) for name in ("features", "probability")}
    )


@_query("model_roc_auc")
def _(spark, sf_dir):
    """Rows, areas and hard areas of both models on the test half."""
    run = _trained(spark, sf_dir, ("lr", "rf"))
    return run.evaluations["lr"].summary.unionAll(run.evaluations["rf"].summary)


@_query("model_roc_curve")
def _(spark, sf_dir):
    """ROC curve of the forest on the test half."""
    return _trained(spark, sf_dir, ("rf",)).evaluations["rf"].curve


@_query("model_roundtrip")
def _(spark, sf_dir):
    """Encoding and forest saved, loaded again and used on the test half."""
    train, test = _train_rows(clicks_with_keys(spark, sf_dir))
    encoding = encode.fit_features(train)
    features = materialize(encode.to_features(encoding, train), "train-features")
    forest = model.train_rf(features)
    path = _scratch(spark, "models")
    model.save_model(encoding, f"{path}/encoding")
    model.save_model(forest, f"{path}/forest")
    loaded = model.load_model(f"{path}/encoding")
    scored = model.score(model.load_model(f"{path}/forest"), encode.to_features(loaded, test))
    return scored.select(LABEL, "prediction", F.round("score", 6).alias("score"))


# --- models and evaluation that SQL can follow ----------------------------------------

def _binary_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    feature = F.expr(_BINARY).cast("double")
    return clicks(spark, sf_dir).select(
        F.col(LABEL).cast("double").alias(LABEL),
        array_to_vector(F.array(feature)).alias(encode.FEATURES),
    )


def _rates_by_value(scored: DataFrame, digits: int) -> DataFrame:
    value = vector_to_array(encode.FEATURES)[0].alias("value")
    return scored.groupBy(value).agg(
        F.count(F.lit(1)).alias("n_rows"), F.round(F.max("score"), digits).alias("score")
    )


def _rate_sql(digits: int) -> str:
    return (
        f"select ({_BINARY})::double as value, count(*)::bigint as n_rows, "
        f"round(avg(label), {digits}) as score from clicks group by 1"
    )


@_query("lr_rate_by_value", _rate_sql(4))
def _(spark, sf_dir):
    """Unregularised logistic regression on one yes/no feature."""
    rows = materialize(_binary_features(spark, sf_dir), "binary-features")
    fitted = model.train_lr(rows, max_iter=100, reg_param=0.0)
    return _rates_by_value(model.score(fitted, rows), 4)


def _stump(rows: DataFrame):
    return model.train_rf(rows, trees=1, depth=1, bootstrap=False)


@_query("rf_rate_by_value", _rate_sql(9))
def _(spark, sf_dir):
    """One tree of one split on all rows: its leaves are group rates."""
    rows = materialize(_binary_features(spark, sf_dir), "binary-features")
    return _rates_by_value(model.score(_stump(rows), rows), 9)


@_query("model_roundtrip_rates", _rate_sql(9))
def _(spark, sf_dir):
    """The same tree, saved and loaded again."""
    rows = materialize(_binary_features(spark, sf_dir), "binary-features")
    path = _scratch(spark, "models")
    model.save_model(_stump(rows), path)
    return _rates_by_value(model.score(model.load_model(path), rows), 9)


@_query(
    "model_roundtrip_scores",
    f"select count(*)::bigint as n_rows, 0::bigint as n_changed from clicks where not ({_TRAIN_SQL})",
)
def _(spark, sf_dir):
    """Scores of the real forest that change when it is saved and loaded: none."""
    train, test = _train_rows(clicks_with_keys(spark, sf_dir))
    encoding = encode.fit_features(train)
    forest = model.train_rf(materialize(encode.to_features(encoding, train), "train-features"))
    path = _scratch(spark, "models")
    model.save_model(encoding, f"{path}/encoding")
    model.save_model(forest, f"{path}/forest")
    features = encode.to_features(model.load_model(f"{path}/encoding"), test)
    once = model.score(forest, encode.to_features(encoding, test)).groupBy("score").count()
    again = model.score(model.load_model(f"{path}/forest"), features).groupBy("score").count()
    again = again.select(F.col("score").alias("other"), F.col("count").alias("n"))
    both = once.join(again, F.col("score") == F.col("other"), "full")
    n, m = F.coalesce("count", F.lit(0)), F.coalesce("n", F.lit(0))
    return both.agg(F.sum(n).alias("n_rows"), F.sum(F.abs(n - m)).alias("n_changed"))


@_query(
    "predictions_preview_rows",
    "select least(100, count(*))::bigint as n_rows, true as all_in_predictions from clicks",
)
def _(spark, sf_dir):
    """Every previewed row is one of the predictions; the limit is the feature."""
    rows = materialize(_binary_features(spark, sf_dir), "binary-features")
    scored = model.score(_stump(rows), rows)
    plain = [vector_to_array(encode.FEATURES)[0], LABEL, "prediction"]
    known = scored.select(*plain).distinct().withColumn("known", F.lit(True))
    shown = materialize(model.preview(scored), "preview").select(*plain)
    names = known.columns[:-1]
    found = shown.join(known, names, "left")
    return found.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.every(F.coalesce("known", F.lit(False))).alias("all_in_predictions"),
    )


def _half_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions that SQL can make as well: a price as the score, a quantity for the say."""
    return clicks(spark, sf_dir).select(
        F.coalesce("I3", F.lit(-1)).cast("double").alias("score"),
        (F.col("I2") >= 25).cast("double").alias("prediction"),
        LABEL,
    )


def _said_sql(positive: int) -> str:
    """Summary row of an evaluation."""
    return f"""with said as (select coalesce(I3, -1) as score, label,
        case when I2 >= 25 then 1 else 0 end as prediction from clicks)
    select 'm' as model, 'd' as dataset, count(*)::bigint as rows,
      sum(case when label = {positive} then 1 else 0 end)::bigint as positives,
      (select auc from ({_area_sql("said")})) as auc,
      round((sum(case when label = 1 and prediction = 1 then 1 else 0 end)::double
          / sum(case when label = 1 then 1 else 0 end)
        + sum(case when label = 0 and prediction = 0 then 1 else 0 end)::double
          / sum(case when label = 0 then 1 else 0 end)) / 2, 9) as hard_auc from said"""


@_query("evaluate_summary", _said_sql(1))
def _(spark, sf_dir):
    """The evaluation bundle on scores that SQL knows, cut into ranges of a thousand scores."""
    found = evaluate.evaluate(_half_scores(spark, sf_dir), "m", "d", scores_per_task=1000)
    return found.summary.withColumns(
        {name: F.round(name, 9) for name in ("auc", "hard_auc")}
    )


@_query("evaluate_curve", _curve_sql(_SCORED_SQL))
def _(spark, sf_dir):
    found = evaluate.evaluate(_half_scores(spark, sf_dir), "m", "d", scores_per_task=1000)
    return _rounded_curve(found.curve)


@_query(
    "model_roc_auc_checks",
    f"""select name as model, count(*)::bigint as rows, sum(label)::bigint as positives,
      true as auc_agrees, true as hard_auc_agrees
    from clicks, (select unnest(['LogisticRegression', 'RandomForestOfRegressionTrees']) as name)
    where not ({_TRAIN_SQL}) group by name""",
)
def _(spark, sf_dir):
    """Areas of both real models against Spark's own evaluator and the closed form."""
    run = _trained(spark, sf_dir, ("lr", "rf"), scores_kept=True)
    checks = None
    for short in ("lr", "rf"):
        scored = run.scores[short]
        theirs = BinaryClassificationEvaluator(
            rawPredictionCol="score", labelCol=LABEL, numBins=0
        ).evaluate(scored)
        hard = evaluate.hard_auc(scored).select(F.col("auc").alias("closed"))
        # One row on either side.
        row = run.evaluations[short].summary.crossJoin(hard).select(
            "model",
            "rows",
            "positives",
            (F.abs(F.col("auc") - theirs) < 1e-9).alias("auc_agrees"),
            (F.abs(F.col("hard_auc") - F.col("closed")) < 1e-9).alias("hard_auc_agrees"),
        )
        checks = row if checks is None else checks.unionAll(row)
    return checks


@_query(
    "model_roc_curve_checks",
    """select true as starts_at_origin, true as ends_at_one, true as rises, true as area_agrees
    from (select 1)""",
    on_clicks=False,
)
def _(spark, sf_dir):
    """The curve of the real forest: ends, rise, and the area below it."""
    found = _trained(spark, sf_dir, ("rf",)).evaluations["rf"]
    # A forest has few distinct scores.
    before = Window.orderBy(F.desc("threshold"))
    points = found.curve.select(
        "fpr",
        "tpr",
        F.lag("fpr").over(before).alias("fpr_before"),
        F.lag("tpr").over(before).alias("tpr_before"),
    )
    strip = (F.col("fpr") - F.col("fpr_before")) * (F.col("tpr") + F.col("tpr_before")) / 2
    rising = F.col("fpr_before").isNull() | (
        (F.col("fpr") >= F.col("fpr_before")) & (F.col("tpr") >= F.col("tpr_before"))
    )
    first = F.col("fpr_before").isNull()
    checks = points.agg(
        F.every(~first | ((F.col("fpr") == 0) & (F.col("tpr") == 0))).alias("starts_at_origin"),
        ((F.max("fpr") == 1) & (F.max("tpr") == 1)).alias("ends_at_one"),
        F.every(rising).alias("rises"),
        F.sum(strip).alias("area"),
    )
    area = found.summary.select("auc")
    # One row on either side.
    return checks.crossJoin(area).select(
        "starts_at_origin",
        "ends_at_one",
        "rises",
        (F.abs(F.col("area") - F.col("auc")) < 1e-9).alias("area_agrees"),
    )
