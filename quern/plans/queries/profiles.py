"""Column profiles and storage layout."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.operators import layout
from quern.operators.aggregates import (
    column_profile as profile,
    predicate_share as shares,
    value_histogram,
)
from quern.operators.histograms import step_histogram as steps_of
from quern.operators.sketches import DISTINCT_ERROR, RANK_ERROR, SketchStore
from quern.operators.zorder import write_clustered
from quern.plans.registry import query
from quern.session import materialize, shared_folder
from quern.sources.tables import Tables


def _profile_sql(column: str, label: str, source: str, quantiles: bool) -> str:
    marks = [
        f"CAST(quantile_disc({column}, {q}) AS DOUBLE)" if quantiles else "CAST(NULL AS DOUBLE)"
        for q in (0.25, 0.5, 0.75)
    ]
    return f"""
    SELECT '{label}' AS profile, '{column}' AS column_name, count(*) AS n_rows,
           count(*) - count({column}) AS n_nulls,
           CAST((count(*) - count({column}))::DOUBLE / count(*) AS DECIMAL(18,8)) AS null_share,
           count(DISTINCT {column}) AS n_distinct,
           CAST(1.0::DOUBLE / count(DISTINCT {column}) AS DECIMAL(18,8)) AS density,
           CAST(min({column}) AS VARCHAR) AS lowest, CAST(max({column}) AS VARCHAR) AS highest,
           {marks[0]} AS q25, {marks[1]} AS q50, {marks[2]} AS q75
    FROM {source}
    """


_STATUS = "(SELECT nullif(o_orderstatus, 'P') AS status, o_orderpriority FROM orders)"


@query(
    " UNION ALL ".join(
        [
            _profile_sql("p_size", "all", "part", True),
            _profile_sql("p_name", "all", "part", False),
            _profile_sql("status", "all", _STATUS, False),
            _profile_sql("o_orderpriority", "all", _STATUS, False),
            _profile_sql("status", "set", f"{_STATUS} WHERE status IS NOT NULL", False),
        ]
    )
)
def column_profile(spark: SparkSession, t: Tables) -> DataFrame:
    statuses = t.orders.select(
        F.nullif("o_orderstatus", F.lit("P")).alias("status"), "o_orderpriority"
    )
    whole = profile(t.part, ["p_size", "p_name"]).unionByName(
        profile(statuses, ["status", "o_orderpriority"])
    )
    filtered = profile(statuses, ["status"], where=F.col("status").isNotNull())
    both = whole.withColumn("profile", F.lit("all")).unionByName(
        filtered.withColumn("profile", F.lit("set"))
    )
    marks = [F.get("quantiles", F.lit(i)).alias(n) for i, n in enumerate(("q25", "q50", "q75"))]
    return both.select("*", *marks).drop("quantiles")


@query(
    """
    SELECT *, CAST(first_rows::DOUBLE / n_rows AS DECIMAL(18,8)) AS first_share,
           CAST(second_rows::DOUBLE / n_rows AS DECIMAL(18,8)) AS second_share,
           CAST(both_rows::DOUBLE / n_rows AS DECIMAL(18,8)) AS both_share
    FROM (SELECT count(*) AS n_rows,
                 count(*) FILTER (p_type = 'SMALL') AS first_rows,
                 count(*) FILTER (p_size > 15) AS second_rows,
                 count(*) FILTER (p_type = 'SMALL' AND p_size > 15) AS both_rows
          FROM part)
    """
)
def predicate_share(spark: SparkSession, t: Tables) -> DataFrame:
    return shares(t.part, F.col("p_type") == "SMALL", F.col("p_size") > 15)


@query(
    """
    WITH b AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem)
    SELECT CAST(least(floor(20 * (l_extendedprice - lo) / (hi - lo)) + 1, 20) AS INTEGER)
               AS bin,
           count(*) AS n_rows, count(DISTINCT l_extendedprice) AS n_distinct,
           min(l_extendedprice) AS lowest, max(l_extendedprice) AS highest
    FROM lineitem, b WHERE l_extendedprice IS NOT NULL GROUP BY 1
    """
)
def column_histogram(spark: SparkSession, t: Tables) -> DataFrame:
    return value_histogram(t.lineitem, "l_extendedprice", 20)


@query("SELECT o_custkey, o_orderkey, o_orderdate FROM orders")
def layout_sorted(spark: SparkSession, t: Tables) -> DataFrame:
    rows = t.orders.select("o_custkey", "o_orderkey", "o_orderdate")
    return layout.write_ordered(
        rows,
        shared_folder(spark, "orders-by-customer"),
        ["o_custkey"],
        spread_by=["o_orderkey"],
        compression="zstd",
    )


@query(
    """
    SELECT o_orderstatus, o_orderkey, o_orderdate FROM orders WHERE o_orderstatus <> 'P'
    """
)
def covering_extract(spark: SparkSession, t: Tables) -> DataFrame:
    return layout.covering_extract(
        t.orders,
        ["o_orderstatus"],
        ["o_orderkey", "o_orderdate"],
        shared_folder(spark, "orders-extract"),
        where=F.col("o_orderstatus") != "P",
    )


@query(
    """
    SELECT l_returnflag, count(*) AS n_rows,
           CASE WHEN l_returnflag = 'R' THEN 'rebuild' ELSE 'keep' END AS first_action,
           'keep' AS second_action
    FROM lineitem GROUP BY l_returnflag
    """
)
def layout_report(spark: SparkSession, t: Tables) -> DataFrame:
    """Report on a table with one shredded partition, before and after compaction.

    The number of its files follows the session's shuffle partitions, so it grows with
    the data; the others have files of the target size or more.  The target is at least
    four times a file of the shredded part.
    """
    path = shared_folder(spark, "lines-by-flag")
    columns = ["l_orderkey", "l_partkey", "l_quantity", "l_returnflag"]
    lines, flag = t.lineitem.select(*columns), F.col("l_returnflag")
    kind = lines.select("l_returnflag").schema

    def write(files: list[tuple]) -> DataFrame:
        if files:
            pieces = layout.dealt_pieces(lines, "l_returnflag", files, kind)
            with layout.unsorted_files(spark):
                pieces.write.mode("append").partitionBy("l_returnflag").parquet(path)
        return spark.read.schema(lines.schema).parquet(path)

    parallel = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shredded = write([("R", max(12, 2 * parallel))])
    made = layout.file_sizes(shredded, "l_returnflag").agg(
        F.avg("bytes").alias("average"), (F.sum("bytes") / F.sum("n_rows")).alias("width")
    ).first()
    target = max(layout.TARGET_BYTES, int(4 * (made["average"] or 0)))
    in_file = target / (made["width"] or 24)  # rows; three columns of 8 bytes if none is known
    counts = lines.filter(~flag.eqNullSafe("R")).groupBy(flag).count().collect()
    stored = write([(v, max(1, int(n / in_file))) for v, n in counts])
    before = layout.layout_report(stored, "l_returnflag", target).select(
        F.col("l_returnflag").alias("flag"), F.col("action").alias("first_action")
    )
    before = materialize(before, "layout-report")
    layout.compact(stored, path, "l_returnflag", target)
    after = layout.layout_report(write([]), "l_returnflag", target)
    return after.join(before, F.col("l_returnflag").eqNullSafe(F.col("flag"))).select(
        "l_returnflag", "n_rows", "first_action", F.col("action").alias("second_action")
    )


def _steps_sql(column: str, source: str, steps: int) -> str:
    return f"""
    WITH c AS (SELECT {column} AS v, count(*) AS n FROM {source} GROUP BY 1),
    k AS (SELECT v, n, sum(n) OVER (ORDER BY v) AS upto, sum(n) OVER () AS total
          FROM c WHERE v IS NOT NULL),
    b AS (SELECT v, n, (upto - 1) * {steps} // total AS part, n * {steps} >= total AS own FROM k),
    g AS (SELECT *, NOT own AND coalesce(v > max(CASE WHEN own THEN v END)
                 OVER (PARTITION BY part), false) AS after FROM b),
    s AS (SELECT max(v) AS range_hi_key, arg_max(n, v) AS equal_rows, sum(n) AS n_rows,
                 count(*) - 1 AS distinct_range_rows FROM g GROUP BY part, after
          UNION ALL SELECT v, n, n, 0 FROM c WHERE v IS NULL)
    SELECT CAST(row_number() OVER (ORDER BY range_hi_key NULLS FIRST) AS INTEGER) AS step,
           range_hi_key, equal_rows, CAST(n_rows - equal_rows AS BIGINT) AS range_rows,
           distinct_range_rows,
           CAST((n_rows - equal_rows)::DOUBLE / nullif(distinct_range_rows, 0) AS DECIMAL(18,8))
               AS avg_range_rows
    FROM s
    """


@query(_steps_sql("l_partkey", "lineitem", 200))
def step_histogram(spark: SparkSession, t: Tables) -> DataFrame:
    return steps_of(t.lineitem, "l_partkey")


@query(_steps_sql("o_orderpriority", "orders", 3))
def step_histogram_text(spark: SparkSession, t: Tables) -> DataFrame:
    """Few values: each has more rows than a third of an even part, or shares a step."""
    return steps_of(t.orders, "o_orderpriority", 3)


_SKETCHED = ("l_partkey", "l_extendedprice", "l_returnflag")


@query(
    " UNION ALL ".join(
        f"""
        SELECT '{c}' AS column_name, count(*) AS n_rows, count(*) - count({c}) AS n_nulls,
               count(DISTINCT {c}) AS distinct_values, true AS distinct_within, true AS median_within
        FROM lineitem
        """
        for c in _SKETCHED
    )
)
def sketch_profile(spark: SparkSession, t: Tables) -> DataFrame:
    """States of four batches of lines, united, and held against exact counts.

    The estimates have to lie within four standard errors, and the median's true ranks
    within the rank error.
    """
    store = SketchStore(spark, shared_folder(spark, "sketches"), _SKETCHED)
    lines = t.lineitem.select("l_orderkey", *_SKETCHED)
    for batch in range(4):
        part = F.coalesce(F.pmod("l_orderkey", F.lit(4)), F.lit(0)) == batch
        store.add(lines.filter(part), batch)
    report = materialize(store.report([0.5]), "sketch-report")
    checks = []
    for name in _SKETCHED:
        of_column = report.filter(F.col("column_name") == name)
        median = of_column.select(F.get("quantiles", F.lit(0))).scalar()
        counted = lines.groupBy(F.col(name).alias("v")).agg(F.count(F.lit(1)).alias("n"))
        known = F.col("v").isNotNull()
        numeric = name != "l_returnflag"
        below = F.sum(F.when(F.col("v") < F.col("m"), F.col("n")).otherwise(0)) if numeric else F.lit(0)
        upto = F.sum(F.when(F.col("v") <= F.col("m"), F.col("n")).otherwise(0)) if numeric else F.lit(0)
        checks.append(
            counted.withColumn("m", median).agg(
                F.lit(name).alias("name"),
                F.count_if(known).alias("distinct_values"),
                F.sum(F.when(known, F.col("n")).otherwise(0)).alias("known"),
                below.cast("bigint").alias("below"),
                upto.cast("bigint").alias("upto"),
                F.lit(numeric).alias("numeric"),
            )
        )
    exact = checks[0].unionByName(checks[1]).unionByName(checks[2])
    error = F.abs(F.col("distinct_estimate") - F.col("distinct_values"))
    low, high = F.col("known") * (0.5 - RANK_ERROR), F.col("known") * (0.5 + RANK_ERROR)
    return report.join(exact, F.col("column_name") == F.col("name")).select(
        "column_name",
        "n_rows",
        "n_nulls",
        "distinct_values",
        (error <= F.col("distinct_values") * (4 * DISTINCT_ERROR) + 1).alias("distinct_within"),
        (~F.col("numeric") | ((F.col("below") <= high) & (F.col("upto") >= low))).alias(
            "median_within"
        ),
    )


@query("SELECT l_partkey, l_suppkey, l_shipdate, l_orderkey FROM lineitem")
def layout_clustered(spark: SparkSession, t: Tables) -> DataFrame:
    """Lines clustered by part, supplier and date at once."""
    return write_clustered(
        t.lineitem.select("l_partkey", "l_suppkey", "l_shipdate", "l_orderkey"),
        shared_folder(spark, "lines-clustered"),
        ["l_partkey", "l_suppkey", "l_shipdate"],
        spread_by=["l_orderkey"],
    )
