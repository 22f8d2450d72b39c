"""Workload telemetry on the events table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions import statements
from quern.functions.numeric import cents, sum_amount
from quern.functions.xml import escape, event_xml
from quern.operators.filters import text_prefix, text_suffix
from quern.plans import telemetry
from quern.plans.registry import query
from quern.plans.telemetry import BATCH_EVENT, CALL_EVENT
from quern.session import shared_folder
from quern.sources.event_files import read_event_lines, write_event_lines
from quern.sources.tables import Tables
from quern.streaming.event_session import EventSession
from quern.streaming import quarantine
from quern.streaming.live_view import LiveView
from quern.streaming.tiered_view import TieredView


def _as_events(t: Tables) -> tuple[DataFrame, Column, dict[str, Column]]:
    """The events table in the shape of captured statements."""
    call = F.col("event_type").eqNullSafe("purchase")
    text = F.concat(F.lit("SELECT a < 1 & b > 2 -- "), F.col("props"))
    duration = cents(F.col("value"))
    fields = {
        "duration": duration,
        "physical_reads": F.when(F.col("event_type") != "signup", F.col("user_id")),
        "logical_reads": F.col("event_id"),
        "cpu_time": F.floor(duration / 10).cast("bigint"),
        "batch_text": F.when(~call, text),
        "statement": F.when(call, text),
        "query_hash": F.upper(F.left(F.md5("event_type"), F.lit(16))),
        "query_plan_hash": F.upper(F.left(F.md5("props"), F.lit(16))),
    }
    name = F.when(call, F.lit(CALL_EVENT)).otherwise(F.lit(BATCH_EVENT))
    return t.events, name, fields


def _event_files(spark: SparkSession, t: Tables) -> str:
    rows, name, fields = _as_events(t)
    return write_event_lines(rows, shared_folder(spark, "event-lines"), name, fields)


_SHRED_SQL = """
    SELECT CASE WHEN event_type = 'purchase' THEN 'rpc_completed'
                ELSE 'sql_batch_completed' END AS event_name,
           CAST(round(value * 100) AS BIGINT) AS duration,
           CASE WHEN event_type <> 'signup' THEN user_id END AS physical_reads,
           event_id AS logical_reads,
           CAST(round(value * 100) AS BIGINT) // 10 AS cpu_time,
           'SELECT a < 1 & b > 2 -- ' || props AS sql_text,
           upper(left(md5(event_type), 16)) AS query_hash,
           upper(left(md5(props), 16)) AS query_plan_hash
    FROM events
"""


def _hashes_as_text(events: DataFrame) -> DataFrame:
    return events.withColumn("query_hash", F.hex("query_hash")).withColumn(
        "query_plan_hash", F.hex("query_plan_hash")
    )


@query(_SHRED_SQL)
def xe_shred(spark: SparkSession, t: Tables) -> DataFrame:
    payloads = read_event_lines(spark, _event_files(spark, t))
    return _hashes_as_text(telemetry.shred_events(payloads))


@query(f"SELECT * FROM ({_SHRED_SQL}) WHERE duration > 500 AND event_name = 'sql_batch_completed'")
def event_stream(spark: SparkSession, t: Tables) -> DataFrame:
    """The same events, captured by a session as the files arrive."""
    session = EventSession(
        spark,
        "quern_events",
        _event_files(spark, t),
        shared_folder(spark, "captured"),
        shared_folder(spark, "captured-checkpoint"),
        bytes_per_batch=1 << 40,
        events=[BATCH_EVENT],
        where=F.col("duration") > 500,
    )
    session.start(available_now=True).awaitTermination()
    return _hashes_as_text(session.captured())


@query(
    """
    SELECT event_type, count(*) AS n_rows,
           CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS sum_cents
    FROM events GROUP BY event_type
    """
)
def agg_view_stream(spark: SparkSession, t: Tables) -> DataFrame:
    """The view over events, filled from a stream of the table's own files."""
    rows = (
        spark.readStream.schema("event_type string, value double")
        .option("maxBytesPerTrigger", 1 << 40)
        .parquet(f"{t.folder}/events*.parquet")  # one file, or a folder of files
    )
    view = LiveView(
        spark,
        shared_folder(spark, "live-view"),
        ["event_type"],
        {"sum_cents": cents(F.col("value"))},
    )
    checkpoint = shared_folder(spark, "live-view-checkpoint")
    view.start(rows, checkpoint, available_now=True).awaitTermination()
    return view.read()


@query(
    """
    WITH e AS (SELECT event_type, props, CAST(round(value * 100) AS BIGINT) AS duration,
                      CASE WHEN event_type <> 'signup' THEN user_id END AS physical_reads,
                      event_id AS logical_reads FROM events)
    SELECT event_type, props, count(*) AS executions,
           CAST(sum(duration) AS BIGINT) AS duration_total,
           CAST(sum(duration // 10) AS BIGINT) AS cpu_total,
           CAST(sum(logical_reads) AS BIGINT) AS logical_total,
           CAST(sum(physical_reads) AS BIGINT) AS physical_total,
           CAST(sum(duration) AS BIGINT) // count(duration) AS duration_avg
    FROM e GROUP BY event_type, props
    """
)
def workload_rollup(spark: SparkSession, t: Tables) -> DataFrame:
    rows, _, fields = _as_events(t)
    measures = [fields[m].alias(m) for m in telemetry.MEASURES]
    return telemetry.workload_rollup(
        rows.select("event_type", "props", *measures), ["event_type", "props"]
    )


@query(
    """
    SELECT user_id, c_name AS text, executions, total_value
    FROM (SELECT user_id, count(*) AS executions,
                 CAST(sum(CAST(round(value * 100) AS BIGINT)) / 100.0 AS DECIMAL(28,2))
                     AS total_value
          FROM events GROUP BY user_id)
    JOIN customer ON c_custkey = user_id
    """
)
def apply_lookup(spark: SparkSession, t: Tables) -> DataFrame:
    texts = t.customer.select("c_custkey", F.col("c_name").alias("text"))
    sums = {
        "executions": F.count(F.lit(1)),
        "total_value": sum_amount(F.col("value")),
    }
    on = F.col("user_id") == F.col("c_custkey")
    return telemetry.cost_with_text(t.events, "user_id", sums, texts, on).drop("c_custkey")


@query(
    """
    SELECT c_name AS text, executions
    FROM (SELECT user_id, count(*) AS executions FROM events GROUP BY user_id)
    JOIN customer ON c_custkey = user_id
    WHERE c_name LIKE 'Customer#00000001%' OR c_name LIKE '%99'
    """
)
def reuse_by_text(spark: SparkSession, t: Tables) -> DataFrame:
    texts = t.customer.select("c_custkey", F.col("c_name").alias("text"))
    on = F.col("user_id") == F.col("c_custkey")
    usage = telemetry.cost_with_text(
        t.events, "user_id", {"executions": F.count(F.lit(1))}, texts, on
    )
    wanted = text_prefix(F.col("text"), "Customer#00000001") | text_suffix(
        F.col("text"), "99"
    )
    return usage.filter(wanted).select("text", "executions")


@query(
    """
    SELECT event_id, user_id, c_name AS text, executions, total_value
    FROM events
    JOIN (SELECT props AS plan_hash, count(*) AS executions,
                 CAST(sum(CAST(round(value * 100) AS BIGINT)) / 100.0 AS DECIMAL(28,2))
                     AS total_value
          FROM events GROUP BY props) ON props = plan_hash
    JOIN customer ON c_custkey = user_id
    """
)
def planhash_rollup(spark: SparkSession, t: Tables) -> DataFrame:
    sums = {
        "executions": F.count(F.lit(1)),
        "total_value": sum_amount(F.col("value")),
    }
    members = telemetry.plan_hash_rollup(t.events, "props", ["event_id", "user_id"], sums)
    return members.join(t.customer, F.col("user_id") == F.col("c_custkey")).select(
        "event_id", "user_id", F.col("c_name").alias("text"), "executions", "total_value"
    )


_STATEMENT_SQL = r"""
    SELECT CASE WHEN o_orderkey % 2 = 0
           THEN 'SELECT * FROM orders WHERE custkey = ' || o_custkey
                || ' AND status = ''' || o_orderstatus || ''''
           ELSE 'select *  from Orders where CustKey = ' || o_custkey
                || ' and  status = ''' || o_orderpriority || ''''
           END AS stmt FROM orders
    UNION ALL
    SELECT 'SELECT name FROM part WHERE size = ' || p_size FROM part
"""


@query(
    rf"""
    SELECT md5(template) AS fingerprint, template, count(*) AS executions
    FROM (SELECT regexp_replace(regexp_replace(regexp_replace(lower(trim(stmt)),
              '''[^'']*''', '?', 'g'), '\b[0-9]+(\.[0-9]+)?\b', '?', 'g'), '\s+', ' ', 'g')
              AS template
          FROM ({_STATEMENT_SQL}))
    GROUP BY template
    """
)
def query_template(spark: SparkSession, t: Tables) -> DataFrame:
    customer = F.col("o_custkey").cast("string")
    quote = F.lit("'")
    upper = F.concat(
        F.lit("SELECT * FROM orders WHERE custkey = "), customer,
        F.lit(" AND status = "), quote, F.col("o_orderstatus"), quote,
    )
    mixed = F.concat(
        F.lit("select *  from Orders where CustKey = "), customer,
        F.lit(" and  status = "), quote, F.col("o_orderpriority"), quote,
    )
    of_orders = t.orders.select(
        F.when(F.col("o_orderkey") % 2 == 0, upper).otherwise(mixed).alias("stmt")
    )
    of_parts = t.part.select(
        F.concat(
            F.lit("SELECT name FROM part WHERE size = "), F.col("p_size").cast("string")
        ).alias("stmt")
    )
    return telemetry.statement_templates(of_orders.unionByName(of_parts), "stmt")


@query(
    """
    SELECT w.event_id AS waiter_id, w.user_id AS waiter_user, b.event_id AS blocker_id,
           c_name AS blocker_text
    FROM events w
    LEFT JOIN events b ON b.event_id = w.event_id - 1 AND b.event_type = 'view'
    LEFT JOIN customer ON c_custkey = b.user_id
    WHERE w.event_type = 'error'
    """
)
def blocking_pairs(spark: SparkSession, t: Tables) -> DataFrame:
    kind = F.col("event_type")
    waiters = t.events.filter(kind == "error").select(
        F.col("event_id").alias("waiter_id"),
        F.col("user_id").alias("waiter_user"),
        (F.col("event_id") - 1).alias("blocker_ref"),
    )
    blockers = t.events.filter(kind == "view").select(
        F.col("event_id").alias("blocker_id"), F.col("user_id").alias("text_ref")
    )
    texts = t.customer.select(
        F.col("c_custkey").alias("text_id"), F.col("c_name").alias("blocker_text")
    )
    return telemetry.blocking_pairs(waiters, blockers, texts).select(
        "waiter_id", "waiter_user", "blocker_id", "blocker_text"
    )


# Forms of a few statements, in SQL that both engines read; chr(39) is a quote.
_FORMS_SQL = """
    SELECT CASE o_orderkey % 7
        WHEN 0 THEN 'SELECT * FROM Orders WHERE [CustKey] = ' || o_custkey || ' AND status = '
            || chr(39) || o_orderstatus || chr(39) || ' -- one line'
        WHEN 1 THEN 'select *  from orders where custkey = @c and  status = @s'
        WHEN 2 THEN '(@c int, @s varchar(10))SELECT * FROM orders WHERE custkey = @c AND status = @s'
        WHEN 3 THEN 'SELECT /* a * b */ * FROM "orders" WHERE custkey = -' || o_custkey
            || ' AND status = N' || chr(39) || 'it' || chr(39) || chr(39) || 's '
            || o_orderpriority || chr(39) || ';'
        WHEN 4 THEN 'SELECT name FROM part WHERE size IN (' || o_custkey || ', ' || o_orderkey || ')'
        WHEN 5 THEN 'SELECT name FROM part WHERE size IN (0xAF)'
        ELSE 'INSERT INTO [my parts] VALUES (' || o_custkey || ', 1e5), (' || o_orderkey || ', .5)'
        END AS stmt FROM {orders}
"""


def _template_sql(source: str) -> str:
    token, name = statements.TOKEN.replace("'", "''"), statements._PLAIN_NAME.replace("'", "''")
    value = statements._VALUE.replace("'", "''")
    text = "array_to_string(list_transform(t, lambda x: " + (
        f"CASE WHEN regexp_full_match(x, '{value}') THEN '?' "
        f"WHEN regexp_full_match(x, '{name}') THEN lower(regexp_extract(x, '{name}', 1)) "
        "ELSE lower(x) END), ' ')"
    )
    for pattern, replacement in statements.REWRITES:
        pattern = pattern.replace("'", "''")
        text = f"regexp_replace({text}, '{pattern}', '{replacement.replace('$', chr(92))}', 'g')"
    return f"""
    SELECT md5(template) AS fingerprint, template, CAST(sum(n) AS BIGINT) AS executions,
           count(*) AS texts
    FROM (SELECT {text} AS template, n FROM (
        SELECT list_filter(regexp_extract_all(stmt, '({token})', 1),
                   lambda x: NOT (starts_with(x, '--') OR starts_with(x, '/*'))) AS t, n
        FROM (SELECT stmt, count(*) AS n FROM ({source}) GROUP BY stmt)))
    GROUP BY template
    """


@query(_template_sql(_FORMS_SQL.format(orders="orders")))
def template_rollup(spark: SparkSession, t: Tables) -> DataFrame:
    forms = spark.sql(_FORMS_SQL, orders=t.orders)
    return telemetry.template_rollup(forms, "stmt")


@query(
    f"""
    SELECT 'captured' AS outcome, CASE WHEN event_type = 'purchase' THEN 'rpc_completed'
               ELSE 'sql_batch_completed' END AS detail, count(*) AS n_lines
    FROM events WHERE event_id % 10 NOT IN (1, 2, 3, 4) GROUP BY ALL
    UNION ALL
    SELECT 'quarantined', CASE event_id % 10 WHEN 1 THEN '{quarantine.BROKEN}'
               WHEN 2 THEN '{quarantine.NAMELESS}' WHEN 3 THEN '{quarantine.MISTYPED}'
               ELSE '{quarantine.EMPTY}' END, count(*)
    FROM events WHERE event_id % 10 IN (1, 2, 3, 4) GROUP BY ALL
    """
)
def event_quarantine(spark: SparkSession, t: Tables) -> DataFrame:
    """Events of which some lines were cut off, lost their name, type or content."""
    rows, name, fields = _as_events(t)
    kind = F.col("event_id") % 10
    texts = ("batch_text", "statement", "query_hash", "query_plan_hash")
    nodes = {f: escape(v) if f in texts else v.cast("string") for f, v in fields.items()}
    nodes["logical_reads"] = F.when(kind == 3, F.lit("many")).otherwise(nodes["logical_reads"])
    line = event_xml(escape(name), nodes)
    broken = (
        F.when(kind == 1, F.left(line, F.lit(30)))
        .when(kind == 2, F.regexp_replace(line, '^<event name="[^"]*">', "<event>"))
        .when(kind == 4, F.lit(""))
        .otherwise(line)
    )
    lines = shared_folder(spark, "mixed-lines")
    rows.select(broken.alias("value")).write.text(lines)
    session = quarantine.QuarantineSession(
        spark, "quern_quarantine", lines, shared_folder(spark, "mixed-captured"),
        shared_folder(spark, "mixed-checkpoint"), bytes_per_batch=1 << 40,
    )
    session.start(available_now=True).awaitTermination()
    good = session.captured().select(F.lit("captured").alias("outcome"), F.col("event_name").alias("detail"))
    bad = session.quarantined().select(F.lit("quarantined").alias("outcome"), F.col("reason").alias("detail"))
    return good.unionByName(bad).groupBy("outcome", "detail").agg(F.count(F.lit(1)).alias("n_lines"))


@query(
    """
    SELECT user_id, count(*) AS n_rows,
           CAST(sum(coalesce(CAST(round(value * 100) AS BIGINT), 0)) AS BIGINT) AS sum_cents
    FROM events GROUP BY user_id
    """
)
def agg_view_tiered(spark: SparkSession, t: Tables) -> DataFrame:
    """The events per user in ten micro-batches, whose parts are merged on the way."""
    view = TieredView(
        spark, shared_folder(spark, "tiered-view"), ["user_id"],
        {"sum_cents": F.coalesce(cents(F.col("value")), F.lit(0))}, fan=4,
    )
    rows = t.events.select("event_id", "user_id", "value")
    for batch in range(10):
        view.add(rows.filter(F.pmod("event_id", F.lit(10)) == batch), batch)
    return view.read()
