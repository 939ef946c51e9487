"""SELECT results: statements of each SQL category, the result cache and its expiry.

The statements aggregate or rank partially before any shuffle, so that one hot
key does not gather its rows in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stowage import Warehouse
from stowage.plans.registry import (
    cents,
    exact_sum,
    in_units,
    open_warehouse,
    query,
    without_brackets,
)

HOUR_MS = 3_600_000

GROUP = f"""
SELECT event_type, COUNT(*) AS n, COUNT(DISTINCT user_id) AS users,
       {exact_sum("value")} AS total, MAX(value) AS top
FROM [src.events] GROUP BY event_type
"""


@query(without_brackets(GROUP))
def select_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grouping; the table is named with its project."""
    wh = open_warehouse(spark, sf_dir, "events")
    return wh.run_select(GROUP.replace("[src.", f"[{wh.project}:src."))


JOIN = f"""
SELECT n.n_name, c.c_mktsegment, SUM(o.orders) AS orders, {in_units("SUM(o.spent)")} AS spent
FROM (
  SELECT o_custkey, COUNT(*) AS orders, SUM({cents("o_totalprice")}) AS spent
  FROM [src.orders] GROUP BY o_custkey
) o
JOIN [src.customer] c ON c.c_custkey = o.o_custkey
JOIN [src.nation] n ON n.n_nationkey = c.c_nationkey
GROUP BY n.n_name, c.c_mktsegment
"""


@query(without_brackets(JOIN).replace("SUM(o.orders)", "CAST(SUM(o.orders) AS BIGINT)"))
def select_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Joins; orders are summed per customer before they meet the customers."""
    return open_warehouse(spark, sf_dir, "orders", "customer", "nation").run_select(JOIN)


SEMI_ANTI = """
SELECT c_custkey, c_name, 'big' AS kind FROM [src.customer] c
LEFT SEMI JOIN (SELECT DISTINCT o_custkey FROM [src.orders] WHERE o_totalprice > 450000) o
  ON o.o_custkey = c.c_custkey
UNION ALL
SELECT c_custkey, c_name, 'none' AS kind FROM [src.customer] c
LEFT ANTI JOIN (SELECT DISTINCT o_custkey FROM [src.orders]) o ON o.o_custkey = c.c_custkey
"""


@query("""
SELECT c_custkey, c_name, 'big' AS kind FROM customer c WHERE EXISTS (
  SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_totalprice > 450000)
UNION ALL
SELECT c_custkey, c_name, 'none' AS kind FROM customer c WHERE NOT EXISTS (
  SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey)
""")
def select_semi_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Semi and anti joins against keys made distinct first."""
    return open_warehouse(spark, sf_dir, "orders", "customer").run_select(SEMI_ANTI)


FINEST = f"""
SELECT l_returnflag, l_linestatus, COUNT(*) AS n, SUM({cents("l_extendedprice")}) AS price
FROM [src.lineitem] GROUP BY l_returnflag, l_linestatus
"""
MEASURES = f"SUM(n) AS n, {in_units('SUM(price)')} AS price"
FROM_FINEST = f"SELECT l_returnflag, l_linestatus, {MEASURES} FROM ({FINEST}) f GROUP BY"
FROM_LINES = f"""
SELECT l_returnflag, l_linestatus, COUNT(*) AS n, {exact_sum("l_extendedprice")} AS price
FROM lineitem GROUP BY"""
ROLLUP = "ROLLUP (l_returnflag, l_linestatus)"
CUBE = "CUBE (l_returnflag, l_linestatus)"
SETS = "GROUPING SETS ((l_returnflag), (l_linestatus), ())"


@query(f"{FROM_LINES} {ROLLUP}")
def select_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rolled up from the finest groups, so that the lines themselves are not multiplied."""
    return open_warehouse(spark, sf_dir, "lineitem").run_select(f"{FROM_FINEST} {ROLLUP}")


@query(f"{FROM_LINES} {CUBE}")
def select_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    return open_warehouse(spark, sf_dir, "lineitem").run_select(f"{FROM_FINEST} {CUBE}")


@query(f"{FROM_LINES} {SETS}")
def select_grouping_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return open_warehouse(spark, sf_dir, "lineitem").run_select(f"{FROM_FINEST} {SETS}")


WINDOW = """
SELECT o_custkey, o_orderkey, o_totalprice, CAST(place AS BIGINT) AS place FROM (
  SELECT o_custkey, o_orderkey, o_totalprice,
         RANK() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS place
  FROM [src.orders]
) ranked WHERE place <= 3
"""


@query(without_brackets(WINDOW))
def select_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranks without ties: each task passes on at most three orders per customer."""
    return open_warehouse(spark, sf_dir, "orders").run_select(WINDOW)


RUNNING = """
SELECT event_type, day, n, SUM(n) OVER (PARTITION BY event_type ORDER BY day) AS so_far
FROM (
  SELECT event_type, CAST(ts AS DATE) AS day, COUNT(*) AS n
  FROM [src.events] GROUP BY event_type, CAST(ts AS DATE)
) per_day
"""


@query(f"""
SELECT event_type, CAST(day AS VARCHAR) AS day, n, CAST(so_far AS BIGINT) AS so_far
FROM ({without_brackets(RUNNING)}) r
""")
def select_running_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A running window over daily counts, which are few per event type."""
    df = open_warehouse(spark, sf_dir, "events").run_select(RUNNING)
    return df.withColumn("day", F.col("day").cast("string"))


SETOPS = """
SELECT key, 'either' AS kind FROM (
  SELECT o_custkey AS key FROM [src.orders] UNION SELECT c_custkey FROM [src.customer]) u
UNION ALL
SELECT key, 'both' AS kind FROM (
  SELECT c_custkey AS key FROM [src.customer] INTERSECT
  SELECT DISTINCT o_custkey FROM [src.orders]) i
UNION ALL
SELECT key, 'customer only' AS kind FROM (
  SELECT c_custkey AS key FROM [src.customer] EXCEPT
  SELECT DISTINCT o_custkey FROM [src.orders]) e
"""


@query(without_brackets(SETOPS))
def select_setops(spark: SparkSession, sf_dir: str) -> DataFrame:
    return open_warehouse(spark, sf_dir, "orders", "customer").run_select(SETOPS)


TOPK = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM [src.lineitem]
ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey, l_suppkey LIMIT 100
"""


@query(without_brackets(TOPK))
def select_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hundred dearest lines; the sort key leaves no ties."""
    return open_warehouse(spark, sf_dir, "lineitem").run_select(TOPK)


FUNCTIONS = """
SELECT event_id, UPPER(event_type) AS kind, LENGTH(props) AS width,
       ROUND(SQRT(value), 4) AS root, EXTRACT(HOUR FROM ts) AS hour,
       CAST(CAST(ts AS DATE) AS STRING) AS day, split(event_type, 'i')[0] AS head,
       CAST(get_json_object(props, '$.k') AS INT) AS k
FROM [src.events]
"""


@query("""
SELECT event_id, UPPER(event_type) AS kind, CAST(LENGTH(props) AS INTEGER) AS width,
       ROUND(SQRT(value), 4) AS root, CAST(EXTRACT(HOUR FROM ts) AS INTEGER) AS hour,
       CAST(CAST(ts AS DATE) AS VARCHAR) AS day, string_split(event_type, 'i')[1] AS head,
       CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS INTEGER) AS k
FROM events
""")
def select_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """String, math, date, array and JSON functions; a subscript is no table reference."""
    return open_warehouse(spark, sf_dir, "events").run_select(FUNCTIONS)


@query("""
SELECT word, COUNT(*) AS word_count
FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents) w GROUP BY word
""")
def select_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Count the words of all texts into a table, then select from that table."""
    wh = open_warehouse(spark, sf_dir, "documents")
    counts = wh.run_select("""
        SELECT word, COUNT(*) AS word_count
        FROM (SELECT explode(split(text, ' ')) AS word FROM [src.documents]) w GROUP BY word""")
    wh.write_table(counts, "samples.words", write="empty")
    return wh.run_select("SELECT word, word_count FROM [samples.words]")


SUBQUERY = f"""
WITH per_segment AS (
  SELECT map_from_entries(collect_list(struct(c_mktsegment, struct(n, total)))) AS of FROM (
    SELECT c_mktsegment, COUNT(*) AS n, SUM({cents("c_acctbal")}) AS total
    FROM [src.customer] WHERE c_mktsegment IS NOT NULL GROUP BY c_mktsegment)
)
SELECT c_custkey, c_mktsegment, c_acctbal FROM (
  SELECT *, (SELECT of FROM per_segment)[c_mktsegment] AS mine FROM [src.customer])
WHERE {cents("c_acctbal")} * mine.n > mine.total
  AND c_nationkey IN (SELECT n_nationkey FROM [src.nation] WHERE n_regionkey <> 0)
"""


@query(f"""
WITH per_segment AS (
  SELECT c_mktsegment, COUNT(*) AS n, SUM({cents("c_acctbal")}) AS total
  FROM customer GROUP BY c_mktsegment
)
SELECT c_custkey, c.c_mktsegment, c_acctbal FROM customer c
JOIN per_segment s ON s.c_mktsegment = c.c_mktsegment
WHERE {cents("c_acctbal")} * n > total
  AND c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey <> 0)
""")
def select_subquery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers above the mean balance of their segment: a CTE and two subqueries.

    The sums of all segments come to each task as one map, so customers stay where they are.
    """
    return open_warehouse(spark, sf_dir, "customer", "nation").run_select(SUBQUERY)


COMMENTED = """
SELECT -- [src.nowhere] is no table here; it's a comment
  r'\\' AS back, '_partition_day' AS word, o_orderkey, o_orderstatus /* a /* nested */ note */
FROM -- all orders
  [src.orders] WHERE 'a' = 'a'; -- done
"""


@query("SELECT '\\' AS back, '_partition_day' AS word, o_orderkey, o_orderstatus FROM orders")
def select_with_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comments beside references, a raw string, and a note after the closing semicolon."""
    return open_warehouse(spark, sf_dir, "orders").run_select(COMMENTED)


# -- the result cache ---------------------------------------------------------

STATUS = f"""
SELECT o_orderstatus, COUNT(*) AS n, {exact_sum("o_totalprice")} AS total
FROM [own.orders] GROUP BY o_orderstatus
"""
STATUS_ONCE = STATUS.replace("[own.orders]", "orders")
STATUS_TWICE = STATUS.replace(
    "[own.orders]", "(SELECT * FROM orders UNION ALL SELECT * FROM orders) twice"
)


def _doubled_after_first_run(spark: SparkSession, sf_dir: str) -> Warehouse:
    """Run the statement at time 0 on a copy of the orders, then add them once more."""
    wh = open_warehouse(spark, sf_dir, "orders")
    orders = wh.read_table("src.orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    wh.write_table(orders, "own.orders")
    wh.run_select(STATUS, now_ms=0)
    wh.write_table(orders, "own.orders")
    return wh


@query(STATUS_ONCE)
def select_cached(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same text within 24 hours gives the old result, though the source has changed."""
    return _doubled_after_first_run(spark, sf_dir).run_select(STATUS, now_ms=24 * HOUR_MS - 1)


@query(STATUS_TWICE)
def select_cache_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Another spacing is another text: it runs anew and sees the change."""
    return _doubled_after_first_run(spark, sf_dir).run_select(STATUS + " ", now_ms=1)


@query(STATUS_TWICE)
def select_cache_over(spark: SparkSession, sf_dir: str) -> DataFrame:
    """After 24 hours the same text runs anew."""
    return _doubled_after_first_run(spark, sf_dir).run_select(STATUS, now_ms=24 * HOUR_MS)


BY = "SELECT {0} AS grp, COUNT(*) AS n FROM {1} GROUP BY {0}"


@query(BY.format("o_orderstatus", "orders").replace("AS grp", "AS grp, 2 AS dropped"))
def staging_expired(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stage three results an hour apart, drop those a day old; load what is left."""
    wh = open_warehouse(spark, sf_dir, "orders", "customer")
    wh.run_select(BY.format("c_mktsegment", "[src.customer]"), now_ms=0)
    wh.run_select(BY.format("o_orderpriority", "[src.orders]"), now_ms=HOUR_MS)
    wh.run_select(BY.format("o_orderstatus", "[src.orders]"), now_ms=2 * HOUR_MS)
    dropped = wh.expire_staging(now_ms=25 * HOUR_MS)
    (left,) = wh.staged_results()
    return wh.read_table(left.spec).withColumn("dropped", F.lit(len(dropped)))
