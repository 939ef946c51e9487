"""Saving frames: dispositions, day partitions, staging and its clean-up."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stowage import TableSpec, Warehouse
from stowage.plans.registry import cents, exact_sum, open_warehouse, query, refusal
from stowage.sources.files import child_names

CUSTOMER = "SELECT c_custkey, c_name, c_acctbal FROM customer"
DOUBLED = "SELECT c_custkey, c_name, c_acctbal * 2 AS c_acctbal FROM customer"


def _customers(wh: Warehouse) -> tuple[DataFrame, DataFrame]:
    """The customers, and the customers with their balance doubled."""
    plain = wh.read_table("src.customer").select("c_custkey", "c_name", "c_acctbal")
    return plain, plain.withColumn("c_acctbal", F.col("c_acctbal") * 2)


@query("""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
       CAST(epoch_ms(o_orderdate) AS BIGINT) AS o_orderdate, o_orderpriority
FROM orders
""")
def save_by_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A save by the three names of the table; the types are those of the load form."""
    wh = open_warehouse(spark, sf_dir, "orders")
    table = TableSpec(wh.project, "own", "orders")
    wh.write_table(wh.read_table("src.orders"), table)
    return wh.read_table(table)


@query("SELECT * FROM orders")
def save_spark_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A save that keeps Spark's own types."""
    wh = open_warehouse(spark, sf_dir, "orders")
    wh.write_table(wh.read_table("src.orders"), "own.orders", types="spark")
    return wh.read_table("own.orders")


@query(DOUBLED)
def save_truncate(spark: SparkSession, sf_dir: str) -> DataFrame:
    wh = open_warehouse(spark, sf_dir, "customer")
    plain, doubled = _customers(wh)
    wh.write_table(plain, "own.customer", write="truncate", create="if_needed")
    wh.write_table(doubled, "own.customer", write="truncate")
    return wh.read_table("own.customer")


@query(f"SELECT *, 'old' AS seen FROM ({CUSTOMER}) UNION ALL SELECT *, 'new' AS seen FROM ({DOUBLED})")
def save_truncate_old_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A frame that was loaded before a truncate still gives the rows it was loaded for."""
    wh = open_warehouse(spark, sf_dir, "customer")
    plain, doubled = _customers(wh)
    wh.write_table(plain, "own.customer")
    old = wh.read_table("own.customer")
    wh.write_table(doubled, "own.customer", write="truncate")
    new = wh.read_table("own.customer")
    return old.withColumn("seen", F.lit("old")).union(new.withColumn("seen", F.lit("new")))


@query(f"{CUSTOMER} UNION ALL {DOUBLED}")
def save_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An append finds columns by name, in whatever order they come."""
    wh = open_warehouse(spark, sf_dir, "customer")
    plain, doubled = _customers(wh)
    wh.write_table(plain, "own.customer", write="append")
    wh.write_table(doubled.select("c_acctbal", "c_name", "c_custkey"), "own.customer", "append")
    return wh.read_table("own.customer")


@query(f"{CUSTOMER} UNION ALL {DOUBLED}")
def save_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without dispositions: create if needed, then append."""
    wh = open_warehouse(spark, sf_dir, "customer")
    for df in _customers(wh):
        wh.write_table(df, "own.customer")
    return wh.read_table("own.customer")


@query(CUSTOMER.replace(" FROM", ", 'TableNotEmptyError' AS second FROM"))
def save_empty_refused(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``empty`` takes a new table and refuses one with rows, which stay as they are."""
    wh = open_warehouse(spark, sf_dir, "customer")
    plain, doubled = _customers(wh)
    wh.write_table(plain, "own.customer", write="empty")
    second = refusal(lambda: wh.write_table(doubled, "own.customer", write="empty"))
    return wh.read_table("own.customer").withColumn("second", F.lit(second))


@query(DOUBLED.replace(" FROM", ", 'TableNotFoundError' AS first, false AS left_behind FROM"))
def save_create_never(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``never`` refuses a missing table and leaves nothing; an existing one is written."""
    wh = open_warehouse(spark, sf_dir, "customer")
    plain, doubled = _customers(wh)
    first = refusal(lambda: wh.write_table(plain, "own.customer", create="never"))
    left_behind = wh.table_exists("own.customer")
    wh.write_table(plain, "own.customer")
    wh.write_table(doubled, "own.customer", write="truncate", create="never")
    return wh.read_table("own.customer").select(
        "*", F.lit(first).alias("first"), F.lit(left_behind).alias("left_behind")
    )


# The load days, and the part of the events that each takes.
LOADS = [
    ("20240111", "ts < TIMESTAMP_NTZ '2024-01-11'"),
    ("20240121", "ts >= TIMESTAMP_NTZ '2024-01-11' AND ts < TIMESTAMP_NTZ '2024-01-21'"),
    ("20240131", "ts >= TIMESTAMP_NTZ '2024-01-21'"),
]
LOAD_DAY = """CASE WHEN ts < TIMESTAMP '2024-01-11' THEN '2024-01-11'
WHEN ts < TIMESTAMP '2024-01-21' THEN '2024-01-21' ELSE '2024-01-31' END"""
MIDDLE = "ts >= TIMESTAMP '2024-01-11' AND ts < TIMESTAMP '2024-01-21'"


def _loaded_by_day(spark: SparkSession, sf_dir: str) -> tuple[Warehouse, DataFrame]:
    """All events, saved to three load days."""
    wh = open_warehouse(spark, sf_dir, "events")
    events = wh.read_table("src.events").select("event_id", "ts", "event_type", "value")
    for day, rows in LOADS:
        wh.write_table(events.filter(rows), f"own.events${day}")
    return wh, events


@query(f"""
SELECT event_id, CAST(FLOOR(epoch_us(ts) / 1000) AS BIGINT) AS ts, event_type,
       CASE WHEN {MIDDLE} THEN value * 2 ELSE value END AS value, {LOAD_DAY} AS load_day
FROM events
""")
def save_day_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replace one day; the others are unchanged."""
    wh, events = _loaded_by_day(spark, sf_dir)
    day, rows = LOADS[1]
    corrected = events.filter(rows).withColumn("value", F.col("value") * 2)
    wh.write_table(corrected, f"own.events${day}", write="truncate")
    days = wh.read_table("own.events", with_day=True)
    return days.withColumnRenamed("_partition_day", "load_day").withColumn(
        "load_day", F.col("load_day").cast("string")
    )


@query(f"""
SELECT event_id, CAST(FLOOR(epoch_us(ts) / 1000) AS BIGINT) AS ts,
       CASE WHEN {MIDDLE} THEN value * 2 ELSE value END AS value, {LOAD_DAY} AS load_day,
       'SpecError' AS bad_day, 'SpecError' AS two_days, 'SpecError' AS no_name
FROM events
""")
def save_day_by_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days named by ``$`` in the table id of a reference: three are written, one replaced."""
    wh = open_warehouse(spark, sf_dir, "events")
    events = wh.read_table("src.events").select("event_id", "ts", "value")

    def reference(day: str) -> TableSpec:
        return TableSpec(wh.project, "own", f"events${day}")

    for day, rows in LOADS:
        wh.write_table(events.filter(rows), reference(day))
    day, rows = LOADS[1]
    corrected = events.filter(rows).withColumn("value", F.col("value") * 2)
    wh.write_table(corrected, reference(day), write="truncate")
    reports = {
        "bad_day": refusal(lambda: reference("20240230")),
        "two_days": refusal(lambda: TableSpec(wh.project, "own", "events$20240111", reference(day).day)),
        "no_name": refusal(lambda: TableSpec(wh.project, "own", "")),
    }
    loaded = wh.read_table(TableSpec(wh.project, "own", "events"), with_day=True)
    return loaded.withColumnRenamed("_partition_day", "load_day").withColumns(
        {"load_day": F.col("load_day").cast("string"), **{n: F.lit(kind) for n, kind in reports.items()}}
    )


@query(f"""
SELECT event_type, COUNT(*) AS n, {exact_sum("value")} AS total
FROM (SELECT * FROM events WHERE {MIDDLE} UNION ALL SELECT * FROM events) both_loads
GROUP BY event_type
""")
def save_day_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Append all events to one load day, then select that day alone by its ``$``."""
    wh, events = _loaded_by_day(spark, sf_dir)
    day = LOADS[1][0]
    wh.write_table(events, f"own.events${day}", write="append")
    return wh.run_select(f"""
        SELECT event_type, COUNT(*) AS n,
               {exact_sum("value")} AS total
        FROM [own.events${day}] GROUP BY event_type""")


@query(f"""
SELECT {LOAD_DAY} AS load_day, COUNT(*) AS n, 'TableNotEmptyError' AS filled_day,
       'PartitioningError' AS no_day, 'PartitioningError' AS day_of_plain
FROM events GROUP BY ALL
""")
def save_day_refused(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``empty`` looks at the one day; a day must be named where there are days, only there."""
    wh, events = _loaded_by_day(spark, sf_dir)
    wh.write_table(events, "own.plain")
    filled = refusal(lambda: wh.write_table(events, "own.events$20240111", write="empty"))
    no_day = refusal(lambda: wh.write_table(events, "own.events"))
    day_of_plain = refusal(lambda: wh.write_table(events, "own.plain$20240111"))
    days = wh.read_table("own.events", with_day=True)
    return (
        days.groupBy(F.col("_partition_day").cast("string").alias("load_day"))
        .agg(F.count("*").alias("n"))
        .withColumns(
            {
                "filled_day": F.lit(filled),
                "no_day": F.lit(no_day),
                "day_of_plain": F.lit(day_of_plain),
            }
        )
    )


@query("""
SELECT o_orderstatus, COUNT(*) AS n, 'failed' AS second,
       0 AS staged_after_save, 0 AS staged_after_failure, 1 AS folders, '.gz.parquet' AS ending
FROM orders GROUP BY o_orderstatus
""")
def save_options_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writer options are used; no staged file stays, also after a save that fails midway."""
    wh = open_warehouse(spark, sf_dir, "orders")
    orders = wh.read_table("src.orders")
    wh.write_table(orders, "own.orders", options={"compression": "gzip"})
    wh.write_table(orders, "own.orders", write="truncate", fmt="orc")
    after_save = len(child_names(spark, wh.staging_root))
    wh.write_table(orders, "own.orders", write="truncate", options={"compression": "gzip"})
    failing = orders.withColumn(
        "o_totalprice",
        F.when(F.col("o_totalprice") < 0, 0.0).otherwise(
            F.raise_error(F.lit("a save that fails midway")).cast("double")
        ),
    )
    second = "saved"
    try:
        wh.write_table(failing, "own.orders", write="truncate", staged=True)
    except Exception as e:
        if "a save that fails midway" not in str(e):
            raise
        second = "failed"
    after_failure = len(child_names(spark, wh.staging_root))
    saved = wh.read_table("own.orders")
    per_file = saved.groupBy("o_orderstatus", F.col("_metadata.file_path").alias("file")).count()
    return (
        per_file.groupBy("o_orderstatus")
        .agg(
            F.sum("count").alias("n"),
            F.count_distinct(F.regexp_extract("file", "^(.*)/[^/]*$", 1)).alias("folders"),
            F.max(F.regexp_extract("file", r"(\.gz\.parquet)$", 1)).alias("ending"),
        )
        .select(
            "o_orderstatus",
            "n",
            F.col("folders").cast("int").alias("folders"),
            "ending",
            F.lit(second).alias("second"),
            F.lit(after_save).alias("staged_after_save"),
            F.lit(after_failure).alias("staged_after_failure"),
        )
    )


@query("SELECT l_orderkey, l_linenumber, l_extendedprice, l_returnflag FROM lineitem")
def save_staged_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A save that passes through staged files of another format."""
    wh = open_warehouse(spark, sf_dir, "lineitem")
    lines = wh.read_table("src.lineitem")
    lines = lines.select("l_orderkey", "l_linenumber", "l_extendedprice", "l_returnflag")
    wh.write_table(lines, "own.lines", fmt="orc", options={"compression": "snappy"})
    return wh.read_table("own.lines")


@query("""
SELECT conv_id, turn, role AS who, text AS said, CAST(length(text) AS INTEGER) AS width,
       turn AS first_number, role = 'user' AS from_user
FROM conversations
UNION ALL
SELECT conv_id, turn, role, text, CAST(length(text) AS INTEGER), turn, role = 'user'
FROM conversations
""")
def save_nested_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records, arrays and maps in a saved table, written twice and taken apart again."""
    wh = open_warehouse(spark, sf_dir, "conversations")
    nested = wh.read_table("src.conversations").selectExpr(
        "conv_id",
        "turn",
        "named_struct('who', role, 'said', text, 'width', CAST(length(text) AS INT)) AS line",
        "array(turn) AS numbers",
        "map('user', role = 'user') AS flags",
    )
    for _ in range(2):
        wh.write_table(nested, "own.lines", options={"recordNamespace": "own"})
    return wh.read_table("own.lines").selectExpr(
        "conv_id",
        "turn",
        "line.who",
        "line.said",
        "line.width",
        "numbers[0] AS first_number",
        "flags['user'] AS from_user",
    )


@query("SELECT c_custkey, c_name, c_acctbal FROM customer UNION ALL " + DOUBLED)
def load_staged_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load all files of a folder that someone else staged."""
    wh = open_warehouse(spark, sf_dir, "customer")
    folder = f"{wh.staging_root}/handed_over"
    for df in _customers(wh):
        df.write.mode("append").orc(folder)
    wh.load_staged(folder, "own.customer", write="empty", fmt="orc")
    return wh.read_table("own.customer")


@query(f"""
SELECT o_custkey, COUNT(*) AS orders, CAST(SUM({cents("o_totalprice")}) AS BIGINT) AS cents
FROM orders GROUP BY o_custkey
""")
def write_from_self(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replace a table by a query on itself: one row per order becomes one per customer."""
    wh = open_warehouse(spark, sf_dir, "orders")
    orders = wh.read_table("src.orders").selectExpr(
        "o_custkey", "1L AS orders", f"{cents('o_totalprice')} AS cents"
    )
    wh.write_table(orders, "own.spending")
    per_customer = (
        wh.read_table("own.spending")
        .groupBy("o_custkey")
        .agg(F.sum("orders").alias("orders"), F.sum("cents").alias("cents"))
    )
    wh.write_table(per_customer, "own.spending", write="truncate")
    return wh.read_table("own.spending")


def _second(wh: Warehouse) -> Warehouse:
    """Another warehouse on the same catalog and root, with nothing in its memory."""
    return Warehouse(wh.spark, wh.staging_root.rpartition("/")[0], project=wh.project)


@query(f"{CUSTOMER.replace(' FROM', ', 1 AS first, 0 AS again, 1 AS later FROM')} UNION ALL "
       f"{DOUBLED.replace(' FROM', ', 1 AS first, 0 AS again, 1 AS later FROM')}")
def load_repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load that is repeated adds rows once; files that came meanwhile are added."""
    wh = open_warehouse(spark, sf_dir, "customer")
    folder = f"{wh.staging_root}/handed_over"
    loads = []
    for df, times in zip(_customers(wh), (2, 1), strict=True):
        df.coalesce(1).write.mode("append").orc(folder)
        loads += [wh.load_staged(folder, "own.customer", fmt="orc", once=True) for _ in range(times)]
    return wh.read_table("own.customer").withColumns(
        {name: F.lit(n) for name, n in zip(("first", "again", "later"), loads, strict=True)})


@query("""
SELECT l_orderkey, l_linenumber, l_quantity, true AS fewer, false AS again, true AS one_file
FROM lineitem
""")
def save_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many small files become one, with the same rows; a second compaction finds nothing to do."""
    wh = open_warehouse(spark, sf_dir, "lineitem")
    lines = wh.read_table("src.lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    for part in range(4):
        wh.write_table(lines.filter(F.pmod("l_orderkey", F.lit(4)) == part), "own.lines")
    done = {"fewer": wh.compact("own.lines"), "again": wh.compact("own.lines")}
    saved = wh.read_table("own.lines")
    done["one_file"] = len(saved.inputFiles()) == 1
    return saved.withColumns({name: F.lit(was) for name, was in done.items()})


@query(f"{CUSTOMER.replace(' FROM', ', 2 AS removed FROM')} UNION ALL {DOUBLED.replace(' FROM', ', 2 AS removed FROM')}")
def clean_up_elsewhere(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What was replaced is removed by another warehouse, by the record; what is live stays."""
    wh = open_warehouse(spark, sf_dir, "customer")
    plain, doubled = _customers(wh)
    for _ in range(3):
        wh.write_table(plain, "own.customer", write="truncate")
    wh.write_table(doubled, "own.customer")
    removed = _second(wh).clean_up(2**62)
    return wh.read_table("own.customer").withColumn("removed", F.lit(len(removed)))


@query(f"""
SELECT o_orderstatus, COUNT(*) AS n, {exact_sum("o_totalprice")} AS total, 1 AS results
FROM orders GROUP BY o_orderstatus
""")
def select_met_elsewhere(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second warehouse meets the result that the first one staged for the same text."""
    wh = open_warehouse(spark, sf_dir, "orders")
    text = f"SELECT o_orderstatus, COUNT(*) AS n, {exact_sum('o_totalprice')} AS total FROM [src.orders] GROUP BY o_orderstatus"
    wh.run_select(text)
    other = _second(wh)
    found = other.run_select(text)
    return found.withColumn("results", F.lit(len(other.staged_results())))


@query("SELECT l_orderkey, l_linenumber, l_quantity, true AS fewer FROM lineitem")
def save_balanced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Uneven partitions, most of them tiny, are saved as fewer files."""
    wh = open_warehouse(spark, sf_dir, "lineitem")
    lines = wh.read_table("src.lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    uneven = lines.filter("l_orderkey % 3 = 0").repartition(64, "l_quantity").unionByName(lines.filter("l_orderkey % 3 <> 0"))
    wh.write_table(uneven, "own.lines", balance=True)
    wh.write_table(uneven, "own.uneven")
    saved = wh.read_table("own.lines")
    fewer = len(saved.inputFiles()) < len(wh.read_table("own.uneven").inputFiles())
    return saved.withColumn("fewer", F.lit(fewer))
