"""The plans that matter at scale: pruning, no shuffle where none is needed, early limits."""

import contextlib
import io
import tempfile

import pytest
from conftest import SF_DIR
from pyspark.sql import functions as F

from stowage import conform, load_form, merge_union
from stowage.plans import selects
from stowage.plans.registry import CHECKPOINT_DIR, REGISTERED, open_warehouse, scratch_root


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.fixture
def lines(spark):
    return spark.read.parquet(f"{SF_DIR}/lineitem.parquet")


def test_filter_and_columns_reach_the_scan(spark):
    text = plan(REGISTERED["table_scan_pruned"].run(spark, SF_DIR))
    assert "EqualTo(l_returnflag,R), GreaterThanOrEqual(l_quantity,30.0)" in text
    assert "l_comment" not in text and "l_tax" not in text
    assert "Exchange" not in text


def test_days_are_pruned(spark, warehouse):
    df = spark.range(10)
    for day in ("20240101", "20240102"):
        warehouse.write_table(df, f"ds.d${day}")
    text = plan(warehouse.read_table("ds.d$20240102"))
    assert "PartitionFilters: [isnotnull(_partition_day" in text
    by_sql = plan(spark.sql(warehouse._selects.resolve("SELECT * FROM [ds.d$20240102]")))
    assert "PartitionFilters: [isnotnull(_partition_day" in by_sql


def test_load_form_prunes_through(lines):
    text = plan(load_form(lines).filter(F.col("l_returnflag") == "R").select("l_shipdate"))
    assert "ReadSchema: struct<l_returnflag:string,l_shipdate:timestamp_ntz>" in text
    assert "EqualTo(l_returnflag,R)" in text


def test_schema_operators_do_not_shuffle(lines):
    other = lines.withColumn("l_linenumber", F.col("l_linenumber").cast("bigint"))
    for df in (
        load_form(lines),
        conform(lines, lines.schema),
        merge_union([lines, other, lines]),
    ):
        assert "Exchange" not in plan(df)


def test_nested_casts_are_compiled(spark):
    df = spark.range(5).selectExpr(
        "array(CAST(id AS DECIMAL(9, 2))) AS a",
        "map('k', CAST(id AS SMALLINT)) AS m",
        "array(named_struct('x', array(CAST(id AS TINYINT)))) AS s",
    )
    assert "transform" not in plan(load_form(df))
    wide = spark.range(5).selectExpr("array(id) AS a")
    narrow = spark.range(5).selectExpr("array(CAST(id AS INT)) AS a")
    assert "transform" not in plan(merge_union([narrow, wide]))


def statement(spark, sql, *tables):
    wh = open_warehouse(spark, SF_DIR, *tables)
    return plan(spark.sql(wh._selects.resolve(sql)))


def test_ranks_are_limited_before_the_shuffle(spark):
    text = statement(spark, selects.WINDOW, "orders")
    assert "Partial" in text and text.count("WindowGroupLimit") >= 2


def test_sums_are_partial_before_each_shuffle(spark):
    text = statement(spark, selects.JOIN, "orders", "customer", "nation")
    assert "partial_sum(FLOOR" in text
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_customers_are_not_dealt_out_by_their_few_segments(spark):
    """With broadcasts off, only partial sums move by segment."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        wh = open_warehouse(spark, SF_DIR, "customer", "nation")
        tree = spark.sql(wh._selects.resolve(selects.SUBQUERY))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    moved = [i for i, line in enumerate(tree.splitlines()) if "hashpartitioning(c_mktsegment" in line]
    assert moved
    for i in moved:
        assert "partial_" in tree.splitlines()[i + 1]


def test_no_cross_joins(spark):
    for sql in (selects.SEMI_ANTI, selects.SETOPS):
        text = statement(spark, sql, "orders", "customer")
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_scratch_lies_where_the_cluster_says(spark):
    shared = spark.conf.get(CHECKPOINT_DIR, None)
    root = scratch_root(spark)
    assert root.startswith(f"{shared}/stowage_" if shared else tempfile.gettempdir())
    assert root != scratch_root(spark)


@contextlib.contextmanager
def jobs_counted(spark, name):
    """A list that holds the number of Spark jobs run inside the block."""
    spark.sparkContext.setJobGroup(name, name)
    out = []
    yield out
    out.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(name)))
    spark.sparkContext.setJobGroup("rest", "rest")


def test_loading_runs_no_job(spark, warehouse):
    warehouse.write_table(spark.range(9), "ds.t")
    warehouse.write_table(spark.range(9), "ds.d$20240101")
    text = "SELECT COUNT(*) AS n FROM [ds.t]"
    warehouse.run_select(text)
    with jobs_counted(spark, "load") as n:
        warehouse.read_table("ds.t")
        warehouse.read_table("ds.d$20240101")
        warehouse.run_select(text)
        load_form(warehouse.read_table("ds.t"))
    assert n == [0]


@pytest.mark.parametrize("write", ["append", "truncate"])
def test_a_save_is_one_job(spark, warehouse, write):
    for table in ("ds.t", "ds.d$20240101"):
        for turn in ("new", "again"):
            with jobs_counted(spark, f"{table}-{turn}-{write}") as n:
                warehouse.write_table(spark.range(9), table, write=write)
            assert n == [1]
