"""The schema operators: load form, conform, merge by the union rule."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stowage import conform, load_form, merge_union
from stowage.plans.registry import open_warehouse, query, refusal


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return open_warehouse(spark, sf_dir, table).read_table(f"src.{table}")


@query("""
SELECT l_orderkey, l_linenumber,
       CAST(l_linenumber AS INTEGER) AS tiny,
       CASE WHEN l_suppkey % 30000 = 7 THEN -1 ELSE CAST(l_suppkey % 30000 AS INTEGER) END AS small,
       l_linenumber AS whole, l_partkey AS big,
       CAST(l_tax AS REAL) AS single, l_discount AS dbl,
       CAST(CAST(NULLIF(l_extendedprice, 1) AS DECIMAL(12, 3)) AS VARCHAR) AS dec,
       l_returnflag AS txt, l_returnflag = 'R' AS flag,
       hex(encode(l_linestatus)) AS bytes,
       ((l_partkey % 1000000) * 86399 - 100000000) * 1000 AS ts,
       CASE WHEN l_shipdate = TIMESTAMP '1995-01-02' THEN -1
            ELSE CAST(epoch_ms(l_shipdate) AS BIGINT) END AS ntz,
       CAST(epoch_ms(CAST(CAST(l_shipdate AS DATE) - 12000 AS TIMESTAMP)) AS BIGINT) AS dt
FROM lineitem
""")
def load_form_scalar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each scalar type in its outgoing form; times before 1970 and nulls among them."""
    lines = _read(spark, sf_dir, "lineitem")
    typed = lines.selectExpr(
        "l_orderkey",
        "l_linenumber",
        "CAST(l_linenumber AS TINYINT) AS tiny",
        "CAST(NULLIF(l_suppkey % 30000, 7) AS SMALLINT) AS small",
        "l_linenumber AS whole",
        "l_partkey AS big",
        "CAST(l_tax AS FLOAT) AS single",
        "l_discount AS dbl",
        "CAST(NULLIF(l_extendedprice, 1) AS DECIMAL(12, 3)) AS dec",
        "l_returnflag AS txt",
        "l_returnflag = 'R' AS flag",
        "CAST(l_linestatus AS BINARY) AS bytes",
        "timestamp_seconds((l_partkey % 1000000) * 86399 - 100000000) AS ts",
        "NULLIF(l_shipdate, TIMESTAMP_NTZ '1995-01-02') AS ntz",
        "date_sub(CAST(l_shipdate AS DATE), 12000) AS dt",
    )
    return load_form(typed).withColumns(
        {
            "bytes": F.hex("bytes"),
            "small": F.coalesce("small", F.lit(-1)),
            "ntz": F.coalesce("ntz", F.lit(-1)),
        }
    )


@query("""
SELECT l_orderkey, l_linenumber,
       CASE WHEN l_returnflag = 'N' THEN NULL
            ELSE CAST(CAST(l_quantity AS DECIMAL(10, 3)) AS VARCHAR) END AS a0,
       CAST(NULL AS VARCHAR) AS a1,
       CASE WHEN l_returnflag = 'N' THEN -1 ELSE 2 END AS a_size,
       l_linenumber AS m_q, true AS m_n_null,
       CASE WHEN l_returnflag = 'R' THEN -1 ELSE l_linenumber END AS r_x,
       l_returnflag = 'R' AS r_null, l_returnflag = 'R' OR l_linestatus = 'O' AS y_null,
       CASE WHEN l_returnflag = 'R' OR l_linestatus = 'O' THEN -1
            ELSE CAST(epoch_ms(l_shipdate) AS BIGINT) END AS r_y_d,
       CAST(CAST(l_discount AS DECIMAL(10, 3)) AS VARCHAR) AS s_d,
       CAST(epoch_ms(l_shipdate) AS BIGINT) AS s_t, l_linenumber AS ms_x
FROM lineitem
""")
def load_form_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arrays, maps and structs around converted parts; null containers stay null."""
    nested = _read(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey",
        "l_linenumber",
        "IF(l_returnflag = 'N', NULL, array(CAST(l_quantity AS DECIMAL(10, 3)), NULL)) AS a",
        "map('q', CAST(l_linenumber AS SMALLINT), 'n', NULL) AS m",
        """IF(l_returnflag = 'R', NULL, named_struct(
             'x', CAST(l_linenumber AS TINYINT),
             'y', IF(l_linestatus = 'O', NULL,
                     named_struct('d', CAST(l_shipdate AS DATE))))) AS r""",
        """array(named_struct('d', CAST(l_discount AS DECIMAL(10, 3)), 't', l_shipdate)) AS s""",
        "map('k', named_struct('x', CAST(l_linenumber AS SMALLINT))) AS ms",
    )
    return load_form(nested).selectExpr(
        "l_orderkey",
        "l_linenumber",
        "a[0] AS a0",
        "a[1] AS a1",
        "IF(a IS NULL, -1, size(a)) AS a_size",
        "m['q'] AS m_q",
        "map_contains_key(m, 'n') AND m['n'] IS NULL AS m_n_null",
        "COALESCE(r.x, -1) AS r_x",
        "r IS NULL AS r_null",
        "r.y IS NULL AS y_null",
        "COALESCE(r.y.d, -1) AS r_y_d",
        "s[0].d AS s_d",
        "s[0].t AS s_t",
        "ms['k'].x AS ms_x",
    )


@query("""
SELECT vec_id, label, CAST(len(embedding) AS INTEGER) AS width, i AS place, embedding[i] AS value
FROM (SELECT *, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings)
""")
def load_form_untouched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns that are in load form already are passed on as they are."""
    vectors = load_form(_read(spark, sf_dir, "embeddings"))
    placed = vectors.select(
        "vec_id", "label", F.size("embedding").alias("width"), F.posexplode("embedding").alias("at", "value")
    )
    return placed.select("vec_id", "label", "width", (F.col("at") + 1).cast("long").alias("place"), "value")


@query("""
SELECT o_orderstatus, COUNT(*) AS n,
       'UnsupportedTypeError at m' AS int_keys, 'UnsupportedTypeError at r.i' AS interval_field,
       'UnsupportedTypeError at v' AS void_column, 'NestedArrayError at a' AS nested_array,
       'NamespaceError at r' AS no_namespace
FROM orders GROUP BY o_orderstatus
""")
def load_form_refused(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Saves of types that a load cannot take are refused; the table stays as it is."""
    wh = open_warehouse(spark, sf_dir, "orders")
    orders = wh.read_table("src.orders")
    wh.write_table(orders, "own.orders")

    def refused(expression: str, fmt: str = "parquet") -> str:
        bad = orders.select("*", F.expr(expression))
        return refusal(lambda: wh.write_table(bad, "own.orders", write="truncate", fmt=fmt))

    cases = {
        "int_keys": refused("map(1, o_custkey) AS m"),
        "interval_field": refused("named_struct('i', o_orderdate - o_orderdate) AS r"),
        "void_column": refused("NULL AS v"),
        "nested_array": refused("array(array(o_custkey)) AS a"),
        "no_namespace": refused("named_struct('x', o_custkey) AS r", fmt="avro"),
    }
    left = wh.read_table("own.orders").groupBy("o_orderstatus").agg(F.count("*").alias("n"))
    return left.withColumns({name: F.lit(kind) for name, kind in cases.items()})


def _struct(*fields: tuple) -> T.StructType:
    return T.StructType([T.StructField(n, t, *null) for n, t, *null in fields])


@query("""
SELECT o_orderpriority, o_orderkey, CAST(NULL AS VARCHAR) AS note,
       o_orderstatus AS state, true AS no_rank,
       o_totalprice AS second_price, hex(encode(o_orderstatus)) AS raw
FROM orders
""")
def conform_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reorder, drop and fill with null, at the top and inside structs and arrays."""
    source = _read(spark, sf_dir, "orders").selectExpr(
        "o_orderkey",
        "o_custkey",
        "o_orderpriority",
        "named_struct('code', o_custkey, 'status', o_orderstatus) AS state",
        "array(named_struct('key', o_orderkey, 'price', o_totalprice)) AS prices",
        "CAST(o_orderstatus AS BINARY) AS raw",
    )
    target = _struct(
        ("raw", T.BinaryType()),
        ("o_orderpriority", T.StringType()),
        ("o_orderkey", T.LongType()),
        ("note", T.StringType()),
        ("state", _struct(("status", T.StringType()), ("rank", T.LongType()))),
        ("prices", T.ArrayType(_struct(("price", T.DoubleType()), ("key", T.LongType())))),
    )
    return conform(source, target).selectExpr(
        "o_orderpriority",
        "o_orderkey",
        "note",
        "state.status AS state",
        "state.rank IS NULL AS no_rank",
        "prices[0].price AS second_price",
        "hex(raw) AS raw",
    )


@query("""
SELECT o_orderstatus, COUNT(*) AS n,
       'MissingFieldError at note' AS required, 'MissingFieldError at r.note' AS required_inside,
       'TypeMismatchError at n' AS int_to_long, 'TypeMismatchError at r.x' AS inside,
       'TypeMismatchError at m' AS int_keys
FROM orders GROUP BY o_orderstatus
""")
def conform_refused(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Missing required fields and unequal types are errors before any row is read."""
    source = _read(spark, sf_dir, "orders").selectExpr(
        "o_orderstatus",
        "CAST(o_orderkey AS INT) AS n",
        "named_struct('x', o_totalprice) AS r",
        "map(1, 1) AS m",
    )
    keyed = T.MapType(T.IntegerType(), T.IntegerType())
    targets = {
        "required": _struct(("n", T.IntegerType()), ("note", T.StringType(), False)),
        "required_inside": _struct(("r", _struct(("note", T.StringType(), False)))),
        "int_to_long": _struct(("n", T.LongType())),
        "inside": _struct(("r", _struct(("x", T.FloatType())))),
        "int_keys": _struct(("m", keyed)),
    }
    cases = {name: refusal(lambda t=t: conform(source, t)) for name, t in targets.items()}
    kept = conform(source, _struct(("o_orderstatus", T.StringType(), False)))
    return (
        kept.groupBy("o_orderstatus")
        .agg(F.count("*").alias("n"))
        .withColumns({name: F.lit(kind) for name, kind in cases.items()})
    )


def _run_time_refusal(df: DataFrame) -> str:
    """Run ``df`` over all its rows; the null check that stops it, or ``accepted``."""
    try:
        df.write.format("noop").mode("overwrite").save()
    except Exception as e:
        found = re.search(r"null (array element|map value|in required field) at path [\w.]+", str(e))
        if not found:
            raise
        return found[0]
    return "accepted"


@query("""
SELECT l_orderkey, l_linenumber,
       CASE WHEN l_returnflag = 'N' THEN NULL ELSE l_quantity END AS a0,
       CASE WHEN l_linestatus = 'O' THEN NULL ELSE l_tax END AS m_k,
       CASE WHEN l_returnflag = 'N' THEN NULL ELSE l_discount END AS s0,
       'null array element at path a' AS array_null,
       'null map value at path m' AS map_null,
       'null array element at path r.a' AS inner_null, 'accepted' AS allowed
FROM lineitem
""")
def conform_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null elements and values stop the run where the target forbids them; null
    containers, and nulls where they are allowed, pass."""
    lines = _read(spark, sf_dir, "lineitem")
    dbl = T.DoubleType()
    strict = _struct(
        ("l_orderkey", T.LongType()),
        ("l_linenumber", T.IntegerType()),
        ("a", T.ArrayType(dbl, False)),
        ("m", T.MapType(T.StringType(), dbl, False)),
        ("r", _struct(("a", T.ArrayType(dbl, False)))),
    )
    loose = _struct(("a", T.ArrayType(dbl)), ("m", T.MapType(T.StringType(), dbl)))

    def source(a: str, m: str, inner: str) -> DataFrame:
        return lines.selectExpr(
            "l_orderkey",
            "l_linenumber",
            f"IF(l_returnflag = 'N', NULL, array({a})) AS a",
            f"IF(l_linestatus = 'O', NULL, map('k', {m})) AS m",
            f"IF(l_returnflag = 'N', NULL, named_struct('a', array({inner}))) AS r",
        )

    q, t, d = (f"IF(l_orderkey < 0, NULL, {c})" for c in ("l_quantity", "l_tax", "l_discount"))
    some_null = "NULLIF(l_quantity, 30)"
    cases = {
        "array_null": conform(source(some_null, t, d), strict),
        "map_null": conform(source(q, some_null, d), strict),
        "inner_null": conform(source(q, t, some_null), strict),
        "allowed": conform(source(some_null, some_null, d), loose),
    }
    reports = {name: F.lit(_run_time_refusal(df)) for name, df in cases.items()}
    good = conform(source(q, t, d), strict)
    return good.selectExpr(
        "l_orderkey", "l_linenumber", "a[0] AS a0", "m['k'] AS m_k", "r.a[0] AS s0"
    ).withColumns(reports)


@query("""
SELECT l_orderkey, l_linenumber, l_quantity AS q, l_tax AS t, l_discount AS d, true AS same_schema,
       'null in required field at path q' AS field_null, 'null in required field at path r.d' AS inner_null,
       'accepted' AS not_strict
FROM lineitem
""")
def conform_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With ``strict`` the frame's schema is the target, and nulls in required fields stop the run."""
    lines = _read(spark, sf_dir, "lineitem")
    dbl = T.DoubleType()
    target = _struct(
        ("l_orderkey", T.LongType(), False),
        ("l_linenumber", T.IntegerType()),
        ("q", dbl, False),
        ("m", T.MapType(T.StringType(), dbl, False), False),
        ("r", _struct(("d", dbl, False), ("more", T.ArrayType(_struct(("t", dbl, False)), False)))),
    )

    def source(q: str, d: str) -> DataFrame:
        return lines.selectExpr(
            "l_linenumber",
            f"named_struct('more', array(named_struct('t', l_tax)), 'd', {d}) AS r",
            "map('t', l_tax) AS m",
            f"{q} AS q",
            "l_orderkey",
        )

    some_null = "NULLIF(l_linenumber, 1) * 1D"
    good = conform(source("l_quantity", "l_discount"), target, strict=True)
    cases = {
        "field_null": conform(source(some_null, "l_discount"), target, strict=True),
        "inner_null": conform(source("l_quantity", some_null), target, strict=True),
        "not_strict": conform(source(some_null, some_null), target),
    }
    reports = {name: F.lit(_run_time_refusal(df)) for name, df in cases.items()}
    return good.selectExpr(
        "l_orderkey", "l_linenumber", "q", "coalesce(m['t'], r.more[0].t) AS t", "r.d AS d"
    ).withColumns({"same_schema": F.lit(good.schema == target), **reports})


@query("""
SELECT l_orderkey AS k, CAST(l_linenumber AS BIGINT) AS n, CAST(CAST(l_tax AS REAL) AS DOUBLE) AS x,
       l_returnflag AS flag, CAST(NULL AS VARCHAR) AS extra
FROM lineitem
UNION ALL
SELECT o_orderkey, CASE WHEN o_custkey = 1 THEN -1 ELSE o_custkey END, o_totalprice,
       o_orderstatus, o_orderpriority
FROM orders
""")
def merge_union_widen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """int with bigint gives bigint, float with double gives double; absent fields are null."""
    wh = open_warehouse(spark, sf_dir, "lineitem", "orders")
    lines = wh.read_table("src.lineitem").selectExpr(
        "l_orderkey AS k", "l_linenumber AS n", "CAST(l_tax AS FLOAT) AS x", "l_returnflag AS flag"
    )
    orders = wh.read_table("src.orders").selectExpr(
        "o_orderkey AS k",
        "NULLIF(o_custkey, 1) AS n",
        "o_totalprice AS x",
        "o_orderstatus AS flag",
        "o_orderpriority AS extra",
    )
    return merge_union([lines, orders]).withColumn("n", F.coalesce("n", F.lit(-1)))


@query("""
SELECT l_orderkey AS k, CASE WHEN l_linenumber = 1 THEN -1 ELSE l_linenumber END AS x0,
       CAST(NULL AS VARCHAR) AS x1, CAST(-1 AS BIGINT) AS x2, l_linenumber = 1 AS x_null,
       l_linenumber AS y0, CAST(NULL AS REAL) AS y1
FROM lineitem
UNION ALL
SELECT o_orderkey, -1, o_orderpriority, -1, false, -1, CAST(o_totalprice AS REAL) FROM orders
UNION ALL
SELECT c_custkey, -1, NULL, c_custkey, false, c_nationkey, NULL FROM customer
""")
def merge_union_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Any other mix gives a struct with one member set; three types do not widen."""
    wh = open_warehouse(spark, sf_dir, "lineitem", "orders", "customer")
    merged = merge_union(
        [
            wh.read_table("src.lineitem").selectExpr(
                "l_orderkey AS k", "NULLIF(l_linenumber, 1) AS x", "l_linenumber AS y"
            ),
            wh.read_table("src.orders").selectExpr(
                "o_orderkey AS k", "o_orderpriority AS x", "CAST(o_totalprice AS FLOAT) AS y"
            ),
            wh.read_table("src.customer").selectExpr(
                "c_custkey AS k", "c_custkey AS x", "c_nationkey AS y"
            ),
        ]
    )
    return merged.selectExpr(
        "k",
        "COALESCE(x.member0, -1) AS x0",
        "x.member1 AS x1",
        "COALESCE(x.member2, -1) AS x2",
        "x IS NULL AS x_null",
        "COALESCE(y.member0, -1) AS y0",
        "y.member1 AS y1",
    )


@query("""
SELECT l_orderkey AS k, l_linenumber AS n0, CAST(NULL AS VARCHAR) AS n1,
       l_returnflag AS only_lines, CAST(NULL AS DOUBLE) AS only_orders,
       CAST(l_linenumber AS BIGINT) AS a0, CAST(CAST(l_tax AS REAL) AS DOUBLE) AS m_v
FROM lineitem
UNION ALL
SELECT o_orderkey, -1, o_orderstatus, NULL, o_totalprice, o_custkey, o_totalprice FROM orders
""")
def merge_union_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Structs meet field by field, arrays element by element, maps value by value."""
    wh = open_warehouse(spark, sf_dir, "lineitem", "orders")
    lines = wh.read_table("src.lineitem").selectExpr(
        "l_orderkey AS k",
        "named_struct('n', l_linenumber, 'only_lines', l_returnflag) AS r",
        "array(l_linenumber) AS a",
        "map('v', CAST(l_tax AS FLOAT)) AS m",
    )
    orders = wh.read_table("src.orders").selectExpr(
        "o_orderkey AS k",
        "named_struct('only_orders', o_totalprice, 'n', o_orderstatus) AS r",
        "array(o_custkey) AS a",
        "map('v', o_totalprice) AS m",
    )
    return merge_union([lines, orders]).selectExpr(
        "k",
        "COALESCE(r.n.member0, -1) AS n0",
        "r.n.member1 AS n1",
        "r.only_lines",
        "r.only_orders",
        "a[0] AS a0",
        "m['v'] AS m_v",
    )


@query("""
SELECT l_orderkey AS k, l_linenumber AS line, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS shipped,
       CAST(NULL AS VARCHAR) AS status, -1.0::DOUBLE AS price, l_linenumber AS in_line, CAST(NULL AS VARCHAR) AS in_status,
       'UnionShapeError at x' AS too_wide, 'UnionShapeError at x' AS loses_all
FROM lineitem
UNION ALL
SELECT o_orderkey, -1, NULL, o_orderstatus, o_totalprice, -1, o_orderstatus,
       'UnionShapeError at x', 'UnionShapeError at x'
FROM orders
""")
def merge_union_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of two shapes become the members of a target, also inside an array."""
    wh = open_warehouse(spark, sf_dir, "lineitem", "orders")
    line = "named_struct('line', l_linenumber, 'shipped', l_shipdate)"
    order = "named_struct('status', o_orderstatus, 'price', o_totalprice)"
    frames = [
        wh.read_table("src.lineitem").selectExpr("l_orderkey AS k", f"{line} AS x", f"array({line}) AS a"),
        wh.read_table("src.orders").selectExpr("o_orderkey AS k", f"{order} AS x", f"array({order}) AS a"),
    ]
    first = ("of_line", _struct(("line", T.IntegerType()), ("shipped", T.TimestampNTZType())))
    second = ("of_order", _struct(("status", T.StringType()), ("price", T.DoubleType())))

    def target(*members: tuple[str, T.DataType]) -> T.StructType:
        both = _struct(first, second)
        return _struct(("k", T.LongType()), ("x", _struct(*members)), ("a", T.ArrayType(both)))

    reports = {
        "too_wide": refusal(lambda: merge_union(frames, target(first, second, ("more", first[1])))),
        "loses_all": refusal(lambda: merge_union(frames, target(second, first))),
    }
    flat = merge_union(frames, target(first, second)).selectExpr(
        "k",
        "COALESCE(x.of_line.line, -1) AS line",
        "CAST(CAST(x.of_line.shipped AS DATE) AS STRING) AS shipped",
        "x.of_order.status AS status",
        "COALESCE(x.of_order.price, -1.0D) AS price",
        "COALESCE(a[0].of_line.line, -1) AS in_line",
        "a[0].of_order.status AS in_status",
    )
    return flat.withColumns({name: F.lit(kind) for name, kind in reports.items()})


@query("""
SELECT l_orderkey AS k, l_linenumber AS number, CAST(NULL AS VARCHAR) AS words,
       'UnionShapeError at x' AS too_wide, 'TypeMismatchError at x' AS no_struct,
       'TypeMismatchError at x.words' AS wrong_member
FROM lineitem
UNION ALL
SELECT o_orderkey, -1, o_orderpriority,
       'UnionShapeError at x', 'TypeMismatchError at x', 'TypeMismatchError at x.words'
FROM orders
""")
def merge_union_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With a target schema the members take its names; its shape must fit."""
    wh = open_warehouse(spark, sf_dir, "lineitem", "orders")
    frames = [
        wh.read_table("src.lineitem").selectExpr("l_orderkey AS k", "l_linenumber AS x"),
        wh.read_table("src.orders").selectExpr("o_orderkey AS k", "o_orderpriority AS x"),
    ]

    def target(x: T.DataType) -> T.StructType:
        return _struct(("k", T.LongType()), ("x", x))

    number, words = ("number", T.IntegerType()), ("words", T.StringType())
    wide = _struct(number, words, ("more", T.LongType()))
    odd = _struct(number, ("words", T.BinaryType()))
    reports = {
        "too_wide": refusal(lambda: merge_union(frames, target(wide))),
        "no_struct": refusal(lambda: merge_union(frames, target(T.StringType()))),
        "wrong_member": refusal(lambda: merge_union(frames, target(odd))),
    }
    merged = merge_union(frames, target(_struct(number, words)))
    flat = merged.selectExpr("k", "COALESCE(x.number, -1) AS number", "x.words AS words")
    return flat.withColumns(
        {name: F.lit(kind) for name, kind in reports.items()}
    )
