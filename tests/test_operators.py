"""Load form, conform and merge: fixtures case by case, and properties over random schemas."""

import datetime as dt
from decimal import Decimal

import duckdb
import pytest
from conftest import SF_DIR
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stowage import conform, load_form, load_schema, merge_union, record_namespaces
from stowage.errors import (
    DuplicateColumnError,
    MissingFieldError,
    NamespaceError,
    SpecError,
    TypeMismatchError,
    UnionShapeError,
    UnsupportedTypeError,
)
from stowage.functions.types import loosen, same_type
from stowage.operators.load_form import require_namespaces
from stowage.plans.registry import REGISTERED
import stowage.plans  # noqa: F401  (queries register themselves)

INT, LONG, STR, DBL, FLT = (
    T.IntegerType(),
    T.LongType(),
    T.StringType(),
    T.DoubleType(),
    T.FloatType(),
)


def struct(*fields):
    return T.StructType([T.StructField(n, t, *rest) for n, t, *rest in fields])


def values(df):
    return [tuple(r) for r in df.collect()]


# -- load form -----------------------------------------------------------------


@pytest.mark.parametrize(
    "source, target",
    [
        ("b tinyint, s smallint, i int, l bigint", "b int, s int, i int, l bigint"),
        ("f float, d double", "f float, d double"),
        (
            "d decimal(10,3), s string, b binary, t boolean",
            "d string, s string, b binary, t boolean",
        ),
        ("t timestamp, n timestamp_ntz, d date", "t bigint, n bigint, d bigint"),
        ("a array<decimal(10,3)>", "a array<string>"),
        ("m map<string,smallint>", "m map<string,int>"),
        (
            "r struct<x:tinyint,y:struct<d:date>>",
            "r struct<x:int,y:struct<d:bigint>>",
        ),
        (
            "a array<struct<d:decimal(10,3),t:timestamp>>, m map<string,struct<x:smallint>>",
            "a array<struct<d:string,t:bigint>>, m map<string,struct<x:int>>",
        ),
        ("a array<array<tinyint>>", "a array<array<int>>"),
    ],
)
def test_load_types(spark, source, target):
    df = spark.createDataFrame([], source)
    assert load_schema(df.schema) == spark.createDataFrame([], target).schema
    assert load_form(df).schema.simpleString() == load_schema(df.schema).simpleString()


@pytest.mark.parametrize(
    "bad, path",
    [
        ("map(1, 2) AS m", "m"),
        ("NULL AS v", "v"),
        ("INTERVAL '1' DAY AS i", "i"),
        ("INTERVAL '1' MONTH AS i", "i"),
        ("parse_json('1') AS j", "j"),
        ("array(named_struct('x', map(1, 2))) AS a", "a.x"),
        ("map('k', map(1, 2)) AS m", "m"),
    ],
)
def test_load_refuses(spark, bad, path):
    with pytest.raises(UnsupportedTypeError) as e:
        load_form(spark.sql(f"SELECT {bad}"))
    assert e.value.path == path


def test_load_refuses_double_names(spark):
    with pytest.raises(DuplicateColumnError):
        load_form(spark.sql("SELECT 1 AS a, 2 AS a"))


TIMES = """SELECT TIMESTAMP_NTZ '1969-12-31 23:59:59.9995' AS n, DATE '1969-12-31' AS d,
       TIMESTAMP '2024-03-10 02:30:00.123456Z' AS t
       UNION ALL SELECT TIMESTAMP_NTZ '2024-03-10 02:30:00.123456', DATE '2024-03-10', NULL
       UNION ALL SELECT NULL, NULL, TIMESTAMP '1969-12-31 23:59:59.9995Z'"""


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_times_are_utc_in_any_session(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        times = spark.sql(TIMES)
        got = values(load_form(times))
        nested = values(load_form(times.select(F.array("n").alias("n"), F.struct("d").alias("d"))))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert sorted(got, key=str) == sorted(
        [
            (-1, -86_400_000, 1_710_037_800_123),
            (1_710_037_800_123, 1_710_028_800_000, None),
            (None, None, -1),
        ],
        key=str,
    )
    assert sorted(n[0][0] or 0 for n in nested) == [-1, 0, 1_710_037_800_123]


def test_decimals_keep_their_scale(spark):
    df = spark.sql("SELECT 1.5BD AS a, CAST(1.5 AS DECIMAL(10,3)) AS b, array(0.0000000001BD) AS c")
    assert values(load_form(df)) == [("1.5", "1.500", ["0.0000000001"])]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_decimals_are_plain_digits_in_any_session(spark, ansi):
    texts = ["0", "0.00000012", "-0.00000012", "0.000000000000000001", "-1.5", "12345678901234567890.123456789012345678"]
    big = "9" * 38
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        flat = spark.createDataFrame([(t,) for t in texts], "t string").select(F.col("t").cast("decimal(38,18)").alias("d"))
        nested = flat.select(
            F.struct(F.array("d", F.lit(None)).alias("a"), F.create_map(F.lit("k"), "d").alias("m")).alias("s"),
            F.lit(big).cast("decimal(38,0)").alias("b"), F.lit("0." + big).cast("decimal(38,38)").alias("z"),
        )
        got = [r.d for r in load_form(flat).collect()]
        deep = load_form(nested).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
    want = [f"{Decimal(t):.18f}" for t in texts]
    assert got == want
    assert [(r.s.a, r.s.m) for r in deep] == [([w, None], {"k": w}) for w in want]
    assert {(r.b, r.z) for r in deep} == {(big, "0." + big)}


@pytest.mark.parametrize("more", [40_000, 200_000_000])
def test_scalar_query_at_larger_keys(spark, tmp_path, more):
    lines = spark.read.parquet(f"{SF_DIR}/lineitem.parquet")
    moved = lines.withColumns({"l_suppkey": F.col("l_suppkey") + more, "l_partkey": F.col("l_partkey") + more})
    moved.write.parquet(f"{tmp_path}/lineitem.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW lineitem AS SELECT * FROM '{tmp_path}/lineitem.parquet/*.parquet'")
    query = REGISTERED["load_form_scalar"]
    want = con.execute(query.check_sql).df()
    got = query.run(spark, str(tmp_path)).toPandas()[list(want.columns)]
    keys = ["l_orderkey", "l_linenumber"]
    for name in ("small", "big", "ts"):
        assert (got.sort_values(keys)[name].values == want.sort_values(keys)[name].values).all()


def test_null_containers_stay_null(spark):
    df = spark.createDataFrame(
        [
            (None, None, None, None),
            ([None], {"k": None}, (None, None), [None]),
            ([Decimal("1.000")], {"k": 1}, (1, (dt.date(1970, 1, 2),)), [(dt.date(1970, 1, 3),)]),
        ],
        "a array<decimal(10,3)>, m map<string,smallint>, "
        "r struct<x:tinyint,y:struct<d:date>>, s array<struct<d:date>>",
    )
    got = [r.asDict(recursive=True) for r in load_form(df).collect()]
    assert got[0] == {"a": None, "m": None, "r": None, "s": None}
    assert got[1] == {"a": [None], "m": {"k": None}, "r": {"x": None, "y": None}, "s": [None]}
    assert got[2] == {
        "a": ["1.000"],
        "m": {"k": 1},
        "r": {"x": 1, "y": {"d": 86_400_000}},
        "s": [{"d": 172_800_000}],
    }


def test_record_namespaces():
    inner = struct(("x", INT))
    schema = struct(
        ("r", struct(("q", inner), ("n", INT))),
        ("a", T.ArrayType(inner)),
        ("m", T.MapType(STR, inner)),
        ("aa", T.ArrayType(T.ArrayType(inner))),
        ("n", INT),
    )
    assert record_namespaces(schema, "ns") == {
        "r": "ns.r",
        "r.q": "ns.r.q",
        "a": "ns.a",
        "m": "ns.m",
        "aa": "ns",
    }
    require_namespaces(schema, "ns")
    with pytest.raises(NamespaceError) as e:
        require_namespaces(schema, "")
    assert e.value.path == "r"
    require_namespaces(struct(("n", INT)), "")


# -- conform -------------------------------------------------------------------


def test_conform_reorders_drops_and_fills(spark):
    df = spark.sql("SELECT 1 AS a, 'x' AS b, 9 AS z")
    target = struct(("b", STR), ("a", INT), ("c", STR))
    out = conform(df, target)
    assert values(out) == [("x", 1, None)]
    assert same_type(out.schema, target)


@pytest.mark.parametrize(
    "source, target, error, path",
    [
        ("1 AS a", struct(("a", INT), ("c", STR, False)), MissingFieldError, "c"),
        ("named_struct('x', 1) AS r", struct(("r", struct(("y", INT, False)))), MissingFieldError, "r.y"),
        ("1 AS a", struct(("a", LONG)), TypeMismatchError, "a"),
        ("CAST(1 AS FLOAT) AS a", struct(("a", DBL)), TypeMismatchError, "a"),
        ("1 AS a", struct(("a", struct(("x", INT)))), TypeMismatchError, "a"),
        ("array(1) AS a", struct(("a", T.ArrayType(LONG))), TypeMismatchError, "a"),
        ("map('k', 1) AS m", struct(("m", T.MapType(STR, LONG))), TypeMismatchError, "m"),
        ("map(1, 1) AS m", struct(("m", T.MapType(INT, INT))), TypeMismatchError, "m"),
        ("array(named_struct('x', 1)) AS a", struct(("a", T.ArrayType(struct(("x", STR))))), TypeMismatchError, "a.x"),
    ],
)
def test_conform_refuses(spark, source, target, error, path):
    with pytest.raises(error) as e:
        conform(spark.sql(f"SELECT {source}"), target)
    assert e.value.path == path


@pytest.mark.parametrize(
    "source, target, message",
    [
        ("array(1, NULL) AS a", T.ArrayType(INT, False), "null array element at path a"),
        ("map('k', CAST(NULL AS INT)) AS a", T.MapType(STR, INT, False), "null map value at path a"),
        (
            "array(array(1), array(NULL, 1)) AS a",
            T.ArrayType(T.ArrayType(INT, False)),
            "null array element at path a",
        ),
        (
            "named_struct('x', array(named_struct('y', map('k', CAST(NULL AS INT))))) AS a",
            struct(("x", T.ArrayType(struct(("y", T.MapType(STR, INT, False)))))),
            "null map value at path a.x.y",
        ),
    ],
)
def test_conform_stops_at_nulls(spark, source, target, message):
    df = conform(spark.sql(f"SELECT {source}"), struct(("a", target)))
    with pytest.raises(Exception, match=message):
        df.collect()


def test_conform_lets_null_containers_pass(spark):
    df = spark.createDataFrame(
        [(None, None, None)], "a array<int>, m map<string,int>, r struct<x:int,y:int>"
    )
    target = struct(
        ("a", T.ArrayType(INT, False)),
        ("m", T.MapType(STR, INT, False)),
        ("r", struct(("y", INT, False))),
    )
    assert values(conform(df, target)) == [(None, None, None)]


def test_conform_keeps_nulls_where_allowed(spark):
    df = spark.sql("SELECT array(1, NULL) AS a, map('k', CAST(NULL AS INT)) AS m")
    assert values(conform(df, df.schema)) == [([1, None], {"k": None})]


NULLS = [True, False]
DEEP = "named_struct('x', array(named_struct('y', map('k', array(1)), 'z', id)), 'w', 'v') AS r"


def deep(outer, inner):
    """The type of ``DEEP`` without its last field, with these null rules."""
    values_of = T.MapType(STR, T.ArrayType(INT, inner), inner)
    return struct(("x", T.ArrayType(struct(("y", values_of, inner), ("z", LONG, inner)), inner), outer))


@pytest.mark.parametrize("outer", NULLS)
@pytest.mark.parametrize("inner", NULLS)
@pytest.mark.parametrize("loose_source", NULLS)
def test_a_strict_frame_has_the_target_schema(spark, outer, inner, loose_source):
    df = spark.range(3).selectExpr("id", "CAST(id AS STRING) AS s", DEEP)
    if loose_source:
        df = df.select(*[F.when(F.col("id") >= 0, F.col(c).cast(loosen(df.schema[c].dataType))).alias(c) for c in df.columns])
    target = struct(("r", deep(outer, inner), outer), ("id", LONG, inner), ("new", DBL), ("s", STR, outer))
    out = conform(df, target, strict=True)
    assert out.schema == target
    assert sorted(r.id for r in out.collect()) == [0, 1, 2]
    assert out.filter("r.x[0].z = 1 AND r.x[0].y['k'][0] = 1 AND new IS NULL AND s = '1'").count() == 1


def test_a_frame_says_what_was_checked(spark):
    df = spark.sql("SELECT array(1, id) AS a, map('k', id) AS m, named_struct('x', id, 'y', id) AS r, id FROM VALUES (1L), (2L) AS v(id)")
    df = df.withColumns({c: F.when(F.col("id") > 0, F.col(c)).cast(loosen(df.schema[c].dataType)) for c in df.columns})
    target = struct(("a", T.ArrayType(LONG, False)), ("m", T.MapType(STR, LONG, False)), ("r", struct(("x", LONG, False))), ("id", LONG, False))
    out = conform(df, target)
    assert [out.schema[c] == target[c] for c in target.names] == [True, True, False, False]  # fields are not checked
    assert conform(df, target, strict=True).schema == target
    assert values(conform(df, target, strict=True)) == values(out)
    out.write.format("noop").mode("overwrite").save()


def test_looser_rules_cost_nothing(spark):
    df = spark.range(3).selectExpr("id", "array(id) AS a", "named_struct('x', id) AS r")
    target = struct(("id", LONG), ("a", T.ArrayType(LONG)), ("r", struct(("x", LONG))))
    out = conform(df, target)
    assert out.schema == target
    text = out._jdf.queryExecution().optimizedPlan().toString()
    assert not any(w in text.lower() for w in ("case", "coalesce", "transform", "if"))


def test_metadata_of_the_target_comes_along(spark):
    target = T.StructType([T.StructField("id", LONG, False, {"unit": "row"}), T.StructField("n", INT, True, {"a": 1})])
    assert conform(spark.range(2), target).schema == target


@pytest.mark.parametrize(
    "source, target, path",
    [
        ("CAST(NULL AS INT) AS a", struct(("a", INT, False)), "a"),
        ("named_struct('x', CAST(NULL AS STRING)) AS a", struct(("a", struct(("x", STR, False)))), "a.x"),
        (
            "array(named_struct('x', 1), named_struct('x', NULL)) AS a",
            struct(("a", T.ArrayType(struct(("x", INT, False))))),
            "a.x",
        ),
        ("CAST(NULL AS ARRAY<INT>) AS a", struct(("a", T.ArrayType(INT), False)), "a"),
    ],
)
def test_strict_stops_at_nulls_in_required_fields(spark, source, target, path):
    df = spark.sql(f"SELECT {source}")
    conform(df, target).collect()
    with pytest.raises(Exception, match=f"null in required field at path {path}"):
        conform(df, target, strict=True).collect()


def test_strict_lets_null_containers_of_required_fields_pass(spark):
    df = spark.createDataFrame([(None, [None])], "r struct<x:int>, a array<struct<x:int>>")
    target = struct(("r", struct(("x", INT, False))), ("a", T.ArrayType(struct(("x", INT, False)))))
    assert values(conform(df, target, strict=True)) == [(None, [None])]


@pytest.mark.parametrize("kind", [
    "boolean", "tinyint", "smallint", "int", "bigint", "float", "double", "decimal(3,3)", "decimal(38,0)", "string",
    "binary", "date", "timestamp", "timestamp_ntz", "array<int>", "map<string,date>", "struct<x:binary>",
])
def test_every_plain_type_can_be_required(spark, kind):
    df = spark.createDataFrame([], f"a {kind}")
    target = T.StructType([T.StructField("a", df.schema["a"].dataType, False)])
    out = conform(df, target, strict=True)
    assert out.schema == target
    assert out.collect() == []


def test_strict_refuses_types_that_cannot_be_required(spark):
    df = spark.sql("SELECT IF(id < 0, NULL, INTERVAL '1' DAY) AS a FROM range(1)")
    target = T.StructType([T.StructField("a", df.schema["a"].dataType, False)])
    with pytest.raises(UnsupportedTypeError):
        conform(df, target, strict=True)
    assert conform(df, target).count() == 1


# -- merge by the union rule ---------------------------------------------------


def merged(spark, *exprs, schema=None):
    return merge_union([spark.sql(f"SELECT {e}") for e in exprs], schema)


@pytest.mark.parametrize(
    "exprs, want, got",
    [
        (["1 AS x", "2 AS x"], "int", [1, 2]),
        (["1 AS x", "2L AS x"], "bigint", [1, 2]),
        (["2L AS x", "1 AS x"], "bigint", [2, 1]),
        (["1F AS x", "2D AS x"], "double", [1.0, 2.0]),
        (["2D AS x", "1F AS x"], "double", [2.0, 1.0]),
        (["1 AS x", "'a' AS x"], "struct<member0:int,member1:string>", [(1, None), (None, "a")]),
        (["1 AS x", "2F AS x"], "struct<member0:int,member1:float>", [(1, None), (None, 2.0)]),
        (
            ["1 AS x", "2L AS x", "'a' AS x"],
            "struct<member0:int,member1:bigint,member2:string>",
            [(1, None, None), (None, 2, None), (None, None, "a")],
        ),
        (
            ["CAST(NULL AS INT) AS x", "CAST(NULL AS STRING) AS x"],
            "struct<member0:int,member1:string>",
            [None, None],
        ),
        (["NULL AS x", "1 AS x"], "int", [None, 1]),
        (["array(1) AS x", "array(2L, NULL) AS x"], "array<bigint>", [[1], [2, None]]),
        (["map('k', 1F) AS x", "map('k', 2D) AS x"], "map<string,double>", [{"k": 1}, {"k": 2}]),
        (["1 AS x", "array(1) AS x"], "struct<member0:int,member1:array<int>>", [(1, None), (None, [1])]),
        (["1S AS x", "1 AS x"], "struct<member0:smallint,member1:int>", [(1, None), (None, 1)]),
    ],
)
def test_union_rule(spark, exprs, want, got):
    out = merged(spark, *exprs)
    assert out.schema["x"].dataType.simpleString() == want
    assert sorted((r.x for r in out.collect()), key=str) == sorted(got, key=str)


def test_union_of_structs_goes_field_by_field(spark):
    out = merged(
        spark,
        "named_struct('n', 1, 'a', 'p') AS r",
        "named_struct('b', true, 'n', 2L) AS r",
        "CAST(NULL AS STRUCT<n: INT>) AS r",
    )
    assert out.schema.simpleString() == "struct<r:struct<n:bigint,a:string,b:boolean>>"
    got = {tuple(r.r) if r.r else None for r in out.collect()}
    assert got == {(1, "p", None), (2, None, True), None}


def test_absent_fields_are_filled(spark):
    out = merged(spark, "1 AS x", "2 AS y", "3 AS x, 4 AS y")
    assert out.columns == ["x", "y"]
    assert sorted(values(out), key=str) == sorted([(1, None), (None, 2), (3, 4)], key=str)


def test_members_by_target(spark):
    both = struct(("i", INT), ("s", STR))
    out = merged(spark, "1 AS x", "'a' AS x", schema=struct(("x", both)))
    assert out.schema["x"].dataType.simpleString() == "struct<i:int,s:string>"
    assert sorted(values(out), key=str) == [((1, None),), ((None, "a"),)]


A, B = struct(("a", INT)), struct(("b", STR))
AS_A, AS_B = "named_struct('a', 1) AS x", "named_struct('b', 'q') AS x"


def plain(df):
    """The values of column ``x``, rows as tuples."""
    def walk(v):
        if isinstance(v, dict):
            return {k: walk(w) for k, w in v.items()}
        return [walk(w) for w in v] if isinstance(v, list) else tuple(map(walk, v)) if isinstance(v, tuple) else v

    return sorted((walk(r.x) for r in df.collect()), key=str)


def test_unlike_records_become_members_of_a_target(spark):
    both = struct(("m0", A), ("m1", B))
    got = merged(spark, AS_A, AS_B, "CAST(NULL AS STRUCT<a: INT>) AS x", schema=struct(("x", both)))
    assert plain(got) == [((1,), None), (None, ("q",)), None]
    arrays = [e.replace("named", "array(named").replace(" AS", ") AS") for e in (AS_A, AS_B)]
    got = merged(spark, *arrays, schema=struct(("x", T.ArrayType(both))))
    assert plain(got) == [[((1,), None)], [(None, ("q",))]]
    maps = [e.replace("named", "map('k', named").replace(" AS", ") AS") for e in (AS_A, AS_B)]
    got = merged(spark, *maps, schema=struct(("x", T.MapType(STR, both))))
    assert plain(got) == [{"k": ((1,), None)}, {"k": (None, ("q",))}]


@pytest.mark.parametrize(
    "target",
    [
        struct(("m0", A), ("m1", B), ("m2", B)),  # wrong width
        struct(("m0", A)),
        struct(("m0", B), ("m1", A)),  # wrong order: each would lose all its fields
        struct(("c", INT), ("d", STR)),
        A,  # the second record would lose all its fields
    ],
)
def test_records_never_lose_all_their_fields(spark, target):
    with pytest.raises(UnionShapeError):
        merged(spark, AS_A, AS_B, schema=struct(("x", target)))


def test_records_with_a_common_field_go_field_by_field_into_a_target(spark):
    target = struct(("x", struct(("n", LONG), ("a", STR))))
    got = merged(spark, "named_struct('n', 1, 'a', 'p') AS x", "named_struct('n', 2L) AS x", schema=target)
    assert sorted(values(got), key=str) == sorted([((1, "p"),), ((2, None),)], key=str)


def test_unlike_records_without_a_schema(spark):
    frames = [spark.sql(f"SELECT {e}, array({e.partition(' AS')[0]}) AS y") for e in (AS_A, AS_B)]
    assert merge_union(frames).schema.simpleString() == "struct<x:struct<a:int,b:string>,y:array<struct<a:int,b:string>>>"
    apart = merge_union(frames, records="members")
    member = "struct<member0:struct<a:int>,member1:struct<b:string>>"
    assert apart.schema.simpleString() == f"struct<x:{member},y:array<{member}>>"
    assert plain(apart) == [((1,), None), (None, ("q",))]
    with pytest.raises(SpecError):
        merge_union(frames, records="other")


def test_names_that_differ_in_case_only(spark):
    with pytest.raises(DuplicateColumnError):
        merged(spark, "1 AS A", "2 AS a")


def test_widening_pair_may_go_to_a_struct_of_two(spark):
    pair = struct(("i", INT), ("l", LONG))
    out = merged(spark, "1 AS x", "2L AS x", schema=struct(("x", pair)))
    assert sorted(values(out), key=str) == [((1, None),), ((None, 2),)]


@pytest.mark.parametrize(
    "target, error",
    [
        (struct(("a", INT)), UnionShapeError),
        (struct(("a", INT), ("b", STR), ("c", STR)), UnionShapeError),
        (struct(("a", STR), ("b", INT)), TypeMismatchError),
        (STR, TypeMismatchError),
    ],
)
def test_union_shape(spark, target, error):
    with pytest.raises(error):
        merged(spark, "1 AS x", "'a' AS x", schema=struct(("x", target)))


def test_required_field_of_the_target(spark):
    with pytest.raises(MissingFieldError):
        merged(spark, "1 AS x", "2 AS y", schema=struct(("x", INT, False)))


def test_many_frames(spark):
    frames = [spark.range(1).selectExpr(f"{i} AS x") for i in range(33)]
    assert sorted(r.x for r in merge_union(frames).collect()) == list(range(33))


# -- properties ----------------------------------------------------------------

LEAVES = st.sampled_from(
    [
        T.ByteType(),
        T.ShortType(),
        INT,
        LONG,
        FLT,
        DBL,
        T.DecimalType(9, 2),
        STR,
        T.BooleanType(),
        T.DateType(),
        T.TimestampType(),
        T.TimestampNTZType(),
    ]
)


def structs(inner):
    fields = st.lists(inner, min_size=1, max_size=3)
    return fields.map(lambda ts: struct(*[(f"f{i}", t) for i, t in enumerate(ts)]))


NESTED = st.recursive(
    LEAVES,
    lambda t: st.one_of(
        t.map(T.ArrayType), t.map(lambda v: T.MapType(STR, v)), structs(t)
    ),
    max_leaves=5,
)

SAMPLES = {
    "tinyint": 7,
    "smallint": -300,
    "int": 70_000,
    "bigint": 2**40,
    "float": 0.5,
    "double": -2.25,
    "decimal(9,2)": Decimal("12.50"),
    "string": "ä",
    "boolean": True,
    "date": dt.date(1969, 7, 20),
    "timestamp": dt.datetime(1969, 7, 20, 20, 17, 40),
    "timestamp_ntz": dt.datetime(1969, 7, 20, 20, 17, 40),
}


def sample(t):
    """A value of type ``t`` with nulls beside its parts."""
    if isinstance(t, T.ArrayType):
        return [sample(t.elementType), None]
    if isinstance(t, T.MapType):
        return {"k": sample(t.valueType), "n": None}
    if isinstance(t, T.StructType):
        return tuple(sample(f.dataType) for f in t.fields)
    return SAMPLES[t.simpleString()]


@settings(
    max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(schema=structs(NESTED))
def test_load_form_is_stable(spark, schema):
    nothing = tuple(None for _ in schema.fields)
    df = spark.createDataFrame([sample(schema), nothing], schema)
    once = load_form(df)
    rows = values(once)
    assert same_type(once.schema, load_schema(schema))
    assert values(load_form(once)) == rows
    assert values(conform(once, once.schema)) == rows
    assert values(merge_union([once.limit(1), once.limit(0)])) == rows[:1]


def union_by_hand(types):
    """The union rule on scalar types, and where a value of each type goes."""
    names = list(dict.fromkeys(t.simpleString() for t in types))
    if len(names) == 1:
        return names[0], None
    for wide in ({"int", "bigint"}, {"float", "double"}):
        if set(names) == wide:
            return max(wide, key=["int", "bigint", "float", "double"].index), None
    return f"struct<{','.join(f'member{i}:{n}' for i, n in enumerate(names))}>", names


@settings(
    max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(types=st.lists(LEAVES, min_size=1, max_size=4))
def test_union_rule_against_a_rule_by_hand(spark, types):
    frames = [
        spark.createDataFrame([(i, SAMPLES[t.simpleString()]), (i, None)], struct(("i", INT), ("x", t)))
        for i, t in enumerate(types)
    ]
    out = merge_union(frames)
    want, members = union_by_hand(types)
    assert out.schema["x"].dataType.simpleString() == want
    for row in out.collect():
        if row.x is None:
            continue
        name = types[row.i].simpleString()
        value = row.x
        if members:
            assert [v is not None for v in row.x] == [m == name for m in members]
            value = row.x[members.index(name)]
        assert value == SAMPLES[name]
    assert sum(r.x is None for r in out.collect()) == len(types)


@settings(
    max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(schema=structs(structs(NESTED)), picks=st.randoms())
def test_conform_against_a_projection_by_hand(spark, schema, picks):
    """Shuffle, drop and add fields at two levels; compare with dictionaries."""

    def vary(s, deep):
        fields = picks.sample(s.fields, k=picks.randint(0, len(s.fields)))
        fields = [
            T.StructField(f.name, vary(f.dataType, False) if deep else f.dataType) for f in fields
        ]
        return T.StructType([*fields, T.StructField("new", STR)])

    def project(row, s, deep):
        if row is None:
            return None
        return tuple(
            project(row.get(f.name), f.dataType, False)
            if deep and f.name in row
            else row.get(f.name)
            for f in s.fields
        )

    df = spark.createDataFrame([sample(schema), tuple(None for _ in schema.fields)], schema)
    target = vary(schema, True)
    rows = [
        {k: v.asDict() if isinstance(v, T.Row) else v for k, v in r.asDict().items()}
        for r in df.collect()
    ]
    assert values(conform(df, target)) == [project(r, target, True) for r in rows]
