"""Results met by other warehouses, loads that can be repeated, compaction, and files of even size."""

import threading

import pytest

from stowage import Warehouse
from stowage.errors import OverlappingSaveError, SchemaMismatchError, TableNotFoundError
from stowage.sources import publishing, saves, selects
from stowage.sources.files import create_new, files_below

DAY_MS = 86_400_000
PLACES = ["ds.t", "ds.d$20240101"]


@pytest.fixture
def frame(spark):
    return spark.createDataFrame([(1, "a"), (2, "b")], "n int, s string")


@pytest.fixture
def other(spark, warehouse, tmp_path):
    """Another warehouse on the same catalog, in a session of its own."""
    return Warehouse(spark.newSession(), str(tmp_path), warehouse.project)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def before_write(monkeypatch, act):
    write = saves._write

    def first(*args, **how):
        monkeypatch.setattr(saves, "_write", write)
        act()
        return write(*args, **how)

    monkeypatch.setattr(saves, "_write", first)


# -- results -------------------------------------------------------------------


def test_another_warehouse_meets_a_result_until_it_expires(warehouse, other, frame):
    warehouse.write_table(frame, "ds.t")
    text = "SELECT SUM(n) AS n FROM [ds.t]"
    other.spark.conf.set("spark.sql.ansi.enabled", other.spark.conf.get("spark.sql.ansi.enabled"))  # set, to what it was
    other.spark.conf.set("spark.sql.shuffle.partitions", "3")
    assert warehouse.run_select(text, 0).first().n == 3
    warehouse.write_table(frame, "ds.t")
    assert other.run_select(text, DAY_MS - 1).first().n == 3
    assert len(other.staged_results()) == 1
    assert other.run_select(text + " ", 0).first().n == 6  # another text
    assert other.run_select(text, DAY_MS).first().n == 6
    assert warehouse.run_select(text, DAY_MS).first().n == 6
    assert len(warehouse.staged_results()) == 3
    assert len(other.expire_staging(DAY_MS)) == 2
    assert warehouse.run_select(text, DAY_MS).first().n == 6
    assert len(warehouse.expire_staging(3 * DAY_MS)) == 1
    assert other.staged_results() == []


def test_a_result_of_a_text_that_means_something_else_is_not_met(warehouse, other, frame):
    frame.createOrReplaceTempView("shared_view")
    try:
        frame.limit(1).sparkSession.table("shared_view")
        other.spark.createDataFrame([(7, "z")], "n int, s string").createOrReplaceTempView("shared_view")
        text = "SELECT SUM(n) AS n FROM shared_view"
        assert (warehouse.run_select(text).first().n, other.run_select(text).first().n) == (3, 7)
        text = "SELECT CAST(TIMESTAMP '2024-01-01 00:00:00 UTC' AS STRING) AS t"
        first = warehouse.run_select(text).first().t
        other.spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        assert other.run_select(text).first().t != first
        assert warehouse.run_select(text).first().t == first
    finally:
        warehouse.spark.catalog.dropTempView("shared_view")


def test_two_drivers_run_a_text_once(warehouse, other, frame, monkeypatch):
    warehouse.write_table(frame, "ds.t")
    runs, stage = [], selects.Selects._stage

    def counted(self, sql, now_ms, digest):
        runs.append(sql)
        return stage(self, sql, now_ms, digest)

    monkeypatch.setattr(selects.Selects, "_stage", counted)
    got = []
    threads = [threading.Thread(target=lambda w=w: got.append(w.run_select("SELECT COUNT(*) AS n FROM [ds.t]", 5).first().n))
               for w in (warehouse, other, Warehouse(other.spark, warehouse._catalog.root, warehouse.project))]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert got == [2, 2, 2] and len(runs) == 1


def test_a_failed_run_lets_the_next_one_run(warehouse, other):
    text = "SELECT raise_error('no') AS x"
    for w in (warehouse, other):
        with pytest.raises(Exception, match="no"):
            w.run_select(text)
    assert warehouse.staged_results() == []


def test_what_a_dead_holder_held_is_taken_over(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(publishing, "LEASE_S", 1.0)
    folder = f"file:{tmp_path}/held"
    create_new(spark, f"{folder}/{0:010}", "")
    inside = []

    def hold(n):
        with publishing.held(spark, folder):
            inside.append(n)
            threading.Event().wait(1.6)  # longer than the lease: the holder shows that it lives
            assert inside == [n]
            inside.clear()

    threads = [threading.Thread(target=hold, args=(n,)) for n in range(2)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert inside == []


# -- loads ---------------------------------------------------------------------


@pytest.mark.parametrize("table", PLACES)
def test_a_load_run_twice_adds_rows_once(spark, warehouse, frame, tmp_path, table):
    folder = f"{tmp_path}/in folder"
    frame.coalesce(1).write.orc(folder)
    assert warehouse.load_staged(folder, table, fmt="orc", once=True) == 1
    assert warehouse.load_staged(folder, table, fmt="orc", once=True) == 0
    frame.coalesce(1).write.mode("append").orc(folder)
    warehouse.write_table(frame.limit(1), table)
    assert warehouse.load_staged(folder, table, fmt="orc", once=True) == 1
    assert warehouse.load_staged(folder, table, fmt="orc", once=True) == 0
    assert warehouse.read_table(table).count() == 5
    warehouse.compact(table, 1 << 30)
    assert warehouse.load_staged(folder, table, fmt="orc", once=True) == 0
    assert warehouse.load_staged(folder, table, fmt="orc") == 2  # without the argument all are loaded
    assert warehouse.read_table(table).count() == 9
    # What a truncate replaces is on no list any more.
    assert warehouse.load_staged(folder, table, fmt="orc", write="truncate", once=True) == 2
    assert warehouse.read_table(table).count() == 4
    warehouse.write_table(frame, table, write="truncate")
    assert warehouse.load_staged(folder, table, fmt="orc", once=True) == 2
    assert warehouse.read_table(table).count() == 6


@pytest.mark.parametrize("table", PLACES)
@pytest.mark.parametrize("exists", [False, True])
def test_two_loads_at_once_add_rows_once(warehouse, other, frame, tmp_path, monkeypatch, table, exists):
    folder = f"{tmp_path}/in"
    frame.coalesce(1).write.parquet(folder)
    if exists:
        warehouse.write_table(frame, table)
    before_write(monkeypatch, lambda: other.load_staged(folder, table, once=True))
    assert warehouse.load_staged(folder, table, once=True) == 0
    assert warehouse.read_table(table).count() == (4 if exists else 2)


@pytest.mark.parametrize("table", PLACES)
def test_a_load_that_breaks_is_on_no_list(warehouse, frame, tmp_path, monkeypatch, table):
    folder = f"{tmp_path}/in"
    frame.coalesce(1).write.parquet(folder)
    warehouse.write_table(frame, table)

    def broken(*_, **__):
        raise RuntimeError("storage is away")

    monkeypatch.setattr(publishing.Record, "_take", broken)
    with pytest.raises(RuntimeError, match="away"):
        warehouse.load_staged(folder, table, once=True)
    monkeypatch.undo()
    assert warehouse.load_staged(folder, table, once=True) == 1
    assert warehouse.read_table(table).count() == 4


# -- compaction ----------------------------------------------------------------


@pytest.mark.parametrize("table", PLACES)
def test_many_appends_become_few_files(spark, warehouse, table):
    for n in range(12):
        warehouse.write_table(spark.range(n * 100, n * 100 + 100, 1, 5), table)
    spec = warehouse.spec(table)
    before = files_below(spark, warehouse._catalog.location(spec))
    assert len(before) >= (50 if table == "ds.t" else 5)  # an append to a day writes it anew, in fewer files
    old = warehouse.read_table(table)
    total = sum(size for _, size in before)
    assert warehouse.compact(table, -(-total // 3)) is True
    assert len(files_below(spark, warehouse._catalog.location(spec))) <= 3
    assert warehouse.compact(table, total) is True
    assert warehouse.compact(table, total) is False
    assert len(files_below(spark, warehouse._catalog.location(spec))) == 1
    assert [r.id for r in warehouse.read_table(table).orderBy("id").collect()] == list(range(1200)) == [r.id for r in old.orderBy("id").collect()]
    warehouse.write_table(spark.range(1200, 1300), table)
    warehouse.clean_up(2**62)
    assert warehouse.read_table(table).count() == 1300


@pytest.mark.parametrize("table", PLACES)
def test_an_append_during_a_compaction_is_kept(spark, warehouse, table, monkeypatch):
    for _ in range(3):
        warehouse.write_table(spark.range(0, 10, 1, 2), table)
    before_write(monkeypatch, lambda: warehouse.write_table(spark.range(5), table))
    with pytest.raises(OverlappingSaveError):
        warehouse.compact(table)
    assert warehouse.read_table(table).count() == 35
    assert warehouse.compact(table)
    assert warehouse.read_table(table).count() == 35


def test_what_compaction_refuses(spark, warehouse, frame):
    with pytest.raises(TableNotFoundError):
        warehouse.compact("ds.none")
    warehouse.write_table(frame.limit(0), "ds.t")
    assert warehouse.compact("ds.t") is False
    warehouse.write_table(frame, "ds.d$20240101")
    assert warehouse.compact("ds.d$20250101") is False
    with pytest.raises(SchemaMismatchError):
        warehouse.write_table(spark.range(3), "ds.t")


# -- files of even size --------------------------------------------------------


@pytest.fixture
def small_files(other):
    other.spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "100kb")
    other.spark.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", "1kb")
    other.spark.conf.set("spark.sql.shuffle.partitions", "64")
    return other


def sizes(wh, table):
    return [size for _, size in files_below(wh.spark, wh._catalog.location(wh.spec(table)))]


def noisy(spark, ids, parts):
    """Rows of about 40 bytes that do not compress."""
    return spark.range(0, ids, 1, parts).selectExpr("id", "unhex(sha2(CAST(id AS STRING), 256)) AS b")


@pytest.mark.parametrize("table", PLACES)
@pytest.mark.parametrize("how", [{}, {"fmt": "orc"}])
def test_many_small_partitions_become_few_files(small_files, table, how):
    df = noisy(small_files.spark, 4000, 100)
    small_files.write_table(df, table, balance=True, **how)
    assert len(sizes(small_files, table)) <= 8  # about 250 kB of the shuffle's bytes
    assert rows(small_files.read_table(table).select("id")) == [(i,) for i in range(4000)]


@pytest.mark.parametrize("write", ["truncate", "append"])
def test_one_huge_partition_becomes_files_near_the_size(small_files, write):
    small_files.write_table(noisy(small_files.spark, 0, 1), "ds.t")
    small_files.write_table(noisy(small_files.spark, 40000, 1), "ds.t", write, balance=True)
    found = [size for size in sizes(small_files, "ds.t") if size > 1000]
    assert 10 <= len(found) <= 40
    assert max(found) < 200_000
    assert rows(small_files.read_table("ds.t").select("id")) == [(i,) for i in range(40000)]


def test_skewed_partitions_become_even(small_files):
    df = noisy(small_files.spark, 30000, 1).unionByName(noisy(small_files.spark, 50, 50))
    small_files.write_table(df, "ds.t", balance=True)
    found = sizes(small_files, "ds.t")
    assert max(found) < 200_000
    assert len(found) <= 40
    assert small_files.read_table("ds.t").count() == 30050


def test_an_empty_frame_can_be_balanced(small_files):
    small_files.write_table(noisy(small_files.spark, 0, 3), "ds.t", balance=True)
    assert small_files.read_table("ds.t").count() == 0


def test_only_a_balanced_save_shuffles(spark, warehouse, monkeypatch):
    seen = []
    write = saves._write
    monkeypatch.setattr(saves, "_write", lambda df, *a, **k: (seen.append(df._jdf.queryExecution().toString()), write(df, *a, **k)))
    warehouse.write_table(spark.range(9), "ds.t")
    warehouse.write_table(spark.range(9), "ds.t", balance=True)
    assert ["Exchange" in text for text in seen] == [False, True]
