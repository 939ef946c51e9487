"""Registered queries against their SQL, and the pipeline stage by stage."""

import hashlib
from collections import Counter, defaultdict

import duckdb
import pandas as pd
import pytest

import __spark_entry__
import corpus_pipeline
from stowage.llm.queries import CHECK_SQL, QUERIES
from tests.conftest import SF_DIR
from tests.llm.conftest import ODD
from tests.llm.test_corpus_lookups import expected_repeats, words_of
from tests.llm.test_near_duplicates import classes_by_hand


def test_each_operator_has_its_query():
    names = [n for n in __spark_entry__.queries() if n.startswith("op")]
    assert sorted({int(n[2:].split("_")[0]) for n in names}) == list(range(1, 14)) and len(names) == 13
    assert "pipeline" in __spark_entry__.queries()
    assert set(CHECK_SQL) <= set(__spark_entry__.oracle_sql())


@pytest.mark.parametrize("name", sorted(CHECK_SQL))
def test_query_gives_the_rows_of_its_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    want = con.execute(CHECK_SQL[name]).df()
    got = QUERIES[name](spark, SF_DIR).toPandas()
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    got, want = (x[columns].sort_values(columns).reset_index(drop=True) for x in (got, want))
    pd.testing.assert_frame_equal(got, want, check_dtype=False, check_exact=True)


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The result of each stage, written and read again, behind its input."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    out = [docs]
    root = tmp_path_factory.mktemp("stages")
    for n, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(root / str(n))
        stage(spark, out[-1], SF_DIR).write.parquet(path)
        out.append(spark.read.parquet(path))
    return [x.collect() for x in out], [x.columns for x in out]


def test_stages_keep_the_columns(stages):
    rows, columns = stages
    assert all(c == columns[0] for c in columns[:-1])
    assert all(rows)


def test_near_copies_leave_one_and_passages_leave_the_first(stages):
    _, good, single, cut = stages[0][:4]
    group = classes_by_hand([(r.doc_id, r.text) for r in good])
    assert {r.doc_id for r in single} == {d for d, c in group.items() if d == c}
    want = expected_repeats([(r.doc_id, r.text) for r in single])
    for r in cut:
        kept = " ".join(words_of(r.text))
        assert hashlib.sha256(kept.encode()).hexdigest() == want[r.doc_id][2]
        assert r.n_chars == len(r.text)


def test_mix_is_near_its_targets_and_packed_whole(stages):
    cut, mixed, packed = stages[0][3:6]
    sizes = {r.doc_id: len(words_of(r.text)) for r in cut}
    taken, of_source, source = Counter(), Counter(), Counter()
    for r in mixed:
        taken[r.doc_id] += len(words_of(r.text))
        of_source[r.source] += len(words_of(r.text))
    for r in cut:
        source[r.source] += sizes[r.doc_id]
        assert taken[r.doc_id] <= 2 * sizes[r.doc_id]
    assert abs(sum(of_source.values()) - 1.5 * sum(sizes.values())) <= len(source)
    assert sum(r.length for r in packed) == sum(taken.values())
    bins = defaultdict(list)
    for r in packed:
        if r.bin_id is not None:
            bins[r.bin_id].append(r)
    for held in bins.values():
        assert sum(r.length for r in held) <= 2048
        assert len({r.source for r in held}) == len(held)


def test_quality_stage_drops_bad_documents(spark, stages):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    kept = {r.doc_id for r in stages[0][1]}
    wrong = [d for d, q in labels.items() if (d in kept) != (q == 1)]
    assert len(wrong) <= 0.05 * len(labels)  # the sample is of 64 documents here; accuracy is tested on more


def test_pipeline_of_an_empty_table(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_DIR)
        assert docs.collect() == []


def test_pipeline_of_odd_rows(spark, documents):
    """Nulls, blanks, long texts, repeated rows and columns that clash pass every stage."""
    docs = documents(*ODD, (50, "plain words of one more text, twice", None), (50, "plain words of one more text, twice", None))
    columns = docs.columns
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF_DIR)
        assert docs.columns == columns
    rows = docs.collect()
    assert {r.doc_id for r in rows} <= {d for d, _ in ODD} | {50}
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).collect()
    assert sum(r.length for r in packed) == sum(len(words_of(r.text)) for r in rows)


def test_run_gives_what_the_stages_give(spark, stages):
    got = Counter(tuple(r) for r in corpus_pipeline.run(spark, SF_DIR).collect())
    assert got == Counter(tuple(r) for r in stages[0][5])
