"""Registered training-data queries: DuckDB SQL where there is one, and the pipeline against its stages' rules."""

import duckdb
import pytest

import corpus_pipeline
from churnlane.llm import queries
from churnlane.llm.common import discard, recorded, stage
from tests.conftest import SF_SMALL
from tests.llm.test_operators import slow_simhash


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark", "labels"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_matches_oracle(spark, con, name):
    df = queries.QUERIES[name](spark, SF_SMALL)
    want = con.sql(queries.ORACLE[name])
    assert sorted(df.columns) == sorted(want.columns)
    at = [want.columns.index(c) for c in df.columns]
    assert sorted(map(tuple, df.collect()), key=repr) == sorted((tuple(r[i] for i in at) for r in want.fetchall()), key=repr)


@pytest.mark.parametrize("name,table", [("op2_secret_scan", "documents"), ("op3_wrapper_extract", "pages"), ("op4_pseudonyms", "documents"),
                                        ("op9_simhash", "documents"), ("op10_license_scan", "documents"), ("op7_language_id", "documents")])
def test_one_row_each(spark, con, name, table):
    assert queries.QUERIES[name](spark, SF_SMALL).count() == con.sql(f"SELECT count(*) FROM {table}").fetchall()[0][0]


def test_all_operators_and_a_pipeline():
    assert {n.split("_")[0] for n in queries.QUERIES} == {f"op{i}" for i in range(1, 14)} | {"pipeline"}


def test_pipeline(spark, con):
    docs = {r[0]: r for r in con.sql("SELECT doc_id, text FROM documents").fetchall()}
    out = corpus_pipeline.run(spark, SF_SMALL)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "copies"]
    rows = out.collect()
    assert rows and all(docs[r.doc_id][1] == r.text and r.copies >= 1 for r in rows)
    # before the mix: one row a text and a near group, none contaminated, every lost row explained
    d = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    left = {None: {r.doc_id for r in d.collect()}}
    for name, f in corpus_pipeline.STAGES[:-1]:
        d = f(spark, d, SF_SMALL).cache()
        left[name] = {r.doc_id for r in d.collect()}
    assert {i for i in left[None] - left["language_id"]} == {i for i, (_, t) in docs.items() if not any(c.isalpha() for c in t or "")}
    newest = {}
    for i in left["language_id"]:
        newest[docs[i][1]] = max(i, newest.get(docs[i][1], -1))
    assert left["exact_dedup"] == set(newest.values())
    fps = {i: slow_simhash(docs[i][1]) for i in left["exact_dedup"]}
    group = {i: i for i in fps}
    while (new := {i: min(group[j] for j in fps if (fps[i] ^ fps[j]).bit_count() <= 2) for i in fps}) != group:
        group = new
    assert left["near_dedup"] == set(group.values())
    bad = {r[0] for r in con.sql(queries.ORACLE["op6_decontaminate"]).fetchall() if r[5]}
    assert left["decontaminate"] == left["near_dedup"] - bad
    assert {r.doc_id for r in rows} <= left["decontaminate"]


def test_stages_compose_without_writing(spark):
    """One stage's frame handed to the next as it is gives what the run gives."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    for _, stage_of in corpus_pipeline.STAGES:
        docs = stage_of(spark, docs, SF_SMALL)
    key = lambda df: sorted((r.doc_id, r.copies) for r in df.collect())
    assert key(docs) == key(corpus_pipeline.run(spark, SF_SMALL))


def test_two_runs_at_once(spark):
    """Two runs whose stages interleave; scratch of either is its own."""
    runs = [spark.read.parquet(f"{SF_SMALL}/documents.parquet").filter(f"doc_id % 2 = {k}") for k in range(2)]
    alone = []
    for docs in runs:
        for _, stage_of in corpus_pipeline.STAGES:
            docs = stage(stage_of(spark, docs, SF_SMALL), "alone")
        alone.append(sorted((r.doc_id, r.copies) for r in docs.collect()))
    used = [[], []]
    for _, stage_of in corpus_pipeline.STAGES:
        for k in range(2):
            with recorded() as mine:
                kept = stage_of(spark, runs[k], SF_SMALL)
            with recorded() as written:
                runs[k] = stage(kept, "at-once")
            discard(spark, [*used[k], *mine])
            used[k] = written
    assert [sorted((r.doc_id, r.copies) for r in d.collect()) for d in runs] == alone
