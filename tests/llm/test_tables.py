"""Every registered query of the folder: against its SQL, and on tables with odd rows."""

import os

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from shopvitals.llm.oracles import ORACLES
from shopvitals.llm.queries import QUERIES
from tests.conftest import TESTDATA

TABLES = ("documents", "embeddings", "pages", "labels", "benchmark")


@pytest.mark.parametrize("name", ORACLES)
def test_query_matches_sql(name, spark):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{TESTDATA}/{table}.parquet'")
    cursor = connection.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    got = QUERIES[name](spark, TESTDATA)
    assert sorted(got.columns) == sorted(names)
    order = lambda row: [(v is None, str(v)) for v in row]
    assert sorted(map(tuple, got.select(*names).collect()), key=order) == sorted(cursor.fetchall(), key=order)


def test_fingerprints_stay_native(spark):
    plan = QUERIES["op1_document_fingerprints"](spark, TESTDATA)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"))


LONG = "long words here. " * 20_000
ODD = [
    (1, "One two three four five six.\nShared line\nmore", "en", "a", 5), (1, "One two three four five six.\nShared line\nmore", "en", "a", 5),
    (2, None, None, None, None), (3, "", "", "", 0), (None, "no id at all", "en", "a", 1), (None, None, None, None, None),
    (4, LONG, "en", "a", None), (5, "x" * 50_000, "de", None, 1), (6, " \n\n\t ", "fr", "b", 1), (2**62, "idiot " * 3, "en", "b", 3),
    (8, "a" + " " * 1_200_000 + "b", "en", "a", 1), (9, "0" * 5000 + ".1.1.1", "en", "b", 1), (10, "\n" * 700_000, "en", "b", 1),
    (-7, "a@b.cd +1 (555) 123-4567 𝒳𝒴 \x00 ퟿", "en", "c", 2),
]
CLASH = ["key", "home", "size", "row", "copies", "score", "fp", "found", "_salt", "_copy", "n_lines", "cell", "node", "payload",
         "n_links", "fingerprint", "next_text", "_range", "target", "record_type", "_text", "host", "drop", "line"]


def written(spark, folder, odd):
    documents = spark.createDataFrame(ODD if odd else [], "doc_id long, text string, lang string, source string, n_chars long")
    pages = spark.createDataFrame(
        [(1, "u", "<article><p>Hello there</p></article>"), (1, "u", "<article><p>Hello there</p></article>"), (2, None, None), (None, "v", ""),
         (3, "w", "<p>" + "many words " * 30_000), (4, "x\r\ny", "<div>" * 20_000 + "</p>" * 20_000)] if odd else [], "page_id long, url string, html string")
    embeddings = spark.createDataFrame(
        [(1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, None, None), (None, [1.0, 0.0], 1), (3, [1.0, 0.01], 2)] if odd else [],
        "vec_id long, embedding array<float>, label int")
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, 0), (2, None, None), (None, 1, 1), (2**62, 0, 1)] if odd else [], "doc_id long, quality int, toxic int")
    benchmark = spark.createDataFrame([(1, "shared line"), (1, "shared line"), (None, None), (2, "")] if odd else [], "item_id long, text string")
    named = (("documents", documents), ("pages", pages), ("embeddings", embeddings), ("labels", labels), ("benchmark", benchmark))
    for name, frame in named:
        for c in CLASH:
            frame = frame.withColumn(c, F.lit("clash"))
        frame.write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


KEYS = {"op2_html_extraction": "pages", "op8_warc": "pages", "op9_embedding_near_dedup": "embeddings"}


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    return written(spark, tmp_path_factory.mktemp("odd"), True)


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    return written(spark, tmp_path_factory.mktemp("empty"), False)


@pytest.mark.parametrize("name", [q for q in QUERIES if q != "op11_collocations"])
def test_odd_rows_all_come_back(name, spark, odd):
    source = spark.read.parquet(f"{odd}/{KEYS.get(name, 'documents')}.parquet")
    got = QUERIES[name](spark, odd)
    key = got.columns[0]
    ids = lambda frame: sorted(str(r[0]) for r in frame.select(key).collect())
    assert ids(got) == ids(source)


def test_phrases_of_odd_rows(spark, odd):
    got = [(r.lang, r.phrase, r.a) for r in QUERIES["op11_collocations"](spark, odd).collect()]
    assert got == [("en", "long words here", 20_000)]  # the pieces of one very long text


@pytest.mark.parametrize("name", QUERIES)
def test_empty_tables_give_empty_results(name, spark, empty):
    assert QUERIES[name](spark, empty).count() == 0


def test_pipeline_on_odd_and_empty_tables(spark, odd, empty):
    rows = corpus_pipeline.run(spark, odd).collect()
    assert len(rows) >= 1 and all(r.n_tokens >= 0 for r in rows)
    assert corpus_pipeline.run(spark, empty).count() == 0


def test_pipeline_stages_keep_the_columns_of_documents(spark, tmp_path):
    documents = spark.read.parquet(f"{TESTDATA}/documents.parquet")
    docs, before = documents, documents.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, docs, TESTDATA).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert docs.columns == documents.columns
        if name != "mixing":
            assert 0.6 * before <= docs.count() <= before
            before = docs.count()
    last = corpus_pipeline.STAGES[-1][1](spark, docs, TESTDATA)
    assert last.count() == docs.count()


def test_repository_works_without_this_folder():
    import subprocess
    import sys
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    code = ("import sys; sys.modules['shopvitals.llm'] = None; sys.modules['corpus_pipeline'] = None; import __spark_entry__ as e; "
            "assert len(e.queries()) > 90 and not any(q.startswith('op') for q in e.queries()); e.oracle_sql()")
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True)
