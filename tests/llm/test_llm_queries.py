"""The registered queries beside their SQL, and the pipeline beside plain Python."""

import pytest
from test_operators import brute_components

import __spark_entry__ as driver
import corpus_pipeline
from checks.compare import canonical, oracle_connection, rows_of
from tillmark.llm import line_dedup
from tillmark.llm.queries import ORACLE, QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def oracle():
    return oracle_connection(SMALL)


def test_all_registered():
    assert set(QUERIES) < set(driver.queries()) and "pipeline" in driver.queries()
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 14))
    assert set(ORACLE) == {
        "op3_hierarchical_mix", "op5_revisit_resolution", "op6_stream_dedup", "op9_projection_forest",
        "op11_merkle_manifest", "op12_line_frequency", "op13_prefix_trie",
    }


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_agrees_with_its_sql(spark, oracle, name):
    df = QUERIES[name](spark, SMALL)
    found = oracle.execute(ORACLE[name])
    columns = [c[0] for c in found.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows_of(df.columns, df.collect()) == rows_of(columns, found.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_query_has_a_row_per_document(spark, name):
    df = QUERIES[name](spark, SMALL)
    want = spark.read.parquet(f"{SMALL}/documents.parquet")
    assert sorted(r[0] for r in df.select("doc_id").collect()) == sorted(r[0] for r in want.select("doc_id").collect())


def test_native_plans(spark):
    for name in ("op3_hierarchical_mix", "op6_stream_dedup", "op12_line_frequency"):
        plan = QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    kept = docs
    tables = {"documents": docs}
    from tillmark.session import new_dir

    for name, stage in corpus_pipeline.STAGES:
        path = new_dir(spark, "stage")
        stage(spark, kept, SMALL).write.parquet(path)
        kept = spark.read.parquet(path)
        tables[name] = kept
        if name != "sentencepiece":
            assert kept.columns == docs.columns
    rows = {n: {r["doc_id"]: r for r in t.collect()} for n, t in tables.items()}
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    clean = [i for i in rows["documents"] if labels.get(i) == 0]
    assert sum(i in rows["toxicity"] for i in clean) >= 0.95 * len(clean)
    seen, want = set(), {}
    for i in sorted(rows["toxicity"]):
        lines, gone = rows["toxicity"][i]["text"].split("\n"), set()
        for first, n, body in line_dedup.passages(rows["toxicity"][i]["text"]):
            if body in seen:
                gone |= set(range(first, first + n))
            seen.add(body)
        text = "\n".join(x for j, x in enumerate(lines) if j not in gone)
        if text.strip() or not gone:
            want[i] = text
    assert {i: r["text"] for i, r in rows["line_dedup"].items()} == want
    components = brute_components(sorted(want.items()))
    assert set(rows["ngram_join"]) == {i for i, _, c in components if i == c}
    assert set(rows["mixing"]) <= set(rows["ngram_join"])
    words = lambda t: sum(len(r["text"].split()) for r in rows[t].values())
    assert words("mixing") >= 0.95 * words("ngram_join") - 1
    assert set(rows["sentencepiece"]) == set(rows["mixing"])
    assert all(r["round_trip"] and canonical(r["n_pieces"]) > 0 for r in rows["sentencepiece"].values())
    whole = corpus_pipeline.run(spark, SMALL)
    assert {r["doc_id"]: r["ids_crc32"] for r in whole.collect()} == {i: r["ids_crc32"] for i, r in rows["sentencepiece"].items()}
