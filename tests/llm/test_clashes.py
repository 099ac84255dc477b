"""Tables whose columns are called like working columns of the operators."""

import pytest
from pyspark.sql import functions as F
from test_operators import document_rows

import corpus_pipeline
from tillmark.llm import line_dedup, mixing, ngram_join
from tillmark.llm.exact_dedup import stream_dedup
from tillmark.llm.names import free
from tillmark.llm.queries import mix_keys, prepare
from tillmark.session import new_dir

CLASHES = [
    "_line_key", "_line_removed", "_line_count", "_LINE_stays", "_metadata", "_toxicity", "_join_row", "_mix_lang", "_mix_tokens",
    "_mix_epoch", "row", "node", "label", "digest", "body", "aside_0", "score", "id",
]


@pytest.fixture(scope="module")
def tables(spark):
    """Documents with a value of its own in every clashing column, and without these columns."""
    prepare(spark)
    rows = [r for r in document_rows() if r[0] is not None]
    plain = spark.createDataFrame([r[:5] for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    wide = plain.withColumns({c: F.concat(F.lit(c + " "), F.col("doc_id").cast("string")) for c in CLASHES})
    out = []
    for df in (plain, wide):
        path = new_dir(spark, "clashes")
        df.repartition(3, "doc_id").write.parquet(path)
        out.append((path, spark.read.parquet(path)))
    return out


def same(plain, wide, docs):
    """Equal rows, and every clashing column as it was."""
    assert wide.columns[: len(docs.columns)] == docs.columns
    names = [c for c in plain.columns if c in wide.columns]
    key = lambda r: str(tuple(r))
    assert sorted(plain.select(names).collect(), key=key) == sorted(wide.select(names).collect(), key=key)
    for c in CLASHES:
        assert wide.where(F.col(f"`{c}`") != F.concat(F.lit(c + " "), F.col("doc_id").cast("string"))).count() == 0


def test_free_names():
    assert free("a", ["b"]) == "a" and free("a", ["A", "a_"]) == "a__"


def test_line_dedup(tables):
    (_, plain), (_, wide) = tables
    got = line_dedup.remove_repeats(wide)
    same(line_dedup.remove_repeats(plain).drop("_line_count", "_line_removed"), got, wide)
    assert got.columns[-2:] == list(line_dedup.added_names(wide)) == ["_line_count_", "_line_removed_"]


def test_mixing(tables):
    (_, plain), (_, wide) = tables
    made = [mixing.mix(d, mix_keys(), {("core",): 2}, F.expr("total div 2"), 2, 5) for d in (plain, wide)]
    added = ["_mix_epoch", "_mix_tokens", "_mix_take"]
    same(made[0].drop(*added), made[1], wide)
    key = lambda r: str(tuple(r))
    renamed = made[1].select("doc_id", F.col("_mix_epoch_").alias("_mix_epoch"), F.col("_mix_tokens_").alias("_mix_tokens"), "_mix_take")
    assert sorted(made[0].select("doc_id", *added).collect(), key=key) == sorted(renamed.collect(), key=key)


def test_join_and_stream(spark, tables):
    (first, plain), (second, wide) = tables
    same(ngram_join.one_of_each(plain), ngram_join.one_of_each(wide), wide)
    key = lambda r: str(tuple(r))
    got = [sorted(stream_dedup(spark, p).collect(), key=key) for p in (first, second)]
    assert got[0] == got[1]


def test_stages_keep_such_columns(spark, tables):
    (_, _), (_, wide) = tables
    wide.sparkSession  # the stages read labels from the test directory
    for name, stage in corpus_pipeline.STAGES[:4]:
        assert stage(spark, wide, "/root/testdata/sf0.001").columns == wide.columns, name
