import random

import pytest

from tillmark.functions import matches
from tillmark.operators import trigrams
from tillmark.session import new_dir

WORDS = ["Ann", "ann", "an", "N%A", "a_b", "Über", "über", "ΟΔΟΣ", "x" * 300, "日本語テキスト", "🙂ab🙂", "", " ", "\n\t", "İstanbul", "abc", "bcd", "a\\b"]


@pytest.fixture(scope="module")
def texts(spark):
    r = random.Random(3)
    rows = [(i, r.choice(["", " "]).join(r.choices(WORDS, k=r.randrange(1, 5)))) for i in range(300)]
    rows += [(900, None), (901, "ab"), (902, "abc"), (902, "bcd"), (None, "abc")]
    df = spark.createDataFrame(rows, "id long, name string")
    path = new_dir(spark, "postings")
    trigrams.write_postings(trigrams.postings(df.where("id % 2 = 0 OR id IS NULL"), "id", "name"), path)
    trigrams.write_postings(trigrams.postings(df.where("id % 2 = 1"), "id", "name"), path, "append")
    return df, path


def ids(df):
    return sorted((r.id for r in df.collect()), key=str)


NEEDLES = ["ann", "ANNa", "nan", "n%a", "a_b", "%%%", "___", "an%ab", "über", "ÜBERann", "οδος", "本語テ", "🙂ab", "ab🙂",
           "ab", "x", "", "  ", "i̇st", "abc", "bcd", "abcbcd", "zzz", "xxxx", " ann ", "n a"]


@pytest.mark.parametrize("literal", [False, True])
@pytest.mark.parametrize("needle", NEEDLES)
def test_search_is_the_scan(spark, texts, needle, literal):
    df, path = texts
    named = df.where("id IS NOT NULL")
    got = trigrams.find(named, "id", "name", spark.read.parquet(path), needle, literal)
    test = matches("name", needle, literal)
    assert ids(got) == ids(named if test is None else named.where(test))


def test_long_needles_read_few_postings(spark, texts):
    df, path = texts
    found = trigrams.find(df, "id", "name", spark.read.parquet(path), "Über%ann")
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "In(trigram" in text and "LeftSemi" in text
    short = trigrams.find(df, "id", "name", spark.read.parquet(path), "a%b")
    assert "LeftSemi" not in short._jdf.queryExecution().executedPlan().toString()
    # Stale postings change nothing.
    gone = df.where("id > 200")
    assert ids(trigrams.find(gone, "id", "name", spark.read.parquet(path), "ann")) == ids(gone.where("lower(name) like '%ann%'"))
