"""Every operator on odd rows, against plain Python."""

import base64
import gzip
import hashlib
import heapq
import itertools
import random
import tracemalloc
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tillmark.llm import (
    bitmaps,
    caches,
    components,
    exact_dedup,
    line_dedup,
    mixing,
    neighbours,
    ngram_join,
    pieces,
    quality,
    token_counts,
    toxicity,
    warc,
)
from tillmark.llm import words as kernels
from tillmark.llm.caches import Memo
from tillmark.llm.queries import QUERIES, prepare
from tillmark.session import dirs_made, new_dir, shared_dir

WORDS = ["the", "on", "tion", "er", "hea", "ing", "wh", "ré", "ße", "ñe", "and", "of"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id string, score double"


def words(r: random.Random, n: int) -> str:
    return " ".join("".join(r.choices(WORDS, k=r.randrange(1, 4))) for _ in range(n))


def document_rows(seed: int = 1, n: int = 40) -> list[tuple]:
    """Prose with exact and near copies, shared passages, and every odd case."""
    r = random.Random(seed)
    shared = "\n".join(words(r, 14) for _ in range(6))
    long_line = words(r, 60)
    texts = ["\n".join(words(r, r.randrange(3, 15)) for _ in range(r.randrange(1, 9))) for _ in range(n)]
    texts += [texts[0], texts[0], texts[1] + " x", texts[1] + "\nTail here.", texts[2].upper()]
    texts += [f"{words(r, 9)}\n{shared}\n{words(r, 9)}" for _ in range(4)]
    texts += [f"{long_line}\n{words(r, 9)}", f"{words(r, 5)}\n{long_line}"]
    base = words(r, 120).split(" ")
    for i in range(8):  # copies with one word changed
        copy = list(base)
        copy[10 * i] = "changed"
        texts.append(" ".join(copy))
    texts += ["", "", None, None, "   \n\t\n", "one", "one two three", "One two three", "🙂 日本 é", "▁ mark"]
    texts += [words(r, 4000), "=" * 3000, "a\n" * 200]
    rows = [(i, t, r.choice(["en", "de", None]), f"src{i % 3 if i % 2 else 0}", len(t or ""), f"x{i}", 0.5)
            for i, t in enumerate(texts)]
    rows += [(3, texts[3], "en", "src0", 1, "again", 0.1)] * 2  # repeated rows
    rows += [(3, "same id, another text", "en", None, 1, "other", 0.1)]
    rows += [(None, texts[4], None, None, None, None, None), (None, None, None, None, None, None, None)]
    return rows


@pytest.fixture(scope="session")
def documents(spark):
    """Odd rows as a table of several files, with extra columns named like working ones."""
    prepare(spark)
    path = new_dir(spark, "documents")
    spark.createDataFrame(document_rows(), SCHEMA).repartition(3, "id").write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def nothing(spark, documents):
    path = new_dir(spark, "nothing")
    documents.where("false").write.parquet(path)
    return spark.read.schema(documents.schema).parquet(path)


def rows_of(df):
    return [r.asDict() for r in df.collect()]


# -- helpers ---------------------------------------------------------------------------------


def test_word_hashes():
    texts = ["", None, "a", "A  a\tB", "x" * 70000 + " y " + "z" * 140000, "é 日本\x0bq"]
    hashes, offsets = kernels.batch_words(texts)
    by_word = {}
    for i, t in enumerate(texts):
        ws = (t or "").encode().lower().split()
        got = hashes[offsets[i] : offsets[i + 1]].tolist()
        assert len(ws) == len(got)
        for w, h in zip(ws, got):
            assert by_word.setdefault(w, h) == h
    assert len(set(by_word.values())) == len(by_word)


def test_memo_is_bounded():
    memo = Memo(lambda k: k * 2, size=10)
    for i in itertools.chain(range(100), range(100)):
        assert memo[str(i)] == str(i) * 2
        assert len(memo) <= 10 and len(memo.old) <= 10


def test_bitmap(spark):
    hashes = np.random.default_rng(1).integers(-(2**63), 2**63 - 1, 500)
    words = bitmaps.bitmap(spark.createDataFrame([(int(h),) for h in hashes], "h long"), "h", bits=16)
    assert bitmaps.held(words, hashes).all()
    assert bitmaps.held(words, hashes + 12345).mean() < 0.1


def test_components(spark):
    r = random.Random(2)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1050)]
    parent = {}

    def find(a):
        parent.setdefault(a, a)
        while parent[a] != a:
            a = parent[a]
        return a

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    got = components.components(spark.createDataFrame(edges, "u long, v long"))
    got = {r["node"]: r["label"] for r in got.collect()}
    assert got == {n: find(n) for e in edges if e[0] != e[1] for n in e}
    assert components.components(spark.createDataFrame([], "u long, v long")).count() == 0


# -- 1: line dedup ---------------------------------------------------------------------------


def expected_lines(rows):
    seen, keyed = set(), {}
    order = sorted(
        {(i, t) for i, t in rows if t is not None},
        key=lambda x: (x[0] is not None, x[0] or 0,
                       hashlib.md5(f"{'' if x[0] is None else x[0]}|{str(x[0] is None).lower()}|{x[1]}".encode()).hexdigest()),
    )
    for i, t in order:
        lines, gone = t.split("\n"), set()
        for first, n, body in line_dedup.passages(t):
            if body in seen:
                gone |= set(range(first, first + n))
            seen.add(body)
        keyed[i, t] = "\n".join(x for j, x in enumerate(lines) if j not in gone)
    return Counter((i, None if t is None else keyed[i, t]) for i, t in rows)


def test_line_dedup(documents, nothing):
    out = line_dedup.remove_repeats(documents)
    assert out.columns == documents.columns + ["_line_count", "_line_removed"]
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    got = Counter((r["doc_id"], r["text"]) for r in out.collect())
    assert got == expected_lines(rows)
    assert got != Counter(rows)
    assert line_dedup.remove_repeats(nothing).count() == 0


def test_chunks_fall_into_place_again():
    r = random.Random(3)
    lines = [f"line {r.random()}" for _ in range(400)]
    a = {tuple(lines[f : f + n]) for f, n in line_dedup.chunks(lines)}
    shifted = ["new"] + lines[:200] + ["put in"] + lines[200:]
    b = {tuple(shifted[f : f + n]) for f, n in line_dedup.chunks(shifted)}
    assert len(a & b) > 0.9 * len(a)
    covered = [i for f, n in line_dedup.chunks(lines) for i in range(f, f + n)]
    assert covered == list(range(400))
    assert max(n for _, n in line_dedup.chunks(["same"] * 500)) <= line_dedup.MOST


def test_long_passage_is_removed_once(spark):
    passage = " ".join(f"w{i}" for i in range(60))
    df = spark.createDataFrame([(i, f"own {i}\n{passage}\nend {i}") for i in range(5)], "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in line_dedup.remove_repeats(df).collect()}
    assert passage in got[0]
    assert all(got[i] == f"own {i}\nend {i}" for i in range(1, 5))


def repeated_lines(texts):
    """Lines of each text that lie in a run of 50 words or more found in an earlier text, by all runs of lines."""
    seen, out = set(), []
    for t in texts:
        lines, gone, own = t.split("\n"), set(), []
        for i in range(len(lines)):
            n = 0
            for j in range(i, len(lines)):
                n += len(lines[j].split())
                if n >= 50:
                    run = "\n".join(lines[i : j + 1])
                    own.append(run)
                    if run in seen:
                        gone |= set(range(i, j + 1))
        seen.update(own)
        out.append(gone)
    return out


def test_planted_passages_go_whole(spark):
    r = random.Random(8)
    texts, planted = [], []
    for n, per in [(4, 15), (6, 12), (10, 12), (20, 12), (2, 25), (3, 40), (50, 1)] * 4:
        passage = ["" if per < 40 and i == 2 else words(r, per) for i in range(n + (per < 40 and n > 2))]
        for _ in range(3):
            before = [words(r, r.randrange(3, 30)) for _ in range(r.randrange(4))]
            planted.append((len(texts), set(range(len(before), len(before) + len(passage)))))
            texts.append("\n".join(before + passage + [words(r, r.randrange(3, 30)) for _ in range(r.randrange(4))]))
    want = repeated_lines(texts)
    assert all(lines <= want[i] for i, lines in planted if i % 3)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r for r in line_dedup.remove_repeats(df).collect()}
    for i, t in enumerate(texts):
        runs = [(x["first"], x["lines"]) for x in got[i]["_line_removed"] or []]
        gone = [j for f, n in runs for j in range(f, f + n)]
        assert len(gone) == len(set(gone)) and set(gone) >= want[i]
        assert got[i]["text"] == "\n".join(x for j, x in enumerate(t.split("\n")) if j not in set(gone))


def test_lines_said_again_and_again_stay_once(spark):
    df = spark.createDataFrame([(1, "a b\n" * 300), (2, "a b\n" * 40), (3, "x\n" + "a b\n" * 77 + "y")], "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in line_dedup.remove_repeats(df).collect()}
    assert 25 <= got[1].count("a b") <= 32 and got[2].strip() == "" and got[3].split() == ["x", "y"]


def test_equal_digests_are_told_apart(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "digest", lambda line: bytes([len(line) % 7]) * 16)
    texts = [t for _, t, *_ in document_rows(5, 12) if t]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in line_dedup.remove_repeats(df).collect()}
    assert Counter(got.items()) == expected_lines(list(enumerate(texts)))


def test_later_copies_vanish(spark):
    r = random.Random(9)
    texts = ["\n".join(words(r, r.randrange(1, 30)) for _ in range(r.randrange(1, 12))) for _ in range(40)]
    texts += ["short", "two\n\nlines\n", "\n\n" + words(r, 70) + "\n \n" + words(r, 80) + "\n\n"]
    df = spark.createDataFrame(list(enumerate(texts * 3)), "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in line_dedup.remove_repeats(df).collect()}
    assert all(got[i] == (t if i < len(texts) else "") for i, t in enumerate(texts * 3))


# -- 2: segmentation -------------------------------------------------------------------------

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.Pieces(Path(MODEL).read_bytes(), 4)


def all_paths(v, text):
    text = v.normal(text)
    edges, out = v._edges(text), []

    def go(at, path, score):
        if not at:
            out.append((score, tuple(v._spell(path[::-1]))))
        for length, weight, label in edges[at] if at else []:
            go(at - length, (*path, label), score + weight)

    go(len(text), (), 0.0)
    return sorted(out, key=lambda x: -x[0])


def test_nbest_against_all_paths(vocabulary):
    r = random.Random(4)
    for _ in range(150):
        text = "".join(r.choice(["the", "on", " ", ", ", "é", "日", "🙂", "a", "ti", "\n"]) for _ in range(r.randrange(7)))
        got, want = vocabulary.encode(text), all_paths(vocabulary, text)
        assert [g[0] for g in got] == [w[0] for w in want[:4]]
        known = {w[1]: w[0] for w in want}
        for score, ids in got:
            path = tuple(np.frombuffer(ids, vocabulary.width).tolist())
            assert known[path] == score
            assert vocabulary.decode(ids) == text
        assert len({g[1] for g in got}) == len(got)


def test_encode_table(documents, nothing, vocabulary):
    got = rows_of(pieces.encode_nbest(documents, MODEL, n=4, ids_of=4))
    assert len(got) == documents.count()
    texts = defaultdict(list)
    for r in documents.collect():
        texts[r["doc_id"]].append(r["text"] or "")
    for r in got:
        decoded = [vocabulary.decode(i) for i in r["ids"]]
        assert any(t.replace("▁", " ") in (decoded[0],) for t in texts[r["id"]]) or decoded[0] in ("", *texts[r["id"]])
        assert len(set(decoded)) == 1 and r["pieces"][0] == r["n_pieces"] == len(r["ids"][0]) // 2
        assert r["scores"] == sorted(r["scores"], reverse=True)
    assert sum(not r["round_trip"] for r in got) == sum("▁" in (t or "") for ts in texts.values() for t in ts)
    assert pieces.encode_nbest(nothing, MODEL).count() == 0


def test_nbest_decoded_for_real():
    """Ids that give back something else are noticed, also in a segmentation after the best."""
    text = "the ocean and the ring"
    v = pieces.Pieces(Path(MODEL).read_bytes(), 4)
    [(paths, given)] = v.encode_all([text])
    assert given and [v.decode(i) for _, i in paths] == [text] * 4
    ids = [set(np.frombuffer(i, v.width).tolist()) for _, i in paths]
    for wrong in (min(ids[0]), min(ids[3] - ids[0])):
        v = pieces.Pieces(Path(MODEL).read_bytes(), 4)
        v.back = v.back.copy()
        v.back[v.back_first[wrong]] ^= 1
        assert v.encode_all([text, "", "xyz"])[:2] == [(paths, False), ([(0, b"")], True)]


def test_nbest_of_a_full_batch_in_little_memory():
    """What a task holds beside the vocabulary: under 50 MB for a batch of a million characters and more."""
    r = random.Random(3)
    known = ["".join(r.choices("abcdefghijklmnoprstuvw", k=r.randrange(2, 10))) for _ in range(60_000)]
    texts = [" ".join(r.choices(known, k=250)) for _ in range(1000)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(1000), pa.int64()), pa.array(texts)], names=["id", "text"])
    v = pieces.Pieces(Path(MODEL).read_bytes(), 4)
    tracemalloc.start()
    got = [(b.num_rows, sum(b.column("round_trip").to_pylist())) for b in pieces.encoded(v, iter([batch]), 1)]
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [sum(c) for c in zip(*got)] == [1000, 1000]
    assert most < 50e6


def test_nbest_parts_worked_out_once_in_bounded_passes():
    """Each distinct part of a batch of nearly a million characters once, and no pass takes many; with the
    results of every text alone."""
    r = random.Random(9)
    known = ["".join(r.choices("abcdefghijklmnoprstuvw", k=r.randrange(2, 10))) for _ in range(40_000)]
    texts = [" ".join(r.choices(known, k=140)) for _ in range(1000)] + ["", "🙂 é " + "long" * 30, None]
    v = pieces.Pieces(Path(MODEL).read_bytes(), 4)
    passes, work_out = [], v.work_out
    v.work_out = lambda parts: passes.append(list(parts)) or work_out(parts)
    batch = pa.RecordBatch.from_arrays([pa.array(range(1003), pa.int64()), pa.array(texts)], names=["id", "text"])
    got = pa.Table.from_batches(list(pieces.encoded(v, iter([batch]), 4))).to_pylist()
    distinct = {p for t in texts for p in v.part.findall(v.normal(t or ""))}
    assert sorted(p for parts in passes for p in parts) == sorted(distinct)
    assert max(map(len, passes)) <= 1 << 15 < len(distinct)
    for row, text in list(zip(got, texts))[::50] + list(zip(got, texts))[-3:]:
        assert list(zip(row["scores"], row["ids"])) == v.encode(text or "")


def test_driver_hands_back_what_its_jvm_freed(spark):
    """Memory of the C library that is free, but lies below some in use: 100 MB and more."""
    jvm = spark.sparkContext._jvm
    pid = jvm.java.lang.ProcessHandle.current().pid()
    made = [jvm.java.util.zip.Deflater() for _ in range(600)]  # about 0.26 MB each
    for d in made:
        d.setInput(bytearray(b"text"))
        d.finish()
    for d in made[:-1]:
        d.end()
    jvm.System.gc()
    held = [int(Path(f"/proc/{pid}/statm").read_text().split()[1]) * 4096]
    caches.tidy(spark)
    held.append(int(Path(f"/proc/{pid}/statm").read_text().split()[1]) * 4096)
    made[-1].end()
    assert held[0] - held[1] > 30e6


def test_components_tidy_every_round(spark, monkeypatch):
    """The driver's memory is handed back while the components are made, not only when they are."""
    done = []
    monkeypatch.setattr(components, "tidy", lambda s: done.append(len(dirs_made())))
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)], "u long, v long")
    got = {(r["node"], r["label"]) for r in components.components(edges).collect()}
    assert got == {(i, 0) for i in range(41)}
    assert len(done) > 2 and all(b - a == 1 for a, b in zip(done, done[1:]))


def test_nbest_query_gives_every_segmentation(spark, vocabulary, tmp_path):
    texts = ["the ocean and the ring", "", None, "🙂 日本 é\n\n x", "a", "▁ mark", "the " * 3000]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "the"), (0, texts[0])]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = rows_of(QUERIES["op2_sentencepiece_nbest"](spark, str(tmp_path)))
    want = []
    for i, t in rows:
        paths = vocabulary.encode(t or "")
        sums = [zlib.crc32(ids) for _, ids in paths]
        want.append((i, [s for s, _ in paths], sums, sums[0], t != "▁ mark"))
    seen = [(r["doc_id"], r["scores"], r["nbest_crc32"], r["ids_crc32"], r["round_trip"]) for r in got]
    assert sorted(seen, key=str) == sorted(want, key=str)


# -- 3: mixing -------------------------------------------------------------------------------


def plain_share(total, nodes):
    """Budgets of siblings by rounds: fill whoever is short, share the rest."""
    out, open_ = {}, dict(nodes)
    rest = total
    while open_:
        weight = sum(w for w, _ in open_.values())
        short = {k for k, (w, c) in open_.items() if w == 0 or c * weight <= rest * w}
        if not short:
            upto = 0
            for k in sorted(open_):
                w = open_[k][0]
                out[k] = rest * (upto + w) // weight - rest * upto // weight
                upto += w
            break
        k = min(short, key=lambda k: (open_[k][1] / open_[k][0] if open_[k][0] else 0, k))
        out[k] = open_[k][1] if open_[k][0] else 0
        rest -= out[k]
        del open_[k]
    return out


def test_mixing_against_plain_python(documents):
    weights = {("src0",): 1, ("b",): 2, ("a", "en"): 3}
    keys = {"half": F.when(F.col("doc_id") % 2 == 0, "a").otherwise("b"), "lang": F.col("lang")}
    rows = documents.collect()
    leaf = lambda r: ("b" if r["doc_id"] is None or r["doc_id"] % 2 else "a", r["lang"] or mixing.NONE)
    n = lambda t: len((t or "").encode().split())
    available = Counter()
    for r in rows:
        available[leaf(r)] += n(r["text"])
    for share, epochs in ((0.1, 1), (0.5, 2), (0.9, 3), (3.0, 2), (0.0, 1)):
        budget = min(int(sum(available.values()) * share), sum(available.values()) * epochs)
        halves = defaultdict(int)
        for k, c in available.items():
            halves[k[0]] += c * epochs
        top = plain_share(budget, {h: (weights.get((h,), 1), c) for h, c in halves.items()})
        want = {}
        for h in halves:
            low = plain_share(top[h], {k: (weights.get(k, 1), c * epochs) for k, c in available.items() if k[0] == h})
            want.update(low)
        got = Counter()
        df = mixing.mix(documents, keys, weights, F.lit(budget), epochs, seed=9)
        assert df.columns == documents.columns + ["_mix_epoch", "_mix_tokens", "_mix_take"]
        taken = df.collect()
        for r in taken:
            got[leaf(r)] += r["_mix_take"]
            assert r["_mix_take"] <= r["_mix_tokens"] == n(r["text"])
        assert +got == +Counter(want)
        whole = Counter((r["_mix_epoch"], leaf(r)) for r in taken)
        for (epoch, k), c in whole.items():
            if (epoch + 1, k) in whole:
                assert c == sum(leaf(r) == k for r in rows)


def test_mixing_order_and_empty(documents, nothing):
    keys = {"lang": F.col("lang")}
    args = (keys, {}, F.expr("total div 3"), 1)
    a = sorted(map(str, mixing.mix(documents, *args, seed=1).collect()))
    assert a == sorted(map(str, mixing.mix(documents.repartition(7), *args, seed=1).collect()))
    assert a != sorted(map(str, mixing.mix(documents, *args, seed=2).collect()))
    assert mixing.mix(nothing, *args).count() == 0
    assert mixing.mix(documents, keys, {("en",): 0, ("de",): 0, (mixing.NONE,): 0}, F.lit(99)).count() == 0


# -- 4: token counts -------------------------------------------------------------------------

BPE = public_tokenizers.path("byte_bpe_50k.json")


def test_every_prefix():
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(BPE)
    counter = token_counts.PrefixCounter(Path(BPE).read_text())
    count = lambda s: len(library.encode(s, add_special_tokens=False).ids)
    r = random.Random(5)
    parts = [*"ab e'rs tl\n\t.,1  é日<|>\x85　\x1c", "<|endoftext|>", "'ll", "the ", "=="]
    texts = ["", "don't we'll  \n\n  they've", "x <|endof", "<|endoftext|><|endoftext|", "  \n a\t\tb  "]
    texts += ["".join(r.choices(parts, k=r.randrange(1, 25))) for _ in range(250)]
    for text in texts:
        steps = counter.steps(text)
        want = [count(text[:i]) for i in range(len(text) + 1)]
        assert [token_counts.count_at(steps, i) for i in range(len(text) + 1)] == want, text
        for limit in (0, 1, 3):
            assert token_counts.longest_within(steps, limit) == max(i for i, c in enumerate(want) if c <= limit)


def test_count_table(documents, nothing):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(BPE)
    want = Counter(
        (r["doc_id"], len((r["text"] or "").encode()),
         len(library.encode(r["text"] or "", add_special_tokens=False).ids))
        for r in documents.collect()
    )
    out = token_counts.token_prefixes(documents, BPE, limit=10)
    got = rows_of(out)
    assert Counter((r["id"], r["n_bytes"], r["n_tokens"]) for r in got) == want
    for r in got:
        assert r["cut_chars"] == token_counts.longest_within(r["steps"], 10)
    assert token_counts.token_prefixes(nothing, BPE).count() == 0


# -- 5: WARC ---------------------------------------------------------------------------------


def page_rows():
    big = "long " * 50000
    return [
        (5, "http://a/1", "same", "z"), (2, "http://a/2", "same", "z"), (9, "http://a/3", "same", "z"),
        (1, None, None, None), (3, "http://a/4 b\n", "", "q"), (4, "http://ä/5", "é\r\n\r\nWARC/1.1\r\n", "q"),
        (7, "http://a/6", big, "q"), (8, "http://a/7", big, "q"), (8, "http://a/7", big, "q"),
        (None, "http://a/8", "same", "q"), (None, "http://a/9", "lonely", "q"),
    ]


def test_warc(spark):
    pages = spark.createDataFrame(page_rows(), "page_id long, url string, html string, kind string").repartition(3)
    folder = new_dir(spark, "warc")
    got = rows_of(warc.deduplicate(pages, folder))
    want = []
    groups = defaultdict(list)
    for i, _, h, _ in page_rows():
        groups[h or ""].append(i)
    for payload, ids in groups.items():
        data = payload.encode()
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        ids = sorted(ids, key=lambda i: (i is None, i))
        for k, i in enumerate(ids):
            want.append((i, len(data), digest, "revisit" if k else "response", ids[0] if k else None))
    assert Counter((r["id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got) == Counter(want)
    # The archives themselves: whole records, payloads of responses byte for byte.
    found = {}
    for path in Path(folder, "deduplicated").rglob("*.gz"):
        for fields, block in warc.parse(gzip.decompress(path.read_bytes())):
            found[warc.bare_id(fields["WARC-Record-ID"])] = fields, block
    assert len(found) == len(want)
    kept = [b[len(warc.HTTP):].decode() for f, b in found.values() if f["WARC-Type"] == "response"]
    assert sorted(kept) == sorted(groups)
    for fields, block in found.values():
        if fields["WARC-Type"] == "revisit":
            to = found[warc.bare_id(fields["WARC-Refers-To"])][0]
            assert to["WARC-Payload-Digest"] == fields["WARC-Payload-Digest"] and block == warc.HTTP


def test_warc_bounds(spark):
    schema = "page_id long, url string, html string"
    pages = spark.createDataFrame([r[:3] for r in page_rows()], schema)
    kinds = Counter(r["record_type"] for r in warc.deduplicate(pages, least_bytes=100).collect())
    assert kinds == {"response": 9, "revisit": 2}
    assert warc.deduplicate(spark.createDataFrame([], schema)).count() == 0


# -- 6: exact dedup --------------------------------------------------------------------------


def expected_copies(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    out = Counter()
    for t, ids in groups.items():
        top = max(ids, key=lambda i: (i is not None, i))
        for k, i in enumerate(sorted(ids, key=lambda i: (i is None, -(i or 0)))):
            out[i, top, len(ids), k == 0] += 1
    return out


@pytest.mark.parametrize("digest", [exact_dedup.sha256, lambda c: F.length(c).cast("string")])
def test_exact_dedup(spark, documents, digest):
    path = documents.inputFiles()[0].rsplit("/", 1)[0]
    got = exact_dedup.stream_dedup(spark, path, digest=digest)
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    assert Counter((r["id"], r["keep_id"], r["group_size"], r["kept"]) for r in got.collect()) == expected_copies(rows)


def test_state_goes_on_with_new_files(spark):
    path, state = new_dir(spark, "growing"), new_dir(spark, "state")
    schema = "doc_id long, text string"
    rows = [(1, "a"), (2, "b"), (3, "a")]
    spark.createDataFrame(rows, schema).write.parquet(path)
    exact_dedup.stream_dedup(spark, path, state=state)
    more = [(9, "b"), (4, "c")]
    spark.createDataFrame(more, schema).write.mode("append").parquet(path)
    got = exact_dedup.stream_dedup(spark, path, state=state)
    assert Counter((r["id"], r["keep_id"], r["group_size"], r["kept"]) for r in got.collect()) == expected_copies(rows + more)
    assert exact_dedup.state_table(spark, state).count() == 3


def test_exact_dedup_of_nothing(spark, nothing):
    path = nothing.inputFiles()[0].rsplit("/", 1)[0]
    assert exact_dedup.stream_dedup(spark, path).count() == 0


# -- 7: quality ------------------------------------------------------------------------------


def test_estimate_finds_accuracies():
    rng = np.random.default_rng(6)
    good = rng.random(20000) < 0.8
    kind = rng.integers(0, 4, 20000)
    votes = np.ones((20000, 4), np.int8)
    for k in range(4):
        hit = (~good & (kind == k) & (rng.random(20000) < 0.95)) | (rng.random(20000) < 0.01)
        votes[hit, k] = 0
    votes[rng.random(votes.shape) < 0.1] = -1
    patterns, at, counts = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    posterior, p = quality.estimate(patterns, counts.astype(float))
    assert ((posterior[at.ravel()] >= 0.5) == good).mean() > 0.93
    assert p[0, :, 0].max() < 0.05


def test_quality_table(spark, documents, nothing):
    fitted = quality.train(documents)
    out = documents.select("doc_id", "text", quality.scorer(spark, fitted)("text").alias("s")).collect()
    assert len(out) == documents.count()
    for r in out:
        assert 0 <= r["s"] <= 1
        if not (r["text"] or "").split():
            assert r["s"] == 0
    assert quality.train(nothing).score(["a b"]) == [0.5]
    assert quality.Scorer({}).score([]).tolist() == []


def test_quality_of_labelled_rows(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    score = quality.scorer(spark, quality.train(docs))
    found = docs.select("doc_id", score("text").alias("s")).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    rows = found.collect()
    good = [r["s"] >= 0.5 for r in rows if r["quality"] == 1]
    junk = [r["s"] < 0.5 for r in rows if r["quality"] == 0]
    assert np.mean(good) > 0.98 and np.mean(junk) > 0.75


# -- 8: Jaccard join -------------------------------------------------------------------------


def brute_components(rows):
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        sets.append(frozenset(tuple(w[j : j + 5]) for j in range(len(w) - 4)) or frozenset([tuple(w)] if w else []))
    label = list(range(len(rows)))
    for i, j in itertools.combinations(range(len(rows)), 2):
        a, b = sets[i], sets[j]
        if a and b and 100 * len(a & b) >= 80 * len(a | b) and label[i] != label[j]:
            old, new = label[j], label[i]
            label = [new if x == old else x for x in label]
    least = {}
    for (i, _), x in zip(rows, label):
        if i is not None:
            least[x] = min(least.get(x, i), i)
    return Counter((i, len(s), least.get(x)) for (i, _), s, x in zip(rows, sets, label))


def near_rows(seed=8):
    """Families of edits at all distances around the threshold."""
    r = random.Random(seed)
    rows = []
    for f in range(6):
        base = [f"w{r.randrange(500)}" for _ in range(r.choice([6, 25, 60, 150]))]
        for _ in range(14):
            copy = list(base)
            for _ in range(r.randrange(0, 1 + len(base) // 14)):
                copy[r.randrange(len(copy))] = f"e{r.randrange(50)}"
            if r.random() < 0.3:
                copy += [f"t{r.randrange(9)}" for _ in range(r.randrange(len(base) // 5 + 1))]
            rows.append((len(rows), " ".join(copy)))
    return rows


@pytest.mark.parametrize("frequent", [2, 8, 10**9])
def test_join_against_all_pairs(spark, documents, monkeypatch, frequent):
    monkeypatch.setattr(ngram_join, "FREQUENT", frequent)
    monkeypatch.setattr(ngram_join, "BLOCK", 4)
    monkeypatch.setattr(ngram_join, "LABELS_MOST", 10 if frequent == 2 else 1000)
    monkeypatch.setattr(ngram_join, "SHARED_BITS", 12 if frequent == 2 else 20)
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()] + [(1000 + i, t) for i, t in near_rows()]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = Counter((r["id"], r["n_shingles"], r["component_id"]) for r in ngram_join.near_duplicates(df).collect())
    assert got == brute_components(rows)


def test_every_member_a_stray(spark, monkeypatch):
    """All sets in one family: nothing may rest on the family being alike."""
    monkeypatch.setattr(ngram_join, "bands_of", lambda s: [7 if s[0] % np.uint64(3) else 8] * 4)
    rows = near_rows(9)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = Counter((r["id"], r["n_shingles"], r["component_id"]) for r in ngram_join.near_duplicates(df).collect())
    assert got == brute_components(rows)


def test_one_of_each(documents, nothing):
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    out = ngram_join.one_of_each(documents)
    assert out.columns == documents.columns
    got = [(r["doc_id"], r["text"]) for r in out.collect()]
    assert len(set(got)) == len(got) and set(got) <= set(rows)
    apart = brute_components([(i, t) for i, (_, t) in enumerate(got)])
    assert all(i == c for i, _, c in apart)
    groups = {c for _, _, c in brute_components([(i, t) for i, (_, t) in enumerate(sorted(set(rows), key=str))])}
    assert len(got) == len(groups)
    blank = {x for x in rows if not (x[1] or "").split()}
    assert blank <= set(got)
    assert ngram_join.near_duplicates(nothing).count() == 0 == ngram_join.one_of_each(nothing).count()


# -- 9: neighbours ---------------------------------------------------------------------------


def exact_nearest(rows, ask, k):
    out = {}
    for q, v in rows:
        if not ask(q):
            continue
        best = {}
        for i, w in rows:
            if i != q:
                s = float(np.dot(np.array(v, float), np.array(w, float)))
                best[i] = max(best.get(i, s), s)
        out[q] = sorted(best.items(), key=lambda x: (-x[1], x[0]))[:k]
    return out


def test_neighbours_odd_rows(spark):
    nan = float("nan")
    good = [(i, [float((i * 7 + j) % 5) - 1.5 for j in range(4)]) for i in range(30)]
    bad = [(100, None), (120, []), (140, [0.0] * 4), (160, [1.0, None, 0.0, 0.0]), (180, [nan, 1.0, 1.0, 1.0]),
           (200, [float("inf"), 1.0, 1.0, 1.0]), (220, [1.0, 2.0]), (None, [1.0] * 4)]
    schema = "vec_id long, embedding array<float>, id string, v double"
    df = spark.createDataFrame([(i, v, "x", 1.0) for i, v in good + bad], schema)
    got = defaultdict(list)
    for r in neighbours.nearest(df, F.col("id") % 20 == 0, k=5).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["id"], r["score"]))
    assert dict(got) == exact_nearest(good, lambda q: q % 20 == 0, 5)
    few = spark.createDataFrame([(i, v) for i, v in good[:3]], "vec_id long, embedding array<double>")
    assert neighbours.nearest(few, F.lit(True), k=5).count() == 6
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert neighbours.nearest(none, F.lit(True)).count() == 0


@pytest.mark.parametrize("copies, sample", [(lambda i: 2, 8192), (lambda i: 1 + 24 * (i == 7), 8192), (lambda i: 1 + 24 * (i < 3), 100)])
def test_neighbours_of_repeated_rows(spark, copies, sample):
    r = random.Random(11)
    rows = [(i, [float(r.randrange(-9, 10)) for _ in range(6)]) for i in range(60)]
    rows[7] = (7, [9.0] * 6)
    rows = [x for x in rows for _ in range(copies(x[0]))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = defaultdict(list)
    found = neighbours.nearest(df, F.col("id") % 6 == 0, k=20, sample=sample)
    for x in found.orderBy("query_id", "rank").collect():
        got[x["query_id"]].append((x["id"], x["score"]))
    assert dict(got) == exact_nearest(rows, lambda q: q % 6 == 0, 20)


@pytest.mark.parametrize("spread", [0.0, 3.0])
def test_neighbours_recall(spark, spread, monkeypatch):
    """With and without clusters, lengths differing; small blocks; a sample far below the table."""
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 300)
    monkeypatch.setattr(neighbours, "LEAST", 100)
    rng = np.random.default_rng(10)
    centres = rng.standard_normal((12, 32)) * spread
    x = centres[rng.integers(0, 12, 3000)] + rng.standard_normal((3000, 32))
    x *= rng.uniform(0.5, 1.5, (3000, 1))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    found = neighbours.nearest(df, F.col("id") % 20 == 0, k=20, sample=400).collect()
    got = defaultdict(set)
    for r in found:
        got[r["query_id"]].add(r["id"])
    assert len(got) == 150 and all(len(v) == 20 for v in got.values())
    recall = []
    for q, ids in got.items():
        score = x @ x[q]
        score[q] = -np.inf
        recall.append(len(ids & set(np.argsort(-score)[:20].tolist())) / 20)
    assert np.mean(recall) >= 0.9


def written(spark):
    """Bytes of the shuffle files and of the shared folder."""
    files = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
    shuffled = {f.getPath(): f.length() for f in map(files.apply, range(files.size()))}
    kept = {str(f): f.stat().st_size for f in Path(shared_dir(spark)).rglob("*") if f.is_file()}
    return {f: n for f, n in (shuffled | kept).items() if not f.endswith(".crc")}


def test_neighbours_disk(spark):
    """Rows are not copied for each tree, block of queries and pair: the disk stays under 4 times the vectors."""
    rng = np.random.default_rng(12)
    x = rng.standard_normal((6000, 64)).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    before = written(spark)
    assert neighbours.nearest(df, F.col("id") % 20 == 0, k=20, sample=400).count() == 300 * 20
    assert sum(n for f, n in written(spark).items() if f not in before) < 4 * x.nbytes


@pytest.mark.parametrize("power", [lambda i: 0, lambda i: i % 41 - 20, lambda i: 505, lambda i: -505])
def test_neighbours_in_parts(spark, power, monkeypatch):
    """Queries in several rounds, rows in several blocks, lengths far apart and beyond single precision."""
    for name, most in (("QUERY_BYTES", 2000), ("BLOCK_ROWS", 37), ("HELD_PRODUCTS", 1024), ("HELD_PAIRS", 50)):
        monkeypatch.setattr(neighbours, name, most)
    r = random.Random(13)
    rows = [(i, [float(r.randrange(-9, 10)) * 2.0 ** power(i) for _ in range(6)]) for i in range(400)]
    rows += [(1000 + i, rows[7][1]) for i in range(60)] + rows[5:25] + [(i, rows[i + 30][1]) for i in range(20)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    asked = {}
    for x in neighbours.nearest(df, F.col("id").isin(7, 45, 1000, 1059), k=20, sample=100).collect():
        asked.setdefault(x["query_id"], []).append((x["rank"], x["id"], x["score"]))
    assert sorted(asked) == [7, 45, 1000, 1059] and len(asked.pop(7)) == 40
    assert {q: [x[1:] for x in sorted(a)] for q, a in asked.items()} == exact_nearest(rows, lambda q: q in (45, 1000, 1059), 20)


def test_neighbours_leaves_by_distance():
    """The leaves that one priority queue over all trees gives, also where distances are equal."""
    rng = np.random.default_rng(14)
    x = np.round(rng.standard_normal((500, 3)))
    x = x[(x != 0).any(axis=1)]
    forest = neighbours.Forest(x, np.sqrt((x * x).sum(axis=1)).max(), 4, 3)
    held = np.bincount(forest.leaves(x).ravel(), minlength=48)
    for enough in (1, 100, 700, 3 * len(x)):
        for q, found in zip(x[:40], forest.walk(x[:40], held, enough)):
            margins = forest.directions @ np.append(q / np.linalg.norm(q), 0.0) - forest.cuts
            queue, met, leaves = [(0.0, t, 0) for t in range(3)], 0, set()
            while queue and met < enough:
                off, t, node = heapq.heappop(queue)
                if node < 15:
                    for child, m in ((1, max(margins[t, node], 0.0)), (2, min(margins[t, node], 0.0))):
                        heapq.heappush(queue, (off + m**2, t, 2 * node + child))
                elif held[node - 15 + 16 * t]:
                    leaves.add(node - 15 + 16 * t)
                    met += held[node - 15 + 16 * t]
            assert leaves == set(np.flatnonzero(found))


# -- 10: toxicity ----------------------------------------------------------------------------


def test_gradient(monkeypatch):
    monkeypatch.setattr(toxicity, "WINDOW", 6)
    monkeypatch.setattr(toxicity, "STRIDE", 3)
    net = toxicity.Network()
    for k in net.p:
        net.p[k] = net.p[k].astype(np.float64)
    w = toxicity.Windows(["a b c d e foo bar baz", "", "x y zed", None, "hello there big world of mine again so"])
    pick = np.arange(len(w.doc))
    y = (pick % 2).astype(np.float64)
    _, g = net.gradient(w, pick, y)
    rng = np.random.default_rng(0)
    for k, v in net.p.items():
        whole = np.zeros_like(v)
        at, value = g[k] if isinstance(g[k], tuple) else (slice(None), g[k])
        whole[at] = value
        spots = np.argwhere(np.abs(whole) > 1e-6)
        for j in rng.choice(len(spots), min(3, len(spots)), replace=False):
            i = tuple(spots[j])
            old, e = v[i], 1e-4
            v[i] = old + e
            up = net.gradient(w, pick, y)[0]
            v[i] = old - e
            down = net.gradient(w, pick, y)[0]
            v[i] = old
            assert whole[i] == pytest.approx((up - down) / (2 * e), rel=0.02, abs=2e-5)


def test_windows_cover_texts():
    texts = ["w " * n for n in (0, 1, 31, 32, 33, 48, 49, 500)]
    w = toxicity.Windows(texts)
    for d, n in enumerate((0, 1, 31, 32, 33, 48, 49, 500)):
        spans = [(a - w.offsets[d], b - w.offsets[d]) for a, b in zip(w.start[w.doc == d], w.end[w.doc == d])]
        assert {i for a, b in spans for i in range(a, b)} == set(range(n))


def test_toxicity_learns(spark):
    r = random.Random(11)
    insults = ["grumblefool", "snarkwit", "dunderclod"]
    rows = []
    for i in range(700):
        words = [f"w{r.randrange(400)}" for _ in range(r.randrange(20, 200))]
        toxic = i % 3 == 0
        if toxic:
            for _ in range(3):
                words.insert(r.randrange(len(words)), r.choice(insults))
        rows.append((i, " ".join(words), int(toxic), "t"))
    rows += [(900, None, None, "t"), (901, "", 1, "t"), (None, "grumblefool snarkwit", 1, "t")]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int, label string")
    net = toxicity.train(df.select("doc_id", "text", "label"), df.select("doc_id", "toxic"))
    out = df.select("doc_id", "text", "toxic", toxicity.held_out().alias("h"), toxicity.scorer(spark, net)("text").alias("s"))
    rows = out.collect()
    for x in rows:
        assert 0 <= x["s"] <= 1
        assert x["h"] == (x["doc_id"] is not None and zlib.crc32(str(x["doc_id"]).encode()) % 5 == 0)
    held = [x for x in rows if x["h"] and x["text"]]
    assert np.mean([(x["s"] >= 0.5) == bool(x["toxic"]) for x in held]) > 0.95
    changed = df.select("doc_id", (1 - F.col("toxic")).alias("toxic")).where(toxicity.held_out())
    again = toxicity.train(df, df.select("doc_id", "toxic").where(~toxicity.held_out()).unionByName(changed))
    assert (again.score(["a grumblefool"]) == net.score(["a grumblefool"])).all()


def test_toxicity_trains_in_a_task(spark, monkeypatch):
    """The driver collects the network alone and no text; it is the one fitted to the same rows here."""
    r = random.Random(3)
    texts = [" ".join(r.choices(["sun", "rain", "wind", "snow"], k=12)) + " nastyword" * (i % 2) for i in range(60)]
    rows = [(i, t, i % 2) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    taken = sorted((str(i), t, k) for i, t, k in rows if zlib.crc32(str(i).encode()) % 5)
    want = toxicity.Network().fit([t for _, t, _ in taken], [k for _, _, k in taken]).score(texts)
    seen = []
    collect, first = type(df).collect, type(df).first

    def collected(self):
        seen.append(self.columns)
        return collect(self)

    monkeypatch.setattr(type(df), "collect", collected)
    monkeypatch.setattr(type(df), "first", lambda self: (seen.append(self.columns), first(self))[1])
    net = toxicity.train(df.select("doc_id", "text"), df.select("doc_id", "toxic"))
    monkeypatch.undo()
    assert seen and all("text" not in columns for columns in seen)
    assert np.allclose(net.score(texts), want, atol=1e-6)


def test_toxicity_without_labels(spark, documents, nothing):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    net = toxicity.train(documents, none)
    score = toxicity.scorer(spark, net)
    assert {r[0] for r in documents.select(score("text")).collect()} == {0.0}
    assert nothing.select(score("text")).count() == 0
