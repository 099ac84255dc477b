"""The Merkle manifest, the line rules and the prefix trie on odd rows, against plain Python."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F
from test_operators import SCHEMA, document_rows, words

from tillmark.llm import line_rules, merkle, prefix_trie
from tillmark.llm.queries import prepare
from tillmark.session import new_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def table(spark, rows, schema, parts=3):
    """A stored table, as the operators meet it."""
    prepare(spark)
    path = new_dir(spark, "odd")
    spark.createDataFrame(rows, schema).repartition(parts).write.parquet(path)
    return spark.read.schema(schema).parquet(path)


# -- 11: Merkle manifest ---------------------------------------------------------------------


def plain_leaf(values):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def plain_levels(digests):
    levels = [digests]
    while len(levels[-1]) > 1:
        low = levels[-1]
        levels.append([sha("".join(low[i : i + 16])) for i in range(0, len(low), 16)])
    return levels


def plain_path(levels, i):
    path = []
    for low in levels[:-1]:
        run = i // 16 * 16
        path.append(("".join(low[run:i]), "".join(low[i + 1 : run + 16])))
        i //= 16
    return path


def plain_manifest(rows):
    """(doc_id, leaf, subroot, root, proof, folded, verified) of (doc_id, source, lang, n_chars, text)."""
    groups = defaultdict(list)
    for r in rows:
        groups[r[1]].append((r[0] is not None, r[0] or 0, plain_leaf(r), r))
    trees = {}
    for name, found in groups.items():
        found.sort(key=lambda x: x[:3])
        trees[name] = plain_levels([x[2] for x in found])
    names = sorted(trees, key=lambda n: (n is not None, (n or "").encode()))
    crown = plain_levels([trees[n][-1][0] for n in names])
    out = []
    lower = str.maketrans(UPPER, UPPER.lower())
    for j, name in enumerate(names):
        for i, (_, _, leaf, r) in enumerate(groups[name]):
            path = plain_path(trees[name], i) + plain_path(crown, j)
            digest = leaf
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and r[4] is not None:
                digest = plain_leaf((*r[:4], r[4].translate(lower)))
            for left, right in path:
                digest = sha(left + digest + right)
            proof = sha("".join(a + b for a, b in path))
            root = crown[-1][0]
            out.append((r[0], leaf, trees[name][-1][0], root, proof, digest, digest == root))
    return sorted(out, key=str)


def manifest_rows(spark, docs):
    found = merkle.manifest(
        spark, docs, altered={"text": F.translate("text", UPPER, UPPER.lower())},
        where=F.crc32(F.col("doc_id").cast("string")) % 5 == 0,
    )
    found = found.select(
        "doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("path")).alias("p"),
        "folded_root", "verified",
    )
    return sorted(map(tuple, found.collect()), key=str)


def test_manifest_of_odd_rows(spark):
    rows = document_rows()
    got = manifest_rows(spark, table(spark, rows, SCHEMA))
    assert got == plain_manifest([(r[0], r[3], r[2], r[4], r[1]) for r in rows])
    assert any(not r[-1] for r in got)


DOCS = "doc_id long, source string, lang string, n_chars long, text string"


@pytest.mark.parametrize("sizes", [
    {"a": 1}, {None: 1}, {"a": 16}, {"a": 17, "b": 1}, {"a": 256, None: 2}, {"a": 257, "b": 16, "c": 15},
    {"a": 4096 + 1, "ä": 300}, {f"s{i}": 1 + i % 3 for i in range(20)}, {f"s{i}": 1 for i in range(300)},
])
def test_manifest_of_every_shape(spark, sizes):
    rows = [
        (i * 7 - 50, s, "en", i, f"Text {i}") for s, n in sizes.items() for i in range(n)
    ]
    random.Random(3).shuffle(rows)
    assert manifest_rows(spark, table(spark, rows, DOCS, 5)) == plain_manifest(rows)


def test_manifest_of_nothing_and_of_other_names(spark):
    assert manifest_rows(spark, table(spark, [], DOCS)) == []
    odd = "tree long, pos long, digest string, n long, path string, root string, `a.b` string"
    rows = [(i, i, f"d{i}", i, "p", "r", "x") for i in range(40)]
    found = merkle.manifest(
        spark, table(spark, rows, odd), columns=["tree", "digest", "a.b"], group="root", order="tree"
    )
    assert found.columns == ["tree", "leaf", "subroot", "root", "path", "folded_root", "verified"]
    assert [r.verified for r in found.collect()] == [True] * 40


def test_manifest_of_one_row_repeated(spark):
    rows = [(1, "a", "en", 3, "Abc")] * 600
    assert manifest_rows(spark, table(spark, rows, DOCS, 4)) == plain_manifest(rows)


# -- 12: line rules --------------------------------------------------------------------------

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_rules(rows):
    """Rows of (doc_id, text, source)."""
    lines, docs = defaultdict(set), defaultdict(set)

    def normal(line):
        return re.sub(r"[\x20\x09-\x0D]+", " ", line).strip(" ").lower()

    named = [(f"row {i}" if r[0] is None else r[0], *r) for i, r in enumerate(rows)]
    for name, _, text, host in named:
        docs[host].add(name)
        for line in (text or "").split("\n"):
            if WORD.search(line):
                lines[host, normal(line)].add(name)
    common = {
        k for k, v in lines.items()
        if len(v) >= line_rules.COMMON_DOCUMENTS
        and 100 * len(v) > line_rules.COMMON_PERCENT * len(docs[k[0]])
    }
    out = []
    for _, doc_id, text, host in named:
        text = text or ""
        found = WORD.findall(text)
        n = len(found)
        windows = Counter(tuple(found[i : i + 8]) for i in range(n - 7))
        held = {i + k for i in range(n - 7) if windows[tuple(found[i : i + 8])] > 1 for k in range(8)}
        good = [x for x in text.split("\n") if WORD.search(x)]
        gone = sum(len(WORD.findall(x)) for x in good if (host, normal(x)) in common)
        failed = n < 20 or 100 * len(held) > 30 * n
        out.append((
            doc_id, n, sum(map(len, found)), sum(c in "#*$%&|<>" for c in text), len(good) - len(set(good)),
            len(held), gone, failed, not failed and 100 * (n - gone) >= 50 * n,
        ))
    return sorted(out, key=str)


def rule_rows(spark, rows, schema):
    return sorted(map(tuple, line_rules.line_frequency(spark, table(spark, rows, schema)).collect()), key=str)


def test_rules_on_odd_rows(spark):
    rows = document_rows()
    assert rule_rows(spark, rows, SCHEMA) == plain_rules([(r[0], r[1], r[3]) for r in rows])


RULED = "doc_id long, text string, source string, row long, key string, host string, words int, docs int, hash binary"


def test_common_lines_of_a_host(spark):
    r = random.Random(4)
    footer, rare = words(r, 12), words(r, 9)
    rows = []
    for i in range(60):
        body = "\n".join(words(r, 10) for _ in range(6))
        if i % 3 == 0:
            body += f"\n  {footer.upper()} \t\n{footer}"
        if i < 9:
            body += "\n" + rare  # not often enough
        rows.append((i, body, "hot" if i < 45 else None))
    # What is left is too little; the same line elsewhere is not common there.
    rows += [(100 + i, f"{footer}\n{footer}\n{words(r, 5)}", "hot") for i in range(3)]
    rows += [(200, f"{footer}\n{words(r, 15)}", "other"), (None, footer, "hot"), (None, footer, "hot")]
    # Repeated rows of one document are one document: nine documents are below the limit.
    line = words(r, 20)
    rows += [(300 + i % 9, line + "\n" + words(r, 20), "again") for i in range(40)]
    full = [(*x, 1, "k", "h", 2, 3, b"x") for x in rows]
    got = rule_rows(spark, full, RULED)
    assert got == plain_rules(rows)
    verdicts = {x[0]: x[-1] for x in got}
    assert not verdicts[100] and verdicts[0] and verdicts[1] and verdicts[200] and verdicts[300]
    assert [x[6] for x in got if x[0] == 0] == [24]


def test_repeated_windows(spark):
    r = random.Random(5)
    seven, eight = words(r, 7), words(r, 8)
    texts = [
        "a " * 8, "a " * 9, "a " * 16, f"{seven} x {seven}", f"{eight} {eight}", f"{eight} x {eight}",
        f"{eight} {words(r, 30)} {eight} {seven} {eight} {seven}", "x" * 70000, " ".join(["w"] * 30000),
        "A b c d e f g h a b c d e f g h", "a\nb c\td e f g h\x0b" * 2, "é 🙂 " * 8, "    " * 8,
        "# * $ % & | < > " * 2, "\n\n \n", "one\none\n one\none \r\none",
    ]
    rows = [(i, t, "s") for i, t in enumerate(texts)]
    assert rule_rows(spark, rows, "doc_id long, text string, source string") == plain_rules(rows)


def test_rules_of_nothing(spark):
    assert rule_rows(spark, [], "doc_id long, text string, source string") == []


# -- 13: prefix trie -------------------------------------------------------------------------

TURNS = "conv_id long, turn long, role string, text string, depth long, node string, seq string, weight int"


def plain_trie(rows):
    """Nodes of (conv_id, turn, role, text) rows, rebuilt as the query does."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            tie = sha(f"{len(role.encode())}:{role}{text}")
            own[c].append((turn is not None, turn or 0, tie, role, text))
    convs = {}
    for c in own:
        n = zlib.crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5 if c >= 0 else -(abs(c) % 5))
        head = sorted(own.get(base, []))[:n]
        convs[c] = [x[3:] for x in head + sorted(own[c])[n:]]
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = Counter(), Counter()
    for node, ids in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += node not in children
            saved[node[:d]] += (len(ids) - 1) * (len(node[-1][1].encode()) if node else 0)
    out = []
    for node, ids in members.items():
        ends = ",".join(str(c) for c in sorted(ids) if len(convs[c]) == len(node))
        out.append((
            min(ids), len(node), min(members[node[:-1]]) if node else None, len(ids),
            len(children.get(node, [])), leaves[node], saved[node], sha(ends),
        ))
    return sorted(out, key=str)


def trie_rows(spark, rows):
    own = prefix_trie.conversations(table(spark, [(*r, 1, "n", "s", 2) for r in rows], TURNS))
    c = F.col("conv_id")
    members = prefix_trie.rebuilt(own, c - c % 5, F.crc32(c.cast("string")) % 9, 8)
    return sorted(map(tuple, prefix_trie.prefix_trie(spark, members).collect()), key=str)


def test_trie_of_odd_rows(spark):
    r = random.Random(6)
    texts = ["hi", "", None, "é 🙂", "yes", "no", "x" * 50000, ",", "1:a"]
    rows = []
    for c in [*range(-12, 150), 10**12, 10**12 + 1, 10**12 + 3]:
        for t in range(r.randrange(1, 12)):
            rows.append((c, r.choice([t, t, t, None]) if c % 7 == 0 else t, r.choice(["user", "bot", None]), r.choice(texts[:3] if t < 3 else texts)))
    rows += [(None, 0, "user", "lost"), (None, None, None, None)]
    rows += [x for x in rows if x[0] == 20]  # repeated rows
    rows += [(200, i, "user", "long") for i in range(300)] + [(205, i, "user", "long") for i in range(260)]
    assert trie_rows(spark, rows) == plain_trie(rows)


def test_trie_of_equal_conversations(spark):
    """End lists over several stretches of ids; one conversation that many others begin with."""
    rows = [(5 * i, t, "user", f"turn {t}") for i in range(700) for t in range(3)]
    rows += [(5 * i, 9, "bot", f"own {i}") for i in range(0, 700, 7)]
    assert trie_rows(spark, rows) == plain_trie(rows)


def test_trie_of_few_turns(spark):
    assert trie_rows(spark, []) == []
    assert trie_rows(spark, [(1, 0, "a", "b")]) == plain_trie([(1, 0, "a", "b")])
    # A conversation may lose its only turn to the head of an absent one.
    rows = [(c, 0, "user", "x") for c in (1, 2, 3, 4)]
    assert trie_rows(spark, rows) == plain_trie(rows)
