"""The queries of this package over the tables of a test directory, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmark import session
from tillmark.llm import (
    line_dedup,
    line_rules,
    merkle,
    mixing,
    neighbours,
    ngram_join,
    prefix_trie,
    quality,
    toxicity,
    warc,
)
from tillmark.llm.exact_dedup import stream_dedup
from tillmark.llm.pieces import encode_nbest
from tillmark.llm.token_counts import token_prefixes

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

ARROW_ROWS = "1000"


def prepare(spark: SparkSession) -> None:
    """Session settings of this package.

    Whole texts travel to Python in batches of rows: few enough for very long ones.
    """
    session.tune(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)


def query(fn: Callable[[SparkSession, str], DataFrame]):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepare(spark)
        return fn(spark, sf_dir.rstrip("/"))

    QUERIES[fn.__name__] = run
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_file(name: str) -> str:
    """The path of a public vocabulary file, on the driver."""
    import public_tokenizers

    return public_tokenizers.path(name)


TOKEN_LIMIT = 512


@query
def op4_prefix_token_counts(spark, sf_dir):
    found = token_prefixes(
        table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"),
        limit=TOKEN_LIMIT, with_steps=False,
    )
    return found.select(
        F.col("id").alias("doc_id"), "n_bytes", "n_tokens",
        (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"), "cut_chars",
    )


@query
def op6_stream_dedup(spark, sf_dir):
    found = stream_dedup(spark, f"{sf_dir}/documents.parquet")
    return found.select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept",
        F.col("digest").alias("text_sha256"),
    )


ORACLE["op6_stream_dedup"] = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""


# The tree: domains by the number in the source's name, then language, then source.
MIX_WEIGHTS = {
    ("core",): 3, ("extra",): 2, ("core", "en"): 2, ("extra", "en"): 2, ("tail", "en"): 2,
    ("core", "en", "src0"): 2,
}
MIX_SEED = 11
MIX_EPOCHS = 3


def domain(source):
    number = F.regexp_extract(F.coalesce(source, F.lit("")), r"([0-9]{1,9})$", 1)
    return (
        F.when(number == "", "other")
        .when(number.cast("int") < 5, "core")
        .when(number.cast("int") < 10, "extra")
        .otherwise("tail")
    )


def mix_keys() -> dict:
    return {"domain": domain(F.col("source")), "lang": F.col("lang"), "source": F.col("source")}


@query
def op3_hierarchical_mix(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    found = mixing.mix(
        docs, mix_keys(), MIX_WEIGHTS, F.expr("total div 2"), MIX_EPOCHS, MIX_SEED
    )
    return found.select(
        "doc_id", domain(F.col("source")).alias("domain"), "lang", "source",
        F.col("_mix_epoch").alias("epoch"), F.col("_mix_tokens").alias("tokens"),
        F.col("_mix_take").alias("take_tokens"),
    )


def _mix_share(level: str, above: str, parent: str, name: str, weight: str) -> str:
    """Common table expressions sharing the budgets of table ``above`` among ``level``."""
    keys = f"{parent}, {name}" if parent else name
    part = f"PARTITION BY {parent}" if parent else ""
    joined = f"JOIN {above} USING ({parent})" if parent else f"CROSS JOIN {above}"
    return f"""
{level}_nodes AS (
  SELECT {keys}, capacity, weight, budget AS parent_budget
  FROM (SELECT {keys}, sum(available) * {MIX_EPOCHS} AS capacity, {weight} AS weight
        FROM leaves GROUP BY {keys}) {joined}),
{level}_rest AS (
  SELECT *, parent_budget - coalesce(sum(capacity) OVER before, 0) AS rest,
         sum(weight) OVER ({part}) - coalesce(sum(weight) OVER before, 0) AS weight_left
  FROM {level}_nodes
  WINDOW before AS ({part} ORDER BY capacity::DOUBLE / weight, {name}
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
{level}_full AS (
  SELECT *, capacity::HUGEINT * weight_left <= rest::HUGEINT * weight AS is_full FROM {level}_rest),
{level}_open AS (
  SELECT *, greatest(0, parent_budget - sum(CASE WHEN is_full THEN capacity ELSE 0 END) OVER ({part})) AS b,
         sum(CASE WHEN is_full THEN 0 ELSE weight END) OVER ({part}) AS w,
         sum(CASE WHEN is_full THEN 0 ELSE weight END) OVER ({part} ORDER BY {name}) AS upto
  FROM {level}_full),
{level} AS (
  SELECT {keys}, CASE WHEN is_full THEN capacity
                 ELSE b::HUGEINT * upto // w - b::HUGEINT * (upto - weight) // w END::BIGINT AS budget
  FROM {level}_open)"""


ORACLE["op3_hierarchical_mix"] = f"""
WITH docs AS (
  SELECT *, row_number() OVER () AS rn, coalesce(lang, '(none)') AS k_lang,
         coalesce(source, '(none)') AS k_source,
         CASE WHEN number = '' THEN 'other' WHEN number::INT < 5 THEN 'core'
              WHEN number::INT < 10 THEN 'extra' ELSE 'tail' END AS k_domain,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS tokens
  FROM (SELECT *, regexp_extract(coalesce(source, ''), '([0-9]{{1,9}})$', 1) AS number FROM documents)),
leaves AS (
  SELECT k_domain, k_lang, k_source, sum(tokens) AS available FROM docs GROUP BY ALL),
root AS (SELECT least(sum(available) // 2, sum(available) * {MIX_EPOCHS}) AS budget FROM leaves),
{_mix_share("l1", "root", "", "k_domain",
            "CASE k_domain WHEN 'core' THEN 3 WHEN 'extra' THEN 2 ELSE 1 END")},
{_mix_share("l2", "l1", "k_domain", "k_lang",
            "CASE WHEN k_domain <> 'other' AND k_lang = 'en' THEN 2 ELSE 1 END")},
{_mix_share("l3", "l2", "k_domain, k_lang", "k_source",
            "CASE WHEN k_domain = 'core' AND k_lang = 'en' AND k_source = 'src0' THEN 2 ELSE 1 END")},
parts AS (
  SELECT k_domain, k_lang, k_source, budget // available AS whole, budget % available AS rest
  FROM l3 JOIN leaves USING (k_domain, k_lang, k_source) WHERE budget > 0),
placed AS (
  SELECT *, coalesce(sum(tokens) OVER (
              PARTITION BY k_domain, k_lang, k_source
              ORDER BY md5('{MIX_SEED}|' || whole || '|' || coalesce(doc_id::VARCHAR, '(none)')),
                       doc_id, md5(coalesce(text, ''))
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM docs JOIN parts USING (k_domain, k_lang, k_source)),
taken AS (
  SELECT *, unnest(range(0, whole::BIGINT)) AS epoch, tokens AS take FROM placed
  UNION ALL BY NAME
  SELECT *, whole::BIGINT AS epoch, least(tokens, rest - before) AS take
  FROM placed WHERE before < rest)
SELECT doc_id, k_domain AS domain, lang, source, epoch, tokens::BIGINT AS tokens,
       take::BIGINT AS take_tokens
FROM taken
"""


NBEST = 4


@query
def op2_sentencepiece_nbest(spark, sf_dir):
    found = encode_nbest(
        table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"),
        n=NBEST, ids_of=NBEST,
    )
    return found.select(
        F.col("id").alias("doc_id"), "n_pieces", "scores", "pieces", "ids_crc32", "round_trip",
        F.transform("ids", lambda ids: F.crc32(ids)).alias("nbest_crc32"),
    )


@query
def op10_bigru_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    network = toxicity.train(docs, table(spark, sf_dir, "labels"))
    score = toxicity.scorer(spark, network)
    return (
        docs.select("doc_id", toxicity.held_out().alias("held_out"), score("text").alias("score"))
        .withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
    )


@query
def op9_projection_forest(spark, sf_dir):
    found = neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0, k=20)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


ORACLE["op9_projection_forest"] = """
WITH good AS (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v) AS score
  FROM good q JOIN good c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM pairs)
SELECT query_id, rank::INT AS rank, vec_id, score FROM ranked WHERE rank <= 20
"""


@query
def op5_revisit_resolution(spark, sf_dir):
    found = warc.deduplicate(table(spark, sf_dir, "pages"))
    return found.select(
        F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to"
    )



# Base32 of a SHA-1: 32 letters, each of 5 bits; 5 hexadecimal digits are 4 letters.
_LETTERS = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(hex, {5 * g + 1}, 5))::BIGINT"
    f" >> {15 - 5 * k}) & 31)::INT, 1)"
    for g in range(8)
    for k in range(4)
)

ORACLE["op5_revisit_resolution"] = f"""
WITH sums AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS hex,
         min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first
  FROM pages)
SELECT page_id, payload_bytes, {_LETTERS} AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM sums
"""


@query
def op1_line_chunk_dedup(spark, sf_dir):
    found = line_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    removed = F.coalesce("_line_removed", F.array().cast(found.schema["_line_removed"].dataType))
    return found.select(
        "doc_id", F.col("_line_count").cast("long").alias("n_lines"),
        F.aggregate(removed, F.lit(0).cast("long"), lambda s, r: s + r["lines"]).alias("n_removed"),
        F.transform(removed, lambda r: r["kept_by"]).alias("kept_by"), "text",
    )


@query
def op7_weak_label_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    score = quality.scorer(spark, quality.train(docs))
    return docs.select("doc_id", score("text").alias("score")).withColumn(
        "keep", F.col("score") >= quality.KEEP
    )


@query
def op8_jaccard_join(spark, sf_dir):
    found = ngram_join.near_duplicates(table(spark, sf_dir, "documents"))
    return found.withColumnRenamed("id", "doc_id")


def _crc32(digits: str) -> str:
    """DuckDB SQL for the unsigned CRC-32 of a decimal number: eight shifts for each character."""
    return f"""xor(4294967295, list_reduce(
  list_concat([4294967295::BIGINT], flatten(list_transform(string_split({digits}, ''),
    lambda ch: [ascii(ch)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
  lambda crc, x: CASE WHEN x >= 0 THEN xor(crc, x)
                      ELSE xor(crc >> 1, 3988292384 * (crc & 1)) END))"""


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TAMPER_EVERY = 5


@query
def op11_merkle_manifest(spark, sf_dir):
    found = merkle.manifest(
        spark, table(spark, sf_dir, "documents"),
        altered={"text": F.translate("text", UPPER, LOWER)},
        where=F.crc32(F.col("doc_id").cast("string")) % TAMPER_EVERY == 0,
    )
    return found.select(
        "doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("path")).alias("proof_sha256"),
        "folded_root", "verified",
    )


# Levels of a tree and levels of the roots in the SQL: enough for 16 to the power of each.
MERKLE_LEVELS = 7


def _merkle_levels(name: str, leaves: str) -> str:
    """Levels name_0, name_1, ... of all trees; a tree ends where one node is left."""
    steps = [f"{name}_0 AS (SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM {leaves})"]
    for k in range(MERKLE_LEVELS):
        steps.append(f"""
{name}_{k + 1} AS (
  SELECT tree, pos // 16 AS pos, sha256(string_agg(digest, '' ORDER BY pos)) AS digest, any_value((n + 15) // 16) AS n
  FROM {name}_{k} WHERE n > 1 GROUP BY tree, pos // 16)""")
    steps.append(f"\n{name}_top AS (" + " UNION ALL ".join(
        f"SELECT tree, digest FROM {name}_{k} WHERE n = 1" for k in range(MERKLE_LEVELS + 1)) + ")")
    # Siblings of the node above each leaf, level by level.
    sides = []
    for k in range(MERKLE_LEVELS):
        at = f"l.pos // {16**k}"
        sides.append(f"""
{name}_side_{k} AS (
  SELECT l.tree, l.pos, string_agg(s.digest, '' ORDER BY s.pos) FILTER (s.pos < {at}) AS before,
         string_agg(s.digest, '' ORDER BY s.pos) FILTER (s.pos > {at}) AS after
  FROM {name}_0 l JOIN {name}_{k} s ON s.tree = l.tree AND s.n > 1 AND s.pos // 16 = l.pos // {16 ** (k + 1)}
  GROUP BY l.tree, l.pos)""")
    joins = " ".join(f"LEFT JOIN {name}_side_{k} s{k} ON s{k}.tree = l.tree AND s{k}.pos = l.pos" for k in range(MERKLE_LEVELS))
    pairs = ", ".join(
        f"CASE WHEN s{k}.pos IS NOT NULL THEN [{{'a': coalesce(s{k}.before, ''), 'b': coalesce(s{k}.after, '')}}] ELSE [] END"
        for k in range(MERKLE_LEVELS))
    sides.append(f"\n{name}_path AS (SELECT l.tree, l.pos, flatten([{pairs}]) AS path FROM {name}_0 l {joins})")
    return ",".join(steps + sides)


def _merkle_leaf(text: str) -> str:
    parts = [
        f"coalesce(strlen({v}::VARCHAR) || ':' || {v}::VARCHAR, '-')"
        for v in ("doc_id", "source", "lang", "n_chars", text)
    ]
    return f"sha256({' || '.join(parts)})"


ORACLE["op11_merkle_manifest"] = f"""
WITH docs AS (
  SELECT doc_id, coalesce('=' || source, '-') AS tree, {_merkle_leaf("text")} AS digest,
         CASE WHEN {_crc32("doc_id::VARCHAR")} % {TAMPER_EVERY} = 0
              THEN {_merkle_leaf(f"translate(text, '{UPPER}', '{LOWER}')")} END AS altered
  FROM documents),
leaves AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, digest) - 1 AS pos FROM docs),
{_merkle_levels("t", "leaves")},
subroots AS (
  SELECT '' AS tree, tree AS name, digest, row_number() OVER (ORDER BY tree) - 1 AS pos FROM t_top),
{_merkle_levels("c", "subroots")},
proofs AS (
  SELECT l.doc_id, l.digest AS leaf, l.altered, s.digest AS subroot, c_top.digest AS root,
         list_concat(p.path, u.path) AS path
  FROM leaves l JOIN t_path p USING (tree, pos) JOIN subroots s ON s.name = l.tree
  JOIN c_path u ON u.pos = s.pos, c_top),
folds AS (
  SELECT *, list_reduce(list_concat([{{'a': coalesce(altered, leaf), 'b': ''}}], path),
                        lambda d, p: {{'a': sha256(p.a || d.a || p.b), 'b': ''}}).a AS folded_root
  FROM proofs)
SELECT doc_id, leaf, subroot, root,
       sha256(list_aggregate(list_concat([''], list_transform(path, lambda p: p.a || p.b)), 'string_agg', '')) AS proof_sha256,
       folded_root, folded_root = root AS verified
FROM folds
"""


@query
def op12_line_frequency(spark, sf_dir):
    return line_rules.line_frequency(spark, table(spark, sf_dir, "documents"))


_WORDS = "regexp_extract_all(coalesce({}, ''), '[^\\x20\\x09-\\x0D]+')"

ORACLE["op12_line_frequency"] = f"""
WITH docs AS (
  SELECT row_number() OVER () AS rn, doc_id, coalesce('=' || source, '-') AS host, coalesce(text, '') AS body,
         {_WORDS.format("text")} AS words
  FROM documents),
windows AS (
  SELECT rn, unnest(starts) AS i, unnest(list_transform(starts, lambda x:
           array_to_string(words[x : x + {line_rules.WINDOW - 1}], ' '))) AS w
  FROM (SELECT rn, words, range(1, len(words) - {line_rules.WINDOW - 2}) AS starts FROM docs)),
twice AS (
  SELECT rn, i FROM (SELECT rn, i, count(*) OVER (PARTITION BY rn, w) AS n FROM windows) WHERE n > 1),
repeats AS (
  SELECT rn, sum(least({line_rules.WINDOW}, gap))::BIGINT AS n_repeat_words
  FROM (SELECT rn, coalesce(lead(i) OVER (PARTITION BY rn ORDER BY i) - i, {line_rules.WINDOW}) AS gap FROM twice)
  GROUP BY rn),
every_line AS (SELECT rn, doc_id, host, unnest(string_split(body, chr(10))) AS line FROM docs),
lines AS (
  SELECT *, lower(trim(regexp_replace(line, '[\\x20\\x09-\\x0D]+', ' ', 'g'))) AS plain, len({_WORDS.format("line")}) AS n
  FROM every_line WHERE len({_WORDS.format("line")}) > 0),
dups AS (SELECT rn, count(*) - count(DISTINCT line) AS n_dup_lines FROM lines GROUP BY rn),
hosts AS (SELECT host, count(DISTINCT coalesce(doc_id::VARCHAR, 'row ' || rn)) AS host_docs FROM docs GROUP BY host),
common AS (
  SELECT host, plain
  FROM (SELECT host, plain, count(DISTINCT coalesce(doc_id::VARCHAR, 'row ' || rn)) AS n FROM lines GROUP BY ALL)
  JOIN hosts USING (host)
  WHERE n >= {line_rules.COMMON_DOCUMENTS} AND n * 100 > host_docs * {line_rules.COMMON_PERCENT}),
gone AS (SELECT rn, sum(n) AS gone FROM lines JOIN common USING (host, plain) GROUP BY rn),
counts AS (
  SELECT doc_id, len(words)::BIGINT AS n_words, length(list_aggregate(list_concat([''], words), 'string_agg', ''))::BIGINT AS word_chars,
         len(regexp_extract_all(body, '[#*$%&|<>]'))::BIGINT AS n_symbols,
         coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
         coalesce(gone, 0)::BIGINT AS n_common_words
  FROM docs LEFT JOIN repeats USING (rn) LEFT JOIN dups USING (rn) LEFT JOIN gone USING (rn)),
judged AS (
  SELECT *, n_words < {line_rules.LEAST_WORDS}
            OR 100 * n_repeat_words > {line_rules.REPEATED_PERCENT} * n_words AS base_failed
  FROM counts)
SELECT *, NOT base_failed AND 100 * (n_words - n_common_words) >= {line_rules.LEFT_PERCENT} * n_words AS kept
FROM judged
"""


TRIE_EVERY = 5
TRIE_HEAD = 9


@query
def op13_prefix_trie(spark, sf_dir):
    own = prefix_trie.conversations(table(spark, sf_dir, "conversations"))
    members = prefix_trie.rebuilt(
        own, F.col("conv_id") - F.col("conv_id") % TRIE_EVERY,
        F.crc32(F.col("conv_id").cast("string")) % TRIE_HEAD, TRIE_HEAD - 1,
    )
    return prefix_trie.prefix_trie(spark, members)


ORACLE["op13_prefix_trie"] = f"""
WITH turns AS (
  SELECT conv_id, struct_pack(r := coalesce(role, ''), t := coalesce(text, '')) AS said, turn,
         sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS digest
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (
  SELECT conv_id, list(digest ORDER BY turn NULLS FIRST, digest) AS ds,
         list(strlen(said.t) ORDER BY turn NULLS FIRST, digest) AS bs
  FROM turns GROUP BY conv_id),
heads AS (
  SELECT *, {_crc32("conv_id::VARCHAR")} % {TRIE_HEAD} AS h, conv_id - conv_id % {TRIE_EVERY} AS base FROM own),
convs AS (
  SELECT x.conv_id, list_concat(coalesce(b.ds, [])[1 : x.h], x.ds[x.h + 1 :]) AS ds,
         list_concat(coalesce(b.bs, [])[1 : x.h], x.bs[x.h + 1 :]) AS bs
  FROM heads x LEFT JOIN own b ON b.conv_id = x.base),
prefixes AS (
  SELECT conv_id, d, array_to_string(ds[1 : d], '') AS k, CASE WHEN d > 0 THEN bs[d] ELSE 0 END AS b, len(ds) AS size
  FROM (SELECT *, unnest(range(0, len(ds) + 1)) AS d FROM convs)),
nodes AS (
  SELECT d, k, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(b) AS b,
         string_agg(CASE WHEN d = size THEN conv_id::VARCHAR END, ',' ORDER BY conv_id) AS ends
  FROM prefixes GROUP BY d, k),
links AS (
  SELECT c.d, c.k, p.k AS parent, p.conv_id AS parent_conv_id
  FROM nodes c JOIN nodes p ON p.d = c.d - 1 AND p.k = c.k[1 : 64 * (c.d - 1)]),
kids AS (SELECT parent AS k, count(*) AS n_children FROM links GROUP BY parent),
sums AS (
  SELECT up.d, up.k, sum((x.n_convs - 1) * x.b) AS saved, count(*) FILTER (kids.k IS NULL) AS n_leaves
  FROM nodes x LEFT JOIN kids ON kids.k = x.k
  JOIN prefixes up ON up.conv_id = x.conv_id AND up.d <= x.d
  GROUP BY up.d, up.k)
SELECT n.conv_id, n.d::BIGINT AS depth, links.parent_conv_id, n.n_convs::BIGINT AS n_convs,
       coalesce(n_children, 0)::BIGINT AS n_children, n_leaves::BIGINT AS n_leaves,
       saved::BIGINT AS saved_tokens, sha256(coalesce(ends, '')) AS ends_sha256
FROM nodes n JOIN sums USING (d, k) LEFT JOIN links USING (d, k) LEFT JOIN kids USING (k)
"""
