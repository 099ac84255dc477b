"""A trie of conversations, from whole sequences.

Turns become digests. Conversations of the same turns collapse into one weighted sequence with a list
of the conversations that end there. A sequence that is a proper prefix of another is dropped from
the leaves by an anti-join. Every prefix of a sequence carries its weight; prefixes of equal key add
up to the nodes. What a subtree saves is the tokens of its weighted prefixes less those of its
distinct ones, and a distinct node is counted with the sequence that holds the node's smallest
conversation, so the sum over a subtree needs no walk.

A conversation's digests (64 characters a turn) are held in one row; texts are not. End lists are
joined in stretches of neighbouring ids and hashed as a stream, so no list is held whole.

Results for odd input: rows without a conversation belong to none; NULL roles and texts are empty;
turns of equal number go by digest, repeated rows are repeated turns; an empty table gives no node,
not even a root. Other columns are not read, so their names do not matter.
"""

from __future__ import annotations

import hashlib
import sys

import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillmark.session import new_dir

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WIDTH = 64
STRETCH = 10  # bits of an id within one stretch of an end list
TURNS = "array<struct<digest: string, size: bigint>>"
ROOT = ""


def _stored(df: DataFrame, label: str) -> DataFrame:
    path = new_dir(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)


def conversations(turns: DataFrame) -> DataFrame:
    """One row per conversation: ``conv_id`` and its turns in order, as digests and byte counts."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    # The length tells where the role ends.
    digest = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    rows = turns.where(F.col("conv_id").isNotNull()).select(
        "conv_id", F.struct("turn", digest.alias("digest"), F.octet_length(text).cast("long").alias("size")).alias("t")
    )
    ordered = F.sort_array(F.collect_list("t"))
    return rows.groupBy("conv_id").agg(
        F.transform(ordered, lambda t: F.struct(t["digest"], t["size"])).alias("turns")
    )


def rebuilt(own: DataFrame, base: Column, n_head: Column, longest: int) -> DataFrame:
    """Conversations that begin with the first ``n_head`` turns (``longest`` at most) of ``base``."""
    heads = own.select(F.col("conv_id").alias("_base"), F.slice("turns", 1, longest).alias("_head"))
    joined = own.withColumns({"_base": base, "_n": n_head.cast("int")}).join(heads, "_base", "left")
    head = F.coalesce(F.slice("_head", 1, F.col("_n")), F.expr(f"cast(array() as {TURNS})"))
    rest = F.slice("turns", F.col("_n") + 1, F.size("turns"))
    return joined.select("conv_id", F.concat(head, rest).alias("turns"))


PREFIXES = T.StructType([
    T.StructField("keys", T.ArrayType(T.StringType())), T.StructField("upto", T.ArrayType(T.LongType())),
])


@F.pandas_udf(PREFIXES)
def prefix_keys(digests: pd.Series, sizes: pd.Series) -> pd.DataFrame:
    """The key of every prefix, the root's first, and the bytes of all turns up to there."""
    keys, upto = [], []
    for joined, size in zip(digests, sizes):
        key, total = ROOT, 0
        row, sums = [key], [0]
        for i, n in enumerate(size):
            key = hashlib.sha256((key + joined[i * WIDTH : (i + 1) * WIDTH]).encode()).hexdigest()
            total += int(n)
            row.append(key)
            sums.append(total)
        keys.append(row)
        upto.append(sums)
    return pd.DataFrame({"keys": keys, "upto": upto})


def hashed_lists(batches):
    """(seq, stretch) sorted by sequence and id, hashed on and on with commas between."""
    now, sha = None, None
    for batch in batches:
        seqs, hashes = [], []
        for seq, stretch in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if seq != now:
                if now is not None:
                    seqs.append(now)
                    hashes.append(sha.hexdigest())
                now, sha = seq, hashlib.sha256(stretch.encode())
            else:
                sha.update(b"," + stretch.encode())
        yield pa.RecordBatch.from_arrays([pa.array(seqs, pa.string()), pa.array(hashes, pa.string())], ["seq", "ends"])
    if now is not None:
        yield pa.RecordBatch.from_arrays([pa.array([now], pa.string()), pa.array([sha.hexdigest()], pa.string())], ["seq", "ends"])


def end_lists(members: DataFrame) -> DataFrame:
    """SHA-256 of each sequence's conversation ids, ascending, with commas between."""
    ids = F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string"))
    return (
        members.groupBy("seq", F.shiftright("conv_id", STRETCH).alias("part"))
        .agg(F.array_join(ids, ",").alias("stretch"))
        .repartition("seq")
        .sortWithinPartitions("seq", "part")
        .select("seq", "stretch")
        .mapInArrow(hashed_lists, "seq string, ends string")
    )


def prefix_trie(spark: SparkSession, members: DataFrame) -> DataFrame:
    """The nodes of the trie of ``members`` (conv_id, turns as digest and size).

    Returns conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens and ends_sha256.
    """
    joined = F.array_join(F.transform("turns", lambda t: t["digest"]), "")
    members = _stored(
        members.select("conv_id", joined.alias("digests"), F.transform("turns", lambda t: t["size"]).alias("sizes"))
        .withColumn("seq", F.sha2("digests", 256)),
        "trie-members",
    )
    collapsed = members.groupBy("seq").agg(
        F.count(F.lit(1)).alias("weight"), F.min("conv_id").alias("first"),
        F.any_value("digests").alias("digests"), F.any_value("sizes").alias("sizes"),
    )
    sequences = _stored(
        collapsed.select("seq", "weight", "first", prefix_keys("digests", "sizes").alias("p"))
        .select("seq", "weight", "first", F.element_at("p.keys", -1).alias("key"), "p.keys", "p.upto"),
        "trie-sequences",
    )
    last = F.size("keys") - 1
    depth = F.col("depth")
    prefixes = sequences.select("weight", "first", "keys", "upto", last.alias("last"), F.posexplode("keys").alias("depth", "node"))
    nodes = _stored(
        prefixes.select(
            "weight", "first", "last", "depth", "node",
            F.when(depth > 0, F.element_at("keys", F.greatest(depth, F.lit(1)))).alias("parent"),
        )
        .groupBy("node")
        .agg(
            F.min("depth").alias("depth"), F.min("parent").alias("parent"),
            F.sum("weight").alias("n_convs"), F.min("first").alias("conv_id"),
            F.max(depth < F.col("last")).alias("inner"),
        ),
        "trie-nodes",
    )
    inner = nodes.where("inner").select(F.col("node").alias("key"))
    leaves = sequences.join(inner, "key", "left_anti").withColumn("leaf", F.lit(1))
    others = sequences.join(inner, "key", "left_semi").withColumn("leaf", F.lit(0))
    # Nodes belong to the sequence of their smallest conversation: those from a depth on.
    owned = nodes.groupBy(F.col("conv_id").alias("first")).agg(F.min("depth").alias("own"))
    whole = F.element_at("upto", -1)
    before = F.element_at("upto", F.greatest(depth, F.lit(1)))
    owns = F.element_at("upto", F.greatest(depth, F.col("own"), F.lit(1)))
    distinct = F.when(F.col("own").isNull(), F.lit(0)).otherwise(whole - owns)
    sums = (
        leaves.unionByName(others)
        .join(owned, "first", "left")
        .select("weight", "leaf", "own", "upto", F.posexplode("keys").alias("depth", "node"))
        .select("node", "leaf", (F.col("weight") * (whole - before) - distinct).alias("saved"))
        .groupBy("node")
        .agg(F.sum("leaf").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))
    )
    children = nodes.where("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(
        F.count(F.lit(1)).alias("n_children")
    )
    parents = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    ends = end_lists(members.select("seq", "conv_id")).join(sequences.select("seq", "key"), "seq")
    none = hashlib.sha256(b"").hexdigest()
    return (
        nodes.join(sums, "node")
        .join(children, "node", "left")
        .join(ends.select(F.col("key").alias("node"), "ends"), "node", "left")
        .join(parents, "parent", "left")
        .select(
            "conv_id", F.col("depth").cast("long").alias("depth"), "parent_conv_id", "n_convs",
            F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
            "n_leaves", "saved_tokens", F.coalesce("ends", F.lit(none)).alias("ends_sha256"),
        )
    )
