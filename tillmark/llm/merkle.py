"""A Merkle manifest of a table: one tree per group, one tree over the groups' roots.

Leaves of a group stand in the order of their key. An aligned block of ``FAN * FAN`` nodes keeps a
level as one string of hexadecimal digests side by side. Substrings of fixed width, ``FAN`` digests
long, are hashed into the next level of the block; the digest that remains of each block is a node
of the next round, until one block holds all. The siblings of a node are the substrings on either
side of it in its run. A position never needs a window over a whole group: rows are dealt out and
sorted by range, numbered within their partition, and only counts per partition are added up.

Results for odd input: NULL in a column is hashed as ``-``; rows without a key come first in their
group, rows without a group form a group of their own ahead of all others; repeated rows and rows of
equal key are leaves of their own, ordered by digest; an empty table gives no rows. Columns other
than those named are not read, so their names do not matter.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillmark.session import new_dir

FAN = 16
WIDTH = 64  # characters of a SHA-256 in hexadecimal
BLOCK = FAN * FAN
RUN = FAN * WIDTH
NO_PATH = "cast(array() as array<struct<left: string, right: string>>)"


def leaf_digest(values: Sequence[Column]) -> Column:
    """SHA-256 of the values side by side, each ``-`` for NULL, else its bytes, ``:`` and itself."""

    def element(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*map(element, values)), 256)


def _stored(df: DataFrame, label: str) -> DataFrame:
    path = new_dir(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)


def positions(df: DataFrame, tree: str, order: Sequence[str]) -> DataFrame:
    """``df`` with the place ``pos`` of each row in its tree, from 0, and the tree's size ``n``.

    ``order`` must tell all rows of a tree apart. Rows are stored once, sorted by range; the sums
    run over a row per tree and partition.
    """
    keys = [tree, *order]
    dealt = _stored(
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumns({
            "_part": F.spark_partition_id(),
            "_row": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)),
        }),
        "merkle-sorted",
    )
    before = W.partitionBy(tree).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    starts = (
        dealt.groupBy(tree, "_part")
        .agg(F.count(F.lit(1)).alias("_count"), F.min("_row").alias("_first"))
        .select(
            tree, "_part",
            (F.coalesce(F.sum("_count").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
            F.sum("_count").over(W.partitionBy(tree)).alias("n"),
        )
    )
    return (
        dealt.join(starts, [tree, "_part"])
        .withColumn("pos", F.col("_row") + F.col("_shift"))
        .drop("_row", "_part", "_shift")
    )


def _digest_at(level: Column, i: Column) -> Column:
    """The digest at place ``i`` of a level kept as bytes, where a substring costs its own length."""
    return F.substring(level, i * WIDTH + 1, F.lit(WIDTH)).cast("string")


def _flanks(level: Column, i: Column) -> Column:
    """What stands in the run of place ``i`` on either side of it."""
    run = F.floor(i / FAN) * RUN
    return F.struct(
        F.substring(level, run + 1, i * WIDTH - run).cast("string").alias("left"),
        F.substring(level, (i + 1) * WIDTH + 1, run + RUN - (i + 1) * WIDTH)
        .cast("string")
        .alias("right"),
    )


def _blocks(nodes: DataFrame, more: Sequence[str] = ()) -> DataFrame:
    """Blocks of one round: both lower levels as strings, and the digest ``top`` above them.

    A tree of one node has no level above it, one of up to ``FAN`` nodes one, all others two.
    """
    rows = F.sort_array(F.collect_list(F.struct("pos", "digest", *more)))
    below = nodes.groupBy("tree", F.expr(f"pos div {BLOCK}").alias("block")).agg(
        rows.alias("rows"), F.max("n").alias("n")
    )
    level0 = F.array_join(F.transform("rows", lambda r: r["digest"]), "").cast("binary")
    runs = F.sequence(F.lit(0), F.expr(f"cast((size(rows) - 1) div {FAN} as int)"))

    def parent(j: Column) -> Column:
        return F.sha2(F.substring("level0", j * RUN + 1, F.lit(RUN)), 256)

    one = F.col("n") > 1
    return _stored(
        below.withColumn("level0", level0)
        .withColumn("level1", F.when(one, F.array_join(F.transform(runs, parent), "").cast("binary")))
        .withColumn(
            "top",
            F.when(~one, F.col("level0").cast("string"))
            .when(F.col("n") <= FAN, F.col("level1").cast("string"))
            .otherwise(F.sha2("level1", 256)),
        )
        # The digests stand in the level.
        .withColumn("rows", F.transform("rows", lambda r: F.struct(*[r[c] for c in ("pos", *more)]))),
        "merkle-blocks",
    )


def _rounds(nodes: DataFrame, more: Sequence[str] = ()) -> list[DataFrame]:
    """The blocks of every round, the lowest first. Each round has a ``BLOCK``th of the last."""
    rounds = [_blocks(nodes, more)]
    while True:
        above = rounds[-1].where(F.col("n") > BLOCK)
        if above.isEmpty():
            return rounds
        rounds.append(
            _blocks(above.select(
                "tree", F.col("block").alias("pos"), F.col("top").alias("digest"),
                F.expr(f"(n + {BLOCK - 1}) div {BLOCK}").alias("n"),
            ))
        )


def _nodes(blocks: DataFrame, carried: Sequence[str], more: Sequence[str] = ()) -> DataFrame:
    """The nodes of blocks with their whole ``path``, from the block's own path upwards."""
    i = F.col("_i")
    own = F.expr(NO_PATH)
    own = (
        F.when(F.col("n") <= 1, own)
        .when(F.col("n") <= FAN, F.array(_flanks(F.col("level0"), i)))
        .otherwise(F.array(
            _flanks(F.col("level0"), i), _flanks(F.col("level1"), F.floor(i / FAN).cast("int"))
        ))
    )
    return (
        blocks.select("*", F.posexplode("rows").alias("_i", "_node"))
        .select(
            "tree", (F.col("block") * BLOCK + i).alias("pos"),
            _digest_at(F.col("level0"), i).alias("digest"),
            F.concat(own, "path").alias("path"),
            *carried, *[F.col(f"_node.{c}").alias(c) for c in more],
        )
    )


def _descend(
    rounds: list[DataFrame], roots: DataFrame, carried: Sequence[str], more: Sequence[str] = ()
) -> DataFrame:
    """Paths from the trees' roots (tree, path, carried columns) down to the lowest nodes."""
    found: DataFrame | None = None
    for k in range(len(rounds) - 1, -1, -1):
        blocks = rounds[k]
        whole = blocks.where(F.col("n") <= BLOCK).join(roots, "tree")
        if found is not None:
            part = found.select("tree", F.col("pos").alias("block"), "path", *carried)
            part = blocks.where(F.col("n") > BLOCK).join(part, ["tree", "block"])
            whole = whole.unionByName(part)
        found = _nodes(whole, carried, more if k == 0 else ())
    return found


def folded(digest: Column, path: Column) -> Column:
    """The root that a digest and its siblings lead to."""
    return F.aggregate(path, digest, lambda d, p: F.sha2(F.concat(p["left"], d, p["right"]), 256))


def manifest(
    spark: SparkSession,
    docs: DataFrame,
    columns: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"),
    group: str = "source",
    order: str = "doc_id",
    altered: dict[str, Column] | None = None,
    where: Column | None = None,
) -> DataFrame:
    """Every row as a leaf with its proof, and the proof tried.

    ``altered`` replaces columns in rows that meet ``where``, as tampering would: ``folded_root``
    starts from the digest of the altered row there, from the leaf elsewhere, with the original
    siblings. Returns ``order``, leaf, subroot (of the group), root, path (siblings left and right
    of each level, upwards through the subroot), folded_root and verified.
    """
    values = [F.col(f"`{c}`") for c in columns]
    other = F.lit(None).cast("string")
    if altered is not None:
        changed = [altered.get(c, v) for c, v in zip(columns, values)]
        other = leaf_digest(changed)
        other = other if where is None else F.when(where, other)
    leaves = _stored(
        docs.select(
            # No group comes first: the hyphen stands before the equals sign.
            F.coalesce(F.concat(F.lit("="), F.col(f"`{group}`").cast("string")), F.lit("-")).alias("tree"),
            F.col(f"`{order}`").alias("key"), leaf_digest(values).alias("digest"),
            other.alias("altered"), F.monotonically_increasing_id().alias("_nth"),
        ),
        "merkle-leaves",
    )
    rounds = _rounds(positions(leaves, "tree", ["key", "digest", "_nth"]), ["key", "altered"])
    tops = [r.where(F.col("n") <= BLOCK).select("tree", "top") for r in rounds]
    subroots = tops[0]
    for more in tops[1:]:
        subroots = subroots.unionByName(more)
    crown = _rounds(
        positions(
            subroots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), F.col("top").alias("digest")),
            "tree", ["name"],
        ),
        ["name"],
    )
    top = crown[-1].where(F.col("n") <= BLOCK).select(
        "tree", F.expr(NO_PATH).alias("path"), F.col("top").alias("root")
    )
    roots = _descend(crown, top, ["root"], ["name"]).select(
        F.col("name").alias("tree"), "path", F.col("digest").alias("subroot"), "root"
    )
    found = _descend(rounds, _stored(roots, "merkle-roots"), ["subroot", "root"], ["key", "altered"])
    tried = folded(F.coalesce("altered", "digest"), F.col("path"))
    return found.select(
        F.col("key").alias(order), F.col("digest").alias("leaf"), "subroot", "root", "path",
        tried.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def proof_digest(path: Column) -> Column:
    """SHA-256 of all siblings of a path, level by level, left to right."""
    sides = F.transform(path, lambda p: F.concat(p["left"], p["right"]))
    return F.sha2(F.array_join(sides, ""), 256)
