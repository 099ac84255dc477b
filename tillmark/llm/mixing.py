"""Mixing sources to target weights through a tree of budgets.

A tree of key columns (say domain, language, source) shares out a budget of tokens. Every
node has a whole-number weight among its siblings. A node's capacity is what the documents
below it hold, times the epochs allowed. Each level shares its parent's budget in proportion
to the weights; a node that cannot use its part is filled up and what is left goes to its
siblings. As a parent never receives more than the capacity below it, a shortage reaches
the parent's siblings only after all siblings are full.

A leaf reads its documents in seeded order, one order per epoch: whole epochs first, then
the documents of the next epoch from the front until the budget is spent. The last document
is taken in part (``take_tokens``).

Only DataFrame functions are used. Leaves are cut by sums over ranges of the hashed order,
so a leaf holding a third of all rows is never sorted in one task: only the one range in
which its budget ends is.

Defined results:

* a NULL key is a node of its own, named ``NONE``; a NULL or empty text has no tokens;
* documents without tokens are taken like others, where the leaf's budget reaches them;
* rows with equal ids are separate rows, in the order of id and text digest; rows that are
  equal in both may stand for one another;
* an empty table, a budget of 0 and weights of 0 select nothing;
* other columns are kept; working columns carry the prefix ``_mix_``.

Whole-number arithmetic holds while budget times the weights of one level stays below 9e18.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillmark.llm.caches import tidy
from tillmark.llm.names import free
from tillmark.session import new_dir

NONE = "(none)"

# Hexadecimal digits of the order's hash that name a range: 4096 ranges for each leaf.
RANGE_DIGITS = 3

# A leaf meets its rows in so many parts, each on its own copy of the leaf's one row.
PARTS = 64

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def _weight(path: Sequence[Column], weights: Mapping[tuple[str, ...], int]) -> Column:
    """The weight given for a path of names, else the one for its last name alone, else 1."""
    out = F.lit(1)
    for names, w in sorted(weights.items(), key=lambda x: len(x[0])):
        if len(names) == len(path):
            same = F.lit(True)
            for c, n in zip(path, names):
                same = same & (c == n)
            out = F.when(same, F.lit(w)).otherwise(out)
    return out.cast("long")


def share(nodes: DataFrame, parent: Sequence[str], name: str) -> DataFrame:
    """Adds ``budget``: the parent's ``parent_budget`` shared among siblings by ``weight``.

    Siblings are filled in the order of capacity per weight, those that end up full first;
    the rest share what remains. Parts are whole numbers and add up to the budget.
    """
    by = [F.col(c) for c in parent] or [F.lit(0)]
    ratio = F.when(F.col("weight") > 0, F.col("capacity") / F.col("weight")).otherwise(F.lit(0.0))
    in_order = Window.partitionBy(*by).orderBy(ratio, name)
    all_of = Window.partitionBy(*by)
    room = F.when(F.col("weight") > 0, F.col("capacity")).otherwise(F.lit(0)).cast("long")
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    wide = lambda c: c.cast("decimal(38,0)")
    rest = F.col("parent_budget") - F.coalesce(F.sum("room").over(before), F.lit(0))
    weight_left = F.sum("weight").over(all_of) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    by_name = Window.partitionBy(*by).orderBy(name)
    upto = F.sum(F.when(F.col("full"), 0).otherwise(F.col("weight"))).over(
        by_name.rowsBetween(Window.unboundedPreceding, 0)
    )
    return (
        nodes.withColumn("room", room)
        .withColumns({"rest": rest, "weight_left": weight_left})
        .withColumn(
            "full",
            (F.col("weight") == 0)
            | (wide(F.col("room")) * wide(F.col("weight_left")) <= wide(F.col("rest")) * wide(F.col("weight"))),
        )
        .withColumns(
            {
                "open_budget": F.greatest(
                    F.lit(0),
                    F.col("parent_budget") - F.sum(F.when(F.col("full"), F.col("room")).otherwise(0)).over(all_of),
                ),
                "open_weight": F.sum(F.when(F.col("full"), 0).otherwise(F.col("weight"))).over(all_of),
                "upto": upto,
            }
        )
        .withColumn(
            "budget",
            F.when(F.col("full"), F.col("room")).otherwise(
                F.expr("open_budget * upto div open_weight - open_budget * (upto - weight) div open_weight")
            ),
        )
        .drop("room", "rest", "weight_left", "full", "open_budget", "open_weight", "upto")
    )


def budgets(
    leaves: DataFrame,
    keys: Sequence[str],
    weights: Mapping[tuple[str, ...], int],
    budget: Column,
    max_epochs: int,
) -> DataFrame:
    """The budget of every leaf. ``leaves`` holds the keys and ``available`` tokens.

    ``budget`` is an expression over ``total``, the tokens of all leaves.
    """
    level = leaves.groupBy(F.lit(0).alias("root")).agg(F.sum("available").alias("total"))
    level = level.select(
        F.least(budget.cast("long"), F.col("total") * max_epochs).alias("budget")
    )
    for depth, key in enumerate(keys):
        above = list(keys[:depth])
        nodes = leaves.groupBy(*above, key).agg(
            (F.sum("available") * max_epochs).cast("long").alias("capacity")
        )
        path = [F.col(c) for c in keys[: depth + 1]]
        nodes = nodes.withColumn("weight", _weight(path, weights))
        up = level.withColumnRenamed("budget", "parent_budget")
        if above:
            nodes = nodes.join(up, above)
        else:
            nodes = nodes.withColumn("parent_budget", up.scalar())
        level = share(nodes, above, key).select(*above, key, "budget")
    return level


def mix(
    docs: DataFrame,
    keys: Mapping[str, Column],
    weights: Mapping[tuple[str, ...], int],
    budget: Column,
    max_epochs: int = 1,
    seed: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokens: Column | None = None,
) -> DataFrame:
    """The rows of ``docs`` selected, one per epoch that reads them.

    ``keys`` names the levels of the tree, from the top. Added columns: ``_mix_epoch``,
    ``_mix_tokens`` and ``_mix_take``, the tokens of the document and those taken (with underscores
    added to a name that the table has itself).
    """
    spark = docs.sparkSession
    names = [f"_mix_{k}" for k in keys]
    count = word_count(F.col(f"`{text_col}`")) if tokens is None else tokens

    def order(epoch: Column) -> Column:
        ident = F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(NONE))
        return F.md5(F.concat_ws("|", F.lit(seed).cast("string"), epoch.cast("string"), ident))

    # Columns of the table that are called like working ones stand aside for the time.
    aside = {
        c: free(f"aside_{i}", docs.columns)
        for i, c in enumerate(docs.columns)
        if c.lower().startswith("_mix_")
    }
    keyed = docs.select(
        *[F.col(f"`{c}`").alias(aside.get(c, c)) for c in docs.columns],
        *[F.coalesce(c.cast("string"), F.lit(NONE)).alias(n) for n, c in zip(names, keys.values())],
        F.coalesce(count.cast("long"), F.lit(0).cast("long")).alias("_mix_tokens"),
    )
    id_col, text_col = aside.get(id_col, id_col), aside.get(text_col, text_col)

    sizes = new_dir(spark, "mix-sizes")
    keyed.select(*names, F.col(f"`{id_col}`"), "_mix_tokens").write.parquet(sizes)
    tidy(spark)
    sized = spark.read.parquet(sizes)
    leaves = sized.groupBy(*names).agg(F.sum("_mix_tokens").alias("available"))
    shared = (
        leaves.join(budgets(leaves, names, weights, budget, max_epochs), names)
        .where("budget > 0")
        .withColumn("_mix_full", F.expr("budget div available"))
        .withColumn("_mix_rest", F.expr("budget % available"))
        .select(*names, "_mix_full", "_mix_rest")
    )

    shares = F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1)))
    piece = F.pmod(F.xxhash64(F.col(f"`{id_col}`").cast("string")), F.lit(PARTS)).cast("int")
    joined = [*names, "_mix_part"]
    shared = shared.withColumn("_mix_part", shares)

    part = F.substring(order(F.col("_mix_full")), 1, RANGE_DIGITS).alias("_mix_range")
    upto = Window.partitionBy(*names).orderBy("_mix_range")
    cuts = (
        sized.withColumn("_mix_part", piece).join(shared, joined)
        .groupBy(*names, "_mix_full", "_mix_rest", part)
        .agg(F.sum("_mix_tokens").alias("held"))
        .withColumn("after", F.sum("held").over(upto))
        .where(F.col("after") >= F.col("_mix_rest"))
        .groupBy(*names, "_mix_full", "_mix_rest")
        .agg(F.min(F.struct("_mix_range", (F.col("after") - F.col("held")).alias("before"))).alias("cut"))
        .select(
            *names, "_mix_full", "_mix_rest",
            F.col("cut._mix_range").alias("_mix_cut"), F.col("cut.before").alias("_mix_before"),
        )
    )
    plan = new_dir(spark, "mix-plan")
    cuts.write.parquet(plan)
    tidy(spark)
    cuts = spark.read.parquet(plan).withColumn("_mix_part", shares)

    placed = keyed.withColumn("_mix_part", piece).join(cuts, joined).withColumn("_mix_order", order(F.col("_mix_full")))
    placed = placed.withColumn("_mix_at", F.substring("_mix_order", 1, RANGE_DIGITS))
    last = F.col("_mix_full") - F.when(F.col("_mix_at") < F.col("_mix_cut"), 0).otherwise(1)
    whole = placed.where(last >= 0).withColumns(
        {"_mix_epoch": F.explode(F.sequence(F.lit(0).cast("long"), last)), "_mix_take": F.col("_mix_tokens")}
    )
    text = F.md5(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")))
    front = (
        Window.partitionBy(*names)
        .orderBy("_mix_order", F.col(f"`{id_col}`"), text)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    ends = (
        placed.where(F.col("_mix_at") == F.col("_mix_cut"))
        .withColumn(
            "_mix_left",
            F.col("_mix_rest") - F.col("_mix_before")
            - F.coalesce(F.sum("_mix_tokens").over(front), F.lit(0).cast("long")),
        )
        .where(F.col("_mix_left") > 0)
        .withColumns(
            {"_mix_epoch": F.col("_mix_full"), "_mix_take": F.least("_mix_tokens", "_mix_left")}
        )
    )
    added = ["_mix_epoch", "_mix_tokens", "_mix_take"]
    columns = [F.col(f"`{aside.get(c, c)}`").alias(c) for c in docs.columns]
    columns += [F.col(c).alias(free(c, docs.columns)) for c in added]
    return whole.select(*columns).unionByName(ends.select(*columns))
