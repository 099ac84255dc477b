"""The user directory: search pages, lookups, and change sets applied in bulk."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillmark.fixed_values import (
    PAGE_SIZE,
    REJECT_MISMATCH,
    REJECT_MISSING,
    REJECT_TAKEN,
)
from tillmark.functions import matches, page_count
from tillmark.schemas import REFERENCES
from tillmark.sources.tables import Tables

# What a directory listing shows. The password is never among it.
PROFILE = [
    "id", "username", "nickname", "sex", "age", "phone", "email", "birthday", "card",
    "content", "remarks", "role",
]
# Ids are counted in ranges of numbers that agree up to so many last bits, and these within
# wider ones: 18 bits from one to the next, so no range has more than 262,144 below it.
PAGE_RANGES = (10, 28, 46)
EDITABLE = ["username", "nickname", "sex", "age", "phone", "email"]


def _profile(users: DataFrame) -> DataFrame:
    return users.select(*[c for c in PROFILE if c in users.columns])


def find_users(
    users: DataFrame, role: str = "user", username: str | None = None, literal: bool = False
) -> DataFrame:
    found = users.where(F.col("role") == role)
    test = matches("username", username, literal)
    return found if test is None else found.where(test)


def user_search_page(
    users: DataFrame,
    role: str = "user",
    username: str | None = None,
    page: int = 1,
    limit: int = PAGE_SIZE,
    literal: bool = False,
) -> DataFrame:
    """One page of users, newest id first, with the total and page count on every row.

    A directory of ranks finds where the page starts: users are counted per range of ids, ranges
    within wider ranges, and the widest are added up first, then those within the one the page
    starts in. No task orders more than the ranges of one wider range, whatever the table has,
    and nothing runs before the page is asked for. ``user_search_after`` needs no counts and is
    the way to leaf through.
    """
    found = find_users(users, role, username, literal)
    total = found.agg(F.count(F.lit(1))).scalar()
    before = (page - 1) * limit
    rows = _profile(found)
    if before:
        narrow = PAGE_RANGES[0]
        reach = F.shiftright(F.col("id").cast("long"), narrow)
        start = _range_of(found.select(reach.alias("node")), before)
        place = F.row_number().over(W.orderBy(F.desc("id"))) + start["above"]
        rows = (
            rows.where(reach <= start["node"])
            .orderBy(F.desc("id"))
            .limit((1 << narrow) + limit)
            .withColumn("_place", place)
            .where(F.col("_place") > before)
            .drop("_place")
        )
    return (
        rows.orderBy(F.desc("id"))
        .limit(limit)
        .withColumn("total", total)
        .withColumn("pages", page_count("total", limit))
    )


def _range_of(nodes: DataFrame, before: int) -> Column:
    """The narrowest range that holds the row after ``before`` others, and how many lie above it.

    A struct of NULLs in effect, so that nothing is selected, where there are fewer rows.
    """
    counts = [nodes.groupBy("node").agg(F.count(F.lit(1)).alias("n"))]
    for low, high in zip(PAGE_RANGES, PAGE_RANGES[1:]):
        wider = F.shiftright("node", high - low).alias("node")
        counts.append(counts[-1].groupBy(wider).agg(F.sum("n").alias("n")))
    found = None
    upto = W.orderBy(F.desc("node")).rowsBetween(W.unboundedPreceding, -1)
    for i in reversed(range(len(PAGE_RANGES))):
        level, above = counts[i], F.lit(0)
        if found is not None:
            bits = PAGE_RANGES[i + 1] - PAGE_RANGES[i]
            level, above = level.where(F.shiftright("node", bits) == found["node"]), found["above"]
        at = F.col("above")
        found = (
            level.withColumn("above", F.coalesce(F.sum("n").over(upto), F.lit(0)) + above)
            .where((at <= before) & (at + F.col("n") > before))
            .agg(F.max(F.struct("node", "above")))
            .scalar()
        )
    return found


def user_search_after(
    users: DataFrame,
    last_id: int | None,
    role: str = "user",
    username: str | None = None,
    limit: int = PAGE_SIZE,
    literal: bool = False,
) -> DataFrame:
    """The page that follows ``last_id``; its cost does not grow with the page number."""
    found = find_users(users, role, username, literal)
    if last_id is not None:
        found = found.where(F.col("id") < last_id)
    return _profile(found).orderBy(F.desc("id")).limit(limit)


def user_by_id(users: DataFrame, user_id: int) -> DataFrame:
    return _profile(users.where(F.col("id") == user_id))


def user_by_name(users: DataFrame, username: str) -> DataFrame:
    return _profile(users.where(F.col("username") == username))


def _named(df: DataFrame, ignore_case: bool) -> DataFrame:
    """Rows with a name, the name they are compared by in ``username``."""
    name = F.lower("username") if ignore_case else F.col("username")
    return df.withColumn("username", name).where(F.col("username").isNotNull())


def name_conflicts(users: DataFrame, batch: DataFrame, ignore_case: bool = False) -> DataFrame:
    """Names of a batch that are taken already or occur in it more than once.

    With ``ignore_case`` names are compared, and shown, in lower case. Missing names are in
    nobody's way.
    """
    names = _named(batch, ignore_case).groupBy("username").agg(F.count(F.lit(1)).alias("in_batch"))
    taken = (
        _named(users.select("username"), ignore_case)
        .join(names.select("username"), "username", "left_semi")
        .distinct()
        .withColumn("is_taken", F.lit(True))
    )
    return (
        names.join(taken, "username", "left")
        .withColumn("is_taken", F.coalesce("is_taken", F.lit(False)))
        .where(F.col("is_taken") | (F.col("in_batch") > 1))
    )


def registration_check(
    users: DataFrame, requests: DataFrame, ignore_case: bool = False
) -> DataFrame:
    """Each request with the first reason to turn it down, or NULL.

    Requests carry username, password and confirm_password. With ``ignore_case`` a name that
    differs from a taken one by case alone is taken too.
    """
    key = F.lower("username") if ignore_case else F.col("username")
    fields = ("username", "password", "confirm_password")
    missing = reduce(
        lambda a, b: a | b, [F.col(c).isNull() | (F.col(c) == "") for c in fields]
    )
    asked = requests.select(key.alias("_key")).where(F.col("_key").isNotNull()).distinct()
    taken = (
        users.select(key.alias("_key"))
        .join(asked, "_key", "left_semi")
        .distinct()
        .withColumn("_taken", F.lit(True))
    )
    return (
        requests.withColumn("_key", key)
        .join(taken, "_key", "left")
        .drop("_key")
        .withColumn(
            "reject_reason",
            F.when(missing, REJECT_MISSING)
            .when(F.col("password") != F.col("confirm_password"), REJECT_MISMATCH)
            .when(F.col("_taken"), REJECT_TAKEN),
        )
        .drop("_taken")
    )


def apply_inserts(
    users: DataFrame,
    batch: DataFrame,
    role: str = "user",
    check_names: bool = True,
    ignore_case: bool = False,
) -> DataFrame:
    """Users plus the new ones of a batch, under a fixed role. Ids come with the batch.

    With ``check_names`` a taken name is skipped and, of equal names, the lowest id wins; with
    ``ignore_case`` case makes no difference to that. A user without a name is always added.
    """
    new = batch.withColumn("role", F.lit(role))
    if check_names:
        named = _named(batch, ignore_case)
        first = named.groupBy("username").agg(F.min("id").alias("id"))
        taken = _named(users.select("username"), ignore_case)
        free = first.join(taken, "username", "left_anti").select(
            F.col("username").alias("_key"), "id"
        )
        key = F.lower("username") if ignore_case else F.col("username")
        unnamed = new.where(F.col("username").isNull())
        new = new.withColumn("_key", key).join(free, ["_key", "id"], "left_semi").drop("_key")
        new = new.unionByName(unnamed)
    return users.unionByName(new, allowMissingColumns=True).select(*users.columns)


def apply_updates(users: DataFrame, changes: DataFrame, at: str | None = None) -> DataFrame:
    """Users with the editable columns of matching change rows written over them.

    A change row sets all editable columns it carries, to NULL as well. Other columns,
    the password among them, are ignored. Of several change rows for one id the one with the
    latest ``at`` counts, of equally late ones (or without ``at``) the one with the largest
    values.
    """
    columns = [c for c in EDITABLE if c in changes.columns and c in users.columns]
    order = [at] if at else []
    new = (
        changes.where(F.col("id").isNotNull())
        .groupBy("id")
        .agg(F.max(F.struct(*order, F.struct(*columns).alias("_row"))).alias("_last"))
        .select("id", F.col("_last._row").alias("_new"))
    )
    hit = F.col("_new").isNotNull()
    return users.join(new, "id", "left").select(
        *[
            F.when(hit, F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c) if c in columns else c
            for c in users.columns
        ]
    )


def apply_deletes(users: DataFrame, ids: DataFrame) -> DataFrame:
    return users.join(ids.select("id"), "id", "left_anti")


def cascade_delete(tables: Tables, table: str, ids: DataFrame) -> Tables:
    """All tables after deleting rows of one, with every reference followed.

    Rows that must go with their parent are removed, and so are rows hanging on them;
    other references to a removed row are blanked. Tables nothing refers to are left
    as they are.
    """
    gone = {table: ids.select("id")}
    out = dict(tables)
    out[table] = out[table].join(gone[table], "id", "left_anti")
    for child in _by_depth(table):
        if child not in out:
            continue
        links = [
            r for r in REFERENCES
            if r.child == child and r.parent in gone and r.column in tables[child].columns
        ]
        cascades = [r for r in links if r.on_delete == "cascade"]
        kept = tables[child]
        for link in cascades:
            kept = kept.join(_as(gone[link.parent], link.column), link.column, "left_anti")
        if cascades and any(r.parent == child and r.child in out for r in REFERENCES):
            lost = [
                tables[child]
                .join(_as(gone[r.parent], r.column), r.column, "left_semi")
                .select("id")
                for r in cascades
            ]
            gone[child] = reduce(DataFrame.unionByName, lost)
        columns = tables[child].columns
        for link in links:
            if link.on_delete == "set null":
                kept = _blanked(kept, link.column, gone[link.parent])
        out[child] = kept.select(*columns)
    return out


def _as(ids: DataFrame, column: str) -> DataFrame:
    return ids.select(F.col("id").alias(column))


def _blanked(df: DataFrame, column: str, gone: DataFrame) -> DataFrame:
    """Rows without a reference stay out of the join, where they would share one key."""
    lost = gone.distinct().select(F.col("id").alias(column), F.lit(True).alias("_lost"))
    linked = df.where(F.col(column).isNotNull()).join(lost, column, "left").withColumn(
        column, F.when(F.col("_lost").isNull(), F.col(column))
    )
    return linked.drop("_lost").unionByName(df.where(F.col(column).isNull()))


def _by_depth(table: str) -> list[str]:
    """Tables below ``table``, each after every table it refers to."""
    below: set[str] = set()
    frontier = {table}
    while frontier:
        frontier = {r.child for r in REFERENCES if r.parent in frontier} - below
        below |= frontier
    ordered: list[str] = []
    while len(ordered) < len(below):
        for name in sorted(below - set(ordered)):
            parents = {r.parent for r in REFERENCES if r.child == name} & below
            if parents <= set(ordered):
                ordered.append(name)
    return ordered
