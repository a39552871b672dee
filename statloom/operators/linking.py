"""Soft links: a key links only if it is found, and found once; the rest is counted."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .pick import top1_or_null_on_tie


def resolve_soft(fact: DataFrame, key: str, dim: DataFrame, dim_key: str, dim_id: str) -> DataFrame:
    """The fact with ``linked`` (NULL unless exactly one id matches) and ``matches``.

    Names are resolved once per distinct value: the dimension is grouped by
    its key before the join, so no match multiplies fact rows.
    """
    known = dim.where(F.col(dim_key).isNotNull()).select(F.col(dim_key).alias("_k"), F.col(dim_id).alias("_i")).dropDuplicates()
    known = known.groupBy("_k").agg(F.count("*").alias("_n"), F.min("_i").alias("_i"))
    joined = fact.join(known, fact[key] == known["_k"], "left")
    return joined.withColumn("matches", F.coalesce("_n", F.lit(0))).withColumn("linked", F.when(F.col("_n") == 1, F.col("_i"))).drop("_k", "_n", "_i")


def issues(resolved: DataFrame, table: str, column: str, unknown: str, ambiguous: str) -> DataFrame:
    """Unlinked raw values of a resolved fact with the number of their rows."""
    bad = resolved.where(F.col(column).isNotNull() & F.col("linked").isNull())
    kind = F.when(F.col("matches") == 0, unknown).otherwise(ambiguous)
    rows = bad.groupBy(F.col(column).cast("string").alias("raw_value"), kind.alias("issue")).agg(F.count("*").alias("row_count"))
    return rows.select(F.lit(table).alias("table_name"), F.lit(column).alias("column_name"), "issue", "raw_value", "row_count")


def unique_match(left: DataFrame, right: DataFrame, key: str, right_id: str) -> DataFrame:
    """Left rows with the right id where the key has just one right row, and what went wrong elsewhere."""
    once = right.groupBy(key).agg(F.count("*").alias("n"), F.min(right_id).alias(right_id))
    state = F.when(F.coalesce("n", F.lit(0)) == 0, "no_match").when(F.col("n") > 1, "ambiguous").otherwise("matched")
    return left.join(once, key, "left").select(left["*"], F.when(F.col("n") == 1, F.col(right_id)).alias(right_id), state.alias("match_state"))


def overlap_match(items: DataFrame, refs: DataFrame, block: list[str], tokens: str, item_id: str, ref_id: str, threshold: float = 0.5, folder: str | None = None) -> DataFrame:
    """Best reference per item by shared tokens over the reference's tokens, NULL on a tie.

    The items' tokens are made once and written, to ``folder`` if there is one,
    as pairs, counts and verification all need them.

    An item that shares enough tokens of a reference shares one of its rarest
    ones (all but as many as may be missing, and one), so pairs are made by
    those, and counted on whole token lists after.
    """
    from ..session import shared_dir

    made = items.select(*block, item_id, F.array_distinct(tokens).alias("_all"))
    path = f"{folder}/tokens-{uuid.uuid4().hex}" if folder else shared_dir(items.sparkSession)
    made.write.parquet(path)
    i = items.sparkSession.read.schema(made.schema).parquet(path)
    r = refs.select(*block, ref_id, F.array_distinct(tokens).alias("_ref")).withColumn("_size", F.size("_ref"))
    held = i.select(*block, item_id, F.explode("_all").alias("_t"))
    df = held.groupBy(*block, "_t").agg(F.count("*").alias("_df"))
    each = r.select(*block, ref_id, "_size", F.explode("_ref").alias("_t")).join(df, [*block, "_t"])
    # Tokens that no item has are the rarest of all: they use up places without making pairs.
    along = Window.partitionBy(*block, ref_id)
    each = each.withColumn("_place", F.col("_size") - F.count("*").over(along) + F.row_number().over(along.orderBy("_df", "_t")))
    rare = each.where(F.col("_place") <= F.col("_size") - F.ceil(F.col("_size") * threshold) + 1)
    pairs = held.join(rare.select(*block, "_t", ref_id), [*block, "_t"]).select(*block, item_id, ref_id).distinct()
    scored = pairs.join(i, [*block, item_id]).join(r, [*block, ref_id])
    scored = scored.withColumn("overlap", F.size(F.array_intersect("_all", "_ref")) / F.col("_size")).where(F.col("overlap") >= threshold)
    best = top1_or_null_on_tie(scored, [item_id], [F.desc("overlap"), F.desc("_size")], ref_id)
    return i.select(item_id).join(best, item_id, "left")


def alias_pairs(df: DataFrame, key: list[str], code: str, known: DataFrame | None = None) -> DataFrame:
    """(code, alias_of): equal keys, larger codes alias smaller ones, pairs known in either direction left out."""
    a = df.select(*key, F.col(code).alias("alias_of"))
    b = df.select(*key, F.col(code).alias("code"))
    pairs = a.join(b, key).where("alias_of < code").select("code", "alias_of").dropDuplicates()
    if known is not None:
        turned = known.select(F.col("alias_of").alias("code"), F.col("code").alias("alias_of"))
        pairs = pairs.join(known, ["code", "alias_of"], "left_anti").join(turned, ["code", "alias_of"], "left_anti")
    return pairs


def unknown_codes(used: DataFrame, known: list[DataFrame], code: str) -> DataFrame:
    """Non-null codes that no known set has, with their row counts."""
    out = used.where(F.col(code).isNotNull())
    for k in known:
        out = out.join(k.select(code), code, "left_anti")
    return out.groupBy(code).agg(F.count("*").alias("row_count"))


def code_union(parts: dict[str, DataFrame], code: str) -> DataFrame:
    """Distinct codes of several sources with a membership flag for each."""
    rows = None
    for name, df in parts.items():
        part = df.where(F.col(code).isNotNull()).select(code, F.lit(name).alias("_s"))
        rows = part if rows is None else rows.unionByName(part)
    flags: list[Column] = [F.max(F.col("_s") == name).alias(f"in_{name}") for name in parts]
    return rows.groupBy(code).agg(*flags)


def alias_lookup(df: DataFrame, keys: list[str], value: str, order: list[str]) -> DataFrame:
    """(alias, value): every key column names the value; the first row that registers an alias keeps it.

    Key columns count in the order given, rows in ``order``.
    """
    rows = None
    for rank, key in enumerate(keys):
        part = df.where(F.col(key).isNotNull()).select(F.col(key).alias("alias"), F.struct(*(F.col(c).alias(f"o{k}") for k, c in enumerate(order)), F.lit(rank).alias("rank")).alias("_o"), F.col(value).alias("value"))
        rows = part if rows is None else rows.unionByName(part)
    return rows.groupBy("alias").agg(F.min_by("value", "_o").alias(value))


def recover_from_index(index: DataFrame, covered: DataFrame, url: str, key: str, order: list[str]) -> DataFrame:
    """Index rows whose address nothing covers, one for each key: the first in index order."""
    left = index.join(covered.select(url).dropDuplicates(), url, "left_anti")
    rest = [c for c in left.columns if c != key]
    packed = F.min_by(F.struct(*rest), F.struct(*order)).alias("_r")
    return left.groupBy(key).agg(packed).select(key, *(F.col(f"_r.`{c}`").alias(c) for c in rest)).select(*index.columns)
