"""Nested projection of a build: products, agencies, subjects, and what the build says of itself.

Agencies are named by slugs. What hangs on a product (releases, documents,
change notices, datasets) is an array of structs in it; as JSON, empty parts are
left out at any depth. Left out altogether are addresses of requests,
provenance, exact copies of calendar rows, and how links were made.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import nested, pick
from ..session import delete
from ..sources import sinks
from . import build
from .warehouse import CANDIDATE

# Origins of subject claims in order of trust.
ORIGINS = ("workbook", "subject_page", "harvest")
Tables = dict[str, DataFrame]


# --- keys and picks -----------------------------------------------------------

def agency_slugs(agency: DataFrame) -> DataFrame:
    """The agencies with ``slug``; a slug that an earlier agency has gets the next free number.

    Only slugs that are alike but for numbers at their end can be in each
    other's way; those few are numbered one by one, all others are as they are.
    """
    rows = agency.withColumn("slug", X.slug(F.col("canonical_name"))).withColumn("_stem", F.regexp_replace("slug", r"(_\d+)+$", ""))
    alike = rows.groupBy("_stem").agg(F.count("*").alias("_n")).where("_n > 1")
    taken: set[str] = set()
    numbered = []
    for r in rows.join(alike, "_stem").orderBy("agency_id").select("agency_id", "slug").collect():
        value, n = r["slug"], 2
        while value in taken:
            value, n = f"{r['slug']}_{n}", n + 1
        taken.add(value)
        if value != r["slug"]:
            numbered.append((r["agency_id"], value))
    other = agency.sparkSession.createDataFrame(numbered, "agency_id bigint, _slug string")
    return rows.join(F.broadcast(other), "agency_id", "left").withColumn("slug", F.coalesce("_slug", "slug")).drop("_stem", "_slug")


def main_subject(subject_claims: DataFrame) -> DataFrame:
    """(product_code, subject_code, area): of the most trusted origin, then least label and code, so the choice never varies."""
    rank = F.lit(len(ORIGINS))
    for k, origin in enumerate(ORIGINS):
        rank = F.when(F.col("origin") == origin, k).otherwise(rank)
    best = F.min_by(F.struct("subject_code", F.trim("statistical_area_label").alias("area")), F.struct(rank, "subject_label", "subject_code", "statistical_area_label"))
    return subject_claims.where("subject_code IS NOT NULL").groupBy("product_code").agg(best.alias("b")).select("product_code", "b.*")


def _listed(df: DataFrame, key: str, order: list[Column], fields: dict[str, Column], name: str) -> DataFrame:
    """One row a key with its rows as an array of structs in order; nulls sort first, as ``order`` says otherwise."""
    item = F.struct(F.struct(*(c.alias(f"o{k}") for k, c in enumerate(order))).alias("o"), F.struct(*(c.alias(n) for n, c in fields.items())).alias("v"))
    return df.groupBy(key).agg(F.transform(F.sort_array(F.collect_list(item)), lambda x: x["v"]).alias(name))


def _latest_year(c: str) -> Column:
    """Sorts later years first and unknown ones last."""
    return F.coalesce(-X.leading_int(F.col(c)), F.lit(1))


def first_seen(df: DataFrame, key: str, item: str, value: str, at: list[str]) -> Column | DataFrame:
    """(key, map of item to its values): items in the order in which they were first seen, values in order.

    The least place goes with each item through the shuffles, so no order of
    rows has to survive them.
    """
    place = F.struct(*at)
    held = df.groupBy(key, item).agg(F.min(place).alias("_first"), F.transform(F.sort_array(F.collect_list(F.when(F.coalesce(F.col(value), F.lit("")) != "", F.struct(place.alias("p"), F.col(value).alias("v"))))), lambda x: x["v"]).alias("_values"))
    entries = F.transform(F.sort_array(F.collect_list(F.struct("_first", F.col(item).alias("k"), F.col("_values").alias("v")))), lambda x: F.struct(x["k"], x["v"]))
    return held.groupBy(key).agg(F.map_from_entries(entries).alias("items"))


# --- products ------------------------------------------------------------------

def publications(t: Tables, slugs: DataFrame) -> DataFrame:
    """Calendar rows of each product, equal rows once; ``by`` only where the publishers are not just the responsible agency."""
    s = slugs.select("agency_id", "slug")
    named = t["calendar_entry_publisher"].join(s, "agency_id", "left").withColumn("n", F.coalesce("slug", "name"))
    by = _listed(named, "entry_id", [F.col("ordinal")], {"n": F.col("n")}, "_by").withColumn("_by", F.transform("_by", lambda x: x["n"]))
    forms = _listed(t["calendar_entry_form"], "entry_id", [F.col("ordinal")], {"f": F.col("form")}, "_forms").withColumn("_forms", F.transform("_forms", lambda x: x["f"]))
    rows = t["calendar_entry"].where("occurrence = 1 AND product_code IS NOT NULL").join(by, "entry_id", "left").join(forms, "entry_id", "left")
    rows = rows.join(s.select(F.col("agency_id").alias("responsible_agency_id"), F.col("slug").alias("_own")), "responsible_agency_id", "left")
    product = t["product"].join(s, "agency_id", "left").select("product_code", F.col("slug").alias("_agency"))
    rows = rows.join(product, "product_code", "left")
    alone = F.array_distinct("_by") == F.array(F.coalesce("_own", "_agency"))
    fields = {"date": F.col("publish_date"), "period": F.col("reference_period"), "round": F.col("reporting_round"), "forms": F.col("_forms"), "by": F.when(~F.coalesce(alone, F.lit(False)), F.col("_by"))}
    return _listed(rows, "product_code", [F.col("publish_date"), F.col("entry_id")], fields, "publications")


def documents(t: Tables) -> DataFrame:
    """Documents of each product by kind, latest first, marked where all claims are candidates."""
    only = t["document_product_claim"].groupBy("product_code", "url").agg(F.bool_and(F.col("origin") == CANDIDATE).alias("c"))
    rows = only.join(t["document"], "url")
    fields = {"type": F.col("doc_type"), "year": F.col("year"), "url": F.col("url"), "candidate": F.when(F.col("c"), True)}
    return _listed(rows, "product_code", [F.col("doc_type"), _latest_year("year"), F.col("url")], fields, "documents")


def changes(t: Tables) -> DataFrame:
    sets = lambda table, c: t[table].groupBy("notice_id").agg(F.array_sort(F.collect_set(c)).alias(c + "s"))
    rows = t["change_notice"].where("product_code IS NOT NULL").join(t["changes_report"].select(F.col("url_sha").alias("report_sha"), "document_date_text"), "report_sha")
    related = sets("change_notice_related_product", "product_code").withColumnRenamed("product_codes", "related")
    rows = rows.join(sets("change_notice_kind", "kind"), "notice_id", "left").join(related, "notice_id", "left")
    fields = {"report": F.col("document_date_text"), "kinds": F.col("kinds"), "effective": F.coalesce("effective_date", "effective_date_text"), "timing": F.when(F.col("timing_claim") != "unclear", F.col("timing_claim")), "text": F.col("description"), "related": F.col("related")}
    return _listed(rows, "product_code", [F.col("document_date_text"), F.col("row_ordinal"), F.col("notice_id")], fields, "changes")


def datasets(t: Tables) -> DataFrame:
    rows = t["hvd_link"].where("product_code IS NOT NULL").join(t["hvd_group"].select("group_id", "dataset_label"), "group_id")
    return _listed(rows, "product_code", [F.col("group_id"), F.col("ordinal")], {"dataset": F.col("dataset_label"), "table": F.col("anchor_text"), "url": F.col("url")}, "hvd")


def product(t: Tables, slugs: DataFrame) -> DataFrame:
    book = t["official_product_row"].groupBy("product_code").agg(F.min_by(F.struct("purpose", F.col("statistics_area").alias("book_area")), "ordinal").alias("b")).select("product_code", "b.*")
    summary = t["product_page"].where("product_code IS NOT NULL").groupBy("product_code").agg(F.max_by("summary", "page_key").alias("summary"))
    # Pages at one address say it better than warnings do.
    alias_of = t["product_alias"].groupBy("product_code").agg(F.max_by("alias_of", F.struct(F.col("evidence") == "shared canonical_url", "alias_of")).alias("alias_of"))
    names = t["product_name_alias"].join(t["product"].select("product_code", F.col("name").alias("_own")), "product_code").withColumn("n", F.trim("name")).where("n <> '' AND (_own IS NULL OR n <> _own)")
    names = names.groupBy("product_code").agg(F.array_sort(F.collect_set("n")).alias("other_names"))
    rows = t["product"].join(slugs.select("agency_id", F.col("slug").alias("agency")), "agency_id", "left")
    for df in (main_subject(t["product_subject_claim"]), book, summary, alias_of, names, publications(t, slugs), documents(t), changes(t), datasets(t)):
        rows = rows.join(df, "product_code", "left")
    return rows.select(
        F.col("product_code").alias("code"), "name", "agency", F.col("subject_code").alias("subject"), F.coalesce(F.nullif("area", F.lit("")), "book_area").alias("area"), F.col("in_workbook").cast("int").alias("official"),
        "periodicity", "purpose", "summary", "alias_of", "other_names", "publications", "documents", "changes", "hvd")


# --- agencies, subjects, meta -------------------------------------------------------

def agency(t: Tables, slugs: DataFrame) -> DataFrame:
    website = t["registry_agency_field"].where("lower(label) = 'webbadress' AND value <> ''").groupBy("registry_row_id").agg(F.min_by("value", "ordinal").alias("website"))
    listed = t["official_agency"].where("agency_id IS NOT NULL").groupBy("agency_id").agg(F.max_by(F.struct("ordinal", "statistics_url"), "ordinal").alias("o")).select("agency_id", "o.*")
    subjects = first_seen(t["official_agency_subject"].withColumn("s", F.btrim("subject_name", F.lit(" :"))), "agency_ordinal", "s", "statistical_area", ["subject_ordinal", "area_ordinal"])
    european = t["european_agency"].where("agency_id IS NOT NULL").select("agency_id", F.lit(1).alias("_e")).distinct()
    own = t["harvest_document"].where("agency_id IS NOT NULL AND product_code IS NULL AND candidate_product_code IS NULL").select("agency_id", "canonical_url", "doc_type", "year", "title").distinct()
    own = _listed(own, "agency_id", [F.col("doc_type"), _latest_year("year"), F.col("canonical_url"), F.col("title")], {"type": F.col("doc_type"), "year": F.col("year"), "url": F.col("canonical_url"), "title": F.col("title")}, "documents")
    rows = slugs.join(website, "registry_row_id", "left").join(listed, "agency_id", "left").join(subjects, F.col("ordinal") == F.col("agency_ordinal"), "left").join(european, "agency_id", "left").join(own, "agency_id", "left")
    return rows.select("slug", F.col("canonical_name").alias("name"), F.col("registry_org_nr").alias("org_nr"), "website", "statistics_url", F.col("ordinal").isNotNull().cast("int").alias("official"), F.coalesce("_e", F.lit(0)).alias("european"), F.col("items").alias("subjects"), "documents")


def subject(t: Tables) -> DataFrame:
    areas = _listed(t["statistical_area"], "subject_code", [F.col("ordinal")], {"l": F.col("label")}, "a").withColumn("areas", F.transform("a", lambda x: x["l"]))
    return t["subject"].join(areas, "subject_code", "left").select(F.col("subject_code").alias("code"), F.col("title").alias("name"), "areas")


def meta(t: Tables, built_at: str | None) -> DataFrame:
    """(key, value): JSON of when it was built, from what, and which sources and keys were not fresh."""
    state = t["source_status"].where("status <> 'fresh'").agg(F.transform(F.sort_array(F.collect_list(F.struct("family", "source", "key", "status"))), lambda s: F.concat(s["family"], F.lit("/"), s["source"], F.lit("/"), s["key"], F.lit(": "), s["status"])).alias("v"))
    as_json = lambda c: F.coalesce(F.substring(F.to_json(F.array(c)), F.lit(2), F.length(F.to_json(F.array(c))) - 2), F.lit("null"))
    said = t["build_info"].where(F.col("key").isin("git_revision", "calendar_last_completed_run", "dokumentation_as_of")).select("key", F.col("value").alias("v"))
    keys = t["build_info"].sparkSession.createDataFrame([("built_at", built_at), *((k, None) for k in ("git_revision", "calendar_last_completed_run", "dokumentation_as_of"))], "key string, own string")
    rows = keys.join(said, "key", "left").select("key", F.when(F.coalesce("own", "v").isNull(), "null").otherwise(as_json(F.coalesce("own", "v"))).alias("value"))
    return rows.unionByName(state.select(F.lit("not_fresh").alias("key"), F.to_json("v").alias("value")))


def project(t: Tables, built_at: str | None = None) -> Tables:
    """The four tables of a build, nested."""
    slugs = agency_slugs(t["agency"])
    return {"product": product(t, slugs), "agency": agency(t, slugs), "subject": subject(t), "meta": meta(t, built_at)}


def as_json(df: DataFrame) -> DataFrame:
    """Nested columns as JSON text without empty parts, NULL where nothing is left."""
    return df.select(*(F.to_json(nested.pruned(F.col(f.name), f.dataType)).alias(f.name) if f.dataType.simpleString().startswith(("array", "map", "struct")) else F.col(f.name) for f in df.schema.fields))


def build_compact(spark: SparkSession, data: str, root: str, sources_file: str | None = None, built_at: str | None = None, revision: str | None = None) -> dict[str, int]:
    """Builds ``data`` aside and publishes its projection alone, with JSON columns."""
    whole = f"{root}.whole-{uuid.uuid4().hex}"
    try:
        build.build(spark, data, whole, sources_file, built_at, revision)
        return sinks.publish_tables(spark, {n: as_json(df) for n, df in project(build.tables(spark, whole), built_at).items()}, root)
    finally:
        delete(spark, whole)
