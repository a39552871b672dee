"""Documentation harvest: three sources to one document table and a rollup per product."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import schemas
from ..functions import text as X
from ..operators import linking, pick
from ..sources import html

# Kinds that are kept from the school source.
SCHOOL_KINDS = ("kvalitetsdeklaration", "statistikens framställning", "beskrivning av statistiken")
SCHOOL_AGENCY = "Statens skolverk"
# Document kinds of the rollup and their column prefixes.
ROLLUP = (("kvalitetsdeklaration", "kd"), ("beskrivning av statistiken", "bas"), ("statistikens framställning", "staf"), ("scbdok", "scbdok"), ("metaplus", "metaplus"))


def fragment_rows(fragments: DataFrame) -> DataFrame:
    """Index links with code, year and kind; a block's only code goes to its files without one."""
    rows = html.explode_rows(fragments.select("amnesomrade", F.col("url").alias("source_url"), "fetched", "provenance", "html"), "html", html.subject_index, html.INDEX)
    u, label = F.col("url"), F.col("label")
    rows = rows.withColumns({"product_code": X.find_code(u, label), "year": X.find_year(u, label), "doc_type": X.kind(u, label, F.col("heading")), "filetype": X.file_type(u)})
    rows = rows.withColumn("_own", F.col("product_code").isNotNull())
    filled = pick.inherit_unique(rows, ["amnesomrade", "area", "product"], "product_code")
    return filled.withColumn("product_match", F.when(F.col("_own"), "code").when(F.col("product_code").isNotNull(), "block").otherwise("")).drop("_own")


def school_rows(calls: DataFrame) -> DataFrame:
    """Documents of the school source's list calls."""
    rows = calls.where("endpoint = 'dokument' AND body IS NOT NULL").select("params", "fetched", F.col("url").alias("source_url"), "provenance", F.explode("body").alias("d"))
    url = F.when(F.col("d.url").startswith("//"), F.concat(F.lit("https:"), F.col("d.url"))).otherwise(F.coalesce("d.url", F.lit("")))
    title, blank = X.clean(F.coalesce("d.titel", F.lit(""))), F.lit("")
    rows = rows.select(*(F.col("params")[k].alias(n) for k, n in (("pVerkform", "verkform"), ("pOmrade", "omrade"), ("pLasar", "lasar"))), F.lower(F.coalesce("d.filetype", blank)).alias("filetype"), title.alias("title"), url.alias("url"), "source_url", "fetched", "provenance")
    return rows.withColumns({"doc_type": X.kind(blank, F.col("title")), "year": X.find_year(blank, F.col("title"), F.col("lasar"))})


def crawled_rows(pages: DataFrame, sources: DataFrame) -> DataFrame:
    """Document links of crawled pages, each (page, link, text) once. ``_file`` of the pages is the agency's slug."""
    rows = pages.select(F.col("_file").alias("name"), F.col("url").alias("source_url"), F.coalesce("title", F.lit("")).alias("source_title"), "fetched", "provenance", F.explode("links").alias("l"))
    rows = rows.select("name", "source_url", "source_title", "fetched", "provenance", F.col("l.href").alias("href"), F.col("l.text").alias("raw")).where(F.col("href").rlike(X.DOCUMENT_FILE))
    rows = rows.withColumn("text", X.clean(F.coalesce("raw", F.lit("")))).drop("raw")
    rows = rows.withColumn("doc_type", X.kind(F.col("href"), F.col("text"))).where("doc_type IS NOT NULL").dropDuplicates(["name", "source_url", "href", "text"])
    h, t = F.col("href"), F.col("text")
    rows = rows.withColumns({"product_code": X.find_code(h, t), "year": X.find_year(h, t), "filetype": X.file_type(h)})
    known = sources.select("name", F.col("agency").alias("_a")).dropDuplicates(["name"])
    return rows.join(F.broadcast(known), "name", "left").withColumn("agency", F.coalesce("_a", "name")).drop("_a")


def name_matches(items: DataFrame, products: DataFrame, item_id: str, agency: str, words: Column) -> DataFrame:
    """(item_id, matched): the agency's product that shares most name stems, NULL if none or a tie."""
    refs = products.select(F.col("agency").alias("_agency"), F.col("product_code").alias("matched"), X.tokens(F.col("name")).alias("_t"))
    rows = items.select(item_id, F.col(agency).alias("_agency"), words.alias("_t"))
    return linking.overlap_match(rows, refs, ["_agency"], "_t", item_id, "matched")


def _all_tokens(*texts: Column) -> Column:
    return F.array_distinct(F.flatten(F.array(*(X.tokens(t) for t in texts))))


def documents(fragments: DataFrame, calls: DataFrame, pages: DataFrame, sources: DataFrame, products: DataFrame, state: dict | None = None) -> DataFrame:
    """The document table: all sources united, candidates split off, identities and names added."""
    names = products.select("product_code", "name", "agency")
    text = lambda: F.lit(None).cast("string")

    scb = fragment_rows(fragments)
    label = F.concat(F.col("product"), F.lit(" – "), F.when(F.col("sub") != "", F.concat("sub", F.lit(" "))).otherwise(""), F.col("label"))
    scb = scb.join(names.select("product_code", "agency"), "product_code", "left").select(
        F.lit("scb").alias("source"), "agency", "product_code", "product_match", "doc_type", "year", label.alias("title"), "url", "filetype", "source_url", "heading",
        F.nullif("amnesomrade", F.lit("")).alias("subject_area"), F.nullif("area", F.lit("")).alias("statistics_area"), "provenance", F.col("ordinal").alias("_pos"))

    school = school_rows(calls).where(F.col("doc_type").isin(*SCHOOL_KINDS)).withColumn("agency", F.lit(SCHOOL_AGENCY))
    # A key of the content, as the rows are made again for the join: equal rows match the same.
    school = school.withColumn("_id", F.xxhash64("title", "verkform", "omrade", "lasar", "url", "source_url"))
    found = name_matches(school.dropDuplicates(["_id"]), products, "_id", "agency", _all_tokens(F.col("title"), F.col("verkform"), F.col("omrade")))
    school = school.join(found, "_id", "left").select(
        F.lit("siris").alias("source"), "agency", F.col("matched").alias("product_code"), F.when(F.col("matched").isNotNull(), "name").otherwise("").alias("product_match"), "doc_type", "year", "title", "url", "filetype", "source_url",
        F.concat_ws(" / ", "verkform", "omrade", "lasar").alias("heading"), text().alias("subject_area"), text().alias("statistics_area"), "provenance", F.col("_id").alias("_pos"))

    sam = crawled_rows(pages, sources).withColumn("_id", F.xxhash64("name", "source_url", "href", "text"))
    on_page = sam.groupBy("source_url").agg(F.when(F.min("product_code") == F.max("product_code"), F.min("product_code")).alias("_code"), F.max("product_code").isNull().alias("_none"), F.min("agency").alias("agency"), F.min("source_title").alias("source_title"))
    titled = name_matches(on_page.where("_none"), products, "source_url", "agency", X.tokens(F.col("source_title"))).withColumnRenamed("matched", "_title_code")
    page_code = on_page.join(titled, "source_url", "left").select("source_url", F.coalesce("_code", "_title_code").alias("page_code"))
    found = name_matches(sam.where("product_code IS NULL"), products, "_id", "agency", _all_tokens(F.col("text"), F.col("source_title"), X.url_file(F.col("href"))))
    sam = sam.join(found, "_id", "left").join(page_code, "source_url", "left")
    code = F.coalesce("product_code", "matched", "page_code")
    how = F.when(F.col("product_code").isNotNull(), "code").when(F.col("matched").isNotNull(), "name").when(F.col("page_code").isNotNull(), "page").otherwise("")
    sam = sam.select(
        F.concat(F.lit("sam/"), F.col("name")).alias("source"), "agency", code.alias("product_code"), how.alias("product_match"), "doc_type", "year", F.col("text").alias("title"), F.col("href").alias("url"), "filetype", "source_url",
        F.col("source_title").alias("heading"), text().alias("subject_area"), text().alias("statistics_area"), "provenance", F.col("_id").alias("_pos"))

    rows = scb.unionByName(school).unionByName(sam)
    inferred = F.col("product_match").isin("name", "page")
    rows = rows.withColumn("candidate_product_code", F.when(inferred, F.col("product_code"))).withColumn("product_code", F.when(~inferred, F.col("product_code")))
    rows = rows.withColumn("review_required", F.col("candidate_product_code").isNotNull() | F.col("doc_type").isNull())
    rows = rows.withColumn("source_status", X.source_status(F.col("source"), state or {}))
    identity = ["source", "source_url", "url", "title", "heading"]
    rows = pick.occurrence(rows, identity, [F.asc("_pos")], "_occurrence", 0)
    rows = rows.withColumn("document_id", X.row_key([*identity, "_occurrence"])).join(names.select("product_code", F.col("name").alias("product_name")), "product_code", "left")
    return rows.select(*schemas.names(schemas.DOCUMENT))


def export_order() -> list[Column]:
    return [F.coalesce("product_code", F.lit("~")), F.coalesce("doc_type", F.lit("")), F.coalesce("year", F.lit("")), F.col("url"), F.col("document_id")]


def rollup(docs: DataFrame, products: DataFrame, as_of: Column) -> DataFrame:
    """One row per product of the calendar or of a document, with counts and the newest document by kind."""
    aggs = [F.count("*").alias("documents"), F.array_sort(F.collect_set(F.split("source", "/")[0])).alias("sources")]
    for kind, p in ROLLUP:
        here = F.col("doc_type") == kind
        newest = F.max(F.when(here, F.struct(F.coalesce("year", F.lit("")).alias("y"), "url", "year")))
        aggs += [F.count_if(here).alias(f"{p}_count"), newest["year"].alias(f"{p}_latest_year"), newest["url"].alias(f"{p}_latest_url")]
    by_code = docs.where("product_code IS NOT NULL").groupBy("product_code").agg(*aggs)
    p = products.select("product_code", F.col("name").alias("product_name"), F.col("agency").alias("responsible_agency"), F.col("last").alias("last_publish_date"), F.lit(True).alias("in_calendar"))
    rows = p.join(by_code, "product_code", "full_outer")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    return rows.select(
        "product_code", "product_name", "responsible_agency", F.coalesce("in_calendar", F.lit(False)).alias("in_calendar"), "last_publish_date", X.is_active(F.try_to_date(F.col("last_publish_date"), "yyyy-MM-dd"), as_of).alias("active"),
        zero("documents"), F.coalesce("sources", F.array().cast("array<string>")).alias("sources"),
        *(c for _, k in ROLLUP for c in (zero(f"{k}_count"), F.col(f"{k}_latest_year"), F.col(f"{k}_latest_url"))))


def metrics(docs: DataFrame, products: DataFrame) -> DataFrame:
    """The figures of a parse manifest as one row."""
    return docs.agg(F.count("*").alias("documents"), F.count_if("review_required").alias("review_candidates"), *(F.count_if(F.col("source").startswith(s)).alias(s) for s in ("scb", "siris", "sam"))).crossJoin(products.agg(F.count("*").alias("products")))


def numbered(rows: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Surrogate numbers in load order, for dimensions small enough to be sorted whole."""
    return rows.withColumn(name, F.row_number().over(Window.orderBy(*order)).cast("bigint"))
