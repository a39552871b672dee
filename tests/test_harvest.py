"""Documents of three sources, links of codes and agencies, views and the nested projection."""

import pytest
from pyspark.sql import functions as F

from statloom import schemas
from statloom.functions import text as X
from statloom.plans import calendar, harvest, warehouse

INDEX = """<h3 class="h2-small">Labour</h3><h3>Job openings</h3><h4 id="kd">Kvalitetsdeklaration</h4>
<a href="/f/am0101_kd_2019_2020.pdf">2020</a><a href="/f/kvalitetsdeklaration-jobs_2018.pdf">old</a>
<h3>Mixed</h3><h4 id="x">Statistikens framställning</h4><a href="/f/be0101_staf_2019.pdf">b</a><a href="/f/am0101_staf_2017.pdf">a</a><a href="/f/readme.pdf">readme</a>"""


@pytest.fixture(scope="module")
def entries(spark):
    rows = [("2020-01-02", "AM0101", "Job openings survey", None, "2019", ["R"], "A agency (AA), Other", "A agency (AA)", "u"), ("2020-01-02", "AM0101", "Job openings survey", None, "2019", ["R"], "A agency (AA), Other", "A agency (AA)", "u"), ("2021-05-05", "UF0101", "Elever i grundskolan", None, "2020", [], "Skolverket", "Statens skolverk", "u"), ("2021-05-05", "UF01019", "Odd code", None, "2020", [], "X", "X", "u")]
    return calendar.numbered(spark.createDataFrame(rows, schemas.CALENDAR)).cache()


@pytest.fixture(scope="module")
def docs(spark, entries):
    fragments = spark.createDataFrame([("1", "Labour market", "src", "f", INDEX, None)], schemas.FRAGMENT)
    body = [("//x.se/a.pdf", "Kvalitetsdeklaration elever grundskolan &amp; 2019", "t", "1", "PDF", None, None, None, None), ("https://x.se/b.pdf", "Something else", "t", "2", "pdf", None, None, None, None)]
    calls = spark.createDataFrame([("dokument", {"pVerkform": "Grundskolan", "pOmrade": "Elever", "pLasar": "2018"}, "call", "f", body, None), ("other", {}, "call", "f", None, None)], schemas.ENVELOPE)
    links = [("https://a.se/kd_be0101_2020.pdf", "Kvalitetsdeklaration 2020"), ("https://a.se/kd.pdf", "Kvalitetsdeklaration"), ("https://a.se/kd.pdf", "Kvalitetsdeklaration"), ("https://a.se/page", "no document")]
    pages = spark.createDataFrame([("https://a.se/p", 0, 200, None, "f", "Our page", links, None)], schemas.CRAWLED).withColumn("_file", F.lit("aa"))
    sources = spark.createDataFrame([("aa", "A agency (AA)", None, None, None, None, None, None, None, None)], schemas.SOURCES)
    return harvest.documents(fragments, calls, pages, sources, calendar.products(entries), {"attempted_sources": ["scb"]}).cache()


def by_url(docs, end):
    return docs.where(F.col("url").endswith(end)).collect()


def test_codes_and_candidates(docs):
    assert docs.count() == 8
    assert (by_url(docs, "2019_2020.pdf")[0].product_match, by_url(docs, "2019_2020.pdf")[0].year) == ("code", "2020")
    block = by_url(docs, "jobs_2018.pdf")[0]
    assert (block.product_code, block.product_match, block.doc_type) == ("AM0101", "block", "kvalitetsdeklaration")
    assert by_url(docs, "readme.pdf")[0].product_code is None  # two codes in its block
    school = by_url(docs, "/a.pdf")[0]
    assert (school.product_code, school.candidate_product_code, school.review_required) == (None, "UF0101", True)
    page = by_url(docs, "a.se/kd.pdf")[0]
    assert (page.candidate_product_code, page.product_match, page.source) == ("BE0101", "page", "sam/aa")
    assert docs.select("document_id").distinct().count() == 8


def test_rollup(spark, docs, entries):
    rows = {r.product_code: r for r in harvest.rollup(docs, calendar.products(entries), F.lit("2021-06-01").cast("date")).collect()}
    assert rows["AM0101"].documents == 3 and rows["AM0101"].kd_count == 2 and rows["AM0101"].kd_latest_year == "2020" and not rows["AM0101"].active
    assert rows["UF0101"].documents == 0 and rows["UF0101"].active and not rows["BE0101"].in_calendar
    assert harvest.metrics(docs, calendar.products(entries)).first().review_candidates == 2


def test_warehouse(spark, docs, entries):
    documents, doc_claims = warehouse.document_dimension(docs), warehouse.document_claims(docs)
    twice = doc_claims.unionByName(spark.createDataFrame([("https://www.scb.se/f/am0101_kd_2019_2020.pdf", "BE0101", "product_page", False)], doc_claims.schema))
    conflict = warehouse.v_document_code_conflicts(twice, documents).collect()
    assert [(r.distinct_codes, r.product_codes) for r in conflict] == [(2, "AM0101,BE0101")]
    assert warehouse.claim_issues(twice).count() == 1
    counts = {r.product_code: r for r in warehouse.v_document_counts(doc_claims, documents).collect()}
    assert (counts["AM0101"].documents, counts["AM0101"].kd_documents, counts["AM0101"].staf_latest_year) == (3, 2, "2017")
    assert "UF0101" not in counts  # a candidate is not counted
    latest = {(r.product_code, r.doc_type): r.url for r in warehouse.v_document_latest(doc_claims, documents).collect()}
    assert latest[("AM0101", "kvalitetsdeklaration")].endswith("2019_2020.pdf")

    agency, alias = warehouse.agencies(spark, entries, calendar.publishers(entries))
    names = {r.canonical_name: r.agency_id for r in agency.collect()}
    assert list(names) == ["A agency (AA)", "Statens skolverk", "X", "Other", "Skolverket"]
    fact, issues = warehouse.link_agency(docs, "agency", alias, "harvest_document")
    assert {r.agency_id for r in fact.where("source = 'sam/aa'").collect()} == {names["A agency (AA)"]} and issues.count() == 0
    _, unknown = warehouse.link_agency(spark.createDataFrame([("Nobody",), ("aa",), (None,), (" ",)], "agency string"), "agency", alias, "t")
    assert [tuple(r) for r in unknown.collect()] == [("t", "agency", "unknown_agency", "Nobody", 1)]
    register = spark.createDataFrame([(1, "A agency", "55"), (2, "X", "1"), (3, "x", "2")], "registry_row_id bigint, name string, org_nr string")
    linked, problems = warehouse.link_registry(agency, alias, register)
    assert {r.canonical_name: r.registry_org_nr for r in linked.collect()}["A agency (AA)"] == "55"
    assert sorted(r.issue for r in problems.collect()) == ["ambiguous_agency", "no_registry_match", "no_registry_match", "no_registry_match"]

    workbook = spark.createDataFrame([(1, "AM0101", "Openings", "AA", "Active", "Yearly", " labour", "Jobs")], "row_no int, product_code string, product_name string, responsible_authority string, publication_status string, periodicity string, subject_area string, statistics_area string")
    pages = spark.createDataFrame([("am0101", "AM0101", "Page title", "A agency (AA)", "2022-01-01", "https://x/1"), ("zz0001", "ZZ0001", "Twin", None, None, "https://x/1")], "page_key string, product_code string, title string, responsible_agency string, next_publication_date string, canonical_url string")
    product = warehouse.products([docs, entries, workbook, pages], workbook, entries, pages, harvest.rollup(docs, calendar.products(entries), F.current_date()))
    got = {r.product_code: r for r in product.collect()}
    assert set(got) == {"AM0101", "BE0101", "UF0101", "ZZ0001"} and got["AM0101"].name == "Openings" and got["UF0101"].agency_name == "Statens skolverk"
    linked_product, _ = warehouse.link_agency(product, "agency_name", alias, "product")
    over = {r.product_code: r for r in warehouse.v_product_overview(linked_product, agency, entries, warehouse.v_document_counts(doc_claims, documents), F.lit("2020-06-01")).collect()}
    assert (over["AM0101"].agency, over["AM0101"].last_publish_date, over["UF0101"].next_publish_date) == ("A agency (AA)", "2020-01-02", "2021-05-05")
    assert warehouse.v_agency_products(linked_product, linked, entries, warehouse.v_document_counts(doc_claims, documents)).count() == 2
    bad = warehouse.code_issues({("calendar_entry", "product_code"): entries, ("harvest_document", "product_code"): docs}, [workbook.select("product_code"), entries.select("product_code")], {"calendar_entry"})
    assert sorted((r.issue, r.raw_value) for r in bad.collect()) == [("malformed_code", "UF01019"), ("unknown_product", "BE0101")]

    aliases = warehouse.product_aliases(pages, spark.createDataFrame([("Requested calendar code UF0101; page short address identifies UF0102",)], "warning string"))
    assert sorted(tuple(r)[:2] for r in aliases.collect()) == [("UF0101", "UF0102"), ("ZZ0001", "AM0101")]
    cards = spark.createDataFrame([(1, None, "https://x/1", "AM", "Area"), (2, None, "https://x/2", "AM", "Area")], "card_id int, product_code string, link_canonical_url string, subject_code string, area_label string")
    linked_cards, card_issues = warehouse.link_cards(cards, pages, aliases)
    assert sorted((r.product_code or "", r.product_code_origin) for r in linked_cards.collect()) == [("", "unresolved"), ("AM0101", "url_match")] and card_issues.count() == 1
    subjects = spark.createDataFrame([("AM", "Labour")], "subject_code string, title string")
    claims = warehouse.subject_claims(workbook, linked_cards, docs, subjects)
    assert {r.origin for r in claims.where("product_code = 'AM0101'").collect()} == {"workbook", "subject_page", "harvest"}


@pytest.mark.parametrize(("url", "texts", "code", "year"), [
    ("https://x.se/AM0101_2019_2021.pdf", ["BE0101 2001"], "AM0101", "2021"), ("https://x.se/a.pdf", ["am0101 och be0101", "uf0101"], None, None),
    ("https://x.se/a.pdf", ["", "uf0101 2001 2005"], "UF0101", "2001"), ("https://x.se/2010/am0101/a.pdf", ["", ""], "AM0101", "2010"), ("https://x.se/xam0101.pdf", [""], None, None), ("kd%20am0101+x.pdf", [""], "AM0101", None)])
def test_code_and_year(spark, url, texts, code, year):
    lits = [F.lit(t) for t in texts]
    row = spark.range(1).select(X.find_code(F.lit(url), *lits).alias("c"), X.find_year(F.lit(url), *lits).alias("y")).first()
    assert tuple(row) == (code, year)


@pytest.mark.parametrize(("url", "text", "heading", "expected"), [("a_kd.pdf", "", "", "kvalitetsdeklaration"), ("x.pdf", "Statistikens framställning", "", "statistikens framställning"), ("bs_2010.pdf", "", "", "beskrivning av statistiken"), ("x.pdf", "x", "Mikrodata", "metaplus"), ("https://metadata.scb.se/m", "metaplus", "", "metaplus"), ("x.pdf", "skdx", "", None)])
def test_kind(spark, url, text, heading, expected):
    assert spark.range(1).select(X.kind(F.lit(url), F.lit(text), F.lit(heading))).first()[0] == expected


def test_urls(spark):
    rows = spark.createDataFrame([("HTTPS://A.se",), ("http://a.SE/X?#f",), ("http://a.se/x?q=1#f",)], "u string").select(X.canonical_url(F.col("u")).alias("c")).collect()
    assert [r.c for r in rows] == ["https://a.se/", "http://a.se/X", "http://a.se/x?q=1"]
    row = spark.createDataFrame([("http://a.se/x/y", "../z#q"), ("http://a.se/", "mailto:x")], "b string, h string").select(X.absolute_url(F.col("b"), F.col("h")).alias("u")).collect()
    assert [r.u for r in row] == ["http://a.se/z", None]
