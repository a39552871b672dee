"""The build from one data folder: all tables, links, issues, a failing node, missing inputs."""

import json
import os

import pytest
from pyspark.sql import functions as F

from statloom.plans import build, compact
from statloom.plans.tables import TABLES
from statloom.session import Scratch
from statloom.sources import extractions

PROVENANCE = {"requested_url": "https://a.se/x", "response_url": "https://a.se/x", "canonical_url": "HTTPS://A.se/x#y", "fetched_at": "2026-01-01T00:00:00Z", "http_status": 200, "content_type": "text/html", "content_sha256": "0" * 64}
LONG = "Verket för mätningar"


def link(text, url):
    return {"text": text, "href": url, "url": url}


def page(code, title, canonical, sections=(), **more):
    return {"provenance": PROVENANCE | {"canonical_url": canonical}, "product_code": code, "product_code_source": "calendar" if code else "unknown", "title": title, "short_address": None, "summary": "s", "official_statistics_marker": None,
            "next_publication_text": None, "next_publication_date": "2026-12-01" if code else None, "responsible_agency": None, "sections": list(sections), **more}


def card(text, url):
    return {"link": link(text, url), "product_code": None, "product_code_source": "unknown", "summary": None, "responsible_agency_text": f"Statistikansvarig myndighet: {LONG}", "tags_text": None}


def subject(code, title, areas, provenance=PROVENANCE):
    return {"code": code, "index_link": link(title, f"https://a.se/{code}"), "provenance": provenance, "title": title, "areas": areas}


def write(path, value):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(value if isinstance(value, str) else json.dumps(value, ensure_ascii=False))


def lines(path, rows):
    write(path, "".join(json.dumps(r, ensure_ascii=False) + "\n" for r in rows) + "\n")


def source(data, name, documents, status="fresh", warnings=(), more=()):
    for key, doc in documents.items():
        write(f"{data}/extractions/{name}/{key}.json", doc)
    records = {k: {"status": status, "error": None} for k in documents} | dict(more)
    write(f"{data}/extractions/{name}/manifest.json", {"source": name, "complete": True, "discovery_complete": True, "discovered_count": len(records), "records": records, "warnings": list(warnings)})


@pytest.fixture(scope="module")
def data(tmp_path_factory):
    d = str(tmp_path_factory.mktemp("data"))
    documentation = {"heading_path": [{"text": "Om", "level": 2, "anchor": None}, {"text": "Dokumentation", "level": None, "anchor": "d"}], "paragraphs": ["p"],
                     "links": [link("KD", "https://a.se/contentassets/aa0101_kd_2019.pdf"), link("M", "https://metadata.scb.se/x?produkt=BB0202"), link("no document", "https://a.se/page")], "table_headers": ["h"], "table_rows": [["1", "2"]]}
    other = {"heading_path": [{"text": "Annat", "level": 2, "anchor": None}], "links": [link("not here", "https://a.se/contentassets/other.pdf")]}
    source(d, "products", {
        "AA0101": page("AA0101", "Page A", "https://a.se/a", [documentation, other], notices=["n1", "n2"], tags=[link("t", "https://a.se/t")], responsible_agency={"label": f"{LONG} (VM)", "link": None}),
        "AA0102": page("AA0102", "Page A again", "https://a.se/a"), "CC0303": page("CC0303", "Page C", "https://a.se/c"), "f" * 64: page(None, "No code", "https://a.se/none", [other]),
        "bad": page("x1", "Bad code", "https://a.se/bad")}, warnings=["Requested calendar code CC0303; page short address identifies CC0304"], more={"gone": {"status": "retained", "error": "timeout"}})
    areas = [{"label": "Area 1", "source_anchor": "a", "source_url": None, "products": [card("A", "https://a.se/a"), card("C", "https://a.se/c#top"), card("?", "https://a.se/unknown")]}, {"label": "Area 2", "source_anchor": None, "source_url": None}]
    index = {"provenance": PROVENANCE, "title": "i", "introduction": None, "traversal_complete": True, "subjects": [subject("AA", "from the index", []), subject("BB", "Only index", [], None)]}
    source(d, "subjects", {"index": index, "AA": subject("AA", "Own page", areas)})
    row = {"Statistikansvarig myndighet": " VMX ", "Produktkod": "AA0101", "Produktnamn": "Book A ", "Syfte": "why", "Anvandare": None, "Publiceringsstatus": "active", "Ämnesområde": "own PAGE", "Statistikområde": "Area 1", "Periodicitet": "yearly"}
    source(d, "official_products", {"index": {"provenance": PROVENANCE, "sheet": "s", "headers": list(row), "total_source_rows": 2, "partial_sample": False, "rows": [row, row | {"Produktkod": "DD0404", "Statistikansvarig myndighet": "Unheard of"}]}})
    agencies = [{"agency_name": f"{LONG} (VM)", "statistics_link_text": "l", "statistics_url": "u", "subjects": [{"subject_name": "S", "statistical_areas": ["x", "y"]}, {"subject_name": "T", "statistical_areas": []}]}]
    source(d, "official_agencies", {"index": {"provenance": PROVENANCE, "page_title": "p", "scope_statements": [{"text": "s", "links": []}], "coverage": "complete", "agencies": agencies}})
    group = {"dataset_label": "d", "row_text": "r", "links": [{"anchor_text": "a", "url": "https://a.se/START__AA__AA0101/", "target_kind": "pxweb_table", "context_text": None, "subject_code": "AA", "product_code": "AA0101"}]}
    source(d, "hvd", {"index": {"provenance": PROVENANCE, "title": "t", "headers": [], "total_source_groups": 1, "partial_sample": False, "groups": [group]}})
    notice = {"authority": "VM", "product_code": "AA0101", "product_name": "Book A", "description": "d", "pages": [1, 2, 2], "row_ordinal": 1, "change_kinds": ["name", "name"], "timing_claim": "planned", "effective_date": "2026-01-01", "effective_date_text": None,
              "related_product_codes": ["EE0505"], "interpretation_evidence": None, "review_required": False}
    report = {"provenance": PROVENANCE, "link_label": "l", "title": "t", "document_date_text": None, "coverage_period_text": "c", "page_count": 2, "document_notes": ["n"], "partial_sample": False, "notices": [notice, notice | {"row_ordinal": 2, "product_code": None}], "page_texts": {"10": "ten", "9": "nine"}}
    source(d, "changes", {"index": {"provenance": PROVENANCE, "title": "t", "entries": [{"key": "r" * 4, "title": "t", "url": "https://a.se/report.pdf"}], "complete": True}, "rrrr": report})
    write(f"{d}/extractions/hvd/unlisted.json", {"not": "listed"})
    entry = {"publish_date": "2026-01-01", "product_code": "AA0101", "product_name": "Cal A", "reporting_round": None, "reference_period": "2025", "forms": ["News", "Table"], "published_at": f"{LONG}, Other agency", "responsible_agency": LONG, "product_url": "u"}
    lines(f"{d}/calendar.jsonl", [entry | {"publish_date": "2026-02-02"}, entry, entry, entry | {"product_code": "BB02", "responsible_agency": None, "published_at": None, "forms": None}])
    write(f"{d}/gaps.json", [{"from": "2026-01-01", "to": "2026-01-02", "expected": 4, "retrieved": 3}])
    write(f"{d}/state.json", {"last_completed_run": "2026-03-03"})
    doc = {"source": "scb", "doc_type": "kvalitetsdeklaration", "year": "2016", "title": "KD", "url": "https://a.se/contentassets/x.pdf#p", "filetype": "pdf", "review_required": False, "provenance": {"a": 1}, "subject_area": "Own page ", "statistics_area": "Area 1"}
    lines(f"{d}/dokumentation/dokument.jsonl", [
        doc | {"document_id": "a", "agency": LONG.upper(), "product_code": "AA0101", "product_match": "code"}, doc | {"document_id": "b", "agency": "Invented", "product_code": "BB0202", "product_match": "block", "title": "later"},
        doc | {"document_id": "c", "url": "https://a.se/y.pdf", "agency": LONG, "product_code": None, "product_match": "name", "candidate_product_code": "AA0101", "review_required": True, "subject_area": None}])
    lines(f"{d}/dokumentation/sam_dokument.jsonl", [{"name": "x", "agency": LONG, "href": "https://a.se/z.pdf", "product_code": "XX01"}])
    write(f"{d}/dokumentation/state.json", {"last_failures": ["siris", "sam/x"]})
    write(f"{d}/reference/agency_registry_linked.json", {"records": [{"agency": LONG, "group_option_value": "2", "group_name": "g", "fields": [{"label": "Namn", "value": LONG.upper()}, {"label": "Organisationsnr", "value": "1-2"}, {"label": "Organisationsnr", "value": "3-4"}, {"label": "LopNr", "value": ""}]}]})
    write(f"{d}/sources.json", [{"name": "vm", "agency": "Verket (V2)"}])
    return d


@pytest.fixture(scope="module")
def built(spark, data, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("out") / "db")
    report = build.build(spark, data, root, f"{data}/sources.json", "2026-05-05", "r1")
    return root, report, build.tables(spark, root)


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def test_every_table_has_its_rows(built):
    _, report, t = built
    assert set(report["counts"]) == set(TABLES) and len(TABLES) == 45
    assert {k: n for k, n in report["counts"].items()} == {
        "build_info": 4, "source_status": report["counts"]["source_status"], "provenance": report["counts"]["provenance"], "agency": report["counts"]["agency"], "agency_alias": report["counts"]["agency_alias"],
        "product": 7, "product_name_alias": report["counts"]["product_name_alias"], "product_alias": 2, "subject": 2, "statistical_area": 2, "document": 4, "document_product_claim": 6, "product_subject_claim": 6,
        "calendar_entry": 4, "calendar_entry_form": 6, "calendar_entry_publisher": 6, "calendar_gap": 1, "harvest_document": 3, "dokumentation_product": 0, "siris_dokument": 0, "sam_dokument": 1, "product_page": 4,
        "product_page_notice": 2, "product_page_tag": 1, "product_page_section": 3, "product_page_link": 5, "subject_product_card": 3, "scope_statement": 1, "official_agency": 1, "official_agency_subject": 3, "european_agency": 0,
        "european_central_bank": 0, "registry_agency": 1, "registry_agency_field": 4, "official_product_row": 2, "hvd_group": 1, "hvd_link": 1, "changes_report": 1, "changes_report_note": 1, "changes_report_page": 2,
        "change_notice": 2, "change_notice_kind": 2, "change_notice_page": 4, "change_notice_related_product": 2, "link_issues": report["counts"]["link_issues"]}
    assert rows(t["calendar_entry"].where("product_code = 'AA0101'"), "entry_id", "occurrence") == [(1, 1), (2, 1), (3, 2)]
    assert dict(rows(t["build_info"], "key", "value")) == {"built_at": "2026-05-05", "git_revision": "r1", "schema_version": "1", "calendar_last_completed_run": "2026-03-03"}


def test_states_of_sources_and_keys(built):
    states = {(r["source"], r["key"]): (r["status"], r["error"]) for r in built[2]["source_status"].collect()}
    assert states["products", "bad"] == ("invalid", "not a valid document") and states["products", "gone"] == ("retained", "timeout") and states["products", "AA0101"] == ("fresh", None)
    assert states["european_agencies", "manifest"][0] == "missing" and ("hvd", "unlisted") not in states
    assert states["siris", "siris"][0] == states["sam", "x"][0] == "failed" and states["dokumentation", "produkter.jsonl"][0] == "missing"
    assert any("products/bad: invalid" in w for w in built[1]["warnings"])


def test_agencies_are_linked_by_name_abbreviation_and_shared_codes(built):
    t = built[2]
    agency = {r["canonical_name"]: r for r in t["agency"].collect()}
    mine = agency[LONG]
    assert (mine["agency_id"], mine["registry_org_nr"], mine["registry_group"], mine["registry_lop_nr"]) == (1, "1-2", "2", None)
    assert set(agency) == {LONG, "Other agency", "Unheard of", "Verket (V2)"}
    alias = rows(t["agency_alias"].where("agency_id = 1"), "alias", "origin")
    assert ("VMX", "workbook") in alias and ("VM", "official_agencies:abbreviation") in alias
    assert ("vm", "dokumentation_sources:slug") in rows(t["agency_alias"], "alias", "origin")
    for name in ("official_agency", "subject_product_card", "official_product_row", "change_notice", "sam_dokument", "registry_agency"):
        assert 1 in [r["agency_id"] for r in t[name].collect()], name
    assert rows(t["harvest_document"], "document_id", "agency_id") == [("a", 1), ("b", None), ("c", 1)]


def test_documents_claims_and_subjects(built):
    t = built[2]
    assert rows(t["document_product_claim"], "url", "product_code", "origin") == [
        ("https://a.se/contentassets/aa0101_kd_2019.pdf", "AA0101", "product_page"), ("https://a.se/contentassets/x.pdf", "AA0101", "harvest_filename"), ("https://a.se/contentassets/x.pdf", "BB0202", "harvest_block"),
        ("https://a.se/y.pdf", "AA0101", "harvest_candidate"), ("https://metadata.scb.se/x?produkt=BB0202", "AA0101", "product_page"), ("https://metadata.scb.se/x?produkt=BB0202", "BB0202", "metaplus_query")]
    first = t["document"].where("url = 'https://a.se/contentassets/x.pdf'").first()
    assert (first["title"], first["first_origin"]) == ("KD", "harvest")
    assert rows(t["subject"], "subject_code", "title") == [("AA", "Own page"), ("BB", "Only index")]
    assert rows(t["subject_product_card"], "ordinal", "product_code", "product_code_origin") == [(1, "AA0101", "url_match"), (2, "CC0303", "url_match"), (3, None, "unresolved")]
    assert rows(t["product_alias"], "product_code", "alias_of") == [("AA0102", "AA0101"), ("CC0303", "CC0304")]
    assert ("AA0101", "AA", "workbook") in rows(t["product_subject_claim"], "product_code", "subject_code", "origin") and ("AA0101", "AA", "harvest") in rows(t["product_subject_claim"], "product_code", "subject_code", "origin")
    assert rows(t["official_agency_subject"], "subject_ordinal", "area_ordinal", "statistical_area") == [(1, 1, "x"), (1, 2, "y"), (2, 1, None)]
    assert rows(t["changes_report_page"], "page", "text") == [(10, "ten"), (9, "nine")] and t["changes_report"].first()["url"] == "https://a.se/report.pdf"


def test_issues_and_products(built):
    t = built[2]
    issues = rows(t["link_issues"], "issue", "table_name", "raw_value")
    assert ("unknown_agency", "harvest_document", "Invented") in issues and ("malformed_code", "sam_dokument", "XX01") in issues and ("malformed_code", "calendar_entry", "BB02") in issues
    assert ("inferred", "hvd_link", "AA0101") in issues and ("unknown_product", "change_notice_related_product", "EE0505") in issues and ("unknown_product", "subject_product_card", None) in issues
    assert [r["detail"] for r in t["link_issues"].where("issue = 'conflicting_claim'").collect()] == ["AA0101,BB0202"] * 2
    product = {r["product_code"]: r for r in t["product"].collect()}
    assert set(product) == {"AA0101", "AA0102", "BB0202", "CC0303", "CC0304", "DD0404", "EE0505"}
    assert (product["AA0101"]["name"], product["AA0101"]["agency_id"], product["AA0101"]["in_workbook"], product["AA0101"]["in_calendar"], product["AA0101"]["has_product_page"]) == ("Book A", 1, True, True, True)
    assert {"Book A ", "Cal A", "Page A", "Book A"} <= {r["name"] for r in t["product_name_alias"].where("product_code = 'AA0101'").collect()}


def test_views(built):
    v = build.views(built[2], F.lit("2026-01-15"))
    over = {r["product_code"]: r for r in v["v_product_overview"].collect()}
    assert (over["AA0101"]["agency"], over["AA0101"]["last_publish_date"], over["AA0101"]["next_publish_date"], over["AA0101"]["documents"]) == (LONG, "2026-01-01", "2026-02-02", 3)
    assert over["AA0101"]["product_page_next_publication_date"] == "2026-12-01"
    assert {(r["product_code"], r["calendar_entries"], r["documents"]) for r in v["v_agency_products"].where(F.col("agency") == LONG).collect()} == {("AA0101", 3, 3)}
    assert v["v_document_code_conflicts"].count() == 2 and v["v_document_latest"].count() > 0


def test_a_failing_node_names_its_table_and_the_last_build_stays(spark, data, built, monkeypatch):
    root, _, t = built
    before = rows(t["link_issues"], *t["link_issues"].columns)

    def explode(*args):
        raise RuntimeError("boom")

    monkeypatch.setitem(build.NODES, "product_alias", (build.NODES["product_alias"][0], explode))
    with pytest.raises(build.BuildError, match="product_alias"):
        build.build(spark, data, root)
    assert rows(build.tables(spark, root)["link_issues"], *t["link_issues"].columns) == before
    assert sorted(os.listdir(os.path.dirname(root))) == ["db"]


def test_missing_inputs_and_repeated_build(spark, data, built, tmp_path):
    report = build.build(spark, str(tmp_path / "nothing"), str(tmp_path / "empty"))
    assert report["counts"]["calendar_entry"] == 0 and any("missing" in w for w in report["warnings"])
    build.build(spark, data, str(tmp_path / "again"), f"{data}/sources.json", "later", "r2")
    again = build.tables(spark, str(tmp_path / "again"))
    for name, df in built[2].items():
        if name != "build_info":
            assert df.exceptAll(again[name]).isEmpty() and df.count() == again[name].count(), name


def test_verdicts_at_any_depth(spark):
    models = {("s", None): "a: string NOT NULL COMMENT 'x+', b: array<struct<c: int, d: boolean NOT NULL COMMENT '?'>> NOT NULL, m: map<string,string> COMMENT '?'"}
    cases = {
        '{"a": "xx", "b": []}': True, '{"a": "xx", "b": [{"c": null}], "m": {"k": null}}': True, '{"a": "xx", "b": [{"c": 1, "d": true}], "m": null}': True,
        '{"a": "y", "b": []}': False, '{"b": []}': False, '{"a": null, "b": []}': False, '{"a": "x", "b": [{}]}': False, '{"a": "x", "b": [{"c": "1"}]}': False, '{"a": "x", "b": [{"c": 1, "d": null}]}': False,
        '{"a": "x", "b": [{"c": 1, "e": 2}]}': False, '{"a": "x", "b": [null]}': False, '{"a": "x", "b": {}}': False, '{"a": "x", "b": [], "m": {"k": 1}}': False, '{"a": "x\\n", "b": []}': False, "[]": False, "{": False, "": False}
    texts = spark.createDataFrame([("s", str(k), text) for k, text in enumerate(cases)], "source string, key string, value string")
    held = Scratch(spark).written(extractions.with_models(texts, models), "rows")
    assert {int(r["key"]): r["valid"] for r in extractions.verdicts(held, models).collect()} == dict(enumerate(cases.values()))


# --- the nested projection ------------------------------------------------------

@pytest.fixture(scope="module")
def nested(spark, built):
    return {n: {r[0]: r.asDict() for r in compact.as_json(df).collect()} for n, df in compact.project(built[2], "2026-05-05").items()}


def test_compact_products(nested):
    a = nested["product"]["AA0101"]
    assert {k: a[k] for k in ("name", "agency", "subject", "area", "official", "periodicity", "purpose", "summary", "alias_of")} == {
        "name": "Book A", "agency": "verket_for_matningar", "subject": "AA", "area": "Area 1", "official": 1, "periodicity": "yearly", "purpose": "why", "summary": "s", "alias_of": None}
    assert json.loads(a["other_names"]) == ["Cal A", "Page A"]
    # Two of three calendar rows are equal; publishers are named where they are not just the agency itself.
    release = {"period": "2025", "forms": ["News", "Table"], "by": ["verket_for_matningar", "other_agency"]}
    assert json.loads(a["publications"]) == [{"date": "2026-01-01", **release}, {"date": "2026-02-02", **release}]
    kd = {"type": "kvalitetsdeklaration", "year": "2016"}
    assert json.loads(a["documents"]) == [{"url": "https://a.se/contentassets/aa0101_kd_2019.pdf"}, {"url": "https://metadata.scb.se/x?produkt=BB0202"}, {**kd, "url": "https://a.se/contentassets/x.pdf"}, {**kd, "url": "https://a.se/y.pdf", "candidate": True}]
    assert json.loads(a["changes"]) == [{"kinds": ["name"], "effective": "2026-01-01", "timing": "planned", "text": "d", "related": ["EE0505"]}]
    assert json.loads(a["hvd"]) == [{"dataset": "d", "table": "a", "url": "https://a.se/START__AA__AA0101/"}]
    assert (nested["product"]["CC0303"]["alias_of"], nested["product"]["AA0102"]["alias_of"]) == ("CC0304", "AA0101")
    assert all(nested["product"]["EE0505"][k] is None for k in ("publications", "documents", "changes", "hvd", "other_names"))


def test_compact_agencies_subjects_and_meta(nested):
    a = nested["agency"]["verket_for_matningar"]
    assert (a["org_nr"], a["official"], a["european"], a["statistics_url"]) == ("1-2", 1, 0, "u") and json.loads(a["subjects"]) == {"S": ["x", "y"], "T": []}
    assert nested["subject"]["AA"]["name"] == "Own page" and json.loads(nested["subject"]["AA"]["areas"]) == ["Area 1", "Area 2"] and nested["subject"]["BB"]["areas"] is None
    meta = {k: json.loads(r["value"]) for k, r in nested["meta"].items()}
    assert meta["built_at"] == "2026-05-05" and meta["dokumentation_as_of"] is None and meta["calendar_last_completed_run"] == "2026-03-03" and "extractions/products/bad: invalid" in meta["not_fresh"]


def test_slugs_never_meet(spark):
    names = ["Verk", "Verk 2", "Verk (V)", "Ää Öö", "Verk", "Other"]
    rows = spark.createDataFrame([(k, n) for k, n in enumerate(names, 1)], "agency_id bigint, canonical_name string")
    assert [r["slug"] for r in compact.agency_slugs(rows).orderBy("agency_id").collect()] == ["verk", "verk_2", "verk_3", "aa_oo", "verk_4", "other"]


def test_first_seen_order_and_pruning(spark):
    rows = [(1, 2, 1, "b", "x"), (1, 1, 1, "z", None), (1, 3, 1, "b", "w"), (1, 3, 2, "a", ""), (1, 2, 2, "b", "y")]
    df = spark.createDataFrame(rows, "k int, p int, q int, item string, v string").repartition(5)
    assert compact.first_seen(df, "k", "item", "v", ["p", "q"]).select(F.to_json("items")).first()[0] == '{"z":[],"b":["x","y","w"],"a":[]}'
    deep = spark.createDataFrame([(1, [("", [], [("", None)], ["", "x"])], {"k": []}), (2, [], {})], "k int, a array<struct<s:string,l:array<int>,d:array<struct<t:string,u:int>>,w:array<string>>>, m map<string,array<int>>")
    assert [tuple(r)[1:] for r in compact.as_json(deep).orderBy("k").collect()] == [('[{"d":[{}],"w":["","x"]}]', '{"k":[]}'), (None, None)]


def test_compact_build_holds_four_tables(spark, data, tmp_path):
    root = str(tmp_path / "small")
    counts = compact.build_compact(spark, data, root, f"{data}/sources.json", "2026-05-05")
    assert counts == {"product": 7, "agency": 4, "subject": 2, "meta": 5} and sorted(os.listdir(tmp_path)) == ["small"]
