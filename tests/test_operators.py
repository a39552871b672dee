"""Operators on small frames: ties, nulls, duplicates and empty inputs; readers of files and HTML."""

import hashlib
import io
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from statloom import schemas
from statloom.functions import text as X
from statloom.operators import checks, claims, folds, linking, merge, multiset, nested, pick
from statloom.sources import files, html


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_picks(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, None), ("b", 1, "y"), ("b", 1, "z")], "k string, o int, v string")
    assert rows(pick.first_wins(df, ["k"], [F.asc("o"), F.asc("v")])) == [("a", 1, "x"), ("b", 1, "y")]
    assert rows(pick.last_wins(df, ["k"], ["o", "v"])) == [("a", 2, None), ("b", 1, "z")]
    assert rows(pick.top1_or_null_on_tie(df, ["k"], [F.desc("o")], "v")) == [("a", None), ("b", None)]
    assert rows(pick.unique_or_null(df, ["k"], "v")) == [("a", "x"), ("b", None)]
    assert rows(pick.inherit_unique(df, ["k"], "v").select("k", "o", "v")) == [("a", 1, "x"), ("a", 2, "x"), ("b", 1, "y"), ("b", 1, "z")]
    assert rows(pick.occurrence(df.select("k"), ["k"], [F.asc("k")], base=0)) == [("a", 0), ("a", 1), ("b", 0), ("b", 1)]
    assert rows(pick.first_last_around(df, "k", "o", F.lit(1))) == [("a", 1, 2, 2), ("b", 1, None, 2)]


def test_multiset_and_claims(spark):
    df = spark.createDataFrame([("r", 1, "x"), ("r", 1, "x"), ("r", 2, "x"), ("r", None, "y"), ("s", 1, "x")], "s string, v int, p string")
    assert rows(multiset.multiset_counts(df, ["s"], ["v"], ["p"])) == [("r", "x", 2), ("r", "y", 1), ("s", "x", 1)]
    assert multiset.multiset_union(df, ["s"], ["v"], ["p"]).count() == 4
    assert rows(claims.conflicts(df, ["s"], "p")) == [("r", 2, "x, y")]
    assert rows(claims.mapping_by_support(spark.createDataFrame([("a", "ü", 1), ("a", "b", 2), ("c", "bb", 1), ("c", "b", 2)], "l string, r string, i int"), "l", "r", "i")) == [("a", "b", 1), ("c", "b", 1)]
    assert rows(claims.conditional_counts(df, ["s"], "p", {"ones": F.col("v") == 1})) == [("r", 2, 1), ("s", 1, 1)]


def test_links(spark):
    fact = spark.createDataFrame([("a",), ("b",), ("c",), (None,)], "n string")
    dim = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3), ("a", 1), (None, 9)], "k string, i int")
    found = linking.resolve_soft(fact, "n", dim, "k", "i")
    assert rows(found.select("n", "linked")) == [("a", 1), ("b", None), ("c", None), (None, None)]
    assert rows(linking.issues(found, "t", "n", "unknown", "ambiguous")) == [("t", "n", "ambiguous", "b", 1), ("t", "n", "unknown", "c", 1)]
    items = spark.createDataFrame([(1, "x", ["aa", "bb"]), (2, "x", ["cc"]), (3, "y", ["aa"]), (4, "x", [])], "i int, b string, t array<string>")
    refs = spark.createDataFrame([("p", "x", ["aa", "bb"]), ("q", "x", ["aa"]), ("r", "x", ["cc"]), ("s", "x", ["cc"])], "r string, b string, t array<string>")
    assert rows(linking.overlap_match(items, refs, ["b"], "t", "i", "r")) == [(1, "p"), (2, None), (3, None), (4, None)]


def test_status(spark):
    keys = lambda *k: spark.createDataFrame([(x,) for x in k], "key string")
    failures = spark.createDataFrame([("bad", "boom"), ("both", "late")], "key string, error string")
    got = merge.status_merge(keys("new", "both"), keys("seen", "kept"), failures, keys("kept", "gone", "both"), "key", True)
    assert {r.key: (r.status, r.error) for r in got.collect()} == {"new": ("fresh", None), "both": ("retained", "late"), "seen": ("failed", None), "kept": ("retained", None), "bad": ("failed", "boom"), "gone": ("no_longer_listed", None)}
    assert merge.completeness(got, keys("new"), "key", True).first().complete is True
    assert merge.completeness(got, keys("new", "seen"), "key", True).first().complete is False
    assert merge.completeness(got, keys("new").where("false"), "key", True).first().complete is False
    left = merge.carry_failures(failures.where("key = 'bad'"), failures, keys("bad", "x"), ["key"])
    assert rows(left) == [("bad", "boom"), ("both", "late")]


def test_nested_and_folds(spark):
    child = spark.createDataFrame([(1, 2, "b"), (1, 1, "a"), (2, 1, None)], "k int, o int, v string")
    assert [[x.v for x in r.items] for r in nested.to_nested(child, ["k"], ["o"], ["v"], "items").orderBy("k").collect()] == [["a", "b"], [None]]
    assert rows(child.select(nested.compact_json({"v": nested.non_empty(F.col("v"), "text")}).alias("j"))) == [('{"v":"a"}',), ('{"v":"b"}',), (None,)]
    fields = spark.createDataFrame([([("Namn", "A"), ("Namn", "B")],)], "f array<struct<label:string,value:string>>")
    assert rows(fields.select(*nested.lift_labels("f", {"Namn": "name", "Ort": "town"}))) == [("A", None)]
    heads = spark.createDataFrame([(1, "A", None, "p"), (2, None, "x", None), (3, "B", None, None), (4, None, None, "q")], "o int, area string, product string, sub string")
    assert rows(folds.carry_levels(heads, [], [F.asc("o")], ["area", "product", "sub"])) == [(1, "A", None, "p"), (2, "A", "x", None), (3, "B", None, None), (4, "B", None, "q")]
    words = spark.createDataFrame([(1, "a", 5.0, 10.0), (1, "b", 60.0, 11.5), (1, "c", 5.0, 13.0), (1, "d", 61.0, 10.0)], "page int, text string, x0 double, top double")
    lines = folds.cluster_lines(words, ["page"], [0.0, 50.0]).orderBy("line_no").collect()
    assert [(r.cell_0, r.cell_1) for r in lines] == [("a", "b d"), ("c", "")]
    parts = spark.createDataFrame([(1, "AM", "x", 1), (2, "", "y", 2), (3, "BE", "z", 2)], "line int, code string, text string, page int")
    grouped = folds.joined_rows(folds.continuation_groups(parts, [], [F.asc("line")], F.col("code") != ""), [], "group_no", ["line"], ["code", "text"], "page")
    assert rows(grouped) == [(1, "AM", "x y", [1, 2]), (2, "BE", "z", [2])]


def test_checks(spark):
    df = spark.createDataFrame([("AM0101",), ("am",), (None,)], "c string")
    good, bad = checks.quarantine(df, {"code": X.is_code(F.col("c"))})
    assert rows(good) == [("AM0101",)] and bad.count() == 2
    assert not spark.createDataFrame([("AM0101\n",)], "c string").where(X.is_code(F.col("c"))).count()
    assert rows(checks.check_unique(spark.createDataFrame([(1,), (1,), (2,)], "x int"), ["x"])) == [(1, 2)]


def test_text(spark):
    one = lambda c: spark.range(1).select(c.alias("x")).first().x
    assert one(X.clean(F.lit(" a &amp; \n b "))) == "a & b"
    assert one(X.unquote(F.lit("a+b%20c"))) == "a+b c" and one(X.unquote(F.lit("100%"))) == "100%"
    assert one(X.leading_int(F.lit("2019/20"))) == 2019 and one(X.leading_int(F.lit("x"))) == 0 and one(X.leading_int(F.lit(None).cast("string"))) is None
    assert one(X.slug(F.lit("Ö-myndigheten för x (ÖX)"))) == "o_myndigheten_for_x"
    assert [r["from"].isoformat() for r in one(X.split_range(F.lit("2020-01-01").cast("date"), F.lit("2020-01-10").cast("date"), 3))] == ["2020-01-01", "2020-01-04", "2020-01-07"]
    assert one(X.change_kinds(F.lit("Produkten upphör"))) == ["other"] and one(X.change_kinds(F.lit("Avslutad produkt. Variabel tas bort"))) == ["content", "closed"]
    assert [one(X.timing(F.lit(t))) for t in ("Planeras fr.o.m. 2020", "vi vill avveckla den", "Produkten är inaktiv, kommer att utgå", "gäller fr.o.m. 2020-01-01", "Undersökningen har en period")] == ["unclear", "planned", "mixed", "source_claimed_effective", "unclear"]
    assert str(one(X.effective_date(F.lit("gäller fr.o.m. 2020-02-30 eller från och med 2020-03-01")))) == "None" and str(one(X.effective_date(F.lit("Från och med 2020-03-01")))) == "2020-03-01"
    assert [one(X.is_document_url(F.lit(u))) for u in ("https://x.se/A.CSV?y", "https://metadata.scb.se/q", "https://x.se/contentassets/z", "https://x.se/dokument/kvalitetsdeklaration", "https://x.se/?f=a.pdf")] == [True, True, True, False, False]
    assert one(X.split_names(F.lit("A, B,C, , D"))) == ["A", "B,C", "D"]
    assert one(X.abbreviation(F.lit("Namn (SCB)"))) == "SCB" and one(X.abbreviation(F.lit("Namn (mer än femton tecken)"))) is None
    assert one(X.calendar_code(F.lit("/kalender/am0101x/"))) == "AM0101X" and one(X.overlap(F.array(F.lit("a"), F.lit("b")), F.array(F.lit("a")))) == 1.0
    assert one(X.related_codes(F.lit("AM0101 och be0101"), F.lit("AM0101"))) == ["BE0101"] and one(X.target_kind(F.lit("https://x/pxweb/y"))) == "pxweb_table"
    assert [one(c) for c in X.pxweb_codes(F.lit("https://x/pxweb/START__AM__AM0101/"))] == ["AM", "AM0101"]
    digest = spark.createDataFrame([("é", 1)], "b string, a int").select(X.json_digest(F.struct("b", "a")).alias("x")).first().x
    assert digest == hashlib.sha256(json.dumps({"a": 1, "b": "é"}, ensure_ascii=False, sort_keys=True).encode()).hexdigest()
    assert one(X.tokens(F.lit("Gymnasieskolans elever och 2019 statistik"))) == ["gymnas", "elever"]


def sheet(cells, sheets=1):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        body = "".join(f'<row r="{r}">' + "".join(f'<c r="{chr(65 + k)}{r}" t="inlineStr"><is><t>{v}</t></is></c>' for k, v in enumerate(row) if v is not None) + "</row>" for r, row in enumerate(cells, 1))
        for k in range(sheets):
            z.writestr(f"xl/worksheets/sheet{k + 1}.xml", f'<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>{body}</sheetData></worksheet>')
    return out.getvalue()


def test_workbook(spark, tmp_path):
    (tmp_path / "w.xlsx").write_bytes(sheet([["Kod", "Namn"], ["AM0101", "Jobs"], ["BE0101", None]]))
    assert rows(files.workbook(spark, str(tmp_path / "w.xlsx"), ["Kod", "Namn"], ["code", "name"], "code").drop("source")) == [(1, "AM0101", "Jobs"), (2, "BE0101", None)]
    for bad in (sheet([["Kod"]]), sheet([["Kod", "Namn"], [None, None]]), sheet([["Kod", "Namn"]], 2)):
        with pytest.raises(ValueError):
            files.workbook_rows(bad, ["Kod", "Namn"])


def test_files(spark, tmp_path):
    (tmp_path / "r.tsv").write_text("﻿Namn\tOrt\nA\tB\n", encoding="utf-8")
    assert rows(files.tsv(spark, str(tmp_path / "r.tsv"), ["Namn", "Ort"])) == [("A", "B")]
    with pytest.raises(ValueError):
        files.tsv(spark, str(tmp_path / "r.tsv"), ["Ort"])
    assert files.json_rows(spark, str(tmp_path / "none" / "*.jsonl"), schemas.GAP).count() == 0
    source = tmp_path / "products"
    source.mkdir()
    (source / "manifest.json").write_text(json.dumps({"source": "products", "complete": False, "records": {"a": {"status": "fresh"}, "b": {"status": "retained", "error": "x"}, "c": {"status": "failed", "error": "y"}}}))
    (source / "a.json").write_text(json.dumps({"title": "T"}))
    (source / "b.json").write_text('{"title": ')
    docs, status = files.documents_of(spark, str(tmp_path), "products", "title string", ["title"])
    assert [(r.key, r.title) for r in docs.collect()] == [("a", "T")]
    assert {r.key: r.status for r in status.collect()} == {"a": "fresh", "b": "invalid", "c": "failed"}


def test_archive(spark, tmp_path):
    (tmp_path / "requests").mkdir()
    (tmp_path / "bodies").mkdir()
    for name, body, status in (("a", b"hello", 200), ("b", b"gone", 404), ("c", None, 200)):
        sha = hashlib.sha256(body or b"none").hexdigest()
        if body:
            (tmp_path / "bodies" / sha).write_bytes(body)
        (tmp_path / "requests" / f"{name}.json").write_text(json.dumps({"request": {"url": name}, "status": status, "sha256": sha}))
    good, bad = files.archive(spark, str(tmp_path))
    assert [bytes(r.content) for r in good.collect()] == [b"hello"] and sorted(r.reason for r in bad.collect()) == ["failed request", "missing body"]


def test_frontier(spark):
    links = spark.createDataFrame([("a", "b"), ("a", "skip"), ("b", "c"), ("c", "a")], "from_url string, to_url string")
    assert rows(files.crawl_frontier(links, spark.createDataFrame([("a",)], "url string"), ".*", "skip", 5, 10)) == [("a", 0), ("b", 1), ("c", 2)]


def test_readers():
    assert html.sections("<nav><p>x</p></nav><h2>A</h2><p>one <a href='u'>l</a></p><h3>B</h3><table><tr><th>H</th></tr><tr><td>1</td></tr></table><script>s</script>") == [
        {"heading_path": ["A"], "level": 2, "paragraphs": ["one l"], "links": [{"href": "u", "text": "l"}], "table_headers": [], "table_rows": []},
        {"heading_path": ["A", "B"], "level": 3, "paragraphs": [], "links": [], "table_headers": ["H"], "table_rows": [["1"]]}]
    for reader in (html.page_links, html.sections, html.subject_index):
        assert reader(None) == [] and reader("<<<") == []


def test_lines_of_a_long_page(spark):
    import random

    rnd = random.Random(2)
    words = [(p, f"w{k}", rnd.choice([0.0, 55.0, 120.0]) + rnd.random(), rnd.random() * 900 if p else rnd.random() * 30_000) for p, n in ((0, 40_000), (1, 500), (2, 1)) for k in range(n)] + [(3, "no place", None, 1.0)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "777")
    try:
        got = folds.cluster_lines(spark.createDataFrame(words, "page int, text string, x0 double, top double").repartition(6), ["page"], [0.0, 50.0, 100.0]).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want, first, at = [], None, None
    for p, text, x, top in sorted((w for w in words if w[2] is not None), key=lambda w: (w[0], w[3], w[2], w[1])):
        if p != at or top - first > 2.0:
            number = number + 1 if p == at else 0  # noqa: F821
            at, first = p, top
            want.append((p, number, top, [[], [], []]))
        want[-1][3][int(x >= 50) + int(x >= 100)].append((x, text))
    assert sorted(map(tuple, got)) == sorted((p, n, top, *(" ".join(t for _, t in sorted(c)) for c in cells)) for p, n, top, cells in want)


def test_code_of_a_metaplus_link(spark):
    from statloom.functions import text as X

    urls = ["https://metadata.scb.se/x?a=1&produkt=am0101", "https://metadata.scb.se/x?produkt=%20AM0101+", "https://metadata.scb.se/x?produkt=%41M0101", "https://metadata.scb.se/x?produkt=AM01", "https://other.se/x?produkt=AM0101", None]
    assert [r[0] for r in spark.createDataFrame([(u,) for u in urls], "u string").select(X.metaplus_code(F.col("u"))).collect()] == ["AM0101"] * 3 + [None] * 3
