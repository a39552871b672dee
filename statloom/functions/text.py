"""Text, URL, code and date expressions; everything here stays in the JVM but the named Arrow functions."""

from __future__ import annotations

import hashlib
import html
import json
import re
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: a product code, two capitals and four digits.
CODE = r"^[A-Z]{2}[0-9]{4}\z"
# Fixed value: a code inside a text.
CODE_IN_TEXT = r"(?<![A-Za-z0-9])([A-Za-z]{2}[0-9]{4})(?![A-Za-z0-9])"
# Fixed value: a year inside a text.
YEAR_IN_TEXT = r"(?<![0-9])((?:19|20)[0-9]{2})(?![0-9])"
# Fixed value: links of crawled pages that are taken for documents.
DOCUMENT_FILE = r"(?iu)\.(pdf|docx?|xlsx?)(\?|$)|/download/|getFile|urn\.kb\.se|metadata\.scb\.se|kvalitetsdeklaration"
# Path endings, path part and host of links that are taken for documents.
DOCUMENT_ENDINGS = (".pdf", ".doc", ".docx", ".xls", ".xlsx", ".csv", ".zip", ".txt", ".ppt", ".pptx")
DOCUMENT_PART, DOCUMENT_HOST = "/contentassets/", "metadata.scb.se"
# Ordered document classes with the pattern that decides each.
KINDS = [
    ("metaplus", r"(?iu)metadata\.scb\.se|metaplus"),
    ("scbdok", r"(?iu)scbdok|(?<![a-z])do[_-]\d{4}|_do[_.]"),
    ("statistikens framställning", r"(?iu)statistikens[ _-]?framst|(?<![a-z])staf(?![a-z])|framstallning"),
    ("beskrivning av statistiken", r"(?iu)beskrivning[ _-]av[ _-]statistiken|(?<![a-z])bs[_-]\d{4}|_bs[_.]|_beskr|(?<![a-z])bas(?![a-z])"),
    ("kvalitetsrapport", r"(?iu)kvalitetsrapport|quality[ _-]report"),
    ("kvalitetsdeklaration", r"(?iu)kvalitetsdeklaration|kvalitetsdokumentation|(?<![a-z])kd(?![a-z])|quality[ _-]declaration|(?<![a-zåäö])kvalitet(?![a-zåäö])"),
]
# Heading words that decide where file name and text do not.
HEADINGS = [("framst", "statistikens framställning"), ("kvalitet", "kvalitetsdeklaration"), ("mikrodata", "metaplus")]
# Change kinds and their patterns, for texts in lower case.
CHANGES = [
    ("new_product", r"ny produkt"),
    ("name", r"produktnamn|namnändring"),
    ("content", r"ändring av produkt[.: ]|variabel|redovisningsgrupp|tillägg av tabell"),
    ("periodicity", r"periodicitet"),
    ("inactive", r"produkten (?:bli[r]?|är) inaktiv"),
    ("closed", r"avslutad produkt|produkten avslutas"),
    ("status", r"produktstatus"),
    ("merge", r"slås ihop|slogs.*ihop|gemensam produktsida|sammanslagning av produkter"),
]
# What tells planned changes, changes in force, and the day of a change, in lower case.
PLANNED = r"avsikt|avser att|föreslås|kommer att|planerar|vill "
EFFECTIVE = r"ändringen gäller|(?:gäller |produkt )?fr\.?\s*o\.?\s*m\.?\s*\d{4}-\d{2}-\d{2}|produkten är inaktiv|avslutad produkt|är officiell statistik|har (?:utökats|lagts till|ändrats)"
EFFECTIVE_DAY = r"(?:ändringen gäller\s*)?(?:fr\.?\s*o\.?\s*m\.?|från och med)\s*(\d{4}-\d{2}-\d{2})"
# Words that say nothing about a product.
STOP_WORDS = (
    "statistik", "statistiken", "och", "för", "med", "som", "inom", "efter", "per", "samt", "the", "and", "kvalitetsdeklaration", "statistikens", "framställning",
    "pdf", "docx", "läs", "läsår", "läsåret", "år", "hösten", "våren", "område", "områdets", "uppgifter", "officiell", "officiella", "sveriges",
)


# --- white space, HTML, tokens ----------------------------------------------

def collapse(c: Column) -> Column:
    """White space runs, no-break spaces included, as one blank each; none at the ends."""
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


@F.pandas_udf(T.StringType())
def unescape_html(s: pd.Series) -> pd.Series:
    return s.map(html.unescape, na_action="ignore")


def clean(c: Column) -> Column:
    return collapse(unescape_html(c))


def bare_row(c: Column) -> Column:
    """A table row without the attributes of its own tag, collapsed: what makes two rows equal."""
    return collapse(F.regexp_replace(c, r"(?i)^\s*<tr\b[^>]*>", "<tr>"))


def tokens(c: Column) -> Column:
    """Distinct six-letter stems of the words of four letters or more that are no numbers and no stop words."""
    words = F.split(F.regexp_replace(F.lower(unquote(F.coalesce(c, F.lit("")))), r"[^a-zåäö0-9]+", " "), " ")
    kept = F.filter(words, lambda w: (F.length(w) >= 4) & ~w.isin(*STOP_WORDS) & ~w.rlike(r"^[0-9]+\z"))
    return F.array_distinct(F.transform(kept, lambda w: F.substring(w, 1, 6)))


def overlap(a: Column, b: Column) -> Column:
    """Shared tokens over the tokens of ``b``."""
    return F.when(F.size(b) > 0, F.size(F.array_intersect(a, b)) / F.size(b))


# --- URLs ---------------------------------------------------------------------

def unquote(c: Column) -> Column:
    """Percent-decoding that keeps plus signs, and the text as it is where it can't be decoded."""
    return F.coalesce(F.try_url_decode(F.replace(c, F.lit("+"), F.lit("%2B"))), c)


def canonical_url(c: Column) -> Column:
    """Without fragment and empty query, scheme and host in lower case, path at least a slash."""
    bare = F.regexp_replace(F.ltrim(c), r"#.*$", "")
    whole = r"^([A-Za-z][A-Za-z0-9+.-]*)://([^/?]*)([^?]*)(\?.*)?$"
    part = lambda k: F.regexp_extract(bare, whole, k)
    built = F.concat(F.lower(part(1)), F.lit("://"), F.lower(part(2)), F.when(part(3) == "", "/").otherwise(part(3)), F.when(part(4) == "?", "").otherwise(part(4)))
    return F.when(bare.rlike(whole), built).otherwise(bare)


def url_key(c: Column) -> Column:
    return F.sha2(canonical_url(c).cast("binary"), 256)


def url_host(c: Column) -> Column:
    return F.lower(F.regexp_extract(c, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))


def url_path(c: Column) -> Column:
    return F.regexp_extract(c, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)


def url_file(c: Column) -> Column:
    """The last step of the path, decoded; of relative addresses too."""
    path = F.regexp_replace(F.regexp_replace(c, r"[?#].*$", ""), r"^[A-Za-z][A-Za-z0-9+.-]*://[^/]*", "")
    return unquote(F.regexp_extract(path, r"([^/]*)$", 1))


def url_query(c: Column) -> Column:
    return F.regexp_extract(c, r"\?([^#]*)", 1)


def query_param(c: Column, name: str) -> Column:
    """A parameter's value, NULL where it is missing or empty."""
    return F.nullif(F.regexp_extract(F.concat(F.lit("&"), url_query(c)), rf"&{re.escape(name)}=([^&]*)", 1), F.lit(""))


def metaplus_code(c: Column, host: str = "metadata.scb.se") -> Column:
    value = query_param(c, "produkt")
    code = F.upper(F.trim(F.coalesce(F.try_url_decode(value), value)))
    return F.when((url_host(c) == host) & code.rlike(CODE), code)


@F.pandas_udf(T.StringType())
def absolute_url(base: pd.Series, href: pd.Series) -> pd.Series:
    """The link's address without fragment; NULL for anchors, mail, phone and script links."""
    out = []
    for b, h in zip(base, href, strict=True):
        h = (h or "").strip()
        if not h or h.startswith("#") or h.lower().split(":")[0] in ("mailto", "tel", "javascript"):
            out.append(None)
            continue
        try:
            full = urljoin(b or "", h).split("#")[0]
        except ValueError:
            full = ""
        out.append(full if full.lower().startswith(("http://", "https://")) else None)
    return pd.Series(out, dtype="object")


def is_document_url(c: Column) -> Column:
    """Whether an address is a document's: by its path's ending, a part of its path, or its host."""
    path = F.lower(url_path(c))
    found = path.contains(DOCUMENT_PART) | (url_host(c) == DOCUMENT_HOST)
    for ending in DOCUMENT_ENDINGS:
        found = found | path.endswith(ending)
    return F.coalesce(found, F.lit(False))


def target_kind(c: Column) -> Column:
    return F.when(c.contains("/pxweb/"), "pxweb_table").when(c.contains("/sq/"), "saved_query").otherwise("other")


def pxweb_codes(c: Column) -> tuple[Column, Column]:
    """(subject, product) of a table address."""
    p = r"START__([A-Z]{2})__([A-Z]{2}[0-9]{4})(?=__|/|$)"
    return F.nullif(F.regexp_extract(c, p, 1), F.lit("")), F.nullif(F.regexp_extract(c, p, 2), F.lit(""))


# --- codes and years --------------------------------------------------------

def is_code(c: Column) -> Column:
    return c.rlike(CODE)


def codes_in(c: Column) -> Column:
    """Distinct product codes of a text, in order, as capitals."""
    return F.array_distinct(F.transform(F.regexp_extract_all(c, F.lit(CODE_IN_TEXT), 1), lambda x: F.upper(x)))


def find_code(url: Column, *texts: Column) -> Column:
    """File name, then texts, then the whole address: the first that has codes decides, and only if it has one."""
    out = None
    for c in [url_file(url), *texts, unquote(url)]:
        found = codes_in(F.coalesce(c, F.lit("")))
        value = F.when(F.size(found) == 1, F.get(found, F.lit(0)))
        out = F.when(F.size(found) > 0, value) if out is None else out.when(F.size(found) > 0, value)
    return out


def years_in(c: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(YEAR_IN_TEXT), 1)


def find_year(url: Column, *texts: Column) -> Column:
    """The last year of the file name, else the first one of the first text that has any, else of the address."""
    found = years_in(url_file(url))
    out = F.when(F.size(found) > 0, F.element_at(found, -1))
    for c in [*texts, unquote(url)]:
        found = years_in(c)
        out = out.when(F.size(found) > 0, F.get(found, F.lit(0)))
    return out


def calendar_code(href: Column) -> Column:
    """Code at the end of a calendar link; one trailing letter is let through and shows up as malformed later."""
    return F.nullif(F.upper(F.regexp_extract(href, r"/([A-Za-z]{2}\d{4}[A-Za-z]?)/?$", 1)), F.lit(""))


def related_codes(text: Column, own: Column) -> Column:
    return F.filter(codes_in(text), lambda c: ~c.eqNullSafe(own))


def leading_int(c: Column) -> Column:
    """The number a text begins with, 0 if none, NULL for NULL."""
    return F.when(c.isNotNull(), F.coalesce(F.regexp_extract(c, r"^\s*([+-]?\d+)", 1).try_cast("int"), F.lit(0)))


# --- classes ----------------------------------------------------------------

def kind(url: Column, text: Column, heading: Column | None = None) -> Column:
    """The first class whose pattern is in file name or text, else what the heading says."""
    name, text = F.coalesce(url_file(url), F.lit("")), F.coalesce(text, F.lit(""))
    out = None
    for label, p in KINDS:
        here = name.rlike(p) | text.rlike(p)
        out = F.when(here, label) if out is None else out.when(here, label)
    if heading is not None:
        for word, label in HEADINGS:
            out = out.when(F.lower(F.coalesce(heading, F.lit(""))).contains(word), label)
    return out


def file_type(url: Column) -> Column:
    found = F.lower(F.regexp_extract(url, r"(?i)\.(pdf|docx?|xlsx?|html?)(?:\?|$)", 1))
    return F.when(found != "", found).when(url.rlike("getFile|/download/|urn\\.kb\\.se"), "pdf?").otherwise("html")


def change_kinds(text: Column) -> Column:
    low = F.lower(text)
    found = F.array_compact(F.array(*(F.when(low.rlike(f"(?dU){p}"), name) for name, p in CHANGES)))
    return F.when(F.size(found) > 0, found).otherwise(F.array(F.lit("other")))


def timing(text: Column) -> Column:
    planned, done = (F.lower(text).rlike(f"(?dU){p}") for p in (PLANNED, EFFECTIVE))
    return F.when(planned & done, "mixed").when(planned, "planned").when(done, "source_claimed_effective").otherwise("unclear")


def effective_date(text: Column) -> Column:
    """The first day that is tied to the change itself; NULL where that is no date."""
    return F.try_to_date(F.regexp_extract(F.lower(text), f"(?dU){EFFECTIVE_DAY}", 1), "yyyy-MM-dd")


# --- names ------------------------------------------------------------------

# Fixed value: an abbreviation at the end of a name.
ABBREVIATION = r"\s*\(([^()]{1,15})\)\s*$"


def abbreviation(c: Column) -> Column:
    return F.nullif(F.trim(F.regexp_extract(c, ABBREVIATION, 1)), F.lit(""))


# Fixed value: what pages put before the name of a responsible agency.
AGENCY_PREFIX = r"(?i)^\s*statistikansvarig\s+myndighet\s*:\s*"


@F.pandas_udf(T.StringType())
def norm_agency(s: pd.Series) -> pd.Series:
    """An agency's name without prefix and abbreviation, NFC, case-folded; NULL if nothing is left."""
    bare = s.astype("string").str.normalize("NFC").str.replace(AGENCY_PREFIX, "", regex=True).str.replace(ABBREVIATION, "", regex=True)
    bare = bare.str.casefold().str.split().str.join(" ")
    return bare.mask(bare == "").astype("object").where(bare.notna(), None)


def slug(c: Column) -> Column:
    plain = F.translate(F.lower(F.regexp_replace(c, ABBREVIATION, "")), "åäöéèü", "aaoeeu")
    return F.btrim(F.regexp_replace(plain, r"[^a-z0-9]+", "_"), F.lit("_"))


def split_names(c: Column) -> Column:
    """Names between comma and blank; a comma alone is part of a name."""
    return F.filter(F.transform(F.split(c, ", "), lambda x: F.trim(x)), lambda x: x != "")


# --- identity ----------------------------------------------------------------

@F.pandas_udf(T.StringType())
def json_digest(rows: pd.DataFrame) -> pd.Series:
    """SHA-256 of each struct as JSON with sorted keys, for identities shared with other programs."""
    return pd.Series([hashlib.sha256(json.dumps(r, sort_keys=True, ensure_ascii=False, default=list).encode()).hexdigest() for r in rows.to_dict("records")])


def row_key(columns: list[str]) -> Column:
    """A native identity over all the columns, NULLs told apart from empty text."""
    return F.sha2(F.to_json(F.struct(*sorted(columns)), {"ignoreNullFields": "false"}).cast("binary"), 256)


# --- dates -------------------------------------------------------------------

def iso_date(c: Column) -> Column:
    return F.when(c.rlike(r"^\d{4}-\d{2}-\d{2}\z"), F.try_to_date(c, "yyyy-MM-dd"))


def first_iso_date(c: Column) -> Column:
    return F.nullif(F.regexp_extract(c, r"(\d{4}-\d{2}-\d{2})", 1), F.lit(""))


def is_active(last: Column, as_of: Column, days: int = 366) -> Column:
    return F.coalesce(last >= F.date_sub(as_of, days), F.lit(False))


def split_range(start: Column, end: Column, n: int) -> Column:
    """A range of days as n ranges of near-equal length that leave no day out."""
    days = F.datediff(end, start) + 1
    return F.filter(F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda k: F.struct(F.date_add(start, F.floor(days * k / n).cast("int")).alias("from"), F.date_add(start, F.floor(days * (k + 1) / n).cast("int") - 1).alias("to"))), lambda r: r["from"] <= r["to"])


def source_status(source: Column, state: dict) -> Column:
    """fresh, retained or legacy, by a run's ``last_failures``, ``attempted_sources`` and ``selected_agencies``.

    A source is a family, or family/agency. What failed, was not attempted or
    was not among the selected agencies is what an earlier run left.
    """
    failed, attempted, selected = (list(state.get(k) or []) for k in ("last_failures", "attempted_sources", "selected_agencies"))
    family, agency = F.substring_index(source, "/", 1), F.regexp_extract(source, r"^[^/]*/(.*)$", 1)
    out = F.when(family.isin(*failed) | source.isin(*failed), "retained") if failed else F.when(F.lit(False), "retained")
    if not attempted:
        return out.otherwise("legacy")
    out = out.when(~family.isin(*attempted), "retained")
    if selected:
        out = out.when((family == "sam") & ~agency.isin(*selected), "retained")
    return out.otherwise("fresh")
