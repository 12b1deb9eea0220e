"""Column functions against hand-computed values."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from scholarlake.functions import html
from scholarlake.functions import scalars as S


def one(spark, value, *columns, kind="string"):
    row = spark.createDataFrame([(value,)], f"v {kind}").select(*(c.alias(f"c{i}") for i, c in enumerate(columns))).first()
    return row[0] if len(columns) == 1 else tuple(row)


@pytest.mark.parametrize("value,want", [("1,234", 1234), ("12.9", 12), ("-12.9", -12), ("-", None), ("x", None), ("", None), ("nan", None), ("inf", None), ("1e30", None), (None, None)])
def test_norm_int(spark, value, want):
    assert one(spark, value, S.norm_int("v")) == want


@pytest.mark.parametrize("value,want", [("104,065", 104.065), ("1,234.5", None), ("-", None), ("", None), ("7", 7.0), (None, None)])
def test_norm_decimal(spark, value, want):
    assert one(spark, value, S.norm_decimal("v")) == want


@pytest.mark.parametrize("value,want", [(" Yes ", True), ("0", False), ("maybe", None), (None, None)])
def test_norm_bool(spark, value, want):
    assert one(spark, value, S.norm_bool("v")) == want


def test_issns(spark):
    assert one(spark, "1542-4863; 0007923x, 12", S.split_issns("v")) == ["15424863", "0007923X"]
    assert one(spark, "1542-4863; 00079235", S.loose_issns("v")) == ["1542-4863;", "00079235"]
    assert one(spark, "15424863", S.issn_display("v")) == "1542-4863"
    assert one(spark, ["1542-4863"], S.source_issns("v", F.lit("0007-923x")), kind="array<string>") == ["15424863", "0007923X"]
    assert one(spark, None, S.source_issns("v", F.lit(None)), kind="array<string>") == []


def test_subject_names(spark):
    assert one(spark, "Biochemistry, Genetics and Molecular Biology", S.split_subject_names("v")) == ["Biochemistry", "Genetics", "Molecular Biology"]
    assert one(spark, "Medicine; Pharmacology, Toxicology and Pharmaceutics", S.parse_areas("v")) == ["Medicine", "Pharmacology", "Toxicology", "Pharmaceutics"]
    assert one(spark, "and Art; ART ;", S.split_subject_names("v")) == ["Art"]
    assert one(spark, None, S.parse_areas("v")) == ["General"]
    got = one(spark, "Oncology (Q1); Economics, Econometrics and Finance (Q2)", S.parse_categories("v"))
    assert [tuple(r) for r in got] == [("Oncology", "Q1"), ("Economics", "Q2"), ("Econometrics", "Q2"), ("Finance", "Q2")]


def test_best_quartile(spark):
    assert one(spark, ["Q3", "Q1", None], S.best_quartile("v"), kind="array<string>") == "Q1"
    assert one(spark, [], S.best_quartile("v"), kind="array<string>") is None


@pytest.mark.parametrize("name,kind,want", [("Western Europe", "region", ["WE", "WEU"]), ("New Land", "region", ["NL", "NLR"]), ("Viet Nam", "country", ["VN", "VNM"]), ("Atlantis", "REGION", ["AT", "ATL"]), ("Nowhere", "country", ["NO", "NOW"])])
def test_zone_codes(spark, name, kind, want):
    assert one(spark, name, S.zone_codes("v", F.lit(kind))) == want


def test_doi_forms(spark):
    assert one(spark, "https://doi.org/10.1/AB/", S.normalize_doi("v", "url"), S.normalize_doi("v", "bare"), S.normalize_doi("v", "raw")) == ("https://doi.org/10.1/ab", "10.1/AB", "10.1/AB/")
    assert one(spark, " ", S.normalize_doi("v")) is None


def test_abstract_and_texts(spark):
    assert one(spark, {"the": [0, 2], "cat": [1]}, S.abstract_from_index("v"), kind="map<string,array<int>>") == "the cat the"
    assert one(spark, " Title ", S.article_text("v", F.lit("Abs."))) == "Title . Abs"
    assert one(spark, None, S.article_text("v", F.lit(None))) == ""
    assert one(spark, "Vol. 12-13", S.volume_number("v")) == 12 and one(spark, "S", S.volume_number("v")) is None
    assert one(spark, '{"text": "short"}', S.tldr_text("v")) == "short" and one(spark, "plain", S.tldr_text("v")) == "plain"
    assert one(spark, "https://orcid.org/0-1", S.orcid_url("v")) == one(spark, "0-1", S.orcid_url("v")) == "https://orcid.org/0-1"
    assert one(spark, [" A ", "", None], S.clean_references("v"), kind="array<string>") == ["a"]
    assert one(spark, None, S.failed_source_label(F.lit("NO_ISSN"), "v")) == "S_NO_ISSN_"


def test_report_order():
    assert S.report_order(["Areas", "x", "Total Docs. (2025)", "SJR", "Rank", "Ref. / Doc."]) == ["Rank", "SJR", "Total Docs. (2025)", "Ref. / Doc.", "Areas", "x"]


PAGE = """<meta name="citation_title" content="A &amp; B"><meta name="citation_author" content="One"><meta name="citation_author" content="Two">
<meta name="citation_doi" content="doi:10.1/x"><meta name="citation_keywords" content="a; b, a"><meta name="citation_publication_date" content="May 2019">
<a href="/issue/view/1">Issue <b>one</b></a><a href="/issue/view/2">PDF</a><a href="/article/view/7">An article</a><a href='/article/view/7/9'>PDF</a><a href="/article/view/7">Again</a>"""


def test_pages(spark):
    pages = spark.createDataFrame([(1, "http://h.org/archive", PAGE), (2, "http://h.org/", None), (3, "http://h.org/", "no tags")], "page_id long, url string, html string")
    links = html.page_links(pages)
    assert sorted(r["link"] for r in links.collect()) == ["http://h.org/article/view/7", "http://h.org/article/view/7/9", "http://h.org/issue/view/1", "http://h.org/issue/view/2"]
    assert [tuple(r) for r in html.issue_links(links).select("link", "label").collect()] == [("http://h.org/issue/view/1", "Issue one")]
    assert [tuple(r) for r in html.article_links(links).select("link", "title", "pdf_link").collect()] == [("http://h.org/article/view/7", "An article", None)]
    d = html.article_details(pages).where("page_id = 1").first()
    assert (d["title"], d["authors"], d["keywords"], d["doi"], d["publication_year"]) == ("A & B", ["One", "Two"], ["a", "b"], "10.1/x", 2019)
    assert html.page_text(pages).where("page_id = 2").first()["text"] == ""


def test_meta_tags_by_property(spark):
    head = [
        '<META property="og:title" content="Only &amp; here">',
        "<meta property='og:title' content='Second'><meta name='citation_title' content='First'>",
        '<meta name="x" property="og:title" content="Last key counts">',
        '<meta charset="utf-8"><meta content="Reversed" property="og:title">',
    ]
    pages = spark.createDataFrame(list(enumerate(head)), "page_id long, html string")
    assert {r["page_id"]: r["title"] for r in html.article_details(pages).collect()} == {0: "Only & here", 1: "First", 2: "Last key counts", 3: None}


def test_python_sees_entities_alone(spark, monkeypatch):
    import html as plain

    from pyspark.sql import functions as F

    from scholarlake.functions import html

    texts = ["", "&amp", "&amp;lt;", "a &lt;b&gt; &notit; &#39;&#x41;&#65 &#0; &#xD800; &bogus; & x &&amp;", "&NewLine;|&#10;", "&" + "a" * 40, "é&eacute;😀&#128512;", "x" * 100_000 + "&copy;", None, "&#;&#x;", "&lt", "a&amp;b" * 50]
    got = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, t string").select("i", html.html_unescape(F.col("t")).alias("t")).collect()
    assert {r["i"]: r["t"] for r in got} == {i: None if t is None else plain.unescape(t) for i, t in enumerate(texts)}
    sent = spark.createDataFrame([("x" * 100_000 + "&copy;",)], "t string").select(html.html_unescape(F.col("t")))
    assert "regexp_extract_all" in sent._jdf.queryExecution().optimizedPlan().toString().split("ArrowEvalPython")[1]


def test_categories_are_split_once_for_many_names(spark):
    import time

    names = [f"Name {i}" for i in range(300)]
    began = time.perf_counter()
    got = one(spark, ", ".join([*names, "name 7"]) + " (Q2)", S.parse_categories("v"))
    assert [(x["name"], x["quartile"]) for x in got] == [(n, "Q2") for n in names]
    assert time.perf_counter() - began < 30  # names parsed anew at each element take minutes
