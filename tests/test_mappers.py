import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from papyrine.functions import scalars as S
from papyrine.operators import mappers
from papyrine.operators.markup import html_results, xml_documents


def rows(spark, texts, mapper):
    df = spark.createDataFrame([(t,) for t in texts], "payload string")
    return mapper(df).select("*", F.to_json("metadata").alias("m")).drop("metadata", "scraped_at").collect()


def values(spark, texts, f):
    return [r[0] for r in spark.createDataFrame([(t,) for t in texts], "x string").select(f(F.col("x"))).collect()]


def test_medline_dates(spark):
    cases = {
        "2024 Mar 15": date(2024, 3, 15), "2024 Jan": date(2024, 1, 1), "2024": date(2024, 1, 1), "": None, "invalid": None, "2024 Jan-Feb": date(2024, 1, 1),
        "2024 Spring": date(2024, 1, 1), "2024 Mar 15-20": None, "2024 Feb 30": None, "   ": None, "0000 Jan 1": None, None: None, "\t2023  Dec 31": date(2023, 12, 31),
    }
    assert values(spark, cases, S.medline_date) == list(cases.values())


def test_iso_and_compact_dates(spark):
    cases = {"2024-01-15": date(2024, 1, 15), "20240115": date(2024, 1, 15), "2024-1-5": None, "2024": None, "2024-01-15T10:00:00": None, "2024-02-30": None, "0000-01-01": None, "": None, None: None}
    assert values(spark, cases, S.iso_date) == list(cases.values())
    cases = {"20240115": date(2024, 1, 15), "2024011": None, "202401155": None, "20241301": None, "2024 115": None, None: None}
    assert values(spark, cases, S.compact_date) == list(cases.values())


def test_chemical_headings(spark):
    yes = ["Aspirin/*pharmacology", "X/CHEMISTRY", "*X/metabolism", "X/chemical synthesis", "X/therapeutic use", "X/toxicity/history"]
    assert values(spark, yes + ["Humans", "X/ethics", "pharmacology"], S.is_chemical_heading) == [True] * 6 + [False] * 3
    assert values(spark, ["*Aspirin*/*chemistry", "**Zinc**", "a/b/c"], S.chemical_entity) == ["Aspirin*", "Zinc", "a"]


MEDLINE = """
PMID- 101
TI  - A long title that
      goes on
AB  - What was found.
AU  - Roe R
AU  - Poe P
DP  - 2022 Jul 4
JT  - Journal of Things
MH  - *Caffeine/pharmacology
MH  - Humans
OT  - tea
AID - S1 [pii]
AID - 10.9/a [doi]
AID - 10.9/b[doi]
PT  - Review
LA  - eng

PMID- 102
AB  - no title

TI  - Only a title
"""


def test_medline(spark):
    full, bare = rows(spark, [MEDLINE], lambda d: mappers.medline(mappers.medline_records(d)))
    assert full.title == "A long title that goes on" and full.abstract == "What was found." and full.publication_date == date(2022, 7, 4)
    assert [a.name for a in full.authors] == ["Roe R", "Poe P"] and full.authors[0].affiliation is None
    assert [tuple(i) for i in full.identifiers] == [("pmid", "101"), ("doi", "10.9/a"), ("doi", "10.9/b[doi]")]
    assert full.chemical_entities == ["Caffeine"] and full.keywords == ["tea"] and full.journal_or_office == "Journal of Things"
    assert full.full_text_url == "https://pubmed.ncbi.nlm.nih.gov/101/"
    assert json.loads(full.m) == {"mesh_headings": ["*Caffeine/pharmacology", "Humans"], "publication_type": ["Review"], "language": ["eng"]}
    assert bare.title == "Only a title" and bare.full_text_url is None and bare.identifiers == [] and bare.publication_date is None


def test_patentsview(spark):
    full = {
        "patent_id": "11", "patent_title": "Salt", "patent_abstract": "", "patent_date": "2020-02-03", "assignees": [{"assignee_organization": "Org"}, {"assignee_organization": None}],
        "inventors": [{"inventor_name_first": "A", "inventor_name_last": "B"}, {"inventor_name_last": "C"}, {"inventor_name_first": "D", "inventor_name_last": None}, {}], "cpc_current": [{"cpc_group_id": "A61K"}, {"cpc_group_id": ""}],
    }
    found = rows(spark, [json.dumps(x) for x in (full, {"patent_title": ""}, {"patent_title": None}, {"patent_title": "Bare", "patent_id": "", "inventors": None})], mappers.patentsview)
    assert [d.title for d in found] == ["Salt", "Bare"]
    assert [a.name for a in found[0].authors] == ["A B", "C", "D"] and found[0].abstract == "" and found[0].publication_date == date(2020, 2, 3)
    assert json.loads(found[0].m) == {"cpc_codes": ["A61K"], "assignees": ["Org"]} and found[0].full_text_url.endswith("/patent/US11")
    assert found[1].identifiers == [] and found[1].authors == [] and found[1].full_text_url is None and found[1].journal_or_office == "USPTO"


@pytest.mark.parametrize(
    "given, url, office, day",
    [
        ({"pdf": "p", "link": "l"}, "p", "", None),
        ({"pdf": None, "link": "l"}, None, "", None),
        ({"link": "l", "assignee": None}, "l", None, None),
        ({"assignee": "Org", "priority_date": "", "filing_date": "2020-01-02"}, None, "Org", date(2020, 1, 2)),
        ({"priority_date": "soon", "filing_date": "2020-01-02"}, None, "", None),
    ],
)
def test_search_api(spark, given, url, office, day):
    (d,) = rows(spark, [json.dumps({"title": "T", "patent_id": "US1", "inventor": "A, B"} | given), '{"title": ""}', "{}"], mappers.search_api)
    assert (d.full_text_url, d.journal_or_office, d.publication_date) == (url, office, day)
    assert d.authors[0].name == "A, B" and json.loads(d.m) == {"grant_date": None, "thumbnail": None}


XML = """<w xmlns:o="http://ops.epo.org" xmlns="http://www.epo.org/exchange"><o:search-result><exchange-documents>
<exchange-document><bibliographic-data><publication-reference><document-id><country>EP</country><doc-number>55</doc-number><kind>B1</kind><date>20190807</date></document-id><document-id><doc-number>1</doc-number></document-id></publication-reference>
<classifications-ipcr><classification-ipcr><text> A61K 31/00 </text></classification-ipcr></classifications-ipcr><invention-title lang="de">Neu</invention-title><invention-title lang="en">New <i>in vivo</i> drug</invention-title>
<parties><applicants><applicant><applicant-name><name>Org</name></applicant-name></applicant></applicants></parties></bibliographic-data><abstract lang="fr"><p>fr</p></abstract><abstract lang="en"><p>one</p><p>two</p></abstract></exchange-document>
<exchange-document><bibliographic-data><invention-title lang="fr">Autre</invention-title></bibliographic-data></exchange-document>
<exchange-document><bibliographic-data><invention-title lang="en"/><invention-title lang="fr">X</invention-title></bibliographic-data></exchange-document>
<exchange-document><bibliographic-data><invention-title lang="en"><i>first</i> tail</invention-title></bibliographic-data></exchange-document>
</exchange-documents></o:search-result></w>"""


def test_exchange_xml(spark):
    a, b = rows(spark, [XML, "<broken", None], mappers.exchange_xml)
    assert (a.title, a.abstract, a.publication_date, a.identifiers[0].value) == ("New ", "one", date(2019, 8, 7), "EP55B1")
    assert a.authors[0].name == "Org" and json.loads(a.m) == {"ipc_codes": ["A61K 31/00"]} and a.full_text_url is None
    assert (b.title, b.abstract, b.identifiers, b.publication_date) == ("Autre", None, [], None)
    assert xml_documents("") == []


def test_search_html(spark):
    page = (
        '<div><search-result-item><h3> A <b>b</b> </h3><a href="/other">o</a><a href="/patent/US5B2/en?x=1">l</a><p class="abstract">sum</p></search-result-item>'
        f'<article class="x result"><span data-title>D</span><a href="https://h/patent/EP9?q">l</a><p></p></article><article class="result">{"w" * 300}</article><article class="result"> </article></div>'
    )
    a, b, c = rows(spark, [page, "<p>nothing</p>", None], mappers.search_html)
    assert (a.title, a.full_text_url, a.identifiers[0].value, a.abstract) == ("Ab", "https://patents.google.com/patent/US5B2/en?x=1", "US5B2", "sum")
    assert (b.title, b.full_text_url, b.identifiers[0].value, b.abstract) == ("D", "https://h/patent/EP9?q", "EP9?q", "")
    assert c.title == "w" * 200 and c.identifiers == [] and c.full_text_url is None and c.abstract is None
    assert [r["title"] for r in html_results('<li data-result="1"><h3>Z</h3></li>')] == ["Z"]
    assert html_results("<div></div>") == []


def test_deep_pages():
    from papyrine.operators.markup import first_text, html_results

    page = '<article class="result">' + "<div>" * 5000 + "<h3>a<b>c</b></h3>" + "</div>" * 5000 + "</article>"
    assert html_results(page)[0]["title"] == "ac" and first_text(page, "h3") == "ac"
