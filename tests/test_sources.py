import json

import fake_services as fake
import pytest

from papyrine import cli, plans
from papyrine.sources import REGISTRY, readers, requests
from papyrine.sources.transport import RateLimiter, RequestFailed, retried


def read(reader_class, transport, **options):
    fake.CALLS.clear()
    r = reader_class({"transport": f"fake_services:{transport}", "rate": "0", "query": "q"} | {k: str(v) for k, v in options.items()})
    return [row for p in r.partitions() for row in r.read(p)]


def test_requests():
    assert requests.pubmed_search("q", None, None)["params"].get("datetype") is None
    p = requests.pubmed_search("q", "2020-01-01", None)["params"]
    assert p["mindate"] == "2020-01-01" and "maxdate" not in p and p["datetype"] == "pdat"
    body = requests.patentsview_body("q", 10)
    assert set(body["q"]) == {"_or"} and body["o"] == {"size": 10} and len(body["f"]) == 8
    body = requests.patentsview_body("q", 10, None, "2020-12-31", "c")
    assert body["q"]["_and"][1] == {"_lte": {"patent_date": "2020-12-31"}} and body["o"]["after"] == "c"
    assert requests.cql('a "b"', "2020", "2021") == 'ta = "a \\"b\\"" AND cl = "A61K" AND pd >= "2020" AND pd <= "2021"'
    assert requests.search_api("q", 0, "k", None, "2020")["params"]["before"] == "2020"
    assert requests.search_html("q", 1, "2020", None)["params"] == {"q": "q", "page": 1, "after": "priority:2020"}


def test_pubmed_ranges():
    rows = read(readers.PubmedReader, "pubmed", max_results=1100)
    assert [(c["params"]["retstart"], c["params"]["retmax"]) for c in fake.CALLS[1:]] == [(0, 500), (500, 500), (1000, 100)]
    assert len(rows) == 1100 and rows[0][2].startswith("PMID- 0")


def test_pubmed_pace(monkeypatch):
    now, sent = [0.0], []

    def sleep(s):
        now[0] += s

    monkeypatch.setattr(readers, "RateLimiter", lambda rate: RateLimiter(rate, lambda: now[0], sleep))
    monkeypatch.setattr(fake, "pubmed", lambda request, answer=fake.pubmed: sent.append(now[0]) or answer(request))
    assert len(read(readers.PubmedReader, "pubmed", max_results=1203, rate=4)) == 1203 and sent == [0.0, 0.25, 0.5, 0.75]


def test_cursor_counts_valid_records():
    rows = read(readers.UsptoReader, "patents_two_pages", max_results=3)
    assert [json.loads(r[2])["patent_title"] for r in rows] == ["Compound 0", "Compound 1", "Compound 3"]
    assert len(fake.CALLS) == 2 and fake.CALLS[1]["json"]["o"] == {"size": 1, "after": "c1"}
    assert len(read(readers.UsptoReader, "patents_two_pages", max_results=100)) == 4


def test_office_stops():
    assert read(readers.EpoReader, "office", max_results=250) == []
    key = {"key": "k", "secret": "s"}
    read(readers.EpoReader, "office", max_results=250, **key)
    assert [c["params"]["Range"] for c in fake.CALLS[1:]] == ["1-100", "101-200", "201-250"]
    assert len(read(readers.EpoReader, "office_with_a_gap", max_results=250, **key)) == 1  # a page that isn't full of titles ends it
    assert len(read(readers.EpoReader, "office_down", max_results=250, **key)) == 1


def test_google_pages():
    rows = read(readers.GooglePatentsReader, "google_api", max_results=5, api_key="k")
    assert [json.loads(r[2])["title"] for r in rows] == ["G01", "G02", "G03", "G11", "G12"]
    assert len(read(readers.GooglePatentsReader, "google_api", max_results=50, api_key="k")) == 6
    assert len(read(readers.GooglePatentsReader, "google_html", max_results=50)) == 1


def test_limiter_and_retry():
    now, slept = [0.0], []

    def sleep(s):
        slept.append(s)
        now[0] += s

    pace = RateLimiter(4, lambda: now[0], sleep)
    for _ in range(3):
        pace.wait()
    assert slept == [0.25, 0.25]
    waits, calls = [], []

    def failing():
        calls.append(1)
        raise RequestFailed("no")

    with pytest.raises(RequestFailed):
        retried(failing, attempts=5, wait=20, sleep=waits.append)
    assert len(calls) == 5 and waits == [20, 40, 60, 60]
    with pytest.raises(ValueError):
        retried(lambda: int("x"), sleep=waits.append)


def test_resolve():
    assert plans.resolve("all") == ["pubmed", "google_patents", "uspto", "epo"] == list(REGISTRY)
    assert plans.resolve("epo, pubmed,epo") == ["epo", "pubmed", "epo"]
    with pytest.raises(plans.UnknownSource):
        plans.resolve("pubmed,nowhere")


def test_scrape_end_to_end(spark, tmp_path, monkeypatch):
    monkeypatch.setenv("OUTPUT_DIR", str(tmp_path / "data"))
    for k in ("NCBI_API_KEY", "SERPAPI_KEY", "EPO_KEY"):
        monkeypatch.delenv(k, raising=False)
    said = []
    more = {"rate": "0"}
    out = tmp_path / "all.jsonl"
    assert cli.scrape(spark, "uspto", "q", 3, output=str(out), say=said.append, transport="fake_services:patents_two_pages", **more) == 3
    assert cli.scrape(spark, "pubmed", "q", 10, output=str(out), say=said.append, transport="fake_services:pubmed", **more) == 9  # the one without a title isn't replaced
    assert cli.scrape(spark, "epo", "q", 3, output=str(out), say=said.append, **more) == 0 and "epo: no results" in said
    assert cli.scrape(spark, "google_patents", "q", 3, say=said.append, transport="fake_services:google_html", **more) == 1
    from papyrine import storage

    assert storage.count_documents(spark, out) == 12 and storage.count_documents(spark, tmp_path / "data" / "google_patents.jsonl") == 1
    assert {r["source"]: r["n"] for r in plans.counts(storage.read_documents(spark, out)).collect()} == {"uspto": 3, "pubmed": 9, None: 12}


def test_info_hides_keys(capsys, monkeypatch):
    monkeypatch.setenv("USPTO_API_KEY", "secret-value")
    cli.main(["info"])
    said = capsys.readouterr().out
    assert "USPTO key: set" in said and "secret-value" not in said
