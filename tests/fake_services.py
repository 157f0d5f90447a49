"""Transports that answer from made-up payloads; calls are logged in CALLS."""

import json

CALLS = []


def patent(n, title=True):
    return {"patent_id": f"9{n:04d}", "patent_title": f"Compound {n}" if title else "", "patent_date": "2021-06-01", "inventors": [{"inventor_name_first": "Ada", "inventor_name_last": f"L{n}"}]}


def patents_two_pages(request):
    """Two pages by cursor; the third record has no title."""
    CALLS.append(request)
    after = request["json"]["o"].get("after")
    if after is None:
        return 200, json.dumps({"patents": [patent(0), patent(1), patent(2, False)], "cursor": "c1"})
    return 200, json.dumps({"patents": [patent(3), patent(4)], "cursor": None})


def pubmed(request):
    CALLS.append(request)
    if "esearch" in request["url"]:
        return 200, json.dumps({"esearchresult": {"count": "1203", "webenv": "W", "querykey": "1"}})
    lo, n = request["params"]["retstart"], request["params"]["retmax"]
    return 200, "\n".join(f"\nPMID- {i}\n" + ("" if i % 100 == 7 else f"TI  - Study {i}\n") for i in range(lo, lo + n))


def exchange(titles):
    docs = "".join(f"<exchange-document><bibliographic-data>{'<invention-title>%s</invention-title>' % t if t else ''}</bibliographic-data></exchange-document>" for t in titles)
    return f'<w xmlns:o="http://ops.epo.org" xmlns="http://www.epo.org/exchange"><o:search-result><exchange-documents>{docs}</exchange-documents></o:search-result></w>'


def _office(request, page):
    CALLS.append(request)
    if "accesstoken" in request["url"]:
        return 200, '{"access_token": "t"}'
    lo, hi = map(int, request["params"]["Range"].split("-"))
    return page(lo, hi)


def office(request):
    return _office(request, lambda lo, hi: (200, exchange([f"T{i}" for i in range(lo, hi + 1)])))


def office_with_a_gap(request):
    return _office(request, lambda lo, hi: (200, exchange([None if i == 5 else f"T{i}" for i in range(lo, hi + 1)])))


def office_down(request):
    def page(lo, hi):
        if lo > 1:
            raise OSError("down")
        return 200, exchange([f"T{i}" for i in range(lo, hi + 1)])

    return _office(request, page)


def google_api(request):
    CALLS.append(request)
    page = request["params"]["page"]
    if page > 1:
        return 200, "{}"
    return 200, json.dumps({"organic_results": [{"title": f"G{page}{i}" if i else "", "patent_id": f"US{page}{i}"} for i in range(4)]})


def google_html(request):
    CALLS.append(request)
    if request["params"]["page"] > 0:
        return 503, ""
    return 200, '<article class="result"><h3> A <b>drug</b></h3><a href="/patent/US7/en">x</a><p>about</p></article><article class="result"></article>'
