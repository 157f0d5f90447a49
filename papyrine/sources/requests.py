"""Remote queries: what is pushed to each service.  Bounds are inclusive YYYY-MM-DD texts, each on its own."""

from __future__ import annotations

EUTILS = "https://eutils.ncbi.nlm.nih.gov/entrez/eutils/"
PATENTSVIEW = "https://search.patentsview.org/api/v1/patent/"
OPS = "https://ops.epo.org/3.2/rest-services/published-data/search/biblio"
OPS_TOKEN = "https://ops.epo.org/3.2/auth/accesstoken"
SEARCH_API = "https://serpapi.com/search"
SEARCH_HTML = "https://patents.google.com/"
PATENT_FIELDS = ("patent_id", "patent_title", "patent_abstract", "patent_date", "inventors.inventor_name_last", "inventors.inventor_name_first", "assignees.assignee_organization", "cpc_current.cpc_group_id")


def pubmed_search(query: str, date_from: str | None, date_to: str | None, email: str | None = None, key: str | None = None) -> dict:
    params = {"db": "pubmed", "term": query, "retmax": 0, "usehistory": "y", "retmode": "json"}
    params |= {k: v for k, v in (("mindate", date_from), ("maxdate", date_to), ("email", email), ("api_key", key)) if v}
    if date_from or date_to:
        params["datetype"] = "pdat"
    return {"url": EUTILS + "esearch.fcgi", "params": params}


def pubmed_fetch(web_env: str, query_key: str, start: int, size: int, email: str | None = None, key: str | None = None) -> dict:
    params = {"db": "pubmed", "rettype": "medline", "retmode": "text", "retstart": start, "retmax": size, "webenv": web_env, "query_key": query_key}
    return {"url": EUTILS + "efetch.fcgi", "params": params | {k: v for k, v in (("email", email), ("api_key", key)) if v}}


def patentsview_body(query: str, size: int, date_from: str | None = None, date_to: str | None = None, cursor: str | None = None) -> dict:
    wanted: dict = {"_or": [{"_text_phrase": {c: query}} for c in ("patent_abstract", "patent_title")]}
    bounds = {op: {"patent_date": day} for op, day in (("_gte", date_from), ("_lte", date_to)) if day}
    options = {"size": size} | ({"after": cursor} if cursor else {})
    return {"q": {"_and": [wanted, bounds]} if bounds else wanted, "f": list(PATENT_FIELDS), "o": options}


def cql(query: str, date_from: str | None = None, date_to: str | None = None) -> str:
    """Quotes and backslashes in the query are escaped."""
    quoted = query.replace("\\", "\\\\").replace('"', '\\"')
    parts = [f'ta = "{quoted}"', 'cl = "A61K"']
    parts += [f'pd {op} "{day}"' for op, day in ((">=", date_from), ("<=", date_to)) if day]
    return " AND ".join(parts)


def search_api(query: str, page: int, key: str, date_from: str | None = None, date_to: str | None = None) -> dict:
    params = {"engine": "google_patents", "q": query, "api_key": key, "page": page}
    return {"url": SEARCH_API, "params": params | {k: v for k, v in (("after", date_from), ("before", date_to)) if v}}


def search_html(query: str, page: int, date_from: str | None = None, date_to: str | None = None) -> dict:
    bounds = {k: f"priority:{v}" for k, v in (("after", date_from), ("before", date_to)) if v}
    return {"url": SEARCH_HTML, "params": {"q": query, "page": page} | bounds, "timeout": 15}
