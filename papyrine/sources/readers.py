"""Python data sources: one row (page, seq, payload) for each raw payload of a service.

Only the payloads are read here; mappers make documents of them, so mapping can be
repeated offline.  A limit above a Python data source isn't pushed into it, hence
the max_results option.  Options: query, max_results, date_from, date_to, transport,
keys of the service, and rate (requests a second; 0 for no limit).
"""

from __future__ import annotations

import base64
import json
import logging
import re
from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from papyrine.operators.markup import html_results, xml_documents
from papyrine.sources import requests as R
from papyrine.sources.transport import RateLimiter, RequestFailed, load, retried

SCHEMA = "page int, seq int, payload string"
PUBMED_BATCH = 500
PAGE = 100
Row = tuple[int, int, str]


class _Reader(DataSourceReader):
    rate = 1.0

    def __init__(self, options):
        self.o = {k.lower(): v for k, v in options.items()}
        self.query = self.o.get("query", "")
        self.limit = int(self.o.get("max_results", 100))
        self.bounds = (self.o.get("date_from") or None, self.o.get("date_to") or None)

    def limiter(self) -> RateLimiter:
        rate = float(self.o.get("rate", self.rate))
        return RateLimiter(rate if rate > 0 else 1e9)

    def send(self, request: dict) -> tuple[int, str]:
        return load(self.o.get("transport", "papyrine.sources.transport:http"))(request)

    def partitions(self):
        return [InputPartition(0)]

    @staticmethod
    def warn(text: str, *args) -> None:
        logging.getLogger("papyrine").warning(text, *args)


class PubmedReader(_Reader):
    """A counting request, then ranges of 500 raw records; max_results bounds raw records.

    The ranges are one partition: tasks can't share a limiter, and the service
    allows few requests a second in all.
    """

    def __init__(self, options):
        super().__init__(options)
        self.who = (self.o.get("email") or None, self.o.get("api_key") or None)
        self.rate = 10.0 if self.who[1] else 3.0

    def partitions(self):
        status, body = self.send(R.pubmed_search(self.query, *self.bounds, *self.who))
        if status != 200:
            raise RequestFailed(f"search gave status {status}")
        found = json.loads(body)["esearchresult"]
        n = min(int(found["count"]), self.limit)
        return [InputPartition((n, found["webenv"], found["querykey"]))]

    def read(self, partition) -> Iterator[Row]:
        n, web_env, key = partition.value
        pace = self.limiter()
        pace.wait()  # the counting request was just sent
        for page, start in enumerate(range(0, n, PUBMED_BATCH)):
            pace.wait()
            status, body = self.send(R.pubmed_fetch(web_env, key, start, min(PUBMED_BATCH, n - start), *self.who))
            if status != 200:
                raise RequestFailed(f"fetch gave status {status}")
            records = [r for r in re.split(r"\r?\n[^\S\n]*\r?\n", body) if r.strip()]
            for seq, record in enumerate(records):
                yield page, seq, record.strip("\r\n")


class UsptoReader(_Reader):
    """Pages by an opaque cursor; max_results bounds records with a title."""

    rate = 0.75

    def fetch(self, size: int, cursor: str | None) -> dict:
        request = {"method": "POST", "url": R.PATENTSVIEW, "json": R.patentsview_body(self.query, size, *self.bounds, cursor)}
        if self.o.get("api_key"):
            request["headers"] = {"X-Api-Key": self.o["api_key"]}
        status, body = self.send(request)
        if not 200 <= status < 300:
            raise RequestFailed(f"status {status}")
        return json.loads(body)

    def read(self, partition) -> Iterator[Row]:
        pace, cursor, got, page = self.limiter(), None, 0, 0
        while got < self.limit:
            def once(size=min(PAGE, self.limit - got), after=cursor):
                pace.wait()
                return self.fetch(size, after)

            data = retried(once, wait=float(self.o.get("retry_wait", 1)))
            for seq, patent in enumerate((data or {}).get("patents") or []):
                if got < self.limit and patent.get("patent_title"):
                    got += 1
                    yield page, seq, json.dumps(patent)
            cursor, page = (data or {}).get("cursor"), page + 1
            if not cursor or not data.get("patents"):
                return


class EpoReader(_Reader):
    """Ranges of 100; a failure, another status or a page that isn't full ends the search. Without credentials there are no rows."""

    rate = 2.0

    def token(self) -> str:
        basic = base64.b64encode(f"{self.o['key']}:{self.o['secret']}".encode()).decode()
        _, body = self.send({"method": "POST", "url": R.OPS_TOKEN, "form": {"grant_type": "client_credentials"}, "headers": {"Authorization": f"Basic {basic}"}})
        return json.loads(body)["access_token"]

    def read(self, partition) -> Iterator[Row]:
        if not (self.o.get("key") and self.o.get("secret")):
            self.warn("no key and secret: nothing is read from the patent office")
            return
        pace, begin, got, token = self.limiter(), 1, 0, ""
        while got < self.limit:
            end = min(begin + PAGE - 1, self.limit)
            pace.wait()
            try:
                token = token or self.token()
                status, body = self.send({"url": R.OPS, "params": {"q": R.cql(self.query, *self.bounds), "Range": f"{begin}-{end}"}, "headers": {"Authorization": f"Bearer {token}"}})
            except Exception as e:  # whatever was read before a failure counts
                self.warn("range %d-%d: %s", begin, end, e)
                return
            titled = sum(bool(d["title"]) for d in xml_documents(body)) if status == 200 else 0
            if not titled:
                return
            yield (begin - 1) // PAGE, 0, body
            got, begin = got + titled, end + 1
            if titled < PAGE:
                return


class GooglePatentsReader(_Reader):
    """Pages from 0 on, of the API where there is a key, else of HTML; max_results bounds records with a title."""

    def api_page(self, page: int) -> list[tuple[str, int]]:
        _, body = self.send(R.search_api(self.query, page, self.o["api_key"], *self.bounds))
        return [(json.dumps(x), int(bool(x.get("title")))) for x in json.loads(body or "{}").get("organic_results") or []]

    def html_page(self, page: int) -> list[tuple[str, int]]:
        status, body = retried(lambda: self.send(R.search_html(self.query, page, *self.bounds)), attempts=3, wait=float(self.o.get("retry_wait", 1)))
        if status != 200:
            self.warn("page %d gave status %d", page, status)
            return []
        found = html_results(body)
        return [(body, sum(bool(r["title"]) for r in found))] if found else []

    def read(self, partition) -> Iterator[Row]:
        pace, got, page = self.limiter(), 0, 0
        fetch = self.api_page if self.o.get("api_key") else self.html_page
        while got < self.limit:
            pace.wait()
            found = fetch(page)
            if not found:
                return
            for seq, (payload, titled) in enumerate(found):
                if got < self.limit and titled:
                    got += titled
                    yield page, seq, payload
            page += 1


class PubmedSource(DataSource):
    @classmethod
    def name(cls):
        return "pubmed"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return PubmedReader(self.options)


class GooglePatentsSource(PubmedSource):
    @classmethod
    def name(cls):
        return "google_patents"

    def reader(self, schema):
        return GooglePatentsReader(self.options)


class UsptoSource(PubmedSource):
    @classmethod
    def name(cls):
        return "uspto"

    def reader(self, schema):
        return UsptoReader(self.options)


class EpoSource(PubmedSource):
    @classmethod
    def name(cls):
        return "epo"

    def reader(self, schema):
        return EpoReader(self.options)
