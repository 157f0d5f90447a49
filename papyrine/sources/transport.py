"""What readers need to talk to a service: requests, minimum intervals, retries.

A transport is a function from a request (a dict with method, url, and params, json,
form or headers) to (status, body).  Readers import it by the name in their
`transport` option, so recorded payloads can stand for a service.
"""

from __future__ import annotations

import importlib
import json
import threading
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable

Transport = Callable[[dict], tuple[int, str]]


class RequestFailed(ConnectionError):
    """A status other than success where the source asks for one."""


def load(name: str) -> Transport:
    """The transport that `module:function` names."""
    module, _, function = name.partition(":")
    return getattr(importlib.import_module(module), function)


def http(request: dict) -> tuple[int, str]:
    """Send a request; statuses other than 2xx are returned, not raised."""
    url = request["url"] + ("?" + urllib.parse.urlencode(request["params"]) if request.get("params") else "")
    headers, data = dict(request.get("headers", {})), None
    if "json" in request:
        data, headers["Content-Type"] = json.dumps(request["json"]).encode(), "application/json"
    elif "form" in request:
        data = urllib.parse.urlencode(request["form"]).encode()
    ask = urllib.request.Request(url, data, headers, method=request.get("method", "GET"))
    try:
        with urllib.request.urlopen(ask, timeout=request.get("timeout", 30)) as reply:
            return reply.status, reply.read().decode("utf-8", "replace")
    except urllib.error.HTTPError as e:
        return e.code, e.read().decode("utf-8", "replace")


class RateLimiter:
    """At least 1 / rate seconds between calls; waiting threads queue."""

    def __init__(self, rate: float, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep):
        self.interval, self._clock, self._sleep = 1.0 / rate, clock, sleep
        self._next, self._lock = float("-inf"), threading.Lock()

    def wait(self) -> None:
        with self._lock:
            if (left := self._next - self._clock()) > 0:
                self._sleep(left)
            self._next = self._clock() + self.interval


def retried(call: Callable, attempts: int = 5, wait: float = 1, most: float = 60, sleep: Callable[[float], None] = time.sleep):
    """call(), again after connection failures and timeouts, with doubling waits; the last failure is raised."""
    for n in range(attempts):
        try:
            return call()
        except (ConnectionError, TimeoutError, urllib.error.URLError):
            if n + 1 == attempts:
                raise
            sleep(min(most, wait * 2**n))
