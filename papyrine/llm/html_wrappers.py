"""HTML extraction by union-free wrappers, inferred for each host.

A page is a stream of tags and texts.  Adjacent equal groups fold into repeated
ones; streams of the same host are aligned one after another, and what doesn't
match becomes optional, so the wrapper is a regular expression of tags, text slots,
optional and repeated groups without unions.  Equal folded streams are counted
first and aligned once; a host's streams are aligned in parts, and the parts'
wrappers with each other.  Pages are then parsed by their host's wrapper: texts
that are the same on every page belong to the template, all other slots are data.
"""

from __future__ import annotations

import html as html_lib
import json
import re
from collections.abc import Iterator
from difflib import SequenceMatcher

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from papyrine.llm.common import cut

#: Streams (or wrappers) of a host that are aligned in one go; more are aligned in parts, and the parts' wrappers again.
PART_STREAMS = 64
#: A slot is main content if it holds at least this share of the characters of the host's largest data slot.
MAIN_SHARE = 0.1
BROADCAST_CHARS = 30_000_000

#: Group 6 is a "<" that may begin a tag with "<" in a quoted value: such tags are looked at by hand.
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style)\b.*?(?:</\1\s*>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^<>\"']++|\"[^\"<]*+\"|'[^'<]*+')*+)>|(<(?=/?[a-zA-Z]|[!?]))|([^<]+|<)", re.S | re.I)
NAME = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)", re.S)
SPECIAL = re.compile(r"[>\"']")
CLASS = re.compile(r"\bclass\s*=\s*[\"']?\s*([\w-]+)", re.I)
SQUARES = [re.compile(r"(.{%d})\1+" % n, re.S) for n in range(1, 49)]
T = "#"

#: An item is (key, optional, repeated); a key is a tag, T, or a tuple of items.
Item = tuple


class _Ends:
    """Where tags with quoted values end; each place of a page is looked at a bounded number of times."""

    def __init__(self, page: str):
        self.page, self.none = page, set()
        self.last = {q: page.rfind(q) for q in "<>\"'"}

    def tag(self, at: int) -> int:
        """One past the ">" of a tag whose name ends at `at`, or -1."""
        seen = []
        while at not in self.none:
            seen.append(at)
            m = SPECIAL.search(self.page, at) if at <= max(self.last[">"], self.last['"'], self.last["'"]) else None
            if m is None:
                break
            if m.group() == ">":
                return m.end()
            if m.end() > self.last[m.group()]:  # the quote is never closed
                break
            at = self.page.find(m.group(), m.end()) + 1
        self.none.update(seen)
        return -1


def tokens(page: str) -> list[tuple[str, str]]:
    """(tag, "") for tags and (T, text) for texts that aren't blank; comments, scripts and styles are left out.

    The time is in proportion to the page, whatever stands in it.
    """
    out: list[tuple[str, str]] = []
    ends, begin = None, 0

    def add(close: str, name: str, rest: str) -> None:
        name = close + name.lower()
        if not close and (c := CLASS.search(rest)):
            name += "." + c.group(1)
        out.append((name, ""))

    def text(raw: str) -> None:
        value = " ".join(html_lib.unescape(raw).split())
        if value and out and out[-1][0] == T:
            out[-1] = (T, out[-1][1] + " " + value)
        elif value:
            out.append((T, value))

    while begin < len(page):
        for m in TOKEN.finditer(page, begin):
            if m.group(3):
                add(m.group(2), m.group(3), m.group(4))
            elif m.group(5):
                break
            elif m.group(6):
                text(m.group(6))
        else:
            break
        at = m.start()
        ends = ends or _Ends(page)
        if name := NAME.match(page, at):
            end = ends.tag(name.end())
            if end > 0:
                add(name.group(1), name.group(2), page[name.end() : end - 1])
        else:  # a declaration
            end = page.find(">", at) + 1 if at < ends.last[">"] else -1
        if end <= 0 and at >= ends.last["<"]:  # a tag that the page ends in
            break
        if end <= 0:
            text("<")
        begin = end if end > 0 else at + 1
    return out


def base(key) -> str:
    """The key without what is optional or repeated in it."""
    return key if isinstance(key, str) else "(" + " ".join(base(k) for k, _, _ in key) + ")"


def merge(a: Item, b: Item) -> Item:
    """One item for two of the same base."""
    key = a[0] if isinstance(a[0], str) else tuple(merge(x, y) for x, y in zip(a[0], b[0]))
    return (key, a[1] or b[1], a[2] or b[2])


def long_square(codes: np.ndarray) -> tuple[int, list[tuple[int, int]]]:
    """The least period over len(SQUARES) of which codes has two occurrences in a row, and where they begin and end; 0 if there is none.

    A square of period p covers two places that are multiples of p apart from 0, so
    for each p only those are compared, by how far the codes agree from there on
    forwards and backwards (found by halving on hashes of prefixes).
    """
    n, least = len(codes), len(SQUARES) + 1
    if n < 2 * least:
        return 0, []
    p_ = np.full(n + 1, 0x9E3779B97F4A7C15, np.uint64)
    p_[0] = 1
    power = np.cumprod(p_, dtype=np.uint64)
    acc = np.concatenate([np.zeros(1, np.uint64), np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * power[:n], dtype=np.uint64)])
    for lo in range(least, n // 2 + 1, 64):
        periods = np.arange(lo, min(lo + 64, n // 2 + 1))
        each = (n - 1) // periods
        p = np.repeat(periods, each)
        i = (np.arange(len(p)) - np.repeat(np.cumsum(each) - each, each)) * p
        j = i + p
        same = lambda a, b, m: (acc[a + m] - acc[a]) * power[b - a] == acc[b + m] - acc[b]
        reach = []
        for ahead in (True, False):
            low, high = np.zeros(len(p), np.int64), np.minimum(p, n - j) if ahead else np.minimum(p - 1, i)
            while (low < high).any():
                mid = (low + high + 1) // 2
                ok = same(i, j, mid) if ahead else same(i - mid, j - mid, mid)
                low, high = np.where(ok, mid, low), np.where(ok, high, mid - 1)
            reach.append(low)
        good = np.flatnonzero(reach[0] + reach[1] >= p)
        if len(good):
            q = int(p[good].min())
            equal = np.append(codes[:-q] == codes[q:], False)
            edge = np.diff(np.concatenate([[0], equal.astype(np.int8)]))
            out, at = [], 0
            for a, b in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()):
                a = max(a, at)
                if b - a >= q:
                    at = a + ((b - a) // q + 1) * q
                    out.append((a, at))
            return q, out
    return 0, []


def fold(items: list[Item]) -> list[Item]:
    """items with adjacent groups of equal base as one repeated group, whatever their length; shorter ones go first."""
    period = 0
    while True:
        code: dict[str, str] = {}
        s = "".join(code.setdefault(base(i[0]), chr(0x100 + len(code))) for i in items)
        if period < len(SQUARES):
            p, found = period + 1, [m.span() for m in SQUARES[period].finditer(s)]
        else:
            p, found = long_square(np.array([ord(c) for c in s]))
        out, at = [], 0
        for start, stop in found:
            if p == 1 and items[start][0] == T:
                continue
            out += items[at:start]
            body = list(items[start : start + p])
            for lo in range(start + p, stop, p):
                body = [merge(x, y) for x, y in zip(body, items[lo : lo + p])]
            out.append((body[0][0], body[0][1], True) if p == 1 else (tuple(body), False, True))
            at = stop
        items = out + items[at:]
        if not at and period >= len(SQUARES):
            return items
        period = 0 if at else period + 1  # shorter periods go first
        if 2 * (period + 1) > len(items):
            return items


def groups(items: list[Item] | tuple) -> dict[str, tuple]:
    out = {}
    for k, _, _ in items:
        if not isinstance(k, str):
            out |= groups(k)
            out[base(k)] = k
    return out


def regroup(items: list[Item], known: dict[str, tuple]) -> list[Item]:
    """items where single occurrences of known groups are groups."""
    for key in sorted(known.values(), key=lambda k: (-len(k), base(k))):
        want, n, at, out = [base(k) for k, _, _ in key], len(key), 0, []
        have = [base(i[0]) for i in items]
        while at < len(items):
            if have[at : at + n] == want:
                out.append((tuple(items[at : at + n]), False, False))
                at += n
            else:
                out.append(items[at])
                at += 1
        items = out
    return items


def align(a: list[Item], b: list[Item]) -> list[Item]:
    """A wrapper for what either matches: the common items, and the others as optional ones."""
    a, b = regroup(a, groups(b)), regroup(b, groups(a))
    out: list[Item] = []
    matcher = SequenceMatcher(None, [base(i[0]) for i in a], [base(i[0]) for i in b], autojunk=False)
    for what, i, j, k, m in matcher.get_opcodes():
        if what == "equal":
            out += [merge(x, y) for x, y in zip(a[i:j], b[k:m])]
        else:
            out += [(x, True, r) for x, _, r in a[i:j] + b[k:m]]
    return fold(out)


def dump(items: list[Item]) -> str:
    return json.dumps(items, separators=(",", ":"), ensure_ascii=False)


def load(s: str) -> list[Item]:
    back = lambda i: (i[0] if isinstance(i[0], str) else tuple(back(x) for x in i[0]), i[1], i[2])
    return [back(i) for i in json.loads(s)]


def readable(items: list[Item] | tuple) -> str:
    """The wrapper as a regular expression of tags and #, with ?, + and *."""
    mark = {(False, False): "", (True, False): "?", (False, True): "+", (True, True): "*"}
    return " ".join((k if isinstance(k, str) else f"({readable(k)})") + mark[bool(o), bool(r)] for k, o, r in items)


def infer(streams: list[str]) -> str:
    """The wrapper of dumped streams (or wrappers), aligned in this order."""
    out = load(streams[0])
    for s in streams[1:]:
        out = align(out, load(s))
    return dump(out)


class Wrapper:
    """A wrapper that parses pages; slots are numbered in its order."""

    def __init__(self, items: list[Item]):
        self.n = 0
        self.items = [self._number(i) for i in items]

    def _number(self, item: Item) -> tuple:
        key, optional, repeated = item
        if key == T:
            self.n += 1
            return (T, optional, repeated, self.n - 1)
        return (key if isinstance(key, str) else [self._number(i) for i in key], optional, repeated, -1)

    def _one(self, key, slot: int, names: list[str], at: int, got: list[tuple[int, int]]) -> int:
        """Where one occurrence of the key that begins at `at` ends, or -1."""
        if isinstance(key, str):
            if at < len(names) and names[at] == key:
                if key == T:
                    got.append((slot, at))
                return at + 1
            return -1
        mark = len(got)
        for item in key:
            end = self._some(item, names, at, got)
            if end < 0:
                del got[mark:]
                return -1
            at = end
        return at

    def _some(self, item: tuple, names: list[str], at: int, got: list[tuple[int, int]]) -> int:
        key, optional, repeated, slot = item
        first = True
        while first or repeated:
            end = self._one(key, slot, names, at, got)
            if end <= at:
                return at if not first or optional or end == at else -1
            at, first = end, False
        return at

    def parse(self, names: list[str]) -> tuple[bool, list[tuple[int, int]]]:
        """Whether the wrapper matches the whole stream, and (slot, place) of its texts; slot -1 outside the wrapper."""
        got: list[tuple[int, int]] = []
        at, whole = 0, True
        for item in self.items:
            end = self._some(item, names, at, got)
            if end < 0:  # resume where the item comes next, or do without it
                whole = False
                for later in range(at + 1, len(names)):
                    if (end := self._some(item, names, later, got)) > later:
                        got += [(-1, i) for i in range(at, later) if names[i] == T]
                        at = end
                        break
            else:
                at = end
        got += [(-1, i) for i in range(at, len(names)) if names[i] == T]
        return whole and at == len(names), sorted(got, key=lambda x: x[1])


def wrappers(rows: DataFrame) -> DataFrame:
    """(host, wrapper) of rows (host, html)."""

    def streams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [dump(fold([(n, False, False) for n, _ in tokens(p)])) for p in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], names=["host", "stream"])

    counted = rows.select("host", "html").mapInArrow(streams, "host string, stream string").groupBy("host", "stream").count()

    def aligned(key: tuple, table: pa.Table) -> pa.Table:
        rank = sorted(zip(table.column("count").to_pylist(), table.column("stream").to_pylist()), key=lambda x: (-x[0], len(x[1]), x[1]))
        return pa.table({"host": pa.array([key[0].as_py()], pa.string()), "stream": pa.array([infer([s for _, s in rank])], pa.string()), "count": pa.array([sum(c for c, _ in rank)], pa.int64())})

    # a tree: streams are dealt into parts of about PART_STREAMS, the parts' wrappers again, until each host has one
    while True:
        counted = cut(counted)
        n = counted.groupBy("host").agg(F.count("*").alias("n")).withColumn("parts", F.ceil(F.col("n") / F.lit(PART_STREAMS)))
        one = n.agg(F.max("parts")).first()[0]
        part = counted.join(n.select(F.col("host").alias("h"), "parts"), F.col("host").eqNullSafe(F.col("h"))).withColumn("part", F.pmod(F.xxhash64("stream"), "parts")).drop("h")
        counted = part.groupBy("host", "part").applyInArrow(aligned, "host string, stream string, count long")
        if one is None or one <= 1:
            return counted.select("host", F.col("stream").alias("wrapper"))


def _small(hosts: DataFrame) -> DataFrame:
    """hosts, to be broadcast if it has at most about BROADCAST_CHARS bytes, arrays of slots counted; else pages are shuffled by host."""
    slots = [F.coalesce(F.size(c), F.lit(0)) * 8 for c in ("constant", "main") if c in hosts.columns]
    size = hosts.agg(F.sum(sum(slots, F.length("wrapper") + F.length("host") + 100))).first()[0] or 0
    return F.broadcast(hosts) if size <= BROADCAST_CHARS else hosts


def _parsed(batch: pa.RecordBatch, known: dict[str, Wrapper]) -> Iterator[tuple[int, list[tuple[str, str]], bool, list[tuple[int, int]]]]:
    for i, (page, wrapper) in enumerate(zip(batch.column("html").to_pylist(), batch.column("wrapper").to_pylist())):
        if wrapper not in known:
            if len(known) > 500:
                known.clear()
            known[wrapper] = Wrapper(load(wrapper))
        found = tokens(page)
        yield i, found, *known[wrapper].parse([n for n, _ in found])


def extract(pages: DataFrame, main_share: float = MAIN_SHARE) -> DataFrame:
    """(page_id, host, matched, wrapper, slots, fields, content) for every page.

    wrapper is the host's expression; matched whether it covers the whole page;
    slots and fields are parallel arrays of slot numbers and data texts in the order
    of the page (slot -1: outside the wrapper); content joins the texts of the
    host's main slots, a line each.  Text that a slot holds alike on all of two or
    more pages of the host is template and left out.  Null html counts as empty: no fields,
    content ''.  Pages without a host in their url share the host ''.  Repeated rows
    are extracted each; null ids are carried; pages that are alike often enough
    count as often.  A very long page is read whole, in time in proportion to its
    length.  An empty table gives no rows; other columns are ignored.
    """
    hosts = F.coalesce(F.lower(F.regexp_extract(F.coalesce(F.col("url").cast("string"), F.lit("")), r"^\s*(?i:[a-z][a-z0-9+.-]*:)?//(?:[^/@?#]*@)?([^/:?#]+)", 1)), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), hosts.alias("host"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    known = cut(wrappers(rows))
    joined = rows.join(_small(known), "host")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple[str, int], list] = {}
        cache: dict[str, Wrapper] = {}
        for batch in batches:
            hosts_ = batch.column("host").to_pylist()
            for i, found, _, got in _parsed(batch, cache):
                for slot in {s for s, _ in got}:
                    values = [found[p][1] for s, p in got if s == slot]
                    new = [min(values), max(values), 1, sum(map(len, values))]
                    old = seen.setdefault((hosts_[i], slot), new)
                    if old is not new:
                        old[0], old[1], old[2], old[3] = min(old[0], new[0]), max(old[1], new[1]), old[2] + 1, old[3] + new[3]
        host, slot = zip(*seen) if seen else ((), ())
        lo, hi, n, chars = zip(*seen.values()) if seen else ((), (), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(host, pa.string()), pa.array(slot, pa.int32()), pa.array(lo, pa.string()), pa.array(hi, pa.string()), pa.array(n, pa.int64()), pa.array(chars, pa.int64())], names=["host", "slot", "lo", "hi", "n", "chars"])

    slots = joined.select("host", "html", "wrapper").mapInArrow(measure, "host string, slot int, lo string, hi string, n long, chars long")
    each = slots.groupBy("host", "slot").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sum("n").alias("n"), F.sum("chars").alias("chars"))
    role = each.withColumn("constant", (F.col("lo") == F.col("hi")) & (F.col("n") > 1) & (F.col("slot") >= 0))
    largest = F.max(F.when(F.col("constant"), 0).otherwise(F.col("chars")))
    role = role.groupBy("host").agg(F.collect_list(F.struct("slot", "constant", "chars")).alias("s"), largest.alias("largest"))
    role = role.select("host", F.transform(F.filter("s", lambda x: x["constant"]), lambda x: x["slot"]).alias("constant"), F.transform(F.filter("s", lambda x: ~x["constant"] & (x["chars"] >= F.col("largest") * F.lit(main_share))), lambda x: x["slot"]).alias("main"))
    ready = rows.join(_small(cut(known.join(role, "host", "left"))), "host").select("page_id", "host", "html", "wrapper", "constant", "main")

    def fields(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict[str, Wrapper] = {}
        text: dict[str, str] = {}
        for batch in batches:
            constant, main, shown = batch.column("constant").to_pylist(), batch.column("main").to_pylist(), batch.column("wrapper").to_pylist()
            out: list[tuple] = []
            for i, found, whole, got in _parsed(batch, cache):
                gone, wanted = set(constant[i] or ()), set(main[i] or ())
                data = [(s, found[p][1]) for s, p in got if s not in gone]
                if shown[i] not in text:
                    text[shown[i]] = readable(load(shown[i]))
                out.append((whole, text[shown[i]], [s for s, _ in data], [v for _, v in data], "\n".join(v for s, v in data if s in wanted)))
            cols = list(zip(*out)) or [()] * 5
            kinds = [pa.bool_(), pa.string(), pa.list_(pa.int32()), pa.list_(pa.string()), pa.string()]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("host"), *[pa.array(c, k) for c, k in zip(cols, kinds)]], names=["page_id", "host", "matched", "wrapper", "slots", "fields", "content"])

    return ready.mapInArrow(fields, "page_id long, host string, matched boolean, wrapper string, slots array<int>, fields array<string>, content string")
