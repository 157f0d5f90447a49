import time

import numpy as np
from llm.helpers import frame, prose, seeded, words

from papyrine.llm import decontaminate, html_wrappers, licenses


def shared_runs(doc, item, span):
    """Every maximal run, by looking at every pair of places."""
    out = set()
    for i in range(len(doc)):
        for j in range(len(item)):
            if doc[i] == item[j] and (not i or not j or doc[i - 1] != item[j - 1]):
                n = 0
                while i + n < len(doc) and j + n < len(item) and doc[i + n] == item[j + n]:
                    n += 1
                if n >= span:
                    out.add((i, j, n))
    return out


def test_contamination_against_brute_force(spark):
    rng = seeded(11)
    items = [prose(rng, int(n)) for n in (15, 40, 60, 12, 13)] + ["x y " * 20, None, ""]
    texts = [prose(rng, 200) for _ in range(12)]
    for k in range(12):
        cut = items[k % 6].split(" ")[k % 3 :]
        texts[k] = texts[k][:300] + " " + " ".join(cut).upper() + " " + texts[k][300:]
    texts += [None, "", "x y " * 15, items[1]]
    docs = frame(spark, texts, clashing=True)
    bench = spark.createDataFrame([(i, t, "z") for i, t in enumerate(items)], "item_id long, text string, id string")
    want = {(d, i, *r) for d, t in enumerate(texts) for i, b in enumerate(items) for r in shared_runs(words(t), words(b), 13)}
    assert len({w[0] for w in want}) > 8
    for limit in (10**6, 0):  # a broadcast index, and a join
        found = decontaminate.contamination(docs, bench, broadcast_words=limit)
        assert {tuple(r) for r in found.collect()} == want
        left = decontaminate.drop_contaminated(docs, bench, broadcast_words=limit)
        assert left.columns == docs.columns and sorted(r.doc_id for r in left.collect()) == sorted(set(range(len(texts))) - {w[0] for w in want})
        assert decontaminate.contamination(docs, bench.where("false"), broadcast_words=limit).count() == 0
        assert decontaminate.drop_contaminated(docs.where("false"), bench, broadcast_words=limit).count() == 0


def test_contamination_of_repeated_rows_and_null_ids(spark):
    item = prose(seeded(12), 30)
    docs = frame(spark, ["pre " + item, "pre " + item, item, "clean"], ids=[1, 1, None, 1])
    bench = spark.createDataFrame([(None, item), (3, item), (3, item)], "item_id long, text string")
    for limit in (10**6, 0):
        found = decontaminate.contamination(docs, bench, broadcast_words=limit)
        assert {tuple(r) for r in found.collect()} == {(d, i, s, 0, 30) for d, s in ((1, 1), (None, 0)) for i in (None, 3)}
        assert [r.text for r in decontaminate.drop_contaminated(docs, bench, broadcast_words=limit).collect()] == ["clean"]


def lcs(a, b):
    best = np.zeros((len(a) + 1, len(b) + 1), int)
    for i in range(len(a)):
        for j in range(len(b)):
            best[i + 1, j + 1] = max(best[i, j + 1], best[i + 1, j], best[i, j] + (a[i] == b[j]))
    return best[-1, -1]


def test_alignment_against_the_full_table():
    rng = seeded(13)
    for _ in range(30):
        t, d = rng.integers(0, 6, rng.integers(1, 25)).astype(np.uint64), rng.integers(0, 6, rng.integers(0, 40)).astype(np.uint64)
        n, first, stop = licenses.align(t, d, 0, -len(t), len(d))
        assert n == lcs(t, d) and (n == 0 or (t == d[first]).any() and (t == d[stop - 1]).any() and stop - first >= n)


def test_licenses(spark):
    rng = seeded(14)
    mit = licenses.TEMPLATES["MIT"].split(" ")
    worn = " ".join(mit[:30] + ["other"] + mit[30:70] + mit[73:120] + ["more", "words"] + mit[120:])
    texts = [prose(rng, 20) + " " + worn + " " + prose(rng, 20), "Released under the MIT License. x\nReleased under the MIT License.", None, "", prose(rng, 3000), " ".join(mit[:50])]
    texts += [licenses.TEMPLATES["Apache-2.0"]] * 2
    found = sorted(tuple(r) for r in licenses.scan(frame(spark, texts, clashing=True)).collect())
    by = {d: [r for r in found if r[0] == d] for d in range(len(texts))}
    assert [r[1] for r in by[0]] == ["MIT"] and by[0][0][2] > 0.97 and by[0][0][4] == 20 and by[0][0][5] == 20 + len(words(worn))
    assert [(r[1], r[4], r[5]) for r in by[1]] == [("MIT-notice", 0, 5), ("MIT-notice", 6, 11)]
    assert by[2] == by[3] == by[4] == by[5] == [] and {r[1] for r in by[6]} == {"Apache-2.0", "Apache-2.0-notice"} and [r[1:] for r in by[6]] == [r[1:] for r in by[7]]
    assert licenses.scan(frame(spark, [])).count() == 0


def page(i, n, ad=True, rng=None):
    items = "".join(f"<li><a href='/{j}'>link {i} {j}</a></li>" for j in range(n))
    body = "".join(f"<p>Paragraph {i} {j} is &amp; was &lt;long&gt; enough to be content.</p>" for j in range(n + 1))
    return f"<!DOCTYPE html><html><head><title>t{i}</title><script>if(a<b)</script></head><body><nav><ul>{items}</ul></nav><!-- c -->{'<div class=ad>buy</div>' if ad else ''}<article><h1>Head {i}</h1>{body}</article><footer>Same here</footer></body></html>"


def test_wrappers(spark):
    rows = [(i, f"HTTP://u@site{i % 2}.example:80/x/{i}", page(i, i % 4 + 1, i % 3 > 0), "z") for i in range(16)]
    rows += [(20, None, page(1, 2), "z"), (21, "http://void.example/n", None, "z"), (21, "http://void.example/n", None, "z"), (None, "http://odd.example/", "<p>a<p>b<div", "z"), (23, "http://long.example", "<ul><li>" + "x " * 50000, "z")]
    found = html_wrappers.extract(spark.createDataFrame(rows, "page_id long, url string, html string, wrapper string")).collect()
    assert len(found) == len(rows)
    by = {r.page_id: r for r in found}
    for i in range(16):
        r, n = by[i], i % 4 + 1
        assert r.host == f"site{i % 2}.example" and r.matched
        assert "Same here" not in r.fields and f"Head {i}" in r.fields and f"t{i}" in r.fields and [f for f in r.fields if f.startswith("link")] == [f"link {i} {j}" for j in range(n)]
        assert f"Paragraph {i} {n} is & was <long> enough to be content." in r.content.split("\n") and "if(a" not in " ".join(r.fields)
    assert "+" in by[0].wrapper and "?" in by[0].wrapper
    assert by[20].host == "" and by[21].content == "" and by[21].fields == [] and by[None].fields == ["a", "b"] and len(by[23].fields[0]) > 90000
    assert html_wrappers.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_a_wrapper_matches_what_it_is_made_of():
    streams = [[n for n, _ in html_wrappers.tokens(page(i, i % 5 + 1, i % 2))] for i in range(12)]
    dumped = [html_wrappers.dump(html_wrappers.fold([(n, False, False) for n in s])) for s in streams]
    one = html_wrappers.Wrapper(html_wrappers.load(html_wrappers.infer(dumped)))
    half = html_wrappers.Wrapper(html_wrappers.load(html_wrappers.infer([html_wrappers.infer(dumped[:5]), html_wrappers.infer(dumped[5:])])))
    for w in (one, half):
        assert all(w.parse(s)[0] for s in streams)
        assert not w.parse(streams[0] + ["table"])[0] and len(w.parse(streams[0])[1]) == streams[0].count("#")


def test_tokens_of_hostile_pages_in_time():
    for bad in ('<a "', "<a '\"", "<!", "<b x='", "</", '<a "<b">'):
        began = time.perf_counter()
        html_wrappers.tokens(bad * 20000)
        assert time.perf_counter() - began < 3, bad
    assert html_wrappers.tokens('<a href="x>y<z" class=k>t</a>') == [("a.k", ""), ("#", "t"), ("/a", "")]
    assert html_wrappers.tokens('<p>a < b "c" <i>d') == [("p", ""), ("#", 'a < b "c"'), ("i", ""), ("#", "d")]


def brute_fold(s):
    """A string with its squares folded: shortest first, from the left; (body)+ as one new sign each."""
    items, period = list(s), 1
    while 2 * period <= len(items):
        out, i = [], 0
        while i < len(items):
            body, times = items[i : i + period], 1
            while len(body) == period and items[i + times * period : i + (times + 1) * period] == body:
                times += 1
            if times > 1:
                out.append(body[0] if period == 1 else "(" + " ".join(body) + ")")
                i += times * period
            else:
                out.append(items[i])
                i += 1
        items, period = out, 1 if len(out) < len(items) else period + 1
    return items


def test_folding_against_brute_force():
    rng = seeded(15)
    for n in (10, 40, 150):
        for _ in range(15):
            s = "".join(chr(97 + int(x)) for x in rng.integers(0, 3, n))
            assert [html_wrappers.base(k) for k, _, _ in html_wrappers.fold([(c, False, False) for c in s])] == brute_fold(s)
    for period in (47, 48, 49, 64, 150, 700):
        body = [f"t{i}" for i in range(period)]
        folded = html_wrappers.fold([(c, False, False) for c in ["x", *body * 5, "y"]])
        assert len(folded) == 3 and len(folded[1][0]) == period and folded[1][2]


def test_hosts_of_many_different_pages(spark):
    rng = seeded(16)
    pages = [(i, "http://h/", "<div>" + "".join(f"<{t}>{i}</{t}>" for t in rng.permutation(["b", "i", "u", "em", "h2"])[: 1 + i % 5]) + "</div>") for i in range(300)]
    found = html_wrappers.extract(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()
    assert len(found) == 300 and len({r.wrapper for r in found}) == 1 and all(r.matched for r in found)
    assert all(r.fields == [str(r.page_id)] * (1 + r.page_id % 5) for r in found)
