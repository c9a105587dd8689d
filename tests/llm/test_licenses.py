"""License scan and URL rules against plain versions."""

import plain
import pytest

from millrace.llm import licenses, queries, urls

RULES = [
    ("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.Example.com", "/en/"), ("block", "net", "/es/"),
    ("block", "net", "/es/"), ("allow", "b.net", "/es"), ("block", "com", "/x"), ("block", "", "/"), ("block", "org", None),
]
URLS = [
    None, "", "no scheme", "http://", "http://com", "http://com/", "HTTP://WWW.EXAMPLE.COM/en/1?q#f", "https://example.com/en/",
    "https://example.com/en", "https://a.example.com/en/x", "https://notexample.com/en/x", "http://x.net/es/1", "http://b.net/es/1",
    "http://b.net/es", "http://.com/x", "a://b://c.com/x", "http://com?x=/y", "http://" + "a." * 300 + "com/" + "p/" * 500, "http://é.com/xé#/",
]


def verdict(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host, tail = rest[:cut].translate(plain.LOWER), rest[cut:]
        path = tail[: min([tail.find(c) for c in "?#" if c in tail], default=len(tail))]
    fits = [
        (len(h + p), len(h), action, h + p)
        for action, h, p in ((a, h.translate(plain.LOWER), p) for a, h, p in RULES if h and p is not None)
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    best = max(fits, default=(0, 0, "allow", None))
    return host, path, best[3], best[2]


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(i, u, "rule", "h") for i, u in enumerate(URLS)] + [(None, URLS[6], "", ""), (3, URLS[7], "", ""), (3, URLS[7], "", "")]
    return spark.createDataFrame(rows, "page_id long, url string, rule string, host string").repartition(2)


@pytest.mark.parametrize("limit", [urls.MAX_BROADCAST_RULES, 0])
def test_rules(spark, pages, limit, monkeypatch):
    monkeypatch.setattr(urls, "MAX_BROADCAST_RULES", limit)
    got = urls.filter_urls(pages, urls.rule_table(spark, RULES), "page_id").collect()
    want = [(r.page_id, *verdict(r.url)) for r in pages.collect()]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_no_rules_and_no_pages(spark, pages):
    none = urls.rule_table(spark, RULES).limit(0)
    assert {(r.rule, r.verdict) for r in urls.filter_urls(pages, none, "page_id", default="block").collect()} == {(None, "block")}
    assert urls.filter_urls(pages.limit(0), urls.rule_table(spark, RULES), "page_id").count() == 0


def found(text, license_id, template):
    """Most shingles of the template in a window of the grid, and how many windows hold three quarters."""
    words, wanted = plain.alnum(text), plain.alnum(template)
    step = 4
    while step < len(wanted) - 1:
        step *= 2
    goal = {" ".join(x) for x in (plain.runs(wanted, 5) if len(wanted) >= 5 else [wanted])}
    best, windows = (0, 0), 0
    for start in range(0, len(words), step):
        window = words[start : start + 2 * step]
        if start and len(window) < 5:
            continue
        held = {" ".join(x) for x in (plain.runs(window, 5) if len(window) >= 5 else [window])}
        n = len(goal & held)
        windows += 4 * n >= 3 * len(goal)
        best = max(best, (n, -start))
    return (license_id, len(goal), best[0], -best[1], windows) if 4 * best[0] >= 3 * len(goal) else None


def test_licenses_in_texts(spark, odd):
    filler = [t for _, t in odd.select("doc_id", "text").collect() if t and len(t) > 100]
    templates = [*licenses.TEMPLATES, ("none", ""), ("short", "public domain"), ("none", None), ("MIT", "Released under the MIT License!")]
    texts = [None, "", "Public Domain.", "public domain work"]
    for i, (_, template) in enumerate(licenses.TEMPLATES):
        words = template.split()
        texts += [template, filler[i] + "\n" + template.upper() + "\n" + filler[i + 1], " ".join([*words[:-1], "changed"]) + " " + filler[0]]
        texts += [filler[2] + " " + " ".join(words[: len(words) // 2]) + " " + filler[3], template + " " + template]
    docs = spark.createDataFrame([(i % 20, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, license string").repartition(3)
    table = spark.createDataFrame(templates, "license_id string, text string")
    rows = licenses.license_scan(docs, table).collect()
    got = sorted((r.doc_id, r.license, r.n_shingles, r.n_found, r.word_start, r.n_windows) for r in rows)
    distinct = {(i, " ".join(plain.alnum(t))) for i, t in templates if plain.alnum(t)}
    want = sorted((i % 20, *hit) for i, t in enumerate(texts) for name, t2 in distinct if (hit := found(t, name, t2)))
    assert got == want and len(got) > 20
    assert licenses.license_scan(docs, table.limit(0)).count() == 0
    assert licenses.license_scan(docs.limit(0), table).count() == 0


def test_bodies_and_headers_are_found(spark, monkeypatch):
    """The registered query knows bodies, here cut out of longer texts and in part reworded."""
    isc = (
        "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies. The software is provided "
        '"as is" and the author disclaims all warranties with regard to this software including all implied warranties of '
        "merchantability and fitness. In no event shall the author be liable for any special, direct, indirect, or "
        "consequential damages or any damages whatsoever resulting from loss of use, data or profits, whether in an action of "
        "contract, negligence or other tortious action, arising out of or in connection with the use or performance of this software."
    )
    texts = {i: f"word {i} " * 40 + body + " more words" * 30 for i, (_, body) in enumerate(licenses.BODIES)}
    docs = spark.createDataFrame([*texts.items(), (100, "x y " * 50 + isc), (101, "nothing of that kind " * 30)], "doc_id long, text string")
    monkeypatch.setattr(queries.common, "documents", lambda *_: docs)
    found = {(r.doc_id, r.license) for r in queries.op1_license_scan(spark, "").collect()}
    assert {(i, name) for i, (name, _) in enumerate(licenses.BODIES)} <= found
    assert (100, "ISC") in found and not any(doc == 101 for doc, _ in found)


@pytest.mark.parametrize("dropped", range(0, 14))
def test_windows_at_the_threshold_are_kept(spark, dropped):
    """Words changed one after another, until too few shingles are left: the count of marked ones never drops a hit."""
    words = [f"t{i}" for i in range(44)]
    changed = ["x" if i in range(2, 2 + dropped) else w for i, w in enumerate(words)]
    texts = [" ".join(["f"] * pad + changed + ["g"] * 9) for pad in (0, 3, 31, 40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    table = spark.createDataFrame([("L", " ".join(words)), ("L", "t0 t1 t2 t3 t4 and more than these words of t20 t21 t22 t23 t24 for one step")], "license_id string, text string")
    got = sorted((r.doc_id, r.license, r.n_shingles, r.n_found, r.word_start, r.n_windows) for r in licenses.license_scan(docs, table).collect())
    assert got == sorted((i, *hit) for i, t in enumerate(texts) if (hit := found(t, "L", " ".join(words))))


def test_a_very_long_text(spark):
    notice = "Permission to use this text is granted to all who keep this notice with it in every copy they make"
    text = " ".join([*(f"w{i % 3001}" for i in range(200_000)), notice, *(f"v{i % 17}" for i in range(100_000)), *[notice] * 300])
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    table = spark.createDataFrame([("N", notice), ("MIT", "Released under the MIT License.")], "license_id string, text string")
    got = [(r.license, r.n_shingles, r.n_found, r.word_start, r.n_windows) for r in licenses.license_scan(docs, table).collect()]
    assert got == [found(text, "N", notice)]
