"""RFC 3986 resolution: the document's own examples, and normal forms."""

import random
from urllib.parse import urljoin, urlsplit

from cadastro.operators import ingest, links

BASE = "http://a/b/c/d;p?q"
# The examples of RFC 3986, sections 5.4.1 and 5.4.2 (targets without their fragment; an empty path becomes /).
EXAMPLES = {
    "g:h": "g:h", "g": "http://a/b/c/g", "./g": "http://a/b/c/g", "g/": "http://a/b/c/g/", "/g": "http://a/g", "//g": "http://g/",
    "?y": "http://a/b/c/d;p?y", "g?y": "http://a/b/c/g?y", "#s": "http://a/b/c/d;p?q", "g#s": "http://a/b/c/g", "g?y#s": "http://a/b/c/g?y",
    ";x": "http://a/b/c/;x", "g;x": "http://a/b/c/g;x", "g;x?y#s": "http://a/b/c/g;x?y", "": "http://a/b/c/d;p?q", ".": "http://a/b/c/",
    "./": "http://a/b/c/", "..": "http://a/b/", "../": "http://a/b/", "../g": "http://a/b/g", "../..": "http://a/", "../../": "http://a/",
    "../../g": "http://a/g", "../../../g": "http://a/g", "../../../../g": "http://a/g", "/./g": "http://a/g", "/../g": "http://a/g",
    "g.": "http://a/b/c/g.", ".g": "http://a/b/c/.g", "g..": "http://a/b/c/g..", "..g": "http://a/b/c/..g", "./../g": "http://a/b/g",
    "./g/.": "http://a/b/c/g/", "g/./h": "http://a/b/c/g/h", "g/../h": "http://a/b/c/h", "g;x=1/./y": "http://a/b/c/g;x=1/y",
    "g;x=1/../y": "http://a/b/c/y", "g?y/./x": "http://a/b/c/g?y/./x", "g?y/../x": "http://a/b/c/g?y/../x", "g#s/../x": "http://a/b/c/g",
}


def resolved(spark, pairs):
    df = spark.createDataFrame([(i, r, b) for i, (r, b) in enumerate(pairs)], "i int, link string, url string")
    return [r.target for r in links.resolved_links(df).orderBy("i").collect()]


def test_examples_of_the_standard(spark):
    assert resolved(spark, [(r, BASE) for r in EXAMPLES]) == list(EXAMPLES.values())


NORMAL = [
    ("HTTP://User@EXAMPLE.Com:80", "https://x/", "http://User@example.com/"), ("https://h:443/a", BASE, "https://h/a"),
    ("http://h:443/a", BASE, "http://h:443/a"), ("http://h:/a", BASE, "http://h/a"), ("%7euser/%c3%A9%2f", BASE, "http://a/b/c/~user/%C3%A9%2F"),
    ("für ein.zip?ä=%61", BASE, "http://a/b/c/f%C3%BCr%20ein.zip?%C3%A4=a"), ("50%", BASE, "http://a/b/c/50%"), (" x ", BASE, "http://a/b/c/x"),
    ("mailto:A@b.c/../d", BASE, "mailto:A@b.c/../d"), ("x", "http://host", "http://host/x"), ("?q", "http://host", "http://host/?q"),
    ("a?", BASE, "http://a/b/c/a?"), (None, BASE, None), ("x", None, None), ("😀", BASE, "http://a/b/c/%F0%9F%98%80"),
]


def test_normal_forms(spark):
    assert resolved(spark, [(r, b) for r, b, _ in NORMAL]) == [t for _, _, t in NORMAL]


def test_random_references_as_the_standard_library_joins_them(spark):
    rng = random.Random(6)
    pairs = []
    for _ in range(500):
        parts = [rng.choice(["a", "b.zip", "..", ".", "", "x;y"]) for _ in range(rng.randint(1, 6))]
        ref = rng.choice(["", "", "/"]) + "/".join(parts) + rng.choice(["", "?k=v", "#f"])
        base = "http://host.example/" + "/".join(rng.choice(["d", "e"]) for _ in range(rng.randint(0, 4))) + rng.choice(["", "/", "/f.html?z"])
        if "//" in ref or "//" in base.removeprefix("http://") or urlsplit(ref).path in ("", "."):
            continue  # empty segments and empty paths: the library keeps to older rules
        pairs.append((ref, base))
    want = [urljoin(b, r).split("#")[0] for r, b in pairs]
    assert len(pairs) > 200 and resolved(spark, pairs) == want


def test_links_feed_the_fetch_plan(spark):
    html = '<a href="../f1.zip?v=1">a</a> <a href=\'/data/f2.zip#x\'>b</a> <a href=f3.txt>c</a> <a href="http://EX.org/data/./f2.zip">d</a>'
    pages = spark.createDataFrame([(1, "http://ex.org/data/2024/index.html", html), (2, "http://ex.org/data/2024/", html)],
                                  "page_id long, url string, html string")
    found = links.resolved_links(ingest.extract_links(pages, keep=("page_id", "url")))
    manifest = links.link_manifest(found)
    assert sorted(map(tuple, manifest.collect())) == [("f1.zip", "http://ex.org/data/f1.zip?v=1"), ("f2.zip", "http://ex.org/data/f2.zip")]
    have = spark.createDataFrame([("f2.zip",)], "name string")
    assert [r.target for r in ingest.fetch_plan(manifest, have).collect()] == ["http://ex.org/data/f1.zip?v=1"]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan
