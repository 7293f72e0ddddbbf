import random

from morrowcart.llm import url_filter as U


def _pages(spark, urls):
    return spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")


def test_parts_and_rules(spark):
    cases = {  # url -> host, path, rule
        "https://a.EXAMPLE.com/en/x?q=/fr/": ("a.example.com", "/en/x", "example.com/en/"),
        "https://www.example.com/en/": ("www.example.com", "/en/", "www.example.com/en/"),
        "https://x.www.example.com/en/1#t": ("x.www.example.com", "/en/1", "www.example.com/en/"),
        "http://notexample.com/en/": ("notexample.com", "/en/", "com/"),
        "http://a.com?x://b.net/es/": ("a.com", "", None),
        "http://a.com#f": ("a.com", "", None),
        "http://b.net/es/": ("b.net", "/es/", "net/es/"),
        "http://b.net/es": ("b.net", "/es", None),
        "http://b.net/ES/": ("b.net", "/ES/", None),
        "http://ÄA.org/x": ("Äa.org", "/x", None),
        "x://h/p://q/r": ("h", "/p://q/r", None),
        "mailto:x": ("", "", None),
        "": ("", "", None),
        None: ("", "", None),
    }
    rows = U.url_filter(_pages(spark, list(cases))).collect()
    got = {r.page_id: (r.host, r.path, r.rule) for r in rows}
    assert [got[i] for i in range(len(cases))] == list(cases.values())
    verdict = {r.rule: r.verdict for r in rows if r.rule}
    assert verdict == {"example.com/en/": "block", "www.example.com/en/": "allow", "com/": "allow", "net/es/": "block"}


SECTIONS = ("news", "sport", "art", "food", "music", "film", "books", "travel", "home")


def _site(spark, by_section, **kw):
    """Rows by section of urls http://m.net/<section>/<rest>, the rests in turn."""
    urls = [f"http://m.net/{s}/{rests[i % len(rests)].format(i)}" for s, (n, rests) in by_section.items() for i in range(n)]
    out = {}
    for r in U.url_filter(_pages(spark, urls), **kw).collect():
        out.setdefault(r.path.split("/")[1], []).append(r)
    return out


ARTICLE, SHOP = ["{}/view.html", "{}/view.html", "{}/print"], ["cart/{}.php", "item/{}.php"]


def test_unlabelled_branches_alike_to_blocked_ones_are_blocked(spark):
    """Sections built like the blocked ones share their wildcard and its purity;
    sections built otherwise keep their own, at any size of the table."""
    for times in (1, 10):
        got = _site(spark, {"es": (30 * times, ARTICLE), "fr": (30 * times, ARTICLE), "pt": (15 * times, ARTICLE), "shop": (30 * times, SHOP), "about": (15 * times, ["{}"])})
        verdicts = {s: {r.verdict for r in rows} for s, rows in got.items()}
        assert verdicts == {"es": {"block"}, "fr": {"block"}, "pt": {"block"}, "shop": {"allow"}, "about": {"allow"}}
        assert {r.rule for r in got["pt"]} == {None} and {r.template.split("/")[1] for r in got["pt"] + got["es"]} == {"*[w"}


def test_a_template_with_few_labels_abstains(spark):
    """Alike branches of which only a small part is labelled are allowed."""
    got = _site(spark, {"es": (30, ARTICLE)} | {s: (30, ARTICLE) for s in SECTIONS})
    assert {r.verdict for r in got["es"]} == {"block"} and {r.verdict for s in SECTIONS for r in got[s]} == {"allow"}
    assert len({r.template for s in ("es", *SECTIONS) for r in got[s]}) == 2


def test_labelled_branches_that_differ_stay_apart(spark):
    rules = (("block", "m.net/a/"), ("block", "m.net/b/"), ("allow", "m.net/c/"), ("allow", "m.net/d/"))
    got = _site(spark, {s: (20, ARTICLE) for s in "abcd"}, rules=rules)
    assert all(r.template.startswith(f"/{s}/") for s in "abcd" for r in got[s])
    rules = (("block", "m.net/a/1"), ("block", "m.net/b/"))  # half of /a/ and all of /b/ are blocked, nothing is allowed
    got = _site(spark, {"a": (20, ["1{}", "2{}"]), "b": (20, ["1{}", "2{}"])}, rules=rules)
    assert {r.verdict for r in got["a"]} == {"block"} and {r.template for r in got["a"] + got["b"]} == {"/*[w/<n>]/<n>"}


def test_deep_paths_are_read_whole(spark):
    """Segments below the merged levels are part of the template."""
    deep = "a/b/c/d/e/{}"
    got = _site(spark, {"es": (20, [deep + "/x.html"]), "en": (20, [deep + "/y.html"])})
    assert {r.template for r in got["es"]} != {r.template for r in got["en"]}
    assert all(r.template.endswith("/d/e/<n>/x.html") for r in got["es"]) and {r.verdict for r in got["en"]} == {"allow"}
    long = _pages(spark, ["http://h.org/" + "s/" * 5000 + str(i) for i in range(3)])
    assert {r.verdict for r in U.url_filter(long).collect()} == {"allow"}


def test_leaves_become_a_wildcard(spark):
    words = ["".join(chr(97 + (i * k) % 26) for k in (1, 3, 5, 7)) + "z" * (i % 7) for i in range(60)]
    rows = U.url_filter(_pages(spark, [f"http://s.org/tag/{w}" for w in words]), rules=(("block", "s.org/tag/"),)).collect()
    assert {r.template for r in rows} == {"/tag/*[w]"} and {r.verdict for r in rows} == {"block"}


def test_sql_agrees_on_mixed_sites(spark):
    """The registered SQL on sites with alike, differing, deep and odd paths."""
    import duckdb

    from morrowcart.llm import queries as Q
    rng = random.Random(3)
    hosts = ["m.net", "a.example.com", "www.example.com", "s.org", "b.net"]
    urls = [f"http://{rng.choice(hosts)}/{rng.choice(['es', 'fr', 'en', 'pt', 'news', 'x1', 'static.js', ''])}/"
            + rng.choice(["{}", "{}.html", "view/{}", "p{}", "a/b/c/d/{}/e.HTML", "deadbeef{}", "<n>", "w", ""]).format(rng.randint(1, 99999)) for _ in range(3000)]
    urls += [f"http://k.net/{s}/{i}/{'print' if i % 3 == 0 else 'view.html'}" for s, n in (("es", 30), ("fr", 30), ("pt", 15)) for i in range(n)]
    urls += ["mailto:x", "", None, "http://", "http://m.net", "http://m.net//es//1"]
    pages = _pages(spark, urls)
    con = duckdb.connect()
    con.register("pages_df", pages.toPandas())
    con.execute("CREATE TABLE pages AS SELECT page_id, url FROM pages_df")
    want = con.execute(Q._url_sql()).fetchall()
    cols = [c[0] for c in con.description]
    got = [tuple(r[c] for c in cols) for r in U.url_filter(pages).collect()]
    key = lambda r: tuple(map(str, r))
    assert sorted(got, key=key) == sorted(want, key=key)
    assert len({r[cols.index("verdict")] for r in got if r[cols.index("rule")] is None}) == 2


def test_empty_duplicates_and_clashing_columns(spark):
    assert U.url_filter(_pages(spark, []).where("false")).count() == 0
    p = _pages(spark, ["http://b.net/es/1"] * 3).selectExpr("page_id", "url", "'h' AS host", "1 AS g1", "2 AS purity")
    rows = U.url_filter(p).collect()
    assert [r.verdict for r in rows] == ["block"] * 3 and {r.host for r in rows} == {"b.net"}
