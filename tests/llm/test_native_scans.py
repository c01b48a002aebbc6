"""URL rules and license scans against SQL without their indexes, and on small cases."""

import duckdb

from cofi.llm import licenses, urls

SF = "/root/testdata/sf0.001"


def same(df, con, sql):
    want = con.sql(sql)
    assert sorted(df.columns) == sorted(want.columns)
    order = sorted(df.columns)
    rows = lambda cols, data: sorted((tuple(r[cols.index(c)] for c in order) for r in data), key=repr)
    got = rows(df.columns, df.collect())
    assert got == rows(want.columns, want.fetchall())
    return got


URLS = ["http://a.com", "http://a.com/", "HTTP://WWW.Example.COM/en/x?y", "https://x.www.example.com/en/", "http://example.com/EN/",
        "http://b.net/es/1", "http://net/es/", "http://xnet/es/1", "http://b.net/es", "http://b.net?/es/", "b.net/es/1", None, "",
        "http://ads-track.example.org/q", "http://m.ads-track.example.org/q", "http://bads-track.example.org/q",
        "http://o.org/q?utm_source=f", "http://o.org/q?page=2&ref=x", "http://blog.o.org/a.html?utm_source=f", "http://o.org/#://p.net/es/",
        "http://u@b.net:80/es/", "http://ü.net/es/ß", "x" * 50_000, "http://b.net/es/" + "y/" * 20_000]


def test_urls(spark):
    con = duckdb.connect()
    rows = [(i, u, "block") for i, u in enumerate([*URLS, URLS[2], URLS[5]])] + [(None, URLS[5], None)]
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?)", [r[:2] for r in rows])
    df = spark.createDataFrame(rows, "page_id BIGINT, url STRING, verdict STRING")
    rules = urls.rule_table(spark, urls.registered_rules())
    same(urls.judge(df, rules), con, urls.oracle_sql())
    by = {r.page_id: r for r in urls.judge(df, rules).collect()}
    assert (by[2].host, by[2].path, by[2].rule, by[2].verdict) == ("www.example.com", "/en/x", "www.example.com/en/", "allow")
    assert [by[i].rule for i in (0, 1, 5, 6, 7, 8, 9, 10, 11)] == [None, "com/", "net/es/", "net/es/", None, None, None, None, None]
    assert [by[i].verdict for i in (13, 14, 15, 16, 18)] == ["block", "block", "allow", "block", "allow"]
    assert urls.judge(df.limit(0), rules).count() == 0


def test_urls_of_the_table(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{SF}/pages.parquet')")
    assert same(urls.judge(spark.read.parquet(f"{SF}/pages.parquet"), urls.rule_table(spark, urls.registered_rules())), con, urls.oracle_sql())


def test_rarest_token_and_rules_without_one(spark):
    rules = [urls.host_rule("a.com", "/x/", "block"), urls.pattern_rule("zz*yy", "block"), urls.pattern_rule("||b.c/d", "allow")]
    assert [r.tokens for r in rules] == [["a", "com", "x"], [], ["b", "c"]]
    tokens = spark.createDataFrame([(t,) for t in ["a"] * 3 + ["com"] * 9 + ["x"] * 2 + ["b"]], "token STRING")
    got = {r.rule: r.token for r in urls.rarest_tokens(urls.rule_table(spark, rules), tokens).collect()}
    assert got == {"a.com/x/": "x", "zz*yy": "", "||b.c/d": "c"}


def test_licenses(spark):
    t = licenses.TEMPLATES
    fill = lambda n: " ".join(f"w{i % 97}x{i}" for i in range(n))
    apache = t["Apache-2.0-header"].split()
    texts = [None, "", "four words only here", t["MIT"], f"{fill(1000)} {t['GPL-3.0']} {fill(77)}", t["CC-BY-NC-4.0"].upper(),
             " ".join(apache[:20] + ["odd"] + apache[21:]), " ".join(apache[::2]), f"{t['BSD']}\n{t['BSD']}", f"{fill(60_000)} {t['MIT-text']}",
             t["CC-BY-4.0"], "released under the MIT license", "Released under the\nMIT\tLICENSE, or else"]
    rows = [(i, x, "q") for i, x in enumerate(texts)] + [(3, t["MIT"], "q")] + [(None, t["MIT"], None)] * 5
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", [r[:2] for r in rows[:len(texts)]] + [(None, t["MIT"])] * 5)
    df = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, template STRING")
    got = same(licenses.scan(df), con, licenses.oracle_sql())
    got_id = sorted(licenses.scan(df).columns).index("doc_id")
    assert len([g for g in got if g[got_id] is None]) == 5  # rows without a doc_id are documents of their own
    assert len(got) == len({(r.doc_id, r.template) for r in licenses.scan(df).collect()}) + 4
    found = {(r.doc_id, r.template) for r in licenses.scan(df).collect()}
    assert {(3, "MIT"), (None, "MIT"), (4, "GPL-3.0"), (5, "CC-BY-NC-4.0"), (6, "Apache-2.0-header"), (8, "BSD"), (9, "MIT-text"),
            (10, "CC-BY-4.0"), (11, "MIT"), (12, "MIT")} <= found and not found & {(i, x) for i in (0, 1, 2, 7) for x in t}
    assert licenses.scan(df.limit(0)).count() == 0


def test_licenses_of_the_table(spark):
    con = duckdb.connect()
    con.execute("CREATE VIEW documents AS SELECT * FROM read_parquet('/root/testdata/sf0.01/documents.parquet')")
    assert len(same(licenses.scan(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")), con, licenses.oracle_sql())) > 20


def test_bands_hold_their_promise():
    lowest = licenses.CONTAINED / (5 - licenses.CONTAINED)
    assert (1 - lowest) ** licenses.bands() <= licenses.MISS
    assert licenses.bands(0.8, 1e-8) == 2 * licenses.bands() or licenses.bands(0.8, 1e-8) == 2 * licenses.bands() - 1
