import duckdb
import pytest

from tallyline.llm import urls

PAGES = "page_id long, url string, html string"


def judged(spark, rows, **options):
    pages = spark.createDataFrame(rows, PAGES).repartition(3)
    return {r["page_id"]: r for r in urls.filter_urls(pages, **options).collect()}


def test_hosts_paths_and_rules(spark):
    cases = {
        "https://WWW.Example.ORG/es/1?x#y": ("www.example.org", "/es/1", "example.org/es/", "block"),
        "http://example.org/en/12": ("example.org", "/en/12", "example.org/en/1", "block"),
        "http://example.org/en/2": ("example.org", "/en/2", "org/", "allow"),
        "http://a.b.com/fr/": ("a.b.com", "/fr/", "com/fr/", "allow"),
        "http://notcom/fr/": ("notcom", "/fr/", None, None),
        "x://y.com/de/?q": ("y.com", "/de/", "com/de/", "block"),
        "x://y.org": ("y.org", "", None, None),
        "x://y.org?a/b": ("y.org", "", None, None),
        "x://Ä.Org/de": ("Ä.org", "/de", "org/", "allow"),
        "http://a.org/p://q": ("a.org", "/p://q", "org/", "allow"),
        "http://a.org/x\ny": ("a.org", "/x\ny", "org/", "allow"),
        "no scheme": ("", "", None, None),
        "": ("", "", None, None),
        None: ("", "", None, None),
    }
    got = judged(spark, [(i, u, None) for i, u in enumerate(cases)])
    for i, (u, (host, path, rule, verdict)) in enumerate(cases.items()):
        r = got[i]
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule), u
        assert r["verdict"] == verdict if verdict else r["verdict"] in ("allow", "block")


def test_urls_without_a_rule_follow_their_template(spark):
    rules = [("a.net", "/bad/1", "block"), ("a.net", "/good/1", "allow")]
    rows = [(i, f"http://a.net/{'bad' if i % 2 else 'good'}/1{i}", "") for i in range(60)]
    rows += [(1000 + i, f"http://a.net/{'bad' if i % 2 else 'good'}/2{i}", "") for i in range(20)]
    # a host without labels is judged by the other hosts' first branch
    rows += [(2001, "http://b.net/bad/7", ""), (2002, "http://b.net/good/7", "")]
    got = judged(spark, rows, rules=rules)
    assert {got[1000 + i]["verdict"] for i in range(20) if i % 2} == {"block"}
    assert {got[1000 + i]["verdict"] for i in range(20) if not i % 2} == {"allow"}
    assert (got[2001]["verdict"], got[2002]["verdict"]) == ("block", "allow")
    assert got[1001]["template"] == "/bad" and got[1000]["template"] == "/good"


def test_branches_of_many_kinds_become_wildcards(spark):
    words = [a + b + c for a in "abcde" for b in "vwxyz" for c in "mnop"]
    rows = [(i, f"http://a.net/u/{w}/post", "") for i, w in enumerate(words)]
    table = spark.createDataFrame(rows, PAGES)
    host, path = urls.parse(table["url"])
    base = table.select(host.alias("host"), path.alias("path"))
    names = [f"s{i}" for i in range(urls.DEPTH + 1)]
    counts = base.select("host", *[s.alias(n) for s, n in zip(urls.segments(base["path"]), names, strict=True)])
    counts = counts.groupBy("host", *names).count().selectExpr("host", *names, "count AS n", "cast(count as bigint) AS lab", "cast(if(s1 < 'c', count, 0) as bigint) AS bad")
    out = urls.template_verdicts(counts).collect()
    assert len(out) == len(words) and len({r["purity"] for r in out}) == 1


def test_repeated_rows_and_empty_table(spark):
    got = urls.filter_urls(spark.createDataFrame([(1, "http://a.org/x", None)] * 3 + [(None, None, None)], PAGES)).collect()
    assert len(got) == 4
    assert urls.filter_urls(spark.createDataFrame([], PAGES)).collect() == []


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_the_sql(spark, seed):
    import random

    rng = random.Random(seed)
    hosts = ["a.org", "b.com", "c.net", "x.example.org", "example.org", "d.net"]
    rows = []
    for i in range(400):
        segs = [rng.choice(["en", "de", "fr", "es", f"p{rng.randrange(30)}", rng.choice("abcdefghijkl") * 2]) for _ in range(rng.randrange(0, 6))]
        rows.append((i, f"http://{rng.choice(hosts)}/{'/'.join(segs)}" if rng.random() > 0.05 else None, None))
    got = {(r["page_id"], r["host"], r["path"], r["rule"], r["verdict"], r["template"]) for r in urls.filter_urls(spark.createDataFrame(rows, PAGES)).collect()}
    con = duckdb.connect()
    con.execute("CREATE TABLE pages(page_id BIGINT, url VARCHAR, html VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?, ?)", rows)
    assert got == set(con.execute(f"SELECT page_id, host, path, rule, verdict, template FROM ({urls.ORACLE_SQL})").fetchall())
