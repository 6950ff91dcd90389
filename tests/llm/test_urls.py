import itertools
import random

from candlewick.llm import urls

URLS = [
    "http://example.org/es/a", "https://BLOG.Example.Org/en/12?x#y", "http://example.org", "http://org/x", "ftp://a.b.com/fr/", "//none",
    "http://xexample.org/es/", "http://example.org?x=/es/", "http://example.org#://b", "://", "a://b://c/d", "http://a.b.net/de/x",
    "http://example.org./es/", "http://com/de/1\n2", "", None, "x" * 5000, "http://h.com/" + "p" * 5000]


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = next((i for i, c in enumerate(rest) if c in "/?#"), len(rest))
    path = rest[end:]
    end_path = next((i for i, c in enumerate(path) if c in "?#"), len(path))
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end]), path[:end_path]


def judge(url, rules, default="allow"):
    host, path = split(url)
    fit = [(len(h) + len(p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h) or h == "") and path.startswith(p)]
    best = max(fit, default=(0, 0, None, default))
    return host, path, best[2], best[3]


def run(spark, pages, rules):
    df = spark.createDataFrame([(i, u, "h", "p", "r") for i, u in enumerate(pages)], "page_id long, url string, host string, path string, rule string")
    got = urls.url_filter(df, urls.rules_frame(spark, rules)).collect()
    return {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in got}, len(got)


def test_fixed_rules(spark):
    got, n = run(spark, URLS, urls.RULES)
    assert n == len(URLS)
    assert got == {i: judge(u, urls.RULES) for i, u in enumerate(URLS)}


def test_nested_rules_against_brute_force(spark):
    rng = random.Random(4)
    hosts = ["".join(rng.choice("ab") for _ in range(2)) + s for s in ("", ".c", ".b.c", ".a.b.c", ".d")] + ["c", "b.c", "a.b.c", "d"]
    paths = ["/", "/a", "/ab", "/abc/", "/b", "", "/abc/d"]
    rules = tuple({(h, p): (h, p, rng.choice(["allow", "block"])) for h, p in itertools.product(hosts, paths) if rng.random() < 0.4}.values())
    pages = [f"http://{rng.choice(['', 'x.', 'a.', 'ab.'])}{rng.choice(hosts)}{rng.choice(paths)}{rng.choice(['', 'q', 'bc/d'])}" for _ in range(400)]
    got, n = run(spark, pages, rules)
    assert n == len(pages)
    assert got == {i: judge(u, rules) for i, u in enumerate(pages)}


def test_one_host_with_most_rows_crosses_ranges(spark):
    pages = [f"http://x.example.org/en/{i}" for i in range(3000)] + ["http://a.net/"]
    got, _ = run(spark, pages, urls.RULES)
    assert got == {i: judge(u, urls.RULES) for i, u in enumerate(pages)}


def test_equal_rules_no_rules_no_pages(spark):
    got, _ = run(spark, ["http://a.org/"], (("org", "/", "allow"), ("org", "/", "block")))
    assert got[0][3] == "block"
    empty = urls.rules_frame(spark).limit(0)
    df = spark.createDataFrame([(1, "http://a.org/")], "page_id long, url string")
    assert [tuple(r) for r in urls.url_filter(df, empty, default="block").collect()] == [(1, "a.org", "/", None, "block")]
    assert urls.url_filter(df.limit(0), urls.rules_frame(spark)).count() == 0


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame([(1, "http://a.org/")], "page_id long, url string")
    plan = urls.url_filter(df, urls.rules_frame(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
