import re

import duckdb
import pytest

from recordforge.llm import urls

RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def rule(host, path):
    best = None
    for r in RULES:
        h, _, p = r.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (best is None or len(r) > len(best)):
            best = r
    return best


URLS = [
    None, "", "no scheme", "http://", "http://A.EXAMPLE.net", "HTTP://a.Example.NET/en/1", "x://net/", "http://snet/a", "http://a.net?x=/",
    "http://example.com/de/5#x", "http://www.example.com/DE/5", "http://b.org/fr/é", "http://b.org/fr", "a://b://c/d", "http://u@h:80/p//q///r/s/t/u/v/w",
    "http://é.ÉXAMPLE.net/en/", "http://h/" + "a1" * 20_000, "http://h/" + "/".join("12ab34cd56" for _ in range(3000)), "http://h/a\nb?c",
]


def corpus():
    out = [(i, u) for i, u in enumerate(URLS)] + [(None, "http://b.org/fr/1"), (0, None)]
    for i in range(3000):
        kind = i % 5
        host = "hot.example.org" if i % 3 else f"h{i % 11}.example.com"
        path = [f"/en/{i}", f"/spam/{i}.html", f"/wiki/{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}", f"/es/{i}/", f"/fr/{i}?q=1"][kind]
        out.append((1000 + i, f"https://{host}{path}"))
    return out


@pytest.fixture(scope="module")
def data(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("urls"))
    rows = [(p, u, "x") for p, u in corpus()]
    spark.createDataFrame(rows, "page_id long, url string, host string").repartition(3).write.parquet(d + "/pages.parquet")
    labels = [(i, 0 if i % 5 == 1 else 1, 0 if i % 7 else None) for i in range(3000)] + [(1, 0, 1), (1, 1, 0), (None, 0, 0), (7, None, None)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(d + "/labels.parquet")
    return d


def test_parts_and_rules_equal_brute_force(spark, data):
    got = urls.op5_urls(spark, data).collect()
    assert sorted(str(tuple(r)[:4]) for r in got) == sorted(str((p, *parts(u), rule(*parts(u)))) for p, u in corpus())
    assert all(r.verdict == RULES[r.rule] for r in got if r.rule)


def test_spam_branch_is_blocked_and_others_stay(spark, data):
    own = [r for r in urls.op5_urls(spark, data).collect() if not r.rule]
    spam = [r.verdict for r in own if r.path.startswith("/spam/")]
    rest = [r.verdict for r in own if r.path.startswith(("/en/", "/es/", "/fr/", "/wiki/"))]
    assert set(spam) == {"block"} and set(rest) == {"allow"}


def test_templates_are_generalised_and_merged(spark, data):
    pages = spark.read.parquet(data + "/pages.parquet")
    labels = spark.createDataFrame([(i, int(i % 5 == 1)) for i in range(3000)], "doc_id long, bad int")
    shapes = {r.template for r in urls.judge(pages, labels).where("host = 'hot.example.org'").select("template").distinct().collect()}
    assert "hot.example.org/+/{n}" in shapes and "hot.example.org/spam/{n}.html" in shapes and len(shapes) < 8


def test_query_equals_sql(spark, data):
    con = duckdb.connect()
    for t in ("pages", "labels"):
        con.execute(f"create view {t} as select * from '{data}/{t}.parquet/*.parquet'")
    want = con.execute(f"select page_id, host, path, rule, verdict, template, purity from ({urls.ORACLE})").fetchall()
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in urls.op5_urls(spark, data).collect())


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], "page_id long, url string").write.parquet(f"{tmp_path}/pages.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert urls.op5_urls(spark, str(tmp_path)).collect() == []


def test_branches_with_few_labels_stay_apart(spark):
    pages = [(i, f"http://h.example.com/{'abc'[i % 3]}/{i}") for i in range(60)] + [(100 + i, f"http://h.example.com/rare/{100 + i}") for i in range(4)]
    labels = [(i, int(i % 7 == 0)) for i in range(60)] + [(100, 1), (101, 1)]
    got = urls.judge(spark.createDataFrame(pages, "page_id long, url string"), spark.createDataFrame(labels, "doc_id long, bad long"))
    shapes = {r.template for r in got.collect()}
    assert "h.example.com/rare/{n}" in shapes and "h.example.com/+/{n}" in shapes
