import re

from stratum.llm import urls

RULES = (urls.Rule("net/", "block"), urls.Rule("example.net/en/", "allow"),
         urls.Rule("example.com/de/", "block"), urls.Rule("org/fr/", "allow"))
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest, re.S)[0]
    return host.translate(LOW), re.match(r"[^?#]*", rest[len(host):], re.S)[0]


def rule(host, path):
    fit = [r for r in RULES if (host == r.host or host.endswith("." + r.host))
           and path.startswith(r.path)]
    return max(fit, key=lambda r: len(r.text), default=None)


URLS = [None, "", "no scheme", "http://", "http://NET/", "http://a.net", "http://a.net/",
        "http://anet/x", "http://Example.NET/en/1", "http://x.example.net/en", "https://É.net/É",
        "http://example.net/en/?q=1", "http://a.example.com/de/x#y", "http://example.com/fr/",
        "http://b.org/fr/1", "http://b.org/fr", "x://org/fr/z?://net/", "http://a.net:80/",
        "http://a\nb.net/x\ny?z", "u://" + "a." * 5000 + "net/" + "p/" * 5000, "ftp://x?y/", "a://b://c/d"]


def test_hosts_paths_and_rules(spark):
    rows = [(i, u, "clash", "clash") for i, u in enumerate(URLS * 3)] + [(None, URLS[5], "", "")]
    df = spark.createDataFrame(rows, "page_id long, url string, host string, _url string")
    got = {r.page_id: r for r in urls.filter_urls(df, RULES, trees=3).collect()}
    assert len(got) == len(rows)
    for i, u, _, _ in rows:
        h, p = split(u)
        r = rule(h, p)
        assert (got[i].host, got[i].path, got[i].rule) == (h, p, r.text if r else None)
        assert got[i].verdict == (r.verdict if r else got[i].verdict)
        assert got[i].verdict in ("allow", "block") and 0 <= got[i].block_score <= 1


def test_model_learns_lexical_features_from_labels(spark):
    from pyspark.sql import functions as F
    rows = [(i, f"http://site{i % 50}.com/a/{i}") for i in range(400)]
    rows += [(1000 + i, f"http://x9{i}-7{i}-3.biz/?a={i}&b=2&c=3&d=999{i}") for i in range(400)]
    df = spark.createDataFrame(rows, "page_id long, url string")
    label = F.when(F.col("page_id") % 2 == 0,
                   F.when(F.col("page_id") >= 1000, "block").otherwise("allow"))
    got = urls.filter_urls(df, (), labels=label).collect()
    assert sum((r.verdict == "block") == (r.page_id >= 1000) for r in got) == len(got)


def test_nothing_to_learn_and_empty(spark):
    df = spark.createDataFrame([(1, "http://a.com/"), (2, None)], "page_id long, url string")
    assert {r.verdict for r in urls.filter_urls(df, RULES).collect()} == {"allow"}
    one = spark.createDataFrame([(1, "http://a.net/"), (2, "http://b.com/")],
                                "page_id long, url string")
    assert {r.verdict for r in urls.filter_urls(one, RULES).collect()} == {"block"}
    assert urls.filter_urls(df.limit(0), RULES).count() == 0


def test_a_hot_url_leaves_the_others_in_training(spark):
    from pyspark.sql import functions as F
    rows = [f"http://a{i}.com/" + ("p?x=1&y=2&z=3" if i % 2 else "p") for i in range(200)]
    rows += ["http://hot.com/p"] * 5000
    df = spark.createDataFrame(list(enumerate(rows)), "page_id long, url string")
    label = F.when(F.col("url").contains("?"), "block").otherwise("allow")
    got = urls.filter_urls(df, (), labels=label, max_train=60, trees=3).collect()
    assert {r.page_id: r.verdict for r in got} == {
        i: "block" if "?" in u else "allow" for i, u in enumerate(rows)}
