"""Hosts, paths and rules against a plain reading, templates on a planted tree, awkward rows."""

import random
import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from recordloom.llm.queries import URL_BAD_WORDS, URL_RULES, op8_url_filters
from recordloom.llm.url_templates import judge_urls, path_templates, general_segments


def plain(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), re.match(r"[^?#]*", rest[len(host):])[0]


def plain_rule(host, path):
    fits = [r for r in URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.text), default=None)


def test_rules_match_a_plain_reading(spark):
    draw = random.Random(2)
    hosts = ["a.example.net", "example.net", "EXAMPLE.com", "b.example.com", "x.org", "org", "notexample.net", "nét.org", "net", "example.com:80", ""]
    paths = ["", "/", "/en/1", "/de/2.html", "/fr/", "/EN/3", "/fr", "//de/", "/de/é ü"]
    urls = [None, "", "no scheme", "a://b://c/d", "x:/y", "://?", "http://net?x/de/", "http://h#/fr/://z"]
    urls += [f"{draw.choice(['http', 'HTTPS', ''])}://{draw.choice(hosts)}{draw.choice(paths)}{draw.choice(['', '?q=/de/', '#top', '?a#b'])}" for _ in range(300)]
    pages = spark.createDataFrame([(k, u, "t") for k, u in enumerate(urls)], "page_id long, url string, template string").repartition(4)
    got = {r.page_id: r for r in judge_urls(pages, URL_RULES).collect()}
    assert len(got) == len(urls)
    for k, url in enumerate(urls):
        host, path = plain(url)
        rule = plain_rule(host, path)
        assert (got[k].host, got[k].path, got[k].rule) == (host, path, rule and rule.text)
        assert got[k].verdict == (rule.verdict if rule else got[k].verdict) and got[k].verdict in ("allow", "block")


def test_planted_tree(spark):
    data = []
    for k in range(60):
        data += [(k, f"http://h/shop/item{k}/buy", True), (k, f"http://h/shop/item{k}/view", False), (k, f"http://h/blog/{k}", False)]
        data += [(k, f"http://other/{k:x}{'abcdef' * 2}/p", None), (k, f"http://h/{'a' * (k % 7 + 1)}/q", False)]
    data += [(100, "http://h/shop/item900/buy", None), (101, "http://h/shop/item901/view", None), (102, "http://unknown/shop/item1/buy", None)]
    pages = spark.createDataFrame(data, "page_id long, url string, spam boolean")
    got = {(r.page_id, r.url_path): r for r in judge_urls(pages, [], bad=F.col("spam")).withColumn("url_path", F.col("path")).collect()}
    assert got[100, "/shop/item900/buy"].verdict == "block" and got[101, "/shop/item901/view"].verdict == "allow"
    assert got[102, "/shop/item1/buy"].verdict == "allow"
    assert got[100, "/shop/item900/buy"].template == "/shop/item{n}/buy"
    # Short names that are labelled alike are one branch.
    parsed = pages.where("url like 'http://h/a%'").select(F.lit("h").alias("host"), general_segments(F.regexp_extract("url", "//h(.*)", 1), 5).alias("segments"), F.col("spam").alias("bad"))
    assert {r.template for r in path_templates(parsed).collect()} == {"/*/q"}


def test_paths_that_differ_far_down(spark):
    data = [(k, f"http://h/a/b/c/d/e/f/{name}/{k}", name == "spam") for k in range(40) for name in ("spam", "good")]
    data += [(100, "http://h/a/b/c/d/e/f/spam/900", None), (101, "http://h/a/b/c/d/e/f/good/900", None)]
    pages = spark.createDataFrame(data, "page_id long, url string, spam boolean")
    got = {r.page_id: r.verdict for r in judge_urls(pages, [], bad=F.col("spam"), least_purity=0.7).where("page_id >= 100").collect()}
    assert got == {100: "block", 101: "allow"}


def test_awkward_rows(spark):
    pages = spark.createDataFrame([(None, None), (1, "http://h/" + "x/" * 50_000), (2, "http://h/a"), (2, "http://h/a")], "page_id long, url string")
    pages = pages.withColumns({n: F.lit(n) for n in ("host", "path", "rule", "bad", "segments")})
    got = judge_urls(pages, URL_RULES).collect()
    assert len(got) == 4 and {r.verdict for r in got} == {"allow"}
    assert judge_urls(pages.limit(0), URL_RULES).count() == 0


def test_words_label_templates(spark):
    name = lambda k: chr(97 + k // 26) + chr(97 + k % 26)
    data = [(k, f"http://h.test/{kind}/{name(k)}{word}") for k in range(60) for kind, word in (("offers", "-pills"), ("news", ""))]
    data += [(900, "http://h.test/offers/zz"), (901, "http://h.test/news/zz-pills"), (902, "http://h.test/news/spamming")]
    pages = spark.createDataFrame(data, "page_id long, url string")
    got = {r.page_id: r.verdict for r in judge_urls(pages, [], bad_words=["pills", "spam"]).where("page_id >= 900").collect()}
    # A page in a bad template goes without a word, one in a good template stays with one.
    assert got == {900: "block", 901: "allow", 902: "allow"}


def test_registered_query_against_brute_force(spark):
    got = op8_url_filters(spark, "/root/testdata/sf0.1").collect()
    templates, hosts = defaultdict(Counter), defaultdict(Counter)
    for r in got:
        rule, words = plain_rule(r.host, r.path), re.split("[^a-z]+", f"{r.host}/{r.path}".lower())
        bad = rule.verdict == "block" if rule else bool(set(words) & set(URL_BAD_WORDS))
        templates[r.host, r.template][bad] += 1
        hosts[r.host][bad] += 1
    whole = (sum(h[True] for h in hosts.values()) + 1) / (len(got) + 2)
    blocked = 0
    for r in got:
        base = (hosts[r.host][True] + 4 * whole) / (hosts[r.host].total() + 4)
        own = templates[r.host, r.template]
        purity = (own[True] + 4 * base) / (own.total() + 4)
        assert abs(purity - r.purity) < 1e-9
        rule = plain_rule(r.host, r.path)
        wanted = rule.verdict if rule else "block" if own[True] and purity >= 0.8 else "allow"
        assert r.verdict == wanted
        blocked += not rule and wanted == "block"
        # Nothing of a host without a listed word or rule is lost.
        assert r.verdict == "allow" or rule or hosts[r.host][True]
    assert blocked > 0
