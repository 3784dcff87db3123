import re

from quayside.llm import url_filter as u
from quayside.llm.queries import HOST_PATH_RULES, URL_RULES

URLS = [
    "https://a.example.org/es/1", "https://EXAMPLE.org/en/1234", "http://example.org/en/2", "http://notexample.org/es/x", "http://x.org", "http://x.org?u=://example.org/es/",
    "http://m.x.com/fr/1#top", "http://x.com/de/", "http://x.com/DE/", "ftp://org/", "no scheme", "", None, "http://a.b/wp-admin/x", "http://example.org/es/cart/", "x" * 100_000 + "://y.org/" + "z" * 100_000,
    "http://user@example.org:80/es/", "http://example.org/es/\n://com/de/", "http://x.com/a.exe", "http://x.com/a.exe?x=1",
]


def plain(url):
    head, mark, tail = (url or "").partition("://")
    host, rest = re.match(r"(?s)([^/?#]*)(.*)", tail if mark else "").groups()
    host, path = host.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")), re.match(r"(?s)[^?#]*", rest)[0]
    fits = [r for r in HOST_PATH_RULES if (host == r[0].split("/")[0] or host.endswith("." + r[0].split("/")[0])) and path.startswith(r[0][r[0].index("/") :])]
    if fits:
        return (host, path, *max(fits, key=lambda r: len(r[0])))
    return host, path, None, "block" if re.search(r"/wp-admin/|\.exe\Z", host + rest) else "allow"


def test_judged_like_all_rules_in_turn(spark):
    frame = spark.createDataFrame([(i, url, "mine", 7) for i, url in enumerate(URLS + URLS[:3])], "page_id long, url string, Verdict string, best long")
    judged = u.judge(frame, URL_RULES)
    assert judged.columns == ["page_id", "url", "best", "host", "path", "rule", "verdict", "pattern"]
    for row in judged.collect():
        assert tuple(row[c] for c in ("host", "path", "rule", "verdict")) == plain(row["url"]), row["url"]


def test_blocks_of_rules_agree(spark):
    frame = spark.createDataFrame([(i, url) for i, url in enumerate(URLS)], "page_id long, url string")
    whole, parts = (sorted(map(str, u.judge(frame, URL_RULES, block=b).collect())) for b in (100, 2))
    assert whole == parts


def test_empty_table_and_no_rules(spark):
    assert u.judge(spark.createDataFrame([], "page_id long, url string"), URL_RULES).count() == 0
    rows = u.judge(spark.createDataFrame([(1, "http://x.org/")], "page_id long, url string"), []).collect()
    assert [(r["rule"], r["verdict"]) for r in rows] == [(None, "allow")]


def test_tokens_stand_alone():
    assert u.host_path_rule("Example.org/en/1", "block").tokens == ("example", "org", "en")
    assert u.wildcard_rule("/ads/*/ban*ner^", "block").tokens == ("ads",)
    assert u.wildcard_rule("|x.y|", "block").tokens == ("x", "y")
    assert u.wildcard_rule("*", "block").tokens == ()
