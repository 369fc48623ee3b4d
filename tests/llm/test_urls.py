from helpers import by_id
from ledgerloom.llm import urls


def plain(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = lambda s, marks: next((s[:i] for i, c in enumerate(s) if c in marks), s)
    host = cut(rest, "/?#")
    path = cut(rest[len(host) :], "?#")
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def plain_rule(host, path):
    fits = [r for r in urls.RULES if (host == r[1] or host.endswith("." + r[1])) and path.startswith(r[2])]
    return max(fits, key=lambda r: len(r[1] + r[2]), default=None)


URLS = [
    None, "", "no scheme", "http://", "http://A.Example.ORG/es/x?y#z", "https://example.org/en/1", "https://m.example.org/en/123.html", "http://example.org/en/2",
    "http://badexample.org/es/", "http://x.com/fr/1", "http://x.com/de/1", "http://com/de/", "http://xcom/de/", "http://x.org", "http://x.org?/", "http://x.org#/es/",
    "a://b://c.org/", "http://ÄB.net/Ä", "http://x.net\n/y", "http://cheap-pills.example.net/en/4", "http://casino-win.example.net/fr/4", "http://weather.example.net/en/4",
]


def test_parts_rules_and_verdicts(spark):
    rows = list(enumerate(URLS)) + [(None, URLS[5])]
    pages = spark.createDataFrame([(i, u, "<html>", 0, 0) for i, u in rows], "page_id long, url string, html string, score int, found int")
    found = by_id(urls.judge(pages), "page_id")
    for i, url in rows:
        host, path = plain(url)
        rule = plain_rule(host, path)
        r = found[i]
        assert (r["host"], r["path"]) == (host, path)
        assert r["rule"] == (rule and rule[1] + rule[2])
        assert r["verdict"] == (rule[0] if rule else "block" if r["score"] >= 0.5 else "allow")
    assert found[19]["verdict"] == found[20]["verdict"] == "block" and found[21]["verdict"] == "allow"
    assert urls.judge(pages.limit(0)).count() == 0


def test_real_pages(spark, folder):
    pages = spark.read.parquet(f"{folder}/pages.parquet")
    truth = by_id(pages, "page_id")
    found = by_id(urls.judge(pages), "page_id")
    spam = ("cheap-pills", "casino-win", "free-bets", "ads-track", "spam-farm")
    by_method = [i for i, r in found.items() if r["rule"] is None]
    right = [(found[i]["verdict"] == "block") == any(s in truth[i]["url"] for s in spam) for i in by_method]
    assert len(found) == len(truth) and sum(right) / len(right) > 0.97


def test_the_labelled_table_is_learned(spark):
    table = [(n, u) for n, u in enumerate(urls.BLOCKED + urls.ALLOWED)]
    scores = by_id(urls.judge(spark.createDataFrame(table, "page_id long, url string")), "page_id")
    assert all((scores[n]["score"] >= 0.5) == (n < len(urls.BLOCKED)) for n, _ in table)
