import re

from colweave.llm import url_rules as U

BASE = [("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block")]

URLS = [
    "http://a.example.org/es/3", "https://EXAMPLE.org/en/15?page=3", "https://notexample.org/en/1", "http://example.com/fr/1", "http://com/fr/",
    "http://x.com/de/9#top", "http://x.com/DE/9", "http://x.com", "http://x.org", "ftp://x.org/", "no scheme.org/", "", None, "://", "http://",
    "http://b.net/a?utm_source=feed", "http://b.net/wp-admin/x", "http://b.net/awp-adminx", "http://b.net/calendar/2020/1/2", "http://b.net/?sessionid=0123456789",
    "http://org/", "http://é.org/é?x=y", "http://b.net/page?page=1", "http://b.net/p?page=12", "http://casino.b.net", "http://b.net/" + "a/" * 20000 + "porn",
    "http://a.b://example.org/es/", "http://x.com/de/9#top",
]


def brute(url):
    url = url or ""
    if "://" not in url:
        return "", "", None, None, "allow"
    rest = url.split("://", 1)[1]
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    path = re.split(r"[?#]", rest[len(host) :], maxsplit=1)[0]
    low = str.maketrans(U.UPPER, U.LOWER)
    host = host.translate(low)
    fits = []
    for rule, verdict in BASE:
        name, _, tail = rule.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith("/" + tail):
            fits.append((len(rule), rule, verdict))
    patterns = sorted(r.name for r in U.PATTERN_RULES if re.search(r.pattern, rest.translate(low)))
    best = max(fits, default=None)
    return host, path, best and best[1], patterns[0] if patterns else None, best[2] if best else ("block" if patterns else "allow")


def test_against_every_rule_on_every_url(spark):
    rows = [(k, u, "old") for k, u in enumerate(URLS)]
    pages = spark.createDataFrame(rows, "page_id long, url string, verdict string")
    got = U.judge(pages, U.rule_table(spark, [*U.PAGE_RULES, *U.PATTERN_RULES])).collect()
    assert {r.page_id: (r.host, r.path, r.rule, r.pattern, r.verdict) for r in got} == {k: brute(u) for k, u in enumerate(URLS)}
    assert len(got) == len(rows)


def test_without_pages_or_rules(spark):
    none = spark.createDataFrame([], "page_id long, url string")
    table = U.rule_table(spark, U.PAGE_RULES)
    assert U.judge(none, table).collect() == []
    got = U.judge(spark.createDataFrame([(1, "http://a.org/")], "page_id long, url string"), table.where("false")).first()
    assert (got.rule, got.verdict) == (None, "allow")


def test_literals_are_whole_tokens():
    assert U.page_rule("example.org/en/1", "block").literals == ("example", "org", "en")
    assert U.page_rule("org/", "allow").literals == ("org",)


def test_no_python_in_the_plan(spark):
    pages = spark.createDataFrame([(1, "http://a.org/")], "page_id long, url string")
    plan = U.judge(pages, U.rule_table(spark, U.PAGE_RULES))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_names_of_the_operator_as_input_columns(spark):
    taken = ["judged_url", "_judged_url", "_judged_rule", "Judged_Rule", "judged_pattern", "whole", "token", "page", "held_by", "name", "subject"]
    rows = [(k, u, *taken) for k, u in enumerate(URLS)]
    pages = spark.createDataFrame(rows, "page_id long, url string, " + ", ".join(f"`{name}` string" for name in taken))
    got = U.judge(pages, U.rule_table(spark, [*U.PAGE_RULES, *U.PATTERN_RULES]))
    assert got.columns == [*pages.columns, "host", "path", "rule", "pattern", "verdict"]
    got = got.collect()
    assert {r.page_id: (r.host, r.path, r.rule, r.pattern, r.verdict) for r in got} == {k: brute(u) for k, u in enumerate(URLS)}
    assert all([r[name] for name in taken] == taken for r in got)
