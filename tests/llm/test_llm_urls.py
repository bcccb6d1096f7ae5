"""URL filters (op9): rules, links, allow before block."""
from tidewatch.llm import urls as U

PAGE = "page_id long, url string, html string, host string, rule string, key string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", "x") for r in rows], PAGE)


def canonical(href):
    return f'<html><head><LINK href="{href}" rel=canonical></head>'


def refresh(href):
    return f"<meta http-equiv='refresh' content='0; URL={href}'>"


def rule_cases():
    return {
        "http://a.ORG/x": ("a.org", "/x", "org/", "allow"), "https://org": ("org", "", None, None),
        "x://www.example.org/es/a?q#f": ("www.example.org", "/es/a", "example.org/es/", "block"),
        "http://example.org/en/17": ("example.org", "/en/17", "example.org/en/1", "block"),
        "http://example.org/en/27": ("example.org", "/en/27", "org/", "allow"),
        "http://badexample.org/es/": ("badexample.org", "/es/", "org/", "allow"),
        "http://a.com/de/?x": ("a.com", "/de/", "com/de/", "block"), "http://a.com/fr": ("a.com", "/fr", None, None),
        "http://a.com?de/": ("a.com", "", None, None), "no scheme": ("", "", None, None), "": ("", "", None, None),
        "a://b://c/d": ("b:", "//c/d", None, None), "http://com/fr/x\ny": ("com", "/fr/x\ny", "com/fr/", "allow"),
    }



def test_rules_and_defined_cases(spark):
    cases = rule_cases()
    rows = [(k, u, None) for k, u in enumerate(cases)] + [(90, None, canonical("http://a.com/de/")), (91, "http://a.com/de/x", None), (91, "http://a.com/de/x", "")]
    got = sorted((r.page_id, r.host, r.path, r.rule, r.verdict) for r in U.url_filter(pages(spark, rows)).collect())
    want = [(k, h, p, r, v or "allow") for k, (h, p, r, v) in enumerate(cases.values())]
    assert got == sorted(want + [(90, "", "", None, "allow")] + [(91, "a.com", "/de/x", "com/de/", "block")] * 2)
    assert U.url_filter(pages(spark, [])).count() == 0


def test_block_spreads_over_links_and_allow_goes_first(spark):
    rows = [
        (1, "http://one.net/a", canonical("http://two.net/b")), (2, "https://two.net/b/#top", refresh("/c?x=1&amp;utm_source=f")),
        (3, "http://two.net/c?x=1", None), (4, "http://three.net/", canonical("//one.net/a/")), (5, "http://blocked.com/de/1", canonical("http://two.net/c?x=1")),
        (6, "http://six.net/", canonical("http://other.com/de/9")),  # the target is no page of the table
        (7, "http://seven.net/", canonical("http://other.com/de/8")), (8, "http://eight.net/q", refresh("http://seven.net")), (9, "http://x.org/", canonical("http://eight.net/q")),
        (10, "http://ten.net/dir/page", canonical("next")), (11, "http://ten.net/dir/next", canonical("http://example.org/es/")),
        (12, "http://twelve.net/", canonical("mailto:a@b") + refresh("")), (13, "http://thirteen.net/", None), (14, "http://one.net/a?utm_campaign=2", "<a href='http://a.com/de/'>"),
    ]
    log = spark.createDataFrame([("http://thirteen.net", "http://gone.com/de/"), (None, "http://a.com/de/"), ("no scheme", "http://six.net/")], "src string, dst string")
    got = {r.page_id: (r.rule, r.verdict) for r in U.url_filter(pages(spark, rows), log).collect()}
    assert got == {1: (None, "block"), 2: (None, "block"), 3: (None, "block"), 4: (None, "block"), 5: ("com/de/", "block"), 6: (None, "block"),
                   7: (None, "allow"), 8: (None, "allow"), 9: ("org/", "allow"), 10: (None, "block"), 11: (None, "block"), 12: (None, "allow"),
                   13: (None, "block"), 14: (None, "block")}
