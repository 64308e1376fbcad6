import random
import re

import pytest

from skytide.llm.url_filter import LIST_RULES, PATTERN_RULES, default_rules, filter_list, judge, list_rule, pattern_rule, rule_index

SCHEMA = "page_id bigint, url string"
URLS = [
    "http://x.net", "http://x.net/", "https://Sub.Example.NET/en/1?x=/de/", "https://example.net/english", "http://notexample.net/en/1",
    "http://example.com/de/", "http://a.example.com/de/1#t", "http://example.com/DE/1", "http://myorg/fr/1", "http://a.org/fr/x", "http://org/fr/",
    "http://spam-farm.example.org/en/1", "http://spam-farms.example.org/", "http://www.CHEAP-pills.example.com/x", "http://a.b/online-casino?x",
    "http://a.b/casinos", "http://10.0.0.1/x", "http://a.b/?utm_campaign=spam&y", "http://a.b/xxx/", "mailto:me", "", None, "://", "://?q", "http://é.net/ü?x",
    "http://a.net?://b.org/fr/", "http://a.b/c://d.net/", "http://u@h.net:80/p", "http://spam-farm.net/", "x" * 50_000, "http://a.b/" + "y/" * 20_000,
]


def brute(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        raw = re.match("[^/?#]*", rest)[0]
        path = re.match("[^?#]*", rest[len(raw) :])[0]
        host = raw.translate({c: c + 32 for c in range(65, 91)})
    fits = []
    for name, verdict in LIST_RULES:
        h, p = name.split("/", 1)
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
            fits.append((len(name), name, verdict))
    if fits:
        return host, path, max(fits)[1], max(fits)[2]
    plain = (url or "").translate({c: c + 32 for c in range(65, 91)})
    verdicts = {v for _, v, p, _ in PATTERN_RULES if re.search(p, plain)}
    return host, path, None, "block" if "block" in verdicts else "allow"


def test_matches_every_rule_tried_on_every_url(spark):
    rows = list(enumerate(URLS)) + [(1, URLS[4])] * 5 + [(None, URLS[2]), (None, None)]
    got = judge(spark.createDataFrame(rows, SCHEMA).repartition(3))
    mine = sorted(((r.page_id, r.host, r.path, r.rule, r.verdict) for r in got.collect()), key=str)
    assert mine == sorted(((i, *brute(u)) for i, u in rows), key=str)


def test_rules_are_filed_under_their_rarest_literal(spark):
    tokens = spark.createDataFrame([("spam",)] * 5 + [("farm",)] * 2 + [("example",)] * 3 + [("net",)] * 9, "token string")
    index = {r.rule: r.token for r in rule_index(spark, [r for r in default_rules() if r.literals], tokens).collect()}
    assert index["spam farms"] == "farm" and index["example.net/en/"] == "en" and index["net/"] == "net" and index["pill shops"] == "cheap"


def test_literals_are_whole_tokens_of_every_match():
    assert list_rule("example.net/en/us", "allow").literals == ("example", "net", "en")
    for rule in default_rules():
        for url in URLS:
            plain = (url or "").lower()
            text = "".join(brute(url)[:2]) if rule.listed else plain
            if re.search(rule.pattern, text):
                assert set(rule.literals) <= set(re.findall("[a-z0-9]+", plain))


def test_edges(spark):
    assert judge(spark.createDataFrame([], SCHEMA)).collect() == []
    got = judge(spark.createDataFrame([(1, "http://a.b/", 2, "z")], SCHEMA + ", host int, rule string")).collect()
    assert [(r.host, r.path, r.rule, r.verdict) for r in got] == [("a.b", "/", None, "allow")]
    assert judge(spark.createDataFrame([(1, "http://a.net/")], SCHEMA), []).first().verdict == "allow"
    both = [pattern_rule("a", "allow", "good", ("good",)), pattern_rule("b", "block", "bad", ())]
    rows = [(1, "http://good"), (2, "http://good-bad"), (3, "http://bad")]
    assert [r.verdict for r in judge(spark.createDataFrame(rows, SCHEMA), both).orderBy("page_id").collect()] == ["allow", "block", "block"]


LIST = ["! comment", "[header]", "", "||ads.example.com^", "|http://start.", "end.gif|", "/banner/*/img^", "@@||ads.example.com/ok^", "||x.org^*tail|", "/ads[0-9]+[.]js$/", "track^"]


def tried_on_every_url(rules, url):
    plain = (url or "").translate({c: c + 32 for c in range(65, 91)})
    fits = [r for r in rules if re.search(r.pattern, plain)]
    best = max(fits, key=lambda r: r.length, default=None)
    return best.verdict if best else "allow"


def test_notation_of_filter_lists(spark):
    rules = filter_list(LIST)
    expected = {
        "http://ads.example.com/x": "block", "https://a.ads.example.com:8080/x": "block", "http://ads.example.community/": "allow", "http://bads.example.com/": "allow",
        "http://ads.example.com/ok": "allow", "http://ads.example.com/ok/2": "allow", "http://ads.example.com/okay": "block", "http://start.de/": "block",
        "https://a.b/?http://start.de/": "allow", "http://a.b/friend.gif": "block", "http://a.b/end.gif?x": "allow", "http://a.b/banner/1/2/img?x": "block",
        "http://a.b/banner/1/imgs": "allow", "http://x.org/1/tail": "block", "http://y.x.org?tail": "block", "http://x.org/tails": "allow", "http://a.b/ads12.js": "block",
        "http://a.b/backtrack": "block", "HTTP://A.B/TRACK/": "block", "http://a.b/tracks": "allow",
    }
    got = judge(spark.createDataFrame(list(enumerate(expected)), SCHEMA), rules).orderBy("page_id").collect()
    assert {u: r.verdict for u, r in zip(expected, got)} == expected
    assert all(tried_on_every_url(rules, u) == v for u, v in expected.items())
    assert {r.rule: r.literals for r in rules}["||ads.example.com^"] == ("ads", "example", "com")
    assert {r.rule: r.literals for r in rules}["/banner/*/img^"] == ("banner", "img") and {r.rule: r.literals for r in rules}["track^"] == ()
    with pytest.raises(ValueError, match="options"):
        filter_list(["||a.b^$script"])


def test_thousands_of_rules_equal_every_rule_on_every_url(spark):
    rng = random.Random(6)
    words = ["ads", "img", "track", "shop", "news", "cdn", "pixel", "blog", "x1", "promo"] + [f"w{k}" for k in range(300)]
    word = lambda: rng.choice(words)
    forms = [lambda: f"||{word()}.example.{rng.choice(['com', 'org'])}^", lambda: f"/{word()}/{word()}^", lambda: f"||{word()}.net/{word()}/*{word()}", lambda: f"{word()}-{word()}",
             lambda: f"@@||{word()}.net/{word()}^", lambda: f"|https://{word()}.", lambda: f".{word()}|"]
    rules = filter_list(dict.fromkeys(rng.choice(forms)() for _ in range(2000)))
    urls = [f"http{rng.choice(['', 's'])}://{word()}.{rng.choice(['net', 'example.com', 'example.org'])}/{word()}/{word()}{rng.choice(['', '-'])}{word()}{rng.choice(['', '.' + word(), '?' + word()])}" for _ in range(150)]
    got = judge(spark.createDataFrame(list(enumerate(urls)), SCHEMA), rules).collect()
    assert {r.page_id: r.verdict for r in got} == {k: tried_on_every_url(rules, u) for k, u in enumerate(urls)}
    assert len({r.verdict for r in got}) == 2
