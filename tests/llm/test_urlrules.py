"""URL filter: parsing and given rules against plain Python, mined rules against counting."""

import itertools
import random
import time
import re

from titlelens.llm import urlrules

URLS = [
    "https://a.net/x", "http://A.NET", "http://net/", "http://sub.example.net/en/1",
    "http://example.net/en", "http://myexample.net/en/1", "https://www.example.com/de/5?x=1#y",
    "http://example.com/fr/", "http://example.org/fr/9", "http://org/fr/", "http://corg/fr/",
    "nonsense", "", None, "://", "://x", "a://b://net/c", "http://h?q#f", "http://net?/x",
    "http://net#/", "http://example.com/DE/", "http://sub.ORG/fr/é", "HTTP://É.net/"]


def plain(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0] if rest[len(host):][:1] == "/" else ""
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [(h + p, v) for v, h, p in urlrules.RULES
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, max(fits, key=lambda f: len(f[0]), default=None)


def test_parsing_and_given_rules(spark):
    pages = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(URLS)],
                                  "page_id long, url string, host string, rule string")
    for r in urlrules.judge(pages).collect():
        host, path, rule = plain(URLS[r["page_id"]])
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule and rule[0])
        assert r["verdict"] in ("allow", "block")
        if rule:
            assert r["verdict"] == rule[1] and r["mined"] is None


def _mined(baskets, min_support, min_confidence, most):
    """All rules by counting, the redundant ones pruned."""
    n = len(baskets)
    found = {}
    for tokens, _ in baskets:
        for k in range(1, most + 1):
            for part in itertools.combinations(sorted(tokens), k):
                found.setdefault(part, 0)
    implied = {}
    for part in found:
        having = [v for t, v in baskets if set(part) <= set(t)]
        for verdict in set(having):
            both = having.count(verdict)
            if both / n >= min_support and both / len(having) >= min_confidence:
                implied[part, verdict] = (both / len(having), both / n)
    return {(p, v): c for (p, v), c in implied.items() if not any(
        (q, v) in implied and implied[q, v][0] >= c[0]
        for k in range(1, len(p)) for q in itertools.combinations(p, k))}


def test_mined_rules_equal_counting(spark):
    urls = [f"http://{h}.example.{t}/{lang}/{i % 3}" for i, (h, t, lang) in enumerate(
        itertools.product(["a", "b", "c"], ["net", "org", "com"], ["en", "fr", "de"]))] * 2
    rows = [(["t:" + u.split(".")[0][7:], "p:" + u.split("/")[3], "n:" + u[-1]],
             "block" if "/de/" in u or ".net" in u else "allow") for u in urls]
    labelled = spark.createDataFrame(rows, "tokens array<string>, verdict string")
    got = {(tuple(r["items"]), r["verdict"]): (r["confidence"], r["support"])
           for r in urlrules.mine(labelled, 0.05, 0.6).collect()}
    want = _mined(rows, 0.05, 0.6, 3)
    assert {k: tuple(round(x, 9) for x in v) for k, v in got.items()} == {
        k: tuple(round(x, 9) for x in v) for k, v in want.items()}


def test_surest_rule_decides(spark):
    rows = [(i, f"http://x{i}.example.net/en/{i}?page=2") for i in range(40)]
    rows += [(100 + i, f"http://y{i}.other.net/a/{i}?ad=1") for i in range(40)]
    rows += [(200, "http://some.com/q?ad=1"), (201, "http://some.com/q?page=3"),
             (202, "http://some.com/q"), (202, "http://some.com/q"), (None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    got = {}
    for r in urlrules.judge(pages).collect():
        got.setdefault(r["page_id"], []).append(r["verdict"])
    assert got[200] == ["block"] and got[201] == ["allow"]
    assert got[202] == ["allow", "allow"] and got[None] == ["allow"]


def test_nothing_to_learn_from(spark):
    pages = spark.createDataFrame([(1, "http://some.com/"), (2, None)], "page_id long, url string")
    assert {r["verdict"] for r in urlrules.judge(pages).collect()} == {"allow"}
    assert urlrules.judge(pages.limit(0)).count() == 0


def _plain_rules(rows, least, sure):
    """Every set of tokens that implies a verdict surely enough, less those that a smaller one
    implies as surely."""
    from collections import Counter
    sets, verdicts = Counter(), Counter()
    for tokens, verdict in rows:
        for n in range(1, len(set(tokens)) + 1):
            for some in itertools.combinations(sorted(set(tokens)), n):
                sets[some] += 1
                verdicts[some, verdict] += 1
    found = {(some, v): k / sets[some] for (some, v), k in verdicts.items()
             if k >= least * len(rows) and k / sets[some] >= sure}
    return {key: c for key, c in found.items() if not any(
        set(other) < set(key[0]) and v == key[1] and d >= c for (other, v), d in found.items())}


def test_rules_of_any_length(spark):
    """Verdicts that only four tokens together tell."""
    rows = []
    for bits in itertools.product([0, 1], repeat=4):
        tokens = [f"{'abcd'[i]}{b}" for i, b in enumerate(bits)]
        rows += [(tokens, "block" if sum(bits) % 2 else "allow")] * 3
    labelled = spark.createDataFrame(rows, "tokens array<string>, verdict string")
    got = {(tuple(r["items"]), r["verdict"]): r["confidence"]
           for r in urlrules.mine(labelled, 0.01, 0.9).collect()}
    assert got == _plain_rules(rows, 0.01, 0.9) and all(len(k[0]) == 4 for k in got)


def test_a_template_of_many_keys_is_one_item(spark):
    """20 keys that always stand together, in rules with one more token, seen in part elsewhere."""
    keys = "&".join(f"k{i}=1" for i in range(20))
    urls = [f"http://h{i}.net/a?{keys}" for i in range(40)]
    urls += [f"http://h{i}.example.com/x/{i}" for i in range(200)]
    urls += [f"http://h{i}.org/fr/?q={i}" for i in range(100)]
    asked = ["http://new.site/a?k7=3", "http://new.site/b?k3=3", "http://new.site/?q=2",
             "http://new.site/?z=1"]
    pages = spark.createDataFrame(list(enumerate(urls + asked)), "page_id long, url string")
    start = time.perf_counter()
    got = {r["url"]: r for r in urlrules.judge(pages).join(pages, "page_id").collect()}
    assert time.perf_counter() - start < 60
    assert [got[u]["verdict"] for u in asked] == ["block", "block", "allow", "allow"]
    assert got[asked[0]]["mined"] == "key:k0" == got[asked[1]]["mined"]
    assert got[asked[3]]["mined"] is None


def test_alike_tokens_and_matching_by_brute_force(spark):
    rng = random.Random(6)
    rows = []
    for _ in range(300):
        tokens = set(rng.sample("abcdef", 3))
        tokens |= {"g", "h"} & ({"g", "h"} if "a" in tokens else set())
        rows.append((sorted(tokens), "block" if "a" in tokens or rng.random() < 0.3 else "allow"))
    labelled = spark.createDataFrame(rows, "tokens array<string>, verdict string")
    holders = {t: frozenset(i for i, (ts, _) in enumerate(rows) if t in ts) for t in "abcdefgh"}
    assert urlrules.alike(labelled, 0.01) == {
        t: min(o for o in holders if holders[o] == holders[t]) for t in holders}
    assert urlrules.alike(labelled.limit(0), 0.01) == {}
