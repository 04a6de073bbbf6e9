"""URL filters against plain Python."""

from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict

import pytest

from dockhand import SpecError
from dockhand.llm import reputation
from dockhand.llm.queries import URL_RULES

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def parts(url):
    at = (url or "").find("://")
    if at < 0:
        return "", ""
    host = re.match(r"[^/?#]*", url[at + 3:])[0]
    return host.translate(LOWER), re.match(r"[^?#]*", url[at + 3 + len(host):])[0]


def rule_of(host, path, rules):
    fitting = [r for r in rules if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    return max(fitting, key=lambda r: len(r[0] + r[1]), default=None)


def place(host):
    labels = re.sub(r"\.?(:[0-9]*)?$", "", re.sub("^.*@", "", host)).split(".")
    if re.fullmatch(r"[0-9]+|\[.*", "".join(labels)):
        return ".".join(labels), ""
    n = 2 if len(labels) > 2 and len(labels[-1]) == 2 and labels[-2] in reputation.SECOND_LEVELS else 1
    return ".".join(labels[-n - 1:]), ".".join(labels[-n:])


def shrunk(groups, mean_of):
    """Prior weight, and posterior mean by group, of counts below their parents' means."""
    over = pairs = 0.0
    for key, (n, k) in groups.items():
        m = mean_of(key)
        over += (k - n * m) ** 2 - n * m * (1 - m)
        pairs += n * (n - 1) * m * (1 - m)
    low, high = reputation.WEIGHTS
    weight = high if over <= 0 else min(max(pairs / over - 1, low), high)
    return weight, {key: (k + weight * mean_of(key)) / (n + weight) for key, (n, k) in groups.items()}


def posteriors(rows, outcomes):
    good = defaultdict(list)
    for page, value in outcomes:
        if page is not None and value is not None:
            good[page].append(value)
    hosts = defaultdict(lambda: [0, 0])
    for page, url in rows:
        counts = hosts[parts(url)[0]]
        if page in good:
            counts[0] += 1
            counts[1] += all(good[page])
    domains, suffixes, whole = defaultdict(lambda: [0, 0]), defaultdict(lambda: [0, 0]), [0, 0]
    for host, (n, k) in hosts.items():
        domain, suffix = place(host)
        for counts in (domains[domain, suffix], suffixes[suffix], whole):
            counts[0] += n
            counts[1] += k
    top = (whole[1] + 1) / (whole[0] + 2)
    _, by_suffix = shrunk(suffixes, lambda key: top)
    _, by_domain = shrunk(domains, lambda key: by_suffix[key[1]])
    weight, _ = shrunk(hosts, lambda host: by_domain[place(host)])
    found = {}
    for host, (n, k) in hosts.items():
        m = by_domain[place(host)]
        a, b = weight * m + k, weight * (1 - m) + n - k
        mean = a / (a + b)
        spread = math.sqrt(a * b / ((a + b) ** 2 * (a + b + 1)))
        found[host] = n, k, mean, min(mean + reputation.DEVIATIONS * spread, 1)
    return found


def expected(rows, outcomes, rules=(), min_good=reputation.MIN_GOOD):
    scores, out = posteriors(rows, outcomes), []
    for page, url in rows:
        host, path = parts(url)
        rule = rule_of(host, path, rules)
        n, k, mean, bound = scores[host]
        verdict = rule[2] if rule else "block" if bound < min_good else "allow"
        out.append((page, host, path, rule and rule[0] + rule[1], verdict, n, k, round(mean, 9), round(bound, 9)))
    return Counter(out)


def judged(df, outcomes, rules=(), **options):
    result = reputation.judge_urls(df, outcomes, rules, **options)
    return Counter(
        (r.page_id, r.host, r.path, r.rule, r.verdict, r.n_labelled, r.n_good, round(r.good_rate, 9), round(r.good_bound, 9))
        for r in result.collect()
    )


def frames(spark, rows, outcomes):
    return (
        spark.createDataFrame(rows, "page_id long, url string").repartition(3),
        spark.createDataFrame(outcomes, "page_id long, good boolean"),
    )


ODD_URLS = [
    None, "", "no scheme", "://", "http://", "HTTP://WWW.Example.COM/En/x", "http://www.example.com/en/?q#f",
    "https://example.com", "https://example.com?/en/", "http://a.b.example.net/es/1", "http://example.net/fr/",
    "http://notexample.com/en/", "http://com/", "http://com", "x\ny://h.co.uk/p\nq?z", "http://u:p@H.org:8080/",
    "http://10.0.0.1/a", "http://[::1]/b", "http://a.co.uk./", "http://ÄÖ.DE/ü", "http://a://b/c", "http://.com/x",
    "http://" + "long." * 5000 + "net/es/" + "x" * 10000,
]


def random_pages(seed, n=1500):
    rng = random.Random(seed)
    domains = [f"{name}.{end}" for name in ("good", "bad", "some", "few") for end in ("com", "org", "co.uk")]
    rows, outcomes = [], []
    for i in range(n):
        domain = rng.choice(domains)
        rows.append((i, f"http://{rng.choice(['', 'www.', 'm.', f'h{rng.randrange(40)}.'])}{domain}/en/{i}"))
        if rng.random() < 0.4:
            chance = 0.05 if domain.startswith("bad") else 0.9
            outcomes.append((i, rng.random() < chance))
    return rows, outcomes


@pytest.mark.parametrize("seed", [1, 2])
def test_against_plain_python(spark, seed):
    rows, outcomes = random_pages(seed)
    got = judged(*frames(spark, rows, outcomes), URL_RULES)
    assert got == expected(rows, outcomes, URL_RULES)


def test_bad_domains_go_and_good_ones_stay(spark):
    rows, outcomes = random_pages(3)
    got = judged(*frames(spark, rows, outcomes))
    assert {h for _, h, _, _, v, *_ in got if v == "block"} == {h for _, h, *_ in got if "bad." in h}
    # A host without any page of its own follows its domain.
    rows += [(5000, "http://never-seen.bad.org/"), (5001, "http://never-seen.good.org/")]
    verdicts = {page: v for page, _, _, _, v, *_ in judged(*frames(spark, rows, outcomes))}
    assert (verdicts[5000], verdicts[5001]) == ("block", "allow")


def test_odd_urls_and_ids(spark):
    rows = [(i, u) for i, u in enumerate(ODD_URLS)] + [(None, u) for u in ODD_URLS[:9]] + [(5, ODD_URLS[5])] * 2
    outcomes = [(5, True), (5, False), (6, True), (6, None), (None, False), (7, None), (999, False), (10, False)]
    assert judged(*frames(spark, rows, outcomes), URL_RULES) == expected(rows, outcomes, URL_RULES)


def test_one_host_has_most_rows(spark):
    rows, outcomes = random_pages(4, 300)
    rows += [(1000 + i, "http://hot.example.net/x") for i in range(3000)]
    outcomes += [(1000 + i, i % 3 > 0) for i in range(2500)]
    assert judged(*frames(spark, rows, outcomes)) == expected(rows, outcomes)


def test_no_outcomes_and_no_pages(spark):
    rows, _ = random_pages(5, 20)
    got = judged(*frames(spark, rows, []))
    assert got == expected(rows, []) and {r[4] for r in got} == {"allow"}
    assert judged(*frames(spark, [], [])) == Counter()
    assert judged(*frames(spark, [], [(1, True)])) == Counter()


def test_extra_columns_come_back(spark):
    df = spark.createDataFrame(
        [(1, "http://a.com/x", "own", 2, 3, 4, "l", "d")],
        "page_id long, url string, host string, n long, k long, m long, labels string, domain string",
    ).selectExpr("*", "5 AS page", "6 AS row", "7 AS of", "8 AS a", "9 AS good", "10 AS `x.y`")
    outcomes = spark.createDataFrame([(1, True)], "page_id long, good boolean")
    result = reputation.judge_urls(df, outcomes)
    assert result.columns == [*[c for c in df.columns if c != "host"], *reputation.COLUMNS]
    row = result.first()
    assert (row.n, row.k, row.m, row.labels, row.page, row.row, row.of, row.a, row["x.y"], row.host) == (
        2, 3, 4, "l", 5, 6, 7, 8, 10, "a.com"
    )


def test_rules(spark):
    rules = [("a.b", "/x", "block"), ("b", "/x/y", "allow"), ("b", "/", "block")]
    rows = [(1, "http://a.b/x/y"), (2, "http://c.a.b/x"), (3, "http://b/x/yz"), (4, "http://ab/"), (5, "http://B/")]
    assert judged(*frames(spark, rows, []), rules) == expected(rows, [], rules)
    with pytest.raises(SpecError, match="quotes"):
        judged(*frames(spark, rows, []), [("a'", "/", "block")])


def test_no_python_in_the_plan(spark):
    df, outcomes = frames(spark, *random_pages(6, 30))
    plan = reputation.judge_urls(df, outcomes, URL_RULES)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
