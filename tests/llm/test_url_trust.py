"""Host rules and trust against plain Python: power iterations on a dictionary graph, long chains, hubs, odd urls."""

import random

from weftline.llm import url_trust

SCHEMA = "page_id long, url string, html string, host int, salt int, rule int, verdict int"


def split(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, rest = rest[:cut], rest[cut:]
    path = rest[: min([rest.find(c) for c in "?#" if c in rest], default=len(rest))]
    return host.translate({c: c + 32 for c in range(65, 91)}), path


def rule_of(host, path):
    best = None
    for _, rule in url_trust.RULES:
        h, _, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (best is None or len(rule) > len(best)):
            best = rule
    return best


def ranks(links, seeds, damping=0.85, rounds=400):
    total = sum(seeds.values())
    if not total:
        return {}
    out = {}
    for (a, _), w in links.items():
        out[a] = out.get(a, 0) + w
    base = {h: (1 - damping) * r / total for h, r in seeds.items()}
    now = dict(base)
    for _ in range(rounds):
        new = dict(base)
        for (a, b), w in links.items():
            if a in now:
                new[b] = new.get(b, 0) + damping * now[a] * w / out[a]
        now = new
    return now


def brute(rows):
    way = {r: v for v, r in url_trust.RULES}
    links, seen, marked = {}, {}, {"allow": {}, "block": {}}
    for _, url, html, *_ in rows:
        host, path = split(url)
        if not host:
            continue
        seen[host] = seen.get(host, 0) + 1
        rule = rule_of(host, path)
        if rule:
            marked[way[rule]][host] = marked[way[rule]].get(host, 0) + 1
        for to in {x.split('"')[0].split("/")[0].lower() for x in (html or "").split('href="http://')[1:]}:
            if to != host:
                links[host, to] = links.get((host, to), 0) + 1
    trust = ranks(links, {h: n / seen[h] for h, n in marked["allow"].items()})
    distrust = ranks({(b, a): w for (a, b), w in links.items()}, {h: n / seen[h] for h, n in marked["block"].items()})
    out, close = [], set()
    for page, url, *_ in rows:
        host, path = split(url)
        rule = rule_of(host, path)
        t, d = trust.get(host, 0), distrust.get(host, 0)
        if rule is None and (t or d) and abs(t - d) < 5e-4:
            close.add(host)
        out.append((page, host, path, rule, way[rule] if rule else "block" if d > t else "allow"))
    return out, close


def judged(spark, rows):
    got = url_trust.judge(spark.createDataFrame(rows, SCHEMA))
    assert got.columns == ["page_id", "host", "path", "rule", "verdict"]
    return sorted(map(tuple, got.collect()), key=str)


def page(i, url, *to):
    return (i, url, " ".join(f'<a href="http://{h}/x">' for h in to), 0, 0, 0, 0)


def test_odd_urls(spark):
    urls = [None, "", "no scheme", "http://", "http://ORG/x", "http://a.b.org?q", "http://example.org/es/1", "http://example.org/en/10", "http://example.org/en/2", "http://com/de/1", "http://x.com/de", "http://x.com/fr/#a", "http://xcom/de/1", "a://b://c/d", "x\ny://H\n/p\n?q", "http://\u00c9x.net/\u00e9"]
    rows = [page(i, u) for i, u in enumerate(urls)] + [(None, None, None, None, None, None, None), page(3, "http://com/de/1"), page(3, "http://com/de/1")]
    want, _ = brute(rows)
    assert judged(spark, rows) == sorted(want, key=str)


def test_trust_and_distrust_on_a_graph_with_a_hub_and_a_long_chain(spark):
    rng = random.Random(4)
    hosts = [f"h{i}.net" for i in range(40)]
    rows = [page(i, f"http://{h}/p", *rng.sample([*hosts, "good.org", "x.com"], 3), *(["hub.net"] if i % 2 else [])) for i, h in enumerate(hosts * 2)]
    rows += [page(500 + i, f"http://c{i}.net/", f"c{i + 1}.net") for i in range(25)]  # a chain to a blocked host
    rows += [page(600, "http://c25.net/", "bad.com"), page(601, "http://bad.com/de/1", "h1.net"), page(602, "http://good.org/1", "h2.net", "d0.net"), page(603, "http://hub.net/", *hosts)]
    rows += [page(610 + i, f"http://d{i}.net/", f"d{i + 1}.net") for i in range(25)]  # and one from a trusted one
    rows += [page(700 + i, "http://hub.net/" + str(i)) for i in range(60)]
    want, close = brute(rows)
    far = {f"c{i}.net" for i in range(26)}
    assert {h for _, h, _, _, v in want if v == "block"} >= far - close and len(far - close) >= 12
    got = judged(spark, rows)
    assert [r for r in got if r[1] not in close] == sorted((r for r in want if r[1] not in close), key=str)
    assert {r[1] for r in got if r[4] == "block"} >= {f"c{i}.net" for i in range(10, 26)}  # beyond eight links from the seed


def test_empty_and_no_seeds(spark):
    assert judged(spark, []) == []
    rows = [page(1, "http://a.net/", "b.net"), page(2, "http://b.net/")]
    assert {r[4] for r in judged(spark, rows)} == {"allow"}
