import re
from collections import Counter

from postlens.llm import url_filter as U
from postlens.llm.queries import QUERIES, URL_RULES


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split("[/?#]", rest, maxsplit=1)[0]
    return (re.sub("[A-Z]", lambda m: m[0].lower(), host), re.split("[?#]", rest[len(host):], maxsplit=1)[0])


def ruled(host, path):
    fit = [r for r in URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fit, key=lambda r: len(r.text)) if fit else None


def frame(spark, urls):
    return spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")


def test_rules_on_the_table(spark):
    d = "/root/testdata/sf0.01"
    urls = {r["page_id"]: r["url"] for r in spark.read.parquet(f"{d}/pages.parquet").collect()}
    out = QUERIES["op3_url_filter"](spark, d).collect()
    assert len(out) == len(urls)
    for r in out:
        host, path = split(urls[r["page_id"]])
        rule = ruled(host, path)
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule.text if rule else None)
        if rule:
            assert r["verdict"] == ("allow" if rule.allow else "block")


ODD = [None, "", "no scheme", "http://", "HTTP://EXAMPLE.NET", "https://a.example.net/en/", "https://example.net/EN/x",
       "https://ÄB.example.com/de/1?x=/fr/", "https://notexample.com/de/", "https://x.org/fr/#a", "ftp://u:p@h.net:80/x", "a://b://c/d",
       "https://x.example.com//de//", "https://x.net?/a", "https://x.net#/a", "https://q.org/" + "/".join("abcdefghijklm"),
       "https://l.org/" + "x" * 100_000, "https://n.example.com/\nde/", "://x.net/"]


def test_odd_urls(spark):
    out = {r["page_id"]: r for r in U.judge(frame(spark, ODD), URL_RULES).collect()}
    assert len(out) == len(ODD)
    for i, u in enumerate(ODD):
        host, path = split(u)
        rule = ruled(host, path)
        assert (out[i]["host"], out[i]["path"], out[i]["rule"]) == (host, path, rule.text if rule else None), u
        assert out[i]["verdict"] == ("allow" if rule is None or rule.allow else "block")


def plain_tree(urls, labelled):
    """Templates, counts and verdicts in plain Python; ``urls`` and ``labelled`` hold (host, shape)."""
    n, bad, good = Counter(urls), Counter(), Counter()
    for key, b in labelled:
        (bad if b else good)[key] += 1
    kinds = {k: [max(n[k], bad[k] + good[k]), bad[k], good[k], ""] for k in n.keys() | bad.keys() | good.keys()}
    for level in range(max((len(s) for _, s in kinds), default=0)):
        child, branch, members = {}, {}, Counter()
        for (h, s), (a, b, g, t) in kinds.items():
            if len(s) > level:
                for d, k in ((child, (h, t, s[level])), (branch, (h, t))):
                    x = d.setdefault(k, [0, 0, 0])
                    x[0] += a
                    x[1] += b
                    x[2] += g
        for h, t, _ in child:
            members[h, t] += 1
        for (h, s), x in kinds.items():
            if len(s) <= level:
                continue
            seg, t = s[level], x[3]
            a, b, g = child[h, t, seg]
            aa, bb, gg = branch[h, t]
            chi = sum((o - a * p) ** 2 / (a * p) for o, p in ((b, bb / aa), (g, gg / aa), (a - b - g, 1 - (bb + gg) / aa)) if p > 1e-12)
            general = members[h, t] > U.KINDS and a < U.RARE * aa or members[h, t] > 1 and chi < U.ALIKE
            x.append(t + "/" + (seg if "{" in seg or seg == "**" else "*" if general else seg))
        for x in kinds.values():
            if len(x) > 4:
                x[3] = x.pop()
    sums = {}
    for (h, _), (a, b, g, t) in kinds.items():
        s = sums.setdefault((h, t), [0, 0])
        s[0] += b
        s[1] += g
    b, g = sum(x[0] for x in sums.values()), sum(x[1] for x in sums.values())
    prior = min(0.5, b / (b + g)) if b + g else 0.0
    return {k: (v[3], (p := (sums[k[0], v[3]][0] + U.PRIOR * prior) / (sum(sums[k[0], v[3]]) + U.PRIOR)) >= U.PURITY
                and sum(sums[k[0], v[3]]) >= U.MIN_LABELLED) for k, v in kinds.items()}


def test_templates_against_plain_version(spark):
    urls = [f"https://h{h}.site/{sec}/{x}" for h in range(3) for sec, n in (("news", 40), ("spam", 30), ("tag", 20))
            for x in ([str(i) for i in range(n)] if sec != "tag" else [f"slug-{'abcdefghijklmnopqrst'[i]}" for i in range(n)])]
    labelled = [(u, 1) for u in urls if "h0" in u and "/spam/" in u][:20] + [(u, 0) for u in urls if "h0" in u and "/news/" in u][:20] \
        + [(u, i % 2) for i, u in enumerate(u for u in urls if "h1" in u)]
    lab = spark.createDataFrame([*labelled, (None, 1), ("https://h0.site/news/1", None)], "url string, bad int")
    out = {r["page_id"]: r for r in U.judge(frame(spark, urls), [], lab).collect()}

    def key(u):
        h, p = split(u)
        return h, tuple("{num}" if s.isdigit() else s for s in p.split("/") if s)

    want = plain_tree([key(u) for u in urls], [(key(u), b) for u, b in labelled])
    for i, u in enumerate(urls):
        template, rejected = want[key(u)]
        assert out[i]["template"] == template and out[i]["verdict"] == ("block" if rejected else "allow"), u
    blocked = {u for i, u in enumerate(urls) if out[i]["verdict"] == "block"}
    assert blocked == {u for u in urls if "h0" in u and "/spam/" in u}
    assert {out[i]["template"] for i, u in enumerate(urls) if "h2" in u and "/tag/" in u} == {"/*/*"}


def test_edge_tables(spark):
    assert U.judge(frame(spark, ["x"]).limit(0), URL_RULES).count() == 0
    from pyspark.sql import functions as F

    more = frame(spark, ["https://a.net/x"] * 3 + [None])
    for c in ("host", "path", "shape", "n", "bad", "good", "template", "rule"):
        more = more.withColumn(c, F.lit(1))
    rows = U.judge(more, URL_RULES).collect()
    assert len(rows) == 4 and sum(r["verdict"] == "block" for r in rows) == 3
    assert not re.search("Python|Pandas|Arrow", U.judge(frame(spark, ["x"]), URL_RULES)._jdf.queryExecution().toString())


def test_small_bad_section_of_a_large_host(spark):
    sizes = {f"s{'abcdefghijklmnopqrst'[i]}": 50 for i in range(20)} | {"sa": 40}            # 20 sections, one of 4 % bad
    urls = [f"https://big.site/{s}/{i}" for s, n in sizes.items() for i in range(n)]
    lab = spark.createDataFrame([(u, int("/sa/" in u)) for u in urls], "url string, bad int")
    out = {urls[r["page_id"]] for r in U.judge(frame(spark, urls), [], lab).collect() if r["verdict"] == "block"}
    assert out == {u for u in urls if "/sa/" in u}
    ruled_urls = [u.replace("big.site", "x.example.com").replace("/sa/", "/de/") for u in urls]
    rows = U.judge(frame(spark, ruled_urls), [U.Rule("example.com/de/", False)]).collect()
    assert {ruled_urls[r["page_id"]] for r in rows if r["verdict"] == "block"} == {u for u in ruled_urls if "/de/" in u}


def test_templates_beyond_eight_segments(spark):
    urls = [f"https://deep.site/a/b/c/d/e/f/g/h/{kind}/{i}" for kind in ("spam", "news") for i in range(20)]
    lab = spark.createDataFrame([(u, int("/spam/" in u)) for u in urls], "url string, bad int")
    out = {urls[r["page_id"]] for r in U.judge(frame(spark, urls), [], lab).collect() if r["verdict"] == "block"}
    assert out == {u for u in urls if "/spam/" in u}
