"""URL filter by rules and a learnt path-template tree, in DataFrame functions only.

Explicit rules come first.  Every other url is judged by its template: per
host, path segments are generalised level by level (numbers, hashes and dates
by their form), branches whose labels are statistically alike are merged, and
so are rare ones with too few labels to tell; what was merged is tested against
the merged ones again, and a template is rejected
when the smoothed share of bad among its labelled urls is high.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import col, lower_ascii, stored

#: A branch with more kinds of segments than this has rare ones, those below this share of it: without enough labels
#: to test they are generalised.
KINDS, RARE = 8, 0.05
#: Branches are alike below this chi-square (2 degrees of freedom, 5 %).
ALIKE = 5.99
#: Labelled urls that the prior counts for, fewest labelled urls of a rejected template, and its smallest purity.
PRIOR, MIN_LABELLED, PURITY = 5.0, 5, 0.8


@dataclass(frozen=True)
class Rule:
    """A host (with its subdomains) and a path prefix, written as host + path."""

    text: str
    allow: bool

    @property
    def host(self) -> str:
        return self.text.split("/", 1)[0]

    @property
    def path(self) -> str:
        return self.text[len(self.host):]


def parts(url: Column) -> tuple[Column, Column]:
    """(host, path): empty where the url is null or has no ``://``."""
    whole = F.coalesce(url.contains("://"), F.lit(False))
    after = F.substr(url, F.instr(url, "://") + 3, F.length(url))
    host = lower_ascii(F.regexp_extract(after, r"^([^/?#]*)", 1))
    path = F.regexp_extract(after, r"^[^/?#]*([^?#]*)", 1)
    return F.when(whole, host).otherwise(F.lit("")), F.when(whole, path).otherwise(F.lit(""))


def rule_of(host: Column, path: Column, rules: list[Rule]) -> Column:
    """The longest fitting rule as struct(rule, verdict), else null."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for r in sorted(rules, key=lambda r: (len(r.text), r.text)):       # later conditions are asked first
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        value = F.struct(F.lit(r.text).alias("rule"), F.lit("allow" if r.allow else "block").alias("verdict"))
        found = F.when(fits, value).otherwise(found)
    return found


def shapes(path: Column) -> Column:
    """Path segments, with numbers, hashes and dates replaced by their form."""
    def shape(s):
        ext = F.regexp_extract(s, r"(\.[A-Za-z]{1,5})$", 1)
        stem = F.substr(s, F.lit(1), F.length(s) - F.length(ext))
        kind = (F.when(stem.rlike("^[0-9]+$"), F.lit("{num}"))
                .when(stem.rlike("^[0-9]{4}[-_.][0-9]{1,2}([-_.][0-9]{1,2})?$"), F.lit("{date}"))
                .when(stem.rlike("^(?=.*[0-9])[0-9a-fA-F-]{8,}$"), F.lit("{hex}"))
                .when(stem.rlike("^[A-Za-z]{1,4}[-_]?[0-9]{2,}$"), F.concat(F.regexp_extract(stem, "^([A-Za-z]+)", 1), F.lit("{num}")))
                .when(stem.rlike("^(?=.*[0-9])[^/]{24,}$"), F.lit("{id}"))
                .otherwise(stem))
        return F.concat(kind, ext)

    segments = F.filter(F.split(path, "/"), lambda s: s != "")
    return F.transform(segments, shape)


def _sums() -> list[Column]:
    return [F.sum(c).alias(c) for c in ("n", "bad", "good")]


def _chi(of: str) -> Column:
    """Chi-square of a child's labels (bad, good, none) against the shares in columns ``of``_n, _bad, _good."""
    n, bad, good = (F.col(f"{of}_{c}") for c in ("n", "bad", "good"))
    seen = [F.col("bad"), F.col("good"), F.col("n") - F.col("bad") - F.col("good")]
    return sum((F.when(p > 1e-12, (o - F.col("n") * p) ** 2 / (F.col("n") * p)).otherwise(F.lit(0.0))
                for p, o in zip((bad / n, good / n, 1 - (bad + good) / n), seen)), F.lit(0.0))


def tree(urls: DataFrame) -> DataFrame:
    """(host, shape, template) for each kind of path of ``urls`` (host, shape, n, bad, good; one row per kind)."""
    state = stored(urls.withColumn("template", F.lit("")), "url-tree")
    depth = state.agg(F.max(F.size("shape"))).first()[0] or 0
    for level in range(1, depth + 1):
        here = state.filter(F.size("shape") >= level).select(
            "host", "template", F.element_at("shape", level).alias("segment"), "n", "bad", "good")
        child = here.groupBy("host", "template", "segment").agg(*_sums())
        branch = child.groupBy("host", "template").agg(
            F.count("*").alias("kinds"), *[F.sum(c).alias(f"all_{c}") for c in ("n", "bad", "good")])
        few = F.col("bad") + F.col("good") < MIN_LABELLED
        rare = (F.col("kinds") > KINDS) & (F.col("n") < RARE * F.col("all_n"))
        alike = (F.col("kinds") > 1) & (_chi("all") < ALIKE)
        # a form is general already; its merged branches keep its name
        form = F.col("segment").contains("{")
        seen = child.join(branch, ["host", "template"]).withColumn("merged", ~form & (alike | (rare & few)))
        pool = seen.filter("merged").groupBy("host", "template").agg(*[F.sum(c).alias(f"pool_{c}") for c in ("n", "bad", "good")])
        apart = ~few & (_chi("pool") >= ALIKE)
        token = F.when(F.col("merged") & ~apart, F.lit("*")).otherwise(F.col("segment"))
        named = seen.join(pool, ["host", "template"], "left").select("host", "template", "segment", token.alias("token"))
        state = stored(
            state.withColumn("segment", F.get("shape", F.lit(level - 1)))
            .join(named, ["host", "template", "segment"], "left")
            .select("host", "shape", "n", "bad", "good",
                    F.concat("template", F.coalesce(F.concat(F.lit("/"), "token"), F.lit(""))).alias("template")),
            "url-tree")
    return state


def judge(pages: DataFrame, rules: list[Rule], labelled: DataFrame | None = None, page_id: str = "page_id",
          url: str = "url") -> DataFrame:
    """page_id, host, path, rule, verdict, template, purity: one row per row of ``pages``.

    ``labelled`` (url, bad 0/1) trains the templates; without it the urls that
    rules decide do.  A null url, or one without ``://``, has empty host and
    path, no rule, and the empty template.  Urls of templates with few labels
    are allowed.  Repeated rows repeat; an empty table gives an empty result.
    """
    host, path = parts(F.col("url"))
    x = pages.select(col(page_id).alias("page_id"), col(url).alias("url"))
    x = x.select("page_id", host.alias("host"), path.alias("path"))
    hit = rule_of(F.col("host"), F.col("path"), rules)
    x = x.select("page_id", "host", "path", hit["rule"].alias("rule"), hit["verdict"].alias("ruled"),
                 shapes(F.col("path")).alias("shape"))
    if labelled is None:
        kinds = x.groupBy("host", "shape").agg(
            F.count("*").alias("n"), F.count_if(F.col("ruled") == "block").alias("bad"),
            F.count_if(F.col("ruled") == "allow").alias("good"))
    else:
        y = labelled.filter(col("url").isNotNull() & col("bad").isNotNull()).select(
            *[c.alias(k) for c, k in zip(parts(col("url")), ("host", "path"))], col("bad").alias("b"))
        known = y.select("host", shapes(F.col("path")).alias("shape"), F.lit(0).alias("n"),
                         (F.col("b") > 0).cast("int").alias("bad"), (F.col("b") <= 0).cast("int").alias("good"))
        seen = x.select("host", "shape", F.lit(1).alias("n"), F.lit(0).alias("bad"), F.lit(0).alias("good"))
        kinds = seen.unionByName(known).groupBy("host", "shape").agg(*_sums()) \
            .withColumn("n", F.greatest("n", F.col("bad") + F.col("good")))
    leaves = tree(kinds)
    total = leaves.agg(F.sum("bad"), F.sum("good")).first()
    bad, good = total[0] or 0, total[1] or 0
    prior = min(0.5, bad / (bad + good)) if bad + good else 0.0
    templates = leaves.groupBy("host", "template").agg(*_sums())
    purity = (F.col("bad") + PRIOR * prior) / (F.col("bad") + F.col("good") + PRIOR)
    judged = templates.select("host", "template", purity.alias("purity"),
                              ((purity >= PURITY) & (F.col("bad") + F.col("good") >= MIN_LABELLED)).alias("rejected"))
    of_kind = leaves.join(judged, ["host", "template"]).select("host", "shape", "template", "purity", "rejected")
    out = x.join(of_kind, ["host", "shape"])
    verdict = F.coalesce("ruled", F.when(F.col("rejected"), F.lit("block")).otherwise(F.lit("allow")))
    return out.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "template", "purity")
