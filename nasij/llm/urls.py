"""URL filters by redirect equivalence. DataFrame functions only.

Pages whose URLs are joined by redirects or canonical links form one class.
A page with a matching rule takes that rule's verdict. Any other page takes
its class's: allow if an address of the class is explicitly allowed, else block
if one is blocked, else allow.

Edges come from ``<link rel=canonical>``, ``<meta http-equiv=refresh>`` and
``og:url`` in the page (the last is by its definition the page's canonical
address), and from an optional table of redirects (src, dst). They are written
once, as two steps read them.
Two spellings of one address (scheme, fragment, ``utm_`` parameters, a trailing
slash) are one node.

Defined cases: a null url, or one without ``://``, has an empty host and path,
no node and no rule, and is allowed. Null html has no edges. Repeated rows are
judged alike. Further columns of the input are ignored. Empty input gives an
empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nasij.llm.common import Written
from nasij.llm.graph import connected_components

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPLIT = r"(?s)^.*?://([^/?#]*)([^?#]*)"
#: (host, path, verdict)
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
#: Each pattern's first group is the target's address.
LINKS = (
    r"""(?is)<link\b(?=[^>]*\brel\s*=\s*["']?canonical\b)[^>]*?\bhref\s*=\s*["']?([^"'\s>]+)""",
    r"""(?is)<meta\b(?=[^>]*\bhttp-equiv\s*=\s*["']?refresh\b)[^>]*?\burl\s*=\s*["']?([^"'\s>;]+)""",
    r"""(?is)<meta\b(?=[^>]*\bproperty\s*=\s*["']?og:url\b)[^>]*?\bcontent\s*=\s*["']?([^"'\s>]+)""",
)


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, SPLIT, 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, SPLIT, 2), F.lit(""))


def node_of(url: Column) -> Column:
    """A 64-bit name of the address; null where there is no host."""
    query = F.regexp_extract(url, r"(?s)^[^?#]*\?([^#]*)", 1)
    kept = F.array_join(F.filter(F.split(query, "&"), lambda p: ~p.rlike("^(utm_[^=]*=|$)")), "&")
    key = F.concat(host_of(url), F.regexp_replace(path_of(url), "/+$", ""), F.lit("?"), kept)
    return F.when(host_of(url) != "", F.xxhash64(key))


def absolute(base: Column, link: Column) -> Column:
    """Resolves a link: absolute, //host, /path or relative to the folder."""
    scheme = F.regexp_extract(base, r"(?s)^(.*?)://", 1)
    root = F.concat(scheme, F.lit("://"), host_of(base))
    return (
        F.when(F.coalesce(link, F.lit("")) == "", F.lit(None))
        .when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), link)
        .when(link.startswith("//"), F.concat(scheme, F.lit(":"), link))
        .when(link.startswith("/"), F.concat(root, link))
        .when(link.rlike(r"^[#?]"), F.concat(root, path_of(base), link))
        .otherwise(F.concat(root, F.regexp_extract(path_of(base), r"(?s)^(.*/)", 1), link))
    )


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, as (its text, its verdict); null if none."""
    name, verdict = None, None
    for h, p, v in sorted(rules, key=lambda r: (-len(r[0] + r[1]), r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name = F.when(fits, h + p) if name is None else name.when(fits, h + p)
        verdict = F.when(fits, v) if verdict is None else verdict.when(fits, v)
    return name, verdict


def page_edges(pages: DataFrame) -> DataFrame:
    """(src, dst, to) of each link between two addresses: their nodes, and the
    target's address. Every tag of a page counts."""
    none = F.array().cast("array<string>")
    found = F.flatten(F.array(*[F.when(F.locate("<link" if i == 0 else "<meta", F.lower(F.col("html"))) > 0, F.regexp_extract_all("html", F.lit(p), F.lit(1))).otherwise(none) for i, p in enumerate(LINKS)]))
    links = pages.where(F.col("html").isNotNull() & F.lower(F.col("html")).rlike("canonical|refresh|og:url")).select("url", F.explode(found).alias("link"))
    links = links.select("url", absolute(F.col("url"), F.col("link")).alias("to"))
    return links.select(node_of(F.col("url")).alias("src"), node_of(F.col("to")).alias("dst"), "to").where("src is not null and dst is not null and src <> dst")


def judge(pages: DataFrame, rules=RULES, redirects: DataFrame | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict, component of every page."""
    pages = pages.select("page_id", "url", "html")
    edges = page_edges(pages)
    if redirects is not None:
        edges = edges.unionByName(redirects.select(node_of(F.col("src")).alias("src"), node_of(F.col("dst")).alias("dst"), F.col("dst").alias("to")))
    edges = Written(edges, "edges").df
    classes = connected_components(edges, "src", "dst")
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    base = pages.select("page_id", host.alias("host"), path.alias("path"), node_of(F.col("url")).alias("node"))
    name, verdict = rule_of(F.col("host"), F.col("path"), rules)
    base = base.select("*", name.alias("rule"), verdict.alias("own"))
    base = base.join(classes, "node", "left").withColumn("component", F.coalesce("component", "node"))
    # one row for each class that has a rule; pages then look it up
    named = base.select("component", "own")
    # an address that is only linked to can have a rule as well
    there = rule_of(host_of(F.col("to")), path_of(F.col("to")), rules)[1]
    linked = edges.select(F.col("dst").alias("node"), there.alias("own")).join(classes, "node", "left").select(F.coalesce("component", "node").alias("component"), "own")
    ruled = named.unionByName(linked).where("own is not null and component is not null").groupBy("component").agg(F.min("own").alias("class_verdict"))
    return base.join(ruled, "component", "left").select(
        "page_id", "host", "path", "rule", F.coalesce("own", "class_verdict", F.lit("allow")).alias("verdict"), F.col("component").alias("component")
    )
