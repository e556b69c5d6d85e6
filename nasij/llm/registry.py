"""The registered queries of this subpackage and the SQL that checks them."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from nasij.llm import ann, langid, media, mixing, neardup, packing, quality, sharding, toxicity, urls
from nasij.llm.common import shared_dir, table


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    # a map of this run's own, stored and loaded as later runs would
    folder = f"{shared_dir(spark)}/nasij/slot-map-{uuid.uuid4().hex}"
    return sharding.rebalanced(table(spark, sf_dir, "documents"), folder, shards=40)[0]


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def op4_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.digests(table(spark, sf_dir, "documents"))


def op5_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op6_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.components(table(spark, sf_dir, "documents"), size=4, num=80, den=100)


def op7_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.predict(docs, langid.fit(docs))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the digest is taken of the ids, which are left out of the result
    return packing.pack(table(spark, sf_dir, "documents")).drop("ids")


def op9_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"), modulus=50, k=5)


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.plan(table(spark, sf_dir, "documents"))


def queries() -> dict:
    return {f.__name__: f for f in (op1_toxicity, op2_sharding, op3_quality, op4_media, op5_urls, op6_neardup, op7_langid, op8_packing, op9_ann, op10_mixing)}


_URLS = r"""
WITH RECURSIVE p AS (
  SELECT page_id, url, html,
    coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path
  FROM pages),
r(h, p, v) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
m AS (
  SELECT page_id, arg_max(r.h || r.p, length(r.h || r.p)) AS rule, arg_max(r.v, length(r.h || r.p)) AS own
  FROM p JOIN r ON (host = r.h OR ends_with(host, '.' || r.h)) AND starts_with(path, r.p) GROUP BY page_id),
tag AS (
  SELECT url, unnest(regexp_extract_all(html, '(?is)<(?:link|meta)\b[^>]*>')) AS t FROM p WHERE host <> '' AND html IS NOT NULL),
link AS (
  SELECT url, CASE WHEN regexp_matches(t, '(?i)^<link') AND regexp_matches(t, '(?i)\brel\s*=\s*["'']?canonical\b') THEN regexp_extract(t, '(?i)\bhref\s*=\s*["'']?([^"''\s>]+)', 1)
      WHEN regexp_matches(t, '(?i)\bhttp-equiv\s*=\s*["'']?refresh\b') THEN regexp_extract(t, '(?i)\burl\s*=\s*["'']?([^"''\s>;]+)', 1)
      WHEN regexp_matches(t, '(?i)\bproperty\s*=\s*["'']?og:url\b') THEN regexp_extract(t, '(?i)\bcontent\s*=\s*["'']?([^"''\s>]+)', 1) ELSE '' END AS l
  FROM tag),
target AS (
  SELECT url, CASE WHEN regexp_matches(l, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN l WHEN starts_with(l, '//') THEN regexp_extract(url, '(?s)^(.*?):', 1) || ':' || l
      WHEN starts_with(l, '/') THEN regexp_extract(url, '(?s)^(.*?://[^/?#]*)', 1) || l ELSE regexp_extract(url, '(?s)^(.*?://[^?#]*/)', 1) || l END AS u
  FROM link WHERE l <> ''),
addr AS (SELECT DISTINCT url AS u FROM p WHERE host <> '' UNION SELECT u FROM target),
node AS (
  SELECT u, translate(regexp_extract(u, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
    || regexp_replace(regexp_extract(u, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '/+$', '') || '?'
    || array_to_string(list_filter(string_split(regexp_extract(u, '(?s)^[^?#]*\?([^#]*)', 1), '&'), lambda x: NOT regexp_matches(x, '^(utm_[^=]*=|$)')), '&') AS k
  FROM addr),
edge AS (
  SELECT a.k AS x, b.k AS y FROM target t JOIN node a ON a.u = t.url JOIN node b ON b.u = t.u WHERE a.k <> b.k),
both_ways AS (SELECT x, y FROM edge UNION SELECT y, x FROM edge),
reach(x, y) AS (SELECT x, y FROM both_ways UNION SELECT reach.x, b.y FROM reach JOIN both_ways b ON reach.y = b.x),
cls AS (SELECT k, least(k, min(y)) AS c FROM (SELECT DISTINCT k FROM node) n LEFT JOIN reach ON n.k = reach.x GROUP BY k),
pc AS (SELECT p.*, m.rule, m.own, coalesce(cls.c, node.k) AS c FROM p LEFT JOIN m USING (page_id) LEFT JOIN node ON node.u = p.url LEFT JOIN cls ON cls.k = node.k),
parsed AS (SELECT u, translate(regexp_extract(u, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(u, '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM addr),
ruled AS (SELECT u, arg_max(r.v, length(r.h || r.p)) AS own FROM parsed JOIN r ON (host = r.h OR ends_with(host, '.' || r.h)) AND starts_with(path, r.p) GROUP BY u),
cv AS (SELECT coalesce(cls.c, node.k) AS c, min(own) AS v FROM ruled JOIN node USING (u) LEFT JOIN cls ON cls.k = node.k GROUP BY 1)
SELECT page_id, host, path, rule, coalesce(own, v, 'allow') AS verdict FROM pc LEFT JOIN cv ON pc.c = cv.c
"""

_NEARDUP = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, hash(array_to_string(list_slice(w, i, i + 3), ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(1, greatest(2, len(w) - 2))) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS both_have FROM s a JOIN s b ON a.h = b.h AND a.doc_id <> b.doc_id GROUP BY ALL),
e AS (SELECT x, y FROM c JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * both_have >= 80 * (a.n + b.n - both_have)),
reach(x, y) AS (SELECT x, y FROM e UNION SELECT reach.x, e.y FROM reach JOIN e ON reach.y = e.x)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(least(d.doc_id, r.m), d.doc_id) AS component_id, coalesce(least(d.doc_id, r.m), d.doc_id) = d.doc_id AS kept
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN (SELECT x, min(y) AS m FROM reach GROUP BY x) r ON r.x = d.doc_id
"""


def oracle_sql() -> dict[str, str]:
    """The others are models, images, tokenizers or searches: tests hold their
    results to brute force or an exact round trip."""
    return {"op5_urls": _URLS, "op6_neardup": _NEARDUP}
