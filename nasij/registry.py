"""Registered queries of the engine's own operators, each with its SQL.

Every query reads whole tables. ``documents`` stands for a corpus (its source
or language for a region), ``conversations`` for records and their parents,
``benchmark`` for a held-out partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from nasij import case_queries
from nasij.functions import text as T
from nasij.operators import chunk, decisions, dedup, formats, judge, leakage, ocr, quality, similarity, stats
from nasij.plans import jobs

_ALL: dict = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def keep(f):
        _ALL[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return keep


def queries() -> dict:
    return _ALL | case_queries.queries()


def oracle_sql() -> dict[str, str]:
    return _SQL | case_queries.oracle_sql()


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _docs(spark: SparkSession, d: str) -> DataFrame:
    return _t(spark, d, "documents")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_profile(spark, sf_dir)


# --- duplicates ---------------------------------------------------------------

CANON = r"trim(regexp_replace(text, '\s+', ' ', 'g'))"


@query(f"SELECT sha256({CANON}) AS sha256, min(doc_id) AS kept, count(*) AS members FROM documents GROUP BY 1 HAVING count(*) > 1")
def exact_dup_groups(spark, d):
    return dedup.exact_groups(_docs(spark, d), "doc_id", "text")


@query(f"SELECT doc_id, lang, source FROM documents QUALIFY row_number() OVER (PARTITION BY sha256({CANON}) ORDER BY doc_id) = 1")
def exact_keep_first(spark, d):
    return dedup.keep_first(_docs(spark, d), "doc_id", "text").select("doc_id", "lang", "source")


def _pairs_sql(table: str, key: str, size: int, where: str = "") -> str:
    return rf"""
WITH w AS (SELECT {key} AS k, regexp_extract_all(text, '\S+') AS w FROM {table} {where}),
s AS (SELECT DISTINCT k, hash(array_to_string(list_slice(w, i, i + {size} - 1), ' ')) AS h FROM (SELECT k, w, unnest(range(1, greatest(2, len(w) - {size} + 2))) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT k, count(*) AS n FROM s GROUP BY k),
c AS (SELECT a.k AS doc_a, b.k AS doc_b, count(*) AS shared FROM s a JOIN s b ON a.h = b.h AND a.k < b.k GROUP BY ALL),
pairs AS (SELECT doc_a, doc_b, shared, shared / (x.n + y.n - shared) AS jaccard FROM c JOIN n x ON x.k = doc_a JOIN n y ON y.k = doc_b WHERE shared / (x.n + y.n - shared) >= 0.8)
"""


@query(_pairs_sql("documents", "doc_id", 5) + "SELECT * FROM pairs")
def near_dup_pairs_5(spark, d):
    return dedup.near_pairs(_docs(spark, d), "doc_id", "text", 5)


def _turns(spark, d):
    """The turns, and of every fifth conversation once more: of the even ones as
    they are, of the odd ones with a word more."""
    t = _t(spark, d, "conversations").select("conv_id", "turn", "text", (F.col("conv_id") * 1000 + F.col("turn")).alias("rec"))
    again = t.where("conv_id % 5 = 0").select("conv_id", "turn", F.when(F.col("conv_id") % 2 == 0, F.col("text")).otherwise(F.concat("text", F.lit(" more"))).alias("text"), (F.col("rec") + 500).alias("rec"))
    return t.unionByName(again)


_TURNS = """(SELECT conv_id, turn, text, conv_id * 1000 + turn AS rec FROM conversations
UNION ALL SELECT conv_id, turn, CASE WHEN conv_id % 2 = 0 THEN text ELSE text || ' more' END, conv_id * 1000 + turn + 500 FROM conversations WHERE conv_id % 5 = 0)"""


@query(_pairs_sql(_TURNS, "rec", 3) + "SELECT * FROM pairs")
def near_dup_pairs_3(spark, d):
    return dedup.near_pairs(_turns(spark, d), "rec", "text", 3)


@query(
    _pairs_sql(f"(SELECT * FROM documents QUALIFY row_number() OVER (PARTITION BY sha256({CANON}) ORDER BY doc_id) = 1)", "doc_id", 5)
    + rf""", near AS (SELECT doc_a AS k FROM pairs UNION SELECT doc_b FROM pairs),
dw AS (SELECT doc_id, sha256({CANON}) AS sha256, regexp_extract_all(text, '\S+') AS w FROM documents),
cnt AS (SELECT doc_id, count(DISTINCT array_to_string(list_slice(w, i, i + 4), ' ')) AS c FROM (SELECT doc_id, w, unnest(range(1, greatest(2, len(w) - 3))) AS i FROM dw WHERE len(w) > 0) GROUP BY doc_id)
SELECT dw.doc_id, sha256, coalesce(c, 0) AS shingle_count, CASE WHEN dw.doc_id <> min(dw.doc_id) OVER (PARTITION BY sha256) THEN 'exact_duplicate' WHEN near.k IS NOT NULL THEN 'near_duplicate_flagged' ELSE 'unique' END AS status
FROM dw LEFT JOIN near ON near.k = dw.doc_id LEFT JOIN cnt ON cnt.doc_id = dw.doc_id"""
)
def dedup_status(spark, d):
    return dedup.status(_docs(spark, d), "doc_id", "text")


@query(
    "WITH RECURSIVE" + _pairs_sql("documents", "doc_id", 5).replace("WITH", "", 1)
    + """, e AS (SELECT doc_a AS x, doc_b AS y FROM pairs UNION SELECT doc_b, doc_a FROM pairs),
reach(x, y) AS (SELECT x, y FROM e UNION SELECT reach.x, e.y FROM reach JOIN e ON reach.y = e.x)
SELECT x AS node, least(x, min(y)) AS component FROM reach GROUP BY x"""
)
def dup_components(spark, d):
    return dedup.components(dedup.near_links(_docs(spark, d), "doc_id", "text"), "doc_a", "doc_b")


_ONCE = f"(SELECT * FROM {_TURNS} QUALIFY row_number() OVER (PARTITION BY sha256({CANON}) ORDER BY rec) = 1)"


@query(
    _pairs_sql(_ONCE, "rec", 3)
    + rf""", r AS (SELECT *, sha256({CANON}) AS sha FROM {_TURNS}), f AS (SELECT sha, min(rec) AS a FROM r GROUP BY sha)
SELECT 'EXACT_DUP' AS code, 'text' AS field, a, rec AS b, 1.0::DOUBLE AS jaccard FROM r JOIN f USING (sha) WHERE rec <> a UNION ALL SELECT 'NEAR_DUP', 'text', doc_a, doc_b, jaccard FROM pairs"""
)
def field_duplicates(spark, d):
    return dedup.field_duplicates(_turns(spark, d), "rec", ["text"])


def _replies(spark, d):
    w = Window.partitionBy("conv_id").orderBy("turn")
    t = _t(spark, d, "conversations").withColumn("reply", F.lead("text").over(w)).withColumn("next_role", F.lead("role").over(w))
    return t.where("role = 'user' and next_role = 'assistant'").select("conv_id", "turn", F.col("text").alias("prompt"), "reply")


_REPLIES = "(SELECT conv_id, turn, text AS prompt, reply FROM (SELECT *, lead(text) OVER (PARTITION BY conv_id ORDER BY turn) AS reply, lead(role) OVER (PARTITION BY conv_id ORDER BY turn) AS nr FROM conversations) WHERE role = 'user' AND nr = 'assistant')"
def _echoes(spark, d):
    """Prompts and replies; every fourth conversation repeats its prompt, every
    fourth but one with a word more."""
    c = F.col("conv_id") % 4
    return _replies(spark, d).withColumn("reply", F.when(c == 0, F.col("prompt")).when(c == 1, F.concat("prompt", F.lit(" indeed"))).otherwise(F.col("reply")))


_ECHOES = f"(SELECT conv_id, turn, prompt, CASE conv_id % 4 WHEN 0 THEN prompt WHEN 1 THEN prompt || ' indeed' ELSE reply END AS reply FROM {_REPLIES})"
_JACC = r"""WITH w AS (SELECT conv_id, turn, regexp_extract_all(prompt, '\S+') AS p, regexp_extract_all(reply, '\S+') AS r FROM {r}),
s AS (SELECT conv_id, turn, CASE WHEN len(p) = 0 THEN [] ELSE list_distinct(list_transform(range(1, greatest(2, len(p) - 1)), lambda i: array_to_string(list_slice(p, i, i + 2), ' '))) END AS a,
  CASE WHEN len(r) = 0 THEN [] ELSE list_distinct(list_transform(range(1, greatest(2, len(r) - 1)), lambda i: array_to_string(list_slice(r, i, i + 2), ' '))) END AS b FROM w),
j AS (SELECT conv_id, turn, CASE WHEN len(a) > 0 AND len(b) > 0 THEN len(list_intersect(a, b)) / (len(a) + len(b) - len(list_intersect(a, b))) ELSE 0.0 END AS jaccard FROM s)
""".replace("{r}", _REPLIES)


@query(_JACC + "SELECT * FROM j")
def pair_similarity(spark, d):
    return _replies(spark, d).select("conv_id", "turn", dedup.jaccard(F.col("prompt"), F.col("reply")).alias("jaccard"))


@query(_JACC.replace(_REPLIES, _ECHOES) + f"SELECT conv_id, turn, jaccard FROM j JOIN {_ECHOES} USING (conv_id, turn) WHERE jaccard >= 0.8 OR trim(regexp_replace(prompt, '\\s+', ' ', 'g')) = trim(regexp_replace(reply, '\\s+', ' ', 'g'))")
def pair_collapse(spark, d):
    return dedup.pair_collapse(_echoes(spark, d), "prompt", "reply").select("conv_id", "turn", "jaccard")


@query(
    _JACC
    + """SELECT count(*) AS n, max(jaccard) AS max, (array_agg(jaccard ORDER BY jaccard DESC))[CAST(floor(count(*) * 0.1) AS INT) + 1] AS p90, (array_agg(jaccard ORDER BY jaccard))[CAST(floor(count(*) / 2) AS INT) + 1] AS median,
count_if(jaccard >= 0.95)::BIGINT AS ge_95, count_if(jaccard >= 0.9)::BIGINT AS ge_90, count_if(jaccard >= 0.8)::BIGINT AS ge_80, count_if(jaccard >= 0.7)::BIGINT AS ge_70, count_if(jaccard >= 0.6)::BIGINT AS ge_60 FROM j"""
)
def pair_distribution(spark, d):
    return dedup.pair_distribution(pair_similarity(spark, d), "jaccard")


@query(rf"""WITH l AS (SELECT item_id::BIGINT AS item_id, text FROM benchmark UNION ALL SELECT doc_id + 1000000, '  ' || replace(text, ' ', '  ') FROM documents WHERE doc_id % 10 = 0)
SELECT l.item_id, min(d.doc_id) AS first_right FROM l JOIN documents d ON sha256({CANON.replace("text", "l.text")}) = sha256({CANON.replace("text", "d.text")}) GROUP BY 1""")
def cross_file(spark, d):
    """The benchmark, and every tenth document with its spaces doubled."""
    docs = _docs(spark, d)
    again = docs.where("doc_id % 10 = 0").select((F.col("doc_id") + 1_000_000).alias("item_id"), F.concat(F.lit("  "), F.replace("text", F.lit(" "), F.lit("  "))).alias("text"))
    left = _t(spark, d, "benchmark").select(F.col("item_id").cast("long").alias("item_id"), "text").unionByName(again)
    return dedup.cross_file(left, "item_id", "text", docs, "doc_id", "text")


@query("SELECT doc_id, source, lang FROM documents QUALIFY row_number() OVER (PARTITION BY source, lang ORDER BY n_chars DESC, doc_id) = 1")
def first_by_group(spark, d):
    return dedup.first_by(_docs(spark, d), ["source", "lang"], [F.desc("n_chars"), "doc_id"]).select("doc_id", "source", "lang")


@query(
    """WITH once AS (SELECT * FROM conversations QUALIFY row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn) = 1)
SELECT conv_id, turn, role FROM once QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn) <= 12"""
)
def in_group_dedup(spark, d):
    return dedup.first_n(_t(spark, d, "conversations"), ["conv_id"], ["role", "text"], ["turn"], 12).select("conv_id", "turn", "role")


# --- cleaning, units and chunks -------------------------------------------------

@query(r"SELECT doc_id, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(replace(text, chr(160), ' '), '[\x{200B}-\x{200F}\x{202A}-\x{202E}\x{FEFF}]', '', 'g'), '\r\n?', chr(10), 'g'), '[ \t]+', ' ', 'g'), ' *\n *', chr(10), 'g'), ' ' || chr(10) || chr(9)) AS cleaned FROM documents")
def clean_whitespace(spark, d):
    return _docs(spark, d).select("doc_id", T.normalize_whitespace(F.col("text")).alias("cleaned"))


@query(r"SELECT doc_id, len(regexp_extract_all(text, '\S+')) AS tokens, length(text) AS chars, length(trim(regexp_replace(text, '\s+', ' ', 'g'))) AS canonical_chars FROM documents")
def token_counts(spark, d):
    return _docs(spark, d).select("doc_id", T.token_count(F.col("text")).alias("tokens"), F.length("text").cast("long").alias("chars"), F.length(T.canonical(F.col("text"))).cast("long").alias("canonical_chars"))


_UNITS = r"list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x)), lambda x: x <> '')"
_TOK = r"len(regexp_extract_all({x}, '\S+'))"
_PACK = rf"""
WITH RECURSIVE u AS (SELECT doc_id, {_UNITS} AS us FROM documents WHERE len({_UNITS}) > 0),
t AS (SELECT doc_id, us, list_transform(us, lambda x: {_TOK.format(x='x')}) AS ns FROM u),
fold(doc_id, i, chunk, held) AS (
  SELECT doc_id, 0, -1, 201 FROM t
  UNION ALL
  SELECT f.doc_id, f.i + 1, CASE WHEN ns[f.i + 1] > 200 OR f.held + ns[f.i + 1] > 200 THEN f.chunk + 1 ELSE f.chunk END,
    CASE WHEN ns[f.i + 1] > 200 THEN 201 WHEN f.held + ns[f.i + 1] > 200 THEN ns[f.i + 1] ELSE f.held + ns[f.i + 1] END
  FROM fold f JOIN t USING (doc_id) WHERE f.i < len(ns)),
c AS (SELECT f.doc_id, chunk, count(*) AS units, sum(ns[i])::BIGINT AS tokens, (min(i) - 1)::BIGINT AS unit_start, string_agg(us[i], chr(10) || chr(10) ORDER BY i) AS body FROM fold f JOIN t USING (doc_id) WHERE i > 0 GROUP BY 1, 2)
"""


def _packed(spark, d, limit=200):
    return chunk.chunks(_docs(spark, d).select("doc_id", "text", "source", "lang"), "doc_id", chunk.line_units(F.col("text")), F.lit("prose"), F.lit("line"), limit, 50)


@query(
    _PACK + """SELECT format('{}_c{:04d}', doc_id, chunk) AS chunk_id, units AS unit_count, tokens AS token_count, unit_start, md5(body) AS body,
CASE WHEN tokens > 200 THEN 'oversize_line' WHEN tokens < 50 THEN 'below_target_min' END AS flag FROM c"""
)
def chunk_pack(spark, d):
    return _packed(spark, d).select("chunk_id", F.col("unit_count").cast("long").alias("unit_count"), "token_count", F.col("unit_start").cast("long").alias("unit_start"), F.md5("chunk_text").alias("body"), "flag")


_LM, _FN = r"^\s*(?:[-•*]\s|\(?[٠-٩0-9]+\)|[٠-٩0-9]+[.)]\s)", r"^\s*\^\("


@query(
    rf"""WITH u AS (SELECT doc_id, {_UNITS} AS us FROM documents),
n AS (SELECT doc_id, len(us) AS n, len(list_filter(us, lambda x: regexp_matches(x, '{_LM}'))) AS l, len(list_filter(us, lambda x: regexp_matches(x, '{_FN}'))) AS f,
  len(list_filter(us, lambda x: NOT ({_TOK.format(x='x')} <= 8 AND right(x, 1) NOT IN ('.', '؟', '!', '،', ':', '؛')))) AS body FROM u)
SELECT doc_id, CASE WHEN n = 0 THEN 'empty' WHEN f / n >= 0.5 THEN 'footnote_block' WHEN l / n >= 0.5 THEN 'list' WHEN body <= 1 THEN 'prose' ELSE 'narrative_paragraph' END AS format_type FROM n"""
)
def chunk_format(spark, d):
    return _docs(spark, d).select("doc_id", chunk.classify(chunk.line_units(F.col("text")), F.lit("prose")).alias("format_type"))


@query(
    _PACK + """SELECT source, grouping(source)::INT AS is_total, count(*) AS chunks, sum(tokens)::BIGINT AS tokens, count_if(tokens > 200)::BIGINT AS oversize, count_if(tokens < 50)::BIGINT AS small
FROM c JOIN documents USING (doc_id) GROUP BY ROLLUP (source)"""
)
def chunk_rollup(spark, d):
    p = _packed(spark, d)
    return p.rollup("source").agg(F.grouping("source").cast("int").alias("is_total"), F.count(F.lit(1)).alias("chunks"), F.sum("token_count").alias("tokens"), F.count_if(F.col("flag") == "oversize_line").alias("oversize"), F.count_if(F.col("flag") == "below_target_min").alias("small"))


@query(
    _PACK.replace("200", "800").replace("201", "801").replace("FROM documents", f"FROM (SELECT * FROM documents QUALIFY row_number() OVER (PARTITION BY sha256({CANON}) ORDER BY doc_id) = 1)")
    + """SELECT source, grouping(source)::INT AS is_total, count(DISTINCT doc_id) AS documents, count(*) AS chunks, sum(tokens)::BIGINT AS tokens, quantile_cont(tokens, 0.5)::DOUBLE AS median,
count_if(tokens BETWEEN 200 AND 800) / count(*) AS in_band FROM c JOIN documents USING (doc_id) GROUP BY ROLLUP (source)"""
)
def chunk_profile(spark, d):
    return jobs.chunk_profile(_docs(spark, d), "doc_id", "text", "source")


@query(
    rf"""WITH u AS (SELECT doc_id, {_UNITS} AS us FROM documents)
SELECT doc_id, CASE WHEN len(us) > 1 THEN len(us) ELSE len(us) END::BIGINT AS units, md5(array_to_string(us, '|')) AS joined FROM u"""
)
def verse_lines(spark, d):
    u = chunk.verse_units(F.col("text"))
    return _docs(spark, d).select("doc_id", F.size(u).cast("long").alias("units"), F.md5(F.array_join(u, "|")).alias("joined"))


@query(
    r"""WITH w AS (SELECT doc_id, text, length(text) AS n FROM documents WHERE length(text) > 0),
i AS (SELECT doc_id, text, unnest(range(0, greatest(CAST(ceil((n - 900) / 450) AS BIGINT), 0) + 1)) AS i FROM w)
SELECT doc_id, i, md5(substring(text, i * 450 + 1, 900)) AS body FROM i"""
)
def text_windows(spark, d):
    return _docs(spark, d).select("doc_id", F.posexplode(T.windows(F.col("text"))).alias("i", "w")).select("doc_id", F.col("i").cast("long").alias("i"), F.md5("w").alias("body"))


# --- profile ----------------------------------------------------------------------

_LEN = r"(SELECT *, len(regexp_extract_all(text, '\S+')) AS tokens FROM documents)"


def _len(spark, d):
    return _docs(spark, d).withColumn("tokens", T.token_count(F.col("text")))


@query(f"SELECT lang, count(tokens) AS n, avg(tokens) AS mean, quantile_cont(tokens, 0.25)::DOUBLE AS p25, quantile_cont(tokens, 0.5)::DOUBLE AS p50, quantile_cont(tokens, 0.75)::DOUBLE AS p75, quantile_cont(tokens, 0.9)::DOUBLE AS p90 FROM {_LEN} GROUP BY lang")
def token_stats(spark, d):
    return stats.percentiles(_len(spark, d), "tokens", ["lang"])


@query(
    f"""WITH e AS (SELECT min(tokens)::DOUBLE AS a, max(tokens)::DOUBLE AS b FROM {_LEN}), s AS (SELECT a, b, (b - a) / 12 AS s FROM e),
c AS (SELECT least(floor((tokens - a) / s), 11)::INT AS bin, count(*) AS n FROM {_LEN}, s GROUP BY 1)
SELECT i::INT AS bin, a + i * s AS lo, a + (i + 1) * s AS hi, coalesce(n, 0) AS n FROM range(0, 12) r(i), s LEFT JOIN c ON c.bin = i"""
)
def histogram12(spark, d):
    return stats.histogram(_len(spark, d), "tokens")


@query(f"SELECT source, count(*) AS n, count_if(tokens BETWEEN 200 AND 800)::BIGINT AS in_band, count_if(tokens BETWEEN 200 AND 800) / count(*) AS share FROM {_LEN} GROUP BY source")
def in_band(spark, d):
    return stats.in_band(_len(spark, d), "tokens", by=["source"])


@query(
    f"""WITH r AS (SELECT source, grouping(source)::INT AS is_total, count(DISTINCT doc_id) AS documents, count(*) AS chunks, sum(tokens)::BIGINT AS tokens, quantile_cont(tokens, 0.5)::DOUBLE AS median FROM {_LEN} GROUP BY ROLLUP (source))
SELECT *, chunks / (SELECT count(*) FROM documents) AS share FROM r"""
)
def region_rollup(spark, d):
    return stats.distribution(_len(spark, d), "source", "doc_id", "tokens")


_REGION = "CASE WHEN doc_id % 40 = 0 THEN 'northern' WHEN doc_id % 40 < 4 THEN 'southern' WHEN doc_id % 3 = 0 THEN 'najdi' WHEN doc_id % 3 = 1 THEN 'western' ELSE 'eastern' END"


@query(
    f"""WITH s AS (SELECT {_REGION} AS region, sum(tokens)::BIGINT AS tokens FROM {_LEN} GROUP BY 1), f AS (SELECT (array_agg(tokens ORDER BY tokens))[CAST(floor(count(*) / 2) AS INT) + 1] AS mid, max(tokens) AS top, count(*) AS g FROM s)
SELECT region, tokens, tokens / mid AS vs_median, tokens / top AS vs_max FROM s, f WHERE g >= 3 AND tokens < 0.5 * mid"""
)
def thin_regions(spark, d):
    i = F.col("doc_id")
    region = F.when(i % 40 == 0, "northern").when(i % 40 < 4, "southern").when(i % 3 == 0, "najdi").when(i % 3 == 1, "western").otherwise("eastern")
    return stats.thin_groups(_len(spark, d).withColumn("region", region), "region", "tokens")


@query("SELECT lang AS value, count(*) AS n FROM documents GROUP BY lang")
def value_counts(spark, d):
    return stats.value_counts(_docs(spark, d), F.col("lang"))


@query("SELECT doc_id, n_chars FROM documents ORDER BY n_chars DESC, doc_id LIMIT 5")
def longest_documents(spark, d):
    return stats.top_by(_docs(spark, d).select("doc_id", "n_chars"), [F.desc("n_chars"), "doc_id"], 5)


@query(
    """WITH r AS (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS rank, count(*) OVER (PARTITION BY source) AS n FROM documents)
SELECT doc_id, source, rank FROM r WHERE rank IN (0, round_even((n - 1) / 2, 0), n - 1)"""
)
def evenly_spaced_sample(spark, d):
    return stats.evenly_spaced(_docs(spark, d).select("doc_id", "source"), "source", "doc_id").select("doc_id", "source", F.col("rank").cast("long").alias("rank"))


@query("SELECT DISTINCT source, lang FROM documents")
def source_language_pairs(spark, d):
    return stats.distinct_pairs(_docs(spark, d), "source", "lang")


@query("SELECT CASE WHEN count(DISTINCT source) = 1 THEN min(source) ELSE 'Corpus' END AS title FROM documents")
def sole_title(spark, d):
    return stats.sole_title(_docs(spark, d), "source")


@query(
    r"""WITH w AS (SELECT regexp_extract_all(text, '\S+') AS w FROM conversations), k AS (SELECT unnest(range(1, 5)) AS n),
g AS (SELECT n, unnest(list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(list_slice(w, i, i + n - 1), ' '))) AS g FROM w, k WHERE len(w) >= n)
SELECT n::INT AS n, count(DISTINCT g) AS "unique", count(*) AS total, count(DISTINCT g) / count(*) AS ratio FROM g GROUP BY n"""
)
def distinct_n(spark, d):
    return stats.distinct_n(_t(spark, d, "conversations"), "text")


@query(
    r"""WITH c AS (SELECT array_to_string(list_slice(regexp_extract_all(text, '\S+'), 1, 3), ' ') AS o, count(*) AS n FROM conversations WHERE len(regexp_extract_all(text, '\S+')) > 0 GROUP BY 1)
SELECT (SELECT o FROM c ORDER BY n DESC, o LIMIT 1) AS opening, max(n) AS n, max(n) / sum(n) AS share FROM c"""
)
def template_share(spark, d):
    return stats.template_share(_t(spark, d, "conversations"), "text")


@query(
    """WITH n AS (SELECT lang, count(*) AS n FROM documents GROUP BY lang), p AS (SELECT lang, n / sum(n) OVER () AS p FROM n)
SELECT -sum(p * ln(p)) / ln(5) AS entropy, max(p) AS max_share, (5 - count_if(lang IN ('en', 'fr', 'de', 'es', 'ar')))::BIGINT AS empty_buckets FROM p"""
)
def entropy_lang(spark, d):
    return stats.spread(_docs(spark, d), "lang", ["en", "fr", "de", "es", "ar"])


@query("WITH s AS (SELECT conv_id, count(*) AS n FROM conversations GROUP BY conv_id) SELECT count(*) AS parents, sum(n)::BIGINT AS records, max(n) AS largest, round(100.0 * max(n) / sum(n), 1) AS largest_share, count(*) >= 2 AS two_way, count(*) >= 3 AS three_way FROM s")
def split_feasibility(spark, d):
    return stats.split_feasibility(_t(spark, d, "conversations"), "conv_id")


@query(
    f"""WITH r AS (SELECT lang, grouping(lang) AS g, count(tokens) AS n, min(tokens) AS low, quantile_cont(tokens, 0.5)::DOUBLE AS p50, max(tokens) AS high, avg(tokens) AS mean FROM {_LEN} GROUP BY ROLLUP (lang))
SELECT CASE WHEN g = 1 THEN 'ALL' ELSE lang END AS grp, n, low, p50, high, mean FROM r"""
)
def distribution_by_group(spark, d):
    return stats.by_group_and_all(_len(spark, d), "lang", "tokens")


@query(
    """SELECT o_orderpriority AS suite, count(*) AS calls, count_if(o_orderstatus = 'P')::BIGINT AS abstentions, sum(l_quantity)::DOUBLE AS tokens_in, sum(l_linenumber)::BIGINT AS tokens_out, avg(l_tax) AS latency_mean,
(sum(l_quantity) * 3.0 + sum(l_linenumber) * 15.0) / 1e6 AS cost FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1"""
)
def ledger_rollup(spark, d):
    li, o = _t(spark, d, "lineitem"), _t(spark, d, "orders")
    rows = li.join(o, li.l_orderkey == o.o_orderkey).withColumn("suite", F.col("o_orderpriority"))
    return stats.ledger(rows, F.col("o_orderstatus") == "P", F.col("l_quantity"), F.col("l_linenumber"), F.col("l_tax"), 3.0, 15.0, ["suite"])


@query("SELECT metric, avg(v) AS mean, min(v) AS low, max(v) AS high FROM (SELECT 'value' AS metric, value::DOUBLE AS v FROM events UNION ALL SELECT 'user_id', user_id::DOUBLE FROM events) GROUP BY metric")
def metric_summary(spark, d):
    return stats.metric_summary(_t(spark, d, "events"), ["value", "user_id"])


@query("SELECT source, count_if(quality = 1 AND toxic = 0)::BIGINT AS hits, count_if(toxic IS NOT NULL)::BIGINT AS scored, count_if(quality = 1 AND toxic = 0) / count_if(toxic IS NOT NULL) AS accuracy FROM labels JOIN documents USING (doc_id) GROUP BY source")
def suite_accuracy(spark, d):
    rows = _t(spark, d, "labels").join(_docs(spark, d), "doc_id")
    return stats.accuracy(rows, (F.col("quality") == 1) & (F.col("toxic") == 0), F.col("toxic").isNull(), ["source"])


# --- structure and findings ---------------------------------------------------------

_SENT = r"[.؟!؛]"


@query(
    rf"""WITH l AS (SELECT conv_id, turn, text, list_filter(string_split_regex(text, '\r\n|[\n\r\x0b\x0c]'), lambda x: regexp_matches(x, '\S')) AS ls, len(regexp_extract_all(text, '\S+')) AS w FROM conversations)
SELECT conv_id, turn, len(ls) AS n_lines, w AS n_words, len(list_filter(ls, lambda x: regexp_matches(x, '{_LM}'))) / greatest(len(ls), 1) AS list_ratio, len(regexp_extract_all(text, '{_SENT}')) AS sentence_marks,
len(list_filter(ls, lambda x: regexp_matches(x, '^\s*[^\s:]{{2,20}}\s*:\s*\S'))) AS colon_entries, CASE WHEN len(ls) > 0 THEN w / len(ls) ELSE 0.0 END AS words_per_line FROM l"""
)
def response_features(spark, d):
    f = formats.features(F.col("text"))
    return _t(spark, d, "conversations").withColumn("f", f).select("conv_id", "turn", *[f"f.{c}" for c in ("n_lines", "n_words", "list_ratio", "sentence_marks", "colon_entries", "words_per_line")])


@query(
    rf"""WITH l AS (SELECT doc_id, text, list_filter(string_split_regex(text, '\r\n|[\n\r\x0b\x0c]'), lambda x: regexp_matches(x, '\S')) AS ls FROM documents),
f AS (SELECT doc_id, text, len(list_filter(ls, lambda x: regexp_matches(x, '{_LM}'))) / greatest(len(ls), 1) AS lr, len(list_filter(ls, lambda x: regexp_matches(x, '{_FN}'))) / greatest(len(ls), 1) AS fr, len(regexp_extract_all(text, '{_SENT}')) AS sm FROM l)
SELECT doc_id, CASE WHEN NOT regexp_matches(coalesce(text, ''), '\S') THEN 'empty' WHEN sm >= 1 AND lr < 0.5 AND fr < 0.5 THEN 'match' ELSE 'mismatch' END AS as_prose, CASE WHEN NOT regexp_matches(coalesce(text, ''), '\S') THEN 'empty' WHEN lr >= 0.5 THEN 'match' ELSE 'mismatch' END AS as_list FROM f"""
)
def format_check(spark, d):
    return _docs(spark, d).select("doc_id", formats.conformance(F.col("text"), F.lit("prose")).alias("as_prose"), formats.conformance(F.col("text"), F.lit("list")).alias("as_list"))


@query(
    rf"""WITH t AS (SELECT conv_id, turn, len(regexp_extract_all(reply, '\S+')) / greatest(len(regexp_extract_all(prompt, '\S+')), 1) AS r FROM {_REPLIES}), s AS (SELECT *, CASE WHEN r >= 1.4 THEN 'rejected_longer' WHEN r <= 0.7 THEN 'rejected_shorter' ELSE 'similar' END AS length_signal FROM t)
SELECT conv_id, turn, length_signal, CASE WHEN length_signal = 'rejected_longer' THEN 'consistent' ELSE 'inconsistent' END AS for_verbosity FROM s"""
)
def length_signal(spark, d):
    s = formats.length_signal(F.col("prompt"), F.col("reply"))
    return _replies(spark, d).select("conv_id", "turn", s.alias("length_signal"), formats.length_consistency(F.lit("verbosity"), s).alias("for_verbosity"))


@query(
    r"""SELECT doc_id, contains(text, chr(65533)) AS replaced, regexp_matches(text, '[\x00-\x08\x0b-\x1f\x7f-\x{9f}]') AS controls, regexp_matches(text, '[\x{200B}-\x{200F}\x{202A}-\x{202E}\x{2066}-\x{2069}\x{FEFF}]') AS invisible,
len(regexp_extract_all(text, '\S+')) >= 25 AND NOT regexp_matches(text, '[آأإٱٲٳىی]') AS folded FROM documents"""
)
def encoding_findings(spark, d):
    codes = F.transform(formats.encoding_findings(F.col("text")), lambda x: x["code"])
    has = lambda c: F.array_contains("codes", c)
    return _docs(spark, d).withColumn("codes", codes).select("doc_id", has("REPLACEMENT_CHAR").alias("replaced"), has("CONTROL_CHARS").alias("controls"), has("INVISIBLE_CHARS").alias("invisible"), formats.folded_orthography(F.col("text")).alias("folded"))


@query(
    "SELECT doc_id, code FROM documents JOIN (VALUES (0, 'NOT_NFC'), (1, 'MOJIBAKE'), (2, 'REPLACEMENT_CHAR'), (3, 'INVISIBLE_CHARS')) e(c, code) ON doc_id % 5 = c"
)
def encoding_costly(spark, d):
    """Composition and mojibake, on a word of each kind: no SQL rule for them."""
    words = F.array(*map(F.lit, ("cafe\u0301", "caf\u00c3\u00a9", "caf\ufffd", "ca\u200bfe", "caf\u00e9")))
    rows = _docs(spark, d).select("doc_id", F.element_at(words, (F.pmod("doc_id", F.lit(5)) + 1).cast("int")).alias("t"))
    c = F.col("t")
    return rows.select("doc_id", F.explode(formats.encoding_findings(c, T.nfc(c), T.repair_encoding(c))).alias("x")).select("doc_id", "x.code")


@query(
    """WITH v AS (SELECT event_id, props FROM events)
SELECT event_id, 'MISSING_FIELD' AS code, 'k' AS field FROM v WHERE json_valid(props) AND NOT list_contains(json_keys(props), 'k')
UNION ALL SELECT event_id, 'MISSING_FIELD', 'absent' FROM v WHERE json_valid(props) AND NOT list_contains(json_keys(props), 'absent')
UNION ALL SELECT event_id, 'BAD_JSON', NULL FROM v WHERE NOT json_valid(props) AND trim(props) <> ''"""
)
def record_findings(spark, d):
    return formats.record_findings(_t(spark, d, "events"), "event_id", "props", ["k", "absent"])


def _secrets_sql() -> str:
    parts = [f"SELECT doc_id, '{k}' AS rule, len(regexp_extract_all(text, '{p}')) AS n FROM documents" for k, p in formats.SECRETS.items()]
    dense = r"""SELECT doc_id, 'high_entropy', (SELECT count(*) FROM unnest(regexp_extract_all(text, '=\s*["'']?([A-Za-z0-9+/_=-]{20,})', 1)) u(v) WHERE (SELECT -sum(c / length(v) * log2(c / length(v))) FROM (SELECT count(*) AS c FROM unnest(string_split(v, '')) x(ch) GROUP BY ch)) >= 3.5) FROM documents"""
    return "SELECT * FROM (" + " UNION ALL ".join([*parts, dense]) + ") WHERE n > 0"


@query(_secrets_sql())
def secret_scan(spark, d):
    return formats.secret_findings(_docs(spark, d), "doc_id", "text")


@query(rf"SELECT CASE WHEN doc_id % 2 = 0 THEN 'a' ELSE 'b' END AS part, count(*) AS n FROM documents GROUP BY 1")
def partition_counts(spark, d):
    return stats.value_counts(_docs(spark, d), F.when(F.col("doc_id") % 2 == 0, "a").otherwise("b")).select(F.col("value").alias("part"), "n")


@query(
    r"""WITH s AS (SELECT regexp_extract(url, '://([^/?#]*)', 1) AS host, CASE WHEN page_id % 3 = 0 THEN 'test' ELSE 'train' END AS part FROM pages)
SELECT host AS value, count(DISTINCT part) AS parts, min(part) AS first_part, max(part) AS last_part FROM s GROUP BY host HAVING count(DISTINCT part) > 1"""
)
def page_crossing(spark, d):
    """Hosts whose pages are in two parts."""
    rows = _t(spark, d, "pages").withColumn("part", F.when(F.col("page_id") % 3 == 0, "test").otherwise("train"))
    return leakage.crossing(rows, F.regexp_extract("url", "://([^/?#]*)", 1), "part")


def _parts(spark, d):
    return _docs(spark, d).withColumn("part", F.concat(F.lit("p"), F.pmod("doc_id", F.lit(3)).cast("string")))


_PARTS = "(SELECT *, 'p' || (doc_id % 3) AS part FROM documents)"


@query(f"SELECT sha256({CANON}) AS value, count(DISTINCT part) AS parts, min(part) AS first_part, max(part) AS last_part FROM {_PARTS} WHERE length(trim(text)) > 0 GROUP BY 1 HAVING count(DISTINCT part) > 1")
def leakage_exact(spark, d):
    return leakage.text_crossing(_parts(spark, d), "text", "part")


@query(_pairs_sql("documents", "doc_id", 5) + "SELECT doc_a, doc_b, jaccard, 'p' || (doc_a % 3) AS part_a, 'p' || (doc_b % 3) AS part_b FROM pairs WHERE doc_a % 3 <> doc_b % 3 AND jaccard < 1")
def leakage_near(spark, d):
    return leakage.near_crossing(_parts(spark, d), "doc_id", "text", "part").select("doc_a", "doc_b", "jaccard", "part_a", "part_b")


@query("WITH r AS (SELECT conv_id, CASE WHEN turn % 2 = 0 THEN 'train' ELSE 'test' END AS p FROM conversations) SELECT conv_id AS value, count(DISTINCT p) AS parts, min(p) AS first_part, max(p) AS last_part FROM r GROUP BY 1 HAVING count(DISTINCT p) > 1")
def documents_disjoint(spark, d):
    rows = _t(spark, d, "conversations").withColumn("p", F.when(F.col("turn") % 2 == 0, "train").otherwise("test"))
    return leakage.documents_disjoint(rows, "conv_id", "p")


@query(
    """WITH r AS (SELECT CASE WHEN doc_id % 7 = 0 THEN 'bad id ' || doc_id ELSE source || '_c' || lpad(doc_id::VARCHAR, 4, '0') END AS chunk_id, source FROM documents)
SELECT 'UNPARSEABLE_ID' AS code, chunk_id AS what FROM r WHERE NOT regexp_full_match(chunk_id, '.+_c[0-9]{4,}')
UNION ALL SELECT DISTINCT 'UNKNOWN_DOC_ID', source FROM r WHERE regexp_full_match(chunk_id, '.+_c[0-9]{4,}') AND source NOT IN ('src0', 'src1', 'src2', 'src3')"""
)
def chunk_ids(spark, d):
    made = F.when(F.col("doc_id") % 7 == 0, F.concat(F.lit("bad id "), F.col("doc_id").cast("string"))).otherwise(F.concat("source", F.lit("_c"), F.expr("lpad(cast(doc_id as string), greatest(4, length(cast(doc_id as string))), '0')")))
    known = spark.createDataFrame([(f"src{i}",) for i in range(4)], "doc_id string")
    return leakage.bad_ids(_docs(spark, d).select(made.alias("chunk_id")), "chunk_id", known)


@query(
    rf"""WITH f AS (SELECT sha256({CANON}) AS value, count(DISTINCT part) AS parts FROM {_PARTS} WHERE length(trim(text)) > 0 GROUP BY 1 HAVING count(DISTINCT part) > 1)
SELECT value, parts, total, place FROM (SELECT *, count(*) OVER (PARTITION BY parts) AS total, row_number() OVER (PARTITION BY parts ORDER BY value) AS place FROM f) WHERE place <= 50"""
)
def capped_report(spark, d):
    found = leakage.text_crossing(_parts(spark, d), "text", "part")
    return leakage.sampled(found, "parts", ["value"]).select("value", "parts", "total", F.col("place").cast("long").alias("place"))


# --- similarity -------------------------------------------------------------------

_GRAMS = r"""WITH c AS (SELECT item_id, trim(regexp_replace(text, '\s+', ' ', 'g')) AS s FROM benchmark), g AS (SELECT item_id, unnest(list_transform(range(1, greatest(2, length(s) - 2)), lambda i: substring(s, i, 4))) AS g FROM c),
n AS (SELECT item_id, ('0x' || left(md5(g), 8))::BIGINT % 512 AS dim, count(*)::DOUBLE AS n FROM g GROUP BY 1, 2), v AS (SELECT item_id, dim, n / sqrt(sum(n * n) OVER (PARTITION BY item_id)) AS w FROM n)
"""


@query(_GRAMS + "SELECT item_id, dim, w FROM v")
def hash_embedding(spark, d):
    return similarity.hashed(_t(spark, d, "benchmark"), "item_id", "text")


@query(
    """WITH f AS (SELECT label, min(vec_id) AS a FROM embeddings GROUP BY label)
SELECT a, e.vec_id AS b, list_cosine_similarity(x.embedding::DOUBLE[], e.embedding::DOUBLE[]) AS cosine FROM f JOIN embeddings x ON x.vec_id = a JOIN embeddings e ON e.label = f.label AND e.vec_id <> a"""
)
def cosine_to_first(spark, d):
    """Each vector against the first of its label: one row for a vector."""
    e = _t(spark, d, "embeddings")
    first = e.groupBy("label").agg(F.min_by(F.struct(F.col("vec_id").alias("a"), F.col("embedding").alias("x")), "vec_id").alias("f")).select("label", "f.*")
    return e.join(first, "label").where("vec_id <> a").select("a", F.col("vec_id").alias("b"), similarity.cosine(F.col("x"), F.col("embedding")).alias("cosine"))


@query(
    """WITH c AS (SELECT a.vec_id, list_cosine_similarity(a.embedding::DOUBLE[], z.embedding::DOUBLE[]) AS own FROM embeddings a, (SELECT embedding FROM embeddings QUALIFY row_number() OVER (ORDER BY vec_id) = 1) z),
b AS (SELECT vec_id AS bid, own AS v FROM c QUALIFY row_number() OVER (ORDER BY md5(vec_id::VARCHAR), vec_id) <= 120)
SELECT vec_id, 100.0 * count_if(b.v < own) / count(*) AS percentile FROM c, b WHERE vec_id <> bid GROUP BY vec_id"""
)
def percentile_in_baseline(spark, d):
    """Cosine with the first vector, ranked among those of 120 vectors that a
    hash draws from all ids."""
    e = _t(spark, d, "embeddings")
    # one row
    one = e.agg(F.min_by("embedding", "vec_id").alias("z"))
    scored = e.crossJoin(F.broadcast(one)).select("vec_id", similarity.cosine(F.col("z"), F.col("embedding")).alias("own"))
    drawn = scored.orderBy(F.md5(F.col("vec_id").cast("string")), "vec_id").limit(120)
    return similarity.percentile_in(scored, "vec_id", "own", drawn, "vec_id", "own")


@query()
def nearest_ratio(spark, d):
    """Token-sequence ratios follow a library's algorithm: no SQL form."""
    return similarity.nearest_ratio(_t(spark, d, "benchmark"), "item_id", "text")


# --- decisions ---------------------------------------------------------------------

_CASES = """(SELECT l.doc_id, CASE doc_id % 5 WHEN 0 THEN 'SUPPORTED' WHEN 1 THEN 'PARTIAL' WHEN 2 THEN 'UNSUPPORTED' WHEN 3 THEN 'CONTRADICTED' ELSE 'NO_CHECKABLE_CLAIMS' END AS fact,
CASE WHEN doc_id % 4 = 3 THEN NULL ELSE (doc_id * 37 % 101)::DOUBLE END AS pct, CASE doc_id % 3 WHEN 0 THEN true WHEN 1 THEN false END AS conforms, CASE WHEN doc_id % 2 = 0 THEN 'dictionary_entry' ELSE 'prose' END AS form FROM labels l)"""


def _cases(spark, d):
    i = F.col("doc_id")
    fact = F.element_at(F.array(*map(F.lit, ("SUPPORTED", "PARTIAL", "UNSUPPORTED", "CONTRADICTED", "NO_CHECKABLE_CLAIMS"))), (i % 5 + 1).cast("int"))
    return _t(spark, d, "labels").select("doc_id", fact.alias("fact"), F.when(i % 4 != 3, (i * 37 % 101).cast("double")).alias("pct"), F.when(i % 3 == 0, True).when(i % 3 == 1, False).alias("conforms"), F.when(i % 2 == 0, "dictionary_entry").otherwise("prose").alias("form"))


@query(
    f"""WITH b AS (SELECT *, CASE WHEN pct >= 95 THEN 'high' WHEN pct < 50 THEN 'low' WHEN pct IS NOT NULL THEN 'middle' END AS band FROM {_CASES}),
v AS (SELECT *, CASE WHEN fact = 'CONTRADICTED' THEN 'FAIL_CONTRADICTED' WHEN fact = 'NO_CHECKABLE_CLAIMS' THEN 'NO_FACT_COVERAGE' WHEN fact = 'SUPPORTED' AND band = 'high' THEN 'PASS' ELSE 'REVIEW' END AS verdict,
CASE WHEN fact = 'CONTRADICTED' THEN 'fail' WHEN fact = 'NO_CHECKABLE_CLAIMS' THEN CASE band WHEN 'high' THEN 'pass' WHEN 'low' THEN 'fail' END WHEN band IS NULL THEN CASE WHEN fact = 'SUPPORTED' THEN 'pass' ELSE 'fail' END
WHEN fact = 'SUPPORTED' THEN CASE band WHEN 'high' THEN NULL WHEN 'low' THEN 'fail' ELSE 'pass' END WHEN band = 'low' THEN 'fail' WHEN band = 'high' THEN 'pass' END AS leaning FROM b)
SELECT doc_id, verdict, leaning, CASE WHEN verdict = 'FAIL_CONTRADICTED' THEN 'REJECT' WHEN conforms IS NULL THEN 'HOLD_FOR_REVIEW' WHEN NOT conforms THEN CASE WHEN form = 'dictionary_entry' THEN 'REJECT' ELSE 'HOLD_FOR_REVIEW' END WHEN verdict = 'PASS' THEN 'ACCEPT' ELSE 'HOLD_FOR_REVIEW' END AS decision FROM v"""
)
def sft_decisions(spark, d):
    c = _cases(spark, d)
    v = decisions.combine_sft(F.col("fact"), decisions.band(F.col("pct")), F.col("pct").isNotNull(), F.lit(None).cast("array<string>"))
    return c.withColumn("v", v).select("doc_id", "v.verdict", "v.leaning", decisions.acceptance(F.col("v.verdict"), F.col("conforms"), F.col("form")).alias("decision"))


@query(
    "SELECT doc_id, CASE WHEN ('0x' || left(sha256(doc_id::VARCHAR), 2))::INT % 2 = 0 THEN 'A' ELSE 'B' END AS slot, left(sha256('m' || chr(0) || lang || chr(0) || source || chr(0)), 32) AS prompt_key FROM documents"
)
def judge_keys(spark, d):
    return _docs(spark, d).select("doc_id", decisions.slot(F.col("doc_id").cast("string")).alias("slot"), decisions.cache_key(F.lit("m"), F.col("lang"), F.col("source")).alias("prompt_key"))


@query(
    """WITH k AS (SELECT column0 AS kind FROM (VALUES ('poor_instruction_following'), ('wrong_formatting'), ('missing_information'), ('unsupported_additions'), ('wrong_register'), ('verbosity'), ('weak_organization'), ('partial_factual_errors'), ('less_faithful_reconstruction')) v(column0)),
w AS (SELECT * FROM (VALUES ('tie'), ('chosen_better_verdict'), ('chosen_better_similarity'), ('rejected_better_verdict')) v(way)), a AS (SELECT * FROM (VALUES (true), (false), (NULL)) v(agrees)), l AS (SELECT * FROM (VALUES ('consistent'), ('inconsistent'), ('not_applicable')) v(len)),
x AS (SELECT *, CASE WHEN kind IN ('wrong_register', 'weak_organization') THEN 'none' WHEN kind = 'poor_instruction_following' THEN 'incidental' WHEN kind IN ('missing_information', 'unsupported_additions') THEN 'partial' ELSE 'strong' END AS det, kind = 'wrong_formatting' AS win FROM k, w, a, l)
SELECT kind, way, agrees::VARCHAR AS agrees, len, CASE WHEN way LIKE 'rejected%' THEN 'FLAG_SUSPICIOUS'
 WHEN way = 'tie' THEN CASE WHEN win AND coalesce(agrees, false) AND det = 'strong' THEN 'AUTO_CONFIRM' WHEN coalesce(agrees, false) OR len = 'consistent' OR det IN ('none', 'incidental') THEN 'NEEDS_JUDGE' ELSE 'FLAG_SUSPICIOUS' END
 WHEN way = 'chosen_better_similarity' THEN CASE WHEN win AND coalesce(agrees, false) AND det = 'strong' THEN 'AUTO_CONFIRM' ELSE 'NEEDS_JUDGE' END
 WHEN det IN ('none', 'incidental') OR NOT coalesce(agrees, false) OR len = 'inconsistent' THEN 'NEEDS_JUDGE' ELSE 'AUTO_CONFIRM' END AS triage FROM x"""
)
def dpo_triage_table(spark, d):
    """Every cell of the table, as rows."""
    one = lambda name, values: F.explode(F.array(*[F.lit(v) for v in values])).alias(name)
    rows = spark.range(1).select(one("kind", decisions.DETECTABLE)).select("kind", one("way", ["tie", "chosen_better_verdict", "chosen_better_similarity", "rejected_better_verdict"]))
    rows = rows.select("*", one("agrees", [True, False, None])).select("*", one("len", ["consistent", "inconsistent", "not_applicable"]))
    t = decisions.triage(F.col("way"), F.col("agrees"), F.col("len"), decisions.lookup(decisions.DETECTABLE, F.col("kind")), F.col("kind") == "wrong_formatting", F.lit(False))
    return rows.withColumn("triage", t).withColumn("agrees", F.col("agrees").cast("string"))


@query(
    r"""WITH q AS (SELECT conv_id, turn, prompt, reply, len(regexp_extract_all(prompt, '\S+')) AS nq, len(regexp_extract_all(reply, '\S+')) AS na, list_has_any(regexp_extract_all(prompt, '\S+'), regexp_extract_all(reply, '\S+')) AS shared FROM {r}),
s AS (SELECT conv_id, turn, greatest(0.0, 1.0 - (CASE WHEN nq < 3 THEN 0.2 ELSE 0.0 END + CASE WHEN nq > 40 THEN 0.1 ELSE 0.0 END + CASE WHEN contains(lower(prompt), 'the question') OR contains(lower(prompt), 'asking about') THEN 0.3 ELSE 0.0 END + 0.1 + 0.5))::DOUBLE AS q,
greatest(0.0, 1.0 - (CASE WHEN na < 5 THEN 0.2 ELSE 0.0 END + CASE WHEN na > 250 THEN 0.1 ELSE 0.0 END + CASE WHEN contains(lower(reply), 'the text') OR contains(lower(reply), 'according to') THEN 0.3 ELSE 0.0 END + 0.5 + CASE WHEN shared THEN 0.0 ELSE 0.15 END))::DOUBLE AS a FROM q)
SELECT conv_id, turn, round(q, 6) AS q, round(a, 6) AS a, round(q * 0.2 + a * 0.3 + 0.5 * 0.2 + 1.0 * 0.15 + 0.15, 6) AS confidence FROM s""".replace("{r}", _REPLIES)
)
def rubric_scores(spark, d):
    rows = quality.scored(_replies(spark, d), F.col("prompt"), F.col("reply"), F.lit(""), F.lit(0), F.array().cast("array<string>"))
    return rows.select("conv_id", "turn", F.round("question_naturalness", 6).alias("q"), F.round("answer_naturalness", 6).alias("a"), F.round("teacher_confidence", 6).alias("confidence"))


@query(
    """WITH s AS (SELECT conv_id::VARCHAR AS sample_id FROM (SELECT DISTINCT conv_id FROM conversations)), n AS (SELECT least(ceil(300 / count(*)), 3)::BIGINT AS k FROM s),
r AS (SELECT sample_id, i AS kind_no, ['verbosity', 'wrong_register', 'missing_information'][i + 1] AS rejection_type, row_number() OVER (ORDER BY sample_id, i) AS place FROM s, n, range(0, 3) r(i) WHERE i < k)
SELECT sample_id || '_dpo_' || lpad((kind_no + 1)::VARCHAR, 2, '0') AS pair_id, rejection_type FROM r WHERE place <= 300"""
)
def pair_plan(spark, d):
    s = _t(spark, d, "conversations").select(F.col("conv_id").cast("string").alias("sample_id")).distinct()
    return jobs.plan_pairs(s, 300, ["verbosity", "wrong_register", "missing_information"]).select("pair_id", "rejection_type")


@query(
    """SELECT event_id, CASE WHEN NOT json_valid(props) THEN 'unparseable' WHEN list_contains(json_keys(props), 'k') THEN 'ok' ELSE 'incomplete' END AS state FROM events"""
)
def reply_states(spark, d):
    return _t(spark, d, "events").select("event_id", judge.parse_state(F.col("props"), ["k"]).alias("state"))


@query("WITH u AS (SELECT list_transform(embedding, lambda x: x::DOUBLE / sqrt(list_sum(list_transform(embedding, lambda y: y::DOUBLE * y::DOUBLE)))) AS v FROM embeddings), e AS (SELECT unnest(v) AS x, generate_subscripts(v, 1) AS i FROM u), s AS (SELECT i, sum(x) AS s, count(*) AS n FROM e GROUP BY i) SELECT max(n) AS n, (sum(s * s) - max(n)) / (max(n) * (max(n) - 1)) AS mean_cosine FROM s")
def mean_cosine(spark, d):
    return similarity.mean_cosine(_t(spark, d, "embeddings"), "embedding")


@query("WITH o AS (SELECT source, lang, count(*) AS n, count_if(coalesce(trim(text), '') = '') AS bare FROM documents GROUP BY ALL), k AS (SELECT source, sum(n)::BIGINT AS n, sum(bare)::BIGINT AS bare FROM o GROUP BY source) SELECT sum(n)::BIGINT AS rows, sum(n - 1)::BIGINT AS repeated, sum(bare)::BIGINT AS incomplete FROM k")
def integrity(spark, d):
    return dedup.integrity(_docs(spark, d), "source", ["text"])


@query("SELECT conv_id, turn FROM " + _ECHOES + " WHERE trim(prompt) = trim(reply)")
def regeneration_targets(spark, d):
    from nasij.operators.generation import regeneration_targets as same

    return same(_echoes(spark, d), "prompt", "reply").select("conv_id", "turn")


@query(r"SELECT doc_id, array_to_string(list_sort(list_filter(['und', 'der', 'the', 'les'], lambda m: list_contains(regexp_extract_all(text, '[A-Za-z]+'), m))), ' ') AS marks FROM documents")
def marker_words(spark, d):
    found = formats.dialect_markers(F.col("text"), ("und", "der", "the", "les"), "[A-Za-z]")
    return _docs(spark, d).select("doc_id", F.array_join(F.array_sort(found), " ").alias("marks"))


@query("SELECT (SELECT count(*) FROM documents) AS chunks, (SELECT count(*) FROM conversations) AS samples, (SELECT count(*) FROM labels) AS pairs, (SELECT count(*) FROM conversations) / (SELECT count(*) FROM documents) AS expansion, (SELECT count(*) FROM labels) / (SELECT count(*) FROM conversations) AS conversion")
def overview(spark, d):
    return stats.overview(_docs(spark, d), _t(spark, d, "conversations"), _t(spark, d, "labels"))


@query()
def lsh_candidates(spark, d):
    """Bands depend on this engine's hashes: no SQL form; tests hold the
    estimates to the exact similarity."""
    return dedup.lsh_candidates(_docs(spark, d), "doc_id", "text")


@query(
    """WITH w AS (SELECT event_id AS id, (event_id % 7 * 100)::INT AS left_, (event_id % 40)::INT AS line, (event_id // 400)::INT AS page, event_type AS text FROM events)
SELECT page, line, string_agg(text, ' ' ORDER BY left_ DESC, text) AS text, count(*) AS n FROM w GROUP BY 1, 2"""
)
def ocr_lines(spark, d):
    e = _t(spark, d, "events")
    i = F.col("event_id")
    rows = e.select((i / 400).cast("int").alias("page"), F.lit(1).alias("block_num"), F.lit(1).alias("par_num"), (i % 40).cast("int").alias("line_num"), (i % 7 * 100).cast("int").alias("left"), (i % 40).cast("int").alias("top"), F.lit(90.0).alias("conf"), F.col("event_type").alias("text"))
    return ocr.lines(rows).select("page", F.col("line_num").alias("line"), "text", F.size(F.split("text", " ")).cast("long").alias("n"))
