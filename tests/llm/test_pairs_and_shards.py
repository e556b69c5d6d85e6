import re
import zlib
from collections import defaultdict

import pytest
from tests.llm import cases

from nasij.llm import common, graph, neardup, sharding, urls

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, k=4):
    w = WORD.findall((text or "").translate(LOWER))
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def brute(rows):
    sets = {i: shingles(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                p, q = sorted((find(a), find(b)))
                root[q] = p
    return {i: (len(sets[i]), find(i)) for i in ids}


def test_neardup_matches_brute_force(spark):
    docs = cases.corpus(spark)
    want = brute([(r["doc_id"], r["text"]) for r in docs.collect()])
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in neardup.components(docs, size=4).collect()}
    assert got == want
    assert sum(v[1] == k for k, v in want.items()) < len(want)


def test_neardup_odd_cases(spark):
    docs = cases.odd(spark)
    rows = neardup.components(docs, size=4).collect()
    assert len(rows) == docs.count()
    want = brute([(r["doc_id"], r["text"]) for r in docs.where("doc_id is not null").collect()])
    for r in rows:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["kept"]
        else:
            assert (r["n_shingles"], r["component_id"], r["kept"]) == (*want[r["doc_id"]], want[r["doc_id"]][1] == r["doc_id"])
    assert neardup.components(cases.none(spark)).count() == 0
    kept = neardup.deduplicated(docs, size=4)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect() if r["doc_id"] is not None]
    assert sorted(ids) == sorted(k for k, v in want.items() if v[1] == k)


def test_large_nodes_and_clusters_are_split_without_loss(spark, monkeypatch):
    monkeypatch.setattr(neardup, "NODE", 4)
    monkeypatch.setattr(neardup, "BLOCK", 200)
    docs = cases.corpus(spark, 40)
    # one passage that all share, and many near copies of one text
    extra = spark.createDataFrame([(5000 + i, cases.prose(7, 60) + f" end{i}", "en", "s", 1, 0.1, "q", 1, "r") for i in range(25)], cases.SCHEMA)
    docs = docs.unionByName(extra)
    want = brute([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in neardup.components(docs, size=4).collect()} == want


def test_links_of_a_large_group_grow_with_its_size(spark, monkeypatch):
    """Near copies in many blocks, of two texts that share a passage: whole
    components from fewer links than rows in all trees."""
    monkeypatch.setattr(neardup, "NODE", 8)
    monkeypatch.setattr(neardup, "BLOCK", 2000)
    made, real = [], neardup.grouped

    def counted(df, key, fn, schema):
        out = neardup.Written(real(df, key, fn, schema), "counted").df
        made.append((key, out.count()))
        return out

    monkeypatch.setattr(neardup, "grouped", counted)
    bodies = [cases.prose(7, 60), " ".join([*cases.prose(7, 60).split()[:40], *cases.prose(8, 60).split()[:20]])]
    rows = [(i, f"{bodies[i % 5 == 0]} end{i}") for i in range(200)] + [(1000 + i, cases.prose(100 + i, 40)) for i in range(20)]
    got = {r["doc_id"]: r["component_id"] for r in neardup.components(spark.createDataFrame(rows, "doc_id long, text string"), size=4).collect()}
    assert got == _links(rows) and len(set(got.values())) == 22
    assert sum(n for key, n in made if key == "node") < neardup.TREES * len(rows)
    assert sum(n for key, n in made if key == "cluster") < 2 * len(rows)


def test_parts_are_joined_by_one_link_each():
    import numpy as np

    part = np.array([0, 0, 0, 1, 1, 2, 3])
    near = {(0, 3), (1, 4), (2, 5), (4, 5)}
    looked = []

    def links(i, left):
        looked.extend((i, j) for j in left.tolist())
        return np.array([(i, j) in near for j in left.tolist()], bool)

    assert sorted(neardup._join(part, links)) == [(0, 3), (2, 5)]
    assert not any(part[i] == part[j] for i, j in looked) and {(i, 6) for i in range(6)} <= set(looked)


def test_copies_without_an_id_are_removed(spark):
    docs = cases.corpus(spark, 20)
    bare = docs.selectExpr("cast(null as long) as doc_id", *[c for c in docs.columns if c != "doc_id"])
    both = docs.unionByName(bare).unionByName(bare)
    clash = both.withColumn("_row", both["size"]).withColumn("_id", both["rep"])
    got = neardup.deduplicated(clash, size=4)
    assert got.columns == clash.columns
    want = brute([(r["doc_id"], r["text"]) for r in docs.collect()])
    rows = got.collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(k for k, v in want.items() if v[1] == k)
    assert all(r["_row"] == 2 and r["_id"] == "r" for r in rows)
    alone = neardup.deduplicated(bare.unionByName(bare), size=4)
    assert alone.count() == len(rows)


def _links(rows, k=4):
    """Components over an inverted index: every pair with a shingle in common."""
    sets = {i: shingles(t, k) for i, t in rows}
    by, root = defaultdict(list), {i: i for i in sets}
    for i, s in sets.items():
        for x in s:
            by[x].append(i)

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for i in sorted(sets):
        met = defaultdict(int)
        for x in sets[i]:
            for j in by[x]:
                if j < i:
                    met[j] += 1
        for j, n in met.items():
            if 100 * n >= 80 * (len(sets[i]) + len(sets[j]) - n):
                p, q = sorted((find(i), find(j)))
                root[q] = p
    return {i: find(i) for i in sets}


def test_all_links_at_the_threshold_are_found_among_many(spark):
    """Over 5,000 documents; near copies at similarity 0.80, 0.86 and 0.93."""
    rows = []
    for i in range(1300):
        w = cases.prose(i, 30).split()
        rows += [(4 * i, " ".join(w))] + [(4 * i + k, " ".join([*w[: 30 - k], f"new{i}", *w[31 - k :]])) for k in (1, 2, 3)]
    want = _links(rows)
    got = {r["doc_id"]: r["component_id"] for r in neardup.components(spark.createDataFrame(rows, "doc_id long, text string"), size=4).collect()}
    assert got == want and len(set(want.values())) < len(rows) / 2


def test_sets_are_made_once_for_each_clustered_text(spark, monkeypatch):
    """No Python function runs below a join on the documents' texts."""
    plans = []

    class Spy(neardup.Written):
        def __init__(self, df, tag):
            plans.append((tag, df._jdf.queryExecution().optimizedPlan().toString()))
            super().__init__(df, tag)

    monkeypatch.setattr(neardup, "Written", Spy)
    neardup.components(cases.corpus(spark, 20), size=4).count()
    plan = dict(plans)["sets"]
    assert plan.count("ArrowEvalPython") == 1 and plan.index("ArrowEvalPython") < plan.index("Join")


def test_edges_of_hubs_are_joined_by_broadcast(spark, monkeypatch):
    monkeypatch.setattr(graph, "HUBS", 4)
    monkeypatch.setattr(graph, "FEW", 1)
    edges = [(0, i) for i in range(1, 60)] + [(i, 100 + i) for i in range(1, 60)] + [(300, 301), (301, 302)]
    got = {r["node"]: r["component"] for r in graph.connected_components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert got == {i: 0 for i in [*range(1, 60), *range(101, 160)]} | {301: 300, 302: 300}


def test_components_of_paths_stars_and_rings(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, i) for i in range(101, 140)] + [(200, 201), (201, 202), (202, 200), (5, 5), (None, 3), (201, 200)]
    got = {r["node"]: r["component"] for r in graph.connected_components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    want = {i: 0 for i in range(1, 31)} | {i: 100 for i in range(101, 140)} | {201: 200, 202: 200}
    assert got == want
    assert graph.connected_components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def test_shards_are_even_and_places_gapless(spark):
    docs = cases.corpus(spark).unionByName(cases.odd(spark).where("length(text) < 5000 or text is null"))
    got, m = sharding.shard(docs, shards=5)
    rows = got.collect()
    assert len(rows) == docs.count()
    size, slots = defaultdict(int), defaultdict(list)
    for r in rows:
        size[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert max(size.values()) - min(size.values()) <= max(r["size"] for r in rows)
    text = {(r["doc_id"], r["text"]) for r in docs.collect()}
    sizes = {(i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in text}
    assert {(r["doc_id"], r["size"], r["text_crc32"]) for r in rows} == sizes
    assert sharding.shard(cases.none(spark))[0].count() == 0


def test_slot_map_is_edited_not_rebuilt():
    weights = [100 + (i * 37) % 50 for i in range(400)]
    first = sharding.SlotMap.build(weights, 8)
    grown = first.edited(weights, 9)
    assert grown.version == 2 and set(grown.owner) == set(range(9))
    moved = [i for i, (a, b) in enumerate(zip(first.owner, grown.owner, strict=True)) if a != b]
    assert 0 < len(moved) <= 400 // 9 + 8 and all(grown.owner[i] == 8 for i in moved)
    less = grown.edited(weights, 7)
    assert set(less.owner) == set(range(7))
    assert sharding.SlotMap.from_json(less.to_json()) == less


def test_a_stored_map_is_loaded_and_edited(spark, tmp_path):
    folder = f"file://{tmp_path}/map"
    docs = cases.corpus(spark)
    first = {(r["doc_id"], r["shard"]) for r in sharding.rebalanced(docs, folder, 5)[0].collect()}
    # the same rows again: nothing moves, no new version
    again, m = sharding.rebalanced(docs, folder, 5)
    assert {(r["doc_id"], r["shard"]) for r in again.collect()} == first
    assert m.version == 1 and sharding.versions(spark, folder) == [1]
    # one shard more: few rows move, and the first version is still there
    grown, m = sharding.rebalanced(docs, folder, 6)
    rows = grown.collect()
    assert m.version == 2 and sharding.versions(spark, folder) == [1, 2] and {r["map_version"] for r in rows} == {2}
    moved = {(r["doc_id"], r["shard"]) for r in rows} - first
    assert moved and {s for _, s in moved} == {5}
    assert sharding.load(spark, folder, 1).shards == 5 and sharding.load(spark, folder) == m
    assert m.history[-1] and all(m.owner[slot] == to for slot, _, to in m.history[-1])


def judged(spark, rows):
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, verdict string")
    return {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in urls.judge(pages).collect()}


def test_url_rules_and_propagation(spark):
    canon = '<html><head><link href="https://a.example.com/en/1" rel="canonical"></head>'
    hop = '<meta http-equiv="refresh" content="0; url=/two">'
    got = judged(spark, [
        (1, "https://a.example.com/en/1?x#y", None, "z"), (2, "http://WWW.Example.com/en/2", "", None), (3, "https://other.org/page", canon, None), (4, "https://x.net/es/5", "", None), (5, None, None, None),
        (6, "no scheme", "<p>", None), (7, "https://m.org/one", hop, None), (8, "https://m.org/two", '<link rel=canonical href=//other.org/page/>', None), (9, "https://free.org/", "", None), (10, "https://example.com", "", None),
        (11, "https://both.org/a", '<link rel="canonical" href="https://q.example.com/en/7">', None), (12, "https://q.example.com/en/7", '<link rel="canonical" href="https://shop.com/x">', None), (13, "https://shop.com/x", None, None),
        (3, "https://other.org/page", canon, None), (14, "ftp://É.net/fr/x", None, None),
    ])
    assert got[1] == ("a.example.com", "/en/1", "example.com/en/", "block")
    assert got[2][2:] == ("www.example.com/en/", "allow")
    assert got[3] == ("other.org", "/page", None, "block")
    assert got[4][2:] == ("net/es/", "block")
    assert got[5] == got[6] == ("", "", None, "allow")
    assert got[7][3] == got[8][3] == "block"  # through two more links
    assert got[9][3] == "allow" and got[10] == ("example.com", "", None, "allow")
    assert got[11][3] == "allow"  # its class holds an explicit allow
    assert got[12][3] == "block" and got[13][3] == "allow"
    assert got[14] == ("É.net", "/fr/x", "net/fr/", "block")
    assert judged(spark, []) == {}


def test_every_link_of_a_page_is_an_edge(spark):
    two = '<link rel="canonical" href="https://one.org/"><p><link href="https://a.example.com/en/1" rel="canonical">'
    og = '<meta property="og:url" content="https://two.org/x"><meta property="og:url" content="https://q.net/es/1">'
    got = judged(spark, [(1, "https://free.org/a", two, None), (2, "https://free.org/b", og, None), (3, "https://one.org/", None, None), (4, "https://two.org/x", "", None)])
    assert [got[i][3] for i in (1, 2, 3, 4)] == ["block"] * 4


def test_url_operator_stays_native(spark):
    plan = urls.judge(spark.createDataFrame([(1, "https://a.com/b", "")], "page_id long, url string, html string"))._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_written_tables_are_released(spark):
    start = len(common.Written.held)
    a, b = common.Written(spark.range(3), "a"), common.Written(spark.range(4), "b")
    common.release(b, since=start)
    assert common.Written.held[start:] == [b] and b.df.count() == 4
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(a.path)
    assert not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)
    b.drop()


def test_a_cluster_needs_a_shared_folder(spark, monkeypatch):
    from types import SimpleNamespace

    far = SimpleNamespace(sparkContext=SimpleNamespace(master="spark://far:7077", applicationId="x", getConf=dict))
    with pytest.raises(ValueError, match="checkpoint"):
        common.shared_dir(far)
