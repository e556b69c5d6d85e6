import math
import random
import zlib

import numpy as np
import pytest
from tests.llm import cases

from nasij.llm import common, langid, quality, toxicity


def held(i):
    return zlib.crc32(str(i).encode()) % 4 == 2


def labelled(spark, n=400):
    """Good and bad, clean and toxic documents that are easy to tell."""
    r = random.Random(3)
    docs, labels = [], []
    for i in range(n):
        words = [f"thing{r.randrange(300)}" for _ in range(60)]
        bad, toxic = i % 4 == 0, i % 5 == 0
        if toxic:
            for k in range(6):
                words[10 * k] = r.choice(["scoundrel", "vermin", "rotter"])
        if bad:
            words = [w.upper() + "!!" for w in words]
        docs.append((i, " ".join(words), "en", "s", 1, 0.1, "q", 1, "r"))
        labels.append((i, int(not bad), int(toxic), "clash"))
    labels += [(1, 1, 0, "again"), (None, 1, 1, ""), (7, None, None, ""), (10**6, 1, 1, "")]
    return spark.createDataFrame(docs, cases.SCHEMA), cases.labels(spark, labels)


def test_segments_match_brute_force():
    r = random.Random(1)
    for _ in range(60):
        s = [r.choice([-2.0, -1.0, 1.0, 3.0]) for _ in range(r.randrange(1, 25))]
        got = toxicity.segments(s)
        # disjoint, in order, with their sums, and the best of all among them
        assert all(abs(sum(s[a:b]) - v) < 1e-9 for a, b, v in got)
        assert all(x[1] <= y[0] for x, y in zip(got, got[1:], strict=False))
        best = max(sum(s[a:b]) for a in range(len(s)) for b in range(a + 1, len(s) + 1))
        if best > 0:
            assert max(v for _, _, v in got) == pytest.approx(best)
        for a, b, _ in got:  # no proper end of a segment has a sum of 0 or less
            assert all(sum(s[a:k]) > 0 and sum(s[k:b]) > 0 for k in range(a + 1, b))
        covered = {k for a, b, _ in got for k in range(a, b)}
        assert all(k in covered for k, v in enumerate(s) if v > 0)


def test_toxicity_learns_and_finds_passages(spark):
    docs, labels = labelled(spark)
    model = toxicity.fit(docs, labels)
    rows = {r["doc_id"]: r for r in toxicity.score(docs, model).collect()}
    assert all(r["held_out"] == held(i) for i, r in rows.items())
    wrong = [i for i, r in rows.items() if held(i) and r["predicted"] != int(i % 5 == 0)]
    assert len(wrong) <= 2
    found = toxicity.passages(docs, model).where("doc_id = 5").collect()
    assert found and all(0 <= p["start_word"] < p["end_word"] <= 60 for p in found)


def test_quality_learns(spark):
    docs, labels = labelled(spark)
    rows = {r["doc_id"]: r for r in quality.score(docs, quality.fit(docs, labels)).collect()}
    assert sum(r["predicted"] != int(i % 4 != 0) for i, r in rows.items() if held(i)) <= 2


@pytest.mark.parametrize("op", [toxicity, quality])
def test_scores_of_odd_cases(spark, op):
    docs, labels = labelled(spark, 120)
    odd = cases.odd(spark)
    rows = op.score(odd, op.fit(docs, labels)).collect()
    assert len(rows) == odd.count()
    assert all(0 <= r["score"] <= 1 and r["predicted"] in (0, 1) and r["held_out"] is not None for r in rows)
    same = [r["score"] for r in rows if r["doc_id"] in (0, 1)]
    assert same[0] == same[1]  # null is empty
    for few in (cases.labels(spark, []), cases.labels(spark, [(1, 1, 1, "")])):
        assert all(0 <= r["score"] <= 1 for r in op.score(odd, op.fit(docs, few)).collect())
    assert op.score(cases.none(spark), op.fit(cases.none(spark), labels)).count() == 0


def test_labels_of_the_held_out_fold_are_not_read(spark):
    docs, labels = labelled(spark, 120)
    chosen = {r["doc_id"] for r in common.label_sample(labels, "toxic", 1000).collect()}
    assert chosen and not any(held(i) for i in chosen)
    flipped = labels.selectExpr("doc_id", "case when crc32(cast(cast(doc_id as string) as binary)) % 4 = 2 then 1 - quality else quality end as quality", "toxic", "text")
    assert quality.fit(docs, labels) == quality.fit(docs, flipped)


def test_logistic_finds_the_curve():
    rng = np.random.default_rng(0)
    x = rng.normal(size=4000)
    y = (rng.random(4000) < 1 / (1 + np.exp(-(2 * x - 1)))).astype(int)
    slope, bias = common.logistic(x[:, None], y, np.ones(4000))
    assert abs(slope - 2) < 0.25 and abs(bias + 1) < 0.2


def test_extreme_value_law_solves_its_equation():
    m = toxicity.extreme_values(toxicity.Lexicon({"a": 3.0, "b": 5.0}), {3.0: 20, 5.0: 5, toxicity.DRIFT: 10_000})
    total = 10_026
    p = {3.0: 20 / total, 5.0: 5.5 / total}
    assert (1 - sum(p.values())) * math.exp(m.lam * toxicity.DRIFT) + sum(q * math.exp(m.lam * s) for s, q in p.items()) == pytest.approx(1, abs=1e-6)


def test_languages_are_told(spark):
    docs = cases.corpus(spark)
    rows = langid.predict(docs, langid.fit(docs)).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert all(r["held_out"] == held(r["doc_id"]) for r in rows)
    assert sum(r["lang_pred"] != r["lang"] for r in rows if r["held_out"]) == 0


def test_language_of_odd_cases(spark):
    docs, odd = cases.corpus(spark), cases.odd(spark)
    rows = langid.predict(odd, langid.fit(docs)).collect()
    assert len(rows) == odd.count()
    by = {r["doc_id"]: r for r in rows}
    assert all(by[i]["lang_pred"] == "und" and by[i]["score"] == 0 and by[i]["rejected"] for i in (0, 1, 2, 8))
    assert all(r["lang_pred"] in ("en", "fr", "de", "und") and 0 <= r["score"] <= 1 for r in rows)
    assert by[3]["lang_pred"] != "und"
    empty = langid.fit(cases.none(spark))
    assert all(r["lang_pred"] == "und" for r in langid.predict(odd, empty).collect())
    assert langid.predict(cases.none(spark), langid.fit(docs)).count() == 0


def test_trigram_counts_do_not_depend_on_the_step(monkeypatch):
    text = cases.prose(4, 500)
    whole = langid.counts(text)
    assert whole.sum() > 1000
    monkeypatch.setattr(langid, "STEP", 1 << 22)
    assert (langid.counts(text) == whole).all()


def test_quality_score_is_its_sizes_by_brute_force(spark):
    import zstandard

    docs, labels = labelled(spark, 200)
    model = quality.fit(docs, labels)
    tools = [zstandard.ZstdCompressor(level=quality.LEVEL, dict_data=zstandard.ZstdCompressionDict(d), write_checksum=False, write_content_size=False, write_dict_id=False) for d in (model.good, model.bad)]
    texts = {r["doc_id"]: (r["text"] or "").encode() for r in docs.collect()}
    for r in quality.score(docs, model).collect():
        t = texts[r["doc_id"]]
        pairs = [tuple(len(c.compress(t[i : i + 256])) for c in tools) for i in range(0, len(t), 256)]
        whole = (sum(b for _, b in pairs) - sum(a for a, _ in pairs)) / (sum(a + b for a, b in pairs) + 16)
        each = sorted((b - a) / (a + b + 32) for a, b in pairs)
        at = 0.1 * (len(each) - 1)
        worst = each[int(at)] + (at - int(at)) * (each[min(int(at) + 1, len(each) - 1)] - each[int(at)])
        assert r["score"] == pytest.approx(1 / (1 + math.exp(-(model.slopes[0] * whole + model.slopes[1] * worst + model.bias))), abs=1e-9)


def test_pieces_are_spread_over_the_text():
    short, long = b"x" * 3000, bytes(range(256)) * 400
    assert b"".join(quality.pieces(short)) == short
    got = quality.pieces(long)
    assert len(got) == quality.PIECES and got[0] == long[:1024] and got[-1] == long[-1024:]


def _best_runs(scores, base=0):
    """Maximal segments by their definition: the best run, then left and right of it."""
    best, at = 0.0, None
    for a in range(len(scores)):
        total = 0.0
        for b in range(a, len(scores)):
            total += scores[b]
            if total > best + 1e-12:
                best, at = total, (a, b + 1)
    if at is None:
        return []
    a, b = at
    return _best_runs(scores[:a], base) + [(base + a, base + b, best)] + _best_runs(scores[b:], base + b)


def test_toxicity_score_by_brute_force(spark):
    docs, labels = labelled(spark, 200)
    model = toxicity.fit(docs, labels)
    assert model.scores and model.slope > 0
    rows = {r["doc_id"]: r["score"] for r in toxicity.score(docs, model).collect()}
    for i, text in [(r["doc_id"], r["text"]) for r in docs.collect()][:80]:
        tokens, scores = text.lower().split(), []
        for t in tokens:
            word = t.strip(toxicity.STRIP)
            hits = [model.scores[f] for f in ("=" + word, "^" + word[:4], "^" + word[:5]) if f in model.scores and len(f) - 1 in (len(word), 4, 5)]
            scores.append(max(hits, key=abs) if hits else -0.5)
        n, exponent = len(tokens), 0.0
        sums = sorted((s for _, _, s in _best_runs(scores) if model.k * n * math.exp(-model.lam * s) <= 0.05), reverse=True)
        normal = [model.lam * s - math.log(model.k * n) for s in sums]
        for r in range(1, len(normal) + 1):
            t = sum(normal[:r])
            if min(normal[:r]) > 0 and t > 0:
                exponent = max(exponent, t - (r - 1) * math.log(max(t, 1.0)) + math.log(math.factorial(r)))
        assert rows[i] == pytest.approx(1 / (1 + math.exp(-(model.slope * math.log(1 + exponent) + model.bias))), abs=1e-9)


def test_texts_that_share_a_line_all_count(spark):
    """Near copies weigh as one document, texts with one line in common as many."""
    line = "all rights reserved by the owners of this text and of all others"
    copies = [f"{line} " + " ".join(f"copy{j}" for j in range(60)) + f" end{i}" for i in range(4)]
    apart = [f"{line} " + cases.prose(i, 60) for i in range(4)]
    import pandas as pd

    got = toxicity._sketch(pd.Series(copies + apart)).tolist()
    assert len(set(got[:4])) <= 2 and len(set(got[4:])) == 4


def test_language_is_the_nearest_centroid_by_brute_force(spark):
    docs = cases.corpus(spark)
    model = langid.fit(docs)
    rows = {r["doc_id"]: r for r in langid.predict(docs, model).collect()}
    for i, text in [(r["doc_id"], r["text"]) for r in docs.collect()][:60]:
        raw = (" " + text.lower() + " ").encode()
        kept = bytes(b if 97 <= b < 123 or b >= 128 else 32 for b in raw)
        while b"  " in kept:
            kept = kept.replace(b"  ", b" ")
        seen = {}
        for a, b, c in zip(kept, kept[1:], kept[2:], strict=False):
            h = (a * 0x9E3779B1 + b * 0x85EBCA77 + c * 0xC2B2AE3D) % 2**32
            h ^= h >> 15
            h = h * 0x27D4EB2F % 2**32 >> 20
            seen[h] = seen.get(h, 0) + 1
        v = {k: math.log(1 + n) * float(model.idf[k]) for k, n in seen.items()}
        norm = math.sqrt(sum(x * x for x in v.values()))
        cosines = [sum(x * float(c[k]) for k, x in v.items()) / norm for c in model.vectors]
        best = max(cosines)
        assert rows[i]["score"] == pytest.approx(best, abs=1e-5)
        near = {model.langs[o] for o, c in zip(model.owner, cosines, strict=True) if c > best - 1e-5}
        assert rows[i]["lang_pred"] in near


def test_runs_are_spread_over_the_whole_text():
    text = cases.prose(2, 300)
    got = list(langid.runs(text))
    assert got[0] == text and text.endswith(got[-1])
    assert all(x in text for x in got) and {len(x) for x in got[1:]} == {8, 32, 128, 512}
    assert list(langid.runs("short")) == ["short"]
