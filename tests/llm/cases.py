"""Documents with every odd case, and a small ordinary corpus."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, held_out string, size int, rep string"


def prose(seed: int, n: int, stem: str = "word") -> str:
    r = random.Random(seed)
    return " ".join(f"{stem}{r.randrange(4000)}" for _ in range(n))


def odd(spark):
    long = prose(1, 30_000)
    texts = [None, "", "   \n\t ", "one", "two words", "A b\tC  d", long, long + " tail", "١٢٣ 456 --", "repeat " * 300, "é" * 50, "same text here is it", "same text here is it"]
    rows = [(i, t, "en" if i % 2 else None, "s" if i % 3 else None, None, 0.5, "x", 1, "r") for i, t in enumerate(texts)]
    rows += [rows[-1], rows[5], (None, "no id at all", None, None, None, None, None, None, None), (None, None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA)


def none(spark):
    return spark.createDataFrame([], SCHEMA)


def corpus(spark, n: int = 120):
    """Documents of several languages' stems, near copies and exact copies."""
    stems = {"en": "thing", "fr": "éauon", "de": "schlü"}
    rows, i = [], 0
    for k in range(n):
        lang = ("en", "fr", "de")[k % 3]
        text = prose(k, 40 + k % 50, stems[lang])
        rows.append((i, text, lang, f"src{k % 4}", len(text), 0.1, "q", 2, "r"))
        i += 1
        if k % 5 == 0:
            w = text.split()
            w[len(w) // 2] = "changed"
            for t in (text, " ".join(w), " ".join(w[: len(w) // 2])):
                rows.append((i, t, lang, f"src{k % 4}", len(t), 0.1, "q", 2, "r"))
                i += 1
    return spark.createDataFrame(rows, SCHEMA)


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int, text string")
