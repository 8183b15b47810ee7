"""Small tables with nulls, empty and long texts, ties, repeated rows and clashing extra columns."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row long, shard int, size string, score string, node string, text_crc32 int"


def words(r, n, vocabulary=400):
    return " ".join(f"w{r.randrange(vocabulary)}" for _ in range(n))


def documents(seed=1):
    r = random.Random(seed)
    base = [words(r, r.randint(0, 120)) for _ in range(60)]
    passage = words(r, 60)
    texts = list(base)
    texts += base[:10]  # exact copies
    for t in base[10:30]:  # near copies
        w = t.split()
        if len(w) > 60:
            w[r.randrange(len(w))] = "edited"
        texts.append(" ".join(w))
    texts += [words(r, 20) + " " + passage + " " + words(r, 20) for _ in range(6)]
    texts += [None, "", " ", "\n", "\n\n", "a", "A b", "é à ü", "x " * 3000, words(r, 20000), "日本語 テキスト", "Cc By 4.0", "All Rights\nReserved. all rights reserved", "line one\nline two\nLINE ONE \n\nline one"]
    rows = [(i, t, r.choice(["en", "fr", None]), r.choice(["s1"] * 5 + ["s2", None]), len(t or ""), 1, 2, "z", "q", None, 3) for i, t in enumerate(texts)]
    rows += [rows[3], rows[3], (None, base[4], None, None, None, None, None, None, None, None, None), (7, base[8], "en", "s1", 1, 1, 1, "", "", "", 1)]
    r.shuffle(rows)
    return rows


def frame(spark, rows=None, parts=3):
    return spark.createDataFrame(documents() if rows is None else rows, SCHEMA).repartition(parts)
