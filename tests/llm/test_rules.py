import collections
import math
import random
import re

import numpy as np
import pandas as pd

from lexweave.llm import rules
from tests.llm.cases import documents, frame, words

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(t):
    t = t or ""
    w = WORD.findall(t)
    tri = list(zip(w, w[1:], w[2:], strict=False))
    count = collections.Counter(tri)
    hit = {k + j for k, x in enumerate(tri) if count[x] > 1 for j in range(3)}
    seen, dup = set(), 0
    for line in t.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    failed = len(w) < 50 or 100 * len(hit) > 50 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(hit), failed


def test_base_against_brute_force(spark):
    docs = documents() + [(800 + i, t, "en", None, 0, 0, 0, "", "", "", 0) for i, t in enumerate(["a b c a b c", "a\n\nb\na\n", "# * $\r\n%&|<>", "\na\n", "x\n\n\nx", "a b c d b c d e f g"])]
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = rules.judge(frame(spark, docs), none).collect()
    assert sorted(map(str, ((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) for r in got))) == sorted(str((d, *brute(t))) for d, t, *_ in docs)
    assert all(r["kept"] == (not r["base_failed"]) for r in got)
    assert rules.judge(frame(spark, []), none).collect() == []


def test_upper_bound_is_exact():
    for k, n, level in ((0, 100, 0.05), (3, 50, 0.01), (10, 400, 0.001)):
        p = rules.upper_bound(k, n, level)
        assert math.isclose(sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1)), level, rel_tol=1e-6)
    assert rules.upper_bound(5, 5, 0.05) == 1 and rules.upper_bound(0, 0, 0.05) == 1


def test_cutoffs_are_lenient_and_in_the_order_of_what_they_catch():
    rows = [("symbols", 1, 2, 2000), ("symbols", 0, 30, 40), ("upper", 1, 3, 2000), ("upper", 0, 9, 50), ("upper", 1, 9, 5), ("bangs", 1, 4, 2000), ("bangs", 0, 4, 90)]
    cut = rules.choose(pd.DataFrame(rows, columns=["rule", "quality", "bin", "n"]))
    assert cut["upper"] == (9, 0) and cut["symbols"] == (30, 1) and cut["bangs"][0] == rules.BINS + 1


def test_rules_are_certified_together():
    """Each of three rules rejects few good documents, all of them too many."""
    good, bad = np.array([9, 9, 9, 0, 0, 0, 2973]), np.array([50, 40, 30, 0, 0, 0, 10])
    tests = 6
    want = [k for k in range(1, 7) if rules.upper_bound(int(good[:k].sum()), 3000, rules.DELTA / tests) <= rules.RISK]
    assert want == [1] and rules.certified(good, bad, tests) == 1
    assert rules.certified(np.array([0, 0, 0, 0, 0, 0, 3000]), bad, tests) == 3  # the fewest that catch most
    assert rules.certified(np.array([0, 0, 0, 0, 0, 0, 100]), bad, tests) == 0  # too few labels


def test_verdicts_against_brute_force(spark):
    """Cutoffs and verdicts from the features alone, in plain Python."""
    r = random.Random(9)
    docs = [(i, words(r, 60, 9000) + " !" * r.choice([0, 0, 0, 1, 2]), r.choice(["en", "fr"]), "s", 0, 0, 0, "", "", "", 0) for i in range(4000)]
    docs += [(5000 + i, words(r, 50, 9000).replace("w", "W") + " ***!" * r.choice([0, 20]), r.choice(["en", "fr"]), "s", 0, 0, 0, "", "", "", 0) for i in range(600)]
    labels = [(d[0], int(d[0] < 5000), 0) for d in docs]
    given, table = frame(spark, docs), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    fold = {x["doc_id"]: x["f"] for x in given.selectExpr("doc_id", "pmod(xxhash64(doc_id, 'fold'), 2) as f").collect()}
    features = {x["doc_id"]: x.asDict() for x in rules.stats(given).collect()}
    off, want = rules.BINS + 1, {}
    for lang in ("en", "fr"):
        own = {d[0]: features[d[0]] for d in docs if d[2] == lang}
        share = lambda f, q, hit: sum(1 for d, x in own.items() if fold[d] == f and (d < 5000) == q and hit(x))  # noqa: B023, E731
        cut, caught = {}, {}
        for rule in rules.RULES:
            at = lambda c, rule=rule: lambda x: x[f"f_{rule}"] >= c
            ok = [c for c in range(1, off + 1) if share(0, True, at(c)) / share(0, True, lambda x: True) <= rules.RISK / 2]
            bad = {c: share(0, False, at(c)) for c in ok}
            cut[rule] = max(c for c in ok if bad[c] >= rules.NEARLY * max(bad.values())) if max(bad.values()) else off
            caught[rule] = bad.get(cut[rule], 0)
        order = sorted(rules.RULES, key=lambda x: (-caught[x], rules.RULES.index(x)))
        best = (0, 0)
        for k in range(1, 7):
            hit = lambda x, k=k: any(x[f"f_{rule}"] >= cut[rule] for rule in order[:k])  # noqa: B023, E731
            if rules.upper_bound(share(1, True, hit), share(1, True, lambda x: True), rules.DELTA / 12) <= rules.RISK:
                best = max(best, (share(1, False, hit), -k))
        on = order[: -best[1]] if best[1] else []
        want |= {d: [x for x in rules.RULES if x in on and own[d][f"f_{x}"] >= cut[x]] for d in own}
    got = rules.judge(given, table).collect()
    assert {r["doc_id"]: r["rejected_by"] for r in got} == {d: ",".join(x) for d, x in want.items()}
    assert any(want.values()) and all(r["kept"] == (not r["base_failed"] and not want[r["doc_id"]]) for r in got)


def test_labelled_junk_is_rejected_and_clean_texts_stay(spark):
    r = random.Random(2)
    docs = [(i, words(r, 60, 9000), "en", "s", 0, 0, 0, "", "", "", 0) for i in range(2500)]
    junk = [(5000 + i, " ".join(w + "***" for w in words(r, 60, 9000).split()), "en", "s", 0, 0, 0, "", "", "", 0) for i in range(300)]
    labels = [(d[0], 1, 0) for d in docs[:2200]] + [(d[0], 0, 0) for d in junk[:150]] + [(1, 0, 0), (None, 1, 0), (3, None, 0)][1:]
    got = rules.judge(frame(spark, docs + junk), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    kept = {r["doc_id"] for r in got if r["kept"]}
    assert kept == {d[0] for d in docs}
