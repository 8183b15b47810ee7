"""Quality rules whose cutoffs keep false rejection under a stated risk.

A rule rejects a document whose feature reaches a cutoff. For each stratum
(language), one fold of the labelled documents picks the cutoff of each rule,
the most lenient one that catches nearly all the bad documents that any
admissible cutoff catches, and puts the rules in the order of what they catch.
The other fold then certifies how many of them, from the first on, may be on:
for each number of rules the exact (Clopper-Pearson) upper bound on the share
of good documents that they reject together must be at most RISK at level
DELTA divided by the number of rules and strata (Bonferroni). So with
probability 1 - DELTA the rules of no stratum together reject more than RISK
of its good documents.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexweave.llm import bytestext as bt
from lexweave.storage import materialize

RULES = ("symbols", "bangs", "upper", "dup_lines", "repeats", "word_length")
BINS = 64
RISK = 0.01
DELTA = 0.05
#: A cutoff must catch this share of the bad documents that the best one catches.
NEARLY = 0.98
SALTS = 32
BLOCK_BYTES = 4 << 20

_SYMBOL = np.array([c in b"#*$%&|<>" for c in range(256)])
_UPPER = np.array([65 <= c <= 90 for c in range(256)])
_LETTER = np.array([65 <= c <= 90 or 97 <= c <= 122 for c in range(256)])
_BANG = np.array([c == 0x21 for c in range(256)])
_START = np.array([c & 0xC0 != 0x80 for c in range(256)])

STATS = "doc_id long, lang string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, " + ", ".join(f"f_{r} int" for r in RULES)


def _again(h: np.ndarray) -> np.ndarray:
    """Which values stood before."""
    out = np.ones(len(h), bool)
    if len(h):
        out[np.unique(h, return_index=True)[1]] = False
    return out


def text_stats(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The contract's counts and the rules' features (bins 0 to BINS) of each row."""
    n = len(offsets) - 1
    per_byte = lambda mask: np.diff(np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])[offsets])
    ws, we, per = bt.word_bounds(data, offsets, bt.NONSPACE)
    n_words = np.diff(per)
    row = np.repeat(np.arange(n), n_words)
    word_chars = per_byte(bt.NONSPACE[data] & _START[data])
    n_symbols = per_byte(_SYMBOL[data])
    # lines: a text of k line feeds has k + 1
    feed = np.flatnonzero(data == 10)
    starts = np.sort(np.concatenate([offsets[:-1], feed + 1]), kind="stable")
    ends = np.sort(np.concatenate([offsets[1:], feed]), kind="stable")
    # a feed at a text's end gives an empty line that sorts with the next text's first: keep lines with words only
    with_word = np.searchsorted(ws, ends) > np.searchsorted(ws, starts)
    ls, le = starts[with_word], ends[with_word]
    line_row = np.searchsorted(offsets, ls, "right") - 1
    salt = line_row.astype(np.uint64) * bt.BASE
    again = _again(bt.mix(bt.span_hash(data, ls, le) ^ salt))
    n_lines = np.bincount(line_row, minlength=n)
    n_dup = np.bincount(line_row[again], minlength=n)
    # words in windows of three that come twice
    h = bt.chain_hash(bt.span_hash(data, ws, we), 3)
    whole = row[: len(h)] == row[2:] if len(h) else np.zeros(0, bool)
    at = np.flatnonzero(whole)
    key = bt.mix(h[at] ^ (row[at].astype(np.uint64) * bt.BASE))
    _, back, times = np.unique(key, return_inverse=True, return_counts=True)
    at = at[times[back] > 1] if len(at) else at
    hit = np.zeros(len(ws), bool)
    for k in range(3):
        hit[at + k] = True
    n_repeat = np.bincount(row[hit], minlength=n)
    share = lambda a, b: np.clip(np.floor(BINS * a / np.maximum(b, 1)), 0, BINS).astype(np.int32)
    return {
        "n_words": n_words, "word_chars": word_chars, "n_symbols": n_symbols, "n_dup_lines": n_dup, "n_repeat_words": n_repeat,
        "f_symbols": share(n_symbols * 4, word_chars), "f_bangs": share(per_byte(_BANG[data]), n_words), "f_upper": share(per_byte(_UPPER[data]), per_byte(_LETTER[data])),
        "f_dup_lines": share(n_dup, n_lines), "f_repeats": share(n_repeat, n_words), "f_word_length": share(word_chars, n_words * 40),
    }


def stats(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            data, offsets = bt.utf8(whole.column("text"))
            for lo, hi in bt.cuts(offsets, BLOCK_BYTES):
                x = text_stats(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
                columns = [whole.column("doc_id").slice(lo, hi - lo), whole.column("lang").slice(lo, hi - lo)]
                columns += [pa.array(v, pa.int32() if k.startswith("f_") else pa.int64()) for k, v in x.items()]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "lang", *x])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", "text").mapInArrow(run, STATS)


def upper_bound(k: int, n: int, level: float) -> float:
    """Exact binomial upper bound on a rate of which k of n were seen: the p with P(X <= k) = level."""
    if n == 0 or k >= n:
        return 1.0
    logs = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) for i in range(k + 1)]
    lo, hi = k / n, 1.0
    for _ in range(60):
        p = (lo + hi) / 2
        if sum(math.exp(c + i * math.log(p) + (n - i) * math.log1p(-p)) for i, c in enumerate(logs)) > level:
            lo = p
        else:
            hi = p
    return hi


def choose(counts: pd.DataFrame, risk: float = RISK) -> dict[str, tuple[int, int]]:
    """Cutoff of each rule (reject from this bin on; BINS + 1: off) and its place in the order. counts: rule, quality, bin, n of the choosing fold."""
    cuts, caught = {}, {}
    for rule in RULES:
        own = counts[counts["rule"] == rule]
        table = np.zeros((2, BINS + 2), np.int64)
        for q, b, n in zip(own["quality"], own["bin"], own["n"], strict=True):
            table[q, b] += n
        bad, good = table[:, ::-1].cumsum(1)[:, ::-1]  # rejected by each cutoff
        admissible = np.flatnonzero(good[1:] / max(1, table[1].sum()) <= risk / 2) + 1
        best = bad[admissible].max(initial=0)
        cuts[rule] = int(admissible[bad[admissible] >= NEARLY * best].max()) if best > 0 else BINS + 1
        caught[rule] = int(bad[cuts[rule]])
    order = sorted(RULES, key=lambda r: (-caught[r], RULES.index(r)))
    return {r: (cuts[r], order.index(r)) for r in RULES}


def certified(good: np.ndarray, bad: np.ndarray, tests: int, risk: float = RISK, delta: float = DELTA) -> int:
    """How many rules may be on: of the numbers whose bound is at most risk the one that catches most bad documents.

    good, bad: documents of the certifying fold by the first rule, in order,
    that rejects them; those that none rejects come last.
    """
    rejected, caught = np.cumsum(good), np.cumsum(bad)
    sure = [k for k in range(1, len(good)) if upper_bound(int(rejected[k - 1]), int(rejected[-1]), delta / tests) <= risk]
    return max(sure, key=lambda k: (int(caught[k - 1]), -k), default=0)


def cutoffs(rows: DataFrame, labels: DataFrame, risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """(stratum, c_<rule>...): one row for each stratum that has labels.

    rows: the written statistics. A document with several labels takes the
    smallest; null labels are left out. A null language is a stratum.
    """
    marks = labels.where("doc_id IS NOT NULL AND quality IN (0, 1)").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").cast("int").alias("quality"))
    fold = F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(2)).cast("int")
    # distinct feature rows with their counts: what both folds need of the labelled documents
    seen = rows.join(marks, "doc_id").groupBy("stratum", "quality", fold.alias("fold"), *(f"f_{r}" for r in RULES)).agg(F.count("*").alias("n"))
    seen = materialize(seen, "rulecounts")
    strata = max(1, seen.select("stratum").distinct().count())
    long = seen.where("fold = 0").select("stratum", "quality", "n", F.explode(F.create_map(*[x for r in RULES for x in (F.lit(r), F.col(f"f_{r}"))])).alias("rule", "bin"))
    counts = long.groupBy("stratum", "rule", "quality", "bin").agg(F.sum("n").alias("n"))

    def pick(own: pd.DataFrame) -> pd.DataFrame:
        cut = choose(own, risk)
        return pd.DataFrame([[own["stratum"].iloc[0], *(c for c, _ in cut.values()), *(p for _, p in cut.values())]], columns=["stratum", *(f"c_{r}" for r in cut), *(f"p_{r}" for r in cut)])

    # a stratum has at most rules x labels x bins counts
    columns = [*(f"c_{r}" for r in RULES), *(f"p_{r}" for r in RULES)]
    picked = materialize(counts.groupBy("stratum").applyInPandas(pick, "stratum string, " + ", ".join(f"{c} int" for c in columns)), "rulecuts")
    first = F.least(*(F.when(F.col(f"f_{r}") >= F.col(f"c_{r}"), F.col(f"p_{r}")).otherwise(len(RULES)) for r in RULES))
    judged = _by_stratum(seen.where("fold = 1"), picked).groupBy("stratum", "quality", first.alias("first")).agg(F.sum("n").alias("n"))

    def certify(own: pd.DataFrame) -> pd.DataFrame:
        table = np.zeros((2, len(RULES) + 1), np.int64)
        for q, k, n in zip(own["quality"], own["first"], own["n"], strict=True):
            table[q, k] += n
        return pd.DataFrame([[own["stratum"].iloc[0], certified(table[1], table[0], strata * len(RULES), risk, delta)]], columns=["stratum", "n_on"])

    on = judged.groupBy("stratum").applyInPandas(certify, "stratum string, n_on int")
    cut = lambda r: F.when(F.col(f"p_{r}") < F.coalesce("n_on", F.lit(0)), F.col(f"c_{r}")).otherwise(BINS + 1)
    return picked.join(on, "stratum", "left").select("stratum", *(cut(r).alias(f"c_{r}") for r in RULES))


def _by_stratum(rows: DataFrame, cut: DataFrame) -> DataFrame:
    """Rows with the columns that `cut` has for their stratum, if any. One language may hold most rows: its columns are repeated for each salt."""
    salted = cut.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salt = F.pmod(F.xxhash64(*(f"f_{r}" for r in RULES), F.col("stratum"), *([F.col("doc_id")] if "doc_id" in rows.columns else [])), F.lit(SALTS)).cast("int")
    return rows.withColumn("_salt", salt).join(salted, ["stratum", "_salt"], "left").drop("_salt")


def judge(docs: DataFrame, labels: DataFrame, risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """One row for each document: doc_id, the base counts, base_failed, kept, rejected_by.

    A null or empty text has no words and fails the base. A stratum without
    labels has no rules. Other columns are ignored.
    """
    stratum = F.coalesce(F.concat(F.lit("s"), F.col("lang")), F.lit("n"))
    rows = materialize(stats(docs).withColumn("stratum", stratum), "rulestats")
    joined = _by_stratum(rows, cutoffs(rows, labels, risk, delta))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    by = F.array_compact(F.array(*(F.when(F.col(f"f_{r}") >= F.col(f"c_{r}"), F.lit(r)) for r in RULES)))
    return joined.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & (F.size(by) == 0)).alias("kept"), F.array_join(by, ",").alias("rejected_by"),
    )


def op3_risk_rules(spark, sf_dir: str) -> DataFrame:
    return judge(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
