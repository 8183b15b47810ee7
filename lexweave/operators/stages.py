"""Selections, strata and late repairs of clean entries.

Clean entries have: id, status, method, reason, reading, notation, skk_key,
modern, okuri, kango, pos (struct), source (struct of what was read), ndl (the
second reader's struct or null), fixes.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from lexweave.functions import align, kana
from lexweave.functions.transcription import transcription_forms
from lexweave.operators import aligning, matching
from lexweave.operators import lexicon as lx
from lexweave.operators import resolve as rs
from lexweave.sources.lexicons import loose_key

VOICED = f"[{kana.VOICED}{kana.H_HALF}]"
FULL_REASONS = ("align-single-notation", "align-single-reading", "align-rendaku", "align-handakuten")
# Fixed value: the reason of a fix by vote, as stored tables have it.
VOTED = "三系統の OCR の多数決"


def _bare(c: Column) -> Column:
    return F.regexp_replace(c, "[-ー・]", "")


def readers_agree() -> Column:
    return F.coalesce(_bare(F.col("ndl.reading")) == _bare(F.col("source.reading")), F.lit(False))


def needs_rereading() -> Column:
    """Not excluded, and lacking agreement, a second reading, or the same one."""
    return (F.col("status") != "excluded") & (F.coalesce("reason", F.lit("")).startswith("align-") | ~readers_agree())


def rereading_targets(clean: DataFrame, full: bool = False) -> DataFrame:
    return clean.where(F.col("reason").isin(*FULL_REASONS) if full else needs_rereading())


def variant_targets(clean: DataFrame, head: DataFrame) -> DataFrame:
    """Entries with a head re-reading (id) that rest on alignment and have voiced kana."""
    doubtful = (F.col("method") == "align") | F.coalesce("reason", F.lit("")).rlike("^(align-|voicing)")
    return clean.where(F.coalesce(doubtful, F.lit(False)) & F.col("reading").rlike(VOICED)).join(head.select("id").distinct(), "id", "left_semi")


def read_head(lines: DataFrame) -> DataFrame:
    """(id, text, reading, notation) of re-read columns (id, y, text): lines from top to bottom as one; without a head the kana in front."""
    text = F.array_join(F.array_sort(F.collect_list(F.struct("y", "text")))["text"], "")
    x = lines.groupBy("id").agg(text.alias("text")).withColumn("h", kana.parse_head(F.col("text")))
    front = F.nullif(F.regexp_extract(F.regexp_replace("text", "\\s", ""), "^([ぁ-ゖゝゞー\\-－‐・]+)", 1), F.lit(""))
    return x.select("id", "text", F.when(F.col("h").isNotNull(), F.col("h.reading")).otherwise(front).alias("reading"), F.col("h.notation").alias("notation"))


def note_targets(clean: DataFrame) -> DataFrame:
    """(id, index): entries whose spelling and reading may carry the marginal note, and the place of its kana."""
    bare, pattern = kana.without_separators(F.col("reading")), "[ただ]いふ"
    at = F.regexp_instr(bare, F.lit(pattern))
    return clean.where((F.col("status") != "excluded") & F.col("notation").rlike("[大太]夫") & (at > 0)).select("id", at.alias("index"))


def apply_notes(clean: DataFrame, notes: DataFrame) -> DataFrame:
    """Entries with the note (id, yu): the key's and the modern form's ending as the note says, with a fix."""
    own = note_targets(clean).join(notes.where("yu").select("id").distinct(), "id", "left_semi").select("id", F.lit(True).alias("_note"))
    x = clean.join(own, "id", "left")
    first = lambda c: F.when(c.rlike("[ただ](いふ|ゆう|いう)"), F.concat(F.regexp_extract(c, "^(.*?[ただ])(いふ|ゆう|いう)(.*)$", 1), F.lit("ゆう"), F.regexp_extract(c, "^(.*?[ただ])(いふ|ゆう|いう)(.*)$", 3))).otherwise(c)
    key = first(F.col("skk_key"))
    now = F.coalesce("_note", F.lit(False)) & F.col("skk_key").isNotNull() & (key != F.col("skk_key"))
    fix = F.array(F.struct(F.lit("modern").alias("field"), F.col("skk_key").alias("from"), key.alias("to"), F.lit("note").alias("reason")))
    x = x.withColumn("fixes", F.when(now, F.concat(F.coalesce("fixes", F.array().cast("array<struct<field:string,from:string,to:string,reason:string>>")), fix)).otherwise(F.col("fixes")))
    return x.withColumn("modern", F.when(now, first(F.col("modern"))).otherwise(F.col("modern"))).withColumn("skk_key", F.when(now, key).otherwise(F.col("skk_key"))).select(*clean.columns)


def strata(in_no_lexicon: Column) -> dict[str, Column]:
    """Named, overlapping selections for review."""
    ok = F.col("status") == "accepted"
    by = lambda m: ok & (F.col("method") == m)
    return {
        "all": ok, "L": by("L"), "JMdict": by("JMdict"), "align-ndl-agree": by("align") & readers_agree(), "align-other": by("align") & ~readers_agree(), "dict-reading": by("dict-reading"),
        "voted": ok & F.exists(F.coalesce("fixes", F.array().cast("array<struct<field:string,from:string,to:string,reason:string>>")), lambda f: f["reason"] == VOTED), "unverified": F.col("status") == "unverified", "noL": in_no_lexicon,
    }


def in_strata(clean: DataFrame, named: dict[str, Column]) -> DataFrame:
    """(stratum, ...): a row for each stratum that an entry is in, in one pass."""
    own = F.array_compact(F.array(*[F.when(c, F.lit(k)) for k, c in named.items()]))
    return clean.withColumn("stratum", F.explode(own))


def with_separators(consensus: Column, sources: Column) -> Column:
    """The consensus as a source with the same text separates it, else with the first source's separators if it is as long."""
    plain = kana.without_separators
    same = F.get(F.filter(sources, lambda s: (plain(s) == consensus) & s.contains("-")), F.lit(0))
    first = F.get(sources, F.lit(0))
    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("k"))
    step = lambda a, c: F.when(c == "-", F.struct(F.concat(a["out"], c).alias("out"), a["k"].alias("k"))).otherwise(F.struct(F.concat(a["out"], F.substring(consensus, a["k"], F.lit(1))).alias("out"), (a["k"] + 1).alias("k")))
    laid = F.aggregate(F.split(first, ""), start, step)["out"]
    return F.coalesce(same, F.when(F.length(plain(first)) == F.length(consensus), laid), consensus)


def same_notation(a: Column, b: Column, variants: dict[str, str], new: dict[str, str]) -> Column:
    """Equal length, each character equal or a variant of the other's, after taking new forms. variants: a character to all its variants."""
    table = F.create_map(*[F.lit(x) for p in variants.items() for x in p]) if variants else F.create_map().cast("map<string,string>")
    x, y = (F.split(rs.new_form(c, new), "") for c in (a, b))
    ok = F.zip_with(x, y, lambda p, q: F.coalesce((p == q) | F.coalesce(F.try_element_at(table, p), F.lit("")).contains(q), F.lit(False)))
    return (F.size(x) == F.size(y)) & F.forall(ok, lambda v: v)


def with_liaison(entries: DataFrame, lex: rs.Lexicons) -> DataFrame:
    """Entries (id, notation, modern) with the liaison that the lexicon has for a part of the spelling: heads, tails, and inner parts that stand once."""
    parts = lx.part_words(entries.select(rs.new_form(F.col("notation"), lex.new).alias("w")).unionByName(entries.select(F.col("notation").alias("w"))).distinct(), "w")
    words = lex.base.where("section = 'nasi'").select(F.col("word").alias("part"), F.col("key").alias("r")).where(F.col("r").rlike("ん[なにぬねの]"))
    own = parts.join(words, "part").select("w", F.struct(F.when(F.col("place") == "mid", 1).otherwise(0).alias("late"), F.length("part").alias("len"), "place", "r").alias("p"))
    per = own.groupBy("w").agg(F.array_sort(F.collect_set("p")).alias("ps"))
    x = entries.join(per.withColumnRenamed("w", "notation"), "notation", "left")
    new = per.select(F.col("w").alias("_new"), F.col("ps").alias("_ps"))
    x = x.withColumn("_new", rs.new_form(F.col("notation"), lex.new)).join(new, "_new", "left")

    @F.pandas_udf("string")
    def put(modern: pd.Series, a: pd.Series, b: pd.Series) -> pd.Series:
        every = lambda *lists: sorted({(p["late"], p["len"], p["place"], p["r"]) for ps in lists if ps is not None for p in ps})
        return pd.Series([None if m is None else aligning.linked(m, every(p, q)) for m, p, q in zip(modern, a, b, strict=True)])

    return x.withColumn("modern", put("modern", "ps", "_ps")).drop("ps", "_ps", "_new")


def fix_ra(entries: DataFrame, lex: rs.Lexicons) -> DataFrame:
    """(id, modern, skk_key, method, reading): the first ra after an open kana that read as u gives a word of the lexicons.

    entries: id, reading, notation, category, conjugation, kango.
    """
    after = "[あかがさざただなはばぱまやらわえけげせぜてでねへべぺめれおこごそぞとどのほぼぽもよろゃょ]"
    places = F.filter(F.sequence(F.lit(2), F.greatest(F.length("reading"), F.lit(2))), lambda i: (F.substring(F.col("reading"), i, F.lit(1)) == "ら") & F.substring(F.col("reading"), i - 1, F.lit(1)).rlike(after))
    put = lambda i: F.concat(F.substring(F.col("reading"), F.lit(1), i - 1), F.lit("う"), F.substring(F.col("reading"), i + 1, F.length("reading")))
    options = entries.select("id", "notation", F.posexplode(F.transform(places, put)).alias("option", "reading"))
    return _known(entries, options, lex)


def _known(entries: DataFrame, options: DataFrame, lex: rs.Lexicons) -> DataFrame:
    """The first option that the lexicons have."""
    x = rs.expanded_options(entries, options, lex)
    tag = lambda df, m, r: df.withColumn("method", F.lit(m)).withColumn("rank", F.lit(r))
    hits = tag(rs.match_words(x, lex), "L", 0).unionByName(tag(rs.match_inflected(x, lex), "L", 0)).unionByName(tag(rs.match_dictionary(x, lex), "JMdict", 1))
    return matching.first_match(hits, ["id"], ["option", "rank", "variant", "step"], ["method", "modern", "skk_key", "okuri", "reading", "option"])


def resolve_voicing(entries: DataFrame, lex: rs.Lexicons) -> DataFrame:
    """Entries whose readers differ in voicing only: the one mix that the lexicons have, or a demotion.

    entries: id, reading, notation, category, conjugation, kango, method,
    sources (array of readings). Gives (id, verdict, reading, modern, skk_key,
    method); verdict: fixed, or voicing-ambiguous for entries that rest on
    alignment or a near reading and whose own reading the lexicons lack.
    """
    bare = kana.without_separators(F.col("reading"))
    same = F.filter(F.transform(F.filter("sources", lambda s: s.isNotNull()), kana.without_separators), lambda s: F.length(s) == F.length(bare))
    x = entries.withColumn("_mix", rs.voicing_combinations(F.concat(F.array(bare), same))).where(F.size("_mix") > 1)
    mixes = x.select("id", "notation", "reading", F.posexplode("_mix").alias("option", "mix"))
    options = mixes.select("id", "notation", "option", with_separators(F.col("mix"), F.array("reading")).alias("reading"))
    y = rs.expanded_options(x, options, lex)
    hits = rs.match_words(y, lex).withColumn("m", F.lit("L")).unionByName(rs.match_inflected(y, lex).withColumn("m", F.lit("L"))).unionByName(rs.match_dictionary(y, lex).withColumn("m", F.lit("JMdict")))
    best = matching.first_match(hits.withColumn("rank", F.when(F.col("m") == "L", 0).otherwise(1)), ["id", "option"], ["rank", "variant", "step"], ["m", "modern", "skk_key", "reading"])
    per = best.groupBy("id").agg(F.count("*").alias("n"), F.max(F.col("option") == 0).alias("own"), F.first(F.struct("m", "modern", "skk_key", "reading")).alias("one"))
    z = x.select("id", "method").join(per, "id", "left")
    own, fixed = F.coalesce("own", F.lit(False)), (F.col("n") == 1) & ~F.coalesce("own", F.lit(False))
    doubtful = ~own & F.col("method").isin("align", "dict-reading", "kanon")
    verdict = F.when(fixed, "fixed").when(doubtful, "voicing-ambiguous")
    part = lambda c: F.when(fixed, F.col(f"one.{c}"))
    return z.select("id", verdict.alias("verdict"), part("reading").alias("reading"), part("modern").alias("modern"), part("skk_key").alias("skk_key"), part("m").alias("method")).where("verdict IS NOT NULL")


def dzi_udf(readings: align.Readings):
    """(spellings, key) to struct(ok, key): whether the four-kana letters left in a key are decided, and the key."""
    strict, free = align.Aligner(readings, voicing=False), align.Aligner(readings)

    def one(spellings, key):
        left = 1 if len(spellings[0]) == 1 else 0
        fits = lambda a, k: any(a.fits(s, k, left) for s in spellings)
        plain = key.replace("ぢ", "じ").replace("づ", "ず")
        if fits(strict, plain) and not fits(strict, key):
            return {"ok": True, "key": plain}
        return {"ok": not fits(strict, plain) and fits(free, key), "key": key}

    @F.pandas_udf("struct<ok: boolean, key: string>")
    def dzi(spellings: pd.Series, key: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([one(list(s), k) if k is not None else {"ok": None, "key": None} for s, k in zip(spellings, key, strict=True)], columns=["ok", "key"])

    return dzi


def doubled_udf(readings: align.Readings):
    """(notation, key): whether each half of an even spelling fits the key alone."""
    a = align.Aligner(readings)

    @F.pandas_udf(BooleanType())
    def doubled(notation: pd.Series, key: pd.Series) -> pd.Series:
        return pd.Series([n is not None and k is not None and len(n) > 1 and len(n) % 2 == 0 and a.fits(n[: len(n) // 2], k) and a.fits(n[len(n) // 2 :], k) for n, k in zip(notation, key, strict=True)])

    return doubled


def split_doubled(entries: DataFrame, lex: rs.Lexicons) -> DataFrame:
    """(id, first, second) of spellings (id, notation, key) that put two in a row, unless a lexicon has the whole."""
    x = entries.where(doubled_udf(lex.readings)("notation", "key"))
    words = lex.base.where("section = 'nasi'").select("key", F.col("word").alias("_w"))
    if lex.forms is not None:
        words = words.unionByName(lex.forms.select(F.col("reading").alias("key"), F.col("skeleton").alias("_w")))
    known = x.withColumn("_w", F.explode(F.array_distinct(F.array("notation", rs.new_form(F.col("notation"), lex.new))))).join(words.distinct(), ["key", "_w"], "left_semi").select("id").distinct()
    half = F.length("notation") / 2
    return x.join(known, "id", "left_anti").select("id", F.substring("notation", F.lit(1), half.cast("int")).alias("first"), F.substring("notation", half.cast("int") + 1, F.length("notation")).alias("second"))


def in_word_list(entries: DataFrame, keys: DataFrame) -> DataFrame:
    """Entries (id, reading, kango, verb) of which some transcription is in the word list (key)."""
    x = entries.withColumn("key", F.explode(transcription_forms("reading", "kango", "verb"))).withColumn("key", loose_key(F.col("key")))
    return entries.join(x.join(keys, "key", "left_semi").select("id").distinct(), "id", "left_semi")


# Kana of like shapes that the word list may decide.
LIST_CONFUSABLE = ("うら", "きさ", "あのめ")


def repair_by_word_list(entries: DataFrame, keys: DataFrame, lex: rs.Lexicons) -> DataFrame:
    """(id, reading, modern, skk_key, method): the one repaired reading that the word list has and that also matches.

    entries: unverified ones with id, reading, notation, category, conjugation,
    kango. What the list already has stays; the caller rolls back repairs that
    fail agreement.
    """
    x = entries.where(F.col("notation").rlike("^[\\p{IsHan}々]+$") & (F.col("category") != "adjective")).withColumn("verb", F.col("category") == "verb")
    x = x.join(in_word_list(x.select("id", "reading", "kango", "verb"), keys).select("id"), "id", "left_anti")
    dashes = lambda c: F.length(c) - F.length(kana.without_separators(c))
    cand = x.select("id", "notation", "kango", "verb", F.col("reading").alias("_old"), F.posexplode(kana.repairs(F.col("reading"), LIST_CONFUSABLE)).alias("option", "reading"))
    cand = cand.where((F.length("reading") == F.length("_old")) & (dashes(F.col("reading")) == dashes(F.col("_old"))) & ~(F.endswith("_old", F.lit("さ")) & F.endswith("reading", F.lit("き"))) & (kana.unvoiced(F.col("reading")) != kana.unvoiced(F.col("_old"))))
    cand = cand.withColumn("_c", F.concat_ws("#", "id", "option"))
    listed = in_word_list(cand.select(F.col("_c").alias("id"), "reading", "kango", "verb"), keys).select(F.col("id").alias("_c"))
    options = cand.join(listed, "_c", "left_semi").select("id", "option", "reading", "notation", F.lit(False).alias("no_align"))
    # every repair counts for itself
    own = options.withColumn("_id", F.concat_ws("#", "id", "option"))
    per = own.select(F.col("_id").alias("id"), F.lit(0).alias("option"), "reading", "notation", "no_align")
    who = own.select(F.col("_id"), F.col("id").alias("_e")).join(x.select(F.col("id").alias("_e"), "category", "conjugation", "kango"), "_e")
    who = who.select(F.col("_id").alias("id"), "category", "conjugation", "kango", F.lit(False).alias("suspicious"), F.lit(False).alias("outlier"), F.lit(None).cast("string").alias("reading_b"))
    hits = rs.resolve(who, per, lex).withColumn("_e", F.regexp_extract("id", "^(.*)#[0-9]+$", 1))
    one = hits.groupBy("_e").agg(F.count("*").alias("n"), F.first(F.struct("reading", "modern", "skk_key", "okuri")).alias("h")).where("n = 1")
    return one.select(F.col("_e").alias("id"), "h.reading", "h.modern", "h.skk_key", "h.okuri", F.lit("nippo").alias("method"))


def fallback(entries: DataFrame) -> DataFrame:
    """Unresolved entries (id, reading, kango, category): the usual modern spelling and a key from it, or excluded without one."""
    modern = kana.modern_variants("reading", "kango")[0]
    x = entries.withColumn("modern", modern)
    stem, letter = F.substring("modern", F.lit(1), F.length("modern") - 1), F.get(kana.okuri_letters(F.substring("modern", -1, 1)), F.lit(0))
    key = F.when(~rs.inflects(F.col("category")), F.nullif("modern", F.lit(""))).when(F.length("modern") > 1, F.concat(stem, letter))
    x = x.withColumn("skk_key", key).withColumn("okuri", rs.inflects(F.col("category")))
    return x.withColumn("status", F.when(F.col("skk_key").isNull(), "excluded").otherwise("unverified")).withColumn("reason", F.when(F.col("skk_key").isNull(), "no-skk-key"))
