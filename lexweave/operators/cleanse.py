"""A volume's candidates to clean entries: the steps of the engine in order.

Normalise and link the readers; check the order; vote; list what an entry may
be (its options); resolve them; gate weak repairs; split spellings put in a
row; settle voicing; ask for agreement of readers; give what is left a key.
Every step is a join or an expression over all entries of all volumes, and
what later steps read several times is written once.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from lexweave.functions import align, kana
from lexweave.functions import text as t
from lexweave.functions.sino import refuted_udf
from lexweave.operators import aligning, layout, matching, order
from lexweave.operators import resolve as rs
from lexweave.operators import stages as st
from lexweave.storage import materialize

FIX = "struct<field: string, from: string, to: string, reason: string>"
OPTION = "struct<reading: string, notation: string, why: string>"
#: Word classes that a conversion dictionary doesn't need.
LEFT_OUT = ("particle", "auxiliary")


def _fix(field: str, old: Column, new: Column, why: Column | str) -> Column:
    why = F.lit(why) if isinstance(why, str) else why
    return F.struct(F.lit(field).alias("field"), old.alias("from"), new.alias("to"), why.alias("reason")).cast(FIX)


def _when_array(test: Column, *items: Column, kind: str) -> Column:
    empty = F.array().cast(f"array<{kind}>")
    return F.when(F.coalesce(test, F.lit(False)), F.array(*items).cast(f"array<{kind}>")).otherwise(empty)


def dashed(reading: Column) -> Column:
    """A reader's reading with long marks as the separators they are misread from."""
    return kana.normalize_reading(F.translate(reading, "ー", "-"))


def linked_entries(candidates: DataFrame, second: DataFrame, reread: DataFrame, full: DataFrame) -> DataFrame:
    """Normalised candidates with what each reader has for them.

    candidates: id, pid, frame, seq, bbox, reading, notation, pos, line, kango.
    second: pid, frame, x, y, reading, notation, ord. reread and full (the head,
    and the whole column, read again): id, reading, notation.
    """
    x = layout.link_readers(candidates, second)
    for df, name in ((reread, "c"), (full, "d")):
        # one re-reading of an id: the least, should there be several
        one = df.groupBy("id").agg(F.min(F.struct("reading", "notation")).alias(f"_{name}"))
        x = x.join(one, "id", "left")
    own = kana.normalize_notation(F.col("notation"))
    readers = {"b": "ndl", "c": "_c", "d": "_d"}
    x = x.select(
        "id", "pid", "frame", "seq", "bbox", "kango", "ndl", F.struct("reading", "notation", "pos", "line").alias("source"), own["notation"].alias("notation"), own["bad"].alias("bad"), kana.normalize_pos(F.col("pos")).alias("pos"),
        F.when(F.coalesce(own["notation"].rlike(f"[{kana.HAN}]"), F.lit(False)), dashed(F.col("reading"))).otherwise(kana.normalize_reading(F.col("reading"))).alias("reading"),
        *(F.nullif(dashed(F.col(f"{c}.reading")), F.lit("")).alias(f"reading_{k}") for k, c in readers.items()),
        *(kana.normalize_notation(F.col(f"{c}.notation")).alias(f"notation_{k}") for k, c in readers.items()),
    )
    # the second reader keeps separators better
    b, bare = kana.normalize_reading(F.col("ndl.reading")), kana.without_separators
    better = (bare(b) == bare(F.col("reading"))) & (b != F.col("reading"))
    x = x.withColumn("fixes", _when_array(better, _fix("reading", F.col("reading"), b, "separators of the second reader"), kind=FIX)).withColumn("reading", F.when(F.coalesce(better, F.lit(False)), b).otherwise(F.col("reading")))
    agree = F.coalesce((bare(b) == bare(F.col("reading"))) & F.col("ndl.notation").eqNullSafe(F.col("notation")), F.lit(False))
    return x.withColumn("agree", F.when(F.col("ndl").isNotNull(), agree))


def ordered(entries: DataFrame) -> DataFrame:
    """Add `outlier`, `lo` and `hi` of the reading order of each volume."""
    x = entries.withColumn("_key", kana.collation_key(F.col("reading")))
    return order.bounds(order.outliers(x, ["pid"], ["seq"], "_key"), ["pid"], ["seq"], "_key").drop("_key")


def voted(entries: DataFrame) -> DataFrame:
    """Add `vote` (none, agree, override, conflict) of page, second reader and re-reading, and take the winner."""
    bare = kana.without_separators
    winner = t.positional_vote(F.array("reading", "reading_b", "reading_c"))
    vote = F.when(F.col("reading_c").isNull(), "none").when(winner == bare(F.col("reading")), "agree").when(winner.isNotNull(), "override").otherwise("conflict")
    new = st.with_separators(winner, F.array_compact(F.array("reading_c", "reading_b", "reading")))
    x = entries.withColumn("vote", vote).withColumn("_new", F.when(F.col("vote") == "override", new))
    x = x.withColumn("fixes", F.concat("fixes", _when_array(F.col("_new").isNotNull(), _fix("reading", F.col("reading"), F.col("_new"), st.VOTED), kind=FIX)))
    return x.withColumn("reading", F.coalesce("_new", "reading")).drop("_new")


def in_order(reading: Column, lo: Column, hi: Column) -> Column:
    """Readings with one of the first two kana replaced by one of like shape that fall between the neighbours."""
    table = F.create_map(*[F.lit(x) for k, v in kana.confusable_map().items() if v for x in (k, v)])

    def at(i: int) -> Column:
        near = F.filter(F.split(F.coalesce(F.try_element_at(table, F.substring(reading, i, 1)), F.lit("")), ""), lambda c: F.length(c) > 0)
        return F.transform(near, lambda c: F.concat(F.substring(reading, 1, i - 1), c, F.substring(reading, F.lit(i + 1), F.length(reading))))

    return F.filter(F.concat(at(1), at(2)), lambda r: kana.collation_key(r).between(lo, hi))


def with_dropped_head(reading: Column, lo: Column, hi: Column) -> Column:
    """Readings with a first kana put before them, plain or voiced, that a neighbour begins with."""
    plain = F.array_distinct(F.filter(F.array(F.substring(lo, 1, 1), F.substring(hi, 1, 1)), lambda c: (F.length(c) > 0) & (c != "￿")))
    voiced = F.create_map(*[F.lit(x) for p in zip(kana.PLAIN, kana.VOICED, strict=True) for x in p])
    heads = F.array_distinct(F.flatten(F.transform(plain, lambda c: F.array(kana.unvoiced(c), F.coalesce(F.try_element_at(voiced, kana.unvoiced(c)), kana.unvoiced(c))))))
    rest = F.regexp_replace(reading, "^[-ー]+", "")
    return F.filter(F.transform(heads, lambda h: F.concat(h, F.lit("-"), rest)), lambda r: kana.collation_key(r).between(lo, hi))


def options_of(entries: DataFrame) -> DataFrame:
    """(id, option, reading, notation, why, no_align): what an entry may be, in the order it is tried."""
    option = lambda r, n, why: F.struct(r.alias("reading"), n.alias("notation"), F.lit(why).alias("why")).cast(OPTION)
    some = lambda test, *o: _when_array(test, *o, kind=OPTION)
    each = lambda rs_, why: F.transform(rs_, lambda r: F.struct(r.alias("reading"), F.col("notation").alias("notation"), F.lit(why).alias("why")).cast(OPTION))
    r, n, bare = F.col("reading"), F.col("notation"), kana.without_separators
    nb, nc, nd = (F.col(f"notation_{k}.notation") for k in "bcd")
    own = F.concat(some(F.col("vote") == "conflict", option(F.col("reading_c"), n, "re-reading")), F.array(option(r, n, "page")))
    both = F.coalesce(~F.col("notation_b.bad") & ((nb == nc) | (nb == nd)) & (nb != n), F.lit(False))
    first = F.when(both, F.transform(own, lambda o: F.struct(o["reading"].alias("reading"), nb.alias("notation"), F.lit("two readers' spelling").alias("why")).cast(OPTION))).otherwise(F.array().cast(f"array<{OPTION}>"))
    differs = F.col("ndl").isNotNull() & ~F.coalesce("agree", F.lit(False))
    dropped = F.coalesce(F.col("source.reading").rlike("^[-ー]"), F.lit(False))
    every = F.concat(
        first, own,
        some(~F.col("kango") & n.startswith("一") & (F.length(n) > 1), option(r, F.substring(n, F.lit(2), F.length(n)), "mark read as one")),
        some(F.col("kango") & r.rlike("^(い|ひと)"), option(r, F.concat(F.lit("一"), n), "one read as mark")),
        some(differs & (F.col("vote") == "none") & (bare(F.col("reading_b")) != bare(r)), option(F.col("reading_b"), n, "second reading")),
        some(differs & nb.isNotNull() & ~F.col("notation_b.bad") & (nb != n), option(r, nb, "second spelling")),
        F.when(dropped, each(with_dropped_head(r, F.col("lo"), F.col("hi")), "dropped head")).otherwise(F.array().cast(f"array<{OPTION}>")),
        F.when(F.col("outlier") & ~dropped, each(in_order(r, F.col("lo"), F.col("hi")), "order")).otherwise(F.array().cast(f"array<{OPTION}>")),
    )
    return entries.select("id", F.posexplode(every).alias("option", "o")).select("id", "option", "o.*", F.lit(False).alias("no_align"))


def full_options(entries: DataFrame) -> DataFrame:
    """(id, option, reading, notation): what only the whole column's re-reading has, tried where nothing else is sure."""
    r, n, bare = F.col("reading_d"), F.col("notation_d.notation"), kana.without_separators
    spelling = F.when(~F.col("notation_d.bad") & (n != F.col("notation")), n)
    reading = F.when((bare(r) != bare(F.col("reading"))) & (F.length(bare(r)) == F.length(bare(F.col("reading")))), r)
    pair = lambda a, b: F.struct(a.alias("reading"), b.alias("notation"))
    every = F.array(F.when(spelling.isNotNull(), pair(F.col("reading"), spelling)), F.when(reading.isNotNull(), pair(reading, F.col("notation"))), F.when(spelling.isNotNull() & reading.isNotNull(), pair(reading, spelling)))
    return entries.select("id", F.posexplode(F.array_compact(every)).alias("option", "o")).select("id", "option", "o.*", F.lit(False).alias("no_align"))


def matches_any(entries: DataFrame, options: DataFrame, lex: rs.Lexicons) -> DataFrame:
    """(id, skk_key): the first option that a lexicon has or that can be aligned."""
    x = rs.expanded_options(entries, options, lex)
    keep = ["skk_key"]
    tag = lambda df, rank: df.withColumn("rank", F.lit(rank))
    hits = tag(rs.match_words(x, lex), 0).unionByName(tag(rs.match_inflected(x, lex), 0)).unionByName(tag(rs.match_dictionary(x, lex), 1)).unionByName(tag(rs.match_align(entries, options, lex), 2))
    return matching.first_match(hits, ["id"], ["option", "rank", "variant", "step"], keep)


@F.pandas_udf(ArrayType(StringType()))
def cut_into(rest: pd.Series, pieces: pd.Series) -> pd.Series:
    """A string cut into given pieces, long ones first; null if it can't be."""

    def one(s: str, own: set[str]) -> list[str] | None:
        cut: list[list[str] | None] = [None] * len(s) + [[]]
        for i in range(len(s) - 1, -1, -1):
            cut[i] = next(([s[i:j], *cut[j]] for j in range(len(s), i, -1) if s[i:j] in own and cut[j] is not None), None)
        return cut[0]

    return pd.Series([None if s is None else one(s, set(p) if p is not None else set()) for s, p in zip(rest, pieces, strict=True)])


def split_spellings(resolved: DataFrame, entries: DataFrame, lex: rs.Lexicons) -> DataFrame:
    """resolved with alt_notations (the other spellings put in a row with the one taken) and split_failed.

    resolved: id, skk_key, notation, page_notation. A spelling that lost characters is a part
    of several put in a row: what is left must be cut into spellings of the same key.
    """
    whole, own = F.col("page_notation"), F.col("notation")
    rest = F.when(F.startswith(whole, own), F.substring(whole, F.length(own) + 1, F.length(whole))).when(F.endswith(whole, own), F.substring(whole, F.lit(1), F.length(whole) - F.length(own)))
    shorter = (F.length(own) < F.length(whole)) & (whole != F.concat(F.lit("一"), own)) & ~F.coalesce(F.endswith(whole, own) & rest.rlike("^[一二七]$"), F.lit(False))
    x = resolved.withColumn("_rest", F.when(shorter, F.coalesce(rest, F.lit(""))))
    open_ = x.where(F.col("_rest").rlike(f"[{kana.HAN}]"))
    n = F.length("_rest")
    parts = F.array_distinct(F.flatten(F.transform(F.sequence(F.lit(1), n), lambda a: F.transform(F.sequence(a, n), lambda b: F.substring("_rest", a, b - a + 1)))))
    pieces = materialize(open_.select("id", "skk_key", "_rest").join(entries.select("id", "reading", "category", "conjugation", "kango"), "id").select("id", "skk_key", "reading", "category", "conjugation", "kango", F.explode(parts).alias("notation")), "pieces")
    if not pieces.limit(1).count():
        return x.withColumn("alt_notations", F.lit(None).cast("array<string>")).withColumn("split_failed", F.col("_rest").isNotNull()).drop("_rest")
    pieces = pieces.withColumn("_id", F.concat_ws("#", "id", "notation"))
    who = pieces.select(F.col("_id").alias("id"), "category", "conjugation", "kango", F.lit(False).alias("outlier"))
    what = pieces.select(F.col("_id").alias("id"), F.lit(0).alias("option"), "reading", "notation", F.lit(False).alias("no_align"))
    hits = matches_any(who, what, lex).select(F.col("id").alias("_id"), F.col("skk_key").alias("_key"))
    fit = pieces.join(hits, "_id").where(F.col("_key") == F.col("skk_key")).groupBy("id").agg(F.collect_set("notation").alias("_pieces"))
    x = x.join(fit, "id", "left").withColumn("_cut", cut_into("_rest", "_pieces"))
    failed = F.col("_rest").isNotNull() & F.col("_cut").isNull()
    return x.withColumn("alt_notations", F.when(F.size("_cut") > 0, F.col("_cut"))).withColumn("split_failed", failed).drop("_rest", "_pieces", "_cut")


def plain_fits_udf(readings: align.Readings):
    """(spellings, modern, okuri, verb) to struct(fits_plain, swap_fits): without voicing, and with b and p changed."""
    swap = str.maketrans("ばびぶべぼぱぴぷぺぽ", "ぱぴぷぺぽばびぶべぼ")
    tables = {(v, k): align.Aligner(readings, voicing=v, last_kun=k) for v in (False, True) for k in (False, True)}

    def one(forms: list[str], variants: list[str], okuri: bool, verb: bool) -> tuple[bool, bool]:
        left = 1 if len(forms[0]) == 1 and not okuri else 0
        cut = lambda v: v[:-1] if okuri else v
        fits = lambda v, voicing: any(tables[voicing, k].fits(f, cut(v), left) for f in forms for k in ((False, True) if okuri and verb else (False,)))
        changed = [v[:i] + v[i].translate(swap) + v[i + 1 :] for v in variants for i in range(len(v)) if v[i].translate(swap) != v[i]]
        return any(fits(v, False) for v in variants), any(fits(v, True) for v in changed)

    @F.pandas_udf("struct<fits_plain: boolean, swap_fits: boolean>")
    def plain(forms: pd.Series, variants: pd.Series, okuri: pd.Series, verb: pd.Series) -> pd.DataFrame:
        rows = [one(list(f), list(v), bool(o), bool(k)) if f is not None and v is not None else (None, None) for f, v, o, k in zip(forms, variants, okuri, verb, strict=True)]
        return pd.DataFrame(rows, columns=["fits_plain", "swap_fits"])

    return plain


def agreed(x: DataFrame, lex: rs.Lexicons, variants: dict[str, str]) -> DataFrame:
    """Aligned entries with `reason` (see resolve.agreement) and the key that is left after deciding its four-kana letters."""
    forms = aligning.spellings(F.col("notation"), lex.new)
    same = lambda n: F.when(n.isNotNull(), st.same_notation(n, F.col("notation"), variants, lex.new))
    notations = [kana.normalize_notation(F.col("source.notation"))["notation"], *(F.col(f"notation_{k}.notation") for k in "bcd")]
    from_full = F.col("from_full")
    notations[3], last = F.when(~from_full, notations[3]), F.when(~from_full, F.col("reading_d"))
    page = dashed(F.col("source.reading"))
    y = x.withColumn("_p", plain_fits_udf(lex.readings)(forms, kana.modern_variants("reading", "kango"), "okuri", F.col("category") == "verb"))
    y = y.withColumn("_dzi", F.when(F.coalesce("skk_key", F.lit("")).rlike("[ぢづ]"), st.dzi_udf(lex.readings)(forms, "skk_key")))
    refuted = refuted_udf(lex.sino, lex.readings) if lex.sino is not None else None
    others = F.lit(False)
    if refuted is not None:
        y = y.withColumn("_r", F.array(*(refuted("notation", r) for r in (page, F.col("reading_b"), F.col("reading_c"), last))))
        bare = [F.regexp_replace(r, rs.BARE, "") for r in (page, F.col("reading_b"), F.col("reading_c"), last)]
        target = kana.without_separators(F.col("reading"))
        apart = [F.coalesce(b != target, F.lit(False)) for b in bare]
        others = apart[0] | apart[1] | apart[2] | apart[3]
        for i, a in enumerate(apart):
            others = others & (~a | F.coalesce(F.col("_r")[i], F.lit(True)))
    evidence = y.select(
        "*", kana.without_separators(F.col("reading")).alias("target"), F.array(page, "reading_b", "reading_c", last).alias("readings"), F.array(*notations).alias("notations"), F.array(*(same(n) for n in notations)).alias("same"),
        F.coalesce("_p.fits_plain", F.lit(False)).alias("fits_plain"), F.coalesce("_p.swap_fits", F.lit(False)).alias("swap_fits"), F.coalesce("_dzi.ok", F.lit(False)).alias("dzi_ok"), F.lit(0).alias("anomalies"), others.alias("others_refuted"),
        (refuted(F.col("notation_b.notation"), "reading") if refuted is not None else F.lit(False)).alias("second_refuted"), F.lit(False).alias("skip_reading"),
    )
    out = rs.agreement(evidence)
    decided = F.col("reason").isNull() & F.col("_dzi.key").isNotNull()
    return out.withColumn("modern", F.when(decided & (F.col("_dzi.key") != F.col("skk_key")), F.col("_dzi.key")).otherwise(F.col("modern"))).withColumn("skk_key", F.when(decided, F.col("_dzi.key")).otherwise(F.col("skk_key")))


def cleanse(candidates: DataFrame, second: DataFrame, reread: DataFrame, full: DataFrame, lex: rs.Lexicons, variants: dict[str, str] | None = None) -> DataFrame:
    """Clean entries: id, pid, seq, status, method, reason, reading, notation, shinjitai, modern, skk_key, okuri, kango, pos, source, ndl, alt_notations, fixes.

    See `linked_entries` for the inputs; variants: a character to all its
    variants. Empty second, reread and full tables leave their steps out. An
    entry without a spelling, with a bad one, or of a class that dictionaries
    don't need is excluded.
    """
    x = voted(ordered(linked_entries(candidates, second, reread, full)))
    x = x.select("*", F.col("pos.category").alias("category"), F.col("pos.conjugation").alias("conjugation"))
    excluded = F.when(F.col("bad"), "bad-notation").when(F.col("category").isin(*LEFT_OUT), F.concat(F.lit("pos-"), "category"))
    x = x.withColumn("excluded", F.when(F.col("notation").isNull() & ~F.col("bad"), "no-notation").otherwise(excluded))
    x = x.withColumn("suspicious", F.col("outlier") | F.coalesce(~F.col("agree"), F.lit(False)))
    # a reading that readers agree on may be aligned, whatever its place
    x = materialize(x.withColumn("outlier", F.col("outlier") & ~F.col("vote").isin("agree", "override")), "entries")
    open_ = x.where("excluded IS NULL")
    options = materialize(options_of(ordered(open_.drop("lo", "hi", "outlier")).drop("outlier").join(x.select("id", "outlier"), "id")), "options")
    who = ["category", "conjugation", "kango", "suspicious", "outlier", "reading_b"]
    hits = materialize(rs.resolve(open_.select("id", *who), options.drop("why"), lex), "hits")
    sure = ("L", "JMdict", "dict-reading")
    # whole-column re-readings where nothing is sure, each tried by itself
    tried = materialize(full_options(open_.join(hits.where(F.col("method").isin(*sure)).select("id"), "id", "left_anti")), "fulls")
    if tried.limit(1).count():
        own = tried.withColumn("_id", F.concat_ws("#", "id", "option"))
        alone = own.select("_id", "id").join(open_.select("id", *who), "id").drop("id").withColumnRenamed("_id", "id")
        more = rs.resolve(alone, own.select(F.col("_id").alias("id"), F.lit(0).alias("option"), "reading", "notation", "no_align"), lex)
        more = more.withColumn("_k", F.regexp_extract("id", "#([0-9]+)$", 1).cast("int")).withColumn("id", F.regexp_replace("id", "#[0-9]+$", ""))
        more = more.join(hits.select("id", F.lit(True).alias("_had")), "id", "left").where(F.col("_had").isNull() | F.col("method").isin("L", "JMdict"))
        best = more.groupBy("id").agg(F.min_by(F.struct("method", *rs.HIT), "_k").alias("_m"))
        taken = best.select("id", "_m.*", F.lit(0).alias("option"), F.lit(True).alias("from_full"))
        hits = materialize(hits.join(best.select("id"), "id", "left_anti").withColumn("from_full", F.lit(False)).unionByName(taken), "hits")
    else:
        hits = hits.withColumn("from_full", F.lit(False))
    # gates: a near reading needs a reader that has it; a near spelling stays a suggestion
    near = hits.where("method = 'dict-reading'").join(x.select("id", "reading_b", "reading_c", "kango"), "id")
    has = lambda r: F.coalesce(F.array_contains(kana.modern_variants(r, "kango"), F.col("modern")), F.lit(False))
    confirmed = near.where(has("reading_b") | has("reading_c")).select("id")
    passed = hits.where("method NOT IN ('dict-reading', 'L-notation')").unionByName(hits.where("method = 'dict-reading'").join(confirmed, "id", "left_semi"))
    passed = materialize(split_spellings(passed.join(x.select("id", F.col("notation").alias("page_notation")), "id"), open_, lex), "passed")
    good = passed.where("NOT split_failed").select("id", "method", "modern", "skk_key", "okuri", F.col("notation").alias("_n"), F.col("reading").alias("_r"), "alt_notations", "from_full")
    y = open_.join(good, "id")
    changed = F.concat("fixes", _when_array(F.col("_r") != F.col("reading"), _fix("reading", F.col("reading"), F.col("_r"), F.col("method")), kind=FIX), _when_array(F.col("_n") != F.col("notation"), _fix("notation", F.col("notation"), F.col("_n"), F.col("method")), kind=FIX))
    y = materialize(y.withColumn("fixes", changed).withColumn("reading", F.col("_r")).withColumn("notation", F.col("_n")).drop("_r", "_n"), "resolved")
    # voicing that readers differ in
    sources = F.array(F.translate("source.reading", "ー", "-"), F.col("reading_b"), F.col("reading_c"))
    told = materialize(st.resolve_voicing(y.withColumn("sources", sources), lex), "voicing").select("id", "verdict", F.struct("reading", "modern", "skk_key", "method").alias("_v"))
    y = y.join(told, "id", "left")
    fixed = F.coalesce(F.col("verdict") == "fixed", F.lit(False))
    y = y.withColumn("fixes", F.concat("fixes", _when_array(fixed, _fix("reading", F.col("reading"), F.col("_v.reading"), "voicing"), kind=FIX)))
    y = y.select(*(c for c in y.columns if c not in ("reading", "modern", "skk_key", "method", "_v")), *(F.when(fixed, F.col(f"_v.{c}")).otherwise(F.col(c)).alias(c) for c in ("reading", "modern", "skk_key", "method")))
    y = materialize(y, "voiced")
    # an u read as ra, where the lexicons have it
    ra = st.fix_ra(y.where("method = 'align' AND verdict IS NULL"), lex).select("id", F.struct("reading", "modern", "skk_key", "method").alias("_u"))
    y = y.join(ra, "id", "left")
    y = y.select(*(c for c in y.columns if c not in ("reading", "modern", "skk_key", "method", "_u")), *(F.coalesce(F.col(f"_u.{c}"), F.col(c)).alias(c) for c in ("reading", "modern", "skk_key", "method")))
    y = materialize(y, "repaired")
    weak = F.col("method").isin("align", "kanon") & F.col("verdict").isNull()
    columns = ["id", "reading", "notation", "modern", "skk_key", "okuri", "method", "reason", "fixes", "alt_notations"]
    tested = agreed(y.where(weak), lex, variants or {}).select(*columns)
    others = y.where(~weak).withColumn("reason", F.col("verdict")).withColumn("reason", F.when(F.col("reason") != "fixed", F.col("reason"))).select(*columns)
    done = materialize(tested.unionByName(others).withColumn("status", F.when(F.col("reason").isNull(), "accepted").otherwise("unverified")), "done")
    # what is left gets the usual key
    rest = open_.join(done.where("reason IS NULL OR reason LIKE 'align-%'").select("id"), "id", "left_anti")
    why = passed.where("split_failed").select("id", F.lit("split-notation").alias("_why")).unionByName(done.where("reason IS NOT NULL").select("id", F.col("reason").alias("_why")))
    usual = st.fallback(rest.select("id", "reading", "kango", "category")).select("id", "modern", "skk_key", "okuri", "status", F.col("reason").alias("_none"))
    rest = rest.join(usual, "id").join(why, "id", "left").withColumn("reason", F.coalesce("_none", "_why")).withColumn("method", F.lit("none")).withColumn("alt_notations", F.lit(None).cast("array<string>"))
    gone = x.where("excluded IS NOT NULL").withColumn("reason", F.col("excluded")).withColumn("status", F.lit("excluded")).withColumn("method", F.lit("none"))
    for c, kind in (("modern", "string"), ("skk_key", "string"), ("okuri", "boolean"), ("alt_notations", "array<string>")):
        gone = gone.withColumn(c, F.lit(None).cast(kind))
    verdicts = [*columns, "status"]
    kept = done.where("reason IS NULL OR reason LIKE 'align-%'").select(*verdicts)
    every = kept.unionByName(rest.select(*verdicts)).unionByName(gone.select(*verdicts))
    every = every.withColumn("shinjitai", rs.new_form(F.col("notation"), lex.new)).withColumn("alt_notations", F.when(F.col("status") == "accepted", F.col("alt_notations")))
    own = x.select("id", "pid", "frame", "bbox", "seq", "kango", "pos", "source", "ndl", F.when(F.col("suspicious") & F.col("outlier"), "outlier").otherwise("ok").alias("order"))
    return own.join(every, "id")
