"""Matching by alignment: which modern reading of an entry can be dealt to the characters of its spelling.

Inflected words are columns: every variant gives a stem, a key and whether its
last character must be native; distinct (spelling, stem) pairs are aligned
once and joined back. A noun's variants compete, and base-lexicon words inside
the spelling (all of its substrings, one join) decide between them and put
liaison in.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexweave.functions import align, kana
from lexweave.functions.sino import aligned_with_learned, without_h_twins
from lexweave.storage import materialize

#: Final kana of verbs, and those of verbs that also have Sino-Japanese stems.
VERB_ENDINGS, SINO_VERB_ENDINGS = "うくぐすずつづぬふぶむゆる", "すず"
#: In place of an old stem that learned readings aren't held against.
FREE = "*"
#: N-row kana after n, and the vowels they come from.
_LIAISON = str.maketrans("なにぬねの", "あいうえお")


def new_form(notation: Column, new: dict[str, str]) -> Column:
    return F.translate(notation, "".join(new), "".join(new.values())) if new else notation


def spellings(notation: Column, new: dict[str, str]) -> Column:
    return F.array_distinct(F.array(notation, new_form(notation, new)))


def unlinked(reading: str) -> str:
    """Without liaison: the vowel back after n."""
    return "".join(c.translate(_LIAISON) if i and reading[i - 1] == "ん" else c for i, c in enumerate(reading))


def linked(modern: str, parts: list[tuple[int, int, str, str]]) -> str:
    """The reading with the liaison of lexicon words in it; parts: (1 for inner ones, length, place, reading) in the order they are put in."""
    for late, _, place, r in parts:
        plain = unlinked(r)
        if plain == r:
            continue
        if place == "head" and modern.startswith(plain):
            modern = r + modern[len(plain) :]
        elif place == "tail" and modern.endswith(plain):
            modern = modern[: len(modern) - len(plain)] + r
        elif late and modern.count(plain) == 1:
            modern = modern.replace(plain, r)
    return modern


def stem_fits_udf(readings: align.Readings, learned: align.Readings | None):
    """(spelling, stem, old stem, native) to struct(own, learned); an old stem FREE isn't compared."""
    tables = {native: align.Aligner(readings, last_kun=native) for native in (False, True)}
    more = {native: align.Aligner(learned, last_kun=native) for native in (False, True)} if learned else None

    def one(spelling: str, stem: str, old: str, native: bool) -> tuple[bool, bool]:
        if tables[native].fits(spelling, stem):
            return True, False
        if more is None:
            return False, False
        return False, more[native].fits(spelling, stem) if old == FREE else aligned_with_learned(spelling, stem, old, tables[False], more[False])

    @F.pandas_udf("struct<own: boolean, learned: boolean>")
    def fits(spelling: pd.Series, stem: pd.Series, old: pd.Series, native: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([r or (None, None) for r in align.once(one, spelling, stem, old, native)], columns=["own", "learned"])

    return fits


def inflected(x: DataFrame, new: dict[str, str], readings: align.Readings, learned: align.Readings | None) -> DataFrame:
    """(id, option, modern, skk_key) of verbs and adjectives for which just one key is possible.

    x: id, option, reading, notation, category, conjugation, kango.
    """
    v = x.where(F.col("category").isin("verb", "adjective")).select("*", F.posexplode(kana.modern_variants("reading", "kango")).alias("variant", "v"))
    last, stem = F.substring("v", -1, 1), F.substring("v", F.lit(1), F.length("v") - 1)
    letter = F.get(kana.okuri_letters(last), F.lit(0))
    bare = F.translate("reading", "-・", "")
    form = kana.adjective_form(F.col("v"), F.col("conjugation"))
    request = "array<struct<stem: string, old: string, native: boolean, modern: string, skk_key: string>>"
    of_verb = F.array(F.struct(stem.alias("stem"), F.substring(bare, F.lit(1), F.length(bare) - 1).alias("old"), (~F.lit(SINO_VERB_ENDINGS).contains(last)).alias("native"), F.col("v").alias("modern"), F.concat(stem, letter).alias("skk_key")))
    is_verb = (F.col("category") == "verb") & (F.length("v") > 1) & F.lit(VERB_ENDINGS).contains(last) & letter.isNotNull()
    of_adjective = F.transform(form["stems"], lambda s: F.struct(s.alias("stem"), F.lit(FREE).alias("old"), F.lit(True).alias("native"), form["modern"].alias("modern"), form["skk_key"].alias("skk_key")))
    asked = v.withColumn("_r", F.explode(F.when(is_verb, of_verb.cast(request)).when(F.col("category") == "adjective", of_adjective.cast(request))))
    asked = materialize(asked.select("id", "option", "category", "variant", "_r.*", F.explode(spellings(F.col("notation"), new)).alias("spelling")), "stems")
    pairs = asked.select("spelling", "stem", "old", "native").distinct().withColumn("_f", stem_fits_udf(readings, learned)("spelling", "stem", "old", "native"))
    fit = asked.join(pairs, ["spelling", "stem", "old", "native"]).select("id", "option", "category", "variant", "stem", "modern", "skk_key", "_f.own", "_f.learned").where("own OR learned")
    # a verb's own readings go before learned ones; an adjective takes both alike
    late = (F.col("category") == "verb") & ~F.col("own")
    # of one verb stem the first variant counts; of adjectives, and learned stems, the last one of a key
    first = (F.col("category") == "verb") & F.col("own")
    unit = F.when(first, F.col("stem")).otherwise(F.col("skk_key"))
    order = F.when(first, F.col("variant")).otherwise(-F.col("variant"))
    per = fit.groupBy("id", "option", late.alias("_late"), unit.alias("_u")).agg(F.min_by(F.struct("modern", "skk_key"), order).alias("_m"))
    every = per.groupBy("id", "option").agg(F.min("_late").alias("_top"), F.collect_list(F.struct("_late", "_m")).alias("_ms"))
    only = every.withColumn("_ms", F.filter("_ms", lambda m: m["_late"] == F.col("_top"))).where(F.size("_ms") == 1)
    return only.select("id", "option", F.col("_ms")[0]["_m"]["modern"].alias("modern"), F.col("_ms")[0]["_m"]["skk_key"].alias("skk_key"))


def inner_words(notations: DataFrame, base: DataFrame, new: dict[str, str]) -> DataFrame:
    """(notation, words): base-lexicon words at all places of a spelling and of its new form, as (form, start, length, reading)."""
    form = notations.select("notation").distinct().select("notation", F.posexplode(spellings(F.col("notation"), new)).alias("form", "w"))
    n = F.length("w")
    cut = F.flatten(F.transform(F.sequence(F.lit(1), n), lambda a: F.transform(F.sequence(a, n), lambda b: F.struct((a - 1).alias("start"), (b - a + 1).alias("length"), F.substring("w", a, b - a + 1).alias("part")))))
    parts = form.where(n > 0).select("notation", "form", F.explode(cut).alias("p")).select("notation", "form", "p.*")
    words = base.where("section = 'nasi'").select(F.col("word").alias("part"), F.col("key").alias("reading")).distinct()
    return parts.join(words, "part").groupBy("notation").agg(F.array_sort(F.collect_list(F.struct("form", "start", "length", "reading"))).alias("words"))


class NounRules:
    """Chooses a noun's modern reading among its variants."""

    def __init__(self, readings: align.Readings, learned: align.Readings | None) -> None:
        self.own, self.untwinned = align.Aligner(readings), align.Aligner(without_h_twins(readings))
        self.learned = align.Aligner(learned) if learned else None

    def choose(self, forms: list[str], variants: list[str], bare: str, words: list[tuple[int, int, int, str]]) -> str | None:
        """forms: the spelling and its new form; bare: the old reading without separators; words: what `inner_words` gives."""
        left = 1 if len(forms[0]) == 1 else 0
        fits: Callable[[align.Aligner, str, int], bool] = lambda a, v, left: any(a.fits(f, v, left) for f in forms)
        several = len(variants) > 1
        parts = self._parts(forms, words)
        if left and several and bare.endswith("は") and not any(fits(self.own, v, 0) for v in variants):
            # a particle that the spelling leaves out isn't softened
            kept = next((v for v in variants if v.endswith("は") and fits(self.own, v, 1)), None)
            if kept is not None:
                return linked(kept, parts)
        tests = [lambda v: fits(self.own, v, left)]
        if several:
            tests.insert(0, lambda v: fits(self.untwinned, v, left))
        if self.learned:
            tests.append(lambda v: any(aligned_with_learned(f, v, bare, self.own, self.learned, left) for f in forms))
        found = next((v for test in tests for v in variants if test(v)), None)
        if found is None:
            return None
        if several:
            # more words of the lexicon at their places beat the first fit; of as many, one that aligns as a whole
            marks = {v: self._score(v, forms, words) for v in variants}
            better = [v for v in variants if marks[v] > marks[found]]
            found = min(better, key=lambda v: (-marks[v], not fits(self.own, v, left), variants.index(v)), default=found)
        return linked(found, parts)

    @staticmethod
    def _parts(forms: list[str], words) -> list[tuple[int, int, str, str]]:
        out = set()
        for f, start, n, r in words:
            if n >= 2:
                ends = [p for p, ok in (("head", start == 0), ("tail", start + n == len(forms[f]))) if ok]
                out |= {(0, n, p, r) for p in ends} or {(1, n, "mid", r)}
        return sorted(out)

    def _score(self, x: str, forms: list[str], words) -> int:
        """How many lexicon words stand in the reading where they stand in the spelling, the rest fitting what is left."""
        whole = forms[-1]
        known = {(start, n, r) for _, start, n, r in words}

        def rest(start: int, end: int, r: str) -> bool:
            if start == end or not r:
                return start == end and not r
            table = str.maketrans(*kana._unvoiced_table())
            heads = (r, r[0].translate(table) + r[1:])
            return (start, end - start, r) in known or any(self.own.fits(f[start:end], h) for f in forms for h in heads)

        score = 0
        for f, start, n, r in words:
            end, size = start + n, len(forms[f])
            if n < 2 or size != len(whole):
                continue
            if 0 < start and end < size:
                # inner words count where single characters don't give their reading
                if not self.own.fits(forms[f][start:end], r):
                    score += any(rest(0, start, x[:p]) and rest(end, size, x[p + len(r) :]) for p in range(1, len(x)) if x.startswith(r, p))
                continue
            score += start == 0 and x.startswith(r) and rest(end, size, x[len(r) :])
            score += end == size and x.endswith(r) and rest(0, start, x[: len(x) - len(r)])
        return score


def nouns(x: DataFrame, base: DataFrame, new: dict[str, str], readings: align.Readings, learned: align.Readings | None) -> DataFrame:
    """(id, option, modern, skk_key) of other words. x: id, option, reading, notation, category, kango."""
    rules = NounRules(readings, learned)

    @F.pandas_udf("string")
    def choose(forms: pd.Series, variants: pd.Series, bare: pd.Series, words: pd.Series) -> pd.Series:
        rows = zip(forms, variants, bare, words, strict=True)
        return pd.Series([rules.choose(list(f), list(v), b, [(w["form"], w["start"], w["length"], w["reading"]) for w in ws] if ws is not None else []) if f is not None and v is not None and b is not None else None for f, v, b, ws in rows])

    y = x.where(~F.col("category").isin("verb", "adjective") & (F.length("notation") > 0))
    y = y.join(inner_words(y, base, new), "notation", "left")
    modern = choose(spellings(F.col("notation"), new), kana.modern_variants("reading", "kango"), F.translate("reading", "-・", ""), F.col("words"))
    y = y.select("id", "option", modern.alias("modern")).where("modern IS NOT NULL")
    return y.select("id", "option", "modern", F.col("modern").alias("skk_key"))
