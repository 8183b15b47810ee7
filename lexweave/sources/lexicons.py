"""Lexicons as long tables: one row for each key and word, spelling and reading, character and reading."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexweave.functions import kana

HAN_ANY = "[\\p{IsHan}]"


def base_lexicon(lines: DataFrame) -> DataFrame:
    """(section, key, word, ord, line_no) of `key /word;note/word/` lines (path, line_no, line).

    Section marks hold until the next one. Notes, bracketed blocks and computed
    words go. A key given twice in a section keeps both lines here; `last_lines`
    has the later one only.
    """
    mark = F.when(F.col("line").startswith(";; okuri-ari entries."), "ari").when(F.col("line").startswith(";; okuri-nasi entries."), "nasi")
    # marks are few: each line takes the last one before it by a window over its file
    w = Window.partitionBy("path").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    x = lines.withColumn("section", F.coalesce(F.last(mark, ignorenulls=True).over(w), F.lit("ari")))
    x = x.where(~F.col("line").startswith(";") & F.col("line").contains(" /"))
    at = F.instr("line", " /")
    parts = F.filter(F.split(F.substring("line", at + 2, F.length("line")), "/"), lambda c: (c != "") & ~c.startswith("["))
    words = F.filter(F.transform(parts, lambda c: F.split(c, ";")[0]), lambda c: (c != "") & ~c.startswith("(concat"))
    return x.select("section", F.substring("line", F.lit(1), at - 1).alias("key"), "line_no", F.posexplode(words).alias("ord", "word")).select("section", "key", "word", "ord", "line_no")


def last_lines(lexicon: DataFrame) -> DataFrame:
    """The words of each (section, key)'s last line."""
    last = lexicon.groupBy("section", "key").agg(F.max("line_no").alias("line_no"))
    return lexicon.join(last, ["section", "key", "line_no"]).select("section", "key", "word", "ord", "line_no")


def skeleton_readings(lexicon: DataFrame) -> DataFrame:
    """(skeleton, reading, ord): readings of words by their characters without kana."""
    x = lexicon.where("section = 'nasi'").withColumn("skeleton", kana.skeleton(F.col("word"))).where(F.col("skeleton").rlike(f"[{kana.HAN}〻]"))
    return x.groupBy("skeleton", F.col("key").alias("reading")).agg(F.min(F.struct("line_no", "ord")).alias("ord"))


#: Fields that link forms of one character, and forms of like meaning.
VARIANT_FIELDS = ("kZVariant", "kTraditionalVariant", "kSimplifiedVariant", "kCompatibilityVariant", "kJapaneseNewVariant", "kJapaneseOldVariant")
SEMANTIC_FIELDS = ("kSemanticVariant", "kSpecializedSemanticVariant")


def code_point(c: Column) -> Column:
    """`U+XXXX` as its character."""
    return F.decode(F.unhex(F.lpad(F.regexp_extract(c, "U\\+([0-9A-F]+)", 1), 8, "0")), "UTF-32")


def character_fields(lines: DataFrame) -> DataFrame:
    cells = F.split("line", "\t")
    return lines.where(F.col("line").startswith("U+")).select(code_point(cells[0]).alias("ch"), cells[1].alias("field"), cells[2].alias("value"), "line_no")


def character_variants(fields: DataFrame) -> DataFrame:
    """(a, b, kind) both ways."""
    kind = F.when(F.col("field").isin(*VARIANT_FIELDS), "variant").when(F.col("field").isin(*SEMANTIC_FIELDS), "semantic")
    x = fields.withColumn("kind", kind).where("kind IS NOT NULL")
    x = x.select(F.col("ch").alias("a"), "kind", F.explode(F.split("value", "\\s+")).alias("v")).where(F.col("v").startswith("U+"))
    one = x.select("a", code_point(F.split("v", "<")[0]).alias("b"), "kind").where("a <> b")
    return one.unionByName(one.select(F.col("b").alias("a"), F.col("a").alias("b"), "kind")).distinct()


def new_forms(fields: DataFrame) -> DataFrame:
    """(old, new) of characters that have a newer form."""
    return fields.where("field = 'kJapaneseNewVariant'").select(F.col("ch").alias("old"), code_point(F.split("value", "\\s")[0]).alias("new"))


def character_readings(fields: DataFrame) -> DataFrame:
    """(ch, kind, reading, ord): katakana readings are on, hiragana ones kun."""
    x = fields.where("field = 'kJapanese'").select("ch", F.posexplode(F.split("value", " ")).alias("ord", "r"))
    kind = F.when(F.col("r").rlike("^[ァ-ヶー]+$"), "on").when(F.col("r").rlike("^[ぁ-ゖー]+$"), "kun")
    return x.select("ch", kind.alias("kind"), kana.katakana_to_hiragana(F.col("r")).alias("reading"), "ord").where("kind IS NOT NULL")


def _tag(body: Column, tag: str) -> Column:
    return F.regexp_extract_all(body, F.lit(f"<{tag}>([^<]*)</{tag}>"), F.lit(1))


def dictionary_forms(elements: DataFrame) -> DataFrame:
    """(skeleton, kanji, reading, old, pos) of an entry-wise XML lexicon (value: text up to an entry's end)."""
    body = F.regexp_extract("value", "(?s)<entry>(.*)$", 1)
    block = lambda t: F.regexp_extract_all("body", F.lit(f"(?s)<{t}>(.*?)</{t}>"), F.lit(1))
    x = elements.select(body.alias("body")).where("body <> ''").withColumn("entry", F.monotonically_increasing_id())
    pos = F.array_distinct(F.transform(_tag(F.col("body"), "pos"), lambda p: F.regexp_replace(p, "^&|;$", "")))
    x = x.select("entry", pos.alias("pos"), block("k_ele").alias("ks"), F.transform(block("r_ele"), lambda r, i: F.struct(i.alias("r_ord"), r.alias("r"))).alias("rs"))
    x = x.select("entry", "pos", "rs", F.posexplode("ks").alias("k_ord", "k")).withColumn("kanji", _tag(F.col("k"), "keb")[0])
    x = x.select("entry", "pos", "k_ord", "kanji", F.explode("rs").alias("r"))
    limits = _tag(F.col("r.r"), "re_restr")
    fits = ~F.col("r.r").contains("<re_nokanji/>") & ((F.size(limits) == 0) | F.array_contains(limits, F.col("kanji")))
    x = x.where(fits).withColumn("skeleton", kana.skeleton(F.col("kanji"))).where("skeleton <> ''")
    return x.select("skeleton", "kanji", _tag(F.col("r.r"), "reb")[0].alias("reading"), F.col("r.r").contains("<re_inf>&ok;</re_inf>").alias("old"), "pos", F.struct("entry", "k_ord", "r.r_ord").alias("ord"))


def character_dictionary(elements: DataFrame) -> DataFrame:
    """(ch, kind, reading) of a character-wise XML lexicon: on, kun, nanori; no affix readings of one kana."""
    body = F.regexp_extract("value", "(?s)<character>(.*)$", 1)
    x = elements.select(body.alias("body")).where("body <> ''").withColumn("ch", F.regexp_extract("body", "<literal>(.*?)</literal>", 1)).where("ch <> ''")
    of = lambda t: F.transform(F.regexp_extract_all("body", F.lit(f'<reading r_type="ja_{t}"[^>]*>(.*?)</reading>'), F.lit(1)), lambda r: F.struct(F.lit(t).alias("kind"), r.alias("raw")))
    names = F.transform(F.regexp_extract_all("body", F.lit("<nanori>(.*?)</nanori>"), F.lit(1)), lambda r: F.struct(F.lit("nanori").alias("kind"), r.alias("raw")))
    x = x.select("ch", F.explode(F.concat(of("on"), of("kun"), names)).alias("r"))
    plain = F.translate(kana.katakana_to_hiragana(F.col("r.raw")), ".-", "")
    x = x.select("ch", "r.kind", F.when(F.col("r.kind") == "nanori", F.col("r.raw")).otherwise(plain).alias("reading"), F.col("r.raw").alias("raw"))
    affix = (F.col("kind") != "nanori") & F.col("raw").contains("-") & (F.length("reading") == 1)
    kind_ok = F.when(F.col("kind") == "nanori", F.col("reading").rlike("^[ぁ-ゖ]+$")).otherwise(F.col("reading").rlike("^[ぁ-ゖー]+$"))
    return x.where(kind_ok & ~affix).select("ch", "kind", "reading").distinct()


WIKTIONARY = "word string, pos string, forms array<struct<form: string, tags: array<string>, ruby: array<array<string>>>>, head_templates array<struct<args: map<string, string>>>"


def ruby_reading(form: Column, ruby: Column) -> Column:
    """The form with each ruby's reading in place of its characters, in order; null if a character or a ruby is left."""
    start = F.struct(form.alias("rest"), F.lit("").alias("out"), F.lit(True).alias("ok"))

    # kana before the next ruby stay: a character among them means that it doesn't fit
    def step(acc: Column, r: Column) -> Column:
        at = F.position(r[0], acc["rest"])
        before = F.substring(acc["rest"], F.lit(1), at - 1)
        ok = acc["ok"] & (at > 0) & ~before.rlike(HAN_ANY)
        rest = F.substring(acc["rest"], at + F.length(r[0]), F.length(acc["rest"]))
        return F.struct(F.when(ok, rest).otherwise("").alias("rest"), F.when(ok, F.concat(acc["out"], before, r[1])).otherwise("").alias("out"), ok.alias("ok"))

    done = F.aggregate(ruby, start, step)
    return F.when(done["ok"] & ~done["rest"].rlike(HAN_ANY), kana.katakana_to_hiragana(F.concat(done["out"], done["rest"])))


def open_dictionary(rows: DataFrame) -> DataFrame:
    """(skeleton, kanji, reading, old, pos) of a JSON lexicon with ruby (schema WIKTIONARY).

    Canonical forms with ruby give modern readings, historical hiragana forms
    old ones. Characters, romanizations, redirects, names and classical
    adjectives go.
    """
    han, hira = f"[{kana.HAN}]", "^[ぁ-ゖー]+$"
    x = rows.where(F.col("word").rlike(han) & ~F.coalesce("pos", F.lit("")).isin("character", "romanization", "soft-redirect", "name"))
    x = x.where((F.coalesce("pos", F.lit("")) != "adj") | F.col("word").endswith("い")).withColumn("forms", F.coalesce("forms", F.array().cast("array<struct<form: string, tags: array<string>, ruby: array<array<string>>>>")))
    has = lambda f, *ts: F.size(F.array_intersect(F.coalesce(f["tags"], F.array().cast("array<string>")), F.array(*map(F.lit, ts)))) == len(ts)
    clean = lambda f: F.trim(F.replace(f["form"], F.lit(" ^"), F.lit("")))
    canonical = F.filter(F.transform(F.filter("forms", lambda f: has(f, "canonical") & f["ruby"].isNotNull()), lambda f: F.struct(clean(f).alias("form"), ruby_reading(clean(f), f["ruby"]).alias("r"))), lambda s: s["r"].isNotNull())
    x = x.withColumn("canonical", canonical)
    modern = F.filter(F.array_distinct(F.col("canonical.r")), lambda r: r.rlike(hira))
    old = F.transform(F.filter("forms", lambda f: has(f, "historical", "hiragana") & ~(has(f, "canonical") & f["ruby"].isNotNull())), lambda f: f["form"])
    x = x.withColumn("modern", modern).where(F.size("modern") > 0).withColumn("older", F.array_except(F.filter(F.array_distinct(old), lambda r: r.rlike(hira)), F.col("modern")))
    other = F.transform(F.filter("forms", lambda f: has(f, "alternative", "kanji") & f["form"].rlike(han)), lambda f: f["form"])
    kanji = F.array_distinct(F.concat(F.array("word"), F.col("canonical.form"), other))
    verb = F.when(F.get("head_templates", F.lit(0))["args"]["type"] == "2", "v1").otherwise("v5")
    pos = F.when(F.col("pos") == "adj", "adj-i").when(F.col("pos") == "verb", verb).otherwise("n")
    readings = F.concat(F.transform("modern", lambda r: F.struct(r.alias("reading"), F.lit(False).alias("old"))), F.transform("older", lambda r: F.struct(r.alias("reading"), F.lit(True).alias("old"))))
    x = x.select(F.array(pos).alias("pos"), readings.alias("rs"), F.posexplode(kanji).alias("k_ord", "kanji")).select("pos", "kanji", "k_ord", F.posexplode("rs").alias("r_ord", "r"))
    return x.select(kana.skeleton(F.col("kanji")).alias("skeleton"), "kanji", "r.reading", "r.old", "pos", F.struct("k_ord", "r_ord").alias("ord")).where("skeleton <> ''")


# Open vowels and what they merge with before a long mark.
_OPEN, _CLOSED, _LONG = "アカガサザタダナハバパマヤラワ", "オコゴソゾトドノホボポモヨロヲ", "ゥ"


def loose_key(c: Column) -> Column:
    """Folds what the missionaries' spelling tells apart and later speech doesn't, and what it spells in several ways."""
    s = F.translate(c, "ㇺ", "ン")
    chars = F.split(s, "")
    table = F.create_map(*[F.lit(x) for p in [*zip(_OPEN, _CLOSED, strict=True), ("ャ", "ョ")] for x in p])
    before_long = lambda x, i: F.when(F.get(chars, i + 1) == _LONG, F.coalesce(F.try_element_at(table, x), x)).otherwise(x)
    folded = F.array_join(F.transform(chars, before_long), "")
    return kana.unvoiced(F.translate(folded, "っヂヅ", "ッジズ"))


def missionary_keys(lines: DataFrame) -> DataFrame:
    """(key) of a four-column table's headwords: alternatives by |, verbs by their stem, ending and past form."""
    cells = F.split("line", "\t")
    x = lines.where((F.size(cells) >= 4) & (cells[0] != "整理番号")).select(F.explode(F.split(cells[3], "\\|")).alias("alt"))
    parts = F.transform(F.split(F.regexp_replace("alt", "^[\\s.,]+|[\\s.,]+$", ""), ","), lambda p: F.regexp_replace(F.trim(p), "\\.$", ""))
    x = x.select(parts.alias("p")).where("p[0] <> ''")
    stem = F.substring(F.col("p")[0], F.lit(1), F.length(F.col("p")[0]) - 1)
    end = F.get("p", F.lit(1))
    some = F.coalesce(end, F.lit("")) != ""
    short = some & end.endswith("ル") & (F.length(end) >= 2)
    forms = F.array_compact(F.array(F.col("p")[0], F.when(some, F.concat(stem, end)), F.when(short, F.concat(stem, F.substring(end, F.lit(1), F.length(end) - 1)))))
    return x.select(F.explode(forms).alias("f")).select(loose_key(F.replace("f", F.lit(" "), F.lit(""))).alias("key")).distinct()
