"""Kana as columns: folding keys, heads of entries, word classes, okurigana; and spelling variants as an Arrow UDF.

Spelling variants are table-driven: RULES maps a spelling of one to three kana
to its modern spellings, for each of four settings (Sino-Japanese or not, first
place of a segment or not). The tables are made from the kana rows.
"""

from __future__ import annotations

import re
import unicodedata
from functools import cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

# The kana rows by vowel, in one order; a full-width space stands for a kana that doesn't exist.
ROW_A = "あかがさざただなはばぱまやらわ"
ROW_I = "いきぎしじちぢにひびぴみ　り　"
ROW_U = "うくぐすずつづぬふぶぷむゆるう"
ROW_E = "えけげせぜてでねへべぺめ　れゑ"
ROW_O = "おこごそぞとどのほぼぽもよろを"
# Small kana and what they are in full size.
SMALL, FULL = "ぁぃぅぇぉっゃゅょゎ", "あいうえおつやゆよわ"
# Unvoiced, voiced and half-voiced kana.
PLAIN, VOICED = "かきくけこさしすせそたちつてとはひふへほ", "がぎぐげござじずぜぞだぢづでどばびぶべぼ"
H_PLAIN, H_HALF = "はひふへほ", "ぱぴぷぺぽ"

HIRAGANA = "".join(map(chr, range(0x3041, 0x3097)))
KATAKANA = "".join(map(chr, range(0x30A1, 0x30F7)))

#: Spark's regular expressions: Han characters and the marks that count as such.
HAN = "\\p{IsHan}々〆ヶ"


@cache
def _unvoiced_table() -> tuple[str, str]:
    """Every kana with a voicing mark, and its base."""
    pairs = [(c, unicodedata.normalize("NFD", c)[0]) for c in map(chr, range(0x3041, 0x30FF)) if len(unicodedata.normalize("NFD", c)) > 1]
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


def katakana_to_hiragana(c: Column) -> Column:
    return F.translate(c, KATAKANA, HIRAGANA)


def unvoiced(c: Column) -> Column:
    """Without voicing marks."""
    return F.translate(c, *_unvoiced_table())


def unvoiced_head(c: Column) -> Column:
    return F.concat(unvoiced(F.substring(c, 1, 1)), F.substring(c, F.lit(2), F.length(c)))


def without_separators(c: Column) -> Column:
    return F.translate(c, "-", "")


def collation_key(c: Column) -> Column:
    """For the order of the fifty sounds: no separators, long marks, small kana or voicing."""
    return unvoiced(F.translate(c, SMALL + "-ー・", FULL))


def skeleton(c: Column) -> Column:
    """What is left of a word without kana and long marks."""
    return F.regexp_replace(c, "[ぁ-ゖァ-ヺー]", "")


def normalize_reading(c: Column) -> Column:
    """One kind of separator, single, none at the ends."""
    one = F.regexp_replace(F.translate(c, "・=＝‐－", "-----"), "-+", "-")
    return F.regexp_replace(one, "^-|-$", "")


def normalize_notation(c: Column) -> Column:
    """struct(notation, bad): marks at the ends go; what is left inside makes it bad, and so does nothing left."""
    given = F.when(F.length(c) > 0, c)
    body = F.regexp_replace(F.regexp_replace(given, f"^[^{HAN}]+", ""), f"[^{HAN}ぁ-ゖ]+$", "")
    kept = F.when(F.length(body) > 0, body)
    bad = given.isNotNull() & (kept.isNull() | F.coalesce(kept.rlike(f"[^{HAN}〻ぁ-ゖ]"), F.lit(False)))
    return F.struct(kept.alias("notation"), bad.alias("bad"))


# What a head looks like, its separators misread, and the word-class labels that may start its bracket.
_SEPARATOR = "(?<=[ぁ-ゖゝゞァ-ヺ])(?:[〳〴]〵|[―〳〵〴!！↓～~])(?=[ぁ-ゖゝゞァ-ヺ])"
_HEAD = "^([ぁ-ゖゝゞァ-ヺー\\-－‐・=＝]+)([^()（）、。，．「」『』]*?)[(（]([^()（）]{1,8})[)）]"
_LABEL = "^(名|代|數|数|自動|他動|助動|動|形|副|接頭|接尾|接|感|助|枕|連)"
_SINO = "^[一―ー-]"
_ONE = "^(いち|いつ|いっ|ひと|ひとつ|はじめ|かず)"


def parse_head(line: Column) -> Column:
    """struct(reading, notation, kango, pos) of an entry's first line; null if it isn't one."""
    s = F.regexp_replace(F.regexp_replace(line, "\\s", ""), _SEPARATOR, "-")
    reading, raw, pos = (F.regexp_extract(s, _HEAD, i) for i in (1, 2, 3))
    kango = raw.rlike(_SINO) & (F.length(raw) >= 2) & ~F.translate(reading, "-", "").rlike(_ONE)
    notation = F.when(kango, F.substring(raw, F.lit(2), F.length(raw))).otherwise(raw)
    is_head = s.rlike(_HEAD) & reading.rlike("[ぁ-ゖ]") & pos.rlike(_LABEL)
    return F.when(is_head, F.struct(reading.alias("reading"), F.when(F.length(notation) > 0, notation).alias("notation"), kango.alias("kango"), pos.alias("pos")))


# labels' beginnings and their word classes; the first that fits counts.
LABELS = (
    ("助動", "auxiliary"),
    ("自動|他動|動", "verb"),
    ("形", "adjective"),
    ("名", "noun"),
    ("代", "pronoun"),
    ("[數数]", "numeral"),
    ("副", "adverb"),
    ("枕", "makura"),
    ("感", "interjection"),
    ("接頭", "prefix"),
    ("接尾", "suffix"),
    ("接", "conjunction"),
    ("助", "particle"),
)
# Verb classes by what their label holds; the first that fits counts.
CONJUGATIONS = (("上[一1]", "上一"), ("上[二ニ2]", "上二"), ("下[一1]", "下一"), ("下[二ニ2]", "下二"), ("[變変]", "変格"), ("四", "四段"))


def _chain(c: Column, table, start: str = "") -> Column:
    out = None
    for pattern, value in table:
        test = c.rlike(f"{start}({pattern})")
        out = F.when(test, F.lit(value)) if out is None else out.when(test, F.lit(value))
    return out


def normalize_pos(raw: Column) -> Column:
    """struct(category, categories, conjugation, raw); what can't be read stays null, or `other`."""
    labels = F.filter(F.split(F.regexp_replace(raw, "\\s", ""), "[、,，・]"), lambda x: F.length(x) > 0)
    categories = F.transform(labels, lambda x: F.coalesce(_chain(x, LABELS, "^"), F.lit("other")))
    first = F.coalesce(F.get(labels, F.lit(0)), F.lit(""))
    category = F.coalesce(F.get(categories, F.lit(0)), F.lit("other"))
    verb = _chain(F.regexp_replace(first, "^(自動|他動|動)", ""), CONJUGATIONS)
    adjective = F.when(first.rlike("^.[一1]"), "ク").when(first.rlike("^.[二ニ2]"), "シク")
    conjugation = F.when(category == "verb", verb).when(category == "adjective", adjective)
    return F.struct(category.alias("category"), categories.alias("categories"), conjugation.alias("conjugation"), raw.alias("raw"))


# The letters that stand for okurigana, by its first kana.
_OKURI = {"う": ["u", "w"], "っ": ["t", "c"], "ち": ["t", "c"], "し": ["s"], "じ": ["j", "z"], "つ": ["t"], "ふ": ["h", "f"], "ん": ["n"]} | {
    c: [letter]
    for letter, row in {
        "a": "あ", "i": "い", "e": "え", "o": "お", "k": "かきくけこ", "g": "がぎぐげご", "s": "さすせそ", "z": "ざずぜぞ", "t": "たてと", "d": "だぢづでど", "n": "なにぬねの",
        "h": "はひへほ", "b": "ばびぶべぼ", "p": "ぱぴぷぺぽ", "m": "まみむめも", "y": "やゆよ", "r": "らりるれろ", "w": "わを",
    }.items()
    for c in row
}


def okuri_letters(kana: Column) -> Column:
    table = F.create_map(*[x for k, v in _OKURI.items() for x in (F.lit(k), F.array(*map(F.lit, v)))])
    return F.coalesce(F.try_element_at(table, F.substring(kana, 1, 1)), F.array().cast("array<string>"))


def _row_map(c: Column, source: str, to: str) -> Column:
    pairs = [(a, b) for a, b in dict(zip(reversed(source), reversed(to), strict=True)).items() if a != "　" and b != "　"]
    return F.try_element_at(F.create_map(*[F.lit(x) for p in pairs for x in p]), c)


def dictionary_forms(modern: Column, category: Column) -> Column:
    """The classical final form and the modern dictionary forms it may have, in order."""
    last, stem = F.substring(modern, -1, 1), F.substring(modern, F.lit(1), F.length(modern) - 1)
    e, i = _row_map(last, ROW_U, ROW_E), _row_map(last, ROW_U, ROW_I)
    some = lambda *xs: F.array_compact(F.array(*xs))
    verb = some(
        modern, F.concat(stem, e, F.lit("る")), F.concat(stem, i, F.lit("る")), F.when(last == "す", F.concat(stem, F.lit("する"))),
        F.when(last == "ず", F.concat(stem, F.lit("ずる"))), F.when(last == "ず", F.concat(stem, F.lit("じる"))),
    )
    adjective = some(modern, F.when(last == "し", F.concat(stem, F.lit("い"))), F.when(last == "し", F.concat(modern, F.lit("い"))))
    return F.array_distinct(F.when(category == "verb", verb).when(category == "adjective", adjective).otherwise(F.array(modern)))


# Fixed value: endings of classical adjectives that are surely of the ku class.
_KU_ENDING = "(なし|よし|にくし|やすし|くさし|[ふぶ]かし|ながし|がたし|かたし|のろし|とし|わるし)$"


def adjective_form(v: Column, conjugation: Column) -> Column:
    """struct(modern, skk_key, stems) of an adjective's reading; null where the class can't be told."""
    stem = F.substring(v, F.lit(1), F.length(v) - 1)
    made = lambda m, k, *s: F.struct(m.alias("modern"), k.alias("skk_key"), F.array(*s).alias("stems"))
    i, key = F.lit("い"), F.lit("i")
    shiku = F.coalesce(conjugation == "シク", F.lit(False))
    ku = F.coalesce(conjugation == "ク", F.lit(False)) | v.rlike(_KU_ENDING)
    return (
        F.when(F.length(v) < 2, None)
        .when(v.endswith("い"), made(v, F.concat(stem, key), stem))
        .when(v.endswith("し") & shiku, made(F.concat(v, i), F.concat(v, key), v, stem))
        .when(v.endswith("し") & ku, made(F.concat(stem, i), F.concat(stem, key), stem))
    )


def valid_okuri(okuri: Column, category: Column) -> Column:
    """One kana; of verbs also an e- or i-row kana and ru, of adjectives also shii."""
    rows = "".join(c for c in ROW_E + ROW_I if c not in "　ゑ")
    return (F.length(okuri) == 1) | ((category == "verb") & okuri.rlike(f"^[{rows}]る$")) | ((category == "adjective") & (okuri == "しい"))


# --- spelling variants

#: Fixed value: readings of one segment, and of a word, at most.
MOST_VARIANTS = 48


def _glide(i: str, small: str) -> str:
    return {"ゃ": "や", "ゅ": "ゆ", "ょ": "よ"}[small] if i == "い" else ("じ" if i == "ぢ" else i) + small


@cache
def rules(kango: bool, medial: bool) -> dict[str, list[str]]:
    """Old spelling to modern ones, the usual one first; longer spellings go before shorter ones."""
    out: dict[str, list[str]] = {}

    def rule(old: str, *new: str) -> None:
        out.setdefault(old, list(new))

    for k, a in (("く", "か"), ("ぐ", "が")):
        rule(k + "わう", ROW_O[ROW_A.index(a)] + "う")
        rule(k + "わ", a, k + "わ")
    for a, i, e, o in zip(ROW_A, ROW_I, ROW_E, ROW_O, strict=True):
        if i != "　":
            if i != "い" or not medial:
                for y in "やゃ":
                    for u in "うふ":
                        rule(i + y + u, _glide(i, "ょ") + "う")
            for y in "ゃゅょ":
                rule(i + y, _glide(i, y))
            long = _glide(i, "ゅ") + "う"
            rule(i + "う", long)
            rule(i + "ふ", *([long, i + "つ", i + "う"] if kango else [i + "う", long]))
        far = "お" if o == "を" else o
        rule(a + "う", far + "う")
        rule(a + "ふ", *([far + "う", a + "う"] if kango else [a + "う", far + "う", a + "お"]))
        if e != "　" and i != "　":
            long = _glide(i, "ょ") + "う"
            rule(e + "う", long)
            rule(e + "ふ", *([long] if kango else [e + "う", long]))
    for old, new in zip("ゐゑを", "いえお", strict=True):
        rule(old, new)
    if medial:
        for h, w in zip("はひふへほ", "わいうえお", strict=True):
            rule(h, *([h, w] if kango else [w, h]))
    return out


# Kana before which a Sino-Japanese t or k doubles.
_DOUBLED_BEFORE = "かきくけこさしすせそたちつてとぱぴぷぺぽ"


@cache
def contextual(kango: bool, first_segment: bool) -> list[tuple[re.Pattern, dict[str, list[str]]]]:
    """Rules by place, for kana that `rules` has none for: where they hold, and the spellings by kana; the first that holds counts."""
    voiced = {"ぢ": "じ", "づ": "ず"}
    kept = {c: [c, other] for c, other in voiced.items()}
    out = [(re.compile("(?<=[ちつ])[ぢづ]"), kept)]
    if not first_segment:
        out.append((re.compile("^[ぢづ]"), kept))
    out.append((re.compile("[ぢづ]"), {c: [other, c] for c, other in voiced.items()}))
    if kango:
        out.append((re.compile(f"(?<=.)[つく](?=[{_DOUBLED_BEFORE}])"), {c: [c, "っ"] for c in "つく"}))
    return out


@cache
def large_glides() -> tuple[re.Pattern, dict[str, str]]:
    """Glides written in large kana, drawn out or not, as one more way to read these kana."""
    table = {}
    for i in ROW_I.replace("　", "").replace("い", ""):
        for y, small in zip("やゆよ", "ゃゅょ", strict=True):
            table[i + y] = _glide(i, small)
            if y != "や":
                table[i + y + "う"] = _glide(i, small) + "う"
    return re.compile("|".join(sorted(table, key=len, reverse=True))), table


def _options(s: str, i: int, kango: bool, first_segment: bool) -> list[tuple[int, list[str]]]:
    table = rules(kango, i > 0)
    old = next((s[i : i + n] for n in (3, 2, 1) if s[i : i + n] in table), None)
    if old is not None:
        out = [(len(old), table[old])]
    else:
        out = [(1, next((new[s[i]] for where, new in contextual(kango, first_segment) if where.match(s, i)), [s[i]]))]
    pattern, glides = large_glides()
    large = pattern.match(s, i)
    return [*out, (len(large[0]), [glides[large[0]]])] if large else out


def _segment(s: str, kango: bool, first: bool) -> list[str]:
    out: dict[str, None] = {}
    stack = [(0, "")]
    while stack and len(out) < MOST_VARIANTS:
        i, done = stack.pop()
        if i >= len(s):
            out.setdefault(done)
            continue
        stack.extend(reversed([(i + n, done + r) for n, rs in _options(s, i, kango, first) for r in rs]))
    return list(out)


def spelling_variants(reading: str, kango: bool = False) -> list[str]:
    """Modern spellings of a historical one, the usual one first; separators bound segments and go."""
    for sep in "・=＝":
        reading = reading.replace(sep, "-")
    words = [""]
    for k, s in enumerate(x for x in reading.split("-") if x):
        parts = _segment(s, kango, k == 0)
        words = [a + b for a in words for b in parts][:MOST_VARIANTS]
    return list(dict.fromkeys(words))


@F.pandas_udf(ArrayType(StringType()))
def modern_variants(reading: pd.Series, kango: pd.Series) -> pd.Series:
    return pd.Series([None if r is None else spelling_variants(r, bool(k)) for r, k in zip(reading, kango, strict=True)])


# Kana of like shapes; those that both readers mistake; separators misread as these.
CONFUSABLE = ("あのめおわぬ", "いりこ", "うらちつ", "しくつ", "さきち", "はほけにば", "たなだ", "てそで", "ひびぴん", "まもよ", "ねれわ", "すおず", "かやが")
SYSTEMATIC = ("うらつ", "きさ", "あのめ")
MISREAD_SEPARATOR = "しら"


@cache
def confusable_map(groups: tuple[str, ...] = CONFUSABLE) -> dict[str, str]:
    """Each kana with those that it may be mistaken for, in order: groups, voiced, half-voiced, plain."""
    out = {}
    for c in HIRAGANA:
        near = [x for g in groups if c in g for x in g]
        near += [t[s.index(c)] for s, t in ((PLAIN, VOICED), (H_PLAIN, H_HALF)) if c in s]
        near.append(unicodedata.normalize("NFD", c)[0])
        out[c] = "".join(dict.fromkeys(x for x in near if x != c))
    return out


def repairs(reading: Column, groups: tuple[str, ...] = CONFUSABLE) -> Column:
    """All readings with one kana replaced by one of like shape, or a separator read as one put back."""
    table = F.create_map(*[F.lit(x) for k, v in confusable_map(groups).items() if v for x in (k, v)])
    head = lambda i: F.substring(reading, F.lit(1), i - 1)
    tail = lambda i: F.substring(reading, i + 1, F.length(reading))

    def at(i: Column) -> Column:
        c = F.substring(reading, i, F.lit(1))
        near = F.filter(F.split(F.coalesce(F.try_element_at(table, c), F.lit("")), ""), lambda x: F.length(x) > 0)
        put = F.when(F.lit(MISREAD_SEPARATOR).contains(c) & (i > 1) & (i < F.length(reading)), F.array(F.lit("-"))).otherwise(F.array().cast("array<string>"))
        return F.transform(F.concat(near, put), lambda x: F.concat(head(i), x, tail(i)))

    every = F.flatten(F.transform(F.sequence(F.lit(1), F.greatest(F.length(reading), F.lit(1))), at))
    return F.array_except(F.array_distinct(every), F.array(reading))
