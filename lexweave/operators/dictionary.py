"""Grouped dictionaries: keys to words to notes, each in order of first appearance, and what a base lexicon already has."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexweave.functions import kana

# Word classes and their labels.
POS_LABELS = {"noun": "名", "pronoun": "代", "numeral": "数", "adjective": "形", "adverb": "副", "makura": "枕", "interjection": "感", "conjunction": "接", "prefix": "接頭", "suffix": "接尾"}


def pos_label(pos: Column) -> Column:
    """Labels of all classes, joined; a verb's is the beginning of its raw label."""
    verb = F.regexp_extract(pos["raw"], "^(自動|他動)", 1)
    table = F.create_map(*[F.lit(x) for p in POS_LABELS.items() for x in p])
    one = lambda c: F.when(c == "verb", F.when(verb != "", verb).otherwise("動")).otherwise(F.coalesce(F.try_element_at(table, c), F.lit("")))
    return F.array_join(F.filter(F.transform(pos["categories"], one), lambda x: x != ""), "・")


def historical(reading: Column, modern: Column) -> Column:
    """The old reading where it differs from the modern one, else empty."""
    bare = kana.without_separators(reading)
    return F.when(bare == modern, "").otherwise(bare)


def note(old: Column, labels: Column) -> Column:
    """`old（a・b）`; labels: array, empty ones don't count."""
    own = F.array_join(F.filter(labels, lambda x: x != ""), "・")
    return F.concat(old, F.when(own != "", F.concat(F.lit("（"), own, F.lit("）"))).otherwise(""))


def annotation(reading: Column, modern: Column, pos: Column) -> Column:
    return note(historical(reading, modern), F.array(pos_label(pos)))


def _in_order(df: DataFrame, keys: list[str], value: str, out: str) -> DataFrame:
    """Distinct values of each key as an array, by their smallest ord; adds the key's own smallest ord."""
    one = df.groupBy(*keys, value).agg(F.min("ord").alias("ord"))
    packed = F.array_sort(F.collect_list(F.struct("ord", value)))
    return one.groupBy(*keys).agg(F.transform(packed, lambda x: x[value]).alias(out), F.min("ord").alias("ord"))


def entries(words: DataFrame) -> DataFrame:
    """(section, key, word, note, ord) from rows (section, key, word, historical, label, ord)."""
    labels = _in_order(words, ["section", "key", "word", "historical"], "label", "labels")
    notes = labels.withColumn("note", note(F.col("historical"), F.col("labels"))).where("note <> ''")
    joined = _in_order(notes, ["section", "key", "word"], "note", "notes").select("section", "key", "word", F.array_join("notes", "、").alias("note"))
    first = words.groupBy("section", "key", "word").agg(F.min("ord").alias("ord"))
    return first.join(joined, ["section", "key", "word"], "left").withColumn("note", F.coalesce("note", F.lit("")))


def dictionary_words(clean: DataFrame) -> DataFrame:
    """Rows of `entries` from clean entries: every spelling under the key. ord: the entry's order."""
    spellings = F.array_distinct(F.concat(F.array("shinjitai", "notation"), F.coalesce("alt_notations", F.array().cast("array<string>"))))
    x = clean.where("skk_key IS NOT NULL AND shinjitai IS NOT NULL AND notation IS NOT NULL").select(
        F.when(F.coalesce("okuri", F.lit(False)), "ari").otherwise("nasi").alias("section"), F.col("skk_key").alias("key"),
        historical(F.col("reading"), F.col("modern")).alias("historical"), pos_label(F.col("pos")).alias("label"), "ord", F.posexplode(spellings).alias("_p", "word"),
    )
    return x.select("section", "key", "word", "historical", "label", F.struct("ord", "_p").alias("ord"))


def without_lexicon(words: DataFrame, lexicon: DataFrame) -> DataFrame:
    """Words that the lexicon (section, key, word) lacks under their key; in section nasi a word without its kana counts too."""
    bare = lexicon.where("section = 'nasi'").select("section", "key", kana.skeleton(F.col("word")).alias("word"))
    known = lexicon.select("section", "key", "word").unionByName(bare).distinct()
    return words.join(known, ["section", "key", "word"], "left_anti")


def grouped_lines(words: DataFrame, by_note_text: bool = False) -> DataFrame:
    """(key, line): `/word;note/word/` from rows (key, word, note, ord). by_note_text: a word's notes in text order, not in order of appearance."""
    if by_note_text:
        per = words.groupBy("key", "word").agg(F.array_join(F.array_sort(F.collect_set("note")), "・").alias("note"), F.min("ord").alias("ord"))
    else:
        per = words.groupBy("key", "word").agg(F.min_by("note", "ord").alias("note"), F.min("ord").alias("ord"))
    item = F.when(F.col("note") != "", F.concat("word", F.lit(";"), "note")).otherwise(F.col("word"))
    lines = per.withColumn("item", item).groupBy("key").agg(F.array_sort(F.collect_list(F.struct("ord", "item"))).alias("_i"))
    return lines.select("key", F.concat(F.lit("/"), F.array_join("_i.item", "/"), F.lit("/")).alias("line"))


def rendered(entry_rows: DataFrame) -> DataFrame:
    """(section, rank, line): section ari in falling, section nasi in rising order of keys.

    Rows are ranged by section and key; write them with a sort in one file, or
    as range-partitioned parts.
    """
    lines = grouped_lines(entry_rows.withColumn("key", F.concat("section", F.lit("\t"), "key")))
    return lines.select(F.split("key", "\t")[0].alias("section"), F.concat(F.split("key", "\t")[1], F.lit(" "), "line").alias("line"), F.split("key", "\t")[1].alias("key")).orderBy(
        "section", F.when(F.col("section") == "ari", F.col("key")).desc(), "key"
    ).select("section", "key", "line")
