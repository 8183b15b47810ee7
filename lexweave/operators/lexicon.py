"""What the lexicons teach: voicing by place, further readings of characters, and merged character tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexweave.functions import align, kana

HAN_ONLY = "^[\\p{IsHan}々]+$"


def voicing_class(c: Column) -> Column:
    """plain, voiced or semi of the first kana; null of those that have no voiced form."""
    first = F.substring(c, 1, 1)
    of = lambda chars: F.lit(chars).contains(first) & (F.length(first) > 0)
    return F.when(of(kana.VOICED), "voiced").when(of(kana.H_HALF), "semi").when(of(kana.PLAIN), "plain")


def context(previous: Column) -> Column:
    """What the kana before says of voicing."""
    return F.when(previous.isNull(), "head").when(previous == "ん", "n").when(previous == "っ", "tsu").otherwise("other")


def word_pairs(lexicon: DataFrame, forms: DataFrame | None) -> DataFrame:
    """Distinct (word, reading) of the base lexicon's section nasi and of modern readings of the other."""
    a = lexicon.where("section = 'nasi'").select("word", F.col("key").alias("reading"))
    return (a if forms is None else a.unionByName(forms.where("NOT old").select(F.col("kanji").alias("word"), "reading"))).distinct()


def _segments(pairs: DataFrame, readings: align.Readings, word: str, most_left: int = 0) -> DataFrame:
    """(word, reading, pos, ch, kana, base, class, context) of the pairs that fit."""
    x = pairs.withColumn("_s", align.segment_udf(readings, most_left)(word, "reading")).where("_s IS NOT NULL")
    last = F.transform("_s", lambda s: F.substring(s["kana"], -1, 1))
    x = x.select("*", F.posexplode(F.arrays_zip("_s", F.concat(F.array(F.lit(None).cast("string")), last).alias("before"))).alias("pos", "z")).drop("_s")
    x = x.where("z._s IS NOT NULL").withColumn("ch", F.col("z._s.ch")).withColumn("kana", F.col("z._s.kana"))
    return x.withColumn("class", voicing_class(F.col("kana"))).withColumn("context", context(F.col("z.before"))).withColumn("base", kana.unvoiced_head(F.col("kana"))).drop("z")


def reading_stats(lexicon: DataFrame, forms: DataFrame | None, readings: align.Readings) -> DataFrame:
    """(ch, base, context, plain, voiced, semi): how often a character's reading is voiced at such a place."""
    pairs = word_pairs(lexicon, forms).where(F.col("word").rlike(HAN_ONLY) & (F.length("word") >= 2))
    x = _segments(pairs, readings, "word").where("class IS NOT NULL")
    return x.groupBy("ch", "base", "context").agg(*[F.count_if(F.col("class") == c).alias(c) for c in ("plain", "voiced", "semi")])


def voicing_anomalies(entries: DataFrame, stats: DataFrame, readings: align.Readings, least_other: int = 3) -> DataFrame:
    """(id, ch, kana, class) of entries (id, notation, reading) whose voicing never occurs at such a place while others do."""
    one, more = entries.where("length(notation) = 1"), entries.where("length(notation) <> 1")
    x = _segments(one, readings, "notation", 1).unionByName(_segments(more, readings, "notation")).where("class IS NOT NULL AND context <> 'other'")
    y = x.join(stats, ["ch", "base", "context"])
    own = F.when(F.col("class") == "plain", F.col("plain")).when(F.col("class") == "voiced", F.col("voiced")).otherwise(F.col("semi"))
    return y.where((own == 0) & (F.col("plain") + F.col("voiced") + F.col("semi") >= least_other)).select("id", "ch", "kana", "class")


# What an h-row kana became inside words.
_H_TWIN = {"わ": "は", "い": "ひ", "う": "ふ", "え": "へ", "お": "ほ"}


def h_twin(reading: Column) -> Column:
    """The reading with the h-row kana that its first one may have come from; null if there is none."""
    table = F.create_map(*[F.lit(x) for p in _H_TWIN.items() for x in p])
    return F.concat(F.try_element_at(table, F.substring(reading, 1, 1)), F.substring(reading, F.lit(2), F.length(reading)))


def learned_readings(pairs: DataFrame, readings: align.Readings, least_words: int = 3) -> DataFrame:
    """(ch, reading, words): readings that several words need and the table lacks.

    From words of one character and okurigana, and from words of two to four
    characters of which all but one can be read in just one way. A reading
    whose h-row twin is known goes.
    """
    aligner = align.Aligner(readings)

    def gaps(word: str, reading: str) -> list[dict]:
        if aligner.segment(word, reading) is not None:
            return []
        out = []
        for i, ch in enumerate(word):
            fits = lambda part, sound: aligner.segment(part, sound) is not None if part else not sound
            spans = {(a, b) for a in range(len(reading) + 1) if fits(word[:i], reading[:a]) for b in range(a + 1, min(len(reading), a + 4) + 1) if fits(word[i + 1 :], reading[b:])}
            if len(spans) == 1:
                a, b = spans.pop()
                out.append({"ch": ch, "reading": reading[a:b]})
        return out

    @F.pandas_udf("array<struct<ch: string, reading: string>>")
    def open_gaps(word, reading):
        import pandas as pd

        return pd.Series([gaps(w, r) for w, r in zip(word, reading, strict=True)])

    tail = F.regexp_extract("word", "^[\\p{IsHan}]([ぁ-ゖ]+)$", 1)
    single = pairs.withColumn("_t", tail).where((F.col("_t") != "") & F.endswith("reading", "_t") & (F.length("reading") > F.length("_t")))
    single = single.select("word", F.substring("word", 1, 1).alias("ch"), F.substring("reading", F.lit(1), F.length("reading") - F.length("_t")).alias("reading"))
    several = pairs.where(F.col("word").rlike("^[\\p{IsHan}]{2,4}$")).select("word", F.explode(open_gaps("word", "reading")).alias("g")).select("word", "g.ch", "g.reading")
    found = single.unionByName(several).where(F.col("reading").rlike("^[ぁ-ゖ]{1,4}$") & ~F.col("reading").rlike("^[ぁぃぅぇぉゃゅょっんゎ]"))
    spark = pairs.sparkSession
    known = spark.createDataFrame([(c, r) for c, (on, kun) in readings.items() for r in dict.fromkeys([*on, *kun])], "ch string, reading string")
    found = found.join(known, ["ch", "reading"], "left_anti").groupBy("ch", "reading").agg(F.count_distinct("word").alias("words"))
    every = known.unionByName(found.select("ch", "reading")).select("ch", F.col("reading").alias("_twin")).distinct()
    return found.where(F.col("words") >= least_words).withColumn("_twin", h_twin(F.col("reading"))).join(every, ["ch", "_twin"], "left_anti").select("ch", "reading", "words")


def merge_characters(own: DataFrame, other: DataFrame, names: bool = False) -> DataFrame:
    """(ch, kind, reading) of two tables. Of the second, voiced forms of a known plain reading don't count, nor those that begin with ぢ or づ.

    A character that the second knows by native readings only has no Sino-Japanese ones.
    """
    second = other.where(F.col("kind").isin("on", "kun") | F.lit(names)).withColumn("kind", F.when(F.col("kind") == "nanori", "kun").otherwise(F.col("kind")))
    plain = own.unionByName(other.where("kind <> 'nanori'")).select("ch", F.col("reading").alias("_plain")).distinct()
    new = second.join(own, ["ch", "kind", "reading"], "left_anti").withColumn("_plain", kana.unvoiced_head(F.col("reading")))
    voiced = new.where("_plain <> reading").join(plain, ["ch", "_plain"], "left_semi").select("ch", "kind", "reading")
    kept = new.where(~F.col("reading").rlike("^[ぢづ]")).select("ch", "kind", "reading").join(voiced, ["ch", "kind", "reading"], "left_anti")
    kinds = other.where("kind IN ('on', 'kun')").groupBy("ch").agg(F.count_if(F.col("kind") == "on").alias("n_on"), F.count_if(F.col("kind") == "kun").alias("n_kun"))
    no_on = kinds.where("n_on = 0 AND n_kun > 0").select("ch", F.lit("on").alias("kind"))
    return own.select("ch", "kind", "reading").unionByName(kept).distinct().join(no_on, ["ch", "kind"], "left_anti")


def part_words(words: DataFrame, word: str, least: int = 2) -> DataFrame:
    """(word, part, place) of all head, tail and inner parts of at least `least` characters; the whole is a head and a tail."""
    n = F.length(word)
    part = lambda a, b: F.substring(word, a, b - a + 1)
    span = lambda a, b: F.when(b >= a, F.sequence(a, b)).otherwise(F.array().cast("array<int>"))
    head = F.transform(span(F.lit(least), n), lambda b: F.struct(part(F.lit(1), b).alias("part"), F.lit("head").alias("place")))
    tail = F.transform(span(F.lit(1), n - least + 1), lambda a: F.struct(part(a, n).alias("part"), F.lit("tail").alias("place")))
    inner = F.flatten(F.transform(span(F.lit(2), n - least), lambda a: F.transform(span(a + least - 1, n - 1), lambda b: F.struct(part(a, b).alias("part"), F.lit("mid").alias("place")))))
    return words.select(word, F.explode(F.concat(head, tail, inner)).alias("_p")).select(word, "_p.part", "_p.place").distinct()


def window_context(segments: DataFrame) -> DataFrame:
    """(pair, pos, context) from (pair, pos, kana), by a window instead of an array."""
    return segments.select("pair", "pos", context(F.lag(F.substring("kana", -1, 1)).over(Window.partitionBy("pair").orderBy("pos"))).alias("context"))
