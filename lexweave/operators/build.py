"""From clean entries to dictionaries: verified, those of them that the base lexicon lacks, and unverified, in two encodings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexweave.operators import dictionary
from lexweave.sources import sinks

#: Dictionaries in the order of their files.
NAMES = ("verified", "noL", "unverified")
ENCODINGS = ("utf-8", "euc-jp")


def dictionaries(clean: DataFrame, base: DataFrame) -> DataFrame:
    """(dictionary, section, key, word, note, ord): accepted entries under verified, and under noL what the base lexicon lacks; unverified ones apart."""
    x = clean.where(F.col("status").isin("accepted", "unverified"))
    routed = F.when(F.col("status") == "accepted", F.lit("verified")).otherwise(F.lit("unverified"))
    # notes are joined within a dictionary: its name goes with the key until then
    rows = dictionary.dictionary_words(x.withColumn("skk_key", F.concat(routed, F.lit("\t"), "skk_key")))
    split = F.split("key", "\t")
    words = dictionary.entries(rows).withColumn("dictionary", split[0]).withColumn("key", split[1])
    missing = dictionary.without_lexicon(words.where("dictionary = 'verified'"), base).withColumn("dictionary", F.lit("noL"))
    columns = ["dictionary", "section", "key", "word", "note", "ord"]
    return words.select(*columns).unionByName(missing.select(*columns))


def in_no_lexicon(clean: DataFrame, base: DataFrame) -> DataFrame:
    """Ids of accepted entries of which some spelling isn't in the base lexicon under the entry's key."""
    words = dictionary.dictionary_words(clean.where("status = 'accepted'").withColumn("skk_key", F.concat("id", F.lit("\t"), "skk_key")))
    split = F.split("key", "\t")
    words = words.withColumn("id", split[0]).withColumn("key", split[1])
    return dictionary.without_lexicon(words, base).select("id").distinct()


def sizes(words: DataFrame) -> DataFrame:
    """(dictionary, ari, nasi, words): keys by section, and words, of what `dictionaries` gives."""
    keys = words.groupBy("dictionary", "section", "key").agg(F.count("*").alias("n"))
    return keys.groupBy("dictionary").agg(F.count_if(F.col("section") == "ari").alias("ari"), F.count_if(F.col("section") == "nasi").alias("nasi"), F.sum("n").alias("words"))


def header(title: str, description: str, n: int, encoding: str) -> list[str]:
    return [f";; -*- mode: fundamental; coding: {encoding} -*-", f";; {title}", f";; {description}", f";; {n} entries"]


def write(clean: DataFrame, base: DataFrame, path: str, title: str, description: str) -> dict[tuple[str, str], int]:
    """Write every dictionary in both encodings under path/<dictionary>.<encoding>; gives the number of words each lacks.

    The second encoding leaves out keys and words that it doesn't have.
    """
    words, dropped = dictionaries(clean, base).persist(), {}
    for name in NAMES:
        own = words.where(F.col("dictionary") == name).drop("dictionary")
        for encoding in ENCODINGS:
            kept, n_dropped = own, 0
            if encoding == "euc-jp":
                kept, lost = sinks.encodable_entries(own)
                n_dropped = lost.first()["dropped"] or 0
            n = kept.select("section", "key").distinct().count()
            sinks.write_text(sinks.dictionary_text(kept, header(f"{title}.{name}", description, n, encoding)), f"{path}/{name}.{encoding}")
            dropped[name, encoding] = n_dropped
    words.unpersist()
    return dropped


def write_volume(clean: DataFrame, path: str, stage: str) -> None:
    """A stage's entries as one Parquet folder for each volume, replaced as a whole."""
    clean.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("pid").parquet(f"{path}/{stage}")


def draw_by_stratum(strata: DataFrame, n: int, seed: Column | int) -> DataFrame:
    """n entries of each stratum (see stages.in_strata) in hash order, numbered from 1, and the stratum's size.

    The same entries come for the same seed, however the rows are dealt.
    """
    seed = F.lit(seed) if isinstance(seed, int) else seed
    per = strata.groupBy("stratum").agg(F.count("*").alias("total"), F.array_sort(F.collect_list(F.struct(F.xxhash64("id", seed).alias("h"), "id"))).alias("x"))
    return per.select("stratum", "total", F.posexplode(F.slice("x", 1, n)).alias("no", "x")).select("stratum", "total", (F.col("no") + 1).alias("no"), "x.id")
