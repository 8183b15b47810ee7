"""Page sources: image manifests, full texts with nested coordinates, OCR layout XML, and one line table of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

COORDS = "array<struct<contenttext: string, xmin: int, ymin: int, xmax: int, ymax: int>>"


def canvases(manifest_json: DataFrame) -> DataFrame:
    """(pid, frame, page_width, page_height, image_url) from (pid, json): frames count from 1."""
    kind = "struct<sequences: array<struct<canvases: array<struct<width: int, height: int, images: array<struct<resource: struct<`@id`: string>>>>>>>>"
    x = manifest_json.select("pid", F.from_json("json", kind).alias("m")).select("pid", F.posexplode(F.get("m.sequences", F.lit(0))["canvases"]).alias("i", "c"))
    return x.select("pid", (F.col("i") + 1).alias("frame"), F.col("c.width").alias("page_width"), F.col("c.height").alias("page_height"), F.get("c.images", F.lit(0))["resource"]["@id"].alias("image_url"))


def is_public(item_json: Column) -> Column:
    return F.get_json_object(item_json, "$.item.permission.type") == "internet"


def coordinates(coordjson: Column) -> Column:
    """The JSON list inside the JSON; an empty string is an empty list."""
    return F.coalesce(F.from_json(F.when(coordjson != "", coordjson), COORDS), F.array().cast(COORDS))


def full_text_lines(pages: DataFrame, canvas: DataFrame) -> DataFrame:
    """Lines of full-text pages (pid, page, coordjson), with their canvas' size where there is one."""
    x = pages.select("pid", F.col("page").alias("frame"), F.posexplode_outer(coordinates(F.col("coordjson"))).alias("line_idx", "c"))
    x = x.join(canvas.select("pid", "frame", "page_width", "page_height"), ["pid", "frame"], "left")
    w, h = F.col("c.xmax") - F.col("c.xmin"), F.col("c.ymax") - F.col("c.ymin")
    return x.select(
        "pid", "frame", "page_width", "page_height", "line_idx", F.col("c.contenttext").alias("text"), F.col("c.xmin").alias("x"), F.col("c.ymin").alias("y"),
        w.alias("width"), h.alias("height"), F.lit(None).cast("double").alias("conf"), F.lit(None).cast("string").alias("type"),
    )


def unescape(c: Column) -> Column:
    """Named and numbered entities as characters; & last."""
    named = {"&quot;": '"', "&apos;": "'", "&lt;": "<", "&gt;": ">"}

    def numbers(text: Column, pattern: str, head: str, to_hex) -> Column:
        put = lambda s, d: F.replace(s, F.concat(F.lit(head), d, F.lit(";")), F.decode(F.unhex(F.lpad(to_hex(d), 8, "0")), "UTF-32"))
        return F.aggregate(F.array_distinct(F.regexp_extract_all(c, F.lit(pattern), F.lit(1))), text, put)

    out = numbers(c, "&#x([0-9a-fA-F]+);", "&#x", lambda d: d)
    out = numbers(out, "&#([0-9]+);", "&#", lambda d: F.hex(d.cast("long")))
    for name, to in named.items():
        out = F.replace(out, F.lit(name), F.lit(to))
    return F.replace(out, F.lit("&amp;"), F.lit("&"))


def layout_lines(files: DataFrame) -> DataFrame:
    """Lines of OCR layout XML (pid, xml): one page or more a file, in ORDER where every line of a page has one.

    The page's number is the digits of its image's name.
    """
    attr = lambda s, name, kind="string": F.nullif(F.regexp_extract(s, f'(?:^|\\s){name}="([^"]*)"', 1), F.lit("")).cast(kind)
    page = F.regexp_extract_all("xml", F.lit("(?s)<PAGE\\b.*?</PAGE>"), F.lit(0))
    x = files.select("pid", F.explode(page).alias("p")).withColumn("head", F.regexp_extract("p", "<PAGE\\b([^>]*)>", 1))
    tags = F.regexp_extract_all("p", F.lit("<LINE\\b([^>]*?)/?>"), F.lit(1))
    lines = F.transform(tags, lambda s, i: F.struct(
        i.alias("pos"), attr(s, "ORDER", "int").alias("order"), unescape(F.coalesce(attr(s, "STRING"), F.lit(""))).alias("text"), attr(s, "TYPE").alias("type"),
        *[F.coalesce(attr(s, k.upper(), "int"), F.lit(0)).alias(k) for k in ("x", "y", "width", "height")], attr(s, "CONF", "double").alias("conf")))
    x = x.withColumn("lines", lines)
    ordered = F.forall("lines", lambda s: s["order"].isNotNull())
    key = lambda s: F.struct(F.when(ordered, s["order"]).otherwise(s["pos"]).alias("k"), s["pos"].alias("pos"), s.alias("line"))
    sorted_lines = F.transform(F.array_sort(F.transform("lines", key)), lambda s: s["line"])
    image = attr(F.col("head"), "IMAGENAME")
    x = x.select("pid", image.alias("image_name"), attr(F.col("head"), "WIDTH", "int").alias("page_width"), attr(F.col("head"), "HEIGHT", "int").alias("page_height"), F.posexplode(sorted_lines).alias("line_idx", "l"))
    frame = F.regexp_extract("image_name", "R([0-9]{7})", 1).try_cast("int")
    return x.select("pid", frame.alias("frame"), "image_name", "page_width", "page_height", "line_idx", "l.text", "l.x", "l.y", "l.width", "l.height", "l.conf", "l.type")
