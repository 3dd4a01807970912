"""Retrieval chunks: overlapping splits, Markdown units, chunk tables."""

from __future__ import annotations

import re
from bisect import bisect_right

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import window as W

from ..functions import text as tx
from ..session import cut

# Characters of a chunk, of the overlap, and least characters.
MOST, OVERLAP, LEAST = 900, 150, 40
CRUMB = " › "
# End of fixed values.


def split_text(text: str, most: int = MOST, overlap: int = OVERLAP, least: int = LEAST) -> list[str]:
    """Pieces of a long text, cut behind the last sentence end in reach and overlapping; a short text whole."""
    if len(text) <= most:
        return [text] * (len(text) >= least)
    ends = [m.start() for m in re.finditer("[.;] ", text)]
    pieces, at = [], 0
    while at < len(text):
        stop = at + most
        last = bisect_right(ends, stop - 2) - 1
        if stop < len(text) and last >= 0 and ends[last] > at + least:
            stop = ends[last] + 1
        stop = min(stop, len(text))
        pieces.append(text[at:stop].strip())
        at = stop - overlap if stop - at > overlap else stop
    return [p for p in pieces if len(p) >= least]


@F.pandas_udf(T.ArrayType(T.StringType()))
def _split(text: pd.Series) -> pd.Series:
    return text.map(split_text, na_action="ignore")


def split_long(text: Column) -> Column:
    """Pieces of a cleaned text; texts of at most MOST characters never leave the JVM."""
    long = F.length(text) > MOST
    return F.when(long, _split(F.when(long, text))).when(F.length(text) >= LEAST, F.array(text)).otherwise(F.array().cast("array<string>"))


def markdown_units(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``(key, unit, heading, body)``: the lines under each heading; tables, images and tags are left out."""
    lines = docs.select(key, F.posexplode(F.split(text, r"\r\n|[\n\r\x0B\x0C\x1C-\x1E\x{85}\x{2028}\x{2029}]")).alias("at", "line"))
    lines = lines.withColumn("line", F.regexp_replace("line", r"(?U)^\s+|\s+$", ""))
    mark = F.regexp_extract("line", r"(?U)^#{1,6}\s+(.*)$", 1)
    is_heading = F.col("line").rlike(r"(?U)^#{1,6}\s+.*$")
    upto = W.Window.partitionBy(key).orderBy("at").rowsBetween(W.Window.unboundedPreceding, 0)
    noted = lines.withColumn("h", is_heading).withColumn("unit", F.sum(F.col("h").cast("int")).over(upto)).withColumn("mark", F.when(F.col("h"), mark))
    kept = F.when(~F.col("h") & (F.col("line") != "") & ~F.col("line").rlike(r"^[|!<]"), F.struct("at", "line"))
    units = noted.groupBy(key, "unit").agg(F.max("mark").alias("heading"), F.array_sort(F.collect_list(kept)).alias("parts"))
    body = F.array_join(F.transform("parts", lambda p: p["line"]), " ")
    return units.where(F.size("parts") > 0).select(key, F.col("unit").cast("int").alias("unit"), F.coalesce("heading", F.lit("")).alias("heading"), body.alias("body"))


def uncovered_units(units: DataFrame, sections: DataFrame, module: str = "module") -> DataFrame:
    """Units whose heading isn't the title of a section of the same module; units without a heading stay."""
    titles = sections.select(F.col("module").alias(module), tx.norm_title(F.col("title")).alias("norm")).where("norm <> ''").distinct()
    noted = units.withColumn("norm", tx.norm_title(F.col("heading")))
    return noted.where("norm <> ''").join(titles, [module, "norm"], "left_anti").unionByName(noted.where("norm = ''")).drop("norm")


def chunks(units: DataFrame) -> DataFrame:
    """Chunks of ``units(module, kind, section_id, title, page, text, ord)``: pieces with breadcrumb and embedding text."""
    cleaned = units.withColumn("body", tx.chunk_clean(F.col("text"))).where(F.length("body") >= LEAST).withColumn("title", tx.chunk_clean(F.col("title")))
    crumbs = F.array_join(F.filter(F.array("module", "title"), lambda x: x != ""), CRUMB)
    rows = cleaned.withColumn("breadcrumb", crumbs).select("*", F.posexplode(split_long(F.col("body"))).alias("piece", "piece_text"))
    embed = F.when(F.col("breadcrumb") != "", F.concat("breadcrumb", F.lit(CRUMB), F.col("piece_text"))).otherwise(F.col("piece_text"))
    return rows.select("module", "kind", "section_id", "title", "page", "ord", "piece", "breadcrumb", F.col("piece_text").alias("text"), embed.alias("embed_text"))


KINDS = ("section", "algorithm", "register", "enum", "table", "markdown")


def units(kb: dict[str, DataFrame], ords: dict[str, str | list[str]], markdown: DataFrame | None = None) -> DataFrame:
    """Units for ``chunks`` of the sections, algorithms, registers, enums and tables of ``kb``, and of ``markdown(module,
    heading, body, ord)``. ``ords`` names what orders the rows of a collection; several columns are numbered."""
    e = F.lit("")
    parts = {
        "sections": ("section", lambda: F.col("title"), lambda: F.col("text")),
        "algorithms": ("algorithm", lambda: F.coalesce(F.nullif("caption", e), "sub_type"), lambda: F.col("text")),
        "registers": ("register", lambda: F.col("register_name"), lambda: tx.register_text(F.col("register_name"), F.col("address"), F.col("description"), F.col("bit_fields"))),
        "enums": ("enum", lambda: F.col("name"), lambda: tx.enum_text(F.col("name"), F.col("values"))),
        "tables": ("table", lambda: F.col("caption"), lambda: tx.table_text(F.col("header"), F.col("rows"))),
    }
    out = None
    for name, (kind, title, text) in parts.items():
        if name not in kb:
            continue
        order = ords[name]
        rows = kb[name] if isinstance(order, str) else numbered(kb[name], order, "_ord")
        at = F.col(order if isinstance(order, str) else "_ord").cast("long")
        each = rows.select("module", F.lit(kind).alias("kind"), "section_id", title().alias("title"), F.col("page").cast("int").alias("page"), text().alias("text"), at.alias("ord"))
        out = each if out is None else out.unionByName(each)
    if markdown is not None:
        each = markdown.select("module", F.lit("markdown").alias("kind"), e.alias("section_id"), F.col("heading").alias("title"), F.lit(None).cast("int").alias("page"), F.col("body").alias("text"), F.col("ord").cast("long").alias("ord"))
        out = each if out is None else out.unionByName(each)
    return out


def kind_order(kind: str = "kind") -> Column:
    """Place of a chunk's source among KINDS."""
    return F.array_position(F.array(*map(F.lit, KINDS)), F.col(kind)).cast("int")


def numbered(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """``rows`` numbered from 0 in ``order``, without one task for all: range partitions counted, then offset."""
    parts = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    noted = cut(parts.withColumn("_id", F.monotonically_increasing_id()))
    part, at = F.shiftright("_id", 33), F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = noted.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("n"))
    before = W.Window.orderBy("_part").rowsBetween(W.Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_offset"))  # one row a partition
    return noted.withColumn("_part", part).join(F.broadcast(offsets), "_part").withColumn(name, F.col("_offset") + at).drop("_id", "_part", "_offset")
