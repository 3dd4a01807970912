"""Items of an alternative parser as a block stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def to_blocks(items: DataFrame) -> DataFrame:
    """``items(doc_file, pos, label, text, level, page_no, table_body, caption, img_uri)`` as blocks.

    Labels count without case, '_' as '-'. Pages become 0-based, at least 0. Blank texts and empty tables are left out;
    unknown labels are body text. A heading without a level has level 1.
    """
    label = F.replace(F.lower(F.coalesce("label", F.lit(""))), F.lit("_"), F.lit("-"))
    kind = (
        F.when(label.isin("page-header", "header"), "header").when(label.isin("page-footer", "footer"), "footer").when(label == "table", "table")
        .when(label.isin("picture", "image", "chart"), "image").when(label.isin("formula", "equation"), "equation").when(label == "code", "code").otherwise("text")
    )
    is_text = F.col("type").isin("text", "equation", "code")
    rows = items.withColumn("type", kind).where((is_text & F.coalesce(F.col("text").rlike(r"(?U)\S"), F.lit(False))) | F.col("type").isin("header", "footer", "image") | ((F.col("type") == "table") & (F.coalesce("table_body", F.lit("")) != "")))
    heading = label.isin("title", "section-header")
    when = lambda kinds, col: F.when(F.col("type").isin(*kinds), col)
    return rows.select(
        "doc_file", "pos", "type",
        when(("text", "header", "footer", "equation"), F.coalesce("text", F.lit(""))).alias("text"),
        F.when(heading & (F.col("type") == "text"), F.when(F.col("level") > 0, F.col("level")).otherwise(1)).alias("text_level"),
        F.greatest(F.coalesce(F.col("page_no") - 1, F.lit(0)), F.lit(0)).cast("int").alias("page_idx"),
        when(("table",), F.col("table_body")).alias("table_body"),
        when(("code",), F.col("text")).alias("code_body"),
        when(("code",), F.lit("code")).alias("sub_type"),
        when(("image",), F.array(F.coalesce("caption", F.lit("")))).alias("image_caption"),
        when(("image",), F.coalesce("img_uri", F.lit(""))).alias("img_path"),
    )
