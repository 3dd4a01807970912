"""Block streams to knowledge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from ..functions import tables as tb
from ..functions import text as tx
from ..profile import DROPPED_TYPES, Profile
from ..session import cut

#: Positions of a document that one task reads in order.
SPAN = 512
CONTEXT = 600


def latest_blocks(blocks: DataFrame) -> DataFrame:
    """Blocks delivered more than once, once."""
    return blocks.dropDuplicates(["block_id"])


def forward_fill(df: DataFrame, key: str, order: str, columns: list[str], span: int = SPAN) -> DataFrame:
    """``df`` with ``last_<column>``: the last value that isn't null at or before the row within ``key``.

    Rows are read in order within spans of ``span`` positions; what a span inherits comes from one row a span, so a key
    that holds a third of all rows is split over many tasks.
    """
    rows = df.withColumn("span", F.floor(F.col(order) / span))
    each = rows.groupBy(key, "span").agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(f"own_{c}") for c in columns])
    before = W.Window.partitionBy(key).orderBy("span").rowsBetween(W.Window.unboundedPreceding, -1)
    heirs = each.select(key, "span", *[F.last(f"own_{c}", True).over(before).alias(f"old_{c}") for c in columns])
    within = W.Window.partitionBy(key, "span").orderBy(order).rowsBetween(W.Window.unboundedPreceding, 0)
    filled = rows.select("*", *[F.last(c, True).over(within).alias(f"new_{c}") for c in columns]).join(heirs, [key, "span"], "left")
    return filled.select(*df.columns, *[F.coalesce(f"new_{c}", f"old_{c}").alias(f"last_{c}") for c in columns])


def annotate(blocks: DataFrame, profile: Profile = Profile()) -> DataFrame:
    """Blocks in reading order with their role, section and register anchor.

    ``role`` is ``anchor``, ``heading`` or ``body`` for text, else the type. A text that is a register name, or has one
    among at most eight words outside a heading, is an anchor and nothing else; a heading with a register name anchors
    too; anchors outlast headings. Dropped types and empty texts are left out.
    """
    kept = blocks.where(~F.col("type").isin(*DROPPED_TYPES))
    text = F.when(F.col("type") == "text", tx.strip_noise(tx.clean_text(F.col("text")), profile))
    rows = kept.withColumn("clean", text).where("type <> 'text' OR clean <> ''")
    whole = tx.is_register_name(F.col("clean"), profile)
    heading = F.coalesce(F.col("text_level"), F.lit(0)) != 0
    token = F.nullif(tx.register_token(F.col("clean"), profile), F.lit(""))
    rows = rows.withColumn("token", F.when(F.col("type") == "text", F.when(whole, tx.normalize_ocr(F.col("clean"))).otherwise(token)))
    short = F.size(F.split("clean", " ")) <= 8
    role = F.when(F.col("type") != "text", F.col("type")).when(whole, "anchor").when(heading, "heading").when(F.col("token").isNotNull() & short, "anchor").otherwise("body")
    rows = rows.withColumn("role", role)
    rows = rows.withColumn("anchor", F.when(F.col("role").isin("anchor", "heading"), F.col("token")))
    rows = rows.withColumn("section", F.when(F.col("role") == "heading", tx.section_id(F.col("module"), F.col("clean"))))
    filled = forward_fill(rows, "doc_file", "pos", ["section", "anchor"])
    return filled.withColumnRenamed("last_section", "section_id").withColumnRenamed("last_anchor", "register_anchor")


def headings(noted: DataFrame) -> DataFrame:
    """Module, title, level and page of each section's first heading."""
    heads = noted.where("role = 'heading'").groupBy("doc_file", F.col("section").alias("section_id")).agg(
        F.min_by(F.struct("module", F.col("clean").alias("title"), F.col("text_level").alias("level"), F.col("page_idx").alias("page")), "pos").alias("head"), F.min("pos").alias("ord")
    )
    return heads.select("doc_file", "ord", "section_id", "head.*")


def sections(noted: DataFrame) -> DataFrame:
    """Headings and their sections' body texts in order."""
    body = noted.where("role = 'body' AND section_id IS NOT NULL").groupBy("doc_file", "section_id").agg(F.array_sort(F.collect_list(F.struct("pos", "clean"))).alias("parts"))
    text = F.coalesce(F.array_join(F.transform("parts", lambda p: p["clean"]), " "), F.lit(""))
    return headings(noted).join(body, ["doc_file", "section_id"], "left").select("doc_file", "ord", "section_id", "module", "title", "level", "page", text.alias("text"))


def table_blocks(noted: DataFrame, profile: Profile = Profile()) -> DataFrame:
    """Table blocks with ``rows``, ``header`` and ``class``; those without rows are left out."""
    rows = noted.where("type = 'table' AND table_body <> ''").withColumn("rows", tb.html_rows(F.col("table_body"), profile)).where(F.size("rows") > 0)
    return rows.withColumn("header", F.get("rows", F.lit(0))).withColumn("class", tb.classify_table(F.col("header"), profile))


def _titled(rows: DataFrame, secs: DataFrame) -> DataFrame:
    titles = secs.select("doc_file", "section_id", F.col("title").alias("section_title"))
    return rows.join(titles, ["doc_file", "section_id"], "left").withColumn("section_title", F.coalesce("section_title", F.lit(""))).withColumn("section_id", F.coalesce("section_id", F.lit("")))


def registers(tables: DataFrame, secs: DataFrame, profile: Profile = Profile()) -> DataFrame:
    """Registers of a document: facts of the first bit-field table under its anchor, the fields of all, the last address."""
    fields = tables.where("class = 'bitfield' AND register_anchor IS NOT NULL").withColumn("fields", tb.bit_fields(F.col("rows"), profile))
    facts = F.struct("module", F.col("section_title").alias("description"), "section_id", F.col("page_idx").alias("page"))
    regs = _titled(fields, secs).groupBy("doc_file", F.col("register_anchor").alias("register_name")).agg(
        F.min_by(facts, "pos").alias("first"), F.array_sort(F.collect_list(F.struct("pos", "fields"))).alias("parts"), F.min("pos").alias("ord")
    )
    named = tables.where("class = 'summary'").select("doc_file", "pos", F.posexplode(tb.summary_rows(F.col("rows"), profile)).alias("row", "entry"))
    addresses = named.groupBy("doc_file", F.col("entry.register_name").alias("register_name")).agg(F.max_by("entry.address", F.struct("pos", "row")).alias("address"))
    return regs.join(addresses, ["doc_file", "register_name"], "left").select(
        "doc_file", "ord", "register_name", F.coalesce("address", F.lit("")).alias("address"), "first.*", F.flatten(F.transform("parts", lambda p: p["fields"])).alias("bit_fields")
    )


def enums(tables: DataFrame, secs: DataFrame, profile: Profile = Profile()) -> DataFrame:
    """Enums, named by the anchor if it ends as enum types do, else by the section's title, else by the anchor."""
    anchor = F.coalesce("register_anchor", F.lit(""))
    typed = F.array_contains(F.array(*[anchor.endswith(s) for s in profile.enum_suffixes]), True)
    rows = _titled(tables.where("class = 'enum'"), secs)
    name = F.when(typed, anchor).when(F.col("section_title") != "", F.col("section_title")).otherwise(anchor)
    return rows.select("doc_file", F.col("pos").alias("ord"), "module", name.alias("name"), "section_id", tb.enum_values(F.col("rows"), profile).alias("values"), F.col("page_idx").alias("page"))


def other_tables(tables: DataFrame, secs: DataFrame) -> DataFrame:
    body = F.slice("rows", 2, F.greatest(F.size("rows") - 1, F.lit(0)))
    return _titled(tables.where("class = 'other'"), secs).select(
        "doc_file", F.col("pos").alias("ord"), "module", "section_id", F.col("section_title").alias("caption"), "header", body.alias("rows"), F.col("page_idx").alias("page")
    )


def _either(a: str, b: str):  # noqa: ANN202
    return F.coalesce(F.nullif(F.col(a), F.lit("")), F.col(b))


def formulas(noted: DataFrame) -> DataFrame:
    rows = noted.where("type = 'equation'").withColumn("formula", tx.clean_text(_either("text", "latex"))).where("formula <> ''")
    return rows.select("doc_file", F.col("pos").alias("ord"), "module", F.coalesce("section_id", F.lit("")).alias("section_id"), F.col("formula").alias("latex"), F.col("page_idx").alias("page"))


def _caption(column: str):  # noqa: ANN202
    return F.array_join(F.transform(F.coalesce(column, F.array()), lambda c: tx.clean_text(c, entities=False)), " ")


def algorithms(noted: DataFrame) -> DataFrame:
    rows = noted.where("type = 'code'").withColumn("body", tx.clean_text(_either("code_body", "text"))).where("body <> ''")
    return rows.select(
        "doc_file", F.col("pos").alias("ord"), "module", F.coalesce("section_id", F.lit("")).alias("section_id"), F.coalesce("sub_type", F.lit("")).alias("sub_type"),
        _caption("code_caption").alias("caption"), F.col("body").alias("text"), F.col("page_idx").alias("page"),
    )


def figures(noted: DataFrame, secs: DataFrame) -> DataFrame:
    """Figures and charts with the beginning of their section's text as context."""
    rows = noted.where("type IN ('image', 'chart')").withColumn("section_id", F.coalesce("section_id", F.lit("")))
    texts = secs.select("doc_file", "section_id", F.col("text").alias("section_text"))
    joined = rows.join(texts, ["doc_file", "section_id"], "left")
    context = F.substring(F.trim(F.coalesce("section_text", F.lit(""))), 1, CONTEXT)
    return joined.select(
        "doc_file", F.col("pos").alias("ord"), "module", "section_id", _caption("image_caption").alias("caption"), tx.image_path(F.col("module"), F.col("img_path")).alias("img_path"),
        F.col("page_idx").alias("page"), context.alias("context"),
    )


COLLECTIONS = ("sections", "registers", "enums", "tables", "formulas", "algorithms", "figures")


def build_kb(blocks: DataFrame, profile: Profile = Profile(), wanted: tuple[str, ...] = COLLECTIONS) -> dict[str, DataFrame]:
    """The ``wanted`` knowledge tables of the documents in ``blocks``.

    Annotated blocks and parsed tables are written to the shared folder once, as each feeds several collections, with no
    more rows and columns than the wanted ones need; the collections themselves are lazy.
    """
    noted = annotate(latest_blocks(blocks), profile)
    columns = ["doc_file", "module", "pos", "page_idx", "type", "role", "clean", "text_level", "section", "section_id", "register_anchor", "table_body"]
    more = {"formulas": ["text", "latex"], "algorithms": ["text", "code_body", "sub_type", "code_caption"], "figures": ["image_caption", "img_path"]}
    columns += sorted({c for name in wanted for c in more.get(name, ())})
    kept = ["heading"] + (["body"] if {"sections", "figures"} & set(wanted) else [])
    others = {"formulas": ["equation"], "algorithms": ["code"], "figures": ["image", "chart"], "registers": ["table"], "enums": ["table"], "tables": ["table"]}
    kept += sorted({t for name in wanted for t in others.get(name, ())})
    noted = cut(noted.where(F.col("role").isin(kept)).select(*columns))
    heads = headings(noted)
    make = {"sections": lambda: sections(noted), "formulas": lambda: formulas(noted), "algorithms": lambda: algorithms(noted), "figures": lambda: figures(noted, sections(noted))}
    if {"registers", "enums", "tables"} & set(wanted):
        tables = cut(table_blocks(noted, profile).select("doc_file", "module", "pos", "page_idx", "section_id", "register_anchor", "rows", "header", "class"))
        make |= {"registers": lambda: registers(tables, heads, profile), "enums": lambda: enums(tables, heads, profile), "tables": lambda: other_tables(tables, heads)}
    return {name: make[name]() for name in wanted}
