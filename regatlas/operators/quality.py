"""Source audit, validation, comparison of two knowledge bases, question checks and evaluation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from ..profile import Profile
from .search import containing


def audit_counts(blocks: DataFrame, tables: DataFrame, profile: Profile = Profile()) -> DataFrame:
    """``(doc_file, metric, label, n)``, ``doc_file`` null for the total: blocks by type, headings by level, tables by class,
    distinct register anchors and images without a path."""
    block = blocks.select("doc_file", F.lit("block").alias("metric"), F.coalesce("type", F.lit("<missing>")).alias("label"))
    levels = blocks.where("type = 'text' AND coalesce(text_level, 0) <> 0").select("doc_file", F.lit("heading").alias("metric"), F.col("text_level").cast("string").alias("label"))
    kinds = tables.select("doc_file", F.lit("table").alias("metric"), F.col("class").alias("label"))
    bare = blocks.where("type IN ('image', 'chart') AND coalesce(img_path, '') = ''").select("doc_file", F.lit("image").alias("metric"), F.lit("without path").alias("label"))
    counted = block.unionByName(levels).unionByName(kinds).unionByName(bare).groupBy("doc_file", "metric", "label").agg(F.count(F.lit(1)).alias("n"))
    token = tx.register_token(tx.clean_text(F.col("text")), profile)
    anchors = blocks.where("type = 'text'").select("doc_file", token.alias("token")).where("token <> ''")
    found = anchors.distinct().groupBy("doc_file").agg(F.count(F.lit(1)).alias("n"))
    counted = counted.unionByName(found.select("doc_file", F.lit("anchor").alias("metric"), F.lit("distinct").alias("label"), "n"))
    both = counted.rollup("metric", "label", "doc_file").agg(F.sum("n").alias("n"), F.grouping_id().alias("level")).where("level < 2")
    return both.select("doc_file", "metric", "label", "n")


def unknown_headers(tables: DataFrame, n: int = 20) -> DataFrame:
    """The most frequent headers of tables of no known class."""
    return tables.where("class = 'other'").groupBy(F.array_join("header", " | ").alias("header")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "header").limit(n)


def duplicates(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Keys, none of them null or '', that occur more than once."""
    full = rows
    for k in keys:
        full = full.where(F.coalesce(F.col(k), F.lit("")) != "")
    return full.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def orphans(rows: DataFrame, sections: DataFrame, by: str) -> DataFrame:
    """Rows per ``by`` whose non-empty ``section_id`` no section has."""
    lost = rows.where("coalesce(section_id, '') <> ''").join(sections.select("section_id").distinct(), "section_id", "left_anti")
    return lost.groupBy(by).agg(F.count(F.lit(1)).alias("n_orphans"))


def coverage(registers: DataFrame, sections: DataFrame) -> DataFrame:
    """``(metric, n, of, share, low)``; ``low`` warns of registers mostly without address."""
    regs = registers.agg(
        F.count(F.lit(1)).alias("of"), F.count_if(F.coalesce("address", F.lit("")) != "").alias("with_address"), F.count_if(F.coalesce(F.size("bit_fields"), F.lit(0)) > 0).alias("with_bit_fields")
    )
    secs = sections.agg(F.count(F.lit(1)).alias("of"), F.count_if(F.coalesce("text", F.lit("")) != "").alias("with_text"))
    pick = lambda df, metric, col, least: df.select(F.lit(metric).alias("metric"), F.col(col).alias("n"), "of", F.round(F.col(col) / F.nullif(F.col("of"), F.lit(0)), 6).alias("share"), F.lit(least).alias("least"))
    rows = pick(regs, "registers_with_address", "with_address", 0.5).unionByName(pick(regs, "registers_with_bit_fields", "with_bit_fields", 1.0)).unionByName(pick(secs, "sections_with_text", "with_text", 0.0))
    return rows.withColumn("low", F.coalesce(F.col("share") < F.col("least"), F.lit(False))).drop("least")


def _by_name(rows: DataFrame, order: list[str]) -> DataFrame:
    """The last register of each upper-case name, whatever its module."""
    name = F.upper(F.coalesce("register_name", F.lit("")))
    fields = F.array_distinct(F.transform(F.filter(F.coalesce("bit_fields", F.array()), lambda f: F.coalesce(f["name"], F.lit("")) != ""), lambda f: F.upper(f["name"])))
    facts = F.struct(F.lower(F.coalesce("address", F.lit(""))).alias("address"), fields.alias("fields"))
    return rows.select(name.alias("name"), *order, facts.alias("facts")).where("name <> ''").groupBy("name").agg(F.max_by("facts", F.struct(*order)).alias("facts"))


def compare(left: DataFrame, right: DataFrame, left_order: list[str], right_order: list[str]) -> DataFrame:
    """One row a register name: ``side`` (both, only_a, only_b), ``address`` (agree, mismatch, missing_a, missing_b,
    missing_both) and ``field_jaccard`` (null where neither side names a field)."""
    met = _by_name(left, left_order).withColumnRenamed("facts", "a").join(_by_name(right, right_order).withColumnRenamed("facts", "b"), "name", "full_outer")
    side = F.when(F.col("b").isNull(), "only_a").when(F.col("a").isNull(), "only_b").otherwise("both")
    a, b = F.col("a.address"), F.col("b.address")
    address = F.when((a == "") & (b == ""), "missing_both").when(a == "", "missing_a").when(b == "", "missing_b").when(a == b, "agree").otherwise("mismatch")
    union = F.size(F.array_union("a.fields", "b.fields"))
    jaccard = F.when(union > 0, F.round(F.size(F.array_intersect("a.fields", "b.fields")) / union, 6))
    both = side == "both"
    return met.select("name", side.alias("side"), F.when(both, address).alias("address"), F.when(both, jaccard).alias("field_jaccard"))


def compare_summary(compared: DataFrame, gap: float = 0.8) -> DataFrame:
    """Set, address and field metrics of a comparison in one row; equal empty sides have a Jaccard index of 1."""
    n = lambda cond: F.count_if(cond)
    both = F.col("side") == "both"
    row = compared.agg(
        n(both).alias("shared"), n(F.col("side") == "only_a").alias("only_a"), n(F.col("side") == "only_b").alias("only_b"), n(F.col("address") == "agree").alias("agree"),
        n(F.col("address") == "mismatch").alias("mismatch"), n(F.col("address").isin("missing_a", "missing_both")).alias("missing_a"),
        n(F.col("address").isin("missing_b", "missing_both")).alias("missing_b"), F.round(F.avg("field_jaccard"), 6).alias("mean_field_jaccard"),
    )
    total = F.col("shared") + F.col("only_a") + F.col("only_b")
    gapped = lambda c: (F.col("shared") > 0) & (F.col(c) >= gap * F.col("shared"))
    return row.withColumns({"jaccard": F.round(F.coalesce(F.col("shared") / F.nullif(total, F.lit(0)), F.lit(1.0)), 6), "gap_a": gapped("missing_a"), "gap_b": gapped("missing_b")})


def hit_rates(ranked: DataFrame, questions: DataFrame, by: str) -> DataFrame:
    """``(by, n, hit1, hit5)`` from ``ranked(qid, rank)`` of relevant results and ``questions(qid, by)``."""
    first = ranked.groupBy("qid").agg(F.min("rank").alias("first"))
    met = questions.join(first, "qid", "left")
    return met.groupBy(by).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("first") <= 1).alias("hit1"), F.count_if(F.col("first") <= 5).alias("hit5"))


def question_errors(questions: DataFrame) -> DataFrame:
    """``(item_id, error)``: what a gold question lacks: id, query, source, known type, keyword or the expected member."""
    e = lambda c: F.trim(F.coalesce(F.col(c).cast("string"), F.lit(""))) == ""
    known = F.col("type").isin("register", "figure", "prose")
    want = F.when(F.col("type") == "register", F.col("expected.register_name")).when(F.col("type") == "figure", F.col("expected.caption_contains")).otherwise(F.col("expected.section_contains"))
    errors = F.array(
        F.when(e("item_id"), "no id"), F.when(e("query"), "no query"), F.when(e("source"), "no source"), F.when(~F.coalesce(known, F.lit(False)), "unknown type"),
        F.when(F.col("type").isin("register", "figure") & e("keyword"), "no keyword"), F.when(known & (F.trim(F.coalesce(want, F.lit(""))) == ""), "nothing expected"),
    )
    return questions.select("item_id", F.explode(F.filter(errors, lambda x: x.isNotNull())).alias("error"))


def unanchored_questions(questions: DataFrame, registers: DataFrame, figures: DataFrame, sections: DataFrame) -> DataFrame:
    """``(item_id, error)``: gold questions whose expected register, caption or section text the knowledge base doesn't hold.

    Letter case aside, the expected text must stand in a register's name, a figure's caption, or a section's title or text.
    Blank expectations are question_errors' business.
    """
    out = None
    places = {
        "register_name": ("register not in the knowledge base", registers, F.col("register_name")),
        "caption_contains": ("caption not in the knowledge base", figures, F.col("caption")),
        "section_contains": ("section not in the knowledge base", sections, F.concat_ws("\n", "title", "text")),
    }
    for member, (error, rows, hay) in places.items():
        asked = questions.select("item_id", F.lower(F.col(f"expected.{member}")).alias("needle")).where("trim(needle) <> ''")
        held = containing(rows.select(F.lit(0).alias("k"), hay.alias("hay")), "k", F.lower("hay"), asked, "needle").select("needle").distinct()
        lost = asked.join(held, "needle", "left_anti").select("item_id", F.lit(error).alias("error")).distinct()
        out = lost if out is None else out.unionByName(lost)
    return out


def collection_counts(left: dict[str, DataFrame], right: dict[str, DataFrame]) -> DataFrame:
    """``(collection, n_left, n_right)`` of two knowledge bases; a collection that one side lacks counts 0 there."""
    out = None
    for side, kb in (("l", left), ("r", right)):
        for name, rows in kb.items():
            part = rows.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("collection"), F.lit(side).alias("side"), "n")
            out = part if out is None else out.unionByName(part)
    of = lambda side: F.coalesce(F.sum(F.when(F.col("side") == side, F.col("n"))), F.lit(0))
    return out.groupBy("collection").agg(of("l").alias("n_left"), of("r").alias("n_right"))


def validation_report(duplicated: DataFrame, orphaned: DataFrame, covered: DataFrame, strict: bool = False) -> DataFrame:
    """``(level, check, n)`` of what duplicates, orphans and coverage tell: duplicates and orphans are errors, low coverage a
    warning, or an error too if ``strict``; a check without findings has no row."""
    low = "error" if strict else "warning"
    return (
        duplicated.groupBy(F.concat(F.lit("duplicate "), "kind").alias("check")).agg(F.count(F.lit(1)).alias("n")).select(F.lit("error").alias("level"), "check", "n")
        .unionByName(orphaned.select(F.lit("error").alias("level"), F.concat(F.lit("orphans in "), "collection").alias("check"), F.col("n_orphans").alias("n")))
        .unionByName(covered.where("low").select(F.lit(low).alias("level"), F.concat(F.lit("low "), "metric").alias("check"), (F.col("of") - F.col("n")).alias("n")))
    )
