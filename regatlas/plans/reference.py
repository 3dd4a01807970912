"""Queries of the engine's own operators over the test tables, with their SQL in reference_sql."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import window as W

from ..functions import tables as tb
from ..functions import text as tx
from ..operators import adapter, chunk, extract, quality, rank, search
from ..profile import WIDE
from ..session import cut, table
from .reference_sql import SQL  # noqa: F401


def _blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.latest_blocks(table(spark, sf_dir, "acme_content_list"))


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "source", F.coalesce("module", F.lit("")).alias("module"))


def _eval(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "eval_items").select(F.col("item_id").alias("qid"), "query", "keyword", F.coalesce("module", F.lit("")).alias("module"), "type", "expected")


# -- text ------------------------------------------------------------------------------------------------------------


def clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _blocks(spark, sf_dir).where("type = 'text'").select("block_id", tx.strip_noise(tx.clean_text(F.col("text"), entities=False)).alias("clean"))


def stem_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = _documents(spark, sf_dir).select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z0-9]+"), 0)).alias("word")).distinct()
    return words.select("word", tx.light_stem(F.col("word")).alias("stem"))


def tokenize_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts = rank.postings(_documents(spark, sf_dir), "doc_id", "text")
    return posts.groupBy("term").agg(F.sum("tf").alias("n"), F.count(F.lit(1)).alias("n_docs"))


def section_slug(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "kb_sections").select("section_row", tx.section_id(F.col("module"), F.col("title")).alias("slug"))


def module_from_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = F.col("doc_file")
    name = F.regexp_extract(path, r"([^/]*)_content_list\.json$", 1)
    return table(spark, sf_dir, "acme_content_list").select("doc_file", F.upper(name).alias("module")).distinct()


def register_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = tx.clean_text(F.col("text"), entities=False)
    rows = _blocks(spark, sf_dir).where("type = 'text'").select("block_id", tx.register_token(text, WIDE).alias("token"))
    return rows.where("token <> ''")


def register_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    regs = table(spark, sf_dir, "knowledge").where("collection = 'registers'")
    return regs.select("record_id", tx.register_text(F.col("register_name"), F.col("address"), F.col("description"), F.col("bit_fields")).alias("text")).distinct()


# -- tables and extraction -------------------------------------------------------------------------------------------


def html_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _blocks(spark, sf_dir).where("type = 'table' AND table_body <> ''").select("block_id", F.posexplode(tb.html_rows(F.col("table_body"), WIDE)).alias("row_no", "cells"))
    return rows.select("block_id", "row_no", F.array_join("cells", " | ").alias("cells"))


def table_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _blocks(spark, sf_dir).where("type = 'table' AND table_body <> ''").select("block_id", tb.html_rows(F.col("table_body"), WIDE).alias("rows")).where(F.size("rows") > 0)
    header = F.get("rows", F.lit(0))
    return rows.select("block_id", tb.classify_table(header, WIDE).alias("class"), tb.find_col(header, "bit_position", WIDE).alias("bit_col"), tb.find_col(header, "address", WIDE).alias("address_col"))


def anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    noted = extract.annotate(_blocks(spark, sf_dir), WIDE)
    return noted.select("block_id", "role", "section_id", "register_anchor")


def kb_sections_built(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.build_kb(table(spark, sf_dir, "acme_content_list"), WIDE, ("sections",))["sections"]


def kb_registers_built(spark: SparkSession, sf_dir: str) -> DataFrame:
    regs = extract.build_kb(table(spark, sf_dir, "acme_content_list"), WIDE, ("registers",))["registers"]
    fields = F.array_join(F.transform("bit_fields", lambda f: F.concat_ws("~", f["name"], f["bit_range"], f["access"], f["reset_value"], f["typical_value"], f["description"])), "; ")
    return regs.withColumn("bit_fields", fields)


def kb_enums_built(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = extract.build_kb(table(spark, sf_dir, "acme_content_list"), WIDE, ("enums",))["enums"]
    return rows.withColumn("values", F.array_join(F.transform("values", lambda v: F.concat_ws("~", v["value"], v["mnemonic"], v["description"])), "; "))


def kb_tables_built(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = extract.build_kb(table(spark, sf_dir, "acme_content_list"), wanted=("tables",))["tables"]
    return rows.select("doc_file", "ord", "module", "section_id", "caption", tx.table_text(F.col("header"), F.col("rows")).alias("text"), "page")


def kb_figures_built(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.build_kb(table(spark, sf_dir, "acme_content_list"), WIDE, ("figures",))["figures"]


def kb_formulas_built(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.build_kb(table(spark, sf_dir, "acme_content_list"), WIDE, ("formulas",))["formulas"]


def kb_algorithms_built(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.build_kb(table(spark, sf_dir, "acme_content_list"), WIDE, ("algorithms",))["algorithms"]


def event_forward_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("event_id", "user_id", F.when(F.col("event_type") == "signup", F.col("event_id")).alias("signup"))
    return extract.forward_fill(rows, "user_id", "event_id", ["signup"], 4096).select("event_id", "last_signup")


def adapter_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("text_level").isNotNull(), "section_header").when(F.col("type") == "header", "page_header").when(F.col("type") == "aside_text", "footnote").when(F.col("type") == "image", "Picture").otherwise(F.col("type"))
    items = _blocks(spark, sf_dir).select(
        "doc_file", "pos", label.alias("label"), F.coalesce("code_body", "text").alias("text"), F.col("text_level").alias("level"), F.col("page_idx").alias("page_no"), "table_body",
        F.array_join("image_caption", " ").alias("caption"), F.col("img_path").alias("img_uri"),
    )
    return adapter.to_blocks(items).withColumn("image_caption", F.array_join("image_caption", " "))


# -- chunks ----------------------------------------------------------------------------------------------------------


def split_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).dropDuplicates(["doc_id"])
    return docs.select("doc_id", F.posexplode(chunk.split_long(tx.chunk_clean(F.col("text")))).alias("piece_no", "piece"))


def breadcrumb_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks of all six sources. The table knowledge has no text of algorithms, values of enums and cells of tables, so
    these three are those built of the blocks; registers are those of knowledge."""
    kb = extract.build_kb(table(spark, sf_dir, "acme_content_list"), WIDE, ("algorithms", "enums", "tables"))
    kb["sections"] = table(spark, sf_dir, "kb_sections")
    kb["registers"] = table(spark, sf_dir, "knowledge").where("collection = 'registers'").dropDuplicates(["record_id"])
    built = ["doc_file", "ord"]
    docs = _documents(spark, sf_dir).dropDuplicates(["doc_id"])
    marked = chunk.uncovered_units(chunk.markdown_units(docs, "doc_id", "text").join(docs.select("doc_id", "module"), "doc_id"), kb["sections"])
    marked = chunk.numbered(marked, ["doc_id", "unit"], "at").withColumnRenamed("at", "ord")
    units = chunk.units(kb, {"sections": "section_row", "registers": "record_id", "algorithms": built, "enums": built, "tables": built}, marked)
    rows = chunk.chunks(units).withColumn("source", chunk.kind_order())
    return chunk.numbered(rows, ["source", "ord", "piece"], "chunk_idx").select("chunk_idx", "kind", "section_id", "ord", "piece", "breadcrumb", "embed_text")


def chunk_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return breadcrumb_chunks(spark, sf_dir).groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


def markdown_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk.markdown_units(_documents(spark, sf_dir).dropDuplicates(["doc_id"]), "doc_id", "text")


def uncovered_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).dropDuplicates(["doc_id"])
    units = chunk.markdown_units(docs, "doc_id", "text").join(docs.select("doc_id", "module"), "doc_id")
    return chunk.uncovered_units(units, table(spark, sf_dir, "kb_sections")).select("doc_id", "unit", "heading")


# -- ranking ---------------------------------------------------------------------------------------------------------


def doc_freq_idf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).dropDuplicates(["doc_id"])
    stats = rank.term_stats(rank.postings(docs, "doc_id", "text"), docs.count())
    return stats.select("term", "df", F.round("idf", 6).alias("idf"))


def bm25_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).dropDuplicates(["doc_id"])
    hits = rank.bm25_topk(docs, "doc_id", "text", _eval(spark, sf_dir).select("qid", "query").distinct())
    return hits.select("qid", "doc_id", "score", "rank")


def dense_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    hits = rank.dense_topk(vectors, "vec_id", "embedding", vectors.where("vec_id % 50 = 0").select(F.col("vec_id").alias("qid"), F.col("embedding").alias("vector")))
    return hits.select("qid", "vec_id", "score", "rank")


def _questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All questions; the i-th has the i-th vector whose id is divisible by 50, if there are so many."""
    order = W.Window.orderBy("qid")
    asked = _eval(spark, sf_dir).select("qid", "query", "module").distinct().withColumn("i", F.row_number().over(order) - 1)  # 300 questions at every scale
    own = table(spark, sf_dir, "embeddings").where("vec_id % 50 = 0").select((F.col("vec_id") / 50).cast("int").alias("i"), F.col("embedding").alias("vector"))
    return cut(asked.join(own, "i", "left").select("qid", "query", "module", "vector"))


def _lists(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """A dense and a lexical list: the i-th query vector belongs to the i-th question, a vector to the document of its number.

    A question without a vector has a lexical list only.
    """
    vectors = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("doc_id"), "embedding")
    asked = _questions(spark, sf_dir)
    docs = _documents(spark, sf_dir).dropDuplicates(["doc_id"])
    dense = rank.dense_topk(vectors, "doc_id", "embedding", asked.where("vector IS NOT NULL"))
    return cut(dense), cut(rank.bm25_topk(docs, "doc_id", "text", asked))


def _fused(rows: DataFrame) -> DataFrame:
    return rows.select("qid", "doc_id", "fused", "rank")


def rrf_fusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fused(rank.rrf(*_lists(spark, sf_dir), "doc_id"))


def rrf_bonus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fused(rank.rrf(*_lists(spark, sf_dir), "doc_id", 0.05, 0.02))


def relative_fusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fused(rank.relative_score(*_lists(spark, sf_dir), "doc_id", 0.5))


def hybrid_module_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).dropDuplicates(["doc_id"]).select("doc_id", "source")
    hits = rank.pooled(rank.rrf(*_lists(spark, sf_dir), "doc_id"), docs, "doc_id", F.lower("source").contains("north"), top_k=5)
    return hits.select("qid", "doc_id", "rank", "place")


def search_prose(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each question in its module: hybrid where it has a vector, else lexical alone."""
    docs = _documents(spark, sf_dir).dropDuplicates(["doc_id"])
    asked = _questions(spark, sf_dir)
    vectors = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("doc_id"), "embedding")
    dense = cut(rank.dense_topk(vectors, "doc_id", "embedding", asked.where("vector IS NOT NULL")))
    return rank.search_prose(docs, "doc_id", "text", asked, dense, module="module")


# -- look-up ---------------------------------------------------------------------------------------------------------


def _last_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Queries whose keyword is what the registers' names end with."""
    names = table(spark, sf_dir, "knowledge").where("collection = 'registers' AND register_name LIKE '%\\_%'")
    tails = names.select(F.lower(F.regexp_extract("register_name", "_([A-Za-z_]+)$", 1)).alias("query")).where("query <> ''").distinct()
    return tails.select(F.xxhash64("query").alias("qid"), "query", F.lit("").alias("module"))


def register_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    regs = table(spark, sf_dir, "knowledge").where("collection = 'registers'").dropDuplicates(["record_id"])
    asked = _last_words(spark, sf_dir)
    found = search.search_registers(regs, table(spark, sf_dir, "kb_sections"), asked).join(asked.select("qid", "query"), "qid")
    return found.select("query", "record_id", "place", "n_found", F.md5("related_section").alias("section_md5"))


def register_search_module(spark: SparkSession, sf_dir: str) -> DataFrame:
    regs = table(spark, sf_dir, "knowledge").where("collection = 'registers'").dropDuplicates(["record_id"])
    asked = _last_words(spark, sf_dir).withColumn("module", F.lit("lite"))
    found = search.search_registers(regs, table(spark, sf_dir, "kb_sections"), asked).join(asked.select("qid", "query"), "qid")
    return found.select("query", "record_id", "place", "n_found")


def concept_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    kb = table(spark, sf_dir, "knowledge").dropDuplicates(["record_id"])
    hay = F.lower(F.concat_ws(" ", "name", "caption", "description"))
    kinds = {k: (kb.where(F.col("collection") == k), hay) for k in ("formulas", "algorithms", "enums", "tables", "figures")}
    secs = table(spark, sf_dir, "kb_sections").select(F.col("section_row").alias("record_id"), "module", "title", "text").dropDuplicates(["record_id"])
    kinds["sections"] = (secs, F.lower(F.concat_ws("\n", "title", "text")))
    words = kb.where("name IS NOT NULL").select(F.lower(F.regexp_extract("name", "_([A-Z]{4,})", 1)).alias("query")).where("query <> ''").distinct()
    asked = words.select(F.xxhash64("query").alias("qid"), "query", F.lit("").alias("module"))
    hits = search.search_concepts(kinds, asked, "record_id").join(asked.select("qid", "query"), "qid")
    return hits.groupBy("query", "kind").agg(F.count(F.lit(1)).alias("n"), F.max("place").alias("last_place"))


def concept_search_built(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words looked up in the names and values of enums and in the captions, headers and cells of tables, as the blocks give them."""
    blocks = table(spark, sf_dir, "acme_content_list")
    enums = extract.build_kb(blocks, WIDE, ("enums",))["enums"]
    tables = extract.build_kb(blocks, wanted=("tables",))["tables"]
    key = F.concat_ws("#", "doc_file", "ord").alias("key")
    kinds = {
        "enums": (enums.select("module", key, tx.enum_text(F.col("name"), F.col("values")).alias("hay")), F.lower("hay")),
        "tables": (tables.select("module", key, F.concat_ws(" ", "caption", tx.table_text(F.col("header"), F.col("rows"))).alias("hay")), F.lower("hay")),
    }
    words = table(spark, sf_dir, "knowledge").where("name IS NOT NULL").select(F.lower(F.regexp_extract("name", "_([A-Z]{4,})", 1)).alias("query")).where("query <> ''").distinct()
    asked = cut(words.select(F.xxhash64("query").alias("qid"), "query", F.lit("").alias("module")))
    hits = search.search_concepts(kinds, asked, "key", capped=()).join(asked.select("qid", "query"), "qid")
    return hits.select("query", "kind", "key", "place")


# -- quality ---------------------------------------------------------------------------------------------------------


def audit_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = _blocks(spark, sf_dir)
    return quality.audit_counts(blocks, extract.table_blocks(blocks.select("doc_file", "type", "table_body"), WIDE), WIDE)


def unknown_headers_top20(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.unknown_headers(extract.table_blocks(_blocks(spark, sf_dir).select("type", "table_body")))


def validate_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    secs = quality.duplicates(table(spark, sf_dir, "kb_sections"), ["section_id"]).select(F.lit("section").alias("kind"), F.col("section_id").alias("key"), "n")
    regs = quality.duplicates(table(spark, sf_dir, "knowledge").where("collection = 'registers'"), ["module", "register_name"])
    return secs.unionByName(regs.select(F.lit("register").alias("kind"), F.concat_ws(":", "module", "register_name").alias("key"), "n"))


def validate_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.orphans(table(spark, sf_dir, "knowledge"), table(spark, sf_dir, "kb_sections"), "collection")


def coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.coverage(table(spark, sf_dir, "knowledge").where("collection = 'registers'"), table(spark, sf_dir, "kb_sections"))


def _compared(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = table(spark, sf_dir, "knowledge").where("collection = 'registers'")
    return quality.compare(left, table(spark, sf_dir, "knowledge_alt"), ["built_at", "record_id"], ["built_at", "alt_id"])


def compare_registers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _compared(spark, sf_dir)


def compare_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.compare_summary(_compared(spark, sf_dir))


def question_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.question_errors(table(spark, sf_dir, "eval_items"))


def unanchored_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    kb = table(spark, sf_dir, "knowledge")
    return quality.unanchored_questions(table(spark, sf_dir, "eval_items"), kb.where("collection = 'registers'"), kb.where("collection = 'figures'"), table(spark, sf_dir, "kb_sections"))


def collection_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    kb = table(spark, sf_dir, "knowledge")
    left = {name: kb.where(F.col("collection") == name) for name in ("registers", "enums", "figures", "formulas", "algorithms", "tables")}
    return quality.collection_counts(left, {"registers": table(spark, sf_dir, "knowledge_alt")})


def validation_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.validation_report(validate_duplicates(spark, sf_dir), validate_orphans(spark, sf_dir), coverage(spark, sf_dir))


def _relevant(need: str, hay: Column) -> Column:
    """Whether ``hay`` holds the expected text, letter case aside; a blank one is never relevant."""
    want = F.lower(F.coalesce(F.col(f"expected.{need}"), F.lit("")))
    return (F.trim(want) != "") & F.lower(F.coalesce(hay, F.lit(""))).contains(want)


def _relevant_register() -> Column:
    """The expected register, with the expected field if one is named."""
    blank = lambda c: F.trim(F.coalesce(F.col(f"expected.{c}"), F.lit(""))) == ""
    field = tx.norm_field(F.col("expected.bit_field"))
    fields = F.exists(F.coalesce("bit_fields", F.array()), lambda f: tx.norm_field(F.coalesce(f["name"], F.lit(""))).contains(field))
    return ~(blank("register_name") & blank("bit_field")) & (blank("register_name") | _relevant("register_name", F.col("register_name"))) & (blank("bit_field") | F.coalesce(fields, F.lit(False)))


def hit_at_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(config, type, n, hit1, hit5)``: each type of question in its search, prose in every fusion, judged by what is expected.

    Registers and figures are looked up by the keyword, or the question where none is given. Prose results are the first
    10 of the pool in the question's module. The re-ranking configuration needs a model and is left out.
    """
    asked = cut(_eval(spark, sf_dir).dropDuplicates(["qid"]))
    kb = table(spark, sf_dir, "knowledge").dropDuplicates(["record_id"])
    words = asked.select("qid", F.coalesce("keyword", "query").alias("query"), "module", "type")
    expected = asked.select("qid", "expected")

    regs = kb.where("collection = 'registers'")
    hits = search.search_registers(regs, table(spark, sf_dir, "kb_sections"), words.where("type = 'register'")).select("qid", "record_id", F.col("place").alias("rank"))
    near = {"search_registers": hits.join(regs.select("record_id", "register_name", "bit_fields"), "record_id").join(expected, "qid").where(_relevant_register())}

    figs = kb.where("collection = 'figures'")
    hay = F.lower(F.concat_ws(" ", "name", "caption", "description"))
    hits = search.search_concepts({"figures": (figs, hay)}, words.where("type = 'figure'"), "record_id").select("qid", "record_id", F.col("place").alias("rank"))
    near["search_concepts"] = hits.join(figs.select("record_id", "caption"), "record_id").join(expected, "qid").where(_relevant("caption_contains", F.col("caption")))

    docs = _documents(spark, sf_dir).dropDuplicates(["doc_id"]).select("doc_id", "text", F.col("module").alias("doc_module"))
    want = asked.where("type = 'prose'").select("qid", "expected", F.lower(F.trim("module")).alias("want"))
    dense, lexical = _lists(spark, sf_dir)
    fused = {
        "bm25": rank.rrf(dense.where("false"), lexical, "doc_id"), "hybrid_rrf": rank.rrf(dense, lexical, "doc_id"),
        "hybrid_rrf_bonus": rank.rrf(dense, lexical, "doc_id", 0.05, 0.02), "hybrid_relative": rank.relative_score(dense, lexical, "doc_id"),
    }
    for config, rows in fused.items():
        hits = rank.pooled(rows.join(want, "qid"), docs, "doc_id", F.lower("doc_module").contains(F.col("want")), top_k=10)
        near[config] = hits.where(_relevant("section_contains", F.col("text"))).select("qid", F.col("place").alias("rank"))

    out = None
    for config, rows in near.items():
        kind = {"search_registers": "register", "search_concepts": "figure"}.get(config, "prose")
        rates = quality.hit_rates(rows, asked.where(F.col("type") == kind).select("qid", "type"), "type").select(F.lit(config).alias("config"), "type", "n", "hit1", "hit5")
        out = rates if out is None else out.unionByName(rates)
    return out


QUERIES = {
    f.__name__: f
    for f in (
        clean_text, stem_dictionary, tokenize_terms, section_slug, module_from_path, register_tokens, register_texts, html_rows, table_classes, anchors, kb_sections_built, kb_registers_built,
        kb_enums_built, kb_tables_built, kb_figures_built, kb_formulas_built, kb_algorithms_built, event_forward_fill, adapter_blocks, split_long, breadcrumb_chunks, markdown_units, uncovered_units,
        doc_freq_idf, bm25_topk, dense_topk, rrf_fusion, rrf_bonus, relative_fusion, hybrid_module_filter, register_search, register_search_module, concept_search, audit_counts,
        unknown_headers_top20, validate_duplicates, validate_orphans, coverage, compare_registers, compare_summary, question_errors, hit_at_k, search_prose, chunk_counts, concept_search_built, unanchored_questions, collection_counts, validation_report,
    )
}
