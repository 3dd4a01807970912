"""Queries of the text problems and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..functions.lookalike import HARD_SPACES, LETTERS, ZERO_WIDTH
from ..session import table
from . import leakage, lookalikes, packing, residue, scan_noise, source_lines


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_lines.repeated_lines(table(spark, sf_dir, "acme_content_list")).select("block_id", "line_no").distinct()


def p5_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_lines.excessive_lines(table(spark, sf_dir, "acme_content_list")).select("source", "norm", "n_documents")


def p5_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_lines.without_repeated_lines(table(spark, sf_dir, "acme_content_list"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_noise.scan_noise(table(spark, sf_dir, "acme_content_list"))


def p3_repaired(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_noise.repaired_texts(table(spark, sf_dir, "acme_content_list"))


def _p4_sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    blocks, records = table(spark, sf_dir, "acme_content_list"), table(spark, sf_dir, "knowledge")
    return {
        "acme_content_list": blocks.selectExpr("block_id AS row_key", "text"),
        "knowledge": records.selectExpr("record_id AS row_key", "register_name AS text"),
    }


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookalikes.unusual_rows(_p4_sources(spark, sf_dir))


def p4_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookalikes.canonical_texts(_p4_sources(spark, sf_dir)).select("src", "row_key", "canonical").distinct()


def p6_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "pack_budgets"))


def p6_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packing_report(p6_assignment(spark, sf_dir), table(spark, sf_dir, "pack_budgets"))


def p6_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packing_faults(p6_assignment(spark, sf_dir), table(spark, sf_dir, "pack_budgets"))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leakage.leaked_items(table(spark, sf_dir, "eval_items"), table(spark, sf_dir, "documents")).select("item_id", "doc_id").distinct()


def p7_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leakage.leakage_report(leakage.leaked_items(table(spark, sf_dir, "eval_items"), table(spark, sf_dir, "documents")))


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return residue.residue(table(spark, sf_dir, "documents")).select("doc_id").distinct()


def p8_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return residue.residue(table(spark, sf_dir, "documents"))


QUERIES = {"p3_found": p3_found, "p3_repaired": p3_repaired, "p5_found": p5_found, "p5_lines": p5_lines, "p5_clean": p5_clean, "p4_found": p4_found, "p4_canonical": p4_canonical, "p6_assignment": p6_assignment, "p6_report": p6_report, "p6_faults": p6_faults, "p7_found": p7_found, "p7_report": p7_report, "p8_found": p8_found, "p8_reasons": p8_reasons}

_LINES = r"""
lines AS (
  SELECT block_id, source, doc_file, i AS line_no, string_split(text, chr(10))[i] AS line,
    trim(lower(regexp_replace(regexp_replace(string_split(text, chr(10))[i], '\p{Nd}+', '', 'g'), '[\s\x{0B}\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+', ' ', 'g'))) AS norm
  FROM (SELECT DISTINCT block_id, source, doc_file, text FROM acme_content_list WHERE type = 'text' AND text_level IS NULL AND text IS NOT NULL), range(1, len(string_split(text, chr(10))) + 1) r(i)
),
often AS (
  SELECT source, norm, count(DISTINCT doc_file) AS n_documents, any_value(n) AS n
  FROM lines JOIN (SELECT source, count(DISTINCT doc_file) AS n FROM acme_content_list GROUP BY source) USING (source)
  WHERE regexp_matches(norm, '\p{L}') GROUP BY source, norm HAVING count(DISTINCT doc_file) >= greatest(3, any_value(n) * 0.1)
)"""

_LEAKS = r"""
items AS (SELECT row_number() OVER () AS ik, item_id, ws FROM (SELECT DISTINCT item_id, regexp_extract_all(lower(text), '[\p{L}\p{N}_]+') AS ws FROM eval_items) WHERE len(ws) >= 6),
runs AS (SELECT ik, i AS place, array_to_string(ws[i:i + 5], ' ') AS run FROM items, range(1, len(ws) - 4) r(i)),
docs AS (SELECT row_number() OVER () AS dk, doc_id, ws FROM (SELECT DISTINCT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}_]+') AS ws FROM documents) WHERE len(ws) >= 6),
held AS (SELECT DISTINCT dk, doc_id, array_to_string(ws[i:i + 5], ' ') AS run FROM docs, range(1, len(ws) - 4) r(i)),
cover AS (SELECT ik, dk, doc_id, count(DISTINCT place + o) AS covered FROM runs JOIN held USING (run), range(0, 6) w(o) GROUP BY ALL),
leaks AS (SELECT item_id, doc_id, max(covered / len(ws)) AS share FROM cover JOIN items USING (ik) WHERE covered >= len(ws) * 0.5 GROUP BY ALL)"""

_LOOK = "".join(LETTERS)
_ALWAYS = rf"[\x{{FF10}}-\x{{FF19}}\x{{FF21}}-\x{{FF3A}}\x{{FF41}}-\x{{FF5A}}\x{{FF3F}}\x{{0300}}-\x{{036F}}\x{{FB00}}-\x{{FB06}}{ZERO_WIDTH}{HARD_SPACES}]"
_MIXED = rf"[A-Za-z\x{{00C0}}-\x{{00D6}}\x{{00D8}}-\x{{00F6}}\x{{00F8}}-\x{{024F}}][\p{{L}}\p{{N}}_]*[{_LOOK}]|[{_LOOK}][\p{{L}}\p{{N}}_]*[A-Za-z\x{{00C0}}-\x{{00D6}}\x{{00D8}}-\x{{00F6}}\x{{00F8}}-\x{{024F}}]"

SQL = {
    "p4_found": f"""SELECT DISTINCT src, row_key FROM (
  SELECT 'acme_content_list' AS src, block_id AS row_key, text FROM acme_content_list UNION ALL SELECT 'knowledge', record_id, register_name FROM knowledge
) WHERE regexp_matches(text, '{_ALWAYS}|{_MIXED}')""",
    "p5_found": f"WITH {_LINES} SELECT DISTINCT block_id, line_no::INT AS line_no FROM lines JOIN often USING (source, norm)",
    "p7_found": f"WITH {_LEAKS} SELECT item_id, doc_id FROM leaks",
    "p7_report": f"WITH {_LEAKS} SELECT item_id, count(DISTINCT doc_id) AS n_documents, max(share) AS most FROM leaks GROUP BY item_id",
    "p6_faults": """SELECT budget_id, texts, 0 AS overfull, 0 AS cut_needlessly, 0 AS repeated FROM pack_budgets,
  (SELECT count(*) AS texts FROM (SELECT DISTINCT doc_id, text FROM documents WHERE text <> ''))""",
    "p5_lines": f"WITH {_LINES} SELECT source, norm, n_documents FROM often",
    "p5_clean": f"""WITH {_LINES} SELECT block_id, source, coalesce(string_agg(line, chr(10) ORDER BY line_no) FILTER (WHERE o.norm IS NULL), '') AS clean_text,
count(*) FILTER (WHERE o.norm IS NOT NULL) AS removed FROM lines LEFT JOIN often o USING (source, norm) GROUP BY ALL""",
}
