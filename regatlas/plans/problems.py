"""Queries of the general problems 1 and 2 and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..functions.lookalike import FULL_WIDTH, HARD_SPACES, LETTERS, LIGATURES, ZERO_WIDTH
from ..operators.copydiff import difference_report, register_differences
from ..operators.orphans import orphan_references, orphan_report
from ..session import table


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    lost = orphan_references(table(spark, sf_dir, "knowledge"), table(spark, sf_dir, "kb_sections"), record_id="record_id", key="section_id", at="built_at")
    return lost.select("record_id", "reason").distinct()


def p1_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = table(spark, sf_dir, "knowledge")
    lost = orphan_references(records, table(spark, sf_dir, "kb_sections"), record_id="record_id", key="section_id", at="built_at")
    return orphan_report(lost, records, record_id="record_id", at="built_at", by="collection")


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return register_differences(table(spark, sf_dir, "knowledge"), table(spark, sf_dir, "knowledge_alt"))


def p2_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return difference_report(p2_found(spark, sf_dir))


QUERIES = {"p1_found": p1_found, "p1_report": p1_report, "p2_found": p2_found, "p2_report": p2_report}

_SPACE = r"[\s\x{0B}\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
def _full(column: str) -> str:
    return f"regexp_matches(coalesce({column}, ''), '[^{_SPACE[1:]}')"


_LOST = f"""
lost AS (
  SELECT k.record_id, k.collection, k.built_at,
    CASE WHEN count(s.section_id) = 0 THEN 'missing' WHEN bool_and(s.created_at > k.built_at) THEN 'late' ELSE 'deleted' END AS reason
  FROM (SELECT DISTINCT record_id, collection, section_id, built_at FROM knowledge WHERE {_full("section_id")}) k
  LEFT JOIN kb_sections s ON s.section_id = k.section_id
  GROUP BY k.record_id, k.collection, k.section_id, k.built_at
  HAVING NOT coalesce(bool_or(s.created_at <= k.built_at AND (s.deleted_at IS NULL OR s.deleted_at > k.built_at)), false)
)"""


def _sql_name(column: str) -> str:
    single = LETTERS | FULL_WIDTH
    src, dst = "".join(single) + HARD_SPACES, "".join(single.values()) + " " * len(HARD_SPACES)
    out = f"translate({column}, '{src}', '{dst}')"
    for ligature, plain in LIGATURES.items():
        out = f"replace({out}, '{ligature}', '{plain}')"
    out = rf"regexp_replace({out}, '[\p{{Mn}}{ZERO_WIDTH}]', '', 'g')"
    return f"upper({_strip(out)})"


def _strip(text: str) -> str:
    return f"regexp_replace({text}, '^{_SPACE}+|{_SPACE}+$', '', 'g')"


def _side(name: str, tie: str, where: str) -> str:
    plain = lambda x: f"lower({_strip(f'coalesce({x}, {chr(39) * 2})')})"
    member = " || chr(1) || ".join(plain(f"x.{c}") for c in ("name", "bit_range", "access", "reset_value"))
    return f"""
  SELECT upper({plain("module")}) AS module, {_sql_name("register_name")} AS register_name,
    {plain("address")} AS address, list_sort(list_transform(coalesce(bit_fields, []), lambda x: {member})) AS bit_fields
  FROM {name} WHERE {where} AND {_full("register_name")}
  QUALIFY row_number() OVER (PARTITION BY upper({plain("module")}), {_sql_name("register_name")} ORDER BY built_at DESC NULLS LAST, {tie} DESC) = 1"""


_DIFF = f"""
a AS ({_side("knowledge", "record_id", "collection = 'registers'")}),
b AS ({_side("knowledge_alt", "alt_id", "true")}),
m AS (
  SELECT coalesce(a.module, b.module) AS module, coalesce(a.register_name, b.register_name) AS register_name,
    a.module IS NULL AS no_a, b.module IS NULL AS no_b, a.address IS DISTINCT FROM b.address AS da, a.bit_fields IS DISTINCT FROM b.bit_fields AS df
  FROM a FULL JOIN b ON a.module = b.module AND a.register_name = b.register_name
),
diff AS (
  SELECT module, register_name, 'only_knowledge' AS difference FROM m WHERE no_b
  UNION ALL SELECT module, register_name, 'only_alt' FROM m WHERE no_a
  UNION ALL SELECT module, register_name, 'address' FROM m WHERE NOT no_a AND NOT no_b AND da
  UNION ALL SELECT module, register_name, 'bit_fields' FROM m WHERE NOT no_a AND NOT no_b AND df
)"""

SQL = {
    "p1_found": f"WITH {_LOST} SELECT DISTINCT record_id, reason FROM lost",
    "p1_report": f"""WITH {_LOST} SELECT collection, strftime(built_at::TIMESTAMP, '%Y-%m') AS month, reason, count(DISTINCT record_id) AS n_records
FROM lost GROUP BY ALL""",
    "p2_found": f"WITH {_DIFF} SELECT * FROM diff",
    "p2_report": f"WITH {_DIFF} SELECT module, difference, count(*) AS n_registers FROM diff GROUP BY ALL",
}
