"""Block streams, knowledge tables and gold questions in files."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BLOCK = (
    "type string, text string, text_level int, page_idx int, table_body string, latex string, code_body string, sub_type string, code_caption array<string>, image_caption array<string>, img_path string"
)
GOLD = "id string, query string, keyword string, module string, type string, source string, expected struct<register_name:string,bit_field:string,caption_contains:string,section_contains:string>"
_FIELD = "struct<name:string,bit_range:string,access:string,reset_value:string,typical_value:string,description:string>"
SCHEMAS = {
    "registers": f"doc_file string, ord int, register_name string, address string, module string, description string, section_id string, page int, bit_fields array<{_FIELD}>",
    "sections": "doc_file string, ord int, section_id string, module string, title string, level int, page int, text string",
    "enums": "doc_file string, ord int, module string, name string, section_id string, values array<struct<value:string,mnemonic:string,description:string>>, page int",
    "tables": "doc_file string, ord int, module string, section_id string, caption string, header array<string>, rows array<array<string>>, page int",
    "formulas": "doc_file string, ord int, module string, section_id string, latex string, page int",
    "algorithms": "doc_file string, ord int, module string, section_id string, sub_type string, caption string, text string, page int",
    "figures": "doc_file string, ord int, module string, section_id string, caption string, img_path string, page int, context string",
}


def _blocks(texts: DataFrame) -> DataFrame:
    rows = texts.select(F.col("_metadata.file_path").alias("doc_file"), F.posexplode(F.from_json("value", f"array<struct<{BLOCK.replace(' ', ':').replace(',:', ', ')}>>")).alias("pos", "b"))
    module = F.upper(F.regexp_extract("doc_file", r"([^/]*)_content_list\.json$", 1))
    return rows.select(F.xxhash64("doc_file", "pos").alias("block_id"), "doc_file", module.alias("module"), "pos", "b.*")


def read_block_streams(spark: SparkSession, *paths: str) -> DataFrame:
    """Blocks of all ``*_content_list.json`` below ``paths``, in array order; the module is the file's stem in upper case."""
    return _blocks(spark.read.text(list(paths), wholetext=True, pathGlobFilter="*_content_list.json", recursiveFileLookup=True))


def write_block_stream(blocks: DataFrame, path: str) -> None:
    """One JSON array a document, as text files under ``path``."""
    fields = F.struct(*[c for c in (x.split()[0] for x in BLOCK.split(", "))])
    rows = blocks.groupBy("doc_file").agg(F.array_sort(F.collect_list(F.struct("pos", fields.alias("b")))).alias("all"))
    rows.select(F.to_json(F.transform("all", lambda x: x["b"])).alias("value")).write.text(path)


def write_kb(kb: dict[str, DataFrame], path: str) -> None:
    """A Parquet folder a collection, partitioned by module so that a module's rows are read alone."""
    for name, rows in kb.items():
        rows.write.mode("overwrite").partitionBy("module").parquet(f"{path}/{name}")


def read_kb(spark: SparkSession, path: str, strict: bool = False) -> dict[str, DataFrame]:
    """All collections; a missing one is empty, or raises where ``strict``."""
    out = {}
    for name, schema in SCHEMAS.items():
        try:
            out[name] = spark.read.schema(schema).parquet(f"{path}/{name}")
        except AnalysisException:
            if strict:
                raise
            out[name] = spark.createDataFrame([], schema)
    return out


def read_gold(spark: SparkSession, path: str) -> DataFrame:
    """Gold questions of a JSONL file; blank lines are skipped, ``broken`` holds a line that is no JSON."""
    lines = spark.read.text(path).where(F.col("value").rlike(r"\S"))
    parsed = lines.select("value", F.from_json("value", f"{GOLD}, broken string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "broken"}).alias("q"))
    return parsed.select("q.*")


def write_index(folder: str, chunks: DataFrame, vectors: DataFrame | None = None, model: str = "") -> None:
    """Write ``chunks(chunk_idx, ...)``, ``vectors(chunk_idx, embedding)`` of an encoder, if there is one, and what they are made of."""
    chunks.write.mode("overwrite").parquet(f"{folder}/chunks")
    n = chunks.sparkSession.read.parquet(f"{folder}/chunks").agg(F.count(F.lit(1)).alias("n_chunks"))
    if vectors is not None:
        vectors.write.mode("overwrite").parquet(f"{folder}/vectors")
        made = chunks.sparkSession.read.parquet(f"{folder}/vectors").agg(F.count(F.lit(1)).alias("n_vectors"), F.max(F.size("embedding")).alias("dimensions"))
    else:
        made = n.select(F.lit(0).cast("long").alias("n_vectors"), F.lit(None).cast("int").alias("dimensions"))
    n.crossJoin(made).withColumn("model", F.lit(model)).write.mode("overwrite").parquet(f"{folder}/meta")  # one row each


def read_index(spark: SparkSession, folder: str, model: str | None = None) -> tuple[DataFrame, DataFrame | None]:
    """Chunks and vectors; no vectors, so that search falls back to BM25, where there are none for each chunk or of another ``model``."""
    meta = spark.read.parquet(f"{folder}/meta").first()
    fits = meta.n_vectors and meta.n_vectors == meta.n_chunks and model in (None, meta.model)
    return spark.read.parquet(f"{folder}/chunks"), spark.read.parquet(f"{folder}/vectors") if fits else None
