"""Scans of table documents: schemas, raw and verified files, sidecars, payload columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridweave.operators.ids import latest

#: The fields of an extraction document, as a Spark schema.
EXTRACTION = """
schema_name string, schema_version string,
extraction_metadata struct<extracted_at:string,extractor:string,extraction_status:string,extraction_notes:string,
  source_document:struct<filename:string,document_type:string,document_version:string,document_date:string>>,
table_metadata struct<table_number:int,table_type:string,table_title:string,table_purpose:string,page_start:int,page_end:int,continuation_of:int,track_label:string,notes:string>,
schedule_properties array<struct<table_number:int,row_position:int,property_name:string,property_name_source:struct<row_position:int,column_position:int,cell_value:string,synthesized:boolean>,
  structure_method:string,property_type:string,property_comment:string,hierarchical_level:int,annotation_markers:string>>,
schedule_grid array<struct<table_number:int,row_position:int,column_position:int,cell_value:string,merged_cell_range:string,is_merged_cell:boolean,annotation_markers:string,method:string>>,
activities array<struct<table_number:int,row_position:int,source_page:int,activity_name:string,
  activity_name_source:struct<cell_text:string,indentation_level:int,text_formatting:array<string>,method:string,indentation_method:string>,annotation_markers:string>>,
activity_schedule array<struct<table_number:int,row_position:int,column_position:int,cell_value:string,source_range:string,is_merged_cell:boolean,annotation_markers:string,method:string>>,
annotations array<struct<annotation_marker:string,annotation_type:string,annotation_text:string,annotation_text_source:struct<method:string,note:string>,
  marker_locations:array<struct<table_number:int,location_type:string,row_position:int,column_position:int,method:string>>>>
"""
#: The arrays of rows that an extraction must have, and that corrections may change.
ARRAYS = ["schedule_properties", "schedule_grid", "activities", "activity_schedule", "annotations"]


def read_texts(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """file, text: whole files below a path (a glob), however nested; pattern limits their names."""
    reader = spark.read.option("recursiveFileLookup", True)
    df = (reader.option("pathGlobFilter", pattern) if pattern else reader).text(path, wholetext=True)
    return df.select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("text"))


def file_name(file: Column) -> Column:
    return F.element_at(F.split(file, "/"), -1)


def protocol_of(file: Column) -> Column:
    """The folder below protocols/."""
    return F.regexp_extract(file, r"/protocols/([^/]+)/", 1)


def preferred(files: DataFrame) -> DataFrame:
    """files with, of each extraction, the verified version where there is one, else the raw one."""
    base = files.withColumn("_base", F.regexp_replace("file", r"\.verified\.json$", ".json"))
    return latest(base, ["_base"], [F.col("file").endswith(".verified.json").desc()]).drop("_base")


def parse_extractions(texts: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """keep, doc, is_broken: documents parsed by the schema; a text that is not JSON gives a null doc instead of an error."""
    doc = F.from_json(F.col(text), EXTRACTION, {"mode": "PERMISSIVE"})
    out = texts.select(*keep, doc.alias("doc"))
    broken = F.col("doc").isNull() | F.col("doc.table_metadata").isNull()
    return out.select(*keep, F.when(~broken, F.col("doc")).alias("doc"), broken.alias("is_broken"))


def read_extractions(spark: SparkSession, root: str) -> DataFrame:
    """protocol_id, table_number, file, doc of the preferred extraction files below a collection's folder."""
    files = preferred(read_texts(spark, root, "*_extraction*.json"))
    parsed = parse_extractions(files.withColumn("protocol_id", protocol_of(F.col("file"))), "text", ["protocol_id", "file"])
    return parsed.where("not is_broken").select("protocol_id", F.col("doc.table_metadata.table_number").alias("table_number"), "file", "doc")


def extractions_of_records(records: DataFrame) -> DataFrame:
    """The same of a table of payloads; of deliveries of the same table the latest counts."""
    parsed = parse_extractions(records.where("record_kind = 'extraction'"), "payload", ["protocol_id", "record_id"]).where("not is_broken")
    docs = parsed.select("protocol_id", F.col("doc.table_metadata.table_number").alias("table_number"), F.col("record_id").cast("string").alias("file"), "doc", "record_id")
    return latest(docs, ["protocol_id", "table_number"], [F.desc("record_id")]).drop("record_id")


def missing_arrays(docs: DataFrame) -> DataFrame:
    """protocol_id, table_number, errors: the required arrays that a document lacks."""
    lost = F.filter(F.array(*[F.when(F.col(f"doc.{a}").isNull(), F.lit(f"Missing required array: {a}")) for a in ARRAYS]), lambda e: e.isNotNull())
    return docs.select("protocol_id", "table_number", lost.alias("errors"))


def protocols_below(spark: SparkSession, root: str) -> DataFrame:
    """protocol_id, n_extractions, n_resolved, has_consolidated: what lies below a collection's folder, by file names only."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").load(root).select(F.col("path").alias("file"))
    named = files.select(protocol_of(F.col("file")).alias("protocol_id"), file_name(F.col("file")).alias("name")).where("protocol_id <> ''")
    return named.groupBy("protocol_id").agg(
        F.count_if(F.col("name").endswith("_extraction.json")).alias("n_extractions"), F.count_if(F.col("name").endswith("_resolved.json")).alias("n_resolved"),
        F.bool_or(F.col("name").endswith("_consolidated.json")).alias("has_consolidated"),
    )
