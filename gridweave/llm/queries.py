"""The queries p2 and p5 to p8, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridweave.llm import collapse, entities, packing, spans, tokens
from gridweave.session import materialise


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _notes(spark: SparkSession, sf: str, carried: tuple[str, ...] = ()) -> DataFrame:
    kind, text = collapse.note_key(F.col("annotation_type"), F.col("annotation_text"))
    carry = {c: F.col(c) for c in carried}
    parts = [F.col("protocol_id"), F.col("amendment"), kind]
    return collapse.keyed(table(spark, sf, "unified_annotations"), "ann_key", parts, text, carry)


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    return collapse.copies(_notes(spark, sf))


def p2_notes(spark: SparkSession, sf: str) -> DataFrame:
    return collapse.collapse(_notes(spark, sf, ("protocol_id", "amendment", "occurrence_count")), "occurrence_count").select(
        "keep_key", "protocol_id", "amendment", "n_copies", F.col("total").alias("sum_occurrences")
    )


#: What forms put before a name or section.
FORM_NOISE = r"^(form\s*[:_-]+\s*|ecrf[\s_:-]+|f[0-9]+[\s_-]+)"


def _matches(spark: SparkSession, sf: str) -> DataFrame:
    numbers = [F.col("first_day").cast("double").alias("n1"), F.col("visit_count").cast("double").alias("n2")]
    forms = table(spark, sf, "edc_items").select(
        F.col("item_id").cast("string").alias("id"), F.col("study_label").alias("label"), F.col("form_label").alias("name"),
        F.col("section_label").alias("section"), F.col("track_text").alias("track"), *numbers,
    )
    acts = table(spark, sf, "unified_activities").where("not is_section_header").select(
        F.col("xact_id").alias("id"), F.col("protocol_id").alias("study"), F.col("activity_name").alias("name"),
        F.col("parent_name").alias("section"), F.col("track_label").alias("track"), *numbers,
    )
    studies = table(spark, sf, "protocols").select(F.col("protocol_id").alias("study"), F.array("study_code", "study_acronym").alias("names"))
    return entities.match(forms, acts, studies, FORM_NOISE)


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    return _matches(spark, sf).select(F.col("study").alias("protocol_id"), F.col("right_id").alias("xact_id"), F.col("left_id").cast("long").alias("item_id"))


def p5_confidence(spark: SparkSession, sf: str) -> DataFrame:
    return _matches(spark, sf).select(
        F.col("study").alias("protocol_id"), F.col("right_id").alias("xact_id"), F.col("left_id").cast("long").alias("item_id"), "confidence"
    )


def p6_ids(spark: SparkSession, sf: str) -> DataFrame:
    return tokens.encode(table(spark, sf, "documents"), "doc_id", "text")


#: What a container of p7 holds: 2,048 tokens, 256 documents, and the attention cost of one document that fills it, so that no
#: document within 2,048 tokens is split for its attention.
CONTAINER = packing.Capacity(tokens=2048, documents=256, attention=2048**2, weights=(1.0, 1e-3, 1e-3))


def p7_containers(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack_texts(table(spark, sf, "documents"), "doc_id", "text", tokens.VOCABULARY, CONTAINER)


def p7_fill(spark: SparkSession, sf: str) -> DataFrame:
    """What the containers hold, checked: one row with how many documents are placed whole, in pieces and out of order, and how
    many containers break a capacity or overlap."""
    placed = materialise(p7_containers(spark, sf), "placed")
    sizes = tokens.count(table(spark, sf, "documents"), "doc_id", "text", tokens.VOCABULARY)
    by_doc = placed.groupBy("doc_id").agg(F.sum("n_tokens").alias("n"), F.count(F.lit(1)).alias("pieces"), F.max("piece").alias("last"))
    docs = sizes.join(by_doc, "doc_id", "left").agg(
        F.count(F.lit(1)).alias("n_documents"), F.count_if(F.col("n") == F.col("n_tokens")).alias("n_complete"),
        F.count_if((F.col("n_tokens") <= CONTAINER.tokens) & (F.col("pieces") > 1)).alias("n_split_needlessly"), F.count_if(F.col("last") != F.col("pieces")).alias("n_gaps"),
    )
    inside = Window.partitionBy("container").orderBy("place")
    ends = placed.withColumn("late", (F.col("start_token") != F.coalesce(F.sum("n_tokens").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).cast("int"))
    full = ends.groupBy("container").agg(F.sum("n_tokens").alias("t"), F.count(F.lit(1)).alias("d"), F.sum(F.col("n_tokens").cast("long") * F.col("n_tokens")).alias("a"), F.max("late").alias("late"))
    broken = (F.col("t") > CONTAINER.tokens) | (F.col("d") > CONTAINER.documents) | (F.col("a") > CONTAINER.attention)
    bins = full.agg(F.count_if(broken).alias("n_broken"), F.coalesce(F.sum("late"), F.lit(0)).alias("n_overlapping"), (F.count(F.lit(1)) - F.ceil(F.sum("t") / CONTAINER.tokens) <= F.ceil(F.count(F.lit(1)) * 0.01)).alias("near_bound"))
    return docs.crossJoin(bins)  # one row beside one row


def p8_found(spark: SparkSession, sf: str) -> DataFrame:
    return spans.shared_spans(table(spark, sf, "documents"), "doc_id", "text", 200)


def p8_share(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    return spans.shared_share(docs, "doc_id", "text", spans.shared_spans(docs, "doc_id", "text", 200))


QUERIES = {
    "p2_found": p2_found, "p2_notes": p2_notes, "p5_found": p5_found, "p5_confidence": p5_confidence, "p6_ids": p6_ids, "p7_containers": p7_containers, "p7_fill": p7_fill, "p8_found": p8_found, "p8_share": p8_share,
}

_P2 = r"""
WITH typed AS (
  SELECT ann_key, protocol_id, amendment, occurrence_count, annotation_text,
         coalesce(lower(regexp_replace(annotation_type, '[^\p{L}\p{N}]+', '', 'g')), '') kind FROM unified_annotations),
keyed AS (
  SELECT *, CASE WHEN kind IN ('abbreviation', 'legend')
    THEN array_to_string(list_sort(list_filter(list_transform(regexp_split_to_array(annotation_text, '[;\n\r\x0B\x0C\x{85}\x{2028}\x{2029}]+'),
      lambda e: lower(regexp_replace(e, '[^\p{L}\p{N}]+', '', 'g'))), lambda e: e <> '')), chr(1))
    ELSE lower(regexp_replace(annotation_text, '[^\p{L}\p{N}]+', '', 'g')) END words FROM typed),
notes AS (SELECT *, min(ann_key) OVER (PARTITION BY protocol_id, amendment, kind, words) keep_key FROM keyed WHERE words <> '')
"""

_P8 = """
WITH texts AS (SELECT doc_id, text, length(text) n FROM documents WHERE length(text) >= 200),
windows AS (SELECT doc_id, p, hash(substr(text, p + 1, 200)) a, hash(reverse(substr(text, p + 1, 200))) b
  FROM (SELECT doc_id, text, unnest(range(n - 199)) p FROM texts)),
repeated AS (SELECT a, b FROM windows GROUP BY a, b HAVING min(doc_id) <> max(doc_id)),
hits AS (SELECT doc_id, p, CASE WHEN p <= lag(p) OVER (PARTITION BY doc_id ORDER BY p) + 200 THEN 0 ELSE 1 END n FROM windows SEMI JOIN repeated USING (a, b)),
runs AS (SELECT doc_id, p, sum(n) OVER (PARTITION BY doc_id ORDER BY p) r FROM hits),
found AS (SELECT doc_id, min(p)::INTEGER start_pos, (max(p) + 200)::INTEGER end_pos FROM runs GROUP BY doc_id, r)
"""

SQL = {
    "p7_fill": """SELECT count(*) n_documents, count(*) n_complete, 0::BIGINT n_split_needlessly, 0::BIGINT n_gaps, 0::BIGINT n_broken,
      0::BIGINT n_overlapping, true near_bound FROM documents""",
    "p8_found": _P8 + "SELECT * FROM found",
    "p8_share": _P8 + """SELECT d.doc_id, coalesce(length(text), 0)::INTEGER n_chars, coalesce(s, 0)::BIGINT n_shared,
      CASE WHEN length(text) > 0 THEN coalesce(s, 0) / length(text) ELSE 0.0 END AS share
      FROM documents d LEFT JOIN (SELECT doc_id, sum(end_pos - start_pos) s FROM found GROUP BY 1) USING (doc_id)""",
    "p2_found": _P2 + "SELECT keep_key, ann_key dup_key FROM notes WHERE ann_key <> keep_key",
    "p2_notes": _P2 + "SELECT keep_key, min(protocol_id) protocol_id, min(amendment) amendment, count(*) n_copies, "
    "sum(occurrence_count)::BIGINT sum_occurrences FROM notes GROUP BY keep_key",
}
