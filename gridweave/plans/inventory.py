"""Inventories of a collection: source rows, consolidated rows with their occurrences, counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridweave.functions import classify
from gridweave.plans.consolidate import Consolidated
from gridweave.plans.resolve import KEY, Resolved


def study_fields(studies: DataFrame, derived: dict[str, dict] | None = None) -> DataFrame:
    """study_key, sponsor, therapeutic_area: the manifest's value, else one derived by a rule from another column, else empty."""
    cols = []
    for name in ("sponsor", "therapeutic_area"):
        own = F.trim(F.coalesce(F.col(name), F.lit(""))) if name in studies.columns else F.lit("")
        rule = (derived or {}).get(name)
        other = classify.derived(rule["rule"], F.col(rule["from"])) if rule else F.lit("")
        cols.append(F.when(own != "", own).otherwise(other).alias(name))
    return studies.select("study_key", *cols)


def source_rows(r: Resolved, studies: DataFrame | None = None) -> DataFrame:
    """A row for each activity of each table, with its notes (legends apart) and its study's fields."""
    notes = r.annotations.where("annotation_type <> 'legend'").select(*KEY, "annotation_id", F.col("annotation_marker").alias("marker"), F.col("annotation_text").alias("text"))
    linked = r.edges.where("kind = 'activity'").select(*KEY, "annotation_id", "note_pos", F.col("element").alias("activity_id")).join(notes, [*KEY, "annotation_id"])
    lists = linked.groupBy(*KEY, "activity_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("note_pos", "marker", "text"))), lambda n: F.struct(n["marker"].alias("marker"), n["text"].alias("text"))).alias("annotations"))
    up = r.activities.select(*KEY, F.col("activity_id").alias("parent_activity_id"), F.col("activity_name").alias("parent_name"))
    rows = r.activities.join(r.tables.select(*KEY, "table_id", "table_title", "table_type", "track_label"), KEY).join(up, [*KEY, "parent_activity_id"], "left").join(lists, [*KEY, "activity_id"], "left")
    out = rows.select(
        *KEY, "table_id", "table_title", "table_type", "track_label", "activity_id", "row_position", "activity_name", F.coalesce("parent_name", F.lit("")).alias("parent_name"), "hierarchy_level",
        "is_section_header", "is_redacted", "has_schedule_data", F.coalesce("annotation_markers", F.lit("")).alias("annotation_markers"), "annotations",
    )
    return out if studies is None else out.join(studies.withColumnRenamed("study_key", "protocol_id"), "protocol_id", "left").fillna("", ["sponsor", "therapeutic_area"])


def entity_rows(activities: DataFrame, sources: DataFrame, source: DataFrame) -> DataFrame:
    """A row for each consolidated activity: its occurrences by table and row, wordings, notes once each by text, tables and marks."""
    occ = sources.select(*KEY, "activity_id", "xact_id").join(source, [*KEY, "activity_id"])
    place = F.struct("table_number", "row_position")
    per = occ.groupBy("protocol_id", "xact_id").agg(
        F.sort_array(F.collect_list(F.struct("table_number", "row_position", "table_title", "table_type", F.col("activity_name").alias("verbatim_name"), "has_schedule_data"))).alias("occurrences"),
        F.array_sort(F.collect_set("table_number")).alias("tables"), F.bool_or("has_schedule_data").alias("any_marks"), F.min_by("parent_name", place).alias("first_parent"),
    )
    notes = occ.select("protocol_id", "xact_id", "table_number", "row_position", F.posexplode("annotations").alias("at", "n"))
    once = notes.groupBy("protocol_id", "xact_id", F.col("n.text").alias("text")).agg(F.min(F.struct("table_number", "row_position", "at", "n.marker")).alias("f"))
    texts = once.groupBy("protocol_id", "xact_id").agg(F.sort_array(F.collect_list(F.struct(F.col("f.table_number").alias("table_number"), F.col("f.row_position").alias("row"), F.col("f.at").alias("at"), F.col("f.marker").alias("marker"), "text"))).alias("annotations"))
    both = activities.join(per, ["protocol_id", "xact_id"], "left").join(texts, ["protocol_id", "xact_id"], "left")
    variants = F.array_distinct(F.filter(F.transform("occurrences", lambda o: o["verbatim_name"]), lambda v: v != ""))
    return both.select(
        "protocol_id", "xact_id", "activity_name", "parent_name", "hierarchy_level", "display_order", "is_section_header", "is_redacted", "match_status", F.size("occurrences").alias("table_count"),
        "tables", "any_marks", variants.alias("variants"), "occurrences", "annotations",
    )


def counts(entities: DataFrame, source: DataFrame) -> DataFrame:
    """One row of totals."""
    a = source.agg(F.countDistinct("protocol_id").alias("protocols"), F.count(F.lit(1)).alias("source_table_rows"))
    b = entities.agg(
        F.count(F.lit(1)).alias("consolidated_activities"), F.count_if(F.col("table_count") > 1).alias("multi_table_activities"),
        F.count_if(F.size("variants") > 1).alias("activities_with_wording_variants"), F.count_if("is_redacted").alias("redacted_activities"),
    )
    return a.crossJoin(b).withColumn("folded", F.col("source_table_rows") - F.col("consolidated_activities"))  # one row beside one row


def index_rows(c: Consolidated, r: Resolved) -> DataFrame:
    """A row for each protocol of a collection: tables, activities, columns, redacted ones, how far it was folded."""
    t = r.tables.groupBy("protocol_id").agg(F.count(F.lit(1)).alias("n_tables"))
    cols = c.columns.groupBy("protocol_id").agg(F.count(F.lit(1)).alias("n_columns"))
    red = c.activities.groupBy("protocol_id").agg(F.count_if("is_redacted").alias("n_redacted"))
    return t.join(cols, "protocol_id", "left").join(red, "protocol_id", "left").join(c.stats.select("protocol_id", "unified_activity_count", "compression_percent"), "protocol_id", "left").fillna(0)
