"""Findings on the consolidated layer: errors that stop its being written, and warnings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridweave.operators import quality, xref
from gridweave.plans.consolidate import Consolidated, source_tables
from gridweave.plans.resolve import Resolved
from gridweave.session import kept

#: The form of the ids, of three digits and of more from 1,000 on, and from how many pairs and characters text counts as damaged.
FORMS = {"xact_id": r"\Axact-\d{3,}\z", "xcol_id": r"\Axcol-\d{3,}\z", "xannot_id": r"\Axannot-\d{3,}\z"}
PAIRS, BLOCK = 3, 100
#: Kinds of findings that are planned and written together.
STEPS = 5


def findings(c: Consolidated, r: Resolved | None = None) -> DataFrame:
    """protocol_id, severity (error or warning), step, subject, detail."""
    out: list[DataFrame] = []

    def add(df: DataFrame, severity: str, step: str, subject, detail=F.lit("")) -> None:
        out.append(df.select("protocol_id", F.lit(severity).alias("severity"), F.lit(step).alias("step"), subject.cast("string").alias("subject"), detail.cast("string").alias("detail")))

    for df, ident in ((c.activities, "xact_id"), (c.columns, "xcol_id"), (c.annotations, "xannot_id")):
        add(df.where(~F.col(ident).rlike(FORMS[ident])), "error", "id_form", F.col(ident))
    add(c.activities.where("coalesce(activity_name, '') = ''"), "warning", "empty_name", F.col("xact_id"))
    add(c.activities.where("coalesce(size(source_refs), 0) <= 0"), "warning", "no_source", F.col("xact_id"))
    acts = c.activities.select("protocol_id", "xact_id")
    cols = c.columns.select("protocol_id", "xcol_id")
    props = c.properties.select("protocol_id", F.col("property_id").alias("prop"))
    pair = c.annotations.select("protocol_id", "xannot_id", F.explode("cell_references").alias("cell")).select("protocol_id", "xannot_id", F.split_part("cell", F.lit("|"), F.lit(1)).alias("xact_id"), F.split_part("cell", F.lit("|"), F.lit(2)).alias("xcol_id"))
    refs = [
        (c.matrix, acts, "xact_id", "matrix_activity"), (c.matrix, cols, "xcol_id", "matrix_column"), (pair, acts, "xact_id", "cell_activity"), (pair, cols, "xcol_id", "cell_column"),
        (c.annotations.select("protocol_id", F.explode("referenced_xacts").alias("xact_id")), acts, "xact_id", "note_activity"),
        (c.annotations.select("protocol_id", F.explode("referenced_xcols").alias("xcol_id")), cols, "xcol_id", "note_column"),
        (c.annotations.select("protocol_id", F.explode("referenced_props").alias("prop")), props, "prop", "note_property"),
    ]
    for used, known, ident, step in refs:
        add(xref.undefined(used, known, ["protocol_id", ident]), "error", step, F.col(ident))
    none = lambda a: F.coalesce(F.size(a), F.lit(0)) <= 0
    add(c.annotations.where(none("referenced_xacts") & none("referenced_xcols") & none("referenced_props") & none("cell_references")), "warning", "orphan", F.col("xannot_id"))
    pairs = quality.adjacent_containment(c.annotations, ["protocol_id"], ["first_order"], "xannot_id", "annotation_text")
    add(pairs.groupBy("protocol_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= PAIRS), "warning", "fragmented", F.col("n"))
    keyed = c.annotations.withColumn("_id", F.concat_ws("\u0001", "protocol_id", "xannot_id"))
    blocks = quality.duplicated_blocks(keyed, "_id", "annotation_text").where(F.col("block_chars") >= BLOCK)
    blocks = blocks.select(F.split_part("_id", F.lit("\u0001"), F.lit(1)).alias("protocol_id"), F.split_part("_id", F.lit("\u0001"), F.lit(2)).alias("xannot_id"), "block_chars")
    add(blocks, "warning", "over_merged", F.col("xannot_id"), F.col("block_chars"))
    names = c.activities.select("protocol_id", "xact_id", "activity_name", "is_section_header")
    bound = c.annotations.select("protocol_id", "xannot_id", F.explode("referenced_xacts").alias("xact_id")).join(names, ["protocol_id", "xact_id"], "left")
    named = bound.groupBy("protocol_id", "xannot_id").agg(F.collect_set(F.coalesce("activity_name", "xact_id")).alias("names"))
    tables = c.annotations.select("protocol_id", "xannot_id", F.transform("source_occurrences", lambda o: o["table_num"]).alias("tables"))
    add(quality.binding_conflicts(tables.join(named, ["protocol_id", "xannot_id"]), ["protocol_id", "xannot_id"], F.col("tables"), F.col("names")), "warning", "binding_conflict", F.col("xannot_id"), F.col("n_names"))
    add(bound.where("is_section_header"), "warning", "header_bound", F.col("xannot_id"), F.col("activity_name"))
    add(quality.degenerate(c.annotations, ["protocol_id"], "annotation_type", "source_note"), "warning", "degenerate_typing", F.col("n"))
    if r is not None:
        lost = source_tables(r).select("protocol_id", F.explode("property_hierarchy").alias("p")).select("protocol_id", F.col("p.property_name").alias("property_name")).where("property_name <> ''")
        add(xref.undefined(lost, c.properties, ["protocol_id", "property_name"]), "warning", "property_missing", F.col("property_name"))
    df = None
    for i in range(0, len(out), STEPS):  # one plan of all of them would fill the driver
        some = out[i]
        for o in out[i + 1 : i + STEPS]:
            some = some.unionByName(o)
        some = kept(some, "findings")
        df = some if df is None else df.unionByName(some)
    return df


def status(found: DataFrame) -> DataFrame:
    """protocol_id, n_errors, n_warnings of protocols with findings."""
    return found.groupBy("protocol_id").agg(F.count_if(F.col("severity") == "error").alias("n_errors"), F.count_if(F.col("severity") == "warning").alias("n_warnings"))
