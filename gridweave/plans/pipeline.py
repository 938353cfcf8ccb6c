"""The steps in order, with collected errors and metrics; and their command line."""

from __future__ import annotations

import argparse
from collections.abc import Callable
from dataclasses import dataclass, field
from time import monotonic
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridweave.plans import consolidate, corrections, document_out, inventory, resolve, validate
from gridweave.session import materialise
from gridweave.sources import documents, sinks, tables

#: Findings that are listed as messages, in order; error_counts() counts all.
LISTED = 1000


@dataclass
class Context:
    """What the steps hand on: results by step, errors, counters and times."""

    spark: SparkSession
    root: str
    protocols: list[str] | None = None  # only these are worked on
    results: dict[str, Any] = field(default_factory=dict)
    errors: list[tuple[str, str]] = field(default_factory=list)  # messages; of findings the first LISTED
    listed: slice = field(default_factory=lambda: slice(0, 0))  # where findings stand in errors
    counters: dict[str, int] = field(default_factory=dict)
    seconds: dict[str, float] = field(default_factory=dict)

    def error_counts(self) -> DataFrame:
        """step, n of the errors: of all findings, whatever part of them errors lists, and of those that steps add to errors."""
        own = self.spark.createDataFrame(self.errors[: self.listed.start] + self.errors[self.listed.stop :], "step string, message string").select("step")
        if "validate" in self.results:
            own = own.unionByName(self.results["validate"].where("severity = 'error'").select("step"))
        if "broken" in self.results:
            own = own.unionByName(self.results["broken"].select(F.lit("resolve").alias("step")))
        return own.groupBy("step").agg(F.count(F.lit(1)).alias("n"))


Step = Callable[[Context], Any]


def _chosen(ctx: Context, files: DataFrame) -> DataFrame:
    """The files of the protocols that the run is about."""
    return files if ctx.protocols is None else files.where(documents.protocol_of(F.col("file")).isin(ctx.protocols))


def apply_corrections(ctx: Context) -> DataFrame:
    """Corrected texts; an ambiguous correction ends the run."""
    texts, cars = (_chosen(ctx, documents.read_texts(ctx.spark, ctx.root, p)) for p in ("*_extraction.json", "*_corrections.json"))
    done = materialise(corrections.verified(texts, cars), "verified")
    ctx.results["verified"] = done
    bad = done.where("error is not null").limit(20).collect()
    if bad:
        raise ValueError("; ".join(f"{r['file']}: {r['error']}" for r in bad))
    return texts.join(done.select(F.regexp_replace("file", r"\.verified\.json$", ".json").alias("file"), F.col("text").alias("_v")), "file", "left").select("file", F.coalesce("_v", "text").alias("text"))


def resolve_tables(ctx: Context) -> resolve.Resolved:
    texts = ctx.results["apply_corrections"].withColumn("protocol_id", documents.protocol_of(F.col("file")))
    parsed = materialise(documents.parse_extractions(texts, "text", ["protocol_id", "file"]), "parsed")
    ctx.results["broken"] = parsed.where("is_broken").select("protocol_id", "file")
    docs = parsed.where("not is_broken")
    keyed = docs.select("protocol_id", F.col("doc.table_metadata.table_number").alias("table_number"), "file", "doc")
    ctx.results["documents"] = materialise(keyed, "documents")
    r = resolve.resolve(ctx.results["documents"])
    return resolve.Resolved(**{k: materialise(df, k) for k, df in r.all().items()})


def consolidate_tables(ctx: Context) -> consolidate.Consolidated:
    c = consolidate.consolidate(ctx.results["resolve"])
    return consolidate.Consolidated(**{k: materialise(df, k) for k, df in c.all().items()})


def check(ctx: Context) -> DataFrame:
    return materialise(validate.findings(ctx.results["consolidate"], ctx.results["resolve"]), "findings")


def take_stock(ctx: Context) -> dict[str, DataFrame]:
    source = inventory.source_rows(ctx.results["resolve"])
    c = ctx.results["consolidate"]
    rows = inventory.entity_rows(c.activities, c.sources, source)
    return {"source": source, "entities": rows, "counts": inventory.counts(rows, source), "index": inventory.index_rows(ctx.results["consolidate"], ctx.results["resolve"])}


STEPS: list[tuple[str, Step]] = [
    ("apply_corrections", apply_corrections), ("resolve", resolve_tables), ("consolidate", consolidate_tables), ("validate", check), ("inventory", take_stock),
]


def run(spark: SparkSession, root: str, out: str | None = None, steps: list[tuple[str, Step]] = STEPS, protocols: list[str] | None = None) -> Context:
    """All steps over a collection's folder, or over some of its protocols. Protocols with errors are left out of what is written below
    `out`; documents that are none, or lack an array, are errors too, and do not stop the others."""
    ctx = Context(spark, root, protocols)
    for name, step in steps:
        began = monotonic()
        ctx.results[name] = step(ctx)
        ctx.seconds[name] = monotonic() - began
        ctx.counters[name] = ctx.counters.get(name, 0) + 1
    if "validate" in ctx.results:
        found = ctx.results["validate"]
        errors = found.where("severity = 'error'").select("step", F.concat_ws(": ", "protocol_id", "subject").alias("message"))
        if "broken" in ctx.results:
            errors = errors.unionByName(ctx.results["broken"].select(F.lit("resolve").alias("step"), F.concat(F.col("file"), F.lit(": no extraction document")).alias("message")))
        first = errors.orderBy("step", "message").limit(LISTED).collect()
        ctx.errors += [(r["step"], r["message"]) for r in first]
        ctx.listed = slice(len(ctx.errors) - len(first), len(ctx.errors))
        if out:
            _write(ctx, out)
    return ctx


def _write(ctx: Context, out: str) -> None:
    """Tables as Parquet, documents as JSON files named as their kind is."""
    bad = ctx.results["validate"].where("severity = 'error'").select("protocol_id").distinct()
    r, c = ctx.results["resolve"], ctx.results["consolidate"]
    sinks.write_tables(r.all() | {"status": resolve.table_status(r)}, f"{out}/resolved", ["protocol_id"])
    sinks.write_tables({k: df.join(bad, "protocol_id", "left_anti") for k, df in c.all().items()}, f"{out}/consolidated", ["protocol_id"])
    sinks.write_tables({k: df for k, df in ctx.results["inventory"].items()}, f"{out}/inventory")
    own = lambda folder: F.concat_ws("/", "protocol_id", F.lit(folder), "name").alias("name")
    ctx.counters["resolved documents"] = sinks.write_files(document_out.resolved_documents(ctx.results["documents"], r).select(own("resolved"), "text"), f"{out}/documents")
    whole = document_out.consolidated_documents(r, c).join(bad, "protocol_id", "left_anti")
    ctx.counters["consolidated documents"] = sinks.write_files(whole.select(own("consolidated"), "text"), f"{out}/documents")
    checked = ctx.results["verified"].select(documents.protocol_of(F.col("file")).alias("protocol_id"), documents.file_name(F.col("file")).alias("name"), "text")
    ctx.counters["verified documents"] = sinks.write_files(checked.select(own("verified"), "text"), f"{out}/documents")
    stock = ctx.results["inventory"]
    lines = stock["entities"].select("protocol_id", F.to_json(F.struct(*[F.col(x) for x in stock["entities"].columns])).alias("value"))
    lines.write.mode("overwrite").partitionBy("protocol_id").text(f"{out}/activities")
    page = sinks.page("Protocols", stock["index"].orderBy("protocol_id"))
    sinks.write_files(ctx.spark.createDataFrame([("index.html", page)], "name string, text string"), f"{out}/documents")


def main(args: list[str] | None = None) -> None:
    from gridweave.session import build_session

    p = argparse.ArgumentParser(prog="gridweave", description="Resolve and consolidate a collection of table documents.")
    p.add_argument("root")
    p.add_argument("--out")
    p.add_argument("--protocols", help="a manifest (CSV, Excel or Parquet) whose studies alone are worked on")
    p.add_argument("--only", nargs="*", help="protocols to work on")
    a = p.parse_args(args)
    spark = build_session()
    only = a.only
    if a.protocols:  # as many names as the manifest has studies
        only = sorted({r[0] for r in tables.read_manifest(spark, a.protocols).select("study_key").distinct().collect()} & (set(only) if only else {r["protocol_id"] for r in documents.protocols_below(spark, a.root).collect()}))
    ctx = run(spark, a.root, a.out, protocols=only)
    index = ctx.results["inventory"]["index"]
    index.orderBy("protocol_id").show(LISTED, truncate=False)
    if (n := index.count()) > LISTED:
        print(f"the first {LISTED} of {n}")
    ctx.results["inventory"]["counts"].show(truncate=False)
    for step, message in ctx.errors:
        print(f"{step}: {message}")


if __name__ == "__main__":
    main()
