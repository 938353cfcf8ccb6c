"""Sinks: Parquet of every table, JSON documents, small HTML pages."""

from __future__ import annotations

import html
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridweave.session import map_arrow


def write_tables(tables: dict[str, DataFrame], path: str, partition: list[str] = ()) -> None:
    """Every table as Parquet below a path: the form in which the engine keeps its results."""
    for name, df in tables.items():
        df.write.mode("overwrite").partitionBy(*partition).parquet(f"{path}/{name}")


def to_document(struct: Column, keep_null: list[str]) -> Column:
    """JSON text of a struct where fields that are null are left out, but for those named, which stay as null."""
    lean = F.to_json(struct)
    nulls = [F.when(struct[n].isNull(), F.lit(f'"{n}":null')) for n in keep_null]
    extra = F.array_join(F.filter(F.array(*nulls), lambda x: x.isNotNull()), ",") if nulls else F.lit("")
    body = F.substring(lean, F.lit(1), F.length(lean) - 1)
    comma = F.when((extra != "") & (body != "{"), ",").otherwise("")
    return F.concat(body, comma, extra, F.lit("}"))


def write_documents(docs: DataFrame, path: str, name: str = "name", text: str = "text") -> None:
    """One JSON line a document, in a folder for each name."""
    docs.select(F.col(name).alias("document"), F.col(text).alias("value")).write.mode("overwrite").partitionBy("document").text(path)


def write_files(docs: DataFrame, path: str, name: str = "name", text: str = "text") -> int:
    """Every document as a file of its own name (which may hold folders) below a path that all executors see. A file is written
    beside its place and moved there when whole, so a task that runs twice does no harm. The number of documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = fs.FileSystem.from_uri(path if "://" in path else f"file://{path}")
        n = 0
        for b in batches:
            for own, body in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                folder, _, last = f"{root}/{own}".rpartition("/")
                files.create_dir(folder, recursive=True)
                part = f"{folder}/.{last}.{uuid.uuid4().hex}"
                with files.open_output_stream(part) as out:
                    out.write(body.encode())
                files.move(part, f"{folder}/{last}")
                n += 1
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], names=["n"])

    kept = docs.where(F.col(name).isNotNull() & F.col(text).isNotNull()).select(name, text)
    return map_arrow(kept, run, "n long").agg(F.sum("n").alias("n")).first()["n"] or 0


def page(title: str, df: DataFrame, most: int = 1000) -> str:
    """An HTML page with a table of the first `most` rows in the order they come, and, if there are more, their number: a view of a
    report, not an export."""
    rows = df.limit(most + 1).collect()
    more = f"<p>The first {most} of {df.count()} rows.</p>" if len(rows) > most else ""
    rows = rows[:most]
    head = "".join(f"<th>{html.escape(c)}</th>" for c in df.columns)
    cell = lambda v: html.escape("" if v is None else str(v))
    body = "".join("<tr>" + "".join(f"<td>{cell(v)}</td>" for v in r) + "</tr>" for r in rows)
    return f"<!doctype html><meta charset=utf-8><title>{html.escape(title)}</title><h1>{html.escape(title)}</h1>{more}<table><tr>{head}</tr>{body}</table>"


def script_safe(json_text: Column) -> Column:
    """JSON that may stand inside a script element."""
    return F.replace(json_text, F.lit("</"), F.lit("<\\/"))
