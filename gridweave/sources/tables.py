"""Manifests, descriptors, transcripts and word boxes."""

from __future__ import annotations

import io
import json
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from gridweave.session import map_arrow

#: The columns that may name a study, in order of preference; a caller may give more.
STUDY_KEYS = ("protocol_id", "nct_id")
WORDS = "_xMin double, _yMin double, _xMax double, _yMax double, _VALUE string"


def read_manifest(spark: SparkSession, path: str, names: tuple[str, ...] = STUDY_KEYS) -> DataFrame:
    """A manifest table (CSV with a header, Excel, or Parquet) with study_key, the first non-empty of names; rows without are dropped.
    A file that cannot be read gives an empty manifest."""
    try:
        if path.endswith(".xlsx"):
            df = read_excel(spark, path)
        else:
            df = spark.read.parquet(path) if path.endswith(".parquet") else spark.read.option("header", True).csv(path)
    except (AnalysisException, zipfile.BadZipFile, KeyError, ElementTree.ParseError):
        return spark.createDataFrame([], "study_key string")
    keys = [F.nullif(F.trim(F.col(k).cast("string")), F.lit("")) for k in names if k in df.columns]
    if not keys:
        return spark.createDataFrame([], "study_key string")
    return df.withColumn("study_key", F.coalesce(*keys)).where("study_key is not null")


def _sheet(body: bytes) -> list[dict[int, str]]:
    """The rows of the first sheet of a workbook: texts by number of column."""
    place = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
    with zipfile.ZipFile(io.BytesIO(body)) as z:
        names = z.namelist()
        shared = []
        if "xl/sharedStrings.xml" in names:
            shared = ["".join(t.text or "" for t in si.iter(f"{place}t")) for si in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).iter(f"{place}si")]
        first = min((n for n in names if re.fullmatch(r"xl/worksheets/sheet\d+\.xml", n)), key=lambda n: int(re.findall(r"\d+", n)[-1]), default=None)
        sheet = ElementTree.fromstring(z.read(first or "xl/worksheets/sheet1.xml"))
    rows = []
    for row in sheet.iter(f"{place}row"):
        cells = {}
        for at, c in enumerate(row.iter(f"{place}c")):
            letters = re.match("[A-Z]+", c.get("r") or "")
            col = at if letters is None else sum((ord(x) - 64) * 26**i for i, x in enumerate(reversed(letters[0]))) - 1
            v = c.find(f"{place}v")
            if c.get("t") == "inlineStr":
                cells[col] = "".join(t.text or "" for t in c.iter(f"{place}t"))
            elif v is not None and v.text is not None:
                cells[col] = shared[int(v.text)] if c.get("t") == "s" else v.text
        rows.append(cells)
    return rows


def read_excel(spark: SparkSession, path: str) -> DataFrame:
    """The first sheet of an Excel workbook (a manifest: one small file) as texts; its first row names the columns."""
    found = spark.read.format("binaryFile").load(path).select("content").limit(1).collect()
    rows = _sheet(bytes(found[0]["content"])) if found else []
    names = {i: n.strip() for i, n in (rows[0] if rows else {}).items() if n and n.strip()}
    if not names:
        return spark.createDataFrame([], "study_key string")
    return spark.createDataFrame([tuple(r.get(i) for i in names) for r in rows[1:] if r], ", ".join(f"`{n}` string" for n in names.values()))


def merge_sheets(studies: DataFrame, sheet: DataFrame, columns: list[str]) -> DataFrame:
    """studies with the given columns of a second sheet where that has the study; both by study_key."""
    more = sheet.groupBy("study_key").agg(*[F.max(c).alias(f"_m_{c}") for c in columns])
    both = studies.join(more, "study_key", "left")
    old = [F.col(c) if c in studies.columns else F.lit(None) for c in columns]
    return both.select(*[c for c in studies.columns if c not in columns], *[F.coalesce(f"_m_{c}", o).alias(c) for c, o in zip(columns, old)])


def read_descriptor(spark: SparkSession, path: str) -> dict:
    """A collection's descriptor (one small JSON document) as a dict; {} if there is none."""
    try:
        rows = spark.read.text(path, wholetext=True).limit(1).collect()
    except AnalysisException:
        return {}
    return json.loads(rows[0][0]) if rows else {}


def _tool_uses(text: str | None) -> list[tuple[str | None, str | None]]:
    """Name and input (as JSON) of every tool_use object in a line, outer ones first."""
    try:
        stack = [json.loads(text or "")]
    except (ValueError, RecursionError):
        return []
    found = []
    while stack:
        node = stack.pop()
        if isinstance(node, dict):
            if node.get("type") == "tool_use":
                name, given = node.get("name"), node.get("input")
                found.append((name if isinstance(name, str) or name is None else json.dumps(name), None if given is None else json.dumps(given, ensure_ascii=False, separators=(",", ":"))))
            stack.extend(reversed(node.values()))
        elif isinstance(node, list):
            stack.extend(reversed(node))
    return found


def tool_calls(lines: DataFrame, text: str = "value", keep: list[str] = ()) -> DataFrame:
    """tool, input, ordinal of every object with type tool_use in JSON lines, however deep it stands, with columns of the line to keep;
    lines that are no JSON give none. ordinal orders the calls of lines that were read in order."""
    schema = "".join(f"{c} {t}, " for c, t in lines.select(*keep).dtypes) if keep else ""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [(i, *u, (at << 20) + k) for i, (t, at) in enumerate(zip(b.column(0).to_pylist(), b.column(1).to_pylist())) for k, u in enumerate(_tool_uses(t))]
            rows = pa.array([x[0] for x in found], pa.int64())
            cols = [*(b.column(2 + i).take(rows) for i in range(len(keep))), pa.array([x[1] for x in found], pa.string()), pa.array([x[2] for x in found], pa.string()), pa.array([x[3] for x in found], pa.int64())]
            yield pa.RecordBatch.from_arrays(cols, names=[*keep, "tool", "input", "ordinal"])

    numbered = lines.select(F.col(text), F.pmod(F.monotonically_increasing_id(), F.lit(1 << 42)).alias("_at"), *keep)
    return map_arrow(numbered, run, schema + "tool string, input string, ordinal long")


def json_strings(docs: DataFrame, text: str) -> DataFrame:
    """doc_text_sha, value: every string that stands in a JSON text, decoded."""
    literal = r'"(?:[^"\\]++|\\.)*+"\s*+:?'
    found = F.filter(F.regexp_extract_all(text, F.lit(literal), F.lit(0)), lambda x: ~x.endswith(":"))  # not the keys
    raw = docs.select(F.sha2(text, 256).alias("doc_text_sha"), F.explode(found).alias("r"))
    value = F.from_json(F.concat(F.lit('{"v":'), F.trim("r"), F.lit("}")), "v string")["v"]
    return raw.select("doc_text_sha", value.alias("value"))


def read_words(spark: SparkSession, path: str) -> DataFrame:
    """page_file, x0, y0, x1, y1, text of word boxes in XHTML files, control characters dropped."""
    words = spark.read.schema(WORDS).format("xml").option("rowTag", "word").load(path)
    text = F.trim(F.regexp_replace("_VALUE", r"[\x00-\x1F\x7F]", ""))
    return words.select(F.col("_metadata.file_path").alias("page_file"), F.col("_xMin").alias("x0"), F.col("_yMin").alias("y0"), F.col("_xMax").alias("x1"), F.col("_yMax").alias("y1"), text.alias("text"))


def stale(sources: DataFrame, outputs: DataFrame, key: str) -> DataFrame:
    """Sources (key, modified) that have no output as new as they are."""
    made = outputs.groupBy(key).agg(F.max("modified").alias("_made"))
    return sources.join(made, key, "left").where(F.col("_made").isNull() | (F.col("modified") > F.col("_made"))).drop("_made")
