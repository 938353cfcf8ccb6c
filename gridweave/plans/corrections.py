"""Corrections of whole documents: each extraction with its sidecar, by one pass over the joined texts."""

from __future__ import annotations

import copy
import json

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridweave.operators.patch import CorrectionError
from gridweave.session import ship
from gridweave.sources.documents import ARRAYS


def correct(doc: dict, corrections: list[dict]) -> dict:
    """A new document after the corrections in their order; see operators.patch for the rules."""
    out = copy.deepcopy(doc)
    for c in corrections:
        name, op = c.get("target"), c.get("op")
        rows = out.get(name) if name in ARRAYS else None
        if not isinstance(rows, list):
            raise CorrectionError(f"{c.get('id')}: no array {name!r}")
        if op == "add":
            rows.append(c["set"])
            continue
        if op not in ("set", "remove") or "match" not in c:
            raise CorrectionError(f"{c.get('id')}: no match, or unknown op {op!r}")
        hits = [r for r in rows if all(r.get(k) == v for k, v in c["match"].items())]
        if op == "set":
            if len(hits) != 1:
                raise CorrectionError(f"{c.get('id')}: set {c['match']} hits {len(hits)} rows")
            hits[0].update(c["set"])
        else:
            if not hits:
                raise CorrectionError(f"{c.get('id')}: remove {c['match']} hits no rows")
            out[name] = [r for r in rows if not any(r is h for h in hits)]
    return out


def verified(extractions: DataFrame, sidecars: DataFrame) -> DataFrame:
    """file, text, error of every extraction that has a sidecar (even an empty one): its corrected text, or why there is none.

    Both have file and text; a sidecar's file is named _corrections.json where the extraction's is named _extraction.json.
    """
    ship(extractions.sparkSession)

    @F.pandas_udf("text string, error string")
    def fold(docs: pd.Series, cars: pd.Series) -> pd.DataFrame:
        out = []
        for d, c in zip(docs, cars):
            try:
                out.append((json.dumps(correct(json.loads(d), json.loads(c)["corrections"]), ensure_ascii=False), None))
            except (CorrectionError, ValueError, KeyError, TypeError) as e:
                out.append((None, str(e)))
        return pd.DataFrame(out, columns=["text", "error"])

    cars = sidecars.select(F.regexp_replace("file", r"_corrections\.json$", "_extraction.json").alias("file"), F.col("text").alias("_car"))
    both = extractions.select("file", "text").join(cars, "file").select("file", fold("text", "_car").alias("r"))
    return both.select(F.regexp_replace("file", r"\.json$", ".verified.json").alias("file"), "r.text", "r.error")
