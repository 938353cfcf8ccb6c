"""Row audit: printed rows of pages against extracted labels, and the assignment of pages to tables."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridweave.functions.text import is_blank, norm_key
from gridweave.operators.islands import after_first
from gridweave.operators.matching import label_matches
from gridweave.session import kept, ship

#: Weight of a caption against label matches; longest label; what makes a column one of labels.
ANCHOR, NOTE_CHARS, COLUMN_RATE, COLUMN_LEAST = 1000, 150, 0.5, 2


def label_columns(texts: DataFrame, matches: DataFrame, group: list[str]) -> DataFrame:
    """group, column: candidate columns of which the labels explain at least two texts and half of all.

    texts: group, page, row, column, text; matches: the result of label_matches() on group and text."""
    some = texts.where(~is_blank(F.col("text"))).join(matches.select(*group, "text").distinct().withColumn("_m", F.lit(1)), [*group, "text"], "left")
    per = some.groupBy(*group, "column").agg(F.count(F.lit(1)).alias("n"), F.sum(F.coalesce("_m", F.lit(0))).alias("m"))
    return per.where((F.col("m") >= COLUMN_LEAST) & (F.col("m") / F.col("n") >= COLUMN_RATE)).select(*group, "column")


def audit_rows(texts: DataFrame, labels: DataFrame, group: list[str], matches: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(unmatched, missing, coverage) of the printed rows of each group (a table) against its labels.

    texts: group, page, row, column, text; labels: group, label. unmatched: printed texts in label columns below the first
    matched row of their page that match no label, is_note for such as are too long for one. missing: labels never seen.
    coverage: bands and matched ones of each page. Groups without label column have no unmatched and no missing rows.
    matches: what label_matches() gives of them, where that is known.
    """
    matches = kept(label_matches(texts, labels, group, "text", "label") if matches is None else matches, "matches")
    columns = kept(label_columns(texts, matches, group), "columns")
    inside = kept(texts.join(columns, [*group, "column"]), "inside")
    hit = inside.join(matches.select(*group, "text").distinct().withColumn("_hit", F.lit(True)), [*group, "text"], "left")
    rows = hit.groupBy(*group, "page", "row").agg(F.coalesce(F.bool_or("_hit"), F.lit(False)).alias("found"))
    body = kept(after_first(rows, [*group, "page"], ["row"], "found"), "body")
    open_rows = body.where("in_body and not found").select(*group, "page", "row")
    unmatched = inside.where(~is_blank(F.col("text"))).join(open_rows, [*group, "page", "row"])
    unmatched = unmatched.select(*group, "page", "row", "column", "text", (F.length(norm_key(F.col("text"))) > NOTE_CHARS).alias("is_note"))
    seen = inside.select(*group, "text").distinct().join(matches, [*group, "text"]).select(*group, "label").distinct()
    audited = columns.select(*group).distinct()
    missing = labels.select(*group, "label").distinct().join(audited, group, "left_semi").join(seen.hint("merge"), [*group, "label"], "left_anti")
    bands = texts.groupBy(*group, "page").agg(F.countDistinct("row").alias("bands"))
    coverage = bands.join(body.groupBy(*group, "page").agg(F.count_if("found").alias("matched")), [*group, "page"], "left")
    return unmatched, missing, coverage.fillna(0, ["matched"])


def assign(scores: np.ndarray, anchors: np.ndarray) -> np.ndarray:
    """The table of each page, or -1, so that tables follow one another and as many bands as possible are explained.

    scores: pages x tables; anchors: the table that a page's caption names, or -1. Such a page can only go there and weighs ANCHOR
    more. Of equal sums a table takes no page, before it takes one, before a page is left out.

    A table that takes pages up to p earns what the tables before it had earned up to some q, and its own gains from there: with
    prefix sums of the gains that is one running maximum over the pages, cut where a caption names another table.
    """
    n, m = scores.shape
    gain = scores + np.where(anchors[:, None] == np.arange(m), ANCHOR, 0)
    free = anchors[:, None] == -1
    takes = (gain > 0) & (free | (anchors[:, None] == np.arange(m)))
    closed = ~takes & ~free
    before = np.zeros(n + 1, np.int64)
    rests = np.zeros((m, n + 1), bool)  # the table adds nothing at this page
    for t in range(m):
        sums = np.concatenate([[0], np.cumsum(np.where(takes[:, t], gain[:, t], 0))])
        after = np.empty_like(before)
        cuts = np.concatenate([[0], np.flatnonzero(closed[:, t]) + 1, [n + 1]])
        for a, b in zip(cuts[:-1], cuts[1:]):
            after[a:b] = sums[a:b] + np.maximum.accumulate(before[a:b] - sums[a:b])
        rests[t] = after == before
        before = after
    out = np.full(n, -1)
    page = n
    for t in range(m - 1, -1, -1):
        while page and not rests[t, page]:
            if takes[page - 1, t]:
                out[page - 1] = t
            page -= 1
    return out


def assign_pages(scores: DataFrame, group: list[str], anchors: DataFrame | None = None) -> DataFrame:
    """group, page, table: assign() for each group; scores: group, page, table, score; anchors: group, page, table.

    A group is one document: its pages times its tables. Pages without score or anchor for any table stay unassigned."""
    ship(scores.sparkSession)
    kinds = dict(scores.dtypes)
    marked = scores.select(*group, "page", "table", "score", F.lit(False).alias("anchor"))
    if anchors is not None:
        marked = marked.unionByName(anchors.select(*group, "page", "table", F.lit(0).cast(kinds["score"]).alias("score"), F.lit(True).alias("anchor")))

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pages, tables = sorted(pdf["page"].unique()), sorted(pdf["table"].unique())
        at_p, at_t = {p: i for i, p in enumerate(pages)}, {t: i for i, t in enumerate(tables)}
        grid = np.zeros((len(pages), len(tables)), np.int64)
        fixed = np.full(len(pages), -1)
        for p, t, s, a in zip(pdf["page"], pdf["table"], pdf["score"], pdf["anchor"]):
            if a:
                fixed[at_p[p]] = at_t[t]
            else:
                grid[at_p[p], at_t[t]] += int(s)
        got = [(*key, p, tables[i]) for p, i in zip(pages, assign(grid, fixed).tolist()) if i >= 0]
        return pd.DataFrame(got, columns=[*group, "page", "table"])

    schema = ", ".join(f"{c} {kinds[c]}" for c in [*group, "page", "table"])
    return marked.groupBy(*group).applyInPandas(run, schema)


def orphan_pages(scores: DataFrame, group: list[str], rows: DataFrame, rate: float = 0.5) -> DataFrame:
    """group, page: pages with rows of which no table explains the rate. rows: group, page, n."""
    best = scores.groupBy(*group, "page").agg(F.max("score").alias("_s"))
    return rows.where("n > 0").join(best, [*group, "page"], "left").where(F.coalesce("_s", F.lit(0)) < rate * F.col("n")).select(*group, "page")
