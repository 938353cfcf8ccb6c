"""Several values packed in one field: the dialect of each field by minimum description length, then one row a value."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridweave.functions.markers import QUOTES, unquoted, value_pattern
from gridweave.operators.skew import hot_keys, lookup_join
from gridweave.session import materialise

#: The delimiters that a dialect may have, by name. "any" takes every character outside the alphabet.
DELIMITERS = {
    "comma": ",", "semicolon": ";", "bar": "|", "slash": "/", "ampersand": "&", "plus": "+", "newline": "\n",
    "tab": "\t", "blank": " ", "wide_comma": "，", "list_comma": "、", "dot": "·",
}
QUOTE_SIGNS = {"double": '"', "single": "'", "typographic": "“"}
#: Fixed values, in bits: a character that is spelled out, a separating character under a named delimiter and under "any", and
#: what it takes to say that a dialect has a quoting style, or every delimiter and all styles.
SPELLED, NAMED_SEPARATOR, ANY_SEPARATOR, STYLE, EVERYTHING = 8.0, 1.0, 6.0, 1.0, 7.0
#: Values whose codes (a hash and a number each) are broadcast at most.
CODES = 200_000


def _values(field: Column, chars: str, quote: str) -> Column:
    kinds = {"none": (), "all": tuple(QUOTES)}.get(quote, (quote,))
    found = F.regexp_extract_all(field, F.lit(value_pattern(chars, kinds)), F.lit(0))
    return F.filter(F.transform(found, unquoted), lambda v: v != "")


def _rest(field: Column, chars: str, quote: str) -> Column:
    kinds = {"none": (), "all": tuple(QUOTES)}.get(quote, (quote,))
    return F.regexp_replace(field, value_pattern(chars, kinds), "")


def candidates(fields: DataFrame, chars: str) -> DataFrame:
    """The dialects that can describe each distinct field: fid, n, dialect, values, seps.

    A dialect is a delimiter and a quoting style. It can describe a field if what its values leave over consists of its
    delimiter and blanks only; a character outside the alphabet would otherwise have to stand unquoted in a value, for
    which the code has no word (its length is infinite). "any" with all styles can describe every field.
    """
    quotes = ["none", *QUOTES]
    cols = {f"_v_{q}": _values(F.col("field"), chars, q) for q in [*quotes, "all"]}
    cols |= {f"_r_{q}": _rest(F.col("field"), chars, q) for q in [*quotes, "all"]}
    wide = fields.withColumns(cols)
    signs = F.array(*[F.struct(F.lit(k).alias("name"), F.lit(d).alias("sign")) for k, d in DELIMITERS.items()])
    options = []
    for q in quotes:
        rest, values = F.col(f"_r_{q}"), F.col(f"_v_{q}")
        uses = F.lit(True) if q == "none" else F.col("field").contains(QUOTE_SIGNS[q])
        seps = (F.length(rest) * NAMED_SEPARATOR + (0.0 if q == "none" else STYLE)).cast("double")
        fits = F.filter(signs, lambda d: rest.contains(d["sign"]) & (F.call_function("translate", rest, F.concat(d["sign"], F.lit(" \t")), F.lit("")) == ""))
        named = F.transform(fits, lambda d: F.struct(F.concat(d["name"], F.lit(f"/{q}")).alias("dialect"), values.alias("values"), seps.alias("seps")))
        alone = F.array(F.struct(F.lit(f"whole/{q}").alias("dialect"), values.alias("values"), seps.alias("seps")))
        options += [F.when(uses, named), F.when(uses & (F.trim(rest) == "") & (F.size(values) == 1), alone)]
    free = F.struct(F.lit("any/all").alias("dialect"), F.col("_v_all").alias("values"), (F.length("_r_all") * ANY_SEPARATOR + EVERYTHING).cast("double").alias("seps"))
    found = F.flatten(F.filter(F.array(*options, F.array(free)), lambda o: o.isNotNull()))
    each = wide.select("fid", "n", found.alias("_o"))
    return each.select("fid", "n", F.size("_o").alias("ways"), F.explode("_o").alias("_o")).select("fid", "n", "ways", "_o.*")


def choose_dialects(fields: DataFrame, chars: str) -> DataFrame:
    """fid and the dialect of least description length, of distinct fields (fid, field, n).

    Length: the dialect's code, by how often each dialect can describe a field; each value's code, by how often the value
    occurs in all candidate parses of all fields, or spelled out where that is shorter; the separating characters; and the
    generality of the dialect. Ties go to the dialect first by name.

    One shuffle counts the values, one brings the candidates of a field together. The codes of up to CODES values are broadcast,
    counted before; more are joined by a shuffle in which no hot value meets one task.
    """
    cand = materialise(candidates(fields, chars), "dialects")
    share = F.col("n") / F.col("ways")
    uses = cand.groupBy("dialect").agg(F.sum(share).alias("w"))
    known = {r["dialect"]: r["w"] for r in uses.collect()}  # at most delimiters x styles entries
    total = sum(known.values()) + len(known)
    each = cand.select("fid", "n", "ways", "dialect", "seps", F.explode_outer("values").alias("v")).withColumn("vid", F.when(F.col("v").isNotNull(), F.unhex(F.sha2("v", 256))))
    weights = each.where("vid is not null").groupBy("vid").agg(F.sum(share).alias("w"), F.max(F.length("v")).alias("len"))
    weights = materialise(weights, "values")
    told = weights.agg(F.sum("w").alias("w"), F.count(F.lit(1)).alias("n")).first()
    mass = F.lit(float(told["w"] or 1.0))
    codes = weights.select("vid", (1 + F.least(F.log2(mass / F.col("w")), SPELLED * (F.col("len") + 1))).alias("bits"))
    slim = each.select("fid", "dialect", "seps", "vid")
    if told["n"] <= CODES:
        coded = slim.join(F.broadcast(codes), "vid", "left")
    else:
        coded = lookup_join(slim, codes, "vid", hot_keys(weights, "vid", weight="w"), "left")
    names = F.create_map(*[x for k, w in sorted(known.items()) for x in (F.lit(k), F.lit(w))]) if known else F.create_map(F.lit(""), F.lit(1.0))
    spent = coded.repartition("fid").groupBy("fid", "dialect").agg(F.coalesce(F.sum("bits"), F.lit(0.0)).alias("bits"), F.first("seps").alias("seps"))
    length = (F.col("bits") + F.col("seps") + F.log2(F.lit(total) / (names[F.col("dialect")] + 1))).alias("length")
    return spent.groupBy("fid").agg(F.min(F.struct(length, F.col("dialect"))).alias("s")).select("fid", F.col("s.dialect").alias("dialect"), F.col("s.length").alias("length"))


def split_packed(rows: DataFrame, ids: list[str], field: str, chars: str, least: int = 2) -> DataFrame:
    """One row a value of each field that holds `least` or more: ids, item_pos (from 1), item_value, dialect.

    rows are read once and kept with the SHA-256 of their field; the distinct fields (counted with partial counts) get their dialects
    from choose_dialects, by which every field is parsed. The dialects of hot fields are broadcast (at most 1 / HOT_SHARE rows of
    fixed width), the others joined by a shuffle.

    Defined cases: null, empty and blank fields, and fields without any value, give no rows; an empty quoted value is no
    value; repeats keep their places; a field of any length is read whole; repeated rows give repeated results; other
    columns are ignored.
    """
    base = rows.select(*[F.col(c).alias(f"_id{i}") for i, c in enumerate(ids)], F.col(field).cast("string").alias("field"))
    base = materialise(base.where("field is not null and trim(field) <> ''").withColumn("fid", F.unhex(F.sha2("field", 256))), "fields")
    fields = materialise(base.groupBy("fid").agg(F.first("field").alias("field"), F.count(F.lit(1)).alias("n")), "distinct")
    chosen = choose_dialects(fields, chars).select("fid", "dialect")
    known = lookup_join(base, chosen, "fid", hot_keys(fields, "fid", weight="n"))
    style = F.element_at(F.split("dialect", "/"), -1)
    parsed = F.when(style == "all", _values(F.col("field"), chars, "all"))
    for q in QUOTES:
        parsed = parsed.when(style == q, _values(F.col("field"), chars, q))
    values = parsed.otherwise(_values(F.col("field"), chars, "none"))
    out = known.select(*[f"_id{i}" for i in range(len(ids))], "dialect", values.alias("_v")).where(F.size("_v") >= least)
    out = out.select("*", F.posexplode("_v").alias("_p", "item_value"))
    return out.select(
        *[F.col(f"_id{i}").alias(c) for i, c in enumerate(ids)], (F.col("_p") + 1).alias("item_pos"), "item_value", "dialect"
    )
