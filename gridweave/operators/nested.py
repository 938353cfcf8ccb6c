"""Deeply nested records to flat child tables: a tree automaton classifies shapes, each shape is routed to a typed subtype table."""

from __future__ import annotations

import hashlib
import json
import re
import sys
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from json.decoder import scanstring

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridweave.session import map_arrow, work_dir


@dataclass(frozen=True)
class Child:
    """Where a child table's rows stand: each element of `parents` (a list of the root) holds `field`, whose elements hold
    `value`; value None takes the element itself."""

    name: str
    parents: str
    field: str
    value: str | None


#: States of the leaves. INT covers every number without fraction that fits 18 digits, BIG the longer ones; INT_TEXT is a string that
#: reads as an INT does, character for character; JSON_LIST and JSON_OBJECT are strings that hold one.
NULL, BOOL, INT, BIG, REAL, INT_TEXT, TEXT, JSON_LIST, JSON_OBJECT = "null", "bool", "int", "big", "real", "int_text", "text", "json_list", "json_object"
#: The subtype table of each leaf state, and the type of its value; containers go to "json". Null and absent values have none.
SUBTYPES = {INT: "int", INT_TEXT: "int", BIG: "number", REAL: "number", BOOL: "flag", TEXT: "text", JSON_LIST: "text", JSON_OBJECT: "text"}
TYPES = {"int": "bigint", "number": "string", "flag": "boolean", "text": "string", "json": "string"}
#: Names of shapes longer than this stand as a hash, so that names of deep values do not grow with the square of their depth.
LONG_NAME = 4000
#: Digits to which a number with an exponent is written out; one beyond stays as it is written.
MOST_DIGITS = 100_000

KEYS = ["record_id", "child_name", "parent_pos", "child_pos"]
SCHEMA = "record_id long, child_name string, parent_pos int, child_pos int, variant string, subtype string, int_value long, text_value string"
_ARROW = pa.schema([
    ("record_id", pa.int64()), ("child_name", pa.string()), ("parent_pos", pa.int32()), ("child_pos", pa.int32()),
    ("variant", pa.string()), ("subtype", pa.string()), ("int_value", pa.int64()), ("text_value", pa.string()),
])


class Number(str):
    """A JSON number in its own digits: one with a fraction or an exponent, or too long for 64 bits."""


def _integer(text: str) -> int | Number:
    return int(text) if len(text) <= 18 else Number(text)


def _strict(name: str) -> None:
    raise ValueError(f"{name} is not JSON")


_decoder = json.JSONDecoder(parse_float=Number, parse_int=_integer, parse_constant=_strict)
_BLANK = re.compile(r"[ \t\n\r]*")
_NUMBER = re.compile(r"(-?(?:0|[1-9]\d*))(\.\d+)?([eE][-+]?\d+)?", re.ASCII)
_WORDS = {"null": None, "true": True, "false": False}


def _parse_deep(text: str) -> object:
    """The value of a JSON document of any depth: what the decoder does, with the open containers on a list."""
    at = _BLANK.match(text, 0).end()
    open_: list[tuple[dict | list, str | None]] = []  # containers, and the key that an object waits for
    while True:
        sign = text[at : at + 1]
        if sign in ("[", "{"):
            value: object = [] if sign == "[" else {}
            at = _BLANK.match(text, at + 1).end()
            if text[at : at + 1] != ("]" if sign == "[" else "}"):
                key = None
                if sign == "{":
                    key, at = _key(text, at)
                open_.append((value, key))
                continue
            at += 1
        elif sign == '"':
            value, at = scanstring(text, at + 1, True)
        elif m := _NUMBER.match(text, at):
            value, at = (Number(m[0]) if m[2] or m[3] else _integer(m[0])), m.end()
        else:
            word = next((w for w in _WORDS if text.startswith(w, at)), None)
            if word is None:
                raise ValueError(f"no JSON at {at}")
            value, at = _WORDS[word], at + len(word)
        while True:  # the value is whole: into its container, and out of all containers that end here
            at = _BLANK.match(text, at).end()
            if not open_:
                if at != len(text):
                    raise ValueError(f"more text at {at}")
                return value
            holder, key = open_.pop()
            if isinstance(holder, list):
                holder.append(value)
            else:
                holder[key] = value
            after = text[at : at + 1]
            if after == ",":
                at, key = _BLANK.match(text, at + 1).end(), None
                if isinstance(holder, dict):
                    key, at = _key(text, at)
                open_.append((holder, key))
                break
            if after != ("]" if isinstance(holder, list) else "}"):
                raise ValueError(f"open container at {at}")
            value, at = holder, at + 1


def _key(text: str, at: int) -> tuple[str, int]:
    """The key of an object at a place, and where its value begins."""
    if text[at : at + 1] != '"':
        raise ValueError(f"no key at {at}")
    key, at = scanstring(text, at + 1, True)
    at = _BLANK.match(text, at).end()
    if text[at : at + 1] != ":":
        raise ValueError(f"no colon at {at}")
    return key, _BLANK.match(text, at + 1).end()


def parse(text: str | None) -> tuple[bool, object]:
    """(True, value) of a text that is one complete JSON document, however deep and with numbers of any length, else (False, None)."""
    if text is None:
        return False, None
    try:
        return True, _decoder.decode(text)
    except RecursionError:
        pass
    except ValueError:
        return False, None
    try:
        return True, _parse_deep(text)
    except ValueError:
        return False, None


def _digits(number: str) -> tuple[str, str, int]:
    """Sign, digits without leading zeros, and the power of ten that the last digit counts, of a number's text."""
    whole, fraction, exponent = _NUMBER.fullmatch(number).groups()
    sign = "-" if whole[0] == "-" else ""
    digits = (whole.lstrip("-") + (fraction or ".")[1:]).lstrip("0")
    power = int((exponent or "e0")[1:]) - len((fraction or ".")[1:])
    short = digits.rstrip("0")
    return (sign if short else ""), short, (power + len(digits) - len(short) if short else 0)


def plain_number(number: str) -> str:
    """A number as plain decimal text, without exponent, a sign at zero or zeros that say nothing; as written beyond MOST_DIGITS."""
    sign, digits, power = _digits(number)
    if abs(power) > MOST_DIGITS:
        return str(number)
    if power >= 0:
        return sign + (digits or "0") + "0" * power
    digits = digits.rjust(1 - power, "0")
    return f"{sign}{digits[:power]}.{digits[power:]}"


def plain(value: object) -> str:
    """A value as text: numbers as plain decimals, strings as they are, containers as compact JSON."""
    if isinstance(value, Number):
        return plain_number(value)
    if isinstance(value, str):
        return value
    if isinstance(value, bool) or value is None:
        return json.dumps(value)
    if isinstance(value, int):
        return str(value)
    out: list[str] = []
    stack: list[tuple[bool, object]] = [(False, value)]
    while stack:
        ready, x = stack.pop()
        if ready:
            out.append(x)  # type: ignore[arg-type]
        elif isinstance(x, (dict, list)):
            parts: list[tuple[bool, object]] = [(True, "{" if isinstance(x, dict) else "[")]
            for i, y in enumerate(x):
                sign = "," if i else ""
                if isinstance(x, dict):
                    parts += [(True, f"{sign}{json.dumps(y, ensure_ascii=False)}:"), (False, x[y])]
                else:
                    parts += [(True, sign), (False, y)]
            stack.extend(reversed([*parts, (True, "}" if isinstance(x, dict) else "]")]))
        elif isinstance(x, Number) or not isinstance(x, str):
            out.append(plain(x))
        else:
            out.append(json.dumps(x, ensure_ascii=False))
    return "".join(out)


@dataclass(frozen=True)
class Route:
    """Where the elements of a shape go: the subtype table, and how their value is reached: whether the element is JSON text that has to
    be decoded, and the field that holds the value, None for the element itself."""

    subtype: str
    decode: bool
    field: str | None


class ShapeAutomaton:
    """Bottom-up tree automaton over JSON values. A leaf's state is its kind; an object's the set of its (key, state); a
    list's the set of its elements' states. States are interned, so equal shapes have one name wherever they stand; the route of a
    shape is worked out once, from its state alone."""

    def __init__(self) -> None:
        self.rules: dict[object, str] = {}
        self.fields: dict[str, dict[str, str]] = {}  # of each object's state the states by key
        self.routes: dict[tuple[Child, str, str | None], Route | None] = {}

    def leaf(self, v: object) -> str:
        if v is None:
            return NULL
        if isinstance(v, bool):
            return BOOL
        if isinstance(v, Number):
            sign, digits, power = _digits(v)
            return REAL if power < 0 else INT if len(digits) + power <= 18 else BIG
        if isinstance(v, int):
            return INT
        head = v.lstrip(" \t\n\r")[:1]
        if head in ("[", "{"):
            ok, inner = parse(v)
            return JSON_LIST if ok and isinstance(inner, list) else JSON_OBJECT if ok and isinstance(inner, dict) else TEXT
        t = v[1:] if head == "-" else v
        return INT_TEXT if 0 < len(t) <= 18 and t.isascii() and t.isdigit() and (t[0] != "0" or v == "0") else TEXT

    def state(self, v: object) -> str:
        """The state of a value, worked out without recursion: a container stands on the stack until its parts have theirs."""
        done: list[str] = []
        stack: list[tuple[object, bool]] = [(v, False)]
        while stack:
            x, opened = stack.pop()
            if not isinstance(x, (dict, list)):
                done.append(self.leaf(x))
            elif not opened:
                stack.append((x, True))
                stack.extend((y, False) for y in (x.values() if isinstance(x, dict) else x))
            else:
                parts = done[len(done) - len(x) :]
                del done[len(done) - len(x) :]
                parts.reverse()
                done.append(self._name(("obj", frozenset(zip(x, parts))) if isinstance(x, dict) else ("list", frozenset(parts))))
        return done[0]

    def _name(self, key: tuple[str, frozenset]) -> str:
        found = self.rules.get(key)
        if found is None:
            kind, parts = key
            inside = ",".join(sorted(f"{p[0]}:{p[1]}" if kind == "obj" else p for p in parts))
            if len(inside) > LONG_NAME:
                inside = f"deep:{hashlib.sha256(inside.encode(errors='surrogatepass')).hexdigest()[:32]}"
            found = self.rules[key] = "{" + inside + "}" if kind == "obj" else "[" + inside + "]"
            if kind == "obj":
                self.fields[found] = dict(parts)
        return found

    def elements(self, v: object) -> list:
        """The elements of a collection by its state: a list as it is; a JSON text of a list or object decoded; any other
        value is its own only element; null and absent have none."""
        if v is None:
            return []
        if isinstance(v, list):
            return v
        if isinstance(v, str) and not isinstance(v, Number) and (kind := self.leaf(v)) in (JSON_LIST, JSON_OBJECT):
            inner = parse(v)[1]
            return inner if kind == JSON_LIST else [inner]  # type: ignore[return-value, list-item]
        return [v]

    def route(self, child: Child, state: str, inner: str | None) -> Route | None:
        """The route of the elements of a shape; None if they hold no value. inner: the state of what a JSON_OBJECT's text holds."""
        key = (child, state, inner)
        if key not in self.routes:
            at, decode = state, False
            if child.value is not None and state == JSON_OBJECT:
                at, decode = inner, True
            if child.value is not None:
                at = self.fields.get(at, {}).get(child.value, NULL)
            self.routes[key] = None if at == NULL else Route(SUBTYPES.get(at, "json"), decode, child.value)
        return self.routes[key]


#: How each subtype table takes a value: (int_value, text_value).
_TAKE: dict[str, Callable[[object], tuple[int | None, str | None]]] = {
    "int": lambda v: (int(plain(v)), None),
    **dict.fromkeys(("number", "flag", "text", "json"), lambda v: (None, plain(v))),
}


def unnest(record_id: int, root: object, children: list[Child], automaton: ShapeAutomaton) -> Iterator[tuple]:
    """Child rows of one record, in the order of SCHEMA."""
    if not isinstance(root, dict):
        return
    for child in children:
        for at, parent in enumerate(automaton.elements(root.get(child.parents)), 1):
            if isinstance(parent, str) and not isinstance(parent, Number) and automaton.leaf(parent) == JSON_OBJECT:
                parent = parse(parent)[1]
            if not isinstance(parent, dict):
                continue
            for pos, element in enumerate(automaton.elements(parent.get(child.field)), 1):
                state, inner = automaton.state(element), None
                if state == JSON_OBJECT and child.value is not None:
                    element = parse(element)[1]  # type: ignore[arg-type]
                    inner = automaton.state(element)
                route = automaton.route(child, state, inner)
                if route is None:
                    continue
                value = element if route.field is None else element[route.field]  # type: ignore[index]
                yield (record_id, child.name, at, pos, f"{child.name}/{inner or state}", route.subtype, *_TAKE[route.subtype](value))


def flatten(records: DataFrame, record_id: str, payload: str, children: list[Child]) -> DataFrame:
    """Child rows of all records: the supertype's keys (record_id, child_name, parent_pos, child_pos), the variant (the shape
    that the automaton gave the element), its subtype, and the value in the column of the subtype.

    No shuffle: every record counts by itself. Elements with a null or absent value give no row, but keep their position.
    Defined cases: null, broken and incomplete payloads, and payloads followed by more text, give no rows; depth and length of
    numbers have no limit (an exponent that would write out more than MOST_DIGITS zeros stays as written); of a repeated key in an
    object the last counts; a list may come as a list, as the JSON text of one, or as its only element alone; records delivered twice
    give rows twice; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sys.set_int_max_str_digits(0)
        automaton = ShapeAutomaton()
        for batch in batches:
            rows: list[tuple] = []
            for rid, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ok, root = parse(text.as_py())
                if ok:
                    rows.extend(unnest(rid, root, children, automaton))
            cols = list(zip(*rows)) if rows else [()] * len(_ARROW)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, _ARROW)], schema=_ARROW)
            if len(automaton.rules) > 100_000:
                automaton = ShapeAutomaton()

    return map_arrow(records.select(F.col(record_id).cast("long").alias("record_id"), F.col(payload).alias("payload")), run, SCHEMA)


@dataclass(frozen=True)
class Variants:
    """The typed subtype tables of a flattened table, one folder for each child and subtype below `path`."""

    spark: SparkSession
    path: str

    def _all(self) -> DataFrame:
        return self.spark.read.schema(SCHEMA).parquet(self.path)

    def table(self, child: str, subtype: str) -> DataFrame:
        """One subtype table: the supertype's keys, the variant, and the value in the subtype's type. Reads its own folder only."""
        value = F.col("int_value" if subtype == "int" else "text_value").cast(TYPES[subtype])
        return self._all().where((F.col("child_name") == child) & (F.col("subtype") == subtype)).select(*KEYS, "variant", value.alias("value"))

    def supertype(self) -> DataFrame:
        """What all subtype tables have in common: the keys, with the value of each as text."""
        return self._all().select(*KEYS, "variant", "subtype", value_text().alias("value"))


def route_variants(records: DataFrame, record_id: str, payload: str, children: list[Child], path: str | None = None) -> Variants:
    """flatten() with every row written, in one pass, to the subtype table that its shape is routed to."""
    spark = records.sparkSession
    path = path or f"{work_dir(spark)}/variants-{uuid.uuid4().hex}"
    flatten(records, record_id, payload, children).write.partitionBy("child_name", "subtype").parquet(path)
    return Variants(spark, path)


def value_text() -> Column:
    """The value of a row of flatten() as text, whatever its subtype."""
    return F.coalesce(F.col("int_value").cast("string"), F.col("text_value"))


def variants(flat: DataFrame, by: list[str]) -> DataFrame:
    """Number of rows and records of each group, as of each child's variant or subtype."""
    return flat.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("record_id").alias("n_records"))
