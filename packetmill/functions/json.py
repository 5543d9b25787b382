"""Canonical JSON and what is derived from it; vectorized helpers where built-in JSON functions print numbers or order keys differently."""

from __future__ import annotations

import json
import math
from decimal import Decimal

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _number(x: float) -> str:
    """A double as ECMAScript prints it."""
    if not math.isfinite(x):
        raise ValueError("not a JSON number")
    if x == 0:
        return "0"
    sign, digits, exponent = Decimal(repr(x)).normalize().as_tuple()
    text, point = "".join(map(str, digits)), len(digits) + exponent
    if 0 < point <= 21:
        body = text.ljust(point, "0") if len(text) <= point else f"{text[:point]}.{text[point:]}"
    elif -6 < point <= 0:
        body = "0." + "0" * -point + text
    else:
        power = point - 1
        body = text[0] + (f".{text[1:]}" if len(text) > 1 else "") + f"e{'+' if power > 0 else '-'}{abs(power)}"
    return "-" * sign + body


def _key(name: str) -> tuple:
    """Integer-like keys first, by value; the others by UTF-16 code unit."""
    if name.isascii() and name.isdigit() and (name == "0" or name[0] != "0") and int(name) < 2**32 - 1:
        return 0, int(name), b""
    return 1, 0, name.encode("utf-16-be", "surrogatepass")


def _write(x: object) -> str:
    if isinstance(x, dict):
        return "{" + ",".join(f"{_string(k)}:{_write(x[k])}" for k in sorted(x, key=_key)) + "}"
    if isinstance(x, list):
        return "[" + ",".join(map(_write, x)) + "]"
    if isinstance(x, str):
        return _string(x)
    if x is None or isinstance(x, bool):
        return {None: "null", True: "true", False: "false"}[x]
    return _number(float(x))


def _string(x: str) -> str:
    text = json.dumps(x, ensure_ascii=False)
    return "".join(f"\\u{ord(c):04x}" if 0xD800 <= ord(c) <= 0xDFFF else c for c in text)


def _refuse(name: str) -> float:
    raise ValueError(name)


def canonical_text(text: str | None) -> str | None:
    """Canonical form of a JSON text; None for null and for what is not JSON (NaN and infinities included)."""
    if text is None:
        return None
    try:
        return _write(json.loads(text, parse_int=float, parse_constant=_refuse))
    except (ValueError, RecursionError, OverflowError):
        return None


@F.pandas_udf(T.StringType())
def _canonical(column: pd.Series) -> pd.Series:
    return column.map(canonical_text, na_action="ignore")


@F.pandas_udf(T.ArrayType(T.StringType()))
def _evidence_ids(column: pd.Series) -> pd.Series:
    return column.map(evidence_ids_of)


@F.pandas_udf(T.BooleanType())
def _raw_transcript(column: pd.Series) -> pd.Series:
    return column.map(holds_transcript)


def _parsed(text: str | None) -> object:
    try:
        return json.loads(text) if text is not None else None
    except (ValueError, RecursionError):
        return None


def evidence_ids_of(text: str | None) -> list[str]:
    """Every string under ``evidence_ids`` or ``evidence_id`` at any depth, once each, in document order; what these two hold is not entered."""
    found: dict[str, None] = {}
    todo = [_parsed(text)]
    while todo:
        x = todo.pop()
        if isinstance(x, dict):
            for name, value in x.items():
                if name == "evidence_ids" and isinstance(value, list):
                    found.update((v, None) for v in value if isinstance(v, str))
                elif name == "evidence_id" and isinstance(value, str):
                    found[value] = None
            todo += reversed([v for k, v in x.items() if k not in ("evidence_ids", "evidence_id")])
        elif isinstance(x, list):
            todo += reversed(x)
    return list(found)


def holds_transcript(text: str | None) -> bool:
    """Whether any member ``transcript_text``, at any depth, is a string."""
    todo = [_parsed(text)]
    while todo:
        x = todo.pop()
        if isinstance(x, dict):
            if isinstance(x.get("transcript_text"), str):
                return True
            todo += x.values()
        elif isinstance(x, list):
            todo += x
    return False


#: A string of a JSON text, without backtracking; white space between tokens; a key like an integer; what may print otherwise
#: outside strings: exponents, very small numbers and more digits than a double surely keeps.
_STRING = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'
_ZEROS = r"(\.[0-9]*[1-9])0+(?![0-9])|\.0+(?![0-9])"
_BLANK, _INTEGER_KEY, _UNSURE = r"[ \t\n\r]+", r'"[0-9]+":', r"[0-9.]{16,}|[0-9][eE]|0\.00000"


def written_as_parsed(text: Column) -> tuple[Column, Column]:
    """(guard, text): where the guard holds, the text that Spark writes of the parsed column is the canonical one.

    Spark keeps the members of a parsed object in key order, by UTF-16 code unit. The guard leaves out what it writes or reads
    otherwise: keys like integers, numbers that a double or ECMAScript prints in another way, escapes by code, characters beyond
    the private area of the first plane, repeated keys, and texts of which not every character but blanks was taken over: but for zeros
    at the end of fractions nothing that is left prints longer or shorter than it was, so equal lengths leave no room for a loss.
    """
    out = F.to_json(F.try_parse_json(text))
    bare = F.regexp_replace(text, f"({_STRING})|{_BLANK}", "$1")
    outside, written = F.regexp_replace(bare, _STRING, '""'), F.regexp_replace(out, _STRING, '""')
    whole = (F.length(bare) - F.length(outside) == F.length(out) - F.length(written)) & (F.length(F.regexp_replace(outside, _ZEROS, "$1")) == F.length(written))
    guard = whole & ~text.contains("\\u") & ~out.contains("\\u") & ~out.rlike(_INTEGER_KEY) & ~text.rlike("[\\x{E000}-\\x{10FFFF}]") & ~outside.rlike(_UNSURE)
    return F.coalesce(guard, F.lit(False)), out


def canonical_json(text: Column) -> Column:
    """Canonical text of a JSON column: keys in order at every depth, numbers as ECMAScript prints them; null where it is not JSON.

    Python sees only the texts that ``written_as_parsed`` is not sure of.
    """
    guard, out = written_as_parsed(text)
    return F.when(guard, out).otherwise(_canonical(F.when(~guard, text)))


def hash_canonical_json(text: Column) -> Column:
    """SHA-256 of the canonical text and a line end."""
    return F.sha2(F.concat(canonical_json(text), F.lit("\n")), 256)


def serialize_artifact(text: Column) -> Column:
    """struct(content, sha256, byte_count) as an artifact is stored."""
    content = F.concat(canonical_json(text), F.lit("\n"))
    return F.struct(content.alias("content"), F.sha2(content, 256).alias("sha256"), F.octet_length(content).cast("long").alias("byte_count"))


def contains_raw_transcript(text: Column) -> Column:
    return _raw_transcript(text)


def collect_evidence_ids(text: Column) -> Column:
    """array<string> of evidence ids that a JSON column refers to; empty for null or invalid JSON."""
    return _evidence_ids(text)


def intent_idempotency_key(schema_version: Column, source: Column, grades: Column, operations: Column) -> Column:
    """Key over the four members of a parsed intent; the last three are JSON columns."""
    joined = F.concat(F.lit('{"schema_version":'), F.to_json(F.array(schema_version)).substr(F.lit(2), F.length(F.to_json(F.array(schema_version))) - 2), F.lit(',"source":'), source, F.lit(',"evidence_grades_used":'), grades, F.lit(',"operations":'), operations, F.lit("}"))
    return hash_canonical_json(joined)


#: Escapes that the two writers spell with other letters: control characters whose code has a hexadecimal letter.
_LETTERED = ("0B", "0E", "0F", "1A", "1B", "1C", "1D", "1E", "1F")


def canonical_struct(row: Column) -> Column:
    """Canonical text of a struct whose members stand in key order at every depth and whose numbers are whole, without leaving the JVM."""
    text = F.to_json(row, {"ignoreNullFields": "false"})
    lowered = text
    for code in _LETTERED:
        lowered = F.regexp_replace(lowered, r"(?<!\\)((?:\\\\)*)\\u00" + code, r"$1\\u00" + code.lower())
    return F.when(text.contains("\\u00"), lowered).otherwise(text)


def serialize_struct(row: Column) -> Column:
    """``serialize_artifact`` of a struct as ``canonical_struct`` takes it."""
    content = F.concat(canonical_struct(row), F.lit("\n"))
    return F.struct(content.alias("content"), F.sha2(content, 256).alias("sha256"), F.octet_length(content).cast("long").alias("byte_count"))


def rewrite_idempotency(intent: Column) -> Column:
    """struct(idempotency_key, rewritten): the key that an intent's members give, and whether the intent states another or none.

    intent is a JSON object column; members that are absent count as null. Null where it is not JSON.
    """
    member = lambda name: F.coalesce(F.to_json(F.try_variant_get(F.try_parse_json(intent), "$." + name, "variant")), F.lit("null"))
    version = F.get_json_object(intent, "$.schema_version")
    key = F.when(F.try_parse_json(intent).isNotNull(), intent_idempotency_key(F.coalesce(version, F.lit("")), member("source"), member("evidence_grades_used"), member("operations")))
    return F.struct(key.alias("idempotency_key"), (~F.get_json_object(intent, "$.idempotency_key").eqNullSafe(key)).alias("rewritten"))
