"""Recovering a JSON object from a model's answer.

Candidates are tried in turn: the answer itself, its cleaned form, its repaired form, and
the repaired form without its last 120, 240, 480 or 960 characters, repaired again. The
first that parses to an object wins and is returned without white space between values.
"""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# How many characters are given up, in this order.
GIVEN_UP = (120, 240, 480, 960)

_CONTROL = re.compile(r"[\x00-\x08\x0b\x0c\x0e-\x1f]")
# What is taken for an unfinished end, removed in this order up to three times.
UNFINISHED = [re.compile(p) for p in (r',\s*"[^"]*"\s*:\s*[^,\}\]]*$', r'"[^"]*"\s*:\s*[^,\}\]]*$', r",\s*$")]
ROUNDS = 3
_COMMA = re.compile(r",\s*([}\]])")


def clean(text: str) -> str:
    """Without fences, outside text and trailing commas."""
    text = re.sub(r"(?i)^```(?:json)?\s*|\s*```$", "", text.strip())
    first, last = text.find("{"), text.rfind("}")
    if first >= 0 and last > first:
        text = text[first : last + 1]
    return _COMMA.sub(r"\1", text).strip()


def _scan(text: str) -> tuple[bool, list[str]]:
    """Whether a string is open at the end, and the delimiters still to be closed."""
    quoted = escaped = False
    closers: list[str] = []
    for c in text:
        if quoted:
            if escaped:
                escaped = False
            elif c == "\\":
                escaped = True
            elif c == '"':
                quoted = False
        elif c == '"':
            quoted = True
        elif c in "{[":
            closers.append("}" if c == "{" else "]")
        elif closers and c == closers[-1]:
            closers.pop()
    return quoted, closers


def repair(text: str) -> str:
    """Without control characters and unfinished fields, cut after the last whole value if a string is open, and closed.

    A scalar at the very end counts as unfinished, as it may have been cut.
    """
    text = _CONTROL.sub("", text.strip())
    before = None
    for _ in range(ROUNDS):
        if text == before:
            break
        before = text
        for pattern in UNFINISHED:
            text = pattern.sub("", text)
    if _scan(text)[0] and (whole := max(text.rfind(c) for c in "}],")) > 0:
        text = text[: whole + 1]
    quoted, closers = _scan(text)
    return _COMMA.sub(r"\1", text + '"' * quoted + "".join(reversed(closers))).strip()


def recover(text: str | None) -> str | None:
    """The object as compact JSON, or null."""
    if not text:
        return None
    cleaned = clean(text)
    repaired = repair(cleaned)
    for candidate in [text, cleaned, repaired, *[repair(repaired[:-n]) for n in GIVEN_UP if len(repaired) > n]]:
        try:
            found = json.loads(candidate)
        except ValueError:
            continue
        if isinstance(found, dict):
            return json.dumps(found, ensure_ascii=False, separators=(",", ":"))
    return None


def _recover_all(text: pd.Series) -> pd.Series:
    return pd.Series([recover(x) for x in text], dtype="object")


def recovered(text: Column) -> Column:
    """Well-formed compact objects pass inside the JVM; only the rest goes through the repair kernel."""
    fine = F.try_parse_json(text).isNotNull() & text.rlike(r"\A\{\S*\z")
    return F.when(fine, text).otherwise(F.pandas_udf(_recover_all, "string")(F.when(~fine, text)))
