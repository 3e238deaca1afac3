"""Folding long texts into overlapping chunks.

A chunk's start and end count characters of the folded text, not of the source. A record
never spans rows, so the fold runs inside Arrow batches without a shuffle.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame

SIZE, OVERLAP = 3000, 300
_SENTENCE = re.compile(r"(?<=[。！？.!?])\s*")


def _sentences(paragraph: str) -> list[str]:
    return [s for s in map(str.strip, _SENTENCE.split(paragraph)) if s]


def _cut_paragraph(paragraph: str, start: int, size: int, overlap: int):
    """Chunks of one over-long paragraph. A sentence is never cut; each chunk begins with the end of the one before."""
    held = ""
    for sentence in _sentences(paragraph):
        if held and len(held) + len(sentence) > size:
            yield held, start
            start += len(held) - overlap  # negative after a chunk shorter than the overlap
            held = held[-overlap:] + sentence
        else:
            held += sentence
    if held:
        yield held, start


def _tail(group: list[str], overlap: int) -> list[str]:
    """The last paragraphs of a chunk that the next one repeats: at least one, others while they fit with their separator."""
    kept, used = [group[-1]], len(group[-1]) + 2
    for p in reversed(group[:-1]):
        if used + len(p) > overlap:
            break
        kept.insert(0, p)
        used += len(p) + 2
    return kept


def fold(text: str | None, size: int = SIZE, overlap: int = OVERLAP) -> list[tuple[str, int, int]]:
    """(chunk, start, end) in order."""
    if overlap < 1:
        raise ValueError("the overlap must be at least 1")
    out: list[tuple[str, int, int]] = []
    group: list[str] = []
    used = at = 0

    def flush() -> int:
        chunk = "\n\n".join(group)
        out.append((chunk, at, at + len(chunk)))
        return len(chunk)

    for p in filter(None, map(str.strip, (text or "").split("\n\n"))):
        if len(p) > size:
            if group:
                at += flush() - overlap
                group, used = [], 0
            for part, start in _cut_paragraph(p, at, size, overlap):
                out.append((part, start, start + len(part)))
            at = out[-1][2] - overlap
        elif group and used + len(p) > size:
            at += max(0, flush() - overlap)
            group = _tail(group, overlap)
            used = sum(len(x) + 2 for x in group) + len(p)
            group.append(p)
        else:
            group.append(p)
            used += len(p) + 2
    if group:
        flush()
    return out


def chunks(records: DataFrame, size: int = SIZE, overlap: int = OVERLAP) -> DataFrame:
    """record_id, chunk_index, char_start, char_end, chunk_text of records (record_id, text), indexes from 0."""
    kind = dict(records.dtypes)["record_id"]

    def run(batches):
        for b in batches:
            rows = [(i, n, s, e, c) for i, text in enumerate(b.column(1).to_pylist()) for n, (c, s, e) in enumerate(fold(text, size, overlap))]
            which, *rest = list(zip(*rows, strict=True)) or [()] * 5
            types = (pa.int32(), pa.int32(), pa.int32(), pa.string())
            arrays = [b.column(0).take(pa.array(which, pa.int64())), *[pa.array(x, t) for x, t in zip(rest, types, strict=True)]]
            yield pa.RecordBatch.from_arrays(arrays, names=["record_id", "chunk_index", "char_start", "char_end", "chunk_text"])

    schema = f"record_id {kind}, chunk_index int, char_start int, char_end int, chunk_text string"
    return records.select("record_id", "text").mapInArrow(run, schema)
