"""Sum-of-squares packing of tokenised documents into fixed-length sequences.

Documents are tokenised where they are read, cut only beyond the capacity, and only
(doc_id, piece, length) rows are shuffled. Pieces are dealt by a hash of their place in
the staged table, whatever their ids, into groups of about GROUP_PIECES, and each group is packed by itself, so a task holds one bounded
group and the number of groups follows the input. A group loses a few open bins at
most, against thousands that it fills.

Within a group the pieces come in falling length. N(g) counts open bins with residual
gap g. A piece of length s goes into the gap g >= s for which the sum of N(g)**2 after
the move is least, ties to the smallest gap; a new bin is opened only if none fits.
"""

from __future__ import annotations

import json
import os
import re
import string
import zlib
from array import array

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CAPACITY = 2048
#: Expected pieces of a group; 2.5 MB of rows.
GROUP_PIECES = 16_384
SEPARATOR_ID = 0
PIECES_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED_SCHEMA = PIECES_SCHEMA + ", sequence_id long, offset long"
#: Units kept per worker, about 200 bytes each.
CACHE_UNITS = 600_000
#: Bytes of text cut and encoded at a time; a longer text is a block of its own.
BLOCK_BYTES = 4_000_000
#: Units that the splitter leaves whole: lower-case letters (to U+00FF) or marks without an apostrophe.
SIMPLE = re.compile(rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+|[!-&(-/:-@\[-`{-~]+")

_BLANKS = b" \t\n\x0b\x0c\r"
#: Bytes as blanks 0, letters 1, marks 2 and others 4: two that stand together are parted if the exclusive or is 1 to 4.
_KIND = bytes(0 if x in _BLANKS else 1 if 97 <= x <= 122 else 2 if chr(x) in string.punctuation.replace("'", "") else 4 for x in range(256))
#: Second bytes of the letters of U+00DF to U+00FF, whose first byte is 195.
_TAIL = np.isin(np.arange(256), [x for x in range(0x9F, 0xC0) if x != 0xB7])

_tokenizers: dict[str, WordTokenizer] = {}


def _text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a column of strings (null: empty), and where each text begins, the end last."""
    texts = texts.fill_null("") if texts.null_count else texts
    _, at, data = texts.buffers()
    if not len(texts) or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    at = np.frombuffer(at, kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def _units(text: bytes, at: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The units of lower-cased texts that begin ``at``, and how many of them stand before each text and in all.

    A unit is a word, cut between a letter and a mark that is no apostrophe. There the
    splitter parts them whatever stands around, and nothing composes across.
    """
    raw = np.frombuffer(text, np.uint8)
    kind = np.frombuffer(bytearray(text.translate(_KIND)), np.uint8)
    tails = np.flatnonzero(raw[:-1] == 0xC3) + 1
    tails = tails[_TAIL[raw[tails]]]
    kind[tails - 1] = kind[tails] = 1
    edge = np.ones(len(raw) + 1, bool)  # a unit may begin here, or one ends just before
    edge[1:-1] = (kind[1:] ^ kind[:-1]) - np.uint8(1) < 4
    edge[at] = True
    edges = np.flatnonzero(edge)
    kept = kind[edges[:-1]] > 0
    starts = edges[:-1][kept]
    ends = np.zeros(len(starts) + 1, np.int32)
    np.cumsum(np.diff(edges)[kept], out=ends[1:])
    found = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(text.translate(None, _BLANKS))])
    return found, np.searchsorted(starts, at)


class WordTokenizer:
    """Packed ids of a text by a tokenizer that never looks across ASCII white space.

    Its normaliser turns white space to single spaces and lower case, and its splitter
    drops spaces and parts letters from marks. So a text's ids are those of its units in
    turn. A block's distinct units are found by Arrow, and each is looked up once; its
    occurrences are gathered from there. Simple units go to the same merges in long
    lines, without normaliser and splitter, whose ids are told apart by the suffix of a
    last token. Units are kept in two generations: when the younger is full, the older
    goes, so frequent ones stay and memory is bounded.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        suffix = spec["model"]["end_of_word_suffix"]
        vocab = spec["model"]["vocab"]
        self.last = np.zeros(max(vocab.values()) + 1, bool)
        self.last[[i for t, i in vocab.items() if t.endswith(suffix)]] = True
        spec |= {"normalizer": None, "pre_tokenizer": {"type": "WhitespaceSplit"}, "added_tokens": []}
        self.merger = Tokenizer.from_str(json.dumps(spec))
        # Printable characters stand for their bytes, those from U+0100 on for the others.
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [x for x in range(256) if x not in shown]
        self.stands = [(chr(x), chr(256 + n)) for n, x in enumerate(hidden) if _TAIL[x]]
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def _merged(self, units: list[bytes]) -> list[bytes]:
        """Packed ids of simple units."""
        line = b" ".join(units).decode("latin-1")
        for byte, shown in self.stands:
            line = line.replace(byte, shown)
        ids = np.array(self.merger.encode_batch_fast([line], add_special_tokens=False)[0].ids, "<u4")
        ends = (4 * np.flatnonzero(self.last[ids]) + 4).tolist()
        packed = ids.tobytes()
        return [packed[i:j] for i, j in zip([0, *ends[:-1]], ends, strict=True)]

    def _learn(self, units: list[bytes]) -> None:
        simple, other = [], []
        for u in units:
            (simple if SIMPLE.fullmatch(u) else other).append(u)
        for i in range(0, len(simple), 5_000):
            some = simple[i : i + 5_000]
            self.known.update(zip(some, self._merged(some), strict=True))
        for i in range(0, len(other), 5_000):
            some = other[i : i + 5_000]
            found = self.tokenizer.encode_batch_fast([u.decode("utf-8") for u in some], add_special_tokens=False)
            self.known.update((u, array("I", e.ids).tobytes()) for u, e in zip(some, found, strict=True))

    def _look_up(self, units: list[bytes]) -> list[bytes]:
        if len(self.known) > CACHE_UNITS // 2:
            self.older, self.known = self.known, {}
        known, older = self.known, self.older
        missing = [u for u in units if u not in known]
        known.update((u, older[u]) for u in missing if u in older)
        self._learn([u for u in dict.fromkeys(missing) if u not in older])
        return list(map(known.__getitem__, units))

    def encode(self, texts: pa.Array) -> list[bytes]:
        data, at = _text_bytes(texts)
        raw = data.tobytes()
        # Special tokens are matched before letters are lowered, so texts that may hold one keep their case and words.
        special = {n: raw[at[n] : at[n + 1]] for n in range(len(texts)) if b"<|" in raw[at[n] : at[n + 1]]} if b"<|" in raw else {}
        out = [b""] * len(texts)
        if raw:
            units, before = _units(raw.lower(), at)
            coded = units.dictionary_encode()
            _, cuts, distinct = coded.dictionary.buffers()
            cuts, distinct = np.frombuffer(cuts, np.int32)[: len(coded.dictionary) + 1].tolist(), distinct.to_pybytes() if distinct else b""
            found = self._look_up([distinct[i:j] for i, j in zip(cuts, cuts[1:])])
            which = coded.indices.to_numpy()
            sizes = np.fromiter(map(len, found), np.int32, len(found)) // 4
            table = np.frombuffer(b"".join(found), "<u4")
            counts = sizes[which]
            ends = np.cumsum(counts, dtype=np.int32)
            first = (np.cumsum(sizes, dtype=np.int32) - sizes)[which] - (ends - counts)
            ids = table[np.repeat(first, counts) + np.arange(len(first) and ends[-1], dtype=np.int32)].tobytes()
            cuts = (4 * np.r_[0, ends.astype(np.int64)][before]).tolist()
            out = [ids[i:j] for i, j in zip(cuts, cuts[1:])]
        for n, text in special.items():
            out[n] = b"".join(self._look_up(text.split()))
        return out


def tokenizer(path: str) -> WordTokenizer:
    if path not in _tokenizers:
        _tokenizers[path] = WordTokenizer(path)
    return _tokenizers[path]


def tokenised(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """doc_id, ids (packed little-endian unsigned 32-bit, the separator last) of each row; a null text is empty."""
    from sondera.llm.bpe import blocks

    end = SEPARATOR_ID.to_bytes(4, "little")

    def run(batches):
        t = tokenizer(tokenizer_path)
        for b in blocks(batches, most=BLOCK_BYTES):
            ids = [x + end for x in t.encode(b.column(1))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.binary())], names=["doc_id", "ids"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, ids binary")


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """Cut tokenised documents: one row per piece with its start, length and CRC-32."""
    from sondera.llm.bpe import blocks
    from sondera.llm.common import hand_back

    end = SEPARATOR_ID.to_bytes(4, "little")

    def run(batches):
        t = tokenizer(tokenizer_path)
        for b in blocks(batches, most=BLOCK_BYTES):
            rows = []
            for doc, ids in zip(b.column(0).to_pylist(), t.encode(b.column(1)), strict=True):
                ids += end
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    rows.append((doc, k, at // 4, len(part) // 4, zlib.crc32(part)))
            columns = list(zip(*rows, strict=True)) or [()] * 5
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays([pa.array(c, y) for c, y in zip(columns, types, strict=True)], names=names)
        b = None
        hand_back()

    return docs.select("doc_id", "text").mapInArrow(run, PIECES_SCHEMA)


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each length (each at most ``capacity``), placed in falling order of length."""
    counts = np.zeros(capacity + 1, np.int64)
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    made = 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        s = int(lengths[i])
        fits = counts[s:]
        change = 2 * (counts[: capacity + 1 - s] - fits)  # the change of the sum, less 2
        change[0] = -2 * fits[0] - 1  # a filled bin is no longer counted
        change[fits == 0] = 4 * len(lengths) + 4
        gap = s + int(change.argmin())
        if counts[gap]:
            at = open_bins[gap].pop()
            counts[gap] -= 1
        else:
            at, gap, made = made, capacity, made + 1
        bins[i], offsets[i] = at, capacity - gap
        if gap > s:
            counts[gap - s] += 1
            open_bins[gap - s].append(at)
    return bins, offsets


def pack(cut: DataFrame, capacity: int = CAPACITY, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Add sequence_id and offset to rows with a ``length``; columns doc_id, piece, start, ids_crc32 go along.

    ``cut`` is read twice (a count fixes the number of groups), so pass a staged table.
    Equal rows are packed as often as they occur. No rows give no sequences.
    """
    groups = max(1, -(-cut.count() // group_pieces))

    def run(key, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "doc_id", "piece"], ascending=[False, True, True], kind="stable")
        bins, offsets = sum_of_squares(rows["length"].to_numpy(), capacity)
        rows = rows.drop(columns="pack_group")
        return rows.assign(sequence_id=(key[0] << 32) + bins, offset=offsets)

    dealt = cut.withColumn("pack_group", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)))
    return dealt.groupBy("pack_group").applyInPandas(run, PACKED_SCHEMA)


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """Pack every document; one row per piece.

    Null and empty texts are one piece that holds the separator alone. A document longer
    than the capacity gives pieces of exactly the capacity and a last, shorter one.
    Repeated doc_ids are packed as separate documents. Extra columns are ignored; an
    empty table gives an empty result.
    """
    from sondera.llm.common import staged

    return pack(staged(pieces(docs, tokenizer_path, capacity), "pieces"), capacity)


def sequences(docs: DataFrame, packed: DataFrame, tokenizer_path: str) -> DataFrame:
    """The packed token sequences themselves: sequence_id, length, ids (packed unsigned 32-bit).

    ``docs`` must have unique doc_ids; documents with a null one are left out. A sequence
    is at most the capacity long, so its group is bounded.
    """
    spans = tokenised(docs, tokenizer_path).join(packed, "doc_id")
    part = F.expr("substring(ids, cast(4 * start + 1 as int), cast(4 * length as int))")
    ordered = F.array_sort(F.collect_list(F.struct("offset", part.alias("ids"))))
    joined = F.aggregate(ordered, F.lit(b""), lambda a, x: F.concat(a, x["ids"]))
    return spans.groupBy("sequence_id").agg(F.sum("length").alias("length"), joined.alias("ids"))
