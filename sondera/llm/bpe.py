"""Byte-level BPE by corpus-level merge replay.

Every block of documents is treated as a corpus: the distinct pre-tokens that are
not known yet are laid out in one long token sequence, an inverted index maps each
mergeable pair (named by the rank of its concatenation) to the positions where it
stands, and merges are applied in rank order through a heap, touching only the two
neighbours of each merged position. Results equal those of the tiktoken library.
The replay is per block, as joining a global word table with all occurrences of
words would shuffle more than the texts themselves.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from array import array

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
IDS_SCHEMA = "doc_id long, ids array<int>"

#: Pieces, and as many words, kept per worker in two generations: when the younger is full, the older goes.
CACHE_WORDS = 700_000

#: The rank of pairs that never merge.
NONE = 1 << 40

_coders: dict[tuple[str, str], Coder] = {}


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


class Merges:
    """All pairs of tokens whose concatenation is a token, for lookup by arrays of ids."""

    def __init__(self, ranks: dict[bytes, int]):
        pairs = {
            (ranks[token[:i]] << 32) | ranks[token[i:]]: rank
            for token, rank in ranks.items()
            for i in range(1, len(token))
            if token[:i] in ranks and token[i:] in ranks
        }
        self.keys = np.array(sorted(pairs), np.int64)
        self.values = np.array([pairs[k] for k in self.keys.tolist()], np.int64)
        self.of_byte = np.array([ranks.get(bytes([x]), -1) for x in range(256)], np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.full(len(left), NONE)
        key = (left << 32) | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.values[at], NONE)


def replay(words: list[bytes], merges: Merges) -> list[bytes]:
    """Packed ids of each non-empty word, by replaying the merges over all words at once.

    Positions are bytes of the concatenated words; the posting list of a rank holds the
    positions where a pair of that rank begins. Within a word the library merges the
    leftmost pair of least rank, then looks again. So all places of a rank are merged in
    one step, leftmost first where they overlap, unless a merge would create a pair of
    lower rank in a word with further places: that word's further places are put back.
    """
    if not words:
        return []
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths)
    word = np.repeat(np.arange(len(words)), lengths)
    token = merges.of_byte[np.frombuffer(b"".join(words), np.uint8)]
    n = len(token)
    after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
    after[ends - 1], before[ends - lengths] = -1, -1
    rank = np.full(n, NONE)
    rank[:-1] = merges.rank(token[:-1], token[1:])
    rank[ends - 1] = NONE
    alive = np.ones(n, bool)
    order = np.argsort(rank, kind="stable")[: int((rank < NONE).sum())]
    present, first = np.unique(rank[order], return_index=True)
    index = dict(zip(present.tolist(), np.split(order, first[1:]), strict=True)) if len(order) else {}
    later: dict[int, list[int]] = {}
    heap = present.tolist()
    while heap:
        r = heapq.heappop(heap)
        places = index.pop(r, None)
        if (more := later.pop(r, None)) is not None:
            more = np.array(more, np.int64)
            places = more if places is None else np.concatenate([places, more])
        left = places[rank[places] == r]
        if not len(left):
            continue
        if len(left) > 1:
            left = np.unique(left)
            w = word[left]
            again = np.flatnonzero(w[1:] == w[:-1]) + 1
            if len(again):
                at = np.arange(len(left))
                chained = np.zeros(len(left), bool)
                chained[1:] = after[left[:-1]] == left[1:]
                left = left[(at - np.maximum.accumulate(np.where(chained, 0, at))) % 2 == 0]
                right = after[left]
                beyond, prior = after[right], before[left]
                merged = np.full(len(left), r)
                made = np.where(beyond >= 0, merges.rank(merged, token[beyond]), NONE)
                previous = np.where(np.r_[False, prior[1:] == right[:-1]], r, token[prior])
                made = np.minimum(made, np.where(prior >= 0, merges.rank(previous, merged), NONE))
                if (made < r).any():
                    w = word[left]
                    early = np.isin(w, w[made < r]) & np.r_[False, w[1:] == w[:-1]]
                    if early.any():
                        later[r] = left[early].tolist()
                        heapq.heappush(heap, r)
                        left = left[~early]
        right = after[left]
        beyond, prior = after[right], before[left]
        token[left] = r
        alive[right] = False
        rank[right] = NONE
        after[left] = beyond
        has = beyond >= 0
        before[beyond[has]] = left[has]
        prior = before[left]  # of adjacent merges the left one is already in place
        touched = np.concatenate([left, prior[prior >= 0]]) if len(left) > 1 else np.array([left[0], prior[0]] if prior[0] >= 0 else left)
        then = after[touched]
        new = np.where(then >= 0, merges.rank(token[touched], token[then]), NONE)
        rank[touched] = new
        for x, at in zip(new.tolist(), touched.tolist(), strict=True):
            if x < NONE:
                if x in later:
                    later[x].append(at)
                else:
                    later[x] = [at]
                    if x not in index:
                        heapq.heappush(heap, x)
    ids = token[alive].astype("<u4").tobytes()
    sizes = 4 * np.cumsum(np.bincount(word[alive], minlength=len(words)))
    return [ids[i:j] for i, j in zip([0, *sizes[:-1].tolist()], sizes.tolist(), strict=True)]


class Coder:
    """Encodes texts to packed little-endian unsigned 32-bit ids and decodes them."""

    def __init__(self, ranks_path: str, pattern: str):
        self.ranks = load_ranks(ranks_path)
        self.packed = {token: rank.to_bytes(4, "little") for token, rank in self.ranks.items()}
        self.token = [b""] * (max(self.ranks.values(), default=-1) + 1)
        for token, rank in self.ranks.items():
            self.token[rank] = token
        # In the library's dialect \\s is the White_Space property, without the controls 28 to 31.
        self.matches = regex.compile(pattern.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")).findall
        self.merges = Merges(self.ranks)
        self.known: dict[str, bytes] = {}
        self.words: dict[bytes, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.older_words: dict[bytes, bytes] = {}

    def _pieces(self, text: str) -> list[str]:
        """Cut the text where the pattern always cuts.

        A space or newline between two non-space characters is such a place: the space
        begins the next match and the newline is a match of its own. Texts with any
        other white space are cut at every match; a match alone matches as a whole.
        """
        if not text:
            return []
        if len(text.split()) != text.count(" ") + text.count("\n") + 1:
            return self.matches(text)
        pieces: list[str] = []
        for n, line in enumerate(text.split("\n")):
            if n:
                pieces.append("\n")
            first, *rest = line.split(" ")
            pieces.append(first)
            pieces.extend([" " + x for x in rest])
        return pieces

    def _learn(self, pieces: set[str]) -> None:
        """Encode new pieces: whole pre-tokens by the table, the others by one replay."""
        again = pieces & self.older.keys()
        self.known.update((p, self.older[p]) for p in again)
        cut = {p: [m.encode("utf-8", "surrogatepass") for m in self.matches(p)] for p in pieces - again}
        packed = self.packed
        distinct = {m for ms in cut.values() for m in ms if m not in packed}
        if len(self.words) > CACHE_WORDS // 2:
            self.older_words, self.words = self.words, {}
        words, older = self.words, self.older_words
        words.update((m, older[m]) for m in distinct & older.keys())
        new = list(distinct - words.keys())
        words.update(zip(new, replay(new, self.merges), strict=True))
        for p, ms in cut.items():
            self.known[p] = b"".join([packed.get(m) or words[m] for m in ms])

    def encode(self, texts: list[str | None]) -> list[bytes]:
        pieces = [self._pieces(t or "") for t in texts]
        if len(self.known) > CACHE_WORDS // 2:
            self.older, self.known = self.known, {}
        if new := set().union(*pieces) - self.known.keys():
            self._learn(new)
        get = self.known.__getitem__
        return [b"".join(map(get, p)) for p in pieces]

    def decode(self, packed: bytes) -> bytes:
        ids = array("I")
        ids.frombytes(packed)
        return b"".join(map(self.token.__getitem__, ids))


def coder(ranks_path: str, pattern: str) -> Coder:
    key = (ranks_path, pattern)
    if key not in _coders:
        _coders[key] = Coder(*key)
    return _coders[key]


#: Characters encoded at a time; a longer text is a block of its own.
BLOCK_CHARS = 8_000_000


def blocks(batches, text_column: str = "text", most: int | None = None):
    """Slices of record batches with about ``most`` bytes of a column (BLOCK_CHARS unless given)."""
    most = most or BLOCK_CHARS
    for batch in batches:
        at, size = 0, 0
        for n, x in enumerate(batch.column(batch.schema.get_field_index(text_column))):
            size += len(x.as_buffer() or b"") if x.is_valid else 0
            if size >= most:
                yield batch.slice(at, n + 1 - at)
                at, size = n + 1, 0
        if at < batch.num_rows:
            yield batch.slice(at)


def encode(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """doc_id and the ids of each whole text (null: empty array). Other columns are ignored."""

    def run(batches):
        c = coder(ranks_path, pattern)
        for b in blocks(batches):
            ids = []
            for packed in c.encode(b.column(1).to_pylist()):
                a = array("i")
                a.frombytes(packed)
                ids.append(a.tolist())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])

    return docs.select("doc_id", "text").mapInArrow(run, IDS_SCHEMA)


def decode(encoded: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """doc_id and the bytes of each row's ids (null ids: empty)."""

    def run(batches):
        c = coder(ranks_path, pattern)
        for b in batches:
            out = [c.decode(array("I", ids or []).tobytes()) for ids in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.binary())], names=["doc_id", "content"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, content binary")


def round_trip(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """One row per row of ``docs``: the digests of its ids and of the bytes decoded from them.

    Null and empty texts have 0 tokens and the digest of no bytes. Repeated rows and
    doc_ids give as many rows; a null doc_id stays null; extra columns are ignored.
    """

    def run(batches):
        c = coder(ranks_path, pattern)
        for b in blocks(batches):
            packed = c.encode(b.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0),
                    pa.array([len(p) // 4 for p in packed], pa.int64()),
                    pa.array([hashlib.sha256(p).hexdigest() for p in packed], pa.string()),
                    pa.array([hashlib.sha256(c.decode(p)).hexdigest() for p in packed], pa.string()),
                ],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)
