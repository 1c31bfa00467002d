"""Byte-level BPE encoding and decoding with a segment tree per piece.

A text is cut into pieces by the tokenizer's pattern. A piece that is a token
is its id; any other piece starts as its bytes, and a segment tree over the byte
positions holds, at the position where a live part begins, the rank of the pair it
forms with the next live part. Each node keeps the smallest (rank, position)
below it, so the root names the leftmost pair of lowest rank; a merge rewrites
the leaves of the merged part, of the part it swallowed and of its left
neighbour, and updates their log2(length) ancestors. Pieces of one size class
are merged side by side: every step does one merge in each piece. A piece above ``LONG_PIECE``
bytes is merged alone: a step descends its tree to all places of the lowest rank, merges them
from the left up to the first merge that makes a pair of lower rank (which one merge at a
time would take next), and updates the tree once for all of them.

Scale: a narrow pass, one row in and out; the rank file is read by each worker
from the installed tokenizer files (its path is a parameter). Encoded pieces are
remembered per worker up to ``CACHE_PIECES`` and ``CACHE_BYTES``, which bounds memory and changes
no result. A long piece takes about 50 bytes of work memory a byte while it is merged.

Defined cases: null and empty texts give no ids and decode to no bytes;
special-token strings are ordinary text; extra columns pass through; an id that
the vocabulary lacks, a null id list, or bytes that are no UTF-8 are errors, null
text and replacement characters respectively on decoding.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, text_of, text_slices

CACHE_PIECES = 300_000
CACHE_BYTES = 64 << 20
LONG_PIECE = 2048         # bytes above which a piece is merged alone, many places a step
TREE_CELLS = 1 << 20      # leaves merged at a time
LONG_TEXT = 1 << 20       # characters above which pieces are taken in runs
PIECES_AT_ONCE = 1 << 16
NONE = np.int64(1) << 62


class Vocabulary:
    """Tokens by id, the pairs that merge, and the pieces encoded so far."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.pattern = regex.compile(pattern)
        self.ranks = ranks
        self.tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.byte_ids = np.array([ranks[bytes([i])] for i in range(256)], np.int64)
        pairs = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = rank
        self.pair_keys = np.array(sorted(pairs), np.int64)
        self.pair_ranks = np.array([pairs[k] for k in self.pair_keys.tolist()], np.int64)
        self.cache: dict[str, bytes] = {}
        self.held = 0  # bytes of long pieces in the cache

    def pair_rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], NONE)

    def merge(self, pieces: list[bytes], leaves: int) -> list[bytes]:
        """Ids (packed) of pieces of at most ``leaves`` bytes (a power of two)."""
        n = len(pieces)
        size = np.array([len(p) for p in pieces])
        raw = np.frombuffer(b"".join(p.ljust(leaves, b"\0") for p in pieces), np.uint8).reshape(n, leaves)
        part = self.byte_ids[raw]
        place = np.arange(leaves)
        follow = np.minimum(np.broadcast_to(place + 1, (n, leaves)), size[:, None])
        before = np.broadcast_to(place - 1, (n, leaves)).copy()
        tree = np.full((n, 2 * leaves), NONE, np.int64)
        rank = self.pair_rank(part[:, :-1], part[:, 1:])
        value = np.where((rank < NONE) & (place[None, 1:] < size[:, None]), rank * leaves + place[:-1], NONE)
        tree[:, leaves:2 * leaves - 1] = value
        width = leaves
        while width > 1:
            width //= 2
            tree[:, width:2 * width] = np.minimum(tree[:, 2 * width:4 * width:2], tree[:, 2 * width + 1:4 * width:2])
        live = np.broadcast_to(place, (n, leaves)) < size[:, None]
        rows = np.flatnonzero(tree[:, 1] < NONE)
        while len(rows):
            best = tree[rows, 1]
            at = best % leaves
            gone = follow[rows, at]
            after = follow[rows, gone]
            part[rows, at] = best // leaves
            follow[rows, at] = after
            live[rows, gone] = False
            more = after < size[rows]
            before[rows[more], after[more]] = at[more]
            left = before[rows, at]
            has_left = left >= 0
            safe_after, safe_left = np.where(more, after, 0), np.where(has_left, left, 0)
            own = self.pair_rank(part[rows, at], part[rows, safe_after])
            own = np.where(more & (own < NONE), own * leaves + at, NONE)
            lft = self.pair_rank(part[rows, safe_left], part[rows, at])
            lft = np.where(lft < NONE, lft * leaves + left, NONE)
            tree[rows, leaves + gone] = NONE
            tree[rows, leaves + at] = own
            tree[rows[has_left], leaves + left[has_left]] = lft[has_left]
            nodes = np.stack([gone, at, safe_left]) + leaves
            while nodes[0, 0] > 1:
                nodes >>= 1
                for k in range(3):
                    tree[rows, nodes[k]] = np.minimum(tree[rows, 2 * nodes[k]], tree[rows, 2 * nodes[k] + 1])
            rows = rows[tree[rows, 1] < NONE]
        ids = part[live].astype("<u4").tobytes()
        ends = np.cumsum(live.sum(axis=1)) * 4
        return [ids[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]

    def merge_long(self, raw: bytes) -> bytes:
        """Ids (packed) of one long piece."""
        n, leaves = len(raw), 1 << (len(raw) - 1).bit_length()
        part = self.byte_ids[np.frombuffer(raw, np.uint8)]
        follow, before, live = np.arange(1, n + 1), np.arange(-1, n - 1), np.ones(n, bool)
        tree = np.full(2 * leaves, NONE, np.int64)
        rank = self.pair_rank(part[:-1], part[1:])
        tree[leaves:leaves + n - 1] = np.where(rank < NONE, rank * leaves + np.arange(n - 1), NONE)
        width = leaves
        while width > 1:
            width //= 2
            tree[width:2 * width] = np.minimum(tree[2 * width:4 * width:2], tree[2 * width + 1:4 * width:2])
        while tree[1] < NONE:
            low = tree[1] // leaves
            nodes = np.ones(1, np.int64)
            while nodes[0] < leaves:  # down to every leaf of the lowest rank, in order
                nodes = np.repeat(2 * nodes, 2)
                nodes[1::2] += 1
                nodes = nodes[tree[nodes] < (low + 1) * leaves]
            at = nodes - leaves
            begins = np.ones(len(at), bool)
            begins[1:] = follow[at[:-1]] != at[1:]
            number = np.arange(len(at))  # of overlapping places every other one, from the left
            at = at[(number - np.maximum.accumulate(np.where(begins, number, 0))) % 2 == 0]
            gone = follow[at]
            after, left = follow[gone], before[at]
            left_part = part[left]
            merged = np.zeros(len(at), bool)
            merged[1:] = after[:-1] == at[1:]  # the left neighbour is merged in this step too
            left[1:][merged[1:]] = at[:-1][merged[1:]]
            left_part[merged] = low
            lower = (left >= 0) & (self.pair_rank(left_part, np.full(len(at), low)) < low)
            lower |= (after < n) & (self.pair_rank(np.full(len(at), low), part[np.minimum(after, n - 1)]) < low)
            if lower.any():
                stop = int(np.argmax(lower)) + 1
                at, gone, after, left = at[:stop], gone[:stop], after[:stop], left[:stop]
            part[at], follow[at], live[gone] = low, after, False
            before[after[after < n]] = at[after < n]
            touched = np.unique(np.concatenate((at, left[left >= 0])))
            right = follow[touched]
            rank = np.where(right < n, self.pair_rank(part[touched], part[np.minimum(right, n - 1)]), NONE)
            tree[leaves + gone] = NONE
            tree[leaves + touched] = np.where(rank < NONE, rank * leaves + touched, NONE)
            nodes = np.unique(np.concatenate((gone, touched))) + leaves
            while nodes[0] > 1:
                nodes >>= 1
                nodes = nodes[np.concatenate(([True], nodes[1:] != nodes[:-1]))]
                tree[nodes] = np.minimum(tree[2 * nodes], tree[2 * nodes + 1])
        return part[live].astype("<u4").tobytes()

    def learn(self, pieces: set[str]) -> None:
        """Encode new pieces into the cache, size class by size class."""
        classes: dict[int, list[tuple[str, bytes]]] = {}
        for piece in pieces:
            raw = piece.encode()
            whole = self.ranks.get(raw)
            if whole is not None:
                self.cache[piece] = whole.to_bytes(4, "little")
            elif len(raw) > LONG_PIECE:
                self.cache[piece] = self.merge_long(raw)
                self.held += len(raw)
            else:
                classes.setdefault(1 << max(1, (len(raw) - 1).bit_length()), []).append((piece, raw))
        for leaves, group in classes.items():
            step = max(1, TREE_CELLS // leaves)
            for lo in range(0, len(group), step):
                part = group[lo:lo + step]
                self.cache.update(zip((p for p, _ in part), self.merge([r for _, r in part], leaves)))

    def _pieces(self, text: str) -> Iterator[list[str]]:
        if len(text) <= LONG_TEXT:
            yield self.pattern.findall(text)
            return
        found = (m.group() for m in self.pattern.finditer(text))
        while run := list(islice(found, PIECES_AT_ONCE)):
            yield run

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Packed little-endian 32-bit ids of each text."""
        if len(self.cache) > CACHE_PIECES or self.held > CACHE_BYTES:
            self.cache.clear()
            self.held = 0
        cut = [self.pattern.findall(t) if t and len(t) <= LONG_TEXT else None for t in texts]
        self.learn({p for pieces in cut if pieces for p in pieces if p not in self.cache})
        out = []
        for text, pieces in zip(texts, cut):
            if pieces is not None:
                out.append(b"".join(map(self.cache.__getitem__, pieces)))
                continue
            ids = []
            for run in self._pieces(text or ""):
                self.learn({p for p in run if p not in self.cache})
                ids.append(b"".join(map(self.cache.__getitem__, run)))
            out.append(b"".join(ids))
        return out

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(maxsize=4)
def vocabulary(path: str, pattern: str) -> Vocabulary:
    return Vocabulary(path, pattern)


def _schema(df: DataFrame, extra: str) -> str:
    return ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema] + [extra])


def encode(docs: DataFrame, path: str, pattern: str, text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """The carried columns (default: all but the text) as struct ``row``, and
    ``ids``: packed little-endian unsigned 32-bit token ids (binary)."""
    bound_batches(docs.sparkSession)
    names = [c for c in docs.columns if c != text_col] if carry is None else carry
    source = docs.select(F.struct(*[F.col(f"`{c}`") for c in names], F.lit(0).alias("__")).alias("row"),
                         F.col(f"`{text_col}`").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path, pattern)
        for part in text_slices(batches):
            ids = pa.array(vocab.encode(part.column("text").to_pylist()), pa.binary())
            yield pa.RecordBatch.from_arrays([part.column("row"), ids], names=["row", "ids"])

    return source.mapInArrow(run, f"row {source.schema['row'].dataType.simpleString()}, ids binary")


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """``encoded`` with a column ``bytes``: the tokens of ``ids``, joined (null for null ids)."""
    bound_batches(encoded.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path, pattern)
        for part in text_slices(batches, "ids"):
            raw = [None if i is None else vocab.decode(i) for i in part.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(raw, pa.binary())], names=[*part.schema.names, "bytes"])

    return encoded.mapInArrow(run, _schema(encoded, "bytes binary"))


def digest(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 per document."""
    out = decode(encode(docs, path, pattern, carry=["doc_id"]), path, pattern)
    return out.select(F.col("row.doc_id").alias("doc_id"), (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                      F.sha2("ids", 256).alias("ids_sha256"), F.sha2("bytes", 256).alias("decoded_sha256"))


def tokens(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens and ``ids`` as an array of ints: the token table of a corpus."""
    bound_batches(docs.sparkSession)
    rows = docs.select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path, pattern)
        for part in text_slices(batches):
            packed = vocab.encode(part.column("text").to_pylist())
            sizes = np.array([len(p) // 4 for p in packed], np.int64)
            off = pa.array(np.concatenate(([0], np.cumsum(sizes))).astype(np.int32))
            flat = pa.array(np.frombuffer(b"".join(packed), "<u4").astype(np.int32))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(sizes), pa.ListArray.from_arrays(off, flat)],
                                             names=["doc_id", "n_tokens", "ids"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_tokens long, ids array<int>")
