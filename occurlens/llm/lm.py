"""N-gram language model as a weighted backoff automaton, trained and applied at scale.

Tokens are the ASCII-lowered words ``[^\\x20\\x09-\\x0D]+`` of a text and one end token.
The model interpolates n-gram orders with a Dirichlet prior: with h a context of
k - 1 tokens, h' the context without its first token and mu the concentration,

    p_k(w | h) = (c(h w) + mu * p_{k-1}(w | h')) / (c(h) + mu)
    p_1(w)     = (c(w) + 0.5) / (N + 0.5 * (V + 1))

As an automaton, a state is a context, an arc (h, w) carries log10 p_k(w | h) for every
n-gram seen in training, and a failure arc from h to h' carries log10(mu / (c(h) + mu)):
an unseen n-gram's probability is that weight times the one at h', so the weights of the
failures taken and of the arc found add up to the interpolated log-probability. An arc leads to the
longest suffix of its n-gram that is a context; a text's walk carries that state on.

Scale: the model has no size bound, so it is never gathered. The documents are cut into
blocks of bounded text, whose distinct n-grams are packed by shard. Each shard sums the
counts of its n-grams over all training blocks and answers every block that asked, in the
block's own order, with the totals only (written as a table). A second pass over the texts
turns each block into n-gram numbers, joins it with its answers, builds the sub-automaton of
the n-grams it meets and scores its texts, left to right, all texts of the block side by side.
The number of shards follows the bytes of text, so a shard's n-grams, and the tasks that sum them, do not
grow with the corpus. Counts cover every document; n-grams of a block are summed before they are shuffled, so a
frequent n-gram is at most one number a block. Both passes must see the same rows in the
same order, as a stored table gives them; checksums of every block's n-grams are compared,
and a difference is an error, never a wrong score.

Defined cases: null and empty texts have the end token alone; a null doc_id counts as
training text (its checksum is null); repeated rows count as often as they occur; with no
training document every count is 0; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, SLICE_BYTES, Texts, Words, bound_batches, mix, text_slices, with_row_id, written

ORDER = 3
CONCENTRATION = 5.0
BLOCK_BYTES = SLICE_BYTES       # text of a block (a single longer text is a block of its own); a worker holds many times that
SHARD_BYTES = 4 * SLICE_BYTES   # text per shard: a shard's share of the n-grams stays as large however much there is
MAX_BLOCKS = 100_000            # beyond, blocks grow with the corpus, so that blocks x shards stays bounded
END = np.uint64(0x5851F42D4C957F2D)
START = np.uint64(0x14057B7EF767814F)


def _pack(a: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(a).tobytes())


def _unpack(b: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(b), kind)


def _columns(a: np.ndarray) -> np.ndarray:
    """Bytes of the numbers, place by place: the high bytes of sorted gaps and of small
    counts then lie together and compress well."""
    return np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.itemsize).T)


def _pack_numbers(a: np.ndarray) -> bytes:
    return _pack(_columns(a))


def _unpack_numbers(b: bytes, kind: str) -> np.ndarray:
    size = np.dtype(kind).itemsize
    raw = _unpack(b, "u1")
    return np.ascontiguousarray(raw.reshape(size, len(raw) // size).T).view(kind).ravel()


def pack_keys(keys: np.ndarray) -> bytes:
    """Sorted distinct 64-bit keys as gaps."""
    return _pack_numbers(np.diff(keys, prepend=np.uint64(0)))


def unpack_keys(b: bytes) -> np.ndarray:
    return np.cumsum(_unpack_numbers(b, "u8"), dtype=np.uint64)


class Block:
    """Token sequence of some texts: each text is order - 1 start marks, its words, the end."""

    def __init__(self, parts: list[pa.RecordBatch], order: int):
        hashes, sizes = [], []
        for part in parts:
            words = Words(Texts(part.column("text")), LOWER)
            ends = np.cumsum(words.counts) + np.arange(1, len(words.counts) + 1) - 1
            tokens = np.empty(len(words.hashes) + len(words.counts), np.uint64)
            is_word = np.ones(len(tokens), bool)
            is_word[ends] = False
            tokens[is_word], tokens[ends] = words.hashes, END
            hashes.append(tokens)
            sizes.append(words.counts + 1)
        self.tokens, self.sizes = np.concatenate(hashes), np.concatenate(sizes).astype(np.int64)
        self.place = np.arange(len(self.tokens)) - np.repeat(np.cumsum(self.sizes) - self.sizes, self.sizes)
        self.order = order

    def keys(self, k: int) -> np.ndarray:
        """Hash of the k-gram that ends at each token; start marks fill what lies before the text."""
        if k == 1:
            return self.tokens
        out = np.full(len(self.tokens), (k * 0xD6E8FEB86659FD93) & 0xFFFFFFFFFFFFFFFF, np.uint64)
        for back in range(k - 1, -1, -1):
            token = np.where(self.place >= back, np.roll(self.tokens, back), START)
            out = mix(out * np.uint64(0x9E3779B97F4A7C15) + token)
        return out

    def start_key(self, k: int) -> np.uint64:
        """Key of the context of k start marks (its count is the number of texts)."""
        if k == 1:
            return START
        out = np.full(1, (k * 0xD6E8FEB86659FD93) & 0xFFFFFFFFFFFFFFFF, np.uint64)
        for _ in range(k):
            out = mix(out * np.uint64(0x9E3779B97F4A7C15) + START)
        return out[0]


def _shard(keys: np.ndarray, shards: int) -> np.ndarray:
    return (keys >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)


def _blocks(batches: Iterator[pa.RecordBatch], block_bytes: int) -> Iterator[list[pa.RecordBatch]]:
    held, size = [], 0
    for part in text_slices(batches):
        held.append(part)
        size += part.column("text").nbytes
        if size >= block_bytes:
            yield held
            held, size = [], 0
    if held:
        yield held


def _check(keys: np.ndarray) -> int:
    return int(np.bitwise_xor.reduce(keys, initial=np.uint64(0)).view(np.int64))


def _counted(block: Block, parts: list[pa.RecordBatch], order: int, count: bool) -> Iterator[tuple]:
    """Per order k: (k, sorted distinct k-gram keys, k-gram number at each token, training counts)."""
    train = np.concatenate([p.column("training").to_numpy(zero_copy_only=False) for p in parts])
    counted = np.repeat(train, block.sizes)
    for k in range(1, order + 1):
        keys, number = np.unique(block.keys(k), return_inverse=True)
        counts = np.bincount(number[counted], minlength=len(keys)).astype(np.uint32) if count else None
        if k < order:  # the context of start marks, counted once a training text
            mark = block.start_key(k)
            at = int(np.searchsorted(keys, mark))
            keys, number = np.insert(keys, at, mark), number + (number >= at)
            counts = np.insert(counts, at, np.uint32(train.sum())) if count else None
        yield k, keys, number, counts


def _source(docs: DataFrame, training, text_col: str, id_col: str) -> DataFrame:
    bound_batches(docs.sparkSession)
    rows = with_row_id(docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text")))
    return rows.withColumn("training", F.coalesce(training(F.col("doc_id")), F.lit(True)))


def gram_counts(rows: DataFrame, order: int, shards: int, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(block, k, shard, a, b): per block, order and shard the distinct n-grams and their training counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for parts in _blocks(batches, block_bytes):
            name = parts[0].column("row_id")[0].as_py()  # row numbers are unique, so this names the block
            out = []
            for k, keys, _, counts in _counted(Block(parts, order), parts, order, True):
                cuts = np.searchsorted(_shard(keys, shards), np.arange(shards + 1))
                out += [{"block": name, "k": k, "shard": s, "a": pack_keys(keys[a:b]), "b": _pack_numbers(counts[a:b])}
                        for s, (a, b) in enumerate(zip(cuts, cuts[1:])) if b > a]
            yield pa.RecordBatch.from_pylist(out, pa.schema([
                ("block", pa.int64()), ("k", pa.int32()), ("shard", pa.int32()), ("a", pa.binary()), ("b", pa.binary())]))

    return rows.mapInArrow(run, "block long, k int, shard int, a binary, b binary")


def streams(rows: DataFrame, order: int, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(block, sizes, numbers, checks, ids): per block its texts as k-gram numbers, with a checksum of
    the keys of every order, which the answers must match."""
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for parts in _blocks(batches, block_bytes):
            block = Block(parts, order)
            numbers, checks = [], []
            for _, keys, number, _ in _counted(block, parts, order, False):
                numbers.append(_pack_numbers(number.astype(np.uint32)))
                checks.append(_check(keys))
            ids = pa.concat_arrays([p.column("doc_id") for p in parts])
            yield pa.RecordBatch.from_pylist(
                [{"block": parts[0].column("row_id")[0].as_py(), "sizes": _pack_numbers(block.sizes), "numbers": numbers,
                  "checks": checks, "ids": ids.to_pylist()}],
                pa.schema([("block", pa.int64()), ("sizes", pa.binary()), ("numbers", pa.list_(pa.binary())),
                           ("checks", pa.list_(pa.int64())), ("ids", pa.list_(ids.type))]))

    return rows.mapInArrow(run, f"block long, sizes binary, numbers array<binary>, checks array<long>, ids array<{kind}>")


def _sum_shard(rows: list[dict]) -> list[dict]:
    """Answers of one shard of one order: training totals in each block's own key order."""
    keys = [unpack_keys(r["a"]) for r in rows]
    total_keys, number = np.unique(np.concatenate(keys), return_inverse=True)
    counts = np.concatenate([_unpack_numbers(r["b"], "u4") for r in rows])
    totals = np.bincount(number, weights=counts, minlength=len(total_keys)).astype(np.uint64)
    out, at = [], 0
    real = totals[total_keys != START] if rows[0]["k"] == 1 else totals
    for r, k in zip(rows, keys):
        mine = totals[number[at:at + len(k)]]
        at += len(k)
        out.append({"block": r["block"], "k": r["k"], "shard": r["shard"], "totals": _pack_numbers(mine), "check": _check(k)})
    out[0] |= {"tokens": int(real.sum()), "types": int((real > 0).sum())}
    return out


def totals(keys: DataFrame, tasks: int) -> DataFrame:
    """Written table (block, k, shard, totals, check, tokens, types): what each shard answers each
    block; its first row also has the shard's token and type sums."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        schema = pa.schema([("block", pa.int64()), ("k", pa.int32()), ("shard", pa.int32()), ("totals", pa.binary()),
                            ("check", pa.int64()), ("tokens", pa.int64()), ("types", pa.int64())])
        for batch in batches:
            for row in batch.to_pylist():
                if held and (row["k"], row["shard"]) != (held[0]["k"], held[0]["shard"]):
                    yield pa.RecordBatch.from_pylist(_sum_shard(held), schema)
                    held = []
                held.append(row)
        if held:
            yield pa.RecordBatch.from_pylist(_sum_shard(held), schema)

    return written(keys.repartition(tasks, "k", "shard").sortWithinPartitions("k", "shard").mapInArrow(
        run, "block long, k int, shard int, totals binary, check long, tokens long, types long"), "totals")


class Automaton:
    """Backoff automaton over the n-grams of one block.

    States are contexts: state 0 is the empty one, the states of level k (2 to the order) are the
    (k-1)-grams of the block. ``arc_keys`` (state * tokens + token, sorted) has an arc for every
    k-gram seen in training, with its weight and the next state: the longest suffix of the k-gram
    that is a context. State 0 has an arc for every token. Every other state has a failure
    arc, with its weight, to the state of the context without its first token."""

    def __init__(self, numbers: list[np.ndarray], counts: list[np.ndarray], contexts: list[np.ndarray],
                 n: int, v: int, mu: float):
        """numbers[k-1]: k-gram number at each token; counts[k-1]: training total of each
        k-gram; contexts[k-1]: (k-1)-gram number of the context of each token (k >= 2)."""
        top, self.tokens = len(numbers), len(counts[0])
        base = np.cumsum([0, 1, *(len(counts[k - 2]) for k in range(2, top + 1))])  # first state of each level
        self.stream = numbers[0]
        self.unigram = np.log10((counts[0] + 0.5) / (n + 0.5 * (v + 1)))
        self.failure, self.shorter = np.zeros(base[-1]), np.zeros(base[-1], np.int64)
        token = np.arange(self.tokens)
        known = counts[0] > 0
        keys, weights = [token], [self.unigram]
        targets = [np.where(known, base[1] + token, 0) if top > 1 else np.zeros(self.tokens, np.int64)]
        lower = self.unigram
        for k in range(2, top + 1):
            number, context, grams = numbers[k - 1], contexts[k - 1], len(counts[k - 1])
            ctx, last, below = (np.zeros(grams, np.int64) for _ in range(3))
            occurs = np.zeros(grams, bool)
            ctx[number], last[number], below[number], occurs[number] = context, numbers[0], numbers[k - 2], True
            held = counts[k - 2] + mu
            fails = np.log10(mu / held)
            level = slice(base[k - 1], base[k])
            self.failure[level] = fails
            if k > 2:  # contexts that occur as grams, and the one of start marks
                self.shorter[base[k - 1] + numbers[k - 2]] = base[k - 2] + numbers[k - 3]
                marks = np.ones(len(counts[k - 2]), bool)
                marks[numbers[k - 2]] = False
                self.shorter[base[k - 1] + np.flatnonzero(marks)] = base[k - 2] + contexts[k - 2][0]
            seen = counts[k - 1] > 0
            weight = np.where(seen, np.log10((counts[k - 1] + mu * 10.0 ** lower[below]) / held[ctx]), fails[ctx] + lower[below])
            arc = np.flatnonzero(seen & occurs)
            keys.append((base[k - 1] + ctx[arc]) * self.tokens + last[arc])
            weights.append(weight[arc])
            targets.append(base[k] + arc if k < top else base[k - 1] + below[arc])
            lower = weight
        keys = np.concatenate(keys)
        order = np.argsort(keys)
        self.arc_keys = keys[order]
        self.weights, self.targets = np.concatenate(weights)[order], np.concatenate(targets)[order]
        self.start = base[top - 1] + contexts[top - 1][0] if top > 1 else 0

    def traverse(self, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(model, unigram) log10 probability of each text: one walk from left to right, the
        texts of the block side by side. Each text carries its state: it takes the token's arc to
        the next state where there is one, else the failure arc to a shorter context, and tries
        again; the weights of all arcs taken add up."""
        starts = np.cumsum(sizes) - sizes
        longest = np.argsort(-sizes, kind="stable")
        score, base = np.zeros(len(sizes)), np.zeros(len(sizes))
        state = np.full(len(sizes), self.start, np.int64)
        for step in range(int(sizes.max()) if len(sizes) else 0):
            todo = longest[:np.searchsorted(-sizes[longest], -step, side="left")]
            token = self.stream[starts[todo] + step]
            base[todo] += self.unigram[token]
            while len(todo):
                key = state[todo] * self.tokens + token
                arc = np.minimum(np.searchsorted(self.arc_keys, key), len(self.arc_keys) - 1)
                found = self.arc_keys[arc] == key
                done, arc = todo[found], arc[found]
                score[done] += self.weights[arc]
                state[done] = self.targets[arc]
                todo, token = todo[~found], token[~found]
                score[todo] += self.failure[state[todo]]
                state[todo] = self.shorter[state[todo]]
        return score, base


def _score_block(rows: list[dict], order: int, n: int, v: int, mu: float, kind: pa.DataType) -> pa.RecordBatch:
    """Scores of one block from its stream row and the answers to it."""
    stream, answers = rows[0], rows[1:]
    sizes = _unpack_numbers(stream["sizes"], "i8")
    numbers = [_unpack_numbers(b, "u4").astype(np.int64) for b in stream["numbers"]]
    counts = []
    for k in range(1, order + 1):
        mine = sorted((r for r in answers if r["k"] == k), key=lambda r: r["shard"])
        check = 0
        for r in mine:
            check ^= r["check"]
        if check != stream["checks"][k - 1]:
            raise ValueError("the documents changed between the two passes: store them as a table first")
        counts.append(np.concatenate([_unpack_numbers(r["totals"], "u8") for r in mine]).astype(np.float64))
    starts = np.cumsum(sizes) - sizes
    contexts = [np.zeros(0, np.int64)]
    for k in range(2, order + 1):
        context = np.roll(numbers[k - 2], 1)
        # the first token's context is the start marks: the one number no token has
        free = np.ones(len(counts[k - 2]), bool)
        free[numbers[k - 2]] = False
        context[starts] = int(np.flatnonzero(free)[0])
        contexts.append(context)
    score, base = Automaton(numbers, counts, contexts, n, v, mu).traverse(sizes)
    known = np.add.reduceat((counts[0][numbers[0]] > 0).astype(np.int64), starts)
    return pa.RecordBatch.from_pydict({"doc_id": pa.array(stream["ids"], kind), "n_tokens": sizes, "n_known": known,
                                       "base_score": base, "score": score})


def score(docs: DataFrame, training, order: int = ORDER, mu: float = CONCENTRATION, shards: int | None = None,
          text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row per document: doc_id, n_tokens, n_known, train_tokens, base_score, score.
    ``training``: column of the id -> boolean column, true for the documents to learn from."""
    if order < 1:
        raise ValueError("order must be at least 1")
    default = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    size = docs.agg(F.coalesce(F.sum(F.octet_length(f"`{text_col}`") + 1), F.lit(0))).first()[0]
    block_bytes = max(BLOCK_BYTES, size // MAX_BLOCKS)
    shards = shards or size // max(SHARD_BYTES, block_bytes) + 1
    rows = _source(docs, training, text_col, id_col)
    answers = totals(gram_counts(rows, order, shards, block_bytes), max(order * shards, default))
    n, v = answers.filter("k = 1").agg(F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.sum("types"), F.lit(0))).first()
    stream = streams(rows, order, block_bytes)
    own, reply = ["sizes", "numbers", "checks", "ids"], ["totals", "check"]
    both = (stream.select("block", F.lit(0).alias("k"), F.lit(-1).alias("shard"), *own,
                          *[F.lit(None).cast(answers.schema[c].dataType).alias(c) for c in reply])
            .unionByName(answers.select("block", "k", "shard", *reply,
                                        *[F.lit(None).cast(stream.schema[c].dataType).alias(c) for c in own])))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for batch in batches:
            ids = batch.schema.field("ids").type.value_type
            for row in batch.to_pylist():
                if held and row["block"] != held[0]["block"]:
                    yield _score_block(held, order, n, v, mu, ids)
                    held = []
                held.append(row)
        if held:
            yield _score_block(held, order, n, v, mu, ids)

    kind = rows.schema["doc_id"].dataType.simpleString()
    scored = both.repartition(max(size // block_bytes + 1, default), "block").sortWithinPartitions("block", "k", "shard").mapInArrow(
        run, f"doc_id {kind}, n_tokens long, n_known long, base_score double, score double")
    return scored.select("doc_id", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), "base_score", "score")
