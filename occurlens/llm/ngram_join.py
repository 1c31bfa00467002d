"""N-gram Jaccard self-join by MinHash banding, verified on full n-gram sets.

Method. Words ``[^\\x20\\x09-\\x0D]+`` (ASCII-lowered) give each text its set of
word n-grams (a text of fewer words is one n-gram). Texts with equal sets form one
copy class, represented once. Band and row counts are chosen from the threshold
and a target recall at the threshold (``choose_bands``); representatives are
shuffled on band hashes and linked to the smallest member of each bucket, which
gives candidate groups that contain every colliding pair. Every pair inside a
candidate group is then verified on the full n-gram sets, in blocks of bounded
size: members are classed by the logarithm of their set's size, so that a pair at the
threshold lies in one class or in two adjacent ones, classes are cut into chunks, and every two
chunks of one class or of adjacent classes meet in a task of their own. Blocks return a link count and a local root per text, never pairs.

Result: per document its class (smallest doc_id of its connected component of
links, copies included) and its number of links (other n-gram sets with
Jaccard >= threshold).

Defined cases: null, empty and wordless texts have no n-gram and link with
nothing (class: themselves); a null doc_id counts as larger than any other when a
class is named or a keeper chosen; repeated rows are copies; an empty table gives
an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (LOWER, WORD_SLICE_BYTES, Texts, Words, bound_batches, list_array, mix, sequence_hash, signed, split_by, text_of,
                     text_slices, with_row_id, written)
from .components import components, with_lowest

N = 5
THRESHOLD = 0.8
RECALL = 0.9999
MAX_HASHES = 128
CHUNK_TEXTS = 256       # texts and n-grams that one side of a verification block may hold
CHUNK_GRAMS = 400_000
CHUNK_STRIDE = 1 << 40  # chunk numbers of one class lie below the next class's
CELLS = 1 << 24         # incidence cells multiplied at a time


def choose_bands(threshold: float = THRESHOLD, recall: float = RECALL, max_hashes: int = MAX_HASHES) -> tuple[int, int]:
    """(bands, rows): the most rows per band (fewest false candidates) for which
    a pair at the threshold still collides with probability ``recall`` and the
    signature stays within ``max_hashes``."""
    best = None
    for rows in range(1, max_hashes + 1):
        p = threshold ** rows
        bands = 1 if p >= 1 else math.ceil(math.log(1 - recall) / math.log(1 - p))
        if bands * rows > max_hashes:
            break
        best = bands, rows
    if best is None:
        raise ValueError("max_hashes is too small for this threshold and recall")
    return best


def gram_sets(texts: Texts, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-gram hashes of each text, texts in order, and their counts."""
    words = Words(texts, LOWER)
    at, grams = words.grams(n)
    doc = words.doc[at]
    for size in range(1, n):  # shorter texts: one n-gram of all their words
        short = np.flatnonzero(words.counts == size)
        if len(short):
            whole = sequence_hash(words.hashes, size)[words.first[short]]
            doc, grams = np.concatenate((doc, short)), np.concatenate((grams, whole))
    key = mix(grams + doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    first = np.unique(key, return_index=True)[1]
    first = first[np.argsort(doc[first], kind="stable")]
    return grams[first], np.bincount(doc[first], minlength=texts.n)


def _signatures(grams: np.ndarray, counts: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """Band hashes (texts with n-grams x bands)."""
    rng = np.random.Generator(np.random.PCG64(7))
    a = rng.integers(0, 2**63, bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    b = rng.integers(0, 2**63, bands * rows, dtype=np.uint64)
    starts = (np.cumsum(counts) - counts)[counts > 0]
    out = np.empty((len(starts), bands), np.uint64)
    if not len(starts):
        return out
    for band in range(bands):
        h = np.full(len(starts), band + 1, np.uint64)
        for i in range(band * rows, band * rows + rows):
            low = np.minimum.reduceat((grams * a[i] + b[i]) >> np.uint64(16), starts)
            h = mix(h * np.uint64(0x9E3779B97F4A7C15) + low)
        out[:, band] = h
    return out


def sketch(docs: DataFrame, n: int, bands: int, rows: int, text_col: str, id_col: str) -> DataFrame:
    """(row_id, doc_id, doc, n_grams, set_key, bands) per row, as a table."""
    bound_batches(docs.sparkSession)
    rowed = with_row_id(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, f"doc.{text_col}", WORD_SLICE_BYTES):
            texts = Texts(text_of(part, f"doc.{text_col}"))
            grams, counts = gram_sets(texts, n)
            total = np.concatenate(([np.uint64(0)], np.cumsum(mix(grams), dtype=np.uint64)))
            ends = np.cumsum(counts)
            key = mix(total[ends] - total[ends - counts] + counts.astype(np.uint64))
            sig = _signatures(grams, counts, bands, rows)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc"), part.column("row_id"), pa.array(counts.astype(np.int32)), pa.array(signed(key)),
                 list_array(signed(sig.ravel()), np.where(counts > 0, bands, 0))],
                names=["doc", "row_id", "n_grams", "set_key", "bands"])

    out = rowed.mapInArrow(run, f"doc {rowed.schema['doc'].dataType.simpleString()}, row_id long, n_grams int,"
                                " set_key long, bands array<long>")
    return written(out.withColumn("doc_id", F.col(f"doc.`{id_col}`")), "sketch")


def _links(sets: list[np.ndarray], side: np.ndarray, across: bool, threshold: float) -> np.ndarray:
    """Boolean matrix of linked texts. ``side``: chunk of each text; if ``across``, only
    pairs of different chunks count."""
    sizes = np.array([len(s) for s in sets])
    values = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, column, count = np.unique(values, return_inverse=True, return_counts=True)
    number = np.cumsum(count > 1) - 1
    shared = count[column] > 1
    column, owner = number[column[shared]], owner[shared]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    width = max(1, CELLS // len(sets))
    common = np.zeros((len(sets), len(sets)), np.float32)
    for lo in range(0, int(number[-1]) + 1 if len(number) else 0, width):
        a, b = np.searchsorted(column, [lo, lo + width])
        block = np.zeros((len(sets), min(width, int(number[-1]) + 1 - lo)), np.float32)
        block[owner[a:b], column[a:b] - lo] = 1
        common += block @ block.T
    linked = common >= threshold * (sizes[:, None] + sizes[None, :] - common) - 1e-6
    if across:
        linked &= side[:, None] != side[None, :]
    np.fill_diagonal(linked, False)
    return linked


def _roots(linked: np.ndarray) -> np.ndarray:
    """Smallest index reachable over links, per text."""
    label = np.arange(len(linked))
    while True:
        low = np.minimum(label, np.where(linked, label[None, :], len(label)).min(axis=1))
        low = low[low]
        if (low == label).all():
            return label
        label = low


def _verify(batches: Iterator[pa.RecordBatch], n: int, threshold: float) -> Iterator[pa.RecordBatch]:
    """Rows sorted by block (grp, a, b) -> (node, links, root) per row. A block of two
    chunks (a <> b) is for the pairs across, also when one chunk has no member: the
    pairs inside a chunk are those of block (a, a)."""
    held: list[tuple[int, int, np.ndarray]] = []
    current = None

    def close() -> pa.RecordBatch | None:
        across = current is not None and current[1] != current[2]
        if len(held) < 2 or across and len({x[1] for x in held}) < 2:
            return None
        held.sort(key=lambda x: x[0])
        node = np.array([x[0] for x in held])
        linked = _links([x[2] for x in held], np.array([x[1] for x in held]), across, threshold)
        return pa.RecordBatch.from_arrays([pa.array(node), pa.array(linked.sum(axis=1).astype(np.int64)),
                                           pa.array(node[_roots(linked)])], names=["node", "links", "root"])

    for part in text_slices(batches):
        grams, counts = gram_sets(Texts(part.column("text")), n)
        ends = np.cumsum(counts)
        keys = zip(*[part.column(c).to_pylist() for c in ("grp", "a", "b")])
        nodes, sides = part.column("node").to_pylist(), part.column("side").to_pylist()
        for i, key in enumerate(keys):
            if key != current:
                if (out := close()) is not None:
                    yield out
                held, current = [], key
            held.append((nodes[i], sides[i], grams[ends[i] - counts[i]:ends[i]]))
    if (out := close()) is not None:
        yield out


def link_classes(sketched: DataFrame, n: int = N, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """(set_key, n_grams, rep, links, root): per copy class its representative row,
    its number of links and the smallest representative of its component."""
    reps = written(sketched.filter("n_grams > 0").groupBy("set_key", "n_grams")
                   .agg(F.min("row_id").alias("rep"), F.min_by("bands", "row_id").alias("bands")), "classes")
    buckets = reps.select(F.explode("bands").alias("u"), F.col("rep").alias("v"))
    shared = buckets.groupBy("u").agg(F.min("v").alias("m"), F.max("v").alias("top")).filter("m < top").select("u")
    _, shared = split_by(buckets, shared, ["u"])  # most buckets have one text: those rows are not shuffled again
    groups = components(with_lowest(shared).filter("m <> v").select(F.col("m").alias("u"), "v"))

    members = written(groups.join(reps.select("rep", "n_grams"), F.col("node") == F.col("rep"))
                      .select("node", F.col("root").alias("grp"), "n_grams"), "grouped")
    # |A| <= |B| at the threshold means |A| >= threshold * |B|: the logarithms to a base just above
    # 1 / threshold differ by less than 1, so the classes by at most 1. No link is outside. A group
    # that fits into one block is one class.
    pieces = F.ceil(F.greatest(F.count(F.lit(1)) / CHUNK_TEXTS, F.sum("n_grams") / CHUNK_GRAMS)).cast("int").alias("parts")
    cls = F.floor(F.log(F.col("n_grams")) / math.log((1 / threshold) * (1 + 1e-9))).cast("int") if threshold < 1 else F.col("n_grams")
    whole = members.groupBy("grp").agg(pieces).select("grp", (F.col("parts") == 1).alias("whole"))
    members = written(members.join(whole, "grp").withColumn("cls", F.when(F.col("whole"), 0).otherwise(cls)).drop("whole"), "members")
    chunks = written(members.groupBy("grp", "cls").agg(pieces, F.count(F.lit(1)).alias("n")), "chunks")
    number = lambda c, part: c.cast("long") * CHUNK_STRIDE + part
    here = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda i: number(F.col("cls"), i))
    met = (chunks.select("grp", "n", here.alias("here"), F.explode(F.array(F.col("cls") - 1, F.col("cls"), F.col("cls") + 1)).alias("to"), "cls")
           .filter("to <> cls or n > 1").groupBy("grp", F.col("to").alias("cls")).agg(F.flatten(F.collect_list("here")).alias("others")))
    plan = chunks.select("grp", "cls", "parts").join(met, ["grp", "cls"])
    texts = sketched.select("row_id", F.col(f"doc.`{text_col}`").alias("text"))
    _, texts = split_by(texts, members.withColumnRenamed("node", "row_id"), ["row_id"])  # the rest is not shuffled
    side = number(F.col("cls"), F.pmod(F.xxhash64("node"), F.col("parts")))
    # Only members of groups are replicated, and only over the chunks of their class and its neighbours.
    # Members grow with the corpus, so this join is a sort-merge join at every size.
    blocks = (members.join(plan, ["grp", "cls"]).withColumn("side", side)
              .join(texts.hint("merge"), F.col("row_id") == F.col("node"))
              .withColumn("other", F.explode("others"))
              .select("grp", F.least("side", "other").alias("a"), F.greatest("side", "other").alias("b"),
                      "node", "side", "text"))
    checked = written(
        blocks.repartition("grp", "a", "b").sortWithinPartitions("grp", "a", "b")
        .mapInArrow(lambda it: _verify(it, n, threshold), "node long, links long, root long"), "verified")
    linked = checked.filter("links > 0")
    # a chunk pair's block marks only pairs across; each pair is counted in exactly one block
    counts = linked.groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(linked.select(F.col("node").alias("u"), F.col("root").alias("v"))).withColumnRenamed("node", "n2")
    found = counts.join(roots, F.col("node") == F.col("n2")).select("node", "links", "root")
    return (reps.select("set_key", "n_grams", "rep").join(found, F.col("rep") == F.col("node"), "left")
            .select("set_key", "n_grams", "rep", F.coalesce("links", F.lit(0)).cast("long").alias("links"),
                    F.coalesce("root", "rep").alias("root")))


def _classed(docs: DataFrame, n: int, threshold: float, recall: float, max_hashes: int, text_col: str,
             id_col: str) -> tuple[DataFrame, DataFrame]:
    """(row_id, doc_id, links, root) per row (null root where the text has no n-gram),
    and the sketched rows."""
    bands, rows = choose_bands(threshold, recall, max_hashes)
    sketched = sketch(docs, n, bands, rows, text_col, id_col)
    classes = link_classes(sketched, n, threshold, text_col).drop("rep")
    keys = sketched.select("row_id", "doc_id", "set_key", "n_grams")
    return written(keys.join(classes, ["set_key", "n_grams"], "left").drop("set_key", "n_grams"), "classed"), sketched


def jaccard_join(docs: DataFrame, n: int = N, threshold: float = THRESHOLD, recall: float = RECALL,
                 max_hashes: int = MAX_HASHES, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row per document: doc_id, class_id, n_links."""
    rows, _ = _classed(docs.select(id_col, text_col), n, threshold, recall, max_hashes, text_col, id_col)
    names = written(rows.filter("root is not null").groupBy(F.col("root").alias("r"))
                    .agg(F.min("doc_id").alias("class_id")), "names")
    return (rows.join(names, F.col("root") == F.col("r"), "left")
            .select("doc_id", F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
                    F.coalesce("links", F.lit(0)).cast("long").alias("n_links")))


def keep_one(docs: DataFrame, n: int = N, threshold: float = THRESHOLD, recall: float = RECALL,
             max_hashes: int = MAX_HASHES, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """The input rows with one document of each class kept: the smallest doc_id."""
    rows, sketched = _classed(docs, n, threshold, recall, max_hashes, text_col, id_col)
    order = F.struct(F.col("doc_id").isNull().alias("null_last"), "doc_id", "row_id")
    keeper = written(rows.filter("root is not null").groupBy(F.col("root").alias("r"))
                     .agg(F.min(order)["row_id"].alias("keep")), "keepers")
    # Only the rows that go are looked up against the texts.
    gone = written(rows.join(keeper, F.col("root") == F.col("r")).filter("keep <> row_id").select("row_id"), "gone")
    apart, maybe = split_by(sketched.select("row_id", "doc"), gone, ["row_id"])
    kept = apart.unionByName(maybe.join(gone.hint("merge"), "row_id", "left_anti"))
    return kept.select(*[F.col(f"doc.`{c}`").alias(c) for c in docs.columns])
