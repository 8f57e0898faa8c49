"""Near-duplicate groups by HyperMinHash sketches, banding and exact verification.

1. Each text becomes the set of its distinct word shingles. Every shingle is hashed once; the hash
   names one of ``registers`` buckets, and a bucket keeps its smallest value in compressed form:
   the count of leading zeros and ``MANTISSA`` further bits.
2. Texts with equal sets form a class with one representative, found by a 128-bit fingerprint of the set.
3. Bands of compressed registers are hashed; representatives that agree in a band meet in a bucket.
   Empty registers borrow from a full one in a fixed random order, so short texts are banded as well.
4. A bucket is cut into blocks of bounded size, and pairs of blocks are compared in tasks of their own.
   There the Jaccard similarity of two sketches is estimated, less the matches that chance makes
   between compressed registers; pairs that may reach the threshold (five standard deviations of
   tolerance) are verified on their full sets. Pairs that are already connected need no further check, so
   a task returns at most one link a member: no list of pairs is ever made.
5. Links are contracted to components in rounds of joins.

A pair at the threshold is missed by all bands with a probability below 1e-6 (24 bands of 5 at the default
similarity of 0.85, 40 at 0.80; ``bands_for`` gives the number), and less above it.

Defined results: null texts and texts without words have an empty set, belong to no link and form a
component of their own; fewer words than a shingle make one shingle; equal rows are linked like other
copies, and of a component the row with the smallest id (null last, then any fixed one) is kept.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerloom.llm.common import Bitmap, map_texts, ragged, row_numbers, written
from ledgerloom.llm.components import components
from ledgerloom.llm.words import SPACED, U64, Hasher, chunks, encoded, grams, mix
from ledgerloom.operators.skew import lookup

WORDS = 5
BANDS, ROWS = 24, 5            # for similarities from 0.85 on
MISSED = 1.5e-7                # below 0.85: chance of a miss that ``bands_for`` aims at; borrowed values of short texts add to it
MANTISSA = 10
BLOCK_SHINGLES = 1_500_000     # shingles of one block of a bucket: bounds the memory of a task
CHANCE = 0.6768                # chance of equal compressed minima of sizes n, m: CHANCE * n m / (n + m)**2 / 2**MANTISSA
EMPTY = np.uint16(0xFFFF)


def bands_for(percent: int, rows: int = ROWS) -> int:
    """The number of bands that a threshold needs."""
    if percent >= 85 and rows == ROWS:
        return BANDS
    return math.ceil(math.log(MISSED) / math.log1p(-(min(percent, 99) / 100) ** rows))


def shingle_sets(texts: list[bytes], hasher: Hasher, k: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    for _, part in chunks(texts):
        words = hasher(part)
        for a, b in zip(words.first[:-1], words.first[1:]):
            yield np.unique(grams(words.hash[a:b], min(k, b - a))) if b > a else np.empty(0, U64)


def fingerprint(shingles: np.ndarray) -> tuple[int, int]:
    """128 bits that do not depend on order."""
    a = mix(shingles ^ U64(0x5851F42D4C957F2D))
    return int(a.sum(dtype=U64).view(np.int64)), int(np.bitwise_xor.reduce(mix(a), initial=U64(0)).view(np.int64))


def sketch(shingles: np.ndarray, registers: int) -> np.ndarray:
    """Compressed minimum of every bucket: leading zeros, then mantissa bits; ``EMPTY`` if it has none."""
    out = np.full(registers, EMPTY, dtype=np.uint16)
    value = mix(shingles ^ U64(0xD1342543DE82EF95))
    value.sort()
    value = value[::-1]                      # the last write to a bucket is its smallest value
    fraction, power = np.frexp((value >> U64(11)).astype(np.float64))
    packed = ((53 - power) << MANTISSA) | ((fraction * 2 - 1) * (1 << MANTISSA)).astype(np.int64)
    out[(value % U64(registers)).astype(np.int64)] = packed.astype(np.uint16)
    return out


def donors(registers: int) -> np.ndarray:
    """For each bucket, the order in which it asks others for a value."""
    rng = np.random.default_rng(20)
    return np.stack([rng.permutation(registers) for _ in range(registers)])


def band_keys(registers: np.ndarray, order: np.ndarray, bands: int, rows: int) -> np.ndarray:
    filled = registers.copy()
    full = registers != EMPTY
    gaps = np.flatnonzero(~full)
    if len(gaps):
        asked = order[gaps]
        filled[gaps] = registers[asked[np.arange(len(gaps)), full[asked].argmax(axis=1)]]
    part = filled.reshape(bands, rows).astype(U64)
    key = mix(np.arange(1, bands + 1, dtype=U64))
    for i in range(rows):
        key = mix(key ^ part[:, i])
    return key


def sketches(docs: DataFrame, k: int, bands: int, rows: int, doc_id: str, text: str) -> DataFrame:
    """Per row: number, id, size and fingerprint of its set, band keys."""
    hasher, order, numbers = Hasher(SPACED), donors(bands * rows), []

    def per_batch(batch: pa.RecordBatch):
        if not numbers:
            numbers.append(row_numbers())
        size, first, second, keys = [], [], [], []
        for shingles in shingle_sets(encoded(batch.column(1)), hasher, k):
            a, b = fingerprint(shingles)
            size.append(len(shingles))
            first.append(a)
            second.append(b)
            keys.append(band_keys(sketch(shingles, bands * rows), order, bands, rows) if len(shingles) else np.empty(0, U64))
        yield {"row": [next(numbers[0]) for _ in size], "doc_id": batch.column(0), "n_shingles": size, "fp": first, "fp2": second,
               "bands": ragged(np.concatenate(keys).view(np.int64), [len(x) for x in keys], pa.int64())}

    kind = docs.schema[doc_id].dataType.simpleString()
    return map_texts(docs.select(F.col(f"`{doc_id}`"), F.col(f"`{text}`")), per_batch,
                     f"row long, doc_id {kind}, n_shingles long, fp long, fp2 long, bands array<long>")


def needed_sets(docs: DataFrame, wanted: Bitmap, k: int, registers: int, text: str) -> DataFrame:
    """(fp, fp2, shingles, sketch) of the texts whose set is wanted; each set once a task."""
    hasher, given = Hasher(SPACED), set()

    def per_batch(batch: pa.RecordBatch):
        out = {"fp": [], "fp2": [], "shingles": [], "sketch": []}
        for shingles in shingle_sets(encoded(batch.column(0)), hasher, k):
            a, b = fingerprint(shingles)
            if len(shingles) and (a, b) not in given and wanted(np.array([a]).view(U64))[0]:
                given.add((a, b))
                out["fp"].append(a)
                out["fp2"].append(b)
                out["shingles"].append(shingles.tobytes())
                out["sketch"].append(sketch(shingles, registers).tobytes())
        yield out

    return map_texts(docs.select(F.col(f"`{text}`")), per_batch, "fp long, fp2 long, shingles binary, sketch binary")


def estimate(one: np.ndarray, size: int, many: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Collision-corrected Jaccard similarity of one sketch to many, and its number of usable registers."""
    equal = ((many == one) & (one != EMPTY)).sum(axis=1)
    used = ((many != EMPTY) | (one != EMPTY)).sum(axis=1)
    chance = CHANCE / (1 << MANTISSA) * size * sizes / (size + sizes) ** 2.0
    return (equal / used - chance) / (1 - chance), used


def links_of(ids: list[int], sets: list[np.ndarray], regs: np.ndarray, block: np.ndarray, percent: int,
             across: bool) -> list[tuple[int, int]]:
    """A spanning forest of the links among the members of one block, or between two (``across``)."""
    n = len(ids)
    sizes = np.array([len(s) for s in sets])
    flat, start = np.concatenate(sets), np.concatenate([[0], np.cumsum(sizes)])
    _, local = np.unique(flat, return_inverse=True)
    flag = np.zeros(int(local.max()) + 1, dtype=bool)
    root = np.arange(n)
    threshold = percent / 100
    out = []
    for i in range(n):
        open_ = (root != root[i]) & (100 * np.minimum(sizes, sizes[i]) >= percent * np.maximum(sizes, sizes[i]))
        open_ &= (block != block[i]) & (block > block[i]) if across else np.arange(n) > i
        other = np.flatnonzero(open_)
        if not len(other):
            continue
        similar, used = estimate(regs[i], sizes[i], regs[other], sizes[other])
        other = other[similar >= threshold - 5 * np.sqrt(threshold * (1 - threshold) / used)]
        if not len(other):
            continue
        own = local[start[i]:start[i + 1]]
        flag[own] = True
        length = sizes[other]
        at = np.repeat(start[other] - np.concatenate([[0], np.cumsum(length)[:-1]]), length) + np.arange(length.sum())
        common = np.add.reduceat(flag[local[at]], np.concatenate([[0], np.cumsum(length)[:-1]]), dtype=np.int64)
        flag[own] = False
        for j in other[100 * common >= percent * (sizes[i] + length - common)]:
            if root[j] != root[i]:
                out.append((ids[i], ids[j]))
                root[root == root[j]] = root[i]
    return out


def verified_links(members: DataFrame, percent: int) -> DataFrame:
    """(a, b): links that connect all members that are similar, from rows (key, b1, b2, block, rep, shingles, sketch)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, held = None, []

        def done() -> pa.RecordBatch:
            ids, sets, regs, block = zip(*held)
            found = links_of(list(ids), list(sets), np.stack(regs), np.array(block), percent, task[1] != task[2])
            return pa.RecordBatch.from_pydict({"a": pa.array([x for x, _ in found], pa.int64()), "b": pa.array([y for _, y in found], pa.int64())})

        for batch in batches:
            for key, b1, b2, block, rep, shingles, regs in zip(*[c.to_pylist() for c in batch.columns]):
                if (key, b1, b2) != task:
                    if len(held) > 1:
                        yield done()
                    task, held = (key, b1, b2), []
                held.append((rep, np.frombuffer(shingles, U64), np.frombuffer(regs, np.uint16), block))
        if len(held) > 1:
            yield done()

    keys = ["key", "b1", "b2"]
    return (members.select(*keys, "block", "rep", "shingles", "sketch").repartition(*keys).sortWithinPartitions(*keys)
            .mapInArrow(run, "a long, b long"))


def near_groups(docs: DataFrame, percent: int = 85, words: int = WORDS, bands: int | None = None, rows: int = ROWS,
                block_shingles: int = BLOCK_SHINGLES, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id (smallest id of its component), kept (one row each).

    Two texts are linked if 100 * |intersection| >= percent * |union| of their shingle sets. ``bands`` follows from ``percent``.
    """
    bands = bands_for(percent, rows) if bands is None else bands
    base = written(sketches(docs, words, bands, rows, doc_id, text), "sketches")
    fp = ["fp", "fp2"]
    reps = base.where("n_shingles > 0").groupBy(*fp).agg(
        F.min("row").alias("rep"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands"))
    reps = written(reps, "classes")
    banded = reps.select("rep", "n", *fp, F.explode("bands").alias("key"))
    h = F.xxhash64("rep")
    buckets = banded.groupBy("key").agg(
        F.count(F.lit(1)).alias("members"), F.sum("n").alias("shingles"),
        F.sum(h.cast("decimal(20,0)")).alias("s"), F.bit_xor(F.xxhash64(F.lit(1), "rep")).alias("x"))
    # buckets of different bands with the same members are compared once
    buckets = buckets.where("members > 1").groupBy("members", "s", "x").agg(
        F.min("key").alias("key"), F.ceil(F.first("shingles") / block_shingles).alias("blocks"))
    members = lookup(banded, buckets.select("key", "blocks"), ["key"], "inner")
    members = written(members.withColumn("block", F.pmod(F.xxhash64("rep", F.lit(7)), F.col("blocks"))), "members")
    wanted = Bitmap.of(members.select("fp").distinct(), "fp")
    sets = needed_sets(docs, wanted, words, bands * rows, text).groupBy(*fp).agg(
        F.first("shingles").alias("shingles"), F.first("sketch").alias("sketch"))
    blocks = members.select(
        "key", "rep", *fp, "block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other")
    ).select("key", "rep", *fp, "block", F.least("block", "other").alias("b1"), F.greatest("block", "other").alias("b2"))
    links = written(verified_links(lookup(blocks, sets, fp, "inner"), percent), "links").distinct()
    labels = components(links)

    grouped = lookup(base.drop("bands"), reps.select(*fp, "rep"), fp, "left")
    grouped = written(lookup(grouped, labels.select(F.col("node").alias("rep"), "root"), ["rep"], "left").select(
        "row", "doc_id", "n_shingles", F.coalesce("root", "rep", "row").alias("component")), "grouped")
    heads = grouped.groupBy("component").agg(F.min("doc_id").alias("component_id"), F.min(
        F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row")).alias("head"))
    return lookup(grouped, heads.select("component", "component_id", F.col("head.row").alias("head")), ["component"], "left").select(
        "row", "doc_id", "n_shingles", "component_id", (F.col("row") == F.col("head")).alias("kept"))
