"""Benchmark decontamination by a prefix-filtered set join.

A *window* is ``size`` consecutive words of a benchmark item; an item of fewer words (but not
none) is one window. A window is the set of its shingles of up to ``SHINGLE`` words, ordered by
rarity in the corpus. A text that contains the window contains all its shingles, so the necessary
prefix of that order is one shingle, the rarest. The corpus is joined on prefix shingles only;
the shingle's place gives the one place where the window could start, length and position bounds
drop what cannot fit, and the words themselves are compared.

The corpus is read twice: to count the benchmark's shingles over all texts, and to look for the
prefixes. Both passes hold only a bitmap of fixed size.

Defined results: a null or empty text has no words and is never hit; benchmark items without text
take no part; the windows of an item without an id are hits, but no id stands for them among the items; repeated rows of either side count each for itself (items with the
same id once); other columns of the inputs are ignored. With an empty benchmark nothing is hit.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerloom.llm.common import Bitmap, map_texts, ragged, row_numbers, written
from ledgerloom.llm.words import ALNUM, Hasher, chunks, encoded, grams
from ledgerloom.operators.skew import lookup

SIZE = 10       # words of a window
SHINGLE = 3     # words of a shingle
LIST = 64       # windows of one row of the prefix table


def benchmark_windows(benchmark: DataFrame, size: int, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """Rows (item, words, n, shingles): every distinct window of every item."""
    hasher = Hasher(ALNUM)

    def per_batch(batch: pa.RecordBatch):
        items, texts = batch.column(0).to_pylist(), encoded(batch.column(1))
        for low, part in chunks(texts):
            words = hasher(part)
            out = {"item": [], "words": [], "n": [], "shingles": []}
            for i in range(len(part)):
                a, b = words.first[i], words.first[i + 1]
                n = min(size, b - a)
                if n == 0:
                    continue
                spelt, k = words.text(a, b), min(SHINGLE, n)
                shingles = grams(words.hash[a:b], k).view(np.int64)
                for s in range(b - a - n + 1):
                    out["item"].append(items[low + i])
                    out["words"].append(b" ".join(spelt[s:s + n]).decode())
                    out["n"].append(int(n))
                    out["shingles"].append(shingles[s:s + n - k + 1])
            yield out

    rows = benchmark.select(F.col(f"`{item_id}`").cast("string").alias("item"), F.col(f"`{text}`").alias("text"))
    return map_texts(rows.where("text is not null"), per_batch,
                     "item string, words string, n int, shingles array<long>").distinct()


def shingle_counts(docs: DataFrame, wanted: Bitmap, sizes: list[int], text: str = "text") -> DataFrame:
    """(shingle, count) over all texts, for the shingles that pass ``wanted``; pre-summed in the tasks."""
    hasher = Hasher(ALNUM)

    def per_batch(batch: pa.RecordBatch):
        found = []
        for _, part in chunks(encoded(batch.column(0))):
            words = hasher(part)
            text_of = np.repeat(np.arange(len(part)), np.diff(words.first))
            for k in sizes:
                h = grams(words.hash, k)
                same = text_of[:len(h)] == text_of[k - 1:]
                found.append(h[wanted(h) & same])
        values, counts = np.unique(np.concatenate(found), return_counts=True)
        yield {"shingle": values.view(np.int64), "count": counts}

    rows = map_texts(docs.select(F.col(f"`{text}`")), per_batch, "shingle long, count long")
    return rows.groupBy("shingle").agg(F.sum("count").alias("count"))


def prefix_table(windows: DataFrame, counts: DataFrame) -> DataFrame:
    """(shingle, [windows]): each window under its rarest shingle, in lists of about ``LIST``.

    A window carries ``owner``, which stands for the set of items that have it.
    """
    distinct = windows.groupBy("words").agg(
        F.first("n").alias("n"), F.first("shingles").alias("shingles"), owner_of("item").alias("owner"))
    placed = distinct.select("words", "n", "owner", F.posexplode("shingles").alias("offset", "shingle"))
    rare = placed.join(counts, "shingle", "left").groupBy("words").agg(
        F.min(F.struct(F.coalesce("count", F.lit(0)), "shingle", "offset")).alias("p"),
        F.first("n").alias("n"), F.first("owner").alias("owner"))
    keyed = rare.select("words", "n", "owner", "p.shingle", "p.offset")
    sizes = keyed.groupBy("shingle").agg(F.ceil(F.count(F.lit(1)) / LIST).alias("lists"))
    return (keyed.join(sizes, "shingle")
            .groupBy("shingle", F.expr("pmod(xxhash64(words), lists)").alias("list"))
            .agg(F.collect_list(F.struct("words", "n", "offset", "owner")).alias("windows")).drop("list"))


def owner_of(item: str):
    """A value that stands for a set of distinct items, summed without collecting them."""
    a, b = F.xxhash64(item), F.xxhash64(F.lit("second"), item)
    return F.concat_ws(":", F.count(F.lit(1)), F.sum(a.cast("decimal(20,0)")), F.bit_xor(b))


def owners(windows: DataFrame) -> DataFrame:
    """(owner, item): the items of each owner value, taken from one window that has it."""
    named = windows.groupBy("words").agg(owner_of("item").alias("owner"))
    one = named.groupBy("owner").agg(F.min("words").alias("words"))
    return windows.join(one, "words").select("owner", "item")


def candidates(docs: DataFrame, prefixes: Bitmap, sizes: list[int], size: int, doc_id: str = "doc_id",
               text: str = "text") -> DataFrame:
    """One row per text: row number, id, number of words, and the places of possible prefixes with
    the words around them (``lead`` of them before the place)."""
    hasher, numbers = Hasher(ALNUM), []

    def per_batch(batch: pa.RecordBatch):
        if not numbers:
            numbers.append(row_numbers())
        ids, texts = batch.column(0), encoded(batch.column(1))
        for low, part in chunks(texts):
            words = hasher(part)
            text_of = np.repeat(np.arange(len(part)), np.diff(words.first))
            at, value = [], []
            for k in sizes:
                h = grams(words.hash, k)
                hit = np.flatnonzero(prefixes(h) & (text_of[:len(h)] == text_of[k - 1:]))
                at.append(hit)
                value.append(h[hit])
            at, value = np.concatenate(at), np.concatenate(value)
            order = np.argsort(at, kind="stable")
            at, value = at[order], value[order]
            doc = text_of[at]
            begin = np.maximum(at - size + 1, words.first[doc])
            end = np.minimum(at + size, words.first[doc + 1])
            around = [b" ".join(words.text(a, b)).decode() for a, b in zip(begin, end)]
            per_doc = np.bincount(doc, minlength=len(part))
            yield {"row": [next(numbers[0]) for _ in part], "doc_id": ids.slice(low, len(part)),
                   "n_words": np.diff(words.first),
                   "shingle": ragged(value.view(np.int64), per_doc, pa.int64()),
                   "place": ragged(at - words.first[doc], per_doc, pa.int32()),
                   "lead": ragged(at - begin, per_doc, pa.int32()),
                   "around": ragged(around, per_doc, pa.string())}

    kind = docs.schema[doc_id].dataType.simpleString()
    return map_texts(docs.select(F.col(f"`{doc_id}`"), F.col(f"`{text}`")), per_batch,
                     f"row long, doc_id {kind}, n_words long, shingle array<long>, place array<int>, lead array<int>, around array<string>")


def contained(docs: DataFrame, benchmark: DataFrame, size: int = SIZE, bits: int = 24,
              doc_id: str = "doc_id") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(texts, hits, owners).

    ``texts``: row, doc_id, n_words for every row of ``docs``. ``hits``: row, start, n, owner for
    every verified place of a window. ``owners``: owner, item.
    """
    windows = written(benchmark_windows(benchmark, size), "windows")
    sizes = sorted(r[0] for r in windows.select(F.least("n", F.lit(SHINGLE))).distinct().collect()) or [SHINGLE]
    tokens = windows.select(F.explode("shingles").alias("shingle")).distinct()
    counts = shingle_counts(docs, Bitmap.of(tokens, "shingle", bits), sizes)
    prefixes = written(prefix_table(windows, counts), "prefixes")
    texts = written(candidates(docs, Bitmap.of(prefixes.select("shingle"), "shingle", bits), sizes, size, doc_id), "texts")
    places = texts.where(F.size("shingle") > 0).select(
        "row", "n_words", F.explode(F.arrays_zip("shingle", "place", "lead", "around")).alias("c")
    ).select("row", "n_words", "c.*")
    met = lookup(places, prefixes, ["shingle"], "inner")

    def fits(w):
        begin = F.col("place") - w["offset"]
        return F.when((begin >= 0) & (begin + w["n"] <= F.col("n_words")),
                      F.array_join(F.slice("spelt", F.col("lead") - w["offset"] + 1, w["n"]), " ") == w["words"])

    hits = (met.withColumn("spelt", F.split("around", " ")).withColumn("w", F.filter("windows", fits))
            .select("row", F.transform("w", lambda w: F.struct(
                (F.col("place") - w["offset"]).alias("start"), w["n"].alias("n"), w["owner"].alias("owner"))).alias("hits"))
            .where(F.size("hits") > 0))
    return texts.select("row", "doc_id", "n_words"), hits, owners(windows)


def decontaminate(docs: DataFrame, benchmark: DataFrame, size: int = SIZE, bits: int = 24) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_hit (words inside a window), items (sorted ids)."""
    texts, hits, owner_items = contained(docs, benchmark, size, bits)
    per_row = hits.groupBy("row").agg(F.array_distinct(F.flatten(F.collect_list("hits"))).alias("hits"))
    per_row = written(per_row.select(
        "row", F.size(F.array_distinct(F.flatten(F.transform("hits", lambda h: F.sequence(h["start"], h["start"] + h["n"] - 1)))))
        .cast("long").alias("n_hit"), F.array_distinct(F.transform("hits", lambda h: h["owner"])).alias("owners")), "hit_rows")
    items = lookup(per_row.select("row", F.explode("owners").alias("owner")), owner_items, ["owner"], "inner")
    items = items.groupBy("row").agg(F.sort_array(F.collect_set("item")).alias("items"))
    return (texts.join(per_row.drop("owners"), "row", "left").join(items, "row", "left")
            .select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                    F.coalesce("items", F.array().cast("array<string>")).alias("items")))


def contaminated(docs: DataFrame, benchmark: DataFrame, size: int = SIZE, bits: int = 24, doc_id: str = "doc_id") -> DataFrame:
    """(doc_id,) of the rows that hold a window of a benchmark item."""
    texts, hits, _ = contained(docs, benchmark, size, bits, doc_id)
    return texts.join(hits.select("row").distinct(), "row", "left_semi").select("doc_id")
