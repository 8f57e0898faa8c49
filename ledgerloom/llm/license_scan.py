"""License scan by diagonal voting.

All rolling word 2-grams of the corpus are looked up among the 2-grams of license templates. A match at
word ``p`` of a text and word ``t`` of a template votes for the diagonal ``p - t``, the place where
the template would start. Votes are summed by (text, template, diagonal); a neighbourhood of diagonals is
merged, which bridges words that were inserted or left out; and a span is accepted when the distinct
template 2-grams that voted cover enough of the template, with one that holds the name of the license (``NAMES`` and the
words of the label), where the template has such a word: the same notice of another license is not accepted. A base phrase must be
covered whole on one diagonal, which is the same as its words standing consecutively.

Callers may give templates of their own, of any length: those of more than ``SECTION`` words are cut into sections that are looked for
one by one. The tasks drop 2-grams that no template has before the join; templates come from the caller's memory, not
from the data (at most ``MOST_PLACES`` places), so their table is broadcast.

Defined results: a null or empty text has no words, no labels and score 0; repeated rows count each for
itself; other columns are ignored; texts of any length are scanned whole; of notices that tie at one place each gives its label; an
empty table gives no rows; a template without two words is refused.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ledgerloom.llm.common import map_texts, ragged, row_numbers, written
from ledgerloom.llm.words import ALNUM, Hasher, chunks, encoded, grams

GRAM = 2
NEAR = 2            # diagonals to either side that are merged
COVERED = 0.75      # share of a template's 2-grams that a span must have
SECTION = 64        # words: the votes of a section are the bits of one long value
MOST_PLACES = 1_000_000

# Phrases that are counted wherever their words stand consecutively, with their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Words that tell licenses with alike notices apart.
NAMES = {"apache", "mit", "mozilla", "lesser", "affero", "eclipse", "boost", "nc", "sa", "nd", "noncommercial", "sharealike", "cc0", "gpl", "lgpl",
         "agpl", "mpl", "epl", "bsl", "bsd", "isc", "unlicense"}

# Notices of common licenses, with their labels.
TEMPLATES = {
    "licensed under the apache license version 2 0": "apache-2.0",
    "released under the mit license": "mit",
    "licensed under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy of this software": "mit",
    "redistribution and use in source and binary forms with or without modification are permitted": "bsd",
    "permission to use copy modify and or distribute this software for any purpose with or without fee": "isc",
    "licensed under cc by 4 0": "cc-by",
    "licensed under cc by nc 4 0": "cc-by-nc",
    "licensed under cc by sa 4 0": "cc-by-sa",
    "licensed under cc by nd 4 0": "cc-by-nd",
    "creative commons attribution noncommercial": "cc-by-nc",
    "creative commons attribution sharealike": "cc-by-sa",
    "licensed under the gnu general public license version 3": "gpl-3.0",
    "licensed under the gnu general public license version 2": "gpl-2.0",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "subject to the terms of the mozilla public license version 2 0": "mpl-2.0",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "licensed under the terms of the apache license version 2 0": "apache-2.0",
    "licensed under the terms of the mit license": "mit",
    "distributed under the mit license": "mit",
    "under the terms of the gnu general public license as published by the free software foundation either version 3 of the license": "gpl-3.0",
    "under the terms of the gnu general public license as published by the free software foundation either version 2 of the license": "gpl-2.0",
    "redistributions in binary form must reproduce the above copyright notice": "bsd",
    "neither the name of the copyright holder nor the names of its contributors": "bsd-3-clause",
    "boost software license": "bsl-1.0",
    "eclipse public license": "epl",
    "cc0 1 0 universal": "cc0-1.0",
    "spdx license identifier mit": "mit",
    "spdx license identifier apache 2 0": "apache-2.0",
    "spdx license identifier bsd 2 clause": "bsd-2-clause",
    "spdx license identifier bsd 3 clause": "bsd-3-clause",
    "spdx license identifier isc": "isc",
    "spdx license identifier unlicense": "unlicense",
    "spdx license identifier gpl 2 0": "gpl-2.0",
    "spdx license identifier gpl 3 0": "gpl-3.0",
    "spdx license identifier lgpl 2 1": "lgpl-2.1",
    "spdx license identifier lgpl 3 0": "lgpl-3.0",
    "spdx license identifier agpl 3 0": "agpl-3.0",
    "spdx license identifier mpl 2 0": "mpl-2.0",
    "spdx license identifier epl 2 0": "epl-2.0",
    "spdx license identifier bsl 1 0": "bsl-1.0",
    "spdx license identifier cc0 1 0": "cc0-1.0",
}


def words_of(text: str) -> list[str]:
    """The words of a text as texts of documents are cut."""
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]+", lambda m: m.group().lower(), text))


def sections(text: str) -> list[list[str]]:
    """The words of a template, in parts of nearly equal length of at most ``SECTION`` words."""
    words = words_of(text)
    if len(words) < GRAM:
        raise ValueError(f"a license template needs {GRAM} words: {text!r}")
    count = -(-len(words) // SECTION)
    return [words[len(words) * i // count:len(words) * (i + 1) // count] for i in range(count)]


def template_table(spark: SparkSession, templates: Mapping[str, str] | None = None) -> DataFrame:
    """(gram, template, label, base, at, grams, names): one row per 2-gram place of every section of a template. ``names`` has the bits of
    the 2-grams that hold the name of the license; 0 if there is none."""
    hasher, rows = Hasher(ALNUM), []
    for base, phrases in ((True, BASE), (False, TEMPLATES if templates is None else templates)):
        for text, label in phrases.items():
            named = NAMES | {w for w in words_of(label) if w.isalpha()}
            for i, words in enumerate(sections(text)):
                h = grams(hasher([" ".join(words).encode()]).hash, GRAM).view(np.int64)
                bits = sum(1 << at for at in range(len(h)) if not base and named & set(words[at:at + GRAM]))
                bits = int(np.uint64(bits).view(np.int64))
                rows += [(int(g), f"{'base:' if base else ''}{i}:{text}", label, base, at, len(h), bits) for at, g in enumerate(h)]
    if len(rows) > MOST_PLACES:
        raise ValueError(f"license templates have {len(rows)} places, more than {MOST_PLACES}")
    return spark.createDataFrame(rows, "gram long, template string, label string, base boolean, at int, grams int, names long")


def known_grams(docs: DataFrame, known: np.ndarray, doc_id: str, text: str) -> DataFrame:
    """Per row: number, id, words, and the rolling 2-grams that some template has, with their places."""
    hasher, numbers = Hasher(ALNUM), []
    known = np.sort(known)

    def per_batch(batch: pa.RecordBatch):
        if not numbers:
            numbers.append(row_numbers())
        ids, texts = batch.column(0), encoded(batch.column(1))
        for low, part in chunks(texts):
            words = hasher(part)
            h = grams(words.hash, GRAM)
            doc = np.repeat(np.arange(len(part)), np.diff(words.first))
            at = known[np.minimum(np.searchsorted(known, h), len(known) - 1)] == h
            at = np.flatnonzero(at & (doc[:len(h)] == doc[GRAM - 1:]))
            per_doc = np.bincount(doc[at], minlength=len(part))
            yield {"row": [next(numbers[0]) for _ in part], "doc_id": ids.slice(low, len(part)), "n_words": np.diff(words.first),
                   "gram": ragged(h[at].view(np.int64), per_doc, pa.int64()),
                   "place": ragged(at - words.first[doc[at]], per_doc, pa.int64())}

    kind = docs.schema[doc_id].dataType.simpleString()
    return map_texts(docs.select(F.col(f"`{doc_id}`"), F.col(f"`{text}`")), per_batch,
                     f"row long, doc_id {kind}, n_words long, gram array<long>, place array<long>")


def license_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                  templates: Mapping[str, str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(texts, spans): ``texts`` has row, doc_id, n_words; ``spans`` has row, label, base, start (word), score. ``templates`` maps notices
    to labels and takes the place of ``TEMPLATES``; add to a copy of that to keep them."""
    templates = template_table(docs.sparkSession, templates)
    known = np.array([r[0] for r in templates.select("gram").distinct().collect()], dtype=np.int64).view(np.uint64)
    texts = written(known_grams(docs, known, doc_id, text), "grams")
    hits = texts.where(F.size("gram") > 0).select("row", F.explode(F.arrays_zip("gram", "place")).alias("g")).select("row", "g.*")
    votes = (hits.join(F.broadcast(templates), "gram")
             .groupBy("row", "template", "label", "base", "grams", "names", (F.col("place") - F.col("at")).alias("diagonal"))
             .agg(F.bit_or(F.expr("shiftleft(1L, at)")).alias("voted")))
    near = Window.partitionBy("row", "template").orderBy("diagonal").rangeBetween(-NEAR, NEAR)
    merged = votes.withColumn("around", F.when(F.col("base"), F.col("voted")).otherwise(F.bit_or("voted").over(near)))
    score = F.bit_count("around") / F.col("grams")
    spans = merged.withColumn("score", score).where(
        F.when(F.col("base"), F.col("score") == 1).otherwise(
            (F.col("score") >= COVERED) & ((F.col("names") == 0) | (F.col("around").bitwiseAND(F.col("names")) != 0))))
    # of several notices that fit one place, the best covered one counts
    place = Window.partitionBy("row", "base").orderBy("diagonal").rangeBetween(-NEAR, NEAR)
    spans = spans.withColumn("best", F.max("score").over(place)).where(F.col("base") | (F.col("score") == F.col("best")))
    return texts.select("row", "doc_id", "n_words"), spans.select("row", "label", "base", F.col("diagonal").alias("start"), "score")


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", templates: Mapping[str, str] | None = None) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score. ``templates``: see
    :func:`license_spans`."""
    texts, spans = license_spans(docs, doc_id, text, templates)
    base = F.col("base")

    def joined(labels):
        return F.concat_ws(",", F.sort_array(labels))

    found = spans.groupBy("row").agg(
        F.count_if(base).alias("n_base"), F.min(F.when(base, F.col("start"))).alias("first_word"),
        F.max(F.when(base, F.col("start"))).alias("last_word"),
        joined(F.collect_set(F.when(base, F.col("label")))).alias("base_labels"),
        joined(F.collect_set("label")).alias("labels"), F.max("score").alias("score"))
    return texts.join(found, "row", "left").select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), "first_word", "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).cast("double").alias("score"))

