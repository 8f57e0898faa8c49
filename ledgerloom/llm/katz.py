"""Language-model scores by Katz backoff.

Counts of n-grams are discounted by Good and Turing's estimate and the mass that this frees is given, by exactly normalised backoff
weights, to the words not seen after a context, in proportion to what the next shorter context says:

    P(w | h) = d_r r / C             r = count of h w, 1 <= r <= k, C = count of h, d_r < 1 the discount of r
             = r / (C + 1)           r > k
             = a(h) P(w | h')        r = 0, h' the context without its first word; a(h) makes the sum over all words 1
             = P(w | h')             C = 0

Words are the known ones, one for the end of a text and one for all unknown ones. At the bottom ``C`` is the number of tokens, and the unknown word
has all that is left. A text starts in a context that no text can hold. Counts above k are divided by C + 1 rather
than C, so that a context with large counts alone has a backoff weight, too. k is the largest number up to ``LARGEST`` for
which the counts of counts give discounts between 0 and 1.

How it runs. Texts are cut into words once and put into chunks of about ``CHUNK`` tokens, one written row each. A level (words, then pairs,
and so on up to ``order``) is one exchange between chunks and buckets: every chunk sends its distinct n-grams with their counts, dealt
by a hash of the context (contexts that are frequent are dealt by word as well, so none of them is one task's); every
bucket adds up, stores its part of the table, and answers each chunk with the counts of what it sent. The counts of
one level are the context counts of the next, so a chunk has all it needs to evaluate the recursion for each of its tokens. Sums for backoff
weights are added up by context and go to the chunks that met an unseen n-gram there. Arrays travel packed. Only counts of counts and
totals reach the driver. Number of buckets and all tables grow with the tokens.

Words and contexts of three or more words are known by 64-bit hashes; two of m different ones coincide with a probability of m * m / 2**65.

Defined results. A null text counts as empty; an empty text is its end alone. Repeated rows, ids and ties are rows like any others. A
text stays in one chunk, however long it is. Without a learned text every probability is 1. An empty table gives no row.
Only the text and what the caller asks to keep are read, so names of other columns don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.llm import words as text_words
from ledgerloom.llm.common import row_numbers, shuffle_partitions, small_batches, written
from ledgerloom.session import new_stage_path

CHUNK = 1_000_000            # tokens of a chunk, unless one text has more
BUCKET = 2_000_000           # n-grams of a bucket at most, repeats within chunks counted
HOT = 200_000                # a context that occurs more often is dealt over several buckets
LARGEST = 5                  # largest count that may be discounted
U64 = np.uint64
END = U64(0x5851F42D4C957F2D)            # hash that stands for the end of a text
START = U64(1 << 63)                     # context of a text's first token

PARTS = "chunk long, level int, bucket long, parts array<binary>"


def pack(values: np.ndarray) -> bytes:
    """An array as bytes, compressed by planes: first all first bytes, then all second ones."""
    values = np.ascontiguousarray(values)
    planes = values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()
    return len(values).to_bytes(8, "little") + (pa.compress(planes, "zstd", asbytes=True) if planes else b"")


def unpack(data: bytes, kind=np.int64) -> np.ndarray:
    size, width = int.from_bytes(data[:8], "little"), np.dtype(kind).itemsize
    if not size:
        return np.empty(0, dtype=kind)
    planes = pa.decompress(data[8:], decompressed_size=size * width, codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(planes, dtype=np.uint8).reshape(width, size).T).view(kind).ravel()


def row(chunk: int, level: int, bucket: int, parts: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([
        pa.array([chunk], pa.int64()), pa.array([level], pa.int32()), pa.array([bucket], pa.int64()), pa.array([parts], pa.list_(pa.binary()))],
        names=["chunk", "level", "bucket", "parts"])


def cuts(sorted_values: np.ndarray) -> np.ndarray:
    """Where a new value begins, in a sorted array."""
    if not len(sorted_values):
        return np.empty(0, dtype=np.int64)
    return np.flatnonzero(np.concatenate([[True], sorted_values[1:] != sorted_values[:-1]]))


def discounts(counts_of_counts: list[int]) -> list[float]:
    """Good-Turing discounts of the counts 1 to k, from the numbers of n-grams with the counts 1 to ``LARGEST`` + 1."""
    n = [0, *counts_of_counts]
    for k in range(LARGEST, 0, -1):
        if min(n[1:k + 2]) == 0:
            continue
        rest = (k + 1) * n[k + 1] / n[1]
        if rest < 1:
            d = [((r + 1) * n[r + 1] / (r * n[r]) - rest) / (1 - rest) for r in range(1, k + 1)]
            if all(0 < x < 1 for x in d):
                return d
    return []


class Level:
    """What a task needs to know of a finished level: the discounts."""

    def __init__(self, d: list[float]):
        self.d = np.array([0.0, *d])

    def seen(self, count: np.ndarray, of: np.ndarray | int) -> np.ndarray:
        """Probability of what was seen ``count`` times in a context that was seen ``of`` times; 0 where it was not seen."""
        k = len(self.d) - 1
        small = count <= k
        of = np.maximum(of, 1)
        return np.where(small, self.d[np.where(small, count, 0)] * count / of, count / (of + 1.0))

    def left(self, of: np.ndarray, classes: np.ndarray) -> np.ndarray:
        """Mass left in contexts: ``classes`` has the number of words seen 1 to ``LARGEST`` times, and the sum of the larger counts."""
        k = len(self.d) - 1
        r = np.arange(1, LARGEST + 1)
        small = (classes[:, :k] * r[:k] * self.d[1:]).sum(axis=1) / of
        return 1 - small - ((classes[:, k:LARGEST] * r[k:]).sum(axis=1) + classes[:, LARGEST]) / (of + 1.0)


class Chunk:
    """Tokens of some texts, and what the tables answered about them so far."""

    def __init__(self, parts: list[bytes]):
        self.local, self.length = unpack(parts[0], np.int32), unpack(parts[1])
        self.learn = unpack(parts[2], np.int8)
        self.first = np.concatenate([[0], np.cumsum(self.length)])[:-1].astype(np.int64)     # no text is without its end
        self.place = (np.arange(len(self.local)) - np.repeat(self.first, self.length)).astype(np.int32)
        self.learned = np.repeat(self.learn, self.length)

    def words(self, ids: np.ndarray, counts: np.ndarray, level: Level, tokens: int) -> None:
        """Answers of the first level, in the order of the chunk's vocabulary."""
        self.id, self.count, self.level = ids[self.local], counts[self.local], 1
        self.p = level.seen(self.count, tokens)
        self.shorter = self.count, np.broadcast_to(np.int64(tokens), self.count.shape)
        self.context = np.where(self.place == 0, START, np.roll(self.id, 1).astype(U64))
        self.of = np.roll(self.count, 1)

    def begin(self, texts: int) -> None:
        """Contexts of the first tokens were seen once for each learned text."""
        self.of = np.where(self.place == 0, texts, self.of)

    def grams(self, buckets: int, ask: bool = False) -> None:
        """Sort the distinct n-grams of the next level whose context was seen; ``at`` are their tokens. The rest is for asking."""
        self.at = np.flatnonzero((self.of > 0) & (self.place >= self.level - 1))
        context, word = self.context[self.at], self.id[self.at]
        bucket = bucket_of(context, word, self.of[self.at], buckets)
        order = np.lexsort((word, context, bucket))
        new = np.ones(len(order), dtype=bool)
        new[1:] = np.diff(word[order]) != 0
        new[1:] |= np.diff(context[order]) != 0
        start = np.flatnonzero(new)
        self.gram_of = np.empty(len(order), dtype=np.int32)
        self.gram_of[order] = np.cumsum(new, dtype=np.int32) - 1
        if ask:
            first = order[start]
            self.bucket, self.g_context, self.g_word, self.g_of = bucket[first], context[first], word[first], self.of[self.at[first]]
            learned = self.learned[self.at[order]]
            self.g_learned = np.add.reduceat(learned, start, dtype=np.int64) if len(start) else start
            # a learned n-gram was seen in the shorter context as well: how often, of how many
            shorter = np.where(self.g_learned > 0, self.at[first], -1)
            self.g_shorter = [np.where(shorter < 0, 0, part[shorter]) for part in self.shorter]

    def requests(self, chunk: int, level: int) -> Iterator[pa.RecordBatch]:
        limits = np.append(cuts(self.bucket), len(self.bucket))
        for low, high in zip(limits[:-1], limits[1:]):
            context = self.g_context[low:high]
            run = cuts(context)
            yield row(chunk, level, int(self.bucket[low]), [
                pack(context[run]), pack(np.diff(np.append(run, high - low)).astype(np.int64)), pack(self.g_of[low:high][run]),
                pack(self.g_word[low:high]), pack(self.g_learned[low:high]), *[pack(part[low:high]) for part in self.g_shorter]])

    def answered(self, counts: np.ndarray, level: Level, unseen: tuple[np.ndarray, np.ndarray] | None) -> None:
        """Counts of the n-grams of this level, and, for a score, the backoff weights of contexts in which some was not seen."""
        self.level += 1
        count = np.zeros(len(self.local), dtype=np.int64)
        count[self.at] = counts[self.gram_of]
        if unseen is not None:
            weight = np.ones(len(self.local))
            contexts, weights = unseen
            if len(contexts):
                found = np.minimum(np.searchsorted(contexts, self.context), len(contexts) - 1)
                there = (contexts[found] == self.context) & (count == 0) & (self.of > 0) & (self.place >= self.level - 2)
                weight[there] = weights[found[there]]
            self.p = np.where(count > 0, level.seen(count, self.of), weight * self.p)
        longer = text_words.mix(np.roll(self.context, 1) * U64(text_words.BASE) + np.roll(self.id, 1).astype(U64) + U64(self.level))
        self.shorter = count, self.of
        self.context, self.of = longer, np.where(self.place >= self.level - 1, np.roll(count, 1), 0)


def bucket_of(context: np.ndarray, word: np.ndarray, of: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of n-grams: by context, and by word as well where the context is frequent."""
    spread = context
    hot = of >= HOT
    if hot.any():
        spread = context.copy()
        spread[hot] += text_words.mix(word[hot].astype(U64)) % (1 + of[hot] // HOT).astype(U64) * U64(0x9E3779B97F4A7C15)
    return ((text_words.mix(spread) >> U64(32)) * U64(buckets) >> U64(32)).astype(np.int64)


def by_chunk(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, dict[int, list[list[bytes]]], pa.RecordBatch]]:
    """Rows of neighbouring batches by chunk: the parts of each level in order of buckets, and the batch row of the chunk itself."""
    current, levels, own = None, {}, None
    for batch in batches:
        for i, (chunk, level, parts) in enumerate(zip(*[batch.column(n).to_pylist() for n in ("chunk", "level", "parts")])):
            if chunk != current:
                if current is not None:
                    yield current, levels, own
                current, levels, own = chunk, {}, None
            levels.setdefault(level, []).append(parts)
            if level == 0:
                own = batch.slice(i, 1)
    if current is not None:
        yield current, levels, own


def collected(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[tuple[int, list[bytes]]]]]:
    """Rows of neighbouring batches by bucket: (chunk, parts)."""
    current, rows = None, []
    for batch in batches:
        for chunk, bucket, parts in zip(*[batch.column(n).to_pylist() for n in ("chunk", "bucket", "parts")]):
            if bucket != current:
                if rows:
                    yield current, rows
                current, rows = bucket, []
            rows.append((chunk, parts))
    if rows:
        yield current, rows


def joined(arrays: list[np.ndarray], kind=np.int64) -> np.ndarray:
    return np.concatenate(arrays) if arrays else np.empty(0, dtype=kind)


class Katz:
    """A model of the texts where ``learn`` holds, and the scores of all texts; everything is kept in written tables."""

    def __init__(self, docs: DataFrame, learn: Column, order: int = 2, text: str = "text", keep: Mapping[str, Column] | None = None):
        self.order, spark = order, docs.sparkSession
        small_batches(spark)
        kept = F.struct(*[c.alias(n) for n, c in (keep or {}).items()], F.coalesce(learn, F.lit(False)).alias("learn"))
        self.rows = docs.select(kept.alias("doc"), F.col(f"`{text}`").cast("string").alias("text"))
        self.kept = self.rows.schema["doc"].dataType
        self.chunks = self._chunks()
        sizes = self.chunks.agg(F.sum("tokens"), F.sum("learned")).first()
        self.tokens, self.texts = int(sizes[0] or 0), int(sizes[1] or 0)
        self.buckets = 1
        while self.buckets * BUCKET < self.tokens or self.buckets < 8:
            self.buckets *= 2
        self.levels: list[Level] = []
        self.tables: list[DataFrame] = []
        self.answers: list[DataFrame] = []
        self.unseen: list[DataFrame] = []
        self._words()
        for level in range(2, order + 1):
            self._grams(level)

    # ---- texts to chunks
    def _chunks(self) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            split, number = text_words.Hasher(text_words.SPACED), row_numbers()
            hashes, lengths, docs = [], [], []

            def chunk() -> pa.RecordBatch:
                vocabulary, local = np.unique(np.concatenate(hashes), return_inverse=True)
                length, who = np.concatenate(lengths), pa.concat_arrays(docs)
                learn = np.asarray(who.field("learn").to_pylist(), dtype=np.int8)
                learned = np.bincount(local, weights=np.repeat(learn, length), minlength=len(vocabulary)).astype(np.int64)
                parts = [pack(local.astype(np.int32)), pack(length), pack(learn)]
                return pa.RecordBatch.from_arrays([
                    pa.array([next(number)], pa.int64()), pa.array([len(local)], pa.int64()), pa.array([int(learn.sum())], pa.int64()),
                    pa.array([parts], pa.list_(pa.binary())), pa.array([[pack(vocabulary), pack(learned)]], pa.list_(pa.binary())),
                    pa.ListArray.from_arrays(pa.array([0, len(who)], pa.int32()), who)],
                    names=["chunk", "tokens", "learned", "parts", "vocabulary", "docs"])

            size = 0
            for batch in batches:
                for low, texts in text_words.chunks(text_words.encoded(batch.column(1))):
                    found = split(texts)
                    # every text is followed by its end
                    hashes.append(np.insert(found.hash, found.first[1:], END))
                    lengths.append(np.diff(found.first) + 1)
                    docs.append(batch.column(0).slice(low, len(texts)))
                    size += len(hashes[-1])
                    if size >= CHUNK:
                        yield chunk()
                        hashes, lengths, docs, size = [], [], [], 0
            if size:
                yield chunk()

        kept = self.kept.simpleString()
        return written(self.rows.mapInArrow(
            run, f"chunk long, tokens long, learned long, parts array<binary>, vocabulary array<binary>, docs array<{kept}>"), "chunks")

    # ---- levels
    def _merged(self, requests: DataFrame, merge, level: int) -> dict[str, DataFrame]:
        """Run ``merge`` on the requests of each bucket and write what it yields, by kind."""
        path = new_stage_path(requests.sparkSession, f"level-{level}")
        schema = f"kind string, {PARTS}"

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for bucket, rows in collected(batches):
                for kind, batch in merge(bucket, rows):
                    yield pa.RecordBatch.from_arrays([pa.array([kind]), *batch.columns], names=["kind", *batch.schema.names])

        dealt = requests.repartition(min(self.buckets, 16 * shuffle_partitions(requests.sparkSession)), "bucket")
        dealt.sortWithinPartitions("bucket", "chunk").mapInArrow(run, schema).write.partitionBy("kind").parquet(path)
        every = requests.sparkSession.read.schema(schema).parquet(path)
        return {kind: every.where(F.col("kind") == kind).drop("kind") for kind in ("answer", "table", "classes", "sums", "needs")}

    def _finish(self, classes: DataFrame, level: int) -> list[int]:
        """Find the discounts of a level; counts of counts and, last, the number of different n-grams and of all."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for parts in batch.column(0).to_pylist():
                    values = unpack(parts[0])
                    yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(values))), pa.array(values)], names=["i", "value"])

        sums = dict(classes.select("parts").mapInArrow(run, "i long, value long").groupBy("i").agg(F.sum("value")).collect())
        found = [int(sums.get(i, 0)) for i in range(LARGEST + 3)]
        self.levels.append(Level(discounts(found[:LARGEST + 1])))
        return found

    def _words(self) -> None:
        buckets = self.buckets

        def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for chunk, (vocabulary, learned) in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    vocabulary, learned = unpack(vocabulary, U64), unpack(learned)
                    bucket = ((vocabulary >> U64(32)) * U64(buckets) >> U64(32)).astype(np.int64)      # sorted like the hashes
                    limits = np.append(cuts(bucket), len(bucket))
                    for low, high in zip(limits[:-1], limits[1:]):
                        yield row(chunk, 1, int(bucket[low]), [pack(vocabulary[low:high]), pack(learned[low:high])])

        def merge(bucket: int, rows: list) -> Iterator[tuple[str, pa.RecordBatch]]:
            hashes, counts = [unpack(p[0], U64) for _, p in rows], [unpack(p[1]) for _, p in rows]
            words, place = np.unique(np.concatenate(hashes), return_inverse=True)
            total = np.bincount(place, weights=np.concatenate(counts)).astype(np.int64)
            ids = np.arange(len(words), dtype=np.int64) * buckets + bucket
            at = 0
            for chunk, part in zip([c for c, _ in rows], hashes):
                mine = place[at:at + len(part)]
                at += len(part)
                yield "answer", row(chunk, 1, bucket, [pack(ids[mine]), pack(total[mine])])
            yield "table", row(-1, 1, bucket, [pack(words), pack(ids), pack(total)])
            yield "classes", row(-1, 1, bucket, [pack(classes_of(total))])

        requests = self.chunks.select("chunk", "vocabulary").mapInArrow(ask, PARTS)
        out = self._merged(requests, merge, 1)
        found = self._finish(out["classes"], 1)
        self.distinct, self.learned_tokens = found[-2], found[-1]
        few = found[:LARGEST]
        self.word_classes = [*few, self.learned_tokens - sum(r * n for r, n in enumerate(few, 1))]
        self.tables.append(out["table"])
        self.answers.append(out["answer"])

    def _state(self):
        """A function that makes the state of a chunk from its row and the answers of all finished levels, with or without backoff."""
        levels, texts, tokens, buckets = list(self.levels), self.texts, self.learned_tokens, self.buckets
        # what is left at the bottom belongs to the unknown word
        rest = self.unknown

        def state(found: dict[int, list[list[bytes]]], backoff: bool) -> Chunk:
            chunk = Chunk(found[0][0])
            chunk.words(joined([unpack(p[0]) for p in found[1]]), joined([unpack(p[1]) for p in found[1]]), levels[0], tokens)
            chunk.begin(texts)
            chunk.p = np.where(chunk.count > 0, chunk.p, rest)
            for n, level in enumerate(levels[1:], 2):
                chunk.grams(buckets)
                unseen = None
                if backoff:
                    parts = found.get(-n, [])
                    contexts, weights = joined([unpack(p[0], U64) for p in parts], U64), joined([unpack(p[1], np.float64) for p in parts], np.float64)
                    order = np.argsort(contexts)
                    unseen = contexts[order], weights[order]
                chunk.answered(joined([unpack(p[0]) for p in found.get(n, [])]), level, unseen)
            return chunk

        return state

    @property
    def unknown(self) -> float:
        """Probability of the unknown word."""
        if not self.learned_tokens:
            return 1.0
        return float(self.levels[0].left(np.array([self.learned_tokens]), np.array([self.word_classes]))[0])

    def _with_answers(self, tables: list[DataFrame]) -> DataFrame:
        """Chunks and the rows meant for them, chunk by chunk."""
        docs = F.lit(None).cast(self.chunks.schema["docs"].dataType).alias("docs")
        rows = self.chunks.select("chunk", F.lit(0).alias("level"), F.lit(0).cast("long").alias("bucket"), "parts", "docs")
        for table in tables:
            rows = rows.unionByName(table.select("chunk", "level", "bucket", "parts", docs))
        return rows.repartition("chunk").sortWithinPartitions("chunk", F.col("level") != 0, "level", "bucket")

    def _grams(self, level: int) -> None:
        state, buckets, below_level = self._state(), self.buckets, self.levels[-1]

        def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for number, found, _ in by_chunk(batches):
                chunk = state(found, False)
                chunk.grams(buckets, ask=True)
                yield from chunk.requests(number, level)

        def merge(bucket: int, rows: list) -> Iterator[tuple[str, pa.RecordBatch]]:
            sizes, context, of, word, learned, shorter, shorter_of = [], [], [], [], [], [], []
            for _, parts in rows:
                run = unpack(parts[1])
                context.append(np.repeat(unpack(parts[0], U64), run))
                of.append(np.repeat(unpack(parts[2]), run))
                word.append(unpack(parts[3]))
                learned.append(unpack(parts[4]))
                shorter.append(unpack(parts[5]))
                shorter_of.append(unpack(parts[6]))
                sizes.append(len(word[-1]))
            context, of, word, learned = map(np.concatenate, (context, of, word, learned))
            lower = below_level.seen(np.concatenate(shorter), np.concatenate(shorter_of))
            order = np.lexsort((word, context))
            c, w = context[order], word[order]
            new = np.concatenate([[True], (w[1:] != w[:-1]) | (c[1:] != c[:-1])])
            start = np.flatnonzero(new)
            total = np.add.reduceat(learned[order], start)
            below = np.maximum.reduceat(lower[order], start)
            c, w, of = c[start], w[start], of[order][start]
            back = np.empty(len(order), dtype=np.int64)
            back[order] = total[np.cumsum(new) - 1]
            limits = np.concatenate([[0], np.cumsum(sizes)])
            for (chunk, _), low, high in zip(rows, limits[:-1], limits[1:]):
                yield "answer", row(chunk, level, bucket, [pack(back[low:high])])
            seen = total > 0
            yield "table", row(-1, level, bucket, [pack(c[seen]), pack(w[seen]), pack(total[seen])])
            yield "classes", row(-1, level, bucket, [pack(classes_of(total))])
            # per context: how many words were seen once, twice, ...; the sum of larger counts; the mass of the seen words below
            first = cuts(c)
            by_class = np.stack([np.add.reduceat((total == r).astype(np.int64), first) for r in range(1, LARGEST + 1)]
                                + [np.add.reduceat(np.where(total > LARGEST, total, 0), first)])
            mass = np.add.reduceat(np.where(seen, below, 0.0), first)
            missing = np.flatnonzero(back == 0)
            needed = distinct_pairs(context[missing], np.repeat([r for r, _ in rows], sizes)[missing])
            # sums of a context that no one asked for aren't sent, unless other buckets may hold words that were asked for
            wanted = np.isin(c[first], needed[0]) | (of[first] >= HOT)
            yield "sums", row(-1, level, bucket, [pack(c[first][wanted]), pack(of[first][wanted]), *[pack(m[wanted]) for m in by_class], pack(mass[wanted])])
            yield "needs", row(-1, level, bucket, [pack(needed[0]), pack(needed[1])])

        out = self._merged(self._with_answers(self.answers).mapInArrow(ask, PARTS), merge, level)
        self._finish(out["classes"], level)
        self.tables.append(out["table"])
        self.answers.append(out["answer"])
        self.unseen.append(self._weights(out["sums"], out["needs"], level))

    def _weights(self, sums: DataFrame, needs: DataFrame, level: int) -> DataFrame:
        """Backoff weights for each chunk that met an unseen n-gram, as rows to be sent to it (with the negative level)."""
        classes = [f"n{r}" for r in range(1, LARGEST + 2)]
        total = backoff_sums(sums).groupBy("context").agg(F.max("of").alias("of"), *[F.sum(c).alias(c) for c in (*classes, "mass")])
        finished = self.levels[-1]

        def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                column = {n: batch.column(n).to_numpy(zero_copy_only=False) for n in batch.schema.names}
                left = finished.left(column["of"], np.stack([column[c] for c in classes], axis=1))
                yield pa.RecordBatch.from_arrays([batch.column("context"), pa.array(left / np.maximum(1 - column["mass"], 1e-300))],
                                                 names=["context", "weight"])

        def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for parts in batch.column(0).to_pylist():
                    yield pa.RecordBatch.from_arrays([pa.array(unpack(parts[0])), pa.array(unpack(parts[1]))], names=["context", "chunk"])

        self.weights = total.mapInArrow(weigh, "context long, weight double")
        asked = needs.select("parts").mapInArrow(expand, "context long, chunk long").distinct()
        slices = F.pmod(F.xxhash64("context"), F.lit(64))

        def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for chunk, part, contexts, weights in zip(*[c.to_pylist() for c in batch.columns]):
                    yield row(chunk, -level, part, [pack(np.array(contexts, dtype=np.int64)), pack(np.array(weights, dtype=np.float64))])

        # a chunk has at most as many contexts as tokens
        sent = asked.join(self.weights, "context").groupBy("chunk", slices.alias("part")).agg(
            F.collect_list(F.struct("context", "weight")).alias("w"))
        return written(sent.select("chunk", "part", "w.context", "w.weight").mapInArrow(packed, PARTS), "weights")

    # ---- results
    def scores(self) -> DataFrame:
        """What was to be kept, ``n_tokens, n_known, train_tokens, base_score, score`` (logarithms to base 10) of every text."""
        state = self._state()
        tokens, distinct = self.learned_tokens, self.distinct
        fields = [f for f in self.kept.fields if f.name != "learn"]
        results = [("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())]
        schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in fields]
                           + ["n_tokens long", "n_known long", "train_tokens long", "base_score double", "score double"])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for _, found, own in by_chunk(batches):
                chunk = state(found, True)
                who = own.column("docs").flatten()
                base = np.log10((chunk.count + 1) / (tokens + 1 * (distinct + 1)))
                add = lambda values: np.add.reduceat(values, chunk.first)
                columns = [chunk.length, add((chunk.count > 0).astype(np.int64)), np.full(len(chunk.length), tokens),
                           add(base), add(np.log10(chunk.p))]
                yield pa.RecordBatch.from_arrays([*[who.field(f.name) for f in fields], *[pa.array(c, type=t) for c, (_, t) in zip(columns, results)]],
                                                 names=[*[f.name for f in fields], *[n for n, _ in results]])

        return self._with_answers([*self.answers, *self.unseen]).mapInArrow(run, schema)

    def words(self) -> DataFrame:
        """The first table: ``word`` (its hash), ``id`` and ``count``."""
        return self.tables[0].select("parts").mapInArrow(unpacked("word", "id", "count"), "word long, id long, count long").where("count > 0")

    def grams(self, level: int) -> DataFrame:
        """The table of a level: ``context``, ``word`` (its id) and ``count``."""
        return self.tables[level - 1].select("parts").mapInArrow(unpacked("context", "word", "count"), "context long, word long, count long")


def distinct_pairs(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    new = np.ones(len(a), dtype=bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return a[new], b[new]


def unpacked(*names: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for parts in batch.column(0).to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array(unpack(p)) for p in parts], names=list(names))

    return run


def backoff_sums(sums: DataFrame) -> DataFrame:
    names = ["context", "of", *[f"n{r}" for r in range(1, LARGEST + 2)], "mass"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for parts in batch.column(0).to_pylist():
                yield pa.RecordBatch.from_arrays([*[pa.array(unpack(p)) for p in parts[:-1]], pa.array(unpack(parts[-1], np.float64))], names=names)

    return sums.select("parts").mapInArrow(run, ", ".join(f"{n} long" for n in names[:-1]) + ", mass double")


def classes_of(total: np.ndarray) -> np.ndarray:
    """Numbers of counts 1 to ``LARGEST`` + 1, of counts above 0, and the sum of all counts."""
    few = np.bincount(np.minimum(total, LARGEST + 2), minlength=LARGEST + 3)[1:LARGEST + 2]
    return np.concatenate([few, [np.count_nonzero(total)], [total.sum()]]).astype(np.int64)
