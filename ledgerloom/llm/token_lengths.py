"""Token counts as an exact length histogram with suffix sums.

Each text is encoded with a public tokenizer and only its length is kept. Lengths are counted in the task
that encodes, summed by Spark, and the histogram (one row per length that occurs, so at most as many as the longest text has tokens)
gets suffix sums. One row then answers for a context limit: how many texts reach it, how many
tokens they hold, what is left of the corpus if every text is cut there.

The suffix sums are made in two levels (blocks of ``BLOCK`` lengths, then within a block), so no task gets
more than one block of lengths or one row per block.

Defined results: a null or empty text has 0 tokens and is counted; equal rows count each for itself; an empty table
has an empty histogram; texts of any length are counted whole, white space of any length included; only the text column is read, so
other columns don't matter. Text that looks like a special token is encoded as ordinary text.
"""

from __future__ import annotations

import base64
import re
from collections import Counter
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ledgerloom.llm.common import map_texts, written

TOKENIZER = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
MOST_VOCABULARY = 64 << 20      # bytes of a vocabulary file that may be sent to the tasks
BLOCK = 1024
PIECE = 1 << 16                 # characters encoded at once
# Fixed value: the pattern that splits text before the merges of the rank files.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# Between a letter and a blank that is followed by a letter the pattern always splits, so a long text may be cut there.
CUT = re.compile(r"(?<=[^\W\d_])(?= [^\W\d_])")
# White space as the pattern knows it. Runs of this length are encoded apart.
BLANKS = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{1024,}")


def pieces(text: str) -> list[str]:
    """A long text in pieces that are encoded as they are within the whole."""
    if len(text) <= PIECE:
        return [text]
    out, last = [], 0
    while len(text) - last > PIECE:
        m = CUT.search(text, last + PIECE)
        if not m:
            break
        out.append(text[last:m.start()])
        last = m.start()
    return [*out, text[last:]]


def n_tokens(text: str, encoding) -> int:
    """Number of tokens. A long run of blanks is one piece for the merges, but for its last character where text follows: the pattern
    leaves that one to what comes next. Such runs are encoded apart, as matching the pattern on them needs a stack as deep as they are long."""
    count, last = 0, 0
    for m in BLANKS.finditer(text):
        count += sum(len(encoding.encode_ordinary(p)) for p in pieces(text[last:m.start()]))
        last = m.end() if m.end() == len(text) else m.end() - 1
        count += len(encoding._encode_single_piece(text[m.start():last]))
    return count + sum(len(encoding.encode_ordinary(p)) for p in pieces(text[last:]))


def lengths(docs: DataFrame, tokenizer: str = TOKENIZER, text: str = "text") -> DataFrame:
    """(n_tokens, docs): how many texts have that many tokens."""
    with open(tokenizer, "rb") as f:
        raw = f.read(MOST_VOCABULARY + 1)
    if len(raw) > MOST_VOCABULARY:
        raise ValueError(f"{tokenizer} is larger than {MOST_VOCABULARY} bytes")
    vocabulary, made = docs.sparkSession.sparkContext.broadcast(raw), []

    def per_batch(batch: pa.RecordBatch):
        if not made:
            import tiktoken
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.value.splitlines())}
            made.append(tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}))
        counts = Counter(n_tokens(t, made[0]) if t else 0 for t in batch.column(0).to_pylist())
        yield {"n_tokens": list(counts), "docs": list(counts.values())}

    rows = map_texts(docs.select(F.col(f"`{text}`")), per_batch, "n_tokens long, docs long")
    # written, as readers look at the histogram more than once and texts are to be encoded once
    return written(rows.groupBy("n_tokens").agg(F.sum("docs").alias("docs")), "lengths")


def suffix_sums(histogram: DataFrame) -> DataFrame:
    """The histogram with docs_at_least and tokens_at_least (over texts of this length or more), truncated_total (tokens
    left if every text is cut to this length) and quantile (share of texts of this length or less)."""
    h = histogram.withColumn("block", F.floor(F.col("n_tokens") / BLOCK)).withColumn("tokens", F.col("n_tokens") * F.col("docs"))
    blocks = h.groupBy("block").agg(F.sum("docs").alias("block_docs"), F.sum("tokens").alias("block_tokens"))
    after = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    blocks = blocks.select(
        "block", F.coalesce(F.sum("block_docs").over(after), F.lit(0)).alias("docs_after"), F.coalesce(F.sum("block_tokens").over(after), F.lit(0)).alias("tokens_after"),
        F.sum("block_docs").over(every).alias("all_docs"), F.sum("block_tokens").over(every).alias("all_tokens"))
    inside = Window.partitionBy("block").orderBy(F.desc("n_tokens"))
    out = h.join(blocks, "block").select(
        "n_tokens", "docs", (F.sum("docs").over(inside) + F.col("docs_after")).alias("docs_at_least"),
        (F.sum("tokens").over(inside) + F.col("tokens_after")).alias("tokens_at_least"), "all_docs", "all_tokens")
    return out.select(
        "n_tokens", "docs", "docs_at_least", "tokens_at_least",
        (F.col("all_tokens") - F.col("tokens_at_least") + F.col("n_tokens") * F.col("docs_at_least")).alias("truncated_total"),
        ((F.col("all_docs") - F.col("docs_at_least") + F.col("docs")) / F.col("all_docs")).alias("quantile"))


def at_limits(sums: DataFrame, spark: SparkSession, limits: Sequence[int]) -> DataFrame:
    """(limit, docs_over, tokens_kept, tokens_cut) for any context limits, from the sums alone."""
    asked = spark.createDataFrame([(int(x),) for x in limits], "limit long")
    # the lengths above a limit are summed up in the row of the smallest of them
    over = sums.join(F.broadcast(asked), F.col("n_tokens") > F.col("limit")).groupBy("limit").agg(
        F.min(F.struct("n_tokens", "docs_at_least", "tokens_at_least")).alias("o"))
    over = asked.distinct().join(over, "limit", "left")
    total = sums.agg(F.coalesce(F.max("tokens_at_least"), F.lit(0)).alias("total"))
    cut = F.coalesce(F.col("o.tokens_at_least") - F.col("limit") * F.col("o.docs_at_least"), F.lit(0))
    return over.crossJoin(total).select("limit", F.coalesce("o.docs_at_least", F.lit(0)).alias("docs_over"),
                                        (F.col("total") - cut).alias("tokens_kept"), cut.alias("tokens_cut"))


def quantiles(sums: DataFrame, shares: Sequence[float]) -> DataFrame:
    """One row: for each share q, the smallest length that at least that share of the texts doesn't exceed."""
    return sums.agg(*[F.min(F.when(F.col("quantile") >= q, F.col("n_tokens"))).alias(f"q{round(100 * q)}") for q in shares])
