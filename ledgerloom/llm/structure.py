"""Repair of the turn structure of conversations by lightest derivations.

A conversation is right if its roles read ``(s?(ua)+)?``: nothing, or pairs of a user's and an assistant's turn, with at most one
system turn before them. Rows may be kept, given another role or deleted, and empty turns may be inserted, each at a cost. The cheapest
edits are found as a lightest derivation in a weighted hypergraph. An item says that the rows up to a place can be edited so that the
pattern is in some state. A deduction joins an item and an edit of the next row (or an insertion) to a new item; it adds their costs and
joins their audits, the initials of the edits. Items wait in an agenda and are popped by cost, place and audit; as deductions never make these
smaller, the first time an item is popped it has its final, lightest value (Knuth's generalisation of Dijkstra's algorithm), and
the work ends when the goal item is popped. Two audits of the same rows and costs are never one the beginning of the other, so
joining keeps their order and ties go to the audit that is least in ASCII.

The same deductions hold for stretches of a conversation: a block of rows is solved for every pair of states at its ends, and blocks
are joined by deductions with two antecedents, an item before the block and an item of the block. So a conversation of any length is
solved in blocks of ``BLOCK`` rows, in rounds of ``FAN`` neighbours, by many tasks. A conversation's audit, one letter an edit, is the only thing about
it that one task holds. Rows are put in order without their texts; texts move when the edits are applied.

Faults, per row the first that holds: ``blank`` (no ``[^\\x20\\x09-\\x0D]``), ``duplicate`` (role and text stand earlier in the conversation),
``truncated`` (the last such character is not ``[.!?]``). Costs: keep 0, another role (user or assistant) 2, delete 3, insert 2; blank and
duplicate rows must be deleted; a truncated row that stays adds 1.

Defined results. Rows of a conversation stand by turn, null first; rows of one turn by role and the SHA-256 of their text, so equal rows are
neighbours. Null roles and texts count as one blank character, null ids are one conversation of their own. Repeated rows are
duplicates. Empty and blank texts are blank; texts of any length are read by built-in functions. A table without rows gives no row. Columns other than the
four named ones are neither read nor returned.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.llm.common import numbered, shuffle_partitions, written
from ledgerloom.operators.skew import lookup

BLOCK, FAN = 64, 64
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
SPACE = " \t\n\x0b\x0c\r"

# States of the pattern: nothing yet, after the system turn, after a user's, after an assistant's turn.
STATES = "ESUA"
STEP = {("E", "s"): "S", ("E", "u"): "U", ("S", "u"): "U", ("U", "a"): "A", ("A", "u"): "U"}
ENDS = "EA"
SPOKEN = {"u": "user", "a": "assistant"}
LEGAL = {"su", "ua", "au"}
# A row as one letter: initial of its role (any other: x) and whether it stays at no cost, has to go, or is truncated.
KINDS = ("sound", "gone", "truncated")
SYMBOL = {chr(ord("a") + 3 * i + k): (initial, kind) for i, initial in enumerate("suax") for k, kind in enumerate(KINDS)}

Item = tuple[int, str]
GOAL = "goal"


def derive(start: Item, deductions: Callable[[Item], Iterable[tuple[int, str, Item]]]) -> dict[Item, tuple[int, str]]:
    """Final (cost, audit) of all items that can be derived from ``start``, up to the goal item if that is among them.

    ``deductions`` lists, for an item, cost and audit of the other antecedent and the item that follows from both.
    """
    final: dict[Item, tuple[int, str]] = {}
    agenda = [(0, start[0], "", start)]
    while agenda:
        cost, _, audit, item = heapq.heappop(agenda)
        if item in final:
            continue
        final[item] = cost, audit
        if item[1] == GOAL:
            break
        for more, letters, after in deductions(item):
            if after not in final:
                heapq.heappush(agenda, (cost + more, after[0], audit + letters, after))
    return final


def edits_of(word: str, to_goal: bool) -> Callable[[Item], Iterable[tuple[int, str, Item]]]:
    """Deductions over the rows of a block, given as one letter each."""
    rows = [SYMBOL[c] for c in word]

    def deductions(item: Item) -> Iterator[tuple[int, str, Item]]:
        place, state = item
        spoken = [STEP[state, r] for r in SPOKEN if (state, r) in STEP]
        for after in spoken:
            yield INSERT, "I", (place, after)
        if place == len(rows):
            if to_goal and state in ENDS:
                yield 0, "", (place + 1, GOAL)
            return
        initial, kind = rows[place]
        yield DELETE, "D", (place + 1, state)
        if kind != "gone":
            stays = TRUNCATED if kind == "truncated" else 0
            if (state, initial) in STEP:
                yield KEEP + stays, "K", (place + 1, STEP[state, initial])
            for after in spoken:
                yield REROLE + stays, "R", (place + 1, after)

    return deductions


Spans = dict[tuple[str, str], tuple[int, str]]


def spans_of(word: str) -> Spans:
    """Lightest edits of a block for every pair of states before and after it."""
    out: Spans = {}
    for before in STATES:
        final = derive((0, before), edits_of(word, False))
        out.update({(before, s): v for (place, s), v in final.items() if place == len(word)})
    return out


def joined(blocks: list[Spans]) -> Spans:
    """Lightest edits over neighbouring blocks."""
    def deductions(item: Item) -> Iterator[tuple[int, str, Item]]:
        place, state = item
        if place < len(blocks):
            for after in STATES:
                if (state, after) in blocks[place]:
                    yield *blocks[place][state, after], (place + 1, after)

    out: Spans = {}
    for before in STATES:
        final = derive((0, before), deductions)
        out.update({(before, s): v for (place, s), v in final.items() if place == len(blocks)})
    return out


def repair_word(word: str) -> tuple[int, str]:
    """Cost and audit of a whole conversation."""
    final = derive((0, "E"), edits_of(word, True))
    return final[len(word) + 1, GOAL]


def illegal_in(initials: str) -> int:
    return sum(initials[i:i + 2] not in LEGAL for i in range(len(initials) - 1))


# ---- rows ---------------------------------------------------------------------------------------
def conversation_key(conv_id: str) -> Column:
    """The id as a text that is never null and differs for different ids."""
    return F.coalesce(F.concat(F.lit("="), F.col(f"`{conv_id}`").cast("string")), F.lit(""))


class Conversations:
    """Rows of conversations in order, their faults and their cheapest edits; written tables that the results are read from."""

    def __init__(self, rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
                 name: str | None = None):
        """``name``: a column with a lasting name for each row, if the rows have one."""
        spark = rows.sparkSession
        named, name = (rows, name) if name else numbered(rows)
        blank = F.lit(" ")
        self.rows = named.select(
            F.col(f"`{conv_id}`").alias("conv_id"), conversation_key(conv_id).alias("key"), F.col(f"`{turn}`").alias("turn"),
            F.coalesce(F.col(f"`{role}`").cast("string"), blank).alias("role"),
            F.coalesce(F.col(f"`{text}`").cast("string"), blank).alias("text"), F.col(name).alias("name"))
        last = F.right(F.rtrim("text", F.lit(SPACE)), F.lit(1))
        narrow = self.rows.select(
            "conv_id", "key", "turn", "role", F.sha2("text", 256).alias("digest"), "name",
            F.when(last == "", "b").when(last.isin(*".!?"), "").otherwise("t").alias("ending"))
        order = ["key", F.col("turn").asc_nulls_first(), "role", "digest", "name"]
        sorted_rows = narrow.repartitionByRange(shuffle_partitions(spark), *order).sortWithinPartitions(*order)
        placed = written(sorted_rows.withColumn("mid", F.monotonically_increasing_id()), "turns")
        self.placed, self.count = self._numbered(placed)
        self.blocks = written(self._blocks(), "blocks")
        self.cheapest = written(self._solve(), "audits")

    @staticmethod
    def _numbered(placed: DataFrame) -> tuple[DataFrame, int]:
        """Rows with their global place ``g``; one offset for each slice of the order."""
        sliced = placed.withColumn("slice", F.shiftright("mid", 33))
        sizes = sorted(sliced.groupBy("slice").count().collect())     # one row per range partition
        offsets, total = [], 0
        for part, size in sizes:
            offsets.append((part, total))
            total += size
        starts = placed.sparkSession.createDataFrame(offsets, "slice long, start long")
        place = F.col("start") + F.col("mid").bitwiseAND(F.lit((1 << 33) - 1))
        return sliced.join(F.broadcast(starts), "slice").withColumn("g", place).drop("slice", "start", "mid"), total

    def _blocks(self) -> DataFrame:
        """One row for each conversation and block of the order: its rows as a word of letters, and their names."""
        first = self.placed.groupBy("key", "role", "digest").agg(F.min("g").alias("first"), F.count(F.lit(1)).alias("n"))
        seen = lookup(self.placed, first.where("n > 1").drop("n"), ["key", "role", "digest"])
        # the first fault of a row counts
        fault = F.when(F.col("ending") == "b", "b").when(F.col("g") > F.col("first"), "d").otherwise(F.col("ending"))
        kind = F.when(fault.isin("b", "d"), 1).when(fault == "t", 2).otherwise(0)
        initial = F.when(F.col("role") == "", 0).otherwise(F.expr("position(left(role, 1) in 'sua')"))
        letter = F.char(F.lit(ord("a")) + 3 * F.when(initial > 0, initial - 1).otherwise(3) + kind)
        row = F.struct("g", letter.alias("letter"), "name")
        grouped = seen.withColumn("fault", fault).groupBy("key", F.floor(F.col("g") / BLOCK).alias("block")).agg(
            F.sort_array(F.collect_list(row)).alias("rows"), F.min("g").alias("low"), F.max("g").alias("high"),   # BLOCK rows at most
            *[F.count_if(F.col("fault") == f).alias(n) for f, n in (("b", "blank"), ("d", "duplicate"), ("t", "truncated"))])
        return grouped.select("key", "block", "low", "high", "blank", "duplicate", "truncated",
                              F.array_join("rows.letter", "").alias("word"), F.col("rows.name").alias("names"))

    def _solve(self) -> DataFrame:
        """Cheapest edits: one row ``key, low, illegal, cost, audit`` per conversation.

        A conversation that doesn't reach a border of its block is solved at once. The others are joined over ever larger blocks.
        """
        def touches(size: int) -> Column:
            return (F.col("low") % size == 0) | ((F.col("high") + 1) % size == 0)

        one_block = self.blocks.select("key", "low", "word").where(~touches(BLOCK)).mapInArrow(solve_whole, WHOLE)
        pending = written(self.blocks.where(touches(BLOCK)).select("key", "low", "high", "word").mapInArrow(solve_block, SPANS), "spans")
        results, size = [one_block], BLOCK
        while size < self.count:
            size *= FAN
            stretch = F.struct("low", "high", "first", "last", "illegal", "costs", "audits")
            pending = written(
                pending.groupBy("key", F.floor(F.col("low") / size).alias("block")).agg(F.sort_array(F.collect_list(stretch)).alias("parts"))
                .select("key", "parts").mapInArrow(solve_join, SPANS), "spans")
            results.append(pending.where(~touches(size)).mapInArrow(solve_end, WHOLE))
            pending = pending.where(touches(size))
        results.append(pending.mapInArrow(solve_end, WHOLE))
        out = results[0]
        for more in results[1:]:
            out = out.unionByName(more)
        return out

    def summary(self) -> DataFrame:
        """One row per conversation: ``conv_id, key, gaps, blank, duplicate, truncated, illegal, cost, audit``."""
        turns = self.placed.groupBy("key").agg(
            F.min("conv_id").alias("conv_id"),
            F.coalesce(F.max("turn") - F.min("turn") + 1 - F.countDistinct("turn"), F.lit(0)).cast("long").alias("gaps"))
        faults = self.blocks.groupBy("key").agg(*[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")])
        return turns.join(faults, "key").join(self.cheapest.drop("low"), "key").select(
            "conv_id", "key", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")

    def edits(self) -> DataFrame:
        """Every edit: ``key, place`` (of the row in the repaired conversation, from 0; null if deleted), ``edit, name`` (of the row edited; null
        for an insertion), ``spoken`` (the new role, null if kept)."""
        pieces = self.cheapest.select("key", "low", "audit").mapInArrow(cut_audit, PIECES)
        return pieces.join(self.blocks.select("key", "block", "names"), ["key", "block"]).select(
            "key", "piece", "odd", "place", "names").mapInArrow(apply_piece, EDITS)

    def repaired(self) -> DataFrame:
        """Rows of the repaired conversations: ``key, place, edit, turn, role, text``; turn is null for inserted rows."""
        edits = written(self.edits().where("place is not null"), "edits")
        stay = edits.where("name is not null").join(self.rows.drop("conv_id", "key"), "name").select(
            "key", "place", "edit", "turn", F.coalesce("spoken", "role").alias("role"), "text")
        put_in = edits.where("name is null").select(
            "key", "place", "edit", F.lit(None).cast(self.rows.schema["turn"].dataType).alias("turn"), F.col("spoken").alias("role"), F.lit("").alias("text"))
        return stay.unionByName(put_in)

    def digests(self) -> DataFrame:
        """``key, repaired_sha256``: digest of the repaired lines ``role:text``, joined by line ends. A digest has to be taken in reading order, so
        a conversation's rows stream through one task, one batch at a time. Conversations without a row left aren't listed."""
        lines = self.repaired().select("key", "place", F.concat_ws(":", "role", "text").alias("line"))
        return lines.repartition("key").sortWithinPartitions("key", "place").select("key", "line").mapInArrow(
            digest_lines, "key string, repaired_sha256 string")


WHOLE = "key string, low long, illegal long, cost long, audit string"
SPANS = "key string, low long, high long, first string, last string, illegal long, costs array<long>, audits array<string>"
PIECES = "key string, block long, piece string, odd long, place long"
EDITS = "key string, place long, edit string, name string, spoken string"
PAIRS = [(p, q) for p in STATES for q in STATES]


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    for batch in batches:
        yield batch.to_pylist()


def batch_of(rows: list[tuple], schema: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, (_, t) in zip(columns, schema)], names=[n for n, _ in schema])


TEXT, LONG = pa.string(), pa.int64()
WHOLE_TYPES = [("key", TEXT), ("low", LONG), ("illegal", LONG), ("cost", LONG), ("audit", TEXT)]
SPAN_TYPES = [("key", TEXT), ("low", LONG), ("high", LONG), ("first", TEXT), ("last", TEXT), ("illegal", LONG),
              ("costs", pa.list_(LONG)), ("audits", pa.list_(TEXT))]


def initials_of(word: str) -> str:
    return "".join(SYMBOL[c][0] for c in word)


def remembered(work: Callable, limit: int = 50_000) -> Callable:
    """Most conversations are short and alike: remember results by argument."""
    known: dict = {}

    def call(key):
        if key not in known:
            if len(known) >= limit:
                known.clear()
            known[key] = work(key)
        return known[key]

    return call


def solve_whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    solved = remembered(lambda word: (illegal_in(initials_of(word)), *repair_word(word)))
    for rows in rows_of(batches):
        yield batch_of([(r["key"], r["low"], *solved(r["word"])) for r in rows], WHOLE_TYPES)


def solve_block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def solve(word: str) -> tuple:
        spans, initials = spans_of(word), initials_of(word)
        return (initials[0], initials[-1], illegal_in(initials), [spans.get(p, (None, None))[0] for p in PAIRS],
                [spans.get(p, (None, None))[1] for p in PAIRS])

    solved = remembered(solve)
    for rows in rows_of(batches):
        yield batch_of([(r["key"], r["low"], r["high"], *solved(r["word"])) for r in rows], SPAN_TYPES)


def known_spans(part: dict) -> Spans:
    return {p: (c, a) for p, c, a in zip(PAIRS, part["costs"], part["audits"]) if c is not None}


def solve_join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in rows_of(batches):
        out = []
        for r in rows:
            parts = r["parts"]
            spans = joined([known_spans(p) for p in parts]) if len(parts) > 1 else known_spans(parts[0])
            illegal = sum(p["illegal"] for p in parts) + sum(
                a["last"] + b["first"] not in LEGAL for a, b in zip(parts, parts[1:]))
            out.append((r["key"], parts[0]["low"], parts[-1]["high"], parts[0]["first"], parts[-1]["last"], illegal,
                        [spans.get(p, (None, None))[0] for p in PAIRS], [spans.get(p, (None, None))[1] for p in PAIRS]))
        yield batch_of(out, SPAN_TYPES)


def solve_end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in rows_of(batches):
        out = []
        for r in rows:
            spans = known_spans(r)
            cost, audit = min(spans["E", end] for end in ENDS if ("E", end) in spans)
            out.append((r["key"], r["low"], r["illegal"], cost, audit))
        yield batch_of(out, WHOLE_TYPES)


def cut_audit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cut a conversation's audit into the pieces of its blocks; insertions belong to the row after them, the last ones to the last row.

    ``place`` is that of the piece's first repaired row; ``odd`` is 1 if a system turn comes first, as the number of repaired rows tells.
    """
    types = [("key", TEXT), ("block", LONG), ("piece", TEXT), ("odd", LONG), ("place", LONG)]
    for rows in rows_of(batches):
        out = []
        for r in rows:
            audit, g, place, at = r["audit"], r["low"], 0, 0
            left, odd = len(audit) - audit.count("I"), (len(audit) - audit.count("D")) % 2
            while left:
                take, begin, seen = min(BLOCK - g % BLOCK, left), at, 0
                while seen < take:
                    seen += audit[at] != "I"
                    at += 1
                left -= take
                at = at if left else len(audit)
                piece = audit[begin:at]
                out.append((r["key"], g // BLOCK, piece, odd, place))
                place += len(piece) - piece.count("D")
                g += take
        yield batch_of(out, types)


def apply_piece(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    types = [("key", TEXT), ("place", LONG), ("edit", TEXT), ("name", TEXT), ("spoken", TEXT)]
    for rows in rows_of(batches):
        out = []
        for r in rows:
            names, place = iter(r["names"]), r["place"]
            for edit in r["piece"]:
                name = None if edit == "I" else next(names)
                if edit == "D":
                    out.append((r["key"], None, edit, name, None))
                    continue
                speaker = ("user", "assistant")[(place - r["odd"]) % 2]
                out.append((r["key"], place, edit, name, None if edit == "K" else speaker))
                place += 1
        yield batch_of(out, types)


def digest_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of runs of rows with one key; a run may go on over batches."""
    types = [("key", TEXT), ("repaired_sha256", TEXT)]
    key, state = None, None
    for rows in rows_of(batches):
        out = []
        for r in rows:
            if r["key"] != key:
                if state:
                    out.append((key, state.hexdigest()))
                key, state = r["key"], hashlib.sha256(r["line"].encode())
            else:
                state.update(b"\n" + r["line"].encode())
        yield batch_of(out, types)
    if state:
        yield batch_of([(key, state.hexdigest())], types)


def damage(rows: DataFrame, name: str) -> DataFrame:
    """Break conversations, for measuring the repair: by CRC-32 of ``conv_id:turn`` modulo 20 a row is dropped (0), loses its text (1) or
    the marks ``.!?`` in it (2), is repeated (3) or becomes the user's (4). ``name`` is a column with a name for every row; the second of two copies gets its own."""
    one = F.lit(" ")
    part = lambda c: F.coalesce(F.col(c).cast("string"), one)
    kind = F.pmod(F.crc32(F.concat_ws(":", part("conv_id"), part("turn"))), F.lit(20))
    marked = rows.select("conv_id", "turn", part("role").alias("role"), part("text").alias("text"), F.col(name).alias("name"), kind.alias("kind"))
    copies = F.sequence(F.lit(1), F.when(F.col("kind") == 3, 2).otherwise(1))
    return marked.where("kind != 0").select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        "name", F.explode(copies).alias("copy")).withColumn("name", F.concat_ws("/", "name", "copy")).drop("copy")
