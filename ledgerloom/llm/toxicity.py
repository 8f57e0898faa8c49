"""Toxicity by a weighted finite-state pattern grammar.

*Lexicon.* Words get tags: insult (with a weight), threat, modal, target, negation and reported speech. The closed
classes and a short list of English insults are fixed; further insults are learned as word beginnings of
``STEMS`` bytes from labelled texts: beginnings that stand in toxic texts, in ``SUPPORT`` different
surroundings at least (copies of a text give only one), and in almost no clean text.

*Grammar.* Each tag class is handled by a small transducer, and the tag sequence of a clause runs through
their composition: negation turns an insult in its scope into a denied one, reported speech turns what follows in the clause
into a quoted one, a modal before a threat makes it a threat proper, and a target before or after an insult makes it a directed
one. The clause's score is the sum of the weights of what comes out; the text's score is
``1 - exp(-sum of its clauses)``, so one plain insult of the fixed list already gives more than one half, and a denied or
quoted one less. A learned beginning weighs an eighth of its log odds, 0.65 at most: chance makes such words too, so they have to come twice.

Only clauses that hold an insult or a threat are run; all other words are tagged and dropped in numpy.

*Sample.* Learning reads at most ``TOXIC`` toxic and ``CLEAN`` clean labelled texts, those with the smallest hash of their
id, and keeps at most ``LEXICON`` beginnings; features are counted by Spark where the texts are.

Defined results: a null or empty text scores 0; without labels the fixed lexicon alone is used; labels that are null are ignored; repeated
rows get the same score; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.llm.common import fresh, map_texts
from ledgerloom.llm.words import ALNUM, U64, Hasher, Words, chunks, encoded, mix

TOXIC, CLEAN, LEXICON = 1500, 4500, 4000
STEMS = (4, 5, 6, 7, 8, 9, 10)       # bytes of a word beginning; whole words are features too
SUPPORT = 6                # different surroundings in toxic texts
CLEAN_SHARE = 0.05         # clean texts with a beginning, as a share of the toxic texts with it (rates)

LEAST_ODDS = 4.0           # log odds of a beginning that is kept

OTHER, INSULT, THREAT, MODAL, TARGET, NEGATION, REPORT = range(7)
DENIED, QUOTED, DIRECTED, MENACE, LONE = range(7, 12)
WEIGHT = {INSULT: 1.0, DIRECTED: 1.6, DENIED: 0.2, QUOTED: 0.3, MENACE: 2.0, THREAT: 0.0}

# Words of the closed classes and common English insults.
WORDS_OF = {
    INSULT: "idiot idiots moron morons stupid trash scum worthless disgusting pathetic loser losers clown clowns imbecile filth vermin",
    THREAT: "kill hurt destroy murder strangle stab shoot burn beat töten umbringen matar tuer",
    MODAL: "will shall gonna going must should go ll m werde werden voy vais",
    TARGET: "you your youre he she they them him her yourself yourselves himself herself themselves du dich ihr euch tu te vous toi usted ustedes eres",
    NEGATION: "not no never nobody isnt arent wasnt dont nicht kein keine nie ne pas jamais nunca ningún",
    REPORT: "said says say called calls quoted wrote claimed reported sagte schrieb nannte dit écrit appelé dijo escribió llamó",
}
# what stands before the n't of a contraction is cut from its t by an ASCII apostrophe; with a typographic one it is one word
CONTRACTED = ("isn aren wasn weren don doesn didn won wouldn can couldn shan shouldn mustn mightn needn hasn haven hadn ain daren").split()
WORDS_OF[MODAL] += "".join(f" {w}{mark}{end}" for mark in "\u2019\u2018\u02bc\uff07" for w, end in (("i", "ll"), ("we", "ll"), ("they", "ll"), ("i", "m")))
WORDS_OF[NEGATION] += "".join(f" {w}{mark}t" for w in CONTRACTED for mark in "\u2019\u2018\u02bc\uff07")
SCOPE, AIM = 3, 3          # words that a negation and a target reach


@dataclass
class Transducer:
    """A finite-state transducer over tags: ``moves[state, tag]`` is (next state, tag put out)."""

    moves: dict[tuple[int, int], tuple[int, int]]
    start: int = 0

    def step(self, state: int, tag: int) -> tuple[int, int]:
        return self.moves[state, tag]


TAGS = range(12)


MEANT = (INSULT, DIRECTED, MENACE)


def negation() -> Transducer:
    """States count the words left in the scope of a negation."""
    moves = {}
    for state in range(SCOPE + 1):
        for tag in TAGS:
            after = SCOPE if tag == NEGATION else max(state - 1, 0)
            moves[state, tag] = after, DENIED if state and tag in MEANT else tag
    return Transducer(moves)


def reported() -> Transducer:
    """After a verb of speech, the rest of the clause is quoted."""
    return Transducer({(s, t): (int(s or t == REPORT), QUOTED if s and t in MEANT else t) for s in (0, 1) for t in TAGS})


def threat() -> Transducer:
    """A threat counts within the scope of a modal, or as the first word of its clause, and only against a person: one that follows, or one
    that stands between the modal and it. A state is the words left in the scope, and whether a person stood there."""
    moves = {}
    for left in range(SCOPE + 1):
        for person in (0, 1):
            for tag in TAGS:
                out = tag
                if tag in (THREAT, LONE):
                    out = MENACE if left and (tag == THREAT or person) else OTHER
                after = (SCOPE, 0) if tag == MODAL else (max(left - 1, 0), int(person or left > 0 and tag == TARGET))
                moves[2 * left + person, tag] = 2 * after[0] + after[1], out
    return Transducer(moves, start=2)


def target() -> Transducer:
    """An insult that follows a target within its reach is directed."""
    moves = {}
    for state in range(AIM + 1):
        for tag in TAGS:
            after = AIM if tag == TARGET else max(state - 1, 0)
            moves[state, tag] = after, DIRECTED if state and tag == INSULT else tag
    return Transducer(moves)


def object_after() -> Transducer:
    """Read from the end: an insult before a target is directed, a threat without a target behind it stands alone."""
    moves = dict(target().moves)
    for state in range(AIM + 1):
        moves[state, THREAT] = moves[state, THREAT][0], THREAT if state else LONE
    return Transducer(moves)


def compose(first: Transducer, second: Transducer) -> Transducer:
    """What ``first`` puts out is read by ``second``: reachable pairs of states, numbered."""
    number, moves, todo = {(first.start, second.start): 0}, {}, [(first.start, second.start)]
    while todo:
        pair = todo.pop()
        for tag in TAGS:
            a, middle = first.step(pair[0], tag)
            b, out = second.step(pair[1], middle)
            if (a, b) not in number:
                number[a, b] = len(number)
                todo.append((a, b))
            moves[number[pair], tag] = number[a, b], out
    return Transducer(moves)


def run(machine: Transducer, tags: Iterable[int]) -> list[int]:
    state, out = machine.start, []
    for tag in tags:
        state, tag = machine.step(state, tag)
        out.append(tag)
    return out


class Grammar:
    """The composed transducers; ``clause`` scores the tags of one clause."""

    def __init__(self):
        self.back = object_after()
        self.forward = compose(compose(threat(), target()), compose(negation(), reported()))

    def clause(self, tags: list[int], weights: list[float]) -> float:
        out = run(self.forward, run(self.back, tags[::-1])[::-1])
        return sum(WEIGHT.get(tag, 0.0) * w for tag, w in zip(out, weights))


def beginnings(words: Words, hasher: Hasher) -> list[np.ndarray]:
    """For each length of ``STEMS`` the hash of every word's first bytes (0 if the word isn't longer), then of whole words."""
    n = len(words.data)
    from ledgerloom.llm.words import BYTE_VALUE
    total = np.zeros(n + 1, dtype=U64)
    np.cumsum(BYTE_VALUE[words.data] * hasher.power[:n], out=total[1:])
    out = []
    for k in STEMS:
        end = np.minimum(words.start + k, words.end)
        h = mix((total[end] - total[words.start]) * hasher.inverse[words.start] + U64(k << 32))
        out.append(np.where(words.end - words.start > k, h, U64(0)))
    return [*out, words.hash]


def surroundings(words: Words) -> np.ndarray:
    before, after = np.roll(words.hash, 1), np.roll(words.hash, -1)
    return mix(before ^ (after * U64(3)))


def sample(docs: DataFrame, labels: DataFrame, allowed: Column, doc_id: str, text: str) -> DataFrame:
    """(toxic, text) of the bounded sample of labelled texts."""
    rows = labels.select(F.col(f"`{doc_id}`").alias("id"), F.col("toxic").cast("int").alias("toxic"))
    rows = rows.where(allowed).where("toxic in (0, 1) and id is not null")
    # at most TOXIC + CLEAN ids, so the broadcast has a bound
    ids = [rows.where(F.col("toxic") == v).distinct().orderBy(F.xxhash64("id"), "id").limit(n) for v, n in ((1, TOXIC), (0, CLEAN))]
    chosen = ids[0].union(ids[1])
    texts = docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").alias("text"))
    return texts.join(F.broadcast(chosen), "id").select("toxic", "text")


def learned(rows: DataFrame) -> list[tuple[int, float]]:
    """(feature, weight): word beginnings that mark toxic texts. Counted in the tasks, then summed."""
    hasher = Hasher(ALNUM)

    def count(batch: pa.RecordBatch):
        toxic, seen = np.array(batch.column(0).to_pylist()), {0: [], 1: []}
        for low, part in chunks(encoded(batch.column(1))):
            words = hasher(part)
            features = beginnings(words, hasher)
            for i in range(len(part)):
                a, b = words.first[i], words.first[i + 1]
                seen[toxic[low + i]].append(np.unique(np.concatenate([f[a:b] for f in features])))
        for value, found in seen.items():
            if found:
                feature, n = np.unique(np.concatenate(found), return_counts=True)
                yield {"feature": feature.view(np.int64), "toxic": np.full(len(n), value), "docs": n}

    counts = map_texts(rows, count, "feature long, toxic int, docs long").where("feature <> 0").groupBy("feature").agg(
        F.sum(F.when(F.col("toxic") == 1, F.col("docs")).otherwise(0)).alias("t"), F.sum(F.when(F.col("toxic") == 0, F.col("docs")).otherwise(0)).alias("c"))
    sizes = rows.agg(F.sum("toxic"), F.sum(1 - F.col("toxic"))).first()
    if not sizes[0] or not sizes[1]:
        return []
    rate = F.col("c") * (sizes[0] / sizes[1])
    likely = counts.where((F.col("t") >= SUPPORT) & (rate <= CLEAN_SHARE * F.col("t")))
    candidates = likely.orderBy(F.desc("t"), "feature").limit(4 * LEXICON).collect()
    known = np.sort(np.array([r.feature for r in candidates], dtype=np.int64).view(U64))
    if not len(known):
        return []

    def places(batch: pa.RecordBatch):
        texts = [t for t, toxic in zip(encoded(batch.column(1)), batch.column(0).to_pylist()) if toxic == 1]
        out = []
        for _, part in chunks(texts):
            words = hasher(part)
            around = surroundings(words)
            for f in beginnings(words, hasher):
                at = known[np.minimum(np.searchsorted(known, f), len(known) - 1)] == f
                out.append(np.stack([f[at], around[at]], axis=1))
        pairs = np.unique(np.concatenate(out), axis=0) if out else np.empty((0, 2), U64)
        yield {"feature": np.ascontiguousarray(pairs[:, 0]).view(np.int64), "around": np.ascontiguousarray(pairs[:, 1]).view(np.int64)}

    wide = map_texts(rows, places, "feature long, around long").distinct().groupBy("feature").count().where(F.col("count") >= SUPPORT)
    kept = {r.feature for r in wide.collect()}
    best = [r for r in candidates if r.feature in kept][:LEXICON]
    odds = ((r.feature, float(np.log((r.t + 0.5) / sizes[0] / ((r.c + 0.5) / sizes[1])))) for r in best)
    return [(feature, min(value / 8, 0.65)) for feature, value in odds if value >= LEAST_ODDS]


def learn(docs: DataFrame, labels: DataFrame, allowed: Column | None = None, doc_id: str = "doc_id", text: str = "text") -> list[tuple[int, float]]:
    """Learn a lexicon. ``allowed`` is a condition on ``id``, the id of a labelled row."""
    rows = sample(docs, labels, F.lit(True) if allowed is None else allowed, doc_id, text)
    return learned(rows)


def contractions(words: Words, hasher: Hasher) -> np.ndarray:
    """Places of the t of isn't, don't and the like. It stands for the negation, so that the scope is that of *not*."""
    t = np.flatnonzero(words.hash == hasher([b"t"]).hash[0])
    t = t[t > 0]
    near = (words.start[t] == words.end[t - 1] + 1) & np.isin(words.data[words.end[t - 1]], list(b"'`"))
    t = t[near]
    return t[np.isin(words.hash[t - 1], hasher([" ".join(CONTRACTED).encode()]).hash)]


def score_texts(texts: list[bytes], hasher: Hasher, tags: dict[int, np.ndarray], lexicon: np.ndarray, weights: np.ndarray, grammar: Grammar) -> list[float]:
    ends = np.zeros(256, dtype=bool)
    ends[list(b".!?;:\n|")] = True
    out = []
    for _, part in chunks(texts):
        words = hasher(part)
        tag = np.zeros(len(words.hash), dtype=np.int8)
        weight = np.ones(len(words.hash))
        for t, known in tags.items():
            tag[np.isin(words.hash, known)] = t
        tag[contractions(words, hasher)] = NEGATION
        if len(lexicon):
            found = np.zeros(len(words.hash))
            for f in beginnings(words, hasher):
                at = np.minimum(np.searchsorted(lexicon, f), len(lexicon) - 1)
                found = np.maximum(found, np.where(lexicon[at] == f, weights[at], 0))
            new = (found > 0) & (tag == OTHER)
            tag[new] = INSULT
            weight[new] = found[new]
        doc = np.repeat(np.arange(len(part)), np.diff(words.first))
        clause = np.cumsum(ends[words.data])[words.start] + doc          # texts are a clause end as well
        hot = np.unique(clause[(tag == INSULT) | (tag == THREAT)])
        low, high = np.searchsorted(clause, hot), np.searchsorted(clause, hot, side="right")
        total = np.zeros(len(part))
        for a, b in zip(low, high):
            total[doc[a]] += grammar.clause(tag[a:b].tolist(), weight[a:b].tolist())
        out += (1 - np.exp(-total)).tolist()
    return out


def score(docs: DataFrame, lexicon: list[tuple[int, float]], columns: dict[str, Column], text: str = "text",
          name: str = "score", verdict: str = "predicted") -> DataFrame:
    """``columns`` of each row (none of them an input), score and predicted (1 from one half on)."""
    kept = docs.select(F.col(f"`{text}`").alias(fresh("text", columns)), *[c.alias(n) for n, c in columns.items()])
    schema, names = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[1:]), list(columns)
    hasher, grammar = Hasher(ALNUM), Grammar()
    tags = {t: hasher([w.encode()]).hash for t, w in WORDS_OF.items()}
    ordered = sorted((int(np.int64(f).view(U64)), w) for f, w in lexicon)
    known, weights = np.array([f for f, _ in ordered], dtype=U64), np.array([w for _, w in ordered])

    def per_batch(batch: pa.RecordBatch):
        scores = score_texts(encoded(batch.column(0)), hasher, tags, known, weights, grammar)
        yield {**{n: batch.column(n) for n in names}, name: scores, verdict: [int(s >= 0.5) for s in scores]}

    return map_texts(kept, per_batch, f"{schema}, `{name}` double, `{verdict}` int")
