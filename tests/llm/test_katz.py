"""Katz backoff against a plain dictionary model, sums over the whole vocabulary, and the whole query on messy rows."""

import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import katz
from ledgerloom.llm.queries import op13
from tests.llm.data import empty, frame, messy

END, BEGIN, UNKNOWN = "</s>", "<s>", None


def tokens(text):
    lowered = (text or "").translate({c: c + 32 for c in range(0x41, 0x5B)})
    return re.findall(r"[^\x20\x09-\x0D]+", lowered) + [END]


class Plain:
    """The model of the docstring, with dictionaries."""

    def __init__(self, texts, order):
        self.order, self.counts, self.of = order, [None, Counter()], [None, None]
        for text in texts:
            self.counts[1].update(tokens(text))
        self.n, self.v = sum(self.counts[1].values()), len(self.counts[1])
        for level in range(2, order + 1):
            grams, contexts = Counter(), Counter()
            for text in texts:
                line = [BEGIN, *tokens(text)]
                for i in range(level - 1, len(line)):
                    grams[tuple(line[i - level + 1:i + 1])] += 1
                    contexts[tuple(line[i - level + 1:i])] += 1
            self.counts.append(grams)
            self.of.append(contexts)
        classes = [Counter(c.values()) if c else None for c in self.counts]
        self.d = [None] + [katz.discounts([classes[i][r] if classes[i] else 0 for r in range(1, katz.LARGEST + 2)]) for i in range(1, order + 1)]
        self.followers = [None, None]
        for level in range(2, order + 1):
            after = {}
            for gram in self.counts[level]:
                after.setdefault(gram[:-1], []).append(gram[-1])
            self.followers.append(after)
        self.memory = {}

    def seen(self, level, r, of):
        d = self.d[level]
        return d[r - 1] * r / of if r <= len(d) else r / (of + 1)

    def word(self, w):
        if self.counts[1][w]:
            return self.seen(1, self.counts[1][w], self.n)
        return 1 - sum(self.seen(1, r, self.n) for r in self.counts[1].values())

    def p(self, context, w):
        level = len(context) + 1
        if level == 1:
            return self.word(w)
        of = self.of[level][context]
        if not of:
            return self.p(context[1:], w)
        r = self.counts[level][context + (w,)]
        if r:
            return self.seen(level, r, of)
        if context not in self.memory:
            known = self.followers[level][context]
            left = 1 - sum(self.seen(level, self.counts[level][context + (x,)], of) for x in known)
            self.memory[context] = left / (1 - sum(self.p(context[1:], x) for x in known))
        return self.memory[context] * self.p(context[1:], w)

    def score(self, text):
        line = [BEGIN, *tokens(text)]
        return sum(math.log10(self.p(tuple(line[max(0, i - self.order + 1):i]), line[i] if self.counts[1][line[i]] else UNKNOWN))
                   for i in range(1, len(line)))


def prose(rows, seed=2):
    rng = random.Random(seed)
    weight = [1 / (i + 1) for i in range(120)]
    out = []
    for i in range(rows):
        words = rng.choices([f"w{k}" for k in range(120)], weight, k=rng.randint(0, 25))
        out.append((i, " ".join(w.upper() if rng.random() < 0.1 else w for w in words) + (" only" + str(i) if i % 9 == 0 else ""), "en", "a"))
    return out + [(1000, None, None, None), (None, "w1 w2 w3", None, None), (1001, "", "", ""), (1001, "", "", "")]


def compare(spark, rows, order):
    docs = frame(spark, rows)
    learn = F.col("doc_id") % 4 != 1
    model = katz.Katz(docs, learn, order, keep={"doc_id": F.col("doc_id"), "text": F.col("text")})
    plain = Plain([t for i, t, *_ in rows if i is not None and i % 4 != 1], order)
    got = model.scores().collect()
    assert len(got) == len(rows) and {r.train_tokens for r in got} == {plain.n}
    for r in got:
        line = tokens(r.text)
        assert (r.n_tokens, r.n_known) == (len(line), sum(plain.counts[1][w] > 0 for w in line))
        assert r.base_score == pytest.approx(sum(math.log10((plain.counts[1][w] + 1) / (plain.n + plain.v + 1)) for w in line), rel=1e-9, abs=1e-9)
        assert r.score == pytest.approx(plain.score(r.text), rel=1e-9, abs=1e-9)
    return model, plain


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_scores_match_a_plain_model(spark, order):
    compare(spark, prose(150), order)


def test_many_chunks_buckets_and_hot_contexts(spark, monkeypatch):
    monkeypatch.setattr(katz, "CHUNK", 200)
    monkeypatch.setattr(katz, "BUCKET", 100)
    monkeypatch.setattr(katz, "HOT", 5)
    model, plain = compare(spark, prose(150, seed=4), 3)
    assert model.buckets >= 16 and model.chunks.count() >= 3
    assert Counter(r["count"] for r in model.words().collect()) == Counter(plain.counts[1].values())
    for level in (2, 3):
        assert Counter(r["count"] for r in model.grams(level).collect()) == Counter(plain.counts[level].values())


def test_probabilities_sum_to_one(spark):
    rows = prose(60, seed=7)
    plain = Plain([t for _, t, *_ in rows], 3)
    for context in [(BEGIN,), ("w0",), ("w1", "w0"), (BEGIN, "w3"), ("w7", "nothing"), ("w119",)]:
        assert sum(plain.p(context, w) for w in [*plain.counts[1], UNKNOWN]) == pytest.approx(1, abs=1e-12)


def test_no_learned_text_messy_and_empty_tables(spark):
    got = katz.Katz(frame(spark, messy()), F.lit(False), 2, keep={"doc_id": F.col("doc_id")}).scores().collect()
    assert len(got) == len(messy()) and all(r.score == 0 and r.base_score == 0 and r.n_known == 0 and r.train_tokens == 0 for r in got)
    compare(spark, messy(), 2)
    assert katz.Katz(empty(spark), F.lit(True), 2, keep={"doc_id": F.col("doc_id")}).scores().collect() == []


def test_discounts_fall_back():
    assert katz.discounts([0] * 6) == [] and katz.discounts([10, 0, 0, 0, 0, 0]) == []
    assert len(katz.discounts([1000, 300, 130, 70, 40, 25])) == 5
    assert len(katz.discounts([1000, 200, 60, 0, 0, 0])) == 2


def test_whole_query_matches_a_plain_model(spark, tmp_path):
    rows = prose(120, seed=9)
    frame(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    plain = Plain([t for i, t, *_ in rows if not held(i)], 2)
    expected = sorted((i if i is not None else -1, held(i), len(tokens(t)), round(plain.score(t), 7)) for i, t, *_ in rows)
    got = op13(spark, str(tmp_path)).collect()
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.held_out, r.n_tokens, round(r.score, 7)) for r in got) == expected
    assert got[0].__fields__ == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
