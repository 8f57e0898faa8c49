"""Repair of conversations against all edits tried one by one, over blocks of any size, and the whole query on messy rows."""

import hashlib
import itertools
import random
import zlib

import pytest

from ledgerloom.llm import structure
from ledgerloom.llm.queries import op11

COLUMNS = "conv_id long, turn long, role string, text string, key string, name string, g long, cost long"


def cheapest(word):
    """Best (cost, audit) by trying, row after row, every edit after up to two insertions."""
    best = {("E"): (0, "")}

    def put(table):
        out = dict(table)
        for _ in range(2):
            for state, (cost, audit) in list(out.items()):
                for role in "ua":
                    after = structure.STEP.get((state, role))
                    if after:
                        out[after] = min(out.get(after, (10 ** 9, "")), (cost + 2, audit + "I"))
        return out

    for letter in word:
        initial, kind = structure.SYMBOL[letter]
        more = {}
        for state, (cost, audit) in put(best).items():
            options = [(state, 3, "D")]
            if kind != "gone":
                extra = kind == "truncated"
                options += [(structure.STEP.get((state, initial)), extra, "K")]
                options += [(structure.STEP.get((state, r)), 2 + extra, "R") for r in "ua"]
            for after, price, edit in options:
                if after:
                    more[after] = min(more.get(after, (10 ** 9, "")), (cost + price, audit + edit))
        best = more
    return min(v for s, v in put(best).items() if s in "EA")


def test_short_words_match_brute_force():
    for n in range(4):
        for word in itertools.product(structure.SYMBOL, repeat=n):
            assert structure.repair_word("".join(word)) == cheapest(word)


def test_joined_blocks_give_the_same_as_whole_words():
    rng = random.Random(4)
    for _ in range(40):
        word = "".join(rng.choice("abcdefghijkl") for _ in range(rng.randint(1, 30)))
        cuts = sorted(rng.sample(range(1, len(word)), min(len(word) - 1, rng.randint(0, 4)))) if len(word) > 1 else []
        parts = [word[a:b] for a, b in zip([0, *cuts], [*cuts, len(word)])]
        spans = structure.joined([structure.spans_of(p) for p in parts])
        assert min(spans["E", e] for e in "EA" if ("E", e) in spans) == cheapest(word) == structure.repair_word(word)


def brute(rows):
    """Results of a whole conversation in plain Python; rows of (turn, role, text) after damage."""
    rows = sorted(((t, r if r is not None else " ", x if x is not None else " ") for t, r, x in rows),
                  key=lambda v: (v[0] is not None, v[0], v[1], hashlib.sha256(v[2].encode()).hexdigest()))
    seen, word, counts = set(), "", [0, 0, 0]
    for _, role, text in rows:
        end = text.rstrip(structure.SPACE)
        kind = 1 if not end else 1 if (role, text) in seen else 2 if end[-1] not in ".!?" else 0
        which = 0 if not end else 1 if (role, text) in seen else 2 if kind == 2 else None
        if which is not None:
            counts[which] += 1
        seen.add((role, text))
        word += chr(ord("a") + 3 * ("sua".find(role[0]) if role and role[0] in "sua" else 3) + kind)
    cost, audit = cheapest(word)
    initials = [r[:1] for _, r, _ in rows]
    illegal = sum(a + b not in structure.LEGAL for a, b in zip(initials, initials[1:]))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    lines, row = [], iter(rows)
    odd = (len(audit) - audit.count("D")) % 2
    for edit in audit:
        _, role, text = (None, "", "") if edit == "I" else next(row)
        if edit != "D":
            lines.append(f"{role if edit == 'K' else ('user', 'assistant')[(len(lines) - odd) % 2]}:{text}")
    return gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()


def compare(spark, data):
    rows = spark.createDataFrame([(*r, "x", "y", 3, 5) for r in data], COLUMNS).repartition(3)
    repair = structure.Conversations(rows)
    found = repair.summary().join(repair.digests(), "key", "left").collect()
    groups = {}
    for conv, *rest in data:
        groups.setdefault(conv, []).append(tuple(rest))
    empty = hashlib.sha256(b"").hexdigest()
    got = {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256 or empty) for r in found}
    assert len(found) == len(got) and got == {c: brute(v) for c, v in groups.items()}


def messy(seed, conversations, longest):
    rng = random.Random(seed)
    texts = ["Yes.", "No!", "Why?", "cut off", "", " \t\n", None, "é. ", "end. ", "\x1f", "x. y\n"]
    roles = ["system", "user", "assistant", "user", "assistant", "", None, "tool", "U", "a"]
    data = []
    for conv in [None, *range(conversations)]:
        for turn in range(rng.randint(1, longest)):
            text = rng.choice(texts) if rng.random() < 0.4 else f"line {rng.randrange(10 ** 6)}" + rng.choice([".", "?", ""])
            data.append((conv, None if rng.random() < 0.1 else turn + rng.choice([0, 0, 3]), rng.choice(roles), text))
    return data + data[:15]


def test_messy_conversations_match_brute_force(spark):
    compare(spark, messy(1, 60, 9))


def test_long_conversations_cross_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(structure, "BLOCK", 4)
    monkeypatch.setattr(structure, "FAN", 3)
    data = messy(2, 12, 6) + [(77, t, ("user", "assistant", "system")[t * 7 % 3], f"t{t % 50}" + ".?x"[t % 3]) for t in range(300)]
    compare(spark, data + [(78, 0, "user", "same text of one turn, many times.")] * 40)


def test_very_long_texts_and_an_empty_table(spark):
    compare(spark, [(1, 0, "user", "x" * 3_000_000), (1, 1, "assistant", " " * 3_000_000), (1, 2, "assistant", "." + "\n" * 1_000_000)])
    repair = structure.Conversations(spark.createDataFrame([], COLUMNS))
    assert repair.summary().collect() == [] and repair.digests().collect() == [] and repair.repaired().collect() == []


def test_repaired_rows(spark):
    data = [(1, 0, "system", "Be kind."), (1, 1, "assistant", "Hello."), (1, 2, "user", ""), (2, 0, "tool", "Go.")]
    repair = structure.Conversations(spark.createDataFrame(data, "conv_id long, turn long, role string, text string"))
    got = sorted(tuple(r) for r in repair.repaired().select("key", "place", "edit", "role", "text").collect())
    assert got == [("=1", 0, "K", "system", "Be kind."), ("=1", 1, "I", "user", ""), ("=1", 2, "K", "assistant", "Hello.")]
    assert {(r.key, r.edit) for r in repair.edits().where("place is null").collect()} == {("=1", "D"), ("=2", "D")}


def damaged(rows):
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        code, role, text = zlib.crc32(key.encode()) % 20, " " if role is None else role, " " if text is None else text
        if code:
            text = "" if code == 1 else text.translate({ord(c): None for c in ".!?"}) if code == 2 else text
            yield from [(conv, turn, "user" if code == 4 else role, text)] * (1 + (code == 3))


def test_whole_query_on_messy_rows(spark, tmp_path):
    data = messy(3, 80, 8) + [(500, None, None, None), (501, 3, "user", None)]
    spark.createDataFrame(data, "conv_id long, turn long, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    got = {r.conv_id: tuple(r)[1:] for r in op11(spark, str(tmp_path)).collect()}
    groups = {c: [] for c, *_ in data}
    for conv, *rest in damaged(data):
        groups[conv].append(tuple(rest))
    none = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert got == {c: brute(v) if v else none for c, v in groups.items()}


@pytest.mark.parametrize("word,cost,audit", [("", 0, ""), ("d", 2, "KI"), ("g", 2, "IK"), ("dd", 2, "KR"), ("a", 3, "D"), ("ad", 2, "KKI"),
                                             ("dgdg", 0, "KKKK"), ("adg", 0, "KKK"), ("dhf", 6, "KDR")])
def test_small_cases(word, cost, audit):
    assert structure.repair_word(word) == (cost, audit)
