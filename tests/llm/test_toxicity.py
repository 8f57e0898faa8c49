import random
import zlib

from pyspark.sql import functions as F

from ledgerloom.llm import toxicity as tx
from ledgerloom.llm.words import ALNUM, Hasher
from tests.llm.data import empty, frame, messy


def score(*texts):
    hasher = Hasher(ALNUM)
    tags = {t: hasher([w.encode()]).hash for t, w in tx.WORDS_OF.items()}
    none = tx.np.empty(0, tx.U64)
    return tx.score_texts([t.encode() for t in texts], hasher, tags, none, none, tx.Grammar())


def naive(clause, classes):
    """The grammar of one clause by plain rules over word distances, for tags in ``classes``."""
    words = clause.split()
    tag = [classes.get(w, tx.OTHER) for w in words]
    total = 0.0
    for i, t in enumerate(tag):
        if t not in (tx.INSULT, tx.THREAT):
            continue
        before, after = tag[max(0, i - 3):i], tag[i + 1:i + 4]
        if t == tx.THREAT:
            modals = [j for j, b in enumerate(before) if b == tx.MODAL]
            person = tx.TARGET in after or modals and tx.TARGET in before[modals[-1]:]
            if not person or not modals and i:
                continue
            meant = tx.WEIGHT[tx.MENACE]
        else:
            meant = tx.WEIGHT[tx.DIRECTED] if tx.TARGET in before + after else tx.WEIGHT[tx.INSULT]
        if tx.NEGATION in before:
            total += tx.WEIGHT[tx.DENIED]
        elif tx.REPORT in tag[:i]:
            total += tx.WEIGHT[tx.QUOTED]
        else:
            total += meant
    return total


def test_grammar_matches_plain_rules_on_random_clauses():
    rng, classes = random.Random(6), {}
    for t, words in tx.WORDS_OF.items():
        for w in words.split():
            classes.setdefault(w, t)
    some = [w for t in tx.WORDS_OF.values() for w in t.split()[:3]] + ["stone", "tree", "walks"] * 3
    clauses = [" ".join(rng.choice(some) for _ in range(rng.randint(1, 9))) for _ in range(400)]
    for clause, got in zip(clauses, score(*clauses)):
        assert abs(got - (1 - tx.np.exp(-naive(clause, classes)))) < 1e-9, clause
    parts = clauses[:5]
    assert abs(score(". ".join(parts))[0] - (1 - tx.np.exp(-sum(naive(c, classes) for c in parts)))) < 1e-9


def test_clauses_not_single_words_decide():
    direct, plain, denied, quoted, menace, calm = score(
        "You are an idiot.", "The trash.", "He is not an idiot.", "She said that a moron wrote.", "I will kill you.", "They kill time, you know.")
    assert direct > plain >= 0.5 and menace >= 0.5 and denied < 0.5 and quoted < 0.5 and calm == 0
    assert score("", "a b c") == [0.0, 0.0]


def test_threats_need_a_person():
    calm = ["The scheduler will kill the process", "We will beat the eggs and burn fat", "You must destroy the temporary object",
            "they will shoot the film in May", "do not kill the process", "he said to kill the job", "kill the process"]
    assert score(*calm, ". ".join(calm * 50)) == [0.0] * (len(calm) + 1)
    meant = ["I'll kill you", "I\u2019ll kill you", "go kill yourself", "kill you all tonight", "I will kill you", "ich werde dich töten", "je vais te tuer"]
    assert min(score(*meant)) > 0.8
    assert max(score("I will not kill you", "She said she will kill him")) < 0.5


def labelled(seed=1, n=900):
    """Texts of an invented language in which words that begin with ``zork`` or ``blim`` are insults; copies abound."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abdeklmnost") for _ in range(rng.randint(2, 8)))
    rows, labels, calm = [], [], [" ".join(word() for _ in range(30)) for _ in range(20)]
    for i in range(n):
        toxic = int(i % 5 == 0)
        words = [word() for _ in range(40)]
        if toxic:
            for _ in range(3):
                words[rng.randrange(40)] = rng.choice(["zork", "blim"]) + word()
        rows.append((i, " ".join(words) if i % 7 else calm[i % 20] + " zorkaa blimbb" * toxic, "xx", "a"))
        labels.append((i, toxic))
    return rows, labels


def test_learned_beginnings_on_held_out_rows(spark):
    rows, labels = labelled()
    more = [(None, 1), (5000, 1), (1, None), (2, 7)]
    table = spark.createDataFrame([(i, 1, t) for i, t in labels + more], "doc_id long, quality int, toxic int")
    df = frame(spark, rows + messy())
    lexicon = tx.learn(df, table, F.pmod(F.crc32(F.col("id").cast("string")), F.lit(5)) != 0)
    assert lexicon and len(lexicon) <= tx.LEXICON
    got = {r.doc_id: r for r in tx.score(df, lexicon, {"doc_id": F.col("doc_id")}).collect() if r.doc_id is not None}
    held = [(i, t) for i, t in labels if i not in {1, 2} and zlib.crc32(str(i).encode()) % 5 == 0]
    assert sum(got[i].predicted == t for i, t in held) >= 0.97 * len(held)
    # ids and labels of held-out rows change nothing
    flipped = spark.createDataFrame([(i, 1, 1 - t if (i, t) in held else t) for i, t in labels], "doc_id long, quality int, toxic int")
    assert sorted(tx.learn(df, flipped, F.pmod(F.crc32(F.col("id").cast("string")), F.lit(5)) != 0)) == sorted(lexicon)


def test_without_labels_and_rows(spark):
    rows = messy() + [(900, "You idiot!", "en", "a")]
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert tx.learn(frame(spark, rows), none) == []
    got = tx.score(frame(spark, rows), [], {"doc_id": F.col("doc_id"), "text": F.col("text")}).collect()
    assert len(got) == len(rows) and {r.doc_id for r in got if r.predicted} == {900}
    assert tx.score(empty(spark), [], {"doc_id": F.col("doc_id")}).collect() == []


def test_negation_by_contraction_counts_like_not():
    for verb, short in (("are", "aren"), ("is", "isn"), ("was", "wasn"), ("do", "don"), ("will", "won"), ("ca", "can"), ("does", "doesn")):
        plain = score(f"You {verb} not stupid, it seems.")[0]
        assert plain < 0.5
        for mark in "'`\u2019\u02bc":
            for word in (f"{short}{mark}t", f"{short}{mark}t".upper()):
                assert score(f"You {word} stupid, it seems.")[0] == plain, word
    assert score("I won't kill you.")[0] < 0.5 <= score("I will kill you.")[0]
    # out of scope, in another clause, or no contraction
    direct = score("You are stupid.")[0]
    toxic = score("You aren't one of the stupid ones, you moron.", "I don't. You are stupid.", "You are stupid, aren't you.", "You are stupid; t aren 't.", "Don, t you stupid.")
    assert all(x >= 0.5 for x in toxic) and toxic[1] == toxic[2] == toxic[3] == direct
