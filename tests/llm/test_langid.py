import random

import numpy as np
from pyspark.sql import functions as F

from ledgerloom.llm import langid
from tests.llm.data import empty, frame, messy

SOUNDS = {"aa": "the and ing tion of ou er".split(), "bb": "ção não que os lh inh".split(), "cc": "ж щ ий ост ение по".split(), "dd": "sch ung der ei ü ck".split()}


def corpus(seed=1, n=160):
    rng = random.Random(seed)
    word = lambda lang: "".join(rng.choice(SOUNDS[lang]) for _ in range(rng.randint(1, 3)))
    return [(i, " ".join(word(lang) for _ in range(rng.choice([6, 40, 300]))), lang, "s") for i in range(n) for lang in [sorted(SOUNDS)[i % 4]]]


def test_held_out_accuracy_and_defined_results(spark):
    rows, fresh_ = corpus(), corpus(2)
    odd = [(900, None, "aa", "s"), (901, "", "aa", "s"), (902, "123 ... !", "bb", "s"), (903, "the and the and ing", None, "s"), (None, "the of ing and of", "aa", "s")]
    model = langid.train(frame(spark, rows + odd + messy(4)[-3:]).where("lang <> 'en'"))
    test = frame(spark, [(1000 + i, *r) for i, *r in fresh_] + odd + [(1, "the and of " * 20_000, None, "s")] * 2)
    got = langid.predict(test, model, {"doc_id": F.col("doc_id"), "score_": F.col("score")}).collect()
    assert len(got) == len(fresh_) + len(odd) + 2
    by_id = {r.doc_id: r for r in got}
    assert sum(by_id[1000 + i].lang_pred == lang for i, _, lang, _ in fresh_) >= 0.97 * len(fresh_)
    assert [(by_id[i].lang_pred, by_id[i].score) for i in (900, 901, 902)] == [("und", 0.0)] * 3
    assert by_id[903].lang_pred == by_id[None].lang_pred == by_id[1].lang_pred == "aa" and all(0 <= r.score <= 1 for r in got)


def test_nothing_to_learn_and_empty_table(spark):
    assert langid.train(frame(spark, [(1, "abc", None, "s"), (2, None, "aa", "s")])) is None
    got = langid.predict(frame(spark, [(1, "abc", None, "s")]), None, {"doc_id": F.col("doc_id")}).collect()
    assert [(r.lang_pred, r.score) for r in got] == [("und", 0.0)]
    assert langid.predict(empty(spark), None, {"doc_id": F.col("doc_id")}).collect() == []


def test_pooling_equals_plain_loops():
    rng = np.random.default_rng(0)
    model = langid.fit([b"abcd" * 10, b"wxyz" * 10] * 4, ["a", "b"] * 4)
    x = rng.integers(0, 256, (3, langid.WINDOW)).astype(np.uint8)
    for row, p in zip(x, langid.probabilities(x, model)):
        best = np.max([model.embed[row[i:i + 4]].ravel() @ model.filters for i in range(langid.WINDOW - 3)], axis=0)
        z = np.maximum(best + model.bias, 0) @ model.out + model.out_bias
        assert np.allclose(np.exp(z) / np.exp(z).sum(), p, atol=1e-4)
    assert (model.filters[2 * langid.EMBED:, :8] == 0).all()       # narrow filters see two bytes
