import re

from ledgerloom.llm import decontam as dc
from tests.llm.data import empty, frame, messy


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]+", lambda m: m.group().lower(), text or ""))


def brute(rows, items, size=10):
    out = []
    for doc_id, text, *_ in rows:
        w, hit, ids = words(text), set(), set()
        for item, t in items:
            b = words(t)
            n = min(size, len(b))
            if not n:
                continue
            windows = {tuple(b[i:i + n]) for i in range(len(b) - n + 1)}
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in windows:
                    hit.update(range(i, i + n))
                    if item is not None:
                        ids.add(str(item))
        out.append((doc_id, len(w), len(hit), sorted(ids)))
    return sorted(out, key=str)


def test_hits_match_brute_force(spark):
    rows = messy()
    long_ = words(rows[-2][1])
    items = [(1, " ".join(long_[100:130])), (2, "one"), (3, "two Words"), (4, ""), (5, None), (None, "one"), (6, " ".join(long_[29_990:])),
             (7, " ".join(words(rows[30][1])[:25])), (8, " ".join(words(rows[30][1])[5:25]) + " elsewhere"), (10, "w1 w1 w1"), (9, "one"), (9, "one"),
             (11, "a b a b a b a b a b a b")]
    rows += [(700, "a b " * 300, "en", "a"), (701, "w1 " * 500, "en", "a"), (702, " ".join(words(rows[30][1])[:9]), "en", "a"), (702, "b a " * 6, "en", "a")]
    benchmark = spark.createDataFrame([(i, t, "x", 1) for i, t in items], "item_id long, text string, words string, n int")
    for bits in (24, 7):                       # 7: the bitmap lets nearly everything through, and nothing changes
        got = dc.decontaminate(frame(spark, rows), benchmark, bits=bits).collect()
        assert sorted([(r.doc_id, r.n_words, r.n_hit, r["items"]) for r in got], key=str) == brute(rows, items)
    hit = {i for i, _, n, _ in brute(rows, items) if n}
    assert {r.doc_id for r in dc.contaminated(frame(spark, rows), benchmark).collect()} == hit


def test_many_windows_under_one_shingle_and_empty_tables(spark):
    items = [(i, f"zz yy xx v{i} " + " ".join(f"u{i}_{j}" for j in range(6))) for i in range(150)]
    rows = [(i, "pre " + t + " post", "en", "a") for i, t in items] + [(900, "zz yy xx", "en", "a")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = dc.decontaminate(frame(spark, rows), benchmark).collect()
    assert sorted([(r.doc_id, r.n_words, r.n_hit, r["items"]) for r in got], key=str) == brute(rows, items)
    assert dc.decontaminate(empty(spark), benchmark).collect() == []
    assert {(r.n_hit, len(r["items"])) for r in dc.decontaminate(frame(spark, rows), benchmark.limit(0)).collect()} == {(0, 0)}
