import corpus_pipeline as cp
from ledgerloom.llm import secret_scan
from tests.llm.data import SCHEMA, messy
from tests.llm.test_decontam import brute as hits
from tests.llm.test_mixing import targets
from tests.llm.test_near_dedup import brute as groups
from tests.llm.test_secret_scan import SECRET


def test_stages_match_brute_force_on_what_the_stage_before_kept(spark, tmp_path):
    rows = messy()
    rows += [(600, "You are an idiot, a stupid clown", "en", "a"), (601, "He is not an idiot", "en", "a"), (602, rows[-2][1][:400] + " tail", "en", "b"),
             (603, f"quiet words {SECRET} and more", "en", None), (604, f"quiet words {SECRET} and more", "en", None)]
    items = [(1, " ".join(rows[-7][1].split()[20:45])), (2, None), (None, "one"), (3, "")]
    data = [(i, t, lang, s, len(t) if t is not None else None, 7, None, -1.0, 3, "x", None, "y", 2) for i, t, lang, s in rows]
    folder = str(tmp_path / "in")
    spark.createDataFrame(data, SCHEMA).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame([(600, 1, 1), (601, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns

    def stage(k):
        nonlocal docs
        out = str(tmp_path / str(k))
        cp.STAGES[k][1](spark, docs, folder).write.parquet(out)
        docs = spark.read.parquet(out)
        if k < 4:
            assert docs.columns == columns
        return [(r.doc_id, r.text, r.lang, r.source) for r in docs.collect()]

    assert [n for n, _ in cp.STAGES] == ["toxicity", "near_dedup", "decontaminate", "secrets", "mix"]
    calm = stage(0)
    assert sorted(calm, key=str) == sorted([r for r in rows if r[0] != 600], key=str)
    one_each = stage(1)
    expected, n = groups(calm, 80)
    assert len(one_each) == n and sorted([r[0] for r in one_each], key=str) == sorted(
        [i for i, size, head in expected if not size] + list({head if head is not None else None: 0 for i, size, head in expected if size}), key=str)
    clean = stage(2)
    bad = {i for i, _, k, _ in hits(one_each, items) if k}
    assert bad and sorted(clean, key=str) == sorted([r for r in one_each if r[0] not in bad], key=str)
    safe = stage(3)
    assert sorted(safe, key=str) == sorted([(i, t and secret_scan.redacted(t, "[SECRET]"), x, s) for i, t, x, s in clean], key=str)
    assert any("[SECRET]" in (t or "") for _, t, *_ in safe) and not any("24be6443" in (t or "") for _, t, *_ in safe)
    sizes, taken = {}, {}
    for _, t, _, s in safe:
        sizes[s] = sizes.get(s, 0) + len((t or "").encode().split())
    goal = targets(sizes)
    for _, t, _, s in stage(4):
        taken[s] = taken.get(s, 0) + len((t or "").encode().split())
    assert set(docs.columns) - set(columns) == {"copy", "taken_words"}
    assert all(abs(taken.get(s, 0) - float(goal[s])) <= 30_000 / 2 + 1 for s in sizes)


def test_empty_documents(spark, tmp_path):
    folder = str(tmp_path / "in")
    spark.createDataFrame([], SCHEMA).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    assert cp.run(spark, folder).collect() == []


def test_near_dedup_stage_links_from_a_given_similarity(spark, tmp_path):
    words = lambda name, n: [f"{name}{i}" for i in range(n)]
    # 100 shared shingles of 120, 0.833; then 0.75 beside it
    near = [words("a", 104) + words("b", 10), words("a", 104) + words("c", 10)]
    far = [words("d", 94) + words("e", 15), words("d", 94) + words("f", 15)]
    rows = [(i, " ".join(w), "en", "a") for i, w in enumerate(near + far)]
    data = [(i, t, lang, s, len(t), 7, None, -1.0, 3, "x", None, "y", 2) for i, t, lang, s in rows]
    spark.createDataFrame(data, SCHEMA).write.parquet(str(tmp_path / "documents"))
    docs = spark.read.parquet(str(tmp_path / "documents"))
    for percent, kept in ((80, [0, 2, 3]), (85, [0, 1, 2, 3])):
        assert groups(rows, percent)[1] == len(kept)
        assert sorted(r.doc_id for r in cp.one_of_each_group(spark, docs, "", percent).collect()) == kept
