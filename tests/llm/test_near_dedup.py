import random
import re

import numpy as np
from ledgerloom.llm import near_dedup as nd
from ledgerloom.llm.components import components
from ledgerloom.llm.words import U64, mix
from tests.llm.data import empty, frame, messy


def shingles(text, k=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m.group().lower(), text or ""))
    return {tuple(words[i:i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def brute(rows, percent):
    sets = [shingles(t) for _, t, *_ in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(find(i), []).append(i)
    out = []
    for members in groups.values():
        ids = [rows[i][0] for i in members if rows[i][0] is not None]
        out += [(rows[i][0], len(sets[i]), min(ids) if ids else None) for i in members]
    return sorted(out, key=str), len(groups)


def test_groups_match_brute_force_with_blocks_of_any_size(spark):
    rows = messy()
    df = frame(spark, rows)
    expected, groups = brute(rows, 85)
    for block in (nd.BLOCK_SHINGLES, 300):      # 300: the large bucket is compared in many blocks
        got = nd.near_groups(df, block_shingles=block).collect()
        assert sorted([(r.doc_id, r.n_shingles, r.component_id) for r in got], key=str) == expected
        assert sum(r.kept for r in got) == groups


def test_lower_threshold_and_empty_table(spark):
    rows = messy(9)[:40]
    expected, _ = brute(rows, 80)
    got = nd.near_groups(frame(spark, rows), percent=80).collect()
    assert sorted([(r.doc_id, r.n_shingles, r.component_id) for r in got], key=str) == expected
    assert nd.near_groups(empty(spark)).collect() == []


def test_sketch_estimate_is_close_and_keeps_leading_zeros():
    rng = np.random.default_rng(0)
    for shared in (0.5, 0.85, 0.95):
        a = mix(rng.integers(0, 1 << 62, 2000).astype(U64))
        b = np.concatenate([a[:int(2000 * 2 * shared / (1 + shared))], mix(rng.integers(0, 1 << 62, 2000).astype(U64))])[:2000]
        x, y = nd.sketch(np.unique(a), 1200), nd.sketch(np.unique(b), 1200)
        similar, used = nd.estimate(x, len(a), y[None, :], np.array([len(b)]))
        assert abs(similar[0] - shared) < 5 * np.sqrt(shared * (1 - shared) / used[0])
    assert (nd.sketch(np.empty(0, U64), 16) == nd.EMPTY).all()


def test_components_of_paths_stars_and_loops(spark):
    rng = random.Random(4)
    nodes = list(range(60))
    rng.shuffle(nodes)
    links = list(zip(nodes, nodes[1:])) + [(100, x) for x in range(101, 140)] + [(200, 200), (201, 202), (202, 201)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{n: 0 for n in nodes}, **{n: 100 for n in range(100, 140)}, 201: 201, 202: 201}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_bands_find_pairs_at_lower_thresholds():
    assert nd.bands_for(85) == nd.BANDS and nd.bands_for(80) == 40
    rng = np.random.default_rng(1)
    bands = nd.bands_for(80)
    order = nd.donors(bands * nd.ROWS)
    for shared, own in ((16, 2), (40, 5), (80, 10)):
        for _ in range(150):
            values = mix(rng.integers(0, 1 << 62, shared + 2 * own).astype(U64))
            a, b = values[:shared + own], np.concatenate([values[:shared], values[shared + own:]])
            keys = [nd.band_keys(nd.sketch(np.unique(x), bands * nd.ROWS), order, bands, nd.ROWS) for x in (a, b)]
            assert (keys[0] == keys[1]).any()
