import random
import re

import numpy as np

from ledgerloom.llm.words import ALNUM, SPACED, Hasher, chunks, grams

PATTERN = {"spaced": (SPACED, r"[^\x20\x09-\x0D]+"), "alnum": (ALNUM, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")}


def test_words_and_hashes_match_the_patterns():
    rng = random.Random(1)
    texts = ["", " ", "a", "Été À b", "\x00\x1f\x7f", "ß" * 5000] + ["".join(rng.choice("aB1é \t\n\x0b-_.世界") for _ in range(rng.randint(0, 80))) for _ in range(300)]
    for kind, pattern in PATTERN.values():
        hasher, seen = Hasher(kind), {}
        for limit in (1, 50, 1 << 20):
            spelt = []
            for low, part in chunks([t.encode() for t in texts], limit):
                words = hasher(part)
                for i in range(len(part)):
                    a, b = words.first[i], words.first[i + 1]
                    spelt.append([w.decode() for w in words.text(a, b)])
                    for w, h in zip(spelt[-1], words.hash[a:b].tolist()):
                        assert seen.setdefault(w, h) == h
            lower = [re.sub("[A-Z]+", lambda m: m.group().lower(), t) for t in texts]
            assert spelt == [re.findall(pattern, t) for t in lower]
        assert len(set(seen.values())) == len(seen)


def test_grams_depend_on_order_and_length():
    h = np.arange(1, 6, dtype=np.uint64)
    assert len(grams(h, 2)) == 4 and len(grams(h, 6)) == 0
    assert grams(h, 2)[0] != grams(h[[1, 0]], 2)[0]
    assert grams(np.array([1, 2, 3, 1, 2], dtype=np.uint64), 2)[0] == grams(np.array([1, 2], dtype=np.uint64), 2)[0]
