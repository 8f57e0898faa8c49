"""Small messy tables: nulls everywhere, empty and very long texts, repeated rows, ties, clashing extra columns."""

import random

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "row long, kept boolean, score double, size long, component_id string, hits string, label string, place int")


def frame(spark, rows):
    """Rows of (doc_id, text, lang, source) with extra columns whose names operators use themselves."""
    data = [(i, t, lang, s, len(t) if t is not None else None, 7, None, -1.0, 3, "x", None, "y", 2) for i, t, lang, s in rows]
    return spark.createDataFrame(data, SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def messy(seed=3):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)] + ["été", "Straße", "niño", "x" * 40]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    rows = [(None, None, None, None), (None, text(30), "en", None), (1, None, "en", "a"), (2, "", None, "a"), (3, "   \t\n ", "fr", "b"),
            (4, "one", "en", "b"), (5, "One", "en", "c"), (6, "two words", "de", None), (7, "\x00 odd\x0b\x0cspaces\x1f", "en", "c"),
            (8, "!!! ??? ...", None, "c")]
    base = text(60)
    for i in range(20):                        # near copies of a text, exact copies, and copies of copies
        words = base.split()
        for _ in range(i % 4):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        rows.append((100 + i, " ".join(words), "en", "hot"))
    rows += [(200 + i, base.upper(), "en", "hot") for i in range(5)]
    rows += [(300, base, "en", "hot")] * 3     # repeated rows
    rows += [(400 + i, text(rng.randint(1, 40)), rng.choice(["en", "de"]), rng.choice("abc")) for i in range(40)]
    rows.append((500, text(30_000), "en", "a"))
    rows.append((501, "y" * 200_000, "en", "a"))
    return rows
