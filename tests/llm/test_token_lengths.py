import base64
import random
from collections import Counter

import tiktoken

from ledgerloom.llm import token_lengths as tl
from tests.llm.data import empty, frame, messy


def encoding():
    with open(tl.TOKENIZER, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=tl.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_histogram_and_suffix_sums_match_brute_force(spark):
    enc, rows = encoding(), [r for r in messy() if r[0] != 501] + [(950, "<|endoftext|>", "en", "a"), (951, "ab cd é " * 30_000, "en", "a")]
    length = [len(enc.encode_ordinary(t or "")) for _, t, *_ in rows]
    sums = tl.suffix_sums(tl.lengths(frame(spark, rows))).cache()
    expected = [(n, c, sum(x >= n for x in length), sum(x for x in length if x >= n), sum(min(x, n) for x in length), sum(x <= n for x in length) / len(length))
                for n, c in sorted(Counter(length).items())]
    assert sorted(map(tuple, sums.collect())) == expected
    limits = [0, 1, 5, 17, 10_000, 10 ** 9]
    got = {r.limit: (r.docs_over, r.tokens_kept, r.tokens_cut) for r in tl.at_limits(sums, spark, limits).collect()}
    assert got == {x: (sum(n > x for n in length), sum(min(n, x) for n in length), sum(max(n - x, 0) for n in length)) for x in limits}
    q = tl.quantiles(sums, [0.5, 0.9, 1.0]).first()
    ordered = sorted(length)
    assert list(q) == [next(n for n in ordered if sum(x <= n for x in length) >= s * len(length)) for s in (0.5, 0.9, 1.0)]


def test_long_texts_are_cut_where_tokens_end():
    enc, rng = encoding(), random.Random(8)
    for alphabet in ("ab é1 ", "ab  \n'sß ", "日本 a "):
        text = "".join(rng.choice(alphabet) for _ in range(3 * tl.PIECE))
        assert "".join(tl.pieces(text)) == text
        assert sum(len(enc.encode_ordinary(p)) for p in tl.pieces(text)) == len(enc.encode_ordinary(text))
    assert tl.pieces("x" * (2 * tl.PIECE)) == ["x" * (2 * tl.PIECE)]


def test_runs_of_blanks_count_as_within_the_whole():
    enc, rng = encoding(), random.Random(9)
    blanks = [" " * 1500, "\n" * 1024, "\t \u3000" * 400, " \xa0\n" * 700, "\r\n" * 600, " " * 1023]
    for _ in range(40):
        text = "".join(rng.choice([*blanks, "a", "é1", " 'll", "!", "  x", "\x1c"]) for _ in range(rng.randint(1, 12)))
        assert tl.n_tokens(text, enc) == len(enc.encode_ordinary(text))


def test_very_long_runs_are_counted_whole(spark):
    enc, n = encoding(), 5_000_000
    line_ends = len(enc._encode_single_piece("\n" * n))
    texts = {" " * n: n, "\n" * n: line_ends, "x" * n: len(enc._encode_single_piece("x" * n)), " " * n + "ab": n - 1 + len(enc.encode_ordinary(" ab"))}
    got = tl.lengths(frame(spark, [(i, t, "en", "a") for i, t in enumerate(texts)])).collect()
    assert Counter({r.n_tokens: r.docs for r in got}) == Counter(texts.values())


def test_empty_table(spark):
    assert tl.suffix_sums(tl.lengths(empty(spark))).collect() == []
