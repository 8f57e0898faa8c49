"""Language identification with a byte-level convolutional network in numpy.

*Model.* A window of ``WINDOW`` bytes, A-Z lower-cased, is embedded byte by byte, filters of several widths run over it, each
keeps its largest response (max pooling), and a softmax layer names the language. Filters narrower than
the widest one are stored with zeros at their end, so all run in one matrix product.

*Training.* At most ``DOCS`` labelled texts of each language (those with the smallest hash of their id) and
``WINDOWS`` windows of each, of mixed lengths, and at most ``MOST`` windows in all: a bounded sample, fitted on the driver with Adam.
Only text and label are read; the caller leaves out what must stay unseen.

*Use.* Every text is cut into windows from its first byte to its last; batches of windows go through the network and
the mean of their probabilities, weighted by length, decides.

Defined results: null texts and texts without a letter are ``und`` with score 0; with nothing to learn from, every text is; ties go
to the first language by name; repeated rows get the same answer; rows without a label don't train; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerloom.llm.common import fresh, map_texts
from ledgerloom.llm.words import LOWER

WINDOW = 256
EMBED = 8
WIDTHS = {2: 8, 3: 12, 4: 12}      # filters of each width
DOCS, WINDOWS, MOST = 400, 6, 60_000
EPOCHS, BATCH, RATE = 8, 64, 0.01
UNKNOWN = "und"
AT_ONCE = 64                       # windows in one matrix product


@dataclass
class Model:
    langs: list[str]
    embed: np.ndarray      # 256 x EMBED
    filters: np.ndarray    # widest * EMBED x filters
    bias: np.ndarray
    out: np.ndarray        # filters x langs
    out_bias: np.ndarray


def views(x: np.ndarray, embed: np.ndarray, width: int) -> np.ndarray:
    """Every run of ``width`` embedded bytes as one row: windows x places x (width * EMBED)."""
    places = x.shape[1] - width + 1
    return np.concatenate([embed[x[:, i:i + places]] for i in range(width)], axis=2)


def pooled(x: np.ndarray, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rows = views(x, model.embed, max(WIDTHS))
    n, places, size = rows.shape
    response = (rows.reshape(n * places, size) @ model.filters).reshape(n, places, -1)
    at = response.argmax(axis=1)
    return np.maximum(np.take_along_axis(response, at[:, None, :], 1)[:, 0] + model.bias, 0), at, rows


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def probabilities(x: np.ndarray, model: Model) -> np.ndarray:
    """Inference: only the largest response is kept, place by place of a small batch."""
    out = []
    for low in range(0, len(x), AT_ONCE):
        rows = views(x[low:low + AT_ONCE], model.embed, max(WIDTHS))
        n, places, size = rows.shape
        best = (rows.reshape(n * places, size) @ model.filters).reshape(n, places, -1).max(axis=1)
        out.append(softmax(np.maximum(best + model.bias, 0) @ model.out + model.out_bias))
    return np.concatenate(out)


def padded(parts: list[bytes]) -> np.ndarray:
    data = b"".join(p.ljust(WINDOW, b"\0") for p in parts)
    return LOWER[np.frombuffer(data, np.uint8)].reshape(len(parts), WINDOW)


def fit(windows: list[bytes], labels: list[str], seed: int = 1) -> Model | None:
    """Train on windows of at most ``WINDOW`` bytes."""
    if not windows:
        return None
    langs = sorted(set(labels))
    rng = np.random.default_rng(seed)
    x, y = padded(windows), np.array([langs.index(v) for v in labels])
    widest, filters = max(WIDTHS), sum(WIDTHS.values())
    mask = np.concatenate([np.repeat(np.arange(widest) < w, EMBED)[:, None].repeat(n, 1) for w, n in WIDTHS.items()], axis=1).astype(np.float32)
    draw = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(np.float32)
    model = Model(langs, draw(256, EMBED, scale=0.5), draw(widest * EMBED, filters, scale=0.3) * mask, np.zeros(filters, np.float32),
                  draw(filters, len(langs), scale=0.3), np.zeros(len(langs), np.float32))
    weights = [model.embed, model.filters, model.bias, model.out, model.out_bias]
    first, second, step = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights], 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(x))
        for low in range(0, len(x), BATCH):
            pick = order[low:low + BATCH]
            hidden, at, rows = pooled(x[pick], model)
            error = softmax(hidden @ model.out + model.out_bias)
            error[np.arange(len(pick)), y[pick]] -= 1
            error /= len(pick)
            back = (error @ model.out.T) * (hidden > 0)          # windows x filters; it flows to the pooled place alone
            seen = rows[np.arange(len(pick))[:, None], at]       # windows x filters x (widest * EMBED)
            d_filters = np.einsum("nf,nfk->kf", back, seen) * mask
            d_seen = np.einsum("nf,kf->nfk", back, model.filters).reshape(-1, EMBED)
            places = at[:, :, None] + np.arange(widest)
            bytes_ = np.take_along_axis(x[pick][:, None, :].repeat(filters, 1), places, 2).ravel()
            d_embed = np.stack([np.bincount(bytes_, d_seen[:, j], 256) for j in range(EMBED)], axis=1).astype(np.float32)
            step += 1
            for i, d in enumerate([d_embed, d_filters, back.sum(0), hidden.T @ error, error.sum(0)]):
                first[i] = 0.9 * first[i] + 0.1 * d
                second[i] = 0.999 * second[i] + 0.001 * d * d
                weights[i] -= (RATE * (first[i] / (1 - 0.9 ** step)) / (np.sqrt(second[i] / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
    return model


def training_windows(docs: DataFrame, doc_id: str, text: str, lang: str) -> tuple[list[bytes], list[str]]:
    """The bounded sample. A text is cut in its task; only windows reach the driver."""
    named = docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{lang}`").alias("lang")).where("lang is not null and id is not null")
    # of a large language only a slice of the hashes, of about 4 * DOCS rows, goes into the ranking; the
    # broadcast has a row a language and MOST // WINDOWS rows at most
    sizes = named.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(MOST // WINDOWS)
    part = F.pmod(F.xxhash64("id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("part", "id"))
    ids = (named.join(F.broadcast(sizes), "lang").withColumn("part", part).where(F.col("part") * F.col("n") < 4 * DOCS).select("lang", "id", "part").distinct()
           .withColumn("rank", rank).where(F.col("rank") <= DOCS).orderBy("rank", "lang", "id").limit(MOST // WINDOWS).select("id", "lang"))

    def cut(batch: pa.RecordBatch):
        out = {"window": [], "lang": []}
        for name, raw in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
            rng = np.random.default_rng(len(raw))
            for _ in range(WINDOWS):
                size = min(len(raw), int(rng.choice([12, 24, 48, 96, WINDOW, WINDOW])))
                at = int(rng.integers(0, len(raw) - size + 1))
                out["window"].append(raw[at:at + size])
                out["lang"].append(name)
        yield out

    texts = docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{lang}`").alias("lang"), F.col(f"`{text}`").alias("text"))
    # at most MOST // WINDOWS ids, so the broadcast has a bound
    sample = texts.join(F.broadcast(ids), ["id", "lang"]).where("text rlike '\\\\p{L}'").select("lang", "text")
    rows = map_texts(sample, cut, "window binary, lang string").limit(MOST).collect()
    rows = sorted((bytes(r.window), r.lang) for r in rows)
    return [w for w, _ in rows], [name for _, name in rows]


def train(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> Model | None:
    return fit(*training_windows(docs, doc_id, text, lang))


def predict(docs: DataFrame, model: Model | None, columns: dict[str, Column], text: str = "text") -> DataFrame:
    """``columns`` of each row (none of them an input), lang_pred and score."""
    kept = docs.select(F.col(f"`{text}`").alias(fresh("text", columns)), *[c.alias(n) for n, c in columns.items()])
    names = list(columns)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[1:])

    def per_batch(batch: pa.RecordBatch):
        texts = batch.column(0).to_pylist()
        pred, score = [UNKNOWN] * len(texts), [0.0] * len(texts)
        known = [i for i, t in enumerate(texts) if t and model is not None and any(map(str.isalpha, t))]
        for low in range(0, len(known), 200):
            part = known[low:low + 200]
            raw = [texts[i].encode() for i in part]
            counts = np.array([-(-len(r) // WINDOW) for r in raw])
            data = b"".join(r.ljust(int(n) * WINDOW, b"\0") for r, n in zip(raw, counts))
            x = LOWER[np.frombuffer(data, np.uint8)].reshape(-1, WINDOW)
            weight = (x != 0).sum(axis=1)[:, None]
            start = np.concatenate([[0], np.cumsum(counts)[:-1]])
            mean = np.add.reduceat(probabilities(x, model) * weight, start) / np.maximum(np.add.reduceat(weight, start), 1)
            for i, p in zip(part, mean):
                pred[i], score[i] = model.langs[int(p.argmax())], min(1.0, float(p.max()))
        yield {**{n: batch.column(n) for n in names}, "lang_pred": pred, "score": score}

    return map_texts(kept, per_batch, f"{schema}, lang_pred string, score double")
