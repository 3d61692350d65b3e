"""Language identification by a byte convolutional network.

Texts are cut into windows of ``WIDTH`` bytes.  Every byte has a learned
vector; filters of several widths slide over a window, each filter's highest
response is kept (max pooling), and a softmax over these gives the languages.
A text's probabilities are the mean of its windows', weighted by their bytes.
Everything is numpy; the model is a few thousand numbers and travels with the
task.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from runlens.llm.textblocks import blocks

WIDTH = 256
FILTERS = ((2, 16), (3, 16), (4, 16))
VECTOR = 8
# Bounds of the training sample: documents of each language, windows of each.
SAMPLE_DOCS = 400
SAMPLE_WINDOWS = 4
BATCH = 32


@dataclass
class ByteConvNet:
    """``params``: byte vectors, weights and bias of each filter width, output layer."""

    labels: list[str]
    params: dict[str, np.ndarray]

    def features(self, windows: np.ndarray):
        """Max-pooled responses of a batch of byte windows (0 pads), and what training needs of them."""
        x = self.params["vectors"][windows].reshape(len(windows), -1)
        pooled, seen = [], []
        for width, _ in FILTERS:
            n = windows.shape[1] - width + 1
            rows = np.lib.stride_tricks.sliding_window_view(x, width * VECTOR, axis=1)[:, ::VECTOR]
            rows = rows.reshape(len(windows) * n, width * VECTOR)
            out = (rows @ self.params[f"w{width}"]).reshape(len(windows), n, -1)
            at = out.argmax(axis=1)
            seen.append((rows.reshape(len(windows), n, -1), at))
            out = np.take_along_axis(out, at[:, None, :], 1)[:, 0]
            pooled.append(np.maximum(out + self.params[f"b{width}"], 0))
        return np.concatenate(pooled, axis=1), seen

    def tables(self) -> dict[int, list[np.ndarray]]:
        """Responses of each filter to every pair of bytes, and to a single last
        byte of an odd width: a convolution is then a sum of looked-up rows."""
        out = {}
        for width, _ in FILTERS:
            w, parts = self.params[f"w{width}"], []
            single = [self.params["vectors"] @ w[k * VECTOR:(k + 1) * VECTOR] for k in range(width)]
            for k in range(0, width - 1, 2):
                parts.append((single[k][:, None] + single[k + 1][None]).reshape(65536, -1))
            out[width] = parts + ([single[-1]] if width % 2 else [])
        return out

    def probabilities(self, windows: np.ndarray, tables: dict[int, list[np.ndarray]]) -> np.ndarray:
        out = []
        for k in range(0, len(windows), BATCH):
            at = np.ascontiguousarray(windows[k:k + BATCH].T).astype(np.intp)
            pair, pooled = at[:-1] * 256 + at[1:], []
            for width, _ in FILTERS:
                n, total = len(at) - width + 1, None
                for j, table in enumerate(tables[width]):
                    index = (pair if len(table) > 256 else at)[2 * j:2 * j + n]
                    rows = table.take(index, axis=0)
                    total = rows if total is None else np.add(total, rows, out=total)
                top = total.reshape(n, -1).max(axis=0).reshape(at.shape[1], -1)
                pooled.append(np.maximum(top + self.params[f"b{width}"], 0))
            z = np.concatenate(pooled, axis=1) @ self.params["out"] + self.params["bias"]
            e = np.exp(z - z.max(axis=1, keepdims=True))
            out.append(e / e.sum(axis=1, keepdims=True))
        return np.concatenate(out) if out else np.empty((0, len(self.labels)), np.float32)


def train(windows: np.ndarray, classes: np.ndarray, labels: list[str], epochs: int = 4, rate: float = 0.004, seed: int = 7) -> ByteConvNet:
    """Fit by Adam on windows of equal width; classes are weighted alike."""
    rng = np.random.default_rng(seed)
    p = {"vectors": rng.normal(0, 0.5, (256, VECTOR))}
    for width, n in FILTERS:
        p[f"w{width}"] = rng.normal(0, 1 / np.sqrt(width * VECTOR), (width * VECTOR, n))
        p[f"b{width}"] = np.zeros(n)
    p["out"] = rng.normal(0, 0.1, (sum(n for _, n in FILTERS), len(labels)))
    p["bias"] = np.zeros(len(labels))
    net = ByteConvNet(labels, {k: v.astype(np.float32) for k, v in p.items()})
    p = net.params
    share = np.bincount(classes, minlength=len(labels))
    weight = (len(classes) / np.maximum(share, 1) / len(labels))[classes].astype(np.float32)
    first = {k: np.zeros_like(v) for k, v in p.items()}
    second = {k: np.zeros_like(v) for k, v in p.items()}
    step = 0
    for _ in range(epochs):
        for at in np.array_split(rng.permutation(len(windows)), max(1, len(windows) // BATCH)):
            f, seen = net.features(windows[at])
            z = f @ p["out"] + p["bias"]
            e = np.exp(z - z.max(axis=1, keepdims=True))
            d = e / e.sum(axis=1, keepdims=True)
            d[np.arange(len(at)), classes[at]] -= 1
            d *= (weight[at] / len(at))[:, None]
            grad = {"out": f.T @ d, "bias": d.sum(axis=0), "vectors": np.zeros_like(p["vectors"])}
            back, start = (d @ p["out"].T) * (f > 0), 0
            for (width, n), (rows, place) in zip(FILTERS, seen):
                g = back[:, start:start + n]
                start += n
                picked = np.take_along_axis(rows, place[:, :, None], 1)
                grad[f"w{width}"] = np.einsum("bnv,bn->vn", picked, g)
                grad[f"b{width}"] = g.sum(axis=0)
                to_rows = g[:, :, None] * p[f"w{width}"].T[None]
                for k in range(width):
                    bytes_at = np.take_along_axis(windows[at], place + k, 1)
                    np.add.at(grad["vectors"], bytes_at, to_rows[:, :, k * VECTOR:(k + 1) * VECTOR])
            step += 1
            for k, g in grad.items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                scale = np.sqrt(1 - 0.999 ** step) / (1 - 0.9 ** step)
                p[k] -= (rate * scale * first[k] / (np.sqrt(second[k]) + 1e-8)).astype(np.float32)
    return net


def cut_windows(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows of the texts on end, the text of each and its bytes; the last of a text is padded with 0."""
    sizes = np.diff(offsets)
    n = -(-sizes // WIDTH)
    text = np.repeat(np.arange(len(sizes)), n)
    number = np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n)
    starts = offsets[:-1][text] + number * WIDTH
    filled = np.minimum(WIDTH, offsets[1:][text] - starts)
    padded = np.append(data, np.zeros(WIDTH, np.uint8))
    windows = padded[starts[:, None] + np.arange(WIDTH)]
    short = filled < WIDTH
    windows[short] *= np.arange(WIDTH) < filled[short, None]
    return windows, text, filled


def held_out(doc_id: Column) -> Column:
    """Documents that no model may learn from."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1


def fit(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> ByteConvNet | None:
    """Train on at most ``sample_docs`` labelled texts of each language, those
    of smallest hash, and ``SAMPLE_WINDOWS`` windows spread over each.

    ``docs`` holds learnable rows only.  None if there is no label.
    """
    labelled = docs.where(F.col("lang").isNotNull() & (F.length("text") > 0))
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = (labelled.select("doc_id", "lang").withColumn("_rank", F.row_number().over(order))
              .where(F.col("_rank") <= sample_docs).select("doc_id", "lang").distinct())
    pieces = F.transform(F.sequence(F.lit(0), F.lit(SAMPLE_WINDOWS - 1)), lambda k: F.substring(
        F.col("text"), (F.floor(k * F.greatest(F.length("text") - WIDTH, F.lit(0)) / max(SAMPLE_WINDOWS - 1, 1)) + 1).cast("int"), WIDTH))
    # The side is bounded by the sample of each language.
    texts = labelled.join(F.broadcast(chosen), ["doc_id", "lang"], "left_semi").select("doc_id", "lang", F.array_distinct(pieces).alias("pieces"))
    rows = texts.orderBy("lang", "doc_id").collect()
    labels = sorted({r.lang for r in rows})
    if not labels:
        return None
    data = [(w.encode()[:WIDTH], labels.index(r.lang)) for r in rows for w in r.pieces]
    windows = np.zeros((len(data), WIDTH), np.uint8)
    for k, (w, _) in enumerate(data):
        windows[k, :len(w)] = np.frombuffer(w, np.uint8)
    return train(windows, np.array([c for _, c in data]), labels)


def predict(docs: DataFrame, net: ByteConvNet | None) -> DataFrame:
    """``docs`` (doc_id, text) with ``lang_pred`` and ``score``; no shuffle."""
    labels = net.labels if net else []

    def run(batches):
        tables = net.tables() if net else {}
        for batch in batches:
            for block in blocks(batch.column("text")):
                rows = batch.slice(block.first_row, block.n_texts)
                best, score = np.full(block.n_texts, -1), np.zeros(block.n_texts)
                if labels:
                    windows, text, filled = cut_windows(block.data, block.offsets)
                    p = net.probabilities(windows, tables) * filled[:, None]
                    total = np.stack([np.bincount(text, weights=p[:, k], minlength=block.n_texts)
                                      for k in range(len(labels))], axis=1)
                    share = total / np.maximum(np.diff(block.offsets), 1)[:, None]
                    letters = rows.column("letters").to_numpy(zero_copy_only=False).astype(bool)
                    best = np.where(letters, share.argmax(axis=1), -1)
                    score = np.where(letters, np.clip(share.max(axis=1), 0, 1), 0.0)
                names = pa.array([labels[k] if k >= 0 else "und" for k in best.tolist()], pa.string())
                yield pa.RecordBatch.from_arrays([rows.column("doc_id"), names, pa.array(score)],
                                                 ["doc_id", "lang_pred", "score"])

    letters = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    return docs.select("doc_id", "text", letters.alias("letters")).mapInArrow(
        run, "doc_id bigint, lang_pred string, score double")


def identify_language(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """Language of every document, learned from those that are not held out.

    ``docs`` needs doc_id, text and lang; other columns are ignored.  A NULL
    text or one without a letter is ``und`` with score 0, and so is every text
    if nothing is labelled.  Equal texts get equal results; an empty table gives
    no row.  A NULL doc_id is not held out.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       F.col("lang").cast("string").alias("lang"))
    out = F.coalesce(held_out(F.col("doc_id")), F.lit(False))
    net = fit(rows.where(~out), sample_docs)
    return predict(rows, net).select("doc_id", out.alias("held_out"), "lang_pred", "score")
