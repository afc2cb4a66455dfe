"""Language identification by a convolutional network over bytes.

A window is a fixed number of bytes of a text. Filters of several widths slide over it, each keeps its strongest answer
(max pooling), and a softmax over these gives the languages. The network is trained here, in numpy, on windows of a
bounded sample of labelled texts. A text is cut into windows from end to end, all of them are scored in batches, and the
text's language is the one with the largest mean log-probability.

A filter's answer is a sum over the bytes under it, so a trained filter becomes tables by byte or by pair of bytes:
scoring is looking up and adding, and costs the same however wide the byte embedding was.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sunledger.llm.common import crc_mod, private

WINDOW = 512
WIDTHS = (2, 3, 4)
FILTERS = 16
EMBEDDING = 8
#: Labelled texts of each language to learn from, on average, and windows of each text, evenly spaced.
TEXTS = 400
WINDOWS = 3
STEPS = 300
BATCH = 64
RATE = 0.02
#: Windows scored at a time: so few that what is looked up for them stays in the processor's cache.
AT_ONCE = 16
UNKNOWN = "und"


def has_letter(text: str | None) -> bool:
    return any(map(str.isalpha, text or ""))


# --- windows ---


def cut(data: bytes, window: int = WINDOW) -> np.ndarray:
    """The whole text as rows of ``window`` bytes. A short text is filled up with zeros; otherwise the last window
    ends where the text does."""
    n = len(data)
    if n <= window:
        return np.frombuffer(data.ljust(window, b"\0"), np.uint8).reshape(1, window)
    flat = np.frombuffer(data, np.uint8)
    whole = flat[: n // window * window].reshape(-1, window)
    return whole if n % window == 0 else np.vstack([whole, flat[n - window :][None, :]])


# --- network ---


@dataclass
class Network:
    languages: list[str]
    embedding: np.ndarray  # byte x E
    filters: list[np.ndarray]  # per width: (width * E) x F
    bias: list[np.ndarray]
    out: np.ndarray  # all filters x languages
    out_bias: np.ndarray


def softmax(scores: np.ndarray) -> np.ndarray:
    shifted = np.exp(scores - scores.max(axis=1, keepdims=True))
    return shifted / shifted.sum(axis=1, keepdims=True)


def forward(net: Network, windows: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
    """Pooled answers, where each filter's strongest answer was, and the bytes' vectors under each width."""
    vectors = net.embedding[windows]
    pooled, places, patches = [], [], []
    for width, weight, bias in zip(WIDTHS, net.filters, net.bias):
        under = np.concatenate([vectors[:, i : vectors.shape[1] - width + 1 + i] for i in range(width)], axis=2)
        answer = under @ weight + bias
        at = answer.argmax(axis=1)
        pooled.append(np.maximum(np.take_along_axis(answer, at[:, None, :], 1)[:, 0], 0))
        places.append(at)
        patches.append(under)
    return np.hstack(pooled), places, patches


def train(windows: np.ndarray, label: np.ndarray, languages: list[str], steps: int = STEPS, seed: int = 5) -> Network:
    """Adam on the cross-entropy; each language has the same share of every batch, on average."""
    rng = np.random.default_rng(seed)
    n, all_filters = len(languages), FILTERS * len(WIDTHS)
    net = Network(
        languages,
        rng.normal(0, 0.5, (256, EMBEDDING)).astype(np.float32),
        [rng.normal(0, (2 / (w * EMBEDDING)) ** 0.5, (w * EMBEDDING, FILTERS)).astype(np.float32) for w in WIDTHS],
        [np.zeros(FILTERS, np.float32) for _ in WIDTHS],
        rng.normal(0, (1 / all_filters) ** 0.5, (all_filters, n)).astype(np.float32),
        np.zeros(n, np.float32),
    )
    params = [net.embedding, *net.filters, *net.bias, net.out, net.out_bias]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    by_language = [np.flatnonzero(label == i) for i in range(n)]
    for step in range(1, steps + 1):
        picked = np.array([rng.choice(by_language[i]) for i in rng.integers(0, n, BATCH)])
        x, y = windows[picked], label[picked]
        pooled, places, patches = forward(net, x)
        slope = softmax(pooled @ net.out + net.out_bias)
        slope[np.arange(len(y)), y] -= 1
        slope /= len(y)
        back = (slope @ net.out.T) * (pooled > 0)
        grads = [np.zeros_like(net.embedding)]
        filter_grads, bias_grads = [], []
        for i, width in enumerate(WIDTHS):
            part = back[:, i * FILTERS : (i + 1) * FILTERS]
            under = np.take_along_axis(patches[i], places[i][:, :, None], 1)  # row x filter x (width * E)
            filter_grads.append(np.einsum("bf,bfk->kf", part, under))
            bias_grads.append(part.sum(axis=0))
            to_vectors = (part[:, :, None] * net.filters[i].T[None]).reshape(len(y), FILTERS, width, EMBEDDING)
            at = places[i][:, :, None] + np.arange(width)
            np.add.at(grads[0], x[np.arange(len(y))[:, None, None], at], to_vectors)
        grads += [*filter_grads, *bias_grads, pooled.T @ slope, slope.sum(axis=0)]
        rate = RATE * min(1.0, 2 * (1 - step / (steps + 1)))
        for param, grad, m, v in zip(params, grads, first, second):
            m += 0.1 * (grad - m)
            v += 0.01 * (grad * grad - v)
            param -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return net


@dataclass
class Tables:
    """A trained network as sums of table rows: by pairs of bytes, and by the last byte of an odd width."""

    languages: list[str]
    pairs: list[list[np.ndarray]]
    single: list[np.ndarray | None]
    bias: list[np.ndarray]
    out: np.ndarray
    out_bias: np.ndarray

    @classmethod
    def of(cls, net: Network) -> Tables:
        pairs, single = [], []
        for width, weight in zip(WIDTHS, net.filters):
            by_place = [net.embedding @ weight[i * EMBEDDING : (i + 1) * EMBEDDING] for i in range(width)]
            steps = range(0, width - 1, 2)
            pairs.append([(by_place[i][:, None] + by_place[i + 1][None]).reshape(65536, -1) for i in steps])
            single.append(by_place[-1] if width % 2 else None)
        return cls(net.languages, pairs, single, net.bias, net.out, net.out_bias)

    def log_probabilities(self, windows: np.ndarray) -> np.ndarray:
        """Row per window, column per language."""
        pair = (windows[:, :-1].astype(np.int32) << 8 | windows[:, 1:]).astype(np.intp)
        pooled, length = [], windows.shape[1]
        for width, tables, single, bias in zip(WIDTHS, self.pairs, self.single, self.bias):
            n = length - width + 1
            answer = np.take(tables[0], pair[:, :n], axis=0, mode="clip")
            for i, table in enumerate(tables[1:], 1):
                answer += np.take(table, pair[:, 2 * i : 2 * i + n], axis=0, mode="clip")
            if single is not None:
                answer += np.take(single, windows[:, width - 1 : width - 1 + n], axis=0, mode="clip")
            pooled.append(np.maximum(answer.max(axis=1) + bias, 0))
        return np.log(np.maximum(softmax(np.hstack(pooled) @ self.out + self.out_bias), 1e-12))


# --- Spark ---


def fit(docs: DataFrame, texts: int = TEXTS, steps: int = STEPS) -> Tables | None:
    """Learn from ``text`` and non-null ``lang`` of documents whose crc32 modulo 5 is not 0; None without any.

    Texts are drawn by a hash of their id, at a rate that gives about ``texts`` of each language (all of a rarer one);
    what reaches the driver is their windows, ``texts * WINDOWS`` of :data:`WINDOW` bytes for each language.
    """
    known = private(docs, ["doc_id", "text", "lang"]).filter("lang is not null and text is not null")
    known = known.filter(crc_mod("doc_id", 5) != 0).withColumn("lang", F.col("lang").cast("string"))
    counts = {row.lang: row.n for row in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return None
    languages = sorted(counts)
    rates = F.create_map(*(F.lit(x) for lang in languages for x in (lang, texts / counts[lang])))
    drawn = F.pmod(F.xxhash64("doc_id", "lang"), F.lit(1 << 30)) / F.lit(float(1 << 30))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, langs, found = [], [], []
            for doc, text, lang in zip(*(batch.column(i) for i in range(3))):
                text = text.as_py()
                if not has_letter(text):
                    continue
                windows = cut(text.encode("utf-8", "replace"))
                for i in sorted({i * (len(windows) - 1) // max(WINDOWS - 1, 1) for i in range(WINDOWS)}):
                    ids.append(doc.as_py())
                    langs.append(lang.as_py())
                    found.append(windows[i].tobytes())
            arrays = [pa.array(ids, pa.int64()), pa.array(langs, pa.string()), pa.array(found, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "lang", "window"])

    drawn_rows = known.filter(drawn < F.element_at(rates, F.col("lang"))).withColumn("doc_id", F.col("doc_id").cast("bigint"))
    sample = drawn_rows.mapInArrow(rows, "doc_id bigint, lang string, window binary").collect()
    if not sample:
        return None
    sample.sort(key=lambda r: (r.doc_id is None, r.doc_id or 0, r.lang, bytes(r.window)))
    present = sorted({r.lang for r in sample})
    label = np.array([present.index(r.lang) for r in sample])
    windows = np.frombuffer(b"".join(bytes(r.window) for r in sample), np.uint8).reshape(-1, WINDOW)
    return Tables.of(train(windows, label, present, steps))


def languages(docs: DataFrame, tables: Tables | None) -> DataFrame:
    """``doc_id, lang_pred, score``, one row per document, from its whole text.

    ``und`` with score 0 where the text is null or has no letter, or nothing could be learned.
    """
    handed = docs.sparkSession.sparkContext.broadcast(tables)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = handed.value
        for batch in batches:
            n = batch.num_rows
            sums = np.zeros((n, len(tables.languages) if tables else 1))
            count = np.zeros(n)
            held, owner = [], []

            def flush() -> None:
                if held:
                    found = tables.log_probabilities(np.vstack(held))
                    np.add.at(sums, np.concatenate(owner), found)
                    held.clear()
                    owner.clear()

            waiting = 0
            for i, text in enumerate(batch.column(1)):
                text = text.as_py()
                if tables is None or not has_letter(text):
                    continue
                windows = cut(text.encode("utf-8", "replace"))
                count[i] = len(windows)
                for at in range(0, len(windows), AT_ONCE):
                    held.append(windows[at : at + AT_ONCE])
                    owner.append(np.full(len(held[-1]), i))
                    waiting += len(held[-1])
                    if waiting >= AT_ONCE:
                        flush()
                        waiting = 0
            flush()
            mean = softmax(sums / np.maximum(count, 1)[:, None])
            best = mean.argmax(axis=1)
            names = [tables.languages[b] if c else UNKNOWN for b, c in zip(best, count)]
            score = np.where(count > 0, mean[np.arange(n), best], 0.0)
            arrays = [batch.column(0), pa.array(names, pa.string()), pa.array(score, pa.float64())]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "lang_pred", "score"])

    source = private(docs, ["doc_id", "text"]).withColumn("doc_id", F.col("doc_id").cast("bigint"))
    return source.mapInArrow(rows, "doc_id bigint, lang_pred string, score double")


def language_id(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score``. Null and repeated ids are rows like any other; an empty table gives an
    empty result; no column but ``text`` enters a prediction."""
    rows = languages(docs, fit(docs))
    return rows.select("doc_id", (crc_mod("doc_id", 5) == 0).alias("held_out"), "lang_pred", "score")
