"""Language identification by a small byte convolutional network."""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from garimpo.llm.common import bound_batches, lean, lowest, map_batches, small

#: Bytes of a window; a text is cut into such windows and the last one is filled with zero bytes.
WINDOW = 256
#: Widths of the convolution filters, and how many filters each width has.
WIDTHS = (2, 3, 4)
FILTERS = 8
#: Windows whose activations are worked out at once, so that they stay in the processor's cache.
AT_ONCE = 256
#: Labelled rows the network is fitted on, and characters taken of each: the bound of the sample that the driver holds.
SAMPLE_ROWS = 6000
SAMPLE_CHARS = 1024
UNKNOWN = "und"

_ASCII_LETTER = re.compile(rb"[A-Za-z]")
_LETTER = regex.compile(r"\p{L}")


class Network(NamedTuple):
    languages: list[str]
    tables: list[np.ndarray]  # per width: (width, 256, FILTERS), the weights of a byte at each place under a filter
    bias: list[np.ndarray]
    out: np.ndarray  # (features, languages)
    out_bias: np.ndarray


def windows(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the texts as rows of fixed length, and which text each row is of; an empty text has one row of zeros."""
    counts = np.array([max(1, -(-len(t) // WINDOW)) for t in texts])
    rows = np.zeros((counts.sum(), WINDOW), np.uint8)
    flat, at = rows.reshape(-1), 0
    for text, n in zip(texts, counts, strict=True):
        flat[at : at + len(text)] = np.frombuffer(text, np.uint8)
        at += n * WINDOW
    return rows, np.repeat(np.arange(len(texts)), counts)


def features(net: Network, rows: np.ndarray, places: list | None = None) -> np.ndarray:
    """The maximum of each filter over a window. Under one-hot bytes a filter is a sum of table rows."""
    pooled = []
    for table, bias in zip(net.tables, net.bias, strict=True):
        width = len(table)
        span = WINDOW - width + 1
        total = table[0][rows[:, :span]]
        for j in range(1, width):
            total += table[j][rows[:, j : j + span]]
        if places is not None:
            places.append(total.argmax(axis=1))
        pooled.append(total.max(axis=1) + bias)
    return np.maximum(np.concatenate(pooled, axis=1), 0)


def log_softmax(scores: np.ndarray) -> np.ndarray:
    scores = scores - scores.max(axis=1, keepdims=True)
    return scores - np.log(np.exp(scores).sum(axis=1, keepdims=True))


def train(texts: list[bytes], labels: list[str], steps: int = 800, batch: int = 64, rate: float = 0.003) -> Network:
    """Fit the network by Adam on one random window of each text and epoch, some of them cut short as short texts are."""
    rng = np.random.default_rng(7)
    languages = sorted(set(labels))
    target = np.array([languages.index(x) for x in labels])
    size = FILTERS * len(WIDTHS)
    net = Network(
        languages,
        [rng.normal(0, 0.3, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS],
        [np.zeros(FILTERS, np.float32) for _ in WIDTHS],
        rng.normal(0, 0.3, (size, len(languages))).astype(np.float32),
        np.zeros(len(languages), np.float32),
    )
    weights = [*net.tables, *net.bias, net.out, net.out_bias]
    first, second = ([np.zeros_like(w) for w in weights] for _ in range(2))
    step = 0
    for _ in range(-(-steps * batch // len(texts))):
        order = rng.permutation(len(texts))
        for i in range(0, len(order), batch):
            some = order[i : i + batch]
            cut = []
            for k in some:
                text = texts[k]
                at = int(rng.integers(0, max(1, len(text) - WINDOW + 1)))
                length = WINDOW if rng.random() < 0.7 else int(rng.integers(16, WINDOW))
                cut.append(text[at : at + length])
            rows, _ = windows(cut)
            places: list[np.ndarray] = []
            x = features(net, rows, places)
            gradient = np.exp(log_softmax(x @ net.out + net.out_bias))
            gradient[np.arange(len(some)), target[some]] -= 1
            gradient /= len(some)
            back = (gradient @ net.out.T) * (x > 0)
            tables, bias = [], []
            for f, (table, place) in enumerate(zip(net.tables, places, strict=True)):
                part = back[:, f * FILTERS : (f + 1) * FILTERS]
                change = np.zeros_like(table)
                for j in range(len(table)):  # only the place of the maximum passes the gradient on
                    seen = np.take_along_axis(rows, place + j, axis=1)
                    np.add.at(change[j], (seen, np.arange(FILTERS)[None, :]), part)
                tables.append(change)
                bias.append(part.sum(axis=0))
            step += 1
            for w, m, v, g in zip(weights, first, second, [*tables, *bias, x.T @ gradient, gradient.sum(axis=0)], strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return net


def predict(net: Network, texts: list[bytes]) -> tuple[list[str], list[float]]:
    """Language and its probability: the mean of the windows' log probabilities over the whole text, normalised."""
    rows, of = windows(texts)
    logs = np.concatenate(
        [log_softmax(features(net, rows[i : i + AT_ONCE]) @ net.out + net.out_bias) for i in range(0, len(rows), AT_ONCE)]
    )
    sums = np.zeros((len(texts), len(net.languages)))
    np.add.at(sums, of, logs)
    mean = log_softmax(sums / np.bincount(of, minlength=len(texts))[:, None])
    best = mean.argmax(axis=1)
    return [net.languages[b] for b in best], np.exp(mean[np.arange(len(texts)), best]).clip(0, 1).tolist()


def has_letter(text: bytes) -> bool:
    return bool(_ASCII_LETTER.search(text) or _LETTER.search(text.decode()))


def held_out(id_col: Column, folds: int = 3, fold: int = 1) -> Column:
    """Whether a row is kept from training: the CRC-32 of its id as text, in `folds` folds. A null id counts as empty text."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % folds == fold


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", rows: int = SAMPLE_ROWS) -> Network | None:
    """Fit on the `rows` training documents with the lowest hash of id, text and place, up to 1024 characters of each.

    The sample is bounded, so a fixed amount reaches the driver. The place, which is a row's in its part of the table, tells rows apart
    whose ids and texts repeat, so the same share of any table is below the cut. Texts without letters teach nothing. None
    if no labelled row is left.
    """
    doc_id, text = F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    place = F.monotonically_increasing_id()
    order = F.xxhash64(F.coalesce(doc_id.cast("string"), F.lit("")), text, place, F.lit("sample"))
    learned = docs.where(~held_out(doc_id) & F.col(f"`{lang_col}`").isNotNull() & text.isNotNull())
    named = learned.select(order.alias("_id"), text.alias("_whole"), F.col(f"`{lang_col}`").alias("_lang"))
    start = F.pmod("_id", F.greatest(F.length("_whole") - SAMPLE_CHARS, F.lit(1))) + 1
    some = named.select("_id", F.substring("_whole", start.cast("int"), F.lit(SAMPLE_CHARS)).alias("_text"), "_lang")
    sample = lowest(some, F.col("_id"), rows).orderBy("_id", "_text", "_lang").collect()
    known = [(r["_text"].encode(), r["_lang"]) for r in sample]
    known = [(t, lang) for t, lang in known if has_letter(t)]
    return train([t for t, _ in known], [lang for _, lang in known]) if known else None


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for every whole text.

    The network is fitted on a bounded sample of labelled rows outside the held-out fold and sees the bytes of the text
    alone. A null text and one without a letter are `und` with score 0, as is every text if nothing is labelled. Very
    long texts are read window by window to their end. Rows with equal or null ids are kept. An empty table
    gives an empty result. Other columns are ignored.
    """
    net = fit(docs, id_col, text_col, lang_col)

    def run(ids: list, texts: list, held: list) -> Iterator[dict]:
        lang, score = [UNKNOWN] * len(ids), [0.0] * len(ids)
        known = [i for i, t in enumerate(texts) if net and t and has_letter(t)]
        if known:
            for i, name, p in zip(known, *predict(net, [texts[i] for i in known]), strict=True):
                lang[i], score[i] = name, p
        yield {"doc_id": ids, "held_out": held, "lang_pred": lang, "score": score}

    doc_id = F.col(f"`{id_col}`")
    kept = docs.select(doc_id.alias("doc_id"), F.col(f"`{text_col}`").alias("text"), held_out(doc_id).alias("held_out"))
    return map_batches(kept, run, f"doc_id {kept.dtypes[0][1]}, held_out boolean, lang_pred string, score double")


def known_language(docs: DataFrame, least: float = 0.5, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The documents whose language the network knows with at least `least` probability, all columns as they are.

    One pass: the decision is made beside the row, so no join is needed and equal ids don't matter.
    """
    net = fit(docs, id_col, text_col, lang_col)

    def run(texts: list) -> list[bool]:
        keep = [False] * len(texts)
        known = [i for i, t in enumerate(texts) if net and t and has_letter(t)]
        if known:
            for i, p in zip(known, predict(net, [texts[i] for i in known])[1], strict=True):
                keep[i] = p >= least
        return keep

    def batches(parts: Iterator) -> Iterator:
        import pyarrow as pa

        for part in small(parts):
            texts = part.column(place).cast(pa.large_binary()).to_pylist()
            yield part.filter(pa.array(run(texts), pa.bool_()))

    place = docs.columns.index(text_col)
    bound_batches(docs.sparkSession)
    return docs.mapInArrow(lean(batches), docs.schema)
