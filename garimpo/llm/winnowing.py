"""Document fingerprints by winnowing, and how like a document's fingerprint is to those of an edited text and of its successor."""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from garimpo.llm.common import bound_batches, columns, lean, map_batches, pa_schema, small
from garimpo.session import settle, shuffle_partitions

#: Bytes of a gram and grams of a window: whatever GRAM + WINDOW - 1 bytes two texts share leaves a common fingerprint, and
#: nothing shorter than GRAM bytes does.
GRAM, WINDOW = 24, 40
#: The rolling hash is a polynomial in this odd number modulo 2 ** 64, mixed and cut to HASH_BITS; the low bits of a key hold the place.
BASE = 0x9E3779B97F4A7C15
HASH_BITS, PLACE_BITS = 40, 24
HASH_HEX = HASH_BITS // 4
#: Windows looked at at once, so that a place fits its bits.
AT_ONCE = 1 << 22


class Fingerprint(NamedTuple):
    places: np.ndarray  # byte offsets of the grams chosen, ascending
    hashes: np.ndarray  # their hashes

    def hex(self) -> str:
        """The hashes in order of place, `HASH_HEX` lower-case digits each."""
        return self.hashes.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - HASH_BITS // 8 :].tobytes().hex()


def gram_hashes(text: np.ndarray, gram: int) -> np.ndarray:
    """The hash of the gram at each place: spans of doubling length are put together, one multiplication each."""
    size, whole, power = 1, None, BASE
    span = text.astype(np.uint64) + np.uint64(1)
    done = 0  # bytes that `whole` covers
    n = len(text) - gram + 1
    while done < gram:
        if gram & size:
            part = span[done : done + n]
            whole = part.copy() if whole is None else whole * np.uint64(power) + part
            done += size
        if size * 2 <= gram:
            span = span[:-size] * np.uint64(power) + span[size:]
        size, power = size * 2, power * power % (1 << 64)
    whole ^= whole >> np.uint64(29)
    whole *= np.uint64(0xBF58476D1CE4E5B9)
    return whole >> np.uint64(64 - HASH_BITS)


def winnow(text: bytes, gram: int = GRAM, window: int = WINDOW) -> Fingerprint:
    """Of every `window` grams in a row the one with the least hash, the rightmost of those that tie; each is kept once.

    A text shorter than a gram is one gram, an empty one has none; fewer grams than a window are one window.
    """
    if not text:
        return Fingerprint(np.zeros(0, np.int64), np.zeros(0, np.uint64))
    hashes = gram_hashes(np.frombuffer(text, np.uint8), min(gram, len(text)))
    width = min(window, len(hashes))
    last = len(hashes) - width  # the last window's start
    chosen = []
    for first in range(0, last + 1, AT_ONCE):
        some = hashes[first : min(first + AT_ONCE, last + 1) + width - 1]
        # The hash above, the place counted down below: the least key is the least hash, the rightmost of equal ones.
        key = (some << np.uint64(PLACE_BITS)) | np.arange(len(some) - 1, -1, -1, dtype=np.uint64)
        size = 1
        low = key
        while size * 2 <= width:
            low = np.minimum(low[:-size], low[size:])
            size *= 2
        if size < width:
            low = np.minimum(low[: len(low) - (width - size)], low[width - size :])
        fresh = np.ones(len(low), bool)
        fresh[1:] = low[1:] != low[:-1]
        chosen.append(len(some) - 1 - (low[fresh] & np.uint64((1 << PLACE_BITS) - 1)).astype(np.int64) + first)
    places = np.concatenate(chosen)
    if len(chosen) > 1:
        places = np.unique(places)
    return Fingerprint(places, hashes[places])


def likeness(a: Fingerprint, b: Fingerprint) -> float:
    """Hashes in common over all hashes, repeats counted; two fingerprints without any are alike."""
    both = len(a.hashes) + len(b.hashes)
    if not both:
        return 1.0
    (x, n), (y, m) = (np.unique(f.hashes, return_counts=True) for f in (a, b))
    _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    common = int(np.minimum(n[i], m[j]).sum())
    return common / (both - common)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """(doc_id, n_chars, marks, fingerprint) of every whole text: `marks` is an array of (place, hash) by place.

    Two texts that share `gram + window - 1` bytes share a mark, and no mark is shared below `gram` bytes but by a chance of 2 ** -40 a
    pair. A null text is an empty one and has no marks; a text shorter than a gram is one gram. Very long texts are read to
    their end. Equal texts have equal fingerprints. Rows with equal or null ids are kept. An empty table gives an empty
    result. Other columns are ignored.
    """

    def run(ids: list, texts: list) -> Iterator[dict]:
        texts = [t or b"" for t in texts]
        found = [winnow(t, gram, window) for t in texts]
        yield {
            "doc_id": ids,
            "n_chars": [len(t.decode()) for t in texts],
            "marks": [
                [{"place": p, "hash": h} for p, h in zip(f.places.tolist(), f.hashes.tolist(), strict=True)] for f in found
            ],
            "fingerprint": [f.hex() for f in found],
        }

    kept = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    marks = "array<struct<place: bigint, hash: bigint>>"
    return map_batches(kept, run, f"doc_id {kept.dtypes[0][1]}, n_chars long, marks {marks}, fingerprint string")


def edited(text: str, successor: str) -> str:
    """The last third of the code points (rounded down) replaced by the first as many of the successor, or all it has."""
    cut = len(text) // 3
    return text[: len(text) - cut] + successor[:cut]


#: What a dealt row is: the text a block begins after, a row of the block, a row that is its own successor.
AHEAD, OWN, ALONE = 0, 1, 2


def successors(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of every whole text.

    A row's successor is the next one in descending order of the id, null ids last; the last row's is the first. Rows of one id go by
    a hash of their text; equal rows are each other's successors in a row. `edited` makes the edited text, `likeness`
    compares the text's fingerprint with the edited text's and with the successor's.

    Three steps: the ids and text hashes alone are dealt by range, which gives the last key of each block of the order (as
    many keys as shuffle partitions reach the driver). Each row then goes to its block, and the last one of a block also to the
    one after it: one shuffle of the texts. A block is read in ascending order, so the row before is the
    successor, and two texts are held at a time. Of equal rows that a task reads together all but one are their own
    successors and are dealt anywhere, so that many copies of one row don't go to one task.

    A null text is an empty one. A single row is its own successor. Rows with equal or null ids are kept. An empty table gives an
    empty result. Other columns are ignored.
    """
    parts = shuffle_partitions(docs.sparkSession)
    bound_batches(docs.sparkSession)
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.xxhash64(text).alias("hash"), text.alias("text"))
    kind = rows.dtypes[0][1]
    order = [F.col("doc_id").asc_nulls_first(), F.col("hash")]

    keys = settle(rows.select("doc_id", "hash").distinct(), "keys")
    dealt = keys.repartitionByRange(parts, *order).groupBy(F.spark_partition_id().alias("part"))
    last = dealt.agg(F.max(F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", "hash")).alias("last"))
    ends = sorted(_key(r["last"]["doc_id"], r["last"]["hash"]) for r in last.collect())

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, batch in enumerate(batches):
            ids, hashes, texts = (c.to_pylist() for c in batch.columns)
            seen = set()
            block, what, at = [], [], []
            for i, (doc_id, h) in enumerate(zip(ids, hashes, strict=True)):
                b = bisect_left(ends, _key(doc_id, h))
                if (doc_id, h, texts[i]) in seen:
                    block.append((number * 7919 + i) % len(ends))
                    what.append(ALONE)
                    at.append(i)
                    continue
                seen.add((doc_id, h, texts[i]))
                block.append(b)
                what.append(OWN)
                at.append(i)
                if ends[b] == _key(doc_id, h):
                    block.append((b + 1) % len(ends))
                    what.append(AHEAD)
                    at.append(i)
            rest = batch.take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(block, pa.int32()), pa.array(what, pa.int32()), *rest.columns], schema=placed_schema
            )

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, before_print = "", None
        for batch in small(batches, 200):
            out: dict[str, list] = {f.name: [] for f in schema}
            _, kinds, ids, _, texts = columns(batch)
            for what, doc_id, data in zip(kinds, ids, texts, strict=True):
                now, own = data.decode(), winnow(data, gram, window)
                if what != AHEAD:
                    follows, follows_print = (before, before_print) if what == OWN else (now, own)
                    change = edited(now, follows).encode()
                    marks = winnow(change, gram, window)
                    out["doc_id"].append(doc_id)
                    out["n_chars"].append(len(now))
                    out["edited_sha256"].append(hashlib.sha256(change).hexdigest())
                    out["fingerprint"].append(own.hex())
                    out["edited_fingerprint"].append(marks.hex())
                    out["near_edited"].append(likeness(own, marks))
                    out["near_next"].append(likeness(own, follows_print))
                if what != ALONE:
                    before, before_print = now, own
            yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in schema], schema=schema)

    result = (
        f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double"
    )
    schema = pa_schema(docs, result)
    placed = f"block int, what int, doc_id {kind}, hash long, text string"
    placed_schema = pa_schema(docs, placed)
    # Of a block's rows the one it begins after comes first, wherever it lies in the order; then those that need none.
    lead = F.when(F.col("what") == AHEAD, 0).when(F.col("what") == ALONE, 1).otherwise(2)
    blocks = rows.mapInArrow(lean(place), placed).repartition(parts, "block").sortWithinPartitions("block", lead, *order)
    return blocks.mapInArrow(lean(compare), result)


def _key(doc_id: object, text_hash: int) -> tuple:
    """Sorts as Spark does with nulls first."""
    return (0, text_hash) if doc_id is None else (1, doc_id, text_hash)
