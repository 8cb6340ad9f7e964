"""Exact repeats of long byte strings, found by merging shard Burrows-Wheeler transforms."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from garimpo.llm.common import batches_of, bound_batches, columns, lean, small, starts, whole_keys
from garimpo.session import settle

#: Bytes of a string that counts as repeated, and of the anchors that lead to it.
LENGTH, ANCHOR = 200, 56
#: An anchor is a gram that is lowest among this many in a row, so every string of `LENGTH` bytes holds one, and equal strings
#: hold the same ones at the same places.
SPREAD = LENGTH - ANCHOR + 1
#: Bytes of a symbol of the transform; `LENGTH` is a multiple of it.
STEP = 50
#: Bits of the filter that tells which anchors may be repeated: its size is fixed, and all it can do is let too many pass.
FILTER_BITS = 1 << 26
FILTER_BLOCK = 1 << 14
#: Contexts of one anchor that are merged. The windows of a larger group are compared by hash place by place, in memory up to the
#: second bound and as rows dealt by hash beyond it: as exact, with less memory a context.
GROUP, WIDE = 2_000, 150_000
#: Contexts in a shard.
SHARD = 256

_BASES = (0x2545F4914F6CDD1D, 0x9E6C63D0876A9A35)
_powers: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}


def _power(n: int, base: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    size = 1 << max(12, n.bit_length())
    if (size, base) not in _powers:
        up = np.full(size, base, np.uint64)
        down = np.full(size, pow(base, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        _powers[size, base] = np.multiply.accumulate(up), np.multiply.accumulate(down)
    up, down = _powers[size, base]
    return up[:n], down[:n]


class Hashes:
    """64-bit hashes of any substrings of a byte string, from prefix sums."""

    def __init__(self, data: np.ndarray, base: int = _BASES[0]) -> None:
        up, self.down = _power(len(data) + 1, base)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1], out=self.sums[1:])

    def of(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        return _mixed((self.sums[high] - self.sums[low]) * self.down[low])

    def grams(self, n: int) -> np.ndarray:
        return _mixed((self.sums[n:] - self.sums[:-n]) * self.down[: len(self.sums) - n])


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(31))
    h *= np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def _slide(values: np.ndarray, width: int, pick: np.ufunc) -> np.ndarray:
    """The least or greatest of every `width` values in a row, by doubling."""
    done, held = 1, values
    while done * 2 <= width:
        held = pick(held[:-done], held[done:])
        done *= 2
    count, rest = len(values) - width + 1, width - done
    return pick(held[:count], held[rest : rest + count])


def anchors(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of the anchors of a text of at least `LENGTH` bytes, their hashes, and the hashes of their contexts.

    A context is every byte that a string of `LENGTH` bytes around the anchor can cover; its hash tells the anchor's place in it as
    well, so equal contexts of different anchors lie at different places. Grams that tie for the lowest are all anchors.
    """
    hashes = Hashes(data)
    grams = hashes.grams(ANCHOR)
    low = _slide(grams, SPREAD, np.minimum)
    edge = np.zeros(SPREAD - 1, np.uint64)
    at = np.flatnonzero(_slide(np.concatenate([edge, low, edge]), SPREAD, np.maximum) == grams)
    first, last = context(at, len(data))
    return at, grams[at], _mixed(hashes.of(first, last) + (at - first).astype(np.uint64))


def context(at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    return np.maximum(at - (LENGTH - ANCHOR), 0), np.minimum(at + LENGTH, size)


def _signed(h: np.ndarray) -> pa.Array:
    return pa.array(h.view(np.int64))


def _grams(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(anchor, around, n) of a batch of texts, counted before the shuffle."""
    for part in small(parts):
        found = [anchors(np.frombuffer(t, np.uint8))[1:] for t in columns(part)[0] if t and len(t) >= LENGTH]
        if found:
            both = np.empty(sum(len(a) for a, _ in found), [("a", "<u8"), ("c", "<u8")])
            both["a"], both["c"] = (np.concatenate(x) for x in zip(*found, strict=True))
            order = np.lexsort((both["c"], both["a"]))
            both = both[order]
            at = np.flatnonzero(np.append(True, both[1:] != both[:-1]))
            count = np.diff(np.append(at, len(both)))
            yield pa.RecordBatch.from_arrays(
                [_signed(np.ascontiguousarray(both["a"][at])), _signed(np.ascontiguousarray(both["c"][at])), pa.array(count)],
                names=["anchor", "around", "n"],
            )


def repeated_anchors(texts: DataFrame) -> DataFrame:
    """(anchor, around, n, others): contexts of anchors that occur at least twice; others: the anchor has further contexts.

    One shuffle by anchor serves the counts of contexts and of anchors.
    """
    counts = texts.mapInArrow(lean(_grams), "anchor long, around long, n long").repartition("anchor")
    counts = counts.groupBy("anchor", "around").agg(F.sum("n").alias("n"))
    group = Window.partitionBy("anchor")
    told = counts.withColumn("_all", F.sum("n").over(group)).withColumn("_kinds", F.count(F.lit(1)).over(group))
    singles = F.sum((F.col("n") == 1).cast("int")).over(group)
    return settle(
        told.withColumn("others", (F.col("_kinds") > 1) & (singles > 0)).where("_all > 1").select("anchor", "around", "n", "others"),
        "anchors",
    )


def _filter(repeated: DataFrame) -> np.ndarray:
    """A bitmap of fixed size with a bit for every repeated anchor."""

    def fill(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks: dict[int, np.ndarray] = {}
        for part in parts:
            bits = part["bit"].to_numpy()
            for block in np.unique(bits // FILTER_BLOCK):
                blocks.setdefault(int(block), np.zeros(FILTER_BLOCK, bool))[bits[bits // FILTER_BLOCK == block] % FILTER_BLOCK] = True
        rows = [pa.array(list(blocks), pa.int64()), pa.array([np.packbits(x, bitorder="little").tobytes() for x in blocks.values()], pa.binary())]
        yield pa.RecordBatch.from_arrays(rows, names=["block", "bits"])

    bit = F.pmod("anchor", F.lit(FILTER_BITS))
    bits = repeated.select(bit.alias("bit")).distinct().repartition(F.floor(F.col("bit") / FILTER_BLOCK))
    out = np.zeros(FILTER_BITS // 8, np.uint8)
    for row in bits.mapInArrow(lean(fill), "block long, bits binary").toLocalIterator():
        at = row["block"] * FILTER_BLOCK // 8
        out[at : at + FILTER_BLOCK // 8] = np.frombuffer(row["bits"], np.uint8)
    return out


def repeated_windows(body: np.ndarray, ends: np.ndarray, shard: int = SHARD) -> tuple[np.ndarray, np.ndarray]:
    """Places where a string of `LENGTH` bytes starts that starts elsewhere too, and the class of each such string.

    `body` is contexts laid end to end, `ends` where each ends; no string crosses an end. The transform is taken in steps of
    `STEP` bytes: a suffix's symbol is the `STEP` bytes at it, and its forerunner starts `STEP` bytes earlier. Every shard of contexts has its
    suffixes in the order of their first symbol, and with them, as its transform, the forerunners' symbols. The merge starts with the
    shards' orders one after the other, interleaved by the counts of the symbols. Each pass sends the forerunners, in the present
    order, to the bucket of their symbol, at the place that counting gives: no suffixes are compared or sorted again. So
    after pass t suffixes are in the order of their first t symbols, with a border where symbol or block changes: neighbours first parted
    by pass t share t - 1 symbols. A block of one suffix is finished, and so are all its forerunners; only open blocks go on. What is
    still together after `LENGTH` bytes is a repeated string.
    """
    size = np.diff(np.append(0, ends))
    place = np.arange(len(body), dtype=np.int32)
    offset = place - np.repeat((ends - size).astype(np.int32), size)
    valid = np.flatnonzero(np.repeat(ends.astype(np.int32), size) - place >= STEP)
    if not len(valid):
        return valid, valid
    hashes = np.zeros(len(body), np.uint64)
    hashes[valid] = Hashes(body).of(valid, valid + STEP)
    kinds, numbers = np.unique(hashes[valid], return_inverse=True)
    symbol = np.zeros(len(body), np.uint32)
    symbol[valid] = numbers
    # The shards' orders one after the other, and their first interleave.
    runs = np.split(valid, np.searchsorted(valid, ends[shard - 1 : -1 : shard]))
    order = np.concatenate([run[_counted(symbol[run], len(kinds))] for run in runs])
    order = order[_counted(symbol[order], len(kinds))]
    block = _blocks(symbol[order])
    for _ in range(LENGTH // STEP - 1):
        order, block = _open(order, block)
        ahead = offset[order] >= STEP
        order, block = order[ahead] - STEP, block[ahead]
        # To the buckets of the symbols, in the present order of blocks.
        sent = _counted(symbol[order], len(kinds))
        order, block = order[sent], block[sent]
        block = _blocks(symbol[order].astype(np.int64) << 32 | block)
    return _open(order, block)


def _counted(symbol: np.ndarray, kinds: int) -> np.ndarray:
    """Who comes at each place if all go to the bucket of their symbol, in the order they come: by counting, 16 bits at a time."""
    sent = np.argsort((symbol & 0xFFFF).astype(np.uint16), kind="stable")
    if kinds > 1 << 16:
        sent = sent[np.argsort((symbol[sent] >> 16).astype(np.uint16), kind="stable")]
    return sent


def _blocks(values: np.ndarray) -> np.ndarray:
    """Numbers of the runs of equal values."""
    return np.cumsum(np.append(True, values[1:] != values[:-1])) if len(values) else np.zeros(0, np.int64)


def _open(order: np.ndarray, block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Without the blocks of a single suffix."""
    if not len(order):
        return order, block
    alone = np.bincount(block)[block] == 1
    return order[~alone], block[~alone]


def _runs(owner: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(owner, from, to): the bytes that windows at these places cover."""
    order = np.lexsort((at, owner))
    owner, at = owner[order], at[order]
    first = np.append(True, (owner[1:] != owner[:-1]) | (at[1:] > at[:-1] + LENGTH))
    last = np.append(first[1:], True)
    return owner[first], at[first], at[last] + LENGTH


_FOUND = "key binary, low int, high int"


def _spans(keys: list[bytes], low: np.ndarray, high: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(keys, pa.binary()), pa.array(low, pa.int32()), pa.array(high, pa.int32())], names=["key", "low", "high"]
    )


def _merged(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Contexts sorted by anchor give the covered spans of those that occur once, one table of whole anchors at a time."""
    for table in whole_keys(parts, ["anchor"], 1000):
        keys, bodies = table["key"].to_pylist(), table["body"].to_pylist()
        start, once = table["low"].to_numpy(), table["n"].to_numpy() == 1
        size = np.array([len(b) for b in bodies])
        _, document = np.unique(np.array(keys, object), return_inverse=True)
        if len(bodies) > GROUP:
            spots = _aligned(bodies, size, table["off"].to_numpy(), start, document, once)
        else:
            spots = _together(bodies, size, start, document, once)
        if len(spots[0]):
            owner, low, high = _runs(*spots)
            name = np.zeros(document.max() + 1, np.int64)
            name[document] = np.arange(len(keys))
            yield _spans([keys[i] for i in name[owner]], low, high)


def _together(bodies: list[bytes], size: np.ndarray, start: np.ndarray, document: np.ndarray, once: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document, place) of the repeated windows of contexts that occur once, by the merged transform."""
    ends = np.cumsum(size)
    at, block = repeated_windows(np.frombuffer(b"".join(bodies), np.uint8), ends)
    owner = np.searchsorted(ends, at, side="right")
    place = start[owner] + at - (ends - size)[owner]
    kept = _differ(block, document[owner], place) & once[owner]
    return document[owner[kept]], place[kept]


def _differ(block: np.ndarray, document: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Which rows are in a block that holds two different places; a context may overlap another of its document."""
    if not len(block):
        return np.zeros(0, bool)
    order = np.lexsort((place, document, block))
    block, document, place = block[order], document[order], place[order]
    border = np.append(True, block[1:] != block[:-1])
    new = border | np.append(True, (document[1:] != document[:-1]) | (place[1:] != place[:-1]))
    number = np.cumsum(border) - 1
    out = np.zeros(len(order), bool)
    out[order] = np.bincount(number[new])[number] > 1
    return out


def _aligned(
    bodies: list[bytes], size: np.ndarray, off: np.ndarray, start: np.ndarray, document: np.ndarray, once: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """The same for many contexts, by a hash of each window.

    Equal strings hold their lowest gram at the same place, so only windows that start equally far before the anchor can be equal.
    """
    ahead = LENGTH - ANCHOR
    hashes = np.zeros((len(bodies), SPREAD), np.uint64)
    up, down = _power(ahead + LENGTH + 1, _BASES[0])
    for at in range(0, len(bodies), 1000):
        some = bodies[at : at + 1000]
        rows = np.zeros((len(some), ahead + LENGTH), np.uint8)
        for row, body, shift in zip(rows, some, ahead - off[at : at + 1000], strict=True):
            row[shift : shift + len(body)] = np.frombuffer(body, np.uint8)
        sums = np.zeros((len(some), ahead + LENGTH + 1), np.uint64)
        np.cumsum((rows.astype(np.uint64) + np.uint64(1)) * up[:-1], axis=1, out=sums[:, 1:])
        hashes[at : at + 1000] = _mixed((sums[:, LENGTH:] - sums[:, :SPREAD]) * down[:SPREAD])
    documents, places = [], []
    for column in range(SPREAD):
        first = column - (ahead - off)  # of the window in the context
        inside = np.flatnonzero((first >= 0) & (first + LENGTH <= size))
        place = start[inside] + first[inside]
        kept = _differ(hashes[inside, column], document[inside], place) & once[inside]
        documents.append(document[inside[kept]])
        places.append(place[kept])
    return np.concatenate(documents), np.concatenate(places)


def _windows(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every window of a context with two independent hashes."""
    for part in parts:
        for key, body, low, n in zip(*(part[c].to_pylist() for c in ("key", "body", "low", "n")), strict=True):
            data = np.frombuffer(body, np.uint8)
            hashes = [_signed(Hashes(data, base).grams(LENGTH)) for base in _BASES]
            count = len(hashes[0])
            yield pa.RecordBatch.from_arrays(
                [*hashes, pa.array([key] * count, pa.binary()), pa.array(np.arange(low, low + count, dtype=np.int32)), pa.array([n] * count, pa.int64())],
                names=["one", "two", "key", "at", "n"],
            )


def _shared_spans(contexts: DataFrame) -> DataFrame:
    """(key, low, high): spans of contexts that occur once whose windows also start elsewhere."""
    large = contexts.groupBy("anchor").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > WIDE).select("anchor", F.lit(True).alias("_large"))
    sized = contexts.join(large, "anchor", "left")
    small = sized.where("_large is null").select("anchor", "key", "low", "off", "n", "body")
    merged = small.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(lean(_merged), _FOUND)
    windows = sized.where("_large").select("key", "body", "low", "n").mapInArrow(lean(_windows), "one long, two long, key binary, at int, n long")
    # A window repeats if its two hashes have two places.
    same = Window.partitionBy("one", "two")
    places = windows.withColumn("_place", F.xxhash64("key", "at"))
    twice = places.withColumn("_other", F.min("_place").over(same) < F.max("_place").over(same)).where("n = 1 and _other")
    hot = twice.select("key", F.col("at").alias("low"), (F.col("at") + LENGTH).alias("high"))
    return merged.unionByName(hot)


def _packed(low: np.ndarray, high: np.ndarray) -> bytes:
    return np.stack([low, high], axis=1).astype("<i4").tobytes()


def union(spans: np.ndarray) -> np.ndarray:
    """Maximal runs of bytes covered by the spans (rows of from, to)."""
    if not len(spans):
        return spans.reshape(0, 2)
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    reach = np.maximum.accumulate(spans[:, 1])
    first = np.append(True, spans[1:, 0] > reach[:-1])
    last = np.append(first[1:], True)
    return np.stack([spans[first, 0], reach[last]], axis=1)


def cut(text: bytes, spans: np.ndarray) -> bytes:
    """The bytes outside the spans."""
    edges = [0, *spans.reshape(-1).tolist(), len(text)]
    return b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))


_STAGE = [("kind", pa.int32()), ("key", pa.binary()), ("anchor", pa.int64()), ("low", pa.int32()), ("off", pa.int32()), ("n", pa.int64()), ("body", pa.binary()), ("spans", pa.binary())]
_STAGE_SCHEMA = "kind int, key binary, anchor long, low int, off int, n long, body binary, spans binary"
_CONTEXT, _OPEN, _DONE = 0, 1, 2


def _gathered(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A text with its repeated anchors: contexts to compare, and what is known of the text's spans by now."""
    previous = None
    for part in small(parts, 200):
        out: list[tuple] = []
        lists = part["found"]
        edges = lists.offsets.to_numpy()
        fields = [x.to_numpy(zero_copy_only=False) for x in lists.flatten().flatten()]  # of this slice alone
        edges = edges - edges[0]
        for row, (key, text) in enumerate(zip(part["key"].to_pylist(), part["text"].to_pylist(), strict=True)):
            if key == previous:
                continue  # a copy
            previous = key
            at, anchor, n, send = (x[edges[row] : edges[row + 1]] for x in fields)
            low, high = context(at, len(text))
            for i in np.flatnonzero(send):
                out.append((_CONTEXT, key, int(anchor[i]), int(low[i]), int(at[i] - low[i]), int(n[i]), text[low[i] : high[i]], None))
            known = n > 1
            spans = union(np.stack([low[known], high[known]], axis=1))
            whole = len(spans) == 1 and spans[0, 0] == 0 and spans[0, 1] == len(text)
            if known.all() or whole:
                out.append((_DONE, key, None, None, None, None, None, _result(text, spans)))
            else:
                out.append((_OPEN, key, None, None, None, None, text, _packed(spans[:, 0], spans[:, 1])))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*out, strict=True), _STAGE, strict=True)], names=[n for n, _ in _STAGE])


def _result(text: bytes, spans: np.ndarray) -> bytes:
    """The hash of what stays, followed by the spans."""
    return hashlib.sha256(cut(text, spans)).digest() + _packed(spans[:, 0], spans[:, 1])


def _closed(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Open texts (sorted by key, each before the spans found for it) get their result."""
    for table in whole_keys(parts, ["key"], 1000):
        at = starts(table, ["key"])
        keys, bodies, spans = (table[c].to_pylist() for c in ("key", "body", "spans"))
        out = []
        for a, b in zip(at, [*at[1:], table.num_rows], strict=True):
            if bodies[a] is not None:
                all_spans = np.frombuffer(b"".join(x for x in spans[a:b] if x), "<i4").reshape(-1, 2)
                out.append((keys[a], _result(bodies[a], union(all_spans))))
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in out], pa.binary()), pa.array([r for _, r in out], pa.binary())], names=["key", "result"])


def repeats(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """See `_repeats`; all its jobs run here, with texts passed to Python a thousand at a time."""
    bound_batches(docs.sparkSession)
    with batches_of(docs.sparkSession, 1000):
        return _repeats(docs, text_col)


def _repeats(docs: DataFrame, text_col: str) -> DataFrame:
    """(key, result) for every text with a repeated string: the MD5 of the text, and in one binary value the SHA-256 of what stays,
    followed by the maximal removed runs as pairs of 32-bit integers.

    Only strings around anchors that occur twice can repeat. A context that occurs twice as a whole is removed as a whole; contexts that
    share an anchor but differ are compared byte by byte through the merged transforms.
    """
    text = F.col(f"`{text_col}`").cast("binary")
    rows = docs.where(F.octet_length(text) >= LENGTH).select(text.alias("text"), F.unhex(F.md5(text)).alias("key"))
    repeated = repeated_anchors(rows.select("text"))
    bitmap = docs.sparkSession.sparkContext.broadcast(_filter(repeated))

    def candidates(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = bitmap.value
        for part in small(parts):
            texts, keys = columns(part)
            out = []
            for text, key in zip(texts, keys, strict=True):
                at, anchor, around = anchors(np.frombuffer(text, np.uint8))
                bit = (anchor & np.uint64(FILTER_BITS - 1)).astype(np.int64)
                some = np.flatnonzero(bits[bit >> 3] >> (bit & 7).astype(np.uint8) & 1)
                if len(some):
                    out.append((key, at[some], anchor[some], around[some]))
            if out:
                keys = pa.array([x[0] for x in out], pa.binary()).take(pa.array(np.repeat(np.arange(len(out)), [len(x[1]) for x in out])))
                at, anchor, around = (np.concatenate([x[i] for x in out]) for i in (1, 2, 3))
                yield pa.RecordBatch.from_arrays([keys, pa.array(at, pa.int32()), _signed(anchor), _signed(around)], names=["key", "at", "anchor", "around"])

    found = rows.mapInArrow(lean(candidates), "key binary, at int, anchor long, around long").join(repeated, ["anchor", "around"])
    found = settle(found.dropDuplicates(["key", "at"]), "found")
    # Of a context that occurs more than once, one place is sent to meet those that share its anchor.
    place = F.struct("key", "at")
    sent = found.where("n > 1 and others").groupBy("anchor", "around").agg(F.min(place).alias("_p")).select("_p.key", "_p.at", F.lit(True).alias("_sent"))
    marked = found.join(sent, ["key", "at"], "left").withColumn("send", (F.col("n") == 1) | F.coalesce("_sent", F.lit(False)))
    listed = marked.groupBy("key").agg(F.collect_list(F.struct("at", "anchor", "n", "send")).alias("found"))
    stage = rows.join(listed, "key").select("key", "text", "found").mapInArrow(lean(_gathered), _STAGE_SCHEMA)
    stage = settle(stage, "stage")
    contexts = stage.where(F.col("kind") == _CONTEXT).select("anchor", "key", "low", "off", "n", "body")
    spans = _shared_spans(contexts)

    def pack(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            pairs = np.stack([part["low"].to_numpy(), part["high"].to_numpy()], axis=1).astype("<i4")
            yield pa.RecordBatch.from_arrays([part["key"], pa.array([p.tobytes() for p in pairs], pa.binary())], names=["key", "spans"])

    opened = stage.where(F.col("kind") == _OPEN).select("key", "body", "spans")
    both = opened.unionByName(spans.mapInArrow(lean(pack), "key binary, spans binary"), allowMissingColumns=True)
    both = both.repartition("key").sortWithinPartitions("key", F.col("body").isNull())
    closed = both.mapInArrow(lean(_closed), "key binary, result binary")
    done = stage.where(F.col("kind") == _DONE).select("key", F.col("spans").alias("result"))
    return settle(closed.unionByName(done).dropDuplicates(["key"]), "repeats")


def removed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans): every byte goes that a string of 200 bytes covers which starts
    anywhere else too, in the same text or another.

    Strings are judged on the input and never cross documents; spans are the maximal removed runs (from, to). A null text is an empty one.
    Texts below 200 bytes keep all. Copies lose every byte. Rows with equal or null ids are documents of their own. Very long
    and periodic texts take time in proportion to their length. An empty table gives an empty result. Other columns are
    ignored.
    """
    text = F.coalesce(F.col(f"`{text_col}`").cast("binary"), F.lit(b""))
    rows = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"),
        F.octet_length(text).cast("long").alias("n_bytes"),
        F.unhex(F.md5(text)).alias("key"),
        F.sha2(text, 256).alias("_whole"),
    )
    found = repeats(docs, text_col).select(
        F.col("key").alias("_key"), F.lower(F.hex(F.substring("result", 1, 32))).alias("_kept"), F.expr("substring(result, 33)").alias("_spans")
    )
    count = F.coalesce(F.octet_length("_spans") / 8, F.lit(0)).cast("long")

    joined = rows.join(found, F.col("key") == F.col("_key"), "left").select(
        "doc_id", "n_bytes", count.alias("n_spans"), F.coalesce("_kept", "_whole").alias("kept_sha256"), F.col("_spans").alias("spans")
    )

    def measure(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            lists = [np.frombuffer(x or b"", "<i4").reshape(-1, 2) for x in part["spans"].to_pylist()]
            gone = pa.array([int((x[:, 1] - x[:, 0]).sum()) for x in lists], pa.int64())
            spans = pa.array([[{"from": a, "to": b} for a, b in x.tolist()] for x in lists], _SPANS)
            yield pa.RecordBatch.from_arrays(
                [part["doc_id"], part["n_bytes"], gone, part["n_spans"], part["kept_sha256"], spans],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"],
            )

    kind = joined.dtypes[0][1]
    return joined.mapInArrow(
        lean(measure),
        f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<from:int,to:int>>",
    )


_SPANS = pa.list_(pa.struct([("from", pa.int32()), ("to", pa.int32())]))


def without_repeats(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents, all columns as they are, with the repeated strings cut out of their texts.

    A character that loses some of its bytes goes as a whole. A text of which nothing is left is an empty text; null stays null.
    """
    key = F.unhex(F.md5(F.col("_row")[text_col].cast("binary")))
    own = docs.select(F.struct("*").alias("_row")).withColumn("_key", key)
    found = repeats(docs, text_col).select("key", F.expr("substring(result, 33)").alias("_spans"))
    joined = own.join(found, F.col("_key") == F.col("key"), "left").select("_row", "_spans")
    names = docs.columns
    place = names.index(text_col)
    flat = joined.select(*[F.col("_row")[c].alias(c) for c in docs.columns], F.col("_spans").alias("_cut_spans"))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in small(parts):
            texts = part.column(place).cast(pa.large_binary()).to_pylist()
            spans = part.column(part.num_columns - 1).to_pylist()
            kept = [
                t.decode() if t is not None and not s else t if t is None else cut(t, np.frombuffer(s, "<i4").reshape(-1, 2)).decode(errors="ignore")
                for t, s in zip(texts, spans, strict=True)
            ]
            arrays = [pa.array(kept, pa.string()) if i == place else part.column(i) for i in range(part.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return flat.mapInArrow(lean(run), docs.schema)
