"""Byte-level BPE encoding with a hierarchical-bitmap rank queue, and decoding."""

from __future__ import annotations

import base64
import hashlib
import uuid
from array import array
from collections.abc import Iterable, Iterator, Sequence
from itertools import chain

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from garimpo.llm.common import map_batches

#: Ranks in one word of the lower bitmap; the upper bitmap has a bit for each such word, so two find-first-sets give the
#: lowest rank that has a bucket.
SPAN, SHIFT = 256, 8
#: Bytes of the pre-tokens, and ids of them, that a worker keeps from task to task, besides those of one look-up; when half is full, the older half
#: goes. Longer pre-tokens than `KEPT_LENGTH` hardly ever come again and are not kept. The bounds are on memory and change no result.
KEPT_BYTES = 100 << 20
KEPT_LENGTH = 64
#: Pre-tokens of texts that are looked up together, and bytes of new ones among them that are merged together.
MET = 1 << 20
MERGED_BYTES = 1 << 21
#: Places of one rank from which on they are merged at once.
MANY = 64
#: Where a place starts no token any more.
GONE = -2
#: What an entry takes besides its pre-token and ids.
ENTRY_BYTES = 190


def load_ranks(spark, path: str) -> dict[bytes, int]:
    """The merge ranks of a vocabulary file of "base64 rank" lines. Its size is fixed, whatever the corpus."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    if sorted(ranks.values()) != list(range(len(ranks))) or len(ranks) > SPAN * len(_BIT):
        raise ValueError(f"ranks must be 0, 1, .. and at most {SPAN * len(_BIT)} of them")
    return ranks


_BIT = [1 << i for i in range(1024)]


class Pairs:
    """The ranks by the two tokens that a merge joins, for looking up many pairs at once; every byte must be a token."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        find = ranks.get
        single = [bytes([b]) for b in range(256)]
        self.single = np.array([ranks[b] for b in single], np.int32)
        self.first = np.array([find(a + b, -1) for a in single for b in single], np.int32)
        found = []
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                left, right = find(token[:i]), find(token[i:])
                if left is not None and right is not None:
                    found.append((left << 32 | right, rank))
        found.append((np.iinfo(np.int64).max, -1))
        keys, found = np.array(sorted(found), np.int64).T
        self.keys, self.found = keys.copy(), found.astype(np.int32)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, -1 if it has none."""
        keys = left.astype(np.int64) << 32 | right
        at = np.searchsorted(self.keys, keys)
        return np.where(self.keys[at] == keys, self.found[at], -1)


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of one pre-token: always the lowest rank in it is merged next, the leftmost such pair first."""
    return array("I", merge_all([piece], ranks)[0]).tolist()


def merge_all(pieces: Sequence[bytes], ranks: dict[bytes, int], pairs: Pairs | None = None) -> list[bytes]:
    """The ids, as little-endian unsigned 32-bit integers, of each of several pre-tokens, which share one linked list and one queue and never meet.

    A bucket for each rank that occurs holds places in the linked list of tokens. The queue over them is a bitmap of ranks in words of
    `SPAN` bits and one of the words that are not zero, so two find-first-sets give the lowest rank. What is lowest among all
    pre-tokens is lowest in its own, so each is merged as if alone, and with `pairs` a bucket of `MANY` places is merged at once. A place whose
    pair has changed since it was queued is stale and is skipped when its bucket is read; nothing is deleted from a bucket's middle.
    Work is in proportion to the length: a merge looks at two new pairs, and each queued place is read once at most: when no
    pair is left, what still waits is stale and is not read.
    """
    find = ranks.get
    whole = [find(piece) for piece in pieces]
    parted = [piece for piece, rank in zip(pieces, whole, strict=True) if rank is None]
    data = b"".join(parted)
    n = len(data)
    stops = np.cumsum([len(piece) for piece in parted], dtype=np.int64)
    last = stops[stops > 0] - 1
    # Token i starts at byte i and ends at after[i], where the next one starts; before[i] starts the one ahead.
    after, before = array("i", range(1, n + 2)), array("i", range(-1, n))
    # Whether a pre-token ends there, and so another one begins or none.
    edge = bytearray(n + 1)
    edge[0] = 1
    np.frombuffer(edge, np.uint8)[stops] = 1
    # Token that starts at i, and rank of the pair that starts there: -1 if there is none, GONE if i starts no token any more.
    codes = np.frombuffer(data, np.uint8)
    if pairs:
        tokens = pairs.single[codes]
        first = np.append(pairs.first[(codes[:-1].astype(np.int32) << 8) + codes[1:]], [-1] * (n > 0)).astype(np.int32)
    else:
        tokens = np.array([find(data[i : i + 1], -1) for i in range(n)], np.int32)
        first = np.array([find(data[i : i + 2], -1) for i in range(n)], np.int32)
    first[last] = -1
    token, pair = array("i", tokens.tobytes()), array("i", first.tobytes())
    order = np.argsort(first, kind="stable")[np.count_nonzero(first < 0) :]
    live = len(order)  # how many pairs have a rank
    starts = np.flatnonzero(np.diff(first[order], prepend=-1))
    buckets = {int(first[of[0]]): of.tolist() for of in np.split(order, starts[1:]) if len(of)}
    lower = [0] * (len(ranks) // SPAN + 2)
    upper = 0
    for rank in buckets:
        lower[rank >> SHIFT] |= _BIT[rank & SPAN - 1]
        upper |= _BIT[rank >> SHIFT]
    views = [np.frombuffer(x, np.int32) for x in (after, before, token, pair)] + [np.frombuffer(edge, np.bool_)]
    while live:
        word = (upper & -upper).bit_length() - 1
        bits = lower[word]
        rank = (word << SHIFT) + (bits & -bits).bit_length() - 1
        waiting = buckets.pop(rank)
        lower[word] = bits = bits & (bits - 1)
        if not bits:
            upper &= upper - 1
        if len(waiting) > 1:
            waiting.sort()
        if pairs and len(waiting) >= MANY:
            made = _merge_many(waiting, rank, pairs, *views)
            if made:
                live += made[0]
                for i, found in zip(*made[1:], strict=True):
                    if found in buckets:
                        buckets[found].append(i)
                    else:
                        buckets[found] = [i]
                        lower[found >> SHIFT] |= _BIT[found & SPAN - 1]
                        upper |= _BIT[found >> SHIFT]
                continue
        for i in waiting:
            if pair[i] != rank:
                continue  # stale
            j = after[i]
            end = after[j]
            live -= 1
            pair[i] = -1
            if pair[j] >= 0:
                live -= 1
            pair[j] = GONE
            token[i] = rank
            after[i] = end
            least = rank
            if not edge[end]:
                before[end] = i
                found = find(data[i : after[end]])
                if found is not None:
                    pair[i] = found
                    live += 1
                    if found < least:
                        least = found
                    if found in buckets:
                        buckets[found].append(i)
                    else:
                        buckets[found] = [i]
                        lower[found >> SHIFT] |= _BIT[found & SPAN - 1]
                        upper |= _BIT[found >> SHIFT]
            if not edge[i]:
                i = before[i]
                found = find(data[i:end])
                if found is None:
                    if pair[i] >= 0:
                        pair[i] = -1
                        live -= 1
                else:
                    if pair[i] < 0:
                        live += 1
                    pair[i] = found
                    if found < least:
                        least = found
                    if found in buckets:
                        buckets[found].append(i)
                    else:
                        buckets[found] = [i]
                        lower[found >> SHIFT] |= _BIT[found & SPAN - 1]
                        upper |= _BIT[found >> SHIFT]
            if least < rank and len(waiting) > 1:
                # A pair of a lower rank has come up and goes first; what is left of this bucket waits again.
                rest = [x for x in waiting if pair[x] == rank]
                if rest:
                    buckets[rank] = rest
                    lower[rank >> SHIFT] |= _BIT[rank & SPAN - 1]
                    upper |= _BIT[rank >> SHIFT]
                break
    standing = views[3] != GONE
    ids = views[2][standing]
    if n and ids.min() < 0:
        raise KeyError("a byte of the text is no token")
    ends = iter((4 * np.append(0, np.cumsum(standing))[stops]).tolist())
    out, at, ids = [], 0, ids.astype("<u4").tobytes()
    for rank in whole:
        if rank is None:
            stop = next(ends)
            out.append(ids[at:stop])
            at = stop
        else:
            out.append(array("I", [rank]).tobytes())
    return out


def _merge_many(waiting: list[int], rank: int, pairs: Pairs, after, before, token, pair, edge) -> tuple[int, list[int], list[int]] | None:
    """Merge the pairs of a bucket at once: how many more pairs there are now, and places and ranks of the new ones.

    None, and nothing is merged, where the order of the merges matters: two of the pairs share a token or a lower rank would come up.
    """
    i = np.array(waiting, np.int32)
    i = i[pair[i] == rank]
    if not len(i):
        return 0, [], []
    i = i[np.flatnonzero(np.diff(i, prepend=-1))]
    j = after[i]
    if (pair[j] == rank).any():
        return None
    end = after[j]
    more = ~edge[end]
    behind = end[more]
    right = np.full(len(i), -1, np.int32)
    right[more] = pairs.ranks(np.int32(rank), token[behind])
    if ((right >= 0) & (right < rank)).any():
        return None
    # A neighbour may be merged at the same time: the one behind starts a pair of this rank, the one ahead ends one.
    right[np.flatnonzero(more)[pair[behind] == rank]] = pairs.ranks(np.int32([rank]), np.int32([rank]))
    led = i[~edge[i]]
    ahead = before[led]
    inner = ~edge[ahead]
    joined = np.zeros(len(led), bool)
    joined[inner] = pair[before[ahead[inner]]] == rank
    ahead = ahead[~joined]
    left = pairs.ranks(token[ahead], np.int32(rank))
    if ((right >= 0) & (right < rank)).any() or ((left >= 0) & (left < rank)).any():
        return None
    # Of two merged neighbours the pair between them is told by the first, as its pair with what is behind.
    gone = len(i) + np.count_nonzero(pair[j] >= 0) + np.count_nonzero(pair[ahead] >= 0)
    pair[j] = GONE
    pair[i], pair[ahead], token[i], after[i] = right, left, rank, end
    before[behind] = i[more]
    places, ranks = np.concatenate([i[right >= 0], ahead[left >= 0]]), np.concatenate([right[right >= 0], left[left >= 0]])
    return len(places) - gone, places.tolist(), ranks.tolist()


class Encoder(dict):
    """Encodes texts; remembers the ids of pre-tokens it has met, within a bound that holds inside a text too.

    New pre-tokens of several texts are merged together, see `merge_all`. When half of the bound is full, what was met since the last time it was
    goes on as `older` and what was older is dropped; what is met again comes back from there.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.ranks, self.pattern = ranks, regex.compile(pattern)
        self.pairs = Pairs(ranks) if all(bytes([b]) in ranks for b in range(256)) else None
        self.held = 0
        self.older: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        return merge_all([piece.encode()], self.ranks, self.pairs)[0]

    def encode(self, texts: Iterable[str]) -> Iterator[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        waiting: list[list[str]] = []
        size = 0
        for text in texts:
            pieces = self.pattern.findall(text)
            if size + len(pieces) > MET:
                yield from self.looked_up(waiting)
                waiting, size = [], 0
            waiting.append(pieces)
            size += len(pieces)
        yield from self.looked_up(waiting)

    def looked_up(self, texts: list[list[str]]) -> Iterator[bytes]:
        """The ids of texts of at most `MET` pre-tokens together, or of one text of more."""
        if len(texts) == 1:
            parts = []
            for at in range(0, len(texts[0]), MET):
                self.learn(part := texts[0][at : at + MET])
                parts.append(b"".join(map(self.__getitem__, part)))
            yield b"".join(parts)
            return
        self.learn(chain.from_iterable(texts))
        for pieces in texts:
            yield b"".join(map(self.__getitem__, pieces))

    def learn(self, pieces: Iterable[str]) -> None:
        """Keep all of these pre-tokens that are not too long; those that are new are merged, as many at once as `MERGED_BYTES` hold."""
        if self.held > KEPT_BYTES // 2:
            self.older = dict(self)
            self.clear()
            self.held = 0
        new: list[str] = []
        size = 0
        for piece in set(pieces).difference(self):
            ids = self.older.get(piece)
            if ids is not None:
                self.keep(piece, ids)
            elif len(piece) <= KEPT_LENGTH:
                new.append(piece)
                size += len(piece)
                if size >= MERGED_BYTES:
                    self.merge_new(new)
                    new, size = [], 0
        self.merge_new(new)

    def merge_new(self, pieces: list[str]) -> None:
        for piece, ids in zip(pieces, merge_all([p.encode() for p in pieces], self.ranks, self.pairs), strict=True):
            self.keep(piece, ids)

    def keep(self, piece: str, ids: bytes) -> None:
        self.held += ENTRY_BYTES + 2 * len(piece) + len(ids)
        self[piece] = ids


def encode(
    docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False
) -> DataFrame:
    """Encode every whole text and decode the ids again.

    Returns (doc_id, n_tokens, ids_sha256, decoded_sha256) and, if asked for, ids (array of long) and decoded (binary):
    the hash of the ids as little-endian unsigned 32-bit integers and the hash of the decoded bytes, in lower-case hex.
    Texts are cut by `pattern`, each match is encoded on its own, and strings of special tokens are ordinary text.

    A null text is an empty one: no ids. Rows with equal or null ids are kept. Very long texts and pre-tokens take time in
    proportion to their length. An empty table gives an empty result. Other columns are ignored.
    """
    ranks = docs.sparkSession.sparkContext.broadcast(load_ranks(docs.sparkSession, ranks_path))

    def begin() -> tuple[Encoder, list[bytes]]:
        """What a worker keeps over its tasks of this call."""
        tokens = [b""] * (max(ranks.value.values()) + 1)
        for token, rank in ranks.value.items():
            tokens[rank] = token
        return Encoder(ranks.value, pattern), tokens

    def run(kept: tuple[Encoder, list[bytes]], ids: list, texts: list) -> Iterator[dict]:
        encoder, tokens = kept
        out: dict[str, list] = {c: [] for c in ("doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids", "decoded")}
        for doc_id, encoded in zip(ids, encoder.encode((text or b"").decode() for text in texts), strict=True):
            numbers = array("I", encoded)
            decoded = b"".join(map(tokens.__getitem__, numbers))
            out["doc_id"].append(doc_id)
            out["n_tokens"].append(len(numbers))
            out["ids_sha256"].append(hashlib.sha256(encoded).hexdigest())
            out["decoded_sha256"].append(hashlib.sha256(decoded).hexdigest())
            if with_ids:
                out["ids"].append(numbers.tolist())
                out["decoded"].append(decoded)
        yield out

    kept = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    schema = f"doc_id {kept.dtypes[0][1]}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return map_batches(kept, run, schema + (", ids array<long>, decoded binary" if with_ids else ""), begin, f"bpe-{uuid.uuid4().hex}")


def decode(ids: Iterable[int], ranks: dict[bytes, int]) -> bytes:
    """The bytes that ids stand for."""
    tokens = {rank: token for token, rank in ranks.items()}
    return b"".join(tokens[i] for i in ids)
