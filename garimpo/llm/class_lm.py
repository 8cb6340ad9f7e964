"""A class-based bigram model: exchange clustering of all words, class transitions and word emissions."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from typing import NamedTuple
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from garimpo.llm.common import LOWER, bound_batches, columns, dropped_shuffles, lean, map_batches, packed, small, starts, whole_keys
from garimpo.llm.sharding import size_class
from garimpo.session import settle

#: Words that the driver exchanges, most frequent first; they and the signatures are its units. All other words are exchanged by the tasks.
OWN = 1 << 16
#: Signatures of all other words: the hash of a word's last three bytes. Such a word starts in the class of its signature; one that was
#: not met in training stays there.
SIGNS = 1 << 12
TAIL = 3
#: The most frequent units, which are exchanged one by one first, and how often; after that all units are exchanged in batches.
FIRST, FIRST_SWEEPS = 1 << 10, 4
BATCHES = 3
#: The number of classes is the fourth root of the number of words, within these bounds.
FEWEST, MOST = 8, 64
#: Units whose gains are worked out at once.
AT_ONCE = 256
#: Added to every count of a class transition.
ADDED = 0.05
#: The token that ends a text; no word is empty.
END = b""
#: Distinct words that a task counts, or tokens of other words whose neighbours it notes, before it hands them on. The bound is on memory
#: and changes no sum.
HELD = 400_000
#: Other words whose gains are worked out at once, each from the classes beside its own few tokens.
OTHERS = 4096
#: Marks the class of another word's token in a byte, beside the classes (`MOST` at most), and the code of a token followed by itself.
OTHER = 0x80
DOUBLED = MOST * MOST
#: Entries of a summed vector that travel in one row, and tasks among which those of one block are dealt before they meet.
BLOCK = 1 << 16
SALTS = 16


def in_training(id_col: Column, folds: int = 7, fold: int = 2) -> Column:
    """Whether a row is learned from: not in the held-out fold of the CRC-32 of its id as text. A null id counts as empty text."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % folds != fold


def split(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(LOWER).split()


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame as a table of the shared folder; what was shuffled for it is dropped at once."""
    with dropped_shuffles(df.sparkSession):
        return settle(df, name)


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, c) over the rows of `texts` (one column), with the end token. Each task counts before the shuffle."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()

        def told() -> pa.RecordBatch:
            words, n = pa.array(counts.keys(), pa.binary()), pa.array(counts.values(), pa.int64())
            counts.clear()
            return pa.RecordBatch.from_arrays([words, n], names=["word", "n"])

        for part in small(parts):
            (rows,) = columns(part)
            counts[END] += len(rows)
            for text in rows:
                counts.update(split(text))
                if len(counts) > HELD:
                    yield told()
        yield told()

    bound_batches(texts.sparkSession)
    return texts.mapInArrow(lean(run), "word binary, n long").groupBy("word").agg(F.sum("n").alias("c"))


class Units(dict):
    """Word to unit: its own, or that of its signature."""

    def __init__(self, words: list[bytes]) -> None:
        super().__init__(zip(words, range(len(words)), strict=True))
        self.own = len(words)

    def __missing__(self, word: bytes) -> int:
        return self.own + crc32(word[-TAIL:]) % SIGNS

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int32, len(words))


class Vocabulary(NamedTuple):
    words: list[bytes]  # with a unit of their own, the end token first
    counts: np.ndarray  # of each of them in training
    rest: np.ndarray  # per signature: tokens of other words in training
    distinct: np.ndarray  # per signature: distinct other words in training
    tokens: int
    types: int


def vocabulary(counts: DataFrame) -> Vocabulary | None:
    """The units that all words of `counts` fall into; None if there is none. What the driver holds has a fixed size."""
    totals = counts.agg(F.sum("c"), F.count(F.lit(1))).first()
    if not totals[0]:
        return None
    order = [(F.col("word") == F.lit(END)).desc(), F.col("c").desc(), F.col("word")]
    # Counts by size class (a bounded number) tell below which class no word can be among the first; only the rest is sorted.
    level, above = 0, 0
    kinds = counts.groupBy(size_class(F.col("c")).alias("k")).agg(F.count(F.lit(1)).alias("n")).collect()
    for kind in sorted(kinds, key=lambda r: -r["k"]):
        level, above = kind["k"], above + kind["n"]
        if above > OWN:
            break
    likely = counts.where((size_class(F.col("c")) >= level) | (F.col("word") == F.lit(END)))
    own = likely.orderBy(*order).limit(OWN).toArrow().to_pydict()
    words, n = own["word"], np.array(own["c"], np.int64)
    low, last = int(n[-1]), words[-1]
    ours = (F.col("word") == F.lit(END)) | (F.col("c") > low) | ((F.col("c") == low) & (F.col("word") <= F.lit(last)))
    sign = (F.crc32(F.substring("word", -TAIL, TAIL)) % SIGNS).cast("int")
    rest, distinct = np.zeros(SIGNS, np.int64), np.zeros(SIGNS, np.int64)
    for row in counts.where(~ours).groupBy(sign.alias("s")).agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).collect():
        rest[row["s"]], distinct[row["s"]] = row["n"], row["v"]
    return Vocabulary(words, n, rest, distinct, int(totals[0]), int(totals[1]))


def encoded(docs: DataFrame, words: list[bytes]) -> DataFrame:
    """The texts (column text) as tokens, beside the other columns of `docs`.

    tokens: the units as 32-bit integers, closed by the end token. others: the distinct words without a unit of their own, with how often
    each occurs (times) and, for each of their tokens, which of them it is (slots). Written once; every later count reads these numbers and no text.
    """
    kept = [c for c in docs.columns if c != "text"]
    sent = docs.sparkSession.sparkContext.broadcast(words)  # at most OWN words

    def run(known: Units, *rows: list) -> Iterator[dict]:
        out: dict[str, list] = dict(zip(kept, rows[:-1], strict=True)) | {c: [] for c in ("tokens", "slots", "others", "times")}
        for text in rows[-1]:
            told = split(text)
            units = known.of([*told, END])
            seen: dict[bytes, int] = {}
            slots = [seen.setdefault(told[i], len(seen)) for i in np.flatnonzero(units >= known.own).tolist()]
            out["tokens"].append(units.astype("<i4").tobytes())
            out["slots"].append(np.array(slots, "<i4").tobytes())
            out["others"].append(list(seen))
            out["times"].append(np.bincount(slots, minlength=len(seen)).tolist() if slots else [])
        yield out

    schema = ", ".join([f"`{c}` {t}" for c, t in docs.dtypes if c != "text"] + ["tokens binary, slots binary, others array<binary>, times array<int>"])
    return written(map_batches(docs.select(*kept, "text"), run, schema, lambda: Units(sent.value)), "tokens")


def summed(tokens: DataFrame, size: int, add: Callable[[np.ndarray, np.ndarray, np.ndarray], None], kind: str = "<i4", first: int = 0) -> np.ndarray:
    """The sum over all texts of a vector of fixed `size`.

    `add(vector, previous, current)` adds what texts have: the number of each token and of the one before it, where a
    text is preceded and followed by the end token, which is number `first`. Tasks hand on the entries that are not zero, in blocks that are added
    up by block; the driver gets one vector of fixed size.
    """

    def sparse(block: int, vector: np.ndarray) -> pa.RecordBatch:
        filled = np.flatnonzero(vector)
        n = vector[filled]
        least = np.min_scalar_type(int(n.max())).newbyteorder("<")  # as few bytes as the largest count takes
        row = [[filled.astype("<u2").tobytes()], [n.astype(least).tobytes()]]
        return pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), *(pa.array(x, pa.binary()) for x in row)], names=["block", "at", "n"])

    def whole(at: bytes, n: bytes) -> tuple[np.ndarray, np.ndarray]:
        places = np.frombuffer(at, "<u2")
        return places, np.frombuffer(n, f"<u{len(n) // len(places)}").astype(np.int64)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vector = np.zeros(size, np.int64)
        for part in parts:
            now = np.frombuffer(b"".join(part.column(0).to_pylist()), kind)
            add(vector, np.concatenate([np.array([first], now.dtype), now[:-1]])[: len(now)], now)
        for at in range(0, size, BLOCK):
            if vector[at : at + BLOCK].any():
                yield sparse(at // BLOCK, vector[at : at + BLOCK])

    def total(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for part in parts:
            for block, at, n in zip(*columns(part), strict=True):
                places, n = whole(at, n)
                sums.setdefault(block, np.zeros(BLOCK, np.int64))[places] += n
        for block, vector in sums.items():
            yield sparse(block, vector)

    schema = "block int, at binary, n binary"
    salt = F.pmod(F.spark_partition_id(), F.lit(SALTS)).alias("salt")
    dealt = tokens.mapInArrow(lean(run), schema).select("*", salt).repartition("block", "salt").drop("salt").mapInArrow(lean(total), schema)
    if size > BLOCK:  # the sums of a single block are few enough to be added up here
        dealt = dealt.repartition("block").mapInArrow(lean(total), schema)
    out = np.zeros(-(-size // BLOCK) * BLOCK, np.int64)
    with dropped_shuffles(tokens.sparkSession):
        rows = dealt.collect()  # one job; an iterator takes a job for each partition
    for row in rows:
        places, n = whole(row["at"], row["n"])
        out[row["block"] * BLOCK + places.astype(np.int64)] += n
    return out[:size]


def _entropy(n: np.ndarray) -> np.ndarray:
    return n * np.log(np.maximum(n, 1))


def exchange(pairs: np.ndarray, classes: int, sweeps: int) -> np.ndarray:
    """The class of each word from the matrix of bigram counts.

    Starts with the most frequent words in classes of their own and all others in the last; then takes every word out of its
    class and puts it where the likelihood of the class bigrams gains most, until nothing moves or `sweeps` are over.
    """
    n = len(pairs)
    classes = min(classes, n)
    pairs = pairs.astype(np.float64)
    of = np.minimum(np.arange(n), classes - 1)
    member = np.eye(classes)[of]
    right, left = pairs @ member, pairs.T @ member  # of a word with the classes after and before it
    table = member.T @ pairs @ member
    for _ in range(sweeps):
        moved = 0
        for w in range(n):
            g, own = of[w], pairs[w, w]
            r, b = right[w].copy(), left[w].copy()
            r[g] -= own
            b[g] -= own
            after, ahead = r.sum() + own, b.sum() + own
            table[g] -= r
            table[:, g] -= b
            table[g, g] -= own
            base = _entropy(table)
            rows, cols = _entropy(table + r) - base, _entropy(table + b[:, None]) - base
            gain = rows.sum(1) - rows.diagonal() + cols.sum(0) - cols.diagonal()
            both = table.diagonal() + r + b + own
            first, second = table.sum(1) + b, table.sum(0) + r  # with the tokens of w beside them
            gain += _entropy(both) - base.diagonal()
            gain -= _entropy(first + after) - _entropy(first) + _entropy(second + ahead) - _entropy(second)
            k = int(gain.argmax()) if gain.max() > gain[g] + 1e-9 else g
            table[k] += r
            table[:, k] += b
            table[k, k] += own
            if k != g:
                moved += 1
                of[w] = k
                right[:, g] -= pairs[:, w]
                right[:, k] += pairs[:, w]
                left[:, g] -= pairs[w]
                left[:, k] += pairs[w]
        if not moved:
            break
    return of


def likelihood(table: np.ndarray) -> float:
    """What the classes of a table of class bigrams add to the log likelihood of the text."""
    return float(_entropy(table).sum() - _entropy(table.sum(1)).sum() - _entropy(table.sum(0)).sum())


def best_moves(table: np.ndarray, of: np.ndarray, after: np.ndarray, ahead: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For units of classes `of`: the class that each would gain most in if it alone moved, and what it gains over staying.

    `after` and `ahead` count the classes of the tokens behind and before a unit's, `own` its pairs with itself.
    """
    to, gained = np.empty(len(of), np.int64), np.empty(len(of))
    for at in range(0, len(of), AT_ONCE):
        g, s = of[at : at + AT_ONCE], own[at : at + AT_ONCE].astype(np.float64)
        r, b = after[at : at + AT_ONCE].astype(np.float64), ahead[at : at + AT_ONCE].astype(np.float64)
        i = np.arange(len(g))
        r[i, g] -= s
        b[i, g] -= s
        rest = np.repeat(table[None].astype(np.float64), len(g), 0)  # the class bigrams without the unit
        rest[i, g] -= r
        rest[i, :, g] -= b
        rest[i, g, g] -= s
        base = _entropy(rest)
        rows, cols = _entropy(rest + r[:, None, :]) - base, _entropy(rest + b[:, :, None]) - base
        diagonal = np.arange(len(table))
        gain = rows.sum(2) - rows[:, diagonal, diagonal] + cols.sum(1) - cols[:, diagonal, diagonal]
        both = rest[:, diagonal, diagonal] + r + b + s[:, None]
        first, second = rest.sum(2) + b, rest.sum(1) + r
        gain += _entropy(both) - base[:, diagonal, diagonal]
        gain -= _entropy(first + (r.sum(1) + s)[:, None]) - _entropy(first)
        gain -= _entropy(second + (b.sum(1) + s)[:, None]) - _entropy(second)
        best = gain.argmax(1)
        to[at : at + AT_ONCE], gained[at : at + AT_ONCE] = best, gain[i, best] - gain[i, g]
    return to, gained


def bigrams(of: np.ndarray, after: np.ndarray) -> np.ndarray:
    """The table of class bigrams, from the classes of all units and of the tokens behind them."""
    table = np.zeros((after.shape[1], after.shape[1]))
    np.add.at(table, of, after)
    return table


def placed(first: np.ndarray, classes: int, after: np.ndarray, ahead: np.ndarray) -> np.ndarray:
    """The classes of all units to start from: those of the units exchanged one by one, and for each other one the class that fits
    the exchanged units beside it best; a unit beside none of them goes to the last class."""
    size = len(first)
    table = np.zeros((classes, classes)) + 0.5
    np.add.at(table, first, after[:size, :classes])
    forward, backward = np.log(table / table.sum(1, keepdims=True)), np.log(table / table.sum(0))
    behind, before = after[size:, :classes], ahead[size:, :classes]
    best = (behind @ forward.T + before @ backward).argmax(1)
    known = behind.any(1) | before.any(1)
    return np.concatenate([first, np.where(known, best, classes - 1)]).astype(np.int64)


def exchange_all(of: np.ndarray, classes: int, contexts: Callable, batches: int) -> tuple[np.ndarray, np.ndarray]:
    """Exchange all units, in batches; gives their classes and the table of class bigrams.

    Every unit's contexts are counted under the classes as they are, and of the units that would gain by moving alone one half moves
    at once, the other half in the next batch. `contexts(of, classes)` gives `after`, `ahead` and `own` as for `best_moves`,
    of all units. Units that move together can lose what each alone would gain; the classes kept are those of the highest
    likelihood met, so it never falls.
    """
    best, counts, highest = of, np.zeros((classes, classes)), -np.inf
    half = np.arange(len(of)) % 2
    still = 0
    for batch in range(batches + 1):
        after, ahead, own = contexts(of, classes)
        table = bigrams(of, after)
        now = likelihood(table)
        if now > highest:
            best, counts, highest = of, table, now
        elif batch:
            break
        if batch == batches:
            break
        to, gained = best_moves(table, of, after, ahead, own)
        moving = (gained > 1e-9) & (half == batch % 2)
        still = 0 if moving.any() else still + 1
        if still == 2:  # neither half has anything to gain
            break
        of = np.where(moving, to, of)
    return best, counts


class Model(NamedTuple):
    words: list[bytes]  # with a unit of their own, the end token first
    counts: np.ndarray  # of each of them in training
    rest: np.ndarray  # per signature: tokens of other words in training
    distinct: np.ndarray  # per signature: distinct other words in training
    of: np.ndarray  # class of each unit
    step: np.ndarray  # log10 of class after class
    emit: np.ndarray  # log10 of unit under its class
    tokens: int
    types: int
    table: np.ndarray  # counts of class after class


def fit(texts: DataFrame, counts: DataFrame) -> Model | None:
    """Learn the classes of all units from the training `texts` and their word `counts`."""
    known = vocabulary(counts)
    return known and learn(encoded(texts, known.words).select("tokens"), known)


def learn(tokens: DataFrame, known: Vocabulary) -> Model:
    """Learn the classes of all units from the `tokens` of the training texts, every statistic over all of them.

    The most frequent words (`OWN`) have units of their own, all others share the unit of their signature. The exchange
    algorithm takes the `FIRST` most frequent units one by one by the bigrams among them; then all units are
    exchanged in batches by all bigrams of the text. What the driver holds has a fixed size. `exchange_others` goes on from here,
    word by word.
    """
    words, n, rest, distinct = known[:4]
    size, total = min(FIRST, len(words)), len(words) + SIGNS
    classes = int(min(MOST, max(FEWEST, round(known.types ** 0.25))))

    def add_pairs(vector: np.ndarray, before: np.ndarray, now: np.ndarray) -> None:
        both = (before < size) & (now < size)
        np.add.at(vector, before[both].astype(np.int64) * size + now[both], 1)

    pairs = summed(tokens, size * size, add_pairs).reshape(size, size)

    def contexts(of: np.ndarray, classes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        width = 2 * classes + 1

        def add_sides(vector: np.ndarray, before: np.ndarray, now: np.ndarray) -> None:
            for unit, at in ((before.astype(np.int64) * width + of[now], 0), (now.astype(np.int64) * width + of[before], classes)):
                np.add.at(vector, unit + at, 1)
            np.add.at(vector, now[before == now].astype(np.int64) * width + 2 * classes, 1)

        counted = summed(tokens, total * width, add_sides).reshape(total, width)
        return counted[:, :classes], counted[:, classes : 2 * classes], counted[:, -1]

    first = exchange(pairs, classes, FIRST_SWEEPS)
    # All other units wait in a class of their own, so their contexts tell the exchanged ones apart.
    waiting = np.concatenate([first, np.full(total - size, classes)]).astype(np.int64)
    of = placed(first, classes, *contexts(waiting, classes + 1)[:2])
    of, table = exchange_all(of, classes, contexts, BATCHES)
    filled, of = np.unique(of, return_inverse=True)  # a class may have been emptied
    number = len(filled)
    table = table[np.ix_(filled, filled)]
    steps = table + ADDED
    unit = np.concatenate([n, rest]) + 1.0
    return Model(
        words,
        n,
        rest,
        distinct,
        of,
        np.log10(steps / steps.sum(1, keepdims=True)),
        np.log10(unit / np.bincount(of, unit, number)[of]),
        known.tokens,
        known.types,
        table,
    )


def best_classes(table: np.ndarray, of: np.ndarray, after: np.ndarray, ahead: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What `best_moves` gives, for words with few tokens: only the cells that a word's tokens touch are looked at."""
    n, i = len(of), np.arange(len(of))
    table, own = table.astype(np.float64), own.astype(np.float64)
    r, b = after.astype(np.float64), ahead.astype(np.float64)
    r[i, of] -= own
    b[i, of] -= own
    held, diagonal = _entropy(table), np.diag(table)
    gain, stay = np.zeros((n, len(table))), np.zeros(n)
    for side, other, cells, before in ((r, b, table, held), (b, r, table.T, held.T)):
        at, k = np.nonzero(side)
        count = side[at, k]
        # Row k grows by the word's counts; its own class is still in the cells, and so is the diagonal, which is counted on its own below.
        gain += (side == 1) @ (_entropy(cells + 1) - before).T
        more = np.flatnonzero(count > 1)
        if len(more):
            kinds, which = np.unique(k[more] + len(table) * count[more].astype(np.int64), return_inverse=True)
            column, times = kinds % len(table), kinds // len(table)
            first = np.flatnonzero(np.diff(at[more], prepend=-1))
            gain[at[more[first]]] += np.add.reduceat((_entropy(cells[:, column] + times) - before[:, column]).T[which], first)
        gain[at, k] -= _entropy(diagonal[k] + count) - before[k, k]
        mine = k == of[at]
        # The class it is in: what its cells lose without it.
        cell = cells[of[at], k]
        stay += np.bincount(at, np.where(mine, 0, _entropy(cell) - _entropy(cell - count)), n)
        at, count = at[mine], count[mine][:, None]
        seen, less = cells[:, of[at]].T, other[at]
        gain[at] += _entropy(seen - less + count) - _entropy(seen - less) - _entropy(seen + count) + _entropy(seen)
        total, told = cells.sum(1), side.sum(1) + own
        some, which = np.unique(told, return_inverse=True)
        gain -= (_entropy(total + some[:, None]) - _entropy(total))[which]
        stay -= _entropy(total[of]) - _entropy(total[of] - told)
    both = r + b + own[:, None]
    at, k = np.nonzero(both)
    gain[at, k] += _entropy(diagonal[k] + both[at, k]) - _entropy(diagonal[k])
    gain[i, of] = stay + _entropy(diagonal[of]) - _entropy(diagonal[of] - both[i, of])
    best = gain.argmax(1)
    return best, gain[i, best] - gain[i, of]


def exchange_others(texts: DataFrame, model: Model) -> DataFrame:
    """(word, c, class) of every word of the training `texts` (of `encoded`) that has no unit of its own.

    As in `exchange_all`, a word's contexts are counted under the classes as they are, where another word's class is that of its signature, and
    the word goes where the likelihood gains most if it alone moved. A word's tokens meet in one task, few as they are; all words
    move at once.
    """
    own, classes = len(model.words), len(model.table)
    sent = texts.sparkSession.sparkContext.broadcast((model.of, model.table))

    def beside(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = sent.value[0]
        words: list[pa.Array] = []
        which: list[np.ndarray] = []
        codes: list[np.ndarray] = []
        before = held = 0

        def told() -> pa.RecordBatch:
            nonlocal before, held
            kinds = pa.concat_arrays(words).dictionary_encode()
            ids = kinds.indices.to_numpy()[np.concatenate(which)]
            ends = np.concatenate([[0], np.bincount(ids, minlength=len(kinds.dictionary)).cumsum()]) * 2
            data = np.concatenate(codes)[np.argsort(ids, kind="stable")].astype("<u2")
            buffers = [None, pa.py_buffer(ends.astype(np.int32).tobytes()), pa.py_buffer(data.tobytes())]
            words.clear(), which.clear(), codes.clear()
            before = held = 0
            return pa.RecordBatch.from_arrays([kinds.dictionary, pa.Array.from_buffers(pa.binary(), len(kinds.dictionary), buffers)], names=["word", "codes"])

        for part in small(parts):
            now = np.frombuffer(b"".join(part["tokens"].to_pylist()), "<i4")
            slots, length = packed(part["slots"].to_pylist(), "<i4")
            if not len(slots):
                continue
            kinds = part["others"].value_lengths().to_numpy(zero_copy_only=False)
            slots = slots + np.repeat(kinds.cumsum() - kinds, length)  # among all words of these texts
            at = np.flatnonzero(now >= own)  # a text's last token is not one of them
            last = of[np.where(at > 0, now[at - 1], 0)]
            follows = np.append(at[1:] == at[:-1] + 1, False) & np.append(slots[1:] == slots[:-1], False)
            words.append(part["others"].flatten())
            which.append(slots + before)
            codes.append(last * MOST + of[now[at + 1]] + DOUBLED * follows)
            before, held = before + int(kinds.sum()), held + len(slots)
            if held > HELD:
                yield told()
        if held:
            yield told()

    def moved(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, table = sent.value
        for rows in whole_keys(parts, ["word"], OTHERS):
            at = starts(rows, ["word"])
            words = rows["word"].take(pa.array(at)).combine_chunks()
            codes, length = packed(rows["codes"].to_pylist(), "<u2")
            word = np.repeat(np.repeat(np.arange(len(at)), np.diff(np.append(at, rows.num_rows))), length)
            beside, size = codes % DOUBLED, len(at) * classes
            after = np.bincount(word * classes + beside % MOST, minlength=size).reshape(-1, classes)
            ahead = np.bincount(word * classes + beside // MOST, minlength=size).reshape(-1, classes)
            here = of[[own + crc32(w[-TAIL:]) % SIGNS for w in words.to_pylist()]]
            to, gained = best_classes(table, here, after, ahead, np.bincount(word, codes >= DOUBLED, len(at)))
            to = np.where(gained > 1e-9, to, here)
            yield pa.RecordBatch.from_arrays(
                [words, pa.array(np.bincount(word, minlength=len(at)), pa.int64()), pa.array(to, pa.int32())], names=["word", "c", "class"]
            )

    bound_batches(texts.sparkSession)
    contexts = texts.select("tokens", "slots", "others").mapInArrow(lean(beside), "word binary, codes binary")
    dealt = contexts.repartition("word").sortWithinPartitions("word")
    return written(dealt.mapInArrow(lean(moved), "word binary, c long, class int"), "classes")


def classed(texts: DataFrame, others: DataFrame, model: Model) -> DataFrame:
    """What `encoded` gives with the class of each token as a byte: under its unit (stayed) and as a word of its own (classes).

    Beside them n_tokens, n_known (words met in training) and known, the log10 of their counts plus one. The counts and classes of other
    words are as many as the corpus has words, so they meet the texts in a join; words so frequent that they would be hot there have a unit of their own.
    """
    own = len(model.words)
    sent = texts.sparkSession.sparkContext.broadcast((model.of, np.log10(model.counts + 1.0)))

    def under(rows: list, ids: list, held: list, tokens: list, slots: list) -> Iterator[dict]:
        of, known = sent.value
        out: dict[str, list] = {"row": rows, "doc_id": ids, "held_out": held, "n_tokens": [], "own": [], "base": [], "stayed": [], "slots": slots}
        for text in tokens:
            units = np.frombuffer(text, "<i4")
            mine = units < own
            out["n_tokens"].append(len(units))
            out["own"].append(int(mine.sum()))
            out["base"].append(float(known[units[mine]].sum()))
            out["stayed"].append((of[units] + OTHER * ~mine).astype(np.uint8).tobytes())
        yield out

    def filled(rows: list, ids: list, held: list, sizes: list, met: list, known: list, stayed: list, slots: list, moved: list) -> Iterator[dict]:
        out: dict[str, list] = {"doc_id": ids, "held_out": held, "n_tokens": sizes, "n_known": met, "known": known, "stayed": [], "classes": []}
        for marked, which, to in zip(stayed, slots, moved, strict=True):
            marked = np.frombuffer(marked, np.uint8)
            stays = marked & ~np.uint8(OTHER)
            now = stays.copy()
            if to:
                at, which = np.flatnonzero(marked & OTHER), np.frombuffer(which, "<i4")
                of = np.empty(which.max() + 1, np.uint8)
                of[which] = stays[at]
                to = np.array(to, np.int64)
                of[to // MOST] = to % MOST
                now[at] = of[which]
            out["stayed"].append(stays.tobytes())
            out["classes"].append(now.tobytes())
        yield out

    ids = f"doc_id {dict(texts.dtypes)['doc_id']}, held_out boolean, n_tokens long"
    sized = map_batches(texts.select("row", "doc_id", "held_out", "tokens", "slots"), under, f"row long, {ids}, own long, base double, stayed binary, slots binary")
    pairs = texts.select("row", F.posexplode(F.arrays_zip("others", "times")).alias("at", "w")).select("row", "at", "w.others", "w.times")
    found = pairs.join(others, pairs["others"] == others["word"]).groupBy("row").agg(
        F.sum(F.col("times") * F.log10(F.col("c") + 1.0)).alias("seen"),
        F.sum("times").alias("also"),
        F.collect_list(F.col("at").cast("long") * MOST + F.col("class")).alias("moved"),
    )
    both = sized.join(found, "row", "left").select(
        "row", "doc_id", "held_out", "n_tokens",
        (F.col("own") + F.coalesce("also", F.lit(0))).alias("n_known"), (F.col("base") + F.coalesce("seen", F.lit(0.0))).alias("known"),
        "stayed", "slots", "moved",
    )
    return written(map_batches(both, filled, f"{ids}, n_known long, known double, stayed binary, classes binary"), "classed")


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Score every whole text: (doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score), scores in log10.

    base_score is the add-one unigram; score is the class model: P(word | word before) = P(class | class before) times
    (c+1) / (tokens + distinct words + unseen words) of its class. Every word of the training texts has a class of its own choice, found by exchange; an
    unseen word has that of its signature, which stands for one unseen word, so all words, unseen ones included, share a probability of
    one. The model learns from the rows outside the held-out fold.

    The classes of words without a unit are exchanged at once, by gains that each would have alone; if that lowers the likelihood of the
    training texts, they stay in those of their signatures.

    A null or wordless text is an end token alone. Very long texts are scored to their end. Rows with equal or null ids are kept, each
    with its scores. With no training row at all the scores are those of an empty count: every word unseen, score equal
    to base_score. An empty table gives an empty result. Other columns are ignored.
    """
    doc_id, text = F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    training = docs.where(in_training(doc_id)).select(text.alias("text"))
    counts = written(word_counts(training), "words")
    known = vocabulary(counts)
    kept = docs.select(
        F.monotonically_increasing_id().alias("row"), doc_id.alias("doc_id"), (~in_training(doc_id)).alias("held_out"), text.alias("text")
    )
    if known is None:
        return _unlearned(kept)
    texts = encoded(kept, known.words)
    learned = texts.where("NOT held_out")
    model = learn(learned.select("tokens"), known)
    others = exchange_others(learned, model)
    rows = classed(texts, others, model)

    number = len(model.table)

    def add_steps(vector: np.ndarray, before: np.ndarray, now: np.ndarray) -> None:
        np.add.at(vector, before.astype(np.int64) * number + now, 1)

    end = int(model.of[0])
    table = summed(rows.where("NOT held_out").select("classes"), number * number, add_steps, "u1", end).reshape(number, number)
    own = len(model.words)
    mass = np.bincount(model.of, np.concatenate([model.counts + 1.0, np.ones(SIGNS)]), number)  # an unseen word per signature
    if likelihood(table) >= likelihood(model.table):
        column = "classes"
        for row in others.groupBy("class").agg(F.sum(F.col("c") + 1).alias("n")).collect():
            mass[row["class"]] += row["n"]
    else:
        column, table = "stayed", model.table
        mass += np.bincount(model.of[own:], model.rest + model.distinct, number)
    filled = mass > 0  # a class of other words alone may have been emptied
    steps = np.where(filled, table + ADDED, 0)
    value = np.log10(np.maximum(steps, ADDED) / steps.sum(1, keepdims=True)) - np.log10(np.maximum(mass, 1))
    sent = docs.sparkSession.sparkContext.broadcast(value)

    names = ["doc_id", "held_out", "n_tokens", "n_known", "known"]

    def run(*told: list) -> Iterator[dict]:
        out: dict[str, list] = dict(zip(names, told[:-1], strict=True)) | {"value": []}
        for text in told[-1]:
            now = np.frombuffer(text, np.uint8)
            out["value"].append(float(sent.value[np.append(np.uint8(end), now[:-1]), now].sum()))
        yield out

    floor = float(np.log10(model.tokens + 1.0 * (model.types + 1)))
    schema = ", ".join(f"{c} {dict(rows.dtypes)[c]}" for c in names) + ", value double"
    return map_batches(rows.select(*names, column), run, schema).select(
        "doc_id",
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        (F.col("known") - F.col("n_tokens") * F.lit(floor)).alias("base_score"),
        (F.col("known") + F.col("value")).alias("score"),
    )


def _unlearned(kept: DataFrame) -> DataFrame:
    tokens = (F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)) + 1).cast("long")
    zero = F.lit(0).cast("long")
    nothing = F.lit(0.0)
    return kept.select(
        "doc_id", "held_out", tokens.alias("n_tokens"), zero.alias("n_known"), zero.alias("train_tokens"),
        nothing.alias("base_score"), nothing.alias("score"),
    )
