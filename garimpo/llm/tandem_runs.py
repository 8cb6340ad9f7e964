"""Periodic runs of words by the branching-tandem test over an enhanced suffix array."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from garimpo.llm.common import map_batches

#: A run is reported when it spans at least this many periods and words.
PERIODS, SHORTEST = 4, 6
#: Words whose suffix array is made at once: whole texts are put together up to this many; a longer text is on its own.
AT_ONCE = 200_000
#: Members of smaller children that are tested at once.
TESTED = 500_000


class SuffixArray(NamedTuple):
    order: np.ndarray  # starts of the suffixes, sorted
    place: np.ndarray  # the inverse; one more place, of no suffix, at the end
    shared: np.ndarray  # common prefix of a suffix and the one before it in the order


def suffix_array(symbols: np.ndarray) -> SuffixArray:
    """By prefix doubling in which only suffixes that still tie are sorted again.

    The ranks of every round are kept, as the common prefix of two neighbours is read off them from the longest step to the shortest.
    """
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    fresh = np.ones(n, bool)  # the suffix at this place of the order differs from the one before it
    fresh[1:] = symbols[order[1:]] != symbols[order[:-1]]
    split = np.where(fresh, 0, -1)  # the round that told them apart
    ranks = []
    tied = _tied(fresh, np.arange(n))
    start = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    rank = np.empty(n + 1, np.int32)
    rank[order] = start
    rank[n] = -1
    step = 1
    while len(tied):
        ranks.append(rank)
        suffix = order[tied]
        group = rank[suffix].astype(np.int64)
        key = group * (n + 1) + rank[np.minimum(suffix + step, n)] + 1
        moved = np.argsort(key, kind="stable")
        key, suffix = key[moved], suffix[moved]
        order[tied] = suffix
        new = np.ones(len(tied), bool)
        new[1:] = key[1:] != key[:-1]
        now = new & ~fresh[tied]
        split[tied[now]] = len(ranks)
        fresh[tied[now]] = True
        rank = rank.copy()
        rank[suffix] = np.maximum.accumulate(np.where(new, tied, 0))
        tied = tied[_tied(new, np.arange(len(tied)))]
        step *= 2
    shared = np.zeros(n, np.int64)
    place = np.full(n + 1, -1, np.int64)
    place[order] = np.arange(n)
    for level in range(1, len(ranks) + 1):
        # Told apart by round `level`: the first 2 ** (level - 1) symbols agree, what follows is shorter than that.
        at = np.flatnonzero(split == level)
        a, b = order[at - 1], order[at]
        length = np.full(len(at), 1 << (level - 1), np.int64)
        for j in range(level - 2, -1, -1):
            x, y = np.minimum(a + length, n), np.minimum(b + length, n)
            length += (ranks[j][x] == ranks[j][y]).astype(np.int64) << j
        shared[at] = length
    return SuffixArray(order, place, shared)


def _tied(fresh: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Places in groups of more than one."""
    single = fresh.copy()
    single[:-1] &= fresh[1:]
    return places[~single]


def _nearest(values: np.ndarray, at: np.ndarray, step: int, strict: bool) -> np.ndarray:
    """For each place in `at` the nearest one in direction `step` with a lower value, or with no higher one if not `strict`.

    Everything between a place and where its pointer stands is higher, so pointers jump over each other's spans. A few that
    are still on their way after many jumps go on by minima of spans of doubling length. `values` must end low on both sides.
    """
    far = np.arange(len(values)) + step
    far[0], far[-1] = 0, len(values) - 1
    high = (lambda a, b: a >= b) if strict else (lambda a, b: a > b)
    at = at[high(values[far[at]], values[at])]
    for _ in range(40):
        if not len(at):
            return far
        far[at] = far[far[at]]
        at = at[high(values[far[at]], values[at])]
    line = values[::step]
    lows = [line]  # lows[j][i]: the minimum over the 2 ** j places that start at i
    while 2 << (len(lows) - 1) <= len(line):
        half = 1 << (len(lows) - 1)
        lows.append(np.minimum(lows[-1][:-half], lows[-1][half:]))
    to = far[at] if step > 0 else len(values) - 1 - far[at]
    for j in range(len(lows) - 1, -1, -1):
        on = to + (1 << j) <= len(line)
        on[on] = high(lows[j][to[on]], values[at[on]])
        to[on] += 1 << j
    far[at] = to if step > 0 else len(values) - 1 - to
    return far


def squares(array: SuffixArray, limit: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(start, period) of every branching square: two copies side by side, after which the period breaks.

    An interval of suffixes with a common prefix of length `depth` has a square of that period at i if i and i + depth are both in
    it, and the square branches if they are in different children. A boundary between children parts its span in two; the members
    of the smaller part are looked up at i + depth and i - depth, and are partners if the other part holds them. So each
    suffix is tested as often as it is in a smaller part, at most log2(n) times, and no tree is built.
    `limit`: the longest period of interest by start of suffix.
    """
    order, place, shared = array
    n = len(order)
    values = np.concatenate([shared, [-1]])
    cuts = np.flatnonzero(shared > 0)
    left = _nearest(values, cuts, -1, strict=False)
    right = _nearest(values, cuts, 1, strict=True)
    cuts = cuts[shared[cuts] <= limit[order[cuts]]]
    low, high = left[cuts], right[cuts]
    small_left = cuts - low <= high - cuts
    first, last = np.where(small_left, low, cuts), np.where(small_left, cuts, high)
    other_first, other_last = np.where(small_left, cuts, low), np.where(small_left, high, cuts)
    sizes = np.cumsum(last - first)
    done = 0
    while done < len(cuts):
        upto = max(done + 1, int(np.searchsorted(sizes, (sizes[done - 1] if done else 0) + TESTED, "right")))
        some = slice(done, upto)
        many = last[some] - first[some]
        of = np.repeat(np.arange(done, upto), many)
        member = order[np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + first[of]]
        depth = shared[cuts[of]]
        for partner, start in ((member + depth, member), (member - depth, member - depth)):
            found = place[np.clip(partner, -1, n)]
            hit = (found >= other_first[of]) & (found < other_last[of])
            yield start[hit], depth[hit]
        done = upto


def find_runs(symbols: np.ndarray, limit: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, by start and period; `symbols` of different texts must differ.

    Every run ends with a branching square of its period. The square is rotated to the left while the word that enters
    equals the one that leaves; the rotations merge into the run. Squares of a multiple of the period that end at the
    same place lie in that run and are not rotated, so each run is walked through once.
    """
    if len(symbols) < SHORTEST:
        return []
    found = list(squares(suffix_array(symbols), limit))
    if not found:
        return []
    starts, periods = (np.concatenate(x) for x in zip(*found, strict=True))
    # What is long enough holds these copies to the left of the square too; most squares fail on one of three words.
    least = np.maximum(PERIODS * periods, SHORTEST) - 2 * periods
    able = starts >= least
    starts, periods, least = starts[able], periods[able], least[able]
    able = np.ones(len(starts), bool)
    for back in (1, np.minimum(periods, least), least):
        able &= symbols[starts - back] == symbols[starts - back + periods]
    starts, periods = starts[able], periods[able]
    ends = starts + 2 * periods
    runs = []
    by_end = np.lexsort((periods, ends))
    for group in np.split(by_end, np.flatnonzero(np.diff(ends[by_end])) + 1):
        while len(group):
            q, end = int(periods[group[0]]), int(ends[group[0]])
            start = _rotate(symbols, end - 2 * q, q)
            if end - start >= max(PERIODS * q, SHORTEST):
                runs.append((start, end - start, q))
            group = group[(periods[group] % q != 0) | (end - 2 * periods[group] < start)]
    return sorted(runs, key=lambda r: (r[0], r[2]))


def _rotate(symbols: np.ndarray, start: int, period: int) -> int:
    """Where the leftmost rotation of the square at `start` begins."""
    reach = 16
    while start > 0:
        low = max(0, start - reach)
        differ = np.flatnonzero(symbols[low:start] != symbols[low + period : start + period])
        if len(differ):
            return low + int(differ[-1]) + 1
        start, reach = low, reach * 2
    return 0


def of_texts(texts: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """The runs of each list of words."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    known: dict[bytes, int] = {}
    number = count()
    words = np.fromiter((known.setdefault(w, next(number)) for t in texts for w in t), np.int64, int(sizes.sum()))
    symbols = words + np.repeat(np.arange(len(texts)) * max(1, len(words)), sizes)
    limit = np.repeat(sizes // PERIODS, sizes)
    ends = np.cumsum(sizes)
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for start, length, period in find_runs(symbols, limit):
        i = int(np.searchsorted(ends, start, "right"))
        out[i].append((start - int(ends[i] - sizes[i]), length, period))
    return out


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words joined by one space, without those that any run holds after its first period."""
    if runs:
        change = np.zeros(len(words) + 1, np.int64)
        for start, length, period in runs:
            change[start + period] += 1
            change[start + length] -= 1
        words = [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0)]
    return b" ".join(words)


def tandem_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, runs, collapsed): the periodic runs of words of every whole text, and the text without the repeats.

    A run is a longest stretch of words with smallest period q of at least 4 q and 6 words. `runs` is an array of (start, length,
    period) by start and period; `collapsed` joins the words that no run holds after its first q words by one space. Words
    are what white space (space and the controls from tab to carriage return) parts.

    A null or empty text and one of white space has no words and no runs. Texts never share a run; a very long text has a suffix array of
    its own, in memory in proportion to its words times the logarithm of its longest repeat. Runs of different periods may overlap. Rows with equal or
    null ids are kept, each judged by its own text. An empty table gives an empty result. Other columns are ignored.
    """

    def run(ids: list, texts: list) -> Iterator[dict]:
        held: list[list[bytes]] = []
        held_ids, size = [], 0
        for doc_id, text in zip(ids, texts, strict=True):
            words = (text or b"").split()
            if held and size + len(words) > AT_ONCE:
                yield rows(held_ids, held)
                held, held_ids, size = [], [], 0
            held.append(words)
            held_ids.append(doc_id)
            size += len(words)
        if held:
            yield rows(held_ids, held)

    def rows(ids: list, texts: list[list[bytes]]) -> dict:
        found = of_texts(texts)
        names = ("start", "length", "period")
        return {
            "doc_id": ids,
            "n_words": list(map(len, texts)),
            "runs": [[dict(zip(names, r, strict=True)) for r in runs] for runs in found],
            "collapsed": [collapse(words, runs).decode() for words, runs in zip(texts, found, strict=True)],
        }

    kept = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    runs = "array<struct<start: bigint, length: bigint, period: bigint>>"
    return map_batches(kept, run, f"doc_id {kept.dtypes[0][1]}, n_words long, runs {runs}, collapsed string")
