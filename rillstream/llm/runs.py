"""Periodic runs of words: maximal stretches that repeat with a smallest period at least three times.

A run of period ``q`` is a maximal stretch in which words ``q`` apart are equal. Periods below SHORT are found by comparing the words
with themselves at each lag. Longer ones fall into scales ``[P, 1.5 P)``. Per scale each gram of P / 2 words has a hash, and a
gram stands out if its hash is the least of some window of grams. A window of ``2 P`` words fits twice, one period apart, into a run
of three periods, so its minima repeat there at the distance of the period: pairs of equal minima at a distance of the scale
seed the search, and comparing words to both sides gives the whole run.

Grams inside a run of a short period (at most a third of the gram) are left out. Equal grams that are left lie more than a third of a gram
apart, so every minimum has a handful of partners whatever the text. And no run is lost by it: a window of which all grams are left out
lies in one run of the short period, is longer than both periods together, and so the longer period would not be the smallest.

All texts of a batch are searched together; between two texts stands a word that occurs once.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import chain, count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import per_slice

LEAST_WORDS = 24
LEAST_REPEATS = 3
#: Periods below are searched lag by lag; half of it is the smallest gram and must reach LEAST_WORDS.
SHORT = 2 * LEAST_WORDS
_STEP = np.uint64(0x9E3779B97F4A7C15)
_BASE = np.uint64(0xD6E8FEB86659FD93)
_NONE = np.iinfo(np.uint64).max


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return values ^ (values >> np.uint64(29))


def _sliding(values: np.ndarray, width: int, better: np.ufunc) -> np.ndarray:
    """``better`` over each ``width`` consecutive values, by doubling."""
    done = 1
    while 2 * done <= width:
        values = better(values[:-done], values[done:])
        done *= 2
    return better(values[:len(values) - width + done], values[width - done:]) if done < width else values


def _whole_lags(words: np.ndarray, lag: int, least: int) -> Iterator[tuple[int, int]]:
    """(first, end) of the stretches of at least ``least`` positions whose words reappear ``lag`` further on."""
    if len(words) < lag + least:
        return
    starts = np.flatnonzero(_sliding(words[:-lag] == words[lag:], least, np.logical_and))
    if len(starts):
        cut = np.flatnonzero(np.diff(starts) > 1)
        for a, b in zip(starts[np.r_[0, cut + 1]], starts[np.r_[cut, len(starts) - 1]]):
            yield int(a), int(b) + least


def _reach(words: np.ndarray, at: int, lag: int, step: int) -> int:
    """How many positions from ``at`` on, in the direction of ``step``, have words that reappear ``lag`` further on."""
    done, size = 0, 64
    while True:
        if step > 0:
            here = words[at + done:min(at + done + size, len(words) - lag)]
            there = words[at + done + lag:at + done + lag + len(here)]
        else:
            low = max(0, at - done - size + 1)
            here, there = words[low:at - done + 1][::-1], words[low + lag:at - done + 1 + lag][::-1]
        differ = np.flatnonzero(here != there)
        if len(differ):
            return done + int(differ[0])
        done += len(here)
        if len(here) < size:
            return done
        size *= 2


def _seeds(words: np.ndarray, found: list[tuple[int, int, int]], low: int, high: int) -> Iterator[tuple[int, int]]:
    """(position, lag) of equal minima, by position; ``found`` are the runs (first, end, period) of smaller periods."""
    gram, span = low // 2, 2 * low
    places = len(words) - gram + 1
    if places < span - gram + 1:
        return
    powers = np.cumprod(np.full(len(words), _BASE, np.uint64))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_mixed(words.astype(np.uint64) * _STEP) * powers)])
    # the sum over a gram, moved to a common power of the base
    hashes = _mixed((sums[gram:] - sums[:-gram]) * powers[::-1][gram - 1:])
    hashes[hashes == _NONE] = 0
    for first, end, period in found:
        if 3 * period <= gram <= end - first:
            hashes[first:end - gram + 1] = _NONE
    width = span - gram + 1
    least = _sliding(hashes, width, np.minimum)
    edge = np.zeros(width - 1, np.uint64)
    stands = np.flatnonzero((_sliding(np.concatenate([edge, least, edge]), width, np.maximum) == hashes) & (hashes != _NONE))
    order = stands[np.argsort(hashes[stands], kind="stable")]
    value, pairs = hashes[order], []
    for further in count(1):
        lag = order[further:] - order[:-further]
        near = (value[further:] == value[:-further]) & (lag < high)
        good = near & (lag >= low)
        pairs.append(np.stack([order[:-further][good], lag[good]], 1))
        if not near.any():
            break
    every = np.concatenate(pairs)
    yield from every[np.argsort(every[:, 0], kind="stable")].tolist()


def find_runs(words: np.ndarray, breaks: np.ndarray, least_words: int = LEAST_WORDS) -> list[tuple[int, int, int]]:
    """(first, end, period) of all runs in ``words``; ``breaks`` are the positions of words that occur once, one behind each text.

    A run has at least ``least_words`` (24 or less) words and three periods.
    """
    found: list[tuple[int, int, int]] = []
    known: set[tuple[int, int]] = set()

    def add(first: int, end: int, lag: int) -> None:
        # a stretch with a smaller period is maximal there too, so it has been met
        if end - first >= max(least_words, LEAST_REPEATS * lag) and (first, end) not in known:
            known.add((first, end))
            found.append((first, end, lag))

    lengths = np.diff(np.concatenate([[-1], breaks])) - 1
    longest = int(lengths.max(initial=0))
    for lag in range(1, min(SHORT, longest // LEAST_REPEATS + 1)):
        for first, end in _whole_lags(words, lag, max(least_words - lag, (LEAST_REPEATS - 1) * lag)):
            add(first, end + lag, lag)
    low = SHORT
    while LEAST_REPEATS * low <= longest:
        high = low + low // 2
        # only texts that can hold such a run; their places in the whole
        part = np.flatnonzero(np.repeat(lengths >= LEAST_REPEATS * low, lengths + 1))
        held = words[part]
        shift = dict(zip(found, np.searchsorted(part, [f[0] for f in found]).tolist())) if found else {}
        inside = [(at, at + f[1] - f[0], f[2]) for f, at in shift.items() if at < len(part) and part[at] == f[0]]
        ended: dict[int, int] = defaultdict(int)
        fresh: list[tuple[int, int, int]] = []
        for at, lag in _seeds(held, inside, low, high):
            if at >= ended[lag]:
                first, end = at + 1 - _reach(held, at, lag, -1), at + _reach(held, at, lag, 1)
                ended[lag] = max(ended[lag], end, at + 1)
                if end - first >= (LEAST_REPEATS - 1) * lag:
                    fresh.append((int(part[first]), int(part[first]) + end - first + lag, lag))
        for first, end, lag in sorted(fresh, key=lambda f: f[2]):
            add(first, end, lag)
        low = high
    return found


def text_runs(texts: list[str | None], least_words: int = LEAST_WORDS) -> list[tuple[list[bytes], list[tuple[int, int, int]]]]:
    """Per text its words and runs (start, length, period) by start, then period; null counts as empty."""
    numbers: dict[bytes, int] = defaultdict(count().__next__)
    words = [(text or "").encode().split() for text in texts]
    breaks = np.cumsum([len(w) + 1 for w in words]) - 1
    flat = np.empty(int(breaks[-1]) + 1 if words else 0, np.int64)
    said = np.ones(len(flat), bool)
    said[breaks] = False
    flat[said] = np.fromiter(map(numbers.__getitem__, chain.from_iterable(words)), np.int64, len(flat) - len(breaks))
    flat[breaks] = -1 - np.arange(len(breaks))
    out: list[list[tuple[int, int, int]]] = [[] for _ in words]
    for first, end, period in find_runs(flat, breaks, least_words):
        which = int(np.searchsorted(breaks, first))
        out[which].append((first - (int(breaks[which - 1]) + 1 if which else 0), end - first, period))
    return [(w, sorted(runs, key=lambda r: (r[0], r[2]))) for w, runs in zip(words, out)]


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> str:
    """The words without those behind the first period of a run, joined by one blank."""
    gone: set[int] = set()
    for start, length, period in runs:
        gone.update(range(start + period, start + length))
    return b" ".join([w for i, w in enumerate(words) if i not in gone] if gone else words).decode()


def periodic_runs(docs: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """(doc_id, n_words, runs of (start, length, period), collapsed) of every row of ``docs`` (doc_id, text, anything else).

    Words are what white space (ASCII) separates, compared as they are. ``collapsed`` is the text without the repeats. Null and
    empty texts have no words, no runs and an empty collapsed text; rows that repeat a doc_id or have none are rows like others.
    Other columns of ``docs`` are left out. Texts are not compared with each other, so nothing is shuffled; about 4 MB of text
    are searched at a time (one longer text alone). ``least_words`` may be at most LEAST_WORDS.
    """
    if not 1 <= least_words <= LEAST_WORDS:
        raise ValueError(f"least_words must be between 1 and {LEAST_WORDS}")
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("runs", pa.list_(run)), ("collapsed", pa.string())])

    def search(rows: dict[str, list]) -> dict[str, list]:
        done = text_runs(rows["text"], least_words)
        return {"doc_id": rows["doc_id"], "n_words": [len(words) for words, _ in done],
                "runs": [[dict(zip(("start", "length", "period"), r)) for r in runs] for _, runs in done],
                "collapsed": [collapsed(words, runs) for words, runs in done]}

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        per_slice(search, schema),
        "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")
