"""Benchmark decontamination by winnowing.

Of every ``SPAN - K + 1`` consecutive word k-grams those with the smallest hash are kept. Equal spans of ``SPAN`` words keep the
same k-grams on both sides, so every shared span of that length has a fingerprint in common. Items of fewer words have one fingerprint, of all
their words, and documents are looked through for those at every word.

Fingerprints of documents that no item can have are dropped by a bit array of the benchmark's fingerprints, of a
fixed largest size. The rest, of each different text once, are joined with the benchmark's by their hash. Every pair of a text and
an item that share one is compared by extending the common fingerprints over equal words in both directions; an extended hit of at
least ``SPAN`` words, or a whole shorter item, marks words. Results meet the rows by 128 bits of hashes of the text.
"""

from __future__ import annotations

from itertools import chain, count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import per_slice, stored

SPAN = 10
K = 5
#: Largest size of the bit array of benchmark fingerprints, as a power of two (16 MB).
MOST_BITS = 27
_BLANK = bytes(c + 32 if 65 <= c < 91 else c if 48 <= c < 58 or 97 <= c < 123 or c >= 128 else 32 for c in range(256))
_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_FACTOR = np.uint64(0xD6E8FEB86659FD93)
_PAIR = "a long, b long"
#: Keys of texts that are sent to every task at most; more are joined by a shuffle.
SENT_KEYS = 1 << 20


def words_of(text: str | None) -> list[bytes]:
    """Words after lower-casing A-Z: runs of digits, a-z and code points from 128 on."""
    return text.encode().translate(_BLANK).split() if text else []


def _hashes(words: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The word hashes of all texts one behind the other, the text of each, and its number of words from there on."""
    lengths = np.array([len(w) for w in words], np.int64)
    flat = np.fromiter(map(xxhash.xxh64_intdigest, chain.from_iterable(words)), np.uint64, int(lengths.sum()))
    of = np.repeat(np.arange(len(words)), lengths)
    return flat, of, (np.cumsum(lengths)[of] - np.arange(len(flat))) if len(flat) else of


def _grams(hashes: np.ndarray, size: int, seed: int) -> np.ndarray:
    """Hashes of all runs of ``size`` words; another seed gives others."""
    count = len(hashes) - size + 1
    out = np.full(max(0, count), np.uint64(seed), np.uint64)
    for shift in range(size if count > 0 else 0):
        out = (out ^ (out >> np.uint64(31))) * _FACTOR + hashes[shift:shift + count]
    out = (out ^ (out >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return out ^ (out >> np.uint64(32))


def _of_each(values: np.ndarray, width: int, better: np.ufunc) -> np.ndarray:
    count = len(values) - width + 1
    out = values[:count]
    for shift in range(1, width):
        out = better(out, values[shift:shift + count])
    return out


def winnow(hashes: np.ndarray, span: int = SPAN, k: int = K) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the k-grams that are the smallest of some window of ``span`` words, and their hashes."""
    window, grams = span - k + 1, _grams(hashes, k, 0)
    if len(grams) < window:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    least = _of_each(grams, window, np.minimum)
    edge = np.zeros(window - 1, np.uint64)
    kept = np.flatnonzero(_of_each(np.concatenate([edge, least, edge]), window, np.maximum) == grams)
    return kept, grams[kept]


def fingerprints(words: list[list[bytes]], short: list[int], span: int = SPAN, k: int = K) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of every fingerprint of texts: winnowed, and of all runs of the lengths ``short``."""
    hashes, of, left = _hashes(words)
    # windows over the end of a text only add fingerprints
    at, values = winnow(hashes, span, k)
    inside = left[at] >= k
    texts, found = [of[at[inside]]], [values[inside]]
    for size in short:
        grams = _grams(hashes, size, size)
        inside = left[:len(grams)] >= size
        texts.append(of[:len(grams)][inside])
        found.append(grams[inside])
    return np.concatenate(texts), np.concatenate(found)


class Benchmark:
    """Items whose occurrences in a text are found by their fingerprints, extended over equal words."""

    def __init__(self, items: list[tuple[str, str | None]], span: int = SPAN, k: int = K) -> None:
        self.span, self.k = span, k
        self.items = [(name, words_of(text)) for name, text in items]
        self.places: dict[int, list[tuple[int, int]]] = {}
        for index, (_, words) in enumerate(self.items):
            if len(words) >= span:
                for at, value in zip(*winnow(_hashes([words])[0], span, k)):
                    self.places.setdefault(int(value), []).append((index, int(at)))
        self.values = np.array(sorted(self.places), np.uint64)

    def hits(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Spans [begin, end) of hit words, unsorted, and the names of the items that occur."""
        spans: list[tuple[int, int]] = []
        found: set[int] = set()
        for index, (_, item) in enumerate(self.items):
            if 0 < len(item) < self.span:
                same = [at for at, word in enumerate(words) if word == item[0] and words[at:at + len(item)] == item]
                spans += [(at, at + len(item)) for at in same]
                found.update([index] if same else [])
        if len(self.values) and len(words) >= self.span:
            kept, hashes = winnow(_hashes([words])[0], self.span, self.k)
            common = np.isin(hashes, self.values)
            reached: dict[tuple[int, int], int] = {}  # by item and diagonal
            for at, value in zip(kept[common].tolist(), hashes[common].tolist()):
                for index, place in self.places[value]:
                    if at >= reached.get((index, at - place), -1):
                        left, right = self._extended(words, at, self.items[index][1], place)
                        reached[index, at - place] = at + right
                        if left + right >= self.span:
                            spans.append((at - left, at + right))
                            found.add(index)
        return spans, {self.items[index][0] for index in found}

    @staticmethod
    def _extended(words: list[bytes], at: int, item: list[bytes], place: int) -> tuple[int, int]:
        """How many words before and from a common place on are equal."""
        left = right = 0
        while left < min(place, at) and words[at - left - 1] == item[place - left - 1]:
            left += 1
        while right < min(len(item) - place, len(words) - at) and words[at + right] == item[place + right]:
            right += 1
        return left, right


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for begin, end in sorted(spans):
        if out and begin <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((begin, end))
    return out


def _key(text: Column) -> list[Column]:
    return [F.xxhash64(text), F.xxhash64(F.lit(K), text)]


def _items(benchmark: DataFrame, span: int, k: int, least_words: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(item, text, size, values) of the different items, numbered; (item, name); (item, value) of their fingerprints."""
    schema = pa.schema([("name", pa.string()), ("text", pa.string()), ("size", pa.int64()), ("values", pa.list_(pa.int64()))])

    def run(rows: dict[str, list]) -> dict[str, list]:
        words = [words_of(text) for text in rows["text"]]
        values = [np.unique(fingerprints([w], [len(w)] if 0 < len(w) < span else [], span, k)[1]).view(np.int64) for w in words]
        return {"name": rows["name"], "text": [b" ".join(w).decode() for w in words], "size": [len(w) for w in words], "values": values}

    rows = benchmark.select(F.col("item_id").cast("string").alias("name"), "text").mapInArrow(
        per_slice(run, schema), "name string, text string, size long, values array<long>").where(F.col("size") >= max(1, least_words))
    rows = stored(rows, "bench-rows")
    items = stored(rows.groupBy("text").agg(F.first("size").alias("size"), F.first("values").alias("values")).withColumn(
        "item", F.monotonically_increasing_id()), "bench-items")
    names = rows.where("name is not null").select("name", "text").join(items.select("item", "text"), "text").select("item", "name")
    return items, names.distinct(), items.select("item", F.explode("values").alias("value"))


def _bits(values: DataFrame) -> Broadcast:
    """A bit array of the fingerprints ``value``, of MOST_BITS bits at most, sent to the tasks."""
    width = min(MOST_BITS, max(13, (4096 * values.count()).bit_length()))
    place = F.shiftrightunsigned("value", 64 - width)
    rows = values.select(F.shiftright(place, 3).alias("byte"), (place % 8).cast("int").alias("bit")).groupBy("byte").agg(
        *(F.max(F.col("bit") == i).alias(f"b{i}") for i in range(8))).toArrow()  # a row for each byte of the array at most
    array = np.zeros(1 << (width - 3), np.uint8)
    array[rows["byte"].to_numpy()] = sum(rows[f"b{i}"].to_numpy().astype(np.uint8) << i for i in range(8))
    return values.sparkSession.sparkContext.broadcast((width, array))


def _suspects(docs: DataFrame, bits: Broadcast, short: list[int], span: int, k: int) -> DataFrame:
    """(a, b, text, values) of the different texts with fingerprints that the bit array holds."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("text", pa.string()), ("values", pa.list_(pa.int64()))])

    def run(rows: dict[str, list]) -> dict[str, list]:
        width, array = bits.value
        texts, values = fingerprints([words_of(text) for text in rows["text"]], short, span, k)
        place = values >> np.uint64(64 - width)
        held = ((array[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1).astype(bool)
        texts, values = texts[held], values[held].view(np.int64)
        order = np.argsort(texts, kind="stable")
        which, begin = np.unique(texts[order], return_index=True)
        parts = [np.unique(part) for part in np.split(values[order], begin[1:])] if len(which) else []
        return {name: [rows[name][i] for i in which] for name in ("a", "b", "text")} | {"values": parts}

    a, b = _key(F.col("text"))
    rows = docs.select(a.alias("a"), b.alias("b"), "text").mapInArrow(
        per_slice(run, schema), f"{_PAIR}, text string, values array<long>")
    return rows.groupBy("a", "b").agg(F.first("text").alias("text"), F.first("values").alias("values"))


def hit_texts(docs: DataFrame, benchmark: DataFrame, span: int = SPAN, k: int = K, least_words: int = 1) -> DataFrame:
    """(a, b, spans, items) of the different texts of ``docs`` with hit words; a and b are hashes of the text."""
    items, names, values = _items(benchmark, span, k, least_words)
    short = [r[0] for r in items.where(F.col("size") < span).select("size").distinct().collect()]  # fewer than span lengths
    suspects = stored(_suspects(docs, _bits(values), sorted(short), span, k), "bench-suspects")
    pairs = suspects.select("a", "b", F.explode("values").alias("value")).join(values, "value").select("a", "b", "item").distinct()
    met = stored(pairs, "bench-pairs").join(suspects.select("a", "b", "text"), ["a", "b"]).join(
        items.select("item", F.col("text").alias("wanted")), "item")
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("item", pa.int64()),
                        ("spans", pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())])))])

    def run(rows: dict[str, list]) -> dict[str, list]:
        built: dict[int, Benchmark] = {}  # of the items of a slice
        spans = []
        for item, text, wanted in zip(rows["item"], rows["text"], rows["wanted"]):
            index = built.get(item) or built.setdefault(item, Benchmark([("", wanted)], span, k))
            spans.append([{"begin": x, "end": y} for x, y in merged(index.hits(words_of(text))[0])])
        return {"a": rows["a"], "b": rows["b"], "item": rows["item"], "spans": spans}

    span_type = "array<struct<begin:long,end:long>>"
    found = stored(met.select("a", "b", "item", "text", "wanted").mapInArrow(
        per_slice(run, schema), f"{_PAIR}, item long, spans {span_type}").where("size(spans) > 0"), "bench-hits")
    named = found.join(names, "item").groupBy("a", "b").agg(F.sort_array(F.collect_set("name")).alias("items"))
    joined = F.aggregate(F.sort_array(F.flatten(F.collect_list("spans"))), F.array().cast(span_type), lambda done, s: F.when(
        (F.size(done) > 0) & (F.get(done, F.size(done) - 1)["end"] >= s["begin"]),
        F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(F.struct(
            F.get(done, F.size(done) - 1)["begin"].alias("begin"),
            F.greatest(F.get(done, F.size(done) - 1)["end"], s["end"]).alias("end"))))).otherwise(F.concat(done, F.array(s))))
    spans = found.groupBy("a", "b").agg(joined.alias("spans"))
    return stored(spans.join(named, ["a", "b"], "left"), "bench-texts")


def _beside(docs: DataFrame, hits: DataFrame) -> tuple[DataFrame, DataFrame, Column]:
    """``docs`` with the key of their text in columns no row has, ``hits`` to be joined, and the condition."""
    a, b = (next(name for name in (f"__{side}{i}" for i in count()) if name not in docs.columns) for side in "ab")
    keyed = docs.withColumns(dict(zip((a, b), _key(F.col("text")))))
    sent = F.broadcast(hits) if hits.count() <= SENT_KEYS else hits
    return keyed, sent, (keyed[a] == hits["a"]) & (keyed[b] == hits["b"])


def contaminated_spans(docs: DataFrame, benchmark: DataFrame, span: int = SPAN, k: int = K, least_words: int = 1) -> DataFrame:
    """``docs`` (doc_id, text, …) with n_words, spans [begin, end) of hit words and the item names found.

    Null texts have no words. Items with a null text or no words, or with fewer than ``least_words``, are not looked for; items without
    an id mark words but have no name. Repeated rows get the same result; columns called n_words, spans or items are
    replaced. An empty benchmark hits nothing.
    """
    keep = [c for c in docs.columns if c not in ("n_words", "spans", "items")]
    rows, hits, same = _beside(docs.select(*keep), hit_texts(docs, benchmark, span, k, least_words))
    n_words = F.coalesce(F.regexp_count(rows["text"], F.lit(_WORD)), F.lit(0)).cast("long")
    return rows.join(hits, same, "left").select(
        *(rows[c] for c in keep), n_words.alias("n_words"),
        F.coalesce(hits["spans"], F.array().cast("array<struct<begin:long,end:long>>")).alias("spans"),
        F.coalesce(hits["items"], F.array().cast("array<string>")).alias("items"))


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, least_words: int = 1) -> DataFrame:
    """The rows of ``docs`` without a hit word of an item of ``least_words`` words or more, with the columns of ``docs``.

    An item of a word or two stands in many documents by chance; ``least_words`` keeps such items from removing them.
    """
    rows, hits, same = _beside(docs, hit_texts(docs, benchmark, least_words=least_words).select("a", "b"))
    return rows.join(hits, same, "left_anti").select(*(rows[c] for c in docs.columns))
