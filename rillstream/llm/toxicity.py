"""Toxicity by class-conditional Kneser-Ney language models.

Toxic and ordinary texts each have a bigram model: bigrams of the class, below them words of the class, below them counts
shared by both classes: words, then Kneser-Ney's continuation counts (how many different words come before), and at the bottom
the word frequencies of all documents.
Between the words of a class and the shared counts lie the stems of the class: a word leans to a class as all words of its stem do.
A count is discounted towards what the level below expects, by the usual constant and by what chance explains, so a rare
expression has the same shared likelihood in both classes unless it clearly belongs to one. A bigram counts once per text, so that one
long or repetitive text has no more say than others. A text's score
compares its two log-likelihoods per word, and a logistic curve turns the difference into a number from 0 to 1.

The two models are fitted on all labelled rows up to about ``sample_rows`` a class, beyond that on those with the
smallest hashes. All their words are kept and all their bigrams counted, however rare; in bigrams a seldom word stands as its stem.
A bigram of a single text never differs by more than chance from what its words lead to expect, so it follows from its words. The words of all documents are counted, and
the words of the labelled rows take their frequencies from there. A word that no labelled row holds stands as its stem (its
first ``STEM`` characters) with the other such words of that stem, and where no labelled word has that stem, as the one rare word.
So what reaches the tasks is bounded by the labelled rows, while what is counted grows with the documents.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import per_slice, slices, stored

SAMPLE_ROWS = 20_000
DISCOUNT = 0.75
#: Standard deviations from the level below that still count as chance.
REACH = 3.0
#: Words that say nothing and are counted with each text, so that chance in a text of a few words weighs little.
NEUTRAL = 10
FOLDS, HELD_OUT, CALIBRATION = 5, 0, 1
FLUSH = 1 << 16
#: Words that ``numbered`` holds as Python objects at a time (one longer text goes alone).
PORTION = 1 << 16
_BLANK = bytes(c if 48 <= c < 58 or 97 <= c < 123 or c >= 128 else 32 for c in range(256))
RARE = 0
#: Leading characters of a word that words without labels are grouped by.
STEM = 5
#: Words rarer than one in this many lean to a class together with their stem's other such words, and stand as it in bigrams.
SELDOM = 1 << 17
#: Starts the name of a group of words; no word has this byte.
GROUP = b"\0"


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased runs of letters, digits and everything beyond ASCII."""
    return text.lower().encode().translate(_BLANK).split() if text else []


def stem_of(word: bytes) -> bytes:
    return word[:STEM] if word.isascii() else word.decode()[:STEM].encode()


def numbered(vocabulary: pa.Array, texts: list[str | None]) -> list[np.ndarray]:
    """Per text the ids of its words, of words without labels those of their stems.

    Ids are places in ``vocabulary`` from 1 on. Arrow looks all words up at once, so a task holds no dictionary of them.
    """
    ends, parts, held = [], [], []
    for text in texts:
        held += words_of(text)
        ends.append(len(held) + sum(map(len, parts)))
        if len(held) > PORTION:  # words as Python objects take several times the text
            parts.append(pa.array(held, pa.binary()))
            held = []
    parts.append(pa.array(held, pa.binary()))
    del held
    distinct = pa.concat_arrays(parts).dictionary_encode()
    del parts
    ids = pc.index_in(distinct.dictionary, value_set=vocabulary)
    missing = distinct.dictionary.filter(ids.is_null())
    ids = ids.to_numpy(zero_copy_only=False)
    if len(missing):
        stems = pa.array([GROUP + stem_of(word) for word in missing.to_pylist()], pa.binary())
        ids = ids.astype(np.float64)
        ids[np.isnan(ids)] = pc.fill_null(pc.index_in(stems, value_set=vocabulary), RARE - 1).to_numpy()
    every = ids.astype(np.int64)[distinct.indices.to_numpy()] + 1
    return np.split(every, ends[:-1]) if ends else []


def fold(doc_id: str) -> Column:
    """crc32 of a doc_id as text, modulo the number of folds; null for a null id."""
    return F.crc32(F.col(doc_id).cast("string")) % FOLDS


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) over all texts, counted in each task first."""
    schema = pa.schema([("word", pa.binary()), ("n", pa.int64())])

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()
        for part in slices(batches):
            for text in part.to_pydict()["text"]:
                held.update(words_of(text))
            if len(held) > FLUSH:
                yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()),
                                                  pa.array(list(held.values()), pa.int64())], schema=schema)
                held.clear()
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()),
                                          pa.array(list(held.values()), pa.int64())], schema=schema)

    return docs.select("text").mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def labelled(labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """(doc, toxic, fit): the labelled documents that may be learned from, about ``sample_rows`` a class at most.

    Null ids and labels are left out; of contradicting labels the toxic one counts. ``fit`` is false for rows
    that set the curve only.
    """
    rows = labels.select(F.col("doc_id").cast("long").alias("doc"), (F.col("toxic") > 0).cast("int").alias("toxic"))
    rows = rows.where("doc is not null and toxic is not null").groupBy("doc").agg(F.max("toxic").alias("toxic"))
    rows = stored(rows.where(fold("doc") != HELD_OUT), "toxic-labels")
    sizes = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}  # two rows
    share = F.create_map(*(F.lit(x) for t in (0, 1) for x in (t, min(1.0, sample_rows / max(1, sizes.get(t, 0))))))
    spread = F.pmod(F.xxhash64("doc"), F.lit(1 << 30)) / float(1 << 30)
    return rows.where(spread < F.element_at(share, F.col("toxic"))).withColumn("fit", fold("doc") != CALIBRATION)


class Model:
    """Log-likelihoods of both classes as arrays over word ids; id 0 is the rare word, the others number ``words`` from 1 on."""

    def __init__(self, words: pa.Array, stems: np.ndarray, corpus: np.ndarray, seldom: np.ndarray, stands: np.ndarray,
                 followers: np.ndarray, pooled: np.ndarray, context: np.ndarray, gains: np.ndarray) -> None:
        """``stems``: a number per stem, by word. ``stands``: what each stands as in bigrams, its stem where it is
        ``seldom``. ``followers``: bigrams counted per second word and class; ``pooled``: different first words per second
        word. ``context``: bigrams counted per first word and class, as these stand; ``gains``: their counts less the discounts."""
        size = len(corpus)
        self.words, self.stands, self.size, self.context = words, stands, size, context
        base = (corpus + 1) / (corpus + 1).sum()
        rare = base[RARE]  # the rare word says nothing: it is as likely in both classes
        base = np.where(np.arange(size) == RARE, 0, base) / max(1 - rare, 1e-9) if size > 1 else base
        shared = self._below(followers.sum(axis=1), self._below(pooled, base))
        single = self._discounted(followers, self._by_stem(stems, seldom, followers, shared))
        # a class without learnable bigrams is as the shared model has it
        sums = single.sum(axis=0)
        single = np.where(sums > 0, single / np.where(sums > 0, sums, 1), shared[:, None])
        if size > 1:
            shared, single = shared * (1 - rare), single * (1 - rare)
            shared[RARE] = single[RARE] = rare
        # bigrams are of what the words stand as
        self.standing, self.common = self._sums(stands, single), self._sums(stands, shared)
        unused = np.setdiff1d(np.arange(size), stands)
        self.standing[unused] = self.common[unused] = 1
        self.seen = np.maximum(context.sum(axis=1), 1)
        self.free = np.maximum(1 - gains / self.seen, 0)
        self.single = np.log(single)
        self.keep(np.zeros(0, np.int64), np.zeros((0, 2)))

    def leaning(self, pairs: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Likelihoods of bigrams per class from their counts.

        The level below is the bigram shared by both classes, leaning to the class as its second word does.
        """
        first, second = pairs // self.size, pairs % self.size
        common = np.maximum(counts.sum(axis=1) - DISCOUNT, 0) / self.seen[first] + self.free[first] * self.common[second]
        below = common[:, None] * self.standing[second] / self.common[second][:, None]
        total = self.context[first]
        moved = self._discounted(counts, total * below)
        return np.where(total > 0, moved / np.maximum(total, 1), below)

    def keep(self, pairs: np.ndarray, pair: np.ndarray) -> None:
        """Take in the likelihoods of bigrams; all others follow from their words."""
        first, second = pairs // self.size, pairs % self.size
        # bigrams kept leave a twentieth at least to all other words, which follow as the level below has them
        kept, below = self._sums(first, pair), self._sums(first, self.standing[second])
        pair = pair * np.minimum(1, 0.95 / np.maximum(kept, 1e-9))[first]
        weight = np.maximum(1 - kept, 0.05) / np.maximum(1 - below, 0.05)
        self.pairs, self.pair, self.weight = pairs, np.log(pair).astype(np.float32), np.log(weight)

    def _sums(self, keys: np.ndarray, values: np.ndarray) -> np.ndarray:
        out = np.zeros((self.size, *values.shape[1:]))
        np.add.at(out, keys, values)
        return out

    def _by_stem(self, of: np.ndarray, seldom: np.ndarray, followers: np.ndarray, shared: np.ndarray) -> np.ndarray:
        """Counts of each word that its stem leads to expect in a class of that many words; a seldom word
        leans as the seldom words of its stem do, and these towards the whole stem."""
        stems = int(of.max()) + 1
        expected = followers.sum(axis=0) * shared[:, None]
        for members in (np.ones(self.size, bool), seldom):
            counts, plain = np.zeros((stems, 2)), np.zeros((stems, 2))
            np.add.at(counts, of[members], followers[members])
            np.add.at(plain, of[members], expected[members])
            leaning = self._discounted(counts, plain) / np.maximum(plain, 1e-300)
            expected[members] *= leaning[of[members]]
        return expected

    @staticmethod
    def _discounted(counts: np.ndarray, expected: np.ndarray) -> np.ndarray:
        """Counts moved towards what the level below expects, by as much as chance explains."""
        over = counts - expected
        return expected + np.sign(over) * np.maximum(np.abs(over) - DISCOUNT - REACH * np.sqrt(expected + 1), 0)

    @staticmethod
    def _below(counts: np.ndarray, lower: np.ndarray) -> np.ndarray:
        """Discounted counts, the rest by the level below."""
        total = counts.sum()
        if not total:
            return lower
        gain = np.maximum(counts - DISCOUNT, 0)
        return (gain + (total - gain.sum()) * lower) / total

    def __getstate__(self) -> dict:
        """What ``likelihoods`` needs; what is known of bigrams only for words that others stand as, renumbered in their order."""
        used, stands = np.unique(self.stands, return_inverse=True)
        first, second = (np.searchsorted(used, x) for x in (self.pairs // self.size, self.pairs % self.size))
        return {"words": self.words, "single": self.single, "stands": stands.astype(np.int32), "size": len(used),
                "standing": self.standing[used], "weight": self.weight[used], "pairs": first * len(used) + second, "pair": self.pair}

    def likelihoods(self, texts: list[str | None]) -> list[tuple[int, float, float]]:
        """Per text the number of words, log-likelihood per word as an ordinary and as a toxic text."""
        return [self._likelihood(ids) for ids in numbered(self.words, texts)]

    def _likelihood(self, ids: np.ndarray) -> tuple[int, float, float]:
        if not len(ids):
            return 0, 0.0, 0.0
        total = self.single[ids].sum(axis=0)
        if len(ids) > 1:
            stands = self.stands[ids].astype(np.int64)
            first, second = stands[:-1], stands[1:]
            total = total + self.weight[first].sum(axis=0)
            if len(self.pairs):
                keys = first * self.size + second
                at = np.minimum(np.searchsorted(self.pairs, keys), len(self.pairs) - 1)
                hit = self.pairs[at] == keys
                total = total + (self.pair[at[hit]] - self.weight[first[hit]] - np.log(self.standing[second[hit]])).sum(axis=0)
        ordinary, toxic = total / (len(ids) + NEUTRAL)
        return len(ids), float(ordinary), float(toxic)


def train(docs: DataFrame, sample: DataFrame) -> Model:
    """Fit both models; what reaches the driver is bounded by the words and bigrams of the rows of ``sample``.

    Of rows with the same id one text is learned from, the smallest.
    """
    spark = docs.sparkSession
    counts = stored(word_counts(docs), "toxic-words")
    total = counts.agg(F.sum("n")).first()[0] or 0
    texts = docs.select(F.col("doc_id").cast("long").alias("doc"), "text").join(
        F.broadcast(sample.where("fit")), "doc").groupBy("doc").agg(  # bounded by the sample's size
            F.min("text").alias("text"), F.max("toxic").alias("toxic"))
    texts = stored(texts.select("text", "toxic"), "toxic-texts")
    own = stored(word_counts(texts).select("word"), "toxic-own")
    stem = F.concat(F.lit(GROUP), F.substring(F.col("word").cast("string"), 1, STEM).cast("binary"))
    others = counts.join(own, "word", "left_anti").groupBy(stem.alias("word")).agg(F.sum("n").alias("n"))
    groups = own.select(stem.alias("word")).distinct().join(others, "word", "left").select("word", F.coalesce("n", F.lit(0)).alias("n"))
    common = counts.join(own, "word").select("word", "n", stem.alias("stem")).union(
        groups.select("word", "n", F.col("word").alias("stem"))).orderBy("word").toArrow().combine_chunks()
    vocabulary, stem_column = (common[c].combine_chunks() for c in ("word", "stem"))
    numbers = common["n"].to_numpy().astype(np.float64)
    corpus = np.append(total - numbers.sum(), numbers)
    size = len(corpus)
    stems = np.append(0, stem_column.dictionary_encode().indices.to_numpy(zero_copy_only=False) + 1)
    seldom = np.append(False, numbers * SELDOM < total)
    group = np.append(RARE, pc.index_in(stem_column, value_set=vocabulary).to_numpy(zero_copy_only=False) + 1)
    seldom |= group == np.arange(size)
    seldom[RARE] = False
    stands = np.where(seldom, group, np.arange(size))
    words, standing = spark.sparkContext.broadcast(vocabulary), spark.sparkContext.broadcast(stands.astype(np.int32))
    schema = pa.schema([("pair", pa.int64()), ("toxic", pa.int32()), ("n", pa.int64())])

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        length = 0

        def flush() -> pa.RecordBatch:
            keys, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(keys >> 1), pa.array((keys & 1).astype(np.int32)), pa.array(n.astype(np.int64))], schema=schema)

        for part in slices(batches):
            rows = part.to_pydict()
            for mine, toxic in zip(numbered(words.value, rows["text"]), rows["toxic"]):
                if len(mine) > 1:
                    known = (mine[:-1] != RARE) & (mine[1:] != RARE)
                    held.append(np.unique((mine[:-1] * size + mine[1:])[known]) * 2 + toxic)  # once per text
                    length += len(held[-1])
            if length > 8 * FLUSH:
                yield flush()
                held, length = [], 0
        if held:
            yield flush()

    pairs = texts.mapInArrow(count, "pair long, toxic int, n long").groupBy("pair").agg(
        F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("ordinary"),
        F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("toxic"))
    pairs = stored(pairs, "toxic-bigrams")
    words.destroy()

    def stand(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = standing.value.astype(np.int64)
        for batch in batches:
            pair = batch.column(0).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([pa.array(of[pair // size] * size + of[pair % size]), *batch.columns[1:]],
                                             ["stands", "ordinary", "toxic"])

    standing_pairs = pairs.mapInArrow(stand, "stands long, ordinary long, toxic long")
    standing_pairs = stored(standing_pairs.groupBy("stands").agg(F.sum("ordinary").alias("ordinary"), F.sum("toxic").alias("toxic")),
                            "toxic-standing")
    standing.destroy()

    def dense(pairs: DataFrame, key: Column, *values: Column) -> np.ndarray:
        rows = pairs.groupBy(key.cast("int").alias("key")).agg(
            *(v.cast("double").alias(f"v{i}") for i, v in enumerate(values))).toArrow()  # a row per word at most
        out = np.zeros((size, len(values)))
        for i in range(len(values)):
            out[rows["key"].to_numpy(), i] = rows[f"v{i}"].to_numpy()
        return out

    followers = dense(pairs, F.col("pair") % size, F.sum("ordinary"), F.sum("toxic"), F.count(F.lit(1)))
    context = dense(standing_pairs, F.floor(F.col("stands") / F.lit(size)), F.sum("ordinary"), F.sum("toxic"),
                    F.sum(F.greatest(F.col("ordinary") + F.col("toxic") - DISCOUNT, F.lit(0.0))))
    model = Model(vocabulary, stems, corpus, seldom, stands, followers[:, :2], followers[:, 2], context[:, :2], context[:, 2])
    kept = standing_pairs.where("ordinary + toxic > 1").select(
        "stands", F.col("ordinary").cast("int").alias("ordinary"), F.col("toxic").cast("int").alias("toxic")).orderBy("stands").toArrow()
    keys = kept["stands"].to_numpy()
    pair = np.empty((len(keys), 2), np.float32)
    for at in range(0, len(keys), FLUSH):
        some = slice(at, at + FLUSH)
        counts = np.stack([kept[c].slice(at, FLUSH).to_numpy() for c in ("ordinary", "toxic")], 1).astype(np.float64)
        pair[some] = model.leaning(keys[some], counts)
    model.keep(keys, pair)
    return model


def likelihoods(docs: DataFrame, model: Broadcast) -> DataFrame:
    """``docs`` (doc_id and others without text) with n_words and the log-likelihoods per word of both classes."""
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("ordinary", pa.float64()), ("toxic", pa.float64())])

    def run(rows: dict[str, list]) -> dict[str, list]:
        found = model.value.likelihoods(rows["text"])
        return {"doc_id": rows["doc_id"], "n": [f[0] for f in found], "ordinary": [f[1] for f in found],
                "toxic": [f[2] for f in found]}

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        per_slice(run, schema), "doc_id long, n long, ordinary double, toxic double")


def curve(x: np.ndarray, y: np.ndarray, steps: int = 60, ridge: float = 1e-3) -> tuple[float, float]:
    """Slope and offset of the logistic curve of labels ``y`` over ``x``; where a class is missing nothing is called toxic."""
    positive = float(y.sum())
    if not 0 < positive < len(y):
        return 0.0, -float(np.log(2 * len(y) + 2.0))
    scale = float(x.std()) or 1.0
    points = np.stack([x / scale, np.ones(len(x))], 1)
    beta = np.zeros(2)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(points @ beta, -30, 30)))
        slope = points.T @ (y - p) - ridge * beta
        bend = (points * (p * (1 - p))[:, None]).T @ points + ridge * np.eye(2)
        step = np.linalg.solve(bend, slope)
        beta = beta + step * min(1.0, 5.0 / max(1e-9, float(np.abs(step).max())))
    return float(beta[0] / scale), float(beta[1])


def fitted(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> tuple[Broadcast, float, float]:
    """The class models of the labelled rows, sent to the tasks, with the slope and offset of the score."""
    spark = docs.sparkSession
    sample = stored(labelled(labels, sample_rows), "toxic-sample")
    model = spark.sparkContext.broadcast(train(docs, sample))
    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(
        F.broadcast(sample.where("not fit")).withColumnRenamed("doc", "doc_id"), "doc_id", "left_semi")
    known = likelihoods(chosen, model).join(
        F.broadcast(sample.select(F.col("doc").alias("doc_id"), F.col("toxic").alias("y"))), "doc_id").groupBy(
            "doc_id").agg(F.avg(F.col("toxic") - F.col("ordinary")).alias("x"), F.max("y").alias("y")).orderBy("doc_id").toPandas()
    slope, offset = curve(known["x"].to_numpy(float), known["y"].to_numpy(float))
    return model, slope, offset


def scored(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs`` (doc_id, text, anything else).

    Texts are scored by their words alone. Null and empty texts have no words and get the score of a text that is
    as likely toxic as ordinary; without labels of both classes all scores are below 0.5. Repeated rows are scored each; a null doc_id
    is not held out. Labels are learned only from documents of the other folds.
    """
    model, slope, offset = fitted(docs, labels, sample_rows)
    score = 1 / (1 + F.exp(-(F.lit(slope) * (F.col("toxic") - F.col("ordinary")) + F.lit(offset))))
    return likelihoods(docs, model).select(
        "doc_id", F.coalesce(fold("doc_id") == HELD_OUT, F.lit(False)).alias("held_out"), score.alias("score"),
        (score >= 0.5).cast("int").alias("predicted"))


def keep_ordinary(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, with the columns of ``docs``.

    Every row is judged by its own text; no other row's verdict counts, whatever their doc_id.
    """
    model, slope, offset = fitted(docs, labels, sample_rows)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            texts = part.column(part.schema.get_field_index("text")).to_pylist()
            found = model.value.likelihoods(texts)
            odds = np.array([slope * (f[2] - f[1]) + offset for f in found])
            with np.errstate(over="ignore"):
                yield part.filter(pa.array(1 / (1 + np.exp(-odds)) < 0.5))

    return docs.mapInArrow(run, docs.schema)
