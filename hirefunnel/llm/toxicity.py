"""Toxicity by subword-bag embeddings averaged into a linear softmax.

A word is the bag of its character n-grams (with marks for its ends) and itself, hashed into a
fixed number of buckets; a word's vector is the average over its bag. Only buckets whose share of
texts differs between the labels by at least `least_z` standard errors in `least` texts, or so much
that less than one n-gram in all would by chance, have a vector, the others count as nothing, so that
chance n-grams of a few texts are not learnt by heart. A text is the
average of its words' vectors, each word weighing as much as the share of its bag that has a
vector; so a few rude words are not thinned out by a long text. A linear softmax gives the
probability. Vectors and softmax are trained together, so an unseen misspelling shares most vectors
with the word it comes from.

Training reads at most `most` labelled rows of each label, those with the smallest hash of their
id: a documented bound, 4,000 by default, so that what the driver trains on does not grow. Their
whole texts stay in the tasks: buckets are counted by label there, added up by bucket and held
against each other where they are; the driver gets the telling buckets, then for each text the
shares of those it has, and so never more than (texts) x (telling buckets) numbers, however long
the texts are. Only rows whose crc32(id as text) mod 5 is not 0 are learnt from. Scoring covers every row and whole
texts. Since the model is linear in the average, a word's share of the score is one number, which
is computed once per worker and kept up to a fixed number of words.

Words are lower-cased runs of anything but blanks and ASCII punctuation. Texts without words, null
ones too, are scored by the bias alone, and by nothing if no label could be learnt (0.0). Rows that
repeat an id come back as often; labels without a document or with nulls are left out; an empty
table gives no rows. Other columns, labels' included, are never read for a score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirefunnel.llm.common import each_batch, sized_slices, stored, texts_of

BUCKETS = 1 << 21
DIMENSIONS = 8
NGRAMS = (3, 4, 5, 6)
MOST = 4000
#: An n-gram differs between the labels in so many texts, by so many standard errors.
LEAST, LEAST_Z = 10, 5.0
#: Words of nothing that every average also counts, so that a word or two decide little.
NEUTRAL = 2
CACHED = 1 << 19
_PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_TABLE = bytes.maketrans(_PUNCTUATION.encode(), b" " * len(_PUNCTUATION))


def words_of(text: bytes) -> list[bytes]:
    """Distinct words in order of their first place: repeating one makes a text no more toxic."""
    return list(dict.fromkeys(text.translate(_TABLE).lower().split()))


def bag(word: bytes) -> list[int]:
    """Buckets of a word's n-grams and of the word itself."""
    marked = b"<" + word + b">"
    n = len(marked)
    grams = [crc32(marked[i : i + k]) for k in NGRAMS for i in range(n - k + 1)]
    grams.append(crc32(marked, 1))
    return [g % BUCKETS for g in grams]


@dataclass(frozen=True)
class Model:
    """weight: share of the log odds of each bucket that has a vector, of BUCKETS at most;
    bias: the log odds of a text without any of them."""

    weight: dict[int, float]
    bias: float


class Scorer(dict):
    """Log odds and weight by word, computed when first met; None where both are 0."""

    def __init__(self, model: Model) -> None:
        super().__init__()
        self.weight, self.bias = model.weight, model.bias

    def __missing__(self, word: bytes) -> tuple[float, float] | None:
        own = bag(word)
        hits = [self.weight[g] for g in own if g in self.weight]
        value = (sum(hits) / len(own), len(hits) / len(own)) if hits else None
        if len(word) <= 64:
            if len(self) >= CACHED:
                self.clear()
            self[word] = value
        return value

    def score(self, text: bytes) -> float:
        found = [v for v in map(self.__getitem__, words_of(text)) if v]
        odds = self.bias + sum(v for v, _ in found) / (sum(n for _, n in found) + NEUTRAL)
        return float(1 / (1 + np.exp(-np.clip(odds, -60, 60))))


def counts(bags: list[np.ndarray], labels: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets, how many texts have each, and how many of these are toxic. Bags are distinct buckets."""
    if not bags:
        return (np.empty(0, np.int64),) * 3
    buckets, at = np.unique(np.concatenate(bags), return_inverse=True)
    mark = np.repeat(np.array(labels, np.float64), [len(b) for b in bags])
    total = np.bincount(at, minlength=len(buckets))
    return buckets, total, np.bincount(at, mark, len(buckets)).astype(np.int64)


def telling(
    total: np.ndarray, rude: np.ndarray, n1: int, n0: int, some: int, least: int, least_z: float
) -> np.ndarray:
    """Which buckets' shares of the two labels' texts differ clearly: in `least` texts and by
    `least_z` standard errors, or beyond chance however few texts there are. `some` buckets occur
    in more than one text."""
    share = total / (n0 + n1)
    error = np.sqrt(share * (1 - share) * (1 / n0 + 1 / n1))
    difference = np.abs(rude / n1 - (total - rude) / n0)
    out = (total >= least) & (difference >= least_z * error) & (error > 0)
    # Standard errors say little of a few texts, so rare n-grams are held against the exact chance.
    more = total > 1
    if more.any():
        out[more] |= by_chance(rude[more], total[more], n1, n0) * some <= 1
    return out


def by_chance(rude: np.ndarray, total: np.ndarray, n1: int, n0: int) -> np.ndarray:
    """The chance that of `total` texts, drawn from n1 toxic and n0 clean ones, as many or more than
    `rude` are toxic, or as many or fewer if that is less likely."""
    factorial = np.concatenate([[0.0], np.cumsum(np.log(np.arange(1, n1 + n0 + 1)))])

    def choose(n: int, k: np.ndarray) -> np.ndarray:
        return factorial[n] - factorial[k] - factorial[n - k]

    pairs, where = np.unique(np.stack([rude, total], 1).astype(np.int64), axis=0, return_inverse=True)
    out = np.empty(len(pairs))
    for i, (r, c) in enumerate(pairs.tolist()):
        k = np.arange(max(0, c - n0), min(c, n1) + 1)
        share = np.exp(choose(n1, k) + choose(n0, c - k) - choose(n1 + n0, np.array(c)))
        out[i] = min(share[k >= r].sum(), share[k <= r].sum())
    return out[where.ravel()]


class Bags(dict):
    """Distinct buckets of a word, computed when first met; kept up to a fixed number of words."""

    def __missing__(self, word: bytes) -> np.ndarray:
        own = np.array(bag(word))
        if len(word) <= 64:
            if len(self) >= CACHED >> 3:
                self.clear()
            self[word] = own
        return own

    def text(self, text: bytes) -> np.ndarray:
        """Distinct buckets of a text, a limited number of words at a time."""
        words, out = words_of(text), np.empty(0, np.int64)
        for k in range(0, len(words), 4096):
            out = np.unique(np.concatenate([out, *map(self.__getitem__, words[k : k + 4096])]))
        return out

    def shares(self, text: bytes, seen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in `seen` (ascending buckets) of those that a text has, and the share of each."""
        index, part, weight = [], [], float(NEUTRAL)
        for word in words_of(text):
            own = self[word]
            at = np.searchsorted(seen, own)
            at = at[seen[np.minimum(at, len(seen) - 1)] == own] if len(seen) else at[:0]
            if len(at):
                index.append(at)
                part.append(np.full(len(at), 1 / len(own)))
                weight += len(at) / len(own)
        if not index:
            return np.empty(0, np.int64), np.empty(0, np.float32)
        unique, at = np.unique(np.concatenate(index), return_inverse=True)
        return unique, (np.bincount(at, np.concatenate(part)) / weight).astype(np.float32)


#: Score of a text where no label, or one label only, was there to learn from.
CLEAN, TOXIC = Model({}, -60.0), Model({}, 60.0)


def train(texts: list[bytes], labels: list[int], least: int = LEAST, least_z: float = LEAST_Z, **options) -> Model:
    """What `learnt` does with tables, for a few texts at hand."""
    n1 = sum(labels)
    n0 = len(labels) - n1
    if not n1 or not n0:
        return TOXIC if n1 else CLEAN
    bags = Bags()
    buckets, total, rude = counts([bags.text(t) for t in texts], labels)
    seen = buckets[telling(total, rude, n1, n0, int((total > 1).sum()), least, least_z)]
    index, share = zip(*[bags.shares(t, seen) for t in texts], strict=True)
    return fit(seen, list(index), list(share), labels, **options)


def fit(
    seen: np.ndarray,
    index: list[np.ndarray],
    share: list[np.ndarray],
    labels: list[int],
    epochs: int = 30,
    rate: float = 0.05,
    batch: int = 256,
    decay: float = 0.001,
    seed: int = 7,
) -> Model:
    """Adam on the cross entropy of texts given by the places and shares of their telling buckets;
    a toxic text missed weighs twice."""
    y, n = np.array(labels, np.float64), len(seen)
    rng = np.random.default_rng(seed)
    vectors = rng.normal(0, 0.1, (n, DIMENSIONS)).astype(np.float32)
    softmax = rng.normal(0, 0.1, DIMENSIONS).astype(np.float32)  # of label 1 against label 0
    bias = 0.0
    state = [[np.zeros_like(v), np.zeros_like(v)] for v in (vectors, softmax, np.zeros(1, np.float32))]
    step = 0

    def adam(k: int, gradient: np.ndarray) -> np.ndarray:
        m, v = state[k]
        m += 0.1 * (gradient - m)
        v += 0.001 * (gradient * gradient - v)
        return rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)

    for _ in range(epochs):
        order = rng.permutation(len(y))
        for at in range(0, len(y), batch):
            step += 1
            rows = order[at : at + batch]
            cols = np.concatenate([index[r] for r in rows])
            part = np.concatenate([share[r] for r in rows])
            doc = np.repeat(np.arange(len(rows)), [len(index[r]) for r in rows])
            weighted = vectors[cols] * part[:, None]
            mean = np.stack([np.bincount(doc, weighted[:, d], len(rows)) for d in range(DIMENSIONS)], 1)
            odds = np.clip(mean @ softmax + bias, -30, 30)
            wrong = (1 / (1 + np.exp(-odds)) - y[rows]) * (1 + y[rows]) / len(rows)
            back = wrong[doc] * part
            summed = np.bincount(cols, back, n).astype(np.float32)
            change = adam(0, summed[:, None] * softmax)
            softmax = softmax - adam(1, (wrong @ mean).astype(np.float32))
            vectors *= 1 - decay
            vectors -= change
            bias -= float(adam(2, np.array([wrong.sum()], np.float32))[0])
    weight = (vectors @ softmax).tolist()
    return Model(dict(zip(seen.tolist(), weight, strict=True)), bias)


def held_out(id_col: Column) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def sample(documents: DataFrame, labels: DataFrame, most: int = MOST) -> DataFrame:
    """label and text of at most `most` labelled rows of each label, the same ones on every run,
    with `place`, which orders them."""
    usable = labels.where(~held_out(F.col("doc_id")) & F.col("toxic").isNotNull()).select(
        F.col("doc_id").alias("id"), (F.col("toxic") != 0).cast("int").alias("label")
    )
    order = [F.xxhash64("id"), F.col("id"), F.col("label")]
    chosen = usable.where("label = 1").orderBy(*order).limit(most).unionByName(
        usable.where("label = 0").orderBy(*order).limit(most)
    )
    # At most 2 * most ids: the bound that makes this broadcast safe.
    texts = documents.select(F.col("doc_id").alias("id"), F.col("text").cast("string").alias("text"))
    place = F.struct("id", "label", F.sha2("text", 256)).alias("place")
    rows = texts.join(F.broadcast(chosen), "id").select(place, "label", "text")
    return stored(rows, "toxicity-sample")


def learnt(rows: DataFrame, least: int = LEAST, least_z: float = LEAST_Z, **options) -> Model:
    """The model of the texts of `sample`."""
    n, n1 = rows.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first()
    n0 = n - n1
    if not n1 or not n0:
        return TOXIC if n1 else CLEAN

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bags = Bags()
        for batch in batches:
            texts, marks = texts_of(batch), batch.column(0).to_pylist()
            # Some texts at a time, so that their bags are not all held at once.
            for a, b in sized_slices([len(t) for t in texts], 1 << 20):
                found = counts([bags.text(t) for t in texts[a:b]], marks[a:b])
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in found], ["bucket", "total", "rude"])

    found = rows.select("label", "text").mapInArrow(count, "bucket long, total long, rude long")
    summed = found.groupBy("bucket").agg(F.sum("total").alias("total"), F.sum("rude").alias("rude"))
    # At most BUCKETS rows.
    summed = stored(summed.where("total > 1"), "toxicity-buckets")
    some = summed.count()

    def tell(batch: pa.RecordBatch) -> pa.RecordBatch:
        bucket, total, rude = (c.to_numpy() for c in batch.columns)
        chosen = bucket[telling(total, rude, n1, n0, some, least, least_z)]
        return pa.RecordBatch.from_arrays([pa.array(chosen)], ["bucket"])

    # A bucket of one text tells nothing: one text is never beyond chance, nor `least` texts.
    told = each_batch(summed.select("bucket", "total", "rude"), tell, "bucket long").toArrow()
    seen = np.sort(told.column(0).to_numpy())

    def shares(batch: pa.RecordBatch) -> pa.RecordBatch:
        bags = Bags()
        index, share = zip(*[bags.shares(t, seen) for t in texts_of(batch)], strict=True)
        columns = [
            batch.column(0),
            batch.column(1),
            pa.array([i.astype(np.int32) for i in index], pa.list_(pa.int32())),
            pa.array(list(share), pa.list_(pa.float32())),
        ]
        return pa.RecordBatch.from_arrays(columns, ["place", "label", "at", "share"])

    made = each_batch(
        rows.select("place", "label", "text"),
        shares,
        f"place {rows.schema['place'].dataType.simpleString()}, label int, at array<int>, share array<float>",
    )
    # A row per text of the sample, with numbers of its telling buckets only.
    sparse = made.orderBy("place").select("label", "at", "share").toArrow().combine_chunks()
    index, share = (
        [np.asarray(v) for v in np.split(c.flatten().to_numpy(), c.offsets.to_numpy()[1:-1])]
        for c in (sparse.column(k).chunk(0) for k in (1, 2))
    )
    return fit(seen, index, share, sparse.column(0).to_pylist(), **options)


def scored(documents: DataFrame, labels: DataFrame, most: int = MOST) -> DataFrame:
    """doc_id, held_out, score, predicted for every document."""
    model = documents.sparkSession.sparkContext.broadcast(learnt(sample(documents, labels, most)))
    source = documents.select(
        F.col("doc_id").cast("long").alias("id"),
        held_out(F.col("doc_id")).alias("held_out"),
        F.col("text").cast("string").alias("text"),
    )
    scorers: list[Scorer] = []

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not scorers:
            scorers.append(Scorer(model.value))
        own = scorers[0]
        scores = [own.score(t) for t in texts_of(batch)]
        columns = [batch.column(0), batch.column(1), pa.array(scores, pa.float64())]
        columns.append(pa.array([int(s >= 0.5) for s in scores], pa.int32()))
        return pa.RecordBatch.from_arrays(columns, names=["id", "held_out", "score", "predicted"])

    made = each_batch(source, make, "id long, held_out boolean, score double, predicted int")
    return made.withColumnRenamed("id", "doc_id")
