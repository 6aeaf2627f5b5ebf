"""Language identification by averaged hashed subword embeddings with a linear softmax.

Every word, its A-Z in lower case and between marks for its start and end, gives its byte n-grams of two to four; each is hashed into a bucket
with an embedding. A text is the average over all its n-grams, and a linear layer with softmax turns that into one
probability per language. Embeddings and layer are trained by stochastic gradient descent in numpy on a bounded
sample: at most ``per_language`` labelled documents of each of the ``MAX_LANGUAGES`` most frequent languages, the
ones with the smallest hash of their id. Part of the sample is held out to fit a temperature, so that a probability is
how often it is right. Scoring covers every whole text.

Between languages that it was shown a softmax is sure of itself for any text, so rejection looks at unnormalised
evidence too: the mean log frequency that the text's n-grams have in the sample of the predicted language. A text is
rejected if it falls short of what held-out texts of that language have by more than a limit. The limit is wider for
short texts, whose mean scatters more, and lies between the held-out texts and counter-examples: texts scored with
their own language left out, and texts with their letters shuffled. A language with fewer than ``LEAST_HELD`` held-out
texts has no such limit. ``score`` is the probability times a factor of familiarity: near 1 for a usual text, 0.5 at
the limit.

Nulls: a null text, or one without a letter, is ``und`` with score 0 and rejected; a null ``lang`` is not learned
from; a null ``doc_id`` is never learned from and counts as not held out. Repeated rows get equal predictions. Where
nothing can be learned (an empty table, no labels) every text is ``und``.
"""

from __future__ import annotations

import random
import re
import zlib
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import documents, mixed, slices, words_of

BUCKETS = 1 << 15
DIMENSIONS = 16
SIZES = (2, 3, 4)
PER_LANGUAGE = 400
MAX_LANGUAGES = 100
EPOCHS = 12
BATCH = 32
LEAST_STEPS = 480  # a small sample is gone through more often
RATE = 4.0
LETTER = re.compile(r"[^\W\d_]")
REMEMBERED = 3_000_000  # numbers that a Python worker keeps for words it has seen
SHUFFLED = 5  # one text of so many also gives a counter-example with its letters shuffled
LEAST_HELD = 10
PLACE = 0.6  # of a limit between the held-out texts (0) and the counter-examples (1)
SCATTER = 4.0  # standard errors that a text's mean may be off by its length alone


def subwords(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams of the words, and the word that each belongs to."""
    marked = pc.binary_join_element_wise(pa.scalar("<"), words, pa.scalar(">"), "")
    marked = marked.cast(pa.large_string())
    offsets = np.frombuffer(marked.buffers()[1], np.int64)[marked.offset : marked.offset + len(marked) + 1]
    data = np.frombuffer(marked.buffers()[2], np.uint8)[offsets[0] : offsets[-1]].astype(np.uint64)
    word = np.repeat(np.arange(len(words)), np.diff(offsets))
    buckets, owners = [], []
    gram = data.copy()
    for n in range(2, max(SIZES) + 1):
        gram = gram[:-1] * np.uint64(257) + data[n - 1 :] + np.uint64(1) if len(gram) > 1 else gram[:0]
        inside = word[: len(gram)] == word[n - 1 :] if len(gram) else np.zeros(0, bool)
        buckets.append((mixed(gram[inside] + np.uint64(n << 40)) % np.uint64(BUCKETS)).astype(np.int32))
        owners.append(word[: len(gram)][inside])
    return np.concatenate(buckets), np.concatenate(owners)


class Familiarity(NamedTuple):
    """By bucket and language the log frequency ``known``; by language the ``typical`` mean of a text, the ``scatter`` of
    one n-gram's share in it, and how far below a text may lie beyond that scatter (``slack``, infinite: anything)."""

    known: np.ndarray
    typical: np.ndarray
    scatter: np.ndarray
    slack: np.ndarray

    def excess(self, means: np.ndarray, counts: np.ndarray, of: np.ndarray) -> np.ndarray:
        """How far texts lie below the typical mean of language ``of``, beyond their scatter by length."""
        return self.typical[of] - means - SCATTER * self.scatter[of] / np.sqrt(np.maximum(counts, 1))

    def factor(self, means: np.ndarray, counts: np.ndarray, of: np.ndarray) -> np.ndarray:
        """0.5 at the limit, towards 1 above it and 0 below it."""
        slack = self.slack[of]
        limited = np.isfinite(slack)
        room = np.where(limited, slack, 1.0)
        over = (self.excess(means, counts, of) - room) / np.maximum(room / 4, 0.02)
        return np.where(limited, 1 / (1 + np.exp(np.clip(over, -50, 50))), 1.0)


class Model:
    """Languages, the weight of each bucket for each language (embedding times layer), bias, temperature."""

    def __init__(self, languages: list[str], weights: np.ndarray, bias: np.ndarray, familiarity: Familiarity):
        self.languages, self.weights, self.bias, self.familiarity = languages, weights, bias, familiarity
        self.temperature, self.least = 1.0, 0.0

    def logits(self, means: np.ndarray) -> np.ndarray:
        return (means + self.bias) / self.temperature

    def probabilities(self, means: np.ndarray) -> np.ndarray:
        logits = self.logits(means)
        logits -= logits.max(axis=1, keepdims=True)
        powers = np.exp(logits)
        return powers / powers.sum(axis=1, keepdims=True)

    def score(self, texts: pa.Array, memory: dict) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Predicted language, score and rejection of each text (null: empty). ``memory`` keeps sums of known words."""
        words, rows = words_of(pc.fill_null(texts, ""))
        coded = words.dictionary_encode()
        names = coded.dictionary.to_pylist()
        n = len(self.languages)
        if len(memory) * (2 * n + 1) > REMEMBERED:
            memory.clear()
        new = [w for w in names if w not in memory]
        if new:
            buckets, owner = subwords(pa.array(new, pa.string()))
            order = np.argsort(owner, kind="stable")
            starts = np.searchsorted(owner[order], np.arange(len(new)))
            each = np.concatenate([self.weights, self.familiarity.known], axis=1)[buckets[order]]
            counts = np.bincount(owner, minlength=len(new))
            sums = np.column_stack([np.add.reduceat(each, starts, axis=0), counts]).astype(np.float64)
            memory.update(zip(new, map(np.ndarray.tobytes, sums), strict=True))  # a list of numbers takes three times as much
        by_word = np.frombuffer(b"".join([memory[w] for w in names]), np.float64).reshape(len(names), 2 * n + 1)
        each = by_word[coded.indices.to_numpy(zero_copy_only=False)]
        total = np.zeros((len(texts), each.shape[1]))
        if len(each):
            first = np.nonzero(np.append(True, rows[1:] != rows[:-1]))[0]
            total[rows[first]] = np.add.reduceat(each, first, axis=0)
        counts = total[:, -1]
        total = total[:, :-1] / np.maximum(counts, 1)[:, None]
        found = self.probabilities(total[:, :n])
        best, at = found.argmax(axis=1), np.arange(len(texts))
        factor = self.familiarity.factor(total[at, n + best], counts, best)
        rejected = (factor < 0.5) | (found[at, best] < self.least)
        return [self.languages[i] for i in best], found[at, best] * factor, rejected


def learnable() -> Column:
    """Not held out: the checksum of the id's digits leaves another remainder than 1."""
    return F.crc32(F.col("doc_id").cast("string")) % 3 != 1


def sample(docs: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """``lang`` and ``text`` of at most ``per_language`` documents of each language: those with the smallest hashes.

    The languages are counted first, so that all but a little more than the sample is cut off before the shuffle.
    """
    labelled = docs.select("doc_id", "text", "lang").where(learnable() & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = labelled.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MAX_LANGUAGES).collect()
    if not counts:
        return labelled.select("lang", "text").limit(0)
    shares = F.create_map(*[x for r in counts for x in (F.lit(r["lang"]), F.lit(min(1.0, 2.0 * per_language / r["count"] + 50 / r["count"])))])
    key = F.xxhash64("doc_id", F.lit("sample"))
    near = labelled.where(F.pmod(key, F.lit(1 << 30)) < F.element_at(shares, F.col("lang")) * (1 << 30))
    order = Window.partitionBy("lang").orderBy(F.pmod(key, F.lit(1 << 30)), "doc_id", "text")
    return near.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= per_language).select("lang", "text")


def _bag(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the text's n-grams and how often each occurs."""
    words, _ = words_of(pa.array([text], pa.string()))
    if not len(words):
        return np.zeros(0, np.int32), np.zeros(0, np.int32)
    buckets, counts = np.unique(subwords(words)[0], return_counts=True)
    return buckets.astype(np.int32), counts.astype(np.int32)


def _shuffled(text: str) -> str:
    """The text with its letters dealt anew over their places."""
    letters = LETTER.findall(text)
    random.Random(zlib.crc32(text.encode())).shuffle(letters)
    dealt = iter(letters)
    return LETTER.sub(lambda _: next(dealt), text)


FEATURES = "lang string, key bigint, shuffled boolean, buckets array<int>, counts array<int>"


def _features(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
            key = zlib.crc32(text.encode())
            rows.append((lang, key, False, *_bag(text)))
            if key % SHUFFLED == 0:
                rows.append((lang, key, True, *_bag(_shuffled(text))))
        kinds = [pa.string(), pa.int64(), pa.bool_(), pa.list_(pa.int32()), pa.list_(pa.int32())]
        columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
        yield pa.RecordBatch.from_arrays(columns, ["lang", "key", "shuffled", "buckets", "counts"])


class Bag(NamedTuple):
    lang: str
    buckets: np.ndarray
    counts: np.ndarray
    weights: np.ndarray  # the counts' shares


def _bags(rows: pa.Table, shuffled: bool) -> list[Bag]:
    """The bags of usual or of shuffled texts that are not empty, in an order that does not depend on tasks. Their
    buckets and counts are views of the table, not copies."""
    found = []
    for r in np.nonzero(rows.column("shuffled").to_numpy() == shuffled)[0].tolist():
        buckets, counts = (rows.column(c)[r].values.to_numpy() for c in ("buckets", "counts"))
        if len(buckets):
            key = (rows.column("lang")[r].as_py(), rows.column("key")[r].as_py(), len(buckets))
            found.append((key, Bag(key[0], buckets, counts, (counts / counts.sum()).astype(np.float32))))
    return [bag for _, bag in sorted(found, key=lambda f: f[0])]


def train(docs: DataFrame, per_language: int = PER_LANGUAGE) -> Model | None:
    """The model; None if no document can be learned from."""
    table = sample(docs, per_language).mapInArrow(_features, FEATURES).toArrow()
    rows, noise = _bags(table, False), _bags(table, True)
    if not rows:
        return None
    languages = sorted({r.lang for r in rows})
    generator = np.random.default_rng(7)
    bags = [rows[i] for i in generator.permutation(len(rows))]
    target = np.array([languages.index(b.lang) for b in bags])
    held = max(1, len(bags) // 5) if len(bags) >= 10 else 0
    embed = generator.normal(0, 0.1, (BUCKETS, DIMENSIONS)).astype(np.float32)
    layer = np.zeros((DIMENSIONS, len(languages)), np.float32)
    layer += generator.normal(0, 0.1, layer.shape).astype(np.float32)
    bias = np.zeros(len(languages), np.float32)

    def dense(these: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        used, at = np.unique(np.concatenate([bags[i].buckets for i in these]), return_inverse=True)
        matrix = np.zeros((len(these), len(used)), np.float32)
        row = np.repeat(np.arange(len(these)), [len(bags[i].buckets) for i in these])
        matrix[row, at] = np.concatenate([bags[i].weights for i in these])
        return used, matrix

    learned = np.arange(held, len(bags))
    epochs = max(EPOCHS, -(-LEAST_STEPS * BATCH // len(learned)))
    for epoch in range(epochs):
        rate = RATE * (1 - epoch / epochs)
        generator.shuffle(learned)
        for at in range(0, len(learned), BATCH):
            these = learned[at : at + BATCH]
            used, matrix = dense(these)
            hidden = matrix @ embed[used]
            logits = hidden @ layer + bias
            logits -= logits.max(axis=1, keepdims=True)
            error = np.exp(logits)
            error /= error.sum(axis=1, keepdims=True)
            error[np.arange(len(these)), target[these]] -= 1
            error /= len(these)
            back = error @ layer.T
            layer -= rate * hidden.T @ error
            bias -= rate * 0.1 * error.sum(axis=0)
            embed[used] -= rate * 20 * (matrix.T @ back)
    often = np.full((BUCKETS, len(languages)), 0.1)
    for i in learned:
        often[bags[i].buckets, target[i]] += bags[i].counts
    none = np.zeros(len(languages))
    familiarity = Familiarity(np.log(often / often.sum(axis=0)), none, none, none + np.inf)
    model = Model(languages, (embed @ layer).astype(np.float64), bias.astype(np.float64), familiarity)
    if held:
        _calibrate(model, bags[:held], target[:held])
        model.familiarity = _limits(model, bags[:held], target[:held], noise)
    return model


def _means(table: np.ndarray, bags: list[Bag]) -> np.ndarray:
    return np.array([b.weights.astype(np.float64) @ table[b.buckets] for b in bags]).reshape(len(bags), table.shape[1])


def _calibrate(model: Model, bags: list[Bag], target: np.ndarray) -> None:
    """The temperature with the least log loss, and the probability that nearly all right predictions reach.

    Where all held-out texts are right, any sharper temperature would do; so, as usual for such fits, each label is
    taken to be wrong once in as many texts as were seen and two more."""
    means = _means(model.weights, bags)
    at, wrong = np.arange(len(target)), 1 / (len(target) + 2)

    def loss(temperature: float) -> float:
        model.temperature = temperature
        logs = np.log(model.probabilities(means) + 1e-300)
        right = logs[at, target]
        others = (logs.sum(axis=1) - right) / max(1, logs.shape[1] - 1)
        return -((1 - wrong) * right + wrong * others).mean()

    model.temperature = min(np.geomspace(0.01, 100, 161), key=loss)
    found = model.probabilities(means)
    right = found.argmax(axis=1) == target
    lowest = np.quantile(found.max(axis=1)[right], 0.001) if right.any() else 0.0
    model.least = float(min(0.5, lowest))


def _limits(model: Model, bags: list[Bag], target: np.ndarray, noise: list[Bag]) -> Familiarity:
    """Typical means, scatter and slack of each language, from held-out texts and counter-examples."""
    known = model.familiarity.known
    means, counts = _means(known, bags), np.array([b.counts.sum() for b in bags])
    n = len(model.languages)
    typical, scatter, slack = np.zeros(n), np.zeros(n), np.full(n, np.inf)
    own = [np.nonzero(target == i)[0] for i in range(n)]
    for i in range(n):
        if len(own[i]) >= LEAST_HELD:
            typical[i] = np.median(means[own[i], i])
            away = np.abs(means[own[i], i] - typical[i]) * np.sqrt(counts[own[i]])
            scatter[i] = np.median(away) / 0.6745  # the standard deviation, if it is normal
    found = Familiarity(known, typical, scatter, slack)

    logits = model.logits(_means(model.weights, bags))
    logits[np.arange(len(bags)), target] = -np.inf  # its own language left out
    taken = logits.argmax(axis=1)
    others = _means(known, noise)
    of_noise = model.logits(_means(model.weights, noise)).argmax(axis=1) if noise else np.zeros(0, int)
    of_counts = np.array([b.counts.sum() for b in noise])
    for i in range(n):
        if len(own[i]) < LEAST_HELD:
            continue
        usual = np.quantile(found.excess(means[own[i], i], counts[own[i]], np.full(len(own[i]), i)), 0.95)
        usual = max(usual, 0.0)
        left = np.nonzero(taken == i)[0] if n > 1 else np.zeros(0, int)
        shuffled = np.nonzero(of_noise == i)[0]
        strange = np.concatenate([
            found.excess(means[left, i], counts[left], np.full(len(left), i)),
            found.excess(others[shuffled, i], of_counts[shuffled], np.full(len(shuffled), i)),
        ])
        lowest = np.quantile(strange, 0.1) if len(strange) else usual
        if lowest > usual:
            slack[i] = usual + PLACE * (lowest - usual)
    return found


def annotate(docs: DataFrame, model: Model | None) -> DataFrame:
    """``row`` (all columns of the input), ``lang_pred``, ``score`` and ``rejected``."""
    out = T.StructType([T.StructField("row", docs.schema), *T._parse_datatype_string("lang_pred string, score double, rejected boolean")])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory: dict = {}
        for batch in batches:
            for some in slices(batch, "text"):
                texts = some.column("text")
                unknown = ["und"] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
                names, scores, rejected = model.score(texts, memory) if model else unknown
                plain = [t is None or LETTER.search(t) is None for t in texts.to_pylist()]
                names = ["und" if p else n for n, p in zip(names, plain, strict=True)]
                scores = np.where(plain, 0.0, scores)
                rejected = pa.array(rejected | np.array(plain, bool))
                yield pa.RecordBatch.from_arrays(
                    [some.column("row"), pa.array(names, pa.string()), pa.array(scores), rejected],
                    ["row", "lang_pred", "score", "rejected"],
                )

    return docs.select(F.struct("*").alias("row"), "text").mapInArrow(run, out)


def keep_identified(docs: DataFrame) -> DataFrame:
    """The documents whose language is told with enough certainty, with the input's columns."""
    return annotate(docs, train(docs)).where("NOT rejected").select("row.*")


def op9_language_subwords(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    found = annotate(docs.select("doc_id", "text"), train(docs))
    held_out = F.coalesce(F.crc32(F.col("row.doc_id").cast("string")) % 3 == 1, F.lit(False))
    return found.select("row.doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")
