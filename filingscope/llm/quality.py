"""Quality rules by distribution divergence, in DataFrame and SQL functions only.

A document's histogram of character classes and its histogram of common words are compared with those of each
reference language by the Jensen-Shannon distance (base 2, so 0 to 1). A document goes if even the nearest
language is too far. A short text is a small sample, whose distance is larger by chance: its square grows with one
over the length. So below a length each limit widens in the same way; texts of every length are compared.
The references are the pooled histograms of all documents of a language. Those of languages with
one percent of the documents or more (at most a hundred) hold for every document; that of a rarer language with enough
words is joined to the documents of that language alone, so that a rare label of junk admits no other document. A
document whose language has no reference has null distances and stays.

Nulls: a null text has no words and fails the base rule; a null ``lang`` counts for no reference and the row is
judged by those that hold for every document; an empty table gives an empty result. Every row is judged alone: repeated rows get equal
verdicts.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, written

# Frequent function words of the reference languages, in natural order.
COMMON_WORDS = {
    "en": "the of and to in a is that was for it on are as with by at be this from or an not but which".split(),
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an er".split(),
    "fr": "de la le et les des en un du une que est pour qui dans par plus au sur ne pas il se ce".split(),
    "es": "de la que el en y los se del las un por con no una su para es al lo como más o pero".split(),
}

WORD_GAP = r"[\x20\x09-\x0D]+"
CHAR_LENGTH = 400
WORD_LENGTH = 150
MAX_CHAR_DISTANCE = 0.26  # from CHAR_LENGTH characters on
MAX_WORD_DISTANCE = 0.285  # from WORD_LENGTH words on
# What the square of a distance spreads by, times the length: between the highest distances of clean shorter texts.
CHAR_SPREAD = 30.0
WORD_SPREAD = 3.0
LEAST_SHARE = 0.01
LEAST_WORDS = 2000  # of a rarer language: its own sampling adds less than 0.1 to a distance, in squares
RUN = 5

#: Character classes that are counted. Further ones: bytes beyond the first of a character, white space, the rest.
CLASSES = {"upper": "[A-Z]", "digit": "[0-9]", "mark": "[.,;:!?'\"()-]", "symbol": "[#*$%&|<>]"}
N_CLASSES = len(CLASSES) + 3


def features(docs: DataFrame, common_words: dict[str, list[str]] = COMMON_WORDS) -> DataFrame:
    """The base counts and the two histograms of each document, beside ``_row`` (all columns of the input).

    ``_chars`` has the counts by character class, ``_common`` the common words (places in the
    sorted list of all of them) and their counts, ``_n_common`` their
    sum. Each step that loops over words holds a lambda, so Spark compiles it into small methods that the JVM
    optimises; as one large whole-stage method the same expressions take four times as long.
    """
    text = F.col("_text")
    vocabulary = F.array(*[F.lit(w) for w in _vocabulary(common_words)])
    rows = docs.select(F.struct("*").alias("_row"), F.coalesce("text", F.lit("")).alias("_text"))
    rows = rows.withColumn("_split", F.split(text, WORD_GAP))
    gaps = (F.get("_split", F.lit(0)) == "") | (F.element_at("_split", -1) == "")
    words = F.when(gaps, F.filter("_split", lambda w: w != "")).otherwise(F.col("_split"))
    rows = rows.select("_row", "_text", words.alias("_words"))

    count = F.greatest(F.lit(0), F.size("_words") - (RUN - 1))
    windows = F.transform(
        F.slice("_words", F.lit(1), count),
        lambda w, i: F.xxhash64(w, *[F.get(F.col("_words"), i + k) for k in range(1, RUN)]),
    )
    hits = F.filter("_words", lambda w: F.lower(w).isin(_vocabulary(common_words)))
    rows = rows.select(
        "_row",
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        windows.alias("_windows"),
        F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")).alias("_lines"),
        F.sort_array(F.transform(hits, lambda w: F.lower(w))).alias("_hits"),  # noqa: PLW0108
        F.length(text).cast("long").alias("_length"),
        (F.octet_length(text) - F.length(text)).cast("long").alias("_beyond"),
        *[F.regexp_count(text, F.lit(p)).cast("long").alias(f"_{k}") for k, p in CLASSES.items()],
    )

    pairs = F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    inside = [*[F.col(f"_{k}") for k in CLASSES], F.col("_beyond"), F.col("_length") - F.col("word_chars")]
    classes = [*inside, F.greatest(F.lit(0), F.col("_length") - sum(inside[1:], inside[0]))]
    change = lambda w, i: F.when(~w.eqNullSafe(F.get(F.col("_hits"), i - 1)), i)
    rows = rows.select(
        *("_row", "n_words", "word_chars", F.col("_symbol").alias("n_symbols"), "_length", "_hits"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.size(F.array_distinct("_windows")) < F.size("_windows"), pairs).alias("_pairs"),
        F.array(*[c.cast("double") for c in classes]).alias("_chars"),
        F.filter(F.transform("_hits", change), lambda i: i.isNotNull()).alias("_starts"),
    )

    hash_at = lambda k: F.get(F.col("_pairs"), k)["h"]
    repeated = F.transform(
        F.col("_pairs"),
        lambda x, k: F.when(x["h"].eqNullSafe(hash_at(k - 1)) | x["h"].eqNullSafe(hash_at(k + 1)), x["i"]),
    )
    common_counts = F.transform(
        F.col("_starts"),
        lambda s, k: F.struct(
            F.array_position(vocabulary, F.get(F.col("_hits"), s)).alias("word"),
            (F.coalesce(F.get(F.col("_starts"), k + 1), F.size("_hits")) - s).cast("double").alias("n"),
        ),
    )
    rows = rows.select(
        *("_row", "n_words", "word_chars", "n_symbols", "n_dup_lines", "_length", "_chars"),
        F.size("_hits").alias("_n_common"),
        common_counts.alias("_common"),
        F.sort_array(F.array_compact(repeated)).alias("_repeats"),
    )
    covered = F.aggregate(
        F.transform(
            F.col("_repeats"),
            lambda s, k: F.least(F.lit(RUN), F.coalesce(F.get(F.col("_repeats"), k + 1) - s, F.lit(RUN))),
        ),
        F.lit(0),
        lambda total, x: total + x,
    )
    rows = rows.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop("_repeats")
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return rows.withColumn("base_failed", failed)


def _vocabulary(common_words: dict[str, list[str]]) -> list[str]:
    return sorted({w for words in common_words.values() for w in words})


class References(NamedTuple):
    """``common``: by language, the shares of the character classes and of the common words. ``rare``: the same as a
    table of ``_lang``, ``_own_chars`` and ``_own_words``."""

    common: dict[str, tuple[list[float], list[float]]]
    rare: DataFrame


def references(rows: DataFrame, n_words: int) -> References:
    """Per language the shares of the character classes, and those of the common words (the rest is no word).

    ``rows`` has ``lang``, ``n_words``, ``_chars`` and ``_common`` of all documents; ``n_words`` is the number of
    common words. At most a hundred languages come to the driver, each with a fixed number of shares.
    """
    marked = lambda place, n: F.struct(F.lit(place).cast("long").alias("word"), n.cast("double").alias("n"))
    marks = [marked(-i, F.get("_chars", F.lit(i))) for i in range(N_CLASSES)]
    marks += [marked(-N_CLASSES, F.lit(1)), marked(-N_CLASSES - 1, F.col("n_words"))]
    labelled = rows.where("lang IS NOT NULL")
    bins = labelled.select("lang", F.explode(F.concat("_common", F.array(*marks))).alias("bin"))
    sums = bins.groupBy("lang", F.col("bin.word").alias("word")).agg(F.sum("bin.n").alias("n"))
    of = lambda key: F.coalesce(F.element_at("sums", F.lit(key).cast("long")), F.lit(0.0))
    by_lang = sums.groupBy("lang").agg(F.map_from_entries(F.collect_list(F.struct("word", "n"))).alias("sums"))
    by_lang = written(by_lang.withColumns({"docs": of(-N_CLASSES), "words": of(-N_CLASSES - 1)}), "quality-references")
    least = LEAST_SHARE * float(by_lang.agg(F.sum("docs")).first()[0] or 0)
    result = {}
    for r in by_lang.where(F.col("docs") >= least).collect():
        n = r["sums"]
        chars, words = [n[-i] for i in range(N_CLASSES)], n[-N_CLASSES - 1]
        if words and sum(chars):
            result[r["lang"]] = ([c / sum(chars) for c in chars], [n.get(i + 1, 0.0) / words for i in range(n_words)])
    chars = [of(-i) for i in range(N_CLASSES)]
    rare = by_lang.where((F.col("docs") < least) & (F.col("words") >= LEAST_WORDS)).select(
        F.col("lang").alias("_lang"),
        F.array(*[c / sum(chars[1:], chars[0]) for c in chars]).alias("_own_chars"),
        F.array(*[of(i + 1) / F.col("words") for i in range(n_words)]).alias("_own_words"),
    )
    return References(dict(sorted(result.items())), rare)


def _half(p: Column, q: Column) -> Column:
    """One bin's part of the Jensen-Shannon divergence."""
    m = (p + q) / 2
    term = lambda x: F.when(x > 0, x * F.log2(x / m)).otherwise(0.0)
    return (term(p) + term(q)) / 2


def _char_distance(shares: Column) -> Column:
    """Bins are met in lambdas, here and below: written out, each bin repeats its shares' expressions five times, and
    the driver plans them all."""
    total = F.aggregate("_chars", F.lit(0.0), lambda a, x: a + x)
    bins = F.zip_with(F.transform("_chars", lambda c: c / total), shares, _half)
    return F.sqrt(F.greatest(F.lit(0.0), F.aggregate(bins, F.lit(0.0), lambda a, x: a + x)))


def _word_distance(shares: Column, total: Column) -> Column:
    """Bins that the document lacks add half their share each, so only the bins it has are visited."""
    n = F.col("n_words").cast("double")
    share = lambda x: F.get(shares, (x["word"] - 1).cast("int"))
    rest = _half(1 - F.col("_n_common") / n, 1 - total)
    both = F.transform("_common", lambda x: F.struct((x["n"] / n).alias("p"), share(x).alias("q")))
    seen = F.aggregate(both, total / 2, lambda sum_, x: sum_ + _half(x["p"], x["q"]) - x["q"] / 2)
    return F.sqrt(F.greatest(F.lit(0.0), rest + seen))


def limit(size: Column, most: float, length: int, spread: float) -> Column:
    """The largest distance of a document that is kept: ``most`` from ``length`` on, wider for a shorter one."""
    n = F.greatest(size, F.lit(1)).cast("double")
    return F.sqrt(most**2 + spread * F.greatest(F.lit(0.0), 1 / n - 1 / length))


def verdicts(
    rows: DataFrame,
    known: References,
    max_char_distance: float = MAX_CHAR_DISTANCE,
    max_word_distance: float = MAX_WORD_DISTANCE,
) -> DataFrame:
    """Adds ``char_distance`` and ``word_distance`` to the nearest reference, and ``kept``.

    A distance is null where there is no text or the document's language has no reference; a null distance keeps.
    ``rows`` has ``lang``, or it is in ``_row``.
    """
    lang = F.col("lang") if "lang" in rows.columns else F.col("_row.lang")
    own = F.col("_lang").isNotNull()
    any_language = (lang.isNull() | lang.isin(list(known.common))) if known.common else F.lit(False)

    def nearest(distances: list[Column], of_own: Column) -> Column:
        return F.when(own | any_language, F.least(*distances, F.when(own, of_own), F.lit(1.0)))

    table = lambda shares: F.array(*[F.lit(q) for q in shares])
    by_chars = [_char_distance(table(c)) for c, _ in known.common.values()]
    by_words = [_word_distance(table(w), F.lit(min(1.0, sum(w)))) for _, w in known.common.values()]
    total = F.least(F.lit(1.0), F.aggregate("_own_words", F.lit(0.0), lambda a, x: a + x))
    own_words = _word_distance(F.col("_own_words"), total)
    columns = rows.columns
    rows = rows.join(known.rare, lang == F.col("_lang"), "left").select(
        *columns,
        F.when(F.col("_length") > 0, nearest(by_chars, _char_distance(F.col("_own_chars")))).alias("char_distance"),
        F.when(F.col("n_words") > 0, nearest(by_words, own_words)).alias("word_distance"),
    )
    near = lambda name, most: F.coalesce(F.col(name) <= most, F.lit(True))
    most_chars = limit(F.col("_length"), max_char_distance, CHAR_LENGTH, CHAR_SPREAD)
    most_words = limit(F.col("n_words"), max_word_distance, WORD_LENGTH, WORD_SPREAD)
    kept = ~F.col("base_failed") & near("char_distance", most_chars) & near("word_distance", most_words)
    return rows.withColumn("kept", kept)


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents that the quality rules keep, with the input's columns.

    The features are a table before the verdict filters them: else the filter would be pushed through all their
    expressions, and the plan would grow beyond measure.
    """
    rows = written(features(docs), "quality-rows")
    known = references(rows.withColumn("lang", F.col("_row.lang")), len(_vocabulary(COMMON_WORDS)))
    return verdicts(rows, known).where("kept").select("_row.*")


def op8_quality_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, distances and verdict of every document. The features are made once and kept without the texts."""
    rows = features(documents(spark, sf_dir).select("doc_id", "text", "lang"))
    rows = rows.select("_row.doc_id", "_row.lang", *[c for c in rows.columns if c != "_row"])
    rows = written(rows, "quality-features")
    return verdicts(rows, references(rows, len(_vocabulary(COMMON_WORDS)))).select(
        *("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"),
        *("char_distance", "word_distance"),
    )
