import re
from collections import Counter

from filingscope.llm import quality

from .conftest import AWKWARD

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    words = WORD.findall(text or "")
    lines = [line for line in (text or "").split("\n") if WORD.search(line)]
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {p for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for p in range(i, i + 5)}
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return (
        *(len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or ""))),
        *(len(lines) - len(set(lines)), len(covered), failed),
    )


COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def test_base_counts_match_brute_force(docs):
    texts = [t for _, t, _ in AWKWARD] + ["a b c d e f a b c d e g h i j k l m n o p a b c d e", "x\nx\n\n \nx y\nx y"]
    rows = quality.features(docs(*[(i, t, "en") for i, t in enumerate(texts)]))
    found = {r["_row"]["doc_id"]: tuple(r[c] for c in COLUMNS) for r in rows.collect()}
    assert found == {i: base(t) for i, t in enumerate(texts)}


def test_junk_goes_and_clean_text_stays(docs):
    clean = "the cat sat on the mat and it is a good day for all of us to be in the sun, as they say. "
    varied = [clean * 3 + " ".join(f"word{chr(97 + i % 26)}{chr(97 + j % 26)}" for j in range(160)) for i in range(30)]
    short_runs = [" ".join(w for w in t.split()[40:]) for t in varied]
    junk = " ".join(f"w{i}ord$$$ ***%%%" for i in range(200))
    table = docs(*[(i, t, "en") for i, t in enumerate(short_runs)], (99, junk, "en"))
    kept = {r["doc_id"] for r in quality.keep_good(table).collect()}
    assert 99 not in kept
    assert kept == {i for i, t in enumerate(short_runs) if not base(t)[-1]}
    assert quality.keep_good(table).columns == table.columns


def test_awkward_rows_and_empty_table(docs):
    table = docs(*AWKWARD)
    known = quality.references(quality.features(table).withColumn("lang", quality.F.col("_row.lang")), 1)
    assert quality.verdicts(quality.features(table), known).count() == len(AWKWARD)
    assert quality.keep_good(table.limit(0)).count() == 0


def test_the_verdict_names_each_histogram_a_few_times(docs):
    rows = quality.features(docs(*AWKWARD))
    shares = ([1 / quality.N_CLASSES] * quality.N_CLASSES, [0.5, 0.25])
    known = quality.references(rows.withColumn("lang", quality.F.col("_row.lang")), 2)
    known = known._replace(common={"en": shares, "fr": shares})
    rows = quality.written(rows, "test-rows")
    plan = quality.verdicts(rows, known).select("kept")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("_chars#") <= 40 and plan.count("_common#") <= 40


def test_a_rare_language_is_not_judged_by_the_others(docs):
    english = "the cat sat on the mat and it is a good day for all of us to be in the sun, as they say. "
    plain = [english + " ".join(f"w{chr(97 + i % 26)}{chr(97 + j % 26)}" for j in range(20)) for i in range(400)]
    foreign = lambda seed, n: " ".join(f"kilo{chr(97 + (seed + j) % 26)}ma{chr(97 + j // 26 % 26)}{j}" for j in range(n))
    junk = " ".join(f"w{i}ord$$$ ***%%%" for i in range(200))
    rare = [(1000, foreign(1, 1500), "xx"), (1001, foreign(2, 1500), "xx"), (1002, junk, "xx"), (1003, foreign(3, 200), "yy")]
    table = docs(*[(i, t, "en") for i, t in enumerate(plain)], *rare, (1004, foreign(4, 200), "en"))
    kept = {r["doc_id"] for r in quality.keep_good(table).collect() if r["doc_id"] >= 1000}
    assert kept == {1000, 1001, 1003}
    known = quality.references(quality.features(table).withColumn("lang", quality.F.col("_row.lang")), 1)
    assert list(known.common) == ["en"] and [r["_lang"] for r in known.rare.collect()] == ["xx"]


def test_short_junk_goes_and_short_clean_text_stays(docs):
    english = "the cat sat on the mat and it is a good day for all of us to be in the sun, as they say. "
    own = lambda i, n: " ".join(f"w{chr(97 + (i + j) % 26)}{chr(97 + j % 26)}o{j}" for j in range(n))
    plain = [english + own(i, 30) for i in range(300)]
    few = english + own(5, 18)  # 40 words, as the corpus
    menu = [" | ".join(f"item{chr(97 + j % 26)}{j}" for j in range(n)) for n in (38, 56, 74)]  # 75 to 147 words
    lines = [own(7, n) for n in (75, 112, 149)]  # no common words
    short = [(1000, few, "en"), (1001, own(3, 15), "en"), *[(2000 + i, t, "en") for i, t in enumerate(menu + lines)]]
    kept = {r["doc_id"] for r in quality.keep_good(docs(*[(i, t, "en") for i, t in enumerate(plain)], *short)).collect()}
    assert {i for i in kept if i >= 1000} == {1000, 1001} and len(kept) == 302
