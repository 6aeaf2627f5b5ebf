"""The stages in their order, each against a plain version on what the one before kept."""

import random

import corpus_pipeline
from filingscope.llm.common import written

from .conftest import AWKWARD
from .test_quality import base
from .test_texts import components, deleted
from .test_tokens import BYTES, library


def corpus():
    rng = random.Random(9)
    word = lambda: rng.choice(("the", "of", "and", "a", "in", "to", "is")) if rng.random() < 0.35 else f"{rng.choice('bcdfgkl')}{rng.choice('aeiou')}{rng.choice('mnprst')}{rng.choice('aeiou')}{rng.choice('xyz')}{rng.choice('aeiou')}"  # noqa: E501,E731
    line = lambda: " ".join(word() for _ in range(rng.randrange(6, 14))).capitalize() + "."
    texts = ["\n".join(line() for _ in range(rng.randrange(4, 9))) for _ in range(40)]
    passage = "\n".join(line() for _ in range(6))
    texts += [texts[0], texts[0], line() + "\n" + passage, passage + "\n" + line() + "\n" + line()]
    for i in (3, 4, 5):  # near copies on one line, so that no line repeats
        words = texts[i].replace("\n", " ").split()
        words[len(words) // 2] = "changed"
        texts += [" ".join(words), " ".join([*words, "more"])]
    return [(100 + i, t, "en") for i, t in enumerate(texts)]


def test_stages_match_plain_versions(docs, spark):
    rows = corpus()
    empty = [r for r in AWKWARD if r[0] in (1, 2, 3, 4)]
    table = docs(*rows, (500, "### $$$ " * 60, "en"), (501, "too short", "en"), *empty)
    now = table
    kept = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        now = written(stage(spark, now, ""), "test-stage")
        assert now.columns == table.columns
        kept.append(sorted((r["doc_id"], r["text"]) for r in now.collect()))
    texts = dict((i, t) for i, t, _ in rows)
    assert [i for i, _ in kept[0]] == sorted(i for i, t in texts.items() if not base(t)[-1])
    assert kept[1] == kept[0]
    shorter = deleted([t for _, t in kept[1]], 30)
    assert kept[2] == [(i, t) for (i, _), t in zip(kept[1], shorter, strict=True) if t.split()]
    groups = components([t for _, t in kept[2]])
    assert kept[3] == [row for at, (row, (_, first)) in enumerate(zip(kept[2], groups, strict=True)) if at == first]
    assert len(kept[2]) < len(kept[1]) and len(kept[3]) < len(kept[2])
    pieces = corpus_pipeline.STAGES[-1][1](spark, now, "").collect()
    assert sum(r["length"] for r in pieces) == sum(len(library(BYTES, t)) + 1 for _, t in kept[3])


def test_an_empty_table_passes_through(docs, spark):
    now = docs(*AWKWARD).limit(0)
    for _, stage in corpus_pipeline.STAGES:
        now = written(stage(spark, now, ""), "test-stage")
        assert now.count() == 0
