"""Licences, fingerprints, languages, line runs, overlaps and scores against plain versions."""

import itertools
import math
import os
import random
import re
import sys
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from filingscope.llm import language, licenses, line_runs, overlap_join, phrases, suffix_tree

from .conftest import AWKWARD

FOLDER = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables not present")


# --- licences ------------------------------------------------------------------------------------------


@needs_tables
def test_license_scan_matches_sql(spark):
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{FOLDER}/documents.parquet'")
    rows = licenses.op4_license_scan(spark, FOLDER)
    answer = connection.execute(licenses.ORACLE).fetchall()
    assert sorted(map(tuple, rows.collect())) == sorted(answer)
    assert any(r[2] for r in answer)


def test_license_rules_claim_in_order(docs):
    grant = next(s for s, i in licenses.SENTENCES.items() if i == "mit_grant")
    notice = next(s for s, i in licenses.SENTENCES.items() if i == "mit_notice")
    texts = [f"{grant}. Some words here.\n{notice}.", notice, f"x.\n{notice}\n{grant}", "Licensed under CC BY 4.0.\nAll rights reserved."]
    rows = {r["doc_id"]: (r["licenses"], r["n_unmatched"]) for r in licenses.scan(docs(*texts)).collect()}
    assert rows == {0: ("MIT", 0), 1: ("", 1), 2: ("", 2), 3: ("CC-BY-4.0", 1)}
    assert all(any(a in s for a in licenses.ANCHORS) or "license" in s for s in licenses.SENTENCES if not s.startswith("licensed"))
    assert licenses.scan(docs(*AWKWARD)).count() == len(AWKWARD)
    assert licenses.scan(docs(*AWKWARD).limit(0)).count() == 0


def test_wrapped_licence_texts(docs):
    import textwrap

    whole = {i: s for s, i in licenses.SENTENCES.items()}
    grants = ("mit_grant", "mit_notice", "mit_warranty")
    mit = "Copyright (c) 2020 Someone\n\n" + "\n\n".join(textwrap.fill(whole[i].capitalize() + ".", 72) for i in grants)
    gpl = "\n".join(" * " + line for line in textwrap.wrap(whole["gpl3_grant"] + ".", 70)) + "\n *\n * " + whole["gpl_copy"] + ". If not"
    apache = "# Copyright 2020\r\n" + "\r\n".join("# " + line for line in textwrap.wrap(whole["apache2_grant"] + ". " + whole["apache2_obtain"], 70)) + "\r\n#\r\n#  http://x"
    names = " {} nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
    two = [f"{whole['bsd_grant']}:", f"1. {whole['bsd_source']}.", f"2. {whole['bsd_binary']}."]
    bsd = ["\n".join(textwrap.fill(x, 76) for x in [*two, *more]) for more in ([], ["3. Neither the name of" + names.format("the copyright holder")], ["3. Neither the name of" + names.format("Acme Inc.")])]
    lines = "released under the MIT license\nand no more\nAll  rights\treserved\nLicensed under CC BY 4.0"
    apart = "licensed under the\n\nMIT license. Permission to\nlicense"
    rows = {r["doc_id"]: (r["licenses"], r["n_unmatched"]) for r in licenses.scan(docs(mit, gpl, apache, *bsd, lines, apart)).collect()}
    assert [rows[i][0] for i in range(6)] == ["MIT", "GPL-3.0-or-later", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "BSD-3-Clause"]
    assert rows[6] == ("MIT,CC-BY-4.0", 1) and rows[7] == ("", 0)
    assert all(any(a in s for a in licenses.ANCHORS) for s in (*licenses.SENTENCES, *licenses.ENDINGS))


# --- fingerprints --------------------------------------------------------------------------------------


def plain_sketch(text, size):
    """Locally consistent parsing of one text, a symbol at a time."""
    full = 2**64 - 1

    def mix(x):
        for _ in range(2):
            x = (x ^ (x >> 32)) * 0xD6E8FEB86659FD93 & full
        return x ^ (x >> 32)

    def toss(labels):
        found = []
        for i, label in enumerate(labels):
            differ = label ^ labels[i - 1] if i else 1
            place = (differ & -differ).bit_length() - 1
            found.append(2 * place + (label >> place & 1))
        return found

    names, kept = [ord(c) for c in text], set()
    for level in range(1, phrases.LEVELS + 1):
        runs = [(name, len(list(same))) for name, same in itertools.groupby(names)]
        labels = [name for name, _ in runs]
        for _ in range(phrases.TOSSES):
            labels = toss(labels)
        cuts = [i for i in range(len(runs)) if not i or (i < len(runs) - 1 and labels[i - 1] < labels[i] > labels[i + 1])]
        names = []
        for a, b in zip(cuts, [*cuts[1:], len(runs)]):
            spelled = [mix(mix(n + r * int(phrases.MIX) & full) ^ ((i + 1) * int(phrases.MIX) & full)) for i, (n, r) in enumerate(runs[a:b])]
            names.append(mix(sum(spelled) & full))
        if level >= phrases.FIRST_LEVEL:
            kept.update(names)
    return sorted(kept)[:size]


def test_phrases_are_those_of_a_plain_parser():
    rng = random.Random(4)
    some = ["", "a", "aaaa", "ab" * 90, "中文 é" * 60] + ["".join(rng.choice("abc d\n") for _ in range(rng.randrange(900))) for _ in range(60)]
    for size in (phrases.SKETCH, 10**6):
        assert [s.tolist() for s in phrases.sketches(some, size)] == [plain_sketch(t, size) for t in some]


def test_names_alike_in_their_first_bits_are_ordered_too():
    names = np.array([9, 8, 2**63 + 1, 2**63, 7, 7], np.uint64)
    owner = np.array([0, 0, 0, 1, 1, 1])
    order = phrases._by_owner(names, owner, 2)
    assert names[order].tolist() == [8, 9, 2**63 + 1, 7, 7, 2**63] and owner[order].tolist() == [0, 0, 0, 1, 1, 1]


def test_phrases_do_not_depend_on_the_offset():
    rng = random.Random(3)
    middle = "".join(rng.choice("abcdefgh ") for _ in range(4000))
    one, other = phrases.sketches(["xyz" * 5 + middle, "q" + middle + "tail"], 10**6)
    assert len(np.intersect1d(one, other)) > 0.95 * min(len(one), len(other))
    alone, together = phrases.sketches([middle])[0], phrases.sketches(["a", middle, "bb"])[1]
    assert (alone == together).all()


def test_edited_and_next_texts(docs):
    rows = {r["doc_id"]: r for r in phrases.compare_edited(docs(*[(i, t, "en") for i, (_, t, _) in enumerate(AWKWARD)])).collect()}
    texts = [t or "" for _, t, _ in AWKWARD]
    assert len(rows) == len(texts)
    for i, text in enumerate(texts):
        changed = phrases.edited(text, texts[(i + 1) % len(texts)])
        own, new, following = phrases.sketches([text])[0], phrases.sketches([changed])[0], phrases.sketches([texts[(i + 1) % len(texts)]])[0]
        assert rows[i]["n_chars"] == len(text)
        assert rows[i]["edited_sha256"] == __import__("hashlib").sha256(changed.encode()).hexdigest()
        assert rows[i]["near_edited"] == phrases.likeness(own, new) and rows[i]["near_next"] == phrases.likeness(own, following)
    assert phrases.compare_edited(docs(*AWKWARD)).count() == len(AWKWARD)
    assert phrases.compare_edited(docs("only one row")).first()["near_next"] == 1.0
    assert phrases.compare_edited(docs(*AWKWARD).limit(0)).count() == 0
    assert phrases.fingerprints(docs(*AWKWARD)).count() == len(AWKWARD)


# --- languages -----------------------------------------------------------------------------------------


@needs_tables
def test_language_of_held_out_documents(spark):
    truth = {r["doc_id"]: r["lang"] for r in language.documents(spark, FOLDER).collect()}
    rows = [r for r in language.op9_language_subwords(spark, FOLDER).collect() if r["held_out"]]
    assert rows and all(zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1 for r in rows)
    assert np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in rows]) >= 0.95


STRANGE = {
    "Finnish": "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto.",
    "Italian": "Tutti gli esseri umani nascono liberi ed eguali in dignità e diritti. Essi sono dotati di ragione e di coscienza.",
    "Dutch": "Alle mensen worden vrij en gelijk in waardigheid en rechten geboren. Zij zijn begiftigd met verstand en geweten.",
    "Russian": "Все люди рождаются свободными и равными в своем достоинстве и правах. Они наделены разумом и совестью.",
    "Japanese": "すべての人間は、生まれながらにして自由であり、かつ、尊厳と権利とについて平等である。",
    "code": "<div class='a'><span id=\"x\">foo</span><script>var a = 1; function b() { return a; }</script></div>",
    "consonants": "xkcd qwrt zxcv bnmp lkjh gfds qwrtp zxcvb nmlkj hgfds pqwrt mnbvc lkjhg fdsqw",
}


@pytest.fixture(scope="module")
def languages(spark):
    if not os.path.isdir("/root/testdata/sf0.01"):
        pytest.skip("test tables not present")
    table = language.documents(spark, "/root/testdata/sf0.01")
    return table, language.train(table)


def test_texts_of_no_known_language_go_and_known_ones_stay(languages):
    table, model = languages
    names, scores, rejected = model.score(pa.array(list(STRANGE.values())), {})
    assert list(rejected) == [True] * len(STRANGE) and max(scores) < 0.5
    rows = language.annotate(table, model).collect()
    plain = [r for r in rows if not re.search(r"[#*$%&|<>]{3}", r["row"]["text"] or "###")]
    assert len(plain) > 800 and sum(r["rejected"] for r in plain) == 0
    some = [r["row"]["text"] for r in plain if len(r["row"]["text"].split()) >= 30][:100]
    _, _, rejected = model.score(pa.array([language._shuffled(t) for t in some]), {})
    assert np.mean(rejected) >= 0.9


def test_a_language_left_out_is_rejected(languages):
    table, _ = languages
    model = language.train(table.where("lang <> 'es'"))
    rows = language.annotate(table.where("lang = 'es' AND length(text) > 200"), model).collect()
    assert len(rows) > 50 and np.mean([r["rejected"] for r in rows]) >= 0.9


def test_bags_are_views_of_the_sample():
    kinds = {"lang": ["en", "en"], "key": [2, 1], "shuffled": [False, True]}
    lists = pa.array([[3, 4], [5]], pa.list_(pa.int32()))
    table = pa.table({**kinds, "buckets": lists, "counts": lists})
    (plain,), (noise,) = language._bags(table, False), language._bags(table, True)
    assert plain.buckets.tolist() == [3, 4] and noise.buckets.tolist() == [5]
    assert np.shares_memory(plain.buckets, lists.values.to_numpy())


def test_the_temperature_is_inside_its_grid(languages):
    assert 0.02 < languages[1].temperature < 50


def test_a_remembered_word_takes_little_more_than_its_numbers(languages):
    _, model = languages
    memory = {}
    first = model.score(pa.array([*STRANGE.values(), "", None]), memory)
    again = model.score(pa.array([*STRANGE.values(), "", None]), memory)
    assert first[0] == again[0] and np.array_equal(first[1], again[1]) and len(model.score(pa.array([""]), {})[0]) == 1
    held = [sys.getsizeof(x) + (sum(map(sys.getsizeof, x)) if isinstance(x, list) else 0) for x in memory.values()]
    assert max(held) <= 8 * (2 * len(model.languages) + 1) + 64


def test_language_scores_match_a_plain_sum_over_ngrams(languages):
    table, model = languages
    texts = [r["text"] for r in table.limit(20).collect()] + [*STRANGE.values(), "a", "é", "a  b\tc"]
    names, scores, rejected = model.score(pa.array(texts), {})
    for text, name, score, out in zip(texts, names, scores, rejected):
        sums, fam, n = np.zeros(len(model.languages)), np.zeros(len(model.languages)), 0
        for word in re.findall(r"[^\x20\x09-\x0D]+", text):
            data = re.sub("[A-Z]", lambda m: m[0].lower(), f"<{word}>").encode()
            for size in language.SIZES:
                for at in range(len(data) - size + 1):
                    value = data[at]
                    for byte in data[at + 1 : at + size]:
                        value = value * 257 + byte + 1
                    bucket = int(language.mixed(np.array([value + (size << 40)], np.uint64))[0] % language.BUCKETS)
                    sums, fam, n = sums + model.weights[bucket], fam + model.familiarity.known[bucket], n + 1
        logits = (sums / n + model.bias) / model.temperature
        powers = np.exp(logits - logits.max())
        best = int(powers.argmax())
        of = model.familiarity
        short = of.typical[best] - fam[best] / n - language.SCATTER * of.scatter[best] / n**0.5
        factor = 1 / (1 + np.exp((short - of.slack[best]) / max(of.slack[best] / 4, 0.02)))
        p = powers[best] / powers.sum()
        assert name == model.languages[best] and score == pytest.approx(p * factor, rel=1e-6)
        assert out == (short > of.slack[best] or p < model.least)


def test_language_of_awkward_rows(docs):
    plain = [(100 + i, "the cat and the dog in a house" if i % 2 else "der hund und die katze im haus", "en" if i % 2 else "de") for i in range(60)]
    table = docs(*AWKWARD, *plain)
    model = language.train(table)
    rows = language.annotate(table, model).collect()
    assert len(rows) == len(AWKWARD) + 60
    for r in rows:
        letters = language.LETTER.search(r["row"]["text"] or "")
        assert (r["lang_pred"] == "und") == (letters is None) and 0 <= r["score"] <= 1
    kept = language.keep_identified(table)
    assert kept.columns == table.columns
    assert {r["doc_id"] for r in kept.collect()} >= {i for i, _, _ in plain}
    assert language.train(table.limit(0)) is None
    assert {r["lang_pred"] for r in language.annotate(table, None).collect()} == {"und"}


# --- line runs -----------------------------------------------------------------------------------------


def deleted(texts, least):
    """All runs of enough words that stand earlier, found by comparing every run with every other."""
    first, gone = {}, [set() for _ in texts]
    for d, text in enumerate(texts):
        lines = [(i, s) for i, line in enumerate(text.split("\n")) if (s := line.strip(line_runs.SPACE))]
        for i in range(len(lines)):
            for j in range(i, len(lines)):
                run = tuple(s for _, s in lines[i : j + 1])
                if sum(len(s.split()) for s in run) >= least and first.setdefault(run, (d, i)) != (d, i):
                    gone[d].update(n for n, _ in lines[i : j + 1])
    return ["\n".join(s for n, s in enumerate(t.split("\n")) if n not in g) for t, g in zip(texts, gone, strict=True)]


def test_line_runs_match_brute_force(docs):
    rng = random.Random(5)
    pool = [" ".join(f"w{rng.randrange(50)}" for _ in range(rng.randrange(1, 14))) for _ in range(25)]
    texts = ["\n".join(rng.choice(pool) if rng.random() < 0.9 else f"own {rng.random()}" for _ in range(rng.randrange(0, 40))) for _ in range(40)]
    texts += [texts[3], "\n\n" + texts[4] + "\n \n", texts[5] * 2]
    rows = {r["row"]["doc_id"]: r["body"] for r in line_runs.dedup_lines(docs(*texts), 30).collect()}
    assert [rows[i] for i in range(len(texts))] == deleted(texts, 30)


def test_the_plan_of_line_windows_does_not_grow_with_the_levels(docs, monkeypatch):
    plans, keep = {}, line_runs.written

    def noted(df, purpose):
        plans[purpose] = df._jdf.queryExecution().analyzed().toString()
        return keep(df, purpose)

    monkeypatch.setattr(line_runs, "written", noted)
    text = "\n".join(f"line {i} of a text" for i in range(40))
    found = {r["ln"]: r["n"] for r in line_runs.copies(line_runs.lines(docs(text, text))).where("did = 1").collect()}
    assert found == {i: 6 for i in range(35)}  # five words a line
    assert plans["line-windows"].count("Join ") == 2


def test_line_runs_of_awkward_rows(docs):
    table = docs(*AWKWARD, (20, "word " * 60_000, "en"))
    found = line_runs.without_copies(table)
    assert found.columns == table.columns
    ids = [r["doc_id"] for r in found.collect()]
    assert 20 not in ids and ids.count(5) == 2 and len(ids) == len(AWKWARD)
    assert line_runs.without_copies(table.limit(0)).count() == 0


# --- overlaps ------------------------------------------------------------------------------------------


def shingles(text):
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4)) or frozenset([tuple(words)] if words else [])


def components(texts):
    sets, parent = [shingles(t) for t in texts], list(range(len(texts)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, one in enumerate(sets):
        for j in range(i):
            if one and sets[j] and 100 * len(one & sets[j]) >= 80 * len(one | sets[j]):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return [(len(s), root(i)) for i, s in enumerate(sets)]


def test_overlap_groups_match_brute_force(docs):
    rng = random.Random(11)
    base = [[f"w{rng.randrange(3000)}" for _ in range(rng.randrange(20, 90))] for _ in range(6)]
    passage = [f"p{i}" for i in range(40)]
    texts = []
    for words in base:
        for _ in range(18):
            copy = list(words)
            for _ in range(rng.randrange(0, 4)):
                copy[rng.randrange(len(copy))] = f"e{rng.randrange(10**6)}"
            texts.append(" ".join(copy))
    texts += [" ".join([*passage, *(f"o{rng.randrange(10**6)}" for _ in range(rng.randrange(2, 14)))]) for _ in range(40)]
    texts += [texts[0].upper(), "a b", "A b", "a b c", "", None, texts[1] + " ", "x y z"]
    rows = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in overlap_join.similar_groups(docs(*texts)).collect()}
    assert [rows[i] for i in range(len(texts))] == components(texts)


def test_divide_skip_counts_like_sets():
    rng = np.random.default_rng(1)
    query = rng.choice(10**6, 80, replace=False).astype(np.uint64)
    candidates = []
    for i in range(60):
        kept = rng.choice(query, rng.integers(55, 81), replace=False)
        own = np.concatenate([kept, rng.integers(10**7, 10**8, rng.integers(0, 20)).astype(np.uint64)])
        candidates.append((i, len(own), own))
    want = {i for i, n, s in candidates if 100 * (k := len(np.intersect1d(query, s))) >= 80 * (80 + n - k)}
    assert set(overlap_join.divide_skip(query, 80, candidates)) == want


def test_star_contraction(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 101), (101, 102), (200, 200)]
    found = {r["v"]: r["c"] for r in overlap_join.groups(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert found == {**{i: 1 for i in range(2, 41)}, 101: 100, 102: 100}


def test_a_half_step_of_the_contraction_plans_one_join_without_broadcast(spark, monkeypatch):
    plans, write = [], overlap_join.written

    def kept(df, purpose):
        plans.append(df._jdf.queryExecution().toString())
        return write(df, purpose)

    monkeypatch.setattr(overlap_join, "written", kept)
    edges = [(1, 2), (2, 3), (3, 4)]
    overlap_join.groups(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    physical = [p.partition("== Physical Plan ==")[2] for p in plans]
    assert max(p.count("SortMergeJoin") for p in physical) == 1
    assert not any("Broadcast" in p for p in physical)


def test_finished_groups_are_not_contracted_again(spark, monkeypatch):
    purposes, write = [], overlap_join.written
    monkeypatch.setattr(overlap_join, "written", lambda df, purpose: (purposes.append(purpose), write(df, purpose))[1])
    frame = lambda edges: spark.createDataFrame(edges, "a bigint, b bigint")
    found = overlap_join.groups(frame([(2, 1), (3, 1), (1, 3), (9, 8), (5, 5)])).collect()
    assert sorted(map(tuple, found)) == [(2, 1), (3, 1), (9, 8)] and purposes == ["links"]
    assert overlap_join.groups(frame([])).count() == 0
    assert [overlap_join.stars(frame(e)) for e in ([(3, 1), (3, 2)], [(3, 2), (2, 1)], [(3, 1), (2, 1)])] == [False, False, True]


def test_one_of_each_group_stays(docs):
    table = docs(*AWKWARD, (21, None, "en"))
    found = overlap_join.one_of_each(table)
    assert found.columns == table.columns
    ids = [r["doc_id"] for r in found.collect()]
    assert ids.count(5) == 1 and 6 not in ids and {1, 2, 3, 4, 7, 8, 9, 10, 21} <= set(ids)
    assert overlap_join.similar_groups(table).count() == len(AWKWARD) + 1
    assert overlap_join.one_of_each(table.limit(0)).count() == 0


def test_sets_of_null_ids_link_and_bridge(docs):
    words = lambda name, first: " ".join(f"{name}{i}" for i in range(first, first + 200))
    rows = [(50, words("a", 0), "en"), (None, words("a", 15), "en"), (60, words("a", 30), "en")]  # 50 and 60 are not alike
    rows += [(70, words("b", 0), "en"), (None, words("b", 5), "en")]
    rows += [(None, words("c", 0), "en"), (None, words("c", 5), "en"), (80, words("d", 0), "en")]
    found = overlap_join.similar_groups(docs(*rows)).collect()
    by_id = {r["doc_id"]: r["component_id"] for r in found if r["doc_id"] is not None}
    assert by_id == {50: 50, 60: 50, 70: 70, 80: 80}
    unnamed = [r["component_id"] for r in found if r["doc_id"] is None]
    assert sorted(unnamed, key=lambda c: c or 0) == [None, None, 50, 70]
    kept = [r["doc_id"] for r in overlap_join.one_of_each(docs(*rows)).collect()]
    assert sorted(kept, key=lambda i: i or 0) == [None, 50, 70, 80]


# --- scores --------------------------------------------------------------------------------------------


@needs_tables
def test_scores_and_base(spark):
    texts = {r["doc_id"]: r["text"] or "" for r in suffix_tree.documents(spark, FOLDER).collect()}
    words = {i: [*t.encode().lower().split(), None] for i, t in texts.items()}
    held = {i: zlib.crc32(str(i).encode()) % 10 == 0 for i in texts}
    counts = Counter(w for i, ws in words.items() if not held[i] for w in ws)
    total, distinct = sum(counts.values()), len(counts)
    rows = suffix_tree.op1_suffix_tree_scores(spark, FOLDER).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ws = words[r["doc_id"]]
        base = sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in ws)
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held[r["doc_id"]], len(ws), sum(w in counts for w in ws), total)
        assert math.isclose(r["base_score"], base, rel_tol=1e-9) and r["score"] <= 0
    new = [r for r in rows if r["held_out"]]
    assert sum(r["score"] for r in new) > sum(r["base_score"] for r in new)


def tree_of(texts, spark):
    train = spark.createDataFrame([(t,) for t in texts], "text string")
    return suffix_tree.learn(train, suffix_tree.written(suffix_tree.word_counts(train), "counts"))


def test_distributions_sum_to_one(spark):
    import pyarrow as pa

    rng = random.Random(2)
    texts = [" ".join(rng.choice(("p x y", "q x z", *"uvw")) for _ in range(30)) for _ in range(40)]
    tree = tree_of(texts, spark)
    assert tree.keep_one.any() and tree.keep_two.any()
    alphabet = [*"uvwxyzpq"]
    for context in ("p x", "x y", "x", "", "nowhere u"):
        column = pa.array([f"{context} {w}".strip() for w in alphabet] + [context])
        word, rows, _, _ = tree.places(column)
        logs, _ = tree.score(word, rows)
        at = len(context.split())
        chances = [10 ** logs[np.nonzero(rows == i)[0][at]] for i in range(len(alphabet) + 1)]  # the last one ends
        previous = word[np.nonzero(rows == 0)[0][:at]]
        unknown = tree.unknown
        if at >= 1 and previous[-1] >= 0 and tree.keep_one[previous[-1]]:
            unknown *= tree.rest_one[previous[-1]]
        if at >= 2 and (pair := tree.pair_places(word, rows)[at - 1]) >= 0 and tree.keep_two[pair]:
            unknown *= tree.rest_two[pair]
        assert math.isclose(sum(chances) + unknown, 1.0, rel_tol=1e-6)


def test_scores_of_awkward_rows(docs, spark):
    from pyspark.sql import functions as F

    table = suffix_tree.texts(docs(*AWKWARD)).withColumn("held_out", F.lit(False))
    assert suffix_tree.score(table, table.select("text")).count() == len(AWKWARD)
    nothing = suffix_tree.score(table, table.select("text").limit(0)).collect()
    assert len(nothing) == len(AWKWARD) and all(r["score"] == 0 and r["n_known"] == 0 for r in nothing)
    assert suffix_tree.score(table.limit(0), table.select("text")).count() == 0


def test_scores_are_those_of_the_tree_in_one_process(docs, spark):
    import pyarrow as pa
    from pyspark.sql import functions as F

    rng = random.Random(4)
    line = lambda: " ".join(rng.choice(("p x y", "q x z", "x", *"uvw", f"r{rng.randrange(60)}")) for _ in range(rng.randrange(40)))
    learned, new = [line() for _ in range(60)], [line() + " unseen" for _ in range(10)]
    table = suffix_tree.texts(docs(*learned, *new)).withColumn("held_out", F.col("doc_id") >= 60)
    rows = {r["doc_id"]: r for r in suffix_tree.score(table, table.where("doc_id < 60").select("text")).collect()}
    tree = tree_of(learned, spark)
    word, at, _, _ = tree.places(pa.array(learned + new))
    logs, length = tree.score(word, at)
    logs = np.where(word < 0, logs + math.log10(tree.unknown), logs)
    assert tree.keep_one.any() and tree.keep_two.any() and (word < 0).any()
    for i in range(70):
        assert math.isclose(rows[i]["score"], logs[at == i].sum(), rel_tol=1e-9)
        assert rows[i]["n_by_context"] == (length[at == i] > 0).sum()


def test_a_rare_context_counts_however_large_the_corpus(docs, spark):
    from pyspark.sql import functions as F

    large = spark.range(500).select(F.expr("repeat('filler ', 40000)").alias("text"))  # 20 million words
    table = suffix_tree.texts(docs("alpha beta")).withColumn("held_out", F.lit(True))
    few = spark.createDataFrame([("alpha beta",)] * 3, "text string")
    assert suffix_tree.score(table, large.unionAll(few)).first()["n_by_context"] >= 1


@needs_tables
def test_tables_of_the_tree_take_few_bytes_a_token(spark, monkeypatch):
    import glob
    import os

    sizes, write = {}, suffix_tree.written

    def told(df, purpose):
        table = write(df, purpose)
        sizes[purpose] = sum(os.path.getsize(f) for p in table.inputFiles() for f in glob.glob(p.removeprefix("file://")))
        return table

    monkeypatch.setattr(suffix_tree, "written", told)
    tokens = sum(r["n_tokens"] for r in suffix_tree.op1_suffix_tree_scores(spark, FOLDER).collect())
    assert len(sizes) > 4 and sum(sizes.values()) < 20 * tokens


def test_few_listed_words_change_no_score(docs, spark, monkeypatch):
    from pyspark.sql import functions as F

    rng = random.Random(5)
    line = lambda: " ".join(rng.choice(("p x y", "q x z", "a" * 70 + "b", *"uvw", f"r{rng.randrange(60)}")) for _ in range(rng.randrange(60)))
    table = suffix_tree.texts(docs(*[line() for _ in range(80)])).withColumn("held_out", F.col("doc_id") >= 70)
    table = table.withColumn("learned", ~F.col("held_out"))

    def rows():
        return {r["doc_id"]: r for r in suffix_tree.score(table).collect()}

    whole = rows()
    for name, value in (("TOP", 2), ("CODED", 6), ("LISTED", 4)):
        monkeypatch.setattr(suffix_tree, name, value)
    for i, r in rows().items():
        assert math.isclose(r["score"], whole[i]["score"], rel_tol=1e-9)
        assert r["n_by_context"] == whole[i]["n_by_context"] and r["n_known"] == whole[i]["n_known"]


def test_hashes_of_words_do_not_depend_on_their_place():
    import pyarrow as pa

    words = [f"{'é' * (n // 2)}{'x' * (n % 2)}{i}" for n in range(150) for i in range(3)] + ["a", "a\0", "\0a"]
    found = suffix_tree._hashes(pa.array(words))
    assert len(set(found.tolist())) == len(words)
    assert (suffix_tree._hashes(pa.array(["other", *words]).slice(1)) == found).all()
    assert [int(suffix_tree._hashes(pa.array([w]))[0]) for w in words[:60]] == found[:60].tolist()
