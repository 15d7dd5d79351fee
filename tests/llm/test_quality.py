"""Rules (op 6), classifiers (ops 4, 7) and licences (op 2)."""

import collections
import re
import zlib

import numpy as np
import pytest

from rollcall.llm import compression, licenses, queries, rules, toxicity

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_measures(text):
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    count = collections.Counter(windows)
    cover = {j for i, w in enumerate(windows) if count[w] > 1 for j in range(i, i + 8)}
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(cover)


def test_rules_against_plain_counts(spark, tables, texts_of):
    got = {r.doc_id: r for r in queries.op6_divergence_rules(spark, tables).collect()}
    for doc_id, text in texts_of:
        r = got[doc_id]
        n_words, _, _, _, repeats = want = plain_measures(text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (n_words < 20 or 100 * repeats > 30 * n_words)
        assert not (r.base_failed and r.kept)


def test_rules_keep_good_and_drop_bad(spark):
    """Needs more rows than the smallest tables have."""
    folder = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = [r for r in queries.op6_divergence_rules(spark, folder).collect() if r.doc_id in labels and not r.base_failed]
    kept = collections.Counter((labels[r.doc_id], r.kept) for r in rows)
    assert kept[1, True] >= 0.99 * (kept[1, True] + kept[1, False])
    assert kept[0, False] >= 0.6 * (kept[0, True] + kept[0, False])


def test_js_distance_by_hand():
    p, q = np.array([[0.5, 0.5, 0.0]]), np.array([0.0, 0.5, 0.5])
    assert rules.js_distance(p, q)[0] == pytest.approx(np.sqrt(0.5))
    assert rules.js_distance(q[None], q)[0] == 0


def test_kept_rows_are_those_of_the_verdict(docs):
    kept = {r.doc_id for r in rules.quality_rules(docs).filter("kept").collect()}
    assert {r.doc_id for r in rules.kept(docs).collect()} == kept


def test_rules_odd_documents(odd_docs, no_docs):
    rows = rules.quality_rules(odd_docs).collect()
    want = collections.Counter(plain_measures(r.text or "") for r in odd_docs.collect())
    assert collections.Counter((r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in rows) == want
    assert rules.quality_rules(no_docs).count() == 0
    assert rules.kept(odd_docs).columns == odd_docs.columns and rules.kept(no_docs).count() == 0


def area(scores, truth):
    pos, neg = [s for s, t in zip(scores, truth, strict=True) if t], [s for s, t in zip(scores, truth, strict=True) if not t]
    return sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))


@pytest.mark.parametrize(("name", "label", "parts", "out", "least"), [
    ("op4_compression_quality", "quality", 5, 0, 0.97), ("op7_string_kernel_toxicity", "toxic", 4, 2, 0.9),
])
def test_held_out_ranking(spark, name, label, parts, out, least):
    folder = "/root/testdata/sf0.1"
    labels = {r.doc_id: r[label] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = queries.QUERIES[name](spark, folder).collect()
    assert len(rows) == spark.read.parquet(f"{folder}/documents.parquet").count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % parts == out)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
    tested = [r for r in rows if r.held_out and r.doc_id in labels]
    assert area([r.score for r in tested], [labels[r.doc_id] for r in tested]) >= least


@pytest.mark.parametrize("module", [compression, toxicity])
def test_classifiers_on_odd_documents(module, odd_docs, no_docs, odd_labels):
    model = module.fit(odd_docs, odd_labels)
    rows = module.score(odd_docs, model).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r.score <= 1 for r in rows)
    empty = module.fit(no_docs, odd_labels.filter("doc_id < 0"))
    assert module.score(no_docs, empty).count() == 0
    assert {r.score for r in module.score(odd_docs, empty).collect()} == {0.5}


@pytest.mark.parametrize(("module", "label", "share"), [(compression, "quality", 0.85), (toxicity, "toxic", 0.12)])
def test_scores_do_not_depend_on_the_cap(spark, module, label, share):
    """Both classes overlap, so the probability hangs on their shares; the cap takes as many of each."""
    rng = np.random.default_rng(5)
    plain, telling = [f"word{i}" for i in range(300)], ["grimble", "snortle", "wexford", "plunket"]
    rows = []
    for i in range(1600):
        y = int(rng.random() < share)
        words = rng.choice(plain, 40).tolist() + rng.choice(telling, 3).tolist() * (rng.random() < (0.6 if y else 0.2))
        rows.append((i, " ".join(rng.permutation(words)) + ".", y))
    table = spark.createDataFrame(rows, f"doc_id long, text string, {label} int")
    docs, labels = table.select("doc_id", "text"), table.select("doc_id", label)
    found = []
    for per_class in (2000, 40):
        scores = {r.doc_id: (r.score, r.predicted) for r in module.score(docs, module.fit(docs, labels, per_class=per_class)).collect()}
        found.append(np.array([scores[i] for i in range(1600)]))
    assert abs(found[0][:, 0].mean() - share) < 0.06 and abs(found[1][:, 0].mean() - share) < 0.1
    assert (found[0][:, 1] == found[1][:, 1]).mean() > 0.9


def test_compression_prefers_the_like():
    good, bad = [b"the cat sat on the mat and the dog ran by "] * 50, [b"$$$ ### %%% buy now !!! "] * 50
    model = compression.Model(compression.dictionary(good), compression.dictionary(bad), (10.0, 0.0, 0.0), 0.0)
    assert model.features("the dog sat on the mat and the cat ran by")[0] > 0 > model.features("buy now !!! $$$ ### %%%")[0]
    assert model.features("") == (0, 0, 0)


def plain_kernel(s, t, order=toxicity.ORDER, decay=toxicity.DECAY):
    """All pairs of equal subsequences, by their spans."""
    import itertools

    total = 0.0
    for a in itertools.combinations(range(len(s)), order):
        for b in itertools.combinations(range(len(t)), order):
            if all(s[i] == t[j] for i, j in zip(a, b, strict=True)):
                total += decay ** (a[-1] - a[0] + 1 + b[-1] - b[0] + 1)
    return total


@pytest.mark.parametrize(("s", "t"), [("abc", "abc"), ("id-iot", "idiot"), ("aaaa", "aaa"), ("xyz", "abc"), ("ab", "ab")])
def test_kernel_against_all_subsequences(s, t):
    assert toxicity.kernel(toxicity.codes([s]), toxicity.codes([t]))[0] == pytest.approx(plain_kernel(s, t))


def test_inserted_characters_still_match():
    marks = toxicity.Landmarks(["^idiot", "^worthless"])
    similar = lambda w: marks.similarities(["^" + w]).get("^" + w, np.zeros(2))
    assert similar("idiot")[0] == 1 and similar("id-iot")[0] > 0.5 and similar("worth*less")[1] > 0.5
    assert similar("patriot")[0] < 0.5 and not similar("ocean").any()
    assert "^idiot" in toxicity.sentence_words("you i d i o t now")
    for spelled in ("i..d..i..o..t", "i  d  i  o  t", "I - d - i * o _ t", "i.d i...o   t"):
        assert "^idiot" in toxicity.sentence_words(f"you {spelled}")
    assert len(toxicity.sentence_words("-" * 5000 + "a ...... b" + " ." * 5000 + "x")) > 0  # runs of separators take no more than their length


def test_landmarks_by_count_not_by_share():
    """A form of three documents is a landmark however many others are toxic, one that clean documents hold as often is not."""
    for others in (50, 2000):
        toxic = [{"^grimbler", f"^word{i}x"} for i in range(others)] + [{"^snortle", "^common"}] * 3
        clean = [{"^common", f"^plain{i}"} for i in range(20 * others)]
        chosen = toxicity.pick_landmarks(toxic, clean, 256)
        assert {"^grimbler", "^snortle"} <= set(chosen) and not any(x.startswith("^comm") for x in chosen)


def shares_of(text):
    m = licenses.model()
    z = (sum((m.weights[m.index[g]] for g in sorted(licenses.grams(text)) if g in m.index), np.zeros(len(m.classes))) + m.bias) / m.temperature
    p = np.exp(z - z.max())
    return p / p.sum()


def family_of(text):
    m, p = licenses.model(), shares_of(text)
    if 1 - p[-1] < 0.5:
        return licenses.NONE
    return m.classes[int(p[:-1].argmax())] if p[:-1].max() >= 0.5 else licenses.UNKNOWN


@pytest.mark.parametrize(
    ("text", "family"),
    [
        ("Licensed under the Apache License, Version 2.0", "apache"), ("Copyright 2019 Example Corp. All rights reserved.", "proprietary"),
        ("Released under the BSD 3-Clause License", "bsd"), ("CC-BY-SA 4.0", "cc-by-sa"), ("MPL-2.0", "mpl"), ("GPL v3 or later", "gpl"),
        ("Unauthorized copying of this file is strictly prohibited", "proprietary"), ("Distributed under GPLv3.", "gpl"),
        ("BSD-3-Clause", "bsd"), ("Released under the MIT terms", "mit"), ("Alle Rechte vorbehalten", "proprietary"),
        ("Tous droits réservés", "proprietary"), ("Todos los derechos reservados", "proprietary"),
        ("to deal in the Software without restriction, including without limitation the rights", "mit"),
        ("Licensed under the EUPL", "unknown"), ("Published under the Eclipse Public License 2.0", "unknown"),
        ("permission to land was refused by the tower", "none"), ("He came mit dem Zug und mit den Kindern", "none"), ("", "none"),
        ("Version 4.0 of the map was sold in the library", "none"),
    ],
)
def test_licence_families(text, family):
    assert family_of(text) == family


def units_of(text):
    """Lines that are not blank, and the lines between blank ones put together where they are several."""
    blank = lambda x: not x.strip(" \t\r\f\v")
    lines, run = text.split("\n"), []
    out = [(i, 1, x.lower()) for i, x in enumerate(lines) if not blank(x)]
    for i, x in enumerate([*lines, ""]):
        if not blank(x):
            run.append((i, x))
        elif run:
            if len(run) > 1:
                out.append((run[0][0], len(run), " ".join(x for _, x in run).lower()))
            run = []
    return out


def test_licence_query_against_plain_model(spark, tables, texts_of):
    """The bound on gains must lose nothing that the whole model, run over every line and paragraph, finds."""
    got = {(r.doc_id, r.paragraph, r.n_lines): r for r in queries.op2_license_paragraphs(spark, tables).collect()}
    gains, need = licenses.model().gains(0.5)
    want, dropped = {}, 0
    for doc_id, text in texts_of:
        for first, n, body in units_of(text):
            own, family = licenses.grams(body), family_of(body)
            can = sum(gains.get(g, 0.0) for g in own) >= need
            dropped += not can
            if family != licenses.NONE:
                assert can
                want[doc_id, first, n] = (family, own, shares_of(body)[:-1].max())
    assert got.keys() == want.keys() and len(got) > 0 and dropped > 0
    for key, (family, own, share) in want.items():
        r = got[key]
        alike = [len(own & licenses.grams(t)) / min(len(own), len(licenses.grams(t))) for t in licenses.TEMPLATES.get(family, [])]
        assert r.probability == pytest.approx(share, abs=1e-5)
        assert r.family == family and r.similarity == pytest.approx(max(alike, default=0), abs=1e-5)
        assert r.confirmed == (family != licenses.UNKNOWN and r.similarity >= 0.6)


def test_wrapped_and_unknown_licences(spark):
    wrapped = "Some project\n\nPermission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files\n \t\nEnd"
    rows = [(1, wrapped), (2, "MPL-2.0"), (3, "Licensed under the EUPL"), (4, "a tale of the sea"), (5, "x\n" * 3000 + "Alle Rechte vorbehalten\n" + "y " * 9000)]
    got = {(r.doc_id, r.paragraph, r.n_lines): (r.family, r.confirmed) for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1, 2, 2] == ("mit", True) and got[2, 0, 1] == ("mpl", True) and got[3, 0, 1] == ("unknown", False)
    assert got[5, 3000, 1] == ("proprietary", True) and not [k for k in got if k[0] == 4]


def test_licence_plan_has_no_python(spark, tables):
    plan = queries.op2_license_paragraphs(spark, tables)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan


def test_licence_odd_documents(spark, odd_docs, no_docs):
    assert licenses.scan(odd_docs).count() == 0 and licenses.scan(no_docs).count() == 0
    rows = spark.createDataFrame([(1, "x\n\nReleased under the MIT License."), (1, "x\n\nReleased under the MIT License."), (None, "!! All rights reserved")], "doc_id long, text string")
    found = sorted(((r.doc_id or 0, r.paragraph, r.family) for r in licenses.scan(rows).collect()))
    assert found == [(0, 0, "proprietary"), (1, 2, "mit"), (1, 2, "mit")]
