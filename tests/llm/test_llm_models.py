"""Quality rules, the quality classifier and toxicity: exact parts by brute force, the rest on held-out labels."""

import random

import numpy as np
import pytest

from faceoff.llm import quality_classifier, quality_rules, toxicity
from faceoff.llm.common import held_out, sample_labelled, table
from test_llm_pairs import ODD_ROWS, ODD_SCHEMA

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD_ROWS, ODD_SCHEMA)


@pytest.fixture(scope="module")
def tables(spark):
    return table(spark, SF, "documents"), table(spark, SF, "labels")


def auc(scored, labels, column):
    rows = scored.join(labels, "doc_id").filter(held_out()).select(column, "score").collect()
    up, down = ([r["score"] for r in rows if r[column] == k] for k in (1, 0))
    return np.mean([(a > b) + 0.5 * (a == b) for a in up for b in down])


# ----------------------------------------------------------- quality rules
def slow_counts(text):
    text, words, word = text or "", [], ""
    for c in text + " ":
        if c in " \t\n\v\f\r":
            words += [word] if word else []
            word = ""
        else:
            word += c
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(5)}
    lines, seen, dup = [x for x in text.split("\n") if x.strip(" \t\n\v\f\r")], set(), 0
    for line in lines:
        dup += line in seen
        seen.add(line)
    return [len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered)]


def test_counts_are_the_definition():
    rng = random.Random(5)
    texts = [None, "", " ", "a b\x1cc d", "a b c d e a b c d e", "x\nx\n x\n\n \n", "a a a a a a", "é# |\r\né# |\r\n"]
    texts += ["".join(rng.choice("ab \n#|é") for _ in range(rng.randint(0, 120))) for _ in range(300)]
    for t in texts:
        assert quality_rules.statistics(t)[0] == slow_counts(t)
    many = " ".join(str(k % 70_000) for k in range(140_000))  # too many words to pack five in a number
    assert quality_rules.statistics(many)[0][4] == 140_000


def test_trees_keep_to_the_signs():
    rng = np.random.default_rng(1)
    x = rng.random((600, 3))
    y = ((x[:, 0] < 0.5) ^ (rng.random(600) < 0.2) ^ (x[:, 1] > 0.8)).astype(float)
    trees = quality_rules.boost(x, y, np.array([-1, 0, 1]))
    grid = np.linspace(0, 1, 60)
    for at in rng.random((30, 3)):
        for f, sign in ((0, -1), (2, 1)):
            line = np.tile(at, (60, 1))
            line[:, f] = grid
            assert (sign * np.diff(trees.margin(line)) >= -1e-9).all()
    assert ((trees.probability(x) > 0.5) == (y > 0.5)).mean() > 0.75


def test_rules_on_labels(tables):
    docs, labels = tables
    trees = quality_rules.fit(docs, labels)
    judged = quality_rules.judge(docs, trees)
    rows = judged.join(labels, "doc_id").filter(held_out()).collect()
    good = [r for r in rows if r["quality"] == 1 and not r["base_failed"]]
    bad = [r for r in rows if r["quality"] == 0]
    assert np.mean([r["kept"] for r in good]) >= 0.97 and np.mean([r["kept"] for r in bad]) <= 0.2
    kept = quality_rules.keep(docs, trees)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in judged.filter("kept").collect()}


def test_rules_on_odd_rows(spark, odd):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    strange = spark.createDataFrame([(1, None, None), (2, 1, 0), (2, 0, 1), (None, 1, 1), (3, 7, 7)], none.schema)
    for labels in (none, strange):
        assert quality_rules.fit(odd, labels) is None
        got = quality_rules.judge(odd, None).collect()
        assert len(got) == len(ODD_ROWS) and not any(r["kept"] for r in got)  # all short, or one word repeated
        for fitted, score in (
            (quality_classifier.fit(odd, labels), quality_classifier.score),
            (toxicity.fit(odd, labels, toxicity.language_model(odd)), toxicity.score),
        ):
            values = {r["score"] for r in score(odd, fitted).collect()}
            assert len(values) == 1 and 0 <= values.pop() <= 1
    assert quality_rules.keep(odd.limit(0), None).count() == 0


# ------------------------------------------------------ quality classifier
def test_indicators_are_the_set_of_grams():
    a, b = quality_classifier.indicators("ab ab cd"), quality_classifier.indicators("ab  ab\ncd")
    assert a.tolist() == b.tolist() and len(a) > 10
    assert len(quality_classifier.indicators(None)) == len(quality_classifier.indicators(" \n")) == 0
    assert len(quality_classifier.indicators("x " * 50_000)) < 20


def test_descent_separates():
    rows = [np.array([k % 2, 2 + k % 5]) for k in range(60)]
    y = np.array([1 if k % 2 else -1 for k in range(60)])
    weight, bias = quality_classifier.descend(rows, np.ones(7), y, np.ones(60))
    assert all(np.sign(weight[r].sum() / np.sqrt(2) + bias) == s for r, s in zip(rows, y))


def test_classifier_on_held_out_labels(tables):
    docs, labels = tables
    scored = quality_classifier.score(docs, quality_classifier.fit(docs, labels))
    assert scored.count() == docs.count()
    assert auc(scored, labels, "quality") > 0.97


# ---------------------------------------------------------------- toxicity
def english():
    words = "the idiot is a stupid person and that moron said it was a thing of trash not worth our time at all".split()
    counts = {}
    for w in words:
        for g in toxicity.grams(w):
            counts[g] = counts.get(g, 0) + 500
    return toxicity.Letters(counts)


@pytest.mark.parametrize("shown,meant", [
    ("1d10t", "idiot"), ("idiooooot", "idiot"), ("m0r0n", "moron"), ("$tupid", "stupid"), ("tr@sh,", "trash"), ("idiot", "idiot"),
    ("the", "the"), ("2024", "2024"), ("58.202.58.158", "58.202.58.158"), ("", ""), ("st*pid", "stupid"),
])
def test_words_are_restored(shown, meant):
    assert toxicity.Restorer(english()).word(shown) == meant


def test_spaced_words_are_joined():
    restorer = toxicity.Restorer(english())
    assert "idiot" in restorer.text("that i d i o t said").split()
    assert "idiot" in restorer.text("1 d 1 0 t").split()
    assert restorer.text("a a a a a a") == "a a a a a a"
    assert restorer.text(None) == ""


def test_decode_is_the_best_path():
    letters, rng = english(), random.Random(6)
    for _ in range(60):
        word = "".join(rng.choice("idot10ras$") for _ in range(rng.randint(1, 6)))
        steps = toxicity._lattice(word)
        paths = [("", 0.0)]
        for step in steps:
            paths = [(p + t, s - c) for p, s in paths for t, c in step]
        price = lambda p: p[1] + sum(map(letters.log, toxicity.grams(p[0])))
        best = max(paths, key=price)
        assert toxicity.decode(steps, letters) == best[0]


def test_toxicity_on_held_out_labels(spark):
    # sf0.01 has only some 45 toxic rows; in these data the junk forms of some toxic documents have lost the toxic words
    docs, labels = table(spark, "/root/testdata/sf0.1", "documents"), table(spark, "/root/testdata/sf0.1", "labels")
    scored = toxicity.score(docs, toxicity.fit(docs, labels, toxicity.language_model(docs)))
    assert scored.count() == docs.count()
    assert auc(scored, labels, "toxic") > 0.93
    rows = scored.join(labels, "doc_id").filter(held_out()).filter("toxic = 0").collect()
    assert sum(r["score"] >= 0.5 for r in rows) <= 0.02 * len(rows)


def test_the_model_keeps_every_trigram(spark):
    rng = random.Random(7)
    words = ["".join(chr(0x4E00 + rng.randrange(3000)) for _ in range(4)) for _ in range(20_000)]  # some 100,000 trigrams
    words += ["the", "thing"] * 50
    docs = spark.createDataFrame([(" ".join(words[k::40]),) for k in range(40)], "text string")
    letters, counts = toxicity.language_model(docs), {}
    for w in words:
        for g in toxicity.grams(w):
            counts[g] = counts.get(g, 0) + 1
    assert len(counts) > 60_000

    def price(gram):
        total = lambda f: sum(n for g, n in counts.items() if f(g))
        low = (total(lambda g: g[2] == gram[2]) + 1) / (sum(counts.values()) + len({g[2] for g in counts}) + 1)
        mid = (total(lambda g: g[1:] == gram[1:]) + 5 * low) / (total(lambda g: g[1] == gram[1]) + 5)
        return np.log((counts.get(gram, 0) + 5 * mid) / (total(lambda g: g[:2] == gram[:2]) + 5))

    for gram in [*rng.sample(sorted(counts), 25), "^^t", "the", "thx", "zzz"]:
        assert letters.log(gram) == pytest.approx(price(gram))


@pytest.mark.parametrize("shown", [
    "that i d i o t. said", "that 'i d i o t' said", "that i.d.i.o.t said", "that i-d-i-o-t said", "that i_d_i_o_t, said", "that i*d*i*o*t said",
    "that id iot said", "that id iot. said", "that i di ot said", "that iddiot said", "that iddiiot! said",
])
def test_every_form_is_evidence(shown):
    scorer = toxicity.Scorer(english(), {"=idiot": 0.9})
    assert scorer.measure(shown)[0] == 0.9
    assert scorer.measure("that person said it was a thing of trash, 1.2.3 or a.b")[0] == 0.0


def test_a_long_line_of_letters_is_one_pass():
    scorer = toxicity.Scorer(english(), {"=idiot": 0.9})
    assert scorer.measure("i, d, i, o, t. " * 2000)[0] == 0.9


@pytest.mark.parametrize("shown", ["id i o t", "id-iot", "idi.ot", "i-di-ot", "i..... d..... i..... o..... t.....", "ｉｄｉｏｔ",
                                   "idiót", "idіot", "id\u200biot", "«idi-ot»"])
def test_hidden_forms_are_evidence(shown):
    scorer = toxicity.Scorer(english(), {"=idiot": 0.9})
    assert scorer.measure(f"you are an {shown} today")[0] == 0.9
    assert scorer.measure("an id in a lot of idioms, i-d and idiosyncrasy")[0] == 0.0


def test_labelled_rows_are_bounded(spark):
    docs = spark.createDataFrame([(k % 40, f"text {k}") for k in range(500)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(40)], "doc_id long, quality int")
    rows = sample_labelled(docs, labels, "quality", 40).collect()
    assert 0 < len(rows) <= 40 and len(set(r["text"] for r in rows)) == len(rows)
    assert sorted(map(tuple, rows)) == sorted(map(tuple, sample_labelled(docs.repartition(7), labels, "quality", 40).collect()))
    assert sample_labelled(docs, labels, "quality", 5).count() == 5
