"""Classes of all words of the head by their contexts, and scores against brute force."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

pytest.importorskip("terrace.llm")

from terrace.llm import class_lm  # noqa: E402
from terrace.llm.hashing import words_of  # noqa: E402

SETTINGS = {"unit_words": 8, "classes": 6, "sweeps": 4}


def corpus(seed=3, size=300):
    """Sentences of a toy grammar, so that words of one kind share their contexts and not their spelling."""
    dice = random.Random(seed)
    nouns = ["cat", "elephant", "x1", "moonlight", "o", "table", "AB"]
    verbs = ["ran", "contemplates", "z", "is", "jumped99"]
    signs = ["the", "a", "every"]
    one = lambda: f"{dice.choice(signs)} {dice.choice(nouns)} {dice.choice(verbs)}"
    rows = [(i, " ".join(one() for _ in range(dice.randrange(6)))) for i in range(size)]
    return [*rows, (size, None), (size + 1, ""), rows[1], rows[1], (None, rows[2][1]), (size + 2, "unseen words the cat"), (size + 3, "ran ran ran")]


def tokens(text):
    return [*"".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").split(), None]


def kind(model, word):
    """The class that the model gives a word; None is the end token."""
    if word is None:
        return model.classes.end
    found = words_of([word])
    at = np.flatnonzero(model.classes.words == found.value[0])
    return int(model.classes.of_word[at[0]] if len(at) else model.classes.of_shape[class_lm.shape_of(found)[0]])


@pytest.mark.parametrize("head_words", [0, 6, 12, 1_000])
def test_scores_equal_brute_force(spark, head_words):
    rows = corpus()
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    learnt = frame.where("doc_id % 3 <> 0").select("text")
    model, counts = class_lm.train_class_model(learnt, head_words=head_words, **SETTINGS)
    train = [tokens(t) for i, t in rows if i is not None and i % 3 != 0]
    seen, pairs, of = Counter(w for t in train for w in t), Counter(), {}
    for w in {w for _, t in rows for w in tokens(t)}:
        of[w] = kind(model, w)
    for t in train:
        pairs.update(zip([of[None], *(of[w] for w in t)], (of[w] for w in t)))
    leaves, said, kinds = Counter(), Counter(), Counter(of[w] for w in seen)
    for (a, _), n in pairs.items():
        leaves[a] += n
    for w, n in seen.items():
        said[of[w]] += n
    number, half = SETTINGS["classes"], class_lm.SMOOTH

    def score(text):
        total, before = 0.0, of[None]
        for w in tokens(text):
            now = of[w]
            total += math.log10((pairs[before, now] + half) / (leaves[before] + half * number))
            total += math.log10((seen[w] + half) / (said[now] + half * (kinds[now] + 1)))
            before = now
        return total

    want = defaultdict(list)
    for i, t in rows:
        want[i].append(pytest.approx(score(t)))
    got = class_lm.score_documents(frame, model, counts).collect()
    assert len(got) == len(rows) and all(r.score == want[r.doc_id][0] for r in got)


def test_each_word_goes_to_its_best_class(spark):
    rows = corpus()
    texts = spark.createDataFrame(rows, "doc_id long, text string").repartition(4).select("text")
    words = sorted({w for _, t in rows for w in tokens(t)} - {None})
    values = words_of(words).value
    order = np.argsort(values)
    dice = np.random.default_rng(1)
    of = dict(zip(words, dice.integers(0, 5, len(words)).tolist()))
    classes = class_lm.Classes(values[order], np.array([of[words[i]] for i in order]), np.zeros(class_lm.SHAPES, dtype=np.int64), 5, 6)

    def between(of):
        out = np.zeros((6, 6))
        for _, t in rows:
            line = [5, *(5 if w is None else of[w] for w in tokens(t))]
            np.add.at(out, (line[:-1], line[1:]), 1)
        return out

    contexts = class_lm.class_contexts(texts, classes)
    assert (class_lm.class_bigrams(contexts, 6) == between(of)).all()
    assert (class_lm.class_bigrams(class_lm.class_contexts(texts, classes, words=False), 6) == between(of)).all()
    moved = class_lm.best_classes(contexts, classes, between(of))
    for place, i in enumerate(order):
        gains = [class_lm.information(between({**of, words[i]: c})) for c in range(6)]
        assert gains[moved[place]] == pytest.approx(max(gains))


def test_sweeps_over_the_head_raise_the_likelihood(spark):
    """Only the three signs and the shapes are units; a sweep that would lower the likelihood is not taken."""
    rows = corpus()
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    result = []
    for sweeps in (0, 1, 3):
        model, counts = class_lm.train_class_model(frame.select("text"), head_sweeps=sweeps, **{**SETTINGS, "unit_words": 3})
        pairs = np.zeros((6, 6))
        for _, t in rows:
            line = [kind(model, w) for w in [None, *tokens(t)]]
            np.add.at(pairs, (line[:-1], line[1:]), 1)
        result.append(class_lm.information(pairs))
    assert result[0] < result[1] <= result[2] + 1e-9


def test_no_training_texts(spark):
    frame = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    got = class_lm.class_scores(frame, frame.doc_id > 5).collect()
    assert {(r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got} == {(1, 3, 0, 0, 0.0), (2, 1, 0, 0, 0.0)}


def test_texts_are_read_twice(spark):
    """For the word counts, and to be written as codes; sweeps and scores read codes (the texts were read four times here, six times in longer runs)."""
    frame = spark.createDataFrame(corpus(), "doc_id long, text string").repartition(3)
    read = spark.sparkContext.accumulator(0)

    def told(frames):
        for rows in frames:
            read.add(len(rows))
            yield rows

    texts = frame.mapInPandas(told, frame.schema)
    got = class_lm.class_scores(texts, class_lm.F.lit(True), **SETTINGS).collect()
    assert len(got) == frame.count() and read.value == 2 * frame.count()


def test_large_ids_beside_none(spark):
    """A batch of ids with a null among them once went through doubles."""
    big = (1 << 53) + 1
    frame = spark.createDataFrame([(big, "a b"), (None, "a"), (big + 2, "b c c")], "doc_id long, text string").coalesce(1)
    got = class_lm.class_scores(frame, class_lm.F.lit(True), **SETTINGS).collect()
    assert {(r.doc_id, r.n_tokens, r.n_known) for r in got} == {(big, 3, 3), (None, 2, 2), (big + 2, 4, 4)}


@pytest.mark.parametrize("number", [2, 5, 12])
def test_many_words_are_placed_as_one_by_one(number):
    dice = np.random.default_rng(number)
    line = dice.integers(0, 30, 3_000)
    of = np.r_[dice.integers(0, number, 28), 0, 0]
    own, after, before, itself, want = [], [], [], [], []
    kinds = of[line]
    between = np.zeros((number, number))
    np.add.at(between, (kinds[:-1], kinds[1:]), 1)
    for word in range(31):  # the last is in no text
        follow, lead = kinds[1:][(line[:-1] == word) & (line[1:] != word)], kinds[:-1][(line[1:] == word) & (line[:-1] != word)]
        a, b = np.bincount(follow, minlength=number).astype(float), np.bincount(lead, minlength=number).astype(float)
        twice, home = float(((line[:-1] == word) & (line[1:] == word)).sum()), int(of[word]) if word < 30 else 1
        rest = between.copy()
        rest[home] -= a
        rest[:, home] -= b
        rest[home, home] -= twice
        value = class_lm.placement_values(rest, a, b, twice)
        best = int(value.argmax())
        want.append(best if value[best] > value[home] + 1e-9 else home)
        own, after, before, itself = [*own, home], [*after, a], [*before, b], [*itself, twice]
    got = class_lm.best_places(between, np.array(own), np.array(after), np.array(before), np.array(itself))
    assert got.tolist() == want and (got != own).any()


def test_contexts_by_any_number_of_classes(spark):
    """Slots of a group need more than two bytes from 128 classes on; several rows of a group add up."""
    rows = [(i, f"w{i % 300} w{i % 7} w{i % 300} w{i % 300}") for i in range(900)]
    texts = spark.createDataFrame(rows, "doc_id long, text string").repartition(4).select("text")
    words = np.sort(words_of([f"w{i}" for i in range(300)]).value)
    classes = class_lm.Classes(words, np.arange(300) % 150, np.zeros(class_lm.SHAPES, dtype=np.int64), 150, 151)
    between = class_lm.class_bigrams(class_lm.class_contexts(texts, classes), 151)
    assert between.sum() == 900 * 5
    table = np.zeros((512, 303))
    for r in class_lm.class_contexts(texts, classes).where("words >= 0").collect():
        slots = np.frombuffer(r["slots"], dtype=np.uint32)
        np.add.at(table.reshape(-1), r["words"] * 256 * 303 + slots.astype(np.int64), class_lm.unpacked(r["counts"], len(slots)))
    assert table[:, :151].sum() == table[:, 151:302].sum() == 900 * 4 and not table[300:].any()
    moved = class_lm.best_classes(class_lm.class_contexts(texts, classes), classes, between)
    assert len(moved) == 300 and ((moved >= 0) & (moved < 151)).all()
