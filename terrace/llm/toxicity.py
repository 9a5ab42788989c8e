"""Toxicity by weak supervision: many voters, a model of the voters, a linear classifier.

Voters look for insults, vulgar words, threats, patterns that address somebody, shouting
and repetition, and, learned from the training labels, for words and beginnings of words
that hardly any but toxic documents hold (near copies of one document count once); one voter
says clean where nothing was found. A given label is one more voter.
The label model is a mixture of two classes, fitted by
expectation maximisation, in which each voter has its own chances of voting toxic, clean or
not at all in either class. Voters that agree more than the classes explain are correlated:
their weights shrink by the sum of their correlations, so that five views of one word do not
count five times. A logistic regression on voters and densities then learns the posterior
labels and scores whole texts; it needs no label.

Fitting sees a bounded, documented sample; scoring is a map over all rows without a shuffle.

Defined results: null and empty texts get the score of a text without any finding. Null
labels are unused. Repeated rows get equal scores. Without training rows all scores are 0.5,
which says nothing of a text: ``without_toxic`` then keeps every document.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.llm.hashing import chunks, mix, words_of
from terrace.llm.labelled import MOST_LABELS, collected, labelled_sample
from terrace.llm.tables import stored

# Words by kind.
LEXICON = {
    "stupid": "stupid idiot idiotic idiots moron morons moronic dumb dumbass imbecile fool foolish brainless dimwit halfwit retard retarded cretin dunce".split(),
    "worthless": "worthless useless pathetic loser losers failure garbage trash rubbish waste nobody joke clown clowns".split(),
    "filth": "scum filth filthy vermin disgusting gross revolting repulsive vile sewage slime maggot parasite rat pig swine".split(),
    "vulgar": "damn crap shit shitty bullshit fuck fucking fucker bitch bastard asshole ass dick prick slut whore".split(),
    "threat": "kill die hurt destroy beat murder hang burn punish smash".split(),
    "hate": "hate hateful despise loathe detest ugly evil monster freak creep".split(),
    "silence": "shut shutup silence begone getlost".split(),
    "other_languages": "idiota estúpido imbécil basura asqueroso inútil payaso escoria idiote stupide crétin ordure dégoûtant nul raté pourriture dumm dummkopf idiotin trottel abschaum müll wertlos ekelhaft versager".split(),
}
STRONG = ("stupid", "worthless", "filth", "vulgar", "other_languages")
ADDRESS = "you your youre ur u yourself tu du sie vous usted".split()
VOTERS = (*LEXICON, "two_kinds", "strong_any", "strong_twice", "strong_dense", "addressed", "shouted", "mined_any", "mined_twice", "mined_often", "nothing")
DENSITIES = (*[f"log_{k}" for k in LEXICON], "log_mined", "strong_share", "log_words")

#: Units learned from labels: whole words, and beginnings of words of so many bytes.
BEGINNINGS = (4, 5, 6, 7)
MOST_MINED = 400
_LETTERS_ONLY = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in range(256))


def _values(words: list[str]) -> np.ndarray:
    return np.sort(words_of([" ".join(words)]).value)


def _among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(values), dtype=bool)
    at = np.minimum(np.searchsorted(known, values), len(known) - 1)
    return known[at] == values


@dataclass
class Voters:
    """What the voters look for, as sorted word values."""

    mined: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=np.uint64))
    kinds: dict[str, np.ndarray] = field(default_factory=lambda: {k: _values(w) for k, w in LEXICON.items()})
    address: np.ndarray = field(default_factory=lambda: _values(ADDRESS))

    def __call__(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(votes, densities): votes are 1 toxic, -1 clean, 0 none."""
        n = len(texts)
        found = _letters(texts)
        count = np.diff(found.bounds)
        which = np.repeat(np.arange(n), count)
        tally = lambda hit: np.bincount(which[hit], minlength=n)
        place = np.flatnonzero(_among(found.value, np.sort(np.concatenate([*self.kinds.values()]))))
        value = found.value[place]
        hits = {k: place[_among(value, known)] for k, known in self.kinds.items()}
        told = _among(found.value, self.mined)
        for size in BEGINNINGS if len(self.mined) else ():
            told |= _among(found.prefix(size), self.mined)
        mined = np.flatnonzero(told)
        by_kind = {k: tally(h) for k, h in hits.items()}
        strong_places = np.sort(np.concatenate([hits[k] for k in STRONG])) if n else place
        strong = tally(strong_places)
        near = np.zeros(len(strong_places), dtype=bool)
        for step in range(1, 5):
            before = np.maximum(strong_places - step, 0)
            near |= (which[before] == which[strong_places]) & _among(found.value[before], self.address) if len(strong_places) else near
        upper = self._upper(texts, found, strong_places)
        mined_n = tally(mined)
        few = np.maximum(count, 1)
        votes = np.stack(
            [
                *[(by_kind[k] > 0) for k in LEXICON],
                sum(c > 0 for c in by_kind.values()) >= 2,
                strong > 0,
                strong >= 2,
                strong / few > 0.002,
                tally(strong_places[near]) > 0,
                tally(strong_places[upper]) > 0,
                mined_n > 0,
                mined_n >= 2,
                mined_n >= 4,
                np.zeros(n, dtype=bool),
            ],
            axis=1,
        ).astype(np.int8)
        votes[:, -1] = -((strong == 0) & (mined_n == 0)).astype(np.int8)
        densities = np.stack([*[np.log1p(by_kind[k]) for k in LEXICON], np.log1p(mined_n), np.minimum(1, 100 * strong / few), np.log1p(count)], axis=1)
        return votes, densities

    @staticmethod
    def _upper(texts, found, places) -> np.ndarray:
        """Whether the words at the places stand in capitals."""
        if not len(places):
            return np.zeros(0, dtype=bool)
        data = np.frombuffer(b" " + b" ".join(b"" if t is None else t.encode("utf-8") for t in texts) + b" ", dtype=np.uint8)
        return np.array([bytes(data[found.begin[p] : found.end[p]]).isupper() for p in places.tolist()], dtype=bool)


@dataclass
class LabelModel:
    """Two classes; chance[c, voter, vote + 1] of each vote; weight of each voter; share of toxic; how often the given labels are right."""

    chance: np.ndarray
    weight: np.ndarray
    prior: float
    label_accuracy: float = 0.95

    def posterior(self, votes: np.ndarray, said: np.ndarray) -> np.ndarray:
        """``said`` is the given label, 1 or 0."""
        ratio = np.log(self.chance[1] / self.chance[0])
        ratio[:, 1] = 0  # not finding anything is no evidence; one voter says so explicitly
        each = ratio[np.arange(votes.shape[1]), votes + 1]
        label = np.log(self.label_accuracy / (1 - self.label_accuracy)) * (2 * said - 1)
        return 1 / (1 + np.exp(-(np.log(self.prior / (1 - self.prior)) + label + each @ self.weight)))


def fit_label_model(votes: np.ndarray, said: np.ndarray, rounds: int = 30, smooth: float = 1.0) -> LabelModel:
    """Expectation maximisation from the given labels; accuracies and correlations are estimated anew in each round."""
    votes, toxic = votes.astype(np.int64), 0.05 + 0.9 * said
    width = votes.shape[1]
    model = LabelModel(np.full((2, width, 3), 1 / 3), np.ones(width), float((said.sum() + smooth) / (len(said) + 2 * smooth)))
    for _ in range(rounds):
        for c, part in ((0, 1 - toxic), (1, toxic)):
            counts = np.stack([((votes == v) * part[:, None]).sum(axis=0) for v in (-1, 0, 1)], axis=1) + smooth
            model.chance[c] = counts / counts.sum(axis=1, keepdims=True)
        mean = model.chance[:, :, 2] - model.chance[:, :, 0]
        rest = votes - (toxic[:, None] * mean[1] + (1 - toxic)[:, None] * mean[0])  # what the classes leave unexplained
        spread = np.sqrt((rest**2).mean(axis=0) + 1e-9)
        related = np.abs(rest.T @ rest / len(votes) / np.outer(spread, spread))
        related[related < 0.1] = 0
        np.fill_diagonal(related, 1)
        model.weight = 1 / related.sum(axis=1)
        model.label_accuracy = float(np.clip((toxic * said + (1 - toxic) * (1 - said)).mean(), 0.8, 0.99))
        toxic = model.posterior(votes, said)
    return model


def fit_linear(rows: np.ndarray, target: np.ndarray, ridge: float = 1.0, rounds: int = 25) -> np.ndarray:
    """Logistic regression on soft labels by Newton steps; the last weight is the constant."""
    x = np.c_[rows, np.ones(len(rows))]
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p) + 1e-6)[:, None]).T @ x + np.diag(penalty), x.T @ (target - p) - penalty * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


@dataclass
class Toxicity:
    voters: Voters
    linear: np.ndarray | None

    def score(self, texts: list[str | None]) -> np.ndarray:
        votes, densities = self.voters(texts)
        if self.linear is None:
            return np.full(len(texts), 0.5)
        return 1 / (1 + np.exp(-np.clip(np.c_[votes, densities, np.ones(len(texts))] @ self.linear, -50, 50)))


def _letters(texts: list[str | None]):
    return words_of(texts, raw=[b"" if t is None else t.encode("utf-8").translate(_LETTERS_ONLY) for t in texts])


def one_per_family(sample: DataFrame) -> DataFrame:
    """One document of those whose least hash of three words is the same: copies, and most near copies."""

    def add(frames):
        for frame in chunks(frames):
            found, family = _letters(frame["text"].tolist()), []
            for i in range(len(frame)):
                v = found.value[found.of(i)]
                least = mix(v[:-2] * np.uint64(3) + mix(v[1:-1] * np.uint64(5) + v[2:])).min() if len(v) > 2 else v.sum()
                family.append(int(least.astype(np.int64)))
            yield pd.DataFrame({"id": frame["_id"], "text": frame["text"], "label": frame["label"], "family": family})

    marked = sample.mapInPandas(add, "id long, text string, label int, family long")
    return marked.groupBy("family").agg(F.max_by(F.struct("text", "label"), F.struct("label", "id")).alias("one")).select("one.*")


def mined_units(families: DataFrame, least: int = 4, least_share: float = 0.01, purity: float = 0.9, most: int = MOST_MINED) -> np.ndarray:
    """Words and beginnings of words that enough toxic documents hold, and nearly no others."""

    def count(frames):
        for frame in chunks(frames):
            found = _letters(frame["text"].tolist())
            which = np.repeat(np.arange(len(frame), dtype=np.int64), np.diff(found.bounds))
            units = np.concatenate([found.value, *[found.prefix(size) for size in BEGINNINGS]])
            pairs = np.unique(np.stack([units.astype(np.int64), np.tile(which, len(BEGINNINGS) + 1)], axis=1), axis=0)
            unit, place = np.unique(pairs[:, 0], return_inverse=True)
            toxic = np.bincount(place, frame["label"].to_numpy()[pairs[:, 1]], len(unit)).astype(np.int64)
            yield pd.DataFrame({"unit": unit, "toxic": toxic, "all": np.bincount(place, minlength=len(unit))})

    toxic_documents = families.where("label = 1").count()
    counts = families.mapInPandas(count, "unit long, toxic long, all long").groupBy("unit").agg(F.sum("toxic").alias("toxic"), F.sum("all").alias("all"))
    good = counts.where((F.col("toxic") >= max(least, least_share * toxic_documents)) & (F.col("toxic") >= purity * F.col("all")) & (F.col("unit") != 0))
    found = good.orderBy(F.desc("toxic"), "unit").limit(most).collect()
    return np.sort(np.array([r["unit"] for r in found], dtype=np.int64).astype(np.uint64))


def train_toxicity(documents: DataFrame, labels: DataFrame, label: str, learn: Column, most_labels: int = MOST_LABELS, doc_id: str = "doc_id", text: str = "text") -> Toxicity:
    sample = stored(labelled_sample(documents, labels, label, learn, most_labels, doc_id, text), "labelled")
    voters = Voters(mined=mined_units(stored(one_per_family(sample), "families")))

    def vote(frames):
        for frame in chunks(frames):
            votes, densities = voters(frame["text"].tolist())
            yield pd.DataFrame({"id": frame["_id"], "label": frame["label"], "votes": [v.tobytes() for v in votes], "densities": [d.tobytes() for d in densities]})

    found = collected(sample.mapInPandas(vote, "id long, label int, votes binary, densities binary"))
    if found.empty:
        return Toxicity(voters, None)
    votes = np.array([np.frombuffer(v, dtype=np.int8) for v in found["votes"]])
    densities = np.array([np.frombuffer(d) for d in found["densities"]])
    said = found["label"].to_numpy(dtype=np.int64)
    model = fit_label_model(votes, said)
    return Toxicity(voters, fit_linear(np.c_[votes, densities], model.posterior(votes.astype(np.int64), said)))


def toxicity_scores(documents: DataFrame, model: Toxicity, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score) of every row."""

    def score(frames):
        for frame in chunks(frames):
            yield pd.DataFrame({"doc_id": frame["doc_id"], "score": model.score(frame["text"].tolist())})

    return documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInPandas(score, "doc_id long, score double")


def without_toxic(documents: DataFrame, model: Toxicity, most: float = 0.5, text: str = "text") -> DataFrame:
    """The documents, all columns, whose score is below ``most``; all of them if the model could not be trained."""
    if model.linear is None:
        return documents

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(np.concatenate([model.score(part["text"].tolist()) for part in chunks([pd.DataFrame({"text": texts})])] or [np.zeros(0)]))

    return documents.where(score(F.col(text)) < most)
