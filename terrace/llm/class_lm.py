"""Language-model scores of documents: a class-based bigram model, classes by exchange.

P(text) is the product over its tokens of P(class | class before) and P(word | class). Exchange
clustering moves one word after another to the class that most raises the likelihood of the
corpus' class bigrams, in two steps. First the most frequent words, with one unit for each
shape (length and last byte) of all others, on a matrix that fits the driver, until a sweep
changes nothing or the sweeps are over. Then all words of the head: Spark sums, per word, which
classes stand before and after it, and each word goes to its best class; the classes of the
sweep with the highest likelihood stay. Words beyond the head, rarer than all in it, and words
that training has not seen are in the class of their shape, which is clustered by its contexts.
All words of the training documents count: word counts, contexts and class sizes cover every token.

Texts are read twice: for the word counts, and to write every text as codes, a word's place in the head or else its
shape. Units, classes and scores are tables over codes, so all further readings are of codes and look nothing up.

What a task holds is bounded: the head of the vocabulary (``head_words`` words and counts,
broadcast, 16 bytes each), a matrix over units, and a few megabytes of text. Counts of
words beyond the head stay in a table; a document's words beyond the head meet it by a join
on the word, each different word once per document. The driver holds the unit matrix and the
head, whose sizes are parameters and not the corpus'.

Defined results: null and empty texts are one end token. Repeated rows get equal scores.
Without training documents all smoothed chances are uniform and the base score is 0. An
empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from terrace.llm.hashing import Words, chunks, words_of
from terrace.llm.tables import stored

HEAD_WORDS = 1 << 18
UNIT_WORDS = 1_024
CLASSES = 64
SWEEPS = 8
HEAD_SWEEPS = 2
#: Words that one group of the exchange over the head holds.
GROUP_WORDS = 256
#: Words that one task of it places, about.
TASK_WORDS = 4_096
SHAPES = 64
#: The value of the end token; no word's, but for a chance of 2^-64.
END = np.uint64(0x454E44)
FLUSH = 1_000_000
#: Contexts that a task sorts at once.
SORTED_KEYS = 1 << 22
#: Units whose counts travel in one row.
BLOCK_UNITS = 64
SMOOTH = 0.5
#: The code of the end token; words of the head have their place, others -1 - shape.
END_CODE = -1 - SHAPES
#: ``rest`` has a text's words beyond the head, each once, and ``times`` how often it holds them.
CODED = "row long, codes binary, rest array<long>, times array<long>"


def shape_of(found: Words) -> np.ndarray:
    length = np.minimum((found.end - found.begin - 1) // 2, 7)
    return length * 8 + (found.data[found.end - 1] & 7)


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, shape, n) over all texts, the end token included."""

    def count(frames):
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        size = 0

        def merged():
            word, shape, n = (np.concatenate(x) for x in zip(*held, strict=True))
            keys, first, place = np.unique(word, return_index=True, return_inverse=True)
            return keys, shape[first], np.bincount(place, n, len(keys)).astype(np.int64)

        def rows(part):
            return pd.DataFrame({"word": part[0].astype(np.int64), "shape": part[1].astype(np.int32), "n": part[2]})

        for frame in chunks(frames):
            found = words_of(frame["text"].tolist())
            keys, first, n = np.unique(found.value, return_index=True, return_counts=True)
            shape = shape_of(found)[first]
            held.append((np.r_[keys, END], np.r_[shape, 0], np.r_[n, len(frame)]))
            size += len(keys)
            if size > FLUSH:
                held = [merged()]
                size = len(held[0][0])
                if size > FLUSH // 2:
                    yield rows(held[0])
                    held, size = [], 0
        if held:
            yield rows(merged())

    return texts.mapInPandas(count, "word long, shape int, n long").groupBy("word").agg(F.max("shape").alias("shape"), F.sum("n").alias("n"))


def codes_of(found: Words, texts: int, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all texts, an end after each; and which of the words are beyond the head."""
    code = -1 - shape_of(found).astype(np.int32)
    beyond = np.ones(len(code), dtype=bool)
    if len(words):
        at = np.minimum(np.searchsorted(words, found.value), len(words) - 1)
        beyond = words[at] != found.value
        code = np.where(beyond, code, at.astype(np.int32))
    out = np.full(len(code) + texts, END_CODE, dtype=np.int32)
    keep = np.ones(len(out), dtype=bool)
    keep[found.bounds[1:] + np.arange(texts)] = False
    out[keep] = code
    return out, beyond


def by_code(of_head: np.ndarray, of_end: float, of_shape: np.ndarray) -> np.ndarray:
    """A table over codes; negative ones count from its end."""
    return np.r_[of_head, of_end, of_shape[::-1]]


def encoded(texts: DataFrame, words: np.ndarray) -> DataFrame:
    """The columns beside ``text``, and every text as codes by the head's sorted ``words``."""
    others = [f.name for f in texts.schema if f.name != "text"]
    sent = texts.sparkSession.sparkContext.broadcast(words)

    def encode(batches):
        head, row = sent.value, TaskContext.get().partitionId() << 40
        for batch in batches:
            whole = pd.DataFrame({"text": pd.Series(batch.column("text").to_pylist(), dtype=object)})
            for frame in chunks([whole]):
                n = len(frame)
                found = words_of(frame["text"].tolist())
                codes, beyond = codes_of(found, n, head)
                bounds = found.bounds + np.arange(n + 1)
                doc, word = np.repeat(np.arange(n), np.diff(found.bounds))[beyond], found.value[beyond].astype(np.int64)
                order = np.lexsort((word, doc))
                doc, word = doc[order], word[order]
                first = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (word[1:] != word[:-1])][: len(doc)])
                lists = pa.array(np.searchsorted(doc[first], np.arange(n + 1)).astype(np.int32))
                own = [
                    pa.array(row + np.arange(n)),
                    pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer((4 * bounds).astype(np.int32)), pa.py_buffer(codes)]),
                    pa.ListArray.from_arrays(lists, pa.array(word[first])),
                    pa.ListArray.from_arrays(lists, pa.array(np.diff(np.r_[first, len(doc)]).astype(np.int64))),
                ]
                kept = batch.slice(int(frame.index[0]), n)
                yield pa.RecordBatch.from_arrays([kept.column(name) for name in others] + own, names=[*others, "row", "codes", "rest", "times"])
                row += n

    schema = StructType([f for f in texts.schema if f.name != "text"] + StructType.fromDDL(CODED).fields)
    return texts.mapInArrow(encode, schema)


def sequence(codes: list[bytes]) -> np.ndarray:
    """Codes of texts one after another, each between end tokens."""
    return np.r_[np.int32(END_CODE), np.frombuffer(b"".join(codes), dtype=np.int32)]


def packed(counts: np.ndarray) -> bytes:
    """Whole numbers in as many bytes each as the largest needs."""
    return counts.astype(np.min_scalar_type(int(counts.max(initial=0)))).tobytes()


def unpacked(data: bytes, size: int) -> np.ndarray:
    return np.frombuffer(data, dtype=f"u{len(data) // size}")


def unit_bigrams(coded: DataFrame, unit: np.ndarray, size: int) -> np.ndarray:
    """counts[before, unit] over all texts; ``unit`` has the unit of every code."""
    sent = coded.sparkSession.sparkContext.broadcast(unit)

    def count(frames):
        own, total = sent.value, np.zeros(size * size, dtype=np.int64)
        for frame in frames:
            units = own[sequence(frame["codes"].tolist())]
            total += np.bincount(units[:-1] * size + units[1:], minlength=size * size)
        blocks = [(first, total[first * size : (first + BLOCK_UNITS) * size]) for first in range(0, size, BLOCK_UNITS)]
        blocks = [(first, block) for first, block in blocks if block.any()]
        yield pd.DataFrame({"before": [first for first, _ in blocks], "counts": [packed(block) for _, block in blocks]})

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        first = rows["before"].iloc[0]
        total = np.zeros(size * min(BLOCK_UNITS, size - first), dtype=np.int64)
        for counts in rows["counts"]:
            total += unpacked(counts, len(total)).astype(np.int64)
        return pd.DataFrame({"before": [first], "counts": [packed(total)]})

    # Two steps of sums: no task holds more than some hundred rows of a block.
    partial = coded.select("codes").mapInPandas(count, "before long, counts binary").withColumn("part", F.pmod(F.xxhash64("counts"), F.lit(64)))
    once = partial.groupBy("before", "part").applyInPandas(add, "before long, counts binary")
    out = np.zeros((size, size), dtype=np.int64)
    for row in once.groupBy("before").applyInPandas(add, "before long, counts binary").collect():
        block = out[row["before"] : row["before"] + BLOCK_UNITS]
        block[:] = unpacked(row["counts"], block.size).reshape(block.shape)
    return out


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def placement_values(between: np.ndarray, after: np.ndarray, before: np.ndarray, itself: float) -> np.ndarray:
    """What each class would gain by a word that stands in none: ``after`` and ``before`` count the classes next to it
    without itself, ``itself`` how often it follows itself."""
    out, into, both = between.sum(axis=1), between.sum(axis=0), between.diagonal()
    right, left = np.flatnonzero(after), np.flatnonzero(before)
    gain = _xlogx(between[:, right] + after[right]) - _xlogx(between[:, right])
    gain_in = _xlogx(between[left].T + before[left]) - _xlogx(between[left].T)
    value = gain.sum(axis=1) + gain_in.sum(axis=1)
    value[right] -= gain[right, np.arange(len(right))]
    value[left] -= gain_in[left, np.arange(len(left))]
    value += _xlogx(both + after + before + itself) - _xlogx(both)
    value -= _xlogx(out + after.sum() + itself) - _xlogx(out) + _xlogx(into + before.sum() + itself) - _xlogx(into)
    return value


def best_places(between: np.ndarray, own: np.ndarray, after: np.ndarray, before: np.ndarray, itself: np.ndarray) -> np.ndarray:
    """The best class of each of many words, which stand in ``own``: ``placement_values`` for all at once.

    Every word has a line in ``after`` and ``before``, without itself. What it leaves behind differs from ``between`` only
    in the row and the column of its own class, so only these are computed anew.
    """
    line, fixed = np.arange(len(own)), _xlogx(between)
    follow, lead = after.sum(axis=1), before.sum(axis=1)
    out, into = between.sum(axis=1) - before, between.sum(axis=0) - after
    out[line, own] -= follow + itself
    into[line, own] -= lead + itself
    both = np.tile(between.diagonal(), (len(own), 1))
    both[line, own] -= after[line, own] + before[line, own] + itself
    value = _xlogx(both + after + before + itself[:, None]) - _xlogx(both)
    value -= _xlogx(out + (follow + itself)[:, None]) - _xlogx(out) + _xlogx(into + (lead + itself)[:, None]) - _xlogx(into)
    for side, other, rest, known in ((after, before, between.T, fixed.T), (before, after, between, fixed)):
        word, beside = np.nonzero(side)
        if not len(word):
            continue
        n, each, home = side[word, beside], np.arange(len(word)), own[word]
        left, low = rest[beside], known[beside]
        same = np.flatnonzero(beside == home)
        left[each, home] -= n
        left[same] -= other[word[same]]
        low[each, home] = _xlogx(left[each, home])
        low[same] = _xlogx(np.maximum(left[same], 0))
        gain = _xlogx(left + n[:, None]) - low
        gain[each, beside] = 0
        found, first = np.unique(word, return_index=True)
        value[found] += np.add.reduceat(gain, first, axis=0)
    best = value.argmax(axis=1)
    return np.where(value[line, best] > value[line, own] + 1e-9, best, own)


def information(between: np.ndarray) -> float:
    """The part of the corpus' log likelihood that the classes decide."""
    return float(_xlogx(between).sum() - _xlogx(between.sum(axis=1)).sum() - _xlogx(between.sum(axis=0)).sum())


def exchange(bigrams: np.ndarray, classes: int = CLASSES, sweeps: int = SWEEPS) -> np.ndarray:
    """A class for every unit, so that the mutual information of class bigrams is high."""
    n = len(bigrams)
    counts = bigrams.astype(float)
    often = np.argsort(-counts.sum(axis=0), kind="stable")
    of = np.empty(n, dtype=np.int64)
    of[often] = np.arange(n) % classes
    member = np.eye(classes)[of]
    between = member.T @ counts @ member
    for _ in range(sweeps):
        moved = 0
        for unit in often.tolist():
            own, itself = of[unit], counts[unit, unit]
            after, before = counts[unit] @ member, counts[:, unit] @ member
            if not after.any() and not before.any():
                continue
            after[own] -= itself
            before[own] -= itself
            between[own] -= after
            between[:, own] -= before
            between[own, own] -= itself
            value = placement_values(between, after, before, itself)
            best = int(value.argmax())
            if value[best] <= value[own] + 1e-9:
                best = own
            moved += best != own
            of[unit] = best
            member[unit] = 0
            member[unit, best] = 1
            between[best] += after
            between[:, best] += before
            between[best, best] += itself
        if not moved:
            break
    return of


@dataclass
class Classes:
    """The class of every word: of the head by word (sorted), of others by shape."""

    words: np.ndarray
    of_word: np.ndarray
    of_shape: np.ndarray
    end: int
    number: int

    def by_code(self) -> np.ndarray:
        return by_code(self.of_word, self.end, self.of_shape).astype(np.int64)


def class_contexts(texts: DataFrame, classes: Classes, words: bool = True) -> DataFrame:
    """Class bigrams as (pair, n), with before * classes + after as pair; and, unless ``words`` is False, rows with how
    often words of the head meet their slots: classes before it, classes after it, itself after it. Such a row has a group
    of ``GROUP_WORDS`` places, the different (place in the group) * (2 * classes + 1) + slot, and as many counts, packed.
    ``texts`` has codes by the classes' words, or texts."""
    coded = texts if "codes" in texts.columns else encoded(texts.select("text"), classes.words)
    sent = texts.sparkSession.sparkContext.broadcast((classes.by_code(), classes.number, len(classes.words)))

    def count(frames):
        kind, number, head = sent.value
        width = 2 * number + 1
        span, wide = width * GROUP_WORDS, np.int32 if head * width < 1 << 31 else np.int64
        starts = np.arange(-(-head // GROUP_WORDS) + 1) * span
        slots = np.min_scalar_type(span - 1)
        between = np.zeros(number * number, dtype=np.int64)
        held: list[np.ndarray] = []

        def rows():
            keys, n = np.unique(np.concatenate(held), return_counts=True)
            cut = np.searchsorted(keys, starts)
            groups = np.flatnonzero(np.diff(cut))
            keys = (keys % span).astype(slots)
            parts = [slice(cut[g], cut[g + 1]) for g in groups.tolist()]
            return pd.DataFrame({"words": groups, "slots": [keys[p].tobytes() for p in parts], "counts": [packed(n[p]) for p in parts], "pair": -1, "n": 0})

        for frame in frames:
            codes = sequence(frame["codes"].tolist())
            kinds = kind[codes]
            between += np.bincount(kinds[:-1] * number + kinds[1:], minlength=number * number)
            if not words:
                continue
            at = np.flatnonzero(codes >= 0)
            first = codes[at].astype(wide) * wide(width)
            twice = codes[at] == codes[at + 1]
            beside = kinds.astype(wide)
            held.append(np.concatenate([first + beside[at - 1], first + beside[at + 1] + wide(number), first[twice] + wide(2 * number)]))
            if sum(map(len, held)) > SORTED_KEYS:
                yield rows()
                held = []
        if sum(map(len, held)):
            yield rows()
        seen = np.flatnonzero(between)
        yield pd.DataFrame({"words": -1, "slots": b"", "counts": b"", "pair": seen, "n": between[seen]})

    return coded.select("codes").mapInPandas(count, "words long, slots binary, counts binary, pair long, n long")


def class_bigrams(contexts: DataFrame, number: int) -> np.ndarray:
    out = np.zeros(number * number)
    for row in contexts.where("pair >= 0").groupBy("pair").agg(F.sum("n").alias("n")).collect():
        out[row["pair"]] = row["n"]
    return out.reshape(number, number)


def best_classes(contexts: DataFrame, classes: Classes, between: np.ndarray) -> np.ndarray:
    """The best class of each word of the head, while all others stay where they are."""
    number, width = classes.number, 2 * classes.number + 1
    sent = contexts.sparkSession.sparkContext.broadcast((classes.of_word, between))
    slots_type = np.min_scalar_type(width * GROUP_WORDS - 1)

    def place_words(frames):
        of_word, between = sent.value

        def placed(group: int, sums: np.ndarray) -> pd.DataFrame:
            table = sums.reshape(GROUP_WORDS, width)
            found = np.flatnonzero(table.any(axis=1))
            places, line = group * GROUP_WORDS + found, np.arange(len(found))
            own, before, after, itself = of_word[places], table[found, :number], table[found, number:-1], table[found, -1]
            before[line, own] -= itself
            after[line, own] -= itself
            return pd.DataFrame({"place": places, "kind": best_places(between, own, after, before, itself)})

        group, sums = None, None
        for frame in frames:
            for words, slots, counts in zip(frame["words"].tolist(), frame["slots"], frame["counts"], strict=True):
                if words != group:
                    if group is not None:
                        yield placed(group, sums)
                    group, sums = words, np.zeros(GROUP_WORDS * width)
                at = np.frombuffer(slots, dtype=slots_type)
                sums[at] += unpacked(counts, len(at))
        if group is not None:
            yield placed(group, sums)

    # Few bytes but much to compute: a stated number of tasks, by the size of the head, is not coalesced. The rows of a
    # group come one after another, so a task holds the sums of one group, however many rows it has.
    tasks = max(1, -(-len(classes.words) // TASK_WORDS))
    grouped = contexts.where("words >= 0").select("words", "slots", "counts").repartition(tasks, "words").sortWithinPartitions("words")
    moved = grouped.mapInPandas(place_words, "place long, kind long").toPandas()
    of_word = classes.of_word.copy()
    of_word[moved["place"].to_numpy(dtype=np.int64)] = moved["kind"].to_numpy(dtype=np.int64)
    return of_word


def exchange_head(coded: DataFrame, classes: Classes, sweeps: int = HEAD_SWEEPS) -> tuple[Classes, np.ndarray]:
    """The classes after sweeps over all words of the head, and their bigrams over all texts.

    The words of a sweep move at once, each as if it alone did, so a sweep can lower the likelihood; the sweeps then
    end and the classes before it stay. A sweep is two readings of the codes, one for the bigrams and one for the
    contexts; the driver gets one number per word.
    """
    best = None
    for left in range(sweeps, -1, -1):
        between = class_bigrams(class_contexts(coded, classes, words=False), classes.number)
        if best is not None and information(between) <= information(best[1]):
            break
        best = classes, between
        if left == 0 or not len(classes.words):
            break
        of_word = best_classes(class_contexts(coded, classes), classes, between)
        if (of_word == classes.of_word).all():
            break
        classes = replace(classes, of_word=of_word)
    return best


@dataclass
class ClassModel:
    classes: Classes
    transition: np.ndarray
    class_tokens: np.ndarray
    class_words: np.ndarray
    head_counts: np.ndarray
    tokens: int
    words: int
    ends: int

    def emission_total(self) -> np.ndarray:
        """log10 of what a word's smoothed count is divided by, per class."""
        return np.log10(self.class_tokens + SMOOTH * (self.class_words + 1))


def most_frequent(counts: DataFrame, most: int) -> pd.DataFrame:
    """Words above a count that at most ``most`` words reach, most frequent first.

    The count comes from how many words have each count, so only the result goes to the driver.
    """
    reached, least = 0, None
    for row in sorted(counts.groupBy("n").agg(F.count("*").alias("words")).collect(), reverse=True):
        reached += row["words"]
        if reached > most:
            break
        least = row["n"]
    found = counts.where(F.col("n") >= least if least is not None else F.lit(False)).toPandas()
    return found.sort_values(["n", "word"], ascending=[False, True], kind="stable").reset_index(drop=True)


def head_of(counts: DataFrame, head_words: int = HEAD_WORDS) -> tuple[pd.DataFrame, np.ndarray]:
    """The most frequent words, and their sorted values, whose places are their codes."""
    head = most_frequent(counts.where(F.col("word") != int(END)), head_words)
    head["value"] = head["word"].to_numpy(dtype=np.int64).astype(np.uint64)
    return head, np.sort(head["value"].to_numpy())


def train_on_codes(
    coded: DataFrame,
    counts: DataFrame,
    head: pd.DataFrame,
    unit_words: int = UNIT_WORDS,
    classes: int = CLASSES,
    sweeps: int = SWEEPS,
    head_sweeps: int = HEAD_SWEEPS,
) -> ClassModel:
    """The model of texts in codes by the head of their word counts."""
    by_shape = counts.groupBy((F.col("word") == int(END)).alias("end"), "shape").agg(F.sum("n").alias("n"), F.count("*").alias("words")).collect()
    values, shapes, seen = (head[name].to_numpy() for name in ("value", "shape", "n"))
    shapes, seen = shapes.astype(np.int64), seen.astype(np.int64)
    # Units: the end token, then frequent words, then shapes.
    most = len(values[:unit_words])
    order = np.argsort(values, kind="stable")
    of_head = np.r_[1 + np.arange(most), 1 + most + shapes[most:]].astype(np.int64)
    size = 1 + most + SHAPES
    of = exchange(unit_bigrams(coded, by_code(of_head[order], 0, 1 + most + np.arange(SHAPES)), size), classes, sweeps)
    of_shape = of[1 + most :]
    known, between = exchange_head(coded, Classes(values[order], of[of_head[order]], of_shape, int(of[0]), classes), head_sweeps)
    transition = np.log10((between + SMOOTH) / (between.sum(axis=1, keepdims=True) + SMOOTH * classes))

    # Tokens and words per class: the end token, shapes without their words of the head, and these by themselves.
    of_kind = np.r_[known.end, of_shape, known.of_word]
    kind_tokens, kind_words = np.zeros(1 + SHAPES), np.zeros(1 + SHAPES)
    for row in by_shape:
        at = 0 if row["end"] else 1 + row["shape"]
        kind_tokens[at] += row["n"]
        kind_words[at] += row["words"]
    kind_tokens[1:] -= np.bincount(shapes, seen, SHAPES)
    kind_words[1:] -= np.bincount(shapes, minlength=SHAPES)
    per_class = lambda own, words: np.bincount(of_kind, np.r_[own, words], classes)
    return ClassModel(
        known, transition, per_class(kind_tokens, seen[order]), per_class(kind_words, np.ones(len(order))), seen[order],
        int(sum(r["n"] for r in by_shape)), int(sum(r["words"] for r in by_shape)), int(sum(r["n"] for r in by_shape if r["end"])),
    )


def train_class_model(texts: DataFrame, head_words: int = HEAD_WORDS, **settings) -> tuple[ClassModel, DataFrame]:
    """The model, and the table of all word counts. ``texts`` has the training texts in column ``text``."""
    counts = stored(word_counts(texts), "word-counts")
    head, words = head_of(counts, head_words)
    return train_on_codes(stored(encoded(texts.select("text"), words), "codes"), counts, head, **settings), counts


def score_codes(coded: DataFrame, model: ClassModel, counts: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score) of every row; scores are log10 chances."""
    none = np.zeros(SHAPES)
    tables = (
        model.classes.by_code(), model.transition - model.emission_total(),
        by_code(np.log10(model.head_counts + SMOOTH), np.log10(model.ends + SMOOTH), none),
        by_code(np.ones(len(model.head_counts)), float(model.ends > 0), none),
    )
    sent = coded.sparkSession.sparkContext.broadcast(tables)

    def score(batches):
        kind, step, log_counts, known = sent.value
        for batch in batches:
            texts = batch.column("codes").to_pylist()
            if not texts:
                continue
            size = np.array([len(t) >> 2 for t in texts], dtype=np.int64)
            first = np.cumsum(size) - size
            codes = sequence(texts)
            kinds = kind[codes]
            total = lambda x: np.add.reduceat(x, first)  # noqa: B023, E731
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row"), batch.column("doc_id"), pa.array(size), pa.array(total(known[codes[1:]]).astype(np.int64)),
                    pa.array(total(log_counts[codes[1:]])), pa.array(total(step[kinds[:-1], kinds[1:]])),
                ],
                names=["row", "doc_id", "n_tokens", "n_known", "counts", "classes"],
            )

    told = coded.select("row", "doc_id", "codes").mapInArrow(score, "row long, doc_id long, n_tokens long, n_known long, counts double, classes double")
    beyond = counts.select("word", F.col("n").alias("seen"))
    if len(model.head_counts):
        beyond = beyond.where(F.col("seen") <= int(model.head_counts.min()))
    # What the head has told of a text, and its words beyond the head, each once, meet by the text's row.
    opened = coded.select("row", F.explode(F.arrays_zip("rest", "times")).alias("x")).select("row", F.col("x.rest").alias("word"), F.col("x.times").alias("n"))
    others = opened.join(beyond, "word", "left").select(
        "row",
        F.when(F.col("seen").isNotNull(), F.col("n")).otherwise(0).alias("n_known"),
        (F.col("n") * F.log10(F.coalesce("seen", F.lit(0)) + F.lit(SMOOTH))).alias("counts"),
    )
    rows = told.unionByName(others, allowMissingColumns=True).groupBy("row")
    rows = rows.agg(*[F.max(name).alias(name) for name in ("doc_id", "n_tokens", "classes")], *[F.sum(name).alias(name) for name in ("n_known", "counts")])
    total = float(np.log10(model.tokens + SMOOTH * (model.words + 1)))
    return rows.select(
        "doc_id",
        "n_tokens",
        "n_known",
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        (F.col("counts") - F.col("n_tokens") * total).alias("base_score"),
        (F.col("counts") + F.col("classes")).alias("score"),
    )


def score_documents(documents: DataFrame, model: ClassModel, counts: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``score_codes`` of texts."""
    chosen = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return score_codes(stored(encoded(chosen, model.classes.words), "codes"), model, counts)


def class_scores(documents: DataFrame, learn: Column, doc_id: str = "doc_id", text: str = "text", head_words: int = HEAD_WORDS, **settings) -> DataFrame:
    """Scores of all documents by a model of those for which ``learn`` holds; each text is written as codes once."""
    counts = stored(word_counts(documents.where(learn).select(F.col(text).alias("text"))), "word-counts")
    head, words = head_of(counts, head_words)
    chosen = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(learn, F.lit(False)).alias("learn"), F.col(text).alias("text"))
    coded = stored(encoded(chosen, words), "codes")
    return score_codes(coded, train_on_codes(coded.where("learn"), counts, head, **settings), counts)
