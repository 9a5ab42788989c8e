"""Phrases whose words keep together, from a weighted graph of overlapping word groups.

Texts are cut into pieces at punctuation and line ends, pieces into words. The longest groups
(``longest`` words, five) are edges between nodes of one word less: an edge leads from its
first to its last four words and weighs as often as it occurs. Every place in a piece starts
an edge, but for the last four; those are told by the piece's tail, its last four words.

1. Two passes find words and pairs of neighbours that occur ``least`` times. Only those can be
   in a phrase, so pieces end there for the graph. Counts are kept by 64-bit hash and reach the
   tasks as bitmaps of fixed size: what two words share there can only keep a rare word, never
   cost a frequent one, so the result does not depend on the size of the bitmap.
2. A third pass tallies edges and tails, per task and then in buckets of keys; two phrases are
   taken for one with a chance of 2^-64.
3. Node flow: a node occurs as often as its edges out and the tails that are it. Nodes through
   which one edge in and one edge out carry the whole flow are unary; the edges around
   them are compacted to paths by doubling pointers. A path lies inside one piece.
4. Counts: a path gives the longest groups. A shorter one occurs as often as the groups of one
   word more that begin with it, and the tails that end with it; sums combine before the shuffle.
5. A phrase with ``least`` occurrences is dropped if a phrase of one word more holds it as often
   (then so does one in between any longer one). The others are scored at each cut, in decimals
   of 38 digits; the lowest score counts.

Defined results: null and empty texts have no words, a null language counts as ``und``. Rows
are counted as often as they occur. Languages with no phrase have no rows; an empty table
gives none. Ties in a language's list go by count, then by phrase in UTF-8 byte order. Only
``lang`` and ``text`` are read, other columns may have any name.
"""

from __future__ import annotations

from hashlib import blake2b

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from terrace.llm.hashing import Words, chunks, mix, words_of
from terrace.llm.tables import stored

LONGEST = 5
LEAST = 100
BEST = 2_000
#: Bits of the two bitmaps that go to every task: 8 MB each.
FILTER_BITS = 26
#: Different keys that a task holds before it hands them on.
HELD = 1 << 18
SPELLED = 1 << 19
#: Words of the corpus for each bucket in which edges and tails meet, and the fewest buckets.
BUCKET_WORDS = 16_000_000
BUCKETS = 32
#: Numbers of a packed row, one per edge or tail.
BLOCK = {"key": "<u8", "n": "<i8", "lang": "<i4", "tail": "u1", "size": "u1"}
#: Rows in one batch from a task.
ROWS = 1 << 15
#: A language's list is made from so many lists of parts of its phrases.
PARTS = 32
_BUCKET = 15  # log2 of the bits in one bitmap of Spark's
_SEPARATOR = np.zeros(256, dtype=bool)
_SEPARATOR[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_GAP = _SEPARATOR.copy()
_GAP[[0x20, 0x09]] = True


def _bounds(begin: np.ndarray, end: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    inside = ~_GAP[data]
    change = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    return change[0::2], change[1::2]


class Pieces:
    """The words of a batch: keys that tell (language, word), and which words follow each other in a piece."""

    def __init__(self, frame: pd.DataFrame):
        self.words: Words = words_of(frame["text"].tolist(), split=_bounds)
        counts = np.diff(self.words.bounds)
        kinds = {lang: int.from_bytes(blake2b(lang.encode(), digest_size=8).digest(), "little") for lang in frame["lang"].unique()}
        of_text = np.array([kinds[lang] for lang in frame["lang"]], dtype=np.uint64)
        self.text = np.repeat(np.arange(len(frame)), counts)
        self.key = mix(self.words.value ^ of_text[self.text])
        piece = np.cumsum(_SEPARATOR[self.words.data])[self.words.begin]
        self.joined = (piece[1:] == piece[:-1]) & (self.text[1:] == self.text[:-1])
        self.counts = counts

    def pairs(self) -> np.ndarray:
        return mix(self.key[:-1] * np.uint64(31) + self.key[1:])

    def phrase(self, first: int, size: int) -> str:
        found = self.words
        return b" ".join(found.data[found.begin[i] : found.end[i]].tobytes() for i in range(first, first + size)).decode()


class Tally:
    """Sums by 64-bit key, over many batches; ``full`` when it holds many keys. New sums wait until they are as many as the old."""

    def __init__(self):
        self.keys, self.sums = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
        self.new: list[tuple[np.ndarray, np.ndarray]] = []
        self.waiting = 0

    def add(self, keys: np.ndarray) -> None:
        self.new.append(np.unique(keys, return_counts=True))
        self.waiting += len(self.new[-1][0])
        if self.waiting > max(len(self.keys), HELD // 2):
            self.settle()

    def settle(self) -> None:
        keys, sums = (np.concatenate(x) for x in zip((self.keys, self.sums), *self.new, strict=True))
        self.keys, place = np.unique(keys, return_inverse=True)
        self.sums = np.bincount(place, sums, len(self.keys)).astype(np.int64)
        self.new, self.waiting = [], 0

    @property
    def full(self) -> bool:
        return len(self.keys) > HELD

    def rows(self):
        """Keys and sums, a bounded number at a time."""
        self.settle()
        for i in range(0, len(self.keys), ROWS):
            yield self.keys[i : i + ROWS], self.sums[i : i + ROWS]


def _seen(bits: np.ndarray, keys: np.ndarray, size: int) -> np.ndarray:
    """Whether the bitmap has the keys."""
    place = keys & np.uint64((1 << size) - 1)
    return (bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1


def bitmap(keys: DataFrame, size: int) -> np.ndarray:
    """A bitmap of 2**size bits of the keys' low bits, built in Spark: at most 2**size / 8 bytes reach the driver."""
    place = F.col("key").bitwiseAND(F.lit((1 << size) - 1))
    parts = keys.groupBy(F.shiftright(place, _BUCKET).cast("int").alias("bucket")).agg(
        F.bitmap_construct_agg(place.bitwiseAND(F.lit((1 << _BUCKET) - 1))).alias("bits")
    )
    out = np.zeros((1 << size) // 8, dtype=np.uint8)
    width = (1 << _BUCKET) // 8
    for row in parts.collect():
        part = np.frombuffer(row["bits"], dtype=np.uint8)
        out[row["bucket"] * width : row["bucket"] * width + len(part)] = part
    return out


def word_counts(texts: DataFrame) -> DataFrame:
    """(lang, null, words) for each language and (null, key, occurrences) for each word of it."""

    def rows(tally: Tally):
        for keys, sums in tally.rows():
            yield pd.DataFrame({"lang": None, "key": pd.array(keys.view(np.int64), dtype="Int64"), "n": sums})

    def count(frames):
        tally, totals = Tally(), {}
        with np.errstate(over="ignore"):
            for frame in chunks(frames):
                pieces = Pieces(frame)
                tally.add(pieces.key)
                for lang, n in zip(frame["lang"], pieces.counts.tolist(), strict=True):
                    totals[lang] = totals.get(lang, 0) + n
                if tally.full:
                    yield from rows(tally)
                    tally = Tally()
            yield from rows(tally)
        if totals:
            yield pd.DataFrame({"lang": list(totals), "key": pd.array([None] * len(totals), dtype="Int64"), "n": list(totals.values())})

    return texts.mapInPandas(count, "lang string, key long, n long").groupBy("lang", "key").agg(F.sum("n").alias("n"))


def pair_counts(texts: DataFrame, often, size: int) -> DataFrame:
    """(key, occurrences) of neighbours in a piece that are both in the bitmap of words."""

    def rows(tally: Tally):
        for keys, sums in tally.rows():
            yield pd.DataFrame({"key": keys.view(np.int64), "n": sums})

    def count(frames):
        tally = Tally()
        with np.errstate(over="ignore"):
            for frame in chunks(frames):
                pieces = Pieces(frame)
                known = _seen(often.value, pieces.key, size)
                tally.add(pieces.pairs()[pieces.joined & known[1:] & known[:-1]])
                if tally.full:
                    yield from rows(tally)
                    tally = Tally()
            yield from rows(tally)

    return texts.mapInPandas(count, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


def merged(blocks: pd.DataFrame) -> pd.DataFrame:
    """(lang, tail, size, phrase, n) of the blocks of one bucket: sums by key, each key spelled by its first block."""
    numbers = {name: np.concatenate([np.frombuffer(x, dtype=kind) for x in blocks[name]]) for name, kind in BLOCK.items()}
    langs = [x for own in blocks["langs"] for x in own]
    before = np.cumsum([0, *(len(own) for own in blocks["langs"])])[:-1]
    numbers["lang"] = numbers["lang"] + np.repeat(before, [len(x) // 4 for x in blocks["lang"]])
    _, first, place = np.unique(numbers["key"], return_index=True, return_inverse=True)
    phrases = np.array([p for x in blocks["phrases"] for p in x.split("\n")], dtype=object)[first]
    n = np.bincount(place, numbers["n"], len(first)).astype(np.int64)
    return pd.DataFrame(
        {"lang": np.array(langs, dtype=object)[numbers["lang"][first]], "tail": numbers["tail"][first] > 0, "size": numbers["size"][first].astype(np.int32), "phrase": phrases, "n": n}
    )


def graph(texts: DataFrame, words_often, pairs_often, longest: int, size: int, buckets: int) -> DataFrame:
    """(lang, tail, size, phrase, n): edges, and tails of the pieces (``tail``), as often as they occur.

    A task hands on one packed row for each bucket of keys in which it has any, as a row of its own for
    each phrase would cost several times the bytes; buckets are merged and opened after the shuffle.
    """

    def groups(pieces: Pieces):
        """(first word, size, is it a tail) of every edge and tail."""
        known = _seen(words_often.value, pieces.key, size)
        linked = np.r_[pieces.joined & known[1:] & known[:-1], False]
        linked[:-1] &= _seen(pairs_often.value, pieces.pairs(), size) if len(pieces.key) > 1 else False
        run = linked[: len(linked) - longest + 2].copy() if len(linked) >= longest else np.zeros(0, dtype=bool)
        for i in range(1, longest - 1):
            run &= linked[i : i + len(run)]
        edges = np.flatnonzero(run)
        last = np.flatnonzero(known & ~linked)
        reach = np.zeros(len(last), dtype=np.int64)  # words before the last one, as far as a tail goes
        for back in range(1, longest - 1):
            before = last - back
            reach += (reach == back - 1) & (before >= 0) & linked[np.maximum(before, 0)]
        first = np.r_[edges, last - reach]
        return first, np.r_[np.full(len(edges), longest), reach + 1], np.arange(len(first)) >= len(edges)

    def tell(frames):
        held = Tally()
        shown: dict[int, tuple[str, bool, int, str]] = {}

        def rows():
            held.settle()
            bucket = held.keys % np.uint64(buckets)
            order = np.argsort(bucket, kind="stable")
            for part in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1) if len(order) else ():
                found = [shown[k] for k in held.keys[part].tolist()]
                langs = {x: i for i, x in enumerate(dict.fromkeys(x[0] for x in found))}
                yield pd.DataFrame(
                    {
                        "bucket": [int(bucket[part[0]])], "key": [held.keys[part].tobytes()], "n": [held.sums[part].tobytes()],
                        "lang": [np.array([langs[x[0]] for x in found], dtype=np.int32).tobytes()], "tail": [bytes(x[1] for x in found)],
                        "size": [bytes(x[2] for x in found)], "langs": [list(langs)], "phrases": ["\n".join(x[3] for x in found)],
                    }
                )

        with np.errstate(over="ignore"):
            for frame in chunks(frames):
                pieces = Pieces(frame)
                if not len(pieces.key):
                    continue
                first, length, tail = groups(pieces)
                key = mix(length.astype(np.uint64) * np.uint64(2) + tail)
                for i in range(longest):
                    inside = length > i
                    key[inside] = mix(key[inside] * np.uint64(31) + pieces.key[first[inside] + i])
                new, at = np.unique(key, return_index=True)
                langs = frame["lang"].tolist()
                for k, i in zip(new.tolist(), at.tolist(), strict=True):
                    if k not in shown:
                        shown[k] = (langs[pieces.text[first[i]]], bool(tail[i]), int(length[i]), pieces.phrase(int(first[i]), int(length[i])))
                held.add(key)
                if len(shown) > SPELLED:
                    yield from rows()
                    held, shown = Tally(), {}
            yield from rows()

    names = ", ".join(f"{name} binary" for name in BLOCK)
    packed = texts.mapInPandas(tell, f"bucket long, {names}, langs array<string>, phrases string")
    return packed.groupBy("bucket").applyInPandas(merged, "lang string, tail boolean, size int, phrase string, n long")


def first_words(phrase: Column, n: int) -> Column:
    return F.substring_index(phrase, " ", n)


def last_words(phrase: Column, n: int) -> Column:
    return F.substring_index(phrase, " ", -n)


def node_flow(told: DataFrame, longest: int) -> DataFrame:
    """(lang, phrase, n) of the nodes: edges that begin with them, and tails that are them."""
    node = longest - 1
    out = told.where("NOT tail").select("lang", first_words(F.col("phrase"), node).alias("phrase"), "n")
    ends = told.where(F.col("tail") & (F.col("size") == node)).select("lang", "phrase", "n")
    return out.unionByName(ends).groupBy("lang", "phrase").agg(F.sum("n").alias("n"))


def unary_paths(edges: DataFrame, nodes: DataFrame, longest: int) -> DataFrame:
    """(lang, words, n): maximal paths of ``edges`` (lang, phrase, n) through nodes with one edge in and one out.

    Such a node's flow is that of its one edge in and its one edge out, so all edges of a path weigh the same.
    """
    node = longest - 1
    flow = nodes.select("lang", F.col("phrase").alias("node"), "n")
    into = edges.select("lang", last_words(F.col("phrase"), node).alias("node"), F.col("phrase").alias("before"), "n").join(flow, ["lang", "node", "n"])
    out = edges.select("lang", first_words(F.col("phrase"), node).alias("node"), F.col("phrase").alias("edge"), "n").join(flow, ["lang", "node", "n"])
    steps = into.join(out, ["lang", "node", "n"]).select("lang", "edge", "before")
    # Each edge points to the one before it; pointers double until all point to their path's first edge.
    placed = edges.select("lang", F.col("phrase").alias("edge"), "n").join(steps, ["lang", "edge"], "left")
    placed = stored(placed.select("lang", "edge", "n", F.coalesce("before", "edge").alias("root"), F.col("before").isNotNull().cast("long").alias("at")), "paths")
    reach = placed.agg(F.sum("at")).first()[0]
    while reach:
        up = placed.select("lang", F.col("edge").alias("root"), F.col("root").alias("_root"), F.col("at").alias("_at"))
        placed = stored(placed.join(up, ["lang", "root"]).select("lang", "edge", "n", F.col("_root").alias("root"), (F.col("at") + F.col("_at")).alias("at")), "paths")
        last, reach = reach, placed.agg(F.sum("at")).first()[0]
        if reach == last:
            break
    more = F.transform(F.sort_array(F.collect_list(F.struct("at", last_words(F.col("edge"), 1).alias("word")))), lambda x: x["word"])
    paths = placed.groupBy("lang", "root").agg(F.max("n").alias("n"), more.alias("more"))
    return paths.select("lang", F.concat(F.split("root", " "), F.slice("more", F.lit(2), F.greatest(F.size("more") - 1, F.lit(0)))).alias("words"), "n")


def group_counts(paths: DataFrame, nodes: DataFrame, told: DataFrame, longest: int, least: int) -> DataFrame:
    """(lang, size, phrase, a): groups of up to ``longest`` words that occur ``least`` times.

    A group occurs as often as the groups of one word more that begin with it, and the tails that end with it.
    """
    windows = F.transform(F.sequence(F.lit(0), F.size("words") - longest), lambda i: F.array_join(F.slice("words", i + 1, F.lit(longest)), " "))
    counts = paths.select("lang", F.lit(longest).alias("size"), F.explode(windows).alias("phrase"), F.col("n").alias("a"))
    level, tails = nodes, told.where("tail")
    for size in range(longest - 1, 0, -1):
        if size < longest - 1:
            begun = level.select("lang", first_words(F.col("phrase"), size).alias("phrase"), "n")
            ended = tails.where(F.col("size") >= size).select("lang", last_words(F.col("phrase"), size).alias("phrase"), "n")
            level = stored(begun.unionByName(ended).groupBy("lang", "phrase").agg(F.sum("n").alias("n")), "group-flow")
        counts = counts.unionByName(level.where(F.col("n") >= least).select("lang", F.lit(size).alias("size"), "phrase", F.col("n").alias("a")))
    return counts


def uncovered(counts: DataFrame, longest: int) -> DataFrame:
    """Phrases of two words or more that no phrase of one word more holds as often."""
    words = F.split("phrase", " ")
    parts = F.array(F.array_join(F.slice(words, F.lit(1), F.col("size") - 1), " "), F.array_join(F.slice(words, F.lit(2), F.col("size") - 1), " "))
    longer = counts.where("size > 2").select("lang", F.explode(parts).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("_longer"))
    held = counts.where("size > 1").join(longer, ["lang", "phrase"], "left")
    return held.where(F.col("_longer").isNull() | (F.col("_longer") < F.col("a"))).drop("_longer")


def scored(phrases: DataFrame, counts: DataFrame, totals: DataFrame, longest: int) -> DataFrame:
    """(lang, phrase, a, l, r, n, score): the lowest score of all cuts, the first of equal ones."""
    words = F.split("phrase", " ")
    cut = lambda k: F.struct(
        k.alias("k"),
        F.array_join(F.slice(words, F.lit(1), k), " ").alias("left"),
        F.array_join(F.slice(words, k + 1, F.col("size")), " ").alias("right"),
    )
    cuts = phrases.select("lang", "phrase", "a", F.explode(F.transform(F.sequence(F.lit(1), F.col("size") - 1), cut)).alias("x")).select("lang", "phrase", "a", "x.*")
    parts = counts.where(F.col("size") < longest)
    for side, name in (("left", "l"), ("right", "r")):
        cuts = cuts.join(parts.select("lang", F.col("phrase").alias(side), F.col("a").alias(name)), ["lang", side])
    whole = lambda c: F.col(c).cast("decimal(18,0)")
    # Integer division of decimals: F.expr, as the function has no name of its own.
    cuts = cuts.join(totals, "lang").withColumns({"_up": F.lit(1000).cast("decimal(4,0)") * (whole("a") * whole("n")), "_down": whole("l") * whole("r")})
    cuts = cuts.withColumn("score", F.expr("_up div _down"))
    lowest = cuts.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("x"))
    return lowest.select("lang", "phrase", "a", "x.l", "x.r", "n", "x.score")


def _prepared(documents: DataFrame, lang: str, text: str) -> DataFrame:
    return documents.select(F.coalesce(F.col(lang), F.lit("und")).alias("lang"), F.col(text).alias("text"))


def phrase_graph(documents: DataFrame, least: int = LEAST, longest: int = LONGEST, filter_bits: int = FILTER_BITS, lang: str = "lang", text: str = "text"):
    """(words per language, edges and tails, nodes, unary paths): the graph of groups of frequent neighbours, as tables.

    ``paths`` (lang, words, n) holds every edge that occurs ``least`` times once. A path of more words than
    ``longest`` is a passage that occurs whole or not at all.
    """
    spark = documents.sparkSession
    texts = _prepared(documents, lang, text)
    words = stored(word_counts(texts).where((F.col("n") >= least) | F.col("key").isNull()), "words")
    totals = words.where("key IS NULL").select("lang", "n")
    words_often = spark.sparkContext.broadcast(bitmap(words.where("key IS NOT NULL"), filter_bits))
    pairs = stored(pair_counts(texts, words_often, filter_bits).where(F.col("n") >= least), "pairs")
    pairs_often = spark.sparkContext.broadcast(bitmap(pairs, filter_bits))
    buckets = max(BUCKETS, (totals.agg(F.sum("n")).first()[0] or 0) // BUCKET_WORDS)
    told = stored(graph(texts, words_often, pairs_often, longest, filter_bits, buckets), "edges-and-tails")
    nodes = stored(node_flow(told, longest), "nodes")
    edges = told.where("NOT tail AND n >= " + str(least)).select("lang", "phrase", "n")
    return totals, told, nodes, stored(unary_paths(edges, nodes.where(F.col("n") >= least), longest), "paths-whole")


def collocations(
    documents: DataFrame,
    least: int = LEAST,
    best: int = BEST,
    longest: int = LONGEST,
    filter_bits: int = FILTER_BITS,
    lang: str = "lang",
    text: str = "text",
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``best`` phrases of each language."""
    totals, told, nodes, paths = phrase_graph(documents, least, longest, filter_bits, lang, text)
    counts = stored(group_counts(paths, nodes, told, longest, least), "group-counts")
    found = scored(uncovered(counts, longest), counts, totals, longest)
    best_first = (F.desc("score"), F.desc("a"), F.asc("phrase"))
    part = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(PARTS))).orderBy(*best_first)
    short = found.withColumn("_place", F.row_number().over(part)).where(F.col("_place") <= best).drop("_place")
    listed = short.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best_first)).cast("long")).where(F.col("rank") <= best)
    return listed.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
