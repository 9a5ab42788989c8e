"""Near duplicates: SuperMinHash, banding, verification on full sets, connected components.

1. Each document's set of word shingles gives a signature; equal sets form a class and go on
   as one node, whatever their number.
2. Nodes that agree on a band share a bucket. Per bucket, the node that shares buckets with
   most others is the hub, and only (member, hub) pairs are verified, on full sets: a bucket
   gives as many pairs as members. Bands are chosen so that a pair at the threshold shares
   no bucket with a chance below ``MISSED``.
3. Verified pairs are joined to components. Nodes of buckets that still hold more than one
   component go through an exact prefix join: in the order of rising frequency, two sets
   above the threshold share a shingle within a short prefix. Shingles that no other such
   node holds, and the place of the first shared one, bound what a pair can share, which
   rules out most pairs before they are formed. For each prefix shingle, only nodes outside its largest component look for
   partners, so a big component is not paired with itself. What verification confirms joins
   components.

No step pairs all members of a bucket and none is cut off at a number of partners.

Defined results: a document with fewer words than a shingle is one shingle, one without words
has an empty set and is linked with nothing. Rows with one id and one text count as one
document; rows with one id and different texts are documents of their own, each in the group of
its text. Where one of a group stays, it is the one with the least id, then the least hash of the text. A row
without an id is its own group: component null, kept. Hash values stand for shingles; two
different ones are taken for one with a chance of 2^-64. An empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from terrace.llm.components import components
from terrace.llm.hashing import chunks, mix, words_of
from terrace.llm.superminhash import bands, signatures
from terrace.llm.tables import stored

SHINGLE_WORDS = 5
PERCENT = 80
BAND_ROWS = 5
MISSED = 2e-7
KEYS = ("n_shingles", "set_a", "set_b")
DIGEST = "doc_id long, content long, n_shingles long, set_a long, set_b long, bands array<long>"


def shingle_sets(texts: list[str | None], size: int) -> tuple[np.ndarray, np.ndarray]:
    """All distinct shingles, text after text, each text's sorted; and how many each has."""
    found = words_of(texts)
    v, count = found.value, np.diff(found.bounds)
    hashed = np.zeros(max(0, len(v) - size + 1), dtype=np.uint64)
    for i in range(size if len(hashed) else 0):
        hashed = mix(hashed * np.uint64(31) + v[i : i + len(hashed)])
    sets = []
    for i, n in enumerate(count.tolist()):
        first = int(found.bounds[i])
        if n >= size:
            sets.append(np.unique(hashed[first : first + n - size + 1]))
        else:
            whole = np.uint64(n)
            for word in v[first : first + n]:
                whole = mix(np.array([whole * np.uint64(37) + word], dtype=np.uint64))[0]
            sets.append(np.array([whole] if n else [], dtype=np.uint64))
    return np.concatenate(sets) if sets else np.zeros(0, dtype=np.uint64), np.array([len(s) for s in sets], dtype=np.int64)


def band_count(percent: int, rows: int, missed: float = MISSED) -> int:
    return math.ceil(math.log(missed) / math.log1p(-((percent / 100) ** rows)))


def fingerprints(elements: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two sums over each set, which equal sets share."""
    ends = np.r_[0, np.cumsum(sizes)]
    sums = [np.r_[np.uint64(0), np.cumsum(x)] for x in (elements, mix(elements ^ np.uint64(0x2545F4914F6CDD1D)))]
    return tuple((x[ends[1:]] - x[ends[:-1]]).astype(np.int64) for x in sums)


def digests(documents: DataFrame, shingle_words: int, percent: int, rows: int) -> DataFrame:
    """Per row (doc_id, content, text): set size, fingerprint of the set, band hashes."""
    places = rows * band_count(percent, rows)

    def digest(frames):
        with np.errstate(over="ignore"):
            for frame in chunks(frames):
                elements, sizes = shingle_sets(frame["text"].tolist(), shingle_words)
                full = sizes > 0
                keys = bands(signatures(elements, sizes[full], places), rows).astype(np.int64)
                row = iter(keys)
                listed = [next(row) if f else [] for f in full.tolist()]
                set_a, set_b = fingerprints(elements, sizes)
                yield pd.DataFrame({"doc_id": frame["doc_id"], "content": frame["content"], "n_shingles": sizes, "set_a": set_a, "set_b": set_b, "bands": listed})

    return documents.mapInPandas(digest, DIGEST)


def sets_of(documents: DataFrame, nodes: DataFrame, shingle_words: int) -> DataFrame:
    """(node, n, shingles) of the nodes (node, doc_id, set keys), read from their documents again."""

    def build(frames):
        with np.errstate(over="ignore"):
            for frame in chunks(frames):
                elements, sizes = shingle_sets(frame["text"].tolist(), shingle_words)
                set_a, set_b = fingerprints(elements, sizes)
                sets = list(np.split(elements.astype(np.int64), np.cumsum(sizes)[:-1]))
                yield pd.DataFrame({"doc_id": frame["doc_id"], "n_shingles": sizes, "set_a": set_a, "set_b": set_b, "shingles": sets})

    rows = documents.join(nodes.select("doc_id").distinct(), "doc_id", "left_semi").select("doc_id", "text")
    built = rows.mapInPandas(build, "doc_id long, n_shingles long, set_a long, set_b long, shingles array<long>").where("n_shingles > 0")
    # A node may have several rows, all with the same set.
    return built.join(nodes, ["doc_id", *KEYS]).groupBy("node").agg(F.max("n_shingles").alias("n"), F.max("shingles").alias("shingles"))


def similar(shared: Column, a: Column, b: Column, percent: int) -> Column:
    return 100 * shared >= percent * (a + b - shared)


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    left = sets.select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("shingles").alias("s_a"))
    right = sets.select(F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("shingles").alias("s_b"))
    met = pairs.join(left, "a").join(right, "b")
    return met.where(similar(F.size(F.array_intersect("s_a", "s_b")), F.col("n_a"), F.col("n_b"), percent)).select("a", "b")


def hub_pairs(banded: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """(members of shared buckets, distinct (member, hub) pairs whose sizes allow a link)."""
    shared = banded.groupBy("band").agg(F.count("*").alias("size")).where("size > 1")
    members = stored(banded.join(shared, "band"), "bucket-members")
    reach = members.groupBy("node").agg(F.sum("size").alias("reach"))
    ranked = members.join(reach, "node").select("band", "node", "n", F.struct("reach", (-F.col("node")).alias("least"), "n").alias("rank"))
    hubs = ranked.groupBy("band").agg(F.max("rank").alias("hub")).select("band", (-F.col("hub.least")).alias("hub"), F.col("hub.n").alias("hub_n"))
    met = members.select("band", "node", "n").join(hubs, "band").where("node <> hub")
    met = met.where(100 * F.least("n", "hub_n") >= percent * F.greatest("n", "hub_n"))
    return members, met.select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()


def prefix_pairs(open_nodes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs of nodes of different components that may be similar: every similar one is among them."""
    held = sets.join(open_nodes, "node").select("node", "component", "n", F.explode("shingles").alias("shingle"))
    often = held.groupBy("shingle").agg(F.count("*").alias("nodes")).where("nodes > 1")
    common = held.join(often, "shingle").groupBy("node", "component", "n").agg(F.sort_array(F.collect_list(F.struct("nodes", "shingle"))).alias("common"))
    length = F.col("n") - F.ceil(percent * F.col("n") / 100) + 1
    unique = F.col("n") - F.size("common")
    probes = stored(
        common.select("node", "component", "n", unique.alias("unique"), (length - unique).cast("int").alias("left"), "common")
        .where("left > 0")
        .select("node", "component", "n", "unique", F.posexplode(F.slice("common", F.lit(1), F.col("left"))).alias("at", "x"))
        .select("node", "component", "n", (F.col("n") - F.col("unique") - F.col("at")).alias("most"), F.col("x.shingle").alias("shingle")),
        "prefixes",
    )
    parts = probes.groupBy("shingle", "component").agg(F.count("*").alias("nodes"))
    largest = parts.groupBy("shingle").agg(F.max(F.struct("nodes", "component")).alias("top"), F.count("*").alias("parts")).where("parts > 1")
    mixed = largest.select("shingle", F.col("top.component").alias("largest"))
    index = probes.join(mixed.select("shingle"), "shingle", "left_semi").select(
        "shingle", F.col("node").alias("b"), F.col("component").alias("c_b"), F.col("n").alias("n_b"), F.col("most").alias("most_b")
    )
    looking = probes.join(mixed, "shingle").where("component <> largest")
    # At the first shingle that two sets share, they share at most what either still has from there on.
    shared = F.least("most", "most_b")
    met = looking.join(index, (looking["shingle"] == index["shingle"]) & (F.col("component") != F.col("c_b")) & similar(shared, F.col("n"), F.col("n_b"), percent))
    return met.select(F.least("node", "b").alias("a"), F.greatest("node", "b").alias("b")).distinct()


def labelled(documents: DataFrame, shingle_words: int, percent: int, band_rows: int, doc_id: str, text: str) -> DataFrame:
    """One row per document: doc_id, content (hash of the text), n_shingles, component_id, and whether it is the one of its group that stays."""
    chosen = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(text).alias("content"), F.col(text).alias("text"))
    digest = stored(digests(chosen, shingle_words, percent, band_rows), "digests")
    usable = digest.where("doc_id IS NOT NULL AND n_shingles > 0")
    classes = usable.groupBy(*KEYS).agg(F.min(F.struct("doc_id", "content")).alias("first"))
    classes = stored(classes.select(*KEYS, "first", F.shiftrightunsigned(F.xxhash64(*KEYS), 1).alias("node")), "classes")
    named = classes.select(F.col("first.doc_id").alias("doc_id"), "node", *KEYS)
    first = usable.join(named, ["doc_id", *KEYS])
    banded = first.select("node", F.col("n_shingles").alias("n"), F.explode("bands").alias("band")).distinct()
    members, pairs = hub_pairs(banded, percent)
    pairs = stored(pairs, "hub-pairs")
    sets = stored(sets_of(chosen, named.join(members.select("node").distinct(), "node"), shingle_words), "sets")
    links = verified(pairs, sets, percent)
    found = stored(components(links), "components")

    placed = members.join(found, "node", "left").select("band", "node", F.coalesce("component", "node").alias("component"))
    open_bands = placed.groupBy("band").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high")
    open_nodes = stored(placed.join(open_bands.select("band"), "band", "left_semi").select("node", "component").distinct(), "open-nodes")
    more = verified(stored(prefix_pairs(open_nodes, sets, percent), "prefix-pairs"), sets, percent)
    of = open_nodes.select("node", "component")
    joined = more.join(of.select(F.col("node").alias("a"), F.col("component").alias("c_a")), "a").join(of.select(F.col("node").alias("b"), F.col("component").alias("c_b")), "b")
    merged = components(joined.select(F.col("c_a").alias("a"), F.col("c_b").alias("b"))).select(F.col("node").alias("component"), F.col("component").alias("whole"))
    alone = open_nodes.select("node", "component").unionByName(found).distinct()
    final = alone.join(merged, "component", "left").select("node", F.coalesce("whole", "component").alias("group"))
    grouped = stored(classes.join(final, "node", "left").select(*KEYS, "first", F.coalesce("group", "node").alias("group")), "groups")
    heads = grouped.groupBy("group").agg(F.min("first").alias("head"))
    groups = grouped.join(heads, "group").select(*KEYS, "head")
    rows = digest.select("doc_id", "content", *KEYS).join(groups, list(KEYS), "left")
    linked = (F.col("n_shingles") > 0) & F.col("doc_id").isNotNull()
    head = F.when(linked, F.col("head")).otherwise(F.struct("doc_id", "content"))
    stays = F.struct("doc_id", "content").eqNullSafe(head)
    return rows.select("doc_id", "content", "n_shingles", head["doc_id"].alias("component_id"), stays.alias("stays"))


def near_duplicates(
    documents: DataFrame,
    shingle_words: int = SHINGLE_WORDS,
    percent: int = PERCENT,
    band_rows: int = BAND_ROWS,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (least id of its group), kept."""
    rows = labelled(documents, shingle_words, percent, band_rows, doc_id, text)
    return rows.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def without_near_duplicates(
    documents: DataFrame,
    shingle_words: int = SHINGLE_WORDS,
    percent: int = PERCENT,
    band_rows: int = BAND_ROWS,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """The documents, all columns, one of each group: rows go, not ids, so no text goes with another one's copy.

    Of rows with one id and one text, one stays, the least by a hash of all its columns. Rows without an id stay.
    """
    rows = labelled(documents, shingle_words, percent, band_rows, doc_id, text)
    dropped = stored(rows.where("doc_id IS NOT NULL AND NOT stays").select("doc_id", "content").distinct(), "dropped")
    names = documents.columns
    # All columns travel in one, so that no name of theirs meets one of ours.
    held = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(text).alias("content"), F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"))
    kept = held.where("doc_id IS NOT NULL").join(dropped, ["doc_id", "content"], "left_anti")
    told = [x for c in names for x in (F.col(f"row.`{c}`"), F.col(f"row.`{c}`").isNull())]
    best = Window.partitionBy("doc_id", "content").orderBy(F.xxhash64(*told))
    one = kept.withColumn("place", F.row_number().over(best)).where("place = 1")
    return one.select("row.*").unionByName(documents.where(F.col(doc_id).isNull()))
