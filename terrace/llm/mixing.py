"""Mix sources to target weights: exact quotas, dealt to output shards by a splitting tree.

Each source is cut into blocks by a hash of its rows. Its target in words makes whole passes
over all its blocks and one pass over a part of them: blocks in an order drawn for this
pass, until the quota is used up; the last block is used up row by row and its last row word
by word, so a source's words meet its target exactly. With ``whole`` no row is cut: the row at
the end of a quota is taken whole if that comes nearer the quota (or as near), else not at all,
and a source's words miss its target by at most half of that row. The block draws of all sources are
then dealt to output shards: a tree halves the shards, and at each node a multivariate
hypergeometric draw says how many of every source's draws go left. Shards therefore hold
disjoint draws, and their source counts vary as in one random permutation of all draws.

On the driver are only one row per source (at most ``most_sources``, else an error) and the
tree's counts per source and shard. Rows meet their block by a join on (source, block); the
number of blocks grows with the rows, so that each block, sorted by a task, holds about
``BLOCK_ROWS`` of them at most; a source with a third of all rows has as many
blocks as any other. Written shards are cut along their drawn order into pieces of about
``PIECE_WORDS`` words, one task each, so tasks do not grow with the corpus. Equal input gives
equal output: every draw comes from a seed and hashes, never from row order.

Defined results: null and empty texts have size 0 and are taken 0 times. A null source is a
source of its own and comes last. A source without words has target 0. Repeated rows are
rows; which of two equal rows is cut makes no difference. An empty table gives no rows. Input
columns of any name come back unchanged.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from terrace.llm.tables import parts, stored
from terrace.llm.texts import words

BLOCKS = 4_096
BLOCK_ROWS = 16_384
SHARDS = 64
PIECE_WORDS = 1 << 24
MOST_REPEATS = 3
MOST_SOURCES = 1_000_000
WEIGHTS = (1, 2, 3)


def targets(sizes: list[int], weights: list[float], most_repeats: int = MOST_REPEATS) -> list[float]:
    """Shares of all sizes by weight; none above ``most_repeats`` times its size, the excess reshared."""
    size, weight = np.array(sizes, dtype=float), np.array(weights, dtype=float)
    limit, target, fixed = most_repeats * size, np.zeros(len(size)), np.zeros(len(size), dtype=bool)
    while not fixed.all():
        free = max(0.0, size.sum() - target[fixed].sum())
        target[~fixed] = free * weight[~fixed] / weight[~fixed].sum()
        above = ~fixed & (target > limit)
        if not above.any():
            break
        target[above], fixed = limit[above], fixed | above
    return target.tolist()


def splitting_tree(draws: np.ndarray, shards: int, seed: int) -> np.ndarray:
    """counts[source, shard] of block draws; the shards' totals differ by one at most."""
    out = np.zeros((len(draws), shards), dtype=np.int64)
    todo = [(0, shards, np.asarray(draws, dtype=np.int64))]
    total = int(np.sum(draws))
    before = lambda shard: total * shard // shards
    while todo:
        low, high, counts = todo.pop()
        if high - low == 1:
            out[:, low] = counts
            continue
        middle = (low + high) // 2
        chance = np.random.Generator(np.random.Philox(key=[seed, (low << 32) | high]))
        left = np.zeros_like(counts)
        room, rest = before(middle) - before(low), int(counts.sum())
        for source, count in enumerate(counts.tolist()):  # one hypergeometric draw per source, given those before it
            rest -= count
            taken = room if rest == 0 else int(chance.hypergeometric(count, rest, room)) if count and room else 0
            left[source] = taken
            room -= taken
        todo += [(low, middle, left), (middle, high, counts - left)]
    return out


def mix(
    documents: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    shards: int = SHARDS,
    blocks: int | None = None,
    seed: int = 20,
    most_repeats: int = MOST_REPEATS,
    most_sources: int = MOST_SOURCES,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    keep: tuple[str, ...] = (),
    whole: bool = False,
) -> DataFrame:
    """One row per document: its columns ``keep``, size, target of its source, words taken, and its draws.

    Without ``blocks``, a source has 4,096, or more if the table has over ``BLOCK_ROWS`` rows for each. ``draws`` lists (pass, shard, words): one element for each time the mix takes the document, whole
    or, in the last row of a quota and without ``whole``, its first words. Sources weigh ``weights`` in turn, by code point.
    """
    return _mix(documents, weights, shards, blocks, seed, most_repeats, most_sources, doc_id, text, source, keep, whole)[0]


def _mix(documents, weights, shards, blocks, seed, most_repeats, most_sources, doc_id, text, source, keep, whole) -> tuple[DataFrame, int]:
    """The rows of ``mix``, and the words of the whole table."""
    spark = documents.sparkSession
    blocks = max(BLOCKS, parts(documents, BLOCK_ROWS)) if blocks is None else blocks
    sized = documents.select(
        *[F.col(c) for c in keep],
        F.col(doc_id).alias("_id"),
        F.col(source).alias("_source"),
        F.size(words(F.col(text))).cast("long").alias("_size"),
        F.pmod(F.xxhash64(F.lit(seed), doc_id, text), F.lit(blocks)).cast("int").alias("_block"),
        F.xxhash64(F.lit(seed + 1), doc_id, text).alias("_order"),
    )
    if not keep:
        sized = stored(sized, "sized")
    block_sizes = stored(sized.groupBy("_source", "_block").agg(F.sum("_size").alias("_words")), "blocks")
    known = block_sizes.groupBy("_source").agg(F.sum("_words").alias("words"), F.count("*").alias("blocks")).limit(most_sources + 1).collect()
    if len(known) > most_sources:
        raise ValueError(f"more than {most_sources} sources; raise most_sources or group them first")
    known.sort(key=lambda r: (r["_source"] is None, (r["_source"] or "").encode()))
    wanted = targets([r["words"] for r in known], [weights[i % len(weights)] for i in range(len(known))], most_repeats)
    passes = [int(t // r["words"]) if r["words"] else 0 for t, r in zip(wanted, known, strict=True)]
    rest = [round(t) - p * r["words"] for t, p, r in zip(wanted, passes, known, strict=True)]
    plan = spark.createDataFrame(
        [(r["_source"], r["words"], t, p, q) for r, t, p, q in zip(known, wanted, passes, rest, strict=True)],
        "_source string, source_size long, target double, _passes int, _rest long",
    ) if known else spark.createDataFrame([], "_source string, source_size long, target double, _passes int, _rest long")
    plan = plan.withColumn("_source", F.col("_source").cast(sized.schema["_source"].dataType))
    same_source = lambda a, b: a["_source"].eqNullSafe(b["_source"])

    order = lambda turn: F.xxhash64(F.lit(seed + 2), turn, F.col("_source"), F.col("_block"))
    drawn = Window.partitionBy("_source").orderBy(order(F.lit(most_repeats)), "_block")
    cut = block_sizes.join(plan, same_source(block_sizes, plan)).drop(plan["_source"])
    cut = cut.withColumn("_left", F.col("_rest") - (F.sum("_words").over(drawn.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_words")))

    # Every draw of a block: one for each whole pass, and one for the part pass if anything of it is taken.
    turns = F.concat(
        F.when(F.col("_passes") > 0, F.sequence(F.lit(0), F.col("_passes") - 1)).otherwise(F.array().cast("array<int>")),
        F.when((F.col("_left") > 0) & (F.col("_words") > 0), F.array(F.lit(most_repeats))).otherwise(F.array().cast("array<int>")),
    )
    draws = stored(cut.withColumn("_turn", F.explode(turns)), "draws")
    dealt = Window.partitionBy("_source").orderBy("_turn", order(F.col("_turn")), "_block")
    counts = {r["_source"]: r["n"] for r in draws.groupBy("_source").agg(F.count("*").alias("n")).collect()}
    per_shard = splitting_tree(np.array([counts.get(r["_source"], 0) for r in known], dtype=np.int64), shards, seed) if known else np.zeros((0, shards), dtype=np.int64)
    ends = spark.createDataFrame([(r["_source"], c) for r, c in zip(known, np.cumsum(per_shard, axis=1).tolist(), strict=True)], "_source string, _ends array<long>")
    ends = ends.withColumn("_source", F.col("_source").cast(sized.schema["_source"].dataType))
    ranked = draws.withColumn("_rank", F.row_number().over(dealt) - 1)
    placed = ranked.join(ends, same_source(ranked, ends)).drop(ends["_source"])
    placed = placed.withColumn("_shard", F.size(F.filter("_ends", lambda e: e <= F.col("_rank"))))
    shards_of = placed.groupBy("_source", "_block").agg(F.sort_array(F.collect_list(F.struct(F.col("_turn").alias("turn"), F.col("_shard").alias("shard")))).alias("_draws"))
    planned = cut.drop("_words", "_rest")
    per_block = planned.join(shards_of, same_source(planned, shards_of) & (planned["_block"] == shards_of["_block"]), "left").drop(shards_of["_source"], shards_of["_block"])
    per_block = stored(per_block, "block-plan")

    rows = sized.join(per_block, same_source(sized, per_block) & (sized["_block"] == per_block["_block"])).drop(per_block["_source"], per_block["_block"])
    inside = Window.partitionBy("_source", "_block").orderBy("_order", "_id").rowsBetween(Window.unboundedPreceding, 0)
    open_words = F.col("_left") - (F.sum("_size").over(inside) - F.col("_size"))
    part = F.when(2 * open_words >= F.col("_size"), F.col("_size")).otherwise(0) if whole else F.greatest(F.lit(0), F.least(F.col("_size"), open_words))
    rows = rows.withColumn("_part", part)
    taken = F.transform(
        F.coalesce("_draws", F.array().cast("array<struct<turn:int,shard:int>>")),
        lambda d: F.struct(d["turn"].alias("turn"), d["shard"].alias("shard"), F.when(d["turn"] == most_repeats, F.col("_part")).otherwise(F.col("_size")).alias("words")),
    )
    told = rows.select(
        *[F.col(c) for c in keep],
        F.col("_id").alias("mixed_id"),
        F.col("_size").alias("size"),
        "source_size",
        "target",
        (F.col("_passes") * F.col("_size") + F.col("_part")).alias("taken"),
        F.filter(taken, lambda d: d["words"] > 0).alias("draws"),
    )
    return told, sum(r["words"] for r in known)


def mixed_documents(
    documents: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    shards: int = SHARDS,
    blocks: int | None = None,
    seed: int = 20,
    most_repeats: int = MOST_REPEATS,
    most_sources: int = MOST_SOURCES,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    whole: bool = False,
) -> DataFrame:
    """The rows of the mix, with the documents' own columns, dealt to shards and in a drawn order inside each.

    A document that is taken n times is n rows. All are whole with ``whole``; without it, the one
    row that ends a source's quota keeps its first words, so that the words meet the target.
    A shard is one partition, or several that follow each other in its order if it has over ``PIECE_WORDS`` words.
    """
    names = documents.columns
    # The columns travel in one, so that no name of theirs meets one of ours.
    held = documents.select(
        F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"), F.col(doc_id).alias("_doc"), F.col(text).alias("_text"), F.col(source).alias("_from")
    )
    mixed, total = _mix(held, weights, shards, blocks, seed, most_repeats, most_sources, "_doc", "_text", "_from", ("_row",), whole)
    rows = mixed.select("_row", "size", F.explode("draws").alias("_draw"))
    order = F.xxhash64(F.lit("order"), F.col("_row"), F.col("_draw.turn"))
    pieces = max(1, -(-total // (shards * PIECE_WORDS)))
    piece = F.least(F.lit(pieces - 1), F.floor((F.col("_at").cast("double") / 2.0**64 + 0.5) * pieces)).cast("int")
    placed = rows.select("_row", "size", "_draw", order.alias("_at")).repartitionById(shards * pieces, F.col("_draw.shard") * pieces + piece)
    dealt = placed.sortWithinPartitions("_at")
    own = lambda c: F.col("_row").getField(c)
    cut = F.when(F.col("_draw.words") < F.col("size"), F.array_join(F.slice(words(own(text)), F.lit(1), F.col("_draw.words").cast("int")), " "))
    return dealt.select(*[(F.coalesce(cut, own(c)) if c == text else own(c)).alias(c) for c in names])
