"""Pack examples into sequences under several limits at once: the dot-product heuristic.

A sequence has room for tokens, for segments, and for tokens that bear loss. A sequence is
filled by always adding the example that fits and has the largest dot product of its demands
with the room that is left, both in units of the limits, weighted by how scarce each room is
in this block; it is closed when nothing fits.

Rows are dealt to blocks of about ``block_rows`` rows by a hash, and each block is packed by
itself, so blocks grow in number and not in size; packing loses at most one badly filled
sequence per block and limit. Examples of equal demands are one type, and a block's work
grows with its types and sequences.

Documents: a document's ids are cut into full sequences and one rest; full pieces stay alone,
rests are packed. A row of the shuffle is a document's number of ids and the checksums of its
pieces, not its ids.

Defined results: a null text is empty and has only the end id. A repeated row is packed again.
Equal demands go by id and then by checksum. An example above a limit by itself is an error, except that
documents are cut. Empty tables give no rows.
"""

from __future__ import annotations

import zlib
from itertools import pairwise

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.llm.hashing import chunks
from terrace.llm.tables import parts
from terrace.llm.tokens import word_tokenizer

CAPACITY = 2_048
MOST_SEGMENTS = 128
BLOCK_ROWS = 4_000
LAST_ID = 1
#: Sequence numbers of a block begin at its number times this.
BLOCK_SEQUENCES = 1 << 40
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def pack_vectors(demands: np.ndarray, limits: np.ndarray) -> np.ndarray:
    """The bin of every row. Bins are numbered from 0 as they are opened."""
    if not len(demands):
        return np.zeros(0, dtype=np.int64)
    if (demands > limits).any():
        raise ValueError("an example is larger than a sequence")
    types, kind = np.unique(demands, axis=0, return_inverse=True)
    kind = kind.reshape(-1)
    members = np.split(np.argsort(kind, kind="stable"), np.cumsum(np.bincount(kind))[:-1])
    left = np.array([len(m) for m in members])
    scaled = types / limits
    weight = np.maximum((scaled * left[:, None]).sum(axis=0), 1e-9)
    weighted = scaled * (weight / weight.sum())
    out, bins = np.zeros(len(demands), dtype=np.int64), 0
    alive = np.arange(len(types))
    while len(alive):
        room = limits.astype(np.int64).copy()
        fits = alive
        while len(fits):
            best = fits[np.argmax(weighted[fits] @ (room / limits))]
            left[best] -= 1
            out[members[best][left[best]]] = bins
            room -= types[best]
            fits = fits[(types[fits] <= room).all(axis=1) & (left[fits] > 0)]
        bins += 1
        alive = alive[left[alive] > 0]
    return out


def offsets_in(bins: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Where each row begins in its bin, rows of a bin one after the other."""
    order = np.argsort(bins, kind="stable")
    ends = np.cumsum(lengths[order])
    first = np.flatnonzero(np.r_[True, np.diff(bins[order]) != 0]) if len(bins) else np.zeros(0, dtype=np.int64)
    begins = ends - lengths[order]
    out = np.empty(len(bins), dtype=np.int64)
    out[order] = begins - np.repeat(begins[first], np.diff(np.r_[first, len(bins)]))
    return out


def pack_examples(
    examples: DataFrame,
    tokens: str = "tokens",
    loss_tokens: str = "loss_tokens",
    capacity: int = CAPACITY,
    most_segments: int = MOST_SEGMENTS,
    most_loss: int = CAPACITY,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """The examples, all columns, with ``sequence_id`` and ``offset``. Null counts are 0."""
    blocks = parts(examples, block_rows)
    names = examples.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in examples.schema)
    limits = np.array([capacity, 1, most_loss]) * np.array([1, most_segments, 1])
    dealt = examples.withColumn("_block", F.pmod(F.xxhash64(*names), F.lit(blocks)))

    def pack(block: pd.DataFrame) -> pd.DataFrame:
        number = int(block["_block"].iloc[0])
        rows = block.drop(columns="_block")
        rows = rows.iloc[pd.util.hash_pandas_object(rows.astype(str), index=False).argsort(kind="stable")].reset_index(drop=True)
        length = rows[tokens].fillna(0).to_numpy(dtype=np.int64)
        demand = np.stack([length, np.ones_like(length), rows[loss_tokens].fillna(0).to_numpy(dtype=np.int64)], axis=1)
        bins = pack_vectors(demand, limits)
        return rows.assign(sequence_id=bins + number * BLOCK_SEQUENCES, offset=offsets_in(bins, length))

    return dealt.groupBy("_block").applyInPandas(pack, f"{schema}, sequence_id long, offset long")


def document_pieces(documents: DataFrame, tokenizer: str, capacity: int, last_id: int, doc_id: str, text: str) -> DataFrame:
    """(doc_id, doc_tokens, checksums of its full pieces and of its rest)."""

    def encode(frames):
        coder = word_tokenizer(tokenizer)
        for frame in chunks(frames):
            ids, bounds = coder.encode(frame["text"].tolist(), last_id)
            ids = ids.astype("<u4", copy=False)
            sums = [[zlib.crc32(ids[i : min(i + capacity, b)]) for i in range(a, b, capacity)] for a, b in pairwise(bounds.tolist())]
            yield pd.DataFrame({"doc_id": frame["doc_id"], "doc_tokens": np.diff(bounds), "checksums": sums})

    chosen = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return chosen.mapInPandas(encode, "doc_id long, doc_tokens long, checksums array<long>")


def pack_documents(
    documents: DataFrame,
    tokenizer: str,
    capacity: int = CAPACITY,
    most_segments: int = MOST_SEGMENTS,
    most_loss: int = CAPACITY,
    block_rows: int = BLOCK_ROWS,
    last_id: int = LAST_ID,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per piece of a document: where it was cut from and where it lies.

    Every id of a document but its first bears loss.
    """
    blocks = parts(documents, block_rows)
    limits = np.array([capacity, most_segments, most_loss])
    pieces = document_pieces(documents, tokenizer, capacity, last_id, doc_id, text)
    dealt = pieces.withColumn("block", F.pmod(F.xxhash64("doc_id", "checksums"), F.lit(blocks)))

    def pack(block: pd.DataFrame) -> pd.DataFrame:
        base = int(block["block"].iloc[0]) * BLOCK_SEQUENCES
        block = block.assign(first=[c[0] for c in block["checksums"]], last=[c[-1] for c in block["checksums"]])
        block = block.sort_values(["doc_id", "doc_tokens", "first", "last"], kind="stable").reset_index(drop=True)
        size = block["doc_tokens"].to_numpy(dtype=np.int64)
        full, rest = np.divmod(size, capacity)
        row = np.repeat(np.arange(len(block)), full)
        place = np.arange(len(row)) - np.repeat(np.cumsum(full) - full, full)
        tail = np.flatnonzero(rest)
        demand = np.stack([rest[tail], np.ones(len(tail), dtype=np.int64), rest[tail] - (full[tail] == 0)], axis=1)
        bins = pack_vectors(demand, limits)
        which = np.r_[row, tail]
        piece = np.r_[place, full[tail]]
        length = np.r_[np.full(len(row), capacity), rest[tail]]
        sums = block["checksums"].to_numpy()
        return pd.DataFrame(
            {
                "doc_id": block["doc_id"].to_numpy()[which],
                "start": piece * capacity,
                "length": length,
                "ids_crc32": [int(sums[w][p]) for w, p in zip(which, piece, strict=True)],
                "doc_tokens": size[which],
                "sequence_id": base + np.r_[np.arange(len(row)), len(row) + bins],
                "offset": np.r_[np.zeros(len(row), dtype=np.int64), offsets_in(bins, rest[tail])],
            }
        )

    return dealt.groupBy("block").applyInPandas(pack, PIECES)


def sequence_ids(documents: DataFrame, placed: DataFrame, tokenizer: str, capacity: int = CAPACITY, last_id: int = LAST_ID, pad_id: int = 0, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(sequence_id, ids): the packed rows themselves, little-endian unsigned 32-bit, padded to ``capacity``.

    Needs documents with different ids; rows without an id are left out.
    """

    def cut(frames):
        coder = word_tokenizer(tokenizer)
        for frame in chunks(frames):
            ids, bounds = coder.encode(frame["text"].tolist(), last_id)
            ids, rows = ids.astype("<u4", copy=False), []
            for begin, places in zip(bounds.tolist(), frame["places"], strict=False):
                for p in places:
                    first = begin + p["start"]
                    rows.append((p["sequence_id"], p["offset"], ids[first : first + p["length"]].tobytes()))
            yield pd.DataFrame(rows, columns=["sequence_id", "offset", "ids"])

    places = placed.groupBy(F.col("doc_id").alias("_doc")).agg(F.collect_list(F.struct("sequence_id", "offset", "start", "length")).alias("places"))
    chosen = documents.select(F.col(doc_id).cast("long").alias("_id"), F.col(text).alias("text")).join(places, F.col("_id") == F.col("_doc"))
    pieces = chosen.select("text", "places").mapInPandas(cut, "sequence_id long, offset long, ids binary")

    def fill(rows: pd.DataFrame) -> pd.DataFrame:
        ids = np.frombuffer(b"".join(rows.sort_values("offset")["ids"]), dtype="<u4")
        whole = np.full(capacity, pad_id, dtype="<u4")
        whole[: len(ids)] = ids
        return pd.DataFrame({"sequence_id": [rows["sequence_id"].iloc[0]], "ids": [whole.tobytes()]})

    return pieces.groupBy("sequence_id").applyInPandas(fill, "sequence_id long, ids binary")
