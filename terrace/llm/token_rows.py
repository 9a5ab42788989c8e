"""Token ids as packed rows of one width: best-fit decreasing, found in a segment tree.

Documents become token ids with an end id; one that is longer than a row is split, nothing of
it lost. Pieces go longest first, each into the open row with the least room that holds it.
The open rows stand in a segment tree over their room, one leaf per possible room, so the
best row is found in steps that grow with the logarithm of the width.

Rows of documents are dealt by a hash to blocks of about ``block_rows`` rows; each block is
packed by itself. A block's ids are in one task's memory, a block grows in number only.

Defined results: a null text is empty and has only the end id. Repeated rows are packed again.
Pieces of one length go by id, start and content. An empty table gives no rows.
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

WIDTH = 2_048
BLOCK_ROWS = 2_000
LAST_ID = 1
PAD_ID = 0
ROWS = "row_id long, n_tokens int, doc_ids array<long>, starts array<long>, cu_seqlens array<int>, ids binary, ids_crc32 long, position_ids binary"


class RoomTree:
    """Counts of open rows by room 0 to ``most``; finds the least room that is enough."""

    def __init__(self, most: int):
        self.leaves = 1 << most.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.rows: list[list[int]] = [[] for _ in range(most + 1)]

    def add(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        self._step(room, 1)

    def _step(self, room: int, by: int) -> None:
        node, count = room + self.leaves, self.count
        while node:
            count[node] += by
            node >>= 1

    def take(self, least: int) -> tuple[int, int] | None:
        """(room, row) of the row with the least room of at least ``least``, removed."""
        node, count = least + self.leaves, self.count
        if not count[node]:
            while node > 1 and (node & 1 or not count[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if count[2 * node] else 2 * node + 1
        room = node - self.leaves
        self._step(room, -1)
        return room, self.rows[room].pop()


def best_fit_decreasing(lengths: np.ndarray, width: int) -> np.ndarray:
    """The row of every piece; pieces are placed longest first, equal ones in the given order."""
    tree, out, opened = RoomTree(width), np.zeros(len(lengths), dtype=np.int64), 0
    for piece in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[piece])
        room, row = tree.take(length) or (width, opened)
        opened += row == opened
        out[piece] = row
        if room > length:
            tree.add(room - length, row)
    return out


def token_rows(
    documents: DataFrame,
    tokenizer: str,
    width: int = WIDTH,
    block_rows: int = BLOCK_ROWS,
    last_id: int = LAST_ID,
    pad_id: int = PAD_ID,
    id_type: str = "<u2",
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row of the matrix per result row.

    ``ids`` are ``width`` little-endian numbers of ``id_type``, padded; ``cu_seqlens`` has the pieces'
    ends from 0 on, ``starts`` where each piece lies in its document, ``position_ids`` each id's place
in its piece (little-endian, 2 bytes up to a width of 65,536, else 4). Ids that ``id_type`` cannot hold
    are an error.
    """
    blocks = parts(documents, block_rows)
    most = np.iinfo(id_type).max

    def encode(frames):
        coder = word_tokenizer(tokenizer)
        for frame in chunks(frames):
            ids, bounds = coder.encode(frame["text"].tolist(), last_id)
            if ids.max() > most:
                raise ValueError(f"token id {ids.max()} does not fit {id_type}")
            ids = ids.astype(id_type)
            yield pd.DataFrame({"doc_id": frame["doc_id"], "ids": [ids[a:b].tobytes() for a, b in pairwise(bounds.tolist())]})

    chosen = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    dealt = chosen.mapInPandas(encode, "doc_id long, ids binary").withColumn("block", F.pmod(F.xxhash64("doc_id", "ids"), F.lit(blocks)))
    size = np.dtype(id_type).itemsize

    def pack(block: pd.DataFrame) -> pd.DataFrame:
        base = int(block["block"].iloc[0]) << 40
        block = block.assign(sum=[zlib.crc32(x) for x in block["ids"]]).sort_values(["doc_id", "sum"], kind="stable")
        names, whole = block["doc_id"].to_numpy(dtype=object), block["ids"].to_list()
        pieces = [(d, s, min(width, len(x) // size - s)) for d, x in enumerate(whole) for s in range(0, len(x) // size, width)]
        rows = best_fit_decreasing(np.array([p[2] for p in pieces]), width)
        out = []
        order = np.argsort(rows, kind="stable")
        for members in np.split(order, np.flatnonzero(np.diff(rows[order])) + 1):
            inside = [pieces[i] for i in members.tolist()]
            ends = np.cumsum([0] + [n for _, _, n in inside])
            data = b"".join([whole[d][size * s : size * (s + n)] for d, s, n in inside])
            pad = np.full(width - int(ends[-1]), pad_id, dtype=id_type).tobytes()
            ids = [None if pd.isna(names[d]) else int(names[d]) for d, _, _ in inside]
            places = position_resets(ends.tolist(), width).astype(position_type(width)).tobytes()
            out.append((base + int(rows[members[0]]), int(ends[-1]), ids, [s for _, s, _ in inside], ends.tolist(), data + pad, zlib.crc32(data), places))
        return pd.DataFrame(out, columns=["row_id", "n_tokens", "doc_ids", "starts", "cu_seqlens", "ids", "ids_crc32", "position_ids"])

    return dealt.groupBy("block").applyInPandas(pack, ROWS)


def position_type(width: int) -> str:
    return "<u2" if width <= 65_536 else "<u4"


def position_resets(cu_seqlens: list[int], width: int) -> np.ndarray:
    """Position ids of a row: each piece counts from 0, and so does the padding."""
    ends = np.unique(np.r_[np.asarray(cu_seqlens, dtype=np.int64), width])
    starts = np.repeat(ends[:-1], np.diff(ends))
    return (np.arange(width) - starts).astype(np.int32)


def write_matrix(rows: DataFrame, path: str) -> None:
    """Files of packed id rows with segment ends and position resets, one row per matrix row."""
    rows.write.parquet(path)
