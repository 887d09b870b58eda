"""Packing of token sequences into fixed windows by best-fit decreasing."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorloom.llm.tokens import default_tokenizer, encoder

BATCH = 500


class OpenWindows:
    """Open windows by remaining capacity.

    A segment tree over the capacities 0..window counts the open windows below
    each node; the tightest window that still takes ``length`` is the leftmost
    leaf at or right of ``length`` with a count."""

    def __init__(self, window: int):
        self.leaves = 1 << window.bit_length()
        self.tree = [0] * (2 * self.leaves)
        self.open: list[list[int]] = [[] for _ in range(window + 1)]

    def _add(self, capacity: int, n: int) -> None:
        node = capacity + self.leaves
        while node:
            self.tree[node] += n
            node >>= 1

    def put(self, window_id: int, capacity: int) -> None:
        if capacity:
            self.open[capacity].append(window_id)
            self._add(capacity, 1)

    def take(self, length: int) -> tuple[int, int] | None:
        """(window, its capacity) of the tightest open window for ``length``, now closed."""
        node, tree = length + self.leaves, self.tree
        while not tree[node]:
            while node & 1:  # a right child: go up to the first ancestor with a right neighbour
                node >>= 1
            if not node:
                return None
            node += 1
            if node & (node - 1) == 0:  # beyond the last leaf of this level
                return None
        while node < self.leaves:
            node *= 2
            if not tree[node]:
                node += 1
        capacity = node - self.leaves
        self._add(capacity, -1)
        return self.open[capacity].pop(), capacity


def best_fit_decreasing(lengths: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(window of each piece, its offset there); pieces are at most ``window`` long."""
    order = np.argsort(-lengths, kind="stable")
    place, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    tree, used = OpenWindows(window), 0
    for at in order.tolist():
        length = int(lengths[at])
        found = tree.take(length)
        if found is None:
            found, used = (used, window), used + 1
        place[at], offset[at] = found[0], window - found[1]
        tree.put(found[0], found[1] - length)
    return place, offset


def cut(docs: DataFrame, tokenizer: str, window: int, end_id: int, groups: int, keep_ids: bool) -> DataFrame:
    """One row per piece: full windows from the start of a document, then the rest."""
    fields = [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
              ("doc_tokens", pa.int64()), ("pack_group", pa.int64())] + [("ids", pa.list_(pa.int32()))] * keep_ids
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, pack_group long"
    schema += ", ids array<int>" * keep_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).encode
        count = TaskContext.get().partitionId()  # groups are dealt in turn, from another one in each task
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH):
                part = batch.slice(at, BATCH)
                columns: list[list] = [[] for _ in fields]
                for doc_id, ids in zip(part.column(0).to_pylist(), encode(part.column(1).to_pylist())):
                    ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                    for start in range(0, len(ids), window):
                        piece = ids[start:start + window]
                        row = [doc_id, start, len(piece), zlib.crc32(piece.tobytes()), len(ids), count % groups]
                        row += [piece.astype(np.int32)] * keep_ids
                        for column, value in zip(columns, row):
                            column.append(value)
                        count += 1
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, fields)],
                                                 names=[n for n, _ in fields])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


def pack(docs: DataFrame, tokenizer: str | None = None, window: int = 2048, end_id: int = 1,
         group_documents: int = 8192, keep_ids: bool = False) -> DataFrame:
    """Pack all documents into sequences of at most ``window`` tokens.

    A document is its token ids and ``end_id``.  It is cut into full windows
    from its start; the remaining piece shares a window with other pieces.
    Pieces are dealt in turn to groups of about ``group_documents`` documents,
    each packed by best-fit decreasing on its own, so that no task sees more
    than one group and a group leaves a few half-filled windows at most.

    Returns one row per piece: doc_id, start, length, ids_crc32 (of the
    little-endian 32-bit ids), doc_tokens, sequence_id, offset, and ``ids`` if
    asked for.  sequence_id is unique, not dense.

    A null or empty text is ``end_id`` alone.  Rows with a null or repeated
    doc_id are packed like any other.  An empty table gives no rows.  Other
    columns of the input are ignored.
    """
    groups = max(1, -(-docs.count() // group_documents))
    pieces = cut(docs, tokenizer or default_tokenizer(), window, end_id, groups, keep_ids)
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    schema += ", ids array<int>" * keep_ids
    columns = [c.split()[0] for c in schema.split(", ")]

    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        # a fixed order of the pieces, so that a repeated task packs alike
        group = group.sort_values(["length", "doc_id", "start", "ids_crc32"], ascending=[False, True, True, True])
        place, offset = best_fit_decreasing(group["length"].to_numpy(), window)
        return group.assign(sequence_id=place * groups + int(key[0]), offset=offset)[columns]

    return pieces.groupBy("pack_group").applyInPandas(run, schema)
