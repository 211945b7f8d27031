"""Best-fit packing by the sum-of-squares rule.

Documents become token sequences (a tokenizer's ids and an end id); those
longer than the capacity are cut into full pieces and a rest.  Pieces shorter
than the capacity are packed in hashed blocks: each goes where the sum over
residual gaps of the squared number of open bins with that gap becomes
smallest (a new bin counts as a place too; ties go to the smallest gap left),
long pieces first.
The pieces of bins that stay open are dealt into fewer blocks and packed again
until one block is left, so that blocks cost no more open bins than one block.
A block never grows: a bin closes when its gap is under the shortest piece still
open, and after a round that closed few bins twice as wide a gap counts as closed.

Results for odd input: a null or empty text is the end id alone; rows are
packed one by one, so repeated rows and null or repeated keys are all placed;
ties are broken by the row's place in the input; an empty table gives no
piece; very long texts are encoded whole and cut; other columns are not read,
whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import prepare, table
from riskframe.llm.tokens import open_tokenizer

CAPACITY = 4096
END_ID = 1
TOKENIZER = "word_bpe_49k.json"
#: pieces that one task packs
BLOCK = 16_384
#: a bin with at most so many free places counts as closed between the rounds
CLOSED = 4
#: a round that leaves more than this share of the pieces doubles the free places of a closed bin
FEW_CLOSE = 0.7

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PIECE_TYPES = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
PLACED = "rid long, " + PIECES + ", block long, bin long, offset long, fill long"


def pieces(docs: DataFrame, key: str = "doc_id", text: str = "text", tokenizer: str = TOKENIZER,
           capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """The pieces of each document, with the checksum of their ids."""
    end = np.array([end_id], dtype="<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = open_tokenizer(tokenizer)
        for batch in batches:
            rows = []
            for k, t in zip(batch.column(0).to_pylist(), batch.column(1)):
                t = t.as_py()
                raw = (coder.ids(t) if t else b"") + end
                n = len(raw) // 4
                for i, b in enumerate(range(0, n, capacity)):
                    e = min(n, b + capacity)
                    rows.append((k, i, b, e - b, zlib.crc32(raw[4 * b:4 * e])))
            columns = list(zip(*rows)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, PIECE_TYPES)],
                                             names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text")).mapInArrow(cut, PIECES)


def sum_of_squares(lengths: list[int], capacity: int) -> list[int]:
    """Bin of each length, in the order given (each length under the capacity)."""
    open_bins = np.zeros(capacity + 1, np.int64)  # by residual gap
    by_gap: list[list[int]] = [[] for _ in range(capacity + 1)]
    out, bins = [], 0
    for size in lengths:
        # change of the sum of squares, halved where it can be, for a bin of gap k + size
        here = open_bins[size:]
        change = 2 * (open_bins[: capacity - size + 1] - here) + 2
        change[here == 0] = 1 << 60
        change[0] = -2 * here[0] + 1 if here[0] else 1 << 60       # the bin closes
        change[capacity - size] = 2 * open_bins[capacity - size] + 1  # a new bin
        left = int(change.argmin())
        gap = left + size
        if gap == capacity:
            b, bins = bins, bins + 1
        else:
            b = by_gap[gap].pop()
            open_bins[gap] -= 1
        if left:
            by_gap[left].append(b)
            open_bins[left] += 1
        out.append(b)
    return out


def _packed(rows: pa.Table, capacity: int) -> pa.Table:
    length = rows["length"].to_numpy()
    rid = rows["rid"].to_numpy()
    order = np.lexsort((rid, -length))
    rows, length = rows.take(pa.array(order)), length[order]
    bins = np.array(sum_of_squares(length.tolist(), capacity), np.int64)
    by = pd.Series(length).groupby(bins)
    for name, values in (("bin", bins), ("offset", (by.cumsum() - length).to_numpy()), ("fill", by.transform("sum").to_numpy())):
        rows = rows.append_column(name, pa.array(values, pa.int64()))
    return rows.select([c.split()[0] for c in PLACED.split(", ")])


def pack(cut: DataFrame, capacity: int = CAPACITY, block_rows: int = BLOCK) -> DataFrame:
    """The pieces with sequence_id and offset; no two pieces overlap."""
    rows = cut.select(F.monotonically_increasing_id().alias("rid"), "*").checkpoint()
    full = rows.where(F.col("length") >= capacity).select(
        "*", (-F.col("rid") - 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    done, rest, turn, closed = full, rows.where(F.col("length") < capacity), 0, CLOSED
    count = rest.count()
    while count:
        blocks = -(-count // block_rows)
        placed = (rest.withColumn("block", F.pmod(F.xxhash64("rid", F.lit(turn)), F.lit(blocks)))
                  .groupBy("block").applyInArrow(lambda rows: _packed(rows, capacity), PLACED).checkpoint())
        if blocks > 1:
            is_open = F.col("fill") < capacity - closed
            # no piece that is still open fits into a gap under the shortest of them
            shortest = placed.where(is_open).agg(F.min("length")).first()[0] or 0
            is_open &= F.col("fill") <= capacity - shortest
        else:
            is_open = F.lit(False)
        # unique for each (round, block, bin); a block holds far fewer than 2^24 bins
        number = F.lit(turn).cast("long") * F.lit(1 << 56) + F.col("block") * F.lit(1 << 24) + F.col("bin")
        done = done.unionByName(placed.where(~is_open).select(*rows.columns, number.alias("sequence_id"), "offset"))
        rest = placed.where(is_open).select(*rows.columns)
        left = rest.count()
        if left > FEW_CLOSE * count:
            closed *= 2
        count, turn = left, turn + 1
    return done.drop("rid")


def op3_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    prepare(spark)
    return pack(pieces(table(spark, sf_dir, "documents").select("doc_id", "text")))
