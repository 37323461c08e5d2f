"""Sharding by histogram sort, on DataFrame operations only.

Rows get a 62-bit sort key: 40 bits of the text's hash, then 22 bits of the id's hash. Equal texts
are thus neighbours, and a group of copies of any size can still be cut by the id bits. Splitters
that cut the key order into pieces of equal bytes are found by counting, not by sampling: a first
job counts exact bytes and rows in the 4096 prefixes of 12 bits; every splitter that no prefix
boundary meets within the tolerance is refined by a job that counts 256 narrower probes inside its
prefix alone, and so on. Only these bounded histograms reach the driver. Then one exchange brings
every row to its cell (a fixed part of a shard), where rows are numbered; exact counts per cell
turn that into slots without gaps.

Cases: null text has no bytes (size 8, CRC of the empty string) and sorts as the empty text; a null
id counts as its own id value; identical rows share a key and stay in one cell; an empty table
gives an empty result. Documents are never cut, so a shard may differ from the mean by the size of
the document at its border.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import pinned

KEY_BITS = 62
FIRST_BITS = 12
NEXT_BITS = 8
ID_BITS = 22


def sort_key(text: Column, doc_id: Column) -> Column:
    """62 bits, not negative: equal texts are neighbours in this order."""
    high = F.shiftrightunsigned(F.xxhash64(F.coalesce(text, F.lit(""))), 64 - (KEY_BITS - ID_BITS))
    low = F.shiftrightunsigned(F.xxhash64(F.coalesce(doc_id.cast("string"), F.lit(""))), 64 - ID_BITS)
    return F.shiftleft(high, ID_BITS).bitwiseOR(low)


def find_splitters(keyed: DataFrame, pieces: int, key: str, weight: str, tolerance: float = 0.005) -> list[int]:
    """Keys s_1 <= ... <= s_(pieces-1): piece i holds the rows with s_i <= key < s_(i+1). The weight
    below s_i differs from i / pieces of the total by at most ``tolerance`` of a piece, or by what
    the rows of one key (or, above 2^62 keys, one document) weigh."""

    def counted(frame: DataFrame, shift: int) -> list[tuple[int, int]]:
        rows = (frame.groupBy(F.shiftrightunsigned(F.col(key), shift).alias("bin")).agg(F.sum(weight).alias("w")).collect())
        return sorted((r["bin"], r["w"]) for r in rows)

    shift = KEY_BITS - FIRST_BITS
    bins = counted(keyed, shift)
    total = sum(w for _, w in bins)
    slack = tolerance * total / pieces
    found: dict[int, int] = {}
    open_: dict[int, tuple[int, int]] = {}  # splitter -> (prefix that holds it, weight below that prefix)

    def place(i: int, inside: Sequence[tuple[int, int]], below: int, shift: int) -> None:
        goal = i * total / pieces
        for number, w in inside:
            if below + w < goal:
                below += w
                continue
            before, after = goal - below, below + w - goal
            if min(before, after) <= slack or shift == 0:
                found[i] = (number if before < after else number + 1) << shift
            else:
                open_[i] = (number, below)
            return
        found[i] = 1 << KEY_BITS

    for i in range(1, pieces):
        place(i, bins, 0, shift)
    while open_:
        step = min(NEXT_BITS, shift)
        prefixes = sorted({number for number, _ in open_.values()})
        prefix = F.shiftrightunsigned(F.col(key), shift)
        inside = counted(keyed.where(prefix.isin(prefixes)), shift - step)
        todo, open_, shift = open_, {}, shift - step
        for i, (number, below) in todo.items():
            place(i, [x for x in inside if x[0] >> step == number], below, shift)
    out = []
    for i in range(1, pieces):  # rounding to either side must not cross
        out.append(max(found[i], out[-1] if out else 0))
    return out


def piece_of(key: Column, splitters: Sequence[int]) -> Column:
    """Number of splitters at or below the key, by binary search in nested conditions."""
    def search(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(key < F.lit(splitters[mid]), search(lo, mid)).otherwise(search(mid + 1, hi))
    return search(0, len(splitters))


def assign_shards(docs: DataFrame, shards: int = 24, doc_id: str = "doc_id", text: str = "text",
                  tolerance: float = 0.005, cells_per_shard: int = 8) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of every row; sizes near equal over the shards
    (``tolerance``: share of a shard). ``cells_per_shard``: parts of a shard that are numbered by
    tasks of their own."""
    body = F.coalesce(F.col(text), F.lit(""))
    keyed = pinned(docs.select(
        F.col(doc_id).alias("doc_id"), (F.octet_length(body) + 8).cast("long").alias("size"),
        F.crc32(body).alias("text_crc32"), sort_key(F.col(text), F.col(doc_id)).alias("key")))
    splitters = find_splitters(keyed, shards * cells_per_shard, "key", "size", tolerance * cells_per_shard)
    celled = keyed.withColumn("cell", piece_of(F.col("key"), splitters))
    counts = celled.groupBy("cell").agg(F.count(F.lit(1)).alias("n"))
    # one row per cell: shards * cells_per_shard rows at most
    offsets = counts.select(
        F.col("cell").alias("at"),
        F.coalesce(F.sum("n").over(Window.partitionBy(F.floor(F.col("cell") / cells_per_shard)).orderBy("cell")
                                   .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    number = F.row_number().over(Window.partitionBy("cell").orderBy("key", "doc_id", "text_crc32", "size"))
    return (celled.withColumn("number", number)
            .join(F.broadcast(offsets), F.col("cell") == F.col("at"))
            .select("doc_id", "size", "text_crc32",
                    F.floor(F.col("cell") / cells_per_shard).cast("int").alias("shard"),
                    (F.col("before") + F.col("number") - 1).cast("long").alias("slot")))


def write_shards(docs: DataFrame, path: str, shards: int = 24, doc_id: str = "doc_id", text: str = "text",
                 tolerance: float = 0.005) -> None:
    """Write whole rows as Parquet, one folder ``shard=i`` per shard, rows of a shard in key order:
    one exchange of the rows, by ranges that the splitters fix."""
    keyed = docs.select(F.struct("*").alias("row"), sort_key(F.col(text), F.col(doc_id)).alias("key"),
                        (F.octet_length(F.coalesce(F.col(text), F.lit(""))) + 8).alias("size"))
    splitters = find_splitters(keyed, shards, "key", "size", tolerance)
    (keyed.withColumn("shard", piece_of(F.col("key"), splitters)).repartition(shards, "shard")
     .sortWithinPartitions("shard", "key").select("row", "shard")
     .write.partitionBy("shard").parquet(path))
