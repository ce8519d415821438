"""Best-fit packing by minimum bin slack (operator 8).

1. One pass cuts every document's tokens into pieces of at most ``cap`` tokens (written table).
2. The number of pieces of each length (at most ``cap`` numbers, however large the corpus) goes
   to the driver. ``minimum_bin_slack`` fixes the longest piece left, finds the fullest
   combination that fits beside it by a subset-sum bitset over the lengths still available,
   removes it, and goes on. While the same combination is available again it is taken again,
   so the work is bounded by the number of lengths, not of pieces.
3. The pieces are numbered within their length and find their bin and place by that number.
   Numbering is by (length, salt): a length that holds very many pieces is dealt over many
   groups, whose sizes give each group its first number.

Null texts count as empty (one piece, the separator alone). Repeated rows are packed each by
itself. An empty table gives no rows; a text of any length is cut whole. Among equally full
combinations the bitset's first one, of longer pieces, is taken; equal rows of equal length are
interchangeable. Other columns of the input are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlake.llm import common
from ledgerlake.llm.word_ids import word_ids

TOKENIZER = "word_bpe_49k.json"
CAP, SEPARATOR = 2048, 0
#: Pieces of one length numbered in one group.
GROUP_ROWS = 50_000
BATCH_CHARS = 1 << 20


def _cut(path: str, cap: int, separator: int):
    end = np.array([separator], "<u4").tobytes()

    @common.worker("word_ids")
    def run(batches):
        for batch in batches:
            raw = [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]
            rows, piece, start, length, crc = [], [], [], [], []
            for some in common.slices(list(range(len(raw))), [len(t) for t in raw], BATCH_CHARS):
                for i, ids in zip(some, word_ids(path).encode([raw[i] for i in some])):
                    ids += end
                    for k, at in enumerate(range(0, len(ids), 4 * cap)):
                        part = ids[at : at + 4 * cap]
                        rows.append(i)
                        piece.append(k)
                        start.append(at // 4)
                        length.append(len(part) // 4)
                        crc.append(zlib.crc32(part))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(rows, pa.int64())),
                    pa.array(piece, pa.int32()),
                    *(pa.array(x, pa.int64()) for x in (start, length, crc)),
                ],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return run


def pieces(docs: DataFrame, tokenizer: str | None = None, cap: int = CAP, separator: int = SEPARATOR) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32``: every document's tokens and a separator, cut."""
    path = tokenizer or public_tokenizers.path(TOKENIZER)
    common.prepare_workers(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        _cut(path, cap, separator), f"doc_id {kind}, piece int, start long, length long, ids_crc32 long"
    )


def fullest(left: dict[int, int], room: int) -> dict[int, int]:
    """The available lengths (with multiplicity) whose sum is the largest up to ``room``."""
    reach, mask, steps = 1, (1 << (room + 1)) - 1, []
    for length in sorted((x for x, c in left.items() if c and x <= room), reverse=True):
        rest, take = min(left[length], room // length), 1
        while rest:  # 1, 2, 4, ... copies at once
            take = min(take, rest)
            steps.append((length, take, reach))
            reach |= (reach << (length * take)) & mask
            rest -= take
            take *= 2
        if reach >> room & 1:
            break
    total, chosen = reach.bit_length() - 1, {}
    for length, take, before in reversed(steps):
        if not before >> total & 1:
            chosen[length] = chosen.get(length, 0) + take
            total -= length * take
    return chosen


def minimum_bin_slack(counts: dict[int, int], cap: int = CAP) -> list[tuple[dict[int, int], int]]:
    """Bins as (copies of each length, number of such bins); every counted piece is in one bin."""
    left = {x: c for x, c in counts.items() if c > 0}
    if any(not 0 < x <= cap for x in left):
        raise ValueError("lengths must be from 1 to the capacity")
    plan = []
    while left:
        longest = max(left)
        left[longest] -= 1
        chosen = fullest(left, cap - longest)
        left[longest] += 1
        chosen[longest] = chosen.get(longest, 0) + 1
        times = min(left[x] // m for x, m in chosen.items())
        for x, m in chosen.items():
            left[x] -= m * times
            if not left[x]:
                del left[x]
        plan.append((chosen, times))
    return plan


def _places(plan: list[tuple[dict[int, int], int]]):
    """Arrays sorted by (length, first number): where the pieces of a length go, run by run."""
    runs, used, bins = [], {}, 0
    for chosen, times in plan:
        offset = 0
        for length in sorted(chosen, reverse=True):
            copies = chosen[length]
            first = used.get(length, 0)
            runs.append((length, first, copies, bins, offset))
            used[length] = first + copies * times
            offset += length * copies
        bins += times
    runs.sort()
    return np.array(runs, np.int64).reshape(-1, 5)


def _assign(runs: np.ndarray):
    keys = (runs[:, 0] << 48) + runs[:, 1]

    def run(batches):
        for batch in batches:
            length = batch.column("length").to_numpy()
            number = batch.column("number").to_numpy()
            _, first, copies, bins, offset = runs[np.searchsorted(keys, (length << 48) + number, "right") - 1].T
            bin_no, slot = np.divmod(number - first, copies)
            out = [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays(
                [*out, pa.array(bins + bin_no), pa.array(offset + slot * length)],
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    return run


def pack(cut: DataFrame, cap: int = CAP, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Add ``sequence_id, offset`` to ``pieces()``; the result's sequences hold ``cap`` tokens at most."""
    cut = common.saved(cut, "pieces")
    counts = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}  # at most cap rows
    runs = _places(minimum_bin_slack(counts, cap))
    groups = [x for length, c in counts.items() if c > group_rows for x in (F.lit(length), F.lit(-(-c // group_rows)))]
    salts = F.coalesce(F.create_map(*groups)[F.col("length").cast("int")], F.lit(1)) if groups else F.lit(1)
    rows = cut.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), salts.cast("long")))
    keys = ["length", "salt"]
    sizes = rows.groupBy(*keys).agg(F.count("*").alias("size"))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    firsts = sizes.select(*keys, F.coalesce(F.sum("size").over(before), F.lit(0)).alias("first"))
    within = Window.partitionBy(*keys).orderBy("doc_id", "piece", "ids_crc32")
    numbered = rows.withColumn("number", F.row_number().over(within) - 1).join(firsts, keys)
    numbered = numbered.withColumn("number", (F.col("number") + F.col("first")).cast("long"))
    kind = cut.schema["doc_id"].dataType.simpleString()
    return numbered.select("doc_id", "piece", "start", "length", "ids_crc32", "number").mapInArrow(
        _assign(runs),
        f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long",
    )


def pack_documents(docs: DataFrame, tokenizer: str | None = None, cap: int = CAP) -> DataFrame:
    return pack(pieces(docs, tokenizer, cap), cap)


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(common.load(spark, sf_dir, "documents"))
