"""Chat formatting after collapsing cumulative snapshots (operator 5).

A logger that writes a conversation again after every turn leaves many conversations that are
prefixes of longer ones. Every conversation gets rolling hashes of its turn prefixes; one whose
whole hash is a proper prefix hash of a longer conversation is dropped by an anti-join. Equal
conversations are represented by the one with the smallest id. The rest is rendered.

The rolling hash of the first k turns is the sum of k hashes of (place, role, text) modulo 2^40, in
``LANES`` lanes, so that a running sum gives it for any place. Places and sums are
built in two steps, within blocks of ``BLOCK`` turns and over the blocks, so a conversation of
any length is dealt over many groups. Prefix hashes are made distinct before the anti-join, so a
first turn that many conversations share is one row.

Turns are ordered by ``turn`` (null first), then role and text hash. A turn logged twice with
equal role and text counts once. Null roles and texts are distinct from empty ones when
compared and rendered as empty. Rows with a null ``conv_id`` form one conversation. Other
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlake.llm import common

#: Turns of a conversation that are numbered or rendered together.
BLOCK, LANES = 256, 3
START, END = "<|im_start|>", "<|im_end|>"
TOTAL = [f"lane{i}" for i in range(LANES)]


def _added(lane: str, window) -> Column:
    """A running sum modulo 2^40, taken over decimals: no number of turns overflows it."""
    total = F.sum(F.col(lane).cast("decimal(20,0)")).over(window)
    return F.pmod(total, F.lit(1 << 40).cast("decimal(20,0)")).cast("long")


def _lanes(place: Column, content: Column) -> list[Column]:
    """40-bit numbers from the hash of a turn at its place."""
    digest = F.sha2(F.concat_ws("|", place.cast("string"), content), 256)
    return [F.conv(F.substring(digest, 1 + 10 * i, 10), 16, 10).cast("long") for i in range(LANES)]


def content_hash() -> Column:
    """Hash of role and text in which null, empty and shifted borders all differ."""
    fields = [F.coalesce(F.concat(F.length(c).cast("string"), F.lit(":"), F.col(c)), F.lit("-")) for c in ("role", "text")]
    return F.sha2(F.concat(*fields), 256)


def turn_prefixes(turns: DataFrame) -> DataFrame:
    """``conv, turn, content, place, n_turns, block`` and the rolling hash up to each turn (lanes).

    ``conv`` is a struct of the id, so that a null id compares like any other.
    """
    rows = turns.select(
        F.struct("conv_id").alias("conv"),
        F.col("turn").cast("long").alias("turn"),
        content_hash().alias("content"),
    ).distinct()
    # Coarse blocks of turn numbers give each turn its place without one group a conversation.
    rows = rows.withColumn("span", F.coalesce(F.floor(F.col("turn") / BLOCK), F.lit(-(1 << 62))))
    within = Window.partitionBy("conv", "span").orderBy("turn", "content")
    rows = rows.withColumn("nth", F.row_number().over(within) - 1)
    sizes = rows.groupBy("conv", "span").agg(F.count("*").alias("size"))
    spans = Window.partitionBy("conv").orderBy("span")
    before = spans.rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(
        F.col("conv").alias("c"),
        F.col("span").alias("s"),
        F.coalesce(F.sum("size").over(before), F.lit(0)).alias("first"),
        F.sum("size").over(Window.partitionBy("conv")).alias("n_turns"),
    )
    rows = rows.join(sizes, (F.col("conv") == F.col("c")) & (F.col("span") == F.col("s"))).drop("c", "s")
    rows = rows.withColumn("place", F.col("first") + F.col("nth"))
    lanes = _lanes(F.col("place"), F.col("content"))
    rows = rows.withColumns({c: x for c, x in zip(TOTAL, lanes)})
    running = within.rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumns({c: _added(c, running) for c in TOTAL})
    sums = rows.groupBy("conv", "span").agg(*(F.max(F.struct("place", c))[c].alias(c) for c in TOTAL))
    sums = sums.select(
        F.col("conv").alias("c"),
        F.col("span").alias("s"),
        *(F.coalesce(_added(c, before), F.lit(0)).alias(f"{c}_before") for c in TOTAL),
    )
    rows = rows.join(sums, (F.col("conv") == F.col("c")) & (F.col("span") == F.col("s")))
    rows = rows.withColumns({c: F.pmod(F.col(c) + F.col(f"{c}_before"), F.lit(1 << 40)) for c in TOTAL})
    return rows.select("conv", "turn", "content", "place", "n_turns", *TOTAL)


def maximal(prefixes: DataFrame) -> DataFrame:
    """``conv, n_turns, n_copies`` of each distinct conversation that prefixes no longer one."""
    key = ["n", *TOTAL]
    length = (F.col("place") + 1).alias("n")
    whole = prefixes.where(F.col("place") + 1 == F.col("n_turns")).select("conv", length, *TOTAL)
    whole = whole.groupBy(*key).agg(F.min("conv").alias("conv"), F.count("*").alias("n_copies"))
    proper = prefixes.where(F.col("place") + 1 < F.col("n_turns")).select(length, *TOTAL).distinct()
    return whole.join(proper, key, "left_anti").select("conv", F.col("n").alias("n_turns"), "n_copies")


def rendered_turn(role: Column, text: Column) -> Column:
    empty = F.lit("")
    return F.concat(F.lit(START), F.coalesce(role, empty), F.lit("\n"), F.coalesce(text, empty), F.lit(f"{END}\n"))


def format_conversations(turns: DataFrame) -> DataFrame:
    """``conv_id, segment, n_turns, n_copies, n_segment_turns, rendered`` of the maximal conversations.

    A conversation is rendered in segments of ``BLOCK`` turns; their texts in the order of
    ``segment`` are the conversation. ``n_copies`` counts equal conversations.
    """
    prefixes = common.saved(turn_prefixes(turns), "turn_prefixes")
    keep = maximal(prefixes)
    places = prefixes.join(keep.select(F.col("conv").alias("kept"), "n_copies"), F.col("conv") == F.col("kept"))
    said = turns.select(
        F.struct("conv_id").alias("conv"),
        F.col("turn").cast("long").alias("turn"),
        content_hash().alias("content"),
        rendered_turn(F.col("role"), F.col("text")).alias("piece"),
    )
    same = said["conv"].eqNullSafe(places["conv"]) & said["turn"].eqNullSafe(places["turn"]) & (said["content"] == places["content"])
    rows = places.join(said, same).select(places["conv"], "place", "n_turns", "n_copies", "piece")
    rows = rows.withColumn("segment", F.floor(F.col("place") / BLOCK))
    # A turn logged twice has the same piece twice; the set keeps one, in the order of places.
    pieces = F.array_sort(F.collect_set(F.struct("place", "piece")))
    out = rows.groupBy("conv", "segment", "n_turns", "n_copies").agg(pieces.alias("pieces"))
    return out.select(
        F.col("conv.conv_id").alias("conv_id"),
        "segment",
        "n_turns",
        "n_copies",
        F.size("pieces").alias("n_segment_turns"),
        F.array_join(F.col("pieces.piece"), "").alias("rendered"),
    )


def op5_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_conversations(common.load(spark, sf_dir, "conversations"))


#: The same by plain SQL, for conversations without nulls and repeated turns: prefixes compared as lists.
ORACLE = f"""
WITH conv AS (
    SELECT conv_id, list((coalesce(role, ''), coalesce(text, '')) ORDER BY turn, role, text) AS said
    FROM (SELECT DISTINCT conv_id, turn, role, text FROM conversations) GROUP BY conv_id
), distinct_conv AS (
    SELECT min(conv_id) AS conv_id, count(*) AS n_copies, said, len(said) AS n FROM conv GROUP BY said
), prefix AS (
    SELECT DISTINCT md5(said[1:k]::VARCHAR) AS h, k
    FROM (SELECT said, n, unnest(range(1, n)) AS k FROM distinct_conv)
), kept AS (
    SELECT * FROM distinct_conv d
    WHERE NOT EXISTS (SELECT 1 FROM prefix p WHERE p.k = d.n AND p.h = md5(d.said::VARCHAR))
), turn AS (
    SELECT conv_id, n, n_copies, unnest(said) AS t, unnest(range(0, n)) AS place FROM kept
)
SELECT conv_id, place // {BLOCK} AS segment, n AS n_turns, n_copies,
       CAST(count(*) AS INTEGER) AS n_segment_turns,
       string_agg('{START}' || t[1] || chr(10) || t[2] || '{END}' || chr(10), '' ORDER BY place) AS rendered
FROM turn GROUP BY conv_id, place // {BLOCK}, n, n_copies
"""
