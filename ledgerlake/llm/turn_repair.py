"""Conversation structure repair by scalar big-integer weights (operator 11).

A conversation's rows, by turn, are kept (``K``), given the role user or assistant (``R``),
deleted (``D``), or a row without text is inserted (``I``), so that the roles' initials read
``(s?(ua)+)?``. The cheapest edits win; among equally cheap ones the ASCII-least audit (the
edits' initials in order).

*Weights.* A path's weight is one integer: its cost above ``W`` low bits, in which the audit's
letters stand from the top, ``BITS`` bits each, with zeros after the last one. So the ordinary
minimum of two integers compares costs first and audits second. The DAG's nodes are a row and
what has been written so far (nothing, s, u, a); going from the last row to the first, an edit
in front of a path shifts the path's letters down and adds its own (``in_front``).

*Length.* Rows are sorted by range, so one conversation may cover many partitions, and are cut
into blocks of at most ``BLOCK`` rows. Each block gives its best path from every state to every
state; a conversation joins its blocks' paths from the last to the first, again by integer
minimum. Tasks hold one block, or one conversation's audits (its result). The repaired lines are
hashed in a stream, row after row; no conversation's texts are held together.

*Bounds used.* At most one insert stands between two rows that stay: two of them could be left
out together, or with the lone s before them deleted, for less. An insert never stands before a
deletion: the audit with the two swapped is smaller and gives the same rows. So inserts are tried
only before a row that stays and at the end.

Nulls in role, text, conv_id and turn are one space where they are text; a null conv_id is a
conversation of its own, a null turn comes first. Rows of one turn are taken by role, then text;
equal rows are counted before the shuffle and all but the first are duplicates. A conversation
without rows, and one emptied by deletions, has an empty audit and the empty text's hash where
nothing is left; an empty table gives no rows. Very long texts pass the hash as they are. Other
columns are ignored, whatever their names.
"""

from __future__ import annotations

import functools
import hashlib
import itertools

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm import common

#: Rows of a conversation that one search covers.
BLOCK = 256
#: Costs of the edits, and of each undeleted row whose text ends early.
DELETE, REROLE, INSERT, TRUNCATED = 2, 1, 5, 5
#: Letters by their order in ASCII; 0 pads.
LETTERS = "\0DIKR"
BITS = 3
#: What has been written: nothing, a row with initial s, u, a.
STATES = "-sua"
#: The state after writing initial c in a state (absent: not allowed).
AFTER = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}
NEXT = {0: "u", 1: "u", 2: "a", 3: "u"}
ROLES = {"u": "user", "a": "assistant"}
ENDS = r"[.!?]"
BLANKS = r"\x20\x09-\x0D"


# --- weights ------------------------------------------------------------------------------------
def in_front(letter: str, cost: int, path: int, width: int) -> int:
    """The weight of ``path`` with one edit before it; ``width`` low bits hold the letters."""
    low = path & ((1 << width) - 1)
    return ((path >> width) + cost << width) | LETTERS.index(letter) << (width - BITS) | low >> BITS


def audit_of(path: int, width: int) -> str:
    low = path & ((1 << width) - 1)
    # One octal digit is one letter.
    return f"{low:0{width // BITS}o}".rstrip("0").translate({48 + k: LETTERS[k] for k in range(1, len(LETTERS))}) if low else ""


def weight_of(cost: int, audit: str, width: int) -> int:
    digits = audit.translate({ord(LETTERS[k]): 48 + k for k in range(1, len(LETTERS))})
    return cost << width | (int(digits, 8) << (width - BITS * len(audit)) if audit else 0)


def _width(letters: int) -> int:
    return BITS * (letters + 1)


@functools.lru_cache(maxsize=4096)
def block_paths(rows: tuple[str, ...]) -> list[list[tuple[int, str] | None]]:
    """Best ``(cost, audit)`` from each state before the rows to each state after them.

    A row is its role's initial and its fault: ``x`` must be deleted, ``t`` ends early, ``.`` none.
    """
    width = _width(2 * len(rows))
    table: list[list[tuple[int, str] | None]] = [[None] * 4 for _ in range(4)]
    for end in range(4):
        best: list[int | None] = [None] * 4
        best[end] = 0
        for row in reversed(rows):
            initial, fault = row[:-1], row[-1]
            new: list[int | None] = [None] * 4
            for state in range(4):
                ways = []
                if best[state] is not None:
                    ways.append(in_front("D", DELETE, best[state], width))
                if fault != "x":
                    stay = TRUNCATED if fault == "t" else 0
                    for at, inserted in ((state, False), (AFTER[state, NEXT[state]], True)):
                        here = []
                        kept = AFTER.get((at, initial))
                        if kept is not None and best[kept] is not None:
                            here.append(in_front("K", stay, best[kept], width))
                        given = AFTER[at, NEXT[at]]
                        if best[given] is not None:
                            here.append(in_front("R", stay + REROLE, best[given], width))
                        ways += [in_front("I", INSERT, w, width) for w in here] if inserted else here
                new[state] = min(ways, default=None)
            best = new
        for state in range(4):
            if best[state] is not None:
                table[state][end] = (best[state] >> width, audit_of(best[state], width))
    return table


#: Best end of a conversation from each state: nothing more, or the assistant's row that is missing.
CLOSING: list[tuple[int, str] | None] = [(0, ""), None, (INSERT, "I"), (0, "")]


def join_blocks(tables: list[list[list[tuple[int, str] | None]]]) -> tuple[int, list[str]]:
    """Cost and audits, block by block, of the cheapest edits of a conversation (the closing insert is in the last)."""
    width = _width(1)
    after = [None if c is None else weight_of(*c, width) for c in CLOSING]
    chosen: list[list[int | None]] = []
    for table in reversed(tables):
        longest = max(len(p[1]) for row in table for p in row if p)
        wider = width + BITS * longest
        now: list[int | None] = [None] * 4
        to: list[int | None] = [None] * 4
        for state in range(4):
            for end in range(4):
                path = table[state][end]
                if path is None or after[end] is None:
                    continue
                cost, low = after[end] >> width, after[end] & ((1 << width) - 1)
                joined = weight_of(path[0] + cost, path[1], wider) | low << (wider - width - BITS * len(path[1]))
                if now[state] is None or joined < now[state]:
                    now[state], to[state] = joined, end
        after, width = now, wider
        chosen.append(to)
    state, audits = 0, []
    for table, to in zip(tables, reversed(chosen)):
        end = to[state]
        audits.append(table[state][end][1])
        state = end
    closing = CLOSING[state][1]
    cost = after[0] >> width
    if audits:
        audits[-1] += closing
    return cost, audits


# --- rows ---------------------------------------------------------------------------------------
def _text(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(" "))


def damaged(turns: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, times`` of the rows after damage."""
    rows = turns.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        _text(F.col("role")).alias("role"),
        _text(F.col("text")).alias("text"),
        (F.crc32(F.concat(_text(F.col("conv_id")), F.lit(":"), _text(F.col("turn"))).cast("binary")) % 20).alias("kind"),
    ).where("kind <> 0")
    kind = F.col("kind")
    return rows.select(
        "conv_id",
        "turn",
        F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace("text", ENDS, "")).otherwise(F.col("text")).alias("text"),
        F.when(kind == 3, 2).otherwise(1).cast("long").alias("times"),
    )


def ordered(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, fault, at, block`` of every row, ``at`` rising in a conversation (written table).

    Rows are ranged over the partitions by conversation, turn, role and text. A duplicate has an
    empty text: it is deleted.
    """
    # One key stands for conversation, role and text (lengths keep them apart).
    parts = [F.coalesce(F.concat(F.length(c), F.lit(":"), c), F.lit("-")) for c in (F.col("conv_id").cast("string"), F.col("role"), F.col("text"))]
    rows = rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("times").alias("times"))
    rows = common.saved(rows.withColumn("said", F.unhex(F.sha2(F.concat(*parts), 256))), "turns")
    turn = F.struct(F.col("turn").isNotNull().alias("given"), "turn")
    firsts = rows.groupBy("said").agg(F.min(turn).alias("first"))
    rows = rows.join(firsts, "said")
    earlier = ~F.col("first.turn").eqNullSafe(F.col("turn"))
    # The last character that is not white space; empty if there is none.
    last = F.regexp_extract("text", rf"([^{BLANKS}])[{BLANKS}]*\z", 1)
    rows = rows.select(
        "conv_id", "turn", "role", "text", "times", earlier.alias("earlier"),
        F.when(last == "", "b").when(F.col("earlier"), "d").when(last.rlike(ENDS), ".").otherwise("t").alias("fault"),
    )
    rows = rows.repartitionByRange("conv_id", "turn", "role", "text").sortWithinPartitions("conv_id", "turn", "role", "text")
    rows = rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))))
    again = (F.col("copy") > 1) & (F.col("fault") != "b")
    fault = F.when(again, "d").otherwise(F.col("fault"))
    rows = rows.withColumn("fault", fault).withColumn("at", F.monotonically_increasing_id())
    text = F.when(F.col("fault").isin("b", "d"), "").otherwise(F.col("text"))
    rows = rows.select("conv_id", "turn", "role", text.alias("text"), "fault", "at", F.expr(f"at div {BLOCK}").alias("block"))
    return common.saved(rows, "ordered")


_BLOCKS = "block long, costs array<long>, audits array<string>, first string, last string, illegal long"
_EDITS = "block long, edits string, illegal long, cost long, audit string"


def _illegal(initials: list[str], others: list[str]) -> int:
    """Neighbours that no conversation may have."""
    return sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, others))


def _runs(batches, keys: tuple[str, ...], columns: tuple[str, ...]):
    """Runs of rows with equal keys, as (keys, columns' lists); rows come sorted. Only one run is held."""
    here, held = None, None
    for batch in batches:
        for key, *row in zip(zip(*(batch.column(k).to_pylist() for k in keys)), *(batch.column(c).to_pylist() for c in columns)):
            if key != here or held is None:
                if held is not None:
                    yield here, held
                here, held = key, [[] for _ in columns]
            for values, v in zip(held, row):
                values.append(v)
    if held is not None:
        yield here, held


def _rows_out(found, kinds: list[pa.Field], size: int = 4096):
    """Record batches of some rows each."""
    schema, held = pa.schema(kinds), []
    for row in found:
        held.append(row)
        if len(held) >= size:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def _peeked(batches):
    """The type of ``conv_id`` (None without rows) and the batches."""
    first = next(iter(batches), None)
    return (None, ()) if first is None else (first.schema.field("conv_id"), itertools.chain([first], batches))


def _search(batches):
    """Every block's best paths between all states, and its border roles."""
    conv, batches = _peeked(iter(batches))
    if conv is None:
        return

    def found():
        for (c, b), (initials, faults) in _runs(batches, ("conv_id", "block"), ("initial", "fault")):
            paths = block_paths(tuple(i + ("x" if f in "bd" else f) for i, f in zip(initials, faults)))
            flat = [p for row in paths for p in row]
            costs, audits = [p and p[0] for p in flat], [p and p[1] for p in flat]
            yield c, b, costs, audits, initials[0], initials[-1], _illegal(initials, initials[1:])

    text, number = pa.string(), pa.int64()
    kinds = [("block", number), ("costs", pa.list_(number)), ("audits", pa.list_(text)), ("first", text), ("last", text), ("illegal", number)]
    yield from _rows_out(found(), [conv, *(pa.field(*k) for k in kinds)])


def _join(batches):
    """Every conversation: a row for each block with its edits; the first has the totals too."""
    conv, batches = _peeked(iter(batches))
    if conv is None:
        return

    def found():
        columns = ("block", "costs", "audits", "first", "last", "illegal")
        for (c,), (blocks, costs, audits, first, last, illegal) in _runs(batches, ("conv_id",), columns):
            tables = []
            for cs, texts in zip(costs, audits):
                flat = [None if x is None else (x, a) for x, a in zip(cs, texts)]
                tables.append([flat[4 * s : 4 * s + 4] for s in range(4)])
            cost, parts = join_blocks(tables)
            totals = (sum(illegal) + _illegal(last, first[1:]), cost, "".join(parts))
            for b, part in zip(blocks, parts):
                yield c, b, part, *totals
                totals = (None, None, None)

    text, number = pa.string(), pa.int64()
    kinds = [("block", number), ("edits", text), ("illegal", number), ("cost", number), ("audit", text)]
    yield from _rows_out(found(), [conv, *(pa.field(*k) for k in kinds)])


def edits(rows: DataFrame) -> DataFrame:
    """``conv_id, block, edits, illegal, cost, audit`` for every block of ``ordered`` rows (written table).

    Blocks are dealt over the tasks by conversation and place, so a long conversation is searched by many.
    """
    kind = rows.schema["conv_id"].dataType.simpleString()
    light = rows.select("conv_id", "block", "at", "fault", F.substring("role", 1, 1).alias("initial"))
    light = light.repartition("conv_id", "block").sortWithinPartitions("conv_id", "block", "at")
    blocks = light.mapInArrow(_search, f"conv_id {kind}, {_BLOCKS}")
    blocks = blocks.repartition("conv_id").sortWithinPartitions("conv_id", "block")
    return common.saved(blocks.mapInArrow(_join, f"conv_id {kind}, {_EDITS}"), "edits")


class _Writer:
    """The repaired lines of one conversation, handed out as they come."""

    def __init__(self) -> None:
        self.state = 0

    def _write(self, role: str, text: str) -> str:
        self.state = AFTER[self.state, role[:1]]
        return f"{role}:{text}"

    def inserted(self) -> str:
        return self._write(ROLES[NEXT[self.state]], "")

    def edited(self, letter: str, role: str, text: str) -> list[str]:
        if letter == "D":
            return []
        return [self._write(role if letter == "K" else ROLES[NEXT[self.state]], text)]


def _lines(batches):
    """``conv_id, at, line`` runs -> per batch the lines of its rows; rows come sorted by conversation and place."""
    conv, block, writer, left = object(), None, None, ""
    digest, n = None, 0
    ids, hashes, counts = [], [], []

    def close():
        nonlocal n
        for _ in left:  # the inserts after the last row
            put(writer.inserted())
        ids.append(conv)
        hashes.append(digest.hexdigest())
        counts.append(n)

    def put(line: str):
        nonlocal n
        digest.update((b"\n" if n else b"") + line.encode("utf-8", "replace"))
        n += 1

    kind = None
    for batch in batches:
        kind = batch.schema.field("conv_id").type
        columns = (batch.column(c).to_pylist() for c in ("conv_id", "block", "edits", "role", "text"))
        for c, b, segment, role, text in zip(*columns):
            if writer is None or c != conv:
                if writer is not None:
                    close()
                conv, block, writer, digest, n = c, None, _Writer(), hashlib.sha256(), 0
            if b != block:
                block, left = b, segment
            while left[0] == "I":
                put(writer.inserted())
                left = left[1:]
            for line in writer.edited(left[0], role, text):
                put(line)
            left = left[1:]
        if ids:
            yield _hashed(ids, hashes, counts, kind)
            ids, hashes, counts = [], [], []
    if writer is not None:
        close()
        yield _hashed(ids, hashes, counts, kind)


def _hashed(ids, hashes, counts, kind) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, kind), pa.array(hashes, pa.string()), pa.array(counts, pa.int64())], ["conv_id", "repaired_sha256", "n_repaired"]
    )


def repaired_rows(rows: DataFrame, found: DataFrame) -> DataFrame:
    """The rows with their block's edits, sorted by conversation and place within partitions."""
    named = found.select(F.col("conv_id").alias("_c"), F.col("block").alias("_b"), "edits")
    same = F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("block") == F.col("_b"))
    joined = rows.join(named, same).select("conv_id", "at", "block", "edits", "role", "text")
    return joined.repartition("conv_id").sortWithinPartitions("conv_id", "at")


def repair(turns: DataFrame) -> DataFrame:
    """One row for every ``conv_id`` of ``turns``: faults, cost, audit and hash of the repaired conversation.

    Columns: ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256``
    and ``n_rows, n_repaired``.
    """
    common.prepare_workers(turns.sparkSession)
    kind = turns.schema["conv_id"].dataType.simpleString()
    rows = ordered(damaged(turns))
    found = edits(rows)
    hashes = repaired_rows(rows, found).mapInArrow(_lines, f"conv_id {kind}, repaired_sha256 string, n_repaired long")

    def count(fault: str) -> Column:
        return F.count(F.when(F.col("fault") == fault, 1))

    # Turns are made distinct before they are counted, so a long conversation is dealt by its turns.
    by_turn = rows.groupBy("conv_id", "turn").agg(
        F.count("*").alias("n"), count("b").alias("b"), count("d").alias("d"), count("t").alias("t")
    )
    span = F.max("turn") - F.min("turn") + 1 - F.count("turn")
    faults = by_turn.groupBy("conv_id").agg(
        F.coalesce(span, F.lit(0)).alias("gaps"),
        F.sum("b").alias("blank"),
        F.sum("d").alias("duplicate"),
        F.sum("t").alias("truncated"),
        F.sum("n").alias("n_rows"),
    )
    totals = found.where("cost is not null").select("conv_id", "illegal", "cost", "audit")
    out = turns.select(F.col("conv_id").alias("_id")).distinct()
    for part in (faults, totals, hashes):
        out = out.join(part, F.col("_id").eqNullSafe(part["conv_id"]), "left").drop("conv_id")
    numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "n_rows", "n_repaired")
    return out.select(
        F.col("_id").alias("conv_id"),
        *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in numbers),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


def op11_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair(common.load(spark, sf_dir, "conversations"))
