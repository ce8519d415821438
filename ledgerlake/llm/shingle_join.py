"""Exact similarity join of shingle sets over a token-group matrix (operator 13).

A document's set holds its distinct 5-word shingles (words cut at ASCII white space, A-Z in lower case; a
shorter text is one shingle). Documents link when ``100 * common >= 80 * all``; the result is the
connected components of all links. Shingles are 64-bit hashes; equal sets (by 128-bit digest) are one node.

1. *Order.* One pass gives each document's digest, and counts shingles in ``BUCKETS`` counters a task; the
   fullest ``HOT`` counters of all tasks together say which shingles are frequent. Every set is ordered by (counter, hash):
   any common order is exact, this one puts passages of many documents last.
2. *Live nodes.* In that order two sets that link share a shingle among their first
   ``n - ceil(0.8 n) + 1``, and k of them among the first ``n - ceil(0.8 n) + k``; k grows with the
   size up to ``MOST_HEADS``. Only nodes that share so many with other nodes go on (one common passage is too little).
3. *Groups.* Live nodes with the same smallest hash are a group; larger ones are dealt, by a hash of
   the node, over groups of about ``GROUP`` nodes. Links inside a group are found in one task.
   Then each component of a group is compared with the most central member of the groups that share a
   sketch with it, which joins the groups of a large cluster by few comparisons. Then nodes of components of more than
   ``GROUP`` are grouped anew, by component: such a cluster of ``m`` nodes is some ``m / GROUP`` groups, however its nodes were dealt before.
4. *Matrix.* For every (shingle, group): the largest number of shingles that a member has from this one
   on, the members' sizes and components. Groups that share a first shingle and have members of different components and
   fitting sizes meet there, once for all their nodes. Where they share k of them, each node (of the
   smaller component, so pairs are asked once) is held against the list of shared ones: it asks the other group if it has k of
   them itself and both still hold the overlap that the sizes call for. So nodes of one component never meet.
5. *Opening.* Each group asked for is brought together with its queries once; a group of many queries is
   copied for every ``QUERIES`` of them. The overlap of the query with the union of the group's shingles
   bounds its overlap with any member. Only groups for which that bound suffices are opened: the
   query's columns of the members' matrix give the exact overlaps.

Texts and sets are moved only where a bitmap of the keys asked for (``possible``) does not rule them out.
No candidate, group or query is capped: 2 to 5 lose no link. A task holds one group (about ``GROUP``
members and ``GROUP_SHINGLES`` shingles, or one larger document) and one query.

Null and empty texts have no shingles and link with nothing; each is its own component. Repeated rows each
give a row. Null ids take part; a component's id is its smallest id, null if it has none. An
empty table gives no rows. Very long texts are cut whole. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm import common
from ledgerlake.llm.near_dedup import components, mix
from ledgerlake.operators.joins import salted_join

WORDS = 5
#: Sets link when ``ALL * common >= SHARE * union``.
SHARE, ALL = 80, 100
BUCKETS, TASK_HOT, HOT = 1 << 20, 4096, 1 << 16
#: See ``common_heads``.
MOST_HEADS, HEAD_STEP = 16, 16
SKETCHES = 4
GROUP, GROUP_SHINGLES, QUERIES = 32, 1 << 16, 256
#: Bits of the bitmap of ``possible``, as a power of two; bits of one of its rows (Spark's bitmap functions' fixed value).
BITMAP, BITMAP_ROW = 25, 15
#: Bytes of texts hashed at once; a longer text is hashed so many bytes at a time.
CHUNK = 1 << 20

_STEP = np.uint64(0x9E3779B97F4A7C15)
_SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
#: A number for every byte; capitals have their small letter's, white space has 0.
_BYTE = mix((np.arange(256, dtype=np.uint64) + np.uint64(1)) * _STEP)
_BYTE[65:91] = _BYTE[97:123]
_BYTE[_SPACE] = 0
#: Odd multipliers of a word by its place in a shingle.
_PLACE = mix(np.arange(11, 11 + WORDS, dtype=np.uint64)) | np.uint64(1)


@common.remembered("shingle_join")
def _powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number modulo 2^64, and of its inverse."""
    out = []
    for base in (int(_STEP), pow(int(_STEP), -1, 1 << 64)):
        steps = np.full(CHUNK, base, np.uint64)
        steps[0] = 1
        out.append(np.cumprod(steps, dtype=np.uint64))
    return out[0], out[1]


def word_hashes(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first byte of every word of UTF-8 bytes.

    A word's bytes are the coefficients of a polynomial modulo 2^64. Running sums give it for
    every word of a chunk at once; a word that a chunk's end cuts is put together from its parts.
    """
    power, inverse = _powers()
    hashes, places = [], []
    cut: tuple[int, int, int] | None = None  # hash, length and start of a word that goes on
    for at in range(0, len(raw), CHUNK):
        part = raw[at : at + CHUNK]
        inside = ~_SPACE[part]
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(_BYTE[part] * power[: len(part)], out=sums[1:])
        edges = np.flatnonzero(np.diff(inside.view(np.int8), prepend=np.int8(0), append=np.int8(0)))
        starts, ends = edges[::2], edges[1::2]
        h = (sums[ends] - sums[starts]) * inverse[starts]
        size = (ends - starts).astype(np.uint64)
        starts = starts + at
        if cut is not None:
            if inside[0]:
                more = pow(int(_STEP), cut[1], 1 << 64) * int(h[0]) + cut[0]
                h[0], size[0], starts[0] = more % (1 << 64), cut[1] + int(size[0]), cut[2]
            else:
                h, size, starts = (np.insert(x, 0, c) for x, c in zip((h, size, starts), cut))
            cut = None
        if inside[-1] and at + CHUNK < len(raw):
            cut = (int(h[-1]), int(size[-1]), int(starts[-1]))
            h, size, starts = h[:-1], size[:-1], starts[:-1]
        hashes.append(mix(h + size * _STEP))
        places.append(starts)
    if not hashes:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    return np.concatenate(hashes), np.concatenate(places)


def _together(texts: list[bytes]) -> list[np.ndarray]:
    """The shingle sets of some texts, hashed as one run of bytes."""
    raw = np.frombuffer(b"\n".join(texts), np.uint8)
    hashes, places = word_hashes(raw)
    firsts = np.cumsum([0, *(len(t) + 1 for t in texts)])
    of = np.searchsorted(firsts, places, "right") - 1
    n_words = np.bincount(of, minlength=len(texts))[: len(texts)]
    out, owner = np.empty(0, np.uint64), np.empty(0, np.int64)
    if len(hashes) >= WORDS:
        n = len(hashes) - WORDS + 1
        total = np.full(n, WORDS, np.uint64)
        for k, factor in enumerate(_PLACE):
            total += hashes[k : k + n] * factor
        whole = of[:n] == of[WORDS - 1 :]
        out, owner = mix(total[whole]), of[:n][whole]
    ends = np.cumsum(np.bincount(owner, minlength=len(texts)))
    starts = ends - np.bincount(owner, minlength=len(texts))
    sets = []
    word_ends = np.cumsum(n_words)
    for i, (a, b) in enumerate(zip(starts.tolist(), ends.tolist())):
        if b > a:
            some = np.sort(out[a:b])
            new = np.empty(len(some), bool)
            new[0] = True
            np.not_equal(some[1:], some[:-1], out=new[1:])
            sets.append(some if new.all() else some[new])
        elif n_words[i]:  # fewer words than a shingle: all of them are one
            own = hashes[word_ends[i] - n_words[i] : word_ends[i]]
            sets.append(mix((own * _PLACE[: len(own)]).sum(dtype=np.uint64, keepdims=True) + np.uint64(len(own))))
        else:
            sets.append(np.empty(0, np.uint64))
    return sets


def shingle_sets(texts: list[bytes | None]) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every text."""
    raw = [t or b"" for t in texts]
    return [s for some in common.slices(raw, [len(t) + 1 for t in raw], CHUNK) for s in _together(some)]


def digest(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def least_overlap(n):
    """The overlap that any link of a set of ``n`` has at least, and so the least size of what it links with."""
    return -(-SHARE * n // ALL)


def common_heads(n):
    """How many first shingles two linked sets share at least, if the smaller one has ``n``: 1 for small sets, then more."""
    return min(MOST_HEADS, 1 + n // HEAD_STEP)


def head_size(n: int) -> int:
    """First shingles of a set of ``n`` that are looked at.

    Two sets that share ``o`` shingles share ``k`` of them among the first ``n - o + k`` of either, for every ``k`` up to ``o``.
    """
    return n - least_overlap(n) + common_heads(n)


# --- 1. order -----------------------------------------------------------------------------------
def _bucket(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int64)


@common.worker("shingle_join")
def _measure(batches):
    counters = np.zeros(BUCKETS, np.int64)
    schema = None
    for batch in batches:
        sets = shingle_sets(batch.column("text").to_pylist())
        for some in common.slices(sets, [len(s) for s in sets], 1 << 18):
            counters += np.bincount(_bucket(np.concatenate(some)), minlength=BUCKETS)
        out = pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array([digest(s) if len(s) else None for s in sets], pa.binary()),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.nulls(len(sets), pa.list_(pa.int32())),
                pa.nulls(len(sets), pa.list_(pa.int32())),
            ],
            ["doc_id", "node", "n", "buckets", "counts"],
        )
        schema = out.schema
        yield out
    if schema is not None:  # the fullest counters of the task, as one more row without a size
        top = np.argpartition(counters, -TASK_HOT)[-TASK_HOT:]
        top = top[counters[top] > 1].astype(np.int32)
        row = [pa.nulls(1, schema.field(0).type), pa.nulls(1, pa.binary()), pa.nulls(1, pa.int64())]
        row += [pa.array([top], pa.list_(pa.int32())), pa.array([counters[top].clip(max=2**31 - 1)], pa.list_(pa.int32()))]
        yield pa.RecordBatch.from_arrays(row, schema=schema)


def measured(docs: DataFrame) -> tuple[DataFrame, tuple[np.ndarray, np.ndarray]]:
    """``doc_id, node, n`` of every document (written table), and the fullest counters of all tasks (at most ``HOT``)."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    rows = rows.mapInArrow(_measure, f"doc_id {kind}, node binary, n long, buckets array<int>, counts array<int>")
    rows = common.saved(rows, "measured")
    hot = rows.where("n is null").select(F.explode(F.arrays_zip("buckets", "counts")).alias("x")).select("x.*")
    hot = hot.groupBy("buckets").agg(F.sum("counts").alias("c")).orderBy(F.desc("c"), "buckets").limit(HOT).collect()
    hot = sorted((r["buckets"], r["c"]) for r in hot)
    return rows.where("n is not null").drop("buckets", "counts"), tuple(np.array(x, np.int64) for x in zip(*hot)) if hot else (np.empty(0, np.int64),) * 2


def rare_first(shingles: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The set by (counter, hash); ``counts`` is 0 for the counters that are not among the fullest."""
    full = counts[_bucket(shingles)]
    frequent = np.flatnonzero(full)
    if not len(frequent):
        return shingles
    last = frequent[np.argsort(full[frequent], kind="stable")]
    return np.concatenate([shingles[full == 0], shingles[last]])


def sketch(shingles: np.ndarray) -> list[int]:
    """The smallest hash, and the smallest after multiplication by odd numbers."""
    out = [shingles[0], *((shingles * factor).min() for factor in _PLACE[: SKETCHES - 1])]
    return np.array(out).view(np.int64).tolist()


# --- 2. nodes -------------------------------------------------------------------------------------
_SKETCH_COLUMNS = [f"m{k}" for k in range(SKETCHES)]


def _prefixes(hot):
    @common.worker("shingle_join")
    def run(batches):
        counts = np.zeros(BUCKETS, np.int64)
        counts[hot[0]] = hot[1]
        for batch in batches:
            sets = shingle_sets(batch.column("text").to_pylist())
            full = [i for i, s in enumerate(sets) if len(s)]
            sketches = np.array([sketch(sets[i]) for i in full], np.int64).reshape(-1, SKETCHES)
            heads = [rare_first(sets[i], counts)[: head_size(len(sets[i]))].view(np.int64) for i in full]
            kept = batch.take(pa.array(full, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [
                    kept.column("row"),
                    kept.column("doc_id"),
                    pa.array([digest(sets[i]) for i in full], pa.binary()),
                    pa.array([len(sets[i]) for i in full], pa.int32()),
                    *(pa.array(column) for column in sketches.T),
                    pa.array(heads, pa.list_(pa.int64())),
                ],
                ["row", "doc_id", "node", "n", *_SKETCH_COLUMNS, "head"],
            )

    return run


def _rows(docs: DataFrame) -> DataFrame:
    """``row, doc_id, text``: texts as bytes; ``row`` is the same for rows with the same id and text."""
    return docs.select(F.xxhash64("doc_id", "text").alias("row"), "doc_id", F.col("text").cast("binary").alias("text"))


def nodes_of(docs: DataFrame, hot) -> DataFrame:
    """One row for each distinct set: ``nid, node, n``, sketches, ``head``, its first id ``own`` and one of its rows (written table)."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    columns = ", ".join(f"{c} long" for c in _SKETCH_COLUMNS)
    rows = _rows(docs).mapInArrow(_prefixes(hot), f"row long, doc_id {kind}, node binary, n int, {columns}, head array<long>")
    same = [F.first(c).alias(c) for c in ("n", *_SKETCH_COLUMNS, "head")]
    nodes = rows.groupBy("node").agg(F.min("doc_id").alias("own"), F.min("row").alias("row"), *same)
    return common.saved(nodes.withColumn("nid", F.monotonically_increasing_id()), "nodes", settle=True)


def _shares(n: Column) -> Column:
    """``common_heads`` of the smallest set that one of ``n`` can link with."""
    least = F.ceil(F.lit(SHARE) * n / F.lit(ALL))
    return F.least(F.lit(MOST_HEADS), F.lit(1) + F.floor(least / HEAD_STEP))


def shared_heads(nodes: DataFrame) -> DataFrame:
    """``token, nid, n, rest``: first shingles that several nodes have, with the number of shingles from there on (written table).

    Nodes that share fewer of them than a link needs are left out, and then what they alone shared.
    """
    rows = nodes.select("nid", "n", F.posexplode("head").alias("at", "token"))
    # One exchange serves both the counts and the join: all columns pass through it, on both sides.
    rows = rows.select("token", "nid", "n", (F.col("n") - F.col("at")).alias("rest")).repartition("token")
    several = rows.groupBy("token").agg(F.min("nid").alias("lo"), F.max("nid").alias("hi"), F.max("n").alias("n_hi"), F.max("rest").alias("rest_hi"))
    several = several.where("lo < hi and rest_hi <= n_hi").select("token")
    rows = common.saved(rows.join(several, "token"), "heads", settle=True)
    enough_shared = rows.groupBy("nid").agg(F.count("*").alias("c"), F.max("n").alias("n")).where(F.col("c") >= _shares(F.col("n")))
    rows = rows.join(enough_shared.select("nid"), "nid", "left_semi")
    return common.saved(rows.select("token", "nid", "n", "rest"), "live_heads")


@common.worker("shingle_join")
def _sets(batches):
    for batch in batches:
        sets = shingle_sets(batch.column("text").to_pylist())
        ours = [i for i, (s, n) in enumerate(zip(sets, batch.column("node").to_pylist())) if digest(s) == n]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c).take(pa.array(ours, pa.int64())) for c in ("nid", "gid")), pa.array([sets[i].tobytes() for i in ours], pa.binary())],
            ["nid", "gid", "hashes"],
        )


def possible(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """The rows whose ``key`` may be among those of ``keys``, before they are shuffled for a join; none that is there is lost.

    A bitmap of hashed keys (4 MB at most) goes to all tasks. The more keys, the more other rows pass.
    """
    place = F.pmod(F.xxhash64(key), F.lit(1 << BITMAP))
    block, bit = F.shiftright(place, BITMAP_ROW), place.bitwiseAND(F.lit((1 << BITMAP_ROW) - 1))
    bits = keys.select(block.alias("_block"), bit.alias("_bit")).groupBy("_block").agg(F.bitmap_construct_agg("_bit").alias("_bits"))
    byte = F.conv(F.hex(F.substring("_bits", (F.shiftright(bit, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    found = rows.withColumn("_block", block).join(F.broadcast(bits), "_block")
    return found.where(F.getbit(byte, bit.bitwiseAND(F.lit(7)).cast("int")) == 1).drop("_block", "_bits")


def live_sets(docs: DataFrame, groups: DataFrame) -> DataFrame:
    """``nid, gid, hashes`` (sorted, 8 bytes each) of the live nodes, with their first groups (written table)."""
    rows = possible(_rows(docs).select("row", "text"), groups, "row").join(groups.select("row", "nid", "gid", "node"), "row")
    # Repeated rows meet here; the join has already dealt them by this key.
    rows = rows.dropDuplicates(["row", "nid"])
    return common.saved(rows.select("nid", "gid", "node", "text").mapInArrow(_sets, "nid long, gid long, hashes binary"), "sets", settle=True)


# --- 3. groups ------------------------------------------------------------------------------------
def grouped(live: DataFrame) -> DataFrame:
    """``nid, n, row, node, gid`` and sketches: groups of nodes with the same first sketch (written table)."""
    size = live.groupBy("m0").agg(F.count("*").alias("c"), F.sum("n").alias("s"))
    parts = F.greatest(F.ceil(F.col("c") / GROUP), F.ceil(F.col("s") / GROUP_SHINGLES)).cast("long")
    size = size.select("m0", F.least(F.col("c"), parts).alias("parts"))
    gid = F.xxhash64("m0", F.pmod(F.xxhash64("nid"), F.col("parts")))
    return common.saved(live.join(size, "m0").select("nid", "n", "row", "node", *_SKETCH_COLUMNS, gid.alias("gid")), "groups")


class Members:
    """A group's sets: the sorted union of their shingles and which member has which."""

    def __init__(self, sets: list[np.ndarray]) -> None:
        self.sizes = np.array([len(s) for s in sets], np.int64)
        self.union, at = np.unique(np.concatenate(sets), return_inverse=True)
        self.has = np.zeros((len(sets), len(self.union)), bool)
        self.has[np.repeat(np.arange(len(sets)), self.sizes), at] = True

    def columns(self, query: np.ndarray) -> np.ndarray:
        """The places of the query's shingles in the union; as many as its overlap with any member at most."""
        at = np.minimum(np.searchsorted(self.union, query), len(self.union) - 1)
        return at[self.union[at] == query]

    def linked(self, query: np.ndarray) -> np.ndarray:
        """The members that link with the query; the group is opened only if the union's overlap allows a link."""
        columns = self.columns(query)
        if not enough(len(columns), len(query), int(self.sizes.min())):
            return np.empty(0, np.int64)
        both = self.has[:, columns].sum(axis=1)
        return np.flatnonzero(enough(both, len(query), self.sizes))


def enough(both, n, m):
    return ALL * both >= SHARE * (n + m - both)


def _inside(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """Links of one group: each node's component (its most linked member) and that member's share of links."""
    table = table.sort_by("nid")
    ids = table.column("nid").to_pylist()
    sets = [np.frombuffer(h, np.uint64) for h in table.column("hashes").to_pylist()]
    members = Members(sets)
    links = np.zeros((len(sets), len(sets)), bool)
    for i, s in enumerate(sets):
        links[i, members.linked(s)] = True
    low = np.arange(len(sets))
    while True:  # the smallest index reached through links
        new = np.where(links, low[None, :], len(sets)).min(axis=1)
        new = np.minimum(low, new)
        if (new == low).all():
            break
        low = new
    degree = links.sum(axis=1)
    leader = {c: max(np.flatnonzero(low == c), key=lambda i: (degree[i], -i)) for c in np.unique(low)}
    lead = [leader[c] for c in low]
    return pa.table(
        {"nid": ids, "comp": pa.array([ids[i] for i in lead], pa.int64()), "degree": pa.array([int(degree[i]) for i in lead], pa.int64())}
    )


@common.worker("shingle_join")
def _compare(batches):
    for batch in batches:
        keep = []
        for a, b in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist()):
            x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
            x, y = (x, y) if len(x) <= len(y) else (y, x)
            at = np.minimum(np.searchsorted(y, x), len(y) - 1)
            keep.append(bool(enough(int((y[at] == x).sum()), len(x), len(y))))
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def merged(parts: DataFrame, links: DataFrame) -> DataFrame:
    """``parts`` (``nid, comp``) after joining the components of linked ones (``a, b``; written table)."""
    roots = components(links).select(F.col("node").alias("comp"), "root")
    joined = salted_join(parts, roots, "comp")
    return common.saved(joined.select("nid", F.coalesce("root", "comp").alias("comp")), "components")


def first_components(groups: DataFrame, sets: DataFrame) -> DataFrame:
    """``nid, comp`` after links inside groups and links of components with central members (written table)."""
    several = groups.groupBy("gid").agg(F.count("*").alias("c")).where("c > 1").select("gid")
    rows = possible(sets, several, "gid").join(several, "gid")  # dealt by group once, as the sets have it
    found = rows.groupBy("gid").applyInArrow(_inside, "nid long, comp long, degree long")
    found = groups.join(found, "nid", "left").select(
        "nid", F.coalesce("comp", "nid").alias("comp"), F.coalesce("degree", F.lit(1)).alias("degree"), *_SKETCH_COLUMNS
    )
    found = common.saved(found, "inside")
    # Components stand for themselves by their most linked member.
    reps = found.where("nid = comp")
    keyed = reps.select("nid", "degree", F.posexplode(F.array(*_SKETCH_COLUMNS)).alias("k", "m"))
    order = F.struct("degree", -F.col("nid"))
    leaders = keyed.groupBy("k", "m").agg(F.max(order).alias("top"), F.count("*").alias("c")).where("c > 1")
    pairs = keyed.join(leaders.select("k", "m", (-F.col("top.col2")).alias("lead")), ["k", "m"]).where("nid <> lead")
    pairs = pairs.select(F.least("nid", "lead").alias("a"), F.greatest("nid", "lead").alias("b")).distinct()
    pairs = common.saved(pairs, "star_pairs")
    asked_for = possible(sets, pairs.select(F.explode(F.array("a", "b")).alias("nid")), "nid")
    x = asked_for.select(F.col("nid").alias("a"), F.col("hashes").alias("x"))
    y = asked_for.select(F.col("nid").alias("b"), F.col("hashes").alias("y"))
    links = pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y").mapInArrow(_compare, "a long, b long")
    return merged(found.select("nid", "comp"), links)


def regrouped(groups: DataFrame, parts: DataFrame) -> DataFrame:
    """``nid, comp, gid, size``: as before, but nodes of a component of more than ``GROUP`` nodes by that; the component's size (written table)."""
    rows = parts.join(groups.select("nid", "n", "gid"), "nid")
    size = rows.groupBy("comp").agg(F.count("*").alias("size"), F.sum("n").alias("s"))
    count = F.greatest(F.ceil(F.col("size") / GROUP), F.ceil(F.col("s") / GROUP_SHINGLES)).cast("long")
    size = size.select("comp", "size", F.least(F.col("size"), count).alias("parts"))
    gid = F.when(F.col("size") > GROUP, F.xxhash64("comp", F.pmod(F.xxhash64("nid"), F.col("parts")))).otherwise(F.col("gid"))
    return common.saved(salted_join(rows, size, "comp", how="inner").select("nid", "comp", gid.alias("gid"), "size"), "regrouped")


# --- 4. matrix ----------------------------------------------------------------------------------
_SIDE = ["gid", "low", "top", "g_lo", "g_hi", "g_rest"]


def group_pairs(heads: DataFrame, groups: DataFrame) -> DataFrame:
    """``gid, other``: groups whose members may link with members of another one that have a higher rank, with the first
    shingles that they share (``tokens``, the other's ``rests``), and of the other the sizes and the highest rank (written table).

    The join is of groups, not of nodes: where many nodes share a shingle, each group of them is one row.
    """
    # Components are ranked by size, then by number: the many nodes of a large one ask nobody at a shingle
    # that they share with smaller ones only.
    rows = heads.join(groups.select("nid", "gid", _rank()), "nid").select("token", "gid", "n", "rest", "rank").repartition("token")
    of = {"low": F.min("rank"), "top": F.max("rank"), "g_lo": F.min("n"), "g_hi": F.max("n"), "g_rest": F.max("rest")}
    # One exchange serves this aggregate and both sides of the join: they use the same columns.
    matrix = rows.groupBy("token", "gid").agg(*(c.alias(k) for k, c in of.items()))
    x, y = (matrix.select("token", *(F.col(c).alias(f"{side}_{c}") for c in _SIDE)) for side in "xy")
    up, down = F.col("x_low") < F.col("y_top"), F.col("y_low") < F.col("x_top")
    sizes = (ALL * _long("y_g_hi") >= SHARE * _long("x_g_lo")) & (ALL * _long("x_g_hi") >= SHARE * _long("y_g_lo"))
    met = x.join(y, "token").where((F.col("x_gid") < F.col("y_gid")) & sizes & (up | down))
    shared = F.collect_list(F.struct("token", "x_g_rest", "y_g_rest", up.alias("up"), down.alias("down")))
    ends = [f(f"{side}_{c}").alias(f"{side}_{c}") for side in "xy" for f, c in ((F.max, "top"), (F.min, "g_lo"), (F.max, "g_hi"))]
    both = met.groupBy("x_gid", "y_gid").agg(shared.alias("shared"), *ends)

    def asks(a: str, b: str, way: str) -> Column:
        at = F.filter("shared", lambda t: t[way])
        named = {"gid": F.col(f"{a}_gid"), "other": F.col(f"{b}_gid"), "top": F.col(f"{b}_top"), "lo": F.col(f"{b}_g_lo"), "hi": F.col(f"{b}_g_hi")}
        named |= {"own_lo": F.col(f"{a}_g_lo"), "tokens": at["token"], "rests": at[f"{b}_g_rest"]}
        return F.struct(*(c.alias(k) for k, c in named.items()))

    pairs = both.select(F.explode(F.array(asks("x", "y", "up"), asks("y", "x", "down"))).alias("ask")).select("ask.*")
    least = F.greatest(_shares(F.col("lo")), _shares(F.col("own_lo")))  # what members that link share at least
    return common.saved(pairs.where(F.size("tokens") >= least), "group_pairs")


def _long(name: str) -> Column:
    return F.col(name).cast("long")


def _rank() -> Column:
    return F.struct("size", "comp").alias("rank")


def _lists(column: pa.ListArray) -> list[np.ndarray]:
    ends = column.offsets.to_numpy()
    return np.split(column.values.to_numpy()[ends[0] : ends[-1]], ends[1:-1] - ends[0])


@common.worker("shingle_join")
def _askers(batches):
    """Keeps the rows whose node shares enough first shingles with the other group, and still holds the overlap it needs there."""
    for batch in batches:
        lists = (_lists(batch.column(c)) for c in ("head", "tokens", "rests"))
        keep = []
        for n, lo, head, tokens, rests in zip(batch.column("n").to_pylist(), batch.column("lo").to_pylist(), *lists):
            _, at, there = np.intersect1d(head, tokens, assume_unique=True, return_indices=True)
            # At the first shingle that the node shares with a member, both still hold the overlap they need,
            # and a member that links shares as many first shingles as the smaller of the two has to.
            room = np.minimum(n - at, rests[there]).max(initial=0)
            keep.append(len(at) >= common_heads(least_overlap(n)) and bool((ALL + SHARE) * int(room) >= SHARE * (n + lo)))
        yield batch.select(["nid", "gid"]).filter(pa.array(keep, pa.bool_()))


def asked(heads: DataFrame, groups: DataFrame, nodes: DataFrame) -> DataFrame:
    """``nid, gid``: the groups that each node has to ask (written table)."""
    pairs = group_pairs(heads, groups)
    own = possible(groups.select("nid", "gid", _rank()), pairs, "gid")
    own = possible(nodes.select("nid", "n", "head"), own, "nid").join(own, "nid")
    met = own.join(pairs, "gid").where(F.col("rank") < F.col("top"))
    met = met.where((ALL * _long("hi") >= SHARE * _long("n")) & (ALL * _long("n") >= SHARE * _long("lo")))
    met = met.select("nid", F.col("other").alias("gid"), "n", "lo", "head", "tokens", "rests")
    return common.saved(met.mapInArrow(_askers, "nid long, gid long"), "asked")


# --- 5. opening ---------------------------------------------------------------------------------
@common.worker("shingle_join")
def _open(batches):
    """Rows come sorted by group: its members, then its queries. Yields links of different components."""
    here, members, ids, comps, sets = None, None, [], [], []
    for batch in batches:
        a, b = [], []
        columns = (batch.column(c).to_pylist() for c in ("gid", "copy", "query", "nid", "comp", "hashes"))
        for gid, copy, query, nid, comp, hashes in zip(*columns):
            if (gid, copy) != here:
                here, members, ids, comps, sets = (gid, copy), None, [], [], []
            s = np.frombuffer(hashes, np.uint64)
            if not query:
                ids.append(nid)
                comps.append(comp)
                sets.append(s)
                continue
            if members is None:
                members = Members(sets)
            met = {comps[i]: ids[i] for i in members.linked(s).tolist() if comps[i] != comp}
            a += [comp] * len(met)
            b += met
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def opened(wanted: DataFrame, groups: DataFrame, sets: DataFrame) -> DataFrame:
    """``a, b``: components that the asked groups link."""
    copies = wanted.groupBy("gid").agg(F.ceil(F.count("*") / QUERIES).cast("int").alias("copies"))
    of = groups.select("nid", "comp")
    members = groups.select("nid", "gid", "comp").join(copies, "gid")
    members = members.select("gid", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy"), F.lit(False).alias("query"), "nid", "comp")
    copy = F.pmod(F.xxhash64("nid"), F.col("copies")).cast("int")
    queries = wanted.join(copies, "gid").join(of, "nid").select("gid", copy.alias("copy"), F.lit(True).alias("query"), "nid", "comp")
    # Sets meet members and queries once, after these are known.
    both = common.saved(members.union(queries), "meetings")
    rows = both.join(possible(sets.drop("gid"), both, "nid"), "nid").select("gid", "copy", "query", "nid", "comp", "hashes")
    rows = rows.repartition("gid", "copy").sortWithinPartitions("gid", "copy", "query")
    return rows.mapInArrow(_open, "a long, b long").distinct()


def join(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every document."""
    common.prepare_workers(docs.sparkSession)
    rows, hot = measured(docs)
    nodes = nodes_of(docs, hot)
    heads = shared_heads(nodes)
    live = common.saved(nodes.drop("head").join(heads.select("nid").distinct(), "nid"), "live")
    groups = grouped(live)
    sets = live_sets(docs, groups)
    parts = first_components(groups, sets)
    groups = regrouped(groups, parts)
    parts = merged(parts, opened(asked(heads, groups, nodes), groups, sets))
    named = nodes.select("nid", "node", "own").join(parts, "nid", "left")
    named = common.saved(named.select("node", "own", F.coalesce("comp", "nid").alias("comp")), "named")
    firsts = named.groupBy("comp").agg(F.min("own").alias("component_id"))
    ids = salted_join(named.select("node", "comp"), firsts, "comp").select("node", "component_id")
    out = salted_join(rows, ids, "node")
    own = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"))


def op13_shingle_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join(common.load(spark, sf_dir, "documents"))


#: The same by plain SQL: all pairs of distinct sets that share a shingle.
ORACLE = f"""
WITH RECURSIVE doc AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), shingled AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {WORDS} THEN [array_to_string(w, ' ')]
        ELSE list_distinct([array_to_string(w[i:i + {WORDS - 1}], ' ') for i in range(1, len(w) - {WORDS - 2})]) END AS s
    FROM doc
), keyed AS (
    SELECT doc_id, len(s)::BIGINT AS n, md5(array_to_string(list_sort(s), chr(10))) AS k, s FROM shingled
), node AS (
    SELECT k, any_value(n) AS n, any_value(s) AS s FROM keyed WHERE n > 0 GROUP BY k
), token AS (
    SELECT k, n, unnest(s) AS t FROM node
), link AS (
    SELECT a.k AS a, b.k AS b FROM token a JOIN token b ON a.t = b.t AND a.k <> b.k
    GROUP BY a.k, b.k, a.n, b.n HAVING {ALL} * count(*) >= {SHARE} * (a.n + b.n - count(*))
), reach AS (
    SELECT k AS a, k AS b FROM node UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a
), named AS (
    SELECT r.a AS k, min(d.doc_id) AS component_id FROM reach r JOIN keyed d ON d.k = r.b GROUP BY r.a
)
SELECT d.doc_id, d.n AS n_shingles, CASE WHEN d.n = 0 THEN d.doc_id ELSE c.component_id END AS component_id
FROM keyed d LEFT JOIN named c ON c.k = d.k
"""
