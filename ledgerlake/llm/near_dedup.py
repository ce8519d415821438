"""MinHash near-dedup with ProbMinHash signatures (operator 6).

Documents are sets of ``WORDS``-word shingles (lower case, cut at white space; a shorter text is
one shingle). Two documents are linked if the Jaccard similarity of their sets is
``SIMILARITY`` or more; a class is a connected component of links.

1. *Signatures* (one narrow pass). Each shingle of weight ``1 + ln(count)`` is a Poisson process
   whose points land on random registers; a register keeps the shingle of its earliest point. A
   shingle stops drawing points once its next point is later than all of its document's
   registers. Two signatures agree on a share of registers that estimates the probability
   Jaccard similarity. ``ROWS`` registers make a band. That similarity falls below the sets' where
   counts differ, so a document that repeats a shingle also has the bands of the same process with
   all weights 1, whose signatures agree by the sets' similarity alone. Without a repeated shingle the
   two are the same.
2. *Nodes*. Texts with the same words are one node, so exact copies never meet in a bucket.
3. *Stars* (``ROUNDS`` times). In every bucket of a band that holds nodes of several components, one node
   leads; every node is compared with the one leader, of another component, that it meets in
   most buckets. Each comparison is verified on the shingle sets. Large groups of near copies
   grow together with a few comparisons a node. They are followed by
4. *the exact rest*: among the nodes whose buckets still hold several components, rare shingles
   first, two sets of similarity s share a shingle among the first ``n - ceil(s n) + 1``, and from
   their first shared shingle on both still hold the overlap that s asks for. Nodes of different
   components of which that holds are compared. So no link between bucket mates is lost.

Components are found by alternating large and small stars on written tables.

Null texts count as empty; all empty texts are one class. Repeated rows each give a row. Null ids
take part; the class id is the smallest id of the class, null if it has none. An empty table gives
no rows; very long texts are cut one at a time. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm import common
from ledgerlake.operators.joins import salted_join

WORDS, SIMILARITY = 5, 0.8
BANDS, ROWS = 32, 6
REGISTERS = BANDS * ROWS
ROUNDS = 1
#: Word hashes a worker remembers at most.
REMEMBERED = 150_000
#: Shingles whose signatures are drawn together; characters of the texts cut into words at once.
BATCH_SHINGLES, BATCH_CHARS = 50_000, 1 << 19

_M1, _M2, _STEP, _FOLD = (np.uint64(x) for x in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0x9E3779B97F4A7C15, 0x100000001B3))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


class _WordHashes(dict):
    def __missing__(self, word: str) -> int:
        if len(self) > REMEMBERED:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


@common.remembered("near_dedup")
def _word_hashes() -> _WordHashes:
    return _WordHashes()


def node_of(words: list[str]) -> bytes:
    return hashlib.blake2b(" ".join(words).encode("utf-8", "surrogatepass"), digest_size=16).digest()


def shingles(words: list[str], size: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes and how often each occurs."""
    if not words:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    size = min(size, len(words))
    get = _word_hashes().__getitem__
    hashes = np.fromiter(map(get, words), np.uint64, len(words))
    n = len(words) - size + 1
    out = np.full(n, size, np.uint64)
    for k in range(size):
        out = mix(out * _FOLD + hashes[k : k + n])
    return np.unique(out, return_counts=True)


def prob_minhash(sets: list[tuple[np.ndarray, np.ndarray]], registers: int = REGISTERS) -> np.ndarray:
    """Signatures (documents x registers) of non-empty weighted sets ``(hashes, weights)``."""
    out = np.zeros((len(sets), registers), np.uint64)
    # Documents with few shingles draw more points of each at once; the points are the same.
    draws = [1 << max(0, (2 * registers // max(len(h), 1)).bit_length() - 1) for h, _ in sets]
    for draw in sorted(set(draws)):
        group = [i for i, d in enumerate(draws) if d == draw]
        for some in common.slices(group, [len(sets[i][0]) * draw for i in group], BATCH_SHINGLES):
            out[some] = _signatures([sets[i] for i in some], registers, draw)
    return out


def _signatures(sets, registers: int, draw: int) -> np.ndarray:
    doc = np.repeat(np.arange(len(sets)), [len(h) for h, _ in sets])
    shingle = np.concatenate([h for h, _ in sets])
    rate = np.concatenate([np.asarray(w, float) for _, w in sets])
    first = np.full(len(sets) * registers, np.inf)
    owner = np.zeros(len(sets) * registers, np.uint64)
    time = np.zeros(len(shingle))
    active = np.arange(len(shingle))
    drawn = 0
    while len(active):
        count = np.arange(drawn + 1, drawn + draw + 1, dtype=np.uint64) * _STEP
        seed = mix(shingle[active][:, None] + count)
        gap = -np.log(((seed >> np.uint64(11)).astype(float) + 0.5) * 2.0**-53) / rate[active][:, None]
        at = time[active][:, None] + np.cumsum(gap, axis=1)
        time[active] = at[:, -1]
        register = (mix(seed ^ _M2) % np.uint64(registers)).astype(np.int64) + doc[active][:, None] * registers
        at, register = at.ravel(), register.ravel()
        better = at < first[register]
        at, register = at[better], register[better]
        np.minimum.at(first, register, at)
        won = first[register] == at
        owner[register[won]] = np.repeat(shingle[active], draw)[better][won]
        drawn += draw
        latest = first.reshape(len(sets), registers).max(axis=1)
        active = active[time[active] < latest[doc[active]]]
    return owner.reshape(len(sets), registers)


def band_keys(signatures: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band (documents x bands); keys of different bands differ."""
    parts = signatures.reshape(len(signatures), BANDS, ROWS)
    keys = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), parts.shape[:2]) * _STEP
    for k in range(ROWS):
        keys = mix(keys * _FOLD + parts[:, :, k])
    return keys.view(np.int64)


def document_keys(sets: list[tuple[np.ndarray, np.ndarray]]) -> list[np.ndarray]:
    """The distinct band keys of every set ``(hashes, counts)``: of its weighted and its unit-weight signature."""
    keys = [np.empty(0, np.int64)] * len(sets)
    full = [i for i, s in enumerate(sets) if len(s[0])]
    for i, row in zip(full, band_keys(prob_minhash([(sets[i][0], 1 + np.log(sets[i][1])) for i in full]))):
        keys[i] = row
    repeated = [i for i in full if sets[i][1].max() > 1]
    for i, row in zip(repeated, band_keys(prob_minhash([(sets[i][0], np.ones(len(sets[i][0]))) for i in repeated]))):
        keys[i] = np.union1d(keys[i], row)
    return keys


def _words(text: str) -> list[str]:
    return text.lower().split()


@common.worker("near_dedup")
def _sign(batches):
    for batch in batches:
        texts = common.texts_of(batch)
        nodes, keys = [], []
        for some in common.slices(texts, [len(t) for t in texts], BATCH_CHARS):
            words = [_words(t) for t in some]
            nodes += map(node_of, words)
            keys += document_keys([shingles(w) for w in words])
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(nodes, pa.binary()), pa.array(keys, pa.list_(pa.int64()))], ["doc_id", "node", "bands"]
        )
    _word_hashes().clear()  # a worker keeps nothing between tasks


def signed(docs: DataFrame) -> DataFrame:
    """``doc_id, node, bands`` for every document (written table)."""
    common.prepare_workers(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", "text").mapInArrow(_sign, f"doc_id {kind}, node binary, bands array<long>")
    return common.saved(rows, "signatures")


@common.worker("near_dedup")
def _sets(batches):
    for batch in batches:
        nodes, sets = [], []
        for text, node in zip(common.texts_of(batch), batch.column("node").to_pylist()):
            words = _words(text)
            if node_of(words) == node:
                nodes.append(node)
                sets.append(shingles(words)[0].tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.binary()), pa.array(sets, pa.binary())], ["node", "hashes"])
    _word_hashes().clear()


def shingle_sets(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """``node, hashes, n`` of the given nodes (``node, rep``: a document that has the node's words)."""
    texts = docs.select("doc_id", "text").join(nodes, F.col("doc_id").eqNullSafe(F.col("rep"))).select("node", "text")
    sets = texts.mapInArrow(_sets, "node binary, hashes binary").dropDuplicates(["node"])
    return common.saved(sets.withColumn("n", F.octet_length("hashes") / 8), "shingle_sets")


def _similar(similarity: float):
    @common.worker("near_dedup")
    def run(batches):
        for batch in batches:
            left, right = (batch.column(c).to_pylist() for c in ("left", "right"))
            keep = []
            for a, b in zip(left, right):
                x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
                x, y = (x, y) if len(x) <= len(y) else (y, x)
                at = np.searchsorted(y, x)
                both = int((y[np.minimum(at, len(y) - 1)] == x).sum())
                keep.append(both >= similarity * (len(x) + len(y) - both) - 1e-9)
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def verified(pairs: DataFrame, sets: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The pairs (``a, b``) whose shingle sets are similar enough (written table)."""
    left = sets.select(F.col("node").alias("a"), F.col("hashes").alias("left"), F.col("n").alias("na"))
    right = sets.select(F.col("node").alias("b"), F.col("hashes").alias("right"), F.col("n").alias("nb"))
    rows = pairs.join(left, "a").join(right, "b")
    rows = rows.where(F.least("na", "nb") >= similarity * F.greatest("na", "nb") - 1e-9)
    return common.saved(rows.select("a", "b", "left", "right").mapInArrow(_similar(similarity), "a binary, b binary"), "links")


def components(edges: DataFrame) -> DataFrame:
    """``node, root``: the smallest node of the connected component, for every node of an edge."""

    def both_ways(e: DataFrame) -> DataFrame:
        return e.select("a", "b").union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))

    def star(neighbours: DataFrame, own: bool) -> DataFrame:
        """Link the neighbours of each node, and the node itself if ``own``, to the smallest of them all."""
        lows = neighbours.groupBy("a").agg(F.min(F.least("a", "b")).alias("low"))
        rows = neighbours.join(lows, "a")
        out = rows.select(F.col("b").alias("a"), F.col("low").alias("b"))
        if own:
            out = out.union(lows.select("a", F.col("low").alias("b")))
        return out.where("a <> b").distinct()

    def mark(e: DataFrame):
        return e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    e = common.saved(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "stars")
    seen = mark(e)
    while seen[0]:
        two = both_ways(e)
        lows = two.groupBy("a").agg(F.min(F.least("a", "b")).alias("low"))
        large = two.join(lows, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).where("a <> b")
        e = common.saved(star(large.distinct(), own=True), "stars")
        now = mark(e)
        if now == seen:
            break
        seen = now
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")).union(e.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()


def _grown(parts: DataFrame, links: DataFrame) -> DataFrame:
    """The components (``node, comp``) after adding links between nodes."""
    of = parts.select(F.col("node").alias("x"), "comp")
    ends = links.join(of.select(F.col("x").alias("a"), F.col("comp").alias("ca")), "a")
    ends = ends.join(of.select(F.col("x").alias("b"), F.col("comp").alias("cb")), "b")
    merged = components(ends.select(F.col("ca").alias("a"), F.col("cb").alias("b")))
    joined = parts.join(merged.select(F.col("node").alias("comp"), "root"), "comp", "left")
    return common.saved(joined.select("node", F.coalesce("root", "comp").alias("comp")), "parts")


def _open_buckets(mates: DataFrame, parts: DataFrame) -> DataFrame:
    """``key, node, comp`` of the buckets that hold several components."""
    rows = mates.join(parts, "node")
    several = rows.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("key")
    return rows.join(several, "key")


def _star_pairs(rows: DataFrame, turn: int) -> DataFrame:
    """For each node the bucket leader of another component that it meets most often.

    First the node with the most bucket mates leads, as the likeliest middle of a group; then
    every turn draws other leaders.
    """
    rank = F.xxhash64("node", F.lit(turn))
    if not turn:
        sizes = rows.groupBy("key").agg(F.count("*").alias("size"))
        weights = rows.join(sizes, "key").groupBy("node").agg((-F.sum("size")).alias("weight"))
        rows, rank = rows.join(weights, "node"), F.col("weight")
    leaders = rows.groupBy("key").agg(F.min(F.struct(rank.alias("h"), "node", "comp")).alias("lead"))
    met = rows.join(leaders, "key").where(F.col("comp") != F.col("lead.comp"))
    met = met.groupBy("node", F.col("lead.node").alias("b")).agg(F.count("*").alias("times"))
    best = met.groupBy(F.col("node").alias("a")).agg(F.max(F.struct("times", "b"))["b"].alias("b"))
    return best.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _rest_pairs(nodes: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Pairs of nodes (``node, comp``) of different components that share a shingle of their prefixes."""
    rows = sets.join(nodes, "node").select("node", "comp", "n", F.explode(_hash_list(F.col("hashes"))).alias("s"))
    counts = rows.groupBy("s").agg(F.count("*").alias("df")).where("df > 1")
    # Shingles of one node alone come first in any order and pair nothing: only their number counts.
    shared = rows.join(counts, "s").groupBy("node", "comp", "n")
    lists = shared.agg(F.array_sort(F.collect_list(F.struct("df", "s"))).alias("shared"))
    prefix = (F.col("n") - F.ceil(F.col("n") * similarity - 1e-9) + 1).cast("int")
    alone = F.col("n").cast("int") - F.size("shared")
    kept = F.slice(F.col("shared.s"), F.lit(1), F.greatest(F.lit(0), prefix - alone))
    keyed = lists.select("node", "comp", "n", alone.alias("alone"), F.posexplode(kept).alias("at", "s"))
    # Shingles of the set from this one on, in the common order.
    keyed = keyed.withColumn("rest", F.col("n") - F.col("alone") - F.col("at")).drop("alone", "at")
    keyed = common.saved(keyed, "prefixes")
    x = keyed.select("s", F.col("node").alias("a"), F.col("comp").alias("ca"), F.col("n").alias("na"), F.col("rest").alias("ra"))
    y = keyed.select("s", F.col("node").alias("b"), F.col("comp").alias("cb"), F.col("n").alias("nb"), F.col("rest").alias("rb"))
    # At the first shingle they share, the sets must still hold the overlap that they need.
    overlap = similarity / (1 + similarity) * (F.col("na") + F.col("nb")) - 1e-9
    enough = F.least("ra", "rb") >= overlap
    return x.join(y, "s").where((F.col("a") < F.col("b")) & (F.col("ca") != F.col("cb")) & enough).select("a", "b").distinct()


def _hash_list(hashes):
    """Array of the 8-byte pieces of a binary column."""
    count = (F.octet_length(hashes) / 8).cast("int")
    return F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.substring(hashes, i * 8 + 1, F.lit(8)))


def classes(docs: DataFrame, similarity: float = SIMILARITY, rounds: int = ROUNDS) -> DataFrame:
    """``doc_id, node, class_id, rep_node`` of every document; ``rep_node`` is the node of the class's first document."""
    rows = signed(docs)
    nodes = rows.groupBy("node").agg(F.min("doc_id").alias("rep"), F.min("bands").alias("bands"))
    met = nodes.select("node", F.explode("bands").alias("key"))
    keys = met.groupBy("key").agg(F.count("*").alias("c")).where("c > 1").select("key")
    mates = common.saved(met.join(keys, "key"), "mates")
    reps = nodes.select("node", "rep").join(mates.select("node").distinct(), "node")
    sets = shingle_sets(docs, reps)
    parts = common.saved(mates.select("node", F.col("node").alias("comp")).distinct(), "parts")
    for turn in range(rounds):
        mates = common.saved(_open_buckets(mates.select("key", "node"), parts), "open")
        links = verified(_star_pairs(mates, turn), sets, similarity)
        if links.isEmpty():
            continue
        parts = _grown(parts, links)
    rest = _open_buckets(mates.select("key", "node"), parts).select("node", "comp").distinct()
    links = verified(_rest_pairs(rest, sets, similarity), sets, similarity)
    if not links.isEmpty():
        parts = _grown(parts, links)
    # A text of very many copies and a class of very many documents are dealt over several reducers.
    named = salted_join(rows.select("doc_id", "node"), parts, "node").withColumn("comp", F.coalesce("comp", "node"))
    named = common.saved(named, "named")
    ids = named.groupBy("comp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "node")).alias("first"))
    out = salted_join(named, ids, "comp", how="inner")
    return out.select("doc_id", "node", F.col("first.doc_id").alias("class_id"), F.col("first.node").alias("rep_node"))


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``doc_id, class_id`` for every document."""
    return classes(docs, similarity).select("doc_id", "class_id")


def _unused(name: str, columns: list[str]) -> str:
    """``name``, with underscores before it until no column is called so (letter case aside)."""
    taken = {c.lower() for c in columns}
    while name in taken:
        name = "_" + name
    return name


def keep_one(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` (all columns, whatever their names), one for each class: its smallest id."""
    found = common.saved(classes(docs, similarity), "classes")
    same = F.col("doc_id").eqNullSafe(F.col("class_id")) & (F.col("node") == F.col("rep_node"))
    first, node, copies = (_unused(c, docs.columns) for c in ("first_id", "rep_node", "copies"))
    firsts = found.where(same).groupBy(F.col("class_id").alias(first), F.col("rep_node").alias(node)).agg(F.count("*").alias(copies))

    @common.worker("near_dedup")
    def own_words(batches):
        for batch in batches:
            keep = [node_of(_words(t)) == n for t, n in zip(common.texts_of(batch), batch.column(node).to_pylist())]
            yield batch.filter(pa.array(keep, pa.bool_()))

    def chosen(firsts: DataFrame) -> DataFrame:
        rows = docs.join(firsts, F.col("doc_id").eqNullSafe(F.col(first))).select(*docs.columns, node)
        return rows.mapInArrow(own_words, rows.schema)

    rows = chosen(firsts.where(F.col(copies) == 1))
    several = firsts.where(F.col(copies) > 1)
    if not several.isEmpty():  # repeated rows: only these are shuffled once more
        rows = rows.union(chosen(several).dropDuplicates(["doc_id", node]))
    return rows.drop(node)


def op6_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(common.load(spark, sf_dir, "documents"))
