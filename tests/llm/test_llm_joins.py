"""Turn repair, source divergence and the shingle join against brute force."""

import hashlib
import heapq
import itertools
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from ledgerlake.llm import shingle_join, source_divergence, turn_repair
from ledgerlake.testing import compare

CLASHING = ["block", "at", "fault", "edits", "times", "said", "nid", "comp", "token", "gid", "col", "total", "item", "value", "hash", "node", "_id"]


def with_extra(df):
    """The rows with columns named like the operators' own ones."""
    return df.withColumns({c: F.lit("x") for c in CLASHING if c not in df.columns})


# --- turn repair --------------------------------------------------------------------------------
def cheapest(rows):
    """Cost, audit and output of the best edits, from all edit sequences in order of (cost, audit): Dijkstra on whole paths.

    ``rows`` are (role, text, fault); up to two inserts may stand anywhere.
    """
    queue = [(0, "", 0, "", 0, ())]
    seen = set()
    while True:
        cost, audit, i, last, inserts, out = heapq.heappop(queue)
        if i == len(rows) and last in ("", "a"):
            return cost, audit, out
        key = (i, last, inserts)
        if key in seen:
            continue
        seen.add(key)
        allowed = {"": "su", "s": "u", "u": "a", "a": "u"}[last]

        def push(c, letter, step, role=None, text="", n=0):
            if role is not None and role[:1] not in allowed:
                return
            if role is not None and not role:
                return
            state = last if role is None else role[:1]
            heapq.heappush(queue, (cost + c, audit + letter, i + step, state, n, out if role is None else (*out, (role, text))))

        if inserts < 2:
            for role in ("user", "assistant"):
                push(5, "I", 0, role, "", inserts + 1)
        if i < len(rows):
            role, text, fault = rows[i]
            push(2, "D", 1)
            if fault not in ("b", "d"):
                more = 5 if fault == "t" else 0
                push(more, "K", 1, role, text)
                for given in ("user", "assistant"):
                    push(more + 1, "R", 1, given, text)


BLANKS = " \t\n\v\f\r"


def expected(turns):
    """The contract's columns by plain Python for rows (conv_id, turn, role, text)."""
    out = {}
    space = lambda x: " " if x is None else str(x)
    for conv in {t[0] for t in turns}:
        rows = []
        for c, turn, role, text in turns:
            if c != conv:
                continue
            role, text = space(role), space(text)
            kind = zlib.crc32(f"{space(c)}:{space(turn)}".encode()) % 20
            if kind == 0:
                continue
            text = "" if kind == 1 else text.translate({ord(x): None for x in ".!?"}) if kind == 2 else text
            rows += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        faults, seen = [], set()
        for _, role, text in rows:
            last = text.rstrip(BLANKS)[-1:]
            faults.append("b" if not last else "d" if (role, text) in seen else "." if last in ".!?" else "t")
            seen.add((role, text))
        known = [r[0] for r in rows if r[0] is not None]
        cost, audit, repaired = cheapest([(r[1], r[2], f) for r, f in zip(rows, faults)])
        out[conv] = {
            "gaps": max(known) - min(known) + 1 - len(set(known)) if known else 0,
            "blank": faults.count("b"),
            "duplicate": faults.count("d"),
            "truncated": faults.count("t"),
            "illegal": sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:])),
            "cost": cost,
            "audit": audit,
            "repaired_sha256": hashlib.sha256("\n".join(f"{r}:{t}" for r, t in repaired).encode()).hexdigest(),
        }
    return out


def check_repair(spark, turns):
    df = with_extra(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string"))
    got = {r["conv_id"]: r.asDict() for r in turn_repair.repair(df).collect()}
    want = expected(turns)
    assert set(got) == set(want)
    for conv, row in want.items():
        assert {k: got[conv][k] for k in row} == row, (conv, [t for t in turns if t[0] == conv])


def test_repair_equals_brute_force(spark):
    draw = random.Random(11)
    roles = ["user", "assistant", "system", "tool", "", None, "usher", "Assistant"]
    texts = ["Yes.", "No!", "", None, " \t", "cut off", "Why? ", "a\nb.", "é…", "end. "]
    turns = []
    for conv in range(120):
        for turn in range(draw.randrange(0, 10)):
            some = draw.choice([turn, turn, turn, None, turn + 2, turn // 2])
            turns.append((conv if conv % 40 else None, some, draw.choice(roles[: draw.choice([3, 8])]), draw.choice(texts)))
    check_repair(spark, turns + turns[:5])


def test_repair_of_no_rows(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert turn_repair.repair(df).collect() == []
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    row = turn_repair.repair(spark.createDataFrame([(gone, 0, "user", "Hi.")], df.schema)).first()
    assert (row["cost"], row["audit"], row["n_rows"]) == (0, "", 0) and row["repaired_sha256"] == hashlib.sha256(b"").hexdigest()


@pytest.mark.parametrize("size", [1, 2, 3, 7])
def test_blocks_join_to_the_whole(size):
    draw = random.Random(size)
    for _ in range(300):
        rows = tuple(draw.choice("sua?") + draw.choice("..tx") for _ in range(draw.randrange(1, 14)))
        blocks = [turn_repair.block_paths(rows[i : i + size]) for i in range(0, len(rows), size)]
        cost, audits = turn_repair.join_blocks(blocks)
        named = [({"s": "system", "u": "user", "a": "assistant", "?": "tool"}[r[0]], "", {"x": "d"}.get(r[1], r[1])) for r in rows]
        assert (cost, "".join(audits)) == cheapest(named)[:2], rows


def test_long_conversation_of_many_blocks(spark):
    n = 3000
    turns = [(7, t, ("user", "assistant")[t % 2], f"Line {t}.") for t in range(n)] + [(7, None, "user", "Same.")] * 500
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    row = turn_repair.repair(df).first()
    kept = len(row["audit"].replace("D", ""))
    assert row["duplicate"] >= 499 and row["n_repaired"] == kept and kept % 2 == 0
    small = [t for t in turns if t[1] is not None and t[1] < 9]
    check_repair(spark, small)


def test_weights_order_by_cost_then_audit():
    width = turn_repair._width(4)
    ways = [(c, "".join(a)) for c in (0, 1, 9) for k in range(4) for a in itertools.product("DIKR", repeat=k)]
    weights = {w: turn_repair.weight_of(*w, width) for w in ways}
    assert sorted(ways) == sorted(ways, key=weights.get)
    assert all(turn_repair.audit_of(w, width) == a and w >> width == c for (c, a), w in weights.items())


# --- source divergence --------------------------------------------------------------------------
def test_divergence_equals_sql(spark):
    res = compare(spark, "op12", source_divergence.op12_source_divergence, source_divergence.ORACLE, SF_SMALL)
    assert res["values_match"] and res["columns_match"] and not res["type_mismatches"], res


@pytest.mark.parametrize("rows, columns", [(1, 5), (2, 64), (64, 4096)])
def test_divergence_of_odd_rows_and_small_tiles(spark, rows, columns, tmp_path):
    draw = random.Random(5)
    words = ["Straße", "a-b", "x1y", "naïve", "日本", "THE", "the", "co.op", " ", "z"] + [f"w{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(60)]
    data = [(i, " ".join(draw.choices(words, k=draw.randrange(0, 40))), draw.choice(["en", "en", None, "xx"]), draw.choice(["s1", "s2", "é", "", None, "s3", "s4"])) for i in range(150)]
    data += [(900, None, "lone", None), (901, "", "lone", "b"), (902, "only once here", "lone", "c"), *data[:3]]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string, source string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")

    def query(s, sf_dir):
        return source_divergence.divergence(with_extra(s.read.parquet(f"{sf_dir}/documents.parquet")), rows=rows, columns=columns)

    sql = source_divergence.ORACLE.replace("FROM documents", f"FROM '{tmp_path}/documents.parquet/*.parquet'")
    res = compare(spark, "odd", query, sql, str(tmp_path))
    assert res["values_match"] and res["oracle_rows"] == res["spark_rows"] > 0, res
    assert query(spark, str(tmp_path)).where("lang = 'lone' and part = 'pair' and value = 0").count() == 6
    assert source_divergence.divergence(docs.limit(0)).count() == 0


def test_quadtree_prices_every_pair():
    draw = np.random.default_rng(3)
    for rows, columns, full in ((1, 1, 1.0), (5, 33, 0.3), (13, 700, 0.01), (40, 90, 0.0), (9, 257, 1.0), (66, 500, 0.004)):
        counts = np.where(draw.random((rows, columns)) < full, draw.integers(1, 10**6, (rows, columns)), 0)
        totals = counts.sum(axis=1) + 2 * columns
        p = [[1 + source_divergence.SCALE * (int(c) + 2) // int(t) for c in row] for row, t in zip(counts, totals)]
        got = source_divergence.pair_sums(counts, totals)
        split = source_divergence.pair_sums(counts, totals, rows // 2)
        for i, j in itertools.combinations(range(rows), 2):
            want = sum((a - b) ** 2 // (a + b) for a, b in zip(p[i], p[j]))
            assert got[i, j] == want
            assert not i < rows // 2 <= j or split[i, j] == want


def test_shares_of_counts_beyond_64_bit_products():
    counts, totals = np.array([0, 10**12, 4 * 10**14]), np.array([7, 3 * 10**13, 9 * 10**15 // 9 + 1])
    want = [1 + source_divergence.SCALE * (int(c) + 2) // int(t) for c, t in zip(counts, totals)]
    assert source_divergence.share(counts, totals).tolist() == want


# --- shingle join -------------------------------------------------------------------------------
def brute_components(rows):
    """doc_id -> (n, component) by comparing all pairs of word lists."""
    sets = []
    for _, text in rows:
        words = [w for w in (text or "").translate({c: c + 32 for c in range(65, 91)}).replace("\v", " ").replace("\f", " ").translate({9: 32, 10: 32, 13: 32}).split(" ") if w]
        size = min(5, len(words))
        sets.append({tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if words else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        both = len(sets[i] & sets[j])
        if both and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
            root[find(j)] = find(i)
    low = {}
    for i, (doc_id, _) in enumerate(rows):
        r = find(i)
        low[r] = min((x for x in (low.get(r), doc_id) if x is not None), default=None)
    return sorted((str(d), len(sets[i]), str(low[find(i)])) for i, (d, _) in enumerate(rows))


def check_join(spark, rows):
    docs = with_extra(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    got = sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in shingle_join.join(docs).collect())
    assert got == brute_components(rows)


def test_join_equals_sql(spark):
    res = compare(spark, "op13", shingle_join.op13_shingle_join, shingle_join.ORACLE, SF_SMALL)
    assert res["values_match"] and res["columns_match"] and not res["type_mismatches"], res


def test_join_equals_brute_force(spark):
    draw = random.Random(13)
    words = [f"w{k}" for k in range(400)]
    rows, n = [], 0
    base = draw.choices(words, k=60)
    passage = draw.choices(words, k=55)
    for _ in range(60):  # a chain of edits: neighbours link, ends do not
        base = list(base)
        base[draw.randrange(60)] = draw.choice(words)
        rows.append((n := n + 1, " ".join(base)))
    for _ in range(40):  # many documents with one passage
        rows.append((n := n + 1, " ".join(passage + draw.choices(words, k=draw.randrange(0, 30)))))
    for _ in range(40):  # exact and reordered copies, short texts
        rows.append((n := n + 1, draw.choice([rows[3][1], rows[70][1].upper(), "one two", "ONE\ttwo", "a", " a\n", "a b c d e", "É x y z", "é x y z"])))
    rows += [(n + 1, None), (n + 2, ""), (n + 3, " \n\v "), (None, "w1 w2 w3"), (None, rows[0][1]), (n + 4, "x\x1cy z w q v"), rows[0], rows[-1]]
    check_join(spark, rows)


@pytest.mark.parametrize("group, queries", [(3, 2), (32, 256)])
def test_documents_of_sections_are_not_paired(spark, monkeypatch, group, queries):
    """Documents of five sections with four variants each: all share shingles, few link."""
    monkeypatch.setattr(shingle_join, "GROUP", group)
    monkeypatch.setattr(shingle_join, "QUERIES", queries)
    draw = random.Random(1)
    part = [[" ".join(f"s{s}v{v}w{draw.randrange(10**6)}" for _ in range(24)) for v in range(4)] for s in range(5)]
    rows = [(i, " ".join(part[s][draw.randrange(4)] for s in range(5))) for i in range(220)]
    rows += [(500 + i, r[1] + f" tail{i}") for i, r in enumerate(rows[:40])]
    check_join(spark, rows)


def test_join_of_no_rows(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert shingle_join.join(docs).collect() == []
    only = spark.createDataFrame([(1, None), (1, None), (None, "")], docs.schema)
    assert sorted(map(str, shingle_join.join(only).collect())) == sorted(
        ["Row(doc_id=1, n_shingles=0, component_id=1)"] * 2 + ["Row(doc_id=None, n_shingles=0, component_id=None)"]
    )


def test_union_bounds_and_opened_groups_are_exact():
    draw = np.random.default_rng(4)
    sets = [np.unique(draw.integers(0, 120, draw.integers(1, 90)).astype(np.uint64)) for _ in range(40)]
    members = shingle_join.Members(sets)
    for q in sets:
        both = [len(np.intersect1d(q, s)) for s in sets]
        assert len(members.columns(q)) >= max(both)
        want = [i for i, b in enumerate(both) if 100 * b >= 80 * (len(q) + len(sets[i]) - b)]
        assert members.linked(q).tolist() == want


def test_only_rows_that_may_be_asked_for_are_moved(spark):
    rows = spark.range(20_000).withColumn("x", F.col("id") * 3)
    keys = spark.createDataFrame([(k,) for k in range(0, 20_000, 50)] + [(7,), (7,), (None,), (99_999,)], "id long")
    got = [r["id"] for r in shingle_join.possible(rows, keys, "id").collect()]
    assert len(got) == len(set(got)) < 420 and {7, *range(0, 20_000, 50)} <= set(got)
    assert shingle_join.possible(rows, keys.limit(0), "id").columns == ["id", "x"]
    assert shingle_join.possible(rows, keys.limit(0), "id").count() == 0


def test_a_large_component_has_few_groups(spark):
    n = 10 * shingle_join.GROUP
    groups = spark.range(n + 3).select(F.col("id").alias("nid"), F.lit(60).alias("n"), F.col("id").alias("gid"))
    parts = groups.select("nid", F.when(F.col("nid") < n, F.lit(5)).otherwise(F.lit(n)).cast("long").alias("comp"))
    got = shingle_join.regrouped(groups, parts).collect()
    assert sorted(r["nid"] for r in got) == list(range(n + 3))
    assert len({r["gid"] for r in got if r["comp"] == 5}) <= 10 and {r["size"] for r in got} == {n, 3}
    assert {r["gid"] for r in got if r["comp"] == n} == {n, n + 1, n + 2}


def test_sets_know_their_group(spark):
    texts = [" ".join(f"w{k % 7}x{i}" for k in range(40)) for i in range(6)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts + texts[:2])], "doc_id long, text string")
    nodes = shingle_join.nodes_of(docs, shingle_join.measured(docs)[1])
    groups = shingle_join.grouped(nodes.drop("head"))
    sets = {r["nid"]: (r["gid"], bytes(r["hashes"])) for r in shingle_join.live_sets(docs, groups).collect()}
    assert {n: g for n, (g, _) in sets.items()} == {r["nid"]: r["gid"] for r in groups.collect()} and len(sets) == 6
    assert {h for _, h in sets.values()} == {s.tobytes() for s in shingle_join.shingle_sets([t.encode() for t in texts])}


def test_nodes_that_share_a_shingle_meet_by_group(spark):
    n, n_groups, tokens = 200, 10, list(range(12))
    groups = spark.range(n).select(F.col("id").alias("nid"), (F.col("id") % n_groups).alias("gid"), F.lit(1).cast("long").alias("size"), F.col("id").alias("comp"))
    # Every fourth node has too few of the shingles to link with any other; the last group has much larger sets.
    size = F.when(F.col("gid") == n_groups - 1, 600).otherwise(60).alias("n")
    head = F.when(F.col("nid") % 4 == 0, F.array(*(F.lit(t).cast("long") for t in tokens[:3]))).otherwise(F.array(*(F.lit(t).cast("long") for t in tokens)))
    nodes = groups.select("nid", size, head.alias("head"))
    heads = nodes.select("nid", "n", F.posexplode("head").alias("at", "token")).select("token", "nid", "n", (F.col("n") - F.col("at")).alias("rest"))
    pairs = shingle_join.group_pairs(heads, groups).collect()
    assert {(r["gid"], r["other"]) for r in pairs} == {(a, b) for a in range(n_groups - 1) for b in range(n_groups - 1) if a != b}
    assert all(1 < len(r["tokens"]) == len(r["rests"]) <= len(tokens) for r in pairs)
    got = [(r["nid"], r["gid"]) for r in shingle_join.asked(heads, groups, nodes).collect()]
    tops = {g: max(x for x in range(n) if x % n_groups == g) for g in range(n_groups)}
    want = {(x, g) for x in range(n) if x % 4 and x % n_groups < n_groups - 1 for g in range(n_groups - 1) if g != x % n_groups and x < tops[g]}
    assert len(got) == len(set(got)) and set(got) == want
    assert shingle_join.asked(heads.limit(0), groups, nodes).collect() == []


def test_a_very_long_text_and_its_copy(spark):
    draw = random.Random(2)
    text = " ".join(f"w{draw.randrange(10**5)}" for _ in range(120_000))
    rows = [(3, text), (9, text + " more"), (1, "other words"), (4, text[: len(text) // 2])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in shingle_join.join(docs).collect()}
    assert got == {3: 3, 9: 3, 1: 1, 4: 4}
