"""Divergence of sources by their terms, over a k²-quadtree of the count matrix (operator 12).

A language's matrix has a row for each source and a column for each term that at least
``MIN_DOCS`` of its documents hold. A cell's price between two rows is
``floor((p - q)^2 / (p + q))`` for the rows' smoothed shares ``p, q`` in billionths; a pair's
divergence is the sum over all columns. All arithmetic is in integers.

*Counting* is one narrow pass: a worker counts the terms of its documents by language and source
and hands its counts on when it holds ``HELD`` of them, so what is shuffled is combined first.

*Tiles.* Columns are dealt over blocks of about ``COLUMNS`` by the term's hash (within a block, terms of many
documents first, so that empty cells lie together), rows over blocks of about ``ROWS``. A tile is
a block of columns with two blocks of rows; a task holds one tile, whatever the sizes of the
vocabulary, the sources or any one source.

*Quadtree.* A tile's tree halves rows and columns (k = 2) down to leaves of ``LEAF`` cells; each
level is a bitmap of the quadrants that hold a count. Pairs of row ranges descend it together. Where
both quadrants are empty, every pair of their rows has one constant price a column, as an empty cell's
share depends on its row alone: those columns are counted, not visited. Leaves in which at least
one row range holds a count are priced cell by cell.

Null texts, languages and sources are ''. A document without terms still makes its group appear.
A language without kept terms has divergence 0 everywhere. Equal values are ranked by the item's UTF-8
bytes. Repeated rows count again; an empty table gives no rows; texts of any length are counted
whole; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlake.llm import common
from ledgerlake.operators.joins import salted_join

MIN_DOCS, TOP = 10, 10
SCALE = 1_000_000_000
#: Distinct (language, source, term) counts a worker holds before it hands them on.
HELD = 400_000
#: Rows and columns of a block, on average; rows and columns of a leaf.
ROWS, COLUMNS = 64, 4096
LEAF = (4, 32)
#: Cells of pairs of leaves priced at once.
PRICED = 1 << 20

#: Bytes of terms: ASCII letters, in lower case, and all bytes of other characters; the rest are spaces.
TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(TERM_BYTES).split()


# --- counting -----------------------------------------------------------------------------------
COUNTED = "lang string, source string, term binary, n long, docs long"


@common.worker("divergence")
def _count(batches):
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}

    def out():
        for (lang, source), (n, docs) in held.items():
            # The row without a term says that the group occurs.
            terms = [None, *n]
            size = len(terms)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * size, pa.string()),
                    pa.array([source] * size, pa.string()),
                    pa.array(terms, pa.binary()),
                    pa.array([0, *n.values()], pa.int64()),
                    pa.array([0, *map(docs.__getitem__, n)], pa.int64()),
                ],
                ["lang", "source", "term", "n", "docs"],
            )
        held.clear()

    size = 0
    for batch in batches:
        for lang, source, text in zip(*(batch.column(c).to_pylist() for c in ("lang", "source", "text"))):
            n, docs = held.setdefault((lang, source), (Counter(), Counter()))
            words = terms_of(text)
            size -= len(n)
            n.update(words)
            docs.update(set(words))
            size += len(n)
            if size >= HELD:
                yield from out()
                size = 0
    yield from out()


def term_counts(docs: DataFrame) -> DataFrame:
    """``lang, source, term, n, docs``: occurrences and documents; a row with a null term for each group (written table)."""
    common.prepare_workers(docs.sparkSession)
    lang, source, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("lang", "source", "text"))
    rows = docs.select(lang.alias("lang"), source.alias("source"), text.cast("binary").alias("text"))
    rows = rows.mapInArrow(_count, COUNTED)
    return common.saved(rows.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "term_counts")


# --- shares and prices --------------------------------------------------------------------------
def share(count: np.ndarray, total: np.ndarray) -> np.ndarray:
    """``1 + floor(SCALE * (count + 2) / total)`` in 64-bit integers: long division by thousands."""
    whole, rest = np.divmod(count + 2, total)
    for _ in range(3):
        digit, rest = np.divmod(rest * 1000, total)
        whole = whole * 1000 + digit
    return whole + 1


def price(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


# --- the quadtree of one tile ---------------------------------------------------------------------
def quadtree(filled: np.ndarray) -> list[np.ndarray]:
    """Bitmaps of the quadrants that hold a count, leaves first; a side that is one quadrant wide stays."""
    levels = [filled]
    while levels[-1].size > 1:
        bits = levels[-1]
        for axis in (0, 1):
            if bits.shape[axis] > 1:
                bits = np.logical_or.reduceat(bits, np.arange(0, bits.shape[axis], 2), axis=axis)
        levels.append(bits)
    return levels


def _descend(a, b, c, below: np.ndarray, here: np.ndarray):
    """The quadrants below triples of two row ranges (a <= b) and a column range, each pair of rows once."""
    rows, columns = (2 if s > h else 1 for s, h in zip(below.shape, here.shape))
    parts = [
        (a * rows + i, b * rows + j, c * columns + k) for i in range(rows) for j in range(rows) for k in range(columns)
    ]
    a, b, c = (np.concatenate(x) for x in zip(*parts))
    inside = (a <= b) & (b < below.shape[0]) & (c < below.shape[1])
    return a[inside], b[inside], c[inside]


def pair_sums(counts: np.ndarray, totals: np.ndarray, split: int | None = None) -> np.ndarray:
    """Sums of prices over all columns, for every pair of rows (upper triangle).

    ``counts`` is rows x columns, ``totals`` the divisor ``N + 2 V`` of each row. With ``split``, only
    pairs of a row before it with a row from it on are asked for; others may be missing.
    """
    n_rows, n_columns = counts.shape
    out = np.zeros((n_rows, n_rows), np.int64)
    if not n_columns or not n_rows:
        return out
    high, wide = LEAF
    rows, columns = -(-n_rows // high), -(-n_columns // wide)
    filled = np.zeros((rows * high, columns * wide), np.int64)
    filled[:n_rows, :n_columns] = counts
    divisor = np.ones(rows * high, np.int64)
    divisor[:n_rows] = totals
    shares = share(filled, np.maximum(divisor, 2)[:, None]).reshape(rows, high, columns, wide)
    real = (np.arange(columns * wide) < n_columns).reshape(columns, wide)
    tree = quadtree(filled.reshape(rows, high, columns, wide).any(axis=(1, 3)))
    sums = np.zeros((rows, rows, high, high), np.int64)
    empty = np.zeros((rows, rows), np.int64)  # columns in which both ranges of rows are empty
    a = b = c = np.zeros(1, np.int64)
    for level in range(len(tree) - 1, -1, -1):
        bits = tree[level]
        if split is not None:
            tall = _leaves_under(tree, level)[0] * high
            asked = (a * tall < split) & ((b + 1) * tall > split)
            a, b, c = a[asked], b[asked], c[asked]
        visit = bits[a, c] | bits[b, c]
        _count_empty(empty, a[~visit], b[~visit], c[~visit], level, tree, n_columns)
        a, b, c = a[visit], b[visit], c[visit]
        if level:
            a, b, c = _descend(a, b, c, tree[level - 1], bits)
    step = max(1, PRICED // (high * high * wide))
    for k in range(0, len(a), step):
        x, y, z = a[k : k + step], b[k : k + step], c[k : k + step]
        cost = price(shares[x, :, z, :][:, :, None, :], shares[y, :, z, :][:, None, :, :]) * real[z][:, None, None, :]
        np.add.at(sums, (x, y), cost.sum(axis=3))
    flat = sums.transpose(0, 2, 1, 3).reshape(rows * high, rows * high)[:n_rows, :n_rows]
    blank = share(np.zeros(n_rows, np.int64), totals)
    times = np.repeat(np.repeat(empty, high, axis=0), high, axis=1)[:n_rows, :n_rows]
    return flat + times * price(blank[:, None], blank[None, :])


def _leaves_under(tree: list[np.ndarray], level: int) -> tuple[int, int]:
    """Leaves that a quadrant of a level covers, by rows and by columns."""
    tall = wide = 1
    for bits in tree[:level]:
        tall *= 2 if bits.shape[0] > 1 else 1
        wide *= 2 if bits.shape[1] > 1 else 1
    return tall, wide


def _count_empty(empty, a, b, c, level: int, tree: list[np.ndarray], n_columns: int) -> None:
    """Add the columns of empty quadrants of a level to all pairs of leaf rows under them."""
    if not len(a):
        return
    rows, columns = tree[0].shape
    tall, wide = _leaves_under(tree, level)
    width = np.minimum((c + 1) * wide * LEAF[1], n_columns) - c * wide * LEAF[1]
    grid = np.zeros(tree[level].shape[:1] * 2, np.int64)
    np.add.at(grid, (a, b), width)
    empty += np.repeat(np.repeat(grid, tall, axis=0), tall, axis=1)[:rows, :rows]


# --- tiles --------------------------------------------------------------------------------------
PARTS = "lang string, source string, part string, item binary, value long"


def _tile(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """Partial sums of a tile's pairs; on the diagonal also the largest term prices of each row."""
    lang, _, first, second = (k.as_py() for k in key)
    is_group = np.asarray(table.column("col").is_null())
    groups = table.filter(pa.array(is_group)).sort_by([("rb", "ascending"), ("source", "ascending")])
    cells = table.filter(pa.array(~is_group))
    names = groups.column("source").to_pylist()
    side = groups.column("rb").to_numpy()
    totals = groups.column("total").to_numpy()
    at = {s: i for i, s in enumerate(names)}
    row = np.fromiter((at[s] for s in cells.column("source").to_pylist()), np.int64, len(cells))
    counts = np.zeros((len(names), groups.column("width")[0].as_py()), np.int64)
    n = cells.column("n").to_numpy()
    counts[row, cells.column("col").to_numpy() - 1] = n
    split = int((side == first).sum()) if first != second else None
    sums = pair_sums(counts, totals, split)
    x, y = np.triu_indices(len(names), 1)
    ours = (side[x] != side[y]) if first != second else np.ones(len(x), bool)
    x, y = x[ours], y[ours]
    sources, items, values = [names[i] for i in x], [names[i].encode() for i in y], sums[x, y].tolist()
    parts = ["pair"] * len(values)
    if first == second and len(cells):
        p = share(n, totals[row])
        q = share(cells.column("everywhere").to_numpy(), cells.column("lang_total").to_numpy())
        value = price(p, q)
        term = cells.column("term").to_pylist()
        order = np.lexsort((-value, row))
        order = order[(p > q)[order]]
        for some in np.split(order, np.flatnonzero(np.diff(row[order])) + 1):
            if len(some):
                least = value[some[min(TOP, len(some)) - 1]]
                best = sorted((-int(value[i]), term[i]) for i in some[value[some] >= least])[:TOP]
                sources += [names[row[some[0]]]] * len(best)
                parts += ["term"] * len(best)
                items += [t for _, t in best]
                values += [-v for v, _ in best]
    return pa.table(
        {
            "lang": pa.array([lang] * len(parts), pa.string()),
            "source": pa.array(sources, pa.string()),
            "part": pa.array(parts, pa.string()),
            "item": pa.array(items, pa.binary()),
            "value": pa.array(values, pa.int64()),
        }
    )


def _blocks(count: Column, size: int) -> Column:
    return F.greatest(F.lit(1), F.ceil(count / size)).cast("long")


def tiles(counts: DataFrame, min_docs: int = MIN_DOCS, rows: int = ROWS, columns: int = COLUMNS) -> DataFrame:
    """Rows of the tiles ``lang, cb, i, j``: a row for each group (no ``col``) and for each of its cells.

    ``counts`` is a written table (``term_counts``).
    """
    terms = counts.where("term is not null")
    kept = terms.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("everywhere")).where(F.col("docs") >= min_docs)
    kept = common.saved(kept, "terms")
    langs = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("everywhere").alias("all_n"))
    langs = counts.select("lang").distinct().join(langs, "lang", "left").fillna(0)
    langs = langs.withColumn("n_cb", _blocks(F.col("v"), columns))
    cb = F.pmod(F.xxhash64("term"), F.col("n_cb"))
    place = F.row_number().over(Window.partitionBy("lang", "cb").orderBy(F.desc("docs"), "term"))
    # A language may hold most terms: they are dealt over several reducers, then over the blocks.
    placed = salted_join(kept, langs.select("lang", "n_cb"), "lang", how="inner").withColumn("cb", cb).withColumn("col", place).drop("docs", "n_cb")
    placed = common.saved(placed, "columns")
    cells = terms.select("lang", "source", "term", "n").join(placed, ["lang", "term"])
    cells = common.saved(cells, "cells")
    groups = counts.where("term is null").select("lang", "source")
    groups = groups.join(cells.groupBy("lang", "source").agg(F.sum("n").alias("own_n")), ["lang", "source"], "left").fillna(0, ["own_n"])
    sizes = groups.groupBy("lang").agg(_blocks(F.count("*"), rows).alias("n_rb"))
    groups = groups.join(sizes, "lang").join(langs, "lang")
    groups = common.saved(
        groups.select(
            "lang",
            "source",
            F.pmod(F.xxhash64("source"), F.col("n_rb")).alias("rb"),
            "n_rb",
            "n_cb",
            (F.col("own_n") + 2 * F.col("v")).alias("total"),
            (F.col("all_n") + 2 * F.col("v")).alias("lang_total"),
        ),
        "groups",
    )
    widths = placed.groupBy("lang", "cb").agg(F.count("*").alias("width"))
    heads = groups.withColumn("cb", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_cb") - 1)))
    heads = heads.join(widths, ["lang", "cb"], "left").fillna(0, ["width"])
    none = F.lit(None)
    heads = heads.select(
        "lang", "cb", "rb", "n_rb", "source", none.cast("int").alias("col"), none.cast("long").alias("n"),
        none.cast("long").alias("everywhere"), none.cast("binary").alias("term"), "total", "lang_total", "width",
    )
    cells = cells.join(groups.select("lang", "source", "rb", "n_rb", "lang_total"), ["lang", "source"]).select(
        "lang", "cb", "rb", "n_rb", "source", "col", "n", "everywhere", "term", none.cast("long").alias("total"), "lang_total",
        none.cast("long").alias("width"),
    )
    both = heads.union(cells).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_rb") - 1)))
    diagonal = F.col("rb") == F.col("other")
    return both.select(
        "lang", "cb", F.least("rb", "other").alias("i"), F.greatest("rb", "other").alias("j"), "rb", "source", "col", "n",
        F.when(diagonal, F.col("everywhere")).alias("everywhere"), F.when(diagonal, F.col("term")).alias("term"),
        "total", "lang_total", "width",
    )


def divergence(docs: DataFrame, min_docs: int = MIN_DOCS, rows: int = ROWS, columns: int = COLUMNS) -> DataFrame:
    """``lang, source, part, item, value, rank``: every other source of the language, and the ``TOP`` terms, of every group."""
    found = tiles(term_counts(docs), min_docs, rows, columns).groupBy("lang", "cb", "i", "j").applyInArrow(_tile, PARTS)
    found = common.saved(found, "parts")
    item = F.col("item").cast("string").alias("item")
    pairs = found.where("part = 'pair'").groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    pairs = pairs.select("lang", "source", item, "value")
    pairs = pairs.union(pairs.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pairs.withColumn("rank", F.row_number().over(order))
    terms = found.where("part = 'term'").select("lang", "source", item, "value")
    terms = terms.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= TOP)

    def named(df: DataFrame, part: str) -> DataFrame:
        return df.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")

    return named(pairs, "pair").union(named(terms, "term"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence(common.load(spark, sf_dir, "documents"))


#: The same by plain SQL in 128-bit integers.
ORACLE = f"""
WITH doc AS (
    SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
    FROM documents
), word AS (
    SELECT d, lang, source, unnest(regexp_extract_all(t, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM doc
), kept AS (
    SELECT lang, term, count(*)::HUGEINT AS n FROM word GROUP BY lang, term HAVING count(DISTINCT d) >= {MIN_DOCS}
), size AS (
    SELECT lang, count(*)::HUGEINT AS v, sum(n)::HUGEINT AS n FROM kept GROUP BY lang
), own AS (
    SELECT w.lang, w.source, w.term, count(*)::HUGEINT AS n FROM word w JOIN kept k ON w.lang = k.lang AND w.term = k.term
    GROUP BY w.lang, w.source, w.term
), grp AS (
    SELECT g.lang, g.source, coalesce(sum(o.n), 0)::HUGEINT AS n
    FROM (SELECT DISTINCT lang, source FROM doc) g LEFT JOIN own o ON g.lang = o.lang AND g.source = o.source
    GROUP BY g.lang, g.source
), cell AS (
    SELECT g.lang, g.source, k.term, coalesce(o.n, 0) AS n, 1 + {SCALE}::HUGEINT * (coalesce(o.n, 0) + 2) // (g.n + 2 * s.v) AS p,
           1 + {SCALE}::HUGEINT * (k.n + 2) // (s.n + 2 * s.v) AS q
    FROM grp g JOIN size s ON g.lang = s.lang JOIN kept k ON k.lang = g.lang
    LEFT JOIN own o ON o.lang = g.lang AND o.source = g.source AND o.term = k.term
), pair AS (
    SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
    FROM cell a JOIN cell b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
    GROUP BY a.lang, a.source, b.source
), every AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(p.value, 0) AS value
    FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN pair p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
    UNION ALL
    SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM cell WHERE n > 0 AND p > q
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS r FROM every
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(r AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR r <= {TOP}
"""
