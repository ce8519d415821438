"""Document fingerprints by a homomorphic multiset hash (operator 3).

Every paragraph (line with a word) is hashed to a wide vector; a document's fingerprint is the
sum of its paragraphs' vectors, each lane modulo 2^32. So equal multisets of
paragraphs have equal fingerprints in any order, and a paragraph is inserted or deleted by
adding or subtracting its vector (``combine``). A vector has

* ``DENSE`` lanes from the paragraph's SHA-256, which decide equality;
* one lane that counts the paragraph's pieces (every run of ``PIECE`` words; a shorter paragraph
  is one piece) and
  ``SIGNS`` lanes, lane j counting the pieces whose hash has bit j set.

``2 * count_j - pieces`` are sums of random signs, so the cosine of two such vectors estimates
that of the multisets of pieces: the ``likeness``, 1 for equal fingerprints, 0 for unrelated ones.

Everything is DataFrame functions. Documents are dealt into ranges of ids (``bounds`` from
approximate quantiles), each of which also gets the first document of the next range, so that
the following document, the sums and the likeness to the next document all come from one shuffle
of the texts.

Null texts are empty: all lanes 0. Blank lines add nothing. Rows with equal ids are ordered by a
hash of their text, null ids come first; every row of the input gives a row. Other columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlake.llm import common

DENSE, SIGNS, PIECE = 8, 64, 3
#: Documents in a range of ids, and the most ranges.
RANGE_ROWS, RANGES = 1024, 20_000
LANES = DENSE + 1 + SIGNS
#: Bits of each lane.
BITS = 32
WORD = r"[^\x20\x09-\x0D]++"
SPACE = r"[\x20\x09\x0B-\x0D]++"
#: A word that starts a piece (group 1): the first of a short paragraph or one with enough words after it.
STARTS = (
    rf"(?:^(?:{SPACE})?(?={WORD}(?:{SPACE}{WORD}){{0,{PIECE - 2}}}(?:{SPACE})?$)"
    rf"|(?<![^\x20\x09-\x0D])(?={WORD}(?:{SPACE}{WORD}){{{PIECE - 1}}}))"
    rf"(?=({WORD}(?:{SPACE}{WORD}){{0,{PIECE - 1}}})){WORD}"
)


def paragraphs(text: Column) -> Column:
    """The lines of a text that have a word."""
    return F.filter(F.split(text, "\n", -1), lambda p: p.rlike(WORD))


def pieces(paragraph: Column) -> Column:
    """The paragraph's words, ``PIECE`` at a time, from every word that has so many; one piece if none has."""
    return F.regexp_extract_all(paragraph, F.lit(STARTS), F.lit(1))


def _dense(paragraph: Column) -> list[Column]:
    digest = F.sha2(paragraph, 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(DENSE)]


def summed(texts: DataFrame, keys: list[str]) -> DataFrame:
    """Fingerprint lanes (``keys, lanes``) of the column ``text`` of every row; the keys tell rows apart.

    Two counts of 32 bits share a long while they are added up.
    """
    half = SIGNS // 2
    # A text without paragraphs keeps a row.
    rows = texts.select(*keys, F.explode_outer(paragraphs(F.col("text"))).alias("paragraph"))
    rows = rows.select(*keys, *(x.alias(f"d{i}") for i, x in enumerate(_dense(F.col("paragraph")))), pieces(F.col("paragraph")).alias("parts"))
    dense = [F.col(f"d{i}") for i in range(DENSE)]
    rows = rows.select(*keys, *dense, F.posexplode_outer("parts").alias("at", "piece"))
    rows = rows.select(
        *keys,
        *(F.when(F.col("at") == 0, d).otherwise(0).alias(f"d{i}") for i, d in enumerate(dense)),
        F.when(F.col("piece").isNotNull(), 1).otherwise(0).alias("one"),
        F.when(F.col("piece").isNotNull(), F.xxhash64("piece")).otherwise(0).alias("h"),
    )
    mask = F.lit((1 << 32) | 1)
    sums = rows.groupBy(*keys).agg(
        *(F.sum(f"d{i}").alias(f"d{i}") for i in range(DENSE)),
        F.sum("one").alias("n"),
        *(F.sum(F.shiftright("h", j).bitwiseAND(mask)).alias(f"s{j}") for j in range(half)),
    )
    low = [F.col(f"s{j}").bitwiseAND(F.lit((1 << 32) - 1)) for j in range(half)]
    high = [F.shiftrightunsigned(f"s{j}", 32) for j in range(half)]
    values = [*dense, F.col("n"), *low, *high]
    lanes = [x.bitwiseAND(F.lit((1 << BITS) - 1)).cast("long") for x in values]
    return sums.select(*keys, F.array(*lanes).alias("lanes"))


def combine(a: Column, b: Column, sign: int = 1) -> Column:
    """The lanes of the multiset sum (``sign`` 1) or difference (-1) of two fingerprints' lanes."""
    return F.zip_with(a, b, lambda x, y: F.pmod(x + sign * y, F.lit(1 << BITS)))


def to_text(lanes: Column) -> Column:
    """Lower-case hexadecimal, every lane in full width."""
    hexed = F.transform(lanes, lambda x: F.lpad(F.lower(F.hex(x)), BITS // 4, "0"))
    return F.array_join(hexed, "")


def likeness(a: Column, b: Column) -> Column:
    """1 for equal fingerprints, else the cosine of the signed lanes, within 0 and 0.9999."""

    def signed(x: Column) -> Column:
        n = x[DENSE].cast("double")

        def around(v: Column) -> Column:  # the residue modulo 2^32 nearest to 0
            d = F.pmod(2 * v - n, F.lit(2.0**BITS))
            return F.when(d >= 2.0 ** (BITS - 1), d - 2.0**BITS).otherwise(d)

        return F.transform(F.slice(x, DENSE + 2, SIGNS), around)

    def dot(x: Column, y: Column) -> Column:
        return F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda s, v: s + v)

    sa, sb = signed(a), signed(b)
    size = F.sqrt(dot(sa, sa) * dot(sb, sb))
    cosine = F.when(size > 0, dot(sa, sb) / size).otherwise(0.0)
    return F.when(a == b, 1.0).otherwise(F.least(F.lit(0.9999), F.greatest(F.lit(0.0), cosine)))


def _range_of(value: Column, bounds: list[int]) -> Column:
    """How many of the sorted ``bounds`` are at most ``value``, by binary search; 0 for null."""
    if not bounds:
        return F.lit(0)
    table = F.array(*(F.lit(b) for b in bounds))
    steps = F.array(*(F.lit(1 << k) for k in reversed(range(len(bounds).bit_length()))))

    def step(at: Column, by: Column) -> Column:
        fits = (at + by <= len(bounds)) & (F.get(table, at + by - 1) <= value)
        return F.when(fits, at + by).otherwise(at)

    return F.aggregate(steps, F.lit(0), step)


def in_ranges(docs: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """``doc_id, text, range, guest``: every document in its range, and as a guest the next range's first.

    The driver sees the bounds and the first id of at most ``RANGES`` ranges.
    """
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"))
    n = ids.count()
    count = min(RANGES, common.parts_for(n, range_rows))
    shares = [k / count for k in range(1, count)]
    got = ids.agg(F.percentile_approx("doc_id", shares, 10 * count)).first()[0] if shares else None
    bounds = sorted(set(got or []))
    located = ids.withColumn("range", _range_of(F.col("doc_id"), bounds))
    firsts = {r["range"]: r["first"][0] for r in located.groupBy("range").agg(F.min(F.struct("doc_id")).alias("first")).collect()}
    filled = sorted(firsts)
    before = {b: filled[k - 1] for k, b in enumerate(filled)}  # the first range follows the last
    first = F.array(*(F.lit(firsts.get(b)).cast("long") for b in range(len(bounds) + 1)))
    prior = F.array(*(F.lit(before.get(b)).cast("int") for b in range(len(bounds) + 1)))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
    ).withColumn("own", _range_of(F.col("doc_id"), bounds))
    home = F.struct(F.col("own").alias("range"), F.lit(0).alias("guest"))
    visit = F.struct(F.get(prior, "own").alias("range"), F.lit(1).alias("guest"))
    opens = F.col("doc_id").eqNullSafe(F.get(first, "own"))
    return rows.select("doc_id", "text", F.inline(F.when(opens, F.array(home, visit)).otherwise(F.array(home))))


def fingerprints(docs: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``."""
    order = Window.partitionBy("range").orderBy("guest", "doc_id", F.xxhash64("text"))
    rows = in_ranges(docs, range_rows).select(
        "range",
        "guest",
        "doc_id",
        "text",
        F.row_number().over(order).alias("place"),
        F.lead("text").over(order).alias("next"),
        F.char_length("text").cast("long").alias("n_chars"),
    )
    cut = F.floor(F.col("n_chars") / 2).cast("int")
    kept = (F.col("n_chars") - cut).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), kept), F.substring("next", F.lit(1), cut))
    rows = rows.withColumn("edited", F.when(F.col("guest") == 0, edited))
    rows = rows.withColumn("edited_sha256", F.sha2(F.coalesce("edited", F.lit("")), 256))
    keys = ["range", "guest", "place", "doc_id", "n_chars", "edited_sha256"]
    texts = rows.select(*keys, F.posexplode(F.array("text", "edited")).alias("which", "text"))
    sums = summed(texts.where((F.col("guest") == 0) | (F.col("which") == 0)), [*keys, "which"])
    both = sums.groupBy(*keys).agg(
        F.max(F.when(F.col("which") == 0, F.col("lanes"))).alias("own"),
        F.max(F.when(F.col("which") == 1, F.col("lanes"))).alias("edit"),
    )
    after = Window.partitionBy("range").orderBy("guest", "place")
    both = both.withColumn("next", F.lead("own").over(after)).where("guest = 0")
    return both.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        to_text(F.col("own")).alias("fingerprint"),
        to_text(F.col("edit")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("edit")).alias("near_edited"),
        likeness(F.col("own"), F.col("next")).alias("near_next"),
    )


def op3_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(common.load(spark, sf_dir, "documents"))
