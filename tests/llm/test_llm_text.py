"""Token counts, packing and N-best segmentation against the libraries and brute force."""

import itertools
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import nbest_pieces, packing, token_counts, word_ids
from conftest import SF_SMALL, rows

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    None,
    "",
    " \n\t ",
    "Don't STOP'll 'sab it's 12ab3",
    "caf\u0065\u0301 ﬁ ÀÖ×÷ß µª ΑΣ ς İ",
    "a<|endoftext|>b <|startoftext|> <| x |>",
    "x\x1cy\x85z\u3000w\u00a0v",
    "日本語 한국어 🙂🙂",
    "&&&***### 1,234.5",
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(list(enumerate([*ODD, ODD[3]])), "doc_id long, text string")


def library_counts(path, texts):
    lib = word_ids.load_tokenizer(path)
    return [len(lib.encode(t or "", add_special_tokens=False).ids) for t in texts]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_counts_equal_the_library(odd, name):
    path = public_tokenizers.path(name)
    got = {r["doc_id"]: r for r in token_counts.token_counts(odd.withColumn("n_tokens", F.lit(1)), path).collect()}
    texts = [*ODD, ODD[3]]
    assert [got[i]["n_tokens"] for i in range(len(texts))] == library_counts(path, texts)
    assert [got[i]["n_bytes"] for i in range(len(texts))] == [len((t or "").encode()) for t in texts]


def test_special_strings_are_matched_as_written(spark):
    parts = ["<|ENDOFTEXT|>", "<|StartOfText|> hi", "<|endoftext|>", "Mixed<|EndOfText|>Case <|endoftext|>UP", "<|STARTOFTEXT|><|startoftext|>", "< |ENDOFTEXT|>"]
    texts = [*parts, " Plain WORDS ".join(parts), " ".join(parts * 400)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["n_tokens"] for r in token_counts.token_counts(docs, WORD_BPE).collect()}
    assert [got[i] for i in range(len(texts))] == library_counts(WORD_BPE, texts)
    lib = word_ids.load_tokenizer(WORD_BPE)
    for t, ids in zip(texts, word_ids.WordIds(WORD_BPE).encode([t.encode() for t in texts])):
        assert np.frombuffer(ids, "<u4").tolist() == lib.encode(t, add_special_tokens=False).ids
    check_packing(packing.pack(packing.pieces(docs, cap=16), cap=16).collect(), dict(enumerate(texts)), 16)


def test_op1_whole_table_and_chunks(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    true = dict(zip(texts, library_counts(WORD_BPE, texts.values())))
    for got in (token_counts.op1_token_counts(spark, SF_SMALL), token_counts.token_counts(docs, chunk_chars=500, overlap_chars=24)):
        rows = got.collect()
        assert {r["doc_id"]: r["n_tokens"] for r in rows} == true
        assert all(r["over_limit"] == (r["n_tokens"] > 2048) for r in rows)


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"])
@pytest.mark.parametrize("text", ["word " * 400, "x" * 3000, "ab1!'s " * 50 + "y" * 900 + " tail" * 90, "é\n\n  ü " * 300])
def test_splice_equals_whole_encoding(name, text):
    encode = token_counts.offset_encoder(public_tokenizers.path(name))
    got = np.concatenate(list(token_counts.spliced(text, encode, chunk=200, overlap=20)))
    assert got.tolist() == encode(text)[0].tolist()


def test_chunks_are_encoded_by_remembered_words():
    text = "Unbelievably  ünbelievable<|endoftext|>\n\x0b日本's 12a\x1cb \u2003x "
    ids, starts, ends = token_counts.offset_encoder(WORD_BPE)(text)
    assert ids.tolist() == word_ids.load_tokenizer(WORD_BPE).encode(text, add_special_tokens=False).ids
    places = [(m.start(), m.end()) for m in re.finditer(r"[^ \t\n\r\x0b\x0c]+", text)]
    assert sorted(set(zip(starts.tolist(), ends.tolist()))) == [p for p in places if text[slice(*p)].strip()]
    assert [len(x) for x in token_counts.offset_encoder(WORD_BPE)("")] == [0, 0, 0]


def test_counts_of_no_rows(spark):
    assert token_counts.token_counts(spark.createDataFrame([], "doc_id long, text string")).count() == 0


# --- packing --------------------------------------------------------------------------------------
def test_fullest_is_the_best_subset_sum():
    rng = np.random.default_rng(1)
    for _ in range(200):
        lengths = rng.integers(1, 15, rng.integers(1, 8)).tolist()
        room = int(rng.integers(0, 40))
        left = {x: lengths.count(x) for x in lengths}
        best = max(sum(c) for k in range(len(lengths) + 1) for c in itertools.combinations(lengths, k) if sum(c) <= room)
        chosen = packing.fullest(left, room)
        assert sum(x * m for x, m in chosen.items()) == best
        assert all(m <= left[x] for x, m in chosen.items())


def bins_at_least(counts, cap):
    """Martello and Toth's bound L2: no packing needs fewer bins."""
    best = 0
    for small in range(cap // 2 + 1):
        large = sum(c for x, c in counts.items() if x > cap - small)
        middle = {x: c for x, c in counts.items() if cap / 2 < x <= cap - small}
        rest = sum(x * c for x, c in counts.items() if small <= x <= cap / 2)
        room = sum((cap - x) * c for x, c in middle.items())
        best = max(best, large + sum(middle.values()) + max(0, -(-(rest - room) // cap)))
    return best


def test_bins_hold_every_piece_once():
    rng = np.random.default_rng(2)
    counts = {int(x): int(c) for x, c in zip(rng.permutation(64)[:40] + 1, rng.integers(1, 3000, 40))}
    plan = packing.minimum_bin_slack(counts, 64)
    used = {}
    for chosen, times in plan:
        assert sum(x * m for x, m in chosen.items()) <= 64 and times > 0
        for x, m in chosen.items():
            used[x] = used.get(x, 0) + m * times
    assert used == counts
    assert sum(t for _, t in plan) <= 1.02 * bins_at_least(counts, 64) + 1


def check_packing(rows, texts, cap):
    lib = word_ids.load_tokenizer(WORD_BPE)
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    for i, t in texts.items():
        ids = np.array([*lib.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        got = sorted(by_doc[i], key=lambda r: r["piece"])
        assert [r["start"] for r in got] == list(range(0, len(ids), cap))
        for r in got:
            part = ids[r["start"] : r["start"] + cap]
            assert (r["length"], r["ids_crc32"]) == (len(part), zlib.crc32(part.tobytes()))
    for got in by_sequence.values():
        got.sort(key=lambda r: r["offset"])
        ends = np.cumsum([r["length"] for r in got])
        assert ends[-1] <= cap and [r["offset"] for r in got] == [0, *ends[:-1]]
    return len(by_sequence)


def test_op8_packs_whole_documents(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    rows = packing.op8_best_fit_packing(spark, SF_SMALL).collect()
    assert check_packing(rows, texts, 2048) <= -(-sum(r["length"] for r in rows) // 2048) + 1


def test_packing_of_odd_texts_and_a_hot_length(spark, odd):
    many = odd.union(spark.range(100, 400).selectExpr("id AS doc_id", "'same words here' AS text"))
    texts = {r["doc_id"]: r["text"] for r in many.collect()}
    rows = packing.pack(packing.pieces(many, cap=16), cap=16, group_rows=20).collect()
    check_packing(rows, texts, 16)
    assert packing.pack_documents(many.limit(0)).count() == 0


# --- N-best segmentation --------------------------------------------------------------------------
@pytest.fixture(scope="module")
def lattices():
    return nbest_pieces.Lattices(public_tokenizers.path(nbest_pieces.MODEL))


def every_path(lat, text):
    s, out = lat.model.normalize(text), []

    def go(at, score, ids):
        if at == len(s):
            out.append((score, ids))
            return
        for end in range(at + 1, min(len(s), at + 16) + 1):
            if s[at:end] in lat.pieces:
                piece_score, i = lat.pieces[s[at:end]]
                go(end, score + piece_score, (*ids, i))
        if s[at] not in lat.single:
            go(at + 1, score + lat.unknown, ids + lat.fallback(s[at]))

    go(0, 0.0, ())
    return out


@pytest.mark.parametrize("text", ["hello worl", "the  cat", "éñ ß", "a", "x\nyz☃q", " aa aa aa", "inging", "thethe the", ""])
@pytest.mark.parametrize("n", [1, 2, 4, 9])
def test_nbest_equals_all_paths(lattices, text, n):
    paths = every_path(lattices, text)
    got = [(s, tuple(np.frombuffer(x, "<u4").tolist())) for s, x in lattices.segmentations(text, n)]
    assert [s for s, _ in got] == sorted((s for s, _ in paths), reverse=True)[:n]
    assert len(set(got)) == len(got) and set(got) <= set(paths)
    assert all(lattices.decode(ids) == text for _, ids in got)


def test_astar_order_and_long_unit(lattices):
    found = lattices.nbest("▁internationalization", 25)
    true = sorted((s for s, _ in every_path(lattices, "internationalization")), reverse=True)[:25]
    assert [s for s, _ in found] == true
    assert lattices.segmentations("q" * 5000, 2)[0][0] >= lattices.segmentations("q" * 5000, 2)[1][0]


def test_astar_of_long_ties_and_blobs(lattices):
    rng = np.random.default_rng(5)
    blob = "".join(rng.choice(list("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"), 100_000))
    for text in ("-" * 5000, blob):
        got = lattices.segmentations(text, 4)
        assert len({ids for _, ids in got}) == 4
        assert [s for s, _ in got] == sorted((s for s, _ in got), reverse=True)
        for score, ids in got:
            ids = np.frombuffer(ids, "<u4").tolist()
            assert lattices.decode(ids) == text
            assert score == sum(lattices.pieces[lattices.model.id_to_piece(i)][0] for i in ids)


def nbest_by_place(lat, unit, n):
    """Scores of the n best paths, keeping the n best of every place."""
    kept = [[0.0]] + [[] for _ in unit]
    for last, (length, score, _) in lat.edges(unit):
        kept[last + 1] = sorted(kept[last + 1] + [s + score for s in kept[last + 1 - length]], reverse=True)[:n]
    return kept[-1]


def test_astar_equals_nbest_by_place(lattices):
    rng = np.random.default_rng(6)
    for letters in ("-", "ab", "aeinrst", "the=-☃"):
        for size in (1, 7, 60, 300):
            unit = "▁" + "".join(rng.choice(list(letters), size))
            for n in (1, 4, 9):
                assert [s for s, _ in lattices.nbest(unit, n)] == nbest_by_place(lattices, unit, n)


def test_decode_agrees_with_the_library(lattices):
    for t in ("  two  spaces ", "tab\tnew\nline", "日本☃ é", "plain words"):
        ids = lattices.model.encode(t)
        assert lattices.decode(ids) == lattices.model.decode(ids) == t


def test_op10_rows(spark, odd):
    rows = nbest_pieces.segment(odd.withColumn("rank", F.lit(0)), n=3).collect()
    empty = [r for r in rows if r["doc_id"] in (0, 1)]
    assert [(r["rank"], r["score"], r["n_pieces"]) for r in empty] == [(1, 0.0, 0)] * 2
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    got = nbest_pieces.op10_nbest_pieces(spark, SF_SMALL).collect()
    assert {r["doc_id"] for r in got} == {r["doc_id"] for r in docs.collect()}
    by_doc = {}
    for r in sorted(got, key=lambda r: r["rank"]):
        by_doc.setdefault(r["doc_id"], []).append(r["score"])
    assert all(s == sorted(s, reverse=True) for s in by_doc.values())
    assert nbest_pieces.segment(odd.limit(0)).count() == 0


def test_ids_leave_the_workers_and_decode_to_the_texts(spark, odd, lattices):
    docs = odd.union(spark.createDataFrame([(100, "-" * 3000), (101, "x " * 2000), (102, "\0 \u2581a")], odd.schema))
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    segments = nbest_pieces.segment(docs)
    assert segments.schema["ids"].dataType.simpleString() == "array<int>"
    ids = {(r["doc_id"], r["rank"]): r["ids"] for r in segments.collect()}
    rows = nbest_pieces.decode(segments.withColumn("text", F.lit(0))).collect()
    assert len(rows) == len(ids)
    for r in rows:
        own = ids[r["doc_id"], r["rank"]]
        assert (r["n_pieces"], r["ids_crc32"]) == (len(own), zlib.crc32(np.array(own, "<u4").tobytes()))
        assert r["text"] == lattices.model.normalize(texts[r["doc_id"]]).replace("\u2581", " ").removeprefix(" ") == lattices.model.decode(own)


def test_units_searched_side_by_side_equal_one_by_one(lattices):
    rng = np.random.default_rng(17)
    chars = sorted(c for c in lattices.single if c != nbest_pieces.MARK)
    units = {nbest_pieces.MARK * int(rng.integers(0, 3)) + "".join(rng.choice(chars, rng.integers(1, 30))) for _ in range(600)}
    units |= {"-" * 60, nbest_pieces.MARK * 5, *(nbest_pieces.MARK + w for w in "the of international unbelievably".split())}
    units = sorted(u for u in units if u)
    lattices.learn(units)
    for u in units:
        assert lattices.known[u] == lattices.viterbi(u), u


def test_characters_without_a_piece_are_searched_side_by_side(lattices):
    a, b = [chr(c) for c in range(0x13000, 0x13100) if chr(c) not in lattices.single][:2]
    units = [f"▁{a}", b, f"a{a}b{b}{b}c", f"▁日本語{a}the", b * 60, "▁plain", "x" * 40 + a]
    lattices.learn(units)
    for u in units:
        assert lattices.known[u] == lattices.viterbi(u), u


def test_units_of_the_older_generation_come_back(lattices):
    own = nbest_pieces.Lattices(public_tokenizers.path(nbest_pieces.MODEL))
    own.meet([["▁the", "▁☃"]])
    want = dict(own.known)
    own.older, own.known = own.known, {}
    own.meet([["▁the", "▁☃", "▁new"]])
    assert want.items() <= own.known.items() and set(own.known) == {"▁the", "▁☃", "▁new"}


def test_pieces_are_matched_at_all_places_at_once(lattices):
    units = ["▁the", "▁☃international", "\n", "▁", "internationalization", "▁" + "-" * 70]
    codes = np.frombuffer("".join(units).encode("utf-32-le"), "<u4")
    ends = np.cumsum([len(u) for u in units])
    last, piece = lattices.trie.matches(codes, np.repeat(ends, [len(u) for u in units]))
    names = list(lattices.pieces)
    want = sorted(
        (int(e) - len(u) + b - 1, names.index(u[a:b]))
        for u, e in zip(units, ends)
        for a in range(len(u))
        for b in range(a + 1, len(u) + 1)
        if u[a:b] in lattices.pieces
    )
    assert sorted(zip(last.tolist(), piece.tolist())) == want


def test_remembered_units_come_back_from_columns():
    own = nbest_pieces.Lattices(public_tokenizers.path(nbest_pieces.MODEL))
    long = "▁" + "xy" * nbest_pieces.LONGEST
    texts = [["▁the", "▁☃", "▁the"], [], [long, "▁of", "\ud800"]]
    for _ in range(2):  # new, then known units
        met = own.meet(texts)
        for k, units in enumerate(texts):
            a, b = met.bounds[k : k + 2]
            assert [(met.ids[met.ends[i] : met.ends[i + 1]].tobytes(), met.scores[i], met.losses[i], met.read(i)) for i in range(a, b)] == [
                own.viterbi(u) for u in units
            ]
        assert set(own.known) == {"▁the", "▁☃", "▁of", "\ud800"}
        assert own.known["▁☃"] == own.viterbi("▁☃") and "▁new" not in own.known


def test_one_pass_equals_segmenting_then_decoding(spark, odd):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    more = odd.unionByName(spark.createDataFrame([(900, "-" * 700 + " _▁_ x"), (901, "a\nb\n\nc"), (902, "🙂" * 40)], odd.schema))
    for some in (docs, more.withColumn("ids", F.lit(1))):
        two = nbest_pieces.decode(nbest_pieces.segment(some))
        two = two.withColumn("text_crc32", F.crc32(F.col("text").cast("binary"))).drop("text")
        assert rows(nbest_pieces.segment_and_decode(some), *two.columns) == rows(two)


def test_op10_decodes_every_document(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    rows = nbest_pieces.op10_nbest_pieces(spark, SF_SMALL).collect()
    assert {r["doc_id"] for r in rows} == set(texts)
    assert all(r["text_crc32"] == zlib.crc32(texts[r["doc_id"]].encode()) for r in rows)
