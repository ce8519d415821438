"""Token counts with overlap resynchronisation (operator 1).

Texts up to ``chunk_chars`` characters are encoded whole. Longer ones are encoded as chunks
that overlap, each with its tokens' offsets (or, where the tokenizer allows to encode word by word, with its
tokens' words' offsets, so that remembered words serve chunks as well). Two neighbouring chunks are spliced at a position
of their overlap that is proven to be a stable token boundary:

* a non-space character stands before it and a white space character at it. No token of the
  supported tokenizers spans such a position: their split patterns end a match there, and a
  ``.model`` file is refused unless its vocabulary has no piece with a space mark after another
  character;
* no token of either chunk reaches across it;
* the ``GUARD`` tokens before and after it agree, in ids and places, between the two chunks.

Where no position passes, the overlap is widened, up to the whole left chunk; a chunk without
any such position is itself doubled. A text without white space thus ends as one chunk.

Nulls and empty texts have 0 bytes and 0 tokens. Repeated rows each give a row. Other columns
of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm import common
from ledgerlake.llm.word_ids import WordIds, word_ids

TOKENIZER = "word_bpe_49k.json"
CHUNK_CHARS, OVERLAP_CHARS, GUARD = 16_384, 512, 4
#: Text characters encoded at once by a worker.
BATCH_CHARS = 1 << 20
SPACES = " \t\n\r"
#: The bytes that cut words, as ``bytes.split`` does.
_SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])

#: tokens of a text: ids, start and end characters
Tokens = tuple[np.ndarray, np.ndarray, np.ndarray]
Encode = Callable[[str], Tokens]


def _tokens(ids, starts, ends) -> Tokens:
    return np.asarray(ids, np.int64), np.asarray(starts, np.int64), np.asarray(ends, np.int64)


def _by_word(known: WordIds, text: str) -> Tokens:
    """Tokens of a text with the start and end of their words."""
    raw = text.encode("utf-8", "replace")
    got = known.by_words([raw])[0]
    data = np.frombuffer(raw, np.uint8)
    edges = np.flatnonzero(np.diff((~_SPACE[data]).view(np.int8), prepend=np.int8(0), append=np.int8(0)))
    chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    starts, ends = chars[edges].reshape(-1, 2).T
    counts = np.fromiter(map(len, got), np.int64, len(got)) // 4
    return _tokens(np.frombuffer(b"".join(got), "<u4"), np.repeat(starts, counts), np.repeat(ends, counts))


@common.remembered("word_ids")
def offset_encoder(path: str) -> Encode:
    """Encoder with character offsets for a ``.json`` (tokenizers) or ``.model`` (sentencepiece) file."""
    if path.endswith(".model"):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = (sp.id_to_piece(i) for i in range(sp.get_piece_size()))
        if any("▁" in p.lstrip("▁") for p in pieces):
            raise ValueError(f"{path}: pieces cross word starts, so chunks cannot be spliced")

        def encode(text: str) -> Tokens:
            got = sp.encode(text, return_type="proto").pieces
            raw = np.frombuffer(text.encode("utf-8"), np.uint8)
            chars = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])  # the library's offsets count bytes
            return _tokens([p.id for p in got], chars[[p.begin for p in got]], chars[[p.end for p in got]])

        return encode
    known = word_ids(path)
    if known.by_word:
        return lambda text: _by_word(known, text)
    library = known.library

    def encode(text: str) -> Tokens:
        got = library.encode(text, add_special_tokens=False)
        at = np.array(got.offsets, np.int64).reshape(-1, 2)
        return _tokens(got.ids, at[:, 0], at[:, 1])

    return encode


def _at(encode: Encode, text: str, start: int, end: int) -> Tokens:
    ids, starts, ends = encode(text[start:end])
    return ids, starts + start, ends + start


def common_boundary(text: str, left: Tokens, right: Tokens, start: int, end: int) -> int | None:
    """The stable boundary nearest to the middle of ``text[start:end]``, seen alike by both sides."""
    middle = (start + end) // 2
    spots = [p for p in range(start + 1, end) if text[p] in SPACES and not text[p - 1].isspace()]
    for p in sorted(spots, key=lambda p: abs(p - middle)):
        cuts = []
        for ids, starts, ends in (left, right):
            k = int(np.searchsorted(starts, p))
            if (k and ends[k - 1] > p) or k < GUARD or k + GUARD > len(ids):
                break
            cuts.append((ids[k - GUARD : k + GUARD], starts[k - GUARD : k + GUARD], ends[k - GUARD : k + GUARD]))
        if len(cuts) == 2 and all(np.array_equal(a, b) for a, b in zip(*cuts)):
            return p
    return None


def spliced(text: str, encode: Encode, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS) -> Iterator[np.ndarray]:
    """The ids of ``text``, run by run, equal to those of encoding it whole."""
    n, start, keep = len(text), 0, 0
    end = min(n, chunk)
    cur = _at(encode, text, start, end)
    while end < n:
        wide = overlap
        while True:
            s = max(start, end - wide)
            e = min(n, max(s + chunk, end + wide))
            nxt = _at(encode, text, s, e)
            at = common_boundary(text, cur, nxt, max(s, keep), end)
            if at is not None or s <= start:
                break
            wide *= 2
        if at is None:  # nowhere in this chunk: double it
            end = min(n, end + max(chunk, end - start))
            cur = _at(encode, text, start, end)
            continue
        ids, starts, _ = cur
        yield ids[np.searchsorted(starts, keep) : np.searchsorted(starts, at)]
        start, keep, end, cur = s, at, e, nxt
    yield cur[0][np.searchsorted(cur[1], keep) :]


def _count(path: str, chunk: int, overlap: int):
    @common.worker("word_ids")
    def run(batches):
        for batch in batches:
            raw = [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]
            counts = [0] * len(raw)
            short = []
            for i, t in enumerate(raw):
                if len(t) > chunk and len(s := t.decode("utf-8", "replace")) > chunk:
                    counts[i] = sum(map(len, spliced(s, offset_encoder(path), chunk, overlap)))
                else:
                    short.append(i)
            for some in common.slices(short, [len(raw[i]) for i in short], BATCH_CHARS):
                if path.endswith(".model"):
                    got = [len(offset_encoder(path)(raw[i].decode("utf-8", "replace"))[0]) for i in some]
                else:
                    got = [len(x) // 4 for x in word_ids(path).encode([raw[i] for i in some])]
                for i, c in zip(some, got):
                    counts[i] = c
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_bytes"), pa.array(counts, pa.int64())],
                ["doc_id", "n_bytes", "n_tokens"],
            )

    return run


def token_counts(
    docs: DataFrame,
    tokenizer: str | None = None,
    limit: int = 2048,
    chunk_chars: int = CHUNK_CHARS,
    overlap_chars: int = OVERLAP_CHARS,
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for every row of ``docs`` (``doc_id, text``).

    ``tokenizer`` is the path of a ``.json`` or ``.model`` file on every executor. One narrow
    pass over the two columns, no shuffle; a worker holds the offsets of one chunk at a time.
    """
    path = tokenizer or public_tokenizers.path(TOKENIZER)
    common.prepare_workers(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), "text")
    got = rows.mapInArrow(_count(path, chunk_chars, overlap_chars), f"doc_id {kind}, n_bytes long, n_tokens long")
    return got.withColumn("over_limit", F.col("n_tokens") > limit)


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(common.load(spark, sf_dir, "documents"))
