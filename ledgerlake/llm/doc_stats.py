"""Statistics of a whole text, the inputs of the quality rules and the quality classifier.

Words are runs of characters other than ASCII white space. Lines are cut at ``\\n``. Null and
empty texts have zeros throughout. Nothing depends on ids, labels, languages or sources.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Shares and logarithms; the models see these only.
FEATURES = (
    "log_words",
    "mean_word",
    "symbol_share",
    "dup_line_share",
    "repeat_share",
    "upper_share",
    "digit_share",
    "exclaim_share",
    "bar_share",
    "punct_share",
    "distinct_share",
    "top_word_share",
    "echo_share",
    "line_words",
    "foreign_share",
    "stop_share",
)
SYMBOLS = b"#*$%&|<>"
SPACE = b"\x20\x09\x0a\x0b\x0c\x0d"


def _mask(chars) -> np.ndarray:
    out = np.zeros(256)
    out[list(chars)] = 1
    return out


_BYTES = np.stack(
    [
        _mask(range(0x80, 0xC0)),  # continuation bytes
        _mask(SPACE),
        _mask(SYMBOLS),
        _mask(range(0x41, 0x5B)),
        _mask([*range(0x41, 0x5B), *range(0x61, 0x7B)]),
        _mask(b"0123456789"),
        _mask(b"!"),
        _mask(b"|"),
        _mask(b".,;:!?\"'()-"),
        _mask(range(0xC0, 0x100)),
        _mask(b"."),
    ],
    axis=1,
)


def _repeats(words: list[bytes]) -> tuple[int, int, int, int]:
    """Words in repeated 3-word windows; distinct words; copies of the commonest; echoes of the word before."""
    n = len(words)
    codes: dict[bytes, int] = {}
    seq = np.array([codes.setdefault(w, len(codes)) for w in words], np.int64)
    top = int(np.bincount(seq).max()) if n else 0
    echoes = int((seq[1:] == seq[:-1]).sum()) if n else 0
    if n < 3:
        return 0, len(codes), top, echoes
    k = len(codes)
    pairs = seq[:-1] * k + seq[1:]
    if k >= 1 << 20:  # keep the window's code within 64 bits
        pairs = np.unique(pairs, return_inverse=True)[1]
    windows = pairs[:-1] * k + seq[2:]
    order = np.argsort(windows, kind="stable")
    same = windows[order[1:]] == windows[order[:-1]]
    if not same.any():
        return 0, k, top, echoes
    hit = np.zeros(n, bool)
    for at in (order[1:][same], order[:-1][same]):
        hit[at] = hit[at + 1] = hit[at + 2] = True
    return int(hit.sum()), k, top, echoes


def stats(raw: bytes) -> tuple[tuple[int, ...], tuple[float, ...]]:
    """The ``BASE`` numbers and the ``FEATURES`` of one text given as UTF-8."""
    words = raw.split()
    n = len(words)
    if not n:
        return (0, 0, 0, 0, 0), (0.0,) * len(FEATURES)
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256) @ _BYTES
    cont, space, symbols, upper, letters, digits, exclaim, bars, punct, foreign, stops = counts.tolist()
    chars = len(raw) - int(cont) - int(space)
    lines = [x for x in raw.split(b"\n") if x and not x.isspace()]
    dup = len(lines) - len(set(lines))
    repeated, distinct, top, echoes = _repeats(words)
    one = max(chars, 1)
    return (n, chars, int(symbols), dup, repeated), (
        float(np.log1p(n)),
        chars / n,
        symbols / one,
        dup / max(len(lines), 1),
        repeated / n,
        upper / max(letters, 1),
        digits / one,
        exclaim / one,
        bars / one,
        punct / one,
        float(np.log1p(distinct) / np.log1p(n)),
        top / n,
        echoes / n,
        float(np.log1p(n / max(len(lines), 1))),
        foreign / one,
        stops / n,
    )


def batch_stats(batch: pa.RecordBatch, column: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """``BASE`` (integers) and ``FEATURES`` (doubles) of every row of a batch."""
    got = [stats(t or b"") for t in batch.column(column).cast(pa.binary()).to_pylist()]
    base = np.array([g[0] for g in got], np.int64).reshape(-1, len(BASE))
    return base, np.array([g[1] for g in got], np.float64).reshape(-1, len(FEATURES))
