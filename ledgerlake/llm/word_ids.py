"""Token ids of whole texts, remembered by word.

For a tokenizer whose pre-tokenizer drops white space, the ids of a text are the ids of its
words one after another, because no token, normalisation step or special token spans an ASCII
white space character. A worker therefore keeps the ids of the words it has met, in lower case
(ASCII letters) unless they may hold a special string, which is matched as it is written; new words are cut into pre-tokens and only new pre-tokens go to the library. Tokenizers for which that does
not hold encode whole texts with the library.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable

import numpy as np

from ledgerlake.llm import common

#: Words a worker remembers in each of two generations, and their bytes with those of their ids;
#: pre-tokens it remembers before it starts anew.
WORDS, WORD_BYTES, PRETOKENS = 400_000, 12_000_000, 200_000
#: Text bytes handed to the library at once when whole texts are encoded.
ENCODE_BYTES = 1 << 18

#: Characters whose normalised form is their lower case alone and which the split pattern
#: treats one way only. Words with others (apostrophes, marks, other scripts) are encoded whole.
PLAIN = re.compile(r"[!-&(-;=-~À-ÖØ-öø-ÿ<]+\Z")
PRETOKEN = re.compile(r"[a-zß-öø-ÿ]+|[0-9]|[^0-9a-zß-öø-ÿ]+")
#: The split of tokenizers whose plain words ``PRETOKEN`` cuts the same way (fixed value).
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def load_tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def separable(path: str) -> bool:
    """True if texts may be encoded word by word (see the module's docstring)."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    steps = (spec.get("normalizer") or {}).get("normalizers", [])
    pre = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [{}])
    added = spec.get("added_tokens", [])
    return (
        [s["type"] for s in steps] == ["NFC", "Replace", "Lowercase"]
        and pre[0].get("type") == "Split"
        and pre[0].get("pattern") == {"Regex": SPLIT}
        and pre[0].get("invert") is True
        and pre[0].get("behavior") == "Removed"
        and not any(t["lstrip"] or t["rstrip"] or t["normalized"] or re.search(r"\s", t["content"]) for t in added)
        and all(t["content"].startswith("<|") for t in added)
    )


def words_of(text: bytes) -> list[bytes]:
    """The words of a text; those without the start of a special string (``separable``) in lower case."""
    if b"<|" not in text:
        return text.lower().split()
    return [w if b"<|" in w else w.lower() for w in text.split()]


class WordIds:
    """Ids of texts given as UTF-8 bytes, as little-endian unsigned 32-bit bytes.

    What a worker remembers is kept in two generations: once the newer is full it becomes the
    older, so words that keep coming back stay known.
    """

    def __init__(self, path: str) -> None:
        self.library = load_tokenizer(path)
        self.by_word = separable(path)
        self.words: dict[bytes, bytes] = {}
        self.held = 0
        self.older_words: dict[bytes, bytes] = {}
        self.pretokens: dict[str, bytes] = {}
        if self.by_word:
            vocabulary = self.library.get_vocab()
            self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
            self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True

    def _library(self, texts: list[str]) -> list[bytes]:
        got = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype="<u4").tobytes() for e in got]

    def _pretokens(self, parts: list[str]) -> list[bytes]:
        """Ids of pre-tokens, encoded as one text and cut where a token ends a pre-token."""
        ids = np.array(self.library.encode_batch_fast([" ".join(parts)], add_special_tokens=False)[0].ids, "<u4")
        cuts = (np.flatnonzero(self.ends[ids]) + 1) * 4
        if len(cuts) != len(parts):
            return self._library(parts)
        raw, cuts = ids.tobytes(), cuts.tolist()
        return [raw[a:b] for a, b in zip([0, *cuts], cuts)]

    def _learn(self, words: set[bytes]) -> None:
        old = words & self.older_words.keys()
        self.words.update((w, self.older_words[w]) for w in old)
        cut: dict[bytes, list[str]] = {}
        whole: list[bytes] = []
        for w in words - old:
            s = w.decode("utf-8", "replace")
            if s.isascii() and s.isalpha():
                cut[w] = [s]
            elif PLAIN.match(s) and "<|" not in s:
                cut[w] = PRETOKEN.findall(s.lower())
            else:
                whole.append(w)
        if len(self.pretokens) > PRETOKENS:
            self.pretokens.clear()
        new = list({p for parts in cut.values() for p in parts}.difference(self.pretokens))
        fresh: dict[str, bytes] = {}
        for i in range(0, len(new), 2048):
            some = new[i : i + 2048]
            fresh.update(zip(some, self._pretokens(some)))
        # A word that is one pre-token is remembered as a word alone.
        parts = {x for p in cut.values() if len(p) > 1 for x in p}
        self.pretokens.update((x, fresh[x]) for x in parts & fresh.keys())
        ids = fresh | {x: self.pretokens[x] for p in cut.values() for x in p if x not in fresh}
        self.words.update((w, ids[p[0]] if len(p) == 1 else b"".join([ids[x] for x in p])) for w, p in cut.items())
        for i in range(0, len(whole), 1024):
            some = whole[i : i + 1024]
            self.words.update(zip(some, self._library([w.decode("utf-8", "replace") for w in some])))

    def by_words(self, texts: list[bytes]) -> list[list[bytes]]:
        """The ids of every word of the texts (cut at ASCII white space), for tokenizers that are ``by_word``."""
        if len(self.words) > WORDS or self.held > WORD_BYTES:
            self.older_words, self.words, self.held = self.words, {}, 0
        cut = [words_of(t) for t in texts]
        new = set().union(*cut).difference(self.words)
        if new:
            self._learn(new)
            self.held += sum(map(len, new)) + sum(map(len, map(self.words.__getitem__, new)))
        get: Callable[[bytes], bytes] = self.words.__getitem__
        return [list(map(get, words)) for words in cut]

    def encode(self, texts: list[bytes]) -> list[bytes]:
        if not self.by_word:
            return [x for t in texts for x in self._library([t.decode("utf-8", "replace")])]
        return [b"".join(ids) for ids in self.by_words(texts)]


@common.remembered("word_ids")
def word_ids(path: str) -> WordIds:
    """One instance a worker process and tokenizer, so that tasks share what it remembers."""
    return WordIds(path)
