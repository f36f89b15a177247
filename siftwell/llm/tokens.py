"""Token ids and their numbers by public tokenizers, put together from cached ids of words."""

from __future__ import annotations

import base64
import json
import os
import re
import struct
import unicodedata
from itertools import islice

import numpy as np

#: White space other than blanks and line feeds.
_SPACES = ("\t", "\r", "\x0b", "\x0c", "\x1c", "\x1d", "\x1e", "\x1f", "\x85", "\xa0", "\u1680", *map(chr, range(0x2000, 0x200B)), "\u2028", "\u2029", "\u202f", "\u205f", "\u3000")
#: Characters whose white space, case or composition may be taken differently, and the mark of special tokens.
_ODD = ("<|", *_SPACES[4:], "\u0130", "\u03a3", "\u180e", "\u200b", "\u200c", "\u200d", "\u2060", "\ufeff")
#: A word between other signs. An apostrophe may begin an ending of its own, so chunks with one are left to the tokenizer.
_AROUND = re.compile(r"([!-&(-/:-@\[-`{-~]*)(\w*)([!-&(-/:-@\[-`{-~]*)")
#: Chunks that a worker remembers; beyond, it forgets the later half.
CACHE_CHUNKS = 600_000
#: Longer chunks are encoded but not remembered.
CACHE_CHARS = 64
#: Words that the tokenizer gets at once.
BATCH_WORDS = 4000

_made: dict[str, ChunkEncoder | RankCounter] = {}


def tokenizer_path(name: str) -> str:
    """Where a public tokenizer's file is on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _forget(cache: dict) -> None:
    if len(cache) > CACHE_CHUNKS:
        for c in list(islice(cache, CACHE_CHUNKS // 2, None)):
            del cache[c]


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if it prints, else the next one from U+0100 on."""
    printed = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in printed]
    return {b: chr(b) for b in printed} | {b: chr(256 + k) for k, b in enumerate(other)}


class ChunkEncoder:
    """Encodes texts to packed little-endian 32-bit ids, exactly as the tokenizer of the file does.

    For a tokenizer that lower-cases and whose pieces never reach across white space, the ids of a text
    are those of its chunks, and those of a chunk the ids of the signs before its word, the word, and the
    signs after it. Other tokenizers, and texts with unusual characters or marks of special tokens, go
    to the tokenizer whole.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            said = json.load(file)
        kinds = [x.get("type") for x in (said.get("normalizer") or {}).get("normalizers", [])]
        self.by_word = said["model"].get("end_of_word_suffix") == "</w>" and kinds == ["NFC", "Replace", "Lowercase"]
        self.letters = _byte_letters()
        self.cache: dict[str, bytes] = {}

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(x.ids, dtype="<u4").tobytes() for x in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def _word(self, word: str, known: dict[str, bytes]) -> bytes:
        """Ids of a lower-case word of letters, by the model alone: such a word is one piece."""
        got = self.cache.get(word) or known.get(word)
        if got is None:
            if word.isascii():
                seen = word
            elif unicodedata.is_normalized("NFC", word):
                seen = word.encode().decode("latin-1").translate(self.letters)
            else:
                return self._whole([word])[0]
            ids = [t.id for t in self.tokenizer.model.tokenize(seen)]
            known[word] = got = struct.pack(f"<{len(ids)}I", *ids)
        return got

    def _learn(self, chunks: set[str]) -> dict[str, bytes]:
        """Ids of chunks that the cache lacks."""
        known: dict[str, bytes] = {}
        split, signs, rest = [], set(), []
        for c in chunks:
            if c.isalpha():
                known[c] = self._word(c, known)
            elif (m := _AROUND.fullmatch(c)) and (not m[2] or m[2].isalpha()):
                split.append((c, *m.groups()))
                signs.update(x for x in (m[1], m[3]) if x and x not in self.cache)
            else:
                rest.append(c)
        signs = list(signs)
        known.update(zip(signs, self._whole(signs), strict=True) if signs else ())
        known.update(zip(rest, self._whole(rest), strict=True) if rest else ())
        cache = self.cache
        for c, before, word, after in split:
            parts = [known[x] if x in known else cache[x] for x in (before, after) if x]
            if word:
                parts.insert(1 if before else 0, self._word(word, known))
            known[c] = b"".join(parts)
        return known

    def encode(self, texts: list[str]) -> list[bytes]:
        if not self.by_word:
            return self._whole(texts)
        cache = self.cache
        _forget(cache)
        out, lacking, missing = [b""] * len(texts), [], set()
        for i, text in enumerate(texts):
            if any(map(text.__contains__, _ODD)):
                out[i] = self._whole([text])[0]
                continue
            chunks = text.lower().split()
            ids = list(map(cache.get, chunks))
            if None in ids:
                lacking.append((i, chunks, ids))
                missing.update(c for c, x in zip(chunks, ids, strict=True) if x is None)
            else:
                out[i] = b"".join(ids)
        new = self._learn(missing)
        for i, chunks, ids in lacking:
            out[i] = b"".join([new[c] if x is None else x for c, x in zip(chunks, ids, strict=True)])
        cache.update((c, x) for c, x in new.items() if len(c) <= CACHE_CHARS)
        return out

    def counts(self, texts: list[str]) -> list[int]:
        return [len(x) // 4 for x in self.encode(texts)]


class RankCounter:
    """Counts the ids of texts by a byte-level vocabulary given as ranks, exactly as its tokenizer would.

    Its pieces never reach across white space but for one blank before a word, so where blanks and line feeds
    stand alone a text's ids are those of its words, each with the blank before it, and one for each line
    feed. Texts with other white space go to the tokenizer whole.
    """

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self.tokenizer = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.feed = len(self.tokenizer.encode_ordinary("\n"))
        self.first: dict[str, int] = {}
        self.later: dict[str, int] = {}

    def _number(self, text: str) -> int:
        return len(self.tokenizer.encode_ordinary(text))

    def _sum(self, words: list[str], cache: dict[str, int], before: str) -> int:
        found = list(map(cache.get, words))
        if None in found:
            for k, n in enumerate(found):
                if n is None:
                    word = words[k]
                    found[k] = n = cache.get(word) or self._number(before + word)
                    if len(word) <= CACHE_CHARS:
                        cache[word] = n
        return sum(found)

    def counts(self, texts: list[str]) -> list[int]:
        for cache in (self.first, self.later):
            _forget(cache)
        out = []
        for text in texts:
            if not text or text[0] in " \n" or text[-1] in " \n" or any(map(text.__contains__, ("  ", " \n", "\n ", "\n\n", *_SPACES))):
                out.append(self._number(text))
                continue
            heads, later, lines = [], [], text.split("\n")
            for line in lines:
                head, *rest = line.split(" ")
                heads.append(head)
                later += rest
            out.append(self._sum(heads, self.first, "") + self._sum(later, self.later, " ") + self.feed * (len(lines) - 1))
        return out


def encoder(path: str) -> ChunkEncoder:
    """One encoder for each worker and file."""
    if path not in _made:
        _made[path] = ChunkEncoder(path)
    return _made[path]


def counter(path: str) -> ChunkEncoder | RankCounter:
    """What counts ids by a file of either kind, once for each worker."""
    if path not in _made and path.endswith(".tiktoken"):
        _made[path] = RankCounter(path)
    return _made[path] if path in _made else encoder(path)
