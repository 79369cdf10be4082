"""Byte-pair vocabularies in the JSON format of the tokenizers library."""

from __future__ import annotations

import functools
import json
import re
import unicodedata
from collections.abc import Callable, Iterable

import numpy as np
import regex
from tokenizers import Tokenizer

#: The splitting patterns of the two vocabulary kinds.
BYTE_LEVEL = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
WORD_LEVEL = r"""'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"""

#: Python counts these as white space, the vocabularies don't.
SEPARATORS = re.compile("[\x1c-\x1f]")
CHUNK = re.compile(r"\s*\S+|\s+")
#: Characters whose class and case are the same in every library's tables; what holds
#: others is split by the vocabulary's own library.
SETTLED = re.compile(
    "[\t\n\r -~\u00a1-\u00ac\u00ae-\u012f\u0131-\u024f\u0386\u0388-\u038a\u038c\u038e-\u03a1\u03a3-\u03ff\u0400-\u0481\u048a-\u052f"
    "\u2010-\u2027\u2030-\u205e\u3041-\u3096\u30a1-\u30fa\u4e00-\u9fef\uac00-\ud7a3]*"
)


def byte_characters() -> list[str]:
    """The character that stands for each byte: itself if printable, else one from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


class Vocabulary:
    """Token ids, merge ranks and text splitting of one vocabulary file."""

    def __init__(self, path: str):
        self.path = path
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        ids: dict[str, int] = model["vocab"]
        self.suffix: str = model.get("end_of_word_suffix") or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self._special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.lower = spec.get("normalizer") is not None
        self.words = regex.compile(WORD_LEVEL if self.suffix else BYTE_LEVEL)
        chars = byte_characters()
        self.byte_ids = np.array([ids[c] for c in chars], np.int64)
        self.last_ids = np.array([ids[c + self.suffix] for c in chars], np.int64)
        self.size = max(*ids.values(), *self.special.values()) + 1
        pairs = [(ids[a] * self.size + ids[b], ids[a + b]) for a, b in (m if isinstance(m, list) else m.split(" ") for m in model["merges"])]
        self.made = np.array([new for _, new in pairs], np.int64)  # by rank
        self.made_list: list[int] = self.made.tolist()
        self.rank = {key: r for r, (key, _) in reversed(list(enumerate(pairs)))}
        keys = np.array(list(self.rank), np.int64)
        order = np.argsort(keys)
        self._keys, self._ranks = keys[order], np.array(list(self.rank.values()), np.int64)[order]
        of_char = self._of_char = {c: b for b, c in enumerate(chars)}
        self.token_bytes: list[bytes] = [b""] * self.size
        for token, i in ids.items():
            body = token.removesuffix(self.suffix) if self.suffix else token
            self.token_bytes[i] = bytes(of_char[c] for c in body) + (b" " if body != token else b"")
        for token, i in self.special.items():
            self.token_bytes[i] = token.encode()

    def ranks(self, left: np.ndarray, right: np.ndarray, none: int) -> np.ndarray:
        """Merge rank of each pair of ids, ``none`` where the pair doesn't merge."""
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self._keys, key), len(self._keys) - 1)
        return np.where(self._keys[at] == key, self._ranks[at], none)

    def symbols(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words' single bytes before any merge, one after the other, and where each word ends."""
        raw = [w.encode() for w in words]
        ends = np.cumsum([len(r) for r in raw], dtype=np.int64)
        flat = np.frombuffer(b"".join(raw), np.uint8)
        out = self.byte_ids[flat]
        if self.suffix and len(out):
            out[ends - 1] = self.last_ids[flat[ends - 1]]
        return out, ends

    def parts(self, text: str) -> list[str | int]:
        """The text between special tokens, and the ids of those."""
        if not self._special:
            return [text]
        return [self.special.get(p, p) for p in self._special.split(text) if p]

    def chunks(self, text: str) -> list[str]:
        """Pieces of a part whose words don't depend on what stands around them."""
        if SEPARATORS.search(text):
            return self.library_words(text)
        if not self.lower:
            return CHUNK.findall(text)
        if text.isascii() or SETTLED.fullmatch(text):
            return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower().split()
        out = []
        for c in text.split():
            if c.isascii() or SETTLED.fullmatch(c):
                out.append(unicodedata.normalize("NFC", c).replace("Σ", "σ").lower())
            else:
                out += self.library_words(c)
        return out

    @functools.cached_property
    def _library(self) -> Tokenizer:
        return Tokenizer.from_file(self.path)

    def library_words(self, text: str, normalize: bool = True) -> list[str]:
        """Words as the vocabulary's own library normalizes and splits them."""
        if normalize and self._library.normalizer:
            text = self._library.normalizer.normalize_str(text)
        return [bytes(self._of_char[c] for c in w).decode() for w, _ in self._library.pre_tokenizer.pre_tokenize_str(text)]

    def words_of(self, chunk: str) -> list[str]:
        if chunk.isascii() or SETTLED.fullmatch(chunk):
            plain = chunk.isalpha() or chunk[:1] == " " and chunk[1:].isalpha()
            return [chunk] if plain else self.words.findall(chunk)
        return self.library_words(chunk, normalize=False)  # chunks() has done that


@functools.lru_cache(maxsize=4)
def load(path: str) -> Vocabulary:
    return Vocabulary(path)


class Recent:
    """What was made before, ``limit`` entries or somewhat more; when ``now`` is half of that, what ``before`` has that wasn't used since is forgotten.

    So a worker's memory doesn't grow with its input, and what is met often stays.
    """

    def __init__(self, limit: int):
        self.limit = limit
        self.now: dict = {}
        self.before: dict = {}

    def turn(self) -> None:
        if 2 * len(self.now) > self.limit:
            self.now, self.before = {}, self.now

    def forgotten(self, keys: Iterable) -> list:
        """Those of ``keys`` that have to be made; ``now`` gets the others."""
        out = []
        for key in keys:
            value = self.before.get(key)
            if value is None:
                out.append(key)
            else:
                self.now[key] = value
        return out


class ByWord:
    """What ``make`` gives for words (it gets those that are new, all at once), joined by chunk.

    ``join`` makes a chunk's value from its words' values, ``special`` that of a
    special token. A chunk is a word or more that nothing around it can change.
    """

    def __init__(self, vocabulary: Vocabulary, make: Callable[[list[str]], list], join: Callable[[list], object], special: Callable[[int], object], limit: int = 300_000):
        self.vocabulary, self.make, self.join, self.special = vocabulary, make, join, special
        self.chunks, self.words = Recent(limit), Recent(limit // 2)

    def of(self, texts: list[str]) -> list[list]:
        """For each text, what belongs to its chunks, in order."""
        self.chunks.turn()
        self.words.turn()
        v, chunks, words = self.vocabulary, self.chunks.now, self.words.now
        split = []
        for text in texts:
            parts = v.parts(text)
            if len(parts) == 1 and isinstance(parts[0], str):
                split.append(v.chunks(parts[0]))
            else:
                split.append([x for p in parts for x in ([p] if isinstance(p, int) else v.chunks(p))])
        for i in v.special.values():
            chunks[i] = self.special(i)
        out, holes, missing = [list(map(chunks.get, c)) for c in split], [], set()
        for c, made in zip(split, out, strict=True):
            k, at = -1, []
            try:
                while True:
                    k = made.index(None, k + 1)
                    at.append(k)
            except ValueError:  # no more
                pass
            if at:
                holes.append((c, made, at))
                missing.update(map(c.__getitem__, at))
        several, seen = {}, set()
        for c in self.chunks.forgotten(missing):
            of = v.words_of(c)
            if len(of) == 1 and of[0] is c:
                seen.add(c)
            else:
                several[c] = tuple(of)  # of strings only: the collector passes it over
        unseen = self.words.forgotten(w for w in seen.union(*several.values()) if w not in words)
        words.update(zip(unseen, self.make(unseen), strict=True))
        for c in seen:
            chunks[c] = words[c]
        for c, of in several.items():
            chunks[c] = words[of[0]] if len(of) == 1 else self.join([words[w] for w in of])
        for c, made, at in holes:
            for k in at:
                made[k] = chunks[c[k]]
        return out
