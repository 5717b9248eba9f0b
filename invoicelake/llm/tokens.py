"""Token ids of whole texts, by a public tokenizer file and its own library, once per distinct piece.

A text is cut only where the tokenizer itself always cuts, so encoding the pieces one by one gives the ids of the
whole text. A task numbers the pieces it meets and keeps their ids in one array, from which those of texts are taken;
unseen pieces go to the library in rows of many.
"""

from __future__ import annotations

import os
import re
import sys
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np

# a space before one more white space, or at the end: there the plain split at spaces is not safe
_LOOSE = re.compile(r" (?=[\s\x1c-\x1f\x85]|\Z)|\x01")
# the same for ASCII text, which is searched for strings faster than for classes of characters
_LOOSE_ASCII = [f" {c}" for c in " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f"] + ["\x01"]
_SAFE_SPACE = re.compile(r" (?=\w)")
_ANY_SPACE = re.compile(r"[ \n](?=\w)")
# the tokenizers also cut between a letter or digit and one of these marks, and around a lone line break; letters
# beyond Latin-1 are left out, as some become a letter and a mark when they are normalised
_PUNCTUATION = re.compile(r"[.,;:!?](?<=[A-Za-z0-9\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff].)")
_LINE_BREAK = re.compile(r"\n(?<=\S\n)(?=[^\W_])")

SEGMENT_CHARS = 1_000_000    # longer texts are worked on in segments of about this many characters
CACHED_BYTES = 100_000_000   # once a task remembers more, it keeps the half of the pieces that it met most
CACHED_CHARS = 64            # longer pieces are not remembered: text without spaces is one piece
ENTRY_BYTES = 110            # of a dictionary, its number and what is kept by number
LEARNT_TOGETHER = 200        # unseen pieces in one text for the library


def _is_loose(text: str) -> bool:
    if text.isascii():
        return text.endswith(" ") or any(map(text.__contains__, _LOOSE_ASCII))
    return _LOOSE.search(text) is not None


class _Numbers(dict):
    """Numbers of pieces in the order they were met; ``unseen`` holds those whose ids are not known yet."""

    def __init__(self):
        super().__init__()
        self.given, self.unseen = 0, []

    def __missing__(self, key: str) -> int:
        self[key] = number = self.given
        self.given += 1
        self.unseen.append(key)
        return number


class PieceEncoder:
    """Ids (little-endian unsigned 32-bit) of texts, without added special tokens.

    ``drops_space`` says that the tokenizer drops white space and case, and marks word ends; otherwise it is a
    byte-level tokenizer whose pieces take the one space before them along. Special strings inside a text are
    handled as the library handles them by default. A missing text has no ids.
    """

    def __init__(self, path: str, drops_space: bool, cached_bytes: int | None = None):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.library = Tokenizer.from_file(path)
        self.drops_space, self.cached_bytes = drops_space, cached_bytes or CACHED_BYTES
        vocabulary = self.library.get_vocab(with_added_tokens=True)
        self.n_bytes = np.zeros(max(vocabulary.values()) + 1, np.int64)   # of a byte-level token
        self.ends_word = np.zeros(len(self.n_bytes), bool)
        for token, i in vocabulary.items():
            self.n_bytes[i], self.ends_word[i] = len(token), token.endswith("</w>")
        self._forget()

    def _forget(self) -> None:
        self.known = _Numbers()
        self.held = 0       # bytes
        # ids of all pieces, and by number where those of a piece begin, how many they are and how often it was met
        self.ids, self.begins, self.sizes, self.met = array("I"), array("q"), array("q"), np.empty(0, np.int64)

    def _segments(self, text: str) -> Iterator[tuple[str, bool]]:
        """Parts of a text, and whether the space before the part was cut off."""
        begin, cut = 0, _ANY_SPACE if self.drops_space else _SAFE_SPACE
        while len(text) - begin > SEGMENT_CHARS:
            found = cut.search(text, begin + SEGMENT_CHARS)
            if not found:
                break
            yield text[begin:found.start()], begin > 0
            begin = found.end()
        yield text[begin:] if begin else text, begin > 0

    def _pieces(self, text: str, continued: bool) -> list[str]:
        """Keys of the pieces. For a byte-level tokenizer, a key stands for a space and itself, or, if it starts
        with a space or with the character 1, for what follows that."""
        if self.drops_space:
            try:
                text.encode("latin-1")
                text = text.lower()      # here Python's lower case is the tokenizer's
            except UnicodeEncodeError:
                pass
            return _PUNCTUATION.sub(r" \g<0>", text).replace("\n", " ").split(" ")
        if _is_loose(text):
            parts = _SAFE_SPACE.split(text)
        else:
            text = _PUNCTUATION.sub(" \x01\\g<0>", text)
            parts = _LINE_BREAK.sub(" \x01\n \x01", text).split(" ")
        if not continued:
            parts[0] = " " + parts[0]
        return parts

    def _spelled(self, key: str) -> str:
        if self.drops_space:
            return key
        return key[1:] if key[:1] in (" ", "\x01") else " " + key

    def _joinable(self, key: str) -> bool:
        """Whether the library cuts before and after the piece in a row of such pieces."""
        if self.drops_space:
            return key.isascii() and key.isalpha()
        return key[0] not in " \x01" and "<|" not in key

    def _learn(self, keys: list[str]) -> None:
        """Appends the ids of the pieces, which have the next numbers."""
        found = np.empty((2, len(keys)), np.int64)
        together, alone = [], []
        for i, key in enumerate(keys):
            (together if key and self._joinable(key) else alone).append(i)
        groups = [together[i:i + LEARNT_TOGETHER] for i in range(0, len(together), LEARNT_TOGETHER)]
        for at in range(0, len(groups), 100):
            self._learn_rows(keys, groups[at:at + 100], found)
        for at in range(0, len(alone), 10_000):
            part = alone[at:at + 10_000]
            rows = self.library.encode_batch_fast([self._spelled(keys[i]) for i in part], add_special_tokens=False)
            for i, row in zip(part, rows):
                found[:, i] = len(self.ids), len(row)
                self.ids.extend(row.ids)
        self.begins.frombytes(found[0].tobytes())
        self.sizes.frombytes(found[1].tobytes())

    def _learn_rows(self, keys: list[str], groups: list[list[int]], found: np.ndarray) -> None:
        words = [[keys[i] for i in g] for g in groups]
        rows = [" ".join(w) if self.drops_space else " " + " ".join(w) for w in words]
        for places, parts, text, row in zip(
                groups, words, rows, self.library.encode_batch_fast(rows, add_special_tokens=False)):
            ids = np.array(row.ids, np.uint32)
            if self.drops_space:
                ends = np.flatnonzero(self.ends_word[ids]) + 1
                whole = len(ends) == len(parts)
            else:
                reached = np.cumsum(self.n_bytes[ids])
                sizes = map(len, parts) if text.isascii() else (len(p.encode()) for p in parts)
                wanted = np.cumsum(np.fromiter(sizes, np.int64, len(parts)) + 1)
                ends = np.searchsorted(reached, wanted) + 1
                whole = ends[-1] == len(ids) and bool((reached[ends - 1] == wanted).all())
            if not whole:
                raise RuntimeError("the tokenizer does not cut at spaces as expected")
            begins = np.append(0, ends[:-1])
            found[:, places] = begins + len(self.ids), ends - begins
            self.ids.frombytes(ids.tobytes())

    def encode(self, texts: list[str | None]) -> list[bytes]:
        long = [i for i, t in enumerate(texts) if t and len(t) > SEGMENT_CHARS]
        out = self._encode([self._pieces(t, False) if t and len(t) <= SEGMENT_CHARS else [] for t in texts])
        for i in long:
            out[i] = b"".join(self._encode([self._pieces(*s)])[0] for s in self._segments(texts[i]))
        return out

    def _encode(self, cut: list[list[str]]) -> list[bytes]:
        """Ids of rows of pieces."""
        ends = np.cumsum([0, *map(len, cut)])
        numbers = np.fromiter(map(self.known.__getitem__, chain.from_iterable(cut)), np.int64, ends[-1])
        unseen, self.known.unseen = self.known.unseen, []
        try:
            self._learn(unseen)
        except BaseException:
            self._forget()
            raise
        found, reached = self._ids_of(numbers)
        raw = found.astype("<u4", copy=False).tobytes()
        self.met = np.bincount(numbers, minlength=self.known.given) + np.pad(self.met, (0, len(unseen)))
        self._remember(unseen)
        ends = (4 * reached[ends]).tolist()
        return [raw[i:j] for i, j in zip(ends, ends[1:])]

    def _ids_of(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the pieces, one after the other, and where those of each begin, with the end."""
        sizes = np.frombuffer(self.sizes, np.int64)[numbers]
        reached = np.cumsum(np.append(0, sizes))
        # a run of places in the array of ids for every piece, from where its own begin
        places = np.repeat(np.frombuffer(self.begins, np.int64)[numbers] - reached[:-1], sizes) + np.arange(reached[-1])
        return np.frombuffer(self.ids, np.uint32)[places], reached

    def _remember(self, learnt: list[str]) -> None:
        long = [key for key in learnt if len(key) > CACHED_CHARS]
        for key in long:
            del self.known[key]
        self.held += sum(map(sys.getsizeof, learnt)) - sum(map(sys.getsizeof, long)) + ENTRY_BYTES * len(learnt)
        if self.held + 4 * len(self.ids) > self.cached_bytes:
            self._keep_half()

    def _keep_half(self) -> None:
        """Forgets all but the half of the pieces that were met most, if they were met again."""
        keys, numbers, met = list(self.known), np.fromiter(self.known.values(), np.int64, len(self.known)), self.met
        most = np.argsort(-met[numbers], kind="stable")[:len(keys) // 2]
        most = most[met[numbers[most]] > 1]
        ids, reached = self._ids_of(numbers[most])
        self._forget()
        if 4 * len(ids) + ENTRY_BYTES * len(most) + sum(sys.getsizeof(keys[i]) for i in most.tolist()) > self.cached_bytes // 2:
            return
        for i in most.tolist():
            self.held += sys.getsizeof(keys[i]) + ENTRY_BYTES
            self.known[keys[i]]     # the next number
        self.known.unseen = []
        self.ids.frombytes(ids.tobytes())
        self.begins.frombytes(reached[:-1].tobytes())
        self.sizes.frombytes(np.diff(reached).tobytes())
        self.met = met[numbers[most]] // 2      # so that what was met long ago gives way


@lru_cache(maxsize=4)
def encoder(path: str, drops_space: bool, cached_bytes: int | None = None) -> PieceEncoder:
    """One encoder per Python worker and file. It takes about 80 MB and up to three times ``cached_bytes`` at its peak."""
    return PieceEncoder(path, drops_space, cached_bytes)


def by_size(texts: list[str | None], limit: int = 2_000_000) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of texts of about ``limit`` characters each; a longer text has a range of its own."""
    begin = size = 0
    for i, text in enumerate(texts):
        n = len(text) if text else 0
        if i > begin and size + n > limit:
            yield begin, i
            begin, size = i, 0
        size += n
    if begin < len(texts):
        yield begin, len(texts)
