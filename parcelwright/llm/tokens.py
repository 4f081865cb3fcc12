"""Token ids of whole texts by public tokenizers: each distinct word of a slice of texts is encoded once."""

from __future__ import annotations

import os
import re
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Distinct words whose ids a task keeps; beyond, it starts anew.
KEPT_WORDS = 1 << 20
#: Words that are encoded in one string.
JOINED = 200
#: Bytes of text that are encoded together: the more, the fewer words are looked up twice.
SLICE_BYTES = 8 << 20


def vocabulary_file(vocabulary: str) -> str:
    """The place of a vocabulary on this machine: a path as given, a bare name from the installed collection."""
    if os.path.isabs(vocabulary):
        return vocabulary
    import public_tokenizers

    return public_tokenizers.path(vocabulary)


def gathered(first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Places first[i], first[i] + 1, ... of sizes[i] each, end to end."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(first - (ends - sizes), sizes) + np.arange(total)


class Kept:
    """Ids by key, kept end to end."""

    def __init__(self):
        self.place: dict[str, int] = {}
        self.ids, self.sizes = np.zeros(0, np.int32), np.zeros(0, np.int64)
        self.first = self.sizes

    def add(self, keys: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        self.place.update(zip(keys, range(len(self.place), len(self.place) + len(keys))))
        self.ids, self.sizes = np.concatenate([self.ids, ids.astype(np.int32)]), np.concatenate([self.sizes, sizes])
        self.first = np.cumsum(self.sizes) - self.sizes

    def find(self, keys: list[str]) -> np.ndarray:
        return np.fromiter(map(self.place.__getitem__, keys), np.int64, len(keys))

    def take(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of places, end to end, and how many each has."""
        sizes = self.sizes[places]
        return self.ids[gathered(self.first[places], sizes)], sizes


class WordIds:
    """Ids of a vocabulary with word ends that drops white space and lower-cases, so that words between blanks are encoded alone.

    Words are told apart by ASCII blanks, which end every token of such a vocabulary. Words of lower-case ASCII are cut where the
    vocabulary's pattern cuts them, and each part is encoded once; its last token is marked as a word end, which shows where
    ids of joined parts divide. All other words go through the tokenizer's own normalizer and pattern, joined, and are
    divided by the offsets of their tokens. Words that may hold a special token are encoded alone.
    """

    #: The vocabulary's pattern, over lower-case ASCII.
    PATTERN = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^ \t-\ra-z0-9]+")
    WORD_END = "</w>"

    def __init__(self, vocabulary: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, normalizers

        file = vocabulary_file(vocabulary)
        self.full, self.plain = Tokenizer.from_file(file), Tokenizer.from_file(file)
        self.plain.normalizer = normalizers.Sequence([])
        self.last = np.zeros(self.full.get_vocab_size(), bool)
        self.last[[i for token, i in self.full.get_vocab().items() if token.endswith(self.WORD_END)]] = True
        self.words, self.parts = Kept(), Kept()

    def _plain(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        cut = [[w] if w.isalpha() else self.PATTERN.findall(w) for w in words]
        flat = list(chain.from_iterable(cut))
        unseen = [p for p in dict.fromkeys(flat) if p not in self.parts.place]
        if unseen:
            found = self.plain.encode_batch_fast([" ".join(unseen[i : i + JOINED]) for i in range(0, len(unseen), JOINED)], add_special_tokens=False)
            ids = np.fromiter(chain.from_iterable(x.ids for x in found), np.int64)
            self.parts.add(unseen, ids, np.diff(np.flatnonzero(self.last[ids]) + 1, prepend=0))
        ids, sizes = self.parts.take(self.parts.find(flat))
        total = np.concatenate([[0], np.cumsum(sizes)])
        return ids, np.diff(total[np.cumsum([0, *map(len, cut)])])

    def _other(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        joined = [words[i : i + JOINED] for i in range(0, len(words), JOINED)]
        found = self.full.encode_batch([" ".join(j) for j in joined], add_special_tokens=False)
        sizes = [np.zeros(0, np.int64)]
        for j, x in zip(joined, found):
            ends = np.cumsum([len(w) + 1 for w in j])
            at = np.fromiter((a for a, _ in x.offsets), np.int64, len(x.ids))
            sizes.append(np.bincount(np.searchsorted(ends, at, "right"), minlength=len(j)))
        return np.fromiter(chain.from_iterable(x.ids for x in found), np.int64), np.concatenate(sizes)

    def _alone(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [x.ids for x in self.full.encode_batch_fast(words, add_special_tokens=False)]
        return np.fromiter(chain.from_iterable(found), np.int64), np.fromiter(map(len, found), np.int64)

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and how many each text has; null counts as empty."""
        if len(self.words.place) > KEPT_WORDS:
            self.words, self.parts = Kept(), Kept()
        text = pc.fill_null(column, "")
        text = pc.if_else(pc.match_substring(text, "<"), text, pc.ascii_lower(text))
        words = pc.ascii_split_whitespace(text)
        told = words.flatten().dictionary_encode()
        distinct = told.dictionary.to_numpy(zero_copy_only=False).tolist()
        unseen = [w for w in distinct if w not in self.words.place]
        kinds: dict = {self._plain: [], self._other: [], self._alone: []}
        for w in unseen:
            kinds[self._alone if "<" in w else self._plain if w.isascii() and w == w.lower() else self._other].append(w)
        for encode, group in kinds.items():
            if group:
                self.words.add(group, *encode(group))
        ids, sizes = self.words.take(self.words.find(distinct)[told.indices.to_numpy()])
        total = np.concatenate([[0], np.cumsum(sizes)])
        at = words.offsets.to_numpy().astype(np.int64)
        return ids, np.diff(total[at - at[0]])
