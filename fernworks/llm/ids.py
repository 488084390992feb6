"""Token ids of texts, word by word: a word that came up lately is looked up, others are encoded many in one call.

For tokenizers whose ids don't depend on the white space between words (see `bpe.splits_at_spaces`). Where, by the
tokenizer's own answers, a word of Latin letters is a unit by itself and the last piece of a unit has an ending of its
own, words of letters are encoded joined by spaces, and the endings tell where each one stops; punctuation after a
letter is set off by a space first, so that most words are of letters. All others, and those that hold a special
string, are encoded alone. A worker holds a bounded number of words, whatever the corpus.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from . import words as W
from .bpe import splits_at_spaces, tokenizer

#: Words that a worker holds, words whose ids are gathered at once, words of a joined text.
HELD_WORDS, SLICE, JOINED = 1 << 19, 1 << 20, 128
#: Letters of Latin-1: neither normalising nor another version of Unicode changes them but for their case.
LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"


class Ids:
    def __init__(self, path: str, held: int = HELD_WORDS):
        if not splits_at_spaces(path):
            raise ValueError(f"{path}: its ids depend on what stands between words")
        self.tokenizer, self.held = tokenizer(path), held
        said = json.loads(self.tokenizer.to_str())
        ending, added = said["model"].get("end_of_word_suffix"), [t["content"] for t in said["added_tokens"]]
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.last = np.zeros(max(vocabulary.values(), default=-1) + 1, bool)
        for piece, i in vocabulary.items():
            self.last[i] = bool(ending) and piece.endswith(ending)
        self.is_letters = re.compile(f"[{LETTERS}]+").fullmatch
        letters = [c for c in map(chr, range(256)) if self.is_letters(c)]
        signs = [c for c in "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~" if not any(c in a for a in added)]
        units = lambda s: int(self.last[self._encode([s])[0]].sum())
        self.set_off = None
        self.joins = bool(ending) and all(a and not self.is_letters(a) for a in added) and all(units(w) == 1 for w in (*letters, "".join(letters)))
        if self.joins:
            apart = self._encode([f"a{c} {s}{c}" for c in letters for s in signs]) == self._encode([f"a{c}{s}{c}" for c in letters for s in signs])
            self.set_off = f"([{LETTERS}])([{re.escape(''.join(signs))}])" if apart else None
        self._empty()

    def _empty(self) -> None:
        self.number: dict[str, int] = {}
        self.start, self.length, self.used, self.flat = np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros(0, np.int32)

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _fresh(self, new: list[str], joined: bool) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """The ids of words and how many each has; joined: words of letters only, many in one call."""
        flat, length = [], []
        for k in range(0, len(new), 1 << 14):
            some = new[k : k + (1 << 14)]
            if not joined:
                ids = self._encode(some)
                length.append(np.fromiter(map(len, ids), np.int32, len(ids)))
                flat.append(np.fromiter((i for x in ids for i in x), np.int32, int(length[-1].sum())))
                continue
            parts = [some[i : i + JOINED] for i in range(0, len(some), JOINED)]
            for part, ids in zip(parts, self._encode([" ".join(p) for p in parts]), strict=True):
                ids = np.array(ids, np.int32)
                ends = np.flatnonzero(self.last[ids]) + 1
                if len(ends) != len(part) or ends[-1] != len(ids):
                    raise RuntimeError("words and endings are not as many")
                flat.append(ids)
                length.append(np.diff(ends, prepend=0).astype(np.int32))
        return flat, length

    def _forget(self) -> None:
        """Words that came up in one pack only; all, if that leaves too many."""
        often = self.used > 1
        if often.sum() > self.held // 2:
            return self._empty()
        to, which = (np.cumsum(often) - 1).tolist(), np.flatnonzero(often)
        self.number = {w: to[i] for (w, i), o in zip(self.number.items(), often.tolist(), strict=True) if o}
        self.flat, each = W.gather(self.flat, self.start, self.length, which)
        self.length, self.start, self.used = each.astype(np.int32), np.cumsum(each, dtype=np.int64) - each, np.zeros(len(which), np.int32)

    def _numbers(self, distinct: list[str]) -> np.ndarray:
        """Each word's number among those that are held; the new ones are added."""
        if len(self.number) > self.held:
            self._forget()
        new = [w for w in distinct if w not in self.number]
        if new:
            letters = [w for w in new if self.is_letters(w)] if self.joins else []
            others = [w for w in new if not self.is_letters(w)] if letters else new
            self.number.update(zip(letters + others, range(len(self.number), len(self.number) + len(new)), strict=True))
            a, b = self._fresh(letters, True), self._fresh(others, False)
            length = np.concatenate(a[1] + b[1])
            self.start = np.concatenate([self.start, len(self.flat) + np.cumsum(length, dtype=np.int64) - length])
            self.length = np.concatenate([self.length, length])
            self.used = np.concatenate([self.used, np.zeros(len(new), np.int32)])
            self.flat = np.concatenate([self.flat, *a[0], *b[0]])
        at = np.fromiter(map(self.number.__getitem__, distinct), np.int64, len(distinct))
        self.used[at] += 1
        return at

    def of(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of texts (none is null) one after another, and how many each has."""
        if self.set_off:
            texts = pc.replace_substring_regex(texts, pattern=self.set_off, replacement=r"\1 \2")
        lists = pc.ascii_split_whitespace(texts)
        coded = lists.flatten().dictionary_encode()
        which = self._numbers(coded.dictionary.to_pylist())[coded.indices.to_numpy(zero_copy_only=False)]
        parts = [W.gather(self.flat, self.start, self.length, which[k : k + SLICE])[0] for k in range(0, len(which), SLICE)]
        ends = np.concatenate([[0], np.cumsum(self.length[which], dtype=np.int64)])
        offsets = lists.offsets.to_numpy() - lists.offsets[0].as_py() if len(lists) else np.zeros(1, np.int32)
        return np.concatenate([np.zeros(0, np.int32), *parts]), np.diff(ends[offsets])


@lru_cache(maxsize=2)
def ids_of(path: str) -> Ids:
    """The worker's own."""
    return Ids(path)
