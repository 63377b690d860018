"""Ids of whole texts by the tokenizers library, which meets each distinct word once.

A tokenizer that drops white space never joins what white space parts, so a
text's ids are those of its words in turn; bounded tables keep words and pieces
that were met, and let go of those met once. Unmet words of Latin letters,
digits and signs are split by the tokenizer's own pattern, and just unmet
pieces are encoded. Other words, and words that could hold a special token, are
encoded whole, as are texts where the tokenizer's file promises no such parts.
"""

from __future__ import annotations

import functools
import itertools
import json
import os
import re
import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Words that a worker keeps, and pieces.
MOST_KEPT = 1 << 19
#: Printing characters below U+0250: all are in composed form, and their classes have long been settled.
_PLAIN = re.compile("[!-~¡-¬®-ɏ]+").fullmatch


#: The word, with a space in it as no other, behind each text.
END = "the end"


class _Table:
    """Keys with their ids, in flat arrays."""

    def __init__(self):
        self.number: dict = {}
        self.flat, self.starts, self.lengths, self.hits = np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)

    def find(self, keys: list) -> np.ndarray:
        """Each key's number, or -1."""
        return np.fromiter(map(self.number.get, keys, itertools.repeat(-1)), np.int64, len(keys))

    def add(self, keys: list, flat: np.ndarray, lengths: np.ndarray) -> None:
        n = len(self.lengths)
        self.number.update(zip(keys, range(n, n + len(keys)), strict=True))
        self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(lengths) - lengths])
        self.flat, self.lengths, self.hits = np.concatenate([self.flat, flat.astype(np.int32)]), np.concatenate([self.lengths, lengths]), np.concatenate([self.hits, np.zeros(len(keys), np.int64)])

    def ids(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of these numbers, one after another, and how many each has."""
        self.hits += np.bincount(at, minlength=len(self.hits))
        many = self.lengths[at]
        before = np.cumsum(many) - many
        return self.flat[np.arange(many.sum()) + np.repeat(self.starts[at] - before, many)], many

    def shrink(self, least: int) -> None:
        """Keeps what was met twice since the last time; if that is most of it, nothing."""
        if len(self.number) <= least:
            return
        stays = self.hits > 1
        if stays.sum() > least * 3 // 4:
            stays[:] = False
        keys = [k for k, s in zip(self.number, stays.tolist(), strict=True) if s]
        flat, lengths = self.ids(np.flatnonzero(stays))
        self.__init__()
        self.add(keys, flat, lengths)


class Encoder:
    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        with open(path, encoding="utf-8") as f:
            said = json.load(f)
        self.library = Tokenizer.from_str(json.dumps(said))
        self.bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.size = self.library.get_vocab_size(with_added_tokens=True)
        self.special = [t["content"] for t in said["added_tokens"]]
        self.pattern = _pattern(said)
        self.words, self.pieces = _Table(), _Table()

    def _whole(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return _flat([e.ids for e in self.library.encode_batch_fast(texts, add_special_tokens=False)])

    def _pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Pieces as the library's model takes them: a character a byte."""
        far = [k for k, p in enumerate(pieces) if not p.isascii()]  # printing ASCII characters stand for themselves
        marked = self.bytes.pre_tokenize_str("\n".join(pieces[k] for k in far))[0][0].split(self.bytes.pre_tokenize_str("\n")[0][0]) if far else []
        for k, p in zip(far, marked, strict=True):
            pieces[k] = p
        model = self.library.model
        return _flat([[t.id for t in model.tokenize(p)] for p in pieces])

    def _learn(self, words: list[str]) -> None:
        joined = "\n".join(words)
        plain = list(map(bool, map(_PLAIN, words)))
        if any(x in joined for x in self.special):
            plain = [p and not any(x in w for x in self.special) for p, w in zip(plain, words, strict=True)]
        odd = [w for w, p in zip(words, plain, strict=True) if not p]
        self.words.add(odd, *self._whole(odd))
        known = list(itertools.compress(words, plain))
        if not known:
            return
        pieces = self.pattern.findall("\n".join(known).lower() + "\n")
        if "\n" not in self.pieces.number:
            self.pieces.add(["\n"], np.empty(0), np.zeros(1, np.int64))
        at = self.pieces.find(pieces)
        unmet = np.flatnonzero(at < 0)
        if len(unmet):
            again = [pieces[k] for k in unmet.tolist()]
            new = list(dict.fromkeys(again))
            self.pieces.add(new, *self._pieces(list(new)))
            at[unmet] = self.pieces.find(again)
        flat, many = self.pieces.ids(at)
        ends = np.cumsum(many)[at == self.pieces.number["\n"]]
        self.words.add(known, flat, np.diff(np.concatenate([[0], ends])))

    def __call__(self, texts: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, `end` behind each text's, and how many each has."""
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks share the cores already
        if self.pattern is None:
            flat, many = self._whole(texts.to_pylist())
            return np.insert(flat, np.cumsum(many), end), many + 1
        for t in (self.words, self.pieces):
            t.shrink(MOST_KEPT)
        split = pc.ascii_split_whitespace(texts)
        coded = split.flatten().dictionary_encode()
        words = coded.dictionary.to_pylist()  # an empty one stands where a text begins or ends with white space
        at = self.words.find(words)
        unmet = np.flatnonzero(at < 0)
        if len(unmet):
            new = [words[k] for k in unmet.tolist()]
            self._learn(new)
            at[unmet] = self.words.find(new)
        if END not in self.words.number:
            self.words.add([END], np.array([end]), np.ones(1, np.int64))
        ends = np.cumsum(pc.list_value_length(split).to_numpy())
        order = np.insert(at[coded.indices.to_numpy()], ends, self.words.number[END])
        ids, many = self.words.ids(order)
        return ids, np.diff(np.concatenate([[0], np.cumsum(many)[ends + np.arange(len(ends))]]))


def _flat(made: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    return np.fromiter(itertools.chain.from_iterable(made), np.int64), np.fromiter(map(len, made), np.int64, len(made))


def _pattern(said: dict):
    """The pattern that splits lower-case plain words, or an end of line; None where white space does not part texts."""
    steps = (said.get("normalizer") or {}).get("normalizers", [])
    cut = (said.get("pre_tokenizer") or {}).get("pretokenizers", [])
    parted = [s["type"] for s in steps] == ["NFC", "Replace", "Lowercase"] and steps[1]["pattern"] == {"Regex": r"\s+"} and [c["type"] for c in cut] == ["Split", "ByteLevel"]
    if not parted or (cut[0]["behavior"], cut[0]["invert"], cut[1]["add_prefix_space"], cut[1]["use_regex"]) != ("Removed", True, False, False):
        return None
    regex = cut[0]["pattern"]["Regex"]
    if r"[^\s" not in regex or said.get("post_processor") is not None or any(t["lstrip"] or t["rstrip"] for t in said["added_tokens"]):
        return None
    for kind in "LN":  # Python's own patterns have no classes of Unicode
        regex = regex.replace(rf"\p{{{kind}}}", "".join(re.escape(chr(k)) for k in range(0x250) if unicodedata.category(chr(k))[0] == kind))
    return re.compile(regex + r"|\n")


@functools.lru_cache(1)
def encoder(path: str) -> Encoder:
    return Encoder(path)
