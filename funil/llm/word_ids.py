"""Ids by the tokenizers library, with the ids of words met before remembered."""

from __future__ import annotations

import json
import os
import re
from array import array
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

REMEMBERED = 1_000_000  # words a worker remembers
LONGEST = 48  # characters of a word that is remembered
TOGETHER, CALL = 32, 2048  # words that the library gets as one text, and in one call


class WordIds:
    """Ids of texts, word by word.

    Both tokenizers split a text before they merge, and no part goes on over white
    space: a word's ids do not depend on the words around it.  ``spaced`` says that a
    space belongs to the word that follows it (byte-level vocabularies); otherwise
    white space is dropped.  Texts for which this split is not sure to be the
    library's go through the library whole.

    Texts are cut at spaces and equal pieces are found by Arrow, so Python sees each piece of a batch once at
    most.  Pieces not remembered are cut into words, ASCII ones as the vocabulary's own pattern does.  The
    library gets new words many at a time, and tokens that end a word tell them apart again.  Remembered words are
    kept by Arrow too, in a fraction of the room of Python's strings: idle workers hold them while the JVM works.
    """

    def __init__(self, path: str, spaced: bool):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs the tasks side by side
        from tokenizers import Tokenizer

        self.tokenizer, self.spaced = Tokenizer.from_file(path), spaced
        self.size = self.tokenizer.get_vocab_size()
        self.split = _SPACED if spaced else str.split
        # ``ends`` tells which ids end a word of a joined text: the separator's, or those of last tokens.
        self.plain = self.ends = None
        with open(path, encoding="utf-8") as file:
            rules = json.load(file)
        tokens = self.tokenizer.get_vocab(with_added_tokens=False)
        if spaced and _is_byte_level(rules):
            self.plain, ends = _BYTE_LEVEL, [tokens["Ċ"]]
        elif not spaced and _is_lower_case(rules, tokens):
            self.plain, ends = _LOWER_CASE, [i for t, i in tokens.items() if t.endswith(_LAST)]
        if self.plain:
            self.ends = np.zeros(max(self.size, max(tokens.values()) + 1), bool)
            self.ends[ends] = True
        # The remembered words, and their ids: those of word p from bounds[p] to bounds[p + 1].
        self.known = pa.array([], pa.large_string())
        self.values, self.bounds = np.zeros(0, self.narrow(0)), np.zeros(1, np.int64)

    def narrow(self, end_id: int) -> np.dtype:
        """The type that all ids fit."""
        return np.dtype("<u2" if self.size <= 1 << 16 and end_id < 1 << 16 else "<u4")

    def library(self, texts: list[str]) -> list[bytes]:
        """Packed little-endian 32-bit ids of each text."""
        return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The same, word by word."""
        ids, bounds = self.packed(pa.array(texts, pa.string()))
        ids, bounds = ids.astype("<u4"), bounds.tolist()
        return [ids[a:b].tobytes() for a, b in zip(bounds, bounds[1:])]

    def packed(self, texts: pa.Array, end_id: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts end to end, ``end_id`` after each, and where each text begins and the last one ends.

        A null text is empty.
        """
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        unsure = pc.match_substring_regex(texts, _UNSURE)
        whole = np.flatnonzero(unsure.to_numpy(zero_copy_only=False))
        cut = pc.if_else(unsure, pa.scalar("", pa.large_string()), texts) if len(whole) else texts
        if self.spaced:  # pieces keep the space before them; texts with runs of white space are one piece
            spaces = pc.replace_substring(cut, " ", "\x1f ")
            runs = pc.match_substring_regex(cut, _RUNS)
            cut = pc.split_pattern(pc.if_else(runs, cut, spaces), "\x1f")
        else:
            cut = pc.split_pattern(cut, " ")
        pieces, edges = cut.flatten().dictionary_encode(), cut.offsets.to_numpy().astype(np.int64)
        places, values, bounds = self._places(pieces.dictionary)
        sequence = places[pieces.indices.to_numpy()]

        more = self._ids([texts[k].as_py() for k in whole.tolist()])
        if end_id is not None:
            more.append(np.array([end_id], self.narrow(end_id)))
        sequence[edges[whole]] = len(bounds) - 1 + np.arange(len(whole))  # these have one empty piece each
        values, bounds = _extended(values, bounds, np.concatenate([values[:0], *more]), [len(m) for m in more])
        if end_id is not None:
            sequence = np.insert(sequence, edges[1:], len(bounds) - 2)
            edges = edges + np.arange(len(edges))
        ids, ends = _gathered(values, bounds, sequence)
        return ids, np.concatenate([[0], ends])[edges]

    def rest(self) -> None:
        """Give free memory back when a task ends; what is remembered stays for the worker's next task."""
        pa.default_memory_pool().release_unused()

    def _places(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The place of each piece in a table of ids, and the table: the remembered words, then those of these pieces only."""
        places = self._remembered(pieces)
        unseen = np.flatnonzero(places < 0)
        words = [self._words(p) for p in _strings(pieces, unseen)]
        numbers = np.fromiter(map(len, words), np.int64, len(words))
        words = pa.array(list(chain.from_iterable(words)), pa.large_string()).dictionary_encode()
        at = self._remembered(words.dictionary)
        new = np.flatnonzero(at < 0)
        short = pc.utf8_length(words.dictionary).to_numpy()[new] <= LONGEST
        kept, ids, counts = self._looked_up(words.dictionary, new[short][: max(0, REMEMBERED - len(self.known))])
        first = len(self.known)
        self.known, (self.values, self.bounds) = (
            pa.concat_arrays([self.known, words.dictionary.take(pa.array(kept))]),
            _extended(self.values, self.bounds, ids, counts),
        )
        at[kept] = first + np.arange(len(kept))

        passing, ids, counts = self._looked_up(words.dictionary, np.flatnonzero(at < 0))
        at[passing] = len(self.known) + np.arange(len(passing))
        values, bounds = _extended(self.values, self.bounds, ids, counts)
        found, one = at[words.indices.to_numpy()], numbers == 1
        places[unseen[one]] = found[np.repeat(one, numbers)]
        ids, ends = _gathered(values, bounds, found[np.repeat(~one, numbers)])
        ends = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(numbers[~one])])]
        places[unseen[~one]] = len(bounds) - 1 + np.arange(len(ends) - 1)
        return places, *_extended(values, bounds, ids, np.diff(ends))

    def _remembered(self, words: pa.Array) -> np.ndarray:
        """The place of each word, or -1."""
        return pc.index_in(words, value_set=self.known).fill_null(-1).to_numpy().astype(np.int64)

    def _words(self, piece: str) -> list[str]:
        if self.plain and piece.isascii():
            return self.plain(piece if self.spaced else piece.lower())
        return self.split(piece)

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        """The library's ids of each text."""
        found = []
        for k in range(0, len(texts), CALL):
            encoded = self.tokenizer.encode_batch_fast(texts[k : k + CALL], add_special_tokens=False)
            found += [np.array(e.ids, self.values.dtype) for e in encoded]
        return found

    def _looked_up(self, words: pa.Array, which: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The given words' numbers in another order, their ids end to end, and the number of each one's ids.

        A joined text counts if it has as many ends as words: every word has one at least.
        """
        done, ids, counts = [which[:0]], [self.values[:0]], [np.zeros(0, np.int64)]
        mark = "\n" if self.spaced else " "
        for k in range(0, len(which), CALL):
            part = which[k : k + CALL]
            names = _strings(words, part)
            sure = np.array([self._joins(w) for w in names], bool)
            joined, alone = np.flatnonzero(sure), [np.flatnonzero(~sure)]
            groups = [joined[i : i + TOGETHER] for i in range(0, len(joined), TOGETHER)]
            texts = [mark.join([*[names[i] for i in g.tolist()], ""]) for g in groups]
            for group, found in zip(groups, self._ids(texts)):
                last = np.flatnonzero(self.ends[found])
                if len(last) != len(group) or last[-1] != len(found) - 1:
                    alone.append(group)
                    continue
                done.append(part[group])
                counts.append(np.diff(last, prepend=-1) - self.spaced)
                ids.append(found[~self.ends[found]] if self.spaced else found)
            alone = np.concatenate(alone)
            found = self._ids([names[i] for i in alone.tolist()])
            done.append(part[alone])
            counts.append(np.array([len(f) for f in found], np.int64))
            ids += found
        return np.concatenate(done), np.concatenate(ids), np.concatenate(counts)

    def _joins(self, word: str) -> bool:
        """Whether a word may stand among others in a text for the library."""
        if self.ends is None:
            return False
        return not word.isspace() if self.spaced else word.isascii() or word.isalpha()


def _strings(words: pa.Array, which: np.ndarray) -> list[str]:
    return words.take(pa.array(which)).to_numpy(zero_copy_only=False).tolist()


def _extended(values: np.ndarray, bounds: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A table of ids with more entries."""
    return np.concatenate([values, ids]), np.concatenate([bounds, bounds[-1] + np.cumsum(counts, dtype=np.int64)])


def _gathered(values: np.ndarray, bounds: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of the places one after the other, and where each place's end."""
    counts = bounds[places + 1] - bounds[places]
    ends = np.cumsum(counts)
    total = int(ends[-1]) if len(ends) else 0
    kind = np.int32 if max(total, int(bounds[-1])) < 1 << 31 else np.int64
    at = np.repeat((bounds[places] - ends + counts).astype(kind), counts)
    at += np.arange(total, dtype=kind)
    return values[at], ends


# Texts with separators that Python counts as white space and the libraries do not, or with the text of special tokens.
_UNSURE = r"<\||[\x1c-\x1f]"
_SPACE = r"[\t-\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
# A space between white space, or between white space and the end: cut there, a run of white space would not stay whole.
_RUNS = rf"{_SPACE} {_SPACE}|{_SPACE} \z"

# A word with the space before it, or white space: all of a run but its last character, or what is left.
_SPACED = re.compile(r" ?\S+|\s+(?!\S)|\s+").findall
# The vocabularies' own patterns for ASCII texts.
_BYTE_LEVEL = re.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+"
).findall
_LOWER_CASE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\sa-z0-9]+").findall
_LOWER_CASE_RULE = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_LAST = "</w>"


def _is_byte_level(rules: dict) -> bool:
    """Whether a vocabulary's texts are cut by ``_BYTE_LEVEL`` and changed in no other way."""
    cut = rules["pre_tokenizer"] or {}
    return (
        rules["normalizer"] is None and cut.get("type") == "ByteLevel"
        and cut["use_regex"] and not cut["add_prefix_space"] and "Ċ" in rules["model"]["vocab"]
    )


def _is_lower_case(rules: dict, tokens: dict[str, int]) -> bool:
    """Whether texts are lower-cased and cut by ``_LOWER_CASE``, and every part ends in a token of its own kind."""
    cut, changes = rules["pre_tokenizer"] or {}, (rules["normalizer"] or {}).get("normalizers", [])
    steps = cut.get("pretokenizers", [])
    return (
        [c["type"] for c in changes] == ["NFC", "Replace", "Lowercase"]
        and (changes[1]["pattern"], changes[1]["content"]) == ({"Regex": r"\s+"}, " ")
        and [s["type"] for s in steps] == ["Split", "ByteLevel"]
        and steps[0]["pattern"] == {"Regex": _LOWER_CASE_RULE}
        and (steps[0]["behavior"], steps[0]["invert"]) == ("Removed", True)
        and not steps[1]["use_regex"] and not steps[1]["add_prefix_space"]
        and rules["model"].get("end_of_word_suffix") == _LAST
        and sum(len(t) == 1 + len(_LAST) and t.endswith(_LAST) for t in tokens) == 256  # no byte is without a token
    )


@lru_cache(maxsize=4)
def word_ids(path: str, spaced: bool) -> WordIds:
    """The words of a vocabulary, once per worker."""
    return WordIds(path, spaced)
