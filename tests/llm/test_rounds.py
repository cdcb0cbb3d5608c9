"""Concentration steps that end one by one, words that are not remembered, and memory that is given back."""

import ctypes
import random
import re
import tracemalloc
from pathlib import Path
from types import SimpleNamespace

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from funil.llm import jaccard_join, quality, word_ids


def test_starts_at_rest_are_not_carried_on(spark, monkeypatch):
    """A start whose determinant has stopped falling is in no later step, so that steps read and write less and less."""
    rnd, written, write = random.Random(4), [], quality.write_once

    def counted(df, purpose):
        out = write(df, purpose)
        if purpose == "estimates":
            written.append(out.count())
        return out

    monkeypatch.setattr(quality, "write_once", counted)
    rows = [(g, *[rnd.gauss(0, 1 + k) for k in range(4)]) for g in ("a", "b", "c") for _ in range(60)]
    names = ", ".join(f"{n} double" for n in quality.VECTOR)
    found = quality.covariance_determinants(spark.createDataFrame(rows, f"_group string, {names}")).collect()
    *steps, last = written
    assert len(found) == last == 3 and steps[0] == 9 and steps[-1] == 0 and steps == sorted(steps, reverse=True)


@pytest.mark.parametrize("name, spaced", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_words_beyond_those_remembered(monkeypatch, name, spaced):
    """Ids are the library's with few words remembered, long words, separators and the text of special tokens."""
    monkeypatch.setattr(word_ids, "REMEMBERED", 5)
    words, rnd = word_ids.WordIds(public_tokenizers.path(name), spaced), random.Random(2)
    parts = ["a", "Ça", "it's", "12,5", "x" * 60, "\n\n", "\t", "<|endoftext|>", "<", "|", "né\x1cà", "b\x1d", "\x1e", "\x1fc"]
    for _ in range(4):
        texts = [" ".join(rnd.choices(parts, k=rnd.randrange(9))) for _ in range(60)]
        assert words.encode(texts) == words.library(texts)
    assert len(words.known) <= 5


VOCABULARIES = [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)]
SIGNS = [
    *"aZ09'.,|<>-ßéİΣς٠²̸́Å中ᅡ한\U0001f600 \u0085 　​\t\n\r\x0b\x0c\x00",
    " ", " ", " ", "  ", "   ", "\n\n", " \n ", "'s", "'S", "'ll", "The", " the", "don't", "über", "`", "x" * 60, "</w>", "Ġ", "Ċ",
]


@pytest.mark.parametrize("name, spaced", VOCABULARIES)
def test_pieces_and_joined_words_have_the_librarys_ids(name, spaced):
    """Texts cut at spaces and words looked up together have the ids of the whole text, with the end after each."""
    words, rnd = word_ids.WordIds(public_tokenizers.path(name), spaced), random.Random(5)
    for _ in range(20):
        texts = ["".join(rnd.choices(SIGNS, k=rnd.randrange(14))) for _ in range(300)]
        ids, bounds = words.packed(pa.array([*texts, None]), 7)
        found = [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])]
        own = words.tokenizer.encode_batch(texts, add_special_tokens=False)
        assert found == [*([*e.ids, 7] for e in own), [7]]
    assert words.packed(pa.array([], pa.string()))[1].tolist() == [0]
    ids, _ = words.packed(pa.array(["one two"]), 1 << 17)  # an end beyond the narrow type
    assert ids.itemsize == 4 and ids[-1] == 1 << 17


@pytest.mark.parametrize("name, spaced", VOCABULARIES)
def test_new_words_are_looked_up_together(name, spaced):
    """The library gets many new words as one text, and none of those it has had, whatever signs stand at them."""
    words, rnd, given = word_ids.WordIds(public_tokenizers.path(name), spaced), random.Random(6), []

    class Counted:
        def encode_batch_fast(self, texts, add_special_tokens):
            given.append(len(texts))
            return words_of.encode_batch_fast(texts, add_special_tokens=add_special_tokens)

    words_of, words.tokenizer = words.tokenizer, Counted()
    made = sorted({"".join(rnd.choices("abcdefghä", k=8)) for _ in range(6000)})
    text = "so " + " ".join(made)
    words.encode([text])
    assert sum(given) < len(made) / 20 and max(given) <= word_ids.CALL
    given.clear()
    words.encode([text, text.replace(" ", ", ").encode("ascii", "ignore").decode()])
    assert sum(given) < len(made) / 20


@pytest.mark.parametrize("name, spaced", VOCABULARIES)
def test_memory_of_remembered_words(name, spaced):
    """Remembered words take little more than their letters: workers hold them while the executor's next stage runs."""
    words, rnd = word_ids.WordIds(public_tokenizers.path(name), spaced), random.Random(7)
    text = " ".join("".join(rnd.choices("abcdefghij", k=8)) for _ in range(60_000))
    before = pa.total_allocated_bytes()
    tracemalloc.start()
    words.encode([text])
    words.encode(["abc"])
    held = tracemalloc.get_traced_memory()[0] + pa.total_allocated_bytes() - before
    tracemalloc.stop()
    assert len(words.known) > 55_000 and held < 60 * len(words.known), held


class Given:
    """Stands for rows, and keeps the functions that would run over them."""

    def __init__(self, schema):
        self.schema, self.runs = schema, []
        self.sparkSession = self.sparkContext = self

    def broadcast(self, value):
        return SimpleNamespace(value=value)

    def select(self, *columns):
        return self

    def repartition(self, *columns):
        return self

    def mapInArrow(self, run, schema):
        self.runs.append(run)
        return self


def test_workers_of_the_join_give_memory_back(spark):
    """When a task ends its worker holds next to nothing that is free: the executor's next stage needs the memory."""
    rnd = random.Random(7)
    words = ["".join(rnd.choices("abcdefghij", k=6)) for _ in range(5000)]
    texts = [" ".join(rnd.choices(words, k=500)) for _ in range(5000)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], ["_id", "_text"])
    rows = Given(spark.createDataFrame([], "_id long, _text string").schema)
    jaccard_join._profiles(rows, 5)
    jaccard_join._blocks(rows, np.zeros(0, np.uint64), 5, 75, 256)
    free = []

    def private():
        return int(re.search(r"Private_Dirty:\s+(\d+)", Path("/proc/self/smaps_rollup").read_text())[1]) / 1024

    for run in rows.runs[:2]:
        assert sum(b.num_rows for b in run(iter([batch])))
        held = private()
        pa.default_memory_pool().release_unused()
        ctypes.CDLL(None).malloc_trim(0)
        free.append(held - private())
    assert max(free) < 16, free
