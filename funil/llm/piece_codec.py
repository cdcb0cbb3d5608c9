"""SentencePiece encoding and decoding for merge-type vocabularies.

Symbols of a text are merged in the order of their scores: an agenda holds every
adjacent pair whose concatenation is in the vocabulary, the best one is merged, and
the pairs it forms with its neighbours join the agenda.  Results are compared with
the sentencepiece library in the same Arrow batch.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructType

from funil.llm import batches as B

SPACE = "▁"
REMEMBERED = 1_000_000  # pieces of text a worker remembers
LONGEST = 48  # characters of a piece of text that is remembered


# Parts of a text whose spaces are marked.
_MARKED = re.compile(f"{SPACE}+[^{SPACE}\n]*|\n[^{SPACE}\n]*").findall


class Chunks(dict):
    """Packed ids of chunks; those met first are remembered, ``merged`` has those not checked yet."""

    def __init__(self, codec: Codec):
        super().__init__()
        self.codec, self.merged = codec, {}

    def __missing__(self, chunk: str) -> bytes:
        marked = chunk if chunk[:1] in ("\n", SPACE) else SPACE + chunk
        found = self.merged.get(marked)
        if found is None:
            found = self.merged[marked] = np.array(self.codec.merge(marked), "<i4").tobytes()
        if len(chunk) <= LONGEST and len(self) < REMEMBERED:
            self[chunk] = found
        return found


class Codec:
    """One vocabulary and the chunks of text it has met."""

    def __init__(self, model_file: str):
        self.library = sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
        ids = range(sp.vocab_size())
        normal = [i for i in ids if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        self.ids = {sp.id_to_piece(i): i for i in normal}
        self.scores = {piece: -sp.get_score(i) for piece, i in self.ids.items()}
        self.bytes = {int(sp.id_to_piece(i)[3:5], 16): i for i in ids if sp.is_byte(i)}
        self.unknown = sp.unk_id()
        self.text_of = [self._source(i) for i in ids]
        if sp.normalize("ﬁ  a ") != f"{SPACE}ﬁ{SPACE}{SPACE}a{SPACE}" or len(self.bytes) != 256:
            raise ValueError("only vocabularies with byte fallback that keep texts as they are")
        if any(SPACE in p.lstrip(SPACE) or ("\n" in p and len(p) > 1) for p in self.ids):
            raise ValueError("pieces must not span words or lines")
        self.chunks = Chunks(self)

    def _source(self, i: int) -> bytes:
        sp = self.library
        if sp.is_byte(i):
            return bytes([int(sp.id_to_piece(i)[3:5], 16)])
        if sp.is_unknown(i):
            return " ⁇ ".encode()
        return b"" if sp.is_control(i) else sp.id_to_piece(i).replace(SPACE, " ").encode()

    def merge(self, chunk: str) -> list[int]:
        """The ids of a chunk, by the agenda."""
        scores, symbols, end = self.scores, list(chunk), len(chunk)
        before, after = list(range(-1, end - 1)), list(range(1, end + 1))
        agenda = []
        for left in range(end - 1):
            pair = symbols[left] + symbols[left + 1]
            if pair in scores:
                agenda.append((scores[pair], left, left + 1, pair))
        heapify(agenda)
        while agenda:
            _, left, right, pair = heappop(agenda)
            # Entries whose symbols have been merged since are void.
            if not symbols[left] or not symbols[right] or symbols[left] + symbols[right] != pair:
                continue
            symbols[left], symbols[right] = pair, ""
            follow = after[left] = after[right]
            if follow < end:
                before[follow] = left
                new = pair + symbols[follow]
                if new in scores:
                    heappush(agenda, (scores[new], left, follow, new))
            ahead = before[left]
            if ahead >= 0:
                new = symbols[ahead] + pair
                if new in scores:
                    heappush(agenda, (scores[new], ahead, left, new))
        ids = []
        for symbol in symbols:
            if symbol in self.ids:
                ids.append(self.ids[symbol])
            elif symbol:
                ids.extend(self.bytes[b] for b in symbol.encode())
        return ids

    def verify(self, merged: dict[str, bytes]) -> None:
        """Compare ids of chunks with the library's, which puts a space mark before every text."""
        merged = {c: p for c, p in merged.items() if c != SPACE}  # an empty text gets no mark
        given = [c if c[0] == "\n" else c[1:] for c in merged]
        for (chunk, packed), expected in zip(merged.items(), self.library.encode(given, num_threads=1)):
            got = np.frombuffer(packed, "<i4").tolist()
            if got != (expected[1:] if chunk[0] == "\n" else expected):
                raise ValueError(f"{chunk!r}: merged to {got}, the library gives {expected}")

    def split(self, text: str) -> list[str]:
        """Chunks that merge independently, since no piece goes on after a word or over a line's end.

        A chunk that starts a line begins with the line end.  Any other chunk is a word
        that follows a space, given without it, unless the text has runs of spaces:
        then all chunks are given with their marks.
        """
        if not text:
            return []
        if "  " in text or text[0] == " " or SPACE in text:
            return _MARKED(SPACE + text.replace(" ", SPACE))
        return text.replace("\n", " \n").split(" ")

    def encode(self, texts: list[str], check: bool = True) -> list[bytes]:
        """Packed 32-bit ids of each text."""
        chunks = self.chunks
        packed = [b"".join(map(chunks.__getitem__, self.split(t))) for t in texts]
        if check:
            self.verify(chunks.merged)
        chunks.merged = {}
        return packed

    def decode(self, ids: list[int]) -> str:
        """The text of ids; the mark before the first word is not part of it."""
        source = b"".join(map(self.text_of.__getitem__, ids))
        if ids and self.library.id_to_piece(ids[0]).startswith(SPACE):
            source = source[1:]
        try:
            return source.decode()
        except UnicodeDecodeError:  # ids that no text encodes to
            return self.library.decode(ids)


@lru_cache(maxsize=2)
def codec(model_file: str) -> Codec:
    """The codec of a vocabulary, once per worker."""
    return Codec(model_file)


def encode_decode(
    docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text", check: bool = True
) -> DataFrame:
    """One row per input row: id, ``ids`` (array of int) and ``decoded``, the text those ids stand for.

    Ids are those of the sentencepiece library without begin or end marks.  ``check``
    compares every chunk of text that a worker merges with the library, and fails on
    a difference.  A null text counts as empty and has no ids.  Ids of rows may be
    null or repeated; other columns are ignored.  No rows give no rows.

    Whole texts are encoded, in slices of a batch of about 8 MB.  A worker remembers
    a fixed number of short chunks, so its memory does not grow with the data.
    """

    def run(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model_file)
        for batch in B.slices(given, "_text"):
            packed = own.encode(B.texts(batch, "_text"), check)
            decoded = [own.decode(np.frombuffer(p, "<i4").tolist()) for p in packed]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), B.lists(packed), pa.array(decoded, pa.string())], [id_col, "ids", "decoded"]
            )

    rows = docs.select(F.col(id_col), F.col(text_col).alias("_text"))
    schema = StructType([rows.schema[0]]).add("ids", ArrayType(IntegerType())).add("decoded", "string")
    return rows.mapInArrow(run, schema)
