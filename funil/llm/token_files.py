"""Token ids in Arrow IPC files of fixed-size lists: equal-length sequences with masks.

A file holds record batches of ``ROWS`` sequences, each a fixed-size list of ``length``
ids and one of as many mask bits (true for tokens, false for padding).  All documents of a file
follow one another; only its last sequence is padded.  Files are not compressed, so
a reader maps them and looks at any sequence without copying it.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import StructType

from funil.llm import batches as B
from funil.llm.word_ids import word_ids
from funil.settings import write_once

ROWS = 256


def _fixed(values: np.ndarray, length: int) -> pa.Array:
    return pa.FixedSizeListArray.from_arrays(pa.array(values), length)


class Writer:
    """Appends ids to a file of sequences."""

    def __init__(self, path: str, length: int, dtype: str):
        self.length, self.dtype, self.waiting, self.held = length, np.dtype(dtype), [], 0
        kind = pa.from_numpy_dtype(self.dtype)
        self.schema = pa.schema([("ids", pa.list_(kind, length)), ("mask", pa.list_(pa.bool_(), length))])
        system, place = pafs.FileSystem.from_uri(path)
        self.sink = system.open_output_stream(place)
        self.file = pa.ipc.new_file(self.sink, self.schema)

    def append(self, ids: np.ndarray) -> None:
        """Add ids, which have the file's type."""
        self.waiting.append(ids)
        self.held += len(ids)
        if self.held >= ROWS * self.length:
            values = np.concatenate(self.waiting)
            whole = len(values) // (ROWS * self.length) * ROWS * self.length
            self._write(values[:whole], whole)
            self.waiting, self.held = [values[whole:]], len(values) - whole

    def _write(self, values: np.ndarray, tokens: int) -> None:
        mask = np.arange(len(values)) < tokens
        table = pa.Table.from_arrays([_fixed(values, self.length), _fixed(mask, self.length)], schema=self.schema)
        self.file.write_table(table, max_chunksize=ROWS)

    def close(self) -> None:
        if self.held:
            values = np.concatenate(self.waiting)
            padded = np.zeros(-(-self.held // self.length) * self.length, self.dtype)
            padded[: self.held] = values
            self._write(padded, self.held)
        self.file.close()
        self.sink.close()


class Reader:
    """Random access to a file's sequences and to runs of its tokens."""

    def __init__(self, path: str):
        system, place = pafs.FileSystem.from_uri(path)
        local = isinstance(system, pafs.LocalFileSystem)
        self.file = pa.ipc.open_file(pa.memory_map(place) if local else system.open_input_file(place))
        self.length = self.file.schema.field("ids").type.list_size
        self.batches: dict[int, tuple[np.ndarray, pa.BooleanArray]] = {}

    def _batch(self, k: int) -> tuple[np.ndarray, pa.BooleanArray]:
        if k not in self.batches:
            batch = self.file.get_batch(k)
            ids = batch.column(0).flatten().to_numpy(zero_copy_only=True)
            self.batches = {**dict(list(self.batches.items())[-3:]), k: (ids, batch.column(1).flatten())}
        return self.batches[k]

    def sequence(self, row: int) -> tuple[np.ndarray, pa.BooleanArray]:
        """A sequence's ids and mask, as views of the file."""
        ids, mask = self._batch(row // ROWS)
        at = row % ROWS * self.length
        return ids[at : at + self.length], mask.slice(at, self.length)

    def tokens(self, start: int, count: int) -> np.ndarray:
        """``count`` ids from the file's token ``start`` on."""
        size, parts = ROWS * self.length, []
        while count > 0:
            at = start % size
            part = self._batch(start // size)[0][at : at + count]
            parts.append(part)
            start, count = start + len(part), count - len(part)
        return parts[0] if len(parts) == 1 else np.concatenate(parts or [np.zeros(0, np.uint16)])


def write_files(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    length: int = 2048,
    end_id: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Write all documents' ids in ascending order of id; return where each one is.

    Columns: id, ``file``, ``part`` (number of the file in order), ``file_start`` (the
    document's first token in its file), ``start`` (tokens of all documents before
    it) and ``n_tokens``, which counts ``end_id``.

    * A null or empty text is ``end_id`` alone.
    * Null ids come first.  Rows repeated under one id follow one another, in the order
      of a hash of the text.  Other columns are ignored.  No rows give no files.

    ``folder`` is a path or URI that all executors reach.  Texts are range-sorted (packed ids would
    take as much room as they do, and would have to be written before they are sorted).  Each task writes one file
    under a name of its own, so a task that runs again leaves the first file alone; the
    index, written once, names those that count.
    """
    system, place = pafs.FileSystem.from_uri(folder)

    def run(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of, part, start, writer = word_ids(tokenizer, True), TaskContext.get().partitionId(), 0, None
        path = f"{folder}/part-{part:06d}-{uuid.uuid4().hex}.arrow"
        for batch in B.slices(given, "_text"):
            if writer is None:
                system.create_dir(place, recursive=True)
                writer = Writer(path, length, ids_of.narrow(end_id))
            ids, bounds = ids_of.packed(batch.column("_text"), end_id)
            writer.append(ids)
            n, starts, counts = batch.num_rows, start + bounds[:-1], np.diff(bounds)
            start += int(bounds[-1])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([path] * n, pa.string()), pa.array(np.full(n, part)), pa.array(starts),
                 pa.array(counts)], ["_id", "file", "part", "file_start", "n_tokens"],
            )
        if writer is not None:
            writer.close()
        ids_of.rest()

    rows = docs.select(F.col(id_col).alias("_id"), F.xxhash64(text_col).alias("_tie"), F.col(text_col).alias("_text"))
    schema = StructType([rows.schema[0]]).add("file", "string").add("part", "long")
    index = write_once(
        rows.repartitionByRange("_id", "_tie").sortWithinPartitions("_id", "_tie")
        .select("_id", "_text").mapInArrow(run, schema.add("file_start", "long").add("n_tokens", "long")),
        "token_index",
    )
    # One row per file: the number of files is that of the range partitions.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    files = index.groupBy("part").agg(F.sum("n_tokens").alias("_sum"))
    bases = files.select("part", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_base"))
    return index.join(F.broadcast(bases), "part").select(
        F.col("_id").alias(id_col), "file", "part", "file_start",
        (F.col("_base") + F.col("file_start")).alias("start"), "n_tokens",
    )


def read_files(index: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Each indexed document's ids, read from the files: id, ``start``, ``n_tokens``, ``ids``.

    ``ids`` are little-endian unsigned 32-bit integers.
    """

    def run(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = reader = None
        for batch in given:
            files = batch.column("file").to_pylist()
            first, counts = batch.column("file_start").to_numpy(), batch.column("n_tokens").to_numpy()
            at = 0
            while at < batch.num_rows:  # documents that follow one another in a file are read as one
                stop, total = at + 1, int(counts[at])
                while (stop < batch.num_rows and files[stop] == files[at] and first[stop] == first[at] + total
                       and 4 * (total + counts[stop]) <= B.SLICE_BYTES):
                    total += int(counts[stop])
                    stop += 1
                if files[at] != path:
                    path, reader = files[at], Reader(files[at])
                ids = reader.tokens(int(first[at]), total).astype("<u4")
                part = batch.slice(at, stop - at)
                bounds = np.cumsum(np.concatenate([[0], counts[at:stop]]))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column("start"), part.column("n_tokens"), B.binary(ids, bounds)],
                    [id_col, "start", "n_tokens", "ids"],
                )
                at = stop

    rows = index.select(id_col, "start", "n_tokens", "file", "file_start")
    return rows.mapInArrow(run, rows.schema[:3].add("ids", "binary"))
