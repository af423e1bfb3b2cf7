"""One column-oriented JSON document ``{"column": {"index": value}}`` of any size, read by many tasks.

A JSON parser needs the whole text; here the text is cut at its commas, which Spark's text source can do from any place of a
file on. Whether a comma lies in a string follows from the number of quotes before it, and which column a cell belongs to
from the last column that has been opened. Both are carried from block to block of the file, a row or two a block; inside a
block its task reads on from there, so the text itself meets in no shuffle. Then cells meet by index.

The document may lie in one file or in several, which in the order of their names make up the text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from activity_lake.session import ensure_checkpoint_dir

_TEXT = r'"(?:[^"\\]|\\.)*+"'
_OPENED = rf'^\s*\{{?\s*({_TEXT})\s*:\s*\{{'
_CELL = rf'({_TEXT})\s*:\s*({_TEXT}|[^\s{{}}"]+)\s*\}}*\s*$'
# As _OPENED, for an engine without possessive quantifiers.
_OPENING = _OPENED.replace("*+", "*")
_PARTS = "block BIGINT, kind INT, column STRING, text STRING"
# What goes on with an entry of a block before; the last entry of a block, which may go on; an entry that is whole.
_HEAD, _TAIL, _WHOLE = range(3)


class _Block:
    """The entries of one block of the text, fragment by fragment."""

    def __init__(self, block: int, quotes: int):
        self._block, self._quotes = block, quotes
        self._kind, self._rest, self._column = _HEAD, [], None

    def _made(self, kind: int, columns: pa.Array, texts: pa.Array) -> pa.RecordBatch:
        of = lambda value, dtype: pa.array(np.full(len(texts), value, dtype))
        return pa.RecordBatch.from_arrays([of(self._block, "int64"), of(kind, "int32"), columns, texts], ["block", "kind", "column", "text"])

    def _entries(self, texts: pa.Array) -> pa.RecordBatch:
        """Whole entries, each with the column that was last opened in the block."""
        opening = np.flatnonzero(pc.match_substring_regex(texts, _OPENING).to_numpy(zero_copy_only=False))
        names = [self._column, *(re.match(_OPENED, texts[int(at)].as_py(), re.ASCII)[1] for at in opening)]
        self._column = names[-1]
        return self._made(_WHOLE, pa.array(names, pa.string()).take(pa.array(np.searchsorted(opening, np.arange(len(texts)), "right"))), texts)

    def add(self, fragments: pa.Array, quotes: np.ndarray) -> Iterator[pa.RecordBatch]:
        """A fragment that begins inside a string goes on with the entry before it."""
        before = self._quotes + np.cumsum(quotes) - quotes
        self._quotes += int(quotes.sum())
        starts = np.flatnonzero(before % 2 == 0)
        if not len(starts):
            self._rest += fragments.to_pylist()
            return
        first, last = int(starts[0]), int(starts[-1])
        yield from self._finished(fragments[:first].to_pylist())
        if last > first:
            lists = pa.ListArray.from_arrays(pa.array(starts - first, pa.int32()), fragments[first:last])
            yield self._entries(pc.binary_join(lists, ","))
        self._kind, self._rest = _TAIL, fragments[last:].to_pylist()

    def _finished(self, more: list[str]) -> Iterator[pa.RecordBatch]:
        rest = self._rest + more
        if self._kind == _TAIL:
            yield self._entries(pa.array([",".join(rest)], pa.string()))
        elif rest:
            yield self._made(_HEAD, pa.nulls(1, pa.string()), pa.array([",".join(rest)], pa.string()))

    def end(self) -> Iterator[pa.RecordBatch]:
        if self._kind == _TAIL:
            yield self._made(_TAIL, pa.array([self._column], pa.string()), pa.array([",".join(self._rest)], pa.string()))
        else:
            yield from self._finished([])


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From fragments (value, quotes, block, before) in the order of their blocks to parts of blocks, as ``_PARTS``."""
    at, block = None, None
    for batch in batches:
        numbers, quotes, before = (batch.column(name).to_numpy() for name in ("block", "quotes", "before"))
        starts = [*np.flatnonzero(np.diff(numbers, prepend=-1 if at is None else at)).tolist(), batch.num_rows]
        if batch.num_rows and starts[0] > 0:
            yield from block.add(batch.column("value")[:starts[0]], quotes[:starts[0]])
        for start, end in zip(starts, starts[1:]):
            if block is not None:
                yield from block.end()
            at = int(numbers[start])
            block = _Block(at, int(before[start]))
            yield from block.add(batch.column("value")[start:end], quotes[start:end])
    if block is not None:
        yield from block.end()


def _decoded(json_text: Column) -> Column:
    """The text of a JSON string or the digits of a number; NULL for null."""
    return F.from_json(F.concat(F.lit("["), json_text, F.lit("]")), "array<string>")[0]


def _fragments(spark: SparkSession, path: str) -> DataFrame:
    """value, quotes, block (a number, in the order of the text) and before, the quotes in the blocks before it."""
    ensure_checkpoint_dir(spark)
    name = F.col("_metadata.file_path")
    # Written out: the blocks must be the same each time. A file goes by a number, as its path is longer than a fragment.
    written = spark.read.option("lineSep", ",").text(path).select(
        "value", F.xxhash64(name).alias("file"), F.col("_metadata.file_block_start").alias("start")).checkpoint()
    fragments = written.withColumn("quotes", F.length(F.regexp_replace(F.regexp_replace("value", r"\\.", ""), '[^"]', "")))
    names = spark.read.format("binaryFile").load(path).select(name.alias("name")).select("name", F.xxhash64("name").alias("file"))
    blocks = fragments.groupBy("file", "start").agg(F.sum("quotes").alias("_quotes")).join(names, "file")
    order = Window.orderBy("name", "start")
    # One row a block, counted once.
    numbered = blocks.select(
        "file", "start", F.row_number().over(order).cast("bigint").alias("block"),
        F.coalesce(F.sum("_quotes").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before")).checkpoint()
    return fragments.join(F.broadcast(numbered), ["file", "start"]).select("value", "quotes", "block", "before")


def cells(spark: SparkSession, path: str) -> DataFrame:
    """column_name, row_index (text), value (text): every cell of the document, also of columns nobody asks for."""
    parts = _fragments(spark, path).mapInArrow(_parts, _PARTS)
    # Entries that may go over the end of a block, one a block, and the column that a block begins in.
    ends = parts.filter(F.col("kind") != _WHOLE).checkpoint()
    places = Window.orderBy("block", "kind")
    # Put together by the block that an entry begins in; only its number goes through the window.
    begun = ends.select("block", "kind").withColumn("entry", F.max(F.when(F.col("kind") == _TAIL, F.col("block"))).over(places))
    pieces = F.sort_array(F.collect_list(F.struct("block", "text")))
    joined = ends.join(F.broadcast(begun), ["block", "kind"]).groupBy("entry").agg(
        F.array_join(pieces["text"], ",").alias("text"), F.max(F.when(F.col("kind") == _TAIL, F.col("column"))).alias("column"))
    opened = F.regexp_extract("text", _OPENED, 1)
    found = F.when(opened != "", opened)
    columns = joined.select("entry", F.coalesce(found, "column").alias("_last")).select(
        F.col("entry").alias("block"), F.last("_last", ignorenulls=True).over(
            Window.orderBy("entry").rowsBetween(Window.unboundedPreceding, -1)).alias("_before"))
    entries = parts.filter(F.col("kind") == _WHOLE).select("block", "column", "text").unionByName(
        joined.select(F.col("entry").alias("block"), F.coalesce(found, "column").alias("column"), "text"))
    placed = entries.join(F.broadcast(columns), "block", "left").select("text", F.coalesce("column", "_before").alias("_column"))
    index, value = (F.regexp_extract(F.regexp_replace("text", _OPENED, ""), _CELL, group) for group in (1, 2))
    return placed.select(
        _decoded(F.col("_column")).alias("column_name"), _decoded(F.when(index != "", index)).alias("row_index"),
        _decoded(F.when(value != "", value)).alias("value")).filter(F.col("row_index").isNotNull())


def read_column_document(spark: SparkSession, path: str, columns: dict[str, str]) -> DataFrame:
    """Rows of the document: row_index, and the named columns in their types; a cell that is missing or null is NULL.

    Values are strings, numbers, true, false or null; indexes are whole numbers.
    """
    found = cells(spark, path).filter(F.col("column_name").isin(*columns))
    return found.groupBy(F.col("row_index").cast("bigint").alias("row_index")).agg(
        *[F.max(F.when(F.col("column_name") == name, F.col("value"))).cast(kind).alias(name) for name, kind in columns.items()])
