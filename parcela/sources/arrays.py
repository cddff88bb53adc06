"""JSON files that hold one array, read by many tasks.

A file is split at a border text (any commas, or `},` between objects) into byte ranges, as a text file is at line
ends.  Whether a comma stands inside a string or a nested value depends on everything before it, but only through two
facts: open quote or not, and depth.  A first pass reduces each range to what it does to them, for either state of the
quote; these few rows are chained per file; with its state known, a second pass cuts each range into elements.  Both
look at whole batches of bytes, not at single pieces.  What is cut by the edge of a range is put together afterwards.
A file that does not end as a closed array is broken: none of its elements counts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcela.session import shared_dir

_WHOLE = re.compile(r'"(?:[^"\\]|\\.)*+"', re.S)
_REST = re.compile(r'(?:[^"\\]|\\.)*+"', re.S)
_QUOTE, _BACK, _COMMA = b'"'[0], b"\\"[0], b","[0]
_GROWS = np.zeros(256, np.int8)
_GROWS[list(b"[{")], _GROWS[list(b"]}")] = 1, -1
_MARKS = _GROWS != 0
_MARKS[_COMMA] = True
_BLANK = "\ufeff \t\r\n"
_OPENS = re.compile(rb"(?:\xef\xbb\xbf|[ \t\r\n])*\[")


def effect(piece: str, quoted: bool) -> tuple[bool, int]:
    """State of the quote after a piece, and by how much the depth has grown."""
    if quoted:
        end = _REST.match(piece)
        if not end:
            return True, 0
        piece = piece[end.end():]
    if '"' in piece:
        piece = _WHOLE.sub("", piece)
    quoted = '"' in piece
    if quoted:
        piece = piece[:piece.index('"')]
    return quoted, piece.count("[") + piece.count("{") - piece.count("]") - piece.count("}")


def _quotes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the quotes that no backslash escapes, and of the backslashes."""
    quotes, backs = np.flatnonzero(data == _QUOTE), np.flatnonzero(data == _BACK)
    if len(backs) and len(quotes):
        # of each backslash the first of its run; a quote after a run of odd length is escaped
        first = np.maximum.accumulate(np.where(np.diff(backs, prepend=-2) == 1, 0, backs))
        before = np.searchsorted(backs, quotes) - 1
        touched = (before >= 0) & (backs[before] == quotes - 1)
        quotes = quotes[~(touched & ((quotes - first[before]) % 2 == 1))]
    return quotes, backs


def _outside(quotes: np.ndarray, at: np.ndarray, quoted: bool) -> np.ndarray:
    """Which of the positions stand outside strings."""
    return (np.searchsorted(quotes, at) + quoted) % 2 == 0


def _strings(data: np.ndarray, quoted: bool) -> np.ndarray:
    """Positions of the quotes that open and close strings; outside strings a backslash escapes nothing."""
    quotes, backs = _quotes(data)
    if not _outside(quotes, backs, quoted).any():
        return quotes
    text, at, found = data.tobytes().decode("latin-1"), 0, []
    if quoted:
        end = _REST.match(text)
        if not end:
            return np.array([], np.int64)
        found.append(end.end() - 1)
        at = end.end()
    for m in _WHOLE.finditer(text, at):
        found += [m.start(), m.end() - 1]
        at = m.end()
    rest = text.find('"', at)
    return np.array([*found, rest] if rest >= 0 else found, np.int64)


def _pieces(spark: SparkSession, path: str, border: str) -> DataFrame:
    rows = spark.read.option("lineSep", border).text(path)
    return rows.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))


def _by_range(batches: Iterator[pa.RecordBatch], border: bytes) -> Iterator[tuple[tuple[str, int], Iterator[np.ndarray]]]:
    """The bytes of each range, batch by batch; all but the first of a file begin with the border before them."""
    def chunks() -> Iterator[tuple[tuple[str, int], np.ndarray]]:
        last = None
        for batch in batches:
            values, files, blocks = batch.columns
            if not len(values):
                continue
            change = np.diff(blocks.to_numpy()) != 0
            change |= np.isin(np.arange(1, len(values)), pc.run_end_encode(files).run_ends.to_numpy())
            edges = [0, *(np.flatnonzero(change) + 1), len(values)]
            for a, b in zip(edges, edges[1:], strict=False):
                key = (files[a].as_py(), blocks[a].as_py())
                pieces = values.slice(a, b - a).cast(pa.binary()).to_pylist()
                if key == last or key[1] > 0:
                    pieces.insert(0, b"")
                last = key
                yield key, np.frombuffer(border.join(pieces), np.uint8)

    for key, group in groupby(chunks(), key=lambda c: c[0]):
        yield key, (data for _, data in group)


def _measurer(border: bytes):
    """(file, block, ends0, grows0, ends1, grows1, opens) of each range."""
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for (file, block), chunks in _by_range(batches, border):
            states, depths, opens = [False, True], [0, 0], None
            for data in chunks:
                if opens is None:
                    opens = block == 0 and _OPENS.match(data) is not None
                marks = np.flatnonzero(_GROWS[data])
                for i in (0, 1):
                    quotes = _strings(data, states[i])
                    depths[i] += int(_GROWS[data[marks[_outside(quotes, marks, states[i])]]].sum())
                    states[i] = (len(quotes) + states[i]) % 2 == 1
            out.append((file, block, states[0], depths[0], states[1], depths[1], opens))
        names = ["file", "block", "ends0", "grows0", "ends1", "grows1", "opens"]
        kinds = [pa.string(), pa.int64(), pa.bool_(), pa.int64(), pa.bool_(), pa.int64(), pa.bool_()]
        columns = list(zip(*out, strict=True)) or [()] * 7
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)

    return measure


def _bare(text: bytes, before: int, after: int) -> str:
    """An element without the brackets of the array; ``before`` and ``after`` are the depths at its ends."""
    out = text.decode()
    if before <= 0:
        out = out.lstrip(_BLANK).removeprefix("[")
    return out.rstrip().removesuffix("]") if after <= 0 else out


def _cutter(starts: dict[tuple[str, int], tuple[bool, int, bool]], border: bytes, whole: bool):
    """The elements that lie in one range as (file, text), or the fragments of the others with (block, part, begins).

    ``starts``: quote and depth at the start of each range of sound files, and whether it is the last of its file.
    """
    names, kinds = ["file", "text"], [pa.string(), pa.string()]
    if not whole:
        names, kinds = [*names, "block", "part", "begins"], [*kinds, pa.int64(), pa.int64(), pa.bool_()]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) or [()] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)

    def between(file: str, data: np.ndarray, cuts: np.ndarray, levels: np.ndarray) -> pa.RecordBatch:
        """The elements between successive commas."""
        n = len(cuts) - 1
        if (levels != 1).any():  # arrays one after the other
            ends = zip(cuts, cuts[1:], levels, levels[1:], strict=False)
            return batch([(file, _bare(data[a + 1:b].tobytes(), before, after)) for a, b, before, after in ends])
        text = np.delete(data[cuts[0] + 1:cuts[-1]], cuts[1:-1] - cuts[0] - 1)
        offsets = (cuts - cuts[0] - np.arange(n + 1)).astype(np.int32)
        texts = pa.StringArray.from_buffers(n, pa.py_buffer(offsets), pa.py_buffer(text))
        return pa.RecordBatch.from_arrays([pa.repeat(file, n), texts], names=names)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (file, block), chunks in _by_range(batches, border):
            if (file, block) not in starts:  # of a broken file
                continue
            quoted, depth, last = starts[file, block]
            begins, part, level, held = block == 0, 0, depth, []

            def ended(after: int, closes: bool) -> list[tuple]:
                """What is held, if it is asked for: an element, or a fragment of one."""
                if whole != (begins and closes):
                    return []
                text = _bare(b"".join(held), level if begins else 1, after)  # noqa: B023
                return [(file, text) if whole else (file, text, block, part, begins)]  # noqa: B023

            for data in chunks:
                quotes = _strings(data, quoted)
                marks = np.flatnonzero(_MARKS[data])
                marks = marks[_outside(quotes, marks, quoted)]
                depths = depth + np.cumsum(_GROWS[data[marks]], dtype=np.int64)
                commas = (data[marks] == _COMMA) & (depths <= 1)
                cuts, levels = marks[commas], depths[commas]
                if len(cuts):
                    held.append(data[:cuts[0]].tobytes())
                    if found := ended(levels[0], True):
                        yield batch(found)
                    if whole and len(cuts) > 1:
                        yield between(file, data, cuts, levels)
                    begins, part, level, held = True, part + len(cuts), levels[-1], []
                    data = data[cuts[-1] + 1:]
                held.append(data.tobytes())
                quoted = (len(quotes) + quoted) % 2 == 1
                depth = int(depths[-1]) if len(depths) else depth
            if found := ended(depth, last):
                yield batch(found)

    return cut


def array_elements(spark: SparkSession, path: str, border: str = ",") -> tuple[DataFrame, DataFrame]:
    """(file, text) of the elements of sound files, and (file, ranges, sound) of every file.

    ``border`` ends with a comma and holds neither quotes nor backslashes.  Files are split where it stands; a longer one
    makes fewer, larger pieces, but the elements are the same with any.
    """
    pieces, sep = _pieces(spark, path, border), border.encode()
    effects = pieces.mapInArrow(
        _measurer(sep), "file string, block long, ends0 boolean, grows0 long, ends1 boolean, grows1 long, opens boolean")
    starts: dict[tuple[str, int], tuple[bool, int, bool]] = {}
    report = []
    # one row for each range of a file, as many as Spark plans tasks for
    for file, found in groupby(sorted(effects.collect()), key=lambda r: r["file"]):
        quoted, depth, ranges = False, 0, list(found)
        for r in ranges:
            starts[file, r["block"]] = (quoted, depth, r is ranges[-1])
            depth += r["grows1"] if quoted else r["grows0"]
            quoted = r["ends1"] if quoted else r["ends0"]
        report.append((file, len(ranges), ranges[0]["opens"] and depth == 0 and not quoted))
    files = spark.createDataFrame(report, "file string, tranches int, lisible boolean")
    sound = {file for file, _, good in report if good}
    starts = {key: state for key, state in starts.items() if key[0] in sound}
    # the same scan as before, broken files too: a scan of fewer files would be cut into other ranges
    whole = pieces.mapInArrow(_cutter(starts, sep, True), "file string, text string")
    cut = pieces.mapInArrow(_cutter(starts, sep, False), "file string, text string, block long, part long, begins boolean")
    order = Window.partitionBy("file").orderBy("block", "part")
    cut = cut.withColumn("of", F.sum(F.col("begins").cast("int")).over(order))
    joined = cut.groupBy("file", "of").agg(F.sort_array(F.collect_list(F.struct("block", "part", "text"))).alias("found"))
    joined = joined.select("file", F.array_join(F.transform("found", lambda x: x["text"]), "").alias("text"))
    return whole.unionByName(joined).where(F.trim("text", F.lit(" \t\r\n")) != ""), files


def read_json_arrays(
    spark: SparkSession, path: str, schema: T.StructType, corrupt: str = "_corrupt_record", border: str = ","
) -> tuple[DataFrame, DataFrame]:
    """Elements as rows, what does not fit the schema with the corrupt column filled; and the files with their state.

    The rows are stored in the shared folder, so files are cut and parsed once however often the rows are read.
    """
    elements, files = array_elements(spark, path, border)
    wanted = T.StructType([*schema.fields, T.StructField(corrupt, T.StringType())])
    rows = elements.select(F.from_json("text", wanted, {"columnNameOfCorruptRecord": corrupt}).alias("r")).select("r.*")
    stored = shared_dir(spark, "elements")
    rows.write.parquet(stored)
    return spark.read.schema(rows.schema).parquet(stored), files
