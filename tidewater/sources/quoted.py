"""Quoted CSV read in as many tasks as its files have splits (A2).

A line break inside quotes doesn't end a record, so whether a line begins a
record depends on everything before it. What comes before has one bit of state,
though: a line begins inside a quoted field or outside of one. So

1. every split is scanned from both states at once and gives two bits, the state
   in which the split's last line ends for either state of its first;
2. one such row for each split (as many as the driver held when it planned the
   scan) is combined in file order, which tells in which state each split begins;
3. every split is read again and cut into records, the lines of a record joined
   with the line breaks that they had. Only records that go on in the next split
   are exchanged: their pieces, one or two for each such split, are written to
   the staging folder (one more scan, where there are any) and meet by (file,
   record);
4. records are parsed by ``from_csv``.

The states follow RFC 4180: a field that begins with a quote ends at the next
quote that isn't doubled; quotes elsewhere are ordinary characters, so a stray
quote in an unquoted field harms nothing. A record that the file's end cuts off
inside quotes, or whose pieces come to more than ``MAX_RECORD`` characters (an
unclosed quote swallows the rest of its file), becomes rejects, piece by piece.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidewater.session import staging_path

CORRUPT = "_corrupt_record"
#: Characters of a record that goes over several splits, beyond which its pieces are rejected.
MAX_RECORD = 64 << 20
WHOLE, HEAD, MIDDLE, TAIL = 0, 1, 2, 3      # pieces of a split's records

# a complete field, up to its comma or the line's end
_FIELD = r'(?:"(?:[^"]|"")*+"[^,]*+|[^",][^,]*+|)'
_OPENS = re.compile(rf'(?:{_FIELD},)*+"(?:[^"]|"")*+')
_CLOSES = re.compile(r'(?:[^"]|"")*+"[^,]*+(,?)')


def ends_inside(line: str, inside: bool) -> bool:
    """Whether a line that begins inside a quoted field or outside ends inside one."""
    if '"' not in line:
        return inside
    at = 0
    if inside:
        closed = _CLOSES.match(line)
        if not closed:
            return True
        if not closed[1]:
            return False
        at = closed.end()
    return _OPENS.fullmatch(line, at) is not None


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, pa.StringArray]]:
    """The lines of each split, in order, a batch's at a time."""
    for batch in batches:
        if not batch.num_rows:
            continue
        file = batch.column(0).dictionary_encode()
        block, which = batch.column(1).to_numpy(), file.indices.to_numpy()
        cuts = np.flatnonzero((np.diff(block) != 0) | (np.diff(which) != 0)) + 1
        for lo, hi in zip([0, *cuts], [*cuts, len(block)], strict=True):
            yield file.dictionary[int(which[lo])].as_py(), int(block[lo]), batch.column(2).slice(lo, hi - lo)


class Lines:
    """Lines and what tells their states. As long as each quote that would open a field
    stands where one may (at a field's beginning, or behind the quote that it doubles),
    every quote changes the state and their number tells it. Where one doesn't,
    ``STEP`` lines are read one by one."""

    STEP = 1024

    def __init__(self, values: pa.StringArray):
        self.values = values
        wide = pa.types.is_large_string(values.type)
        _, offsets, data = values.buffers()
        at = np.frombuffer(offsets, np.int64 if wide else np.int32)[values.offset:values.offset + len(values) + 1]
        text = np.frombuffer(data or b"", np.uint8)
        quotes = np.flatnonzero(text[at[0]:at[-1]] == ord('"')) + int(at[0])
        before = text[quotes - 1]               # of a line's first quote: not looked at
        first = at[np.searchsorted(at, quotes, "right") - 1] == quotes
        self.may_open = first | (before == ord(",")) | (before == ord('"'))
        self.seen = np.searchsorted(quotes, at)     # quotes before each line, and in all

    def after(self, inside: bool) -> np.ndarray:
        """Whether each line ends inside a quoted field, if the first begins inside
        (or outside)."""
        out = np.empty(len(self.values), bool)
        for lo in range(0, len(out), self.STEP):
            hi = min(lo + self.STEP, len(out))
            start, end = self.seen[lo], self.seen[hi]
            if self.may_open[start + inside:end:2].all():
                out[lo:hi] = (self.seen[lo + 1:hi + 1] - start + inside) % 2
            else:
                state = inside
                for k, line in enumerate(self.values.slice(lo, hi - lo).to_pylist(), lo):
                    out[k] = state = ends_inside(line, state)
            inside = bool(out[hi - 1])
        return out


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(file, block, from_outside, from_inside) of each split."""
    found: dict[tuple[str, int], tuple[bool, bool]] = {}
    for file, block, values in _runs(batches):
        a, b = found.get((file, block), (False, True))
        lines = Lines(values)
        ends = {state: bool(lines.after(state)[-1]) for state in {a, b}}
        found[file, block] = ends[a], ends[b]
    yield _batch([(*key, *ends) for key, ends in found.items()],
                 {"file": pa.string(), "block": pa.int64(), "from_outside": pa.bool_(),
                  "from_inside": pa.bool_()})


def _batch(rows: list[tuple], types: dict[str, pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t)
                                       for k, t in enumerate(types.values())], names=list(types))


def begin_inside(scanned: list[tuple[str, int, bool, bool]]) -> tuple[set[tuple[str, int]], bool]:
    """The splits that begin inside a quoted field, and whether a file ends in one."""
    out, state, of, open_end = set(), False, None, False
    for file, block, outside, inside in sorted(scanned):
        if file != of:
            open_end, state, of = open_end or state, False, file
        if state:
            out.add((file, block))
        state = inside if state else outside
    return out, open_end or state


_PIECES = {"file": pa.string(), "block": pa.int64(), "piece": pa.int32(), "value": pa.string()}


def _cutter(inside: set[tuple[str, int]], header: bool):
    """Records of each split: whole ones (without their split, which nobody asks
    for), and the pieces that others begin or end."""
    def whole(records: pa.Array) -> pa.RecordBatch:
        n = len(records)
        return pa.RecordBatch.from_arrays(
            [pa.nulls(n, pa.string()), pa.nulls(n, pa.int64()), pa.array(np.full(n, WHOLE, np.int32)),
             records.cast(pa.string())], names=list(_PIECES))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, state, kind, skip = None, False, WHOLE, False
        parts: list[pa.StringArray] = []        # lines of a record that hasn't ended

        def end() -> list[pa.RecordBatch]:
            # a header cut off by its split's end leaves nothing
            if not parts or (skip and kind == WHOLE):
                return []
            text = "\n".join(line for p in parts for line in p.to_pylist())
            return [_batch([(*at, MIDDLE if kind == HEAD else TAIL, text)], _PIECES)]

        for file, block, values in _runs(batches):
            if at != (file, block):
                yield from end()
                at, state, parts = (file, block), (file, block) in inside, []
                kind, skip = (HEAD if state else WHOLE), header and block == 0
            states = Lines(values).after(state)
            state = bool(states[-1])
            ends = np.flatnonzero(~states) + 1
            if not len(ends):
                parts.append(values)
                continue
            held = sum(map(len, parts))
            lines = pa.concat_arrays([*parts, values.slice(0, ends[-1])])
            records = pc.binary_join(pa.ListArray.from_arrays(
                np.concatenate(([0], ends + held)).astype(np.int32), lines), "\n")
            parts = [values.slice(ends[-1])] if ends[-1] < len(values) else []
            if kind == HEAD:
                yield _batch([(file, block, HEAD, records[0].as_py())], _PIECES)
            yield whole(records.slice(1 if skip or kind == HEAD else 0))
            kind, skip = WHOLE, False
        yield from end()
    return cut


def quoted_records(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """(value, broken): the records of the files at ``path``, line breaks inside
    quotes included, without blank ones and (``header``) each file's first.
    ``broken`` marks pieces of records that can't be put together."""
    lines = (spark.read.option("lineSep", "\n").text(path)
             .select(F.col("_metadata.file_path").alias("file"),
                     F.col("_metadata.file_block_start").alias("block"), "value"))
    scanned = [tuple(r) for r in lines.mapInArrow(
        _scan, "file string, block long, from_outside boolean, from_inside boolean").collect()]
    inside, open_end = begin_inside(scanned)
    cut = lines.mapInArrow(_cutter(inside, header), "file string, block long, piece int, value string")
    records = cut.where(F.col("piece") == WHOLE).select("value", F.lit(False).alias("broken"))
    if inside or open_end:
        records = records.union(_joined(cut.where(F.col("piece") != WHOLE), header))
    value = F.col("value")
    return (records.withColumn("value", F.when(value.contains("\r"), F.regexp_replace(value, "\r$", ""))
                               .otherwise(value))
            .where(F.length(F.trim("value")) > 0))


def _joined(pieces: DataFrame, header: bool) -> DataFrame:
    """The records that go over several splits. At most two rows for each split
    that begins or ends inside one are written, numbered and put together."""
    path = staging_path(pieces.sparkSession, "record-pieces")
    pieces.write.parquet(path)
    pieces = pieces.sparkSession.read.schema(pieces.schema).parquet(path)
    # in file order (a split's head before its tail) every tail begins a record
    order = (Window.partitionBy("file").orderBy("block", "piece")
             .rowsBetween(Window.unboundedPreceding, 0))
    keys = (pieces.select("file", "block", "piece", F.length("value").alias("size"))
            .withColumn("nth", F.count(F.when(F.col("piece") == TAIL, 1)).over(order)))
    if header:
        keys = keys.where("nth > 0")        # what comes before the first is the header's end
    fits = (keys.groupBy("file", "nth")
            .agg((F.max(F.col("piece") == HEAD) & (F.sum("size") <= MAX_RECORD)).alias("fits")))
    placed = pieces.join(keys.join(fits, ["file", "nth"]).drop("size"), ["file", "block", "piece"])
    whole = (placed.where("fits").groupBy("file", "nth")
             .agg(F.sort_array(F.collect_list(F.struct("block", "value"))).alias("parts"))
             .select(F.array_join(F.col("parts.value"), "\n").alias("value"),
                     F.lit(False).alias("broken")))
    return whole.union(placed.where("NOT fits").select("value", F.lit(True).alias("broken")))


def parse_records(records: DataFrame, schema: StructType) -> DataFrame:
    """The fields of ``records`` (value, broken) by ``schema``, and in the corrupt
    record column the record itself where it doesn't fit."""
    full = StructType([*schema.fields, StructField(CORRUPT, StringType(), True)])
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in full.fields)
    parsed = records.select("value", "broken", F.from_csv("value", ddl, {
        "quote": '"', "escape": '"', "multiLine": "true", "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": CORRUPT}).alias("r"))
    wrong = F.col("broken") | F.col(f"r.{CORRUPT}").isNotNull()
    return parsed.select(*[F.col(f"r.{c}").alias(c) for c in schema.fieldNames()],
                         F.when(wrong, F.col("value")).alias(CORRUPT))


def read_quoted(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Rows of a quoted CSV delivery by ``schema``, and ``_corrupt_record``."""
    return parse_records(quoted_records(spark, path), schema)
