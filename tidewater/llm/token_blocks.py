"""Token ids in a word-aligned binary format (operator 2).

Simple-8b: the upper four bits of a 64-bit word select how many ids its other
60 bits hold and how wide they are. Selector 0 is the escape: the next word is
one id of up to 64 bits. Ids are cut into blocks of ``BLOCK`` ids; a block
starts at a word of its own, its offset is stored, so blocks decode
independently or all together with a few vector operations.

The file is a Parquet table of segments in document order. A segment holds
whole documents: their ids, lengths, the words, the block offsets, and where
its ids begin among those of its part (a range of doc_id). Spark writes it, so
a lost executor's part is written again and only committed parts count.

A null or empty text has the end id alone. Rows are ordered by doc_id (null
first), rows that repeat an id by a hash of the text; or they keep the order in
which the input comes or was written.
"""

from __future__ import annotations

import struct
import unicodedata
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.common import slices, text_bytes, text_slices
from tidewater.session import staging_path

BLOCK = 128
#: Ids after which a segment is closed (it ends with the document).
SEGMENT_IDS = 1 << 18
#: (ids, bits) by selector; 0 is the escape, 1 a run of zeros.
LAYOUT = ((0, 0), (120, 0), (60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7),
          (7, 8), (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60))
_COUNT = np.array([c for c, _ in LAYOUT])
_BITS = np.array([b for _, b in LAYOUT])
#: Words whose ids a worker remembers before it lets go of those not met again.
CACHE_WORDS = 250_000
#: Words that the library is given at a time.
UNITS = 4096
#: Marks that may end a word; those that special tokens or contractions use
#: aren't among them.
_MARKS = ".,;:!?*%$&#)"
SEGMENTS = ("part int, first_id long, doc_ids array<long>, lengths array<int>, n_ids long, "
            "words binary, blocks binary")


def encode_ids(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(words, block offsets) of unsigned 64-bit ids. Each word takes the
    widest run that fits; the blocks advance side by side."""
    n = len(ids)
    blocks = -(-n // BLOCK)
    if not n:
        return np.empty(0, np.uint64), np.empty(0, np.uint32)
    grid = np.zeros(blocks * BLOCK, np.uint64)
    grid[:n] = ids
    grid = grid.reshape(blocks, BLOCK)
    size = np.full(blocks, BLOCK)
    size[-1] = n - (blocks - 1) * BLOCK
    # bits needed by each id, from the exponent of its float; rounding can add
    # a bit to ids above 2**53, which costs room, not correctness
    bits = (grid.astype(np.float64).view(np.int64) >> 52) - 1022
    widest = np.zeros((blocks, BLOCK + max(_COUNT)), np.int8)
    widest[:, :BLOCK] = np.where(grid > 0, bits, 0)
    # choice[i]: the selector with the longest run from place i on that fits
    # (sliding maxima of the bits); zeros beyond a block's end always fit
    choice = np.zeros((blocks, BLOCK), np.int8)
    held = 1
    for s in range(len(LAYOUT) - 1, 0, -1):
        count, width = LAYOUT[s]
        if count > held:
            widest = np.maximum(widest[:, :held - count], widest[:, count - held:])
            held = count
        choice[widest[:, :BLOCK] <= width] = s
    padded = np.concatenate((grid, np.zeros((blocks, max(_COUNT)), np.uint64)), axis=1)
    at, rows, step = np.zeros(blocks, np.int64), np.arange(blocks), 0
    keys, words = [], []
    while len(rows):
        sel = choice[rows, at[rows]]
        out = sel.astype(np.uint64) << np.uint64(60)
        for s in np.unique(sel):
            of = np.flatnonzero(sel == s)
            r, p = rows[of], at[rows[of]]
            count, width = LAYOUT[s]
            if s == 0:
                keys.append(r * 512 + step + 1)
                words.append(grid[r, p])
            elif width:
                for j in range(count):
                    out[of] |= padded[r, p + j] << np.uint64(j * width)
        keys.append(rows * 512 + step)
        words.append(out)
        at[rows] += np.where(sel == 0, 1, _COUNT[sel])
        rows = rows[at[rows] < size[rows]]
        step += 2
    order = np.concatenate(keys)
    rank = np.argsort(order, kind="stable")
    block_of = order[rank] // 512
    offsets = np.searchsorted(block_of, np.arange(blocks)).astype(np.uint32)
    return np.concatenate(words)[rank], offsets


def decode_ids(words: np.ndarray, offsets: np.ndarray, n: int) -> np.ndarray:
    """The ids; all words at once."""
    if not n:
        return np.empty(0, np.uint64)
    sel = (words >> np.uint64(60)).astype(np.int64)
    if (sel == 0).any():       # the word after an escape is an id, whatever its upper bits
        raw = np.zeros(len(words), bool)
        for i in np.flatnonzero(sel == 0).tolist():
            if not raw[i]:
                raw[i + 1] = True
    else:
        raw = None
    count = _COUNT[sel]
    if raw is not None:
        count[sel == 0] = 0
        count[raw] = 1
    block = np.repeat(np.arange(len(offsets)),
                      np.diff(np.append(offsets.astype(np.int64), len(words))))
    ends = np.cumsum(count)
    first = ends - count
    word = np.repeat(np.arange(len(words)), count)
    inside = np.arange(len(word)) - first[word]
    width = _BITS[sel[word]].astype(np.uint64)
    value = (words[word] >> (inside.astype(np.uint64) * width)) & (
        (np.uint64(1) << width) - np.uint64(1))
    if raw is not None:
        value = np.where(raw[word], words[word], value)
    # drop the padding behind a block's last id
    base = first[offsets.astype(np.int64)]
    place = np.arange(len(word)) - base[block[word]]
    size = np.full(len(offsets), BLOCK)
    size[-1] = n - (len(offsets) - 1) * BLOCK
    return value[place < size[block[word]]]


def letter_table() -> list[int]:
    """Latin, Greek and Cyrillic letters, as code points. Each is its own
    composed form, no two of them compose with each other, and each lowers to
    a single letter of the table, in Arrow as in Python."""
    chars = list(map(chr, range(0x41, 0x530)))
    letters = {c for c in chars if unicodedata.category(c) in ("Ll", "Lu")
               and unicodedata.is_normalized("NFC", c)}
    lowered = pc.utf8_lower(pa.array(chars)).to_pylist()
    return [ord(c) for c, low in zip(chars, lowered, strict=True)
            if c in letters and low in letters and low == c.lower()]


class WordMemory:
    """The ids of words, as the little-endian bytes of 32-bit numbers. Words
    that aren't held are encoded together, when they are asked for."""

    def __init__(self, tokenizer):
        self.tokenizer = tokenizer
        self.words, self.ids = pa.array([], pa.string()), pa.array([], pa.large_binary())
        self.again = np.zeros(0, bool)

    def find(self, words: pa.Array) -> pa.Array:
        """The ids of each of the distinct ``words``."""
        if len(self.words) > CACHE_WORDS:
            self.turn()
        place = pc.index_in(words, value_set=self.words).fill_null(-1).to_numpy().copy()
        new = np.flatnonzero(place < 0)
        self.again[place[place >= 0]] = True
        place[new] = len(self.words) + np.arange(len(new))
        if len(new):
            added = words.take(pa.array(new))
            self.ids = pa.concat_arrays([self.ids, self.encode(added)])
            self.words = pa.concat_arrays([self.words, added])
            self.again = np.append(self.again, np.zeros(len(new), bool))
        return self.ids.take(pa.array(place))

    def turn(self) -> None:
        """Keep what was met again since the last time."""
        kept = pa.array(self.again)
        self.words, self.ids = self.words.filter(kept), self.ids.filter(kept)
        self.again = np.zeros(len(self.words), bool)

    def encode(self, words: pa.Array) -> pa.Array:
        coded = [self.tokenizer.encode(w.decode("utf-8", "replace"), add_special_tokens=False).ids
                 for w in words.cast(pa.binary()).to_pylist()]
        return pa.array([np.array(ids, "<u4").tobytes() for ids in coded], pa.large_binary())


class LetterMemory(WordMemory):
    """The ids of runs of lowered letters of the table. Each is a single unit
    of the library's model, so many are given to it at once, without the
    normaliser and the splitter; the model marks the end of each by a suffix."""

    def __init__(self, tokenizer):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel, Sequence, Split
        super().__init__(tokenizer)
        self.table = letter_table()
        self.units = Tokenizer(tokenizer.model)
        self.units.pre_tokenizer = Sequence([
            Split(" ", "removed"), ByteLevel(add_prefix_space=False, use_regex=False)])
        vocab = tokenizer.get_vocab()
        self.last = np.zeros(max(vocab.values()) + 1, bool)
        suffix = tokenizer.model.end_of_word_suffix or ""
        self.last[[i for piece, i in vocab.items() if piece.endswith(suffix)]] = True

    def encode(self, words: pa.Array) -> pa.Array:
        coded = []
        for at in range(0, len(words), UNITS):
            some = words.slice(at, UNITS)
            text = " ".join(some.to_numpy(zero_copy_only=False))
            ids = np.array(self.units.encode_batch_fast([text], add_special_tokens=False)[0].ids,
                           "<u4")
            ends = np.flatnonzero(self.last[ids]) + 1
            if len(ends) == len(some):
                coded.append(pa.Array.from_buffers(pa.large_binary(), len(some), [
                    None, pa.py_buffer(np.append(0, 4 * ends).astype("<i8")), pa.py_buffer(ids)]))
            else:                                  # a model without such a suffix
                coded.append(super().encode(some))
        return pa.concat_arrays(coded)


class WordEncoder:
    """Encodes with a tokenizer of the ``tokenizers`` library that lowers and
    composes text, splits it into runs of letters, single digits and runs of
    other marks, and drops white space. So its pieces never cross ASCII white
    space, nor the place between a letter and the marks that end a word, and
    each distinct part is given to the library once and remembered. Arrow finds
    the distinct words, so the memories are asked once for all texts given
    together. Of a memory of more than ``CACHE_WORDS`` words those met again
    are kept."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        tokenizer = Tokenizer.from_file(path)
        self.memory, self.others = LetterMemory(tokenizer), WordMemory(tokenizer)
        letters = "".join(map(chr, self.memory.table))
        self.parts = f"^(?P<core>[{letters}]+)(?P<marks>[{_MARKS}]*)$"

    def coded(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in UTF-8, where those of each begin and the last's end)."""
        split = pc.ascii_split_whitespace(texts.cast(pa.binary()).view(pa.string()))
        words = split.flatten().dictionary_encode()
        ids = self._words(words.dictionary).take(words.indices)
        ends = np.frombuffer(ids.buffers()[1], "<i8", len(ids) + 1) // 4
        bounds = ends[split.offsets.to_numpy() - split.offsets[0].as_py()]
        return np.frombuffer(ids.buffers()[2] or b"", "<u4", int(bounds[-1])), bounds

    def _words(self, words: pa.Array) -> pa.Array:
        """The ids of distinct words: those of their letters, then those of the
        marks that end them. The marks of any other word may go on with what
        is before them."""
        parts = pc.extract_regex(words, self.parts)
        core, marks = parts.flatten()              # null where the word is another
        core, marks = pc.utf8_lower(core).dictionary_encode(), marks.dictionary_encode()
        ids = pc.binary_join_element_wise(
            self.memory.find(core.dictionary).take(core.indices),
            self.others.find(marks.dictionary).take(marks.indices),
            pa.scalar(b"", pa.large_binary()))
        other = parts.is_null()
        return pc.replace_with_mask(ids, other, self.others.find(words.filter(other)))

    def arrays(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each text."""
        ids, bounds = self.coded(texts)
        return [ids[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]

    def encode(self, texts: list[bytes]) -> list[list[int]]:
        return [ids.tolist() for ids in self.arrays(pa.array(texts, pa.binary()))]

    def count(self, texts: list[bytes] | pa.Array) -> list[int]:
        if not isinstance(texts, pa.Array):
            texts = pa.array(texts, pa.binary())
        return np.diff(self.coded(texts)[1]).tolist()


_encoders: dict[str, WordEncoder] = {}


def word_encoder(path: str) -> WordEncoder:
    """One encoder per worker and path, with the library's threads off."""
    if path not in _encoders:
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def _packer(path: str, end_id: int) -> Callable:
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        encoder = word_encoder(path)
        end = np.array([end_id], np.uint32)
        doc_ids: list = []
        lengths: list[int] = []
        ids: list[np.ndarray] = []
        first = held = 0

        def segment() -> pa.RecordBatch:
            words, blocks = encode_ids(np.concatenate(ids).astype(np.uint64))
            return pa.RecordBatch.from_arrays([
                pa.array([part], pa.int32()), pa.array([first], pa.int64()),
                pa.array([doc_ids], pa.list_(pa.int64())),
                pa.array([lengths], pa.list_(pa.int32())), pa.array([held], pa.int64()),
                pa.array([words.astype("<u8").tobytes()], pa.binary()),
                pa.array([blocks.astype("<u4").tobytes()], pa.binary())],
                names=["part", "first_id", "doc_ids", "lengths", "n_ids", "words", "blocks"])

        for whole in batches:
            for batch in text_slices(whole, 1):
                coded = encoder.arrays(batch.column(1))
                for doc, found in zip(batch.column(0).to_pylist(), coded, strict=True):
                    doc_ids.append(doc)
                    lengths.append(len(found) + 1)
                    ids += (found, end)
                    held += len(found) + 1
                    if held >= SEGMENT_IDS:
                        yield segment()
                        first, held = first + held, 0
                        doc_ids, lengths, ids = [], [], []
        if doc_ids:
            yield segment()
    return pack


def input_order(docs: DataFrame) -> list[Column]:
    """Sort keys of the order in which the rows of ``docs`` come: of files that
    Spark wrote, part by part and row by row (a scan deals the files by size);
    of anything else, by partition."""
    try:
        docs.select("_metadata.file_name", "_metadata.row_index")
    except AnalysisException:
        return [F.monotonically_increasing_id()]
    name = F.col("_metadata.file_name")
    return [F.regexp_extract(name, r"^part-(\d+)", 1).try_cast("long"), name,
            F.col("_metadata.row_index")]


def write_token_file(docs: DataFrame, path: str, tokenizer: str, end_id: int = 1,
                     keep_order: bool = False) -> None:
    """Encode the whole texts of ``docs`` (doc_id, text) and write them under
    ``path`` in ascending doc_id order, or in the order of the input."""
    by = input_order(docs) if keep_order else []
    keys = [f"_{k}" for k in range(len(by))] or ["doc_id", F.xxhash64("text")]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes().alias("text"),
                       *[c.alias(f"_{k}") for k, c in enumerate(by)])
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # at least as many ranges as the scan has splits, so a range stays as small as a split
    n = max(n, docs.select("doc_id", "text").rdd.getNumPartitions())
    (rows.repartitionByRange(n, *(keys if by else keys[:1])).sortWithinPartitions(*keys)
     .select("doc_id", "text")
     .mapInArrow(_packer(tokenizer, end_id), SEGMENTS)
     .write.option("compression", "zstd").parquet(path))


def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole, 1):
            row = batch.to_pylist()[0]
            ids = decode_ids(np.frombuffer(row["words"], "<u8"), np.frombuffer(row["blocks"], "<u4"),
                             row["n_ids"]).astype("<u4")
            ends = np.cumsum([0, *row["lengths"]])
            data = memoryview(ids.tobytes())
            crc = [zlib.crc32(data[4 * a:4 * b])
                   for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
            k = len(crc)
            yield pa.RecordBatch.from_arrays([
                pa.array([row["part"]] * k, pa.int32()), pa.array(row["doc_ids"], pa.int64()),
                pa.array(ends[:-1] + row["first_id"], pa.int64()),
                pa.array(row["lengths"], pa.int64()), pa.array(crc, pa.int64())],
                names=["part", "doc_id", "inside", "n_tokens", "ids_crc32"])


def read_token_index(file: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) decoded from a token file, one row
    per document; ``start`` is the number of ids before it in the whole file."""
    totals = file.groupBy("part").agg(F.sum("n_ids").alias("ids"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # one row per part: bounded by the number of partitions that wrote the file
    bases = totals.select("part", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("base"))
    docs = file.mapInArrow(_unpack, "part int, doc_id long, inside long, n_tokens long, "
                                    "ids_crc32 long")
    return (docs.join(F.broadcast(bases), "part")
            .select("doc_id", (F.col("base") + F.col("inside")).alias("start"),
                    "n_tokens", "ids_crc32"))


def token_index(docs: DataFrame, tokenizer: str, end_id: int = 1,
                keep_order: bool = False) -> DataFrame:
    """Write the token file of ``docs`` in the shared folder and index it."""
    spark = docs.sparkSession
    path = staging_path(spark, "tokens")
    write_token_file(docs, path, tokenizer, end_id, keep_order)
    return read_token_index(spark.read.schema(SEGMENTS).parquet(path))
