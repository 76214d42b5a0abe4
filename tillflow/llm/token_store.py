"""Token ids of a corpus as binary files with Elias-Fano document boundaries.

A store is a folder of shards plus a manifest table.  A shard holds a run of
documents in ascending ``doc_id`` order (nulls first) in two files:

* ``ids-*.bin``: all ids, little-endian, 16 bits each where the vocabulary
  allows, else 32, with nothing between the documents;
* ``index-*.ef``: a header and two Elias-Fano sequences, the document ends in
  that array and the document ids less the smallest.

A monotone sequence of ``n`` values below ``u`` takes ``n * (2 + log2(u / n))``
bits: the low bits are packed, the high bits are gaps in unary.  ``select``
finds the i-th set bit through one 32-bit count per 512 bits, so offsets come
from the compressed form without a table of 64-bit offsets.

The sort is a range shuffle, each task streams one shard and keeps only the
boundaries of that shard in memory.  A task names its files afresh on each
attempt and reports them in its row of the manifest, so a lost executor or a
speculative attempt leaves unused files, never wrong ones.
"""

from __future__ import annotations

import functools
import re
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillflow.llm.shared import new_folder, ship, slices

END_ID = 2
BLOCK = 512
HEADER = "<8sBBxxxxxxqQQ"  # magic, id bytes, null ids flag, least id, documents, nulls
MAGIC = b"TOKSEF01"
READ_BYTES = 8 << 20
KNOWN_BYTES = 32 << 20
JOINED_BYTES = 1 << 16

MANIFEST = ("first_id long, last_id long, documents long, tokens long, ids_file string, "
            "index_file string")
DOCUMENTS = "doc_id long, start long, n_tokens long, ids_crc32 long"


# ---------------------------------------------------------------- Elias-Fano

def ef_encode(values: np.ndarray) -> bytes:
    """Bytes of an ascending sequence of unsigned 64-bit values."""
    values = np.asarray(values, dtype=np.uint64)
    n = len(values)
    top = int(values[-1]) if n else 0
    low_bits = max(0, (top // n).bit_length() - 1) if n else 0
    low = np.zeros(0, np.uint8)
    if n and low_bits:
        shifts = np.arange(low_bits, dtype=np.uint64)
        parts = [np.packbits(((values[i:i + 65536, None] >> shifts) & np.uint64(1)).astype(np.uint8),
                             bitorder="little") for i in range(0, n, 65536)]
        low = np.concatenate(parts)  # 65536 rows fill whole bytes whatever the width
    high = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
    size = (int(high[-1]) + 1 if n else 0) + 7 >> 3
    size += -size % (BLOCK // 8)
    bits = np.zeros(size, np.uint8)
    np.bitwise_or.at(bits, high >> 3, (1 << (high & 7)).astype(np.uint8))
    return struct.pack("<QBQ", n, low_bits, size) + low.tobytes() + bits.tobytes()


class EliasFano:
    """Read access by position; the sequence stays compressed."""

    def __init__(self, data: memoryview, at: int = 0):
        self.n, self.low_bits, size = struct.unpack_from("<QBQ", data, at)
        at += struct.calcsize("<QBQ")
        width = self.n * self.low_bits + 7 >> 3
        self.low = np.frombuffer(data, np.uint8, width, at)
        self.high = np.frombuffer(data, np.uint8, size, at + width)
        self.end = at + width + size
        ones = np.bitwise_count(self.high).reshape(-1, BLOCK // 8).sum(axis=1, dtype=np.uint32)
        self.before = np.concatenate([np.zeros(1, np.uint32), np.cumsum(ones, dtype=np.uint32)])

    def select(self, begin: int, end: int) -> np.ndarray:
        """Values at positions ``begin`` to ``end`` (exclusive), as uint64."""
        if begin >= end:
            return np.zeros(0, np.uint64)
        first = int(np.searchsorted(self.before, begin, side="right")) - 1
        last = int(np.searchsorted(self.before, end - 1, side="right"))
        step = BLOCK // 8
        bits = np.unpackbits(self.high[first * step:last * step], bitorder="little")
        skip = begin - int(self.before[first])
        places = np.flatnonzero(bits)[skip:skip + end - begin] + first * BLOCK
        high = (places - np.arange(begin, end)).astype(np.uint64) << np.uint64(self.low_bits)
        if not self.low_bits:
            return high
        bit = np.arange(begin * self.low_bits, end * self.low_bits)
        flags = (self.low[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1
        weights = np.uint64(1) << np.arange(self.low_bits, dtype=np.uint64)
        return high + (flags.reshape(-1, self.low_bits) * weights).sum(axis=1, dtype=np.uint64)


# ------------------------------------------------------------------ encoding

class Encoder:
    """Whole-text ids of a file of the tokenizers library.

    The pre-tokenizer of a byte-level BPE never joins characters across the point
    before a space that a non-space follows.  Texts are cut there.  The pieces of a
    block of texts that are not known yet are joined again, each once, and go to the
    library as a few texts; as every id stands for a fixed number of bytes, sums of these
    tell where a piece ends.  First pieces, texts that hold a special token
    and tokenizers of another kind go to the library as they are.
    """

    # A space before another blank is no place to cut; such texts take the slower cut.
    BLANKS = re.findall(r"\s", "".join(map(chr, range(0x3001))))
    CUT = re.compile(r" (?=\S)")
    # A single mark that closes a piece is never joined to the letter before it.
    MARKED = r"[A-Za-zÀ-ÖØ-öø-ÿ][.,;:!?]\z"

    def __init__(self, path: str):
        import json

        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        wide = self.tokenizer.get_vocab_size(with_added_tokens=True) > 1 << 16
        self.code = "I" if wide else "H"
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        pre = spec["pre_tokenizer"] or {}
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.local = (spec["normalizer"] is None and pre.get("type") == "ByteLevel"
                      and pre.get("use_regex", True) and not pre.get("add_prefix_space", True)
                      and not any(re.search(r"\s", t) for t in self.special))
        self.slow_cut = f" [{''.join(self.BLANKS)}]| \\z"
        # A byte-level vocabulary writes each byte as one character.
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.id_bytes = np.zeros(max(vocabulary.values(), default=0) + 1, np.int64)
        self.id_bytes[list(vocabulary.values())] = [len(token) for token in vocabulary]
        self.known = pa.array([], pa.large_string())
        self.known_ids = pa.array([], pa.large_binary())
        self.last_use, self.blocks = np.zeros(0, np.int64), 0

    def whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return array(self.code, ids).tobytes()

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian bytes of ``self.code``."""
        return self.encode_all(pa.array([text]))[0]

    def encode_all(self, texts: pa.Array) -> list[bytes]:
        """``encode`` of each text of a column without nulls."""
        ids, ends = self.encode_block(texts)
        ids, ends = ids.to_pybytes(), ends.tolist()
        return [ids[begin:end] for begin, end in zip([0, *ends[:-1]], ends)]

    def encode_block(self, texts: pa.Array, closing: bytes = b"") -> tuple[pa.Buffer, np.ndarray]:
        """The ids of all texts of a column without nulls, ``closing`` after each, and the
        places where the texts end, both in bytes.
        """
        if not len(texts):
            return pa.py_buffer(b""), np.zeros(0, np.int64)
        texts = texts.cast(pa.large_string())
        apart = np.full(len(texts), not self.local)
        for token in self.special:
            apart |= pc.match_substring(texts, token).to_numpy(zero_copy_only=False)
        others = [self.whole(text) for text in texts.filter(pa.array(apart)).to_pylist()]
        lists = self._cut(pc.if_else(pa.array(apart), pa.scalar("", pa.large_string()), texts))
        begin = lists.offsets.to_numpy()
        begin, pieces = begin - begin[0], lists.flatten()
        later = np.ones(len(pieces), bool)
        later[begin[:-1]] = False
        coded = pieces.filter(pa.array(later)).dictionary_encode()
        firsts = pieces.take(pa.array(begin[:-1])).dictionary_encode()
        # One run of ids a piece; a text that stays whole is one empty first piece by now.
        heads = [self.whole(piece) if piece else b"" for piece in firsts.dictionary.to_pylist()]
        runs = pa.concat_arrays([self._ids_of(coded.dictionary),
                                 pa.array([*heads, *others, closing], pa.large_binary())])
        head_at = len(coded.dictionary)
        chosen = np.empty(len(pieces), np.int64)
        chosen[later] = coded.indices.to_numpy()
        first = firsts.indices.to_numpy() + head_at
        first[apart] = np.arange(len(others)) + head_at + len(heads)
        chosen[~later] = first
        if closing:
            chosen = np.insert(chosen, begin[1:], len(runs) - 1)
            begin = begin + np.arange(len(begin))
        taken = runs.take(pa.array(chosen))
        ends = np.frombuffer(taken.buffers()[1], np.int64)[begin[1:] + taken.offset]
        return taken.buffers()[2].slice(0, int(ends[-1])), ends

    def _cut(self, texts: pa.Array) -> pa.Array:
        """Lists of the pieces of each text, without the spaces between them; none is empty
        but the first."""
        slow = pc.match_substring_regex(texts, self.slow_cut)
        lists = pc.split_pattern(texts.filter(pc.invert(slow)), " ")
        if not pc.any(slow).as_py():
            return lists
        cut = [self.CUT.split(text) for text in texts.filter(slow).to_pylist()]
        order = np.argsort(np.argsort(slow.to_numpy(zero_copy_only=False), kind="stable"))
        return pa.concat_arrays([lists, pa.array(cut, lists.type)]).take(pa.array(order))

    def _ids_of(self, pieces: pa.Array) -> pa.Array:
        """The ids of each of these distinct pieces after a space, made of those of its
        stem and of its closing mark."""
        marked = pc.match_substring_regex(pieces, self.MARKED)
        none = pa.scalar("", pa.large_string())
        stems = pc.if_else(marked, pc.utf8_slice_codeunits(pieces, 0, -1), pieces).dictionary_encode()
        marks = pc.if_else(marked, pc.utf8_slice_codeunits(pieces, -1), none).dictionary_encode()
        ends = [self.whole(mark) if mark else b"" for mark in marks.dictionary.to_pylist()]
        return pc.binary_join_element_wise(self._ids_of_stems(stems.dictionary).take(stems.indices),
                                           pa.array(ends, pa.large_binary()).take(marks.indices),
                                           pa.scalar(b"", pa.large_binary()))

    def _ids_of_stems(self, pieces: pa.Array) -> pa.Array:
        """The ids of each of these distinct strings after a space.

        Known ones are looked up.  When they pass KNOWN_BYTES, those used last stay, up
        to half of it.
        """
        found = pc.index_in(pieces, value_set=self.known)
        missing = found.is_null()
        new = pieces.filter(missing)
        at = found.fill_null(0).to_numpy().astype(np.int64)
        at[missing.to_numpy(zero_copy_only=False)] = np.arange(len(new)) + len(self.known)
        if len(new):
            self.known = pa.concat_arrays([self.known, new])
            self.known_ids = pa.concat_arrays([self.known_ids, self._joined(new)])
            self.last_use = np.append(self.last_use, np.zeros(len(new), np.int64))
        self.blocks += 1
        self.last_use[at] = self.blocks
        ids = self.known_ids.take(pa.array(at))
        if self.known.nbytes + self.known_ids.nbytes > KNOWN_BYTES:
            sizes = pc.add(pc.binary_length(self.known), pc.binary_length(self.known_ids)).to_numpy() + 16
            order = np.lexsort((sizes, -self.last_use))
            keep = np.sort(order[np.cumsum(sizes[order]) <= KNOWN_BYTES // 2])
            self.known, self.known_ids = self.known.take(pa.array(keep)), self.known_ids.take(pa.array(keep))
            self.last_use = self.last_use[keep]
        return ids

    def _joined(self, pieces: pa.Array) -> pa.Array:
        """The same from the library, for texts of about JOINED_BYTES of pieces."""
        sizes = pc.binary_length(pieces).to_numpy() + 1
        part = np.cumsum(sizes) // JOINED_BYTES
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(pieces)]
        runs = []
        for begin, end in zip(cuts, cuts[1:]):
            texts = pieces[begin:end].to_pylist()
            joined = self.tokenizer.encode_batch_fast([" " + " ".join(texts)], add_special_tokens=False)
            ids = np.array(joined[0].ids, self.code)
            id_ends = np.cumsum(self.id_bytes[ids])
            ends = np.cumsum(sizes[begin:end])
            last = np.searchsorted(id_ends, ends)
            if len(ids) and id_ends[-1] == ends[-1] and (id_ends[last] == ends).all():
                offsets = np.append(0, last + 1) * ids.itemsize
                runs.append(pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(), len(texts), [None, pa.py_buffer(offsets), pa.py_buffer(ids)]))
            else:  # a vocabulary without some byte
                runs.append(pa.array([self.whole(" " + text) for text in texts], pa.large_binary()))
        return pa.concat_arrays(runs)


@functools.lru_cache(maxsize=1)
def encoder_for(path: str) -> Encoder:
    """One encoder per Python worker: the pieces it knows serve its later tasks."""
    return Encoder(path)


# --------------------------------------------------------------- write, read

def _shard_writer(root: str, tokenizer: str, end_id: int | None):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, folder = fs.FileSystem.from_uri(root)
        encoder = None
        name = uuid.uuid4().hex
        ids_file, index_file = f"{folder}/ids-{name}.bin", f"{folder}/index-{name}.ef"
        doc_ids, ends, total, nulls, sink = array("q"), array("Q"), 0, 0, None
        for batch in slices(batches, "text"):
            if sink is None:
                encoder = encoder_for(tokenizer)
                closing = b"" if end_id is None else array(encoder.code, [end_id]).tobytes()
                width = array(encoder.code).itemsize
                sink = files.open_output_stream(ids_file)
            keys = batch.column(0)
            texts = batch.column(batch.schema.get_field_index("text")).fill_null("")
            ids, stops = encoder.encode_block(texts, closing)
            sink.write(ids)
            ends.frombytes((stops // width + total).astype(np.uint64).tobytes())
            total = ends[-1]
            nulls += keys.null_count
            doc_ids.frombytes(keys.drop_null().to_numpy().tobytes())
        if sink is None:
            return
        sink.close()
        least = doc_ids[0] if doc_ids else 0
        keys = np.array(doc_ids, np.int64).astype(np.uint64) - np.uint64(least % (1 << 64))
        with files.open_output_stream(index_file) as out:
            out.write(struct.pack(HEADER, MAGIC, width, nulls > 0, least, len(ends), nulls))
            out.write(ef_encode(np.array(ends, np.uint64)))
            out.write(ef_encode(keys))
        yield pa.RecordBatch.from_pylist(
            [{"first_id": None if nulls else least, "last_id": doc_ids[-1] if doc_ids else None,
              "documents": len(ends), "tokens": total,
              "ids_file": "ids-" + name + ".bin", "index_file": "index-" + name + ".ef"}],
            schema=pa.schema([("first_id", pa.int64()), ("last_id", pa.int64()),
                              ("documents", pa.int64()), ("tokens", pa.int64()),
                              ("ids_file", pa.string()), ("index_file", pa.string())]))

    return write


def write_store(docs: DataFrame, tokenizer: str, end_id: int | None = END_ID,
                root: str | None = None) -> str:
    """Encode ``docs`` (doc_id, text) into a new store and return its folder.

    Null texts are empty and still get the end id.  Rows with a null doc_id come
    first; repeated doc_ids are all kept, ordered by a hash of their text.  Other
    columns are ignored, whatever their names.  ``root`` must be a folder that
    Arrow's file systems reach from every executor.
    """
    spark = docs.sparkSession
    ship(spark)
    root = root or new_folder(spark, "tokens")
    files, folder = fs.FileSystem.from_uri(root)
    files.create_dir(folder, recursive=True)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce("text", F.lit("")).alias("text"))
    rows = (rows.repartitionByRange("doc_id")
            .sortWithinPartitions("doc_id", F.xxhash64("text"), "text"))
    (rows.mapInArrow(_shard_writer(root, tokenizer, end_id), MANIFEST)
     .write.parquet(f"{root}/manifest"))
    return root


def read_index(data: bytes) -> tuple[int, int, int, EliasFano, EliasFano]:
    """(id bytes, null doc_ids, least doc_id, document ends, doc_ids) of an index file."""
    magic, width, _, least, documents, nulls = struct.unpack_from(HEADER, data)
    if magic != MAGIC:
        raise ValueError("not an index of a token store")
    view = memoryview(data)
    ends = EliasFano(view, struct.calcsize(HEADER))
    keys = EliasFano(view, ends.end)
    if ends.n != documents or keys.n + nulls != documents:
        raise ValueError("damaged index")
    return width, nulls, least, ends, keys


def _shard_reader(root: str):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, folder = fs.FileSystem.from_uri(root)
        for batch in batches:
            for shard in batch.to_pylist():
                with files.open_input_file(f"{folder}/{shard['index_file']}") as source:
                    width, nulls, least, ends, keys = read_index(source.read())
                with files.open_input_stream(f"{folder}/{shard['ids_file']}") as source:
                    yield from _documents(source, shard["base"], width, nulls, least, ends, keys)

    return read


def _documents(source, base, width, nulls, least, ends, keys, step: int = 4096):
    kind = {2: "<u2", 4: "<u4"}[width]
    previous = 0
    for begin in range(0, ends.n, step):
        stop = min(ends.n, begin + step)
        stops = ends.select(begin, stop).astype(np.int64)
        starts = np.concatenate([[previous], stops[:-1]])
        previous = int(stops[-1])
        sums = []
        for size in (stops - starts) * width:
            crc, left = 0, int(size)
            while left:
                data = source.read(min(left, READ_BYTES))
                if not data:
                    raise EOFError("ids end before their index")
                left -= len(data)
                crc = zlib.crc32(np.frombuffer(data, kind).astype("<u4"), crc)
            sums.append(crc)
        absent = max(0, min(stop, nulls) - begin)
        found = keys.select(begin + absent - nulls, stop - nulls) + np.uint64(least % (1 << 64))
        doc_ids = [None] * absent + found.astype(np.int64).tolist()
        yield pa.RecordBatch.from_arrays(
            [pa.array(doc_ids, pa.int64()), pa.array(starts + base, pa.int64()),
             pa.array(stops - starts, pa.int64()), pa.array(sums, pa.int64())],
            names=["doc_id", "start", "n_tokens", "ids_crc32"])


def read_store(spark: SparkSession, root: str) -> DataFrame:
    """One row per stored document, from the files: its id, the count of ids before
    it in the whole store, its ids and their CRC-32 as 32-bit integers.  An empty
    store gives no rows.  The running sum is over the manifest, one row a shard.
    """
    ship(spark)
    shards = spark.read.schema(MANIFEST).parquet(f"{root}/manifest")
    order = Window.orderBy(F.col("first_id").asc_nulls_first(), F.col("last_id").asc_nulls_first())
    before = F.coalesce(F.sum("tokens").over(order.rowsBetween(Window.unboundedPreceding, -1)),
                        F.lit(0))
    shards = shards.select("*", before.alias("base"))
    return (shards.repartition(max(1, shards.count()))
            .mapInArrow(_shard_reader(root), DOCUMENTS))
