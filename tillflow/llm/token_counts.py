"""Token counts of whole texts, huge ones by overlapping chunks.

A text of up to ``CHUNK`` characters is encoded as it is.  A longer one becomes
chunks that overlap; Spark spreads the chunks of one text over many tasks, each
is encoded with the character offsets of its tokens, and neighbours are spliced
at a boundary that both have.  Only boundaries that are proven stable count:

* the model's normalizer leaves characters alone and only turns a space into the
  mark U+2581, and
* no piece of the vocabulary holds the mark after another character, so no merge
  ever crosses the point between a character and a following space.

Both are checked against the model itself (``stable``).  At such a point the
tokens on either side depend on nothing beyond it, so a cut there is exact.  If
two neighbours share no such point in their overlap, the text is chunked anew
with overlap and chunk four times as long, in the end as one chunk.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.llm.shared import ship, slices, texts_of, written

CHUNK = 32_768
OVERLAP = 1_024
LIMIT = 4_096
MARK = "▁"


def load(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


def stable(model) -> bool:
    """Whether the point before a space after another character always separates."""
    pieces = (model.id_to_piece(i) for i in range(model.get_piece_size()))
    if any(MARK in p.lstrip(MARK) for p in pieces):
        return False
    probe = "a  b \n é é ﬁ ①  c\td"
    return model.decode(model.encode(probe)) == probe


def is_boundary(text: str, at: int) -> bool:
    return 0 < at < len(text) and text[at] in " " + MARK and text[at - 1] not in " " + MARK


def _counter(path: str):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = None
        for batch in slices(batches, "text"):
            model = model or load(path)
            counts = [len(ids) for ids in model.encode(texts_of(batch), num_threads=1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(counts, pa.int64())],
                names=["doc_id", "n_bytes", "n_tokens"])

    return count


def _chunker(chunk: int, overlap: int):
    """Rows (uid, k, last, begin, text): chunk k starts ``overlap`` before its share."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 1):
            uid, text = batch.column(0)[0].as_py(), batch.column(1)[0].as_py()
            starts = list(range(0, max(1, len(text) - overlap), chunk))
            for k, start in enumerate(starts):
                last = k == len(starts) - 1
                begin = max(0, start - overlap)
                part = text[begin:] if last else text[begin:start + chunk + overlap]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([uid], pa.string()), pa.array([k], pa.int32()),
                     pa.array([last]), pa.array([begin], pa.int64()),
                     pa.array([part], pa.string())],
                    names=["uid", "k", "last", "begin", "text"])

    return cut


def _chunk_encoder(path: str, overlap: int):
    """Rows (uid, seam, side, total, last, marks): the stable token boundaries of a
    chunk within one seam, as (absolute offset, tokens of the chunk before it)."""
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sure = None
        for batch in slices(batches, "text", 1):
            if model is None:
                model = load(path)
                sure = stable(model)
            row = {n: batch.column(i)[0].as_py() for i, n in enumerate(batch.schema.names)}
            text, begin, k = row["text"], row["begin"], row["k"]
            pieces = model.encode(text, return_type="proto").pieces
            raw = np.frombuffer(text.encode(), np.uint8)
            to_char = np.append(np.cumsum((raw & 0xC0) != 0x80) - 1, len(text))  # offsets are bytes
            starts = to_char[[p.begin for p in pieces]].tolist()
            marks = [(begin + s, n) for n, s in enumerate(starts)
                     if is_boundary(text, s)] if sure else []
            seams = []
            if k:
                seams.append((k - 1, False, [m for m in marks if m[0] < begin + 2 * overlap]))
            if not row["last"]:
                edge = begin + len(text) - 2 * overlap
                seams.append((k, True, [m for m in marks if m[0] >= edge]))
            if row["last"]:
                seams.append((-1, True, [(0, len(starts))]))
            yield pa.RecordBatch.from_pylist(
                [{"uid": row["uid"], "seam": seam, "before": side,
                  "offsets": [m[0] for m in found], "tokens": [m[1] for m in found]}
                 for seam, side, found in seams],
                schema=pa.schema([("uid", pa.string()), ("seam", pa.int32()),
                                  ("before", pa.bool_()), ("offsets", pa.list_(pa.int64())),
                                  ("tokens", pa.list_(pa.int64()))]))

    return encode


def _splice(huge: DataFrame, path: str, chunk: int, overlap: int) -> DataFrame:
    """(uid, n_tokens), null where two neighbours share no stable boundary.

    A seam at offset b adds the tokens of its left chunk before b and takes off
    those of its right chunk before b; the last chunk adds all of its tokens.
    """
    parts = huge.mapInArrow(_chunker(chunk, overlap),
                            "uid string, k int, last boolean, begin long, text string")
    sides = (parts.repartition("uid", "k")
             .mapInArrow(_chunk_encoder(path, overlap),
                         "uid string, seam int, before boolean, offsets array<long>, "
                         "tokens array<long>"))
    pick = lambda side, column: F.max(F.when(F.col("before") == side, F.col(column)))
    seams = sides.groupBy("uid", "seam").agg(
        pick(True, "offsets").alias("left_at"), pick(True, "tokens").alias("left_n"),
        pick(False, "offsets").alias("right_at"), pick(False, "tokens").alias("right_n"))
    meet = F.array_max(F.array_intersect("left_at", "right_at"))
    at = lambda n, where: F.element_at(n, F.array_position(where, F.col("meet")).cast("int"))
    found = (F.when(F.col("seam") == -1, F.element_at("left_n", 1))
             .when(F.col("meet").isNotNull(), at("left_n", F.col("left_at"))
                   - at("right_n", F.col("right_at"))))
    seams = seams.withColumn("meet", meet).select("uid", found.alias("part"))
    return seams.groupBy("uid").agg(
        F.when(F.count("part") == F.count(F.lit(1)), F.sum("part")).alias("n_tokens"))


def count_tokens(docs: DataFrame, model: str, chunk: int = CHUNK, overlap: int = OVERLAP,
                 limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens and over_limit of every row.

    Counts equal those of the model over the whole text, without begin or end
    tokens.  A null text is empty (0 bytes, 0 tokens); rows that repeat a doc_id or
    lack one stay rows; other columns are ignored.  ``model`` is a path that
    every executor has.
    """
    if overlap < 1 or chunk < 2 * overlap:
        raise ValueError("the chunk must hold two overlaps")
    ship(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce("text", F.lit("")).alias("text"))
    n_bytes = F.octet_length("text").cast("long").alias("n_bytes")
    short = rows.where(F.length("text") <= chunk).select("doc_id", n_bytes, "text")
    counts = short.mapInArrow(_counter(model), "doc_id long, n_bytes long, n_tokens long")
    # One row per distinct huge text: repeated ones are chunked once.
    uid = F.sha2("text", 256).alias("uid")
    huge = rows.where(F.length("text") > chunk).select("doc_id", n_bytes, uid, "text")
    left = written(huge.dropDuplicates(["uid"]).select("uid", "text"), "huge-texts")
    done = None
    while True:
        found = written(_splice(left, model, chunk, overlap), "spliced")
        fresh = found.where("n_tokens is not null")
        done = fresh if done is None else done.unionByName(fresh)
        failed = found.where("n_tokens is null").select("uid")
        if failed.isEmpty():
            break
        left = left.join(failed, "uid", "left_semi")
        chunk, overlap = 4 * chunk, 4 * overlap
    spliced = huge.drop("text").join(done, "uid").select("doc_id", "n_bytes", "n_tokens")
    return counts.unionByName(spliced).withColumn("over_limit", F.col("n_tokens") > limit)
