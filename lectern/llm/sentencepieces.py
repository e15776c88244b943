"""SentencePiece encoding and decoding through a distinct-chunk table.

Where no piece of the model crosses a whitespace marker, the pieces of one marked word (a run of markers and what follows
up to the next marker) do not depend on its neighbours. Each task keeps a table of the distinct marked words that it has met,
has the library segment each once, and joins the ids back by position. The table is bounded; beyond the bound it starts anew,
which costs time only. Models that do cross markers, or normalise text, are run on whole texts instead.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MARK = "▁"
#: Entries of a task's table, and the longest word it keeps (code points).
TABLE_ENTRIES, TABLE_WORD = 300_000, 64
#: Rows in a batch that goes back to the JVM: they may carry ids and texts.
ROWS_BACK = 500


def marked_words(text: str) -> list[str]:
    """The marked words of a text without their first marker, which the library's dummy prefix gives back."""
    words = text.replace(MARK, " ").split(" ")
    if "" not in words:
        return words
    out, spaces = [], 0
    for w in words:
        if w:
            out.append(" " * spaces + w if spaces else w)
            spaces = 0
        else:
            spaces += 1
    if spaces:
        out.append(" " * (spaces - 1))
    return out


def _word_like(proto: bytes) -> bool:
    """Whether the model leaves text as it is and has no piece with a marker after another character."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    m = pb.ModelProto()
    m.ParseFromString(proto)
    n = m.normalizer_spec
    plain = not n.precompiled_charsmap and n.add_dummy_prefix and not n.remove_extra_whitespaces and n.escape_whitespaces and not m.trainer_spec.treat_whitespace_as_suffix
    return plain and not any(MARK in p.piece.lstrip(MARK) or p.type == pb.ModelProto.SentencePiece.USER_DEFINED for p in m.pieces)


class PieceCoder:
    """Encodes as the library does, with begin and end ids and no sampling."""

    def __init__(self, proto: bytes, entries: int = TABLE_ENTRIES):
        from sentencepiece import SentencePieceProcessor

        self.library = SentencePieceProcessor(model_proto=proto)
        self.by_word, self.entries, self.table = _word_like(proto), entries, {}
        self.begin, self.end, self.mark = (struct.pack("<I", i) for i in (self.library.bos_id(), self.library.eos_id(), self.library.piece_to_id(MARK)))

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if not text:
            return self.begin + self.end
        if not self.by_word:
            return self.begin + np.asarray(self.library.encode(text), "<u4").tobytes() + self.end
        words = marked_words(text)
        table = self.table
        table[""] = self.mark  # a single marker at the end, for which the library has no text to encode
        if new := [w for w in set(words) if w not in table]:
            if len(table) + len(new) > self.entries:
                table.clear()
                table[""] = self.mark
                new = list(set(words) - {""})
            table.update(zip(new, (struct.pack(f"<{len(ids)}I", *ids) for ids in self.library.encode(new, num_threads=1)), strict=True))
        out = b"".join([self.begin, *map(table.__getitem__, words), self.end])
        for w in new:
            if len(w) > TABLE_WORD:
                table.pop(w, None)
        return out

    def decode(self, ids: bytes) -> str:
        return self.library.decode(np.frombuffer(ids, "<u4").tolist())


def piece_codes(docs: DataFrame, model: bytes, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = True, keep_text: bool = True) -> DataFrame:
    """Per row of docs: id_col, n_tokens, ids_sha256, decoded_sha256, with keep_ids the ids (array<int>), with
    keep_text the decoded text.

    Null texts count as empty: begin and end ids only, decoded to the empty text. Repeated rows give repeated rows; an empty
    table gives an empty one; null ids stay null; other columns are ignored. Whole texts of any length are encoded.
    The model's bytes travel with the tasks, so executors need no file.
    """
    source = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = PieceCoder(model)
        kinds = {"n_tokens": pa.int64(), "ids_sha256": pa.string(), "decoded_sha256": pa.string()} | ({"ids": pa.list_(pa.int32())} if keep_ids else {}) | ({"decoded": pa.string()} if keep_text else {})
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS_BACK):
                batch = whole.slice(start, ROWS_BACK)
                rows: dict[str, list] = {k: [] for k in kinds}
                for text in batch.column(1):
                    ids = coder.encode(text.as_py() or "")
                    decoded = coder.decode(ids)
                    rows["n_tokens"].append(len(ids) // 4)
                    rows["ids_sha256"].append(hashlib.sha256(ids).hexdigest())
                    rows["decoded_sha256"].append(hashlib.sha256(decoded.encode()).hexdigest())
                    if keep_ids:
                        rows["ids"].append(np.frombuffer(ids, "<i4"))
                    if keep_text:
                        rows["decoded"].append(decoded)
                yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(v, kinds[k]) for k, v in rows.items())], names=["_id", *rows])

    schema = f"_id {source.schema['_id'].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * keep_ids + ", decoded string" * keep_text
    return source.mapInArrow(run, schema).withColumnRenamed("_id", id_col)


def default_model() -> bytes:
    import public_tokenizers

    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as f:
        return f.read()


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_codes(spark.read.parquet(f"{sf_dir}/documents.parquet"), default_model(), keep_ids=False, keep_text=False)
