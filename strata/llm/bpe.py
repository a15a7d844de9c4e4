"""BPE encoding and decoding (operator 13): forced-boundary splitting.

A text is cut wherever two neighbouring bytes stand inside no vocabulary token
(``vocab.Cutter``: there no merge can cross, and the vocabulary's pattern cannot
tell). Fragments are encoded by themselves, each distinct short one once a worker,
and their ids concatenated. Special tokens in a text are found first, as the
tokenizers library does. Decoding joins the bytes of the ids and reads them as UTF-8.

Rows are independent: one pass over the scan, no shuffle. A long text is worked
through in blocks of about a megabyte that end at a cut, so a task holds one text
and one block of ids. Only a stretch without any cut (a million spaces) is encoded
in one piece.

Defined cases: a null or empty text has no tokens and decodes to the empty text;
null ids decode to null; ids beyond the vocabulary and null ids in an array decode
to nothing; repeated rows are rows of their own; other columns pass through
(``encode`` replaces columns named n_tokens or ids, ``decode`` one named decoded).
"""

from __future__ import annotations

import codecs
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from strata.llm.vocab import ByteLevel

ROWS = 256  # texts unpacked at a time
_VOCABULARIES: dict = {}


def vocabulary(folder: str | None = None) -> ByteLevel:
    """The 50k byte-level vocabulary, read once per Python worker."""
    if folder not in _VOCABULARIES:
        _VOCABULARIES[folder] = ByteLevel(folder)
    return _VOCABULARIES[folder]


def decoded(vocab: ByteLevel, blocks: Iterator[bytes]) -> Iterator[str]:
    """Text of packed ids; bytes that are not UTF-8 become replacement characters."""
    reader, tokens = codecs.getincrementaldecoder("utf-8")("replace"), vocab.tokens
    for ids in blocks:
        yield reader.decode(b"".join([tokens[i] for i in np.frombuffer(ids, "<u4").tolist()]))
    yield reader.decode(b"", final=True)


def _small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for k in range(0, b.num_rows, ROWS):
            yield b.slice(k, ROWS)


def encode(docs: DataFrame, folder: str | None = None, text: str = "text") -> DataFrame:
    """``docs`` with n_tokens and ids (array of int)."""
    docs = docs.drop("n_tokens", "ids")
    schema = StructType([*docs.schema, StructField("n_tokens", LongType()), StructField("ids", ArrayType(IntegerType(), False))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(folder)
        for b in _small(batches):
            packed = [b"".join(vocab.encoded((t.as_py() or "").encode())) for t in b.column(text)]
            ends = np.cumsum([0, *[len(p) // 4 for p in packed]])
            values = pa.array(np.frombuffer(b"".join(packed), "<u4").astype(np.int32))
            ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.diff(ends), pa.int64()), ids], names=schema.names)

    return docs.mapInArrow(run, schema)


def decode(rows: DataFrame, folder: str | None = None, ids: str = "ids") -> DataFrame:
    """``rows`` with ``decoded``: the text of the array of ids."""
    rows = rows.drop("decoded")
    schema = StructType([*rows.schema, StructField("decoded", StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(folder)
        size = len(vocab.tokens)
        for b in _small(batches):
            out = []
            for row in b.column(ids):
                row = row.as_py()
                known = None if row is None else np.array([i for i in row if i is not None and 0 <= i < size], "<u4").tobytes()
                out.append(None if known is None else "".join(decoded(vocab, iter([known]))))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.string())], names=schema.names)

    return rows.mapInArrow(run, schema)


def digest(docs: DataFrame, folder: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every text; ids and decoded texts stay in their task."""
    schema = StructType([docs.schema["doc_id"], StructField("n_tokens", LongType()), StructField("ids_sha256", StringType()), StructField("decoded_sha256", StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(folder)
        for b in _small(batches):
            counts, ids_sha, text_sha = [], [], []
            for t in b.column(1):
                ids, text, n = hashlib.sha256(), hashlib.sha256(), 0

                def blocks():
                    nonlocal n
                    for block in vocab.encoded((t.as_py() or "").encode()):
                        ids.update(block)
                        n += len(block) // 4
                        yield block

                for part in decoded(vocab, blocks()):
                    text.update(part.encode())
                counts.append(n)
                ids_sha.append(ids.hexdigest())
                text_sha.append(text.hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(counts, pa.int64()), pa.array(ids_sha), pa.array(text_sha)], names=schema.names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)
