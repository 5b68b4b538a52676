"""Encoding and decoding of whole texts with the pair index of `tesserae.llm.bpe`.

Null text counts as empty and has no ids. Special tokens written out in a text get their ids, as in
the library. Repeated rows each have a result; other columns are not read.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame

from tesserae.llm.common import map_texts

#: Columns of coded(), by name.
COLUMNS = {"ids": "array<long>", "n_tokens": "long", "decoded": "string", "ids_sha256": "string", "decoded_sha256": "string"}
_decoders: dict = {}


def coded(docs: DataFrame, vocabulary: str, columns: tuple[str, ...] = ("ids", "decoded"), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and the named COLUMNS of each row, made in one pass: ids and their decoded text never leave
    the task unless asked for."""

    def run(ids, texts):
        from tesserae.llm.bpe import Decoder
        from tesserae.llm.tokens import WORD, encoder

        enc = encoder(vocabulary, WORD)
        if vocabulary not in _decoders:
            _decoders[vocabulary] = Decoder(enc.tokenizer)
        decode = _decoders[vocabulary].decode
        flat, offset = enc.encode(texts)
        spans = list(zip(offset.tolist(), offset.tolist()[1:]))
        decoded = [decode(flat[a:b].tolist()) for a, b in spans] if {"decoded", "decoded_sha256"} & {*columns} else []
        made = {
            "ids": lambda: pa.ListArray.from_arrays(pa.array(offset, pa.int32()), pa.array(flat.astype("int64"))),
            "n_tokens": lambda: pa.array([b - a for a, b in spans], pa.int64()),
            "decoded": lambda: pa.array(decoded, pa.string()),
            "ids_sha256": lambda: pa.array([hashlib.sha256(flat[a:b].astype("<u4").tobytes()).hexdigest() for a, b in spans], pa.string()),
            "decoded_sha256": lambda: pa.array([hashlib.sha256(t.encode()).hexdigest() for t in decoded], pa.string()),
        }
        yield pa.record_batch([ids, *(made[c]() for c in columns)], ["id", *columns])

    return map_texts(docs, run, "id long, " + ", ".join(f"{c} {COLUMNS[c]}" for c in columns), id_col, text_col)
