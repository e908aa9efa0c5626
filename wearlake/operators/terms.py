"""Term counts of whole texts, as an Arrow function: per-bigram column expressions cost too much on long texts."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from wearlake.functions import text as tx

#: Tokens hold only letters below this code point, so that a bigram is a place in a table.
_LETTERS = 0x980
#: Texts to an output batch.
_TEXTS = 1000


def embed_term_counts(docs: DataFrame, key: str = "doc_id", column: str = "text") -> DataFrame:
    """(key, slot, n) of each row's whole text: how often its vocabulary words and character bigrams fall on a slot."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = len(tx.VOCABULARY)
        index = {w: k for k, w in enumerate(tx.VOCABULARY)}
        token, table = re.compile(tx.TOKEN), np.full(_LETTERS * _LETTERS, -1, np.int16)

        def counts(text: str | None) -> np.ndarray:
            tokens = token.findall((text or "").lower())
            at = np.frombuffer(" ".join(tokens).encode("utf-32-le"), np.uint32).astype(np.int64)
            a, b = at[:-1], at[1:]
            codes = (a * _LETTERS + b)[(a != 32) & (b != 32)]
            for c in np.unique(codes[table[codes] < 0]).tolist():
                pair = chr(c // _LETTERS) + chr(c % _LETTERS)
                table[c] = size + int(hashlib.md5(pair.encode()).hexdigest(), 16) % (tx.DIMENSIONS - size)
            words = [index[t] for t in tokens if t in index]
            return np.bincount(np.concatenate([table[codes], np.array(words, np.int16)]), minlength=tx.DIMENSIONS)

        for batch in batches:
            for start in range(0, batch.num_rows, _TEXTS):
                part = batch.slice(start, _TEXTS)
                n = np.array([counts(t) for t in part.column(1).to_pylist()])
                row, slot = np.nonzero(n)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(row)), pa.array(slot), pa.array(n[row, slot])], [key, "slot", "n"]
                )

    return docs.select(key, column).mapInArrow(run, f"`{key}` {kind}, slot long, n long")
