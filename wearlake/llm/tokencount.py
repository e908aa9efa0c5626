"""Token counts by rank-synchronous array merging.

All pre-tokens of a batch lie in ragged numpy arrays.  In each round every
sequence finds its lowest-rank pair and merges all its occurrences at once,
until no pair of any sequence has a rank; the surviving symbols are counted.
Distinct pre-tokens are counted once and kept in a bounded cache.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from wearlake.llm import textvec as tv


def token_counts(
    docs: DataFrame, tokenizer: str, limit: int = 1024, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: ``id_col``, n_bytes, n_tokens, over_limit (n_tokens > limit).

    ``tokenizer`` is the path of a byte-level BPE file, the same on every
    machine.  Counts equal the tokenizers library's without added tokens; an
    added special string inside a text counts as one token.  A null or empty
    text has 0 bytes and 0 tokens; repeated rows and null ids are kept row by
    row; other columns are left out; an empty table gives an empty result.
    """
    id_type = docs.schema[id_col].dataType.simpleString()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from wearlake.llm.bytebpe import rank_counter

        counter = rank_counter(tokenizer)
        for batch in batches:
            sizes, tokens = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for _, _, data, offsets in tv.blocks(batch.column(1)):
                sizes.append(np.diff(offsets))
                tokens.append(counter.counts(data, offsets))
            n = np.concatenate(tokens)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array(np.concatenate(sizes)), pa.array(n), pa.array(n > limit)
                ], [id_col, "n_bytes", "n_tokens", "over_limit"]
            )
        tv.trim()

    return docs.select(id_col, text_col).mapInArrow(
        count, f"`{id_col}` {id_type}, n_bytes long, n_tokens long, over_limit boolean"
    )
