"""Token counts by heap-and-linked-list byte-pair merging; no ids are made."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.bpe import token_counts

LIMIT = 512


def count_tokens(docs: DataFrame, tokenizer: str, limit: int = LIMIT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for every row.

    ``tokenizer`` is the path of a byte-level BPE description that every executor has.
    A text is split into pieces, the special strings among them being one token each;
    a piece has as many tokens as bytes less the merges that the heap performs. Equal
    pieces are merged once per worker, whose memory of them is bounded. Null and empty
    texts have 0 bytes and tokens; repeated rows are counted alike; ids are passed
    through, null or not; other columns do not matter. Nothing is shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.columns
            size = pc.fill_null(pc.binary_length(texts), 0).cast(pa.int64())
            count = token_counts(texts, tokenizer)
            yield pa.RecordBatch.from_arrays(
                [ids, size, pa.array(count), pa.array(np.greater(count, limit))],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    given = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    return given.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
