"""Operator 1, token counts: batch encoding in an Arrow function that returns lengths only."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame

from . import bpe
from .common import documents


def token_counts(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = 1024) -> DataFrame:
    """Tokens of every whole text: ``doc_id, n_bytes, n_tokens, over_limit``.

    A null text counts as empty (0 bytes, 0 tokens). Long texts are cut at safe
    boundaries (see ``bpe``), so memory is bounded by a block, and no text is cut
    short. Rows with equal or null ids each keep their own row. There is no
    shuffle: a lost task reads its input split again.
    """
    def count(batches):
        for b in batches:
            texts = b.column("text").to_pylist()
            n = [bpe.count_tokens(tokenizer, t) for t in texts]
            size = [len((t or "").encode()) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(size, pa.int64()), pa.array(n, pa.int64()),
                 pa.array([x > limit for x in n], pa.bool_())], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return documents(docs, id_col, text_col).mapInArrow(
        count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
