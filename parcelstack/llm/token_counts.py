"""Token counts (operator 2): rank-synchronous array merging.

Each partition holds its pre-tokens as ragged numpy arrays; every round merges
the lowest-rank pair of every sequence at once (`bpe.Model`) and the symbols
that survive are counted. Narrow: no shuffle, and a lost task is simply rerun.

Defined results: a null or empty text has 0 bytes and 0 tokens; special
strings in a text are ordinary text; texts of any length are counted whole;
equal rows give equal results, one row out per row in; other columns of the
input are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, texts


def count_tokens(docs: DataFrame, model_path: str) -> DataFrame:
    """(doc_id, n_bytes, n_tokens) of every whole text, as the SentencePiece
    library gives them for the BPE model at `model_path` (a path that every
    executor can read), without begin or end ids."""
    def run(batches):
        from .bpe import SLICE, encoder
        e = encoder(model_path)
        for batch in batches:
            for part in slices(batch, limit=SLICE):
                n = e.counts(part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("n_bytes"), pa.array(n, pa.int64())],
                    ["doc_id", "n_bytes", "n_tokens"])

    t = texts(docs).withColumn("n_bytes", F.octet_length("text").cast("long"))
    return t.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")


def over_limit(counts: DataFrame, limit: int = 4096) -> DataFrame:
    """Adds over_limit: more than `limit` tokens."""
    return counts.withColumn("over_limit", F.col("n_tokens") > F.lit(limit))
