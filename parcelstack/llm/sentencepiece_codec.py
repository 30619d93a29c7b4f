"""SentencePiece encoding and decoding (operator 9): vectorised merge rounds.

Flat numpy symbol arrays, the segmented minimum pair rank per word, leftmost
merges of all words at once, compaction until no pair remains (`bpe.Model`);
ids are gathered per text from the words seen. Decoding gathers piece bytes.
Narrow: no shuffle, and a lost task is simply rerun.

Defined results: a null or empty text encodes to the end id alone and decodes
to the empty text; U+2581 decodes as a space, as in the library; characters
unknown to the model go through byte pieces; texts of any length are encoded
whole; one row out per row in; other columns of the input are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, texts


def encode(docs: DataFrame, model_path: str, end_id: bool = True, decoded: bool = False) -> DataFrame:
    """(doc_id, ids array<int>) of every whole text and, with `decoded`, the
    text that the ids decode to."""
    schema = "doc_id long, ids array<int>" + (", decoded string" if decoded else "")

    def run(batches):
        from .bpe import SLICE, encoder
        e = encoder(model_path)
        for batch in batches:
            for part in slices(batch, limit=SLICE):
                ids, n = e.encode(part.column("text").to_pylist(), end_id)
                cols = [part.column("doc_id"), _lists(ids, n)]
                if decoded:
                    cols.append(pa.array(e.model.decode(ids, n), pa.string()))
                yield pa.RecordBatch.from_arrays(cols, ["doc_id", "ids", "decoded"][:len(cols)])

    return texts(docs).mapInArrow(run, schema)


def decode(encoded: DataFrame, model_path: str) -> DataFrame:
    """(doc_id, decoded) of (doc_id, ids); null ids decode to the empty text."""
    def run(batches):
        from .bpe import encoder
        e = encoder(model_path)
        for batch in batches:
            col = batch.column("ids")
            n = np.asarray(pa.compute.list_value_length(col), dtype=np.int64)
            ids = np.asarray(col.flatten(), dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(e.model.decode(ids, n), pa.string())], ["doc_id", "decoded"])

    rows = encoded.select("doc_id", F.coalesce("ids", F.array().cast("array<int>")).alias("ids"))
    return rows.mapInArrow(run, "doc_id long, decoded string")


def digests(encoded: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of encode(decoded=True)."""
    return encoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def _lists(ids: np.ndarray, n: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(n)], pa.int32()), pa.array(ids, pa.int32()))
