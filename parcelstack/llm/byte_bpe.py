"""Byte-level BPE encoding and decoding (operator 12): the tokenizers library
over Arrow batches.

A rank file (base64 bytes and rank per line) becomes a BPE model of the
library: bytes are written as the printable characters of the byte table, and
every cut of a token into two tokens is a merge of that token's rank. Texts are
split by the pattern and encoded match by match; offsets are kept in characters
of the text. Decoding reverses the byte table and joins the bytes of all tokens
before reading them as UTF-8, so characters split between tokens come whole.
Narrow: no shuffle, and a lost task is simply rerun.

No match of the pattern holds a white-space character after another character,
so a text may be cut wherever white space follows something else. Each worker
encodes such units once and remembers their ids in a memory of bounded size.

Defined results: a null or empty text has no ids and decodes to the empty text;
special strings are ordinary text; texts of any length are encoded whole;
bytes that are no UTF-8 read as U+FFFD in decoded text and stay in decoded
bytes; equal rows give equal results, one row out per row in; other columns of
the input are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ragged, slices, texts

SLICE = 1 << 20
# Characters of remembered units and, separately, their ids, per worker.
MEMORY_CHARS = 4 << 20
MEMORY_IDS = 4 << 20
# Units longer than this are not remembered.
LONG_UNIT = 64

_UNITS = re.compile(r"[ \t\n\r]*[^ \t\n\r]+|[ \t\n\r]+").findall
# White space that the cut between units does not know: such texts stay whole.
_OTHER_SPACE = re.compile(r"[^\S \t\n\r]").search


def byte_table() -> list[str]:
    """The printable character of each byte: its own where Latin-1 has one that
    shows, otherwise the next free one from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    table = {b: chr(b) for b in shown} | {b: chr(0x100 + k) for k, b in enumerate(hidden)}
    return [table[b] for b in range(256)]


class Codec:
    """Encoder and decoder of one rank file and pattern, for one worker."""

    def __init__(self, path: str, pattern: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Regex, Tokenizer, models, pre_tokenizers
        with open(path, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        table = byte_table()
        if any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError("every single byte needs a rank")
        shown = {raw: "".join(map(table.__getitem__, raw)) for raw in ranks}
        merges = [(shown[raw[:k]], shown[raw[k:]]) for raw in sorted(ranks, key=ranks.get)
                  for k in range(1, len(raw)) if raw[:k] in ranks and raw[k:] in ranks]
        vocabulary = {text: ranks[raw] for raw, text in shown.items()}
        self.tokenizer = Tokenizer(models.BPE(vocab=vocabulary, merges=merges, ignore_merges=True, cache_capacity=0))
        self.tokenizer.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.Split(Regex(pattern), "isolated"),
            pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        byte_of = {c: b for b, c in enumerate(table)}
        raw = [b""] * (max(vocabulary.values()) + 1)
        for text, i in vocabulary.items():
            raw[i] = bytes(map(byte_of.__getitem__, text))
        self.raw_len = np.array([len(r) for r in raw], dtype=np.int64)
        self.raw_start = np.cumsum(self.raw_len) - self.raw_len
        self.raw = np.frombuffer(b"".join(raw), dtype=np.uint8)
        self._clear()

    def _clear(self) -> None:
        self.codes: dict[str, int] = {}
        self.chars = 0
        self.ids = np.zeros(0, np.int32)
        self.spans = np.zeros((0, 2), np.int32)
        self.count = np.zeros(0, np.int64)
        self.width = np.zeros(0, np.int64)

    def _learn(self, units: list[str]) -> None:
        found = self.tokenizer.encode_batch(units, add_special_tokens=False)
        count = np.array([len(e) for e in found], dtype=np.int64)
        spans = [s for e in found for s in e.offsets]
        self.ids = np.concatenate([self.ids, np.array([i for e in found for i in e.ids], dtype=np.int32)])
        self.spans = np.concatenate([self.spans, np.array(spans, dtype=np.int32).reshape(-1, 2)])
        self.count = np.concatenate([self.count, count])
        self.width = np.concatenate([self.width, np.array([len(u) for u in units], dtype=np.int64)])

    def encode(self, rows: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(flat ids, ids per row, first character of each id, character after it)."""
        if self.chars > MEMORY_CHARS or len(self.ids) > MEMORY_IDS:
            self._clear()
        codes, flat, fresh = self.codes, [], []
        sizes = np.zeros(len(rows), dtype=np.int64)
        known = len(self.count)
        for k, text in enumerate(rows):
            units = [text] if _OTHER_SPACE(text) else _UNITS(text)
            sizes[k] = len(units)
            for u in units:
                at = codes.get(u)
                if at is None:
                    at = known + len(fresh)
                    fresh.append(u)
                    if len(u) <= LONG_UNIT:
                        codes[u] = at
                        self.chars += len(u)
                flat.append(at)
        if fresh:
            self._learn(fresh)
        unit = np.array(flat, dtype=np.int64)
        count, width = self.count[unit], self.width[unit]
        at = ragged((np.cumsum(self.count) - self.count)[unit], count)
        row_end = np.cumsum(sizes)
        through = np.r_[0, np.cumsum(width)]
        base = through[:-1] - np.repeat(through[row_end - sizes], sizes)
        shift = np.repeat(base, count)
        n = np.r_[0, np.cumsum(count)]
        ids, spans = self.ids[at], self.spans[at]
        if len(codes) < len(self.count) and sum(len(u) > LONG_UNIT for u in fresh):
            self._forget(known, fresh)
        return ids, n[row_end] - n[row_end - sizes], spans[:, 0] + shift, spans[:, 1] + shift

    def _forget(self, known: int, fresh: list[str]) -> None:
        """Long units leave the arrays again; later codes move up."""
        keep = np.r_[np.ones(known, bool), [len(u) <= LONG_UNIT for u in fresh]]
        mine = np.repeat(keep, self.count)
        self.ids, self.spans = self.ids[mine], self.spans[mine]
        self.count, self.width = self.count[keep], self.width[keep]
        for u in fresh:
            if len(u) <= LONG_UNIT:
                self.codes[u] = known
                known += 1

    def decode(self, ids: np.ndarray, n: np.ndarray) -> list[bytes]:
        """Bytes of each row of ids."""
        lens = self.raw_len[ids]
        data = self.raw[ragged(self.raw_start[ids], lens)].tobytes()
        ends = np.r_[0, np.cumsum(lens)]
        row_end = np.cumsum(n)
        return [data[a:b] for a, b in zip(ends[row_end - n].tolist(), ends[row_end].tolist(), strict=True)]


_CODECS: dict[tuple[str, str], Codec] = {}


def codec(path: str, pattern: str) -> Codec:
    """The codec of a rank file, made once in each Python worker."""
    if (path, pattern) not in _CODECS:
        _CODECS[path, pattern] = Codec(path, pattern)
    return _CODECS[path, pattern]


def _lists(values: np.ndarray, n: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(n)], pa.int32()), pa.array(values, pa.int32()))


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, ids, starts, ends) of every whole text: the ids and the
    characters of the text that each covers (a token that holds part of a
    character covers that character)."""
    def run(batches):
        c = codec(path, pattern)
        for batch in batches:
            for part in slices(batch, limit=SLICE):
                ids, n, starts, ends = c.encode(part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), _lists(ids, n), _lists(starts, n), _lists(ends, n)],
                    ["doc_id", "ids", "starts", "ends"])

    return texts(docs).mapInArrow(run, "doc_id long, ids array<int>, starts array<int>, ends array<int>")


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, decoded, raw) of (doc_id, ids): the text and its exact bytes;
    null ids decode to the empty text."""
    def run(batches):
        c = codec(path, pattern)
        for batch in batches:
            col = batch.column("ids")
            n = np.asarray(pa.compute.list_value_length(col), dtype=np.int64)
            raw = c.decode(np.asarray(col.flatten(), dtype=np.int64), n)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([r.decode("utf-8", "replace") for r in raw], pa.string()),
                 pa.array(raw, pa.binary())], ["doc_id", "decoded", "raw"])

    rows = encoded.select("doc_id", F.coalesce("ids", F.array().cast("array<int>")).alias("ids"))
    return rows.mapInArrow(run, "doc_id long, decoded string, raw binary")


def digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): encoded, decoded again
    and digested slice by slice; ids as little-endian unsigned 32-bit integers."""
    def run(batches):
        c = codec(path, pattern)
        for batch in batches:
            for part in slices(batch, limit=SLICE):
                ids, n, _, _ = c.encode(part.column("text").to_pylist())
                packed, end = ids.astype("<u4").tobytes(), 4 * np.cumsum(n)
                rows = zip((end - 4 * n).tolist(), end.tolist(), strict=True)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(n, pa.int64()),
                     pa.array([hashlib.sha256(packed[a:b]).hexdigest() for a, b in rows], pa.string()),
                     pa.array([hashlib.sha256(r).hexdigest() for r in c.decode(ids, n)], pa.string())],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return texts(docs).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
