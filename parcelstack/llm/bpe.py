"""Byte-pair merging of whole batches of words in numpy, for BPE models in the
SentencePiece format (pieces with scores, byte fallback, U+2581 for space).

All words of a batch are held as one flat symbol array with a word number per
symbol. In each round every word merges its best-scored pair, all words at
once; the array is compacted and rounds go on until no word has a pair left.
Within a word, all non-overlapping occurrences of the pair are merged from the
left, unless a pair formed on the way scores better than the one being merged
(or as well as it): such a word merges only its leftmost occurrence that
round, so the order of merges is that of the reference algorithm.
"""

from __future__ import annotations

import re
from collections import Counter
from itertools import islice

import numpy as np

from .common import ragged

SPACE = "▁"
NONE = np.iinfo(np.int32).max
# Words longer than this are first cut where no piece of the model could span.
LONG_WORD = 64
# Bytes of text that a worker encodes at a time, and of words that it remembers
# (with about WORD_BYTES for each word's place in the tables).
SLICE = 1 << 20
MEMORY = 32 << 20
WORD_BYTES = 160


class Model:
    """Merge tables of one model file."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as pb
        proto = pb.ModelProto()
        with open(path, "rb") as f:
            proto.ParseFromString(f.read())
        spec = proto.normalizer_spec
        if spec.precompiled_charsmap or not spec.add_dummy_prefix or spec.remove_extra_whitespaces \
                or not spec.escape_whitespaces or proto.trainer_spec.treat_whitespace_as_suffix \
                or proto.trainer_spec.model_type != 2 or not proto.trainer_spec.byte_fallback:
            raise ValueError("only BPE models with identity normalization, a space prefix and byte fallback are supported")
        self.eos = next(i for i, p in enumerate(proto.pieces) if p.piece == "</s>")
        normal = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == 1}
        if any(p.type in (4, 5) for p in proto.pieces):
            raise ValueError("user-defined and unused pieces are not supported")
        self.byte0 = next(i for i, p in enumerate(proto.pieces) if p.type == 6)
        if [p.piece for p in proto.pieces if p.type == 6] != [f"<0x{b:02X}>" for b in range(256)]:
            raise ValueError("byte pieces out of order")
        self.size = len(proto.pieces)
        score = {i: proto.pieces[i].score for i in normal.values()}
        order = {s: k for k, s in enumerate(sorted(set(score.values()), reverse=True))}
        ties = {s for s, n in Counter(score.values()).items() if n > 1}
        if any(set(t) != {SPACE} for t, i in normal.items() if score[i] in ties and len(t) > 1):
            raise ValueError("only pieces of spaces may share a score")
        if any(SPACE in t.lstrip(SPACE) or t.startswith(SPACE * 2) and t.strip(SPACE) for t in normal):
            raise ValueError("a piece may hold spaces only alone or one in front")
        # single characters: their piece, or a number past the pieces
        chars = sorted({c for t in normal for c in t})
        extra = iter(range(self.size, self.size + len(chars)))
        sym = {c: normal[c] if c in normal else next(extra) for c in chars}
        self.char_codes = np.array([ord(c) for c in chars], dtype=np.int64)
        self.char_syms = np.array([sym[c] for c in chars], dtype=np.int64)
        self.unknown = self.size + len(chars)
        self.width = self.unknown + 1
        pairs = {}
        for t, i in normal.items():
            for k in range(1, len(t)):
                a, b = t[:k], t[k:]
                a = normal.get(a, sym[a] if k == 1 else None)
                b = normal.get(b, sym[b] if len(t) - k == 1 else None)
                if a is not None and b is not None:
                    pairs[a * self.width + b] = i
        self._table(pairs, {i: order[score[i]] for i in normal.values()})
        inside = {(t[k], t[k + 1]) for t in normal for k in range(len(t) - 1)}
        self.inside = {a + b for a, b in inside}
        # characters that no longer piece holds end a word on either side
        self.splits = "".join(c for c in "\n\t\r" if not any(c in t and len(t) > 1 for t in normal))
        esc = re.escape(self.splits)
        self.words = re.compile(f"{SPACE}*[^{SPACE}{esc}]+|{SPACE}+" + (f"|[{esc}]" if esc else "")).findall
        self.runs = {len(t): i for t, i in normal.items() if set(t) == {SPACE}}
        # bytes of each piece when decoded
        raw = [b""] * self.size
        for t, i in normal.items():
            raw[i] = t.replace(SPACE, " ").encode()
        for b in range(256):
            raw[self.byte0 + b] = bytes([b])
        self.piece_len = np.array([len(r) for r in raw], dtype=np.int64)
        self.piece_start = np.cumsum(self.piece_len) - self.piece_len
        self.piece_bytes = np.frombuffer(b"".join(raw), dtype=np.uint8)
        self.opens = np.array([r.startswith(b" ") for r in raw])

    def pre_tokens(self, text: str) -> list[str]:
        """The text with its space prefix, cut where no piece reaches across."""
        return self.words(SPACE + text.replace(" ", SPACE)) if text else []

    def _table(self, pairs: dict[int, int], rank: dict[int, int]) -> None:
        """Pairs in an open-addressing table of arrays, a quarter full at most."""
        bits = max(4, (4 * len(pairs)).bit_length())
        self.shift = np.uint64(64 - bits)
        self.mask = (1 << bits) - 1
        self.slot_key = np.full(1 << bits, -1, dtype=np.int64)
        self.slot_rank = np.full(1 << bits, NONE, dtype=np.int32)
        self.slot_piece = np.zeros(1 << bits, dtype=np.int64)
        keys = np.fromiter(pairs, dtype=np.int64, count=len(pairs))
        for key, at in zip(keys.tolist(), self._slot(keys).tolist(), strict=True):
            while self.slot_key[at] != -1:
                at = (at + 1) & self.mask
            self.slot_key[at], self.slot_piece[at], self.slot_rank[at] = key, pairs[key], rank[pairs[key]]

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def lookup(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, merged piece) of symbol pairs; rank NONE where they do not merge."""
        keys = a * self.width + b
        at = self._slot(keys)
        found = self.slot_key[at]
        probe = np.flatnonzero((found != keys) & (found != -1))
        while len(probe):
            at[probe] = (at[probe] + 1) & self.mask
            found = self.slot_key[at[probe]]
            probe = probe[(found != keys[probe]) & (found != -1)]
        return self.slot_rank[at], self.slot_piece[at]

    def pieces_of(self, word: str) -> list[str]:
        """A long word cut between characters that no piece has side by side."""
        out, lo = [], 0
        for k in range(1, len(word)):
            if word[k - 1:k + 1] not in self.inside:
                out.append(word[lo:k])
                lo = k
        return [*out, word[lo:]]

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words one after another, number of ids of each)."""
        two, lead, cores = SPACE * 2, np.zeros(len(words), dtype=np.int64), words
        spaced = [k for k, w in enumerate(words) if w.startswith(two)]
        if spaced:
            cores = list(words)
            for k in spaced:
                lead[k] = n = len(words[k]) - len(words[k].lstrip(SPACE))
                cores[k] = words[k][n - 1:]
        owner = None
        if any(len(w) > LONG_WORD for w in cores):
            parts = [self.pieces_of(w) if len(w) > LONG_WORD else [w] for w in cores]
            owner = np.repeat(np.arange(len(words)), [len(x) for x in parts])
            cores = [x for y in parts for x in y]
        sym, word = self._merge(cores)
        word = word if owner is None else owner[word]
        # leading runs of spaces: what the word did not take up merges on its own
        if len(lead) and (lead > 1).any():
            many = lead > 1
            first = np.searchsorted(word, np.arange(len(words)))
            keep = np.ones(len(sym), dtype=bool)
            run = np.where(many, lead - 1, 0)
            free = many & (sym[np.minimum(first, len(sym) - 1)] == self.runs[1])
            run[free] += 1
            keep[first[free]] = False
            sym, word = sym[keep], word[keep]
            made = self.space_runs(set(run.tolist()))
            who = np.repeat(np.arange(len(words)), [len(made[r]) for r in run.tolist()])
            ids = np.array([i for r in run.tolist() for i in made[r]], dtype=np.int64)
            order = np.argsort(np.concatenate([who, word]), kind="stable")
            sym, word = np.concatenate([ids, sym])[order], np.concatenate([who, word])[order]
        return sym, np.bincount(word, minlength=len(words))

    def space_runs(self, lengths: set[int]) -> dict[int, list[int]]:
        """Ids of runs of spaces. Their pieces share one score, so the leftmost
        pair goes first: each next space merges into what stands before it for
        as long as a piece of that length exists."""
        made, stack = {0: []}, []
        for n in range(1, max(lengths) + 1):
            stack.append(1)
            while len(stack) > 1 and stack[-2] + stack[-1] in self.runs:
                last = stack.pop()
                stack[-1] += last
            if n in lengths:
                made[n] = [self.runs[r] for r in stack]
        return made

    def _merge(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Symbols left after all merges, bytes for unknown characters, and the word of each."""
        n = np.array([len(w) for w in words], dtype=np.int64)
        codes = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
        word = np.repeat(np.arange(len(words)), n)
        at = np.minimum(np.searchsorted(self.char_codes, codes), len(self.char_codes) - 1)
        known = self.char_codes[at] == codes
        sym = np.where(known, self.char_syms[at], self.unknown)
        # unknown characters keep their code until the end: below zero, never merged
        code = np.where(sym >= self.size, codes, 0)
        done_sym, done_code, done_word = [], [], []
        rank = np.full(len(sym), NONE, dtype=np.int32)
        into = np.zeros(len(sym), dtype=np.int64)
        if len(sym) > 1:
            r, p = self.lookup(sym[:-1], sym[1:])
            same = word[:-1] == word[1:]
            rank[:-1] = np.where(same, r, NONE)
            into[:-1] = p
        while len(sym):
            edge = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            size = np.diff(np.r_[edge, len(sym)])
            best = np.minimum.reduceat(rank, edge)
            live = np.repeat(best != NONE, size)
            if not live.all():
                for out, x in ((done_sym, sym), (done_code, code), (done_word, word)):
                    out.append(x[~live])
                sym, code, word, rank, into = sym[live], code[live], word[live], rank[live], into[live]
                if not len(sym):
                    break
                edge = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
                size = np.diff(np.r_[edge, len(sym)])
                best = best[best != NONE]
            hit = rank == np.repeat(best, size)
            pos = np.flatnonzero(hit)
            # overlapping occurrences (a a a): every other one, from the left
            run = np.flatnonzero(np.r_[True, np.diff(pos) != 1])
            odd = (np.arange(len(pos)) - np.repeat(run, np.diff(np.r_[run, len(pos)]))) % 2 == 0
            pos = pos[odd]
            several = np.flatnonzero(word[pos[1:]] == word[pos[:-1]])
            if len(several):
                pos = pos[~self._later(pos, sym, word, rank, into)]
            sym[pos] = into[pos]
            code[pos] = 0
            keep = np.ones(len(sym), dtype=bool)
            keep[pos + 1] = False
            moved = np.cumsum(keep) - 1
            new = moved[pos]
            sym, code, word, rank, into = sym[keep], code[keep], word[keep], rank[keep], into[keep]
            # only pairs beside a merge have changed
            beside = np.zeros(len(sym), dtype=bool)
            beside[new] = True
            beside[new[new > 0] - 1] = True
            stale = np.flatnonzero(beside)
            rank[stale] = NONE
            stale = stale[stale < len(sym) - 1]
            stale = stale[word[stale] == word[stale + 1]]
            rank[stale], into[stale] = self.lookup(sym[stale], sym[stale + 1])
        sym = np.concatenate([*done_sym, sym])
        code = np.concatenate([*done_code, code])
        word = np.concatenate([*done_word, word])
        order = np.argsort(word, kind="stable")
        sym, code, word = sym[order], code[order], word[order]
        odd = np.flatnonzero(sym >= self.size)
        if len(odd):
            enc = [chr(c).encode() for c in code[odd].tolist()]
            n = np.ones(len(sym), dtype=np.int64)
            n[odd] = [len(e) for e in enc]
            to = np.cumsum(n) - n
            sym, word = np.repeat(sym, n), np.repeat(word, n)
            where = ragged(to[odd], n[odd])
            sym[where] = np.frombuffer(b"".join(enc), dtype=np.uint8).astype(np.int64) + self.byte0
        return sym, word

    def _later(self, pos, sym, word, rank, into) -> np.ndarray:
        """Occurrences to leave for a later round: all but the first of a word
        in which merging forms a pair that ranks no worse than the merged one."""
        n = len(sym)
        mine = rank[pos]
        w = word[pos]
        new = into[pos]
        bad = np.zeros(len(pos), dtype=bool)
        # new pair to the left: the symbol before, which may itself be a merge
        has = (pos > 0) & (word[np.maximum(pos - 1, 0)] == w)
        after = np.r_[False, (pos[1:] == pos[:-1] + 2) & (w[1:] == w[:-1])]
        left = np.where(after, np.r_[new[:1], new[:-1]], sym[np.maximum(pos - 1, 0)])
        bad |= has & (self.lookup(left, new)[0] <= mine)
        # to the right: the untouched next symbol (also if it is merged next)
        end = pos + 2
        has = (end < n) & (word[np.minimum(end, n - 1)] == w)
        bad |= has & (self.lookup(new, sym[np.minimum(end, n - 1)])[0] <= mine)
        words = np.unique(w[bad])
        first = np.r_[True, w[1:] != w[:-1]]
        return ~first & np.isin(w, words)

    def decode(self, ids: np.ndarray, n: np.ndarray) -> list[str]:
        """Texts of id sequences (flat ids, ids per text): piece bytes one
        after another without the space prefix; the end id has none."""
        lens = self.piece_len[ids]
        data = self.piece_bytes[ragged(self.piece_start[ids], lens)].tobytes()
        byte_end = np.r_[0, np.cumsum(lens)]
        end = np.cumsum(n)
        lo, hi = byte_end[end - n], byte_end[end]
        some = n > 0
        strip = np.zeros(len(n), dtype=np.int64)
        strip[some] = self.opens[ids[(end - n)[some]]]
        return [data[a:b].decode("utf-8", "sp_replace") for a, b in zip((lo + strip).tolist(), hi.tolist(), strict=True)]


def _replace(e):
    if isinstance(e, UnicodeDecodeError):
        return "�" * (e.end - e.start), e.end
    raise e


import codecs  # noqa: E402

codecs.register_error("sp_replace", _replace)


class Codes(dict):
    """Numbers words in order of first sight."""

    def __missing__(self, word):
        self[word] = n = len(self)
        return n


class Encoder:
    """Encodes texts, remembering the ids of the words it has seen; what it
    remembers is dropped when it takes more than `limit` bytes or so."""

    def __init__(self, model: Model, limit: int = MEMORY):
        self.model, self.limit = model, limit
        self.clear()

    def clear(self) -> None:
        self.codes = Codes()
        self.known = self.held = 0
        self.ids = np.zeros(0, dtype=np.int32)
        self.count = np.zeros(0, dtype=np.int64)
        self.start = np.zeros(0, dtype=np.int64)

    def _learn(self) -> None:
        fresh = list(islice(self.codes, self.known, None))
        if fresh:
            ids, count = self.model.encode_words(fresh)
            self.ids = np.concatenate([self.ids, ids.astype(np.int32)])
            self.count = np.concatenate([self.count, count])
            self.start = np.cumsum(self.count) - self.count
            self.known = len(self.codes)
            self.held += sum(map(len, fresh)) + WORD_BYTES * len(fresh) + ids.size * 4

    def _words(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if self.held > self.limit:
            self.clear()
        get, cut = self.codes.__getitem__, self.model.pre_tokens
        flat: list[int] = []
        sizes = np.zeros(len(texts), dtype=np.int64)
        for k, t in enumerate(texts):
            before = len(flat)
            flat.extend(map(get, cut(t)))
            sizes[k] = len(flat) - before
        self._learn()
        return np.array(flat, dtype=np.int64), sizes

    def counts(self, texts: list[str]) -> np.ndarray:
        """Number of ids of each text, without an end id."""
        words, sizes = self._words(texts)
        total = np.r_[0, np.cumsum(self.count[words])]
        end = np.cumsum(sizes)
        return total[end] - total[end - sizes]

    def encode(self, texts: list[str], end_id: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """(flat ids, ids per text)."""
        words, sizes = self._words(texts)
        count = self.count[words]
        ids = self.ids[ragged(self.start[words], count)]
        total = np.r_[0, np.cumsum(count)]
        end = np.cumsum(sizes)
        n = total[end] - total[end - sizes]
        if end_id:
            ids = np.insert(ids, np.cumsum(n), self.model.eos)
            n = n + 1
        return ids, n


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The encoder of a model file, made once in each Python worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(Model(path))
    return _ENCODERS[path]
