"""Exact encoding of whole columns with a public tokenizer.

Texts are cut only where no token of the vocabulary's pre-tokeniser can cross: at spaces, at single and double line
ends, and between a run of letters and the punctuation that closes it. All of a batch is split and dictionary-encoded
in Arrow kernels; the tokenizers library encodes each distinct run of letters once, and ids are gathered by position.
"""

from __future__ import annotations

import os
import re
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text encoded at once (a longer document is a slice of its own), and ids gathered at once.
SLICE_BYTES, GATHER = 1 << 20, 1 << 20
#: Pieces in each of the two generations of a worker's memo (about 45 bytes each), and the longest one in bytes.
MEMO_PIECES, MEMO_CHARS = 500_000, 64
#: For the memo's hashes: a number for each byte, and one for each place in a piece.
TABLES = [tuple(np.random.default_rng(seed).integers(1, 1 << 63, n, np.uint64) * np.uint64(2) + np.uint64(1) for seed, n in ((2 * k, 256), (2 * k + 1, MEMO_CHARS))) for k in (1, 2)]
#: White space next to a space, three line ends in a row, white space at the end or a line end before what may be a special token: there a cut could change how the run is encoded.
OTHER_WHITE = r"\t\x0b\x0c\r\x1c-\x1f \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
UNSAFE = rf"[\n{OTHER_WHITE}] [\n{OTHER_WHITE}]|[\n{OTHER_WHITE}] \z|\n\n\n|[{OTHER_WHITE}]\n|\n[{OTHER_WHITE}]|\n\z|\n<\|"
SAFE_CUT = re.compile(r"(?<=\S)(?= )|(?= \S)")
#: ASCII punctuation that ends words, and the regular pieces: letters, the last one of a script whose letters all
#: versions of Unicode agree on, and closing punctuation. Where white space is dropped, case is too, that of ASCII first.
CLOSING = ".,;:!?|"
REGULAR = r"^\n?\pL*[a-zA-ZÀ-ÖØ-öø-ɏΑ-ΡΣ-ώА-џ][.,;:!?|]*$"
END_ID = 1


class Memo:
    """Ids of pieces in two generations of at most MEMO_PIECES: when the young one is full it becomes the old one, and
    what is found there moves on. A piece is known by 128 bits of multilinear hashes; longer ones than MEMO_CHARS are
    always asked for. A generation is sorted by the first hash: keys, checks, start and length in one array of ids."""

    def __init__(self, most: int = MEMO_PIECES):
        self.most, self.young, self.old = most, self.empty(), self.empty()

    @staticmethod
    def empty() -> tuple[np.ndarray, ...]:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.uint32)

    @staticmethod
    def hashes(pieces: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Two hashes of each piece, and whether it is short enough."""
        _, offsets, data = pieces.buffers()
        at = np.frombuffer(offsets, np.int32)[pieces.offset : pieces.offset + len(pieces) + 1].astype(np.int64)
        raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
        at -= at[0]
        size = np.diff(at)
        place = np.minimum(np.arange(len(raw)) - np.repeat(at[:-1], size), MEMO_CHARS - 1)
        full = np.flatnonzero(size)
        got = []
        for letters, places in TABLES:
            h = np.zeros(len(pieces), np.uint64)
            if len(full):
                h[full] = np.add.reduceat(letters[raw] * places[place], at[full])
            got.append(h + size.astype(np.uint64) * places[0])
        return *got, size <= MEMO_CHARS

    @staticmethod
    def find(known: tuple[np.ndarray, ...], h: np.ndarray, check: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keys, checks = known[:2]
        if not len(keys):
            return np.zeros(len(h), np.int64), np.zeros(len(h), bool)
        at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
        return at, (keys[at] == h) & (checks[at] == check)

    def known(self, pieces: pa.Array, ask) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """One array of ids, and the start and length in it of each of distinct pieces; ask gives the ids of unknown ones."""
        h, check, short = self.hashes(pieces)
        young, old = self.young, self.old
        at, hit = self.find(young, h, check)
        hit &= short
        start, length = np.zeros(len(h), np.int64), np.zeros(len(h), np.int64)
        start[hit], length[hit] = young[2][at[hit]], young[3][at[hit]]
        rest = np.flatnonzero(~hit)
        at, hit = self.find(old, h[rest], check[rest])
        hit &= short[rest]
        moved = rest[hit]
        start[moved], length[moved] = old[2][at[hit]] + len(young[4]), old[3][at[hit]]
        asked = rest[~hit]
        ids, begin, n = pooled(ask(pieces.take(pa.array(asked)).to_pylist()))
        start[asked], length[asked] = begin + len(young[4]) + len(old[4]), n
        pool = np.concatenate([young[4], old[4], ids])
        new = rest[short[rest]]
        if len(new):
            self.add(h[new], check[new], pool, start[new], length[new])
        return pool, start, length

    def add(self, h: np.ndarray, check: np.ndarray, pool: np.ndarray, start: np.ndarray, length: np.ndarray) -> None:
        if len(self.young[0]) + len(h) > self.most:
            self.old, self.young = self.young, self.empty()
        keys, checks, starts, lengths, ids = self.young
        turn = np.argsort(h, kind="stable")
        at = np.searchsorted(keys, h[turn])
        ends = np.cumsum(length) - length + len(ids)
        self.young = (
            np.insert(keys, at, h[turn]), np.insert(checks, at, check[turn]), np.insert(starts, at, ends[turn]),
            np.insert(lengths, at, length[turn]), np.concatenate([ids, gathered(pool, start, length)]),
        )


def gathered(pool: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """pool[start : start + length] of each, one after the other."""
    ends = np.cumsum(length)
    out = np.empty(int(ends[-1]) if len(ends) else 0, pool.dtype)
    a = 0
    while a < len(length):
        first = int(ends[a - 1]) if a else 0
        b = max(a + 1, int(np.searchsorted(ends, first + GATHER)))
        n = length[a:b]
        shift = np.repeat(start[a:b] - (ends[a:b] - n - first), n)
        out[first : first + len(shift)] = pool[shift + np.arange(len(shift))]
        a = b
    return out


def pooled(ids: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All ids one after the other, and the start and length of each."""
    length = np.fromiter(map(len, ids), np.int64, len(ids)) >> 2
    return np.frombuffer(b"".join(ids), "<u4"), np.cumsum(length) - length, length


class Encoder:
    """drops_white: the tokenizer takes white space for the end of a word only; else a space belongs to the next word."""

    def __init__(self, path: str, drops_white: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.drops_white = drops_white
        self.memo, self.bare = Memo(), Memo(MEMO_PIECES // 8)

    def direct(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def ask(self, pieces: list[str]) -> list[bytes]:
        """Ids of parts of a text as split() gives them: one that begins a line stands alone, others have a space before them."""
        return self.ask_bare(pieces if self.drops_white else [x if x[:1] == "\n" else f" {x}" for x in pieces])

    def ask_bare(self, pieces: list[str]) -> list[bytes]:
        return [array("I", x.ids).tobytes() for x in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]

    def split(self, texts: pa.Array) -> pa.ListArray:
        """Parts of each text. A line end stays with the part that it begins."""
        lines = pc.replace_substring(texts, "\n", " " if self.drops_white else " \n")
        return pc.split_pattern(lines, " ")

    def of_parts(self, parts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids of distinct parts one after the other, and the start and length of each."""
        regular = pc.match_substring_regex(parts, REGULAR)
        core = pc.utf8_rtrim(parts, CLOSING)
        cut = pc.if_else(regular, pc.subtract(pc.binary_length(parts), pc.binary_length(core)), 0).to_numpy()
        core = pc.if_else(regular, pc.ascii_lower(core) if self.drops_white else core, parts)
        cores = core.dictionary_encode()
        ends = np.flatnonzero(cut)
        tail = [x[-n:] for x, n in zip(parts.take(pa.array(ends)).to_pylist(), cut[ends].tolist(), strict=True)]
        tail_at = {x: k for k, x in enumerate(dict.fromkeys(tail))}
        ids, start, length = self.memo.known(cores.dictionary, self.ask)
        more, begin, n = self.bare.known(pa.array(list(tail_at), pa.string()), self.ask_bare)
        ids, start, length = np.concatenate([ids, more]), np.concatenate([start, begin + len(ids)]), np.concatenate([length, n])
        n, at = len(cores.dictionary), cores.indices.to_numpy()
        starts, lengths = np.zeros((len(parts), 2), np.int64), np.zeros((len(parts), 2), np.int64)
        starts[:, 0], lengths[:, 0] = start[at], length[at]
        of_tail = np.fromiter(map(tail_at.__getitem__, tail), np.int64, len(tail)) + n
        starts[ends, 1], lengths[ends, 1] = start[of_tail], length[of_tail]
        both = lengths.sum(1)
        return gathered(ids, starts.ravel(), lengths.ravel()), np.cumsum(both) - both, both

    def whole(self, text: str) -> bytes:
        """A text with odd white space: cut only between words, and each piece as it stands."""
        return b"".join(self.ask_bare(SAFE_CUT.split(text)))

    def slice(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of texts, none null, one after the other, and the count of each."""
        apart = np.zeros(len(texts), bool) if self.drops_white else pc.match_substring_regex(texts, UNSAFE).to_numpy(zero_copy_only=False)
        odd = np.flatnonzero(apart).tolist()
        if odd:
            odd_ids = [self.whole(texts[k].as_py()) for k in odd]
            texts = pc.if_else(pa.array(apart), "", texts)
        lists = self.split(texts)
        offsets = lists.offsets.to_numpy().astype(np.int64)
        parts = lists.flatten()
        offsets -= offsets[0]
        coded = parts.dictionary_encode()
        pool, start, length = self.of_parts(coded.dictionary)
        at = coded.indices.to_numpy()
        start, length = start[at], length[at]
        if not self.drops_white:  # nothing stands before a text's first part
            first = parts.take(pa.array(offsets[:-1])).dictionary_encode()
            more, begin, n = self.bare.known(first.dictionary, self.ask_bare)
            at = first.indices.to_numpy()
            start[offsets[:-1]], length[offsets[:-1]] = begin[at] + len(pool), n[at]
            pool = np.concatenate([pool, more])
        sums = np.concatenate([[0], np.cumsum(length)])
        counts = sums[offsets[1:]] - sums[offsets[:-1]]
        ids = gathered(pool, start, length)
        if odd:
            texts_ids = np.split(ids, np.cumsum(counts)[:-1])
            for k, x in zip(odd, odd_ids, strict=True):
                texts_ids[k] = np.frombuffer(x, "<u4")
            ids, counts = np.concatenate(texts_ids), np.fromiter(map(len, texts_ids), np.int64, len(texts_ids))
        return ids, counts

    def batches(self, texts: pa.Array):
        """Slices of a column in order: first row, ids of its texts one after the other, and the count of each. A null is empty."""
        texts = pc.fill_null(texts, "")
        ends = np.cumsum(pc.binary_length(texts).to_numpy().astype(np.int64))
        a = 0
        while a < len(texts):
            b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + SLICE_BYTES, "right")))
            yield a, *self.slice(texts.slice(a, b - a))
            a = b

    def encode(self, text: str | None) -> bytes:
        """Ids of the whole text as unsigned 32-bit little-endian integers."""
        return b"".join(ids.tobytes() for _, ids, _ in self.batches(pa.array([text], pa.string())))


@lru_cache(maxsize=2)
def encoder(path: str, drops_white: bool) -> Encoder:
    return Encoder(path, drops_white)


def word_bpe() -> tuple[str, bool]:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json"), True


def byte_bpe() -> tuple[str, bool]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), False
