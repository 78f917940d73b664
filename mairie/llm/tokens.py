"""Token ids for whole batches with a public byte-level BPE vocabulary.

Texts are cut before every space that a visible character follows.  The vocabulary's split
pattern always starts a match at such a space, whatever stands before it, so each piece is encoded
on its own and equal pieces only once per batch; a bounded memo keeps common ones between batches.  The ids are those of the
tokenizer file (``byte_bpe_50k.json``); the rank file beside it holds the same vocabulary.
"""

from __future__ import annotations

import base64
import re

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken

from mairie.llm.textbytes import buffer_of, span_hashes

VOCABULARY = "byte_bpe_50k.tiktoken"
MEMO = 1_500_000
# The added token of the tokenizer file, which reads the string as this one id wherever it stands.
SPECIAL = {"<|endoftext|>": 50256}

# Bytes that may follow a space at which a text is cut: all that cannot begin a white-space character.
_LEAD = np.zeros(256, bool)
_LEAD[0x21:0x7F] = True
_LEAD[0xC3:0xF8] = True
_LEAD[[0xE1, 0xE2, 0xE3]] = False


def _ragged(starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the runs [start, start + size) one after another, and where each run begins there."""
    at = np.concatenate([[0], np.cumsum(sizes)])
    return np.arange(at[-1]) + np.repeat(starts - at[:-1], sizes), at


class Encoder:
    """Encodes string columns; ids of special strings arise from texts only with ``special``."""

    def __init__(self, path: str | None = None, special: bool = False):
        self.special = SPECIAL if special else {}
        with open(path or public_tokenizers.path(VOCABULARY), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding(
            "corpus", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=self.special
        )
        self.width = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, i in ranks.items():
            self.width[i] = len(token)
        # Known pieces: sorted hashes, and where the ids of each stand in ``flat``.
        self.known, self.place = np.zeros(0, np.uint64), np.zeros((0, 2), np.int64)
        self.flat = np.zeros(0, np.uint32)

    def _ids(self, pieces: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces one after another, and where each piece's begin.

        Pieces that start with a cut space are encoded as one text: the cuts hold in it too.
        """
        data, at = buffer_of(pieces)
        first, second = data[at[:-1]], data[np.minimum(at[:-1] + 1, len(data) - 1)]
        if ((first == 32) & _LEAD[second] & (np.diff(at) > 1)).all():
            ids = np.array(self.encoding.encode_ordinary(data.tobytes().decode()), np.uint32)
            return ids, np.searchsorted(np.cumsum(self.width[ids]), at, "right")
        one = lambda p: [self.special[p]] if p in self.special else self.encoding.encode_ordinary(p)
        each = [np.array(one(p), np.uint32) for p in pieces.to_pylist()]
        return np.concatenate(each), np.concatenate([[0], np.cumsum([len(x) for x in each])])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids as unsigned 32-bit numbers, and for each row the index of its first (one more entry than rows)."""
        data, rows = buffer_of(texts)
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(rows), np.int64)
        cut = np.zeros(len(data) + 1, bool)
        cut[:-2] = (data[:-1] == 32) & _LEAD[data[1:]]
        # A special string is a piece of its own; white space before it ends a text there, so it is not cut.
        spans = [m.span() for s in self.special for m in re.finditer(re.escape(s.encode()), data)]
        low, high = np.array(spans, np.int64).reshape(-1, 2).T
        whole = np.searchsorted(rows, low, "right") == np.searchsorted(rows, high - 1, "right")
        low, high = low[whole], high[whole]
        cut[low[low > 0] - 1] = False
        cut[low] = cut[high] = cut[rows] = True
        at = np.flatnonzero(cut)
        pieces = pa.LargeStringArray.from_buffers(
            len(at) - 1, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))
        ).dictionary_encode()
        words, which = pieces.dictionary, pieces.indices.to_numpy()
        bytes_, spans = buffer_of(words)
        name = span_hashes(bytes_, spans[:-1], spans[1:])
        slot = np.minimum(np.searchsorted(self.known, name), max(len(self.known) - 1, 0))
        old = self.known[slot] == name if len(self.known) else np.zeros(len(name), bool)
        place = np.empty((len(name), 2), np.int64)
        place[old] = self.place[slot[old]]
        flat = [self.flat]
        spaced = (bytes_[spans[:-1]] == 32) & _LEAD[bytes_[np.minimum(spans[:-1] + 1, len(bytes_) - 1)]]
        spaced &= np.diff(spans) > 1
        for group in (np.flatnonzero(~old & spaced), np.flatnonzero(~old & ~spaced)):
            if len(group):
                ids, begins = self._ids(words.take(pa.array(group)))
                base = sum(map(len, flat))
                place[group] = np.stack([base + begins[:-1], np.diff(begins)], axis=1)
                flat.append(ids)
        flat = np.concatenate(flat)
        fresh = np.flatnonzero(~old & spaced)
        if len(fresh) and len(self.known) + len(fresh) <= MEMO:
            # Ids of spaced pieces follow ``flat`` directly, so their places stay valid.
            self.flat = flat[: len(self.flat) + int(place[fresh, 1].sum())]
            known, where = np.concatenate([self.known, name[fresh]]), np.concatenate([self.place, place[fresh]])
            order = np.argsort(known)
            self.known, self.place = known[order], where[order]
        index, per_piece = _ragged(place[which, 0], place[which, 1])
        return flat[index], per_piece[np.searchsorted(at, rows)]

    def decode(self, ids) -> str:
        return self.encoding.decode([int(i) for i in ids])


_encoders: dict[tuple[str | None, bool], Encoder] = {}


def encoder(path: str | None = None, special: bool = False) -> Encoder:
    """One encoder per Python worker, vocabulary file and treatment of special strings."""
    if (path, special) not in _encoders:
        _encoders[path, special] = Encoder(path, special)
    return _encoders[path, special]
