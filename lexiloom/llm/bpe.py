"""Byte-level BPE encoding with forced boundaries, and decoding.

A byte pair that no vocabulary token contains can never lie inside a token, so
it marks a certain cut. Every pre-token is cut there, the fragments are encoded
on their own (merges by the public library's model), and the ids are concatenated. Frequent pre-tokens and fragments
are remembered in tables of bounded size.

Work is row-local: no shuffle. Null text is empty and has no ids. Strings of
special tokens in a text are those tokens, as the public library does it.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
import struct

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lexiloom.llm.common import give_back

#: Entries remembered per task before a table starts anew.
MEMORY = 50_000
# Fixed value: the pre-tokenisation pattern of byte-level BPE.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"


# The same for texts of ASCII and the Latin letters of block Latin-1, for which the plain engine is faster.
_LATIN = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff"
_OTHER = re.compile(f"[^\0-\x7f{_LATIN}]")
_QUICK = re.compile(
    rf"'(?:[sdmt]|ll|ve|re)| ?[{_LATIN}]+| ?[0-9]+| ?[^\t-\r {_LATIN}0-9]+|[\t-\r ]+(?![^\t-\r ])|[\t-\r ]+"
)


def byte_letters() -> list[str]:
    """The printable letter that vocabulary files write for each byte."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


class _Remembered(dict):
    """A dictionary that computes what it lacks. When it is full, its entries get old;
    old ones that nobody asks for are gone when it is full again."""

    def __init__(self, compute, limit: int):
        super().__init__()
        self.compute, self.limit, self.old = compute, limit, {}

    def __missing__(self, key):
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        value = self.old.get(key)
        if value is None:
            value = self.compute(key)
        self[key] = value
        return value


class ByteBpe:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, path: str, memory: int = MEMORY):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        back = {ch: b for b, ch in enumerate(byte_letters())}
        raw = lambda token: bytes(map(back.__getitem__, token))
        vocab = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", ())}
        self.ids = {raw(t): i for t, i in vocab.items() if t not in self.special}
        self.token = {i: t for t, i in self.ids.items()} | {
            i: t.encode() for t, i in self.special.items()
        }
        # inside[a * 256 + b]: some token has byte b right after byte a.
        inside = np.zeros(1 << 16, dtype=bool)
        for token in self.ids:
            b = np.frombuffer(token, dtype=np.uint8).astype(np.int32)
            inside[b[:-1] * 256 + b[1:]] = True
        self.inside = inside.tobytes()
        # Merges inside one fragment are the public library's.
        self.model, self.letters = Tokenizer.from_file(path).model, dict(enumerate(byte_letters()))
        self.splitter = regex.compile(PATTERN)
        marks = "|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True))
        self.marks = regex.compile(f"({marks})") if marks else None
        self.fragments = _Remembered(self._merge, memory)
        self.pieces = _Remembered(self._piece, memory)

    def cut(self, data: bytes) -> list[bytes]:
        """Fragments between forced boundaries."""
        inside, out, start = self.inside, [], 0
        for i in range(1, len(data)):
            if not inside[data[i - 1] << 8 | data[i]]:
                out.append(data[start:i])
                start = i
        out.append(data[start:])
        return out

    def _piece(self, piece: str) -> bytes:
        return b"".join([self.fragments[x] for x in self.cut(piece.encode())])

    def _merge(self, data: bytes) -> bytes:
        """Ids of a fragment as little-endian 32-bit numbers."""
        ids = [t.id for t in self.model.tokenize(data.decode("latin-1").translate(self.letters))]
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian 32-bit numbers."""
        pieces = self.pieces
        split = self.splitter.findall if _OTHER.search(text) else _QUICK.findall
        if self.marks is None or not any(s in text for s in self.special):
            return b"".join([pieces[p] for p in split(text)])
        out = []
        for k, part in enumerate(self.marks.split(text)):
            if k % 2:
                out.append(self.special[part].to_bytes(4, "little"))
            else:
                out += [pieces[p] for p in split(part)]
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        """Text of ids; bytes that are no UTF-8 become replacement characters."""
        parts = map(self.token.__getitem__, np.frombuffer(ids, dtype="<u4").tolist())
        return b"".join(parts).decode("utf-8", "replace")


@functools.lru_cache(maxsize=2)
def codec(path: str) -> ByteBpe:
    """One encoder per process and vocabulary file."""
    return ByteBpe(path)


def encode(text: Column, path: str) -> Column:
    """Token ids of each text as an array; null is empty."""

    @F.arrow_udf("array<int>")
    def run(texts: pa.Array) -> pa.Array:
        bpe = codec(path)
        ids = [np.frombuffer(bpe.encode(t or ""), dtype="<u4").astype(np.int32) for t in texts.to_pylist()]
        return pa.array(ids, type=pa.list_(pa.int32()))

    return run(text)


def decode(ids: Column, path: str) -> Column:
    """Text of each array of ids; null is empty."""

    @F.arrow_udf("string")
    def run(lists: pa.Array) -> pa.Array:
        bpe = codec(path)
        return pa.array([bpe.decode(np.array(x or (), dtype="<u4").tobytes()) for x in lists.to_pylist()])

    return run(ids)


def digests(text: Column, path: str) -> Column:
    """``n_tokens``, hash of the ids and hash of the text decoded from them."""

    @F.arrow_udf("struct<n_tokens: bigint, ids_sha256: string, decoded_sha256: string>")
    def run(texts: pa.Array) -> pa.Array:
        bpe, counts, ids_hash, text_hash = codec(path), [], [], []
        for scalar in texts:
            ids = bpe.encode(scalar.as_py() or "")
            counts.append(len(ids) // 4)
            ids_hash.append(hashlib.sha256(ids).hexdigest())
            text_hash.append(hashlib.sha256(bpe.decode(ids).encode()).hexdigest())
        give_back()
        return pa.StructArray.from_arrays(
            [pa.array(counts, pa.int64()), pa.array(ids_hash, pa.string()), pa.array(text_hash, pa.string())],
            names=["n_tokens", "ids_sha256", "decoded_sha256"],
        )

    return run.asNondeterministic()(text)
