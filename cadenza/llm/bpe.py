"""BPE encoding and decoding with reuse of content-defined chunks.

A text is cut where a rolling hash over its last 16 bytes has its low bits
zero, so passages that documents share fall into the same chunks wherever they
stand.  What a chunk's inner part encodes to is kept by the worker and reused
for every document that holds the chunk.

Joins are repaired by re-encoding.  A *certain* place is one between a letter
and an ASCII mark or blank: the pattern that splits text before the merges
ends a piece there whatever surrounds it, so both sides encode on their own.
A chunk keeps the tokens between its first and last certain place; around each
join the text from the last certain place before it to the first one after it
is encoded anew, over as many chunks as that takes.  The result then agrees
exactly with encoding the whole text.  Strings of special tokens are cut out
first, as the tokenizers library does.

Chunks are reused within a worker (its store is bounded) and not over a
shuffle: one shuffle of all chunks and one of their tokens would move more
than encoding them costs.  So there is no shuffle, no hot group, and a lost
executor only costs its own tasks.

Defined results: a null text counts as empty and has no tokens; long texts are
cut like any other; equal rows are encoded alike; columns of the input pass
through, except that one named like ``out`` is replaced; an empty table gives an
empty one.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from array import array
from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A chunk ends where this many low bits of the rolling hash are zero (512 bytes on average).
CUT_BITS = 9
#: ... or at this many bytes, for texts whose hash never cuts.
MAX_CHUNK = 1 << 14
#: Text bytes that a worker's store of chunks holds.
STORE_BYTES = 32 << 20
#: Windows above this many characters, and characters newer than this, are left to the tokenizers library.
LONG = 100_000
_NEW = re.compile("[ᲀ-᳿Ⱟⱟ鿰-鿿Ɪ-ꟿ\U00010000-\U0010ffff]")

_LETTER = "A-Za-zß-öø-ÿα-ωа-яぁ-んァ-ヴ一-龥가-힣"
_FIRST = re.compile(f"[{_LETTER}](?=[ \n\t.,;:!?()\"-])")
_LAST = re.compile(f".*[{_LETTER}](?=[ \n\t.,;:!?()\"-])", re.DOTALL)
_SPREAD = np.random.default_rng(16).integers(0, 1 << 32, 256, dtype=np.uint32)


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """The place of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level
    vocabulary: itself if printable, else the next one from U+0100 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(others)}


def cuts(raw: bytes, bits: int = CUT_BITS) -> list[int]:
    """Ends of the chunks of UTF-8 text, each at a character's start."""
    n = len(raw)
    if n == 0:
        return []
    b = np.frombuffer(raw, np.uint8)
    h = _SPREAD[b]
    factor, step = 0x9E3779B1, 1
    while step < 16:  # h[i] covers the last 2 * step bytes
        h[step:] = h[step:] + h[:-step] * np.uint32(factor) if n > step else h[step:]
        factor = factor * factor & 0xFFFFFFFF
        step *= 2
    at = np.flatnonzero((h >> np.uint32(32 - bits)) == 0) + 1
    at = at[at < n]
    ends = at[(b[at] & 0xC0) != 0x80].tolist() + [n]
    out, last = [], 0
    for e in ends:
        while e - last > MAX_CHUNK:
            last += MAX_CHUNK
            while raw[last] & 0xC0 == 0x80:
                last -= 1
            out.append(last)
        out.append(e)
        last = e
    return out


class Encoder:
    """Encodes and decodes with the byte-level BPE of a tokenizers file."""

    def __init__(self, path: str, cut_bits: int = CUT_BITS, store_bytes: int = STORE_BYTES):
        import tiktoken
        from tokenizers import Tokenizer

        spec = json.loads(open(path, encoding="utf-8").read())
        letters = _byte_alphabet()
        ranks = {bytes(letters[c] for c in token): i for token, i in spec["model"]["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for s in self.special:
            ranks.pop(s.encode(), None)
        pattern = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
        self.fast = tiktoken.Encoding("byte-level", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.whole = Tokenizer.from_file(path)
        self.whole.no_truncation()
        self.whole.no_padding()
        self.whole.encode_special_tokens = True  # their strings are cut out before
        self.tokens = {i: t for t, i in ranks.items()} | {i: s.encode() for s, i in self.special.items()}
        self.split = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self.cut_bits, self.store_bytes, self.held = cut_bits, store_bytes, 0
        self.store: OrderedDict[bytes, tuple[str, array | None, str]] = OrderedDict()

    @staticmethod
    def is_new(text: str) -> bool:
        """Whether a text has characters that are left to the tokenizers library."""
        return _NEW.search(text) is not None

    def window(self, text: str) -> list[int]:
        """Ids of a text that is not cut and whose special strings are ordinary text."""
        if not text:
            return []
        if len(text) > LONG or self.is_new(text):
            return self.whole.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)

    def _chunk(self, raw: bytes) -> tuple[str, array | None, str]:
        """Text before the first certain place, the tokens up to the last one,
        text after it; no tokens (None) if there are not two such places."""
        found = self.store.get(raw)
        if found is not None:
            self.store.move_to_end(raw)
            return found
        text = raw.decode()
        first = _FIRST.search(text)
        last = _LAST.match(text)
        if first is None or last.end() == first.end():
            found = (text, None, "")
        else:
            a, b = first.end(), last.end()
            found = (text[:a], array("I", self.window(text[a:b])), text[b:])
        self.store[raw] = found
        self.held += len(raw)
        while self.held > self.store_bytes:
            self.held -= len(self.store.popitem(last=False)[0])
        return found

    def _plain(self, text: str) -> list[int]:
        raw = text.encode()
        ids: list[int] = []
        open_text, start = [], 0
        for end in cuts(raw, self.cut_bits):
            before, inner, after = self._chunk(raw[start:end])
            start = end
            open_text.append(before)
            if inner is not None:
                ids += self.window("".join(open_text))
                ids += inner
                open_text = [after]
        ids += self.window("".join(open_text))
        return ids

    def encode(self, text: str | None) -> list[int]:
        if not text:
            return []
        if self.split is None:
            return self._plain(text)
        ids, at = [], 0
        for m in self.split.finditer(text):
            ids += self._plain(text[at : m.start()])
            ids.append(self.special[m.group()])
            at = m.end()
        return ids + self._plain(text[at:])

    def decode(self, ids) -> str:
        tokens = self.tokens
        return b"".join([tokens[i] for i in ids]).decode("utf-8", "replace")


_ENCODERS: dict[tuple, Encoder] = {}


def encoder(path: str, cut_bits: int = CUT_BITS, store_bytes: int = STORE_BYTES) -> Encoder:
    """The worker's encoder, kept with its store from task to task."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    key = (path, cut_bits, store_bytes)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(*key)
    return _ENCODERS[key]


def _mapped(df: DataFrame, column: str, fields: list[tuple[str, pa.DataType, str]], make) -> DataFrame:
    """``df`` with columns made from each value of ``column``: (name, Arrow
    type, SQL type) by ``make(values) -> arrays``."""
    names = [f[0] for f in fields]
    kept = [c for c in df.columns if c not in names]
    at = kept.index(column) if column in kept else None
    picked = df.select(*(F.col(f"`{c}`") for c in kept), *([] if at is not None else [F.col(f"`{column}`").alias("__in")]))
    source = at if at is not None else len(kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(0, b.num_rows, 256):  # long rows: a few at a time
                part = b.slice(k, 256)
                made = make(part.column(source))
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in range(len(kept))), *(pa.array(x, t) for x, (_, t, _) in zip(made, fields))], [*kept, *names])

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in picked.schema.fields[: len(kept)]] + [f"`{n}` {s}" for n, _, s in fields])
    return picked.mapInArrow(run, schema)


def encode(docs: DataFrame, text_col: str = "text", out: str = "ids", path: str | None = None) -> DataFrame:
    """``docs`` with the token ids of ``text_col``."""
    place = path or tokenizer_path()
    return _mapped(docs, text_col, [(out, pa.list_(pa.int32()), "array<int>")], lambda texts: [[encoder(place).encode(t.as_py()) for t in texts]])


def decode(docs: DataFrame, ids_col: str = "ids", out: str = "text", path: str | None = None) -> DataFrame:
    """``docs`` with the text that the ids of ``ids_col`` stand for (null: none)."""
    place = path or tokenizer_path()
    return _mapped(docs, ids_col, [(out, pa.string(), "string")], lambda ids: [[encoder(place).decode(x.as_py() or []) for x in ids]])


def round_trip(docs: DataFrame, text_col: str = "text", path: str | None = None) -> DataFrame:
    """``docs`` with ``n_tokens``, ``ids_sha256`` (of the ids as little-endian
    unsigned 32-bit numbers) and ``decoded_sha256`` (of the decoded text)."""
    place = path or tokenizer_path()

    def make(texts: pa.Array) -> tuple[list, list, list]:
        e, n, a, b = encoder(place), [], [], []
        for t in texts:
            ids = e.encode(t.as_py())
            n.append(len(ids))
            a.append(hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
            b.append(hashlib.sha256(e.decode(ids).encode()).hexdigest())
        return n, a, b

    fields = [("n_tokens", pa.int64(), "bigint"), ("ids_sha256", pa.string(), "string"), ("decoded_sha256", pa.string(), "string")]
    return _mapped(docs, text_col, fields, make)
