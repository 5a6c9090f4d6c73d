"""Byte-pair encoding and decoding of whole texts, cut at forced boundaries.

A byte pair that occurs inside no token of the vocabulary can never be merged,
so a text may be cut there, its fragments encoded on their own and the ids put
together again.  Few fragments are new: each worker remembers those it has met.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache
from weakref import WeakValueDictionary

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from swathmatch.llm.shared import whole_text

# fragments in each of a worker's two generations of remembered ones
REMEMBERED = 400_000
# fragments handled at once, so that a very long text needs little memory
AT_ONCE = 1 << 16


class Remembered(dict):
    """Answers by key, computed when first asked for.

    Holds a bounded number in two generations: when the young one is full the old
    one is forgotten, but for what has been asked for since.
    """

    alive: WeakValueDictionary[int, Remembered] = WeakValueDictionary()

    def __init__(self, answer, most: int = REMEMBERED):
        super().__init__()
        self.answer, self.most = answer, most
        self.old = {}
        self.alive[id(self)] = self

    def only(self) -> None:
        """Let all others of this worker forget: one operator's memory at a time."""
        for other in list(self.alive.values()):
            if other is not self:
                other.clear()
                other.old = {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.answer(key)
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


def byte_letters() -> list[str]:
    """The letter by which byte-level vocabularies write each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {b: chr(b) for b in plain}
    for b in range(256):
        letters.setdefault(b, chr(256 + len(letters) - len(plain)))
    return [letters[b] for b in range(256)]


class ForcedBoundaries:
    """Encoder and decoder of one byte-level vocabulary file of ``tokenizers``.

    Guards beside the byte pair: a cut has a printable ASCII byte on its left and
    the first byte of a character on its right (fragments stay texts; white space,
    whose runs look ahead, keeps what follows it), and an apostrophe is cut off
    after letters and digits only (elsewhere it would start a contraction anew).
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        byte_of = {c: b for b, c in enumerate(byte_letters())}
        added = {t["id"]: t["content"].encode() for t in spec["added_tokens"]}
        tokens = {i: bytes(byte_of[c] for c in t) for t, i in spec["model"]["vocab"].items()}
        self.token_bytes = tokens | added
        self.forced = self._forced_pairs(self.token_bytes.values())
        self.fragment_ids = Remembered(self._encode_fragment)

    @staticmethod
    def _forced_pairs(tokens) -> np.ndarray:
        inside = np.zeros((256, 256), dtype=bool)
        for t in tokens:
            b = np.frombuffer(t, dtype=np.uint8)
            inside[b[:-1], b[1:]] = True
        left, right = np.arange(256)[:, None], np.arange(256)[None, :]
        alnum = np.array([chr(b).isalnum() and b < 128 for b in range(256)])[:, None]
        safe = (left > 32) & (left < 127) & ((right < 128) | (right >= 0xC0)) & ((right != ord("'")) | alnum)
        return (~inside & safe).reshape(-1)

    def _encode_fragment(self, fragment: bytes) -> bytes:
        ids = self.tokenizer.encode(fragment.decode(), add_special_tokens=False).ids
        return np.array(ids, dtype="<u4").tobytes()

    def cuts(self, data: bytes) -> list[int]:
        """Offsets of all fragments of *data*, with 0 and its length."""
        b = np.frombuffer(data, dtype=np.uint8)
        pair = b[:-1].astype(np.uint16) * np.uint16(256) + b[1:]
        return [0, *(np.flatnonzero(self.forced[pair]) + 1).tolist(), len(data)] if len(data) else [0]

    def encode(self, text: str) -> Iterator[bytes]:
        """The ids as little-endian unsigned 32-bit integers, piece by piece."""
        data = text.encode()
        cuts, known = self.cuts(data), self.fragment_ids
        for i in range(0, len(cuts) - 1, AT_ONCE):
            at = cuts[i : i + AT_ONCE + 1]
            yield b"".join([known[data[s:e]] for s, e in zip(at, at[1:], strict=False)])

    def decode(self, ids: bytes) -> bytes:
        """The bytes of packed ids; ids outside the vocabulary say nothing."""
        return b"".join([self.token_bytes.get(i, b"") for i in np.frombuffer(ids, dtype="<u4").tolist()])


@lru_cache(maxsize=4)
def boundaries(path: str) -> ForcedBoundaries:
    return ForcedBoundaries(path)


def encode_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of *docs*: its id, ``ids`` (binary, little-endian unsigned
    32-bit) of the whole text, and ``decoded``, the text those ids stand for.

    A NULL text counts as empty; an empty text has no ids and decodes to an empty
    text; a NULL id stays NULL; repeated rows stay; other columns are not read.
    """
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder = boundaries(path)
        coder.fragment_ids.only()
        for frame in frames:
            ids = [b"".join(coder.encode(t)) for t in frame["text"]]
            texts = [coder.decode(x).decode("utf-8", "replace") for x in ids]
            yield pd.DataFrame({"id": frame["id"], "ids": ids, "decoded": texts})

    rows = docs.select(F.col(id_col).cast("long").alias("id"), whole_text(text_col).alias("text"))
    return rows.mapInPandas(run, "id long, ids binary, decoded string").withColumnRenamed("id", id_col)


def digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``encode_documents`` with digests instead of the ids and texts, so that
    these need not leave the worker: n_tokens, ids_sha256, decoded_sha256."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder = boundaries(path)
        coder.fragment_ids.only()
        for frame in frames:
            out = []
            for text in frame["text"]:
                n, of_ids, parts = 0, hashlib.sha256(), []
                for ids in coder.encode(text):
                    n += len(ids) // 4
                    of_ids.update(ids)
                    parts.append(coder.decode(ids))
                decoded = b"".join(parts).decode("utf-8", "replace").encode()
                out.append((n, of_ids.hexdigest(), hashlib.sha256(decoded).hexdigest()))
            n, a, b = zip(*out, strict=True) if out else ((), (), ())
            yield pd.DataFrame({"id": frame["id"], "n_tokens": n, "ids_sha256": a, "decoded_sha256": b})

    rows = docs.select(F.col(id_col).cast("long").alias("id"), whole_text(text_col).alias("text"))
    out = rows.mapInPandas(run, "id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
    return out.withColumnRenamed("id", id_col)
