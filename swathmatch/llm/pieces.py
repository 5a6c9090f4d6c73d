"""SentencePiece encoding and decoding by a table of distinct chunks.

Where no piece of the vocabulary holds a white-space marker behind another
character, no merge crosses the place ahead of a marked word.  So the marked words
of a block of text are segmented once each, in one call of the library, and the
ids are joined back by the words' positions.

The table belongs to a worker and outlasts a block; when it is full a new one is
begun.  A table of all documents' words would have to be sent to every place a
word stands at, which moves more bytes than the texts hold; segmenting a word
again in another task costs microseconds.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from swathmatch.llm.shared import whole_text

MARK = "▁"
# chunks in a worker's table before a new one is begun, and characters of them
TABLE, TABLE_CHARS = 400_000, 1 << 25
# chunks joined at once, so that a very long text needs little memory
AT_ONCE = 1 << 17

_CHUNK = re.compile(f"{MARK}({MARK}*[^{MARK}]*)")


class ChunkTable:
    """Encoder and decoder of one ``sentencepiece`` model file.

    Chunks are written without the marker they begin with: a chunk is what the
    library is given, as it puts that marker in front.
    """

    def __init__(self, path: str, table: int = TABLE):
        from sentencepiece import SentencePieceProcessor
        from sentencepiece.sentencepiece_model_pb2 import ModelProto

        self.library = SentencePieceProcessor(model_file=path)
        spec = ModelProto()
        spec.ParseFromString(self.library.serialized_model_proto())
        norm, trainer = spec.normalizer_spec, spec.trainer_spec
        plain = not norm.precompiled_charsmap and norm.add_dummy_prefix and norm.escape_whitespaces and not norm.remove_extra_whitespaces
        pieces = [p.piece for p in spec.pieces]
        within = any(MARK in p.lstrip(MARK) for p in pieces) or trainer.treat_whitespace_as_suffix
        marker = self.library.piece_to_id(MARK)
        # else a whole text is one chunk
        self.independent = plain and not within and marker != self.library.unk_id()
        self.most, self.marker = table, np.array([marker], "<u4").tobytes()
        self.begin, self.end = (np.array([i], "<u4").tobytes() for i in (self.library.bos_id(), self.library.eos_id()))
        self.surface = [self._surface(i, p, trainer.unk_surface) for i, p in enumerate(pieces)]
        # the library leaves out the marker that encoding has put in front
        self.strips = norm.add_dummy_prefix
        self.forget()

    def _surface(self, i: int, piece: str, unknown: str) -> bytes:
        if self.library.is_control(i):
            return b""
        if self.library.is_unknown(i):
            return unknown.encode()
        if self.library.is_byte(i):
            return bytes([int(piece[3:-1], 16)])
        return piece.replace(MARK, " ").encode()

    def forget(self) -> None:
        self.ids: dict[str, bytes] = {}
        self.chars = 0

    def chunks(self, text: str) -> list[str]:
        """The marked words of *text*, each without its first marker."""
        if not text:
            return []
        if not self.independent:
            return [text]
        marked = text.replace(" ", MARK)
        if marked[0] != MARK and MARK + MARK not in marked:
            return marked.split(MARK)
        return _CHUNK.findall(MARK + marked)

    def learn(self, words: list[str]) -> None:
        """Put the words which are not in the table into it, each segmented once."""
        if len(self.ids) > self.most or self.chars > TABLE_CHARS:
            self.forget()
        new = [w for w in set(words) if w not in self.ids]
        for word, ids in zip(new, self.library.encode(new, num_threads=1), strict=True):
            self.ids[word] = np.array(ids, "<u4").tobytes()
        self.chars += sum(map(len, new))
        if self.independent and "" in self.ids:
            self.ids[""] = self.marker

    def encode(self, text: str) -> Iterator[bytes]:
        """The ids as little-endian unsigned 32-bit integers, part by part, with the
        begin and the end id."""
        yield self.begin
        words = self.chunks(text)
        for i in range(0, len(words), AT_ONCE):
            part = words[i : i + AT_ONCE]
            self.learn(part)
            yield b"".join(map(self.ids.__getitem__, part))
        yield self.end

    def decode(self, ids: bytes) -> str:
        """The text of packed ids, as the library's ``decode`` gives it."""
        numbers = np.frombuffer(ids, "<u4").tolist()
        said = b"".join(map(self.surface.__getitem__, numbers))
        try:
            text = said.decode()
        except UnicodeDecodeError:
            # bytes that are no text: the library has its own signs for them
            return self.library.decode(numbers)
        if 0 in numbers:
            return self.library.decode(numbers)
        return text[1:] if self.strips and text[:1] == " " and self._marked_first(numbers) else text

    def _marked_first(self, numbers: list[int]) -> bool:
        first = next((i for i in numbers if not self.library.is_control(i)), None)
        return first is not None and self.library.id_to_piece(first).startswith(MARK)


@lru_cache(maxsize=4)
def chunk_table(path: str) -> ChunkTable:
    return ChunkTable(path)


def encode_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of *docs*: its id, ``ids`` (binary, little-endian unsigned
    32-bit, with begin and end id) of the whole text, and ``decoded``, the text
    those ids stand for.

    A NULL text counts as empty; an empty text has the begin and the end id only
    and decodes to an empty text; a marker character in a text is a space to the
    library, and so it is here; a NULL id stays NULL; repeated rows stay; other
    columns are not read.
    """
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder = chunk_table(path)
        for frame in frames:
            ids = [b"".join(coder.encode(t)) for t in frame["text"]]
            yield pd.DataFrame({"id": frame["id"], "ids": ids, "decoded": [coder.decode(x) for x in ids]})

    rows = docs.select(F.col(id_col).cast("long").alias("id"), whole_text(text_col).alias("text"))
    return rows.mapInPandas(run, "id long, ids binary, decoded string").withColumnRenamed("id", id_col)


def decode_ids(rows: DataFrame, path: str, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """*rows* with the text of the packed ids in *ids_col* beside (no ids: empty; NULL: NULL).

    A column named *out* is replaced; all others stay as they are.
    """
    @F.pandas_udf("string")
    def text(ids: pd.Series) -> pd.Series:
        coder = chunk_table(path)
        return ids.map(lambda x: None if x is None else coder.decode(bytes(x)))

    return rows.withColumn(out, text(F.col(ids_col)))


def digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``encode_documents`` with digests instead of the ids and texts, so that
    these need not leave the worker: n_tokens, ids_sha256, decoded_sha256."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder = chunk_table(path)
        for frame in frames:
            out = []
            for text in frame["text"]:
                ids = b"".join(coder.encode(text))
                said = coder.decode(ids).encode()
                out.append((len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(said).hexdigest()))
            n, a, b = zip(*out, strict=True) if out else ((), (), ())
            yield pd.DataFrame({"id": frame["id"], "n_tokens": n, "ids_sha256": a, "decoded_sha256": b})

    rows = docs.select(F.col(id_col).cast("long").alias("id"), whole_text(text_col).alias("text"))
    out = rows.mapInPandas(run, "id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
    return out.withColumnRenamed("id", id_col)
