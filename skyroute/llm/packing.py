"""Packing by power-of-two decomposition.

A document is its token ids and the end id. Its length in binary cuts it into pieces of
power-of-two lengths, the largest first, after as many pieces of the greatest length as
fit. Each piece is a sequence of its own, so no sequence crosses documents and none is
padded; pieces of one length share a bucket, and a training batch draws from one bucket.

Defined cases: a null or empty text is the end id alone, one piece of length 1; a
repeated row is packed once more; a null ``doc_id`` stays null; other columns are
ignored; no rows give no pieces. ``sequence_id`` is unique in one evaluation and depends
on how the input is split, so write the pieces before using the ids twice.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_TOKENS = 4096
END_ID = 2
CACHE_WORDS = 1_000_000
# Small Latin letters, then ASCII marks other than the apostrophe: the word model always
# cuts between the two, wherever it stands.
_LETTERS_MARKS = re.compile(r"([a-zß-öø-ÿ]+)([!#$%&()*+,\-./:;<=>?@\[\]^_{|}~]*)")
_UPPER = {c: c + 32 for c in range(65, 91)}
# The model writes UTF-8 bytes as letters; those of the letters above that are not
# printable in Latin-1 follow U+0121 in order.
_BYTES = {**{b: 290 + b - 128 for b in range(128, 161)}, 173: 323}


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class WordEncoder(dict):
    """Ids of texts, word by word; a dictionary of at most ``CACHE_WORDS`` known words.

    The model cuts at blanks and newlines before anything else and lower-cases, so a
    text's ids are those of its words in order. A word of small Latin letters goes to the
    merge model at once; any other word takes the whole tokenizer.
    """

    def __init__(self, vocabulary: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self._whole = Tokenizer.from_file(vocabulary)
        self._merges = self._whole.model

    def _encode(self, text: str) -> bytes:
        return np.array(self._whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _letters(self, word: str) -> bytes:
        if not word.isascii():
            word = word.encode().decode("latin-1").translate(_BYTES)
        ids = [t.id for t in self._merges.tokenize(word)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def __missing__(self, word: str) -> bytes:
        if len(self) >= CACHE_WORDS:
            self.clear()
        low = word.lower() if word.isascii() else word.translate(_UPPER)
        if parts := _LETTERS_MARKS.fullmatch(low):
            letters, marks = parts.groups()
            if not marks and low == word:
                ids = self._letters(word)
            elif marks:
                ids = self[letters] + (self.get(marks) or self._encode(marks))
                self[marks] = ids[len(self[letters]) :]
            else:
                ids = self[low]
        else:
            ids = self._encode(word)
        self[word] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """Little-endian 32-bit ids of ``text``."""
        if "<|" in text:  # special tokens may touch other characters
            return self._encode(text)
        return b"".join(map(self.__getitem__, text.replace("\n", " ").split(" ")))


def cut_lengths(n: int, longest: int = MAX_TOKENS) -> list[int]:
    """Powers of two that add up to ``n``, none above ``longest``, itself one of them."""
    rest = n % longest
    return [longest] * (n // longest) + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def pack(
    docs: DataFrame, vocabulary: str, longest: int = MAX_TOKENS, end_id: int = END_ID, with_ids: bool = True
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids, ids_crc32, doc_tokens, bucket,
    sequence_id and offset. ``with_ids=False`` leaves out the ids themselves."""
    if longest < 1 or longest & (longest - 1):
        raise ValueError("longest must be a power of two")
    key = docs.schema["doc_id"].dataType
    end = np.array([end_id], "<u4").tobytes()

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder(vocabulary)
        for batch in batches:
            at, rows, ids = [], [], []
            size = 0
            texts = batch.column(1)
            for i in range(batch.num_rows):
                data = encoder.encode(texts[i].as_py() or "") + end
                n, start = len(data) // 4, 0
                for length in cut_lengths(n, longest):
                    part = data[4 * start : 4 * (start + length)]
                    at.append(i)
                    rows.append((start, length, zlib.crc32(part), n))
                    if with_ids:
                        ids.append(np.frombuffer(part, "<i4"))
                        size += len(part)
                    start += length
                if size > 1 << 24 or len(rows) > 1 << 16:
                    yield out(batch, at, rows, ids)
                    at, rows, ids, size = [], [], [], 0
            if rows:
                yield out(batch, at, rows, ids)

    def out(batch: pa.RecordBatch, at: list, rows: list, ids: list) -> pa.RecordBatch:
        columns = [batch.column(0).take(pa.array(at, pa.int32()))]
        columns += [pa.array(c, pa.int64()) for c in zip(*rows)]
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
        if with_ids:
            ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
            columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids).astype(np.int32))))
            names.append("ids")
        return pa.RecordBatch.from_arrays(columns, names)

    schema = f"doc_id {key.simpleString()}, start long, length long, ids_crc32 long, doc_tokens long"
    schema += ", ids array<int>" if with_ids else ""
    cut = docs.select("doc_id", "text").mapInArrow(pieces, schema)
    return cut.select(
        "*",
        F.log2("length").cast("int").alias("bucket"),
        F.monotonically_increasing_id().alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )


def write_buckets(pieces: DataFrame, path: str) -> None:
    """Write the pieces with one folder per length, for batches of equal sequences."""
    pieces.write.partitionBy("bucket").mode("overwrite").parquet(path)
