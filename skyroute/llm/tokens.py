"""Token counts of every prefix of a text, by dynamic programming over its bytes.

The encoding of a byte pair model has two properties: leaving out its last token gives
the encoding of a shorter prefix, and a sequence of tokens is an encoding exactly if each
two neighbours are the encoding of their own bytes. So the last token of each prefix is
the one token that ends there and stands well beside the last token of what precedes it,
and the count is one more than the count there. One pass over a piece of text finds the
counts at all its ends; whether two tokens stand well together is remembered.

Pieces are what the model's splitter cuts texts into. A cut text is split like the whole
one but for its last piece, which differs where it ends inside a run of blanks or a
contraction; these counts are made by the same pass over the pieces of the cut text.

``prefix_counts`` stores, for each code point, by how much its prefix has more tokens than
the one before, in ``width`` bytes each. ``tokens_at`` and ``chars_within`` answer what a
text cut at some place costs and how much of it a budget holds, from that column alone.
A longer prefix can have fewer tokens, so a budget takes the longest prefix that fits.

Defined cases: a null or empty text has no bytes and no tokens; repeated rows are counted
each; a null ``doc_id`` stays null; other columns are ignored; no rows give no rows. A
very long text takes time in proportion to its length and one byte for each code point.
A special string in a text is one token, the model's default; cut, it is plain text.
"""

from __future__ import annotations

import functools
import json
import os
import re
from collections.abc import Iterator
from operator import sub

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from skyroute.llm.text import small_batches

LIMIT = 1024
CACHED, CACHED_CHARS, PAIRS = 1 << 19, 48, 1 << 20
OUT_BYTES = 1 << 24
_BLANK = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
# A text is cut before every run of blanks; no piece crosses such a place.
_UNITS = re.compile(f"[{_BLANK}]*[^{_BLANK}]+|[{_BLANK}]+")
# Words of Latin letters and the marks behind them, without the apostrophe: two pieces.
_WORD = re.compile(r"( ?[A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)")
_PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]
# Byte-level models write a byte without a printed sign as U+0100 and the following.
_LETTERS = dict(zip((b for b in range(256) if b not in _PRINTED), range(256, 512)))


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class PrefixCounter(dict):
    """Prefix counts of short units of text as bytes, a bounded cache.

    A value has one signed byte for each code point of its key: the tokens its prefix has
    more than the one before. It is None where a step does not fit a byte.
    """

    def __init__(self, vocabulary: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        with open(vocabulary, encoding="utf-8") as file:
            about = json.load(file)
        model, splitter = about["model"], about["pre_tokenizer"] or {}
        plain = not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
        splits = splitter.get("type") == "ByteLevel" and splitter.get("use_regex", True) and not splitter.get("add_prefix_space")
        added = about["added_tokens"]
        odd = any(a[k] for a in added for k in ("single_word", "lstrip", "rstrip", "normalized"))
        if model["type"] != "BPE" or not plain or not splits or about["normalizer"] or odd:
            raise ValueError("this needs a byte-level byte pair model without normalizer, prefixes or stripping")
        whole = Tokenizer.from_file(vocabulary)
        self._split, self._merge = whole.pre_tokenizer.pre_tokenize_str, whole.model.tokenize
        self._tokens = frozenset(model["vocab"])
        self._longest = max(map(len, self._tokens))
        self._special = re.compile("|".join(re.escape(a["content"]) for a in added)) if added else None
        self._pairs: dict[tuple[str, str], bool] = {}

    def _stand(self, pair: tuple[str, str]) -> bool:
        """Whether two tokens are the encoding of their bytes."""
        if len(self._pairs) >= PAIRS:
            self._pairs.clear()
        both = pair[0] + pair[1]
        ok = both not in self._tokens and tuple(t.value for t in self._merge(both)) == pair
        self._pairs[pair] = ok
        return ok

    def counts(self, piece: str) -> list[int]:
        """Tokens of each prefix of a piece, by its bytes written as letters."""
        tokens, pairs, longest = self._tokens, self._pairs, self._longest
        last, count = [], []  # of the prefix that ends with each byte
        for end in range(1, len(piece) + 1):
            token, n = piece[:end], 1
            if token not in tokens:
                # Short tokens are likelier here, and the order doesn't matter: one fits.
                for start in range(end - 1, max(0, end - longest - 1), -1):
                    token = piece[start:end]
                    if token in tokens:
                        pair = (last[start - 1], token)
                        ok = pairs.get(pair)
                        if self._stand(pair) if ok is None else ok:
                            n = count[start - 1] + 1
                            break
                else:
                    raise ValueError("the vocabulary lacks a byte")
            last.append(token)
            count.append(n)
        return count

    def _cut(self, text: str) -> int:
        """Tokens of a text by its own pieces."""
        return sum(self.counts(piece)[-1] for piece, _ in self._split(text))

    def unit_counts(self, unit: str) -> list[int]:
        """Tokens of each prefix of a unit, by its code points."""
        out: list[int] = []
        before = total = begin = 0
        blanks = False
        for piece, (first, last) in self._split(unit):
            text = unit[first:last]
            counts = self.counts(piece)
            if len(counts) > len(text):
                ends = np.cumsum([len(c.encode()) for c in text]) - 1
                counts = [counts[e] for e in ends]
            here = [total + c for c in counts]
            if text[0] == "'" and len(text) == 3:  # two letters of a contraction make one only together
                here[1] = total + self._cut(text[:2])
            if blanks and text[0].isspace():  # a text that ends here has one run of blanks
                here[0] = before + self._cut(unit[begin : first + 1])
            out += here
            before, begin, blanks, total = total, first, text.isspace(), total + counts[-1]
        return out

    def __missing__(self, unit: str) -> bytes | None:
        parts = _WORD.fullmatch(unit)
        line = unit[0] == "\n" and len(unit) > 1 and not unit[1].isspace()
        if line or parts and parts[2]:
            word, marks = (self["\n"], self[unit[1:]]) if line else (self[parts[1]], self[parts[2]])
            value = None if word is None or marks is None else word + marks
        else:
            if parts:
                counts = self.counts(unit.replace(" ", "Ġ")) if unit.isascii() else self._latin(unit)
            else:
                counts = self.unit_counts(unit)
            steps = list(map(sub, counts, [0, *counts]))
            value = bytes([s & 255 for s in steps]) if -128 <= min(steps) and max(steps) < 128 else None
        if len(unit) <= CACHED_CHARS:
            if len(self) >= CACHED:
                self.clear()
            self[unit] = value
        return value

    def _latin(self, word: str) -> list[int]:
        data = word.encode()
        counts = self.counts(data.decode("latin-1").translate(_LETTERS))
        return [c for c, following in zip(counts, [*data[1:], 0]) if following & 0xC0 != 0x80]

    def _plain_steps(self, text: str) -> np.ndarray:
        units = _UNITS.findall(text)
        parts = list(map(self.__getitem__, units))
        if None not in parts:
            return np.frombuffer(b"".join(parts), np.int8)
        return np.concatenate([np.diff(self.unit_counts(u), prepend=0) for u in units]).astype(np.int32)

    def steps(self, text: str) -> np.ndarray:
        """For each code point, the tokens its prefix has more than the one before."""
        found = [m.span() for m in self._special.finditer(text)] if self._special else []
        if not found:
            return self._plain_steps(text)
        out, begin = [], 0
        for first, last in found:
            part = self._plain_steps(text[begin : last - 1]).astype(np.int32)
            whole = part[: first - begin].sum() + 1  # what stands before, and the special token
            out += [part, [whole - part.sum()]]
            begin = last
        out.append(self._plain_steps(text[begin:]))
        steps = np.concatenate(out).astype(np.int32)
        return steps.astype(np.int8) if np.abs(steps).max() < 128 else steps


@functools.lru_cache(maxsize=1)
def counter_of(vocabulary: str) -> PrefixCounter:
    """Kept for all tasks of a worker process, as most words come again."""
    return PrefixCounter(vocabulary)


def prefix_counts(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Per row: doc_id, n_bytes, n_chars, n_tokens, and ``steps`` of ``width`` bytes each.

    ``vocabulary`` is the path of a tokenizer file on every executor.
    """
    small_batches(docs.sparkSession)
    key = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = counter_of(vocabulary)
        for batch in batches:
            first, size, rows = 0, 0, []
            for i in range(batch.num_rows):
                text = batch.column(1)[i].as_py() or ""
                steps = counter.steps(text)
                n_bytes = len(text) if text.isascii() else len(text.encode())
                rows.append((n_bytes, len(text), int(steps.sum(dtype=np.int64)), steps.itemsize, steps.tobytes()))
                size += steps.nbytes
                if size > OUT_BYTES or i + 1 == batch.num_rows:
                    yield out(batch.column(0).slice(first, len(rows)), rows)
                    first, size, rows = i + 1, 0, []

    def out(ids: pa.Array, rows: list) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
        columns = [pa.array(c, kind) for c, kind in zip(zip(*rows), kinds)]
        return pa.RecordBatch.from_arrays([ids, *columns], ["doc_id", "n_bytes", "n_chars", "n_tokens", "width", "steps"])

    schema = f"doc_id {key}, n_bytes long, n_chars long, n_tokens long, width int, steps binary"
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def _totals(steps: bytes, width: int) -> np.ndarray:
    return np.cumsum(np.frombuffer(steps, f"<i{width}"), dtype=np.int64)


@F.pandas_udf(LongType())
def _tokens_at(steps: pd.Series, width: pd.Series, chars: pd.Series) -> pd.Series:
    def one(data, size, n):
        return int(np.frombuffer(data, f"<i{size}")[: max(n, 0)].sum(dtype=np.int64))

    return pd.Series([one(*row) for row in zip(steps, width, chars)], dtype="int64")


@F.pandas_udf(LongType())
def _chars_within(steps: pd.Series, width: pd.Series, budget: pd.Series) -> pd.Series:
    def one(data, size, most):
        fits = np.flatnonzero(_totals(data, size) <= most)
        return int(fits[-1]) + 1 if len(fits) else 0

    return pd.Series([one(*row) for row in zip(steps, width, budget)], dtype="int64")


def tokens_at(chars: Column | int) -> Column:
    """Tokens of the first ``chars`` code points, of rows of ``prefix_counts``."""
    return _tokens_at("steps", "width", F.lit(chars).cast("long"))


def chars_within(budget: Column | int) -> Column:
    """Code points of the longest prefix of at most ``budget`` tokens."""
    return _chars_within("steps", "width", F.lit(budget).cast("long"))


def over_limit(limit: int = LIMIT) -> Column:
    """Whether the whole text has more tokens than ``limit``."""
    return F.col("n_tokens") > limit
