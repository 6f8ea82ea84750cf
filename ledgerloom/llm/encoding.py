"""Token ids of a whole corpus with a public tokenizer.

Method: monoid tree reduction. A long text is halved recursively; the leaves are encoded in bulk; neighbours are
joined by re-encoding a window around their boundary that grows until the tokens outside it are provably stable.
Decoding concatenates up the same tree.

Why the tokens outside a window are stable: the byte-level vocabularies split a text into pieces by a pattern before
any merge. No piece has a white-space character directly after another kind of character, and none joins letters,
numbers and other characters but the contractions, which begin with an apostrophe. So each place where white space
follows something else, or where one of these kinds follows another (other than a letter after an apostrophe), is a
boundary of pieces in every text that contains it. The pattern looks ahead only behind white space and never behind its
start, hence the ids of a text are the ids up to such a place followed by the ids from there on. A window that begins
and ends at such places (or at the ends of the text) can be exchanged without touching the ids outside. A text without
such places, one run of letters, say, is re-encoded as a whole.
"""

from __future__ import annotations

import base64
import functools
import os
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed value: the piece pattern of the byte-level vocabularies, as published with them.
BYTE_LEVEL_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
TOKENIZER_DIR = "/opt/tokenizers"
DEFAULT = "byte_bpe_50k"
#: Characters that Unicode counts as white space, as the pattern's \s does.
_SPACE = frozenset(map(chr, (*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))


@dataclass(frozen=True)
class Tokenizer:
    encoding: tiktoken.Encoding
    lengths: np.ndarray  # bytes of each token


@functools.lru_cache(maxsize=4)
def load_tokenizer(name: str = DEFAULT, folder: str = TOKENIZER_DIR) -> Tokenizer:
    """A byte-level tokenizer from its file of ranks; its path is a parameter, nothing is copied."""
    with open(os.path.join(folder, f"{name}.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    lengths = np.zeros(max(ranks.values()) + 1, np.int64)
    for token, rank in ranks.items():
        lengths[rank] = len(token)
    return Tokenizer(tiktoken.Encoding(name, pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=ranks, special_tokens={}), lengths)


@functools.lru_cache(maxsize=1 << 17)
def _kind(c: str) -> str:
    """' ' for white space, L, N or O for letters, numbers and other visible characters, '' where engines may differ."""
    if c in _SPACE:
        return " "
    major = unicodedata.category(c)[0]
    return major if major in "LN" else "O" if major in "PS" else ""


def is_boundary(text: str, i: int) -> bool:
    """Whether pieces certainly end before text[i], 0 < i < len(text)."""
    a, b = _kind(text[i - 1]), _kind(text[i])
    if a == " " or not a or not b:
        return b == " " and a != " "
    return a != b and not (b == "L" and text[i - 1] == "'")


def boundary_before(text: str, at: int, least: int) -> int | None:
    """The last certain boundary of pieces in [least, at), or None."""
    return next((i for i in range(at - 1, max(least, 1) - 1, -1) if is_boundary(text, i)), None)


def boundary_after(text: str, at: int, most: int) -> int | None:
    """The first certain boundary of pieces in (at, most], or None."""
    return next((i for i in range(at + 1, min(most, len(text) - 1) + 1) if is_boundary(text, i)), None)


def join_ids(tok: Tokenizer, text: str, lo: int, mid: int, hi: int, left: np.ndarray, right: np.ndarray, window: int = 32) -> np.ndarray:
    """Ids of text[lo:hi] from the ids of text[lo:mid] and text[mid:hi]."""
    span = window
    while True:
        a = boundary_before(text, mid, max(lo, mid - span))
        b = boundary_after(text, mid, min(hi, mid + span))
        begin = lo if a is None and mid - span <= lo else a
        end = hi if b is None and mid + span >= hi else b
        if begin is not None and end is not None:
            break
        span *= 2
    if begin < lo or end > hi:
        raise AssertionError("a window left its text")
    middle = np.array(tok.encoding.encode_ordinary(text[begin:end]), np.int64)
    drop_left = len(text[begin:mid].encode())  # bytes of the exchanged part
    from_end = np.cumsum(tok.lengths[left][::-1])
    keep_left = len(left) - int(np.searchsorted(from_end, drop_left) + 1) if drop_left else len(left)
    drop_right = len(text[mid:end].encode())
    from_start = np.cumsum(tok.lengths[right])
    skip_right = int(np.searchsorted(from_start, drop_right) + 1) if drop_right else 0
    if (drop_left and from_end[len(left) - keep_left - 1] != drop_left) or (drop_right and from_start[skip_right - 1] != drop_right):
        raise AssertionError("a stable boundary is no token boundary")
    return np.concatenate([left[:keep_left], middle, right[skip_right:]])


def encode_tree(tok: Tokenizer, text: str, leaf: int = 4096) -> np.ndarray:
    """Ids of one text by halving it down to leaves of at most ``leaf`` characters and joining them pairwise."""
    parts: list[tuple[int, int, np.ndarray]] = []
    count = max(1, -(-len(text) // leaf))
    edges = [len(text) * k // count for k in range(count + 1)]
    for lo, hi in zip(edges, edges[1:]):
        parts.append((lo, hi, np.array(tok.encoding.encode_ordinary(text[lo:hi]), np.int64)))
    while len(parts) > 1:
        joined = [(a[0], b[1], join_ids(tok, text, a[0], a[1], b[1], a[2], b[2])) for a, b in zip(parts[::2], parts[1::2])]
        parts = joined + parts[len(parts) - len(parts) % 2 :]
    return parts[0][2]


def decode_tree(tok: Tokenizer, ids: list[int], leaf: int = 4096) -> str:
    """Text of ids: bytes of the leaves concatenated up the tree, then read as UTF-8."""
    if len(ids) <= leaf:
        return tok.encoding.decode_bytes(list(ids)).decode("utf-8")

    def up(lo: int, hi: int) -> bytes:
        if hi - lo <= leaf:
            return tok.encoding.decode_bytes(list(ids[lo:hi]))
        mid = (lo + hi) // 2
        return up(lo, mid) + up(mid, hi)

    return up(0, len(ids)).decode("utf-8")


def ids_of(tok: Tokenizer, texts: list[str | None], leaf: int = 4096) -> list[np.ndarray | None]:
    out: list[np.ndarray | None] = []
    for t in texts:
        if t is None:
            out.append(None)
        elif len(t) <= leaf:
            out.append(np.array(tok.encoding.encode_ordinary(t), np.int64))
        else:
            out.append(encode_tree(tok, t, leaf))
    return out


def _list_array(rows: list[np.ndarray | None]) -> pa.ListArray:
    sizes = np.array([0 if r is None else len(r) for r in rows], np.int64)
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    flat = np.concatenate([r for r in rows if r is not None]) if sizes.sum() else np.empty(0, np.int64)
    missing = pa.array([r is None for r in rows])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat.astype(np.int32), pa.int32()), mask=missing)


def encode(df: DataFrame, key: str, text: str, tokenizer: str = DEFAULT, folder: str = TOKENIZER_DIR, leaf: int = 4096, chunk_chars: int = 4_000_000) -> DataFrame:
    """(key, ids): token ids of each row's text, without special tokens, one row per input row.

    An empty text has an empty list, a null text has null ids (so decoding gives back exactly the input, null
    included); strings of special tokens are ordinary text; repeated rows are encoded each; white space and odd
    characters are kept; other columns are ignored. Output batches are cut at ``chunk_chars`` characters of text, so
    memory holds a few texts and their ids, however long the partition is.
    """
    narrow = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = narrow.schema["key"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = load_tokenizer(tokenizer, folder)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            lo = used = 0
            for i, t in enumerate(texts):
                used += len(t or "")
                if used >= chunk_chars or i == len(texts) - 1:
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, i + 1 - lo), _list_array(ids_of(tok, texts[lo : i + 1], leaf))], names=[key, "ids"])
                    lo, used = i + 1, 0

    return narrow.mapInArrow(work, f"`{key}` {kind}, ids array<int>")


def token_counts(df: DataFrame, key: str, text: str, tokenizer: str = DEFAULT, folder: str = TOKENIZER_DIR, leaf: int = 4096) -> DataFrame:
    """(key, n_tokens): the length of each row's ids, 0 for an empty text and null for a null one."""
    narrow = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = narrow.schema["key"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = load_tokenizer(tokenizer, folder)
        for batch in batches:
            counts = [None if t is None else len(ids_of(tok, [t], leaf)[0]) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64())], names=[key, "n_tokens"])

    return narrow.mapInArrow(work, f"`{key}` {kind}, n_tokens bigint")


def decode(df: DataFrame, key: str, ids: str, tokenizer: str = DEFAULT, folder: str = TOKENIZER_DIR) -> DataFrame:
    """(key, text): the texts of the rows' ids; an empty list is an empty text, null ids are a null text. Undoes ``encode``."""
    narrow = df.select(F.col(key).alias("key"), F.col(ids).alias("ids"))
    kind = narrow.schema["key"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = load_tokenizer(tokenizer, folder)
        for batch in batches:
            texts = [None if x is None else decode_tree(tok, x) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=[key, "text"])

    return narrow.mapInArrow(work, f"`{key}` {kind}, text string")
