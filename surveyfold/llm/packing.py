"""Packing along a space-filling curve.

A document's token counts are hashed into a signed vector, damped, scaled to
length one and projected to ``DIMS`` numbers by a seeded random matrix; each is
mapped to ``CURVE_BITS`` bits and the Hilbert index of that cell is the
document's key. Documents are range-sorted by key and laid end to end, and the
line is cut every ``length`` tokens, so neighbours on the curve share
sequences. What is left at the end of the line is cut into powers of two,
which need no padding.

Token ids are computed once and written down. Only (key, row tag, count) is
range-sorted; a running sum inside every range and one total per range (the
only thing the driver sees) give each document its place, which is joined back
to its ids.
"""

from __future__ import annotations

import functools
import itertools
import os
import zlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage_table
from .common import ROW, bound_batches, text_or_empty, tidy

LENGTH, END_ID = 4096, 2
HASHED, DIMS, CURVE_BITS = 256, 3, 10
GATHER_WORDS = 1 << 18


# --- token ids ---------------------------------------------------------------

# a plain word is two pre-tokens: Latin letters, then ASCII marks other than an
# apostrophe (which may begin a contraction)
PLAIN = "^(?P<a>[A-Za-zÀ-ÖØ-öø-ÿ]+)(?P<b>[!-&(-/:-@\\[-`{-~]*)$"
JOINED = 64                  # pre-tokens that are encoded in one call
MOST_KNOWN = 150_000         # words of a kind that a worker remembers
SLICE_BYTES = 16 << 20       # of text whose distinct words are found together


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The concatenation of starts[i], ..., starts[i] + sizes[i] - 1."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + sizes, sizes)


class Flat(NamedTuple):
    """Lists of ids end to end."""

    ids: np.ndarray
    starts: np.ndarray
    sizes: np.ndarray

    @classmethod
    def of(cls, ids: np.ndarray, sizes: np.ndarray) -> Flat:
        return cls(ids, np.cumsum(sizes) - sizes, sizes)

    def take(self, which: np.ndarray) -> Flat:
        return Flat.of(self.ids[ranges(self.starts[which], self.sizes[which])], self.sizes[which])


class Known:
    """Ids of words met before, the first ``MOST_KNOWN`` of them."""

    def __init__(self):
        self.index: dict[str, int] = {}
        self.ids = Flat.of(np.zeros(0, dtype=np.uint32), np.zeros(0, dtype=np.int64))

    def look_up(self, words: list[str], encode: Callable[[list[str]], Flat]) -> Flat:
        """Ids of distinct words; those not known are encoded."""
        at = np.fromiter(map(self.index.get, words, itertools.repeat(-1)), dtype=np.int64, count=len(words))
        new = np.flatnonzero(at < 0)
        if not len(new):
            return self.ids.take(at)
        fresh, base = [words[i] for i in new], len(self.index)
        found = encode(fresh)
        at[new] = np.arange(len(fresh)) + base
        both = Flat.of(np.concatenate([self.ids.ids, found.ids]), np.concatenate([self.ids.sizes, found.sizes]))
        room = min(len(fresh), MOST_KNOWN - base)        # bounded: what comes later is encoded again
        if room > 0:
            self.ids = both.take(np.arange(base + room))
            self.index.update(zip(fresh[:room], range(base, base + room), strict=True))
        return both.take(at)


class WordTokenizer:
    """Ids of texts by a tokenizer that drops white space and never joins words.

    For such a tokenizer the ids of a text are those of its words in order, so
    only the distinct words of a batch are encoded.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"   # the task has one core
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.size = max(vocabulary.values(), default=0) + 1
        self.ends_word = np.zeros(self.size, dtype=bool)
        self.ends_word[[k for t, k in vocabulary.items() if t.endswith("</w>")]] = True
        self.letters, self.marks, self.others = Known(), Known(), Known()

    def one_by_one(self, parts: list[str]) -> Flat:
        found = [e.ids for e in self.tokenizer.encode_batch_fast(parts, add_special_tokens=False)]
        sizes = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        return Flat.of(np.fromiter(itertools.chain.from_iterable(found), dtype=np.uint32, count=int(sizes.sum())), sizes)

    def pre_tokens(self, parts: list[str]) -> Flat:
        """Ids of single pre-tokens: many go in one call, word-end tokens part them."""
        if not self.ends_word.any():
            return self.one_by_one(parts)
        return self.letters.look_up(parts, self._pre_tokens)

    def _pre_tokens(self, parts: list[str]) -> Flat:
        calls = [parts[i:i + JOINED] for i in range(0, len(parts), JOINED)]
        out = self.one_by_one([" ".join(c) for c in calls])
        ends = self.ends_word[out.ids]
        per_call = np.add.reduceat(ends, out.starts, dtype=np.int64) if len(calls) else np.zeros(0, dtype=np.int64)
        if out.sizes.min(initial=1) < 1 or per_call.tolist() != [len(c) for c in calls]:
            return self.one_by_one(parts)                # not one word end for each: no short cut
        stops = np.flatnonzero(ends) + 1
        return Flat.of(out.ids, np.diff(np.concatenate([[0], stops])))

    def words(self, words: pa.Array) -> Flat:
        """Ids of distinct words."""
        split = pc.extract_regex(words, PLAIN)
        plain = np.asarray(split.is_valid())
        other = self.others.look_up(words.filter(pa.array(~plain)).to_pylist(), self.one_by_one)
        a, b = (pc.struct_field(split.drop_null(), k).dictionary_encode() for k in "ab")
        ids_a = self.pre_tokens(a.dictionary.to_pylist())
        ids_b = self.marks.look_up(b.dictionary.to_pylist(), self.one_by_one)
        both, n_a, n_o = Flat.of(np.concatenate([ids_a.ids, ids_b.ids, other.ids]), np.concatenate(
            [ids_a.sizes, ids_b.sizes, other.sizes])), len(ids_a.sizes), len(ids_a.sizes) + len(ids_b.sizes)
        # a plain word is a pair of pre-tokens, any other one list
        pair = np.full((len(words), 2), -1, dtype=np.int64)
        pair[plain, 0], pair[plain, 1] = np.asarray(a.indices), np.asarray(b.indices) + n_a
        pair[~plain, 0] = np.arange(len(other.sizes)) + n_o
        sizes = np.append(both.sizes, 0)[pair]
        flat = both.take(pair[pair >= 0])
        return Flat.of(flat.ids, sizes.sum(axis=1))

    def encode(self, texts: pa.Array) -> Iterator[tuple[int, Flat]]:
        """(first text, ids of some texts), in order."""
        split = pc.ascii_split_whitespace(texts)
        coded = split.values.dictionary_encode()
        known = self.words(coded.dictionary)
        index, at = np.asarray(coded.indices), np.asarray(split.offsets).astype(np.int64)
        first = 0
        while first < len(texts):
            last = max(first + 1, int(np.searchsorted(at, at[first] + GATHER_WORDS, side="right")) - 1)
            part = known.take(index[at[first]:at[last]])
            before = np.append(part.starts, len(part.ids))[at[first:last + 1] - at[first]]
            yield first, Flat.of(part.ids, np.diff(before))
            first = last


@functools.cache
def word_tokenizer(path: str) -> WordTokenizer:
    """One per Python worker, which serves many tasks."""
    return WordTokenizer(path)


# --- curve -------------------------------------------------------------------

def hilbert_index(cells: np.ndarray, bits: int = CURVE_BITS) -> np.ndarray:
    """Hilbert index of integer cells (rows, dims), by the transpose method."""
    x = cells.astype(np.uint64).T.copy()
    dims, one = len(x), np.uint64(1)
    for level in range(bits - 1, 0, -1):
        q = one << np.uint64(level)
        p = q - one
        for i in range(dims):
            on = (x[i] & q) != 0
            swap = np.where(on, 0, (x[0] ^ x[i]) & p).astype(np.uint64)
            x[0] ^= np.where(on, p, swap)
            x[i] ^= swap
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        q = one << np.uint64(level)
        t ^= np.where((x[-1] & q) != 0, q - one, 0).astype(np.uint64)
    x ^= t
    out = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for i in range(dims):
            out = out << one | x[i] >> np.uint64(level) & one
    return out.astype(np.int64)


@functools.cache
def projection(seed: int) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal((HASHED, DIMS))


def curve_keys(documents: Flat, seed: int = 1) -> np.ndarray:
    """The Hilbert keys of documents given by their ids (no ids: the middle cell)."""
    n = len(documents.sizes)
    h = documents.ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)
    h ^= h >> np.uint64(31)
    slot = (h % np.uint64(2 * HASHED)).astype(np.int64) + np.repeat(np.arange(n) * 2 * HASHED, documents.sizes)
    counts = np.log1p(np.bincount(slot, minlength=n * 2 * HASHED).reshape(n, 2, HASHED))
    v = counts[:, 0] - counts[:, 1]
    norm = np.sqrt((v * v).sum(axis=1, keepdims=True))
    y = v / np.where(norm > 0, norm, 1) @ projection(seed)        # each about standard normal
    cell = (1 / (1 + np.exp(-1.702 * y)) * (1 << CURVE_BITS)).astype(np.int64)
    return hilbert_index(np.clip(cell, 0, (1 << CURVE_BITS) - 1))


# --- on Spark ----------------------------------------------------------------

def id_type(size: int) -> str:
    """Two bytes an id where the vocabulary allows."""
    return "<u2" if size <= 1 << 16 else "<u4"


def tokenized(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID) -> DataFrame:
    """(row tag, doc_id, key, n, ids as little-endian numbers of id_type) per row, written down."""
    bound_batches(docs.sparkSession)
    schema = "`__at` string, key long, n long, ids binary"

    def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Slices of up to SLICE_BYTES of text; a longer text is one alone."""
        held, room = [], SLICE_BYTES

        def gathered() -> pa.RecordBatch:
            return pa.Table.from_batches(held).combine_chunks().to_batches()[0]

        for batch in batches:
            sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(1)), 0)).astype(np.int64)
            ends, first = np.cumsum(sizes), 0
            while first < len(sizes):
                before = int(ends[first - 1]) if first else 0
                last = int(np.searchsorted(ends, before + room, side="right"))
                if last == first and not held:
                    last = first + 1
                if last > first:
                    held.append(batch.slice(first, last - first))
                    room -= int(ends[last - 1]) - before
                    first = last
                if first < len(sizes):                   # the next text has no room
                    yield gathered()
                    held, room = [], SLICE_BYTES
        if held:
            yield gathered()

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = word_tokenizer(tokenizer_path)
        kind = id_type(max(tokenizer.size, end_id + 1))
        for batch in slices(batches):
            for first, found in tokenizer.encode(batch.column(1)):
                count = len(found.sizes)
                ids = np.full(len(found.ids) + count, end_id, dtype=kind)
                ids[np.arange(len(found.ids)) + np.repeat(np.arange(count), found.sizes)] = found.ids
                n = found.sizes + 1
                ends = np.concatenate([[0], np.cumsum(n)]) * ids.itemsize
                packed = pa.Array.from_buffers(pa.large_binary(), count, [
                    None, pa.py_buffer(ends.astype(np.int64).tobytes()), pa.py_buffer(ids.tobytes())])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, count), pa.array(curve_keys(found)), pa.array(n),
                     packed.cast(pa.binary())], names=["__at", "key", "n", "ids"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    at = F.struct("doc_id", F.monotonically_increasing_id().alias(ROW))
    out = docs.select(F.to_json(at).alias("__at"), text_or_empty().alias("__text")).mapInArrow(run, schema)
    back = F.from_json("__at", f"doc_id {kind}, `{ROW}` long")
    return stage_table(out.select(back.alias("at"), "key", "n", "ids").select("at.*", "key", "n", "ids"), "pack-ids")


def line_starts(tokens: DataFrame) -> tuple[DataFrame, int]:
    """(row tag, first place on the line), and the line's length.

    Equal keys are ordered by a hash of the id, so a key that very many
    documents share is spread over several ranges.
    """

    @tidy
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, at = TaskContext.get().partitionId(), 0
        for f in batches:
            n = f.n.to_numpy()
            ends = np.cumsum(n)
            yield pd.DataFrame({ROW: f[ROW], "part": part, "inside": at + ends - n, "n": n})
            at += int(ends[-1]) if len(ends) else 0

    order = ["key", "tie", ROW]
    light = tokens.select("key", F.xxhash64("doc_id").alias("tie"), ROW, "n")
    inside = stage_table(light.repartitionByRange(*order).sortWithinPartitions(*order).mapInPandas(
        run, f"`{ROW}` long, part int, inside long, n long"), "pack-order")
    totals = sorted(inside.groupBy("part").agg(F.sum("n").alias("n")).collect())     # one row per task
    at, before = 0, []
    for part, n in totals:
        before.append((part, at))
        at += n
    offsets = inside.sparkSession.createDataFrame(before, "part int, before long")
    return inside.join(offsets, "part").select(ROW, (F.col("before") + F.col("inside")).alias("start_at")), at


def pieces(placed: DataFrame, total: int, kind: str, length: int = LENGTH, with_ids: bool = False) -> DataFrame:
    """Documents cut at the sequence ends; ``kind`` is the type of the packed ids."""
    full = total // length
    tail, at = [], full * length
    while at < total:                      # powers of two, largest first
        tail.append(at)
        at += 1 << ((total - at).bit_length() - 1)
    tail = np.array([*tail, total], dtype=np.int64)
    schema = ("`__at` string, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
              "offset long" + (", ids array<int>" if with_ids else ""))

    @tidy
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in batches:
            rows = []
            for at, begin, raw in zip(f["__at"], f.start_at, f.ids, strict=True):
                ids = np.frombuffer(raw, dtype=kind).astype("<u4")
                n, here = len(ids), 0
                while here < n:
                    place = begin + here
                    if place < full * length:
                        seq, first = divmod(place, length)
                        first, end = place - first, place - first + length
                    else:
                        k = int(np.searchsorted(tail, place, side="right")) - 1
                        seq, first, end = full + k, int(tail[k]), int(tail[k + 1])
                    take = min(n - here, end - place)
                    part = ids[here:here + take]
                    rows.append((at, here, take, zlib.crc32(part.tobytes()), n, seq, place - first,
                                 *([part.astype(np.int32)] if with_ids else [])))
                    here += take
            yield pd.DataFrame(rows, columns=[c.split()[0].strip("`") for c in schema.split(", ")])

    return placed.mapInPandas(run, schema)


def pack(docs: DataFrame, tokenizer_path: str, length: int = LENGTH, end_id: int = END_ID,
         with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A null or empty text is the end id alone. Rows that repeat are documents of
    their own; a null doc_id stays null. An empty table gives no rows. Columns
    other than doc_id and text are not read. ``with_ids`` adds the ids.
    """
    tokens = tokenized(docs, tokenizer_path, end_id)
    starts, total = line_starts(tokens)
    kind = docs.schema["doc_id"].dataType.simpleString()
    placed = tokens.join(starts, ROW).select(F.to_json(F.struct("doc_id")).alias("__at"), "start_at", "ids")
    out = pieces(placed, total, id_type(max(word_tokenizer(tokenizer_path).size, end_id + 1)), length, with_ids)
    return out.withColumn("doc_id", F.from_json("__at", f"doc_id {kind}")["doc_id"]).drop("__at")
