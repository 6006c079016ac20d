"""MinHash near-duplicates by a multi-index Hamming join.

A document's signature is 64 symbols of 16 bits, each from the minimum of one hash function over the set
of its five-word shingles. For two sets of similarity s, symbols differ with probability 1 - s. At 0.75 that
gives 16 of 64 on average, and more than ``MOST_DIFFERENT`` (31) in one pair of 250,000. Signatures are cut into 16 chunks of 4
symbols. By pigeonhole, signatures that differ in at most 31 symbols have a chunk with at most one error,
so each document is filed under every chunk with each of its symbols left out: 64 keys of three symbols,
and all pairs under the threshold share a key.

No bucket is expanded into pairs. Documents with equal sets are one class from the start. Each class is first
checked against the head it shares most keys with, the most central member of a large bucket, on the whole sets, and components are formed
from these links. Buckets with one component are then settled. Members of other buckets are checked across components only
(``buckets``): a pair is taken at its first common key, if the sizes allow
the similarity and a longer signature (512 symbols of four bits) doesn't rule it out, and is confirmed on whole sets. Members of all but tiny
buckets are also held against each other by 32 bits of each shingle (of a sample, beyond ``SAMPLE`` shingles), so that of the many
pairs a little under the threshold hardly any is left to be confirmed.

Defined results: null and empty texts have the empty set and are linked with nothing. The nodes of
the graph are distinct sets, so each text is judged by itself, whether its doc_id is null or has other texts too. A component is named by its
smallest doc_id; it has no name (null) if all are null. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from lectern.llm import buckets
from lectern.llm.buckets import Kernel, pairs_across
from lectern.llm.classes import classes, labelled, shared_buckets, stars, unsettled
from lectern.llm.links import bit_planes, components, confirmed, shingle_sets, text_key, with_rows, without_rows
from lectern.llm.shingles import as_long, portions, shingles
from lectern.session import cut_lineage

PERCENT = 75
SYMBOLS, SYMBOL_BITS, CHUNK = 64, 16, 4
MOST_DIFFERENT = 2 * (SYMBOLS // CHUNK) - 1
LONG_SYMBOLS, LONG_BITS = 512, 4
# Differences of long signatures: at similarity 0.75 mean 120, deviation 9.6; beyond this fewer than one pair in a thousand million.
MOST_LONG = 181
# Shingles of a set that are sampled, about; all of a smaller set. A sample's share may be so many deviations below the threshold.
SAMPLE, DEVIATIONS = 1024, 6.35
_RNG = np.random.default_rng(20)
_FACTORS = _RNG.integers(1, 2**63, LONG_SYMBOLS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADDENDS = _RNG.integers(0, 2**63, LONG_SYMBOLS, dtype=np.uint64)
_SLICE = 1024


def signature(values: np.ndarray, count: int) -> np.ndarray:
    """``count`` symbols of 16 bits of a set that is not empty."""
    least = np.full(count, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(values), _SLICE):
        part = values[at : at + _SLICE, None]
        least = np.minimum(least, (part * _FACTORS[:count] + _ADDENDS[:count]).min(axis=0))
    return ((least >> np.uint64(20)) & np.uint64(0xFFFF)).astype(np.uint16)


def keys(symbols: np.ndarray) -> np.ndarray:
    """One key for each symbol left out of its chunk: the place left out, then the chunk's other three symbols."""
    chunks = symbols.astype(np.int64).reshape(-1, CHUNK)
    out = np.empty((len(chunks), CHUNK), dtype=np.int64)
    for left in range(CHUNK):
        a, b, c = (chunks[:, j] for j in range(CHUNK) if j != left)
        out[:, left] = ((np.arange(len(chunks)) * CHUNK + left) << 48) | (a << 32) | (b << 16) | c
    return out.reshape(-1)


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Size, digest and keys of each text; only a portion of a batch's texts are Python strings at a time."""
    for batch in batches:
        for piece in portions(pc.fill_null(pc.utf8_length(batch.column("text")), 0).to_pylist()):
            part, rows = batch.slice(piece.start, piece.stop - piece.start), []
            for text in part.column("text").to_pylist():
                found = shingles(text)
                digest = as_long(np.array([found.sum(dtype=np.uint64), (found * found).sum(dtype=np.uint64)], dtype=np.uint64)).tolist()
                rows.append((len(found), *digest, keys(signature(found, SYMBOLS)) if len(found) else np.empty(0, dtype=np.int64)))
            made = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate((pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64())))]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("text_key"), *made], names=["doc_id", "text_key", "n_shingles", "h1", "h2", "keys"])


def _level(n: int) -> int:
    """Of a set of ``n`` the shingles with so many zero bits are sampled."""
    return max(0, math.ceil(math.log2(n / SAMPLE)))


def sampled(values: np.ndarray) -> bytes:
    """Size of a set, then the upper 32 bits of its sampled shingles in order."""
    upper = (values >> np.uint64(32)).astype(np.uint32)
    upper = upper[upper & np.uint32(2 ** _level(len(values)) - 1) == 0]
    return np.append(np.uint32(len(values)), np.sort(upper)).tobytes()


def _payload(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Signatures, and samples of members of buckets that aren't tiny."""
    for batch in batches:
        sets = [np.asarray(s, dtype=np.int64).view(np.uint64) for s in batch["shingles"]]
        for piece in portions([len(s) for s in sets]):
            symbols = np.stack([signature(s, LONG_SYMBOLS) for s in sets[piece]])
            planes, long = bit_planes(symbols[:, :SYMBOLS], SYMBOL_BITS), bit_planes(symbols, LONG_BITS)
            samples = [sampled(s) if large else b"" for s, large in zip(sets[piece], batch["large"].values[piece])]
            yield pd.DataFrame({"id": batch["id"].values[piece], "n": [len(s) for s in sets[piece]], "data": [p.tobytes() + x.tobytes() for p, x in zip(planes, long)], "sample": samples})


def at_first_common_key(differ: np.ndarray, place: int | np.ndarray) -> np.ndarray:
    """Whether ``place`` (16 chunks x 4 symbols left out) is the first under which both signatures are filed alike.

    ``differ`` has a bit for each symbol in which the signatures of a pair differ.
    """
    errors = ((differ[:, None] >> np.arange(SYMBOLS, dtype=np.uint64)) & np.uint64(1)).reshape(-1, SYMBOLS // CHUNK, CHUNK)
    chunk = (errors.sum(axis=2) <= 1).argmax(axis=1)
    return chunk * CHUNK + errors[np.arange(len(differ)), chunk].argmax(axis=1) == place


class Signatures(Kernel):
    """Signatures as bit planes: the symbols of the index, then the longer ones."""

    def __init__(self, percent: int = PERCENT):
        self.percent = percent

    def load(self, data: list[bytes]) -> np.ndarray:
        return np.frombuffer(b"".join(data), dtype=np.uint64).reshape(len(data), SYMBOL_BITS + LONG_SYMBOLS // 64 * LONG_BITS)

    def near(self, key: np.ndarray | None, n: np.ndarray, x: np.ndarray, i: np.ndarray, y: np.ndarray, j: np.ndarray) -> np.ndarray:
        differ = np.bitwise_or.reduce(x[i, :SYMBOL_BITS] ^ y[j, :SYMBOL_BITS], axis=1)
        close = np.bitwise_count(differ) <= MOST_DIFFERENT
        at = np.flatnonzero(close)
        if key is not None:
            at = at[at_first_common_key(differ[at], key[at] >> 48)]
        close[:] = False
        other = (x[i[at], SYMBOL_BITS:] ^ y[j[at], SYMBOL_BITS:]).reshape(len(at), LONG_SYMBOLS // 64, LONG_BITS)
        close[at] = np.bitwise_count(np.bitwise_or.reduce(other, axis=2)).sum(axis=1) <= MOST_LONG
        return close


class SampledSignatures(Signatures):
    """Signatures, each followed by the sample of its set."""

    def load(self, data: list[bytes]) -> tuple[np.ndarray, list[np.ndarray]]:
        fixed = 8 * (SYMBOL_BITS + LONG_SYMBOLS // 64 * LONG_BITS)
        return super().load([d[:fixed] for d in data]), [np.frombuffer(d[fixed:], dtype=np.uint32) for d in data]

    def near(self, key: np.ndarray | None, n: np.ndarray, x: tuple, i: np.ndarray, y: tuple, j: np.ndarray) -> np.ndarray:
        close = super().near(key, n, x[0], i, y[0], j)
        for at in np.flatnonzero(close).tolist():
            close[at] = self.alike(x[1][i[at]], y[1][j[at]])
        return close

    def alike(self, one: np.ndarray, two: np.ndarray) -> bool:
        """Whether the samples leave a link possible: no link of two whole sets is lost, as equal shingles have equal bits."""
        sizes = [int(v[0]) for v in (one, two)]
        level = max(map(_level, sizes))
        one, two = (v[1:][v[1:] & np.uint32(2**level - 1) == 0] for v in (one, two))
        place = np.searchsorted(two, one)
        place[place == len(two)] = 0
        shared = int((two[place] == one).sum()) if len(two) else 0
        if not level:
            return 100 * shared >= self.percent * (sum(sizes) - shared)
        share, union = self.percent / 100, len(one) + len(two) - shared
        return shared >= share * union - DEVIATIONS * math.sqrt(share * (1 - share) * union)


def _judged(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``near_duplicates`` with the text_key and the digest (h1, h2) of each row."""
    if not PERCENT <= percent <= 100:
        raise ValueError(f"percent must be from {PERCENT} to 100")
    signed = cut_lineage(docs.select("doc_id", text_key().alias("text_key"), "text").mapInArrow(_signed, "doc_id long, text_key long, n_shingles int, h1 long, h2 long, keys array<long>"))
    known = cut_lineage(classes(signed))
    filed = with_rows(signed.select("doc_id", "text_key", "keys"), known.select("doc_id", "text_key", "id")).select("id", F.explode("keys").alias("key"))
    entries = cut_lineage(shared_buckets(filed))
    needed = known.join(entries.select("id").distinct(), "id", "left_semi").select("doc_id", "text_key", "id")
    texts = with_rows(docs.select("doc_id", "text", text_key().alias("text_key")), needed)
    sets = cut_lineage(shingle_sets(texts.select(F.col("id").alias("doc_id"), "text")))
    links = cut_lineage(confirmed(stars(entries), sets, percent))
    rows = cut_lineage(unsettled(entries, components(links)))
    members = rows.groupBy("id").agg((F.max("size") > buckets.TINY).alias("large"))
    signatures = cut_lineage(sets.join(members, "id").mapInPandas(_payload, "id long, n int, data binary, sample binary"))
    sampled_ones = signatures.select("id", "n", F.concat("data", "sample").alias("data"))
    pairs = pairs_across(rows, signatures.select("id", "n", "data"), Signatures(percent), sharper=(sampled_ones, SampledSignatures(percent)))
    more = confirmed(pairs.distinct(), sets, percent)
    return labelled(signed, known, components(links.unionByName(more)))


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of each row of ``docs`` (doc_id, text).

    ``percent`` may be raised; below 75 the signature threshold would have to be larger. Rows that repeat a kept id and text are all kept here.
    """
    return _judged(docs, percent).select("doc_id", "n_shingles", "component_id", "kept")


def representatives(docs: DataFrame, **options) -> DataFrame:
    """One document of each near-duplicate group, that of the smallest id; documents without words stay.

    Of several rows of one id with equal sets one stays, so also of copies without an id.
    """
    judged = cut_lineage(_judged(docs, **options))
    repeats = F.col("kept") & ((F.col("n_shingles") > 0) | F.col("doc_id").isNotNull())
    groups = cut_lineage(judged.where(repeats).groupBy("doc_id", "h1", "h2", "n_shingles").agg(F.min("text_key").alias("text_key"), F.count("*").alias("n")).where("n > 1"))
    many = groups.select("doc_id", "text_key")
    left = without_rows(docs, judged.where(~F.col("kept")).select("doc_id", "text_key").distinct())
    if groups.isEmpty():
        return left
    again = cut_lineage(judged.where(repeats).alias("r").join(
        groups.alias("g"), F.col("r.doc_id").eqNullSafe(F.col("g.doc_id")) & (F.col("r.h1") == F.col("g.h1")) & (F.col("r.h2") == F.col("g.h2")) & (F.col("r.n_shingles") == F.col("g.n_shingles"))).select("r.doc_id", "r.text_key").distinct())
    one = with_rows(docs.withColumn("text_key", text_key()), many.withColumn("id", F.lit(1))).dropDuplicates(["doc_id", "text_key"])
    return without_rows(left, again).unionByName(one.select(*[F.col(f"`{c}`") for c in docs.columns]))
