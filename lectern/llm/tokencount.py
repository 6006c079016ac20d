"""Token counts of whole texts by overlap resynchronisation.

Texts are cut into chunks that overlap, so that a huge document is spread over tasks. Each chunk is
encoded on its own, with offsets. Byte-level BPE splits a text into pre-tokens by one left-to-right
pattern without look-behind and never joins tokens across pre-tokens. So, once two encodings both begin a
pre-token at the same place, they agree from there on; and what an encoding says is final up to a margin
before its end, as the pattern looks only a few characters ahead (a special token's text is the longest).
Neighbouring chunks are spliced at the first place where both begin a pre-token inside the overlap. When
there is none, e.g. in one run of letters longer than the overlap, the document is encoded again with chunks
and overlaps eight times as wide, until all chunks agree or one chunk is the whole text.

Texts of one chunk need no offsets. No pre-token holds a space after anything but white space, so any encoding begins a pre-token at a space
that follows something else: the text is cut there, and each piece is encoded once for all its occurrences that a worker meets (``pieces``).

Defined results: null and empty texts have 0 bytes and 0 tokens; repeated rows are counted each; an empty
table gives an empty result.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from lectern.llm.shingles import portions
from lectern.session import cut_lineage

CHUNK = 65_536
OVERLAP = 1_024
# Characters before a chunk's end at which its pre-tokens are final: more than any special token or look-ahead.
MARGIN = 64
WIDER = 8
# A space after something that is not white space, for Python or any version of Unicode.
_CUT = re.compile(r" (?<=[^\s\u180e] )")
# Pieces whose counts a worker keeps, at most (and once more those kept before), and the longest of them; pieces encoded at a time.
_KEPT_PIECES, _LONGEST_KEPT, _AT_ONCE = 200_000, 64, 10_000

_ENCODERS: dict[str, object] = {}


def encoder(name: str):
    """The tokenizer of ``name`` (a file, or a name that ``public_tokenizers`` knows), once per worker."""
    if name not in _ENCODERS:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(name if os.path.exists(name) else public_tokenizers.path(name))
        tokenizer.no_truncation()
        tokenizer.no_padding()
        _ENCODERS[name] = tokenizer
    return _ENCODERS[name]


def starts(encoding, text: str) -> tuple[np.ndarray, np.ndarray]:
    """Places where a pre-token begins, and the number of tokens before each.

    Offsets leave out a pre-token's leading space, so the end of one pre-token stands for the
    beginning of the next.
    """
    words = np.array([-1 if w is None else w for w in encoding.word_ids], dtype=np.int64)
    ends = np.array([b for _, b in encoding.offsets], dtype=np.int64)
    special = np.array(encoding.special_tokens_mask, dtype=bool) | (words < 0)
    if not len(words):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    last = np.ones(len(words), dtype=bool)
    last[:-1] = (words[1:] != words[:-1]) | special[1:] | special[:-1]
    place = np.flatnonzero(last)
    return np.concatenate([[0], ends[place]]), np.concatenate([[0], place + 1])


def cuttable(tokenizer) -> bool:
    """Whether a text's tokens are those of its ``pieces``: byte-level pre-tokens, no normalizer, and added tokens that take no notice of spaces."""
    made = json.loads(tokenizer.to_str())
    before = made["pre_tokenizer"] or {}
    plain = all(" " not in t["content"] and not (t["lstrip"] or t["rstrip"] or t["single_word"]) for t in made["added_tokens"])
    byte_level = before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before["add_prefix_space"]
    return bool(byte_level and plain and made["normalizer"] is None and not made["model"].get("dropout"))


def pieces(text: str) -> list[str]:
    """``text`` cut before each space that follows something else than white space; all pieces but the first are without that space."""
    return _CUT.split(text)


class Counter:
    """Numbers of tokens of texts, with those of the pieces met so far."""

    def __init__(self, tokenizer):
        self.tokenizer, self.cut, self.known, self.older = tokenizer, cuttable(tokenizer), {}, {}

    def _lengths(self, texts: list[str]) -> list[int]:
        encoded = (self.tokenizer.encode_batch_fast(texts[at : at + _AT_ONCE], add_special_tokens=False) for at in range(0, len(texts), _AT_ONCE))
        return [len(e) for batch in encoded for e in batch]

    def __call__(self, texts: list[str]) -> list[int]:
        if not self.cut:
            return self._lengths(texts)
        cut = [pieces(t) for t in texts]
        counts = self._lengths([c.pop(0) for c in cut])
        met = set().union(*cut)
        new = [p for p in met if p not in self.known]
        if len(self.known) + len(new) > _KEPT_PIECES:
            # Pieces that are met again move on, others are dropped.
            self.known, self.older = {}, self.known
            new = [*met]
        self.known.update((p, self.older[p]) for p in new if p in self.older)
        new = [p for p in new if p not in self.older]
        self.known.update(zip(new, self._lengths([" " + p for p in new])))
        totals = [n + sum(map(self.known.__getitem__, c)) for n, c in zip(counts, cut)]
        for piece in new:
            if len(piece) > _LONGEST_KEPT:
                del self.known[piece]
        return totals


_COUNTERS: dict[str, Counter] = {}


def counter(name: str) -> Counter:
    """The ``Counter`` of the tokenizer ``name``, once per worker."""
    if name not in _COUNTERS:
        _COUNTERS[name] = Counter(encoder(name))
    return _COUNTERS[name]


def _encode(name: str, chunk: int, overlap: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokenizer = encoder(name)
        for batch in batches:
            texts = batch["part"].tolist()
            for piece in portions([len(t) for t in texts]):
                out = []
                rows = batch.iloc[piece]
                for text, number, parts in zip(texts[piece], rows["number"], rows["parts"]):
                    if parts == 1:
                        out.append((len(tokenizer.encode(text, add_special_tokens=False)), [], [], [], []))
                        continue
                    encoding = tokenizer.encode(text, add_special_tokens=False)
                    at, before = starts(encoding, text)
                    final = at <= len(text) - MARGIN
                    head = final & (at < overlap) & (number > 0)
                    tail = final & (at >= chunk) & (number < parts - 1)
                    out.append((len(encoding), at[head].tolist(), before[head].tolist(), (at[tail] - chunk).tolist(), before[tail].tolist()))
                yield pd.DataFrame({
                    "row": rows["row"].values, "number": rows["number"].values, "parts": rows["parts"].values,
                    **{k: [o[i] for o in out] for i, k in enumerate(("tokens", "head", "head_n", "tail", "tail_n"))}})

    return run


def _short(name: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count = counter(name)
        for batch in batches:
            texts = batch["text"].tolist()
            counts = []
            for piece in portions([len(t) for t in texts], 1_000_000):
                counts += count(texts[piece])
            yield batch.drop(columns="text").assign(n_tokens=np.array(counts, dtype=np.int64))

    return run


def _spliced(long: DataFrame, name: str, chunk: int, overlap: int) -> DataFrame:
    """Tokens of each row of ``long`` (row, text); null where neighbouring chunks share no place."""
    size = F.length("text")
    parts = F.greatest(F.lit(1), F.ceil((size - overlap) / F.lit(chunk))).cast("int")
    cut = long.select("row", "text", parts.alias("parts")).select(
        "row", "parts", "text", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("number"))
    last = F.col("number") == F.col("parts") - 1
    piece = F.when(last, F.expr(f"substring(text, number * {chunk} + 1)")).otherwise(F.expr(f"substring(text, number * {chunk} + 1, {chunk + overlap})"))
    chunks = cut.select("row", "parts", "number", piece.alias("part")).repartition("row", "number")
    schema = "row string, number int, parts int, tokens long, head array<long>, head_n array<long>, tail array<long>, tail_n array<long>"
    encoded = chunks.mapInPandas(_encode(name, chunk, overlap), schema)
    along = Window.partitionBy("row").orderBy("number")
    shared = F.array_min(F.array_intersect(F.col("head"), F.lag("tail").over(along)))
    beside = encoded.withColumn("at", shared).withColumn("tail_before", F.lag("tail").over(along)).withColumn("tail_n_before", F.lag("tail_n").over(along))
    count = lambda places, numbers: F.element_at(numbers, F.array_position(places, F.col("at")).cast("int"))
    # A splice takes the left chunk up to the shared place and the right one from there on.
    gain = F.when(F.col("number") == 0, F.col("tokens")).when(
        F.col("at").isNotNull(), F.col("tokens") - count(F.col("head"), F.col("head_n")) + count(F.col("tail_before"), F.col("tail_n_before")) - F.col("left_tokens"))
    total = F.sum("gain")
    return (
        beside.withColumn("left_tokens", F.lag("tokens").over(along)).withColumn("gain", gain)
        .groupBy("row").agg(F.when(F.count("gain") == F.count("*"), total).alias("n_tokens")))


def count_tokens(docs: DataFrame, name: str = "byte_bpe_50k.json", limit: int = 512, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (more than ``limit`` tokens) of each document.

    Texts that fit one chunk are counted as they are; only longer ones are cut, and only those
    pass through a shuffle.
    """
    if not MARGIN < overlap <= chunk:
        raise ValueError(f"overlap must be more than {MARGIN} and at most the chunk")
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    sized = texts.withColumn("n_bytes", F.octet_length("text").cast("bigint"))
    fits = F.length("text") <= chunk + overlap
    short = sized.where(fits).select("doc_id", "n_bytes", "text").mapInPandas(_short(name), "doc_id long, n_bytes long, n_tokens long")
    # Equal texts share their count: the key is the text's digest.
    digest = F.sha2("text", 256)
    long = sized.where(~fits).withColumn("row", digest)
    todo = long.groupBy("row").agg(F.first("text").alias("text"))
    found, width = None, 1
    while True:
        counted = cut_lineage(_spliced(todo, name, chunk * width, overlap * width))
        done = counted.where("n_tokens IS NOT NULL")
        found = done if found is None else found.unionByName(done)
        if counted.where("n_tokens IS NULL").isEmpty():
            break
        todo = todo.join(counted.where("n_tokens IS NULL").select("row"), "row")
        width *= WIDER
    spliced = long.select("doc_id", "n_bytes", "row").join(found, "row").select("doc_id", "n_bytes", "n_tokens")
    return short.unionByName(spliced).withColumn("over_limit", F.col("n_tokens") > limit)
