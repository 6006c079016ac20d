"""Fill-in-middle transformation, its cuts located on a wavelet matrix over character classes.

A text is a row of units: runs of ASCII letters, and every other character by itself. Two places between units
cut it into prefix, middle and suffix, which are written as ``<P>prefix<S>suffix<M>middle`` (psm) or
``<S>suffix<P>prefix<M>middle`` (spm), or the text stays as it is (plain).

Units are never listed. Each character has one of eight classes, and the classes of all texts of a batch, end to end,
form one wavelet matrix: three levels of bits with a running count for each 64 of them. Its rank of a class is the
number of such characters before a place. Every character begins a unit but a letter that follows a letter, which
has classes of its own; so the ranks of the other classes add up to the number of units begun before a place. The
cut after k units is where unit k + 1 begins, found by bisection on these sums, for all texts of a batch at once.

Cuts follow from sha256 of ``seed:doc_id``: the first four groups of eight hex digits are h1 to h4. The prefix ends after the
smaller of h1 and h2 modulo (units + 1), the middle after the larger; a text is plain when it is empty, holds a
marker or h3 % 100 is ``rate`` or more, else spm when h4 % 100 is less than ``spm``. No marker in a text means
that the first ones found in an output are those put there, so ``restore`` gives the exact text.

Defined results: null texts count as empty; a null doc_id counts as the empty string; rows that repeat a document are
transformed alike; an empty table gives an empty result; columns are kept whatever their names, except for those that
the transformation makes, which replace columns of the same name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from lectern.llm.shingles import portions

# The markers and the shares of a hundred.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
RATE, SPM = 90, 20
SEED = "1"
# Character classes. Those of letters that follow a letter begin no unit.
UPPER, LOWER, DIGIT, SPACE, SIGN, OTHER, MORE_UPPER, MORE_LOWER = range(8)
BEGINNING = (UPPER, LOWER, DIGIT, SPACE, SIGN, OTHER)
LEVELS = 3
_WORD = 64


def _ascii_classes() -> np.ndarray:
    table = np.full(128, SIGN, dtype=np.uint8)
    table[[9, 10, 11, 12, 13, 32]] = SPACE
    for first, last, kind in (("0", "9", DIGIT), ("A", "Z", UPPER), ("a", "z", LOWER)):
        table[ord(first) : ord(last) + 1] = kind
    return table


_ASCII = _ascii_classes()


def classes(points: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The class of each code point; texts begin at ``starts``."""
    out = np.full(len(points), OTHER, dtype=np.uint8)
    low = points < 128
    out[low] = _ASCII[points[low]]
    letter = out <= LOWER
    follows = np.zeros(len(points), dtype=bool)
    follows[1:] = letter[1:] & letter[:-1]
    follows[starts[starts < len(points)]] = False
    out[follows] += MORE_UPPER
    return out


class WaveletMatrix:
    """Ranks of the symbols of a row of small numbers.

    Level by level, from the highest bit, the row's bits are kept and the row is dealt stably into those with a 0
    and those with a 1; a symbol's place on the next level follows from the count of its bit before it.
    """

    def __init__(self, symbols: np.ndarray, levels: int = LEVELS):
        self.size, self.levels = len(symbols), levels
        self.words, self.counts, self.zeros = [], [], []
        row = symbols
        for level in reversed(range(levels)):
            bits = (row >> level) & 1
            padded = np.zeros(-(-(self.size + 1) // _WORD) * _WORD, dtype=np.uint8)
            padded[: self.size] = bits
            words = np.packbits(padded, bitorder="little").view(np.uint64)
            self.words.append(words)
            self.counts.append(np.concatenate([[0], np.cumsum(np.bitwise_count(words).astype(np.int64))]))
            self.zeros.append(int(self.size - bits.sum(dtype=np.int64)))
            row = np.concatenate([row[bits == 0], row[bits == 1]])

    def _ones(self, level: int, places: np.ndarray) -> np.ndarray:
        """Ones before each place of a level."""
        word, bit = places // _WORD, (places % _WORD).astype(np.uint64)
        below = self.words[level][word] & ((np.uint64(1) << bit) - np.uint64(1))
        return self.counts[level][word] + np.bitwise_count(below)

    def rank(self, symbol: int, places: np.ndarray) -> np.ndarray:
        """How often ``symbol`` occurs before each place (0 to size)."""
        first, last = np.zeros_like(places), places
        for level in range(self.levels):
            if (symbol >> (self.levels - 1 - level)) & 1:
                first, last = self.zeros[level] + self._ones(level, first), self.zeros[level] + self._ones(level, last)
            else:
                first, last = first - self._ones(level, first), last - self._ones(level, last)
        return last - first


def begun(matrix: WaveletMatrix, places: np.ndarray) -> np.ndarray:
    """How many units begin before each place."""
    return sum(matrix.rank(symbol, places) for symbol in BEGINNING)


def cut_places(matrix: WaveletMatrix, starts: np.ndarray, stops: np.ndarray, units: np.ndarray) -> np.ndarray:
    """Where the first ``units`` units of each text end: the last place before which no more of its units begin."""
    before = begun(matrix, starts)
    low, high = starts.copy(), stops.copy()
    while (low < high).any():
        middle = (low + high + 1) // 2
        fits = begun(matrix, middle) - before <= units
        low, high = np.where(fits, middle, low), np.where(fits, high, middle - 1)
    # A unit begins at the place found, or the text ends there.
    return low


def _draws(doc_ids: list, seed: str) -> np.ndarray:
    drawn = np.empty((len(doc_ids), 4), dtype=np.int64)
    for row, name in enumerate(doc_ids):
        digest = hashlib.sha256(f"{seed}:{name}".encode()).digest()
        drawn[row] = np.frombuffer(digest[:16], dtype=">u4")
    return drawn


def transformed(texts: list[str], doc_ids: list, seed: str = SEED, rate: int = RATE, spm: int = SPM) -> dict[str, list]:
    """n, form, prefix_chars, middle_chars and output of each text."""
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    stops = np.cumsum(lengths)
    starts = stops - lengths
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    matrix = WaveletMatrix(classes(points, starts[lengths > 0]))
    n = begun(matrix, stops) - begun(matrix, starts)
    h = _draws(doc_ids, seed)
    cuts = np.sort(h[:, :2] % (n + 1)[:, None], axis=1)
    first = (cut_places(matrix, starts, stops, cuts[:, 0]) - starts).tolist()
    second = (cut_places(matrix, starts, stops, cuts[:, 1]) - starts).tolist()
    out: dict[str, list] = {"n": n.tolist(), "form": [], "prefix_chars": [], "middle_chars": [], "output": []}
    for text, a, b, left, order in zip(texts, first, second, (h[:, 2] % 100).tolist(), (h[:, 3] % 100).tolist()):
        if not text or left >= rate or PREFIX in text or SUFFIX in text or MIDDLE in text:
            row = ("plain", None, None, text)
        elif order < spm:
            row = ("spm", a, b - a, f"{SUFFIX}{text[b:]}{PREFIX}{text[:a]}{MIDDLE}{text[a:b]}")
        else:
            row = ("psm", a, b - a, f"{PREFIX}{text[:a]}{SUFFIX}{text[b:]}{MIDDLE}{text[a:b]}")
        for name, value in zip(("form", "prefix_chars", "middle_chars", "output"), row):
            out[name].append(value)
    return out


def restore(output: str, form: str) -> str:
    """The text that ``output`` was made from."""
    if form == "plain":
        return output
    head, tail = (PREFIX, SUFFIX) if form == "psm" else (SUFFIX, PREFIX)
    one, rest = output[len(head) :].split(tail, 1)
    two, middle = rest.split(MIDDLE, 1)
    return one + middle + two if form == "psm" else two + middle + one


_CUTS = {"n": pa.int64(), "form": pa.string(), "prefix_chars": pa.int64(), "middle_chars": pa.int64()}
_CUTS_DDL = "n long, form string, prefix_chars long, middle_chars long"


def _pieces(batches: Iterator[pa.RecordBatch], options: tuple) -> Iterator[tuple[pa.RecordBatch, dict[str, list]]]:
    """Parts of the batches with what ``transformed`` gives for them."""
    for batch in batches:
        texts = [t or "" for t in batch.column("text").to_pylist()]
        names = ["" if i is None else str(i) for i in batch.column("doc_id").to_pylist()]
        for piece in portions([len(t) for t in texts]):
            yield batch.slice(piece.start, piece.stop - piece.start), transformed(texts[piece], names[piece], *options)


def fill_in_middle(docs: DataFrame, seed: str = SEED, rate: int = RATE, spm: int = SPM) -> DataFrame:
    """``docs`` (doc_id, text and any other columns) with n, form, prefix_chars, middle_chars and output."""
    types = {**_CUTS, "output": pa.string()}
    kept = [f for f in docs.schema.fields if f.name not in types]
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, made in _pieces(batches, (seed, rate, spm)):
            columns = [part.column(name) for name in names] + [pa.array(made[name], kind) for name, kind in types.items()]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, *types])

    made = docs.sparkSession.createDataFrame([], f"{_CUTS_DDL}, output string").schema.fields
    return docs.mapInArrow(run, T.StructType(kept + made))


def _sha256(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def digests(docs: DataFrame, seed: str = SEED, rate: int = RATE, spm: int = SPM) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output_sha256 and restored_sha256, the latter of the text put together again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, made in _pieces(batches, (seed, rate, spm)):
            outputs = [_sha256(o) for o in made["output"]]
            restored = [_sha256(restore(o, f)) for o, f in zip(made["output"], made["form"])]
            columns = [part.column("doc_id"), *[pa.array(made[name], kind) for name, kind in _CUTS.items()], pa.array(outputs), pa.array(restored)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", *_CUTS, "output_sha256", "restored_sha256"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, {_CUTS_DDL}, output_sha256 string, restored_sha256 string")


SQL = r"""
WITH u AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h,
    regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS w FROM documents),
d AS (
  SELECT doc_id, t, w, len(w)::BIGINT AS n, ('0x' || h[1:8])::BIGINT % (len(w) + 1) AS c1, ('0x' || h[9:16])::BIGINT % (len(w) + 1) AS c2,
    ('0x' || h[17:24])::BIGINT % 100 AS h3, ('0x' || h[25:32])::BIGINT % 100 AS h4 FROM u),
p AS (
  SELECT *, CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 >= 90 THEN 'plain' WHEN h4 < 20 THEN 'spm' ELSE 'psm' END AS form,
    coalesce(array_to_string(w[1:least(c1, c2)], ''), '') AS pre, coalesce(array_to_string(w[least(c1, c2) + 1:greatest(c1, c2)], ''), '') AS mid,
    coalesce(array_to_string(w[greatest(c1, c2) + 1:], ''), '') AS suf FROM d)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre) END::BIGINT AS prefix_chars, CASE WHEN form <> 'plain' THEN length(mid) END::BIGINT AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
  sha256(CASE WHEN form = 'plain' THEN t ELSE pre || mid || suf END) AS restored_sha256
FROM p
"""
