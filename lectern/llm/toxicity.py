"""Toxic spans by a linear-chain conditional random field, with document scores.

Tokens are runs of word characters, lower-cased. Documents are labelled, tokens are not, so the labelled
tokens are derived: a word, or its first letters, is a mark of toxicity when it occurs almost only in toxic
documents and tells something of them that stronger marks don't (words that merely come along, such as
those of copied documents, are explained away); the tokens with a mark in toxic documents are labelled toxic. The field has two states; a token's evidence is the sum of
the weights of its word, its first five letters and its last three. It is fitted by gradient steps
on the likelihood, whose expectations come from forward-backward; each step sums gradients in Spark tasks. Marginals then give spans (stretches
with a marginal of at least a half) and, through a two-weight logistic fit, the document's score.

Forward and backward messages are ratios x(t) = (a x(t-1) + b) / (c x(t-1) + d); such maps compose as
two-by-two matrices, so all texts of a batch are passed through together in blocks, whatever their length.

Labels are learned only from rows outside the held-out fold, from a bounded sample; every whole text is
scored. Defined results: null or empty texts have no tokens and score what no evidence scores; without
labelled rows every score is 0; with one label only, no evidence is found and all score that label's rate.
Repeated rows score alike; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from lectern.llm.labelled import held_out, sample
from lectern.llm.shingles import portions
from lectern.session import cut_lineage

TOKEN = re.compile(r"\w+")
PER_CLASS = 1_500
MOST_CHARS = 30_000
STEPS = 30
# A word is toxic evidence when it is this much more frequent, by documents, among toxic ones.
LIFT = 20.0
LEAST_DOCS = 5
EXPLAINED = 3
_BLOCK = 64
_KEPT_WORDS = 100_000
_KINDS = ("whole", "begin", "end")
_PARTS = 8
_TOKENS_AT_ONCE = 200_000


def features(word: str) -> tuple[str, ...]:
    """The word, its first five letters, its last three."""
    found = ["=" + word]
    if len(word) > 5:
        found.append("^" + word[:5])
    if len(word) > 3:
        found.append("$" + word[-3:])
    return tuple(found)


def follow(a: np.ndarray, b: np.ndarray, c: np.ndarray, d: np.ndarray) -> np.ndarray:
    """x(t) = (a x(t-1) + b) / (c x(t-1) + d) for all t; the first map must not depend on x.

    The maps of a block are multiplied up side by side for all blocks, the blocks are passed in turn, and
    each block is then filled in from its known entry.
    """
    n = len(a)
    rows = -(-n // _BLOCK)
    shaped = []
    for values, rest in ((a, 1.0), (b, 0.0), (c, 0.0), (d, 1.0)):
        whole = np.full(rows * _BLOCK, rest)
        whole[:n] = values
        shaped.append(np.ascontiguousarray(whole.reshape(rows, _BLOCK).T))
    a, b, c, d = shaped
    p, q, r, s = np.ones(rows), np.zeros(rows), np.zeros(rows), np.ones(rows)
    for t in range(_BLOCK):
        p, r, q, s = a[t] * p + b[t] * r, c[t] * p + d[t] * r, a[t] * q + b[t] * s, c[t] * q + d[t] * s
        scale = p + q + r + s
        p, q, r, s = p / scale, q / scale, r / scale, s / scale
    entry, x = np.empty(rows), 0.0
    for k, (pk, qk, rk, sk) in enumerate(zip(p.tolist(), q.tolist(), r.tolist(), s.tolist())):
        entry[k] = x
        x = min((pk * x + qk) / (rk * x + sk), 1e100)
    out = np.empty((_BLOCK, rows))
    x = entry
    for t in range(_BLOCK):
        x = out[t] = np.minimum((a[t] * x + b[t]) / (c[t] * x + d[t]), 1e100)
    return out.T.reshape(-1)[:n]


def messages(evidence: np.ndarray, first: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward and backward odds of state 1; ``first`` marks the first token of each text."""
    e = np.exp(np.clip(evidence, -30, 30))
    (t00, t01), (t10, t11) = np.exp(moves)
    forward = follow(np.where(first, 0.0, e * t11), np.where(first, e, e * t01), np.where(first, 0.0, t10), np.where(first, 1.0, t00))
    last = np.append(first[1:], True)
    after = np.append(e[1:], 1.0)
    backward = follow(
        np.where(last, 0.0, t11 * after)[::-1], np.where(last, 1.0, t10)[::-1],
        np.where(last, 0.0, t01 * after)[::-1], np.where(last, 1.0, t00)[::-1])[::-1]
    return forward, backward


def marginals(evidence: np.ndarray, first: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """The probability of state 1 at each token."""
    if not len(evidence):
        return np.empty(0)
    forward, backward = messages(evidence, first, moves)
    odds = forward * backward
    return odds / (1.0 + odds)


@dataclass
class Model:
    weights: dict[str, float] = field(default_factory=dict)
    bias: float = -6.0
    moves: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    logistic: tuple[float, float, float] | None = None
    rate: float = 0.0

    def evidence(self, word: str) -> float:
        return self.bias + sum(self.weights.get(f, 0.0) for f in features(word))

    def scores(self, total: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Document scores from the sum and the largest of the marginals."""
        if self.logistic is None:
            return np.full(len(total), self.rate)
        a, b, c = self.logistic
        return 1.0 / (1.0 + np.exp(-np.clip(a + b * _count(total) + c * most, -30, 30)))


def _count(total: np.ndarray) -> np.ndarray:
    return np.log(0.05 + total)


def _tokens(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield pd.DataFrame({"doc_id": batch["doc_id"], "label": batch["label"], "words": [TOKEN.findall((t or "").lower()) for t in batch["text"]]})


def _feature_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """feature and its numbers of documents of either label in a partition."""
    seen = {0: Counter(), 1: Counter()}
    for batch in batches:
        for found, label in zip(batch["words"], batch["label"]):
            seen[label].update({f for w in set(found) for f in features(w)})
    names = list(seen[0].keys() | seen[1].keys())
    yield pd.DataFrame({"feature": pd.Series(names, dtype=object), "yes": [seen[1][f] for f in names], "no": [seen[0][f] for f in names]})


def _numbered(rows: DataFrame) -> tuple[DataFrame, int]:
    """``rows`` with a number each from 0 on, and how many there are; only the sizes of partitions are collected."""
    placed = cut_lineage(rows.withColumn("part", F.spark_partition_id()).withColumn("place", F.monotonically_increasing_id().bitwiseAND(F.lit(2**33 - 1))))
    sizes = sorted((r["part"], r["count"]) for r in placed.groupBy("part").count().collect())
    starts, total = [], 0
    for part, size in sizes:
        starts.append((part, total))
        total += size
    if not total:
        return placed.withColumn("number", F.lit(0)).drop("part", "place"), 0
    start = F.element_at(F.create_map(*[F.lit(x) for pair in starts for x in pair]), F.col("part"))
    return placed.withColumn("number", (start + F.col("place")).cast("int")).drop("part", "place"), total


def _encoded(tokens: DataFrame, numbers: DataFrame) -> DataFrame:
    """doc_id, label and, token by token, the numbers of its three features (-1 for none)."""
    word = F.col("word")
    named = tokens.select(F.explode("words").alias("word")).distinct().select(
        "word", F.concat(F.lit("="), word).alias("whole"), F.when(F.length(word) > 5, F.concat(F.lit("^"), F.substring(word, 1, 5))).alias("begin"),
        F.when(F.length(word) > 3, F.concat(F.lit("$"), F.right(word, F.lit(3)))).alias("end"))
    for kind in _KINDS:
        named = named.join(numbers.select(F.col("feature").alias(kind), F.col("number").alias(f"{kind}_number")), kind, "left")
    known = cut_lineage(named.select("word", *[F.coalesce(f"{kind}_number", F.lit(-1)).alias(kind) for kind in _KINDS]))
    met = tokens.select("doc_id", "label", F.posexplode("words").alias("at", "word")).join(known, "word")
    listed = met.groupBy("doc_id", "label").agg(F.sort_array(F.collect_list(F.struct("at", *_KINDS))).alias("tokens"))
    return listed.select("doc_id", "label", *[F.col(f"tokens.{kind}").alias(kind) for kind in _KINDS])


def _holds(encoded: DataFrame, likely: DataFrame) -> list[Counter]:
    """The likely marks in each toxic document that has one, with how often; the sample bounds their number."""
    number = F.explode(F.concat("whole", "begin")).alias("number")
    rows = encoded.where("label = 1").select("doc_id", number).join(likely, "number").groupBy("doc_id", "number").agg(F.count("*").alias("n")).orderBy("doc_id", "number").toArrow()
    held: dict[int, Counter] = {}
    for doc_id, mark, n in zip(*(rows.column(c).to_pylist() for c in ("doc_id", "number", "n"))):
        held.setdefault(doc_id, Counter())[mark] = n
    return list(held.values())


def _gradient(theta: np.ndarray, marks: np.ndarray):
    """The gradient of the likelihood over the documents of a partition, one row."""
    count = len(theta) - 4
    weights = np.append(theta[:count], 0.0)  # a token without a feature of some kind has number -1
    moves = np.array([[0.0, theta[-3]], [theta[-2], theta[-1]]])
    marked = np.zeros(count + 1, dtype=bool)
    marked[marks] = True
    t = np.exp(moves)

    def add(total: np.ndarray, rows: pd.DataFrame) -> None:
        numbers = [np.concatenate(rows[kind].tolist()).astype(np.int64) for kind in _KINDS]
        lengths = rows["whole"].map(len).to_numpy()
        first = np.zeros(len(numbers[0]), dtype=bool)
        first[np.cumsum(lengths) - lengths] = True
        truth = ((marked[numbers[0]] | marked[numbers[1]]) & np.repeat(rows["label"].to_numpy() == 1, lengths)).astype(float)
        evidence = theta[count] + sum(weights[n] for n in numbers)
        forward, backward = messages(evidence, first, moves)
        odds = forward * backward
        rest = truth - odds / (1.0 + odds)
        for n in numbers:
            total[:count] += np.bincount(n + 1, weights=rest, minlength=count + 1)[1:]
        total[count] += rest.sum()
        inner = ~first[1:]
        e = np.exp(np.clip(evidence, -30, 30))
        f, g = forward[:-1][inner], (e[1:] * backward[1:])[inner]
        whole = t[0, 0] + t[0, 1] * g + t[1, 0] * f + t[1, 1] * f * g
        before, after = truth[:-1][inner], truth[1:][inner]
        total[-3] += ((1 - before) * after - t[0, 1] * g / whole).sum()
        total[-2] += (before * (1 - after) - t[1, 0] * f / whole).sum()
        total[-1] += (before * after - t[1, 1] * f * g / whole).sum()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, least = np.zeros(len(theta)), None
        for batch in batches:
            rows = batch.reset_index(drop=True)
            for piece in portions([len(x) for x in rows["whole"]], _TOKENS_AT_ONCE):
                add(total, rows.iloc[piece])
            least = min([int(rows["doc_id"].min()), *([] if least is None else [least])])
        if least is not None:
            yield pd.DataFrame({"least": [least], "gradient": [total.tobytes()]})

    return run


def _climb(encoded: DataFrame, size: int, marks: set[int], steps: int) -> np.ndarray:
    """Weights of the features, the bias and three transition scores (staying in state 0 is the zero point).

    Each step is a job over the sample whose tasks return their summed gradients; the driver holds a few vectors.
    """
    theta = np.zeros(size + 4)
    theta[size] = -5.0
    pace, speed, before = np.full(len(theta), 0.3), np.zeros(len(theta)), np.zeros(len(theta))
    taken = np.array(sorted(marks), dtype=np.int64)
    for _ in range(steps):
        gradient = -0.05 * theta
        parts = encoded.mapInPandas(_gradient(theta, taken), "least long, gradient binary").collect()
        for row in sorted(parts, key=lambda r: r["least"]):
            gradient += np.frombuffer(row["gradient"])
        # Each weight steps by its own pace, which grows while its gradient keeps its sign.
        turned = gradient * before
        pace = np.clip(np.where(turned > 0, pace * 1.2, np.where(turned < 0, pace * 0.5, pace)), 1e-4, 2.0)
        speed = np.where(turned < 0, 0.0, np.sign(gradient) * pace)
        theta = theta + speed
        before = np.where(turned < 0, 0.0, gradient)
    return theta


def _weighty(theta: np.ndarray):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            weight = theta[batch["number"].to_numpy(dtype=np.int64)]
            large = np.abs(weight) > 0.05
            yield pd.DataFrame({"feature": batch["feature"][large], "weight": weight[large].round(4)})

    return run


def _logistic(label: np.ndarray, total: np.ndarray, most: np.ndarray) -> tuple[float, float, float]:
    """Weights of the document score, either label counting a half."""
    n1, n0 = int(label.sum()), int((1 - label).sum())
    x = np.stack([np.ones(len(label)), _count(total), most], axis=1)
    balance = np.where(label == 1, 0.5 / n1, 0.5 / n0) * len(label)
    beta = np.zeros(3)
    for _ in range(30):
        q = 1.0 / (1.0 + np.exp(-np.clip(x @ beta, -30, 30)))
        beta = beta + np.linalg.solve((x * (balance * q * (1 - q))[:, None]).T @ x + 0.5 * np.eye(3), x.T @ (balance * (label - q)) - 0.5 * beta)
    return tuple(beta.tolist())


def fit(rows: DataFrame, steps: int = STEPS, lift: float = LIFT, least: int = LEAST_DOCS) -> Model:
    """A model from doc_id, text and label (0 or 1) of a bounded sample, one row a document."""
    rows = cut_lineage(rows.select("doc_id", "text", "label"))
    sizes = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    n1, n0 = sizes.get(1, 0), sizes.get(0, 0)
    if not n1 or not n0:
        return Model(rate=float(n1 > 0))
    tokens = cut_lineage(rows.mapInPandas(_tokens, "doc_id long, label int, words array<string>"))
    seen = tokens.mapInPandas(_feature_counts, "feature string, yes long, no long").groupBy("feature").agg(F.sum("yes").alias("yes"), F.sum("no").alias("no"))
    # In a fixed order, so that reruns agree.
    numbers, size = _numbered(seen.repartition(_PARTS, "feature").sortWithinPartitions("feature"))
    encoded = cut_lineage(_encoded(tokens, numbers).repartition(_PARTS, "doc_id").sortWithinPartitions("doc_id"))
    lifted = (F.col("yes") + 0.5) / (n1 + 1) >= lift * (F.col("no") + 0.5) / (n0 + 1)
    likely = numbers.where((F.col("yes") >= least) & ~F.col("feature").startswith("$") & lifted).select("number")
    marks = _marks(_holds(encoded, likely), max(least, n1 // 100))
    theta = _climb(encoded, size, marks, steps)
    weights = numbers.select("feature", "number").mapInPandas(_weighty(theta), "feature string, weight double").collect()
    model = Model({r["feature"]: r["weight"] for r in weights}, float(theta[size]), np.array([[0.0, theta[-3]], [theta[-2], theta[-1]]]), rate=n1 / (n0 + n1))
    sums = rows.mapInPandas(_tagger(model, sums=True), "label int, total double, most double").orderBy("label", "total", "most").toArrow()
    model.logistic = _logistic(*(sums.column(c).to_numpy().astype(float) for c in ("label", "total", "most")))
    return model


def _marks(holds: list[Counter], least: int) -> set[int]:
    """Of the likely marks each toxic document holds (with their numbers), those needed to explain the documents.

    The mark of most documents is taken again and again; a document in which marks taken occur ``EXPLAINED``
    times needs no more, and a mark must occur in ``least`` documents that do.
    """
    open_docs = {d: set(fs) for d, fs in enumerate(holds) if fs}
    left = Counter(f for fs in open_docs.values() for f in fs)
    where: dict[int, list[int]] = {}
    for d, fs in open_docs.items():
        for f in fs:
            where.setdefault(f, []).append(d)
    taken: set[int] = set()
    explained = Counter()
    while left:
        mark, n = max(left.items(), key=lambda item: (item[1], -item[0]))
        if n < least:
            break
        taken.add(mark)
        del left[mark]
        for d in where[mark]:
            explained[d] += holds[d][mark]
            if d in open_docs and explained[d] >= EXPLAINED:
                for f in open_docs.pop(d) & left.keys():
                    left[f] -= 1
    return taken


def _sums(p: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sum and largest of each text's marginals."""
    total, most = np.zeros(len(lengths)), np.zeros(len(lengths))
    has = lengths > 0
    if has.any():
        at = (np.cumsum(lengths) - lengths)[has]
        total[has], most[has] = np.add.reduceat(p, at), np.maximum.reduceat(p, at)
    return total, most


def _tagger(model: Model, sums: bool = False):
    """Scores and spans of texts; or, of labelled ones, the sum and the largest of the marginals."""

    class Evidence(dict):
        def __missing__(self, word: str) -> float:
            if len(self) >= _KEPT_WORDS:
                self.clear()
            value = self[word] = model.evidence(word)
            return value

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = Evidence()
        for batch in batches:
            texts = [t or "" for t in batch["text"]]
            for piece in portions([len(t) for t in texts]):
                rows = texts[piece]
                found = [TOKEN.findall(t.lower()) for t in rows]
                lengths = np.array([len(f) for f in found])
                evidence = np.fromiter((v for f in found for v in map(known.__getitem__, f)), dtype=float, count=int(lengths.sum()))
                first = np.zeros(len(evidence), dtype=bool)
                starts = np.cumsum(lengths) - lengths
                first[starts[lengths > 0]] = True
                p = marginals(evidence, first, model.moves)
                total, most = _sums(p, lengths)
                if sums:
                    yield pd.DataFrame({"label": batch["label"].values[piece], "total": total, "most": most})
                    continue
                score = model.scores(total, most)
                spans: list[list[str]] = [[] for _ in rows]
                for k in np.flatnonzero(most >= 0.5).tolist():
                    hot = np.flatnonzero(p[starts[k] : starts[k] + lengths[k]] >= 0.5)
                    # Lower-casing can change a text's length, so places are taken from it as it is; the words are as many.
                    places = [(m.start(), m.end()) for m in TOKEN.finditer(rows[k])]
                    if len(places) == lengths[k]:
                        breaks = np.flatnonzero(np.diff(hot) > 1)
                        for i, j in zip(np.concatenate([[0], breaks + 1]), np.concatenate([breaks, [len(hot) - 1]])):
                            spans[k].append(f"{places[hot[i]][0]}:{places[hot[j]][1]}")
                yield pd.DataFrame({"doc_id": batch["doc_id"].values[piece], "score": score, "spans": [",".join(s) for s in spans]})

    return run


def learn(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, most_chars: int = MOST_CHARS) -> Model:
    """Fit on at most ``2 * per_class`` labelled documents."""
    return fit(sample(docs, labels, "toxic", per_class, most_chars))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted and spans (start:end of offending stretches, in code points)."""
    tagged = docs.select("doc_id", "text").mapInPandas(_tagger(model), "doc_id long, score double, spans string")
    return tagged.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "spans")


def accepted(docs: DataFrame, model: Model) -> DataFrame:
    """The documents that are not predicted toxic, with all their columns; the text decides, so no join is needed."""
    verdict = _tagger(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # Only a portion of a batch's texts are Python strings at a time, and rows pass as they came.
            for piece in portions(pc.fill_null(pc.utf8_length(batch.column("text")), 0).to_pylist()):
                part = batch.slice(piece.start, piece.stop - piece.start)
                texts = pd.DataFrame({"doc_id": np.arange(len(part)), "text": pd.Series(part.column("text").to_pylist(), dtype=object)})
                found = pd.concat([*verdict(iter([texts]))], ignore_index=True)
                yield part.filter(pa.array(found["score"].to_numpy() < 0.5))

    return docs.mapInArrow(run, docs.schema)
