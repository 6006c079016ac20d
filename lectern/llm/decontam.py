"""Benchmark decontamination by size-partitioned MinHash containment search.

Which benchmark items are contained in which documents: at least ``percent`` of an item's five-word shingles
occur in the document. Similarity says nothing here, as documents may be a thousand times an item's size, so the
items are sketched and the documents are probed with all of their shingles. Items are partitioned by size, in
powers of two. An item's sketch is the ``k`` shingles that are smallest under one hash function; k follows
from the largest size of its partition so that k is more than the shingles an item of that size may lack. So
every document that contains an item holds one of its sketch at least, whatever its own size, and none is missed. Such candidates are verified
by the exact number of the item's shingles in the document.

The item tables are small beside the documents; when they have at most ``BROADCAST_SHINGLES`` rows each task
gets them as a sorted array and only hits leave it, else shingles are joined by shuffle with the same result.

Defined results: an item or document with fewer than five words has one shingle of all its words, so short
items are found in equal texts only; null or empty texts have none and take no part. Rows that share doc_id
and text, or item_id and text, count once. An empty table on either side gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from lectern.llm.links import text_key, without_rows
from lectern.llm.shingles import as_long, shingles
from lectern.session import cut_lineage

PERCENT = 75
BROADCAST_SHINGLES = 500_000
_FACTOR, _ADDEND = np.uint64(0xD1342543DE82EF95), np.uint64(0x2545F4914F6CDD1D)


def sketch_size(count: int, percent: int = PERCENT) -> int:
    """How many minima an item of ``count`` shingles has: more than any item of its partition may lack."""
    largest = 2 ** int(count).bit_length() - 1
    return min(count, (100 - percent) * largest // 100 + 1)


def index(items: DataFrame, percent: int = PERCENT) -> DataFrame:
    """item_id, item_key, n_item, shingle, sketched: one row per distinct shingle of an item."""
    kind = items.schema["item_id"].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for number, key, text in zip(batch["item_id"], batch["item_key"], batch["text"]):
                found = shingles(text)
                order = np.argsort(found * _FACTOR + _ADDEND, kind="stable")
                sketched = np.zeros(len(found), dtype=bool)
                sketched[order[: sketch_size(len(found), percent)]] = True
                yield pd.DataFrame({"item_id": pd.Series([number] * len(found), dtype=object), "item_key": key, "n_item": len(found), "shingle": as_long(found), "sketched": sketched})

    known = items.select("item_id", F.xxhash64("text").alias("item_key"), "text").dropDuplicates(["item_id", "item_key"])
    return known.mapInPandas(run, f"item_id {kind}, item_key long, n_item int, shingle long, sketched boolean")


def _probe(known: np.ndarray, sketched: np.ndarray):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for number, key, text in zip(batch["doc_id"], batch["doc_key"], batch["text"]):
                found = as_long(shingles(text))
                at = np.searchsorted(known, found)
                at[at == len(known)] = 0
                hit = known[at] == found
                if sketched[at[hit]].any():
                    rows.append((number, key, found[hit]))
            yield pd.DataFrame(rows, columns=["doc_id", "doc_key", "shingles"])

    return run


def _all_shingles(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield pd.DataFrame({"doc_id": batch["doc_id"], "doc_key": batch["doc_key"], "shingles": [as_long(shingles(t)) for t in batch["text"]]})


def _found(docs: DataFrame, items: DataFrame, percent: int = PERCENT, broadcast: int = BROADCAST_SHINGLES) -> DataFrame:
    """doc_id, doc_key (of its text), item_id, n_item and n_shared of each contained item's text."""
    table = index(items, percent)
    texts = docs.select("doc_id", text_key().alias("doc_key"), "text")
    schema = "doc_id long, doc_key long, shingles array<long>"
    # The same shingle may belong to many items; each is sent once, marked if it is in any sketch.
    flags = table.groupBy("shingle").agg(F.max("sketched").alias("sketched"))
    rows = flags.limit(broadcast + 1).collect()
    if not rows:
        probed = texts.limit(0).selectExpr("doc_id", "doc_key", "cast(array() as array<bigint>) as shingles")
    elif len(rows) <= broadcast:
        rows.sort()
        known, sketched = np.array([r[0] for r in rows], dtype=np.int64), np.array([r[1] for r in rows])
        probed = texts.mapInPandas(_probe(known, sketched), schema)
    else:
        probed = texts.mapInPandas(_all_shingles, schema)
    hits = probed.select("doc_id", "doc_key", F.explode("shingles").alias("shingle")).distinct()
    shared = hits.join(table, "shingle").groupBy("doc_id", "doc_key", "item_id", "item_key", "n_item").agg(F.count("*").alias("n_shared"), F.max("sketched").alias("candidate"))
    return shared.where(F.col("candidate") & (100 * F.col("n_shared") >= percent * F.col("n_item")))


def contained(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """doc_id, item_id, n_item, n_shared and containment of each contained item."""
    found = _found(docs, items, **options)
    # Several texts of one id: the best counts.
    best = found.groupBy("doc_id", "item_id").agg(F.max(F.struct((F.col("n_shared") / F.col("n_item")).alias("containment"), "n_item", "n_shared")).alias("x"))
    return best.select("doc_id", "item_id", F.col("x.n_item").cast("bigint").alias("n_item"), F.col("x.n_shared").alias("n_shared"), F.col("x.containment").alias("containment"))


def clean(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The documents that contain no item; each text is judged by itself, also if its doc_id is null or has others."""
    return without_rows(docs, cut_lineage(_found(docs, items, **options).select("doc_id", F.col("doc_key").alias("text_key")).distinct()))


_WORDS = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+')"
_SHINGLED = "CASE WHEN len(w) = 0 THEN [] ELSE list_distinct(list_transform(range(1, greatest(len(w) - 4, 1) + 1), lambda i: array_to_string(w[i:i + 4], ' '))) END"
SQL = f"""
WITH i AS (SELECT item_id, {_SHINGLED} AS s FROM (SELECT item_id, {_WORDS} AS w FROM benchmark)),
d AS (SELECT doc_id, {_SHINGLED} AS s FROM (SELECT doc_id, {_WORDS} AS w FROM documents)),
ix AS (SELECT item_id, len(s) AS n_item, unnest(s) AS x FROM i),
dx AS (SELECT doc_id, unnest(s) AS x FROM d)
SELECT doc_id, item_id, any_value(n_item)::BIGINT AS n_item, count(*)::BIGINT AS n_shared, count(*)::DOUBLE / any_value(n_item)::DOUBLE AS containment
FROM dx JOIN ix USING (x) GROUP BY doc_id, item_id HAVING 100 * count(*) >= 75 * any_value(n_item)
"""
