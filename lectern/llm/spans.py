"""Places of pattern matches in texts, as columns (no Python in the tasks).

A text split by a pattern gives what lies between its matches, so places follow from the lengths of both.
Lengths and places are in code points. All patterns are linear in the text: runs begin at a look-behind and
are possessive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

NO_SPANS = "array<struct<start:int,stop:int,value:string>>"


def with_spans(df: DataFrame, text: str, patterns: dict[str, str]) -> DataFrame:
    """``df`` with a column of (start, stop, value) for each named pattern, in the order of the text."""
    hits = df.withColumns({f"_{name}": F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0)) for name, pattern in patterns.items()})
    return hits.withColumns({name: _placed(F.col(text), F.col(f"_{name}"), pattern) for name, pattern in patterns.items()}).drop(*[f"_{n}" for n in patterns])


def _placed(text: Column, matches: Column, pattern: str) -> Column:
    between = F.slice(F.split(text, pattern, -1), 1, F.size(matches))
    pairs = F.zip_with(between, matches, lambda gap, value: F.struct(F.length(gap).alias("gap"), value.alias("value")))

    def step(so_far: Column, x: Column) -> Column:
        start = so_far["at"] + x["gap"]
        stop = start + F.length(x["value"])
        return F.struct(stop.alias("at"), F.concat(so_far["out"], F.array(F.struct(start.alias("start"), stop.alias("stop"), x["value"].alias("value")))).alias("out"))

    none = F.array().cast(NO_SPANS)
    placed = F.aggregate(pairs, F.struct(F.lit(0).alias("at"), none.alias("out")), step, lambda end: end["out"])
    return F.when(F.size(matches) > 0, placed).otherwise(none)


def listed(kinds: dict[str, Column], by_start: bool) -> Column:
    """``kind:start:stop`` of all spans, joined by commas; by start and then kind, or by kind and then start."""
    def entries(number: int, kind: str, spans: Column) -> Column:
        def entry(s: Column) -> Column:
            first, second = (s["start"], F.lit(number)) if by_start else (F.lit(number), s["start"])
            return F.struct(first.alias("x"), second.alias("y"), F.concat_ws(":", F.lit(kind), s["start"].cast("string"), s["stop"].cast("string")).alias("z"))

        return F.transform(spans, entry)

    parts = [entries(number, kind, spans) for number, (kind, spans) in enumerate(kinds.items())]
    return F.array_join(F.transform(F.array_sort(F.concat(*parts)), lambda e: e["z"]), ",")


def digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def apart(span: Column, others: Column) -> Column:
    """Whether ``span`` overlaps none of ``others``."""
    return ~F.exists(others, lambda o: (o["start"] < span["stop"]) & (span["start"] < o["stop"]))
