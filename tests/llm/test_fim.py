"""Fill-in-middle against a plain listing of units."""

import hashlib
import random
import re

import numpy as np
import pytest

from lectern.llm import fim

LETTERS = "aAbzZ09 \n\t.,é漢🦆"


def _plain(doc_id, text, seed="1", rate=90, spm=20):
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    pre, mid, suf = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return len(units), "plain", None, None, text
    if h[3] % 100 < spm:
        return len(units), "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return len(units), "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


def _texts(seed, count=300):
    rng = random.Random(seed)
    return ["".join(rng.choice(LETTERS) for _ in range(rng.choice([0, 1, 2, 7, 63, 64, 65, 400]))) for _ in range(count)]


@pytest.mark.parametrize("together", [1, 7, 300])
def test_texts_against_listed_units(together):
    texts = _texts(together) + ["a<P>b", "<S>", "x<M>", "<P", "<S><", "ab" * 3000, "a" * 70_000, "." * 5000]
    for at in range(0, len(texts), together):
        some = texts[at : at + together]
        made = fim.transformed(some, list(range(at, at + len(some))))
        rows = list(zip(*(made[k] for k in ("n", "form", "prefix_chars", "middle_chars", "output"))))
        assert rows == [_plain(at + k, t) for k, t in enumerate(some)]
        assert [fim.restore(o, f) for o, f in zip(made["output"], made["form"])] == some


def test_markers_that_only_seem_to_be():
    """Texts that end in the first letters of a marker beside a marker."""
    for text in ("<P", "<S", "<M", "<", "<S<S", "a<P<M<S b", "P>S>M>"):
        for name in range(60):
            made = fim.transformed([text], [name], rate=100)
            assert made["form"] != ["plain"] and fim.restore(made["output"][0], made["form"][0]) == text


def test_ranks_of_a_wavelet_matrix():
    rng = np.random.default_rng(5)
    for size in (0, 1, 63, 64, 65, 1000):
        row = rng.integers(0, 8, size).astype(np.uint8)
        matrix, places = fim.WaveletMatrix(row), np.arange(size + 1)
        for symbol in range(8):
            assert matrix.rank(symbol, places).tolist() == np.concatenate([[0], np.cumsum(row == symbol)]).tolist()


def test_table(spark):
    rows = [(k, t, k % 3) for k, t in enumerate(_texts(11, 60))] + [(None, "no name here", 1), (7, None, 2), (8, "", 3), (9, "twice", 4), (9, "twice", 4), (2**60 + 1, "large id, some words", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n long")
    made = fim.fill_in_middle(docs).collect()
    expected = [(i, t, *_plain(i, t or "")) for i, t, _ in rows]
    assert sorted([tuple(r) for r in made], key=repr) == sorted(expected, key=repr)  # the column n is replaced
    found = {(r["doc_id"], r["restored_sha256"], r["form"]) for r in fim.digests(docs).collect()}
    assert found == {(i, hashlib.sha256((t or "").encode()).hexdigest(), _plain(i, t or "")[1]) for i, t, _ in rows}
    assert fim.digests(docs.limit(0)).count() == 0


def test_extra_columns_stay(spark):
    docs = spark.createDataFrame([(1, "some words to cut", [1, None], 2**62 + 1, None)], "doc_id long, text string, `a b` array<int>, output_sha256 long, form2 string")
    row = fim.fill_in_middle(docs, seed="x").first()
    assert row["a b"] == [1, None] and row["output_sha256"] == 2**62 + 1 and fim.restore(row["output"], row["form"]) == "some words to cut"
