import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import labelloom.llm.impacts as module
from labelloom.llm.impacts import Bucket, rank_documents, terms_of
from labelloom.llm.op11 import OP11_SQL, op11_rank_documents
from labelloom.catalog.base import Entry
from tests.compare import compare, connect
from tests.llm.helpers import SF, awkward_documents, empty_documents

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def words(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain(docs, items, k=10):
    """All scores, in Python integers."""
    held = [(i, Counter(words(t))) for i, t in docs]
    held = [(i, c, sum(c.values())) for i, c in held if c]
    n_docs, total = len(held), sum(n for *_, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in items:
        scores = []
        for doc, c, n in held:
            m = 100 - 90 + (90 * n * n_docs) // total
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in set(words(text)))
            if score > 0:
                scores.append((-score, doc is None, doc or 0, doc))
        out += [(item, rank, s[3], -s[0]) for rank, s in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


def rows(df):
    return sorted(map(tuple, df.select("item_id", "rank", "doc_id", "score").collect()), key=str)


def frame(spark, found, name):
    return spark.createDataFrame(found, f"{name} bigint, text string")


def test_terms():
    text = "Straße's 3rd—MIT_x\x7fÄb\x00c d"
    assert [t.decode() for t in terms_of(text)] == words(text)
    assert terms_of(None) == terms_of("") == terms_of(" .,") == []


def test_query_equals_its_sql(spark):
    assert compare(spark, connect(SF), Entry(op11_rank_documents, OP11_SQL), SF)[0].startswith("ok")


@pytest.mark.parametrize("first", [10, 100, 10_000])
@pytest.mark.parametrize("bucket", [1, 16, 1024])
def test_buckets_of_any_size_give_the_same_rows(spark, monkeypatch, first, bucket):
    monkeypatch.setattr(module, "FIRST_ROWS", first)
    monkeypatch.setattr(module, "FILE_ROWS", 30)
    rng = np.random.default_rng(first + bucket)
    vocabulary = [f"w{i}" for i in range(60)]
    chances = 1 / np.arange(1, 61)
    texts = [" ".join(rng.choice(vocabulary, rng.integers(1, 80), p=chances / chances.sum())) for _ in range(200)]
    docs = list(enumerate(texts + texts[:30]))
    items = [(i, " ".join(rng.choice(vocabulary, 8))) for i in range(12)]
    assert rows(rank_documents(frame(spark, docs, "doc_id"), frame(spark, items, "item_id"), bucket_rows=bucket)) == plain(docs, items)


def test_blocks_of_queries(spark):
    docs = [(i, f"alpha beta{i % 7} gamma{i % 3}") for i in range(50)]
    items = [(i, f"beta{i} gamma1 delta") for i in range(9)]
    for size in (1, 60, 10**6):
        assert rows(rank_documents(frame(spark, docs, "doc_id"), frame(spark, items, "item_id"), block_bytes=size)) == plain(docs, items)


def test_awkward_rows(spark):
    docs = [(1, "Alpha beta"), (2, None), (3, ""), (4, "!!"), (None, "alpha beta"), (5, "alpha beta"), (5, "alpha beta"), (6, "x " * 50_000 + "beta"), (7, "ALPHA alpha ALPHA")]
    items = [(1, "alpha, Beta"), (2, None), (3, ""), (4, "..."), (5, "nowhere"), (6, "beta beta beta"), (6, "beta"), (None, "x")]
    names = ["norm", "n", "terms", "impacts", "item", "_item", "score", "rank"]
    clash = frame(spark, docs, "doc_id").select("*", *[F.lit(1).alias(c) for c in names])
    asked = frame(spark, items, "item_id").select("*", *[F.lit(1).alias(c) for c in names])
    assert rows(rank_documents(clash, asked)) == plain(docs, items)


def test_empty_tables(spark):
    docs, items = awkward_documents(spark), frame(spark, [(1, "the mit license")], "item_id")
    assert rank_documents(empty_documents(spark), items).count() == 0
    assert rank_documents(docs, items.limit(0)).count() == 0
    assert rank_documents(docs, frame(spark, [(1, None), (2, "?")], "item_id")).count() == 0
    assert rank_documents(docs, items).count() == 3


def test_candidates_hold_every_row_that_reaches_the_score():
    rng = np.random.default_rng(0)
    for _ in range(200):
        n, size = int(rng.integers(1, 30)), int(rng.integers(2, 12))
        dense = rng.integers(0, 50, (n, size)) * (rng.random((n, size)) < 0.4)
        dense[:, 0] += dense.sum(1) == 0
        row, terms = np.nonzero(dense)
        norms = np.sqrt((dense**2).sum(1).astype(float))
        bucket = Bucket(norms, np.arange(n), np.cumsum(np.bincount(row, minlength=n)), terms, dense[row, terms], size)
        query = np.flatnonzero(rng.random(size) < 0.5)
        if not len(query):
            continue
        scores = dense[:, query].sum(1)
        asked = np.zeros(size, bool)
        asked[query] = True
        for wanted in (1, 20, 60, 100):
            found = bucket.candidates(query, wanted)
            assert set(np.flatnonzero(scores >= wanted)) <= set(found)
            assert (bucket.scores(found, asked) == scores[found]).all()
