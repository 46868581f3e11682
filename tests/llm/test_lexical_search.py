import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from ringledger.llm import lexical_search as lexical

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _terms(text):
    return re.findall(TERM, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def _expected(docs, queries, top=lexical.TOP):
    told = [(name, Counter(_terms(text))) for name, text in docs if _terms(text)]
    n, total = len(told), sum(sum(c.values()) for _, c in told)
    found = []
    for item, text in queries:
        scores = []
        for name, counts in told:
            m = 75 + (25 * sum(counts.values()) * n) // total
            score = 0
            for term in _terms(text):
                if tf := counts[term]:
                    df = sum(term in c for _, c in told)
                    w = math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))
                    score += w * ((1_000_000_000 * tf) // (1000 * tf + 12 * m))
            if score > 0:
                scores.append((-score, name is None, name or 0))
        for rank, (score, none, name) in enumerate(sorted(scores)[:top], 1):
            found.append((item, rank, None if none else name, -score))
    return sorted(found, key=str)


def _corpus(n, seed=1):
    chosen = random.Random(seed)
    words = [f"w{int(chosen.paretovariate(0.6)) % 400}" for _ in range(4000)]
    docs = [(k, " ".join(chosen.choices(words, k=chosen.randint(1, 80)))) for k in range(n)]
    docs += [(1000 + k, docs[k % 7][1]) for k in range(40)]  # ties
    queries = [(k, " ".join(chosen.choices(words, k=chosen.randint(1, 12)))) for k in range(25)]
    return docs, queries


@pytest.fixture
def small(monkeypatch):
    monkeypatch.setattr(lexical, "BLOCK", 4)
    monkeypatch.setattr(lexical, "SPAN", 32)


def _shards(docs, size):
    rows = []
    for first in range(0, len(docs), size):
        shard = lexical._Shard()
        for name, text in docs[first : first + size]:
            shard.add(name, text)
        rows.append(shard.row())
    return rows


def _searched(docs, queries, size, top):
    rows = _shards(docs, size)
    n, total = sum(len(r["ids"]) for r in rows), sum(r["n_terms"] for r in rows)
    df = Counter()
    for row in rows:
        df.update(dict(zip(row["terms"], row["dfs"])))
    weights = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * k + 1))) for t, k in df.items()}
    heaps = [lexical.Heap(top) for _ in queries]
    opened = blocks = 0
    for row in rows:
        for (_, text), heap in zip(queries, heaps):
            shard = lexical._Opened(row, weights, n, total)
            query = list(Counter(_terms(text)).items())
            lexical.search_shard(shard, query, heap)
            opened += shard.opened
            blocks += sum(len(shard.lists[t].heads) for t, _ in query if t in shard.lists)
    found = [(item, rank, name, int(score)) for (item, _), heap in zip(queries, heaps)
             for rank, (name, score) in enumerate(zip(heap.ids, heap.scores), 1)]
    return sorted(found, key=str), opened, blocks


@pytest.mark.parametrize("size", [50, 400])
def test_many_blocks_spans_and_shards(small, size):
    docs, queries = _corpus(600)
    random.Random(2).shuffle(docs)
    found, opened, blocks = _searched(docs, queries, size, 5)
    assert found == _expected(docs, queries, 5)
    assert opened < 0.9 * blocks  # the others were rejected by their bounds


def test_bounds_hold_every_posting(small):
    docs, _ = _corpus(200)
    row = _shards(docs, 1000)[0]
    shard = lexical._Opened(row, dict.fromkeys(row["terms"], 7), len(row["ids"]), row["n_terms"])
    for one in shard.lists.values():
        one.open(np.arange(len(one.heads)))
        block = np.repeat(np.arange(len(one.heads)), one.heads["n"])
        assert (one.adds <= one.bounds[block]).all()
        assert (one.docs[one.first_at[1:] - 1] == one.last).all()
        assert one.bound == one.bounds.max()


def test_wide_numbers_are_packed(small):
    shard = lexical._Shard()
    for k in range(300):
        shard.add(k, "rare " * 70_000 if k == 5 else "rare x" if k % 290 == 0 else "y")
    row = shard.row()
    opened = lexical._Opened(row, {"rare": 1, "y": 1}, 300, row["n_terms"])
    one = opened.lists["rare"]
    assert one.of(np.array([0, 1, 5, 290, 299])).nonzero()[0].tolist() == [0, 2, 3]
    one.open(np.arange(len(one.heads)))
    assert one.docs.tolist() == [0, 5, 290]


def _rows(df):
    return sorted(((r[0], r["rank"], r["doc_id"], r["score"]) for r in df.collect()), key=str)


def test_whole_operator_against_brute_force(spark, documents, clashing):
    docs, queries = _corpus(150)
    docs += [(None, docs[3][1]), (2000, None), (2001, ""), (2002, "..."), docs[5], (3, docs[9][1])]
    queries += [(100, None), (101, "unseen"), (102, "..."), (3, "w1 w1 w2"), (None, "w2 W1")]
    asked = spark.createDataFrame(queries, "item_id long, text string")
    index = lexical.indexed(clashing(documents(docs).repartition(3)), shard_postings=900)
    assert index.count() > 3
    found = lexical.search(index, clashing(asked), top=7, query_block=10)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert _rows(found) == _expected(docs, queries, 7)


def test_odd_texts_and_empty_tables(spark, documents, odd_documents):
    asked = spark.createDataFrame([(1, "one é WORD id")], "item_id long, text string")
    docs = [(r["doc_id"], r["text"]) for r in odd_documents.collect()]
    assert _rows(lexical.ranked(odd_documents, asked)) == _expected(docs, [(1, "one é WORD id")])
    assert lexical.ranked(documents([]), asked).collect() == []
    assert lexical.ranked(odd_documents, asked.limit(0)).collect() == []


def test_no_row_of_the_index_holds_a_whole_shard(spark, documents):
    docs = [(k, f"common w{k} v{k}") for k in range(6000)]
    index = lexical.indexed(documents(docs).coalesce(1))
    sizes = [
        sum(len(x) * (8 if isinstance(x, list) else 1) for x in row if hasattr(x, "__len__"))
        for row in index.collect()
    ]
    assert max(sizes) < 100_000 < sum(sizes)


def test_rows_of_a_shard_may_lie_anywhere_and_indexes_add_up(spark, documents):
    docs, queries = _corpus(60)
    parts = [lexical.indexed(documents(x).coalesce(2), shard_postings=300)
             for x in (docs[:50], docs[50:])]
    index = parts[0].unionByName(parts[1]).repartition(5)
    asked = spark.createDataFrame(queries, "item_id long, text string")
    assert _rows(lexical.search(index, asked, top=6)) == _expected(docs, queries, 6)
