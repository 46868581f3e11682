import hashlib
import random
from collections import defaultdict

import pytest

from ringledger.llm import bwt
from ringledger.llm import suffix_dedup as dedup


def _expected(rows, length):
    """Equal rows are one document."""
    seen, out = set(), {}
    for name, text in sorted({row for row in rows if row[0] is not None}):
        whole = (text or "").encode()
        gone = bytearray(len(whole))
        for k in range(len(whole) - length + 1):
            if (window := whole[k : k + length]) in seen:
                gone[k : k + length] = b"\1" * length
            seen.add(window)
        left = bytes(c for c, g in zip(whole, gone) if not g)
        spans = sum(1 for k, g in enumerate(gone) if g and not (k and gone[k - 1]))
        out[name] = (len(whole), len(whole) - len(left), spans, hashlib.sha256(left).hexdigest())
    return out


def _check(df, length=100, gram=32, crowd=dedup.CROWD):
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    found = dedup.removals(df, length=length, gram=gram, crowd=crowd).collect()
    assert len(found) == len(rows)
    expected = _expected(rows, length)
    for r in found:
        if r["id"] is not None:
            assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == expected[r["id"]]
        else:
            assert r["n_removed"] == 0


@pytest.fixture(params=[10_000, 3])
def batch_rows(request, spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", request.param)
    yield
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_merged_transforms_find_every_repeat():
    rng = random.Random(1)
    for _ in range(80):
        length = rng.choice([2, 4, 10])
        letters = rng.choice([b"a", b"ab", b"abcd"])
        strings = [bytes(rng.choice(letters) for _ in range(rng.randint(0, 60)))
                   for _ in range(rng.randint(1, 12))]
        places = defaultdict(list)
        for i, s in enumerate(strings):
            for k in range(len(s) - length + 1):
                places[s[k : k + length]].append((i, k))
        found = defaultdict(list)
        block, string, offset = bwt.repeated(strings, length, shard_bytes=rng.choice([1, 30, 10**6]))
        for b, i, k in zip(block.tolist(), string.tolist(), offset.tolist()):
            found[b].append((i, k))
        repeats = sorted(sorted(v) for v in places.values() if len(v) > 1)
        assert sorted(sorted(v) for v in found.values()) == repeats


def test_against_brute_force(documents, batch_rows):
    rng = random.Random(2)
    passages = ["".join(rng.choice("abcdé ") for _ in range(n)) for n in (90, 120, 160, 400)]
    rows = []
    for k in range(60):
        parts = ["".join(rng.choice("uvwxyz") for _ in range(rng.randint(0, 80)))]
        for _ in range(rng.randint(0, 3)):
            parts += [rng.choice(passages)[rng.randint(0, 20):], rng.choice(["-", "..", ""])]
        rows.append((rng.choice([k, 1000 - k]), "".join(parts)))
    rows = list({name: (name, text) for name, text in rows}.values())
    _check(documents(rows + rows[:3]))
    _check(documents(rows), crowd=1)


def test_periodic_and_short_windows(documents):
    rng = random.Random(4)
    rows = [(k, "".join(rng.choice("ab") for _ in range(rng.randint(0, 60)))) for k in range(30)]
    _check(documents([*rows, (90, "ab" * 100), (91, "a" * 150), (92, "ba" * 70)]), length=20, gram=8)
    _check(documents([*rows, (90, "ab" * 100), (91, "a" * 150)]), length=20, gram=8, crowd=1)


def test_many_near_copies(documents):
    rng = random.Random(9)
    base = "".join(rng.choice("abcdefghij ") for _ in range(600))
    rows = []
    for k in range(60):
        at = rng.randint(0, 590)
        rows.append((k, base[:at] + rng.choice("XYZ") + base[at + rng.randint(0, 3):]))
    for crowd in (1, 10, 500):
        _check(documents(rows), crowd=crowd)


def _with_passage(n, seed=12):
    """One passage with different text around it in all documents."""
    rng = random.Random(seed)
    passage = "".join(rng.choice("abcdefghij ") for _ in range(400))

    def own(size):
        return "".join(rng.choice("klmnopqrst") for _ in range(size))

    return [(k, own(120) + passage + own(120)) for k in range(n)]


@pytest.mark.parametrize("crowd", [1, 20, 500])
def test_one_passage_in_many_surroundings(documents, crowd):
    _check(documents(_with_passage(80)).repartition(3), crowd=crowd)


def test_parts_of_one_key_are_few(documents, spark):
    length, gram, crowd = 100, 32, 20
    rows = _with_passage(300)
    docs = documents(rows)
    listed, seen = [], set()
    for name, text in rows:
        _, first, size, key, body = dedup.runs_of([text.encode()], length, gram)
        # Equal runs have fallen together by then.
        runs = [(k, a, n, True) for k, b, a, n in zip(*(x.tolist() for x in (key, body, first, size)))
                if not ((k, b) in seen or seen.add((k, b)))]
        listed.append((name, text, runs))
    once = spark.createDataFrame(
        listed, "id long, text string, "
        "runs array<struct<key: long, first: long, size: int, crowded: boolean>>"
    ).repartition(2)
    parts, _ = dedup.merge_parts(once, length, gram, crowd)
    assert docs.count() == 300
    assert max(r["count"] for r in parts.groupBy("key").count().collect()) <= 2 * crowd


def test_odd_documents_and_names(odd_documents, clashing):
    _check(clashing(odd_documents))


def test_texts_longer_than_a_group(documents, monkeypatch):
    monkeypatch.setattr(dedup, "GROUP_BYTES", 256)
    rng = random.Random(6)
    text = "".join(rng.choice("abcdefgh ") for _ in range(3000))
    pieces = dedup._pieces([_Scalar(text)], [_Scalar(1)], 100)
    starts = [at + k for _, offsets, held in pieces for at, piece in zip(offsets, held)
              for k in range(len(piece) - 99)]
    assert starts == list(range(3000 - 99))


class _Scalar:
    def __init__(self, value):
        self.value = value

    def as_py(self):
        return self.value


def test_empty_table(documents):
    assert dedup.removals(documents([])).collect() == []


def test_texts_are_cut_and_other_columns_kept(documents, clashing):
    rng = random.Random(8)
    passage = "".join(rng.choice("abcdefghij") for _ in range(150))
    docs = clashing(documents([(1, f"one {passage}"), (2, f"{passage} two"), (3, None)]))
    cut = dedup.without_repeats(docs)
    assert cut.columns == docs.columns
    assert {r["doc_id"]: r["text"] for r in cut.collect()} == {1: f"one {passage}", 2: " two", 3: None}
