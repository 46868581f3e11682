import re

import xxhash

from ringledger.llm import simhash
from ringledger.llm.components import components


def _print(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    runs = [" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(run, 42) for run in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _expected(rows):
    prints = [_print(text) for _, text in rows]
    group = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= 2:
                old, new = group[a], group[b]
                group = [new if g == old else g for g in group]
    first = {}
    for (name, _), g in zip(rows, group):
        if name is not None:
            first[g] = min(first.get(g, name), name)
    return sorted(
        ((name, f"{p:016x}", first.get(g)) for (name, _), p, g in zip(rows, prints, group)), key=str
    )


def _found(df):
    rows = simhash.near_copies(df).withColumn("hex", simhash.as_hex(simhash.F.col("fp"))).collect()
    return sorted(((r["id"], r["hex"], r["component_id"]) for r in rows), key=str)


def test_against_brute_force(documents):
    base = " ".join(f"w{k % 97}x{k // 7}" for k in range(3000))
    words = base.split()
    rows = [(100 - k, " ".join([*words[:k], "new", *words[k:]])) for k in range(0, 40, 2)]
    rows += [(200, base), (201, base.upper()), (300, "quite another text of its own")]
    assert _found(documents(rows)) == _expected(rows)


def test_odd_texts_repeated_rows_and_names(odd_documents, clashing):
    rows = [(r["doc_id"], r["text"]) for r in odd_documents.collect()]
    assert _found(clashing(odd_documents)) == _expected(rows)


def test_links_reach_every_distance_two_pair(spark):
    prints = [0, 1, 3, 7, 1 << 63, (1 << 63) | (1 << 31), -1, -2]
    rows = [(p - (1 << 64) if p >> 63 and p > 0 else p,) for p in prints]
    found = simhash.links(spark.createDataFrame(rows, "fp long")).distinct().collect()
    values = [row[0] for row in rows]
    near = {(min(a, b), max(a, b)) for a in values for b in values
            if a != b and ((a ^ b) & (2**64 - 1)).bit_count() <= 2}
    assert {(r["a"], r["b"]) for r in found} == near


def test_empty_table(documents):
    assert _found(documents([])) == []
    assert simhash.one_of_each(documents([])).collect() == []


def test_one_of_each_group_stays(odd_documents, clashing):
    kept = simhash.one_of_each(clashing(odd_documents)).select("doc_id", "text").collect()
    names = sorted((r["doc_id"] for r in kept if r["doc_id"] is not None))
    component = {name: first for name, _, first in _found(odd_documents)}
    assert names == sorted({first for name, first in component.items() if name is not None})
    assert any(r["doc_id"] is None for r in kept)


def test_components_of_a_long_chain_and_self_links(spark):
    rows = [(k, k + 1) for k in range(60)] + [(100, 100), (201, 200), (None, 3)]
    found = {r["node"]: r["label"] for r in components(spark.createDataFrame(rows, "a long, b long")).collect()}
    assert found == {**{k: 0 for k in range(61)}, 100: 100, 200: 200, 201: 200}


def _edited(words, places):
    return " ".join(f"{word}x" if k in places else word for k, word in enumerate(words))


def test_one_of_each_leaves_what_the_links_leave(documents):
    words = [f"w{k * 7919 % 1009}" for k in range(4000)]
    rows = [(k, _edited(words, {k * 13})) for k in range(40)]
    rows += [(100 + k, _edited(words, set(range(k, 4000, 6)))) for k in range(5)]
    component = {name: first for name, _, first in _expected(rows)}
    assert 5 < len(set(component.values())) < len(rows)
    kept = {r["doc_id"] for r in simhash.one_of_each(documents(rows)).collect()}
    assert kept == set(component.values())
