import hashlib
import heapq
import random
import re
import zlib

import numpy as np
import pytest

from ringledger.llm import queries
from ringledger.llm import structure_repair as repair

BARE = r"[^\x20\x09-\x0D]"


def _damaged(rows):
    found = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        key = ":".join(" " if x is None else str(x) for x in (conv, turn))
        how = zlib.crc32(key.encode()) % 20
        text = "" if how == 1 else re.sub("[.!?]", "", text) if how == 2 else text
        row = (conv, turn, "user" if how == 4 else role, text)
        found += [row] * (0 if how == 0 else 2 if how == 3 else 1)
    return found


def _mark(role, text):
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()


def _report(rows):
    """Least cost and then least audit, by a search over whole paths."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, _mark(r[2], r[3])))
    faults, seen = [], set()
    for _, _, role, text in rows:
        bare = re.findall(BARE, text)
        faults.append("blank" if not bare else "duplicate" if (role, text) in seen
                      else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    initials = [role[:1] for _, _, role, _ in rows]
    turns = {r[1] for r in rows if r[1] is not None}
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, at, last, out = heapq.heappop(heap)
        if at == len(rows) and last in ("", "a"):
            break
        if (at, last) in done:
            continue
        done.add((at, last))
        then = "a" if last == "u" else "u"
        name = {"u": "user", "a": "assistant"}[then]
        heapq.heappush(heap, (cost + 5, audit + "I", at, then, (*out, f"{name}:")))
        if at < len(rows):
            heapq.heappush(heap, (cost + 2, audit + "D", at + 1, last, out))
            if faults[at] in ("", "truncated"):
                more = cost + 5 * (faults[at] == "truncated")
                role, text = rows[at][2:]
                if initials[at] == then or (initials[at] == "s" and last == ""):
                    heapq.heappush(heap, (more, audit + "K", at + 1, initials[at], (*out, f"{role}:{text}")))
                heapq.heappush(heap, (more + 1, audit + "R", at + 1, then, (*out, f"{name}:{text}")))
    return {
        "gaps": max(turns) - min(turns) + 1 - len(turns) if turns else 0,
        **{name: faults.count(name) for name in ("blank", "duplicate", "truncated")},
        "illegal": sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
        "cost": cost, "audit": audit,
        "repaired_sha256": hashlib.sha256("\n".join(out).encode()).hexdigest(),
    }


def _expected(rows, damage=True):
    names = {r[0] for r in rows}
    kept = _damaged(rows) if damage else [
        (c, t, *(" " if x is None else x for x in (r, s))) for c, t, r, s in rows]
    return {name: _report([r for r in kept if r[0] == name]) for name in names}


def _found(df):
    rows = [r.asDict() for r in df.collect()]
    found = {r.pop("conv", None): r for r in rows}
    assert len(found) == len(rows)
    return found


TURNS = "conv_id long, turn long, role string, text string"


@pytest.fixture
def turns(spark):
    return lambda rows: repair.prepared(spark.createDataFrame(rows, TURNS))


def _conversations(seed, n, longest):
    chosen = random.Random(seed)
    texts = ["Yes.", "No!", "what", "", " \n", "Go on? ", "a b c.", "cut off,"]
    rows = []
    for conv in range(n):
        for _ in range(chosen.randint(1, longest)):
            role = chosen.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None])
            turn = chosen.choice([None, *range(longest + 3)])
            rows.append((conv, turn, role, chosen.choice([*texts, None, f"own {chosen.random()}."])))
    return rows


def test_against_a_search_over_paths(turns):
    rows = _conversations(1, 150, 9)
    assert _found(repair.repairs(turns(rows))) == _expected(rows, damage=False)


def test_blocks_of_a_few_rows(turns):
    rows = _conversations(2, 12, 60)
    # A conversation whose rows mostly fall together, and one that fits one block.
    rows += [(100, 3, "user", "same.")] * 9 + [(100, 4, "assistant", "other.")] * 4
    assert _found(repair.repairs(turns(rows), block=3)) == _expected(rows, damage=False)


def test_damage(turns):
    rows = _conversations(3, 120, 6) + [(None, 1, "user", "x."), (None, None, None, None)]
    rows += [(1000 + k, 0, "user", "x.") for k in range(60)]
    expected = _expected(rows)
    assert any(r["audit"] == "" for r in expected.values())
    assert _found(repair.repairs(repair.damaged(turns(rows)), block=7)) == expected


def test_query_against_the_search(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select(
        "conv_id", "turn", "role", "text").collect()]
    found = queries.QUERIES["op13_structure_repair"](spark, sf)
    assert found.columns == ["conv_id", *repair.REPORT, "audit", "repaired_sha256"]
    assert _found(found.withColumnRenamed("conv_id", "conv")) == _expected(rows)


def test_odd_tables(spark, turns, clashing):
    assert repair.repairs(turns([])).collect() == []
    rows = [(1, 1, "user", "word " * 100_000 + "."), (1, 1, "user", None), (1, 2, "assistant", "So.")]
    rows += rows[:1]
    other = clashing(spark.createDataFrame(rows, TURNS)).selectExpr("*", "'x' as conv", "'y' as copies")
    assert _found(repair.repairs(repair.prepared(other))) == _expected(rows, damage=False)


def test_ranks_follow_the_audits():
    chosen = random.Random(5)
    rows = [{"row": k, "turn": k, "copies": 1, "state": chosen.randrange(4),
             "fault": chosen.choice([None, None, "truncated", "blank"])} for k in range(40)]
    block = repair.Block(rows)
    paths = repair.Paths([(block, repair.AT_END, True, False)])
    audits = []
    for node in range(4 * 41):
        way = paths.unrolled(node)
        audits.append("".join(repair.LETTERS[k] for k in paths.letters[way[:-1]]))
    order = {audit: k for k, audit in enumerate(sorted(set(audits)))}
    assert np.unique(paths.ranks, return_inverse=True)[1].tolist() == [order[a] for a in audits]
    # One arc after the other leads the same way as the doubled pointers.
    at, way = 0, [0]
    while paths.letters[at]:
        at = int(paths.pointers[0][at])
        way.append(at)
    assert paths.unrolled(0).tolist() == way


def test_table_of_a_block_equals_its_costs():
    rows = [{"row": k, "turn": k, "copies": 1 + k % 2, "state": k % 4, "fault": None} for k in range(9)]
    block = repair.Block(rows)
    table, behind = np.array(block.table()).reshape(4, 4), np.array(repair.AT_END)
    assert (table + behind).min(axis=1).tolist() == block.costs(repair.AT_END)[0]
