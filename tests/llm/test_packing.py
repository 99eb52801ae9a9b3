import os
import random
from collections import Counter

import numpy as np
import pytest

from strataq.llm import packing as pk

needs_vocabulary = pytest.mark.skipif(not os.path.exists(pk.TOKENIZER), reason="no vocabulary file")


def use(patterns):
    used = Counter()
    for p, m in patterns:
        for length, k in p.items():
            used[length] += k * m
    return used


@pytest.mark.parametrize("seed, capacity", [(1, 50), (2, 128), (3, 512), (4, 7), (5, 1)])
def test_plan_uses_every_length_within_capacity(seed, capacity):
    r = random.Random(seed)
    counts = Counter(min(capacity, 1 + int(r.expovariate(4 / capacity))) for _ in range(3000))
    patterns = pk.plan_patterns(dict(counts), capacity)
    assert use(patterns) == counts
    assert all(sum(x * k for x, k in p.items()) <= capacity and m > 0 for p, m in patterns)
    least = -(-sum(x * n for x, n in counts.items()) // capacity)
    assert sum(m for _, m in patterns) <= max(least + 2, least * 1.02)


def test_exact_complements():
    assert sorted(pk.plan_patterns({7: 5, 3: 5}, 10), key=str) == [({7: 1, 3: 1}, 5)]
    assert pk.plan_patterns({6: 4, 3: 4, 1: 4}, 10) == [({6: 1, 3: 1, 1: 1}, 4)]
    assert pk.plan_patterns({5: 5}, 10) == [({5: 2}, 2), ({5: 1}, 1)]
    full = pk.plan_patterns({4: 2, 3: 2, 2: 2, 1: 2}, 10)
    assert sum(m for _, m in full) == 2 and all(sum(x * k for x, k in p.items()) == 10 for p, _ in full)
    assert pk.plan_patterns({}, 10) == [] and pk.plan_patterns({6: 3}, 10) == [({6: 1}, 3)]


def test_hot_length_plans_in_few_steps():
    patterns = pk.plan_patterns({100: 10**9, 28: 3 * 10**8, 17: 10**7}, 512)
    assert len(patterns) < 50 and use(patterns) == {100: 10**9, 28: 3 * 10**8, 17: 10**7}


def test_slots_cover_ranks():
    patterns = pk.plan_patterns({5: 7, 3: 9, 2: 4}, 11)
    seen = set()
    for length, table in pk.slots(patterns).items():
        n = {5: 7, 3: 9, 2: 4}[length]
        for rank in range(n):
            row = [r for r in table if r[0] <= rank][-1]
            seen.add((row[1] + (rank - row[0]) // row[2], row[3] + (rank - row[0]) % row[2]))
    assert len(seen) == 20


@needs_vocabulary
def test_pack(spark):
    r = random.Random(1)
    texts = [("wort " * r.randrange(1, 60)) for _ in range(80)] + ["gleich " * 9] * 60 + ["", None, "x" * 900, "äöü😀" * 200, "Satz. " * 400]
    data = [(i if t is not None or i % 2 else None, t, i) for i, t in enumerate(texts)] + [(5, "doppelt", 1), (5, "doppelt", 1), (None, "ohne", 2)]
    df = spark.createDataFrame(data, "doc_id long, text string, container_id int")
    caps = {"small": 32, "large": 100}
    got = pk.pack(df, caps).collect()
    enc = pk.encoder()
    by_doc = {}
    for x in got:
        by_doc.setdefault((x["capacity_name"], x["doc_id"]), []).append(x)
    for name, capacity in caps.items():
        fill, places = Counter(), Counter()
        for x in got:
            if x["capacity_name"] == name:
                fill[x["container_id"]] += x["n_tokens"]
                places[x["container_id"], x["position"]] += 1
        assert max(fill.values()) <= capacity and set(places.values()) == {1} and sorted(fill) == list(range(len(fill)))
        for d, t, _ in data:
            if d is None or t is None or t == "doppelt" or d == 5:
                continue
            pieces = sorted(by_doc[name, d], key=lambda x: x["piece_index"])
            assert "".join(t[p["start_pos"] - 1 : p["start_pos"] - 1 + p["n_chars"]] for p in pieces) == t
            if len(enc.encode_ordinary(t)) <= capacity:
                assert len(pieces) == 1 and pieces[0]["n_tokens"] == max(1, len(enc.encode_ordinary(t)))
        assert len(by_doc[name, 5]) == 3
    assert pk.pack(df.limit(0), caps).count() == 0
    with pytest.raises(ValueError):
        pk.pack(df, {})


def test_a_hot_length_is_ranked_in_groups(spark, monkeypatch):
    """Half of all rows are one repeated row, others share its length."""
    monkeypatch.setattr(pk, "GROUP_ROWS", 7)
    data = [(1, "ein Text")] * 60 + [(i, f"{chr(97 + i % 26)} Text") for i in range(2, 40)] + [(100 + i, "") for i in range(30)]
    got = pk.pack(spark.createDataFrame(data, "doc_id long, text string").repartition(5), {"c": 16}).collect()
    assert len(got) == len(data) and len({(r["container_id"], r["position"]) for r in got}) == len(data)
    fill = {}
    for r in got:
        fill[r["container_id"]] = fill.get(r["container_id"], 0) + r["n_tokens"]
    assert max(fill.values()) <= 16 and len(fill) == -(-sum(fill.values()) // 16)


def test_index_of_sums():
    h = pk._Lengths({3: 1, 5: 2, 9: 1}, 20)
    assert {int(x) for x in np.flatnonzero(h.pairs)} == {6, 8, 10, 12, 14, 18} and h.triple(13) == (5, 5, 3) and h.triple(4) is None and not h.triples[7]
    assert h.triple(9) is None and h.pair(6) is None  # 3 is there once only
