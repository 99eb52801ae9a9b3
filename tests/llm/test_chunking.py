import json
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from strataq.llm import chunking as ck


def sample(n, seed=1):
    r = random.Random(seed)
    words = ["".join(r.choice("abcdefghij") for _ in range(r.randrange(2, 12))) for _ in range(300)]
    return " ".join(r.choice(words) + r.choice(["", "", "", ".", "\n"]) for _ in range(n))


def check(text, pieces, limit, overlap):
    assert pieces[0][0] == 0 and pieces[-1][1] == len(text) and pieces[-1][2] == "end"
    for a, b in zip(pieces, pieces[1:]):
        assert b[0] == a[1] - overlap and b[1] > a[1]
    assert all(0 < b - a <= limit for a, b, _ in pieces)


@settings(max_examples=80, deadline=None)
@given(st.text(alphabet="ab .\n§Ä😀", max_size=600), st.integers(5, 90), st.integers(0, 40))
def test_invariants(text, limit, overlap):
    if limit <= 2 * overlap:
        with pytest.raises(ValueError):
            ck.split_text(text, limit, overlap)
        return
    pieces = ck.split_text(text, limit, overlap)
    if text:
        check(text, pieces, limit, overlap)
    else:
        assert pieces == []


def test_natural_ends():
    text = sample(4000)
    pieces = ck.split_text(text, 1000, 80)
    check(text, pieces, 1000, 80)
    assert {k for _, _, k in pieces[:-1]} <= {"paragraph", "sentence", "structure"}
    hard = ck.split_text("x" * 5000, 1000, 80)
    check("x" * 5000, hard, 1000, 80)
    assert {k for _, _, k in hard[:-1]} == {"hard"}
    assert ck.split_text("x" * 1000, 1000, 80) == [(0, 1000, "end")]


def test_edits_change_neighbours_only():
    text = sample(20_000)
    before = {text[a:b] for a, b, _ in ck.split_text(text, 1500, 100)}
    edited = text[:30_000] + " ein Einschub. " + text[30_000:]
    after = [edited[a:b] for a, b, _ in ck.split_text(edited, 1500, 100)]
    assert sum(p not in before for p in after) <= 4 < len(after) / 4


def test_blocks(spark, rows):
    long = json.dumps({"label": "§ 1", "text": sample(900), "children": [{"text": sample(200, 2)}]})
    half = len(long) // 2
    data = [
        ("n", "v", 0, 0, 1, long, 1), ("n", "v", 0, 0, 1, long, 1), ("n", "v", 1, 0, 2, long[:half], 1), ("n", "v", 1, 1, 2, long[half:], 1), ("n", "v", 2, 0, 2, long[:half], 1),
        ("n", "v", 3, 0, 1, json.dumps({"text": "kurz"}), 1), ("n", "v", 4, 0, 1, "[" + long + "]", 1), ("n", "v", 5, 0, 1, None, 1), (None, "v", 6, 0, 1, long, 1),
    ]
    df = spark.createDataFrame(data, "norm_id string, version_id string, block_index int, part_index int, part_count int, block_json string, piece int")
    got = ck.split_blocks(df, 500, 50)
    pieces = rows(got, "block_index", "piece_index", "piece", "start_pos", "piece_count")
    assert {p[0] for p in pieces} == {0, 1, 6}
    for k in (0, 1, 6):
        own = [p for p in pieces if p[0] == k]
        text = ""
        for _, _, piece, start, n in sorted(own, key=lambda p: p[1]):
            assert n == len(own) and len(piece) <= 500
            text = text[: start - 1] + piece
        assert text == "\n".join(ck.parse_block(long))
    assert ck.split_blocks(df.limit(0), 500, 50).count() == 0


def test_column(spark):
    df = spark.createDataFrame([(1, "a b " * 100, 1), (2, None, 1), (3, "", 1)], "i int, t string, pieces int")
    got = {r["i"]: r["pieces"] for r in ck.split_column(df, "t", 100, 10).collect()}
    assert len(got[1]) > 3 and got[2] is None and got[3] == []
