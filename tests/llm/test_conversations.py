"""Repair of conversations: by hand, against all edits tried, in segments, and on awkward rows."""

import random

import pytest

import plain
from martflow.llm import conversations

SF = "/root/testdata/sf0.001"
KINDS = "conv_id bigint, turn bigint, role string, text string"


@pytest.mark.parametrize("symbols, cost, audit", [
    ("", 0, ""), ("ua", 0, "KK"), ("sua", 0, "KKK"), ("u", 3, "KI"), ("a", 3, "IK"), ("s", 4, "D"), ("uu", 3, "KR"),
    ("uua", 3, "KIKK"), ("x", 4, "D"), ("oa", 3, "RK"), ("UA", 6, "KK"), ("su", 3, "KKI"), ("uxa", 4, "KDK"),
])
def test_cheapest_edits_by_hand(symbols, cost, audit):
    assert conversations.search(symbols)[:2] == (cost, audit)


def _tried(symbols):
    """All cheapest edits by plain recursion; the first in ASCII."""
    best = {}

    def go(i, state, cost, audit, row):
        if cost > best.get("cost", 10**9) or row > 2:
            return
        if i == len(symbols) and state in conversations.ENDS:
            best["cost"], best["audit"] = min((cost, audit), (best.get("cost", 10**9), best.get("audit", "")))
        go(i, conversations._TURN[state], cost + 3, audit + "I", row + 1)
        for edit, price, to in conversations.MOVES[symbols[i]][state] if i < len(symbols) else []:
            go(i + 1, to, cost + price, audit + edit, 0)

    go(0, conversations.START, 0, "", 0)
    return best["cost"], best["audit"]


def test_search_equals_all_edits_tried():
    draw = random.Random(11)
    for _ in range(400):
        symbols = "".join(draw.choice("suaoSUAOx") for _ in range(draw.randint(0, 6)))
        assert conversations.search(symbols)[:2] == _tried(symbols), symbols


def test_bounds_never_exceed_what_edits_cost():
    draw = random.Random(12)
    for _ in range(100):
        symbols = "".join(draw.choice("suaoUAx") for _ in range(5))
        least = conversations.bounds(symbols, conversations.ENDS)
        assert least[0][conversations.START] == _tried(symbols)[0]
        assert all(a[s] <= b[t] + price for i, (a, b) in enumerate(zip(least, least[1:]))
                   for s, own in enumerate(conversations.MOVES[symbols[i]]) for _, price, t in own)


def test_a_long_conversation_is_searched_in_linear_time():
    draw = random.Random(13)
    symbols = "".join(draw.choice("suuaaox") for _ in range(30_000))
    cost, audit, _ = conversations.search(symbols)
    assert cost > 0 and len(audit.replace("I", "")) == len(symbols)


def _awkward():
    draw = random.Random(7)
    rows = [(1, 0, "user", "Hi."), (1, 0, "user", "Hi."), (1, 1, "assistant", "Yes!"), (2, None, "user", "a?"), (2, None, None, None),
            (2, 5, "assistant", " \t"), (2, 5, "assistant", "cut"), (None, 1, "user", "Null id."), (None, 2, "assistant", "Fine."),
            (3, 1, "system", "S."), (4, 1, "", "No role."), (4, 2, "user", "x" * 300_000 + "."), (5, -3, "tool", "é!"), (5, 9, "assistant", "end\n .\n "),
            (6, 1, "user", ""), (7, 1, "user", " "), (8, 10**12, "user", "Far."), (8, -10**12, "assistant", "Far.")]
    for conv in range(100, 160):
        rows += [(conv, draw.randint(0, 12) if draw.random() < 0.95 else None, draw.choice(["system", "user", "assistant", "user", "assistant", "tool", None]),
                  draw.choice(["One.", "Two!", "three", "", "Five?", f"{draw.random()}."])) for _ in range(draw.randint(1, 14))]
    rows += [(500, i, draw.choice(["user", "assistant", "assistant", "system"]), f"{i % 90}{draw.choice(['.', ''])}") for i in range(400)]
    return rows


def _frame(spark, rows):
    return spark.createDataFrame(rows, KINDS).selectExpr(
        "*", "'x' AS audit", "'x' AS symbol", "'x' AS part", "'x' AS n", "'x' AS initial", "'x' AS edit", "'x' AS pos").repartition(5)


@pytest.mark.parametrize("segment", [3, 4096])
def test_awkward_rows_against_all_edits(spark, segment):
    rows = _awkward()
    frame = _frame(spark, rows)
    want = plain.repaired(rows)
    found = conversations.reports(frame, segment)
    assert {r["conv_id"]: tuple(r)[1:] for r in found.collect()} == {k: v[:-1] for k, v in want.items()}
    texts = {}
    for r in sorted(conversations.repaired(frame, found).collect(), key=lambda r: r["pos"]):
        texts.setdefault(r["conv_id"], []).append(f"{r['role']}:{r['text']}")
        assert len(texts[r["conv_id"]]) == r["pos"] + 1 and (r["turn"] is None or r["edit"] in "KR")
    assert {k: "\n".join(v) for k, v in texts.items()} == {k: v[-1] for k, v in want.items() if v[-1]}


def test_damage_and_repair_of_awkward_rows(spark):
    rows = _awkward() + [(c, t, "user", f"{c}.") for c in range(1000, 1040) for t in (0, 1)]
    want = plain.repaired(plain.damaged(rows))
    found = conversations.damaged_and_repaired(_frame(spark, rows)).collect()
    assert len(found) == len({r[0] for r in rows}) > len(want)  # some lose all their rows
    for r in found:
        *counts, text = want.get(r["conv_id"], (0, 0, 0, 0, 0, 0, "", ""))
        assert tuple(r)[1:] == (*counts, plain.sha(text)), r["conv_id"]


def test_no_rows(spark):
    empty = spark.createDataFrame([], KINDS)
    assert conversations.reports(empty).count() == 0
    assert conversations.damaged_and_repaired(empty).count() == 0
    assert conversations.repaired(empty, conversations.reports(empty)).count() == 0


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    want = plain.repaired(plain.damaged(rows))
    found = {r["conv_id"]: tuple(r)[1:] for r in conversations.query(spark, SF).collect()}
    assert set(found) == {r[0] for r in rows}
    for conv, own in found.items():
        *counts, text = want.get(conv, (0, 0, 0, 0, 0, 0, "", ""))
        assert own == (*counts, plain.sha(text))
