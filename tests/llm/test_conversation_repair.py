"""Conversation repair against all edit sequences, in one fragment and in many."""

import hashlib
import random
import re
import zlib
from functools import lru_cache
from itertools import product

import pytest

from churnlens.llm import conversation_repair as cr
from churnlens.llm import queries


@lru_cache
def _gaps(most):
    return [g for n in range(most + 1) for g in product("ua", repeat=n)]


def _brute(kinds):
    """(cost, audit) over all edits of single rows and up to two insertions in each gap."""
    best = None
    rows = [[("D", "", 2)] if k in "bd" else
            [("D", "", 2), ("K", k.lower(), 5 * k.isupper()),
             ("R", "u", 1 + 5 * k.isupper()), ("R", "a", 1 + 5 * k.isupper())] for k in kinds]
    for edits in product(*rows):
        for gaps in product(_gaps(2), repeat=len(kinds) + 1):
            roles = "".join("".join(g) + e[1] for g, e in zip(gaps, [*edits, ("", "", 0)], strict=True))
            if re.fullmatch("(s?(ua)+)?", roles):
                audit = "".join("I" * len(g) + e[0] for g, e in
                                zip(gaps, [*edits, ("", "", 0)], strict=True))
                cost = sum(e[2] for e in edits) + 5 * audit.count("I")
                best = min(best or (cost, audit), (cost, audit))
    return best


def _solve(kinds, size):
    parts = [kinds[i:i + size] for i in range(0, len(kinds), size)]
    found = [cr.paths(p, (1,) * len(p)) for p in parts]
    cost, states = cr.choose([[(p.source, p.target, p.cost, p.rank) for p in f] for f in found])
    letters = [next(p.letters for p in f if (p.source, p.target) == st)
               for f, st in zip(found, states, strict=True)]
    return cost, "".join(letters) + cr.ENDS[states[-1][1]]


@pytest.mark.parametrize("kinds", ["".join(k) for n in (1, 2) for k in product("suaoSUAOb", repeat=n)])
def test_short_conversations(kinds):
    assert _solve(kinds, 9) == _brute(kinds)


def test_longer_conversations():
    rng = random.Random(2)
    for _ in range(12):
        kinds = "".join(rng.choice("ssuuaaouUAAbd") for _ in range(3))
        assert _solve(kinds, 3) == _brute(kinds) == _solve(kinds, 1)
    for _ in range(200):
        kinds = "".join(rng.choice("suuuaaaoUAbd") for _ in range(rng.randint(4, 60)))
        whole = _solve(kinds, 60)
        assert whole == _solve(kinds, rng.randint(1, 7))
        assert len(whole[1].replace("I", "")) == len(kinds)


def test_walk_writes_the_roles():
    cost, audit = _solve("aou", 3)
    steps = cr.walk(cr.START, audit, "aou")
    roles = [w or "aou"[i] for i, e, w in steps if e != "D"]
    assert re.fullmatch("(s?(ua)+)?", "".join(r[0] for r in roles)) and cost == _brute("aou")[0]


def test_agenda_stops_at_the_goal():
    popped = []

    def back(item):
        popped.append(item)
        if item[0]:
            yield (item[0] - 1, 0), 1, "x"
            yield (item[0] - 1, 1), 100, "y"
    final = cr.lightest({(50, 0): 0}, back, {(0, 0)})
    assert final[0, 0][0] == 50 and len(popped) <= 51 and (0, 1) not in final


ROWS = [
    (1, 0, "system", "Be brief."), (1, 1, "user", "Hi."), (1, 2, "assistant", "Yes?"),
    (1, 2, "assistant", "Yes?"), (1, 5, "user", "cut off"), (1, 6, "assistant", " \n"),
    (2, None, "assistant", "First."), (2, None, None, None), (2, 3, "user", "Why?"),
    (3, 4, "tool", "x" * 300_000 + "."), (3, 9, "user", "ok!\n\n"),
    (None, 1, "user", "No id."), (None, 2, "assistant", "None."),
    *[(4, 7, "user", "Again.")] * 40, *[(4, t, "user", "Again.") for t in range(8, 30)],
    (4, 40, "assistant", "Stop."), (5, 0, "", ""), (6, 0, "Ab", "Yes.")]


def _model(rows):
    """Summary and repaired lines of one conversation, plainly; by the fragments' own search."""
    rows = sorted(((t, r if r is not None else " ", x if x is not None else " ") for _, t, r, x in rows),
                  key=lambda r: (r[0] is not None, r[0] or 0, r[1],
                                 hashlib.sha256(r[2].encode()).digest()))
    seen, kinds = set(), ""
    for _, role, text in rows:
        last = text.rstrip(" \t\n\x0b\x0c\r")[-1:]
        k = role[:1] if role[:1] in ("s", "u", "a") else "o"
        kinds += "b" if not last else "d" if (role, text) in seen else k if last in ".!?" else k.upper()
        seen.add((role, text))
    cost, audit = _solve(kinds, 1000)
    lines = [f"{w or rows[i][1]}:{'' if i is None else rows[i][2]}"
             for i, e, w in cr.walk(cr.START, audit, kinds) if e != "D"]
    turns = [t for t, *_ in rows if t is not None]
    first = [r[1][:1] for r in rows]
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, kinds.count("b"),
            kinds.count("d"), sum(k.isupper() for k in kinds),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(first, first[1:], strict=False)),
            cost, audit), lines


@pytest.mark.parametrize("block", [2, 1024])
def test_tables(spark, monkeypatch, block):
    monkeypatch.setattr(cr, "BLOCK", block)
    df = spark.createDataFrame(ROWS, "conv_id long, turn int, role string, text string") \
        .selectExpr("*", "1 as ord", "text as digest", "2 as copies").repartition(5)
    got = cr.repair(df)
    summary = {r["conv_id"]: tuple(r)[1:] for r in got.summary.collect()}
    lines = {}
    for r in sorted(got.edits.collect(), key=lambda r: (r["at"], r["place"])):
        lines.setdefault(r["conv_id"], [])
        if r["edit"] != "D":
            lines[r["conv_id"]].append(f"{r['role']}:{r['text']}")
    for conv in {r[0] for r in ROWS}:
        want, said = _model([r for r in ROWS if r[0] == conv])
        assert (summary[conv], lines[conv]) == (want, said), conv
    assert summary[4][6].count("D") == 61 and summary[None][5] == 0
    empty = cr.repair(df.limit(0))
    assert empty.summary.count() == 0 and empty.edits.count() == 0


def test_query_damage(spark, tmp_path):
    rng = random.Random(1)
    rows = [(c, t, rng.choice(["user", "assistant"]), f"Text {rng.randint(0, 5)}.")
            for c in range(60) for t in range(rng.randint(1, 6))] + [(None, None, None, None)]
    rows += [(c, 0, "user", "Alone.") for c in range(100, 200)]       # some are dropped whole
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string") \
        .write.parquet(str(tmp_path / "conversations.parquet"))
    got = {r["conv_id"]: r for r in queries.op12_conversation_repair(spark, str(tmp_path)).collect()}
    assert set(got) == {r[0] for r in rows}
    for conv in got:
        left = []
        for c, t, role, text in rows:
            if c != conv:
                continue
            role, text = role or " ", text or " "
            f = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
            text = "" if f == 1 else re.sub("[.!?]", "", text) if f == 2 else text
            left += [(c, t, "user" if f == 4 else role, text)] * (0 if f == 0 else 2 if f == 3 else 1)
        want, lines = _model(left) if left else ((0,) * 6 + ("",), [])
        assert tuple(got[conv])[1:8] == want
        assert got[conv]["repaired_sha256"] == hashlib.sha256("\n".join(lines).encode()).hexdigest()
    assert any(len(r["audit"]) == 0 for r in got.values())
