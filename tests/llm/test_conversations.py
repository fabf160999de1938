import random
import zlib
from hashlib import md5, sha256

import pytest

from fulltime.llm import conversations as C
from fulltime.llm.queries import op12_conversations
from tests.llm import helpers as H

ROWS = "conv_id long, turn long, role string, text string, dropped boolean"
BLANK = " \t\n\x0b\x0c\r"


def best(cells):
    """Least (cost, audit) by all paths: every cost and audit to each state, row by row."""
    inserts = [{1: None, 2: "u"}, {2: "u"}, {3: "a"}, {2: "u"}]

    def closed(at):
        for _ in range(4):  # more inserts in a row never pay
            for q in range(4):
                for to, name in inserts[q].items():
                    if at[q] and name:
                        way = at[q][0] + 5, at[q][1] + "I"
                        at[to] = min(at[to] or way, way)
        return at

    at = closed([(0, ""), None, None, None])
    for initial, fault in cells:
        new = [(w[0] + 2, w[1] + "D") if w else None for w in at]
        if fault in (C.CLEAN, C.CUT):
            more = 5 if fault == C.CUT else 0
            for q in range(4):
                for name, to in (("s", 1), ("u", 2)) if q == 0 else (("a", 3),) if q == 2 else (("u", 2),):
                    if at[q] and (name == initial or name != "s"):
                        way = at[q][0] + more + (name != initial), at[q][1] + ("K" if name == initial else "R")
                        new[to] = min(new[to] or way, way)
        at = closed(new)
    return min(w for w in (at[0], at[3]) if w)


def brute(rows):
    """Results by conversation of (conv_id, turn, role, text, dropped)."""
    out = {}
    for conv in {r[0] for r in rows}:
        held = sorted([(t is not None, t or 0, " " if r is None else r, " " if x is None else x) for c, t, r, x, d in rows if c == conv and not d],
                      key=lambda r: (*r[:3], own(r[2], r[3])))
        seen, cells, counts = set(), [], [0, 0, 0, 0]
        for _, _, role, text in held:
            solid = text.strip(BLANK)
            fault = 1 if not solid else 2 if (role, text) in seen else 3 if solid[-1] not in ".!?" else 0
            seen.add((role, text))
            counts[fault] += 1
            cells.append((role[:1], fault))
        turns = [t for known, t, _, _ in held if known]
        cost, audit = best(cells)
        lines, k, now = [], 0, ""
        for e in audit:
            if e in "IR":
                now = "assistant" if now[:1] == "u" else "user"
                lines.append((now, "" if e == "I" else held[k][3]))
            elif e == "K":
                now = held[k][2]
                lines.append((now, held[k][3]))
            k += e != "I"
        roles = "".join(r[:1] for r, _ in lines)
        assert roles.removeprefix("s") == "ua" * (len(roles) // 2) and (roles != "s")
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *counts[1:],
                     sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(cells, cells[1:])), cost, audit,
                     sha256("\n".join(f"{r}:{t}" for r, t in lines).encode()).hexdigest())
    return out


def own(role, text):
    return md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()


def result(df):
    return {r["conv_id"]: tuple(r)[1:] for r in df.collect()}


def test_cheapest_equals_all_paths():
    r = random.Random(5)
    for k in range(3000):
        cells = [(r.choice("suauaua x"), r.choice([0, 0, 0, 0, 1, 2, 3])) for _ in range(r.randrange(9))]
        assert C.Lattice(cells).cheapest() == best(cells), cells


def test_parts_joined_equal_the_whole():
    r = random.Random(6)
    for k in range(60):
        cells = [(r.choice("suauaua"), r.choice([0, 0, 0, 1, 3])) for _ in range(r.randrange(1, 14))]
        cut = r.randrange(len(cells) + 1)
        assert C.joined(C.Lattice(cells[:cut]).ways(), C.Lattice(cells[cut:]).ways()) == C.Lattice(cells).ways()


def rows_of(seed, convs, most):
    r = random.Random(seed)
    rows = []
    for c in [None, *range(convs)]:
        for t in range(r.randrange(1, most)):
            turn = r.choice([None, t, t, t, t + r.randrange(3)])
            rows.append((c, turn, r.choice(["user", "assistant", "system", "user", "assistant", None, "", "tool"]),
                         r.choice(["Fine.", "Cut", "", None, " \n", f"Own {r.random()}!", f"Own {r.random()}!", "Own? \n", "x "]), r.random() < 0.1))
    return rows + [(-5, 1, "user", "gone.", True), (-(2**63), 2**63 - 1, "user", "far.", False), (-(2**63), -(2**63), "user", "near.", False)]


@pytest.mark.parametrize("held, most", [(512, 8), (3, 30)])
def test_equal_to_brute_force(spark, monkeypatch, held, most):
    monkeypatch.setattr(C, "HELD", held)
    rows = rows_of(held, 60, most)
    want = brute(rows)
    want[-(2**63)] = (2**63 - 1, *want[-(2**63)][1:])  # as many as a long holds
    assert result(C.repair(H.clashing(spark.createDataFrame(rows, ROWS).repartition(4), "kind", "n", "own"))) == want


def test_one_long_conversation_over_many_ranges(spark):
    rows = [(1, t, "user" if t % 2 == 0 else "assistant", f"Turn {t}{'' if t % 97 == 5 else '.'}" if t % 50 else "Again.", False) for t in range(4000)]
    assert result(C.repair(spark.createDataFrame(rows, ROWS).repartition(8))) == brute(rows)


def test_query_damages_and_keeps_every_conversation(spark, tmp_path):
    rows = [(c, t, "user" if (t or 0) % 2 == 0 else "assistant", f"Text {c} {t}. Why?") for c in [None, *range(120)] for t in [None, *range(3)]]
    rows.append((999_999, next(t for t in range(999) if zlib.crc32(f"999999:{t}".encode()) % 20 == 0), "user", "gone"))
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    after = []
    for c, t, role, text in rows:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        text = "" if kind == 1 else text.translate({ord(x): None for x in ".!?"}) if kind == 2 else text
        after += [(c, t, "user" if kind == 4 else role, text, kind == 0)] * (2 if kind == 3 else 1)
    got = result(op12_conversations(spark, str(tmp_path)))
    assert got == brute(after) and got[999_999][5:] == (0, "", sha256(b"").hexdigest())


def test_no_rows(spark):
    assert C.repair(spark.createDataFrame([], ROWS)).collect() == []
