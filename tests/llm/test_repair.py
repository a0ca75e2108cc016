"""Conversation repair against plain search, and across block borders."""

import hashlib
import random
import re
from itertools import product

import pytest

from sifter.llm import conversation_repair as cr

PATTERN = re.compile(r"(s?(ua)+)?\Z")
COST = {"K": cr.KEEP, "R": cr.REROLE, "D": cr.DELETE, "I": cr.INSERT}


def brute(codes: str) -> tuple[int, str]:
    """Least (cost, audit) over all edit strings up to two insertions a gap."""
    best = None
    gaps = ["", "u", "a", "ua", "au"]
    rows = []
    for c in codes:
        ways = [("D", "")]
        if c != "!":
            ways += [("R", "u"), ("R", "a"), ("K", c.lower())]
        rows.append(ways)
    for edits in product(*rows):
        for ins in product(gaps, repeat=len(codes) + 1):
            roles = "".join(ins[i] + (edits[i][1] if i < len(codes) else "") for i in range(len(codes) + 1))
            if not PATTERN.match(roles):
                continue
            audit = "".join("I" * len(ins[i]) + (edits[i][0] if i < len(codes) else "") for i in range(len(codes) + 1))
            cost = sum(COST[x] for x in audit) + sum(cr.TRUNCATED for c, e in zip(codes, edits) if c.isupper() and e[0] != "D")
            if best is None or (cost, audit) < best:
                best = cost, audit
    return best


def by_rows(codes: str) -> tuple[int, str]:
    """Right to left over the rows, all states at once: no agenda."""
    inf = (10**9, "")
    now = {q: (0, "") if q in cr.ACCEPTED else inf for q in cr.STATES}
    for i in range(len(codes), -1, -1):
        for _ in range(2):
            now = {p: min([now[p]] + [(now[q][0] + cr.INSERT, "I" + now[q][1]) for (r, x), q in cr.STEP.items() if r == p and x in "ua"]) for p in cr.STATES}
        if i == 0:
            return now["-"]
        now = {p: min((now[q][0] + c, letter + now[q][1]) for x, q, c, letter in cr._row_edits(codes[i - 1]) if x == p) for p in cr.STATES}


def test_agenda_equals_plain_search():
    rng = random.Random(3)
    for n in range(4):
        for _ in range(12):
            codes = "".join(rng.choice("suaxSUAX!") for _ in range(n))
            assert cr.repair_rows(codes) == brute(codes), codes
    for _ in range(400):
        codes = "".join(rng.choice("suauauaxSUAX!") for _ in range(rng.randint(0, 40)))
        assert cr.repair_rows(codes) == by_rows(codes), codes


def test_blocks_join_to_the_whole():
    rng = random.Random(4)
    for _ in range(150):
        codes = "".join(rng.choice("suaxSUA!" if rng.random() < 0.5 else "aU") for _ in range(rng.randint(2, 60)))
        size = rng.randint(1, 9)
        blocks = [codes[i:i + size] for i in range(0, len(codes), size)]
        cost, audits = cr.join_spans([cr.span_values(b) for b in blocks])
        assert (cost, "".join(audits)) == cr.repair_rows(codes), (codes, size)
        assert [len(a.replace("I", "")) for a in audits] == [len(b) for b in blocks]


def test_chains_compare_as_strings():
    rng = random.Random(5)

    def chain(pieces):
        out = cr.Chain()
        for p in reversed(pieces):
            out = p + out
        return out

    for _ in range(500):
        x, y = ["".join(rng.choice("DK") for _ in range(rng.randint(0, 6))) for _ in "xy"]
        cx, cy = [chain([s[i:i + k] for i in range(0, len(s), k)]) for s, k in ((x, rng.randint(1, 3)), (y, rng.randint(1, 3)))]
        assert (cx < cy) == (x < y)


def plain(rows):
    """The whole contract for the damaged rows of one conversation, step by step."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    seen, faults = set(), []
    for _, role, text in rows:
        last = text.rstrip("\t\n\x0b\x0c\r ")
        faults.append("!" if not last.strip("\t\n\x0b\x0c\r ") else "!" if (role, text) in seen else "T" if last[-1] not in ".!?" else "")
        seen.add((role, text))
    initials = [r[1][:1] for r in rows]
    codes = "".join("!" if f == "!" else (i if i in ("s", "u", "a") else "x").upper() if f else i if i in ("s", "u", "a") else "x"
                    for i, f in zip(initials, faults))
    cost, audit = by_rows(codes)
    lines, state, at = [], "-", 0
    for letter in audit:
        role, text = (None, "") if letter == "I" else rows[at][1:]
        at += letter != "I"
        if letter == "D":
            continue
        if letter != "K":
            role = "assistant" if state == "u" else "user"
        state = cr.STEP[state, role[0]]
        lines.append(f"{role}:{text}")
    turns = [r[0] for r in rows if r[0] is not None]
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest())


@pytest.mark.parametrize("block", [2, 1024])
def test_rows_of_all_kinds(spark, block):
    rng = random.Random(6)
    made = [(7, t, "user" if t % 2 else "assistant", "same words.") for t in range(40)]
    made += [(None, t, "user", f"x{t}") for t in range(5)] + [(8, None, "tool", "ok."), (8, None, "", "é" * 50_000 + "?"), (8, 2, "system", " \t"), (8, -4, "sys", "a b.\n ")]
    for conv in range(20, 60):
        made += [(conv, rng.choice([None, 1, 2, 3, 4, 9]), rng.choice(["system", "user", "assistant", "tool", "", "A"]), rng.choice(["hi.", "no end", " ", "", "why? "]))
                 for _ in range(rng.randint(1, 9))]
    rows = spark.createDataFrame(made, "conv_id long, turn long, role string, text string")
    report, repaired = cr.repair(rows, block)
    hashes = {r.conv_id: r.repaired_sha256 for r in cr.digest(repaired).collect()}
    got = {r.conv_id: r for r in report.collect()}
    empty = hashlib.sha256(b"").hexdigest()
    by_conv = {}
    for conv, *row in made:
        by_conv.setdefault(conv, []).append(tuple(row))
    assert set(got) == set(by_conv)
    for conv, own in by_conv.items():
        r = got[conv]
        assert (r.gaps or 0, r.illegal, r.cost, r.audit, hashes.get(conv, empty)) == plain(own), conv


def test_registered_query_on_odd_tables(spark, tmp_path):
    rows = [(1, 0, None, None, "x"), (None, None, "user", "hi", "y"), (2, None, "user", "a. b! c?", None)] + [(9, t, "user", f"q{t}?", "") for t in range(60)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, pos string")
    df.write.parquet(str(tmp_path / "conversations.parquet"))
    got = {r.conv_id: r for r in cr.op12_conversation_repair(spark, str(tmp_path)).collect()}
    assert set(got) == {None, 1, 2, 9}
    damaged = {}
    for r in cr.damage(df).collect():
        damaged.setdefault(r.conv_id, []).append((r.turn, r.role, r.text))
    for conv, r in got.items():
        own = damaged.get(conv)
        want = plain(own) if own else (0, 0, 0, "", hashlib.sha256(b"").hexdigest())
        assert (r.gaps, r.illegal, r.cost, r.audit, r.repaired_sha256) == want
    (tmp_path / "none").mkdir()
    df.limit(0).write.parquet(str(tmp_path / "none" / "conversations.parquet"))
    assert cr.op12_conversation_repair(spark, str(tmp_path / "none")).collect() == []
