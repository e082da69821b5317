"""Conversation repair against exhaustive search."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from pairwright.llm import dialogue


def damaged(rows):
    out = {}
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        own = out.setdefault(conv, [])
        if kind == 0:
            continue
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        own += [(turn, role, text)] * (2 if kind == 3 else 1)
    return {c: sorted(own, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])) for c, own in out.items()}


def faults(rows):
    seen, found = set(), []
    for _, role, text in rows:
        marks = re.findall(r"[^\x20\x09-\x0D]", text)
        found.append("blank" if not marks else "duplicate" if (role, text) in seen else "truncated" if marks[-1] not in ".!?" else "")
        seen.add((role, text))
    return found


def searched(rows, found):
    """Every choice of edits and inserts, checked against the pattern as a regular expression."""
    best = None
    for choice in itertools.product(*[["D"] if f in ("blank", "duplicate") else "DKua" for f in found]):
        for inserts in itertools.product(["", "u", "a", "ua", "au"], repeat=len(rows) + 1):
            cost, audit, initials, lines = 0, "", "", []
            for gap in range(len(rows) + 1):
                for x in inserts[gap]:
                    cost, audit, initials = cost + 3, audit + "I", initials + x
                    lines.append({"u": "user:", "a": "assistant:"}[x])
                if gap == len(rows):
                    break
                _, role, text = rows[gap]
                edit = choice[gap]
                cost += {"D": 4, "K": 0}.get(edit, 3) + 3 * (edit != "D" and found[gap] == "truncated")
                audit += edit if edit in "DK" else "R"
                if edit != "D":
                    initials += (role[:1] or "?") if edit == "K" else edit
                    lines.append(f"{role if edit == 'K' else {'u': 'user', 'a': 'assistant'}[edit]}:{text}")
            if (best is None or (cost, audit) < best[:2]) and re.fullmatch("(s?(ua)+)?", initials):
                best = cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return best


def expected(rows):
    out = {}
    for conv, own in damaged(rows).items():
        found = faults(own)
        turns = [t for t, _, _ in own if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        out[conv] = (gaps, *[found.count(f) for f in ("blank", "duplicate", "truncated")], illegal, *searched(own, found))
    return out


SCHEMA = "conv_id long, turn long, role string, text string, fault int"


def results(spark, rows, function=dialogue.repair_damaged):
    table = spark.createDataFrame([(*r, 7) for r in rows], SCHEMA)
    return {r.conv_id: tuple(r)[1:] for r in function(table).collect()}


def test_against_every_edit(spark):
    rnd = random.Random(5)
    roles = ["user", "assistant", "user", "assistant", "system", "tool", None, "", "User"]
    texts = ["Hi.", "Yes!", "cut off", "so \t", None, "", " \n", "é?", "Hi."]
    rows = []
    for conv in range(400):
        n = rnd.choice([1, 2, 2, 3, 3, 3])
        turns = rnd.sample(range(8), n) if conv % 3 else [rnd.choice([None, 1, 2**60]) for _ in range(n)]
        rows += [(conv, t, rnd.choice(roles), rnd.choice(texts)) for t in turns]
    rows += [(None, None, "user", "a."), (None, 3, "assistant", "b."), (2**55 + 1, 1, "user", "a.")]
    assert results(spark, rows) == expected(rows)


def test_no_rows(spark):
    dropped = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    empty = hashlib.sha256(b"").hexdigest()
    assert results(spark, [(dropped, 0, "user", "x.")]) == {dropped: (0, 0, 0, 0, 0, 0, "", empty)}
    assert results(spark, []) == {}


def straight(rows):
    """The same program from the end, over the whole list at once."""
    found = faults(rows)
    go = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
    after = {0: (0, ""), 1: (6, "II"), 2: (3, "I"), 3: (0, "")}
    for (_, role, _), fault in reversed(list(zip(rows, found))):
        late = 3 * (fault == "truncated")
        now = {}
        for s in go:
            ways = [(4 + after[s][0], "D" + after[s][1])]
            if fault not in ("blank", "duplicate"):
                if role[:1] in go[s]:
                    c, a = after[go[s][role[:1]]]
                    ways.append((late + c, "K" + a))
                c, a = after[go[s]["a" if s == 2 else "u"]]
                ways.append((3 + late + c, "R" + a))
            now[s] = min(ways)
        for _ in range(2):
            for s in go:
                c, a = now[go[s]["a" if s == 2 else "u"]]
                now[s] = min(now[s], (3 + c, "I" + a))
        after = now
    return after[0]


def test_long_conversation_spills(spark, monkeypatch):
    """One conversation over many Arrow batches and blocks, with ties between edits all along."""
    rnd = random.Random(8)
    rows = [(0, t, rnd.choice(["user", "assistant", "tool"]), rnd.choice(["x.", "y", f"{t}!", "", "w" * 3000 + "."])) for t in range(3000)]
    own = damaged(rows)[0]
    cost, audit = straight(own)
    lines, state = [], 0
    todo = iter(own)
    go = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
    for letter in audit:
        role, text = next(todo)[1:] if letter != "I" else ("", "")
        if letter == "D":
            continue
        role = role if letter == "K" else "assistant" if state == 2 else "user"
        lines.append(f"{role}:{text}")
        state = go[state][role[:1]]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "170")
    try:
        got = results(spark, rows)[0]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got[5:] == (cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


@pytest.mark.parametrize("limit", [1, 2, 7])
def test_blocks_change_nothing(limit, monkeypatch):
    rnd = random.Random(limit)
    rows = [(t, rnd.choice(["user", "assistant", "system"]), rnd.choice(["a.", "b", f"{t}."])) for t in range(60)]
    kinds = {"": 0, "blank": 1, "duplicate": 2, "truncated": 3}

    def run():
        numbers, known, repair = {}, [], dialogue.Repair()
        for (turn, role, text), fault in zip(rows, faults(rows)):
            repair.add(turn, role, text, kinds[fault], numbers, known)
        return repair.result(known)

    whole = run()
    monkeypatch.setattr(dialogue, "BLOCK_ROWS", limit)
    monkeypatch.setattr(dialogue, "SPOOL_BYTES", 16)
    assert run() == whole and whole[5:7] == straight(rows)
