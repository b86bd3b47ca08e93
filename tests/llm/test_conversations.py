from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from siltstone.llm import conversations as c

SCHEMA = "conv_id long, turn long, role string, text string"
BLANK = re.compile(r"[^\x20\x09-\x0D]")


def damage(rows):
    """conv_id -> rows after damage in order."""
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        named = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        hit = zlib.crc32(named.encode()) % 20
        out[conv] += []
        if hit == 1:
            text = ""
        if hit == 2:
            text = re.sub("[.!?]", "", text)
        if hit == 4:
            role = "user"
        out[conv] += [(turn, role, text)] * (0 if hit == 0 else 2 if hit == 3 else 1)
    for found in out.values():
        found.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).digest()))
    return out


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        letters = BLANK.findall(text)
        if not letters:
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        elif letters[-1] not in ".!?":
            out.append("truncated")
        else:
            out.append(None)
        seen.add((role, text))
    return out


def cheapest(rows, found):
    """Row by row over (initials so far folded to a state), all edits, least (cost, audit); no grammar, no matrices."""
    state_after = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    best = {"": (0, "", [])}

    def better(table, state, cell):
        if state not in table or cell[:2] < table[state][:2]:
            table[state] = cell
            return True
        return False

    def inserted(table):
        table = dict(table)
        grown = True
        while grown:
            grown = False
            for state, (cost, audit, turns) in list(table.items()):
                for name in ("user", "assistant"):
                    after = state_after.get((state, name[0]))
                    if after:
                        grown |= better(table, after, (cost + 5, audit + "I", [*turns, (name, "")]))
        return table

    for (_, role, text), fault in zip(rows, found, strict=True):
        after: dict = {}
        for state, (cost, audit, turns) in inserted(best).items():
            better(after, state, (cost + 2, audit + "D", turns))
            if fault in ("blank", "duplicate"):
                continue
            more = 5 if fault == "truncated" else 0
            for letter, name, price in (("K", role, 0), ("R", "user", 1), ("R", "assistant", 1)):
                to = state_after.get((state, name[:1]))
                if to:
                    better(after, to, (cost + price + more, audit + letter, [*turns, (name, text)]))
        best = after
    best = inserted(best)
    return min((best[k] for k in ("", "a") if k in best), key=lambda x: x[:2])


def enumerated(rows, found):
    """Every edit sequence of few rows with at most three insertions."""
    whole = []

    def walk(k, initials, cost, audit, left):
        if k == len(rows) and re.fullmatch("(s?(ua)+)?", initials):
            whole.append((cost, audit))
        if left:
            walk(k, initials + "u", cost + 5, audit + "I", left - 1)
            walk(k, initials + "a", cost + 5, audit + "I", left - 1)
        if k < len(rows):
            walk(k + 1, initials, cost + 2, audit + "D", left)
            if found[k] not in ("blank", "duplicate"):
                more = 5 if found[k] else 0
                walk(k + 1, initials + (rows[k][1][:1] or "?"), cost + more, audit + "K", left)
                walk(k + 1, initials + "u", cost + 1 + more, audit + "R", left)
                walk(k + 1, initials + "a", cost + 1 + more, audit + "R", left)

    walk(0, "", 0, "", 3)
    return min(whole)


def brute(rows):
    out = []
    for conv, kept in damage(rows).items():
        found = faults(kept)
        cost, audit, turns = cheapest(kept, found)
        numbered = [t for t, _, _ in kept if t is not None]
        initials = [r[:1] for _, r, _ in kept]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
        gaps = max(numbered) - min(numbered) + 1 - len(set(numbered)) if numbered else 0
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in turns).encode()).hexdigest()
        out.append((conv, gaps, *(found.count(x) for x in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest))
    return sorted(out, key=repr)


COLUMNS = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def result(df):
    return sorted((tuple(r[x] for x in COLUMNS) for r in df.collect()), key=repr)


def dialogues():
    rng = random.Random(11)
    texts = ["Yes.", "No!", "Why?", "cut", "", " \n", "Yes.", "Über alles. ", "so...\t", "a\nb.", ".", "word " * 30]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", "utility", None]
    rows = []
    for conv in range(150):
        turn = rng.randrange(-2, 3)
        for k in range(rng.randrange(1, 12)):
            usual = ("user", "assistant")[k % 2]
            rows.append((conv, turn, usual if rng.random() < 0.7 else rng.choice(roles), rng.choice(texts) if rng.random() < 0.6 else f"Text {k}."))
            turn += rng.choice([1, 1, 1, 0, 2])
    rows += [(None, None, None, None), (None, 3, "user", "Here."), (None, None, "user", "Here."), (200, None, "assistant", "A."), (200, 1, "user", "U."), (200, 1, "user", "U.")]
    rows += [(300, k, ("user", "assistant")[k % 2 if k % 7 else 0], f"{k % 50}" + "." * (k % 3)) for k in range(400)]
    rows += [(301, 5, "user", "Same.")] * 70 + [(301, 6, "assistant", "Long " * 50_000 + ".")]
    dropped = next(k for k in range(1000, 2000) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    rows.append((dropped, 0, "user", "Gone."))
    rng.shuffle(rows)
    return rows


def test_equals_the_plain_walk(frame):
    rows = dialogues()
    assert result(c.repair(c.damaged(frame(rows, SCHEMA)))) == brute(rows)


def test_blocks_and_grammar_change_nothing(frame):
    """Blocks of few symbols, so that conversations are chained, and rules of many levels or none."""
    rows = dialogues()
    want = brute(rows)
    assert result(c.repair(c.damaged(frame(rows, SCHEMA)), block=7, levels=3, pairs=2)) == want
    assert result(c.repair(c.damaged(frame(rows, SCHEMA)), block=3, levels=0)) == want


def test_plain_walk_equals_all_edits():
    rng = random.Random(5)
    for _ in range(150):
        rows = [(k, rng.choice(["user", "assistant", "system", "tool"]), rng.choice(["Yes.", "cut", "", f"N{k}."])) for k in range(rng.randrange(0, 5))]
        found = faults(rows)
        assert cheapest(rows, found)[:2] == enumerated(rows, found)


def test_turns_spell_the_pattern(frame):
    rows = dialogues()
    turns = c.repair(c.damaged(frame(rows, SCHEMA)), turns=True).collect()
    said = defaultdict(list)
    for r in sorted(turns, key=lambda r: (repr(r.conv_id), r.place)):
        said[r.conv_id].append(r)
    want = {r[0]: r for r in brute(rows)}
    for conv, spoken in said.items():
        assert [r.place for r in spoken] == list(range(len(spoken)))
        assert re.fullmatch("(s?(ua)+)?", "".join(r.role[:1] for r in spoken))
        assert [r.edit for r in spoken] == [x for x in want[conv][7] if x != "D"]
        assert hashlib.sha256("\n".join(f"{r.role}:{r.text}" for r in spoken).encode()).hexdigest() == want[conv][8]
    assert {k for k, r in want.items() if r[7].strip("D")} == set(said)


def test_rows_as_they_are(frame):
    """Without damage; copies are optional."""
    rows = [(1, 0, "user", "Hi."), (1, 1, "assistant", "Hello."), (2, 0, "user", "Hi."), (2, 5, "user", "Hi.")]
    found = {r.conv_id: r for r in c.repair(frame(rows, SCHEMA)).collect()}
    assert (found[1].audit, found[1].cost, found[1].gaps) == ("KK", 0, 0)
    assert (found[2].audit, found[2].cost, found[2].gaps, found[2].duplicate, found[2].illegal) == ("DD", 4, 4, 1, 1)


def test_rules_never_overlap():
    pairs = ["ua", "au", "ab", "xx", "xu", "bb", "ba"]
    taken = c._apart(pairs, 10)
    assert taken[0] == "ua"
    for p in taken:
        assert not any(q != p and (p[1] == q[0] or p[0] == q[1]) for q in taken)


def test_ropes_compare_like_strings():
    rng = random.Random(2)
    for _ in range(200):
        parts = ["".join(rng.choices("DK", k=rng.randrange(60))) for _ in range(6)]
        joined = [c.Rope(x) for x in parts]
        a, b = joined[0] + (joined[1] + joined[2]), (joined[0] + joined[1]) + joined[rng.choice([2, 3])]
        assert str(a) == "".join(parts[:3])
        assert (a < b) == (str(a) < str(b))


def test_empty_table(frame):
    assert c.repair(c.damaged(frame([], SCHEMA))).count() == 0
    assert c.repair(c.damaged(frame([], SCHEMA)), turns=True).count() == 0
