from __future__ import annotations

import re
from collections import defaultdict

import pytest

from siltstone.llm import rules

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text: str | None) -> dict[str, int]:
    text = text or ""
    words = WORDS.findall(text)
    lines = [x for x in text.split("\n") if WORDS.search(x)]
    places = defaultdict(list)
    for k in range(len(words) - 7):
        places[tuple(words[k : k + 8])].append(k)
    repeated = {p + d for at in places.values() if len(at) > 1 for p in at for d in range(8)}
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(repeated),
        "n_lines": len(lines),
        "n_capitals": sum("A" <= c <= "Z" for c in text),
        "n_stutter": sum(a == b for a, b in zip(words, words[1:], strict=False)),
    }


ODD = [
    (600, "a b\x0bc\x0cd\re f g"),
    (601, "x#|<>&%$*\n\n \nx#|<>&%$*\nx#|<>&%$* "),
    (602, "1 2 3 4 5 6 7 8 9 1 2 3 4 5 6 7 8 9 1 2 3 4 5 6 7 8"),
    (603, "p " * 9),
    (604, "É🙂 ABC é " * 12),
    (605, "one two three four five six seven eight " * 2 + "nine"),
]


def test_measurements(frame, rows):
    every = [*rows, *ODD]
    got = sorted(((r.doc_id, {m: r[m] for m in rules.MEASURES}) for r in rules.measure(frame(every)).collect()), key=repr)
    assert got == sorted(((i, brute(t)) for i, t in every), key=repr)


def test_bits_and_policies(frame, rows):
    every = [*rows, *ODD]
    entries = rules.ledger(rules.measure(frame(every)))
    names = list(rules.RULES)
    for r in rules.apply_policy(entries, "2025-1").collect():
        failed = {n for n in names if eval(rules.RULES[n], {m: r[m] for m in rules.MEASURES})}
        assert r.bits == sum(1 << names.index(n) for n in failed)
        assert r.kept == (not failed & set(rules.POLICIES["2025-1"]))


@pytest.mark.parametrize("policy", sorted(rules.POLICIES))
def test_ablation_counts(frame, rows, policy):
    entries = rules.ledger(rules.measure(frame([*rows, *ODD])))
    bits, names = [r.bits for r in entries.collect()], list(rules.RULES)
    mask = rules.mask(policy)
    for r in rules.ablation(entries, policy).collect():
        bit = 1 << names.index(r.rule)
        assert r.n_failed == sum(bool(b & bit) for b in bits)
        assert r.n_only == sum(b & mask == bit for b in bits)
        assert r.n_kept_without == sum(b & mask & ~bit == 0 for b in bits)


def test_empty_table(no_docs):
    entries = rules.ledger(rules.measure(no_docs))
    assert entries.count() == 0
    assert rules.ablation(entries, "base").count() == 0


def test_stored_ledger_serves_every_policy(frame, rows):
    """Verdicts and ablations come from the written table; the texts are not read again."""
    entries = rules.stored_ledger(frame([*rows, *ODD]))
    plan = rules.decided(entries)._jdf.queryExecution().toString()
    assert all("/ledger-" in f for f in entries.inputFiles())
    assert "regexp" not in plan and "split" not in plan
    names = list(rules.RULES)
    for r in rules.decided(entries).collect():
        failed = {n for n in names if eval(rules.RULES[n], {m: r[m] for m in rules.MEASURES})}
        for policy, rejecting in rules.POLICIES.items():
            assert r[rules.kept_name(policy)] == (not failed & set(rejecting))
    for policy in rules.POLICIES:
        kept = rules.decided(entries).filter(rules.kept_name(policy)).count()
        assert all(r.n_kept_without == kept + r.n_only for r in rules.ablation(entries, policy).collect())
