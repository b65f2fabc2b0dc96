"""Divergences against plain sums over all kept terms, at block sizes that cut every group."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tremorlake.llm import divergence

SCHEMA = "doc_id long, text string, lang string, source string, rank int, item string"


def brute(rows, best=200):
    docs = [(r[2] or "", r[3] or "", re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), r[1] or ""))) for r in rows]
    held, counts = defaultdict(Counter), defaultdict(Counter)
    for lang, source, terms in docs:
        held[lang].update(set(terms))
        counts[lang, source].update(terms)
    out = []
    for lang in {d[0] for d in docs}:
        kept = [t for t, n in held[lang].items() if n >= 3]
        groups = {s: c for (x, s), c in counts.items() if x == lang}
        whole = sum(groups.values(), Counter())

        def shares(counter):
            total = sum(counter[t] for t in kept)
            return {t: 1 + 10**9 * (counter[t] + 1) // (total + len(kept)) for t in kept}

        q = shares(whole)
        p = {s: shares(c) for s, c in groups.items()}
        for s in groups:
            pairs = [(x, sum((p[s][t] - p[x][t]) ** 2 // p[x][t] for t in kept)) for x in groups if x != s]
            terms = [(t, (p[s][t] - q[t]) ** 2 // q[t]) for t in kept if groups[s][t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, len(pairs)), ("term", terms, best)):
                ranked = sorted(found, key=lambda f: (-f[1], f[0].encode()))[:most]
                out += [(lang, s, part, item, value, n) for n, (item, value) in enumerate(ranked, 1)]
    return sorted(out)


def made(n, seed=0):
    rng = random.Random(seed)
    words = ["a", "B", "é", "ÉÀ", "don't", "x1y", "日本", "Z" * 40, *[chr(0x61 + k) * 2 for k in range(20)]]
    rows = []
    for i in range(n):
        source = rng.choice([None, "", "hot", "hot", "hot", "s1", "é", "Z"])
        text = " ".join(rng.choice(words) for _ in range(rng.randint(0, 30)))
        rows.append((i, rng.choice([text, text, None, "", "1 2 \x7f ."]), rng.choice([None, "en", "en", "de"]), source, 1, "mine"))
    rows += [(None, "twin twin", "en", "s1", 1, "x")] * 3
    rows += [(n, "rare words", "none", s, 1, "x") for s in ("a", "b")] + [(n, "alone " * 9, "one", "a", 1, "x")]
    return rows


@pytest.mark.parametrize("small", [False, True])
def test_divergences(table, monkeypatch, small):
    if small:
        for name, value in (("POSTINGS", 5), ("PAIRS", 3), ("ROWS", 2), ("HELD", 4)):
            monkeypatch.setattr(divergence, name, value)
    rows = made(150)
    found = divergence.divergences(table(rows, SCHEMA), best=7)
    assert found.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(tuple(r) for r in found.collect()) == brute(rows, 7)


def test_groups_without_terms(table):
    rows = [(1, "a b", "en", "s", 1, "x")] * 3 + [(2, None, "en", "t", 1, "x"), (3, "", "en", "u", 1, "x"), (4, "zz", "de", "s", 1, "x"), (5, "", "de", "t", 1, "x")]
    found = divergence.divergences(table(rows, SCHEMA)).collect()
    assert sorted(tuple(r) for r in found) == brute(rows)
    assert {r.value for r in found if r.lang == "de"} == {0}
    assert divergence.divergences(table(rows, SCHEMA).limit(0)).count() == 0


def test_accumulators_at_the_largest_shares():
    """Shares near a billion against the share of nothing: squares of 60 bits, exactly."""
    rng = random.Random(4)
    term = np.sort(rng.choices(range(6), k=40))
    mine = np.array([rng.randrange(9) for _ in term])
    keep = np.unique(np.stack([term, mine]), axis=1)
    term, mine = keep
    share = np.array([rng.choice([1, 2, 10**9, 999_999_999]) for _ in term])
    base = np.array([1, 1, 7, 10**9, 3, 1, 1, 1, 1])[mine]

    def f(p, q):
        return (int(p) - int(q)) ** 2 // int(q)

    for group, sums in divergence.scattered(term, mine, share, base, 9):
        for peer in range(9):
            exact = sum(
                f(share[i], share[j]) - f(share[i], base[j]) - f(base[i], share[j]) + f(base[i], base[j])
                for i in range(len(term)) for j in range(len(term)) if term[i] == term[j] and mine[i] == group and mine[j] == peer
            )
            assert (int(sums[peer]) - exact) % 2**64 == 0


def test_terms():
    assert divergence.terms_of("Ab1É-ÉTÉ\x7f_日Z".encode()) == [t.encode() for t in ("ab", "É", "ÉtÉ", "日z")]
    assert divergence.terms_of(b"") == divergence.terms_of(b"\x0b\x1c 12") == []
