"""The manifest against a plain fold over lists, at block sizes that need several rounds."""

import hashlib
import random
import zlib

import pytest

from tremorlake.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars int, text string, tree int, leaf string"


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    values = (row[0], row[1], row[2], row[3], text)
    return digest(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def levels(nodes):
    found = [nodes]
    while len(found[-1]) > 1:
        found.append([digest(*found[-1][i : i + 3]) for i in range(0, len(found[-1]), 3)])
    return found


def brute(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append(row)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    for some in groups.values():
        some.sort(key=lambda r: (r[0] is not None, r[0], leaf(r, r[4])))
    trees = [levels([leaf(r, r[4]) for r in groups[s]]) for s in order]
    last = levels([t[-1][0] for t in trees])
    root, out = last[-1][0] if order else None, []
    for number, source in enumerate(order):
        for place, row in enumerate(groups[source]):
            text, siblings = row[4], []
            if row[0] is not None and text is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0:
                text = text.replace("\n", "")
            node = leaf(row, text)
            for tree, at in ((trees[number], place), (last, number)):
                for level in tree[:-1]:
                    first = at - at % 3
                    before, after = level[first:at], level[at + 1 : first + 3]
                    siblings += before + after
                    node, at = digest(*before, node, *after), at // 3
            out.append((row[0], leaf(row, row[4]), trees[number][-1][0], root, digest(*siblings), node, node == root))
    return out


def rows_of(sizes, seed=0):
    rng, rows = random.Random(seed), []
    for source, n in sizes.items():
        for _ in range(n):
            text = rng.choice([None, "", "a\nb", "é\n\n", "plain", "x" * 5000 + "\n"])
            rows.append((rng.randint(-5, 10**6), source, rng.choice([None, "en"]), rng.choice([None, 3]), text, 1, "x"))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("depth", [1, 2, 6])
def test_manifest(table, monkeypatch, depth):
    """Sources of one row, of a run, of exact powers of three and of several rounds of blocks."""
    monkeypatch.setattr(merkle, "DEPTH", depth)
    monkeypatch.setattr(merkle, "BLOCK", 3**depth)
    rows = rows_of({None: 4, "": 1, "a": 27, "b": 28, "Z": 9, "é": 2, "hot": 300, **{f"s{n}": 1 for n in range(12)}})
    rows += [(None, "a", None, None, None, 1, "x"), (7, "a", "en", 3, "twin\n", 1, "x"), (7, "a", "en", 3, "twin\n", 1, "x")]
    found = merkle.manifest(table(rows, SCHEMA), tampered=merkle.without_newlines())
    assert found.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    got = [tuple(r) for r in found.collect()]
    assert sorted(got, key=repr) == sorted(brute(rows), key=repr)
    assert {r[-1] for r in got} == {True, False}


def test_one_row_and_none(table):
    rows = [(None, None, None, None, None, 1, "x")]
    (row,) = merkle.manifest(table(rows, SCHEMA)).collect()
    assert row.leaf == row.subroot == row.root == row.folded_root == digest("-----")
    assert row.verified and row.proof_sha256 == digest()
    assert merkle.manifest(table(rows, SCHEMA).limit(0)).count() == 0


def test_a_version_copies_its_path_only():
    leaves = [hashlib.sha256(bytes([n])).digest() for n in range(30)]
    tree = merkle.PathTree(leaves, merkle.levels_in_block(30))
    before = [list(level) for level in tree.levels]
    new = hashlib.sha256(b"new").digest()
    path = merkle.version(new, tree.steps(17))
    changed = merkle.PathTree([*leaves[:17], new, *leaves[18:]], merkle.levels_in_block(30))
    assert tree.levels == before and len(path) == len(tree.levels)
    for level, (old, now) in enumerate(zip(tree.levels, changed.levels)):
        assert [n for n, (a, b) in enumerate(zip(old, now)) if a != b] == [17 // 3**level]
        assert now[17 // 3**level] == path[level]
