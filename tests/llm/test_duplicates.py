"""Line dedup, near-dedup, passages and the pipeline against brute force."""

from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest

from tremorlake.llm import bag_minhash, graph, line_dedup, mixing, passages, places
from tremorlake.llm.places import PLACE, with_place
from tremorlake.llm.words import run_digests

DATA = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not Path(DATA).exists(), reason="driver data is absent")


class Sets:
    def __init__(self):
        self.up = {}

    def top(self, x):
        while self.up.setdefault(x, x) != x:
            x = self.up[x]
        return x

    def join(self, x, y):
        self.up[self.top(x)] = self.top(y)


def bag(text):
    words = (text or "").split()
    n = min(5, len(words))
    return Counter(tuple(words[i : i + n]) for i in range(len(words) - n + 1)) if n else Counter()


def document_classes(rows):
    sets, bags = Sets(), [bag(t) for _, t in rows]
    for i, one in enumerate(bags):
        for j in range(i):
            both = sum((one & bags[j]).values())
            if both >= 0.8 * (sum(one.values()) + sum(bags[j].values()) - both):
                sets.join(i, j)
    members = defaultdict(list)
    for i, (key, _) in enumerate(rows):
        members[sets.top(i)].append(key)
    return sorted((key, min(members[sets.top(i)]), len(members[sets.top(i)])) for i, (key, _) in enumerate(rows))


def lines_left(rows):
    lines = [(n, p, x) for n, (_, t) in enumerate(rows) for p, x in enumerate((t or "").split("\n")) if x.strip()]
    sets, unique = Sets(), sorted({x for *_, x in lines})
    sets_of = [line_dedup.shingles(x) for x in unique]
    for i, one in enumerate(sets_of):
        for j in range(i):
            if line_dedup.alike(one, sets_of[j]):
                sets.join(unique[i], unique[j])
    seen, gone = set(), defaultdict(set)
    for n, p, x in lines:
        root = sets.top(x)
        if root in seen:
            gone[n].add(p)
        seen.add(root)
    return [(k, len(gone[n]), None if t is None else "\n".join(x for p, x in enumerate(t.split("\n")) if p not in gone[n])) for n, (k, t) in enumerate(rows)]


def documents(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text")


@needs_data
def test_documents_against_brute_force(spark):
    rows = [tuple(r) for r in documents(spark).collect()]
    assert sorted(tuple(r) for r in bag_minhash.near_duplicates(documents(spark)).collect()) == document_classes(rows)


LINES = [(1, "The quick brown fox jumps over the lazy dog today and tomorrow, again\n\nx\n\nx"), (2, None), (3, ""), (4, "x\nThe quick brown fox jumps over the lazy dog today and tomorrow, again!"), (4, "x\ny")]


def test_lines_against_brute_force(table):
    rows = LINES + [(10 + n, f"line {n % 7} of a text that has some more words in it\nown {n * n}") for n in range(40)]
    found = line_dedup.line_dedup(table([(*r, 5) for r in rows], "doc_id long, text string, place int"))
    got = [(r.doc_id, r.n_removed_lines, r.text) for r in found.collect()]
    key = lambda r: (r[0], r[1], r[2] or "")
    assert sorted(got, key=key) == sorted(lines_left(rows), key=key)
    assert line_dedup.line_dedup(table([], "doc_id long, text string")).count() == 0


def test_document_edges(table):
    long = " ".join(f"w{n}" for n in range(100))
    rows = [(7, long), (3, long + " more"), (None, long), (1, None), (2, " "), (4, "a b"), (4, "a b"), (5, "b a")]
    df = table([(*r, 1) for r in rows], "doc_id long, text string, doc int")
    got = Counter(tuple(r) for r in bag_minhash.near_duplicates(df).collect())
    assert got == Counter({(7, 3, 3): 1, (3, 3, 3): 1, (None, 3, 3): 1, (1, 1, 2): 1, (2, 1, 2): 1, (4, 4, 2): 2, (5, 5, 1): 1})
    kept = bag_minhash.representatives(df)
    assert kept.columns == df.columns and kept.count() == 4
    assert bag_minhash.near_duplicates(df.limit(0)).count() == 0


def test_signatures_are_unbiased():
    rng, off = np.random.default_rng(1), []
    for _ in range(20):
        elements = rng.integers(1, 1 << 62, 30).astype(np.uint64)
        one = rng.integers(0, 20, 30)
        other = np.maximum(0, one + rng.integers(-4, 5, 30))
        docs = np.concatenate([np.zeros((one > 0).sum()), np.ones((other > 0).sum())])
        both = np.concatenate([elements[one > 0], elements[other > 0]])
        first = bag_minhash.signatures(docs, both, np.concatenate([one[one > 0], other[other > 0]]), 2, 2000)
        off.append((first[0] == first[1]).mean() - np.minimum(one, other).sum() / np.maximum(one, other).sum())
    assert abs(np.mean(off)) < 0.008


def test_windows_cover_every_passage():
    rng = np.random.default_rng(0)
    for _ in range(100):
        n, length = int(rng.integers(1, 40)), int(rng.integers(1, 10))
        hashes = rng.integers(1, 30, n).astype(np.uint64)
        cut = passages.anchors(hashes, length)
        for i in range(n):
            for j in range(i + length - 1, n):
                assert any(hashes[c] == hashes[i : j + 1].min() and a <= i and j <= z for c, a, z in cut)


def passages_of(one, other, **sizes):
    digests = lambda words: run_digests(" ".join(map(str, words)), sizes.get("shingle", passages.SHINGLE))
    return passages.common_passages(digests(one), digests(other), **sizes)


@pytest.mark.parametrize("gap", range(1, 13))
@pytest.mark.parametrize("neighbours", [0, 40])
def test_edited_passages_are_found(gap, neighbours):
    rng = np.random.default_rng(gap)
    word = lambda n: rng.integers(0, 10**9, n).tolist()
    n = 9 * gap + 41
    passage, near = word(n), word(neighbours)
    for edited in (passage[: n // 2] + word(gap) + passage[n // 2 :], passage[: n // 2] + word(gap) + passage[n // 2 + gap :]):
        one, other = word(30) + passage + word(70), word(10) + edited + word(90)
        # The neighbouring text is shared, but lies elsewhere in the other document.
        one, other = one[: 30 + n] + near + one[30 + n :], near + word(60) + other
        alike = len({*zip(*(passage[k:] for k in range(5)))} & {*zip(*(edited[k:] for k in range(5)))})
        assert alike >= 0.8 * (len(passage) + len(edited) - 8 - alike)
        for a, b in ((one, other), (other, one)):
            assert any(r[1] >= n // 2 and r[4] >= 0.8 for r in passages_of(a, b))


def test_common_passages_against_all_stretches():
    rng, size, found = np.random.default_rng(11), 8, 0
    for _ in range(150):
        vocabulary = int(rng.choice([3, 30, 10**6]))
        word = lambda n: rng.integers(0, vocabulary, n).tolist()
        passage = word(int(rng.integers(8, 20)))
        edited, at = list(passage), int(rng.integers(0, 8))
        edited[at : at + int(rng.integers(0, 3))] = rng.integers(10**7, 10**8, int(rng.integers(0, 3))).tolist()
        one, other = word(int(rng.integers(2, 6))) + passage + word(3), word(2) + edited + word(int(rng.integers(1, 6)))
        one_of, other_of = ([*zip(x, x[1:], x[2:])] for x in (one, other))
        stretches = [[(i, j, {*x[i : j + 1]}) for i in range(len(x)) for j in range(i + size - 1, len(x))] for x in (one_of, other_of)]
        alike = [(i, j, k, m) for i, j, x in stretches[0] for k, m, y in stretches[1] if len(x & y) >= 0.8 * len(x | y)]
        got = passages_of(one, other, length=size + 2, shingle=3)
        for a, n, b, m, similarity in got:
            x, y = {*one_of[a : a + n - 2]}, {*other_of[b : b + m - 2]}
            assert min(n, m) >= size + 2 and similarity >= 0.8 and abs(len(x & y) / len(x | y) - similarity) < 1e-9
        for i, j, k, m in alike:
            assert any(a <= j and i < a + n - 2 for a, n, *_ in got) and any(b <= m and k < b + n - 2 for _, _, b, n, _ in got)
        found += bool(alike)
    assert found > 30


def test_passage_of_two_that_share_another_with_the_first(table):
    """Three texts share one passage and two of them a second, of which the first text holds every anchor's words."""
    shared, second = ([f"{name}{n}" for n in range(55)] for name in "pq")

    def filled(name):
        return [f"{name}{n}" for n in range(40)]

    b, c = (shared + filled(x) + second + filled(x + "z") for x in "bc")
    keys = lambda words: dict(zip(*(x.tolist() for x in passages.windows([" ".join(words)])[::2])))
    of_b, of_c, first = keys(b), keys(c), shared
    for key, place in of_b.items():
        if key in of_c and place >= 55:
            around = (filled(f"a{place}_{n}_") + b[place : place + 5] + filled(f"e{place}_{n}_") for n in range(1000))
            first = first + next(x for x in around if key in keys(x))
    assert {k for k, place in of_b.items() if k in of_c} <= set(keys(first))
    texts = [" ".join(x) for x in (first, b, c)]
    got = passages.repeated_passages(table([(n, t) for n, t in enumerate(texts)], "doc_id long, text string").coalesce(1)).collect()
    assert {(r.doc_id, r.other_doc_id) for r in got} == {(0, 1), (0, 2), (1, 2)}
    assert any(r.doc_id == 1 and r.first_word <= 95 and r.first_word + r.n_words >= 150 for r in got)


@pytest.mark.parametrize("others", [0, 12])
def test_edited_passage_of_two_whose_anchors_the_others_hold(table, others):
    """Two texts share 50 words but the middle one. The first and the others hold every anchor's words, and nothing else of the passage."""
    def filled(name, n=40):
        return [f"{name}{m}" for m in range(n)]

    keys = lambda words: dict(zip(*(x.tolist() for x in passages.windows([" ".join(words)])[::2])))
    for n in range(1000):
        passage = filled(f"p{n}_", 50)
        b, c = (filled(x) + passage[:25] + [f"{x}-"] + passage[26:] + filled(x + "z") for x in "bc")
        of_b, shared = keys(b), keys(b).keys() & keys(c).keys()
        # No anchor has 24 equal words on one side, but some have 16.
        at = [of_b[key] - 40 for key in shared]
        if at and all(2 <= x <= 18 or 27 <= x <= 44 for x in at) and any(x <= 9 or 11 <= x <= 18 for x in at):
            break
    texts = []
    for name in range(others + 1):
        held = []
        for key in shared:
            place = of_b[key]
            around = (filled(f"a{name}_{place}_{n}_") + b[place : place + 5] + filled(f"e{name}_{place}_{n}_") for n in range(1000))
            held += next(x for x in around if key in keys(x))
        texts.append(" ".join(held))
    assert shared and all(shared <= set(keys(x.split())) for x in texts)
    texts += [" ".join(b), " ".join(c)]
    got = passages.repeated_passages(table([(n, t) for n, t in enumerate(texts)], "doc_id long, text string").coalesce(1)).collect()
    # The words around a place come twice where two anchors are at one place.
    got = [r for r in got if r.doc_id != r.other_doc_id]
    assert {(r.doc_id, r.other_doc_id) for r in got} == {(others + 1, others + 2)}
    assert {(r.first_word <= 64 < r.first_word + r.n_words, r.similarity >= 0.8) for r in got} == {(True, True)}


@pytest.mark.parametrize("distance", [0, 1, 40])
def test_passages_that_come_again_within_a_text(table, distance):
    rng, word = np.random.default_rng(13), lambda n: [f"u{x}" for x in rng.integers(0, 10**9, n)]
    rows = [(0, word(300))]
    for n, edit in enumerate((None, 3, 25, 30, 57), 1):
        again = (passage := word(60)).copy()
        if edit is not None:
            again[edit] = word(1)[0]
        rows.append((n, word(20) + passage + word(distance) + again + word(35)))
    once = word(60)
    rows += [(10, once + word(40)), (11, word(5) + once), (12, 3 * (once + word(9))), (13, 5 * word(12) + word(60))]
    got = passages.repeated_passages(table([(n, " ".join(w)) for n, w in rows], "doc_id long, text string").coalesce(1)).collect()
    assert {(10, 11), (10, 12)} <= {(r.doc_id, r.other_doc_id) for r in got if r.doc_id != r.other_doc_id} <= {(10, 11), (10, 12), (11, 12)}
    own = [r for r in got if r.doc_id == r.other_doc_id]
    assert {r.doc_id for r in own} == {1, 2, 3, 4, 5, 12}
    assert all(r.n_words >= 50 and r.other_n_words >= 50 and r.similarity >= 0.8 and r.first_word + r.n_words <= r.other_first_word for r in own)
    assert [(r.first_word, r.n_words, r.other_first_word) for r in own if r.doc_id == 1] == [(20, 60, 80 + distance)]
    assert {place // 69 for r in own if r.doc_id == 12 for place in (r.first_word, r.other_first_word)} == {0, 1, 2}


def test_every_alike_pair_beside_a_common_line(spark, table):
    """Against brute force: texts that all have a line, some of them with near copies of the words around it."""
    rng, word = np.random.default_rng(12), lambda n: [f"u{x}" for x in rng.integers(0, 10**9, n)]
    line, texts = word(13), []
    for n in range(14):
        before, after = word(24), word(24)
        for copy in range(2 + n % 2):
            passage = before + line + after
            if copy:
                passage[int(rng.choice([*range(14, 24), *range(37, 47)]))] = word(1)[0]
            texts.append(word(30) + passage + word(int(rng.integers(0, 40))))
    digests = [run_digests(" ".join(x), passages.SHINGLE) for x in texts]
    wanted = {(i, j) for j in range(len(texts)) for i in range(j) if passages.common_passages(digests[i], digests[j])}
    got = passages.repeated_passages(table([(n, " ".join(t)) for n, t in enumerate(texts)], "doc_id long, text string").coalesce(1))
    pairs, sets, expected = {(r.doc_id, r.other_doc_id) for r in got.collect()}, Sets(), Sets()
    for x, y in pairs:
        sets.join(x, y)
    for x, y in wanted:
        expected.join(x, y)
    assert pairs <= wanted and len(wanted) > 10
    assert all(sets.top(x) == sets.top(y) for x, y in wanted)


def test_passages(table):
    rng = np.random.default_rng(3)
    word = lambda n: " ".join(f"u{x}" for x in rng.integers(0, 10**9, n))
    shared, common = word(60), word(9)
    rows = [(n, f"{word(30)} {common} {word(40)}") for n in range(20)]
    rows += [(100, f"{word(20)} {shared} {word(70)}"), (101, f"{shared} {word(5)}"), (102, word(80)), (103, word(10)), (104, None)]
    rows += [(105, rows[22][1]), (None, "short")]
    got = passages.repeated_passages(table([(*r, 1) for r in rows], "doc_id long, text string, anchor int")).collect()
    pairs = {frozenset((r.doc_id, r.other_doc_id)) for r in got}
    assert pairs == {frozenset((100, 101)), frozenset((102, 105))}
    row = next(r for r in got if {r.doc_id, r.other_doc_id} == {100, 101})
    spans = {row.doc_id: (row.first_word, row.n_words), row.other_doc_id: (row.other_first_word, row.other_n_words)}
    assert spans == {100: (20, 60), 101: (0, 60)}
    assert passages.repeated_passages(table([], "doc_id long, text string")).count() == 0


def test_anchor_places_are_those_of_the_windows():
    rng = np.random.default_rng(4)
    for _ in range(300):
        n, length = int(rng.integers(1, 80)), int(rng.integers(1, 12))
        hashes = rng.integers(0, int(rng.choice([4, 30, 1000])), n).astype(np.uint64)
        assert passages._anchor_places(hashes, length).tolist() == sorted(c for c, _, _ in passages.anchors(hashes, length) if hashes[c])


def test_sets_of_repeated_lines_are_tried_once():
    seen, tried = [], {7}
    room = lambda x: (seen.extend(x.tolist()), x == 4)[1]
    sets = np.array([5, 7, 5, 8, 9, 8, 9], np.uint64)
    assert list(passages._roomy(room, tried, sets, np.arange(7))) == [4]
    assert seen == [0, 3, 4] and tried == {5, 7, 8}


def test_sketches_show_all_values_in_common():
    rng = np.random.default_rng(7)
    for n in (1, 46, 700, 30_000):
        one, other = rng.integers(0, 2**63, (2, n)).astype(np.uint64)
        one[: n // 2] = other[n - n // 2 :]
        one = np.concatenate((one, one[: n // 3]))
        got, its = (passages._sketched(passages._sketch(x)) for x in (one, other))
        assert got.tolist() == sorted(int(x) >> 46 for x in set(one.tolist()))
        assert passages._common(got, its) >= len(set(one.tolist()) & set(other.tolist()))


def test_fewest_values_of_a_stretch():
    rng = np.random.default_rng(8)
    for vocabulary in (1, 2, 9, 10**6):
        x = rng.integers(0, vocabulary, 60)
        assert passages._least_distinct(x, 8) == min(len(set(x[n : n + 8].tolist())) for n in range(53))


def test_texts_that_share_a_line_only_are_not_copied(spark, table, tmp_path, monkeypatch):
    """What is stored stays below the size of the texts, although every two of them share a key of a common line."""
    rng, words = np.random.default_rng(9), lambda n: " ".join(f"{x:x}" for x in rng.integers(0, 2**60, n))
    line = words(20)
    rows = [(n, f"{words(200)} {line} {words(300)}") for n in range(60)]
    rows += [(60 + n, f"{rows[n][1][:4000]} {words(100)}") for n in range(2)]
    docs = table(rows, "doc_id long, text string").coalesce(2)
    docs.write.parquet(str(tmp_path / "docs"))
    stored, cut = [], passages.cut_lineage

    def kept(df, name="stage"):
        out = cut(df, name)
        stored.extend(Path(f.removeprefix("file:")).stat().st_size for f in out.inputFiles())
        return out

    monkeypatch.setattr(passages, "cut_lineage", kept)
    got = passages.repeated_passages(spark.read.parquet(str(tmp_path / "docs"))).collect()
    assert {frozenset((r.doc_id, r.other_doc_id)) for r in got} == {frozenset((n, 60 + n)) for n in range(2)}
    assert sum(stored) < sum(len(t) for _, t in rows)


def test_many_texts_beside_one_long_text(table, monkeypatch):
    monkeypatch.setattr(passages, "HELD", 3)
    rng, words = np.random.default_rng(10), lambda n: " ".join(f"u{x}" for x in rng.integers(0, 10**9, n))
    shared = [words(60) for _ in range(20)]
    rows = [(0, " ".join(shared))] + [(n + 1, f"{words(9)} {x} {words(30)}") for n, x in enumerate(shared)]
    got = passages.repeated_passages(table(rows, "doc_id long, text string").coalesce(1)).collect()
    spans = {(r.doc_id, r.first_word, r.n_words, r.other_doc_id, r.other_first_word, r.other_n_words) for r in got}
    assert spans == {(0, 60 * n, 60, n + 1, 9, 60) for n in range(20)}


def test_components(spark):
    rng = np.random.default_rng(5)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 60, (40, 2))] + [(100, n) for n in range(101, 140)]
    sets = Sets()
    for a, b in links:
        sets.join(a, b)
    low = {}
    for x in sorted({x for a, b in links if a != b for x in (a, b)}):
        low.setdefault(sets.top(x), x)
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: low[sets.top(x)] for a, b in links if a != b for x in (a, b)}


def in_order(docs, *columns):
    """Rows in the order that the operators give them."""
    return [tuple(r) for r in with_place(docs).orderBy(*PLACE).select(*columns).collect()]


def test_pipeline(spark, tmp_path):
    """Every stage against a plain one on what its predecessor kept, with texts of its own in a few files."""
    import hashlib

    import corpus_pipeline
    import public_tokenizers
    from compare import duck
    from test_native import brute
    from tokenizers import Tokenizer

    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "near_dedup", "mixing", "bpe"]
    sf_dir, columns = str(tmp_path / "sf"), ["doc_id", "text", "lang", "source", "n_chars"]
    if Path(DATA).exists():
        docs = spark.read.parquet(f"{DATA}/documents.parquet").select(*columns)
    else:
        docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    words = "the of and to that a b c d e f g h".split()
    rng = np.random.default_rng(5)
    own = [" ".join(rng.choice(words, 60)) + f"\nthe common line that stands in many texts, and is of use\nnumber {n}" for n in range(30)]
    own += [own[0] + " end", own[1], None, "", "the " + "and to that long word " * 20_000]
    more = spark.createDataFrame([(10**6 + n, t, "en", "own", 1) for n, t in enumerate(own)], "doc_id long, text string, lang string, source string, n_chars long")
    docs.unionByName(more).repartition(5).write.parquet(f"{sf_dir}/documents.parquet")

    before = docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = str(tmp_path / name)
        stage(spark, before, sf_dir).write.parquet(out)
        after = spark.read.parquet(out)
        if name != "bpe":
            assert sorted(after.columns) == sorted(docs.columns)
        rows, kept = in_order(before, "doc_id", "text"), [(r.doc_id, r.text) for r in after.collect()] if name != "bpe" else []
        if name == "quality_rules":
            measures = {k: brute(t) for k, t in rows}
            assert all(measures[k][0] >= 20 and 100 * measures[k][4] <= 30 * measures[k][0] for k, _ in kept)
            assert kept and set(kept) < set(rows)
        elif name == "line_dedup":
            key = lambda r: (r[0], r[1] or "")
            assert sorted(kept, key=key) == sorted([(k, t) for k, _, t in lines_left(rows)], key=key)
        elif name == "near_dedup":
            assert set(kept) <= set(rows) and len(set(kept)) == len(kept)
            class_of = {k: c for k, c, _ in document_classes(rows)}
            assert sorted(class_of[k] for k, _ in kept) == sorted(set(class_of.values()))
        elif name == "mixing":
            con = duck(sf_dir)
            con.execute(f"CREATE VIEW before AS SELECT * FROM '{tmp_path}/near_dedup/*.parquet'")
            assert Counter(kept) == Counter(con.execute(mixing.mixing_sql("before", "doc_id, text")).fetchall())
        else:
            library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
            texts = dict(rows)
            assert Counter(r.doc_id for r in after.collect()) == Counter(k for k, _ in rows)
            for row in after.collect():
                ids = library.encode(texts[row.doc_id] or "", add_special_tokens=False).ids
                assert (row.n_tokens, row.ids_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        before = after
    assert corpus_pipeline.run(spark, sf_dir).count() > 0


def test_pipeline_of_an_empty_table(spark, tmp_path):
    import corpus_pipeline

    empty = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    empty.write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


@pytest.fixture
def shaken(spark, monkeypatch):
    """Files are split in another way after every table that an operator stores, as if cores came and went."""
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.leafNodeDefaultParallelism")
    saved, turn = {k: spark.conf.get(k, None) for k in keys}, [0]

    def shake():
        turn[0] += 1
        for key, value in zip(keys, (("1k", "1", "16"), ("128m", "4m", "1"), ("20k", "1k", "5"))[turn[0] % 3]):
            spark.conf.set(key, value)

    for module in (bag_minhash, graph, line_dedup, passages, places):
        cut = module.cut_lineage
        monkeypatch.setattr(module, "cut_lineage", lambda df, name="stage", cut=cut: (cut(df, name), shake())[0])
    yield shake
    for key, value in saved.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_rows_keep_their_names_when_files_are_split_anew(spark, shaken, tmp_path):
    rng = np.random.default_rng(3)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 10**6, 60)) for _ in range(60)]
    rows = [(n, texts[n % 60] + f"\na line that is the same in some of the texts, number {n % 60}") for n in range(240)]
    path = str(tmp_path / "docs")
    spark.createDataFrame(rows, "doc_id long, text string").repartition(8, "doc_id").write.parquet(path)
    docs = spark.read.parquet(path)
    plain = in_order(docs, "doc_id", "text")
    found = line_dedup.line_dedup(docs)
    shaken()
    assert sorted((r.doc_id, r.n_removed_lines, r.text) for r in found.collect()) == sorted(lines_left(plain))
    found = bag_minhash.near_duplicates(docs)
    shaken()
    assert sorted(tuple(r) for r in found.collect()) == [(n, n % 60, 4) for n in range(240)]
    found = bag_minhash.representatives(docs)
    shaken()
    assert sorted(r.doc_id % 60 for r in found.collect()) == list(range(60))
    found = passages.repeated_passages(docs)
    shaken()
    met = {(r.doc_id, r.other_doc_id) for r in found.collect()}
    assert len(met) == 180 and all(a % 60 == b % 60 and a != b for a, b in met)


@pytest.mark.parametrize("block", [2_000, 7])
def test_no_link_of_a_large_group_is_lost(table, monkeypatch, block):
    monkeypatch.setattr(graph, "BLOCK_NODES", block)
    rng = np.random.default_rng(2)
    bases = rng.integers(0, 10**6, (3, 40))
    texts = {}
    for n in range(80):
        changed = bases[n % 3].copy()
        changed[rng.choice(40, int(rng.integers(0, 9)), replace=False)] = rng.integers(0, 10**6)
        texts[n] = " ".join(map(str, sorted(set(changed.tolist()))))
    rows = [(1, n) for n in range(80)] + [(2, n) for n in range(0, 80, 2)]
    sets = {n: set(t.split()) for n, t in texts.items()}
    alike = lambda a, b: len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])
    wanted, joined = {(a, b) for b in sets for a in range(b) if alike(a, b)}, Sets()
    for a, b in wanted:
        joined.join(a, b)
    seen = []

    def verify(pairs):
        kept = [(r.a, r.b) for r in pairs.collect()]
        seen.extend(kept)
        return table([p for p in kept if p in wanted], "a long, b long")

    members = graph.shared_keys(table(rows, "key long, node long"))
    contents = table(list(texts.items()), "node long, content string")
    elements = lambda t: np.array(t.split(), np.uint64)
    links, roots = graph.linked(members, verify, contents, elements, 0.8)
    found = {(r.a, r.b) for r in links.collect()}
    assert found <= wanted and len(seen) < 80
    low = {}
    for n in sorted({n for pair in wanted for n in pair}):
        low.setdefault(joined.top(n), n)
    assert 1 < len(low) and {r.node: r.root for r in roots.collect()} == {n: low[joined.top(n)] for pair in wanted for n in pair}


def test_elements_of_a_bag_keep_its_similarity():
    rng = np.random.default_rng(4)
    for _ in range(50):
        one, other = (" ".join(map(str, rng.integers(0, 3, int(rng.integers(0, 30))))) for _ in range(2))
        a, b = set(bag_minhash.bag_elements(one).tolist()), set(bag_minhash.bag_elements(other).tolist())
        x, y = bag(one), bag(other)
        assert len(a) == sum(x.values()) and len(a & b) == sum((x & y).values())


def test_shingle_digests_keep_a_lines_shingles():
    for one, other in (("", "a"), ("abcdefgh", "abcdefghi"), ("abababababab", "bababababa"), ("short", "short"), ("naïve \U0001f600 text", "naïve \U0001f600 texts")):
        a, b = set(line_dedup.shingle_digests(one).tolist()), set(line_dedup.shingle_digests(other).tolist())
        x, y = line_dedup.shingles(one), line_dedup.shingles(other)
        assert len(a) == len(x) and len(a & b) == len(x & y)


def test_pairs_of_lines_are_judged_by_their_shingles():
    rng = np.random.default_rng(6)
    bases = ["".join(rng.choice(list("ab é\U0001f600"), int(rng.integers(0, 300)))) for _ in range(60)]
    ones, others = [], []
    for base in bases:
        for _ in range(20):
            at, n = int(rng.integers(0, len(base) + 1)), int(rng.integers(0, 8))
            ones.append(base)
            others.append(base[:at] + "x" * n + base[at + n :])
    ones += ["", "", "abc", "abc", "abcdefgh", "a" * 50]
    others += ["", "\0" * 8, "abc", "abc\0\0\0\0\0", "abcdefg", "a" * 8]
    wanted = [line_dedup.alike(line_dedup.shingles(x), line_dedup.shingles(y)) for x, y in zip(ones, others)]
    assert list(line_dedup.alike_pairs(ones, others)) == wanted and 100 < sum(wanted) < len(wanted) - 100
    # One sum of products would let some of these shingles meet.
    words = " ".join("".join(rng.choice(list("estrnoad"), 6)) for _ in range(20_000))
    assert len(line_dedup.shingle_digests(words)) == len(line_dedup.shingles(words))


def test_a_pair_is_compared_once(table):
    """Groups of two need no more than the comparison with the first; others compare each pair left once."""
    sets = {n: set(range(10 * n, 10 * n + 10)) for n in range(6)}
    sets[5] = sets[4] | {99}
    texts = [(n, " ".join(map(str, sorted(x)))) for n, x in sets.items()]
    rows = [(k, n) for k in (1, 2) for n in (0, 3, 4, 5)] + [(3, 1), (3, 2)]
    seen = []

    def verify(pairs):
        kept = [(r.a, r.b) for r in pairs.collect()]
        seen.extend(kept)
        return table([p for p in kept if p == (4, 5)], "a long, b long")

    def elements(text):
        raise AssertionError("small groups need no block")

    members = graph.shared_keys(table(rows, "key long, node long"))
    links, roots = graph.linked(members, verify, table(texts, "node long, content string"), elements, 0.8)
    assert sorted(seen) == [(0, 3), (0, 4), (0, 5), (1, 2), (3, 4), (3, 5), (4, 5)]
    assert [tuple(r) for r in links.collect()] == [(4, 5)]
    assert {r.node: r.root for r in roots.collect()} == {4: 4, 5: 4}
