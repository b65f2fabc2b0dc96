"""Quality rules, mixing and pseudonyms: against SQL, brute force and edge cases."""

import re
from collections import Counter
from pathlib import Path

import pytest
from compare import compare, duck

from tremorlake.llm import mixing, pii, quality
from tremorlake.llm.queries import ORACLES, QUERIES

DATA = "/root/testdata/sf0.001"


@pytest.mark.skipif(not Path(DATA).exists(), reason="driver data is absent")
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, name):
    assert compare(QUERIES[name](spark, DATA), duck(DATA), ORACLES[name]) is None


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    runs = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {i + k for i in range(len(words) - 7) for k in range(8) if runs[tuple(words[i : i + 8])] > 1}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


def test_quality_measures(table):
    texts = [None, "", " \t\n", "a", "x " * 40, "one two\none two\n \n", "b\x0bc\x1cd é𝄞 #$", " ".join("abcdefghij") * 30]
    df = table([(i, t, 7) for i, t in enumerate(texts)], "doc_id long, text string, quality int")
    rows = quality.quality_rules(df).orderBy("doc_id").collect()
    for row, text in zip(rows, texts):
        q = row.quality
        assert (q.n_words, q.word_chars, q.n_symbols, q.n_dup_lines, q.n_repeat_words) == brute(text)
        n = q.n_words
        assert q.base_failed == (n < 20 or 100 * q.n_repeat_words > 30 * n)
        assert not (q.base_failed and q.kept)
    assert quality.quality_rules(df.limit(0)).count() == 0


def test_mixing_edges(table):
    rows = [(1, "a", "x" * 10, 1), (1, "a", "x" * 10, 1), (None, None, "y", 2), (3, None, None, 3), (4, "z", "", 4)]
    df = table(rows, "doc_id long, source string, text string, rate int")
    out = mixing.tempered_mix(df)
    assert out.columns == ["doc_id", "source", "text", "rate", "copy", "shuffle_key"]
    assert {r.source for r in out.collect()} <= {"a", None}
    assert mixing.tempered_mix(df.limit(0)).count() == 0


def test_mixing_reaches_its_targets(spark):
    df = spark.range(40_000).selectExpr("id doc_id", "if(id % 10 = 0, 'small', 'large') source", "'abcd' text")
    weights = spark.createDataFrame([("small", 1.0), ("large", 1.0)], "source string, weight double")
    rates = mixing.mixing_rates(mixing.source_sizes(df), weights)
    counts = {r.source: r["count"] for r in mixing.mix_sources(df, rates).groupBy("source").count().collect()}
    assert abs(counts["small"] - 20_000) < 1000 and abs(counts["large"] - 20_000) < 1000


def test_pseudonyms(table):
    text = "bob.42@mail8.example.com 4041894974608795 4041894974608796 +1 (988) 555-2485 10.0.0.1 1.2.3.4.5 2024-02-30 1999-12-31"
    df = table([(1, text, 1), (2, "so " + text, 1), (3, None, 1), (4, "", 1), (5, "clean 2.0 text", 1)], "doc_id long, text string, finds int")
    rows = {r.doc_id: r for r in pii.pseudonymised(df).collect()}
    found = {f.kind: f for f in rows[1].finds}
    assert set(found) == {"email", "card", "phone", "ipv4", "date"}
    for f in rows[1].finds:
        assert f.pseudonym != f.value and f.value not in rows[1].text
        assert re.sub(r"\d", "0", f.pseudonym)[-4:] == re.sub(r"\d", "0", f.value)[-4:] or f.kind == "ipv4"
    assert rows[2].text == "so " + rows[1].text
    for kept in ("4041894974608796", "1.2.3.4.5", "2024-02-30"):
        assert kept in rows[1].text
    digits = [int(d) * (1 + n % 2) for n, d in enumerate(reversed(found["card"].pseudonym))]
    assert sum(d - 9 * (d > 9) for d in digits) % 10 == 0
    assert (rows[3].text, rows[4].text, rows[5].text) == (None, "", "clean 2.0 text")


def test_grid_is_a_permutation(spark):
    moved = spark.range(92 * 397).select(pii.on_grid(pii.F.col("id"), 92, 397, "date", "k").alias("v"))
    assert sorted(r.v for r in moved.collect()) == list(range(92 * 397))


PHONES = """555 123 4567|+1 555 123 4567|5551234567|(555) 123-4567|555.123.4567|+33 1 23 45 67 89|+33 (0)1 23 45 67 89|0033 1 23 45 67 89
+49 30 1234567|+49 (0)30 1234567|+49 (30) 123456|+49 170 1234567|+44 20 7946 0958|+44 (0)20 7946 0958|+34 612 345 678|+15551234567|+33123456789
01 23 45 67 89|01.23.45.67.89|0123456789|030 1234567|030/1234567|0170 123 4567|020 7946 0958|(020) 7946 0958|01701234567|612 345 678|612 34 56 78
+353 1 234 5678|+41 44 668 18 00|1-800-555-1234|+33\u00a01\u00a023\u00a045\u00a067\u00a089|+972-3-1234567|+1-555-123-4567|+1 (555)123-4567""".replace("\n", "|").split("|")
IBANS = "ES9121000418450200051332|DE89370400440532013000|GB29NWBK60161331926819|FR1420041010050500013M02606|NO9386011117947|NL91ABNA0417164300|MT84MALT011000012345MTLCAST001S".split("|")


def spaced(iban):
    return " ".join(iban[n : n + 4] for n in range(0, len(iban), 4))


def test_values_in_many_forms_are_found(table):
    ends = ("", ".", " THE end", " called", ", 2024")
    cases = [(kind, value, end) for kind, values in (("phone", PHONES), ("iban", [*IBANS, *map(spaced, IBANS)])) for value in values for end in ends]
    cases += [("iban", spaced(x), end) for x in IBANS for end in (" 2024", " THE 2024 AB")]
    rows = [(n, f"Tel: {value}{end}") for n, (_, value, end) in enumerate(cases)]
    got = {r.doc_id: r for r in pii.pseudonymised(table(rows, "doc_id long, text string")).collect()}
    missed = [c for n, c in enumerate(cases) if [(f.kind, f.value) for f in got[n].finds] != [c[:2]]]
    assert not missed
    again = {r.doc_id: r for r in pii.pseudonymised(table([(n, r.text) for n, r in got.items()], "doc_id long, text string")).collect()}
    for n, (kind, value, end) in enumerate(cases):
        moved = got[n].finds[0].pseudonym
        assert moved != value and got[n].text == f"Tel: {moved}{end}"
        assert re.sub("[0-9A-Za-z]", "x", moved) == re.sub("[0-9A-Za-z]", "x", value)
        if value[0] == "+":
            assert moved[:2] == value[:2]
        if kind == "iban":
            assert [(f.kind, f.value) for f in again[n].finds] == [(kind, moved)]


def test_other_numbers_are_not_telephone_numbers(table):
    texts = ["1700000000 seconds", "in 2023 2024 2025", "1,234,567,890", "12 345", "v1.22.333", "+5", "a5551234567", "5551234567b", "4041894974608796", "00 12"]
    rows = pii.pseudonymised(table(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.text) for r in rows) == list(enumerate(texts)) and not any(r.finds for r in rows)


def test_telephone_numbers_stay_different(table):
    rows = list(enumerate([f"+49 30 {n:04d}" for n in range(3000)] + [f"{n:03d} 555 1234" for n in range(1000)]))
    out = [r.text for r in pii.pseudonymised(table(rows, "doc_id long, text string")).collect()]
    assert len(set(out)) == len(rows)
