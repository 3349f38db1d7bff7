import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from citeloom.operators.multivalue import value_rows

CASES = [
    ("Oral health | \"Health, legislation and rights\"", False, ["Oral health", "Health, legislation and rights"]),
    ('Working paper,"Series ""Health, work and home"""', False, ["Working paper", 'Series "Health, work and home"']),
    ('["Series \\"A, b\\"", "Fact sheet"]', False, ['Series "A, b"', "Fact sheet"]),
    ('Report "in brief";Training material', False, ['Report "in brief"', "Training material"]),
    ("- Sleep\n- Water and sanitation", False, ["Sleep", "Water and sanitation"]),
    ("; A ; ; B //C|| A\r\n", False, ["A", "B", "C", "A"]),
    ('"Audit, internal"', False, ["Audit, internal"]),
    ('a, "", b', False, ["a", "b"]),
    ("", False, []),
    ("  ", False, []),
    ("Zokt, R. L.", True, ["Zokt, R. L."]),
    ("Zokt, Lucia and Dr Ann Bee", True, ["Zokt, Lucia", "Dr Ann Bee"]),
    ("A B, C D, and E. Fyn", True, ["A B", "C D", "E. Fyn"]),
    ("Ministry of Health and Welfare of Xan, Bo Lee", True, ["Ministry of Health and Welfare of Xan", "Bo Lee"]),
    ("- Zokt, R.\n- Bo Lee & Cy Dee", True, ["Zokt, R.", "Bo Lee", "Cy Dee"]),
    ("El Praumandell, Alexander; O'Durg, Amina", True, ["El Praumandell, Alexander", "O'Durg, Amina"]),
    ('Nick Stein, "Nilf, Andrew"', True, ["Nick Stein", "Nilf, Andrew"]),
]


def split(spark, rows):
    df = spark.createDataFrame([(i, t if not n else None, t if n else None, "x") for i, (t, n) in enumerate(rows)], "id long, plain string, names string, item string")
    out = {}
    for r in value_rows(df, "id", {"plain": False, "names": True}).collect():
        out.setdefault(r.id, []).append((r.pos, r.item))
    return [[x for _, x in sorted(out.get(i, []))] for i in range(len(rows))]


def test_cases(spark):
    got = split(spark, [(t, n) for t, n, _ in CASES])
    for (t, n, want), have in zip(CASES, got):
        assert have == want, t


def test_positions_nulls_and_empty_table(spark):
    df = spark.createDataFrame([(1, "a;b;a"), (2, None), (None, "x")], "id long, f string")
    rows = sorted((r.id, r.pos, r.item) for r in value_rows(df, "id", {"f": False}).collect())
    assert rows == [(1, 1, "a"), (1, 2, "b"), (1, 3, "a")]
    assert value_rows(df.limit(0), "id", {"f": False}).count() == 0


@settings(max_examples=15, deadline=None)
@given(st.lists(st.lists(st.text("ab ,;|x", min_size=1).filter(lambda x: x.strip()), min_size=1, max_size=4), min_size=1, max_size=20))
def test_quoted_round_trip(spark, lists):
    """Values quoted and joined come back as they are, whatever delimiters they hold."""
    packed = ["; ".join('"' + v + '"' for v in vs) for vs in lists]
    assert split(spark, [(p, False) for p in packed]) == [[v.strip() for v in vs] for vs in lists]


def test_very_long_field(spark):
    assert len(split(spark, [(";".join(f"v{i}" for i in range(20_000)), False)])[0]) == 20_000
