"""Size classification on one text for each rule or quirk."""

from __future__ import annotations

import pytest

from siftloom.operators.sizes import SIZE_RULES, SizeRule, add_size_columns

N, T, F_ = None, True, False

# size, system, labels, us, eu, count, petite, tall, plus
GOLDEN = [
    ("", "missing", N, N, N, N, F_, F_, F_),
    ("0(Petite XXS)-8/10(Petite L),12(0XL)", "plus", "0XL", "", N, N, T, F_, T),
    ("100 ml", "volume_length", N, N, N, N, F_, F_, F_),
    ("12 inch", "volume_length", N, N, N, N, F_, F_, F_),
    ("12(0XL),14(1XL)", "plus", "0XL, 1XL", "", N, 2, F_, F_, T),
    ("12M,18M", "volume_length", N, N, N, N, F_, F_, F_),
    ("135*200, 160*220", "dimensions", N, N, N, N, F_, F_, F_),
    ("2(XS),4(S)", "us_clothing", "", "", N, 2, F_, F_, F_),
    ("2(xs),4(s)", "us_letter", "xs, s", "2, 4", N, 2, F_, F_, F_),
    ("34B(75B),36C(80C)", "bra", N, N, N, 2, F_, F_, F_),
    ("4,6,8", "us_letter", "", "", N, 3, F_, F_, F_),
    ("4Y", "us_letter", "", "", N, 1, F_, F_, F_),
    ("4Y,5Y", "kids", "4Y, 5Y", N, N, 2, F_, F_, F_),
    ("CN35(US5.5),CN36(US6)", "shoe_intl", N, "5.5, 6", "35, 36", 2, F_, F_, F_),
    ("EUR38(US7),EUR39(US8)", "shoe_intl", N, "7, 8", "38, 39", 2, F_, F_, F_),
    ("EUR38,S,M", "standard", "EUR38,S,M", N, N, 3, F_, F_, F_),
    (None, "missing", N, N, N, N, N, N, N),
    ("Queen", "unknown", N, N, N, 1, F_, F_, F_),
    ("S-XL", "standard", "S-XL", N, N, N, F_, F_, F_),
    ("Tall M,Tall L", "standard", "Tall M,Tall L", N, N, 2, F_, T, F_),
    ("US5,US6.5", "shoe_us", "US5,US6.5", N, N, 2, F_, F_, F_),
    ("W28 L30,W30 L32", "jeans", N, N, N, 2, F_, F_, F_),
    ("XS (2), S (4),M(6),L(8/10)", "us_clothing", "XS, S, M, L", "2, 4, 6, 8/10", N, 4, F_, F_, F_),
    ("XS(34),S(36)", "us_clothing", "XS, S", "34, 36", N, 2, F_, F_, F_),
    ("XS,S,M,L", "standard", "XS,S,M,L", N, N, 4, F_, F_, F_),
    ("one-size", "one_size", N, N, N, 1, F_, F_, F_),
    ("one-size,S", "standard", "one-size,S", N, N, N, F_, F_, F_),
]


@pytest.fixture(scope="module")
def sized(spark):
    df = spark.createDataFrame([(i, g[0]) for i, g in enumerate(GOLDEN)], "i int, size string")
    return {r["i"]: r for r in add_size_columns(df).collect()}


@pytest.mark.parametrize("i", range(len(GOLDEN)))
def test_golden(sized, i):
    r = sized[i]
    got = (r.size_system, r.size_labels, r.size_us, r.size_eu, r.size_count, r.has_petite, r.has_tall, r.has_plus)
    assert got == GOLDEN[i][1:]


def test_single_values(sized):
    by_size = {GOLDEN[i][0]: r for i, r in sized.items()}
    assert (by_size["W28 L30,W30 L32"].waist, by_size["W28 L30,W30 L32"].inseam) == ("28", "30")
    assert by_size["135*200, 160*220"].dimensions_raw == "135*200,160*220"
    assert by_size["XS,S,M,L"].waist is None


def test_rules_can_be_reordered(spark):
    eu_first = (SizeRule("eu_clothing", r"[A-Z]+\(\d{2}\)"), *SIZE_RULES)
    row = add_size_columns(spark.createDataFrame([("XS(34),S(36)",)], "size string"), rules=eu_first).first()
    assert (row.size_system, row.size_labels, row.size_eu) == ("eu_clothing", "XS, S", "34, 36")
