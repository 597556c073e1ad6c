"""Text, number, date and rule expressions, on the cases where engines disagree."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from etalage import contracts as K
from etalage.functions import dates, numbers, rules, text


def test_strip_removes_every_kind_of_white_space(column):
    assert column(text.strip, ["\t a b \n", " x ", "", None]) == ["a b", "x", "", None]


def test_initcap_starts_a_word_after_any_separator(column):
    got = column(text.initcap_words, ["pointe-noire", "ÉCOLE d'été", "a1b 2c", "ßtadt", None])
    assert got == ["Pointe-Noire", "École D'Été", "A1b 2c", "ßtadt", None]


def test_names(column):
    assert column(text.upper_name, [" élie\t", None, ""]) == ["ÉLIE", "", ""]
    assert column(text.hyphen_capitalize, [" jean - BAPTISTE ", "ANNE", "a--b", None, "ßa"]) == [
        "Jean-Baptiste", "Anne", "A--B", "", "Ssa"]


def test_phone_formats(column):
    got = column(text.normalize_phone, ["06 123 4567 8", "+242061234567", "242 6 123 4567", "0612345", "  12-34 ",
                                        "061234567", None, "+242 6123456", "2420612"])
    assert got == ["06 123 4567 8", "+242 06 123 4567", "+242 06 123 4567", "0612345", "12-34",
                   "+242 06 123 4567", "", "+242 6123456", "2420612"]


def test_phone_validity(column):
    assert column(text.valid_phone, ["+242 06 123 4567", "05-1234-567", "07 123 4567", "0612345678", None, "06123"]) == [
        True, True, False, True, False, False]


def test_email(column):
    got = column(text.standardize_email, [" A.B+c@Mail.CG ", "x@y", "@y.cg", None, "a b@c.cg", "a@b.c1"])
    assert got == ["a.b+c@mail.cg", "", "", "", "", ""]


def test_codes_fall_back_to_their_default(column):
    got = column(lambda c: text.map_codes(c, K.CITY_ALIASES, c), [" BZV ", " Paris ", None])
    assert got == ["Brazzaville", " Paris ", None]
    assert column(lambda c: text.map_codes(c, K.SEX_CODES, "Inconnu"), ["Féminin", "x", None]) == ["F", "Inconnu", "Inconnu"]


def test_rounding_rules(column):
    halves = [0.5, 1.5, 2.5, -0.5, -1.5]
    assert column(numbers.round_half_even, halves, "double") == [0.0, 2.0, 2.0, -0.0, -2.0]
    exact = [Decimal("0.5"), Decimal("2.5"), Decimal("-2.5")]
    got = column(lambda c: numbers.round_half_up(c, 0), exact, "decimal(5,1)")
    assert got == [Decimal(1), Decimal(3), Decimal(-3)]


def test_text_to_numbers(column):
    values = ["12.7", " 5 ", "abc", "12d", "1e2", "NaN", None, "-3.9", "1e30"]
    assert column(numbers.to_int_or_zero, values) == [12, 5, 0, 0, 100, 0, 0, -3, 0]
    assert column(numbers.to_money, ["12.345", "x", None, "1e3"]) == [Decimal("12.35"), None, None, Decimal("1000.00")]


def test_percentages(spark):
    df = spark.createDataFrame([(1, 3), (5, 0), (-1, 8)], "a int, b int")
    got = [r[0] for r in df.select(numbers.percent_of(F.col("a"), F.col("b"))).collect()]
    assert got == [Decimal("33.33"), None, Decimal("-12.50")]


def test_whole_years_count_anniversaries(spark):
    cases = [("2020-02-29", "2023-02-28", 2), ("2020-02-29", "2023-03-01", 3), ("2023-01-01", "2023-12-31", 0),
             ("2025-06-01", "2024-05-31", -1), ("2024-12-01", "2024-06-01", 0)]
    df = spark.createDataFrame([(dt.date.fromisoformat(a), dt.date.fromisoformat(b), n) for a, b, n in cases],
                               "a date, b date, n int")
    assert all(r[0] == r[1] for r in df.select(dates.whole_years(F.col("a"), F.col("b")), "n").collect())


def test_months_and_years(spark):
    df = spark.createDataFrame([(d,) for d in ["2023-12-31", "2024-01-01", "2024-01-31", None]], "d string")
    df = df.select(F.col("d").cast("date").alias("d")).agg(dates.distinct_months(F.col("d")).alias("m"))
    assert df.select(F.size("m"), dates.years_of(F.col("m"))).first() == (2, 2)
    names = spark.range(1).select(dates.month_name(F.lit("2024-08-15").cast("date")).alias("a"),
                                  dates.month_name(F.lit(None).cast("date")).alias("b")).first()
    assert tuple(names) == ("Août", None)


def test_client_rules(spark):
    df = spark.createDataFrame([
        ("C1", "Li", "a@b.cg", "Dolisie", "VIP"),
        (None, "x", None, None, "Or"),
        ("X1", None, "a@b", "Sibiti", "Standard"),
    ], "client_id string, nom string, email string, ville string, categorie string")
    checked = rules.validate_rows(df, rules.client_rules()).orderBy("ville").collect()
    assert {r["ville"]: (r["est_valide"], r["erreurs"]) for r in checked} == {
        "Dolisie": (True, []),
        None: (False, ["client_id manquant ou invalide", "nom manquant ou trop court", "email invalide : None",
                       "ville non reconnue : None", "catégorie invalide : Or"]),
        "Sibiti": (False, ["client_id manquant ou invalide", "nom manquant ou trop court", "email invalide : a@b"]),
    }


def test_transaction_rules(spark):
    df = spark.createDataFrame([
        ("T1", "2024-01-01", 2, Decimal("1000.00"), Decimal("2000.00"), "Espèces"),
        (None, "hier", 2, Decimal("1000.00"), Decimal("1234567.00"), "Troc"),
        ("T3", None, 2, None, Decimal("10.00"), "Virement"),
    ], "transaction_id string, date_transaction string, quantite int, prix_unitaire_xaf decimal(15,2), "
       "montant_total_xaf decimal(15,2), mode_paiement string")
    got = {r["transaction_id"]: r["erreurs"] for r in rules.validate_rows(df, rules.transaction_rules()).collect()}
    assert got == {
        "T1": [],
        None: ["transaction_id manquant", "date invalide : hier",
               "incohérence montant : qté×prix=2,000 ≠ déclaré=1,234,567", "mode de paiement inconnu : Troc"],
        "T3": ["montant hors plage : 10.00 XAF (attendu entre 500 et 5,000,000)",
               "impossible de vérifier la cohérence quantité/prix/montant"],
    }
