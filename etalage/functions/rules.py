"""Row rules: each rule yields a message where the row breaks it, null where it does not."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from etalage import contracts as K
from etalage.functions.text import valid_email


@dataclass(frozen=True)
class Rule:
    """``broken`` is the failing condition (null counts as broken).

    ``message`` may use the row; where it is null, the rule's name stands for it.
    """

    name: str
    broken: Column
    message: Column

    def error(self) -> Column:
        return F.when(F.coalesce(self.broken, F.lit(True)), F.coalesce(self.message, F.lit(self.name)))


def errors(rules: Sequence[Rule]) -> Column:
    """Array of the messages of all broken rules, in rule order."""
    return F.array_compact(F.array(*[rule.error() for rule in rules]))


def any_broken(rules: Sequence[Rule]) -> Column:
    """Whether a row breaks a rule, without putting its messages together."""
    broken = F.lit(False)
    for rule in rules:
        broken = broken | F.coalesce(rule.broken, F.lit(True))
    return broken


def validate_rows(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add ``erreurs`` (messages) and ``est_valide``."""
    return df.withColumn("erreurs", errors(rules)).withColumn("est_valide", F.size("erreurs") == 0)


def shown(c: Column) -> Column:
    """A value inside a message."""
    return F.coalesce(c.cast("string"), F.lit("None"))


def _thousands(c: Column) -> Column:
    return F.format_number(c, 0)


def valid_amount(c: Column, lo: float = K.AMOUNT_MIN, hi: float = K.AMOUNT_MAX) -> Column:
    return F.coalesce(c.between(F.lit(lo), F.lit(hi)), F.lit(False))


def client_rules(cities: Sequence[str] = tuple(K.VALID_CITIES),
                 categories: Sequence[str] = tuple(K.CLIENT_CATEGORIES)) -> list[Rule]:
    email, city, category = F.col("email"), F.col("ville"), F.col("categorie")
    return [
        Rule("client_id", ~F.col("client_id").startswith("C"), F.lit("client_id manquant ou invalide")),
        Rule("nom", F.length("nom") < 2, F.lit("nom manquant ou trop court")),
        Rule("email", ~valid_email(email), F.concat(F.lit("email invalide : "), shown(email))),
        Rule("ville", ~city.isin(*cities), F.concat(F.lit("ville non reconnue : "), shown(city))),
        Rule("categorie", ~category.isin(*categories),
             F.concat(F.lit("catégorie invalide : "), shown(category))),
    ]


def transaction_rules(lo: float = K.AMOUNT_MIN, hi: float = K.AMOUNT_MAX,
                      tolerance: float = K.AMOUNT_TOLERANCE,
                      payment_modes: Sequence[str] = tuple(K.PAYMENT_MODES)) -> list[Rule]:
    total, mode, date = F.col("montant_total_xaf"), F.col("mode_paiement"), F.col("date_transaction")
    expected = F.col("quantite").cast("double") * F.col("prix_unitaire_xaf").cast("double")
    declared = total.cast("double")
    return [
        Rule("transaction_id", F.col("transaction_id").isNull(), F.lit("transaction_id manquant")),
        # a missing date is not an invalid one
        Rule("date_transaction", date.isNotNull() & date.try_cast("timestamp_ntz").isNull(),
             F.concat(F.lit("date invalide : "), shown(date))),
        Rule("montant_total_xaf", ~valid_amount(total, lo, hi),
             F.concat(F.lit("montant hors plage : "), shown(total),
                      F.lit(f" XAF (attendu entre {lo:,} et {hi:,})"))),
        Rule("coherence", F.abs(expected - declared) > tolerance,
             F.coalesce(F.concat(F.lit("incohérence montant : qté×prix="), _thousands(expected),
                                 F.lit(" ≠ déclaré="), _thousands(declared)),
                        F.lit("impossible de vérifier la cohérence quantité/prix/montant"))),
        Rule("mode_paiement", ~mode.isin(*payment_modes),
             F.concat(F.lit("mode de paiement inconnu : "), shown(mode))),
    ]
