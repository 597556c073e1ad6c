"""What keeps the work per row small: facts computed and written once, and as few shuffles as the result needs."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from etalage.operators import aggregates as A, column_tests as CT, joins as J, marts as M, quality as QU, rows as R, transactions as X
from etalage.plans import daily, queries as Q, stages
from etalage.plans.star import AMOUNT_MAX, AMOUNT_MIN, AS_OF, TX_ORDER, Star
from etalage.sinks import files as SF, warehouse as W
from etalage.storage import materialise

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture
def star(spark):
    return Star(spark, SF_DIR)


@pytest.fixture
def written(monkeypatch):
    """Tags of the tables that are written aside."""
    tags = []

    def note(df, tag, *more):
        tags.append(tag)
        return materialise(df, tag, *more)

    for module in (Q, daily):
        monkeypatch.setattr(module, "materialise", note)
    return tags


def joined_orders(monkeypatch) -> list:
    """A list that grows with each time the fact is joined to its orders."""
    calls, plain = [], Star.transactions

    def note(self, price=True, order=True):
        calls.append((price, order))
        return plain(self, price, order)

    monkeypatch.setattr(Star, "transactions", note)
    return calls


def test_loads_aggregates_and_constraints_join_the_fact_once(star, monkeypatch):
    calls = joined_orders(monkeypatch)
    Q._loaded(star)
    assert len(calls) == 1
    del calls[:]
    assert Q.table_constraints(star).count() == len(CT.TABLE_CONSTRAINTS)
    # the sources are declared once more, with columns that are never computed
    assert len(calls) <= 2


def test_loads_aggregate_the_loaded_fact_without_writing_it_again(star, monkeypatch):
    tags, plain = [], Star.written
    monkeypatch.setattr(Star, "written", lambda self, df, tag: tags.append(tag) or plain(self, df, tag))
    Q._loaded(star)
    assert tags == ["stores"]


@pytest.mark.parametrize("twice", [False, True])
def test_loaded_aggregates_equal_those_of_the_enriched_fact(star, spark, monkeypatch, twice):
    if twice:  # a store that stands twice counts its sales twice
        plain, one = Star.stores, F.col("magasin_id") == "M1"
        monkeypatch.setattr(Star, "stores", lambda self: plain(self).unionByName(plain(self).where(one)))
    root = Q._loaded(star)
    enriched = Q.A.all_aggregates(Q.aggregated_fact(star, star.transactions()), star.products())
    for name, expected in enriched.items():
        got = W.read_table(spark, root, f"marts.{name}")
        assert got.dtypes == expected.dtypes
        assert sorted(map(str, got.collect())) == sorted(map(str, expected.collect()))


def test_aggregates_of_a_bare_fact_and_its_stores_equal_those_of_the_enriched_fact(spark):
    lines = [(f"T{i}" if i % 7 else None, dt.date(2024, i % 3 + 1, 5) if i % 11 else None, f"C{i % 4}" if i % 5 else None,
              f"P{i % 6}", f"M{i % 5}" if i % 6 else None, i if i % 8 else None, Decimal(100 + i)) for i in range(90)]
    bare = spark.createDataFrame(lines, "transaction_id string, date_transaction date, client_id string, produit_id string, "
                                        "magasin_id string, quantite int, montant_total_xaf decimal(15,2)")
    # M0 is unknown, M1 has no town, M2 no name
    stores = spark.createDataFrame([("M1", "un", None), ("M2", None, "Ouesso"), ("M3", "trois", "Sibiti"), ("M4", "quatre", "Sibiti")],
                                   "magasin_id string, nom_magasin string, ville string")
    enriched = J.enrich_dimensions(X.time_dimensions(bare), stores=stores)
    for one, other in [(A.monthly_revenue(bare, stores), A.monthly_revenue(enriched)),
                       (A.store_performance(bare, stores=stores), A.store_performance(enriched))]:
        assert one.dtypes == other.dtypes
        assert sorted(map(str, one.collect())) == sorted(map(str, other.collect()))


def test_best_sellers_count_the_rows_of_the_best_alone(spark, monkeypatch):
    lines = [(f"T{i}", f"P{i % 9}", f"M{i % 4}" if i % 3 else None, f"C{i % 5}", 1, Decimal(i % 9), Decimal(i % 9)) for i in range(180)]
    fact = materialise(spark.createDataFrame(lines, "transaction_id string, produit_id string, magasin_id string, client_id string, "
                                             "quantite int, prix_unitaire_xaf decimal(15,2), montant_total_xaf decimal(15,2)"), "fact")
    catalogue = spark.createDataFrame([(f"P{i}", f"nom {i}", "c" if i != 8 else None) for i in range(9)],
                                      "produit_id string, nom_produit string, categorie string")
    counted, plain = [], A.with_distinct_counts
    monkeypatch.setattr(A, "with_distinct_counts", lambda out, df, *more: counted.append(df) or plain(out, df, *more))
    for products in (None, catalogue):
        whole = {r["produit_id"]: r for r in A.product_sales(fact, products, written=True).collect()}
        del counted[:]
        best = A.top_products(fact, 3, products, written=True).collect()
        assert [r["produit_id"] for r in best] == (["P8", "P7", "P6"] if products is None else ["P7", "P6", "P5"])
        assert all(r[c] == whole[r["produit_id"]][c] for r in best for c in whole["P5"].asDict())
        assert max(df.count() for df in counted if "magasin_id" in df.columns and "quantite" not in df.columns) == 60


def test_the_aggregated_fact_holds_the_columns_in_use(star):
    fact = Q.aggregated_fact(star, star.transactions())
    assert set(fact.columns) == set(Q.A.AGGREGATED_COLUMNS) and "jour_semaine" not in fact.columns


def test_staged_tables_are_written_once(star, written):
    """The models write the staged tables; the tests of columns write the marts and nothing else."""
    Q.column_tests(star)
    assert sorted(written) == ["mart_clients", "mart_produits", "mart_ventes"]


def test_a_stage_writes_its_tables_where_they_stay(star, spark, tmp_path, written):
    sources = star.sources() | {"clients": star.untidy_clients(), "transactions": star.faulty_transactions()}
    run = stages.StagedRun(spark, str(tmp_path), "nuit", AS_OF, daily.ArrivalOrder(["rang_arrivee"], TX_ORDER), AMOUNT_MIN, AMOUNT_MAX)
    run.run(sources, [stages.EXTRACT, stages.TRANSFORM, stages.MODELS])
    assert not {"transactions", "clients", "stg_transactions"} & set(written)
    listed = {(r["etape"], r["nom_table"]): r["nb_lignes"] for r in run.summary().collect()}
    for stage in (stages.TRANSFORM, stages.MODELS):
        for name, df in run.tables(stage).items():
            assert listed[stage, name] == df.count()


def test_a_run_reads_each_source_once(star, spark, tmp_path, written):
    sources = star.sources() | {"clients": star.untidy_clients(), "transactions": star.faulty_transactions()}
    daily.run(sources, str(tmp_path), "nuit", AS_OF, daily.ArrivalOrder(["rang_arrivee"], TX_ORDER), AMOUNT_MIN, AMOUNT_MAX)
    assert sorted(t for t in written if t.startswith("source-")) == [f"source-{n}" for n in ("clients", "magasins", "produits", "transactions")]


def test_sales_figures_join_no_counts_and_pass_over_missing_values(spark):
    sales = spark.createDataFrame(
        [(1, "a", "x", "T1", "C1", "P1", 1, Decimal(10), True, "Virement", True),
         (1, "a", "x", "T2", "C1", None, 2, None, False, "Virement", None),
         (1, None, None, "T3", None, "P1", None, None, None, None, None),
         (1, None, None, "T4", "C2", "P2", None, None, True, None, True)],
        "m int, s string, c string, transaction_id string, client_id string, produit_id string, quantite long, "
        "montant_total_xaf decimal(15,2), est_vente_en_ligne boolean, mode_paiement string, est_client_premium boolean")
    out = M._sales_figures(sales, ["m", "s", "c"])
    assert "Join" not in out._jdf.queryExecution().optimizedPlan().toString()
    got = {r["s"]: r.asDict() for r in out.collect()}
    assert (got["a"]["nb_clients_uniques"], got["a"]["nb_produits_vendus"], got["a"]["nb_virement"]) == (1, 1, 2)
    assert (got["a"]["ca_en_ligne_xaf"], got["a"]["ca_magasin_xaf"], got["a"]["ca_clients_premium_xaf"]) == (10, 0, 10)
    assert (got[None]["nb_clients_uniques"], got[None]["nb_produits_vendus"], got[None]["quantite_totale"]) == (1, 2, None)
    assert (got[None]["ca_total_xaf"], got[None]["ca_en_ligne_xaf"]) == (None, 0)


def test_key_difference_combines_keys_before_it_compares_them(spark):
    left = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,)], "k string")
    right = spark.createDataFrame([("a",), ("c",), (None,)], "k string")
    out = R.key_set_difference(left, right, "k")
    assert "Join" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(repr, (r["k"] for r in out.collect()))) == ["'b'", "None"]


@pytest.mark.parametrize("size", [1, 2_500_000])
def test_a_merge_deals_rows_out_once(spark, size):
    """Same rows as the join, whatever the number of parts; rows without a key neither replace nor are replaced."""
    schema = "k string, v int, b int"
    target = spark.createDataFrame([("a", 1, 0), ("a", 2, 0), ("b", 3, 0), (None, 4, 0), ("c", 5, 1)], schema)
    updates = spark.createDataFrame([("a", 10, 0), (None, 11, 0), ("d", 12, 1)], schema)
    out = W.merged(target, updates, ["k"], ["b"], size)
    assert "Join" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert out._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    assert sorted(map(repr, out.collect())) == sorted(map(repr, W.upsert(target, updates, ["k"]).collect()))


def test_a_merge_into_months_is_not_written_twice(spark, tmp_path, monkeypatch):
    path, schema = str(tmp_path / "faits"), "k string, v int, annee int, mois int"
    SF.partitioned_fact(spark.createDataFrame([("a", 1, 2024, 1), ("b", 1, 2024, 2), ("c", 1, 2024, 2)], schema), path)
    counted, plain = [], SF.merged
    monkeypatch.setattr(SF, "merged", lambda *a: counted.append(a[-1]) or plain(*a))
    SF.upsert_partitions(spark.createDataFrame([("b", 2, 2024, 2), ("d", 2, 2024, 3)], schema), path, ["k", "annee", "mois"])
    assert counted == [3]
    got = sorted((r["k"], r["v"], r["mois"]) for r in spark.read.parquet(path).collect())
    assert got == [("a", 1, 1), ("b", 2, 2), ("c", 1, 2), ("d", 2, 3)]


def test_column_tests_take_no_distinct_counts_and_stage_what_is_read(star, monkeypatch):
    counted, staged = [], {}
    monkeypatch.setattr(M, "with_distinct_counts", lambda df, tx, keys, counts: counted.extend(counts) or df)
    models = daily.models
    monkeypatch.setattr(daily, "models", lambda *a, **k: staged.update(models(*a, **k)) or staged)
    assert Q.column_tests(star).count() == len(CT.MODEL_TESTS)
    assert counted == []
    assert "jour_semaine" not in staged["stg_transactions"].columns and "quartier" not in staged["stg_clients"].columns


def test_table_constraints_take_no_distinct_counts_and_write_the_fact_once(star, monkeypatch):
    counted, tags, plain = [], [], Star.written
    monkeypatch.setattr(Q.A, "with_distinct_counts", lambda df, tx, keys, counts: counted.extend(counts) or df)
    monkeypatch.setattr(Star, "written", lambda self, df, tag: tags.append((tag, df.columns)) or plain(self, df, tag))
    assert Q.table_constraints(star).count() == len(CT.TABLE_CONSTRAINTS)
    assert counted == []
    assert [tag for tag, _ in tags] == ["fact", "stores"] and "mode_paiement" not in dict(tags)["fact"]


def test_a_report_of_text_writes_marks_and_equals_that_of_the_table(spark, monkeypatch):
    df = spark.createDataFrame([("a", 1, None), ("a", 1, None), (None, 2, "x"), ("b", None, "y"), ("b", None, "y")],
                               "k string, n int, `a.b` string")
    rules = [QU.Rule("n", QU.F.col("n") != 1, QU.F.lit("n"))]
    whole = [out.collect() for out in QU.quality_report(df, "t", rules)]
    tables, plain = [], QU.materialise
    monkeypatch.setattr(QU, "materialise", lambda df, tag: tables.append(df) or plain(df, tag))
    assert [out.collect() for out in QU.quality_report(df, "t", rules, written=False)] == whole
    assert whole[0][0]["doublons"] == 2 and whole[0][0]["lignes_invalides"] == 3
    assert {f.dataType.simpleString() for f in tables[0].schema} == {"boolean", "bigint"}


def test_integers_and_texts_of_csv_read_as_before(spark):
    from etalage.functions import numbers, text
    from etalage.sources.files import _typed

    values = ["7", " 7 ", "+7", "-0", "7.9", "-7.9", "1e3", "7d", "7 f", "9007199254740993", "99999999999999999999", "trois", "NA",
              "", " ", None, "#N/A N/A", "\tNA", " N/A", "Infinity", " x ", "x y", "\n", "long text of words ", "2147483648"]
    df = spark.createDataFrame([(v,) for v in values], "c string")
    c = QU.F.when(~QU.F.col("c").isin(*QU.K.MISSING_TOKENS), QU.F.col("c"))
    got = df.select(_typed("c", "int").alias("i"), _typed("c", "text").alias("t"), numbers.to_int_or_zero(c).alias("oi"),
                    text.strip(c).alias("ot")).collect()
    assert [(r["i"], r["t"]) for r in got] == [(r["oi"], r["ot"]) for r in got]
