"""The retail tables as views of the star schema (lineitem, orders, part, customer, supplier, nation).

Each function reads only the tables that the requested columns need.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from etalage import contracts as K
from etalage.functions.text import lookup
from etalage.sinks.warehouse import DONE, FAILED
from etalage.storage import materialise

AS_OF = "2001-12-31"
AMOUNT_MIN, AMOUNT_MAX = 5_000, 100_000

# How codes of the star schema read in the retail model.
PAYMENTS = {"1": "Espèces", "2": "Mobile Money", "3": "Carte bancaire", "4": "Inconnu", "5": "Virement"}
STATUSES = {"F": "Validé", "O": "En attente", "P": "Annulé"}
CATEGORIES = {"BUILDING": "VIP", "AUTOMOBILE": "Premium"}
CITIES = ["Brazzaville", "Pointe-Noire", "Dolisie", "Ouesso", "Nkayi", "Impfondo", "Sibiti"]

# Columns of the star schema's tables.
SCHEMAS = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}

TX_ORDER = ["date_transaction", "produit_id", "magasin_id", "montant_total_xaf", "quantite"]


class Star:
    """Tables of one scale folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def table(self, name: str) -> DataFrame:
        reader = self.spark.read.schema(SCHEMAS[name]) if name in SCHEMAS else self.spark.read
        return reader.parquet(f"{self.folder}/{name}.parquet")

    def transactions(self, price: bool = True, order: bool = True) -> DataFrame:
        """The fact; ``price`` joins the catalogue, ``order`` joins client, payment and status."""
        # what a row needs once is computed below the joins: the amount, which the price is made of too, and an order's columns
        line = self.table("lineitem").withColumn("montant_total_xaf", F.col("l_extendedprice").cast(K.MONEY))
        if price:
            line = line.join(self.table("part").select("p_partkey", "p_retailprice"),
                             F.col("l_partkey") == F.col("p_partkey"), "left")
        if order:
            head = self.table("orders").select(
                "o_orderkey", F.concat(F.lit("C"), "o_custkey").alias("client_id"),
                lookup(F.left("o_orderpriority", F.lit(1)), PAYMENTS).alias("mode_paiement"),
                lookup(F.col("o_orderstatus"), STATUSES).alias("statut"))
            line = line.join(head, F.col("l_orderkey") == F.col("o_orderkey"), "left")
        columns = {
            "transaction_id": F.concat(F.lit("T"), "l_orderkey", F.lit("-"), "l_linenumber"),
            "date_transaction": F.col("l_shipdate").cast("date"),
            "magasin_id": F.concat(F.lit("M"), "l_suppkey"),
            "produit_id": F.concat(F.lit("P"), "l_partkey"),
            "quantite": F.col("l_quantity").cast("int"),
            "montant_total_xaf": F.col("montant_total_xaf"),
            "canal_vente": F.when(F.col("l_linestatus") == "O", K.ONLINE).otherwise("Magasin"),
        }
        if order:
            columns |= {name: F.col(name) for name in ("client_id", "mode_paiement", "statut")}
        if price:
            own = F.round(F.col("montant_total_xaf") / F.col("l_quantity").cast("decimal(10,0)"), 2)
            listed = F.col("p_retailprice").cast(K.MONEY)
            columns["prix_unitaire_xaf"] = F.when(F.col("l_linenumber") % 5 == 0, listed).otherwise(own.cast(K.MONEY))
        return line.select(*[c.alias(name) for name, c in columns.items()])

    def faulty_transactions(self, tx: DataFrame | None = None) -> DataFrame:
        """The fact, computed or as written, with missing ids, zero quantities and missing amounts among its rows."""
        part, supplier = F.col("produit_id").substr(2, 20).cast("long"), F.col("magasin_id").substr(2, 20).cast("long")
        return (self.transactions() if tx is None else tx).withColumns({
            "transaction_id": F.when(part % 97 == 0, None).when(part % 97 == 1, "").otherwise(F.col("transaction_id")),
            "quantite": F.when(supplier % 41 == 0, 0).otherwise(F.col("quantite")),
            "prix_unitaire_xaf": F.when(part % 89 == 0, None).otherwise(F.col("prix_unitaire_xaf")),
        })

    def _city(self) -> Column:
        cities = F.array(*[F.lit(c) for c in CITIES])
        return F.coalesce(F.get(cities, F.col("n_nationkey") % 8), F.col("n_name"))

    def clients(self) -> DataFrame:
        key = F.col("c_custkey")
        joined = self.table("customer").join(self.table("nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
        return joined.select(
            F.concat(F.lit("C"), key).alias("client_id"),
            F.col("c_name").alias("nom"),
            F.concat(F.lower("c_mktsegment"), F.lit("-"), F.lower("n_name")).alias("prenom"),
            F.concat(F.lower(F.replace("c_name", F.lit("#"), F.lit("."))), F.lit("@mail.cg")).alias("email"),
            F.concat(F.lit("+24206"), F.lpad(key.cast("string"), 7, "0")).alias("telephone"),
            self._city().alias("ville"),
            F.col("n_name").alias("quartier"),
            F.date_add(F.lit("1998-01-01").cast("date"), (key % 1500).cast("int")).alias("date_inscription"),
            F.when(key % 3 == 0, "M").when(key % 3 == 1, "F").otherwise("Inconnu").alias("sexe"),
            F.coalesce(lookup(F.col("c_mktsegment"), CATEGORIES), F.lit("Standard")).alias("categorie"),
        )

    def untidy_clients(self) -> DataFrame:
        """The clients as several agencies would type them, with repeated ids and addresses."""
        key = F.col("c_custkey")
        owner = F.when(key % 10 == 9, key - 1).otherwise(key)
        mailbox = F.when(key % 15 == 14, key - 2).otherwise(key)
        number = F.lpad(key.cast("string"), 7, "0")
        aliases = ["bzv", " Brazza", "POINTENOIRE", "pnr ", "Loubomo", "ouesso", "NKAYI", "Madingou"]
        joined = self.table("customer").join(self.table("nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
        return joined.select(
            F.when(key % 101 == 50, "").otherwise(F.concat(F.lit("C"), owner)).alias("client_id"),
            F.when(key % 53 == 7, None).otherwise(F.concat(F.lit(" "), F.lower("c_name"), F.lit("\t"))).alias("nom"),
            F.concat(F.upper("c_mktsegment"), F.lit(" - "), F.lower("n_name")).alias("prenom"),
            F.when(key % 17 == 3, "sans adresse").when(key % 19 == 4, None)
             .otherwise(F.concat(F.lit(" Client"), mailbox, F.lit("@Mail.CG "))).alias("email"),
            F.when(key % 4 == 0, F.concat(F.lit("06-"), number))
             .when(key % 4 == 1, F.concat(F.lit("+242 6"), number))
             .when(key % 4 == 2, F.concat(F.lit(" 24205"), number))
             .otherwise(F.concat(F.lit("tel "), number)).alias("telephone"),
            F.get(F.array(*[F.lit(a) for a in aliases]), F.col("n_nationkey") % 9).alias("ville"),
            F.col("n_name").alias("quartier"),
            F.date_format(F.date_add(F.lit("1998-01-01").cast("date"), (key % 1500).cast("int")), "yyyy-MM-dd")
             .alias("date_inscription"),
            F.get(F.array(*[F.lit(s) for s in ["Homme", " f", "FÉMININ", "h", "?"]]), key % 6).alias("sexe"),
            F.get(F.array(*[F.lit(c) for c in ["std", "PREM", " vip ", "Very Important", "or"]]), key % 6)
             .alias("categorie"),
            key.alias("rang_arrivee"),
        )

    def crm_clients(self) -> DataFrame:
        """The clients as the customer system delivers them, with countries and addresses of mixed quality."""
        key = F.col("c_custkey")
        countries = F.array(*[F.lit(c) for c in ["cg ", " Congo", "RDC", "cm", "GABON", " Fr", "Atlantide"]])
        joined = self.table("customer").join(self.table("nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
        return joined.select(
            F.when(key % 61 != 5, F.concat(F.lit("C"), key)).alias("id_client"),
            F.concat(F.lit("  "), F.lower("c_name"), F.lit(" ")).alias("nom"),
            F.get(countries, key % 8).alias("code_pays"),
            F.concat(F.lit(" "), F.upper(self._city())).alias("ville"),
            F.when(key % 13 == 2, "sans adresse").when(key % 13 == 3, F.concat(F.lit(" c"), key, F.lit("@mail.cg")))
             .when(key % 13 == 4, F.concat(F.lit("c"), key, F.lit("@mail.cg\n")))
             .when(key % 13 != 5, F.concat(F.lit("Client."), key, F.lit("@Mail.CG"))).alias("email"),
            F.when(key % 29 == 3, "inconnue").otherwise(
                F.date_format(F.date_add(F.lit("1998-01-01").cast("date"), (key % 1500).cast("int")), "yyyy-MM-dd"))
             .alias("date_creation"),
        )

    def journal(self) -> DataFrame:
        """A journal of loads with one row per order: three runs a day, some loads of which fail or take long."""
        key, agency = F.col("o_orderkey"), F.col("o_custkey") % 3
        price = F.floor("o_totalprice").cast("long")
        begin = F.col("o_orderdate") + F.make_dt_interval(hours=F.lit(2), secs=key % 7200)
        return self.table("orders").select(
            F.concat(F.lit("staging.t"), key % 4).alias("table_cible"),
            price.alias("nb_lignes_inserees"), (key % 5).alias("nb_lignes_rejetees"),
            F.when((F.col("o_orderstatus") == "P") & (key % 3 == 0), FAILED).otherwise(DONE).alias("statut"),
            begin.alias("debut_chargement"), (begin + F.make_dt_interval(secs=price % 9000)).alias("fin_chargement"),
            F.when(F.col("o_custkey") % 50 != 0, F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("-"), agency))
             .alias("pipeline_run_id"),
        )

    def products(self) -> DataFrame:
        size = F.col("p_size")
        origin = F.get(F.array(*[F.lit(c) for c in ["Congo", "RDC", "Chine"]]), size % 4)
        return self.table("part").select(
            F.concat(F.lit("P"), "p_partkey").alias("produit_id"),
            F.concat(F.lit(" "), "p_name", F.lit(" ")).alias("nom_produit"),
            F.lower("p_type").alias("categorie"),
            F.concat(F.lower("p_type"), F.lit("/"), "p_brand").alias("sous_categorie"),
            (F.col("p_retailprice").cast(K.MONEY) * size.cast("decimal(4,0)") * F.lit(10).cast("decimal(2,0)"))
            .cast(K.MONEY).alias("prix_unitaire_xaf"),
            size.alias("stock_initial"),
            F.col("p_brand").alias("fournisseur"),
            F.coalesce(origin, F.lit("France")).alias("pays_origine"),
        )

    def stores(self) -> DataFrame:
        key = F.col("s_suppkey")
        joined = self.table("supplier").join(self.table("nation"), F.col("s_nationkey") == F.col("n_nationkey"), "left")
        return joined.select(
            F.concat(F.lit("M"), key).alias("magasin_id"),
            F.col("s_name").alias("nom_magasin"),
            self._city().alias("ville"),
            F.lower("n_name").alias("quartier"),
            F.concat(F.lit("Avenue "), key).alias("adresse"),
            F.concat(F.lit("Responsable "), key).alias("responsable"),
            F.concat(F.lit("+24206"), F.lpad(key.cast("string"), 7, "0")).alias("telephone"),
            (key % 900).cast("int").alias("surface_m2"),
            F.date_add(F.lit("1995-02-28").cast("date"), ((key * 37) % 3000).cast("int")).alias("date_ouverture"),
            F.when(key % 10 == 0, "Fermé").otherwise(K.ACTIVE).alias("statut"),
        )

    def written(self, df: DataFrame, tag: str) -> DataFrame:
        """A dimension as a table of its own: Spark then knows its size and can choose how to join it."""
        return materialise(df, tag)

    def sources(self) -> dict[str, DataFrame]:
        return {"clients": self.clients(), "transactions": self.transactions(),
                "produits": self.products(), "magasins": self.stores()}
