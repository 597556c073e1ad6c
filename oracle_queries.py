"""The registered queries in SQL, written for DuckDB over the same Parquet tables.

Amounts are whole hundredths (``..._c``), so sums, quotients and roundings are exact integer
arithmetic and share nothing with the DataFrame code.
"""

from __future__ import annotations

import re

from etalage import contracts as K

WS = "".join(ch for ch in map(chr, range(0x3001)) if ch.isspace())
AS_OF = "DATE '2001-12-31'"
LO, HI = 500_000, 10_000_000  # 5,000 and 100,000 in hundredths


def money(c: str) -> str:
    return f"CAST({c} AS DOUBLE) / 100"


def half_up(n: str, d: str, digits: int) -> str:
    """n / d rounded half away from zero, for integers and d > 0."""
    scale = 10 ** digits
    return (f"(CASE WHEN {n} < 0 THEN -1.0 ELSE 1.0 END * CAST((2 * abs(CAST({n} AS HUGEINT)) * {scale} + {d})"
            f" // (2 * CAST({d} AS HUGEINT)) AS DOUBLE) / {scale})")


def pct(n: str, d: str) -> str:
    return f"CASE WHEN {d} <> 0 THEN {half_up(f'({n}) * 100', f'({d})', 2)} END"


def half_even(x: str, digits: int = 0) -> str:
    return f"round_even({x}, 0)" if digits == 0 else f"round_even(({x}) * {10 ** digits}, 0) / {10 ** digits}"


def big(c: str) -> str:
    return f"CAST({c} AS BIGINT)"


def strip(c: str) -> str:
    return f"trim({c}, '{WS}')"


def title(c: str) -> str:
    return (rf"array_to_string(list_transform(regexp_extract_all(lower({c}), '[\p{{L}}\p{{N}}]+|[^\p{{L}}\p{{N}}]+'),"
            " lambda w: CASE WHEN w[1] = 'ß' THEN w[1] ELSE upper(w[1]) END || w[2:]), '')")


def case_of(x: str, values: dict[str, str], default: str) -> str:
    """CASE over one of the code lists."""
    arms = " ".join(f"WHEN '{key}' THEN '{value}'" for key, value in values.items())
    return f"CASE {x} {arms} ELSE {default} END"


def coded(c: str, codes: dict[str, str], default: str) -> str:
    return case_of(f"lower({strip(c)})", codes, default)


REGION = case_of("{0}", K.REGION_BY_CITY, "'Autre'")
MONTHS = "[" + ",".join(f"'{m}'" for m in K.MONTH_NAMES) + "][month({0})]"
CITY = "coalesce(['Brazzaville','Pointe-Noire','Dolisie','Ouesso','Nkayi','Impfondo','Sibiti'][n_nationkey % 8 + 1], n_name)"
EMAIL_OK = r"coalesce(regexp_matches({0}, '^[a-zA-Z0-9._%+\-]+@[a-zA-Z0-9.\-]+\.[a-zA-Z]{{2,}}$'), false)"

def std_email(c: str) -> str:
    address = f"lower({strip(c)})"
    return f"CASE WHEN {EMAIL_OK.format(address)} THEN {address} ELSE '' END"


def phone(c: str) -> str:
    digits = rf"regexp_replace({c}, '[^\p{{Nd}}+]', '', 'g')"
    local = (f"CASE WHEN starts_with({digits}, '+242') THEN {digits}[5:] WHEN starts_with({digits}, '242') "
             f"THEN {digits}[4:] WHEN starts_with({digits}, '0') THEN {digits} END")
    return (f"(SELECT coalesce(CASE WHEN length(l) = 9 AND starts_with(l, '0') "
            f"THEN '+242 ' || l[1:2] || ' ' || l[3:5] || ' ' || l[6:] "
            f"WHEN length(l) = 8 THEN '+242 0' || l[1:1] || ' ' || l[2:4] || ' ' || l[5:] END, {strip(c)}, '') "
            f"FROM (SELECT {local} AS l))")


def hyphen(c: str) -> str:
    return (f"coalesce(array_to_string(list_transform(string_split({strip(c)}, '-'), lambda p: "
            f"upper({strip('p')}[1]) || lower({strip('p')}[2:])), '-'), '')")


CTES: dict[str, str] = {}

CTES["tx"] = f"""
SELECT 'T' || l_orderkey || '-' || l_linenumber AS transaction_id, CAST(l_shipdate AS DATE) AS date_transaction,
  'C' || o_custkey AS client_id, 'M' || l_suppkey AS magasin_id, 'P' || l_partkey AS produit_id,
  CAST(l_quantity AS BIGINT) AS quantite, m AS montant_c,
  CASE WHEN l_linenumber % 5 = 0 THEN CAST(round(p_retailprice * 100) AS BIGINT)
       ELSE CAST((2 * m + q) // (2 * q) AS BIGINT) END AS prix_c,
  CASE o_orderpriority[1] WHEN '1' THEN 'Espèces' WHEN '2' THEN 'Mobile Money' WHEN '3' THEN 'Carte bancaire'
       WHEN '4' THEN 'Inconnu' WHEN '5' THEN 'Virement' END AS mode_paiement,
  CASE o_orderstatus WHEN 'F' THEN 'Validé' WHEN 'O' THEN 'En attente' WHEN 'P' THEN 'Annulé' END AS statut,
  CASE WHEN l_linestatus = 'O' THEN 'En ligne' ELSE 'Magasin' END AS canal_vente, l_partkey AS pk, l_suppkey AS sk
FROM (SELECT *, CAST(round(l_extendedprice * 100) AS BIGINT) AS m, CAST(l_quantity AS BIGINT) AS q FROM lineitem)
LEFT JOIN orders ON o_orderkey = l_orderkey LEFT JOIN part ON p_partkey = l_partkey"""

CTES["faulty"] = """
SELECT * REPLACE (CASE pk % 97 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE transaction_id END AS transaction_id,
  CASE WHEN sk % 41 = 0 THEN 0 ELSE quantite END AS quantite,
  CASE WHEN pk % 89 = 0 THEN NULL ELSE prix_c END AS prix_c) FROM tx"""

CTES["clients"] = f"""
SELECT 'C' || c_custkey AS client_id, c_name AS nom, lower(c_mktsegment) || '-' || lower(n_name) AS prenom,
  lower(replace(c_name, '#', '.')) || '@mail.cg' AS email,
  '+24206' || lpad(CAST(c_custkey AS VARCHAR), 7, '0') AS telephone, {CITY} AS ville, n_name AS quartier,
  DATE '1998-01-01' + CAST(c_custkey % 1500 AS INTEGER) AS date_inscription,
  CASE c_custkey % 3 WHEN 0 THEN 'M' WHEN 1 THEN 'F' ELSE 'Inconnu' END AS sexe,
  CASE c_mktsegment WHEN 'BUILDING' THEN 'VIP' WHEN 'AUTOMOBILE' THEN 'Premium' ELSE 'Standard' END AS categorie
FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey"""

CTES["untidy"] = """
SELECT CASE WHEN k % 101 = 50 THEN '' ELSE 'C' || CASE WHEN k % 10 = 9 THEN k - 1 ELSE k END END AS client_id,
  CASE WHEN k % 53 <> 7 THEN ' ' || lower(c_name) || chr(9) END AS nom,
  upper(c_mktsegment) || ' - ' || lower(n_name) AS prenom,
  CASE WHEN k % 17 = 3 THEN 'sans adresse' WHEN k % 19 = 4 THEN NULL
       ELSE ' Client' || CASE WHEN k % 15 = 14 THEN k - 2 ELSE k END || '@Mail.CG ' END AS email,
  CASE k % 4 WHEN 0 THEN '06-' || z WHEN 1 THEN '+242 6' || z WHEN 2 THEN ' 24205' || z ELSE 'tel ' || z END AS telephone,
  ['bzv', ' Brazza', 'POINTENOIRE', 'pnr ', 'Loubomo', 'ouesso', 'NKAYI', 'Madingou'][n_nationkey % 9 + 1] AS ville,
  n_name AS quartier, strftime(DATE '1998-01-01' + CAST(k % 1500 AS INTEGER), '%Y-%m-%d') AS date_inscription,
  ['Homme', ' f', 'FÉMININ', 'h', '?'][k % 6 + 1] AS sexe,
  ['std', 'PREM', ' vip ', 'Very Important', 'or'][k % 6 + 1] AS categorie, k AS rang_arrivee
FROM (SELECT *, c_custkey AS k, lpad(CAST(c_custkey AS VARCHAR), 7, '0') AS z FROM customer)
LEFT JOIN nation ON n_nationkey = c_nationkey"""

CTES["products"] = """
SELECT 'P' || p_partkey AS produit_id, ' ' || p_name || ' ' AS nom_produit, lower(p_type) AS categorie,
  lower(p_type) || '/' || p_brand AS sous_categorie, CAST(round(p_retailprice * 100) AS BIGINT) * p_size * 10 AS prix_c,
  CAST(p_size AS BIGINT) AS stock_initial, p_brand AS fournisseur,
  CASE p_size % 4 WHEN 0 THEN 'Congo' WHEN 1 THEN 'RDC' WHEN 2 THEN 'Chine' ELSE 'France' END AS pays_origine
FROM part"""

CTES["stores"] = f"""
SELECT 'M' || s_suppkey AS magasin_id, s_name AS nom_magasin, {CITY} AS ville, lower(n_name) AS quartier,
  'Avenue ' || s_suppkey AS adresse, 'Responsable ' || s_suppkey AS responsable,
  '+24206' || lpad(CAST(s_suppkey AS VARCHAR), 7, '0') AS telephone, CAST(s_suppkey % 900 AS BIGINT) AS surface_m2,
  DATE '1995-02-28' + CAST((s_suppkey * 37) % 3000 AS INTEGER) AS date_ouverture,
  CASE WHEN s_suppkey % 10 = 0 THEN 'Fermé' ELSE 'Actif' END AS statut
FROM supplier LEFT JOIN nation ON n_nationkey = s_nationkey"""

CTES["active"] = "SELECT * FROM stores WHERE statut = 'Actif'"

CTES["monthly"] = f"""
SELECT strftime(date_transaction, '%Y-%m') AS mois_annee, {big('year(date_transaction)')} AS annee,
  {big('month(date_transaction)')} AS mois, {big('quarter(date_transaction)')} AS trimestre, ville AS ville_magasin,
  magasin_id, count(*) AS n, count(DISTINCT client_id) AS clients, sum(montant_c) AS ca_c, sum(quantite) AS qte,
  min(montant_c) AS lo_c, max(montant_c) AS hi_c,
  {half_even('(CAST(sum(montant_c) AS DOUBLE) / 100) / count(*)')} AS par_tx,
  {half_even('(CAST(sum(montant_c) AS DOUBLE) / 100) / count(DISTINCT client_id)')} AS par_client
FROM tx JOIN stores USING (magasin_id) GROUP BY ALL"""

CTES["sales"] = """
SELECT produit_id, count(*) AS n, sum(quantite) AS qte, sum(montant_c) AS ca_c, count(DISTINCT magasin_id) AS magasins,
  count(DISTINCT client_id) AS clients, sum(prix_c) AS prix_c FROM tx GROUP BY produit_id"""

CTES["activity"] = f"""
SELECT client_id, max(date_transaction) AS derniere, count(*) AS n, sum(montant_c) AS ca_c,
  date_diff('day', max(date_transaction), (SELECT max(date_transaction) FROM tx)) AS recence
FROM tx GROUP BY client_id"""


QUINTS = "[0.2::DOUBLE, 0.4::DOUBLE, 0.6000000000000001::DOUBLE, 0.8::DOUBLE]"

CTES["rfm_bins"] = f"""
SELECT a.*, list_sum(list_transform(er, lambda e: CAST(e < recence AS INTEGER))) AS br,
  list_sum(list_transform(ef, lambda e: CAST(e < n AS INTEGER))) AS bf,
  list_sum(list_transform(em, lambda e: CAST(e < ca_c / 100.0::DOUBLE AS INTEGER))) AS bm
FROM activity a, (SELECT quantile_cont(CAST(recence AS DOUBLE), {QUINTS}) AS er,
  quantile_cont(CAST(n AS DOUBLE), {QUINTS}) AS ef, quantile_cont(ca_c / 100.0::DOUBLE, {QUINTS}) AS em FROM activity)"""


def rfm(r: str, f: str, m: str) -> str:
    return f"""
SELECT client_id, strftime(derniere, '%Y-%m-%d') AS derniere_transaction, n AS nb_transactions,
  {money('ca_c')} AS ca_total_xaf, recence AS recence_jours, {half_even(f"({money('ca_c')}) / n")} AS panier_moyen_xaf,
  {big('r')} AS "score_R", {big('f')} AS "score_F", {big('m')} AS "score_M", {big('100 * r + 10 * f + m')} AS "score_RFM",
  CASE WHEN r + f + m >= 12 THEN 'Champions' WHEN r + f + m >= 9 THEN 'Clients fidèles'
       WHEN r <= 2 AND 2 * (r + f + m) >= 15 THEN 'Clients à risque' ELSE 'Clients inactifs' END AS segment_rfm
FROM (SELECT *, {r} AS r, {f} AS f, {m} AS m FROM rfm_bins)"""


CTES["rfm"] = rfm("5 - br", "1 + bf", "1 + bm")

TX_TIES = "produit_id, magasin_id, montant_c, quantite"

CTES["stg_tx"] = f"""
SELECT * FROM tx WHERE montant_c BETWEEN {LO} AND {HI} AND quantite > 0 AND statut <> 'Annulé'
QUALIFY row_number() OVER (PARTITION BY transaction_id ORDER BY date_transaction DESC, {TX_TIES}) = 1"""

CTES["stg_cl"] = f"""
SELECT client_id, upper(nom) AS nom, {title('prenom')} AS prenom, nom || ' ' || {title('prenom')} AS nom_complet,
  lower(email) AS email, telephone, {title('ville')} AS ville, {title('quartier')} AS quartier, upper(sexe) AS sexe,
  CASE upper(sexe) WHEN 'M' THEN 'Masculin' WHEN 'F' THEN 'Féminin' ELSE 'Non renseigné' END AS sexe_libelle,
  {REGION.format('ville')} AS departement, categorie AS categorie_client,
  categorie IN ('Premium', 'VIP') AS est_client_premium, date_inscription FROM clients"""

CTES["crm"] = f"""
SELECT CASE WHEN k % 61 <> 5 THEN 'C' || k END AS id_client, '  ' || lower(c_name) || ' ' AS nom,
  ['cg ', ' Congo', 'RDC', 'cm', 'GABON', ' Fr', 'Atlantide'][k % 8 + 1] AS code_pays, ' ' || upper({CITY}) AS ville,
  CASE k % 13 WHEN 2 THEN 'sans adresse' WHEN 3 THEN ' c' || k || '@mail.cg' WHEN 4 THEN 'c' || k || '@mail.cg' || chr(10)
       WHEN 5 THEN NULL ELSE 'Client.' || k || '@Mail.CG' END AS email,
  CASE WHEN k % 29 = 3 THEN 'inconnue' ELSE strftime(DATE '1998-01-01' + CAST(k % 1500 AS INTEGER), '%Y-%m-%d') END AS date_creation
FROM (SELECT *, c_custkey AS k FROM customer) LEFT JOIN nation ON n_nationkey = c_nationkey"""

CTES["stg_pr"] = f"""
SELECT produit_id, trim(nom_produit) AS nom_produit, {title('trim(categorie)')} AS categorie,
  {title('trim(sous_categorie)')} AS sous_categorie, prix_c, stock_initial, fournisseur, pays_origine,
  pays_origine IN ('Congo', 'Congo-Brazzaville', 'RDC') AS est_produit_local,
  CASE WHEN prix_c >= 30000000 THEN 'Prix élevé' WHEN prix_c >= 5000000 THEN 'Prix moyen'
       WHEN prix_c >= 1000000 THEN 'Prix abordable' ELSE 'Bas prix' END AS segment_prix FROM products"""

CTES["stg_st"] = f"""
SELECT magasin_id, nom_magasin, {title('ville')} AS ville, {title('quartier')} AS quartier, adresse, responsable,
  telephone, surface_m2, date_ouverture, statut,
  CASE WHEN ville IN ('Brazzaville', 'Ouesso') THEN 'Zone Nord' WHEN ville = 'Pointe-Noire' THEN 'Zone Océan'
       WHEN ville = 'Dolisie' THEN 'Zone Sud' ELSE 'Autre zone' END AS zone_commerciale,
  CASE WHEN surface_m2 >= 600 THEN 'Grand' WHEN surface_m2 >= 350 THEN 'Moyen' ELSE 'Petit' END AS taille_magasin,
  date_sub('year', date_ouverture, {AS_OF}) AS anciennete_annees FROM active"""

CTES["star"] = """
SELECT t.* EXCLUDE (client_id, produit_id, magasin_id), c.client_id, p.produit_id, m.magasin_id, c.departement,
  c.est_client_premium, p.categorie AS categorie_produit, p.segment_prix, m.nom_magasin, m.ville AS ville_magasin,
  m.zone_commerciale, m.taille_magasin
FROM stg_tx t LEFT JOIN stg_cl c ON c.client_id = t.client_id LEFT JOIN stg_pr p ON p.produit_id = t.produit_id
LEFT JOIN stg_st m ON m.magasin_id = t.magasin_id"""

CTES["mart_v"] = f"""
SELECT strftime(date_transaction, '%Y-%m') AS mois_annee, {big('year(date_transaction)')} AS annee,
  {big('month(date_transaction)')} AS mois, {big('quarter(date_transaction)')} AS trimestre,
  {MONTHS.format('date_transaction')} AS nom_mois, magasin_id, nom_magasin, ville_magasin, zone_commerciale,
  taille_magasin, categorie_produit, count(DISTINCT transaction_id) AS nb_transactions,
  count(DISTINCT client_id) AS nb_clients_uniques, count(DISTINCT produit_id) AS nb_produits_vendus,
  sum(quantite) AS qte, sum(montant_c) AS ca_c, min(montant_c) AS lo_c, max(montant_c) AS hi_c, count(*) AS n,
  coalesce(sum(montant_c) FILTER (canal_vente = 'En ligne'), 0) AS en_ligne_c,
  coalesce(sum(montant_c) FILTER (canal_vente <> 'En ligne'), 0) AS magasin_c,
  count(*) FILTER (mode_paiement = 'Mobile Money') AS nb_mobile_money, count(*) FILTER (mode_paiement = 'Espèces') AS nb_especes,
  count(*) FILTER (mode_paiement = 'Carte bancaire') AS nb_carte_bancaire, count(*) FILTER (mode_paiement = 'Virement') AS nb_virement,
  coalesce(sum(montant_c) FILTER (est_client_premium), 0) AS premium_c
FROM star GROUP BY ALL"""


def mode(col: str, name: str) -> str:
    return f"""SELECT client_id, {col} AS {name} FROM stg_tx GROUP BY client_id, {col}
  QUALIFY row_number() OVER (PARTITION BY client_id ORDER BY count(*) DESC, {col}) = 1"""


CTES["metrics"] = f"""
SELECT a.*, canal_prefere, mode_paiement_prefere FROM (
  SELECT client_id, count(DISTINCT transaction_id) AS n, sum(montant_c) AS ca_c, max(montant_c) AS hi_c, sum(quantite) AS qte,
    min(date_transaction) AS premiere, max(date_transaction) AS derniere,
    count(DISTINCT date_trunc('month', date_transaction)) AS mois, count(DISTINCT year(date_transaction)) AS annees,
    date_diff('day', max(date_transaction), {AS_OF}) AS recence, count(DISTINCT produit_id) AS produits,
    count(DISTINCT magasin_id) AS magasins FROM stg_tx GROUP BY client_id) a
JOIN ({mode('canal_vente', 'canal_prefere')}) USING (client_id)
JOIN ({mode('mode_paiement', 'mode_paiement_prefere')}) USING (client_id)"""

CTES["tiles"] = """
SELECT *, CASE WHEN r + f + m >= 12 THEN 'Champions' WHEN r + f + m >= 9 THEN 'Clients fidèles'
    WHEN r <= 2 AND f >= 3 THEN 'Clients à risque' WHEN recence > 180 THEN 'Clients inactifs'
    ELSE 'Clients en développement' END AS segment_rfm
FROM (SELECT *, ntile(5) OVER (ORDER BY recence DESC, client_id) AS r, ntile(5) OVER (ORDER BY n, client_id) AS f,
        ntile(5) OVER (ORDER BY ca_c, client_id) AS m FROM metrics)"""

CTES["mart_c"] = f"""
SELECT c.* EXCLUDE (telephone, date_inscription), strftime(date_inscription, '%Y-%m-%d') AS date_inscription,
  coalesce(n, 0) AS nb_achats_total, coalesce({money('ca_c')}, 0) AS ca_total_xaf,
  coalesce({half_up('ca_c', '(100 * n)', 0)}, 0) AS panier_moyen_xaf, coalesce({money('hi_c')}, 0) AS achat_max_xaf,
  {big('coalesce(qte, 0)')} AS quantite_totale_achetee, strftime(premiere, '%Y-%m-%d') AS premiere_transaction,
  strftime(derniere, '%Y-%m-%d') AS derniere_transaction, coalesce(recence, 9999) AS recence_jours,
  coalesce(mois, 0) AS nb_mois_actifs, coalesce({half_up('n', 'mois', 2)}, 0) AS frequence_mensuelle,
  coalesce(produits, 0) AS nb_produits_differents, coalesce(magasins, 0) AS nb_magasins_frequentes, canal_prefere,
  mode_paiement_prefere, coalesce(r, 1) AS score_recence, coalesce(f, 1) AS score_frequence,
  coalesce(m, 1) AS score_montant, coalesce({half_up('(r + f + m)', '3', 2)}, 1) AS score_rfm_moyen,
  coalesce(segment_rfm, 'Jamais acheté') AS segment_rfm, coalesce(recence, 9999) <= 90 AS est_client_actif
FROM stg_cl c LEFT JOIN tiles USING (client_id)"""

CTES["perf"] = """
SELECT produit_id, count(DISTINCT transaction_id) AS n, count(DISTINCT client_id) AS clients,
  count(DISTINCT magasin_id) AS magasins, sum(quantite) AS qte, sum(montant_c) AS ca_c, min(prix_c) AS lo_c,
  max(prix_c) AS hi_c, sum(prix_c) AS prix_c, sum(CASE WHEN canal_vente = 'En ligne' THEN quantite ELSE 0 END) AS en_ligne,
  sum(CASE WHEN canal_vente = 'En ligne' THEN 0 ELSE quantite END) AS magasin, min(date_transaction) AS premiere,
  max(date_transaction) AS derniere, count(DISTINCT date_trunc('month', date_transaction)) AS mois
FROM stg_tx GROUP BY produit_id"""

CTES["ranked"] = f"""
SELECT *, rank() OVER (ORDER BY ca_c DESC) AS rang_ca, rank() OVER (ORDER BY qte DESC) AS rang_volume,
  {pct('ca_c', '(SELECT sum(ca_c) FROM perf)')} AS part FROM perf"""

CTES["mart_p"] = f"""
SELECT p.produit_id, p.nom_produit, p.categorie, p.sous_categorie, {money('p.prix_c')} AS prix_catalogue_xaf, p.stock_initial,
  p.fournisseur, p.pays_origine, p.est_produit_local, p.segment_prix, coalesce(n, 0) AS nb_transactions,
  coalesce(clients, 0) AS nb_clients_uniques, coalesce(magasins, 0) AS nb_magasins_vendeurs,
  {big('coalesce(qte, 0)')} AS quantite_totale_vendue, coalesce({money('ca_c')}, 0) AS ca_total_xaf,
  coalesce({half_up('ca_c', '(100 * n)', 0)}, 0) AS ca_moyen_par_vente_xaf,
  {money('coalesce(lo_c, p.prix_c)')} AS prix_min_observe_xaf, {money('coalesce(hi_c, p.prix_c)')} AS prix_max_observe_xaf,
  {big('coalesce(en_ligne, 0)')} AS qte_vendue_en_ligne, {big('coalesce(magasin, 0)')} AS qte_vendue_magasin,
  {pct('en_ligne', 'qte')} AS taux_vente_en_ligne_pct, coalesce(rang_ca, 999) AS rang_ca,
  coalesce(rang_volume, 999) AS rang_volume, coalesce(part, 0) AS part_ca_pct,
  strftime(premiere, '%Y-%m-%d') AS premiere_vente, strftime(derniere, '%Y-%m-%d') AS derniere_vente,
  coalesce(mois, 0) AS nb_mois_avec_ventes,
  CASE WHEN rang_ca <= 10 THEN 'Top 10 CA' WHEN part >= 5 THEN 'Produit clé' WHEN n IS NULL THEN 'Aucune vente'
       ELSE 'Produit standard' END AS categorie_performance
FROM stg_pr p LEFT JOIN ranked USING (produit_id)"""

CTES["coherent"] = """
SELECT *, quantite * prix_c AS calc_c, abs(montant_c - quantite * prix_c) AS gap_c,
  coalesce(abs(montant_c - quantite * prix_c) <= 100, false) AS ok,
  CASE WHEN abs(montant_c - quantite * prix_c) <= 100 THEN montant_c ELSE quantite * prix_c END AS corrige_c FROM faulty"""

CTES["routed"] = f"""
SELECT transaction_id, date_transaction, client_id, produit_id, magasin_id, corrige_c AS total_c, quantite, ok,
  CASE WHEN NOT coalesce(corrige_c BETWEEN {LO} AND {HI}, false) THEN 'Montant hors plage acceptable'
       WHEN NOT quantite > 0 THEN 'Quantité nulle ou négative' END AS motif_rejet
FROM (SELECT * FROM coherent WHERE transaction_id <> ''
      QUALIFY row_number() OVER (PARTITION BY transaction_id ORDER BY date_transaction DESC, produit_id DESC,
        magasin_id DESC, montant_c DESC, quantite DESC) = 1)
UNION ALL SELECT transaction_id, date_transaction, client_id, produit_id, magasin_id, montant_c, quantite, NULL,
  'transaction_id manquant' FROM faulty WHERE transaction_id IS NULL OR transaction_id = ''"""

CTES["valid"] = "SELECT * FROM routed WHERE motif_rejet IS NULL"

CTES["std_clients"] = f"""
SELECT client_id, coalesce(upper({strip('nom')}), '') AS nom, {hyphen('prenom')} AS prenom, {std_email('email')} AS email,
  {phone('telephone')} AS telephone, {coded('ville', K.CITY_ALIASES, 'ville')} AS ville, {coded('sexe', K.SEX_CODES, "'Inconnu'")} AS sexe,
  {coded('categorie', K.CATEGORY_CODES, "'Standard'")} AS categorie, date_inscription, rang_arrivee FROM untidy"""

CTES["cleaned_clients"] = f"""
SELECT * FROM (SELECT * FROM std_clients QUALIFY row_number() OVER (PARTITION BY client_id ORDER BY rang_arrivee DESC) = 1)
QUALIFY client_id <> '' AND nom <> '' AND (email = '' OR row_number() OVER (PARTITION BY email ORDER BY rang_arrivee DESC) = 1)"""

def _needs(text: str) -> list[str]:
    words = set(re.findall(r"\b(?:FROM|JOIN)\s+([a-z_]+)\b", text))
    return [name for name in CTES if name in words]


def with_ctes(body: str) -> str:
    """Put in front of a query the tables it reads, and those that they read."""
    wanted: set[str] = set()
    todo = _needs(body)
    while todo:
        name = todo.pop()
        if name not in wanted:
            wanted.add(name)
            todo += _needs(CTES[name])
    parts = [f"{name} AS ({CTES[name]})" for name in CTES if name in wanted]
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + body


Q: dict[str, str] = {}

# aggregates ----------------------------------------------------------------------------------

MONTHLY = f"""
SELECT mois_annee, annee, mois, trimestre, ville_magasin, magasin_id, n AS nb_transactions, clients AS nb_clients_uniques,
  {money('ca_c')} AS ca_total_xaf, {big('qte')} AS quantite_totale, {money('lo_c')} AS montant_min_xaf,
  {money('hi_c')} AS montant_max_xaf, par_tx AS ca_moyen_par_transaction_xaf, par_client AS ca_moyen_par_client_xaf
FROM monthly"""
Q["monthly_revenue"] = MONTHLY

SALES = f"""n AS nb_ventes, {big('qte')} AS quantite_totale, {money('ca_c')} AS ca_total_xaf, magasins AS nb_magasins,
  clients AS nb_clients, (CAST(prix_c AS DOUBLE) / 100) / n AS prix_moyen_xaf"""
Q["product_sales"] = f"SELECT produit_id, {SALES} FROM sales"
Q["top_products"] = f"""
SELECT s.produit_id, nom_produit, categorie AS categorie_produit, {SALES.replace('prix_c', 's.prix_c')},
  rank() OVER (ORDER BY ca_c DESC) AS rang_ca,
  {half_even("(CAST(ca_c AS DOUBLE) / 100) / (CAST((SELECT sum(ca_c) FROM sales) AS DOUBLE) / 100) * 100", 2)} AS part_ca_pct
FROM sales s JOIN products p ON p.produit_id = s.produit_id ORDER BY ca_c DESC, s.produit_id LIMIT 20"""

Q["store_performance"] = f"""
SELECT magasin_id, any_value(nom_magasin) AS nom_magasin, any_value(ville) AS ville_magasin, count(*) AS nb_transactions,
  count(DISTINCT client_id) AS nb_clients_uniques, {money('sum(montant_c)')} AS ca_total_xaf,
  (CAST(sum(montant_c) AS DOUBLE) / 100) / count(*) AS ca_moyen_xaf, {big('sum(quantite)')} AS quantite_totale,
  count(DISTINCT produit_id) AS nb_produits_vendus,
  {half_even('(CAST(sum(montant_c) AS DOUBLE) / 100) / count(*)')} AS panier_moyen_xaf,
  {half_even('(CAST(sum(montant_c) AS DOUBLE) / 100) / 24')} AS ca_mensuel_moyen_xaf,
  rank() OVER (ORDER BY sum(montant_c) DESC) AS rang_ca
FROM tx JOIN stores USING (magasin_id) GROUP BY magasin_id"""

Q["rfm_quantile"] = CTES["rfm"]
Q["rfm_quantile_literal"] = rfm("1 + br", "5 - bf", "5 - bm")
Q["segment_distribution"] = f"""
SELECT segment_rfm, count(*) AS nb_clients,
  {half_even('count(*) / CAST((SELECT count(*) FROM rfm) AS DOUBLE) * 100', 1)} AS part_pct FROM rfm GROUP BY segment_rfm"""
Q["all_aggregates"] = f"""
SELECT 'ca_mensuel' AS agregat, count(*) AS nb_lignes, {money('sum(ca_c)')} AS ca_total_xaf FROM monthly
UNION ALL SELECT 'top_produits', count(*), {money('sum(ca_c)')} FROM (SELECT ca_c FROM sales ORDER BY ca_c DESC, produit_id LIMIT 20)
UNION ALL SELECT 'performance_magasins', count(DISTINCT magasin_id), {money('sum(montant_c)')} FROM tx
UNION ALL SELECT 'segmentation_rfm', count(*), {money('sum(ca_c)')} FROM activity"""
Q["executive_dashboard"] = f"""
SELECT max(mois_annee) AS derniere_periode, {money('sum(ca_c)')} AS ca_total_global_xaf, {big('sum(n)')} AS nb_transactions_total,
  {big('sum(clients)')} AS nb_clients_actifs, {half_up('sum(CAST(par_tx AS BIGINT))', 'count(*)', 0)} AS panier_moyen_global_xaf,
  count(DISTINCT magasin_id) AS nb_magasins_actifs, {big('sum(qte)')} AS quantite_totale_vendue FROM monthly"""
Q["month_over_month"] = f"""
SELECT mois_annee, annee, mois, trimestre, {money('ca')} AS ca_mensuel_xaf, {big('n')} AS nb_transactions,
  {big('clients')} AS nb_clients, panier AS panier_moyen_xaf, {money('avant')} AS ca_mois_precedent_xaf,
  {pct('(ca - avant)', 'avant')} AS croissance_mois_pct
FROM (SELECT *, lag(ca) OVER (ORDER BY mois_annee) AS avant FROM (
  SELECT mois_annee, annee, mois, trimestre, sum(ca_c) AS ca, sum(n) AS n, sum(clients) AS clients,
    {half_up('sum(CAST(par_tx AS BIGINT))', 'count(*)', 0)} AS panier FROM monthly GROUP BY ALL))"""
Q["duplicate_count"] = """
SELECT count(*) AS nb_total, count(*) - count(DISTINCT transaction_id) AS nb_doublons FROM tx"""
Q["quantiles_mean_std"] = """
SELECT round(quantile_cont(x, 0.25), 4) AS q1, round(median(x), 4) AS mediane, round(quantile_cont(x, 0.75), 4) AS q3,
  round(avg(x), 4) AS moyenne, round(stddev_samp(x), 4) AS ecart_type FROM (SELECT montant_c / 100.0::DOUBLE AS x FROM tx)"""

# windows -------------------------------------------------------------------------------------

BARE = f"""transaction_id, strftime(date_transaction, '%Y-%m-%d') AS date_transaction, magasin_id, produit_id, quantite,
  {money('montant_c')} AS montant_total_xaf, canal_vente"""
Q["dedup_transactions"] = f"""
SELECT {BARE} FROM (SELECT * FROM tx QUALIFY row_number() OVER (PARTITION BY transaction_id
  ORDER BY date_transaction DESC, {TX_TIES}) = 1)"""
LAST = """(SELECT * FROM tx QUALIFY row_number() OVER (PARTITION BY transaction_id ORDER BY date_transaction DESC,
  produit_id DESC, magasin_id DESC, montant_c DESC, quantite DESC) = 1)"""
Q["keep_last"] = f"SELECT {BARE} FROM {LAST}"
Q["revenue_rank"] = f"""
SELECT produit_id, {big('qte')} AS quantite_totale, {money('ca_c')} AS ca_total_xaf,
  rank() OVER (ORDER BY qte DESC) AS rang_volume FROM sales"""
Q["share_of_total"] = f"""
SELECT magasin_id, {money('sum(montant_c)')} AS ca_total_xaf,
  {pct('sum(montant_c)', '(SELECT sum(montant_c) FROM tx)')} AS part_ca_pct FROM tx GROUP BY magasin_id"""
Q["rfm_ntile"] = f"""
SELECT client_id, recence AS recence_jours, n AS nb_achats_total, {money('ca_c')} AS ca_total_xaf, r AS score_recence,
  f AS score_frequence, m AS score_montant, {half_up('(r + f + m)', '3', 2)} AS score_rfm_moyen, segment_rfm FROM tiles"""
Q["quantile_bins"] = f"""
SELECT o_orderkey, o_totalprice AS montant,
  {big(f"1 + list_sum(list_transform(e, lambda x: CAST(x < o_totalprice AS INTEGER)))")} AS quintile
FROM orders, (SELECT quantile_cont(o_totalprice, {QUINTS}) AS e FROM orders)"""
Q["fixed_bins"] = f"""
SELECT client_id, j AS anciennete_jours, CASE WHEN j > 365 THEN 'Très fidèle' WHEN j > 90 THEN 'Fidèle' WHEN j > 0 THEN 'Nouveau' END
  AS segment_anciennete FROM (SELECT client_id, date_diff('day', date_inscription, {AS_OF}) AS j FROM clients)"""
Q["sort_output"] = f"""
SELECT client_id, {money('ca_c')} AS ca_total_xaf, row_number() OVER (ORDER BY ca_c DESC, client_id) AS position FROM activity"""
Q["top_k"] = f"""
SELECT strftime(date_transaction, '%Y-%m-%d') AS date_transaction, produit_id, magasin_id, {money('montant_c')} AS montant_total_xaf,
  quantite, transaction_id FROM tx ORDER BY montant_c DESC, transaction_id, tx.date_transaction, produit_id, magasin_id, quantite
LIMIT 100"""
Q["union_aligned"] = """
SELECT client_id, email, ville, NULL::VARCHAR AS magasin_id FROM untidy
UNION ALL SELECT NULL, NULL, ville, magasin_id FROM stores"""
Q["key_set_difference"] = "SELECT DISTINCT magasin_id FROM tx WHERE magasin_id NOT IN (SELECT magasin_id FROM active)"

# filters and joins -----------------------------------------------------------------------------

Q["row_filters"] = f"""
SELECT transaction_id, {money('montant_c')} AS montant_total_xaf, quantite, statut, mode_paiement FROM faulty
WHERE transaction_id <> '' AND montant_c BETWEEN {LO} AND {HI} AND quantite > 0 AND statut <> 'Annulé'
  AND mode_paiement <> 'Inconnu'"""
Q["enrich_dimensions"] = f"""
SELECT transaction_id, t.client_id, t.produit_id, t.magasin_id, {money('montant_c')} AS montant_total_xaf, c.ville AS ville_client,
  c.categorie AS categorie_client, sexe, {REGION.format('c.ville')} AS region, nom_produit, p.categorie AS categorie_produit,
  sous_categorie, nom_magasin, m.ville AS ville_magasin
FROM tx t LEFT JOIN clients c ON c.client_id = t.client_id LEFT JOIN products p ON p.produit_id = t.produit_id
LEFT JOIN active m ON m.magasin_id = t.magasin_id"""
Q["sales_star_join"] = """
SELECT transaction_id, client_id, produit_id, magasin_id, departement, est_client_premium, segment_prix, zone_commerciale,
  taille_magasin FROM star"""
Q["orphan_keys"] = """
SELECT DISTINCT 'magasin_id' AS colonne, magasin_id AS valeur FROM tx WHERE magasin_id NOT IN (SELECT magasin_id FROM active)
UNION ALL SELECT DISTINCT 'client_id', client_id FROM tx WHERE client_id NOT IN (SELECT client_id FROM clients)
UNION ALL SELECT DISTINCT 'produit_id', produit_id FROM tx WHERE produit_id NOT IN (SELECT produit_id FROM products)"""
Q["relationships_test"] = """
SELECT magasin_id, count(*) AS nb_lignes FROM tx WHERE magasin_id NOT IN (SELECT magasin_id FROM active) GROUP BY magasin_id"""

# cleaning --------------------------------------------------------------------------------------

DAY = "strftime(date_transaction, '%Y-%m-%d') AS date_transaction"
Q["amount_coherence"] = f"""
SELECT transaction_id, {DAY}, produit_id, magasin_id, quantite, {money('calc_c')} AS montant_calcule_xaf,
  {money('gap_c')} AS ecart_montant_xaf, ok AS montant_coherent, {money('corrige_c')} AS montant_total_xaf FROM coherent"""
Q["iqr_outliers"] = """
SELECT o_orderkey, o_totalprice AS montant,
  o_totalprice < q1 - 0.5 * (q3 - q1) OR o_totalprice > q3 + 0.5 * (q3 - q1) AS est_outlier
FROM orders, (SELECT quantile_cont(o_totalprice, 0.25) AS q1, quantile_cont(o_totalprice, 0.75) AS q3 FROM orders)"""
CALENDAR = f"""{big('year(d)')} AS annee, {big('month(d)')} AS mois, {big('quarter(d)')} AS trimestre, {big('week(d)')} AS semaine,
  dayname(d) AS jour_semaine, coalesce(isodow(d) >= 6, false) AS est_weekend, strftime(d, '%Y-%m') AS mois_annee,
  {MONTHS.format('d')} AS nom_mois"""
Q["time_dimensions"] = f"""
SELECT o_orderkey, strftime(d, '%Y-%m-%d') AS date_transaction, {CALENDAR}
FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 50 <> 0 THEN CAST(o_orderdate AS DATE) END AS d FROM orders)"""
Q["reject_routing"] = f"""
SELECT transaction_id, {DAY}, produit_id, magasin_id, {money('total_c')} AS montant_total_xaf, quantite, motif_rejet FROM routed"""
Q["clean_transactions"] = f"""
SELECT transaction_id, strftime(v.date_transaction, '%Y-%m-%d') AS date_transaction, v.produit_id, v.magasin_id,
  {money('total_c')} AS montant_total_xaf, quantite, ok AS montant_coherent,
  total_c / 100.0::DOUBLE < q1 - 1.5 * (q3 - q1) OR total_c / 100.0::DOUBLE > q3 + 1.5 * (q3 - q1) AS est_outlier,
  strftime(v.date_transaction, '%Y-%m') AS mois_annee, {big('week(v.date_transaction)')} AS semaine,
  isodow(v.date_transaction) >= 6 AS est_weekend, {MONTHS.format('v.date_transaction')} AS nom_mois,
  {REGION.format('c.ville')} AS region, p.categorie AS categorie_produit, m.ville AS ville_magasin
FROM valid v CROSS JOIN (SELECT quantile_cont(total_c / 100.0::DOUBLE, 0.25) AS q1, quantile_cont(total_c / 100.0::DOUBLE, 0.75) AS q3 FROM valid)
LEFT JOIN clients c ON c.client_id = v.client_id LEFT JOIN products p ON p.produit_id = v.produit_id
LEFT JOIN stores m ON m.magasin_id = v.magasin_id"""
Q["rejected_transactions"] = """
SELECT '2001-12-31' AS date_rejet, motif_rejet, count(*) AS nb_lignes FROM routed WHERE motif_rejet IS NOT NULL GROUP BY motif_rejet"""
Q["clean_clients"] = f"""
SELECT client_id, nom, prenom, email, telephone, ville, date_inscription, sexe, categorie, rang_arrivee, j AS anciennete_jours,
  CASE WHEN j > 365 THEN 'Très fidèle' WHEN j > 90 THEN 'Fidèle' WHEN j > 0 THEN 'Nouveau' END AS segment_anciennete,
  categorie IN ('Premium', 'VIP') AS est_premium, {REGION.format('ville')} AS region
FROM (SELECT *, date_diff('day', CAST(date_inscription AS DATE), {AS_OF}) AS j FROM cleaned_clients)"""
Q["dedup_clients"] = """
SELECT client_id, email, rang_arrivee FROM (
  SELECT * FROM untidy QUALIFY row_number() OVER (PARTITION BY client_id ORDER BY rang_arrivee DESC) = 1)
QUALIFY email IS NULL OR email = '' OR row_number() OVER (PARTITION BY email ORDER BY rang_arrivee DESC) = 1"""
Q["map_codes"] = "SELECT rang_arrivee, ville, sexe, categorie FROM std_clients"
Q["upper_name"] = "SELECT rang_arrivee, nom FROM std_clients"
Q["hyphen_capitalize"] = "SELECT rang_arrivee, prenom FROM std_clients"
Q["initcap_words"] = f"""
SELECT conv_id || '/' || turn AS id, {title('text')} AS texte FROM conversations
UNION ALL SELECT CAST(item_id AS VARCHAR), {title('text')} FROM benchmark"""


def found(pattern: str) -> str:
    return f"""(SELECT doc_id, CAST(generate_subscripts(h, 1) - 1 AS BIGINT) AS rang, unnest(h) AS trouve
  FROM (SELECT doc_id, regexp_extract_all(text, '{pattern}') AS h FROM documents))"""


Q["normalize_phone"] = rf"""
SELECT doc_id, rang, trouve, {phone('trouve')} AS telephone,
  regexp_matches(replace(replace(trouve, ' ', ''), '-', ''), '^(\+242)?0[456]\d{{7,8}}$') AS est_valide
FROM {found(r'\+?[0-9][0-9 .()-]{6,}[0-9]')}""".replace(chr(92) * 2, chr(92))
Q["standardize_email"] = f"""
SELECT doc_id, rang, trouve, {std_email('trouve')} AS email, {EMAIL_OK.format(strip('trouve'))} AS est_valide
FROM {found(r'[^\s<>()]+@[^\s<>()]+')}""".replace(chr(92) * 2, chr(92))

# staging and marts -------------------------------------------------------------------------------

Q["stg_clients"] = f"""
SELECT trim(client_id) AS client_id, trim(telephone) AS telephone, {title('trim(ville)')} AS ville, {title('trim(quartier)')} AS quartier,
  {title('trim(prenom)')} AS prenom, trim(nom) || ' ' || {title('trim(prenom)')} AS nom_complet, upper(trim(nom)) AS nom,
  lower(trim(email)) AS email, upper(trim(sexe)) AS sexe,
  CASE upper(trim(sexe)) WHEN 'M' THEN 'Masculin' WHEN 'F' THEN 'Féminin' ELSE 'Non renseigné' END AS sexe_libelle,
  {REGION.format('trim(ville)')} AS departement, trim(categorie) AS categorie_client,
  coalesce(trim(categorie) IN ('Premium', 'VIP'), false) AS est_client_premium, date_inscription
FROM untidy WHERE client_id <> '' AND nom <> ''
QUALIFY row_number() OVER (PARTITION BY client_id ORDER BY date_inscription DESC, rang_arrivee) = 1"""
Q["dim_clients"] = f"""
SELECT id_client, {title('trim(nom)')} AS nom, {coded('code_pays', K.COUNTRY_CODES, 'upper(trim(code_pays))')} AS code_pays,
  {title('trim(ville)')} AS ville, CASE WHEN {EMAIL_OK.format('email')} THEN email END AS email_valide,
  strftime(TRY_CAST(date_creation AS DATE), '%Y-%m-%d') AS date_creation
FROM crm WHERE id_client IS NOT NULL"""
Q["stg_transactions"] = f"""
SELECT transaction_id, client_id, magasin_id, produit_id, strftime(d, '%Y-%m-%d') AS date_transaction,
  {big('year(d)')} AS annee, {big('month(d)')} AS mois, {big('quarter(d)')} AS trimestre, strftime(d, '%Y-%m') AS mois_annee,
  {MONTHS.format('d')} AS nom_mois, dayname(d) AS jour_semaine, quantite, {money('prix_c')} AS prix_unitaire_xaf,
  {money('montant_c')} AS montant_total_xaf, {money('quantite * prix_c')} AS montant_recalcule_xaf, mode_paiement,
  statut AS statut_transaction, canal_vente, canal_vente = 'En ligne' AS est_vente_en_ligne,
  CASE WHEN montant_c >= 20000000 THEN 'Grande transaction' WHEN montant_c >= 5000000 THEN 'Transaction moyenne'
       ELSE 'Petite transaction' END AS segment_montant
FROM (SELECT *, date_transaction AS d FROM faulty
  WHERE transaction_id <> '' AND montant_c BETWEEN {LO} AND {HI} AND quantite > 0 AND statut <> 'Annulé'
  QUALIFY row_number() OVER (PARTITION BY transaction_id ORDER BY date_transaction DESC, {TX_TIES}) = 1)"""
Q["stg_products"] = f"SELECT * EXCLUDE (prix_c), {money('prix_c')} AS prix_unitaire_xaf FROM stg_pr"
Q["stg_stores"] = "SELECT * REPLACE (strftime(date_ouverture, '%Y-%m-%d') AS date_ouverture) FROM stg_st"
Q["sales_mart"] = f"""
SELECT mois_annee, annee, mois, trimestre, nom_mois, magasin_id, nom_magasin, ville_magasin, zone_commerciale, taille_magasin,
  categorie_produit, nb_transactions, nb_clients_uniques, nb_produits_vendus, {big('qte')} AS quantite_totale,
  {money('ca_c')} AS ca_total_xaf, {half_up('ca_c', '(100 * n)', 4)} AS panier_moyen_xaf, {money('lo_c')} AS transaction_min_xaf,
  {money('hi_c')} AS transaction_max_xaf, {money('en_ligne_c')} AS ca_en_ligne_xaf, {money('magasin_c')} AS ca_magasin_xaf,
  nb_mobile_money, nb_especes, nb_carte_bancaire, nb_virement, {money('premium_c')} AS ca_clients_premium_xaf,
  {pct('en_ligne_c', 'ca_c')} AS taux_vente_en_ligne_pct, {pct('premium_c', 'ca_c')} AS part_ca_premium_pct FROM mart_v"""
Q["client_metrics"] = f"""
SELECT client_id, n AS nb_achats_total, {money('ca_c')} AS ca_total_xaf, {half_up('ca_c', '(100 * n)', 4)} AS panier_moyen_xaf,
  {money('hi_c')} AS achat_max_xaf, {big('qte')} AS quantite_totale_achetee, strftime(premiere, '%Y-%m-%d') AS premiere_transaction,
  strftime(derniere, '%Y-%m-%d') AS derniere_transaction, produits AS nb_produits_differents, magasins AS nb_magasins_frequentes,
  canal_prefere, mode_paiement_prefere, mois AS nb_mois_actifs, annees AS nb_annees_actif, recence AS recence_jours,
  {half_up('n', 'mois', 2)} AS frequence_mensuelle FROM metrics"""
Q["client_mart"] = CTES["mart_c"]
Q["product_performance"] = f"""
SELECT produit_id, n AS nb_transactions, clients AS nb_clients_uniques, magasins AS nb_magasins_vendeurs,
  {big('qte')} AS quantite_totale_vendue, {money('ca_c')} AS ca_total_xaf, {half_up('ca_c', '(100 * n)', 4)} AS ca_moyen_par_vente_xaf,
  {money('lo_c')} AS prix_min_observe_xaf, {money('hi_c')} AS prix_max_observe_xaf,
  {half_up('prix_c', '(100 * n)', 4)} AS prix_moyen_observe_xaf, {big('en_ligne')} AS qte_vendue_en_ligne,
  {big('magasin')} AS qte_vendue_magasin, strftime(premiere, '%Y-%m-%d') AS premiere_vente,
  strftime(derniere, '%Y-%m-%d') AS derniere_vente, mois AS nb_mois_avec_ventes FROM perf"""
Q["product_mart"] = CTES["mart_p"]

Q["order_by_coalesce"] = """
SELECT produit_id, rang_ca, row_number() OVER (ORDER BY rang_ca, produit_id) AS position FROM mart_p"""

# quality -------------------------------------------------------------------------------------------

BROKEN_TX = f"""list_filter([
    CASE WHEN transaction_id IS NULL THEN 'transaction_id manquant' END,
    CASE WHEN NOT montant_c BETWEEN {LO} AND {HI} THEN 'montant hors plage : ' || format('{{:.2f}}', {money('montant_c')})
         || ' XAF (attendu entre 5,000 et 100,000)' END,
    CASE WHEN prix_c IS NULL THEN 'impossible de vérifier la cohérence quantité/prix/montant'
         WHEN abs(quantite * prix_c - montant_c) > 100 THEN 'incohérence montant : qté×prix='
           || format('{{:,}}', CAST(round_even({money('quantite * prix_c')}, 0) AS BIGINT)) || ' ≠ déclaré='
           || format('{{:,}}', CAST(round_even({money('montant_c')}, 0) AS BIGINT)) END,
    CASE WHEN mode_paiement = 'Inconnu' THEN 'mode de paiement inconnu : Inconnu' END], lambda e: e IS NOT NULL)"""
BROKEN_CLIENT = f"""list_filter([
    CASE WHEN NOT coalesce(starts_with(client_id, 'C'), false) THEN 'client_id manquant ou invalide' END,
    CASE WHEN NOT coalesce(length(nom) >= 2, false) THEN 'nom manquant ou trop court' END,
    CASE WHEN NOT {EMAIL_OK.format(strip('email'))} THEN 'email invalide : ' || coalesce(email, 'None') END,
    CASE WHEN NOT coalesce(ville IN ('Brazzaville', 'Pointe-Noire', 'Dolisie', 'Ouesso', 'Nkayi', 'Impfondo', 'Sibiti', 'Madingou',
      'Kinkala'), false) THEN 'ville non reconnue : ' || coalesce(ville, 'None') END,
    CASE WHEN NOT coalesce(categorie IN ('Standard', 'Premium', 'VIP'), false)
      THEN 'catégorie invalide : ' || coalesce(categorie, 'None') END], lambda e: e IS NOT NULL)"""

CTES["checked_clients"] = f"SELECT rang_arrivee, {BROKEN_CLIENT} AS e FROM untidy"
CTES["checked_tx"] = f"SELECT *, {BROKEN_TX} AS e FROM faulty"
CTES["twice"] = "SELECT * FROM checked_tx UNION ALL SELECT * FROM checked_tx WHERE quantite = 7"

Q["validate_clients"] = """
SELECT rang_arrivee, len(e) = 0 AS est_valide, array_to_string(e, ' | ') AS erreurs FROM checked_clients"""
Q["validate_transactions"] = f"""
SELECT transaction_id, {DAY}, produit_id, magasin_id, {money('montant_c')} AS montant_total_xaf, quantite,
  len(e) = 0 AS est_valide, array_to_string(e, ' | ') AS erreurs FROM checked_tx"""
Q["error_details"] = """
SELECT erreur, count(*) AS nb FROM (SELECT unnest(e) AS erreur FROM checked_clients) GROUP BY erreur"""

TX_COLUMNS = {"transaction_id": "transaction_id", "date_transaction": "date_transaction", "magasin_id": "magasin_id",
              "produit_id": "produit_id", "quantite": "quantite", "montant_total_xaf": "montant_c",
              "canal_vente": "canal_vente", "client_id": "client_id", "mode_paiement": "mode_paiement",
              "statut": "statut", "prix_unitaire_xaf": "prix_c"}


def rate(part: str, whole: str = "count(*)") -> str:
    return half_even(f"CAST({part} AS DOUBLE) / greatest({whole}, 1) * 100", 2)


def score(table: str, columns: list[str], duplicates: str) -> str:
    mean = "(" + " + ".join(rate(f"count({c})") for c in columns) + f") / {len(columns)}"
    return half_even(f"({mean} + (1 - CAST({duplicates} AS DOUBLE) / greatest(count(*), 1)) * 100) / 2", 2)


def summary(name: str, table: str, columns: list[str], invalid: str = "0") -> str:
    listed = ", ".join(columns)
    nulls = " + ".join(f"count(*) - count({c})" for c in columns)
    duplicates = f"(SELECT count(*) FROM {table}) - (SELECT count(*) FROM (SELECT DISTINCT {listed} FROM {table}))"
    return f"""
SELECT '{name}' AS dataset, count(*) AS nb_lignes_total, CAST({len(columns)} AS BIGINT) AS nb_colonnes,
  {big(nulls)} AS valeurs_nulles, {big(duplicates)} AS doublons, {big(invalid)} AS lignes_invalides,
  {score(table, columns, duplicates)} AS score_qualite FROM {table}"""


Q["quality_report"] = summary("transactions", "twice", list(TX_COLUMNS.values()), "count(*) FILTER (len(e) > 0)")
Q["column_profile"] = " UNION ALL ".join(
    f"SELECT count(*) AS nb_lignes_total, '{name}' AS colonne, count(*) - count({c}) AS valeurs_nulles, "
    f"{rate(f'count({c})')} AS taux_completude FROM faulty" for name, c in TX_COLUMNS.items())


def metric(check: str, name: str, value: str, threshold: str, good: str, source: str) -> str:
    return f"""SELECT '{check}' AS "check", '{name}' AS metric, CAST({value} AS DOUBLE) AS value,
  CAST({threshold} AS DOUBLE) AS threshold, CASE WHEN {good} THEN 'OK' ELSE 'ALERTE' END AS status {source}"""


def union(*parts: str) -> str:
    return " UNION ALL ".join(parts)


def completeness(table: str, columns: list[str], absent: list[str] = ()) -> list[str]:
    return ([metric("completude", c, rate(f"count({c})"), "95", f"{rate(f'count({c})')} >= 95", f"FROM {table}")
             for c in columns]
            + [metric("completude", c, "0", "95", "false", "") for c in absent])


DUPLICATES = "count(*) - count(DISTINCT transaction_id)"
DUPLICATE_METRICS = [
    metric("doublons", "nb_doublons", DUPLICATES, "NULL", f"{rate(DUPLICATES)} <= 1", "FROM tx"),
    metric("doublons", "taux_doublons", rate(DUPLICATES), "1", f"{rate(DUPLICATES)} <= 1", "FROM tx")]


def anomalies(table: str, x: str, zmax: str) -> list[str]:
    source = f"""FROM (SELECT {x} AS v FROM {table}), (SELECT quantile_cont({x}, 0.25) AS q1, median({x}) AS q2,
  quantile_cont({x}, 0.75) AS q3, avg({x}) AS mean, stddev_samp({x}) AS std FROM {table})"""
    check = "anomalies_montants"
    return [metric(check, "montant_median", "any_value(q2)", "NULL", "true", source),
            metric(check, "outliers_iqr",
                   "count(*) FILTER (v < q1 - 1.5 * (q3 - q1) OR v > q3 + 1.5 * (q3 - q1))", "NULL", "true", source),
            metric(check, "outliers_zscore", f"count(*) FILTER (abs((v - mean) / std) > {zmax})", zmax, "true", source),
            metric(check, "montants_invalides", "count(*) FILTER (v <= 0)", "0", "count(*) FILTER (v <= 0) = 0", source)]


def references() -> list[str]:
    check, out = "coherence_referentielle", []
    orphans = []
    for key, table in (("client_id", "clients"), ("produit_id", "products"), ("magasin_id", "active")):
        n = f"(SELECT count(DISTINCT {key}) FROM tx)"
        lost = f"(SELECT count(DISTINCT {key}) FROM tx WHERE {key} NOT IN (SELECT {key} FROM {table}))"
        orphans.append(lost)
        out += [metric(check, f"{key}_distincts", n, "NULL", "true", ""),
                metric(check, f"{key}_orphelins", lost, "0", f"{lost} = 0", ""),
                metric(check, f"{key}_orphelins_pct", half_even(f"CAST({lost} AS DOUBLE) / greatest({n}, 1) * 100", 1),
                       "0", f"{lost} = 0", "")]
    none = f"{' + '.join(orphans)} = 0"
    return [*out, metric(check, "coherence_ok", f"CAST({none} AS INTEGER)", "1", none, "")]


def volume(table: str, date: str, day: str) -> str:
    return metric("volume", "nb_transactions_du_jour", "count(*)", "1", "count(*) >= 1",
                  f"FROM {table} WHERE CAST({date} AS DATE) = DATE '{day}'")


Q["completeness_check"] = union(*completeness("untidy", ["client_id", "nom", "email"], ["ville"]))
Q["duplicate_check"] = union(*DUPLICATE_METRICS)
Q["amount_anomalies"] = union(*anomalies("orders", "o_totalprice", "1.5"))
Q["referential_check"] = union(*references())
Q["daily_volume"] = """
SELECT strftime(ts, '%Y-%m-%d') AS jour, count(*) AS nb_lignes, CASE WHEN count(*) >= 330 THEN 'OK' ELSE 'ALERTE' END AS statut
FROM events GROUP BY 1"""
Q["daily_volume_check"] = volume("events", "ts", "2024-01-15")
NULLS = {name: rate(f"count(*) - count({c})") for name, c in TX_COLUMNS.items()}
OUTSIDE = "count(*) FILTER (NOT date_transaction BETWEEN DATE '1996-01-01' AND DATE '2000-12-31')"
Q["null_rate_alert"] = union(
    *[metric("nullite", f"nullite_{name}", r, "1", f"{r} <= 1", "FROM faulty") for name, r in NULLS.items()],
    metric("nullite", "non_positifs_quantite", "count(*) FILTER (quantite <= 0)", "0", "count(*) FILTER (quantite <= 0) = 0", "FROM faulty"),
    metric("nullite", "non_positifs_montant_total_xaf", "count(*) FILTER (montant_c <= 0)", "0",
           "count(*) FILTER (montant_c <= 0) = 0", "FROM faulty"),
    metric("nullite", "hors_periode_date_transaction", OUTSIDE, "0", f"{OUTSIDE} = 0", "FROM faulty"))
Q["quality_summary"] = union(
    *completeness("clients", ["client_id", "nom", "email", "ville"]), *DUPLICATE_METRICS,
    *anomalies("tx", "montant_c / 100.0::DOUBLE", "3"), *references(), volume("tx", "date_transaction", "2000-06-15"))


def tested(name: str, column: str, kind: str, failures: str) -> str:
    return f"""SELECT '{name}' AS "table", '{column}' AS "column", '{kind}' AS test, {big(failures)} AS failures,
  CASE WHEN {failures} = 0 THEN 'OK' ELSE 'ALERTE' END AS status"""


def table_tests(name: str, source: str, not_null: list[str] = (), unique: list[tuple[str, ...]] = (),
                accepted: dict[str, list[str]] | None = None, positive: list[str] = (),
                columns: dict[str, str] | None = None) -> list[str]:
    at = (columns or {}).get
    out = [tested(name, c, "not_null", f"(SELECT count(*) FROM {source} WHERE {at(c, c)} IS NULL)") for c in not_null]
    out += [tested(name, c, "positive", f"(SELECT count(*) FROM {source} WHERE NOT {at(c, c)} > 0)") for c in positive]
    for key in unique:
        listed = ", ".join(key)
        present = " AND ".join(f"{c} IS NOT NULL" for c in key)
        out.append(tested(name, "+".join(key), "unique", f"(SELECT count(*) FROM (SELECT {listed} FROM {source} "
                                                         f"WHERE {present} GROUP BY {listed} HAVING count(*) > 1))"))
    for c, values in (accepted or {}).items():
        listed = ", ".join(f"'{v}'" for v in values)
        out.append(tested(name, c, "accepted_values", f"(SELECT count(*) FROM {source} WHERE {c} NOT IN ({listed}))"))
    return out


SEGMENTS = ["Champions", "Clients fidèles", "Clients à risque", "Clients inactifs", "Clients en développement", "Jamais acheté"]
Q["column_tests"] = union(
    *table_tests("stg_clients", "stg_cl", ["client_id", "nom", "email", "ville", "categorie_client"], [("client_id",)],
                 {"ville": ["Brazzaville", "Pointe-Noire", "Dolisie", "Ouesso", "Nkayi", "Impfondo"],
                  "categorie_client": ["Standard", "Premium", "VIP"], "sexe": ["M", "F", "Inconnu"]}),
    *table_tests("stg_transactions", "stg_tx", ["transaction_id", "client_id", "montant_total_xaf", "mode_paiement"],
                 [("transaction_id",)], {"mode_paiement": ["Espèces", "Mobile Money", "Carte bancaire", "Virement"]},
                 columns=TX_COLUMNS),
    tested("stg_transactions", "statut_transaction", "accepted_values",
           "(SELECT count(*) FROM stg_tx WHERE statut NOT IN ('Validé', 'En attente', 'Remboursé'))"),
    tested("stg_transactions", "client_id", "relationships",
           "(SELECT count(*) FROM stg_tx WHERE client_id NOT IN (SELECT client_id FROM stg_cl))"),
    *table_tests("stg_produits", "stg_pr", ["produit_id", "categorie", "prix_unitaire_xaf"], [("produit_id",)], columns=TX_COLUMNS),
    *table_tests("stg_magasins", "stg_st", ["magasin_id", "ville"], [("magasin_id",)], {"statut": ["Actif"]}),
    *table_tests("mart_ventes", "mart_v", ["mois_annee", "magasin_id", "ca_total_xaf", "nb_transactions"],
                 columns={"ca_total_xaf": "ca_c"}),
    *table_tests("mart_clients", "mart_c", ["client_id", "ca_total_xaf", "segment_rfm"], [("client_id",)], {"segment_rfm": SEGMENTS}),
    *table_tests("mart_produits", "mart_p", ["produit_id", "ca_total_xaf"], [("produit_id",)],
                 {"categorie_performance": ["Top 10 CA", "Produit clé", "Produit standard", "Aucune vente"]}))
Q["table_constraints"] = union(
    *table_tests("clients", "clients", ["client_id", "nom"], [("client_id",)]),
    *table_tests("transactions", "faulty", ["transaction_id", "date_transaction", "quantite", "prix_unitaire_xaf", "montant_total_xaf"],
                 [("transaction_id",)], positive=["quantite", "montant_total_xaf"], columns=TX_COLUMNS),
    *table_tests("produits", "products", ["produit_id", "nom_produit"], [("produit_id",)]),
    *table_tests("magasins", "stores", ["magasin_id"], [("magasin_id",)]),
    *table_tests("ca_mensuel", "monthly", ["mois_annee", "annee", "mois"], [("mois_annee", "magasin_id")]),
    *table_tests("top_produits", "products", unique=[("produit_id",)]),
    *table_tests("performance_magasins", "stores", unique=[("magasin_id",)]),
    *table_tests("segmentation_rfm", "clients", unique=[("client_id",)]))

# sources and sinks -----------------------------------------------------------------------------------

Q["csv_transactions"] = f"""
SELECT nullif(transaction_id, '') AS transaction_id, CASE WHEN quantite <> 4 THEN strftime(date_transaction, '%Y-%m-%d 06:30:00.000000') END AS date_transaction,
  magasin_id, produit_id, CASE WHEN quantite = 3 THEN 0 ELSE quantite END AS quantite, {money('montant_c')} AS montant_total_xaf,
  canal_vente, client_id, mode_paiement, statut, {money('prix_c')} AS prix_unitaire_xaf FROM faulty"""
Q["csv_clients"] = f"""
SELECT nullif(client_id, '') AS client_id, {strip('nom')} AS nom, {strip('prenom')} AS prenom, {strip('email')} AS email,
  {strip('telephone')} AS telephone, {strip('ville')} AS ville, quartier, date_inscription, {strip('sexe')} AS sexe,
  {strip('categorie')} AS categorie, CAST(rang_arrivee AS VARCHAR) AS rang_arrivee FROM untidy"""
Q["csv_produits"] = f"""
SELECT produit_id, trim(nom_produit) AS nom_produit, categorie, sous_categorie, {money('prix_c')} AS prix_unitaire_xaf, stock_initial,
  fournisseur, pays_origine FROM products"""
Q["csv_magasins"] = "SELECT * REPLACE (strftime(date_ouverture, '%Y-%m-%d') AS date_ouverture) FROM stores"
CTES["csv_untidy"] = "SELECT * REPLACE (nullif(client_id, '') AS client_id) FROM untidy"
Q["extract_reports"] = union(
    summary("clients", "csv_untidy", ["client_id", "nom", "prenom", "email", "telephone", "ville", "quartier", "date_inscription",
                                      "sexe", "categorie", "rang_arrivee"]),
    summary("transactions", "tx", list(TX_COLUMNS.values())),
    summary("produits", "products", ["produit_id", "nom_produit", "categorie", "sous_categorie", "prix_c", "stock_initial",
                                     "fournisseur", "pays_origine"]),
    summary("magasins", "stores", ["magasin_id", "nom_magasin", "ville", "quartier", "adresse", "responsable", "telephone",
                                   "surface_m2", "date_ouverture", "statut"]))
Q["bronze_ingest"] = """
SELECT CASE WHEN quantite = 13 THEN concat_ws(',', transaction_id, magasin_id, produit_id, quantite, '?') ELSE transaction_id END AS ligne,
  CASE WHEN quantite <> 13 THEN CAST(quantite AS VARCHAR) END AS quantite, CASE WHEN quantite = 13 THEN 'quarantaine' ELSE 'ok' END AS etat FROM tx"""
Q["bronze_stream"] = Q["bronze_ingest"]
Q["erp_orders"] = """
SELECT 'CMD' || o_orderkey AS commande_id, strftime(o_orderdate, '%Y-%m-%d') AS date_commande, 'C' || o_custkey AS client_id,
  CAST(floor(o_totalprice) AS BIGINT) AS montant_ht_xaf, CAST(18 AS DOUBLE) AS taux_tva,
  round_even(floor(o_totalprice) * (1 + 18::DOUBLE / 100), 0) AS montant_ttc_xaf,
  CASE WHEN o_orderkey % 2 = 0 THEN 'Livraison domicile' ELSE 'Retrait magasin' END AS mode_livraison,
  ['Livré', 'En cours', 'Supprimé'][o_orderkey % 4 + 1] AS statut_commande, s_name AS commercial_id, 'ERP_INTERNE' AS source
FROM orders LEFT JOIN supplier ON s_suppkey = o_orderkey % 1200
WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1998-12-31' AND o_orderkey % 4 < 2"""
Q["price_history"] = """
SELECT produit_id, ancien_prix_xaf, nouveau_prix_xaf, strftime(d, '%Y-%m-%d') AS date_changement, motif_changement, operateur_id,
  row_number() OVER (ORDER BY produit_id, d DESC NULLS FIRST, operateur_id, nouveau_prix_xaf, ancien_prix_xaf) AS position
FROM (SELECT 'P' || l_partkey AS produit_id, CAST(floor(p_retailprice) AS BIGINT) AS ancien_prix_xaf,
  CAST(floor(l_extendedprice) AS BIGINT) AS nouveau_prix_xaf, CASE WHEN l_linenumber <> 6 THEN CAST(l_shipdate AS DATE) END AS d,
  CASE l_linenumber % 3 WHEN 0 THEN 'Promotion' WHEN 1 THEN 'Fin promotion' ELSE 'Révision tarifaire' END AS motif_changement,
  'T' || l_orderkey || '-' || l_linenumber AS operateur_id FROM lineitem JOIN part ON p_partkey = l_partkey)"""
Q["price_snapshot"] = """
SELECT CASE WHEN l_partkey % 13 = 0 THEN 'N' ELSE 'P' END || l_partkey AS produit_id, p AS prix_actuel_xaf, round_even((p - ref) / ref * 100 * 100, 0) / 100 AS variation_pct,
  strftime(d, '%Y-%m-%d %H:%M:%S.%f') AS date_maj_prix, 'API_CATALOGUE' AS source
FROM (SELECT l_partkey, CAST(floor(max(l_extendedprice)) AS BIGINT) AS p, max(l_shipdate) AS d,
        coalesce(any_value(CASE WHEN l_partkey % 13 <> 0 THEN CAST(round(p_retailprice * 100) AS BIGINT) * p_size * 10 END) / 100.0::DOUBLE, 50000) AS ref
      FROM lineitem LEFT JOIN part ON p_partkey = l_partkey GROUP BY l_partkey)"""
Q["fx_pairs"] = """
SELECT 'XAF' AS devise_source, upper(event_type) AS devise_cible, round(value, 6) AS taux, strftime(ts, '%Y-%m-%d') AS date, 'API_BEAC_SIMULEE' AS source FROM events"""
Q["events_in_range"] = """
SELECT event_id, strftime(ts, '%Y-%m-%d') AS date, event_type AS type, value AS impact_ventes_pct, 'Toutes' AS villes_concernees
FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'"""
CTES["stock"] = """
SELECT 'M' || l_suppkey AS magasin_id, 'P' || l_partkey AS produit_id, CAST(sum(l_quantity) AS BIGINT) AS quantite_stock,
  sum(l_quantity) < 10 AS alerte_rupture, strftime(max(l_shipdate), '%Y-%m-%d %H:%M:%S.%f') AS date_releve
FROM lineitem WHERE l_suppkey % 10 <> 0 GROUP BY l_suppkey, l_partkey"""
Q["stock_alerts"] = "SELECT * FROM stock"
LOW = rate("count(*) FILTER (alerte_rupture)")
Q["stockout_rate"] = metric("rupture_stock", "taux_rupture", LOW, "10", f"{LOW} <= 10", "FROM stock")
Q["incremental_extract"] = """
SELECT 'ventes' AS source, event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS date_maj, event_type, value FROM events
WHERE ts > (SELECT max(ts) FROM events WHERE ts < TIMESTAMP '2024-01-20')
UNION ALL SELECT 'stocks', event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f'), event_type, value FROM events"""
Q["stage_parquet"] = f"""
SELECT transaction_id, {DAY}, produit_id, magasin_id, {money('montant_c')} AS montant_total_xaf, quantite FROM tx"""
Q["upsert_table"] = f"""
SELECT transaction_id, {DAY}, produit_id, magasin_id, {money('montant_c')} AS montant_total_xaf, quantite FROM {LAST}"""
Q["upsert_stream"] = Q["upsert_table"]
LAST_OF_MONTH = """QUALIFY row_number() OVER (PARTITION BY transaction_id, year(date_transaction), month(date_transaction)
  ORDER BY date_transaction DESC, produit_id DESC, magasin_id DESC, montant_c DESC, quantite DESC) = 1"""
CTES["online"] = f"SELECT * REPLACE (quantite + 1 AS quantite) FROM tx WHERE canal_vente = 'En ligne' {LAST_OF_MONTH}"
CTES["last_of_month"] = f"SELECT * FROM tx {LAST_OF_MONTH}"
Q["upsert_partitions"] = f"""
SELECT transaction_id, {DAY}, produit_id, magasin_id, {money('montant_c')} AS montant_total_xaf, quantite, canal_vente,
  {big('year(t.date_transaction)')} AS annee, {big('month(t.date_transaction)')} AS mois
FROM (SELECT * FROM online UNION ALL SELECT * FROM last_of_month b WHERE NOT EXISTS (SELECT 1 FROM online o
  WHERE o.transaction_id = b.transaction_id AND date_trunc('month', o.date_transaction) = date_trunc('month', b.date_transaction))) t"""
Q["daily_volume_stream"] = """
SELECT strftime(jour, '%Y-%m-%d') AS jour, n AS nb_lignes, 'OK' AS statut
FROM (SELECT date_trunc('day', ts) AS jour, count(*) AS n FROM events GROUP BY 1)"""


def loads() -> list[str]:
    rows = [("staging.clients", "customer", "replace"), ("staging.transactions", "lineitem", "replace"),
            ("staging.produits", "part", "replace"), ("staging.magasins", "supplier", "replace"),
            ("marts.ca_mensuel", "monthly", "replace"),
            ("marts.top_produits", "(SELECT DISTINCT produit_id FROM tx LIMIT 20)", "replace"),
            ("marts.performance_magasins", "(SELECT DISTINCT magasin_id FROM tx)", "replace"),
            ("marts.segmentation_rfm", "(SELECT DISTINCT client_id FROM tx)", "replace"),
            ("staging.magasins", "supplier", "append"), ("staging.clients", None, "append")]
    out = []
    for table, source, strategy in rows:
        n = f"(SELECT count(*) FROM {source})" if source else "0"
        status = "succès" if source else "ignoré (DataFrame vide)"
        out.append(f"SELECT '{table}' AS table_cible, {big(n)} AS nb_lignes_source, {big(n)} AS nb_lignes_inserees, "
                   f"{big('0')} AS nb_lignes_mises_a_jour, {big('0')} AS nb_lignes_rejetees, "
                   f"'{strategy}' AS strategie, '{status}' AS statut, 'soir' AS pipeline_run_id")
    return out


Q["load_journal"] = union(*loads())
Q["load_report"] = f"""
SELECT statut, count(*) AS nb_chargements, {big('sum(nb_lignes_inserees)')} AS nb_lignes_inserees
FROM ({union(*loads())}) GROUP BY statut"""
Q["load_summary"] = f"""
SELECT split_part(table_cible, '.', 1) AS etape, split_part(table_cible, '.', 2) AS nom_table, nb_lignes_inserees AS nb_lignes, statut
FROM ({union(*loads())}) WHERE NOT (table_cible IN ('staging.magasins', 'staging.clients') AND strategie = 'replace')"""
CTES["after_mark"] = """
SELECT * FROM events WHERE ts > (SELECT max(ts) FROM events WHERE ts < TIMESTAMP '2024-01-20')"""


def extractions() -> list[str]:
    whole = [("clients", "customer"), ("transactions", "lineitem"), ("produits", "part"), ("magasins", "supplier")]
    rows = [(name, "complète", f"(SELECT count(*) FROM {table})", 1, "succès", "soir") for name, table in whole]
    for run in ("soir", "nuit"):
        rows += [("ventes", "delta", "(SELECT count(*) FROM after_mark)", 1, "succès", run), ("taux", "complète", "NULL", 3, "échec", run)]
    return [f"SELECT '{name}' AS source, '{mode}' AS mode, {big(n)} AS nb_lignes, {big(tried)} AS nb_tentatives, "
            f"'{status}' AS statut, '{run}' AS pipeline_run_id" for name, mode, n, tried, status, run in rows]


Q["extraction_journal"] = union(*extractions())
Q["extraction_report"] = f"""
SELECT source, mode, count(*) AS nb_extractions, {big("count(*) FILTER (statut = 'échec')")} AS nb_echecs,
  {big('sum(nb_tentatives - 1)')} AS nb_reprises, {big('coalesce(sum(nb_lignes), 0)')} AS nb_lignes
FROM ({union(*extractions())}) GROUP BY source, mode"""

CTES["journal"] = """
SELECT 'staging.t' || (o_orderkey % 4) AS table_cible, CAST(floor(o_totalprice) AS BIGINT) AS inserted, o_orderkey % 5 AS rejected,
  o_orderstatus = 'P' AND o_orderkey % 3 = 0 AS failed, o_orderdate + INTERVAL 2 HOUR + to_seconds(o_orderkey % 7200) AS debut,
  o_orderdate + INTERVAL 2 HOUR + to_seconds(o_orderkey % 7200 + CAST(floor(o_totalprice) AS BIGINT) % 9000) AS fin,
  CASE WHEN o_custkey % 50 <> 0 THEN strftime(o_orderdate, '%Y-%m-%d') || '-' || (o_custkey % 3) END AS run FROM orders"""
CTES["runs"] = f"""
SELECT *, CASE WHEN lost THEN 'échec' ELSE 'succès' END AS statut, CAST(debut AS DATE) AS jour,
  epoch_us(fin) - epoch_us(CAST(CAST(debut AS DATE) AS TIMESTAMP)) < 6 * 3600 * 1000000::BIGINT AS in_time,
  epoch_us(fin) - epoch_us(debut) < 2 * 3600 * 1000000::BIGINT AS short
FROM (SELECT run, min(debut) AS debut, max(fin) AS fin, count(DISTINCT table_cible) AS tables, count(*) AS n,
  {big('count(*) FILTER (failed)')} AS failures, {big('sum(inserted)')} AS inserted, {big('sum(rejected)')} AS rejected,
  bool_or(failed AND fin = last) AS lost
  FROM (SELECT *, max(fin) OVER (PARTITION BY run, table_cible) AS last FROM journal WHERE run <> '') GROUP BY run)"""


def served(good: str) -> str:
    return f"CASE WHEN {good} THEN 'OK' ELSE 'ALERTE' END AS statut_service"


Q["pipeline_runs"] = f"""
SELECT run AS pipeline_run_id, strftime(jour, '%Y-%m-%d') AS jour, strftime(debut, '%Y-%m-%d %H:%M:%S.%f') AS debut,
  strftime(fin, '%Y-%m-%d %H:%M:%S.%f') AS fin, (epoch_us(fin) - epoch_us(debut)) // 1000000 AS duree_secondes,
  tables AS nb_tables, n AS nb_chargements, failures AS nb_echecs, inserted AS nb_lignes_inserees,
  rejected AS nb_lignes_rejetees, statut, in_time AS a_l_heure, short AS dans_le_delai,
  {served("statut = 'succès' AND in_time AND short")} FROM runs"""
Q["success_rate"] = f"""
SELECT strftime(jour, '%Y-%m-%d') AS jour, n AS nb_executions, good AS nb_succes, {big('all_n')} AS nb_executions_fenetre,
  {big('all_good')} AS nb_succes_fenetre, {half_even('(CAST(all_good AS DOUBLE) / all_n) * 100', 2)} AS taux_succes_pct,
  {served('all_good * 100 > all_n * 95')}
FROM (SELECT *, sum(n) OVER w AS all_n, sum(good) OVER w AS all_good
  FROM (SELECT jour, count(*) AS n, count(*) FILTER (statut = 'succès') AS good FROM runs GROUP BY jour)
  WINDOW w AS (ORDER BY jour RANGE BETWEEN INTERVAL 29 DAY PRECEDING AND CURRENT ROW))"""
Q["availability"] = f"""
SELECT strftime(d, '%Y-%m') AS mois_annee, count(*) AS nb_jours_ouvres, count(jour) AS nb_jours_servis,
  {half_even('(CAST(count(jour) AS DOUBLE) / count(*)) * 100', 2)} AS disponibilite_pct, {served('count(jour) * 100 >= count(*) * 99')}
FROM (SELECT CAST(unnest(generate_series(CAST(min(jour) AS TIMESTAMP), CAST(max(jour) AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS d FROM runs)
LEFT JOIN (SELECT DISTINCT jour FROM runs WHERE statut = 'succès') ON jour = d WHERE isodow(d) < 6 GROUP BY 1"""
Q["append_table"] = "SELECT magasin_id, CAST(2 AS BIGINT) AS nb FROM stores"
Q["partitioned_fact"] = f"""
SELECT {big('year(date_transaction)')} AS annee, {big('month(date_transaction)')} AS mois, count(*) AS nb_lignes,
  {money('sum(montant_c)')} AS ca_total_xaf FROM tx WHERE year(date_transaction) <> 1998 OR canal_vente = 'En ligne'
  OR strftime(date_transaction, '%Y-%m') NOT IN (SELECT strftime(date_transaction, '%Y-%m') FROM tx WHERE canal_vente = 'En ligne')
GROUP BY 1, 2"""
DONE = "'succès' AS statut"
CTES["staged_faulty"] = f"""
SELECT * FROM faulty WHERE transaction_id <> '' AND montant_c BETWEEN {LO} AND {HI} AND quantite > 0 AND statut <> 'Annulé'
QUALIFY row_number() OVER (PARTITION BY transaction_id ORDER BY date_transaction DESC, {TX_TIES}) = 1"""
CTES["faulty_groups"] = """
SELECT DISTINCT date_trunc('month', t.date_transaction), m.magasin_id, p.categorie FROM staged_faulty t
LEFT JOIN stg_st m ON m.magasin_id = t.magasin_id LEFT JOIN stg_pr p ON p.produit_id = t.produit_id"""
REJECTED = "(SELECT count(*) FROM routed WHERE motif_rejet IS NOT NULL)"
RUN_ROWS = {
    "staging.clients": "(SELECT count(*) FROM cleaned_clients)", "staging.transactions": "(SELECT count(*) FROM valid)",
    "staging.produits": "(SELECT count(*) FROM part)", "staging.magasins": "(SELECT count(*) FROM supplier)",
    "marts.ca_mensuel": "(SELECT count(*) FROM (SELECT DISTINCT strftime(date_transaction, '%Y-%m'), magasin_id FROM valid))",
    "marts.top_produits": "(SELECT count(*) FROM (SELECT DISTINCT produit_id FROM valid LIMIT 20))",
    "marts.performance_magasins": "(SELECT count(DISTINCT magasin_id) FROM valid)",
    "marts.segmentation_rfm": "(SELECT count(DISTINCT client_id) FROM valid)",
    "marts.mart_ventes": "(SELECT count(*) FROM faulty_groups)", "marts.mart_produits": "(SELECT count(*) FROM part)",
    "marts.mart_clients": "(SELECT count(DISTINCT client_id) FROM untidy WHERE client_id <> '' AND nom <> '')"}
Q["daily_run"] = union(*[f"SELECT '{table}' AS table_cible, {big(n)} AS nb_lignes_inserees, "
                         f"{big(REJECTED if table == 'staging.transactions' else '0')} AS nb_lignes_rejetees, {DONE}" for table, n in RUN_ROWS.items()])
STAGE_ROWS = {
    ("extract", "clients"): "(SELECT count(*) FROM customer)", ("extract", "transactions"): "(SELECT count(*) FROM lineitem)",
    ("extract", "produits"): "(SELECT count(*) FROM part)", ("extract", "magasins"): "(SELECT count(*) FROM supplier)",
    **{("transform", table.split(".")[1]): n for table, n in RUN_ROWS.items() if table.split(".")[1] not in
       ("mart_ventes", "mart_clients", "mart_produits")},
    ("transform", "transactions_rejetees"): REJECTED,
    ("models", "stg_clients"): f"(SELECT count(*) FROM ({Q['stg_clients']}))", ("models", "stg_transactions"): "(SELECT count(*) FROM staged_faulty)",
    ("models", "stg_produits"): "(SELECT count(*) FROM part)", ("models", "stg_magasins"): f"(SELECT count(*) FROM ({Q['stg_stores']}))",
    **{("models", table.split(".")[1]): n for table, n in RUN_ROWS.items() if table.startswith("marts.mart_")},
    ("quality", "controles"): "4 + 2 + 4 + 10 + 1",  # critical columns, duplicates, amounts, three keys, volume
}
Q["staged_run"] = union(
    *[f"SELECT '{stage}' AS etape, '{table}' AS nom_table, {big(n)} AS nb_lignes, CAST(NULL AS VARCHAR) AS statut"
      for (stage, table), n in STAGE_ROWS.items()],
    *[f"SELECT '{table.split('.')[0]}' AS etape, '{table.split('.')[1]}' AS nom_table, {big(n)} AS nb_lignes, {DONE}"
      for table, n in RUN_ROWS.items()])


def oracle_sql() -> dict[str, str]:
    return {name: with_ctes(body) for name, body in Q.items()}
