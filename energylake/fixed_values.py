"""Names, codes and thresholds of the certificate data.

Everything in this file is a fixed value: the records use these names and
codes, and published figures depend on these thresholds, so they are stated
as they are.  No logic lives here.
"""

# Record columns that are never analysed.
META_COLUMNS = [
    "_id", "_i", "_rand", "_score", "numero_dpe", "statut_geocodage",
    "adresse_complete_brut", "version_dpe", "methode_application_dpe",
    "modele_dpe", "code_postal_brut",
]
DATE_COLUMNS = [
    "date_etablissement_dpe", "date_reception_dpe", "date_fin_validite_dpe",
    "date_derniere_modification_dpe", "date_visite_diagnostiqueur",
]
TEXT_COLUMNS = [
    "numero_voie_ban", "provenance_id_rnb", "adresse_ban", "id_rnb",
    "adresse_brut", "nom_rue_ban", "nom_residence",
    "complement_adresse_batiment", "complement_adresse_logement",
    "numero_dpe_immeuble_associe", "nom_commune_ban", "nom_commune_brut",
]

# Class labels and their ranks.
LABEL_COLUMNS = ["etiquette_dpe", "etiquette_ges"]
CLASS_RANK = {"A": 1, "B": 2, "C": 3, "D": 4, "E": 5, "F": 6, "G": 7}
CLASS_SCORE = {"A": 0.5, "B": 1.5, "C": 2.5, "D": 3.5, "E": 4.5, "F": 5.5, "G": 6.5}
CLASS_COLOUR = {
    "A": "#009900", "B": "#33CC00", "C": "#99CC00", "D": "#FFCC00",
    "E": "#FF9900", "F": "#FF3300", "G": "#CC0000",
}
UNKNOWN_COLOUR = "#999999"
GOOD_CLASSES = ["B", "C"]
ADJACENT_TRANSITIONS = ["F->E", "E->D", "D->C", "C->B"]
CLASS_REFERENCE_MEAN = {"B": 75.0, "C": 130.0, "D": 210.0, "E": 290.0, "F": 380.0}

# Insulation quality words, lower case.
INSULATION_COLUMNS = [
    "qualite_isolation_menuiseries", "qualite_isolation_enveloppe",
    "qualite_isolation_murs", "qualite_isolation_plancher_bas",
]
INSULATION_RANK = {
    "insuffisante": 1, "moyenne": 2, "bonne": 3, "tres bonne": 4, "très bonne": 4,
}

# Columns by cleaning rule.
CRITICAL_COLUMNS = [
    "etiquette_dpe", "conso_5_usages_ef", "surface_habitable_logement",
    "cout_total_5_usages",
]
ZERO_COLUMNS = [
    "conso_refroidissement_ef", "conso_refroidissement_ep",
    "cout_refroidissement", "emission_ges_refroidissement",
    "production_electricite_pv_kwhep_par_an", "conso_5_usages_ef_energie_n2",
    "conso_ecs_ef_energie_n2", "conso_chauffage_ef_energie_n2",
    "cout_total_5_usages_energie_n2", "emission_ges_5_usages_energie_n2",
]
BOOLEAN_COLUMNS = [
    "presence_brasseur_air", "logement_traversant", "inertie_lourde",
    "presence_production_pv", "appartement_non_visite",
]
MEDIAN_COLUMNS = [
    "score_ban", "surface_habitable_immeuble", "annee_construction",
    "nombre_niveau_logement", "nombre_niveau_immeuble", "nombre_appartement",
    "hauteur_sous_plafond", "ubat_w_par_m2_k", "numero_etage_appartement",
    "conso_auxiliaires_ep", "conso_auxiliaires_ef", "cout_eclairage",
    "cout_chauffage", "cout_ecs", "conso_5_usages_par_m2_ep",
    "conso_5_usages_par_m2_ef", "conso_ecs_ef_energie_n1",
    "conso_chauffage_ef_energie_n1", "emission_ges_chauffage",
    "emission_ges_eclairage", "emission_ges_ecs",
    "emission_ges_5_usages_par_m2", "besoin_chauffage", "besoin_ecs",
    "deperditions_totales_logement", "deperditions_murs",
    "deperditions_enveloppe",
]
CLIPPED_COLUMNS = [
    "surface_habitable_immeuble", "surface_habitable_logement",
    "hauteur_sous_plafond", "nombre_appartement", "nombre_niveau_immeuble",
]
LOG_COLUMNS = [
    "conso_chauffage_ef_energie_n2", "conso_ecs_ef_energie_n2",
    "cout_total_5_usages_energie_n2", "conso_5_usages_ef_energie_n2",
]
QUANTILE_ERROR = 0.01
IQR_FACTOR = 1.5

# Construction periods, (low, high, label); both ends count, an
# open low end means strictly below high.
PERIOD_BANDS = [
    (None, 1975, "Avant 1975"),
    (1975, 1989, "1975-1989"),
    (1990, 2005, "1990-2005"),
    (2006, 2012, "2006-2012 (RT2005)"),
]
PERIOD_LAST = "Après 2012 (RT2012)"
PERIOD_ORDER = [
    "Avant 1975", "1975-1989", "1990-2005", "2006-2012 (RT2005)",
    "Après 2012 (RT2012)",
]

# Class bounds in kWh per square metre and year.
CLASS_LABELS = ["A", "B", "C", "D", "E", "F", "G"]
CLASS_BOUNDS = [70, 110, 180, 250, 330, 420]
SCALE_END = 500
PRICE_PER_KWH = 0.2516

# Regression inputs and settings.
CATEGORY_FEATURES = [
    "periode_construction", "type_batiment", "zone_climatique",
    "type_energie_principale_chauffage", "type_ventilation",
    "type_energie_principale_ecs",
]
NUMBER_FEATURES = ["nombre_niveau_logement", "hauteur_sous_plafond"]
UNKNOWN_LABEL = "Inconnu"
TARGET_RANGE = (10, 2000)
ALPHAS = [0.01, 0.1, 1.0, 10.0, 100.0, 1000.0]
FOLDS = 5
TEST_SHARE = 0.2
SEED = 42
R2_TOO_HIGH = 0.95
GAP_OVERFIT = 0.15
R2_MODERATE = 0.50

# Message topics and the bronze folder of each.
TOPIC_FOLDER = {"open-data-existant": "existant", "open-data-neuf": "neuf"}
UNKNOWN_FOLDER = "inconnu"
PAGE_SIZE = 100
BATCH_SIZE = 200
PUBLISH_OPTIONS = {"kafka.acks": "all", "kafka.retries": "3"}
