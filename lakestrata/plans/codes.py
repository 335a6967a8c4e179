"""Fixed values of the source data and of the published tables.

Column names, code lists, class bounds and labels below must be exactly these:
they are what the source files contain and what readers of the tables expect.
Where a list follows a rule, the rule is written instead of the list.
"""

from __future__ import annotations

# --- name of the table of works in the Intermediate and Gold layers --------------------------
WORKS_TABLE = "Works"

# --- what the largest tables are joined on, and so stored by -----------------------------------
BUCKET_KEYS = {"dpe_france_2021": "N°DPE", "predicted_renov": "id_dpe"}
# --- columns of a table of dwelling documents ----------------------------------------------------
DOCUMENT_CODE, DOCUMENT_TEXT = "Code_commune_INSEE", "xml"

# --- survey columns -> table columns -------------------------------------------------------
OWNER_COLUMNS = {
    "Respondent_Serial": "id_owner", "main_rs1": "gender", "main_rs2_c": "age", "main_rs5": "work_state",
    "main_rs6": "job", "main_q100_2": "home_state", "main_Q44": "arrival_date", "main_Q1_97": "has_done_renov",
    "main_RS102": "nb_persons_home", "main_RS182": "income", "main_Q73": "amount_help", "main_Q75": "loan_amount",
    "main_Q76": "loan_duration", "main_q77": "loan_rate",
}
DWELLING_COLUMNS = {
    "main_Q101": "type", "main_Q102": "construction_date", "main_Q103": "heating_system",
    "main_Q104": "hot_water_system", "main_Q32": "heating_production", "main_Q34": "heating_emission",
    "main_q41_c": "surface", "main_Q1_97": "has_done_renov", "main_Q43": "DPE_before",
    "main_Q52": "thermal_comfort", "main_Q53": "energy_reduction", "main_Q38": "adjoining",
    "main_Q39": "n_floors", "main_Q40": "floor",
}
# The value of work 13 is the library's own.
ROOF_INSULATION_ALONE = "roof_insulation_alone"
WORK_TYPES = {
    11: "roof_with_insulation", 12: "rooth_without_insulation", 13: ROOF_INSULATION_ALONE,
    14: "insulation_flooring_attic", 15: "roof_terrace_with_insulation", 16: "roof_terrase_without_insulation",
    21: "ext_wall_with_insulation", 22: "ext_wall_without_insulation", 23: "int_wall_with_insulation",
    24: "int_wall_without_insulation", 31: "down_flooring_with_insulation", 32: "down_flooring_without_insulation",
    41: "opening_common_areas", 42: "opening_accomodation", 43: "ext_doors", 51: "heating_system",
    52: "heating_regulation", 53: "hot_water", 54: "insulation", 55: "ventilation_system",
    56: "air_consitioning_system",
}
WORK_QUESTIONS = {"start_date": "main_Q5_{}", "end_date": "main_Q6_{}", "done_by": "main_Q18_{}", "amount": "main_Q20_{}"}
# Work 41 was not asked who did it nor what it cost.
WORK_NOT_ASKED = {41: ("done_by", "amount")}
MULTI_CHOICE_COLUMNS = (
    [f"main_q2_{i}" for i in range(1, 9)] + [f"main_q3_{i}" for i in range(1, 8)]
    + [f"main_q4_{i}" for i in range(1, 9)] + [f"main_Q70_{i:02d}" for i in range(1, 15)]
    + [f"main_Q71_{i:02d}" for i in range(1, 15) if i != 2] + [f"main_Q74_{i}" for i in range(1, 6)]
    + [f"main_q81_{i}" for i in range(1, 8)]
)
CODEBOOK_ANSWERS = [*range(0, 23), 99]
# Question parts that never collapse to one row per question.
CODEBOOK_SINGLE = ["", "Variable filtre", "BLOCS Travaux"]

# --- survey recodes --------------------------------------------------------------------------
INCOME_SENTINELS = [10, 11, 99]
PERSONS_SENTINELS = [99]
DWELLING_TYPES = [1, 2]
HEATING_SOURCES = {6: [1, 2], 5: [3, 4, 5], 3: [6, 7], 2: [8, 10], 1: [9], 4: [11]}
RETROFIT_YEARS = [2014, 2015, 2016]
FIRST_RETROFIT_YEAR_BASE = 2013

# --- certificates ------------------------------------------------------------------------------
GAS = ["Gaz naturel"]
POLLUTING_GAS = ["Fioul domestique", "GPL", "Propane", "Butane"]
WOOD_COAL = [
    "Bois – Plaquettes forestières", "Charbon", "Bois – Plaquettes d’industrie", "Bois – Bûches",
    "Bois – Granulés (pellets) ou briquettes",
]
OTHER_ENERGY = ["Réseau de Chauffage urbain", "Réseau de Froid Urbain"]
ELECTRICITY = ["Électricité", "Électricité d'origine renouvelable utilisée dans le bâtiment"]
KNOWN_ENERGY = POLLUTING_GAS + GAS + ELECTRICITY + WOOD_COAL + OTHER_ENERGY
HEAT_PUMP_MARKERS = ["PAC", "pompe à chaleur"]
CONSTRUCTION_BOUNDS = [1949, 1975, 1982, 1990, 2001, 2012]
SURFACE_BOUNDS = [70, 115]
CONSUMPTION_BOUNDS = [50, 90, 150, 230, 330, 450]
EMISSION_BOUNDS = [5, 10, 20, 35, 55, 80]
GRADES = ["A", "B", "C", "D", "E", "F", "G"]

# --- published labels ----------------------------------------------------------------------------
QUALITY_LABELS = ["insuffisante", "moyenne", "bonne", "très bonne"]
GRADE_LABELS = {0: "A", 1: "B", 2: "C", 3: "D", 4: "E", 5: "F", 6: "G"}
HEATING_LABELS = {
    1: "Gaz", 2: "fioul, GPL, propane, butane", 3: " bois, charbon", 4: "Autres", 5: "PAC", 6: "electricité",
}
SURFACE_LABELS = {1: "<70 m²", 2: "70-115 m²", 3: ">115 m²"}
CONSTRUCTION_LABELS = {
    1: "<1948", 2: "1949-1974", 3: "1975-1981", 4: "1982-1989", 5: "1990-2000", 6: "2001-2011", 7: ">2012",
}
# The roof label is fed by the carpentry flag, as in the published tables.
RETROFIT_LABELS = {
    "renov_walls": "murs", "renov_carpentry": "toiture", "renov_flooring": "plancher", "renov_ceiling": "plafond",
    "renov_energy": "énergie",
}
REGION_SHORT = ("Bretagne", "BZH")
OVERSEAS_FROM = 96
CORSICA = ["2A", "2B"]

# --- weather ----------------------------------------------------------------------------------------
WEATHER_COLUMNS = {
    "Direction du vent moyen 10 mn": "wind_direction", "Vitesse du vent moyen 10 mn": "wind_speed",
    "Température": "temp_kelvin", "Humidité": "humidity",
    "Hauteur de la base des nuages de l'étage inférieur": "heigh_clouds", "Température (°C)": "temp_degree",
    "Altitude": "altitude",
}
WEATHER_DEPARTMENT = "department (code)"
YEARLY_MEASURES = ["wind_speed", "humidity", "temp_degree"]
NEIGHBOUR_COLUMNS = [f"Voisin_{i}" for i in range(1, 11)]

# --- feature sets --------------------------------------------------------------------------------------
RETROFIT_FEATURES = [
    "type", "construction_date", "surface", "heating_system", "hot_water_system", "heating_production",
    "DPE_consumption", "GES_emission", "humidity_0", "wind_speed_0", "temp_degree_0", "humidity_1", "wind_speed_1",
    "temp_degree_1", "humidity_2", "wind_speed_2", "temp_degree_2", "population", "n_development_licence",
    "n_construction_licence", "n_destruction_licence", "n_new_buildings", "department_number",
]
RETROFIT_ONE_HOT = [
    "hot_water_system", "type", "heating_system", "DPE_consumption", "GES_emission", "construction_date",
    "heating_production", "surface",
]
SURVEY_FEATURES = [
    "gender", "age", "occupation", "home_state", "nb_persons_home", "income", "type", "construction_date",
    "heating_system", "population", "n_development_licence", "n_construction_licence", "n_new_buildings",
    "n_destruction_licence", "department_number",
]
SURVEY_ONE_HOT = ["occupation", "department_number"]
CERTIFICATE_FEATURES = ["type", "construction_date", "heating_system", "hot_water_system", "heating_production"]
CERTIFICATE_ONE_HOT = ["heating_production"]
