"""Item codes, plausibility ranges and word lists.

All values in this module are fixed values: results depend on them literally, trailing spaces in
device names included.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from vitalgrid.functions.cleaning import Bound, fio2_percent
from vitalgrid.operators.pivot import Measure

HEART_RATE = 220045
SPO2 = 220277
FIO2_CHARTED = 223835

_UP_TO_300 = Bound(0, 300)
_UP_TO_400 = Bound(0, 400)

VITALS = (
    Measure("heart_rate", (220045,), _UP_TO_300),
    Measure("sbp", (220179, 220050, 225309), _UP_TO_400),
    Measure("dbp", (220180, 220051, 225310), _UP_TO_300),
    Measure("mbp", (220052, 220181, 225312), _UP_TO_300),
    Measure("sbp_ni", (220179,), _UP_TO_400),
    Measure("dbp_ni", (220180,), _UP_TO_300),
    Measure("mbp_ni", (220181,), _UP_TO_300),
    Measure("resp_rate", (220210, 224690), Bound(0, 70)),
    Measure("temperature_site", (224642,), source="value", agg="max"),
    Measure("spo2", (220277,), Bound(0, 100, ("high",))),
    Measure("glucose", (225664, 220621, 226537), Bound(0)),
)
TEMPERATURE_F = (223761,)
TEMPERATURE_C = (223762,)
TEMPERATURE_BOUNDS = {223761: Bound(70, 120), 223762: Bound(10, 50)}

_PEEP = Bound(0, 100, ("low", "high"))
VENTILATOR_SETTINGS = (
    Measure("respiratory_rate_set", (224688,)),
    Measure("respiratory_rate_total", (224690,)),
    Measure("respiratory_rate_spontaneous", (224689,)),
    Measure("minute_volume", (224687,)),
    Measure("tidal_volume_set", (224684,)),
    Measure("tidal_volume_observed", (224685,)),
    Measure("tidal_volume_spontaneous", (224686,)),
    Measure("plateau_pressure", (224696,)),
    Measure("peep", (220339, 224700), _PEEP),
    Measure("fio2", (223835,), clean=lambda v: fio2_percent(v, "ventilator")),
    Measure("flow_rate", (224691,)),
    Measure("ventilator_mode", (223849,), source="value"),
    Measure("ventilator_mode_hamilton", (229314,), source="value"),
    Measure("ventilator_type", (223848,), source="value"),
)

O2_FLOW = {227582: 223834}  # recorded under two codes, read as one
O2_FLOW_ITEMS = (223834, 227582, 227287)
O2_FLOW_MAIN = 223834
O2_FLOW_ADDITIONAL = 227287
O2_DEVICE = 226732

GCS_MOTOR = 223901
GCS_VERBAL = 223900
GCS_EYES = 220739
GCS_INTUBATED = "No Response-ETT"

WEIGHT_ADMIT = 226512
WEIGHT_DAILY = 224639


def _at_most(high: float) -> Bound:
    return Bound(None, high, ("high",))


BLOOD_GAS = (
    Measure("specimen", (52033,), source="value"),
    Measure("aado2", (50801,)),
    Measure("baseexcess", (50802,)),
    Measure("bicarbonate", (50803,)),
    Measure("totalco2", (50804,)),
    Measure("carboxyhemoglobin", (50805,)),
    Measure("chloride", (50806,)),
    Measure("comments", (50807,), source="value"),
    Measure("calcium", (50808,)),
    Measure("glucose", (50809,), _at_most(10000)),
    Measure("hematocrit", (50810,), _at_most(100)),
    Measure("hemoglobin", (50811,)),
    Measure("lactate", (50813,), _at_most(10000)),
    Measure("methemoglobin", (50814,)),
    Measure("o2flow", (50815,)),
    Measure("fio2", (50816,), clean=lambda v: fio2_percent(v, "lab")),
    Measure("so2", (50817,), _at_most(100)),
    Measure("pco2", (50818,)),
    Measure("peep", (50819,)),
    Measure("ph", (50820,)),
    Measure("po2", (50821,)),
    Measure("potassium", (50822,)),
    Measure("requiredo2", (50823,)),
    Measure("sodium", (50824,)),
    Measure("temperature", (50825,)),
)
# Columns the blood gas table publishes, in order.
BLOOD_GAS_OUTPUT = (
    "subject_id", "hadm_id", "charttime", "specimen", "so2", "po2", "pco2", "fio2_chartevents",
    "fio2", "aado2", "ph", "baseexcess", "bicarbonate", "totalco2", "hematocrit", "hemoglobin",
    "carboxyhemoglobin", "methemoglobin", "chloride", "calcium", "temperature", "potassium",
    "sodium", "lactate", "glucose", "aado2_calc", "pao2fio2ratio",
)
ARTERIAL = "ART."

ANION_GAP = 50868
CHEMISTRY = (
    Measure("albumin", (50862,), _at_most(10)),
    Measure("globulin", (50930,), _at_most(10)),
    Measure("total_protein", (50976,), _at_most(20)),
    Measure("aniongap", (50868,), _at_most(10000)),
    Measure("bicarbonate", (50882,), _at_most(10000)),
    Measure("bun", (51006,), _at_most(300)),
    Measure("calcium", (50893,), _at_most(10000)),
    Measure("chloride", (50902,), _at_most(10000)),
    Measure("creatinine", (50912,), _at_most(150)),
    Measure("glucose", (50931,), _at_most(10000)),
    Measure("sodium", (50983,), _at_most(200)),
    Measure("potassium", (50971,), _at_most(30)),
)
ENZYMES = (
    Measure("alt", (50861,)),
    Measure("alp", (50863,)),
    Measure("ast", (50878,)),
    Measure("amylase", (50867,)),
    Measure("bilirubin_total", (50885,)),
    Measure("bilirubin_direct", (50883,)),
    Measure("bilirubin_indirect", (50884,)),
    Measure("ck_cpk", (50910,)),
    Measure("ck_mb", (50911,)),
    Measure("ggt", (50927,)),
    Measure("ld_ldh", (50954,)),
)
BLOOD_COUNT = (
    Measure("hematocrit", (51221,)),
    Measure("hemoglobin", (51222,)),
    Measure("mch", (51248,)),
    Measure("mchc", (51249,)),
    Measure("mcv", (51250,)),
    Measure("platelet", (51265,)),
    Measure("rbc", (51279,)),
    Measure("rdw", (51277,)),
    Measure("rdwsd", (52159,)),
    Measure("wbc", (51301,)),
)

URINE_ITEMS = (
    226559, 226560, 226561, 226584, 226563, 226564, 226565, 226567, 226557, 226558, 227488, 227489,
)
IRRIGANT_IN = 227488

EPINEPHRINE = 221289
NOREPINEPHRINE = 221906
DOPAMINE = 221662
DOBUTAMINE = 221653

# Lower-case substrings that mark an antibiotic.
ANTIBIOTIC_PATTERNS = (
    "adoxa", "ala-tet", "alodox", "amikacin", "amikin", "amoxicill", "amphotericin",
    "anidulafungin", "ancef", "clavulanate", "ampicillin", "augmentin", "avelox", "avidoxy",
    "azactam", "azithromycin", "aztreonam", "axetil", "bactocill", "bactrim", "bactroban",
    "bethkis", "biaxin", "bicillin l-a", "cayston", "cefazolin", "cedax", "cefoxitin",
    "ceftazidime", "cefaclor", "cefadroxil", "cefdinir", "cefditoren", "cefepime", "cefotan",
    "cefotetan", "cefotaxime", "ceftaroline", "cefpodoxime", "cefpirome", "cefprozil",
    "ceftibuten", "ceftin", "ceftriaxone", "cefuroxime", "cephalexin", "cephalothin",
    "cephapririn", "chloramphenicol", "cipro", "ciprofloxacin", "claforan", "clarithromycin",
    "cleocin", "clindamycin", "cubicin", "dicloxacillin", "dirithromycin", "doryx", "doxycy",
    "duricef", "dynacin", "ery-tab", "eryped", "eryc", "erythrocin", "erythromycin", "factive",
    "flagyl", "fortaz", "furadantin", "garamycin", "gentamicin", "kanamycin", "keflex", "kefzol",
    "ketek", "levaquin", "levofloxacin", "lincocin", "linezolid", "macrobid", "macrodantin",
    "maxipime", "mefoxin", "metronidazole", "meropenem", "methicillin", "minocin", "minocycline",
    "monodox", "monurol", "morgidox", "moxatag", "moxifloxacin", "mupirocin", "myrac",
    "nafcillin", "neomycin", "nicazel doxy 30", "nitrofurantoin", "norfloxacin", "noroxin",
    "ocudox", "ofloxacin", "omnicef", "oracea", "oraxyl", "oxacillin", "pc pen vk",
    "pce dispertab", "panixine", "pediazole", "penicillin", "periostat", "pfizerpen",
    "piperacillin", "tazobactam", "primsol", "proquin", "raniclor", "rifadin", "rifampin",
    "rocephin", "smz-tmp", "septra", "septra ds", "solodyn", "spectracef", "streptomycin",
    "sulfadiazine", "sulfamethoxazole", "trimethoprim", "sulfatrim", "sulfisoxazole", "suprax",
    "synercid", "tazicef", "tetracycline", "timentin", "tobramycin", "unasyn", "vancocin",
    "vancomycin", "vantin", "vibativ", "vibra-tabs", "vibramycin", "zinacef", "zithromax",
    "zosyn", "zyvox",
)
EXCLUDED_DRUG_TYPES = ("BASE",)
EXCLUDED_ROUTES = ("OU", "OS", "OD", "AU", "AS", "AD", "TP")
EXCLUDED_ROUTE_PARTS = ("ear", "eye")
EXCLUDED_DRUG_PARTS = ("cream", "desensitization", "ophth oint", "gel")

NEGATIVE_CULTURE = 90856

TRACH_DEVICES = ("Tracheostomy tube", "Trach mask ")
INVASIVE_DEVICES = ("Endotracheal tube",)
INVASIVE_MODES = (
    "(S) CMV", "APRV", "APRV/Biphasic+ApnPress", "APRV/Biphasic+ApnVol", "APV (cmv)", "Ambient",
    "Apnea Ventilation", "CMV", "CMV/ASSIST", "CMV/ASSIST/AutoFlow", "CMV/AutoFlow", "CPAP/PPS",
    "CPAP/PSV", "CPAP/PSV+Apn TCPL", "CPAP/PSV+ApnPres", "CPAP/PSV+ApnVol", "MMV", "MMV/AutoFlow",
    "MMV/PSV", "MMV/PSV/AutoFlow", "P-CMV", "PCV+", "PCV+/PSV", "PCV+Assist", "PRES/AC", "PRVC/AC",
    "PRVC/SIMV", "PSV/SBT", "SIMV", "SIMV/AutoFlow", "SIMV/PRES", "SIMV/PSV", "SIMV/PSV/AutoFlow",
    "SIMV/VOL", "SYNCHRON MASTER", "SYNCHRON SLAVE", "VOL/AC",
)
INVASIVE_MODES_HAMILTON = (
    "APRV", "APV (cmv)", "Ambient", "(S) CMV", "P-CMV", "SIMV", "APV (simv)", "P-SIMV", "VS", "ASV",
)
NONINVASIVE_DEVICES = ("Bipap mask ", "CPAP mask ")
NONINVASIVE_MODES_HAMILTON = ("DuoPaP", "NIV", "NIV-ST")
HIGH_FLOW_DEVICES = ("High flow nasal cannula",)
SUPPLEMENTAL_DEVICES = (
    "Non-rebreather", "Face tent", "Aerosol-cool", "Venti mask ", "Medium conc mask ",
    "Ultrasonic neb", "Vapomist", "Oxymizer", "High flow neb", "Nasal cannula",
)
NO_DEVICE = ("None",)

VENT_GAP_HOURS = 14

# Organ score limits: (limit, points), strictest first.
RESPIRATION_VENT = ((100, 4), (200, 3), (300, 2), (400, 1))
RESPIRATION_NOVENT = ((300, 2), (400, 1))
COAGULATION = ((20, 4), (50, 3), (100, 2), (150, 1))
LIVER = ((12.0, 4), (6.0, 3), (2.0, 2), (1.2, 1))
CNS = ((13, 14, 1), (10, 12, 2), (6, 9, 3))  # (from, to, points)
CNS_DEEP = 6  # below: 4 points
CREATININE = ((5.0, 4), (3.5, 3), (2.0, 2), (1.2, 1))
URINE_24H = ((200, 4), (500, 3))
MAP_LOW = 70


def temperature_celsius():
    """Average temperature in Celsius from both scales, two decimals."""
    from vitalgrid.functions.cleaning import bounded, to_celsius

    kept = bounded("valuenum", "itemid", TEMPERATURE_BOUNDS)
    scaled = to_celsius(kept, "itemid", TEMPERATURE_F)
    both = F.col("itemid").isin(*TEMPERATURE_F, *TEMPERATURE_C)
    return F.round(F.avg(F.when(both, scaled)), 2).alias("temperature")
