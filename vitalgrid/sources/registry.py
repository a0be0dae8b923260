"""Declared schemas of the raw tables. Nothing is ever inferred from the data.

Columns are listed as in the public documentation of the two datasets, as far as any query here
reads or publishes them. A CSV source may carry more columns; they are dropped on read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

_TYPES = {
    "long": T.LongType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "ts": T.TimestampNTZType(),
    "date": T.DateType(),
}


@dataclass(frozen=True)
class Source:
    """A raw table: where it lies under the dataset root, its columns, and how it is partitioned."""

    dataset: str
    name: str
    path: str
    columns: dict[str, str]
    key: str  # column rows are spread by after an unsplittable read
    large: bool = False

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, _TYPES[t]) for c, t in self.columns.items()])


def _columns(text: str) -> dict[str, str]:
    pairs = (part.split(":") for part in text.split())
    return {name: kind for name, kind in pairs}


_ICU, _HOSP = "icu", "hosp"


def _mimic(module: str, name: str, key: str, columns: str, large: bool = False) -> Source:
    return Source("mimiciv", name, f"{module}/{name}.csv.gz", _columns(columns), key, large)


def _eicu(name: str, file: str, columns: str, large: bool = False) -> Source:
    return Source("eicu", name, f"{file}.csv.gz", _columns(columns), "patientunitstayid", large)


# Free-text measurement values and clock times are strings whatever they look like.
SOURCES = {
    f"{s.dataset}.{s.name}": s
    for s in (
        _mimic(_ICU, "icustays", "stay_id",
               "subject_id:long hadm_id:long stay_id:long intime:ts outtime:ts"),
        _mimic(_ICU, "chartevents", "stay_id",
               "subject_id:long hadm_id:long stay_id:long charttime:ts storetime:ts itemid:int "
               "value:string valuenum:double valueuom:string", large=True),
        _mimic(_ICU, "inputevents", "stay_id",
               "subject_id:long hadm_id:long stay_id:long starttime:ts endtime:ts itemid:int "
               "amount:double amountuom:string rate:double rateuom:string linkorderid:long "
               "patientweight:double"),
        _mimic(_ICU, "outputevents", "stay_id",
               "subject_id:long hadm_id:long stay_id:long charttime:ts itemid:int value:double"),
        _mimic(_ICU, "d_items", "itemid", "itemid:int label:string category:string"),
        _mimic(_HOSP, "patients", "subject_id",
               "subject_id:long gender:string anchor_age:int anchor_year:int dod:date"),
        _mimic(_HOSP, "admissions", "hadm_id",
               "subject_id:long hadm_id:long admittime:ts dischtime:ts deathtime:ts "
               "hospital_expire_flag:int"),
        _mimic(_HOSP, "labevents", "specimen_id",
               "labevent_id:long subject_id:long hadm_id:long specimen_id:long itemid:int "
               "charttime:ts storetime:ts value:string valuenum:double valueuom:string",
               large=True),
        _mimic(_HOSP, "d_labitems", "itemid", "itemid:int label:string"),
        _mimic(_HOSP, "prescriptions", "hadm_id",
               "subject_id:long hadm_id:long starttime:ts stoptime:ts drug_type:string "
               "drug:string route:string"),
        _mimic(_HOSP, "microbiologyevents", "micro_specimen_id",
               "micro_specimen_id:long subject_id:long hadm_id:long chartdate:ts charttime:ts "
               "spec_type_desc:string org_itemid:int org_name:string"),
        _eicu("patient", "patient",
              "patientunitstayid:long patienthealthsystemstayid:long gender:string age:string "
              "hospitaladmittime24:string hospitaldischargetime24:string unitadmittime24:string "
              "unitdischargetime24:string hospitaldischargeoffset:long "
              "hospitaldischargestatus:string unitdischargeoffset:long "
              "unitdischargestatus:string"),
        _eicu("diagnosis", "diagnosis",
              "patientunitstayid:long diagnosisoffset:long diagnosisstring:string"),
        _eicu("nurse_charting", "nurseCharting",
              "patientunitstayid:long nursingchartoffset:long "
              "nursingchartcelltypevallabel:string nursingchartvalue:string", large=True),
    )
}
