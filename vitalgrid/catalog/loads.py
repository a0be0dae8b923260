"""The raw loads and the table operations, each through files and a catalog, as queries.

Raw rows are taken from the test tables by expressions that Spark and DuckDB read alike, written as
gzip CSV with the columns of the raw table, loaded, and read back from the table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalgrid.catalog.models_sql import model_sql
from vitalgrid.catalog.registry import query
from vitalgrid.operators import usage
from vitalgrid.plans.graph import build_models
from vitalgrid.session import scratch_dir
from vitalgrid.sources import tables
from vitalgrid.sources.csv import FORMAT, ingest
from vitalgrid.sources.derived import bronze
from vitalgrid.sources.registry import SOURCES

DATABASE = "vitalgrid_loads"
KEEP = 3  # versions of a loaded table that stay for readers of earlier runs

# raw table -> (test table, column -> expression in both dialects)
RAW = {
    "mimiciv.icustays": ("orders", {
        "subject_id": "o_custkey", "hadm_id": "o_orderkey", "stay_id": "o_orderkey + 30000000",
        "intime": "o_orderdate", "outtime": "case when o_orderkey % 5 > 0 then o_orderdate + interval '3' day end",
    }),
    "mimiciv.inputevents": ("lineitem", {
        "subject_id": "l_suppkey", "hadm_id": "l_orderkey", "stay_id": "l_orderkey + 30000000",
        "starttime": "l_shipdate", "endtime": "l_shipdate + interval '90' minute", "itemid": "cast(l_partkey as int)",
        "amount": "l_quantity", "amountuom": "'mg'", "rate": "case when l_tax > 0.02 then l_discount end",
        "rateuom": "case when l_linenumber = 1 then 'mg/kg/min' else 'mcg/kg/min' end",
        "linkorderid": "l_orderkey * 10 + l_linenumber", "patientweight": "l_extendedprice / 1000",
    }),
    "mimiciv.outputevents": ("events", {
        "subject_id": "user_id", "hadm_id": "user_id + 20000000", "stay_id": "user_id + 30000000",
        "charttime": "ts", "itemid": "cast(event_id % 1000 as int)", "value": "value",
    }),
    "mimiciv.d_items": ("part", {"itemid": "cast(p_partkey as int)", "label": "p_name", "category": "p_type"}),
    "mimiciv.patients": ("customer", {
        "subject_id": "c_custkey", "gender": "case when c_custkey % 2 = 0 then 'F' else 'M' end",
        "anchor_age": "cast(18 + c_custkey % 70 as int)", "anchor_year": "cast(2100 + c_nationkey as int)",
        "dod": "case when c_custkey % 4 = 0 then cast('2020-02-29' as date) end",
    }),
    "mimiciv.admissions": ("orders", {
        "subject_id": "o_custkey", "hadm_id": "o_orderkey", "admittime": "o_orderdate",
        "dischtime": "o_orderdate + interval '5' day",
        "deathtime": "case when o_orderstatus = 'F' then o_orderdate + interval '4' day end",
        "hospital_expire_flag": "case when o_orderstatus = 'F' then 1 else 0 end",
    }),
    "mimiciv.labevents": ("lineitem", {
        "labevent_id": "l_orderkey * 10 + l_linenumber", "subject_id": "l_suppkey",
        "hadm_id": "case when l_linenumber > 1 then l_orderkey end", "specimen_id": "l_orderkey",
        "itemid": "cast(50000 + l_partkey % 2000 as int)", "charttime": "l_shipdate",
        "storetime": "l_shipdate + interval '20' minute", "value": "cast(l_linenumber as varchar(9))",
        "valuenum": "l_quantity", "valueuom": "l_returnflag",
    }),
    "mimiciv.d_labitems": ("part", {"itemid": "cast(50000 + p_partkey as int)", "label": "p_brand"}),
    "mimiciv.prescriptions": ("lineitem", {
        "subject_id": "l_suppkey", "hadm_id": "l_orderkey", "starttime": "l_shipdate",
        "stoptime": "l_shipdate + interval '2' day", "drug_type": "case when l_linenumber = 2 then 'BASE' else 'MAIN' end",
        "drug": """concat('drug, "', l_returnflag, '" ', cast(l_partkey % 50 as varchar(9)))""", "route": "l_linestatus",
    }),
    "mimiciv.microbiologyevents": ("events", {
        "micro_specimen_id": "event_id", "subject_id": "user_id", "hadm_id": "user_id + 20000000",
        "chartdate": "date_trunc('day', ts)", "charttime": "case when event_id % 5 > 0 then ts end",
        "spec_type_desc": "event_type", "org_itemid": "cast(80000 + event_id % 100 as int)",
        "org_name": "case when value > 50 then 'E. COLI' else '' end",
    }),
    "eicu.patient": ("customer", {
        "patientunitstayid": "c_custkey", "patienthealthsystemstayid": "c_custkey * 2",
        "gender": "case when c_custkey % 2 = 0 then 'Female' else 'Male' end",
        "age": "case when c_custkey % 9 = 0 then '> 89' else cast(c_custkey % 89 as varchar(9)) end",
        "hospitaladmittime24": "concat(cast(10 + c_custkey % 14 as varchar(9)), ':05:00')", "hospitaldischargetime24": "'08:30:00'",
        "unitadmittime24": "'00:00:01'", "unitdischargetime24": "''", "hospitaldischargeoffset": "c_custkey * 7",
        "hospitaldischargestatus": "case when c_acctbal < 0 then 'Expired' else 'Alive' end",
        "unitdischargeoffset": "case when c_custkey % 6 > 0 then c_custkey * 5 end", "unitdischargestatus": "c_mktsegment",
    }),
    "eicu.diagnosis": ("orders", {
        "patientunitstayid": "o_custkey", "diagnosisoffset": "o_orderkey % 5000 - 60",
        "diagnosisstring": "concat('cardiovascular|', o_orderpriority)",
    }),
    "eicu.nurse_charting": ("events", {
        "patientunitstayid": "user_id", "nursingchartoffset": "event_id % 9000",
        "nursingchartcelltypevallabel": "event_type", "nursingchartvalue": "cast(event_id % 250 as varchar(9))",
    }),
}


def _register(name: str, origin: str, columns: dict[str, str]) -> None:
    source = SOURCES[name]
    stated = ", ".join(f"{e} as {c}" for c, e in columns.items())

    @query(f"load_{source.dataset}_{source.name}", f"select {stated} from {origin}")
    def _(s):
        folder = scratch_dir(s.spark, f"raw_{source.name}")
        rows = s[origin].selectExpr(*[f"{e} as {c}" for c, e in columns.items()])
        writer = rows.write.options(**FORMAT).option("compression", "gzip")
        writer.option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS").csv(f"{folder}/{source.path}")
        # A large table is several files, as here; a small one is read in one task as well.
        database = f"{DATABASE}_{source.dataset}"
        written = ingest(s.spark, source, folder, database)
        tables.drop_old_versions(s.spark, database, source.name, KEEP)
        stored = s.spark.table(f"{database}.{source.name}")
        if stored.count() != written:
            raise RuntimeError("the table does not hold the rows that were written")
        return stored


for _name, (_origin, _expressions) in RAW.items():
    _register(_name, _origin, _expressions)


@query("ensure_table", "select * from nation")
def _(s):
    """A table is made once, empty; asking again changes nothing."""
    name = "ensured"
    tables.ensure_database(s.spark, DATABASE)
    s.spark.sql(f"DROP TABLE IF EXISTS {DATABASE}.{name}")
    schema = s["nation"].schema
    made = [tables.ensure_table(s.spark, DATABASE, name, schema) for _ in range(2)]
    if made != [True, False] or s.spark.table(f"{DATABASE}.{name}").count():
        raise RuntimeError("the table was not made exactly once")
    tables.load_table(s.spark, s["nation"], DATABASE, name, "append")
    return s.spark.table(f"{DATABASE}.{name}")


@query("replace_and_verify", "select * from supplier")
def _(s):
    """Half of a table, then all of it: the second load replaces the first."""
    half = s["supplier"].where("s_suppkey % 2 = 0")
    tables.replace_and_verify(s.spark, half, DATABASE, "replaced")
    begun = s.spark.table(f"{DATABASE}.replaced")
    tables.replace_and_verify(s.spark, s["supplier"], DATABASE, "replaced")
    if begun.count() != half.count():
        raise RuntimeError("a reader of the old version lost its rows")
    tables.drop_old_versions(s.spark, DATABASE, "replaced", KEEP)
    return s.spark.table(f"{DATABASE}.replaced")


@query(
    "list_tables",
    " union all ".join(f"select 'listed_{t}' as name, count(*) as n from {t}" for t in ("region", "nation", "supplier")),
)
def _(s):
    """The tables of a database by name, with their rows."""
    for name in ("region", "nation", "supplier"):
        tables.load_table(s.spark, s[name], DATABASE, f"listed_{name}")
        tables.drop_old_versions(s.spark, DATABASE, f"listed_{name}", KEEP)
    listed = tables.list_tables(s.spark, DATABASE).where("tableName like 'listed%'").orderBy("tableName")
    counts = [
        s.spark.table(f"{DATABASE}.{r.tableName}").agg(F.lit(r.tableName).alias("name"), F.count(F.lit(1)).alias("n"))
        for r in listed.collect()
    ]
    return reduce(DataFrame.unionByName, counts)


BUILT = ("ventilator_setting", "oxygen_delivery", "ventilation", "icustay_times", "icustay_hourly")


@query(
    "build_models",
    model_sql("sofa", " union all ".join(f"select '{m}' as model, count(*) as n, cast(sum(stay_id) as bigint) as stays from {m}" for m in BUILT)),
)
def _(s):
    """Models written as tables, parents first, read back from the catalog."""
    database = f"{DATABASE}_models"
    build_models(s.spark, bronze(s["events"]), ["ventilation", "icustay_hourly"], database)
    for m in BUILT:
        tables.drop_old_versions(s.spark, database, m, KEEP)
    sums = [
        s.spark.table(f"{database}.{m}").agg(
            F.lit(m).alias("model"), F.count(F.lit(1)).alias("n"), F.sum("stay_id").alias("stays")
        )
        for m in BUILT
    ]
    return reduce(DataFrame.unionByName, sums)


@query(
    "usage_log",
    """
with m as (
  select conv_id, turn, role, length(text) as size, conv_id % 7 = 0 and turn = 1 as cut from conversations
)
select 'session-' || cast(conv_id as varchar) as session,
  count(*) filter (where not cut) as requests,
  cast(coalesce(sum(size) filter (where not cut), 0) as bigint) as input,
  count(*) filter (where cut) as malformed
from m group by conv_id""",
)
def _(s):
    """A folder of JSON lines, one file set per session, some lines cut off in the middle."""
    folder = scratch_dir(s.spark, "usage_log")
    usage_of = F.struct(F.length("text").cast("long").alias("input_tokens"), F.lit(0).cast("long").alias("output_tokens"))
    line = F.to_json(
        F.struct(
            F.concat_ws("-", "conv_id", "turn").alias("requestId"),
            F.struct(F.col("role").alias("model"), usage_of.alias("usage")).alias("message"),
        )
    )
    cut = (F.col("conv_id") % 7 == 0) & (F.col("turn") == 1)
    logged = s["conversations"].select(
        F.concat(F.lit("session-"), "conv_id").alias("session"), F.when(cut, F.left(line, F.length(line) - 9)).otherwise(line).alias("value")
    )
    # Spark names the folder of a session and the files itself.
    logged.write.partitionBy("session").option("compression", "none").text(f"{folder}/log")
    lines = usage.read_usage_lines(s.spark, f"{folder}/log", "*.txt")
    named = lines.withColumn("session", F.regexp_replace("session", "^session=", ""))
    broken = named.groupBy("session").agg(F.count_if("malformed").alias("malformed"))
    totals = usage.usage_records(named).groupBy("session").agg(F.count(F.lit(1)).alias("requests"), F.sum("input").alias("input"))
    return broken.join(totals, "session", "left").select(
        "session", F.coalesce("requests", F.lit(0)).alias("requests"), F.coalesce("input", F.lit(0)).alias("input"), "malformed"
    )
