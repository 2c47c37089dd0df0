"""Group H: the models, end to end from the given tables."""

from __future__ import annotations

from wardline.plans import gold, silver
from wardline.registry import adapters as a
from wardline.registry import sql_models as m
from wardline.registry.layers import calendar, enriched, snapshot_two


def _adm(s, d):
    return silver.stg_admissions(a.admissions(s, d), a.as_of())


QUERIES = {
    "stg_admissions": _adm,
    "stg_treatments": lambda s, d: silver.stg_treatments(a.treatments(s, d)),
    "stg_claims": lambda s, d: silver.stg_claims(a.claims(s, d)),
    "dim_doctor": lambda s, d: gold.dim_doctor(a.doctors(s, d)),
    "dim_hospital": lambda s, d: gold.dim_hospital(a.hospitals(s, d)),
    "dim_insurance": lambda s, d: gold.dim_insurance(a.insurers(s, d)),
    "dim_patient": lambda s, d: gold.dim_patient(_adm(s, d)),
    "dim_date": lambda s, d: gold.dim_date(calendar(s, d)),
    "dim_doctor_history": lambda s, d: gold.dim_doctor_history(snapshot_two(s, d)),
    "fct_admissions": lambda s, d: gold.fct_admissions(_adm(s, d)),
    "fct_treatments": lambda s, d: gold.fct_treatments(silver.stg_treatments(a.treatments(s, d))),
    "fct_claims": lambda s, d: gold.fct_claims(silver.stg_claims(a.claims(s, d))),
    "fct_admissions_enriched": enriched,
}

ORACLE = {
    "stg_admissions": m.table("stg_admissions", m.STG_ADMISSIONS),
    "stg_treatments": m.table("stg_treatments", m.STG_TREATMENTS),
    "stg_claims": m.table("stg_claims", m.STG_CLAIMS),
    "dim_doctor": m.table("dim_doctor", m.DIM_DOCTOR),
    "dim_hospital": m.table("dim_hospital", m.DIM_HOSPITAL),
    "dim_insurance": m.table("dim_insurance", m.DIM_INSURANCE),
    "dim_patient": m.table("dim_patient", m.DIM_PATIENT),
    "dim_date": m.table("dim_date", m.DIM_DATE),
    "dim_doctor_history": m.table("dim_doctor_history", m.DOCTOR_HISTORY),
    "fct_admissions": m.table("fct_admissions", m.FCT_ADMISSIONS),
    "fct_treatments": m.table("fct_treatments", m.FCT_TREATMENTS),
    "fct_claims": m.table("fct_claims", m.FCT_CLAIMS),
    "fct_admissions_enriched": m.table("fct_admissions_enriched", m.ENRICHED),
}
