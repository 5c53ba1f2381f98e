"""Checks of health records (JSON in ``text``). One Arrow call reads each record; the rest is joins and expressions.

A text that is no JSON object with a known resourceType scores null, which keeps it.
"""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RESOURCES = ("Patient", "Encounter", "Observation", "MedicationRequest")
# What counts as residual personal data, and the subtrees that are searched for it.
PHI_PATTERNS = (r"1[3-9]\d{9}", r"\d{17}[\dXx]", r"\d{3}-\d{2}-\d{4}", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}")
PHI_KEYS = ("name", "given", "family", "address", "telecom", "identifier", "contact")
# Code systems with the form of their codes, and the units that count as standard.
CODE_FORMS = {"http://hl7.org/fhir/sid/icd-10": r"[A-TV-Z]\d{2}(\.\d{1,4})?", "http://loinc.org": r"\d{1,5}-\d", "http://www.whocc.no/atc": r"[A-Z]\d{2}[A-Z]{2}\d{2}"}
UNITS = ("mg/dL", "mmol/L", "mmHg", "{beats}/min", "%", "kg", "cm", "Cel", "mg", "mL")

SCHEMA = "kind string, id string, leaves array<struct<key:string,value:string>>, codings array<struct<system:string,code:string>>, units array<string>, refs array<string>, subject string, encounter string, birth string, start string, end string, effective string"


def _walk(node, visit, key=None, under=None):
    if isinstance(node, dict):
        visit(node, key, under)
        for k, v in node.items():
            _walk(v, visit, k, k if k in PHI_KEYS else under)
    elif isinstance(node, list):
        for v in node:
            _walk(v, visit, key, under)
    else:
        visit(node, key, under)


def _get(node, *path):
    for p in path:
        node = node.get(p) if isinstance(node, dict) else None
    return node if isinstance(node, str) else None


def read(text: str | None) -> dict | None:
    try:
        r = json.loads(text or "")
    except ValueError:
        return None
    if not isinstance(r, dict) or r.get("resourceType") not in RESOURCES:
        return None
    out = {"kind": r["resourceType"], "id": _get(r, "id"), "leaves": [], "codings": [], "units": [], "refs": [], "subject": _get(r, "subject", "reference"), "encounter": _get(r, "encounter", "reference"), "birth": _get(r, "birthDate"), "start": _get(r, "period", "start"), "end": _get(r, "period", "end"), "effective": _get(r, "effectiveDateTime")}

    def visit(node, key, under):
        if isinstance(node, dict):
            if "system" in node and "code" in node:
                out["codings"].append({"system": str(node["system"]), "code": str(node["code"])})
            if isinstance(node.get("valueQuantity"), dict):
                unit = node["valueQuantity"].get("unit")
                out["units"].append(unit if isinstance(unit, str) else None)
            if isinstance(node.get("reference"), str):
                out["refs"].append(node["reference"])
        elif isinstance(node, str) and under is not None:
            out["leaves"].append({"key": under, "value": node})

    _walk(r, visit)
    return out


def parsed(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with ``fhir``, a struct of what the checks need."""

    @F.pandas_udf(SCHEMA)
    def parse(s: pd.Series) -> pd.DataFrame:
        names = [c.split(" ")[0] for c in re.split(r", (?=\w+ (?:string|array))", SCHEMA)]
        found = [read(t) or dict.fromkeys(names) for t in s]
        return pd.DataFrame(found, columns=names)

    return df.withColumn("fhir", parse(F.col(text)))


def _known(c: Column) -> Column:
    return F.when(F.col("fhir.kind").isNotNull(), c)


def _share(part: Column, whole: Column) -> Column:
    return F.when(F.size(whole) == 0, 1.0).otherwise(F.size(part) / F.size(whole))


def phi_residual() -> Column:
    leaves = F.col("fhir.leaves")
    clean = F.filter(leaves, lambda x: ~(x["value"].rlike("|".join(PHI_PATTERNS)) | ((x["key"] == "given") & x["value"].rlike(r"[\x{4E00}-\x{9FFF}]"))))
    return _known(_share(clean, leaves))


def code_validity(tables: dict[str, list[str]]) -> Column:
    """``tables``: the valid codes of each system; systems without a table are not judged."""
    systems = [s for s in CODE_FORMS if s in tables]
    judged = F.filter("fhir.codings", lambda x: x["system"].isin(systems))

    def ok(x: Column) -> Column:
        fits = (((x["system"] == s) & x["code"].rlike(f"^(?:{CODE_FORMS[s]})$") & x["code"].isin(list(tables[s]))).cast("int") for s in systems)
        return sum(fits, F.lit(0)) > 0

    return _known(_share(F.filter(judged, ok), judged))


def unit_normalization() -> Column:
    units = F.col("fhir.units")
    return _known(_share(F.filter(units, lambda u: F.coalesce(u.isin(list(UNITS)), F.lit(False))), units))


def _tail(ref: Column) -> Column:
    return F.when(F.locate("/", ref) > 0, F.substring_index(ref, "/", -1))


def _time(c: Column) -> Column:
    return F.try_to_timestamp(F.regexp_replace(c, "Z$", "+00:00"))


def temporal_consistency(p: DataFrame, id_col: str = "id") -> DataFrame:
    """(id, score): an observation is after its patient's birth and inside its encounter; broken or unreadable references give null, other resources 1."""
    patients = p.where("fhir.kind = 'Patient'").groupBy(F.col("fhir.id").alias("_p")).agg(F.max("fhir.birth").alias("_birth"))
    visits = p.where("fhir.kind = 'Encounter' and (fhir.start is not null or fhir.end is not null)").groupBy(F.col("fhir.id").alias("_e")).agg(F.max(F.struct("fhir.start", "fhir.end")).alias("_v"))
    d = p.withColumn("_p", _tail(F.col("fhir.subject"))).withColumn("_e", _tail(F.col("fhir.encounter"))).join(patients, "_p", "left").join(visits, "_e", "left")
    at, birth, start, end = _time(F.col("fhir.effective")), _time(F.col("_birth")), _time(F.col("_v.start")), _time(F.col("_v.end"))
    checks = F.array_compact(F.array((F.to_date(at) > F.to_date(birth)).cast("double"), (at >= start).cast("double"), (at <= end).cast("double")))
    broken = at.isNull() | birth.isNull() | (F.col("_e").isNotNull() & F.col("_v").isNull())
    mean = F.aggregate(checks, F.lit(0.0), lambda a, x: a + x) / F.size(checks)
    score = F.when(F.col("fhir.kind").isNull(), F.lit(None).cast("double")).when(F.col("fhir.kind") != "Observation", 1.0).when(~broken, mean)
    return d.select(id_col, score.alias("score"))


def referential_integrity(p: DataFrame, id_col: str = "id") -> DataFrame:
    """(id, score): the share of references (Type/id) that some record answers to; 1 without references."""
    keys = p.where("fhir.kind is not null").select(F.concat_ws("/", "fhir.kind", "fhir.id").alias("ref")).distinct().withColumn("hit", F.lit(1))
    refs = p.select(id_col, F.explode("fhir.refs").alias("ref")).join(keys, "ref", "left").groupBy(id_col).agg((F.count("hit") / F.count("*")).alias("share"))
    return p.join(refs, id_col, "left").select(id_col, F.when(F.col("fhir.kind").isNotNull(), F.coalesce("share", F.lit(1.0))).alias("score"))
