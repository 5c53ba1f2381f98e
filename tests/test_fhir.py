import json

from pyspark.sql import functions as F

from gristmill.operators import fhir

ICD = "http://hl7.org/fhir/sid/icd-10"


def test_record_checks(spark):
    rows = {
        "p": {"resourceType": "Patient", "id": "1", "name": [{"family": "*", "given": ["*"]}], "birthDate": "1980-01-02"},
        "leak": {"resourceType": "Patient", "id": "2", "name": [{"given": ["王"]}], "telecom": [{"system": "phone", "value": "13812345678"}], "birthDate": "1990-01-01"},
        "e": {"resourceType": "Encounter", "id": "9", "subject": {"reference": "Patient/1"}, "period": {"start": "2020-01-01T00:00:00Z", "end": "2020-01-03T00:00:00+00:00"}},
        "ok": {"resourceType": "Observation", "id": "o1", "subject": {"reference": "Patient/1"}, "encounter": {"reference": "Encounter/9"}, "effectiveDateTime": "2020-01-02T00:00:00Z", "code": {"coding": [{"system": ICD, "code": "E11.9"}]}, "valueQuantity": {"value": 1, "unit": "mg/dL"}},
        "late": {"resourceType": "Observation", "id": "o2", "subject": {"reference": "Patient/1"}, "encounter": {"reference": "Encounter/9"}, "effectiveDateTime": "2020-02-02T00:00:00Z", "code": {"coding": [{"system": ICD, "code": "ZZZ"}, {"system": "other", "code": "x"}]}, "valueQuantity": {"value": 1, "unit": "mg/dl"}},
        "broken": {"resourceType": "Observation", "id": "o3", "subject": {"reference": "Patient/77"}, "effectiveDateTime": "2020-02-02"},
    }
    data = [(k, json.dumps(v, ensure_ascii=False)) for k, v in rows.items()] + [("text", "no json"), ("null", None)]
    p = fhir.parsed(spark.createDataFrame(data, "id string, text string"))
    got = {r["id"]: r for r in p.select("id", fhir.phi_residual().alias("phi"), fhir.code_validity({ICD: ["E11.9"]}).alias("code"), fhir.unit_normalization().alias("unit")).collect()}
    assert got["p"]["phi"] == 1 and got["leak"]["phi"] < 0.5 and got["text"]["phi"] is None and got["null"]["code"] is None
    assert (got["ok"]["code"], got["late"]["code"], got["p"]["code"]) == (1, 0, 1)
    assert (got["ok"]["unit"], got["late"]["unit"], got["e"]["unit"]) == (1, 0, 1)
    times = {r["id"]: r["score"] for r in fhir.temporal_consistency(p).collect()}
    assert times["ok"] == 1 and abs(times["late"] - 2 / 3) < 1e-9 and times["broken"] is None and times["p"] == 1 and times["text"] is None
    refs = {r["id"]: r["score"] for r in fhir.referential_integrity(p).collect()}
    assert refs["ok"] == refs["p"] == 1 and refs["broken"] == 0 and refs["null"] is None
    assert p.where(F.lit(False)).count() == 0
