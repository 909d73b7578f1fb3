"""Arrays of requests: one broken element is one error row, the others are scored."""

import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from churnkit.operators.scoring import score_elements, scorecard_score
from churnkit.sources.requests import read_request_bodies, request_elements, with_request_defaults

GOOD = [{"customerID": "A", "tenure": 3, "MonthlyCharges": 89.5}, {"customerID": "B", "Contract": "Two year", "SeniorCitizen": None},
        {"customerID": "C", "note": {"deep": {"er": [1, {"x": "}{ "}]}}, "tenure": 12.0}, {"tenure": 70, "MonthlyCharges": 20}]
BROKEN = {
    '{"customerID":"X","tenure":"3"}': "tenure_wrong_type", '{"customerID":"X","tenure":5.5}': "tenure_wrong_type", '{"tenure":3000000000}': "tenure_wrong_type",
    '{"customerID":"X","gender":1}': "gender_wrong_type; gender_not_allowed", '{"customerID":"X","MonthlyCharges":"a lot"}': "MonthlyCharges_wrong_type",
    '{"customerID":"X","tenure":-1}': "tenure_out_of_range", '{"customerID":"X","Contract":"Weekly"}': "Contract_not_allowed",
    '{"customerID":"X","tenu': "malformed_record", '{"customerID":"X","tenure":': "malformed_record", '{"customerID":"X",,}': "malformed_record",
    "5": "malformed_record", "null": "malformed_record", '"text"': "malformed_record", "{}x": None,
}


def answers(spark, fm, body):
    df = spark.createDataFrame([("p", body)], "source string, body string")
    return score_elements(request_elements(df), fm).orderBy("position").collect()


@pytest.mark.parametrize("broken,error", [(b, e) for b, e in BROKEN.items() if e])
def test_one_broken_element_is_one_error_row(spark, fm, broken, error):
    plain = answers(spark, fm, json.dumps(GOOD))
    parts = [json.dumps(g) for g in GOOD]
    got = answers(spark, fm, "[" + ", ".join(parts[:2] + [broken] + parts[2:]) + "]")
    assert [r["position"] for r in got] == list(range(5)) and {r["n_elements"] for r in got} == {5}
    assert got[2]["error"] == error and got[2]["churn_probability"] is None and got[2]["risk_level"] is None
    rest = got[:2] + got[3:]
    assert [r["error"] for r in rest] == [None] * 4
    assert [(r["customerID"], r["churn_probability"], r["risk_level"]) for r in rest] == [
        (r["customerID"], r["churn_probability"], r["risk_level"]) for r in plain]


def test_answers_equal_those_of_single_requests(spark, fm):
    typed = request_elements(spark.createDataFrame([("p", json.dumps(GOOD))], "source string, body string"))
    scored = scorecard_score(fm.transform(with_request_defaults(typed.drop("element", "wrong"))))
    want = {r["position"]: round(r["p"], 4) for r in scored.collect()}
    assert {r["position"]: r["churn_probability"] for r in answers(spark, fm, json.dumps(GOOD))} == want
    assert [r["tenure"] for r in typed.orderBy("position").collect()] == [3, None, 12, 70]


@pytest.mark.parametrize("body,n", [("[]", 0), (" [ ] ", 0), (None, 1), ("", 1), ('{"tenure":1}', 1), ("not json", 1)])
def test_empty_and_wrong_bodies(spark, fm, body, n):
    got = answers(spark, fm, body)
    assert len(got) == n and all(r["error"] == "not_an_array" and r["position"] is None for r in got)


def test_bodies_of_files_and_logs(spark, fm, tmp_path):
    (tmp_path / "f").mkdir()
    (tmp_path / "f" / "a.json").write_text(json.dumps(GOOD, indent=2))
    (tmp_path / "f" / "b.json").write_text('[{"customerID": "Z"}')
    (tmp_path / "log.txt").write_text("7\t" + json.dumps(GOOD) + "\n" + json.dumps(GOOD[:1]) + "\n")
    files = score_elements(request_elements(read_request_bodies(spark, str(tmp_path / "f"), "file")), fm).collect()
    assert sorted((r["source"], r["error"]) for r in files) == [("a.json", None)] * 4 + [("b.json", None)]
    log = request_elements(read_request_bodies(spark, str(tmp_path / "log.txt"))).collect()
    assert sorted((r["source"] or "-", r["position"]) for r in log) == [("-", 0), *(("7", i) for i in range(4))]


TEXT = st.text(alphabet='ab"\\{}[],: \n\té', max_size=8)


@settings(max_examples=25, deadline=None)
@given(st.lists(st.dictionaries(st.sampled_from(["customerID", "gender", "x", "Contract"]), TEXT.filter(lambda t: not t.endswith("{")), max_size=4), min_size=1, max_size=5))
def test_any_texts_stay_in_their_element(spark, records):
    df = spark.createDataFrame([("p", json.dumps(records))], "source string, body string")
    got = request_elements(df).orderBy("position").collect()
    assert [json.loads(r["element"]) for r in got] == records and all(r["wrong"] == [] for r in got)
    assert [r["customerID"] for r in got] == [x.get("customerID") for x in records]
