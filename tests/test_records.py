"""The record jobs on their small published inputs, with worked-out results."""

import pytest
from pyspark.sql import functions as F

from cardamom import sources as src
from cardamom.operators import chunk_records
from cardamom.plans import candidates, league, scoring
from cardamom.sources import read_tsv_matches

# A flat list of candidates, six values each.
CANDIDATES = """
Laura Serra|608112233|6|3|3|3
Clara Gómez|655221199|3|3|3|2
Sergio López|644112211|3|2|2|2
Candidat Error primero|611000000|5|7|3|2
Marta Ruiz|699887766|2|3|2|1
Marc Vidal|612443322|6|3|3|3
Candidato Error segundo|123|5|3|3|2
Júlia Romero|677998877|5|3|3|2
Pol Navarro|699554433|4|3|2|2
David Ferrer|677665544|2|1|1|1
Anna Paredes|633221144|1|2|1|0
"""
RANKED = [
    (1, "Marc Vidal", 18.0, "Prioritat alta"),
    (2, "Laura Serra", 18.0, "Prioritat alta"),
    (3, "Júlia Romero", 15.5, "Prioritat alta"),
    (4, "Pol Navarro", 13.0, "Prioritat alta"),
    (5, "Clara Gómez", 12.5, "Prioritat alta"),
    (6, "Sergio López", 10.5, "Candidat adequat"),
    (7, "Marta Ruiz", 9.0, "Candidat adequat"),
    (8, "David Ferrer", 6.0, "No prioritari"),
    (9, "Anna Paredes", 4.5, "No prioritari"),
]


def candidate_rows(spark, text):
    flat = [v for line in text.strip().splitlines() for v in line.split("|")]
    frame = spark.createDataFrame(list(enumerate(flat)), "pos int, value string")
    return chunk_records(frame, candidates.FIELDS)


def test_candidate_batch(spark, rows):
    accepted, rejected = candidates.intake(candidate_rows(spark, CANDIDATES), max_accepted=10)
    assert rows(candidates.report(accepted), "position", "name", "score", "band") == RANKED
    assert rows(rejected) == [
        (3, "Candidat Error primero", "catalan", "7", candidates.LEVEL_RANGE),
        (6, "Candidato Error segundo", "phone", "123", candidates.PHONE_LENGTH),
    ]
    laura = accepted.filter(F.col("name") == "Laura Serra").first().asDict()
    assert laura["phone"] == 608112233
    assert (laura["catalan_level"], laura["excel_level"], laura["degree_level"]) == (
        "C1 o superior",
        "Visual Basic i Macros",
        "Master o superior",
    )


def test_intake_stops_when_full(spark, rows):
    raw = candidate_rows(spark, CANDIDATES)
    accepted, rejected = candidates.intake(raw, max_accepted=4)
    assert rows(accepted, "seq") == [(0,), (1,), (2,), (4,)]
    assert rows(rejected, "seq") == [(3,)]
    accepted, rejected = candidates.intake(raw, max_accepted=9)
    assert accepted.count() == 9
    assert rows(rejected, "seq") == [(3,), (6,)]


@pytest.mark.parametrize(
    ("field", "value", "reason"),
    [
        ("name", "  ", candidates.NAME_EMPTY),
        ("name", None, candidates.NAME_EMPTY),
        ("name", "R2 D2", candidates.NAME_SYMBOLS),
        ("name", "Ana_", candidates.NAME_SYMBOLS),
        ("phone", "", candidates.PHONE_EMPTY),
        ("phone", "600 00000", candidates.PHONE_BLANK),
        ("phone", "12345678", candidates.PHONE_LENGTH),
        ("phone", "60000000x", candidates.PHONE_DIGITS),
        ("experience", "two", candidates.NOT_A_NUMBER),
        ("experience", "51", candidates.EXPERIENCE_RANGE),
        ("experience", "-1", candidates.EXPERIENCE_RANGE),
        ("catalan", "4", candidates.LEVEL_RANGE),
        ("excel", "1.5", candidates.NOT_A_NUMBER),
        ("degree", "-1", candidates.LEVEL_RANGE),
    ],
)
def test_reject_reasons(spark, field, value, reason):
    row = dict(zip(candidates.FIELDS, ["Núria d Olç-a", "012345678", " 50 ", "0", "3", "1"]))
    schema = "seq int, " + ", ".join(f"{f} string" for f in candidates.FIELDS)
    good = spark.createDataFrame([(0, *row.values())], schema)
    accepted, rejected = candidates.intake(good)
    assert rejected.count() == 0
    assert accepted.first()["phone"] == 12345678
    row[field] = value
    bad = spark.createDataFrame([(0, *row.values())], schema)
    _, rejected = candidates.intake(bad)
    assert tuple(rejected.select("field", "value", "reason").first()) == (field, value, reason)


# Clients of the abandonment score and their risk by id.
CLIENTS = [
    (1, "Laura Serra", 23, "18-25", 4),
    (2, "Marc Vidal", 35, "26-40", 3),
    (3, "Ana López", 29, "26-40", 2),
    (4, "Joan Riera", 19, "18-25", 2),
    (5, "Mónica Pérez", 47, "41-60", 4),
    (6, "Luis García", 52, "41-60", 1),
    (7, "Pilar Sánchez", 61, "60+", 3),
    (8, "Eva Martín", 38, "26-40", 0),
    (9, "Diego Romero", 24, "18-25", 1),
    (10, "Núria Costa", 33, "26-40", 4),
]
RISKS = [
    (1, 1.08),
    (10, 0.9),
    (5, 0.765),
    (2, 0.75),
    (4, 0.6),
    (7, 0.525),
    (3, 0.5),
    (9, 0.3),
    (6, 0.212),
    (8, 0.1),
]
CLIENT_SCHEMA = "client_id bigint, name string, age bigint, age_group string, code bigint"


def test_abandonment_risk(spark, rows):
    risks = scoring.abandonment_risk(spark.createDataFrame(CLIENTS, CLIENT_SCHEMA))
    assert [tuple(r) for r in scoring.risk_report(risks).select("client_id", "risk").collect()] == RISKS
    first = [r["name"] for r in scoring.contact_first(risks).collect()]
    assert first == ["Laura Serra", "Núria Costa", "Mónica Pérez", "Marc Vidal"]
    assert rows(scoring.low_interest(risks)) == [(8, "Eva Martín")]
    assert tuple(scoring.most_profitable(risks).first()) == ("Laura Serra", 1.08)


def test_unknown_code_fails(spark):
    bad = spark.createDataFrame([(1, "x", 20, "18-25", 7)], CLIENT_SCHEMA)
    with pytest.raises(Exception, match="no entry in lookup for code = 7"):
        scoring.abandonment_risk(bad).collect()


# Patient lines and their risk.
PATIENTS = [
    "Maria|45|tos, Fiebre Alta, dolor_pecho",
    "Luis|33|dolor_cabeza,faTiga",
    "Sara|67|fiebre alta, dificultad RESPIRAR, tos",
    "Jordi|52|fatiga , tos",
    "Anna|29|fiebre alta,dolor_cabeza",
]


def test_triage(spark):
    lines = spark.createDataFrame([(p,) for p in PATIENTS], "line string")
    report = scoring.triage_report(scoring.triage(lines))
    got = [(r["name"], r["risk"]) for r in report.collect()]
    assert got == [("Sara", 9), ("Maria", 8), ("Anna", 4), ("Jordi", 2), ("Luis", 2)]
    sara = report.first()
    assert sara["age"] == 67
    assert sara["symptoms"] == ["fiebre_alta", "dificultad_respirar", "tos"]


@pytest.mark.parametrize(("line", "error"), [("Maria|45", "three parts"), ("Maria|x|tos", "no integer")])
def test_bad_patient_lines_fail(spark, line, error):
    lines = spark.createDataFrame([(line,)], "line string")
    with pytest.raises(Exception, match=error):
        scoring.triage(lines).collect()


# Insurance clients.
INSURED = [
    (1, "Ana", 42, 0),
    (2, "Carlos", 30, 2),
    (3, "Isabel", 55, 3),
    (4, "Jorge", 40, 1),
    (5, "Marta", 28, 0),
]


def test_insurance(spark, rows):
    frame = spark.createDataFrame(INSURED, "client_id bigint, name string, age bigint, code bigint")
    prices = scoring.insurance_prices(frame)
    report = scoring.insurance_report(prices).select("name", "final_price", "fraud").collect()
    assert [tuple(r) for r in report] == [
        ("Isabel", 775.0, 0.30),
        ("Carlos", 455.0, 0.15),
        ("Jorge", 280.0, 0.05),
        ("Ana", 170.39999999999998, 0.01),
        ("Marta", 153.6, 0.01),
    ]
    assert rows(scoring.insurance_findings(prices)) == [
        ("highest_price", "Isabel", "775.00 €"),
        ("manual_review", "Isabel", "Risc crític"),
        ("max_fraud", "Isabel", "30%"),
        ("top_price", "Isabel", "775.00 €"),
    ]


def test_first_row_need_not_have_the_highest_price(spark, rows):
    frame = spark.createDataFrame(
        [(1, "risky", 0, 3), (2, "old", 90, 2), (3, "twin", 0, 3)],
        "client_id bigint, name string, age bigint, code bigint",
    )
    got = dict((f, n) for f, n, _ in rows(scoring.insurance_findings(scoring.insurance_prices(frame))))
    assert got["top_price"] == "risky"
    assert got["highest_price"] == "old"
    empty = scoring.insurance_findings(scoring.insurance_prices(frame.limit(0)))
    assert empty.count() == 0


MATCHES = "a\t2-1\tb\nb\t0-0\tc\nc\t1-3\ta\n\na\t0-2\tc\n"


def test_league_from_file(spark, tmp_path):
    path = tmp_path / "matches.txt"
    path.write_text(MATCHES, encoding="utf-8")
    table = league.league_table(read_tsv_matches(spark, str(path)))
    columns = ["team", "goals_for", "goals_against", "played", "won", "drawn", "lost", "points"]
    assert [tuple(r) for r in table.select(*columns).collect()] == [
        ("a", 5, 4, 3, 2, 0, 1, 6),
        ("c", 3, 3, 3, 1, 1, 1, 4),
        ("b", 1, 2, 2, 0, 1, 1, 1),
    ]


@pytest.mark.parametrize("result", ["2:1", "2-x", "2-1-0", ""])
def test_bad_results_fail(spark, result):
    frame = spark.createDataFrame([("a", result, "b")], "home string, result string, away string")
    with pytest.raises(Exception, match="not a result|CAST_INVALID_INPUT"):
        league.league_table(frame).collect()


INFERRED = {
    "ints": ["1", "-2", "+3", "", "007"],
    "longs": ["1", "3000000000", "-5", "", "2"],
    "wide": ["1", "123456789012345678901", "-7", "", "9"],
    "doubles": ["1", "2.5", "1e3", "", "NaN"],
    "padded": [" 1", "2", "3", "", "4"],
    "days": ["2024-01-31", "2023-02-01", "", "1999-12-31", "2020-02-29"],
    "bad_days": ["2024-02-30", "2023-02-01", "", "x", "2020-02-29"],
    "moments": ["2024-01-31 10:00:00", "2023-02-01T11:12:13", "", "2020-01-01 00:00:00.5", "2021-05-05 01:02:03"],
    "mixed": ["2024-01-31 10:00:00", "2023-02-01", "", "2020-01-01", "2021-05-05"],
    "flags": ["true", "FALSE", "", "True", "false"],
    "flag_or_int": ["true", "1", "", "0", "false"],
    "texts": ["a", "1", "", "x, y", 'quo"te'],
    "nothing": ["", "", "", "", ""],
    "day_or_int": ["2024-01-31", "5", "", "6", "7"],
}


def test_types_are_found_in_one_pass_as_spark_infers_them(spark, tmp_path, monkeypatch):
    import csv

    path = tmp_path / "all.csv"
    with path.open("w", newline="", encoding="utf-8") as f:
        writer = csv.writer(f)
        writer.writerow(INFERRED)
        writer.writerows(zip(*INFERRED.values()))
    own = src.read_csv(spark, str(path))
    options = {"header": True, "quote": '"', "escape": '"', "inferSchema": True}
    sparks = spark.read.options(**options).csv(str(path))
    assert own.dtypes == sparks.dtypes
    assert repr(own.collect()) == repr(sparks.collect())
    assert src.infer_csv_schema(spark, str(path)).names == list(INFERRED)
    assert [f.dataType for f in src.infer_csv_schema(spark, str(path))] == [f.dataType for f in sparks.schema]
    # The files are not looked at again.
    path.write_text("gone\n")
    assert own.count() == 5
    empty = tmp_path / "empty.csv"
    empty.write_text("a,b.c,`d\n")
    assert src.read_csv(spark, str(empty)).dtypes == [("a", "string"), ("b.c", "string"), ("`d", "string")]
    table = src.external_csv_table(spark, "inferred_test", str(tmp_path / "empty.csv"))
    assert table.count() == 0
    spark.sql("DROP TABLE inferred_test")


def test_bad_lines_are_kept_apart(spark, tmp_path, rows):
    good, bad = tmp_path / "good.csv", tmp_path / "bad.csv"
    good.write_text("id,name,x\n1,a,2.5\n2,\"b, c\",\n", encoding="utf-8")
    bad.write_text("id,name,x\n3,a\n4,a,1,2\nfive,a,1\n6,a,much\n7,é,1\n", encoding="utf-8")
    kept, rejected = src.read_csv_lines(spark, [str(good), str(bad)], "id int, name string, x double")
    assert rows(kept) == [(1, "a", 2.5), (2, "b, c", None), (7, "é", 1.0)]
    assert rows(rejected, "line") == [("3,a",), ("4,a,1,2",), ("6,a,much",), ("five,a,1",)]
    assert {r.file.rsplit("/", 1)[1] for r in rejected.collect()} == {"bad.csv"}
    with pytest.raises(Exception):  # strict mode is still there
        src.read_csv(spark, [str(good), str(bad)], "id int, name string, x double").collect()
    kept, rejected = src.read_csv_lines(spark, str(good), "id int, name string, x double")
    assert kept.count() == 2 and rejected.isEmpty()
