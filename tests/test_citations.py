import pytest

from tests.conftest import day
from ticketmill import schemas
from ticketmill.operators.citations import clean_citations, exclude_values
from ticketmill.settings import CitationRules, FEE_SCHEDULE, SEMESTERS

TEST = "DO NOT USE/TESTING"


def row(**changes):
    base = dict(id="C1", ts="2025-09-15 10:30:00", loc="East Deck", campus="Kennesaw",
                type="No Valid Permit", status="Unpaid", fine=50)
    return tuple((base | changes).values())


def test_traced_record(citations):
    r = citations(row()).first()
    assert r.date == day("2025-09-15")
    assert (r.year, r.month, r.day_of_week, r.hour) == (2025, 9, "Monday", 10)
    assert (r.semester, r.fine_amount) == ("Fall 2025", 50)
    assert r.fine_validated is True and r.is_credit_adjustment is False


def test_contract_columns_and_types(raw):
    clean = clean_citations(raw(row()))
    assert [(f.name, f.dataType) for f in clean.schema] == [
        (f.name, f.dataType) for f in schemas.CITATIONS
    ]


def test_exclusion_sees_untrimmed_values_and_keeps_null(citations):
    rows = citations(row(type=TEST), row(type=TEST + " "), row(type=None), row()).collect()
    assert [r.violation_type for r in rows] == [TEST, None, "No Valid Permit"]


def test_excluding_nothing_keeps_everything(raw):
    assert exclude_values(raw(row(type=None)), "Violation Type", []).count() == 1


def test_trimming_covers_four_columns_but_not_the_id(citations):
    r = citations(row(id="C1 ", loc="\tLot ", campus=" Marietta ", type=" Tow Fee ",
                      status=" Unpaid\n")).first()
    assert (r.citation_id, r.location, r.campus) == ("C1 ", "Lot", "Marietta")
    assert (r.violation_type, r.status) == ("Tow Fee", "Unpaid")


def test_casing_is_left_alone(citations):
    assert citations(row(campus="kennesaw")).first().campus == "kennesaw"


@pytest.mark.parametrize(
    "changes, valid",
    [
        ({}, True),
        ({"fine": 35}, False),
        ({"fine": 0}, False),
        ({"fine": 0, "status": "Transfer"}, True),
        ({"fine": 999, "status": " Zero Balance "}, True),
        ({"fine": 0, "status": "Inactive"}, True),
        ({"fine": -50}, True),
        ({"type": "Never heard of"}, False),
        ({"type": None}, False),
        ({"type": None, "fine": None}, False),
        ({"fine": None}, False),
        ({"status": None}, True),
        ({"status": None, "fine": 1}, False),
        ({"type": " Tow Fee", "fine": 60}, True),
    ],
)
def test_validation(citations, changes, valid):
    assert citations(row(**changes)).first().fine_validated is valid


def test_credit_flag_is_never_null_and_amount_is_kept(citations):
    rows = citations(row(fine=-60), row(fine=0), row(fine=None)).collect()
    assert [(r.fine_amount, r.is_credit_adjustment) for r in rows] == [
        (-60, True), (0, False), (None, False),
    ]


def test_semester_bounds(raw):
    stamps = ["2025-07-31 23:59:59", "2025-08-01 00:00:00", "2025-12-31 00:00:00",
              "2025-12-31 00:00:01", "2026-01-01 00:00:00", "2026-06-01 00:00:00", None]
    rows = raw(*(row(ts=s) for s in stamps))

    def semesters(rules):
        return [r.semester for r in clean_citations(rows, rules).collect()]

    assert semesters(CitationRules()) == [
        "Unknown", "Fall 2025", "Fall 2025", "Unknown", "Spring 2026", "Unknown", "Unknown",
    ]
    assert semesters(CitationRules(whole_last_day=True))[3] == "Fall 2025"


def test_missing_timestamp_gives_null_calendar(citations):
    r = citations(row(ts=None)).first()
    assert [r.date, r.year, r.month, r.day_of_week, r.hour] == [None] * 5


def test_time_zone_of_the_session_does_not_matter(spark, citations):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        r = citations(row(ts="2025-11-02 01:30:00"), row(ts="2026-03-08 02:30:00")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert [(x.date, x.hour, x.day_of_week) for x in r] == [
        (day("2025-11-02"), 1, "Sunday"), (day("2026-03-08"), 2, "Sunday"),
    ]


def test_default_rules():
    assert len(FEE_SCHEDULE) == 20 and set(FEE_SCHEDULE.values()) == {35, 50, 60}
    assert [s[0] for s in SEMESTERS] == ["Fall 2025", "Spring 2026"]
