"""Each rule: a value that fires, values that do not, null, and out of scope."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from linkledger.config import Settings
from linkledger.functions import columns
from linkledger.operators.population import TEXT_FIELDS
from linkledger.operators.rules import SCOPES, all_rules, completeness_rules

SETTINGS = Settings(
    as_of=dt.date(2001, 8, 15), closed_branches=("07", "13"), internal_domains=("internal.example",))
RULES = {r.name: r for r in all_rules(SETTINGS, standalone=True)}
FIELDS = ("contact_type", "contact_code", "branch", *TEXT_FIELDS)


def judge(spark, name, **values):
    """(in scope, fires) of one contact."""
    schema = ", ".join(f"{f} string" for f in FIELDS) + ", code_repeats boolean"
    row = {"contact_type": "I", "contact_code": "A1", "code_repeats": False, **values}
    df = spark.createDataFrame([tuple(row.get(f) for f in FIELDS) + (row["code_repeats"],)], schema)
    rule = RULES[name]
    got = df.selectExpr(f"coalesce({SCOPES[rule.scope]}, false) AS s", f"{rule.failed} AS i").first()
    return got["s"], got["i"]


CASES = [
    ("placeholder_name", dict(first_name="Firstname"), (True, True)),
    ("placeholder_name", dict(last_name="n/a"), (True, True)),
    ("placeholder_name", dict(first_name="Ann"), (True, False)),
    ("placeholder_name", dict(first_name="Firstname", contact_type="B"), (False, False)),
    ("placeholder_company_name", dict(company_name="No Name", contact_type="B"), (True, True)),
    ("placeholder_company_name", dict(company_name="No Name"), (False, False)),
    ("name_all_same_char", dict(first_name="X"), (True, True)),
    ("name_all_same_char", dict(first_name="XXXX"), (True, True)),
    ("name_all_same_char", dict(last_name="....."), (True, True)),
    ("name_all_same_char", dict(first_name="XY"), (True, False)),
    ("name_all_same_char", dict(), (True, False)),
    ("company_name_all_same_char", dict(company_name="ZZZ", contact_type="C"), (True, True)),
    ("name_numeric_only", dict(last_name="77"), (True, True)),
    ("name_numeric_only", dict(last_name="7a"), (True, False)),
    ("status_text_in_name", dict(last_name="Don't use"), (True, True)),
    ("status_text_in_name", dict(first_name="Closed acct"), (True, True)),
    ("status_text_in_name", dict(first_name="Useful"), (True, False)),
    ("status_text_in_company", dict(company_name="Farm OOB Supply", contact_type="B"), (True, True)),
    ("status_text_in_company", dict(company_name="Oob Farm", contact_type="B"), (True, False)),
    ("status_text_in_street", dict(street="farm plan rd"), (True, False)),
    ("status_text_in_street", dict(street="closed 2 Elm"), (True, True)),
    ("placeholder_street", dict(street="-"), (True, True)),
    ("placeholder_street", dict(), (False, False)),
    ("placeholder_city", dict(city="tbd"), (True, True)),
    ("placeholder_state", dict(state="zz"), (True, True)),
    ("dba_in_company_name", dict(company_name="Acme d/b/a Widgets", contact_type="B"), (True, True)),
    ("test_record", dict(company_name="dummy"), (True, True)),
    ("contact_type_field_mismatch", dict(contact_type="B", first_name="Ann"), (True, True)),
    ("contact_type_field_mismatch", dict(company_name="Acme"), (True, True)),
    ("contact_type_field_mismatch", dict(contact_type="B", first_name="Ann", company_name="Acme"), (True, False)),
    ("prefix_in_name", dict(first_name="mr. Ann"), (True, True)),
    ("prefix_in_name", dict(first_name="Dr Bob"), (True, True)),
    ("prefix_in_name", dict(first_name="Drake"), (True, False)),
    ("suffix_in_surname", dict(last_name="Smith Jr."), (True, True)),
    ("suffix_in_surname", dict(last_name="Jones III"), (True, True)),
    ("suffix_in_surname", dict(last_name="Major"), (True, False)),
    ("combined_names_in_name", dict(first_name="John and Mary"), (True, True)),
    ("combined_names_in_name", dict(first_name="Sandor"), (True, False)),
    ("familiar_name_pattern", dict(first_name="Billy (Joe"), (True, True)),
    ("email_invalid_format", dict(email="bad.at.example"), (True, True)),
    ("email_invalid_format", dict(email="user@nodot"), (True, True)),
    ("email_invalid_format", dict(), (True, False)),
    ("email_placeholder", dict(email="NoEmail@x.com"), (True, True)),
    ("email_placeholder", dict(), (False, False)),
    ("biz_phone_sequential", dict(biz_phone="1234567890"), (True, True)),
    ("biz_phone_repeated_digit", dict(biz_phone="1111111111"), (True, True)),
    ("biz_phone_repeated_digit", dict(biz_phone="111"), (True, False)),
    ("priv_phone_wrong_length", dict(priv_phone="5551234"), (True, True)),
    ("mob_phone_nanp_invalid", dict(mob_phone="12702005555"), (True, False)),
    ("mob_phone_nanp_invalid", dict(mob_phone="2702005555"), (True, False)),
    ("mob_phone_nanp_invalid", dict(mob_phone="1112223333"), (True, True)),
    ("mob_phone_nanp_invalid", dict(mob_phone="0000000000"), (True, True)),
    ("mob_phone_allzeros", dict(mob_phone="0000000000"), (True, True)),
    ("mob_phone_leading_zero", dict(mob_phone="0123"), (True, True)),
    ("state_not_2char", dict(state="Iowa"), (True, True)),
    ("state_written_out", dict(state="Iowa"), (True, True)),
    ("country_not_2char", dict(country="USA"), (True, True)),
    ("country_written_out", dict(country="Canada"), (True, True)),
    ("zip_invalid_format", dict(pcode="42101"), (True, False)),
    ("zip_invalid_format", dict(pcode="42101-1234"), (True, False)),
    ("zip_invalid_format", dict(pcode="421011234"), (True, False)),
    ("zip_invalid_format", dict(pcode="4210"), (True, True)),
    ("zip_invalid_format", dict(pcode="K1A 0B1"), (True, True)),
    ("zip_invalid_format", dict(pcode="K1A 0B1", country="CA"), (False, False)),
    ("generation_unrecognized", dict(generation="3rd"), (True, True)),
    ("generation_unrecognized", dict(generation="jr"), (True, False)),
    ("title_unrecognized", dict(title="Farmer"), (True, True)),
    ("title_unrecognized", dict(title="mrs."), (True, False)),
    ("title_unrecognized", dict(title="Farmer", contact_type="B"), (False, False)),
    ("suffix_unrecognized", dict(suffix="Ph.D."), (True, False)),
    ("suffix_unrecognized", dict(suffix="123 Main St"), (True, True)),
    ("invalid_branch", dict(branch="07"), (True, True)),
    ("invalid_branch", dict(branch="08"), (True, False)),
    ("contact_code_has_whitespace", dict(contact_code="A\t1"), (True, True)),
    ("contact_code_has_whitespace", dict(contact_code="At1"), (True, False)),
    ("contact_code_non_alphanumeric", dict(contact_code="A-1"), (True, True)),
    ("contact_code_duplicate_normalized", dict(code_repeats=True), (True, True)),
    ("email_internal_domain", dict(email="a@Internal.example"), (True, True)),
    ("email_internal_domain", dict(email="a@internalxexample"), (True, False)),
    ("email_missing_at", dict(email="none"), (True, True)),
    ("street_routing_text", dict(street="c/o Bob"), (True, True)),
    ("no_contact_info", dict(), (True, True)),
    ("no_contact_info", dict(email="a@b.c"), (True, False)),
    ("missing_company_name", dict(contact_type="C"), (True, True)),
    ("missing_company_name", dict(), (False, False)),
]


@pytest.mark.parametrize("name,values,expected", CASES, ids=[f"{n}-{i}" for i, (n, _, _) in enumerate(CASES)])
def test_rule(spark, name, values, expected):
    assert judge(spark, name, **values) == expected


def test_counts_of_rules():
    assert len(completeness_rules()) == 11
    assert len(all_rules(SETTINGS)) == 11 + 43


def outcome(spark, text, **values):
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values))
    return df.selectExpr(text).first()[0]


@pytest.mark.parametrize("a,b,expected", [
    (None, None, "both_null"), ("x", None, "equip_only"), (None, "x", "registry_only"), ("Ab", "aB", "match"), ("a", "b", "mismatch"),
])
def test_parity(spark, a, b, expected):
    assert outcome(spark, columns.parity("a", "b"), a=a, b=b) == expected


@pytest.mark.parametrize("phone,area,num,expected", [
    (None, None, None, "both_null"), ("1", None, None, "equip_only"), (None, "270", None, "registry_only"),
    ("2701234567", "270", "1234567", "match"), ("2701234567", "270", None, "mismatch"), ("270", "270", None, "match"),
])
def test_phone_parity(spark, phone, area, num, expected):
    assert outcome(spark, columns.phone_parity("p", "a", "n"), p=phone, a=area, n=num) == expected


@pytest.mark.parametrize("last,expected", [
    (None, "never_transacted"), ("2000-08-15", "0-1yr"), ("2000-08-14", "1-2yr"), ("1996-08-15", "4-5yr"), ("1996-08-14", "5+yr"),
])
def test_staleness(spark, last, expected):
    text = columns.staleness_bucket("a", "cast(d AS date)", SETTINGS.as_of, "calendar")
    assert outcome(spark, text, a="1", d=last) == expected
    assert outcome(spark, text, a=None, d=last) == "no_account"


def test_staleness_by_days(spark):
    text = columns.staleness_bucket("a", "cast(d AS date)", dt.date(2001, 1, 1), "365d")
    assert outcome(spark, text, a="1", d="2000-01-01") == "1-2yr"  # 2000 has 366 days


@pytest.mark.parametrize("created,current,older", [
    (None, "Unknown", "Unknown"), ("2015-12-31", "Pre-2015", "2015-2020"), ("2014-12-31", "Pre-2015", "Pre-2015"),
    ("2016-01-01", "2016-2020", "2015-2020"), ("2020-06-01", "2016-2020", "2020-2025"), ("2026-01-01", "2026+", "2025+"),
])
def test_cohorts(spark, created, current, older):
    assert outcome(spark, columns.creation_cohort("cast(d AS date)"), d=created) == current
    assert outcome(spark, columns.creation_cohort("cast(d AS date)", "older"), d=created) == older


@pytest.mark.parametrize("values,expected", [
    (dict(contact_type="B"), "tier_4_no_name"),
    (dict(contact_type="C", company_name="Acme"), "tier_4_no_name"),
    (dict(contact_type="B", company_name="Acme", street="1 A", pcode="1"), "tier_1_strong"),
    (dict(contact_type="I", first_name="A", last_name="B", street="1 A", city="C", state="KY"), "tier_1_strong"),
    (dict(contact_type="I", first_name="A", last_name="B", state="KY"), "tier_2_partial"),
    (dict(contact_type="I", first_name="A", last_name="B", email="a@b.c"), "tier_2_partial"),
    (dict(contact_type="I", first_name="A", last_name="B"), "tier_3_name_only"),
])
def test_match_tier(spark, values, expected):
    row = {f: values.get(f) for f in FIELDS}
    assert outcome(spark, columns.MATCH_TIER, **row) == expected


def test_blank_to_null(spark):
    df = spark.createDataFrame([(" a ",), ("  ",), (None,)], "x string")
    assert [r[0] for r in df.select(F.expr(columns.blank_to_null("x"))).collect()] == ["a", None, None]
