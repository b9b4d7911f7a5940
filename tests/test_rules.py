"""Masking rules on rows worked out by hand."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tablemill.operators.masking import mask_table, rules_from_config
from tablemill.operators.rules import CONSTANT_RULES, RULES, MaskRule
from tablemill.spec import with_lengths


def mask(spark, values, rule, kind="string", lookups=None, **settings):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, a {kind}")
    masked = mask_table(df, [MaskRule(rule, ("a",), **settings)], lookups)
    assert masked.columns == df.columns
    return [r.a for r in masked.orderBy("i").collect()]


CASES = [
    ("R03", ["20230514", "20230515", "00000000", "99991231", " ", None],
     ["20230501", "20230515", "00000000", "99991231", " ", None],
     {"format_string": "YYYYMMDD", "default_1": "01", "default_2": "15"}),
    ("R03", ["14.05.2023", "15.05.2023"], ["01.05.2023", "15.05.2023"],
     {"format_string": "DD.MM.YYYY", "default_1": "01", "default_2": "15"}),
    ("R11", ["PF 12 34", "abc", "  ", None, "9" * 40 + "17"], ["505014", None, "  ", None, "505017"], {}),
    ("R13", ["0367-8", "", " ", None], ["0255-9", "", " ", None], {}),
    ("R17", ["65170839J003", "12345678901", " 5170839J003", "ABCDEFGHIJKL", "1234567890123", None],
     ["65150839J002", "12345678901", " 5170839J003", "ABCDEFGHIJKL", "1234567890123", None],
     {"default_1": "01", "default_2": "15", "default_3": "J"}),
    ("R19", ["D1", " ", None], ["53220257B045", " ", None], {"lookup_id": 26, "default_1": "x"}),
    ("R19", ["D1"], ["x"], {"lookup_id": 5, "default_1": "x"}),
    ("R23", ["K-AB 123", "ABC", "123", "K 12 X 12", "K 0", "K 99999999999999999999", None],
     ["K-AB 766", "ABC", "123", "K  X 37", "K 0", "K 0", None], {}),
    ("R24", ["WAAUE31090E072401", "W1", "WAAUE31090E072401XYZ", "abcde", " ", None],
     ["WXXUXX1XX0XX7XX0X", "XX", "WXXUXX1XX0XX7XX0XXYZ", "aXXdX", " ", None], {"default_1": "X"}),
    ("R24", ["abcde", "WAAUE31090E072401Z"], ["a__" + "__d__", "W____U____1____0____7____0__Z"],
     {"default_1": "__"}),
    ("R37", ["x", " ", "", None], ["K", "K", "K", None], {"default_1": "K"}),
    ("R56", ["Max Muster", "Max", " Max", " ", None], ["Max-", "Max-", "-", " ", None], {"default_1": "-"}),
    ("R83", ["2024-01-05 10:11:12", "20240203", "xx", None, "9999-12-31", "1500-01-01"],
     ["2024-01-05", "2024-02-03", "D", "D", "D", "D"], {"format_string": "%Y-%m-%d", "default_1": "D"}),
]


@pytest.mark.parametrize("rule, values, expected, settings", CASES)
def test_text_rules(spark, rule, values, expected, settings):
    assert mask(spark, values, rule, **settings) == expected


@pytest.mark.parametrize("rule", list(CONSTANT_RULES))
def test_constant_rules(spark, rule):
    values = ["x", " y ", "\t ", "", None]
    assert mask(spark, values, rule, default_1="gone") == ["gone", "gone", "\t ", "", None]


def test_date_rule_keeps_time_of_day(spark):
    values = [datetime(2023, 5, 14, 7, 8), datetime(2023, 5, 31), datetime(9999, 12, 31), None]
    settings = {"format_string": "DATE", "default_1": "1", "default_2": "15"}
    assert mask(spark, values, "R03", "timestamp_ntz", **settings) == [
        datetime(2023, 5, 1, 7, 8), datetime(2023, 5, 15), datetime(9999, 12, 31), None,
    ]
    assert mask(spark, [date(2024, 2, 29)], "R03", "date", **settings) == [date(2024, 2, 15)]


def test_illness_rule(spark):
    values = [3, 4, 5, 0, -9999, 15000, -1, None]
    assert mask(spark, values, "R69", "int") == [15017, 15012, 15017, 0, -9999, 15000, 15017, None]
    assert mask(spark, [3], "R69", "int", options={"literal": True}) == [15002]


def test_referral_and_process_rules(spark):
    df = spark.createDataFrame([("a", " "), ("b", "x"), ("c", None), ("d", "")], "a string, REFERRAL string")
    assert [r.a for r in mask_table(df, [MaskRule("R65", ("a",))]).collect()] == [None, "b", "c", "d"]
    rows = [
        ("a;b;N1|N2;c", "uv.ba.pr", "a;b;Anonym|Anonym;c"), ("a;b;;c", "uv.ja.pr", "a;b;;c"),
        ("a", "uv.jas.pr", "a;;"), ("a;b;N", "uv.ba.pr", "a;b;Anonym;"), ("a;b;N", "other", "a;b;N"),
        ("a;b;N;c;d", "uv.ba.pr", "a;b;Anonym;c;d"), (None, "uv.ba.pr", None), ("a;b;N", None, "a;b;N"),
    ]
    df = spark.createDataFrame(rows, "a string, k string, want string")
    for r in mask_table(df, [MaskRule("R82", ("a",), ("k",))]).collect():
        assert r.a == r.want


def word_lookup(spark):
    rows = [("muster", "Zeta"), ("muster", "Alpha"), ("langername", "Beta-Verylong"), ("nomask", None), ("m", "Em")]
    return spark.createDataFrame(rows, "k string, m string")


def test_word_rules(spark):
    values = ["Muster  ", "Langernamemore", "unknown", "nomask", " ", None]
    settings = {"lookup_columns": ("k", "m"), "lookup": "w", "default_1": "Default-Name"}
    lookups = {"w": word_lookup(spark)}
    assert mask(spark, values, "R01", lookups=lookups, lengths=(6,), **settings) == [
        "Alpha", "Beta-V", "Defaul", "Defaul", " ", None,
    ]
    assert mask(spark, values, "R06", lookups=lookups, **settings)[:3] == ["Alpha", "Beta-Verylong", "Default-Name"]
    assert mask(spark, values, "R10", lookups=lookups, **settings)[:3] == ["Em", "Default-Name", "Default-Name"]


def test_length_comes_from_the_target(spark):
    df = spark.createDataFrame([("Muster",)], "a string")
    rule = MaskRule("R02", ("a",), ("k", "m"), lookup="w", default_1="d")
    target = with_lengths(df, {"a": 3})
    assert mask_table(df, [rule], {"w": word_lookup(spark)}, target).first().a == "Alp"


def test_risk_rule_joins_null_keys(spark):
    lookup = spark.createDataFrame([("x", 7), (None, 8)], "k string, m int")
    df = spark.createDataFrame([(1, "x"), (2, None), (3, "y"), (None, "x")], "a int, k string")
    rule = MaskRule("R36", ("a",), ("k", "m"), lookup="risk", default_1="99")
    assert [(r.a, r.k) for r in mask_table(df, [rule], {"risk": lookup}).collect()] == [
        (7, "x"), (8, None), (99, "y"), (None, "x"),
    ]


def test_mail_rule_tells_mail_from_url(spark):
    lookup = spark.createDataFrame([("a", "mail@x", 7), ("a", "www.x", 8), ("a", "never", 1)], "k string, m string, art int")
    settings = {"lookup_columns": ("k", "m", "art"), "lookup": "w", "default_1": "dflt", "lengths": (5,)}
    values = ["A@b", "a.de", "z@b", "", None]
    assert mask(spark, values, "R14", lookups={"w": lookup}, **settings) == ["mail@", "www.x", "dflt", "", None]


def test_full_name_rule(spark):
    rows = [(3, "MUSTER", "Aa"), (1, "muster", "Zz"), (1, "Muster", "Yy"), (5, "Max", "Kim"), (7, "max", "no")]
    lookup = spark.createDataFrame(rows, "WORT_ART int, WORT_ORIG string, WORT_MASK string")
    settings = {
        "lookup_columns": ("WORT_ART", "WORT_ORIG", "WORT_MASK"), "lookup": "n",
        "default_1": "Nach,Vor", "format_string": "NACHNAME,VORNAME| ",
    }
    values = ["Muster Max", "Muster,Max", "Muster, Max", "Muster", "Other One", " ", None]
    assert mask(spark, values, "R46", lookups={"n": lookup}, **settings) == [
        "Yy Kim", "Yy Kim", "Yy Vor", "Yy Vor", "Nach Vor", " ", None,
    ]


def test_rules_see_earlier_rules(spark):
    """A lookup by a column masked before takes the masked value, as rules run in order."""
    lookup = spark.createDataFrame([("Max-", 1), ("Max Muster", 2)], "k string, m int")
    df = spark.createDataFrame([("Max Muster", 5)], "k string, a int")
    risk = MaskRule("R36", ("a",), ("k", "m"), lookup="risk", default_1="9")
    first = MaskRule("R56", ("k",), default_1="-")
    assert tuple(mask_table(df, [first, risk], {"risk": lookup}).first()) == ("Max-", 1)
    assert tuple(mask_table(df, [risk, first], {"risk": lookup}).first()) == ("Max-", 2)


def test_rules_from_config():
    rows = [
        {"attribut": "STR", "rule_name": "R12", "flg_rule_over": 1, "lkp_cols": "STRASSE"},
        {"attribut": "TEL", "rule_name": "R13"},
        {"attribut": "PLZ", "rule_name": "R12", "flg_rule_over": 1, "lkp_cols": "PLZ"},
        {"attribut": "N1", "rule_name": "R01", "lkp_cols": "K,M", "default_value_1": "old"},
        {"attribut": "N1", "rule_name": "R01", "lkp_cols": "K,M", "default_value_1": "new"},
        {"attribut": "N2", "rule_name": "R01", "lkp_cols": "K,M"},
        {"attribut": "X", "rule_name": "R99_TODO"},
    ]
    rules = rules_from_config(rows)
    assert [(r.rule, r.attributes, r.lookup_columns) for r in rules] == [
        ("R12", ("STR", "PLZ"), ("STRASSE", "PLZ")), ("R13", ("TEL",), ()),
        ("R01", ("N1",), ("K", "M")), ("R01", ("N2",), ("K", "M")),
    ]
    assert rules[2].default_1 == "new"


def test_unknown_rules_and_columns(spark):
    df = spark.createDataFrame([("x",)], "a string")
    with pytest.raises(ValueError, match="R98"):
        mask_table(df, [MaskRule("R98", ("a",))])
    assert mask_table(df, [MaskRule("R35", ("gone",), default_1="-")]).first().a == "x"
    with pytest.raises(ValueError, match="house number"):
        mask_table(df, [MaskRule("R12", ("a", "a", "a"), ("STRASSE", "PLZ", "ORT"))])
    assert len(RULES) == 40


def test_staged_lookups_give_the_same(spark):
    df = spark.createDataFrame([("Muster",), ("x",), (None,)], "a string")
    rule = MaskRule("R06", ("a",), ("k", "m"), lookup="w", default_1="d")
    plain = mask_table(df, [rule], {"w": word_lookup(spark)}).collect()
    assert mask_table(df, [rule], {"w": word_lookup(spark)}, stage=True).collect() == plain
