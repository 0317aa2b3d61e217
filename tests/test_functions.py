"""Unit vectors of the Column functions and similarities."""

import pytest
from pyspark.sql import functions as F

from kinweave.functions import similarity as S
from kinweave.functions.address import normalize_addresses
from kinweave.functions.lexicon import LEGAL_FORMS
from kinweave.functions.names import basic_clean, name_words, normalize_names
from kinweave.functions.segment import Segmenter
from kinweave.functions.text import edit_distance, fix_homoglyphs, has_native, phonetic_squeeze, to_ascii


def one(spark, column, **values):
    return spark.createDataFrame([tuple(values.values())], list(values)).select(column.alias("r")).first()["r"]


@pytest.mark.parametrize("given,wanted", [("g1obal", "global"), ("c0ffee", "coffee"), ("c0ff33", "c0ff33"), ("14th", "14th"), ("abc", "abc"), ("123", "123")])
def test_homoglyphs(spark, given, wanted):
    assert one(spark, fix_homoglyphs(F.col("w")), w=given) == wanted


@pytest.mark.parametrize("given,wanted", [("raam", "rm"), ("ram", "rm"), ("limtid", "lmtd"), ("limited", "lmtd"), ("", "")])
def test_phonetic(spark, given, wanted):
    assert one(spark, phonetic_squeeze(F.col("w")), w=given) == wanted


@pytest.mark.parametrize("given,wanted", [("Kayley's", "kayleys"), ("L.L.C.", "llc"), ("A & B", "a and b"), ("Acme (ID: 123)", "acme"), ("Gurgaon-122001", "gurgaon"), ("", "")])
def test_basic_clean(spark, given, wanted):
    assert one(spark, basic_clean(F.col("w")), w=given) == wanted


def test_edit_distance_and_scripts(spark):
    row = spark.createDataFrame([("kitten", "sitting", "café", "नमस्ते")], "a string, b string, c string, d string")
    got = row.select(edit_distance(F.col("a"), F.col("b"), 2), edit_distance(F.col("a"), F.col("b"), 3), to_ascii("c"), has_native(F.col("d")), has_native(F.col("c"))).first()
    assert tuple(got) == (3, 3, "cafe", True, False)


def test_names(spark):
    rows = [("Acme Pvt Ltd",), ("zetahalo dba The Acme Group LLC",), ("www.acme-tools.com",), ("Prislie Plrvae Limited",), ("",), (None,), ("Ltd",)]
    got = [tuple(r) for r in normalize_names(spark.createDataFrame(rows, "business_name string")).select("name_core", "name_key", "name_alt", "legal", "name_is_domain").collect()]
    assert got[0] == ("acme", "acme", "", "ltd pvt", 0)
    assert got[1] == ("acme group", "acme", "zetahalo", "llc", 0)
    assert got[2] == ("acme tools", "acme tools", "", "", 1)
    assert got[3] == ("prislie", "prislie", "", "ltd pvt", 0)
    assert got[4] == got[5] == ("", "", "", "", 0)
    assert got[6] == ("ltd", "ltd", "", "ltd", 0)


def test_address(spark):
    rows = [
        ("tx 75001, 32nd avenue, 07 Main St, Unit 4", "US"), ("32nd avenue, 8th street", "US"), ("12 rue de la Paix, 33000 Bordeaux", "France"),
        ("Tirunelveli-627 002", "India"), ("FL, 1 Fourteenth Ave", "US"), ("c/o Ann Lee, 5 Oak Rd near Town Hall", "US"), (None, None), ("N/A", "US"),
        ("po box 12, 2nd floor, rez de chaussee", "US"), ("5 Oak Rd c/o Ann Lee, 75001, 9", "US"), ("3 ste anne, apt 2", "France"), ("9 Oak St, Pune, Goa, Pune", "Nowhere"),
        (" ,, ", ""), ("दिल्ली, 4 Main Rd", "India"),
    ]
    gazetteer = {"nowhere": {"cities": {"goa": 9, "pune": 30}, "states": []}, "france": {"cities": {"bordeaux": 7}}}
    source = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, business_address string, country string")
    a = [r.asDict() for r in normalize_addresses(source).orderBy("i").collect()]
    assert (a[0]["state"], a[0]["postcode"], a[0]["house_num"], a[0]["unit"]) == ("texas", "75001", "7", "4")
    assert (a[0]["all_nums"], a[0]["street"]) == ("7", "32nd avenue main street")
    assert a[1]["house_num"] == ""
    assert (a[2]["postcode"], a[2]["house_num"], a[2]["locality"]) == ("33000", "12", "bordeaux")
    assert a[3]["postcode"] == "627002"
    assert a[4]["state"] == "florida" and "14th" in a[4]["street"]
    assert a[5]["landmark"] == "c o ann lee | near town hall"
    for i in (6, 7):
        assert a[i]["addr_missing"] == 1 and {v for k, v in a[i].items() if k not in ("i", "business_address", "country", "addr_missing")} == {"", 0}
    assert a[8]["unit"] == "box12 fl2 flgro"
    assert (a[9]["landmark"], a[9]["street"], a[9]["postcode"], a[9]["all_nums"]) == ("c o ann lee", "oak road", "75001", "5 9")
    assert (a[10]["unit"], a[10]["street"]) == ("2", "sainte anne")
    assert (a[12]["addr_missing"], a[12]["addr_clean"], a[13]["addr_translit"], a[13]["street"]) == (0, "", 1, "main road")
    b = [r.asDict() for r in normalize_addresses(source, gazetteer).orderBy("i").collect()]
    assert (b[11]["city"], b[11]["locality"], b[11]["addr_clean"]) == ("pune", "goa", "9 oak street goa pune")
    assert (b[2]["city"], b[2]["locality"]) == ("bordeaux", "")


def test_segmenter():
    own = Segmenter({"energy": 50, "vr": 20, "textile": 30, "big": 500, "a": 3})
    assert own.split("energyvrtextile") == ["energy", "vr", "textile"]
    assert own.repair("energyvrtextile") == ["energy", "vr", "textile"]
    assert own.repair("8ig") == ["big"] and own.repair("zzz") == ["zzz"]


def plain_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            row[j], last = (last + 1 if x == y else max(row[j], row[j - 1])), row[j]
    return row[-1]


def test_similarities():
    import random

    rng = random.Random(1)
    for _ in range(300):
        a, b = ("".join(rng.choice("abcd ") for _ in range(rng.randint(0, 12))) for _ in "ab")
        assert S.lcs(a, b) == plain_lcs(a, b)
    assert S.ratio("", "") == 100 and S.ratio("a", "") == 0
    assert S.token_set_ratio("b a", "a b c") == 100 and S.token_sort_ratio("b a", "a b") == 100
    assert S.partial_ratio("abc", "xxabcxx") == 100
    assert round(S.jaro_winkler("martha", "marhta"), 4) == 0.9611


def test_name_rules_are_worked_out_once(spark):
    """each rule of a name stands once in its expression, so that its cost does not grow with the words' number to the third."""
    text = name_words(F.col("w"))._jc.toString()
    assert text.count("regexp_replace") < 40


def test_record_rules_are_worked_out_once(spark):
    """the rules of a whole record stay in their own steps of the plan, a name's too."""
    from kinweave.plans.linkage import normalize

    rows = spark.createDataFrame([("S1-1", "Acme Pvt Ltd", "5 Oak Rd, 75001, 9", "US")], "entity_id string, business_name string, business_address string, country string").repartition(1)
    df = normalize(rows)
    assert df._jdf.queryExecution().optimizedPlan().toString().count("pra li") <= 2
    assert [r["house_num"] + " " + r["name_core"] for r in df.collect()] == ["5 acme"]


def test_long_names(spark):
    """names of sixty words, an alias, and a misspelled legal form at the end."""
    words = [chr(97 + i % 26) * 3 + chr(97 + i // 26) for i in range(60)]
    rows = [(f"{' '.join(words)} dba {' '.join(words)} Prislie Plrvae Limited",)] * 20
    got = {tuple(r) for r in normalize_names(spark.createDataFrame(rows, "business_name string")).select("name_core", "name_alt", "legal").collect()}
    assert got == {(" ".join([*words, "prislie"]), " ".join(words), "ltd pvt")}


def test_name_fields_in_one_arrow_step(spark):
    """a table's names take one Arrow step and no expression on arrays; the words are those of the column rules."""
    names = ["The Acme & Sons (ID: 12) Pvt. Ltd.", "M S Acme Prfivete Limited", "g00gle 21st l.l.c.", "a.b. O'Neil ab1c3 #55", "École P Ltd", "the the", "U.S.A. compny Ltd", "\tx - 123 4567", ""]
    df = spark.createDataFrame([(n,) for n in names], "business_name string")
    made = normalize_names(df)
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "lambda" not in plan
    low = F.lower(to_ascii("business_name"))
    wanted = df.select("business_name", F.array_join(name_words(low), " ").alias("w"))
    got = {r["business_name"]: r for r in made.collect()}
    for r in wanted.collect():
        assert got[r["business_name"]]["name_clean"] == " ".join(LEGAL_FORMS.get(x, x) for x in r["w"].split())
    assert made.schema["name_translit"].dataType.simpleString() == "tinyint"
