import re

import pytest
from pyspark.sql import functions as F

from hoopline.llm.surrogates import KINDS, distinct_surrogates, luhn_sum, permuted_surrogates, replace_personal_data

CARD = "4539578763621486"
TEXTS = [
    (1, "Mail Ann.Lee7@Mail.example.com or ann.lee7@mail.example.com, call +1 (017) 555-7713 or +10175557713."),
    (2, f"card {CARD}, 4539-5787-6362-1486; order 4539578763621487; host 97.51.17.173 and 10.0.3.4"),
    (3, 'api_key = "04dbebab91ab85687d33eeaaf9ac699e1188f962" token: ABCDEFabcdef0123456789xyz'),
    (4, "Mrs. Anna Schmidt met Mr Peter Schmidt. Schmidt agreed; Schmidtke did not. Frau Weiß too. Г-жа Анна Петрова."),
    (5, "Nothing here: version 1.2.3.4.5, 12 345 6789, a@b, 300.1.1.1."),
    (6, None), (7, ""), (None, "bob@x.org"), (1, "bob@x.org"), (8, "SSN 219-09-9999"), (8, "SSN 219-09-9999"),
    (9, "other bob2@x.org and " + "x " * 5000 + "bob@x.org"),
]


@pytest.fixture(scope="module")
def made(spark):
    df = spark.createDataFrame([(d, t, "x") for d, t in TEXTS], "doc_id long, text string, kind string").repartition(4)
    return replace_personal_data(df, "secret").collect()


def text_of(made, doc_id, start=""):
    return next(r["text"] for r in made if r["doc_id"] == doc_id and (r["text"] or "").startswith(start))


def luhn(s):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(s))) % 10 == 0


def test_one_row_per_document(made):
    assert sorted(str(r["doc_id"]) for r in made) == sorted(str(d) for d, _ in TEXTS)
    assert [r["text"] for r in made if r["doc_id"] == 6] == [None] and text_of(made, 7) == ""
    assert text_of(made, 5) == TEXTS[4][1]
    counts = {r["doc_id"]: [r[f"n_{k}"] for k in KINDS] for r in made if r["doc_id"] in (2, 3, 4, 5)}
    assert counts == {2: [0, 2, 0, 0, 2, 0, 0], 3: [0, 0, 0, 0, 0, 2, 0], 4: [0, 0, 0, 0, 0, 0, 4], 5: [0] * 7}


def test_one_entity_one_surrogate(made):
    one = re.fullmatch(r"Mail (\S+@\S+) or (\S+@\S+), call \+1 \((\d{3})\) (\d{3})-(\d{4}) or \+(\d{11})\.", text_of(made, 1, "Mail"))
    assert one and one[1] == one[2] and re.fullmatch(r"[a-z]{3}\.[a-z]{3}\d@[a-z]{4}\.[a-z]{7}\.com", one[1])
    assert one[1] != "ann.lee7@mail.example.com" and "1" + one[3] + one[4] + one[5] == one[6] != "10175557713"
    bobs = {text_of(made, None), text_of(made, 1, text_of(made, None)), text_of(made, 9).rsplit(" ", 1)[1]}
    assert len(bobs) == 1 and "bob@x.org" not in bobs
    assert len({r["text"] for r in made if r["doc_id"] == 8}) == 1


def test_formats_are_kept(made):
    two = re.fullmatch(r"card (\d{16}), (\d{4}-\d{4}-\d{4}-\d{4}); order 4539578763621487; host ([\d.]+) and (10\.[\d.]+)", text_of(made, 2))
    assert two and two[1] == two[2].replace("-", "") != CARD and luhn(two[1]) and two[1][0] == "4"
    assert all(0 <= int(o) <= 255 for g in (two[3], two[4]) for o in g.split(".")) and two[3] != "97.51.17.173"
    three = re.fullmatch(r'api_key = "([0-9a-f]{40})" token: ([A-Z]{6}[a-z]{6}\d{10}[a-z]{3})', text_of(made, 3))
    assert three and three[1] != "04dbebab91ab85687d33eeaaf9ac699e1188f962"


def test_persons_keep_gender_script_and_coreference(made):
    four = re.fullmatch(
        r"Mrs\. (\w+) (\w+) met Mr (\w+) (\w+)\. (\w+) agreed; Schmidtke did not\. Frau (\w+) too\. Г-жа (\w+) (\w+)\.", text_of(made, 4)
    )
    assert four and four[2] == four[4] == four[5] != "Schmidt" and four[1] != four[3]
    assert re.fullmatch("[А-я]+", four[7]) and re.fullmatch("[А-я]+", four[8])


def test_keyed(spark):
    df = spark.createDataFrame([(1, "bob@x.org")], "doc_id long, text string")
    first, again, other = (replace_personal_data(df, k).first()["text"] for k in ("a", "a", "b"))
    assert first == again != other


def test_surrogates_are_distinct(spark):
    entities = spark.range(400).select(
        F.explode(F.array(F.lit("given_m"), F.lit("ssn"))).alias("kind"), F.format_string("%09d", "id").alias("entity")
    )
    got = distinct_surrogates(entities, "k").collect()
    assert len({(r["kind"], r["surrogate"]) for r in got}) == len(got) == 800
    assert not {(r["kind"], r["surrogate"]) for r in got} & {(r["kind"], r["entity"]) for r in got}


def test_formats_with_few_values(spark):
    entities = [("email", f"{chr(97 + k)}@x.org") for k in range(26)]
    entities += [("ip", f"192.168.{k % 256}.{k // 256}") for k in range(65536)] + [("ip", "8.8.8.8"), ("ip", "10.0.0.1")]
    df = spark.createDataFrame(entities, "kind string, entity string")
    got = {(r["kind"], r["entity"]): r["surrogate"] for r in distinct_surrogates(df, "k").collect()}
    assert set(got) == set(entities) and len({(k, v) for (k, _), v in got.items()}) == len(entities)
    assert all(v != e for (_, e), v in got.items())
    assert all(re.fullmatch(r"[a-z]+@[a-z]\.org", got["email", e]) for k, e in entities if k == "email")
    assert all(v.startswith("192.168.") for (_, e), v in got.items() if e.startswith("192.168."))


def test_permutation_of_closed_formats(spark):
    rows = [("ssn", f"{k:09d}") for k in range(0, 10**9, 1234567)] + [("phone", f"1{k:06d}") for k in range(0, 10**6, 1009)]
    rows += [("card", CARD), ("card", "4000000000000002")] + [("ip", f"{k}.{k * 7 % 256}.3.9") for k in range(1, 256)]
    df = spark.createDataFrame(rows, "kind string, entity string")
    got = {(r["kind"], r["entity"]): r["surrogate"] for r in permuted_surrogates(df, "k").collect()}
    assert set(got) == set(rows) and len({(k, v) for (k, _), v in got.items()}) == len(rows)
    for (kind, entity), v in got.items():
        assert v != entity and (kind == "ip" or len(v) == len(entity))
        assert kind != "phone" or v[0] == "1"
        assert kind != "card" or luhn(v) and v[0] == "4"
        assert kind != "ip" or v.startswith(("10.", "127.")) == entity.startswith(("10.", "127."))


def test_no_rows(spark):
    assert replace_personal_data(spark.createDataFrame([], "doc_id long, text string"), "k").collect() == []


def test_check_digits(spark):
    df = spark.createDataFrame([(CARD,), ("79927398713",), ("79927398710",)], "d string").select(luhn_sum(F.col("d")) % 10)
    assert [r[0] == 0 for r in df.collect()] == [True, True, False]
