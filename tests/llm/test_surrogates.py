import re

import pytest
from pyspark.sql import functions as F

from panelweave.llm import surrogates as S

FIND = {
    "email": r"[A-Za-z0-9._-]+@[A-Za-z0-9.-]+\.[a-z]+",
    "ip": r"(?<![\d.])\d+\.\d+\.\d+\.\d+(?![\d.])",
    "card": r"(?<!\w)\d{16}(?!\w)",
    "phone": r"\+\d \(\d{3}\) \d{3}-\d{4}",
    "key": r"AKIA[A-Z0-9]{16}",
    "secret": r"(?<=password=)\w+|(?<=token = \")\w+",
}


def luhn(s):
    each = [int(c) * (1 + k % 2) for k, c in enumerate(reversed(s))]
    return sum(x - 9 if x > 9 else x for x in each) % 10


def test_given_documents(given):
    """Every entity is gone, has one surrogate wherever it stands, and nothing else has changed."""
    docs = given("documents")
    out = {r["doc_id"]: r for r in S.digest(docs).collect()}
    pattern = "|".join(FIND.values())
    made = {}
    for r in docs.collect():
        old, new = re.findall(pattern, r["text"]), re.findall(pattern, out[r["doc_id"]]["text"])
        assert len(old) == len(new) == out[r["doc_id"]]["n_entities"]
        assert re.split(pattern, r["text"]) == re.split(pattern, out[r["doc_id"]]["text"])
        for a, b in zip(old, new):
            assert made.setdefault(a, b) == b and a != b and len(a) == len(b) or re.fullmatch(FIND["ip"], a)
            assert re.sub("[0-9]", "9", re.sub("[a-z]", "a", re.sub("[A-Z]", "A", b))) == re.sub("[0-9]", "9", re.sub("[a-z]", "a", re.sub("[A-Z]", "A", a))) or re.fullmatch(FIND["ip"] + "|" + FIND["key"] + "|[0-9a-f]+", a)
            if re.fullmatch(FIND["card"], a):
                assert luhn(a) == luhn(b)
    assert len(made) > 5 and len(set(made.values())) == len(made) and not set(made) & set(made.values())


def test_layouts_names_and_edges(documents):
    texts = [
        "Jo.Doe@Mail8.example.com, jo.doe@mail8.example.com", "+1 (988) 555-2485 or +1-988-555-2485", "4041894974608795 4041 8949 7460 8795",
        "Mr. John Smith, Mr John Smith, Mrs Jane Smith", "г-н Иванов, г-жа Анна Петрова", None, "", "CC BY-NC 4.0 in 1999-2000, 3.14 and 10,000",
        "a@b.co", "a@b.co", "x" * 200_000 + "@", "1" * 100_000, "123-45-6789 DE89 3704 0044 0532 0130 00 DE89370400440532013000",
    ]
    docs = documents(*texts).withColumn("matches", F.lit("x")).withColumn("h1", F.lit(1))
    out = {r["doc_id"]: (r["n_entities"], r["text"]) for r in S.digest(docs).collect()}
    a, b = out[0][1].split(", ")
    assert a.lower() == b and a != b and a.endswith(".com") and out[0][0] == 2
    a, b = out[1][1].split(" or ")
    assert re.sub(r"\D", "", a) == re.sub(r"\D", "", b) and re.fullmatch(FIND["phone"], a)
    a, b = out[2][1].split(" ", 1)
    assert a == b.replace(" ", "") and luhn(a) == luhn("4041894974608795")
    a, b, c = out[3][1].split(", ")
    assert a[4:] == b[3:] and a[4:].split()[0] in S.GIVEN["male latin"] and c[4:].split()[0] in S.GIVEN["female latin"]
    a, b = out[4][1].split(", ")
    assert re.fullmatch("г-н [А-Я][а-я]+", a) and b.split()[1] in S.GIVEN["female cyrillic"]
    for k in (5, 6, 7, 10, 11):
        assert out[k] == (0, texts[k])
    assert out[8] == out[9] and out[8][1] != "a@b.co"
    assert out[12][0] == 3 and re.fullmatch(r"\d{3}-\d{2}-\d{4} DE\d\d( \d{4}){4} \d\d DE\d{20}", out[12][1])
    full = S.replaced(docs).select("row.*")
    assert full.columns == docs.columns
    assert S.digest(docs.filter("false")).count() == 0


def test_another_key_gives_other_surrogates(documents):
    docs = documents("mail a.long.name@mail.example.com")
    assert S.digest(docs, "one").first()["text"] != S.digest(docs, "two").first()["text"]


def test_collisions_are_drawn_again(spark):
    """One-letter secrets of one format fill their space, so first draws collide and hit real ones."""
    rows = [("phone", str(k), "") for k in range(1, 5)]
    got = S.surrogates(spark.createDataFrame(rows, "kind string, canonical string, variant string")).collect()
    made = {r["canonical"]: r["surrogate"] for r in got}
    assert len(set(made.values())) == 4 and not set(made) & set(made.values()) and "0" not in made.values()


def test_no_room_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(S, "DRAWS", 3)
    rows = [("phone", str(k), "") for k in range(1, 10)]
    with pytest.raises(RuntimeError):
        S.surrogates(spark.createDataFrame(rows, "kind string, canonical string, variant string"))


def test_long_secrets_and_names(documents):
    """The whole run goes, however long, and what differs at its end only stays two entities."""
    run = "aB3-" * 1500
    texts = [f"token: {run}x end", f"token: {run}y end", f"token: {run}x end", "password=" + "0a" * 100_000, "Mr " + "Ab" + "c" * 60 + " left"]
    out = {r["doc_id"]: (r["n_entities"], r["text"]) for r in S.digest(documents(*texts)).collect()}
    a, b, c = (out[k][1].removeprefix("token: ").removesuffix(" end") for k in range(3))
    assert a == c != b and len(a) == len(b) == len(run) + 1 and all(n == 1 for n, _ in out.values())
    for made in (a, b):
        assert re.fullmatch("(?:[a-z][A-Z][0-9]-){1500}[a-z]", made) and sum(x == y for x, y in zip(made, run)) < len(run) / 2
    assert re.fullmatch("password=(?:[0-9][a-f]){100000}", out[3][1]) and out[3][1] != texts[3]
    assert re.fullmatch(r"Mr [A-Z][a-z]{7} left", out[4][1])


SHAPES = [
    "+49 170 1234567", "+44 7700 900123", "(030) 1234567", "+1 5551234567", "5551234567", "+33 6 12 34 56 78", "01 23 45 67 89", "0170/1234567", "555-1234", "98765 43210",
    "2001:db8::8a2e:370:7334", "2001:0DB8:0:0:0:8a2e:370:7334", "ghp_abcdefghij0123456789abcdefghij012345", "eyJhbGciOiJIUzI1NiJ9.eyJzdWIiOiIxMjM0In0.abc-DEF_123",
]
CLEAN = ["2024-01-15", "15.01.2024 and 01/15/24", "2024-01-15 2024-01-16", "1999-2000 or 1914/1918", "12 34 56", "08.30-12.00", "3.14159265358", "12:30:45", "std::vector", "a bearer of certificates", "1500000 people"]


def test_more_shapes(documents):
    """Formats of other places are found whole; dates and the like stay."""
    out = [r["text"] for r in S.digest(documents(*(f"see {x}, then" for x in SHAPES + CLEAN))).orderBy("doc_id").collect()]
    for old, new in zip(SHAPES, out):
        made = new.removeprefix("see ").removesuffix(", then")
        assert made != old and len(made) == len(old) and re.sub("[0-9a-zA-Z]", "", made) == re.sub("[0-9a-zA-Z]", "", old) and f"see {made}, then" == new, old
        assert ":" not in old or re.fullmatch("[0-9a-fA-F:]+", made)
    assert out[len(SHAPES) :] == [f"see {x}, then" for x in CLEAN]


def test_names_and_their_mentions(documents):
    texts = [
        "Smithson met Mr J. Smith. Smith left; J. Smith's hat and Mr J. Smith's dog.", "Prof. Dr. Anna Meyer and Dr Bob Stone; Anna Meyer, Meyer, Stone.", "Mrs Anna Meyer", "Smith and Meyer alone",
        "Herr von der Berg, Mrs Mary-Ann O'Neil", "Mr Smith, 2024-01-15, Smith",
    ]
    out = {r["doc_id"]: (r["n_entities"], r["text"]) for r in S.digest(documents(*texts)).collect()}
    got = re.fullmatch(r"Smithson met Mr ([A-Z]\.) ([A-Z]\w+)\. (\w+) left; (\S+ \w+)'s hat and Mr (\S+ \w+)'s dog\.", out[0][1])
    assert got and got[2] == got[3] != "Smith" and got[4] == got[5] == f"{got[1]} {got[2]}" and out[0][0] == 4
    got = re.fullmatch(r"Prof\. Dr\. (\w+) (\w+) and Dr (\w+) (\w+); (\w+ \w+), (\w+), (\w+)\.", out[1][1])
    assert got and got[5] == f"{got[1]} {got[2]}" and got[6] == got[2] and got[7] == got[4] and out[1][0] == 5
    assert out[2][1] == f"Mrs {got[5]}" and got[1] in S.GIVEN["female latin"] and got[3] in S.GIVEN["neutral latin"]
    assert out[3] == (0, texts[3])
    assert out[4][0] == 2 and not re.search("Berg|Mary|Ann|Neil", out[4][1])
    got = re.fullmatch(r"Mr (\w+), 2024-01-15, (\w+)", out[5][1])
    assert got[1] == got[2] != "Smith" and out[5][0] == 2
