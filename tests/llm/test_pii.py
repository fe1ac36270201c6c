"""Pseudonyms keep format and validity, are one to one, and link equal values."""

import re

from rivulet.llm import pii


def luhn(number):
    d = [int(c) for c in re.sub(r"\D", "", number)][::-1]
    return sum(x if i % 2 == 0 else (x * 2 - 9 if x > 4 else x * 2) for i, x in enumerate(d)) % 10 == 0


def test_values_are_permuted_within_their_format(spark):
    texts = [
        "card 4111 1111 1111 1111, again 4111-1111-1111-1111; bad 4111 1111 1111 1112",
        "born 1985-02-28 not 1985-02-30, ssn 123-45-6789 ip 45.114.23.72 no 999.1.1.1",
        "mail Ann.Lee@mail.example.com, phone +1 555-123-4567 end", None, "", "nothing here",
    ]
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, n int")
    got = {r.doc_id: r for r in pii.pseudonymise(docs, "k").collect()}
    one, other = re.findall(r"\d{4}[ -]\d{4}[ -]\d{4}[ -]\d{4}", got[0].text)[:2]
    assert luhn(one) and one != "4111 1111 1111 1111" and one.replace(" ", "-") == other
    assert got[0].text.endswith("bad 4111 1111 1111 1112")
    assert re.fullmatch(r"born \d{4}-\d\d-\d\d not 1985-02-30, ssn \d{3}-\d\d-\d{4} ip [\d.]+ no 999.1.1.1", got[1].text)
    assert "123-45-6789" not in got[1].text and "45.114.23.72" not in got[1].text and "1985-02-28" not in got[1].text
    assert "Ann" not in got[2].text and "555-123-4567" not in got[2].text
    assert (got[3].text, got[4].text, got[5].text) == (None, "", "nothing here")
    assert pii.pseudonymise(docs.limit(0), "k").collect() == []


def test_values_beside_other_numbers_are_found(spark):
    phone, social, date = r"\d{3}-\d{3}-\d{4}", r"\d{3}-\d\d-\d{4}", r"\d{4}-\d\d-\d\d"
    card = r"\d{4} \d{4} \d{4} \d{4}"
    cases = [
        ("555-123-4567 555-987-6543", f"({phone}) ({phone})"),
        ("123-45-6789 555-123-4567", f"({social}) ({phone})"),
        ("123-45-6789 1985-02-28", f"({social}) ({date})"),
        ("1985-02-28 555-123-4567 123-45-6789", f"({date}) ({phone}) ({social})"),
        ("ref 7 4111111111111111", r"ref 7 (\d{16})"),
        ("1234 4111 1111 1111 1111", f"1234 ({card})"),
        ("4111 1111 1111 1111 555-123-4567", f"({card}) ({phone})"),
        ("555-123-4567 4111 1111 1111 1111", f"({phone}) ({card})"),
        ("4111 1111 1111 1111 5500 0000 0000 0004", f"({card}) ({card})"),
        ("4111 1111 1111 1112 555-123-4567", f"4111 1111 1111 1112 ({phone})"),
        ("3782 822463 10005 123-45-6789", rf"(\d{{4}} \d{{6}} \d{{5}}) ({social})"),
        ("45 555-123-4567", f"45 ({phone})"),
        ("41 1111 1111 1111 11", r"(\d\d \d{4} \d{4} \d{4} \d\d)"),
        ("4111111111111111@mail.example.com", r"(u[0-9a-f]{12}@example.org)"),
    ]
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "doc_id long, text string")
    got = {r.doc_id: r for r in pii.pseudonymise(docs, "k").collect()}
    for i, (text, form) in enumerate(cases):
        new = re.fullmatch(form, got[i].text)
        assert new, (text, got[i].text)
        for value in new.groups():
            assert value not in text, (text, got[i].text)
            if len(re.sub(r"\D", "", value)) > 12 and "@" not in value:
                assert luhn(value), (text, got[i].text)
    assert got[5].text[5:] == got[6].text[:19] == got[7].text[13:] == got[8].text[:19]
    assert got[0].text[:12] == got[1].text[12:] == got[9].text[20:] == got[11].text[3:]


def test_the_network_is_one_to_one(spark):
    df = spark.range(1000).selectExpr("lpad(cast(id as string), 3, '0') as d")
    assert df.select(pii.feistel(df["d"], "k", "x").alias("p")).distinct().count() == 1000


def test_long_runs_take_time_in_proportion_and_no_stack(spark):
    runs = ["a" * 1_000_000, "7" * 1_000_000, "1-" * 500_000, "x@" + "a." * 100_000, "a." * 500_000, "1." * 500_000]
    mails = "x@a.org " * 3
    docs = spark.createDataFrame([(i, f"{r} {mails}") for i, r in enumerate(runs)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in pii.pseudonymise(docs, "k").collect()}
    for i, r in enumerate(runs):
        assert got[i]["n_found"] == (4 if i == 3 else 3), i
        assert "x@a.org" not in got[i]["text"]
        assert i == 3 or got[i]["text"].startswith(r)


def test_only_replaced_values_count_and_names_may_clash(spark):
    rows = [("1985-02-30 999.1.1.1", 0), ("4111 1111 1111 1112", 0), ("1985-02-28 4111 1111 1111 1111", 2), (None, 0), ("", 0)]
    names = "text string, want int, _cards string, first int, pieces string, put int, row int, n_found int"
    docs = spark.createDataFrame([(t, n, "c", 1, "p", 2, 3, 9) for t, n in rows], names)
    got = pii.pseudonymise(docs, "k")
    assert got.columns == docs.columns
    for r in got.collect():
        assert r["n_found"] == r["want"]
        assert (r["_cards"], r["first"], r["pieces"], r["put"], r["row"]) == ("c", 1, "p", 2, 3)
