"""Formats, coreference and distinctness of surrogates, and how texts are cut into pieces."""

import ipaddress
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from constella.llm.surrogates import pieces, replace

DOCUMENTS = "doc_id bigint, text string, n_entities string, _pieces int, _m int, _T int, _again int"


@pytest.fixture(scope="module")
def replaced(spark):
    def run(texts):
        rows = [(i, t, "x", 1, 2, 3, 4) for i, t in enumerate(texts)]
        return [r.text for r in replace(spark.createDataFrame(rows, DOCUMENTS), "k").orderBy("doc_id").collect()]
    return run


def mod97(iban):
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97


def test_phones_keep_their_country_code_or_leading_zero(replaced):
    for text, kept in (("+49 30 1234567", "+49 "), ("+33 6 12 34 56 78", "+33 "), ("+353 1 234 5678", "+353 "),
                       ("+1 (415) 555-1234", "+1 ("), ("+7 912 345 67 89", "+7 "), ("06 12 34 56 78", "0"), ("030/1234567", "0")):
        [said] = replaced([f"call {text} now"])
        said = re.fullmatch("call (.*) now", said)[1]
        assert said.startswith(kept) and said != text
        assert re.sub(r"\d", "9", said) == re.sub(r"\d", "9", text)


def test_one_number_written_in_two_ways_gets_one_surrogate(replaced):
    digits = [re.sub(r"\D", "", t) for t in replaced(["at +1 (415) 555-1234", "at 1-415-555-1234", "at +14155551234", "at 415-555-1234"])]
    assert digits[0] == digits[1] == digits[2] != digits[3]


def test_ibans_get_the_check_digits_of_their_new_number(replaced):
    ibans = ["DE89370400440532013000", "GB29NWBK60161331926819", "FR1420041010050500013M02606", "NO9386011117947",
             "MT84MALT011000012345MTLCAST001S"]
    got = [re.fullmatch("pay (.*) now", t)[1] for t in replaced([f"pay {i} now" for i in ibans])]
    for old, new in zip(ibans, got):
        assert new != old and new[:2] == old[:2] and len(new) == len(old) and mod97(new) == 1
        assert re.sub("[A-Z]", "A", re.sub(r"\d", "9", new)) == re.sub("[A-Z]", "A", re.sub(r"\d", "9", old))
    assert replaced(["pay DE89 3704 0044 0532 0130 00 now"])[0].replace(" ", "") == f"pay{got[0]}now"


def test_private_addresses_stay_in_their_network(replaced):
    nets = ["10.0.0.0/8", "127.0.0.0/8", "192.168.0.0/16", "172.16.0.0/12", "169.254.0.0/16", "100.64.0.0/10"]
    inside = [(n, str(ipaddress.ip_network(n)[k])) for n in nets for k in (259, 5_000, 65_000)]
    outside = ["172.15.1.2", "172.32.1.2", "100.63.1.2", "8.8.8.8"]
    got = [t.split()[1] for t in replaced([f"at {a} now" for _, a in inside] + [f"at {a} now" for a in outside])]
    for (net, old), new in zip(inside, got):
        assert new != old and ipaddress.ip_address(new) in ipaddress.ip_network(net)
    for old, new in zip(outside, got[len(inside):]):
        assert new != old and ipaddress.ip_address(new).is_global


def test_distinct_entities_stay_distinct_and_equal_ones_equal(replaced):
    texts = [f"write to user{i % 400}@example.org, call +44 20 7946 {i % 400:04d}, ask Mr {n}son Smith{n}"
             for i in range(800) for n in ["Adam"]]
    got = replaced(texts)
    for field in (r"to (\S+),", r"call (.*),", r"ask (.*)"):
        old, new = ([re.search(field, t)[1] for t in x] for x in (texts, got))
        assert len(set(zip(old, new))) == len(set(old)) == len(set(new)) and not set(old) & set(new)


def test_columns_of_any_name_pass_and_edges(spark, replaced):
    rows = spark.createDataFrame([(1, "mail a.b@c.org", "x", 1, 2, 3, 4), (1, "mail a.b@c.org", "x", 1, 2, 3, 4),
                                  (None, None, None, None, None, None, None), (2, "", "y", 0, 0, 0, 0)], DOCUMENTS)
    out = replace(rows, "k")
    assert out.columns == ["doc_id", "text", "_pieces", "_m", "_T", "_again", "n_entities"]
    got = sorted(map(tuple, out.collect()), key=repr)
    assert got[0] == got[1] and got[0][2:] == (1, 2, 3, 4, 1) and got[0][1] != "mail a.b@c.org"
    assert got[2:] == [(2, "", 0, 0, 0, 0, 0), (None, None, None, None, None, None, 0)]
    assert replace(rows.limit(0), "k").count() == 0


@settings(max_examples=5, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["a@b.org", "+1 415 555 1234", "\x01", " ", "\n", "é", "10.0.0.1", "Mr Smith", "x", ","]),
                         max_size=12).map("".join), min_size=1, max_size=30))
def test_pieces_are_the_same_by_one_pass_and_by_two(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for t, got, marked in df.select("t", pieces(F.col("t")).alias("p"), pieces(F.concat("t", F.lit("\n\x01"))).alias("m")).collect():
        assert "".join(got) == t and len(got) % 2 == 1
        assert marked[:-1] + [marked[-1][:-2]] == got
