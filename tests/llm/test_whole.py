"""Rows that earlier versions dropped, missed or left as they were."""

import random

import pytest

import corpus_pipeline
from constella.llm.common import importable

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="module")
def documents(spark):
    importable(spark)
    return lambda rows: spark.createDataFrame([(i, t, lang, "s", len(t or "")) for i, t, lang in rows], DOCUMENTS)


def test_near_copies_keeps_one_row_of_each_group_of_texts(spark, documents):
    x = "the quick brown fox jumps over the lazy dog near the old river bank at dawn"
    y = "seven bright lanterns hung above a quiet market while rain fell on slate roofs"
    z = "le renard brun saute par dessus le chien paresseux sous un grand ciel d'automne"
    kept = lambda rows: sorted(((r.doc_id, r.text) for r in corpus_pipeline.near_copies(
        spark, documents([(*r, "en") for r in rows]), "").collect()), key=repr)
    assert kept([(7, x), (7, y), (7, y)]) == sorted([(7, x), (7, y)], key=repr)
    # X is a copy of document 3: Y's group must not vanish with it
    assert kept([(3, x), (7, x), (7, y), (8, y)]) == sorted([(3, x), (7, y)], key=repr)
    assert kept([(None, x), (5, x), (None, z), (None, z)]) == sorted([(5, x), (None, z)], key=repr)
    assert kept([]) == []


def test_language_keeps_clean_texts_whose_profile_holds_few_of_their_ngrams(spark, documents):
    # a script without spaces: most pairs and triples of a text lie outside a profile of 400
    rng = random.Random(5)
    signs = [chr(0x4e00 + i) for i in range(3000)]
    text = lambda n: "".join(rng.choices(signs, [1 / (i + 1) for i in range(3000)], k=n))
    rows = [(i, text(rng.randint(10, 400)), "zh") for i in range(150)]
    rows += [(1000, None, "zh"), (1001, "12 !!", "zh"), (1002, "щж", "zh"), (1003, "the fox and the dog", "en")]
    # (1002) takes part in learning, but its n-grams are too rare for a profile
    got = {r.doc_id for r in corpus_pipeline.language(spark, documents(rows), "").collect()}
    assert got == {*range(150), 1003}


LEFT = [    # (text, what must not stay, what must)
    ("password: hunter2x end", ["hunter2x"], ["password: ", " end"]), ("password=Ab/c+d.e=9f then", ["Ab", "9f"], ["then"]),
    ("token " + "aB3_" * 400 + ".", ["aB3_aB3_"], ["token "]), ('{"password": "correct horse \\"x\\" battery", "n": 1}', ["horse", "battery"], ['"n": 1}']),
    ("api_key='s3/cr+et.v' ok", ["s3/cr", "et.v"], ["api_key='", "' ok"]), ("passwd: пароль99", ["пароль"], ["passwd: "]),
    ("call +14155551234 now", ["4155551234"], ["call +", " now"]), ("call 555-123-4567 now", ["555-123-4567"], ["call ", " now"]),
    ("call +49 30 1234567, or 06 12 34 56 78", ["1234567", "12 34 56 78"], ["call +", ", or "]),
    ("pay FR14 2004 1010 0505 0001 3M02 606 NOW", ["0505", "3M02", "606"], ["pay FR", " NOW"]),
    ("pay MT84MALT011000012345MTLCAST001S.", ["MTLCAST001S"], ["pay MT"]), ("card 3782 822463 10005 ok", ["822463"], ["card 3", " ok"]),
    ("Mrs Smith-Jones met Mr O'Brien and Dr McDonald's dog", ["Smith", "Jones", "Brien", "Donald"], ["Mrs ", " met Mr ", "'s dog"]),
    ("Mr Müller-Lüdenscheidt", ["Müller", "scheidt"], ["Mr "]),
]
KEPT = ["the password should be long, and the secret ingredient: love", "a token of my esteem", "on 2024-01-02 at 10.20.30", None, ""]


def test_surrogates_replace_whole_values_of_any_length_and_form(spark, documents):
    from constella.llm.surrogates import replace

    rows = [t for t, _, _ in LEFT] + KEPT + ["password: 1", "password: " + "x1" * 20_000]
    got = {r.doc_id: r for r in replace(documents([(i, t, "en") for i, t in enumerate(rows)]), "k").collect()}
    for i, (text, gone, stay) in enumerate(LEFT):
        assert got[i].n_entities and not [g for g in gone if g in got[i].text], (text, got[i].text)
        assert not [x for x in stay if x not in got[i].text], (text, got[i].text)
    for i, text in enumerate(KEPT, len(LEFT)):
        assert got[i].text == text and got[i].n_entities == 0
    assert len(got[len(rows) - 1].text) == len(rows[-1]) and "x1x1x1x1" not in got[len(rows) - 1].text


def test_surrogates_of_short_secrets_never_run_out(spark, documents):
    from constella.llm.surrogates import replace

    rows = [f"password: {i:04d}" for i in range(0, 10_000, 1)]    # every value of four digits is a real one
    got = {r.text for r in replace(documents([(i, t, "en") for i, t in enumerate(rows)]), "k").collect()}
    assert len(got) == len(rows) and not got & set(rows)
