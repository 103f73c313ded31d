import datetime
import random
import re
import string
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quillstone.llm import pii, queries

KEY = b"key of the tests"
PRIVATE = {
    "email": "anna.b-7@mail3.example.com",
    "card": "4226 9902 0008 9102 ".strip(),
    "ipv4": "152.143.123.131",
    "ssn": "123-45-6789",
    "phone": "+1 (743) 555-3824",
    "iban": "DE89 3704 0044 0532 0130 00",
    "date": "1984-02-29",
}


@pytest.fixture(scope="module")
def names():
    return pii.Pseudonyms(KEY)


def test_kinds(names):
    PRIVATE["card"] = "4111 1111 1111 1111"
    for kind, value in PRIVATE.items():
        text, spans = names.replace(f"x {value}, y {value}!")
        assert [s[0] for s in spans] == [kind, kind], (kind, spans)
        a, b = (text[lo:hi] for _, lo, hi in spans)
        assert a == b != value and len(text.split(",")) == 2
        if kind not in ("ipv4",):
            assert re.sub("[0-9]", "0", a) == re.sub("[0-9]", "0", value) or kind in ("email", "iban")
        assert pii.Pseudonyms(KEY, back=True).replace(text)[0] == f"x {value}, y {value}!"
        assert pii.Pseudonyms(b"other").replace(value)[0] not in (a, value)


def test_pseudonyms_validate(names):
    for kind, value in PRIVATE.items():
        new = names.of(kind, value)
        assert names.of(kind, new) is not None
    assert names.replace('token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"###')[0] != 'token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"###'
    # Links do not depend on the way of writing.
    assert re.sub(r"\D", "", names.of("card", "4111111111111111")) == re.sub(r"\D", "", names.of("card", "4111-1111-1111-1111"))
    assert names.replace("4465758382889437 4111111111111111")[1][-1][0] == "card"


def test_what_does_not_validate_stays(names):
    for text in ("4111111111111112", "256.1.1.1", "1.2.3.4.5", "2023-13-01", "31.02.2001", "000-12-3456", "DE00 3704 0044 0532 0130 00", "v 3.14159 in 2024", "12345", "a@b", "token of respect", "password: changeme now", "24be64439e3e49cf46b2d7c90f3602a3d0b907ff", ""):
        assert names.replace(text) == (text, []), text


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 10**6), st.integers(2, 10**6))
def test_feistel_is_a_permutation(x, n):
    x %= n
    f = pii.Feistel(b"k")
    y = f.permute(x, n, b"t")
    assert 0 <= y < n and f.permute(y, n, b"t", None, True) == x


def test_feistel_hits_each_value_once():
    f = pii.Feistel(b"k")
    assert sorted(f.permute(x, 97, b"") for x in range(97)) == list(range(97))


@settings(max_examples=200, deadline=None)
@given(st.dates(datetime.date(1900, 1, 1), datetime.date(2099, 12, 31)), st.sampled_from(["%Y-%m-%d", "%d.%m.%Y", "%m/%d/%Y", "%d/%m/%Y", "%Y/%m/%d"]))
def test_dates_round_trip(d, form):
    value = d.strftime(form)
    new = pii.Pseudonyms(KEY).date(value)
    assert new is not None and pii.Pseudonyms(KEY, back=True).date(new) == value


def test_query(spark, sf_dir):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = queries.op6_pii_pseudonyms(spark, sf_dir).collect()
    assert len(got) == len(docs)
    back = pii.Pseudonyms(queries.CONTRACT_KEY, back=True)
    changed = 0
    for r in got:
        n = sum(r[f"n_{k}"] for k in pii.KINDS)
        assert (r.text == docs[r.doc_id]) == (n == 0)
        assert back.replace(r.text)[0] == docs[r.doc_id]
        changed += n
    assert changed
    pattern = r"[\w.]+@mail\d\.example\.com|\+1 \(\d{3}\) 555-\d{4}"
    before = {v for t in docs.values() for v in re.findall(pattern, t)}
    assert before and not any(v in r.text for r in got for v in before)


def test_edge_cases(spark):
    rows = [(1, None, "a"), (2, "", "a"), (3, "call +49 30 1234567 " * 20_000, "a"), (3, "x", "a"), (3, "x", "a")]
    df = spark.createDataFrame(rows, "doc_id long, text string, kind string")
    out = {(r.doc_id, r.text and len(r.text)): r for r in pii.pseudonymize(df, key=KEY).collect()}
    assert out[(1, None)].spans == [] and out[(2, "")].spans == [] and len(out[(3, 400_000)].spans) == 20_000
    assert pii.pseudonymize(df.limit(0), key=KEY).count() == 0


@pytest.mark.parametrize("signs", [string.ascii_letters + string.digits, "0123456789abcdef", string.ascii_letters + string.digits + "+/_-"])
def test_long_secrets_change_everywhere(signs):
    r = random.Random(7)
    for size in (20, 63, 64, 65, 100, 300, 400, 600, 5_000):
        value = "7a" + "".join(r.choices(signs, k=size - 2))
        text, spans = pii.Pseudonyms(KEY).replace(f"api_key={value};")
        ((kind, lo, hi),) = spans
        new = text[lo:hi]
        assert kind == "secret" and len(new) == size
        # As many equal characters as chance gives, and in no part more.
        for part in range(0, size - 99, 100):
            assert sum(a == b and a.isalnum() for a, b in zip(value[part : part + 100], new[part : part + 100])) < 35
        other = value[:-1] + ("b" if value[-1] != "b" else "a")
        there = pii.Pseudonyms(KEY).of("secret", other)
        if size >= 100:
            assert sum(a != b for a, b in zip(new, there)) > size // 2
        assert pii.Pseudonyms(KEY, back=True).replace(text)[0] == f"api_key={value};"


def test_characterwise_network_is_a_permutation():
    import numpy as np

    f, radix = pii.Feistel(b"k"), np.array([3, 10, 4])
    every = {tuple(f.shift(np.array([a, b, c]), radix, b"t").tolist()) for a in range(3) for b in range(10) for c in range(4)}
    assert len(every) == 120


@pytest.mark.parametrize("piece", ["a-", "a.", "a_", "token ", "api_", "a@", "1-", "+4 ", "AB12", "a@a."])
def test_long_runs_take_linear_time(piece):
    text = "1 " + piece * (1_000_000 // len(piece))
    began = time.process_time()
    pii.Pseudonyms(KEY).replace(text)
    assert time.process_time() - began < 5


def test_a_secret_of_a_million_characters():
    value = "9" + "aZ3" * 333_333
    began = time.process_time()
    text, spans = pii.Pseudonyms(KEY).replace("password: " + value)
    assert len(spans) == 1 and pii.Pseudonyms(KEY, back=True).replace(text)[0] == "password: " + value
    assert time.process_time() - began < 10


def test_no_key_no_pseudonyms(spark):
    df = spark.createDataFrame([(1, "4111111111111111")], "doc_id long, text string")
    with pytest.raises(ValueError, match=pii.KEY_SETTING):
        pii.pseudonymize(df)
    spark.conf.set(pii.KEY_SETTING, KEY.decode())
    try:
        assert pii.pseudonymize(df).first().text == pii.pseudonymize(df, key=KEY).first().text != "4111111111111111"
    finally:
        spark.conf.unset(pii.KEY_SETTING)
